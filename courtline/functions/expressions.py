"""Column expressions.  Everything here is a built-in Catalyst expression, so
it stays inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampNTZType, TimestampType


def col_of(name: str) -> Column:
    """A column reference that tolerates dots in the name (``season.x``)."""
    return F.col(f"`{name}`")


def to_int(c: Column, source_type=None, target: str = "int") -> Column:
    """Lenient integer cast that never raises under ANSI mode.

    Whole numbers in text are cast as they are, so that long ones stay exact;
    other text such as ``'12.0'`` goes through double.  Anything unparsable
    becomes null instead of failing the job.
    """
    if source_type is not None and isinstance(source_type, NumericType):
        return c.try_cast(target)
    return F.coalesce(c.try_cast(target), c.try_cast("double").try_cast(target))


def margin_to_int(c: Column, source_type=None) -> Column:
    """Score margin text (``'TIE'``, ``'-7'``, ``'12'``) as an integer."""
    if source_type is not None and not isinstance(source_type, StringType):
        return to_int(c, source_type)
    return to_int(F.regexp_replace(c, "TIE", "0"))


def join_names(first: Column, second: Column, sep: str = "_") -> Column:
    """``first + sep + second``; null when either part is null."""
    if sep:
        return F.concat(first, F.lit(sep), second)
    return F.concat(first, second)


def season_start_year(season: Column) -> Column:
    """``'2018-19'`` -> 2018."""
    return F.split(season, "-").getItem(0).try_cast("int")


def season_two_digits(season: Column) -> Column:
    """``'2018-19'`` -> 19."""
    return F.right(season, F.lit(2)).try_cast("int")


def as_timestamp(c: Column, source_type=None) -> Column:
    """Text or date -> timestamp; a timestamp (with or without zone) is kept."""
    if isinstance(source_type, (TimestampType, TimestampNTZType)):
        return c
    if source_type is not None and not isinstance(source_type, StringType):
        return c.try_cast("timestamp")
    return F.try_to_timestamp(c)


def time_of_day(c: Column) -> Column:
    """Clock text, ``'7:05 PM'`` or ``'19:05[:30]'``, as ``'HH:mm:ss'``; other text is null."""
    text = F.upper(F.trim(c))
    formats = ("h:mm a", "h:mm:ss a", "H:m[:s]")
    return F.date_format(F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)),
                         "HH:mm:ss")


def replace_values(c: Column, mapping: dict) -> Column:
    """Simultaneous dictionary replace (not chained): a value is looked up once."""
    if not mapping:
        return c
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(lookup, c), c)
