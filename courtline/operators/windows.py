"""Ordered-within-group operators that stay parallel when one group is huge.

A plain ``Window.partitionBy(game)`` puts every row of a game in one task.  That
is the best plan for ordinary games, and the only trouble is a game with so many
rows that its task is the whole job.  So the operators look for *hot* groups, those
above ``segment_rows``, in one count over the key columns (``hot_cuts``; a caller that
runs several operators over one input counts once and passes the result on).  Without
any, the plain window runs and nothing else.

**Order.**  Rows are ordered by the order key, then by the tiebreak columns, then by
a 64-bit digest of the whole row.  So the result is a function of the rows alone:
only rows equal in all columns can change places, which changes nothing.  (Map
columns cannot be hashed and do not count towards the digest.)

**Cuts.**  Each hot group is cut into as many segments as its own rows ask for, at
quantiles of its order key from one KLL sketch per group, whose size follows the
number of cuts.  A value that holds several quantiles is a run of ties; it is cut
inside, by the next tiebreak column in the same way, or, behind the last one, by
equal ranges of the digest.  Null order keys are such a run too.  There are fewer cuts
than rows / ``segment_rows``, however the keys are spread; all other groups are segment 0.
A row finds its segment in a search tree of cuts, 64 to a node, with one broadcast
join for each level.

The window then runs per (group, segment), and only hot groups need stitching:

* ``forward_fill``: a segment's carry-in value is the last non-null value of the
  segments before it (a window over one summary row per segment); the carry row
  goes in front of the segment's rows;
* ``lag_rows``: the first ``n`` rows of a segment get their values from "halo" copies
  of the last rows of the segments before, matched on (group, segment, index).

**Tasks.**  The planner sizes window tasks by shuffled bytes, which are compressed and
often of fewer columns than the window sorts, so a task's memory grows with the input
up to many times that size.  The count tells the rows too, so they are dealt (``deal``) by
group to as many tasks as ``TASK_ROWS`` asks for.

Results equal the single-window form; group and order keys may be null (nulls come
first and match each other).  Order keys are cut if they are whole numbers, floating
point numbers, dates, timestamps or decimals of at most 18 digits; a hot group ordered
by anything else stays one segment, and so do rows whose key is NaN.  Equal rows have equal digests, so a row copied millions
of times is one segment: remove or count copies first, as the silver table does.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of a group that one window task sorts; regular games have < 1,000.
SEGMENT_ROWS = 2_000_000
# Pieces of one order key of a group: a sketch tells no more quantiles apart.  A game
# of more than MAX_PIECES * SEGMENT_ROWS rows (16 billion) gets longer segments.
MAX_PIECES = 1 << 13
# Cuts of all groups together, which are broadcast (24 bytes each and more with
# tiebreaks); with more than MAX_CUTS * SEGMENT_ROWS rows (500 billion) in hot groups
# all segments grow alike.
MAX_CUTS = 1 << 18
# Cuts in a node of the search tree.
FANOUT = 64
# Rows dealt to a task, on average.  A row of the play silver takes some 1.6 KB there: the
# sort of the window and both hash tables of the whole-row de-duplication behind it.
TASK_ROWS = 200_000
# Tasks of one window; with more than MAX_TASKS * TASK_ROWS rows (13 billion) they grow
# and spill.
MAX_TASKS = 1 << 16

_SEG = "__seg"
_DIGEST = "__digest"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)))


def row_digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """64 bits of the whole row (or of ``cols``): the last tiebreak of every ordered window."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes
                        if (cols is None or c in cols) and "map<" not in t and "variant" not in t])


def _number(name: str, dtype: str) -> Column | None:
    """The column as a long or a double that orders alike and keeps values apart, or
    None for a type that has no such number."""
    c = F.col(name)
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("long")
    if dtype in ("float", "double"):
        return c.cast("double")
    if dtype == "date":
        return F.unix_date(c).cast("long")
    if dtype == "timestamp":
        return F.unix_micros(c)
    if dtype == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c)
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", dtype)
    if digits and int(digits[1]) <= 18:
        return (c * F.lit(10 ** int(digits[2])).cast("decimal(19,0)")).cast("long")
    return None


@dataclass(frozen=True)
class Cuts:
    """Where hot groups are cut.  ``levels`` are the search tree's tables, its root first:
    (group keys, ``__node``, ``__cuts``), ``__cuts`` an array of structs that compare with
    ``key``.  ``inside``: some cut lies between rows that tie on the order key.
    ``rows``: all that were counted (0: not counted).  ``groups``: the hot groups' keys and
    the tasks that their rows ask for (``__tasks``)."""

    by: tuple[str, ...]
    orders: tuple[str, ...]
    levels: tuple[DataFrame, ...] = ()
    count: int = 0
    inside: bool = False
    rows: int = 0
    groups: DataFrame | None = None

    @property
    def empty(self) -> bool:
        return not self.levels

    def tasks(self, spark: SparkSession) -> int:
        return task_count(spark, self.rows, TASK_ROWS)

    def key(self, dtypes: dict[str, str]) -> Column:
        """A row's place.  A cut has a 1 behind each value within which it lies and a 2
        behind the value after which it comes; so it compares as a struct."""
        parts = []
        for i, o in enumerate(self.orders):
            value = _number(o, dtypes[o])
            if value is None:  # only its nulls can be cut
                value = F.when(F.col(o).isNotNull(), F.lit(0).cast("long"))
            parts += [value.alias(f"o{i}"), F.lit(1).alias(f"m{i}")]
        return F.struct(*parts, F.col(_DIGEST).alias("d"))


def _digest_cuts(n: int) -> list[int]:
    """``n`` digests that cut a run of ties into n + 1 like parts."""
    return [-(1 << 63) + (1 << 64) * j // (n + 1) for j in range(1, n + 1)]


def _quantile_cuts(df: DataFrame, by: list[str], order: str, hot: list, segment_rows: int) -> dict[int, list]:
    """For each group number of ``hot`` (rows of keys, counts) its cut values, rising."""
    wanted = {g: min(MAX_PIECES, -(-r["__known"] // segment_rows)) for g, r in enumerate(hot)}
    wanted = {g: p for g, p in wanted.items() if p > 1}
    if not wanted:
        return {}
    spark, types = df.sparkSession, dict(df.dtypes)
    value = _number(order, types[order])
    if value is None:
        return {}
    keys = [f"__k{i}" for i in range(len(by))]
    schema = ", ".join(f"{k} {types[b]}" for b, k in zip(by, keys))
    # sketches of like size together: the grid of a class has four steps or more a piece
    classes = sorted({p.bit_length() + 2 for p in wanted.values()})
    groups = spark.createDataFrame(
        [(*[hot[g][k] for k in keys], g, p.bit_length() + 2) for g, p in wanted.items()],
        f"{schema}, __g int, __class int")
    kind = "bigint" if dict(df.select(value.alias("v")).dtypes)["v"] == "bigint" else "double"
    sketch, quantile = (getattr(F, f"kll_sketch_{f}_{kind}") for f in ("agg", "get_quantile"))
    if kind == "double":
        value = F.when(~F.isnan(value), value)
    rows = df.join(F.broadcast(groups), _same(by, keys)).select("__g", "__class", value.alias("__v"))
    sketched = rows.groupBy("__g", "__class").agg(*[
        sketch(F.when(F.col("__class") == c, F.col("__v")), F.lit(min(65535, 4 << c))).alias(f"__s{c}")
        for c in classes])
    found = F.coalesce(*[F.when(F.col("__class") == c, quantile(f"__s{c}", F.expr(
        "array(" + ", ".join(f"{i / (1 << c)}D" for i in range(1, 1 << c)) + ")"))) for c in classes])
    out = {}
    for r in sketched.select("__g", "__class", found.alias("q")).collect():
        pieces, steps = wanted[r["__g"]], 1 << r["__class"]
        out[r["__g"]] = [r["q"][max(1, round(i * steps / pieces)) - 1] for i in range(1, pieces)]
    return out


def _group_cuts(df: DataFrame, by: list[str], orders: list[str], segment_rows: int
                ) -> tuple[list[tuple[tuple, list[tuple]]], int]:
    """(group keys, cuts) of the groups above ``segment_rows`` rows, and the rows of all groups;
    a cut is (value, 1 or 2, value of the tiebreak, 1 or 2, .., digest), with None behind a 2."""
    types = dict(df.dtypes)
    keys = [f"__k{i}" for i in range(len(by))]
    counts = (df.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys)])
              .agg(F.count(F.lit(1)).alias("__rows"), F.count(orders[0]).alias("__known")))
    # one job: the hot groups (at most rows / segment_rows) come with the sum of all
    total, hot = counts.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)),
        F.collect_list(F.when(F.col("__rows") > segment_rows, F.struct(*keys, "__rows", "__known")))).first()
    if not hot:
        return [], total
    segment_rows = max(segment_rows, sum(r["__rows"] for r in hot) // MAX_CUTS)
    quantiles = _quantile_cuts(df, by, orders[0], hot, segment_rows)
    rest = 2 * (len(orders) - 1)
    out, runs = [], []
    for g, r in enumerate(hot):
        nulls = r["__rows"] - r["__known"]
        held: dict = {None: -(-nulls // segment_rows) - 1} if nulls > segment_rows else {}
        for v in quantiles.get(g, ()):
            held[v] = held.get(v, 0) + 1
        cuts = []
        for v, n in held.items():
            if n == 1 and v is not None:
                cuts.append((v, 2, *[None] * (rest + 1)))
            elif len(orders) == 1:
                cuts += [(v, 1, d) for d in _digest_cuts(n)]
            else:
                runs.append((g, v))
        out.append((tuple(r[k] for k in keys), cuts))
    if runs:
        # runs of ties are groups of their own, cut by the next column
        value = _number(orders[0], types[orders[0]])
        value_type = "long" if value is None else dict(df.select(value.alias("v")).dtypes)["v"]
        number = {i: g for g, i in enumerate(runs)}
        run_key = f"__run{len(orders)}"
        listed = df.sparkSession.createDataFrame(
            [(*hot[g], v, number[g, v]) for g, v in runs],
            ", ".join(f"{k} {types[b]}" for b, k in zip(by, keys)) + f", __rows long, __known long, __v {value_type}, {run_key} int")
        tie = F.col(orders[0]).isNull() if value is None else value.eqNullSafe(F.col("__v"))
        tied = df.join(F.broadcast(listed), _same(by, keys) & tie).select(
            run_key, *orders[1:])
        for (run,), inner in _group_cuts(tied, [run_key], orders[1:], segment_rows)[0]:
            g, v = runs[run]
            out[g][1].extend((v, 1, *c) for c in inner)
    return [(k, sorted(c, key=lambda cut: tuple((x is not None, x if x is not None else 0) for x in cut)))
            for k, c in out if c], total


def hot_cuts(df: DataFrame, by: str | Sequence[str] = "game_id", order: str = "event_num",
             tiebreak: Sequence[str] = (), segment_rows: int | None = SEGMENT_ROWS) -> Cuts:
    """The cuts of the groups above ``segment_rows`` rows (``empty`` if there are none).

    One count over the key columns of ``df`` runs here, and for hot groups one pass over
    their rows for the sketches, one more where ties are cut by a tiebreak column.  The
    cuts serve any frame with the same keys and no more rows to a group, such as one
    with copies removed or rows filtered: segments only come out smaller.
    """
    by, orders = _as_list(by), [order, *tiebreak]
    if segment_rows is None:
        return Cuts(tuple(by), tuple(orders))
    types = dict(df.dtypes)
    found, total = _group_cuts(df.select(*by, *[o for o in orders if o not in by]), by, orders, segment_rows)
    if not found:
        return Cuts(tuple(by), tuple(orders), rows=total)
    numbers = [_number(o, types[o]) for o in orders]
    kinds = ["long" if n is None else dict(df.select(n.alias("v")).dtypes)["v"] for n in numbers]
    struct = ", ".join(f"o{i}: {k}, m{i}: int" for i, k in enumerate(kinds)) + ", d: long"
    keys = [f"__k{i}" for i in range(len(by))]
    schema = ", ".join(f"{k} {types[b]}" for b, k in zip(by, keys)) + f", __node long, __cuts array<struct<{struct}>>"
    groups = df.sparkSession.createDataFrame(
        [(*k, -(-(len(c) + 1) * segment_rows // TASK_ROWS)) for k, c in found],
        ", ".join([*(f"{k} {types[b]}" for b, k in zip(by, keys)), "__tasks int"]))
    levels, lists = [], found
    while True:
        rows = [(*k, at // FANOUT, c[at:at + FANOUT]) for k, c in lists for at in range(0, max(1, len(c)), FANOUT)]
        levels.append(df.sparkSession.createDataFrame(rows, schema))
        if all(len(c) <= FANOUT for _, c in lists):
            break
        # what leads to node j of the level below is its first cut
        lists = [(k, c[FANOUT::FANOUT]) for k, c in lists]
    return Cuts(tuple(by), tuple(orders), tuple(reversed(levels)), sum(len(c) for _, c in found),
                any(cut[1] == 1 for _, c in found for cut in c), total, groups)


def task_count(spark: SparkSession, rows: int, task_rows: int) -> int:
    """Tasks that ``rows`` are dealt to: as many as ``task_rows`` asks for and no fewer than
    there are cores; 0 (no dealing) if one task can take them all."""
    if rows <= task_rows:
        return 0
    return min(MAX_TASKS, max(-(-rows // task_rows), spark.sparkContext.defaultParallelism))


def even_tasks(df: DataFrame, by: Sequence[str], task_rows: int) -> int:
    """``task_count`` of ``df``, or 0 if a key of ``by`` holds more than ``SEGMENT_ROWS``: such
    a key is left to the planner, which splits its join.

    Keys are counted by buckets of their hash, so that the count takes no memory by key; a
    bucket far above the mean holds a hot key.
    """
    buckets = 1 << 16
    counts = df.groupBy(F.pmod(F.xxhash64(*by), F.lit(buckets)).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    rows, most = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.max("__n"), F.lit(0))).first()
    return 0 if most > SEGMENT_ROWS + 2 * rows // buckets else task_count(df.sparkSession, rows, task_rows)


def deal(df: DataFrame, by: Sequence[str], cuts: Cuts) -> DataFrame:
    """``df`` hash-partitioned by ``by`` over ``cuts.tasks``.  The shuffle stands in for that of
    the window behind it, and falls away if ``df`` comes dealt alike."""
    tasks = cuts.tasks(df.sparkSession)
    return df.repartition(tasks, *by) if tasks else df


def with_segment(df: DataFrame, cuts: Cuts) -> DataFrame:
    """``df`` (with its digest) and each row's segment: the number of its group's cuts
    that lie before it."""
    by, key = list(cuts.by), cuts.key(dict(df.dtypes))
    keys = [f"__k{i}" for i in range(len(by))]
    out = df.withColumn(_SEG, F.lit(0).cast("long")).withColumn("__key", key)
    for level in cuts.levels:
        met = out.join(F.broadcast(level), _same([*by, _SEG], [*keys, "__node"]), "left")
        below = F.size(F.filter("__cuts", lambda c: c < F.col("__key")))
        place = F.col(_SEG) * FANOUT + below
        out = met.withColumn(_SEG, F.when(F.col("__cuts").isNull(), F.col(_SEG)).otherwise(place)).drop(
            "__cuts", "__node", *keys)
    return out.drop("__key")


def _only_hot(df: DataFrame, cuts: Cuts) -> DataFrame:
    keys = [f"__k{i}" for i in range(len(cuts.by))]
    groups = cuts.levels[0].select(*keys)
    return df.join(F.broadcast(groups), _same(cuts.by, keys), "left_semi")


def _checked(cuts: Cuts | None, df: DataFrame, by: list[str], orders: list[str], segment_rows: int | None) -> Cuts:
    if cuts is None:
        return hot_cuts(df, by, orders[0], orders[1:], segment_rows)
    if cuts.by != tuple(by) or cuts.orders != tuple(orders):
        raise ValueError(f"cuts of {cuts.by} ordered by {cuts.orders} used for {by} ordered by {orders}")
    return cuts


def forward_fill(df: DataFrame, cols: Sequence[str], by: str | Sequence[str] = "game_id",
                 order: str = "event_num", tiebreak: Sequence[str] = (),
                 segment_rows: int | None = SEGMENT_ROWS, cuts: Cuts | None = None,
                 segment_column: str | None = None, digest_of: Sequence[str] | None = None) -> DataFrame:
    """Replace each null in ``cols`` by the last non-null value earlier in its group.

    ``segment_rows=None`` uses one window per group.  ``cuts`` are those of an earlier
    count (default: ``df`` is counted).  ``segment_column`` keeps the segment id under that
    name if there are hot groups and no cut lies between ties: it is then a function of
    group and order key, and the output is hash-partitioned by (group, segment), so a
    later whole-row de-duplication that includes it needs no second shuffle.
    ``digest_of`` names the columns that tell rows apart (default: all).
    """
    by, cols, orders = _as_list(by), list(cols), [order, *tiebreak]
    cuts = _checked(cuts, df, by, orders, segment_rows)
    if cuts.empty:
        w = (Window.partitionBy(*by).orderBy(*orders, row_digest(df, digest_of))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return deal(df, by, cuts).withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})

    rows = with_segment(df.withColumn(_DIGEST, row_digest(df, digest_of)), cuts)
    keys, orders = [*by, _SEG], [*orders, _DIGEST]
    # the last non-null value of each segment of the hot groups, and from it the
    # carry-in of each segment: one row per segment
    summary = _only_hot(rows, cuts).groupBy(*keys).agg(*[
        F.max(F.when(F.col(c).isNotNull(),
                     F.struct(*[F.col(o) for o in orders], F.col(c).alias("v"))))
        .getField("v").alias(f"__l{i}") for i, c in enumerate(cols)])
    w_carry = Window.partitionBy(*by).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, *[
        F.last(f"__l{i}", ignorenulls=True).over(w_carry).alias(c) for i, c in enumerate(cols)])
    # the carry row goes first in its window partition: one shuffle, no join
    both = rows.withColumn("__m", F.lit(1)).unionByName(
        carry.withColumn("__m", F.lit(0)), allowMissingColumns=True)
    w = (Window.partitionBy(*keys).orderBy("__m", *orders)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = deal(both, keys, cuts).withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    out = out.filter(F.col("__m") == 1)
    if segment_column and not cuts.inside:
        return out.select(*df.columns, F.col(_SEG).alias(segment_column))
    return out.select(*df.columns)


def _halo(rows: DataFrame, cols: Sequence[str], outs: Sequence[str], n: int, by: list[str],
          orders: list[str]) -> DataFrame:
    """For the first ``n`` rows of each segment of ``rows`` (hot groups): ``__h*`` group
    keys, ``__hs`` segment, ``__hr`` row number in it, and the values ``n`` rows back.

    A segment's last ``n`` rows go to the later segments within reach; segments
    shorter than ``n`` pass the reach on to the next.
    """
    keys = [*by, _SEG]
    w = Window.partitionBy(*keys).orderBy(*orders)
    local = rows.select(*keys, F.row_number().over(w).alias("__rn"),
                        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("__cnt"),
                        *[F.col(c).alias(f"__v{j}") for j, c in enumerate(cols)])
    w_next = Window.partitionBy(*by).orderBy(_SEG).rowsBetween(1, n)
    following = F.collect_list(F.struct(F.col(_SEG).alias("s"), F.col("__cnt").alias("c"))).over(w_next)
    counts = local.filter("__rn = 1").select(*keys, "__cnt")
    # rows between a segment's end and each of the segments after it
    reach = counts.select(*[F.col(k).alias(f"__q{i}") for i, k in enumerate(keys)],
                          following.alias("__next"))
    reach = reach.withColumn("__next", F.transform("__next", lambda x, i: F.struct(
        x["s"].alias("s"), F.aggregate(F.slice("__next", 1, i), F.lit(0).cast("long"),
                                       lambda acc, y: acc + y["c"]).alias("gap"))))
    tail = local.withColumn("__back", F.col("__cnt") - F.col("__rn")).filter(F.col("__back") < n)
    met = tail.join(reach, _same(keys, [f"__q{i}" for i in range(len(keys))]))
    met = met.select("*", F.explode(F.filter(
        F.transform("__next", lambda x: F.struct(
            x["s"].alias("s"), (F.lit(n) - F.col("__back") - x["gap"]).alias("row"))),
        lambda e: e["row"] > 0)).alias("__to"))
    return met.select(*[F.col(b).alias(f"__h{i}") for i, b in enumerate(by)],
                      F.col("__to.s").alias("__hs"), F.col("__to.row").alias("__hr"),
                      *[F.col(f"__v{j}").alias(f"__halo_{o}") for j, o in enumerate(outs)])


def _lag(df: DataFrame, cols: Sequence[str], outs: Sequence[str], n: int, by: list[str],
         orders: list[str], segment_rows: int | None, cuts: Cuts | None) -> DataFrame:
    """``df`` plus ``outs[j]`` = ``cols[j]`` of the row ``n`` rows earlier in the group."""
    cuts = _checked(cuts, df, by, orders, segment_rows if n > 0 else None)
    if cuts.empty or n <= 0:
        w = Window.partitionBy(*by).orderBy(*orders, row_digest(df))
        return deal(df, by, cuts).withColumns({o: F.lag(c, n).over(w) for c, o in zip(cols, outs)})
    rows = with_segment(df.withColumn(_DIGEST, row_digest(df)), cuts)
    orders = [*orders, _DIGEST]
    w = Window.partitionBy(*by, _SEG).orderBy(*orders)
    local = deal(rows, [*by, _SEG], cuts).withColumns({
        "__rn": F.row_number().over(w), **{o: F.lag(c, n).over(w) for c, o in zip(cols, outs)}})
    halo = _halo(_only_hot(rows, cuts), cols, outs, n, by, orders)
    first = [*[f"__h{i}" for i in range(len(by))], "__hs", "__hr"]
    joined = local.join(halo, _same([*by, _SEG, "__rn"], first), "left")
    # a halo row is met only by a row that has no lagged value in its own segment
    return joined.select(*df.columns, *[
        F.when(F.col("__hr").isNotNull(), F.col(f"__halo_{o}")).otherwise(F.col(o)).alias(o)
        for o in outs])


def lag_rows(df: DataFrame, col: str, n: int, out: str, by: str | Sequence[str] = "game_id",
             order: str = "event_num", tiebreak: Sequence[str] = (),
             segment_rows: int | None = SEGMENT_ROWS, cuts: Cuts | None = None) -> DataFrame:
    """Value of ``col`` ``n`` rows earlier in the group (null for the first ``n``)."""
    return _lag(df, [col], [out], n, _as_list(by), [order, *tiebreak], segment_rows, cuts)


def lag_all_columns(df: DataFrame, n: int, by: str | Sequence[str] = "game_id",
                    order: str = "event_num", tiebreak: Sequence[str] = (),
                    keep: Sequence[str] = (), suffix: str = "",
                    segment_rows: int | None = SEGMENT_ROWS, cuts: Cuts | None = None) -> DataFrame:
    """Shift every column ``n`` rows down within its group (a frame-wide shift).

    Columns in ``keep`` (plus the group and order columns) are kept as they
    are, the others are replaced by their lagged values (named ``c + suffix``).
    """
    by = _as_list(by)
    fixed = [*by, order, *[k for k in keep if k not in by and k != order]]
    moving = [c for c in df.columns if c not in fixed]
    outs = [f"__lag{j}" for j in range(len(moving))]
    res = _lag(df, moving, outs, n, by, [order, *tiebreak], segment_rows, cuts)
    return res.select(*fixed, *[F.col(o).alias(c + suffix) for c, o in zip(moving, outs)])
