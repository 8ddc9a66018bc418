"""The medallion pipeline as a run of plain functions in dependency order.

Each dataset is a function of its upstream tables.  A dataset read by more
than one downstream table (the play silver feeds three gold tables) is
written once and re-read, so its window and de-duplication run once; writing
a table also cuts the lineage, so a lost executor never forces a recompute
from the raw files.

A dataset may carry expectations: named predicates whose violations are counted while
the table is written and stored in the table ``pipeline_checks``, next to the rows of
every dataset.  Rows that violate them are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.operators import medallion as M
from courtline.operators.quality import expect_all
from courtline.operators.windows import Cuts
from courtline.sources.catalog import save_table

CHECKS_TABLE = "pipeline_checks"

# FIXED VALUES: the expectation of the original's play silver.
SILVER_EXPECTATION = ("score_margin_complete does not contain any empty rows", "score_margin_complete")


@dataclass
class Dataset:
    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    comment: str = ""
    partition_by: tuple[str, ...] = ()
    expectations: tuple[tuple[str, Column], ...] = ()


@dataclass
class Pipeline:
    datasets: list[Dataset] = field(default_factory=list)

    def add(self, ds: Dataset) -> Pipeline:
        self.datasets.append(ds)
        return self

    def order(self) -> list[Dataset]:
        """Topological order of the datasets (inputs first)."""
        by_name = {d.name: d for d in self.datasets}
        done: list[str] = []
        seen: set[str] = set()

        def visit(n: str, stack: tuple[str, ...] = ()) -> None:
            if n in seen:
                return
            if n in stack:
                raise ValueError(f"cycle through {n}")
            for i in by_name[n].inputs:
                if i in by_name:
                    visit(i, stack + (n,))
            seen.add(n)
            done.append(n)

        for d in self.datasets:
            visit(d.name)
        return [by_name[n] for n in done]

    def run(self, spark: SparkSession, database: str, sources: dict[str, DataFrame]
            ) -> dict[str, str]:
        """Materialise every dataset as ``database.name``; returns name -> table.

        ``pipeline_checks`` (table_name, expectation, rows, violations) then holds one row
        per dataset without an expectation, and one per expectation; its name is in
        the result as well.
        """
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        tables: dict[str, str] = {}
        checks: list[tuple] = []
        for ds in self.order():
            args = [sources[i] if i in sources else spark.table(tables[i]) for i in ds.inputs]
            watched, report = expect_all(ds.build(*args), ds.expectations)
            tables[ds.name] = save_table(watched, ds.name, database, comment=ds.comment or None,
                                         partition_by=ds.partition_by)
            checks += [(ds.name, *row) for row in report()]
        found = spark.createDataFrame(checks, "table_name string, expectation string, rows long, violations long")
        tables[CHECKS_TABLE] = save_table(found.coalesce(1), CHECKS_TABLE, database,
                                          comment="Rows and violated expectations of the last run")
        return tables


def medallion(sep: str = "_", expectations: Sequence[tuple[str, Column]] = (), cuts: Cuts | None = None) -> Pipeline:
    """The tables of the original; ``expectations`` are further ones of the play silver.
    ``cuts`` are those of an earlier count of the bronze plays (default: they are counted)."""
    name, column = SILVER_EXPECTATION
    silver_checks = ((name, F.col(column).isNotNull()), *expectations)
    p = Pipeline()
    p.add(Dataset("play_by_play_silver", lambda b: M.play_by_play_silver(b, sep, cuts=cuts),
                  ("play_bronze",), "Play-by-play rows: typed, names merged, scores filled, "
                  "de-duplicated", expectations=silver_checks))
    p.add(Dataset("overall_game_silver", M.overall_game_silver, ("game_bronze",),
                  "Game-level rows, one per game"))
    p.add(Dataset("play_by_event_gold", M.play_by_event_gold, ("play_by_play_silver",),
                  "Plays by season and event type"))
    p.add(Dataset("play_by_event_team_gold", M.play_by_event_team_gold,
                  ("play_by_play_silver",), "Plays by season, event type and home team"))
    p.add(Dataset("play_by_player_gold", M.play_by_player_gold, ("play_by_play_silver",),
                  "Plays by season, event type and player"))
    p.add(Dataset("team_stats_season_home_gold", M.team_stats_season_home_gold,
                  ("overall_game_silver",), "Home games and average points by team and season"))
    p.add(Dataset("team_stats_season_away_gold", M.team_stats_season_away_gold,
                  ("overall_game_silver",), "Away games and average points by team and season"))
    return p
