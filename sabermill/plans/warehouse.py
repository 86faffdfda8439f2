"""All models over the seven raw tables, each built on first use."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sabermill.plans import intermediate, marts, staging

STAGING = [
    "stg_teams", "stg_players", "stg_games", "stg_schedule", "stg_batting_stats",
    "stg_pitching_stats", "stg_statcast",
]
INTERMEDIATE = [
    "int_game_results", "int_player_season_batting", "int_player_season_pitching",
    "int_statcast_metrics", "int_team_standings",
]
MARTS = [
    "dim_players", "dim_teams", "fct_batting_performance", "fct_pitching_performance",
    "fct_game_summary", "fct_statcast_leaders", "fct_team_season_summary",
]


class Warehouse:
    """Lazy models by name.

    ``written`` holds models that were materialised before; they are read instead of derived.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        min_batted_balls: int = marts.MIN_BATTED_BALLS,
        written: dict[str, DataFrame] | None = None,
    ):
        self.raw = raw
        self.min_batted_balls = min_batted_balls
        for name, df in (written or {}).items():
            self.__dict__[name] = df

    @cached_property
    def stg_teams(self) -> DataFrame:
        return staging.stg_teams(self.raw["teams"])

    @cached_property
    def stg_players(self) -> DataFrame:
        return staging.stg_players(self.raw["players"])

    @cached_property
    def stg_games(self) -> DataFrame:
        return staging.stg_games(self.raw["games"])

    @cached_property
    def stg_schedule(self) -> DataFrame:
        return staging.stg_schedule(self.raw["schedule"])

    @cached_property
    def stg_batting_stats(self) -> DataFrame:
        return staging.stg_batting_stats(self.raw["batting_stats"])

    @cached_property
    def stg_pitching_stats(self) -> DataFrame:
        return staging.stg_pitching_stats(self.raw["pitching_stats"])

    @cached_property
    def stg_statcast(self) -> DataFrame:
        return staging.stg_statcast(self.raw["statcast"])

    @cached_property
    def int_game_results(self) -> DataFrame:
        return intermediate.int_game_results(self.stg_games)

    @cached_property
    def int_player_season_batting(self) -> DataFrame:
        return intermediate.int_player_season_batting(self.stg_batting_stats)

    @cached_property
    def int_player_season_pitching(self) -> DataFrame:
        return intermediate.int_player_season_pitching(self.stg_pitching_stats)

    @cached_property
    def int_statcast_metrics(self) -> DataFrame:
        return intermediate.int_statcast_metrics(self.stg_statcast)

    @cached_property
    def int_team_standings(self) -> DataFrame:
        return intermediate.int_team_standings(self.int_game_results, self.stg_teams)

    @cached_property
    def dim_players(self) -> DataFrame:
        return marts.dim_players(self.stg_players, self.stg_teams)

    @cached_property
    def dim_teams(self) -> DataFrame:
        return marts.dim_teams(self.stg_teams)

    @cached_property
    def fct_batting_performance(self) -> DataFrame:
        return marts.fct_batting_performance(
            self.int_player_season_batting, self._contact(intermediate.BATTER), self.stg_players
        )

    @cached_property
    def fct_pitching_performance(self) -> DataFrame:
        return marts.fct_pitching_performance(
            self.int_player_season_pitching, self._contact(intermediate.PITCHER), self.stg_players
        )

    @cached_property
    def fct_game_summary(self) -> DataFrame:
        return marts.fct_game_summary(self.stg_games, self.stg_teams, self.stg_players)

    @cached_property
    def fct_statcast_leaders(self) -> DataFrame:
        return marts.fct_statcast_leaders(
            self.int_statcast_metrics, self.stg_players, self.min_batted_balls
        )

    @cached_property
    def fct_team_season_summary(self) -> DataFrame:
        return marts.fct_team_season_summary(
            self.int_team_standings, self.stg_batting_stats, self.stg_pitching_stats
        )

    def _contact(self, role: str) -> DataFrame:
        """The written metrics if there are any, else just the role a mart reads."""
        if "int_statcast_metrics" in self.__dict__:
            return self.int_statcast_metrics
        return intermediate.contact_metrics(self.stg_statcast, role)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self, names: list[str]) -> None:
        for name in names:
            self.model(name).createOrReplaceTempView(name)


# Models that read only staging models or the ones before; each group is written at once.
STEPS = [
    [name for name in INTERMEDIATE if name != "int_team_standings"],
    ["int_team_standings"],
    MARTS,
]
SEASON = "season"


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str,
    views: str | None = None,
    parallel: int = 4,
    **options,
) -> "Warehouse":
    """Write all models as a new version under ``folder`` and read them from there.

    Models of a step run at once. Tables with a season lie in season folders, so a query for a
    season reads its folders only. Older versions are not touched: a failed build leaves
    them as they were, and a reader keeps its version. ``views`` is a prefix under which
    catalog views are pointed at the new version, after everything is written.
    """
    version = f"{folder}/{uuid.uuid4().hex}"
    warehouse = Warehouse(raw, **options)
    written: dict[str, DataFrame] = {}

    def write(name: str) -> tuple[str, DataFrame]:
        df = warehouse.model(name)
        path = f"{version}/{name}"
        if SEASON in df.columns:
            df.hint("rebalance", SEASON).write.partitionBy(SEASON).parquet(path)
        else:
            df.write.parquet(path)
        return name, spark.read.schema(df.schema).parquet(path).select(*df.columns)

    with ThreadPoolExecutor(parallel) as pool:
        for step in STEPS:
            written |= dict(pool.map(write, step))
            warehouse = Warehouse(raw, written=written, **options)
    if views is not None:
        for name, df in written.items():
            columns = ", ".join(df.columns)
            spark.sql(
                f"CREATE OR REPLACE VIEW {views}{name} AS "
                f"SELECT {columns} FROM parquet.`{version}/{name}`"
            )
    return warehouse
