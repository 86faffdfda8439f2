"""The given star-schema tables seen as the seven raw tables.

Every row of the given tables is used; all values are whole-number arithmetic on their columns,
so a second engine computes the same ones. ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from harness import fillers
from sabermill.schemas import raw_schema

# Division names in the long form, by number.
DIVISIONS = [
    "American League East",
    "American League Central",
    "American League West",
    "National League East",
    "National League Central",
    "National League West",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def div(a: Column, b: int) -> Column:
    """Whole-number quotient, for values that are not negative."""
    return F.call_function("div", a, F.lit(b))


def tenths(value: Column) -> Column:
    return value.cast("decimal(15,0)") * F.lit(Decimal("0.1"))


def thousandths(value: Column) -> Column:
    return value.cast("decimal(13,0)") * F.lit(Decimal("0.001"))


def ratio(num: Column, den: Column, places: int, guard: Column | None = None) -> Column:
    positive = den if guard is None else guard
    exact = num.cast("decimal(20,1)") / den.cast("decimal(20,1)")
    return F.when(positive > 0, F.round(exact, places))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nat = F.col("s_suppkey"), F.col("s_nationkey")
    slot = nat % 6
    division = F.element_at(F.array(*[F.lit(d) for d in DIVISIONS]), slot + 1)
    return table(spark, sf_dir, "supplier").select(
        key.alias("team_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("c"), key.cast("string")).alias("team_code"),
        F.concat(F.lit("T"), key.cast("string")).alias("abbreviation"),
        F.concat(F.lit("Team "), key.cast("string")).alias("team_name"),
        F.concat(F.lit("NATION_"), nat.cast("string")).alias("location_name"),
        (F.lit(103) + div(slot, 3)).alias("league_id"),
        F.when(slot < 3, "American League").otherwise("National League").alias("league_name"),
        F.when(nat != 24, slot + 200).alias("division_id"),
        F.when(nat != 24, division).alias("division_name"),
        key.alias("venue_id"),
        F.concat(F.lit("Park "), key.cast("string")).alias("venue_name"),
        F.lit(1).alias("sport_id"),
        (F.col("s_acctbal") >= 0).alias("active"),
        F.when(key % 50 == 7, "n/a")
        .otherwise((F.lit(1900) + key % 100).cast("string"))
        .alias("first_year_of_play"),
        F.current_timestamp().alias("loaded_at"),
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1970-01-01").cast("date"), (key % 9000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.alias("player_id"),
        F.col("c_name").alias("full_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        (key % 100).cast("string").alias("primary_number"),
        born.alias("birth_date"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("birth_city"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("birth_country"),
        F.concat((F.lit(60) + key % 20).cast("string"), F.lit("in")).alias("height"),
        (F.lit(150) + key % 100).alias("weight"),
        (key % 10).cast("string").alias("primary_position_code"),
        F.when(key % 29 != 0, F.col("c_mktsegment")).alias("primary_position_name"),
        F.when(key % 3 == 0, "Pitcher")
        .when(key % 3 == 1, "Infielder")
        .otherwise("Outfielder")
        .alias("primary_position_type"),
        F.when(key % 3 == 0, "R").when(key % 3 == 1, "L").otherwise("S").alias("bat_side"),
        F.when(key % 2 == 0, "R").otherwise("L").alias("pitch_hand"),
        F.when(key % 17 != 0, div(key, 15)).alias("current_team_id"),
        F.date_add(born, 8000).alias("mlb_debut_date"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.current_timestamp().alias("loaded_at"),
    )


def _fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What games and schedule share: one row per order."""
    key, price = F.col("o_orderkey"), F.floor(F.col("o_totalprice")).cast("long")
    home = div(F.col("o_custkey"), 15)
    visitor = div(key, 150)
    neighbour = home + 1 - (home % 2) * 2
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        key.alias("game_pk"),
        price.alias("price"),
        F.col("o_custkey").alias("custkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "P").otherwise("R").alias("game_type"),
        F.year("o_orderdate").alias("season"),
        F.to_date("o_orderdate").alias("game_date"),
        F.col("o_orderdate").cast("timestamp").alias("game_datetime"),
        status.alias("status_code"),
        F.when(status == "F", "Final")
        .when(status == "P", "Completed Early")
        .otherwise("Scheduled")
        .alias("status_detail"),
        home.alias("home_team_id"),
        F.when(visitor == home, neighbour).otherwise(visitor).alias("away_team_id"),
        F.when(key % 2 == 0, "day").otherwise("night").alias("day_night"),
        F.concat(F.lit("Series "), (key % 3).cast("string")).alias("series_description"),
        (key % 4 + 1).alias("series_game_number"),
        F.when(key % 20 == 0, "Y").otherwise("N").alias("double_header"),
        F.current_timestamp().alias("loaded_at"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("game_pk"), F.col("price")
    scored = (F.col("status_code") != "O") & (key % 97 != 0)
    return _fixture(spark, sf_dir).select(
        "game_pk", "game_type", "season", "game_date", "game_datetime", "status_code",
        "status_detail", "home_team_id", "away_team_id",
        F.when(scored, price % 13).alias("home_score"),
        F.when(scored, div(price, 13) % 13).alias("away_score"),
        (key % 90).alias("home_wins"),
        (key % 70).alias("home_losses"),
        (price % 90).alias("away_wins"),
        (price % 70).alias("away_losses"),
        F.col("home_team_id").alias("venue_id"),
        F.concat(F.lit("Park "), F.col("home_team_id").cast("string")).alias("venue_name"),
        F.col("custkey").alias("winning_pitcher_id"),
        div(key, 10).alias("losing_pitcher_id"),
        F.when(key % 3 == 0, div(F.col("custkey"), 2)).alias("save_pitcher_id"),
        F.when(F.col("status_code") != "O", F.when(key % 5 == 0, key % 4 + 9).otherwise(9))
        .alias("innings"),
        "day_night", "series_description", "series_game_number", "double_header", "loaded_at",
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    home, away = F.col("home_team_id"), F.col("away_team_id")
    return _fixture(spark, sf_dir).select(
        F.col("game_pk").alias("id"), "game_pk", "game_date", "game_type", "season",
        "status_code", "status_detail", "home_team_id",
        F.concat(F.lit("Team "), home.cast("string")).alias("home_team_name"),
        "away_team_id",
        F.concat(F.lit("Team "), away.cast("string")).alias("away_team_name"),
        home.alias("venue_id"),
        F.concat(F.lit("Park "), home.cast("string")).alias("venue_name"),
        "game_datetime", "day_night", "series_description", "series_game_number",
        F.lit(4).alias("games_in_series"), "double_header",
        F.when(F.col("double_header") == "Y", 7).otherwise(9).alias("scheduled_innings"),
        "loaded_at",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "q": F.col("l_quantity").cast("int"),
            "n": F.col("l_linenumber"),
            "season": F.year("l_shipdate"),
            "game_type": F.when(F.col("l_linenumber") == 7, "P").otherwise("R"),
        }
    )


def batting_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n, order = F.col("q"), F.col("n"), F.col("l_orderkey")
    counted = {
        "games_played": F.lit(1),
        "at_bats": q - 1,
        "runs": div(q, 6),
        "hits": div(q, 4),
        "doubles": div(q, 20),
        "triples": F.when(F.col("l_returnflag") != "N", div(q, 40)),
        "home_runs": div(q, 16),
        "rbi": div(q, 3),
        "stolen_bases": q % 3,
        "caught_stealing": div(q % 7, 6),
        "walks": n,
        "strikeouts": div(q, 5),
        "ground_into_dp": div(q % 11, 10),
        "hit_by_pitch": order % 2,
        "sacrifice_bunts": div(order % 5, 4),
        "sacrifice_flies": order % 3,
        "intentional_walks": div(n, 6),
    }
    c = {name: F.col(name) for name in counted}
    chances = c["at_bats"] + c["walks"] + c["hit_by_pitch"] + c["sacrifice_flies"]
    triples = F.coalesce(c["triples"], F.lit(0))
    return (
        _lines(spark, sf_dir)
        .groupBy(
            F.col("l_partkey").alias("player_id"),
            "season",
            F.col("l_suppkey").alias("team_id"),
            "game_type",
        )
        .agg(*[F.sum(v).alias(k) for k, v in counted.items()])
        .withColumns(
            {
                "id": F.xxhash64("player_id", "season", "team_id", "game_type"),
                "league_id": F.col("team_id") % 2 + 103,
                "plate_appearances": chances,
                "total_bases": c["hits"] + c["doubles"] + triples * 2 + c["home_runs"] * 3,
            }
        )
        .withColumns(
            {
                "batting_average": ratio(c["hits"], c["at_bats"], 3),
                "obp": ratio(c["hits"] + c["walks"] + c["hit_by_pitch"], chances, 3),
                "slg": ratio(F.col("total_bases"), c["at_bats"], 3),
                "loaded_at": F.current_timestamp(),
            }
        )
        .withColumn("ops", F.col("obp") + F.col("slg"))
    )


def pitching_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n, part = F.col("q"), F.col("n"), F.col("l_partkey")
    counted = {
        "wins": q % 2,
        "losses": (q + 1) % 2 * (n % 2),
        "games": F.lit(1),
        "games_started": n % 2,
        "games_finished": div(n % 3, 2),
        "complete_games": div(q, 48),
        "shutouts": div(q, 50),
        "saves": div(q, 44),
        "save_opportunities": div(q, 40),
        "holds": div(q % 9, 8),
        "blown_saves": div(q % 13, 12),
        "outs_written": div(q - 1, 3) * 10 + (q - 1) % 3,
        "hits_allowed": div(q, 4),
        "runs_allowed": q % 5 + q % 2,
        "earned_runs": q % 5,
        "home_runs_allowed": div(q, 25),
        "walks": n - 1,
        "strikeouts": div(q, 5),
        "hit_batsmen": part % 2,
        "wild_pitches": part % 3,
        "balks": div(part % 7, 6),
    }
    c = {name: F.col(name) for name in counted}
    ip = F.col("innings_pitched")
    return (
        _lines(spark, sf_dir)
        .groupBy(
            div(F.col("l_orderkey"), 10).alias("player_id"),
            "season",
            F.col("l_suppkey").alias("team_id"),
            "game_type",
        )
        .agg(*[F.sum(v).alias(k) for k, v in counted.items()])
        .withColumns(
            {
                "id": F.xxhash64("player_id", "season", "team_id", "game_type"),
                "league_id": F.col("team_id") % 2 + 103,
                "innings_pitched": tenths(c["outs_written"]),
            }
        )
        .withColumns(
            {
                "era": ratio(c["earned_runs"] * 9, ip, 2),
                "whip": ratio(c["walks"] + c["hits_allowed"], ip, 2),
                "batting_average_against": ratio(
                    c["hits_allowed"], ip * 3 + c["hits_allowed"], 3, ip
                ),
                "strikeout_walk_ratio": ratio(c["strikeouts"], c["walks"], 2),
                "strikeouts_per_9": ratio(c["strikeouts"] * 9, ip, 2),
                "walks_per_9": ratio(c["walks"] * 9, ip, 2),
                "hits_per_9": ratio(c["hits_allowed"] * 9, ip, 2),
                "loaded_at": F.current_timestamp(),
            }
        )
        .drop("outs_written")
    )


def _typed(value: Column, kind: T.DataType) -> Column:
    """Measurements in their stored decimal types; whole numbers stay as wide as they come."""
    return value if isinstance(kind, T.IntegralType) else value.cast(kind)


def statcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pitch per line item; fouls have a speed but no play result, other misses neither."""
    q, n = F.col("q"), F.col("n")
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    flag, hit = F.col("l_returnflag"), F.col("l_returnflag") != "N"
    known = {
        "id": F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "game_pk": order,
        "game_date": F.to_date("l_shipdate"),
        "game_year": F.col("season"),
        "batter": supp,
        "pitcher": div(part, 20) * 16,
        "batter_name": F.concat(F.lit("B"), supp.cast("string")),
        "events": F.when(n != 7, F.when(~hit, "strikeout")
                         .when(F.col("l_linestatus") == "F", "single").otherwise("field_out")),
        "description": F.when(hit, "hit_into_play").otherwise("swinging_strike"),
        "zone": q % 14 + 1,
        "stand": F.when(part % 2 == 0, "R").otherwise("L"),
        "p_throws": F.when(part % 3 == 0, "L").otherwise("R"),
        "home_team": F.concat(F.lit("T"), supp.cast("string")),
        "away_team": F.concat(F.lit("T"), (supp + 1).cast("string")),
        "type": F.when(flag == "N", "B").when(flag == "A", "S").otherwise("X"),
        "pitch_type": F.when(q % 3 == 0, "FF").when(q % 3 == 1, "SL").otherwise("CH"),
        "release_speed": F.when(part % 19 != 0, tenths(part % 800 + 350)),
        "release_spin_rate": part % 500 + 2000,
        "pfx_x": tenths(q - 25),
        "launch_speed": F.when(hit, tenths(q * 10 + n + 600)),
        "launch_angle": F.when(order % 11 != 0, tenths(part % 800 - 200)),
        "hit_distance_sc": F.when(hit, q * 8),
        "estimated_ba_using_speedangle": F.when(n % 3 != 0, thousandths(order % 1000)),
        "estimated_woba_using_speedangle": F.when(n % 3 != 0, thousandths(order % 1000 * 2)),
        "at_bat_number": n,
        "pitch_number": part % 6 + 1,
        "inning": q % 9 + 1,
        "balls": q % 4,
        "strikes": q % 3,
        "loaded_at": F.current_timestamp(),
    }
    return _lines(spark, sf_dir).select(
        *[
            _typed(
                known[field.name] if field.name in known else fillers.value(field.name),
                field.dataType,
            ).alias(field.name)
            for field in raw_schema("statcast")
        ]
    )


RAW_TABLES = {
    "teams": teams,
    "players": players,
    "games": games,
    "batting_stats": batting_stats,
    "pitching_stats": pitching_stats,
    "statcast": statcast,
    "schedule": schedule,
}


@lru_cache(maxsize=64)
def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A plan over the given tables, kept per session; nothing is computed or stored."""
    return RAW_TABLES[name](spark, sf_dir)


class RawTables(Mapping):
    """The raw tables by name, each planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return raw_table(self.spark, self.sf_dir, name)

    def __iter__(self):
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)
