"""Landed documents and pitch frames that Spark derives from the given tables.

Each function returns a frame with one JSON text per row (column ``doc``) over every row of its
table, with the gaps and odd texts that landing has to cope with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harness import adapter, fillers
from harness.adapter import div, table
from sabermill.schemas import RAW
from sabermill.session import spread_out
from sabermill.sources import landing


def _document(df: DataFrame, **fields: Column) -> DataFrame:
    body = F.struct(*[value.alias(name) for name, value in fields.items()])
    return df.select(F.to_json(body).alias("doc"))


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per supplier; sport and active are left out of some."""
    key = F.col("team_id")
    raw = adapter.teams(spark, sf_dir)
    team = _struct(
        id=key,
        name=F.col("name"),
        teamCode=F.col("team_code"),
        abbreviation=F.col("abbreviation"),
        teamName=F.col("team_name"),
        locationName=F.col("location_name"),
        league=_struct(id=F.col("league_id"), name=F.col("league_name")),
        division=_struct(id=F.col("division_id"), name=F.col("division_name")),
        venue=_struct(id=F.col("venue_id"), name=F.col("venue_name")),
        sport=F.when(key % 4 == 1, _struct(id=F.lit(11))),
        active=F.when(key % 3 != 0, F.col("active")),
        firstYearOfPlay=F.col("first_year_of_play"),
    )
    return _document(raw, teams=F.array(team))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per customer; the current team is absent or zero in some."""
    key = F.col("player_id")
    raw = adapter.players(spark, sf_dir)
    person = _struct(
        id=key,
        fullName=F.when(key % 7 != 0, F.col("full_name")),
        firstName=F.col("first_name"),
        lastName=F.col("last_name"),
        primaryNumber=F.col("primary_number"),
        birthDate=F.col("birth_date"),
        weight=F.col("weight"),
        primaryPosition=_struct(
            code=F.col("primary_position_code"),
            name=F.col("primary_position_name"),
            type=F.col("primary_position_type"),
        ),
        batSide=_struct(code=F.col("bat_side")),
        currentTeam=F.when(key % 17 != 0, _struct(id=F.when(key % 19 == 0, 0)
                                                  .otherwise(div(key, 15)))),
        active=F.when(key % 3 != 0, F.col("active")),
    )
    return _document(raw, people=F.array(person))


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rostered players per order, so most players are on several rosters."""
    customer = F.col("o_custkey")
    spots = F.array(*[_struct(person=_struct(id=p)) for p in (customer, div(customer, 2))])
    return _document(
        table(spark, sf_dir, "orders"),
        team_id=div(F.col("o_orderkey"), 150),
        team_order=F.col("o_orderkey"),
        roster=spots,
    )


def _landed_status() -> Column:
    """Played orders land with one of two final codes, open ones as scheduled."""
    code = F.col("status_code")
    return F.when(code == "F", "F").when(code == "P", "FT").otherwise("S")


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates per order: one with the game, one with no games."""
    key = F.col("game_pk")
    games = adapter.games(spark, sf_dir)

    def side(name: str) -> Column:
        team_id = F.col(f"{name}_team_id")
        return _struct(
            team=_struct(id=team_id, name=F.concat(F.lit("Team "), team_id.cast("string"))),
            score=F.col(f"{name}_score"),
            leagueRecord=_struct(wins=F.col(f"{name}_wins"), losses=F.col(f"{name}_losses")),
        )

    listed = F.when(key % 2 == 0, F.transform(
        F.sequence(F.lit(1).cast("long"), F.coalesce(F.col("innings").cast("long"), F.lit(9))),
        lambda i: _struct(num=i),
    ))
    game = _struct(
        gamePk=key,
        gameType=F.col("game_type"),
        season=F.col("season").cast("string"),
        gameDate=F.date_format("game_datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        status=_struct(statusCode=_landed_status(), detailedState=F.col("status_detail")),
        teams=_struct(home=side("home"), away=side("away")),
        venue=_struct(id=F.col("venue_id"), name=F.col("venue_name")),
        linescore=_struct(innings=listed),
        decisions=_struct(
            winner=_struct(id=F.col("winning_pitcher_id")),
            loser=_struct(id=F.col("losing_pitcher_id")),
            save=_struct(id=F.col("save_pitcher_id")),
        ),
        scheduledInnings=F.when(key % 3 == 0, 7),
        dayNight=F.col("day_night"),
        seriesDescription=F.col("series_description"),
        seriesGameNumber=F.col("series_game_number"),
        gamesInSeries=F.lit(4),
        doubleHeader=F.col("double_header"),
    )
    played = _struct(date=F.col("game_date").cast("string"), games=F.array(game))
    idle = _struct(
        date=F.date_add("game_date", 1).cast("string"), games=F.filter(F.array(game), lambda g: F.lit(False))
    )
    return _document(games, dates=F.array(played, idle))


def _person_stats(spark: SparkSession, sf_dir: str, group: str, player: Column, stat: Column):
    """A block of another group, an empty block of this one, then the block that counts."""
    split = _struct(
        stat=stat,
        team=F.when(F.col("n") != 6, _struct(id=F.col("l_suppkey"))),
        league=_struct(id=F.lit(103) + F.col("l_suppkey") % 2),
    )
    # The split is a column of its own, so that three blocks hold it but each line makes it once.
    lines = spread_out(adapter._lines(spark, sf_dir)).withColumn("split", split)
    own = F.array(F.col("split"))
    block = lambda name, splits: _struct(group=_struct(displayName=F.lit(name)), splits=splits)
    blocks = F.array(block("fielding", own), block(group, F.slice(own, 1, 0)), block(group, own))
    return _document(
        lines,
        player_id=player,
        season=F.col("season"),
        game_type=F.col("game_type"),
        people=F.array(_struct(stats=blocks)),
    )


def _points(value: Column) -> Column:
    return F.concat(F.lit("."), F.lpad(value.cast("string"), 3, "0"))


def hitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("q")
    stat = _struct(
        gamesPlayed=F.lit(1),
        atBats=F.when(q % 9 == 0, "").otherwise(q.cast("string")),
        hits=F.when(q % 10 == 0, "12.0").otherwise(div(q, 4).cast("string")),
        homeRuns=div(q, 16),
        baseOnBalls=F.col("n"),
        avg=F.when(q % 5 == 0, ".---").otherwise(_points(q * 7)),
        ops=F.concat(F.lit("1"), _points(q * 3)),
    )
    return _person_stats(spark, sf_dir, "hitting", F.col("l_partkey"), stat)


def pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("q")
    innings = F.concat(div(q, 3).cast("string"), F.lit("."), (q % 3).cast("string"))
    stat = _struct(
        wins=q % 2,
        gamesPitched=F.lit("1"),
        inningsPitched=F.when(q % 7 != 0, innings),
        era=F.when(q % 4 == 0, "-.--").otherwise(F.concat((q % 9).cast("string"), F.lit(".25"))),
        homeRuns=div(q, 25),
        avg=_points(q * 9),
    )
    player = div(F.col("l_orderkey"), 10)
    return _person_stats(spark, sf_dir, "pitching", player, stat)


def _rest(names: dict[str, str], own: list[str]) -> list[str]:
    return [column for column in names if column not in own]


# Statistics that the documents above leave out.
HITTING_REST = _rest(landing.HITTING, ["games_played", "at_bats", "hits", "home_runs", "walks", "batting_average", "ops"])
PITCHING_REST = _rest(landing.PITCHING, ["wins", "games", "innings_pitched", "era", "home_runs_allowed", "batting_average_against"])


def rest_number(i: int) -> str:
    """The value of the i-th of them in units of its last place, for both engines."""
    return f"(n * 37 + {i} * 11) % 900 + {i}"


def _rest_stats(names: dict[str, str], rest: list[str], places: dict[str, int]) -> Column:
    """All of them as text; decimals with their point, every seventh line without a value."""

    def text(i: int, column: str) -> Column:
        number = F.expr(rest_number(i))
        if not places[column]:
            return F.when(F.col("q") % 7 != 0, number.cast("string"))
        unit = 10 ** places[column]
        whole = F.expr(f"({rest_number(i)}) div {unit}").cast("string")
        part = F.lpad((number % unit).cast("string"), places[column], "0")
        return F.when(F.col("q") % 7 == 0, ".---").otherwise(F.concat(whole, F.lit("."), part))

    return _struct(**{names[c]: text(i, c) for i, c in enumerate(rest)})


def places_of(table: str) -> dict[str, int]:
    """Decimal places of the whole numbers and decimals of a raw table."""
    return {name: int(places or 0) for name, _, places in fillers.TYPES.findall(RAW[table])}


def hitting_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stat = _rest_stats(landing.HITTING, HITTING_REST, places_of("batting_stats"))
    return _person_stats(spark, sf_dir, "hitting", F.col("l_partkey"), stat)


def pitching_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stat = _rest_stats(landing.PITCHING, PITCHING_REST, places_of("pitching_stats"))
    return _person_stats(spark, sf_dir, "pitching", div(F.col("l_orderkey"), 10), stat)


# Columns with values of their own below, and columns that do not land at all.
_LANDED_OWN = """game_pk game_date game_year batter pitcher batter_name events description zone
    launch_speed launch_angle at_bat_number pitch_number""".split()
_ABSENT = ["pitcher_name", "inning", "release_extension"]
LANDED_REST = [c for c in fillers.KINDS if c not in (*_LANDED_OWN, *_ABSENT)]


def landed_pitches(lines: DataFrame) -> DataFrame:
    """A pitch frame as it lands: floats for whole numbers, NaN for missing, dates with times,
    an unknown column, and some known columns absent. Works on a stream as on a table."""
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    part = F.col("l_partkey")
    missing = F.lit(float("nan"))
    return lines.select(
        F.col("l_orderkey").cast("double").alias("game_pk"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("game_date"),
        F.year("l_shipdate").cast("double").alias("game_year"),
        F.when(n == 5, missing).otherwise(F.col("l_suppkey")).alias("batter"),
        F.when(part % 23 == 0, missing).otherwise(part).alias("pitcher"),
        F.concat(F.lit("B"), F.col("l_suppkey").cast("string")).alias("player_name"),
        F.when(F.col("l_linestatus") == "F", "single").alias("events"),
        F.col("l_returnflag").alias("description"),
        F.when(q % 3 == 0, "bad").otherwise(q.cast("string")).alias("zone"),
        F.when(F.col("l_returnflag") == "N", missing)
        .otherwise(q + 60 + n / 10)
        .alias("launch_speed"),
        (part % 800 - 200).cast("double").alias("launch_angle"),
        n.cast("double").alias("at_bat_number"),
        (part % 6 + 1).cast("double").alias("pitch_number"),
        *[fillers.value(c, floating=True).alias(c) for c in LANDED_REST],
        F.lit("x").alias("unknown_column"),
    )
