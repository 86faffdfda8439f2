"""Landed JSON payloads to raw rows.

Payload schemas name only what the raw tables need, with statistics as text, since the service
writes the same field as a number in one place and as text in another. Each flattening takes a
frame of parsed payloads; ``read_payloads`` makes one from files and ``parse_payloads`` from a
text column. Both stop at a document that can't be read; ``split_payloads`` keeps such documents
apart instead. A value that can't be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sabermill.functions.coerce import missing_to_default, safe_int, safe_numeric, truthy_or
from sabermill.operators.dedup import first_per_key
from sabermill.schemas import raw_schema

# Field names of the landed payloads.
_ID_NAME = "STRUCT<id INT, name STRING>"
TEAMS_PAYLOAD = f"""
    teams ARRAY<STRUCT<id INT, name STRING, teamCode STRING, abbreviation STRING,
      teamName STRING, locationName STRING, league {_ID_NAME}, division {_ID_NAME},
      venue {_ID_NAME}, sport STRUCT<id INT>, active BOOLEAN, firstYearOfPlay STRING>>"""
ROSTER_PAYLOAD = """
    team_id INT, team_order BIGINT, roster ARRAY<STRUCT<person: STRUCT<id: INT>>>"""
PEOPLE_PAYLOAD = """
    people ARRAY<STRUCT<id INT, fullName STRING, firstName STRING, lastName STRING,
      primaryNumber STRING, birthDate STRING, birthCity STRING, birthCountry STRING,
      height STRING, weight INT, primaryPosition STRUCT<code STRING, name STRING, type STRING>,
      batSide STRUCT<code STRING>, pitchHand STRUCT<code STRING>, currentTeam STRUCT<id INT>,
      mlbDebutDate STRING, active BOOLEAN>>"""
_SIDE = """STRUCT<team: STRUCT<id: INT, name: STRING>, score: INT,
      leagueRecord: STRUCT<wins: INT, losses: INT>>"""
SCHEDULE_PAYLOAD = f"""
    dates ARRAY<STRUCT<date STRING, games ARRAY<STRUCT<gamePk INT, gameType STRING,
      season STRING, gameDate STRING, status STRUCT<statusCode STRING, detailedState STRING>,
      teams STRUCT<home: {_SIDE}, away: {_SIDE}>, venue {_ID_NAME},
      linescore STRUCT<innings: ARRAY<STRUCT<num: INT>>>,
      decisions STRUCT<winner: STRUCT<id: INT>, loser: STRUCT<id: INT>, save: STRUCT<id: INT>>,
      scheduledInnings INT, dayNight STRING, seriesDescription STRING, seriesGameNumber INT,
      gamesInSeries INT, doubleHeader STRING>>>>"""

# Raw column -> statistic in the payload.
HITTING = {
    "games_played": "gamesPlayed", "at_bats": "atBats", "runs": "runs", "hits": "hits",
    "doubles": "doubles", "triples": "triples", "home_runs": "homeRuns", "rbi": "rbi",
    "stolen_bases": "stolenBases", "caught_stealing": "caughtStealing", "walks": "baseOnBalls",
    "strikeouts": "strikeOuts", "batting_average": "avg", "obp": "obp", "slg": "slg",
    "ops": "ops", "plate_appearances": "plateAppearances", "total_bases": "totalBases",
    "ground_into_dp": "groundIntoDoublePlay", "hit_by_pitch": "hitByPitch",
    "sacrifice_bunts": "sacBunts", "sacrifice_flies": "sacFlies",
    "intentional_walks": "intentionalWalks",
}
PITCHING = {
    "wins": "wins", "losses": "losses", "era": "era", "games": "gamesPitched",
    "games_started": "gamesStarted", "games_finished": "gamesFinished",
    "complete_games": "completeGames", "shutouts": "shutouts", "saves": "saves",
    "save_opportunities": "saveOpportunities", "holds": "holds", "blown_saves": "blownSaves",
    "innings_pitched": "inningsPitched", "hits_allowed": "hits", "runs_allowed": "runs",
    "earned_runs": "earnedRuns", "home_runs_allowed": "homeRuns", "walks": "baseOnBalls",
    "strikeouts": "strikeOuts", "hit_batsmen": "hitBatsmen", "whip": "whip",
    "batting_average_against": "avg", "wild_pitches": "wildPitches", "balks": "balks",
    "strikeout_walk_ratio": "strikeoutWalkRatio", "strikeouts_per_9": "strikeoutsPer9Inn",
    "walks_per_9": "walksPer9Inn", "hits_per_9": "hitsPer9Inn",
}
FINAL_STATUSES = ["F", "FT", "FR", "FO"]


def _stats_payload(names: dict[str, str]) -> str:
    stat = ", ".join(f"{name}: STRING" for name in dict.fromkeys(names.values()))
    return f"""
    player_id INT, season INT, game_type STRING,
    people ARRAY<STRUCT<stats: ARRAY<STRUCT<group: STRUCT<displayName: STRING>,
      splits: ARRAY<STRUCT<stat: STRUCT<{stat}>, team: STRUCT<id: INT>,
        league: STRUCT<id: INT>>>>>>>"""


HITTING_PAYLOAD = _stats_payload(HITTING)
PITCHING_PAYLOAD = _stats_payload(PITCHING)


def read_payloads(
    spark: SparkSession, path: str, schema: str, one_per_file: bool = True
) -> DataFrame:
    """Landed JSON files: one document per file, or one per line (splittable, for large files)."""
    reader = spark.read.schema(schema).option("multiLine", one_per_file).option("mode", "FAILFAST")
    return reader.json(path)


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed documents as text, with their file and their order in it, for ``parse_documents``."""
    texts = spark.read.text(path, wholetext=one_per_file)
    return texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("document"))


def parse_payloads(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """Payloads that lie in a text column; an unreadable one is an error.

    Unpacked by a generator, so each text is parsed once; a projection would be inlined into
    every later use of a field and parse again there.
    """
    parsed = F.from_json(column, schema, {"mode": "FAILFAST"})
    return texts.select(F.inline(F.array(parsed)))


UNREADABLE, SOURCE = "_unreadable", "_source"


def parse_documents(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """Payloads of all texts; an unreadable one keeps its row of ``texts`` in ``_source``, else that is NULL.

    A document counts as readable if all of it could be taken; NULL is unreadable. Every text is
    parsed once if this frame is written before its branches read it.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    known = f"{schema.strip()}, {UNREADABLE} STRING"
    parsed = texts.select(F.struct("*").alias(SOURCE), F.inline(F.array(F.from_json(column, known, options))))
    bad = F.col(UNREADABLE).isNotNull() | F.col(SOURCE).getField(column).isNull()
    return parsed.withColumn(SOURCE, F.when(bad, F.col(SOURCE))).drop(UNREADABLE)


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(SOURCE).isNull()).drop(SOURCE)


def unreadable(parsed: DataFrame) -> DataFrame:
    """The rows of the texts that could not be parsed."""
    return parsed.where(F.col(SOURCE).isNotNull()).select(f"{SOURCE}.*")


def split_payloads(texts: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Both without a table between them: lazy, and each of the two frames parses the texts."""
    parsed = parse_documents(texts, column, schema)
    return readable(parsed), unreadable(parsed)


def _select(df: DataFrame, table: str, columns: dict[str, Column]) -> DataFrame:
    """The columns in the raw table's order and types."""
    kinds = {f.name: f.dataType for f in raw_schema(table)}
    return df.select(*[columns[n].try_cast(kinds[n]).alias(n) for n in kinds if n in columns])


def flatten_teams(payloads: DataFrame) -> DataFrame:
    team = payloads.select(F.explode("teams").alias("t")).select("t.*")
    return _select(
        team,
        "teams",
        {
            "team_id": F.col("id"),
            "name": F.col("name"),
            "team_code": F.col("teamCode"),
            "abbreviation": F.col("abbreviation"),
            "team_name": F.col("teamName"),
            "location_name": F.col("locationName"),
            "league_id": F.col("league.id"),
            "league_name": F.col("league.name"),
            "division_id": F.col("division.id"),
            "division_name": F.col("division.name"),
            "venue_id": F.col("venue.id"),
            "venue_name": F.col("venue.name"),
            "sport_id": missing_to_default(F.col("sport.id"), 1),
            "active": missing_to_default(F.col("active"), True),
            "first_year_of_play": F.col("firstYearOfPlay"),
        },
    )


def first_roster_spots(rosters: DataFrame) -> DataFrame:
    """Each rostered player once, with the team whose roster names the player first."""
    spots = rosters.select(
        F.col("team_id").alias("roster_team_id"),
        "team_order",
        F.posexplode("roster").alias("place", "spot"),
    ).select(F.col("spot.person.id").alias("player_id"), "roster_team_id", "team_order", "place")
    first = first_per_key(spots, ["player_id"], [F.col("team_order"), F.col("place")])
    return first.select("player_id", "roster_team_id")


def flatten_players(payloads: DataFrame, roster_spots: DataFrame) -> DataFrame:
    """A player without a current team takes the team of the roster."""
    person = payloads.select(F.explode("people").alias("p")).select("p.*")
    return _select(
        person.withColumnRenamed("id", "player_id").join(roster_spots, "player_id", "left"),
        "players",
        {
            "player_id": F.col("player_id"),
            "full_name": missing_to_default(F.col("fullName"), ""),
            "first_name": F.col("firstName"),
            "last_name": F.col("lastName"),
            "primary_number": F.col("primaryNumber"),
            "birth_date": F.col("birthDate"),
            "birth_city": F.col("birthCity"),
            "birth_country": F.col("birthCountry"),
            "height": F.col("height"),
            "weight": F.col("weight"),
            "primary_position_code": F.col("primaryPosition.code"),
            "primary_position_name": F.col("primaryPosition.name"),
            "primary_position_type": F.col("primaryPosition.type"),
            "bat_side": F.col("batSide.code"),
            "pitch_hand": F.col("pitchHand.code"),
            "current_team_id": truthy_or(F.col("currentTeam.id"), F.col("roster_team_id")),
            "mlb_debut_date": F.col("mlbDebutDate"),
            "active": missing_to_default(F.col("active"), True),
        },
    )


def _scheduled_games(payloads: DataFrame) -> DataFrame:
    """One row per game of every date, the date kept beside the game's own fields."""
    day = payloads.select(F.explode("dates").alias("d"))
    return day.select(F.col("d.date").alias("day"), F.explode("d.games").alias("g"))


def _game_identity() -> dict[str, Column]:
    return {
        "game_pk": F.col("g.gamePk"),
        "game_type": F.col("g.gameType"),
        "season": safe_int(F.col("g.season")),
        "game_date": F.col("day"),
        "game_datetime": F.col("g.gameDate"),
        "status_code": F.col("g.status.statusCode"),
        "status_detail": F.col("g.status.detailedState"),
        "home_team_id": F.col("g.teams.home.team.id"),
        "away_team_id": F.col("g.teams.away.team.id"),
        "venue_id": F.col("g.venue.id"),
        "venue_name": F.col("g.venue.name"),
        "day_night": F.col("g.dayNight"),
        "series_description": F.col("g.seriesDescription"),
        "series_game_number": F.col("g.seriesGameNumber"),
        "double_header": F.col("g.doubleHeader"),
    }


def flatten_schedule(payloads: DataFrame) -> DataFrame:
    columns = {
        **_game_identity(),
        "home_team_name": F.col("g.teams.home.team.name"),
        "away_team_name": F.col("g.teams.away.team.name"),
        "games_in_series": F.col("g.gamesInSeries"),
        "scheduled_innings": missing_to_default(F.col("g.scheduledInnings"), 9),
    }
    return _select(_scheduled_games(payloads), "schedule", columns)


def innings_played() -> Column:
    """Innings in the line score, or the scheduled number where it lists none."""
    listed = F.size("g.linescore.innings")
    return F.when(listed > 0, listed).otherwise(F.col("g.scheduledInnings"))


def flatten_games(payloads: DataFrame) -> DataFrame:
    """Games with a final status."""
    final = _scheduled_games(payloads).where(F.col("g.status.statusCode").isin(FINAL_STATUSES))
    columns = {
        **_game_identity(),
        **{
            f"{side}_{name}": F.col(f"g.teams.{side}.{field}")
            for side in ("home", "away")
            for name, field in {
                "score": "score",
                "wins": "leagueRecord.wins",
                "losses": "leagueRecord.losses",
            }.items()
        },
        "winning_pitcher_id": F.col("g.decisions.winner.id"),
        "losing_pitcher_id": F.col("g.decisions.loser.id"),
        "save_pitcher_id": F.col("g.decisions.save.id"),
        "innings": innings_played(),
    }
    return _select(final, "games", columns)


def stat_splits(group: str) -> Column:
    """Splits of the first statistic block of that group which has any; first person only."""
    blocks = F.get("people", F.lit(0)).getField("stats")
    chosen = F.filter(
        blocks,
        lambda b: (b.getField("group").getField("displayName") == group)
        & (F.size(b.getField("splits")) > 0),
    )
    return F.get(chosen, F.lit(0)).getField("splits")


def _flatten_stats(payloads: DataFrame, group: str, table: str, names: dict) -> DataFrame:
    kinds = {f.name: f.dataType for f in raw_schema(table)}
    rows = payloads.select(
        "player_id", "season", "game_type", F.explode(stat_splits(group)).alias("s")
    )

    def value(column: str, field: str) -> Column:
        text = F.col(f"s.stat.{field}")
        if kinds[column].typeName() == "integer":
            return safe_int(text)
        return safe_numeric(text, kinds[column].simpleString())

    columns = {
        "player_id": F.col("player_id"),
        "season": F.col("season"),
        "game_type": F.col("game_type"),
        "team_id": F.col("s.team.id"),
        "league_id": F.col("s.league.id"),
        **{column: value(column, field) for column, field in names.items()},
    }
    if "innings_pitched" in columns:
        innings = missing_to_default(F.col("s.stat.inningsPitched"), "0")
        columns["innings_pitched"] = safe_numeric(
            innings, kinds["innings_pitched"].simpleString()
        )
    with_team = rows.where(F.col("s.team.id").isNotNull())
    return _select(with_team, table, columns)


def flatten_batting_stats(payloads: DataFrame) -> DataFrame:
    """One row per split that names a team."""
    return _flatten_stats(payloads, "hitting", "batting_stats", HITTING)


def flatten_pitching_stats(payloads: DataFrame) -> DataFrame:
    """One row per split that names a team; missing innings count as zero."""
    return _flatten_stats(payloads, "pitching", "pitching_stats", PITCHING)
