"""Raw tables from storage or a database, and the team seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sabermill.operators.merge import merge
from sabermill.schemas import DEFAULTS, KEYS, RAW, raw_schema

# The 30 teams of 2024 (id, name, abbreviation, nickname, place, league, division).
SEED_TEAMS = """
110|Baltimore Orioles|BAL|Orioles|Baltimore|American League|AL East
111|Boston Red Sox|BOS|Red Sox|Boston|American League|AL East
147|New York Yankees|NYY|Yankees|New York|American League|AL East
139|Tampa Bay Rays|TB|Rays|St. Petersburg|American League|AL East
141|Toronto Blue Jays|TOR|Blue Jays|Toronto|American League|AL East
145|Chicago White Sox|CWS|White Sox|Chicago|American League|AL Central
114|Cleveland Guardians|CLE|Guardians|Cleveland|American League|AL Central
116|Detroit Tigers|DET|Tigers|Detroit|American League|AL Central
118|Kansas City Royals|KC|Royals|Kansas City|American League|AL Central
142|Minnesota Twins|MIN|Twins|Minneapolis|American League|AL Central
117|Houston Astros|HOU|Astros|Houston|American League|AL West
108|Los Angeles Angels|LAA|Angels|Anaheim|American League|AL West
133|Oakland Athletics|OAK|Athletics|Oakland|American League|AL West
136|Seattle Mariners|SEA|Mariners|Seattle|American League|AL West
140|Texas Rangers|TEX|Rangers|Arlington|American League|AL West
144|Atlanta Braves|ATL|Braves|Atlanta|National League|NL East
146|Miami Marlins|MIA|Marlins|Miami|National League|NL East
121|New York Mets|NYM|Mets|New York|National League|NL East
143|Philadelphia Phillies|PHI|Phillies|Philadelphia|National League|NL East
120|Washington Nationals|WSH|Nationals|Washington|National League|NL East
112|Chicago Cubs|CHC|Cubs|Chicago|National League|NL Central
113|Cincinnati Reds|CIN|Reds|Cincinnati|National League|NL Central
158|Milwaukee Brewers|MIL|Brewers|Milwaukee|National League|NL Central
134|Pittsburgh Pirates|PIT|Pirates|Pittsburgh|National League|NL Central
138|St. Louis Cardinals|STL|Cardinals|St. Louis|National League|NL Central
109|Arizona Diamondbacks|ARI|D-backs|Phoenix|National League|NL West
115|Colorado Rockies|COL|Rockies|Denver|National League|NL West
119|Los Angeles Dodgers|LAD|Dodgers|Los Angeles|National League|NL West
135|San Diego Padres|SD|Padres|San Diego|National League|NL West
137|San Francisco Giants|SF|Giants|San Francisco|National League|NL West
"""
SEED_COLUMNS = [
    "team_id", "name", "abbreviation", "team_name", "location_name", "league_name",
    "division_name",
]


def seed_rows() -> list[tuple]:
    lines = [line.split("|") for line in SEED_TEAMS.strip().splitlines()]
    return [(int(line[0]), *line[1:], True) for line in lines]


def seed_batch(spark: SparkSession) -> DataFrame:
    """The seed as a merge batch: some team columns, and ``active`` for all."""
    schema = "team_id INT, " + ", ".join(f"{c} STRING" for c in SEED_COLUMNS[1:])
    rows = [(number, *row) for number, row in enumerate(seed_rows())]
    return spark.createDataFrame(rows, f"seq INT, {schema}, active BOOLEAN")


def seed_teams(teams: DataFrame) -> DataFrame:
    """The team table with the seed merged in."""
    return merge(
        teams, seed_batch(teams.sparkSession), KEYS["teams"], "seq", defaults=DEFAULTS["teams"]
    )


def read_raw(spark: SparkSession, folder: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    """The seven raw tables, each in a folder of its own name."""
    return {
        name: spark.read.schema(raw_schema(name)).format(file_format).load(f"{folder}/{name}")
        for name in RAW
    }


def read_database_table(
    spark: SparkSession, url: str, table: str, split_by: str, low: int, high: int, parts: int,
    **options: str,
) -> DataFrame:
    """A table of a relational database, read by ``parts`` tasks over ranges of ``split_by``."""
    return spark.read.jdbc(
        url, table, column=split_by, lowerBound=low, upperBound=high, numPartitions=parts,
        properties=options,
    )


def write_database_table(df: DataFrame, url: str, table: str, mode: str, **options: str) -> None:
    df.write.jdbc(url, table, mode=mode, properties=options)
