"""Landed documents into keyed raw tables: parse, flatten, key, merge, and say what was left out.

``load`` takes documents as text and the table as it is, and gives the table as it becomes, the
documents and rows that can't be stored, and counts of all of them. Nothing is dropped without a
trace.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from sabermill.operators.merge import LOADED_AT, merge
from sabermill.schemas import DEFAULTS, KEYS, raw_schema
from sabermill.session import settle
from sabermill.sources import landing

ORDER = "_order"
# Documents of each table's extract and how they become rows; players also need the rosters.
SOURCES: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "teams": (landing.TEAMS_PAYLOAD, landing.flatten_teams),
    "players": (landing.PEOPLE_PAYLOAD, landing.flatten_players),
    "games": (landing.SCHEDULE_PAYLOAD, landing.flatten_games),
    "schedule": (landing.SCHEDULE_PAYLOAD, landing.flatten_schedule),
    "batting_stats": (landing.HITTING_PAYLOAD, landing.flatten_batting_stats),
    "pitching_stats": (landing.PITCHING_PAYLOAD, landing.flatten_pitching_stats),
}


@dataclass
class Extract:
    rows: DataFrame
    unreadable: DataFrame
    incomplete: DataFrame
    counts: DataFrame


@dataclass
class Load:
    merged: DataFrame
    unreadable: DataFrame
    incomplete: DataFrame
    counts: DataFrame


def required_columns(table: str) -> list[str]:
    """Columns that a stored row must have, beside those a load fills itself."""
    filled = {"id", LOADED_AT, *DEFAULTS.get(table, {})}
    fields = raw_schema(table).fields
    return [f.name for f in fields if not f.nullable and f.name not in filled]


def with_id(rows: DataFrame, table: str) -> DataFrame:
    """A 64-bit label from the natural key, where the table has an id; rows are never matched by it."""
    if "id" not in raw_schema(table).names or "id" in rows.columns:
        return rows
    return rows.withColumn("id", F.xxhash64(*KEYS[table]))


def extract(parsed: DataFrame, table: str, rosters: DataFrame | None = None) -> Extract:
    """Rows of parsed documents (``landing.parse_documents``, written before) that can be stored, and what can't."""
    extra = [landing.first_roster_spots(rosters)] if table == "players" else []
    rows = SOURCES[table][1](landing.readable(parsed), *extra)
    lacks = reduce(or_, [F.col(c).isNull() for c in required_columns(table)], F.lit(False))
    kept = with_id(rows.where(~lacks), table)
    one = F.count(F.lit(1))
    counts = (
        parsed.agg(one.alias("documents"), F.count(landing.SOURCE).alias("unreadable"))
        .crossJoin(rows.agg(one.alias("rows"), F.count_if(lacks).alias("incomplete")))
        .withColumn("kept", F.col("rows") - F.col("incomplete"))
    )
    ordered = kept.withColumn(ORDER, F.struct(*sorted(kept.columns)))
    return Extract(ordered, landing.unreadable(parsed), rows.where(lacks), counts)


def merge_options(rows: DataFrame, table: str) -> dict:
    """How extracted rows go into their table: of those with the same key the last by content counts."""
    update = [c for c in rows.columns if c not in (*KEYS[table], "id", ORDER)]
    return {
        "keys": KEYS[table], "order": ORDER, "update_columns": update, "defaults": DEFAULTS.get(table), "order_is_row": True,
    }


def load(
    documents: DataFrame,
    column: str,
    table: str,
    target: DataFrame,
    rosters: DataFrame | None = None,
) -> Load:
    """``documents`` merged into ``target``.

    Documents are parsed and written once, here; the four frames of the result read what was written.
    Of rows with the same key the last by content counts, whatever order they arrive in.
    ``counts`` has one row: documents read and unreadable, rows flattened, incomplete and kept.
    """
    parsed = settle(landing.parse_documents(documents, column, SOURCES[table][0]), f"documents-{table}")
    found = extract(parsed, table, rosters)
    merged = merge(target, found.rows, **merge_options(found.rows, table))
    return Load(merged, found.unreadable, found.incomplete, found.counts)
