"""Registered queries against their SQL on a second engine, and the shape of their plans.

By default a few queries per family run; set EVERY_QUERY=1 for all of them.
"""

import os
import re

import pytest

from harness import compare, registry

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "P1_stg_teams", "P7_stg_statcast", *registry.MODELS, "dim_players", "F6_role_starter",
    "J12_fact_current_team", "J13_orphans", "A7_team_records", "A11_global_kpis",
    "W1_batter_exit_velo_rank", "W5_pitcher_exit_velo_rank", "M30_luck", "S2_flatten_players",
    "S5_flatten_games", "S8_flatten_batting", "S9_flatten_pitching", "S13_coerce_pitches",
    "S15_date_chunks", "S17_seed_teams", "K1_append", "K2_upsert", "K3_partial_upsert",
    "K4_insert_only", "K5_compound_keys", "I1_ingest_append", "I1_ingest_keyed", "D1_unique",
    "D3_accepted_values", "D4_relationships", "D5_ranges", "D7_group_consistency",
    "D10_null_shares", "Q3_top_teams", "Q4_recent_games", "Q9_batting_leaders",
    "Q18_fip_leaders", "Q22_standings", "Q36_xwoba_leaders", "Q38_player_batting",
]
# At this size no starting pitcher, no orphan and the like.
MAY_BE_EMPTY: set[str] = set()
CHOSEN = list(registry.ENTRIES) if os.environ.get("EVERY_QUERY") else SAMPLE
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def second_engine():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows_as_sql(spark, second_engine, name):
    problem = compare.difference(spark, second_engine, name, SF_DIR)
    assert problem in ((None, "both are empty") if name in MAY_BE_EMPTY else (None,))


def plan(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fct_team_season_summary", "fct_game_summary", "S15_date_chunks",
                                  "D12_traceability", "fct_statcast_leaders", "K2_upsert"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert forbidden not in text


def test_both_roles_come_from_one_scan(spark):
    text = plan(spark, "int_statcast_metrics")
    assert text.count("FileScan parquet") == 1
    assert "partial_count" in text.split("Exchange")[1]


def test_both_sides_of_a_game_come_from_one_scan_with_the_status_pushed_down(spark):
    text = plan(spark, "int_game_results")
    assert text.count("FileScan parquet") == 1 and "Exchange" not in text
    assert "EqualTo(o_orderstatus,F)" in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "M2_batting_average")
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "l_extendedprice" not in read and "l_tax" not in read


@pytest.mark.parametrize("name", ["fct_statcast_leaders", "fct_team_season_summary",
                                  "int_team_standings", "Q22_standings", "Q33_ev_leaders"])
def test_building_a_query_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"plan-{name}", name)
    try:
        registry.queries()[name](spark, SF_DIR)
        # Reading a Parquet schema is the only job a plan may need.
        assert len(tracker.getJobIdsForGroup(f"plan-{name}")) <= len(os.listdir(SF_DIR))
        before = len(tracker.getJobIdsForGroup(f"plan-{name}"))
        plan(spark, name)
        assert len(tracker.getJobIdsForGroup(f"plan-{name}")) <= 2 * before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def windows_of(text):
    """(partition columns, order) of each window."""
    specs = re.findall(r"windowspecdefinition\(([^\n]*?), specifiedwindowframe", text)
    names = [re.sub(r"#\d+L?", "", spec).split(", ") for spec in specs]
    return [([n for n in each if " " not in n], [n for n in each if " " in n]) for each in names]


def test_no_window_holds_the_rows_of_a_season(spark):
    windows = windows_of(plan(spark, "fct_statcast_leaders"))
    assert len(windows) == 6  # three for groups with a season, three for those without
    for columns, order in windows:
        # Either the values of one range, or one number for each range.
        assert columns[:3] == ["season", "player_role", "_metric"]
        assert columns[3:] == ["_range"] or [o.split()[0] for o in order] == ["_range"]


@pytest.mark.parametrize(("name", "table", "column"), [
    ("Q22_standings", "orders", "o_orderdate"), ("Q33_ev_leaders", "lineitem", "l_shipdate"),
])
def test_a_season_is_filtered_at_every_scan_of_its_rows(spark, name, table, column):
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    text = plan(spark, name)
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if f"/{table}.parquet" in line]
    assert scans
    for i in scans:
        above = lines[i - 1]
        asked = re.search(rf"\(year\(cast\({column}#\d+ as date\)\) = {registry.SEASON}\)", above)
        # Groups without a season read rows without one only.
        nameless = re.search(rf"isnull\(year\(cast\({column}#\d+ as date\)\)\)", above)
        assert "Filter" in above and (asked or nameless), above


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
