import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from harness import adapter
from sabermill.plans import boards, suite
from sabermill.plans.warehouse import INTERMEDIATE, MARTS, Warehouse, build
from sabermill.session import fresh_path, settle, shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
def test_written_models_equal_lazy_ones(spark, rows):
    raw = adapter.raw_tables(spark, SF_DIR)
    lazy = Warehouse(raw)
    written = build(spark, raw, fresh_path(spark, "warehouse"))
    for name in ("int_statcast_metrics", "fct_pitching_performance", "fct_team_season_summary"):
        assert rows(written.model(name)) == rows(lazy.model(name).select(*written.model(name).columns))
    assert all("parquet" in str(written.model(n).inputFiles()) for n in [*INTERMEDIATE, *MARTS])
    verdicts = suite.every_check(written).collect()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the plan shortens locations
    plan = suite.row_checks(written)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name in ("fct_statcast_leaders", "int_player_season_pitching", "int_team_standings"):
        assert plan.count(f"/{name}]") == 1, name
    declared = {(v["check"], v.table_name, v.column_name) for v in verdicts}
    assert len(declared) == len(verdicts)
    kinds = Counter(v["check"] for v in verdicts)
    assert kinds["unique"] == 17 and kinds["accepted_values"] == 13
    assert kinds["relationships"] == 9 + 1 and kinds["traced"] == 5
    broken = {(v["check"], v.table_name) for v in verdicts if v.violations}
    assert ("accepted_values", "stg_teams") in broken and ("traced", "fct_game_summary") not in broken
    written.register_views(MARTS)
    top = spark.sql("SELECT max(win_pct) FROM fct_team_season_summary").first()[0]
    assert boards.top_teams(written.fct_team_season_summary, 1).first().win_pct == top


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
def test_builds_are_versions_laid_out_by_season(spark, rows):
    raw = adapter.raw_tables(spark, SF_DIR)
    folder = fresh_path(spark, "warehouse")
    built = build(spark, raw, folder, views="v_")
    text = boards.standings(built.fct_team_season_summary, 1998)._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(season" in text.executedPlan().toString()
    before = rows(built.dim_teams)
    assert rows(spark.table("v_dim_teams")) == before

    broken = {**raw, "games": raw["games"].where(F.raise_error(F.lit("broken")).cast("boolean"))}
    with pytest.raises(Exception, match="broken"):
        build(spark, broken, folder, views="v_")
    assert rows(built.dim_teams) == before == rows(spark.table("v_dim_teams"))
    assert len(os.listdir(folder)) == 2
    for name in [*INTERMEDIATE, *MARTS]:
        spark.sql(f"DROP VIEW v_{name}")


def test_settled_frames_keep_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    again = settle(df, "settled")
    assert rows(again) == rows(df) and again.schema == df.schema
    assert settle(df.limit(0), "settled").count() == 0


def session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_cluster_names_the_shared_folder():
    assert shared_folder(session("hdfs://c/tmp/", "yarn")) == "hdfs://c/tmp"
    with pytest.raises(RuntimeError):
        shared_folder(session(None, "yarn"))
    assert os.path.isdir(shared_folder(session(None, "local[2]")))
