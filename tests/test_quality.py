from pyspark.sql import functions as F

from sabermill.operators import quality as q


def counts(df):
    return {(r["check"], r.column_name): r.violations for r in df.collect()}


def test_row_rules_share_one_pass_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-3, None)], "n int, s string")
    got = q.row_rules(df, "t", {
        ("not_null", "n"): q.missing("n"), ("accepted_values", "s"): q.not_in("s", ["a"]),
        ("in_range", "n"): q.outside("n", 0, 5),
    })
    assert counts(got) == {
        ("not_null", "n"): 1, ("accepted_values", "s"): 1, ("in_range", "n"): 1,
    }
    assert got._jdf.queryExecution().analyzed().toString().count("Aggregate [") == 1
    empty = q.row_rules(df.limit(0), "t", {("not_null", "n"): q.missing("n")})
    assert counts(empty) == {("not_null", "n"): 0}


def test_unique_counts_repeated_values_not_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,), (None,), (None,)], "k int")
    assert counts(q.unique(df, "t", "k")) == {("unique", "k"): 2}
    assert counts(q.distinct_key(df, "t", "k")) == {("rows_equal_keys", "k"): 5}


def test_orphans_count_child_rows(spark):
    child = spark.createDataFrame([(1, 1), (9, 1), (9, 9), (None, 8)], "a int, b int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert counts(q.related(child, "t", "a", parent, "id")) == {("relationships", "a"): 2}
    both = q.related_all(child, "t", ["a", "b"], parent, "id")
    assert counts(both) == {("relationships", "a, b"): 3}
    assert counts(q.related(child.limit(0), "t", "a", parent, "id")) == {("relationships", "a"): 0}


def test_group_rules(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True), (3, True), (3, True)],
                               "g int, won boolean")
    got = q.groups_break(
        df, "t", "g", {"n": F.count(F.lit(1)), "won": F.count_if("won")},
        {"pairs": F.col("n") != 2, "one_winner": F.col("won") != 1},
    )
    assert counts(got) == {("pairs", "g"): 1, ("one_winner", "g"): 1}


def test_sizes_and_null_shares(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,), (5,)], "v int")
    assert counts(q.few_rows(df, "t", 7)) == {("at_least_7_rows", ""): 2}
    assert counts(q.few_rows(df, "t", 5)) == {("at_least_5_rows", ""): 0}
    assert counts(q.same_size({"a": df, "b": df.limit(2)})) == {("same_row_count", ""): 3}
    assert counts(q.null_share(df, "t", {"v": "0.20"})) == {("null_share_below_0.20", "v"): 1}
    assert counts(q.null_share(df, "t", {"v": "0.21"})) == {("null_share_below_0.21", "v"): 0}
    assert counts(q.null_share(df.limit(0), "t", {"v": "0.2"})) == {("null_share_below_0.2", "v"): 0}
