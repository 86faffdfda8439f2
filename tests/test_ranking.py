from decimal import Decimal as D

from pyspark.sql import functions as F

from sabermill.operators.dedup import first_per_key
from sabermill.operators.ranking import competition_ranks, value_range


def expected_ranks(values, ascending):
    def place(v):
        better = [
            w for w in values
            if w is not None and (v is None or (w < v if ascending else w > v))
        ]
        return 1 + len(better)

    return [place(v) for v in values]


def test_ranks_match_brute_force_with_ties_nulls_and_a_hot_group(spark):
    data = []
    for season, size in ((2023, 7), (2024, 900), (None, 5)):  # one group holds nearly all rows
        for role in ("batter", "pitcher"):
            for i in range(size):
                speed = None if i % 13 == 0 else D(i * 7919 % 50) / 10
                share = D("0.000") if i % 3 else D(i % 40) / 1000
                data.append((i, season, role, speed, share))
    df = spark.createDataFrame(
        data, "player int, season int, role string, speed decimal(5,1), share decimal(5,3)"
    )
    ranked = competition_ranks(
        df,
        ["season", "role"],
        {"speed_rank": "speed", "share_rank": "share"},
        ascending=F.col("role") == "pitcher",
    )
    got = {(r.player, r.season, r.role): (r.speed_rank, r.share_rank) for r in ranked.collect()}
    assert ranked.count() == len(data)
    for season in (2023, 2024, None):
        for role in ("batter", "pitcher"):
            group = [d for d in data if d[1] == season and d[2] == role]
            up = role == "pitcher"
            speeds = expected_ranks([d[3] for d in group], up)
            shares = expected_ranks([d[4] for d in group], up)
            for d, speed, share in zip(group, speeds, shares, strict=True):
                assert got[(d[0], season, role)] == (speed, share)


def test_metrics_are_ranked_in_their_own_type(spark):
    fine = [D("0.10014"), D("0.10011"), D("0.10014"), None, D("0.09999")]
    wide = [1e-9, 2e-9, 1e300, 2e-9, None]
    df = spark.createDataFrame(
        [(i, 1, f, w) for i, (f, w) in enumerate(zip(fine, wide, strict=True))],
        "id int, g int, fine decimal(7,5), wide double",
    )
    for up in (True, False):
        ranked = competition_ranks(df, ["g"], {"a": "fine", "b": "wide"}, ascending=F.lit(up))
        got = {r.id: (r.a, r.b) for r in ranked.collect()}
        want = zip(expected_ranks(fine, up), expected_ranks(wide, up), strict=True)
        assert got == dict(enumerate(want))


def test_one_group_of_all_rows_with_hot_values_repeats_and_odd_doubles(spark):
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-320, -1e308, 1.7e308, None]
    data = [(i % 700, 0.25 if i % 3 else (i * 7919 % 4001) / 7, i % 5) for i in range(6000)]
    data += [(i, v, None) for i, v in enumerate(odd * 2)]
    df = spark.createDataFrame(data, "id int, v double, w int").repartition(6)
    for up in (True, False):
        want = df.selectExpr(
            "*", f"rank() OVER (ORDER BY v IS NULL, v {'ASC' if up else 'DESC'}) AS a",
            f"rank() OVER (ORDER BY w IS NULL, w {'ASC' if up else 'DESC'}) AS b",
        ).withColumn("g", F.lit(1))
        got = competition_ranks(df.withColumn("g", F.lit(1)), ["g"], {"a": "v", "b": "w"}, F.lit(up))
        assert got.count() == len(data)
        assert got.select(want.columns).exceptAll(want).isEmpty()


def test_ranges_never_fall_and_split_a_season(spark):
    values = sorted([x / 997 - 40 for x in range(80_000)] + [10.0**e for e in range(-300, 300, 7)])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranges = [r[0] for r in df.select(value_range(F.col("v"))).collect()]
    assert ranges == sorted(ranges)
    assert max(ranges.count(r) for r in set(ranges[70_000:])) < 60


def test_first_per_key_takes_the_lowest_order(spark, rows):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, None), (None, 1, "n")],
        "k int, o int, v string",
    )
    assert rows(first_per_key(df, ["k"], [F.col("o")])) == [
        (1, 1, "a"), (2, 9, None), (None, 1, "n"),
    ]
