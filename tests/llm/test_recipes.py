import hashlib
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.llm import recipes
from sabermill.llm.recipes import chunk_store, chunks, exact_duplicates, normalised, two_hashes, verified_seed


def expected(rows):
    """Brute force over (doc_id, text)."""
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (doc, _), text in zip(rows, texts, strict=True):
        group = [d for (d, _), t in zip(rows, texts, strict=True) if t == text]
        keep = min((d for d in group if d is not None), default=None)
        out.append((doc, keep, len(group), doc == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in exact_duplicates(df, **options).collect()), key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop ä漢", k=rng.randint(1, 9))) for _ in range(n))


def test_equals_brute_force_with_copies_nulls_and_white_space(spark):
    rng = random.Random(3)
    base = [words(rng, n) for n in (0, 1, 5, 200, 900, 3000)]
    rows = [(7, None), (3, ""), (9, " "), (None, "\t"), (1, " \n"), (None, None), (None, "only nameless"), (None, "only nameless")]
    rows += [(i, rng.choice(base).replace(" ", rng.choice([" ", "  ", "\t\n", "\x0b"]))) for i in range(20, 60)]
    rows += [(2, base[3]), (2, base[3]), (2, base[4]), (61, base[5] + " "), (62, base[5] + "x"), (63, " " + base[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == expected(rows)
    assert found(df, least=4, most=16) == expected(rows)


def test_chunks_join_to_the_text_and_move_with_it(spark):
    rng = random.Random(5)
    text = words(rng, 4000)
    edited = text[:5000] + "inserted words" + text[5000:]
    huge = "x" * 50_000
    df = spark.createDataFrame([(text,), (edited,), (huge,), ("𝒳" * 9000,), ("",), (None,)], "text string")
    cut = [r[0] for r in df.select(chunks(normalised(F.col("text")))).collect()]
    given = ["".join(c) for c in cut]
    assert given[0] == re.sub(r"[\x20\x09-\x0D]+", " ", text) and given[2:] == [huge, "𝒳" * 9000, "", ""]
    assert all(0 < len(c) <= recipes.MOST for each in cut for c in each)
    shared = set(cut[0]) & set(cut[1])
    assert len(shared) >= 0.8 * len(cut[0]) and len(cut[0]) > 15


def test_identifiers_that_collide_are_replaced(spark):
    rows = [(i, f"text number {i % 30} " * 100) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def weak(chunk, seed):  # all chunks look alike until the third seed
        return two_hashes(chunk, seed) if seed >= 2 else [F.lit(1).cast("long"), F.length(chunk).cast("long")]

    assert verified_seed(df, identify=weak) == 2
    assert found(df, identify=weak) == expected(rows) == found(df)


def test_a_hot_text_moves_its_chunks_once(spark):
    text = words(random.Random(8), 2000)
    df = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string")
    assert chunk_store(df, 0).count() < 40
    kept = exact_duplicates(df).agg(F.count_if("kept"), F.min("group_size"), F.count("*")).first()
    assert tuple(kept) == (1, 300, 300)


def test_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", 5, 6, 7), (2, "a  b", 5, 6, 7)], "id long, `te.xt` string, a int, recipe int, chunk int")
    got = exact_duplicates(df, id_col="id", text_col="te.xt")
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert [r.keep_id for r in got.collect()] == [1, 1]
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plans = [exact_duplicates(df), chunk_store(df, 0)]
    text = "".join(p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert not re.search("Python|Arrow|Pandas", text)
    assert isinstance(exact_duplicates(df).schema["group_size"].dataType, T.LongType)
