"""Benchmark decontamination: which words of a document lie inside a benchmark passage.

A prefix-filtered set join with containment 1. Every item is cut into windows of ``window``
consecutive words (a shorter item is one window). A window is a set of shingles of up to
``shingle`` words at fixed offsets. A document contains the window only if it contains every one of
its shingles, so with shingles ordered by rarity in the corpus the necessary prefix of a window is
its single rarest shingle. The documents' shingles are joined with those prefixes alone. The length
bound (the window fits into the document) and the positional bound (the shingle's offset fixes the
start) leave one candidate start for each match, and the words of that span are compared exactly.

Everything is built-in column functions. The documents are scanned once to count the items'
shingles and once to join the prefixes; no shingle of a document is shuffled: the counts combine
before the shuffle and the join streams past a broadcast block of windows. A block has at most
``block_windows`` windows whatever the benchmark's size; a larger benchmark takes more blocks, that
is, more scans.

Defined cases:

* A null or empty text has no words, no hits and no items; an item without words has no window.
* Rows are told apart by (id, text). Repeated rows each get the same result; rows that share an id
  but not a text get their own.
* An item whose id is null marks words but isn't counted or listed as an item. Repeated item rows
  count once.
* Empty tables give no rows or no hits. Columns of ``docs`` are carried along; those named like a
  result column are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sabermill.llm.tables import col, others
from sabermill.session import settle

# A word is a run of characters that are neither ASCII marks, spaces nor controls.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def words_of(text: Column) -> Column:
    """Words after lower-casing A to Z; none for null."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    lowered = F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _key(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def item_windows(items: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows with the items they come from and their shingles' keys and offsets."""
    words = items.select(col(id_col).alias("item"), words_of(col(text_col)).alias("words"))
    words = words.where(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(window)))
    starts = words.select("item", "words", "len", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("len") + 1)).alias("at"))
    cut = starts.groupBy(F.slice("words", F.col("at"), F.col("len")).alias("words")).agg(F.collect_set("item").alias("items"))
    cut = cut.withColumn("len", F.size("words")).withColumn("size", F.least(F.col("len"), F.lit(shingle)))
    keys = reduce(
        lambda rest, n: F.when(F.col("size") == n, F.transform(F.sequence(F.lit(0), F.col("len") - n), lambda i: _key(F.col("words"), i, n))).otherwise(rest),
        range(1, shingle + 1),
        F.array().cast("array<bigint>"),
    )
    return cut.withColumn("keys", keys)


def _shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """One row for each position of a document and shingle size; ``words`` stays beside it."""
    # The outer form adds no filter on the array, for which every text would be cut twice.
    at = docs.select("*", F.posexplode_outer("words").alias("pos", "word"))
    keyed = [F.when(F.col("pos") + n <= F.size("words"), _key(F.col("words"), F.col("pos"), n)) for n in sizes]
    # No lambda here: it would end the generated code between the array and the join, and every
    # row would carry a copy of the words.
    key = keyed[0] if len(keyed) == 1 else F.explode(F.array(*keyed))
    return at.withColumn("key", key).where(F.col("key").isNotNull())


def _in_blocks(small: DataFrame, rows: int, bound: int) -> list[DataFrame]:
    """``small`` cut by hash into parts of about ``bound`` rows, each fit to be broadcast."""
    parts = -(-rows // bound)
    if parts <= 1:
        return [F.broadcast(small)]
    return [F.broadcast(small.where(F.pmod(F.col("key"), F.lit(parts)) == i)) for i in range(parts)]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 10,
    shingle: int = 3,
    block_windows: int = 200_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurring window), n_items and item_ids (items
    with an occurring window) and contaminated (n_hit > 0).

    The windows of the benchmark are written once to the shared folder.
    """
    windows = settle(item_windows(items, window, shingle, item_col, item_text_col), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    kept = others(docs, *RESULT)
    text = col(text_col)
    row = [col(id_col).alias("__id"), F.xxhash64(text).alias("__text"), words_of(text).alias("words")]
    hits = None
    if sizes:
        keyed = _shingles(docs.select(*row), sizes)
        asked = windows.select(F.explode("keys").alias("key")).distinct()
        counted = [
            keyed.join(part, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("seen"))
            for part in _in_blocks(asked, asked.count(), block_windows)
        ]
        seen = reduce(DataFrame.unionAll, counted)
        placed = windows.select("words", "items", F.posexplode("keys").alias("offset", "key"))
        # A window with a shingle that no document has occurs nowhere: the inner join and the
        # count of its shingles drop it.
        prefix = (
            placed.join(seen, "key")
            .groupBy("words", "items")
            .agg(F.min(F.struct("seen", "offset", "key")).alias("rarest"), F.count(F.lit(1)).alias("found"))
            .where(F.col("found") == F.size("words") - F.least(F.size("words"), F.lit(shingle)) + 1)
            .select(F.col("words").alias("wanted"), "items", "rarest.offset", "rarest.key")
        )
        prefix = settle(prefix, "prefixes")
        start = F.col("pos") - F.col("offset")
        length = F.size("wanted")
        found = [
            keyed.join(part, "key")
            .where((start >= 0) & (start + length <= F.size("words")))
            .where(F.slice("words", start + 1, length) == F.col("wanted"))
            .select("__id", "__text", F.struct(start.alias("start"), (start + length).alias("end")).alias("span"), "items")
            for part in _in_blocks(prefix, prefix.count(), block_windows)
        ]
        hits = reduce(DataFrame.unionAll, found)
        hits = hits.groupBy("__id", "__text").agg(
            F.sort_array(F.collect_set("span")).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("__items"),
        )
    base = docs.select(*[col(n).alias(n) for n in kept], *row[:2], F.size(words_of(text)).cast("long").alias("n_words"))
    item_type = items.select(col(item_col)).dtypes[0][1]
    none = F.array().cast(f"array<{item_type}>")
    if hits is None:
        joined = base.withColumns({"n_hit": F.lit(0).cast("long"), "item_ids": none})
    else:
        # Spans in order of their starts; each adds what lies beyond the furthest end so far.
        merged = F.aggregate(
            "spans",
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, s: F.struct(
                (acc.n + F.greatest(F.lit(0), s.end - F.greatest(acc.end, s.start))).alias("n"),
                F.greatest(acc.end, s.end).alias("end"),
            ),
        )
        hits = hits.select(F.col("__id").alias("__hit_id"), F.col("__text").alias("__hit_text"), merged.n.cast("long").alias("n_hit"), F.col("__items").alias("item_ids"))
        same = F.col("__id").eqNullSafe(F.col("__hit_id")) & F.col("__text").eqNullSafe(F.col("__hit_text"))
        joined = base.join(hits, same, "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "item_ids": F.coalesce("item_ids", none)})
    return joined.select(
        *[col(n) for n in kept],
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        "item_ids",
        (F.col("n_hit") > 0).alias("contaminated"),
    )
