"""Exact duplicates by content-defined chunk recipes, in column functions only.

1. **Chunks.** A text, its white space runs made one space, is cut where its content says so: after a
   space that follows a chosen character, at the first such place past ``least`` characters, and after
   ``most`` characters where there is none. An edit moves the cuts near it alone, so texts share the chunks
   before and after it, and no chunk is longer than ``most``.
2. **Verified identifiers.** A chunk's identifier is two 64-bit hashes of it. All distinct chunks are brought
   together once, repeats combined before they move, and no two different ones may have the same
   identifier; if two have, identifiers of the next seed are taken and verified in turn. So equal
   identifiers mean equal chunks, proven on the data and not only likely.
3. **Recipes.** A document becomes the list of its chunks' identifiers, 16 bytes for some hundred
   characters. Equal texts have equal lists, and the lists are equal for no others, so lists are grouped in place of texts; copies
   combine before the shuffle, and a list that a third of all rows share joins its group by a skewed
   join that Spark splits. A long document moves once, as its distinct chunks.

Cost: two passes over the texts (one verifies, one writes recipes and digests) and the shuffle of distinct
chunks. Nothing is broadcast or collected but the verdict of a verification.

Defined cases: a null text is empty; empty texts are equal and have an empty recipe. White space at the
ends of a text stays, as one space. Of equal texts the smallest id stays; rows that repeat it are kept
as well. A null id is larger than any other and stays only if its group has no other (keep_id is then
null and all rows of the group are kept). Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sabermill.llm.tables import col, written

# Runs of white space other than one space; those are already what they become.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
LEAST, MOST = 512, 4096
SEEDS = 8


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.coalesce(F.regexp_replace(text, RUNS, " "), F.lit(""))


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Pieces of a text that give it when joined, cut by content."""
    # Every fourth character of ASCII, and all others, so that no script goes without cuts.
    chosen = "".join(rf"\x{code:02X}" for code in range(0, 128, 4)) + r"\x{80}-\x{10FFFF}"
    place = rf"(?<=[{chosen}]\x20)"
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most}}}?{place}|.{{1,{most}}}"), F.lit(0))


def two_hashes(chunk: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), chunk), F.xxhash64(F.lit(2 * seed + 1), chunk)]


def chunk_store(docs: DataFrame, seed: int, *, text_col: str = "text", least: int = LEAST, most: int = MOST, identify: Callable[[Column, int], list[Column]] = two_hashes) -> DataFrame:
    """The distinct chunks of all texts: a, b (their identifier) and chunk."""
    cut = docs.select(F.explode(chunks(normalised(col(text_col)), least, most)).alias("chunk"))
    a, b = identify(F.col("chunk"), seed)
    return cut.select(a.alias("a"), b.alias("b"), "chunk").distinct()


def verified_seed(docs: DataFrame, **options) -> int:
    """The first seed whose identifiers tell all distinct chunks of ``docs`` apart."""
    for seed in range(SEEDS):
        shared = chunk_store(docs, seed, **options).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if shared.isEmpty():
            return seed
    raise RuntimeError(f"identifiers of {SEEDS} seeds all failed to tell the chunks apart")


def recipe(text: Column, seed: int, *, least: int = LEAST, most: int = MOST, identify: Callable[[Column, int], list[Column]] = two_hashes) -> Column:
    """Identifiers of a text's chunks, in order."""
    return F.flatten(F.transform(chunks(text, least, most), lambda chunk: F.array(*identify(chunk, seed))))


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text) of every row.

    ``options``: least, most (characters of a chunk) and identify, which gives the two hashes of a chunk.
    """
    seed = verified_seed(docs, text_col=text_col, **options)
    text = normalised(col(text_col))
    rows = docs.select(col(id_col).alias("doc_id"), text.alias("text"))
    listed = rows.select("doc_id", recipe(F.col("text"), seed, **options).alias("recipe"), F.sha2("text", 256).alias("text_sha256"))
    listed = written(listed, "recipes")
    # Written, so that the join below reads plain shuffles, of which Spark can split a hot list's.
    groups = listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups.where("group_size > 1"), "groups")
    done = listed.join(groups, "recipe", "left").withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return done.select("doc_id", "keep_id", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), kept, "text_sha256")
