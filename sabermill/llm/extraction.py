"""Main text of web pages, by markup and by differences between neighbouring pages of a host.

Pages are ordered by (host, path) and dealt to tasks by ranges of that order, so a large host is spread
over many tasks. Range bounds are keys of pages chosen by hash, a number bounded by that of ranges. The last
page of a range is handed on to the next range, and the first one to the range before, so where the bounds lie
changes no result. A page's partner is the page before it in the same host, for the first one of the host
the page after it. The lines of both are aligned by longest common subsequence, and lines that both
have are template text: they are deleted.

Differences alone don't give the article: menus and footers differ from page to page, and articles
of copied pages are equal. So markup comes first. Text in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments is no line at all. Where a page marks its
article (or, failing that, its main part), that is the text, and shared lines inside it stay. Lines of pages
without such marks are kept unless they are shared.

Alignment trims equal ends and then divides the longer page until one line is left, with bit-parallel
rows, so memory grows with the lines of two pages and not with their product.

Defined cases: a null page is empty; an empty page, or one of template text only, has the text "". A page
without a partner (alone in its host, or with a null or odd URL of its own) loses no shared line. Repeated rows
are pages of their own, so a page that marks no article and stands beside its own copy is all template.
Extra columns are carried along; those named like a result column are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.llm.html_lines import ARTICLE, MAIN, OPEN, lines_of
from sabermill.llm.tables import bundle, col, unbundle, written


_KEYS_A_RANGE = 64


def _row(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    every = free = (1 << len(b)) - 1
    for x in a:
        hit = free & places.get(x, 0)
        free = ((free + hit) | (free - hit)) & every
    bits = np.unpackbits(np.frombuffer(free.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            out.append(a1 - 1)
            a1, b1 = a1 - 1, b1 - 1
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                out.append(a0)
            continue
        half = (a0 + a1) // 2
        front, back = _row(a[a0:half], b[b0:b1]), _row(a[half:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int((front + back).argmax())
        stack += [(a0, half, b0, cut), (half, a1, cut, b1)]
    return sorted(out)


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None) -> tuple[str, int]:
    """The text of a page and how many lines were deleted as shared with its partner."""
    shared = set(shared_lines([t for t, _ in lines], [t for t, _ in partner])) if partner is not None else set()
    kinds = {k for _, k in lines}
    chosen = ARTICLE if ARTICLE in kinds else MAIN if MAIN in kinds else OPEN
    kept = [t for i, (t, k) in enumerate(lines) if k == chosen and (k != OPEN or i not in shared)]
    return " ".join(kept), sum(k == OPEN for i, (_, k) in enumerate(lines) if i in shared)


def range_bounds(keys: list[tuple[str, str]], ranges: int) -> list[str]:
    """Bounds of ``ranges`` ranges among the sorted (host, key) of some pages."""
    bounds = set()
    for r in range(1, ranges):
        i = r * len(keys) // ranges
        if 2 <= i < len(keys) - 1:
            host, key = keys[i]
            inside = keys[i - 2][0] == host == keys[i + 1][0]
            bounds.add(key if inside else host)
    return sorted(bounds)


def extract(pages: DataFrame, *, range_bytes: int = 8 << 20, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without the HTML, with text, n_chars (code points) and n_shared (lines deleted as shared)."""
    url = F.coalesce(col(url_col), F.lit(""))
    address = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)", 1), F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)", 2)
    result = ("text", "n_chars", "n_shared")
    rows = pages.select(
        F.lower(address[0]).alias("host"), address[1].alias("path"), col(id_col).alias("id"), col(url_col).alias("url"), col(html_col).alias("html"), bundle(pages, id_col, url_col, html_col, *result).alias("rest")
    )
    # One text that sorts as (host, path, url, id) do; the characters between sort before any other.
    key = F.concat_ws("\x00", "host", "path", F.coalesce("url", F.lit("")), F.coalesce(F.lpad(F.col("id").cast("string"), 20, "0"), F.lit("")))
    rows = rows.withColumn("key", key)
    count, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("html").cast("long"))).first()
    ranges = max(1, -(-(size or 0) // range_bytes))
    every = max(1, count // (ranges * _KEYS_A_RANGE))
    chosen = rows.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("host", "key").limit(8 * ranges * _KEYS_A_RANGE)
    bounds = range_bounds(sorted(tuple(r) for r in chosen.collect()), ranges) if ranges > 1 else []

    @F.arrow_udf("int")
    def range_of(keys: pa.Array) -> pa.Array:
        return pa.array([bisect_right(bounds, k) for k in keys.to_pylist()], pa.int32())

    dealt = rows.withColumn("range", range_of("key")).withColumn("own", F.lit(True))
    if bounds:
        # Pages at the edges of each range, as neighbours for the range beside it; they give no rows there.
        edges = written(dealt.groupBy("range").agg(F.min("key").alias("low"), F.max("key").alias("high")), "edges")
        handed = [
            dealt.join(edges.select(F.col(end).alias("key"), (F.col("range") + step).alias("beside")), "key").dropDuplicates(["key"])
            for end, step in (("high", 1), ("low", -1))
        ]
        for beside in handed:
            beside = beside.withColumn("range", F.col("beside")).withColumn("own", F.lit(False))
            dealt = dealt.unionByName(beside.select(dealt.columns))
    dealt = dealt.repartitionById(ranges, "range")
    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_shared", T.LongType()), rows.schema["rest"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=4)
        def parsed(page: str) -> list[tuple[str, int]]:
            return lines_of(page)

        def stream():
            for batch in batches:
                hosts, pages_, ranges_ = (batch.column(i).to_pylist() for i in (0, 4, 7))
                for i, (host, page, own) in enumerate(zip(hosts, pages_, ranges_, strict=True)):
                    yield (own, host), page or "", batch, i

        # A batch is complete when the page after its last one is known, so results come with a delay of one page.
        done: list[tuple[str, int]] = []
        current = None

        def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, shared = zip(*done, strict=True)
            done.clear()
            found = pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(shared, pa.int64()), batch.column(5)], schema.names)
            return found.filter(batch.column(8))

        for _, own in groupby(stream(), key=lambda r: r[0]):
            before = held = None
            for (_, host), page, batch, i in own:
                if before is None and held is None and host:
                    held = (page, batch, i)  # the first of its host waits for the second
                    continue
                if held is not None:
                    before = held[0]
                    if current is not None and held[1] is not current:
                        yield finish(current)
                    current, held_page, held = held[1], held[0], None
                    done.append(main_text(parsed(held_page), parsed(page)))
                if current is not None and batch is not current:
                    yield finish(current)
                current = batch
                done.append(main_text(parsed(page), parsed(before) if before is not None and host else None))
                before = page
            if held is not None:
                if current is not None and held[1] is not current:
                    yield finish(current)
                current = held[1]
                done.append(main_text(parsed(held[0]), None))
        if current is not None:
            yield finish(current)

    done = dealt.sortWithinPartitions("range", "key").mapInArrow(run, schema)
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), *result, *unbundle(done, pages, id_col, url_col, html_col, *result))
