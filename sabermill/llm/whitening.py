"""Whitening of embeddings by incremental eigendecomposition.

Every entry c becomes the whole number floor(scale * c) + shift. The rows' covariance (around the mean of
all, divided by their number) has unit eigenvectors; a row's whitened value is its distance from the mean,
projected on a component, over the square root of that component's eigenvalue.

1. **Partitions.** Each keeps count, exact sums and a spectrum of its rows (``spectra.py``): blocks of rows of
   ``block_bytes`` are centred, turned into no more rows than they have columns, and taken in as rank-one updates
   through the secular equation, with deflation. Memory is a block and a square of the dimension.
2. **Combination.** Spectra are combined ``fan`` at a time, level by level, by an update for the distance of
   the means and one for each eigenpair, until one is left. No task and not the driver ever holds more
   than ``fan`` of them, however many partitions there are.
3. **Rayleigh-Ritz.** One more pass projects the rows, centred on the exact mean, on that basis and adds up
   their scatter, again level by level; its eigenvectors turn the basis, and its eigenvalues are the
   covariance's to double precision.
4. Two passes give the covariance of the whitened values (how far it is from the identity) and the rows.

Rows are never shuffled; what moves is a square matrix for each partition. A basis is bounded by the
dimension, which is a property of the model that made the vectors and not of their number.

Defined cases: rows with a null vector, or a null or non-finite entry, are dropped. Vectors of different lengths lie
in different spaces: each length has its own fit (the driver holds a basis for each). Components without
variance (under 1e-12 of the largest) can't be whitened and give no rows: none at all for a single row, or
for equal rows. Of equal eigenvalues any basis is right. Repeated rows count each and give each their rows; ids
are carried along, null or not. ``deviation`` is exact, a decimal, null beyond 38 digits. Entries that
don't fit 62 bits when scaled raise an error, as an overflow does in ANSI SQL. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sabermill.llm.spectra import Spectrum, centred, column_sums
from sabermill.llm.tables import col, written

_DIGITS = pa.decimal128(38, 0)
# A component with less of the largest one's variance is rounding, not variance.
_NOTHING = 1e-12
# Rows of results in one Arrow batch.
_RESULTS = 1 << 16


def _blocks(batch: pa.RecordBatch, scale: float, shift: int, block_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, whole-number rows, their places in the batch), one length at a time."""
    vectors = batch["vector"]
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    if np.abs(flat).max(initial=0) >= 2.0**61:
        raise OverflowError("a scaled entry does not fit 62 bits")
    flat = flat.astype(np.int64) + shift
    begins = np.cumsum(lengths) - lengths
    for size in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == size)
        step = max(1, block_bytes // (8 * max(1, size)))
        for a in range(0, len(own) if size else 0, step):
            places = own[a : a + step]
            yield size, flat[begins[places][:, None] + np.arange(size)], places


def _folded(parts: DataFrame, merge: Callable[[pa.Table], pa.Table], name: str, fan: int) -> dict[int, dict]:
    """One row for each length, merged ``fan`` at a time; ``parts`` has one for each length and partition."""
    parts = written(parts.withColumn("at", F.spark_partition_id().cast("long")), name)
    schema = parts.drop("at").schema
    most = parts.agg(F.max("at")).first()[0]
    while most:  # also None, if there is no part
        parts = parts.withColumn("at", F.floor(F.col("at") / fan))

        def merged(key: tuple, table: pa.Table) -> pa.Table:
            return merge(table.drop_columns("at")).append_column("at", pa.array([key[1].as_py()], pa.int64()))

        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        parts = parts.groupBy("size", "at").applyInArrow(merged, f"{names}, at long")
        most //= fan
    return {r["size"]: r.asDict() for r in parts.collect()}  # one for each length


def _added(table: pa.Table) -> pa.Table:
    """Sums of the matrices of a length."""
    total = sum(np.frombuffer(m, "<f8") for m in table["total"].to_pylist())
    return pa.table({"size": table["size"].slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})


def _record(size: int, s: Spectrum) -> dict:
    return {
        "size": pa.array([size], pa.int32()), "n": pa.array([s.n], pa.int64()), "sums": pa.array([[Decimal(v) for v in s.sums]], pa.list_(_DIGITS)),
        "spectrum": pa.array([s.values.astype("<f8").tobytes() + np.ascontiguousarray(s.vectors).astype("<f8").tobytes()], pa.binary()),
    }


def _spectrum(size: int, n: int, sums: list, data: bytes) -> Spectrum:
    numbers = np.frombuffer(data, "<f8")
    return Spectrum(n, [int(v) for v in sums], numbers[:size].copy(), numbers[size:].reshape(size, size).copy())


def _combined(table: pa.Table) -> pa.Table:
    """Spectra of a length made one, the largest first, as every other is then taken in by it."""
    size = table["size"][0].as_py()
    found = sorted((_spectrum(size, *r) for r in zip(*[table[c].to_pylist() for c in ("n", "sums", "spectrum")], strict=True)), key=lambda s: -s.n)
    for other in found[1:]:
        found[0].merge(other)
    return pa.table(_record(size, found[0]))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums of (n x - sums)^2 over the entries of each row."""
    size, most = x.shape[1], int(np.abs(x).max(initial=0))
    if n * most + max(map(abs, sums)) < 1 << 62:
        y = n * x - np.array(sums, np.int64)
        if size * int(np.abs(y).max(initial=0)) ** 2 < 1 << 63:
            return pa.array((y * y).sum(axis=1)).cast(_DIGITS)
    y = n * x.astype(object) - np.array(sums, object)
    return pa.array([Decimal(v) if v < 10**38 else None for v in (y * y).sum(axis=1).tolist()], _DIGITS)


def whiten(
    vectors: DataFrame, *, components: int = 32, scale: float = 64, shift: int = 1_000_000, fan: int = 8, block_bytes: int = 1 << 24,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for every row and component."""
    spark = vectors.sparkSession
    rows = vectors.select(col(id_col).alias("vec_id"), col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))

    def per_partition(start: Callable, take: Callable, give: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            states: dict = {}
            for batch in batches:
                for size, x, _ in _blocks(batch, scale, shift, block_bytes):
                    if size not in states:
                        states[size] = start(size)
                    states[size] = take(states[size], size, x)
            for size, state in states.items():
                yield pa.RecordBatch.from_pydict(give(size, state))

        return run

    def add(spectrum: Spectrum, size: int, x: np.ndarray) -> Spectrum:
        spectrum.add_rows(x)
        return spectrum

    only = rows.select("vector")
    spectra = only.mapInArrow(per_partition(Spectrum.empty, add, _record), "size int, n long, sums array<decimal(38,0)>, spectrum binary")
    fits = {}
    for size, found in _folded(spectra, _combined, "spectra", fan).items():
        s = _spectrum(size, found["n"], found["sums"], found["spectrum"])
        fits[size] = (s.n, s.sums, np.linalg.qr(s.vectors)[0])

    def scatter(start: Callable[[int], int], project: Callable) -> dict[int, np.ndarray]:
        """Sums over all rows of the outer product of what ``project`` makes of them."""

        def take(total: np.ndarray, size: int, x: np.ndarray) -> np.ndarray:
            y = project(size, x)
            return total + y.T @ y

        def give(size: int, total: np.ndarray) -> dict:
            return {"size": pa.array([size], pa.int32()), "total": pa.array([total.astype("<f8").tobytes()], pa.binary())}

        parts = only.mapInArrow(per_partition(lambda size: np.zeros((start(size),) * 2), take, give), "size int, total binary")
        return {size: np.frombuffer(r["total"], "<f8").reshape(start(size), -1) for size, r in _folded(parts, _added, "scatter", fan).items()}

    bases = {}
    for size, total in scatter(lambda size: size, lambda size, x: centred(x, fits[size][0], fits[size][1]) @ fits[size][2]).items():
        n, sums, basis = fits[size]
        values, turn = np.linalg.eigh(total / n)
        order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > _NOTHING * max(values.max(), 0)]
        basis = basis @ turn[:, order]
        basis *= np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(order))] < 0, -1, 1) if order else 1
        bases[size] = (n, sums, basis / np.sqrt(values[order]), values[order] / np.trace(total / n) if order else np.empty(0))

    def whitened(size: int, x: np.ndarray) -> np.ndarray:
        n, sums, basis, _ = bases[size]
        return centred(x, n, sums) @ basis

    def with_one(size: int, x: np.ndarray) -> np.ndarray:
        return np.column_stack([whitened(size, x), np.ones(len(x))])

    errors = {}
    for size, total in scatter(lambda size: bases[size][2].shape[1] + 1, with_one).items():
        n = bases[size][0]
        mean = total[:-1, -1] / n
        errors[size] = float(np.abs(total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))).max(initial=0))

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, x, places in _blocks(batch, scale, shift, block_bytes):
                n, sums, basis, explained = bases[size]
                k = basis.shape[1]
                if not k:
                    continue
                values, deviations = whitened(size, x), _deviations(x, n, sums)
                step = max(1, _RESULTS // k)
                for a in range(0, len(x), step):
                    part = values[a : a + step]
                    which = np.repeat(np.arange(a, a + len(part)), k)
                    yield pa.RecordBatch.from_pydict({
                        "vec_id": batch["vec_id"].take(pa.array(places[which])), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                        "n": pa.array(np.full(len(which), n)), "deviation": deviations.take(pa.array(which)), "whitened": pa.array(part.ravel()),
                        "explained": pa.array(np.tile(explained, len(part))), "identity_error": pa.array(np.full(len(which), errors[size])),
                    })

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(result, f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
