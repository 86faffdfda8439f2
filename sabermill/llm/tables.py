"""Reading the given tables and keeping extra columns out of the operators' way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sabermill.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, *used: str) -> list[str]:
    """Names of the columns that an operator carries along and doesn't produce itself."""
    taken = {name.lower() for name in used}
    return [name for name in df.columns if name.lower() not in taken]


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def bundle(df: DataFrame, *used: str) -> Column:
    """The carried columns as one struct, so that none of them can clash with an inner name."""
    names = others(df, *used)
    return F.struct(*[col(n).alias(n) for n in names]) if names else F.struct(F.lit(0).alias("_"))


def unbundle(df: DataFrame, source: DataFrame, *used: str) -> list[Column]:
    return [F.col("rest").getField(n).alias(n) for n in others(source, *used)]


def stretches(bound: int, *columns: pa.Array) -> Iterator[list[list]]:
    """Values of consecutive rows of about ``bound`` bytes of text, column by column; a batch is never held whole as Python texts."""
    sizes = np.ones(len(columns[0]), np.int64)
    for column in columns:
        sizes += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    begins = np.flatnonzero(np.diff(np.cumsum(sizes) // bound, prepend=-1)).tolist()
    for a, b in zip(begins, [*begins[1:], len(sizes)], strict=False):
        yield [column.slice(a, b - a).to_pylist() for column in columns]


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder with the writer's options, and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
