"""Helpers for operators that add columns to a table in one pass over its batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


#: Bytes of a batch that goes to Python. Both sides hold several copies of a batch.
BATCH_BYTES = 1 << 23
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow in batches of about BATCH_BYTES; at the end of a task its worker gives free memory back.

    Spark reads the size of batches from the session when a job starts: a larger setting is lowered, a smaller one stays.
    """
    spark = df.sparkSession
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_SETTING, "64m").removeprefix("-"))
    if now > BATCH_BYTES or spark.conf.get(_SETTING, "").startswith("-"):
        spark.conf.set(_SETTING, str(BATCH_BYTES))

    def trimmed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(it)
        give_back()

    return df.mapInArrow(trimmed, schema)


def give_back() -> None:
    """Return free memory of Arrow and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str):
    """A column by its exact name, dots and all."""
    return df[f"`{name.replace('`', '``')}`"]


def position(df: DataFrame, name: str) -> int:
    """The place of a column by its exact name, dots and all, else by its name in any case; the first of several."""
    same = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not same:
        raise ValueError(f"no column {name} among {df.columns}")
    return same[0]


def append_column(df: DataFrame, field: T.StructField, work: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """df with one more column, computed batch by batch in Arrow; other columns pass through, one of its name is replaced by it."""
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() != field.name.lower()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([*[batch.columns[i] for i in kept], work(batch)], names=[*[batch.schema.names[i] for i in kept], field.name])

    return map_arrow(df, run, T.StructType([*[df.schema.fields[i] for i in kept], field]))


def key_name(key: str, results) -> str:
    """The name under which a key is returned: its own, or with underscores before it where a result column has that name."""
    taken = {c.lower() for c in results}
    while key.lower() in taken:
        key = f"_{key}"
    return key


def struct_of(names, arrays) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(a) for a in arrays], names=list(names))


def longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def as_text(name: str):
    """A text column as a string, null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
