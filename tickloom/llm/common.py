"""Helpers shared by the operators: table access, scratch tables, slices of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at once (a longer text is a slice of its own).
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share.

    Only a local session without that setting gets a temporary folder; on a cluster it is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that operators on texts read, whatever else stands in the table."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary array and the offsets of its values; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.large_binary()
    texts = pc.fill_null(texts.cast(kind), pa.scalar(b"", kind))
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most `most` bytes of text (or one row): rows, their bytes, offsets."""
    for batch in batches:
        buf, at = buffers(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield batch.slice(i, j - i), buf[at[i] : at[j]], at[i : j + 1] - at[i]
            i = j


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start .. start + length - 1 of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
