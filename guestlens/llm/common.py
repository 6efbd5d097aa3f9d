"""Helpers that the operators share: work folder, size-checked joins, texts as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.session import landed, materialize, new_path, scratch, work_dir  # noqa: F401

# A small side is broadcast up to this many rows; above, both sides are shuffled.
BROADCAST_ROWS = 200_000
# Bytes of text that a Python worker looks at at once; its arrays take some fifty times as much.
SLICE = 1 << 19
# Rows of a hot key are spread over this many shuffle keys.
SALTS = 64
# The words of the contracts: runs of anything but space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """A name of a text for joins between scans: 128 bits of hashes, null for none.

    A row's place in the input would differ between jobs if their number of cores did.
    """
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), F.col(text), F.lit(2)).alias("b"))
    return F.when(F.col(text).isNotNull(), key)


def join_small(
    rows: DataFrame, small: DataFrame, keys: list[str], how: str, spread: Column | None = None, most: int = BROADCAST_ROWS
) -> DataFrame:
    """Join rows to a table with one row per key.

    The table is counted first; keys may repeat in it if there is no salt. Up to ``most`` rows it is broadcast. Beyond
    that both sides are shuffled, whatever size Spark expects: it takes a table for as large as its
    compressed files, and no larger when it is repeated. Where keys repeat in ``rows`` and may be hot,
    the table is repeated once per salt, and rows pick a salt by ``spread``,
    a number that differs between rows of one key.
    """
    if small.count() <= most:
        return rows.join(F.broadcast(small), keys, how)
    if spread is None:
        return rows.join(small.hint("merge"), keys, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(spread, F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
