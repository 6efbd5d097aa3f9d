"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.sources.readers import NULL_CELL, escaped


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = "locality",
    mode: str = "errorifexists",
    cluster_by: str | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Parquet, one folder per city, so that a city filter reads one folder.

    The rebalance hint gathers each city into few files and lets AQE split a
    city that is too large for one task. With ``cluster_by``, each file is sorted
    by that column within its city and has a Bloom filter of it, so that a
    question about one of its values reads few row groups: those whose range has
    the value, and whose filter does.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*[c for c in (partition_by, cluster_by) if c])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if cluster_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{cluster_by}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A table whose rows are dealt to buckets by ``key`` and sorted in them, kept under ``path``.

    Two such tables with as many buckets are joined by the key, or one is grouped
    by it, without a shuffle, as often as they are read. Each task writes its
    rows of a bucket to a file of its own, so rows are dealt before.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", one_line: bool = False, compression: str = "gzip"
) -> None:
    """CSV, gzipped, that ``read_csv`` gives back.

    With ``one_line``, line breaks in strings are escaped, so a record is a line
    and a file that is not compressed, or by bzip2, is read by several tasks; empty
    strings are then kept apart from NULL, and any text from its mark.
    """
    if one_line:
        df = df.select([escaped(F.col(f"`{f.name}`")).alias(f.name) if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in df.schema])
    (
        df.write.mode(mode)
        .option("header", True)
        .option("compression", compression)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", NULL_CELL)
        .option("emptyValue", '""' if one_line else "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


MOST_LINES = 100_000


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file with the lines of a report in order; refuses more than ``MOST_LINES``."""
    if lines.limit(MOST_LINES + 1).count() > MOST_LINES:
        raise ValueError(f"a report has at most {MOST_LINES} lines")
    one = lines.coalesce(1).sortWithinPartitions("line_no")
    one.select(F.col("line").alias("value")).write.mode(mode).text(path)
