"""File scans with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens import schemas


# What stands for NULL in a CSV cell, so that an empty string can be itself.
NULL_CELL = "\\N"


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, or one JSON array per line, which gives a row per element."""
    return spark.read.schema(schema).json(path)


# What line breaks, and the backslash that begins such pairs, are in a CSV of one line per record.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(text: Column) -> Column:
    """A text on one line: every backslash in it begins one of the pairs of ``ESCAPES``."""
    for plain, pair in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(pair))
    return text


def unescaped(text: Column) -> Column:
    for plain, pair in reversed(ESCAPES):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


def read_csv(spark: SparkSession, path: str, schema: T.StructType, one_line: bool = False) -> DataFrame:
    """CSV, gzipped or not, with line breaks and doubled quotes inside fields.

    Such a file is read by one task: use it for hand-over only. One that was
    written with ``one_line`` is split like any text file.
    """
    table = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", not one_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", NULL_CELL)
        .option("emptyValue", "")
        .csv(path)
    )
    if one_line:
        texts = {f.name: unescaped(F.col(f"`{f.name}`")) for f in schema if f.dataType == T.StringType()}
        table = table.withColumns(texts) if texts else table
    return table


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.REVIEWS_RAW)


def read_offerings(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.OFFERINGS_RAW)


def read_model_input(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.MODEL_INPUT)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.MODEL_METRICS)
