"""Sampled splitters: near-equal shards by ranges of a key."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm.common import materialize

ROW_BYTES = 16
# Ranges per shard, and sampled records per range. Both only set how fine and
# how even the ranges are; shards are cut by exact sums.
RANGES = 32
SAMPLES = 16
LOWEST = 1 - (1 << 63)


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed share per record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _splitters(records: DataFrame, total: int, wanted: int) -> list[tuple[int, int, int]]:
    """Boundaries of the ranges, from a sample that weighs records by size.

    A record is drawn with probability ``size / step``; one larger than a step is
    always drawn and counts in full. The sample has ``wanted * SAMPLES`` records
    on average whatever the input, so the driver sorts it.
    """
    step = max(1.0, total / (wanted * SAMPLES))
    draw = F.pmod(F.xxhash64("_tie", "_row", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = records.where(draw * step < F.col("_size")).select("_key", "_tie", "_row", "_size")
    sample = sorted((r[0], r[1], r[2], max(float(r[3]), step)) for r in drawn.collect())
    if not sample:
        return []
    sums = list(accumulate(s[3] for s in sample))
    cut, points = sums[-1] / wanted, []
    for (key, tie, row, _), s in zip(sample, sums):
        if s >= cut * (len(points) + 1):
            points.append((key, tie, row))
            while s >= cut * (len(points) + 1):
                points.append((key, tie, row))
    # A key that fills a range or more is overfull: it gets ranges of its own,
    # cut by the tie-breaker. Every other boundary moves to the start of its key.
    hot = {a[0] for a, b in zip(points, points[1:]) if a[0] == b[0]}
    ends = {(k, LOWEST, LOWEST) for k, _, _ in points} | {p for p in points if p[0] in hot}
    ends |= {(k + 1, LOWEST, LOWEST) for k in hot if k < -LOWEST}
    return sorted(ends)


def _range_of(points: list[tuple[int, int, int]]) -> Column:
    """The number of boundaries at or below a record: a binary search in an array."""
    if not points:
        return F.lit(0)
    # A folded literal: bounded by the number of ranges, so is its use per row.
    bounds = F.expr("array(" + ",".join(f"struct({k}L, {t}L, {r}L)" for k, t, r in points) + ")")
    own = F.struct("_key", "_tie", "_row")
    steps = [1 << i for i in reversed(range(len(points).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= own, at + step).otherwise(at),
    )


def shard(docs: DataFrame, shards: int, key: Column, tie: Column, size: Column, keep: list[str]) -> DataFrame:
    """Deal records to shards 0 to ``shards`` - 1 of near-equal size, by ranges of ``key``.

    Law ``bytes``. Size-weighted key samples give quantile boundaries; records
    are partitioned by those ranges, keys that overfill a range are subdivided
    by ``tie``, and running sums inside the ranges place each record at its exact
    position in key order, which names its shard. Records of one key share a
    shard unless their sum is a range (1 / RANGES of a shard) or more.

    Returns ``keep`` and size, law, shard, slot (gapless from 0 in each shard,
    in order of key) and grown_shard (null for this law). Null keys, ties and
    sizes are allowed; repeated rows are told apart by their place in the input.
    An empty table gives an empty result. Only the named columns are carried, so
    input columns may have any other names.
    """
    records = materialize(
        docs.select(
            *keep,
            F.coalesce(size, F.lit(0)).cast("long").alias("_size"),
            F.coalesce(key, F.lit(0)).cast("long").alias("_key"),
            F.coalesce(tie, F.lit(0)).cast("long").alias("_tie"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-keys",
    )
    total = records.agg(F.sum("_size")).first()[0] or 0
    points = _splitters(records, total, shards * RANGES)
    ranged = records.withColumn("_range", _range_of(points))

    sizes = ranged.groupBy("_range").agg(F.sum("_size").alias("_bytes"))
    in_order = W.orderBy("_range")
    starts = sizes.select("_range", (F.sum("_bytes").over(in_order) - F.col("_bytes")).alias("_start"))
    by_range = W.partitionBy("_range").orderBy("_key", "_tie", "_row")
    hot = [p[0] for p in points if p[1] != LOWEST]
    whole = ~F.col("_key").isin(sorted(set(hot))) if hot else F.lit(True)
    placed = (
        # One row per range: len(points) + 1 rows, bounded by the shard count.
        ranged.join(F.broadcast(starts), "_range")
        .withColumn("_before", F.sum("_size").over(by_range) - F.col("_size"))
        .withColumn("_group", F.min("_before").over(W.partitionBy("_range", "_key").orderBy("_tie", "_row")))
        .withColumn("_at", F.col("_start") + F.when(whole, F.col("_group")).otherwise(F.col("_before")))
        .withColumn("shard", F.floor(F.col("_at") * F.lit(shards) / F.lit(max(total, 1))).cast("int"))
        .withColumn("shard", F.least("shard", F.lit(shards - 1)))
        .withColumn("_n", F.row_number().over(by_range))
        .withColumn("_n", F.col("_n") - F.min("_n").over(W.partitionBy("_range", "shard")))
    )
    placed = materialize(placed.select(*keep, "_size", "_range", "shard", "_n"), "shard-places")
    pieces = placed.groupBy("_range", "shard").agg(F.count("*").alias("_rows"))
    by_shard = W.partitionBy("shard").orderBy("_range")
    pieces = pieces.select("_range", "shard", (F.sum("_rows").over(by_shard) - F.col("_rows")).alias("_first"))
    return placed.join(F.broadcast(pieces), ["_range", "shard"]).select(
        *keep,
        F.col("_size").alias("size"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_first") + F.col("_n")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Documents in ``shards`` shards, equal texts together."""
    keyed = docs.select(
        "doc_id",
        record_size(F.col("text")).alias("_bytes"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
    )
    return shard(
        keyed, shards, F.col("_text"), F.xxhash64("doc_id"), F.col("_bytes"), ["doc_id", "text_crc32"]
    )
