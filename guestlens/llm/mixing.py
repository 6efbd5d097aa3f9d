"""Mix sources to target weights by thresholds on a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm.common import WORD, join_small, materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
# Each level looks at so many further bits of the hash. The last two tell rows
# apart that have the same id and text.
BITS, LEVELS = 10, 6
_HASH_BITS, _OWN_BITS = 62, 40


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """The target of each source: its part of ``share`` of everything by weight.

    No target is above ``most`` times the source's size; what is cut off goes to
    the others by weight until none is above. That is one level ``x`` with
    target = min(weight * x, cap): the sources whose caps bind are those with
    the smallest cap per weight, so sums over that order give ``x`` directly.
    ``sizes`` has one row per source; weights repeat in code point order, null last.
    """
    everything = W.partitionBy(F.lit(0))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sizes.select(
        "source",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights)))).alias("_weight"),
        (F.col("source_size") * F.lit(float(most))).alias("_cap"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_budget"),
    )
    order = W.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    levelled = weighted.withColumn("_level", level)
    # The first source, in that order, whose cap does not bind sets the level of all after it.
    free = F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.col("_level"))
    found = levelled.withColumn("_free", F.first(free, ignorenulls=True).over(order))
    return found.select(
        "source",
        "source_size",
        F.least(F.coalesce(F.col("_free") * F.col("_weight"), F.col("_cap")), F.col("_cap")).alias("target"),
    )


def _bucket(level: int) -> Column:
    """The bits of the hash that ``level`` looks at."""
    shift = _HASH_BITS - BITS * (level + 1)
    return F.shiftright("_hash", shift).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def mix(
    docs: DataFrame,
    size: Column,
    keep: list[str],
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """How much the mix takes of each document: 0, 1 .. ``most`` times its size.

    ``keep`` names columns of ``docs`` to return, whatever their names; docs has source, doc_id and text. A source gives every document ``floor(target / size)`` times, and once
    more those whose hash is below the source's threshold. The threshold comes
    from a histogram of sizes by source and hash bucket: whole buckets are taken
    while they fit, then only the boundary bucket is split by further bits, until
    it holds one row. A row in the last boundary bucket is taken if that brings
    the sum nearer to the target. Nothing is sorted and each row is decided by
    its own hash, so reruns agree.

    Null sources are a source of their own, null sizes count 0, repeated rows
    are rows of their own, an empty table gives an empty result.
    """
    spread = F.xxhash64("_id", "_text")
    own = ((1 << _OWN_BITS) - 1) << (_HASH_BITS - _OWN_BITS)
    rows = docs.select(
        # Packed, so that no kept name can clash with one of the columns here.
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_keep"),
        "source",
        F.coalesce(size, F.lit(0)).cast("long").alias("_size"),
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_text"),
    ).withColumn(
        # The upper bits depend on id and text alone; the lower ones tell equal rows apart.
        "_hash",
        spread.bitwiseAND(F.lit(own)).bitwiseOR(
            F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << (_HASH_BITS - _OWN_BITS)) - 1))
        ),
    )
    rows = materialize(rows.drop("_id", "_text"), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    goals = targets(sizes, weights, share, most)
    goals = goals.withColumn("_times", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long"))
    goals = materialize(
        goals.withColumn("_rest", F.col("target") - F.col("_times") * F.col("source_size")).withColumn(
            "_key", F.xxhash64("source", F.col("source").isNull())
        ),
        "mix-targets",
    )
    limits = _thresholds(rows.withColumn("_key", F.xxhash64("source", F.col("source").isNull())), goals)
    table = goals.join(limits, "_key", "left").select(
        "_key", "source_size", "target", "_times", F.coalesce("_limit", F.lit(0)).alias("_limit")
    )
    rows = rows.withColumn("_key", F.xxhash64("source", F.col("source").isNull()))
    joined = join_small(rows, materialize(table, "mix-limits"), ["_key"], "inner", F.col("_hash"))
    times = F.col("_times") + (F.col("_hash") < F.col("_limit")).cast("long")
    kept = [F.col("_keep").getField(c).alias(c) for c in keep]
    return joined.select(*kept, F.col("_size").alias("size"), "source_size", "target", (times * F.col("_size")).alias("taken"))


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(_key, _limit): rows with a hash below the limit sum up to the rest of the target.

    Every pass reads what is left: all rows first, then the boundary buckets.
    """
    state = goals.select("_key", F.col("_rest"), F.lit(0).cast("long").alias("_limit"))
    left = rows.select("_key", "_hash", "_size")
    for level in range(LEVELS):
        width = F.lit(1 << (_HASH_BITS - BITS * (level + 1)))
        histogram = (
            left.withColumn("_bucket", _bucket(level))
            .groupBy("_key", "_bucket")
            .agg(F.sum("_size").alias("_sum"), F.count("*").alias("_rows"))
        )
        up_to = W.partitionBy("_key").orderBy("_bucket")
        sums = histogram.join(state, "_key").withColumn("_up_to", F.sum("_sum").over(up_to))
        # The boundary is the first bucket that does not fit whole, at most one per source.
        over = sums.where(F.col("_up_to") > F.col("_rest"))
        first = over.groupBy("_key").agg(
            F.min(F.struct("_bucket", "_sum", "_rows", (F.col("_rest") - F.col("_up_to") + F.col("_sum")).alias("_rest"))).alias("_b")
        )
        merged = state.join(first, "_key", "left")
        start = F.col("_limit") + F.col("_b._bucket").cast("long") * width
        last = (F.col("_b._rows") == 1) if level < LEVELS - 1 else F.lit(True)
        nearer = F.col("_b._sum") - F.col("_b._rest") < F.col("_b._rest")
        merged = materialize(
            merged.select(
                "_key",
                F.when(F.col("_b").isNull(), None).when(last, None).otherwise(F.col("_b._bucket")).alias("_open"),
                F.when(F.col("_b").isNull(), F.lit(None)).otherwise(F.col("_b._rest")).alias("_rest"),
                # Without a boundary every row fits: the limit is the end of this range.
                F.when(F.col("_b").isNull(), F.col("_limit") + F.lit(1 << (_HASH_BITS - BITS * level)))
                .when(last, start + F.when(nearer, width).otherwise(F.lit(0)))
                .otherwise(start)
                .alias("_limit"),
            ),
            "mix-level",
        )
        done = merged.where(F.col("_open").isNull()).select("_key", "_limit")
        limits = done if level == 0 else limits.unionByName(done)
        open_ = merged.where(F.col("_open").isNotNull())
        if level == LEVELS - 1 or open_.isEmpty():
            break
        boundary = open_.select("_key", "_open")
        inside = join_small(left, boundary, ["_key"], "inner", F.col("_hash"))
        left = materialize(inside.where(_bucket(level) == F.col("_open")).drop("_open"), "mix-boundary")
        state = open_.select("_key", "_rest", "_limit")
    return limits


def mix_documents(docs: DataFrame) -> DataFrame:
    """The contract's mix of documents: doc_id, size, source_size, target, taken."""
    return mix(docs, n_words(F.col("text")), ["doc_id", "source"]).drop("source")
