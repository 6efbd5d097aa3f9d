"""Exact Jaccard join on word shingles: a grouped prefix join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm import common, hashing
from guestlens.llm.common import WORD, landed, materialize, slices
from guestlens.llm.components import components

SHINGLE = 5
# Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 75
# So many of the most frequent shingles come last in the global order. Any order
# gives the same result; this one keeps widely shared passages out of prefixes.
COMMON = 1 << 18
_BLOCK = 1 << 20  # shingles counted at once in a task
# Candidates share so many shingles of their prefixes, or what their sizes ask for.
SHARED = 4
# A shared shingle has one of so many hubs among the groups that have it.
HUBS = 16
# Turns of hubs, each with others, while a turn links a hundredth of the nodes.
ROUNDS = 5
LAST = (1 << 63) - 1  # stands for a null doc_id, which is smaller than none
# Tables about nodes are broadcast up to so many rows: what is a hundredth of an input is soon more.
SMALL = 10_000
join_small = partial(common.join_small, most=SMALL)
_SLOTS = 22  # bits of a hash that name its slot among common ones


def _shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle hashes of each text in order of place, repeats included."""
    w = hashing.words(column)
    hashes = hashing.word_hashes(w, lower=True)
    grams = hashing.windows(hashes, SHINGLE)
    short = hashing.whole(hashes, w)
    for k, (a, n) in enumerate(zip(w.first[:-1].tolist(), w.counts.tolist())):
        yield grams[a : a + n - SHINGLE + 1] if n >= SHINGLE else short[k : k + (n > 0)]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that stand in three or more different texts of a block, with the number of texts."""

    def counted(block: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(block), return_counts=True)
        often = n >= 3
        return pa.RecordBatch.from_pydict(
            {"slot": pa.array((values[often] >> np.uint64(64 - _SLOTS)).astype(np.int64)), "n": pa.array(n[often].astype(np.int64))}
        )

    block, size, seen = [np.empty(0, np.uint64)], 0, set()
    for batch in slices(batches, "text"):
        for node, found in zip(batch.column("_node").to_pylist(), _shingles(batch.column("text"))):
            if node not in seen:
                seen.add(node)
                block.append(np.unique(found))
                size += len(block[-1])
        if size >= _BLOCK:
            yield counted(block)
            block, size, seen = [np.empty(0, np.uint64)], 0, set()
    yield counted(block)


def _common_slots(rows: DataFrame) -> bytes:
    """A bit per slot (2 ** 22 in all): whether it holds frequent shingles.

    At most ``COMMON`` slots are set: those whose count reaches a power of two
    that few enough slots reach.
    """
    counts = rows.select("text", "_node").mapInArrow(_frequent, "slot long, n long")
    counts = materialize(counts.groupBy("slot").agg(F.sum("n").alias("n")), "frequent")
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect()
    cut, total = 64, 0
    for level, n in sorted(levels, reverse=True):
        total += n
        if total > COMMON:
            break
        cut = level
    bits = np.zeros(1 << _SLOTS, bool)
    slots = [r[0] for r in counts.where(F.floor(F.log2("n")) >= cut).select("slot").collect()]
    bits[slots] = True
    return np.packbits(bits).tobytes()


def _ordered(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Distinct shingles in the global order, as signed numbers."""
    last = common[found >> np.uint64(64 - _SLOTS)].astype(np.int64) << 62
    return np.unique((found >> np.uint64(2)).astype(np.int64) | last)


def prefix_length(n: int) -> int:
    """Two sets that link share a shingle among so many first ones of each."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def _prefixes(packed: bytes):
    common = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal common
        common = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in slices(batches, "text"):
            n, group, prefix = [], [], []
            for found in _shingles(batch.column("text")):
                own = _ordered(found, common)
                first = own[: prefix_length(len(own))]
                n.append(len(own))
                group.append(xxhash.xxh64_intdigest(first.tobytes(), seed=len(own)) - (1 << 63))
                prefix.append(first)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "_row": batch.column("_row"),
                "same": batch.column("_node"),
                "n": pa.array(n, pa.int32()),
                "grp": pa.array(group, pa.int64()),
                "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefix))),
            })

    return run


def _sets(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in slices(batches, "text", 1 << 20):
            own = [_ordered(found, common) for found in _shingles(batch.column("text"))]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("node"), "members": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own)))}
            )

    return run


def _least_overlap(a: Column, b: Column) -> Column:
    """The smallest intersection of sets of these sizes that link."""
    return F.ceil((a + b) * F.lit(PERCENT) / F.lit(100 + PERCENT)).cast("int")


def _prefix(n: Column) -> Column:
    return n - F.ceil(n * F.lit(PERCENT) / F.lit(100)).cast("int") + 1


def _shared_prefix(a: Column, b: Column) -> Column:
    """How many shingles the prefixes of linked sets share at least.

    A set lacks at most ``n - overlap`` of the other's shingles, so of prefixes
    of length ``n - overlap + k`` at least k shingles meet.
    """
    overlap = _least_overlap(a, b)
    return F.least(_prefix(a) - a + overlap, _prefix(b) - b + overlap)


def _sizes_fit() -> Column:
    return 100 * F.least("n", "_m") >= PERCENT * F.greatest("n", "_m")


def _wanted() -> Column:
    """How many shared prefix shingles are asked of a pair of sizes n and _m: ``SHARED`` or the bound."""
    return F.least(F.lit(SHARED), _shared_prefix(F.col("n"), F.col("_m")))


def _meet() -> Column:
    """Sizes allow a link, and the shared shingle, at places ``at`` and ``_to``, is
    among the first ones of which sets of these sizes share ``_wanted``."""
    a, b = F.col("n"), F.col("_m")
    overlap = _least_overlap(a, b)
    return _sizes_fit() & (F.col("at") < a - overlap + _wanted()) & (F.col("_to") < b - overlap + _wanted())


def _ends(pairs: DataFrame, label: str) -> DataFrame:
    """The rows that stand for the nodes of the pairs."""
    return materialize(pairs.select(F.col("a").alias("_row")).union(pairs.select("b")).distinct(), label)


@dataclass
class _Texts:
    """Where the texts of nodes are: in rows with the node's hash and smallest id."""

    rows: DataFrame  # _node, _id, text
    nodes: DataFrame  # node, same, _least, _copies
    packed: bytes

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, members): the whole sets of the wanted nodes (_row), one row each.

        Rows are found by the text's hash and their id, which are the same in every scan.
        """
        named = self.nodes.join(wanted.withColumnRenamed("_row", "node"), "node")
        named = named.select("node", F.col("same").alias("_node"), F.col("_least.doc_id").alias("_id"), "_copies")
        named = materialize(named, "needed-nodes")
        texts = join_small(self.rows, named, ["_node", "_id"], "inner")
        found = texts.where("_copies = 1").select("text", "node")
        if not named.where("_copies > 1").isEmpty():
            # Repeated rows, with the same id and text, are one.
            found = found.union(texts.where("_copies > 1").select("text", "node").dropDuplicates(["node"]))
        return found.mapInArrow(_sets(self.packed), "node long, members array<long>")


def _verified(pairs: DataFrame, texts: _Texts) -> DataFrame:
    """Those of the pairs (a, b) whose sets link, by their whole sets.

    Sets of near copies are many times their files' size in memory, so they are not broadcast.
    """
    sets = materialize(texts.sets(_ends(pairs, "needed-rows")), "sets").hint("merge")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("_b")), "b"
    )
    shared = F.size(F.array_intersect("_a", "_b"))
    linked = 100 * shared >= PERCENT * (F.size("_a") + F.size("_b") - shared)
    return materialize(both.where(linked).select("a", "b"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, stays and text_hash of every document.

    ``stays`` marks one row of each component, the first with its smallest id.

    Equal texts are one node. Nodes with equal prefixes and size are one group.
    Groups that share a prefix shingle are candidates if their sizes and the
    number of shared prefix shingles allow a link. First each group is paired
    with one of a few representatives per shared shingle (hubs, by hash) and groups
    are expanded to their members, paired with the group's leader; whole sets
    verify these pairs, and the links found join nodes to components. Then every
    pair of nodes of *different* components that share a prefix shingle is
    checked, be they of two groups or of one, so no link between components is
    lost, while copies of one text in many variants never meet all against all.

    Null and empty texts, and texts without words, have no shingles and link
    with nothing; their component is their own doc_id. A text of fewer than five
    words is one shingle. Repeated doc_ids are rows of their own; a null doc_id
    counts for no component's smallest. An empty table gives an empty result.
    Other columns, whatever their names, are not looked at. Rows are numbered
    once, in a table that is written; texts are read again by their hash and id.
    """
    return landed(docs.sparkSession, "near-duplicates", lambda: _labelled(docs))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, but one of each component: the first with its smallest id.

    All documents without words stay.
    """
    columns = docs.columns
    node, own_id = F.xxhash64("text").alias("_node"), F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("_id")

    def make() -> DataFrame:
        keys = near_duplicates(docs).where("n_shingles > 0").groupBy(own_id, F.col("text_hash").alias("_node"))
        return keys.agg(F.bool_or("stays").alias("stays"), F.count("*").alias("_copies")).where("stays").drop("stays")

    first = landed(docs.sparkSession, "first-of-each", make)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_keep"), node, own_id, _has_words("text").alias("_worded"))
    joined = join_small(keyed, first, ["_id", "_node"], "left")
    stays = joined.where("NOT _worded OR _copies = 1")
    if not first.where("_copies > 1").isEmpty():
        stays = stays.union(joined.where("_worded AND _copies > 1").dropDuplicates(["_id", "_node"]))
    return stays.select(*[F.col("_keep").getField(c).alias(c) for c in columns])


def _has_words(text: str) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(WORD)), F.lit(False))


def _labelled(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("_node"),
        F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("_id"),
        # Only read from the table that it is written to.
        F.monotonically_increasing_id().alias("_row"),
    )
    packed = _common_slots(rows)
    schema = "doc_id long, _row long, same long, n int, grp long, prefix array<long>"
    table = materialize(rows.drop("_id").mapInArrow(_prefixes(packed), schema), "prefixes")
    worded = table.where("n > 0")
    own = worded.groupBy("same", F.coalesce("doc_id", F.lit(LAST)).alias("doc_id")).agg(
        F.min("_row").alias("_row"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("grp").alias("grp")
    )
    nodes = own.groupBy("same").agg(
        F.min("_row").alias("node"),
        F.min(F.struct("doc_id", "_row", "copies")).alias("_least"),
        F.min("n").alias("n"),
        F.min("grp").alias("grp"),
    )
    nodes = materialize(nodes.withColumn("_copies", F.col("_least.copies")), "nodes")
    texts = _Texts(rows.select("_node", "_id", "text"), nodes.select("node", "same", "_least", "_copies"), packed)
    leaders = nodes.groupBy("grp").agg(F.min("node").alias("leader"), F.min("n").alias("n"), F.max("node").alias("_last"))
    leaders = materialize(leaders, "groups")
    spark = docs.sparkSession
    shared_hits = landed(spark, "shared-hits", lambda: _shared_hits(worded, leaders))

    members = nodes.join(leaders.select("grp", "leader"), "grp").where("node != leader")
    within = members.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    found = nodes.select("node", F.col("node").alias("component")).limit(0)
    all_nodes = nodes.count()
    for turn in range(ROUNDS):
        hubs = landed(spark, "stars", lambda: _by_prefix(materialize(_stars(shared_hits.where("between"), leaders, found, turn), "stars"), worded))
        links = landed(spark, "links", lambda: _verified(hubs if turn else materialize(hubs.union(within), "pairs"), texts))
        size = links.count()
        if size:
            found = _joined(found, links)
        if 100 * size < all_nodes:
            break
    rest = landed(spark, "rest", lambda: _by_prefix(_between(shared_hits, nodes, found), worded))
    links = landed(spark, "links", lambda: _verified(rest, texts))
    if not links.isEmpty():
        found = _joined(found, links)

    labelled = join_small(nodes, found, ["node"], "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("_least").alias("_first"))
    of_node = materialize(labelled.join(least, "component").select("same", "_first"), "component-ids")
    final = join_small(table.select("doc_id", "same", "n", "_row"), of_node, ["same"], "left", F.col("_row"))
    alone = F.col("n") == 0
    return final.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).when(F.col("_first.doc_id") < LAST, F.col("_first.doc_id")).alias("component_id"),
        (alone | (F.col("_row") == F.col("_first._row"))).alias("stays"),
        F.col("same").alias("text_hash"),
    )


def _shared_hits(worded: DataFrame, leaders: DataFrame) -> DataFrame:
    """(token, at, grp, n, between): the prefix shingles of groups that two nodes have; ``between`` two groups."""
    first = materialize(leaders.select(F.col("leader").alias("_row")), "first-rows")
    once = join_small(worded.select("_row", "grp", "n", "prefix"), first, ["_row"], "left_semi")
    tokens = materialize(once, "group-prefixes").select(F.posexplode("prefix").alias("at", "token"), "grp", "n")
    ends = tokens.groupBy("token").agg(F.min("grp").alias("_a"), F.max("grp").alias("_b"))
    shared = materialize(ends.where("_a < _b").select("token"), "shared-tokens")
    hits = tokens.join(shared, "token", "left_semi").withColumn("between", F.lit(True))
    # The prefix of a group of two or more nodes is shared, whatever other groups have.
    several = materialize(leaders.where("leader < _last").select("grp"), "several")
    inside = join_small(tokens, several, ["grp"], "left_semi").join(shared, "token", "left_anti")
    return hits.unionByName(inside.withColumn("between", F.lit(False)))


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links; a component stands for its links so far by a star."""
    return landed(found.sparkSession, "components", lambda: components(found.toDF("a", "b").union(links.select("a", "b"))))


def _stars(hits: DataFrame, leaders: DataFrame, found: DataFrame, turn: int) -> DataFrame:
    """Pairs of leaders of different components: each group with the hubs of its shared shingles.

    In the first turn the hub of a shingle is the group most of whose prefix other
    groups have as well: the text that near copies were made of shares all of it,
    a copy not the shingles that are its own. Later turns take hubs by hash.
    Only guesses that join most of what belongs together: whatever is left out
    here meets in ``_between``.
    """
    own = join_small(leaders.withColumnRenamed("leader", "node"), found, ["node"], "left")
    label = own.select("grp", F.col("node").alias("leader"), F.coalesce("component", "node").alias("_c"))
    label = materialize(label, "group-labels")
    of_hub = F.xxhash64("grp", F.pmod(F.col("token"), F.lit(HUBS)), F.lit(turn)).alias("_h")
    open_ = join_small(hits, label, ["grp"], "inner")
    if turn == 0:
        # A group's shingles are no more than its text's.
        part = -F.count("*").over(W.partitionBy("grp")) / _prefix(F.col("n"))
        open_ = open_.withColumn("_part", part)
    else:
        open_ = open_.withColumn("_part", F.lit(0.0))
    hubs = open_.groupBy("token").agg(F.min(F.struct("_part", of_hub, "leader", "n", "_c")).alias("_hub"))
    hubs = hubs.select("token", F.col("_hub.leader").alias("_g"), F.col("_hub.n").alias("_m"), F.col("_hub._c").alias("_d"))
    stars = open_.join(materialize(hubs, "hubs"), "token").where((F.col("_c") != F.col("_d")) & _sizes_fit())
    stars = stars.select(F.greatest("leader", "_g").alias("a"), F.least("leader", "_g").alias("b"), "n", "_m")
    counted = stars.groupBy("a", "b").agg(F.count("*").alias("_k"), F.min("n").alias("n"), F.min("_m").alias("_m"))
    return counted.where(F.col("_k") * 2 * HUBS >= _shared_prefix(F.col("n"), F.col("_m"))).select("a", "b")


def _by_prefix(pairs: DataFrame, worded: DataFrame) -> DataFrame:
    """Pairs whose prefixes share as many shingles as linked sets do at least."""
    own = join_small(worded.select("_row", "n", "prefix"), _ends(pairs, "prefix-rows"), ["_row"], "left_semi")
    own = materialize(own.withColumnRenamed("_row", "node"), "prefix-own").hint("merge")
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("n").alias("_n"), F.col("prefix").alias("_p")), "a").join(
        own.select(F.col("node").alias("b"), F.col("n").alias("_m"), F.col("prefix").alias("_q")), "b"
    )
    enough = F.size(F.array_intersect("_p", "_q")) >= _shared_prefix(F.col("_n"), F.col("_m"))
    return both.where(enough).select("a", "b")


def _between(hits: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that their prefixes allow to link."""
    label = join_small(nodes, found, ["node"], "left").select("grp", "node", F.coalesce("component", "node").alias("_c"))
    open_ = join_small(hits, materialize(label, "labels"), ["grp"], "inner")
    ends = open_.groupBy("token").agg(F.min("_c").alias("_a"), F.max("_c").alias("_b"))
    mixed = materialize(ends.where("_a < _b").select("token"), "open-tokens")
    open_ = join_small(open_, mixed, ["token"], "left_semi").select("token", "node", "_c", "n", "at")
    open_ = materialize(open_, "open-hits")
    other = open_.select(
        "token", F.col("node").alias("b"), F.col("_c").alias("_d"), F.col("n").alias("_m"), F.col("at").alias("_to")
    )
    pairs = open_.withColumnRenamed("node", "a").join(other, "token").where(
        (F.col("a") < F.col("b")) & (F.col("_c") != F.col("_d")) & _meet()
    )
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("_k"), F.min("n").alias("n"), F.min("_m").alias("_m"))
    return materialize(counted.where(F.col("_k") >= _wanted()).select("a", "b"), "between")
