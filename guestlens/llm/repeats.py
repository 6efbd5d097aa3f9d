"""Substring dedup by level-wise doubling of repeated word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import hashing
from guestlens.llm.common import landed, materialize, slices

WINDOW = 13
# Doubling starts from seeds of at most so many words.
LEAST_SEED = 8
_SECOND = np.uint64(0xA0761D6478BD642F)  # makes the second hash of a window
LAST = (1 << 63) - 1  # stands for a null doc_id, which is smaller than none


def _seeds(w: hashing.Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The seed of every window: which windows exist, their seeds' hashes and places.

    A seed is half a window (half + half - 1 words make a window), namely the
    one with the smallest hash in the window, the first of equals. Equal windows
    have equal seeds, so a window can only be repeated if its seed is.
    """
    half = window // 2 + 1
    at = np.flatnonzero(w.left() >= window)
    if not len(at):
        return at, np.empty(0, np.uint64), at, half
    grams = hashing.windows(hashes, half)
    best, place = grams[at], at.copy()
    for j in range(1, window - half + 1):
        other = grams[at + j]
        less = other < best
        best = np.where(less, other, best)
        place = np.where(less, at + j, place)
    return at, best, place, half


def _seed_rows(window: int, with_windows: bool):
    """Arrow function: documents to their seeds, or to seeds with the run of windows that chose them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = hashing.words(batch.column("text"))
            at, seed, place, _ = _seeds(w, hashing.word_hashes(w), window)
            if not len(at):
                continue
            text_of = w.text_of()
            # Windows that share a seed follow one another.
            new = np.concatenate([[True], (place[1:] != place[:-1]) | (text_of[at[1:]] != text_of[at[:-1]])])
            head = np.flatnonzero(new)
            columns = {"seed": pa.array(seed[head].view(np.int64))}
            own = pa.array(text_of[at[head]])
            if with_windows:
                columns["_ref"] = batch.column("_ref").take(own)
                columns["first"] = pa.array((at[head] - w.first[text_of[at[head]]]).astype(np.int32))
                columns["n"] = pa.array(np.diff(np.concatenate([head, [len(at)]])).astype(np.int32))
            else:
                columns["_order"] = batch.column("_order").take(own)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _window_rows(length: int, below: int):
    """Arrow function: documents with the runs of places that survived to a row per window of ``length``.

    A run names places of windows itself (``below`` 0), or of repeated windows of
    ``below`` words; then both ends of a window have to be such places. Two
    64-bit hashes are a window's identity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = hashing.words(batch.column("text"))
            hashes = hashing.word_hashes(w)
            runs = batch.column("runs")
            base = np.repeat(w.first[:-1], pc.list_value_length(runs).to_numpy(zero_copy_only=False))
            spans = runs.flatten()
            first = base + spans.field("first").to_numpy(zero_copy_only=False)
            last = np.minimum(first + spans.field("n").to_numpy(zero_copy_only=False), len(hashes))
            inside = first < len(hashes)
            change = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(change, first[inside], 1)
            np.add.at(change, last[inside], -1)
            open_ = np.cumsum(change[:-1]) > 0
            at = np.flatnonzero(open_ & (w.left() >= length))
            if below:
                at = at[open_[at + length - below]]
            if not len(at):
                continue
            text_of = w.text_of()[at]
            own = pa.array(text_of)
            yield pa.RecordBatch.from_pydict({
                "h1": pa.array(hashing.windows(hashes, length)[at].view(np.int64)),
                "h2": pa.array(hashing.windows(hashing.mix(hashes ^ _SECOND), length)[at].view(np.int64)),
                "_order": batch.column("_order").take(own),
                "_ref": batch.column("_ref").take(own),
                "at": pa.array((at - w.first[text_of]).astype(np.int32)),
            })

    return run


def lengths(window: int) -> list[int]:
    """The lengths of the levels, two at least: each at most twice the one before, the last is ``window``."""
    found = [window]
    while len(found) < 2 or found[0] > LEAST_SEED:
        found.insert(0, found[0] // 2 + 1)
    return found


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of documents that also start in a document with a smaller ``_order``.

    ``docs`` has text, _order and _ref, a hash of both. Returns ``_order``,
    ``_ref`` and ``at``, the window's first word in its document.

    The first level counts one seed per window of the second length, half as
    long. The seeds are about a quarter of all places. At each level windows that
    stand in documents of one ``_order`` alone end there; the others are extended to twice
    their length, up to ``window`` or until none survive. Counting is by partial
    sums and the joins are with one row per key, so a passage in many documents
    meets in no single task. Only places travel back to the texts, in lists as
    long as their document at most.
    """
    spark, rows, levels = docs.sparkSession, docs.select("text", "_order", "_ref"), lengths(window)
    runs = landed(spark, "runs", lambda: _by_document(_seed_runs(rows, levels[1])))
    schema = "h1 long, h2 long, _order long, _ref long, at int"
    for below, length in zip([0, *levels[1:]], levels[1:]):
        # Read twice, hashed twice: the windows themselves would fill more disk than the texts.
        opened = rows.join(runs, "_ref").mapInArrow(_window_rows(length, below), schema)
        firsts = landed(spark, "window-firsts", lambda: _window_firsts(opened))
        if length == window or firsts.isEmpty():
            return _later(opened, firsts)
        repeated = _repeated(opened, firsts).select("_ref", F.col("at").alias("first"), F.lit(1).alias("n"))
        runs = landed(spark, "runs", lambda: _by_document(repeated))


def _seed_runs(rows: DataFrame, window: int) -> DataFrame:
    """(_ref, first, n): the runs of windows whose seed stands in documents of different order."""
    seeds = rows.select("text", "_order").mapInArrow(_seed_rows(window, False), "seed long, _order long")
    alive = materialize(_in_several(seeds, ["seed"]), "seeds")
    found = rows.select("text", "_ref").mapInArrow(_seed_rows(window, True), "seed long, _ref long, first int, n int")
    return found.join(alive, "seed", "left_semi").drop("seed")


def _by_document(runs: DataFrame) -> DataFrame:
    return runs.groupBy("_ref").agg(F.collect_set(F.struct("first", "n")).alias("runs"))


def _in_several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand in documents of different order."""
    ends = rows.groupBy(*keys).agg(F.min("_order").alias("_first"), F.max("_order").alias("_last"))
    return ends.where(F.col("_first") < F.col("_last")).select(*keys)


def _window_firsts(opened: DataFrame) -> DataFrame:
    """(h1, h2, _first): windows in documents of different order, and the smallest one.

    ``h2`` is null where all windows of an h1 have the same, so that joins need no
    more than h1; where two different windows share it, each has a row with its own.
    """
    ends = F.min("_order").alias("_first"), F.max("_order").alias("_last")
    by_one = opened.groupBy("h1").agg(*ends, F.min("h2").alias("_a"), F.max("h2").alias("_b"))
    by_one = materialize(by_one.where(F.col("_first") < F.col("_last")), "by-one-hash")
    clear = by_one.where("_a = _b").select("h1", F.lit(None).cast("long").alias("h2"), "_first")
    shared = by_one.where("_a < _b").select("h1")
    if shared.isEmpty():
        return clear
    both = opened.join(shared, "h1", "left_semi").groupBy("h1", "h2").agg(*ends)
    return clear.union(both.where(F.col("_first") < F.col("_last")).select("h1", "h2", "_first"))


def _repeated(opened: DataFrame, firsts: DataFrame) -> DataFrame:
    """(_order, _ref, at, _first) of the windows that ``firsts`` has."""
    clear = opened.drop("h2").join(firsts.where("h2 IS NULL").drop("h2"), "h1")
    found = clear.select("_order", "_ref", "at", "_first")
    if not firsts.where("h2 IS NOT NULL").isEmpty():
        found = found.union(opened.join(firsts, ["h1", "h2"]).select("_order", "_ref", "at", "_first"))
    return found


def _later(opened: DataFrame, firsts: DataFrame) -> DataFrame:
    return _repeated(opened, firsts).where(F.col("_first") < F.col("_order")).select("_order", "_ref", "at")


def _cut(window: int, with_text: bool):
    """Arrow function: documents with their repeated windows to what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, removed, digests, kept_texts = [], [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts")):
                words = (text or "").encode().split()
                if starts.is_valid and len(starts.values):
                    gone = np.zeros(len(words) + 1, np.int64)
                    places = starts.values.to_numpy()
                    np.add.at(gone, places, 1)
                    np.add.at(gone, places + window, -1)
                    keep = np.cumsum(gone[:-1]) == 0
                    kept = [words[i] for i in np.flatnonzero(keep)]
                else:
                    kept = words
                joined = b" ".join(kept)
                n_words.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined.decode() if with_text else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept_text": pa.array(kept_texts, pa.string()),
            })

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Documents without the words that an earlier document's window covers.

    Returns doc_id, n_words, n_removed, kept_sha256, kept_text (kept words joined
    by one space; null unless ``with_text``). Of equal doc_ids none is earlier
    than the other; a null doc_id is later than all others. Null, empty and short
    texts have no windows and stay as they are. Rows with equal id and text have
    equal results. Other columns, whatever their names, are not looked at. An
    empty table gives an empty result.

    Documents are named by their id and a hash of it and the text, the same in every scan.
    """
    order = F.coalesce("doc_id", F.lit(LAST)).cast("long")
    rows = docs.select("doc_id", "text", order.alias("_order"), F.xxhash64(order, "text").alias("_ref"))

    def make() -> DataFrame:
        # Bounded by the length of the document itself.
        return repeated_windows(rows, window).groupBy("_order", "_ref").agg(F.collect_set("at").alias("starts"))

    spans = landed(docs.sparkSession, "repeats", make)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    found = rows.join(spans, ["_order", "_ref"], "left").select("doc_id", "text", "starts")
    return found.mapInArrow(_cut(window, with_text), schema)
