"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import heapq
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm.common import join_small, materialize, slices

# The fit reads at most so many labelled documents of each kind, of at most so
# many characters each, chosen by a hash of their id.
TOXIC_DOCS, ORDINARY_DOCS, SAMPLE_CHARS = 2_000, 4_000, 20_000
CALIBRATION_DOCS = 20_000
THRESHOLD = 0.7
LEVEL = 19
TOXIC_BYTES, ORDINARY_BYTES = (1024, 4096), 32_768
# A window is one word, written so often that the compressor looks for matches.
REPEAT = 4
# Hashes are counted in so many buckets to find where a top-k is full.
_BUCKET_BITS = 14
_MARKS = b".,!?;:|\"'()[]#*$%&<>"
_CACHE = 300_000


def is_held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def plain(word: bytes) -> bytes:
    return word.strip(_MARKS).lower()


class Lengths:
    """The compressed lengths of a word under each dictionary, as one number."""

    def __init__(self, dictionaries: list[bytes]) -> None:
        self.compressors = []
        for data in dictionaries:
            kind = zstandard.ZstdCompressionDict(data)
            kind.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=kind, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def cell(self, word: bytes) -> int:
        if not word:
            return 0
        window = (b" " + word) * REPEAT + b" "
        cell = min(len(word), 20)
        for compressor in self.compressors:
            cell = cell << 8 | min(len(compressor.compress(window)), 255)
        return cell


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Dictionaries of ordinary text and, in two sizes, of what toxic text alone says."""
    draw = random.Random(7)
    known = {plain(w) for t in ordinary for w in t.encode().split()}
    only = [w for t in toxic for w in map(plain, t.encode().split()) if w and w not in known] or [b"-"]
    windows = []
    for t in ordinary:
        words = [plain(w) for w in t.encode().split()]
        windows += [b" ".join(words[i : i + 8]) for i in range(0, len(words), 8)]
    draw.shuffle(windows)
    samples = [b" " + b" ".join(draw.choices(only, k=6)) + b" " for _ in range(20_000)]
    return [_trained(ORDINARY_BYTES, windows[:60_000])] + [_trained(n, samples) for n in TOXIC_BYTES]


def _trained(size: int, samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b" ".join(samples)[-size:].rjust(8)


def _cells(dictionaries: list[bytes]):
    """Arrow function: labelled documents to the cells of their words, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, known = Lengths(dictionaries), {}
        for batch in slices(batches, "text"):
            toxic, cells = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = set()
                for word in set((text or "").encode().split()):
                    if word not in known:
                        if len(known) >= _CACHE:
                            known.clear()
                        known[word] = lengths.cell(plain(word))
                    own.add(known[word])
                cells += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_pydict({"toxic": pa.array(toxic, pa.int32()), "cell": pa.array(cells, pa.int64())})

    return run


def _features(dictionaries: list[bytes], ratios: dict[int, float], unseen: float):
    """Arrow function: per document the two largest ratios of its words, and how many words differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, known, plains = Lengths(dictionaries), {}, {}

        def ratio(word: bytes) -> float:
            own = plain(word)
            if own not in plains:
                if len(plains) >= _CACHE:
                    plains.clear()
                plains[own] = ratios.get(lengths.cell(own), unseen)
            if len(known) >= _CACHE:
                known.clear()
            known[word] = plains[own]
            return plains[own]

        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                words = set((text or "").encode().split())
                found = [ratio(w) if (r := known.get(w)) is None else r for w in words]
                top = heapq.nlargest(2, found) + [0.0, 0.0]
                rows.append((top[0], top[1], float(np.log1p(len(words)))))
            first, second, size = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "_row": batch.column("_row"),
                "first": pa.array(first, pa.float64()),
                "second": pa.array(second, pa.float64()),
                "size": pa.array(size, pa.float64()),
            })

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression with an intercept, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _first(rows: DataFrame, order: list[Column], most: int, label: str) -> DataFrame:
    """The ``most`` rows that come first by ``order``, whose first column is a hash; written in that order.

    A plain top-k would send so many rows of every partition, with their texts, to one place. So the
    bucket of hashes at which it is full is looked up first, and only rows up to there are sorted.
    """
    bucket = F.shiftright(order[0], 64 - _BUCKET_BITS).cast("int")
    reached, cut = 0, None
    for upto, n in sorted(rows.groupBy(bucket.alias("bucket")).count().collect()):
        reached += n
        if reached >= most:
            cut = upto
            break
    if cut is not None:
        rows = rows.where(bucket <= cut)
    return materialize(rows.orderBy(*order).limit(most), label)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Only labels of rows that are not held out are learned from. A bounded sample
    of them trains the dictionaries. Every learnable labelled document is then
    compressed word by word: how much likelier a pattern of lengths is in toxic
    documents calibrates the distances, and a logistic curve over a document's
    two most toxic words makes the score. Label, language, source and id are no
    inputs of a score, and each whole text is scored.

    Null and empty texts have a score too, from no words. Null ids are not held
    out and have no label; where a document has several labels the toxic one
    holds. Without labels of both kinds every score is the share of toxic labels
    (0 without any). An empty table gives an empty result. ``docs`` is a table,
    as rows are told apart by their place in its files.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    learn = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out())
    learn = materialize(learn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    labelled = materialize(
        join_small(rows, learn, ["doc_id"], "inner", F.col("_row")).select("doc_id", "text", "toxic", F.length("text").alias("chars")), "toxic-texts"
    )
    totals = dict(labelled.groupBy("toxic").count().collect())
    if not totals.get(0) or not totals.get(1):
        share = 1.0 if totals.get(1) else 0.0
        return _result(rows.select("doc_id"), F.lit(share))

    short = labelled.where(F.col("chars") <= SAMPLE_CHARS)
    samples = []
    for label, most in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS)):
        order = [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("text")]
        chosen = _first(short.where(F.col("toxic") == label), order, most, "toxic-sample")
        samples.append([r[0] for r in chosen.orderBy(*order).select("text").collect()])
    dictionaries = train_dictionaries(*samples)

    found = labelled.select("text", "toxic").mapInArrow(_cells(dictionaries), "toxic int, cell long")
    counts = found.groupBy("cell").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("plain")
    )
    ratio = F.log((F.col("toxic") + 0.1) / F.lit(totals[1] + 0.2)) - F.log((F.col("plain") + 1.0) / F.lit(totals[0] + 2.0))
    # Lengths are small numbers, so cells are few: 20 word lengths times lengths below 4 * 20 + 20.
    ratios = dict(counts.select("cell", ratio).collect())
    schema = "doc_id long, _row long, first double, second double, size double"
    measure = _features(dictionaries, ratios, 0.0)
    worded = labelled.where(F.col("chars").isNotNull()).select("doc_id", "text", F.col("toxic").cast("long").alias("_row"))
    sample = _first(worded, [F.xxhash64("doc_id", F.lit(1)), F.col("doc_id")], CALIBRATION_DOCS, "toxic-calibration")
    fit = sample.mapInArrow(measure, schema).toPandas()
    weights = _logistic(fit[["first", "second", "size"]].to_numpy(), (fit["_row"] == 1).to_numpy(float))
    linear = sum(F.col(c) * F.lit(float(w)) for c, w in zip(("first", "second", "size"), weights)) + F.lit(float(weights[-1]))
    return _result(rows.mapInArrow(measure, schema), 1 / (1 + F.exp(-linear)))


def _result(rows: DataFrame, value) -> DataFrame:
    scored = rows.select("doc_id", is_held_out().alias("held_out"), value.cast("double").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
