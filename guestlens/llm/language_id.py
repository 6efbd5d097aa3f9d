"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm.common import join_small, landed, materialize, slices, utf8

# Byte n-grams of these lengths within and across words; buckets that they are hashed to.
ORDERS, BITS = (1, 2, 3), 13
BUCKETS = 1 << BITS
# Centroids per language, turns of their clustering, and the number of labelled
# documents of a language that it sees, about (chosen by a hash): all if there
# are fewer. Document frequencies cover all labelled documents.
CENTROIDS, TURNS, SAMPLE_DOCS = 4, 12, 1000
# A document is rejected where it is farther from its centroid than so many
# times this quantile of the centroid's own documents.
QUANTILE, REACH = 0.99, 1.2
UNKNOWN = "und"
_ODD = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
# Bytes that stand in no letter are spaces; bytes of other letters than a-z stay.
_SYMBOL = np.full(256, 0x20, np.uint8)
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[128:] = np.arange(128, 256)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def gram_counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text how often each bucket's n-grams stand in it; a text begins and ends with a space."""
    data, offsets = utf8(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        symbols = np.full(b - a + 2, 0x20, np.uint32)
        symbols[1:-1] = _SYMBOL[data[a:b]]
        # Runs of spaces are one.
        gap = symbols == 0x20
        symbols = symbols[~(gap & np.concatenate([[False], gap[:-1]]))]
        counts = np.zeros(BUCKETS, np.int64)
        for n in ORDERS:
            if len(symbols) >= n:
                gram = symbols[: len(symbols) - n + 1].copy()
                for k in range(1, n):
                    gram = gram << np.uint32(8) | symbols[k : len(symbols) - n + 1 + k]
                bucket = ((gram + np.uint32(n)) * _ODD[n - 1]) >> np.uint32(32 - BITS)
                counts += np.bincount(bucket, minlength=BUCKETS)
        yield counts


def vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors, a row per text."""
    rows = np.array([np.log1p(c) for c in gram_counts(column)], np.float32).reshape(len(column), BUCKETS) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the task each bucket occurs."""
    seen = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches, "text"):
        for counts in gram_counts(batch.column("text")):
            seen += counts > 0
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.flatnonzero(seen).astype(np.int32)), "n": pa.array(seen[seen > 0])})


def _sampled(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 18):
            found = vectors(batch.column("text"), idf)
            ends = np.arange(len(found) + 1, dtype=np.int32) * BUCKETS * 4
            packed = pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "place": batch.column("place"), "vector": packed})

    return run


def cluster(points: np.ndarray, most: int = CENTROIDS, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit vectors by cosine, and the distance that ``QUANTILE`` of each one's points keep.

    Starts from the point nearest to the mean and then from points far from all
    chosen ones, so equal points always give equal centroids.
    """
    most = min(most, len(points))
    chosen = [int(np.argmax(points @ points.mean(0)))]
    nearest = points @ points[chosen[0]]
    for _ in range(1, most):
        # Half way to the farthest point, as that one may be junk.
        chosen.append(int(np.argsort(nearest, kind="stable")[len(points) // 8]))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centroids = points[chosen].copy()
    own = None
    for _ in range(turns):
        found = np.argmax(points @ centroids.T, axis=1)
        if own is not None and (found == own).all():
            break
        own = found
        for k in range(most):
            if (own == k).any():
                centroids[k] = points[own == k].mean(0)
                centroids[k] /= max(np.linalg.norm(centroids[k]), 1e-12)
    distance = 1 - points @ centroids.T
    own = np.argmin(distance, axis=1)
    radius = [np.quantile(distance[own == k, k], QUANTILE) if (own == k).any() else 0.0 for k in range(most)]
    return centroids, np.array(radius)


def _centroids(table: pa.Table) -> pa.Table:
    """The centroids of one language from its sample."""
    table = table.sort_by("place")
    points = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float32).reshape(-1, BUCKETS)
    centroids, radius = cluster(points)
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * len(radius), pa.string()),
        "radius": pa.array(radius, pa.float64()),
        "centroid": pa.array([c.tobytes() for c in centroids], pa.binary()),
    })


class Model:
    """Weights of the buckets, and centroids with their languages; 32 KB per centroid."""

    def __init__(self, idf: np.ndarray, langs: list[str], radius: np.ndarray, centroids: np.ndarray) -> None:
        self.idf, self.langs, self.radius, self.centroids = idf, langs, radius, centroids

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per text the language of the nearest centroid, its cosine, and whether it is too far away."""
        cosine = np.clip(vectors(column, self.idf) @ self.centroids.T, 0, 1)
        best = cosine.argmax(1)
        score = cosine[np.arange(len(best)), best].astype(np.float64)
        return [self.langs[k] for k in best], score, 1 - score > REACH * self.radius[best]


def fit(docs: DataFrame) -> Model | None:
    """Learn from text and lang of ``docs`` (doc_id, text, lang, none null); None without rows.

    All documents count for the weights of the n-grams. About ``SAMPLE_DOCS`` of
    each language, by a hash of text and id, are clustered; a language's sample
    is one task's. Only weights and centroids, whose size the
    number of languages decides, reach the driver.
    """
    docs = docs.select("doc_id", "text", "lang")
    per_lang = materialize(docs.groupBy("lang").agg(F.count("*").alias("_n")), "languages")
    total = per_lang.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    found = docs.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    seen = np.zeros(BUCKETS)
    seen[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)

    place = F.xxhash64("text", "doc_id")
    share = F.pmod(place, F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(float(SAMPLE_DOCS)) / F.col("_n")) * (1 << 30)
    sample = join_small(docs.withColumn("place", place), per_lang, ["lang"], "inner", F.col("place")).where(share)
    sample = materialize(sample.select("lang", "place", "text"), "language-sample")
    packed = sample.mapInArrow(_sampled(idf), "lang string, place long, vector binary")
    table = packed.groupBy("lang").applyInArrow(_centroids, "lang string, radius double, centroid binary").toArrow()
    if not table.num_rows:
        return None
    table = table.sort_by([("lang", "ascending"), ("centroid", "ascending")])
    centroids = np.frombuffer(b"".join(table.column("centroid").to_pylist()), np.float32).reshape(-1, BUCKETS)
    return Model(idf, table.column("lang").to_pylist(), table.column("radius").to_numpy(), centroids)


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            if model is None:
                langs, score, far = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            else:
                langs, score, far = model.predict(batch.column("text"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "has_letter": batch.column("has_letter"),
                "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(score, pa.float64()),
                "rejected": pa.array(far, pa.bool_()),
            })

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every document, from its text alone."""
    text = F.lower("text").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)).alias("has_letter"))
    schema = "doc_id long, has_letter boolean, lang_pred string, score double, rejected boolean"
    found = rows.mapInArrow(_predict(model), schema)
    known = F.col("has_letter")
    return found.select(
        "doc_id",
        F.when(known, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        (~known | F.col("rejected")).alias("rejected"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document.

    Learns from the documents that are not held out and have text and lang. The
    score is the cosine to the nearest centroid; ``rejected`` marks texts too far
    from it to be of its language, and those without one. A null text, or one
    without a letter, is ``und`` with score 0; so is every text if nothing could
    be learned. A null doc_id is not held out. Repeated rows are judged alike
    (and learned from each). Other columns, whatever their names, are not looked
    at. An empty table gives an empty result.
    """
    learn = docs.where(~is_held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    learn = learn.select("doc_id", F.lower("text").alias("text"), "lang").where(F.rlike("text", F.lit(r"\p{L}")))

    def make() -> DataFrame:
        found = predict(docs, fit(learn))
        return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "rejected")

    return landed(docs.sparkSession, "languages", make)
