"""Interpolated modified Kneser-Ney models of words, of order 3, whose context crosses lines.

The n-grams of all texts are counted, and each gets its probability from the counts of
every order, all of them in Spark tables that grow with the input: no table of words or
grams is collected. Grams are dealt to cells by their middle word, so that a cell has
whatever stands before or after a pair of words that it has a gram of, and counts in
arrays. A word, and a pair of words, that stands in the texts more often than a cell holds is
spread over several cells, whose counts Spark adds up. Shards of cells take turns on
the disk: a first round counts what all of them have to know, the words, the pairs of spread words
and how many grams have which count, a second scores. A word is a 32-bit hash of its
bytes, so of ten million different words one in four hundred shares its hash with another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm import hashing
from guestlens.llm.common import landed, materialize, slices
from guestlens.llm.kneser_ney import discounts

ORDER = 3
# The texts are dealt to two folds by their hash.
FOLDS = (0, 1)
# The grams of texts of so many bytes are a shard, up to so many shards.
SHARD_BYTES, SHARDS = 1 << 23, 4
# A cell has the grams of about so many bytes of text; a word of so many bytes, its space included, is usual.
CELL_BYTES, WORD_BYTES = 1 << 22, 6
# Words that a task deals to cells at once.
_CHUNK = 1 << 20
# Frequent words are looked for in this share of the texts, or in so many bytes of them if that is more. They
# decide which cell counts a gram and nothing else.
_LOOK, _LOOK_BYTES = 1 / 16, 1 << 26
# Negative log probabilities are added up in such parts, as whole numbers, so their order does not count.
PARTS = 1_000_000

_COUNTED = (
    "cell int, w1 int, w2 int, n0 int, n1 int, word int, u0 int, u1 int, sums array<long>, contexts array<long>"
)
_N = [f"n{k}" for k in FOLDS]


def ids(w: hashing.Words) -> np.ndarray:
    """A number of each word, never 0."""
    found = (hashing.word_hashes(w) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return np.where(found == 0, np.int32(1), found)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two words as one number."""
    return (a.view(np.uint32).astype(np.uint64) << np.uint64(32)) | b.view(np.uint32)


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the numbers are among the ``known`` sorted ones, and where."""
    if not len(known):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked, at


@dataclass
class _Deal:
    """Which cell counts a gram. Spread words and pairs of words are sorted, with the number of their parts."""

    cells: int
    shards: int
    words: np.ndarray
    word_parts: np.ndarray
    pairs: np.ndarray
    pair_parts: np.ndarray

    def cell(self, gram: list[np.ndarray]) -> np.ndarray:
        key = gram[1].view(np.uint32).astype(np.uint64)
        at = np.flatnonzero(_find(self.words, gram[1])[0])
        if len(at):
            # Grams with the same first two words stay together, but for spread pairs.
            w0, w1, w2 = (w[at] for w in gram)
            parts = self.word_parts[_find(self.words, w1)[1]]
            own = hashing.mix(_pair(w1, (hashing.mix(w0.view(np.uint32).astype(np.uint64)) % parts).astype(np.int32)))
            known, which = _find(self.pairs, _pair(w0, w1))
            if known.any():
                part = hashing.mix(w2[known].view(np.uint32).astype(np.uint64)) % self.pair_parts[which[known]]
                own[known] = hashing.mix(_pair(w0, w1)[known]) + part
            key[at] = own
        return (hashing.mix(key + np.uint64(1)) % np.uint64(self.cells)).astype(np.int32)


def _chunks(batches: Iterator[pa.RecordBatch], kept: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]]:
    """The grams that end at the words of many texts, the text each stands in, and the columns ``kept`` of the texts."""

    def joined() -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
        word, counts, *names = (np.concatenate(part) for part in zip(*held))
        text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        gram = []
        for back in reversed(range(ORDER)):
            before = np.zeros(len(word), np.int32)
            before[back:] = word[: len(word) - back]
            gram.append(np.where(place >= back, before, np.int32(0)))
        return gram, text, names

    held, size = [], 0
    for batch in slices(batches, "text"):
        w = hashing.words(batch.column("text"))
        held.append((ids(w), w.counts, *(batch.column(c).to_numpy(zero_copy_only=False) for c in kept)))
        size += len(w.starts)
        if size >= _CHUNK:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def _frequent(share: float):
    """Words in the middle of grams (w0 null), and first two words of grams, that make up a quarter of ``share`` of a chunk or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, text, _ in _chunks(batches, []):
            middle = gram[1].view(np.uint32).astype(np.uint64)
            for pairs, own in ((False, middle), (True, _pair(gram[0], gram[1]))):
                key, n = np.unique(own, return_counts=True)
                often = n * 4 >= share * len(text)
                w1 = key[often].astype(np.uint32).view(np.int32)
                w0 = (key[often] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"w0": pa.array(w0, mask=np.full(len(w0), not pairs)), "w1": pa.array(w1), "n": pa.array(n[often].astype(np.int64))}
                )

    return run


def _deal(rows: DataFrame) -> _Deal:
    """The number of cells grows with the texts; spread words and pairs are fewer than four times the cells."""
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(SHARDS, 1 + size // SHARD_BYTES)
    cells = shards * (1 + size // shards // CELL_BYTES)
    most, look = max(1, CELL_BYTES // WORD_BYTES), min(1.0, max(_LOOK, _LOOK_BYTES / max(size, 1)))
    words: dict[int, int] = {}
    pairs: dict[int, int] = {}
    if size > CELL_BYTES:
        looked = rows.select("text") if look == 1 else rows.select("text").sample(look, seed=1)
        found = looked.mapInArrow(_frequent(most * WORD_BYTES / size), "w0 int, w1 int, n long").groupBy("w0", "w1").agg(F.sum("n").alias("n"))
        for w0, w1, n in found.where(F.col("n") >= most * look).collect():
            parts = 2 + int(2 * n / look / most)
            if w0 is None:
                words[w1] = parts
            else:
                pairs[(w0 & 0xFFFFFFFF) << 32 | w1 & 0xFFFFFFFF] = parts
                words.setdefault(w1, 2)
    of_words, of_pairs = (np.array(sorted(spread.items()), kind).reshape(-1, 2) for spread, kind in ((words, np.int64), (pairs, np.uint64)))
    return _Deal(cells, shards, of_words[:, 0].astype(np.int32), of_words[:, 1].astype(np.uint64), of_pairs[:, 0], of_pairs[:, 1])


def _places(deal: _Deal, shard: int, named: bool):
    """Per cell of the shard, and chunk, the grams, and which texts they stand in or, unless ``named``, which folds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for gram, text, (names, folds) in _chunks(batches, ["text_hash", "_fold"]):
            if not named:
                text, names = folds[text] + 1, np.arange(-1, len(FOLDS))
                folds = names
            cell = deal.cell(gram)
            own = np.flatnonzero(cell % deal.shards == shard)
            order = own[np.argsort(cell[own].astype(np.int64) * len(names) + text[own], kind="stable")]
            cell, text, gram = cell[order], text[order], np.stack([w[order] for w in gram])
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)] if len(cell) else [0]
            out: dict[str, list] = {"cell": [], "grams": [], "texts": []}
            for a, b in zip(cuts, cuts[1:]):
                heads = np.flatnonzero(np.concatenate([[True], text[a + 1 : b] != text[a : b - 1]]))
                which, n = text[a:b][heads], np.diff(np.append(heads, b - a))
                out["cell"].append(cell[a])
                out["grams"].append(packer.compress(gram[:, a:b].tobytes()))
                texts = names[which].astype(np.int64).tobytes() + n.astype(np.int32).tobytes() + folds[which].astype(np.int8).tobytes()
                out["texts"].append(packer.compress(texts))
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(out["cell"], pa.int32()), "grams": pa.array(out["grams"], pa.binary()), "texts": pa.array(out["texts"], pa.binary())}
            )

    return run


def _dealt(rows: DataFrame, deal: _Deal, shard: int, named: bool) -> DataFrame:
    return rows.select("text_hash", "_fold", "text").mapInArrow(_places(deal, shard, named), "cell int, grams binary, texts binary")


class _Cell:
    """The different grams of a cell in order of their middle, last and first word, and their counts in each fold."""

    def __init__(self, table: pa.Table, deal: _Deal) -> None:
        unpack, gram, texts = zstandard.ZstdDecompressor().decompress, [], []
        for row in table.column("grams"):
            gram.append(np.frombuffer(unpack(row.as_py()), np.int32).reshape(ORDER, -1))
        for row in table.column("texts"):
            data = unpack(row.as_py())
            n = len(data) // 13
            texts.append([np.frombuffer(data, kind, n, at * n) for kind, at in ((np.int64, 0), (np.int32, 8), (np.int8, 12))])
        self.names, self.times, folds = (np.concatenate(part) for part in zip(*texts))
        coded = [pa.array(w).dictionary_encode() for w in np.concatenate(gram, axis=1)]
        self.values = [c.dictionary.to_numpy() for c in coded]
        w0, w1, w2 = (c.indices.to_numpy() for c in coded)
        bits = [len(v).bit_length() for v in self.values]
        if sum(bits) <= 63:
            key = (w1.astype(np.int64) << (bits[2] + bits[0])) | (w2.astype(np.int64) << bits[0]) | w0
            self.order = np.argsort(key)
        else:
            self.order = np.lexsort((w0, w2, w1))
        w0, w1, w2 = w0[self.order], w1[self.order], w2[self.order]
        pair = np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])])
        head = pair.copy()
        head[1:] |= w0[1:] != w0[:-1]
        self.gram_of = np.cumsum(head) - 1  # of each place in order
        fold = np.repeat(folds, self.times)[self.order]
        self.w0, self.w1, self.w2, pair = w0[head], w1[head], w2[head], pair[head]
        self.n = [np.bincount(self.gram_of[fold == k], minlength=len(pair)) for k in FOLDS]
        # Different words before each pair.
        self.pair_of, self.pairs = np.cumsum(pair) - 1, np.flatnonzero(pair)
        self.before = [np.bincount(self.pair_of[n > 0], minlength=len(self.pairs)) for n in self.n]
        self.spread = _find(deal.words, self.values[1])[0]  # of each middle word
        contexts = pa.array(self.w1.astype(np.int64) << 32 | self.w0).dictionary_encode()
        self.context_of, context = contexts.indices.to_numpy(), contexts.dictionary.to_numpy()
        # The pairs that begin grams, as numbers, and what is known of them here.
        self.context = _pair(self.values[0][context & 0xFFFFFFFF], self.values[1][context >> 32])
        self.sums = [_sums_of(self.context_of, n, len(context)) for n in self.n]


def _sums_of(group: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """Of a context: all counts, and how many grams have the counts 1, 2 and more."""
    some = [np.bincount(group[own], minlength=size) for own in (n == 1, n == 2, n > 2)]
    return [np.bincount(group, n, size).astype(np.int64), *some]


def _only(values: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """The values at their places, null elsewhere."""
    out, none = np.zeros(size, np.int32), np.ones(size, bool)
    out[at], none[at] = values, False
    return pa.array(out, mask=none)


def _count(deal: _Deal):
    """A row per different gram of a cell. What the cell learned of a pair of a spread word, and of a last
    word, stands in the row of its first gram; sums over the cell stand in its first row."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        c = _Cell(table, deal)
        size, spread = len(c.w1), c.spread[c.w1[c.pairs]]
        at, plain = c.pairs[spread], c.pairs[~spread]
        first = np.zeros(len(c.values[2]), np.int64)
        first[c.w2[::-1]] = np.arange(size)[::-1]
        out = {"cell": pa.array(np.full(size, key[0].as_py(), np.int32)), "w1": _only(c.values[1][c.w1[at]], at, size), "w2": _only(c.values[2][c.w2[at]], at, size)}
        out |= {f"n{k}": _only(c.before[k][spread], at, size) for k in FOLDS}
        out["word"] = _only(c.values[2], first, size)
        for k in FOLDS:
            own = plain[c.before[k][~spread] > 0]
            out[f"u{k}"] = _only(np.bincount(c.w2[own], minlength=len(first)), first, size)
        sums = [np.sum(n == i) for n in c.n for i in range(1, 5)] + [np.sum(n[~spread] == i) for n in c.before for i in range(1, 5)]
        known, which = _find(deal.pairs, c.context)
        contexts = np.stack([which, *c.sums[0], *c.sums[1]])[:, known].T.ravel()
        for name, values in (("sums", np.array(sums)), ("contexts", contexts)):
            row = pa.array([values.tolist()] + [None] * (size - 1), pa.list_(pa.int64()))
            out[name] = row
        return pa.table(out)

    return run


def _counts_of_counts(order: int) -> list[Column]:
    return [F.count_if(F.col(f"n{k}") == i).alias(f"c{order}_{k}_{i}") for k in FOLDS for i in range(1, 5)]


def _sums() -> list[Column]:
    """Of a context: all counts, and how many grams have the counts 1, 2 and more; whole numbers, so the order of rows does not count."""
    out = []
    for k in FOLDS:
        n = F.col(f"n{k}")
        out += [F.sum(n).alias(f"total{k}"), F.count_if(n == 1).alias(f"one{k}"), F.count_if(n == 2).alias(f"two{k}"), F.count_if(n > 2).alias(f"more{k}")]
    return out


@dataclass
class _Learned:
    """What all cells have to know; all but the tables is bounded by the number of cells."""

    grams: list[DataFrame]  # of each shard
    pairs: DataFrame  # w1, w2, n0, n1 of spread words
    words: DataFrame  # word, n0, n1
    d: list[list[tuple[float, float, float]]]  # discounts by order less 1, and fold
    contexts: np.ndarray  # sums of each spread pair as a context
    middles: np.ndarray  # sums of each spread word as a context


def _learn(marked: DataFrame, deal: _Deal) -> _Learned:
    grams = [
        materialize(_dealt(marked, deal, shard, False).groupBy("cell").applyInArrow(_count(deal), _COUNTED), "shard-grams")
        for shard in range(deal.shards)
    ]
    known = reduce(DataFrame.unionAll, grams)
    pairs = known.where("w1 IS NOT NULL").groupBy("w1", "w2").agg(*[F.sum(n).alias(n) for n in _N])
    pairs = materialize(pairs, "spread-pairs")
    words = known.where("word IS NOT NULL").select("word", *[F.col(f"u{k}").cast("long").alias(f"n{k}") for k in FOLDS])
    words = words.unionAll(pairs.select("w2", *[(F.col(n) > 0).cast("long") for n in _N]))
    words = materialize(words.groupBy("word").agg(*[F.sum(n).alias(n) for n in _N]), "words")

    firsts = known.where("sums IS NOT NULL")
    sums = np.array(firsts.agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(16)]).first()).reshape(2, 2, 4)
    of_words, of_pairs = (np.array(table.agg(*_counts_of_counts(0)).first()).reshape(2, 4) for table in (words, pairs))
    d = [[discounts(dict(enumerate(n.tolist(), 1))) for n in order] for order in (of_words, sums[1] + of_pairs, sums[0])]

    contexts, middles = np.zeros((len(deal.pairs), 8), np.int64), np.zeros((len(deal.words), 8), np.int64)
    for (row,) in firsts.where(F.size("contexts") > 0).select("contexts").collect():
        row = np.array(row).reshape(-1, 9)
        contexts[row[:, 0]] += row[:, 1:]
    for w1, *row in pairs.groupBy("w1").agg(*_sums()).collect():
        middles[np.searchsorted(deal.words, np.int32(w1))] = row
    return _Learned(grams, pairs, words, d, contexts, middles)


def _probabilities(d: list) -> list[Column]:
    """The probability ``p`` in each fold from the count, the sums of the context and the probability ``q`` without the first word."""
    out = []
    for k in FOLDS:
        n, total, q = F.col(f"n{k}"), F.col(f"total{k}"), F.col(f"q{k}")
        off = F.when(n == 0, 0.0).when(n == 1, d[k][0]).when(n == 2, d[k][1]).otherwise(d[k][2])
        mass = F.col(f"one{k}") * d[k][0] + F.col(f"two{k}") * d[k][1] + F.col(f"more{k}") * d[k][2]
        out.append(F.when(total > 0, (n - off + mass * q) / total).otherwise(q).cast("float").alias(f"p{k}"))
    return out


def _probability(n: np.ndarray, sums: list[np.ndarray], q: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """The same in a cell, in one fold."""
    total, one, two, more = sums
    off = np.array([0.0, *d])[np.minimum(n, 3)]
    with np.errstate(divide="ignore", invalid="ignore"):
        p = (n - off + (one * d[0] + two * d[1] + more * d[2]) * q) / total
    return np.where(total > 0, p, q).astype(np.float32)


def _of_words(words: DataFrame, d: list) -> DataFrame:
    """(word, p0, p1) of every word; below is the even distribution over the learned words and one more."""
    totals = words.agg(*_sums())
    for k in FOLDS:
        totals = totals.withColumn(f"q{k}", 1 / (F.col(f"one{k}") + F.col(f"two{k}") + F.col(f"more{k}") + 1))
    return words.crossJoin(F.broadcast(totals)).select("word", *_probabilities(d))


def _score(deal: _Deal, learned: _Learned):
    """(text_hash, parts, n): the parts of negative log probabilities that a cell's grams add to a text, and their number.

    The highest order uses the counts; the one below the number of different
    words seen before a gram. A gram not learned has the weight of its context
    times the probability without the first word; a context not learned has weight 1.
    """
    d, contexts, middles = learned.d, learned.contexts, learned.middles

    def run(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        c = _Cell(table, deal)
        of_pair, middle, last, x0, x1 = (known.column(name).to_numpy() for name in ("pair", "w1", "w2", "x0", "x1"))
        order = np.argsort(last[~of_pair])
        at = order[np.searchsorted(last[~of_pair], c.values[2], sorter=order)]
        # Spread words: their pairs, and what follows them, were counted in other cells too.
        whole = _pair(middle[of_pair], last[of_pair])
        by_pair = np.argsort(whole)
        spread = c.spread[c.w1[c.pairs]]
        asked = _pair(c.values[1][c.w1[c.pairs[spread]]], c.values[2][c.w2[c.pairs[spread]]])
        found = by_pair[np.searchsorted(whole, asked, sorter=by_pair)]
        word = c.w1[c.pairs]
        which = _find(deal.words, c.values[1])[1]
        hot, place = _find(deal.pairs, c.context)
        parts = []
        for k, x in zip(FOLDS, (x0, x1)):
            before = c.before[k].copy()
            before[spread] = x[of_pair][found]
            sums = _sums_of(word, before, len(c.values[1]))
            below = []
            for i, own in enumerate(sums):
                own[c.spread] = middles[which[c.spread], 4 * k + i]
                below.append(own[word])
            q = _probability(before, below, x[~of_pair][at][c.w2[c.pairs]], d[1][k])
            for i, own in enumerate(c.sums[k]):
                own[hot] = contexts[place[hot], 4 * k + i]
            p = _probability(c.n[k], [own[c.context_of] for own in c.sums[k]], q[c.pair_of], d[2][k])
            parts.append(np.floor(-np.log(p.astype(np.float64)) * PARTS + 0.5).astype(np.int64))
        names, text = np.unique(c.names, return_inverse=True)
        text = np.repeat(text, c.times)[c.order]
        # A text is scored by the model of the other fold.
        own = np.where(names[text] % len(FOLDS) == 0, parts[1][c.gram_of], parts[0][c.gram_of])
        total = np.bincount(text, own, len(names)).astype(np.int64)
        return pa.table({"text_hash": names, "parts": total, "n": np.bincount(text, minlength=len(names)).astype(np.int64)})

    return run


def _scored(marked: DataFrame, deal: _Deal, learned: _Learned, words: DataFrame, shard: int) -> DataFrame:
    """(text_hash, parts, n) of the texts by the grams of a shard.

    Words and pairs grow with the texts and are many times their files' size in memory, so neither is broadcast.
    """
    grams = learned.grams[shard]
    asked = grams.where("word IS NOT NULL").select("cell", "word").join(words.hint("merge"), "word")
    known = asked.select("cell", F.lit(False).alias("pair"), F.lit(0).alias("w1"), F.col("word").alias("w2"), *[F.col(f"p{k}").cast("double").alias(f"x{k}") for k in FOLDS])
    asked = grams.where("w1 IS NOT NULL").select("cell", "w1", "w2").join(learned.pairs.hint("merge"), ["w1", "w2"])
    known = known.unionAll(asked.select("cell", F.lit(True), "w1", "w2", *[F.col(n).cast("double") for n in _N]))
    placed = _dealt(marked, deal, shard, True).groupBy("cell")
    scored = placed.cogroup(known.groupBy("cell")).applyInArrow(_score(deal, learned), "text_hash long, parts long, n long")
    return scored.groupBy("text_hash").agg(F.sum("parts").alias("parts"), F.sum("n").alias("n"))


def perplexities(rows: DataFrame, known: Column, label: str) -> DataFrame:
    """(text_hash, word_log_perplexity) of every different text with words: the mean over its words.

    The ``known`` texts are learned from. ``rows`` has ``text`` and ``text_hash``, a hash that deals the
    texts to two folds; each is scored by the model of the other fold, so that none, nor a copy of it,
    is judged by what was learned from itself. Null and empty texts have no row.
    """
    spark = rows.sparkSession
    fold = F.pmod("text_hash", F.lit(len(FOLDS)))
    marked = rows.withColumn("_fold", F.when(known, fold).otherwise(F.lit(-1)).cast("long"))

    def make() -> DataFrame:
        deal = _deal(rows)
        learned = _learn(marked, deal)
        words = materialize(_of_words(learned.words, learned.d[0]), "word-p")
        parts = [landed(spark, "shard-scores", lambda: _scored(marked, deal, learned, words, shard)) for shard in range(deal.shards)]
        found = reduce(DataFrame.unionAll, parts).groupBy("text_hash")
        return found.agg((F.sum("parts") / F.sum("n") / PARTS).alias("word_log_perplexity"))

    return landed(spark, f"{label}-perplexities", make)
