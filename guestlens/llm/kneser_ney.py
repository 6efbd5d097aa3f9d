"""Interpolated modified Kneser-Ney models of the characters in words.

A text's symbols are the characters of its words and the end of each word, put
into 64 classes; a symbol's context is the (up to) three symbols before it in
its word. So a 4-gram is a 24-bit number, a model has at most 2 ** 24 entries
per order whatever it was trained on, and the probability of a word depends on
that word alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sized

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm import hashing
from guestlens.llm.common import materialize, slices

ORDER, BITS = 4, 6
CLASSES = 1 << BITS
LEAST_DISCOUNT = 0.1
_FLUSH = 1_000_000  # counts of grams that a counting task holds
_CACHE = 400_000  # words whose probability a scoring task remembers


def _class_table() -> np.ndarray:
    """Class of each code point below 0x3000: 0 ends a word, 1-26 a-z, 27 capitals,
    28 digits, 29-40 single marks, 41 other marks, 42-63 other letters by code point."""
    table = np.empty(0x3000, np.uint8)
    marks = ".,!?-'#*$%&|"
    for code in range(len(table)):
        char = chr(code)
        if "a" <= char <= "z":
            table[code] = code - 96
        elif char.isupper():
            table[code] = 27
        elif char.isdigit():
            table[code] = 28
        elif char in marks:
            table[code] = 29 + marks.index(char)
        elif char.isalpha():
            table[code] = 42 + code % 22
        else:
            table[code] = 41
    table[0] = 0
    return table


_CLASS = _class_table()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each symbol of the words, and the word it stands in."""
    pad = b"\0" * (ORDER - 1)
    joined = pad + b"\n".join(words).replace(b"\0", b"\1").replace(b"\n", pad) + b"\0"
    codes = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    symbols = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], 42 + codes % 22).astype(np.int64)
    key = symbols.copy()
    for back in range(1, ORDER):
        key[back:] |= symbols[:-back] << (BITS * back)
    ends = symbols == 0
    ends[1:] &= symbols[:-1] != 0
    ends[: ORDER - 1] = False
    at = np.flatnonzero((symbols != 0) | ends)
    word = np.cumsum(ends)[at] - ends[at]
    return key[at], word


def _counts(admit: Callable[[bytes, Sized], bool] | None):
    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        # Keys have 24 bits, the times that a word stands in a part of the texts fewer than 39.
        both = np.sort(np.concatenate([key << 39 | times for key, times in held]))
        key, times = both >> 39, both & ((1 << 39) - 1)
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        sums = np.add.reduceat(times, head) if len(head) else times
        return pa.RecordBatch.from_pydict({"key": pa.array(key[head]), "n": pa.array(sums)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text"):
            w = hashing.words(batch.column("text"))
            words, at = hashing.distinct(w)
            if admit is not None:
                texts = zip(batch.column("text").to_pylist(), w.counts.tolist())
                at = at[np.repeat([admit((text or "").encode(), range(n)) for text, n in texts], w.counts)]
            times = np.bincount(at, minlength=len(words))
            key, word = grams(words)
            seen = times[word] > 0
            held.append((key[seen], times[word][seen]))
            size += len(held[-1][0])
            if size > _FLUSH:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def count_grams(
    texts: DataFrame, label: str, admit: Callable[[bytes, Sized], bool] | None = None
) -> DataFrame:
    """(key, n): how often each 4-gram stands in all the texts, or in those that ``admit`` takes."""
    found = texts.select("text").mapInArrow(_counts(admit), "key long, n long")
    return materialize(found.groupBy("key").agg(F.sum("n").alias("n")), label)


def discounts(found: dict[int, int]) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and 3 or more, from how many grams have the counts 1 to 4."""
    n1, n2, n3, n4 = (float(found.get(i, 0)) for i in range(1, 5))
    if not n1 or not n2 or not n3:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    # A discount of zero would leave nothing for unseen grams.
    return tuple(min(max(d, LEAST_DISCOUNT), float(i)) for i, d in enumerate(found, 1))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    return discounts(dict(counts.where("n <= 4").groupBy("n").count().collect()))


def _discount(n: Column, d: tuple[float, float, float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _low(key: str, order: int) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def train(counts: DataFrame, label: str) -> list[tuple[DataFrame, DataFrame]]:
    """From 4-gram counts, per order 1 to 4: (key, p) of seen grams and (context, gamma).

    The highest order uses the counts; each lower one the number of different
    symbols seen before a gram. All tables are joined by key, sharded by Spark.
    An empty table gives empty tables, and so the even distribution.
    """
    levels, level = [], counts.select("key", "n")
    for order in range(ORDER, 0, -1):
        levels.append((order, level))
        level = level.groupBy(_low("key", order - 1).alias("key")).agg(F.count("*").alias("n"))
    model: list[tuple[DataFrame, DataFrame]] = []
    for order, level in reversed(levels):
        level = materialize(level, f"{label}-n{order}")
        d = _discounts(level)
        seen = level.withColumn("context", F.shiftright("key", BITS)).withColumn("_off", F.least(_discount(F.col("n"), d), "n"))
        contexts = seen.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("_off") / F.sum("n")).alias("gamma"))
        joined = seen.join(contexts, "context").withColumn("below", _low("key", order - 1))
        if order == 1:
            lower = F.lit(1.0 / CLASSES)
        else:
            joined = joined.join(model[-1][0].select(F.col("key").alias("below"), F.col("p").alias("q")), "below")
            lower = F.col("q")
        p = (F.col("n") - F.col("_off")) / F.col("total") + F.col("gamma") * lower
        model.append((materialize(joined.select("key", p.alias("p")), f"{label}-p{order}"), contexts.select("context", "gamma")))
    return model


def probabilities(keys: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, p) for any 4-grams: joins with the counts of every order, shard by shard.

    An unseen gram has the weight of its context times the probability without
    the first symbol; an unseen context has weight 1.
    """
    found = keys.select("key").withColumn("p", F.lit(1.0 / CLASSES))
    for order, (seen, contexts) in enumerate(model, 1):
        gram = found.withColumn("_k", _low("key", order)).withColumn("_c", F.shiftright(_low("key", order), BITS))
        gram = gram.join(seen.select(F.col("key").alias("_k"), F.col("p").alias("_p")), "_k", "left")
        gram = gram.join(contexts.select(F.col("context").alias("_c"), "gamma"), "_c", "left")
        found = gram.select("key", F.coalesce("_p", F.coalesce("gamma", F.lit(1.0)) * F.col("p")).alias("p"))
    return found


class HashArrays:
    """A model as arrays sorted by the hash of their keys; at most 2 ** 24 entries each."""

    def __init__(self, model: list[tuple[DataFrame, DataFrame]]) -> None:
        self.orders = []
        for seen, contexts in model:
            self.orders.append((self._sorted(seen.toArrow()), self._sorted(contexts.toArrow())))

    @staticmethod
    def _hash(key: np.ndarray) -> np.ndarray:
        """A bijection of the keys' 32 bits."""
        return (key.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ np.uint32(0x5BD1E995)

    def _sorted(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        key, value = (table.column(i).to_numpy() for i in range(2))
        order = np.argsort(self._hash(key))
        return self._hash(key)[order], value[order].astype(np.float32)

    def _find(self, arrays: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = arrays
        if not len(hashes):
            return np.zeros(len(key), bool), np.zeros(len(key), np.float32)
        wanted = self._hash(key)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return hashes[at] == wanted, values[at]

    def p(self, key: np.ndarray) -> np.ndarray:
        p = np.full(len(key), 1.0 / CLASSES)
        for order, (seen, contexts) in enumerate(self.orders, 1):
            low = key & ((1 << (BITS * order)) - 1)
            known, gamma = self._find(contexts, low >> BITS)
            p *= np.where(known, gamma, 1.0)
            known, own = self._find(seen, low)
            p = np.where(known, own, p)
        return p


class Table:
    """Probabilities of all 4-grams that can be asked for, sorted by key; at most 2 ** 24."""

    def __init__(self, probabilities: DataFrame) -> None:
        table = probabilities.toArrow()
        key, p = (table.column(i).to_numpy() for i in range(2))
        order = np.argsort(key)
        self.key, self.value = key[order].astype(np.int32), p[order].astype(np.float32)

    def p(self, key: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.key, key)]


class Scorer:
    """Natural log probabilities of words, remembered."""

    def __init__(self, model: HashArrays | Table) -> None:
        self.model, self.known = model, {}

    def texts(self, w: hashing.Words) -> np.ndarray:
        """The log probability of each text."""
        if len(self.known) > _CACHE:
            self.known.clear()
        words, at = hashing.distinct(w)
        new = [word for word in words if word not in self.known]
        for a in range(0, len(new), 50_000):
            part = new[a : a + 50_000]
            key, word = grams(part)
            logs = np.bincount(word, np.log(self.model.p(key)), len(part))
            self.known.update(zip(part, logs.tolist()))
        logs = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        return np.bincount(w.text_of(), logs[at], len(w.first) - 1)


def fences(scores: DataFrame, group: str, value: str, reach: float, least: int = 50) -> DataFrame:
    """(group, low, high) from the quartiles of ``value``: ``reach`` spreads beyond them.

    A group of fewer than ``least`` values has the fences of all values. The
    quantile sketches have bounded size.
    """
    sketch = F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.75)), F.lit(20_000)).alias("_q")
    own = scores.groupBy(group).agg(sketch, F.count(value).alias("_n"))
    pooled = scores.agg(sketch).first()[0] or [0.0, 0.0]
    q = [F.when(F.col("_n") >= least, F.col("_q")[i]).otherwise(F.lit(float(pooled[i]))) for i in range(2)]
    return own.select(group, (q[0] - reach * (q[1] - q[0])).alias("low"), (q[1] + reach * (q[1] - q[0])).alias("high"))
