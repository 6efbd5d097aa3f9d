"""Spelling variants of words: blocked Gram matrices of letter counts, then exact edits."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.common import landed, materialize, slices

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
# One run in so many has a letter deleted.
NOISE = 31
# Words in a Gram matrix: small blocks share one, blocks of more words than that are cut into chunks.
TILE = 1024
_FLUSH = 200_000  # distinct words that a counting task holds
_RUN = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LETTERS = 26 + 64
_LATIN = 0xC0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to partial counts of their words.

    Runs shorter than a word give none, deleted letter or not, so they are not
    matched. A run has one fate in a document, so each is hashed once there.
    """

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
        seen.clear()
        return rows

    seen: dict[str, int] = {}
    for batch in slices(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
                h = zlib.crc32(run.encode(), start)
                if h % NOISE == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST_LENGTH:
                        continue
                seen[run] = seen.get(run, 0) + n
            if len(seen) >= _FLUSH:
                yield flush()
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all documents with how often they occur, two times at least."""
    partial = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count_words, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def is_one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced character makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = len(os.path.commonprefix([a, b]))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each letter occurs in each word, a row per word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(codes < _LATIN, codes - ord("a"), codes - _LATIN + 26)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * _LETTERS + letter, minlength=len(words) * _LETTERS).reshape(len(words), _LETTERS).astype(np.float32)


def blocks(words: DataFrame, tile_rows: int = TILE) -> DataFrame:
    """(tile, base, last, lo, hi, chunk, word, n): the words of each block that may be near.

    Near words have equal lengths, or lengths that follow one another; ``base``
    is the smaller. One edit leaves their first base // 2 letters alone, or else
    their last ones (``last``). So words meet by length and half. A block
    of more words than a tile is cut into chunks by a hash, and each two chunks
    make a tile, so none has many more than twice ``tile_rows``.
    """
    length, base = F.length("word"), F.col("base")
    bases = F.filter(F.array(length, length - 1), lambda b: b >= LEAST_LENGTH)
    rows = words.select("word", "n", F.explode(bases).alias("base"))
    rows = rows.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("last"))
    half = F.floor(base / 2).cast("int")
    part = F.when(F.col("last"), F.right("word", base - half)).otherwise(F.left("word", half))
    rows = materialize(rows.withColumn("part", part), "word-blocks")
    keys = ["base", "last", "part"]
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("chunks"), F.count("*").alias("_m"))
    met = rows.join(sizes.where("_m > 1").drop("_m"), keys)
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    met = met.select(*keys, "word", "n", chunk.alias("chunk"), other.alias("_other"))
    lo, hi = F.least("chunk", "_other"), F.greatest("chunk", "_other")
    return met.select(F.xxhash64(*keys, lo, hi).alias("tile"), "base", "last", lo.alias("lo"), hi.alias("hi"), "chunk", "word", "n")


def _pairs(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Places of near words in some whole tiles.

    One matrix product of the words' letter counts gives their squared
    distances; words at most two apart in one tile are compared letter by letter.
    """
    words = table.column("word").to_pylist()
    tile, chunk, base, last, lo, hi = (
        table.column(c).to_numpy() for c in ("tile", "chunk", "base", "last", "lo", "hi")
    )
    counts = letter_counts(words)
    norm = (counts * counts).sum(1)
    close = norm[:, None] + norm[None, :] - 2 * (counts @ counts.T) <= 2
    close &= tile[:, None] == tile[None, :]
    i, j = np.nonzero(np.triu(close, 1))
    # The tile's number is a hash, so what it stands for is compared as well.
    same = (base[i] == base[j]) & (last[i] == last[j]) & (lo[i] == lo[j]) & (hi[i] == hi[j])
    same &= (lo[i] == hi[i]) | (chunk[i] != chunk[j])
    for i, j in zip(i[same].tolist(), j[same].tolist()):
        a, b, n = words[i], words[j], int(base[i])
        # Two words of the greater length meet in the block of their own length.
        if len(a) + len(b) > 2 * n + 1:
            continue
        half = n // 2
        heads = a[:half] == b[:half]
        met = a[len(a) - n + half :] == b[len(b) - n + half :] and not heads if last[i] else heads
        if met and is_one_edit(a, b):
            yield i, j


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile to the near words in them, in both directions."""

    def solved(table: pa.Table) -> pa.RecordBatch:
        words, n = table.column("word"), table.column("n")
        i, j = np.array(list(_pairs(table)), np.int64).reshape(-1, 2).T
        a, b = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        columns = [words.take(a), words.take(b), n.take(b)]
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in columns], names=["word", "near", "near_n"])

    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if rest.num_rows < 4 * TILE:
            continue
        *whole, rest = _whole_tiles(rest)
        for part in whole:
            yield solved(part)
    if rest is not None and rest.num_rows:
        for part in _whole_tiles(rest):
            yield solved(part)


def _whole_tiles(table: pa.Table) -> Iterator[pa.Table]:
    """Parts of about ``TILE`` rows that cut no tile; a greater tile is a part of its own."""
    tile = table.column("tile").to_numpy()
    ends = np.concatenate([np.flatnonzero(tile[1:] != tile[:-1]) + 1, [len(tile)]])
    a = 0
    while a < len(tile):
        at = max(np.searchsorted(ends, a + TILE, "right") - 1, np.searchsorted(ends, a, "right"))
        yield table.slice(a, int(ends[at]) - a)
        a = int(ends[at])


def near_words(words: DataFrame, tile_rows: int = TILE) -> DataFrame:
    """(word, near, near_n): each two words that one edit makes each other, in both directions, once."""
    tiles = blocks(words, tile_rows)
    ordered = tiles.repartition(F.col("tile")).sortWithinPartitions("tile")
    return ordered.mapInArrow(_near, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) ends, for every word that has a form.

    Each turn doubles the steps that a word has gone. A form is ten times as
    frequent as its word, so few turns do.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        further = materialize(links.join(up, "root", "left"), "roots")
        links = further.select("word", F.coalesce("_up", "root").alias("root"))
        if further.where("_up IS NOT NULL").isEmpty():
            return links


def spelling_variants(docs: DataFrame, tile_rows: int = TILE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the documents.

    Words are maximal runs of Latin letters, A-Z as a-z; of one run in 31, by a
    hash of id and run, a letter is deleted. They have seven letters and two
    occurrences at least. ``form`` is the most frequent of the words that one
    edit away, the first in code-point order of equals, if it is at least ten
    times as frequent as the word; ``root`` is where forms lead.

    Null and empty texts have no words; a null doc_id hashes as an empty one.
    Repeated rows count each. Other columns, whatever their names, are not
    looked at. An empty table gives an empty result. Counting is by partial
    sums, and no task holds more than a few tiles of words, so neither frequent words nor
    letters that many words begin or end with meet in one place.
    """

    def make() -> DataFrame:
        words = materialize(word_counts(docs), "words")
        best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("_best")
        near = near_words(words, tile_rows).groupBy("word").agg(F.count("*").alias("n_near"), best)
        joined = words.join(near, "word", "left").withColumn("form_n", -F.col("_best.n"))
        is_form = F.col("form_n") >= TIMES * F.col("n")
        joined = joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("_best.near")).alias("form"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        )
        joined = materialize(joined, "word-forms")
        found = joined.join(roots(joined.where("form IS NOT NULL")), "word", "left")
        return found.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

    return landed(docs.sparkSession, "spelling", make)
