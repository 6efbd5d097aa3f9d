"""Token ids of documents in files of independent zstandard frames.

A file holds one frame per document (several for a very long one), then a
skippable frame with the documents' index, then a skippable frame with the
seek table of the public zstandard seekable format: compressed and decompressed
size of every frame and the low 32 bits of the XXH64 of its content. A plain
zstandard decoder reads the ids; a reader that knows the table fetches and
decompresses only the frames of the documents that it is asked for.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm.common import materialize, new_path, slices

# Fixed values of the public seekable format.
SKIPPABLE, INDEX, FOOTER = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
END_ID = 2
FRAME_IDS = 1 << 20  # ids in one frame at most
WORDS, CACHE = 600_000, 400_000  # words and pieces whose ids a worker remembers
# How the vocabulary prepares and cuts a text. The fast path below does the same, so it
# is taken for such vocabularies only.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ],
}
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# What the fast path may cut itself: printable ASCII and accented Latin letters, which are normal as
# they stand, and plain white space. The pattern is the vocabulary's own for such texts in lower case.
_PLAIN = re.compile(r"[ \t\n\x0b\x0c\r!-~À-ÖØ-öø-įı-ž]+")
_PIECE = re.compile(r"[a-zß-öø-ž]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-z0-9ß-öø-ž]+")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, remembered by word and piece.

    A vocabulary that drops white space and never joins across it gives a text
    the ids of its words, and a word those of its pieces. Words with other characters than
    printable ASCII and Latin letters, or with special tokens, go through the
    library as a whole. So do texts with control characters that Python and the
    library class differently, and all texts of a vocabulary that prepares or
    cuts texts in another way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        made = json.loads(self.tokenizer.to_str())
        self.is_known = (made["normalizer"], made["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER)
        # The vocabulary spells letters beyond ASCII by their bytes.
        letters = [chr(c) for c in range(0xC0, 0x17F) if self.is_known and _PLAIN.fullmatch(chr(c))]
        self.spelled = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        tokenize = self.tokenizer.model.tokenize
        found = tokenize(piece if piece.isascii() else piece.translate(self.spelled))
        ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        if len(piece) <= 64:
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _word(self, word: str, plain: bool) -> bytes:
        if plain or self._is_plain(word):
            ids = b"".join([self.pieces.get(p) or self._piece(p) for p in _PIECE.findall(word.lower())])
        else:
            ids = self._whole(word)
        if len(word) <= 64:
            if len(self.words) >= WORDS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.is_known or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._whole(text)
        words, known = text.split(), self.words.get
        found = list(map(known, words))
        if None in found:
            plain = self._is_plain(text)
            found = [known(w) or self._word(w, plain) if f is None else f for w, f in zip(words, found)]
        return b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_file(out: pa.NativeFile, documents: Iterable[tuple[int | None, bytes]], level: int = 1) -> tuple[int, int]:
    """Write (doc_id, ids) in the given order; the numbers of documents and ids."""
    compressor = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
    frames, docs, total = [], [], 0
    for doc_id, ids in documents:
        parts = [ids[i : i + 4 * FRAME_IDS] for i in range(0, len(ids), 4 * FRAME_IDS)]
        for part in parts:
            frame = compressor.compress(part)
            out.write(frame)
            frames.append((len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        docs.append((doc_id is None, doc_id or 0, len(parts), len(ids) // 4))
        total += len(ids) // 4
    index = np.array(docs, [("null", "u1"), ("id", "<i8"), ("frames", "<u4"), ("ids", "<u8")]).tobytes()
    packed = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(index)
    out.write(struct.pack("<II", INDEX, len(packed)) + packed)
    table = np.array(frames, "<u4").tobytes() + struct.pack("<IBI", len(frames), HAS_CHECKSUMS, FOOTER)
    out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
    return len(docs), total


class Reader:
    """Documents of one file, all in order or those with given ids."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source, size = source, source.size()
        n, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != FOOTER or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table")
        table = self._bytes(size - 9 - 12 * n, 12 * n)
        self.frames = np.frombuffer(table, "<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._bytes(int(self.offsets[-1]), 8))
        if magic != INDEX:
            raise ValueError("no index of documents")
        packed = self._bytes(int(self.offsets[-1]) + 8, length)
        kind = [("null", "u1"), ("id", "<i8"), ("frames", "<u4"), ("ids", "<u8")]
        self.docs = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)
        self.first = np.concatenate([[0], np.cumsum(self.docs["frames"], dtype=np.int64)])
        self.decompressor = zstandard.ZstdDecompressor()

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, place: int) -> bytes:
        """The ids of the document at ``place``; only its frames are read."""
        a, b = self.first[place], self.first[place + 1]
        raw, out = self._bytes(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a])), []
        for k in range(a, b):
            low = int(self.offsets[k] - self.offsets[a])
            part = self.decompressor.decompress(raw[low : low + int(self.frames[k, 0])])
            if len(part) != self.frames[k, 1] or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            out.append(part)
        return b"".join(out)

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for place, doc in enumerate(self.docs):
            yield None if doc["null"] else int(doc["id"]), self.ids(place)

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """The documents with these ids, in the file's order."""
        wanted = np.flatnonzero(np.isin(self.docs["id"], list(doc_ids)) & (self.docs["null"] == 0))
        for place in wanted:
            yield int(self.docs["id"][place]), self.ids(int(place))


def part_name(part: int) -> str:
    return f"part-{part:06d}.zst"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Encode documents into files under ``path``, in ascending order of doc_id.

    Returns the manifest: part, n_docs, n_ids; one row per file, files in order
    of their parts. Texts are dealt to files by ranges of doc_id (nulls first;
    rows with equal ids by text, then by place in the input), so a repeated id
    fills no single task. A file is written under a name of its own and then
    renamed, so a task that runs twice leaves the same file. Null and empty texts
    have the end id only. An empty table gives empty files or none.
    """
    order = ["doc_id", "_text", "_row"]
    rows = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row")
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        encode = encoder(vocabulary).encode

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in slices(batches, "text"):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    yield doc_id, encode(text) + end

        attempt = f"{folder}/.{part_name(part)}-{uuid.uuid4().hex}"
        with store.open_output_stream(attempt) as out:
            n_docs, n_ids = write_file(out, documents())
        store.move(attempt, f"{folder}/{part_name(part)}")
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())}
        )

    return materialize(rows.mapInArrow(write, "part int, n_docs long, n_ids long"), "token-manifest")


def read_tokens(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32.

    One task reads one file. ``start`` adds up the manifest, a row per file.
    """
    files = manifest.count()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                with store.open_input_file(f"{folder}/{part_name(part)}") as source:
                    reader, at, out = Reader(source), 0, []
                    for doc_id, ids in reader:
                        out.append((part, doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                        if len(out) == 20_000:
                            yield _rows(out)
                            out = []
                    yield _rows(out)

    parts = spark.range(0, files, 1, max(files, 1)).select(F.col("id").cast("int").alias("part"))
    found = parts.mapInArrow(scan, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    before = F.sum("n_ids").over(W.orderBy("part")) - F.col("n_ids")
    starts = manifest.select("part", before.alias("_before"))
    return found.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])


def token_files(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents and read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    return read_tokens(spark, path, write_tokens(docs, path, vocabulary))
