"""Fill-in-the-middle texts: units by repeated captures, two cuts, three forms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from guestlens.llm.common import slices

# The marks of the three pieces, the name of the draw, the shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
DRAW = "1:"
TRANSFORMED, SUFFIX_FIRST = 90, 20
CODE_POINT = r"(?s:.)"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(doc_id: int | None) -> list[int]:
    """Four numbers below 2 ** 32 that only the id decides; a null id draws as an empty one."""
    digest = hashlib.sha256(f"{DRAW}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _ends(units: regex.Pattern, text: str) -> list[int] | None:
    """Where each unit of the text ends, from the captures of one match; None if units do not cover it."""
    match = units.fullmatch(text)
    return None if match is None else match.ends(1)


def transform(text: str | None, doc_id: int | None, units: regex.Pattern) -> tuple[int | None, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    ends = _ends(units, text)
    if ends is None:
        return None, PLAIN, None, None, text
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= TRANSFORMED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made of, by its marks alone.

    No piece holds a mark, and none can arise where a piece meets one, so the
    first occurrence of each mark is the mark itself.
    """
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    head, middle = output.removeprefix(first).split(MIDDLE, 1)
    one, other = head.split(second, 1)
    return one + middle + other if form == PSM else other + middle + one


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _run(unit: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*", regex.V1)
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            rows = [transform(t, i, units) for t, i in zip(batch.column("text").to_pylist(), ids)]
            n, form, prefix, middle, output = zip(*rows)
            columns = {
                "doc_id": pa.array(ids, pa.int64()),
                "n": pa.array(n, pa.int64()),
                "form": pa.array(form, pa.string()),
                "prefix_chars": pa.array(prefix, pa.int64()),
                "middle_chars": pa.array(middle, pa.int64()),
            }
            if digests:
                columns["output_sha256"] = pa.array(map(_sha256, output), pa.string())
                columns["restored_sha256"] = pa.array([_sha256(restore(o, f)) for o, f in zip(output, form)], pa.string())
            else:
                columns["output"] = pa.array(output, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def infill(docs: DataFrame, unit: str = CODE_POINT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every document.

    One ``fullmatch`` of ``(unit)*`` keeps every repetition; its captures' ends
    give n and both cuts, whose places come from a hash of the id. A unit must
    not match the empty string. A text that units do not cover stays plain and
    has no n, as a text has that holds one of the marks. Null texts are empty
    and plain. Rows are transformed where they are read, each by itself: repeated
    rows give the same, an empty table an empty result, and other columns,
    whatever their names, are not looked at. The captures take about 60 bytes
    of a worker's memory per unit of the longest text.
    """
    return docs.select("doc_id", "text").mapInArrow(_run(unit, False), SCHEMA)


def infill_digests(docs: DataFrame, unit: str = CODE_POINT) -> DataFrame:
    """``infill`` with the digests of the output, and of the text restored from it, for the output."""
    schema = SCHEMA.replace("output string", "output_sha256 string, restored_sha256 string")
    return docs.select("doc_id", "text").mapInArrow(_run(unit, True), schema)


def infill_sql() -> str:
    """``infill_digests`` by code points in DuckDB's SQL."""
    h1, h2, h3, h4 = (f"('0x' || substr(h, {i}, 8))::BIGINT" for i in (1, 9, 17, 25))
    has_mark = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                     sha256('{DRAW}' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cuts AS (SELECT doc_id, t, n, least({h1} % (n + 1), {h2} % (n + 1)) AS a, greatest({h1} % (n + 1), {h2} % (n + 1)) AS b,
         CASE WHEN t = '' OR {has_mark} OR {h3} % 100 >= {TRANSFORMED} THEN '{PLAIN}'
              WHEN {h4} % 100 < {SUFFIX_FIRST} THEN '{SPM}' ELSE '{PSM}' END AS form FROM docs),
pieces AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN a END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN t WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces"""
