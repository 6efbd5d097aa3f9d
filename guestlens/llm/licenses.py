"""License scan by digests of canonical texts."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.llm.common import join_small, landed, materialize

# Notices, and the whole texts of short licences. Those of all others are files.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
)
# Spellings that licence texts use for one another.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("noncommercial", "non commercial"), ("favour", "favor"), ("honour", "honor"),
    ("acknowledgement", "acknowledgment"), ("fulfil ", "fulfill "), ("judgement", "judgment"), ("merchantibility", "merchantability"),
)
# The published texts, one file per licence and wording ("name.txt", "name+wording.txt"), read by the driver.
FOLDER = Path(__file__).parent / "known_licenses"
# Other headings of the texts whose first paragraph is one.
HEADINGS = {
    "MIT": ("The MIT License", "The MIT License (MIT)"),
    "ISC": ("The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'),
}
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
_YEAR = r"[<\[{(]?(?:year|yyyy|(?:19|20)[0-9]{2})(?![\p{L}0-9])"
_HOLDER = r"(?!(?:Notice|Holder|Owner|Licen[sc]e|Law|Statement|Act|Interest|Treat|Permission|Disclaimer|Right|Protection)(?:s|y|ies)?\b)\p{Lu}"
# Lines that state a copyright: the word with a sign, a year or a holder's name. Wrapped
# lines of a licence that begin with the word, or with an item "(c)", are none.
STATEMENT = (
    r"(^|\n)[ \t]*(?:"
    rf"(?i:copyright)[ \t,:]*(?:(?i:by)[ \t]+)?(?i:\(c\)|©|&copy;|{_YEAR})[^\n]*"
    rf"|Copyright:?[ \t]+(?:(?:by|the|The)[ \t]+)?{_HOLDER}[^\n]*"
    rf"|(?i:\(c\)[ \t]*(?:copyright|{_YEAR}))[^\n]*|(?i:\(c\)[^\n]*all rights reserved)[^\n]*"
    r"|(?:©|&copy;)[^\n]*"
    r"|(?i:all rights reserved)[ \t\r.!]*(?=\n|$))"
)


def canonical_lines(text: Column) -> Column:
    """Lower case, without copyright statements, one spelling, marks as single spaces; line ends stay."""
    text = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), STATEMENT, "\n"))
    for other, one in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(one))
    return F.regexp_replace(text, r"[^a-z0-9\n]+", " ")


def canonical(lines: Column) -> Column:
    """A whole text of canonical lines on one line."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def full_texts(folder: Path = FOLDER) -> list[tuple[str, str]]:
    """(license, text) of the whole licences in the folder, as they are published.

    Each stands with and without its heading (the first paragraph) and the part
    that follows its terms, and with either form of the links in it.
    """
    found = []
    for file in sorted(folder.glob("*.txt")):
        name, text = file.stem.split("+")[0], file.read_text(encoding="utf-8").strip()
        heading, body = re.split(r"\n[ \t]*\n", text, maxsplit=1)
        begins = [text, body, *(f"{h}\n\n{body}" for h in HEADINGS.get(name, ()))] if len(heading) < 200 else [text]
        ends = [(b, re.split(r"(?<=END OF TERMS AND CONDITIONS)\s", b)[0]) for b in begins]
        for whole in dict.fromkeys(b for pair in ends for b in pair):
            found += [(name, whole), (name, whole.replace("http://", "https://")), (name, whole.replace("https://", "http://"))]
    return list(dict.fromkeys(found))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, folder: Path | None = FOLDER) -> DataFrame:
    """(digest, license) of the known texts and of the whole licences in the folder, one row per digest."""
    texts = [*known, *(full_texts(folder) if folder else ())]
    rows = spark.createDataFrame(texts, "license string, text string")
    digests = rows.select(F.md5(canonical(canonical_lines(F.col("text")))).alias("digest"), "license")
    return materialize(digests.groupBy("digest").agg(F.min("license").alias("license")), "known-licenses")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, license, notices of every document.

    ``license`` is what the entire text is: its canonical digest joined with the
    known ones. ``notices`` names the licences that single lines state, sorted
    and joined by a comma, by the same join over the digests of lines. Both are
    null where nothing is known. Null texts are empty; an empty text has a digest
    and no licence. Repeated rows are scanned alike, an empty table gives an
    empty result. Other columns, whatever their names, are not looked at.

    Every text is made canonical once: the digests of the whole and of its lines
    are written, with a number per row that is stored with them, and the joins read those.
    """

    def make() -> DataFrame:
        lines = docs.select("doc_id", canonical_lines(F.col("text")).alias("_lines"))
        each = F.array_distinct(F.filter(F.transform(F.split("_lines", "\n"), lambda x: F.trim(x)), lambda x: x != ""))
        digests = materialize(
            lines.select(
                "doc_id",
                F.monotonically_increasing_id().alias("_row"),
                F.md5(canonical(F.col("_lines"))).alias("digest"),
                F.transform(each, lambda x: F.unhex(F.md5(x))).alias("_each"),
            ),
            "digests",
        )
        parts = digests.select("_row", F.explode("_each").alias("_line"))
        of_line = known.select(F.unhex("digest").alias("_line"), "license")
        # One row per known text.
        stated = join_small(parts, of_line, ["_line"], "inner", F.col("_row"))
        notices = stated.groupBy("_row").agg(F.concat_ws(",", F.sort_array(F.collect_set("license"))).alias("notices"))
        whole = join_small(digests.drop("_each"), known, ["digest"], "left", F.col("_row"))
        joined = join_small(whole, materialize(notices, "notices"), ["_row"], "left")
        return joined.select("doc_id", "digest", "license", "notices")

    return landed(docs.sparkSession, "licenses", make)


def _sql_string(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql(known: tuple[tuple[str, str], ...] = KNOWN) -> str:
    """The scan in DuckDB's SQL, by the notices and short licences alone and without any line that begins like a
    copyright statement: the same as ``scan`` where no text has a longer licence or such a line of other meaning."""

    def lines(text: str) -> str:
        out = f"regexp_replace(lower(coalesce({text}, '')), {_sql_string(COPYRIGHT_LINE)}, chr(10), 'g')"
        for other, one in SPELLINGS:
            out = f"replace({out}, {_sql_string(other)}, {_sql_string(one)})"
        return f"regexp_replace({out}, '[^a-z0-9\\n]+', ' ', 'g')"

    def whole(text: str) -> str:
        return f"md5(trim(regexp_replace({text}, '[ \\n]+', ' ', 'g')))"

    values = ", ".join(f"({_sql_string(name)}, {_sql_string(text)})" for name, text in known)
    return f"""
WITH texts(license, text) AS (VALUES {values}),
known AS (SELECT {whole(lines('text'))} AS digest, min(license) AS license FROM texts GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines('text')} AS l FROM documents),
parts AS (SELECT DISTINCT r, trim(unnest(string_split(l, chr(10)))) AS line FROM docs),
notices AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
            FROM parts JOIN known ON md5(line) = digest WHERE line <> '' GROUP BY r)
SELECT doc_id, {whole('l')} AS digest, license, notices
FROM docs LEFT JOIN known ON {whole('l')} = known.digest LEFT JOIN notices USING (r)
"""
