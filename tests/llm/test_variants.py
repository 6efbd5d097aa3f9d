"""Spelling variants, fill-in-middle texts and language ID against brute force, and on odd inputs."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from guestlens.llm import infill, language_id, queries, spelling
from tests.llm.test_llm import ODD, SCHEMA

TYPOS = [
    (i, text, "en", "a", 1, 1, 1, 1, 1)
    for i, text in enumerate(
        ["Restaurant restaurant RESTAURANT " * 12, "restaurent restaurents resturant restaurant " * 2, "ÉÀéàüöä Éàéàüöä Éàéàüöä",
         "abcdefg abcdefg abcdefh abcdefh abcdefgh abcdefgh zabcdefg zabcdefg", "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa",
         "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5001 + " " + "x" * 5001, "short words only", None, "", "1234567 ----- é"] * 3
    )
]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    def make(rows, name):
        path = str(tmp_path_factory.mktemp(name) / "documents.parquet")
        spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="module")
def frames(spark, sf, table):
    odd = table(ODD, "odd")
    return {"docs": spark.read.parquet(f"{sf}/documents.parquet"), "odd": odd, "typos": table(TYPOS, "typos"), "none": odd.limit(0)}


# Spelling variants


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def deletions(word):
    return {(i, word[:i] + word[i + 1 :]) for i in range(len(word))}


def brute_near(words):
    """Near words by what is left of each when one letter is deleted."""
    near, gaps = {w: set() for w in words}, {}
    for w in words:
        if len(w) > 1000:
            continue
        for i, rest in deletions(w):
            if rest in near:
                near[w].add(rest)
                near[rest].add(w)
            gaps.setdefault((i, rest), set()).add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    long = [w for w in words if len(w) > 1000]
    for a in long:
        near[a] |= {b for b in long if abs(len(a) - len(b)) == 1 and set(a) == set(b) == {"x"}}
    return near


def brute_variants(rows):
    words = brute_words(rows)
    near, forms = brute_near(words), {}
    for w, own in near.items():
        if own:
            best = min(own, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                forms[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, n, len(near[w]), forms.get(w), words[forms[w]] if w in forms else None, root))
    return out


@pytest.mark.parametrize("name", ["docs", "odd", "typos", "none"])
def test_variants(frames, name):
    rows = [(r.doc_id, r.text) for r in frames[name].select("doc_id", "text").collect()]
    got = [tuple(r) for r in spelling.spelling_variants(frames[name]).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows)


def test_hot_blocks_are_cut_into_chunks(spark):
    words = {"commonhead" + "".join(p) for p in ([a + b + c for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"])}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    tiles = spelling.blocks(df, 50)
    sizes = [r[0] for r in tiles.groupBy("tile").count().select("count").collect()]
    assert max(sizes) < 200
    got = Counter((r.word, r.near) for r in spelling.near_words(df, 50).collect())
    near = brute_near(words)
    assert max(got.values()) == 1 and set(got) == {(w, v) for w in words for v in near[w]}


@settings(max_examples=200, deadline=None)
@given(st.text("abé", max_size=9), st.text("abé", max_size=9))
def test_one_edit(a, b):
    near = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "abé"}
    near |= {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "abé"}
    assert spelling.is_one_edit(a, b) == (b in near - {a})


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("v", "w5")]
    got = dict(spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect())
    assert set(got.values()) == {"w13"} and len(got) == 14


# Fill-in-middle


def brute_infill(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", a, b - a, "<P>" + p + "<S>" + s + "<M>" + m


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_infill(frames, name):
    rows = [(r.doc_id, r.text) for r in frames[name].select("doc_id", "text").collect()]
    assert sorted(infill.infill(frames[name]).collect(), key=str) == sorted([(i, *brute_infill(i, t)) for i, t in rows], key=str)
    digests = infill.infill_digests(frames[name]).collect()
    sha = Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)
    assert Counter(r.restored_sha256 for r in digests) == sha


def test_infill_matches_sql(spark, sf, duck):
    df = queries.QUERIES["op12_fill_in_middle"](spark, sf)
    cursor = duck.execute(queries.ORACLE_SQL["op12_fill_in_middle"])
    names = [d[0] for d in cursor.description]
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(cursor.fetchall())


@settings(max_examples=300, deadline=None)
@given(st.text("<PSM>aé\n😀\0"), st.integers(-5, 10**12))
def test_infill_round_trip(text, doc_id):
    units = regex.compile(f"({infill.CODE_POINT})*", regex.V1)
    n, form, prefix, middle, output = infill.transform(text, doc_id, units)
    assert (n, form, prefix, middle, output) == brute_infill(doc_id, text)
    assert infill.restore(output, form) == text


def test_other_units():
    units = regex.compile(r"(\S+\s*)*", regex.V1)
    found = [infill.transform("one two  three four", i, units) for i in range(40)]
    assert {f[0] for f in found} == {4} and {f[1] for f in found} == {"plain", "psm", "spm"}
    assert {f[2] for f in found} <= {None, 0, 4, 9, 15, 19}
    assert infill.transform(" starts with a space", 1, units)[:2] == (None, "plain")


# Language ID


def has_letter(text):
    return any(unicodedata.category(c).startswith("L") for c in text or "")


def test_languages_held_out(spark, frames):
    rows = {r.doc_id: r for r in language_id.identify(frames["docs"]).collect()}
    truth = {r.doc_id: r for r in frames["docs"].select("doc_id", "lang", "text").collect()}
    assert set(rows) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    test = [i for i, r in rows.items() if r.held_out and truth[i].lang is not None]
    assert sum(rows[i].lang_pred == truth[i].lang for i in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert all((r.lang_pred == "und") == (not has_letter(truth[i].text)) for i, r in rows.items())


def test_vectors_against_brute_force():
    texts = ["Ab  é\n12 ab", "", "x", None]
    import pyarrow as pa

    for text, got in zip(texts, language_id.gram_counts(pa.array(texts, pa.string()))):
        raw = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in (text or "").encode())
        raw = re.sub(rb" +", b" ", b" " + raw + b" ")
        want = Counter()
        for n in language_id.ORDERS:
            for k in range(len(raw) - n + 1):
                gram = (int.from_bytes(raw[k : k + n], "big") + n) * int(language_id._ODD[n - 1]) % 2**32
                want[gram >> (32 - language_id.BITS)] += 1
        assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == want


def test_cosine_of_nearest_centroid_and_rejection():
    import pyarrow as pa

    idf = np.ones(language_id.BUCKETS, np.float32)
    texts = ["the cat and the dog", "der hund und die katze", "the dog and the cat ran"]
    points = language_id.vectors(pa.array(texts[:2]), idf)
    model = language_id.Model(idf, ["en", "de"], np.array([0.5, 0.01]), points)
    langs, score, far = model.predict(pa.array([*texts, "zzzz qqqq"]))
    assert langs[:3] == ["en", "de", "en"] and score[0] == pytest.approx(1, abs=1e-6)
    assert score[2] == pytest.approx(float(language_id.vectors(pa.array(texts[2:]), idf)[0] @ points[0]), abs=1e-6)
    assert far.tolist()[:3] == [False, False, False] and far[3]


def test_clusters_find_separate_groups():
    rng = np.random.default_rng(1)
    base = np.eye(4, 64, dtype=np.float32)
    points = base[np.arange(200) % 4] + rng.normal(0, 0.02, (200, 64)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids, radius = language_id.cluster(points)
    assert sorted(np.argmax(base @ centroids.T, axis=1).tolist()) == [0, 1, 2, 3] and (radius < 0.1).all()
    again, _ = language_id.cluster(points.copy())
    assert (again == centroids).all()
    same, radius = language_id.cluster(np.repeat(points[:1], 9, axis=0))
    assert np.allclose(same, points[0], atol=1e-5) and np.allclose(radius, 0, atol=1e-5)


def test_languages_of_odd_rows(frames, spark, table):
    rows = language_id.identify(frames["odd"]).collect()
    assert len(rows) == len(ODD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(tuple(r))
    assert all(len(v) == 1 for v in by_id.values())
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in rows if r.doc_id in (3, 4, 5))
    assert all(r.lang_pred in ("en", "fr") for r in rows if r.doc_id in (1, 6, 7, 8))
    assert language_id.identify(frames["none"]).count() == 0
    unlabelled = table([(1, "some words", None, "a", 1, 1, 1, 1, 1)], "unlabelled")
    assert [tuple(r) for r in language_id.identify(unlabelled).collect()] == [(1, False, "und", 0.0, True)]
