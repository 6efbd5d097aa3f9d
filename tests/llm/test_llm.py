"""The training-data operators against brute force, and on odd inputs."""

import hashlib
import io
import re
import textwrap
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from guestlens.llm import (
    common, components, jaccard, kneser_ney, licenses, mixing, quality_model, quality_rules, queries, repeats, sharding,
    templates, tokens, toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Clashing names, nulls, repeated rows and ids, empty and long texts.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, size long, node long, seed long"
LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
ODD = [
    (1, BASE, "en", "a", 1, 9, 9, 9, 9),
    (2, BASE + " tail", "en", "a", 1, None, 9, 9, 9),
    (2, BASE + " tail", "en", "a", 1, None, 9, 9, 9),
    (None, BASE, None, None, None, None, None, None, None),
    (3, None, "en", "b", 0, 1, 1, 1, 1),
    (4, "", None, "b", 0, 1, 1, 1, 1),
    (5, " \t\n", "fr", "", 0, 1, 1, 1, 1),
    (6, "one two", "fr", None, 7, 1, 1, 1, 1),
    (7, "One  TWO", "fr", None, 7, 1, 1, 1, 1),
    (8, LONG, "en", "a", 1, 1, 1, 1, 1),
    (9, "naïve Ünï\x1c don't <|endoftext|> 12.5km \x00 x", "en", "c", 1, 1, 1, 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(ODD, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    odd.limit(0).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_queries_are_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


# Sharding


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(docs, texts):
    rows = sharding.shard_documents(docs, 8).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()
    }
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    largest = max(r.size for r in rows)
    assert set(sums) == set(range(8)) and max(sums.values()) - min(sums.values()) <= 2 * largest + sum(sums.values()) / 8 / 4
    assert gapless(rows) and {r.law for r in rows} == {"bytes"}


def test_hot_key_is_subdivided(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else f"text {i}") for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard_documents(df, 10).collect()
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    assert gapless(rows) and max(sums.values()) < 1.1 * min(sums.values())


def test_shards_of_odd_rows(odd, none):
    rows = sharding.shard_documents(odd, 40).collect()
    assert len(rows) == len(ODD) and gapless(rows)
    assert sharding.shard_documents(none).count() == 0


# Token files


def test_token_file_round_trip(tmp_path):
    written = [(None, b""), (5, np.arange(3, dtype="<u4").tobytes()), (7, np.arange(tokens.FRAME_IDS * 2 + 5, dtype="<u4").tobytes())]
    out = io.BytesIO()
    assert tokens.write_file(pa.PythonFile(out, "w"), written) == (3, 3 + tokens.FRAME_IDS * 2 + 5)
    data = bytearray(out.getvalue())
    assert list(tokens.Reader(pa.BufferReader(bytes(data)))) == written
    reader = tokens.Reader(pa.BufferReader(bytes(data)))
    fetched = []
    own, reader._bytes = reader._bytes, lambda at, n: fetched.append(n) or own(at, n)
    assert list(reader.find([5, 99])) == [written[1]] and sum(fetched) < 100
    data[int(reader.offsets[1]) + 12] ^= 0xFF
    with pytest.raises(Exception):
        list(tokens.Reader(pa.BufferReader(bytes(data))))


def expected_tokens(pairs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.vocabulary())
    at, out = 0, []
    for i, text in pairs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_tokens_of_documents(docs, texts):
    got = sorted(tuple(r) for r in tokens.token_files(docs, queries.vocabulary()).collect())
    assert got == expected_tokens(sorted(texts.items()))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_gives_the_ids_of_the_library(texts, name, monkeypatch):
    """Of any vocabulary, and with caches that overflow; only the known kind takes the fast path."""
    monkeypatch.setattr(tokens, "WORDS", 50)
    monkeypatch.setattr(tokens, "CACHE", 30)
    own = tokens.Encoder(queries.vocabulary(name))
    assert own.is_known == (name == "word_bpe_49k.json")
    odd = ["It's WE'LL 'S 'tis x\x0by\x85z", "İstanbul ǅ ﬁ ŉ Ÿ ÷×", "e\u0301 <|endoftext|>a x\x1cy", "a" * 5000, LONG[:20_000], ODD[-1][1]]
    for text in [*odd, *list(texts.values())[:60]]:
        want = np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode(text) == want and own.encode(text) == want


def test_tokens_of_odd_rows(odd, none):
    got = sorted((tuple(r) for r in tokens.token_files(odd, queries.vocabulary()).collect()), key=lambda r: r[1])
    first = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected_tokens([r[:2] for r in first])
    assert tokens.token_files(none, queries.vocabulary()).count() == 0


# Mixing


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, fixed, budget = set(order), {}, share * sum(sizes.values())
    while open_:
        rest, total = budget - sum(fixed.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > most * sizes[s]}
        if not over:
            return fixed | {s: rest * weight[s] / total for s in open_}
        fixed |= {s: most * sizes[s] for s in over}
        open_ -= over
    return fixed


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_mix(request, name):
    df = request.getfixturevalue(name)
    rows = mixing.mix(df.drop("size"), mixing.n_words(F.col("text")), ["doc_id", "source", "text"]).collect()
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(r.text or "")) and r.taken in (0, r["size"], 2 * r["size"])
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r["size"])
    goals = filled(sizes)
    assert len(rows) == df.count()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
    assert all(abs(taken[s] - goals[s]) <= most[s] for s in sizes)


def test_mix_again_and_of_nothing(docs, none):
    one, two = (sorted(tuple(r) for r in mixing.mix_documents(docs).collect()) for _ in range(2))
    assert one == two and mixing.mix_documents(none).count() == 0


# Substring dedup


def without_repeats(pairs, n=13):
    cut = [(i, WORD.findall(t or "")) for i, t in pairs]
    first = {}
    for i, ws in cut:
        for k in range(len(ws) - n + 1):
            key = tuple(ws[k : k + n])
            first[key] = min(first.get(key, 1 << 63), 1 << 63 if i is None else i)
    out = []
    for i, ws in cut:
        keep = [True] * len(ws)
        for k in range(len(ws) - n + 1):
            if first[tuple(ws[k : k + n])] < (1 << 63 if i is None else i):
                keep[k : k + n] = [False] * n
        kept = " ".join(w for w, f in zip(ws, keep) if f)
        out.append((i, len(ws), len(ws) - sum(keep), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [5, 24, 50])
def test_repeats_of_other_lengths(docs, window):
    """Fewer or more levels of doubling than the contract's two."""
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs, window).collect()), key=str)
    assert got == without_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()], window)


def test_windows_that_share_a_hash_are_told_apart(docs, monkeypatch):
    """As if the first hash of a window had few values: the second one decides."""
    full = repeats._window_rows

    def coarse(length, below):
        def run(batches):
            for batch in full(length, below)(batches):
                h1 = batch.column("h1").to_numpy() % 7
                yield batch.set_column(batch.schema.get_field_index("h1"), "h1", pa.array(h1))

        return run

    monkeypatch.setattr(repeats, "_window_rows", coarse)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs).collect()), key=str)
    assert got == without_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_levels_double():
    assert [repeats.lengths(n) for n in (13, 24, 50)] == [[7, 13], [7, 13, 24], [8, 14, 26, 50]]
    for window in range(9, 300):
        levels = repeats.lengths(window)
        assert all(b <= 2 * a and b >= a for a, b in zip(levels, levels[1:]))


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_repeats(request, name):
    df = request.getfixturevalue(name)
    got = sorted((tuple(r) for r in repeats.remove_repeats(df).collect()), key=str)
    assert got == without_repeats([tuple(r) for r in df.select("doc_id", "text").collect()])


# Jaccard join


def shingle_sets(pairs):
    low = {c: c + 32 for c in range(65, 91)}
    out = []
    for i, t in pairs:
        ws = WORD.findall((t or "").translate(low))
        out.append((i, {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())))
    return out


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_jaccard(request, name):
    df = request.getfixturevalue(name)
    sets = shingle_sets([tuple(r) for r in df.select("doc_id", "text").collect()])
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = defaultdict(lambda: 1 << 63)
    for g, (i, _) in zip(group, sets):
        least[g] = min(least[g], 1 << 63 if i is None else i)
    want = sorted(((i, len(s), least[g] if least[g] < 1 << 63 else None) for g, (i, s) in zip(group, sets)), key=str)
    found = jaccard.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == want
    assert sum(r.stays for r in found) == len(set(group))


def test_jaccard_inside_one_group(spark, tmp_path, monkeypatch):
    """Two texts with equal prefixes that link with each other, but not with the first of their group."""
    monkeypatch.setattr(jaccard, "COMMON", 0)  # any order gives the same result
    pairs = []
    for i in range(60):
        w = [f"g{i}w{k}" for k in range(11)]
        core = " ".join(w[1:10])
        pairs += [(10 * i, f"x{i} {core} y{i}"), (10 * i + 1, f"{w[0]} {core} p{i}"), (10 * i + 2, f"{w[0]} {core} q{i}")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(pairs, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == {i: i - (i % 10 == 2) for i, _ in pairs}


def test_near_copies_meet_at_the_text_they_were_made_of(spark, tmp_path, monkeypatch):
    """Copies that link with the original alone become one component in the first turn of hubs."""
    draw = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    pairs = [(0, " ".join(words))]
    for i in range(1, 200):
        own = list(words)
        own[int(draw.integers(60))] = f"own{i}"
        pairs.append((i, " ".join(own)))
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(path)
    left = []
    between = jaccard._between
    monkeypatch.setattr(jaccard, "_between", lambda *a: left.append(between(*a).count()) or between(*a))
    got = {r.component_id for r in jaccard.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == {0} and left == [0]


def test_sets_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Whole sets, prefixes and what is repeated per salt meet by key: Spark takes them for smaller than they are."""
    monkeypatch.setattr(jaccard, "join_small", partial(common.join_small, most=2))
    words = [f"w{k}" for k in range(60)]
    pairs = [(i, " ".join([*words[:i], f"own{i}", *words[i:]])) for i in range(30)] + [(99, "something else that nobody has said yet")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(path)
    plans, write, prefix, land = [], jaccard.materialize, jaccard._by_prefix, jaccard.landed

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(jaccard, "materialize", lambda df, label: write(watched(df) if label == "links" else df, label))
    monkeypatch.setattr(jaccard, "_by_prefix", lambda *a: watched(prefix(*a)))
    monkeypatch.setattr(jaccard, "landed", lambda spark, label, make: land(spark, label, (lambda: watched(make())) if label == "near-duplicates" else make))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == {i: i if i == 99 else 0 for i, _ in pairs}
    assert len(plans) > 3 and not any("Broadcast" in p for p in plans)


def test_prefix_bound():
    """Linked sets share as many prefix shingles as the bound says, at all sizes."""
    draw = np.random.default_rng(1)
    for _ in range(300):
        n = int(draw.integers(1, 60))
        x = set(draw.choice(200, n, replace=False).tolist())
        y = {v for v in x if draw.random() > 0.1} | set(draw.choice(200, int(draw.integers(0, 6))).tolist())
        if not y or 100 * len(x & y) < 75 * len(x | y):
            continue
        p, q = (set(sorted(s)[: jaccard.prefix_length(len(s))]) for s in (x, y))
        overlap = -(-75 * (len(x) + len(y)) // 175)
        k = min(len(p) - len(x) + overlap, len(q) - len(y) + overlap)
        assert k >= 1 and len(p & q) >= k


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


# Kneser-Ney


def test_probabilities_add_up(spark, docs):
    counts = kneser_ney.count_grams(docs, "test-grams")
    model = kneser_ney.train(counts, "test-model")
    arrays = kneser_ney.HashArrays(model)
    seen = np.array([r.key for r in counts.orderBy("key").limit(30).collect()] + [63 << 18 | 62 << 12 | 61 << 6])
    every = ((seen >> 6) << 6)[:, None] | np.arange(kneser_ney.CLASSES)
    p = arrays.p(every.ravel()).reshape(every.shape)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4) and (p > 0).all()
    joined = dict(kneser_ney.probabilities(spark.createDataFrame([(int(k),) for k in seen], "key long"), model).collect())
    assert np.allclose([joined[int(k)] for k in seen], arrays.p(seen), rtol=1e-5)


def base_rules(text):
    words = WORD.findall(text)
    at = defaultdict(list)
    for k in range(len(words) - 7):
        at[tuple(words[k : k + 8])].append(k)
    inside = {j for ks in at.values() if len(ks) > 1 for k in ks for j in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
        len(words) < 20 or 100 * len(inside) > 30 * len(words),
    )


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_quality_rules(request, name):
    df = request.getfixturevalue(name)
    rows = quality_rules.rate_documents(df).collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    want = [(r.doc_id, *base_rules(r.text or "")) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.kept == (not r.base_failed and r.low <= r.log_perplexity <= r.high) for r in rows if r.log_perplexity is not None)


def test_rules_reject_junk_and_keep_prose(spark, docs, sf):
    labelled = quality_rules.rate_documents(docs).where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    kept = {q: (n, k) for q, n, k in labelled.groupBy("quality").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).collect()}
    assert kept[1][1] >= 0.95 * kept[1][0] and kept[0][1] <= 0.5 * kept[0][0]


def test_quality_model(spark, docs, odd, none, sf):
    trusted = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    rows = quality_model.classify(docs, trusted).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.good for r in rows if r.quality == 1]) > 0.9 > 0.6 > np.mean([r.good for r in rows if r.quality == 0])
    assert quality_model.classify(odd, trusted).count() == len(ODD)
    assert not any(r.good for r in quality_model.classify(odd, trusted.limit(0)).collect())
    assert quality_model.classify(none, trusted).count() == 0


# Decontamination

ITEM = "If Tom has 12 red apples and gives 5 km of rope to Anna then Tom keeps 12 apples in the old barn behind the hill"


def leaks(spark, texts, items=(ITEM,)):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    rows = templates.decontaminate(df, bench, ["doc_id"]).orderBy("doc_id").collect()
    return [r.item_ids for r in rows]


def test_leaks_verbatim_and_re_parameterised(spark):
    other = ITEM.replace("Tom", "Kim").replace("12", "94").replace("Anna", "Bo").replace("5 km", "7 mi")
    thrice = "Tom saw a boat and Tom met a goat while Tom sold a coat to a stoat near Tom"
    torn = thrice.replace("Tom", "Kim", 1).replace("and Tom", "and Bo").replace("while Tom", "while Al")
    found = leaks(spark, [
        "Before. " + ITEM + " After.", ITEM.lower().replace(" ", "\n"), "x " * 9 + other, torn, "nothing of it", None, "",
        " ".join(ITEM.split()[3:16]), " ".join(ITEM.split()[3:15]), thrice.replace("Tom", "Kim"),
    ], (ITEM, thrice))
    assert found == [[0], [0], [0], [], [], [], [], [0], [], [1]]


def test_leaks_at_all_places_and_of_short_items(spark):
    item = "Tom has 12 red apples. Each day Anna eats 3 of them. How many remain now"
    renamed = "Kim has 40 red apples; each day Bo eats 9 of them. How many remain now"
    assert leaks(spark, ["x " * k + renamed for k in range(14)], (item,)) == [[0]] * 14
    short, shorter = "Why does Tom sing in the rain", "Name nine red birds"
    inside = "so we ask why does Ann SING in the Rain today"
    found = leaks(spark, [inside.replace("why does Ann", "Why does Kim"), "x " * 5 + "name nine RED birds.", "why does it sing in rain", "name nine", inside + " y", ""], (short, shorter, "", "How old is Al now, and how old was Tom"))
    assert found == [[0], [1], [], [], [0], []]
    assert leaks(spark, ["x " * k + "How old is Bo now, and how old was Kim then" for k in range(9)], ("How old is Al now, and how old was Tom",)) == [[0]] * 9


def test_leaks_of_documents(spark, docs, texts, sf, odd, none):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    cut = lambda t: re.findall(r"[a-zà-ÿß]+", t.lower())
    runs = {}
    for r in bench.collect():
        ws = cut(r.text)
        for k in range(len(ws) - 12):
            runs.setdefault(tuple(ws[k : k + 13]), set()).add(r.item_id)
    want = {i: set().union(*[runs.get(tuple(ws[k : k + 13]), set()) for k in range(len(ws) - 12)]) for i, ws in ((i, cut(t)) for i, t in texts.items())}
    got = {r.doc_id: set(r.item_ids) for r in templates.decontaminate(docs, bench, ["doc_id"]).collect()}
    assert got == want and any(want.values())
    assert templates.decontaminate(odd, bench, ["doc_id", "size", "node"]).where("contaminated").count() == 0
    assert templates.decontaminate(none, bench, ["doc_id"]).count() == 0
    assert templates.decontaminate(odd, bench.limit(0), ["doc_id"]).where("contaminated").count() == 0


# Licences


def test_licenses_match_sql(spark, sf, duck):
    df = queries.license_scan(spark, sf)
    want = duck.execute(queries.ORACLE_SQL["op9_license_scan"]).fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_whole_licence_in_other_words(spark, odd, none):
    text = dict((n, t) for n, t in licenses.KNOWN)["ISC"]
    copy = "Copyright (c) 2020 Somebody\n" + text.upper().replace(", ", " ,\n")
    df = spark.createDataFrame([(1, copy), (2, "a LICENCED work.\nLicenced under CC BY 4.0"), (3, text + " more")], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(df, licenses.known_digests(spark)).collect()}
    assert got == {1: ("ISC", None), 2: (None, "CC-BY-4.0"), 3: (None, None)}
    assert licenses.scan(odd, licenses.known_digests(spark)).count() == len(ODD)
    assert licenses.scan(none, licenses.known_digests(spark)).count() == 0


MIT_FILE = """MIT License

Copyright (c) 2021 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC_FILE = """ISC License

Copyright Some Body Inc.

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""


def test_published_licence_files(spark):
    apache = (licenses.FOLDER / "Apache-2.0.txt").read_text()
    filled = apache.replace("[yyyy] [name of copyright owner]", "2020 Some Body")
    rewrapped = "\n\n".join(textwrap.fill(" ".join(p.split()), 50) for p in re.split(r"\n[ \t]*\n", filled))
    headless = MIT_FILE.split("\n\n", 1)[1]
    texts = [MIT_FILE, headless, MIT_FILE.replace("MIT License", "The MIT License (MIT)"), ISC_FILE, apache, rewrapped,
             (licenses.FOLDER / "GPL-3.0.txt").read_text().replace("http://", "https://"), MIT_FILE + "but not on Sundays"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(df, licenses.known_digests(spark)).orderBy("doc_id").collect()
    assert [r.license for r in rows] == ["MIT", "MIT", "MIT", "ISC", "Apache-2.0", "Apache-2.0", "GPL-3.0", None]


# Toxicity


def test_toxicity_learns(spark):
    draw = np.random.default_rng(3)
    plain = [f"{a}{b}" for a in ("the", "on", "in", "er", "sh", "th") for b in ("ing", "ed", "ly", "an", "or", "ea", "ble")]
    data, marks = [], []
    for i in range(900):
        words = draw.choice(plain, int(draw.integers(30, 80))).tolist()
        if i % 4 == 0:
            for _ in range(4):
                words[int(draw.integers(len(words)))] = str(draw.choice(["vilescum", "grubtrash", "dolt"]))
        data.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    rows = toxicity.score(df, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_of_odd_rows(spark, odd, none):
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (6, 1), (8, 0), (None, 1), (9, None), (2, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd, marks).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.score(odd, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score(none, marks).count() == 0


# Pipeline


def test_pipeline_stages(spark, sf, docs, texts):
    out = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before, out = out, stage(spark, out, sf).cache()
        ids, was = {r.doc_id for r in out.collect()}, {r.doc_id for r in before.collect()}
        assert out.columns == docs.columns and ids <= was and len(ids) > 0
        if k == 0:
            want = {r.doc_id for r in quality_rules.judge(before).where("kept").collect()}
        elif k == 1:
            want = {r.doc_id for r in jaccard.near_duplicates(before).collect() if r.doc_id == r.component_id}
        elif k == 2:
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            want = {r.doc_id for r in templates.decontaminate(before, bench, ["doc_id"]).where("NOT contaminated").collect()}
        else:
            want = {r.doc_id for r in mixing.mix_documents(before).where("taken > 0").collect()}
        assert ids == want
        path = corpus_pipeline.new_path(spark, "test-stage")
        out.write.parquet(path)
        out = spark.read.parquet(path)
    last = sorted((tuple(r) for r in corpus_pipeline.token_stage(spark, out, sf).collect()), key=lambda r: r[1])
    assert last == expected_tokens(sorted((r.doc_id, texts[r.doc_id]) for r in out.select("doc_id").collect()))
