"""The Kneser-Ney models and the compression distances against plain Python."""

import math
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from guestlens.llm import common, kneser_ney, quality_model, quality_rules, toxicity, word_model

TEXTS = [
    (1, "the cat sat on the mat. The cat, the CAT!", "en"), (2, "a dog and 12 cats sat", "en"), (3, "le chat été noir", "fr"),
    (4, "the dog sat on the cat " * 5, "en"), (5, "", "en"), (6, None, None), (7, "zzzz qqqq 9999 ####", "en"),
]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lm") / "documents.parquet")
    spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def symbols(word):
    return [int(kneser_ney._CLASS[ord(c)]) for c in word] + [0]


def grams_of(words):
    """The 4-gram that ends at each symbol of each word."""
    for word in words:
        padded = [0, 0, 0, *symbols(word)]
        for k in range(3, len(padded)):
            yield tuple(padded[k - 3 : k + 1])


def discounts(counts):
    n1, n2, n3, n4 = (sum(c == i for c in counts.values()) for i in range(1, 5))
    if not n1 or not n2 or not n3:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, kneser_ney.LEAST_DISCOUNT), float(i)) for i, d in enumerate(found, 1))


class Brute:
    """Interpolated modified Kneser-Ney, level by level."""

    def __init__(self, words):
        level, self.levels = Counter(grams_of(words)), []
        while level and len(next(iter(level))):
            self.levels.insert(0, level)
            level = Counter(gram[1:] for gram in level)
        self.d = [discounts(level) for level in self.levels]
        self.of_context = []
        for level in self.levels:
            own = defaultdict(list)
            for gram, n in level.items():
                own[gram[:-1]].append(n)
            self.of_context.append(own)

    def p(self, gram):
        p = 1 / kneser_ney.CLASSES
        for order in range(1, 5):
            own = gram[4 - order :]
            counts = self.of_context[order - 1].get(own[:-1])
            if not counts:
                continue
            off = [min(self.d[order - 1][min(n, 3) - 1], n) for n in counts]
            n = self.levels[order - 1].get(own, 0)
            mine = n - min(self.d[order - 1][min(n, 3) - 1], n) if n else 0
            p = (mine + sum(off) * p) / sum(counts)
        return p

    def log(self, words):
        return sum(math.log(self.p(g)) for g in grams_of(words))


def key(gram):
    out = 0
    for symbol in gram:
        out = out << kneser_ney.BITS | symbol
    return out


def test_probabilities_against_brute_force(spark, small):
    brute = Brute([w for _, t, _ in TEXTS for w in (t or "").split()])
    model = kneser_ney.train(kneser_ney.count_grams(small, "test-grams"), "test-model")
    draw = np.random.default_rng(3)
    asked = set(brute.levels[-1]) | {tuple(draw.integers(0, 30, 4).tolist()) for _ in range(200)}
    asked |= {(*g[:3], 5) for g in list(brute.levels[-1])[:50]}
    table = spark.createDataFrame([(key(g),) for g in asked], "key long")
    got = {r.key: r.p for r in kneser_ney.probabilities(table, model).collect()}
    arrays = kneser_ney.HashArrays(model)
    for gram in asked:
        want = brute.p(gram)
        assert got[key(gram)] == pytest.approx(want, rel=1e-9)
        assert arrays.p(np.array([key(gram)]))[0] == pytest.approx(want, rel=1e-5)


def test_perplexities_against_brute_force(spark, small):
    """Those of the rules, whose model knows all prose, and of the classifier, whose model knows trusted texts."""
    prose = [w for _, t, _ in TEXTS if quality_rules.is_prose((t or "").encode(), (t or "").encode().split()) for w in t.split()]
    brute = Brute(prose)
    for r in quality_rules.judge(small).collect():
        words = dict((i, t or "") for i, t, _ in TEXTS)[r.doc_id].split()
        if not words:
            assert r.log_perplexity is None
            continue
        want = -brute.log(words) / (sum(map(len, words)) + len(words))
        assert r.log_perplexity == pytest.approx(want, rel=1e-4)
    trusted = spark.createDataFrame([(1,), (2,), (2,), (None,)], "doc_id long")
    brute = Brute([w for i, t, _ in TEXTS if i in (1, 2) for w in t.split()])
    for r in quality_model.classify(small, trusted).collect():
        words = dict((i, t or "") for i, t, _ in TEXTS)[r.doc_id].split()
        if words:
            assert r.log_perplexity == pytest.approx(-brute.log(words) / (sum(map(len, words)) + len(words)), rel=1e-4)


def test_compressed_lengths_are_those_of_the_library():
    ordinary = ["the quiet river runs past the old mill and the garden " * 3] * 40
    toxic = ["the quiet blargh river snorf runs past " * 3] * 40
    dictionaries = toxicity.train_dictionaries(toxic, ordinary)
    lengths = toxicity.Lengths(dictionaries)
    for word in (b"blargh", b"river", b"x", b"snorfblargh" * 9, "é".encode()):
        window = (b" " + word) * toxicity.REPEAT + b" "
        want = min(len(word), 20)
        for data in dictionaries:
            compressor = zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(data), level=toxicity.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            want = want << 8 | min(len(compressor.compress(window)), 255)
        assert lengths.cell(word) == want
    assert lengths.cell(b"") == 0
    # A toxic word is shorter under the dictionaries of toxic text than under that of ordinary text.
    cell = lengths.cell(b"blargh")
    assert min(cell & 255, cell >> 8 & 255) < cell >> 16 & 255


def test_the_first_rows_are_cut_off_before_they_are_sorted(spark, monkeypatch):
    """As a plain top-k gives them; few more than are asked for meet in one place, whatever the number of partitions."""
    rows = spark.range(0, 20_000, 1, 16).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 7).alias("text"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("text")]
    sorted_, limit = [], toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, label: sorted_.append(df) or limit(df, label))
    for most in (1, 500, 19_999, 30_000):
        got = toxicity._first(rows, order, most, "first").orderBy(*order).collect()
        assert got == rows.orderBy(*order).limit(most).collect()
    plan = sorted_[1]._jdf.queryExecution().optimizedPlan()
    assert "Filter" in plan.toString() and toxicity._first(rows.limit(0), order, 5, "first").count() == 0


def test_toxicity_samples_are_all_that_the_driver_gets(spark, tmp_path, monkeypatch):
    """Each selection of texts by hash is cut off first."""
    docs = spark.createDataFrame([(i, "blargh snorf" if i % 4 == 0 else f"river mill {i}") for i in range(120)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, toxic int")
    asked, first = [], toxicity._first
    monkeypatch.setattr(toxicity, "_first", lambda rows, order, most, label: asked.append(most) or first(rows, order, most, label))
    assert toxicity.score(spark.read.parquet(str(tmp_path / "documents.parquet")), marks).count() == 120
    assert asked == [toxicity.TOXIC_DOCS, toxicity.ORDINARY_DOCS, toxicity.CALIBRATION_DOCS]


def test_toxicity_scores_against_brute_force(spark, tmp_path):
    """Cells counted once per document, their ratios, and the logistic curve over the two largest."""
    draw = np.random.default_rng(2)
    texts = {
        i: " ".join(draw.choice(["river", "mill", "garden", "stone", "walks", "slowly"], 30)) + (" blargh snorf" if i % 4 == 0 else "")
        for i in range(240)
    }
    docs_path, labels_path = str(tmp_path / "documents.parquet"), str(tmp_path / "labels.parquet")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2).write.parquet(docs_path)
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in texts], "doc_id long, toxic int").write.parquet(labels_path)
    seen = []
    train = toxicity.train_dictionaries
    toxicity.train_dictionaries = lambda *a: seen.append(train(*a)) or seen[-1]
    try:
        rows = {r.doc_id: r for r in toxicity.score(spark.read.parquet(docs_path), spark.read.parquet(labels_path)).collect()}
    finally:
        toxicity.train_dictionaries = train
    import zlib

    learn = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    lengths = toxicity.Lengths(seen[0])
    cells = {i: {lengths.cell(toxicity.plain(w)) for w in t.encode().split()} for i, t in texts.items()}
    totals = Counter(i % 4 == 0 for i in learn)
    counts = {kind: Counter(c for i in learn if (i % 4 == 0) == kind for c in cells[i]) for kind in (True, False)}
    ratio = {
        c: math.log((counts[True][c] + 0.1) / (totals[True] + 0.2)) - math.log((counts[False][c] + 1) / (totals[False] + 2))
        for c in counts[True] | counts[False]
    }
    features = {}
    for i, t in texts.items():
        words = set(t.encode().split())
        top = sorted((ratio.get(lengths.cell(toxicity.plain(w)), 0.0) for w in words), reverse=True)
        features[i] = (top[0], top[1], math.log1p(len(words)))
    weights = toxicity._logistic(np.array([features[i] for i in learn]), np.array([float(i % 4 == 0) for i in learn]))
    for i, row in rows.items():
        want = 1 / (1 + math.exp(-float(np.dot(weights[:3], features[i]) + weights[3])))
        assert row.score == pytest.approx(want, rel=1e-6, abs=1e-9)
        assert row.held_out == (i not in learn) and row.predicted == int(want >= 0.7)


def brute_words(texts, learned):
    """Log perplexities of texts under the word model of the learned ones: three words, level by level."""
    def grams(text):
        words = ["", "", *text.split()]
        return [tuple(words[k - 2 : k + 1]) for k in range(2, len(words))]

    level, levels = Counter(g for t in learned for g in grams(t)), []
    for _ in range(3):
        levels.insert(0, level)
        level = Counter(g[1:] for g in level)
    of = [defaultdict(list) for _ in levels]
    for own, counts in zip(of, levels):
        for gram, n in counts.items():
            own[gram[:-1]].append(n)

    def p(gram):
        out = 1 / (len(levels[0]) + 1)
        for order, (counts, own) in enumerate(zip(levels, of), 1):
            d, mine = discounts(counts), gram[3 - order :]
            if context := own.get(mine[:-1]):
                n = counts.get(mine, 0)
                off = d[min(n, 3) - 1] if n else 0
                out = (n - off + sum(d[min(c, 3) - 1] for c in context) * out) / sum(context)
        return out

    return {t: -sum(math.log(p(g)) for g in grams(t)) / len(t.split()) for t in texts}


PROSE = ["the cat sat on the mat and", "the dog sat by the old mill", "a cat and a dog sat by the mat", "mill and mat and cat"]


def test_word_perplexities_against_brute_force(spark):
    """Each text by the texts of the other fold; words, their order and copies across lines count."""
    draw = np.random.default_rng(5)
    texts = [" ".join(draw.choice(" ".join(PROSE).split(), 30)) + " " + PROSE[i % 4] for i in range(12)]
    texts += [texts[0].replace(" ", "\n", 3), "the\ncat #### sat | 2 | ON THE MAT"]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[1], "", None]], "text string").withColumn("text_hash", F.xxhash64("text"))
    fold = {r.text: r.text_hash % 2 for r in rows.collect() if r.text}
    for known in (set(texts), set(texts[:9])):
        found = word_model.perplexities(rows, F.col("text").isin(sorted(known)), "test-words")
        got = {r.text: r.word_log_perplexity for r in found.join(rows.distinct(), "text_hash").collect()}
        want = {}
        for k in (0, 1):
            learned = [t for t in [*texts, texts[1]] if t in known and fold[t] != k]
            want |= brute_words([t for t in fold if fold[t] == k], learned)
        assert set(got) == set(fold)
        for t in fold:
            assert got[t] == pytest.approx(want[t], rel=1e-5), t


def test_grams_are_held_shard_by_shard(spark, monkeypatch):
    """No table has all grams at once, and the shards add up to what one shard finds."""
    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 60, 200)) for _ in range(40)]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[0], "", None]], "text string").withColumn("text_hash", F.xxhash64("text"))
    known = F.xxhash64("text", F.lit(1)) % 3 != 0
    whole = sorted(map(tuple, word_model.perplexities(rows, known, "one-shard").collect()))
    held = Counter()
    write = word_model.materialize
    monkeypatch.setattr(word_model, "SHARD_BYTES", 1)
    monkeypatch.setattr(word_model, "SHARDS", 4)
    monkeypatch.setattr(word_model, "materialize", lambda df, label: held.update([(label, (out := write(df, label)).count())]) or out)
    parts = sorted(map(tuple, word_model.perplexities(rows, known, "shards").collect()))
    assert parts == whole and len(whole) == len(texts)
    grams = [n for label, n in held.elements() if label == "shard-grams"]
    different = {tuple(g) for t in texts for g in zip(["", "", *t.split()], ["", *t.split()], t.split())}
    assert len(grams) == 4 and sum(grams) == len(different) and max(grams) < len(different) / 2


def test_many_trusted_texts_are_shuffled_once(spark, tmp_path, monkeypatch):
    """With more trusted ids than are broadcast, texts meet them in one query, and the scores are the same."""
    draw = np.random.default_rng(9)
    texts = [(i % 50, " ".join(draw.choice(" ".join(PROSE).split(), 30)), "en") for i in range(60)] + [(None, "the cat", None), (3, "", "en")]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs, trusted = spark.read.parquet(str(tmp_path / "documents.parquet")), spark.range(30).toDF("doc_id")
    want = sorted(map(tuple, quality_model.classify(docs, trusted).collect()), key=str)
    labels, write = [], quality_model.materialize
    monkeypatch.setattr(quality_model, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(quality_model, "join_small", partial(common.join_small, most=10))
    monkeypatch.setattr(quality_model, "materialize", lambda df, label: labels.append(label) or write(df, label))
    assert sorted(map(tuple, quality_model.classify(docs, trusted).collect()), key=str) == want and len(want) == len(texts)
    assert labels.count("marked-texts") == 1


def test_words_and_pairs_are_not_broadcast(spark, monkeypatch):
    """Their tables grow with the texts, and Spark takes them for as small as their files."""
    draw = np.random.default_rng(8)
    texts = [" ".join(draw.choice(["in", "the", *(f"w{i}" for i in range(300))], 120, p=[0.2, 0.2, *[0.002] * 300])) for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("text_hash", F.xxhash64("text"))
    monkeypatch.setattr(word_model, "CELL_BYTES", 2048)
    plans, score = [], word_model._scored

    def watch(*a):
        plans.append((out := score(*a))._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(word_model, "_scored", watch)
    assert word_model.perplexities(rows, F.lit(True), "plans").count() == len(texts)
    assert plans and not any("Broadcast" in p for p in plans) and all(p.count("SortMergeJoin") >= 2 for p in plans)


def test_frequent_words_are_spread_over_cells(spark, monkeypatch):
    """No cell has all grams of a word or of a pair of words that stands everywhere; the results are those of one cell."""
    draw = np.random.default_rng(7)
    texts = [" ".join(draw.choice(["in", "the", "in the", *(f"w{i}" for i in range(300))], 120, p=[0.1, 0.1, 0.2, *[0.002] * 300])) for _ in range(60)]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[0], "", None]], "text string").withColumn("text_hash", F.xxhash64("text"))
    known = F.xxhash64("text", F.lit(1)) % 3 != 0
    whole = sorted(map(tuple, word_model.perplexities(rows, known, "one-cell").collect()))
    deals, largest = [], []
    make, write = word_model._deal, word_model.materialize

    def watch(df, label):
        out = write(df, label)
        if label == "shard-grams":
            largest.extend(r["count"] for r in out.groupBy("cell").count().collect())
        return out

    monkeypatch.setattr(word_model, "CELL_BYTES", 2048)
    monkeypatch.setattr(word_model, "SHARD_BYTES", 1 << 13)
    monkeypatch.setattr(word_model, "_deal", lambda rows: deals.append(make(rows)) or deals[-1])
    monkeypatch.setattr(word_model, "materialize", watch)
    parts = sorted(map(tuple, word_model.perplexities(rows, known, "cells").collect()))
    assert parts == whole and len(whole) == len(texts)
    assert len(deals[0].words) >= 2 and len(deals[0].pairs) >= 1
    grams = [g for t in texts for g in zip(["", "", *t.split()], ["", *t.split()], t.split())]
    assert max(largest) < max(Counter(g[1] for g in set(grams)).values())


@pytest.fixture(scope="module")
def chains(spark, tmp_path_factory):
    """Sentences whose words follow each other in few ways, and the same words out of order."""
    draw, rows = np.random.default_rng(1), []
    for i in range(160):
        words = [f"word{10 * start + k}" for start in draw.permutation(200)[:12] for k in range(10)]
        rows.append((i, " ".join(words), "en"))
    for i in range(160, 166):
        rows.append((i, " ".join(draw.permutation(rows[i - 160][1].split())), "en"))
    path = str(tmp_path_factory.mktemp("chains") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def test_words_out_of_order_fail(spark, chains):
    trusted = spark.range(160).select(F.col("id").alias("doc_id"))
    good = {r.doc_id: r.good for r in quality_model.classify(chains, trusted).collect()}
    kept = {r.doc_id: r.kept for r in quality_rules.rate_documents(chains).collect()}
    for verdict in (good, kept):
        taken = {i for i, v in verdict.items() if v}
        assert max(taken) < 160 and len(taken) > 120
