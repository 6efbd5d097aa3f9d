"""Operators on small frames, one hazard each."""

from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from guestlens import schemas
from guestlens.operators import (
    browse,
    filters,
    joins,
    language,
    metrics,
    ranking,
    reports,
    sampling,
    sentiment,
    shape,
    words,
)
from guestlens.plans import etl


def rows(df, *columns):
    return sorted([tuple(r[c] for c in columns or df.columns) for r in df.collect()], key=str)


def reviews(spark, data):
    return spark.createDataFrame(data, "name string, predicted_review_label string, service double")


# Filters and splits


def test_city_split_covers_all_rows(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "locality string")
    assert rows(filters.in_city(df, "A")) == [("A",)]
    assert rows(filters.outside_city(df, "A")) == [("B",), (None,)]


def test_keep_unknown_language(spark):
    df = spark.createDataFrame([("en",), ("fr",), (None,)], "language string")
    assert language.keep_language(df).count() == 1
    assert language.keep_language(df, keep_unknown=True).count() == 2


def test_same_name_in_two_cities(spark):
    df = spark.createDataFrame([("H", "A"), ("H", "B")], "name string, locality string")
    assert filters.of_hotel(df, "H").count() == 2
    assert filters.of_hotel(df, "H", "A").count() == 1


def test_any_null(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert df.agg(filters.any_null(F.col("x"))).first()[0] is True
    assert df.na.drop().agg(filters.any_null(F.col("x"))).first()[0] is False


# Joins


def test_repeated_ids_multiply_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "comment_id long, v string")
    ids = spark.createDataFrame([(1,), (1,)], "comment_id long")
    assert rows(joins.keep_listed(df, ids)) == [(1, "a")]
    predictions = ids.withColumn("prediction", F.lit(0.0))
    assert rows(joins.join_predictions(df, predictions)) == [(1, "a", 0.0)]


@pytest.mark.parametrize("hot_rows", [1, 100, 10**6])
def test_group_totals_with_and_without_hot_groups(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    data = [("hot", i) for i in range(300)] + [(f"h{i % 40}", i) for i in range(400)] + [(None, 1)]
    df = spark.createDataFrame(data, "name string, x long").repartition(4)
    got = joins.with_group_totals(df, "name", {"n": F.count("*"), "total": F.sum("x")})
    counts, sums = Counter(n for n, _ in data), Counter()
    for name, x in data:
        sums[name] += x
    want = sorted([(n, x, counts[n], sums[n]) for n, x in data if n is not None], key=str)
    assert rows(got) == want


def test_hot_rows_enter_no_shuffle(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 10_000)
    df = spark.range(100_000, numPartitions=8).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("name"), "id")
    got = joins.with_group_totals(df, "name", {"n": F.count("*")})
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) <= 2 * 100_000 / 8
    assert got.where("name = 'hot' AND n = 90000").count() == 90_000


def test_split_of_a_sample_holds_both_classes(spark):
    df = spark.range(4000).select(F.col("id").alias("comment_id"), F.when(F.col("id") % 5 > 0, "positive").otherwise("negative").alias("review"))
    for part, share in zip(sampling.random_split(sampling.balance(df)), (0.8, 0.2)):
        n = dict(part.groupBy("review").count().collect())
        assert abs(n["negative"] - 800 * share) < 60 and abs(n["positive"] - 3200 * 0.3 * share) < 80


def test_skewed_key_join_is_split(spark):
    """Sort-merge joins of raw tables leave hot keys to AQE."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(200000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("offering_id"), F.col("id").alias("v")
        )
        dim = spark.range(1000).select(F.col("id").alias("offering_id"), F.lit("n").alias("name"))
        merged = joins.merge_reviews_offerings(facts, dim)
        assert merged.count() == 200000
        merged.write.format("noop").mode("overwrite").save()
        merged.collect()
        assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


# Shape


def test_flatten_keeps_clashing_names_apart(spark):
    df = spark.createDataFrame([(1, (2, "x"))], "id long, author struct<id: long, name: string>")
    assert shape.flatten(df, "author", "author_").columns == ["id", "author_id", "author_name"]


def test_etl_schema(spark):
    raw = spark.createDataFrame([], schemas.REVIEWS_RAW)
    hotels = spark.createDataFrame([], schemas.OFFERINGS_RAW)
    merged = etl.merged_reviews(raw, hotels)
    assert len(merged.columns) == len(set(merged.columns))
    clean = etl.cleaned_reviews(merged)
    assert not set(etl.UNUSED_COLUMNS) & set(clean.columns)
    assert {"month_stayed", "review", "title", "text", "comment_id", *schemas.CATEGORIES} <= set(clean.columns)


# Samples


def frame(spark, positives, negatives):
    data = [(i, "positive") for i in range(positives)] + [(positives + i, "negative") for i in range(negatives)]
    return spark.createDataFrame(data, "comment_id long, review string")


def test_fraction_is_clamped(spark):
    """1 positive among 20 negatives asks for more than all positives."""
    assert sampling.balance(frame(spark, 1, 20)).count() == 21


def test_balance_keeps_negatives_and_samples_positives(spark):
    kept = Counter(r["review"] for r in sampling.balance(frame(spark, 8000, 2000)).collect())
    assert kept["negative"] == 2000
    assert abs(kept["positive"] - 8000 * 0.3) < 200


@pytest.mark.parametrize("positives, negatives", [(5000, 700), (30, 400), (0, 5), (5, 0), (8, 8)])
def test_exact_balance(spark, positives, negatives):
    df = frame(spark, positives, negatives)
    kept = sampling.balance_exact(df)
    counts = Counter(r["review"] for r in kept.collect())
    smallest = min(positives, negatives)
    assert counts == Counter({k: smallest for k in ("positive", "negative") if smallest})
    assert rows(kept) == rows(sampling.balance_exact(df.repartition(3)))


def test_exact_balance_ranks_inside_one_bucket(spark, monkeypatch):
    """Rows of equal hash bucket are cut by rank, so no bucket is all or nothing."""
    monkeypatch.setattr(sampling, "id_hash", lambda key, seed: F.col(key))
    kept = sampling.balance_exact(frame(spark, 900, 100))
    assert Counter(r["review"] for r in kept.collect()) == {"positive": 100, "negative": 100}
    assert max(r["comment_id"] for r in kept.where("review = 'positive'").collect()) == 99


def test_split_is_repeatable_and_disjoint(spark):
    df = frame(spark, 3000, 2000)
    train, test = sampling.random_split(df)
    again, _ = sampling.random_split(df.repartition(7))
    ids = {r["comment_id"] for r in train.collect()}
    assert ids == {r["comment_id"] for r in again.collect()}
    assert ids.isdisjoint(r["comment_id"] for r in test.collect())
    assert len(ids) + test.count() == 5000
    assert abs(len(ids) - 4000) < 150


# Rankings


def test_top_hotels_ties_by_name_and_skips_nameless(spark):
    data = [("b", "positive", None), ("a", "positive", None), (None, "positive", None), ("c", "negative", None)]
    top = ranking.top_hotels(reviews(spark, data), 2)
    assert rows(top, "rank", "name", "review_count", "positive_counts") == [(1, "a", 1, 1), (2, "b", 1, 1)]


def test_category_score_modes(spark):
    """Scores 5 and 1 of a hotel, global mean 3: (2*5 + 30) / 12 and 3."""
    df = reviews(spark, [("h", "positive", 5.0), ("h", "negative", 1.0), ("g", "positive", 3.0)])
    best = {r["name"]: r["weighted_avg"] for r in ranking.category_scores(df, "service").collect()}
    mean = {r["name"]: r["weighted_avg"] for r in ranking.category_scores(df, "service", "mean").collect()}
    assert best["h"] == pytest.approx(40 / 12) and mean["h"] == pytest.approx(3.0)
    with pytest.raises(ValueError):
        ranking.category_scores(df, "service", "median")


def test_missing_scores_come_from_the_label(spark):
    df = reviews(spark, [("h", "positive", None), ("h", "negative", float("nan")), ("h", None, None)])
    assert rows(ranking.impute_category(df, "service"), "service") == [(2.0,), (4.0,), (None,)]


def test_hotel_without_any_score_comes_last(spark):
    df = reviews(spark, [("a", None, None), ("b", "negative", None)])
    top = ranking.top_by_category(df, "service")
    assert [r["name"] for r in top.orderBy("rank").collect()] == ["b", "a"]


def test_ranking_does_not_depend_on_row_order(spark):
    data = [(f"h{i % 13}", "positive" if i % 3 else "negative", float(i % 5) or None) for i in range(400)]
    df = reviews(spark, data)
    for rank in (ranking.top_hotels, lambda d: ranking.top_by_category(d, "service")):
        assert rows(rank(df)) == rows(rank(df.orderBy(F.rand(1)).repartition(5)))


def test_smoothed_mean_lies_between(spark):
    data = [(f"h{i % 7}", "positive", float(1 + i * i % 5)) for i in range(200)]
    df = reviews(spark, data)
    total = sum(d[2] for d in data) / len(data)
    for r in ranking.category_scores(df, "service", "mean").collect():
        own = [d[2] for d in data if d[0] == r["name"]]
        low, high = sorted([sum(own) / len(own), total])
        assert low - 1e-9 <= r["weighted_avg"] <= high + 1e-9


def test_category_scan_is_shared(spark, tmp_path):
    """The global mean reuses the ranking's shuffle: reviews are scanned once."""
    reviews(spark, [(f"h{i % 7}", "positive", 1.0) for i in range(50)]).write.parquet(str(tmp_path / "r"))
    top = ranking.top_by_category(spark.read.parquet(str(tmp_path / "r")), "service")
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


# Browsing and reports


def test_pages_and_numbers(spark):
    df = spark.createDataFrame([(f"h{i:02}", "A") for i in range(45)] * 2, "name string, locality string")
    assert rows(browse.hotel_page(df, "A", 2)) == [(41 + i, f"h{40 + i}") for i in range(5)]
    assert browse.hotel_page(df, "A", 3).count() == 0
    assert rows(browse.hotel_at(df, "A", 41)) == [("h40",)]
    assert browse.hotel_at(df, "A", 0).count() == browse.hotel_at(df, "A", 46).count() == 0


SAMPLE = """\
Rank  Hotel Name                                   Total Reviews Positive Reviews
----------------------------------------------------------------------------------------------
1     Sofitel Philadelphia Hotel                   177          150             
2     Philadelphia Marriott Downtown               167          145             
3     Loews Philadelphia Hotel                     163          132             
4     Hotel Palomar Philadelphia - a Kimpton Hotel 132          125             
5     Courtyard Philadelphia Downtown              119          111             """.split("\n")


def test_report_layout(spark):
    names = [line[6:50].strip() for line in SAMPLE[2:]]
    counts = [(177, 150), (167, 145), (163, 132), (132, 125), (119, 111)]
    top = spark.createDataFrame(
        [(i + 1, n, a, b) for i, (n, (a, b)) in enumerate(zip(names, counts))],
        "rank long, name string, review_count long, positive_counts long",
    )
    assert [r["line"] for r in reports.top_report(top).orderBy("line_no").collect()] == SAMPLE


def test_category_report_layout(spark):
    top = spark.createDataFrame(
        [(1, "Inn", 4.256, 12, 7)], "rank long, name string, weighted_avg double, review_count long, positive_counts long"
    )
    lines = [r["line"] for r in reports.category_report(top, "rooms").orderBy("line_no").collect()]
    assert lines == [
        f"{'Rank':<5} {'Hotel Name':<3} {'Avg Rooms Score':<22} {'Total Count':<12} {'Positive Reviews':<16}",
        "-" * 53,
        f"{1:<5} {'Inn':<3} {4.26:<22.2f} {12:<12} {7:<16}",
    ]


def test_card(spark):
    df = spark.createDataFrame(
        [(2, "Inn", 4.0, "s2", "c", "r", "u2"), (1, "Inn", 0.0, "s1", "c", "r", "u1")],
        "comment_id long, name string, hotel_class double, street_address string, locality string, region string, url string",
    )
    lines = [r["line"] for r in reports.card_report(browse.hotel_card(df, "Inn")).orderBy("line_no").collect()]
    rule = "-" * 50
    assert lines == [
        "", rule, f"- {'Inn'.center(46)} -", rule, "", "Hotel Class: Not Given stars",
        "Hotel Address: s1, c, r", "Link: u1", "Number of Reviews: 2",
    ]


# Words


TEXTS = ["the Great room, great rooms!", "great room 12 and a class's classes", "rooms b's b 7 great room"]


def brute_terms(texts, stop):
    """Counts of folded words and scored pairs, word by word."""
    import re

    singles, pairs = Counter(), Counter()
    for t in texts:
        ws = [w[:-2] if w.endswith("'s") else w for w in re.findall(r"\w[\w']*", t.lower())]
        ws = [w for w in ws if not w.isdigit()]
        singles.update(w for w in ws if w not in stop)
        pairs.update((a, b) for a, b in zip(ws, ws[1:]) if a not in stop and b not in stop)

    def plural(word, known):
        return word.endswith("s") and not word.endswith("ss") and word[:-1] in known

    form = {w: w[:-1] if plural(w, singles) else w for w in singles}
    folded, folded_pairs = Counter(), Counter()
    for w, n in singles.items():
        folded[form[w]] += n
    for (a, b), n in pairs.items():
        folded_pairs[a, b[:-1] if plural(b, {y for x, y in pairs if x == a}) else b] += n
    total, scores = sum(folded.values()), {}

    def part(k, m, x):
        return log(max(x, 1e-10)) * k + log(max(1 - x, 1e-10)) * (m - k)

    for (a, b), n in folded_pairs.items():
        c1, c2 = folded[form[a]], folded[form[b]]
        if total <= c1 or total <= c2:
            scores[a, b] = 0.0
            continue
        p, p1, p2 = c2 / total, n / c1, (c2 - n) / (total - c1)
        scores[a, b] = -2 * (
            part(n, c1, p) + part(c2 - n, total - c1, p) - part(n, c1, p1) - part(c2 - n, total - c1, p2)
        )
    return singles, folded, folded_pairs, scores, form


def test_words_against_brute_force(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "title string")
    stop = {"the", "and", "a"}
    singles, folded, pairs, scores, form = brute_terms(TEXTS, stop)
    assert dict(rows(words.word_counts(df, "title", stop_words=stop))) == singles
    assert dict(rows(words.folded_counts(df, "title", stop_words=stop))) == folded
    found = {r["word"]: (r["n"], r["score"]) for r in words.collocations(df, "title", stop_words=stop, min_score=-1e9).collect()}
    assert found == {" ".join(k): (pairs[k], pytest.approx(scores[k], abs=1e-9)) for k in pairs}
    want = Counter(folded)
    for (a, b), n in pairs.items():
        if scores[a, b] > 1.0:
            want[f"{a} {b}"] += n
            want[form[a]] -= n
            want[form[b]] -= n
    terms = words.cloud_terms(df, "title", stop_words=stop, min_score=1.0)
    assert dict(rows(terms, "word", "n")) == {w: n for w, n in want.items() if n > 0}


def test_top_words_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "name string, title string")
    top = words.top_words(words.word_counts(df, "title", ["name"]), ["name"])
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


# Metrics


def test_metrics_by_label_name(spark):
    data = [("positive", "positive")] * 6 + [("positive", "negative")] * 2 + [("negative", "positive")] + [("negative", "negative")] * 3
    df = spark.createDataFrame(data, "review string, predicted_review_label string")
    matrix = metrics.confusion_matrix(df)
    assert matrix.agg(F.sum("n")).first()[0] == len(data)
    got = metrics.class_metrics(matrix).first().asDict()
    assert got["Accuracy"] == pytest.approx(9 / 12)
    assert got["Precision"] == pytest.approx(6 / 7)
    assert got["Recall"] == got["True Positive Rate"] == pytest.approx(6 / 8)
    assert got["F1Score"] == pytest.approx(12 / 15)
    assert got["False Positive Rate"] == pytest.approx(1 / 4)


def test_metrics_of_an_absent_class(spark):
    df = spark.createDataFrame([("negative", "negative")], "review string, predicted_review_label string")
    got = metrics.class_metrics(metrics.confusion_matrix(df)).first().asDict()
    assert got["Accuracy"] == 1.0 and got["Precision"] == got["Recall"] == got["F1Score"] == 0.0


def test_metrics_agree_with_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    data = [("positive", "negative")[i % 3 == 0] for i in range(50)], [("positive", "negative")[i % 4 == 0] for i in range(50)]
    df = spark.createDataFrame(list(zip(*data)), "review string, predicted_review_label string")
    got = metrics.class_metrics(metrics.confusion_matrix(df)).first().asDict()
    indexed = df.select(*[
        F.when(F.col(c) == "positive", 0.0).otherwise(1.0).alias(n)
        for c, n in [("review", "label"), ("predicted_review_label", "prediction")]
    ])
    for metric, name in [("accuracy", "Accuracy"), ("precisionByLabel", "Precision"), ("recallByLabel", "Recall"),
                         ("fMeasureByLabel", "F1Score"), ("falsePositiveRateByLabel", "False Positive Rate")]:
        evaluator = MulticlassClassificationEvaluator(metricName=metric, metricLabel=0.0)
        assert got[name] == pytest.approx(evaluator.evaluate(indexed)), metric


# Classifiers


@pytest.fixture(scope="module")
def opinions(spark):
    good = ["great clean room", "lovely stay great staff", "great breakfast lovely view"]
    bad = ["dirty room rude staff", "noisy dirty bad", "rude bad breakfast"]
    data = [(i, "positive", good[i % 3]) for i in range(30)] + [(30 + i, "negative", bad[i % 3]) for i in range(30)]
    return spark.createDataFrame(data, "comment_id long, review string, review_text string")


@pytest.mark.parametrize("kind", ["nb", "rf", "svc"])
def test_classifiers_learn(spark, opinions, kind, tmp_path):
    settings = {"numTrees": 10, "maxDepth": 5} if kind == "rf" else {}
    model = sentiment.fit(opinions, kind, **settings)
    sentiment.save(model, str(tmp_path / kind))
    model = sentiment.load(str(tmp_path / kind))
    scored = sentiment.score(model, opinions)
    assert {"reviewIndexed", "prediction", "predicted_review_label"} <= set(scored.columns)
    assert scored.where("review <> predicted_review_label").count() == 0
    assert scored.where("reviewIndexed <> prediction").count() == 0


def test_unknown_and_missing_labels_are_scored(spark, opinions):
    model = sentiment.fit(opinions)
    new = spark.createDataFrame([(1, "odd", "great stay"), (2, None, "dirty")], opinions.schema)
    got = rows(sentiment.score(model, new), "comment_id", "reviewIndexed", "predicted_review_label")
    assert got == [(1, None, "positive"), (2, None, "negative")]
    assert sentiment.score(model, new.drop("review")).count() == 2


def test_class_index_is_fixed(spark):
    """Negatives in the majority: ``positive`` stays class 0."""
    df = spark.createDataFrame(
        [(1, "negative", "bad"), (2, "negative", "bad"), (3, "positive", "good")],
        "comment_id long, review string, review_text string",
    )
    scored = sentiment.score(sentiment.fit(df), df)
    assert {(r["predicted_review_label"], r["prediction"]) for r in scored.collect()} == {("negative", 1.0), ("positive", 0.0)}


def test_vocabulary_is_the_frequent_terms(spark):
    texts = ["b b b c c a a", "c a d e", "f e d zz"]
    df = spark.createDataFrame([(i, "positive", t) for i, t in enumerate(texts)], "comment_id long, review string, review_text string")
    counts = Counter(w for t in texts for w in t.split())
    best = sorted(counts, key=lambda w: (-counts[w], w))
    for size in (1, 3, 4, 7, 100):
        got = sentiment.frequent_terms(df, size, stop_words=[]).collect()
        assert [(r["term"], r["n"]) for r in got] == [(w, counts[w]) for w in best[:size]]
        assert set(sentiment.fit_vocabulary(df, size, []).vocabulary) == set(best[:size])


def test_empty_tokens_are_terms(spark):
    df = spark.createDataFrame([(1, "positive", "good  stay")], "comment_id long, review string, review_text string")
    assert rows(sentiment.class_term_counts(df), "term") == [("",), ("good",), ("stay",)]


def test_likelihood_ratio_is_compiled(spark):
    """No lambda function in it, which Spark would interpret for each pair of words."""
    counts = [(5, 10, 8, 100), (1, 1, 1, 1), (3, 3, 3, 50), (2, 40, 9, 41)]
    ratio = words.likelihood_ratio(*[F.col(c) for c in ("c12", "c1", "c2", "n")])
    df = spark.createDataFrame(counts, "c12 long, c1 long, c2 long, n long").select("*", ratio.alias("ratio"))
    assert "lambda" not in df._jdf.queryExecution().executedPlan().toString()

    def log_l(k, m, x):
        return log(max(x, 1e-10)) * k + log(max(1 - x, 1e-10)) * (m - k)

    for k, a, b, n, got in df.collect():
        want = 0.0
        if n > a and n > b:
            p, p1, p2 = b / n, k / a, (b - k) / (n - a)
            want = -2 * (log_l(k, a, p) + log_l(b - k, n - a, p) - log_l(k, a, p1) - log_l(b - k, n - a, p2))
        assert got == pytest.approx(want, abs=1e-9)
