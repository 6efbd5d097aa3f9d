"""Classifiers as tables, the forest's bounded width, the comparison, and languages of short texts."""

import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from guestlens.catalog import queries, views
from guestlens.functions import vocabulary
from guestlens.operators import language, sampling, sentiment
from guestlens.plans import compare, inspect, recommend
from guestlens.session import materialize, new_path


@pytest.fixture(scope="module")
def reviews(spark):
    """Labels follow from two words among many that say nothing."""
    rows = []
    for i in range(600):
        good = i * 7919 % 10 < 6
        noise = " ".join(f"w{(i * k) % 211}" for k in range(1, 12))
        rows.append((i, f"h{i % 17}", "ABC"[i % 3], f"title w{i % 5}", f"{noise} {'lovely' if good else 'dirty'}", "positive" if good else "negative", None))
    schema = "comment_id long, name string, locality string, title string, text string, review string, service double"
    return materialize(spark.createDataFrame(rows, schema), "test-reviews")


def test_linear_model_as_a_table(spark, reviews, duck):
    """The same labels and margins as the estimator; the same by SQL over the stored weights."""
    model = recommend.train_for_city(reviews, "A", "svc")
    path = new_path(spark, "weights")
    sentiment.linear_terms(model).write.parquet(path)
    rows = sampling.split_by_city(reviews, "A")[1]
    odd = spark.createDataFrame([(9001, None, ""), (9002, None, "unseenword"), (9003, "x", "lovely lovely dirty")], rows.schema)
    rows = materialize(rows.unionByName(odd), "asked")
    got = {r.comment_id: r for r in sentiment.score_linear(rows, spark.read.parquet(path)).collect()}
    want = sentiment.score(model, rows).collect()
    assert len(got) == len(want) == rows.count()
    for r in want:
        assert got[r.comment_id].predicted_review_label == r.predicted_review_label
        assert got[r.comment_id].margin == pytest.approx(r.rawPrediction[1], abs=1e-9)
    folder = path.removeprefix("file://").removeprefix("file:")
    asked = sentiment._terms(rows.select("comment_id", "review_text"), None).select("comment_id", "term")
    terms = new_path(spark, "terms")
    asked.write.parquet(terms)
    terms = terms.removeprefix("file://").removeprefix("file:")
    twin = duck.execute(f"""
        SELECT comment_id, sum(weight) + (SELECT sum(weight) FROM '{folder}/*.parquet' WHERE term IS NULL) AS margin
        FROM '{terms}/*.parquet' JOIN '{folder}/*.parquet' USING (term) GROUP BY comment_id""").fetchall()
    assert len(twin) > 100 and all(got[i].margin == pytest.approx(m, abs=1e-9) for i, m in twin)


def test_svc_scored_is_the_estimator(spark, sf):
    mine = {r.comment_id: r.predicted_review_label for r in queries.QUERIES["svc_scored"](spark, sf).collect()}
    theirs = {r.comment_id: r.predicted_review_label for r in queries.QUERIES["svc_predict"](spark, sf).collect()}
    assert mine == theirs and len(mine) > 10


def test_telling_terms(spark, reviews):
    train = recommend.training_rows(reviews, "A")
    terms = [r.term for r in sentiment.telling_terms(train, 2).collect()]
    assert sorted(terms) == ["dirty", "lovely"]
    n = train.count()
    a = train.where("review = 'positive' AND review_text LIKE '%w3 %'").count()
    found = {r.term: r.score for r in sentiment.telling_terms(train, 10_000).collect()}
    assert found["dirty"] == pytest.approx(n) and all(v <= n + 1e-6 for v in found.values()) and a >= 0


def test_forest_is_narrow_and_better_than_the_majority(spark, reviews):
    model = recommend.train_for_city(reviews, "A", "rf", numTrees=10, maxDepth=5)
    vectorizer = next(s for s in model.stages if hasattr(s, "vocabulary"))
    assert len(vectorizer.vocabulary) <= sentiment.FOREST_TERMS
    narrow = recommend.train_for_city(reviews, "A", "rf", numTrees=10, maxDepth=5, vocab_size=8)
    assert len(next(s for s in narrow.stages if hasattr(s, "vocabulary")).vocabulary) == 8
    rows = sampling.split_by_city(reviews, "A")[1]
    for m in (model, narrow):
        scored = sentiment.score(m, rows)
        n, right, positive = scored.select(
            F.count("*"), F.count_if(F.col("review") == F.col("predicted_review_label")), F.count_if(F.col("review") == "positive")
        ).first()
        assert right > 1.2 * max(positive, n - positive)


@pytest.fixture
def fitted(monkeypatch):
    """What forests are fitted to: the number of rows, and of rows that are looked at for thresholds."""
    seen, fit = [], RandomForestClassifier._fit

    def recorded(self, rows):
        seen.append((n := rows.count(), min(n, max(self.getMaxBins() ** 2, sentiment.SPLIT_ROWS))))
        return fit(self, rows)

    monkeypatch.setattr(RandomForestClassifier, "_fit", recorded)
    return seen


def test_forest_learns_from_every_row(spark, reviews, fitted, monkeypatch):
    """A bound on its rows, which there was, samples nothing; thresholds are looked for in all rows."""
    monkeypatch.setattr(sentiment, "FOREST_ROWS", 50, raising=False)
    train = materialize(recommend.training_rows(reviews, "A"), "train")
    n = train.count()
    sentiment.fit(train, "rf", numTrees=1, maxDepth=1)
    assert fitted == [(n, n)] and n > 100
    many = train.crossJoin(spark.range(10_001 // n + 1)).withColumn("comment_id", F.monotonically_increasing_id())
    sentiment.fit(materialize(many, "many"), "rf", numTrees=1, maxDepth=1, vocab_size=4)
    assert fitted[1] == (many.count(),) * 2 and fitted[1][0] > 10_000


def test_forest_is_compared_on_every_row(reviews, fitted, monkeypatch):
    monkeypatch.setattr(sentiment, "FOREST_ROWS", 50, raising=False)
    compare.compare_models(reviews, "A", ["rf"], {"rf": {"numTrees": 1, "maxDepth": 1}}).collect()
    assert fitted == [(compare.evaluation_sets(reviews, "A")[compare.TRAINING].count(),) * 2] and fitted[0][0] > 100


def test_compare_models(spark, reviews):
    options = {"rf": {"numTrees": 5, "maxDepth": 4}}
    rows = compare.compare_models(reviews, "A", options=options).collect()
    assert {(r.Model, r["Prediction Data"]) for r in rows} == {
        (m, d) for m in sentiment.MODEL_NAMES.values() for d in (compare.TRAINING, compare.VALIDATION, compare.PREDICTION)
    }
    assert all(r.Accuracy > 0.9 and 0 <= r["False Positive Rate"] <= 0.2 for r in rows if r.Model != sentiment.MODEL_NAMES["rf"])


def test_menu_entries(spark, reviews):
    scored = recommend.predict_city(reviews, "A").collect()
    assert len(scored) == 200 and sum(r.review == r.predicted_review_label for r in scored) > 190
    assert [tuple(r) for r in inspect.hotel_list(reviews, "A").orderBy("number").limit(2).collect()] == [(1, "h0"), (2, "h1")]
    cards = reviews.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                  [("hotel_class", "double"), ("street_address", "string"), ("region", "string"), ("url", "string")]])
    lines = inspect.hotel_report(cards, "h3", "A").orderBy("line_no").collect()
    assert len(lines) == 9 and "h3" in lines[2].line


SENTENCES = {
    "en": "the room was very clean and we were happy with it", "de": "das Zimmer war sehr sauber und wir waren damit zufrieden",
    "fr": "la chambre est propre et nous avons aimé ce petit hôtel", "es": "la habitación era muy buena pero también un poco cara",
    "it": "la camera era molto bella ma il servizio non era buono", "pt": "o quarto era muito bom mas não gostei do serviço também",
    "nl": "de kamer was heel schoon en wij waren er zeer tevreden mee", "sv": "rummet var mycket fint och vi är inte missnöjda med det",
    "fi": "huone oli siisti ja me olimme siihen että tämä on hyvä mutta kallis", "hu": "a szoba nagyon szép volt és mi is azt hogy ez egy jó hely",
    "ru": "номер был очень хороший и мы не были против этого", "tr": "oda çok temizdi ve biz bu otel için hiç ama hiç",
}


def test_fourteen_languages(spark):
    assert len(vocabulary.default_profiles()) == 14
    from pyspark.ml.feature import StopWordsRemover

    for code, name in vocabulary.SPARK_LANGUAGES.items():
        assert vocabulary.spark_profiles(code)[code] == list(dict.fromkeys(StopWordsRemover.loadDefaultStopWords(name)))
    df = spark.createDataFrame(list(SENTENCES.items()), "lang string, title string")
    assert {r.lang: r.language for r in language.with_language(df).collect()} == {k: k for k in SENTENCES}


def test_accuracy_on_texts_and_titles(spark, sf):
    """Function words on whole texts; letter grams, learned from other rows, on first lines."""
    texts = language.with_language(views.documents(spark, sf), "text").where("lang IS NOT NULL")
    assert texts.where("lang = language").count() > 0.95 * texts.count()
    titles = queries.QUERIES["title_language"](spark, sf).where("lang IS NOT NULL")
    _, test = sampling.random_split(titles)
    assert test.where("lang = language").count() > 0.93 * test.count()
    by_words = language.with_language(
        views.documents(spark, sf).select(F.col("doc_id").alias("comment_id"), "lang", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title")), "title"
    )
    assert titles.where("lang = language").count() > by_words.where("lang = language").count()


def test_gram_language_of_odd_rows(spark):
    labelled = spark.createDataFrame([("aa", "abab abab"), ("bb", "cdcd cdcd"), (None, "zz"), ("aa", None)], "lang string, text string")
    profiles = materialize(language.gram_profiles(labelled), "profiles")
    rows = spark.createDataFrame([(1, "ABAB!"), (2, "cdcd"), (3, None), (4, "123"), (5, "xyz")], "id long, title string")
    got = {r.id: r.language for r in language.with_gram_language(rows, profiles, "id").collect()}
    assert got == {1: "aa", 2: "bb", 3: None, 4: None, 5: None}
    nothing = materialize(language.gram_profiles(labelled.limit(0)), "profiles")
    assert language.with_gram_language(rows, nothing, "id").where("language IS NOT NULL").count() == 0


def test_a_city_of_texts_is_read_by_many_tasks(spark, sf, monkeypatch):
    """Row groups have the size asked for, so files of one city are split."""
    monkeypatch.setattr(queries, "TEXT_ROW_GROUP", 1 << 10, raising=False)
    rows = spark.read.parquet(f"{sf}/documents.parquet").limit(1).crossJoin(spark.range(2000))
    rows = rows.select(F.col("id").alias("doc_id"), F.concat("text", F.col("id").cast("string")).alias("text"), F.lit("source5").alias("source"), "lang")
    monkeypatch.setattr(queries.views, "table", lambda *_: rows.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")))
    monkeypatch.setattr(queries.views, "documents", lambda *_: rows)
    files = queries._text_rows(spark, sf).inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert sum(g.num_rows for g in groups) == 2000 and sum(g.num_row_groups for g in groups) > 5 * len(files)


def test_gram_languages_count_nothing_per_text(spark):
    """Repeated grams weigh as often as they stand; the only group is the text, whose state has a fixed size."""
    profiles = language.gram_profiles(spark.createDataFrame([("the cat sat", "en"), ("le chat dort", "fr")], "text string, lang string"))
    profiles = materialize(profiles, "test-profiles")
    rows = spark.createDataFrame([(1, "the the the le"), (2, "le le chat the"), (3, ""), (4, None)], "id long, title string")
    found = language.with_gram_language(rows, profiles, "id")
    assert {r.id: r.language for r in found.collect()} == {1: "en", 2: "fr", 3: None, 4: None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [id" in line and "gram" in line.split("]")[0]]
