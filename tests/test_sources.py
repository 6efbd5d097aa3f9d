"""Readers, writers and the work folder."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from guestlens import schemas, session
from guestlens.catalog.queries import QUERIES
from guestlens.operators import reports
from guestlens.plans import etl, recommend
from guestlens.sources import readers, writers

REVIEW = {
    "ratings": {"overall": 4.0, "service": 5.0, "sleep_quality": 3.0},
    "title": "“Great\nstay”", "text": "The staff was great.\r\nWe loved it, \"really\"!",
    "author": {"id": "A1", "username": "u", "num_cities": 3, "location": "Here"},
    "date_stayed": "July 2012", "offering_id": 7, "num_helpful_votes": 0, "date": "July 3, 2012",
    "id": 101, "via_mobile": False,
}
HOTEL = {
    "hotel_class": 4.0, "region_id": 60763, "url": "http://x/7", "phone": "", "details": None, "type": "hotel",
    "address": {"region": "NY", "street-address": "1 Main", "postal-code": "1", "locality": "New York City"},
    "id": 7, "name": "Inn",
}


def test_json_lines_to_clean_reviews(spark, tmp_path):
    (tmp_path / "review.txt").write_text(json.dumps(REVIEW) + "\n" + json.dumps(REVIEW | {"id": 102, "offering_id": 8}))
    (tmp_path / "offering.txt").write_text(json.dumps(HOTEL))
    clean = etl.build_reviews(
        readers.read_reviews(spark, str(tmp_path / "review.txt")),
        readers.read_offerings(spark, str(tmp_path / "offering.txt")),
        detect_on="text",
    )
    row = clean.collect()
    assert len(row) == 1
    row = row[0].asDict()
    assert row["title"] == "greatstay" and row["text"] == "the staff was greatwe loved it really"
    assert (row["comment_id"], row["name"], row["locality"], row["street_address"]) == (101, "Inn", "New York City", "1 Main")
    assert (row["month_stayed"], row["review"], row["overall"], row["rooms"]) == ("July", "positive", 4.0, None)


def test_json_array_on_one_line(spark, tmp_path):
    records = [{"comment_id": i, "review": "positive", "review_text": "a b"} for i in range(3)]
    (tmp_path / "training.json").write_text(json.dumps(records))
    assert readers.read_model_input(spark, str(tmp_path / "training.json")).count() == 3


def test_csv_keeps_breaks_quotes_and_spaces(spark, tmp_path):
    data = [(1, "  a, \"b\"\nc  "), (2, ""), (3, None), (4, "back\\slash \"")]
    df = spark.createDataFrame(data, "id long, text string")
    writers.write_csv(df, str(tmp_path / "x"))
    assert list((tmp_path / "x").glob("*.csv.gz"))
    back = readers.read_csv(spark, str(tmp_path / "x"), df.schema)
    want = [(i, text or None) for i, text in data]
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(want, key=str)


def test_metrics_file(spark, tmp_path):
    header = ",".join(schemas.MODEL_METRICS.fieldNames())
    (tmp_path / "m.csv").write_text(header + "\nNaive Bayes,training,0.9,0.8,0.7,0.6,0.1,0.7\n")
    row = readers.read_metrics(spark, str(tmp_path / "m.csv")).first()
    assert (row["Model"], row["False Positive Rate"]) == ("Naive Bayes", 0.1)


def test_city_table_prunes_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id long, locality string")
    writers.write_table(df, str(tmp_path / "t"))
    back = readers.read_table(spark, str(tmp_path / "t"))
    city = back.where(F.col("locality") == "A")
    assert [r["id"] for r in city.collect()] == [1] and back.count() == 3
    assert "PartitionFilters: [isnotnull(locality" in city._jdf.queryExecution().toString()


def test_report_file_is_one_ordered_file(spark, tmp_path):
    top = spark.createDataFrame([(i, f"h{i}", 5, 3) for i in range(1, 6)],
                                "rank long, name string, review_count long, positive_counts long").repartition(4)
    writers.write_report(reports.top_report(top), str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("part-*"))
    assert len(files) == 1
    assert [line.split()[0] for line in files[0].read_text().splitlines()[2:]] == ["1", "2", "3", "4", "5"]


def test_work_dir_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def get(self, key, default):
            return "hdfs://shared/work/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert session.work_dir(Session()) == "hdfs://shared/work"


def test_work_dir_falls_back_to_the_warehouse():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: "hdfs://shared/warehouse" if key == "spark.sql.warehouse.dir" else default)

    assert session.work_dir(Session()) == "hdfs://shared/warehouse/_work"


def test_machine_local_work_dir_is_refused_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: "file:/tmp/warehouse" if key == "spark.sql.warehouse.dir" else default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert session.work_dir(Session()) == "file:/tmp/warehouse/_work"


def files_below(path):
    return [f for f in Path(path.removeprefix("file:")).rglob("*") if f.is_file()]


def test_scratch_deletes_what_its_block_wrote(spark):
    before = session.materialize(spark.range(5), "before")
    with session.scratch(spark) as folder:
        inner = session.materialize(spark.range(10), "inner")
        with session.scratch(spark) as nested:
            assert nested.startswith(folder) and session.new_path(spark, "x").startswith(nested)
            session.materialize(spark.range(10), "nested")
        assert inner.count() == 10 and files_below(folder) and not files_below(nested)
    assert not Path(folder.removeprefix("file:")).exists() and before.count() == 5
    with pytest.raises(RuntimeError):
        with session.scratch(spark) as folder:
            session.materialize(spark.range(10), "failed")
            raise RuntimeError
    assert not Path(folder.removeprefix("file:")).exists()
    assert not session.new_path(spark, "x").startswith(folder)


def test_landed_keeps_the_result_alone(spark):
    folders = []

    def make():
        folders.append(session.new_path(spark, "x").rsplit("/", 1)[0])
        return session.materialize(spark.range(10), "a").join(session.materialize(spark.range(5), "b"), "id")

    assert session.landed(spark, "result", make).count() == 5
    assert not Path(folders[0].removeprefix("file:")).exists()


def test_a_query_leaves_nothing_in_its_scratch_folder(spark, sf):
    with session.scratch(spark) as folder:
        assert QUERIES["nb_saved"](spark, sf).count() > 0
        assert files_below(folder)
    assert not Path(folder.removeprefix("file:")).exists()


def test_materialize_drops_shuffle_files(spark):
    def blocks():
        store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return store.getAllFiles().size()

    df = spark.range(1000).groupBy(F.expr("id % 7").alias("k")).count()
    before = blocks()
    session.materialize(df, "shuffled")
    assert blocks() <= before
    assert spark.conf.get(session.CLEAN_SHUFFLES) == "false"


def test_train_and_rank_a_city(spark):
    """The whole menu: train elsewhere, score a city, rank its hotels."""
    good, bad = "great lovely clean", "dirty rude noisy"
    data = []
    for i in range(80):
        is_good = i % 3 != 0
        data.append((i, f"h{i % 5}", "AB"[i % 2], "title", good if is_good else bad, "positive" if is_good else "negative", None))
    data.append((99, "h1", "A", None, "great", "positive", None))
    reviews = spark.createDataFrame(
        data, "comment_id long, name string, locality string, title string, text string, review string, service double"
    )
    model = recommend.train_for_city(reviews, "A")
    scored = recommend.score_city(reviews, "A", model)
    assert scored.count() == 40 and scored.where("review <> predicted_review_label").count() == 0
    top = recommend.top_hotels_of_city(reviews, "A", model).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5] and sum(r["review_count"] for r in top) == 40
    category = recommend.top_category_of_city(reviews, "A", "service", model).collect()
    assert all(2.0 <= r["weighted_avg"] <= 4.0 for r in category)
