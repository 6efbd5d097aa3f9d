"""Tables laid out for the questions asked of them, and rankings kept as partial aggregates."""

import pytest
from pyspark.sql import functions as F

from guestlens.operators import browse, joins, partials, ranking
from guestlens.session import new_path
from guestlens.sources import readers, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def scanned_rows(spark, df):
    """Rows that the file scans of a finished query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves() if plan.nodeName() != "AdaptiveSparkPlan" else plan.executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numOutputRows").value() for m in metrics if m.contains("numOutputRows"))


def test_one_hotel_reads_few_row_groups(spark):
    reviews = spark.range(200_000).select(
        F.concat(F.lit("h"), F.col("id") % 5000).alias("name"), (F.col("id") % 2).cast("string").alias("locality"), F.xxhash64("id").alias("v")
    )
    path = new_path(spark, "clustered")
    writers.write_table(reviews, path, cluster_by="name", row_group_bytes=64 << 10)
    one = readers.read_table(spark, path).where("name = 'h42' AND locality = '0'")
    assert one.count() == 40
    assert 40 <= scanned_rows(spark, one) < 0.2 * 100_000
    # A name inside every range that no row has: only the Bloom filters know.
    none = readers.read_table(spark, path).where("name = 'h42x' AND locality = '0'")
    assert scanned_rows(spark, none) == 0


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = {}
        for label in ("reviews", "hotels"):
            df = spark.range(1000).select((F.col("id") % 100 if label == "reviews" else F.col("id")).alias("offering_id"), F.col("id").alias(label))
            path = new_path(spark, label)
            name = path.rsplit("/", 1)[1].replace("-", "_")
            writers.write_bucketed(df, name, path, "offering_id", 4)
            tables[label] = spark.table(name)
        for df in (
            joins.merge_reviews_offerings(tables["reviews"], tables["hotels"]),
            tables["reviews"].groupBy("offering_id").count(),
        ):
            df.collect()
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joins.merge_reviews_offerings(tables["reviews"], tables["hotels"]).count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TEXTS = ["a\nb\r\nc", "\\n", "\\\\n\\b", '"q", \\N', "\\N", "", None, " pad ", "\\", "é x\x0b"]


@pytest.mark.parametrize("one_line", [False, True])
def test_csv_gives_back_texts(spark, tmp_path, one_line):
    # Without one_line an empty text, and one that reads like the null mark, is NULL.
    texts = [t for t in TEXTS if one_line or t not in ("", "\\N")]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    writers.write_csv(df, str(tmp_path / "csv"), one_line=one_line)
    back = readers.read_csv(spark, str(tmp_path / "csv"), df.schema, one_line)
    assert dict(map(tuple, back.collect())) == dict(enumerate(texts))


def test_csv_of_lines_is_split(spark, tmp_path):
    df = spark.range(20_000).select("id", F.concat(F.lit("line\n"), "id", F.lit("\n\\n")).alias("text")).coalesce(1)
    writers.write_csv(df, str(tmp_path / "csv"), one_line=True, compression="none")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = readers.read_csv(spark, str(tmp_path / "csv"), df.schema, one_line=True)
        assert len(list((tmp_path / "csv").glob("part-*"))) == 1 and back.select(F.spark_partition_id()).distinct().count() > 3
        assert rows(back) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("n", [0, 1, 500])
def test_numbers_by_ranges(spark, n):
    names = [f"h{i * 7919 % 1000:04d}" for i in range(n)]
    df = spark.createDataFrame([(x,) for x in names], "name string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = browse.numbered(df)
        assert rows(index) == rows(spark.createDataFrame(list(enumerate(sorted(names), 1)), "number long, name string"))
        page = browse.page_of(index, 3, 7)
        assert [r.name for r in page.orderBy("number").collect()] == sorted(names)[21:28]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rankings_from_partials(spark):
    schema = "name string, locality string, month int, predicted_review_label string, service double, rooms double"
    data = [
        (f"h{i % 13}" if i % 50 else None, "A", i % 5, "positive" if i * 31 % 7 < 4 else "negative", float(i % 5 + 1) if i % 3 else None, None)
        for i in range(900)
    ]
    reviews = spark.createDataFrame(data, schema)
    parts = [partials.partial_scores(reviews.where(c), "month", categories=["service", "rooms"]) for c in ("month < 3", "month >= 3")]
    # The same month may come in two loads.
    parts.append(partials.partial_scores(reviews.where("month = 4"), "month", categories=["service", "rooms"]))
    reviews = reviews.union(reviews.where("month = 4"))
    stored = parts[0].union(parts[1]).union(parts[2])
    compacted = partials.merged(stored, "name", "locality", "month")
    assert compacted.count() < stored.count()
    for table in (stored, compacted):
        assert rows(partials.top_hotels(table)) == rows(ranking.top_hotels(reviews))
        for mode in ("max", "mean"):
            for category in ("service", "rooms"):
                got = partials.top_by_category(table, category, mode=mode).withColumn("weighted_avg", F.round("weighted_avg", 9))
                want = ranking.top_by_category(reviews, category, mode=mode).withColumn("weighted_avg", F.round("weighted_avg", 9))
                assert rows(got) == rows(want) and len(rows(got)) == 10


def test_totals_plan_runs_no_job_and_reads_rows_once(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("name"), "id")
        got = joins.with_group_totals(df, "name", {"n": F.count("*")})
        assert not jobs.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got.where("n >= 142").count() == 1000
