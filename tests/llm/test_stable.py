"""Results do not depend on how many cores there are, or on their number between two jobs."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from guestlens import session
from guestlens.llm import jaccard, licenses, repeats, templates
from guestlens.llm.common import join_small, read
from tests.llm.test_llm import ODD, SCHEMA

CORES = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def docs(spark, sf, tmp_path_factory):
    """Documents in many files, so that their partitions change with the setting; some rows are repeated."""
    path = str(tmp_path_factory.mktemp("split") / "documents.parquet")
    table = read(spark, sf, "documents")
    odd = spark.createDataFrame(ODD, SCHEMA).select(*table.columns)
    table.unionByName(table.where("doc_id % 10 = 0")).unionByName(odd).repartition(12).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def changing(spark, monkeypatch):
    """Another number of cores after every table that is written."""
    numbers, write = itertools.cycle(["1", "16", "5"]), session._write

    def written(df, path):
        write(df, path)
        spark.conf.set(CORES, next(numbers))

    def start():
        monkeypatch.setattr(session, "_write", written)

    yield start
    spark.conf.unset(CORES)


OPERATORS = {
    "op5": lambda spark, docs, sf: templates.decontaminate(docs, read(spark, sf, "benchmark"), ["doc_id"]),
    "op7": lambda spark, docs, sf: repeats.remove_repeats(docs),
    "op8": lambda spark, docs, sf: jaccard.near_duplicates(docs),
    "op9": lambda spark, docs, sf: licenses.scan(docs, licenses.known_digests(spark)),
    "quality": corpus_pipeline.quality_stage,
    "near duplicates": corpus_pipeline.duplicates_stage,
    "decontamination": corpus_pipeline.decontamination_stage,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_results_are_stable(spark, docs, sf, changing, name):
    def result():
        return sorted((str(tuple(r)) for r in OPERATORS[name](spark, docs, sf).collect()))

    spark.conf.set(CORES, "4")
    want = result()
    changing()
    assert result() == want


def test_stages_on_odd_rows_against_brute_force(spark, sf, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and clashing names; then an empty table."""
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(ODD, SCHEMA).coalesce(2).write.parquet(path)
    docs = spark.read.parquet(path)
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, df=docs):
        out = stages[name](spark, df, sf)
        assert out.columns == corpus_pipeline.COLUMNS or name == "token-ID output"
        return sorted((tuple(r) for r in out.collect()), key=str)

    rows = sorted((tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()), key=str)
    # Fewer than 20 words, or none, go.
    assert all(len((r[1] or "").split()) >= 20 for r in kept("quality rules"))
    # The two copies with id 2 are near the text of id 1, as is the one without id; 6 and 7 are one in lower case.
    ids = [r[0] for r in kept("n-gram Jaccard join")]
    assert sorted(ids) == [1, 3, 4, 5, 6, 8, 9]
    assert kept("benchmark decontamination") == rows
    mixed = kept("mixing to target weights")
    assert set(mixed) <= {r for r in rows if (r[1] or "").split()} and max(mixed.count(r) for r in mixed) <= 4
    tokens = kept("token-ID output")
    assert len(tokens) == len(rows) and sum(t[2] == 1 for t in tokens) == 3
    for name in stages:
        assert stages[name](spark, docs.limit(0), sf).count() == 0


def test_repeated_rows_leave_one(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "en", "a", 1)] * 3 + [(5, text + " more", "en", "a", 1)] * 2 + [(9, "", None, None, None)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    out = jaccard.one_of_each(spark.read.parquet(path)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert dict(map(tuple, out)) == {1: 1, 9: 2}


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_tables_are_not_broadcast(spark, how, salted):
    """Not even where Spark takes them for small: it does not know that they are repeated once per salt."""
    small = spark.range(0, 300, 2).select(F.col("id").alias("key"), F.lit(1).alias("x"))
    small = session.materialize(small if how in ("inner", "left") else small.drop("x"), "small")
    rows = session.materialize(spark.range(5000).select((F.col("id") % 500).alias("key"), F.col("id").alias("_row")), "rows")
    spread = F.xxhash64("_row") if salted else None
    joined = join_small(rows, small, ["key"], how, spread, most=100)
    want = rows.join(small, ["key"], how)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in join_small(rows, small, ["key"], how, spread, most=150)._jdf.queryExecution().executedPlan().toString()
