"""The stages of the pipeline on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.common import written
from millrace.llm.mixing import label_sample
from millrace.session import checkpoint_dir
from tests.llm.conftest import prose

SF_DIR = "/root/testdata/sf0.001"


def test_stages_filter_and_pack(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == counts[-1]
    assert not docs.filter("text rlike '[a-z]@[a-z0-9-]+[.][a-z]'").count()


def test_stages_take_edges(spark, edge_documents, no_documents):
    for docs in (edge_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF_DIR).count() <= 4 * docs.count() + 40


def test_rows_are_judged_one_by_one(spark):
    """Null and repeated ids, and columns named like the stages' own."""
    texts = [prose(k, 80) for k in range(5)]
    rows = [(None, t) for t in texts] + [(None, "short")] + [(9, prose(9, 70)), (9, "short too")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _kept boolean, row double, rate int"
    docs = spark.createDataFrame([(k, t, "en", "a", len(t), True, 1.0, 1) for k, t in rows], schema).withColumn("_id", F.lit(0))
    kept = corpus_pipeline.keep_quality(spark, docs, SF_DIR).collect()
    assert sorted(r.text for r in kept) == sorted([*texts, prose(9, 70)])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() > 0


def test_one_row_of_each_group_stays(spark):
    one, other = prose(1, 80), prose(2, 80)
    rows = [(1, one), (1, one), (1, other), (None, one), (None, other), (None, one), (5, other), (None, ""), (None, None)]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id or 0, r.text or "-") for r in kept) == sorted([(1, one), (1, other), (0, "-"), (0, "-")])


def test_least_labels_count_however_rows_are_dealt(spark):
    rows = [(k, label) for k in range(50) for label in (("junk", "clean") if k % 2 else ("clean", "junk"))]
    labels, docs = spark.createDataFrame(rows, "doc_id long, label string"), spark.range(50).select(F.col("id").alias("doc_id"))
    for parts in (1, 7):
        assert {r.label for r in label_sample(docs, labels.repartition(parts), F.col("label"), 100).collect()} == {"clean"}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(("name", "texts_written"), [("quality", 0), ("mixing", 1)])
def test_decisions_are_not_joined_to_texts(spark, no_broadcast, tmp_path, name, texts_written):
    """Texts are not shuffled, and written once at most."""
    rows = [(k, prose(k, 80), "en", "a", 1) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("llm-*"))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    made = [spark.read.parquet(f"file://{x}") for x in set(folder.glob("llm-*")) - before]
    assert sum("text" in x.columns for x in made) == texts_written
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(row" not in plan
    assert out.columns == corpus_pipeline.COLUMNS
    own = {r.doc_id: r for r in docs.collect()}
    kept = out.collect()
    assert kept and all(r == own[r.doc_id] for r in kept)
