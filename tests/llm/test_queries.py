"""Neighbours against brute force, the classifiers on labelled rows, URL lists against their SQL, pages and edges."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from millrace.llm.cotraining import View, designs, lesson, lessons_of_all, quality_scores, record_features
from millrace.llm.mixing import GRID, PULL, WITHIN, Step, mixed_rates, replay
from millrace.llm.nearest import BLOCK, CollisionIndex, nearest, verified
from millrace.llm.queries import DOMAIN, ORACLE_SQL, QUERIES, TARGETS
from millrace.llm.text_classifier import SHAPE, TAG_BUCKETS, WORD_BUCKETS
from millrace.llm.url_lists import DAY, _by_day, intervals, temporal_list_join

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_neighbours_are_nearly_those_of_brute_force(spark):
    got = QUERIES["op2_nearest_neighbours"](spark, SF_DIR).collect()
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect() if r.embedding}
    ids, vectors = np.array(list(rows)), np.stack(list(rows.values()))
    hits = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = vectors @ rows[q]
        best = [i for i in ids[np.lexsort((ids, -scores))].tolist() if i != q][:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all(abs(r.score - rows[q] @ rows[r.vec_id]) < 1e-12 for r in mine)
        hits += len(set(best) & {r.vec_id for r in mine})
    assert hits >= 0.9 * len(got) and len(got) == 20 * sum(ids % 20 == 0)


def directions(kind, n, seed=5):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, 64))
    if kind == "clustered":
        x = draw.standard_normal((200, 64))[draw.integers(0, 200, n)] + 0.6 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * np.exp(0.5 * draw.standard_normal(n))[:, None] if kind == "unequal" else x


@pytest.mark.parametrize("kind", ["unit", "clustered", "unequal"])
@pytest.mark.parametrize("blocks", [1, 3])
def test_recall_in_full_blocks(kind, blocks):
    """A set share of each block is verified, and nine of ten neighbours are found."""
    x = directions(kind, blocks * BLOCK)
    ids = np.arange(len(x))
    parts = [CollisionIndex(ids[b::blocks], x[b::blocks]) for b in range(blocks)]
    hits, queries = 0, range(0, 60)
    for q in queries:
        assert all(len(part.candidates(x[q], verified(BLOCK, 20))) <= 0.15 * BLOCK for part in parts)
        found, scores = map(np.concatenate, zip(*(part.nearest(q, x[q], 20) for part in parts), strict=True))
        exact = x @ x[q]
        exact[q] = -np.inf
        hits += len(set(found[np.argsort(-scores)[:20]].tolist()) & set(np.argsort(-exact)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(queries)


def test_lengths_beyond_the_range_of_squares():
    x = np.array([[1e200, 0.0], [1e200, 1e200], [1e-200, 0.0], [-1e-200, 1e-200]])
    assert CollisionIndex(np.arange(4), x).nearest(2, x[2], 3)[0].tolist() == [0, 1, 3]


def test_neighbour_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (None, [1.0, 1.0]), (6, [1.0, None]), (7, [2.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(table, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 2.0), (0, 2, 1, 1.0)]
    assert nearest(table.limit(0), F.lit(True)).count() == 0


def test_url_lists_equal_their_sql(spark):
    got = QUERIES["op6_url_filters"](spark, SF_DIR).toPandas()
    duck = duckdb.connect()
    for name in ("pages", "events"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    expected = duck.sql(ORACLE_SQL["op6_url_filters"]).df()[list(got.columns)]
    as_text = lambda df: sorted(map(tuple, df.astype(str).to_numpy().tolist()))
    assert as_text(got) == as_text(expected) and got["blocked"].any()


YEARS = 20 * 365 * DAY


def test_url_lists_over_time(spark):
    """Ties, nulls, long open entries, captures far ahead and columns named like the join's own."""
    entries = [("domain=b.com", 10, "add"), ("host=a.b.com", 5, "add"), ("host=a.b.com", 5, "remove"), ("prefix=a.b.com/x", DAY, "add"), ("prefix=a.b.com/x", 3 * DAY, "remove")]
    entries += [(None, 1, "add"), ("host=a.b.com", None, "add"), ("host=a.b.com", 1, None), ("host=a.b.com", 1, "other")]
    captures = [(1, "http://a.b.com/x/y", 9), (2, "http://a.b.com/x/y", 10), (3, "http://A.b.com./x", 2 * DAY), (3, "http://A.b.com./x", 2 * DAY), (4, "http://a.b.com/x", 3 * DAY)]
    captures += [(5, "https://b.com", YEARS), (6, "http://c.com/", 50), (7, None, 50), (8, "http://b.com", None), (9, "no host", 50), (10, "http://b.com", 400 * YEARS)]
    table = spark.createDataFrame([(*c, 0, "f", 1, 2) for c in captures], "id long, url string, at long, n_active int, found string, _url int, day int")
    listed = spark.createDataFrame(entries, "pattern string, at long, action string")
    rows = temporal_list_join(table, listed)
    assert rows.columns == ["id", "url", "at", "found", "_url", "day", "n_active", "patterns", "blocked"]
    one, both = "domain=b.com", "domain=b.com,prefix=a.b.com/x"
    expected = {1: "", 2: one, 3: both, 4: one, 5: one, 6: "", 7: "", 8: "", 9: "", 10: one}
    got = rows.collect()
    assert {r.id: r.patterns for r in got} == expected and len(got) == len(captures)
    assert all((r.n_active, r.blocked) == (len(r.patterns.split(",")) if r.patterns else 0, r.patterns != "") for r in got)
    assert temporal_list_join(table.limit(0), listed).count() == 0
    assert {r.patterns for r in temporal_list_join(table, listed.limit(0)).collect()} == {""}


def test_an_open_entry_costs_no_row_for_each_day(spark):
    opened = intervals(spark.createDataFrame([("host=a", 0, "add")], "pattern string, at long, action string"))
    wanted = spark.createDataFrame([("host=a", YEARS // DAY), ("host=a", 7), ("host=b", 7)], "pattern string, day long")
    assert sorted(r.day for r in _by_day(opened, wanted).collect()) == [0, 7, YEARS // DAY]


def test_pages_have_one_row_each(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = QUERIES["op1_html_content"](spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in pages.select("page_id").collect())
    assert all(r.n_chars == len(r.text) and "<script" not in r.text for r in rows)
    assert sum(r.n_chars > 0 for r in rows) > 0.9 * len(rows)


def test_quality_scores_of_rows_held_out(spark):
    """Labels of ids divisible by five are unseen; smaller tables hold too few to learn from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    scores = {r.doc_id: r.score for r in quality_scores(docs, labels.filter("doc_id % 5 <> 0"), good).collect()}
    marks = {r.doc_id: r.good for r in labels.filter("doc_id % 5 = 0").select("doc_id", good.alias("good")).collect()}
    assert len(scores) == docs.count()
    assert np.mean([(scores[k] >= 0.5) == g for k, g in marks.items() if k in scores and g is not None]) > 0.9


def test_every_document_outside_the_sample_teaches(spark):
    """Sums over all rows, however they are dealt out, are those of one table in memory."""
    rows = record_features(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    whole, rng = rows.toArrow(), np.random.default_rng(3)
    views = [View(rng.normal(0, wide, size), rng.normal(0, 1, width + 1), np.zeros(width), np.ones(width)) for size, width, wide in ((WORD_BUCKETS, SHAPE, 0.3), (TAG_BUCKETS, 0, 3))]
    sample = pa.array([0, 3, 5, 10_000])
    want = lesson(views, views, designs(whole.filter(pc.invert(pc.is_in(whole["doc_id"], sample)))))
    assert sum(want[at] for at in (0, 1 + 2 * WORD_BUCKETS + SHAPE + 1)) > 20
    for parts in (1, 7):
        assert np.allclose(lessons_of_all(rows.repartition(parts), views, views, sample), want, rtol=1e-5, atol=1e-3)


def test_rates_bring_tokens_to_their_targets(spark, labels):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixed_rates(docs, labels, F.expr(DOMAIN), TARGETS).collect()
    p, tokens, rates = (np.array([r[c] for r in rows]) for c in ("posterior", "n_tokens", "rate"))
    assert np.allclose(p.sum(axis=1), 1) and (rates >= 0).all()
    shares = (tokens * rates) @ p / tokens.sum()
    assert np.abs(shares - list(TARGETS.values())).max() < 0.03


def test_replayed_rates_stay_within_bounds():
    p = np.array([[1.0, 0.0], [0.0, 1.0]])
    rates = replay(p, [Step(np.array([3.0, -30.0]))], 8.0).rates
    assert rates.tolist() == [0.0, 8.0]


@pytest.mark.parametrize(("targets", "volume", "highest"), [((0.95, 0.05, 0.0), 1.0, 8.0), ((0.97, 0.03, 0.0), 1.1, 1.0), ((0.1, 0.1, 0.8), 1.0, 2.0)])
def test_rates_are_near_those_of_plain_descent(spark, labels, targets, volume, highest):
    """Many plain steps over all documents; the second and third targets are out of reach, and ``left`` says so."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixed_rates(docs, labels, F.expr(DOMAIN), dict(zip(TARGETS, targets, strict=True)), volume, highest).collect()
    p, tokens, got = (np.array([r[c] for r in rows]) for c in ("posterior", "n_tokens", "rate"))
    rounded, plain = np.rint(p * GRID) / GRID, tokens @ p
    present, rates = np.maximum(plain, 1e-6 * plain.sum()), np.ones(len(p))
    for _ in range(20_000):
        errors = ((tokens * rates) @ p - np.array(targets) * volume * plain.sum()) / present
        rates = np.clip(rates - (rounded @ errors + PULL * (rates - 1)) / (1 + PULL), 0, highest)
    assert np.sqrt(tokens @ (got - rates) ** 2 / tokens.sum()) < 2 * WITHIN
    assert np.abs(np.array(rows[0].left) - errors).max() < 0.01
    assert highest == 8 or max(np.abs(rows[0].left)) > 0.05


def test_classifier_edges(spark, edge_documents, no_documents, labels):
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    for of in (labels, labels.limit(0)):
        assert quality_scores(edge_documents, of, good).count() == edge_documents.count()
        assert mixed_rates(edge_documents, of, F.expr(DOMAIN), TARGETS).count() == edge_documents.count()
        assert quality_scores(no_documents, of, good).count() == 0
        assert mixed_rates(no_documents, of, F.expr(DOMAIN), TARGETS).count() == 0
