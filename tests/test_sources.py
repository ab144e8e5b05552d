import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.sources import jsonl
from millrace.sources.jsonl import count_examples, limit_examples, positions, read_jsonl, read_jsonl_quarantine
from millrace.sources import stages
from millrace.sources.stages import input_version, keep_latest, latest_version, materialize_stage, materialize_version
from millrace.sources.vocabulary import (
    read_special_tokens,
    read_special_tokens_map,
    read_token_roles,
)

FLAGS = {"lstrip": False, "normalized": False, "rstrip": False, "single_word": False}


def keys(df):
    return sorted(r.id for r in df.collect())


def test_limit_policies(spark):
    rows = spark.range(10)
    assert keys(limit_examples(rows, 3, ["id"])) == [0, 1, 2]
    assert keys(limit_examples(rows, 0, ["id"])) == [] == keys(limit_examples(rows, 0, ["id"], "clamp"))
    assert keys(limit_examples(rows, None, ["id"])) == list(range(10))
    with pytest.raises(ValueError, match="fewer than 11"):
        limit_examples(rows, 11, ["id"])
    assert keys(limit_examples(rows, 11, ["id"], "clamp")) == list(range(10))
    assert keys(limit_examples(rows, 0, ["id"], "clamp_zero_all")) == list(range(10))
    assert keys(limit_examples(rows, 4, ["id"], "clamp_zero_all")) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="policy"):
        limit_examples(rows, 1, ["id"], "other")


@pytest.fixture
def few(monkeypatch):
    """Passes go on until a handful of rows is left."""
    monkeypatch.setattr(jsonl, "SPLITS", 5)
    monkeypatch.setattr(jsonl, "FEW_ROWS", 4)


@pytest.mark.parametrize("n", [1, 2, 99, 333, 999, 1000, 5000])
def test_limits_cut_by_key(spark, few, n):
    rows = spark.range(0, 1000, 1, 6).select("id", (F.col("id") % 10).alias("b")).orderBy(F.rand(1))
    expected = sorted(range(1000), key=lambda i: (i % 10, i))[:n]
    assert keys(limit_examples(rows, n, ["b", "id"], "clamp")) == sorted(expected)


def test_limits_keep_null_keys(spark, few):
    rows = [(None if k < 1_200 else k % 7, float("nan") if k == 9 else k / 2, k) for k in range(3_000)]
    table = spark.createDataFrame(rows, "a INT, x DOUBLE, b INT")
    for n in (1, 1_100, 1_200, 2_999, 5_000):
        expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] != r[1], r[1]))[:n]
        assert sorted(r.b for r in limit_examples(table, n, ["a", "x"], "clamp").collect()) == sorted(r[2] for r in expected)


@pytest.mark.parametrize("n", [1, 400, 700, 1_000, 1_399])
def test_ties_are_settled(spark, few, n):
    """A third of the rows has one key, and repeats of one row are cut within themselves."""
    rows = [(k, "x") for k in range(500)] + [(77, f"t{k}") for k in range(300)] + [(77, "same")] * 600
    table = spark.createDataFrame(rows, "a INT, t STRING").withColumn("m", F.create_map(F.lit("k"), F.col("t")))
    kept = [(r.a, r.t) for r in limit_examples(table, n, ["a"]).collect()]
    assert len(kept) == n and sorted(a for a, _ in kept) == sorted(a for a, _ in rows)[:n]
    again = [(r.a, r.t) for r in limit_examples(table.repartition(13), n, ["a"]).collect()]
    assert sorted(again) == sorted(kept)
    assert limit_examples(table.select("a"), n, ["a"]).count() == n


def test_limits_add_no_shuffle(spark):
    rows = spark.range(0, 10_000, 1, 6)
    for n in (5, 9_000):
        plan = limit_examples(rows, n, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_positions(spark):
    rows = spark.range(0, 500, 1, 7).withColumn("k", (F.col("id") * 37) % 501)
    got = sorted(positions(rows, ["k"]).collect(), key=lambda r: r.k)
    assert [r.pos for r in got] == list(range(500))


def test_jsonl(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"text": "a", "n": 1}\n{"text": null}\n')
    rows = read_jsonl(spark, str(path), "text STRING")
    assert sorted((r.text or "") for r in rows.collect()) == ["", "a"]
    assert set(read_jsonl(spark, [str(path)]).columns) == {"text", "n"}
    assert count_examples(rows).first().examples == 2
    path.write_text('{"text": "a"\n')
    with pytest.raises(Exception, match="FAILFAST"):
        read_jsonl(spark, str(path), "text STRING").collect()


def test_special_token_settings(spark, tmp_path):
    config = {
        "add_bos_token": True, "add_eos_token": False, "bos_token": "<s>", "eos_token": "</s>",
        "pad_token": None, "unk_token": "<unk>", "model_max_length": 10**30,
        "added_tokens_decoder": {
            str(i): {"content": t, "special": True, **FLAGS} for i, t in enumerate(["<unk>", "<s>", "</s>"])
        },
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config, indent=2))
    rows = read_special_tokens(spark, str(path)).orderBy("id").collect()
    assert [(r.id, r.token, r.role, r.special, r.lstrip) for r in rows] == [
        (0, "<unk>", "unk", True, False), (1, "<s>", "bos", True, False), (2, "</s>", "eos", True, False),
    ]
    assert tuple(read_token_roles(spark, str(path)).first()) == ("<s>", "</s>", None, "<unk>", True, False)
    path.write_text(json.dumps({"bos_token": {"content": "<s>", **FLAGS}}, indent=2))
    assert [tuple(r) for r in read_special_tokens_map(spark, str(path)).collect()] == [
        ("bos", "<s>", False, False, False, False)
    ]


def test_stage_is_reused_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "stage")
    runs = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            runs.add(1)
            yield frame

    def stage(n=5, version="v1"):
        return keys(materialize_stage(spark.range(0, n, 1, 1).mapInPandas(counted, "id BIGINT"), path, version))

    assert stage() == list(range(5)) and runs.value == 1
    assert stage() == list(range(5)) and runs.value == 1
    assert stage(4, "v2") == list(range(4)) and runs.value == 2
    part = next((tmp_path / "stage" / "data").glob("*.parquet"))
    part.write_bytes(part.read_bytes()[:-9])
    assert stage(4, "v2") == list(range(4)) and runs.value == 3
    next((tmp_path / "stage" / "data").glob("*.parquet")).unlink()
    assert stage(4, "v2") == list(range(4)) and runs.value == 4
    spark.createDataFrame([("building", "", None, "")], "state STRING, fields STRING, n_rows BIGINT, version STRING").write.mode(
        "overwrite"
    ).json(f"{path}/manifest")
    assert stage(4, "v2") == list(range(4)) and runs.value == 5


def test_latest_runs(spark):
    rows = [("a", s) for s in range(10)] + [("b", 1)]
    kept = keep_latest(spark.createDataFrame(rows, "run STRING, step INT"), 3)
    assert sorted(tuple(r) for r in kept.collect()) == [("a", 7), ("a", 8), ("a", 9), ("b", 1)]


def test_bad_lines_are_set_aside(spark, tmp_path):
    """Every line that isn't blank is in one of the two tables, with the first reason against it."""
    lines = [
        '{"id": 1, "conversations": [{"role": "user", "content": "a"}]}', '{"id": 2, "conversations": null}', '{"id": 3}', "{", "", "  ",
        "nonsense", '{"id": "x", "conversations": []}', '{"id": null, "conversations": []}', '[1]', '{"id": 4, "conversations": [], "more": 1}',
    ]
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(lines) + "\n")
    schema = "id BIGINT, conversations ARRAY<STRUCT<role STRING, content STRING>>"
    good, bad = read_jsonl_quarantine(spark, str(path), schema, ["conversations", "id"])
    assert good.columns == ["id", "conversations"] and sorted(r.id for r in good.collect()) == [1, 4]
    reasons = {r.line: r.reason for r in bad.collect()}
    assert len(reasons) == 7 and reasons['{"id": 3}'] == reasons[lines[1]] == "conversations is null"
    assert reasons[lines[8]] == "id is null" and reasons["{"] == reasons["nonsense"] == reasons["[1]"] == "not JSON of the schema"
    assert read_jsonl_quarantine(spark, str(path), schema)[0].filter("id = 2").count() == 1


@pytest.mark.parametrize("n", [1_001, 2_500, 9_000])
def test_many_latest_rows_by_ranges(spark, n):
    """A run that holds most rows, one with a null name, short ones, and columns that look like the helpers."""
    rows = spark.range(0, 9_000, 1, 7).selectExpr(
        "case when id % 3 > 0 then 'hot' when id % 2 = 0 then null else concat('r', id % 9) end AS run", "id AS step", "id AS place"
    )
    newest = Window.partitionBy("run").orderBy(F.desc("step"))
    expected = rows.withColumn("p", F.row_number().over(newest)).filter(F.col("p") <= n).drop("p")
    got = keep_latest(rows, n)
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
    ranked = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number" in line]
    assert not ranked


def test_versions_of_a_stage(spark, tmp_path, monkeypatch):
    """A failed write leaves the version before; whole ones are found again; damaged ones are written anew."""
    path = str(tmp_path / "stage")
    with pytest.raises(ValueError, match="no version"):
        latest_version(spark, path)
    assert keys(materialize_version(spark.range(5), path, "a")) == list(range(5))
    failing = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        materialize_version(failing.select(F.col("id").cast("long")), path, "b")
    assert keys(latest_version(spark, path)) == list(range(5))
    assert keys(materialize_version(spark.range(7), path, "b")) == list(range(7))
    assert keys(materialize_version(spark.range(99), path, "a")) == list(range(5))
    assert keys(latest_version(spark, path)) == list(range(7))
    newest = stages._versions(spark, path)[0].folder
    part = next((tmp_path / "stage" / newest.rsplit("/", 1)[1]).glob("*.parquet"))
    part.write_bytes(part.read_bytes()[:-9])
    assert keys(latest_version(spark, path)) == list(range(5))
    assert keys(materialize_version(spark.range(7), path, "b")) == list(range(7))

    def unreachable(*_):
        raise PySparkException("the store does not answer")

    monkeypatch.setattr(stages, "_lacks_files", lambda error: False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stages._versions(spark, str(tmp_path / "nothing"))
    monkeypatch.undo()
    monkeypatch.setattr(type(spark.read), "parquet", unreachable)
    with pytest.raises(PySparkException, match="does not answer"):
        latest_version(spark, path)


def test_versions_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5).write.parquet(path)
    first = input_version(spark.read.parquet(path))
    assert first == input_version(spark.read.parquet(path)) != input_version(spark.read.parquet(path), code="2")
    spark.range(5).write.mode("append").parquet(path)
    assert input_version(spark.read.parquet(path)) != first
