import pytest
from pyspark.sql import types as T

from matchlore.sources.runs import RunFolder

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("text", T.StringType())])


def rows(spark, keys, mark):
    return spark.createDataFrame([(k, f"{mark}{k}", 1) for k in keys], "k long, text string, other int")


@pytest.mark.parametrize("format_", ["parquet", "json"])
def test_runs_add_up(spark, tmp_path, format_):
    folder = RunFolder(spark, str(tmp_path / "out"), SCHEMA, "k", format_)
    assert folder.read().count() == folder.finished().count() == 0
    assert folder.add(rows(spark, range(200), "a")) == 200
    assert folder.add(rows(spark, range(300), "b")) == 100
    assert folder.add(rows(spark, range(300), "c")) == 0
    got = {r["k"]: r["text"] for r in folder.read().collect()}
    assert got == {k: f"{'a' if k < 200 else 'b'}{k}" for k in range(300)}
    assert folder.committed().count() == 2 and folder.finished().count() == 300


def test_a_broken_run_does_not_count(spark, tmp_path):
    folder = RunFolder(spark, str(tmp_path / "out"), SCHEMA, "k")
    folder.add(rows(spark, range(5), "a"), "r1")
    folder._write_rows(rows(spark, range(5, 9), "half").select("k", "text"), "r2")
    assert folder.read().count() == 5
    rows(spark, range(5, 8), "half").select("k").write.parquet(str(tmp_path / "out/finished/run=r2"))
    assert folder.finished().count() == 5
    assert folder.add(rows(spark, range(7), "b"), "r2") == 2
    assert sorted(r["text"] for r in folder.read().collect()) == ["a0", "a1", "a2", "a3", "a4", "b5", "b6"]
    with pytest.raises(ValueError, match="r1"):
        folder.add(rows(spark, [99], "z"), "r1")


def test_runs_at_the_same_time(spark, tmp_path):
    """Both saw the folder without the other's rows; the first by name keeps the keys they share."""
    folder = RunFolder(spark, str(tmp_path / "out"), SCHEMA, "k")
    for run in ("r2", "r1"):
        folder._write_rows(rows(spark, [1, 2, 3] if run == "r2" else [3, 4], run).select("k", "text"), run)
    assert folder._commit("r2") == 3 and folder._commit("r1") == 2
    got = sorted((r["k"], r["text"], r["run"]) for r in folder.read().collect())
    assert got == [(1, "r21", "r2"), (2, "r22", "r2"), (3, "r13", "r1"), (4, "r14", "r1")]


def test_rows_without_key_and_repeated_keys(spark, tmp_path):
    folder = RunFolder(spark, str(tmp_path / "out"), SCHEMA, "k")
    assert folder.add(spark.createDataFrame([(None, "x"), (1, "p"), (1, "q")], SCHEMA)) == 2
    assert sorted(r["text"] for r in folder.read().collect()) == ["p", "q"]
    assert folder.add(spark.createDataFrame([(1, "r"), (2, None)], SCHEMA)) == 1
    assert folder.read().count() == 3
