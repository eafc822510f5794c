"""A run is published whole or not at all."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotwise.sources import sinks

ROWS = [("a", 1.5, None), ("NA", None, 3), ("q\"x\ny", -0.0, 4), ("", 1e300, 5), ("a", 1.5, None)]


def _df(spark, rows=ROWS):
    return spark.createDataFrame(rows, "s string, d double, i int")


def test_third_of_four_writes_fails_then_a_retry_is_whole(spark, tmp_path):
    base, df = str(tmp_path / "runs"), _df(spark)
    broken = df.withColumn("s", F.when(F.col("i") == 4, F.raise_error(F.lit("no more disk"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="no more disk"):
        sinks.export_run(base, "r1", df, df, broken, missing=df.select("s"))
    assert sinks.runs(spark, base) == [] and not Path(base, "r1").exists()
    assert list(Path(base, sinks.STAGING).iterdir()) == []
    assert sinks.read_run(spark, base, sinks.FULL, df.schema).count() == 0
    paths = sinks.export_run(base, "r1", df, df, df, missing=df.select("s"))
    assert sinks.runs(spark, base) == ["r1"] and all(Path(p, "_SUCCESS").exists() for p in paths.values())
    found = {r["name"]: r["rows"] for r in sinks.manifest(spark, base, "r1").collect()}
    assert found == {sinks.FULL: 5, sinks.FORMATTED: 5, sinks.FILTERED: 5, sinks.MISSING: 5}
    back = sinks.read_run(spark, base, sinks.FULL, df.schema).collect()
    assert sorted(map(str, back)) == sorted(str(r).replace("Row(", "Row(run_id='r1', ", 1) for r in df.collect())
    assert sinks.damaged_tables(spark, base, "r1") == []


def test_a_run_is_never_written_twice(spark, tmp_path):
    base, df = str(tmp_path / "runs"), _df(spark)
    sinks.publish_run(base, "r1", {"x": df})
    with pytest.raises(FileExistsError):
        sinks.publish_run(base, "r1", {"x": df.limit(1)})
    assert sinks.read_run(spark, base, "x", df.schema).count() == 5


def test_readers_pass_over_folders_without_a_manifest(spark, tmp_path):
    base, df = str(tmp_path / "runs"), _df(spark)
    for run in ("r2", "r1", "r3"):
        sinks.publish_run(base, run, {"x": df.withColumn("s", F.lit(run))})
    sinks.sink_csv(df, f"{base}/half/x")
    assert sinks.runs(spark, base) == ["r1", "r2", "r3"]
    got = sinks.read_run(spark, base, "x", df.schema)
    assert {tuple(r) for r in got.select("run_id", "s").collect()} == {(r, r) for r in ("r1", "r2", "r3")}
    assert sinks.read_run(spark, base, "x", df.schema, ["r2", "half"]).count() == 5
    with pytest.raises(FileNotFoundError):
        sinks.manifest(spark, base, "half")


def test_damage_is_found(spark, tmp_path):
    base, df = str(tmp_path / "runs"), _df(spark)
    none = df.limit(0)
    sinks.publish_run(base, "r1", {"x": df.coalesce(1), "y": df, "z": none})
    assert sinks.damaged_tables(spark, base, "r1") == []
    part = next(Path(base, "r1", "x").glob("part-*.csv"))
    part.write_text(part.read_text().replace("1.5", "2.5", 1))
    Path(base, "r1", "x", f".{part.name}.crc").unlink()
    assert sinks.damaged_tables(spark, base, "r1") == ["x"]
    text = next(Path(base, "r1", sinks.MANIFEST).glob("part-*")).read_text()
    assert {json.loads(line)["name"] for line in text.splitlines()} == {"x", "y", "z"}
