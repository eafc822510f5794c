"""Exports as compressed text: the same rows, and files that do not outgrow the tables they come from."""

import gzip
from pathlib import Path

import pytest
from paths import SF

import __spark_entry__ as entry
from lotwise.catalog import sources
from lotwise.sources import sinks

ROWS = [("a", 1.5), ("NA", None), ("\\NA", 0.1), ("\\\\NA", 3.0), ("BANANA", 4.0), ("NA\n", 5.0), ('q"x\r\ny', -0.0), ("", 1e300), (None, 2.0)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_texts_come_back(spark, tmp_path, compression):
    df = spark.createDataFrame(ROWS, "s string, d double")
    base = str(tmp_path / "runs")
    paths = sinks.export_run(base, "r1", df, df, df, compression=compression)
    for path in paths.values():
        back = sinks.read_back_csv(spark, path, df.schema).collect()
        assert sorted(map(str, back)) == sorted(map(str, df.collect()))
    assert sinks.damaged_tables(spark, base, "r1") == []
    assert {f.suffix for f in Path(paths[sinks.FULL]).glob("part-*")} == {".gz" if compression == "gzip" else ".csv"}


def test_four_exports_are_written_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "new_path", lambda spark, name: str(tmp_path / name))
    found = {r["file"]: r["count"] for r in entry.queries()["four_exports"](spark, SF).groupBy("file").count().collect()}
    for name, n in found.items():
        files = list((tmp_path / "exports" / sources.RUN / name).glob("part-*"))
        text = [gzip.decompress(f.read_bytes()) for f in files]
        assert {f.name[-7:] for f in files} == {".csv.gz"}
        assert sum(t.count(b"\n") - 1 for t in text if t) == n  # headers aside, one line a row
    full = list((tmp_path / "exports" / sources.RUN / sinks.FULL).glob("part-*"))
    assert 2 * sum(f.stat().st_size for f in full) < sum(len(gzip.decompress(f.read_bytes())) for f in full)
