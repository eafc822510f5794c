"""The stream gives what the batch gives, and each file is read once."""

import csv

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lotwise.catalog.study import P
from lotwise.plans import deals
from lotwise.plans.scoring import score, with_linear_gap
from lotwise.sources.listings import RAW_COLUMNS, clean_listings, kept_listings, scan_listings_csv
from lotwise.streaming.recent import recent_deals_to, scored_stream


def test_stream_equals_batch(spark, study, tmp_path):
    rows = study.raw.withColumn("car", F.lit("")).limit(600).select(*RAW_COLUMNS.values()).collect()
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, part):
        # an extra first column, as the scraped file has columns nobody reads
        with open(folder / name, "w", newline="") as f:
            csv.writer(f).writerows([["extra", *RAW_COLUMNS], *[["x", *("" if v is None else v for v in r)] for r in part]])

    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for name, part in (("a.csv", rows[:300]), ("b.csv", rows[300:])):
        land(name, part)
        query = recent_deals_to(out, state, scored_stream(spark, str(folder), study.model, P), P)
        query.awaitTermination(120)
        assert query.exception() is None
    raw = scan_listings_csv(spark, str(folder))
    batch = with_linear_gap(score(kept_listings(clean_listings(raw, P), P), study.model, P), P)
    want = {tuple(r) for r in deals.deals_recent_linear(batch, P).select("Id", "L_Price_Gap_Percentage").collect()}
    got = [tuple(r) for r in spark.read.parquet(out).select("Id", "L_Price_Gap_Percentage").collect()]
    assert want and len(got) == len(want) and set(got) == want


def test_another_header_fails(spark, study, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = list(RAW_COLUMNS)
    (folder / "a.csv").write_text(",".join(names) + "\n")
    scored = scored_stream(spark, str(folder), study.model, P)
    swapped = [names[1], names[0], *names[2:]]
    (folder / "b.csv").write_text(",".join(swapped) + "\n" + ",".join("1" for _ in names) + "\n")
    query = recent_deals_to(str(tmp_path / "out"), str(tmp_path / "state"), scored, P)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
