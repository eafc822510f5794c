"""Archives: round trips, revisits, and reading by arbitrary byte ranges."""

import hashlib
import io
import random
from collections import Counter

from pyspark.sql import functions as F

from lotwise.llm import warc


def test_every_split_reads_each_record_once():
    rng = random.Random(1)
    noise = [rng.randbytes(rng.choice([0, 10, 3000, 40000])) + warc.MAGIC + b"WARC/1.1" for _ in range(60)]
    data = b"".join(warc.record(i, f"http://x/{i}", p, 3 if i % 5 == 0 else None, "d") for i, p in enumerate(noise))
    for split in (911, 5_000, 1 << 23):
        got = [m for s in range(0, len(data), split) for m in warc.members(io.BytesIO(data), s, s + split)]
        ids = [warc.parsed(m).fields["warc-record-id"] for m in got]
        assert ids == [f"<urn:page:{i}>" for i in range(60)]
        assert all(warc.parsed(m).payload == noise[i] for i, m in enumerate(got) if i % 5)
    # what only looks like a member is passed over, and so is a cut-off one
    broken = b"\x1f\x8b\x08junk" + data[:-20]
    assert len(list(warc.members(io.BytesIO(broken), 0, len(broken)))) == 59
    assert list(warc.members(io.BytesIO(b""), 0, 10)) == []


def _pages():
    big, other = "é" * 600, "y" * 1000
    return [
        (1, "http://a", big), (2, "http://b", big), (9, "http://c", big), (9, "http://c2", big), (None, "u", big),
        (3, None, other), (4, "http://d\r\nx: y", None), (5, "http://e", ""), (6, "http://f", "small"), (7, "g", "small"),
        (8, "http://ü", "z" * 999), (10, "h", "z" * 999), (None, "i", "n" * 2000), (None, "j", "n" * 2000),
    ]


def test_round_trip(spark):
    pages = spark.createDataFrame(_pages(), "page_id bigint, url string, html string").selectExpr("*", "1 AS d", "2 AS n")
    for split in (64, warc.SPLIT):
        got = warc.read_archives(warc.write_archives(pages), split, payloads=True).collect()
        assert len(got) == len(_pages())
        seen = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got)
        raw = [(str(i), (h or "").encode()) for i, _, h in _pages()]
        assert seen == sorted((i, len(b), hashlib.sha1(b).hexdigest()) for i, b in raw)
        kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got if r["record_type"] == "revisit")
        assert kinds == [("1", "revisit", 9), ("2", "revisit", 9), ("None", "revisit", 9)]
        assert {r["payload"] for r in got if r["page_id"] == 6} == {b"small"}


def test_ranges_are_read_by_many_tasks(spark):
    """Adaptive execution must not put the short list of ranges into one task."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    rng = random.Random(2)
    pages = spark.createDataFrame([(i, "u", rng.randbytes(900).hex()) for i in range(600)], "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages.coalesce(1))
    split = 1 + manifest.agg({"bytes": "sum"}).first()[0] // 50
    got = warc.read_archives(manifest, split).select("page_id", F.spark_partition_id().alias("task")).collect()
    per_task = Counter(r["task"] for r in got)
    assert sorted(r["page_id"] for r in got) == list(range(600))
    assert len(per_task) > 10 and max(per_task.values()) < 120
    assert warc._read_tasks(manifest, warc.SPLIT) == 1


def test_no_pages_and_damage(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archives(warc.write_archives(empty)).count() == 0
    bad = warc.parsed(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort")
    assert bad is None and warc.parsed(b"no header") is None
