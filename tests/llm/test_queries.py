"""The queries and the pipeline on the smallest test tables."""

import pytest
from check import compare, sql_connection

import __spark_entry__ as entry
import corpus_pipeline
from lotwise.llm import catalog
from lotwise.llm.common import table
from lotwise.workspace import stored

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert entry.queries()[name] is QUERIES[name]
    df = QUERIES[name](spark, SF)
    if name in SQL:
        same, note = compare(df, sql_connection(SF), SQL[name])
        assert same, note
    else:
        n = df.count()
        whole = table(spark, SF, "pages" if name == "op11_url_filters" else "documents").count()
        assert n == whole if name != "op5_substring_dedup" else 0 < n < whole


def test_stages_keep_columns_and_only_what_they_say(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF), name)
        assert docs.columns == columns if name != "sharding" else docs.columns == [*columns, "shard"]
        if name not in ("mixing", "sharding"):
            assert docs.exceptAll(before).count() == 0
        assert 0 < docs.count() <= 2 * before.count()
    shards = {r["shard"] for r in docs.select("shard").distinct().collect()}
    assert shards <= set(range(24)) and len(shards) > 12


def test_stages_bear_extra_and_missing_values(spark):
    docs = table(spark, SF, "documents").limit(40).selectExpr("*", "1 AS shard", "2 AS mix", "3 AS found", "4 AS _row")
    blank = spark.createDataFrame([(None, None, None, None, None, 1, 2, 3, 4), (1, "", None, None, 0, 1, 2, 3, 4)], docs.schema)
    docs = docs.unionByName(blank).unionByName(blank)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert out.count() > 0 and stage(spark, docs.limit(0), SF).count() == 0
