"""Fresh scrapes as they land in a folder, scored by the stored model.

Scoring has no state, so the batch functions are applied to the stream unchanged: the
model's tables are the static side of each join. Counts, ranks and means per trim need
the whole batch and stay in the batch plans.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotwise.params import Params
from lotwise.plans.deals import deals_recent_linear
from lotwise.plans.effects import PriceModel
from lotwise.plans.scoring import score, with_linear_gap
from lotwise.sources.listings import RAW_SCHEMA, canonical, clean_listings, kept_listings, typed


def scored_stream(spark: SparkSession, folder: str, m: PriceModel, p: Params = Params()) -> DataFrame:
    """CSV files of ``folder`` with prediction and gap.

    Columns go by the names in the header of the files that are there at the start,
    whatever their order; the raw columns in order if there is none. A file that lands
    later with another header fails the query, it never shifts columns.
    """
    reader = spark.readStream.schema(_header(spark, folder)).option("enforceSchema", False)
    raw = reader.option("header", True).option("escape", '"').option("multiLine", True).csv(folder)
    return with_linear_gap(score(kept_listings(clean_listings(canonical(typed(raw)), p), p), m, p), p)


def _header(spark: SparkSession, folder: str) -> T.StructType:
    try:
        names = spark.read.option("header", True).option("escape", '"').csv(folder).columns
    except AnalysisException as e:
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        names = RAW_SCHEMA.names
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def recent_deals_to(path: str, checkpoint: str, scored: DataFrame, p: Params = Params()) -> StreamingQuery:
    """Append the deals among all files that have landed so far, each file once."""
    return (
        deals_recent_linear(scored, p)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path, format="parquet")
    )
