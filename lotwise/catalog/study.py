"""Shared inputs of the catalog's queries over one folder of test tables.

Each step that several queries need (kept rows, split, fitted model) is derived from the
tables once per session and stored in the session's shared folder.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.plans import effects, forest
from lotwise.operators.split import split_with_coverage
from lotwise.plans.effects import PriceModel
from lotwise.plans.scoring import score, with_linear_gap
from lotwise.sources import tpch
from lotwise.sources.listings import clean_listings, kept_listings
from lotwise.workspace import stored

P = tpch.TPCH_PARAMS

_STUDIES: dict[tuple[str, str], "Study"] = {}


class Study:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @staticmethod
    def of(spark: SparkSession, sf_dir: str) -> "Study":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _STUDIES:
            _STUDIES[key] = Study(spark, sf_dir)
        return _STUDIES[key]

    @staticmethod
    def forget() -> None:
        """Drop every shared step, so that the next query derives it again."""
        _STUDIES.clear()

    @property
    def raw(self) -> DataFrame:
        return tpch.listings(self.spark, self.sf_dir)

    @property
    def cleaned(self) -> DataFrame:
        return clean_listings(self.raw, P)

    @property
    def kept(self) -> DataFrame:
        return kept_listings(self.cleaned, P)

    @cached_property
    def kept_table(self) -> DataFrame:
        raw = tpch.listings(self.spark, self.sf_dir, spread_out=True)
        return stored(kept_listings(clean_listings(raw, P), P), "kept")

    @cached_property
    def split(self) -> DataFrame:
        return stored(split_with_coverage(self.kept_table, P, tpch.order_bucket()), "split")

    @cached_property
    def model(self) -> PriceModel:
        return effects.fit(self.split, P)

    @property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("split") == "train")

    @property
    def scored(self) -> DataFrame:
        """Full data with predictions and linear gap."""
        return with_linear_gap(score(self.split, self.model, P, with_count=True), P)

    # the fresh scrape: listings posted within hours; the known data: all others
    @property
    def known(self) -> DataFrame:
        return self.kept_table.filter(F.col("posted_time").isNull())

    @property
    def fresh(self) -> DataFrame:
        return self.kept_table.filter(F.col("posted_time").isNotNull())

    @cached_property
    def known_split(self) -> DataFrame:
        return stored(split_with_coverage(self.known, P, tpch.order_bucket()), "known_split")

    @cached_property
    def known_model(self) -> PriceModel:
        return effects.fit(self.known_split, P)

    @property
    def fresh_scored(self) -> DataFrame:
        return with_linear_gap(score(self.fresh, self.known_model, P), P)

    @cached_property
    def forest(self):
        return forest.rf_train(self.kept_table, P)

    @cached_property
    def onehot_forest(self):
        return forest.rf_train(self.kept_table, replace(P, rf_encoding="onehot"))

    @cached_property
    def known_forest(self):
        return forest.rf_train(self.known, P)
