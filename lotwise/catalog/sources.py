"""Scans, literal rows, sinks and stores."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lotwise.catalog import sql as S
from lotwise.catalog.registry import query
from lotwise.catalog.rounding import r
from lotwise.catalog.study import P
from lotwise.functions.keys import with_keys
from lotwise.operators.groups import left_lookup
from lotwise.operators.profile import count_by
from lotwise.operators.rank import missing_trims, union_rows
from lotwise.plans import deals
from lotwise.plans.effects import PriceModel, fit, refit
from lotwise.plans.scoring import score
from lotwise.sources import sinks
from lotwise.sources.listings import (
    RAW_COLUMNS,
    clean_listings,
    literal_rows,
    scan_listings_csv,
)
from lotwise.workspace import new_path

RUN = sinks.run_id(datetime(2024, 4, 18, 11, 54, 3))

# cars typed in by hand: make, model, trim, personal, year, gear_type, cylinder, mileage
CARS = [
    ("Brand#2", "ECONOMY", "T2", "", 2000, "A", 6, 10000.0),
    ("Brand#17", "ECONOMY", "T1", "", 1999, "N", 4, 90000.0),
    ("Brand#4", "SMALL", "T2", "", 1996, "R", 6, 125000.0),
    ("Brand#9", "STANDARD", "T0", "", 2001, "N", 4, 0.0),
    ("Brand#11", "LARGE", "T0", "", 1998, "A", 6, 175000.0),
    ("Brand#2", "ECONOMY", "Sport", "", 2000, "A", 8, 10000.0),
    ("Unknown", "ECONOMY", "T2", "", 2000, "A", 6, 10000.0),
]
CARS_SQL = """
cars AS (SELECT * FROM (VALUES
  ('Brand#2', 'ECONOMY', 'T2', 2000, 'A', 6, 10000.0::DOUBLE),
  ('Brand#17', 'ECONOMY', 'T1', 1999, 'N', 4, 90000.0),
  ('Brand#4', 'SMALL', 'T2', 1996, 'R', 6, 125000.0),
  ('Brand#9', 'STANDARD', 'T0', 2001, 'N', 4, 0.0),
  ('Brand#11', 'LARGE', 'T0', 1998, 'A', 6, 175000.0),
  ('Brand#2', 'ECONOMY', 'Sport', 2000, 'A', 8, 10000.0),
  ('Unknown', 'ECONOMY', 'T2', 2000, 'A', 6, 10000.0)
) v(make, model, trim, year, gear_type, cylinder, mileage)),
keyed_cars AS (SELECT *, make || '-' || model AS model_key, 0 AS price,
  concat_ws('-', make, make, model, trim, cylinder, gear_type) AS trim_key FROM cars)"""

_TYPED = "id, make, model, trim, year, price, mileage, cylinder, gear_type, personal, likes, date_sold"


# texts that a CSV file may lose: blanks, line breaks, quotes, what stands for missing
_HARD = [" x ", "a\nb", 'say "a, b"', "", "a\r\nb", "\t", "NA", "\\NA"]
_HARD_SQL = "[' x ', 'a' || chr(10) || 'b', 'say \"a, b\"', '', 'a' || chr(13) || chr(10) || 'b', chr(9), 'NA', '\\NA']"


def _hard_text(n: int = len(_HARD)):
    return F.get(F.array(*[F.lit(x) for x in _HARD[:n]]), F.col("likes").cast("int"))


@query(
    "scan_listings_csv",
    S.CLEAN
    + f"""SELECT {_TYPED.replace("trim,", "hard AS trim,")}
    FROM (SELECT *, {_HARD_SQL}[1:6][CAST(likes AS INT) + 1] AS hard FROM cleaned)""",
)
def _(s):
    path = new_path(s.spark, "listings_csv")
    names = {ours: theirs for theirs, ours in RAW_COLUMNS.items()}
    raw = s.raw.withColumns({"car": F.lit(""), "trim": _hard_text(6)})
    sinks.sink_csv(raw.select(*[F.col(c).alias(n) for c, n in names.items()]), path)
    return clean_listings(scan_listings_csv(s.spark, path), P).select(*_TYPED.split(", "))


@query(
    "literal_rows",
    S.chain(S.LISTINGS, S.CLEANED, S.KEPT, CARS_SQL)
    + """SELECT c.trim_key, c.year, c.mileage, count(k.id) AS n
    FROM keyed_cars c LEFT JOIN kept k USING (trim_key) GROUP BY ALL""",
)
def _(s):
    cars = with_keys(literal_rows(s.spark, CARS))
    known = left_lookup(cars, count_by(s.kept, "trim_key"), ["trim_key"])
    return known.select("trim_key", "year", "mileage", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "sink_csv",
    S.KEEP + f"SELECT id, {_HARD_SQL}[CAST(likes AS INT) + 1] AS note, model_key, year, price, mileage FROM kept",
)
def _(s):
    path = new_path(s.spark, "kept_csv")
    rows = s.kept.select("id", _hard_text().alias("note"), "model_key", "year", "price", "mileage")
    sinks.sink_csv(rows, path)
    return sinks.read_back_csv(s.spark, path, rows.schema)


@query("run_versioned_output", S.KEEP + f"SELECT '{RUN}' AS run_id, id, price FROM kept")
def _(s):
    base = new_path(s.spark, "runs")
    rows = s.kept.select("id", "price")
    sinks.publish_run(base, RUN, {"kept": rows})
    return sinks.read_run(s.spark, base, "kept", rows.schema)


@query(
    "run_manifests",
    S.KEEP
    + """SELECT run_id, name, CASE name WHEN 'kept' THEN count(*) ELSE count(DISTINCT trim_key) END AS rows, TRUE AS undamaged
    FROM kept, (VALUES ('2024Apr18_11-54-03'), ('2024Apr19_00-00-00')) r(run_id), (VALUES ('kept'), ('trims')) n(name)
    GROUP BY run_id, name""",
)
def _(s):
    base = new_path(s.spark, "runs")
    tables = {"kept": s.kept_table.select("id", "price", "model_key"), "trims": s.kept_table.select("trim_key").distinct()}
    broken = {**tables, "trims": tables["trims"].withColumn("trim_key", F.raise_error(F.lit("lost")).cast("string"))}
    out = []
    for run, attempts in ((RUN, (broken, tables)), ("2024Apr19_00-00-00", (tables, tables))):
        for attempt in attempts:  # the first run needs a second attempt, the second refuses one
            try:
                sinks.publish_run(base, run, attempt)
            except (PySparkException, FileExistsError):
                pass
    for run in sinks.runs(s.spark, base):
        bad = sinks.damaged_tables(s.spark, base, run)
        listed = sinks.manifest(s.spark, base, run)
        out.append(listed.select(F.lit(run).alias("run_id"), "name", "rows", (~F.col("name").isin(bad)).alias("undamaged")))
    return union_rows(*out)


@query("effect_table_store", S.SCORED + "SELECT id, rounded(pred3, 2) AS pred3 FROM scored")
def _(s):
    path = new_path(s.spark, "model")
    s.model.save(path)
    again = PriceModel.load(s.spark, path)
    return score(s.split, again, P).select("id", r("pred3").alias("pred3"))


@query("merged_effect_tables", S.SCORED + "SELECT id, rounded(pred3, 2) AS pred3 FROM scored")
def _(s):
    # fitted on the rows known before, stored, then grown by the fresh ones
    path = new_path(s.spark, "model")
    fit(s.split.filter(F.col("posted_time").isNull()), P).save(path)
    grown = refit(PriceModel.load(s.spark, path), s.split.filter(F.col("posted_time").isNotNull()), P)
    return score(s.split, grown, P).select("id", r("pred3").alias("pred3"))


@query(
    "four_exports",
    S.RECENT
    + """SELECT '_Export_full' AS file, id, CAST(CAST(price AS BIGINT) AS VARCHAR) AS price,
      CAST(CAST(mileage AS BIGINT) AS VARCHAR) AS mileage, date_sold AS note FROM scored
    UNION ALL SELECT '_Export_Formated', id, format('{:,}', CAST(price AS BIGINT)),
      format('{:,}', CAST(mileage AS BIGINT)), date_sold FROM scored
    UNION ALL SELECT '_Export_Formated_Filtered', id, format('{:,}', CAST(price AS BIGINT)),
      format('{:,}', CAST(mileage AS BIGINT)), NULL FROM scored WHERE l_gap > 10
    UNION ALL SELECT DISTINCT '_Export_missing', trim_key, NULL, NULL, NULL FROM fresh
      WHERE trim_key NOT IN (SELECT trim_key FROM known)""",
)
def _(s):
    from lotwise.workspace import stored

    scored = stored(deals.scored_recent(s.fresh, s.known_model, P), "fresh_scored")
    shown = deals.formatted(deals.select_rename(scored, deals.FULL_LINEAR_COLUMNS))
    tables = {
        "full": scored,
        "formatted": shown,
        "filtered": deals.formatted(deals.deals_recent_linear(scored, P)),
        "missing": missing_trims(s.fresh, s.known).withColumnRenamed("trim_key", "x"),
    }
    # every column of every fresh row as quoted text is ten times the stored table and more
    paths = sinks.export_run(new_path(s.spark, "exports"), RUN, **tables, compression="gzip")
    files = [
        (name, sinks.read_back_csv(s.spark, path, df.schema)) for (name, path), df in zip(paths.items(), tables.values())
    ]
    none = F.lit(None).cast("string")
    whole = lambda name: F.col(name).cast("bigint").cast("string")
    columns = [
        ("id", whole("price"), whole("mileage"), F.col("date_sold")),
        ("Id", F.col("Price"), F.col("Mileage"), F.col("Date_sold")),
        ("Id", F.col("Price"), F.col("Mileage"), none),
        ("x", none, none, none),
    ]
    parts = [
        df.select(F.lit(name).alias("file"), F.col(key).alias("id"), price.alias("price"), mileage.alias("mileage"), note.alias("note"))
        for (name, df), (key, price, mileage, note) in zip(files, columns)
    ]
    return union_rows(*parts)


@query("split_sets_store", S.SPLIT + "SELECT id, split FROM split")
def _(s):
    path = new_path(s.spark, "split_sets")
    sinks.store_split_sets(s.split, path)
    return s.spark.read.parquet(path).select("id", "split")
