"""Sinks: quoted CSV, one folder per run, the export set, the split store."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lotwise.workspace import drop_path, exists, list_folders, rename

# fixed values: names of the export files
FULL, FORMATTED, FILTERED, MISSING = (
    "_Export_full",
    "_Export_Formated",
    "_Export_Formated_Filtered",
    "_Export_missing",
)
MISSING_TEXT = "NA"
RUN_FORMAT = "%Y%b%d_%H-%M-%S"
STAGING = "_staging"
MANIFEST = "manifest"
MANIFEST_SCHEMA = "name string, rows bigint, digest string"


def sink_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Header, every value quoted, missing values as ``NA``, nothing overwritten.

    Blanks and line breaks in texts stay. A text that would read as missing gets a
    backslash in front, as does one that looks so marked. With ``compression="gzip"``
    the same text goes to ``.csv.gz`` files, which readers of CSV open as they are.
    """
    marked = {c: _marked(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string"}
    writer = df.withColumns(marked).write.mode("errorifexists").option("header", True).option("quoteAll", True)
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer = writer.option("zlib.compress.level", "BEST_SPEED")  # if compressed: a fifth more bytes, two thirds of the time
    writer.option("escape", '"').option("nullValue", MISSING_TEXT).csv(path, compression=compression)


def _missing_after(text: Column, slashes: str) -> Column:
    """Whether the text is ``NA`` after so many backslashes; few texts end so, the others meet no pattern."""
    return text.endswith(MISSING_TEXT) & text.rlike(rf"\A{slashes}{MISSING_TEXT}\z")


def _marked(text: Column) -> Column:
    return F.when(_missing_after(text, r"\\*"), F.concat(F.lit("\\"), text)).otherwise(text)


def _unmarked(text: Column) -> Column:
    return F.when(_missing_after(text, r"\\+"), F.substring(text, 2, 1 << 30)).otherwise(text)


def read_back_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A file of :func:`sink_csv` as a frame."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    back = reader.option("nullValue", MISSING_TEXT).csv(path)
    return back.withColumns({c: _unmarked(F.col(f"`{c}`")) for c, t in back.dtypes if t == "string"})


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(RUN_FORMAT)


def run_path(base: str, run: str) -> str:
    return f"{base.rstrip('/')}/{run}"


def publish_run(
    base: str, run: str, tables: Mapping[str, DataFrame], compression: str = "none"
) -> dict[str, str]:
    """Write the tables of one run so that readers see all of them or nothing.

    They go into a staging folder beside the runs, then a manifest with the rows and a
    digest of each, and the folder gets its place in one rename, which fails if the run is
    there already. A failed attempt leaves the run id free and takes its staging folder
    along. On storage that renames by copying, the manifest is what makes a run visible:
    :func:`runs` passes over folders without one.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = run_path(base, run)
    if exists(spark, folder):
        raise FileExistsError(f"run {run} is there already: {folder}")
    staging = f"{base.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    try:
        rows = []
        for name, df in tables.items():
            text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
            seen = Observation()
            sink_csv(text.observe(seen, *_fingerprint(_as_written(text))), f"{staging}/{name}", compression)
            rows.append((name, seen.get["n"], str(seen.get["digest"])))
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.json(f"{staging}/{MANIFEST}")
        rename(spark, staging, folder)
    except BaseException:
        drop_path(spark, staging)
        raise
    return {name: f"{folder}/{name}" for name in tables}


def _as_written(text: DataFrame) -> list[Column]:
    return [F.coalesce(_marked(F.col(f"`{c}`")), F.lit(MISSING_TEXT)) for c in text.columns]


def _fingerprint(values: Sequence[Column]) -> list[Column]:
    """Rows, and the sum of their hashes, which does not depend on their order."""
    digest = F.sum(F.xxhash64(*values).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(digest, F.lit(0).cast("decimal(38,0)")).alias("digest")]


def runs(spark: SparkSession, base: str) -> list[str]:
    """Ids of the runs that are whole, in byte order."""
    names = list_folders(spark, base)
    return sorted(n for n in names if n != STAGING and exists(spark, f"{run_path(base, n)}/{MANIFEST}/_SUCCESS"))


def manifest(spark: SparkSession, base: str, run: str) -> DataFrame:
    """(name, rows, digest) of the tables of a run."""
    if run not in runs(spark, base):
        raise FileNotFoundError(f"no whole run {run} in {base}")
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{run_path(base, run)}/{MANIFEST}")


def read_run(spark: SparkSession, base: str, name: str, schema: StructType, chosen: Sequence[str] | None = None) -> DataFrame:
    """Table ``name`` of all whole runs, or of the ``chosen`` ones, with its ``run_id`` in front."""
    whole = runs(spark, base)
    met = whole if chosen is None else [r for r in whole if r in set(chosen)]
    parts = [
        read_back_csv(spark, f"{run_path(base, r)}/{name}", schema).select(F.lit(r).alias("run_id"), "*")
        for r in met
        if exists(spark, f"{run_path(base, r)}/{name}")
    ]
    if not parts:
        return spark.createDataFrame([], StructType([StructField("run_id", StringType()), *schema.fields]))
    return reduce(DataFrame.unionByName, parts)


def damaged_tables(spark: SparkSession, base: str, run: str) -> list[str]:
    """Names of the run's tables that are not what the manifest says, read anew."""
    bad = []
    for row in manifest(spark, base, run).collect():
        path = f"{run_path(base, run)}/{row['name']}"
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        raw = reader.option("emptyValue", "").csv(path) if exists(spark, path) else None
        if raw is None or not raw.columns:
            bad += [row["name"]] if raw is None or row["rows"] else []
            continue
        values = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]
        found = raw.agg(*_fingerprint(values)).first()
        if (found["n"], str(found["digest"])) != (row["rows"], row["digest"]):
            bad.append(row["name"])
    return bad


def export_run(
    base: str,
    run: str,
    full: DataFrame,
    formatted: DataFrame,
    filtered: DataFrame,
    missing: DataFrame | None = None,
    suffix: str = "",
    compression: str = "none",
) -> dict[str, str]:
    """Publish the files of one run; a run id is never written twice."""
    tables = {
        f"{FULL}{suffix}": full,
        f"{FORMATTED}{suffix}": formatted,
        f"{FILTERED}{suffix}": filtered,
    }
    if missing is not None:
        tables[MISSING] = missing
    return publish_run(base, run, tables, compression)


def store_split_sets(df: DataFrame, path: str) -> None:
    """Train, test and validation rows as one table partitioned by ``split``."""
    df.write.mode("errorifexists").partitionBy("split").parquet(path)
