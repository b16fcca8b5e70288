"""Forecast and metrics tables on storage.

Forecasts are written partitioned by run, model and target, metrics by run, so
reading a run or a model prunes whole folders; every write goes to a path the
caller names (on a cluster: shared storage, never a machine-local folder).
Writing replaces the partitions it holds rows for and leaves other runs alone.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.score import FORECASTS_SCHEMA, METRICS_COLUMNS

FORECAST_COLUMNS = [f.name for f in FORECASTS_SCHEMA.fields]


def _write(df: DataFrame, path: str, *keys: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    """Uniform forecast records, one folder per (run, model, target)."""
    _write(forecasts.select(*FORECAST_COLUMNS), path, "run_id", "model", "target")


def read_forecasts(spark: SparkSession, path: str, models: list[str] | None = None, run_id: str | None = None,
                   config: Mapping[str, object] | None = None) -> DataFrame:
    """Read back with the fixed schema; run and model filters prune folders, ``config`` is column -> value."""
    df = spark.read.schema(FORECASTS_SCHEMA).parquet(path)
    if models:
        df = df.filter(F.col("model").isin(*models))
    if run_id is not None:
        df = df.filter(F.col("run_id") == run_id)
    for column, value in (config or {}).items():
        df = df.filter(F.col(column) == value)
    return df.select(*FORECAST_COLUMNS)


SCORE_KEYS = ("entity", "target", "date")


@contextlib.contextmanager
def bucketed(df: DataFrame, path: str, buckets: int | None = None) -> Iterator[DataFrame]:
    """``df`` stored under ``path`` in buckets of the scoring keys, one sorted file a bucket, as a table for the time of the block.

    Two tables of as many buckets are joined on the keys where they lie: rows are dealt out once, when
    they are written, however often they are scored.  The files stay when the table is dropped.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"scored_{uuid.uuid4().hex}"
    (df.repartition(n, *SCORE_KEYS).sortWithinPartitions(*SCORE_KEYS).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, *SCORE_KEYS).sortBy(*SCORE_KEYS).saveAsTable(name))
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """The 8-column metrics record under its run."""
    _write(metrics.select(*METRICS_COLUMNS, F.lit(run_id).alias("run_id")), path, "run_id")


def read_metrics(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The metrics record with its run id."""
    df = spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))
    return (df if run_id is None else df.filter(F.col("run_id") == run_id)).select(*METRICS_COLUMNS, "run_id")
