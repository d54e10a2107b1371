"""Scans.

CSV inputs are read with an explicit schema by default: type inference costs
an extra full pass over the files and can change types from one file to the
next.  Inference stays available for ad-hoc inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the raw metrics CSV the batch jobs
# consume (one row per node measurement).  The label is ``query_latency``.
METRICS_CSV_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.IntegerType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("query_latency", T.DoubleType()),
        T.StructField("cpu_utilization", T.DoubleType()),
        T.StructField("memory_utilization", T.DoubleType()),
        T.StructField("disk_io", T.DoubleType()),
        T.StructField("network_latency", T.DoubleType()),
        T.StructField("network_bandwidth", T.DoubleType()),
        T.StructField("active_queries", T.IntegerType()),
        T.StructField("system_load", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("error_rate", T.IntegerType()),
    ]
)

METRICS_LABEL = "query_latency"
FRAUD_LABEL = "fraud"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    header: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV scan with a header.  Give ``schema`` (preferred) or ``infer=True``."""
    reader = spark.read.option("header", str(header).lower()).option("mode", mode)
    if schema is not None:
        # Names in the header must match the schema: columns that changed
        # places would otherwise be read with swapped values.
        reader = reader.schema(schema).option("enforceSchema", str(not header).lower())
    elif infer:
        reader = reader.option("inferSchema", "true")
    else:
        raise ValueError("read_csv needs a schema, or infer=True for an extra pass")
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan; filters and projections reach the scan through Catalyst."""
    if isinstance(path, (list, tuple)):
        return spark.read.parquet(*path)
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's test tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def s3a_conf(
    endpoint_url: str,
    access_key: str,
    secret_key: str,
    ssl: bool = True,
    path_style: bool = True,
) -> dict[str, str]:
    """Object-store settings for ``build_session(extra_conf=...)`` (S-3).

    On a managed cluster these usually come from the submit command or an
    instance profile; nothing here is printed or logged.
    """
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint_url,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
