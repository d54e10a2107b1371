"""Incremental batch inference with Structured Streaming.

The daily inference job scores whatever files landed since the last run.  As
a file-source stream with ``trigger(availableNow=True)`` each run processes
exactly the new files (tracked in the checkpoint), then stops; a failed run
resumes from the checkpoint without scoring a file twice.  The checkpoint
lives in the shared folder (``spark.checkpoint.dir``), never on a local disk.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators import scoring


def _next_batch(spark: SparkSession, checkpoint_dir: str) -> int:
    """Id the next micro-batch will have, from the checkpoint's commit log."""
    try:
        done = spark.read.format("binaryFile").load(f"{checkpoint_dir}/commits").select(F.regexp_extract("path", r"/(\d+)$", 1).alias("b"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    last = done.where("b <> ''").agg(F.max(F.col("b").cast("long"))).first()[0]
    return 0 if last is None else last + 1


def score_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    model: PipelineModel,
    keep: list[str],
    sink_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    timeout_s: int | None = None,
) -> int:
    """Score every not-yet-seen file under ``source_dir`` into ``sink_dir``
    (Parquet, partitioned by ingestion date).  Returns the number of
    micro-batches run.  ``fmt`` is ``parquet`` or ``csv`` (with header)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        stream = reader.option("header", "true").csv(source_dir)
    else:
        stream = reader.parquet(source_dir)
    scored = scoring.score(model, stream, keep=keep).withColumn("score_date", F.current_date().cast("string"))
    first = _next_batch(spark, checkpoint_dir)
    q = (
        scored.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy("score_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
    if not finished:
        q.stop()
        raise TimeoutError(f"not all files were scored within {timeout_s} s; the next run goes on from the checkpoint")
    if q.exception() is not None:
        raise q.exception()
    # Batch ids count up over the checkpoint's life; recentProgress keeps only the newest.
    ids = [p.batchId for p in q.recentProgress if p.numInputRows]
    return max(ids) - first + 1 if ids else 0
