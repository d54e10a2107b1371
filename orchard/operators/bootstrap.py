"""Paired bootstrap of positive-class F1 for two models.

Both forms keep the data on the executors; nothing is collected.

* ``poisson_bootstrap`` (B-1b): each (row, replicate) gets a Poisson(1)
  weight from its key hash, the same weight for both models (paired).
  Rows explode into replicates inside the task and are aggregated map-side
  to one row per (segment, replicate) before the shuffle.  Exactly
  reproducible by any SQL engine with MD5.
* ``multinomial_bootstrap`` (B-1): F1 only depends on the counts of the cells
  (label, pred_a, pred_b), and resampling n rows with replacement gives
  multinomial cell counts.  The data is reduced to at most 8 cells per
  segment, then each replicate is one multinomial draw in ``mapInPandas``.
  Work drops from rows x replicates to 8 x replicates.
"""

from __future__ import annotations

import sys
from functools import partial

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.functions.hashing import poisson_weight, stream_words
from orchard.session import shuffle_partitions

# Functions of this module run in Python workers.  Ship them by value, so the
# workers do not need this package installed (no --py-files step).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den > 0, (2.0 * tp) / den).otherwise(F.lit(0.0))


def poisson_bootstrap(
    df: DataFrame,
    keys: list[str],
    label: str,
    pred_a: str,
    pred_b: str,
    segments: list[str] | None = None,
    replicates: int = 1000,
    seed: int = 42,
    names: tuple[str, str] = ("champion", "challenger"),
) -> DataFrame:
    """One row per (segment, replicate): weighted tp/fp/fn and F1 of both models."""
    seg = segments or []
    a, b = stream_words(keys, seed)
    pos = F.col(label).cast("double") == 1.0
    pa = F.col(pred_a).cast("double") == 1.0
    pb = F.col(pred_b).cast("double") == 1.0
    rows = df.select(
        *seg,
        pos.alias("_y"), pa.alias("_a"), pb.alias("_b"),
        a.alias("_wa"), b.alias("_wb"),
    )
    # Rows that are true negatives for both models add nothing to tp/fp/fn.
    rows = rows.where(F.col("_y") | F.col("_a") | F.col("_b"))
    # The explode below multiplies every row by ``replicates``.  Spread the
    # narrow, pre-filtered rows over the shuffle partitions first (hash of the
    # row's own stream word), so an input with few splits does not leave that
    # work to a few tasks.  Weights depend on the row only, not its placement.
    rows = rows.repartition(shuffle_partitions(df.sparkSession), "_wa")
    ex = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    w = poisson_weight(F.col("_wa"), F.col("_wb"), F.col("replicate"))
    ex = ex.withColumn("_w", w)
    na, nb = names

    def wsum(cond: Column, alias: str) -> Column:
        return F.sum(F.when(cond, F.col("_w")).otherwise(F.lit(0))).cast("bigint").alias(alias)

    y, pa_, pb_ = F.col("_y"), F.col("_a"), F.col("_b")
    agg = ex.groupBy(*seg, "replicate").agg(
        wsum(y & pa_, f"tp_{na}"), wsum(~y & pa_, f"fp_{na}"), wsum(y & ~pa_, f"fn_{na}"),
        wsum(y & pb_, f"tp_{nb}"), wsum(~y & pb_, f"fp_{nb}"), wsum(y & ~pb_, f"fn_{nb}"),
    )
    return agg.withColumns(
        {
            f"f1_{na}": _f1(F.col(f"tp_{na}"), F.col(f"fp_{na}"), F.col(f"fn_{na}")),
            f"f1_{nb}": _f1(F.col(f"tp_{nb}"), F.col(f"fp_{nb}"), F.col(f"fn_{nb}")),
        }
    )


# Cell index = 4 * label + 2 * pred_a + pred_b (binary columns).
_CELLS = 8


def cell_counts(
    df: DataFrame, label: str, pred_a: str, pred_b: str, segments: list[str] | None = None
) -> DataFrame:
    """Per segment, the counts of the 8 (label, pred_a, pred_b) cells: c0..c7."""
    seg = segments or []
    cell = (
        (F.col(label).cast("double") == 1.0).cast("int") * 4
        + (F.col(pred_a).cast("double") == 1.0).cast("int") * 2
        + (F.col(pred_b).cast("double") == 1.0).cast("int")
    )
    return df.groupBy(*seg).agg(
        *[F.sum(F.when(cell == k, 1).otherwise(0)).cast("bigint").alias(f"c{k}") for k in range(_CELLS)]
    )


def segment_salt(segments: list[str]) -> Column:
    """Number that stands for a segment's values, from their text in Spark (a
    pandas batch would turn whole numbers next to a null into floats)."""
    said = [F.coalesce(F.col(s).cast("string"), F.lit("\0")) for s in segments]
    return F.crc32(F.encode(F.concat_ws("\x1f", *said), "utf-8")) if said else F.lit(0).cast("bigint")


def draw_cells(batches, seg: list[str], names: tuple[str, str], seed: int):
    """One multinomial draw per row: cells c0..c7 -> counts and F1 of both models."""
    na, nb = names
    y, a, b = (np.array([(k >> bit) & 1 for k in range(_CELLS)], dtype=bool) for bit in (2, 1, 0))
    for pdf in batches:
        counts = pdf[[f"c{k}" for k in range(_CELLS)]].to_numpy(dtype=np.int64)
        out = np.zeros((len(pdf), _CELLS), dtype=np.int64)
        for i, (salt, replicate) in enumerate(zip(pdf["_salt"].tolist(), pdf["replicate"].tolist())):
            if n := int(counts[i].sum()):
                out[i] = np.random.default_rng([seed + replicate, salt]).multinomial(n, counts[i] / n)
        res = pdf[[*seg, "replicate"]].copy()
        res["replicate"] = res["replicate"].astype("int32")
        for name, p in ((na, a), (nb, b)):
            tp, fp, fn = out[:, y & p].sum(axis=1), out[:, ~y & p].sum(axis=1), out[:, y & ~p].sum(axis=1)
            den = 2 * tp + fp + fn
            res[f"tp_{name}"], res[f"fp_{name}"], res[f"fn_{name}"] = tp, fp, fn
            res[f"f1_{name}"] = np.where(den > 0, 2.0 * tp / np.maximum(den, 1), 0.0)
        yield res[[*seg, "replicate", f"tp_{na}", f"fp_{na}", f"fn_{na}", f"tp_{nb}", f"fp_{nb}", f"fn_{nb}", f"f1_{na}", f"f1_{nb}"]]


def multinomial_bootstrap(
    df: DataFrame,
    label: str,
    pred_a: str,
    pred_b: str,
    segments: list[str] | None = None,
    replicates: int = 1000,
    seed: int = 42,
    names: tuple[str, str] = ("champion", "challenger"),
) -> DataFrame:
    """B-1: replicate i draws with seed (seed + i, segment) for both models."""
    seg = segments or []
    cells = cell_counts(df, label, pred_a, pred_b, seg)
    reps = cells.withColumn("_salt", segment_salt(seg)).select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    reps = reps.repartition(shuffle_partitions(df.sparkSession))
    na, nb = names
    seg_types = {f.name: f.dataType.simpleString() for f in cells.schema.fields if f.name in seg}
    schema = ", ".join(
        [f"`{s}` {seg_types[s]}" for s in seg]
        + ["replicate int"]
        + [f"{m}_{na} bigint" for m in ("tp", "fp", "fn")]
        + [f"{m}_{nb} bigint" for m in ("tp", "fp", "fn")]
        + [f"f1_{na} double", f"f1_{nb} double"]
    )

    return reps.mapInPandas(partial(draw_cells, seg=seg, names=names, seed=seed), schema)
