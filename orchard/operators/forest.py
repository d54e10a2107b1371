"""Fitted forests as a table of nodes.

``node_table`` gives a saved forest's nodes as rows, from the public on-disk
format of ``pyspark.ml``; any engine can score with it.  ``score_with_nodes``
does so in Spark: all (row, tree) pairs start at the root and one join a level
moves them down.  ``prefix_scores`` evaluates the first k trees of a forest, cut
at several depths, for several k in one pass over the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.session import fresh_path

# Functions of this module run in Python workers.  Ship them by value, so the
# workers do not need this package installed (no --py-files step).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_nodes(forest_path: str, spark) -> DataFrame:
    """Nodes of a forest saved under ``forest_path``:

    ``tree, node, feature, threshold, left, right, value, n_rows``.  A leaf has
    null ``feature``; a row with ``features[feature] <= threshold`` goes left.
    ``value`` is the mean label of a regression leaf and the share of class 1
    of a classification leaf; ``n_rows`` counts training rows before weights.
    """
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    stats = n["impurityStats"]
    meta = spark.read.text(f"{forest_path}/metadata").first()["value"]
    value = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if "Classification" in meta else n["prediction"]
    data = spark.read.parquet(f"{forest_path}/data")
    categories = F.when(inner, F.assert_true(n["split"]["numCategories"] == -1, F.lit("categorical splits have no threshold")))
    return data.withColumn("_checked", categories).select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(inner & F.col("_checked").isNull(), n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        value.alias("value"), n["rawCount"].alias("n_rows"),
    )


def node_table(forest, spark) -> DataFrame:
    """``read_nodes`` of a fitted forest, which is saved to the work folder."""
    path = fresh_path(spark, "forest")
    forest.write().save(path)
    return read_nodes(path, spark)


def score_with_nodes(rows: DataFrame, nodes: DataFrame, trees: int, depth: int, keys: list[str], features: str = "features") -> DataFrame:
    """(keys, features, score): mean leaf value over the trees, by ``depth``
    joins of (row, tree) pairs with the node table.

    The node table has at most trees x 2^(depth+1) rows, whatever the data;
    Spark broadcasts it by its measured bytes and shuffles it otherwise.  Rows
    that are equal in keys and features count once.
    """
    at = rows.select(*keys, vector_to_array(F.col(features)).alias("features")).distinct()
    at = at.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(0))
    inner = nodes.where(F.col("feature").isNotNull()).select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        goes_left = F.get("features", F.col("feature")) <= F.col("threshold")
        step = F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").select(*keys, "features", "tree", step.alias("node"))
    leaves = nodes.where(F.col("feature").isNull()).select("tree", "node", "value")
    return at.join(leaves, ["tree", "node"]).groupBy(*keys, "features").agg(F.avg("value").alias("score"))


def _walk_table(forest, spark, depths: list[int] | None = None):
    """What it takes to walk a forest's trees: children (right, left) of every
    node, a leaf's being itself, feature, threshold, the roots, the number of
    steps to the deepest leaf, and one row of values per depth: what a leaf's
    rows get from the tree cut there."""
    columns = ["tree", "node", "feature", "threshold", "left", "right", "value"]
    nodes = node_table(forest, spark).select(*columns).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    tree, value = nodes["tree"].to_numpy(), nodes["value"].to_numpy()
    start = np.searchsorted(tree, np.arange(forest.getNumTrees))
    leaf = nodes["left"].is_null().to_numpy()
    left, right = (np.where(leaf, -1, nodes[c].fill_null(0).to_numpy().astype(np.int64) + start[tree]) for c in ("left", "right"))
    # Leaves that predict alike are one leaf in a fitted tree.
    told = value > 0.5 if hasattr(forest, "numClasses") else value
    rows = np.stack([cut_values(left, right, value, told, start, d) for d in depths] if depths else [value])
    own = np.arange(len(leaf))
    children = np.stack([np.where(leaf, own, right), np.where(leaf, own, left)], axis=1).ravel()
    steps, at = 0, start[~leaf[start]]
    while at.size:
        steps, at = steps + 1, np.concatenate([left[at], right[at]])
        at = at[~leaf[at]]
    return children, nodes["feature"].fill_null(0).to_numpy().astype(np.int64), nodes["threshold"].fill_null(0.0).to_numpy(), start, steps, rows


def cut_values(left: np.ndarray, right: np.ndarray, value: np.ndarray, told: np.ndarray, roots: np.ndarray, depth: int) -> np.ndarray:
    """For every node the value of the leaf it falls into when its tree is cut
    at ``depth`` and sibling leaves with equal ``told`` are merged, as a fit to
    that depth does."""
    levels = [roots]
    while levels[-1].size:
        inner = levels[-1][left[levels[-1]] >= 0]
        levels.append(np.concatenate([left[inner], right[inner]]))
    ends = left < 0
    for at in levels[depth : depth + 1]:
        ends[at] = True
    for at in reversed(levels[:depth]):
        at = at[~ends[at]]
        a, b = left[at], right[at]
        ends[at] = ends[a] & ends[b] & (told[a] == told[b])
    holder = np.where(ends, np.arange(len(left)), -1)
    for at in levels[:-1]:
        at = at[left[at] >= 0]
        for child in (left[at], right[at]):
            holder[child] = np.where(holder[at] >= 0, holder[at], holder[child])
    return value[holder]


def prefix_scores(
    forest, rows: DataFrame, counts: list[int], keep: list[str], out: str = "scores",
    depths: list[int] | None = None, first_tree: int = 0, before: str | None = None,
) -> DataFrame:
    """``keep`` columns plus ``out``: for each k of ``counts`` the mean leaf
    value of the forest's first k trees (a regression's prediction, a
    classifier's score for class 1); with ``depths``, for each depth in turn
    those of the trees cut there.

    A large forest may come in parts: this one's trees begin at ``first_tree``,
    and the column ``before`` holds what the parts before it gave.

    The trees, at most trees x 2^(depth+1) nodes, are broadcast; a batch of rows
    walks down all at a time, and the leaf values, one per entry of ``depths``,
    are summed along the trees once.
    """
    spark = rows.sparkSession
    table = spark.sparkContext.broadcast(_walk_table(forest, spark, depths))
    trees = forest.getNumTrees
    took = np.clip(np.array(counts) - first_tree, 0, trees)

    @F.arrow_udf("array<double>")
    def along(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        children, feature, threshold, roots, steps, values = table.value
        for part in parts:
            n = len(part)
            x = part.flatten().to_numpy(zero_copy_only=False)
            first = np.arange(n) * (len(x) // max(n, 1))
            sums, means = np.zeros((n, len(values))), np.zeros((n, len(values), len(counts)))
            for t in range(trees):
                at = np.full(n, roots[t])
                for _ in range(steps):
                    goes_left = x[first + feature[at]] <= threshold[at]
                    at = children[2 * at + goes_left]
                sums += values[:, at].T
                for i in np.flatnonzero(took == t + 1):
                    means[:, :, i] = sums / counts[i]
            width = means.shape[1] * means.shape[2]
            yield pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, means.ravel())

    scores = along(vector_to_array(F.col(forest.getFeaturesCol())))
    if before is not None:
        scores = F.zip_with(F.col(before), scores, lambda a, b: a + b)
    return rows.select(*keep, scores.alias(out))
