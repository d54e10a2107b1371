"""Train / hold-out splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.functions.hashing import fold_of, is_holdout

TRAIN, TEST = "train", "test"


def with_split(
    df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42, col: str = "split"
) -> DataFrame:
    """T-2: tag each row ``train`` or ``test`` from a hash of its key.

    Unlike ``randomSplit`` the side of a row does not depend on partitioning,
    so the A/B job rebuilds exactly the hold-out the training job left out.
    """
    return df.withColumn(
        col, F.when(is_holdout(keys, test_size, seed), F.lit(TEST)).otherwise(F.lit(TRAIN))
    )


def hash_split(
    df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """T-2 as two DataFrames (train, test).  Both are lazy filters of one scan."""
    flag = is_holdout(keys, test_size, seed)
    return df.where(~flag), df.where(flag)


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """T-1: ``randomSplit`` kept as an option (partition-dependent)."""
    train, test = df.randomSplit([1.0 - test_size, test_size], seed=seed)
    return train, test


def split_sizes(tagged: DataFrame, col: str = "split") -> DataFrame:
    """T-3: sizes of both sides in one aggregation (not one count job per side)."""
    return tagged.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def with_folds(
    df: DataFrame, keys: list[str], num_folds: int = 3, seed: int = 42, col: str = "fold"
) -> DataFrame:
    """L-8: reproducible fold column for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, fold_of(keys, num_folds, seed))


def fold_sizes(folded: DataFrame, col: str = "fold") -> DataFrame:
    return folded.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
