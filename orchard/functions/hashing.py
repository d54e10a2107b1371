"""Deterministic, partition-independent randomness from row keys.

``randomSplit`` and ``rand`` depend on how rows are laid out in partitions:
the same seed gives a different hold-out after a repartition, so a later job
cannot rebuild the same split.  Everything here is a pure function of the key
columns and a seed, written with built-in expressions (``md5``, ``conv``,
integer arithmetic) that give identical results in any engine with MD5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296
# Prime modulus for the per-replicate uniform stream (2^31 - 1).
STREAM_PRIME = 2147483647


def key_string(keys: list[str], salt: str | int | None = None) -> Column:
    """Key text; a null key part is written as ``\\N``, so (1, null) and
    (null, 1) differ.  Without keys every row would get the same hash."""
    if not keys:
        raise ValueError("a row hash needs at least one key column")
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\\N")) for k in keys]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    return F.concat_ws("#", *parts)


def md5_u32(s: Column, word: int = 0) -> Column:
    """32-bit unsigned integer from hex digits ``8*word+1 .. 8*word+8`` of md5."""
    return F.conv(F.substring(F.md5(s), 8 * word + 1, 8), 16, 10).cast("bigint")


def split_threshold(fraction: float) -> int:
    """Integer cut on the 32-bit hash for a side of size ``fraction``."""
    return int(round(fraction * TWO_32))


def is_holdout(keys: list[str], test_size: float = 0.2, seed: int = 42) -> Column:
    """T-2: true for the hold-out side.  Same keys -> same side, always."""
    return md5_u32(key_string(keys, seed)) < F.lit(split_threshold(test_size))


def fold_of(keys: list[str], num_folds: int = 3, seed: int = 42) -> Column:
    """L-8: fold index in ``[0, num_folds)`` from an independent hash word."""
    return (md5_u32(key_string(keys, seed), word=1) % num_folds).cast("int")


def poisson_cdf_thresholds(modulus: int = STREAM_PRIME) -> list[int]:
    """Integer cut points of the Poisson(1) CDF on ``[0, modulus)``, up to the
    weight whose cut reaches the modulus: no draw lies above the last one."""
    cuts, acc, term, k = [], 0.0, math.exp(-1.0), 0
    while not cuts or cuts[-1] < modulus:
        acc += term
        k += 1
        term /= k
        # the tail beyond a weight of k is less than 2 * term
        cuts.append(modulus if 2 * term * modulus < 1 else int(math.floor(acc * modulus)))
    return cuts


def stream_words(keys: list[str], seed: int) -> tuple[Column, Column]:
    """Two per-row words (a, b) with b != 0 for the replicate stream.

    Salted apart from the split hash: the hold-out is selected on that hash,
    so reusing it would leave only a biased range of values for the stream.
    """
    s = key_string(keys, f"b{seed}")
    a = md5_u32(s, 0) % STREAM_PRIME
    b = md5_u32(s, 1) % (STREAM_PRIME - 1) + 1
    return a, b


def poisson_weight(a: Column, b: Column, replicate: Column) -> Column:
    """B-1b: Poisson(1) bootstrap weight of a row in one replicate.

    ``u = (a + r*b) mod p`` is uniform on ``[0, p)`` for each replicate ``r``
    and independent across rows (a, b come from the row's md5); for one row
    the draws of two replicates are pairwise independent.  ``u`` is turned
    into a weight by inverting the Poisson(1) CDF with integer cut points.
    """
    u = (a + replicate.cast("bigint") * b) % STREAM_PRIME
    cuts = poisson_cdf_thresholds()
    expr = F.when(u < F.lit(cuts[0]), F.lit(0))
    for k, cut in enumerate(cuts[1:], start=1):
        expr = expr.when(u < F.lit(cut), F.lit(k))
    return expr
