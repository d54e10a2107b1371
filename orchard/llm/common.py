"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.session import fresh_path

#: ASCII white space of the word contracts, as a regex class body.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, so a
    lost executor costs only the tasks that were running on it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus`` (the contracts' hold-out)."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "utf-8")), F.lit(modulus))


def word_count(text: Column) -> Column:
    """Number of runs of non-white-space; 0 for null."""
    flat = F.btrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(F.length(flat) > 0, F.size(F.split(flat, " +"))).otherwise(F.lit(0)).cast("long")


def components(nodes: DataFrame, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node reachable over undirected ``links``.

    ``links`` holds (a, b) pairs, any direction, repeats allowed; nodes without
    links are their own component.  Each round every node takes the smallest
    label of its neighbours and then jumps to its label's label, so a chain of
    length n needs about log2(n) rounds.  A group's star around its smallest
    member needs one.  Labels are checkpointed each round.
    """
    spark = nodes.sparkSession
    both = links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("l")), "labels")
    for _ in range(max_rounds):
        # smallest label among the neighbours, sent along the links
        spread = both.join(labels.select(F.col("n").alias("a"), "l"), "a").groupBy(F.col("b").alias("n")).agg(F.min("l").alias("m"))
        step = labels.join(spread, "n").select("n", "l", F.least("l", "m").alias("s"))
        # hook: the old label's other holders also learn the smaller label
        hook = step.where("s < l").groupBy(F.col("l").alias("l")).agg(F.min("s").alias("h"))
        step = step.join(hook, "l", "left").select("n", F.col("l").alias("old"), F.least("s", F.coalesce("h", "s")).alias("l"))
        # jump: take the label that the new label's node held
        up = labels.select(F.col("n").alias("l"), F.col("l").alias("up"))
        nxt = materialize(step.join(up, "l", "left").select("n", "old", F.least(F.col("l"), F.coalesce("up", "l")).alias("l")), "labels")
        changed = nxt.where("l <> old").limit(1).count()
        labels = nxt.select("n", "l")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(labels.withColumnRenamed("n", "node"), "node", "left").select("node", F.coalesce("l", "node").alias("component"))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of one key each, from batches sorted by the key columns.

    Only the rows of the key at hand are held; callers bound a key's rows by
    splitting hot keys into chunks beforehand.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word (ASCII-lowered run of non-white-space).

    A polynomial in 2**64 arithmetic over the word's bytes, taken from one
    prefix sum over the whole text, then mixed.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not raw.size:
        return np.empty(0, np.uint64)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not start.size:
        return np.empty(0, np.uint64)
    n = raw.size
    powers, inverse = _powers(n)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)))
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_POWERS: dict[str, np.ndarray] = {}
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or _POWERS["p"].size < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("p", _BASE), ("i", _INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["p"], _POWERS["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that tasks which
    follow one another in it need not rebuild tables of fixed size.  A worker
    keeps the tables of one name: another operator's go first."""
    import sys
    import types

    holder = sys.modules.setdefault("_orchard_worker_cache", types.ModuleType("_orchard_worker_cache"))
    held = holder.__dict__.setdefault("held", {})
    if name not in held:
        held.clear()
        held[name] = {}
    return held[name]


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that a worker holds few texts as
    Python strings at a time.  What a batch took goes back to the system."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
        del b
        pa.default_memory_pool().release_unused()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A batch's texts, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
