"""Near-duplicate embeddings by randomised-rotation binary codes.

Equal vectors of one label form a class first; only its smallest id goes on,
with the class's size.  A vector's code is the signs of its unit vector after a
random rotation, packed to one bit each and stored with the correction factor
f = <unit, code>, once per vector; in a bucket <x, code_y> / f_y estimates <x, y> without bias, with an error of about
``ERROR * sqrt((1 - f^2) / f^2 / (D - 1))`` at most.  A pair whose estimate plus
that bound stays below the threshold is dropped; every other pair is computed
again in double precision, so no pair below the threshold links.

Pairs to estimate share a bucket: ``b`` sign bits of further rotations, in as
many tables as it takes to miss a pair at the threshold with probability
``MISS`` at most (b grows with the logarithm of the largest label, so a bucket
of unrelated vectors keeps its size).  A pair counts in the first table it
shares.  Buckets above ``CHUNK`` rows are split into pairs of chunks; nothing is
capped.  Tasks return counts and the links that connect their rows, not pairs.

Nulls and odd rows: a null label, or a vector that is null, zero, empty, of
another length than most, or holds null or non-finite components, links with
nothing; rows that share a ``vec_id`` are one node of the graph but keep a row
each; an empty table gives an empty result; columns other than ``vec_id,
embedding, label`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import components, grouped, materialize
from orchard.llm.vectors import dimension, matrix, rotation, row_dots, usable

THRESHOLD = 0.93
MISS = 1e-6
ERROR = 5.5
BUCKET_ROWS = 128
CHUNK = 2048
PAIRS_AT_ONCE = 1024


def tables_for(rows: int) -> tuple[int, int]:
    """(bits, tables) for a label of ``rows`` vectors."""
    bits = max(0, min(30, round(math.log2(max(rows, 1) / BUCKET_ROWS)))) if rows > BUCKET_ROWS else 0
    agree = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, 1 if agree >= 1 else math.ceil(math.log(MISS) / math.log(1 - agree))


def table_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket keys from the signs after several rotations."""
    if not bits:
        return np.zeros((len(unit), tables), np.int64)
    dim = unit.shape[1]
    signs = np.concatenate([unit @ rotation(dim, 100 + r) > 0 for r in range(-(-bits * tables // dim))], 1)
    return signs[:, : bits * tables].reshape(len(unit), tables, bits) @ (1 << np.arange(bits))


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and correction factors of unit vectors."""
    turned = unit @ rotation(unit.shape[1], 1)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def unpacked(codes: np.ndarray, dim: int) -> np.ndarray:
    """Packed codes as unit vectors of the rotated space."""
    return (np.unpackbits(codes, axis=1, count=dim) * 2.0 - 1.0) / math.sqrt(dim)


def link_bucket(ids: np.ndarray, weights: np.ndarray, side: np.ndarray, x: np.ndarray, codes: np.ndarray, f: np.ndarray, table: int, bits: int, tables: int, one: bool) -> tuple[dict, list]:
    """(links per id, connecting links) among one bucket's vectors.  ``one``:
    all rows against each other, else side 0 against side 1."""
    unit = _units(x)
    dim = unit.shape[1]
    keys = table_keys(unit, bits, tables)[:, :table]
    turned, code = unit @ rotation(dim, 1), unpacked(codes, dim)
    bound = ERROR * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(dim - 1, 1))
    left, right = (np.arange(len(ids)),) * 2 if one else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    counts: dict[int, int] = {}
    root = np.arange(len(ids))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    links = []
    for lo in range(0, len(left), PAIRS_AT_ONCE):
        own = left[lo : lo + PAIRS_AT_ONCE]
        estimate = (turned[own] @ code[right].T) / f[right] + bound[right]
        i, j = np.nonzero(estimate >= THRESHOLD)
        i, j = own[i], right[j]
        if one:
            i, j = i[i < j], j[i < j]
        if table:  # counted already where an earlier table holds both
            new = np.ones(i.size, bool)
            for at in range(0, i.size, 1 << 18):
                s = slice(at, at + (1 << 18))
                new[s] = ~(keys[i[s]] == keys[j[s]]).any(1)
            i, j = i[new], j[new]
        near = row_dots(unit, i, unit, j) >= THRESHOLD
        i, j = i[near], j[near]
        n = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
        for a in np.flatnonzero(n):
            counts[int(ids[a])] = counts.get(int(ids[a]), 0) + int(n[a])
        for a, b in zip(i.tolist(), j.tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                links.append((int(ids[a]), int(ids[b])))
    return counts, links


def near_duplicates(rows: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), F.col("label").alias("label"))
    fine = every.where(usable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    dim = dimension(fine, "v")
    classes = materialize(fine.where(F.size("v") == dim).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w")), "vec-classes")
    bits, tables = tables_for(classes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = _units(matrix(b.column("v"), dim))
            codes, factors = encode(unit)
            keys = table_keys(unit, bits, tables)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("label", "v", "rep", "w")), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(factors), pa.array(keys.tolist(), pa.list_(pa.int64()))], names=["label", "v", "rep", "w", "code", "factor", "keys"])

    schema = classes.select("label", "v", "rep", "w", F.lit(b"").alias("code"), F.lit(0.0).alias("factor"), F.array(F.lit(0).cast("long")).alias("keys")).schema
    coded = materialize(classes.mapInArrow(keyed, schema), "vec-codes")
    dealt = coded.select("label", "rep", "w", "v", "code", "factor", F.posexplode("keys").alias("t", "key"))
    large = dealt.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CHUNK)
    large = large.select("label", "t", "key", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks"))
    split = dealt.join(large, ["label", "t", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    split = split.withColumn("own", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    split = split.select("label", "t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "w", "v", "code", "factor")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int | None, int]] = []
        for g in grouped(batches, ["label", "t", "key", "lo", "hi"]):
            if g.num_rows < 2:
                continue
            col = lambda c: g.column(c).to_numpy()  # noqa: B023, E731
            counts, links = link_bucket(col("rep"), col("w").astype(np.float64), col("side"), matrix(g.column("v"), dim), np.frombuffer(b"".join(g.column("code").to_pylist()), np.uint8).reshape(g.num_rows, -1), col("factor"), int(col("t")[0]), bits, tables, bool(col("lo")[0] == col("hi")[0]))
            out += [(a, None, n) for a, n in counts.items()] + [(a, b, 0) for a, b in links]
            if len(out) > 1 << 16:
                yield _result(out)
                out = []
        if out:
            yield _result(out)

    found = split.repartition("label", "t", "key", "lo", "hi").sortWithinPartitions("label", "t", "key", "lo", "hi").mapInArrow(compare, "a long, b long, n long")
    found = materialize(found, "vec-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    linked = components(classes.select(F.col("rep").alias("node")).distinct(), found.where("b is not null").select("a", "b"))
    per_class = classes.join(linked, classes.rep == linked.node).join(counts, F.col("rep") == F.col("a"), "left")
    per_class = per_class.select(F.col("label").alias("l"), F.col("v").alias("u"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component")
    out = every.join(per_class, (every.label == F.col("l")) & (every.v == F.col("u")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _result(rows: list) -> pa.RecordBatch:
    a, b, n = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])
