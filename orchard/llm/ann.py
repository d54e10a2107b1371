"""Approximate nearest neighbours by adaptive dimension scan.

An inverted-list index: centroids from k-means over a sample of at most
``SAMPLE`` vectors and ``SAMPLE_BYTES``; every vector goes to its nearest
centroid's list.  A query probes the lists with the largest inner products; how
many, is calibrated on the sample so that ``TARGET`` of the sample's true
neighbours lie in them.  Inside a list, rotated vectors are scanned in blocks of
columns: from the squared distance over the first d of D dimensions a
hypothesis test (error factor ``1 + EPSILON / sqrt(d)``) drops candidates that
cannot be as near as a score that ``k`` vectors are known to reach.  That score
to beat is the query's k-th best among at most ``PILOTS`` vectors (and
``PILOT_BYTES``), which are broadcast for this and nothing else: what is
returned was found in a probed list.  The nearest ``FIRST`` lists are scanned
against it, then ``GROWTH`` times as many in all and so on; the k-th best found
so far is the score to beat in the next ones, so that a query's hits grow with
the number of turns, not with the number of rows.  Scores of survivors come from
the original vectors in double precision.

Lists are cut into chunks of about ``CHUNK`` rows, so one vector that holds a
third of all rows is spread; queries stream past a chunk.

Nulls and odd rows: vectors that are null, empty, zero, hold null or
non-finite components or differ in length from most take no part; a null id
takes no part; ids that repeat are separate candidates, except for a query's
own id; equal scores go by the smaller id; an empty table gives an empty
result; only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import materialize
from orchard.llm.vectors import dimension, matrix, rotation, row_dots, usable

NEIGHBOURS = 20
SAMPLE, SAMPLE_BYTES = 32_768, 64 << 20
PILOTS, PILOT_BYTES = 2048, 16 << 20
LIST_ROWS = 512
MAX_LISTS = 4096
TARGET = 0.97
CHUNK = 4096
FIRST, GROWTH = 1, 4
COLUMNS = 16
EPSILON = 2.1
QUERIES_AT_ONCE = 256


def kmeans(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; empty clusters keep theirs."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([(x[lo : lo + 4096] @ c.T - half).argmax(1) for lo in range(0, len(x), 4096)] or [np.empty(0, int)])


def fit(sample: np.ndarray, rows: int) -> dict:
    """Centroids and the number of lists to probe."""
    lists = int(max(1, min(MAX_LISTS, rows // LIST_ROWS, len(sample) // 8)))
    c = kmeans(sample, lists)
    own = nearest(sample, c)
    tests = sample[:: max(1, len(sample) // 256)]
    score = tests @ sample.T
    # The neighbours a query has among all rows lie as far out as about this
    # many of the sample; rank 0 is the query itself.
    k = max(2, round(NEIGHBOURS * len(sample) / max(rows, 1)) + 1)
    best = np.argsort(-score, axis=1, kind="stable")[:, 1 : max(k, 11)]
    order = np.argsort(-(tests @ c.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(lists)[None, :].repeat(len(tests), 0), 1)
    need = np.take_along_axis(rank, own[best], 1).ravel()
    probes = int(np.quantile(need, TARGET, method="higher")) + 1 if need.size else lists
    return {"centroids": c, "probes": min(lists, probes)}


def search(rows: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found per query."""
    spark = rows.sparkSession
    v = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), is_query.alias("q"))
    v = v.where(usable(F.col("v")) & F.col("id").isNotNull())
    dim = dimension(v, "v")
    v = materialize(v.where(F.size("v") == dim), "ann-vectors")
    n = v.count()
    share = min(1.0, SAMPLE / max(n, 1), SAMPLE_BYTES / max(8 * dim * n, 1))
    picked = v.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "v").toArrow() if n else None
    ids, sample = (picked.column("id").to_numpy(), matrix(picked.column("v"), dim)) if n else (np.empty(0, np.int64), np.empty((0, 1)))
    order = np.argsort(ids, kind="stable")
    ids, sample = ids[order], sample[order]
    model = fit(sample, n) if len(sample) else {"centroids": np.zeros((1, dim)), "probes": 1}
    few = slice(0, None, max(1, -(-len(ids) // max(1, min(PILOTS, PILOT_BYTES // max(8 * dim, 1))))))
    shared = spark.sparkContext.broadcast(model | {"pilot_ids": ids[few], "pilots": sample[few]})

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value["centroids"]
        for b in batches:
            x = matrix(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(nearest(x, c), pa.int32())], names=["id", "v", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists to probe and the score to beat."""
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, QUERIES_AT_ONCE):
                part = b.slice(lo, QUERIES_AT_ONCE)
                q, own = matrix(part.column("v"), dim), part.column("id").to_numpy()
                lists = np.argsort(-(q @ m["centroids"].T), axis=1, kind="stable")[:, : m["probes"]]
                score = q @ m["pilots"].T
                score[own[:, None] == m["pilot_ids"][None, :]] = -np.inf
                beat = np.full(len(q), -np.inf)
                # A matrix product may differ from the pair's own sum by a rounding.
                slack = 1e-9 * np.sqrt((q * q).sum(1) * (m["pilots"] ** 2).sum(1).max())
                if score.shape[1] >= k:
                    best = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
                    beat = best - 1e-9 * np.abs(best) - slack
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(beat), pa.array(slack), pa.array(lists.astype(np.int32).tolist(), pa.list_(pa.int32()))], names=["id", "v", "beat", "slack", "lists"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, 1)
        key, parts, block = None, [], None
        for b in batches:
            lists, chunks, kinds = (b.column(c).to_numpy() for c in ("list", "chunk", "kind"))
            change = np.flatnonzero((lists[1:] != lists[:-1]) | (chunks[1:] != chunks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            cuts = [0, *change.tolist(), b.num_rows] if b.num_rows else []
            for lo, hi in zip(cuts, cuts[1:]):
                if (lists[lo], chunks[lo]) != key:
                    key, parts, block = (lists[lo], chunks[lo]), [], None
                part = b.slice(lo, hi - lo)
                ids, x = part.column("id").to_numpy(), matrix(part.column("v"), dim)
                if kinds[lo] == 0:
                    parts.append((ids, x))
                    continue
                if not parts:
                    continue
                if block is None:
                    every, raw = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    block = every, raw, raw @ turn, (raw * raw).sum(1)
                beat = part.column("beat").to_numpy()
                for at in range(0, len(ids), QUERIES_AT_ONCE):
                    s = slice(at, at + QUERIES_AT_ONCE)
                    yield adaptive_scan(ids[s], x[s], x[s] @ turn, beat[s], *block, k=k)

    based = materialize(v.mapInArrow(base, v.select("id", "v", F.lit(0).alias("list")).schema), "ann-lists")
    sizes = based.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    asked = v.where("q").mapInArrow(probe, v.select("id", "v", F.lit(0.0).alias("beat"), F.lit(0.0).alias("slack"), F.array(F.lit(0)).alias("lists")).schema)
    asked = materialize(asked, "ann-queries")
    held = based.join(sizes, "list").select("list", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("kind"), "id", "v", F.lit(0.0).alias("beat"))

    def scanned(asked: DataFrame) -> DataFrame:
        """Hits of queries (id, v, beat, lists) in their lists."""
        sent = asked.select("id", "v", "beat", F.explode("lists").alias("list")).join(sizes, "list")
        sent = sent.select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("kind"), "id", "v", "beat")
        return held.unionByName(sent).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "kind").mapInArrow(scan, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    # Nearest lists first, then ever more: the k-th best of a query found so far
    # is the score to beat in the next ones.  A query's id may repeat.
    best, done = None, 0
    while done < model["probes"]:
        upto = min(model["probes"], FIRST if not done else done * GROWTH)
        turn = asked.withColumn("lists", F.slice("lists", done + 1, upto - done))
        if best is not None:
            reached = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score") - F.lit(1e-9) * F.abs("score")).alias("found"))
            turn = turn.join(reached, "id", "left").withColumn("beat", F.coalesce(F.greatest("beat", F.col("found") - F.col("slack")), "beat"))
        hits = scanned(turn.select("id", "v", "beat", "lists"))
        best, done = ranked(hits if best is None else best.drop("rank").unionByName(hits)), upto
        if done < model["probes"]:
            best = materialize(best, "ann-best")
    return best


def adaptive_scan(q_ids, q_raw, q_rot, beat, ids, raw, rot, norms, k: int) -> pa.RecordBatch:
    """Hits (query_id, vec_id, score) of some queries in one chunk."""
    dim = raw.shape[1]
    q_norms = (q_raw * q_raw).sum(1)
    # Squared distance at which the inner product equals the score to beat.
    reach = np.maximum(q_norms[:, None] + norms[None, :] - 2 * beat[:, None], 0.0)
    d = min(COLUMNS, dim)
    part = (q_rot[:, :d] ** 2).sum(1)[:, None] + (rot[:, :d] ** 2).sum(1)[None, :] - 2 * q_rot[:, :d] @ rot[:, :d].T
    open_ = part * (dim / d) <= reach * (1 + EPSILON / np.sqrt(d)) ** 2 + 1e-9
    i, j = np.nonzero(open_ & (q_ids[:, None] != ids[None, :]))
    part = part[i, j]
    while d < dim and i.size:
        e = min(d + COLUMNS, dim)
        diff = q_rot[i, d:e] - rot[j, d:e]
        part, d = part + (diff * diff).sum(1), e
        slack = (1 + EPSILON / np.sqrt(d)) ** 2 if d < dim else 1 + 1e-9
        keep = part * (dim / d) <= reach[i, j] * slack + 1e-9
        i, j, part = i[keep], j[keep], part[keep]
    score = row_dots(q_raw, i, raw, j)
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i, "left")
    top = np.arange(i.size) - first < k
    return pa.RecordBatch.from_arrays([pa.array(q_ids[i[top]], pa.int64()), pa.array(ids[j[top]], pa.int64()), pa.array(score[top], pa.float64())], names=["query_id", "vec_id", "score"])
