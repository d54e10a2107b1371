"""Ranked lexical search over bit-sliced Bloom signatures.

Index (``build_index``): documents of like size form blocks of at most
``BLOCK`` rows.  A document's signature is a Bloom filter over the pairs (term,
level), one for each of ``LEVELS`` that the term's occurrences reach; a block
stores its signatures bit by bit, so that each slice is a bitmap of its
documents.  The block also holds ids, term numbers and texts.  The same pass
counts, task by task, how many documents hold each term.

Search (``search``): the AND of a term's slices at a level is a bitmap that
contains every document in which the term reaches the level (and maybe more).
From the highest level set for a term follows the most it can add to the
score; weighted sums over an item's terms are upper bounds.  A document is left
out only if its bound is below a score that fifty known documents reach, or
equal to it with a larger id than all of these; every other one is rescored
from its text, in the same task.  Scores that are known before: a share of the
blocks (one in ``PILOT``, by a hash) is searched first, and its fiftieth score
is where the others start, so the rows a task returns do not grow in number
with the tasks.  Bounds and scores are whole numbers below 2**53 in doubles.

Items are a stated query set, taken in blocks of at most ``ITEMS`` items and
about ``TERMS`` terms; what is broadcast is such a block with its terms'
weights.  Each block is searched in one scan of the index.

Nulls and odd rows: a null text or one without a term is no document; a null
item text has no terms and no rows; rows that share an item's id are one item
with the terms of all of them; documents that share an id are ranked each, those
without an id after others of the same score; texts of any length are indexed
whole (beyond ``MOST_SLICES`` a signature only gets denser); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orchard.llm.common import mix64, small, worker_cache
from orchard.session import fresh_path

#: Occurrences at which a term enters the signature once more.
LEVELS = [1, 2, 3, *(x << k for k in range(30) for x in (4, 6))]
HASHES = 3
BITS_PER_ENTRY = 10
BLOCK = 256
#: Bounds of a block: bytes of slices, bytes of texts; slices of a signature.
SLICE_BYTES, TEXT_BYTES, MOST_SLICES = 2 << 20, 2 << 20, 1 << 24
PILOT = 32
ITEMS, TERMS = 1024, 16_384
#: Terms whose document counts a task holds, and whose hashes a worker keeps.
FLUSH, HASHES_KEPT = 100_000, 200_000
#: Blocks that Spark hands a Python worker at a time.
BLOCKS_AT_ONCE = 8
ROW_GROUP = 16 << 20

#: Separators become spaces, A-Z lower case, other bytes stay.
_FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

INDEX = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("slices", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()), T.StructField("texts", T.ArrayType(T.BinaryType())),
    T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType()), T.StructField("part", T.StringType()),
])
_ARROW = pa.schema([("block", pa.int64()), ("slices", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()),
                    ("texts", pa.list_(pa.binary())), ("term", pa.binary()), ("n", pa.int64()), ("total", pa.int64()), ("part", pa.string())])


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def level_keys(hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """One key for each level that each term reaches."""
    out = []
    for i, level in enumerate(LEVELS):
        if i:
            reach = tf >= level
            if not reach.any():
                break
            hashes, tf = hashes[reach], tf[reach]
        out.append(hashes + np.uint64((i * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    return np.concatenate(out)


def positions(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slices of each key, one column per hash."""
    return np.stack([mix64(keys ^ np.uint64(0xD6E8FEB86659FD93 * (j + 1) & (2**64 - 1))) % np.uint64(slices) for j in range(HASHES)], -1).astype(np.int64)


class Open:
    """A block that still takes documents."""

    def __init__(self, slices: int):
        self.slices = slices
        self.most = max(8, min(BLOCK, SLICE_BYTES * 8 // slices // 8 * 8))
        self.ids, self.sizes, self.texts, self.at, self.bytes = [], [], [], [], 0

    def add(self, key, size: int, text: bytes, keys: np.ndarray) -> bool:
        """Take a document; true if the block is full then."""
        self.ids.append(key), self.sizes.append(size), self.texts.append(text)
        self.at.append(np.unique(positions(keys, self.slices)))
        self.bytes += len(text) + self.at[-1].nbytes
        return len(self.ids) >= self.most or self.bytes >= TEXT_BYTES

    def row(self, block: int) -> tuple:
        packed = np.zeros((self.slices, -(-len(self.ids) // 8)), np.uint8)
        for i, at in enumerate(self.at):
            packed[at, i >> 3] |= np.uint8(128 >> (i & 7))
        pilot = int(mix64(np.array([block], np.uint64))[0]) % PILOT == 0
        return block, self.slices, self.ids, self.sizes, packed.tobytes(), self.texts, None, None, None, "pilot" if pilot else "rest"


def _hashes(words: list[bytes], known: dict) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    if len(known) > HASHES_KEPT:
        known.clear()
    get = known.get
    out = [h if (h := get(w)) is not None else known.setdefault(w, xxh3_64_intdigest(w)) for w in words]
    return np.array(out, np.uint64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> str:
    """Write the index of ``docs`` and return its path.  Parts: ``pilot`` and
    ``rest`` (blocks), ``terms`` (documents per term, summed per task),
    ``stats`` (documents and terms per task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = worker_cache("search-hashes"), TaskContext.get().partitionId() << 32
        opened: dict[int, Open] = {}
        held: Counter = Counter()
        docs_seen = terms_seen = 0

        def counted() -> pa.RecordBatch:
            n = len(held)
            none = [None] * n
            rows = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([none, none, none, none, none, none, list(held.keys()), list(held.values()), none, ["terms"] * n], _ARROW)], schema=_ARROW)
            held.clear()
            return rows

        for b in small(batches):
            for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist()):
                if t is None or not (words := terms_of(t)):
                    continue
                tf = Counter(words)
                docs_seen += 1
                terms_seen += len(words)
                held.update(tf.keys())
                keys = level_keys(_hashes(list(tf.keys()), known), np.fromiter(tf.values(), np.int64, len(tf)))
                slices = min(MOST_SLICES, BITS_PER_ENTRY << max(4, (keys.size - 1).bit_length()))
                block = opened.setdefault(slices, Open(slices))
                if block.add(i, len(words), t, keys):
                    yield _rows([block.row(number)])
                    number += 1
                    del opened[slices]
                if len(held) > FLUSH:
                    yield counted()
        for block in opened.values():
            yield _rows([block.row(number)])
            number += 1
        if held:
            yield counted()
        if docs_seen:
            yield _rows([(None, None, None, None, None, None, None, docs_seen, terms_seen, "stats")])

    rows = docs.select(F.col(key).cast("long").alias("i"), F.col(text).cast("binary").alias("t"))
    path = fresh_path(docs.sparkSession, "search-index")
    rows.mapInArrow(run, INDEX).write.option("parquet.block.size", ROW_GROUP).partitionBy("part").parquet(path)
    return path


class Query:
    """A block of items with the weights of their terms."""

    def __init__(self, items: list[tuple], weights: dict[bytes, int], n: int, total: int):
        self.n, self.total = n, total
        self.terms = sorted(t for t, w in weights.items() if w > 0)
        self.index = {t: i for i, t in enumerate(self.terms)}
        self.weight = [weights[t] for t in self.terms]
        self.items = [(k, at, np.array([self.weight[i] for i in at], np.float64)) for k, words in items if (at := [self.index[w] for w in words if w in self.index])]

    def lengths(self, sizes: list[int]) -> list[int]:
        """The m of each document, from its number of terms."""
        return [50 + 50 * s * self.n // self.total for s in sizes]


def add(tf: int, m: int) -> int:
    """What ``tf`` occurrences add per unit of weight in a document of length m."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Searcher:
    """Runs through blocks and keeps each item's best documents so far."""

    def __init__(self, query: Query, top: int, floor: list[int]):
        from xxhash import xxh3_64_intdigest

        self.q, self.top, self.floor = query, top, floor
        self.hashes = np.array([xxh3_64_intdigest(t) for t in query.terms], np.uint64)
        self.best: list[list[tuple]] = [[] for _ in query.items]  # (-score, id is null, id)
        self.where: dict[int, list[np.ndarray]] = {}

    def slices_of(self, slices: int, level: int) -> np.ndarray:
        """Slices of every query term at a level."""
        got = self.where.setdefault(slices, [])
        while len(got) <= level:
            key = self.hashes + np.uint64((len(got) * 0x9E3779B97F4A7C15) & (2**64 - 1))
            got.append(positions(key, slices))
        return got[level]

    def bounds(self, slices: int, bits: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The most each query term can add in each document: (terms, docs)."""
        most = np.zeros((len(self.q.terms), m.size))
        alive, before, last = np.arange(len(self.q.terms)), None, np.zeros(m.size)
        for i in range(len(LEVELS)):
            at = self.slices_of(slices, i)[alive]
            rows = bits[at[:, 0]]
            for j in range(1, HASHES):
                rows = rows & bits[at[:, j]]
            if before is not None:
                rows &= before
            some = rows.any(1)
            alive, before = alive[some], rows[some]
            if not alive.size:
                break
            reach = LEVELS[i + 1] - 1 if i + 1 < len(LEVELS) else 1 << 33
            now = (1_000_000_000 * reach // (1000 * reach + 20 * m)).astype(np.float64)
            most[alive] += np.unpackbits(before, axis=1, count=m.size) * (now - last)
            last = now
        return most

    def block(self, slices: int, ids: list, sizes: list[int], bits: bytes, texts) -> None:
        m = self.q.lengths(sizes)
        most = self.bounds(slices, np.frombuffer(bits, np.uint8).reshape(slices, -1), np.array(m, np.int64))
        opened: dict[int, dict[int, int]] = {}
        for k, (_, at, weights) in enumerate(self.q.items):
            bound = weights @ most[at]
            best = self.best[k]
            least = max(1, self.floor[k], -best[-1][0] if len(best) == self.top else 0)
            likely = np.flatnonzero(bound >= least)
            if not likely.size:
                continue
            for d in likely[np.argsort(-bound[likely], kind="stable")].tolist():
                id_ = ids[d]
                rank = (-int(bound[d]), id_ is None, id_ or 0)
                if len(best) == self.top and rank > best[-1]:
                    continue  # excluded by bound, or by the id at equal score
                if d not in opened:
                    words, index = Counter(terms_of(texts[d].as_py())), self.q.index
                    opened[d] = {index[w]: add(n, m[d]) for w, n in words.items() if w in index}
                adds = opened[d]
                score = sum(self.q.weight[i] * c for i in at if (c := adds.get(i)))
                if score >= max(1, self.floor[k]):
                    best.append((-score, id_ is None, id_ or 0))
                    best.sort()
                    del best[self.top :]

    def rows(self) -> list[tuple]:
        return [(k, None if null else i, -s) for k, best in enumerate(self.best) for s, null, i in best]


def _scan(blocks: DataFrame, query, top: int, floor) -> DataFrame:
    """(item number, doc_id, score): each task's best documents per item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Searcher(query.value, top, floor)
        for b in batches:
            cols = {c: b.column(c) for c in ("slices", "ids", "sizes", "bits", "texts")}
            for i in range(b.num_rows):
                found.block(cols["slices"][i].as_py(), cols["ids"][i].as_py(), cols["sizes"][i].as_py(), cols["bits"][i].as_buffer(), cols["texts"][i].values)
            del b, cols
            pa.default_memory_pool().release_unused()
        rows = found.rows()
        for lo in range(0, len(rows), 10_000):
            k, i, s = zip(*rows[lo : lo + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int64()), pa.array(s, pa.int64())], names=["item", "doc_id", "score"])

    return blocks.select("slices", "ids", "sizes", "bits", "texts").mapInArrow(run, "item int, doc_id long, score long")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """(id, distinct terms) of the query set, in blocks of bounded size."""
    one = items.where(F.col(text).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.collect_set(F.col(text).cast("binary")).alias("t"))
    held, size = [], 0
    for r in one.toLocalIterator():
        words = sorted({w for t in r["t"] for w in terms_of(bytes(t))})
        if held and (len(held) >= ITEMS or size + len(words) > TERMS):
            yield held
            held, size = [], 0
        held.append((r["k"], words))
        size += len(words)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = 50) -> DataFrame:
    """(item id, rank, doc id, score): each item's ``top`` documents."""
    spark = docs.sparkSession
    path = build_index(docs, key, text)
    # A session of its own for the scans: rows are whole blocks there, so few of
    # them make a batch.
    scans = spark.newSession()
    scans.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCKS_AT_ONCE))
    scans.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))

    def part(*names: str) -> DataFrame:
        return scans.read.schema(INDEX).parquet(path).where(F.col("part").isin(*names))

    kind = items.schema[item].dataType
    n, total = part("stats").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    out = None
    for block in item_blocks(items, item, item_text) if n else ():
        asked = sorted({w for _, words in block for w in words})
        if not asked:
            continue
        wanted = scans.createDataFrame([(bytearray(w),) for w in asked], "term binary")
        df = part("terms").join(F.broadcast(wanted), "term").groupBy("term").agg(F.sum("n").alias("df")).collect()
        weights = {bytes(r["term"]): math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in df}
        made = Query(block, weights, n, total)
        query = spark.sparkContext.broadcast(made)
        floor = [0] * len(made.items)
        for r in _ranked(_scan(part("pilot"), query, top, floor), top).where(F.col("rank") == top).collect():
            floor[r["item"]] = r["score"]
        ranked = _ranked(_scan(part("pilot", "rest"), query, top, floor), top)
        found = fresh_path(spark, "found")
        ranked.write.parquet(found)
        found = spark.read.schema(ranked.schema).parquet(found)
        names = spark.createDataFrame([(i, k) for i, (k, _, _) in enumerate(made.items)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", kind)]))
        rows = found.join(F.broadcast(names), "item").select(F.col("name").alias(item), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(key), "score")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(item, kind), T.StructField("rank", T.IntegerType()), T.StructField(key, T.LongType()), T.StructField("score", T.LongType())]))
    return out
