"""Exact dedup by Patricia tries whose terminal nodes hold the owner of a text.

Two levels of tries.  Each task first inserts its rows' full byte strings into
a compressed radix trie; a terminal node keeps the owner's id and how many rows
ended there, so copies within a task leave it as one row.  What is left is
dealt out by length and content hash and sorted by them; each partition inserts
the byte strings into a second trie.  Equality is always decided by the bytes
on the trie's edges, never by the hash.

Memory: a first-level trie that grows beyond ``LIMIT`` bytes spills its
largest subtree, that is, sends it on as rows; the second level meets whatever
was sent twice.  In the second level rows arrive by (length, hash), so once the
key moves on, all earlier subtrees are complete and leave the trie when it
holds ``LIMIT`` bytes.  A group of copies therefore costs the shuffle one row
a task and spill, however many rows it has, and a task one byte string.

Owners meet the rows again by length and SHA-256 (one owner row per text with
copies).  A text held by at least one in ``HOT_SHARE`` of all rows is joined by
broadcast, at most ``HOT_SHARE`` of them can exist; the rest by shuffle.

Nulls and odd rows: a null text counts as empty, and all empty texts are
equal; a null id is below every id (a group of null ids only has a null owner,
and all its rows stay); rows that repeat an id and a text are counted as rows
and stay or go together; any length is taken whole; an empty table gives an
empty result; only the two named columns are read, others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import materialize, small

#: Bytes of byte strings that a trie holds before it spills.
LIMIT = 64 << 20
#: Texts held by more than one in so many rows are joined by broadcast.
HOT_SHARE = 1000
#: Rows and bytes of an output batch.
OUT_ROWS, OUT_BYTES = 1024, 8 << 20


def common_prefix(label: bytes, data: bytes, at: int) -> int:
    """Length of the longest prefix of ``label`` that ``data`` has at ``at``."""
    lo, hi = 0, min(len(label), len(data) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if data.startswith(label[:mid], at):
            lo = mid
        else:
            hi = mid - 1
    return lo


class Node:
    __slots__ = ("edges", "owner", "rows")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.owner = None
        self.rows = 0


class Trie:
    """Compressed radix trie; ``rows`` of a node is 0 unless a string ends there."""

    def __init__(self, largest: bool = False):
        self.better = max if largest else min
        self.clear()

    def clear(self) -> None:
        self.root = Node()
        self.bytes = 0
        #: Bytes held below the root, by first byte.
        self.below: dict[int, int] = {}

    def insert(self, data: bytes, owner: int | None, rows: int = 1) -> None:
        node, at, n = self.root, 0, len(data)
        while at < n:
            edge = node.edges.get(data[at])
            if edge is None:
                child = Node()
                label = data[at:]
                node.edges[data[at]] = (label, child)
                self.bytes += len(label)
                self.below[data[0]] = self.below.get(data[0], 0) + len(label)
                node, at = child, n
                break
            label, child = edge
            if not data.startswith(label, at):  # the edge parts here
                k = common_prefix(label, data, at)
                middle = Node()
                middle.edges[label[k]] = (label[k:], child)
                node.edges[data[at]] = (label[:k], middle)
                node, at = middle, at + k
            else:
                node, at = child, at + len(label)
        node.rows += rows
        if owner is not None:
            node.owner = owner if node.owner is None else self.better(node.owner, owner)

    def terminals(self, first: int | None = None) -> Iterator[tuple[bytes, int | None, int]]:
        """(byte string, owner, rows) below one first byte, or all of them."""
        if first is None:
            todo = [(b"", self.root)]
        else:
            todo = [self.root.edges[first]]
        while todo:
            data, node = todo.pop()
            if node.rows:
                yield data, node.owner, node.rows
            todo += [(data + label, child) for label, child in node.edges.values()]

    def spill(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Take the largest subtree below the root out of the trie."""
        first = max(self.below, key=self.below.get)
        yield from self.terminals(first)
        del self.root.edges[first]
        self.bytes -= self.below.pop(first)


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded rows and bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += weight(r)
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def owners(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """(n, sha, owner, rows) of each text that more than one row holds: its
    length in bytes, SHA-256, smallest (``largest``: largest) id, row count."""
    limit = LIMIT

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(largest)

        def out():
            for b in small(batches):
                for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist()):
                    trie.insert(t, i)
                    while trie.bytes > limit:
                        yield from trie.spill()
            yield from trie.terminals()

        schema = pa.schema([("t", pa.binary()), ("owner", pa.int64()), ("rows", pa.int64())])
        yield from _batches(out(), schema, lambda r: len(r[0]))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(largest)

        def done():
            for t, owner, rows in trie.terminals():
                if rows > 1:
                    yield len(t), hashlib.sha256(t).digest(), owner, rows

        def out():
            last = None
            for b in small(batches):
                for n, h, t, owner, rows in zip(*(b.column(c).to_pylist() for c in ("n", "h", "t", "owner", "rows"))):
                    if (n, h) != last and trie.bytes > limit:
                        yield from done()
                        trie.clear()
                    last = (n, h)
                    trie.insert(t, owner, rows)
            yield from done()

        schema = pa.schema([("n", pa.int32()), ("sha", pa.binary()), ("owner", pa.int64()), ("rows", pa.int64())])
        yield from _batches(out(), schema, lambda r: 64)

    rows = docs.select(F.col(key).cast("long").alias("i"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
    sent = rows.mapInArrow(combine, "t binary, owner long, rows long")
    dealt = sent.select(F.octet_length("t").alias("n"), F.xxhash64("t").alias("h"), "t", "owner", "rows").repartition("n", "h").sortWithinPartitions("n", "h")
    return dealt.mapInArrow(own, "n int, sha binary, owner long, rows long")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """(key, n_bytes, sha, keep_id, group_size) of every row: the id of the
    row that stays of its group of equal texts, and the group's rows."""
    found = materialize(owners(docs, key, text, largest), "owners")
    total = docs.count()
    hot = found.where(F.col("rows") * F.lit(HOT_SHARE) >= F.lit(total)).select(F.col("n").alias("hot_n"), F.col("sha").alias("hot_sha"), F.col("owner").alias("hot_owner"), F.col("rows").alias("hot_rows"))
    cool = found.where(F.col("rows") * F.lit(HOT_SHARE) < F.lit(total))
    t = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).cast("long").alias("i"), F.octet_length(t).alias("n_bytes"), F.unhex(F.sha2(t, 256)).alias("digest"))
    rows = rows.join(F.broadcast(hot), (F.col("n_bytes") == F.col("hot_n")) & (F.col("digest") == F.col("hot_sha")), "left")
    # Rows already met go through the second join under a key of their own.
    meet = F.when(F.col("hot_rows").isNull(), F.col("digest")).otherwise(F.encode(F.col("i").cast("string"), "utf-8"))
    rows = rows.withColumn("meet", F.coalesce(meet, F.lit(b"")))
    rows = rows.join(cool, (F.col("meet") == F.col("sha")) & (F.col("n_bytes") == F.col("n")), "left")
    size = F.coalesce("hot_rows", "rows", F.lit(1))
    owner = F.when(F.col("hot_rows").isNotNull(), F.col("hot_owner")).when(F.col("rows").isNotNull(), F.col("owner")).otherwise(F.col("i"))
    return rows.select(F.col("i").alias(key), "n_bytes", F.col("digest").alias("sha"), owner.alias("keep_id"), size.cast("long").alias("group_size"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """``exact_groups`` as a report: kept rows are those whose id owns the text."""
    return exact_groups(docs, key, text, largest).select(key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
