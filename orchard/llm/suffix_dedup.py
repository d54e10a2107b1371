"""Removal of repeated passages with distributed, prefix-aware suffix merging.

A byte goes when a ``WINDOW``-byte string that covers it also starts in a
document with a smaller id.  Strings are judged on the input.

1. Sampling.  Every window has a minimizer, its ``KMER`` with the smallest
   hash.  Equal windows have equal minimizers at equal places, so two documents
   can share a window only where they share a minimizer's k-mer.  One row per
   (k-mer hash, document) is exchanged; k-mers of a single document drop out.
   This is lossless.  A text that a document with a smaller id repeats as a
   whole (by digest) goes as one span, and only the first of them is compared.
2. Runs.  For each remaining anchor the task takes the suffix that holds all
   windows of that minimizer (a superwindow), sorts its suffixes, front-codes
   them (length of the prefix shared with the one before, and the rest) and
   deals them to buckets by k-mer.  k-mers in more than ``HOT`` documents are
   dealt window by window instead, and a window's documents by a salt, so that
   about ``HOT`` of them meet in a bucket.
3. Merge.  A bucket's runs go through a loser tree that carries the known
   common prefix with the last output and compares bytes only beyond it.  Equal
   suffixes come out together: all but those of the smallest document go.
   Superwindows of one k-mer that differ are then compared window by window.
   A salted window's smallest document of each bucket goes on, and all but the
   smallest of those go as well.
4. The spans are joined to their documents and cut out.

Nulls and odd rows: a null text is empty; rows without a ``doc_id`` are kept
whole; rows that share a ``doc_id`` count as one document and are each cut by the
union of their spans (clipped to the text), so exact repeats agree;
an empty table gives an empty result; only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import _powers, grouped, materialize, mix64, small

WINDOW = 50
KMER = 24
HOT = 20_000
#: Bits of a place inside a stretch whose minimizers are taken together; the
#: hash is compared without as many of its lower bits, at every text length.
PLACE_BITS = 20
#: Longest suffix: all windows of one minimizer.
WIDTH = 2 * WINDOW - KMER
#: Suffixes a bucket holds on average, and suffixes in a run.
BUCKET_ROWS = 16_384
RUN_ROWS = 200_000
#: Spans that leave a merge at a time.
SPAN_ROWS = 65_536


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer hash, first window, last window) per minimizer of a text."""
    windows, w = raw.size - WINDOW + 1, WINDOW - KMER + 1
    if windows < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    powers, inverse = _powers(raw.size + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[: raw.size], dtype=np.uint64)))
    m = raw.size - KMER + 1
    h = mix64((total[KMER:] - total[:m]) * inverse[:m])
    least = np.empty(windows, np.int64)
    step = 1 << PLACE_BITS
    for lo in range(0, windows, step - w):
        part = h[lo : lo + step]
        # The hash's upper bits, then the place: of equal hashes the leftmost.
        x = (part >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(part.size, dtype=np.uint64)
        # Minima over 2, 4, 8 ... places, then over w by two that overlap.
        width = 1
        while 2 * width <= w:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        if width < w:
            x = np.minimum(x[: width - w], x[w - width :])
        n = min(step - w, windows - lo)
        least[lo : lo + n] = (x[:n] & np.uint64(step - 1)).astype(np.int64) + lo
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return h[least[first]].view(np.int64), first, np.concatenate((first[1:], [windows])) - 1


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def shared_kmers(docs: DataFrame) -> DataFrame:
    """(doc, kmer, salts): each document's minimizer k-mers that other documents
    hold too; salts is the number of parts that the documents of a hot one are
    dealt over, and 0 for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids, keys = [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                k = np.unique(anchors(_raw(text))[0])
                keys.append(k), ids.append(np.full(k.size, doc, np.int64))
                if sum(map(len, keys)) > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["kmer", "doc"])
                    ids, keys = [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["kmer", "doc"])

    rows = docs.mapInArrow(run, "kmer long, doc long")
    held = Window.partitionBy("kmer")
    rows = rows.withColumn("lo", F.min("doc").over(held)).withColumn("hi", F.max("doc").over(held)).withColumn("n", F.count(F.lit(1)).over(held)).where("lo <> hi")
    return materialize(rows.select("doc", "kmer", F.when(F.col("n") > HOT, F.ceil(F.col("n") / HOT)).otherwise(0).cast("int").alias("salts")), "suffix-kmers")


def front_code(bucket: np.ndarray, text: np.ndarray, size: np.ndarray, kmer: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Buckets and their front-coded runs.  ``text`` holds the suffixes as rows
    of bytes, zero beyond their ``size``."""
    whole = np.ascontiguousarray(text).view(f"S{text.shape[1]}").ravel()
    # By bucket, bytes, size: a zero byte sorts like the end, the size decides.
    order = np.argsort(size, kind="stable")
    order = order[np.argsort(whole[order], kind="stable")]
    order = order[np.argsort(bucket[order], kind="stable")]
    bucket, text, size = bucket[order], text[order], size[order]
    same = text[1:] == text[:-1]
    lcp = np.where(same.all(1), text.shape[1], same.argmin(1))
    lcp = np.minimum(lcp, np.minimum(size[1:], size[:-1]))
    lcp[bucket[1:] != bucket[:-1]] = 0
    lcp = np.concatenate((np.zeros(1, np.int64), lcp))
    column = np.arange(text.shape[1])
    rest = text[(column >= lcp[:, None]) & (column < size[:, None])].tobytes()
    at = np.concatenate(([0], np.cumsum(size - lcp)))
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [bucket.size]))
    kmer, doc, place = kmer[order], doc[order], place[order].astype(np.int32)
    lcp, size = lcp.astype(np.uint8), size.astype(np.uint8)
    blobs = []
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        parts = [np.array([hi - lo], np.int64), lcp[lo:hi], size[lo:hi], kmer[lo:hi], doc[lo:hi], place[lo:hi]]
        blobs.append(zlib.compress(b"".join([x.tobytes() for x in parts]) + rest[at[lo] : at[hi]], 1))
    return bucket[cuts[:-1]].tolist(), blobs


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are given."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while known + 8 <= n and a[known : known + 8] == b[known : known + 8]:
        known += 8
    while known < n and a[known] == b[known]:
        known += 1
    return known


def decode_run(blob: bytes) -> Iterator[tuple[int, bytes, list[tuple[int, int, int]]]]:
    """(prefix shared with the suffix before, suffix, [(k-mer, doc, place)])
    for each distinct suffix of a run."""
    raw = zlib.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    lcps, sizes, base = raw[8 : 8 + n], raw[8 + n : 8 + 2 * n], 8 + 2 * n
    kmers, docs = (np.frombuffer(raw, np.int64, n, base + 8 * n * i).tolist() for i in (0, 1))
    table = list(zip(kmers, docs, np.frombuffer(raw, np.int32, n, base + 16 * n).tolist()))
    at, i, last = base + 20 * n, 0, b""
    while i < n:
        lcp, size = lcps[i], sizes[i]
        s = last[:lcp] + raw[at : at + size - lcp]
        at += size - lcp
        held = [table[i]]
        i += 1
        while i < n and lcps[i] == size and sizes[i] == size:
            held.append(table[i])
            i += 1
        yield lcp, s, held
        last = s


def merge_runs(runs: list[Iterator]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Distinct suffixes in order with all their holders.

    A loser tree: each contender carries the length of the prefix it shares
    with the suffix last put out.  The longer one wins unseen; at equal lengths
    bytes are compared from there on, and the loser keeps the length found.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list = [None] * k
    lcp = [0] * k
    for i, r in enumerate(runs):
        heads[i] = next(r, None)
    nodes = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return (a, b) if la > lb else (b, a)
        s, t = x[1], y[1]
        c = _common(s, t, la)
        if c == len(s) or (c < len(t) and s[c] < t[c]):
            lcp[b] = c
            return a, b
        lcp[a] = c
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, nodes[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    if not runs:
        return
    winner = build(1) if k > 1 else 0
    out, held = None, []
    while heads[winner] is not None:
        _, s, rows = heads[winner]
        if out is not None and lcp[winner] == len(s) == len(out):
            held.extend(rows)
        else:
            if out is not None:
                yield out, held
            out, held = s, list(rows)
        heads[winner] = nxt = next(runs[winner], None)
        if nxt is not None:
            lcp[winner] = nxt[0]  # shared with the suffix just put out
        node = (winner + k) // 2
        while node:
            winner, nodes[node] = play(winner, nodes[node])
            node //= 2
    if out is not None:
        yield out, held


def _spans(runs: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(doc, start, end) to remove, from one bucket's runs."""
    reps: dict[int, list[tuple[int, bytes, list[int]]]] = {}
    for s, held in merge_runs([decode_run(r) for r in runs]):
        least = min(d for _, d, _ in held)
        for _, d, p in held:
            if d > least:
                yield d, p, p + len(s)
        reps.setdefault(held[0][0], []).append((least, s, [p for _, d, p in held if d == least]))
    for group in reps.values():
        if len(group) < 2 or len({d for d, _, _ in group}) < 2:
            continue
        seen: dict[bytes, int] = {}
        for doc, s, places in sorted(group, key=lambda x: x[0]):
            # windows next to each other become one span
            first, n = -1, len(s) - WINDOW + 1
            for i in range(n + 1):
                if i < n and seen.setdefault(s[i : i + WINDOW], doc) < doc:
                    first = i if first < 0 else first
                elif first >= 0:
                    for p in places:
                        yield doc, p + first, p + i - 1 + WINDOW
                    first = -1


def _hot_spans(runs: list[bytes]) -> Iterator[tuple[int, int, int, bytes | None]]:
    """(doc, start, end, window) from one bucket's runs of single windows: spans
    to remove, without the window, and those of its smallest document here."""
    for s, held in merge_runs([decode_run(r) for r in runs]):
        least = min(d for _, d, _ in held)
        for _, d, p in held:
            if d > least:
                yield d, p, p + len(s), None
        # places next to each other become one span
        places = sorted({p for _, d, p in held if d == least})
        first = places[0]
        for p, q in zip(places, [*places[1:], None]):
            if q != p + 1:
                yield least, first, p + len(s), s
                first = q


def whole_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n): documents with a row whose text, of ``WINDOW`` bytes or
    more, a document with a smaller id holds as well."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select("doc_id", F.octet_length(raw).alias("n"), F.unhex(F.sha2(raw, 256)).alias("digest")).where(F.col("n") >= WINDOW)
    first = rows.groupBy("n", "digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    late = rows.join(first, ["n", "digest"]).where("doc_id > first").select("doc_id", "n", "digest").distinct()
    # A document with other rows as well (an id that occurs with several texts) is compared.
    several = rows.groupBy("doc_id").agg(F.countDistinct("digest").alias("texts")).where("texts > 1").select("doc_id")
    return materialize(late.join(several, "doc_id", "left_anti").select("doc_id", "n"), "suffix-copies")


class Rows:
    """Suffixes held for the next runs, as columns."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.count = 0

    def add(self, padded: np.ndarray, bucket: np.ndarray, start: np.ndarray, size: np.ndarray, kmer: np.ndarray, doc: int) -> None:
        column = np.arange(WIDTH)
        text = padded[start[:, None] + column]
        text[column >= size[:, None]] = 0
        self.parts.append((bucket, text, size, kmer, np.full(start.size, doc, np.int64), start))
        self.count += start.size

    def runs(self, number: int) -> pa.RecordBatch:
        buckets, blobs = front_code(*(np.concatenate(c) for c in zip(*self.parts)))
        self.parts, self.count = [], 0
        return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array([number] * len(buckets), pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "run", "blob"])


def coded_runs(docs: DataFrame, kmers: DataFrame, copies: DataFrame) -> DataFrame:
    """(bucket, run, blob): front-coded runs of the suffixes to compare; those
    of hot k-mers, cut into windows, are in the buckets below 0."""
    count = kmers.agg(F.count(F.lit(1)).alias("all"), F.coalesce(F.sum((F.col("salts") > 0).cast("long")), F.lit(0)).alias("hot")).first()
    buckets = max(64, count["all"] // BUCKET_ROWS)
    hot_buckets = max(64, count["hot"] * (WINDOW - KMER + 1) // BUCKET_ROWS)
    kmers = kmers.join(copies.select(F.col("doc_id").alias("doc")).distinct(), "doc", "left_anti")
    wanted = kmers.groupBy("doc").agg(F.collect_list(F.struct("kmer", "salts")).alias("kmers"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = Rows(), 0
        for b in small(batches):
            listed = b.column("kmers")
            for r, (doc, text) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())):
                raw = _raw(text)
                padded = np.concatenate((raw, np.zeros(WIDTH, np.uint8)))
                hashes, first, last = anchors(raw)
                known, salts = (listed[r].values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(known)
                at = np.minimum(np.searchsorted(known, hashes, sorter=order), known.size - 1)
                at = order[at]
                met = known[at] == hashes
                salt = np.where(met, salts[at], -1)
                # A long text's suffixes leave in parts.
                for lo in range(0, hashes.size, RUN_ROWS // 32):
                    part = slice(lo, lo + RUN_ROWS // 32)
                    cold = salt[part] == 0
                    h, i, j = hashes[part][cold], first[part][cold], last[part][cold]
                    if h.size:
                        held.add(padded, h % buckets, i, j - i + WINDOW, h, doc)
                    hot = salt[part] > 0
                    if hot.any():
                        i, j, n = first[part][hot], last[part][hot], salt[part][hot]
                        each = j - i + 1
                        start = np.repeat(i, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                        mixed = mix64(np.array([doc], np.int64).view(np.uint64))[0]
                        seed = (mixed % np.repeat(n, each).astype(np.uint64)).tolist()
                        data = raw.tobytes()
                        bucket = np.array([-1 - xxhash.xxh3_64_intdigest(data[p : p + WINDOW], x) % hot_buckets for p, x in zip(start.tolist(), seed)], np.int64)
                        held.add(padded, bucket, start, np.full(start.size, WINDOW), np.zeros(start.size, np.int64), doc)
                    if held.count >= RUN_ROWS:
                        yield held.runs(number)
                        number += 1
        if held.count:
            yield held.runs(number)

    return docs.join(wanted, docs.doc_id == wanted.doc).select("doc_id", "text", "kmers").mapInArrow(runs, "bucket long, run long, blob binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): byte spans to remove, possibly overlapping."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["bucket"]):
            blobs = t.column("blob").to_pylist()
            found = _hot_spans(blobs) if t.column("bucket")[0].as_py() < 0 else ((*x, None) for x in _spans(blobs))
            while rows := list(islice(found, SPAN_ROWS)):
                d, s, e, w = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(w, pa.binary())], names=["doc_id", "start", "end", "window"])

    copies = whole_copies(docs)
    coded = coded_runs(docs, shared_kmers(docs), copies)
    spans = coded.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "doc_id long, start long, end long, window binary")
    spans = materialize(spans, "suffix-spans")
    salted = spans.where("window is not null")
    least = salted.groupBy("window").agg(F.min("doc_id").alias("least"))
    late = salted.join(least, "window").where("doc_id > least")
    found = spans.where("window is null").select("doc_id", "start", "end").unionByName(late.select("doc_id", "start", "end"))
    return found.unionByName(copies.select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end")))


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): kept bytes of each text."""
    listed = spans.groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = docs.select("doc_id", "text").join(listed, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            spans_col = b.column("spans")
            for i, text in enumerate(b.column("text").to_pylist()):
                raw = _raw(text)
                gone = np.zeros(raw.size + 1, np.int64)
                if spans_col[i].is_valid:
                    v = spans_col[i].values
                    np.add.at(gone, np.minimum(v.field(0).to_numpy(), raw.size), 1)
                    np.add.at(gone, np.minimum(v.field(1).to_numpy(), raw.size), -1)
                off = np.cumsum(gone)[:-1] > 0
                out["n_bytes"].append(raw.size)
                out["n_removed"].append(int(off.sum()))
                out["n_spans"].append(int((off[1:] & ~off[:-1]).sum()) + int(off[:1].sum()))
                out["kept"].append(raw[~off].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept"], pa.binary())], names=["doc_id", *out])

    schema = docs.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.lit(b"").alias("kept")).schema
    return rows.mapInArrow(run, schema)
