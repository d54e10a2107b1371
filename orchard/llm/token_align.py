"""Alignment of two tokenizers' tokens on the same text.

Both tokenizers cut the bytes of one space and the text into tokens that tile
it.  Per batch, ``pandas.merge_asof`` keyed by document finds for each token
start the token of the other side that covers it, in both directions; their
union holds every overlapping pair.  An overlapping pair with equal ends closes
a group, and every A-B pair of token occurrences inside a group is a link.

Corpus-wide, a pair of ids counts the documents that hold it linked.  Tasks add
these up for their rows before the shuffle.  The ``HEAD`` most frequent pairs
at most (cut by a histogram of counts) are broadcast; a document's other pairs
meet their counts in a shuffled join, so every pair counts at every size.  The
highest count of each A id is a table of at most one row per id of A's
vocabulary and is broadcast.

Memory: texts are tokenised in slices of at most ``ROWS`` rows and, beyond one
row, ``BYTES`` bytes.  Links are enumerated ``LINKS`` at a time; a group of
more than ``LARGE`` links (a long run where the tokenizers never meet) goes by
its distinct ids and their numbers instead, so a text's cost follows its
distinct pairs.  One text's tokens must fit in a task.

The tokenizer files are read on the driver (under 3 MB) and broadcast.

Nulls and odd rows: a null or empty text, and one whose tokens' joined bytes on
either side differ from space and text, has no tokens: zeros and ''.  Rows are
documents of their own, also if they repeat an id or have none; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.bpe import byte_symbols
from orchard.llm.common import materialize, worker_cache

ROWS, BYTES = 128, 1 << 20
LINKS = 1 << 21
LARGE = 4096
HEAD = 1 << 19
#: Distinct pairs that a task adds up before it sends them on.
FLUSH = 1 << 21
SPACE_MARK = "▁"
#: Fixed value: how byte-level files cut a text before merging.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizers:
    """Both tokenizers with their tokens' bytes.  A: a byte-level ``tokenizers``
    file; B: a ``sentencepiece`` model, which puts a space in front itself."""

    def __init__(self, a_file: str, b_file: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import regex
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        back = {c: i for i, c in enumerate(byte_symbols())}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        # Entries with characters outside the byte alphabet are added tokens.
        self.a_bytes = [bytes([back[c] for c in s]) if all(c in back for c in s) else s.encode() for s in names]
        pieces = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        #: Decimal id with each separator: inside a side, and after its last token.
        self.a_text = [f"{i}{s}" for i in range(len(self.a_bytes)) for s in ",|"]
        self.b_text = [f"{i}{s}" for i in range(len(self.b_bytes)) for s in ",;"]
        # The same merges by rank, where the file's ids follow its merges, its
        # split is the plain byte-level one and the text's character classes are
        # beyond doubt; the file's own library otherwise.
        spec = json.loads(a_file)
        cut, merges = spec.get("pre_tokenizer") or {}, [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not spec.get("normalizer")
        order = [spec["model"]["vocab"][x + y] for x, y in merges]
        self.ranked = None
        if plain and order == sorted(order) and len(order) + 256 == len(spec["model"]["vocab"]) - len({t["content"] for t in spec["added_tokens"]} & set(spec["model"]["vocab"])):
            added = {t["content"] for t in spec["added_tokens"]}
            self.ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, special_tokens={}, mergeable_ranks={self.a_bytes[i]: i for x, i in spec["model"]["vocab"].items() if x not in added})
        self.unusual = regex.compile("[^\x00-\u024f]|[\x1c-\x1f\x85]").search

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text on both sides; none where the bytes differ."""
        a, b = [], self.b.encode(texts, num_threads=1)
        for i, t in enumerate(texts):
            whole = " " + t
            ranked = self.ranked is not None and self.unusual(t) is None
            a.append(self.ranked.encode_ordinary(whole) if ranked else self.a.encode(whole, add_special_tokens=False).ids)
            want = whole.encode()
            if not t or b"".join(map(self.a_bytes.__getitem__, a[i])) != want or b"".join(map(self.b_bytes.__getitem__, b[i])) != want:
                a[i], b[i] = [], []
        return a, b


def overlaps(a_doc, a_start, b_doc, b_start) -> tuple[np.ndarray, np.ndarray]:
    """Indices (A, B) of overlapping tokens: each token start with the token of
    the other side that covers it.  Starts grow over the whole batch."""
    a = pd.DataFrame({"at": a_start, "doc": a_doc, "a": np.arange(a_start.size)})
    b = pd.DataFrame({"at": b_start, "doc": b_doc, "b": np.arange(b_start.size)})
    pairs = [pd.merge_asof(a, b, on="at", by="doc"), pd.merge_asof(b, a, on="at", by="doc")]
    return np.concatenate([p["a"].to_numpy() for p in pairs]), np.concatenate([p["b"].to_numpy() for p in pairs])


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if keys.size else times


class Aligned:
    """Groups and links of a slice of texts, from its token ids."""

    def __init__(self, tok: Tokenizers, a: list[list[int]], b: list[list[int]]):
        self.tok, self.n = tok, len(a)
        self.n_a, self.n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        self.a, self.b = (np.concatenate([np.array(x, np.int64) for x in side]) for side in (a, b))
        self.a_doc, self.b_doc = np.repeat(np.arange(self.n), self.n_a), np.repeat(np.arange(self.n), self.n_b)
        a_end, b_end = np.cumsum(tok.a_size[self.a]), np.cumsum(tok.b_size[self.b])
        at, bt = overlaps(self.a_doc, a_end - tok.a_size[self.a], self.b_doc, b_end - tok.b_size[self.b])
        close = a_end[at] == b_end[bt]
        self.a_last, self.b_last = np.zeros(self.a.size, bool), np.zeros(self.b.size, bool)
        self.a_last[at[close]] = True
        self.b_last[bt[close]] = True
        self.a_group, self.b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        self.group_doc = self.a_doc[self.a_last]
        groups = self.group_doc.size
        self.p, self.q = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        self.n_groups = np.bincount(self.group_doc, minlength=self.n)
        summed = np.concatenate(([0], np.cumsum(self.p * self.q)))
        ends = np.concatenate(([0], np.cumsum(self.n_groups)))
        self.n_links = summed[ends[1:]] - summed[ends[:-1]]

    def digests(self) -> list[str]:
        """Hex digest of each document's groups, '' without tokens."""
        # Both sides interleaved: a group's A tokens, then its B tokens.
        to_a = np.arange(self.a.size) + (np.cumsum(self.q) - self.q)[self.a_group]
        to_b = np.arange(self.b.size) + np.cumsum(self.p)[self.b_group]
        words = np.empty(self.a.size + self.b.size, object)
        words[to_a] = list(map(self.tok.a_text.__getitem__, (2 * self.a + self.a_last).tolist()))
        words[to_b] = list(map(self.tok.b_text.__getitem__, (2 * self.b + self.b_last).tolist()))
        flat, out, lo = words.tolist(), [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256("".join(flat[lo : lo + n])[:-1].encode()).hexdigest() if n else "")
            lo += n
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs, times, bounds): each document's distinct linked id pairs
        ``a * size of B + b`` in order, how often it links them, and where
        each document begins and ends."""
        width = len(self.tok.b_bytes)
        large = self.p * self.q > LARGE
        first, a_first = np.cumsum(self.q) - self.q, np.cumsum(self.p) - self.p
        found = []
        for g in np.flatnonzero(large).tolist():
            (x, m), (y, k) = (np.unique(t[lo : lo + n], return_counts=True) for t, lo, n in ((self.a, a_first[g], self.p[g]), (self.b, first[g], self.q[g])))
            base = int(self.group_doc[g]) << 40
            found.append((((x * width)[:, None] + y + base).ravel(), (m[:, None] * k).ravel()))
        tokens = np.flatnonzero(~large[self.a_group])
        each = self.q[self.a_group[tokens]]
        done = np.cumsum(each)
        lo = 0
        while lo < tokens.size:
            hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + LINKS, "right")))
            i, n = tokens[lo:hi], each[lo:hi]
            of = np.repeat(i, n)
            nth = np.arange(of.size) - np.repeat(np.cumsum(n) - n, n)
            keys = (self.a_doc[of] << 40) + self.a[of] * width + self.b[first[self.a_group[of]] + nth]
            found.append(_distinct(keys, np.ones(keys.size, np.int64)))
            lo = hi
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(self.n + 1, np.int64)
        keys, times = found[0] if len(found) == 1 and not large.any() else _distinct(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        return keys & ((1 << 40) - 1), times, np.searchsorted(keys, np.arange(self.n + 1) << 40)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc ids, texts) of few rows and, beyond one row, of few bytes."""
    for b in batches:
        size = b.column("n").to_numpy(zero_copy_only=False)
        lo = 0
        while lo < b.num_rows:
            hi = lo + 1
            total = size[lo]
            while hi < b.num_rows and hi - lo < ROWS and total + size[hi] <= BYTES:
                total += size[hi]
                hi += 1
            part = b.slice(lo, hi - lo)
            yield part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()]
            lo = hi


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def align(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, int]:
    """A row per document with its token and group numbers and its distinct
    linked pairs, and the size of B's vocabulary."""
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = sc.broadcast((f.read(), g.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key = worker_cache("align"), hash(files.value)
        if key not in cache:
            cache.clear()
            cache[key] = Tokenizers(*files.value)
        tok = cache[key]
        row = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in ALIGNED.split(", ")]
        for ids, texts in slices(batches):
            x = Aligned(tok, *tok.encode(texts))
            pairs, times, bounds = x.pairs()
            bounds = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64()), pa.array(x.n_a, pa.int64()), pa.array(x.n_b, pa.int64()),
                pa.array(x.n_groups, pa.int64()), pa.array(x.n_links, pa.int64()), pa.array(x.digests()),
                pa.ListArray.from_arrays(bounds, pa.array(pairs)), pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64()))], names=names)
            row += len(ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_proto=files.value[1]).get_piece_size()
    return rows.mapInArrow(run, ALIGNED), width


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no
    pair of its A id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added():
            keys, n = _distinct(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held[:] = [(keys, n)]
            return keys.size

        def out():
            for lo in range(0, held[0][0].size, 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + (1 << 16)]) for x in held[0]], names=["pair", "n"])
            held.clear()

        for b in batches:
            keys = b.column("pairs").flatten().to_numpy()
            if not keys.size:
                continue
            keys, n = np.unique(keys, return_counts=True)
            held.append((keys, n.astype(np.int64)))
            size += keys.size
            if size > FLUSH:
                size = added()
                if size > FLUSH // 2:
                    yield from out()
                    size = 0
        if held:
            added()
            yield from out()

    counts = aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-counts")
    a_id = F.floor(F.col("pair") / F.lit(width))
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def head_of(counts: DataFrame) -> pd.DataFrame:
    """The most frequent pairs, at most ``HEAD``, in order of the pair: a
    histogram of counts in narrow logarithmic steps tells where to cut."""
    levels = counts.withColumn("level", F.floor(F.log2("n") * 64))
    room, least = HEAD, None
    for r in sorted(levels.groupBy("level").count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    frame = levels.where(F.lit(False) if least is None else F.col("level") >= least).select("pair", "n", "best").toPandas()
    return frame.sort_values("pair")


def link_report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: tokens of both sides, groups, links, the links whose pair
    is its A id's most frequent one, the sum of the links' counts, the groups'
    digest."""
    spark = docs.sparkSession
    aligned, width = align(docs, a_path, b_path)
    aligned = materialize(aligned, "aligned")
    counts = materialize(pair_counts(aligned, width), "pair-links")
    frame = head_of(counts)
    head = spark.sparkContext.broadcast((frame["pair"].to_numpy(np.int64), frame["n"].to_numpy(np.int64), frame["best"].to_numpy(bool)))

    def found(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = head.value[0]
        if not keys.size:
            return np.zeros(values.size, np.int64), np.zeros(values.size, bool)
        at = np.minimum(np.searchsorted(keys, values), keys.size - 1)
        return at, keys[at] == values

    def flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs = b.column("pairs")
        lengths = pairs.value_lengths().to_numpy(zero_copy_only=False)
        return pairs.flatten().to_numpy(), b.column("times").flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))

    def in_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs, times, ends = flat(b)
            at, hit = found(pairs)
            if head.value[0].size:
                times = np.where(hit, times, 0)
                per = [times * head.value[1][at], times * head.value[2][at]]
            else:
                per = [np.zeros(pairs.size, np.int64)] * 2
            sums = [np.concatenate(([0], np.cumsum(x))) for x in per]
            arrays = [b.column(i) for i, f in enumerate(b.schema) if f.name not in ("pairs", "times")]
            names = [f.name for f in b.schema if f.name not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums)], names=[*names, "head_sum", "head_best"])

    def in_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs, times, ends = flat(b)
            rest = ~found(pairs)[1]
            if rest.any():
                row = np.repeat(b.column("row").to_numpy(), np.diff(ends))
                yield pa.RecordBatch.from_arrays([pa.array(x[rest]) for x in (row, pairs, times)], names=["row", "pair", "times"])

    base = ", ".join(c for c in ALIGNED.split(", ") if c.split()[0] not in ("pairs", "times"))
    scored = aligned.mapInArrow(in_head, base + ", head_sum long, head_best long")
    tail = aligned.select("row", "pairs", "times").mapInArrow(in_tail, "row long, pair long, times long")
    tail = tail.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("tail_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("tail_best"))
    whole = scored.join(tail, "row", "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("head_best") + F.coalesce("tail_best", F.lit(0))).alias("n_best"),
        (F.col("head_sum") + F.coalesce("tail_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
