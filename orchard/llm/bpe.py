"""BPE encoding and decoding.

A word's symbols form a doubly linked list; a heap holds the merge rank of
each adjacent pair, and an entry whose pair has since changed is skipped when
it surfaces.  Decoding concatenates vocabulary strings.  Words repeat, so each
Python worker keeps two bounded tables of words already encoded: when the newer
one is full it replaces the older one, and a word found there moves on (a miss
is encoded again).

The vocabulary file is a ``tokenizers`` JSON: a BPE model with an end-of-word
suffix, byte-level symbols and added tokens that are matched in the raw text.
It is read on the driver (fixed size, under 2 MB) and broadcast.  Texts whose
characters all lie below U+0250 are normalised here (no composition applies to
them) and split here if the file's pattern is ``WORDS``; others go through the
file's own normaliser and splitter, whose Unicode tables then decide.

Nulls and odd rows: a null or empty text has no tokens; any length is encoded
whole; rows are independent, so repeats and null ids just pass through; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat
from operator import add
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import worker_cache

#: Words in each of a worker's two tables.
WORDS_KEPT = 200_000
ROWS_AT_ONCE = 256
#: The split by which a run of letters, or of marks after it, is one word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space to Python's split() but not to the file.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: A heap entry is ``rank << POSITION | position``; NONE is above all of them.
POSITION, NONE = 32, 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value: visible
    Latin-1 characters stand for themselves, the rest follow from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """Merge tables of one vocabulary file."""

    def __init__(self, source: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        symbols = self.symbols = byte_symbols()
        # Symbols are numbered from the byte values on, those that end a word
        # next; each has its vocabulary id as little-endian 32 bits.
        names = dict.fromkeys([*symbols, *(c + suffix for c in symbols), *self.vocab])
        number = {name: i for i, name in enumerate(names)}
        self.ids = [self.vocab[name].to_bytes(4, "little") for name in names]
        self.ending = number[symbols[0] + suffix]
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.merges = {(number[a], number[b]): rank << POSITION for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.merged = [number[a + b] for a, b in pairs]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = strings_of(source)
        own = Tokenizer.from_str(source)
        self.normalize, self.pretokenize = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.splits_here = pattern == WORDS
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.high = re.compile("[^\x00-\u024f]").search
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: str) -> bytes:
        """Little-endian 32-bit ids of one word of normalised text."""
        symbols = list(word.encode("utf-8"))
        symbols[-1] += self.ending
        n, rank_of, merged = len(symbols), self.merges.get, self.merged
        ranks = [*map(rank_of, zip(symbols, symbols[1:]), repeat(NONE)), NONE]
        heap = [e for e in map(add, ranks, range(n)) if e < NONE]
        heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        at = (1 << POSITION) - 1
        while heap:
            entry = heappop(heap)
            i = entry & at
            if ranks[i] != entry - i:  # stale: one of the two has merged since
                continue
            j = after[i]
            symbols[i] = new = merged[entry >> POSITION]
            symbols[j] = -1
            after[i] = k = after[j]
            ranks[i] = ranks[j] = NONE
            if k < n:
                before[k] = i
                ranks[i] = rank = rank_of((new, symbols[k]), NONE)
                if rank < NONE:
                    heappush(heap, rank + i)
            if (h := before[i]) >= 0:
                ranks[h] = rank = rank_of((symbols[h], new), NONE)
                if rank < NONE:
                    heappush(heap, rank + h)
        ids = self.ids
        return b"".join([ids[x] for x in symbols if x >= 0])

    def word(self, word: str) -> bytes:
        """``merge`` through the tables of known words."""
        found = self.known.get(word)
        if found is None:
            found = self.older.get(word) or self.merge(word)
            if len(word) <= 64:
                if len(self.known) >= WORDS_KEPT:
                    self.older, self.known = self.known, {}
                self.known[word] = found
        return found

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if self.splits_here and (text.isascii() or self.high(text) is None) and not any(c in text for c in SEPARATORS):
            get, make = self.known.get, self.chunk  # no word spans white space
            return b"".join([get(c) or make(c) for c in text.lower().split()])
        back = {c: b for b, c in enumerate(self.symbols)}
        split = self.pretokenize(self.normalize(text))
        return b"".join([self.word(bytes(back[c] for c in w).decode("utf-8")) for w, _ in split])

    def chunk(self, chunk: str) -> bytes:
        """Ids of a lower-cased run without white space."""
        if chunk.isalpha():
            return self.word(chunk)
        head = chunk.rstrip(punctuation)
        if head.isalpha():  # a word and the marks behind it
            return self.word(head) + self.word(chunk[len(head) :])
        return b"".join(map(self.word, self.find(chunk)))

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.added):
            return self.plain(text)
        parts = self.cut.split(text)
        return b"".join(self.plain(p) if i % 2 == 0 else np.array([self.added[p]], "<u4").tobytes() for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        return decode_ids(self.strings, ids)


def strings_of(source: str) -> dict[int, str]:
    """Vocabulary string of each id, added tokens included."""
    spec = json.loads(source)
    return {i: s for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


def decode_ids(strings: dict[int, str], ids: bytes) -> str:
    return " ".join(map(strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _mapped(df: DataFrame, vocabulary: str, column: str, out: str, kind: str, make, each) -> DataFrame:
    """``df`` with ``out`` = ``each(make(file), column's value)``; other columns
    pass.  What ``make`` builds is kept by the worker."""
    with open(vocabulary, encoding="utf-8") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c != out]
    schema = df.select(*keep, F.lit(None).cast(kind).alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key = worker_cache("bpe-" + kind), hash(source.value)
        if key not in cache:
            cache.clear()
            cache[key] = make(source.value)
        tables = cache[key]
        to = pa.binary() if kind == "binary" else pa.string()
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(lo, ROWS_AT_ONCE)
                values = pa.array([each(tables, v) for v in b.column(column).to_pylist()], to)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), values], names=[*keep, out])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the text's token ids as little-endian 32-bit integers."""
    return _mapped(df, vocabulary, text, out, "binary", Bpe, lambda bpe, t: bpe.encode(t or ""))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the vocabulary strings of ``ids``, as the file's tokenizer
    (which has no decoder stage) joins them: one space between tokens."""
    return _mapped(df, vocabulary, ids, out, "string", strings_of, lambda strings, b: decode_ids(strings, b or b""))


def round_trip(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` without its text, with ``ids`` and ``decoded``: both directions in
    one pass and one worker."""
    with open(vocabulary, encoding="utf-8") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c not in (text, ids, decoded)]
    schema = df.select(*keep, F.lit(b"").alias(ids), F.lit("").alias(decoded)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key = worker_cache("bpe-binary"), hash(source.value)
        if key not in cache:
            cache.clear()
            cache[key] = Bpe(source.value)
        bpe = cache[key]
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(lo, ROWS_AT_ONCE)
                found = [bpe.encode(t or "") for t in b.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(found, pa.binary()), pa.array([bpe.decode(x) for x in found], pa.string())], names=[*keep, ids, decoded])

    return df.mapInArrow(run, schema)
