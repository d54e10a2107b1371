"""Language-model scoring with a hidden Markov model.

Words fall into emission classes: the end mark and the ``OWN`` most frequent
words have one each, the others share ``SHARED`` classes by hash.  Every class
has an emission probability by state; inside a shared class a word has
probability (c + 1) / (N_class + V_class + 1), c its training count (an unseen
word: c = 0), whatever the state.

Encoding: one pass turns each text into its classes and adds up what does not
depend on states; later passes read the classes only.

Training: Baum-Welch.  Each task adds up the expected transitions and emissions
of its whole texts, Spark sums them across partitions, and the next round
starts from the sums.  All training texts take part in every round.  Rounds go
on until the log likelihood grows by less than ``GAIN`` of itself and no faster
than before, ``MOST_ROUNDS`` at most.  States start with a taste for different
words and change seldom, so that each comes to stand for a kind of text.

Scoring: scaled forward recursion over whole texts.  Texts run side by side,
token by token; one longer than ``BLOCK`` tokens runs as blocks whose transfer
matrices are chained, in training as well, so nothing is approximated.

Counts: the ``HEAD`` most frequent words (a fixed bound; words of at most
``HEAD_BYTES`` bytes) are broadcast with their counts.  All other words of a
text go through a shuffled join with the whole vocabulary, whose size follows
the corpus.  Together they cover every word.

Nulls and odd rows: a null text is empty and consists of the end mark alone; a
null ``doc_id`` counts as training; repeated rows are separate texts; without
training rows the counts are 0 and the model uniform; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import materialize, small, texts

STATES = 4
OWN = 16_383
SHARED = 1024
CLASSES = 1 + OWN + SHARED
HEAD = 131_072
HEAD_BYTES = 64
GAIN, MOST_ROUNDS = 1e-4, 12
BLOCK = 1024
#: Tokens of the texts that run side by side (one text may have more).
SLICE_TOKENS = 1 << 20
#: Type of what a training round computes token by token (sums are doubles).
REAL = np.float32
FLUSH = 200_000
END = b""


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shared_class(word: bytes) -> int:
    return 1 + OWN + zlib.crc32(word) % SHARED


def vocabulary(training: DataFrame) -> DataFrame:
    """(word, c): every training token's count; the end mark is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return b

        for b in small(batches):
            for t in texts(b):
                seen.update(words(t))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield out()
        if seen:
            yield out()

    return training.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(vocab: DataFrame) -> list:
    """The most frequent words, at most ``HEAD``, in order of their counts.

    A histogram of counts in narrow logarithmic steps tells from which count on
    they fit; only those rows come to the driver."""
    short = vocab.where((F.length("word") <= HEAD_BYTES) & (F.length("word") > 0)).withColumn("level", F.floor(F.log2("c") * 64))
    room, least = HEAD, None
    for r in sorted(short.groupBy("level").count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    if least is None:
        return []
    return sorted(short.where(F.col("level") >= least).select("word", "c").collect(), key=lambda r: (-r["c"], bytes(r["word"])))


def _class_of(word: Column) -> Column:
    return F.lit(1 + OWN) + F.pmod(F.crc32(word), F.lit(SHARED)).cast("int")


class Segments:
    """Texts as class ids, cut into blocks of ``BLOCK`` tokens, longest first."""

    def __init__(self, lines: list[np.ndarray]):
        sizes = np.array([x.size for x in lines], np.int64)
        self.docs = sizes.size
        per = -(-sizes // BLOCK)
        self.doc = np.repeat(np.arange(sizes.size), per)
        first = np.cumsum(per) - per
        self.nth = np.arange(per.sum()) - first[self.doc]
        self.blocks = per[self.doc]
        self.length = np.minimum(BLOCK, sizes[self.doc] - self.nth * BLOCK)
        flat = np.concatenate([*lines, np.zeros(BLOCK, np.int16)])
        at = (np.cumsum(sizes) - sizes)[self.doc] + self.nth * BLOCK
        order = np.argsort(-self.length, kind="stable")
        self.doc, self.nth, self.length, self.blocks, at = (x[order] for x in (self.doc, self.nth, self.length, self.blocks, at))
        longest = int(self.length[0]) if order.size else 0
        #: Blocks that have a token at each step: the first so many.
        self.active = np.searchsorted(-self.length, -np.arange(longest), "left").tolist()
        #: Class ids of each step's active blocks.
        self.steps = [flat[at[:k] + t] for t, k in enumerate(self.active)]
        self.chained = np.flatnonzero(self.blocks > 1)


def transfers(seg: Segments, a: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, log scale) of each block of texts that have several."""
    own = seg.chained
    m, logs = np.broadcast_to(np.eye(STATES), (own.size, STATES, STATES)).copy(), np.zeros(own.size)
    for t, cls in enumerate(seg.steps):
        k = int(np.searchsorted(own, seg.active[t]))
        if not k:
            break
        m[:k] = (m[:k].reshape(-1, STATES) @ a).reshape(k, STATES, STATES) * e[cls[own[:k]]][:, None, :]
        if t % 8 == 7:
            big = m[:k].max((1, 2))
            m[:k] /= big[:, None, None]
            logs[:k] += np.log(big)
    return m, logs


def chain(seg: Segments, model: dict, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State distribution before each block, and the backward vector after it
    (each up to a factor)."""
    before, after = np.tile(model["start"], (seg.doc.size, 1)), np.ones((seg.doc.size, STATES))
    own = seg.chained
    if own.size:
        m, _ = transfers(seg, model["A"], e)
        place = {(int(seg.doc[b]), int(seg.nth[b])): i for i, b in enumerate(own.tolist())}
        for d in sorted({k[0] for k in place}):
            rows = [place[d, j] for j in range(int(seg.blocks[own[place[d, 0]]]))]
            state, back = model["start"], np.ones(STATES)
            for i in rows:
                before[own[i]] = state
                state = state @ m[i]
                state = state / state.sum()
            for i in reversed(rows):
                after[own[i]] = back
                back = m[i] @ back
                back = back / back.sum()
    return before, after


def expected(seg: Segments, model: dict, sums: dict) -> None:
    """Add a slice's expected transitions, emissions and starts, and its log
    likelihood, to ``sums``."""
    if not seg.steps:
        return
    a, e = model["A"].astype(REAL), model["E"].astype(REAL)
    before, after = (x.astype(REAL) for x in chain(seg, model, model["E"]))
    # Forward: scaled state distributions before the first step and after each.
    alphas, scales, gains, add = [before], [], [], np.ones((STATES, 1), REAL)
    for cls, k in zip(seg.steps, seg.active):
        gain = e[cls]
        nxt = alphas[-1][:k] @ a
        nxt *= gain
        c = nxt @ add
        nxt /= c
        alphas.append(nxt), scales.append(c), gains.append(gain)
    # A chained block's backward vector is known up to a factor; with the right
    # one, forward times backward sums to 1 at every step.
    beta = after
    for i in seg.chained.tolist():
        beta[i] /= (alphas[int(seg.length[i])][i] * beta[i]).sum()
    gammas, flows = [None] * len(scales), [None] * len(scales)
    for t in reversed(range(len(scales))):
        k = seg.active[t]
        gammas[t] = alphas[t + 1] * beta[:k]
        flow = gains[t]
        flow *= beta[:k]
        flow /= scales[t]
        flows[t] = flow
        beta[:k] = flow @ a.T
    sums["A"] += model["A"] * (np.concatenate([x[:k] for x, k in zip(alphas, seg.active)]).T @ np.concatenate(flows))
    flat, weight = np.concatenate(seg.steps).astype(np.intp), np.concatenate(gammas).T.astype(np.float64)
    for s in range(STATES):
        sums["B"][s] += np.bincount(flat, weight[s], CLASSES)
    sums["start"] += (before * beta)[seg.nth == 0].sum(0)
    sums["ll"] += float(np.log(np.concatenate(scales), dtype=np.float64).sum())


def log_likelihood(seg: Segments, model: dict) -> np.ndarray:
    """Natural log probability of each text's class sequence."""
    before, _ = chain(seg, model, model["E"])
    state, total = before, np.zeros(seg.doc.size)
    for cls, k in zip(seg.steps, seg.active):
        nxt = (state[:k] @ model["A"]) * model["E"][cls]
        c = nxt.sum(1)
        total[:k] += np.log(c)
        state = nxt / c[:, None]
    return np.bincount(seg.doc, total, seg.docs)


def _normalised(sums: dict) -> dict:
    """Smoothed model from expected counts; E is B by class."""
    a, b = sums["A"] + 1.0, sums["B"] + 0.1
    a, b, start = a / a.sum(1, keepdims=True), b / b.sum(1, keepdims=True), sums["start"] + 1.0
    return {"A": a, "B": b, "E": np.ascontiguousarray(b.T), "start": start / start.sum()}


def _initial(class_counts: np.ndarray) -> dict:
    """Class frequencies, tilted by a fixed pattern so that states differ, and
    states that stay."""
    rng = np.random.default_rng(5)
    return _normalised({"A": np.full((STATES, STATES), 1.0) + 96 * np.eye(STATES), "B": class_counts * rng.uniform(0.2, 1.8, (STATES, CLASSES)), "start": np.ones(STATES)})


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows whose ``classes`` hold a bounded number of tokens."""
    for b in batches:
        lines = [np.frombuffer(x.as_buffer(), np.int16) for x in b.column("classes")]
        ends = np.cumsum([x.size for x in lines])
        lo = 0
        while lo < len(lines):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_TOKENS, "right")))
            yield b.slice(lo, hi - lo), lines[lo:hi]
            lo = hi


def train(encoded: DataFrame, class_counts: np.ndarray) -> tuple[dict, list[float]]:
    """Baum-Welch over all rows of ``encoded``: the model, and the log
    likelihood that each round began with."""
    sc = encoded.sparkSession.sparkContext
    model, lls = _initial(class_counts), []
    for _ in range(MOST_ROUNDS):
        now = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums = {"A": np.zeros((STATES, STATES)), "B": np.zeros((STATES, CLASSES)), "start": np.zeros(STATES), "ll": np.zeros(1)}
            for _, lines in sliced(batches):
                expected(Segments(lines), now.value, sums)
            for kind, x in sums.items():
                at = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * at.size, pa.string()), pa.array(at.astype(np.int32)), pa.array(x.ravel()[at], pa.float64())], names=["kind", "i", "v"])

        sums = {"A": np.zeros(STATES * STATES), "B": np.zeros(STATES * CLASSES), "start": np.zeros(STATES), "ll": np.zeros(1)}
        for r in encoded.select("classes").mapInArrow(run, "kind string, i int, v double").groupBy("kind", "i").agg(F.sum("v").alias("v")).toPandas().itertuples(index=False):
            sums[r.kind][r.i] = r.v
        now.unpersist()
        if not sums["start"].any():
            break
        lls.append(float(sums["ll"][0]))
        model = _normalised({"A": sums["A"].reshape(STATES, STATES), "B": sums["B"].reshape(STATES, CLASSES), "start": sums["start"]})
        gains = np.diff(lls)
        if gains.size > 1 and gains[-1] <= min(gains[-2], GAIN * abs(lls[-1])):
            break
    return model, lls


def encode(docs: DataFrame, table: dict, known_end: int, inside: np.ndarray) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, known, base, within, classes, rest):
    ``base`` and ``within`` add up over the words of the head; ``rest`` lists
    the others, which are here as unseen ones."""
    head, less = docs.sparkSession.sparkContext.broadcast(table), docs.sparkSession.sparkContext.broadcast(inside)
    listed = F.array(F.struct(F.lit(b"").alias("word"), F.lit(0).cast("long").alias("tf")))
    zero = F.lit(0).cast("long")
    schema = docs.select(zero.alias("row"), "doc_id", "held_out", zero.alias("n_tokens"), zero.alias("known"), F.lit(0.0).alias("base"), F.lit(0.0).alias("within"), F.lit(b"").alias("classes"), listed.alias("rest")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, cls, base, within = head.value["at"].get, head.value["class"], head.value["base"], head.value["in"]
        unseen, row = less.value, TaskContext.get().partitionId() << 33
        for b in small(batches):
            flat, sizes = [], []
            for t in texts(b):
                w = words(t)
                flat += w
                flat.append(END)
                sizes.append(len(w) + 1)
            if not sizes:
                continue
            at = np.fromiter(map(get, flat, repeat(-1)), np.int64, len(flat))
            met = at >= 0
            other = np.flatnonzero(~met)
            line = cls[at]
            line[other] = [shared_class(flat[i]) for i in other.tolist()]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            sums = [np.add.reduceat(x, starts) for x in (met.astype(np.int64), np.where(met, base[at], 0.0), np.where(met, within[at], -unseen[line]))]
            # The words outside the head, each with its number, document by document.
            rest = [Counter(flat[i] for i in part.tolist()) for part in np.split(other, np.searchsorted(other, ends[:-1]))]
            bounds = np.concatenate(([0], np.cumsum([len(c) for c in rest])))
            listed = pa.StructArray.from_arrays([pa.array([x for c in rest for x in c], pa.binary()), pa.array([x for c in rest for x in c.values()], pa.int64())], names=["word", "tf"])
            line = line.astype(np.int16)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + n)), b.column("doc_id"), b.column("held_out"), pa.array(sizes, pa.int64()), pa.array(sums[0] - 1 + known_end), pa.array(sums[1]), pa.array(sums[2]),
                pa.array([line[lo:hi].tobytes() for lo, hi in zip(starts.tolist(), ends.tolist())], pa.binary()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), listed)],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "within", "classes", "rest"])
            row += n

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    vocab = materialize(vocabulary(training), "lm-vocabulary")
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = most_frequent(vocab)
    end = vocab.where(F.length("word") == 0).first()
    ends = end["c"] if end else 0

    # Totals of the shared classes; own words, which hash there too, leave them.
    groups = {r["k"]: (r["c"], r["v"]) for r in vocab.where(F.length("word") > 0).groupBy(_class_of(F.col("word")).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()}
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (c, types) in groups.items():
        class_n[k], class_v[k] = c, types
    for r in frequent[:OWN]:
        k = shared_class(bytes(r["word"]))
        class_n[k] -= r["c"]
        class_v[k] -= 1
    class_counts = class_n.copy()
    class_counts[0] = ends
    class_counts[1 : 1 + len(frequent[:OWN])] = [r["c"] for r in frequent[:OWN]]
    inside = np.log10(class_n + class_v + 1.0)  # minus log10 of an unseen word's share

    # Entry 0 is the end mark, then the head by frequency.
    base_all = math.log10(n + v + 1.0)
    counts = np.array([ends, *(r["c"] for r in frequent)], np.float64)
    cls = np.array([0, *(1 + i if i < OWN else shared_class(bytes(r["word"])) for i, r in enumerate(frequent))], np.int64)
    within = np.where(np.arange(counts.size) <= OWN, 0.0, np.log10(counts + 1.0) - inside[cls])
    table = {"at": {END: 0} | {bytes(r["word"]): 1 + i for i, r in enumerate(frequent)}, "class": cls, "base": np.log10(counts + 1.0) - base_all, "in": within}
    encoded = materialize(encode(docs, table, int(ends > 0), inside), "lm-encoded")
    model = spark.sparkContext.broadcast(train(encoded.where(~F.col("held_out")), class_counts)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lines in sliced(batches):
            hidden = log_likelihood(Segments(lines), model.value) / math.log(10)
            names = [c for c in part.schema.names if c != "classes"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(hidden)], names=[*names, "hidden"])

    plain = encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "within", F.aggregate("rest", F.lit(0).cast("long"), lambda a, x: a + x["tf"]).alias("n_rest"), "classes")
    scored = plain.mapInArrow(run, plain.drop("classes").withColumn("hidden", F.lit(0.0)).schema)
    rest = encoded.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.tf")
    # Unseen words add log10(1) beyond the share already counted.
    seen = rest.join(vocab, "word").groupBy("row").agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("gain"))
    out = scored.join(seen, "row", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_rest") * base_all + gain).alias("base_score"), (F.col("within") + F.col("hidden") + gain).alias("score"))
