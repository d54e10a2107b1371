"""N-gram Jaccard self-join with a token-group matrix.

A document's set holds its distinct shingles of ``words`` words as 64-bit hashes;
sets link at a Jaccard of ``num / den`` or more (3 words and 9/10 unless given).

1. Equal sets form one class; only its smallest id goes on.
2. Candidates come from segments: the shingle universe is cut by hash into m
   segments, m more than the largest symmetric difference that the threshold
   allows for the size class, so two linked sets agree on a whole segment.
   Segments are far more selective than single shingles: a passage that many
   documents share rarely fills one.  A pair meets in the size class of the
   smaller set; a set also enters the class below when a partner may be there.
   As m exceeds the difference by more than one, linked sets agree on several
   segments, and each leaves out its most widely held ones (prefix filter).
3. Each segment's holders are compared with its smallest holder.  What links
   forms the groups: similar documents, partitioned.
4. A segment whose holders lie in several groups gives buckets to compare.
   Where the groups are few (``FEW``), each document meets the whole of every
   foreign group once, whatever number of segments they share.  Where they are
   many, the segment's holders meet each other.  The rows of a bucket's
   token-group matrix are the shingle unions of its groups.  A document is held
   against the unions of the other groups first; only where the overlap can
   reach the threshold is a group opened and its members compared.  Groups that
   link become one on the way, so a bucket gives no more links than it has
   documents.  Large buckets are cut into parts of about ``CHUNK``, and every
   two parts meet in a task; what the tables carry grows with documents x parts,
   never with pairs.
5. Components over the links give each document its component.

No link is lost: steps 2 to 4 are exact.  Links within a group beyond those
that connect it are not listed.

Nulls and odd rows: texts without words (or null) have an empty set and link
with nothing; a text with fewer words than the shingle length is one shingle;
rows that share a ``doc_id`` are one node of the graph but keep a row each; a
null ``doc_id`` has no component unless its set equals another's; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import components, grouped, materialize, mix64, small, texts, word_hashes

WORDS = 3
#: Similarity as a fraction: 10 * intersection >= 9 * union.
NUM, DEN = 9, 10
GROWTH = 1.5
SPARE = 6
CHUNK = 2048
FEW = 8
#: Documents that a leader is compared with in one task.
STAR = 512


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    w = word_hashes(text)
    if not w.size:
        return w
    k = min(words, w.size)
    h = np.zeros(w.size - k + 1, np.uint64)
    for i in range(k):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w[i : w.size - k + 1 + i])
    return np.unique(h)


def _bounds(limit: int = 1 << 40) -> list[int]:
    """Lower ends of the size classes."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
    return out


def segment_keys(tokens: np.ndarray, bounds: list[int], num: int = NUM, den: int = DEN) -> tuple[np.ndarray, int]:
    """Keys of the set's segments in the size classes where it may meet
    partners, and the least number of keys it shares with any partner."""
    n = tokens.size
    least = -(-n * num // den)
    keys, need = [], []
    for k in range(int(np.searchsorted(bounds, least, "right")) - 1, int(np.searchsorted(bounds, n, "right"))):
        largest = bounds[k + 1] - 1
        differ = largest * (den - num) // num  # most the smaller set's partner can differ
        if not differ:
            continue  # in this class linked sets are equal
        spare = 1 + differ // SPARE  # linked sets agree on spare + 1 segments or more
        m = differ + 1 + spare
        seg = (mix64(tokens ^ np.uint64(0xA5A5 + k)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        at = seg[order]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sums = np.add.reduceat(mix64(tokens[order] + np.uint64(0x51ED270B)), starts)
        filled = at[starts]
        void = m - filled.size
        if void > spare:  # more empty segments than can be passed over
            empty = np.setdiff1d(np.arange(m), filled)
            filled, sums = np.concatenate((filled, empty)), np.concatenate((sums, np.zeros(empty.size, np.uint64)))
        # A partner with few empty segments lists none of them.
        need.append(max(1, spare + 1 - void))
        keys.append(mix64(sums ^ mix64(filled.astype(np.uint64) + np.uint64(k << 40))))
    return (np.concatenate(keys), min(need)) if keys else (np.empty(0, np.uint64), 1)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n, sig): set size and 128-bit digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = [shingles(t, words) for t in texts(b)]
            sig = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.size for s in sets], pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "n", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("sig")).schema)


def _keys(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds()
        for b in small(batches):
            found = [segment_keys(shingles(t, words), bounds, num, den) for t in texts(b)]
            keys, need = [k.view(np.int64) for k, _ in found], [n for _, n in found]
            offsets = np.concatenate(([0], np.cumsum([k.size for k in keys]))).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*keys, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), listed, pa.array(need, pa.int32())], names=["doc", "keys", "need"])

    schema = docs.select(F.col("doc_id").alias("doc"), F.array(F.lit(0).cast("long")).alias("keys"), F.lit(0).alias("need")).schema
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def open_stars(docs: DataFrame, roles: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Links (a, b) between leaders and the documents of their chunks.

    ``roles`` holds (doc, grp, chunk, kind): kind 0 the leader, which arrives
    first, kind 1 the documents it is compared with."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = [shingles(t, words).tobytes() for t in texts(b)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc", "grp", "chunk", "kind")), pa.array(sets, pa.binary())], names=["doc", "grp", "chunk", "kind", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = leader = None
        for b in small(batches):
            a_out, b_out = [], []
            for doc, grp, chunk, kind, raw in zip(*(b.column(c).to_pylist() for c in ("doc", "grp", "chunk", "kind", "tokens"))):
                if (grp, chunk) != key:
                    key, leader = (grp, chunk), None
                t = np.frombuffer(raw, np.uint64)
                if kind == 0:
                    leader = t
                    continue
                # J >= num/den needs num/den of the larger set at least.
                if leader is None or den * min(t.size, leader.size) < num * max(t.size, leader.size):
                    continue
                both = np.intersect1d(t, leader, assume_unique=True).size
                if den * both >= num * (t.size + leader.size - both):
                    a_out.append(doc), b_out.append(grp)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    # The roles grow with the corpus: they are joined by a shuffle, not broadcast.
    t = docs.select(F.col("doc_id").alias("doc"), "text").join(roles.hint("merge"), "doc").select("doc", "grp", "chunk", "kind", "text")
    t = t.mapInArrow(tokens, "doc long, grp long, chunk int, kind int, tokens binary")
    return t.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "kind", "doc").mapInArrow(run, "a long, b long")


def _chunked(members: DataFrame) -> DataFrame:
    """(doc, grp) plus chunk and the group's number of chunks."""
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    m = members.join(sizes, "grp").withColumn("chunks", F.ceil(F.col("size") / STAR).cast("int"))
    return m.withColumn("chunk", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))


def compare_bucket(docs: list[int], groups: list[int], side: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the groups of a bucket.  With two sides only documents of
    different sides are compared.  Rows come ordered by (side, group)."""
    root = list(range(len(docs)))
    blocks, lows = [], []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[int, int] = {}
    for i, g in enumerate(groups):
        root[i] = find(first.setdefault(g, i))
        if not i or (side[i], g) != (side[i - 1], groups[i - 1]):
            lows.append(i)
    blocks = list(zip(lows, [*lows[1:], len(docs)]))
    sizes = np.array([t.size for t in sets])
    words, place = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    # The matrix: each group's union as a run of token numbers.
    unions = [np.unique(place[ends[lo] : ends[hi]]) if hi - lo > 1 else place[ends[lo] : ends[hi]] for lo, hi in blocks]
    flat = np.concatenate(unions)
    starts = np.concatenate(([0], np.cumsum([u.size for u in unions])))
    least = np.array([int(sizes[lo:hi].min()) for lo, hi in blocks])
    two = side[0] != side[-1]
    turn = next((k for k, (lo, _) in enumerate(blocks) if side[lo] != side[0]), len(blocks))
    flag, out = np.zeros(words.size, np.int64), []
    for k, (lo, hi) in enumerate(blocks[:turn] if two else blocks):
        after = max(k + 1, turn) if two else k + 1
        if after >= len(blocks):
            break
        for i in range(lo, hi):
            mine = place[ends[i] : ends[i + 1]]
            flag[mine] = 1
            n = int(sizes[i])
            shared = np.add.reduceat(flag[flat[starts[after] :]], starts[after:-1] - starts[after])
            # J >= num/den needs an overlap of num (n + n') / (num + den) at least.
            open_ = np.flatnonzero((num + den) * shared >= num * (n + np.maximum(least[after:], -(-n * num // den))))
            for b in (open_ + after).tolist():
                x, y = blocks[b]
                if find(i) == find(x):
                    continue
                both = np.add.reduceat(flag[place[ends[x] : ends[y]]], ends[x:y] - ends[x])
                hit = np.flatnonzero(den * both >= num * (n + sizes[x:y] - both))
                if hit.size:  # one link joins the groups; a group's members are linked already
                    j = x + int(hit[0])
                    out.append((docs[i], docs[j]))
                    root[find(i)] = find(x)
            flag[mine] = 0
    return out


def foreign_buckets(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, at): members (side 0) of groups that documents of others (side 1)
    share a segment with, cut into chunks that meet all these documents."""
    there = placed.select("key", F.col("grp").alias("other")).distinct()
    asking = placed.join(there, "key").where("other < grp").select("doc", "grp", "other").distinct()
    asking = materialize(asking, "ngram-asking")
    wanted = asking.select(F.col("other").alias("grp")).distinct()
    members = groups.join(wanted, "grp", "left_semi")
    sizes = members.groupBy(F.col("grp").alias("g")).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    members = members.join(sizes, F.col("grp") == F.col("g")).withColumn("i", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))
    meeting = F.lit(-1).alias("j")
    asking = asking.join(sizes, F.col("other") == F.col("g")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return members.select("doc", F.struct(F.col("grp").alias("key"), "i", meeting, "grp", F.lit(0).alias("side")).alias("at")).unionByName(
        asking.select("doc", F.struct(F.col("other").alias("key"), "i", meeting, "grp", F.lit(1).alias("side")).alias("at")))


def segment_buckets(placed: DataFrame) -> DataFrame:
    """(doc, at): the holders of a segment.  Parts i <= j meet in one task:
    within a part, or one part against the other."""
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    p = placed.join(sizes, "key").withColumn("parts", F.ceil(F.col("size") / CHUNK).cast("int"))
    p = p.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    p = p.select("key", "doc", "grp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return p.select("doc", F.struct("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "grp", F.when(F.col("part") > F.col("other"), 1).otherwise(0).alias("side")).alias("at"))


def open_buckets(docs: DataFrame, dealt: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Links (a, b) between documents of different groups that meet in a bucket.
    ``dealt`` holds (doc, at); a document's tokens are made once and then dealt."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = [shingles(t, words).tobytes() for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("at"), pa.array(sets, pa.binary())], names=["doc", "at", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["key", "i", "j"]):
            held = [t.column(c).to_pylist() for c in ("doc", "grp", "side", "tokens")]
            links = compare_bucket(*held[:3], [np.frombuffer(x, np.uint64) for x in held[3]], num, den)
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    wanted = dealt.groupBy("doc").agg(F.collect_list("at").alias("at"))
    t = docs.select(F.col("doc_id").alias("doc"), "text").join(wanted.hint("merge"), "doc").select("doc", "at", "text")
    schema = t.select("doc", "at", F.lit(b"").alias("tokens")).schema
    t = t.mapInArrow(tokens, schema).select("doc", "tokens", F.explode("at").alias("at")).select("at.*", "doc", "tokens")
    t = t.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "grp", "doc")
    return t.mapInArrow(run, "a long, b long")


def link_representatives(docs: DataFrame, reps: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Links (a, b) that connect the representatives (column ``doc``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = _keys(docs, words, num, den).join(reps.hint("merge"), "doc", "left_semi").select("doc", "need", F.explode("keys").alias("key"))
    held = Window.partitionBy("key")
    first, last = F.min("doc").over(held), F.max("doc").over(held)
    keyed = keyed.withColumn("holders", F.count(F.lit(1)).over(held)).withColumn("lo", first).withColumn("hi", last).where("lo <> hi")
    # Prefix filter: a set that shares `need` segments with any partner still
    # shares one when it leaves out its need - 1 most widely held ones.
    common = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("holders"), "key"))
    keyed = keyed.select("doc", "need", "key", "holders").withColumn("at", common).where("at >= need").select("key", "doc")
    shared = keyed.withColumn("leader", first).withColumn("last", last)
    shared = materialize(shared.where("leader <> last").select("key", "doc", "leader"), "ngram-shared")

    # Every holder of a segment against the smallest one.
    stars = materialize(shared.where("doc <> leader").select(F.col("leader").alias("grp"), "doc").distinct(), "ngram-stars")
    stars = _chunked(stars)
    leaders = stars.groupBy("grp").agg(F.max("chunks").alias("chunks")).select(F.col("grp").alias("doc"), "grp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("kind"))
    roles = leaders.unionByName(stars.select("doc", "grp", "chunk", F.lit(1).alias("kind")))
    links = materialize(open_stars(docs, roles, words, num, den), "ngram-links")

    # Groups of what linked; keys whose holders lie in several groups.
    holders = shared.select(F.col("doc").alias("node")).distinct()
    groups = materialize(components(holders, links).select(F.col("node").alias("doc"), F.col("component").alias("grp")), "ngram-groups")
    placed = shared.select("key", "doc").join(groups, "doc")
    # A key's number of groups, without gathering them: the distinct pairs.
    spread = placed.select("key", "grp").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1")
    placed = materialize(placed.join(spread, "key").select("key", "doc", "grp", "groups"), "ngram-placed")
    few, many = (placed.where(c).drop("groups") for c in (F.col("groups") <= FEW, F.col("groups") > FEW))
    dealt = foreign_buckets(few, groups).unionByName(segment_buckets(many))
    return links.unionByName(materialize(open_buckets(docs, dealt, words, num, den), "ngram-links"))


def jaccard_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document row."""
    docs = docs.select("doc_id", "text")
    sets = materialize(signatures(docs, words), "ngram-sets")
    classes = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").cast("long").alias("rep"))
    classes = materialize(classes, "ngram-classes")
    reps = classes.where("rep is not null").select(F.col("rep").alias("doc"))
    links = link_representatives(docs, reps, words, num, den)
    found = components(reps.select(F.col("doc").alias("node")).distinct(), links)
    placed = classes.join(found, classes.rep == found.node).select(F.col("sig").alias("s"), "component")
    out = sets.join(placed, F.col("sig") == F.col("s"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.col("doc_id").cast("long")).alias("component_id"))
