"""Ranked lexical search against brute force and SQL."""

import collections
import math
import os
import random
import re
import sys

import numpy as np
import pytest

from orchard.llm import bloom_search
from orchard.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    tfs = [(i, collections.Counter(terms(t))) for i, t in docs]
    tfs = [(i, c, sum(c.values())) for i, c in tfs if c]
    n, total = len(tfs), sum(s for _, _, s in tfs)
    df = collections.Counter(w for _, c, _ in tfs for w in c)
    asked = {}
    for k, t in items:
        if t is not None:
            asked.setdefault(k, set()).update(terms(t))
    out = []
    for k, words in asked.items():
        found = []
        for i, c, s in tfs:
            m = 100 - 50 + ((50 * s * n) // total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if w in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        found = sorted(found)[:top]
        out += [(k, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(found)]
    return sorted(out, key=str)


def corpus(seed=2):
    rnd = random.Random(seed)
    vocab = [f"w{int(rnd.paretovariate(0.7)) % 400}" for _ in range(2000)] + ["Été", "naïve", "数学", "O'Neil", "a1-b2", "x_y", "[z]"]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([1, 3, 8, 40, 200])))) for i in range(500)]
    docs += [(500 + i, "copy of w1 w2 w3 w4 in a third of all rows") for i in range(250)]
    docs += [(1000, None), (1001, ""), (1002, " .,;\x7f\x00"), (1003, "w1 " * 5000), (1004, " ".join(f"u{k}" for k in range(20_000)) + " w7 w8"), (1005, "q" * 100_000), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (3, "w9 w9"), (3, "w9 w9"), (-5, "w9 w9 Z")]
    rnd.shuffle(docs)
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 30)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "nowhere at all zzz"), (103, "w1"), (104, "W1 w1 W2"), (7, "w9 more"), (None, "w5 w6"), (105, "copy of w1"), (106, "u5 w7 q"), (107, "w " * 100)]
    return docs, items


@pytest.mark.parametrize("block,pilot,items_at_once,bits", [(256, 32, 1024, 10), (8, 2, 7, 10), (16, 10**9, 1024, 1)])
def test_equals_brute_force(spark, monkeypatch, block, pilot, items_at_once, bits):
    for name, value in (("BLOCK", block), ("PILOT", pilot), ("ITEMS", items_at_once), ("BITS_PER_ENTRY", bits), ("FLUSH", 50)):
        monkeypatch.setattr(bloom_search, name, value)
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], "doc_id long, text string, term string, part string, bits string").repartition(4)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in bloom_search.search(d, q).collect()), key=str)
    assert got == brute(docs, items)


def test_signatures_exclude_documents():
    """Bounds are never below the score, and most documents are not opened."""
    docs, items = corpus(5)
    docs = [(i, t.encode()) for i, t in docs if t and terms(t)]
    counted = [collections.Counter(bloom_search.terms_of(t)) for _, t in docs]
    n, total = len(docs), sum(sum(c.values()) for c in counted)
    df = collections.Counter(w for c in counted for w in c)
    weights = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for w, d in df.items()}
    query = bloom_search.Query([(k, sorted({w.encode() for w in terms(t)})) for k, t in items if t], weights, n, total)
    search = bloom_search.Searcher(query, 5, [0] * len(query.items))
    blocks = {}
    for (i, t), c in zip(docs, counted):
        keys = bloom_search.level_keys(bloom_search._hashes(list(c), {}), np.array(list(c.values())))
        slices = bloom_search.BITS_PER_ENTRY << max(4, (keys.size - 1).bit_length())
        blocks.setdefault(slices, (bloom_search.Open(slices), []))[0].add(i, sum(c.values()), t, keys)
        blocks[slices][1].append(c)
    opened = pairs = 0
    for slices, (block, held) in blocks.items():
        m = query.lengths(block.sizes)
        bits = np.frombuffer(block.row(0)[4], np.uint8).reshape(slices, -1)
        most = search.bounds(slices, bits, np.array(m))
        for d, c in enumerate(held):
            exact = np.array([bloom_search.add(c[w], m[d]) if c[w] else 0 for w in query.terms])
            assert (most[:, d] >= exact).all()
            assert ((most[:, d] > 0) & (exact == 0)).mean() < 0.05  # false positives
        for _, at, w in query.items:
            bound = w @ most[at]
            least = sorted(bound)[-5] if bound.size > 5 else 1
            opened, pairs = opened + int((bound >= max(1, least)).sum()), pairs + bound.size
    assert opened < 0.5 * pairs


def test_query_equals_sql(spark):
    got = QUERIES["op13_lexical_search"](spark, SF)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert compare(got.toPandas(), duck(SF).sql(ORACLE["op13_lexical_search"]).df()) is None


def test_empty_tables(spark):
    d, q = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert bloom_search.search(d, q).count() == 0
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert bloom_search.search(d, q.limit(0)).count() == 0
    assert [tuple(r) for r in bloom_search.search(d, q).collect()] == [(1, 1, 1, r) for r in [math.floor(1000 * math.log(4 / 3)) * (10**9 // (1000 + 20 * 100))]]
