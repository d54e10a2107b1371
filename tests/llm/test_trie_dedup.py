"""Exact dedup against brute force, with spills and odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from orchard.llm import trie_dedup
from orchard.llm.trie_dedup import Trie

SCHEMA = "doc_id long, text string, n string, rows string, owner string, h string, t string, meet string, digest string"


def brute(rows, largest):
    ids, pick = {}, max if largest else min
    for i, t in rows:
        ids.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        group = ids[t or ""]
        known = [x for x in group if x is not None]
        keep = pick(known) if known else None
        out.append((i, keep, len(group), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def cases(seed=1):
    rnd = random.Random(seed)
    hot = "shared prefix " * 40
    rows = [(i, hot + rnd.choice("abc")) for i in range(400)]  # a third of all rows, three texts
    rows += [(400 + i, "".join(rnd.choices("aé \n", k=rnd.randint(0, 4)))) for i in range(300)]
    rows += [(700 + i, hot[: rnd.randint(0, len(hot))]) for i in range(300)]
    rows += [(1001, "x" * 300_000), (1002, "x" * 300_000), (1003, "x" * 299_999 + "y"), (1004, None), (1005, ""), (1006, None)]
    rows += [(5, hot + "a"), (5, hot + "a"), (None, "no id"), (None, "no id"), (None, hot + "b"), (-7, "no id twice"), (None, "no id twice")]
    rnd.shuffle(rows)
    return rows


def test_trie_equals_a_dictionary():
    rnd = random.Random(3)
    for largest in (True, False):
        trie, want = Trie(largest), {}
        for i in range(3000):
            s = bytes(rnd.choices(b"ab\x00", k=rnd.randint(0, 9)))
            trie.insert(s, i if i % 7 else None, 2)
            owner, rows = want.get(s, (None, 0))
            if i % 7:
                owner = i if owner is None else (max if largest else min)(owner, i)
            want[s] = owner, rows + 2
        got = list(trie.terminals())
        assert {t: (o, n) for t, o, n in got} == want and len(got) == len(want)
        held = trie.bytes
        out = []
        while trie.bytes:
            out += list(trie.spill())
        out += list(trie.terminals())
        assert held > 0 and {t: (o, n) for t, o, n in out} == want and len(out) == len(want)


@pytest.mark.parametrize("limit,share", [(64 << 20, 1000), (2000, 1000), (1, 2)])
@pytest.mark.parametrize("largest", [True, False])
def test_equals_brute_force(spark, monkeypatch, limit, share, largest):
    monkeypatch.setattr(trie_dedup, "LIMIT", limit)
    monkeypatch.setattr(trie_dedup, "HOT_SHARE", share)
    rows = cases()
    docs = spark.createDataFrame([(i, t, *["clash"] * 7) for i, t in rows], SCHEMA).repartition(5)
    got = trie_dedup.exact_dedup(docs, largest=largest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, largest)


def test_equal_hashes_do_not_make_equal_texts(spark, monkeypatch):
    monkeypatch.setattr(trie_dedup.F, "xxhash64", lambda *a: F.lit(1).cast("long"))
    rows = [(i, "ab" if i % 3 else "ba") for i in range(50)]
    got = trie_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, False)


def test_empty_table(spark):
    assert trie_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
