"""Cross-tokenizer alignment against brute force."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from orchard.llm import token_align
from orchard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "<|endoftext|> and </s> <s> <unk> [PAD]", "x" * 30_000, "naïve café — 数学 и 🙂🙂🏽 ‍﻿", "a\x00b", "tab\tnew\nline  two   spaces ", "▁mark", "é" * 500, "0" * 4000, "ab" * 3001, "🙂" * 700]


def tokens(text):
    """[(id, bytes)] of both sides, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(tokens, "a"):
        tokens.a = Tokenizer.from_file(A)
        tokens.a.encode_special_tokens = True
        tokens.b = sentencepiece.SentencePieceProcessor(model_file=B)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        tokens.back = {chr(c): c for c in kept} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in kept)}
    a = [(i, bytes(tokens.back[c] for c in tokens.a.id_to_token(i))) for i in tokens.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in tokens.b.encode(text):
        p = tokens.b.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()))
    return a, b


def groups_of(text):
    if not text:
        return []
    a, b = tokens(text)
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    out, i, j, ea, eb = [], 0, 0, 0, 0
    group = ([], [])
    while i < len(a) or j < len(b):
        if ea <= eb:
            group[0].append(a[i][0])
            ea += len(a[i][1])
            i += 1
        else:
            group[1].append(b[j][0])
            eb += len(b[j][1])
            j += 1
        if ea == eb:
            out.append(group)
            group = ([], [])
    return out


def brute(rows):
    all_groups = [groups_of(t) for _, t in rows]
    links = []
    for gs in all_groups:
        c = collections.Counter()
        for x, y in gs:
            for i, m in collections.Counter(x).items():
                for j, k in collections.Counter(y).items():
                    c[i, j] += m * k
        links.append(c)
    count = collections.Counter(p for c in links for p in c)
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for (doc, _), gs, c in zip(rows, all_groups, links):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((doc, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), sum(c.values()), sum(m for p, m in c.items() if count[p] == top[p[0]]), sum(m * count[p] for p, m in c.items()), hashlib.sha256(said.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("links,large,head,flush,rows_at_once", [(1 << 21, 4096, 1 << 19, 1 << 21, 128), (50, 3, 40, 100, 3), (7, 1 << 30, 1, 10, 1)])
def test_equals_brute_force(spark, monkeypatch, links, large, head, flush, rows_at_once):
    for name, value in (("LINKS", links), ("LARGE", large), ("HEAD", head), ("FLUSH", flush), ("ROWS", rows_at_once), ("BYTES", 5000)):
        monkeypatch.setattr(token_align, name, value)
    rnd = random.Random(4)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += [(10_000 + i, t if t is None or large < 1 << 30 else t[:900]) for i, t in enumerate(ODD)]
    rows += [(20_000 + i, "".join(rnd.choices("ab 1é\n🙂▁", k=rnd.randint(1, 40)))) for i in range(60)]
    rows += [(None, "no id"), (7, "same id"), (7, "same id")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, row string, pairs string").repartition(4)
    got = token_align.link_report(docs, A, B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_token_ends_that_never_meet():
    """One group of long sides goes by distinct ids; the numbers stay exact."""
    tok = token_align.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    a1, a2, a8 = (tok.a_bytes.index(b"=" * n) for n in (1, 2, 8))
    b1, b2 = (tok.b_bytes.index(b"=" * n) for n in (1, 2))
    n, width = 3000, len(tok.b_bytes)
    # Meet every eight bytes; no tokens; meet at the very end only.
    x = token_align.Aligned(tok, [[a8] * 700, [], [a1, *[a2] * n, a1]], [[b1] * 5600, [], [b2] * (n + 1)])
    pairs, times, bounds = x.pairs()
    assert x.n_groups.tolist() == [700, 0, 1] and x.n_links.tolist() == [5600, 0, (n + 2) * (n + 1)]
    assert bounds.tolist() == [0, 1, 1, 3] and dict(zip(pairs.tolist()[1:], times.tolist()[1:])) == {a1 * width + b2: 2 * (n + 1), a2 * width + b2: n * (n + 1)}
    assert (pairs[0], times[0]) == (a8 * width + b1, 5600)


def test_empty_table_and_query_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.link_report(none, A, B).count() == 0
    got = QUERIES["op11_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.all([r["n_best"] <= r["n_links"] <= r["count_sum"] for r in got.collect()])
