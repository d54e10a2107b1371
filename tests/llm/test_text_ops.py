"""Text operators against brute force on the small tables and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.llm import bpe, hmm_lm, langid, mixing, ngram_join, pii, suffix_dedup
from orchard.llm.queries import QUERIES, vocabulary_path

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("size", T.StringType()), T.StructField("h", T.StringType()), T.StructField("keys", T.StringType())])
ODD = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "b", "x", "x", "x"), (1, "one two three four five six seven eight nine ten eleven", "en", "b", "x", "x", "x"),
    (2, "one two three four five six seven eight nine ten eleven", "en", None, "x", "x", "x"), (3, None, None, "a", None, None, None), (4, "", "en", "a", "", "", ""), (5, " \t\n\x0b\x0c\r", "de", "a", "x", "x", "x"),
    (6, "word " * 20000, "fr", "c", "x", "x", "x"), (7, "x" * 60000, "de", "c", "x", "x", "x"), (8, "12 34 !!", "es", "c", "x", "x", "x"), (9, "solo", "en", None, "x", "x", "x"), (None, "text without an id", "en", "a", "x", "x", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


# --- personal data


def base_spans(text):
    def luhn(d):
        return sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0

    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": all(int(x) < 256 for x in m.group().split(".")) if kind == "ip" else True, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def check_pii(spark, pairs):
    frame = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in pairs])
    got = {r["doc_id"]: r for r in pii.report(frame).collect()}
    assert len(got) == len(pairs)
    for i, t in pairs:
        want = base_spans(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (i, t[:80], want)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(got[i]["spans"].split(","))
    return got


def test_pii_base_spans(spark, rows):
    rnd = random.Random(3)
    noise = [(100_000 + i, "".join(rnd.choice("0123456789 -.+()@a%é🙂bZ0123456789.@+") for _ in range(rnd.randint(0, 200)))) for i in range(300)]
    long = [(200_001, "1" * 30000), (200_002, "a" * 30000 + "@b.c" + ".d" * 9000), (200_003, "4" + " 1" * 9000), (200_004, "1.1." * 5000), (200_005, "")]
    check_pii(spark, rows + noise + long)


def test_pii_adds_wide_forms_and_redacts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000").select("doc_id", "text")
    more = spark.createDataFrame([(900_001, "pay 4516.7448.5457.4821 ok"), (900_002, "on 2024-01-02 we had 12345.678 and 2024 2025"), (900_003, "mail a.b@c.de or +1 (017) 555-7713 now 1.2.3.4")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(docs.unionByName(more)).where("doc_id >= 900000").collect()}
    assert got[900_001]["spans"] == "card:4:23" and got[900_001]["n_card"] == 0
    assert got[900_002]["spans"] == ""
    told = {r["doc_id"]: r["text"] for r in pii.redact(docs.unionByName(more)).where("doc_id >= 900000").collect()}
    assert told[900_003] == "mail [EMAIL] or [PHONE] now [IP]" and "2024-01-02" in told[900_002]


def test_pii_learns_from_every_candidate(spark, monkeypatch):
    """More base candidates than the 20,000 that training once stopped at: all
    of them and their rewritten copies train or calibrate."""
    kept = []
    own = pii.materialize
    monkeypatch.setattr(pii, "materialize", lambda df, name: kept.append((name, own(df, name))) or kept[-1][1])
    good, bad = F.concat_ws(".", F.lit("10.1"), F.col("id") % 200, F.col("id") % 251), F.concat_ws(".", F.lit("999.1"), F.col("id") % 200, F.col("id") % 251)
    docs = spark.range(24000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host "), F.when(F.col("id") % 3 == 0, bad).otherwise(good), F.lit(" up")).alias("text"))
    assert pii._fit(pii.candidates(docs)) is not None
    rows = dict(kept)["pii-train"].where("kind = 'ip'")
    assert rows.where("label = 1").count() == 2 * 16000 and rows.where("label = 0").count() == 16000 + 8000


def test_pii_odd_rows(spark, odd, empty):
    assert odd.count() == pii.report(odd).count() and pii.report(empty).count() == 0
    assert pii.redact(odd).columns == odd.columns


# --- language ID


def test_language_id_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op2_language_id"](spark, sf).join(truth, "doc_id").toPandas()
    held = out[out.held_out]
    assert len(out) == 1000 and len(held) > 100
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert out.score.between(0, 1).all() and not out.rejected.any()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))


def test_language_id_rejects_gibberish_and_an_unlearned_script(spark):
    rnd = random.Random(8)
    alphabets = {"latin": "abcdefghijklmnopqrstuvwxyz", "script": "".join(map(chr, range(0x430, 0x450)))}
    planted = [(-1 - k, " ".join("".join(rnd.choice(letters) for _ in range(6)) for _ in range(words))) for k, (letters, words) in enumerate((a, n) for a in alphabets.values() for n in (2, 4, 9, 35, 120, 500, 3500))]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    got = langid.predict(docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string")), model, ["doc_id"]).collect()
    assert {r["doc_id"] for r in got if r["__rejected"]} == {i for i, _ in planted}
    # a labelled row that is none of its language does not open its length class
    odd_row = spark.createDataFrame([(2_000_000, planted[3][1], "en")], docs.schema)
    assert langid.rejection_floors(docs.unionByName(odd_row), model).min() > 0.2


def test_language_id_odd_rows(odd, empty):
    got = langid.identify(odd, F.lit(False), ["doc_id"]).collect()
    assert len(got) == len(ODD)
    assert {r["__lang"] for r in got if r["doc_id"] in (3, 4, 5, 8)} == {"und"}
    assert all(r["__lang"] in ("en", "de", "fr") for r in got if r["doc_id"] in (1, 2, 6, 7, 9, None))
    assert langid.identify(empty, F.lit(False), ["doc_id"]).count() == 0
    assert {r["__lang"] for r in langid.identify(odd, F.lit(True), ["doc_id"]).collect()} == {"und"}


# --- BPE


def test_bpe_equals_the_library(rows):
    from tokenizers import Tokenizer

    path = vocabulary_path()
    theirs, ours = Tokenizer.from_file(path), bpe.Bpe(open(path, encoding="utf-8").read())
    rnd = random.Random(1)
    marks = [chr(i) for i in range(0x250)] + ["'s", "'ll", "<|endoftext|>", "<|startoftext|>", "  ", "\n", "Σ", "ς", "漢", "é", "🙂", "½", " ", "‍", "İ", "K"]
    noise = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["a" * 5000, "ab" * 3000 + "é" * 999, "", "   "]
    for text in [t for _, t in rows] + noise:
        want = theirs.encode(text, add_special_tokens=False).ids
        got = ours.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text[:60]
        assert ours.decode(got) == theirs.decode(want, skip_special_tokens=False)


def test_bpe_characters_beside_letters_and_marks():
    """Every character that is split here, and some beyond, against the library."""
    from tokenizers import Tokenizer

    path = vocabulary_path()
    theirs, ours = Tokenizer.from_file(path), bpe.Bpe(open(path, encoding="utf-8").read())
    for c in [*map(chr, range(0x260)), "\u0307", "\u2c65", "\u3000", "漢"]:
        text = f"{c} {c}a a{c} a{c}b, {c}. 'a{c}'s a{c}'.. 7{c} a_{c}_ A{c}{c}! {c}'ll'{c}"
        for _ in range(2):  # the second time from the tables
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(c)


def test_bpe_of_another_split_and_without_a_suffix():
    import json

    from tokenizers import Tokenizer

    spec = json.loads(open(vocabulary_path(), encoding="utf-8").read())
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    split["pattern"]["Regex"] = r"[\p{L}\p{N}]+'?|[^\s\p{L}\p{N}]+"
    texts = ["it's the 2024 o'clock'' news, x7. don't--7th", "aaaa", ""]
    for suffix in (spec["model"]["end_of_word_suffix"], None):
        spec["model"]["end_of_word_suffix"] = suffix
        theirs, ours = Tokenizer.from_str(json.dumps(spec)), bpe.Bpe(json.dumps(spec))
        for text in texts * 2:
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_bpe_keeps_words_in_use_when_its_tables_turn_over(monkeypatch):
    """Words that texts use again and again are merged once, whatever marks
    follow them and however many rare words pass through the tables."""
    for name in ("WORDS_KEPT", "CHUNKS_KEPT"):
        monkeypatch.setattr(bpe, name, 40, raising=False)
    coder, merged = bpe.Bpe(open(vocabulary_path(), encoding="utf-8").read()), []
    merge = coder.merge
    coder.merge = lambda word: merged.append(word) or merge(word)
    rare = [chr(97 + i // 26) + chr(97 + i % 26) + "q" for i in range(26 * 26)]
    first = coder.encode("orchard apple")
    for i, word in enumerate(rare):
        assert coder.encode(f"orchard{',.;!'[i % 4]} apple {word}")[-4:] and coder.encode("orchard apple") == first
    assert merged.count("orchard") == merged.count("apple") == 1
    assert len(coder.known) <= 40 and len(coder.older) <= 40


def test_bpe_odd_rows(odd, empty):
    out = bpe.decode(bpe.encode(odd.select("doc_id", "text"), vocabulary_path()), vocabulary_path()).collect()
    assert len(out) == len(ODD) and all(len(r["ids"]) == 0 and r["decoded"] == "" for r in out if r["doc_id"] in (3, 4, 5))
    assert bpe.encode(empty, vocabulary_path()).count() == 0


# --- n-gram join


def brute_components(pairs):
    sets = {}
    for i, t in pairs:
        w = words(t)
        sets[i] = {" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))} if w else set()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    by = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for x in s for j in by[x] if j < i).items():
            if 100 * n >= 90 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def variants():
    """Chains of texts whose neighbours link but whose ends do not."""
    rnd = random.Random(9)
    out, i = [], 0
    for size in (9, 12, 20, 45, 120, 400):
        base = [f"w{rnd.randint(0, 9999)}" for _ in range(size)]
        for _ in range(25):
            out.append((i, " ".join(base)))
            base = list(base)
            base[rnd.randrange(size)] = f"v{rnd.randint(0, 9999)}"
            i += 1
    passage = " ".join(f"p{k}" for k in range(60))
    out += [(1000 + k, passage + " " + " ".join(f"q{rnd.randint(0, 99999)}" for _ in range(rnd.randint(0, 40)))) for k in range(80)]
    return out


def test_ngram_join_equals_brute_force(spark, rows):
    pairs = rows + [(100_000 + i, t) for i, t in variants()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got == brute_components(pairs)


def test_ngram_join_chunks_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    pairs = variants()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got == brute_components(pairs)


def test_ngram_join_links_a_set_that_fills_one_segment(spark):
    # 10 shingles in one of the 3 segments, and the same with one more elsewhere: J = 10/11
    bounds = ngram_join._bounds()
    k = bounds.index(9)

    def segment(w):
        return int(ngram_join.mix64(ngram_join.shingles(" ".join(w[-3:])) ^ np.uint64(0xA5A5 + k))[0] % np.uint64(3))

    a = ["w0", "w1"]
    while len(a) < 12:
        a.append(next(x for x in (f"x{len(a)}n{i}" for i in range(1000)) if segment([*a, x]) == 0))
    b = [*a, next(x for x in (f"y{i}" for i in range(1000)) if segment([*a, x]) != 0)]
    pairs = [(1, " ".join(a)), (2, " ".join(b)), (3, "nothing of the kind")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    assert got == brute_components(pairs) == {1: (10, 1), 2: (11, 1), 3: (2, 3)}


def test_ngram_join_odd_rows(odd, empty):
    got = ngram_join.jaccard_components(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and by[3]["n_shingles"] == 0 and by[9]["n_shingles"] == 1 and by[4]["component_id"] == 4
    assert ngram_join.jaccard_components(empty).count() == 0


# --- language model


def test_lm_counts_and_base_score(spark, rows):
    got = {r["doc_id"]: r for r in QUERIES["op8_lm_scoring"](spark, SF).collect()}
    tokens = {i: t.encode().lower().split() + [b""] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())


def test_lm_tail_join_gives_the_same_as_the_head(spark, docs, monkeypatch):
    sample = docs.where("doc_id < 40")
    held = F.lit(False)
    monkeypatch.setattr(hmm_lm, "OWN", 50)
    whole = {r["doc_id"]: r for r in hmm_lm.score(sample, held).collect()}
    monkeypatch.setattr(hmm_lm, "HEAD", 600)
    joined = {r["doc_id"]: r for r in hmm_lm.score(sample, held).collect()}
    for i, r in whole.items():
        assert r["n_known"] == joined[i]["n_known"]
        assert math.isclose(r["base_score"], joined[i]["base_score"], rel_tol=1e-9) and math.isclose(r["score"], joined[i]["score"], rel_tol=1e-9)


def slow_forward(m, line):
    a, total = m["start"].copy(), 0.0
    for c in line:
        a = (a @ m["A"]) * m["B"][:, c]
        total += math.log(a.sum())
        a /= a.sum()
    return total


@pytest.mark.parametrize("block", [1024, 64, 3])
def test_lm_forward_is_exact(monkeypatch, block):
    monkeypatch.setattr(hmm_lm, "BLOCK", block)
    rng = np.random.default_rng(1)
    m = hmm_lm._initial(rng.random(hmm_lm.CLASSES))
    lines = [rng.integers(0, hmm_lm.CLASSES, n).astype(np.int16) for n in (1, 5, 64, 65, 200, 3000, 0)]
    for x, got in zip(lines, hmm_lm.log_likelihood(hmm_lm.Segments(lines), m)):
        assert math.isclose(slow_forward(m, x), got, rel_tol=1e-9, abs_tol=1e-12)


def empty_sums():
    return {"A": np.zeros((hmm_lm.STATES, hmm_lm.STATES)), "B": np.zeros((hmm_lm.STATES, hmm_lm.CLASSES)), "start": np.zeros(hmm_lm.STATES), "ll": np.zeros(1)}


@pytest.mark.parametrize("block,real", [(1024, np.float64), (2, np.float64), (1024, np.float32), (2, np.float32)])
def test_lm_expected_counts_equal_a_sum_over_all_paths(monkeypatch, block, real):
    """Baum-Welch sums against every state path of short texts."""
    import itertools

    monkeypatch.setattr(hmm_lm, "BLOCK", block)
    monkeypatch.setattr(hmm_lm, "REAL", real)
    rng = np.random.default_rng(2)
    m = hmm_lm._initial(rng.random(hmm_lm.CLASSES))
    m["A"] = rng.dirichlet(np.ones(hmm_lm.STATES), hmm_lm.STATES)
    lines = [rng.integers(0, 6, n).astype(np.int16) for n in (1, 2, 5, 4)]
    want = empty_sums()
    for line in lines:
        paths = list(itertools.product(range(hmm_lm.STATES), repeat=line.size + 1))
        weights = np.array([m["start"][p[0]] * np.prod([m["A"][x, y] * m["B"][y, c] for x, y, c in zip(p, p[1:], line)]) for p in paths])
        want["ll"] += math.log(weights.sum())
        for p, w in zip(paths, weights / weights.sum()):
            want["start"][p[0]] += w
            for x, y, c in zip(p, p[1:], line):
                want["A"][x, y] += w
                want["B"][y, c] += w
    got = empty_sums()
    hmm_lm.expected(hmm_lm.Segments(lines), m, got)
    for k in want:
        assert np.allclose(got[k], want[k], rtol=1e-9 if real == np.float64 else 1e-5, atol=1e-12 if real == np.float64 else 1e-6), k


def test_lm_training_rises_and_beats_one_state(spark, docs, monkeypatch):
    """Each round's likelihood is above the last one's; held-out texts score
    better than under class frequencies alone, by one in a hundred at least."""
    monkeypatch.setattr(hmm_lm, "OWN", 300)
    monkeypatch.setattr(hmm_lm, "SHARED", 100)
    monkeypatch.setattr(hmm_lm, "CLASSES", 401)
    rows = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    counts = collections.Counter(w for t in rows for w in hmm_lm.words(t))
    own = {w: 1 + i for i, (w, _) in enumerate(counts.most_common(300))}
    lines = [np.array([own.get(w) or hmm_lm.shared_class(w) for w in hmm_lm.words(t)] + [0], np.int16) for t in rows]
    learn, kept = [x for i, x in enumerate(lines) if i % 5], [x for i, x in enumerate(lines) if not i % 5]
    seen = np.bincount(np.concatenate(learn), minlength=401).astype(float)
    encoded = spark.createDataFrame([(bytearray(x.tobytes()),) for x in learn], "classes binary").repartition(3)
    model, lls = hmm_lm.train(encoded, seen)
    assert 3 <= len(lls) <= hmm_lm.MOST_ROUNDS and all(b > a for a, b in zip(lls, lls[1:]))
    whole = sum(slow_forward(model, x) for x in kept)
    share = np.log((seen + 0.1) / (seen + 0.1).sum())
    assert whole > 0.99 * sum(float(share[x].sum()) for x in kept)


def test_lm_odd_rows(odd, empty):
    got = hmm_lm.score(odd, F.lit(False)).collect()
    assert len(got) == len(ODD) and all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (3, 4, 5))
    assert all(math.isfinite(r["score"]) for r in got)
    assert hmm_lm.score(empty, F.lit(False)).count() == 0
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in hmm_lm.score(odd, F.lit(True)).collect())


# --- suffix dedup


def brute_cut(pairs):
    first, out = {}, {}
    for i, t in sorted(pairs):
        b = t.encode()
        off = np.zeros(len(b) + 1, int)
        all_ = [b[p : p + 50] for p in range(len(b) - 49)]
        for p, w in enumerate(all_):
            if first.get(w, i) < i:
                off[p] += 1
                off[p + 50] -= 1
        for w in all_:
            first.setdefault(w, i)
        gone = np.cumsum(off)[:-1] > 0
        out[i] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()), np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


def passages():
    rnd = random.Random(4)
    text = "".join(rnd.choice("ab ") for _ in range(4000))
    out = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            p, n = rnd.randrange(3800), rnd.choice([20, 49, 50, 51, 73, 74, 120])
            parts += [text[p : p + n], "".join(rnd.choice("cdé🙂") for _ in range(rnd.randint(0, 30)))]
        out.append((i, "".join(parts)))
    return out + [(60, "a" * 3000), (61, "a" * 2000 + "b"), (62, "a" * 49), (63, "ab" * 700), (64, "")]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_equals_brute_force(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    pairs = passages() + [(1000 + i, t) for i, t in rows]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.cut(docs, suffix_dedup.repeated_spans(docs)).collect()}
    assert got == brute_cut(pairs)


def test_suffix_dedup_deals_a_hot_window_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    rnd = random.Random(12)
    line = "permission is granted to use this text in any way, free of charge, to all who want it"
    pairs = [(i, "".join(rnd.choice("cdefg ") for _ in range(rnd.randint(0, 80))) + line) for i in range(400)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    held = collections.Counter()
    for r in suffix_dedup.coded_runs(docs, suffix_dedup.shared_kmers(docs), suffix_dedup.whole_copies(docs)).collect():
        for _, s, rows in suffix_dedup.decode_run(r["blob"]):
            held[r["bucket"], s] += len(rows)
    assert max(held.values()) < 100
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.cut(docs, suffix_dedup.repeated_spans(docs)).collect()}
    assert got == brute_cut(pairs)


def coded(rows, buckets=1):
    """Runs of (suffix, k-mer, document, place) rows by bucket, from unordered rows."""
    text = np.zeros((len(rows), suffix_dedup.WIDTH), np.uint8)
    for i, (t, *_) in enumerate(rows):
        text[i, : len(t)] = np.frombuffer(t, np.uint8)
    kmer, doc, place = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
    return dict(zip(*suffix_dedup.front_code(place % buckets, text, np.array([len(r[0]) for r in rows], np.int64), kmer, doc, place)))


def test_loser_tree_merges_sorted_runs():
    rnd = random.Random(2)
    runs = [[(bytes(rnd.choices(b"ab\x00", weights=[9, 9, 1], k=rnd.randint(50, 54))), 1, i, p) for p in range(rnd.randint(1, 80))] for i in range(5)]
    runs[0] += [(b"a" * 50 + b"\x00" * k, 1, 0, 100 + k) for k in (3, 0, 2, 1)]  # a zero byte is not the end
    merged = list(suffix_dedup.merge_runs([suffix_dedup.decode_run(coded(r)[0]) for r in runs]))
    want = collections.defaultdict(list)
    for s, *held in sorted(x for r in runs for x in r):
        want[s].append(tuple(held))
    assert [s for s, _ in merged] == sorted(want)
    assert {s: sorted(h) for s, h in merged} == {s: sorted(h) for s, h in want.items()}


def test_front_coded_runs_keep_every_row_of_their_bucket():
    rnd = random.Random(3)
    rows = [(bytes(rnd.choices(b"abc", k=rnd.randint(50, 76))), rnd.randrange(-(2**60), 2**60), rnd.randrange(2**40), p) for p in range(500)]
    rows += [(rows[p][0], 5, 6, 1000 + p) for p in range(0, 500, 3)]
    found = coded(rows, 7)
    assert sorted(found) == list(range(7))
    for bucket, blob in found.items():
        back = [(s, *h) for _, s, held in suffix_dedup.decode_run(blob) for h in held]
        assert [r[0] for r in back] == sorted(r[0] for r in back)
        assert sorted(back) == sorted(r for r in rows if r[3] % 7 == bucket)


def test_suffix_dedup_folds_whole_copies(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("ab cd") for _ in range(n)) for n in (30, 49, 50, 51, 200, 900)]
    pairs = [(100 - i, texts[i % 6]) for i in range(40)] + [(200, texts[4] + texts[5]), (3, texts[5][100:400])]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    copies = {r["doc_id"] for r in suffix_dedup.whole_copies(docs).collect()}
    assert copies == {i for i, t in pairs if len(t) >= 50 and any(j < i and u == t for j, u in pairs)}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.cut(docs, suffix_dedup.repeated_spans(docs)).collect()}
    assert got == brute_cut(pairs)
    # an id with two texts: each of its rows is cut by the spans of both
    twice = spark.createDataFrame([(1, texts[4]), (2, texts[4]), (2, texts[5])], "doc_id long, text string")
    cut = suffix_dedup.cut(twice, suffix_dedup.repeated_spans(twice)).where("doc_id = 2").collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in cut) == [(200, 200), (900, 200)]


def test_suffix_dedup_odd_rows(odd, empty):
    got = suffix_dedup.cut(odd, suffix_dedup.repeated_spans(odd)).collect()
    assert len(got) == len(ODD)
    assert [r["n_removed"] for r in got if r["doc_id"] == 2] == [r["n_bytes"] for r in got if r["doc_id"] == 2]
    assert suffix_dedup.cut(empty, suffix_dedup.repeated_spans(empty)).count() == 0


# --- mixing


def test_mixing_targets_and_quotas(spark):
    out = mixing.mix_sources(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    assert len(out) == 1000 and (out.taken <= 3 * out["size"]).all() and (out.taken >= 0).all()
    g = out.groupby("source").agg(size=("size", "sum"), whole=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (g["size"] == g.whole).all() and math.isclose(g.target.sum(), g.whole.sum(), rel_tol=1e-9)
    assert (abs(g.taken / g.target - 1) < 0.02).all()


def water(sizes, weights, ratio=3):
    """Targets by repeated resharing."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(ratio * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        target = [ratio * sizes[i] if i in capped else rest * weights[i] / w for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if target[i] > ratio * sizes[i] + 1e-9} - capped
        if not over:
            return target
        capped |= over


def test_mixing_caps_and_reshares(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "Z": 700, "é": 40, None: 3}
    names = sorted((k for k in sizes if k), key=lambda s: s.encode()) + [None]
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = water([sizes[n] for n in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    assert all(math.isclose(got[n], t, rel_tol=1e-9) for n, t in zip(names, want))


def test_sainte_lague_equals_sequential_awards(spark):
    rnd = random.Random(6)
    shares = [rnd.random() ** 4 * 50 + 0.01 for _ in range(40)]
    seats = 300
    scale = seats / sum(shares)
    frame = spark.createDataFrame([(i, x * scale) for i, x in enumerate(shares)], "u int, v double")
    got = {r["u"]: r["seats"] for r in mixing.sainte_lague(frame, [], F.col("v"), F.lit(seats), F.lit(10**9), [F.col("u")]).collect()}
    won = [0] * len(shares)
    for _ in range(seats):
        won[max(range(len(shares)), key=lambda i: (shares[i] / (2 * won[i] + 1), -i))] += 1
    assert got == dict(enumerate(won))


def test_mixing_reruns_agree_and_odd_rows(odd, empty):
    def once():
        return sorted(map(str, mixing.mix_sources(odd.repartition(3)).collect()))

    first = once()
    assert first == once() and len(first) == len(ODD)
    assert all(r["size"] == 0 and r["taken"] == 0 for r in mixing.mix_sources(odd).collect() if r["doc_id"] in (3, 4, 5))
    assert mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize("chunk,few", [(2048, 8), (16, 1), (16, 10**6)])
def test_near_copies_that_do_not_link(spark, monkeypatch, chunk, few):
    """Many copies of one text with changes of their own: most share segments
    and link with none, some link in chains."""
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "STAR", 8)
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    pairs = []
    for i in range(160):
        text = list(base)
        for _ in range(rnd.choice([1, 1, 3, 6, 9])):
            text[rnd.randrange(len(text))] = f"x{rnd.randrange(30)}"
        pairs.append((1000 - i, " ".join(text)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()}
    want = brute_components(pairs)
    assert got == want and 1 < len({c for _, c in want.values()}) < 160


def test_bucket_links_join_what_brute_force_joins():
    """One bucket of random groups: its links connect the same documents as all
    links between documents of different groups, within a part and across two."""
    rnd = random.Random(11)
    for case in range(60):
        n, two = rnd.randint(2, 25), case % 2
        sets = [np.unique(np.array(rnd.sample(range(14), rnd.randint(8, 13)), np.uint64)) for _ in range(n)]
        rows = sorted((rnd.randrange(2) if two else 0, rnd.randrange(6), i) for i in range(n))
        side, groups, docs = (list(x) for x in zip(*rows))
        if two and len(set(side)) < 2:
            continue
        held = [sets[i] for i in docs]

        def parts(links):
            root = {("g", g): ("g", g) for g in groups} | {("d", d): ("d", d) for d in docs}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for x, y in [(("d", d), ("g", g)) for d, g in zip(docs, groups)] + [(("d", a), ("d", b)) for a, b in links]:
                root[find(x)] = find(y)
            return [[find(("d", a)) == find(("d", b)) for a in docs] for b in docs]

        every = [(docs[i], docs[j]) for i in range(n) for j in range(i) if groups[i] != groups[j] and (not two or side[i] != side[j]) and 10 * (k := np.intersect1d(held[i], held[j]).size) >= 9 * (held[i].size + held[j].size - k)]
        links = ngram_join.compare_bucket(docs, groups, side, held, 9, 10)
        assert set(links) <= set(every) | {(b, a) for a, b in every} and len(links) < n
        assert parts(links) == parts(every)


def test_bpe_round_trip_equals_both_directions(odd, docs):
    for frame in (odd.select("doc_id", "text", "lang"), docs.select("doc_id", "text", "lang").limit(50)):
        one = bpe.round_trip(frame, vocabulary_path())
        two = bpe.decode(bpe.encode(frame, vocabulary_path()).drop("text"), vocabulary_path())
        assert one.columns == two.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
