"""Language ID against a plain version of its model and its decisions."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.llm import langid

SF = "/root/testdata/sf0.001"
M32 = (1 << 32) - 1


def places(text):
    """Counts of 1- to 3-grams by hashed place, and the number of letters."""
    out = [" "]
    for c in text + " ":
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out.append(c)
    f = [ord(c) for c in out]
    letters = sum(c != 32 for c in f)
    seen = collections.Counter()
    for i in range(len(f)):
        h = f[i] * 0x9E3779B1 & M32
        for n in range(3):
            if n:
                if i + n >= len(f):
                    break
                h = (h ^ (f[i + n] + n)) * (0x85EBCA77, 0xC2B2AE3D)[n - 1] & M32
            seen[((h ^ (h >> 15)) * 0x27D4EB2F & M32) >> (32 - langid.BITS)] += 1
    return (seen, letters) if letters else (collections.Counter(), 0)


@pytest.fixture(scope="module")
def case(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 120")
    odd = [(9001, None, "en"), (9002, "", "de"), (9003, "12 34 !!", "en"), (9004, "ÅÄÖ ß İstanbul", None), (9005, "Цифры и слова", None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).repartition(3).persist()
    return docs, langid.fit(docs.where("doc_id % 5 <> 0")), docs.collect()


def vectors(rows, idf):
    for r in rows:
        seen, letters = places(r["text"] or "")
        v = np.zeros(langid.BINS)
        for p, n in seen.items():
            v[p] = math.log(1 + n) * idf[p]
        yield r, v / max(np.linalg.norm(v), 1e-300), letters


def test_document_frequencies(case):
    docs, model, rows = case
    train = [r for r in rows if r["doc_id"] % 5 and r["text"] is not None and r["lang"] is not None]
    df = collections.Counter(p for r in train for p in places(r["text"])[0])
    want = [math.log((len(train) + 1) / (df[p] + 1)) + 1 for p in range(langid.BINS)]
    assert np.allclose(model["idf"], want)
    assert set(model["langs"]) == {r["lang"] for r in train if places(r["text"])[1]} and np.allclose(np.linalg.norm(model["centroids"], axis=1), 1, atol=1e-5)


def test_floors_are_quantiles_over_all_training_texts(case):
    docs, model, rows = case
    steps = collections.defaultdict(list)
    train = [r for r in rows if r["doc_id"] % 5 and r["text"] is not None and r["lang"] is not None]
    for r, v, letters in vectors(train, model["idf"]):
        if letters:
            own = model["centroids"][[x == r["lang"] for x in model["langs"]]]
            step = int(min(1.0, max(0.0, float((own @ v.astype(np.float32)).max()))) * langid.STEPS)
            for key in ((r["lang"], langid.length_class(letters)), (r["lang"], None), (None, None)):
                steps[key].append(step)

    def quantile(values):
        return sorted(values)[math.ceil(len(values) * langid.QUANTILE) - 1]

    for k, lang in enumerate(model["langs"]):
        for cls in range(langid.LENGTH_CLASSES):
            levels = [steps[x] for x in ((lang, cls), (lang, None)) if len(steps[x]) >= langid.EVIDENCE]
            want = langid.REJECT * quantile(levels[0] if levels else steps[None, None]) / langid.STEPS
            assert abs(model["floors"][k][cls] - want) <= langid.REJECT * 1.5 / langid.STEPS


def test_every_decision_is_the_nearest_centroid(case):
    docs, model, rows = case
    got = {r["doc_id"]: r for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for r, v, letters in vectors(rows, model["idf"]):
        g = got[r["doc_id"]]
        if not letters:
            assert (g["__lang"], g["__score"], g["__rejected"]) == ("und", 0.0, True)
            continue
        cos = model["centroids"].astype(np.float64) @ v
        k = int(cos.argmax())
        assert g["__score"] == pytest.approx(min(1.0, max(0.0, cos[k])), abs=1e-5)
        if np.sort(cos)[-1] - np.sort(cos)[-2] > 1e-5:
            assert g["__lang"] == model["langs"][k]
        floor = model["floors"][model["langs"].index(g["__lang"])][langid.length_class(letters)]
        if abs(cos[k] - floor) > 1e-4 and g["__lang"] == model["langs"][k]:
            assert g["__rejected"] == (cos[k] < model["floors"][k][langid.length_class(letters)])
    kept = {r["doc_id"] for r in docs.where(~langid.rejects(docs, F.col("doc_id") % 5 == 0)).select("doc_id").collect()}
    assert kept == {i for i, g in got.items() if not g["__rejected"]}
