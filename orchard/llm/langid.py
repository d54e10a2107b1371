"""Language identification by nearest centroids.

Texts become TF-IDF vectors of character 1- to 3-grams (letters folded to lower
case, all else a word break) hashed to ``BINS`` places, scaled to length 1.
Document frequencies cover every training document.  The centroids, several
per language, come from spherical k-means over a sample of at most about
``SAMPLE`` labelled documents per language, chosen by a hash of the id; one
group per language, so a group is bounded.  A text takes the language of the
centroid with the largest cosine.  It is rejected when that cosine lies below
``REJECT`` times the ``QUANTILE`` of the cosines that all training texts of the
language and length class have with their own language's best centroid.  A
class of fewer than ``EVIDENCE`` texts uses the language's quantile, a language
of fewer the overall one.

Nulls and odd rows: a null text or one without a letter is ``und`` with score
0 and rejected; rows with a null language train nothing; a null ``doc_id``
counts as not held out; repeated rows are separate; an empty table gives an
empty result, and without any training row every text is ``und``; only
``doc_id, text, lang`` are read, ``lang`` for training alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import small, texts, worker_cache

BITS = 13
BINS = 1 << BITS
SAMPLE = 1500
CENTROIDS = 4
ROUNDS = 8
REJECT = 0.5
QUANTILE = 0.02
EVIDENCE = 200
#: Places of a cosine in the counts that the quantiles are taken from.
STEPS = 1000
LENGTH_CLASSES = 24


def _fold_table() -> np.ndarray:
    """Lower-case code point of each letter, a blank for everything else."""
    cache = worker_cache("langid")
    if "fold" not in cache:
        fold = np.full(0x110000, 32, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                fold[cp] = ord(low[0])
        cache["fold"] = fold
    return cache["fold"]


def counts(text: str, fold: np.ndarray) -> tuple[np.ndarray, int]:
    """(n-gram counts by place, number of letters)."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    f = np.concatenate((np.array([32], np.uint32), fold[cps], np.array([32], np.uint32)))
    f = f[np.concatenate(([True], (f[1:] != 32) | (f[:-1] != 32)))]
    letters = int((f != 32).sum())
    if not letters:
        return np.zeros(BINS, np.int64), 0
    one = f * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (f[1:] + np.uint32(1))) * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ (f[2:] + np.uint32(2))) * np.uint32(0xC2B2AE3D)
    place = np.concatenate((one ^ (one >> np.uint32(15)), two ^ (two >> np.uint32(15)), three ^ (three >> np.uint32(15))))
    return np.bincount((place * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS), minlength=BINS), letters


def vector(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    n = math.sqrt(float(v @ v))
    return v / n if n else v


def length_class(letters: int) -> int:
    return min(LENGTH_CLASSES - 1, int(math.log2(letters + 1)))


def document_frequencies(training: DataFrame) -> DataFrame:
    """(place, df) over all training texts; place -1 holds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, fold = np.zeros(BINS, np.int64), 0, _fold_table()
        for b in small(batches):
            for t in texts(b):
                total += counts(t, fold)[0] > 0
                n += 1
        if n:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["place", "df"])

    return training.select("text").mapInArrow(run, "place long, df long").groupBy("place").agg(F.sum("df").alias("df"))


def _fit_language(rows: pd.DataFrame, idf: np.ndarray) -> pd.DataFrame:
    fold = _fold_table()
    rows = rows.sort_values(["order", "text"])
    pairs = (counts(t or "", fold) for t in rows["text"])
    x = np.array([vector(tf, idf).astype(np.float32) for tf, letters in pairs if letters], np.float32).reshape(-1, BINS)
    if not len(x):
        return pd.DataFrame({"lang": [], "centroid": []}, dtype=object)
    # Farthest-first seeds, then Lloyd rounds by cosine.
    seeds = [x.mean(0) / max(np.linalg.norm(x.mean(0)), 1e-12)]
    while len(seeds) < min(CENTROIDS, len(x)):
        seeds.append(x[int(np.argmin((x @ np.array(seeds).T).max(1)))])
    c = np.array(seeds)
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(1)
        for k in range(len(c)):
            if (own == k).any():
                m = x[own == k].sum(0)
                c[k] = m / max(np.linalg.norm(m), 1e-12)
    lang = rows["lang"].iloc[0]
    return pd.DataFrame({"lang": [lang] * len(c), "centroid": [v.astype("<f4").tobytes() for v in c]})


def rejection_floors(training: DataFrame, model: dict) -> np.ndarray:
    """Least cosine by centroid and length class, from all training texts."""
    shared = training.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, fold, seen = shared.value, _fold_table(), Counter()
        own = {lang: m["centroids"][[x == lang for x in m["langs"]]] for lang in set(m["langs"])}
        for b in small(batches):
            for t, lang in zip(texts(b), b.column("lang").to_pylist()):
                tf, letters = counts(t, fold)
                if letters:
                    best = float((own[lang] @ vector(tf, m["idf"]).astype(np.float32)).max())
                    seen[lang, length_class(letters), int(min(1.0, max(0.0, best)) * STEPS)] += 1
        if seen:
            lang, cls, step = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(cls, pa.int32()), pa.array(step, pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["lang", "cls", "step", "n"])

    rows = training.select("text", "lang").mapInArrow(run, "lang string, cls int, step int, n long")
    rows = rows.groupBy("lang", "cls", "step").agg(F.sum("n").alias("n"))
    # A null length class stands for all of them, a null language for all languages.
    one, none = F.col("lang"), F.lit(None)
    levels = F.array(*[F.struct(a.cast("string").alias("lang"), c.cast("int").alias("cls")) for a, c in ((one, F.col("cls")), (one, none), (none, none))])
    rows = rows.select(F.explode(levels).alias("of"), "step", "n").groupBy("of", "step").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("of")
    rows = rows.withColumn("upto", F.sum("n").over(of.orderBy("step"))).withColumn("total", F.sum("n").over(of))
    rows = rows.where(F.col("upto") >= F.col("total") * QUANTILE).groupBy("of").agg(F.min("step").alias("step"), F.first("total").alias("total"))
    found = {(r["of"]["lang"], r["of"]["cls"]): (r["total"], REJECT * r["step"] / STEPS) for r in rows.collect()}

    def floor(lang: str, cls: int) -> float:
        levels = [found.get(x, (0, 0.0)) for x in ((lang, cls), (lang, None))]
        return next((x for n, x in levels if n >= EVIDENCE), found[None, None][1])

    return np.array([[floor(lang, cls) for cls in range(LENGTH_CLASSES)] for lang in model["langs"]])


def fit(training: DataFrame) -> dict:
    """Model from (doc_id, text, lang) rows: idf, centroids, their languages
    and rejection floors.  Its size is bounded by the number of languages."""
    training = training.where("lang is not null and text is not null")
    freq = {r["place"]: r["df"] for r in document_frequencies(training).collect()}
    n = freq.pop(-1, 0)
    idf = np.full(BINS, math.log(n + 1.0) + 1.0)
    for place, df in freq.items():
        idf[place] = math.log((n + 1.0) / (df + 1.0)) + 1.0
    share = {r["lang"]: min(1.0, SAMPLE / r["count"]) for r in training.groupBy("lang").count().collect()}
    if not share:
        return {"idf": idf, "langs": [], "centroids": np.zeros((0, BINS), np.float32), "floors": np.zeros((0, LENGTH_CLASSES))}
    order = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30))
    wanted = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(share.items()) for x in kv]), F.col("lang"))
    sample = training.select("lang", "text", order.alias("order")).where(F.col("order") < wanted * (1 << 30))
    found = sample.groupBy("lang").applyInPandas(lambda pdf: _fit_language(pdf, idf), "lang string, centroid binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    model = {
        "idf": idf, "langs": [r["lang"] for r in found],
        "centroids": np.array([np.frombuffer(r["centroid"], "<f4") for r in found]).reshape(-1, BINS),
    }
    known = training.where(F.col("lang").isin(sorted(set(model["langs"]))))
    return model | {"floors": rejection_floors(known, model) if found else np.zeros((0, LENGTH_CLASSES))}


def judge(m: dict, fold: np.ndarray, text: str) -> tuple[str, float, bool]:
    """(language, score, rejected) of one text."""
    tf, letters = counts(text, fold)
    if not letters or not m["langs"]:
        return "und", 0.0, True
    cos = m["centroids"] @ vector(tf, m["idf"]).astype(np.float32)
    k = int(cos.argmax())
    best = min(1.0, max(0.0, float(cos[k])))
    return m["langs"][k], best, best < m["floors"][k][length_class(letters)]


def predict(docs: DataFrame, model: dict, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus __lang, __score, __rejected, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep, F.lit("").alias("__lang"), F.lit(0.0).alias("__score"), F.lit(True).alias("__rejected")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, fold = shared.value, _fold_table()
        for b in small(batches):
            found = [judge(m, fold, t) for t in texts(b, text)]
            lang, score, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*keep, "__lang", "__score", "__rejected"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def rejects(docs: DataFrame, held_out: Column, text: str = "text") -> Column:
    """A column of ``docs``, learned from its rows that are not ``held_out``:
    whether the text's language is rejected.  Only the text goes to Python; the
    other columns of the row stay in Spark and may have any name."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out).select("doc_id", text, "lang")))

    @F.arrow_udf("boolean")
    def rejected(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, fold = shared.value, _fold_table()
        for part in parts:
            out = []
            for lo in range(0, len(part), 256):
                out += [judge(m, fold, t or "")[2] for t in part.slice(lo, 256).to_pylist()]
            yield pa.array(out, pa.bool_())

    return rejected(docs[text])


def identify(docs: DataFrame, held_out: Column, keep: list[str]) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and predict every row."""
    return predict(docs, fit(docs.where(~held_out).select("doc_id", "text", "lang")), keep)
