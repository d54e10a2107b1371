"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Generators of high recall propose spans that may overlap: the four base forms
(which always stay when they pass their check) and wider forms of the same
kinds (obfuscated addresses, numbers without a plus sign or with other
separators).  Gradient-boosted trees score the wide ones by format and
context.  They are trained on candidates found in the corpus: base matches
that pass their check are positive, those that fail it negative, and rewritten
copies of both teach the wide forms.  Every base candidate of the corpus is used:
three of four for training, by hash, the rest to calibrate each kind's threshold,
no less than ``MIN_PROB`` and above all but ``FALSE_RATE`` of its negatives.  Of accepted spans that overlap,
the likeliest stays; one that overlaps a base span is dropped.

Everything is DataFrame functions and ``pyspark.ml``.  Regular expressions use
possessive repeats and run-start look-behinds, so that they match what the
plain forms match, in linear time and without deep recursion on long runs.

Nulls and odd rows: a null text is empty and has no span; a null ``doc_id`` is
kept as such; equal rows are searched once and each gets the result; an empty
table gives an empty result; without training rows of both classes nothing is
added to the base spans; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
MIN_PROB = 0.85
FALSE_RATE = 0.002
CONTEXT = 24
CELL = 64
TREES, DEPTH = 12, 4

_LOCAL = "A-Za-z0-9._%+-"
#: Base forms; ``\G`` lets a match start where the previous one ended.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider forms of the same kinds.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:[\[({] ?(?:at|AT) ?[\])}]|@) ?[A-Za-z0-9-]{1,64}+(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]{2,64}+){1,4}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?[\[(]\.[\])] ?[0-9]{1,3}+){3}+(?![0-9.])",
    "card": r"(?<![0-9A-Za-z+])[0-9]{4}[ ._/-]{1,3}[0-9]{4}[ ._/-]{1,3}[0-9]{4}[ ._/-]{1,3}[0-9]{1,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:00|\()?[0-9][ ().0-9-]{6,24}[0-9](?![0-9A-Za-z])",
}
_MAY_HOLD = {
    ("base", "email"): "@", ("wide", "email"): r"@|[\[({] ?(?:at|AT) ?[\])}]", ("base", "phone"): r"\+[0-9]",
}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.coalesce(F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0, F.lit(False))


def octets_ok(ip: Column) -> Column:
    """Whether all dot-separated numbers are at most 255, leading zeros aside."""
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(ip, r"\."), small)


def valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    return (
        F.when(kind == "email", F.lit(True)).when(kind == "ip", octets_ok(F.btrim(F.regexp_replace(value, "[^0-9]+", "."), F.lit("."))))
        .when(kind == "card", F.when(n.between(13, 19), luhn(_digits(value))).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def _found(text: Column, pattern: str) -> Column:
    """Array of (value, gap before it, left context, right context)."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zipped = F.arrays_zip(hits.alias("value"), gaps.alias("before"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("after"))
    return F.transform(zipped, lambda z: F.struct(z["value"].alias("value"), F.length(z["before"]).alias("gap"), F.right(z["before"], F.lit(CONTEXT)).alias("left"), F.left(z["after"], F.lit(CONTEXT)).alias("right")))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, h, form, kind, start, end, value, left, right) of every
    generator's matches in the whole texts; h identifies the text."""
    d = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").where("text rlike '[0-9@]|[\\\\[({] ?(?:at|AT) ?[\\\\])}]'")
    forms = [(form, kind, pattern) for form, group in (("base", BASE), ("wide", WIDE)) for kind, pattern in group.items()]
    arrays = []
    for form, kind, pattern in forms:
        may = F.col("text").rlike(_MAY_HOLD.get((form, kind), "[0-9]"))
        found = _found(F.col("text"), pattern)
        arrays.append(F.when(may, found).otherwise(_found(F.lit(""), pattern)).alias(f"{form}_{kind}"))
    d = d.select("doc_id", "h", *arrays)
    d = d.dropDuplicates(["doc_id", "h"])

    def tagged(form: str, kind: str) -> Column:
        return F.transform(f"{form}_{kind}", lambda m, i: F.struct(F.lit(form).alias("form"), F.lit(kind).alias("kind"), i.alias("at"), m.alias("m")))

    every = F.concat(*[tagged(form, kind) for form, kind, _ in forms])
    d = d.select("doc_id", "h", F.explode(every).alias("c")).select("doc_id", "h", "c.form", "c.kind", "c.at", "c.m.*").where("value is not null")
    line = Window.partitionBy("doc_id", "h", "form", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length("value")).over(line.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return d.withColumn("ok", valid(F.col("kind"), F.col("value"))).drop("at", "gap")


def features(c: DataFrame) -> DataFrame:
    """Format and context of a candidate, all numbers."""
    value, left, right = F.col("value"), F.col("left"), F.col("right")
    digits = _digits(value)
    groups = F.size(F.split(F.btrim(F.regexp_replace(value, "[^0-9]+", " ")), " "))
    numbers = F.transform(F.split(F.btrim(F.regexp_replace(value, "[^0-9]+", " ")), " "), lambda g: F.when(F.length(g) <= 9, F.coalesce(g.try_cast("int"), F.lit(0))).otherwise(F.lit(10**9)))
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    cols = {
        **{f"is_{k}": flag(F.col("kind") == k) for k in KINDS},
        "length": F.length(value), "digits": F.length(digits), "letters": count("[A-Za-z]"), "spaces": count(" "), "dots": count(r"\."), "dashes": count("-"), "slashes": count("[/_]"), "brackets": count(r"[()\[\]{}]"),
        "groups": groups, "largest": F.least(F.array_max(numbers), F.lit(100_000)), "smallest_group": F.array_min(F.transform(F.split(F.btrim(F.regexp_replace(value, "[^0-9]+", " ")), " "), lambda g: F.length(g))),
        "plus": flag(value.startswith("+")), "zeros": flag(value.startswith("00")), "open": flag(value.startswith("(")), "luhn": flag(F.when(F.length(digits).between(12, 19), luhn(digits))), "different": F.size(F.array_distinct(F.split(digits, "(?<=.)(?=.)"))),
        "at_sign": count("@"), "at_word": flag(F.lower(value).rlike(r"[\[({] ?at ?[\])}]")), "last_label": F.length(F.regexp_extract(F.right(value, F.lit(CONTEXT)), r"([A-Za-z]*)$", 1)),
        "left_letter": flag(left.rlike(r"\p{L}$")), "left_joint": flag(left.rlike(r"[=:\"'/.,$€%-]\s?$")), "left_digits": F.length(F.regexp_replace(left, "[^0-9]", "")),
        "right_letter": flag(right.rlike(r"^\p{L}")), "right_joint": flag(right.rlike(r"^\s?[=:\"'/%$€-]")), "right_digits": F.length(F.regexp_replace(right, "[^0-9]", "")),
        "cue_phone": flag(F.lower(left).rlike(r"\b(?:tel|phone|call|fax|mobile|cell|whatsapp)\b")), "cue_mail": flag(F.lower(left).rlike(r"mail|contact|write")), "cue_card": flag(F.lower(left).rlike(r"card|visa|iban|account")), "cue_ip": flag(F.lower(left).rlike(r"\bip\b|host|addr|server")),
    }
    made = c.select("*", *[x.cast("double").alias(f"f_{n}") for n, x in cols.items()])
    return VectorAssembler(inputCols=[f"f_{n}" for n in cols], outputCol="features", handleInvalid="keep").transform(made).drop(*[f"f_{n}" for n in cols])


def training_rows(c: DataFrame) -> DataFrame:
    """All base candidates with weak labels, and rewritten copies of them."""
    base = c.where(F.col("form") == "base").withColumn("label", F.col("ok").cast("double"))
    good = base.where("label = 1")

    def rewritten(kind: str, label: float, value: Column) -> DataFrame:
        return good.where(F.col("kind") == kind).withColumn("value", value).withColumn("label", F.lit(label))

    v, digits = F.col("value"), _digits(F.col("value"))
    parts = [
        base,
        rewritten("email", 1.0, F.replace(F.replace(v, F.lit("@"), F.lit(" (at) ")), F.lit("."), F.lit(" (dot) "))),
        rewritten("email", 1.0, F.replace(v, F.lit("@"), F.lit(" [at] "))),
        rewritten("email", 0.0, F.regexp_replace(v, r"\.[A-Za-z0-9-]+$", " .5")),
        rewritten("email", 0.0, F.concat(F.lit("@ "), F.regexp_replace(v, "[0-9@]", ""))),
        rewritten("ip", 1.0, F.replace(v, F.lit("."), F.lit("[.]"))),
        rewritten("ip", 0.0, F.regexp_replace(v, r"\.", "[.]9")),
        rewritten("card", 1.0, F.regexp_replace(digits, r"([0-9]{4})(?=[0-9])", "$1.")),
        rewritten("card", 1.0, F.regexp_replace(digits, r"([0-9]{4})(?=[0-9])", "$1 - ")),
        rewritten("card", 0.0, F.concat(F.regexp_replace(F.expr("left(value, length(value) - 1)"), r"([0-9]{4})(?=[0-9])", "$1."), ((F.right(v, F.lit(1)).try_cast("int") + 1) % 10).cast("string"))),
        rewritten("phone", 1.0, F.regexp_replace(v, r"^\+[0-9]{1,2} ?", "")),
        rewritten("phone", 1.0, F.regexp_replace(v, r"^\+", "00")),
        rewritten("phone", 0.0, digits),
        rewritten("phone", 0.0, F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2))),
        rewritten("phone", 0.0, F.regexp_replace(digits, "([0-9]{1,2})(?=(?:[0-9]{2})+$)", "$1 ")),
        rewritten("phone", 0.0, F.concat(F.substring(digits, 1, 5), F.lit("."), F.substring(digits, 6, 4))),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("kept_out", F.pmod(F.xxhash64("h", "value"), F.lit(4)) == 0)


def _fit(c: DataFrame):
    """(model, thresholds by kind), or None where a class is missing."""
    rows = materialize(features(training_rows(c)).select("kind", "label", "kept_out", "features"), "pii-train")
    classes = {r["label"] for r in rows.where("not kept_out").select("label").distinct().collect()}
    if classes != {0.0, 1.0}:
        return None
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(rows.where("not kept_out"))
    away = model.transform(rows.where("kept_out and label = 0")).withColumn("p", vector_to_array("probability")[1])
    worst = {r["kind"]: r["p"] for r in away.groupBy("kind").agg(F.percentile("p", 1 - FALSE_RATE).alias("p")).collect()}
    return model, {k: max(MIN_PROB, worst.get(k) or 0.0) for k in KINDS}


def _celled(spans: DataFrame, tag: str) -> DataFrame:
    """Spans once per stretch of ``CELL`` code points they touch: overlap tests
    stay local in texts with very many spans.  Columns get the tag."""
    cells = F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor((F.col("end") - 1) / CELL)))
    s = spans.withColumn("cell", cells)
    return s.select(*[F.col(c).alias(f"{tag}_{c}") for c in s.columns])


def _touching(a: DataFrame, b: DataFrame, more: Column | None = None) -> DataFrame:
    """Spans of ``a`` that overlap one of ``b`` for which ``more`` holds."""
    on = F.col("a_doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("a_h") == F.col("b_h")) & (F.col("a_cell") == F.col("b_cell")) & (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    hit = _celled(a, "a").join(_celled(b, "b"), on if more is None else on & more, "left_semi")
    return hit.select(*[F.col(f"a_{c}").alias(c) for c in a.columns]).dropDuplicates(["doc_id", "h", "kind", "start", "end"])


def _without(a: DataFrame, out: DataFrame) -> DataFrame:
    o = out.select(*[F.col(c).alias(f"o_{c}") for c in ("doc_id", "h", "kind", "start", "end")])
    same = F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
    for c in ("h", "kind", "start", "end"):
        same = same & (F.col(c) == F.col(f"o_{c}"))
    return a.join(o, same, "left_anti")


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, h, kind, start, end, base): the accepted spans of each text."""
    c = materialize(candidates(docs), "pii-candidates")
    keep = ["doc_id", "h", "kind", "start", "end"]
    base = c.where("form = 'base' and ok").select(*keep)
    found = base.withColumn("base", F.lit(True))
    fitted = _fit(c)
    if fitted is None:
        return found
    model, least = fitted
    wide = c.where("form = 'wide' and ok")
    wide = _without(wide, _touching(wide.select(*keep), base))
    scored = model.transform(features(wide)).withColumn("p", vector_to_array("probability")[1])
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in least.items() for x in kv]), F.col("kind"))
    scored = materialize(scored.where(F.col("p") > limit).select(*keep, "p"), "pii-accepted")
    # Among overlapping ones the likeliest stays, then the longest, then the first.
    order = lambda t: F.struct(F.col(f"{t}_p"), F.col(f"{t}_end") - F.col(f"{t}_start"), -F.col(f"{t}_start"), F.col(f"{t}_kind"))
    added = _without(scored, _touching(scored, scored, order("a") < order("b")))
    return found.unionByName(added.select(*keep).withColumn("base", F.lit(False)))


def _listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def by_document(docs: DataFrame) -> DataFrame:
    """(doc_id, h, spans, base_spans): arrays of (rank, start, end, kind),
    ordered by kind as listed and start; for texts that have any."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    s = find_spans(docs).withColumn("s", F.struct(rank.alias("rank"), "start", "end", "kind"))
    return s.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("s")).alias("spans"), F.array_sort(F.collect_list(F.when(F.col("base"), F.col("s")))).alias("base_spans"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document with counts and listings of its spans."""
    s = by_document(docs).withColumnsRenamed({"doc_id": "d", "h": "g"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"))
    out = rows.join(s, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    empty = F.array().cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string>>")
    base, spans = F.coalesce("base_spans", empty), F.coalesce("spans", empty)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_listing(base).cast("binary"), 256).alias("base_sha256"), _listing(spans).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``[KIND]``; where spans
    overlap, they are replaced together under the first one's kind."""
    s = by_document(docs).select(F.col("doc_id").alias("__d"), F.col("h").alias("__g"), F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))).alias("__spans"))
    d = docs.withColumn("__h", F.xxhash64("text"))
    d = d.join(s, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__h") == F.col("__g")), "left")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, x: Column) -> Column:
        # A span that begins before the last one's end adds nothing but its tail.
        gap = F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.greatest(F.lit(0), x["start"] - a["at"]).cast("int"))
        mark = F.when(x["start"] >= a["at"], F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.concat(a["done"], gap, mark).alias("done"), F.greatest(a["at"], x["end"].cast("long")).alias("at"))

    walked = F.aggregate("__spans", start, step)
    rest = F.substring(F.col("text"), (walked["at"] + 1).cast("int"), F.length("text"))
    return d.withColumn("text", F.when(F.size("__spans") > 0, F.concat(walked["done"], rest)).otherwise(F.col("text"))).select(*docs.columns)
