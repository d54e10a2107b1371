"""Mixing sources to target weights by Sainte-Laguë apportionment.

Documents are laid end to end inside shards of their source, in seeded hash
order, and each shard is cut into blocks of nearly equal word counts.  Seats
(one seat = one block taken once) go first to sources and then to the shards
of a source, each time by the highest quotients ``share / (2 k + 1)``.  Inside
a shard every block is taken ``seats div blocks`` times and the rest of the
seats go to a seeded choice of its blocks.

Nulls and odd rows: a null text or one of white space only has size 0 and is
taken 0 times; a null source is a source of its own, ranked last; a null
``doc_id`` is hashed like any other value; repeated rows are separate
documents; an empty table gives an empty result.  Columns other than
``doc_id, text, source`` are not read, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import materialize, word_count

WEIGHTS = (1.0, 2.0, 3.0)
MAX_RATIO = 3
BLOCK_WORDS = 128
SHARD_WORDS = 1 << 18
MAX_SHARDS = 4096
SEED = 20_24
#: Parts a source's rows are dealt to when its totals are joined back.
SALTS = 64


def targets(totals: DataFrame, weights=WEIGHTS, max_ratio: float = MAX_RATIO) -> DataFrame:
    """(source, source_size) -> plus target: shares by weight, none above
    ``max_ratio`` times the source's size, the excess reshared by weight.

    Sources are ordered by the level at which they reach their cap; the capped
    ones are a prefix of that order, so running sums give the final level
    without iterating.  One row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("rank", rank).withColumn("w", w)
    t = t.withColumn("cap", F.col("source_size") * float(max_ratio)).withColumn("at", F.col("cap") / F.col("w"))
    whole = Window.partitionBy()
    upto = Window.orderBy("at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("all_words", F.sum("source_size").over(whole))
    t = t.withColumn("capped_before", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
    t = t.withColumn("w_left", F.sum("w").over(Window.orderBy("at", "rank").rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.col("all_words") - F.col("capped_before")) / F.col("w_left"))
    t = t.withColumn("free", F.col("level") < F.col("at"))
    final = F.min(F.when(F.col("free"), F.struct("at", "rank", "level"))).over(whole)
    t = t.withColumn("final", final)
    open_ = F.col("final").isNotNull() & (F.struct("at", "rank") >= F.struct("final.at", "final.rank"))
    return t.withColumn("target", F.when(open_, F.col("w") * F.col("final.level")).otherwise(F.col("cap"))).select("source", "rank", "source_size", "target")


def sainte_lague(units: DataFrame, group: list[str], share: Column, seats: Column, limit: Column, order: list[Column]) -> DataFrame:
    """Add ``seats``: highest quotients ``share / (2 k + 1)`` within each group.

    ``share`` sums to ``seats`` over a group of n units.  The final divisor d
    obeys seats/(seats + n/2) <= d <= seats/(seats - n/2), so a unit's seats lie
    between two bounds that differ by about ``share * n / seats + 1``: only the
    quotients between them are ranked, some 2 n rows a group.  ``limit`` is the
    most seats a unit may hold; ties go by ``order``.
    """
    g = Window.partitionBy(*group)
    u = units.withColumn("_v", share.cast("double")).withColumn("_m", seats.cast("double")).withColumn("_cap", limit.cast("long"))
    half = F.count(F.lit(1)).over(g) / 2.0 / F.greatest(F.col("_m"), F.lit(1.0))
    low = F.floor(F.greatest(F.lit(0.0), F.col("_v") * (1 - half) - 0.5))
    high = F.ceil(F.col("_v") * (1 + half) + 0.5)
    u = u.withColumn("_low", F.least(low, F.col("_cap"))).withColumn("_high", F.least(high, F.col("_cap")))
    u = u.withColumn("_left", F.col("_m") - F.sum("_low").over(g))
    u = u.withColumn("_k", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))))
    quotient = F.when(F.col("_v") > 0, F.col("_v") / (2 * F.col("_k") + 1))
    u = u.withColumn("_at", F.row_number().over(g.orderBy(quotient.desc_nulls_last(), *order, F.col("_k"))))
    won = F.when(quotient.isNotNull() & (F.col("_at") <= F.col("_left")), 1).otherwise(0)
    return u.groupBy(*units.columns, "_low").agg((F.col("_low") + F.sum(won)).alias("seats")).drop("_low")


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_ratio: int = MAX_RATIO, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document row."""
    key = F.xxhash64(F.col("doc_id"), F.lit(seed))
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")), "mix-sizes")
    totals = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_ratio), "mix-targets")

    # Every row learns its source's totals; a hot source is dealt to many parts.
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "s")
    d = sized.withColumn("salt", F.pmod(F.shiftright("key", 20), F.lit(SALTS)).cast("int"))
    d = d.join(salted, F.col("source").eqNullSafe(F.col("s")) & (d.salt == salted.salt)).drop("s", "salt")
    shards = F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))
    d = d.withColumn("shard", F.pmod(F.col("key"), shards).cast("int"))

    # Units: one row per (source, shard); rank stands for the source from here on.
    units = d.groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    units = materialize(units.withColumn("blocks", F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / block_words))).otherwise(0).cast("long")), "mix-units")
    per_source = units.groupBy("rank").agg(F.sum("blocks").alias("source_blocks"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("source_blocks")).otherwise(0.0)
    per_source = per_source.withColumn("want", want).withColumn("all", F.round(F.sum("want").over(Window.partitionBy())))
    quotas = sainte_lague(per_source, [], F.col("want") * F.col("all") / F.greatest(F.sum("want").over(Window.partitionBy()), F.lit(1e-9)), F.col("all"), F.col("source_blocks") * max_ratio, [F.col("rank")])
    quotas = quotas.select("rank", "source_blocks", F.col("seats").alias("source_seats"))
    held = units.where("blocks > 0").select("rank", "shard", "words", "blocks").join(quotas, "rank")
    held = sainte_lague(held, ["rank"], F.col("source_seats") * F.col("blocks") / F.col("source_blocks"), F.col("source_seats"), F.col("blocks") * max_ratio, [F.col("shard")])
    held = materialize(held.select("rank", "shard", "words", "blocks", "seats", F.expr("seats div blocks").alias("passes"), (F.col("seats") % F.col("blocks")).alias("extra")), "mix-quotas")

    # The seats left after whole passes go to a seeded choice of blocks.
    chosen = held.where("extra > 0").select("rank", "shard", "extra", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    pick = Window.partitionBy("rank", "shard").orderBy(F.xxhash64("rank", "shard", "block", F.lit(seed)), "block")
    chosen = chosen.withColumn("_at", F.row_number().over(pick)).where("_at <= extra").select("rank", "shard", "block", F.lit(1).alias("hit"))

    line = Window.partitionBy("rank", "shard").orderBy("key", "doc_id", "size")
    d = d.withColumn("row", F.row_number().over(line))
    d = d.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("begin", F.col("end") - F.col("size"))
    d = d.join(held.select("rank", "shard", "words", "blocks", "passes").hint("merge"), ["rank", "shard"], "left")
    first = F.expr("((begin + 1) * blocks - 1) div words")
    last = F.expr("(end * blocks - 1) div words")
    d = d.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    # Chosen blocks grow with the corpus, though their estimate does not show it.
    d = d.join(chosen.hint("merge"), ["rank", "shard", "block"], "left")
    low, high = F.expr("block * words div blocks"), F.expr("(block + 1) * words div blocks")
    part = F.when(F.col("hit") == 1, F.least("end", high) - F.greatest("begin", low)).otherwise(0)
    out = d.withColumn("part", part).groupBy("rank", "shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("passes").alias("passes"), F.sum("part").alias("part"))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.coalesce(F.col("size") * F.col("passes"), F.lit(0)) + F.col("part")).cast("long").alias("taken"))
