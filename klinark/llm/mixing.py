"""Mixtures of sources: temperature weights, realised as blocks that are permutations of their source."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from klinark.session import stage

SECTIONS = 64  # exponents that one pass over the sources tries
ROUNDS = 6     # passes; each narrows the interval 64-fold
HOT = 256      # a source with one in so many rows is hot; there are at most as many of these
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the exponent must meet: an entropy of the weights (nats), or a limit of repetition.

    The limit compares the most repeated source with the least repeated one.
    """
    entropy: float | None = None
    repeats: float | None = None


def word_count(text: Column) -> Column:
    """Words of a text as its token count; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def find_exponent(sources: DataFrame, target: Target) -> float:
    """Exponent in [0, 1] of the token shares, to 6 decimals.

    1 keeps the shares, 0 makes the sources equal. The largest exponent whose entropy is not
    below the target, or the smallest one within the repetition limit; both are monotone, so
    the interval is bisected, 64 parts at a time, each pass being one aggregation over the
    sources. A target that no exponent meets gives the nearest end.
    """
    shares = sources.filter("tokens > 0")
    log_share = F.log(F.col("tokens") / shares.agg(F.sum("tokens")).scalar())
    shares = shares.select(log_share.alias("l"))

    def meets(exponents: list[float]) -> list[bool]:
        row = shares.agg(F.count("*"), F.max("l"), F.min("l"), *[F.sum(F.exp(F.col("l") * a)) for a in exponents],
                         *[F.sum(F.exp(F.col("l") * a) * F.col("l")) for a in exponents]).first()
        if not row[0]:
            return [True] * len(exponents)
        z, zl = row[3:3 + len(exponents)], row[3 + len(exponents):]
        if target.entropy is not None:
            return [math.log(s) - a * sl / s >= target.entropy - 1e-12 for a, s, sl in zip(exponents, z, zl)]
        return [(row[1] - row[2]) * (1 - a) <= math.log(target.repeats) + 1e-12 for a in exponents]

    low, high = 0.0, 1.0
    rising = target.entropy is None  # a larger exponent repeats less; a smaller one has more entropy
    at_low, at_high = meets([0.0, 1.0])
    if at_low if rising else at_high:
        return low if rising else high
    if not (at_high if rising else at_low):
        return high if rising else low
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        ok = meets(grid)
        k = ok.index(True) if rising else len(ok) - 1 - ok[::-1].index(True)
        low, high = (grid[max(k - 1, 0)], grid[k]) if rising else (grid[k], grid[min(k + 1, SECTIONS)])
    return math.ceil(high * 1e6 - 1e-3) / 1e6 if rising else math.floor(low * 1e6 + 1e-3) / 1e6


def order_key(seed: str, block: Column, doc_id: Column) -> Column:
    """Place of a document in the permutation of a block."""
    return F.md5(F.concat_ws("|", F.lit(seed), block.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def quotas(docs: DataFrame, target: Target, budget: int | None, source: str, tokens: str) -> DataFrame:
    """Per source: its tokens, full blocks and the tokens left for a last, partial block.

    With exponent a, weights are the shares to the power a, normalised. A budget is split by the
    weights; without one, the budget is the least that gives every source one full block, so that
    no document is left out. A source without tokens has one full block.
    """
    sources = stage(docs.groupBy(F.col(source).alias("_mix_source"))
                    .agg(F.sum(tokens).alias("tokens"), F.count("*").alias("_mix_rows")), "mix-sources")
    a = find_exponent(sources, target)
    if budget is None:
        whole = F.pow(F.col("tokens"), a) * F.pow(sources.agg(F.max("tokens")).scalar(), 1 - a)
    else:
        whole = F.pow(F.col("tokens"), a) / sources.agg(F.sum(F.pow("tokens", F.lit(a)))).scalar() * budget
    quota = F.floor(F.round(whole, 6)).cast("long")
    if budget is None:
        quota = F.greatest(quota, F.col("tokens"))
    full = F.when(F.col("tokens") > 0, F.expr("_quota div tokens")).otherwise(F.lit(1))
    return (sources.withColumn("_quota", F.when(F.col("tokens") > 0, quota).otherwise(F.lit(0).cast("long")))
            .withColumn("_mix_full", full.cast("long"))
            .withColumn("_mix_rest", F.col("_quota") - F.col("_mix_full") * F.col("tokens")).drop("tokens", "_quota"))


def mix(docs: DataFrame, target: Target, budget: int | None = None, seed: str = "mix", doc_id: str = "doc_id",
        source: str = "source", text: str = "text") -> DataFrame:
    """Documents of the mixture: all columns, with `_tokens`, `_block` and `_order`.

    A source gives full blocks, each a permutation of all its documents, and one partial block: the
    documents that come first in its permutation and fit the tokens left. `_order` sorts a
    block. A document thus appears once in each block it belongs to.

    To find where a partial block ends, tokens are summed per source and 1/4096 of the order; only the
    part with the end is sorted. Rows of hot sources (one in HOT rows or more, so at most HOT of them, which are broadcast)
    are then kept or repeated where they are; those of other sources meet their source in a join in which no
    source has a large share.

    A null source is a source of its own; a null or empty text has no tokens and is in every full
    block; rows with one doc_id stay together; an empty table gives no row. Columns of the names
    above are replaced.
    """
    rows = docs.drop("_tokens", "_block", "_order").withColumn("_tokens", word_count(F.col(text)))
    slim = stage(rows.select(F.col(source).alias("_mix_source"), F.col(doc_id).alias("_doc"), "_tokens"), "mix-tokens")
    plan = stage(quotas(slim, target, budget, "_mix_source", "_tokens"), "mix-quotas")

    keyed = (slim.withColumnRenamed("_mix_source", "_s").join(plan.filter("_mix_rest > 0"), F.col("_s").eqNullSafe(F.col("_mix_source")))
             .withColumn("_key", order_key(seed, F.col("_mix_full"), F.col("_doc")))
             .withColumn("_part", F.substring("_key", 1, 3)))
    parts = keyed.groupBy("_mix_source", "_part").agg(F.sum("_tokens").alias("_sum"), F.first("_mix_rest").alias("_mix_rest"))
    upto = Window.partitionBy("_mix_source").orderBy("_part")
    parts = parts.withColumn("_upto", F.sum("_sum").over(upto))
    # the first part that does not fit whole
    last = (parts.filter("_upto > _mix_rest").groupBy("_mix_source")
            .agg(F.min("_part").alias("_part"), F.min_by(F.col("_upto") - F.col("_sum"), "_part").alias("_begin")))
    ending = (keyed.select(F.col("_mix_source").alias("_s"), F.col("_part").alias("_p"), "_key", "_tokens", "_mix_rest")
              .join(last, F.col("_s").eqNullSafe(F.col("_mix_source")) & (F.col("_p") == F.col("_part")))
              .groupBy("_mix_source", "_key").agg(F.sum("_tokens").alias("_tokens"), F.first("_mix_rest").alias("_mix_rest"),
                                              F.first("_begin").alias("_begin")))
    running = F.col("_begin") + F.sum("_tokens").over(Window.partitionBy("_mix_source").orderBy("_key"))
    cuts = (ending.withColumn("_run", running).filter("_run > _mix_rest")
            .groupBy("_mix_source").agg(F.min("_key").alias("_mix_cut")))
    cuts = cuts.withColumnRenamed("_mix_source", "_c")
    plan = (plan.join(cuts, F.col("_mix_source").eqNullSafe(F.col("_c")), "left")
            .select(F.col("_mix_source"), "_mix_full", "_mix_rest", "_mix_cut", "_mix_rows"))
    plan = stage(plan.withColumn("_mix_hot", F.col("_mix_rows") * HOT >= plan.agg(F.sum("_mix_rows")).scalar()).drop("_mix_rows"), "mix-plan")

    hot = plan.filter("_mix_hot")
    same = F.col(source).eqNullSafe(F.col("_mix_source"))
    found = rows.join(F.broadcast(hot), same, "left")
    rare = found.filter("_mix_hot is null").drop(*plan.columns).join(plan.filter("not _mix_hot"), same)
    joined = found.filter("_mix_hot").unionByName(rare).drop("_mix_hot")
    key = order_key(seed, F.col("_mix_full"), F.col(doc_id))
    partly = (F.col("_mix_rest") > 0) & F.coalesce(key < F.col("_mix_cut"), F.lit(True))
    count = F.col("_mix_full") + F.when(partly, F.lit(1)).otherwise(F.lit(0))
    blocks = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<long>"))
    return (joined.withColumn("_block", F.explode(blocks))
            .withColumn("_order", order_key(seed, F.col("_block"), F.col(doc_id)))
            .drop("_mix_source", "_mix_full", "_mix_rest", "_mix_cut"))
