"""Mixing sources to target weights by temperature.

A source with share p of all tokens gets a weight proportional to p ** exponent. At 1 nothing changes; towards 0 the
mixture flattens, its entropy rises and small sources repeat more. Bisection finds the smallest exponent at which the
entropy is at most its target and no row repeats beyond its limit. Each pass over the (small) table of sources
evaluates the points of several halvings at once, as aggregate columns.

The weights are realised as a budget of tokens for each source. Its rows are hashed into blocks and the blocks are
put in a pseudo-random order. Every row gets the whole number of copies that the budget holds; what is left of the
budget goes to the first rows in block order. That place in the order is one cut for each source, so whether a row is
in is decided from its own hash and the cut: texts are never shuffled or sorted.

Only SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_total, stored, text_of

#: Halvings of the exponent's interval in one pass, and passes: the exponent is known to 2**-32.
HALVINGS, PASSES = 4, 8


def token_estimate(text_col: str = "text") -> Column:
    """About four bytes a token, and an end token."""
    return F.ceil(F.octet_length(text_of(text_col)) / 4).cast("long") + 1


def solve_exponent(shares: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget_share: float | None = None) -> float:
    """The smallest exponent in [0, 1] that keeps both limits; 1 if none does. ``shares`` has a column ``share``.

    ``budget_share`` is the budget over all tokens; None is the least budget that keeps every row once.
    """
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        n = 1 << HALVINGS
        points = [low + (high - low) * i / n for i in range(n)]
        cells = []
        for i, a in enumerate(points):
            power, ratio = F.pow("share", F.lit(a)), F.pow("share", F.lit(a - 1))
            cells += [F.sum(power).alias(f"z{i}"), F.sum(power * F.ln("share")).alias(f"l{i}"), F.max(ratio).alias(f"hi{i}"), F.min(ratio).alias(f"lo{i}")]
        row = shares.agg(*cells).first()
        if row["z0"] is None:
            return 1.0
        step = n
        for i, a in enumerate(points):
            z = row[f"z{i}"]
            entropy = math.log(z) - a * row[f"l{i}"] / z
            repeats = row[f"hi{i}"] / row[f"lo{i}"] if budget_share is None else budget_share * row[f"hi{i}"] / z
            if (target_entropy is None or entropy <= target_entropy) and (max_repeats is None or repeats <= max_repeats):
                step = i
                break
        if step == 0:
            return points[0]
        low, high = points[step - 1], (points[step] if step < n else high)
    return high


def _keyed(docs: DataFrame, source_col: str, id_col: str, text_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(source_col).cast("string").alias("_source"), F.xxhash64(F.col(id_col), text_of(text_col), F.lit(seed)).alias("_hash"), token_estimate(text_col).alias("_tokens"))


def _block(hash_: Column, blocks: Column) -> Column:
    return F.pmod(hash_, blocks)


def _block_order(source: Column, block: Column, seed: int) -> Column:
    return F.xxhash64(source, block, F.lit(seed))


def mixing_plan(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", target_entropy: float | None = None, max_repeats: float | None = 2.0, budget_tokens: int | None = None, block_tokens: int = 1 << 20, seed: int = 17) -> DataFrame:
    """A row for each source: tokens, share, exponent, weight, repeats, copies, blocks and the cut in block order.

    A null source is a source of its own, a null text is empty. An empty table gives no rows. Columns but those three
    are never read. Without a budget the least one is taken that keeps every row at least
    once. ``repeats`` is a source's budget over its tokens; ``copies`` its whole part. The rows up to the cut
    (``cut_order``, ``cut_hash``; null: none) get one more, which together stay within the budget, but that rows with
    the same id and text are taken or left together.
    """
    rows = stored(_keyed(docs, source_col, id_col, text_col, seed), "mix-rows")
    sizes = rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens"))
    total = rows.agg(F.sum("_tokens")).first()[0] or 0
    shares = stored(sizes.withColumn("share", F.col("tokens") / F.lit(float(total or 1))), "mix-sources")
    exponent = solve_exponent(shares, target_entropy, max_repeats, None if budget_tokens is None else budget_tokens / max(total, 1))
    norm = shares.agg(F.sum(F.pow("share", F.lit(exponent))).alias("z"), F.min(F.pow("share", F.lit(exponent - 1))).alias("lo")).first()
    z, budget = norm["z"] or 1.0, budget_tokens
    if budget is None:
        budget = total * z / (norm["lo"] or 1.0)
    plan = shares.select(
        F.col("_source").alias("source"), "tokens", "share", F.lit(exponent).alias("exponent"),
        (F.pow("share", F.lit(exponent)) / F.lit(z)).alias("weight"),
    )
    # A hair above the quotient, so that a budget of exactly once or twice the source isn't missed by rounding.
    plan = plan.withColumn("repeats", F.lit(float(budget)) * F.col("weight") / F.col("tokens")).withColumn("copies", F.floor(F.col("repeats") + 1e-9))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens)))).withColumn("_rest", F.greatest(F.lit(0.0), (F.col("repeats") - F.col("copies")) * F.col("tokens")))
    placed = rows.join(plan.select("source", "blocks"), F.col("_source").eqNullSafe(F.col("source"))).select("_source", "_hash", "_tokens", _block_order(F.col("_source"), _block(F.col("_hash"), F.col("blocks")), seed).alias("_order"))
    summed = stored(running_total(placed.withColumn("_named", F.col("_source").isNotNull()), "_tokens", "_named", "_source", "_order", "_hash", into="_before"), "mix-order")
    starts = summed.groupBy("_source").agg(F.min("_before").alias("_start"))
    limits = plan.join(starts, F.col("_source").eqNullSafe(F.col("source"))).select(F.col("source").alias("_of"), (F.col("_start") + F.col("_rest") + 1e-6).alias("_limit"))
    taken = summed.join(limits, F.col("_source").eqNullSafe(F.col("_of"))).where(F.col("_before") + F.col("_tokens") <= F.col("_limit"))
    cuts = taken.groupBy("_source").agg(F.max(F.struct("_order", "_hash")).alias("_cut"))
    return stored(plan.join(cuts, F.col("_source").eqNullSafe(F.col("source")), "left").select("source", "tokens", "share", "exponent", "weight", "repeats", "copies", "blocks", F.col("_cut._order").alias("cut_order"), F.col("_cut._hash").alias("cut_hash")), "mix-plan")


def mix(docs: DataFrame, plan: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 17, into: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the plan says, with a struct ``into`` for each copy.

    The struct has ``epoch`` (from 0), ``block``, ``block_key``, by which the blocks of all sources and epochs are put
    in one pseudo-random order, ``tokens``, ``weight`` and ``repeats``. All columns of the input are kept; one called
    ``into`` is replaced. Repeated rows are repeated alike. An empty table gives no rows.
    """
    of = plan.select(F.struct(*plan.columns).alias("plan"))
    # The row is one column while others are added, so no name of the input can clash.
    keyed = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(id_col), text_of(text_col), F.lit(seed)).alias("hash"), token_estimate(text_col).alias("tokens"))
    joined = keyed.join(of, F.col("source").eqNullSafe(F.col("plan.source")))
    block = _block(F.col("hash"), F.col("plan.blocks"))
    place = F.struct(_block_order(F.col("plan.source"), block, seed).alias("o"), F.col("hash").alias("h"))
    more = F.coalesce(place <= F.struct(F.col("plan.cut_order").alias("o"), F.col("plan.cut_hash").alias("h")), F.lit(False)) & F.col("plan.cut_order").isNotNull()
    copies = F.col("plan.copies") + F.when(more, 1).otherwise(0)
    epochs = F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)).otherwise(F.array().cast("array<long>"))
    each = joined.withColumn("epoch", F.explode(epochs))
    told = F.struct(
        F.col("epoch").cast("int").alias("epoch"), block.alias("block"),
        F.xxhash64(F.col("plan.source"), block, F.col("epoch"), F.lit(seed + 1)).alias("block_key"),
        "tokens", F.col("plan.weight").alias("weight"), F.col("plan.repeats").alias("repeats"),
    )
    return each.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != into.lower()], told.alias(into))
