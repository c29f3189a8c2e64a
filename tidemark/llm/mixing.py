"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the number of times the mix should take it. Of all rates between 0 and
``limit`` whose words add up to the target of every source, those with the largest entropy
relative to "every document once" are taken. They have the form

    rate = limit / (1 + (limit - 1) * exp(-lambda * size / scale))

with one multiplier ``lambda`` per source: the tilt is exponential in a document's words, and
the bound on rates turns the exponential into this logistic form. The multipliers solve the convex
dual, one equation per source, by Newton steps that Spark computes for all sources at once over
counts per (source, size); a step that leaves the known bracket is replaced by halving it.

Rates become copies by rounding that carries the missing words from long sizes on to shorter ones:
each document gets the whole part of its rate or one copy more, and a source misses its target by
a few words unless all its documents are long. It runs over the counts per (source, size), of which
a source has no more than its longest document has words. Which documents of one size get the copy
is up to the hash of their id, so reruns agree. Sums are of decimals, so no order of addition
changes them.

Defined results: a null text has size 0 and is taken with 0 words; a null source is a source of its
own, ordered last; rows with the same id or text are rows of their own; an empty table gives an
empty mix; a source of size 0 has target 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, word_count

LIMIT = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
STEPS = 60
CLOSE_ENOUGH = 1e-7
#: Documents of one (source, size) ranked by one task.
RANKED_TOGETHER = 1_000


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def source_targets(sources: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Targets share the sum of all sizes by weight and stop at ``limit`` times a source's size; the
    excess is shared again by weight. The common level (words per weight) rises until no open source
    is above its limit; each pass is one aggregation. There is one row per source here, so ordering
    them in one task is fine.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    weighed = stored(sources.withColumn("weight", weight.cast("long")), "mix-weights")
    level = 0.0
    while True:
        full = F.lit(level) * F.col("weight") >= limit * F.col("source_size")
        row = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full & (F.lit(level) > 0), limit * F.col("source_size")).otherwise(0)).alias("stopped"),
            F.sum(F.when(full & (F.lit(level) > 0), 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            level = float("inf")
            break
        new = (row["all"] - row["stopped"]) / row["open"]
        if new <= level:
            break
        level = new
    share = F.lit(level) * F.col("weight") if level != float("inf") else F.lit(limit) * F.col("source_size")
    return weighed.withColumn("target", F.least(share.cast("double"), (limit * F.col("source_size")).cast("double")))


def _rate(multiplier: Column, size: Column, scale: Column, limit: int) -> Column:
    free = limit / (1 + (limit - 1) * F.exp(-multiplier * size / scale))
    return F.when(F.col("stopped"), F.lit(float(limit))).otherwise(free)


def multipliers(sizes: DataFrame, targets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Solve the dual. ``sizes``: source, size, n. Returns source, source_size, target, multiplier, scale, stopped."""
    state = targets.select(
        "source",
        "source_size",
        "target",
        F.lit(0.0).alias("multiplier"),
        F.lit(-1e6).alias("low"),
        F.lit(1e6).alias("high"),
        F.col("mean_size").alias("scale"),
        (F.col("target") >= limit * F.col("source_size")).alias("stopped"),
    )
    hist = sizes.withColumnRenamed("source", "_source")
    state = stored(state, "mix-state")
    for _ in range(STEPS):
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("scale"), limit)
        words = F.col("n") * F.col("size") * rate
        slope = words * F.col("size") / F.col("scale") * (1 - rate / limit)
        sums = (
            hist.join(state, _same(F.col("_source"), F.col("source")))
            .groupBy("source")
            .agg(
                F.sum(words.cast("decimal(38,9)")).cast("double").alias("taken"),
                F.sum(slope.cast("decimal(38,9)")).cast("double").alias("slope"),
            )
            .withColumnRenamed("source", "_source")
        )
        gap = F.col("taken") - F.col("target")
        done = F.col("stopped") | (F.abs(gap) <= CLOSE_ENOUGH * F.col("target"))
        moved = state.join(sums, _same(F.col("_source"), F.col("source"))).select(
            *state.columns, "slope", gap.alias("gap"), done.alias("done")
        )
        low = F.when(F.col("gap") < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("gap") > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - F.col("gap") / F.col("slope")
        step = F.when((F.col("slope") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        moved = stored(
            moved.select(
                "source",
                "source_size",
                "target",
                F.when(F.col("done"), F.col("multiplier")).otherwise(step).alias("multiplier"),
                low.alias("low"),
                high.alias("high"),
                "scale",
                "stopped",
                "done",
            ),
            "mix-state",
        )
        finished = moved.filter(~F.col("done")).isEmpty()
        state = moved.drop("done")
        if finished:
            break
    return state


def _round_rates(counts: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of each size, and how many documents of it get one more; one source, a row per size.

    Sizes go from long to short and each carries over the words it is off, so short documents make
    up for long ones.
    """
    counts = counts.sort_values("size", ascending=False)
    extra, carry = [], 0.0
    for size, n, rate in zip(counts["size"], counts["n"], counts["rate"]):
        words = carry + (rate - int(rate)) * n * size
        e = min(n, max(0, round(words / size))) if size else 0
        carry = words - e * size
        extra.append(e)
    return counts.assign(whole=counts["rate"].astype("int64"), extra=extra)


def mix(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Return doc_id, source, size, source_size, target, rate, copies, taken; one row per row of ``docs``."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = stored(
        sized.withColumn("_pick", F.xxhash64("doc_id", F.lit("mix"))).withColumn("_row", F.monotonically_increasing_id()),
        "mix-sizes",
    )
    sizes = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("documents")
    )
    targets = source_targets(sources, limit).withColumn(
        "mean_size", F.greatest(F.lit(1.0), F.col("source_size") / F.col("documents"))
    )
    solved = multipliers(sizes, targets, limit)

    named = solved.withColumnRenamed("source", "_source")
    rated = sizes.join(named, _same(F.col("_source"), F.col("source"))).select(
        "source",
        "size",
        "n",
        "source_size",
        "target",
        F.round(_rate(F.col("multiplier"), F.col("size"), F.col("scale"), limit), 9).alias("rate"),
    )
    fields = ", ".join(f"{name} {kind}" for name, kind in rated.dtypes)
    plan = rated.groupBy("source").applyInPandas(_round_rates, f"{fields}, whole long, extra long")
    plan = plan.select(
        F.col("source").alias("_source"),
        F.col("size").alias("_size"),
        "source_size",
        "target",
        "rate",
        "whole",
        "extra",
        F.ceil(F.col("n") / RANKED_TOGETHER).cast("long").alias("parts"),
    )
    plan = stored(plan, "mix-plan")
    placed = sized.join(plan, _same(F.col("_source"), F.col("source")) & (F.col("_size") == F.col("size"))).drop(
        "_source", "_size"
    )
    # Rank within (source, size): parts of the hash range are ranked apart, counts of earlier parts are added.
    group = ["source", "size", "_part"]
    placed = placed.withColumn("_part", F.pmod("_pick", F.col("parts")))
    before = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.filter(F.col("parts") > 1)
        .groupBy(*group)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_part").alias("_p"), "_before")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_pick", "_row"))
    ranked = placed.withColumn("_rank", rank).join(
        offsets,
        _same(F.col("_s"), F.col("source")) & (F.col("_z") == F.col("size")) & (F.col("_p") == F.col("_part")),
        "left",
    )
    copies = F.col("whole") + (F.col("_rank") + F.coalesce("_before", F.lit(0)) <= F.col("extra")).cast("long")
    return ranked.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "rate",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        "_row",
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")
