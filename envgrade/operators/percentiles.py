"""Exact percentiles that never gather a whole group in one task.

The built-in ``median`` and ``percentile`` keep every distinct value of a group in
one aggregation buffer. That fits an ordinary city-window and not a group that
holds a third of the data, so the groups are narrowed first:

1. equal values collapse to (value, count), shuffled by group *and* value;
2. a histogram over order-preserving value bins, summed map-side, tells in which
   bin the wanted ranks fall (a group has a few thousand bins at most);
3. those bins are cut again, evenly between their own smallest and largest value, so
   that a group whose values lie close together spreads too;
4. only the parts that hold a wanted rank are ranked, each in its own partition.

The result is exact. Interpolation is linear, as in ``percentile``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 1024
PARTS_PER_BIN = 1024


def _bin(value: Column) -> Column:
    """Monotone bin number: fine near zero, 0.07 % wide elsewhere.

    NaN shares the last bin with infinity, where the sort by value puts it last.
    """
    magnitude = F.floor(F.log2(F.lit(1.0) + F.abs(value)) * F.lit(float(BINS_PER_OCTAVE)))
    signed = F.when(value < 0, -magnitude).otherwise(magnitude)
    return F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(signed)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    nearest_rank: bool = False,
) -> DataFrame:
    """One row per group: its keys, ``n`` non-null values and one column per prob.

    With ``nearest_rank`` the value at rank ``round_half_even(p * (n - 1))`` is
    returned instead of an interpolation.
    """
    # The keys travel as one struct: it is never null, so the join below adds no
    # not-null filters to one of its sides and both read the same shuffle.
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("all"))
    values = (
        df.where(F.col(value).isNotNull())
        .select(group.alias("_g"), F.col(value).cast("double").alias("_v"))
        .withColumn("_bin", F.coalesce(_bin(F.col("_v")), F.lit(0).cast("bigint")))
        .groupBy("_g", "_bin", "_v")
        .agg(F.count(F.lit(1)).alias("_k"))
    )

    by_bin = Window.partitionBy("_g").orderBy("_bin")
    bins = (
        values.groupBy("_g", "_bin")
        .agg(F.sum("_k").alias("_bin_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .withColumn(
            "_upto",
            F.sum("_bin_n").over(by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .withColumn("n", F.sum("_bin_n").over(Window.partitionBy("_g")))
    )

    def ranks(p: float) -> tuple[Column, Column]:
        position = F.lit(float(p)) * (F.col("n") - 1)
        if nearest_rank:
            rank = F.bround(position, 0).cast("bigint") + 1
            return rank, rank
        return F.floor(position) + 1, F.ceil(position) + 1

    def covered(upto: Column, count: Column, rank: Column) -> Column:
        return (rank <= upto) & (rank > upto - count)

    wanted = [r for p in probs.values() for r in ranks(p)]
    hit_bins = bins.where(
        reduce(lambda a, b: a | b, [covered(F.col("_upto"), F.col("_bin_n"), r) for r in wanted])
    ).withColumn("_before", F.col("_upto") - F.col("_bin_n")).drop("_upto", "_bin_n")

    place = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * F.lit(float(PARTS_PER_BIN - 1))
    near = values.join(hit_bins, ["_g", "_bin"], "inner").withColumn(
        "_part", F.when(F.col("_high") > F.col("_low"), F.floor(place)).otherwise(F.lit(0).cast("bigint"))
    )
    by_part = Window.partitionBy("_g", "_bin").orderBy("_part")
    parts = (
        near.groupBy("_g", "_bin", "_part")
        .agg(F.sum("_k").alias("_part_n"), F.max("_before").alias("_before"), F.max("n").alias("n"))
        .withColumn("_upto", F.col("_before") + F.sum("_part_n").over(
            by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    hit_parts = parts.where(
        reduce(lambda a, b: a | b, [covered(F.col("_upto"), F.col("_part_n"), r) for r in wanted])
    ).select("_g", "_bin", "_part", (F.col("_upto") - F.col("_part_n")).alias("_start"))

    in_part = (
        Window.partitionBy("_g", "_bin", "_part")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        near.join(hit_parts, ["_g", "_bin", "_part"], "inner")
        .withColumn("_upto", F.col("_start") + F.sum("_k").over(in_part))
    )
    picks = []
    for name, p in probs.items():
        for side, rank in zip(("lo", "hi"), ranks(p)):
            hit = covered(F.col("_upto"), F.col("_k"), rank)
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}_{name}"))
    found = ranked.groupBy("_g").agg(F.max("n").alias("n"), *picks)

    def value_at(name: str, p: float) -> Column:
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        if nearest_rank:
            return lo
        position = F.lit(float(p)) * (F.col("n") - 1)
        share = position - F.floor(position)
        return F.when(lo == hi, lo).otherwise((F.lit(1.0) - share) * lo + share * hi)

    return found.select(
        *[F.col("_g")[k].alias(k) for k in keys],
        "n",
        *[value_at(name, p).alias(name) for name, p in probs.items()],
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return exact_percentiles(df, keys, value, {name: 0.5})


def exact_profile(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """Percentiles of several columns in one pass: ``{column: {output name: prob}}``.

    The columns are stacked under a metric name, so the input is read and shuffled
    once for all of them. Groups without any value of any column do not appear.
    """
    probs = sorted({p for names in wanted.values() for p in names.values()})
    labels = {p: f"_q{i}" for i, p in enumerate(probs)}
    stacked = F.array(
        *[
            F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_x"))
            for c in wanted
        ]
    )
    long = df.select(*keys, F.inline(stacked))
    found = exact_percentiles(long, [*keys, "_metric"], "_x", {labels[p]: p for p in probs})
    picks = [
        F.max(F.when(F.col("_metric") == c, F.col(labels[p]))).alias(name)
        for c, names in wanted.items()
        for name, p in names.items()
    ]
    return found.groupBy(*keys).agg(*picks)
