"""Exact quantiles with linear interpolation, without collecting a group.

The built-in exact ``percentile`` keeps all distinct values of a group in one
task. Here equal values are counted first, the counts are binned by magnitude
(a fixed number of bins, whatever the data), and only the bins that hold a
wanted rank are kept. A kept bin of more than ``ordered`` different values is
cut into equal ranges, of which again only those that hold a rank are kept, and
so on until every bin is small enough for one task to order. Where the bins were
counted before (:func:`binned`), only values of the kept bins are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.sources.staging import stage

BINS_PER_OCTAVE = 64
CUTS = 1024


def _bin(v: Column) -> Column:
    """A bin number that rises with the value: sign, then logarithm of the magnitude; infinities have bins of their own."""
    level = F.floor(F.log2(F.abs(v)) * BINS_PER_OCTAVE) + 2000 * BINS_PER_OCTAVE
    beyond = 4000 * BINS_PER_OCTAVE
    return F.when(v == 0, F.lit(0)).when(F.abs(v) == float("inf"), (F.signum(v) * beyond).cast("long")).otherwise((F.signum(v) * level).cast("long")).cast("long")


def _inside(rank: Column, below: Column, upto: Column) -> Column:
    return (below < rank) & (rank <= upto)


def _cut(rows: DataFrame, group: Sequence[str], ordered: int) -> DataFrame:
    """The rows with every bin of more than ``ordered`` values replaced by the ranges of it that hold a wanted rank.

    A bin lies within an octave, so it has at most 2**52 values and each cut
    leaves a 1,024th of them: six cuts at most, whatever the data.
    """
    hot = rows.where(F.col("__values") > ordered).withColumn("__sub", F.least(F.lit(CUTS - 1), F.floor(
        (F.col("__val") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * CUTS)))
    so_far = Window.partitionBy(*group, "__bin").orderBy("__sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("__from_bin") + F.sum("__count").over(so_far)
    ranges = (
        hot.groupBy(*group, "__bin", "__sub").agg(
            F.sum("__n").alias("__count"), F.count(F.lit(1)).alias("__values"),
            F.min("__val").alias("__lo"), F.max("__val").alias("__hi"),
            F.first("__below").alias("__from_bin"), F.first("__want").alias("__all"))
        .withColumn("__upto", upto).withColumn("__below", F.col("__upto") - F.col("__count"))
        .withColumn("__want", F.filter("__all", lambda w: _inside(w["lo"], F.col("__below"), F.col("__upto"))
                                       | _inside(w["hi"], F.col("__below"), F.col("__upto"))))
        .where(F.size("__want") > 0)
        .select(*group, "__bin", "__sub", "__below", "__values", "__lo", "__hi", "__want")
    )
    small = hot.select(*group, "__bin", "__sub", "__val", "__n").join(ranges, [*group, "__bin", "__sub"]).withColumn(
        "__bin", F.concat_ws("/", "__bin", F.col("__sub").cast("string")))
    return rows.where(F.col("__values") <= ordered).unionByName(small.select(*rows.columns))


def binned(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row a value: ``by``, ``__col``, ``__val`` as a double, and ``__bin``, null for a null or NaN."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("val")) for c in columns
    ])
    long = df.select(*by, F.explode(pairs).alias("__p")).select(
        *by, F.col("__p.col").alias("__col"), F.col("__p.val").alias("__val"))
    return long.withColumn("__bin", F.when(~F.isnan("__val"), _bin(F.col("__val"))))


def _hits(bins: DataFrame, group: Sequence[str], wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """The bins that hold a wanted rank, with the ranks wanted of them and the count below."""
    so_far = (
        Window.partitionBy(*group).orderBy("__bin")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    specs = F.array(*[
        F.struct(F.lit(n).alias("out"), F.lit(c).alias("col"), F.lit(float(p)).alias("p"))
        for n, (c, p) in wanted.items()
    ])
    ranged = (
        bins.withColumn("__upto", F.sum("__n").over(so_far))
        .withColumn("__total", F.sum("__n").over(Window.partitionBy(*group)))
        .withColumn("__below", F.col("__upto") - F.col("__n"))
        .withColumn("__spec", F.explode(specs))
        .where(F.col("__spec.col") == F.col("__col"))
        .withColumn("__pos", F.col("__spec.p") * (F.col("__total") - 1))
    )
    lo, hi = F.floor("__pos") + 1, F.ceil("__pos") + 1
    here = F.col("__below"), F.col("__upto")
    kept = [c for c in ("__values", "__lo", "__hi") if c in bins.columns]
    return (
        ranged.where(_inside(lo, *here) | _inside(hi, *here))
        .groupBy(*group, "__bin", "__below", *kept)
        .agg(F.collect_list(F.struct(
            F.col("__spec.out").alias("out"), F.col("__pos").alias("pos"),
            lo.alias("lo"), hi.alias("hi"))).alias("__want"))
    )


#: of a bin: how many different values, and its ends
_SPAN = {"__values": F.count, "__lo": F.min, "__hi": F.max}


def quantiles(
    df: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[str, float]], ordered: int = 250_000,
    bins: DataFrame | None = None,
) -> DataFrame:
    """One row per ``by`` with ``{output: (column, probability)}``; nulls are skipped.

    Keys must not be null. Groups without a value are absent. No task orders
    more than ``ordered`` values; the bins that hold a rank are staged.

    ``bins`` has ``by``, ``__col``, ``__bin`` and the number ``__n`` of rows of every
    bin of :func:`binned`, counted before: ``df`` is then read for the values of the
    bins that hold a rank, and no others are counted or shuffled.
    """
    columns = sorted({c for c, _ in wanted.values()})
    group = [*by, "__col"]
    long = binned(df, by, columns).dropna(subset=[*by, "__bin"])
    if bins is None:
        # both uses of the counts ask for the same rows, so that one shuffle serves both
        counts = (
            long.select(*group, "__val").groupBy(*group, "__val")
            .agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__bin", _bin(F.col("__val")))
        )
        hits = _hits(counts.groupBy(*group, "__bin").agg(
            F.sum("__n").alias("__n"), *[f("__val").alias(c) for c, f in _SPAN.items()]), group, wanted)
        rows = counts.join(hits, [*group, "__bin"])
    else:
        hits = stage(_hits(bins.select(*group, "__bin", "__n").dropna(subset=[*by, "__bin"]), group, wanted), "quantile-hits")
        some = long.join(hits.select(*group, "__bin"), [*group, "__bin"], "left_semi")
        counts = stage(some.groupBy(*group, "__bin", "__val").agg(F.count(F.lit(1)).alias("__n")), "quantile-values")
        spans = counts.groupBy(*group, "__bin").agg(*[f("__val").alias(c) for c, f in _SPAN.items()])
        rows = counts.join(hits.join(spans, [*group, "__bin"]), [*group, "__bin"])
    inner = (
        Window.partitionBy(*group, "__bin").orderBy("__val")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("__bin", F.col("__bin").cast("string"))
    rows = stage(rows, "quantile-bins") if bins is None else rows
    while (rows.agg(F.max("__values")).first()[0] or 0) > ordered:
        rows = stage(_cut(rows, group, ordered), "quantile-bins")
    ranked = (
        rows
        .withColumn("__to", F.col("__below") + F.sum("__n").over(inner))
        .withColumn("__from", F.col("__to") - F.col("__n"))
        .withColumn("__w", F.explode("__want"))
    )
    covers = lambda k: _inside(k, F.col("__from"), F.col("__to"))

    def interpolated(name: str) -> Column:
        mine = F.col("__w.out") == name
        low = F.max(F.when(mine & covers(F.col("__w.lo")), F.col("__val")))
        high = F.max(F.when(mine & covers(F.col("__w.hi")), F.col("__val")))
        share = F.max(F.when(mine, F.col("__w.pos") - F.floor("__w.pos")))
        return F.when(low == high, low).otherwise(low + (high - low) * share)

    return ranked.groupBy(*by).agg(*[interpolated(n).alias(n) for n in wanted])


def medians(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return quantiles(df, by, {c: (c, 0.5) for c in columns})
