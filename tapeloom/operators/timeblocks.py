"""Ordered-series operators that never put a whole series into one task.

``Window.partitionBy('ticker').orderBy('date')`` sends every row of a ticker to
one task, which fails when one key holds a large share of the table. Both
operators here cut each series into pieces along its order and carry what the
pieces owe each other in a table with one row per key and piece:

* :func:`with_carry` cuts by calendar slice (a year by default) and joins back
  a summary of the earlier slices: running sums, maxima, last values, row
  numbers. The rows are shuffled once, by (key, slice).
* :func:`rolling` cuts by row number into blocks of ``block_rows`` rows and
  copies the last ``back`` (and first ``ahead``) rows of a block to its
  neighbour, so that any bounded frame is exact inside its block.

Rows in, rows out: the grain of the input is kept, and so is every row. The
order must be unique within a key (deduplicate first), as it must be for any
running value; one row per day then bounds a yearly slice at 366 rows, however
hot its key. For a finer order pass a finer ``slice_by``, such as the hour.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SLICE = "__slice"
#: a series and a piece of it as one value: a struct is equal to itself where a
#: part is null, so windows, summaries and joins share one partitioning
KEY = "__key"
BLOCK = "__block"
ROW = "__row"
BLOCK_ROWS = 3072  # with the edges of the widest feature still within one window buffer


def _position(order: Sequence[str]) -> Column:
    """The order as one value. A struct would force sort-based aggregation."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def slice_key(by: Sequence[str], order: Sequence[str], slice_by: Column | None = None) -> Column:
    """A series and its calendar slice, a year by default."""
    cut = slice_by if slice_by is not None else F.year(F.col(order[0]))
    return F.struct(*by, cut.alias(SLICE))


def block_key(by: Sequence[str], block: Column) -> Column:
    """A series and its block. The block is never null and must not look so: keys of two types are cast
    where they are joined, and all rows would be shuffled and sorted again for it."""
    return F.struct(*by, F.coalesce(block, F.lit(0).cast("long")).alias(BLOCK))


def with_carry(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    local: Callable[[WindowSpec], Mapping[str, Column]],
    summary: Mapping[str, Column],
    carry: Callable[[WindowSpec], Mapping[str, Column]],
    combine: Mapping[str, Column],
    slice_by: Column | None = None,
    keep_key: bool = False,
) -> DataFrame:
    """Window columns over whole series, from windows over slices plus a carry.

    ``local(w)`` are columns over the rows of one slice, ``summary`` aggregates
    of one slice, ``carry(earlier)`` window columns over the summaries of the
    earlier slices, and ``combine`` the output columns from both. With
    ``keep_key`` the key of the slices stays, for joins where the rows lie.
    """
    sliced = df.withColumn(KEY, slice_key(by, order, slice_by))
    w = Window.partitionBy(KEY).orderBy(*order)
    earlier = (
        Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    owed = (
        sliced.groupBy(KEY)
        .agg(*[c.alias(n) for n, c in summary.items()])
        .select("*", f"{KEY}.*")
        .select(KEY, *[c.alias(n) for n, c in carry(earlier).items()])
    )
    out = sliced.withColumns(dict(local(w))).join(owed, KEY, "left")
    return out.select(*df.columns, *[KEY] * keep_key, *[c.alias(n) for n, c in combine.items()])


@dataclass(frozen=True)
class Carry:
    """What :func:`with_carry` needs for some output columns; several share one window and one join."""

    local: Callable[[WindowSpec], Mapping[str, Column]]
    summary: Mapping[str, Column]
    carry: Callable[[WindowSpec], Mapping[str, Column]]
    combine: Mapping[str, Column]


def with_carries(df: DataFrame, by: Sequence[str], order: Sequence[str], *carries: Carry, slice_by: Column | None = None,
                 keep_key: bool = False) -> DataFrame:
    """Columns of all ``carries``, in one pass over the rows. Their inner names must differ."""
    def merged(parts) -> dict[str, Column]:
        out = {}
        for part in parts:
            if out.keys() & part.keys():
                raise ValueError(f"two carries use {sorted(out.keys() & part.keys())}")
            out |= part
        return out

    return with_carry(
        df, by, order, slice_by=slice_by, keep_key=keep_key,
        local=lambda w: merged(c.local(w) for c in carries),
        summary=merged(c.summary for c in carries),
        carry=lambda e: merged(c.carry(e) for c in carries),
        combine=merged(c.combine for c in carries))


def sums(cols: Mapping[str, Column]) -> Carry:
    """Running totals: ``{output: summed column}``."""
    return Carry(
        local=lambda w: {f"__l_{n}": F.sum(c).over(_so_far(w)) for n, c in cols.items()},
        summary={f"__s_{n}": F.sum(c) for n, c in cols.items()},
        carry=lambda e: {f"__c_{n}": F.sum(f"__s_{n}").over(e) for n in cols},
        combine={
            n: F.when(F.col(f"__c_{n}").isNull(), F.col(f"__l_{n}"))
            .otherwise(F.col(f"__c_{n}") + F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}") * 0))
            for n in cols
        },
    )


def numbers(name: str = ROW) -> Carry:
    """1-based position of each row in its series."""
    return Carry(
        local=lambda w: {"__l": F.row_number().over(w).cast("long")},
        summary={"__s": F.count(F.lit(1))},
        carry=lambda e: {"__c": F.sum("__s").over(e)},
        combine={name: F.col("__l") + F.coalesce(F.col("__c"), F.lit(0))},
    )


def sizes(by: Sequence[str], name: str) -> Carry:
    """Number of rows of each row's series, joined by slice and not by the (maybe hot) key."""
    return Carry(
        local=lambda w: {},
        summary={"__rows": F.count(F.lit(1))},
        carry=lambda e: {"__size": F.sum("__rows").over(Window.partitionBy(*by))},
        combine={name: F.col("__size")},
    )


def before(order: Sequence[str], cols: Mapping[str, Column]) -> Carry:
    """The value of the row before, null on the first row of a series."""
    position = _position(order)
    return Carry(
        local=lambda w: {
            "__first": F.row_number().over(w) == 1,
            **{f"__l_{n}": F.lag(c).over(w) for n, c in cols.items()},
        },
        summary={f"__s_{n}": F.max_by(c, position) for n, c in cols.items()},
        carry=lambda e: {f"__c_{n}": F.last(f"__s_{n}").over(e) for n in cols},
        combine={
            n: F.when(F.col("__first"), F.col(f"__c_{n}")).otherwise(F.col(f"__l_{n}"))
            for n in cols
        },
    )


def known(order: Sequence[str], cols: Mapping[str, Column]) -> Carry:
    """Forward fill: the newest non-null value at or before each row."""
    position = _position(order)
    return Carry(
        local=lambda w: {f"__l_{n}": F.last(c, True).over(_so_far(w)) for n, c in cols.items()},
        summary={
            f"__s_{n}": F.max_by(c, F.when(c.isNotNull(), position)) for n, c in cols.items()
        },
        carry=lambda e: {f"__c_{n}": F.last(f"__s_{n}", True).over(e) for n in cols},
        combine={n: F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")) for n in cols},
    )


def running_sum(df, by, order, cols: Mapping[str, Column], slice_by=None) -> DataFrame:
    return with_carries(df, by, order, sums(cols), slice_by=slice_by)


def row_numbers(df, by, order, name: str = ROW, slice_by=None) -> DataFrame:
    return with_carries(df, by, order, numbers(name), slice_by=slice_by)


def series_size(df, by, order, name: str, slice_by=None) -> DataFrame:
    return with_carries(df, by, order, sizes(by, name), slice_by=slice_by)


def previous(df, by, order, cols: Mapping[str, Column], slice_by=None) -> DataFrame:
    return with_carries(df, by, order, before(order, cols), slice_by=slice_by)


def last_known(df, by, order, cols: Mapping[str, Column], slice_by=None) -> DataFrame:
    return with_carries(df, by, order, known(order, cols), slice_by=slice_by)


def drawdown_by(
    df: DataFrame, by: Sequence[str], order: str, value: str, slice_by: Column | None = None
) -> DataFrame:
    """Deepest fall below the running peak: one row per key, no join back.

    Each slice yields its own deepest fall, lowest and highest value; the fall
    against an earlier peak is its lowest value against the highest before it.
    """
    cut = slice_by if slice_by is not None else F.year(F.col(order))
    keys = [*by, SLICE]
    w = Window.partitionBy(*keys).orderBy(order)
    inside = df.where(F.col(value).isNotNull()).select(
        *by, cut.alias(SLICE), order, F.col(value).alias("__v")
    )
    inside = inside.withColumn("__fall", F.try_divide("__v", F.max("__v").over(_so_far(w))) - 1)
    slices = inside.groupBy(*keys).agg(
        F.min("__fall").alias("__fall"),
        F.min("__v").alias("__low"),
        F.max("__v").alias("__high"),
        F.count(F.lit(1)).alias("__n"),
    )
    earlier = (
        Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = slices.withColumn("__peak", F.max("__high").over(earlier))
    fall = F.least(F.col("__fall"), F.try_divide("__low", "__peak") - 1)
    return across.groupBy(*by).agg(
        F.min(fall).alias("max_drawdown"), F.sum("__n").alias("drawdown_rows")
    )


def rolling(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    back: int,
    ahead: int = 0,
    block_rows: int = BLOCK_ROWS,
    slice_by: Column | None = None,
    attach: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Apply ``build(frame, w)`` where ``w`` may look ``back`` rows behind and
    ``ahead`` rows on.

    ``attach`` joins columns to the numbered rows by the key of their slices
    (:func:`slice_key`), by which they lie together; it keeps the rows as they are.

    ``build`` sees blocks with their copied edge rows and adds columns; the
    copies are dropped afterwards. A key of any size becomes many blocks of at
    most ``block_rows + back + ahead`` rows.
    """
    if max(back, ahead) > block_rows:
        raise ValueError("block_rows must be at least the look-back and look-ahead")
    numbered = with_carries(df, by, order, numbers(ROW), slice_by=slice_by, keep_key=attach is not None)
    if attach is not None:
        numbered = attach(numbered).drop(KEY)
    at = F.col(ROW) - 1
    home = F.floor(at / block_rows)
    offset = at % block_rows
    homes = [home]
    if back:
        homes.append(F.when(offset >= block_rows - back, home + 1))
    if ahead:
        homes.append(F.when((offset < ahead) & (home > 0), home - 1))
    spread = numbered.withColumn(BLOCK, F.explode(F.array_compact(F.array(*homes))))
    spread = spread.withColumn(KEY, block_key(by, F.col(BLOCK)))
    w = Window.partitionBy(KEY).orderBy(ROW)
    return build(spread, w).where(F.col(BLOCK) == home).drop(KEY, BLOCK, ROW)


def decayed_sums(df: DataFrame, by: Sequence[str], order: str, terms: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``{output: (decay, addend)}``: the sum so far, faded by exp(-decay) at each row before its addend comes.

    One row's map x -> exp(-decay) x + addend composes with the next row's to
    one of the same form, so this is any first-order recursion. Sums are kept in
    stretches of a total decay of 400, within the range of a double, and take
    the stretch before with them; what is older weighs less than 1e-170. A weight
    is off by the rounding of the total decay of the series. Meant for tables of summaries: the windows run over whole series.
    """
    stretch = 400.0
    w = Window.partitionBy(*by).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"__l_{n}": F.sum(d).over(_so_far(w)) for n, (d, _) in terms.items()})
    df = df.withColumns({f"__g_{n}": F.floor(F.col(f"__l_{n}") / stretch) for n in terms})
    for n, (_, addend) in terms.items():
        inside = F.col(f"__l_{n}") - stretch * F.col(f"__g_{n}")
        part = Window.partitionBy(*by, f"__g_{n}").orderBy(order)
        df = df.withColumn(f"__y_{n}", F.exp(-inside) * F.sum(addend * F.exp(inside)).over(_so_far(part)))
    ends = {n: F.lead(f"__g_{n}", 1).over(w) != F.col(f"__g_{n}") for n in terms}
    df = df.withColumns({f"__e_{n}": end for n, end in ends.items()})
    df = df.withColumns({
        f"__{of}p_{n}": F.last(F.when(F.col(f"__e_{n}"), F.col(f"__{of}_{n}")), True).over(before) for n in terms for of in ("y", "l")})
    df = df.withColumns({
        n: F.col(f"__y_{n}") + F.coalesce(F.exp(F.col(f"__lp_{n}") - F.col(f"__l_{n}")) * F.col(f"__yp_{n}"), F.lit(0.0)) for n in terms})
    return df.drop(*[f"__{of}_{n}" for n in terms for of in ("l", "g", "y", "e", "yp", "lp")])


def frame(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the ``n - 1`` before it."""
    return w.rowsBetween(-(n - 1), 0)


def full_frame(agg: Column, of: Column, w: WindowSpec, n: int, at_least: int | None = None) -> Column:
    """``agg`` over ``frame(w, n)``, null until ``at_least`` (default ``n``) values are in it."""
    f = frame(w, n)
    return F.when(F.count(of).over(f) >= (n if at_least is None else at_least), agg.over(f))
