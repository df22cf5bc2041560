"""Cleaning and enrichment of bars. Grain in and out: one row per ticker and day,
except where a function says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.operators import timeblocks
from tapeloom.sources.staging import stage

# Vendor column names and ours.
COLUMN_MAPPING = {
    "Date": "date",
    "Ticker": "ticker",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Adj Close": "adj_close",
    "ingested_at": "ingested_at",
}
KEY = ("ticker", "date")
CRITICAL = ("date", "ticker", "close")
OUTLIER_RETURN_PCT = 50
LOW_VOLUME = 10_000
MIN_HISTORY = 252


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column: inside the engine missing is null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def standardize_columns(df: DataFrame, mapping: Mapping[str, str] = COLUMN_MAPPING) -> DataFrame:
    return df.toDF(*[mapping.get(c, c).lower() for c in df.columns])


def cast_date(df: DataFrame, col: str = "date", strict: bool = True) -> DataFrame:
    """Text to date. Not strict: rows whose date cannot be read are dropped."""
    if strict:
        return df.withColumn(col, F.to_date(col))
    return df.withColumn(col, F.try_to_timestamp(F.col(col)).cast("date")).dropna(subset=[col])


def newest_first(df: DataFrame, keys: Sequence[str], stamp: str | None = "ingested_at") -> list[Column]:
    """A total order for "keep last": the stamp, then every other column."""
    rest = [c for c in df.columns if c not in keys and c != stamp]
    lead = [stamp] if stamp and stamp in df.columns else []
    return [F.col(c).desc_nulls_last() for c in [*lead, *rest]]


def deduplicate(
    df: DataFrame, keys: Sequence[str] = KEY, order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key. The rank filter is applied before the shuffle as well as
    after it, so many copies of one key do not meet in one task."""
    w = Window.partitionBy(*keys).orderBy(*(order or newest_first(df, keys)))
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count), one row per column."""
    cols = [c for c in (cols or df.columns) if c in df.columns]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "null_count")


def drop_null_rows(df: DataFrame, cols: Sequence[str] = CRITICAL) -> DataFrame:
    return df.dropna(subset=[c for c in cols if c in df.columns])


def _gates() -> dict[str, Column]:
    rules = {
        "close": F.col("close") > 0,
        "high_low": F.col("high") >= F.col("low"),
        "volume": F.col("volume") >= 0,
        "open": F.col("open") > 0,
    }
    return {n: F.coalesce(c, F.lit(False)) for n, c in rules.items()}


def quality_gates(df: DataFrame) -> DataFrame:
    """Rows that pass every gate; a gate on a null value fails."""
    for rule in _gates().values():
        df = df.where(rule)
    return df


def gate_counts(df: DataFrame) -> DataFrame:
    """Rows each gate removes, taken in order: one row."""
    so_far = F.lit(True)
    counts = []
    for name, rule in _gates().items():
        counts.append(F.count_if(so_far & ~rule).alias(f"removed_{name}"))
        so_far = so_far & rule
    return df.agg(*counts, F.count_if(so_far).alias("kept"), F.count(F.lit(1)).alias("rows"))


def _return(first_return: float | None) -> Column:
    pct = (F.try_divide(F.col("close"), F.col("__prev")) - 1) * 100
    return pct if first_return is None else F.coalesce(pct, F.lit(float(first_return)))


def daily_return(df: DataFrame, first_return: float | None = 0.0) -> DataFrame:
    """Close-to-close return in percent; the first row of a ticker gets ``first_return``."""
    out = timeblocks.previous(df, ["ticker"], ["date"], {"__prev": F.col("close")})
    return out.withColumn("daily_return", _return(first_return)).drop("__prev")


def add_sector(df: DataFrame, *dims: DataFrame) -> DataFrame:
    """Sector and industry of the first given dimension, missing ones ``Unknown``.

    Rows with the key of their slice (``timeblocks.KEY``) stay where they lie by it: the
    dimension is joined to the slices, and the slices to the rows.
    """
    out = df.drop("sector", "industry")
    dim = next((d for d in dims if d is not None), None)
    if dim is None:
        return out.withColumns({"sector": F.lit("Unknown"), "industry": F.lit("Unknown")})
    one = deduplicate(
        dim.select("ticker", *[c for c in ("sector", "industry") if c in dim.columns]), ["ticker"]
    )
    if timeblocks.KEY in out.columns:
        rows = out.select("ticker", *[c for c in out.columns if c != "ticker"])
        slices = out.select(timeblocks.KEY).distinct().select(timeblocks.KEY, f"{timeblocks.KEY}.ticker")
        found = slices.join(one, "ticker", "left").drop("ticker")
        out = rows.join(found, timeblocks.KEY, "left").select(*rows.columns, *[c for c in one.columns if c != "ticker"])
    else:
        out = out.join(one, "ticker", "left")
    return out.withColumns({
        c: F.coalesce(F.col(c), F.lit("Unknown")) if c in one.columns else F.lit("Unknown")
        for c in ("sector", "industry")
    })


def stamp(df: DataFrame, version: str, at: str = "enriched_at") -> DataFrame:
    return df.withColumns({at: F.current_timestamp(), "data_version": F.lit(version)})


def _flags(min_history: int) -> dict[str, Column]:
    return {
        "is_penny_stock": F.col("close") < 1.0,
        "has_outlier_return": F.abs("daily_return") > OUTLIER_RETURN_PCT,
        "low_liquidity": F.col("volume") < LOW_VOLUME,
        "insufficient_history": F.coalesce(F.col("__n") < min_history, F.lit(False)),
    }


def quality_flags(df: DataFrame, min_history: int = MIN_HISTORY) -> DataFrame:
    """Four flags per row."""
    sized = timeblocks.series_size(df, ["ticker"], ["date"], "__n")
    return sized.withColumns(_flags(min_history)).drop("__n")


FLAGS = ("is_penny_stock", "has_outlier_return", "low_liquidity", "insufficient_history")


def flag_counts(df: DataFrame) -> DataFrame:
    """How many rows carry each flag, and how many none: one row."""
    clear = F.lit(True)
    for c in FLAGS:
        clear = clear & ~F.coalesce(F.col(c), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c)).alias(c) for c in FLAGS],
        F.count_if(clear).alias("high_quality"),
    )


def clean_bars(df: DataFrame, *dims: DataFrame, version: str = "silver_v1") -> DataFrame:
    """Raw bars to the cleaned table: names, dates, duplicates, nulls, gates,
    returns, sector, stamp, flags, in that order.

    The source is read once: the rows that pass the gates are written to the
    shared folder. Previous close and length of the series are one carry.
    """
    df = cast_date(no_nan(standardize_columns(df)))
    df = stage(quality_gates(drop_null_rows(deduplicate(df))), "clean-gated")
    by, order = ["ticker"], ["date"]
    carried = timeblocks.with_carries(
        df, by, order, timeblocks.before(order, {"__prev": F.col("close")}), timeblocks.sizes(by, "__n"), keep_key=True)
    out = stamp(add_sector(carried.withColumn("daily_return", _return(0.0)).drop("__prev"), *dims).drop(timeblocks.KEY), version)
    return out.withColumns(_flags(MIN_HISTORY)).drop("__n")


def append_new(existing: DataFrame, new: DataFrame, start=None) -> DataFrame:
    """``existing`` plus the rows of ``new`` dated after its newest day."""
    newest = existing.agg(F.max("date").alias("m")).scalar()
    fresh = new.where(F.col("date") > F.coalesce(newest, F.lit("0001-01-01").cast("date")))
    if start is not None:
        fresh = fresh.where(F.col("date") >= F.lit(start).cast("date"))
    return existing.unionByName(fresh, allowMissingColumns=True)


def minimal_clean(df: DataFrame) -> DataFrame:
    return df.dropna().distinct()


def last_close(df: DataFrame) -> DataFrame:
    """Newest non-null close per ticker: (ticker, last_price)."""
    when = F.when(F.col("close").isNotNull(), F.col("date"))
    return df.groupBy("ticker").agg(F.max_by("close", when).alias("last_price")).dropna(
        subset=["last_price"]
    )


def refresh_prices(metrics: DataFrame, live: DataFrame, at: Column | None = None) -> DataFrame:
    """Overwrite ``last_price`` where ``live`` (ticker, last_price) has one.

    If ``live`` has the time ``last_ts`` of its prices, that is the stamp, and
    only prices newer than a ticker's ``updated_at`` count.
    """
    timed = "last_ts" in live.columns
    new = live.select("ticker", F.col("last_price").alias("__new"), *([F.col("last_ts").cast("timestamp").alias("__ts")] if timed else []))
    out = metrics.join(new, "ticker", "left")
    if timed:
        at = F.col("__ts")
        if "updated_at" in metrics.columns:
            newer = F.col("updated_at").isNull() | (at > F.col("updated_at"))
            out = out.withColumn("__new", F.when(newer, F.col("__new")))
    cols = {"last_price": F.coalesce(F.col("__new"), F.col("last_price"))}
    stamped = F.when(F.col("__new").isNotNull(), at if at is not None else F.current_timestamp())
    if "updated_at" in metrics.columns:
        stamped = F.coalesce(stamped, F.col("updated_at"))
    return out.withColumns({**cols, "updated_at": stamped}).drop("__new", "__ts")
