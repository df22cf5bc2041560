"""Cleaning queries."""

from pyspark.sql import functions as F

from tapeloom.operators import clean
from tapeloom.plans import fixtures as fx
from tapeloom.plans.registry import query, view
from tapeloom.sources.staging import staged_once

PRICES = "open high low close"

view("dedup_bars", """
  SELECT ticker, date, open, high, low, close, volume, ingested_at FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY ingested_at DESC) AS rk FROM bars_dirty)
  WHERE rk = 1""")
view("gated_bars", """
  SELECT * FROM dedup_bars WHERE close > 0 AND high >= low AND volume >= 0 AND open > 0""")
view("returned_bars", """
  SELECT *, coalesce((close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100, 0) AS daily_return
  FROM bars""")
view("clean_table", """
  SELECT b.*, coalesce(m.sector, 'Unknown') AS sector, coalesce(m.industry, 'Unknown') AS industry,
         'silver_v1' AS data_version, close < 1 AS is_penny_stock, abs(daily_return) > 50 AS has_outlier_return,
         volume < 10000 AS low_liquidity,
         count(*) OVER (PARTITION BY b.ticker) < 252 AS insufficient_history
  FROM (SELECT *, coalesce((close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100, 0) AS daily_return
        FROM gated_bars) b LEFT JOIN metadata m USING (ticker)""")
view("silver", """
  SELECT b.*, coalesce(m.sector, 'Unknown') AS sector, coalesce(m.industry, 'Unknown') AS industry
  FROM returned_bars b LEFT JOIN metadata m USING (ticker)""")


def _build_silver(spark, sf):
    return clean.add_sector(clean.daily_return(fx.bars(spark, sf)), fx.metadata(spark, sf))


def silver(spark, sf):
    """Bars with returns and sector: what the gold operators read."""
    return staged_once(spark, sf, "silver", lambda: _build_silver(spark, sf))


def _build_clean(spark, sf):
    return clean.clean_bars(fx.bars_dirty(spark, sf), fx.metadata(spark, sf)).drop("enriched_at")


def clean_table(spark, sf):
    return staged_once(spark, sf, "clean_table", lambda: _build_clean(spark, sf))


@query("clean_standardize_columns", "C01",
       "SELECT date, ticker, close AS adj_close, volume FROM bars", "adj_close")
def _(spark, sf):
    raw = fx.bars(spark, sf).select(
        F.col("date").alias("Date"), F.col("ticker").alias("Ticker"),
        F.col("close").alias("Adj Close"), F.col("volume").alias("Volume"))
    return clean.standardize_columns(raw)


@query("clean_cast_date", "C02", """
  SELECT ticker, date, close FROM bars WHERE volume % 7000 <> 0""", "close")
def _(spark, sf):
    text = F.when(F.col("volume") % 7000 == 0, F.lit("n/a")).otherwise(F.col("date").cast("string"))
    return clean.cast_date(
        fx.bars(spark, sf).select("ticker", text.alias("date"), "close"), strict=False)


@query("clean_deduplicate", "C03", "SELECT * FROM dedup_bars", PRICES)
def _(spark, sf):
    return clean.deduplicate(fx.bars_dirty(spark, sf))


@query("clean_drop_nulls", "C04", "SELECT * FROM bars_dirty WHERE open IS NOT NULL", PRICES)
def _(spark, sf):
    return clean.drop_null_rows(fx.bars_dirty(spark, sf), ["ticker", "date", "open", "absent"])


@query("clean_null_counts", "C04", """
  SELECT "column", null_count FROM (
    UNPIVOT (SELECT count(*) FILTER (ticker IS NULL) AS ticker, count(*) FILTER (date IS NULL) AS date,
             count(*) FILTER (open IS NULL) AS open, count(*) FILTER (high IS NULL) AS high,
             count(*) FILTER (low IS NULL) AS low, count(*) FILTER (close IS NULL) AS close,
             count(*) FILTER (volume IS NULL) AS volume, count(*) FILTER (ingested_at IS NULL) AS ingested_at FROM bars_dirty)
    ON COLUMNS(*) INTO NAME "column" VALUE null_count)""")
def _(spark, sf):
    return clean.null_counts(fx.bars_dirty(spark, sf))


@query("clean_quality_gates", "C05", "SELECT * FROM gated_bars", PRICES)
def _(spark, sf):
    return clean.quality_gates(clean.deduplicate(fx.bars_dirty(spark, sf)))


@query("clean_gate_counts", "C05", """
  SELECT count(*) FILTER (NOT a) AS removed_close, count(*) FILTER (a AND NOT b) AS removed_high_low,
         count(*) FILTER (a AND b AND NOT c) AS removed_volume,
         count(*) FILTER (a AND b AND c AND NOT d) AS removed_open,
         count(*) FILTER (a AND b AND c AND d) AS kept, count(*) AS "rows"
  FROM (SELECT coalesce(close > 0, FALSE) a, coalesce(high >= low, FALSE) b,
               coalesce(volume >= 0, FALSE) c, coalesce(open > 0, FALSE) d FROM bars_dirty)""")
def _(spark, sf):
    return clean.gate_counts(fx.bars_dirty(spark, sf))


@query("clean_daily_return", "C06", "SELECT * FROM returned_bars", PRICES + " daily_return")
def _(spark, sf):
    return clean.daily_return(fx.bars(spark, sf))


@query("clean_add_sector", "C07", """
  SELECT b.ticker, b.date, b.close, coalesce(m.sector, 'Unknown') AS sector,
         coalesce(m.industry, 'Unknown') AS industry
  FROM bars b LEFT JOIN metadata m USING (ticker)""", "close")
def _(spark, sf):
    return clean.add_sector(fx.bars(spark, sf).select("ticker", "date", "close"), fx.metadata(spark, sf))


@query("clean_stamp", "C08", """
  SELECT ticker, date, 'silver_v1' AS data_version, TRUE AS stamped FROM bars""")
def _(spark, sf):
    out = clean.stamp(fx.bars(spark, sf).select("ticker", "date"), "silver_v1")
    return out.withColumn("stamped", F.col("enriched_at").isNotNull()).drop("enriched_at")


@query("clean_quality_flags", "C09", """
  SELECT ticker, date, is_penny_stock, has_outlier_return, low_liquidity, insufficient_history FROM clean_table""")
def _(spark, sf):
    src = clean.daily_return(clean.quality_gates(clean.deduplicate(fx.bars_dirty(spark, sf))))
    return clean.quality_flags(src).select("ticker", "date", *clean.FLAGS)


@query("clean_flag_counts", "C09", """
  SELECT count(*) AS "rows", count(*) FILTER (is_penny_stock) AS is_penny_stock,
         count(*) FILTER (has_outlier_return) AS has_outlier_return,
         count(*) FILTER (low_liquidity) AS low_liquidity,
         count(*) FILTER (insufficient_history) AS insufficient_history,
         count(*) FILTER (NOT is_penny_stock AND NOT has_outlier_return AND NOT low_liquidity
                          AND NOT insufficient_history) AS high_quality
  FROM clean_table""")
def _(spark, sf):
    return clean.flag_counts(clean_table(spark, sf))


@query("clean_bars_full", "C10", "SELECT * FROM clean_table", PRICES + " daily_return")
def _(spark, sf):
    return clean.clean_bars(fx.bars_dirty(spark, sf), fx.metadata(spark, sf)).drop("enriched_at")


@query("clean_append_new", "C11", """
  WITH old AS (SELECT * FROM bars WHERE date <= DATE '2000-06-30')
  SELECT * FROM old UNION ALL
  SELECT * FROM bars WHERE date > (SELECT max(date) FROM old) AND date >= DATE '2000-08-01'""", PRICES)
def _(spark, sf):
    b = fx.bars(spark, sf)
    old = b.where(F.col("date") <= F.lit("2000-06-30").cast("date"))
    return clean.append_new(old, b, start="2000-08-01")


@query("clean_minimal", "C12", """
  SELECT DISTINCT * FROM bars_dirty WHERE ticker IS NOT NULL AND date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL
         AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL AND ingested_at IS NOT NULL""", PRICES)
def _(spark, sf):
    return clean.minimal_clean(fx.bars_dirty(spark, sf))


@query("clean_last_close", "C14", """
  SELECT ticker, max_by(close, date) AS last_price FROM bars GROUP BY ticker""", "last_price")
def _(spark, sf):
    return clean.last_close(fx.bars(spark, sf))


@query("clean_refresh_prices", "C13", """
  WITH m AS (SELECT ticker, min(close) AS last_price FROM bars GROUP BY ticker),
  live AS (SELECT ticker, max_by(close, date) AS last_price FROM bars
           WHERE date >= DATE '2001-11-01' GROUP BY ticker)
  SELECT m.ticker, coalesce(live.last_price, m.last_price) AS last_price, live.ticker IS NOT NULL AS updated
  FROM m LEFT JOIN live USING (ticker)""", "last_price")
def _(spark, sf):
    b = fx.bars(spark, sf)
    metrics = b.groupBy("ticker").agg(F.min("close").alias("last_price"))
    live = clean.last_close(b.where(F.col("date") >= F.lit("2001-11-01").cast("date")))
    out = clean.refresh_prices(metrics, live)
    return out.withColumn("updated", F.col("updated_at").isNotNull()).drop("updated_at")
