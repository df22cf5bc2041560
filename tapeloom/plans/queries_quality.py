"""Validation, quality and calendar queries."""

from dataclasses import replace

from pyspark.sql import functions as F

from tapeloom.contracts import CONTRACTS, DATE, DOUBLE, LONG, STRING
from tapeloom.operators import calendars, quality
from tapeloom.plans import fixtures as fx
from tapeloom.plans.queries_clean import clean_table, silver
from tapeloom.plans.registry import query, view

INF = "'inf'::DOUBLE"

# a metric table with planted faults: infinities, tiny prices, wrong signs
view("metric_faults", """
  SELECT ticker, first_price, last_price,
    CASE WHEN n % 7 = 0 THEN 67450897.0 WHEN n % 5 = 0 THEN 'inf'::DOUBLE ELSE r END::DOUBLE AS avg_daily_return,
    CASE WHEN n % 6 = 0 THEN -v ELSE v END AS volatility,
    CASE WHEN n % 4 = 0 THEN -dd ELSE dd END AS max_drawdown,
    CASE WHEN n % 9 = 0 THEN NULL ELSE v * 100 END AS sharpe_ratio, n AS volume
  FROM (SELECT ticker, count(*) AS n, stddev(daily_return) AS v, avg(daily_return) / 100 AS r,
               min(close) / 100 - 1 AS dd,
               CASE WHEN count(*) % 3 = 0 THEN 6e-5::DOUBLE ELSE min_by(close, date) END AS first_price,
               CASE WHEN count(*) % 8 = 0 THEN -1.0::DOUBLE ELSE max_by(close, date) END AS last_price
        FROM silver GROUP BY ticker)""")


def metric_faults(spark, sf):
    base = silver(spark, sf).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.stddev("daily_return").alias("v"),
        (F.avg("daily_return") / 100).alias("r"), (F.min("close") / 100 - 1).alias("dd"),
        F.min_by("close", "date").alias("f"), F.max_by("close", "date").alias("l"))
    n = F.col("n")
    return base.select(
        "ticker",
        F.when(n % 3 == 0, F.lit(6e-5)).otherwise(F.col("f")).alias("first_price"),
        F.when(n % 8 == 0, F.lit(-1.0)).otherwise(F.col("l")).alias("last_price"),
        F.when(n % 7 == 0, F.lit(67450897.0)).when(n % 5 == 0, F.lit(float("inf")))
        .otherwise(F.col("r")).alias("avg_daily_return"),
        F.when(n % 6 == 0, -F.col("v")).otherwise(F.col("v")).alias("volatility"),
        F.when(n % 4 == 0, -F.col("dd")).otherwise(F.col("dd")).alias("max_drawdown"),
        F.when(n % 9 != 0, F.col("v") * 100).alias("sharpe_ratio"),
        n.alias("volume"))


def _text(df):
    """Examples as one rounded text column, for comparison."""
    digits = F.transform("examples", lambda x: F.round(x.cast("double"), 4).try_cast("decimal(20,4)").cast("string"))
    return df.withColumn("examples", F.array_join(digits, ","))


def _examples_sql(rows: str) -> str:
    """SQL of (column, invalid_count, examples) from rows (column, value)."""
    return f"""
  SELECT c AS "column", CAST(sum(n) AS BIGINT) AS invalid_count,
         string_agg(CAST(TRY_CAST(round(v, 4) AS DECIMAL(20,4)) AS VARCHAR), ',' ORDER BY v) FILTER (rk <= 5) AS examples
  FROM (SELECT c, v, count(*) AS n, row_number() OVER (PARTITION BY c ORDER BY v) AS rk
        FROM ({rows}) GROUP BY c, v) GROUP BY c"""


def _bad_rows(conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS c, {c}::DOUBLE AS v FROM metric_faults WHERE {cond}" for c, cond in conditions.items())


RANGE_SQL = _bad_rows({
    c: f"({c} < {lo} OR {c} > {hi if hi != float('inf') else INF})"
    for c, (lo, hi) in quality.VALID_RANGES.items()
    if c in ("first_price", "last_price", "avg_daily_return", "sharpe_ratio", "volatility", "max_drawdown", "volume")
})
SIGN_SQL = _bad_rows({
    "first_price": "first_price < 0", "last_price": "last_price < 0", "volume": "volume < 0",
    "volatility": "volatility < 0", "max_drawdown": "max_drawdown > 0"})
NUMERIC = ("first_price", "last_price", "avg_daily_return", "volatility", "max_drawdown", "sharpe_ratio", "volume")
NAN_SQL = " UNION ALL ".join(
    f"SELECT 'warning' AS severity, 'nan' AS issue, '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS invalid_count FROM metric_faults"
    f" UNION ALL SELECT 'error', 'inf', '{c}', count(*) FILTER (abs({c}) = {INF}) FROM metric_faults"
    for c in NUMERIC)
FORMAT_SQL = """
  SELECT 'raw' AS c, replace(CAST(CAST(close AS DECIMAL(20,2)) AS VARCHAR), '7', '.') AS v FROM bars
  WHERE length(replace(CAST(CAST(close AS DECIMAL(20,2)) AS VARCHAR), '7', '.'))
      - length(replace(replace(CAST(CAST(close AS DECIMAL(20,2)) AS VARCHAR), '7', '.'), '.', '')) > 1"""


@query("validate_bars", "V01", """
  SELECT 'missing' AS "check", 'volume' AS "column", 'absent' AS detail, 1::BIGINT AS "count"
  UNION ALL SELECT 'type', 'high', 'string', 1
  UNION ALL SELECT 'null', 'close', 'null in critical column', count(*) FROM bars_dirty WHERE close = 0""")
def _(spark, sf):
    d = fx.bars_dirty(spark, sf)
    return quality.validate_bars(d.select(
        "date", "ticker", "open", F.col("high").cast("string").alias("high"), "low",
        F.nullif("close", F.lit(0.0)).alias("close")))


@query("validate_contract", "V02", """
  SELECT 'missing_column' AS issue, 'industry' AS "column", 1::BIGINT AS "count", NULL AS examples
  UNION ALL SELECT 'null', 'open', count(*), NULL FROM bars_dirty WHERE open IS NULL
  UNION ALL
  SELECT 'value_not_allowed', 'ticker', CAST(sum(n) AS BIGINT), string_agg(ticker, ',' ORDER BY ticker) FILTER (rk <= 5)
  FROM (SELECT ticker, count(*) AS n, row_number() OVER (ORDER BY ticker) AS rk FROM bars_dirty
        WHERE ticker NOT IN ('SPY', 'S1', 'S2') GROUP BY ticker)""")
def _(spark, sf):
    contract = replace(
        CONTRACTS["silver_enriched_stocks"], allowed={"ticker": ("SPY", "S1", "S2")},
        columns=(("date", DATE, False), ("ticker", STRING, False), ("open", DOUBLE, False), ("close", DOUBLE, False),
                 ("volume", LONG, False), ("industry", STRING, False)))
    out = quality.validate_contract(fx.bars_dirty(spark, sf), contract)
    return out.withColumn("examples", F.array_join("examples", ","))


@query("validate_contract_strict", "V02", """
  SELECT 'type' AS issue, 'volume' AS "column", 1::BIGINT AS "count"
  UNION ALL SELECT 'null', 'open', count(*) FROM bars_dirty WHERE open IS NULL
  UNION ALL SELECT 'duplicate_key', 'date,ticker', count(*) - count(DISTINCT (date, ticker)) FROM bars_dirty""")
def _(spark, sf):
    contract = replace(
        CONTRACTS["silver_enriched_stocks"], key=("date", "ticker"),
        columns=(("date", DATE, False), ("ticker", STRING, False), ("open", DOUBLE, False), ("volume", DOUBLE, True)))
    return quality.validate_contract(fx.bars_dirty(spark, sf), contract, strict=True).drop("examples")


@query("validate_ranges", "V04", "SELECT 'error' AS severity, 'range' AS issue, * FROM (" + _examples_sql(RANGE_SQL) + ")")
def _(spark, sf):
    return _text(quality.range_violations(metric_faults(spark, sf)))


@query("validate_ranges_with_change", "V04", """
  SELECT 'error' AS severity, 'range' AS issue, 'price_change_pct' AS "column", count(*) AS invalid_count
  FROM (SELECT (max_by(close, date) / min_by(close, date) - 1) * 100 * 400 AS p FROM bars GROUP BY ticker)
  WHERE p < -99 OR p > 10000 HAVING count(*) > 0""")
def _(spark, sf):
    change = F.max_by("close", "date") / F.min_by("close", "date") - 1
    d = fx.bars(spark, sf).groupBy("ticker").agg((change * 100 * 400).alias("price_change_pct"))
    return quality.range_violations(d, quality.VALID_RANGES_WITH_CHANGE).drop("examples")


@query("validate_signs", "V05", "SELECT 'error' AS severity, 'sign' AS issue, * FROM (" + _examples_sql(SIGN_SQL) + ")")
def _(spark, sf):
    return _text(quality.sign_violations(metric_faults(spark, sf)))


@query("validate_signs_strict", "V05", """
  SELECT 'error' AS severity, 'sign' AS issue, 'volume' AS "column", count(*) AS invalid_count
  FROM bars_dirty WHERE volume <= 0""")
def _(spark, sf):
    return quality.sign_violations(
        fx.bars_dirty(spark, sf).select("volume"), strict=True).drop("examples")


@query("validate_nan_inf", "V06", f"SELECT * FROM ({NAN_SQL}) WHERE invalid_count > 0")
def _(spark, sf):
    return quality.nan_inf_violations(metric_faults(spark, sf)).drop("examples")


def _raw_numbers(spark, sf):
    text = F.col("close").cast("decimal(20,2)").cast("string")
    return fx.bars(spark, sf).select(F.replace(text, F.lit("7"), F.lit(".")).alias("raw"))


@query("validate_number_format", "V07", f"""
  SELECT 'error' AS severity, 'number_format' AS issue, 'raw' AS "column", count(*) AS invalid_count,
         (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT v FROM ({FORMAT_SQL}) ORDER BY v LIMIT 5)) AS examples
  FROM ({FORMAT_SQL})""")
def _(spark, sf):
    out = quality.numeric_format_violations(_raw_numbers(spark, sf))
    return out.withColumn("examples", F.array_join("examples", ","))


@query("validate_issues", "V08", f"""
  SELECT 'error' AS severity, 'range' AS issue, "column", invalid_count FROM ({_examples_sql(RANGE_SQL)})
  UNION ALL SELECT 'error', 'sign', "column", invalid_count FROM ({_examples_sql(SIGN_SQL)})
  UNION ALL SELECT * FROM ({NAN_SQL}) WHERE invalid_count > 0""")
def _(spark, sf):
    return quality.validation_issues(metric_faults(spark, sf)).drop("examples")


@query("validate_report", "V08", f"""
  WITH issues AS (
    SELECT 'error' AS severity FROM ({_examples_sql(RANGE_SQL)})
    UNION ALL SELECT 'error' FROM ({_examples_sql(SIGN_SQL)})
    UNION ALL SELECT severity FROM ({NAN_SQL}) WHERE invalid_count > 0)
  SELECT count(*) FILTER (severity = 'error') = 0 AS is_valid, count(*) AS total_issues,
         count(*) FILTER (severity = 'error') AS error_count, count(*) FILTER (severity = 'warning') AS warning_count,
         (SELECT count(*) FROM metric_faults) AS rows_checked FROM issues""")
def _(spark, sf):
    return quality.validation_report(metric_faults(spark, sf))


@query("validate_row_flags", "V09", """
  SELECT ticker, coalesce(last_price BETWEEN 0.01 AND 1000000, FALSE) AS valid_price,
         coalesce(abs(avg_daily_return) <= 1, FALSE) AS valid_return,
         coalesce(sharpe_ratio BETWEEN -5 AND 10, FALSE) AS valid_sharpe,
         coalesce(max_drawdown BETWEEN -100 AND 0, FALSE) AS valid_drawdown FROM metric_faults""")
def _(spark, sf):
    out = quality.flag_valid(metric_faults(spark, sf), price="last_price", ret="avg_daily_return")
    return out.select("ticker", "valid_price", "valid_return", "valid_sharpe", "valid_drawdown")


METRICS = "first_price last_price avg_daily_return volatility max_drawdown sharpe_ratio"


@query("clean_metrics", "V10", """
  SELECT ticker, CASE WHEN first_price >= 0.001 THEN first_price END AS first_price,
         CASE WHEN last_price >= 0.001 THEN last_price END AS last_price,
         CASE WHEN abs(avg_daily_return) <= 10 THEN avg_daily_return END AS avg_daily_return, volatility,
         -abs(max_drawdown) AS max_drawdown, sharpe_ratio, volume FROM metric_faults""", METRICS)
def _(spark, sf):
    return quality.clean_metrics(metric_faults(spark, sf))


@query("clean_metrics_clip", "V11", f"""
  SELECT ticker, CASE WHEN first_price > 0 THEN first_price END AS first_price,
         CASE WHEN last_price > 0 THEN last_price END AS last_price,
         CASE WHEN avg_daily_return < {INF} THEN greatest(-1, least(1, avg_daily_return)) END AS avg_daily_return,
         volatility, -abs(max_drawdown) AS max_drawdown, sharpe_ratio, volume FROM metric_faults""", METRICS)
def _(spark, sf):
    return quality.clean_metrics(metric_faults(spark, sf), mode="clip")


@query("clean_adjust_splits", "V12", """
  SELECT ticker, date, close / coalesce((SELECT product(ratio) FROM splits s
         WHERE s.ticker = b.ticker AND s.split_date > b.date), 1) AS price FROM bars b""", "price")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date", F.col("close").alias("price"))
    return quality.adjust_splits(b, fx.splits(spark, sf))


DIRTY = ("ticker", "date", "open", "high", "low", "close", "volume", "ingested_at")
NULLS = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in DIRTY)
SURPLUS = "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"


@query("quality_profile", "V13", f"""
  SELECT 'bronze' AS layer, 'raw' AS step, count(*) AS row_count, {len(DIRTY)}::BIGINT AS column_count,
         {NULLS} AS total_nulls, ({NULLS})::DOUBLE / (count(*) * {len(DIRTY)}) AS null_rate,
         {" || ' ' || ".join(f"'{c}=' || count(*) FILTER ({c} IS NULL)" for c in DIRTY)} AS null_counts,
         CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max,
         count(DISTINCT ticker) AS ticker_count, {SURPLUS.format(t="bars_dirty")} AS duplicate_rows FROM bars_dirty""", "null_rate")
def _(spark, sf):
    out = quality.profile(fx.bars_dirty(spark, sf).select(*DIRTY), "bronze", "raw").drop("columns")
    shown = F.transform(F.map_entries("null_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return out.withColumn("null_counts", F.array_join(shown, " "))


@query("quality_compare", "V14", """
  SELECT 'bronze' AS layer1, 'silver' AS layer2, a AS rows_layer1, b AS rows_layer2, a - b AS rows_dropped,
         (a - b)::DOUBLE / a AS drop_rate,
         CASE WHEN (a - b)::DOUBLE / a > 0.05 THEN 'high' WHEN (a - b)::DOUBLE / a > 0.01 THEN 'moderate' ELSE 'low' END AS alert,
         'daily_return,sector,industry,data_version,is_penny_stock,has_outlier_return,low_liquidity,insufficient_history' AS columns_added,
         '' AS columns_removed
  FROM (SELECT (SELECT count(*) FROM bars_dirty) AS a, (SELECT count(*) FROM clean_table) AS b)""", "drop_rate")
def _(spark, sf):
    out = quality.compare_profiles(
        quality.profile(fx.bars_dirty(spark, sf), "bronze", "raw"),
        quality.profile(clean_table(spark, sf), "silver", "clean"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("columns_added", "columns_removed")})


@query("quality_log_summary", "V15", f"""
  SELECT 'bronze' AS layer, 'raw' AS step, count(*) AS row_count, {len(DIRTY)}::BIGINT AS column_count,
         count(DISTINCT ticker) AS ticker_count, round(({NULLS})::DOUBLE / (count(*) * {len(DIRTY)}) * 100, 2) AS null_rate_pct,
         {SURPLUS.format(t="bars_dirty")} AS duplicate_rows FROM bars_dirty
  UNION ALL
  SELECT 'silver', 'clean', count(*), 16, count(DISTINCT ticker), 0, {SURPLUS.format(t="clean_table")} FROM clean_table""", "null_rate_pct")
def _(spark, sf):
    from tapeloom.sources.staging import shared_dir
    import uuid

    path = f"{shared_dir(spark)}/quality-log-{uuid.uuid4().hex}"
    quality.log_profile(quality.profile(fx.bars_dirty(spark, sf), "bronze", "raw"), path)
    quality.log_profile(quality.profile(clean_table(spark, sf), "silver", "clean"), path)
    return quality.quality_summary(quality.load_quality_log(spark, path, last=10)).drop("timestamp")


@query("quality_quick_check", "V16", f"""
  WITH t AS (SELECT ticker, count(*) AS n FROM bars_dirty GROUP BY ticker),
  r AS (SELECT count(*) AS row_count, {len(DIRTY)}::BIGINT AS column_count, {NULLS} AS total_nulls,
               {SURPLUS.format(t="bars_dirty")} AS duplicate_rows,
               CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max FROM bars_dirty)
  SELECT r.*, s.* FROM r, (SELECT count(*) AS tickers, min(n) AS min_rows, max(n) AS max_rows,
                                  quantile_cont(n, 0.5) AS median_rows FROM t) s""", "median_rows")
def _(spark, sf):
    return quality.quick_check(fx.bars_dirty(spark, sf))


@query("quality_duplicates", "V22", f"""
  SELECT {SURPLUS.format(t="bars_dirty")} AS duplicate_rows,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT ticker, date FROM bars_dirty)) AS duplicate_keys
  FROM bars_dirty""")
def _(spark, sf):
    return quality.duplicate_counts(fx.bars_dirty(spark, sf))


@query("quality_duplicate_texts", "V22", """
  WITH d AS (SELECT text, lang, source, n_chars FROM documents)
  SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS duplicate_rows,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source FROM d)) AS duplicate_keys FROM d""")
def _(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang", "source", "n_chars")
    return quality.duplicate_counts(docs, ["lang", "source"])


@query("quality_window_summary", "V25", """
  SELECT count(*) AS "rows", min(date) AS first_date, max(date) AS last_date, count(DISTINCT ticker) AS tickers
  FROM bars WHERE date BETWEEN DATE '2000-11-05' AND DATE '2000-12-20'""")
def _(spark, sf):
    return quality.window_summary(fx.bars(spark, sf), "2000-11-05", "2000-12-20")


@query("quality_unknown_sector", "V21", """
  SELECT count(*) FILTER (sector = 'Unknown') AS unknown, count(*) AS total,
         count(*) FILTER (sector = 'Unknown')::DOUBLE / count(*) AS share,
         count(*) FILTER (sector = 'Unknown')::DOUBLE / count(*) > 0.2 AS alert FROM silver""", "share")
def _(spark, sf):
    return quality.unknown_sector_share(silver(spark, sf))


view("sparse_dates", "SELECT DISTINCT date FROM bars WHERE date_diff('day', DATE '1995-01-01', date) % 37 > 3")
view("missing_days", """
  SELECT CAST(d AS DATE) AS date FROM range((SELECT min(date) FROM sparse_dates)::TIMESTAMP,
         (SELECT max(date) FROM sparse_dates)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
  WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (SELECT date FROM sparse_dates)""")
view("gap_list", """
  SELECT min(date) AS gap_start, max(date) AS gap_end, count(*) AS missing_days
  FROM (SELECT date, sum(CASE WHEN date - p > 3 THEN 1 ELSE 0 END) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS isl
        FROM (SELECT date, lag(date) OVER (ORDER BY date) AS p FROM missing_days)) GROUP BY isl""")


def _sparse(spark, sf):
    k = F.datediff("date", F.lit("1995-01-01").cast("date"))
    return calendars.existing_dates(fx.bars(spark, sf).where(k % 37 > 3))


@query("calendar_existing_dates", "V17", "SELECT DISTINCT date FROM bars")
def _(spark, sf):
    return calendars.existing_dates(fx.bars(spark, sf))


@query("calendar_gaps", "V18", "SELECT * FROM gap_list")
def _(spark, sf):
    return calendars.detect_gaps(_sparse(spark, sf))


@query("calendar_gap_summary", "V19", """
  SELECT count(*) AS gaps, CAST(sum(gap_end - gap_start + 1) AS BIGINT) AS span_days,
         CAST(sum(missing_days) AS BIGINT) AS missing_days FROM gap_list""")
def _(spark, sf):
    return calendars.gap_summary(calendars.detect_gaps(_sparse(spark, sf)))


@query("calendar_longest_gaps", "V19", """
  SELECT gap_start, gap_end, CAST(gap_end - gap_start + 1 AS BIGINT) AS span_days FROM gap_list
  ORDER BY 3 DESC, 1 LIMIT 5""")
def _(spark, sf):
    return calendars.longest_gaps(calendars.detect_gaps(_sparse(spark, sf)))


@query("calendar_trading_days", "V20", """
  SELECT CAST(d AS DATE) AS date FROM range((SELECT min(date) FROM bars)::TIMESTAMP,
         (SELECT max(date) FROM bars)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
  WHERE isodow(d) <= 5 AND NOT (month(d) = 12 AND day(d) = 25) AND NOT (month(d) = 1 AND day(d) = 1)""")
def _(spark, sf):
    b = fx.bars(spark, sf)
    bounds = b.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    years = bounds.select(F.explode(F.sequence(F.year("start"), F.year("end"))).alias("y"))
    holidays = years.select(F.explode(F.array(
        F.make_date("y", F.lit(12), F.lit(25)), F.make_date("y", F.lit(1), F.lit(1)))).alias("date"))
    return calendars.trading_days(bounds, holidays)


@query("calendar_partition_lag", "V24", """
  SELECT max(date) AS newest, CAST(DATE '2001-12-31' - max(date) AS BIGINT) AS days_behind,
         count(*) FILTER (CAST(date AS VARCHAR) LIKE '2000-1%') AS in_prefix FROM (SELECT DISTINCT date FROM bars)""")
def _(spark, sf):
    return calendars.partition_lag(calendars.existing_dates(fx.bars(spark, sf)), "2001-12-31", "2000-1")
