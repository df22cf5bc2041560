"""Feature and model queries."""

from pyspark.sql import functions as F

from tapeloom.operators import features, models
from tapeloom.plans import fixtures as fx
from tapeloom.plans.queries_gold import market_days
from tapeloom.plans.queries_reference import econ_daily, news_table
from tapeloom.plans.registry import query, view
from tapeloom.sources.staging import staged_once

W = "PARTITION BY ticker ORDER BY date"


def _roll(agg: str, of: str, n: int) -> str:
    over = f"OVER ({W} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({of}) {over} = {n} THEN {agg}({of}) {over} END"


def _chg(n: int) -> str:
    return f"close / lag(close, {n}) OVER ({W}) - 1"


def _ema(name: str, of: str, src: str, n: int) -> str:
    """EMA as a recursion over row numbers."""
    a, b = 2 / (n + 1), 1 - 2 / (n + 1)
    return f"""
  WITH RECURSIVE {name}_r AS (
    SELECT ticker, rn, {of} AS e FROM {src} WHERE rn = 1
    UNION ALL
    SELECT s.ticker, s.rn, {a!r}::DOUBLE * s.{of} + {b!r}::DOUBLE * r.e
    FROM {name}_r r JOIN {src} s ON s.ticker = r.ticker AND s.rn = r.rn + 1)
  SELECT ticker, rn, e FROM {name}_r"""


view("bars_rn", f"SELECT ticker, date, close, row_number() OVER ({W}) AS rn FROM bars")
view("ema12", _ema("ema12", "close", "bars_rn", 12))
view("ema26", _ema("ema26", "close", "bars_rn", 26))
view("macd_line", "SELECT ticker, rn, a.e - b.e AS m FROM ema12 a JOIN ema26 b USING (ticker, rn)")
view("ema9", _ema("ema9", "m", "macd_line", 9))
view("ema_table", """
  SELECT b.ticker, b.date, a.e AS ema_12, c.e AS ema_26, l.m AS macd, s.e AS macd_signal, l.m - s.e AS macd_hist
  FROM bars_rn b JOIN ema12 a USING (ticker, rn) JOIN ema26 c USING (ticker, rn)
  JOIN macd_line l USING (ticker, rn) JOIN ema9 s USING (ticker, rn)""")
view("sma_table", "SELECT ticker, date, " + ", ".join(
    f"{_roll('avg', 'close', n)} AS sma_{n}" for n in features.SMA_PERIODS) + " FROM bars")
view("rsi_table", f"""
  SELECT ticker, date, CASE WHEN l <> 0 THEN 100 - 100 / (1 + g / l) END AS rsi
  FROM (SELECT ticker, date, {_roll('avg', 'up', 14)} AS g, {_roll('avg', 'down', 14)} AS l
        FROM (SELECT ticker, date, greatest(d, 0) AS up, greatest(-d, 0) AS down
              FROM (SELECT ticker, date, coalesce(close - lag(close) OVER ({W}), 0) AS d FROM bars)))""")
view("change_table", "SELECT ticker, date, " + ", ".join(
    [f"({_chg(n)}) * 100 AS roc_{n}" for n in features.ROC_PERIODS]
    + [f"{_chg(n)} AS return_{n}d" for n in features.RETURN_PERIODS]) + " FROM bars")
view("bands_table", f"""
  SELECT ticker, date, m AS bb_middle, m + 2 * s AS bb_upper, m - 2 * s AS bb_lower, 4 * s / m AS bb_width,
         (close - (m - 2 * s)) / (4 * s) AS bb_pct
  FROM (SELECT ticker, date, close, {_roll('avg', 'close', 20)} AS m, {_roll('stddev_samp', 'close', 20)} AS s FROM bars)""")
view("atr_table", f"""
  SELECT ticker, date, {_roll('avg', 'tr', 14)} AS atr FROM (
    SELECT ticker, date, greatest(high - low, abs(high - p), abs(low - p)) AS tr
    FROM (SELECT *, lag(close) OVER ({W}) AS p FROM bars))""")
view("vol_table", "SELECT ticker, date, " + ", ".join(
    f"{_roll('stddev_samp', 'r', n)} * sqrt(252) AS volatility_{n}" for n in features.VOLATILITY_PERIODS)
    + f" FROM (SELECT ticker, date, {_chg(1)} AS r FROM bars)")
view("volume_table", f"""
  SELECT ticker, date, volume / v AS volume_ratio, CASE WHEN obv > m THEN 1 ELSE -1 END::INTEGER AS obv_trend
  FROM (SELECT *, {_roll('avg', 'obv', 10)} AS m FROM (
    SELECT ticker, date, volume, {_roll('avg', 'volume', 20)} AS v, sum(flow) OVER ({W} ROWS UNBOUNDED PRECEDING) AS obv
    FROM (SELECT *, coalesce(sign(close - lag(close) OVER ({W})), 0) * volume AS flow FROM bars)))""")
view("target_table", f"""
  SELECT ticker, date, t AS target_return, CASE WHEN t > 0 THEN 1 ELSE 0 END::INTEGER AS target_direction
  FROM (SELECT ticker, date, lead(close) OVER ({W}) / close - 1 AS t FROM bars)""")

SMA = " ".join(f"sma_{n}" for n in features.SMA_PERIODS)
ROC = " ".join(f"roc_{n}" for n in features.ROC_PERIODS)
RET = " ".join(f"return_{n}d" for n in features.RETURN_PERIODS)
VOL = " ".join(f"volatility_{n}" for n in features.VOLATILITY_PERIODS)
BANDS = "bb_middle bb_upper bb_lower bb_width bb_pct"
MACD = "macd macd_signal macd_hist"
ALL = f"{SMA} ema_12 ema_26 rsi {MACD} {ROC} {BANDS} atr {VOL} volume_ratio {RET} target_return"
EXTRA = "VIX vix_regime vix_change_5d EFFR rate_change_20d news_sentiment news_attention sentiment_ma5"
# blocks far shorter than a series, so that every check crosses block borders
SMALL = 200


def _bars(spark, sf):
    return fx.bars(spark, sf)


def _only(df, *cols):
    return df.select("ticker", "date", *cols)


@query("features_sma", "F01", "SELECT * FROM sma_table", SMA)
def _(spark, sf):
    return _only(features.sma(_bars(spark, sf), block_rows=SMALL), *SMA.split())


@query("features_ema", "F02", "SELECT ticker, date, ema_12, ema_26 FROM ema_table", "ema_12 ema_26")
def _(spark, sf):
    return _only(features.ema(_bars(spark, sf)), "ema_12", "ema_26")


@query("features_rsi", "F03", "SELECT * FROM rsi_table", "rsi")
def _(spark, sf):
    return _only(features.rsi(_bars(spark, sf), block_rows=SMALL), "rsi")


@query("features_macd", "F04", "SELECT ticker, date, macd, macd_signal, macd_hist FROM ema_table", MACD)
def _(spark, sf):
    return _only(features.macd(_bars(spark, sf)), *MACD.split())


@query("features_roc", "F05", f"SELECT ticker, date, {ROC.replace(' ', ', ')} FROM change_table", ROC)
def _(spark, sf):
    return _only(features.roc(_bars(spark, sf), block_rows=SMALL), *ROC.split())


@query("features_bollinger", "F06", "SELECT * FROM bands_table", BANDS)
def _(spark, sf):
    return _only(features.bollinger(_bars(spark, sf), block_rows=SMALL), *BANDS.split())


@query("features_atr", "F07", "SELECT * FROM atr_table", "atr")
def _(spark, sf):
    return _only(features.atr(_bars(spark, sf), block_rows=SMALL), "atr")


@query("features_volatility", "F08", "SELECT * FROM vol_table", VOL)
def _(spark, sf):
    return _only(features.rolling_volatility(_bars(spark, sf), block_rows=SMALL), *VOL.split())


@query("features_volume", "F09", "SELECT * FROM volume_table", "volume_ratio")
def _(spark, sf):
    return _only(features.volume_features(_bars(spark, sf), block_rows=SMALL), "volume_ratio", "obv_trend")


@query("features_returns", "F10", f"SELECT ticker, date, {RET.replace(' ', ', ')} FROM change_table", RET)
def _(spark, sf):
    return _only(features.returns(_bars(spark, sf), block_rows=SMALL), *RET.split())


@query("features_target", "F11", "SELECT * FROM target_table", "target_return")
def _(spark, sf):
    return _only(features.target(_bars(spark, sf), block_rows=SMALL), "target_return", "target_direction")


view("feature_table", """
  SELECT b.*, sma_table.* EXCLUDE (ticker, date), ema_table.* EXCLUDE (ticker, date), rsi_table.* EXCLUDE (ticker, date),
         change_table.* EXCLUDE (ticker, date), bands_table.* EXCLUDE (ticker, date), atr_table.* EXCLUDE (ticker, date),
         vol_table.* EXCLUDE (ticker, date), volume_table.* EXCLUDE (ticker, date), target_table.* EXCLUDE (ticker, date),
         e.* EXCLUDE (date), n.* EXCLUDE (ticker, date)
  FROM bars b JOIN sma_table USING (ticker, date) JOIN ema_table USING (ticker, date) JOIN rsi_table USING (ticker, date)
       JOIN change_table USING (ticker, date) JOIN bands_table USING (ticker, date) JOIN atr_table USING (ticker, date)
       JOIN vol_table USING (ticker, date) JOIN volume_table USING (ticker, date) JOIN target_table USING (ticker, date)
       JOIN econ_trading_days e USING (date) JOIN bars_news n USING (ticker, date)""")


def feature_table(spark, sf):
    return features.engineer_features(_bars(spark, sf), econ_daily(spark, sf), news_table(spark, sf))


@query("features_full", "F12", "SELECT * FROM feature_table", f"open high low close {ALL} {EXTRA}", digits=5)
def _(spark, sf):
    return feature_table(spark, sf)


STATS = features.FEATURE_COLUMNS


@query("features_describe", "F13", f"""
  SELECT feature, count(v) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS "min", max(v) AS "max",
         quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
  FROM (UNPIVOT (SELECT {", ".join(f"{c}::DOUBLE AS {c}" for c in STATS)} FROM feature_table) ON COLUMNS(*) INTO NAME feature VALUE v)
  GROUP BY feature""", 'mean std "min" "max" q25 q50 q75'.replace('"', ""))
def _(spark, sf):
    return features.describe_features(feature_table(spark, sf), STATS)


def model_table(spark, sf):
    """What the forest reads again and again: all features and the target."""
    return staged_once(spark, sf, "features", lambda: feature_table(spark, sf).select(
        *features.FEATURE_COLUMNS, "target_direction"))


def importance(spark, sf):
    """100 trees of depth 10 on all features, once per table."""
    return staged_once(spark, sf, "importance", lambda: models.feature_importance(
        model_table(spark, sf), features.FEATURE_COLUMNS))


@query("model_feature_importance", "L01")
def _(spark, sf):
    return importance(spark, sf)


@query("model_top_features", "L02")
def _(spark, sf):
    return models.top_features(importance(spark, sf))


view("effects", """
  SELECT m.date, m.avg_return, e.vix, e.fed_funds_rate, e.cpi FROM market_days m JOIN econ_filled e USING (date)""")


def effects(spark, sf):
    e = econ_daily(spark, sf).select("date", "vix", "fed_funds_rate", "cpi")
    return staged_once(spark, sf, "effects", lambda: market_days(spark, sf).join(e, "date").select(
        "date", "avg_return", "vix", "fed_funds_rate", "cpi"))


TREATMENTS = ("vix", "fed_funds_rate", "cpi")


def _two_sample_sql(c):
    return f"""
  SELECT '{c}' AS treatment, nt AS treated, nc AS control, mt - mc AS effect,
         CASE WHEN nt > 5 AND nc > 5 THEN (mt - mc) / sqrt(((nt - 1) * vt + (nc - 1) * vc) / (nt + nc - 2) * (1::DOUBLE / nt + 1::DOUBLE / nc)) END AS t_value
  FROM (SELECT count(*) FILTER (x) AS nt, count(*) FILTER (NOT x) AS nc, avg(y) FILTER (x) AS mt, avg(y) FILTER (NOT x) AS mc,
               var_samp(y) FILTER (x) AS vt, var_samp(y) FILTER (NOT x) AS vc
        FROM (SELECT avg_return AS y, {c} > (SELECT median({c}) FROM effects) AS x FROM effects WHERE {c} IS NOT NULL))"""


TWO_SAMPLE = " UNION ALL ".join(_two_sample_sql(c) for c in TREATMENTS)


@query("model_two_sample", "L03", TWO_SAMPLE, "effect t_value")
def _(spark, sf):
    return models.two_sample(effects(spark, sf), TREATMENTS, "avg_return")


# Student's distribution at a whole number of degrees of freedom is a finite series in the angle atan(t / sqrt(nu))
STUDENT = f"""
  WITH RECURSIVE s AS (SELECT *, treated + control - 2 AS nu, atan(abs(t_value) / sqrt(treated + control - 2)) AS h FROM ({TWO_SAMPLE})),
  terms AS (
    SELECT treatment, nu, h, 0 AS j, CASE WHEN nu % 2 = 0 THEN 1 ELSE cos(h) END::DOUBLE AS term FROM s WHERE t_value IS NOT NULL
    UNION ALL
    SELECT treatment, nu, h, j + 1,
           term * cos(h) * cos(h) * CASE WHEN nu % 2 = 0 THEN (2 * j + 1)::DOUBLE / (2 * j + 2) ELSE (2 * j + 2)::DOUBLE / (2 * j + 3) END
    FROM terms WHERE j + 1 <= (nu - 2 - nu % 2) / 2),
  inside AS (SELECT treatment, sin(any_value(h)) * sum(term) AS total FROM terms GROUP BY treatment)
  SELECT treatment, treated, control, effect, t_value,
         CASE WHEN total IS NULL THEN 0.5 WHEN nu % 2 = 0 THEN 1 - total ELSE 1 - 2 / pi() * (h + total) END::DOUBLE AS p_value
  FROM s LEFT JOIN inside USING (treatment)"""


@query("model_treatment_test", "L03", f"SELECT *, p_value < 0.05 AS significant FROM ({STUDENT})", "effect t_value p_value")
def _(spark, sf):
    return models.treatment_test(effects(spark, sf), TREATMENTS, "avg_return")


COMPLETE = "SELECT * FROM effects WHERE vix IS NOT NULL AND fed_funds_rate IS NOT NULL"


@query("model_treatment_effect", "L04", f"""
  SELECT 'vix' AS treatment, (SELECT regr_slope(avg_return, vix) FROM effects WHERE vix IS NOT NULL) AS raw_ate,
         (covar_samp(avg_return, vix) * var_samp(fed_funds_rate) - covar_samp(avg_return, fed_funds_rate) * covar_samp(vix, fed_funds_rate))
         / (var_samp(vix) * var_samp(fed_funds_rate) - covar_samp(vix, fed_funds_rate) ** 2) AS adjusted_ate
  FROM ({COMPLETE})""", "raw_ate adjusted_ate")
def _(spark, sf):
    return models.ate(effects(spark, sf), "vix", "avg_return", ["fed_funds_rate"])


def _adjusted_sql(t, c):
    return f"""
  SELECT '{t}' AS treatment, (SELECT regr_slope(avg_return, {t}) FROM effects WHERE {t} IS NOT NULL) AS raw_ate,
         (covar_samp(avg_return, {t}) * var_samp({c}) - covar_samp(avg_return, {c}) * covar_samp({t}, {c}))
         / (var_samp({t}) * var_samp({c}) - covar_samp({t}, {c}) ** 2) AS adjusted_ate
  FROM effects WHERE {t} IS NOT NULL AND {c} IS NOT NULL"""


@query("model_treatment_effects", "L04", " UNION ALL ".join(_adjusted_sql(t, "vix") for t in ("fed_funds_rate", "cpi")), "raw_ate adjusted_ate")
def _(spark, sf):
    return models.ate_all(effects(spark, sf), ("fed_funds_rate", "cpi"), "avg_return", ["vix"])


@query("model_effect_table", "L05", f"""
  SELECT 'high_' || treatment AS treatment, effect AS adjusted_ate, effect * 100 AS ate_pct,
         CASE treatment WHEN 'vix' THEN 'Vix' WHEN 'cpi' THEN 'Cpi' ELSE 'Fed Funds Rate' END AS treatment_clean,
         CASE WHEN effect >= 0 THEN 'Positive' ELSE 'Negative' END AS color_type FROM ({TWO_SAMPLE})""", "adjusted_ate ate_pct")
def _(spark, sf):
    found = models.two_sample(effects(spark, sf), TREATMENTS, "avg_return")
    return models.effect_table(found.select(
        F.concat(F.lit("high_"), "treatment").alias("treatment"), F.col("effect").alias("adjusted_ate")))
