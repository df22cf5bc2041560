"""Queries on risk, sectors, portfolios, performance and serving."""

from pyspark.sql import functions as F

from tapeloom.functions import labels
from tapeloom.operators import performance, portfolios, risk, sectors, serving
from tapeloom.plans import fixtures as fx
from tapeloom.plans.queries_clean import silver
from tapeloom.plans.queries_reference import econ_daily, _meta
from tapeloom.plans.registry import query, view
from tapeloom.sources.staging import staged_once

RF = "(0.05::DOUBLE / 252)"

view("priced", """
  SELECT s.* EXCLUDE (sector, industry), coalesce(m.sector, 'Unknown') AS sector
  FROM silver s LEFT JOIN meta_std m USING (ticker)""")


def _build_priced(spark, sf):
    meta = _meta(spark, sf).select("ticker", F.col("sector").alias("std"))
    return silver(spark, sf).join(meta, "ticker", "left").withColumn(
        "sector", F.coalesce("std", F.lit("Unknown"))).drop("std", "industry")


def priced(spark, sf):
    """Bars with returns and standard sector names."""
    return staged_once(spark, sf, "priced", lambda: _build_priced(spark, sf))


# ------------------------------------------------------------------ risk
view("risk_base", """
  SELECT ticker, min(date) AS first_date, max(date) AS last_date, count(*) AS num_records,
         min(sector) AS sector, avg(r) AS mean_return, stddev_samp(r) AS std_return,
         min_by(close, date) AS first_price, max_by(close, date) AS last_price,
         stddev_samp(r) FILTER (r < 0) AS std_down
  FROM (SELECT *, daily_return / 100 AS r FROM priced) GROUP BY ticker""")
view("risk_ratios", f"""
  SELECT *, CASE WHEN std_return > 0 AND num_records >= 30 THEN (mean_return - {RF}) / std_return * sqrt(252) END AS sharpe_ratio,
         CASE WHEN std_down > 0 AND num_records >= 30 THEN (mean_return - {RF}) / std_down * sqrt(252) END AS sortino_ratio,
         std_return * sqrt(252) AS volatility FROM risk_base""")
view("risk_var", "SELECT ticker, quantile_cont(daily_return / 100, 0.05) AS var_95 FROM priced GROUP BY ticker")
view("risk_falls", """
  SELECT ticker, min(close / peak - 1) AS max_drawdown FROM (
    SELECT ticker, close, max(close) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM priced)
  GROUP BY ticker HAVING count(*) >= 30""")
view("risk_shared", """
  SELECT p.ticker, p.date, p.daily_return / 100 AS r, s.daily_return / 100 AS m,
         row_number() OVER (PARTITION BY p.ticker ORDER BY p.date DESC) AS rk
  FROM priced p JOIN (SELECT date, daily_return FROM priced WHERE ticker = 'SPY') s USING (date)""")
view("risk_beta", f"""
  SELECT ticker, shared, beta_static, beta_rolling_252, (r - ({RF} + beta_static * (m - {RF}))) * 252 AS alpha
  FROM (SELECT ticker, count(*) AS shared, avg(r) AS r, avg(m) AS m,
               CASE WHEN count(*) >= 60 AND var_samp(m) > 0 THEN covar_samp(r, m) / var_samp(m) END AS beta_static,
               CASE WHEN count(*) >= 60 AND count(*) >= 252
                    THEN covar_samp(r, m) FILTER (rk <= 252) / var_samp(m) FILTER (rk <= 252)
                    WHEN count(*) >= 60 THEN covar_samp(r, m) / var_samp(m) END AS beta_rolling_252
        FROM risk_shared GROUP BY ticker)""")
view("risk_full", """
  SELECT b.* EXCLUDE (std_down), v.var_95, f.max_drawdown, x.beta_static, x.beta_rolling_252, x.alpha,
         x.beta_rolling_252 AS beta, var_95 * 100 AS var_95_pct, max_drawdown * 100 AS max_drawdown_pct,
         volatility * 100 AS volatility_pct, alpha * 100 AS alpha_pct
  FROM risk_ratios b LEFT JOIN risk_var v USING (ticker) LEFT JOIN risk_falls f USING (ticker)
       LEFT JOIN risk_beta x USING (ticker)""")
LIMITS = "num_records >= 30 AND max_drawdown > -0.7 AND volatility < 0.8 AND sharpe_ratio BETWEEN -10 AND 20"
view("risk_table", f"SELECT * FROM risk_full WHERE {LIMITS}")

BASE = "mean_return std_return first_price last_price"
FULL = (BASE + " sharpe_ratio sortino_ratio volatility var_95 max_drawdown beta_static beta_rolling_252 alpha beta "
        "var_95_pct max_drawdown_pct volatility_pct alpha_pct")


def risk_table(spark, sf):
    """The published risk table the serving queries read."""
    return staged_once(spark, sf, "risk_table", lambda: risk.risk_metrics(priced(spark, sf)))


@query("risk_base", "R01", "SELECT * FROM risk_base", BASE + " std_down")
def _(spark, sf):
    return risk.risk_base(priced(spark, sf))


@query("risk_sharpe", "R02", "SELECT ticker, sharpe_ratio FROM risk_ratios", "sharpe_ratio")
def _(spark, sf):
    return risk.add_ratios(risk.risk_base(priced(spark, sf))).select("ticker", "sharpe_ratio")


@query("risk_volatility", "R03", "SELECT ticker, volatility FROM risk_ratios", "volatility")
def _(spark, sf):
    return risk.add_ratios(risk.risk_base(priced(spark, sf))).select("ticker", "volatility")


@query("risk_var95", "R04", "SELECT * FROM risk_var", "var_95")
def _(spark, sf):
    return risk.var95(priced(spark, sf))


@query("risk_max_drawdown", "R05", "SELECT * FROM risk_falls", "max_drawdown")
def _(spark, sf):
    return risk.max_drawdown(priced(spark, sf))


@query("risk_sortino", "R06", "SELECT ticker, sortino_ratio FROM risk_ratios", "sortino_ratio")
def _(spark, sf):
    return risk.add_ratios(risk.risk_base(priced(spark, sf))).select("ticker", "sortino_ratio")


@query("risk_beta_static", "R07", "SELECT ticker, shared, beta_static FROM risk_beta", "beta_static")
def _(spark, sf):
    p = priced(spark, sf)
    return risk.beta_static(p, risk.benchmark_from_bars(p)).drop("alpha")


@query("risk_beta_trailing", "R08", "SELECT ticker, beta_static, beta_rolling_252 FROM risk_beta", "beta_static beta_rolling_252")
def _(spark, sf):
    p = priced(spark, sf)
    return risk.betas(p, risk.benchmark_from_bars(p)).drop("alpha")


@query("risk_alpha", "R09", "SELECT ticker, alpha FROM risk_beta", "alpha")
def _(spark, sf):
    p = priced(spark, sf)
    return risk.beta_static(p, risk.benchmark_from_bars(p)).select("ticker", "alpha")


TIGHT = "num_records >= 500 AND max_drawdown > -0.35 AND volatility < 0.19 AND sharpe_ratio BETWEEN -1 AND 1"


@query("risk_quality_filter", "R10", f"SELECT * FROM risk_full WHERE {TIGHT}", FULL)
def _(spark, sf):
    return risk.risk_metrics(priced(spark, sf), min_rows=500, drawdown=-0.35, volatility=0.19, sharpe_between=(-1, 1))


view("risk_sectors", """
  SELECT sector, count(*) AS num_tickers, avg(sharpe_ratio) AS avg_sharpe, avg(sortino_ratio) AS avg_sortino,
         avg(volatility) AS avg_volatility, avg(beta) AS avg_beta, avg(alpha) AS avg_alpha,
         avg(max_drawdown) AS avg_max_drawdown, avg(var_95) AS avg_var_95,
         avg(volatility) * 100 AS avg_volatility_pct, avg(max_drawdown) * 100 AS avg_max_drawdown_pct
  FROM risk_table GROUP BY sector""")
SECTOR_COLS = ("avg_sharpe avg_sortino avg_volatility avg_beta avg_alpha avg_max_drawdown avg_var_95 "
               "avg_volatility_pct avg_max_drawdown_pct")


@query("risk_by_sector", "R11", "SELECT * FROM risk_sectors", SECTOR_COLS)
def _(spark, sf):
    return risk.sector_risk(risk_table(spark, sf))


@query("risk_metrics", "R12", "SELECT * FROM risk_table", FULL)
def _(spark, sf):
    return risk.risk_metrics(priced(spark, sf))


_rates = " ".join(f"WHEN y >= {a} AND y < {b} THEN {r}" for (a, b), r in labels.RISK_FREE_BY_YEAR.items())


@query("risk_free_by_year", "R13", f"""
  SELECT year, n, CASE {_rates} ELSE 0.05 END AS rate
  FROM (SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n, year(date) + shift AS y, shift
        FROM bars, (VALUES (0), (-30), (12), (40)) v(shift) GROUP BY 1, 3, 4)""", "rate")
def _(spark, sf):
    years = fx.bars(spark, sf).groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    shifted = years.withColumn("s", F.explode(F.array(*[F.lit(x) for x in (0, -30, 12, 40)])))
    return shifted.select("year", "n", labels.risk_free_rate(F.col("year") + F.col("s")).alias("rate"))


@query("risk_benchmark", "R14", "SELECT date, daily_return / 100 AS market_return FROM priced WHERE ticker = 'SPY'", "market_return")
def _(spark, sf):
    return risk.benchmark_from_bars(priced(spark, sf))


view("risk_compact", """
  SELECT *, std_ret * 15.8745::DOUBLE AS volatility,
         greatest(-5, least(5, avg_ret * 252 / (std_ret * 15.8745::DOUBLE + 0.1::DOUBLE))) AS sharpe_ratio
  FROM (SELECT ticker, avg(daily_return) AS avg_ret, stddev_samp(daily_return) AS std_ret, count(*) AS "count",
               max(date) AS last_date FROM silver GROUP BY ticker HAVING count(*) > 50)""")
view("risk_compact_falls", """
  SELECT c.ticker, 'Unknown' AS sector, c.sharpe_ratio, greatest(2, least(100, c.volatility)) AS volatility,
         greatest(-99.9, least(0, d.max_drawdown * 100)) AS max_drawdown, c.avg_ret, c.last_date AS date
  FROM risk_compact c JOIN risk_falls d USING (ticker) WHERE c.volatility < 100 AND d.max_drawdown * 100 > -80""")


@query("risk_compact", "R15", "SELECT * FROM risk_compact", "avg_ret std_ret volatility sharpe_ratio")
def _(spark, sf):
    return risk.risk_compact(silver(spark, sf))


@query("risk_compact_drawdown", "R16", "SELECT * FROM risk_compact_falls", "sharpe_ratio volatility max_drawdown avg_ret")
def _(spark, sf):
    return risk.risk_compact_drawdown(silver(spark, sf))


@query("risk_sector_median", "R17", """
  SELECT sector, count(*) AS num_tickers, median(sharpe_ratio) AS sharpe_ratio, median(volatility) AS volatility,
         median(max_drawdown) AS max_drawdown FROM risk_table GROUP BY sector""", "sharpe_ratio volatility max_drawdown")
def _(spark, sf):
    return risk.sector_median(risk_table(spark, sf))


@query("risk_top_sharpe", "R18", """
  SELECT ticker, sector, sharpe_ratio, max_drawdown FROM risk_table ORDER BY sharpe_ratio DESC, ticker LIMIT 10""",
       "sharpe_ratio max_drawdown")
def _(spark, sf):
    return risk.top_by(risk_table(spark, sf), "sharpe_ratio", 10).select(
        "ticker", "sector", "sharpe_ratio", "max_drawdown")


# --------------------------------------------------------------- sectors
view("sector_days", """
  SELECT sector, date, avg(daily_return / 100) AS daily_return, avg(close) AS close FROM priced GROUP BY sector, date""")
view("sector_stats", """
  WITH f AS (SELECT sector, min(close / peak - 1) * 100 AS max_drawdown FROM (
      SELECT sector, close, max(close) OVER (PARTITION BY sector ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM sector_days)
    GROUP BY sector),
  d AS (SELECT sector, avg(daily_return) AS m, stddev_samp(daily_return) AS s,
               stddev_samp(daily_return) FILTER (daily_return < 0) AS dn, product(1 + daily_return) AS g FROM sector_days GROUP BY sector),
  c AS (SELECT sector, count(DISTINCT ticker) AS num_tickers, count(*) AS total_records, min(date) AS min_date, max(date) AS max_date
        FROM priced GROUP BY sector)
  SELECT sector, num_tickers, total_records, m * 100 AS avg_daily_return, (g - 1) * 100 AS total_return,
         s * sqrt(252) * 100 AS volatility, coalesce((m * 252 - 0.02::DOUBLE) / (s * sqrt(252)), 0) AS sharpe_ratio,
         coalesce((m * 252 - 0.02::DOUBLE) / (dn * sqrt(252)), 0) AS sortino_ratio, max_drawdown, min_date, max_date
  FROM c JOIN d USING (sector) JOIN f USING (sector)""")


@query("sector_daily", "A01", "SELECT * FROM sector_days", "daily_return close")
def _(spark, sf):
    return sectors.sector_daily(priced(spark, sf))


@query("sector_metrics", "A02", "SELECT * FROM sector_stats",
       "avg_daily_return total_return volatility sharpe_ratio sortino_ratio max_drawdown")
def _(spark, sf):
    return sectors.sector_metrics(priced(spark, sf))


view("densest", "SELECT ticker, count(*) AS num_records FROM priced GROUP BY ticker ORDER BY 2 DESC, 1 LIMIT 20")


@query("sector_ticker_metrics", "A03", """
  SELECT b.ticker, b.sector, b.num_records, first_date, last_date, first_price, last_price,
         (last_price / first_price - 1) * 100 AS price_change_pct, mean_return * 100 AS avg_daily_return,
         std_return * sqrt(252) * 100 AS volatility,
         (mean_return * 252 - 0.02::DOUBLE) / (std_return * sqrt(252)) AS sharpe_ratio,
         max_drawdown * 100 AS max_drawdown, avg_volume
  FROM risk_base b JOIN densest USING (ticker) JOIN risk_falls USING (ticker)
       JOIN (SELECT ticker, avg(volume) AS avg_volume FROM priced GROUP BY ticker) USING (ticker)""",
       "first_price last_price price_change_pct avg_daily_return volatility sharpe_ratio max_drawdown avg_volume")
def _(spark, sf):
    return sectors.ticker_metrics(priced(spark, sf), top_n=20)


@query("sector_monthly", "A04", """
  SELECT strftime(date, '%Y-%m') AS year_month, avg(daily_return) AS avg_return, stddev_samp(daily_return) AS return_std,
         count(daily_return) AS trading_days, avg(close) AS avg_price, CAST(sum(volume) AS BIGINT) AS total_volume,
         count(DISTINCT ticker) AS active_tickers FROM priced GROUP BY 1""", "avg_return return_std avg_price")
def _(spark, sf):
    return sectors.monthly_performance(priced(spark, sf))


view("market_days", """
  SELECT date, count(DISTINCT ticker) AS n_tickers, avg(daily_return) AS avg_return, stddev_samp(daily_return) AS volatility,
         count(*) FILTER (daily_return > 0) / count(*)::DOUBLE AS pct_positive, avg(close) AS avg_close,
         avg(abs(daily_return)) AS avg_abs_return FROM priced WHERE date >= DATE '1996-01-01' GROUP BY date""")
MARKET = "avg_return volatility pct_positive avg_close avg_abs_return"


def market_days(spark, sf):
    return sectors.market_daily(priced(spark, sf), since="1996-01-01")


@query("market_daily", "A05", "SELECT * FROM market_days", MARKET)
def _(spark, sf):
    return market_days(spark, sf)


@query("sector_performance", "A06", """
  SELECT sector, count(DISTINCT ticker) AS num_stocks, avg(daily_return / 100) * 252 AS avg_return,
         stddev_samp(daily_return / 100) * sqrt(252) AS volatility, count(*) AS total_records
  FROM priced WHERE date >= (SELECT max(date) FROM priced) - 365 GROUP BY sector""", "avg_return volatility")
def _(spark, sf):
    return sectors.sector_performance(priced(spark, sf))


@query("total_return_by_ticker", "A07", """
  SELECT ticker, count(*) AS days, min_by(close, date) AS first_close, max_by(close, date) AS last_close,
         (max_by(close, date) / min_by(close, date) - 1) * 100 AS total_return_pct FROM priced GROUP BY ticker""",
       "first_close last_close total_return_pct")
def _(spark, sf):
    return sectors.total_return_by_ticker(priced(spark, sf))


@query("features_densest_tickers", "F14", "SELECT p.* FROM priced p WHERE ticker IN (SELECT ticker FROM densest)",
       "open high low close daily_return")
def _(spark, sf):
    return sectors.keep_densest(priced(spark, sf), 20)


MARKET_ECON = "vix fed_funds_rate cpi treasury_10y"


@query("market_with_econ", "J13", """
  SELECT m.date, n_tickers, avg_return, volatility, pct_positive, avg_close, avg_abs_return,
         coalesce(last_value(e.vix IGNORE NULLS) OVER w, 0) AS vix, coalesce(last_value(e.fed_funds_rate IGNORE NULLS) OVER w, 0) AS fed_rate,
         coalesce(last_value(e.cpi IGNORE NULLS) OVER w, 0) AS cpi,
         coalesce(last_value(e.treasury_10y IGNORE NULLS) OVER w, 0) AS treasury_10y
  FROM market_days m LEFT JOIN econ_wide e USING (date) WINDOW w AS (ORDER BY m.date ROWS UNBOUNDED PRECEDING)""",
       MARKET + " vix fed_rate cpi treasury_10y")
def _(spark, sf):
    from tapeloom.operators import economic, unify

    wide = economic.pivot_indicators(fx.econ(spark, sf), {
        "VIXCLS": "VIXCLS", "DFF": "DFF", "CPIAUCSL": "CPIAUCSL", "DGS10": "DGS10"})
    return unify.market_with_econ(market_days(spark, sf), wide)


# ------------------------------------------------------------ portfolios
view("candidates", """
  SELECT b.ticker, b.sector, x.beta_static AS beta,
         CASE WHEN num_records >= 30 AND std_return > 0 THEN mean_return / std_return ELSE 0 END AS return_stability,
         p.pop * sqrt(252) AS volatility, num_records AS num_days, mean_return * 252 AS avg_return
  FROM risk_base b JOIN risk_beta x USING (ticker)
       JOIN (SELECT ticker, stddev_pop(daily_return / 100) AS pop FROM priced GROUP BY ticker) p USING (ticker)
  WHERE num_records >= 252 AND x.beta_static IS NOT NULL""")
view("low_beta", "SELECT * FROM candidates WHERE round(beta, 9) < 1 ORDER BY return_stability DESC, ticker LIMIT 30")
view("low_beta_held", """
  SELECT ticker, sector, beta, return_stability, volatility, avg_return,
         (1 / volatility) / sum(1 / volatility) OVER () AS weight, vix_signal, 'low_beta_quality' AS strategy
  FROM low_beta, (SELECT CASE WHEN max_by(vix, date) > 25 THEN 1.1 ELSE 1.0 END::DOUBLE AS vix_signal FROM econ_daily)""")
view("regime_now", """
  SELECT CASE WHEN vix > 25 THEN 'recession' WHEN vix < 15 AND rate > 5 THEN 'peak' WHEN vix < 15 THEN 'expansion'
              WHEN stored IN ('recovery', 'expansion', 'peak', 'recession') THEN stored ELSE 'expansion' END AS regime
  FROM (SELECT max_by(vix, date) AS vix, max_by(fed_funds_rate, date) AS rate, max_by(market_regime, date) AS stored FROM econ_daily)""")
# sector names as the allocation table spells them
RENAME = {"Financials": "Financial Services", "Unknown": "Utilities"}
view("allocated", "SELECT * REPLACE (CASE sector " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in RENAME.items()) + " ELSE sector END AS sector) FROM priced")
view("allocation", "SELECT * FROM (VALUES " + ", ".join(
    f"('{r}', '{s}', {w}::DOUBLE)" for r, ss in portfolios.REGIME_ALLOCATION.items() for s, w in ss.items())
    + ") t(regime, sector, sector_target_weight)")
view("rotation_held", """
  SELECT ticker, sector, regime, sector_target_weight, w / sum(w) OVER () AS weight, 'sector_rotation' AS strategy
  FROM (SELECT *, sector_target_weight / count(*) OVER (PARTITION BY sector) AS w
        FROM (SELECT sector, ticker, row_number() OVER (PARTITION BY sector ORDER BY count(*) DESC, ticker) AS rk
              FROM allocated GROUP BY sector, ticker)
        JOIN allocation USING (sector) WHERE rk <= 5 AND regime = (SELECT regime FROM regime_now))""")
view("momentum_scores", """
  SELECT ticker, max(close) FILTER (rk = 22) / max(close) FILTER (rk = 273) - 1 AS momentum
  FROM (SELECT ticker, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk FROM priced)
  GROUP BY ticker HAVING count(*) >= 273""")
view("momentum_kept", """
  SELECT m.ticker, s.sector, m.momentum, p.xgb_probability FROM momentum_scores m
  JOIN (SELECT ticker, min(sector) AS sector FROM priced GROUP BY ticker) s USING (ticker)
  LEFT JOIN predictions p USING (ticker)
  WHERE p.xgb_probability IS NULL OR p.xgb_probability >= 0.55 OR p.xgb_probability <= 0.45""")
view("momentum_held", """
  SELECT ticker, sector, momentum, 1.0 / count(*) OVER () AS weight
  FROM (SELECT * FROM momentum_kept ORDER BY momentum DESC, ticker LIMIT 30)""")
view("holdings", """
  SELECT strategy, ticker, sector, weight FROM low_beta_held
  UNION ALL SELECT strategy, ticker, sector, weight FROM rotation_held
  UNION ALL SELECT 'momentum', ticker, sector, weight FROM momentum_held""")


def allocated(spark, sf):
    return priced(spark, sf).withColumn("sector", labels.alias_sector(F.col("sector"), RENAME))


def _bench(spark, sf):
    return risk.benchmark_from_bars(silver(spark, sf))


def holdings(spark, sf):
    cols = ["strategy", "ticker", "sector", "weight"]
    p, e = priced(spark, sf), econ_daily(spark, sf)
    low = portfolios.low_beta_quality(p, _bench(spark, sf), e)
    mom = portfolios.momentum_portfolio(p, fx.predictions(spark, sf)).withColumn("strategy", F.lit("momentum"))
    rot = portfolios.sector_rotation(allocated(spark, sf), e)
    return low.select(cols).unionByName(rot.select(cols)).unionByName(mom.select(cols))


CAND = "beta return_stability volatility avg_return"


@query("portfolio_return_stability", "P01", """
  SELECT ticker, CASE WHEN num_records >= 30 AND std_return > 0 THEN mean_return / std_return ELSE 0 END AS return_stability
  FROM risk_base""", "return_stability")
def _(spark, sf):
    b = risk.risk_base(priced(spark, sf))
    return b.select("ticker", portfolios.return_stability(
        F.col("mean_return"), F.col("std_return"), F.col("num_records")).alias("return_stability"))


@query("portfolio_low_beta_candidates", "P02", "SELECT * FROM candidates", CAND)
def _(spark, sf):
    return portfolios.low_beta_candidates(priced(spark, sf), _bench(spark, sf))


@query("portfolio_low_beta_select", "P03", "SELECT * FROM low_beta", CAND)
def _(spark, sf):
    return portfolios.low_beta_select(portfolios.low_beta_candidates(priced(spark, sf), _bench(spark, sf)))


@query("portfolio_inverse_vol", "P04", "SELECT ticker, weight FROM low_beta_held", "weight")
def _(spark, sf):
    chosen = portfolios.low_beta_select(portfolios.low_beta_candidates(priced(spark, sf), _bench(spark, sf)))
    return portfolios.inverse_vol_weights(chosen).select("ticker", "weight")


@query("portfolio_vix_signal", "P05", "SELECT CASE WHEN max_by(vix, date) > 25 THEN 1.1 ELSE 1.0 END::DOUBLE AS vix_signal FROM econ_daily",
       "vix_signal")
def _(spark, sf):
    return portfolios.vix_signal(econ_daily(spark, sf))


@query("portfolio_low_beta_quality", "P06", "SELECT * FROM low_beta_held", CAND + " weight vix_signal")
def _(spark, sf):
    return portfolios.low_beta_quality(priced(spark, sf), _bench(spark, sf), econ_daily(spark, sf))


@query("portfolio_regime", "P07", "SELECT * FROM regime_now")
def _(spark, sf):
    return portfolios.current_regime(econ_daily(spark, sf))


@query("portfolio_sector_rotation", "P08", "SELECT * FROM rotation_held", "sector_target_weight weight")
def _(spark, sf):
    return portfolios.sector_rotation(allocated(spark, sf), econ_daily(spark, sf))


@query("portfolio_by_sector", "P09", """
  SELECT sector, count(*) AS stocks, sum(weight) AS total_weight FROM rotation_held GROUP BY sector""", "total_weight")
def _(spark, sf):
    return portfolios.portfolio_by_sector(portfolios.sector_rotation(allocated(spark, sf), econ_daily(spark, sf)))


@query("portfolio_momentum_scores", "P10", "SELECT * FROM momentum_scores", "momentum")
def _(spark, sf):
    return portfolios.momentum(priced(spark, sf))


@query("portfolio_ml_filter", "P11", "SELECT ticker, momentum, xgb_probability FROM momentum_kept", "momentum xgb_probability")
def _(spark, sf):
    return portfolios.ml_filter(portfolios.momentum(priced(spark, sf)), fx.predictions(spark, sf))


@query("portfolio_momentum", "P12", "SELECT * FROM momentum_held", "momentum weight")
def _(spark, sf):
    return portfolios.momentum_portfolio(priced(spark, sf), fx.predictions(spark, sf))


@query("portfolio_all_strategies", "P13", """
  SELECT * FROM (SELECT strategy, ticker, sector, weight FROM low_beta_held
  UNION ALL SELECT 'momentum', ticker, sector, weight FROM momentum_held
  UNION ALL
  SELECT 'sector_rotation', ticker, sector, w / sum(w) OVER () FROM (
    SELECT *, sector_target_weight / count(*) OVER (PARTITION BY sector) AS w
    FROM (SELECT sector, ticker, row_number() OVER (PARTITION BY sector ORDER BY count(*) DESC, ticker) AS rk
          FROM priced GROUP BY sector, ticker)
    JOIN allocation USING (sector) WHERE rk <= 5 AND regime = (SELECT regime FROM regime_now)))""", "weight")
def _(spark, sf):
    return portfolios.run_strategies(
        priced(spark, sf), _bench(spark, sf), econ_daily(spark, sf), fx.predictions(spark, sf))


@query("portfolio_daily_pnl", "P14", """
  SELECT p.date, h.strategy, sum(h.weight * p.daily_return / 100) AS daily_return, count(*) AS holdings
  FROM priced p JOIN holdings h USING (ticker) GROUP BY p.date, h.strategy""", "daily_return")
def _(spark, sf):
    return portfolios.strategy_pnl(holdings(spark, sf), priced(spark, sf))


@query("universe_portfolio_overlap", "U09", """
  SELECT ticker, string_agg(strategy, ',' ORDER BY strategy) AS strategies, count(*) AS held_by
  FROM holdings GROUP BY ticker HAVING count(*) > 1""")
def _(spark, sf):
    from tapeloom.operators.universe import portfolio_overlap

    return portfolio_overlap(holdings(spark, sf)).withColumn("strategies", F.array_join("strategies", ","))


# ----------------------------------------------------------- performance
view("rebalances", """
  SELECT date FROM (SELECT date, lag(date) OVER (ORDER BY date) AS p FROM (SELECT DISTINCT date FROM stock_bars))
  WHERE p IS NULL OR date_trunc('month', date) <> date_trunc('month', p)""")
view("targets", """
  SELECT date, ticker, 1.0::DOUBLE / count(*) OVER (PARTITION BY date) AS weight FROM (
    SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY ticker) AS rk FROM stock_bars
    WHERE date IN (SELECT date FROM rebalances)) WHERE rk <= 10""")
view("period_days", """
  SELECT p.start, p.until, d.date FROM (SELECT date AS start, lead(date) OVER (ORDER BY date) AS until FROM rebalances) p
  JOIN (SELECT DISTINCT date FROM stock_bars) d ON d.date >= p.start AND (p.until IS NULL OR d.date <= p.until)""")
view("held_values", """
  SELECT p.start, p.until, p.date, t.ticker, t.weight * b.close / e.close AS v
  FROM period_days p JOIN targets t ON t.date = p.start
  JOIN stock_bars e ON e.ticker = t.ticker AND e.date = p.start
  ASOF JOIN stock_bars b ON b.ticker = t.ticker AND b.date <= p.date""")
view("growths", "SELECT start, until, date, sum(v) AS growth FROM held_values GROUP BY start, until, date")
view("costs", """
  SELECT date, sum(abs(coalesce(w, 0) - coalesce(old, 0))) AS turnover,
         sum(abs(coalesce(w, 0) - coalesce(old, 0))) * 0.0015::DOUBLE AS cost
  FROM (SELECT coalesce(t.date, d.date) AS date, t.weight AS w, d.old FROM targets t
        FULL JOIN (SELECT date, ticker, v / sum(v) OVER (PARTITION BY date) AS old FROM held_values WHERE date = until) d
        ON d.date = t.date AND d.ticker = t.ticker) GROUP BY date""")
view("value_path", """
  WITH ends AS (SELECT start, max_by(growth, date) AS g FROM growths GROUP BY start),
  chain AS (SELECT e.start, coalesce(product(g) OVER (ORDER BY e.start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)
                 * product(1 - c.cost) OVER (ORDER BY e.start ROWS UNBOUNDED PRECEDING) AS base
            FROM ends e JOIN costs c ON c.date = e.start)
  SELECT date, max_by(growth * base, start) * 100000 AS total_value FROM growths JOIN chain USING (start) GROUP BY date""")
view("strategy_values", """
  SELECT 'equal_weight' AS strategy, date, total_value FROM value_path
  UNION ALL SELECT ticker, date, close FROM bars""")


def _rebalances(spark, sf):
    return performance.rebalance_dates(fx.stock_bars(spark, sf))


def _targets(spark, sf):
    return staged_once(spark, sf, "targets", lambda: performance.equal_weight_targets(
        fx.stock_bars(spark, sf), _rebalances(spark, sf)))


def _segments(spark, sf):
    return staged_once(spark, sf, "segments", lambda: performance.segments(fx.stock_bars(spark, sf), _targets(spark, sf)))


def _backtest(spark, sf):
    """Bars, targets and the segment table the backtest queries share."""
    return fx.stock_bars(spark, sf), _targets(spark, sf), _segments(spark, sf)


def _value_path(spark, sf):
    bars, targets, held = _backtest(spark, sf)
    return staged_once(spark, sf, "value_path", lambda: performance.portfolio_value(bars, targets, held=held))


def strategy_values(spark, sf):
    path = _value_path(spark, sf)
    own = fx.bars(spark, sf).select(F.col("ticker").alias("strategy"), "date", F.col("close").alias("total_value"))
    return path.select(F.lit("equal_weight").alias("strategy"), "date", "total_value").unionByName(own)


@query("backtest_rebalance_dates", "B01", "SELECT * FROM rebalances")
def _(spark, sf):
    return _rebalances(spark, sf)


@query("backtest_rebalance_weeks", "B01", """
  SELECT date FROM (SELECT date, lag(date) OVER (ORDER BY date) AS p FROM (SELECT DISTINCT date FROM stock_bars))
  WHERE p IS NULL OR date_trunc('week', date) <> date_trunc('week', p)""")
def _(spark, sf):
    return performance.rebalance_dates(fx.stock_bars(spark, sf), "weekly")


@query("backtest_equal_weight", "B02", "SELECT * FROM targets", "weight")
def _(spark, sf):
    return performance.equal_weight_targets(fx.stock_bars(spark, sf), _rebalances(spark, sf))


@query("backtest_period_values", "B03", "SELECT start, date, growth FROM growths", "growth")
def _(spark, sf):
    return performance.period_values(*_backtest(spark, sf))


@query("backtest_portfolio_value", "B03", "SELECT * FROM value_path", "total_value", digits=3)
def _(spark, sf):
    bars, targets, held = _backtest(spark, sf)
    return performance.portfolio_value(bars, targets, held=held)


# the same targets a day late, when not every ticker trades and some dates have no bar at all
view("late_targets", "SELECT date + 1 AS date, ticker, weight FROM targets")


def _late_segments(spark, sf):
    late = _targets(spark, sf).withColumn("date", F.date_add("date", 1))
    return staged_once(spark, sf, "late_segments", lambda: performance.segments(fx.stock_bars(spark, sf), late))


@query("backtest_unpriced", "B03", """
  SELECT t.date AS start, t.ticker, t.weight FROM late_targets t
  LEFT JOIN stock_bars b ON b.ticker = t.ticker AND b.date = t.date AND b.close > 0 WHERE b.ticker IS NULL""", "weight")
def _(spark, sf):
    return performance.unpriced_holdings(_late_segments(spark, sf))


@query("backtest_late_values", "B03", """
  WITH p AS (SELECT date AS start, lead(date) OVER (ORDER BY date) AS until FROM (SELECT DISTINCT date FROM late_targets)),
  days AS (SELECT date FROM stock_bars UNION SELECT date FROM late_targets),
  d AS (SELECT p.start, days.date FROM p JOIN days ON days.date >= p.start AND (p.until IS NULL OR days.date <= p.until)),
  bought AS (SELECT t.date AS start, t.ticker, t.weight, e.close AS entry FROM late_targets t
             LEFT JOIN stock_bars e ON e.ticker = t.ticker AND e.date = t.date AND e.close > 0)
  SELECT start, date, sum(v) AS growth FROM (
    SELECT start, d.date, x.weight * coalesce(b.close / x.entry, 1) AS v
    FROM d JOIN bought x USING (start) ASOF LEFT JOIN stock_bars b ON b.ticker = x.ticker AND b.date <= d.date)
  GROUP BY start, date""", "growth")
def _(spark, sf):
    held = _late_segments(spark, sf)
    return performance.period_values(fx.stock_bars(spark, sf), _targets(spark, sf), held)


@query("backtest_costs", "B04", "SELECT * FROM costs", "turnover cost")
def _(spark, sf):
    bars, targets, held = _backtest(spark, sf)
    return performance.rebalance_costs(bars, targets, held=held)


view("moves", """
  SELECT coalesce(t.date, d.date) AS date, coalesce(t.ticker, d.ticker) AS ticker, coalesce(t.weight, 0) - coalesce(d.old, 0) AS change
  FROM targets t FULL JOIN (
    SELECT date, ticker, v / sum(v) OVER (PARTITION BY date) AS old FROM held_values WHERE date = until) d
  ON d.date = t.date AND d.ticker = t.ticker""")


@query("backtest_trades", "B04", """
  SELECT date, ticker, CASE WHEN change > 0 THEN 'BUY' ELSE 'SELL' END AS side, value,
         value * 0.001::DOUBLE AS commission, value * 0.0005::DOUBLE AS slippage
  FROM (SELECT m.date, m.ticker, m.change, abs(m.change) * v.total_value / (1 - c.cost) AS value
        FROM moves m JOIN costs c USING (date) JOIN value_path v USING (date) WHERE abs(m.change) > 1e-9)""",
       "value commission slippage", digits=3)
def _(spark, sf):
    bars, targets, held = _backtest(spark, sf)
    return performance.rebalance_trades(bars, targets, _value_path(spark, sf), held=held)


view("value_steps", """
  SELECT strategy, date, total_value / lag(total_value) OVER (PARTITION BY strategy ORDER BY date) - 1 AS daily_return
  FROM strategy_values""")


@query("backtest_returns", "B05", "SELECT * FROM value_steps WHERE daily_return IS NOT NULL", "daily_return")
def _(spark, sf):
    return performance.value_returns(strategy_values(spark, sf))


@query("backtest_summary", "B06", """
  WITH r AS (SELECT strategy, avg(daily_return) AS m, stddev_samp(daily_return) AS s, count(daily_return) AS n
             FROM value_steps GROUP BY strategy),
  e AS (SELECT strategy, count(*) AS days, min_by(total_value, date) AS first_value, max_by(total_value, date) AS last_value
        FROM strategy_values GROUP BY strategy),
  f AS (SELECT strategy, min(total_value / peak - 1) AS max_drawdown FROM (
          SELECT strategy, total_value, max(total_value) OVER (PARTITION BY strategy ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak
          FROM strategy_values) GROUP BY strategy)
  SELECT strategy, days, first_value, last_value, last_value / first_value - 1 AS total_return,
         pow(last_value / first_value, 252::DOUBLE / n) - 1 AS annualized_return, s * sqrt(252) AS volatility,
         (m - 0.05::DOUBLE / 252) / s * sqrt(252) AS sharpe_ratio, max_drawdown,
         (pow(last_value / first_value, 252::DOUBLE / n) - 1) / abs(max_drawdown) AS calmar_ratio
  FROM e JOIN r USING (strategy) JOIN f USING (strategy)""",
       "first_value last_value total_return annualized_return volatility sharpe_ratio max_drawdown calmar_ratio", digits=4)
def _(spark, sf):
    return performance.performance_summary(strategy_values(spark, sf))


# --------------------------------------------------------------- serving
LEAD = "sharpe_ratio volatility max_drawdown"


@query("serve_market_pulse", "D01", """
  SELECT *, CASE WHEN median_sharpe > 1 THEN 'Bull' WHEN median_sharpe < 0.5 THEN 'Bear' ELSE 'Neutral' END AS mood
  FROM (SELECT count(*) AS tickers, count(*) FILTER (sharpe_ratio > 2) AS sharpe_above_2,
               count(*) FILTER (sharpe_ratio > 1) AS sharpe_above_1, median(sharpe_ratio) AS median_sharpe,
               median(max_drawdown) AS median_drawdown FROM risk_table)""", "median_sharpe median_drawdown")
def _(spark, sf):
    return serving.market_pulse(risk_table(spark, sf))


@query("serve_top_sharpe", "D02", """
  SELECT ticker, sector, sharpe_ratio, volatility, max_drawdown FROM risk_table ORDER BY sharpe_ratio DESC, ticker LIMIT 20""", LEAD)
def _(spark, sf):
    return serving.leaders(risk_table(spark, sf))


@query("serve_low_volatility", "D02", """
  SELECT ticker, sector, sharpe_ratio, volatility, max_drawdown FROM risk_table ORDER BY volatility, ticker LIMIT 20""", LEAD)
def _(spark, sf):
    return serving.leaders(risk_table(spark, sf), by="volatility", ascending=True)


@query("serve_lookup", "D03", "SELECT * FROM risk_table WHERE ticker = 'S7'", FULL)
def _(spark, sf):
    return serving.lookup(risk_table(spark, sf), "S7")


@query("serve_sector_leaders", "D04", """
  SELECT sector, median(sharpe_ratio) AS sharpe_ratio FROM risk_table GROUP BY sector ORDER BY 2 DESC, 1 LIMIT 10""", "sharpe_ratio")
def _(spark, sf):
    return serving.sector_leaders(risk_table(spark, sf))


@query("serve_histogram", "D05", """
  SELECT bin, lo + bin * w AS low, lo + (bin + 1) * w AS high, count(*) AS "count" FROM (
    SELECT CAST(least(49, floor((daily_return - lo) / w)) AS INTEGER) AS bin, lo, w FROM priced,
      (SELECT min(daily_return) AS lo, (max(daily_return) - min(daily_return)) / 50 AS w FROM priced))
  GROUP BY bin, lo, w""", "low high")
def _(spark, sf):
    return serving.histogram(priced(spark, sf), "daily_return", 50)


@query("serve_screen", "D06", "SELECT * FROM risk_table WHERE sector = 'Energy' AND sharpe_ratio >= -1", FULL)
def _(spark, sf):
    return serving.screen(risk_table(spark, sf), "Energy", -1)


@query("serve_sector_drill", "D07", """
  SELECT count(*) AS tickers, avg(sharpe_ratio) AS avg_sharpe, avg(volatility) AS avg_volatility
  FROM risk_table WHERE sector = 'Energy'""", "avg_sharpe avg_volatility")
def _(spark, sf):
    return serving.sector_drill(risk_table(spark, sf), "Energy")


@query("serve_sector_compare", "D08", "SELECT * FROM risk_sectors", SECTOR_COLS)
def _(spark, sf):
    return serving.sector_compare(risk.sector_risk(risk_table(spark, sf)), "avg_volatility")


@query("serve_sector_list", "D08", "SELECT DISTINCT sector FROM risk_table")
def _(spark, sf):
    return serving.sector_list(risk_table(spark, sf))


@query("serve_derive_missing", "D09", """
  SELECT ticker, mean_return AS avg_return, std_return AS volatility, mean_return AS avg_ret,
         (mean_return * 252 - 0.04::DOUBLE) / (std_return * sqrt(252) + 0.001::DOUBLE) AS sharpe_ratio,
         -std_return * 200 AS max_drawdown, mean_return AS avg_daily_return FROM risk_base""",
       "avg_return volatility avg_ret sharpe_ratio max_drawdown avg_daily_return")
def _(spark, sf):
    b = risk.risk_base(priced(spark, sf))
    return serving.derive_missing(b.select(
        "ticker", F.col("mean_return").alias("avg_return"), F.col("std_return").alias("volatility"),
        F.col("mean_return").alias("avg_ret")))


@query("serve_small_segments", "D10", """
  WITH h AS (SELECT ticker AS name, sum(weight) AS v FROM holdings GROUP BY ticker)
  SELECT CASE WHEN v / t < 0.02 THEN 'Others' ELSE name END AS name, v / t < 0.02 AS is_others, sum(v) AS v
  FROM h, (SELECT sum(v) AS t FROM h) GROUP BY 1, 2""", "v")
def _(spark, sf):
    h = holdings(spark, sf).groupBy(F.col("ticker").alias("name")).agg(F.sum("weight").alias("v"))
    return serving.group_small_segments(h, "name", "v")


@query("serve_page", "D11", """
  SELECT ticker, sector, sharpe_ratio FROM risk_table ORDER BY sharpe_ratio DESC, ticker LIMIT 20 OFFSET 40""", "sharpe_ratio")
def _(spark, sf):
    return serving.page(risk_table(spark, sf).select("ticker", "sector", "sharpe_ratio"), "sharpe_ratio", 3, ascending=False)
