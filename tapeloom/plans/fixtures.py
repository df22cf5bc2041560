"""Market tables derived from the driver tables, in Spark and as SQL.

The engine works on bars, indicators, metadata and news; the driver supplies
orders and documents. Each builder here has a twin in ``SQL`` with the same
name, columns and values, so that a query on one can be checked on the other.
Sums are taken over integer hundredths to be exact on both sides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import timeblocks
from tapeloom.session import tune
from tapeloom.sources.staging import staged_once

BENCHMARK = "SPY"
# Prices are rounded, which makes both engines agree on them, then scaled by this
# factor, which leaves no decimal ties in their averages.
UNTIE = 1.0000371093


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf}/{name}.parquet")


def _cents(col: str):
    return F.round(F.col(col) * 100).cast("long")


def _build_bars(spark, sf):
    days = (
        table(spark, sf, "lineitem")
        .groupBy(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
            F.to_date("l_shipdate").alias("date"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_cents("l_discount")).alias("d"),
            F.sum(_cents("l_tax")).alias("t"),
            F.sum(F.col("l_quantity").cast("long")).alias("q"),
        )
    )
    market = (
        days.groupBy("date")
        .agg(*[F.sum(c).alias(c) for c in "ndtq"])
        .withColumn("ticker", F.lit(BENCHMARK))
    )
    steps = (
        days.unionByName(market)
        .withColumn("tax", F.col("t").cast("double") / F.col("n") / 100)
        .withColumn("step", 0.4 * (F.col("d").cast("double") / F.col("n") / 100 - 0.05))
    )
    path = timeblocks.running_sum(steps, ["ticker"], ["date"], {"level": F.col("step")})
    close = F.round(100 * F.exp("level"), 6)
    open_ = F.round(100 * F.exp(F.col("level") - F.col("step")), 6)
    return path.select("ticker", "date", "tax", "q", close.alias("close"), open_.alias("open")).select(
        "ticker",
        "date",
        (F.col("open") * UNTIE).alias("open"),
        (F.round(F.greatest("open", "close") * (1 + 0.1 * F.col("tax")), 6) * UNTIE).alias("high"),
        (F.round(F.least("open", "close") * (1 - 0.1 * F.col("tax")), 6) * UNTIE).alias("low"),
        (F.col("close") * UNTIE).alias("close"),
        (F.col("q") * 1000).alias("volume"),
    )


def bars(spark, sf) -> DataFrame:
    """One bar per supplier and ship day, plus one series over all suppliers."""
    return staged_once(spark, sf, "bars", lambda: _build_bars(spark, sf))


def stock_bars(spark, sf) -> DataFrame:
    return bars(spark, sf).where(F.col("ticker") != BENCHMARK)


def bars_dirty(spark, sf) -> DataFrame:
    """``bars`` with faults planted by day number, and corrected copies of every 50th day."""
    k = F.datediff("date", F.lit("1995-01-01").cast("date"))
    every = lambda n: F.col("k") % n == 0
    src = bars(spark, sf).withColumn("k", k)
    src = src.where((F.col("ticker") != "S0") | (F.col("date") < F.lit("1996-01-01").cast("date")))
    faulty = src.select(
        "ticker",
        "date",
        F.when(~every(79), F.col("open")).alias("open"),
        F.when(every(89), F.col("low")).when(every(71), F.col("high") * 2)
        .otherwise(F.col("high")).alias("high"),
        F.when(every(89), F.col("high")).when(every(67), F.lit(0.4))
        .otherwise(F.col("low")).alias("low"),
        F.when(every(97), F.lit(0.0)).when(every(71), F.col("close") * 2)
        .when(every(67), F.lit(0.5)).otherwise(F.col("close")).alias("close"),
        F.when(every(83), F.lit(-1)).otherwise(F.col("volume")).cast("long").alias("volume"),
        "k",
    )
    stamp = F.col("date").cast("timestamp_ntz")
    first = faulty.withColumn("ingested_at", stamp)
    again = faulty.where(every(50)).withColumn("close", F.round(F.col("close") * 1.01, 6)).withColumn(
        "ingested_at", stamp + F.expr("INTERVAL 1 DAY")
    )
    return first.unionByName(again).drop("k")


# priority -> (indicator, base, slope): a table of the fixture, not of the engine
INDICATORS = {
    "1-URGENT": ("VIXCLS", 10.0, 30.0),
    "2-HIGH": ("UNRATE", 3.0, 5.0),
    "3-MEDIUM": ("DFF", 0.0, 5.5),
    "4-NOT SPECIFIED": ("DGS10", 0.0, 6.0),
    "5-LOW": ("CPIAUCSL", 250.0, 50.0),
}


def _build_econ(spark, sf):
    means = (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("p"))
        .agg(F.sum(_cents("o_totalprice")).alias("c"), F.count(F.lit(1)).alias("n"))
        .withColumn("x", F.col("c").cast("double") / F.col("n") / 100 / 499979)
    )
    pick = lambda i: F.coalesce(*[F.when(F.col("p") == p, F.lit(v[i])) for p, v in INDICATORS.items()])
    value = F.round(pick(1) + pick(2) * F.col("x"), 6) * UNTIE
    return means.select("date", pick(0).alias("indicator_id"), value.alias("value"))


def econ(spark, sf) -> DataFrame:
    """Long indicator series: one row per day and indicator."""
    return staged_once(spark, sf, "econ", lambda: _build_econ(spark, sf))


def metadata(spark, sf) -> DataFrame:
    cents = F.round(F.col("s_acctbal") * 100).cast("long").cast("double")
    pe = (cents / 100 / 100).cast("string")
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
            F.col("s_name").alias("company_name"),
            F.when(F.col("r_regionkey") == 0, "technology")
            .when(F.col("r_regionkey") == 1, "Financial Services")
            .when(F.col("r_regionkey") == 2, "oil & gas")
            .when(F.col("r_regionkey") == 4, "reit fund").alias("sector"),
            F.when(F.col("s_suppkey") % 7 != 3, F.col("n_name")).alias("industry"),
            (cents * 20000).alias("market_cap"),
            F.when(F.col("s_suppkey") % 11 == 5, "{broken")
            .otherwise(F.concat(
                F.lit('{"forwardPE": '), (F.col("s_suppkey") % 40).cast("string"),
                F.lit('.5, "priceToBook": '), (F.col("s_suppkey") % 9).cast("string"),
                F.lit('.25, "profitMargins": 0.'), (F.col("s_suppkey") % 10).cast("string"),
                F.lit("}"))).alias("raw_json"),
        )
    )


def news(spark, sf) -> DataFrame:
    id_ = F.col("doc_id")
    one = F.concat(F.lit("S"), (id_ % 10).cast("string"))
    two = F.concat(F.lit("S"), ((id_ * 7 + 3) % 10).cast("string"))
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            id_.cast("string").alias("news_id"),
            F.concat(
                F.lit("$"), F.upper("lang"), F.lit(" and CEO of AAPL: "), F.substring_index("text", "\n", 1)
            ).alias("title"),
            F.col("text").alias("content"),
            F.date_add(F.lit("1995-01-02").cast("date"), (id_ % 2000).cast("int"))
            .cast("timestamp_ntz").alias("published_at"),
            F.when(id_ % 2 == 0, F.concat(F.lit('["'), one, F.lit('", "'), two, F.lit('"]')))
            .otherwise(F.concat(F.lower(one), F.lit(", "), two)).alias("tickers"),
            F.when(F.col("toxic") == 1, F.lit(-0.05))
            .when(F.col("quality") == 1, F.lit(0.5))
            .when(F.col("quality") == 0, F.lit(-0.5)).alias("sentiment_score"),
        )
    )


def predictions(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").where(F.col("s_suppkey") % 3 != 0).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
        ((F.col("s_suppkey") % 101).cast("double") / 100).alias("xgb_probability"),
    )


def splits(spark, sf) -> DataFrame:
    """Two splits for every fifth supplier."""
    dates = F.array(
        F.struct(F.lit("1998-01-01").cast("date").alias("split_date"), F.lit(2.0).alias("ratio")),
        F.struct(F.lit("2000-01-01").cast("date").alias("split_date"), F.lit(3.0).alias("ratio")),
    )
    return (
        table(spark, sf, "supplier").where(F.col("s_suppkey") % 5 == 0)
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                F.explode(dates).alias("s"))
        .select("ticker", "s.split_date", "s.ratio")
    )


def ticks(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        "ts",
        (F.col("value") + 100).alias("price"),
        F.lit(1).cast("long").alias("size"),
    )


SQL = {
    "bars": f"""
  SELECT ticker, date, open * {UNTIE}::DOUBLE AS open,
         round(greatest(open, close) * (1 + 0.1::DOUBLE * tax), 6) * {UNTIE}::DOUBLE AS high,
         round(least(open, close) * (1 - 0.1::DOUBLE * tax), 6) * {UNTIE}::DOUBLE AS low,
         close * {UNTIE}::DOUBLE AS close, CAST(q * 1000 AS BIGINT) AS volume
  FROM (SELECT ticker, date, tax, q, round(100 * exp(level), 6) AS close,
               coalesce(round(100 * exp(lag(level) OVER (PARTITION BY ticker ORDER BY date)), 6), 100.0::DOUBLE) AS open
        FROM (SELECT *, sum(step) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS level
              FROM (SELECT ticker, date, q, t::DOUBLE / n / 100 AS tax,
                           0.4::DOUBLE * (d::DOUBLE / n / 100 - 0.05::DOUBLE) AS step
                    FROM (SELECT * FROM bar_days
                          UNION ALL
                          SELECT 'SPY', date, sum(n), sum(d), sum(t), sum(q) FROM bar_days GROUP BY date))))""",
    "bar_days": """
  SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, count(*) AS n,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS d,
         sum(CAST(round(l_tax * 100) AS BIGINT)) AS t,
         sum(CAST(l_quantity AS BIGINT)) AS q
  FROM lineitem GROUP BY 1, 2""",
    "stock_bars": "SELECT * FROM bars WHERE ticker <> 'SPY'",
    "bars_dirty": """
  WITH src AS (SELECT *, date_diff('day', DATE '1995-01-01', date) AS k FROM bars
               WHERE ticker <> 'S0' OR date < DATE '1996-01-01'),
  faulty AS (SELECT ticker, date,
       CASE WHEN k % 79 <> 0 THEN open END AS open,
       CASE WHEN k % 89 = 0 THEN low WHEN k % 71 = 0 THEN high * 2 ELSE high END AS high,
       CASE WHEN k % 89 = 0 THEN high WHEN k % 67 = 0 THEN 0.4::DOUBLE ELSE low END AS low,
       CASE WHEN k % 97 = 0 THEN 0.0::DOUBLE WHEN k % 71 = 0 THEN close * 2
            WHEN k % 67 = 0 THEN 0.5::DOUBLE ELSE close END AS close,
       CASE WHEN k % 83 = 0 THEN -1 ELSE volume END AS volume, k FROM src)
  SELECT ticker, date, open, high, low, close, volume, CAST(date AS TIMESTAMP) AS ingested_at FROM faulty
  UNION ALL
  SELECT ticker, date, open, high, low, round(close * 1.01::DOUBLE, 6), volume,
         CAST(date AS TIMESTAMP) + INTERVAL 1 DAY FROM faulty WHERE k % 50 = 0""",
    "econ": f"""
  SELECT date,
         CASE p WHEN '1-URGENT' THEN 'VIXCLS' WHEN '2-HIGH' THEN 'UNRATE' WHEN '3-MEDIUM' THEN 'DFF'
                WHEN '4-NOT SPECIFIED' THEN 'DGS10' WHEN '5-LOW' THEN 'CPIAUCSL' END AS indicator_id,
         round(CASE p WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 3 WHEN '5-LOW' THEN 250 ELSE 0 END::DOUBLE
             + CASE p WHEN '1-URGENT' THEN 30 WHEN '2-HIGH' THEN 5 WHEN '3-MEDIUM' THEN 5.5
                      WHEN '4-NOT SPECIFIED' THEN 6 WHEN '5-LOW' THEN 50 END::DOUBLE * x, 6) * {UNTIE}::DOUBLE AS value
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS p,
               sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / count(*) / 100 / 499979 AS x
        FROM orders GROUP BY 1, 2)""",
    "metadata": """
  SELECT 'S' || s_suppkey AS ticker, s_name AS company_name,
         CASE r_regionkey WHEN 0 THEN 'technology' WHEN 1 THEN 'Financial Services'
              WHEN 2 THEN 'oil & gas' WHEN 4 THEN 'reit fund' END AS sector,
         CASE WHEN s_suppkey % 7 <> 3 THEN n_name END AS industry,
         CAST(round(s_acctbal * 100) AS BIGINT)::DOUBLE * 20000 AS market_cap,
         CASE WHEN s_suppkey % 11 = 5 THEN '{broken'
              ELSE '{"forwardPE": ' || (s_suppkey % 40) || '.5, "priceToBook": ' || (s_suppkey % 9)
                   || '.25, "profitMargins": 0.' || (s_suppkey % 10) || '}' END AS raw_json
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "news": """
  SELECT CAST(doc_id AS VARCHAR) AS news_id,
         '$' || upper(lang) || ' and CEO of AAPL: ' || split_part(text, chr(10), 1) AS title,
         text AS content,
         CAST(DATE '1995-01-02' + CAST(doc_id % 2000 AS INTEGER) AS TIMESTAMP) AS published_at,
         CASE WHEN doc_id % 2 = 0 THEN '["S' || (doc_id % 10) || '", "S' || ((doc_id * 7 + 3) % 10) || '"]'
              ELSE 's' || (doc_id % 10) || ', S' || ((doc_id * 7 + 3) % 10) END AS tickers,
         CASE WHEN toxic = 1 THEN -0.05 WHEN quality = 1 THEN 0.5 WHEN quality = 0 THEN -0.5 END::DOUBLE
           AS sentiment_score
  FROM documents LEFT JOIN labels USING (doc_id)""",
    "predictions": """
  SELECT 'S' || s_suppkey AS ticker, (s_suppkey % 101)::DOUBLE / 100 AS xgb_probability
  FROM supplier WHERE s_suppkey % 3 <> 0""",
    "splits": """
  SELECT 'S' || s_suppkey AS ticker, split_date, ratio
  FROM supplier, (VALUES (DATE '1998-01-01', 2.0::DOUBLE), (DATE '2000-01-01', 3.0::DOUBLE)) v(split_date, ratio)
  WHERE s_suppkey % 5 = 0""",
    "ticks": """
  SELECT event_id, 'U' || user_id AS ticker, ts, value + 100 AS price, 1::BIGINT AS size FROM events""",
}


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the fixture tables it names, and those they name."""
    known = {**SQL, **(extra or {})}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                # a table of the same name inside its own text is not a reference
                if known[name] is text:
                    continue
                need(known[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in ordered) + f"\nSELECT * FROM ({sql})"
