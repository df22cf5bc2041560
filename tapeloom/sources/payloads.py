"""Landed vendor payloads (JSON text, one per row in ``payload``) to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE = (
    "docs array<struct<_id:string,headline:struct<main:string>,abstract:string,lead_paragraph:string,"
    "pub_date:string,section_name:string,news_desk:string,web_url:string,"
    "keywords:array<struct<value:string>>>>"
)
MARKET_NEWS = (
    "array<struct<id:string,headline:string,summary:string,source:string,url:string,"
    "datetime:bigint,related:string>>"
)
ARTICLES = (
    "articles array<struct<title:string,description:string,content:string,url:string,"
    "publishedAt:string,author:string,source:struct<name:string>>>"
)
OBSERVATIONS = "observations array<struct<date:string,value:string>>"
BARS = "ticker string, results array<struct<t:bigint,o:double,h:double,l:double,c:double,v:double>>"

_NEWS = ("news_id", "title", "summary", "content", "source", "url", "published_at", "tickers",
         "sentiment_score", "sentiment_label")


def _news(df: DataFrame, **cols) -> DataFrame:
    cols = {"tickers": F.lit(None).cast("string"), "sentiment_score": F.lit(None).cast("double"),
            "sentiment_label": F.lit(None).cast("string"), **cols}
    extra = [c for c in cols if c not in _NEWS]
    return df.select(*[cols[c].alias(c) for c in (*_NEWS, *extra)])


def flatten_news_payload(df: DataFrame, kind: str, payload: str = "payload") -> DataFrame:
    """News rows of an ``archive``, ``market`` or ``articles`` payload. A missing
    or unreadable payload gives no rows."""
    d = lambda f: F.col(f"d.{f}")
    if kind == "archive":
        rows = df.select(F.explode(F.from_json(payload, ARCHIVE)["docs"]).alias("d"))
        return _news(
            rows, news_id=d("_id"), title=d("headline.main"), summary=d("abstract"),
            content=d("lead_paragraph"), source=F.lit("archive"), url=d("web_url"),
            published_at=F.try_to_timestamp(d("pub_date")),
            section=d("section_name"), news_desk=d("news_desk"),
            keywords=F.to_json(F.coalesce(d("keywords.value"), F.array().cast("array<string>"))),
            raw_json=F.to_json("d"))
    if kind == "market":
        # a lone object would be read as a list of one
        listed = F.when(F.ltrim(payload).startswith("["), F.col(payload))
        rows = df.select(F.explode(F.from_json(listed, MARKET_NEWS)).alias("d"))
        related = F.when(d("related") != "", F.split(d("related"), ","))
        return _news(
            rows, news_id=d("id"), title=d("headline"), summary=d("summary"), content=d("summary"),
            source=d("source"), url=d("url"), published_at=F.timestamp_seconds(d("datetime")),
            tickers=F.to_json(F.coalesce(related, F.array().cast("array<string>"))),
            raw_json=F.to_json("d"))
    if kind == "articles":
        rows = df.select(F.explode(F.from_json(payload, ARTICLES)["articles"]).alias("d"))
        return _news(
            rows, news_id=F.substring(F.md5(F.coalesce(d("url"), F.lit("")).cast("binary")), 1, 16),
            title=d("title"), summary=d("description"), content=d("content"), source=d("source.name"),
            url=d("url"), published_at=F.try_to_timestamp(d("publishedAt")), author=d("author"),
            raw_json=F.to_json("d"))
    raise ValueError(f"unknown news payload {kind}")


def flatten_observations(df: DataFrame, series: str = "indicator_id", payload: str = "payload") -> DataFrame:
    """(date, indicator_id, value); a ``.`` or unreadable value is no observation."""
    rows = df.select(series, F.explode(F.from_json(payload, OBSERVATIONS)["observations"]).alias("o"))
    return rows.select(
        F.try_to_timestamp(F.col("o.date")).cast("date").alias("date"),
        F.col(series).alias("indicator_id"),
        F.nullif(F.col("o.value"), F.lit(".")).try_cast("double").alias("value"),
    ).dropna(subset=["date", "value"])


def flatten_bars_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Daily bars out of a vendor response with epoch milliseconds."""
    parsed = df.select(F.from_json(payload, BARS).alias("p"))
    rows = parsed.select("p.ticker", F.explode("p.results").alias("b"))
    return rows.select(
        F.to_date(F.timestamp_millis("b.t")).alias("date"), "ticker",
        F.col("b.o").alias("open"), F.col("b.h").alias("high"), F.col("b.l").alias("low"),
        F.col("b.c").alias("close"), F.col("b.v").cast("long").alias("volume"))
