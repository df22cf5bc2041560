"""News articles and their daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import labels, text

HEADLINES = 5


def valid_tickers(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Tickers registered under ``prices``, else the distinct tickers of the bars."""
    listed = universe.where(F.col("source") == "prices").select("ticker").distinct()
    none = listed.agg(F.count(F.lit(1)).alias("n")).scalar() == 0
    return listed.unionByName(bars.select("ticker").where(none).distinct())


def process_articles(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Cleaned text, date, tickers and sentiment class; one row per ``news_id``.

    Names found in the text must be in the universe; names the article lists
    itself are kept. The check is a join, so the universe may be of any size.
    """
    out = df.withColumns({
        f"{c}_clean": text.clean_text(F.col(c))
        for c in ("title", "summary", "content") if c in df.columns
    })
    published = (
        F.try_to_timestamp(F.col("published_at"))
        if dict(df.dtypes)["published_at"] == "string" else F.col("published_at")
    )
    score = F.col("sentiment_score") if "sentiment_score" in df.columns else F.lit(None).cast("double")
    out = out.withColumn("published_at", published).withColumns({
        "news_date": F.to_date("published_at"),
        "sentiment_category": labels.sentiment_category(score),
        "__listed": text.parse_tickers(F.col("tickers")),
    })
    parts = [text.extract_tickers(F.col(c)) for c in ("title_clean", "content_clean") if c in out.columns]
    found = parts[0] if len(parts) == 1 else F.array_union(*parts)
    names = (
        out.select("news_id", "__listed", F.explode(F.array_union("__listed", found)).alias("ticker"))
        .select("news_id", "ticker", F.array_contains("__listed", F.col("ticker")).alias("listed"))
        .join(universe.select("ticker").distinct().withColumn("valid", F.lit(True)), "ticker", "left")
    )
    keep = F.col("listed") | F.col("valid").isNotNull()
    per_article = names.groupBy("news_id").agg(
        F.array_sort(F.collect_set(F.when(keep, F.col("ticker")))).alias("extracted_tickers"),
        F.bool_or(F.col("valid").isNotNull()).alias("has_valid_tickers"),
    )
    out = out.join(per_article, "news_id", "left").drop("__listed")
    return out.withColumns({
        "extracted_tickers": F.coalesce("extracted_tickers", F.array().cast("array<string>")),
        "has_valid_tickers": F.coalesce("has_valid_tickers", F.lit(False)),
    })


def mentions(articles: DataFrame, universe: DataFrame) -> DataFrame:
    """One row per article and ticker of the universe."""
    return articles.withColumn("ticker", F.explode("extracted_tickers")).join(
        universe.select("ticker").distinct(), "ticker", "left_semi")


def aggregate_news(articles: DataFrame, universe: DataFrame) -> DataFrame:
    """One row per date and ticker: counts, mean score, first five headlines.

    ``news_count`` counts scored articles only; ``article_count`` counts all.
    """
    rows = mentions(articles, universe).select(
        F.col("news_date").alias("date"), "ticker", "title", "published_at", "news_id",
        "sentiment_score", "sentiment_category")
    is_ = lambda c: F.count_if(F.col("sentiment_category") == c)
    daily = rows.groupBy("date", "ticker").agg(
        F.count("sentiment_score").alias("news_count"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        is_("positive").alias("positive_count"),
        is_("negative").alias("negative_count"),
        is_("neutral").alias("neutral_count"),
        F.count(F.lit(1)).alias("article_count"),
    )
    w = Window.partitionBy("date", "ticker").orderBy("published_at", "news_id")
    first = (
        rows.where(F.col("title").isNotNull()).select("date", "ticker", "published_at", "news_id", "title")
        .withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= HEADLINES)
        .groupBy("date", "ticker")
        .agg(F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rk", "title"))), lambda s: s["title"]),
            " | ").alias("headlines"))
    )
    return daily.join(first, ["date", "ticker"], "left")


def news_daily(df: DataFrame) -> DataFrame:
    """Processed news to one row per date and ticker, under the unified names."""
    return df.groupBy("date", "ticker").agg(
        F.sum("news_count").alias("daily_news_count"),
        F.avg("avg_sentiment").alias("daily_sentiment"),
        F.sum("positive_count").alias("positive_count"),
        F.sum("negative_count").alias("negative_count"),
    )


def mentioned_tickers(df: DataFrame, col: str = "tickers") -> DataFrame:
    return df.select(F.explode(text.parse_tickers(F.col(col))).alias("ticker")).distinct()
