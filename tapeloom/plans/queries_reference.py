"""Queries on indicators, metadata, news, universe and the unified table."""

from pyspark.sql import functions as F

from tapeloom.functions import labels, text
from tapeloom.operators import economic, metadata, news, unify, universe
from tapeloom.plans import fixtures as fx
from tapeloom.plans.queries_clean import silver
from tapeloom.plans.registry import query, view
from tapeloom.sources.staging import staged_once

# ---------------------------------------------------------------- indicators
WIDE = "cpi unemployment_rate fed_funds_rate treasury_10y vix"

view("econ_wide", "SELECT date, " + ", ".join(
    f"max(value) FILTER (indicator_id = '{i}') AS {c}" for i, c in economic.INDICATOR_COLUMNS.items())
    + " FROM econ GROUP BY date")
view("econ_calendar", """
  SELECT CAST(d AS DATE) AS date, w.* EXCLUDE (date) FROM range((SELECT min(date) FROM econ_wide)::TIMESTAMP,
       (SELECT max(date) FROM econ_wide)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
  LEFT JOIN econ_wide w ON w.date = CAST(d AS DATE)""")
view("econ_filled", "SELECT date, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {c}"
    for c in economic.INDICATOR_COLUMNS.values()) + " FROM econ_calendar")
view("econ_lagged", "SELECT *, " + ", ".join(
    f"lag({c}, {n}) OVER (ORDER BY date) AS {c}_realtime" for c, n in economic.PUBLICATION_LAGS.items())
    + " FROM econ_filled")
view("econ_daily", """
  SELECT *, treasury_10y - cpi_yoy AS real_rate,
    CASE WHEN vix > 0 AND vix <= 15 THEN 'low_vol' WHEN vix > 15 AND vix <= 20 THEN 'normal'
         WHEN vix > 20 AND vix <= 30 THEN 'elevated' WHEN vix > 30 AND vix <= 100 THEN 'high_vol' END AS vix_regime,
    CASE WHEN coalesce(vix, 20) > 30 THEN 'crisis' WHEN coalesce(vix, 20) > 25 THEN 'uncertainty'
         WHEN coalesce(yield_curve_slope, 1) < 0 THEN 'inversion' WHEN coalesce(unemployment_rate, 5) > 6 THEN 'contraction'
         WHEN coalesce(unemployment_rate, 5) < 4 AND coalesce(vix, 20) < 20 THEN 'expansion' ELSE 'normal' END AS market_regime
  FROM (SELECT *, treasury_10y - fed_funds_rate AS yield_curve_slope,
               (cpi / lag(cpi, 252) OVER (ORDER BY date) - 1) * 100 AS cpi_yoy FROM econ_lagged)""")
ALL_WIDE = " ".join(economic.INDICATOR_COLUMNS.values())
REALTIME = " ".join(f"{c}_realtime" for c in economic.INDICATOR_COLUMNS.values())
DERIVED = "yield_curve_slope cpi_yoy real_rate"


def econ_daily(spark, sf):
    """The daily indicator table."""
    return staged_once(spark, sf, "econ_daily", lambda: economic.build_economic(fx.econ(spark, sf)).drop(
        "processed_at", "data_version"))


def _filled(spark, sf):
    return economic.forward_fill(economic.to_daily_calendar(economic.pivot_indicators(fx.econ(spark, sf))))


@query("econ_combine", "E01", """
  SELECT date, indicator_id, CASE WHEN indicator_id = 'DFF' THEN value + 1 ELSE value END AS value
  FROM econ""", "value")
def _(spark, sf):
    e = fx.econ(spark, sf)
    later = e.where("indicator_id = 'DFF'").withColumn("value", F.col("value") + 1)
    return economic.combine_indicators(e, later)


@query("econ_pivot", "E02", "SELECT * FROM econ_wide", ALL_WIDE)
def _(spark, sf):
    return economic.pivot_indicators(fx.econ(spark, sf))


@query("econ_calendar_days", "E03", "SELECT * FROM econ_calendar", ALL_WIDE)
def _(spark, sf):
    return economic.to_daily_calendar(economic.pivot_indicators(fx.econ(spark, sf)))


@query("econ_forward_fill", "E04", "SELECT * FROM econ_filled", ALL_WIDE)
def _(spark, sf):
    return _filled(spark, sf)


@query("econ_publication_lags", "E05", "SELECT * FROM econ_lagged", f"{ALL_WIDE} {REALTIME}")
def _(spark, sf):
    return economic.apply_publication_lags(_filled(spark, sf))


@query("econ_derived", "E06", "SELECT date, yield_curve_slope, cpi_yoy, real_rate FROM econ_daily", DERIVED)
def _(spark, sf):
    return economic.derive_indicators(_filled(spark, sf)).select("date", *DERIVED.split())


@query("econ_vix_bucket", "E07", "SELECT date, vix, vix_regime FROM econ_daily", "vix")
def _(spark, sf):
    return economic.derive_indicators(_filled(spark, sf)).select("date", "vix", "vix_regime")


@query("econ_market_regime", "E08", "SELECT date, market_regime FROM econ_daily")
def _(spark, sf):
    return economic.classify_market_regime(
        economic.derive_indicators(_filled(spark, sf))).select("date", "market_regime")


@query("econ_distribution", "E09", """
  SELECT market_regime, count(*) AS "count", count(*) * 100.0 / (SELECT count(*) FROM econ_daily) AS pct
  FROM econ_daily GROUP BY market_regime""", "pct")
def _(spark, sf):
    return economic.distribution(econ_daily(spark, sf), "market_regime")


@query("econ_build", "E10", "SELECT *, 'silver_v1' AS data_version FROM econ_daily", f"{ALL_WIDE} {REALTIME} {DERIVED}")
def _(spark, sf):
    return economic.build_economic(fx.econ(spark, sf)).drop("processed_at")


@query("econ_asof", "E11", """
  SELECT b.ticker, b.date, e.vix, e.cpi FROM bars b ASOF LEFT JOIN econ_filled e ON b.date >= e.date""", "vix cpi")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date")
    return economic.asof_indicators(b, economic.pivot_indicators(fx.econ(spark, sf)), ["vix", "cpi"])


# ------------------------------------------------------------------ metadata
_partial = " ".join(
    f"WHEN contains(s, '{k}') THEN '{v}'" for k, v in labels.SECTOR_MAPPING.items())
_exact = " ".join(f"WHEN s = '{k}' THEN '{v}'" for k, v in labels.SECTOR_MAPPING.items())
_gics = ", ".join(f"'{g}'" for g in labels.GICS_SECTORS)
view("meta_std", f"""
  SELECT * EXCLUDE (sector, s), sector AS sector_original,
         CASE WHEN s IS NULL THEN 'Unknown' {_exact} {_partial} WHEN sector IN ({_gics}) THEN sector ELSE 'Unknown' END AS sector
  FROM (SELECT *, trim(lower(sector)) AS s FROM metadata)""")
_cap = """CASE WHEN market_cap >= 10000000000 THEN 'Large' WHEN market_cap >= 2000000000 THEN 'Mid'
          WHEN market_cap > 0 THEN 'Small' ELSE 'Unknown' END"""
_json = ", ".join(
    f"CASE WHEN json_valid(raw_json) THEN CAST(json_extract_string(raw_json, '$.{f}') AS DOUBLE) END AS {c}"
    for c, f in metadata.JSON_FIELDS.items())
JSON_COLS = " ".join(metadata.JSON_FIELDS)
_sectors = "[" + ", ".join(f"'{s}'" for s in labels.VALID_SECTORS) + "]"


@query("metadata_flatten_json", "M01", f"SELECT *, {_json} FROM metadata", f"market_cap {JSON_COLS}")
def _(spark, sf):
    return metadata.flatten_metadata_json(fx.metadata(spark, sf))


@query("metadata_standardize_sector", "M02", "SELECT ticker, sector_original, sector FROM meta_std")
def _(spark, sf):
    return metadata.standardize_sectors(fx.metadata(spark, sf)).select("ticker", "sector_original", "sector")


_alias = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.SECTOR_ALIASES.items())


@query("metadata_alias_sector", "M03", f"SELECT ticker, CASE sector {_alias} ELSE sector END AS sector FROM meta_std")
def _(spark, sf):
    m = metadata.standardize_sectors(fx.metadata(spark, sf))
    return m.select("ticker", labels.alias_sector(F.col("sector")).alias("sector"))


@query("metadata_cap_category", "M04", f"SELECT ticker, {_cap} AS market_cap_category, replace({_cap}, 'Unknown', 'Small') AS plain FROM metadata")
def _(spark, sf):
    m = metadata.add_cap_category(fx.metadata(spark, sf))
    return m.select("ticker", "market_cap_category",
                    labels.market_cap_category(F.col("market_cap"), unknown=False).alias("plain"))


@query("metadata_fill_unknown", "M05", """
  SELECT ticker, company_name, coalesce(sector, 'Unknown') AS sector, coalesce(industry, 'Unknown') AS industry,
         market_cap, raw_json FROM metadata""", "market_cap")
def _(spark, sf):
    return metadata.fill_unknown(fx.metadata(spark, sf))


@query("metadata_top_sectors", "M06", """
  SELECT sector, count(*) AS "count" FROM meta_std GROUP BY sector ORDER BY 2 DESC, 1 LIMIT 3""")
def _(spark, sf):
    return metadata.top_counts(metadata.standardize_sectors(fx.metadata(spark, sf)), "sector", 3)


@query("metadata_cap_distribution", "M06", f"""
  SELECT market_cap_category, count(*) AS "count", count(*) * 100.0 / (SELECT count(*) FROM metadata) AS pct
  FROM (SELECT {_cap} AS market_cap_category FROM metadata) GROUP BY 1""", "pct")
def _(spark, sf):
    return economic.distribution(metadata.add_cap_category(fx.metadata(spark, sf)), "market_cap_category")


@query("metadata_build", "M07", f"""
  SELECT ticker, company_name, sector, sector_original, coalesce(industry, 'Unknown') AS industry, market_cap, raw_json,
         {_cap} AS market_cap_category, {_json}, 'silver_v1' AS data_version FROM meta_std""", f"market_cap {JSON_COLS}")
def _(spark, sf):
    return metadata.build_metadata(fx.metadata(spark, sf)).drop("processed_at")


@query("metadata_hash_sector", "M08", f"""
  SELECT b.ticker, b.date, coalesce(m.sector, h) AS sector,
         CASE WHEN m.sector IS NULL THEN h || ' (Auto-assigned)' ELSE coalesce(m.industry, 'Unknown') END AS industry
  FROM (SELECT ticker, date, ({_sectors})[list_reduce(
          list_transform(string_split(md5(ticker), ''), lambda c: instr('0123456789abcdef', c) - 1),
          lambda a, d: (a * 16 + d) % 10) + 1] AS h
        FROM bars) b LEFT JOIN metadata m USING (ticker)""")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date")
    return metadata.add_sector_metadata(b, fx.metadata(spark, sf))


@query("metadata_mock_sector", "M09", "SELECT ticker, 'Sector_S' AS sector FROM bars GROUP BY ticker")
def _(spark, sf):
    return metadata.mock_sector(metadata.tickers(fx.bars(spark, sf)).withColumn("sector", F.lit("Unknown")))


@query("metadata_missing_tickers", "M11", "SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (SELECT ticker FROM predictions)")
def _(spark, sf):
    return metadata.missing_tickers(fx.bars(spark, sf), fx.predictions(spark, sf))


@query("metadata_tickers", "M12", "SELECT DISTINCT ticker FROM bars")
def _(spark, sf):
    return metadata.tickers(fx.bars(spark, sf))


@query("metadata_benchmark_dim", "M13", """
  SELECT CASE WHEN ticker = 'SPY' THEN 'SPY' WHEN ticker = 'S1' THEN 'VIX' ELSE ticker END AS ticker, date,
         CASE WHEN volume % 3000 = 0 THEN 0 ELSE volume END AS volume,
         CASE ticker WHEN 'SPY' THEN 'S&P 500 ETF' WHEN 'S1' THEN 'CBOE Volatility Index' ELSE ticker END AS benchmark_name,
         CASE ticker WHEN 'SPY' THEN 'broad_market' WHEN 'S1' THEN 'volatility' ELSE 'unknown' END AS category
  FROM bars""")
def _(spark, sf):
    b = fx.bars(spark, sf).select(
        F.when(F.col("ticker") == "S1", "^VIX").otherwise(F.col("ticker")).alias("ticker"), "date",
        F.when(F.col("volume") % 3000 != 0, F.col("volume")).alias("volume"))
    return metadata.benchmark_dim_join(b)


# ---------------------------------------------------------------------- news
_ws = r"\t\n\v\f\r \x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _html(c):
    return f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g')"


def _special(c):
    return f"regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}_{_ws}.,!?;:''-]', ' ', 'g')"


def _space(c):
    return f"trim(regexp_replace(coalesce({c}, ''), '[{_ws}]+', ' ', 'g'))"


def _clean(c):
    return _space(_special(_html(c)))


_black = "[" + ", ".join(f"'{w}'" for w in text.TICKER_BLACKLIST) + "]"
# RE2 knows ASCII word borders only: words are cut at every other character first
_words = r"string_split_regex({c}, '[^\p{{L}}\p{{N}}\p{{M}}_]+')"


def _extract(c):
    words = f"list_filter({_words.format(c=c)}, lambda w: regexp_full_match(w, '[A-Z]{{2,5}}'))"
    return f"list_filter(list_distinct({words}), lambda w: NOT list_contains({_black}, w))"


_parse = """list_filter(list_transform(
    CASE WHEN json_valid(tickers) THEN json_extract_string(tickers, '$[*]') ELSE string_split(tickers, ',') END,
    lambda x: upper(trim(x))), lambda x: x <> '')"""


@query("text_clean_html", "N01", f"SELECT page_id, {_html('html')} AS cleaned FROM pages")
def _(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query("text_clean_special", "N02", f"SELECT doc_id, {_special('text')} AS cleaned FROM documents")
def _(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", text.clean_special(F.col("text")).alias("cleaned"))


@query("text_clean", "N03", f"SELECT page_id, {_clean('html')} AS cleaned FROM pages")
def _(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


@query("text_collapse_space", "N03", f"SELECT doc_id, {_space('text')} AS cleaned FROM documents")
def _(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", text.collapse_space(F.col("text")).alias("cleaned"))


@query("text_extract_tickers", "N04", f"""
  SELECT news_id, array_to_string(list_sort(list_distinct(list_concat({_extract('title')},
         list_transform(regexp_extract_all(title, '\\$([A-Z]{{1,5}})', 1), lambda x: x)))), ',') AS title_tickers,
         array_to_string(list_sort({_extract('content')}), ',') AS content_tickers FROM news""")
def _(spark, sf):
    n = fx.news(spark, sf)
    return n.select(
        "news_id",
        F.array_join(text.extract_tickers(F.col("title")), ",").alias("title_tickers"),
        F.array_join(text.extract_tickers(F.col("content")), ",").alias("content_tickers"))


@query("text_extract_tickers_valid", "N04", f"""
  SELECT news_id, array_to_string(list_filter(list_sort(list_distinct(list_concat({_extract('title')},
         regexp_extract_all(title, '\\$([A-Z]{{1,5}})', 1)))), lambda w: w IN ('AAPL', 'EN')), ',') AS title_tickers
  FROM news""")
def _(spark, sf):
    valid = F.array(F.lit("AAPL"), F.lit("EN"))
    n = fx.news(spark, sf)
    return n.select("news_id", F.array_join(text.extract_tickers(F.col("title"), valid), ",").alias("title_tickers"))


@query("text_parse_tickers", "N05", f"SELECT news_id, array_to_string({_parse}, ',') AS listed FROM news")
def _(spark, sf):
    return fx.news(spark, sf).select("news_id", F.array_join(text.parse_tickers(F.col("tickers")), ",").alias("listed"))


_cat = "CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative' ELSE 'neutral' END"


@query("text_sentiment_class", "N06", f"SELECT news_id, {_cat} AS category FROM news")
def _(spark, sf):
    return fx.news(spark, sf).select("news_id", labels.sentiment_category(F.col("sentiment_score")).alias("category"))


view("universe_sources", f"""
  SELECT 'prices' AS source, ticker FROM bars WHERE ticker <> 'S3' GROUP BY ticker
  UNION ALL SELECT 'metadata', ticker FROM metadata WHERE market_cap > 0
  UNION ALL SELECT DISTINCT 'news', unnest({_parse}) FROM news
  UNION ALL SELECT 'benchmarks', 'SPY'""")
view("articles", f"""
  SELECT a.*, list_sort(list_distinct(list_concat(listed, list_filter(found, lambda x: list_contains(u.all_t, x))))) AS extracted,
         len(list_filter(list_concat(listed, found), lambda x: list_contains(u.all_t, x))) > 0 AS has_valid_tickers
  FROM (SELECT *, {_clean('title')} AS title_clean, {_clean('content')} AS content_clean,
               CAST(published_at AS DATE) AS news_date, {_cat} AS sentiment_category, {_parse} AS listed,
               list_concat({_extract(_clean('title'))}, {_extract(_clean('content'))}) AS found FROM news) a,
       (SELECT list(DISTINCT ticker) AS all_t FROM universe_sources) u""")
view("news_table", """
  SELECT date, ticker, count(sentiment_score) AS news_count, avg(sentiment_score) AS avg_sentiment,
         count(*) FILTER (sentiment_category = 'positive') AS positive_count,
         count(*) FILTER (sentiment_category = 'negative') AS negative_count,
         count(*) FILTER (sentiment_category = 'neutral') AS neutral_count, count(*) AS article_count,
         string_agg(title, ' | ' ORDER BY rk) FILTER (rk <= 5) AS headlines
  FROM (SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY published_at, news_id) AS rk
        FROM (SELECT news_date AS date, unnest(extracted) AS ticker, title, published_at, news_id,
                     sentiment_score, sentiment_category FROM articles)
        WHERE ticker IN (SELECT ticker FROM universe_sources)) GROUP BY date, ticker""")


def _build_universe(spark, sf):
    b, m = fx.bars(spark, sf), fx.metadata(spark, sf)
    return universe.build_universe({
        "prices": b.where("ticker <> 'S3'").select("ticker"),
        "metadata": m.where("market_cap > 0"),
        "news": news.mentioned_tickers(fx.news(spark, sf)),
        "benchmarks": b.where("ticker = 'SPY'").select("ticker"),
    })


def universe_table(spark, sf):
    return staged_once(spark, sf, "universe", lambda: _build_universe(spark, sf))


def articles(spark, sf):
    return news.process_articles(fx.news(spark, sf), universe_table(spark, sf))


def news_table(spark, sf):
    return staged_once(spark, sf, "news_table", lambda: news.aggregate_news(
        articles(spark, sf), universe_table(spark, sf)))


@query("news_process_articles", "N07", """
  SELECT news_id, title_clean, content_clean, news_date, sentiment_category, has_valid_tickers,
         array_to_string(extracted, ',') AS extracted_tickers FROM articles""")
def _(spark, sf):
    return articles(spark, sf).select(
        "news_id", "title_clean", "content_clean", "news_date", "sentiment_category", "has_valid_tickers",
        F.array_join("extracted_tickers", ",").alias("extracted_tickers"))


@query("news_aggregate", "N08", "SELECT * FROM news_table", "avg_sentiment")
def _(spark, sf):
    u = universe_table(spark, sf)
    return news.aggregate_news(news.process_articles(fx.news(spark, sf), u), u)


@query("news_valid_tickers", "N09", "SELECT ticker FROM bars WHERE ticker <> 'S3' GROUP BY ticker")
def _(spark, sf):
    return news.valid_tickers(universe_table(spark, sf), fx.bars(spark, sf))


@query("news_valid_tickers_fallback", "N09", "SELECT DISTINCT ticker FROM bars")
def _(spark, sf):
    return news.valid_tickers(universe_table(spark, sf).where("source <> 'prices'"), fx.bars(spark, sf))


view("news_days", """
  SELECT date, ticker, CAST(sum(news_count) AS BIGINT) AS daily_news_count, avg(avg_sentiment) AS daily_sentiment,
         CAST(sum(positive_count) AS BIGINT) AS positive_count, CAST(sum(negative_count) AS BIGINT) AS negative_count
  FROM news_table GROUP BY date, ticker""")


@query("news_daily", "N10", "SELECT * FROM news_days", "daily_sentiment")
def _(spark, sf):
    return news.news_daily(news_table(spark, sf))


def _hits(words):
    return " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in words)


@query("news_lexicon_sentiment", "N11", f"""
  SELECT doc_id, CASE WHEN {_hits(text.POSITIVE_WORDS)} > {_hits(text.NEGATIVE_WORDS)} THEN 'positive'
         WHEN {_hits(text.NEGATIVE_WORDS)} > {_hits(text.POSITIVE_WORDS)} THEN 'negative' ELSE 'neutral' END AS label
  FROM documents""")
def _(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", text.lexicon_sentiment(F.col("text")).alias("label"))


@query("news_stable_id", "N12", """
  SELECT news_id, substring(md5(title || strftime(published_at, '%Y-%m-%d %H:%M:%S')), 1, 16) AS stable_id FROM news""")
def _(spark, sf):
    return fx.news(spark, sf).select("news_id", text.news_id(F.col("title"), F.col("published_at")).alias("stable_id"))


@query("news_mentioned_tickers", "N14", f"SELECT DISTINCT unnest({_parse}) AS ticker FROM news")
def _(spark, sf):
    return news.mentioned_tickers(fx.news(spark, sf))


# ------------------------------------------------------------------ universe
_counts = "SELECT ticker, count(*) AS n FROM universe_sources GROUP BY ticker"


_listed = "SELECT ticker, count(*) AS n FROM universe_sources WHERE source <> 'benchmarks' GROUP BY ticker"


@query("universe_register", "U01", """
  SELECT source, ticker FROM universe_sources WHERE source <> 'news'
  UNION ALL SELECT 'news', ticker FROM predictions""")
def _(spark, sf):
    messy = fx.predictions(spark, sf).select(F.concat(F.lit(" "), F.lower("ticker")).alias("ticker"))
    return universe.register_source(universe_table(spark, sf), "news", messy)


@query("universe_intersection", "U02", f"SELECT ticker FROM ({_listed}) WHERE n = 3")
def _(spark, sf):
    return universe.universe_intersection(universe_table(spark, sf).where("source <> 'benchmarks'"))


@query("universe_intersection_named", "U02", """
  SELECT ticker FROM universe_sources WHERE source = 'prices'
  INTERSECT SELECT ticker FROM universe_sources WHERE source = 'news'""")
def _(spark, sf):
    return universe.universe_intersection(universe_table(spark, sf), ["prices", "news", "absent"])


@query("universe_union", "U03", "SELECT DISTINCT ticker FROM universe_sources")
def _(spark, sf):
    return universe.universe_union(universe_table(spark, sf))


SOURCES = ("prices", "metadata", "news", "benchmarks")


@query("universe_coverage", "U04", "SELECT ticker, " + ", ".join(
    f"bool_or(source = '{s}') AS {s}" for s in SOURCES) + ", count(*) AS source_count FROM universe_sources GROUP BY ticker")
def _(spark, sf):
    return universe.universe_coverage(universe_table(spark, sf), SOURCES)


@query("universe_summary", "U05", f"""
  SELECT 'source:' || source AS measure, count(*) AS "count" FROM universe_sources GROUP BY source
  UNION ALL SELECT 'total_sources', count(DISTINCT source) FROM universe_sources
  UNION ALL SELECT 'union', count(DISTINCT ticker) FROM universe_sources
  UNION ALL SELECT 'intersection', count(*) FROM ({_counts}) WHERE n = 4""")
def _(spark, sf):
    return universe.universe_summary(universe_table(spark, sf))


@query("universe_filter", "U06", """
  SELECT ticker, date, close FROM bars
  WHERE ticker IN (SELECT ticker FROM universe_sources WHERE source = 'prices')
    AND ticker IN (SELECT ticker FROM universe_sources WHERE source = 'news')""", "close")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date", "close")
    return universe.filter_universe(b, universe_table(spark, sf), required=["prices", "news"])


@query("universe_filter_min", "U06", f"""
  SELECT ticker, date, close FROM bars WHERE ticker IN (SELECT ticker FROM ({_counts}) WHERE n >= 3)""", "close")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date", "close")
    return universe.filter_universe(b, universe_table(spark, sf), min_sources=3)


@query("universe_analyzed", "U07", f"SELECT ticker FROM ({_counts}) WHERE n >= 2")
def _(spark, sf):
    return universe.analyzed_tickers(universe_table(spark, sf), 2)


@query("universe_analyzed_all", "U07", f"SELECT ticker FROM ({_listed}) WHERE n = 3")
def _(spark, sf):
    return universe.analyzed_tickers(universe_table(spark, sf).where("source <> 'benchmarks'"), 9)


@query("universe_build", "U08", "SELECT source, ticker FROM universe_sources")
def _(spark, sf):
    return _build_universe(spark, sf)


# ------------------------------------------------------------- unified table
view("spy", """
  SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS spy_return, close AS spy_close FROM bars WHERE ticker = 'SPY'""")
view("bars_econ", """
  SELECT b.*, e.vix, e.fed_funds_rate, e.treasury_10y, coalesce(e.market_regime, 'unknown') AS market_regime,
         e.yield_curve_slope, e.unemployment_rate FROM silver b ASOF LEFT JOIN econ_daily e ON b.date >= e.date""")
ECON_COLS = "vix fed_funds_rate treasury_10y yield_curve_slope unemployment_rate"
META_SQL = f"SELECT ticker, company_name, sector, industry, market_cap, {_cap} AS market_cap_category FROM meta_std"
view("unified", f"""
  SELECT b.ticker, b.date, b.open, b.high, b.low, b.close, b.volume, b.daily_return,
         coalesce(m.sector, b.sector) AS sector, coalesce(m.industry, b.industry) AS industry,
         m.company_name, m.market_cap, m.market_cap_category, s.spy_return, s.spy_close,
         b.vix, b.fed_funds_rate, b.treasury_10y, b.market_regime, b.yield_curve_slope, b.unemployment_rate,
         coalesce(n.daily_news_count, 0) AS daily_news_count, n.daily_sentiment, n.positive_count, n.negative_count
  FROM bars_econ b LEFT JOIN ({META_SQL}) m USING (ticker) LEFT JOIN spy s ON s.date = b.date
       LEFT JOIN news_days n ON n.date = b.date AND n.ticker = b.ticker
  WHERE b.ticker IN (SELECT ticker FROM ({_counts}) WHERE n >= 2)""")


def _meta(spark, sf):
    return metadata.add_cap_category(metadata.standardize_sectors(fx.metadata(spark, sf)))


def unified(spark, sf, k=2):
    return unify.unify(
        silver(spark, sf), _meta(spark, sf), unify.benchmark_returns(fx.bars(spark, sf)),
        econ_daily(spark, sf), news.news_daily(news_table(spark, sf)), universe_table(spark, sf), k)


@query("join_metadata_dim", "J01", META_SQL, "market_cap")
def _(spark, sf):
    return unify.metadata_dim(_meta(spark, sf))


@query("join_benchmark_returns", "J02", "SELECT * FROM spy", "spy_return spy_close")
def _(spark, sf):
    return unify.benchmark_returns(fx.bars(spark, sf))


@query("join_metadata", "J03", f"""
  SELECT b.ticker, b.date, coalesce(m.sector, b.sector) AS sector, coalesce(m.industry, b.industry) AS industry,
         b.close, m.company_name, m.market_cap, m.market_cap_category, 0 AS dup FROM silver b
  LEFT JOIN ({META_SQL}) m USING (ticker)""", "close market_cap")
def _(spark, sf):
    s = silver(spark, sf).select("ticker", "date", "sector", "industry", "close")
    return unify.join_metadata(s, unify.metadata_dim(_meta(spark, sf))).withColumn("dup", F.lit(0))


@query("join_benchmark", "J04", """
  SELECT b.ticker, b.date, s.spy_return, s.spy_close FROM bars b LEFT JOIN spy s USING (date)""", "spy_return spy_close")
def _(spark, sf):
    b = fx.bars(spark, sf)
    return unify.join_benchmark(b.select("ticker", "date"), unify.benchmark_returns(b))


@query("join_economic", "J05", f"""
  SELECT ticker, date, vix, fed_funds_rate, treasury_10y, market_regime, yield_curve_slope, unemployment_rate
  FROM bars_econ""", ECON_COLS)
def _(spark, sf):
    return unify.join_economic(fx.bars(spark, sf).select("ticker", "date"), econ_daily(spark, sf))


@query("join_news", "J06", """
  SELECT b.ticker, b.date, coalesce(daily_news_count, 0) AS daily_news_count, daily_sentiment, positive_count, negative_count
  FROM bars b LEFT JOIN news_days USING (date, ticker)""", "daily_sentiment")
def _(spark, sf):
    return unify.join_news(fx.bars(spark, sf).select("ticker", "date"), news.news_daily(news_table(spark, sf)))


@query("join_filter_min_sources", "J07", f"""
  SELECT ticker, date FROM bars WHERE ticker IN (SELECT ticker FROM ({_counts}) WHERE n >= 2)""")
def _(spark, sf):
    return universe.filter_min_sources(fx.bars(spark, sf).select("ticker", "date"), universe_table(spark, sf), 2)


@query("join_filter_min_sources_noop", "J07", "SELECT ticker, date FROM bars")
def _(spark, sf):
    return universe.filter_min_sources(fx.bars(spark, sf).select("ticker", "date"), universe_table(spark, sf), 9)


UNIFIED_DOUBLES = "open high low close daily_return market_cap spy_return spy_close daily_sentiment " + ECON_COLS


@query("join_unified", "J08", "SELECT *, 'unified_v1' AS data_version FROM unified", UNIFIED_DOUBLES)
def _(spark, sf):
    return unified(spark, sf).drop("unified_at")


@query("quality_join_coverage", "V23", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null, count({c}) * 100.0 / count(*) AS coverage_pct FROM unified"""
    for c in ("spy_return", "vix", "market_regime", "daily_sentiment", "company_name", "market_cap_category")), "coverage_pct")
def _(spark, sf):
    from tapeloom.operators.quality import join_coverage

    return join_coverage(unified(spark, sf))


@query("join_semi_universe", "J09", """
  SELECT ticker, date FROM bars WHERE ticker IN (SELECT ticker FROM predictions WHERE xgb_probability > 0.5)""")
def _(spark, sf):
    keep = fx.predictions(spark, sf).where("xgb_probability > 0.5")
    return unify.semi_join_universe(fx.bars(spark, sf).select("ticker", "date"), keep)


view("econ_trading_days", """
  SELECT *, CASE WHEN "VIX" > 0 AND "VIX" <= 15 THEN 0 WHEN "VIX" > 15 AND "VIX" <= 25 THEN 1
                 WHEN "VIX" > 25 AND "VIX" <= 100 THEN 2 END::DOUBLE AS vix_regime,
         "VIX" / lag("VIX", 5) OVER (ORDER BY date) - 1 AS vix_change_5d,
         "EFFR" - lag("EFFR", 20) OVER (ORDER BY date) AS rate_change_20d
  FROM (SELECT d.date, e.vix AS "VIX", e.fed_funds_rate AS "EFFR" FROM (SELECT DISTINCT date FROM bars) d
        ASOF LEFT JOIN econ_daily e ON d.date >= e.date)""")
ECON_FEATURES = "VIX EFFR vix_regime vix_change_5d rate_change_20d"


@query("features_economic", "J11", """
  SELECT ticker, e.* FROM bars JOIN econ_trading_days e USING (date)""", ECON_FEATURES)
def _(spark, sf):
    return unify.economic_features(fx.bars(spark, sf).select("ticker", "date"), econ_daily(spark, sf))


view("bars_news", """
  SELECT *, ln(1 + news_count) AS news_attention,
         avg(news_sentiment) OVER (PARTITION BY ticker ORDER BY date ROWS 4 PRECEDING) AS sentiment_ma5
  FROM (SELECT b.ticker, b.date, coalesce(n.avg_sentiment, 0) AS news_sentiment, coalesce(n.news_count, 0) AS news_count
        FROM bars b LEFT JOIN news_table n USING (ticker, date))""")


@query("features_news", "J12", "SELECT * FROM bars_news", "news_sentiment news_attention sentiment_ma5")
def _(spark, sf):
    return unify.news_features(fx.bars(spark, sf).select("ticker", "date"), news_table(spark, sf))


@query("join_ticker_sector", "J14", "SELECT ticker, min(sector) AS sector FROM silver GROUP BY ticker")
def _(spark, sf):
    return unify.ticker_sector(silver(spark, sf))
