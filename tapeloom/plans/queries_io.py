"""Source, sink, snapshot and streaming queries. Each writes to a new folder of
the shared directory and reads the result back."""

import os
import uuid

from pyspark.sql import functions as F

from tapeloom.contracts import BARS
from tapeloom.operators import calendars
from tapeloom.plans import fixtures as fx
from tapeloom.plans.queries_clean import silver
from tapeloom.plans.queries_gold import holdings
from tapeloom.plans.registry import query, view
from tapeloom.sources import payloads, readers, sinks, snapshots
from tapeloom.sources.partitions import by_day, by_hash
from tapeloom.sources.staging import shared_dir, staged_once
from tapeloom.streaming import bars as live
from tapeloom.streaming import refresh

PRICES = "open high low close"


def folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(spark, df, name):
    path = folder(spark, name)
    df.write.parquet(path)
    return path


def _pascal(df):
    return df.select(*[F.col(c).alias(c.capitalize()) for c in df.columns])


RANGE = "date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"


@query("source_bars", "S01", f"SELECT * FROM bars WHERE {RANGE}", PRICES)
def _(spark, sf):
    extra = _pascal(fx.bars(spark, sf)).withColumn("Ignored", F.lit(1))
    return readers.read_bars(spark, written(spark, extra, "bars"), start="1997-01-01", end="1999-12-31")


@query("source_bars_partitioned", "S02", f"SELECT * FROM bars WHERE {RANGE}", PRICES)
def _(spark, sf):
    return readers.read_bars(spark, by_date(spark, sf), start="1997-01-01", end="1999-12-31")


_by_date = {}


def by_date(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _by_date:
        _by_date[key] = folder(spark, "by-date")
        sinks.write_by_date(fx.bars(spark, sf), _by_date[key])
    return _by_date[key]


@query("source_sample_tickers", "S03", """
  SELECT * FROM bars WHERE ticker IN (
    SELECT ticker FROM (SELECT DISTINCT ticker FROM bars) ORDER BY md5(ticker || '42'), ticker LIMIT 10)""", PRICES)
def _(spark, sf):
    return readers.sample_tickers(fx.bars(spark, sf), 10)


@query("source_bars_csv", "S04", "SELECT * FROM bars", PRICES)
def _(spark, sf):
    path = folder(spark, "csv")
    fx.bars(spark, sf).select(*BARS.names).write.option("header", True).csv(path)
    return readers.read_bars_csv(spark, path)


@query("source_vendor_csv", "S05", f"SELECT *, TRUE AS stamped FROM bars WHERE {RANGE}", PRICES)
def _(spark, sf):
    path = folder(spark, "vendor")
    names = {v: k for k, v in readers.VENDOR_COLUMNS.items()}
    fx.bars(spark, sf).withColumnsRenamed(names).write.option("header", True).csv(path)
    out = readers.import_vendor_csv(spark, path, "1997-01-01", "1999-12-31")
    return out.withColumn("stamped", F.col("ingested_at").isNotNull()).drop("ingested_at")


@query("source_unpivot", "S06", "SELECT date, ticker, open, high, low, close, volume FROM bars", PRICES)
def _(spark, sf):
    bars = fx.bars(spark, sf)
    fields = ("open", "high", "low", "close", "volume")
    path = folder(spark, "wide")
    wide, places = readers.widen_bars(bars, fields)  # blocks of tickers: no file has a column for every ticker
    wide.write.parquet(path)
    return readers.unpivot_bars(spark.read.parquet(path), places, fields)


@query("source_normalize", "S07", """
  SELECT date, ticker, open, high, low, CASE WHEN volume % 7000 <> 0 THEN close END AS close,
         CASE WHEN volume % 3000 = 0 THEN 0 ELSE volume END AS volume FROM bars""", PRICES)
def _(spark, sf):
    b = fx.bars(spark, sf)
    v = F.col("volume")
    return readers.normalize_bars(b.withColumns({
        "close": F.when(v % 7000 == 0, F.lit("n/a")).otherwise(F.col("close").cast("string")),
        "volume": F.when(v % 3000 != 0, v.cast("string"))}))


@query("source_canonicalize", "S08", "SELECT ticker, date, close FROM bars", "close")
def _(spark, sf):
    return readers.canonicalize_columns(fx.bars(spark, sf).select(
        F.col("ticker").alias("Symbol"), F.col("date").alias("Date"), F.col("close").alias("CLOSE")))


@query("source_fallback", "S09", """
  SELECT ticker, date, CASE WHEN volume % 2000 = 0 THEN close ELSE close + 1 END AS close FROM bars""", "close")
def _(spark, sf):
    b = fx.bars(spark, sf).select("ticker", "date", "close", "volume")
    second = b.withColumn("close", F.col("close") + 1)
    first = b.where(F.col("volume") % 2000 == 0).drop("volume")
    return readers.coalesce_sources([(2, second), (1, first)]).drop("volume")


@query("source_json_records", "S10", "SELECT news_id, title, sentiment_score FROM news", "sentiment_score")
def _(spark, sf):
    path = folder(spark, "json")
    fx.news(spark, sf).select("news_id", "title", "sentiment_score").write.json(path)
    return readers.read_json_records(
        spark, path, "news_id string, title string, sentiment_score double", multi_line=False)


@query("source_text_documents", "S11", r"""
  SELECT regexp_replace(text, '\s+', ' ', 'g') AS text, TRUE AS keyed FROM documents""")
def _(spark, sf):
    # files of a bounded number of one-line documents; every file comes back as one row
    path = folder(spark, "texts")
    line = F.regexp_replace("text", r"[\t\n\f\r ]+", " ")
    fx.table(spark, sf, "documents").select(line).write.option("maxRecordsPerFile", 500).text(path)
    files = readers.read_text_documents(spark, path)
    return files.select(
        F.explode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n")).alias("text"),
        (F.startswith("doc_id", F.lit("part-")) & ~F.contains("doc_id", F.lit("."))).alias("keyed"))


# ---- vendor payloads built from the tables
def _payload(df, value):
    return df.select(F.to_json(value).alias("payload"))


@query("source_news_archive", "S12", """
  SELECT 'n' || news_id AS news_id, title, content AS summary, content, published_at,
         '["S' || (CAST(news_id AS INT) % 10) || '"]' AS keywords FROM news""")
def _(spark, sf):
    doc = F.struct(
        F.concat(F.lit("n"), "news_id").alias("_id"), F.struct(F.col("title").alias("main")).alias("headline"),
        F.col("content").alias("abstract"), F.col("content").alias("lead_paragraph"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss+0000").alias("pub_date"),
        F.array(F.struct(F.concat(F.lit("S"), (F.col("news_id").cast("int") % 10).cast("string")).alias("value"))).alias("keywords"))
    p = _payload(fx.news(spark, sf), F.struct(F.array(doc).alias("docs")))
    out = payloads.flatten_news_payload(p, "archive")
    return out.select("news_id", "title", "summary", "content",
                      F.col("published_at").cast("timestamp_ntz").alias("published_at"), "keywords")


@query("source_news_market", "S12", """
  SELECT news_id, title, published_at, CASE WHEN CAST(news_id AS INT) % 2 = 0
         THEN '["S' || (CAST(news_id AS INT) % 10) || '","SPY"]' ELSE '[]' END AS tickers FROM news""")
def _(spark, sf):
    n = F.col("news_id").cast("long")
    item = F.struct(
        n.alias("id"), F.col("title").alias("headline"),
        F.unix_timestamp(F.col("published_at").cast("timestamp")).alias("datetime"),
        F.when(n % 2 == 0, F.concat(F.lit("S"), (n % 10).cast("string"), F.lit(",SPY"))).otherwise("").alias("related"))
    out = payloads.flatten_news_payload(_payload(fx.news(spark, sf), F.array(item)), "market")
    return out.select("news_id", "title", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "tickers")


@query("source_news_articles", "S12", """
  SELECT substring(md5('u' || news_id), 1, 16) AS news_id, title, content, 'wire' AS source, published_at FROM news""")
def _(spark, sf):
    art = F.struct(
        "title", "content", F.concat(F.lit("u"), "news_id").alias("url"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.struct(F.lit("wire").alias("name")).alias("source"))
    p = _payload(fx.news(spark, sf), F.struct(F.array(art).alias("articles")))
    out = payloads.flatten_news_payload(p, "articles")
    return out.select("news_id", "title", "content", "source",
                      F.col("published_at").cast("timestamp_ntz").alias("published_at"))


@query("source_observations", "S12", "SELECT date, indicator_id, value FROM econ WHERE indicator_id <> 'DFF'", "value")
def _(spark, sf):
    e = fx.econ(spark, sf)
    text = F.when(F.col("indicator_id") == "DFF", ".").otherwise(F.col("value").cast("string"))
    obs = F.struct(F.array(F.struct(F.col("date").cast("string").alias("date"), text.alias("value"))).alias("observations"))
    return payloads.flatten_observations(e.select("indicator_id", F.to_json(obs).alias("payload")))


@query("source_bars_payload", "S12", "SELECT date, ticker, open, high, low, close, volume FROM bars", PRICES)
def _(spark, sf):
    ms = F.unix_millis(F.col("date").cast("timestamp"))
    bar = F.struct(ms.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
                   F.col("close").alias("c"), F.col("volume").alias("v"))
    return payloads.flatten_bars_payload(_payload(
        fx.bars(spark, sf), F.struct("ticker", F.array(bar).alias("results"))))


# ------------------------------------------------------------- snapshots
OLD, NEW = "date < DATE '1999-01-01'", "date >= DATE '1999-01-01'"


def _two_versions(spark, sf):
    path = folder(spark, "snapshot")
    b = fx.bars(spark, sf)
    cut = F.lit("1999-01-01").cast("date")
    snapshots.write_snapshot(b.where(F.col("date") < cut), path)
    snapshots.write_snapshot(b.where(F.col("date") >= cut), path, mode="append")
    return path


@query("snapshot_write_append", "S13", f"""
  SELECT 0::BIGINT AS version, 'overwrite' AS operation, count(*) AS "rows", 7 AS columns FROM bars WHERE {OLD}
  UNION ALL SELECT 1, 'append', count(*), 7 FROM bars WHERE {NEW}""")
def _(spark, sf):
    log = snapshots.snapshot_history(spark, _two_versions(spark, sf))
    return log.select("version", "operation", "rows", F.size("columns").alias("columns"))


@query("snapshot_read_latest", "S14", f"SELECT * FROM bars WHERE {NEW}", PRICES)
def _(spark, sf):
    return snapshots.read_snapshot(spark, _two_versions(spark, sf))


@query("snapshot_time_travel", "S14", f"SELECT * FROM bars WHERE {OLD}", PRICES)
def _(spark, sf):
    return snapshots.read_snapshot(spark, _two_versions(spark, sf), version=0)


@query("snapshot_read_all", "S14", "SELECT * FROM bars", PRICES)
def _(spark, sf):
    return snapshots.read_snapshot(spark, _two_versions(spark, sf), read="all")


@query("snapshot_info", "S15", f"""
  SELECT 2::BIGINT AS versions, 1::BIGINT AS current_version, count(*) AS "rows", 7 AS columns FROM bars WHERE {NEW}""")
def _(spark, sf):
    return snapshots.snapshot_info(spark, _two_versions(spark, sf)).drop("updated_at")


@query("snapshot_convert", "S16", "SELECT * FROM bars", PRICES)
def _(spark, sf):
    path = folder(spark, "converted")
    snapshots.to_snapshot(spark, written(spark, fx.bars(spark, sf), "plain"), path)
    return snapshots.read_snapshot(spark, path)


# ----------------------------------------------------------------- sinks
@query("sink_by_date", "S17", """
  SELECT * REPLACE (CASE WHEN date >= DATE '2001-01-01' THEN close + 1 ELSE close END AS close) FROM bars""", PRICES)
def _(spark, sf):
    path = folder(spark, "replaced")
    b = fx.bars(spark, sf)
    sinks.write_by_date(b, path)
    again = b.where(F.col("date") >= F.lit("2001-01-01").cast("date")).withColumn("close", F.col("close") + 1)
    sinks.write_by_date(again, path)
    return spark.read.parquet(path)


@query("sink_append", "S18", "SELECT * FROM bars", PRICES)
def _(spark, sf):
    path = folder(spark, "appended")
    b = fx.bars(spark, sf)
    cut = F.lit("1999-01-01").cast("date")
    sinks.append_bars(b.where(F.col("date") >= cut), path)
    sinks.append_bars(b.where(F.col("date") < cut), path)
    return spark.read.parquet(path)


@query("sink_csv_by_indicator", "S19", "SELECT date, indicator_id, value FROM econ", "value")
def _(spark, sf):
    path = folder(spark, "csv-by")
    sinks.export_csv_by(fx.econ(spark, sf), path)
    return spark.read.schema("date date, value double, indicator_id string").option("header", True).csv(path)


@query("sink_json_preview", "S19", "SELECT ticker, date, close FROM bars ORDER BY date, ticker LIMIT 50", "close")
def _(spark, sf):
    path = folder(spark, "preview")
    sinks.export_json_preview(fx.bars(spark, sf).select("ticker", "date", "close"), path, ["date", "ticker"])
    return spark.read.schema("ticker string, date date, close double").json(path)


@query("sink_publish", "S20", """
  SELECT ticker, max_by(close, date) AS last_price FROM bars GROUP BY ticker""", "last_price")
def _(spark, sf):
    from tapeloom.operators.clean import last_close

    pub = sinks.Publisher(spark, folder(spark, "published"))
    none = pub.load_published("prices", "ticker string, last_price double")
    pub.publish("prices", none)
    pub.publish("prices", last_close(fx.bars(spark, sf)))
    return pub.load_published("prices", none.schema)


@query("sink_upsert", "S21", """
  SELECT date, CASE WHEN date >= DATE '2001-01-01' THEN -1 ELSE n END AS n
  FROM (SELECT date, count(*) AS n FROM bars GROUP BY date)""")
def _(spark, sf):
    days = fx.bars(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    delta = days.where(F.col("date") >= F.lit("2001-01-01").cast("date")).select(
        "date", F.lit(-1).cast("long").alias("n"))
    return sinks.upsert_by_key(days, delta, ["date"])


@query("sink_freshness", "S22", """
  SELECT max(date) AS last_batch, CAST(DATE '2001-11-05' - max(date) AS BIGINT) AS age_days,
         DATE '2001-11-05' - max(date) <= 1 AS is_valid, 'stale' AS status FROM bars""")
def _(spark, sf):
    log = fx.bars(spark, sf).select(
        F.col("ticker").alias("name"), F.col("date").alias("batch_date"),
        F.col("date").cast("timestamp").alias("updated_at"))
    return sinks.freshness(log, "2001-11-05 00:00:00")


@query("source_merge_fragments", "S23", """
  SELECT ticker, date, CASE WHEN date < DATE '1999-01-01' THEN close END AS close, volume FROM bars""", "close")
def _(spark, sf):
    b = fx.bars(spark, sf)
    cut = F.lit("1999-01-01").cast("date")
    first = _pascal(b.where(F.col("date") < cut).select("ticker", "date", "close", "volume"))
    second = b.where(F.col("date") >= cut).select("ticker", "date", "volume")
    return readers.merge_fragments(spark, [written(spark, first, "f1"), written(spark, second, "f2")])


@query("calendar_partition_dates", "V17", "SELECT DISTINCT date FROM bars")
def _(spark, sf):
    return calendars.existing_dates(spark.read.parquet(by_date(spark, sf)))


# ------------------------------------------------------------- streaming
TICKS = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"


def tick_stream(spark, sf):
    src = fx.tune(spark).readStream.schema(TICKS).option("pathGlobFilter", "events.parquet").parquet(sf)
    return src.select(
        "event_id", F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("ts").cast("timestamp").alias("ts"), (F.col("value") + 100).alias("price"),
        F.lit(1).cast("long").alias("size"))


def _upserted(spark, stream, schema, keys, part):
    """Run a stream to its end, keeping the newest row per key in a live table."""
    pub = sinks.Publisher(spark, folder(spark, "stream"))
    step = refresh.upsert_step(pub, "out", schema, keys, part)
    live.for_each_batch(stream, step, folder(spark, "checkpoint"), mode="update").awaitTermination()
    return pub.load_published("out", schema)


view("tick_bars", """
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bar_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS bar_end,
         ticker, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close,
         CAST(sum(size) AS BIGINT) AS volume FROM ticks GROUP BY 1, 2, 3""")


def _ntz(df):
    return df.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


@query("stream_latest_price", "O01", """
  SELECT ticker, arg_max(price, ts) AS last_price, max(ts) AS last_ts FROM ticks GROUP BY ticker""", "last_price")
def _(spark, sf):
    out = _upserted(spark, live.stream_latest(tick_stream(spark, sf)),
                    "ticker string, last_price double, last_ts timestamp", ["ticker"], by_hash("ticker"))
    return _ntz(out)


@query("stream_five_minute_bars", "O02", "SELECT * FROM tick_bars", PRICES)
def _(spark, sf):
    return _ntz(_upserted(spark, live.stream_bars(tick_stream(spark, sf)), refresh.BARS, ["bar_start", "ticker"], by_day("bar_start")))


@query("stream_to_bronze", "O03", "SELECT *, CAST(ts AS DATE) AS date FROM ticks", "price")
def _(spark, sf):
    path = folder(spark, "bronze")
    live.stream_to_bronze(tick_stream(spark, sf), path, folder(spark, "checkpoint")).awaitTermination()
    return _ntz(spark.read.parquet(path))


@query("stream_layers", "O04", """
  SELECT ticker, count(*) AS bars, max(close) AS high_close FROM tick_bars GROUP BY ticker""", "high_close")
def _(spark, sf):
    pub = sinks.Publisher(spark, folder(spark, "layers"))

    def gold_step(bars, batch_id):
        pub.publish("gold", bars.groupBy("ticker").agg(
            F.count(F.lit(1)).alias("bars"), F.max("close").alias("high_close")))

    bars = live.stream_bars(tick_stream(spark, sf))
    live.for_each_batch(bars, refresh.layered(refresh.state_bars_step(pub), gold_step),
                        folder(spark, "checkpoint"), mode="update").awaitTermination()
    return pub.load_published("gold", "ticker string, bars bigint, high_close double")


@query("stream_refresh_prices", "O06", """
  SELECT ticker, arg_max(price, ts) AS last_price, count(*) AS n, TRUE AS updated FROM ticks GROUP BY ticker""", "last_price")
def _(spark, sf):
    pub = sinks.Publisher(spark, folder(spark, "refresh"))
    base = fx.ticks(spark, sf).groupBy("ticker").agg(F.min("price").alias("last_price"), F.count(F.lit(1)).alias("n"))
    pub.publish("risk_metrics", base)
    step = refresh.refresh_step(pub, base.schema)
    live.for_each_batch(tick_stream(spark, sf), step, folder(spark, "checkpoint")).awaitTermination()
    out = pub.load_published("risk_metrics", base.schema)
    return out.withColumn("updated", F.col("updated_at").isNotNull()).drop("updated_at")


@query("stream_daily_pnl", "O07", """
  SELECT p.date, h.strategy, sum(h.weight * p.daily_return / 100) AS daily_return, count(*) AS holdings
  FROM silver p JOIN holdings h USING (ticker) GROUP BY p.date, h.strategy""", "daily_return")
def _(spark, sf):
    table = silver(spark, sf)
    path = os.path.dirname(table.inputFiles()[0])
    days = spark.readStream.schema(table.schema).parquet(path).select("ticker", "date", "daily_return")
    pub = sinks.Publisher(spark, folder(spark, "pnl"))
    held = staged_once(spark, sf, "holdings", lambda: holdings(spark, sf))
    step = refresh.pnl_step(pub, held)
    live.for_each_batch(days, step, folder(spark, "checkpoint")).awaitTermination()
    return pub.load_published("performance", "date date, strategy string, daily_return double, holdings bigint")
