"""What the physical plans must and must not contain."""

import re

import pytest

import tapeloom.plans.catalog  # noqa: F401
from tapeloom.plans.registry import REGISTRY, spark_query

from conftest import SF

HEADLINES = ["clean_bars_full", "clean_deduplicate", "join_unified", "risk_metrics", "sector_metrics",
             "features_full", "news_aggregate", "portfolio_all_strategies", "backtest_portfolio_value"]


def plan(spark, name):
    return spark_query(name)(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEADLINES)
def test_no_python_and_no_pairs(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_ticker_windows_are_sliced_or_limited(spark):
    """A window over a whole ticker runs only on slice summaries or behind a rank limit."""
    text = plan(spark, "features_full")
    for spec in re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text):
        keys = re.sub(r"#\d+L?", "", spec)
        # __key: a series and its slice or block; __g_: a stretch of a series on the table of blocks
        assert re.fullmatch(r"__key|ticker|ticker, __g_\w+|date|indicator_id|", keys), keys
    assert "__block" in text


def test_dedup_limits_before_the_shuffle(spark):
    text = plan(spark, "clean_deduplicate")
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_feature_shuffles_once_per_stage(spark):
    """Row numbers, slice sizes and blocks; the rest is day tables and news."""
    text = plan(spark, "features_bollinger")
    assert text.count("Exchange hashpartitioning") <= 4


def test_every_query_but_models_has_a_twin():
    bare = {n for n, q in REGISTRY.items() if q.sql is None}
    assert bare == {"model_feature_importance", "model_top_features"}


def scans(df):
    """File scans and shuffles of whole rows in the plan as it ran; reused exchanges are not run again."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return text.count("FileScan parquet")


def test_a_backtest_scans_its_segments(spark):
    """Values, costs and chain come from the staged segments: neither bars nor targets are read again."""
    text = plan(spark, "backtest_portfolio_value").split("Initial Plan")[0]
    assert "lineitem" not in text and text.count("FileScan parquet") <= 10


def test_source_is_scanned_once(spark, tmp_path):
    from tapeloom.operators import clean, risk
    from tapeloom.plans import fixtures as fx
    from tapeloom.plans.queries_gold import priced

    raw = fx.bars_dirty(spark, SF)
    raw.write.parquet(str(tmp_path / "raw"))
    out = clean.clean_bars(spark.read.parquet(str(tmp_path / "raw")))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "raw" not in {f.rsplit("/", 2)[-2].split("-")[0] for f in out.inputFiles()} and "ingested_at" in text
    assert scans(risk.risk_metrics(priced(spark, SF))) <= 3


def test_block_keys_need_no_second_shuffle(spark):
    """The averages that enter the blocks are joined where the rows lie: the keys have one type, and rows are
    shuffled by slice and by block only, the news joined by the key of the slices."""
    text = plan(spark, "features_full").split("Initial Plan")[0]
    assert "cast(__key" not in text
    spine = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert not any(re.search(r"hashpartitioning\((date|ticker)#\d+, (ticker|date)#\d+", line) for line in spine)


def test_a_staged_table_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    from tapeloom.session import tune
    from tapeloom.sources.staging import stage

    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {x for x in (blocks.apply(i).toString() for i in range(blocks.size())) if x.startswith("shuffle_")}

    had = files()
    out = stage(tune(spark).range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    assert out.count() == 7
    out.count()
    assert not files() - had


def test_sectors_come_to_the_slices(spark):
    """The cleaned rows are shuffled by key and by slice, not once more by ticker for their sector."""
    from tapeloom.operators import clean
    from tapeloom.plans import fixtures as fx

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = clean.clean_bars(fx.bars_dirty(spark, SF), fx.metadata(spark, SF))
        tree = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    closes = [i for i, line in enumerate(tree.splitlines()) if "FileScan" in line and "high#" in line.split("]")[0]]
    assert len(closes) == 1 and "__key" in tree
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines, above, at = tree.splitlines(), [], 10**9
    for line in reversed(lines[:closes[0]]):  # from the scan of the rows to the top
        if depth(line) < at:
            at = depth(line)
            above += [line] if "Exchange" in line else []
    assert len(above) == 1 and "hashpartitioning(__key" in above[0]


def test_no_hashes_of_rows_meet_when_none_repeats(spark):
    """Whole rows are compared only where their hashes repeat: without any, the rows are not read for it."""
    from pyspark.sql import functions as F

    from tapeloom.operators import quality

    df = spark.range(20_000).select("id", (F.col("id") * 3).alias("x"))
    counted = quality.row_counts(df)
    assert tuple(counted.first()) == (20_000, 20_000)
    assert counted.inputFiles() and all("row-hashes" in f for f in counted.inputFiles())
    assert tuple(quality.row_counts(df.unionByName(df.limit(5))).first()) == (20_005, 20_000)
