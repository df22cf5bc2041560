"""Validation and data-quality reports.

Reports are small tables (a row per column or per rule). Counting is one
aggregate pass; example values are the smallest few per rule, found with a
ranked filter instead of collecting the offending values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.contracts import TableContract
from tapeloom.operators import timeblocks
from tapeloom.operators.clean import CRITICAL, null_counts
from tapeloom.operators.quantiles import quantiles
from tapeloom.sources.staging import stage

# Valid ranges per column.
VALID_RANGES: dict[str, tuple[float, float]] = {
    "price": (0.01, 1_000_000),
    "first_price": (0.01, 1_000_000),
    "last_price": (0.01, 1_000_000),
    "daily_return": (-1.0, 1.0),
    "avg_daily_return": (-0.5, 0.5),
    "sharpe_ratio": (-5.0, 10.0),
    "volatility": (0, 500),
    "max_drawdown": (-100, 0),
    "volume": (0, math.inf),
    "avg_volume": (0, math.inf),
}
VALID_RANGES_WITH_CHANGE = {**VALID_RANGES, "price_change_pct": (-99, 10000)}
NON_NEGATIVE = ("price", "first_price", "last_price", "volume", "avg_volume", "volatility")
NON_POSITIVE = ("max_drawdown",)
EXAMPLES = 5

# The hard check at ingestion.
REQUIRED_TYPES = {
    "date": ("timestamp", "timestamp_ntz", "date"),
    "ticker": ("string",),
    "open": ("double", "float"),
    "high": ("double", "float"),
    "low": ("double", "float"),
    "close": ("double", "float"),
    "volume": ("bigint", "int"),
}


def validate_bars(df: DataFrame) -> DataFrame:
    """Violations of the hard check: (check, column, detail, count); empty if none."""
    spark = df.sparkSession
    have = dict(df.dtypes)
    found = [("missing", c, "absent", 1) for c in REQUIRED_TYPES if c not in have]
    found += [
        ("type", c, have[c], 1)
        for c, ok in REQUIRED_TYPES.items() if c in have and have[c] not in ok
    ]
    schema = "check string, column string, detail string, count bigint"
    nulls = null_counts(df, [c for c in CRITICAL if c in have]).where("null_count > 0").select(
        F.lit("null").alias("check"), "column", F.lit("null in critical column").alias("detail"),
        F.col("null_count").alias("count"))
    return spark.createDataFrame(found, schema).unionByName(nulls)


def _pairs(cols: Mapping[str, Column], kind: str) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), c.cast(kind).alias("value")) for n, c in cols.items()
    ]))


def _long(df: DataFrame, cols: Sequence[str], kind: str = "double") -> DataFrame:
    return df.select(_pairs({c: F.col(c) for c in cols}, kind).alias("p")).select("p.*")


def _with_examples(bad: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count per key plus the smallest distinct values, from rows (keys, value)."""
    per_value = bad.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("value")
    few = (
        per_value.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= EXAMPLES)
        .groupBy(*keys).agg(F.array_sort(F.collect_list("value")).alias("examples"))
    )
    return per_value.groupBy(*keys).agg(F.sum("n").alias("count")).join(few, list(keys), "left")


def validate_contract(df: DataFrame, contract: TableContract, strict: bool = False) -> DataFrame:
    """(issue, column, count, examples). Strict adds type and key checks."""
    spark = df.sparkSession
    have = dict(df.dtypes)
    fields = contract.fields()
    rows = [("missing_column", n, 1) for n, _, _ in fields if n not in have]
    if strict:
        rows += [
            ("type", n, 1) for n, t, _ in fields if n in have and have[n] != t.simpleString()
        ]
    parts = [
        spark.createDataFrame(rows, "issue string, column string, count bigint").withColumn(
            "examples", F.lit(None).cast("array<string>"))
    ]
    required = [n for n, _, nullable in fields if not nullable and n in have]
    if required:
        parts.append(null_counts(df, required).where("null_count > 0").select(
            F.lit("null").alias("issue"), "column", F.col("null_count").alias("count"),
            F.lit(None).cast("array<string>").alias("examples")))
    limited = {c: v for c, v in contract.allowed.items() if c in have}
    if limited:
        ok = reduce(
            lambda a, b: a | b,
            [(F.col("column") == c) & F.col("value").isin(*v) for c, v in limited.items()],
        )
        bad = _long(df, list(limited), "string").where(F.col("value").isNotNull() & ~ok)
        parts.append(_with_examples(bad, ["column"]).select(
            F.lit("value_not_allowed").alias("issue"), "column", "count", "examples"))
    if strict and all(k in have for k in contract.key):
        twice = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(twice.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("count")).where(
            "count > 0").select(
            F.lit("duplicate_key").alias("issue"), F.lit(",".join(contract.key)).alias("column"),
            "count", F.lit(None).cast("array<string>").alias("examples")))
    return reduce(DataFrame.unionByName, parts)


def _issue(df: DataFrame, name: str, severity: str) -> DataFrame:
    return df.select(
        F.lit(severity).alias("severity"), F.lit(name).alias("issue"), "column",
        F.col("count").alias("invalid_count"), "examples",
    )


def _no_issue(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "severity string, issue string, column string, invalid_count bigint, examples array<double>")


def range_violations(
    df: DataFrame, rules: Mapping[str, tuple[float, float]] = VALID_RANGES
) -> DataFrame:
    cols = [c for c in rules if c in df.columns]
    if not cols:
        return _no_issue(df)
    bound = lambda i: reduce(
        lambda acc, c: acc.when(F.col("column") == c, F.lit(float(rules[c][i]))), cols[1:],
        F.when(F.col("column") == cols[0], F.lit(float(rules[cols[0]][i]))))
    long = _long(df, cols).where(~F.isnan("value"))
    bad = long.where((F.col("value") < bound(0)) | (F.col("value") > bound(1)))
    return _issue(_with_examples(bad, ["column"]), "range", "error")


def sign_violations(
    df: DataFrame, non_negative=NON_NEGATIVE, non_positive=NON_POSITIVE, strict: bool = False
) -> DataFrame:
    """Wrong-signed values; strict also rejects zero where a positive is due."""
    low = [c for c in non_negative if c in df.columns]
    high = [c for c in non_positive if c in df.columns]
    if not low and not high:
        return _no_issue(df)
    v, c = F.col("value"), F.col("column")
    below = (v <= 0) if strict else (v < 0)
    bad = _long(df, [*low, *high]).where(
        ~F.isnan("value") & ((c.isin(*low) & below) | (c.isin(*high) & (v > 0))))
    return _issue(_with_examples(bad, ["column"]), "sign", "error")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nan_inf_violations(df: DataFrame) -> DataFrame:
    """Missing values (warning) and infinities (error) per numeric column."""
    cols = numeric_columns(df)
    if not cols:
        return _no_issue(df)
    x = {c: F.col(c).cast("double") for c in cols}
    one = df.agg(
        *[F.count_if(x[c].isNull() | F.isnan(x[c])).alias(f"{c}|nan") for c in cols],
        *[F.count_if(F.abs(x[c]) == float("inf")).alias(f"{c}|inf") for c in cols],
    )
    long = one.unpivot([], one.columns, "key", "count").where("count > 0")
    kind = F.substring_index("key", "|", -1)
    return long.select(
        F.when(kind == "nan", "warning").otherwise("error").alias("severity"),
        kind.alias("issue"),
        F.substring_index("key", "|", 1).alias("column"),
        F.col("count").alias("invalid_count"),
        F.array().cast("array<double>").alias("examples"),
    )


def numeric_format_violations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Text with more than one dot, per text column."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    bad = _long(df, cols, "string").where(F.regexp_count("value", F.lit(r"\.")) > 1)
    return _issue(_with_examples(bad, ["column"]), "number_format", "error")


def validation_issues(df: DataFrame, rules: Mapping = VALID_RANGES, strict: bool = False) -> DataFrame:
    as_text = lambda d: d.withColumn("examples", F.col("examples").cast("array<string>"))
    parts = [range_violations(df, rules), sign_violations(df, strict=strict), nan_inf_violations(df)]
    if any(isinstance(f.dataType, T.StringType) for f in df.schema.fields):
        parts.append(numeric_format_violations(df))
    return reduce(DataFrame.unionByName, [as_text(p) for p in parts])


def validation_report(df: DataFrame, rules: Mapping = VALID_RANGES, strict: bool = False) -> DataFrame:
    """One row: is_valid, total_issues, error_count, warning_count, rows_checked."""
    issues = validation_issues(df, rules, strict)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return issues.agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("is_valid"),
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"),
    ).withColumn("rows_checked", rows)


def flag_valid(df: DataFrame, price="price", ret="daily_return", sharpe="sharpe_ratio",
               drawdown="max_drawdown") -> DataFrame:
    """Row flags; a null is not valid."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    rules = {
        "valid_price": (price, lambda c: c.between(0.01, 1_000_000)),
        "valid_return": (ret, lambda c: F.abs(c) <= 1),
        "valid_sharpe": (sharpe, lambda c: c.between(-5, 10)),
        "valid_drawdown": (drawdown, lambda c: c.between(-100, 0)),
    }
    return df.withColumns({
        n: yes(rule(F.col(c))) for n, (c, rule) in rules.items() if c in df.columns
    })


def clean_metrics(df: DataFrame, mode: str = "null") -> DataFrame:
    """Repair a metric table: infinities, tiny prices, positive drawdowns, wild returns.

    ``null`` nulls prices below 0.001 and returns beyond 10; ``clip`` nulls
    prices at or below 0 and clips returns to [-1, 1].
    """
    out: dict[str, Column] = {}
    for c, kind in df.dtypes:
        if kind not in ("double", "float"):
            continue
        v = F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c))
        if c in ("price", "first_price", "last_price"):
            v = F.when(v >= 0.001, v) if mode == "null" else F.when(v > 0, v)
        elif c == "max_drawdown":
            v = F.when(v > 0, -v).otherwise(v)
        elif c == "avg_daily_return" and mode == "null":
            v = F.when(F.abs(v) <= 10, v)
        elif c in ("daily_return", "avg_daily_return") and mode == "clip":
            v = F.when(v.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v)))
        out[c] = v
    return df.withColumns(out)


def adjust_splits(bars: DataFrame, splits: DataFrame, price: str = "price") -> DataFrame:
    """Divide each price by the ratios of all later splits of its ticker.

    Bars and splits are one series, walked from its end by years; a slice holds
    a bar and a split a day, whatever the number of splits. Rows without a date
    or a ticker, and splits without a ratio, change nothing.
    """
    daily = splits.dropna(subset=["ticker", "split_date", "ratio"]).groupBy(
        "ticker", F.col("split_date").alias("date")).agg(F.product("ratio").alias("__ratio"))
    both = bars.withColumn("__split", F.lit(0)).unionByName(daily.withColumn("__split", F.lit(1)), allowMissingColumns=True)
    # from the last day back; a split counts for the days before it, so the bar of its day comes first
    both = both.withColumn("__back", -F.datediff("date", F.lit("1970-01-01")))
    ratios = F.product("__ratio")
    out = timeblocks.with_carry(
        both, ["ticker"], ["__back", "__split"], slice_by=-F.year("date"),
        local=lambda w: {"__here": ratios.over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))},
        summary={"__all": ratios},
        carry=lambda earlier: {"__after": F.product("__all").over(earlier)},
        combine={"__factor": F.coalesce(F.col("__here"), F.lit(1.0)) * F.coalesce(F.col("__after"), F.lit(1.0))})
    return out.where("__split = 0").withColumn(price, F.col(price) / F.col("__factor")).select(*bars.columns)


def _plain(df: DataFrame) -> list[Column]:
    """The columns as values that hash: zeros without a sign, maps as text."""
    def one(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c + F.lit(0.0).cast(f.dataType)
        return F.to_json(c) if isinstance(f.dataType, T.MapType) else c

    return [one(f) for f in df.schema.fields]


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row; a null counts at its place."""
    marked = [x for c in _plain(df) for x in (c, c.isNull())]
    return [F.xxhash64(*marked), F.xxhash64(F.lit(1), *reversed(marked))]


def _whole_row(df: DataFrame) -> Column:
    """sha-256 over all values of a row, each with its length before it."""
    def text(c, f):
        if isinstance(f.dataType, T.BinaryType):
            return F.hex(c)
        return F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType)) else c.cast("string")

    parts = [text(c, f) for c, f in zip(_plain(df), df.schema.fields)]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def row_counts(df: DataFrame, hashes: Sequence[Column] | None = None) -> DataFrame:
    """One row: ``rows`` and ``distinct_rows``, by whole rows of any width.

    Hashes are grouped first, and those that came more than once are staged with
    the number of all others. Only rows with a staged hash are compared, by a digest
    of all their values: the values themselves are never shuffled, copies of one row
    are counted where they lie, and without a repeated hash no row is read again.
    """
    h1, h2 = hashes or row_hashes(df)
    both = ["__h1", "__h2"]
    rows = df.select(h1.alias("__h1"), h2.alias("__h2"), F.unhex(_whole_row(df)).alias("__row"))
    more = F.col("__n") > 1
    seen = stage(
        rows.groupBy(*both).agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(more.alias("__more"), *[F.when(more, F.col(c)).alias(c) for c in both]).agg(F.sum("__n").alias("__n")), "row-hashes")
    again = rows.join(seen.where("__more").select(*both), both, "left_semi").groupBy(*both, "__row").agg(F.lit(1).alias("__one"))
    twice = again.agg(F.count(F.lit(1)).alias("n")).scalar()
    once = F.coalesce(F.sum(F.when(~F.col("__more"), F.col("__n"))), F.lit(0))
    return seen.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), once.alias("once")).select(
        "rows", (F.col("once") + twice).alias("distinct_rows"))


def profile(df: DataFrame, layer: str, step: str, date: str = "date", ticker: str = "ticker") -> DataFrame:
    """One row on a table: its size, nulls in all and by column, days, tickers and surplus whole rows."""
    cols = df.columns
    nulls = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in cols}
    aggs = [F.count(F.lit(1)).alias("row_count"), F.struct(*[n.alias(c) for c, n in nulls.items()]).alias("__nulls")]
    if date in cols:
        aggs += [F.min(date).cast("string").alias("date_min"), F.max(date).cast("string").alias("date_max")]
    if ticker in cols:
        aggs.append(F.count_distinct(ticker).alias("ticker_count"))
    counted = row_counts(df)
    of = lambda c: F.col("__nulls")[c]
    out = df.agg(*aggs).withColumns({
        "total_nulls": reduce(lambda a, b: a + b, [of(c) for c in cols]),
        "null_counts": F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[of(c) for c in cols])),
        "duplicate_rows": F.col("row_count") - counted.select("distinct_rows").scalar(),
    })
    rate = F.try_divide(F.col("total_nulls").cast("double"), F.col("row_count") * len(cols))
    return out.withColumns({
        "layer": F.lit(layer), "step": F.lit(step),
        "column_count": F.lit(len(cols)).cast("long"),
        "columns": F.array(*[F.lit(c) for c in cols]),
        "null_rate": F.coalesce(rate, F.lit(0.0)),
    }).drop("__nulls")


def compare_profiles(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two profile rows side by side: rows dropped, rate, alert, columns added and removed."""
    pick = lambda d, n: d.select(
        F.lit(1).alias("one"), F.col("layer").alias(f"layer{n}"),
        F.col("row_count").alias(f"rows_layer{n}"), F.col("columns").alias(f"c{n}"))
    rate = F.coalesce(
        F.try_divide(F.col("rows_dropped").cast("double"), F.col("rows_layer1")), F.lit(0.0))
    return (
        pick(first, 1).join(pick(second, 2), "one")
        .withColumn("rows_dropped", F.col("rows_layer1") - F.col("rows_layer2"))
        .withColumn("drop_rate", rate)
        .withColumn("alert", F.when(F.col("drop_rate") > 0.05, "high")
                    .when(F.col("drop_rate") > 0.01, "moderate").otherwise("low"))
        .withColumn("columns_added", F.array_except("c2", "c1"))
        .withColumn("columns_removed", F.array_except("c1", "c2"))
        .drop("one", "c1", "c2")
    )


def log_profile(row: DataFrame, path: str, at: Column | None = None) -> None:
    """Append a profile row to the quality log."""
    stamped = row.withColumn("timestamp", at if at is not None else F.current_timestamp())
    stamped.write.mode("append").parquet(path)


def load_quality_log(spark, path: str, last: int | None = None) -> DataFrame:
    log = spark.read.option("mergeSchema", "true").parquet(path)
    ordered = log.orderBy(F.desc("timestamp"), "layer", "step")
    return ordered.limit(last) if last else ordered


def quality_summary(log: DataFrame) -> DataFrame:
    return log.select(
        "timestamp", "layer", "step", "row_count", "column_count", "ticker_count",
        F.round(F.col("null_rate") * 100, 2).alias("null_rate_pct"), "duplicate_rows",
    ).orderBy("timestamp", "layer", "step")


def quick_check(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    """One row: rows, columns, nulls, duplicates and rows per ticker (min, median, max)."""
    base = profile(df, "", "").select(
        "row_count", "column_count", "total_nulls", "duplicate_rows", "date_min", "date_max",
        F.lit(1).alias("one"))
    per = df.groupBy(ticker).agg(F.count(F.lit(1)).alias("n"))
    spread = per.agg(
        F.count(F.lit(1)).alias("tickers"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
        F.lit(1).alias("one"))
    middle = quantiles(per.withColumn("one", F.lit(1)), ["one"], {"median_rows": ("n", 0.5)})
    return base.join(spread, "one").join(middle, "one", "left").drop("one")


def duplicate_counts(df: DataFrame, keys: Sequence[str] = ("date", "ticker")) -> DataFrame:
    """One row: surplus whole rows, and surplus rows per key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    surplus = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).scalar()
    return row_counts(df).select(
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"), surplus.alias("duplicate_keys"))


# The joined columns whose coverage is reported.
COVERAGE_COLUMNS = (
    "spy_return", "vix", "market_regime", "daily_sentiment", "company_name", "market_cap_category",
)


def join_coverage(df: DataFrame, cols: Sequence[str] = COVERAGE_COLUMNS) -> DataFrame:
    """(column, non_null, coverage_pct) for the columns that exist."""
    cols = [c for c in cols if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count(c).alias(c) for c in cols])
    return one.unpivot(["__all"], cols, "column", "non_null").select(
        "column", "non_null",
        F.coalesce(F.try_divide(F.col("non_null") * 100.0, F.col("__all")), F.lit(0.0)).alias("coverage_pct"))


def unknown_sector_share(df: DataFrame, limit: float = 0.2) -> DataFrame:
    unknown = F.count_if(F.col("sector") == "Unknown")
    share = F.coalesce(F.try_divide(unknown.cast("double"), F.count(F.lit(1))), F.lit(0.0))
    return df.agg(unknown.alias("unknown"), F.count(F.lit(1)).alias("total"),
                  share.alias("share"), (share > limit).alias("alert"))


def window_summary(df: DataFrame, start, end) -> DataFrame:
    """One row: rows, first and last day, tickers inside a date window."""
    inside = df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return inside.agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.count_distinct("ticker").alias("tickers"))
