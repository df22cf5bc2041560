import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.operators.quantiles import medians, quantiles


def test_grouped_quantiles_equal_numpy(spark):
    rnd = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "g": rnd.choice(["hot", "hot", "hot", "a", "b"], 6000),
        "x": np.where(rnd.random(6000) < 0.3, 0.0, rnd.normal(0, 3, 6000) * 10.0 ** rnd.integers(-6, 7, 6000)),
        "y": rnd.integers(-5, 5, 6000).astype(float)})
    got = quantiles(spark.createDataFrame(pdf), ["g"], {
        "x05": ("x", 0.05), "x50": ("x", 0.5), "x0": ("x", 0.0), "x1": ("x", 1.0), "y25": ("y", 0.25)})
    for r in got.collect():
        sub = pdf[pdf.g == r.g]
        for name, col, p in (("x05", "x", .05), ("x50", "x", .5), ("x0", "x", 0), ("x1", "x", 1), ("y25", "y", .25)):
            np.testing.assert_allclose(r[name], sub[col].quantile(p), rtol=1e-12, atol=1e-15)


def test_nulls_are_skipped_and_empty_groups_absent(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), ("b", None)], "g string, x double")
    assert [tuple(r) for r in medians(df, ["g"], ["x"]).collect()] == [("a", 2.5)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=40), st.floats(0, 1))
def test_any_values(spark, xs, p):
    df = spark.createDataFrame([(1, float(x)) for x in xs], "g int, x double")
    got = quantiles(df, ["g"], {"q": ("x", p)}).first()["q"]
    want = pd.Series(xs).quantile(p)
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_hot_value_ranges_are_cut_until_they_are_small(spark, monkeypatch):
    """Many different values inside one bin, some of them in ranges a millionth as wide, and one value that is most rows."""
    from tapeloom.operators import quantiles as q

    rnd = np.random.default_rng(3)
    x = np.concatenate([1.0 + rnd.random(40_000) * 1e-3, 1.0005 + rnd.random(40_000) * 1e-9, np.full(15_000, 1.0005), -rnd.random(50)])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(x)) % 3 == 0, "a", "hot"), "x": x})
    written = []
    real = q.stage
    monkeypatch.setattr(q, "stage", lambda df, name: written.append(real(df, name)) or written[-1])
    wanted = {f"q{p}": ("x", p / 1000) for p in (0, 1, 250, 500, 733, 999, 1000)}
    got = quantiles(spark.createDataFrame(pdf), ["g"], wanted, ordered=200).collect()
    assert len(got) == 2
    for r in got:
        mine = pdf[pdf.g == r.g].x
        for name, (_, p) in wanted.items():
            np.testing.assert_allclose(r[name], mine.quantile(p), rtol=1e-15)
    largest = [w.groupBy("g", "__bin").count().selectExpr("max(count)").first()[0] for w in written]
    assert len(largest) > 2 and largest[0] > 20_000 and largest[-1] <= 200


def test_describing_shuffles_only_values_of_bins_with_a_quartile(spark, monkeypatch):
    """The moments come from the counts of the bins; rows are not written, and most values are only counted."""
    from tapeloom.operators import features, quantiles as q

    rng = np.random.default_rng(5)
    wide = pd.DataFrame({"a": rng.normal(0, 3, 20_000), "b": np.exp(rng.normal(0, 2, 20_000)), "c": np.nan, "d": 7.0})
    wide.loc[::11, "b"] = np.nan
    staged, stage = {}, q.stage
    monkeypatch.setattr(q, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    df = spark.createDataFrame(wide).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in wide.columns])
    got = {r["feature"]: r for r in features.describe_features(df, ["a", "b", "c", "d"]).collect()}
    for c in "ab":
        v = wide[c].dropna()
        want = [len(v), v.mean(), v.std(), v.min(), v.max(), *v.quantile([0.25, 0.5, 0.75])]
        assert [got[c][k] for k in ("count", "mean", "std", "min", "max", "q25", "q50", "q75")] == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert list(got["c"])[1:] == [0, *[None] * 7]
    assert [got["d"][k] for k in ("count", "mean", "std", "q25", "q75")] == [20_000, 7.0, 0.0, 7.0, 7.0]
    assert 0 < staged["quantile-values"].count() < 4_000
