"""Quality, toxicity and language: edge cases and held-out accuracy."""

import numpy as np
import pytest

from tapeloom.llm import language, quality, toxicity

from .conftest import EDGES, crc, documents

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_edges(spark, edges, nothing, labels, operator):
    got = operator(edges, labels).collect()
    assert len(got) == len(EDGES)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
    assert len({(r["doc_id"], r["score"]) for r in got if r["doc_id"] == 7}) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert operator(nothing, labels).collect() == []
    assert len(operator(edges, labels.limit(0)).collect()) == len(EDGES)


@pytest.mark.parametrize("operator,label,folds,rest,least", [
    (quality.quality, "quality", 5, 0, 0.93), (toxicity.toxicity, "toxic", 3, 1, 0.93)])
def test_held_out_accuracy(spark, operator, label, folds, rest, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = operator(documents(spark, SF), labels).toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: crc(i, folds) == rest)).all()
    held = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (held["predicted"] == held[label]).mean() >= least
    assert held.loc[held[label] == 1, "score"].mean() > held.loc[held[label] == 0, "score"].mean() + 0.5


def test_lookup_tables_are_what_is_added():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y, np.ones(400), pairs=2)
    by_hand = []
    for row in x[:50]:
        total = model.base + sum(t[(c <= v).sum()] for c, t, v in zip(model.cuts, model.tables, row))
        total += sum(t[(model.coarse[a] <= row[a]).sum(), (model.coarse[b] <= row[b]).sum()] for a, b, t in model.pairs)
        by_hand.append(1 / (1 + np.exp(-total)))
    assert np.allclose(model.score(x[:50]), by_hand)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.95  # only the pair can learn this


def test_folding_and_exceptions():
    assert toxicity.folded("Yоu 1di0t $tupid m0r​0n worthless*** 2024".encode()) == [
        "you", "idiot", "stupid", "moron", "worthless", "2024"]
    lexicon = toxicity.Lexicon(((" idiot", 3.0), (" idiotic ", 5.0), (" trash ", 2.0)), (" trash can ",))
    found = toxicity.machine(lexicon)
    assert toxicity.matches(" an idiotic trash can idiots ", found) == [(3, 5.0), (21, 3.0)]
    assert toxicity.measures(b"nothing here", found) == [0.0, 0.0, 0.0]
    assert toxicity.measures(b"", toxicity.machine(toxicity.Lexicon(()))) == [0.0, 0.0, 0.0]


def test_language_edges(edges, nothing):
    got = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language.languages(edges).collect()}
    assert {(1, "und", False), (2, "und", False), (3, "und", False), (11, "und", False)} <= got
    assert all(name in ("en", "de", "fr", "und") or name == "es" for _, name, _ in got)
    assert language.languages(nothing).collect() == []


def test_language_held_out(spark):
    docs = documents(spark, SF)
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_substitutes_at_ends_and_in_runs():
    assert toxicity.folded(b"sh17 wh0r3 455hole wow!! 2024 12:30") == ["shit", "whore", "asshole", "wow", "2024", "12", "30"]
    lexicon = toxicity.Lexicon(((" ass ", 4.0), (" bitch", 3.0), (" bitches ", 5.0), (" wow ", 1.0), (" fu ", 2.0)))
    found = toxicity.machine(lexicon)
    totals = [float(np.expm1(toxicity.measures(t, found)[1])) for t in (b"a$$", b"b1tch3$", b"wow!!", b"455!", b"4ss", b"fu", b"!" * 200_000)]
    assert np.allclose(totals, [4, 5, 1, 0, 4, 2, 0])
    terms = toxicity.candidates(["fu", "x" * 30])
    assert " fu " in terms and f" {'x' * 30} " in terms
