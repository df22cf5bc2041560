"""Source divergence against exact sums over every term, source and language."""

import re
from collections import Counter, defaultdict

import pytest

from tapeloom.llm import divergence
from tapeloom.llm.common import read
from tapeloom.llm.queries import SQL, op12_divergence

from .conftest import SF

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def want(rows, least, top=10):
    terms = [(lang or "", source or "", TERM.findall((text or "").translate(LOW))) for _, text, lang, source, _ in rows]
    docs, groups, langs = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, _, found in terms:
        docs.update((lang, t) for t in set(found))
    kept = {lang: {t for (x, t), n in docs.items() if x == lang and n >= least} for lang, _, _ in terms}
    for lang, source, found in terms:
        mine = Counter(t for t in found if t in kept[lang])
        groups[lang, source] += mine
        langs[lang] += mine
    out = []

    def share(counts, t, v):
        return 1 + 10**9 * (counts[t] + 2) // (sum(counts.values()) + 2 * v)

    def gap(p, q):
        return (p - q) ** 2 // (p + q)

    for (lang, source), mine in groups.items():
        v = len(kept[lang])
        pairs = [(-sum(gap(share(mine, t, v), share(theirs, t, v)) for t in kept[lang]), other.encode(), other)
                 for (x, other), theirs in groups.items() if x == lang and other != source]
        high = [(t, share(mine, t, v), share(langs[lang], t, v)) for t in mine if mine[t]]
        best = [(-gap(p, q), t.encode(), t) for t, p, q in high if p > q]
        out += [(lang, source, "pair", t, -value, i + 1) for i, (value, _, t) in enumerate(sorted(pairs))]
        out += [(lang, source, "term", t, -value, i + 1) for i, (value, _, t) in enumerate(sorted(best)[:top])]
    return sorted(out)


def got(df, **more):
    return sorted(map(tuple, divergence.divergence(df, **more).collect()))


@pytest.mark.parametrize("at_once", [2_000_000, 300])
def test_edges(spark, edges, at_once):
    rows = [tuple(r) for r in edges.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    for least in (1, 2, 50):  # with 50 no language keeps a term
        assert got(edges, min_docs=least, at_once=at_once) == want(rows, least)


def test_ties_and_empty(spark, nothing):
    rows = [(i, t, "en", s, 0) for i, (t, s) in enumerate([
        ("b a é", "x"), ("b a é", "y"), ("a b É ß z", "z"), ("", "w"), (None, None), ("A-B'c_d", "x")])]
    df = spark.createDataFrame(rows, nothing.schema)
    assert got(df, min_docs=1) == want(rows, 1)
    assert got(nothing) == []


def test_query(spark, con):
    ours = sorted(map(tuple, op12_divergence(spark, SF).collect()))
    rows = [tuple(r) for r in read(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert ours == want(rows, 10)
    assert ours == sorted(con.sql(SQL["op12_divergence"]).fetchall())


def test_learns_from_no_more_rows_than_needed(spark, nothing, monkeypatch):
    texts = ["The cat, the dog"] * 40 + ["a rare ÉÉ bird", "ÉÉ"]
    rows = [(i, t, lang, "x", 0) for lang in ("en", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, nothing.schema).coalesce(1)
    fit, seen = divergence.CountVectorizer.fit, []

    def watched(self, given):
        seen.extend(t for r in given.collect() for t in r["terms"] if t)
        return fit(self, given)

    monkeypatch.setattr(divergence.CountVectorizer, "fit", watched)
    for least in (1, 2, 10, 41):
        seen.clear()
        assert got(df, min_docs=least) == want(rows, least)
        held = {"the": 40, "cat": 40, "dog": 40, "a": 1, "rare": 1, "ÉÉ": 2, "bird": 1}
        assert Counter(seen) == {f"{lang}\0{t}": min(n, least) for lang in ("en", "") for t, n in held.items()}
        # stretches end where a task holds enough
        monkeypatch.setattr(divergence, "HELD", 2)
        monkeypatch.setattr(divergence, "IN_ROW", 2)
        monkeypatch.setattr(divergence, "TEXTS", 500)
        monkeypatch.setattr(divergence, "IN_TEXT", 40)
        assert got(df, min_docs=least) == want(rows, least)
        monkeypatch.undo()
        monkeypatch.setattr(divergence.CountVectorizer, "fit", watched)
