"""Lattice recursion against all segmentations; scores against a plain count."""

import math
from collections import Counter
from itertools import product

import numpy as np
from hypothesis import given, settings as limits
from hypothesis import strategies as st

from tapeloom.llm import lm_score
from tapeloom.llm.lattice import Lattice, default_path, first_weights, vocabulary

from .conftest import EDGES, crc, documents

PIECES = [("<unk>", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)],
          *[(p, -float(k)) for k, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "bab", "é", "▁ab", "aba"])], ("▁▁", -1e9)]


def segmentations(word):
    if not word:
        return [[]]
    known = {p for p, _ in PIECES if not p.startswith("<")} - {"▁▁"}
    out = []
    for k in range(1, len(word) + 1):
        if word[:k] in known or k == 1:
            out += [[word[:k], *rest] for rest in segmentations(word[k:])]
    return out


@given(st.lists(st.text("abéx", max_size=6), min_size=1, max_size=5))
@limits(max_examples=40, deadline=None)
def test_forward_and_expected_counts(words):
    words = ["▁" + w for w in words]
    cut, p = Lattice(PIECES), first_weights(PIECES)
    ids = {piece: i for i, (piece, _) in enumerate(PIECES)}

    def weight(piece):
        return p[ids[piece]] if piece in ids else math.prod(p[ids[f"<0x{b:02X}>"]] for b in piece.encode())

    with np.errstate(divide="ignore"):
        logp = np.log(p)[:, None]
    got, uses = cut.forward(words, logp)[:, 0], cut.expected(words, np.arange(1, len(words) + 1.0), logp)
    want_uses = np.zeros(len(PIECES))
    for k, word in enumerate(words):
        ways = [(math.prod(map(weight, s)), s) for s in segmentations(word)]
        total = sum(w for w, _ in ways)
        assert math.isclose(got[k], math.log(total), rel_tol=1e-9)
        for w, s in ways:
            for piece in s:
                for i in [ids[piece]] if piece in ids else [ids[f"<0x{b:02X}>"] for b in piece.encode()]:
                    want_uses[i] += (k + 1) * w / total
    assert np.allclose(uses, want_uses)


def base_scores(rows):
    tokens = lambda t: (t or "").encode().lower().split()
    train = [r for r in rows if r[0] is not None and crc(r[0], 5) != 1]
    c = Counter(w for r in train for w in tokens(r[1]))
    ends = len(train)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    term = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return sorted(((r[0] if r[0] is not None else -10**9, len(tokens(r[1])) + 1,
                    sum(c[w] > 0 for w in tokens(r[1])) + (ends > 0), n,
                    round(sum(term(c[w]) for w in tokens(r[1])) + term(ends), 6)) for r in rows))


def found(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -10**9, r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in df.collect())


def test_base_score_and_frequent_words_make_no_difference(spark, edges, nothing):
    assert found(lm_score.held_out_scores(edges)) == base_scores(EDGES)
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    many, few = lm_score.held_out_scores(docs), lm_score.held_out_scores(docs, frequent=50)
    assert found(many) == found(few) == base_scores(rows)
    a, b = many.toPandas().sort_values("doc_id"), few.toPandas().sort_values("doc_id")
    assert np.allclose(a["score"], b["score"]) and (a["score"] < 0).all()
    assert lm_score.held_out_scores(nothing).collect() == []


def test_untrained(edges):
    got = lm_score.held_out_scores(edges.where("doc_id is null")).collect()
    assert [(r["n_known"], r["train_tokens"], r["held_out"]) for r in got] == [(0, 0, True)]
    assert got[0]["base_score"] == 0.0 and got[0]["score"] < 0


def test_words_have_no_more_than_one_in_all():
    p = first_weights(PIECES)
    with np.errstate(divide="ignore"):
        logp = np.log(p)[:, None]
    words = ["▁" + "".join(w) for k in range(6) for w in product("abé", repeat=k)]
    assert np.exp(Lattice(PIECES).forward(words, logp)).sum() <= 1


def test_score_against_all_segmentations(spark):
    """The query's whole model again, by plain loops over every way to cut a word."""
    texts = ["The cat sat", "the cat the mat", "a zebra é", "THE  mat\tsat", "", None, "cat quux cat \u4e00\U0001f600", "sat on a mat"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["score"]) for r in lm_score.held_out_scores(docs, frequent=2).collect())

    pieces = vocabulary(default_path())
    first = first_weights(pieces)
    bytes_at = {p: i for i, (p, _) in enumerate(pieces) if p.startswith("<0x")}
    ids = {p: i for i, (p, _) in enumerate(pieces) if first[i] > 0 and i not in bytes_at.values()}

    def cuts(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            head = [ids[word[:k]]] if word[:k] in ids else None
            if head is None and k == 1:
                head = [bytes_at[f"<0x{b:02X}>"] for b in word[0].encode()]
            if head is not None:
                for rest in cuts(word[k:]):
                    yield head + rest

    def fold_case(t):
        return "".join(c.lower() if c.isascii() else c for c in t or "").split()

    learned = [fold_case(t) for i, t in rows if crc(i, 5) != 1]
    n = Counter(w for t in learned for w in t)
    every = {w: list(cuts("▁" + w)) for _, t in rows for w in fold_case(t)}
    share = first
    for _ in range(2):
        uses = np.zeros(len(pieces))
        for w, k in n.items():
            weights = [math.prod(share[i] for i in way) for way in every[w]]
            for way, x in zip(every[w], weights):
                np.add.at(uses, way, k * x / sum(weights))
        share = (uses + 100 * first) / (uses + 100 * first).sum()
    spelled = {w: sum(math.prod(share[i] for i in way) for way in ways) for w, ways in every.items()}
    size, ends = sum(n.values()), len(learned)
    fit = lambda g: sum(k * math.log(max((k - 1) / size * g + spelled[w] * (1 - g), 1e-300)) for w, k in n.items())
    span = max((k / 20 for k in range(1, 20)), key=fit)
    stop = (ends + 0.5) / (size + ends + 1)
    want = sorted((i, math.log10(stop) + sum(
        math.log10((1 - stop) * (span * n[w] / size + (1 - span) * spelled[w])) for w in fold_case(t))) for i, t in rows)
    assert 0 < len(learned) < len(rows) and [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-9)
