"""Language-model scores: subword lattice likelihood.

A fixed public vocabulary gives the pieces and their first weights; expected
piece counts over the words of the training documents re-weight them. A word of
the training documents has one more arc that spans it, weighted by its count. A
text's score sums over all its segmentations, word by word, as no piece crosses
a word start. The base score is the usual word
unigram with half a count added.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import bytes_of, fold, stage
from tapeloom.llm.lattice import Lattice, default_path, first_weights, vocabulary, word_of


def word_counts(docs: DataFrame, training: Column, at_once: int = 300_000) -> DataFrame:
    """(word, n) of every word of ``docs``; ``n`` counts it in the training rows and may be 0.

    Tasks add up their own words first, ``at_once`` distinct ones at a time.
    """

    def rows(batches):
        found: Counter = Counter()

        def out():
            return pd.DataFrame({"word": list(found.keys()), "n": list(found.values())})

        for b in batches:
            for text, learn in zip(b["text"], b["learn"]):
                words = text.lower().split()
                if learn:
                    found.update(words)
                else:
                    for w in words:
                        found.setdefault(w, 0)
                if len(found) >= at_once:
                    yield out()
                    found.clear()
        yield out()

    learn = F.coalesce(training, F.lit(False)).alias("learn")
    return docs.select(learn, bytes_of(F.col("text")).alias("text")).mapInPandas(rows, "word binary, n long").groupBy(
        "word").agg(F.sum("n").alias("n"))


def reweigh(words: DataFrame, pieces: list[tuple[str, float]], *, rounds: int = 2, prior: float = 100.0) -> np.ndarray:
    """Natural log probability of every piece.

    Each round takes the expected counts of the pieces over all of ``words``
    (word, n) and adds ``prior`` times their first weights.
    """
    first = first_weights(pieces)
    share = first.copy()
    for _ in range(rounds):
        with np.errstate(divide="ignore"):
            logp = np.log(share)[:, None]

        def rows(batches, logp=logp):
            cut, total = Lattice(pieces), np.zeros(len(pieces))
            for b in batches:
                total += cut.expected([word_of(w) for w in b["word"]], b["n"].to_numpy(float), logp)
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": used, "uses": total[used]})

        got = words.mapInPandas(rows, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        count = np.zeros(len(pieces))  # as many rows as the vocabulary has pieces, at most
        for r in got:
            count[r["piece"]] = r["uses"]
        share = count + prior * first
        share /= share.sum()
    with np.errstate(divide="ignore"):
        return np.log(share)


def spelled_words(counts: DataFrame, pieces: list[tuple[str, float]], logp: np.ndarray) -> DataFrame:
    """(word, n, spelled): the log10 probability of each word over all its segmentations."""

    def rows(batches):
        cut = Lattice(pieces)
        for b in batches:
            found = cut.forward([word_of(w) for w in b["word"]], logp[:, None])[:, 0]
            yield pd.DataFrame({"word": b["word"], "n": b["n"], "spelled": found / np.log(10)})

    return counts.mapInPandas(rows, "word binary, n long, spelled double")


def span_share(table: DataFrame, total: int) -> float:
    """Share of the arcs that span a word, the likeliest one of a grid when each occurrence is scored by the others."""
    grid = [k / 20 for k in range(1, 20)]
    if not total:
        return 0.0
    others, spelled = (F.col("n") - 1) / total, F.pow(F.lit(10.0), F.col("spelled"))
    fit = table.where("n > 0").agg(*[
        F.sum(F.col("n") * F.log(F.greatest(others * g + spelled * (1 - g), F.lit(1e-300)))).alias(f"g{k}")
        for k, g in enumerate(grid)]).first()
    return grid[max(range(len(grid)), key=lambda k: (fit[k], -k))]


def lm_scores(docs: DataFrame, training: Column, *, vocabulary_path: str | None = None, frequent: int = 50_000,
              rounds: int = 2) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (both log10) of every row of ``docs``.

    A text ends before each word with one probability and goes on with a word
    otherwise; a word is taken whole, by its share of the training words, or
    spelled in pieces, by one share for all. Words and pieces have probabilities
    that add up to 1, so those of all texts add up to no more.

    ``training`` is a condition on ``doc_id``, an integer or a string. Every
    distinct word goes through the lattice once. The ``frequent`` commonest
    words travel to every task, all others are joined; the results do not
    depend on that number. Null and empty texts have one token, their end. With
    no training rows the pieces keep their first weights. Repeated rows get a
    row each; other columns, whatever their names, are ignored.
    """
    pieces = vocabulary(vocabulary_path or default_path())
    counts = stage(word_counts(docs, training), "lm-words")
    ends = docs.where(training).count()
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = size["n"] + ends, size["v"] + (ends > 0)
    spread = total + 0.5 * (distinct + 1)
    stop = (ends + 0.5) / (total + 1.0)
    logp = reweigh(counts.where("n > 0"), pieces, rounds=rounds)
    table = stage(spelled_words(counts, pieces, logp), "lm-spelled")
    span = span_share(table, size["n"])
    base = F.log10((F.col("n") + 0.5) / F.lit(spread))
    word = F.log10(F.lit(1 - stop)) + F.when(F.col("n") > 0, F.log10(
        F.lit(span) * F.col("n") / F.lit(max(size["n"], 1)) + F.lit(1 - span) * F.pow(F.lit(10.0), "spelled"))
    ).otherwise(F.log10(F.lit(1 - span)) + F.col("spelled"))
    table = table.select("word", "n", base.alias("base"), word.alias("score"))
    often = table.where("n > 0").orderBy(F.desc("n"), "word").limit(frequent).toPandas()
    place = {bytes(w): i for i, w in enumerate(often["word"])}
    bases, scores = often["base"].to_numpy(float), often["score"].to_numpy(float)
    end_base, end_score = float(np.log10((ends + 0.5) / spread)), float(np.log10(stop))

    def rows(batches):
        for b in batches:
            out = {k: [] for k in ("row", "doc_id", "word", "times", "n_tokens", "n_known", "base", "score")}
            for row, doc_id, text in zip(b["row"], b["doc_id"], b["text"]):
                times = Counter(text.lower().split())
                here = [(place[w], k) for w, k in times.items() if w in place]
                rest = {w: k for w, k in times.items() if w not in place}
                at, k = np.array(here, np.int64).reshape(-1, 2).T
                known, none = int(k.sum()), [0] * len(rest)
                out["row"] += [row] * (len(rest) + 1)
                out["doc_id"] += [doc_id, *[None] * len(rest)]
                out["word"] += [None, *rest]
                out["times"] += [0, *rest.values()]
                out["n_tokens"] += [known + sum(rest.values()) + 1, *none]
                out["n_known"] += [known + (ends > 0), *none]
                out["base"] += [float(bases[at] @ k) + end_base, *none]
                out["score"] += [float(scores[at] @ k) + end_score, *none]
            yield pd.DataFrame(out)

    # numbers and keys of the rows are written once, with what they belong to
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"),
                        bytes_of(F.col("text")).alias("text"))
    parts = stage(keyed.mapInPandas(
        rows, "row long, doc_id string, word binary, times long, n_tokens long, n_known long, base double, score double"), "lm-parts")
    times = F.col("times")
    rest = parts.where(F.col("word").isNotNull()).select("row", "word", "times").join(table, "word").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * F.col("base")).alias("more_base"), F.sum(times * F.col("score")).alias("more_score"))
    whole = parts.where(F.col("word").isNull()).drop("word", "times").join(rest, "row", "left")
    return whole.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def held_out_scores(docs: DataFrame, *, folds: int = 5, held: int = 1, **more) -> DataFrame:
    """``lm_scores`` learned outside one fold; rows with a null key count as held out."""
    part = fold(F.col("doc_id"), folds)
    out = (part == held) | (part < 0)
    return lm_scores(docs, ~out, **more).withColumn("held_out", out)
