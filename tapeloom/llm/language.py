"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of one fixed public vocabulary,
learned as expected counts over the words of its training texts. A text's
likelihood in a language sums over all its segmentations.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import bytes_of, fold, stage
from tapeloom.llm.lattice import START, Lattice, default_path, first_weights, vocabulary

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: bytes) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall(text.decode("utf-8", "replace").lower())


@dataclass(frozen=True)
class Languages:
    names: list[str]
    pieces: list[tuple[str, float]]
    logp: np.ndarray  # pieces by languages
    prior: np.ndarray


def learn(docs: DataFrame, training: Column, *, per_language: int = 2_000, rounds: int = 2, prior: float = 50.0,
          vocabulary_path: str | None = None) -> Languages:
    """Fit on at most ``per_language`` training documents of every language, the first ones by a hash of their key."""
    pieces = vocabulary(vocabulary_path or default_path())
    first = first_weights(pieces)
    rows = docs.where(training & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"), "doc_id", bytes_of(F.col("text")).alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Languages([], pieces, np.zeros((len(pieces), 0)), np.zeros(0))
    picked = rows.select("lang", "h", "doc_id").withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(
        F.col("k") <= per_language).select("lang", "doc_id").distinct()
    # at most per_language rows of each language
    sample = rows.select("lang", "doc_id", "text").join(F.broadcast(picked), ["lang", "doc_id"])

    def tally(batches):
        found: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                found.setdefault(lang, Counter()).update(letter_words(text))
        for lang, c in ((lang, c) for lang, c in found.items() if c):
            yield pd.DataFrame({"lang": lang, "word": list(c.keys()), "n": list(c.values())})

    words = stage(sample.select("lang", "text").mapInPandas(tally, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n")), "language-words")
    share = np.tile(first[:, None], len(names))
    for _ in range(rounds):
        with np.errstate(divide="ignore"):
            logp = np.log(share)

        def expect(batches, logp=logp):
            cut = Lattice(pieces)
            total = np.zeros(logp.shape)
            for b in batches:
                for lang, part in b.groupby("lang"):
                    g = names.index(lang)
                    total[:, g] += cut.expected([START + w for w in part["word"]], part["n"].to_numpy(float), logp[:, g:g + 1])
            p, g = np.nonzero(total)
            yield pd.DataFrame({"piece": p, "g": g, "uses": total[p, g]})

        got = words.mapInPandas(expect, "piece long, g long, uses double").groupBy("piece", "g").agg(
            F.sum("uses").alias("uses")).toPandas()  # pieces times languages at most
        share = prior * np.tile(first[:, None], len(names))
        share[got["piece"].to_numpy(int), got["g"].to_numpy(int)] += got["uses"].to_numpy(float)
        share /= share.sum(0)
    with np.errstate(divide="ignore"):
        logp = np.log(share)
    weight = np.array([sizes[n] for n in names], float)
    return Languages(names, pieces, logp, np.log(weight / weight.sum()))


def predict(text: Column, model: Languages) -> Column:
    """The posterior and the name of a text's likeliest language, with a space between; 0 and ``und`` where there is no letter."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut, known = Lattice(model.pieces), {}
        for texts in batches:
            split = [letter_words(t) for t in texts]
            places = {w: i for i, w in enumerate(set().union(*split))}
            new = [w for w in places if w not in known]
            if len(known) + len(new) > 200_000:
                known.clear()
                new = list(places)
            spelled = [w for w in new if any(map(str.isalpha, w))]
            known.update(dict.fromkeys(new, None))
            known.update(zip(spelled, cut.forward([START + w for w in spelled], model.logp)))
            none = np.full(len(model.names), np.nan)
            table = np.array([none if known[w] is None else known[w] for w in places]).reshape(len(places), len(model.names))
            langs, scores = [], []
            for words in split:
                x = table[np.fromiter(map(places.__getitem__, words), np.int64, len(words))]
                if not model.names or not len(x) or np.isnan(x).all():
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = np.nansum(x, axis=0) + model.prior
                best = int(np.argmax(total))
                langs.append(model.names[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pd.Series([f"{s!r} {name}" for name, s in zip(langs, scores)], dtype=object)

    return run(bytes_of(text))


def languages(docs: DataFrame, *, folds: int = 3, held: int = 1, **more) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    Learned from rows outside the held-out fold whose ``lang`` is not null; rows
    with a null key count as held out. Null, empty and letterless texts are
    ``und`` with score 0, as is everything where nothing could be learned.
    Repeated rows get a row each; an empty table gives none; other columns,
    whatever their names, are ignored.
    """
    part = fold(F.col("doc_id"), folds)
    out = (part == held) | (part < 0)
    found = predict(F.col("text"), learn(docs, ~out, **more))
    return docs.select("doc_id", out.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.expr("substring(found, instr(found, ' ') + 1)").alias("lang_pred"),
        F.substring_index("found", " ", 1).cast("double").alias("score"))
