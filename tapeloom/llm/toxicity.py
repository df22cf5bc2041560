"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding undoes look-alike letters and digits or signs that stand for letters.
The lexicon (whole words and word beginnings) and its weights are learned from
labelled documents; phrases in which a term is harmless are exceptions. The
weights found in a text are normalised by its length and turned into a
probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import LABELLED, bytes_of, fold as fold_of, labelled_sample, stage

#: letters of other scripts that look like Latin ones
HOMOGLYPHS = str.maketrans(
    "\u0430\u0435\u043e\u0440\u0441\u0443\u0445\u0456\u0458\u0455\u0501\u04bb\u0432\u043a\u043c\u043d\u0442"
    "\u03b1\u03b5\u03b9\u03ba\u03bd\u03bf\u03c1\u03c4\u03c5\u03c7\u0131",
    "aeopcyxijsdhbkmht"
    "aeikvoptuxi",
    "\u200b\u200c\u200d\u00ad\u2060",  # and invisible marks go
)
SUBSTITUTES = str.maketrans("0134578@$!|", "oieastbasil")
_ANY_SUBSTITUTE = re.compile(r"[0134578@$!|]")
_TOKEN = re.compile(r"[^\W_]+")
#: a word with the signs that stand for letters before, in and after it
_SIGNED = re.compile(r"(?<![@$!|])([@$!|]*)((?:[^\W_][@$!|]*)*[^\W_])([@$!|]*)")
_LETTER = re.compile(r"[^\W\d_]")


def readings(text: bytes) -> tuple[list[str], list[tuple[int, str]]]:
    """Folded words of a text, and other readings of some, with the word's number.

    Every substitute in a word with a letter is folded. Signs at its end may be
    marks or letters, and it may be meant as it stands, so these are read too.
    """
    s = text.decode("utf-8", "replace").lower()
    if not s.isascii():
        s = s.translate(HOMOGLYPHS)
    if not _ANY_SUBSTITUTE.search(s):
        return _TOKEN.findall(s), []
    words, others = [], []
    for m in _SIGNED.finditer(s):
        if not _ANY_SUBSTITUTE.search(m[0]):
            words.append(m[0])
        elif not _LETTER.search(m[0]):
            words += _TOKEN.findall(m[0])
        else:
            word = (m[1] + m[2]).translate(SUBSTITUTES)
            more = {word + m[3].translate(SUBSTITUTES), *filter(_LETTER.search, _TOKEN.findall(m[0]))} - {word}
            others += [(len(words), w) for w in sorted(more)]
            words.append(word)
    return words, others


def folded(text: bytes) -> list[str]:
    """Folded words of a text."""
    return readings(text)[0]


def every_reading(text: bytes) -> list[str]:
    words, others = readings(text)
    return words + [w for _, w in others]


def candidates(words: list[str]) -> set[str]:
    """Terms a text votes for: its words, ended by a space, and their beginnings."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(4, min(len(w), 8)))
    return out


@dataclass(frozen=True)
class Lexicon:
    """Weighted terms, harmless phrases, and the logistic weights of the document score."""

    terms: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)


def machine(lexicon: Lexicon):
    found = ahocorasick.Automaton()
    for phrase in lexicon.exceptions:
        found.add_word(phrase, (len(phrase), None))
    for term, weight in lexicon.terms:
        found.add_word(term, (len(term), weight))
    if len(found):
        found.make_automaton()
    return found


def matches(text: str, found: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """(start, weight) of the words hit, the heaviest term of each, outside exception phrases.

    ``text`` has folded words with one space before, between and after them.
    """
    if not len(found):
        return []
    hits: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight) in found.iter(text):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        else:
            hits[start] = max(weight, hits.get(start, 0.0))
    if spared:
        hits = {s: w for s, w in hits.items() if not any(a <= s < b for a, b in spared)}
    return sorted(hits.items())


def measures(text: bytes, found: ahocorasick.Automaton) -> list[float]:
    """Whether any term is hit, the summed weight, and the weight per hundred words (both as logs)."""
    words, others = readings(text)
    hits = matches(f" {' '.join(words)} ", found) if words else []
    total = sum(w for _, w in hits)
    if others:
        places, held = np.cumsum([0] + [len(w) + 1 for w in words]).tolist(), dict(hits)
        best: dict[int, float] = {}
        for k, other in others:  # a word counts once, by its heaviest reading
            best[k] = max(best.get(k, 0.0), *(w for _, w in matches(f" {other} ", found)), 0.0)
        total += sum(max(0.0, w - held.get(places[k], 0.0)) for k, w in best.items())
    return [float(total > 0), float(np.log1p(total)), float(np.log1p(100.0 * total / max(len(words), 1)))]


def contexts(words: list[str], found: ahocorasick.Automaton) -> set[str]:
    """Two-word phrases around the hits of a text."""
    text = f" {' '.join(words)} "
    out = set()
    for start, _ in matches(text, found):
        stop = text.index(" ", start + 1)
        if start > 0:
            out.add(text[text.rindex(" ", 0, start):stop + 1])
        if stop + 1 < len(text):
            out.add(text[start:text.index(" ", stop + 1) + 1])
    return out


def choose(votes: list[tuple[str, int, int]], toxic: int, clean: int, *, least: int, share: float, odds: float,
           size: int) -> tuple[tuple[str, float], ...]:
    """Terms whose log odds are at least ``odds``; of a beginning and its continuations the more telling stay."""
    need = max(least, share * toxic)
    good = {}
    for term, a, b in votes:
        weight = float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1)))
        if a >= need and weight >= odds:
            good[term] = (weight, a)
    kept = dict(good)
    for term in sorted(good, key=len, reverse=True):  # a longer term with the same support is more specific
        weight, a = good[term]
        for k in range(5, len(term)):
            short = good.get(term[:k])
            if short and a >= 0.95 * short[1] and weight >= short[0] - 0.1:
                kept.pop(term[:k], None)
    for term in sorted(kept, key=len, reverse=True):
        if any(term[:k] in kept and kept[term[:k]][0] >= kept[term][0] - 0.5 for k in range(5, len(term))):
            kept.pop(term)
    return tuple(sorted(((t, w) for t, (w, _) in kept.items()), key=lambda x: (-x[1], x[0]))[:size])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> tuple[float, ...]:
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ ((y - p) * weight) - ridge * beta
        h = (x * (np.maximum(p * (1 - p), 1e-9) * weight)[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def learn(docs: DataFrame, labels: DataFrame, training: Column, *, per_class: int = 10_000, least: int = 4,
          share: float = 0.002, odds: float = 2.0, size: int = 5_000) -> Lexicon:
    """Lexicon, exceptions and score curve from at most ``2 * per_class`` labelled documents.

    ``least`` and ``share`` bound a term's support from below, in documents and
    as a share of the toxic ones; ``size`` bounds the lexicon.
    """
    sample = stage(labelled_sample(docs, labels, "toxic", training, per_class), "toxicity-sample")
    held = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = held.get(1, 0), held.get(0, 0)
    if not toxic or not clean:
        mean = (toxic + 0.5) / (toxic + clean + 1)
        return Lexicon((), (), (float(np.log(mean / (1 - mean))), 0.0, 0.0, 0.0))

    def tally(batches, lexicon):
        found = lexicon and machine(lexicon)
        votes = (Counter(), Counter())
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                votes[label].update(contexts(folded(text), found) if lexicon else candidates(every_reading(text)))
        terms = list(votes[0].keys() | votes[1].keys())
        for i in range(0, len(terms), 50_000):
            part = terms[i:i + 50_000]
            yield pd.DataFrame({"term": part, "toxic": [votes[1][t] for t in part], "clean": [votes[0][t] for t in part]})

    def votes(lexicon=None):
        return sample.mapInPandas(lambda bs: tally(bs, lexicon), "term string, toxic long, clean long").groupBy(
            "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    need = max(least, share * toxic)
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = votes().where((F.col("toxic") >= need) & (weight >= odds)).orderBy(
        weight.desc(), "term").limit(20 * size)
    terms = choose([tuple(r) for r in best.collect()], toxic, clean, least=least, share=share, odds=odds, size=size)
    harmless = votes(Lexicon(terms)).where(
        (F.col("clean") >= least) & (F.col("toxic") / toxic < F.col("clean") / clean)).orderBy(
        F.desc("clean"), "term").limit(size)
    full = Lexicon(terms, tuple(sorted(r["term"] for r in harmless.collect())))

    def rows(batches):
        found = machine(full)
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "share": b["share"], "x": [measures(t, found) for t in b["text"]]})

    got = sample.mapInPandas(rows, LABELLED).toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), 3)
    return Lexicon(full.terms, full.exceptions, _logistic(x, got["label"].to_numpy(float), got["share"].to_numpy(float)))


def score(text: Column, lexicon: Lexicon) -> Column:
    """Probability that a text (null: empty) is toxic."""
    base, *weights = lexicon.curve

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = machine(lexicon)
        for texts in batches:
            x = np.array([measures(t, found) for t in texts], dtype=float).reshape(len(texts), 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(base + x @ np.array(weights), -30, 30))))

    return run(bytes_of(text))


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, threshold: float = 0.7,
             per_class: int = 10_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The lexicon is learned outside the held-out fold. Rows with a null key count
    as held out. Null, empty and wordless texts hit nothing and get the score
    of a text without hits. Repeated rows get a row each; an empty table gives
    none; other columns, whatever their names, are ignored.
    """
    part = fold_of(F.col("doc_id"), folds)
    out = (part == held) | (part < 0)
    lexicon = learn(docs, labels, ~out, per_class=per_class)
    return docs.select("doc_id", out.alias("held_out"), score(F.col("text"), lexicon).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
