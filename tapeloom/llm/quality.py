"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, each chosen pair of features a
table over two coarser binnings. The tables are learned by cyclic boosting of
shallow trees on a bounded sample of labelled documents; a document's score is
the logistic function of the sum of its table entries.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import LABELLED, bytes_of, fold, labelled_sample

_CLASSES = np.zeros((256, 9))
_CLASSES[ord("a"):ord("z") + 1, 0] = 1
_CLASSES[ord("A"):ord("Z") + 1, 1] = 1
_CLASSES[ord("0"):ord("9") + 1, 2] = 1
_CLASSES[[ord(c) for c in " \t\n\r\v\f"], 3] = 1
_CLASSES[[ord(c) for c in ".,;:'\"()-?"], 4] = 1
_CLASSES[[ord(c) for c in "!"], 5] = 1
_CLASSES[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"], 6] = 1
_CLASSES[128:, 7] = 1
_CLASSES[ord("\n"), 8] = 1

FEATURES = (
    "log_bytes", "lower", "upper", "digits", "space", "marks", "shouts", "symbols", "high", "breaks",
    "log_words", "word_length", "longest_word", "distinct_words", "top_word", "short_words",
    "distinct_lines", "top_line", "line_words", "sentence_words",
)


def features(text: bytes) -> list[float]:
    """Counts and shares over the whole text; an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
    words = text.split()
    k = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.splitlines() if x.strip()]
    m = max(len(lines), 1)
    distinct = Counter(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    stops = text.count(b".") + text.count(b"!") + text.count(b"?")
    return [
        float(np.log1p(n)), *(shares[:8] / n).tolist(), float(shares[8] / k),
        float(np.log1p(len(words))), float(lengths.mean()), float(np.log1p(lengths.max())),
        len(counts) / k, max(counts.values(), default=0) / k, float((lengths <= 2).mean()),
        len(distinct) / m, max(distinct.values(), default=0) / m, k / m, k / (stops + 1),
    ]


@dataclass(frozen=True)
class Additive:
    """The fitted tables; ``score`` adds up one entry of each."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of the rows of ``x``, between 0 and 1."""
        total = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, f], side="right")]
        for a, b, table in self.pairs:
            i = np.searchsorted(self.coarse[a], x[:, a], side="right")
            j = np.searchsorted(self.coarse[b], x[:, b], side="right")
            total += table[i, j]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best split of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Newton step of each bin from a tree of at most ``leaves`` leaves over the bins."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max((*_best_cut(g[a:b], h[a:b], ridge), k) for k, (a, b) in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts.pop(k)
        parts += [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree of depth two that cuts a grid once along either axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    ag, ah = cg[:-1, :-1], ch[:-1, :-1]
    bg, bh = cg[:-1, -1:] - ag, ch[:-1, -1:] - ah
    dg, dh = cg[-1:, :-1] - ag, ch[-1:, :-1] - ah
    eg, eh = tg - ag - bg - dg, th - ah - bh - dh
    if not ag.size:
        return 0.0, np.zeros_like(g)
    gain = sum(x**2 / (y + ridge) for x, y in ((ag, ah), (bg, bh), (dg, dh), (eg, eh))) - tg**2 / (th + ridge)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(g)
    for rows, cols, x, y in (
        (slice(None, i + 1), slice(None, j + 1), ag, ah), (slice(None, i + 1), slice(j + 1, None), bg, bh),
        (slice(i + 1, None), slice(None, j + 1), dg, dh), (slice(i + 1, None), slice(j + 1, None), eg, eh),
    ):
        step[rows, cols] = x[i, j] / (y[i, j] + ridge)
    return float(gain[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, bins: int = 32, grid: int = 8, pairs: int = 8,
        rounds: int = 150, rate: float = 0.15, leaves: int = 3, ridge: float = 4.0) -> Additive:
    """Cyclic boosting: each round gives every table one small tree on the current residuals.

    With no rows, or rows of one class, every score is the smoothed share of class 1.
    """
    mean = (float((y * weight).sum()) + 0.5) / (float(weight.sum()) + 1.0)
    base = float(np.log(mean / (1 - mean)))
    if len(y) == 0 or y.min() == y.max():
        return Additive(base, [], [], [], [])
    cuts = [_cuts(x[:, f], bins) for f in range(x.shape[1])]
    at = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), base)

    def pull():
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
        return (y - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight

    for _ in range(rounds):
        for f, (k, table) in enumerate(zip(at, tables)):
            g, h = pull()
            size = len(table)
            step = rate * _tree(np.bincount(k, g, size), np.bincount(k, h, size), leaves, ridge)
            table += step
            total += step[k]
    coarse = [_cuts(x[:, f], grid) for f in range(x.shape[1])]
    cell = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]

    def summed(a, b, v):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(cell[a] * shape[1] + cell[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = pull()
    ranked = sorted(
        ((_quadrants(summed(a, b, g), summed(a, b, h), ridge)[0], a, b)
         for a in range(len(cuts)) for b in range(a + 1, len(cuts))), reverse=True)
    chosen = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for gain, a, b in ranked[:pairs] if gain > 1e-9]
    for _ in range(rounds // 2):
        for a, b, table in chosen:
            g, h = pull()
            step = rate * _quadrants(summed(a, b, g), summed(a, b, h), ridge)[1]
            table += step
            total += step[cell[a], cell[b]]
    return Additive(base, cuts, tables, coarse, chosen)


def learn(docs: DataFrame, labels: DataFrame, training: Column, *, per_class: int = 10_000) -> Additive:
    """Fit on at most ``2 * per_class`` labelled documents that meet ``training`` (a condition on doc_id)."""
    sample = labelled_sample(docs, labels, "quality", training, per_class)

    def rows(batches):
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "share": b["share"], "x": [features(t) for t in b["text"]]})

    got = sample.mapInPandas(rows, LABELLED).toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got["label"].to_numpy(float), got["share"].to_numpy(float))


def score(text: Column, model: Additive) -> Column:
    """Score of a text (null: empty), 0 to 1, higher for better texts."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(x))

    return run(bytes_of(text))


def quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, threshold: float = 0.3,
            per_class: int = 10_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The model sees only rows outside the held-out fold. Rows with a null key
    count as held out. Repeated rows get a row each; an empty table gives none;
    other columns of ``docs``, whatever their names, are ignored. Null and empty
    texts are scored as texts without any feature.
    """
    part = fold(F.col("doc_id"), folds)
    out = (part == held) | (part < 0)
    model = learn(docs, labels, ~out, per_class=per_class)
    return docs.select("doc_id", out.alias("held_out"), score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
