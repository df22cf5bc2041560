"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping passages, weighted by TF-IDF over the terms
of the benchmark. A randomised SVD of all passages, corpus and benchmark,
spans the latent space; passages near a benchmark passage are candidates: what
their terms add to the latent product with it, measured by the product of a
copy, so that words beside a copy never make it less. A candidate is a hit when
its longest common subsequence with the benchmark passage covers enough of it,
or less of it together with the passage's answer. Passages of a long item
overlap, and a run without a gap as long as what is enough of one counts too.

The benchmark is a stated query set and is taken in blocks; each block's terms
and passages are bounded, so what travels to the tasks is too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import bytes_of, stage

PASSAGE, STRIDE = 64, 32
#: passages of a longer benchmark item begin so many words apart
STEP = 16


@dataclass(frozen=True)
class Queries:
    """Benchmark passages of a block: item, words, the words of the item's answer, and of longer items the words around too."""

    items: list[int]
    words: list[list[str]]
    answers: list[list[str]]
    around: list[list[str]]


_MARKS = ".,;:!?\"'()[]{}<>*#$%&|\u00ab\u00bb\u201c\u201d\u2018\u2019\u2026"


def tidy(text: bytes) -> list[str]:
    """Words in lower case without marks around them."""
    return [w for w in (w.strip(_MARKS) for w in text.decode("utf-8", "replace").lower().split()) if w]


def pieces_of(items: list[tuple[int, bytes, bytes | None]]) -> Queries:
    """Overlapping passages of at most ``PASSAGE`` words; the answer of an item without one is its last sentence."""
    out = Queries([], [], [], [])
    for item, text, answer in items:
        words = tidy(text)
        if answer is None:
            answer = next((s for s in reversed(text.replace(b"?", b".").replace(b"!", b".").split(b".")) if tidy(s)), b"")
        last = max(len(words) - PASSAGE, 0)
        for start in [*range(0, last, STEP), last] if words else []:
            out.items.append(item)
            out.words.append(words[start:start + PASSAGE])
            out.answers.append(tidy(answer))
            out.around.append(words[max(start - PASSAGE, 0):start + 2 * PASSAGE] if last else [])
    return out


def parts_of(queries: Queries, terms: int, passages: int = 2_000) -> Iterator[Queries]:
    """The passages in runs of at most ``passages`` with ``terms`` distinct words (one passage at least)."""
    part, seen = Queries([], [], [], []), set()
    for item, words, answer, around in zip(queries.items, queries.words, queries.answers, queries.around):
        if part.items and (len(part.items) == passages or len(seen.union(words)) > terms):
            yield part
            part, seen = Queries([], [], [], []), set()
        seen.update(words)
        part.items.append(item)
        part.words.append(words)
        part.answers.append(answer)
        part.around.append(around)
    if seen:
        yield part


def term_rows(ids: np.ndarray, sizes: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, times) of the known words of texts of ``sizes`` words, and the first passage of every text and of one more.

    Passages are numbered through all texts; a word is in one or two of them.
    """
    count = np.where(sizes > 0, np.maximum(1, -(-(sizes - PASSAGE) // STRIDE) + 1), 0)
    offsets, first = np.append(0, np.cumsum(count)), np.cumsum(sizes) - sizes
    known = np.flatnonzero(ids >= 0)
    text = np.repeat(np.arange(len(sizes)), sizes)[known]
    place, term = (known - first[text]) // STRIDE, ids[known]
    last = np.minimum(place, count[text] - 1)
    two = np.flatnonzero((place >= 1) & (place < count[text]))
    key = np.concatenate([(offsets[text] + last) * terms + term, (offsets[text[two]] + place[two] - 1) * terms + term[two]])
    key, times = np.unique(key, return_counts=True)
    return key // terms, key % terms, times, offsets


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        m = masks.get(w)
        if m is not None:
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def holds(words: list[str], run: list[str]) -> bool:
    """Whether ``run`` stands in ``words`` without a gap."""
    return bool(run) and any(words[i:i + len(run)] == run for i, w in enumerate(words) if w == run[0])


def common_run(a: list[str], b: list[str]) -> int:
    """Length of the longest run of words without a gap in both."""
    return SequenceMatcher(None, a, b, autojunk=False).find_longest_match().size


class _Numbers:
    """Term numbers of the words that ``tidy`` keeps; -1 for words that are no terms."""

    def __init__(self, index: dict[str, int]):
        self.terms = pa.array([w.encode() for w in sorted(index, key=index.get)], pa.large_binary())
        self.signs, self.two, self.three = np.zeros(256, bool), [], []
        for mark in (m.encode() for m in _MARKS):
            if len(mark) == 1:
                self.signs[mark[0]] = True
            else:
                (self.two if len(mark) == 2 else self.three).append(int.from_bytes(mark))

    def _marks(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray, left: bool) -> np.ndarray:
        """The size of the mark at one end of the words from ``first`` to before ``last``; 0 where there is none."""
        size, long = last - first, len(raw) - 1
        at = first if left else last - 1
        out = np.where((size >= 1) & self.signs[raw[np.clip(at, 0, long)]], 1, 0)
        for n, marks in ((2, self.two), (3, self.three)):
            some = np.flatnonzero((size >= n) & (out == 0) & (raw[np.clip(at, 0, long)] >= 0x80))
            code = np.zeros(len(some), np.int64)
            for k in range(n):
                code = code << 8 | raw[(first[some] if left else last[some] - n) + k]
            out[some[np.isin(code, marks)]] = n
        return out

    def of(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts, and how many words each text has."""
        split = [t.decode("utf-8", "replace").lower().split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        if not sizes.sum():
            return np.zeros(0, np.int64), sizes
        data = "\n".join(chain.from_iterable(split)).encode()
        raw = np.frombuffer(data, np.uint8)
        stops = np.append(np.flatnonzero(raw == 0x0A), len(raw))
        starts = np.append(0, stops[:-1] + 1)
        for left in (True, False):
            at = np.arange(len(starts))
            while len(at):
                found = self._marks(raw, starts[at], stops[at], left)
                at, found = at[found > 0], found[found > 0]
                (starts if left else stops)[at] += found if left else -found
        keep = starts < stops
        size = (stops - starts)[keep]
        ends = np.cumsum(size)
        inside = np.repeat(starts[keep] - (ends - size), size)
        inside += np.arange(len(inside))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [
            None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(raw[inside])])
        numbers = pc.fill_null(pc.index_in(words, self.terms), -1).to_numpy().astype(np.int64)
        whole = np.append(0, np.cumsum(keep))
        last = np.cumsum(sizes)
        return numbers, whole[last] - whole[last - sizes]


def idf_of(texts: DataFrame, queries: Queries, *, common: float) -> tuple[dict[str, int], np.ndarray]:
    """(term numbers, their weights) from all passages of ``texts``.

    Terms in more than a share ``common`` of the passages weigh nothing, unless
    they are in the rarer half of a benchmark passage's terms.
    """
    vocabulary = sorted(set().union(*map(set, queries.words)) if queries.words else ())
    index = {w: i for i, w in enumerate(vocabulary)}

    def rows(batches):
        found, passages, numbers = np.zeros(len(index) + 1, np.int64), 0, _Numbers(index)
        for b in batches:
            _, term, _, offsets = term_rows(*numbers.of(b["text"]), max(len(index), 1))
            found[:-1] += np.bincount(term, minlength=len(index))
            passages += offsets[-1]
        found[-1] = passages
        used = np.flatnonzero(found)
        yield pd.DataFrame({"term": used, "n": found[used]})

    got = texts.mapInPandas(rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(len(index) + 1)  # a row per term of the block at most
    for r in got:
        count[r["term"]] = r["n"]
    passages = count[-1] + len(queries.words)
    own = Counter(w for words in queries.words for w in set(words))
    df = count[:-1] + np.array([own[w] for w in vocabulary], float)
    weight = np.log1p(passages / (df + 0.5))
    needed = np.zeros(len(weight), bool)
    for words in queries.words:
        own_terms = np.array(sorted({index[w] for w in words}), int)
        needed[own_terms[np.argsort(df[own_terms], kind="stable")][:(len(own_terms) + 1) // 2]] = True
    weight[(df > common * passages) & ~needed] = 0.0
    return index, weight


def query_rows(queries: Queries, index: dict[str, int], weight: np.ndarray) -> np.ndarray:
    """TF-IDF of the benchmark passages with damped counts, one row each."""
    out = np.zeros((len(queries.words), len(index)))
    for k, words in enumerate(queries.words):
        for w, n in Counter(words).items():
            out[k, index[w]] = damped(n) * weight[index[w]]
    return out


def damped(times: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(times)


def gate_of(queries: Queries, index: dict[str, int], weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(terms by benchmark passages) what a term adds to the likeness of a text and a benchmark passage.

    The latent product of a text and a benchmark passage, divided by that of the
    passage with itself; no term takes anything away. So a text that holds all
    words of the passage has 1 or more, whatever else it holds and however large
    the corpus is.
    """
    own = query_rows(queries, index, weight)
    close = basis @ (own @ basis).T
    whole = np.einsum("qt,tq->q", own, close)
    return np.maximum(close / np.maximum(whole, 1e-9), 0.0).astype(np.float32)


def _products(sums: np.ndarray, term: np.ndarray, v: np.ndarray, first: np.ndarray, size: np.ndarray, at_once: int = 1_000_000) -> None:
    """Add the upper triangle of x x' to ``sums`` for every passage x, given by its ascending terms and values from ``first`` on."""
    flat, terms = sums.ravel(), len(sums)
    ends = np.cumsum(size * (size + 1) // 2)
    lo = 0
    while lo < len(first):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + at_once, side="right")))
        at = np.arange(first[lo], first[hi - 1] + size[hi - 1])
        each = np.repeat(first[lo:hi] + size[lo:hi], size[lo:hi]) - at  # a term and those behind it in its passage
        right = np.arange(each.sum()) + np.repeat(at - (np.cumsum(each) - each), each)
        np.add.at(flat, np.repeat(term[at] * terms, each) + term[right], np.repeat(v[at], each) * v[right])
        lo = hi


def latent(texts: DataFrame, queries: Queries, index: dict[str, int], weight: np.ndarray, *, rank: int,
           seed: int = 11) -> np.ndarray:
    """Right singular vectors (terms by ``rank``) of the TF-IDF rows of all passages, by a randomised SVD.

    One pass sketches the matrix: every task adds up its passages' share of A'A
    and sends its product with Omega, which grows with terms and rank only; the
    sum gives the singular vectors. The benchmark's rows weigh as much as all others together.
    """
    terms = len(index)
    rank = max(1, min(rank, terms))
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, min(terms, rank + 16))))[0].astype(np.float32)
    idf = weight.astype(np.float32)

    def rows(batches):
        sums, energy, numbers = np.zeros((terms, terms), np.float32), 0.0, _Numbers(index)
        for b in batches:
            passage, term, times, _ = term_rows(*numbers.of(b["text"]), terms)
            v = damped(times) * idf[term]
            use = v > 0
            passage, term, v = passage[use], term[use], v[use]
            if not len(v):
                continue
            first = np.flatnonzero(np.append(True, np.diff(passage) > 0))
            energy += len(first)
            size = np.diff(np.append(first, len(v)))
            v = v / np.repeat(np.sqrt(np.add.reduceat(v * v, first)), size)
            _products(sums, term, v.astype(np.float32), first, size)
        own = sums.diagonal().copy()
        sums += sums.T.copy()  # the lower triangle was empty
        np.fill_diagonal(sums, own)
        sketch = (sums @ omega).astype(float)
        used = np.flatnonzero(sketch.any(axis=1))
        yield pd.DataFrame({"term": np.append(used, -1), "row": [*sketch[used], np.array([energy])]})

    summed = texts.mapInPandas(rows, "term long, row array<double>").select("term", F.posexplode("row").alias("c", "v")).groupBy(
        "term", "c").agg(F.sum("v").alias("v")).groupBy("term").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("c", "v"))), lambda x: x["v"]).alias("row"))
    sketch, energy = np.zeros(omega.shape), 0.0
    for r in summed.collect():  # a row per term of the block at most
        if r["term"] < 0:
            energy = r["row"][0]
        else:
            sketch[r["term"]] = r["row"]
    own = query_rows(queries, index, weight)
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    sketch += max(energy, 1.0) / max(len(own), 1) * (own.T @ (own @ omega))
    # Nystroem: A'A is about S (omega' S)^+ S', whose eigenvectors are the right singular vectors
    core = omega.T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(initial=0), 1e-30)
    left, _, _ = np.linalg.svd(sketch @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left[:, :rank].astype(np.float32)


def search(docs: DataFrame, queries: Queries, index: dict[str, int], weight: np.ndarray, basis: np.ndarray, *,
           cosine: float, covered: float, partly: float) -> DataFrame:
    """(doc_id, item_id, cosine, covered, answered) of the hits, the best passage of each pair."""
    close = gate_of(queries, index, weight, basis)
    idf = weight.astype(np.float32)

    needs = [set(words) for words in queries.words]
    some = max(1, 8_000_000 // (PASSAGE * max(1, len(needs))))  # passages at once: 32 MB
    reach = close.max(axis=1, initial=0.0)  # no passage gets more from a term

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = _Numbers(index)
        for b in batches:
            passage, term, times, offsets = term_rows(*numbers.of(b["text"]), len(index))
            v = (damped(times) * idf[term]).astype(np.float32)
            near = np.bincount(passage, v * reach[term], offsets[-1]) >= cosine * (1 - 1e-4)
            use = (v > 0) & near[passage]
            passage, term, v = passage[use], term[use], v[use]
            starts = np.flatnonzero(np.append(True, np.diff(passage) > 0)) if len(v) else np.zeros(0, int)
            best: dict[tuple[int, int], tuple] = {}
            text, words = -1, []
            for lo in range(0, len(starts), some):
                a = starts[lo]
                e = starts[lo + some] if lo + some < len(starts) else len(passage)
                like = np.add.reduceat(close[term[a:e]] * v[a:e, None], starts[lo:lo + some] - a, axis=0)
                at = passage[starts[lo:lo + some]]
                texts = np.searchsorted(offsets, at, side="right") - 1
                for w, q in zip(*np.nonzero(like >= cosine * (1 - 1e-4))):
                    if texts[w] != text:
                        text = int(texts[w])
                        words = tidy(b["text"].iloc[text])
                    asked, begin = queries.words[q], int(at[w] - offsets[text]) * STRIDE
                    start = max(0, begin - len(asked))
                    region = words[start:begin + PASSAGE + len(asked)]
                    if sum(map(needs[q].__contains__, region)) < min(covered, partly) * len(asked):  # a bound of what they share
                        continue
                    if len(asked) < 8:
                        share, answered = float(holds(region, asked)), False
                    else:
                        share = common_subsequence(asked, region) / len(asked)
                        answered = holds(region, queries.answers[q])
                        if partly <= share < covered and queries.around[q]:  # a copy across the passage's border
                            run = common_run(queries.around[q], region) / PASSAGE
                            share = max(share, min(run, 1.0) if run >= covered else 0.0)
                    if share >= covered or share >= partly and answered:
                        got = (share, min(1.0, float(like[w, q])), answered)
                        pair = text, queries.items[q]
                        best[pair] = max(got, best.get(pair, got))
            out = [(b["doc_id"].iloc[text], item, c, s, a) for (text, item), (s, c, a) in best.items()]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "cosine", "covered", "answered"])

    # the key travels as text: pandas would make a float of a long that may be null
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        rows, "doc_id string, item_id long, cosine double, covered double, answered boolean")
    return _best(found.withColumn("doc_id", F.col("doc_id").cast("long")))


def _best(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("covered", "cosine", "answered")).alias("x")).select(
        "doc_id", "item_id", "x.cosine", "x.covered", "x.answered")


def _blocks(items: DataFrame, block: int) -> Iterator[list]:
    """The rows of ``items`` about ``block`` at a time: those without an id by a hash, then the others by their ids."""
    for place, group in ((F.xxhash64("text", "answer"), F.col("item_id").isNull()), (F.col("item_id"), F.col("item_id").isNotNull())):
        left, more = items.where(group).withColumn("at", place), True
        while more:
            some = left.orderBy("at").limit(block).collect()
            more = len(some) == block
            if more:  # rows of one item stay together
                last = some[-1]["at"]
                some = [r for r in some if r["at"] != last] + left.where(F.col("at") == last).collect()
                left = left.where(F.col("at") > last)
            if some:
                yield some


def contaminated(docs: DataFrame, benchmark: DataFrame, *, answer: str | None = None, rank: int = 256,
                 cosine: float = 0.2, covered: float = 0.7, partly: float = 0.5, common: float = 0.1,
                 block: int = 200, terms: int = 5_000) -> DataFrame:
    """A row for each document and benchmark item of which it holds a passage.

    ``answer`` names a column of ``benchmark`` with the items' answers. Items
    are taken ``block`` at a time in the order of their ids, and of these as many as
    have ``terms`` distinct words; tasks hold a matrix of these terms (100 MB). Null and empty
    documents and items match nothing; rows without a doc_id or item_id are reported with a
    null one. Repeated rows of a document or item give one row. Without
    documents, items or hits there is none. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of(F.col("text")).alias("text"))
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), bytes_of(F.col("text")).alias("text"),
        (F.col(answer).cast("binary") if answer else F.lit(None).cast("binary")).alias("answer")).distinct()
    out = None
    for some in _blocks(items, block):
        queries = pieces_of([(r["item_id"], bytes(r["text"]), None if r["answer"] is None else bytes(r["answer"])) for r in some])
        for queries in parts_of(queries, terms):
            index, weight = idf_of(texts.select("text"), queries, common=common)
            basis = latent(texts.select("text"), queries, index, weight, rank=rank)
            found = stage(search(texts, queries, index, weight, basis, cosine=cosine, covered=covered, partly=partly),
                          "contaminated")
            out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, covered double, answered boolean")
    return _best(out)
