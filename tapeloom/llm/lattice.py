"""Unigram models over the pieces of a fixed public vocabulary, marginal over all segmentations.

A word is the string of a word-start mark and its characters. Its probability is
the sum over all ways to cut that string into pieces of the product of the
piece probabilities, found by a forward recursion in log space. Pieces never
cross a word start, so a text's probability is the product over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

START = "▁"


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def first_weights(pieces: list[tuple[str, float]], byte_share: float = 1e-4) -> np.ndarray:
    """Probabilities from the vocabulary's scores.

    The scores of the vocabulary are negative ranks, which a Zipf law turns into
    probabilities; byte pieces share a fixed small mass, marks have none.
    """
    p = np.zeros(len(pieces))
    for i, (piece, score) in enumerate(pieces):
        if piece.startswith("<0x"):
            p[i] = -1.0
        elif piece.startswith("<") and piece.endswith(">") and len(piece) > 2 or START in piece[1:]:
            p[i] = 0.0
        else:
            p[i] = 1.0 / (3.0 - score if score > -1e8 else 1e9)
    byte = p < 0
    p[byte] = 0
    p *= (1 - byte_share) / p.sum()
    p[byte] = byte_share / max(byte.sum(), 1)
    return p


class Lattice:
    """Cuts words into all their piece sequences and sums over them.

    The pieces form a trie whose edges are in one hash table, so that all
    starts of all words of a batch walk it together.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.size = len(pieces)
        self.bytes = np.zeros(256, np.int64)
        edges: dict[int, int] = {}
        ends = [-1]
        for i, (piece, _) in enumerate(pieces):
            if piece.startswith("<0x"):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (piece.startswith("<") and piece.endswith(">") and len(piece) > 2) and START not in piece[1:]:
                node = 0
                for c in piece:
                    key = node << 21 | ord(c)
                    node = edges.setdefault(key, len(ends))
                    if node == len(ends):
                        ends.append(-1)
                ends[node] = i
        self.ends = np.array(ends)
        self.bits = max(4, len(edges).bit_length() + 3)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.children = np.zeros(1 << self.bits, np.int64)
        for key, child in edges.items():
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.children[at] = key, child

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The children of nodes along characters, or -1."""
        keys = nodes << 21 | chars
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.children[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.children[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def _blocks(self, words: list[str], chars: int = 400_000) -> Iterator["_Arcs"]:
        """The arcs of the words, longest words first, about ``chars`` characters at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        block = np.cumsum(lengths[order]) // chars
        for part in np.split(order, np.flatnonzero(np.diff(block)) + 1):
            if len(part):
                yield self._arcs(part, [words[i] for i in part], lengths[part])

    def _arcs(self, part: np.ndarray, words: list[str], lengths: np.ndarray) -> "_Arcs":
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        first = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(words)), lengths)
        stop = (first + lengths)[owner]
        start = np.arange(len(text))
        node, single = np.zeros(len(text), np.int64), np.zeros(len(text), bool)
        starts, sizes, ids = [], [], []
        size = 0
        while len(start):
            node = self._step(node, text[start + size])
            size += 1
            live = node >= 0
            start, node = start[live], node[live]
            piece = self.ends[node]
            hit = piece >= 0
            starts.append(start[hit])
            sizes.append(np.full(int(hit.sum()), size))
            ids.append(piece[hit])
            if size == 1:
                single[start[hit]] = True
            more = start + size < stop[start]
            start, node = start[more], node[more]
        odd = np.flatnonzero(~single)
        spelled, which = np.unique(text[odd], return_inverse=True)
        starts.append(odd)
        sizes.append(np.ones(len(odd), np.int64))
        ids.append(self.size + which)
        start, size = np.concatenate(starts), np.concatenate(sizes)
        word = owner[start]
        return _Arcs(part, lengths, word, start - first[word], size, np.concatenate(ids), [chr(c) for c in spelled])

    def _table(self, logp: np.ndarray, odd: list[str]) -> np.ndarray:
        spelled = [logp[self.bytes[list(c.encode("utf-8", "surrogatepass"))]].sum(0) for c in odd]
        return np.concatenate([logp, np.array(spelled).reshape(len(odd), logp.shape[1])])

    def forward(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability under each column of ``logp``."""
        out = np.zeros((len(words), logp.shape[1]))
        for arcs in self._blocks(words):
            table = self._table(logp, arcs.odd)
            for g in range(logp.shape[1]):
                out[arcs.part, g] = arcs.last(arcs.recursion(table[arcs.ids, g]))
        return out

    def expected(self, words: list[str], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over words that occur ``counts`` times; ``logp`` has one column."""
        total = np.zeros(self.size)
        for arcs in self._blocks(words):
            weight = self._table(logp, arcs.odd)[arcs.ids, 0]
            ahead, back = arcs.recursion(weight), arcs.recursion(weight, backward=True)
            uses = np.exp(ahead[arcs.source] + weight + back[arcs.target] - arcs.last(ahead)[arcs.word])
            used = np.bincount(arcs.ids, np.nan_to_num(uses) * counts[arcs.part][arcs.word], self.size + len(arcs.odd))
            total += used[:self.size]
            for c, k in zip(arcs.odd, used[self.size:]):
                np.add.at(total, self.bytes[list(c.encode("utf-8", "surrogatepass"))], k)
        return total


class _Arcs:
    """All arcs of a block of words, the longest words first."""

    def __init__(self, part, lengths, word, start, size, ids, odd):
        self.part, self.lengths, self.word, self.ids, self.odd = part, lengths, word, ids, odd
        self.base = np.cumsum(lengths + 1) - (lengths + 1)  # a word of n characters has n + 1 states
        self.source, self.target = self.base[word] + start, self.base[word] + start + size
        self.start, self.end = start, start + size

    def recursion(self, weight: np.ndarray, backward: bool = False) -> np.ndarray:
        """Log sums of the paths from a word's first state to each state, or from each state to its last one."""
        state = np.full(int((self.lengths + 1).sum()), -np.inf)
        left = self.lengths[self.word] - self.start
        place, come, go = (left, self.target, self.source) if backward else (self.end, self.source, self.target)
        state[self.base + self.lengths if backward else self.base] = 0
        order = np.argsort(place.astype(np.uint16) if place.max(initial=0) < 65_536 else place, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            if not len(at):
                continue
            word = self.word[at]
            x = state[come[at]] + weight[at]
            size = int(word.max()) + 1
            top = np.full(size, -np.inf)
            np.maximum.at(top, word, x)
            top[~np.isfinite(top)] = 0.0
            total = np.bincount(word, np.exp(x - top[word]), size)
            here = np.full(size, -1)
            here[word] = go[at]
            reached = np.flatnonzero(here >= 0)
            with np.errstate(divide="ignore"):
                state[here[reached]] = np.log(total[reached]) + top[reached]
        return state

    def last(self, state: np.ndarray) -> np.ndarray:
        return state[self.base + self.lengths]


def word_of(word: bytes) -> str:
    return START + word.decode("utf-8", "replace")
