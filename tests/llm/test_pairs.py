"""Near duplicates, contamination and fingerprints against brute force."""

import hashlib
import struct

import numpy as np
import pytest
import xxhash

from tapeloom.llm import decontam, fingerprints, near_dups
from tapeloom.plans.compare import duck, rows_of
from tapeloom.llm.queries import SQL, QUERIES

from .conftest import COPY, EDGES, documents

SF = "/root/testdata/sf0.01"


def linked(rows, size, percent):
    """component of every row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    head = list(range(len(rows)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                head[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return sorted((key, len(s), min(groups[find(i)])) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None)


@pytest.fixture(scope="module")
def chains(spark):
    """Copies that drift: neighbours are alike, the ends are not; and many texts around one passage."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows, text = [], [words[i] for i in rng.integers(0, 400, 120)]
    for i in range(40):
        rows.append((1000 - i, " ".join(text)))
        text = list(text)
        text[int(rng.integers(0, 120))] = words[int(rng.integers(0, 400))]
    passage = [words[i] for i in rng.integers(0, 400, 50)]
    for i in range(60):
        rows.append((i, " ".join(passage + [words[j] for j in rng.integers(0, 400, 20)])))
    return rows


@pytest.mark.parametrize("full", [5_000, 1])
def test_components(spark, chains, full):
    df = spark.createDataFrame(chains, "doc_id long, text string")
    assert result(near_dups.near_duplicates(df, shingle=4, full=full)) == linked(chains, 4, 80)


def test_edges(edges, nothing):
    got = result(near_dups.near_duplicates(edges, shingle=4))
    assert got == linked([e[:2] for e in EDGES if e[0] is not None], 4, 80)
    assert near_dups.near_duplicates(nothing).collect() == []
    rows = near_dups.deduplicated(edges).collect()
    kept = [r["doc_id"] for r in rows]
    # copies leave one row, texts without shingles stay, and so does the text without a key
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 9, 11, 12, 13, 14, -5, None], key=str)
    assert rows[0].asDict().keys() == edges.limit(1).collect()[0].asDict().keys()
    assert near_dups.deduplicated(nothing).collect() == []


def test_estimate_is_near_the_truth():
    functions = near_dups.seeds()
    rng = np.random.default_rng(1)
    for same in (20, 60, 100):
        grams = np.unique(rng.integers(0, 2**63, 500 - same, np.uint64))
        a, b = np.append(grams[:same * 2], grams[same * 2::2]), np.append(grams[:same * 2], grams[same * 2 + 1::2])
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = near_dups.minima(a, functions), near_dups.minima(b, functions)
        agree = np.mean((x & 3) == (y & 3))
        assert abs((agree - 0.25) / 0.75 - truth) < 0.16
        assert abs(np.mean(x == y) - truth) < 0.13


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    got, want = rows_of(QUERIES[name](spark, SF).toArrow()), rows_of(duck(SF).sql(SQL[name]).to_arrow_table())
    assert got[0] == want[0] and got[2] == want[2]


def test_contamination(spark, edges, nothing):
    items = spark.createDataFrame(
        [(1, COPY), (2, "The answer to the riddle is plain. Seven grey birds"), (3, None), (4, ""), (5, "one two"),
         (6, "a passage that no document of this small table holds in any form at all. None")],
        "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS answer_", "'x' AS cosine")
    rows = [(1, COPY), (2, "before " * 50 + COPY.upper() + " after" * 70), (3, None), (4, "x one two y"), (5, "two one"),
            (6, " ".join(COPY.split()[::2])), (None, COPY)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS covered")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 1), (4, 5)}
    blocks = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df.union(df), items.union(items), block=2, terms=5).collect()}
    assert blocks == got
    paraphrase = [(1, "when the old king left his quiet town he gave all gold to a boy. the boy was Ludo")]
    text = "long ago the old king left the town and gave much gold to a young boy and the boy was Ludo they say"
    asked = spark.createDataFrame(paraphrase, "item_id long, text string")
    told = spark.createDataFrame([(1, text), (2, text.replace("Ludo", "Remo"))], "doc_id long, text string")
    assert [(r["doc_id"], r["answered"]) for r in decontam.contaminated(told, asked).collect()] == [(1, True)]
    assert decontam.contaminated(nothing, items).collect() == []
    assert decontam.contaminated(df, items.limit(0)).collect() == []
    assert decontam.contaminated(edges, items).where("doc_id = 4").count() == 0


def test_contamination_against_all_pairs(spark):
    docs = documents(spark, SF).toPandas()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    grams = lambda w: {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    held = [(d.doc_id, grams(decontam.tidy((d.text or "").encode()))) for d in docs.itertuples()]
    want = set()
    for i in items.itertuples():
        g = grams(decontam.tidy(i.text.encode()))
        want |= {(key, i.item_id) for key, x in held if len(x & g) > 0.6 * len(g)}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontam"](spark, SF).collect()}
    assert got == want


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [0] * len(b) if False else _next(row, x, b)
        return row[-1]

    def _next(row, x, b):
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(out[-1], row[j + 1]))
        return out

    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (list(map(str, rng.integers(0, 4, rng.integers(0, 20)))) for _ in range(2))
        assert decontam.common_subsequence(a, b) == plain(a, b)


def by_hand(text, k=2):
    """The fingerprint of a text, step by step."""
    mask = (1 << fingerprints.PLACE) - 1
    top = lambda x: x & ~mask & (2**64 - 1)

    def chain(*parts):
        seed = 42
        for p in parts:
            if p is not None:
                raw = p.encode() if isinstance(p, str) else struct.pack("<Q" if p[1] == 8 else "<I", p[0])
                seed = xxhash.xxh64_intdigest(raw, seed)
        return seed

    words = [w for w in "".join(" " if c in " \t\n\r\x0b\f" else c for c in text).split(" ") if w]
    if not words:
        return ""
    seen, numbered = {}, []
    for i in range(max(len(words) - k, 0) + 1):
        h = top(chain(*[words[i + j] if i + j < len(words) else None for j in range(k)]))
        numbered.append((top(chain((h, 8), (seen.get(h, 0), 4))), i))
        seen[h] = seen.get(h, 0) + 1
    out = []
    signed = lambda x: x - 2**64 if x >> 63 else x
    for sketch in range(64):
        chosen = []
        for cell in (2 * sketch, 2 * sketch + 1):
            inside = [x for x in numbered if x[0] >> 57 == cell]
            if inside:
                chosen.append(min(inside, key=lambda x: signed(x[0])))
        if chosen:
            h = chain(*[(x[0], 8) for x in sorted(chosen, key=lambda x: x[1])])
            out.append((sketch, ((h >> 32) & 0xFFFFFFC0) | sketch))
    order = sorted(out, key=lambda x: x[0] if x[0] < 32 else x[0] - 64)
    return "".join(f"{x:08x}" for _, x in order)


def test_fingerprints(spark, edges, nothing):
    got = fingerprints.fingerprints(edges).collect()
    assert len(got) == len(EDGES)
    text = {}
    for e in EDGES:
        text.setdefault(e[0], e[1] or "")
    order = sorted(k for k in text if k is not None)
    for r in got:
        own = text[r["doc_id"]]
        after = order[0] if r["doc_id"] is None else order[(order.index(r["doc_id"]) + 1) % len(order)]
        half = len(own) // 2
        edited = own[:len(own) - half] + text[after][:half]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == by_hand(own) and r["edited_fingerprint"] == by_hand(edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    near = {r["doc_id"]: r["near_next"] for r in got}
    assert near[5] == 1.0 and near[1] == 1.0 and near[3] == 0.0
    assert fingerprints.fingerprints(nothing).collect() == []


def test_far_apart_ids(spark):
    ids = [-2**62, -7, 0, 1, 4095, 4096, 2**24, 2**40 + 3, 2**62]
    got = {r["id"]: r["next_id"] for r in fingerprints.following(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert got == dict(zip(ids, ids[1:] + [None]))


def test_order_counts(spark):
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(swapped)), (3, " ".join(words[:140] + ["new"] + words[140:]))],
                               "doc_id long, text string")
    got = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprints(df).collect()}
    assert got[3] > 0.8 and got[1] < 0.85 and got[2] < 0.85


def test_copies_of_short_items_at_any_size(spark):
    words = [f"c{j}" for j in range(15)]
    rows = [(i, " ".join([w for j, w in enumerate(words) if (i * 7 + j * 3) % 11 == 0] + [f"x{i}y{k}" for k in range(40)])) for i in range(4_000)]
    rows += [(9_001, " ".join(words + [f"z{k}" for k in range(49)])), (9_002, " ".join(words) + " zebra" * 49)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a zebra and eight other rare words are in this one")], "item_id long, text string")
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(9_001, 1), (9_002, 1)}
    assert all(r["cosine"] > 0.99 for r in got)


def test_excerpts_across_passages_of_a_long_item(spark):
    words = [f"v{i}" for i in range(400)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    cuts = [(start, size) for start in range(100, 164, 3) for size in (45, 52, 60, 88)]
    rows = [(k, " ".join([f"p{k}q{i}" for i in range(k % 70)] + words[a:a + n] + [f"r{k}s{i}" for i in range(50)])) for k, (a, n) in enumerate(cuts)]
    rows += [(1_000, " ".join(words[120:150]))]
    got = {r["doc_id"] for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == set(range(len(cuts)))
    assert decontam.pieces_of([(1, b"", None), (2, b"one two", None)]).words == [["one", "two"]]
    long = decontam.pieces_of([(1, " ".join(words).encode(), None)])
    assert set().union(*long.words) == set(words) and {len(w) for w in long.words} == {decontam.PASSAGE}


def test_items_without_ids(spark):
    texts = [f"item number {i} asks for alpha{i} and beta{i} or gamma{i} and delta{i}" for i in range(230)]
    items = spark.createDataFrame([(None, t) for t in texts] + [(7, "seven old men sat by the cold sea and sang low")], "item_id long, text string")
    docs = spark.createDataFrame([(i, texts[i]) for i in (0, 100, 229)] + [(900, "seven old men sat by the cold sea and sang low")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items, block=200).collect()}
    assert got == {(0, None), (100, None), (229, None), (900, 7)}


def test_passages_of_a_batch_of_texts():
    from collections import Counter

    rng = np.random.default_rng(4)
    signs = list(" \n\t\x1c\x85\xa0\u3000.,«»“”‘…\"'ÉßaéΣİ日|") + ["de", " la ", " é", " que", " ß "]
    texts = [b"", b" ... ", b"\xff\xfe a \xc3"] + ["".join(rng.choice(signs, rng.integers(0, 900))).encode() for _ in range(60)]
    index = {w: i for i, w in enumerate(["de", "la", "que", "é", "ß", "a", "日", "aé"])}
    ids, sizes = decontam._Numbers(index).of(texts)
    passage, term, times, offsets = decontam.term_rows(ids, sizes, len(index))
    got = Counter(dict(zip(zip(passage.tolist(), term.tolist()), times.tolist())))
    want, at = Counter(), 0
    for text, size, first in zip(texts, sizes, offsets):
        words = decontam.tidy(text)
        assert (len(words), at) == (size, first)
        last = max(-(-(len(words) - decontam.PASSAGE) // decontam.STRIDE), 0) if words else -1
        for k in range(last + 1):
            lo = k * decontam.STRIDE
            want.update((at + k, index[w]) for w in words[lo:lo + decontam.PASSAGE] if w in index)
        at += last + 1
    assert got == want and offsets[-1] == at and len(set(sizes)) > 20
    first = np.flatnonzero(np.append(True, np.diff(passage) > 0))
    size, v, dense = np.diff(np.append(first, len(passage))), times.astype(np.float32), np.zeros((at, len(index)), np.float32)
    dense[passage, term] = v
    for at_once in (7, 1_000_000):
        sums = np.zeros((len(index), len(index)), np.float32)
        decontam._products(sums, term, v, first, size, at_once)
        assert np.allclose(sums, np.triu(dense.T @ dense))
