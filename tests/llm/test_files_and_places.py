"""Token files, packing and page texts."""

import itertools
import json
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapeloom.llm import html_text, packing, token_file

from .conftest import EDGES, documents


def plain_tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@given(st.text(" \t\n aé's1.<|endoftext|>　", max_size=30))
@limits(max_examples=150, deadline=None)
def test_stretches_encode_like_whole_texts(text):
    assert ENCODER.encode([text])[0].tolist() == PLAIN.encode(text, add_special_tokens=False).ids + [0]


ENCODER, PLAIN = token_file.Encoder(token_file.tokenizer_json(), at_once=40), plain_tokenizer()


@given(st.lists(st.text(" \t\n\r'’“aZéñßÀ×÷ЖёΩ·日。1٣²½.,-_<|>\x00\x1c\x7f\x85\xa0\u0301\u1680\u180e\u2003\u200b\u2028\u202f\u205f\u3000\ufeff😀st", max_size=40), max_size=4))
@limits(max_examples=400, deadline=None)
def test_cuts_between_classes(texts):
    texts = [*texts, "it's don't '' 'll x''s <|endoftext|>s <|endoftext|>  é", "".join(texts)]
    for ids, text in zip(ENCODER.encode(texts, units=7), texts, strict=True):
        assert ids.tolist() == USUAL.encode(text, add_special_tokens=False).ids + [0]


USUAL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_words_are_encoded_once_whatever_stands_behind_them():
    coder = token_file.Encoder(token_file.tokenizer_json())
    text = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}é{end}" for end in ".,;:!?)-\"#%&*+/=" for i in range(100))
    assert coder.encode([text])[0].tolist() == USUAL.encode(text, add_special_tokens=False).ids + [0]
    assert len(coder.known) < 150  # 1,600 when a word and the sign behind it were one stretch


def test_other_pre_tokenizers_get_whole_texts():
    told = json.loads(token_file.tokenizer_json())
    told["pre_tokenizer"]["add_prefix_space"] = True
    plain, text = Tokenizer.from_str(json.dumps(told)), "one two, three"
    assert token_file.Encoder(json.dumps(told)).encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids + [0]


def want(rows):
    out, start = [], 0
    for key, text in rows:
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files(spark, edges, nothing, tmp_path):
    docs = documents(spark)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    path = str(tmp_path / "ids")
    got = token_file.token_files(docs, path, width=64, file_ids=5_000).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want(rows)
    files = sorted((tmp_path / "ids").glob("part-*"))
    assert len(files) > 10
    ids, mask, marks = token_file.open_file(str(files[3]))
    assert ids.shape[1] == 64 and not ids.flags.owndata and mask.sum() == marks["lengths"].sum()
    text = dict(rows)[int(marks["doc_ids"][0])]
    assert ids.ravel()[:marks["lengths"][0] - 1].tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    some = sorted({e[:2] for e in EDGES if e[0] != 7}, key=lambda e: -10**9 if e[0] is None else e[0])
    got = token_file.token_files(edges.where("doc_id is null or doc_id <> 7")).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want(some)
    assert token_file.token_files(edges.where("doc_id = 7")).count() == 2
    assert token_file.token_files(nothing).collect() == []


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
@limits(max_examples=100, deadline=None)
def test_borders_pad_least(counts, buckets):
    lengths = sorted(counts)

    def cost(cuts):
        return sum(n * (min(c for c in cuts if c >= size) - size) for size, n in counts.items())

    got = packing.borders(lengths, [counts[x] for x in lengths], buckets)
    k = min(buckets, len(lengths))
    best = min(cost([*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], k - 1))
    assert len(got) == k and cost(got) == best


def test_packing(spark, edges, nothing):
    got = packing.pack(edges, max_length=100, buckets=3, budget=400).toPandas()
    words = {e[0]: len((e[1] or "").encode().split()) + 1 for e in EDGES}
    assert got[got["doc_id"] != 7].groupby("doc_id")["n_tokens"].sum().to_dict() == {
        k: v for k, v in words.items() if k is not None and k != 7}
    assert (got["n_tokens"] <= got["width"]).all() and got["width"].nunique() == 3
    assert not got.duplicated(["bucket", "batch", "slot"]).any()
    assert (got.groupby(["bucket", "batch"])["width"].sum() <= 400).all()
    for _, b in got.groupby("bucket"):  # only the last batch has room left
        full = max(1, 400 // b["width"].iloc[0])
        assert (b.groupby("batch").size().sort_index().iloc[:-1] == full).all()
    assert packing.pack(nothing).collect() == []
    from pyspark.sql import functions as F

    assert packing.pack(edges, F.col("n_chars"), max_length=5_000_000).where("doc_id = 2").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><div class="cookieNotice">We use</div>
<article><h1>Ti&am &amp; x</h1><p><b>First<br>one<p>Second &lt;x&gt;  a
 b</p><ul><li>one<li>two</ul><div class="share-buttons">Tweet</div><aside>side</aside>tail <i>it</i>al</article>
<section id="comments"><article class="comment"><p>reader</p></article></section><footer>&copy; x</footer>"""


def test_page_text():
    assert html_text.page_text(PAGE) == "Ti&am & x\n\nFirst one\n\nSecond <x> a b\n\none\n\ntwo\n\ntail ital"
    assert html_text.page_text("plain < 3 text <b>x") == "plain < 3 text x"
    assert html_text.page_text("<p>" * 3_000 + "deep" + "<b>" * 3_000) == "deep"


def test_template_of_a_host(spark):
    bodies = [f"<div class='x1'>Read us daily</div><div class='x2'><a href='/{i}'>Topic {i}</a></div><div class='x3'><p>Story {i} "
              f"tells of {i * 7} things</p><p>More of {i}</p></div><div class='x4'>All rights</div>" for i in range(30)]
    pages = [(i, f"https://h.example/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    pages += [(100, "https://one.example/", "<p>alone</p>"), (101, None, None), (102, "odd", ""), (103, None, "<p>no url</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS token", "3 AS n")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got[3] == "Story 3 tells of 21 things\n\nMore of 3"
    assert got[100] == "alone" and got[101] == "" and got[102] == "" and got[103] == "no url"
    assert html_text.main_text(df.limit(0)).collect() == []
    assert html_text.main_text(df.union(df)).count() == 2 * len(pages)


def test_template_inside_articles(spark):
    pages = [(i, f"https://h.example/{i}", f"<html><body><article><h1>Story {i}</h1><div class='x1'>Tell your friends</div><p>Told of "
              f"{i * 7} things</p>{"<div class='x3'>Read on</div>" if i % 3 else '<p>The end</p>'}<div class='x2'><a href='/{i}'>Next {i}</a></div></article></body></html>")
             for i in range(30)]
    pages += [(100 + i, f"https://few.example/{i}", f"<article><p>Said twice</p><p>Only {i}</p></article>") for i in range(4)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got[4] == "Story 4\n\nTold of 28 things"
    assert got[3] == "Story 3\n\nTold of 21 things\n\nThe end"
    assert got[101] == "Said twice\n\nOnly 1"
    assert html_text.page_text(pages[4][2]) == "Story 4\n\nTell your friends\n\nTold of 28 things\n\nRead on\n\nNext 4"


def test_end_mark_in_a_text(spark):
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "a<|endoftext|>b  c", "<|endoftext|>", "x <|endoftext|>\n y"]
    assert [x.tolist() for x in token_file.Encoder(token_file.tokenizer_json()).encode(texts)] == [
        default.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert default.token_to_id("<|endoftext|>") in default.encode(texts[0], add_special_tokens=False).ids
    got = token_file.token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [len(default.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
