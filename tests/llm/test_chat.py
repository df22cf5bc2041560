"""Chat formatting: round trips of typed parts, masks, and the query against its contract."""

import hashlib

import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm import chat
from tapeloom.llm.common import read
from tapeloom.llm.queries import SQL, op13_chat

from .conftest import CLASHES, SF

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("content", T.ArrayType(chat.PART)),
])
ODD = ["", "plain", "<|im_end|>", "<\\|im_end|>", "<\\\\|", "<", "|", "a<", "|b", "<|image:0|>", "<|text|>", "\n", "é日本<|", None]


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_parts_come_back(spark):
    contents = [[part("text", a), part(None, b)] for a in ODD for b in ODD]
    contents += [[part("image", ref="i.png", width=100, height=29), part("text", a), part("audio", ref="s", seconds=1.01),
                  part("document", ref="d", pages=3), part("video", ref="v"), part("text", "end")] for a in ODD if a]
    contents += [[], None, [None, part("text", "x")]]
    roles = ["assistant", "user", "a\nb%0A%", "<|im_start|>", None]
    rows = [(i, j, roles[(i + j) % 5], c) for i, c in enumerate(contents) for j in range(2)]
    df = spark.createDataFrame(rows, TURNS)
    for (_, _, role, content), r in zip(rows, sorted(chat.format_turns(df, F.col("content")).collect(), key=lambda r: (r["conv_id"], r["turn"]))):
        given = [p for p in content or [] if p is not None]
        plain = lambda p: p[0] in (None, "text")
        want = [("text", p[1] or "") if plain(p) else (p[0] if p[0] != "video" else "file", str(i)) for i, p in enumerate(given)]
        assert chat.read_turn(r["formatted"]) == (role or "", want or [("text", "")])
        runs = [x.asDict() for x in r["runs"]]
        assert sum(x["chars"] for x in runs) == len(r["formatted"]) == r["formatted_chars"]
        learned = [p[1] for p in given if plain(p) and p[1]] if role == "assistant" else []
        assert [t for t in chat.read_loss(r["formatted"], runs) if t] == learned
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == 1
        assert [(a["type"], a["ref"]) for a in r["attachments"]] == [
            (p[0] if p[0] != "video" else "file", p[2]) for p in given if not plain(p)]
        tokens = {"image": 4 * 2, "audio": 26, "document": 3 * 512, "video": 0}
        assert r["expanded_tokens"] == sum(tokens.get(p[0], 0) for p in given)


@given(st.text("<|\\>a\n%:", max_size=12), st.text("<|\\>a\n%0A", max_size=8))
@limits(max_examples=300, deadline=None)
def test_escapes_are_reversible(text, role):
    import re

    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    line = re.sub(r"<(\\*)\|", r"<\\\1|", role).replace("%", "%25").replace("\n", "%0A")
    assert "<|" not in escaped
    assert chat.read_turn(f"<|im_start|>{line}\n{escaped}<|im_end|>\n") == (role, [("text", text)])


def test_own_sizes(spark):
    with pytest.raises(ValueError):
        chat.Visitor({"text": lambda p: F.lit(1)})
    df = spark.createDataFrame([(1, 0, "user", [part("video", seconds=2.0), part("image")])], TURNS)
    row = chat.format_turns(df, F.col("content"), chat.Visitor({"video": lambda p: F.ceil(p["seconds"] * 10)})).first()
    assert row["formatted"] == "<|im_start|>user\n<|video:0|><|file:1|><|im_end|>\n" and row["expanded_tokens"] == 20


def want(rows):
    out = {}
    for key in {r[0] for r in rows}:
        turns = [(t, role or "", text or "") for c, t, role, text in rows if c == key]
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        learned = "".join(x for _, role, x in turns if role == "assistant")
        out[key] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learned), sha(learned))
    return out


def test_query(spark, con):
    got = {r["conv_id"]: tuple(r)[1:5] for r in op13_chat(spark, SF).collect()}
    rows = [tuple(r) for r in read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.FORGED), (-1, 1, "assistant", chat.FORGED)]
    assert got == want(rows)
    theirs = con.sql(f"SELECT * FROM ({SQL['op13_chat']}) ORDER BY conv_id").fetchall()
    ours = sorted(map(tuple, op13_chat(spark, SF).select(*con.sql(SQL["op13_chat"]).columns).collect()))
    assert ours == theirs


def test_edges(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x" * 300_000), (3, None, "user", "first"), (3, 0, "assistant", "<|"),
            (4, 0, "assistant", "b"), (4, 0, "assistant", "b"), (5, 2, "assistant", "日本語 😀"), (5, 1, "", "\n\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *[F.lit("clash").alias(c) for c in (*CLASHES, "formatted", "runs", "parts", "written", "attachments")])
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversations(df).collect()}
    assert got == want(rows + [(-1, 0, "user", chat.FORGED), (-1, 1, "assistant", chat.FORGED)])
    assert [r["conv_id"] for r in chat.conversations(df.limit(0)).collect()] == [-1]
    assert chat.digests(chat.format_turns(df.limit(0))).collect() == []
