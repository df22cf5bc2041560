"""Token ids in Arrow stream files of fixed-size-list batches.

The ids of all documents, each ended by id 0, form one long sequence in
ascending order of the key. A file holds a run of whole documents, cut into
rows of equal length: a fixed-size list of ids and one of mask bits, false where
the last row is filled up. Row k of a mapped file is at a known offset and is
read without copying. The schema's metadata name the file's place in the
sequence and its documents with their lengths.

Spark's text writer puts the files down, one value per file, so that they reach
any store that Spark reaches and appear only when their task has committed: the
last byte of a stream, a zero, is what the writer adds as line separator.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import bytes_of, stage
from tapeloom.sources.staging import shared_dir

END = 0


def tokenizer_json(path: str | None = None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


#: classes of bytes: what may be anything, white space, letters, digits, other signs, the apostrophe
ANY, SPACE, LETTER, DIGIT, SIGN, QUOTE = range(6)


def _classes() -> np.ndarray:
    out = np.full(256, ANY, np.uint8)
    out[0x21:0x7F] = SIGN
    for kind, chars in ((SPACE, b" \t\n\v\f\r"), (DIGIT, b"0123456789"), (QUOTE, b"'"),
                        (LETTER, bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)]))):
        out[list(chars)] = kind
    return out


def _pairs() -> np.ndarray:
    """Whether a unit of the byte-level pre-tokenizer always ends between two classes."""
    out = np.zeros((6, 6), bool)
    out[LETTER, [SPACE, DIGIT, SIGN, QUOTE]] = out[DIGIT, [SPACE, LETTER, SIGN, QUOTE]] = True
    out[SIGN, [SPACE, LETTER, DIGIT]] = out[QUOTE, [SPACE, DIGIT]] = True  # an apostrophe may take letters along
    return out.ravel()


def _byte_letters() -> dict[int, int]:
    """The character by which a byte-level vocabulary writes each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in set(plain))}


def is_byte_level(definition: dict) -> bool:
    """Whether ids of a text are those of its stretches: the usual byte-level pattern and nothing that looks beyond a unit."""
    before = definition.get("pre_tokenizer") or {}
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        and not definition.get("normalizer") and not definition.get("truncation") and not definition.get("padding")
        and not any(t.get(k) for t in definition.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")))


class Encoder:
    """Encodes whole texts, remembering the ids of the stretches between sure ends of the pre-tokenizer's units.

    A unit of the byte-level pre-tokenizer is white space with a run of letters,
    of digits or of other signs behind it, and nothing in a unit depends on what
    stands beyond it. So the ids of a text are those of its stretches in turn,
    wherever these begin between a character that is no white space and one of
    another class. Characters whose class is not plain stay joined to their
    neighbours, and special tokens stay whole. Other pre-tokenizers get whole texts.
    """

    LETTERS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1)  # first bytes of letters, but for U+00D7 and U+00F7
    #: stretches that are one unit
    UNIT = re.compile(rb" ?(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4\xC5\xD0\xD1][\x80-\xBF])+|[0-9]+|[!-&(-/:-@[-`{-~]+)")

    def __init__(self, definition: str, at_once: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel units
        from tokenizers import Tokenizer

        told = json.loads(definition)
        self.tokenizer, self.at_once = Tokenizer.from_str(definition), at_once
        self.cuts, self.special = is_byte_level(told), [t["content"].encode() for t in told.get("added_tokens", [])]
        self.classes, self.pairs, self.model = _classes(), _pairs(), self.tokenizer.model
        self.letters = _byte_letters()
        self.inside = [t for t in self.special if self.UNIT.fullmatch(t) or self.UNIT.fullmatch(t + b"a")]  # may be part of a unit
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0  # bytes of the stretches
        self.starts, self.ids = array("q", [0, 1]), array("I", [END])  # the first entry is the end of a document

    def begins(self, data: bytes) -> np.ndarray:
        """Whether a stretch begins, for every byte of ``data``."""
        raw = np.frombuffer(data, np.uint8)
        out = np.zeros(len(raw), bool)
        if not self.cuts or len(raw) < 2:
            return out
        kind = self.classes[raw]
        first = np.flatnonzero(np.isin(raw[:-1], self.LETTERS))
        first = first[(raw[first] != 0xC3) | ((raw[first + 1] != 0x97) & (raw[first + 1] != 0xB7))]
        kind[first] = kind[first + 1] = LETTER
        out[1:] = self.pairs[kind[:-1] * np.uint8(6) + kind[1:]]
        # a space behind another character beyond ASCII, unless that is white space itself
        at = np.flatnonzero((kind[1:] == SPACE) & (kind[:-1] == ANY) & (raw[:-1] >= 0x80)) + 1
        one, two, three = raw[at - 1], raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 3, 0)]
        blank = (two == 0xC2) | ((three == 0xE2) & (two == 0x80) & ((one < 0x90) | (one >= 0xA8) & (one < 0xB0))) | (
            (three == 0xE2) & (two == 0x81)) | ((three == 0xE3) & (two == 0x80)) | ((three == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
        out[at[~blank]] = True
        for token in self.special:
            place = data.find(token) if token else -1
            while place >= 0:
                out[place + 1:place + len(token)] = False
                place = data.find(token, place + 1)
        return out

    def _entries(self, units: pa.Array) -> np.ndarray:
        """Entries of the stretches, which are encoded where they are new."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [u for u in distinct if u not in self.known]
        if len(self.known) + len(new) > self.at_once or self.held + sum(map(len, new)) > 64 * self.at_once:  # go on with those in use
            starts, ids, kept = self.starts, self.ids, [(u, self.known[u]) for u in distinct if u in self.known]
            self._forget()
            for u, at in kept:
                self._add(u, ids[starts[at]:starts[at + 1]])
        mixed, one = [], self.UNIT.fullmatch
        for u in new:
            if self.cuts and one(u) and not (self.inside and any(t in u for t in self.inside)):
                # one unit: the model's part of the work is all there is
                word = u.decode().replace(" ", "\u0120") if u.isascii() else u.decode("latin-1").translate(self.letters)
                self._add(u, [t.id for t in self.model.tokenize(word)])
            else:
                mixed.append(u)
        for lo in range(0, len(mixed), 5_000):
            part = mixed[lo:lo + 5_000]
            for u, e in zip(part, self.tokenizer.encode_batch_fast([u.decode() for u in part], add_special_tokens=False)):
                self._add(u, e.ids)
        entries = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return entries[coded.indices.to_numpy()]

    def _add(self, unit: bytes, ids) -> None:
        self.known[unit] = len(self.starts) - 1
        self.held += len(unit)
        self.ids.extend(ids)
        self.starts.append(len(self.ids))

    def encode(self, texts: list[str], units: int = 500_000) -> list[np.ndarray]:
        """The ids of each text and the end id; ``units`` stretches are looked up at once."""
        raw = [t.encode() for t in texts]
        data, ends = b"".join(raw), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        begin = self.begins(data)
        begin[(ends - np.fromiter(map(len, raw), np.int64, len(raw)))[[len(r) > 0 for r in raw]]] = True
        place = np.append(np.flatnonzero(begin), len(data))
        ended = np.searchsorted(place[:-1], ends)  # stretches before the end of each text
        got, sizes = [], []
        for lo in range(0, len(place) - 1, units):
            bounds = place[lo:lo + units + 1]
            part = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data)])
            at = self._entries(part)
            starts = np.array(self.starts, np.int64)
            size = starts[at + 1] - starts[at]
            stop = np.cumsum(size)
            got.append(np.array(self.ids, np.uint32)[np.arange(stop[-1]) + np.repeat(starts[at] - (stop - size), size)])
            sizes.append(size)
        before = np.append(0, np.cumsum(np.concatenate(sizes) if sizes else np.zeros(0, np.int64)))
        flat = np.concatenate(got) if got else np.zeros(0, np.uint32)
        stops = before[ended]
        flat = np.insert(flat, stops, np.uint32(END))
        return np.split(flat, (stops + np.arange(1, len(stops) + 1))[:-1]) if len(stops) else []


def stream(ids: np.ndarray, width: int, marks: dict[str, bytes]) -> bytes:
    """An Arrow stream of ``ids`` in rows of ``width``."""
    rows = -(-len(ids) // width)
    values = np.zeros(rows * width, ids.dtype)
    values[:len(ids)] = ids
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(values), width),
        pa.FixedSizeListArray.from_arrays(pa.array(np.arange(rows * width) < len(ids)), width),
    ]
    schema = pa.schema([("ids", columns[0].type), ("mask", columns[1].type)], metadata=marks)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.record_batch(columns, schema=schema))
    return sink.getvalue().to_pybytes()


def open_file(source: bytes | str) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(rows of ids, rows of mask bits, doc_ids and lengths of the documents) of a file's content or of a file mapped by its path.

    The ids are a view of the mapped memory.
    """
    reader = pa.ipc.open_stream(pa.memory_map(source) if isinstance(source, str) else source)
    batch = reader.read_next_batch()
    marks = reader.schema.metadata
    width = batch.schema.field("ids").type.list_size
    ids = batch.column("ids").flatten().to_numpy().reshape(-1, width)
    mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    documents = {k: np.frombuffer(marks[k.encode()], "<i8") for k in ("doc_ids", "without_id", "lengths", "place")}
    return ids, mask, documents


def write(docs: DataFrame, path: str, *, tokenizer: str | None = None, width: int = 2048,
          file_ids: int = 2_000_000) -> None:
    """Write the ids of all texts below ``path``, in files of whole documents of about ``file_ids`` ids."""
    definition = tokenizer_json(tokenizer)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Encoder(definition)
        kind = np.uint16 if coder.tokenizer.get_vocab_size() <= 65_536 else np.uint32
        part, number, held, keys, bare, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def file():
            marks = {
                "place": np.array([part, number], "<i8").tobytes(),
                "doc_ids": np.array(keys, "<i8").tobytes(),
                "without_id": np.array(bare, "<i8").tobytes(),
                "lengths": np.array(list(map(len, held)), "<i8").tobytes(),
            }
            return pd.DataFrame({"content": [stream(np.concatenate(held), width, marks)[:-1]]})

        for b in batches:
            for key, none, ids in zip(b["doc_id"], b["none"], coder.encode([t.decode("utf-8", "replace") for t in b["text"]])):
                keys.append(key)
                bare.append(none)
                held.append(ids.astype(kind))
                size += len(ids)
                if size >= file_ids:
                    yield file()
                    number, held, keys, bare, size = number + 1, [], [], [], 0
        if held:
            yield file()

    text = bytes_of(F.col("text"))
    key = F.col("doc_id").cast("long")
    ordered = docs.select(key.alias("id"), text.alias("text"), F.xxhash64(text).alias("h")).repartitionByRange(
        "id", "h").sortWithinPartitions("id", "h")  # nulls come first
    ordered.select(F.coalesce("id", F.lit(0)).alias("doc_id"), F.col("id").isNull().cast("long").alias("none"), "text").mapInPandas(rows, "content binary").select(
        F.col("content").cast("string").alias("value")).write.option("lineSep", "\u0000").option(
        "maxRecordsPerFile", 1).text(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files below ``path``."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                ids, mask, marks = open_file(bytes(content))
                flat = ids.ravel()[mask.ravel()]
                ends = np.cumsum(marks["lengths"])
                starts = ends - marks["lengths"]
                yield pd.DataFrame({
                    "part": marks["place"][0], "number": marks["place"][1], "doc_id": marks["doc_ids"], "none": marks["without_id"],
                    "before": starts, "n_tokens": marks["lengths"],
                    "ids_crc32": [zlib.crc32(flat[a:e].astype("<u4").tobytes()) for a, e in zip(starts, ends)],
                })

    files = spark.read.format("binaryFile").load(path)
    found = files.select("content").mapInPandas(
        rows, "part long, number long, doc_id long, none long, before long, n_tokens long, ids_crc32 long")
    return placed(found.withColumn("doc_id", F.when(F.col("none") == 0, F.col("doc_id"))).drop("none"))


def placed(found: DataFrame) -> DataFrame:
    """Adds the ids of earlier parts and files to the places inside files; only a row per part meets in one task."""
    found = stage(found, "token-places")
    files = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before.orderBy("part")), none).alias("part_start"))
    starts = files.select(
        "part", "number", F.coalesce(F.sum("n").over(before.partitionBy("part").orderBy("number")), none).alias("file_start"))
    return found.join(starts, ["part", "number"]).join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, **more) -> DataFrame:
    """Write all texts to ``path`` (by default a new folder in the shared one) and return what is read back.

    Null and empty texts have their end id alone. Repeated rows are repeated in
    the files, in the order of a hash of their text. Rows without a key come
    first, in the same order. An empty table gives no row; other columns,
    whatever their names, are ignored.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write(docs, path, **more)
    return read_back(spark, path)
