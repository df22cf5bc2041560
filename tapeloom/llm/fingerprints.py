"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are runs of words, numbered by occurrence so that repeated ones
differ. One hash deals the numbered k-mers to the sketches and their two cells,
and each cell selects its minimal one. A sketch retains the selected k-mers in
the order of the text and hashes that tuple, so both changed k-mers and a
changed order change it, as an edit distance does. The fingerprint is the row of
tuple hashes, and likeness the share of sketches that agree.

All work is on arrays inside a row: hashes and positions are packed into one
long, so that sorting an array of longs groups equal k-mers in text order, and a
second sort brings the minimum of every cell to its front.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.common import stage

#: sketches, as a power of two; every sketch has two cells
SKETCH_BITS = 6
KMER = 2
#: bits of a packed long that hold a word's position
PLACE = 24
_PLACES = (1 << PLACE) - 1
_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _hash(x: Column) -> Column:
    return x.bitwiseAND(F.lit(~_PLACES))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACES))


def _starts(values: Column, of: Callable[[Column], Column]) -> Column:
    """Places in a non-empty sorted array at which ``of`` changes."""
    return F.filter(F.sequence(F.lit(0), F.size(values) - 1),
                    lambda i: (i == 0) | (of(F.get(values, i)) != of(F.get(values, i - 1))))


def _kmers(words: Column, k: int) -> Column:
    """Packed (hash, position) of every run of ``k`` words, sorted; fewer words are one run."""

    def packed(i):
        run = F.xxhash64(*[F.get(words, i + j) for j in range(k)])
        return _hash(run).bitwiseOR(F.least(i, F.lit(_PLACES)).cast("long"))

    return F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0))), packed))


def _numbered(kmers: Column) -> Column:
    """Packed (hash of k-mer and occurrence number, position), sorted."""

    def one(x, o):
        return _hash(F.xxhash64(_hash(x), o)).bitwiseOR(_place(x))

    def runs(starts):
        size = lambda a, r: F.coalesce(F.get(starts, r + 1), F.size(kmers)) - a
        return F.flatten(F.transform(starts, lambda a, r: F.transform(
            F.sequence(F.lit(0), size(a, r) - 1), lambda o: one(F.get(kmers, a + o), o))))

    return F.sort_array(let(_starts(kmers, _hash), runs))


def _tuples(numbered: Column) -> Column:
    """One int per non-empty sketch: its number in the low bits, the hash of its tuple above them."""
    cell = lambda x: F.shiftrightunsigned(x, 63 - SKETCH_BITS)
    sketch = lambda x: F.shiftrightunsigned(x, 64 - SKETCH_BITS)

    def tuple_of(chosen, i):
        x, y = F.get(chosen, i), F.get(chosen, i + 1)
        paired = F.when(
            y.isNull() | (sketch(y) != sketch(x)), F.xxhash64(_hash(x))).when(
            _place(x) <= _place(y), F.xxhash64(_hash(x), _hash(y))).otherwise(F.xxhash64(_hash(y), _hash(x)))
        low = (1 << SKETCH_BITS) - 1
        return F.shiftright(paired, 32).bitwiseAND(F.lit(~low)).bitwiseOR(sketch(x)).cast("int")

    least = F.transform(_starts(numbered, cell), lambda i: F.get(numbered, i))
    return let(least, lambda chosen: F.transform(_starts(chosen, sketch), lambda i: tuple_of(chosen, i)))


def sketches(text: Column, k: int = KMER) -> Column:
    """Tuple hashes of a non-null text, in the order of the sketches' numbers; none without a word."""
    of_words = lambda w: F.when(F.size(w) > 0, let(_kmers(w, k), lambda x: let(_numbered(x), _tuples)))
    return F.coalesce(let(F.array_remove(F.split(text, _SPACE), ""), of_words), F.array().cast("array<int>"))


def fingerprint(tuples: Column) -> Column:
    """Eight hexadecimal digits a tuple."""
    return F.array_join(F.transform(tuples, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing sketches among those that are filled on either side; two empty fingerprints are alike."""
    number = lambda x: x.bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))
    filled = F.size(F.array_union(F.transform(a, number), F.transform(b, number)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def following(ids: DataFrame, shift: int = 12) -> DataFrame:
    """(id, next_id) of distinct ids; the last one has none.

    Ids are cut into ranges of 4,096, these ranges into ranges again, so that
    only the table of the widest ranges is ordered in one task.
    """
    if shift > 40:
        return ids.select("id", F.lead("id").over(Window.orderBy("id")).alias("next_id"))
    cut = ids.withColumn("slice", F.shiftright("id", 12))
    slices = cut.groupBy("slice").agg(F.min("id").alias("first"))
    after = following(slices.select(F.col("slice").alias("id")), shift + 14)
    first = after.join(slices.select(F.col("slice").alias("next_id"), F.col("first").alias("beyond")), "next_id").select(
        F.col("id").alias("slice"), "beyond")
    inside = F.lead("id").over(Window.partitionBy("slice").orderBy("id"))
    return cut.withColumn("inside", inside).join(first, "slice", "left").select(
        "id", F.coalesce("inside", "beyond").alias("next_id"))


def fingerprints(docs: DataFrame, k: int = KMER) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and what they are like.

    In the edited text the last floor(n/2) of the n code points give way to as
    many first ones of the next document (all, if it has fewer): the one with the
    next larger doc_id, after the last the first. Of rows that share a doc_id the
    one with the smallest hash of its text counts as the document; rows without
    one come before the first document. Null texts are empty, and empty or
    wordless texts have an empty fingerprint. Repeated rows get a row each; an
    empty table gives none; other columns, whatever their names, are ignored.
    """
    # a key under its own name, not an alias of itself: then both joins have the same shuffle of the texts, which runs once
    key = F.col("doc_id") if docs.schema["doc_id"].dataType == T.LongType() else F.col("doc_id").cast("long").alias("doc_id")
    texts = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    placed = texts.where(F.col("doc_id").isNotNull()).repartition("doc_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    edge = ids.agg(F.min("id")).first()[0]
    first = F.lit(edge).cast("long")
    after = following(ids).select(F.col("id").alias("doc_id"), F.coalesce("next_id", first).alias("next_id"))
    wanted = texts.select("doc_id", F.length("text").alias("n")).distinct().join(after, "doc_id", "left").select(
        F.col("doc_id").alias("to"), F.col("n").alias("of"), F.coalesce("next_id", first).alias("next_id"))
    heads = placed.join(wanted.where(F.col("next_id").isNotNull()), F.col("doc_id") == F.col("next_id")).groupBy("to", "of", "next_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), F.expr("left(text, of div 2)").alias("head"))).alias("d")).select(
        "to", "of", "next_id", "d.head")
    joined = placed.join(heads.where(F.col("to").isNotNull()), (F.col("doc_id") == F.col("to")) & (F.length("text") - F.col("of") == 0))
    bare = texts.where(F.col("doc_id").isNull()).join(wanted.where(F.col("to").isNull()).select("of").distinct().join(
        heads.where(F.col("to").isNull()), "of", "left").select(
        "to", "of", "next_id", F.coalesce("head", F.lit("")).alias("head")), F.length("text") == F.col("of"))
    joined = joined.union(bare).withColumn("n", F.col("of"))
    edited = F.concat(F.expr("left(text, n - n div 2)"), F.col("head"))
    done = stage(
        joined.select("doc_id", "next_id", "n", "text", edited.alias("edited")).select(
            "doc_id", "next_id", F.col("n").cast("long").alias("n_chars"), F.xxhash64("text").alias("h"),
            F.sha2("edited", 256).alias("edited_sha256"), sketches(F.col("text"), k).alias("own"),
            sketches(F.col("edited"), k).alias("other")), "fingerprints")
    nearby = done.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("next_id")).agg(
        F.min(F.struct("h", "own")).alias("d")).select("next_id", F.col("d.own").alias("next"))
    return done.join(nearby, "next_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("next", F.array().cast("array<int>"))).alias("near_next"))
