"""How far the sources of a language differ in their words.

The documents of a group become exact sparse vectors of term counts
(:class:`pyspark.ml.feature.CountVectorizer`, one vocabulary a language: a term
is counted under its language). The vectors are summed by language and source
as sparse entries, and the sources of a language are compared on smoothed
shares in whole numbers, of which terms that neither source has need no row.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import bytes_of, stage

#: terms are runs of ASCII letters and bytes beyond ASCII; A-Z in lower case, every other byte a blank
TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
#: between a language and its term; no term holds it
CUT = "\x00"
#: distinct terms a task holds before their levels are handed on, in rows of so many terms
HELD, IN_ROW = 500_000, 50_000
#: bytes of texts a task holds to bring those of a group together, in rows of so many bytes
TEXTS, IN_TEXT = 32 << 20, 2 << 20
LARGEST = 2**31 - 1
SCALE = 1_000_000_000


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], bytes_of(F.col("text")).alias("text"))


def _stretches(items, size, most: int):
    """Lists of items in order, each ended as soon as its size reaches ``most``."""
    out, n = [], 0
    for x in items:
        out.append(x)
        n += size(x)
        if n >= most:
            yield out
            out, n = [], 0
    if out:
        yield out


def _documents(docs: DataFrame) -> DataFrame:
    """(lang, source, terms): all terms of a stretch of documents of one group, with their language.

    Texts of a group are read as one, a blank between them, so a term's entries are
    fewer and the sums the same. An empty term may stand at either end.
    """
    def cut(batches):
        every = ((key, text) for b in batches for *key, text in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for some in _stretches(every, lambda x: len(x[1]) + 100, TEXTS):
            groups = defaultdict(list)
            for key, text in some:
                groups[tuple(key)].append(text)
            rows = ((*key, b" ".join(t)) for key, texts in groups.items() for t in _stretches(texts, len, IN_TEXT))
            for part in _stretches(rows, lambda x: len(x[2]) + 100, IN_TEXT):
                lang, source, text = zip(*part, strict=True)
                found = pc.ascii_split_whitespace(pa.array([t.translate(TERMS) for t in text], pa.binary()).view(pa.string()))
                of = pc.take(pa.array(lang, pa.string()), pc.list_parent_indices(found))
                terms = pa.ListArray.from_arrays(found.offsets, pc.binary_join_element_wise(of, found.flatten(), CUT))
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), terms], ["lang", "source", "terms"])

    return _read(docs).mapInArrow(cut, "lang string, source string, terms array<string>")


def _levels(docs: DataFrame, min_docs: int) -> DataFrame:
    """Rows of distinct terms: a term is in as many rows as documents of its language hold it, if these are fewer than ``min_docs``.

    The k-th row of a stretch of documents holds the terms that k of them have.
    From the ``min_docs``-th on a row would say nothing: its terms are kept anyway.
    """
    def levels(held):
        terms = [(lang + CUT.encode() + t, n) for lang, mine in held.items() for t, n in mine.items()]
        for k in range(1, max(min_docs, 1) + 1):
            terms = [x for x in terms if x[1] >= k]
            for at in range(0, len(terms), IN_ROW):  # a row may be cut: its terms are distinct
                values = pa.array([t for t, _ in terms[at:at + IN_ROW]], pa.binary()).view(pa.string())
                row = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([row], ["terms"])

    def count(batches):
        held = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                held.setdefault(lang.encode(), Counter()).update(set(text.translate(TERMS).split()))
                if sum(map(len, held.values())) > HELD:
                    yield from levels(held)
                    held = {}
        yield from levels(held)

    return _read(docs).select("lang", "text").mapInArrow(count, "terms array<string>")


def _vectorisers(docs: DataFrame, min_docs: int, at_once: int) -> list[tuple[DataFrame, CountVectorizerModel]]:
    """Documents and model of each part of the terms; no part keeps more than ``at_once``.

    The vocabulary size is never what limits a vocabulary: a part that keeps
    more terms than may lie on the driver is dealt out again, by hash.
    """
    read, levels = _documents(docs), _levels(docs, min_docs)
    # a vectoriser refuses an empty vocabulary: this term is of no language
    some = docs.sparkSession.range(min_docs).select(F.array(F.lit("")).alias("terms"))
    parts = 1
    while True:
        out = []
        for part in range(parts):
            mine, learnt = (df if parts == 1 else df.withColumn(
                "terms", F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(parts)) == part)) for df in (read, levels))
            size = min(at_once + 2, LARGEST)
            model = CountVectorizer(inputCol="terms", outputCol="v", minDF=float(min_docs), vocabSize=size).fit(learnt.unionAll(some))
            out.append((mine, model))
            if len(model.vocabulary) == size and size < LARGEST:
                break
        else:
            return out
        parts *= 4


def group_counts(docs: DataFrame, min_docs: int = 10, at_once: int = 2_000_000) -> DataFrame:
    """(lang, source, term, n): occurrences of each kept term in each group that has it.

    A language keeps the terms that at least ``min_docs`` of its documents
    hold. A vocabulary lies on the driver and in every task, so kept terms are
    dealt to as many vectorisers as hold ``at_once`` of them each; every one
    reads the texts on its own.
    """
    out = []
    for mine, model in _vectorisers(docs, min_docs, at_once):
        names = docs.sparkSession.createDataFrame(list(enumerate(model.vocabulary)), "i int, name string")
        entries = model.transform(mine).select(
            "lang", "source", F.explode(F.arrays_zip(F.unwrap_udt("v")["indices"].alias("i"), F.unwrap_udt("v")["values"].alias("c"))).alias("e"))
        sums = entries.groupBy("lang", "source", F.col("e.i").alias("i")).agg(F.sum(F.col("e.c").cast("long")).alias("n"))
        # at most ``at_once`` names and the one of no language
        out.append(sums.join(F.broadcast(names), "i").select(
            "lang", "source", F.element_at(F.split("name", CUT), -1).alias("term"), "n"))
    return reduce(DataFrame.unionAll, out)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact; null where a language keeps no term."""
    whole = F.lit(SCALE).cast("decimal(18,0)") * (n + 2).cast("decimal(20,0)")
    over = F.nullif((total + 2 * terms).cast("decimal(20,0)"), F.lit(0))
    return 1 + F.call_function("div", whole, over)


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)), exact: shares stay below 2^30."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, at_once: int = 2_000_000, salts: int = 16) -> DataFrame:
    """(lang, source, part, item, value, rank): every source against the others of its language, and its outstanding terms.

    Part ``pair`` ranks the other sources by their distance, summed over all
    kept terms of the language; part ``term`` the ``top`` terms that the group
    has and uses more than its language does. Null texts, languages and sources
    are empty strings, which are a language and a source like others. Repeated
    rows and keys count as they come; a language that keeps no term gives pairs
    of value 0 and no terms; an empty table gives no rows. Ties go to the least
    item by its UTF-8 bytes.
    """
    counts = stage(group_counts(docs, min_docs, at_once), "divergence-counts")
    of_terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = of_terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("all"))
    occurring = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("long")
    groups = (
        occurring
        .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("total", "own", "terms", "all")])
        .withColumn("p0", _share(zero, F.col("total"), F.col("terms")))
    )
    groups = stage(groups, "divergence-groups")
    shares = stage(
        counts.join(groups, ["lang", "source"])
        .join(of_terms.withColumnRenamed("n", "n_lang"), ["lang", "term"])
        .select("lang", "source", "term", "p0", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                _share(F.col("n_lang"), F.col("all"), F.col("terms")).alias("q")),
        "divergence-shares")

    # terms that the first group has, against the second's share of a term it has not
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"),
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    one_sided = (
        shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
        .withColumn("salt", F.pmod(F.hash("source", "p"), F.lit(salts)))
        .join(other, ["lang", "salt"]).where(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item").agg(F.sum(F.col("m") * _gap(F.col("p"), F.col("q0"))).alias("v"))
    )

    def swapped(df):
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "v", "common")

    # terms that both have, in place of what the one-sided sums took them for
    second = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p2"), F.col("p0").alias("p02"))
    both = (
        shares.join(second, ["lang", "term"]).where(F.col("source") < F.col("item"))  # the gap is the same both ways
        .groupBy("lang", "source", "item").agg(
            F.sum(_gap(F.col("p"), F.col("p2")) - _gap(F.col("p"), F.col("p02")) - _gap(F.col("p0"), F.col("p2"))).alias("v"),
            F.count("*").alias("common"))
    )
    one_sided = one_sided.withColumn("common", zero)
    parts = [one_sided, swapped(one_sided), both, swapped(both)]
    corrected = reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "item").agg(
        F.sum("v").alias("v"), F.sum("common").alias("common"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("own").alias("own2"), F.col("p0").alias("p02"))
    neither = F.col("terms") - F.col("own") - F.col("own2") + F.coalesce(F.col("common"), zero)
    pairs = (
        groups.join(b, "lang").where(F.col("source") != F.col("item"))  # one row a result row
        .join(corrected, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                F.coalesce(F.coalesce(F.col("v"), zero) + neither * _gap(F.col("p0"), F.col("p02")), zero).alias("value"))
    )
    terms = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .unionByName(terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))
    )


DIVERGENCE_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
    e AS MATERIALIZED (SELECT id, lang, source, unnest(w) AS term FROM d),
    k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM e GROUP BY ALL HAVING count(DISTINCT id) >= 10),
    l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN k USING (lang, term) GROUP BY ALL),
    t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
    p AS MATERIALIZED (  -- every group with every kept term
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
            CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS BIGINT) AS p,
            CAST(1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v) AS BIGINT) AS q
        FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM r QUALIFY part = 'pair' OR rank <= 10"""
