"""Packing into optimal length buckets.

One histogram over all lengths goes to the driver, where dynamic programming
finds the bucket borders with the least padding. Inside a bucket the sequences
are put in order and cut into batches whose padded size stays within a token
budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import WORD


def word_tokens(text: Column) -> Column:
    """Words of a text and one end; null is empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1


def borders(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper borders, at most ``buckets``, that pad the fewest tokens; of equally good ones the lower earlier borders.

    ``lengths`` are distinct and ascending.
    """
    m = len(lengths)
    k = min(buckets, m)
    if not k:
        return []
    top = np.array(lengths, np.int64)
    c = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    s = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) * top)])
    best = top * c[1:] - s[1:]  # one bucket for the first j lengths
    back = []
    for _ in range(1, k):
        following, choice = np.full(m, np.iinfo(np.int64).max), np.zeros(m, np.int64)
        for j in range(len(back) + 1, m):
            i = np.arange(len(back), j)  # the last length of the bucket before
            cost = best[i] + top[j] * (c[j + 1] - c[i + 1]) - (s[j + 1] - s[i + 1])
            at = int(np.argmin(cost))
            following[j], choice[j] = cost[at], i[at]
        best = following
        back.append(choice)
    cut = [m - 1]
    for choice in reversed(back):
        cut.append(int(choice[cut[-1]]))
    return [int(top[i]) for i in reversed(cut)]


def pack(docs: DataFrame, length: Column | None = None, *, max_length: int = 2048, buckets: int = 8,
         budget: int = 65_536) -> DataFrame:
    """Places of all sequences: doc_id, piece, start, n_tokens, bucket, width, batch and slot.

    ``length`` is the number of tokens of a row, by default its words and one
    end. Longer rows than ``max_length`` give pieces of that length and a rest,
    so the histogram has at most ``max_length`` rows. A bucket's sequences, in
    the order of length, md5 of the key and key, fill batches of
    max(1, floor(budget / width)) slots, each padded to the bucket's ``width``.

    Null and empty texts are one token. Rows without a length or with none
    above zero have no piece. Rows with a null key are ordered as if it were
    empty; repeated rows get a place each. An empty table gives none; other
    columns, whatever their names, are ignored.
    """
    n = (word_tokens(F.col("text")) if length is None else length).cast("long")
    whole = docs.select("doc_id", n.alias("total")).where(F.col("total") > 0)
    pieces = whole.select(
        "doc_id", "total", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(max_length).cast("long"))).alias("piece", "start"),
    ).select(
        "doc_id", F.col("piece").cast("long").alias("piece"), "start",
        F.least(F.col("total") - F.col("start"), F.lit(max_length)).cast("long").alias("n_tokens"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("m"))
    counted = sorted((r["n_tokens"], r["c"]) for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("c")).collect())
    cuts = borders([x for x, _ in counted], [c for _, c in counted], buckets)
    spark, table, k, before = docs.sparkSession, [], 0, 0
    for size, count in counted:
        if size > cuts[k]:
            k, before = k + 1, 0
        table.append((size, k + 1, cuts[k], max(1, budget // cuts[k]), before))
        before += count
    plan = spark.createDataFrame(table, "n_tokens long, bucket int, width long, slots long, before long")

    # a length may be very frequent: its rows are numbered in 4,096 parts
    parted = pieces.withColumn("part", F.substring("m", 1, 3))
    parts = parted.groupBy("n_tokens", "part").agg(F.count("*").alias("c"))
    earlier = Window.partitionBy("n_tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("n_tokens", "part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("n_tokens", "part").orderBy("m", "doc_id", "piece")) - 1
    place = F.col("before") + F.col("offset") + F.col("inside")
    return parted.withColumn("inside", inside).join(offsets, ["n_tokens", "part"]).join(F.broadcast(plan), "n_tokens").select(
        "doc_id", "piece", "start", "n_tokens", "bucket", "width",
        F.floor(place / F.col("slots")).cast("long").alias("batch"), (place % F.col("slots")).cast("long").alias("slot"))


def pack_sql(table: str, *, max_length: int = 2048, buckets: int = 8, budget: int = 65_536) -> str:
    """The same over ``table`` (doc_id, text)."""
    return f"""
    WITH RECURSIVE t AS (
        SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + 1 AS total FROM {table}),
    p AS MATERIALIZED (
        SELECT doc_id, s // {max_length} AS piece, s AS start, least(total - s, {max_length}) AS n_tokens,
               md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS m
        FROM (SELECT doc_id, total, unnest(range(0, total, {max_length})) AS s FROM t)),
    h AS MATERIALIZED (
        SELECT l, row_number() OVER (ORDER BY l) AS j, CAST(sum(c) OVER (ORDER BY l) AS BIGINT) AS c,
               CAST(sum(c * l) OVER (ORDER BY l) AS BIGINT) AS s
        FROM (SELECT n_tokens AS l, count(*) AS c FROM p GROUP BY ALL)),
    d AS (
        SELECT 1 AS k, j, l * c - s AS cost, [l] AS cuts FROM h
        UNION ALL
        SELECT any_value(d.k) + 1, h.j, min(d.cost + h.l * (h.c - i.c) - (h.s - i.s)),
               arg_min(list_append(d.cuts, h.l), row(d.cost + h.l * (h.c - i.c) - (h.s - i.s), d.j))
        FROM d JOIN h ON d.j < h.j JOIN h i ON i.j = d.j WHERE d.k < {buckets} GROUP BY h.j),
    b AS (
        SELECT unnest(cuts) AS width, generate_subscripts(cuts, 1) AS bucket
        FROM (SELECT cuts FROM d WHERE j = (SELECT max(j) FROM h) ORDER BY cost, k DESC LIMIT 1)),
    q AS (
        SELECT p.*, (SELECT min(width) FROM b WHERE width >= n_tokens) AS width FROM p),
    r AS (
        SELECT q.*, row_number() OVER (PARTITION BY width ORDER BY n_tokens, m, doc_id, piece) - 1 AS place FROM q)
    SELECT doc_id, CAST(piece AS BIGINT) AS piece, CAST(start AS BIGINT) AS start, CAST(n_tokens AS BIGINT) AS n_tokens,
           CAST(bucket AS INTEGER) AS bucket, CAST(width AS BIGINT) AS width,
           CAST(place // greatest(1, {budget} // width) AS BIGINT) AS batch,
           CAST(place % greatest(1, {budget} // width) AS BIGINT) AS slot
    FROM r JOIN b USING (width)"""
