"""Cheapest edits that bring conversations into order, the least of equally cheap ones.

An automaton of four states reads the roles: nothing yet, after ``s``, after
``u``, after ``a``. Every row is kept, given another role or deleted, and rows
may be inserted. A node is a state between two rows. Dynamic programming gives
every node the least cost to the end; its optimal arcs are those that lie on a
cheapest way. Prefix doubling then ranks the nodes by their least audits of 1,
2, 4, ... letters, from the ranks at both halves, and doubled pointers walk the
least path. A letter leads a node to one node only, so equal audits of a node
end in the same node.

Conversations are cut into blocks of rows. What a block does to the costs is a
4 x 4 matrix of least sums, and what it does to a path is a map of states to
states; both compose, and only conversations of several blocks go through the
log2(blocks) joins that compose them. So no task holds a conversation but the
one that puts its audit together, which is one value of the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import in_order, stage
from tapeloom.operators.timeblocks import with_carry

SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 50
LETTERS = np.frombuffer(b"\x00DIKR", np.uint8)
#: by state: the role that may come next (2: user, 3: assistant); it is the next state as well
PUT = np.array([2, 2, 3, 2])
#: by initial (none of them, s, u, a) and state: the next state, or 4 for none
STEP = np.array([[4, 4, 4, 4], [1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4]])
#: costs from each state behind the last row
ENDS = [0, 2 * INSERT, INSERT, 0]
ROLES = {2: "user", 3: "assistant"}


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), damaged by crc32 of ``conv_id:turn`` modulo 20; null values are one space.

    0 drops a row, 1 empties its text, 2 takes out its sentence ends, 3 doubles
    it and 4 makes it the user's.
    """
    role, text = [F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")]
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    roll = F.pmod(F.crc32(key), F.lit(20))
    return turns.where(roll != 0).select(
        "conv_id", "turn", F.when(roll == 4, "user").otherwise(role).alias("role"),
        F.when(roll == 1, "").when(roll == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(roll == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def _light(turns: DataFrame) -> DataFrame:
    """Rows without their texts: the text's hash, the role's initial and the faults seen in the row alone."""
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    return turns.select(
        "conv_id", "turn", "role", _text_key(F.col("text")).alias("key"),
        F.when(end == "", 1).when(~F.contains(F.lit(".!?"), end), 3).otherwise(0).alias("fault"))


def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)


def blocks_of(light: DataFrame, block: int) -> DataFrame:
    """(conv_id, b, codes): a letter a row, in order; blocks but the first begin with the letter of the row before.

    Rows come by turn, nulls first, then role and hash of the text. A row is a
    duplicate if its role and text came at an earlier turn or just before.
    """
    firsts = light.groupBy("conv_id", "role", "key").agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull().cast("int")).alias("nulls"))
    other = [F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "key")]
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    later = F.col("turn").isNotNull() & ((F.col("nulls") == 1) | (F.col("turn") > F.col("first")))
    marked = light.join(firsts.select(*other, "first", "nulls"), same).select(*light.columns, later.alias("later"))

    def inside(w):
        def before(c):
            return F.lag(c, 1).over(w).eqNullSafe(F.col(c))

        n = F.row_number().over(w)
        return {"n_": n.cast("long"), "again": (n > 1) & before("turn") & before("role") & before("key")}

    numbered = with_carry(
        marked, ["conv_id"], ["turn", "role", "key"], slice_by=F.floor(F.col("turn") / 512),
        local=inside,
        summary={"s_": F.count(F.lit(1))},
        carry=lambda earlier: {"c_": F.sum("s_").over(earlier)},
        combine={"pos": F.col("n_") + F.coalesce(F.col("c_"), F.lit(0)) - 1, "again": F.col("again")},
    )
    fault = F.when((F.col("fault") != 1) & (F.col("later") | F.col("again")), 2).otherwise(F.col("fault"))
    b = F.floor(F.col("pos") / block)
    homes = F.when(F.col("pos") % block == block - 1, F.array(b, b + 1)).otherwise(F.array(b))
    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    return (
        numbered.select("conv_id", "pos", F.char(F.lit(65) + fault * 4 + _initial()).alias("code"), F.explode(homes).alias("b"))
        .groupBy("conv_id", "b").agg(letters.alias("codes"))
    )


def _classes(codes: list[str], b: np.ndarray, most: int = 1 << 15):
    """Groups of blocks of similar length: (index of blocks, rows aligned to the right, lengths)."""
    length = np.array([len(c) - (i > 0) for c, i in zip(codes, b)], np.int64)
    size = np.array([int(n).bit_length() for n in length])
    for k in np.unique(size):
        some = np.flatnonzero(size == k)
        step = max(1, most >> int(k))
        for i in range(0, len(some), step):
            at = some[i:i + step]
            wide = int(length[at].max())
            rows = np.zeros((len(at), wide), np.int64)
            for j, x in enumerate(at):
                if length[x]:
                    rows[j, wide - length[x]:] = np.frombuffer(codes[x].encode(), np.uint8)[-int(length[x]):] - 65
            yield at, rows, length[at]


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Least costs with inserts: no cheapest way inserts more than two rows at a place."""
    for _ in range(2):
        cost = np.minimum(cost, INSERT + cost[..., PUT])
    return cost


def _row_costs(fault: np.ndarray, initial: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reroling a row, by state; ``after`` are the costs behind it (..., 4)."""
    must = ((fault == 1) | (fault == 2))[..., None]
    more = np.where(fault == 3, TRUNCATED, 0)[..., None]
    far = np.concatenate([after, np.full(after.shape[:-1] + (1,), FAR)], -1)
    keep = np.where(must, FAR, KEEP + more + np.take_along_axis(far, STEP[initial], -1))
    rerole = np.where(must, FAR, REROLE + more + after[..., PUT])
    return DELETE + after, keep, rerole


def _backward(rows: np.ndarray, length: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least costs of all nodes, (blocks, places, 4), from those at the blocks' ends."""
    n, wide = rows.shape
    cost = np.full((n, wide + 1, 4), FAR, np.int64)
    cost[:, wide] = end
    for i in range(wide - 1, -1, -1):
        on = np.flatnonzero(wide - i <= length)
        fault, initial = rows[on, i] // 4, rows[on, i] % 4
        cost[on, i] = _inserted(np.minimum.reduce(_row_costs(fault, initial, cost[on, i + 1])))
    return cost


def block_matrix(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(blocks, 4, 4): the least cost from a state before a block to one behind it; inserts behind it count for the next."""
    columns = [_backward(rows, length, np.where(np.arange(4) == t, 0, FAR)[None])[np.arange(len(rows)), rows.shape[1] - length]
               for t in range(4)]
    return np.minimum(np.stack(columns, -1), FAR)


def least_paths(rows: np.ndarray, length: np.ndarray, end: np.ndarray, last: np.ndarray):
    """Costs, exits and audits of each block by entry state: (blocks, 4) arrays, audits as bytes."""
    n, wide = rows.shape
    cost = _backward(rows, length, end)
    place = np.arange(wide + 1)
    first = (wide - length)[:, None]
    node = np.arange(n * (wide + 1) * 4).reshape(n, wide + 1, 4)
    step = cost[:, 1:]
    delete, keep, rerole = _row_costs(rows // 4, rows % 4, step)
    here, inside = cost[:, :-1], (place[:-1] >= first)[..., None]
    ahead = node[:, 1:]
    kept = np.take_along_axis(np.concatenate([ahead, ahead[..., :1]], -1), STEP[rows % 4], -1)
    no = np.zeros((n, 1, 4), bool)
    stay = np.zeros((n, 1, 4), np.int64)

    def of_rows(value, target):
        return np.concatenate([inside & (value == here), no], 1), np.concatenate([target, stay], 1)

    inserts = (place >= first)[..., None] & ((place < wide) | last[:, None])[..., None] & (INSERT + cost[..., PUT] == cost)
    # by ascending letter: delete, insert, keep, rerole
    arcs = [of_rows(delete, ahead), (inserts, node[..., PUT]), of_rows(keep, kept), of_rows(rerole, ahead[..., PUT])]
    ok = np.stack([a[0].ravel() for a in arcs])
    to = np.stack([a[1].ravel() for a in arcs])

    # ranks by audits of 1, 2, 4, ... letters; a node without arcs points to itself and ranks lowest
    some, least = ok.any(0), ok.argmax(0)
    itself = node.ravel()
    rank, ahead_of = np.where(some, least + 1, 0), np.where(some, to[least, itself], itself)
    while True:
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[ahead_of], return_inverse=True)
        further = ahead_of[ahead_of]
        if np.array_equal(further, ahead_of):
            break
        ahead_of = further
    # the ranks choose a node's arc, and pointers over 1, 2, 4, ... of the chosen arcs walk the path
    key = np.where(ok, np.arange(1, 5)[:, None] * (int(rank.max()) + 1) + rank[to], FAR)
    chosen = key.argmin(0)
    letter = np.where(some, chosen + 1, 0)
    jumps = [np.where(some, to[chosen, itself], itself)]
    while not np.array_equal(further := jumps[-1][jumps[-1]], jumps[-1]):
        jumps.append(further)
    start = node[np.arange(n), wide - length]  # (blocks, 4)
    path = start.reshape(-1, 1)
    for jump in reversed(jumps):
        path = np.stack([path, jump[path]], -1).reshape(len(path), -1)
    text = LETTERS[letter[path]]
    audits = np.ascontiguousarray(text).view(f"S{text.shape[1]}").reshape(n, 4)
    exits = jumps[-1][start] % 4
    return cost[np.arange(n), wide - length], exits, audits


MATRIX = "conv_id {key}, b long, m array<long>"
SOLVED = ("conv_id {key}, b long, exits array<int>, audits array<string>, costs array<long>, "
          "blank long, duplicate long, truncated long, illegal long")


def _illegal(code: str) -> int:
    pairs = [(ord(a) - 65) % 4 * 4 + (ord(b) - 65) % 4 for a, b in zip(code, code[1:])]
    return sum(p not in (1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2) for p in pairs)


def _matrices(batches):
    for batch in batches:
        codes, b = batch.column("codes").to_pylist(), batch.column("b").to_numpy()
        out = [None] * len(codes)
        for at, rows, length in _classes(codes, b):
            for i, m in zip(at, block_matrix(rows, length)):
                out[i] = m.ravel().tolist()
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("b"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "b", "m"])


def _solve(batches):
    for batch in batches:
        codes, b = batch.column("codes").to_pylist(), batch.column("b").to_numpy()
        ends = batch.column("after").to_pylist()
        out = [None] * len(codes)
        for at, rows, length in _classes(codes, b):
            last = np.array([ends[i] is None for i in at])
            end = np.array([ends[i] or ENDS for i in at], np.int64)
            faults = [np.bincount(r[len(r) - n:] // 4, minlength=4).tolist() for r, n in zip(rows, length)]
            for i, cost, leave, audit, f in zip(at, *least_paths(rows, length, end, last), faults):
                out[i] = (leave.tolist(), [a.decode() for a in audit], cost.tolist(), *f[1:], _illegal(codes[i]))
        kinds = [pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())] + [pa.int64()] * 4
        columns = list(zip(*out)) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("b"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
            ["conv_id", "b", "exits", "audits", "costs", "blank", "duplicate", "truncated", "illegal"])


def _scan(table: DataFrame, value: str, way: int, compose, rounds: int, name: str) -> DataFrame:
    """Composes ``value`` with those of all later (``way`` 1) or earlier (-1) blocks, in ``rounds`` doublings."""
    for k in range(rounds):
        far = table.select(F.col("conv_id").alias("_c"), (F.col("b") - way * (1 << k)).alias("_b"), F.col(value).alias("_v"))
        on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("b") == F.col("_b"))
        table = stage(table.join(far, on, "left").select(
            "conv_id", "b", F.when(F.col("_v").isNull(), F.col(value)).otherwise(compose(F.col(value), F.col("_v"))).alias(value)), name)
    return table


def _product(m: Column, n: Column) -> Column:
    """Least sums of two matrices, row after row."""
    return F.array(*[F.least(*[m[4 * i + k] + n[4 * k + j] for k in range(4)], F.lit(FAR)) for i in range(4) for j in range(4)])


def plan(turns: DataFrame, block: int = 1024) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation in ``turns``.

    ``turns`` has conv_id, turn, role and text. A null conversation is one of
    its own, null turns come first; null roles and texts are empty. Rows of one
    turn come by role and sha-256 of the text; a repeated row is a duplicate.
    """
    key = turns.schema["conv_id"].dataType.simpleString()
    none = F.lit("")
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                         *[F.coalesce(F.col(c), none).alias(c) for c in ("role", "text")])
    light = stage(_light(turns), "conversations-light")
    blocks = stage(blocks_of(light, block), "conversations-blocks")
    most = blocks.agg(F.max("b")).first()[0] or 0
    rounds = int(most).bit_length()

    after = None
    if most:
        many = blocks.where("b > 0").select(F.col("conv_id").alias("_c")).distinct()
        long = blocks.join(many, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")
        matrix = stage(long.mapInArrow(_matrices, MATRIX.format(key=key)), "conversations-matrices")
        ahead = _scan(matrix, "m", 1, _product, rounds, "conversations-ahead")
        least = [F.least(*[F.col("m")[4 * i + k] + ENDS[k] for k in range(4)]) for i in range(4)]
        after = ahead.select(F.col("conv_id").alias("_c"), (F.col("b") - 1).alias("_b"), F.array(*least).alias("after"))
    ended = blocks.withColumn("after", F.lit(None).cast("array<long>")) if after is None else blocks.join(
        after, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("b") == F.col("_b")), "left").drop("_c", "_b")
    solved = stage(ended.mapInArrow(_solve, SOLVED.format(key=key)), "conversations-solved")

    entry = F.lit(0)
    if most:
        maps = solved.join(many, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").select("conv_id", "b", F.col("exits").alias("f"))
        ways = _scan(maps, "f", -1, lambda f, earlier: F.transform(earlier, lambda s: F.get(f, s)), rounds, "conversations-ways")
        before = ways.select(F.col("conv_id").alias("_c"), (F.col("b") + 1).alias("_b"), F.col("f")[0].alias("entry"))
        solved = solved.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("b") == F.col("_b")), "left")
        entry = F.coalesce(F.col("entry"), F.lit(0))
    pieces = F.sort_array(F.collect_list(F.struct("b", F.get("audits", entry).alias("audit"))))  # a value of the result
    whole = solved.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.max(F.when(F.col("b") == 0, F.col("costs")[0])).alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
    turn = F.col("turn")
    gaps = light.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps"))
    gaps = gaps.withColumnRenamed("conv_id", "_c")
    return whole.join(gaps, F.col("conv_id").eqNullSafe(F.col("_c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


REPAIRED = "conv_id {key}, place long, edit string, role string, text string"


def _edited(batches):
    """Applies each conversation's audit, which comes before its rows, in one pass over them."""
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        keys, roles, texts, audits = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))
        out = []
        for key, role, text, audit in zip(keys, roles, texts, audits):
            if audit is not None:
                letters, at, place, state = audit, 0, 0, 0
            else:
                edit = letters[at]
                at += 1
                if edit == "R":
                    state = int(PUT[state])
                    out.append((key, place, edit, ROLES[state], text))
                elif edit == "K":
                    state = {"s": 1, "u": 2, "a": 3}[role[0]]
                    out.append((key, place, edit, role, text))
                place += edit != "D"
            while at < len(letters) and letters[at] == "I":  # inserts come before the next row
                state = int(PUT[state])
                out.append((key, place, "I", ROLES[state], ""))
                at, place = at + 1, place + 1
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["conv_id", "place", "edit", "role", "text"])


def repaired(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows that remain, in order, under the audits of :func:`plan`.

    The rows of a conversation lie in one partition and in order.
    """
    key = turns.schema["conv_id"].dataType.simpleString()
    null = F.lit(None).cast("string")
    rows = turns.select(
        "conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]).withColumn("key", _text_key(F.col("text")))
    heads = edits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                         F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("key"), "audit")
    both = rows.withColumn("audit", null).unionByName(heads)
    return in_order(both, "conv_id", "kind", "turn", "role", "key").select("conv_id", "role", "text", "audit").mapInArrow(
        _edited, REPAIRED.format(key=key))


def _hashed(batches):
    begun, key, kind, done = False, None, None, []

    def some():
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if not begun or c != key:
                if begun:
                    done.append((key, digest.hexdigest()))
                begun, key, digest = True, c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if len(done) > 1000:
            yield some()
            done = []
    if begun:
        done.append((key, digest.hexdigest()))
        yield some()


def repair(turns: DataFrame, block: int = 1024) -> DataFrame:
    """Damages conversations and repairs them: one row for every conversation of ``turns``.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 (the repaired ``role:text``, joined by line ends). A
    conversation that lost all its rows has zeros, an empty audit and the hash
    of an empty text; an empty table gives no rows. Order, nulls and ties as in
    :func:`damage` and :func:`plan`.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    rows = damage(turns)
    edits = stage(plan(rows, block), "conversations-plan")
    key = turns.schema["conv_id"].dataType.simpleString()
    hashes = repaired(rows, edits).mapInArrow(_hashed, f"conv_id {key}, repaired_sha256 string").withColumnRenamed("conv_id", "_h")
    every = turns.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(edits.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")), "left")
        .join(hashes, F.col("conv_id").eqNullSafe(F.col("_h")), "left")
        .select("conv_id", *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
    )
