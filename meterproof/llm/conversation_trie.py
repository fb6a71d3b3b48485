"""Conversation prefix trie, measured along an Euler tour.

Nodes are the distinct beginnings of conversations. A node's key is a pair of polynomial digests
of its turns, scanned over range partitions of all turns, so one conversation may lie in many of them. Every
node has an arc that enters it and one that leaves it, each pointing to the arc that follows on
the tour. The tour is ranked as a distributed list: tasks contract the stretches that lie within
them, random mates contract what is left round by round until FINISH stretches remain, and the
rounds are undone in reverse. Sums along the ranked arcs then give what a subtree holds: the sum
at the arc that leaves a node minus the sum before the arc that enters it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from meterproof.llm.common import in_arrow, split_join, stored

#: Odd multipliers of the two digests.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Arcs of one contracting task, about.
PER_TASK = 200_000
#: Stretches of the tour that are ranked in one piece.
FINISH = 20_000
#: Nodes of one chain that are dealt to the same task.
CHAIN = 1024
#: Arcs of one stretch of prefix sums at least, and how many stretches there are at most.
STRETCH, STRETCHES = 16_384, 10_000
#: Ids of one piece of a digest's text.
IDS = 1000
# Fixed values of the contract: conversations that share a beginning, and the number of lengths it can have.
GROUP, HEADS = 100, 6
NO_IDS = hashlib.sha256(b"").hexdigest()


def powers(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2 ** 64."""
    result, left = np.ones(len(exponents), np.uint64), exponents.astype(np.uint64)
    with np.errstate(over="ignore"):
        while left.any():
            result = np.where(left & np.uint64(1), result * base, result)
            base, left = base * base, left >> np.uint64(1)
    return result


def _changes(column: pa.Array, before: object) -> np.ndarray:
    """Whether each value differs from the one before it."""
    if not len(column):
        return np.zeros(0, bool)
    inner = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[column[0].as_py() != before], inner.astype(bool)])


def _scanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and digests of the turns so far, from where this partition's part of the conversation begins.
    Columns: conv_id, h1, h2, size."""
    before, count, sums = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = _changes(batch.column(0), before)
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        goes_on = start < 0
        k = np.where(goes_on, np.arange(n) + count, np.arange(n) - start) + 1
        columns = []
        with np.errstate(over="ignore"):
            for j, base in enumerate(BASES):
                parts = batch.column(1 + j).to_numpy(zero_copy_only=False).view(np.uint64) * powers(base, k)
                total = np.cumsum(parts, dtype=np.uint64)
                origin = np.where(goes_on, np.uint64(0) - sums[j], (total - parts)[np.maximum(start, 0)])
                sums[j] = (total - origin)[-1]
                columns.append(pa.array((total - origin).view(np.int64)))
        before, count = batch.column(0)[-1].as_py(), int(k[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k), *columns], [*batch.schema.names, "k", "e1", "e2"])


def _carrying(carried: dict[int, tuple]):
    """Adds what earlier partitions hold of the first conversation of a partition; gives depth, the node's key and its parent's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(7).to_numpy() >> 33
            k = batch.column(4).to_numpy().copy()
            e = [batch.column(5 + j).to_numpy().view(np.uint64).copy() for j in range(2)]
            with np.errstate(over="ignore"):
                for p in np.unique(part):
                    if int(p) in carried:
                        conv, count, *sums = carried[int(p)]
                        mine = (part == p) & pc.equal(batch.column(0), conv).to_numpy(zero_copy_only=False).astype(bool)
                        for j, base in enumerate(BASES):
                            e[j][mine] = np.uint64(sums[j]) + powers(base, np.array([count]))[0] * e[j][mine]
                        k[mine] += count
                parents = [e[j] - batch.column(1 + j).to_numpy().view(np.uint64) * powers(base, k) for j, base in enumerate(BASES)]
            # The last bit of the second digest is left to tell the two arcs of a node apart.
            keys = [e[0], e[1] & ~np.uint64(1), parents[0], parents[1] & ~np.uint64(1)]
            columns = [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(k), *(pa.array(x.view(np.int64)) for x in keys)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "h1", "h2", "size", "depth", "k1", "k2", "p1", "p2"])

    return run


def scan_turns(turns: DataFrame, *order: str) -> DataFrame:
    """Adds, to turns (conv_id, h1, h2, size and the columns of `order`), depth and the keys of the node and of its parent.

    What passes through the driver is the first conversation of each range partition and the last one's sums.
    """
    key = ("conv_id", *order)
    ordered = turns.repartitionByRange(*key).sortWithinPartitions(*key).select("conv_id", "h1", "h2", "size")
    kind = "conv_id long, h1 long, h2 long, size long"
    rows = stored(in_arrow(ordered, _scanning, f"{kind}, k long, e1 long, e2 long").withColumn("at", F.monotonically_increasing_id()), "scanned")
    edges = rows.groupBy(F.shiftright("at", 33).alias("part")).agg(
        F.min_by("conv_id", "at").alias("first"), F.max_by(F.struct("conv_id", "k", "e1", "e2"), "at").alias("last")
    )
    carried: dict[int, tuple] = {}
    last: tuple = (None, 0, 0, 0)
    for edge in edges.orderBy("part").collect():
        conv, k, e1, e2 = edge["last"]
        if edge["first"] == last[0]:
            carried[edge["part"]] = last
        if edge["first"] == last[0] == conv:
            with np.errstate(over="ignore"):
                ahead = [int(np.uint64(last[2 + j]) + powers(base, np.array([last[1]]))[0] * np.uint64(e % 2**64)) for j, (base, e) in enumerate(zip(BASES, (e1, e2)))]
            last = (conv, last[1] + k, *ahead)
        else:
            last = (conv, k, e1 % 2**64, e2 % 2**64)
    return in_arrow(rows, _carrying(carried), f"{kind}, depth long, k1 long, k2 long, p1 long, p2 long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (from 1), h1, h2 (hashes of role and text) and size (code points), by turn, NULL turns first.

    Equal turns of a conversation are ordered by their hashes, so repeated rows count each time in
    a fixed order; NULL roles and texts become empty; rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"), F.length(text).cast("long").alias("size"),
    )
    return scan_turns(rows, "turn", "h1", "h2").select("conv_id", F.col("depth").alias("i"), "h1", "h2", "size")


def rebuilt(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The contract's conversations: each begins with the first h turns of its group's first
    conversation and goes on with its own turns after its first h; h is from its id's hash."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = turns.where(F.col("i") > h)
    # At most HEADS - 1 turns of a group's first conversation, for at most GROUP conversations.
    first = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("i") < HEADS)).withColumnRenamed("conv_id", "base")
    heirs = members.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), h.alias("h"))
    return own.unionByName(heirs.join(first, "base").where("i <= h").select(*own.columns))


def _next_siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the key of the row after each, if it has the same parent. Columns 0 to 3: p1, p2, k1, k2."""
    held: pa.RecordBatch | None = None
    names = None

    def with_next(rows: pa.RecordBatch, after: pa.RecordBatch | None) -> pa.RecordBatch:
        follow = [pa.concat_arrays([rows.column(j).slice(1), after.column(j).slice(0, 1) if after else pa.nulls(1, pa.int64())]) for j in range(4)]
        same = pc.fill_null(pc.and_(pc.equal(rows.column(0), follow[0]), pc.equal(rows.column(1), follow[1])), False)
        nexts = [pc.if_else(same, follow[j], pa.scalar(None, pa.int64())) for j in (2, 3)]
        return pa.RecordBatch.from_arrays([*rows.columns, *nexts], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        names = [*batch.schema.names, "s1", "s2"]
        if held is not None:
            yield with_next(held, batch)
        held = batch
    if held is not None:
        yield with_next(held, None)


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Adds the key (s1, s2) of the next child of the same parent, by smallest member; the root has none.
    Children are ordered over range partitions, so a parent may have any number of them."""
    key = ("p1", "p2", "conv_id")
    columns = ["p1", "p2", "k1", "k2", *[c for c in nodes.columns if c not in ("p1", "p2", "k1", "k2")]]
    ordered = nodes.repartitionByRange(*key).sortWithinPartitions(*key).select(*columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    rows = stored(in_arrow(ordered, _next_siblings, f"{schema}, s1 long, s2 long").withColumn("at", F.monotonically_increasing_id()), "siblings")
    edge = F.struct("at", "p1", "p2", "k1", "k2")
    edges = rows.groupBy(F.shiftright("at", 33).alias("part")).agg(F.min(edge).alias("first"), F.max(edge).alias("last")).orderBy("part").collect()
    over = [(a["last"]["at"], b["first"]["k1"], b["first"]["k2"]) for a, b in zip(edges, edges[1:]) if a["last"]["p1"] is not None and a["last"][1:3] == b["first"][1:3]]
    # One row a partition at most.
    borders = F.broadcast(nodes.sparkSession.createDataFrame(over, "at long, o1 long, o2 long"))
    return rows.join(borders, "at", "left").select(*columns, F.coalesce("s1", "o1").alias("s1"), F.coalesce("s2", "o2").alias("s2"))


def _contracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the arcs of this task that follow each other: per arc the first of its stretch and its
    offset there; that first one has the stretch's length and what follows it. Columns: a1, a2, b1, b2, leaf, saved."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    arcs = pa.Table.from_batches(table).combine_chunks()
    n = arcs.num_rows
    a1, a2, b1, b2 = (pc.fill_null(arcs.column(j), 0).to_numpy() for j in range(4))
    ends = arcs.column(2).is_null().to_numpy()
    pairs = np.ascontiguousarray(np.stack([np.concatenate([a1, b1]), np.concatenate([a2, b2])], 1)).view("V16").ravel()
    found, where = np.unique(pairs, return_inverse=True)
    index = np.full(len(found), -1)
    index[where[:n]] = np.arange(n)
    follower = np.where(ends, -1, index[where[n:]])
    up, offset = np.arange(n), np.zeros(n, np.int64)
    inside = follower >= 0
    up[follower[inside]], offset[follower[inside]] = np.flatnonzero(inside), 1
    while True:
        offset, further = offset + offset[up], up[up]
        if (further == up).all():
            break
        up = further
    length, follow = np.zeros(n, np.int64), np.zeros(n, np.int64)
    tails = np.flatnonzero(~inside)
    length[up[tails]], follow[up[tails]] = offset[tails] + 1, tails
    open_end = (length == 0) | ends[follow]
    columns = [
        arcs.column(0).chunk(0), arcs.column(1).chunk(0), pa.array(a1[up]), pa.array(a2[up]), pa.array(offset), pa.array(length),
        pa.array(b1[follow], mask=open_end), pa.array(b2[follow], mask=open_end), arcs.column(4).chunk(0), arcs.column(5).chunk(0),
    ]
    yield from pa.Table.from_arrays(columns, ["a1", "a2", "h1", "h2", "off", "len", "n1", "n2", "leaf", "saved"]).to_batches(50_000)


def _coin(a1: str, a2: str, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), a1, a2).bitwiseAND(1) == 1


def rank_stretches(stretches: DataFrame, finish: int = FINISH) -> DataFrame:
    """Positions (a1, a2, pos) of the stretches (a1, a2, len, n1, n2) of one list.

    Random mates: a stretch whose coin shows heads is taken in by the one before it if that shows
    tails, so about a quarter goes in each round and all rounds together move a few times the list. The driver ranks the last
    `finish`, a bounded number.
    """
    spark, left, rounds = stretches.sparkSession, stretches, []
    while left.count() > finish:
        heads = _coin("a1", "a2", len(rounds))
        t = left.where(heads).select(*[F.col(c).alias(f"t_{c}") for c in left.columns])
        both = left.where(~heads).join(t, (F.col("n1") == F.col("t_a1")) & (F.col("n2") == F.col("t_a2")), "full")
        both = stored(both, "mates")
        rounds.append(both.where("a1 IS NOT NULL AND t_a1 IS NOT NULL").select(F.col("t_a1").alias("c1"), F.col("t_a2").alias("c2"), "a1", "a2", F.col("len").alias("off")))
        taken = F.col("t_a1").isNotNull()
        left = both.select(
            F.coalesce("a1", "t_a1").alias("a1"), F.coalesce("a2", "t_a2").alias("a2"), (F.coalesce("len", F.lit(0)) + F.coalesce("t_len", F.lit(0))).alias("len"),
            F.when(taken, F.col("t_n1")).otherwise(F.col("n1")).alias("n1"), F.when(taken, F.col("t_n2")).otherwise(F.col("n2")).alias("n2"),
        )
    rest = {(r["a1"], r["a2"]): (r["len"], (r["n1"], r["n2"])) for r in left.collect()}
    behind = {after for _, after in rest.values()}
    at, place, ranked = next((k for k in rest if k not in behind), None), 0, []
    while at in rest:
        ranked.append((*at, place))
        place, at = place + rest[at][0], rest[at][1]
    positions = spark.createDataFrame(ranked, "a1 long, a2 long, pos long")
    for taken in reversed(rounds):
        found = taken.join(positions, ["a1", "a2"]).select(F.col("c1").alias("a1"), F.col("c2").alias("a2"), (F.col("pos") + F.col("off")).alias("pos"))
        positions = stored(positions.unionByName(found), "positions")
    return positions


def tour_sums(nodes: DataFrame, finish: int = FINISH, per_task: int = PER_TASK) -> DataFrame:
    """Per node (k1, k2): n_leaves and saved, the sums of `leaf` and `saved` over its subtree.

    `nodes` has k1, k2, p1, p2, f1, f2 (first child), s1, s2 (next sibling), conv_id, depth, leaf and saved.
    """
    leave = F.col("k2") + 1
    enters = F.struct(
        F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.coalesce("f1", "k1").alias("b1"),
        F.when(F.col("f1").isNull(), leave).otherwise(F.col("f2")).alias("b2"), "leaf", "saved",
    )
    leaves = F.struct(
        F.col("k1").alias("a1"), leave.alias("a2"), F.coalesce("s1", "p1").alias("b1"),
        F.when(F.col("s1").isNull(), F.col("p2") + 1).otherwise(F.col("s2")).alias("b2"), F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"),
    )
    arcs = stored(nodes.select(F.xxhash64("conv_id", F.floor(F.col("depth") / CHAIN)).alias("chain"), F.explode(F.array(enters, leaves)).alias("arc")).select("chain", "arc.*"), "arcs")
    n = arcs.count()
    dealt = arcs.repartition(1 + n // per_task, "chain").select("a1", "a2", "b1", "b2", "leaf", "saved")
    schema = "a1 long, a2 long, h1 long, h2 long, off long, len long, n1 long, n2 long, leaf long, saved long"
    contracted = stored(in_arrow(dealt, _contracting, schema), "contracted")
    stretches = contracted.where("len > 0").select("a1", "a2", "len", "n1", "n2")
    heads = rank_stretches(stretches, finish).select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), "pos")
    placed = stored(contracted.join(heads, ["h1", "h2"]).select("a1", "a2", (F.col("pos") + F.col("off")).alias("pos"), "leaf", "saved"), "tour")
    stretch = max(STRETCH, -(-n // STRETCHES))
    number = F.floor(F.col("pos") / stretch)
    totals = placed.groupBy(number.alias("stretch")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).orderBy("stretch").collect()
    before = np.cumsum([[0, 0], *[[t["leaf"], t["saved"]] for t in totals]], axis=0)
    carried = [(t["stretch"], int(a), int(b)) for t, (a, b) in zip(totals, before)]
    # At most STRETCHES rows.
    carry = F.broadcast(nodes.sparkSession.createDataFrame(carried, "stretch long, leaf_before long, saved_before long"))
    sums = in_arrow(
        placed.withColumn("stretch", number).repartition("stretch").sortWithinPartitions("stretch", "pos").select("stretch", "a1", "a2", "leaf", "saved"),
        _summing, "stretch long, a1 long, a2 long, leaf long, saved long, own_leaf long, own_saved long",
    ).join(carry, "stretch")
    entering = F.col("a2").bitwiseAND(1) == 0
    total = {c: F.col(c) + F.col(f"{c}_before") for c in ("leaf", "saved")}
    return sums.groupBy(F.col("a1").alias("k1"), F.col("a2").bitwiseAND(-2).alias("k2")).agg(*[
        F.sum(F.when(entering, F.col(f"own_{c}") - total[c]).otherwise(total[c])).alias(name) for c, name in (("leaf", "n_leaves"), ("saved", "saved"))
    ])


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of the last two columns within each value of the first; their own values follow."""
    before, sums = None, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        start = np.maximum.accumulate(np.where(_changes(batch.column(0), before), np.arange(n), -1))
        columns = []
        for j in range(2):
            own = batch.column(3 + j).to_numpy()
            total = np.cumsum(own)
            run = total - np.where(start < 0, -sums[j], (total - own)[np.maximum(start, 0)])
            sums[j] = int(run[-1])
            columns.append(pa.array(run))
        before = batch.column(0)[-1].as_py()
        arrays = [*batch.columns[:3], *columns, *batch.columns[3:]]
        yield pa.RecordBatch.from_arrays(arrays, ["stretch", "a1", "a2", "leaf", "saved", "own_leaf", "own_saved"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, conv_id) as pieces of comma-joined ids."""
    kept: list[tuple[int, int, int, str]] = []
    key, ids = None, []

    def close() -> None:
        if ids:
            kept.append((*key, ids[0], ",".join(map(str, ids))))

    def rows() -> pa.RecordBatch:
        columns = list(zip(*kept)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["k1", "k2", "conv_id", "ids"])

    for batch in batches:
        for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) != key or len(ids) >= IDS:
                close()
                key, ids = (k1, k2), []
            ids.append(conv)
            if len(kept) > 10_000:
                yield rows()
                kept = []
    close()
    yield rows()


def _digesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per key, over the sorted pieces as a stream."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["k1", "k2", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node (k1, k2) that conversations end in: the digest of their ids, ascending and comma-joined.
    Tasks join ids into pieces over range partitions; only the pieces of one node meet in one task, as a stream."""
    ids = ends.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id").select("k1", "k2", "conv_id")
    pieces = in_arrow(ids, _pieces, "k1 long, k2 long, conv_id long, ids string")
    return in_arrow(pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id"), _digesting, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, finish: int = FINISH, per_task: int = PER_TASK) -> DataFrame:
    """Per node of the trie of all conversations: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    `turns` has conv_id, i (their order), h1, h2, size; `members` has each conv_id once, turnless conversations
    included, which belong to the root alone. A node's last text is that of turn `depth` of its smallest member.
    Equal conversations share all their nodes. Without conversations there is no node.
    """
    rows = stored(scan_turns(turns, "i").select("conv_id", "depth", "k1", "k2", "p1", "p2", "size"), "rows")
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    count = F.count(F.lit(1)).alias("n_convs")
    root = members.agg(F.min("conv_id").alias("conv_id"), count).where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), "conv_id", zero.alias("depth"), null.alias("p1"), null.alias("p2"), "n_convs", zero.alias("size")
    )
    inner = rows.groupBy("k1", "k2").agg(F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in ("depth", "p1", "p2", "size")], count)
    nodes = stored(root.unionByName(inner), "nodes")
    ends = rows.groupBy("conv_id").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("end"))
    ends = members.join(ends, "conv_id", "left").select("conv_id", F.coalesce("end.k1", zero).alias("k1"), F.coalesce("end.k2", zero).alias("k2"))
    child = F.struct("conv_id", "k1", "k2")
    parents = nodes.where("p1 IS NOT NULL").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children"), F.min(child).alias("first"))
    children = parents.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"))
    known = nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    leaf = (F.col("n_children") == 0).cast("long").alias("leaf")
    known = stored(with_siblings(known.select("*", leaf, ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))), "known")
    sums = tour_sums(known, finish, per_task)
    named = known.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size_of_parent"))
    facts = known.select("k1", "k2", "p1", "p2", "conv_id", "depth", "n_convs", "n_children")
    below = split_join(facts.where("p1 IS NOT NULL"), named, ["p1", "p2"], "size_of_parent").drop("size_of_parent")
    every = below.unionByName(facts.where("p1 IS NULL").withColumn("parent_conv_id", null))
    found = every.join(sums, ["k1", "k2"]).join(end_digests(ends), ["k1", "k2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame, finish: int = FINISH, per_task: int = PER_TASK) -> DataFrame:
    """The trie of conversations as they are: rows of conv_id, turn, role and text.

    NULL turns come first, NULL roles and texts count as empty, rows without a conv_id are left out, equal turns are
    ordered by a hash of their contents, repeated rows are turns of their own, texts of any length
    count whole, other columns are not read, and an empty table gives an empty result.
    """
    turns = stored(ordered_turns(conversations), "turns")
    return prefix_trie(turns, turns.select("conv_id").distinct(), finish, per_task)


def rebuilt_trie(conversations: DataFrame, finish: int = FINISH, per_task: int = PER_TASK) -> DataFrame:
    """The trie of the contract's rebuilt conversations; NULLs, ties and empty tables as in `conversation_trie`."""
    turns = stored(ordered_turns(conversations), "turns")
    members = stored(turns.select("conv_id").distinct(), "members")
    return prefix_trie(rebuilt(turns, members), members, finish, per_task)
