"""The prefix trie of conversations: which of them begin alike, and what sharing their beginnings saves.

Conversations are range-partitioned by their turns, so that a shard holds neighbours in lexicographic order. A shard lays them out as
matrices of turn numbers, padded with zeros, sorts the rows with numpy's lexsort, and marks where a column differs from
the row above; these marks, OR-accumulated along the row, are true where a node begins at that depth, and reduceat adds up every
node's rows. Matrices are 16 columns wide; rows that go on continue in the next one, grouped by the node they reached.

Nodes on the way to a shard's first or last row may go on in the next shard: only these are handed out as partial
sums and combined by key, a 128-bit hash of the turns down to the node. Sums over their subtrees take a logarithmic number of joins, which
doubles the distance that sums have travelled each time. Conversations of more than SEGMENT turns are cut into
segments, whose connecting nodes are combined in the same way, so no row grows with the length of a conversation.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallymart.operators.running import running_total
from tallymart.session import checkpointed, new_shared_path

SEGMENT = 1024
WIDTH = 16
# Turns of a shard, about; more turns make more shards.
SHARD_TURNS = 400_000
# Bytes of the conv_ids of one node that are written as one row.
CHUNK = 1 << 20
NO_IDS = hashlib.sha256(b"").hexdigest()
KEY = ["k1", "k2"]


def turn_ids(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id (128-bit hash of role and text, nulls as empty), chars (code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.char_length(text).cast("long").alias("chars"))


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``pos``, the turn's number in its conversation (from 1), by turn, nulls first, then by id; no task holds a whole conversation."""
    placed = checkpointed(running_total(turns, "chars", "conv_id", "turn", "id").select(*turns.columns, "position"))
    begin = placed.groupBy("conv_id").agg((F.min("position") - 1).alias("begin"))
    return placed.join(begin, "conv_id").select(*turns.columns, (F.col("position") - F.col("begin")).alias("pos"))


def rebuilt(turns: DataFrame, family: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, id, chars) of conversations begun as the first of their family, and the conv_ids left without any turn.

    A conversation takes the first ``crc32(conv_id) % heads`` turns of conversation ``conv_id - conv_id % family`` (all if it has fewer,
    none if there is none) and goes on with its own turns after as many.
    """
    turns = turns.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"))
    own = turns.groupBy("conv_id", "h").agg(F.max("pos").alias("n")).withColumn("base", F.expr(f"conv_id - conv_id % {family}"))
    head = turns.where((F.expr(f"conv_id % {family}") == 0) & (F.col("pos") < heads)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))).alias("head"))
    known = own.join(head, "base", "left").select(
        "conv_id", "h", "n", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,id:binary,chars:bigint>>")), F.lit(1), F.col("h")).alias("head"))
    known = checkpointed(known)
    first = known.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.id", "t.chars")
    rest = turns.where(F.col("pos") > F.col("h")).drop("h").join(known.select("conv_id", "h", F.size("head").alias("taken")), "conv_id").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "id", "chars")
    return first.union(rest), known.where((F.size("head") == 0) & (F.col("n") <= F.col("h"))).select("conv_id")


def segments(turns: DataFrame, turnless: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, seg, s1, s2 (hash of all turns before), more (whether another segment follows), w1, w2, chars (arrays).

    ``w1`` and ``w2`` hash a turn and its depth; the exclusive or of those down to a node is the node's key.
    """
    keyed = turns.select("conv_id", F.expr(f"(depth - 1) div {segment}").alias("seg"), "depth", F.xxhash64("id", "depth").alias("w1"),
                         F.xxhash64("depth", "id").alias("w2"), "chars")
    rows = keyed.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(F.struct("depth", "w1", "w2", "chars"))).alias("t"),
                                               F.bit_xor("w1").alias("x1"), F.bit_xor("w2").alias("x2"))
    rows = rows.select("conv_id", "seg", "x1", "x2", F.col("t.w1").alias("w1"), F.col("t.w2").alias("w2"), F.col("t.chars").alias("chars"))
    none = F.array().cast("array<bigint>")
    rows = rows.union(turnless.select("conv_id", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), none, none, none))
    path = new_shared_path(turns.sparkSession, "segments")
    rows.write.parquet(path)
    rows = turns.sparkSession.read.schema(rows.schema).parquet(path)
    # Segments but the last are full. Only conversations with several have a row here.
    own = Window.partitionBy("conv_id").orderBy("seg")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where((F.col("seg") > 0) | (F.size("w1") == segment)).select("conv_id", "seg", "x1", "x2").select(
        "conv_id", "seg", F.bit_xor("x1").over(before).alias("s1"), F.bit_xor("x2").over(before).alias("s2"), F.lead("seg").over(own).isNotNull().alias("more"))
    zero = F.lit(0).cast("long")
    return rows.join(long, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", F.coalesce("s1", zero).alias("s1"), F.coalesce("s2", zero).alias("s2"), F.coalesce("more", F.lit(False)).alias("more"), "w1", "w2", "chars")


class Shard:
    """The trie nodes of neighbouring segments, held in numpy columns."""

    def __init__(self, conv, seg, s1, s2, more, w1, w2, chars, begin, segment: int = SEGMENT, width: int = WIDTH):
        self.segment, self.width = segment, width
        self.conv, self.seg, self.s1, self.s2, self.more = conv, seg, s1, s2, more
        self.w1, self.w2, self.chars, self.begin = w1, w2, chars, begin
        self.size = np.diff(begin)
        self.turn = self._turn_numbers()
        self.nodes = {name: [] for name in ("depth", "k1", "k2", "p1", "p2", "parent", "conv", "n", "chars", "shared")}
        self.count, self.levels = 0, []
        self.ended: list[tuple[int, np.ndarray]] = []

    def _turn_numbers(self) -> np.ndarray:
        """Turns numbered from 1, equal ones alike."""
        order = np.lexsort((self.w2, self.w1))
        a, b = self.w1[order], self.w2[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(order) else np.zeros(0, bool)
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    def matrix(self, values: np.ndarray, rows: np.ndarray, at: int, width: int) -> np.ndarray:
        """``values`` of the turns ``at`` to ``at + width`` of rows, padded with zeros."""
        out = np.zeros((len(rows), width), values.dtype)
        for j in range(width):
            some = np.flatnonzero(self.size[rows] > at + j)
            out[some, j] = values[self.begin[rows[some]] + at + j]
        return out

    def shared_depth(self) -> np.ndarray:
        """Down to which depth the nodes of each row may be in other shards or segments; by w1 alone, as rows are partitioned."""
        head = self.matrix(self.w1, np.arange(len(self.conv)), 0, self.width)
        within = np.arange(self.width) < self.size[:, None]
        out = np.zeros(len(self.conv), np.int64)
        for edge in (0, -1):
            same = (head == head[edge]) & within & within[edge]
            same &= ((self.seg == self.seg[edge]) & (self.s1 == self.s1[edge]))[:, None]
            out = np.maximum(out, np.logical_and.accumulate(same, axis=1).sum(axis=1))
        return np.where((out == self.width) | self.more, np.iinfo(np.int64).max, out)

    def build(self) -> None:
        shared = self.shared_depth()
        order = np.lexsort((self.s2, self.s1, self.seg))
        change = np.r_[True, (self.seg[order][1:] != self.seg[order][:-1]) | (self.s1[order][1:] != self.s1[order][:-1]) | (self.s2[order][1:] != self.s2[order][:-1])]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(change)
        node = np.full(len(order), -1)
        k1, k2 = self.s1.copy(), self.s2.copy()
        top = np.flatnonzero(self.seg == 0)
        if len(top):
            zero = np.zeros(1, np.int64)
            self._add(depth=zero, k1=zero, k2=zero, p1=zero, p2=zero, parent=zero - 1, conv=self.conv[top].min(keepdims=True),
                      n=zero + len(top), chars=zero, shared=zero == 0)
            node[top] = 0
            empty = top[self.size[top] == 0]
            if len(empty):
                self.ended.append((0, np.sort(self.conv[empty])))
        rows = np.flatnonzero(self.size > 0)
        at = 0
        while len(rows):
            width = min(self.width, int(self.size[rows].max()) - at)
            turns = self.matrix(self.turn, rows, at, width)
            order = np.lexsort((self.conv[rows], *turns.T[::-1], group[rows]))
            rows, turns = rows[order], turns[order]
            marks = np.empty((len(rows), width + 1), bool)
            marks[0] = True
            marks[1:, 0] = group[rows][1:] != group[rows][:-1]
            marks[1:, 1:] = turns[1:] != turns[:-1]
            marks = np.logical_or.accumulate(marks, axis=1)
            for j in range(width):
                own = np.flatnonzero(turns[:, j])
                own_rows, begins = rows[own], np.flatnonzero(marks[own, j + 1])
                turn = self.begin[own_rows] + at + j
                p1, p2, parent = k1[own_rows[begins]], k2[own_rows[begins]], node[own_rows[begins]]
                k1[own_rows] ^= self.w1[turn]
                k2[own_rows] ^= self.w2[turn]
                node[own_rows] = self.count + np.cumsum(marks[own, j + 1]) - 1
                first = self.count
                self._add(depth=self.seg[own_rows[begins]] * self.segment + at + j + 1, k1=k1[own_rows[begins]], k2=k2[own_rows[begins]], p1=p1, p2=p2, parent=parent,
                          conv=np.minimum.reduceat(self.conv[own_rows], begins), n=np.diff(np.r_[begins, len(own)]),
                          chars=self.chars[turn[begins]], shared=(np.maximum.reduceat(shared[own_rows], begins) > at + j) | (parent < 0))
                last = np.flatnonzero((self.size[own_rows] == at + j + 1) & ~self.more[own_rows])
                if len(last):
                    at_node = node[own_rows[last]] - first
                    cuts = np.flatnonzero(np.r_[True, at_node[1:] != at_node[:-1]])
                    for n, ids in zip(at_node[cuts].tolist(), np.split(self.conv[own_rows[last]], cuts[1:])):
                        self.ended.append((first + n, ids))
            # Rows that go on, grouped by the node they are at.
            rows, at = rows[self.size[rows] > at + width], at + width
            group = node
        self.columns = {name: np.concatenate(parts) for name, parts in self.nodes.items()} if self.count else {}

    def _add(self, **columns) -> None:
        for name, values in columns.items():
            self.nodes[name].append(values)
        self.levels.append((self.count, self.count + len(columns["n"])))
        self.count += len(columns["n"])

    def summed(self) -> None:
        """children, leaves and saved of each node from its complete subtrees; whole for complete nodes, partial for shared ones."""
        c = self.columns
        children, leaves, saved = (np.zeros(self.count, np.int64) for _ in range(3))
        for lo, hi in reversed(self.levels):
            own = np.arange(lo, hi)[~c["shared"][lo:hi]]
            leaves[own[children[own] == 0]] = 1
            saved[own] += (c["n"][own] - 1) * c["chars"][own]
            up = c["parent"][own]
            inside = up >= 0
            np.add.at(children, up[inside], 1)
            np.add.at(leaves, up[inside], leaves[own[inside]])
            np.add.at(saved, up[inside], saved[own[inside]])
        c |= {"children": children, "leaves": leaves, "saved": saved}

    def rows(self, chunk: int = CHUNK):
        """Arrow batches: nodes (whole, or parts of shared ones), then the conv_ids that end at shared nodes, in pieces."""
        c = self.columns
        sha = np.full(self.count, NO_IDS, object)
        pieces = []
        for node, ids in self.ended:
            joined = ",".join(map(str, ids.tolist())).encode()
            if not c["shared"][node]:
                sha[node] = hashlib.sha256(joined).hexdigest()
                continue
            for lo in range(0, len(joined), chunk):
                pieces.append((node, int(ids[0]), lo, joined[lo:lo + chunk]))
        inside = (c["parent"] >= 0) & ~c["shared"]
        inside[inside] = ~c["shared"][c["parent"][inside]]
        parent_conv = pa.array(c["conv"][np.maximum(c["parent"], 0)], mask=~inside)
        table = [pa.array(np.where(c["shared"], 1, 0).astype(np.int32)), *(pa.array(c[k]) for k in ("depth", "k1", "k2", "p1", "p2", "conv")),
                 parent_conv, *(pa.array(c[k]) for k in ("n", "chars", "children", "leaves", "saved")), pa.array(sha, pa.string()), pa.nulls(self.count, pa.binary())]
        whole = pa.RecordBatch.from_arrays(table, NAMES)
        for lo in range(0, self.count, 50_000):
            yield whole.slice(lo, 50_000)
        for node, first, at, text in pieces:
            values = {"kind": 2, "k1": c["k1"][node], "k2": c["k2"][node], "conv": first, "n": at, "ids": text}
            yield pa.RecordBatch.from_arrays([pa.array([values.get(k)], f.type) for k, f in zip(NAMES, table)], NAMES)


NAMES = ["kind", "depth", "k1", "k2", "p1", "p2", "conv", "parent_conv", "n", "chars", "children", "leaves", "saved", "sha", "ids"]
PARTS = "kind int, " + ", ".join(f"{n} long" for n in NAMES[1:13]) + ", sha string, ids binary"


def _shard(batches, segment: int, width: int, chunk: int):
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    column = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
    lists = [table.column(n).combine_chunks() for n in ("w1", "w2", "chars")]
    begin = np.r_[0, np.cumsum(lists[0].value_lengths().to_numpy())]
    shard = Shard(*(column(n) for n in ("conv_id", "seg", "s1", "s2", "more")), *(v.flatten().to_numpy() for v in lists), begin, segment, width)
    shard.build()
    shard.summed()
    yield from shard.rows(chunk)


def _digests(batches):
    """SHA-256 of pieces that come in order, node by node; a piece is held at a time."""
    node, digest, at = None, None, 0
    done = []
    for batch in batches:
        for k1, k2, at, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (k1, k2) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256()
            elif at == 0:
                digest.update(b",")
            digest.update(ids)
    if node is not None:
        done.append((*node, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))], [*KEY, "sha"])


def subtree_sums(nodes: DataFrame, rounds: int) -> DataFrame:
    """k1, k2, leaves, saved, summed over each node's subtree; every round doubles how far sums have come."""
    for _ in range(rounds):
        up = nodes.where("p1 IS NOT NULL").groupBy("p1", "p2").agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved")).toDF("k1", "k2", "more", "more_saved")
        further = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("p1").alias("g1"), F.col("p2").alias("g2"))
        nodes = checkpointed(nodes.join(up, KEY, "left").join(further, ["p1", "p2"], "left").select(
            *KEY, F.col("g1").alias("p1"), F.col("g2").alias("p2"), (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")))
    return nodes.select(*KEY, "leaves", "saved")


def trie(parts: DataFrame) -> DataFrame:
    """One row per node from the rows of all shards."""
    own = parts.where("kind = 1").groupBy(*KEY).agg(
        *(F.max(c).alias(c) for c in ("depth", "p1", "p2", "chars")), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")))
    own = checkpointed(own)
    deepest = own.agg(F.max("depth")).first()[0] or 0
    top = F.col("depth") == 0
    below = own.where(~top).groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("below"))
    own = own.join(below, KEY, "left").withColumn("children", F.col("children") + F.coalesce("below", F.lit(0)))
    own = checkpointed(own.select(
        *KEY, "depth", F.when(~top, F.col("p1")).alias("p1"), F.when(~top, F.col("p2")).alias("p2"), "conv", "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved")))
    sums = subtree_sums(own.select(*KEY, "p1", "p2", "leaves", "saved"), math.ceil(math.log2(deepest + 1)))
    pieces = parts.where("kind = 2").select(*KEY, "n", "ids", "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv", "n").select(*KEY, "n", "ids")
    sha = pieces.mapInArrow(_digests, "k1 long, k2 long, sha string")
    named = own.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv"))
    shared = own.drop("leaves", "saved").join(sums, KEY).join(sha, KEY, "left").join(named, ["p1", "p2"], "left").withColumn("sha", F.coalesce("sha", F.lit(NO_IDS)))
    whole = parts.where("kind = 0")
    under = whole.where("parent_conv IS NULL").drop("parent_conv").join(named, ["p1", "p2"])
    columns = [F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
               F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256")]
    return whole.where("parent_conv IS NOT NULL").select(columns).union(under.select(columns)).union(shared.select(columns))


def nodes(turns: DataFrame, turnless: DataFrame, shard_turns: int = SHARD_TURNS, segment: int = SEGMENT, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """The trie of conversations given as turns (conv_id, depth from 1 without gaps, id, chars) and conv_ids without turns; see ``conversation_trie``."""
    spark = turns.sparkSession
    rows = segments(turns, turnless, segment)
    total = rows.agg(F.sum(F.size("w1") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    # Equal beginnings stay together, copies go on by conv_id.
    place = ["seg", "s1", F.slice("w1", 1, width), "conv_id"]

    def run(batches):
        yield from _shard(batches, segment, width, chunk)

    path = new_shared_path(spark, "trie_parts")
    rows.repartitionByRange(shards, *place).sortWithinPartitions(*place).mapInArrow(run, PARTS).write.parquet(path)
    return trie(spark.read.schema(PARTS).parquet(path))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, nulls first, equal ones by the hash of role and text; null roles and texts are empty; rows without a conv_id belong to
    no conversation. Other columns are ignored. A turn is told by its role and text, so copies of a conversation share all their nodes.
    No conversations give no nodes.
    """
    return nodes(*rebuilt(numbered(turn_ids(conversations))))
