"""Near-duplicate vectors by lattice hashing: random projections decoded to points of the E8 lattice.

A random rotation turns the unit vectors, and each run of eight rotated coordinates is a table. Vectors with cosine
c or more are at most d = sqrt(2 - 2c) apart, so in at least one of the m tables their projections are at most d / sqrt(m) apart, and the
middle between those two projections is at most half of that from both. Each vector is therefore entered, in every table, in the cell
of its own lattice point and in all neighbouring cells that come within that half distance: a linked pair always meets in the cell of its middle.
There the cosine is verified, and the pair is counted only in its first such table, so nothing is counted twice
and no list of pairs is ever written.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.components import components, unite
from tallymart.session import checkpointed

# Scaled so that the half distance is this part of the lattice's unit (its shortest vectors have length sqrt 2).
REACH = 0.15
# Vectors of one cell that one task compares at once; larger cells are dealt out as pairs of slices.
CELL_ROWS = 1_024
SLACK = 1e-6


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all entries +-1/2 with an even number of minus signs."""
    whole = [np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
    half = [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


ROOTS = roots()


def decode(points: np.ndarray) -> np.ndarray:
    """The nearest E8 points, doubled so that they are whole numbers. E8 is D8 and D8 shifted by one half."""
    def nearest_d8(x):
        r = np.rint(x)
        odd = (r.sum(1) % 2) != 0
        gap = x - r
        at = np.abs(gap).argmax(1)
        rows = np.arange(len(x))
        r[rows[odd], at[odd]] += np.where(gap[rows[odd], at[odd]] >= 0, 1, -1)
        return r

    a, b = nearest_d8(points), nearest_d8(points - 0.5) + 0.5
    closer = ((points - a) ** 2).sum(1) <= ((points - b) ** 2).sum(1)
    return np.rint(2 * np.where(closer[:, None], a, b)).astype(np.int64)


def neighbours() -> np.ndarray:
    """The 2,400 lattice points at distance sqrt 2 or 2 from the origin: the shortest vectors and sums of two at a right angle."""
    sums = (ROOTS[:, None, :] + ROOTS[None, :, :]).reshape(-1, 8)
    sums = sums[np.abs((sums * sums).sum(1) - 4) < 1e-9]
    return np.concatenate([ROOTS, np.unique(np.rint(2 * sums).astype(np.int64), axis=0) / 2])


NEIGHBOURS = neighbours()
LENGTHS = np.sqrt((NEIGHBOURS ** 2).sum(1))


def cells_within(points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, doubled lattice point) for all lattice points whose cell may come within ``reach`` (at most 0.2) of the row's point.

    A point at distance <= reach from a point z of the cell of 0 can only lie in the cell of v if
    v.z + reach |v| >= |v|^2 / 2. As |z| <= 1 in a cell, no v longer than 2 can meet this.
    """
    own = decode(points)
    near = (points - own / 2) @ NEIGHBOURS.T >= LENGTHS ** 2 / 2 - reach * LENGTHS - SLACK
    row, at = np.nonzero(near)
    rows = np.concatenate([np.arange(len(points)), row])
    return rows, np.concatenate([own, own[row] + np.rint(2 * NEIGHBOURS).astype(np.int64)[at]])


def rotation(dims: int, seed: int = 8) -> np.ndarray:
    """A random rotation of ``dims`` coordinates, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


class Tables:
    """The tables for vectors of one length."""

    def __init__(self, dims: int, cosine: float):
        self.dims, self.cosine = dims, cosine
        self.padded = -(-dims // 8) * 8
        self.tables = self.padded // 8
        self.half = math.sqrt(2 - 2 * cosine) / math.sqrt(self.tables) / 2
        self.scale = self.half / REACH
        self.rotation = rotation(self.padded)

    def points(self, unit: np.ndarray) -> np.ndarray:
        """Rows x tables x 8, in lattice units."""
        wide = np.zeros((len(unit), self.padded))
        wide[:, :self.dims] = unit
        return (wide @ self.rotation).reshape(len(unit), self.tables, 8) / self.scale


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    top = np.abs(vectors).max(1, keepdims=True)
    vectors = vectors / top
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


_tables: dict = {}


def _tables_for(dims: int, cosine: float) -> Tables:
    if (dims, cosine) not in _tables:
        _tables[dims, cosine] = Tables(dims, cosine)
    return _tables[dims, cosine]


def _by_length(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of a list column, one for each length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, begin = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    return [(rows := np.flatnonzero(lengths == n), flat[begin[rows][:, None] + np.arange(n)]) for n in np.unique(lengths)]


def _entries(cosine: float):
    """Arrow function: a row per (vector, table, cell)."""
    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                column = pa.concat_arrays([batch.column(2)])
                for rows, matrix in _by_length(column):
                    tables = _tables_for(matrix.shape[1], cosine)
                    points = tables.points(unit_rows(matrix))
                    for t in range(tables.tables):
                        r, cells = cells_within(points[:, t], REACH)
                        r = pa.array(rows[r])
                        cell = pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(16), len(r), [None, pa.py_buffer(np.ascontiguousarray(cells.astype(np.int16)).tobytes())]).cast(pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(r), batch.column(1).take(r), pa.array(np.full(len(r), matrix.shape[1] * 1_000 + t)), cell],
                            ["class_id", "label", "place", "cell"])

    return run


CELL = ["label", "place", "cell"]


def _verify(cosine: float):
    """Arrow function over whole (slices of) cells: partial link counts and links that connect, per class."""
    def pairs_of(unit, start, stop, side):
        """Index pairs of rows in the same run with cosine >= threshold. side: -1 all with all, else 0 with 1."""
        for s, e in zip(start, stop):
            if e - s < 2:
                continue
            x, sides = unit[s:e], side[s:e]
            for lo in range(0, e - s, 512):
                near = x[lo:lo + 512] @ x.T >= cosine
                near &= np.arange(e - s)[None, :] > np.arange(lo, min(lo + 512, e - s))[:, None]
                if sides[0] >= 0:
                    near &= sides[lo:lo + 512, None] != sides[None, :]
                i, j = np.nonzero(near)
                yield i + s + lo, j + s

    def small_pairs(unit, run_end):
        """The same for short runs, all at once: each row with the one k further on."""
        k = 1
        at = np.flatnonzero(run_end > np.arange(len(unit)) + 1)
        while len(at):
            near = np.einsum("ij,ij->i", unit[at], unit[at + k]) >= cosine
            yield at[near], at[near] + k
            k += 1
            at = at[run_end[at] > at + k]

    def work(rows):
        klass, place, cell, n, vector, run, side = rows
        parent, count = np.arange(len(klass)), np.zeros(len(klass), np.int64)
        for at, matrix in _by_length(vector):
            tables = _tables_for(matrix.shape[1], cosine)
            unit = unit_rows(matrix)
            r = run[at]
            start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            stop = np.r_[start[1:], len(r)]
            long = stop - start > 48
            whole_end = np.repeat(stop, stop - start)
            alone = np.repeat(~long & (side[at][start] < 0), stop - start)
            end = np.where(alone, whole_end, 0)
            own = long | (side[at][start] >= 0)
            for i, j in itertools.chain(small_pairs(unit, end), pairs_of(unit, start[own], stop[own], side[at])):
                if not len(i):
                    continue
                a, b = tables.points(unit[i]), tables.points(unit[j])
                table = place[at][i] % 1_000
                close = ((a - b) ** 2).sum(2) <= (2 * REACH + SLACK) ** 2
                first = close.argmax(1) == table
                i, j, table = i[first], j[first], table[first]
                middle = (a[first][np.arange(len(i)), table] + b[first][np.arange(len(i)), table]) / 2
                here = (decode(middle).astype(np.int16).view("V16").ravel() == cell[at][i]) if len(i) else np.zeros(0, bool)
                i, j = at[i[here]], at[j[here]]
                np.add.at(count, i, n[j])
                np.add.at(count, j, n[i])
                parent = unite(parent, i, j)
        some = np.flatnonzero((count > 0) | (parent != np.arange(len(parent))))
        return pa.RecordBatch.from_arrays(
            [pa.array(klass[some]), pa.array(count[some]), pa.array(klass[parent[some]])], ["class_id", "links", "with"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 4_000:
                continue
            runs = _runs(held)
            begin = int(np.argmax(runs == runs[-1]))
            if begin:
                yield work(_columns(held.slice(0, begin), runs[:begin]))
                held = held.slice(begin)
        if held is not None and held.num_rows:
            yield work(_columns(held, _runs(held)))

    return run


def _runs(table: pa.Table) -> np.ndarray:
    """Number of the cell (or pair of slices) of each row; rows of a cell follow each other."""
    new = np.zeros(table.num_rows, bool)
    for name in ("label", "place", "pair"):
        v = table.column(name).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    v = np.array(table.column("cell").to_pylist(), "V16")
    new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def _columns(table: pa.Table, runs: np.ndarray):
    take = lambda name: table.column(name).to_numpy()
    return (take("class_id"), take("place"), np.array(table.column("cell").to_pylist(), "V16"), take("n"),
            pa.concat_arrays(table.column("vector").chunks), runs, take("side"))


def near_vectors(vectors: DataFrame, cosine: float = 0.98, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null, their lengths are equal and their cosine is at least ``cosine``.
    Vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label, are linked with
    nothing: n_links 0, their own vec_id as component. Labels may be of any type that has equality and a text form. Equal vectors are compared once and counted as often as they occur; rows that
    repeat a vec_id are vectors of their own; a null vec_id is counted as a link but names no component (kept is null there).
    Other columns are ignored.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    good = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    keys = ["label", "digest", "vector"]
    valid = rows.where("good").withColumn("digest", F.xxhash64("vector"))
    # Equal vectors of a label are a class; it is numbered, since a vec_id may name different vectors.
    classes = checkpointed(
        valid.groupBy(*keys).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")).withColumn("class_id", F.monotonically_increasing_id()))
    entries = classes.select("class_id", F.col("label").cast("string").alias("label"), "vector").mapInArrow(
        _entries(cosine), "class_id long, label string, place long, cell binary")
    # Vectors are only sent to cells where they have company.
    shared = checkpointed(entries.groupBy(*CELL).count().where("count > 1"))
    # The rows of a large cell go to all pairs of slices that hold their slice.
    slices = F.ceil(F.col("count") / cell_rows).cast("long")
    spread = entries.join(shared.withColumn("slices", slices).drop("count"), CELL).withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("slices")))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    spread = spread.select(
        "class_id", *CELL, (F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).alias("pair"),
        F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"))
    dealt = spread.join(classes.select("class_id", "n", "vector"), "class_id")
    dealt = dealt.repartition(*CELL, "pair").sortWithinPartitions(*CELL, "pair", "class_id")
    found = checkpointed(dealt.select("class_id", *CELL, "n", "vector", "pair", "side").mapInArrow(
        _verify(cosine), "class_id long, links long, with long"))
    linked = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("class_id").alias("a"), F.col("with").alias("b")))
    result = classes.join(linked, "class_id", "left").join(named, F.col("class_id") == F.col("node"), "left")
    result = result.withColumn("root", F.coalesce("component", "class_id"))
    least = result.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    result = result.join(least, "root").select(
        *keys, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id")
    joined = valid.select("vec_id", *keys).join(result, keys)
    alone = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.select("vec_id", "n_links", "component_id").union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
