"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has 64 bits, one per bit of the XXH64 hashes of its word shingles. Distinct fingerprints
are sorted, which makes every prefix range a trie node; pairs of nodes are traversed together from the
top, each step adds the bit in which the two sides differ, and a pair is dropped as soon as it differs in
more bits than allowed.

How the tries are spread: two fingerprints with at most b differing bits agree on at least one of b+1 blocks
of bits. The fingerprint is rotated so that each block in turn comes first, and that block is traversed
without any error, so the tries below it are independent cells. A cell with too many fingerprints is
cut into its pairs of child nodes a few bits further down, with the same pruning, until all are small.

``one_of_each`` and ``near_copies`` look for a given share of equal shingles instead of a few bits, which no number of bits tells for certain: they join
texts on their rare shingles, and compare all shingles of the pairs found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import unused, utf8
from tallymart.llm.components import components, unite
from tallymart.session import checkpointed, shuffles_freed

BITS = 64
# Fingerprints that one task compares at once; larger cells are cut.
CELL_ROWS = 4_096
# Bits consumed by one cut.
CUT_BITS = 6
# Node pairs that are expanded together.
FRONTIER = 400_000
# Rows behind each row that are compared before all pairs of a cell.
NEXT_ROWS = 2
# Rows of a shingle that one task compares at once.
PRINT_CELL_ROWS = 20_000
# Parities of the shingle hashes of a text; a power of two.
PARITY_BITS = 256
# Bits of a shingle's hash that name its counter, and how many counters are added up together.
COUNTER_BITS = 19
COUNTERS_ADDED = 4_096
# Pairs of rows that are compared together, and proposed pairs that a task remembers.
BLOCK_PAIRS = 50_000
SEEN_PAIRS = 100_000
# Ends of links that are broadcast, and links of one text that are settled in one task.
BROADCAST_ENDS = 200_000
# Keys of dropped documents that are broadcast; beyond this the documents are shuffled to them.
BROADCAST_KEYS = 200_000
HUB_LINKS = 1_000


def fingerprint(text: bytes, shingle_words: int = 3, seed: int = 42) -> int:
    """SimHash of a text: A-Z lower-cased, words between ASCII blanks, shingles with repeats, a bit is set
    if it is set in over half the hashes. Without words: zero."""
    hashes = shingle_hashes(text, shingle_words, seed)
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at:at + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def shingle_hashes(text: bytes, shingle_words: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; fewer words than a shingle has are one shingle, no words are none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    n = max(1, len(words) - shingle_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    width = min(shingle_words, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[:n], stops[width:])), "<u8", n)


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as signed long) for every row."""
    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(run, "doc_id long, fp long")


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the blocks, one more than the bits that may differ."""
    cuts = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _cells(prints: DataFrame, max_bits: int) -> DataFrame:
    """Each fingerprint once per rotation: rot, depth (bits consumed), pa <= pb (the two node prefixes), key."""
    rows = [
        F.struct(
            F.lit(i).alias("rot"), F.lit(width).alias("depth"),
            F.expr(f"shiftleft(fp, {lo}) | {f'shiftrightunsigned(fp, {BITS - lo})' if lo else '0L'}").alias("key"))
        for i, (lo, width) in enumerate(_blocks(max_bits))
    ]
    cells = prints.select(F.inline(F.array(*rows)))
    prefix = F.expr("shiftrightunsigned(key, 64 - depth)")
    return cells.select("rot", "depth", prefix.alias("pa"), prefix.alias("pb"), "key")


CELL = ["rot", "depth", "pa", "pb"]


def _cut(cells: DataFrame, max_bits: int) -> DataFrame:
    """The cells replaced by the pairs of their child nodes CUT_BITS further down that are within the budget."""
    masks = [m for m in range(2 ** CUT_BITS) if bin(m).count("1") <= max_bits]
    own = cells.withColumn("own", F.expr(f"shiftrightunsigned(key, 64 - depth - {CUT_BITS})"))
    own = own.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    mine = F.expr(f"shiftrightunsigned(own, {CUT_BITS})")
    facing = F.when(mine == F.col("pa"), F.col("pb")).otherwise(F.col("pa"))
    other = F.shiftleft(facing, CUT_BITS).bitwiseOR(
        F.col("own").bitwiseAND(F.lit(2 ** CUT_BITS - 1)).bitwiseXOR(F.col("mask")))
    own = own.withColumn("other", other)
    return own.where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= max_bits).select(
        "rot", (F.col("depth") + CUT_BITS).alias("depth"), F.least("own", "other").alias("pa"),
        F.greatest("own", "other").alias("pb"), "key")


def join_sorted(key: np.ndarray, cell_start: np.ndarray, split: np.ndarray, depth: np.ndarray, errors: np.ndarray,
                max_bits: int) -> np.ndarray:
    """Smallest connected row for every row of cells that lie one after the other, each sorted by ``key``.

    Cell i has the rows cell_start[i]..cell_start[i+1]; its second node starts at split[i], or there
    is only one node, joined with itself, where split[i] is cell_start[i]. ``depth`` bits are consumed and
    ``errors`` of them differ.
    """
    parent = np.arange(len(key))
    lo, hi = cell_start[:-1], cell_start[1:]
    alone = split == lo
    first = np.stack([lo, np.where(alone, hi, split), split, hi, errors, depth])
    stack = [first[:, (first[1] > first[0]) & (first[3] > first[2])]]
    while stack:
        pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            middle = pairs.shape[1] // 2
            stack += [pairs[:, :middle], pairs[:, middle:]]
            continue
        a0, a1, b0, b1, err, bit = pairs
        same = a0 == b0
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        leaf = single & ~same
        if leaf.any():  # two single fingerprints: the rest of the way in one step
            x, y = a0[leaf], b0[leaf]
            ok = np.bitwise_count(key[x] ^ key[y]) <= max_bits
            parent = unite(parent, x[ok], y[ok])
        done = leaf | (single & same)
        # Equal keys at the end of the trie: all rows of both nodes are connected.
        ended = ~done & (bit >= BITS)
        if ended.any():
            for p, q, r, s in zip(a0[ended], a1[ended], b0[ended], b1[ended]):
                rows = np.unique(np.r_[p:q, r:s])
                parent = unite(parent, rows[1:], rows[:-1])
        keep = ~(done | ended)
        if not keep.any():
            continue
        a0, a1, b0, b1, err, bit, same = (v[keep] for v in (a0, a1, b0, b1, err, bit, same))
        am, bm = _middle(key, a0, a1, bit), _middle(key, b0, b1, bit)
        children = [
            (a0, am, b0, bm, err, same | True),
            (am, a1, bm, b1, err, same | True),
            (a0, am, bm, b1, err + 1, same | True),
            (am, a1, b0, bm, err + 1, ~same),  # for a node with itself the same as the one before
        ]
        out = [np.stack([p, q, r, s, e, bit + 1])[:, ok & (e <= max_bits) & (q > p) & (s > r)]
               for p, q, r, s, e, ok in children]
        stack.append(np.concatenate(out, axis=1))
    return parent


def _middle(key, lo, hi, bit):
    """First row of each range whose bit (from the top) is set; a binary search in all ranges at once."""
    shift = (BITS - 1 - bit).astype(np.uint64)
    left, right = lo.copy(), hi.copy()
    while True:
        open_ = left < right
        if not open_.any():
            return left
        mid = (left + right) >> 1
        at = np.minimum(mid, len(key) - 1)
        one = ((key[at] >> shift) & np.uint64(1)).astype(bool)
        right = np.where(open_ & one, mid, right)
        left = np.where(open_ & ~one, mid + 1, left)


def _links_of(rows, max_bits: int):
    """Links (two unrotated fingerprints) that connect what is connected within the given whole cells."""
    rot, depth, pa_, pb, key = rows
    pa_, pb, key = (v.view(np.uint64) for v in (pa_, pb, key))
    order = np.lexsort((key, pb, pa_, depth, rot))
    rot, depth, pa_, pb, key = (v[order] for v in (rot, depth, pa_, pb, key))
    new = np.ones(len(key), bool)
    new[1:] = (rot[1:] != rot[:-1]) | (depth[1:] != depth[:-1]) | (pa_[1:] != pa_[:-1]) | (pb[1:] != pb[:-1])
    starts = np.flatnonzero(new)
    own = key >> (BITS - depth).astype(np.uint64)
    in_first = np.add.reduceat((own == pa_).astype(np.int64), starts)
    self_pair = pa_[starts] == pb[starts]
    split = np.where(self_pair, starts, starts + in_first)
    errors = np.bitwise_count(pa_[starts] ^ pb[starts]).astype(np.int64)
    parent = join_sorted(key, np.r_[starts, len(key)], split, depth[starts].astype(np.int64), errors, max_bits)
    linked = np.flatnonzero(parent != np.arange(len(key)))
    back = np.array([lo for lo, _ in _blocks(max_bits)], np.uint64)[rot[linked]]

    def unrotated(k):
        left = (np.uint64(BITS) - back) % np.uint64(BITS)
        return np.where(back == 0, k, (k >> back) | (k << left)).view(np.int64)

    return unrotated(key[linked]), unrotated(key[parent[linked]])


def links(prints: DataFrame, max_bits: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly what pairs of distinct ``fp`` with at most ``max_bits`` differing bits
    connect. Within a cell only a spanning forest is emitted, so there are at most as many links as rows."""
    cells, deepest = _cells(prints, max_bits), max(width for _, width in _blocks(max_bits))
    while deepest + CUT_BITS <= BITS:
        large = cells.groupBy(*CELL).count().where(F.col("count") > cell_rows).drop("count")
        large = checkpointed(large)
        if large.isEmpty():
            break
        # Rows of large cells are cut, the others stay as they are.
        marked = cells.join(large.withColumn("large", F.lit(True)), CELL, "left")
        cells = checkpointed(
            marked.where(F.col("large").isNull()).drop("large")
            .union(_cut(marked.where("large").drop("large"), max_bits)))
        deepest += CUT_BITS

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
            # The last cell may go on in the next batch.
            last = np.ones(len(held[0]), bool)
            for column in held[:4]:
                last &= column == column[-1]
            begin = int(np.argmax(last))
            if begin > 0 and len(held[0]) >= 20_000:
                yield from emit([c[:begin] for c in held])
                held = [c[begin:] for c in held]
        if held is not None:
            yield from emit(held)

    def emit(rows):
        a, b = _links_of(rows, max_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = cells.repartition(*CELL).sortWithinPartitions(*CELL)
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Equal fingerprints are one class, so a group of copies costs one fingerprint. A null or empty text has
    fingerprint zero and is linked like any other; rows that repeat a doc_id keep a row each; a null doc_id
    takes part but never names a component (null where nothing else is in it). Other columns are ignored.
    """
    rows = checkpointed(fingerprints(docs, shingle_words))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(classes.select("fp"), max_bits))
    named = classes.join(found, classes.fp == found.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    named = checkpointed(named)
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def distinct_shingles(text: bytes, shingle_words: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    return np.unique(shingle_hashes(text, shingle_words, seed))


def print_of(hashes: np.ndarray) -> int:
    """SimHash of a set of shingles, as signed long: a bit is set if it is set in over half of them."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def set_number(hashes: np.ndarray) -> int:
    """A number for a set of shingles, as signed long: texts with equal sets have equal numbers."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 42)).astype(np.int64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common shingles of two texts, from all their distinct hashes (ascending, 64 bits)."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def prefix_length(n, similarity: float):
    """How many of a text's ``n`` shingles, the first in an order common to all texts, must hold one that any near copy has among its own first."""
    return n - np.ceil(similarity * n - 1e-6).astype(np.int64) + 1


def parities(hashes: np.ndarray) -> bytes:
    """PARITY_BITS bits, each whether an odd number of hashes falls on it. Two texts differ in at least as many shingles as parities."""
    return np.packbits(np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1 == 1).tobytes()


def counter_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(BITS - COUNTER_BITS)).astype(np.int64)


def shingle_counts(texts: DataFrame, shingle_words: int) -> np.ndarray:
    """How many shingles of all texts fall on each counter; a text's shingle counts once, shingles with the same upper bits count together.

    The counts decide the order in which a text's shingles are looked at, frequent ones last.
    """
    def count(batches):
        counts = np.zeros(2 ** COUNTER_BITS, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                held = [distinct_shingles(t, shingle_words) for t in batch.column(0).slice(lo, 1_000).to_pylist()]
                counts += np.bincount(counter_of(np.concatenate(held)), minlength=len(counts))
        if counts.any():
            parts = counts.reshape(-1, COUNTERS_ADDED)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[part] = sums.get(part, 0) + np.frombuffer(raw.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])

    kind = "part long, counts binary"
    total = np.zeros((2 ** COUNTER_BITS // COUNTERS_ADDED, COUNTERS_ADDED), np.int64)
    for part, raw in texts.mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).collect():
        total[part] = np.frombuffer(raw, np.int64)
    return total.reshape(-1)


def _rarest_first(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashes by the counts of their counters, then by themselves."""
    return hashes[np.lexsort((hashes, counts[counter_of(hashes)]))]


def _candidates(rows, similarity: float, apart: np.ndarray, only_next: int = 0):
    """Pairs of rows of one cell (n, place of the cell's shingle, parities; by n) that can be near copies, in blocks; ``only_next``: rows that near only."""
    n, place, bits = rows
    factor, after, last = similarity / (1 + similarity), n - place, len(n)
    # Partners are not longer than this; a longer one has too few shingles in common.
    stop = np.searchsorted(n, np.floor(n / similarity + 1e-6), side="right")
    if only_next:
        stop = np.minimum(stop, np.arange(last) + 1 + only_next)
    lo = 0
    while lo < last:
        wide = np.cumsum(stop[lo:lo + BLOCK_PAIRS] - np.arange(lo, min(lo + BLOCK_PAIRS, last)) - 1)
        hi = lo + max(1, int(np.searchsorted(wide, BLOCK_PAIRS, side="right")))
        many = stop[lo:hi] - np.arange(lo, hi) - 1
        x = np.repeat(np.arange(lo, hi), many)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
        both = n[x] + n[y]
        # If the cell's shingle is the first one in common, all others come after it in both.
        ok = (apart[x] != apart[y]) & (np.minimum(after[x], after[y]) >= factor * both - 1e-6)
        x, y, both = x[ok], y[ok], both[ok]
        ok = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64) <= (1 - 2 * factor) * both + 1e-6
        yield x[ok], y[ok]
        lo = hi


def _proposed(cells: DataFrame, similarity: float, only_next: int = 0) -> DataFrame:
    """Distinct pairs ``a`` < ``b`` of rows of a cell (token, pair, id, n, place, bits, component) that can be near copies and are not yet connected."""
    names = ["token", "pair"]

    def emit(table):
        token, pair, number, n, place, component = (table.column(k).to_numpy() for k in ("token", "pair", "id", "n", "place", "component"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64)
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (pair[1:] != pair[:-1])
        starts = np.r_[np.flatnonzero(new), len(token)]
        seen = set()
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if hi - lo < 2 or (component[lo:hi] == component[lo]).all():
                continue
            own = slice(lo, hi)
            for x, y in _candidates((n[own], place[own], bits[own]), similarity, component[own], only_next):
                a, b = np.minimum(number[own][x], number[own][y]), np.maximum(number[own][x], number[own][y])
                # Copies share many shingles, so the same pairs come up in many cells of a task.
                pairs = [p for p in zip(a.tolist(), b.tolist()) if p not in seen]
                if len(seen) > SEEN_PAIRS:
                    seen.clear()
                seen.update(pairs)
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*pairs)], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            # The last cell may go on in the next batch.
            last = np.ones(held.num_rows, bool)
            for k in names:
                column = held.column(k).to_numpy()
                last &= column == column[-1]
            begin = int(np.argmax(last))
            if begin > 0 and held.num_rows >= 20_000:
                yield from emit(held.slice(0, begin))
                held = held.slice(begin)
        if held is not None and held.num_rows:
            yield from emit(held)

    dealt = cells.select("token", "pair", "id", "n", "place", "bits", "component").repartition(*names).sortWithinPartitions(*names, "n", "id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _sliced(shared: DataFrame, cell_rows: int) -> DataFrame:
    """The rows of each shingle as cells; a shingle with more than ``cell_rows`` rows (``rows``) is dealt out as pairs of slices, so that no pair is lost."""
    slices = F.ceil(F.col("rows") / cell_rows).cast("long")
    spread = shared.withColumn("slices", slices).withColumn("own", F.pmod(F.xxhash64("id"), F.col("slices")))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    return spread.withColumn("pair", F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).drop("slices", "own", "other", "rows")


def verified(links: DataFrame, classes: DataFrame, texts: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """The links ``a``, ``b`` between classes (id, one: the key of a text of the class) that have at least this Jaccard similarity.

    A link is settled where the end with more links is, its hub: there the other text's shingles are compared with the hub's as the rows come, so they are
    sent once for each of its links to a hub, and nothing but the hub's are held. The links of a hub are dealt out by HUB_LINKS. ``texts`` has one row
    per key (one, text); only texts with links are read in Python, once each.
    """
    degree = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").count()
    dealt = links
    for end in "ab":
        dealt = dealt.join(degree.select(F.col("id").alias(end), F.col("count").alias(f"n_{end}")), end)
    first = F.col("n_a") >= F.col("n_b")
    dealt = dealt.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("id"),
                         F.ceil(F.greatest("n_a", "n_b") / HUB_LINKS).alias("slices"))
    dealt = dealt.select("hub", F.pmod(F.xxhash64("id"), F.col("slices")).alias("slice"), "id")
    ends = checkpointed(dealt.union(dealt.select("hub", "slice", F.col("hub").alias("id")).distinct()))
    few = ends.limit(BROADCAST_ENDS + 1).count() <= BROADCAST_ENDS
    keys = classes.select("id", "one").join(ends.select("id").distinct(), "id")

    def sets(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                held = [distinct_shingles(t, shingle_words).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(held, pa.binary())], ["id", "hashes"])

    def run(batches):
        at, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            near, hubs, ids = [], batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, (hub, part, own) in enumerate(zip(hubs, batch.column(1).to_pylist(), ids)):
                hashes = np.frombuffer(batch.column(3)[row].as_py(), "<u8")
                if own == hub:
                    at, held = (hub, part), hashes
                elif at != (hub, part):
                    raise ValueError("a link without its hub")
                near.append(own != hub and jaccard(held, hashes) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    found = texts.join(F.broadcast(keys) if few else keys, "one").select("id", "text").mapInArrow(sets, "id long, hashes binary")
    placed = found.join(F.broadcast(ends) if few else ends, "id").select("hub", "slice", "id", "hashes").repartition("hub", "slice")
    return placed.sortWithinPartitions("hub", "slice", F.col("id") != F.col("hub"), "id").mapInArrow(run, "a long, b long")


def print_pairs(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a``, ``b`` of classes (id, fp) that connect those whose fingerprints the trie join connects; no more pairs than classes."""
    first = checkpointed(classes.groupBy("fp").agg(F.min("id").alias("first")))
    equal = classes.join(first, "fp").where("id <> first").select("id", "first")
    one, two = (first.select(F.col("fp").alias(e), F.col("first").alias(f"id_{e}")) for e in "ab")
    linked = links(first.select("fp"), max_bits).join(one, "a").join(two, "b").select("id_a", "id_b")
    pairs = equal.union(linked)
    return pairs.select(F.least(*pairs.columns).alias("a"), F.greatest(*pairs.columns).alias("b")).distinct()


def near_copies(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id (smallest doc_id among the texts connected by near copies).

    See ``near_groups``.
    """
    return near_groups(docs, shingle_words, similarity).select("doc_id", "component_id")


def near_groups(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, h1, h2 (hashes of the text), root (number of its group), component_id (smallest doc_id of the group).

    Near copies are texts with a Jaccard similarity of at least ``similarity`` over distinct shingles; every such pair is found and every link is
    verified by all shingles of both texts. Texts with equal sets of shingles are one class. The trie join of their SimHashes proposes the first pairs,
    which connect most copies cheaply. What it cannot see, pairs of 0.8 whose SimHashes lie far apart, is proposed by a prefix join: with the shingles
    of every text in one common order, rare ones first, near copies share one of their first ``prefix_length``. Of the pairs that share one, those are
    left out whose lengths, places of the shingle or parities show that too few others are in common, and those that verified links connect already.
    Null and empty texts are equal to each other; a null doc_id takes part but never names a component; rows that repeat a doc_id keep a row each;
    other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long"), utf8().alias("text"))
    hashed = texts.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    counts = shingle_counts(texts.select("text"), shingle_words)

    def prefixes(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                held = [distinct_shingles(t, shingle_words) for t in part.column(3).to_pylist()]
                first = [_rarest_first(h, counts)[:int(prefix_length(np.int64(len(h)), similarity))].view(np.int64) for h in held]
                starts = np.cumsum([0, *map(len, first)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([set_number(h) for h in held], pa.int64()), pa.array([print_of(h) for h in held], pa.int64()), pa.array([len(h) for h in held], pa.int64()),
                     pa.array([parities(h) for h in held], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(first), pa.int64()))],
                    ["doc_id", "h1", "h2", "id", "fp", "n", "bits", "tokens"])

    rows = checkpointed(hashed.mapInArrow(prefixes, "doc_id long, h1 long, h2 long, id long, fp long, n long, bits binary, tokens array<long>"))
    key = F.struct("doc_id", "h1", "h2")
    classes = checkpointed(rows.groupBy("id").agg(F.min("doc_id").alias("least"), F.min(key).alias("one"), F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("bits").alias("bits"),
                                                  F.min("tokens").alias("tokens")))
    tried = checkpointed(print_pairs(classes.select("id", "fp")))
    # The same text under the same doc_id more than once, or without one: one row of these is enough.
    again = rows.groupBy("doc_id", "h1", "h2").count().where("count > 1").limit(1).count() > 0
    keyed = hashed.select(key.alias("one"), "text")
    keyed = keyed.join(classes.select("one"), "one", "left_semi").groupBy("one").agg(F.min("text").alias("text")) if again else keyed

    def near_of(links):
        return verified(links, classes, keyed, shingle_words, similarity)

    by_print = checkpointed(near_of(tried))
    tokens = classes.select("id", "n", F.posexplode("tokens").alias("place", "token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = checkpointed(tokens.join(often, "token").select("token", "rows", "id", "n", F.col("place").cast("long").alias("place")))
    bits = classes.select("id", "bits")

    def connected(near):
        part = components(near).select(F.col("node").alias("id"), F.col("component").alias("named"))
        return shared.join(part, "id", "left").withColumn("component", F.coalesce("named", "id")).drop("named")

    # First the texts next to each other by length, which connects dense groups; then all pairs that this has not connected.
    cells = _sliced(connected(by_print), PRINT_CELL_ROWS).join(bits, "id")
    proposed = checkpointed(_proposed(cells, similarity, only_next=NEXT_ROWS).join(tried, ["a", "b"], "left_anti"))
    near = checkpointed(by_print.union(near_of(proposed)))
    shared = connected(near)
    # Shingles whose texts are all connected have no more to tell.
    apart = shared.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    cells = _sliced(shared.join(apart, "token", "left_semi"), PRINT_CELL_ROWS).join(bits, "id")
    rest = checkpointed(_proposed(cells, similarity).join(proposed.union(tried), ["a", "b"], "left_anti"))
    found = components(near.union(near_of(rest)))
    named = checkpointed(classes.join(found, classes.id == found.node, "left").select(
        "id", "least", F.coalesce("component", "id").alias("root")))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "root").select("id", "root", "component_id")
    return rows.select("doc_id", "h1", "h2", "id").join(named, "id").select("doc_id", "h1", "h2", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies; columns unchanged.

    The one with the smallest doc_id stays (documents without a doc_id come last), then the one with the smallest hash of its text, and one of rows that
    agree in both, whichever Spark meets first. Rows that share a doc_id but not their text are judged apart.
    """
    with shuffles_freed(docs.sparkSession):
        return _one_of_each(docs)


def _one_of_each(docs: DataFrame) -> DataFrame:
    groups = checkpointed(near_groups(docs))
    key = ["doc_id", "h1", "h2"]
    one = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), *key)).alias("one")).select("root", F.col("one.h1").alias("o1"), F.col("one.h2").alias("o2"), F.col("one.doc_id").alias("one"))
    same = F.col("doc_id").eqNullSafe(F.col("one")) & (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2"))
    rows = groups.join(one, "root").withColumn("stays", same)
    lost = checkpointed(rows.where(~F.col("stays")).select(*key).distinct())
    again = checkpointed(rows.where("stays").groupBy(*key).count().where("count > 1").select(*key))
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    name = unused("key", docs.columns)
    keyed = docs.withColumn(name, F.struct(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")))

    def among(these, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.struct(*key).alias(f"{name}_"))
        few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        return these.join(F.broadcast(keys) if few else keys, F.col(name) == F.col(f"{name}_"), how)

    # Whole texts are shuffled only where the lost keys are too many to broadcast, or rows repeat.
    single = among(keyed, lost, "left_anti")
    if not again.isEmpty():
        single = among(single, again, "left_anti").union(among(single, again, "left_semi").dropDuplicates([name]))
    return single.drop(name)
