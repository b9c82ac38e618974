"""Packing documents into fixed windows with every window at the target mixture.

Each source is a queue of tokens. A window is one round of deficit round-robin: every queue earns its share
of the window, is served whole tokens, and the rest of its credit is carried to the next window. Because documents may be cut
anywhere, a queue's unserved credit is always under one token, and the number of tokens a queue has been served up to any window
follows from its weight alone: token j of a queue with weight w is due at time (2j+1)/w, and windows are filled in order of due time.
So a task can take up the round at any window with the right deficits, and nothing runs through the
driver but one total per queue. When a queue runs empty, a new epoch begins in which the others share its credit.

Sources too many for a queue each share one queue by the same rule, in chunks: a chunk whose middle is token j of a source with n tokens is due at (2j+1)/n,
so that each of them is served evenly to within a chunk.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import utf8
from tallymart.llm.wordcodes import WordCoder, as_binary, batches_of_bytes, with_end, words
from tallymart.operators.running import running_total
from tallymart.session import new_shared_path

# Weights are whole numbers, the largest this: shares are met to about one part in 2**15.
FINEST = 2 ** 15
# Sources that get a queue each, those with the most tokens (sources with a given share always do); the others share one more, in chunks of at most so many tokens.
QUEUES = 31
CHUNK = 64
# Rows of running sums, one per task and source, that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000

@dataclass
class Epoch:
    """A stretch of windows in which the same queues have tokens: first token overall, per queue first token, tokens, weight."""
    begin: int
    first: list[int]
    tokens: list[int]
    weight: list[int]


def epochs(totals: list[int], shares: list[float]) -> list[Epoch]:
    """The epochs for queues with ``totals`` tokens and wanted ``shares`` (any positive numbers; zero: only at the end)."""
    left, first, begin, out = list(totals), [0] * len(totals), 0, []
    while any(left):
        live = [s if n else 0.0 for s, n in zip(shares, left)]
        if not any(live):
            live = [float(n) for n in left]
        top = max(live)
        weight = [max(1, round(FINEST * s / top)) if s else 0 for s in live]
        # The queue that is empty first ends the epoch; due times are compared as whole numbers.
        i = min((k for k in range(len(left)) if weight[k]), key=lambda k: (left[k] / weight[k], k))
        end, w = 2 * left[i], weight[i]
        taken = [min(n, (end * v // w + 1) // 2) if v else 0 for n, v in zip(left, weight)]
        out.append(Epoch(begin, list(first), taken, weight))
        left = [n - t for n, t in zip(left, taken)]
        first = [f + t for f, t in zip(first, taken)]
        begin += sum(taken)
    return out


def _rank(epoch: Epoch, queue: int, token: np.ndarray) -> np.ndarray:
    """Place in the epoch's order of due times of the given tokens of a queue (counted from the epoch's first)."""
    x, w = 2 * token + 1, epoch.weight[queue]
    place = np.zeros(len(token), np.int64)
    for other, (v, n) in enumerate(zip(epoch.weight, epoch.tokens)):
        if not v or not n:
            continue
        if other < queue:
            before = (x * v // w + 1) // 2
        elif other > queue:
            before = -(-x * v // w) // 2
        else:
            before = token
        place += np.minimum(before, n)
    return place


def served(plan: list[Epoch], queue: int, position: np.ndarray) -> np.ndarray:
    """How many tokens of a queue are among the first ``position`` tokens of all windows."""
    out = np.zeros(len(position), np.int64)
    for epoch in plan:
        here = position - epoch.begin
        n, total = epoch.tokens[queue], sum(epoch.tokens)
        inside = (here > 0) & (here < total)
        out[here >= total] += n
        if not n or not inside.any():
            continue
        want = here[inside]
        lo, hi = np.zeros(len(want), np.int64), np.full(len(want), n, np.int64)
        guess = (want.astype(np.float64) * (epoch.weight[queue] / sum(epoch.weight))).astype(np.int64)
        slack = len(epoch.weight) + 4 + (guess >> 40)
        # Queues that ran short within the epoch only move the place up, never by more than the slack.
        lo, hi = np.maximum(lo, np.minimum(guess - slack, n)), np.minimum(hi, guess + slack)
        bad = ((lo > 0) & (_rank(epoch, queue, np.maximum(lo - 1, 0)) >= want)) | (
            (hi < n) & (_rank(epoch, queue, np.minimum(hi, n - 1)) < want))
        lo, hi = np.where(bad, 0, lo), np.where(bad, n, hi)
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) >> 1
            less = _rank(epoch, queue, np.minimum(mid, n - 1)) < want
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        out[inside] += lo
    return out


def _place_of(plan: list[Epoch], queue: int, token: np.ndarray) -> np.ndarray:
    """Place in the order of all windows' tokens of the given tokens of a queue."""
    out = np.zeros(len(token), np.int64)
    for epoch in plan:
        here = token - epoch.first[queue]
        inside = (here >= 0) & (here < epoch.tokens[queue])
        if inside.any():
            out[inside] = epoch.begin + _rank(epoch, queue, here[inside])
    return out


def cut(plan: list[Epoch], queue: np.ndarray, start: np.ndarray, length: np.ndarray, window: int):
    """Pieces of documents that lie at ``start`` (in tokens) of their queue: row, start in the document, length, window, offset."""
    row, number = [], []
    for q in np.unique(queue):
        own = np.flatnonzero((queue == q) & (length > 0))
        w0 = _place_of(plan, q, start[own]) // window
        w1 = _place_of(plan, q, start[own] + length[own] - 1) // window
        n = w1 - w0 + 1
        at = np.repeat(np.arange(len(own)), n)
        row.append(own[at])
        number.append(w0[at] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    if not row:
        return [np.zeros(0, np.int64)] * 5
    row, number = np.concatenate(row), np.concatenate(number)
    numbers, at = np.unique(number, return_inverse=True)
    low = np.stack([served(plan, q, numbers * window) for q in range(len(plan[0].weight))])
    high = np.stack([served(plan, q, (numbers + 1) * window) for q in range(len(plan[0].weight))])
    before = np.cumsum(high - low, axis=0) - (high - low)
    q = queue[row]
    begin = np.maximum(start[row], low[q, at])
    end = np.minimum(start[row] + length[row], high[q, at])
    offset = before[q, at] + begin - low[q, at]
    some = end > begin
    return [v[some] for v in (row, begin - start[row], end - begin, number, offset)]


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, shares: dict[str, float] | None = None,
         queues: int = QUEUES) -> DataFrame:
    """One row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit).

    ``shares`` gives sources their wanted part of every window (sources not named are served when those are empty);
    without it each source has its part of all tokens, so that all queues last to the end and all windows are alike. Sources with a given share and, up to
    ``queues`` in all, the largest others have a queue each; the rest share one, in which each is served evenly to within CHUNK tokens. Only the last sequence may be short. A null text is empty (one
    piece with the end id), a null source an empty one; rows with the same or no doc_id are documents of their own; a document longer
    than a window is cut. Other columns are ignored. No rows give no pieces.
    """
    spark = docs.sparkSession
    coded = _tokens(docs, tokenizer_path, end_id)
    path = new_shared_path(spark, "tokens")
    coded.write.option("compression", "zstd").parquet(path)
    coded = spark.read.parquet(path)
    # One row per task and source: the driver sees one total for each queue, of which there are queues + 1, or one more than given shares.
    sums = coded.groupBy("task", "source").agg(F.sum("n").alias("n"))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    named = sorted(shares or {})
    largest = [r["source"] for r in by_source.where(~F.col("source").isin(named)).orderBy(F.desc("n"), "source")
               .limit(max(0, queues - len(named))).collect()]
    order = named + largest
    number = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]).cast("array<string>"), F.col("source")), F.lit(0)).cast("int")
    number = F.when(number > 0, number - 1).otherwise(len(order))
    totals = [0] * (len(order) + 1)
    for r in by_source.groupBy(number.alias("queue")).agg(F.sum("n").alias("n")).collect():
        totals[r["queue"]] = int(r["n"])
    wanted = [shares.get(s, 0.0) for s in order] + [0.0] if shares else [float(t) for t in totals]
    plan = epochs(totals, wanted)
    # Where a task's tokens of a source begin in the queue: a running sum over tasks, not documents, in ranges, so that a queue is in no one task.
    first = F.array(*[F.lit(sum(totals[:q])).cast("long") for q in range(len(totals))])
    begins = running_total(sums.withColumn("queue", number), "n", "queue", "source", "task").select(
        "task", "source", "queue", (F.col("running").cast("long") - F.col("n") - F.get(first, F.col("queue"))).alias("begin"))
    rest = F.col("queue") == len(order)
    if totals[-1]:
        # In the shared queue from the source's first token on, with the source's tokens.
        of_source = begins.where(rest).groupBy("source").agg(F.min("begin").alias("first")).join(by_source.withColumnRenamed("n", "all"), "source")
        begins = begins.join(of_source, "source", "left").withColumn("begin", F.col("begin") - F.coalesce("first", F.lit(0))).drop("first")
    else:
        begins = begins.withColumn("all", F.lit(0).cast("long"))
    if begins.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        begins = F.broadcast(begins)
    placed = coded.join(begins, ["task", "source"]).withColumn("start", F.col("begin") + F.col("at"))
    columns = ["doc_id", "source", "queue", "start", "n", "ids", "base", "doc_tokens"]
    whole = placed.withColumn("base", F.lit(0).cast("long")).withColumn("doc_tokens", F.col("n")).select(*columns, "all")
    placed = whole.where(~rest).select(columns) if totals[-1] else whole.select(columns)
    if totals[-1]:
        width = F.expr("octet_length(ids) div doc_tokens")
        chunks = whole.where(rest).withColumn("base", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK} * {CHUNK}, {CHUNK}L)")))
        chunks = chunks.withColumn("n", F.least(F.lit(CHUNK).cast("long"), F.col("doc_tokens") - F.col("base"))).withColumn("start", F.col("start") + F.col("base"))
        chunks = chunks.withColumn("ids", F.substring("ids", (F.col("base") * width + 1).cast("int"), (F.col("n") * width).cast("int")))
        chunks = chunks.withColumn("due", (2 * F.col("start") + F.col("n")) / F.col("all"))
        dealt = running_total(chunks, "n", "due", "source", "start")
        placed = placed.union(dealt.withColumn("start", F.col("running").cast("long") - F.col("n")).select(columns))

    def run(batches):
        for batch in batches:
            yield from _pieces(plan, batch, window)

    return placed.mapInArrow(run, "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _pieces(plan, batch, window):
    doc, source = batch.column(0), batch.column(1)
    queue, start, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
    base, doc_tokens = (batch.column(i).to_numpy(zero_copy_only=False) for i in (6, 7))
    row, begin, length, number, offset = cut(plan, queue, start, n, window)
    ids = batch.column(5)
    for lo in range(0, len(row), 20_000):
        part = slice(lo, lo + 20_000)
        wide, last, out = None, -1, []
        for r, b, k in zip(row[part].tolist(), begin[part].tolist(), length[part].tolist()):
            if r != last:
                raw = ids[r].as_py()
                wide, last = np.frombuffer(raw, f"<u{len(raw) // n[r]}").astype("<u4").tobytes(), r
            out.append(wide[4 * b:4 * (b + k)])
        at = pa.array(row[part])
        yield pa.RecordBatch.from_arrays(
            [doc.take(at), source.take(at), pa.array(base[row[part]] + begin[part]), pa.array(length[part]), pa.array(doc_tokens[row[part]]),
             pa.array(number[part]), pa.array(offset[part]), pa.array(out, pa.binary())],
            ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def _tokens(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, source, n, ids, and where the document lies: task, and ``at``, tokens of its source before it in the task."""
    def run(batches):
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        task, before = TaskContext.get().partitionId(), {}
        coder = WordCoder(Tokenizer.from_file(tokenizer_path), words, kept=(tokenizer_path,))
        for batch in batches:
            for lo, k in batches_of_bytes(batch.column(2), 4_000_000):
                part = batch.slice(lo, k)
                coded, count = with_end(*coder.encode(part.column(2)), end_id)
                at = []
                for source, n in zip(part.column(1).to_pylist(), count.tolist()):
                    at.append(before.get(source, 0))
                    before[source] = at[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count, pa.int64()), as_binary(coded, count),
                     pa.array([task] * len(count), pa.int64()), pa.array(at, pa.int64())],
                    ["doc_id", "source", "n", "ids", "task", "at"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), utf8().alias("text")).mapInArrow(
        run, "doc_id long, source string, n long, ids binary, task long, at long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a crc32 in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def crc_of(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
