"""Removing lines that many documents share, with the line keys held in levelled sorted runs.

A run is a table of line hashes, bucketed and sorted by hash, with the number of documents and the largest
doc_id that hold the line. Documents arrive in batches. A batch is merge-anti-joined with the runs,
which says which of its lines are new, and is then added as a run of its own; whenever a level has ``fanout`` runs they
are merged into one run of the next level. Buckets line up, so neither the merge joins nor the compactions shuffle.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.llm.common import utf8
from tallymart.session import checkpointed, new_shared_path

BLANKS = b" \t\n\v\f\r"
KEY = ["h1", "h2"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line without outer blanks and with A-Z lower-cased; None if it has fewer than min_chars code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(keys: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(pairs[:, i])) for i in range(2)]


def line_counts(docs: DataFrame, min_chars: int = 20, hold: int = 200_000) -> DataFrame:
    """h1, h2, docs, last per line key, added up within a task (so a key may come once per task)."""
    def run(batches):
        seen: dict[bytes, list] = {}

        def out():
            ends = list(seen.values())
            result = pa.RecordBatch.from_arrays(
                _halves(list(seen)) + [pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64())],
                [*KEY, "docs", "last"])
            seen.clear()
            return result

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for key in {line_key(line, min_chars) for line in text.split(b"\n")}:
                    if key is None:
                        continue
                    entry = seen.get(key)
                    if entry is None:
                        seen[key] = [1, doc_id]
                    else:
                        entry[0] += 1
                        if doc_id is not None and (entry[1] is None or doc_id > entry[1]):
                            entry[1] = doc_id
                if len(seen) >= hold:
                    yield out()
        if seen:
            yield out()

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(
        run, "h1 long, h2 long, docs long, last long")


class LineRuns:
    """Levelled sorted runs of line keys in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", new_shared_path(self.spark, name)).saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        """Forget a merged run and delete its files."""
        place = self.spark.table(name).inputFiles()
        self.spark.sql(f"DROP TABLE {name}")
        if place:
            jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(place[0]).getParent()
            folder.getFileSystem(conf).delete(folder, True)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, counts: DataFrame) -> str:
        """Adds a batch (h1, h2, docs, last; keys may repeat) as a run; its ``known`` says that an earlier run has the key."""
        own = counts.repartition(self.buckets, *KEY).groupBy(*KEY).agg(
            F.sum("docs").alias("docs"), F.max("last").alias("last"))
        fresh = own
        for run in self.runs():
            fresh = fresh.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        if self.levels:
            marks = fresh.select(*KEY, F.lit(False).alias("_new"))
            own = own.join(marks.hint("merge"), KEY, "left").withColumn("known", F.col("_new").isNull()).drop("_new")
        else:
            own = own.withColumn("known", F.lit(False))
        name = self._write(own)
        self._place(name, 0)
        return name

    def _place(self, name: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            parts = self.levels[level]
            # The merged rows of a key are known earlier if its first run says so.
            merged = _union([self.spark.table(p) for p in parts]).repartition(self.buckets, *KEY).groupBy(*KEY).agg(
                F.sum("docs").alias("docs"), F.max("last").alias("last"), F.bool_and("known").alias("known"))
            self.levels[level] = []
            self._place(self._write(merged), level + 1)
            for part in parts:
                self._drop(part)

    def repeated(self, min_docs: int) -> DataFrame:
        """h1, h2, last of the keys that at least ``min_docs`` documents hold, over all runs.

        Keys that are in one run only are decided there; a key in several runs is marked ``known`` in all but the first.
        """
        rows = _union(self.runs())
        again = rows.where("known").select(*KEY).distinct()
        apart = rows.where(~F.col("known") & (F.col("docs") >= min_docs)).select(*KEY)
        wanted = again.union(apart).distinct()
        return rows.join(wanted, KEY, "left_semi").groupBy(*KEY).agg(
            F.sum("docs").alias("docs"), F.max("last").alias("last")).where(F.col("docs") >= min_docs).drop("docs")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2) -> DataFrame:
    """h1, h2, last of all line keys in at least ``min_docs`` documents; ``batches`` slices by doc_id hash go through the runs."""
    runs = LineRuns(docs.sparkSession, fanout=fanout)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for i in range(batches):
        runs.add(line_counts(docs.where(part == i), min_chars))
    return runs.repeated(min_docs)


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, kept (the text without its dropped lines), n_lines, n_dropped.

    A line is dropped if its key has at least ``min_chars`` code points, at least ``min_docs`` documents hold it and the
    doc_id is not the largest of them. A null or empty text is one empty line. Each row counts as a document; rows that
    share the largest doc_id all keep the line; a null doc_id is smaller than any other, and where all holders have none,
    all keep the line. Other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return _applied(plain, ["doc_id"], min_chars, min_docs, batches)


def deduplicated(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4) -> DataFrame:
    """The documents with their dropped lines taken out of ``text`` (and ``n_chars`` set to its new length); a null text stays null."""
    names = docs.columns
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"), docs["text"].isNull().alias("_null"),
                        *[docs[c].alias(f"_c{i}") for i, c in enumerate(names) if c != "text"])
    out = _applied(plain, ["_null", *[f"_c{i}" for i, c in enumerate(names) if c != "text"]], min_chars, min_docs, batches)
    text = F.when(F.col("_null"), F.lit(None)).otherwise(F.col("kept"))
    new = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[new.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(names)])


def _applied(docs: DataFrame, keep: list[str], min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """``keep`` columns, kept, n_lines and n_dropped for docs with doc_id and text (bytes)."""
    # Written out, so that the join below shuffles both sides itself and a line of very many documents can be split.
    shared = checkpointed(shared_lines(docs.select("doc_id", "text"), min_chars, min_docs, batches).where("last IS NOT NULL"))
    # Rows without a doc_id are told apart by their text, so that they do not meet in one group.
    docs = docs.withColumn("_row", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    held = line_counts_by_doc(docs, min_chars)
    gone = (held.join(shared, KEY).where("doc_id IS NULL OR doc_id < last")
            .groupBy("doc_id", "_row").agg(F.collect_set(F.struct(*KEY)).alias("_gone"))
            .select(F.col("doc_id").alias("_id"), F.col("_row").alias("_of"), "_gone"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_of"))
    matched = docs.join(gone.hint("shuffle_hash"), same, "left").select(*keep, "text", "_gone")
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(rows):
        for batch in rows:
            texts, gones, out = batch.column(len(keep)), batch.column(len(keep) + 1), []
            for i in range(batch.num_rows):
                lines, gone = texts[i].as_py().split(b"\n"), gones[i].as_py()
                kept = lines
                if gone:
                    pairs = np.array([(g["h1"], g["h2"]) for g in gone], "<i8").tobytes()
                    drop = {pairs[at:at + 16] for at in range(0, len(pairs), 16)}
                    kept = [line for line in lines if line_key(line, min_chars) not in drop]
                out.append((b"\n".join(kept).decode("utf-8", "replace"), len(lines), len(lines) - len(kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] +
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
                [*keep, "kept", "n_lines", "n_dropped"])

    schema = ", ".join(f"`{k}` {fields[k]}" for k in keep)
    return matched.mapInArrow(run, f"{schema}, kept string, n_lines long, n_dropped long")


def line_counts_by_doc(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, doc_id, _row for every line key of every row."""
    def run(batches):
        for batch in batches:
            keys, at = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                own = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                keys += own
                at += [i] * len(own)
            if keys:
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([*_halves(keys), batch.column(0).take(at), batch.column(1).take(at)], [*KEY, "doc_id", "_row"])

    return docs.select("doc_id", "_row", "text").mapInArrow(run, "h1 long, h2 long, doc_id long, _row long")
