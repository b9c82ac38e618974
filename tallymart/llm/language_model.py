"""Language-model scores: a log-bilinear neural model over word classes, trained with noise-contrastive estimation.

Words fall into classes: the text end and the most frequent words have one each, the others share ``SUFFIXES`` classes by their
last letters. The model gives the class of a token from the classes of the two before it; the vectors of the context are added and multiplied
with those of all classes at once, and a softmax normalises exactly. Within a shared class a word has its share of the class's add-one counts,
and there is one outcome for all unseen words. The training set of the model are the counts of all class triples of all training documents.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import remainder, utf8
from tallymart.session import checkpointed, new_shared_path

FREQUENT = 95
SUFFIXES = 32
CLASSES = 1 + FREQUENT + SUFFIXES
# Most frequent words whose counts every task holds; the counts of all others come by a join.
HELD_WORDS = 100_000
MARKS = b".,;:!?*&%$#|()\""
END = b""  # no word is empty


def suffix_class(word: bytes) -> int:
    return 1 + FREQUENT + zlib.crc32(word.rstrip(MARKS)[-2:]) % SUFFIXES


def word_counts(docs: DataFrame, hold: int = 300_000) -> DataFrame:
    """word (bytes), n over all texts, an end for each text; added up within tasks before the shuffle."""
    def run(batches):
        seen: dict[bytes, int] = {}

        def out():
            result = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return result

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in text.lower().split():
                    seen[word] = seen.get(word, 0) + 1
                seen[END] = seen.get(END, 0) + 1
                if len(seen) > hold:
                    yield out()
        if seen:
            yield out()

    return docs.select(utf8().alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """The held words: number by word, and by number the class and log10(count + 1)."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.number = {w: i for i, w in enumerate(words)}
        frequent = [w for w in words if w != END][:FREQUENT]
        class_of = {w: 1 + i for i, w in enumerate(frequent)} | {END: 0}
        self.classes = np.array([class_of[w] if w in class_of else suffix_class(w) for w in words] or [0], np.int64)
        self.log_count = np.log10(np.array(counts or [0], float) + 1)
        self.frequent = {w: class_of[w] for w in frequent}

    def class_of(self, word: bytes) -> int:
        return 0 if word == END else self.frequent.get(word) or suffix_class(word)

    def numbers(self, text: bytes) -> np.ndarray:
        """Number of each token, the end included; -1 - class for a word that is not held."""
        get = self.number.get
        words = text.lower().split()
        words.append(END)
        return np.array([n if (n := get(w)) is not None else -1 - self.class_of(w) for w in words], np.int64)

    def classes_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers >= 0, self.classes[np.maximum(numbers, 0)], -1 - numbers)


def triples(classes: np.ndarray) -> np.ndarray:
    """Code of each token with the two before it; before the text there are ends."""
    c = np.concatenate([[0, 0], classes])
    return (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]


def triple_counts(docs: DataFrame, lexicon) -> DataFrame:
    """code, n of all class triples; at most CLASSES ** 3 rows."""
    def run(batches):
        words = lexicon.value
        for batch in batches:
            codes = [triples(words.classes_of(words.numbers(t))) for t in batch.column(0).to_pylist()]
            if codes:
                code, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    return docs.select(utf8().alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def train(code: np.ndarray, n: np.ndarray, dims: int = 32, steps: int = 700, batch: int = 4_096, noise: int = 64, ratio: int = 20,
          rate: float = 0.15, seed: int = 3) -> np.ndarray:
    """log10 P(class | two classes before) as a CLASSES x CLASSES x CLASSES table of a log-bilinear model.

    Noise-contrastive estimation on triples drawn by their counts: each true class is told apart from ``ratio`` noise classes (drawn by
    class frequency, ``noise`` of them shared by a batch). The products are normalised at the end.
    """
    rng = np.random.default_rng(seed)
    order = np.argsort(code)
    code, n = code[order], n[order]
    frequency = np.bincount(code % CLASSES, n, CLASSES) + 1.0 if len(code) else np.ones(CLASSES)
    frequency /= frequency.sum()
    log_noise = np.log(ratio * frequency).astype(np.float32)
    p = {"near": rng.normal(0, 0.1, (CLASSES, dims)), "far": rng.normal(0, 0.1, (CLASSES, dims)),
         "out": rng.normal(0, 0.1, (CLASSES, dims)), "bias": np.log(frequency)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    square = {k: np.full_like(v, 1e-2) for k, v in p.items()}
    cumulative = np.cumsum(n / max(1, n.sum()))
    for step in range(steps if len(code) else 0):
        drawn = code[np.minimum(np.searchsorted(cumulative, rng.random(batch)), len(code) - 1)]
        far, near, word = drawn // CLASSES ** 2, drawn // CLASSES % CLASSES, drawn % CLASSES
        other = rng.choice(CLASSES, noise, p=frequency)
        context = p["near"][near] + p["far"][far]
        true = 1 / (1 + np.exp(-((context * p["out"][word]).sum(1) + p["bias"][word] - log_noise[word]))) - 1
        false = 1 / (1 + np.exp(-(context @ p["out"][other].T + p["bias"][other] - log_noise[other]))) * (ratio / noise)
        to_context = true[:, None] * p["out"][word] + false @ p["out"][other]
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        np.add.at(grad["near"], near, to_context)
        np.add.at(grad["far"], far, to_context)
        np.add.at(grad["out"], word, true[:, None] * context)
        np.add.at(grad["out"], other, false.T @ context)
        np.add.at(grad["bias"], word, true)
        np.add.at(grad["bias"], other, false.sum(0))
        for k in p:
            g = grad[k] / batch
            square[k] += g * g * 100
            p[k] -= rate * 10 * g / np.sqrt(square[k]) * (1 - step / steps)
    out = np.empty((CLASSES, CLASSES, CLASSES), np.float32)
    for far in range(CLASSES):
        logits = (p["near"] + p["far"][far]) @ p["out"].T + p["bias"]
        logits -= logits.max(1, keepdims=True)
        out[far] = (logits - np.log(np.exp(logits).sum(1, keepdims=True))) / math.log(10)
    return out


def scored(docs: DataFrame, held_out_of: int = 7, held_out: int = 2, held_words: int = HELD_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose crc32(doc_id as text) mod ``held_out_of`` is not ``held_out``; a null doc_id counts as an empty
    text. A null text is empty and has one token, its end. Rows that repeat a doc_id are scored each and count each; other columns are ignored.
    Without training documents all counts are zero and base_score is that of one unseen word per token.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = docs.where(remainder("doc_id", held_out_of) != held_out)
    path = new_shared_path(spark, "word_counts")
    word_counts(training).write.parquet(path)
    counts = spark.read.parquet(path)
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("words")).first()
    tokens, words = int(size["tokens"]), int(size["words"])
    # The end is held in any case: it is no word that a text could be split into.
    end = F.octet_length("word") == 0
    held = counts.orderBy(end.desc(), F.desc("n"), "word").limit(held_words).toArrow()
    lexicon = Lexicon(held.column("word").to_pylist(), held.column("n").to_pylist())
    least = int(held.column("n")[-1].as_py()) if held.num_rows == held_words else 0
    shared = spark.sparkContext.broadcast(lexicon)
    found = triple_counts(training, shared).toArrow()
    table = spark.sparkContext.broadcast(train(found.column("code").to_numpy(), found.column("n").to_numpy()))
    mass = np.zeros(CLASSES)
    for r in class_mass(counts, shared).collect():
        mass[r["class"]] = r["mass"]
    # One more outcome in each shared class, for words that are not in the counts.
    log_mass = np.log10(mass + 1)
    log_mass[:1 + FREQUENT] = 0.0
    log_all = math.log10(tokens + words + 1)

    def run(batches):
        words, log_p = shared.value, table.value.ravel()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for text in batch.column(3).to_pylist():
                numbers = words.numbers(text)
                classes = words.classes_of(numbers)
                known = numbers >= 0
                log_count = np.where(known, words.log_count[np.maximum(numbers, 0)], 0.0)
                grouped = classes > FREQUENT
                within = np.where(grouped, log_count - log_mass[classes], 0.0)
                out.append((len(numbers), int(known.sum()), float(log_count.sum()) - len(numbers) * log_all,
                            float(log_p[triples(classes)].sum(dtype=np.float64) + within.sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                ["doc_id", "id", "digest", "n_tokens", "held", "base", "model"])

    # Rows are told apart by id and content; equal rows have equal scores.
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(-2**63)).alias("id"), F.xxhash64("text").alias("digest"), utf8().alias("bytes"))
    rows = checkpointed(keyed.mapInArrow(run, "doc_id long, id long, digest long, n_tokens long, held long, base double, model double"))
    key = ["id", "digest"]
    rest = counts.where(F.col("n") <= least) if least else counts.limit(0)
    rare = rare_words(keyed, shared).join(rest, "word").groupBy(*key).agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_count"), F.sum("times").alias("known"))
    # Equal rows have each added to the sums.
    copies = rows.groupBy(*key).agg(F.count("*").alias("copies"))
    rare = rare.join(copies, key).select(*key, (F.col("log_count") / F.col("copies")).alias("log_count"), F.expr("known div copies").alias("known"))
    more = F.coalesce("log_count", F.lit(0.0))
    return rows.join(rare, key, "left").select(
        "doc_id", (remainder("doc_id", held_out_of) == held_out).alias("held_out"), "n_tokens",
        (F.col("held") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))


def class_mass(counts: DataFrame, lexicon) -> DataFrame:
    """class, mass: sum of count + 1 over the counted words of each class."""
    def run(batches):
        words, total = lexicon.value, np.zeros(CLASSES)
        for batch in batches:
            classes = np.fromiter(map(words.class_of, batch.column(0).to_pylist()), np.int64, batch.num_rows)
            total += np.bincount(classes, batch.column(1).to_numpy() + 1.0, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total)], ["class", "mass"])

    return counts.mapInArrow(run, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("mass"))


def rare_words(keyed: DataFrame, lexicon) -> DataFrame:
    """id, digest, word, times for the words of each row that are not held."""
    def run(batches):
        words = lexicon.value.number
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                row, word, times = [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    seen: dict[bytes, int] = {}
                    for w in text.lower().split():
                        if w not in words:
                            seen[w] = seen.get(w, 0) + 1
                    row += [i] * len(seen)
                    word += seen
                    times += seen.values()
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(word, pa.binary()), pa.array(times, pa.int64())],
                    ["id", "digest", "word", "times"])

    return keyed.select("id", "digest", "bytes").mapInArrow(run, "id long, digest long, word binary, times long")
