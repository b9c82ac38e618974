"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a look-up table over its bins, learnt by cyclic boosting: round after round, each feature in turn fits a shallow tree to
what is still unexplained and adds a small step of it to its table. The strongest pairs of features then get tables of
their own in the same way. A score is a sum of look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import remainder, utf8

# Labelled rows that are fitted at most: those with the smallest hashes of their doc_id.
TRAIN_ROWS = 20_000
BINS = 32
FEATURES = [
    "log_words", "log_bytes", "mean_word", "longest_word", "distinct_words", "same_as_last_word", "upper_letters", "letters", "digits", "symbols",
    "marks", "exclamations", "bars", "non_ascii", "lines_per_word", "repeated_lines", "words_with_mark", "top_word",
]


def features(text: bytes) -> list[float]:
    """The features of a whole text; an empty one has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n, size = max(1, len(words)), len(text)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    of = lambda chars: float(counts[np.frombuffer(chars, np.uint8)].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper, lower = float(counts[65:91].sum()), float(counts[97:123].sum())
    return [
        np.log1p(len(words)), np.log1p(size), sum(map(len, words)) / n, float(max(map(len, words), default=0)), len(tally) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, upper / max(1.0, upper + lower), (upper + lower) / size,
        float(counts[48:58].sum()) / size, of(b"#*$%&<>") / size, of(b".,;:") / n, of(b"!?") / n, of(b"|") / n,
        float(counts[128:].sum()) / size, len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n, max(tally.values(), default=0) / n,
    ]


@dataclass
class Additive:
    """Tables of a fitted model; ``pairs`` has (feature, feature, table)."""
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1) if len(self.edges) else np.zeros((len(x), 0), int)

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for i, t in enumerate(self.tables):
            z += t[b[:, i]]
        for i, j, t in self.pairs:
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, least: float = 5.0, ridge: float = 1.0) -> np.ndarray:
    """Leaf values per bin of a tree of at most ``depth`` levels over ordered bins with gradient and weight sums."""
    out = np.full(len(g), -g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl * 4 >= least) & (hr * 4 >= least), gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge), -1)
    at = int(gain.argmax())
    if gain[at] <= g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
        return out
    return np.concatenate([_tree(g[:at + 1], h[:at + 1], depth - 1, least, ridge), _tree(g[at + 1:], h[at + 1:], depth - 1, least, ridge)])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8, step: float = 0.1, depth: int = 2) -> Additive:
    """Fits the model; without rows it says 1/2, with one label only (nearly) that label."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    edges = []
    for i in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
        # Bins at the thin end of a feature that is mostly one value.
        rest = x[x[:, i] > cuts[-1], i] if len(cuts) and len(x) else np.zeros(0)
        edges.append(np.unique(np.concatenate([cuts, np.quantile(rest, [0.25, 0.5, 0.75])])) if len(rest) else cuts)
    model = Additive(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges])
    if not len(x):
        return model
    b, z = model.bins(x), np.full(len(x), model.base)
    for _ in range(rounds):
        for i, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-z))
            add = step * _tree(np.bincount(b[:, i], p - y, len(t)), np.bincount(b[:, i], p * (1 - p), len(t)), depth)
            t += add
            z += add[b[:, i]]
    grid = lambda i, j, v: np.bincount(b[:, i] * len(model.tables[j]) + b[:, j], v, len(model.tables[i]) * len(model.tables[j])).reshape(
        len(model.tables[i]), len(model.tables[j]))
    p = 1 / (1 + np.exp(-z))
    ranked = sorted(((-_cross(grid(i, j, p - y), grid(i, j, p * (1 - p)))[0], i, j)
                     for i in range(x.shape[1]) for j in range(i)), key=lambda r: r)
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for _, i, j in ranked[:pairs]]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            p = 1 / (1 + np.exp(-z))
            add = step * _cross(grid(i, j, p - y), grid(i, j, p * (1 - p)))[1]
            t += add
            z += add[b[:, i], b[:, j]]
    return model


def _cross(g: np.ndarray, h: np.ndarray, least: float = 5.0, ridge: float = 5.0) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts both features of a pair once."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quarter = lambda c: (c, c[-1:, :] * 0 + c[:, -1:] - c, c[-1:, :] - c, c[-1, -1] - c[:, -1:] - c[-1:, :] + c)
    gs, hs = quarter(cg), quarter(ch)
    gain = sum(a ** 2 / (b + ridge) for a, b in zip(gs, hs))
    gain = np.where(np.minimum.reduce(hs) * 4 >= least, gain, -1.0)[:-1, :-1]
    if not gain.size or gain.max() <= 0:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    leaf = [-a[i, j] / (b[i, j] + ridge) for a, b in zip(gs, hs)]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaf
    return float(gain[i, j]), out


def with_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, the features of the text, one row per row."""
    fields = {f.name: f for f in docs.schema}

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                rows = [features(t) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(rows, pa.list_(pa.float64()))], [*keep, "x"])

    schema = ", ".join(f"`{k}` {fields[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, utf8().alias("_text")).mapInArrow(run, f"{schema}, x array<double>")


def trained(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, held_out_of: int = 5) -> Additive:
    """The model fitted on labelled documents whose crc32(doc_id as text) mod ``held_out_of`` is not 0.

    Of the labels, at most ``train_rows`` are taken, by hash of their doc_id; labels that are null or neither 0 nor 1 are not used.
    """
    wanted = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(remainder("doc_id", held_out_of) != 0)
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(train_rows))
    # At most train_rows short rows: small enough to be broadcast, so that no text is shuffled.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id")
    found = with_features(rows, "doc_id", "y").orderBy(F.xxhash64("doc_id"), "y", F.xxhash64("x")).limit(train_rows).toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, found.column("y").to_numpy().astype(float))


def scored(docs: DataFrame, model: Additive, *keep: str) -> DataFrame:
    """``keep`` columns and ``score``, the probability of good quality, one row per row."""
    fields = {f.name: f for f in docs.schema}

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                part = batch.slice(lo, 1_000)
                x = np.array([features(t) for t in part.column(len(keep)).to_pylist()]).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(model.scores(x))], [*keep, "score"])

    schema = ", ".join(f"`{k}` {fields[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, utf8().alias("_text")).mapInArrow(run, f"{schema}, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out_of: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words; repeated rows are scored each; a null doc_id is passed on (its crc32 is
    that of an empty text). Without usable labels every score is 1/2. Only the text is an input of the score.
    """
    model = trained(docs, labels, held_out_of=held_out_of)
    return scored(docs, model, "doc_id").select(
        "doc_id", (remainder("doc_id", held_out_of) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier does not reject, columns unchanged."""
    model = trained(docs, labels)
    names = docs.columns
    # Columns travel by position: names may clash with those of the scoring.
    plain = docs.select(*[docs[c].alias(f"_c{i}") for i, c in enumerate(names)], docs["text"])
    out = scored(plain, model, *[f"_c{i}" for i in range(len(names))]).where(F.col("score") >= threshold)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
