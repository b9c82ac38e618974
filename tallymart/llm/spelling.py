"""Grouping spelling variants: words one edit apart are found by pivotal bigrams, and each variant points to its frequent form.

All bigrams are in one order, rare ones first. A word's prefix holds its three first bigrams and all that are equal to the third, so
two of them always lie apart; its pivots are the two disjoint bigrams of the prefix that dynamic programming finds rarest together. One edit
spoils at most one pivot. Let r be the word whose prefix ends first in the order: the pivot that is left in its
neighbour s comes no later than the end of s's prefix, so it is in that prefix. Pivots are therefore looked up among
the prefixes of other words. The edit lies to one side of the pivot, so that on the other side both words agree to their end, which fixes
the bigram's position but for the difference in length; that agreeing side is part of the key. A short side is joined by
the one or two characters that follow it or that are at the far end: one edit in the rest spares at least one of them.
Every pair found is verified by its edit distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import ascii_lower
from tallymart.session import checkpointed, new_shared_path

LETTERS = r"[A-Za-zÀ-ÿ]"
# Shorter words are left out: the keys need this many characters.
MIN_CHARS = 7
# One occurrence in this many loses a character.
SPOILED = 31
# A form is at least this many times as frequent as its variant.
TIMES = 10
# Letters a-z, the 64 of U+00C0..U+00FF and one class for all others; bigrams are counted by class.
CLASSES = 91
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def spoiled_words(docs: DataFrame) -> DataFrame:
    """``word`` for each run of seven letters or more of each text, A-Z lower-cased, every 31st or so without one of its characters.

    The hash of doc_id and word decides which occurrence loses which character. A null text has no words, a null doc_id
    counts as an empty one. A word may come out shorter than seven characters.
    """
    runs = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(LETTERS + "{%d,}" % MIN_CHARS), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return rows.withColumn("h", h).select(F.when(F.col("h") % SPOILED == 0, less).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = 2) -> DataFrame:
    """``word`` and ``n`` of the words with enough characters and occurrences."""
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


class Grams:
    """The bigrams of a batch of words: code points end to end, and for each bigram its word, place and class."""

    def __init__(self, words: list[str]):
        self.code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length
        known = (self.code >= 97) & (self.code <= 122)
        accented = (self.code >= 0xC0) & (self.code <= 0xFF)
        letter = np.where(known, self.code - np.uint64(97), np.where(accented, self.code - np.uint64(0xC0 - 26), np.uint64(CLASSES - 1))).astype(np.int64)
        word = np.repeat(np.arange(len(words)), self.length)
        at = np.delete(np.arange(len(self.code)), self.start + self.length - 1)
        self.word, self.place = word[at], at - self.start[word[at]]
        self.gram = letter[at] * CLASSES + letter[at + 1]
        # Sums of code points times powers of BASE: the hash of any part of a word is a difference of two.
        longest = int(self.length.max())
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(longest, BASE)], dtype=np.uint64)
        inverse = np.uint64(pow(int(BASE), -1, 2 ** 64))
        self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(longest, inverse)], dtype=np.uint64)
        within = np.arange(len(self.code)) - self.start[word]
        self.sums = np.r_[np.uint64(0), np.cumsum(self.code * self.power[within], dtype=np.uint64)]

    def part(self, word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of characters ``begin`` to ``end`` of the words."""
        s = self.start[word]
        return mixed((self.sums[s + end] - self.sums[s + begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(32))


def prefixes(grams: Grams, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bigrams are in their word's prefix, and the rank of each word's last one."""
    r = rank[grams.gram]
    in_order = np.lexsort((r, grams.word))
    first = grams.start - np.arange(len(grams.start))
    last = r[in_order[first + 2]]
    return np.flatnonzero(r <= last[grams.word]), last


def pivots(word: np.ndarray, place: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Marks for each word (entries in order of word and place) the two disjoint bigrams of least cost together."""
    chosen = np.zeros(len(word), bool)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(word)])
    for m in np.unique(count):
        at = first[count == m][:, None] + np.arange(m)
        p, c = place[at], cost[at].astype(np.float64)
        least = np.minimum.accumulate(c, axis=1)
        # The best first pivot for each second one: of the entries before it, all but a directly neighbouring one.
        before = np.full(c.shape, np.inf)
        before[:, 2:] = least[:, :-2]
        apart = p[:, 1:] - p[:, :-1] >= 2
        before[:, 1:] = np.where(apart, least[:, :-1], before[:, 1:])
        second = np.argmin(c + before, axis=1)
        rows = np.arange(len(at))
        limit = p[rows, second] - 2
        one = np.argmin(np.where(p <= limit[:, None], c, np.inf), axis=1)
        chosen[at[rows, one]] = chosen[at[rows, second]] = True
    return chosen


def keys(grams: Grams, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and keys: each side of a bigram, a short one with the characters next to it or at the far end."""
    word, place = grams.word[entry], grams.place[entry]
    size = grams.length[word]
    number, key = [], []
    zero = np.zeros(len(entry), np.int64)
    for side, begin, end in ((1, zero, place + 2), (2, place, size)):
        own = end - begin
        more = np.where(own <= 3, 2, np.where(own <= 5, 1, 0))
        base = grams.part(word, begin, end) + np.uint64(side)
        near = (end, end + more) if side == 1 else (begin - more, begin)
        far = (size - more, size) if side == 1 else (zero, more)
        for tag, (a, b), use in ((1, near, more > 0), (2, far, more > 0), (3, (zero, zero), more == 0)):
            i = np.flatnonzero(use)
            number.append(i)
            key.append(mixed(base[i] * MIX + grams.part(word[i], a[i], b[i]) + np.uint64(tag)))
    return np.concatenate(number), np.concatenate(key).astype(np.int64)


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram`` (class pair), ``n`` words that hold it; at most CLASSES squared rows."""
    def run(batches):
        total = np.zeros(CLASSES ** 2, np.int64)
        for batch in batches:
            if batch.num_rows:
                grams = Grams(batch.column(0).to_pylist())
                once = np.unique(grams.word * CLASSES ** 2 + grams.gram) % CLASSES ** 2
                total += np.bincount(once, minlength=CLASSES ** 2)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    return words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``a_n``, ``b_n``: each pair of ``words`` (word, n; distinct, seven characters or more) at edit distance one, once."""
    cost = np.zeros(CLASSES ** 2, np.int64)
    for row in gram_counts(words).collect():
        cost[row["gram"]] = row["n"]
    rank = np.empty(CLASSES ** 2, np.int64)
    rank[np.lexsort((np.arange(CLASSES ** 2), cost))] = np.arange(CLASSES ** 2)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 10_000):
                part = batch.slice(lo, 10_000)
                grams = Grams(part.column(0).to_pylist())
                entry, last = prefixes(grams, rank)
                pivot = pivots(grams.word[entry], grams.place[entry], cost[grams.gram[entry]])
                number, key = keys(grams, entry)
                word = grams.word[entry][number]
                at = pa.array(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(pivot[number]), pa.array(last[word]), pa.array(grams.length[word]), part.column(0).take(at), part.column(1).take(at)],
                    ["key", "pivot", "last", "size", "word", "n"])

    rows = words.select("word", "n").mapInArrow(run, "key long, pivot boolean, last long, size long, word string, n long")
    probe = rows.where("pivot").drop("pivot")
    index = rows.drop("pivot").toDF("key", "last_b", "size_b", "b", "b_n")
    found = probe.join(index, "key").where(
        "(last < last_b OR (last = last_b AND word < b)) AND abs(size - size_b) <= 1").where(F.levenshtein("word", "b", 1) == 1)
    return found.select(F.col("word").alias("a"), "b", F.col("n").alias("a_n"), "b_n").distinct()


def forms(near: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``form``, ``form_n`` of each word of the pairs: its neighbour of most occurrences, if it has TIMES as many."""
    both = near.select(F.col("a").alias("word"), F.col("a_n").alias("n"), "b", "b_n").union(near.select("b", "b_n", "a", "a_n"))
    best = both.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best"))
    some = -F.col("best.less") >= TIMES * F.col("n")
    return best.select("word", "n_near", F.when(some, F.col("best.b")).alias("form"), F.when(some, -F.col("best.less")).alias("form_n"))


def roots(variants: DataFrame, steps: int) -> DataFrame:
    """``word``, ``root`` for ``word``, ``form`` rows: the end of each chain of at most ``steps`` forms, the distance doubled by each join."""
    out = variants.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        on = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = out.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return out


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of seven letters or more that occurs at least twice, spoiled occurrences included.

    ``form`` is the word's neighbour (one character inserted, deleted or replaced) of most occurrences, the first in code-point order of equals,
    if it has ten times the word's; ``root`` is the last form when forms are followed. Only doc_id and text are read; null texts and empty tables give no words, repeated rows count again.
    """
    spark = docs.sparkSession
    path = new_shared_path(spark, "words")
    word_counts(spoiled_words(docs)).write.parquet(path)
    words = spark.read.schema("word string, n long").parquet(path)
    most = words.agg(F.max("n")).first()[0] or 0
    known = checkpointed(forms(near_pairs(words)))
    # Each form has ten times its variant's occurrences, of which there are two or more.
    steps = math.ceil(math.log(max(1, most), TIMES))
    ends = roots(known.where(F.col("form").isNotNull()), steps)
    joined = words.join(known, "word", "left").join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
