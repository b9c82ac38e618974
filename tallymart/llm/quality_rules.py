"""Quality rules: a table of thresholds compiled into one projection of built-in Spark functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.llm.common import BLANK

SYMBOLS = "[#*$%&|<>]"
# Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as "
    "der die das und den von zu mit ist im "
    "de la le les et des un une en du "
    "que el los las por con para no se").split()
# Window numbers and hashes share a long: this many bits for the number.
PLACE_BITS = 24


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high`` where the text has at least ``min_words`` words."""
    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 1


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2, 16),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.25),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9, 20),
    Rule("ellipsis_lines", "n_ellipsis_lines / n_lines", None, 0.5, 20),
    Rule("words_with_letters", "n_letter_words / n_words", 0.6, None),
    Rule("stop_words", "n_stop_words", 1, None, 100),
)


def compiled(rules=RULES) -> Column:
    """One condition that is true where every rule holds."""
    out = F.lit(True)
    for rule in rules:
        value, ok = F.expr(rule.measure), F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= rule.low)
        if rule.high is not None:
            ok = ok & (value <= rule.high)
        out = out & (F.when(F.col("n_words") >= rule.min_words, ok).otherwise(True))
    return out


def _repeat_words(words: str, n: str, size: int = 5) -> Column:
    """Words inside windows of ``size`` words that occur at least twice in the text.

    Windows are hashed, and hash and position are sorted as plain longs; windows whose upper hash bits meet a
    neighbour's are compared word by word. A text with more positions than the long has room for compares all windows so.
    """
    low = (1 << PLACE_BITS) - 1
    w = F.col(words)
    starts = F.sequence(F.lit(0), F.col(n) - size)
    packed = F.sort_array(F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
                                      .bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

    def meets(x, i, s):
        same = lambda y: F.shiftrightunsigned(x.bitwiseXOR(y), PLACE_BITS) == 0
        return same(F.get(s, i + 1)) | same(F.get(s, i - 1))

    # let-binding: the sorted array is an array of one array, so that it is made once
    likely = F.flatten(F.transform(F.array(packed), lambda s: F.transform(
        F.filter(s, lambda x, i: meets(x, i, s)), lambda x: x.bitwiseAND(F.lit(low)).cast("int"))))
    likely = F.when(F.col(n) <= low, likely).otherwise(starts)
    exact = F.sort_array(F.transform(likely, lambda p: F.struct(F.array_join(F.slice(w, p + 1, size), " ").alias("t"), p.alias("p"))))

    def twice(s):
        again = lambda x, i: (x["t"] == F.get(s, i + 1)["t"]) | (x["t"] == F.get(s, i - 1)["t"])
        return F.sort_array(F.transform(F.filter(s, again), lambda x: x["p"]))

    places = F.flatten(F.transform(F.array(exact), twice))
    # Each window adds its words up to the next repeated window's start.
    covered = F.transform(F.array(places), lambda a: F.aggregate(
        F.transform(a, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(a, i + 1) - p, F.lit(size)))), F.lit(0), lambda x, y: x + y))
    return F.when(F.col(n) <= size, F.lit(0)).otherwise(F.get(covered, F.lit(0)))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text, from built-in functions only."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        F.col("doc_id"), text.alias("text"),
        F.array_remove(F.split(text, BLANK + "+"), "").alias("words"), F.split(text, "\n").alias("lines"))
    lines = F.filter("lines", lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    second = first.select(
        "doc_id", "text", "words", F.size("words").alias("n"), F.greatest(F.size("lines"), F.lit(1)).cast("long").alias("n_lines"),
        lines.alias("filled"))
    stops = F.array(*[F.lit(v) for w in STOP_WORDS for v in (w, w.capitalize(), w.upper())])
    measures = F.struct(
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
        _repeat_words("words", "n").cast("long").alias("n_repeat_words"),
        F.col("n_lines"),
        F.size(F.filter("filled", lambda x: F.regexp_like(x, F.lit(r"^[\x20\t]*[-*•]")))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("filled", lambda x: F.regexp_like(x, F.lit(r"(\.\.\.|…)[\x20\t\r]*$")))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("words", lambda x: F.regexp_like(x, F.lit(r"\p{L}")))).cast("long").alias("n_letter_words"),
        F.size(F.array_intersect("words", stops)).cast("long").alias("n_stop_words"))
    # Through inline() no later filter can be pushed below the measures, where each would be computed again and again.
    return second.select("doc_id", F.inline(F.array(measures)))


def judged(docs: DataFrame, rules=RULES, min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measures, base_failed and kept.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them in five-word windows that
    occur twice. ``kept``: not base_failed and every rule holds. A null text is empty: one line, no words, so base_failed.
    Repeated rows are judged each, a null doc_id is passed on, other columns are ignored.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return measured(docs).withColumn("base_failed", failed).withColumn(
        "kept", F.coalesce(F.when(F.col("base_failed"), False).otherwise(compiled(rules)), F.lit(False)))
