"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked to the target marginals in turn until all hold, or until more rounds bring them no
nearer, as with targets that contradict each other; ``gaps`` tells how near they are, and ``strict`` refuses the rest. Documents are
sampled with probabilities in proportion to their cell's factor. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tallymart.llm.common import unused
from tallymart.session import checkpointed

MARGINS = ["source", "lang", "topic"]
# A table of this many cells is raked in one partition and broadcast to the documents; a larger one is shuffled.
SMALL_CELLS = 50_000
# Margins hold when none is further from its target than this part of it.
CLOSE = 1e-10
# Raking ends unmet when this many sweeps take off less than a tenth of the gap.
PATIENCE = 5


def tokens(text: Column) -> Column:
    """Tokens by blanks and line breaks: one more than there are; an empty or null text has none."""
    gaps = F.octet_length(text) - F.octet_length(F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(gaps + 1).cast("long")


def times(text: Column, what: str) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(what), F.lit("")))) / len(what)


def topic(text: Column, n: Column) -> Column:
    """What a text mostly consists of: table, shouting, symbols, or short or long prose."""
    text = F.coalesce(text, F.lit(""))
    marks = times(text, "***") + times(text, "$$$") + times(text, "%%%") + times(text, "&&&") + times(text, "###")
    return (F.when(n < times(text, "|") * 10, "table").when(n < times(text, "!!") * 10, "shouting")
            .when(n < marks * 10, "symbols").when(n < 200, "short prose").otherwise("long prose"))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the doc_id only."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / float(2 ** 32)


def cells(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, tokens per document; a null source or language is an empty one."""
    n = tokens(F.col("text"))
    first = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text", n.alias("tokens"))
    return first.select("doc_id", "source", "lang", topic(F.col("text"), F.col("tokens")).alias("topic"), "tokens")


def shares_of(table: DataFrame, margin: str, targets: dict[str, DataFrame] | None, temperature: float) -> DataFrame:
    """The margin's values that occur, and their target ``{margin}_share``; shares of values that occur add up to one."""
    own = table.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("share"))
    if targets and margin in targets:
        given = targets[margin].select(F.col("value").cast("string").alias(margin), F.col("share").cast("double").alias("given"))
        own = own.join(given, margin, "left").select(margin, F.coalesce("given", F.lit(0.0)).alias("share"))
    own = checkpointed(own)
    total = own.agg(F.sum("share")).first()[0] or 0.0
    return own.select(margin, F.coalesce(F.try_divide(F.col("share"), F.lit(total)), F.lit(0.0)).alias(f"{margin}_share"))


def rake(table: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.8, strict: bool = False) -> tuple[DataFrame, bool]:
    """The cells with ``factor``: weights tokens * factor add up to the target share of every margin's values.

    ``targets`` has a table (value, share) per margin; shares are scaled so that those of values that occur add up to one. Margins without one aim at
    the share of tokens to the power ``temperature``, scaled to one. Raking ends when every margin is within CLOSE of its targets, or when
    PATIENCE sweeps take less than a tenth off the largest gap: then ``strict`` raises a ValueError, otherwise the nearest weights are returned, the last
    margin met. Returns the cells and whether they are few enough to be broadcast.
    """
    small = table.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS
    table = checkpointed(table.coalesce(1) if small else table)
    tokens_of_all = float(table.agg(F.sum("tokens")).first()[0] or 1)
    for margin in MARGINS:
        own = shares_of(table, margin, targets, temperature)
        table = table.join(F.broadcast(own) if small else own, margin)
    # Weights are parts of one, and stay so: shares add up to one.
    table = checkpointed(table.withColumn("weight", F.col("tokens") / F.lit(tokens_of_all)))
    gaps: list[float] = []
    while True:
        if small:
            table = table.coalesce(1)
        # ``_off``: how far the margins are from their targets just before they are raked again.
        for margin in MARGINS:
            now, share = F.sum("weight").over(Window.partitionBy(margin)), F.col(f"{margin}_share")
            off = F.when(share > 0, F.abs(now / share - 1)).otherwise(now)
            table = table.withColumn("_off", off if margin == MARGINS[0] else F.greatest("_off", off))
            table = table.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * share, now), F.lit(0.0)))
        table = checkpointed(table)
        gaps.append(table.agg(F.max("_off")).first()[0] or 0.0)
        if gaps[-1] < CLOSE:
            break
        if len(gaps) > PATIENCE and gaps[-1] > 0.9 * gaps[-1 - PATIENCE]:
            if strict:
                raise ValueError(f"targets cannot be met: after {len(gaps)} sweeps a margin is {gaps[-1]:.3g} of its target away")
            break
    return table.withColumn("factor", F.coalesce(F.try_divide(F.col("weight"), F.col("tokens")), F.lit(0.0))), small


def cells_of(docs: DataFrame) -> DataFrame:
    """Tokens of each cell that has any."""
    return docs.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")


def calibrated(rows: DataFrame, targets: dict[str, DataFrame] | None, temperature: float, strict: bool) -> tuple[DataFrame, bool]:
    """The probability of each cell (to nine digits), and whether cells are few enough to be broadcast."""
    table, small = rake(cells_of(rows), targets, temperature, strict)
    most = table.agg(F.max("factor")).first()[0]
    return checkpointed(table.select(*MARGINS, F.round(F.col("factor") / F.lit(most or 1.0), 9).alias("probability"))), small


def gaps(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.8) -> DataFrame:
    """margin, value, target, share (what raking reaches) and gap (share / target - 1; null for a target of zero), a row per value that occurs."""
    table, _ = rake(cells_of(cells(docs)), targets, temperature)
    total = table.agg(F.sum("weight")).first()[0] or 1.0
    rows = [table.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.max(f"{m}_share").alias("target"), (F.sum("weight") / F.lit(total)).alias("share"))
            for m in MARGINS]
    found = rows[0].union(rows[1]).union(rows[2])
    return found.withColumn("gap", F.try_divide(F.col("share"), F.col("target")) - 1)


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.8, strict: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, tokens, probability, kept.

    The cell with the largest factor is kept whole (probability 1), the others in proportion, so the expected tokens of the kept documents
    have the target marginals, as far as ``rake`` can meet them (see ``gaps``; with ``strict`` targets that cannot be met raise a ValueError). A document
    is kept if its number in [0, 1), a hash of its doc_id, is below its probability (rounded
    to nine digits). Null or empty texts have no tokens: they weigh nothing and are kept with their cell, or with probability 1 in
    a cell without tokens. Rows that repeat a doc_id in the same cell stay or go together; other columns are ignored.
    """
    rows = checkpointed(cells(docs))
    table, small = calibrated(rows, targets, temperature, strict)
    out = rows.join(F.broadcast(table) if small else table, MARGINS, "left")
    out = out.withColumn("probability", F.coalesce("probability", F.lit(1.0)))
    return out.select("doc_id", *MARGINS, "tokens", "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = 0.8, strict: bool = False) -> DataFrame:
    """The documents that ``mixed`` keeps, columns unchanged; the decision is made on each row again, without joining texts."""
    own = unused("mix", docs.columns)
    table, small = calibrated(cells(docs), targets, temperature, strict)
    table = table.select(*[F.col(m).alias(f"{own}_{m}") for m in MARGINS], F.col("probability").alias(f"{own}_p"))
    n = tokens(F.col("text"))
    of_doc = {"source": F.coalesce(F.col("source").cast("string"), F.lit("")), "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")), "topic": topic(F.col("text"), n)}
    keyed = docs.withColumns({f"{own}_k_{m}": of_doc[m] for m in MARGINS})
    same = [F.col(f"{own}_k_{m}") == F.col(f"{own}_{m}") for m in MARGINS]
    kept = keyed.join(F.broadcast(table) if small else table, same, "left").where(
        uniform(F.col("doc_id")) < F.coalesce(f"{own}_p", F.lit(1.0)))
    return kept.select(*[docs[c] for c in docs.columns])
