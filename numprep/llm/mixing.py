"""Mixing sources to target weights: Efraimidis-Spirakis order within a source, cut at the source's word budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprep.llm.common import WORD, left_by, running_total, stored, text_of

#: Weights of the sources in code point order, repeated as often as needed.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words.
BUDGET = 1.5
#: A source, and so a document, is taken at most so many times.
EPOCHS = 2
#: Quality weights lie between this and 1, which bounds how far they can crowd the cells of the running total.
LEAST_QUALITY = 0.05
#: Rows of a source that are summed in one task, on average at even weights.
ROWS_PER_CELL = 4_000


def words(text: Column) -> Column:
    """Number of words of a text."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality(text: Column) -> Column:
    """Share of letters among the characters that are not blank, to the fourth power, at least ``LEAST_QUALITY``."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    seen = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    share = letters / F.greatest(seen, F.lit(1))
    return F.greatest(F.lit(LEAST_QUALITY), share * share * share * share)


def exponential_key(seed: str, weight: Column, *parts: Column) -> Column:
    """-ln(u) / weight, with u in (0, 1) from a hash: ascending, it draws without replacement in proportion to weight."""
    named = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    u = (F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 13), 16, 10).cast("double") + 0.5) * F.lit(2.0**-52)
    return -F.ln(u) / weight


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rows (source, source_size, rows, target) of rows (source, source_size, rows).

    Sources in code point order, the missing one last, weigh 3, 1, 2 and so on, and share ``BUDGET`` of all words. A
    target stops at ``EPOCHS`` times its source; the excess is shared again by weight until no target is above.
    Each round is one aggregate over the sources; only two sums reach the driver.
    """
    ordered = sizes.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    ranked = sizes.sparkSession.createDataFrame(
        ordered.map(lambda x: (*x[0], x[1])), sizes.schema.add("place", "long")
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = stored(ranked.withColumn("weight", weight), "sources").withColumn("cap", F.col("source_size") * EPOCHS)
    share = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(share)
        sums = weighed.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("cap")).otherwise(0)).alias("capped"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not sums["open"]:
            break
        again = (BUDGET * sums["words"] - sums["capped"]) / sums["open"]
        if again <= share:
            break
        share = again
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(share))
    return weighed.select("source", "source_size", "rows", target.alias("target"))


def measured(docs: DataFrame, seed: str) -> DataFrame:
    """The rows with ``size`` and ``_draw``, the exponential key of their place in the source."""
    text = text_of()
    return docs.withColumns(
        {"size": words(text), "_draw": exponential_key(seed, quality(text), F.col("doc_id"), text)}
    )


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """All rows with ``source_size``, ``target``, ``taken`` and ``copies``, of rows with ``source``, ``size`` and ``_draw``.

    Complete epochs come first: every document is taken floor(target / source_size) times. The rest of the target goes
    to the documents in the order of their exponential keys, until it is used up; ``taken`` counts words, so the last of
    them is taken in part, and every source's words are its target, rounded. ``copies`` counts whole documents: the last
    one counts if at least half of it is taken. The same rows give the same mix in any run and order; equal rows are
    interchangeable. A missing source is a source; a source without a word has the target 0; no row is lost.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(sizes)
    joined = left_by(docs, targets, ["source"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round("target").cast("long") - F.col("_epochs") * F.col("source_size")
    cells = F.ceil(F.col("rows") / ROWS_PER_CELL)
    cell = F.least(F.floor((1 - F.exp(-F.col("_draw") * LEAST_QUALITY)) * cells), cells - 1)
    prepared = joined.withColumn("_epochs", epochs.cast("long")).withColumns({"_rest": rest, "_cell": cell})
    order = [F.col("_draw"), F.col("doc_id"), F.col("size")]
    placed = running_total(prepared, ["source"], "_cell", order, F.col("size"), "_before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))
    whole = (F.col("_rest") - F.col("_before") >= F.col("size") / 2) & (F.col("size") > 0)
    return placed.withColumns(
        {
            "taken": (F.col("_epochs") * F.col("size") + part).cast("long"),
            "copies": (F.col("_epochs") + whole.cast("long")).cast("int"),
        }
    ).drop("rows", "_draw", "_epochs", "_rest", "_cell", "_before")
