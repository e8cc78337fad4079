"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, gone through ``epochs`` times at most. A document's virtual
finish time is the number of words its source has sent up to its end, divided by the source's weight. In the order of
these times all sources are served side by side by weight; a source that has run dry leaves its share to the others. The
mix is that order up to the time at which the words sent reach the budget. Each source is in the middle of one document
then: that is cut there, or kept whole if at least half of it was sent.

Sums within a source are taken in two steps, over hash ranges of the shuffled order and then over the ranges, so no
task holds a source, and only ids and sizes are shuffled for them.

Defined cases: a null source is a source, the last one; null and empty texts have size 0 and are never taken; rows that are
equal in id and text are interchangeable; an empty table gives no rows, and budgets of 0 take nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the budget: 3/2 of all words
EPOCHS = 2
SEED = "mix-1"
# About so many rows of the table share the leading hash digits by which a source's sums are split.
RANGE_ROWS = 20_000
_EXACT = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE,
                   epochs: int = EPOCHS) -> DataFrame:
    """One row per source with its ``source_size``, ``weight`` and ``target`` (words, not rounded).

    Weights repeat over the sources in code point order, null last. A source is full where the words that all sources
    have sent when it runs dry still are within the budget. ``sizes`` has ``source`` and ``size``. Sums are combined before
    the shuffle; only the table of sources, one row each, is ordered as a whole.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(number, F.lit(len(weights))).cast("int") + 1)
    num, den = share
    ranked = totals.withColumn("weight", weight.cast("bigint")).withColumns({
        "cap": (F.col("source_size") * epochs).cast(_EXACT),
        "budget": (F.sum("source_size").over(everything) * num).cast(_EXACT),  # times den
    })
    # Sources by the time at which they run dry.
    dry = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    until = dry.rowsBetween(Window.unboundedPreceding, 0)
    exact = lambda c: c.cast(_EXACT)
    summed = ranked.withColumns({
        "gone": exact(F.sum("cap").over(until)),
        "left": exact(F.sum("weight").over(everything) - F.sum("weight").over(until)),
    })
    sent = (F.col("gone") * F.col("weight") + F.col("cap") * F.col("left")) * den
    full = summed.withColumn("full", sent <= F.col("budget") * F.col("weight")).withColumn("heavy", F.col("weight"))
    spent = exact(F.sum(F.when(F.col("full"), F.col("cap")).otherwise(F.lit(0))).over(everything))
    open_ = exact(F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(F.lit(0))).over(everything))
    shared = ((F.col("budget") - spent * den) * F.col("weight")).cast("double") / (open_ * den).cast("double")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared)
    return full.select("source", "source_size", "weight", target.alias("target"))


def schedule(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS,
             seed: str = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document with what the mix takes of it.

    ``id``, ``size``, ``source``, ``source_size``, ``target``, ``taken`` (words over all passes, the last document of a source
    cut), ``passes`` (an array with the words taken in each pass) and ``finish``, the virtual finish time of the first
    pass; besides the columns ``keep``.
    """
    # The shuffled order: by a seeded hash of the id, equal ids by text.
    spin = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))).cast("binary"))
    # A null source needs a name in joins; the flag keeps it apart from any text.
    placed_by = [
        F.col(id_col).alias("_id"), F.col(source_col).isNull().alias("_none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"), n_words(F.col(text_col)).alias("_size"),
        spin.alias("_spin"), F.xxhash64(F.col(text_col)).alias("_text"),
    ]
    # Without the texts this table is small, and it is needed three times.
    narrow = materialize(docs.select(*placed_by), "sizes")
    total, digits = narrow.count(), 1
    while total > RANGE_ROWS * 16**digits:
        digits += 1
    split = F.left("_spin", F.lit(digits))
    rows = (docs.select(*[F.col(c) for c in keep], *placed_by) if keep else narrow).withColumn("_range", split)
    narrow = narrow.withColumn("_range", split)
    sized = narrow.select(F.when(~F.col("_none"), F.col("_source")).alias("source"), F.col("_size").alias("size"))
    targets = source_targets(sized, weights, share, epochs)
    targets = targets.withColumns({"_none": F.col("source").isNull(), "_source": F.coalesce("source", F.lit(""))})
    key = ["_none", "_source"]
    ranges = narrow.groupBy(*key, "_range").agg(F.sum("_size").alias("_in"))
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    offsets = offsets.join(targets.select(*key, "source_size", "weight", "target"), key).drop("_in")

    within = Window.partitionBy(*key, "_range").orderBy("_spin", "_text", "_size")
    end = F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("_end", end).join(offsets, [*key, "_range"])
    start = F.col("_before") + F.col("_end") - F.col("_size")
    quota = F.floor("target")
    passes = F.array(*[
        F.greatest(F.lit(0), F.least(F.col("_size"), quota - (start + F.col("source_size") * k))).cast("bigint")
        for k in range(epochs)
    ])
    return placed.select(
        *keep, F.col("_id").alias("id"), F.col("_size").alias("size"),
        F.when(~F.col("_none"), F.col("_source")).alias("source"), "source_size", "target", passes.alias("passes"),
        F.aggregate(passes, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("taken"),
        ((F.col("_before") + F.col("_end")) / F.col("weight")).alias("finish"), "weight",
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The mixed documents, all columns, in the order of their virtual finish times.

    A document stands once for every pass that sends at least half of its words.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]  # clashes with no working column
    of = dict(zip(docs.columns, names))
    plan = schedule(docs.toDF(*names), id_col=of[id_col], text_col=of[text_col], source_col=of[source_col],
                    weights=weights, share=share, epochs=epochs, seed=seed, keep=names)
    sent = plan.select("*", F.posexplode("passes").alias("pass", "words")).filter("size > 0 AND words * 2 >= size")
    time = F.col("finish") + F.col("source_size") * F.col("pass") / F.col("weight")
    ordered = sent.withColumn("time", time).repartitionByRange("time", "id").sortWithinPartitions("time", "id")
    return ordered.select(*names).toDF(*docs.columns)
