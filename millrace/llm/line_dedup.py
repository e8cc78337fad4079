"""Line dedup with a suffix array over line ids.

Texts become sequences of line ids. A suffix is a place in such a sequence; suffixes are sorted by prefix doubling, without
any task seeing more than a range of them: ranks by the first line, then by pairs of ranks, by the first two, four, ... lines,
until ``min_lines`` are compared. Neighbours in that order with equal ranks have a common prefix of ``min_lines`` lines or
more: an interval of such neighbours holds all places where one run of lines stands. The first place (by id, then by line)
stays; the lines of all later ones are deleted. A line with more than ``long_words`` words is a run by itself: the intervals
of its place are those of the first order, by one line. A longer run that repeats is covered by its runs of ``min_lines``
lines, which repeat with it, so doubling beyond that would delete the same lines.

Lines that stand only once end every run, so after the first count they are left out. Counts and minima are combined
before the shuffle, and ranks are running sums over sorted ranges of distinct values.

Defined cases: null texts stay null and an empty text is one empty line; a run is counted within one text; rows equal in id
and text are one document read twice and get the same result; equal ids with different texts are told apart by the text; null
ids come first; an empty table gives no rows; extra columns are ignored. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

MIN_LINES = 2
# A line with more words is a run of its own.
LONG_WORDS = 50


def _ranks(values: DataFrame, by: list[str]) -> DataFrame:
    """``by``, the ``place`` of it (the number of suffixes sorted before) and how many share it, per distinct value."""
    counted = values.groupBy(*by).agg(F.count(F.lit(1)).alias("same"))
    ranged = counted.repartitionByRange(*by).sortWithinPartitions(*by)
    stored = materialize(ranged.withColumn("part", F.spark_partition_id()), "ranks")
    totals = stored.groupBy("part").agg(F.sum("same").alias("total"))
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start")))
    upto = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    placed = stored.withColumn("place", F.sum("same").over(upto) - F.col("same")).join(starts, "part")
    return placed.select(*by, (F.col("place") + F.col("start")).alias("place"), "same")


def _document_key(id_col: str, text_col: str) -> dict[str, Column]:
    return {
        "none": F.col(id_col).isNull(), "name": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        "of": F.xxhash64(text_col),
    }


def _is_long(line: Column, words: int) -> Column:
    """Whether a line has more than ``words`` words; only lines that have the room for them are searched."""
    counted = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) > words
    return (F.octet_length(line) > 2 * words) & counted


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES,
                   long_words: int = LONG_WORDS) -> DataFrame:
    """Where repeated runs begin: document key, ``line``, ``n_lines`` (``min_lines``, or 1 for a long line), ``run`` (its rank
    among runs of so many lines), and ``later`` for all places but the first."""
    document = ["none", "name", "of"]
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col)).withColumns(_document_key("id", text_col))
    each = F.transform(F.split(text_col, "\n"), lambda x: F.struct(F.xxhash64(x).alias("value"), _is_long(x, long_words).alias("long")))
    lines = materialize(
        keyed.select("id", *document, F.posexplode(each).alias("line", "of_line")).select("id", *document, "line", "of_line.*").distinct(),
        "lines",
    )
    ranked = _ranks(lines, ["value"]).filter("same > 1")
    single = materialize(lines.join(ranked, "value").select("id", *document, "line", "long", F.col("place").alias("rank")), "places")

    def at(step: int) -> Column:
        """The rank ``step`` lines further on in the text; null if that line stands only once or is past the end."""
        return F.first("rank").over(Window.partitionBy(*document).orderBy("line").rangeBetween(step, step))

    places = single
    known = 1
    while known < min_lines:
        step = min(known, min_lines - known)  # the last pair may overlap
        pairs = materialize(places.withColumn("next", at(step)).filter("next IS NOT NULL"), "pairs")
        ranks = _ranks(pairs, ["rank", "next"]).filter("same > 1")
        places = materialize(pairs.join(ranks, ["rank", "next"]).select("id", *document, "line", F.col("place").alias("rank")), "places")
        known += step
    columns = ["id", *document, "line", "rank"]
    runs_ = places.select(*columns, F.lit(min_lines).alias("n_lines"))
    if min_lines > 1:
        runs_ = runs_.unionByName(single.filter("long").select(*columns, F.lit(1).alias("n_lines")))
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "of", "line")
    # Stored, so that the join has a shuffle of its own on either side, and adaptive execution can split a hot run.
    first = materialize(runs_.groupBy("n_lines", "rank").agg(F.min(place).alias("first")), "first")
    return runs_.join(first, ["n_lines", "rank"]).select(
        *document, "line", "n_lines", F.col("rank").alias("run"), (~place.eqNullSafe(F.col("first"))).alias("later")
    )


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES,
         long_words: int = LONG_WORDS) -> DataFrame:
    """The stretches of lines that are deleted, neighbouring ones as one: document key, first ``line`` and ``n_lines``."""
    document = ["none", "name", "of"]
    later = repeated_lines(docs, id_col, text_col, min_lines, long_words).filter("later")
    order = Window.partitionBy(*document).orderBy("line", "n_lines")
    before = F.max(F.col("line") + F.col("n_lines")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    breaks = F.col("line") > F.coalesce(before, F.lit(-1))
    number = later.withColumn("break", breaks.cast("int")).withColumn("island", F.sum("break").over(order))
    return number.groupBy(*document, "island").agg(
        F.min("line").alias("line"), (F.max(F.col("line") + F.col("n_lines")) - F.min("line")).alias("n_lines")
    ).drop("island")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES,
          long_words: int = LONG_WORDS) -> DataFrame:
    """One row per document: the id, ``text`` without later copies of repeated runs, ``n_lines`` and ``n_removed``."""
    document = ["none", "name", "of"]
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = runs(source, "id", "text", min_lines, long_words)
    gone = F.flatten(F.collect_list(F.sequence(F.col("line"), F.col("line") + F.col("n_lines") - 1)))
    deleted = found.groupBy(*document).agg(F.array_distinct(gone).alias("gone"))
    met = source.withColumns(_document_key("id", "text")).join(deleted, document, "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    kept = F.array_join(F.transform(stay, lambda k: F.get(lines, k)), "\n")
    removed = F.coalesce(F.size("gone"), F.lit(0))
    return met.select(
        F.col("id").alias(id_col), F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(removed).cast("bigint").alias("n_removed"),
    )
