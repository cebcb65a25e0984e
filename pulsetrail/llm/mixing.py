"""Mix sources to target weights by systematic sampling.

A source's target is its share of all words by weight, at most ``CAP`` times what the source has; what
is over goes to the others by weight until none is above. Within a source every document has the same
expected number of copies, target over size. Documents are put in order of their size and these
expectations are summed up along it; one offset is added per source, and a document is emitted once for
each whole number its stretch of the sum crosses. In order of size, neighbours are alike, so the words
taken come within about one document of the target.

Rows: a NULL source is a source of its own and comes last; a NULL text has size 0 and may be taken any
number of times without adding words. Repeated rows are documents of their own. An empty table gives an
empty mix. Only counts per source and range go through one task, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import keep_row, with_word_count
from pulsetrail.llm.ranks import ranked
from pulsetrail.workspace import stage

CAP = 3
WEIGHTS = (5, 2, 1)
# Offsets are multiples of 1/65536, so that sums with whole numbers stay exact.
STEPS = 65536


def mix(
    df: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    carry: Sequence[str] | None = None,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``df`` as ``_row`` (of its columns those in ``carry``, or all) with ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken``.

    Sources take the ``weights`` in turn, by code point of their names.
    """
    named = [F.col(id).alias("id"), F.col(source).alias("source"), F.col(text).alias("text")]
    sized = with_word_count(keep_row(df, *named, carry=carry), "text", "size")
    # Rows without a source get a flag, as a join on the name would lose them.
    rows = sized.withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    by = ["no_source", "source"]
    rows = ranked(rows, by, ["size", "id"], "mix")
    sums = rows.groupBy(*by).agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sums, weights), "mix-targets")
    u, place = _offset(seed), F.col("place").cast("double")
    crossed = F.floor(u + F.col("ratio") * (place + 1)) - F.floor(u + F.col("ratio") * place)
    return (
        rows.join(targets, by)
        .withColumn("copies", crossed)
        .select("size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "_row")
    )


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sources`` (no_source, source, source_size) with ``target`` and ``ratio``, target over size.

    Sources in order of size over weight are at their cap up to some place; each row sees what the ones
    before it leave and decides whether its own part of that is above its cap.
    """
    place = F.row_number().over(Window.orderBy("no_source", "source")) - 1
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", cycle.cast("bigint"))
    key = F.col("source_size") / F.col("weight")
    order = Window.orderBy(key, "no_source", "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - CAP * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    cap = CAP * F.col("source_size")
    capped = weighed.withColumn(
        "capped",
        cap.cast("double") * open_weight.cast("double") <= F.col("weight").cast("double") * left.cast("double"),
    )
    rest = F.sum("source_size").over(every) - CAP * F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(every)
    weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("capped"), cap.cast("double")).otherwise((F.col("weight") * rest).cast("double") / weight.cast("double"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        capped.withColumn("target", target)
        .withColumn("ratio", ratio)
        .select("no_source", "source", "source_size", "target", "ratio")
    )


def mixed_rows(df: DataFrame, **names: str) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    mixed = mix(df, **names).filter("copies > 0")
    repeated = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return repeated.select("_row.*")


def _offset(seed: str) -> Column:
    """A fixed random number from [0, 1) for each source."""
    name = F.concat(F.lit(f"{seed}:"), F.when(F.col("no_source"), "-").otherwise(F.concat(F.lit("+"), "source")))
    return F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("double") / STEPS
