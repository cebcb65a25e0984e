"""Whether what arrived is what was sent, message by message, without holding the messages against each other.

Each message has a hash of its key and value, and the hashes of a set of messages add up to a digest that no order
changes but any lost, repeated or altered message does. Sent messages count up, delivered ones down, so a set
that agrees comes to zero. Sets are the cells of a tree: stretches of time and parts of the key's hash on top,
finer parts below, single keys at the bottom. All messages pass one aggregation at the top; each further level only
shuffles those of cells that did not come to zero, and only the messages of differing keys are named.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.workspace import stage

# Bits of the key's hash that tell cells apart, level by level.
LEVELS = (10, 22)
# Parts of a hash, small enough for the sum over 2^41 messages to be exact.
LIMBS = ((0, 22), (22, 21), (43, 21))
FOUND = "key, value, sent, delivered, finding"
MISSING, UNEXPECTED, REPEATED, CHANGED, MOVED = "missing", "unexpected", "repeated", "changed", "moved"


def reconcile_content(sent: DataFrame, delivered: DataFrame, *, stretch: str | None = None, levels: Sequence[int] = LEVELS) -> DataFrame:
    """key, value, sent, delivered and finding of every different message that did not arrive as often as it was sent.

    ``sent`` and ``delivered`` have key and value, and may share a column ``stretch`` that cells go by as well.
    Findings: ``moved`` has the same value missing under one key and unexpected under another, ``changed`` has
    other values missing and unexpected under one key, ``repeated`` arrived more often than it was sent,
    ``missing`` less often, ``unexpected`` was never sent. NULL keys and values are messages like any other. Nothing
    comes back when all agree, which takes one aggregation of one row per cell and task.
    """
    both = _signed(sent, 1, stretch).unionByName(_signed(delivered, -1, stretch))
    open_ = both
    for level, bits in enumerate(levels):
        cell = F.shiftright(F.xxhash64("key"), 64 - bits)
        differ = stage(_differing(open_.withColumn("cell", cell), ["stretch", "cell"]), f"cells-{level}")
        if differ.isEmpty():
            return _named(both.filter(F.lit(False)))
        named = differ.select(F.col("stretch").alias("_s"), F.col("cell").alias("_c"))
        match = F.col("stretch").eqNullSafe(F.col("_s")) & (cell == F.col("_c"))
        # Spark sends the list to all tasks while its file is small and joins by shuffle beyond.
        open_ = both.join(named, match, "left_semi")
    return _named(open_)


def digests(messages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Messages per group and the digest of their contents, three numbers."""
    return messages.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"d{i}") for i, x in enumerate(_limbs())])


def _signed(messages: DataFrame, sign: int, stretch: str | None) -> DataFrame:
    at = F.col(stretch) if stretch else F.lit(0)
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        at.cast("bigint").alias("stretch"),
        F.lit(sign).cast("bigint").alias("sign"),
    )


def _limbs() -> list[Column]:
    # A NULL does not enter xxhash64, so whether there is one does.
    whole = F.xxhash64(F.col("key").isNull(), "key", F.col("value").isNull(), "value")
    return [F.shiftrightunsigned(whole, at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")) for at, bits in LIMBS]


def _differing(signed: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose sent and delivered messages do not come to zero."""
    sums = [F.sum("sign").alias("n"), *[F.sum(F.col("sign") * x).alias(f"d{i}") for i, x in enumerate(_limbs())]]
    nonzero = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in ("n", *[f"d{i}" for i in range(len(LIMBS))])])
    return signed.groupBy(*by).agg(*sums).filter(nonzero).select(*by)


def _named(signed: DataFrame) -> DataFrame:
    """The messages whose counts differ, and what is wrong with each."""
    counted = signed.groupBy("key", "value").agg(
        F.count_if(F.col("sign") > 0).alias("sent"), F.count_if(F.col("sign") < 0).alias("delivered")
    )
    wrong = stage(counted.filter("sent <> delivered"), "differences")
    lost, new = F.col("delivered") == 0, F.col("sent") == 0

    def both_ways(by: str) -> DataFrame:
        """Where messages that never arrived meet messages that were never sent."""
        seen = wrong.groupBy(F.col(by).alias(f"_{by}")).agg(F.bool_or(lost).alias("lost"), F.bool_or(new).alias("new"))
        return seen.filter("lost AND new").select(f"_{by}", F.lit(True).alias(f"_by_{by}"))

    marked = wrong
    for by in ("value", "key"):
        marked = marked.join(both_ways(by), F.col(by).eqNullSafe(F.col(f"_{by}")), "left")
    finding = (
        F.when((lost | new) & F.col("_by_value"), MOVED)
        .when((lost | new) & F.col("_by_key"), CHANGED)
        .when(new, UNEXPECTED)
        .when(F.col("delivered") > F.col("sent"), REPEATED)
        .otherwise(MISSING)
    )
    return marked.select("key", "value", "sent", "delivered", finding.alias("finding"))
