"""Rows that could not be sent, tried again until they can or have had their tries.

Rejected rows become letters: the row, why it was rejected, how often it has been tried and what became of it.
A round lets a rule mend the waiting ones, sends those that pass now, and writes all letters anew; the last round
written is where a restart goes on. There are at most as many rounds as tries.
"""

from __future__ import annotations

import time as wall
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.config import ReplayConfig, Sink
from pulsetrail.functions.columns import column
from pulsetrail.operators.envelope import envelope, split_rejects
from pulsetrail.operators.messages import write_messages
from pulsetrail.workspace import path_exists

WAITING, DELIVERED, DEAD = "waiting", "delivered", "dead"
LETTER = "_pt_letter"

Mend = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class RetryPolicy:
    """How often a row is tried, and the wait before the first try and from one to the next."""

    tries: int = 3
    first_wait_s: float = 60.0
    factor: float = 2.0


def retry_rejects(
    spark: SparkSession,
    rejected: DataFrame,
    mend: Mend,
    config: ReplayConfig,
    sink: Sink,
    path: str,
    *,
    policy: RetryPolicy = RetryPolicy(),
    sleep: Callable[[float], None] = wall.sleep,
) -> DataFrame:
    """Try the rows of ``split_rejects`` again; returns the letters: reason, tries, state and the row as it is now.

    ``mend(rows, round)`` gives back the rows with their columns set right where it can, one row for each and no
    columns lost. A row is ``delivered`` in one round only: a sink with a path holds a folder per round, which a
    round that broke off replaces; a Kafka topic may get a round's messages twice. What still can not be sent
    after all tries is ``dead`` with its last reason. Letters are kept at ``path``, a folder per round.
    """
    columns = [c for c in rejected.columns if c != "reason"]
    done = max((r for r in range(policy.tries + 1) if path_exists(spark, f"{path}/round-{r}/_SUCCESS")), default=None)
    if done is None:
        # Written files give each row the same number from here on.
        row = F.struct(*[column(c) for c in columns]).alias("row")
        new = rejected.select("reason", F.lit(0).alias("tries"), F.lit(WAITING).alias("state"), row)
        new.write.mode("overwrite").parquet(f"{path}/round-0")
        done = 0
    letters = _round(spark, path, done)
    while done < policy.tries and not letters.filter(F.col("state") == WAITING).isEmpty():
        sleep(policy.first_wait_s * policy.factor**done)
        done += 1
        _try_again(letters, mend, config, sink, policy, done).write.mode("overwrite").parquet(f"{path}/round-{done}")
        letters = _round(spark, path, done)
    return letters


def _round(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/round-{number}")


def _try_again(letters: DataFrame, mend: Mend, config: ReplayConfig, sink: Sink, policy: RetryPolicy, number: int) -> DataFrame:
    """The letters after one more round; messages of rows that pass are sent."""
    waiting = letters.filter(F.col("state") == WAITING)
    mended = mend(waiting.select("row.*", F.col("tries").alias(LETTER)), number)
    good, bad = split_rejects(mended, config)
    write_messages(envelope(good.drop(LETTER), config), sink.under(f"round={number}"))
    columns = [c for c in mended.columns if c != LETTER]

    def settled(rows: DataFrame, state: str, reason: str | None) -> DataFrame:
        why = F.lit(reason).cast("string") if reason is None else F.col(reason)
        row = F.struct(*[column(c) for c in columns]).alias("row")
        return rows.select(why.alias("reason"), (F.col(LETTER) + 1).alias("tries"), F.lit(state).alias("state"), row)

    last = number >= policy.tries
    settled_before = letters.filter(F.col("state") != WAITING)
    after = settled(good, DELIVERED, None).unionByName(settled(bad, DEAD if last else WAITING, "reason"))
    return settled_before.unionByName(after)
