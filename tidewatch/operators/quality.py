"""Quarantine and bounded retry (SNK-05/07, STR-12/13, SRC-05, DOM-28, Q9, Q12).

Rows that cannot be processed never fail a job: they are routed to a quarantine frame
with a reason and an attempt counter.  A retry run re-enters them through the same
operator; rows that still fail get ``attempt + 1`` and are given up (``dead``) once they
reach the configured maximum, instead of being re-queued forever.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_quarantine(rejected: DataFrame, reason: str | F.Column, attempt: int = 0) -> DataFrame:
    r = F.lit(reason) if isinstance(reason, str) else reason
    return rejected.withColumn("reason", r).withColumn("attempt", F.lit(attempt))


def retry(quarantine: DataFrame, process: Callable[[DataFrame], DataFrame], max_attempts: int) -> DataFrame:
    """Re-process quarantined rows in one pass and label each with its ``outcome``:
    ``recovered``, ``requeued`` (``attempt + 1`` still below the maximum) or ``dead``
    (the maximum is reached -- never re-queued forever).

    ``process`` enriches the rows and adds a boolean ``_ok``; rows already at the
    maximum are not retried.  No branch is recomputed: one frame, one outcome column."""
    tried = process(quarantine)
    gone = F.col("attempt") >= max_attempts
    ok = ~gone & F.coalesce(F.col("_ok"), F.lit(False))
    nxt = F.col("attempt") + 1
    outcome = (F.when(gone, "dead").when(ok, "recovered").when(nxt >= max_attempts, "dead")
                .otherwise("requeued"))
    return (tried.withColumn("outcome", outcome)
                 .withColumn("attempt", F.when(gone | ok, F.col("attempt")).otherwise(nxt))
                 .drop("_ok"))


def nested_verdict(event: DataFrame, path: str = "Used_by_ES_ExtendInfo") -> F.Column:
    """Q9: the verdict of a standardised event is read from its nested block (the
    reference's retry job reads a top-level key that does not exist and always routes
    white)."""
    return F.when(F.coalesce(F.col(f"{path}.is_malicious"), F.lit(False)) |
                  F.coalesce(F.col(f"{path}.alert"), F.lit(False)), "black").otherwise("white")
