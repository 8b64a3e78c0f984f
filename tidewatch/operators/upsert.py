"""Snapshot maintenance without MERGE: latest change per business key, then a full outer
join with the current snapshot (SURVEY §2.11, WIN-01).

Both sides are shuffled once on the business key; the result is written to a *new*
snapshot directory (``write_snapshot``), never over the path being read, so a lost
executor or a retried job simply recomputes the same snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_per_key(changes: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """WIN-01: keep the newest row of each key, "newest" = largest ``newest_first`` tuple
    (e.g. event time, then message offset as the deterministic tie-breaker).

    Written as ``max_by(row, ordering)`` aggregation rather than a ``row_number`` window:
    the aggregate is combined map-side, so a hot key (one asset sending a third of all
    reports) is reduced inside every task before the shuffle instead of being sorted in a
    single task."""
    rest = [c for c in changes.columns if c not in keys]
    if not rest:
        return changes.select(*keys).distinct()
    # exact ties on the ordering are broken by the remaining atomic columns -> deterministic
    atomic = {"string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "timestamp",
              "timestamp_ntz", "date"}
    ties = [f.name for f in changes.schema.fields
            if f.name in rest and f.name not in newest_first and f.dataType.simpleString() in atomic]
    order = F.struct(*[F.col(c) for c in list(newest_first) + ties])
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_latest"))
    return latest.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])


def upsert(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], insert_defaults: dict[str, Column] | None = None) -> DataFrame:
    """Full outer join on ``keys``: for a changed key the ``update_cols`` take the change's
    values (a NULL in the change sets NULL, as an SQL UPDATE would), new keys are inserted,
    untouched keys keep their snapshot row.  ``changes`` must hold one row per
    key (see ``latest_per_key``).  Output columns = snapshot columns (+ any update column the
    snapshot lacks); ``_op`` tells insert / update / keep."""
    insert_defaults = insert_defaults or {}
    s = snapshot.select(*[F.col(c).alias(f"s_{c}") for c in snapshot.columns])
    c = changes.select(*[F.col(x).alias(f"c_{x}") for x in changes.columns])
    cond = [s[f"s_{k}"] == c[f"c_{k}"] for k in keys]
    j = s.join(c, cond, "full")
    in_s = s[f"s_{keys[0]}"].isNotNull()
    in_c = c[f"c_{keys[0]}"].isNotNull()
    cols = list(snapshot.columns) + [u for u in update_cols if u not in snapshot.columns]
    out = []
    for col in cols:
        if col in keys:
            out.append(F.coalesce(s[f"s_{col}"], c[f"c_{col}"]).alias(col))
        elif col in update_cols and col in changes.columns:
            snap_v = s[f"s_{col}"] if col in snapshot.columns else F.lit(None)
            out.append(F.when(in_c, c[f"c_{col}"]).otherwise(snap_v).alias(col))
        elif col in snapshot.columns:
            dflt = insert_defaults.get(col, F.lit(None))
            out.append(F.when(in_s, s[f"s_{col}"]).otherwise(dflt).alias(col))
        else:
            out.append(F.lit(None).alias(col))
    op = F.when(in_s & in_c, "update").when(in_c, "insert").otherwise("keep")
    return j.select(*out, op.alias("_op"))


def changed(old: DataFrame, new: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Change feed (SNK-09): keys whose ``col`` differs between two versions (NULL-safe)."""
    o = old.select(*keys, F.col(col).alias("old"))
    n = new.select(*keys, F.col(col).alias("new"))
    return o.join(n, list(keys)).filter(~F.col("old").eqNullSafe(F.col("new")))


def write_snapshot(df: DataFrame, root: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write a snapshot version to ``root/version`` (never the path being read)."""
    path = f"{root.rstrip('/')}/{version}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
