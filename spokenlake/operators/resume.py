"""Resuming: which finished work can be used again, and why not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokenlake.functions import text as T


def reuse_reason(work: DataFrame, state: DataFrame, key: str, signature: str) -> DataFrame:
    """reason: reuse, or the first thing that stands against it. state: key, status, signature, and, where it has them,
    prompt, response and saved_url, against the work's url."""
    joined = work.join(state, key, "left")
    reason = F.when(F.col("status").isNull(), "new").when(F.col("status") != "success", "not_success")
    for text in ("prompt", "response"):
        if text in state.columns:
            reason = reason.when(F.coalesce(T.non_blank(F.col(text)), F.lit("")) == "", f"blank_{text}")
    if "saved_url" in state.columns:
        reason = reason.when(~F.col("saved_url").eqNullSafe(F.col("url")), "url_changed")
    reason = reason.when(~F.col("signature").eqNullSafe(F.lit(signature)), "signature_changed").otherwise("reuse")
    return joined.select(key, reason.alias("reason"))


def split(work: DataFrame, done: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(finished, open) work."""
    return work.join(done, key, "left_semi"), work.join(done, key, "left_anti")


def latest_state(log: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row of an append-only state log, as a partial aggregate."""
    rest = [c for c in log.columns if c not in (key, at)]
    return log.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("m")).select(key, "m.*")
