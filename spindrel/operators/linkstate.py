"""The link-state table: monotone merge of verdicts, worklists, confirmation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import host_of

FIELDS = ["status", "reason", "http", "final_url"]


def merge(observations: DataFrame, key: str, at: str, extra: list[str]) -> DataFrame:
    """The state after all observations (key, status, at, extra): the latest settled one
    (yes or no), or the latest if none is settled. Associative and idempotent: the state
    may be merged with new observations again and again, in any order."""
    settled = F.col("status").isin("yes", "no").cast("int")
    row = F.max_by(F.struct("status", at, *extra), F.struct(settled, F.col(at), *map(F.col, extra)))
    return observations.groupBy(key).agg(row.alias("_r")).select(key, "_r.*")


def stale(state: DataFrame, manual: DataFrame, urls: DataFrame, key: str, at: str, now: Column, *, max_age: int | None = None, statuses: tuple[str, ...] = ()) -> DataFrame:
    """Keys of `urls` to check: never those judged by hand; those without state; by status
    if `statuses` is given, else maybe, and settled ones of max_age days or more."""
    todo = urls.select(key).distinct().join(manual.select(key).distinct(), key, "left_anti").join(state.select(key, "status", at), key, "left")
    fresh = F.col("status").isNull()
    if statuses:
        due = fresh | F.col("status").isin(*statuses)
    else:
        due = fresh | (F.col("status") == "maybe")
        if max_age is not None:
            days = F.timestamp_diff("DAY", F.try_to_timestamp(F.col(at).cast("string")), now)
            due = due | F.coalesce(days >= max_age, F.lit(True))
    return todo.where(due).select(key)


def worklist(due: DataFrame, key: str, *, only: str | None = None, exclude: str | None = None, limit: int | None = None) -> DataFrame:
    """Keys to check with their host, by host; hosts that hold `only` and do not hold
    `exclude`; the first `limit` of them, which is how a run is kept short."""
    out = due.select(key, F.coalesce(host_of(F.col(key)), F.lit("")).alias("host"))
    if only is not None:
        out = out.where(F.col("host").contains(only.lower()))
    if exclude is not None:
        out = out.where(~F.col("host").contains(exclude.lower()))
    out = out.orderBy("host", key)
    return out if limit is None else out.limit(limit)


def confirmed(observations: DataFrame, key: str, order: list[str], reason: str) -> DataFrame:
    """First observation per key, where `no` needs the next one to agree; otherwise that one
    stands, with a remark."""
    w = Window.partitionBy(key).orderBy(*order)
    df = observations.withColumn("_n", F.row_number().over(w)).withColumn("_s", F.lead("status").over(w)).withColumn("_r", F.lead(reason).over(w)).where("_n = 1")
    turn = (F.col("status") == "no") & F.col("_s").isNotNull()
    again = F.when(F.col("_s") == "no", F.col("_r")).otherwise(F.concat(F.col("_r"), F.lit(" (first attempt looked dead)")))
    return df.select(key, F.when(turn, F.col("_s")).otherwise(F.col("status")).alias("status"), F.when(turn, again).otherwise(F.col(reason)).alias(reason))


def affiliate_verdict(product: Column, short: Column, live: Column, dead: Column) -> Column:
    """By the product link's status, whether it is a shortened code itself, and the counts of
    live and dead affiliate codes beside it; null where there is nothing to report."""
    return (
        F.when((dead > 0) & ~short & (product == "yes"), "affiliate dead, product link fine")
        .when((dead > 0) & ~short & (product == "no"), "both dead")
        .when((dead > 0) & ~short, "affiliate dead, product link unresolved")
        .when(short & (product == "no"), "only link is a dead affiliate code")
    )


def link_note(reason: Column, product: Column, short: Column, dead: Column) -> Column:
    """Remark on a source, most telling first; `dead`: an affiliate code of it is dead."""
    reason = F.coalesce(reason, F.lit(""))
    return (
        F.when(reason.contains("obsolete"), "distributor still lists the page but the part is obsolete or discontinued")
        .when(reason.contains("currently unavailable"), "listing is still up but has no buy button - currently unavailable")
        .when(dead & ~short & (product == "yes"), "affiliate code is dead but the product link still works - drop or regenerate the code")
        .when(dead & ~short & (product == "no"), "affiliate code and product link are both dead")
        .when(short & (product == "no"), "the only link is a dead affiliate code, so the product it pointed at cannot be recovered")
    )
