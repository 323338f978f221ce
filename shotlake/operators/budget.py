"""Sharing a fixed number of rows among videos, and admitting candidates under it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import reason_priority


def capacities(seed_rows: DataFrame) -> DataFrame:
    n = F.count_if("locator")
    return seed_rows.groupBy("video_id").agg(n.alias("locator_rows"), (F.count("*") - n).alias("extra_capacity"))


def half_of_extras(capacity: DataFrame) -> DataFrame:
    """One row: a target that leaves room for half of all extras."""
    return capacity.agg((F.sum("locator_rows") + F.expr("sum(extra_capacity) div 2")).alias("target"))


def plan(capacity: DataFrame, target: int | DataFrame) -> DataFrame:
    """``capacity`` with target_rows: all locators, and extras by largest remainder (ties: larger video_id first).

    Only two numbers per video take part; the totals are one broadcast row.
    """
    totals = capacity.agg(F.sum("locator_rows").alias("l"), F.sum("extra_capacity").alias("c"))
    totals = totals.crossJoin(target) if isinstance(target, DataFrame) else totals.withColumn("target", F.lit(target))
    totals = totals.select("c", F.least(F.greatest(F.col("target") - F.col("l"), F.lit(0)), F.col("c")).alias("remaining"))
    rows = capacity.crossJoin(F.broadcast(totals))
    exact = F.coalesce(F.try_divide((F.col("remaining") * F.col("extra_capacity")).cast("double"), F.col("c")), F.lit(0.0))
    rows = rows.withColumn("exact", exact).withColumn("base", F.least("extra_capacity", F.floor("exact").cast("bigint")))
    given = rows.agg(F.sum("base").alias("given"))
    order = F.row_number().over(Window.orderBy(F.desc(F.col("exact") - F.col("base")), F.desc("video_id")))
    rows = rows.withColumn("place", order).crossJoin(F.broadcast(given))
    extra = (F.col("place") <= F.col("remaining") - F.col("given")).cast("bigint")
    return rows.select("video_id", "locator_rows", "extra_capacity", (F.col("locator_rows") + F.col("base") + extra).alias("target_rows"))


def plan_failures(planned: DataFrame, target: int) -> DataFrame:
    """Why a plan can't meet its target: at most one row for each reason."""
    t = planned.agg(F.sum("locator_rows").alias("l"), F.sum("extra_capacity").alias("c"), F.sum("target_rows").alias("t"))
    checks = F.array(
        F.when(F.col("l") > target, F.lit("locators exceed the target")),
        F.when(F.col("l") + F.col("c") < target, F.lit("too few extras")),
        F.when(F.col("t") != target, F.lit("assigned rows differ from the target")),
    )
    return t.select(F.explode(F.array_compact(checks)).alias("failure"))


def reconcile(planned: DataFrame, results: DataFrame) -> DataFrame:
    """Plan against results (video_id, candidate_rows, decode_missing): realised rows and failures of each video.

    The first result of a video counts (``results`` may have an order column pos); unknown videos come with their failure.
    """
    once = results.groupBy("video_id").agg(F.min_by("candidate_rows", "pos").alias("candidate_rows"), F.min_by("decode_missing", "pos").alias("decode_missing"), F.count("*").alias("times"))
    rows = planned.withColumn("planned", F.lit(True)).join(once, "video_id", "full")
    actual = F.coalesce("candidate_rows", F.lit(0)).cast("bigint")
    failures = F.array(
        F.when(F.coalesce("video_id", F.lit("")) == "", F.lit("no id")),
        F.when(F.col("times") > 1, F.lit("duplicate")),
        F.when(F.col("planned").isNull(), F.lit("unexpected")),
        F.when(F.col("times").isNull(), F.lit("missing")),
        F.when(F.col("decode_missing") != 0, F.lit("incomplete")),
        F.when(F.col("planned") & (actual < F.col("locator_rows")), F.lit("below locators")),
        F.when(F.col("planned") & (actual > F.col("target_rows")), F.lit("above ceiling")),
    )
    return rows.select(
        "video_id", "locator_rows", F.col("target_rows").alias("requested_rows"), F.when(F.col("planned"), actual).alias("target_rows"),
        F.when(F.col("planned"), F.greatest(F.lit(0), F.col("target_rows") - actual)).alias("underfilled_rows"), F.array_compact(failures).alias("failures"),
    )


def totals(reconciled: DataFrame) -> DataFrame:
    """One row: what all known videos asked for and got, and whether nothing failed."""
    known = F.col("requested_rows").isNotNull()
    of = lambda c: F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0)).cast("bigint")
    out = reconciled.agg(of("locator_rows").alias("locator_rows"), of("requested_rows").alias("requested_assigned_rows"), of("target_rows").alias("assigned_rows"), F.coalesce(F.sum(F.size("failures")), F.lit(0)).alias("failures"))
    out = out.withColumns({"source_extra_rows": F.col("assigned_rows") - F.col("locator_rows"), "underfilled_rows": F.col("requested_assigned_rows") - F.col("assigned_rows")})
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def finalised(planned: DataFrame, results: DataFrame) -> DataFrame:
    """The plan with realised rows in place of the asked ones; videos that failed or aren't in the plan are left out."""
    rows = reconcile(planned, results).filter((F.size("failures") == 0) & F.col("requested_rows").isNotNull())
    return rows.join(planned.select("video_id", "extra_capacity"), "video_id").select("video_id", "locator_rows", "extra_capacity", "requested_rows", "target_rows", "underfilled_rows")


def longest_first(planned: DataFrame) -> DataFrame:
    """Videos in the order in which their work begins: the most rows first, so that no long one is left at the end.

    One number a video takes part.
    """
    order = Window.orderBy(F.desc("target_rows"), "video_id")
    return planned.select("video_id", "target_rows", F.row_number().over(order).cast("bigint").alias("place"))


def admission_order() -> list[Column]:
    return [F.desc("hard_keep"), F.desc(reason_priority(F.col("reasons"))), F.desc(F.coalesce("quality_score", F.lit(0.0))), F.asc("frame_idx")]


def admitted(rows: DataFrame, planned: DataFrame | None) -> DataFrame:
    """All locators and the best extras that were not rejected, up to each video's target; without a plan all rows.

    A video with more locators than target rows keeps its locators (the plan reports it).
    """
    if planned is None:
        return rows
    extra = ~F.col("locator") & F.col("rejected").isNull()
    place = F.row_number().over(Window.partitionBy("video_id", extra).orderBy(*admission_order()))
    ranked = rows.withColumn("place", place).withColumn("extra", extra).join(planned.select("video_id", (F.col("target_rows") - F.col("locator_rows")).alias("room")), "video_id")
    return ranked.filter("locator or (extra and place <= room)").drop("place", "extra", "room")
