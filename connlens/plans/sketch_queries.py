"""Questions answered from stored day sketches of ``events`` (rows-only checks: estimates are not SQL's exact values)."""

from __future__ import annotations

from pyspark.sql import functions as F

from connlens.operators import sketches as SK
from connlens.plans.registry import register
from connlens.session import materialize
from connlens.sources.tables import table

DISTINCT, NUMERIC = ["event_id", "user_id", "event_type", "props"], ["value"]


def stored(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return materialize(SK.day_sketches(events, F.to_date("ts"), DISTINCT, NUMERIC), "day-sketches")


@register("sketch_nunique")
def q_sketch_nunique(spark, sf_dir):
    return SK.distinct_counts(stored(spark, sf_dir))


@register("sketch_quantiles")
def q_sketch_quantiles(spark, sf_dir):
    return SK.quantiles(stored(spark, sf_dir), [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])


@register("sketch_drift")
def q_sketch_drift(spark, sf_dir):
    """Each day's values against those of the first week, PSI and KS distance."""
    days = stored(spark, sf_dir)
    first = days.agg(F.min("day")).scalar()
    return SK.drift(days, days.where(F.col("day") < F.date_add(first, 7)))
