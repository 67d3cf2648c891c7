"""Headways: the time between consecutive reports on a route and direction.

One route and direction can hold a third of all rows, and a plain ``lag`` over
it would sort them in one task. So the work is cut twice. Reports that share a
timestamp collapse to one tick with a count while they are still on the map
side: n reports at one instant are n-1 headways of zero. Then ``lag`` runs per
short time slot, whose tick count is limited by the clock and not by the rows,
and the first tick of a slot takes the last tick of the slot before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, recent
from tramline.functions.measures import row_count

LINE = ["route_id", "direction_id"]
SLOT_SECONDS = 900


def _seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 1_000_000.0


def ticks(positions: DataFrame) -> DataFrame:
    """Distinct report times per line, with the number of reports at each."""
    return positions.groupBy(*LINE, "timestamp").agg(row_count().alias("reports"))


def slot_gaps(positions: DataFrame, bunch_s: float, gap_s: float, slot_seconds: int) -> DataFrame:
    """Headway moments per line and time slot, stitched to the slot before."""
    in_slot = Window.partitionBy(*LINE, "slot").orderBy("timestamp")
    along = Window.partitionBy(*LINE).orderBy("slot")
    head = F.col("headway")
    edge = _seconds(F.col("first_tick"), F.lag("last_tick").over(along))
    return (
        ticks(positions)
        .withColumn("slot", F.floor(F.unix_seconds("timestamp") / slot_seconds))
        .withColumn("headway", _seconds(F.col("timestamp"), F.lag("timestamp").over(in_slot)))
        .groupBy(*LINE, "slot")
        .agg(
            F.min("timestamp").alias("first_tick"),
            F.max("timestamp").alias("last_tick"),
            F.count(head).alias("moves"),
            F.sum(F.col("reports") - 1).alias("repeats"),
            F.sum(head).alias("total"),
            F.sum(head * head).alias("squares"),
            F.min(head).alias("least"),
            F.max(head).alias("most"),
            F.count_if(head < bunch_s).alias("bunched"),
            F.count_if(head > gap_s).alias("gaps"))
        .withColumn("edge", edge)
        .withColumn("is_edge", F.col("edge").isNotNull().cast("bigint")))


def headway_moments(
    positions: DataFrame,
    bunch_s: float = 180,
    gap_s: float = 900,
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Per line: headway count, mean, variance, extremes, bunching and gap counts, in seconds."""
    edge = F.col("edge")
    repeats = F.sum("repeats")
    n = F.sum("moves") + F.sum("is_edge") + repeats
    total = F.coalesce(F.sum("total"), F.lit(0.0)) + F.coalesce(F.sum(edge), F.lit(0.0))
    squares = F.coalesce(F.sum("squares"), F.lit(0.0)) + F.coalesce(F.sum(edge * edge), F.lit(0.0))
    centred = F.greatest(squares - total * total / n, F.lit(0.0))
    bunched_repeats = repeats if bunch_s > 0 else F.lit(0)
    return (
        slot_gaps(positions, bunch_s, gap_s, slot_seconds)
        .groupBy(*LINE)
        .agg(
            n.alias("total_headways"),
            F.when(n > 0, total / n).alias("mean_s"),
            F.when(n > 1, centred / (n - 1)).alias("variance_s"),
            F.least(F.min("least"), F.min(edge), F.when(repeats > 0, 0.0)).alias("min_s"),
            F.greatest(F.max("most"), F.max(edge), F.when(repeats > 0, 0.0)).alias("max_s"),
            (F.sum("bunched") + F.count_if(edge < bunch_s) + bunched_repeats).alias("bunching_incidents"),
            (F.sum("gaps") + F.count_if(edge > gap_s)).alias("gap_incidents"))
        .where("total_headways > 0"))


def headways_of(
    positions: DataFrame, route_id: str, direction_id: int | None = None, as_of: AsOf = None, hours: float | None = None,
    bunch_s: float = 180, gap_s: float = 900,
) -> DataFrame:
    """headway_moments() of one route within the window: per direction, or of one direction if it is given."""
    line = recent(positions, as_of, hours).where(F.col("route_id") == route_id)
    if direction_id is not None:
        line = line.where(F.col("direction_id") == direction_id)
    return headway_moments(line, bunch_s, gap_s)
