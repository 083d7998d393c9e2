"""Progress of generation runs from their logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators.ordered import WIDTH, by_width, scan_groups

MICROS = 1_000_000


def runtime_eta(
    log: DataFrame, run: str, pos: str, elapsed: str, ts: str, width: int = WIDTH
) -> DataFrame:
    """Per log row: running mean seconds, rows left in the run and the expected end.

    The end is the row's own time plus mean times rows left, so it is the same on every run.
    Seconds are added up as whole microseconds, which makes the sums independent of order.
    """
    micros = F.round(F.col(elapsed) * MICROS).cast("bigint")
    rows = log.select(run, pos, elapsed, ts).withColumn("_us", micros)
    seen = scan_groups(
        by_width(rows, pos, width), [run], [pos], totals={"_sum": F.col("_us"), "n_done": F.lit(1).cast("bigint")}
    )
    left = F.col("n_done_all") - F.col("n_done")
    # Decimals: microseconds times rows of a long run do not fit a long.
    ahead = F.expr("(cast(_sum as decimal(20, 0)) * cast(n_done_all - n_done as decimal(17, 0))) div n_done")
    return seen.select(
        run, pos, elapsed, "n_done",
        (F.col("_sum") / F.col("n_done") / MICROS).alias("mean_seconds"),
        left.alias("n_left"),
        F.timestamp_add("MICROSECOND", ahead, F.col(ts)).alias("eta"),
    )


def run_time(log: DataFrame, run: str, elapsed: str, ts: str) -> DataFrame:
    """Rows, summed seconds, minutes and time span per run."""
    micros = F.sum(F.round(F.col(elapsed) * MICROS).cast("bigint"))
    return log.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (micros / MICROS).alias("total_seconds"),
        (micros / MICROS / 60).alias("total_minutes"),
        F.min(ts).alias("started"),
        F.max(ts).alias("ended"),
    )
