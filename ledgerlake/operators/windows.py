"""Window operators W1-W4: trailing-frame mean / sample stddev, guarded
z-score and k-sigma flags.

All four expressions share one window spec, so Catalyst plans a single
Window node (one shuffle + sort by the partition key). Call this on
pre-aggregated series (one row per key and period) -- the partition key of a
monitoring series has few values, so a raw-row window would put a third of
the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_zscores(
    df: DataFrame,
    partition_col: str,
    order_col: str,
    series: dict[str, str],
    preceding: int = 30,
    k: float = 2.0,
    digits: int = 2,
) -> DataFrame:
    """``rolling_zscore`` for several value columns at once ({name: column}).

    All frame aggregates are added in one projection over one window spec, so
    the plan has a single Window operator (one sort of the partition)."""
    w = Window.partitionBy(partition_col).orderBy(order_col).rowsBetween(-preceding, -1)
    stats = {}
    for name, col in series.items():
        x = F.col(col).cast("double")
        stats[f"rolling_avg_{name}"] = F.avg(x).over(w)
        stats[f"rolling_stddev_{name}"] = F.stddev_samp(x).over(w)  # NULL with fewer than two prior rows
    out = df.withColumns(stats)
    flags = {}
    for name, col in series.items():
        x = F.col(col).cast("double")
        m, sd = F.col(f"rolling_avg_{name}"), F.col(f"rolling_stddev_{name}")
        flags[f"{name}_z_score"] = F.when(sd > 0, F.round((x - m) / sd, digits)).otherwise(F.lit(0.0))
        flags[f"is_{name}_anomaly"] = F.coalesce((sd > 0) & (F.abs(x - m) > F.lit(k) * sd), F.lit(False))
    return out.withColumns(flags)


def rolling_zscore(
    df: DataFrame,
    partition_col: str,
    order_col: str,
    value_col: str,
    name: str,
    preceding: int = 30,
    k: float = 2.0,
    digits: int = 2,
) -> DataFrame:
    """Adds rolling_avg_<name>, rolling_stddev_<name>, <name>_z_score,
    is_<name>_anomaly over ROWS BETWEEN ``preceding`` PRECEDING AND 1 PRECEDING
    (the current row excluded; the frame counts rows, not calendar days)."""
    return rolling_zscores(df, partition_col, order_col, {name: value_col}, preceding, k, digits)
