"""Delay gate on a table: records wait until a delay has passed since first sight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delay_gate(df: DataFrame, stamp_col: str, as_of_ms: int, delay_ms: int, route_col: str = "route") -> DataFrame:
    """First sight (null stamp): stamp = ``as_of_ms``, route ``delay``. A
    stamped record is ``ready`` when ``as_of - stamp > delay`` (strict), else
    ``delay``. Existing stamps are kept."""
    stamp = F.col(stamp_col)
    now = F.lit(int(as_of_ms))
    route = (F.when(stamp.isNull(), F.lit("delay"))
             .when(now - stamp > F.lit(int(delay_ms)), F.lit("ready"))
             .otherwise(F.lit("delay")))
    return df.withColumn(route_col, route).withColumn(stamp_col, F.coalesce(stamp, now))
