"""Fixed-width histograms (V1), computed where the data lives.

Same bins as a plotting library's ``hist(bins=n, range=(lo, hi))``: ``n``
equal bins, each closed on the left and open on the right except the last,
which also takes ``hi``. Values outside the range and nulls are not counted.
Empty bins are kept with a count of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column | str, lo: float, hi: float, bins: int) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    counted = (df.select(v.alias("_v"))
               .filter(F.col("_v").between(lo, hi))
               .select(F.least(F.width_bucket(F.col("_v"), F.lit(float(lo)), F.lit(float(hi)),
                                              F.lit(bins)),
                               F.lit(bins)).cast("int").alias("bin"))
               .groupBy("bin").count())
    # The counted side has at most `bins` rows, so broadcasting it is bounded.
    width = (hi - lo) / bins
    all_bins = (df.sparkSession.range(1, bins + 1)
                .select(F.col("id").cast("int").alias("bin")))
    return (all_bins.join(F.broadcast(counted), "bin", "left")
            .select("bin",
                    (F.lit(float(lo)) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
                    (F.lit(float(lo)) + F.col("bin") * F.lit(width)).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))
