"""Integer statistics over a small result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"


def floor_statistics(df: DataFrame, value: str) -> DataFrame:
    """Rows ``(statistic, value)`` for Mean, Sum, Min, Max and Var; none for an empty input.

    The mean is rounded down, and the variance is the population variance around that rounded mean, itself rounded
    down. One pass suffices: sum((x - m)^2) = sum(x^2) - 2 m sum(x) + n m^2. Wide decimals keep squares of large
    counts exact.
    """
    x = F.col(value).cast("decimal(19,0)")
    sums = df.agg(
        F.count(value).cast("decimal(20,0)").alias("n"),
        F.sum(x).cast(WHOLE).alias("total"),
        F.min(x).alias("least"),
        F.max(x).alias("most"),
        F.sum((x * x).cast("decimal(38,0)")).alias("squares"),
    ).filter("n > 0")
    # The quotients below are taken as remainders off the dividend, which stays exact where division would round.
    mean = sums.withColumn("mean", ((F.col("total") - F.pmod("total", "n")) / F.col("n")).cast("decimal(19,0)"))
    off = mean.withColumn(
        "spread",
        (
            F.col("squares") - (2 * F.col("mean") * F.col("total")).cast(WHOLE)
            + (F.col("n") * (F.col("mean") * F.col("mean")).cast(WHOLE)).cast(WHOLE)
        ).cast(WHOLE),
    )
    var = ((F.col("spread") - F.pmod("spread", "n")) / F.col("n")).cast(WHOLE)
    return off.select(
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("statistic"), c.cast(WHOLE).alias("value"))
                    for name, c in [
                        ("Mean", F.col("mean")),
                        ("Sum", F.col("total")),
                        ("Min", F.col("least")),
                        ("Max", F.col("most")),
                        ("Var", var),
                    ]
                )
            )
        ).alias("s")
    ).select("s.statistic", "s.value")
