"""Travel-time impedance: w = exp(alpha * t ** beta)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (mode, purpose, alpha, beta).
IMPEDANCE = [
    ("Drive", "Work", -0.007127, 1.501453),
    ("Drive", "Non-work", -0.020097, 1.361630),
    ("Walk", "Work", -0.053588, 1.085346),
    ("Walk", "Non-work", -0.058269, 1.007449),
    ("Bike", "Work", -0.007653, 1.591415),
    ("Bike", "Non-work", -0.028080, 1.145222),
]


def impedance_table(spark: SparkSession, params=None) -> DataFrame:
    return spark.createDataFrame(params or IMPEDANCE, "mode string, purpose string, alpha double, beta double")


def weight(t: Column, alpha: Column, beta: Column) -> Column:
    return F.exp(alpha * F.pow(t, beta))


def with_weights(od: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Add ``w_work`` and ``w_non``; both are NULL for modes without parameters (see ``modes_without_weights``).

    The parameter side has one row per mode (an enumeration of four modes at most), so it is broadcast.
    """
    params = impedance_table(od.sparkSession) if params is None else params
    by_mode = params.groupBy("mode").agg(
        *[
            F.expr(f"max(if(purpose = '{p}', {c}, null)) as _{c}_{tag}")
            for p, tag in (("Work", "work"), ("Non-work", "non"))
            for c in ("alpha", "beta")
        ]
    )
    return od.join(F.broadcast(by_mode), "mode", "left").selectExpr(
        *od.columns, *[f"exp(_alpha_{tag} * pow(time_min, _beta_{tag})) as w_{tag}" for tag in ("work", "non")]
    )


def modes_without_weights(od: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Modes of the travel times that have no parameters, with their pairs: only unweighted measures exist for them."""
    params = impedance_table(od.sparkSession) if params is None else params
    counts = od.groupBy("mode").agg(F.count("*").alias("pairs"))
    return counts.join(F.broadcast(params.select("mode").distinct()), "mode", "left_anti")
