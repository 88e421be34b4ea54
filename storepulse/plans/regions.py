"""Sales per region with colour bands for the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.plans.metrics import CENTS

# The map's scale, bands of 100 from 0 to 600.
BAND_LOW, BAND_HIGH, BANDS = 0.0, 600.0, 6


def region_sales(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                 unit: float = 1.0) -> DataFrame:
    """`region`, `amount`, `band` per nation; `band` is 0 below the scale and 7 above it.

    `unit` is the amount that counts as one step of the scale. Orders are summed
    per customer before they meet the customers, so a customer with very many
    orders sends one row per task.
    """
    per_customer = (orders.groupBy("o_custkey")
                    .agg(F.sum(F.col("o_totalprice").cast(CENTS)).alias("amount")))
    per_nation = (per_customer
                  .join(customer.select("c_custkey", "c_nationkey"),
                        F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey").agg(F.sum("amount").alias("amount")))
    amount = F.col("amount").cast("double")
    return (per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("region"), amount.alias("amount"),
                    F.width_bucket(amount / unit, F.lit(BAND_LOW), F.lit(BAND_HIGH), F.lit(BANDS))
                    .alias("band")))
