"""Token cost by model and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Model, threshold in thousands of input tokens, USD per million tokens in and out up to it, in and out beyond it.
PRICES = (
    ("gemini-2.5-pro-preview-05-06", 200, 1.25, 10.00, 2.50, 15.00),
    ("gemini-2.5-pro-preview-03-25", 200, 1.25, 10.00, 2.50, 15.00),
    ("gemini-1.5-pro-latest", 128, 1.25, 5.00, 2.50, 10.00),
    ("gemini-1.5-flash-latest", 128, 0.075, 0.30, 0.15, 0.60),
    ("gemini-1.5-flash-8b-latest", 128, 0.0375, 0.15, 0.075, 0.30),
    ("gemini-2.0-flash-latest", None, 0.10, 0.40, None, None),
    ("gemini-2.0-flash-lite-latest", None, 0.075, 0.30, None, None),
    ("gemini-2.5-flash-preview-05-07", None, 0.15, 0.60, None, None),
)
PRICE_SCHEMA = "price_model string, threshold_k int, lo_in double, lo_out double, hi_in double, hi_out double"


def price_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRICES, PRICE_SCHEMA)


def base_model(model: Column) -> Column:
    """The listed model that an unlisted name falls back to; null if there is none."""
    pro = F.when(model.contains("2.5"), "gemini-2.5-pro-preview-05-06").otherwise("gemini-1.5-pro-latest")
    flash = F.when(model.contains("2.0"), "gemini-2.0-flash-latest").otherwise("gemini-1.5-flash-latest")
    return F.when(model.contains("-pro"), pro).when(model.contains("-flash"), flash)


def priced_model(model: Column) -> Column:
    return F.when(model.isin(*[p[0] for p in PRICES]), model).otherwise(base_model(model))


def with_cost(usage: DataFrame, model: str = "model", tokens_in: str = "input_tokens", tokens_out: str = "output_tokens", name: str = "cost_usd") -> DataFrame:
    """``usage`` with its cost in USD: 0 for an unknown model or a missing count. The price list has a fixed number of rows."""
    prices = F.broadcast(price_list(usage.sparkSession))
    joined = usage.join(prices, priced_model(F.col(model)) == F.col("price_model"), "left")
    high = F.col("threshold_k").isNotNull() & (F.col(tokens_in) > F.col("threshold_k") * 1000)
    cost = F.col(tokens_in) / 1e6 * F.when(high, F.col("hi_in")).otherwise(F.col("lo_in")) + F.col(tokens_out) / 1e6 * F.when(high, F.col("hi_out")).otherwise(F.col("lo_out"))
    return joined.withColumn(name, F.coalesce(cost, F.lit(0.0))).drop("price_model", "threshold_k", "lo_in", "lo_out", "hi_in", "hi_out")


def cost_stats(costs: DataFrame, column: str = "cost_usd") -> DataFrame:
    """Total, mean, population deviation, least, most and number of the numeric costs."""
    c = F.col(column)
    return costs.filter(c.isNotNull()).agg(
        F.count(c).alias("n"),
        F.sum(c).alias("total"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("std"),
        F.min(c).alias("least"),
        F.max(c).alias("most"),
    )


def document_cost(document: Column) -> Column:
    """The cost in a batch document: at its top level, or among its processing statistics."""
    paths = ("$.estimated_cost_usd", "$.processing_stats.estimated_cost_usd")
    return F.coalesce(*[F.get_json_object(document, p).try_cast("double") for p in paths])
