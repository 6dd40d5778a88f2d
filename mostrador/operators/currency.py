"""Conversion of native amounts to the base currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import exact, exact_product


def convert_currency(
    sales: DataFrame,
    rates: DataFrame,
    amount: str = "amount_native",
    currency: str = "currency",
    day: str = "sale_date",
    rate_day: str = "rate_date",
    rate: str = "rate_to_mxn",
    base: str = "MXN",
    out: str = "amount_mxn",
) -> DataFrame:
    """Add the amount in the base currency, by the rate of the row's day and currency.

    Base-currency rows pass unchanged; a row without a rate gets NULL. Works on single sales and on
    totals per (currency, day) alike: the rate is constant there, so converting a total equals totalling
    the converted rows. Amounts and rates keep all their digits; a result too large for the type fails the job.
    """
    table = rates.select(
        F.col(rate_day).alias("_rate_day"), F.col(currency).alias("_rate_currency"), F.col(rate).alias("_rate")
    )
    match = (F.col(currency) == F.col("_rate_currency")) & (F.col(day) == F.col("_rate_day"))
    converted = F.when(F.col(currency) == base, exact(F.col(amount))).otherwise(exact_product(F.col(amount), F.col("_rate")))
    return (
        sales.join(table, match, "left")
        .withColumn(out, converted)
        .drop("_rate_day", "_rate_currency", "_rate")
    )
