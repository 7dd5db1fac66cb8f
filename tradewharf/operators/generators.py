"""Deterministic table operators behind the domain's data generation: enrichment, weights,
contract calendars, price bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewharf.operators.ordering import row_numbers, top_ranked_per_group

# Fee, tax and margin rates and settlement lag in calendar days per product.
RATES = {
    "EQUITY": {"fee": "0.0015", "sell_tax": "0.001", "lag": 2},
    "DERIVATIVES": {"fee": "0.0002", "margin": "0.15", "lag": 2},
    "OEF": {"fee": "0", "lag": 3},
}
MAINTENANCE_RATIO = "0.15"


def _rate(text: str) -> Column:
    return F.lit(text).cast("decimal(9,6)")


def enrich_trades(df: DataFrame, product: str) -> DataFrame:
    """Amount, fee, tax or margin, and settlement date from quantity and price.

    Equity needs ``side``; derivatives need ``multiplier``; funds carry ``amount`` and
    ``nav_price`` and get ``quantity_unit``. All arithmetic stays DECIMAL.
    """
    r = RATES[product]
    out = df
    if product == "EQUITY":
        out = out.withColumn("amount", (F.col("quantity") * F.col("price")).cast("decimal(20,2)"))
        tax = F.when(F.col("side") == "SELL", F.round(F.col("amount") * _rate(r["sell_tax"]), 2))
        out = out.withColumn("tax_amount", tax.otherwise(F.lit(0)).cast("decimal(18,2)"))
    elif product == "DERIVATIVES":
        amount = F.col("quantity") * F.col("price") * F.col("multiplier")
        out = out.withColumn("amount", amount.cast("decimal(20,2)"))
        margin = F.round(F.col("amount") * _rate(r["margin"]), 2)
        out = out.withColumn("margin_amount", margin.cast("decimal(20,2)"))
    else:
        units = F.round(F.col("amount") / F.col("nav_price"), 4)
        out = out.withColumn("quantity_unit", units.cast("decimal(20,4)"))
    fee = F.round(F.col("amount") * _rate(r["fee"]), 2).cast("decimal(18,2)")
    return out.withColumns(
        {"fee_amount": fee, "settlement_date": F.date_add("trade_date", r["lag"])}
    )


def margin_flags(df: DataFrame, ratio: str = "margin_ratio") -> DataFrame:
    """Call flag for a ratio below the maintenance ratio; a ratio equal to it is fine."""
    floor = F.lit(MAINTENANCE_RATIO).cast("decimal(9,4)")
    return df.withColumns(
        {
            "maintenance_margin_ratio": floor,
            "call_margin_flag": F.when(F.col(ratio) < floor, True).otherwise(False),
        }
    )


def price_bands(df: DataFrame, reference: str = "reference_price") -> DataFrame:
    """Daily ceiling (+7 %) and floor (-7 %) of the reference price."""
    ref = F.col(reference)
    return df.withColumns(
        {
            "ceiling_price": F.round(ref * F.lit("1.07").cast("decimal(5,2)"), 2).cast("decimal(18,2)"),
            "floor_price": F.round(ref * F.lit("0.93").cast("decimal(5,2)"), 2).cast("decimal(18,2)"),
        }
    )


def contract_calendar(bounds: DataFrame, start: str, end: str, prefix: str) -> DataFrame:
    """One contract per month in [start, end): listed three months before, maturing at month
    end."""
    months = bounds.where(F.col(start) < F.col(end)).select(
        F.explode(
            F.sequence(F.trunc(start, "MM"), F.date_add(F.col(end), -1), F.expr("interval 1 month"))
        ).alias("contract_month")
    )
    m = F.col("contract_month")
    return months.select(
        F.concat(F.lit(prefix), F.date_format(m, "yyMM")).alias("contract_code"),
        "contract_month",
        F.add_months(m, -3).alias("listing_date"),
        F.last_day(m).alias("maturity_date"),
    )


def segment_weight(segment: Column, vip: int, priority: int) -> Column:
    return F.when(segment == "VIP", vip).when(segment == "PRIORITY", priority).otherwise(1)


def weight_by_rank(
    df: DataFrame, group: str, key: str, top: int, weight: int, out: str = "weight"
) -> DataFrame:
    """``weight`` for the first ``top`` rows of each group by key, 1 for the rest.

    Only the first ranks are computed (at most ``top`` rows per group leave a task) and
    joined back on the key, so a hot group is never sorted as a whole.
    """
    leaders = top_ranked_per_group(df.select(group, key), [group], [F.col(key).asc()], top)
    marked = df.join(leaders.select(F.col(key).alias("_lead")), F.col(key) == F.col("_lead"), "left")
    return marked.withColumn(
        out, F.when(F.col("_lead").isNotNull(), weight).otherwise(1)
    ).drop("_lead")


def front_month_weights(contracts: DataFrame, month_start: Column) -> DataFrame:
    """Weights 15 and 4 for the two nearest maturities from ``month_start`` on, else 1.

    Two rows decide the result; they are a top-2, read as a scalar subquery.
    """
    active = contracts.where(F.col("maturity_date") >= month_start)
    lead = active.orderBy("maturity_date", "contract_id").limit(2)
    ids = lead.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("maturity_date", "contract_id"))),
            lambda x: x["contract_id"],
        )
    )
    place = F.array_position(ids.scalar(), F.col("contract_id"))
    return active.withColumn("weight", F.when(place == 1, 15).when(place == 2, 4).otherwise(1))


def numbered_accounts(customers: DataFrame, key: str, prefix: str, width: int) -> DataFrame:
    """Account numbers in key order: ``prefix`` plus the zero-padded ordinal."""
    from tradewharf.functions import pad_code

    numbered = row_numbers(customers, key, "account_seq")
    return numbered.withColumn("account_no", pad_code(prefix, F.col("account_seq"), width))


def base_price(securities: DataFrame, sectors: DataFrame) -> DataFrame:
    """Base price of a security inside its sector's price range, by its id."""
    width = F.nullif(F.col("price_max") - F.col("price_min"), F.lit(0))
    return securities.join(sectors, "sector").withColumn(
        "base_price",
        (F.col("price_min") + (F.col("security_id") * 37) % width).cast("decimal(18,2)"),
    )
