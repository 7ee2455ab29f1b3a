"""Transaction totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import predicates as Q
from ..functions import properties as P
from . import updates as U

# Property and field names of transaction lists.
TRANSACTIONS, AMOUNT, REVENUE = "$transactions", "$amount", "Revenue"


def transaction_total(m: Column | str = "properties", strict: bool = True) -> Column:
    """Sum of ``$amount`` over the transaction list; no list gives 0.

    As specified, the sum stops at the first transaction without ``$amount``
    (or with one that is not a number) and keeps what it has. ``strict=False``
    skips such transactions instead.
    """
    # Cast from a variant, one odd element is NULL; from_json would drop the list.
    listed = F.try_parse_json(P.prop(m, TRANSACTIONS))
    items = F.try_variant_get(listed, "$", f"array<struct<`{AMOUNT}`: double>>")
    amounts = F.transform(items, lambda t: t[AMOUNT])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))

    def until_missing(values: Column) -> Column:
        cut = F.array_position(F.transform(values, F.isnull), True)
        return F.when(cut == 0, values).otherwise(
            F.slice(values, F.lit(1), (cut - 1).cast("int"))
        )

    summed = total(P.bind(amounts, until_missing)) if strict else total(amounts)
    return F.coalesce(summed, F.lit(0.0))


def revenue_from_lists(profiles: DataFrame, targets=None, strict: bool = True) -> DataFrame:
    """Set ``Revenue`` from each profile's own transaction list."""
    hit = Q.defined("properties", TRANSACTIONS) if targets is None else targets
    value = F.create_map(
        F.lit(REVENUE), P.bind(transaction_total("properties", strict), lambda t: P.json_text(t, "double"))
    )
    return U.set_properties(profiles, value, hit)


def revenue_totals(transactions: DataFrame) -> DataFrame:
    """Total per user over a transactions table (``distinct_id, amount``)."""
    return transactions.groupBy("distinct_id").agg(
        F.coalesce(F.sum("amount"), F.lit(0)).alias("revenue")
    )


def revenue_from_table(profiles: DataFrame, transactions: DataFrame) -> DataFrame:
    """Set ``Revenue`` on every profile from a transactions table; none gives 0."""
    totals = revenue_totals(transactions)
    joined = profiles.join(totals, "distinct_id", "left")
    kind = totals.schema["revenue"].dataType
    value = P.json_text(F.coalesce(F.col("revenue"), F.lit(0)).cast(kind), kind)
    return joined.withColumn(
        "properties", P.overlay("properties", F.create_map(F.lit(REVENUE), value))
    ).select(*profiles.columns)
