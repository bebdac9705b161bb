"""Ledger jobs: lot and item profit and loss, sell-through.

Input: a long-form transaction ledger with columns for the key (lot or item),
the transaction type, the amount, the transaction id and the item type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import money
from strata.operators.cleaning import fill_zero, sentinel_to_null
from strata.operators.reshape import pivot_fixed

# Transaction types and their output column names: fixed values.
LEDGER_TYPES = ["revenue", "purchase", "fee", "shipseller", "shipbuyer"]
LEDGER_COLUMNS = ["Revenue", "Purchases", "Fees", "ShipSeller", "ShipBuyer"]
EXPENSE_COLUMNS = ["Purchases", "Fees", "ShipSeller", "ShipBuyer"]


@dataclass(frozen=True)
class LedgerCols:
    lot: str = "lot_name"
    item: str = "item_name"
    item_type: str = "item_type"
    txn_type: str = "txn_type"
    amount: str = "amount"
    txn_id: str = "txn_id"


def clean_ledger(txns: DataFrame, cols: LedgerCols = LedgerCols(), sentinel: str = "NULL") -> DataFrame:
    """Round amounts to cents (exact decimal), turn the 'NULL' lot text into a
    real NULL, and lower-case the transaction and item types so 'Revenue' and
    'revenue', 'Doll' and 'doll' agree."""
    out = sentinel_to_null(txns, cols.lot, sentinel)
    return out.withColumns({
        cols.amount: money(cols.amount),
        cols.txn_type: F.lower(F.col(cols.txn_type)),
        **({cols.item_type: F.lower(F.col(cols.item_type))} if cols.item_type in txns.columns else {}),
    })


def pnl(clean: DataFrame, key: str, cols: LedgerCols = LedgerCols(), key_name: str | None = None) -> DataFrame:
    """Profit and loss per ``key``: pivot the five types, zero-fill all five,
    profit = revenue - the four costs (rounded to cents), all expenses = the four
    costs.  Amounts stay exact decimals until the end, then become doubles."""
    wide = pivot_fixed(clean, [key], cols.txn_type, LEDGER_TYPES, F.col(cols.amount), LEDGER_COLUMNS)
    wide = fill_zero(wide, LEDGER_COLUMNS)
    profit = F.col("Revenue")
    for c in EXPENSE_COLUMNS:
        profit = profit - F.col(c)
    expenses = F.col(EXPENSE_COLUMNS[0])
    for c in EXPENSE_COLUMNS[1:]:
        expenses = expenses + F.col(c)
    out = wide.select(
        F.col(key).alias(key_name or key),
        *[F.col(c).cast("double").alias(c) for c in LEDGER_COLUMNS],
        F.round(profit, 2).cast("double").alias("Profit"),
        expenses.cast("double").alias("AllExpenses"),
    )
    return out


def lot_pnl(txns: DataFrame, cols: LedgerCols = LedgerCols()) -> DataFrame:
    return pnl(clean_ledger(txns, cols), cols.lot, cols, key_name="LotName")


def item_pnl(txns: DataFrame, cols: LedgerCols = LedgerCols()) -> DataFrame:
    """Item ranking by profit, highest first (all five types zero-filled)."""
    return (pnl(clean_ledger(txns, cols), cols.item, cols, key_name="ItemName")
            .orderBy(F.desc("Profit"), F.asc("ItemName")))


def total_profit(pnl_df: DataFrame) -> DataFrame:
    """``SELECT SUM(Profit) AS TOTAL``: summed as cents so the result is exact."""
    return pnl_df.agg(F.sum(F.col("Profit").cast("decimal(18,2)")).cast("double").alias("TOTAL"))


def unlisted_types(txns: DataFrame, cols: LedgerCols = LedgerCols()) -> DataFrame:
    """Transactions whose type the fixed pivot list drops, counted per type."""
    t = F.lower(F.col(cols.txn_type))
    return (txns.filter(~t.isin(LEDGER_TYPES) | t.isNull())
                .groupBy(t.alias("txn_type")).agg(F.count(F.lit(1)).alias("n")))


def sell_through(txns: DataFrame, cols: LedgerCols = LedgerCols(), item_type: str = "doll",
                 keep_unsold: bool = False) -> DataFrame:
    """Items purchased and sold per lot, for one item type.  Both counts come
    from one pass (conditional counts), then lots with no sale are dropped, as
    the reference's inner join of the two count views does (H29);
    ``keep_unsold=True`` keeps lots that bought but sold nothing (0 sold)."""
    clean = clean_ledger(txns, cols)
    t = F.col(cols.txn_type)
    counts = (clean.filter(F.col(cols.item_type) == item_type.lower())
                   .filter(t.isin("purchase", "revenue"))
                   .groupBy(cols.lot)
                   .agg(F.count(F.when(t == "purchase", F.col(cols.txn_id))).alias("ItemsPurchased"),
                        F.count(F.when(t == "revenue", F.col(cols.txn_id))).alias("ItemsSold"),
                        F.count_if(t == "purchase").alias("__p"),
                        F.count_if(t == "revenue").alias("__s")))
    # Inner join semantics: a lot needs at least one purchase row and one sale
    # row; the join key itself must be non-NULL.
    present = (F.col("__p") > 0) if keep_unsold else ((F.col("__p") > 0) & (F.col("__s") > 0))
    return (counts.filter(present & F.col(cols.lot).isNotNull())
                  .select(F.col(cols.lot).alias("LotName"), "ItemsPurchased", "ItemsSold"))


def oversold(sell: DataFrame) -> DataFrame:
    """Lots that sold more items than they bought (the reference's anomaly)."""
    return sell.filter(F.col("ItemsSold") > F.col("ItemsPurchased"))
