"""RFM scoring: recency, frequency and monetary value per customer, each cut
into quintiles.

``NTILE`` over all customers is a global ordering; a plain window would pull
every customer into one task. The scores instead compare each customer with the
four cut rows of each ranking, which counting finds exactly (``operators.selection``):
no customer is sorted, numbered or joined for its scores.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.selection import Ranking, with_tiles
from martlet.plans.explore import money
from martlet.session import stage_table

BUCKETS = 5
RANKINGS = [
    Ranking("recency_days", "r_score", descending=True),
    Ranking("frequency", "f_score"),
    Ranking("_monetary", "m_score"),
]


def customer_rfm_base(fact: DataFrame, as_of: dt.date, customers: DataFrame | None = None) -> DataFrame:
    """Per customer: days since the last order, distinct orders, spend. If the
    fact carries raw customer ids, pass the valid ``customers`` keys: the
    per-customer rows are semi-joined to them after the aggregation."""
    per = (
        fact.where(F.col("order_date").isNotNull() & F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.datediff(F.lit(as_of), F.max("order_date")).cast("long").alias("recency_days"),
            F.countDistinct("order_number").alias("frequency"),
            F.sum("sales_amount").alias("_monetary"),
        )
    )
    if customers is not None:
        per = per.join(customers.select("customer_key"), "customer_key", "left_semi")
    return per


def rfm_scores(fact: DataFrame, as_of: dt.date, customers: DataFrame | None = None) -> DataFrame:
    """Scores 1..5 where 5 is best: most recent, most frequent, highest spend.
    Ties are ordered by customer key so every score is deterministic. The
    per-customer metrics are staged once; the passes of the selection read that."""
    base = stage_table(customer_rfm_base(fact, as_of, customers), "rfm-base")
    scored = with_tiles(base, "customer_key", RANKINGS, BUCKETS)
    return scored.select(
        "customer_key",
        "recency_days",
        "frequency",
        money("_monetary").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"), F.col("m_score").cast("string")).alias(
            "rfm_cell"
        ),
    )
