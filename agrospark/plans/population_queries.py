"""Selection from one population that is a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evolution import u_sql
from ..operators.population import roulette_rows
from ..session import read_table
from .evolution_queries import U
from .registry import register


@register("order_roulette_draws", covers=("G4", "J10", "W4"), sql=f"""
WITH w AS (SELECT o_orderkey AS id, CAST(floor(CAST(o_totalprice AS DOUBLE) * 100) AS BIGINT) AS w FROM orders),
line AS (SELECT id, w, CAST(sum(w) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING) - w AS BIGINT) AS start FROM w),
total AS (SELECT CAST(sum(w) AS BIGINT) AS t FROM w),
draws AS (SELECT c_custkey AS draw, least(CAST(floor(({U('row1', 'c_custkey')} + {U('row2', 'c_custkey')} / 4294967296.0::DOUBLE)
                                                  * CAST(t AS DOUBLE)) AS BIGINT), t - 1) AS at FROM customer, total)
SELECT d.draw, l.id FROM draws d ASOF JOIN (SELECT * FROM line WHERE w > 0) l ON d.at >= l.start""")
def order_roulette_draws(spark, d):
    """One draw a customer from all orders, in proportion to their price in cents."""
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("id"),
                                                   F.floor(F.col("o_totalprice").cast("double") * 100).alias("weight"))
    share = F.expr(f"{u_sql('row1', 'c_custkey')} + {u_sql('row2', 'c_custkey')} / 4294967296.0D")
    return roulette_rows(orders, read_table(spark, d, "customer").select(F.col("c_custkey").alias("draw"), share.alias("share")))
