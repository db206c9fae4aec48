"""Product affinity: how often two products are bought in one order.

For products A != B, the count is the number of (line of A, line of B)
pairs inside the same order, summed over orders; (A, B) and (B, A) have the
same count.

Plan:

1. Order lines are dealt out by order, so many to a task (``session.dealt``), and
   reduced there to one row per (order, product) with its line count; this
   streams, so the repeated lines of a hot order take no memory.
2. Orders with more than ``block_size`` distinct products ("hot" orders), and the
   numbers of order products and of pairs, are found on those rows, with no
   further shuffle.  The products of hot orders are split into ``ceil(products /
   block_size)`` blocks by a hash of the product id, and the pairs of a hot
   order are formed per *block pair*: each row is replicated once per block
   on the other side and the self-join key is (order, block of A, block of
   B).  No task ever forms the pairs of a whole hot order.  Ordinary orders
   use a plain self-join on the order (one shared exchange for both sides).
3. Each unordered pair is formed once (A < B); the per-pair products of
   line counts are summed - after a partial aggregate where the products are so
   few that their pairs fit a task, else dealt out by pair, for a partial
   aggregate would hold nearly every pair of its task - and the mirror image
   (B, A) is produced after the aggregation - for a top n, after the n best
   unordered pairs are known, among which the n best ordered ones must be.

The pairs themselves are the answer's support: an order with d distinct
products contributes d(d-1)/2 distinct pairs, which are spread over
block pairs but cannot be avoided by an exact method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.session import dealt

BLOCK_SIZE = 1024
HOT_LIST_BROADCAST_BYTES = 64 * 1024 * 1024
#: Pairs of products that a partial aggregate may hold.
FEW_PAIRS = 500_000


def _hot_orders(per_order: DataFrame, order: str, block_size: int) -> DataFrame:
    """Orders with more than ``block_size`` products, and their block count."""
    return (per_order.groupBy(order).agg(F.count(F.lit(1)).alias("products"))
            .filter(F.col("products") > block_size)
            .select(order, F.ceil(F.col("products") / F.lit(block_size)).cast("int").alias("blocks")))


def _pair_counts(per_order: DataFrame, order: str, block_size: int) -> tuple[int, int, int]:
    """Numbers of hot orders, of pairs and (nearly) of products."""
    d = F.col("products")
    sizes = per_order.groupBy(order).agg(F.count(F.lit(1)).alias("products"))
    got = sizes.agg(F.count(F.when(d > block_size, 1)).alias("hot"),
                    F.sum((d * (d - 1)).cast("decimal(38,0)")).alias("pairs")).first()
    products = per_order.agg(F.approx_count_distinct("_p").alias("n")).first()["n"]
    return got["hot"], int(got["pairs"] or 0) // 2, products


def _plain_pairs(rows: DataFrame, order: str) -> DataFrame:
    a = rows.select(F.col(order).alias("_oa"), F.col("_p").alias("Product_A"),
                    F.col("n").alias("n_a"))
    b = rows.select(F.col(order).alias("_ob"), F.col("_p").alias("Product_B"),
                    F.col("n").alias("n_b"))
    return a.join(b, (F.col("_oa") == F.col("_ob"))
                  & (F.col("Product_A") < F.col("Product_B")), "inner") \
        .select("Product_A", "n_a", "Product_B", "n_b")


def _block_pairs(rows: DataFrame, order: str) -> DataFrame:
    """Pairs of hot orders, formed per (order, block of A, block of B)."""
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("_p"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = blocked.select(F.col(order).alias("_oa"), F.col("_p").alias("Product_A"),
                       F.col("n").alias("n_a"), F.col("block").alias("_ba"), other.alias("_bb"))
    b = blocked.select(F.col(order).alias("_ob"), F.col("_p").alias("Product_B"),
                       F.col("n").alias("n_b"), other.alias("_ba2"), F.col("block").alias("_bb2"))
    return a.join(b, (F.col("_oa") == F.col("_ob")) & (F.col("_ba") == F.col("_ba2"))
                  & (F.col("_bb") == F.col("_bb2"))
                  & (F.col("Product_A") < F.col("Product_B")), "inner") \
        .select("Product_A", "n_a", "Product_B", "n_b")


def co_purchase_counts(lines: DataFrame, order: str = "Order_ID", product: str = "Product_ID",
                       block_size: int = BLOCK_SIZE) -> DataFrame:
    """(Product_A, Product_B, Times_Bought_Together) for every ordered pair
    of different products that share an order."""
    return _mirrored(unordered_counts(lines, order, product, block_size))


def top_pairs(lines: DataFrame, n: int, order: str = "Order_ID", product: str = "Product_ID",
              block_size: int = BLOCK_SIZE, rows: int | None = None) -> DataFrame:
    """The ``n`` ordered pairs bought together most often, then by id.  ``rows`` is the
    number of lines, counted if not given."""
    best = unordered_counts(lines, order, product, block_size, rows).orderBy(
        F.col("cnt").desc(), "Product_A", "Product_B").limit(n)
    return _mirrored(best).orderBy(F.col("Times_Bought_Together").desc(), "Product_A", "Product_B").limit(n)


def _mirrored(counted: DataFrame) -> DataFrame:
    both = counted.select(
        F.explode(F.array(
            F.struct(F.col("Product_A").alias("a"), F.col("Product_B").alias("b")),
            F.struct(F.col("Product_B").alias("a"), F.col("Product_A").alias("b")),
        )).alias("p"), "cnt")
    return both.select(F.col("p.a").alias("Product_A"), F.col("p.b").alias("Product_B"),
                       F.col("cnt").cast("bigint").alias("Times_Bought_Together"))


def unordered_counts(lines: DataFrame, order: str = "Order_ID", product: str = "Product_ID",
                     block_size: int = BLOCK_SIZE, rows: int | None = None) -> DataFrame:
    """(Product_A, Product_B, cnt) with A < B, for products that share an order."""
    rows = lines.count() if rows is None else rows
    lines = lines.filter(F.col(order).isNotNull() & F.col(product).isNotNull())
    per_order = (dealt(lines.select(order, F.col(product).alias("_p")), rows, order)
                 .groupBy(order, "_p").agg(F.count(F.lit(1)).alias("n")))
    hot_rows, n_pairs, products = _pair_counts(per_order, order, block_size)
    if hot_rows == 0:
        pairs = _plain_pairs(per_order, order)
    else:
        # The hot list has at most (lines / block_size) entries; it is
        # broadcast only when its counted size is under the bound.
        hot = _hot_orders(per_order, order, block_size)
        if hot_rows * 24 <= HOT_LIST_BROADCAST_BYTES:
            hot = F.broadcast(hot)
        tagged = per_order.join(hot, order, "left")
        pairs = _plain_pairs(tagged.filter(F.col("blocks").isNull()), order).unionByName(
            _block_pairs(tagged.filter(F.col("blocks").isNotNull()), order))
    pairs = pairs.select("Product_A", "Product_B", (F.col("n_a") * F.col("n_b")).alias("_both"))
    if products * (products - 1) // 2 > FEW_PAIRS:
        pairs = dealt(pairs, n_pairs, "Product_A", "Product_B")
    return pairs.groupBy("Product_A", "Product_B").agg(F.sum("_both").alias("cnt"))
