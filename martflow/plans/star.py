"""Star joins with a proven broadcast bound and eager aggregation.

A dimension is broadcast only when its size is *known* to be small: the
exact row count of a dimension is read from its files' metadata, once per
load.  Row count x estimated row width (of the columns actually used)
must stay under ``BROADCAST_LIMIT_BYTES``.

A dimension over the limit is not broadcast.  Then the fact is first joined
with the broadcastable dimensions (map-side, no shuffle) and pre-aggregated
on the large dimension's key plus the grouping columns already known; only
those aggregated rows are shuffle-joined with it, and a final aggregate
combines the partial sums.  Where the groups can be about as many as the rows
(:func:`many_groups`), partial aggregates would hold nearly every row of their
task: the rows are dealt out by group, so many to a task, and aggregated once.
With several large dimensions the needed columns of
the fact are shuffled once, to the largest; everything after that join moves
aggregated rows.  Only decomposable measures (sum, count) are used, which makes
the two-step aggregate exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.plans.warehouse import Warehouse
from martflow.session import dealt

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Session setting that overrides the limit (bytes), e.g. per cluster.
BROADCAST_LIMIT_CONF = "martflow.star.broadcastLimitBytes"
# Groups are many when their number x row width may be over this.
MANY_GROUPS_BYTES = 64 * 1024 * 1024

DIM_TABLE = {"customer": "dim_customer", "product": "dim_product", "store": "dim_store",
             "supplier": "dim_supplier", "time": "dim_time"}
DIM_KEY = {"customer": "Customer_ID", "product": "Product_ID", "store": "Store_ID",
           "supplier": "Supplier_ID", "time": "Time_ID"}


def _width(dt: T.DataType) -> int:
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, (T.IntegerType, T.DateType, T.FloatType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 16
    if isinstance(dt, T.StringType):
        return 48
    return 16


def row_bytes(schema: T.StructType) -> int:
    return 16 + sum(_width(f.dataType) for f in schema.fields)


def dimension(wh: Warehouse, d: str) -> DataFrame:
    """A dimension as the star joins see it."""
    dim = wh.table(DIM_TABLE[d])
    if d == "product":  # the fact carries its own store / supplier keys
        dim = dim.drop("Store_ID", "Supplier_ID")
    if d == "store":  # the store's city is not the buyer's
        dim = dim.withColumnRenamed("City_Category", "Store_City_Category")
    return dim


def broadcast_limit(wh: Warehouse) -> int:
    return int(wh.spark.conf.get(BROADCAST_LIMIT_CONF, str(BROADCAST_LIMIT_BYTES)))


def fits_broadcast(wh: Warehouse, d: str, columns: list[str], limit: int | None = None) -> bool:
    limit = broadcast_limit(wh) if limit is None else limit
    rows = wh.row_count(DIM_TABLE[d])
    if rows is None:
        return False
    schema = dimension(wh, d).select(*columns).schema
    return rows * row_bytes(schema) <= limit


def many_groups(wh: Warehouse, frames: dict[str, DataFrame], group_by: list[str]) -> bool:
    """Whether the groups may be too many for an aggregate before the shuffle.  They are
    no more than the fact's rows and the product of what each dimension
    can add: its rows, or its distinct labels, counted only if the rows say too little."""
    fact_rows = wh.row_count("fact_sales") or 0
    labels = {d: [c for c in f.columns if c != DIM_KEY[d] or c in group_by] for d, f in frames.items()}
    width = 16 + sum(row_bytes(frames[d].select(*cols).schema) - 16 for d, cols in labels.items())

    def over(cells: int) -> bool:
        return min(cells, fact_rows) * width > MANY_GROUPS_BYTES

    counts = {d: wh.row_count(DIM_TABLE[d]) or 0 for d, cols in labels.items() if cols}
    for d in sorted(counts, key=lambda d: counts[d]):
        if not over(math.prod(counts.values())):
            return False
        counts[d] = min(counts[d], frames[d].agg(F.approx_count_distinct(F.struct(*labels[d]))).first()[0])
    return over(math.prod(counts.values()))


@dataclass
class Derived:
    """A grouping label computed from dimension attributes."""

    needs: list[str]
    expr: Callable[[], Column]


def star_aggregate(wh: Warehouse, dims: list[str], group_by: list[str],
                   sums: dict[str, str] | None = None, counts: dict[str, str] | None = None,
                   derived: dict[str, Derived] | None = None, fact: DataFrame | None = None,
                   dim_filters: dict[str, Column] | None = None,
                   limit: int | None = None) -> DataFrame:
    """``group_by`` + exact sums / counts of fact columns over a star join.

    ``sums`` / ``counts`` map an output name to a fact column. ``derived``
    labels are computed as soon as the attributes they need are joined.
    ``dim_filters`` restrict a dimension before the join (inner join
    semantics)."""
    sums, counts, derived = sums or {}, counts or {}, derived or {}
    dim_filters = dim_filters or {}
    measure_cols = list(dict.fromkeys(list(sums.values()) + list(counts.values())))
    base = fact if fact is not None else wh.fact
    df = base.select(*list(dict.fromkeys(measure_cols + [DIM_KEY[d] for d in dims])))

    wanted = set(group_by) | {c for dv in derived.values() for c in dv.needs}
    frames = {}
    for d in dims:
        dim = dimension(wh, d)
        if d in dim_filters:
            dim = dim.filter(dim_filters[d])
        cols = [DIM_KEY[d]] + [c for c in dim.columns if c in wanted and c != DIM_KEY[d]]
        frames[d] = dim.select(*cols)
    small = [d for d in dims if fits_broadcast(wh, d, frames[d].columns, limit)]
    large = [d for d in dims if d not in small]

    pending = dict(derived)

    def add_derived(frame: DataFrame) -> DataFrame:
        for name, dv in list(pending.items()):
            if all(c in frame.columns for c in dv.needs):
                frame = frame.withColumn(name, dv.expr())
                del pending[name]
        return frame

    aggs = [F.sum(c).alias(n) for n, c in sums.items()]
    aggs += [F.count(c).alias(n) for n, c in counts.items()]
    final = [F.sum(n).alias(n) for n in list(sums) + list(counts)]
    rows = wh.row_count("fact_sales") or 0
    if fact is None and many_groups(wh, frames, group_by):
        if large:       # one row per keys first, however often a large dimension's row is sold
            ids = [DIM_KEY[d] for d in dims]
            df = dealt(df, rows, *ids).groupBy(*ids).agg(*aggs)
            for d in large:
                df = dealt(df, rows, DIM_KEY[d]).join(dealt(frames[d], rows, DIM_KEY[d]), DIM_KEY[d], "inner")
        for d in small:
            df = df.join(F.broadcast(frames[d]), DIM_KEY[d], "inner")
        df = add_derived(df)
        return dealt(df, rows, *group_by).groupBy(*group_by).agg(*(final if large else aggs))

    for d in small:
        df = df.join(F.broadcast(frames[d]), DIM_KEY[d], "inner")
    df = add_derived(df)

    if not large:
        return df.groupBy(*group_by).agg(*aggs)

    # Eager aggregation below the shuffle joins with the large dimensions.  One
    # of them: aggregate on its key first, then join.  Several: their keys
    # together are nearly as many as the fact's rows, so the fact is joined
    # with the largest as it is, and only then aggregated - by that one's
    # attributes and the other keys - below each further join.
    large.sort(key=lambda d: -(wh.row_count(DIM_TABLE[d]) or 0))
    summed = False
    for i, d in enumerate(large):
        rest = [DIM_KEY[x] for x in large[i:]]
        if i or len(large) == 1:
            keys = list(dict.fromkeys([c for c in group_by if c in df.columns]
                                      + [c for dv in pending.values() for c in dv.needs if c in df.columns] + rest))
            df = df.groupBy(*keys).agg(*(final if summed else aggs))
            summed = True
        df = add_derived(df.join(frames[d], DIM_KEY[d], "inner"))
    return df.groupBy(*group_by).agg(*final)
