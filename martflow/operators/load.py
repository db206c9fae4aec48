"""Staging -> star schema loaders.

Every loader is ``(staged, existing target) -> rows to append``.  Dimensions go
first and the fact last, and all are insert-ignore on their business key, so
re-running a load (or replaying a micro-batch) appends nothing twice.

A load of all tables shares its scans of the staged rows: :func:`batch_keys`
finds the keys of the batch for all dimensions in one scan, :func:`dimension_rows`
fetches the attributes of the new ones in a second (none when no key is new), and
the foreign keys are checked on those keys (:func:`missing_parents`), not on the
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.calendar import calendar_columns, time_key
from martflow.operators.keys import (
    FEW_KEYS_BYTES, first_per_key, insert_ignore, insert_ignore_rare,
)
from martflow.schemas import (
    ARRIVAL_ORDER, DIM_CUSTOMER_COLUMNS, DIM_PRODUCT_COLUMNS, DIM_STORE_COLUMNS,
    DIM_SUPPLIER_COLUMNS, DIM_TIME_COLUMNS, FACT_COLUMNS, FACT_FOREIGN_KEYS, FACT_KEY,
    FACT_KEY_REQUIRED,
    REVENUE_FACT, STAR_TABLES,
)


def dim_customer(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return insert_ignore(staged, ["Customer_ID"], ARRIVAL_ORDER, DIM_CUSTOMER_COLUMNS, target,
                         few_keys=True)


def dim_product(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return insert_ignore(staged, ["Product_ID"], ARRIVAL_ORDER, DIM_PRODUCT_COLUMNS, target,
                         few_keys=True)


def dim_store(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """City_Category comes from the buyer, so a store has one candidate per
    buyer city; the earliest sale decides."""
    return insert_ignore(staged, ["Store_ID"], ARRIVAL_ORDER, DIM_STORE_COLUMNS, target,
                         few_keys=True)


def dim_supplier(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return insert_ignore(staged, ["Supplier_ID"], ARRIVAL_ORDER, DIM_SUPPLIER_COLUMNS, target,
                         few_keys=True)


def dim_time(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row per calendar day, keyed by the date itself; Time_ID is the
    yyyymmdd number, so the fact needs no lookup join to find it."""
    days = staged.select(F.to_date("Date").alias("Date")).filter(F.col("Date").isNotNull())
    return calendar_rows(days.distinct(), target)  # a hash aggregate, combined map-side


def calendar_rows(days: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = days.select(time_key(F.col("Date")).alias("Time_ID"), "Date",
                       *calendar_columns(F.col("Date")))
    rows = rows.select(*DIM_TIME_COLUMNS)
    if target is None:
        return rows
    return rows.join(target.select("Date"), "Date", "left_anti").select(*DIM_TIME_COLUMNS)


def fact_rows(staged: DataFrame) -> DataFrame:
    """Fact-shaped rows of the staging table (J3 resolved by K1)."""
    return staged.select(
        "Order_ID", "Line_Number", "Customer_ID", "Product_ID", "Store_ID", "Supplier_ID",
        time_key(F.to_date("Date")).alias("Time_ID"),
        "Quantity",
        F.col("Revenue").cast(REVENUE_FACT).alias("Revenue"),
        F.year("Date").alias("Year"),
        "Date",
    )


def fact_sales(staged: DataFrame, target: DataFrame | None = None, batch_rows: int | None = None,
               target_rows: int | None = None) -> DataFrame:
    """Fact rows to append.  Order lines are almost never repeated, so only
    the key columns are shuffled to find the few that are (or that are
    already loaded); all other rows go straight to the write."""
    return insert_ignore_rare(fact_rows(staged), FACT_KEY, ARRIVAL_ORDER, FACT_COLUMNS, target,
                              required=FACT_KEY_REQUIRED, batch_rows=batch_rows, target_rows=target_rows)


def foreign_key_check(fact: DataFrame, dims: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Fact rows with ``Reject_Reason`` naming the first missing parent (J7);
    NULL when every non-NULL foreign key has its dimension row.  ``columns``
    limits the check to some foreign keys.

    The keys are looked up, not the rows: one scan of the fact finds the keys of
    all foreign keys (a hash aggregate, combined map-side), those without a row in
    their dimension are checkpointed and counted, and the rows are joined with
    them - by broadcast, where they are few.  A row without a key (NULL) has no parent to look for."""
    from martflow.plans.star import row_bytes
    from martflow.session import shared_dir
    checked = [fk for fk in FACT_FOREIGN_KEYS if columns is None or fk[0] in columns]
    names = [col for col, _, _ in checked]
    shared_dir(fact.sparkSession)
    keys = (fact.groupingSets([[c] for c in names], *names)
            .agg(F.grouping_id().cast("long").alias("_set")).checkpoint(eager=True))
    df, reasons = fact, [F.lit(None).cast("string")]
    for i, (col, dim, dim_col) in enumerate(checked):
        hit, others = f"_fk{i}", (1 << len(names)) - 1 - (1 << (len(names) - 1 - i))
        mine = keys.where((F.col("_set") == others) & F.col(col).isNotNull()).select(col)
        orphan = mine.join(dims[dim].select(F.col(dim_col).alias(col)), col, "left_anti").checkpoint(eager=True)
        n = orphan.count()
        if not n:
            continue
        orphan = orphan.withColumn(hit, F.lit(True))
        few = n * row_bytes(orphan.schema) <= FEW_KEYS_BYTES
        df = df.join(F.broadcast(orphan) if few else orphan, col, "left")
        reasons.append(F.when(F.col(hit), F.lit(f"no {dim} row for {col}")))
    return df.select(*fact.columns, F.coalesce(*reasons).alias("Reject_Reason"))


def foreign_key_split(fact: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows whose parents exist, rows with a missing parent + reason)."""
    checked = foreign_key_check(fact, dims)
    ok = checked.filter(F.col("Reject_Reason").isNull()).select(*fact.columns)
    return ok, checked.filter(F.col("Reject_Reason").isNotNull())


#: The dimensions that come from sales: table -> key and columns.
SALE_DIMENSIONS = {
    "dim_customer": ("Customer_ID", DIM_CUSTOMER_COLUMNS), "dim_product": ("Product_ID", DIM_PRODUCT_COLUMNS),
    "dim_store": ("Store_ID", DIM_STORE_COLUMNS), "dim_supplier": ("Supplier_ID", DIM_SUPPLIER_COLUMNS),
}
#: Those whose columns all come from one master row: the other two take one from the sale.
OF_ONE_MASTER = {"dim_customer", "dim_supplier"}
_KEYS = ["Customer_ID", "Product_ID", "Store_ID", "Supplier_ID", "Day"]


def _of(keys: DataFrame, key: str) -> DataFrame:
    """The rows of :func:`batch_keys` that hold keys of one dimension."""
    return keys.where((F.col("_set") == _set(key)) & F.col(key).isNotNull())


def batch_keys(staged: DataFrame) -> DataFrame:
    """Every dimension key of a batch with its earliest date, from one scan: a hash
    aggregate over the five grouping sets, combined map-side, so a hot key
    is one row per task before the shuffle.  Checkpointed in the shared folder."""
    from martflow.session import shared_dir
    rows = staged.select(*_KEYS[:-1], F.to_date("Date").alias("Day"), "Date")
    keys = rows.groupingSets([[k] for k in _KEYS], *_KEYS).agg(
        F.min("Date").alias("_lead"), F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_set"))
    shared_dir(staged.sparkSession)
    return keys.checkpoint(eager=True)


def _set(key: str) -> int:
    return (1 << len(_KEYS)) - 1 - (1 << (len(_KEYS) - 1 - _KEYS.index(key)))


def dimension_rows(staged: DataFrame, keys: DataFrame, targets: dict[str, DataFrame | None],
                   limit_bytes: int = FEW_KEYS_BYTES) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Rows to append to each dimension that has new keys, and the numbers of those
    keys.  Keys that are already there are left
    out first; only where keys are new are the staged rows scanned, once for all
    dimensions: the rows of a new key's earliest date are kept map-side and the
    first of them by arrival order is taken.  For a dimension whose new keys are too
    many to broadcast see :func:`rows_of_many_keys`."""
    from martflow.plans.star import row_bytes
    fresh = []
    dims = {**SALE_DIMENSIONS, "dim_time": ("Day", DIM_TIME_COLUMNS)}
    for table, (key, _) in dims.items():
        mine, target = _of(keys, key), targets.get(table)
        if target is not None:
            loaded = target.select(F.col("Date").alias("Day") if key == "Day" else key)
            mine = mine.join(loaded, key, "left_anti").select(*keys.columns)
        fresh.append(mine)
    fresh_keys = reduce(DataFrame.unionByName, fresh).checkpoint(eager=True)
    found = {r["_set"]: r["count"] for r in fresh_keys.groupBy("_set").count().collect()}
    counts = {table: found.get(_set(key), 0) for table, (key, _) in dims.items()}
    out = {}
    if counts["dim_time"]:
        out["dim_time"] = calendar_rows(_of(fresh_keys, "Day").select(F.col("Day").alias("Date")))
    picked, rows = [], staged
    for table, (key, columns) in SALE_DIMENSIONS.items():
        if not counts[table]:
            continue
        mine = _of(fresh_keys, key).select(key, F.col("_lead").alias(f"_{table}"))
        if counts[table] * row_bytes(mine.schema) > limit_bytes:
            out[table] = rows_of_many_keys(staged, _of(fresh_keys, key).select(key), key, columns,
                                           table in OF_ONE_MASTER, limit_bytes)
        else:
            picked.append(table)
            rows = rows.join(F.broadcast(mine), key, "left")
    if picked:
        first = {t: F.col("Date") == F.col(f"_{t}") for t in picked}
        wanted: Column = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in first.values()])
        candidates = rows.where(wanted).checkpoint(eager=True)
        for t in picked:
            key, columns = SALE_DIMENSIONS[t]
            out[t] = first_per_key(candidates.where(first[t]), [key], ARRIVAL_ORDER, columns).select(*columns)
    return out, counts


def rows_of_many_keys(staged: DataFrame, fresh: DataFrame, key: str, columns: list[str],
                      from_master: bool, limit_bytes: int = FEW_KEYS_BYTES) -> DataFrame:
    """Dimension rows of new keys (``fresh``) that are too many to broadcast.

    The staged rows are not dealt out by key: each task reduces its own to one row a
    key first, which leaves few where the rows were staged by that key.  Which row of a
    key comes first matters only where its rows differ, so with columns that are all
    ``from_master`` the distinct rows are found, by a hash aggregate of these columns
    alone, and only keys with several have theirs taken in arrival order."""
    from martflow.plans.star import row_bytes
    rows = staged.where(F.col(key).isNotNull()).select(*dict.fromkeys([*ARRIVAL_ORDER, *columns]))
    if not from_master:
        return first_per_key(rows, [key], ARRIVAL_ORDER, columns).select(*columns).join(fresh, key, "left_semi")
    others = [c for c in columns if c != key]
    kinds = rows.select(*columns).distinct().groupBy(key).agg(
        F.count(F.lit(1)).alias("_kinds"), F.min(F.struct(*others)).alias("_row"))
    kinds = kinds.join(fresh, key, "left_semi").checkpoint(eager=True)
    same = kinds.where("_kinds = 1").select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in columns])
    differing = kinds.where("_kinds > 1").select(key)
    n = differing.count()
    if not n:
        return same
    if n * row_bytes(differing.schema) <= limit_bytes:
        differing = F.broadcast(differing)
        rows = rows.join(differing, key, "left_semi")
    firsts = first_per_key(rows, [key], ARRIVAL_ORDER, columns).select(*columns)
    return same.unionByName(firsts.join(differing, key, "left_semi"))


def missing_parents(keys: DataFrame, dims: dict[str, DataFrame]) -> dict[str, int]:
    """J7 on the keys of a batch: foreign-key column -> number of keys without
    their dimension row (columns without such keys are left out).  The rows of the
    fact are joined with nothing."""
    missing = []
    for col, dim, dim_col in FACT_FOREIGN_KEYS:
        if col == "Time_ID":
            mine = _of(keys, "Day").select(time_key(F.col("Day")).alias(col))
        else:
            mine = _of(keys, col).select(col)
        parent = dims[dim].select(F.col(dim_col).alias(col))
        missing.append(mine.join(parent, col, "left_anti").select(F.lit(col).alias("fk")))
    return {r["fk"]: r["count"] for r in reduce(DataFrame.unionByName, missing).groupBy("fk").count().collect()}


@dataclass
class LoadResult:
    """What one load appended, per table."""

    rows: dict[str, int]

    def report(self, spark: SparkSession) -> DataFrame:
        """Rows newly loaded per table."""
        values = ", ".join(f"('{t}', CAST({self.rows[t]} AS BIGINT))" for t in STAR_TABLES if t in self.rows)
        return spark.sql(f"SELECT * FROM VALUES {values} AS report(table_name, rows_loaded)")


# Loader of each star table: (staged rows, existing table or None) -> rows to append.
LOADERS = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_supplier": dim_supplier,
    "dim_time": dim_time,
    "fact_sales": fact_sales,
}
