"""Key operators: first row per key (D1) and insert-ignore (D1 + J6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                  payload: list[str]) -> DataFrame:
    """The row with the smallest ``order_by`` tuple for every key.

    Written as ``min(struct(order..., payload...))`` per key rather than a
    ``row_number`` window: the aggregate is combined map-side, so a key that
    holds a third of all rows is reduced to one row per task before the
    shuffle instead of landing whole in one window task.  Ties on the full
    ``order_by`` tuple are broken by the payload, which keeps the result
    deterministic.
    """
    order_by = [c for c in order_by if c not in keys]
    fields = list(dict.fromkeys(order_by + [c for c in payload if c not in keys]))
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    index = {c: i for i, c in enumerate(fields)}
    return agg.select(*keys, *[F.col(f"_first.f{index[c]}").alias(c)
                               for c in payload if c not in keys])


#: Buckets of the fact's key index, and orders with consecutive numbers that share one.
KEY_BUCKETS, ORDERS_PER_BLOCK_BITS = 256, 10


def order_bucket(order: Column) -> Column:
    """Bucket of an order in the key index: a hash of its block of consecutive
    numbers.  Orders are numbered as they come, so a batch falls into few
    buckets; blocks are spread evenly, however hot an order is."""
    return F.pmod(F.xxhash64(F.shiftright(order, ORDERS_PER_BLOCK_BITS)), F.lit(KEY_BUCKETS)).cast("int")


#: A target of at most so many times the batch's rows is counted together with it,
#: a larger one where the batch's keys are too many to broadcast.
TARGET_PER_BATCH = 2

# A key set is "few" when (number of keys x row width) is under this.
FEW_KEYS_BYTES = 64 * 1024 * 1024


#: A key with more rows than this is hot; at most one in so many rows can be one.
HOT_KEY_ROWS = 1_000_000


def rows_at_lead(df: DataFrame, leads: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` joined with ``leads`` (keys, ``_rows`` of each, further columns), which
    is too large to broadcast: rows are dealt out by key, those of hot keys stay
    where they are and meet the few leads of such keys in a broadcast."""
    hot = F.broadcast(leads.where(F.col("_rows") > HOT_KEY_ROWS))
    others = df.join(hot.select(*keys), keys, "left_anti").join(
        leads.where(F.col("_rows") <= HOT_KEY_ROWS), keys, "inner")
    return others.unionByName(df.join(hot, keys, "inner").select(*others.columns)).drop("_rows")


def first_per_key_few(df: DataFrame, keys: list[str], order_by: list[str],
                      payload: list[str], limit_bytes: int = FEW_KEYS_BYTES) -> DataFrame:
    """:func:`first_per_key` for a key set that is small next to the rows
    (a dimension: stores, suppliers, customers of a batch).

    Phase 1 is a hash aggregate (numeric / date buffers) that finds, per
    key, the smallest value of the leading order column.  It is checkpointed
    and counted; when it fits ``limit_bytes`` it is broadcast and phase 2 keeps
    only the rows at that leading value (map-side), so the sort-based
    tie-break runs on those few rows instead of sorting the whole batch.
    The lexicographic minimum of (o0, o1, ...) is the minimum of (o1, ...)
    among the rows whose o0 is minimal, so the result is exact.  NULL sorts
    first, as in :func:`first_per_key`.  Over the limit the rows are dealt out by
    key (:func:`rows_at_lead`).
    """
    from martflow.plans.star import row_bytes
    from martflow.session import shared_dir
    lead = next(c for c in order_by if c not in keys)
    phase1 = df.groupBy(*keys).agg(
        F.min(lead).alias("_lead_min"),
        F.max(F.col(lead).isNull().cast("int")).alias("_lead_null"), F.count(F.lit(1)).alias("_rows"))
    shared_dir(df.sparkSession)  # make sure the checkpoint folder is set
    phase1 = phase1.checkpoint(eager=True)  # counted and broadcast from there: one scan, not two
    n = phase1.count()
    if n * row_bytes(phase1.drop("_rows").schema) > limit_bytes:
        joined = rows_at_lead(df.select(*dict.fromkeys([*keys, *order_by, *payload])), phase1, keys)
    else:
        joined = df.join(F.broadcast(phase1.drop("_rows")), keys, "inner")
    at_lead = joined.filter(
        F.when(F.col("_lead_null") == 1, F.col(lead).isNull())
        .otherwise(F.col(lead) == F.col("_lead_min")))
    return first_per_key(at_lead.drop("_lead_min", "_lead_null"), keys, order_by, payload)


def not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def _null_safe_keys(df: DataFrame, keys: list[str], optional: list[str]) -> tuple[DataFrame, list[str]]:
    """Plain, never-NULL key columns for the optional key parts: (value or a
    typed default, is-NULL flag).  Grouping and joining on them equals
    NULL-safe grouping / joining on the original column, and because they
    are plain columns the join can reuse the aggregate's partitioning."""
    types = dict(df.dtypes)
    out = df
    names = []
    for k in keys:
        if k not in optional:
            names.append(k)
            continue
        default = F.lit("") if types[k] == "string" else F.lit(0).cast(types[k])
        out = out.withColumn(f"_v_{k}", F.coalesce(F.col(k), default)) \
                 .withColumn(f"_n_{k}", F.col(k).isNull())
        names += [f"_v_{k}", f"_n_{k}"]
    return out, names


def insert_ignore(batch: DataFrame, keys: list[str], order_by: list[str],
                  columns: list[str], target: DataFrame | None = None,
                  required: list[str] | None = None, few_keys: bool = False) -> DataFrame:
    """Rows of ``batch`` to append to ``target`` under INSERT IGNORE rules.

    Rows with a NULL in a ``required`` key part (default: every key part)
    are skipped, the first row per key (by ``order_by``) wins, and keys
    already in ``target`` are never touched (SCD type 0).  Optional key parts
    compare NULL-safely, so a replayed row with a NULL part is recognised.
    Only the key columns of the target are read (column pruning at the scan).
    ``few_keys`` (dimensions) picks :func:`first_per_key_few`.
    """
    required = keys if required is None else required
    optional = [k for k in keys if k not in required]
    rows, group_keys = _null_safe_keys(not_null(batch, required), keys, optional)
    payload = [c for c in columns if c not in group_keys]
    pick = first_per_key_few if few_keys else first_per_key
    candidates = pick(rows, group_keys, order_by, payload)
    if target is None:
        return candidates.select(*columns)
    existing, _ = _null_safe_keys(not_null(target, required), keys, optional)
    existing = existing.select(*group_keys)
    return candidates.join(existing, group_keys, "left_anti").select(*columns)


def insert_ignore_rare(batch: DataFrame, keys: list[str], order_by: list[str],
                       columns: list[str], target: DataFrame | None = None,
                       required: list[str] | None = None,
                       limit_bytes: int = FEW_KEYS_BYTES, batch_rows: int | None = None,
                       target_rows: int | None = None) -> DataFrame:
    """:func:`insert_ignore` for keys that are almost always unique (the
    order lines of the fact).

    Only the key columns are shuffled: a hash aggregate counts each key of
    the batch, and with a ``target`` a semi join finds the batch keys that
    are already loaded.  The keys
    that need attention - repeated in the batch or already present - are
    checkpointed to the shared folder and counted; when they fit
    ``limit_bytes`` they are broadcast, every other row passes straight
    through (map-side), and only the repeated new keys go through the
    first-row-per-key aggregate.  When they do not fit (a delivery that comes a
    second time), the rows are dealt out by key to meet them; where many keys
    repeat in the batch too, this is :func:`insert_ignore`.  The result is the
    same as that of :func:`insert_ignore`.

    With the numbers of rows of the batch and of the target known, a batch that
    fits ``limit_bytes`` is broadcast to a target of more than ``TARGET_PER_BATCH``
    times its rows.  Any other is counted together with the target: each key is
    shuffled once, not once to be counted and again to be looked up, and a batch of
    which every row is already loaded (a replay) ends there.
    """
    from martflow.plans.star import row_bytes
    from martflow.session import shared_dir
    required = keys if required is None else required
    optional = [k for k in keys if k not in required]
    rows, group_keys = _null_safe_keys(not_null(batch, required), keys, optional)
    sizes_known = target is not None and batch_rows is not None and target_rows is not None
    batch_fits = sizes_known and batch_rows * row_bytes(rows.select(*group_keys).schema) <= limit_bytes
    together = sizes_known and (target_rows <= TARGET_PER_BATCH * batch_rows or not batch_fits)
    if target is not None:
        existing, _ = _null_safe_keys(not_null(target, required), keys, optional)
    if together:
        both = rows.select(*group_keys, F.lit(1).alias("_b"), F.lit(False).alias("_e")).unionByName(
            existing.select(*group_keys, F.lit(0).alias("_b"), F.lit(True).alias("_e")))
        counts = both.groupBy(*group_keys).agg(F.sum("_b").alias("_n"), F.max("_e").alias("_exists"))
        special = counts.filter((F.col("_n") > 1) | ((F.col("_n") == 1) & F.col("_exists")))
    else:
        counts = rows.groupBy(*group_keys).agg(F.count(F.lit(1)).alias("_n"))
        special = counts.filter(F.col("_n") > 1).select(*group_keys, F.lit(False).alias("_exists"))
    if target is not None and not together:
        # Loaded keys that occur in this batch.  As a semi join of the table
        # with the batch keys, the table stays where it is when those are known to
        # be few; else Spark's runtime bloom filter (built from the batch side)
        # skips most of a large table before the shuffle.
        wanted = rows.select(*group_keys)
        present = (existing.select(*group_keys)
                   .join(F.broadcast(wanted) if batch_fits else wanted, group_keys, "left_semi")
                   .select(*group_keys, F.lit(True).alias("_exists")))
        special = special.unionByName(present).groupBy(*group_keys).agg(
            F.max("_exists").alias("_exists"))
    shared_dir(batch.sparkSession)  # make sure the checkpoint folder is set
    special = special.checkpoint(eager=True)
    if together:
        seen = special.groupBy("_exists").agg(F.count(F.lit(1)).alias("count"), F.sum("_n").alias("rows")).collect()
        if any(r["_exists"] and r["rows"] == batch_rows for r in seen):    # every row is there
            return rows.where(F.lit(False)).select(*columns)
        special = special.drop("_n")
    else:
        seen = special.groupBy("_exists").count().collect()
    found = {r["_exists"]: r["count"] for r in seen}
    if found.get(False, 0) * row_bytes(special.schema) > limit_bytes:
        return insert_ignore(batch, keys, order_by, columns, target, required)
    if not found:       # every key is new and comes once
        return rows.select(*columns)
    few = sum(found.values()) * row_bytes(special.schema) <= limit_bytes
    flagged = F.broadcast(special) if few else special
    passthrough = rows.join(flagged, group_keys, "left_anti")
    if False not in found:
        return passthrough.select(*columns)
    repeated = rows.join(F.broadcast(special.filter(~F.col("_exists")).select(*group_keys)), group_keys,
                         "left_semi")
    payload = [c for c in columns if c not in group_keys]
    firsts = first_per_key(repeated, group_keys, order_by, payload)
    return passthrough.select(*columns).unionByName(firsts.select(*columns))
