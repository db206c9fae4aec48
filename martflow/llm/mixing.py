"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / weight``; ``u`` comes from
a hash of its id, so reruns agree.  Inside its source, documents are taken in
key order until the token budget is reached.  A target above the source's own
size first takes complete epochs; only the rest is selected by key.

No task sorts a whole source: the range of a source's keys is cut into buckets,
their sizes are summed, and the bucket in which the budget ends is cut again until
it holds few rows; only those are sorted by row.  Null sources form a source of their own; null or empty texts have size 0
and nothing is taken from them; repeated rows count as rows; an empty table
gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, keep, read, row_numbers

#: Rows of a source that one task may sort, and buckets that a range is cut into.
ROWS_PER_BUCKET = 10_000
CUTS = 1024


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Default quality weight: the share of letters, at least 0.05."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    share = letters / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.05))


def unit_draw(doc_id: Column, seed: str) -> Column:
    """Uniform in (0, 1) from a hash of the id."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``source, source_size, target`` from one row per source
    (``source, source_size``).  The wanted total is shared out by weight; a
    source above ``most`` times its size stays there, and what it cannot take
    is shared again by weight among the others."""
    ranked = row_numbers(sources, F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(w) for w in weights])
    cap = keep(ranked.select(
        "source", "source_size", (F.col("source_size") * most).alias("cap"),
        F.element_at(choices, (F.col("rank") % len(weights) + 1).cast("int")).cast("long").alias("w")), "caps")
    total = (cap.agg(F.sum("source_size")).first()[0] or 0) * share
    capped, left_weight = 0, cap.agg(F.sum("w")).first()[0] or 0
    full = F.lit(False)
    while left_weight:
        level = F.col("w") * F.lit(float(total - capped)) / F.lit(float(left_weight))
        full = level > F.col("cap")
        row = cap.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w")))).first()
        if (row[0] or 0) == capped:
            break
        capped, left_weight = row[0], row[1] or 0
        full = F.lit(True) if not left_weight else full
    level = F.col("w") * F.lit(float(total - capped)) / F.lit(float(left_weight or 1))
    return cap.select("source", "source_size",
                      F.when(full, F.col("cap").cast("double")).otherwise(level).alias("target"))


def _budget_ends(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """``source, low, high, before, rest``: the range of keys in which a source's
    budget ends, few rows long, and the size of what comes before it.  A source
    whose rest covers all its rows has none."""
    ends = keep(sized.groupBy("source").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
                .withColumn("before", F.lit(0).cast("long")).alias("e")
                .join(goal.alias("g"), F.col("e.source").eqNullSafe(F.col("g.source")))
                .select("e.source", "low", "high", "n", "before", "rest"), "ends")
    order = Window.partitionBy("s").orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        # the first time all sources are cut, to find those whose budget does not end
        share = (F.col("key") - F.col("low")) / (F.col("high") - F.col("low"))
        cut = F.when(F.col("high") > F.col("low"), F.least(F.floor(share * CUTS), F.lit(CUTS - 1))).otherwise(F.lit(0))
        at = ends.withColumnRenamed("source", "s").drop("n")
        counted = (sized.join(at, F.col("source").eqNullSafe(F.col("s")))
                   .where(F.col("key").between(F.col("low"), F.col("high")))
                   .groupBy("s", "before", "rest", cut.alias("cut"))
                   .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
                   .withColumn("upto", F.col("before") + F.sum("size").over(order)).where("upto > rest"))
        ends = keep(counted.groupBy("s").agg(F.min(F.struct("cut", "low", "high", "n", (F.col("upto") - F.col("size"))
                                                            .alias("before"), "rest")).alias("e"))
                    .select(F.col("s").alias("source"), "e.low", "e.high", "e.n", "e.before", "e.rest"), "ends")
        if ends.where((F.col("n") > ROWS_PER_BUCKET) & (F.col("high") > F.col("low"))).isEmpty():
            return ends


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
        seed: str = "mix", size: Column | None = None, weight: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target,
    copies, taken``.  ``copies`` is how often the mix holds the document."""
    text = F.col("text")
    sized = keep(docs.select(
        "doc_id", "source", (text_size(text) if size is None else size).alias("size"),
        (-F.log(unit_draw(F.col("doc_id"), seed)) / (letter_share(text) if weight is None else weight)).alias("key")), "sized")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = keep(goal.withColumn("epochs", F.when(F.col("source_size") > 0,
                                                 F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
                .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")

    ends = _budget_ends(sized, goal)
    g, e = goal.alias("g"), ends.alias("e")
    budgets = keep(g.join(e, F.col("g.source").eqNullSafe(F.col("e.source")), "left")
                   .select(F.col("g.source").alias("s"), "source_size", "target", "epochs", "g.rest", "low", "high",
                           "before"), "budgets")
    rows = sized.join(budgets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    on_edge = F.coalesce(F.col("key").between(F.col("low"), F.col("high")), F.lit(False))
    inside = rows.where(~on_edge).withColumn("chosen", F.col("low").isNull() | (F.col("key") < F.col("low")))
    # only the bucket in which the budget ends is ordered row by row
    line = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size") \
                 .rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.where(on_edge).withColumn("upto", F.col("before") + F.sum("size").over(line)).withColumn(
        "chosen", F.col("upto") - F.col("size") / 2 <= F.col("rest")).drop("upto")
    copies = F.col("epochs") + F.when(F.col("chosen") & (F.col("rest") > 0), F.lit(1)).otherwise(F.lit(0))
    return inside.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed corpus itself: every row of ``docs`` as often as it is taken.
    Rows are matched by ``doc_id``; those that repeat an id go together."""
    often = (mixed.where("copies > 0").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max("copies").alias("_copies")))
    return (docs.join(often, docs["doc_id"].eqNullSafe(often["_id"]))
            .select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                    F.explode(F.sequence(F.lit(1), often["_copies"])))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         greatest(coalesce(len(regexp_replace(text, '[^\p{L}]+', '', 'g')) / greatest(len(text), 1), 0.0), 0.05) AS weight
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 1.5 * sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER before, 0) AS capped, sum(w) OVER rest AS left_weight
  FROM ranked
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (   -- the first source, by room per weight, that the shared level does not fill
  SELECT CAST(total - capped AS DOUBLE) AS pool, CAST(left_weight AS DOUBLE) AS left_weight, source_size / w AS room
  FROM ordered WHERE w * (total - capped) / left_weight <= 2 * source_size
  ORDER BY room LIMIT 1),
goal AS (
  SELECT source, source_size,
         CASE WHEN w * pool / left_weight > 2 * source_size OR pool IS NULL
              THEN CAST(2 * source_size AS DOUBLE) ELSE w * pool / left_weight END AS target
  FROM ranked LEFT JOIN level ON true),
keyed AS (
  SELECT s.doc_id, s.size, g.*,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest,
         -ln((CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
             / 4503599627370496.0) / weight AS key
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size
                            ROWS UNBOUNDED PRECEDING) AS upto FROM keyed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM summed
"""
