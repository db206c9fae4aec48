"""N-gram Jaccard self-join of texts: size-aware, heavy and light.

A document's set holds its distinct shingles (64-bit hashes).  Documents with
equal sets form a class; the join runs on classes.  Two sets of sizes a and b
link when they share at least ``need(a, b) = ceil(t / (1 + t) * (a + b))``.

* Light sets (size up to a boundary) enumerate all subsets of the fixed sizes
  ``need(n, m)`` over the light partner sizes m: two light sets link exactly
  when they share such a subset.
* Heavy sets scan inverted lists, those of their rarest elements: sets that
  link must meet in the first ``n - ceil(t * n) + 1`` elements of any common
  order; frequent shingles come last in it, so long lists are hardly used.
* The boundary is where enumerating becomes dearer than scanning; the lists'
  mean length enters it and is measured on the data.

Every list first compares its members with one hub.  Members that end up in
the hub's component need no further comparison; pairs of a list across
components are then all compared.  So the components are exact, while a group
of n near copies costs about n comparisons.  Candidates are held against the
bound that their prefixes give, and then verified on the whole sets.

Null or empty texts have an empty set, size 0 and no link; texts with fewer
words than a shingle have one shingle, the whole sequence; repeated rows are
one class; null ids are kept, unlinked; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, keep, lean, read

WORDS = 5
SIMILARITY = Fraction(4, 5)
#: Frequent shingles known to every task: this many at most, 8 bytes each.
MAX_FREQUENT = 1 << 18
#: Counters a task keeps while it counts shingles.
COUNTERS = 1 << 16
#: Lists of shingles at least this frequent are never brought into one task.
HOT_LIST = 10_000
MAX_LIGHT = 16
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text (A-Z in lower case)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(words, len(tokens))
    out = h[:len(h) - k + 1] * _ODD[0]
    for i in range(1, k):
        out = out + h[i:len(h) - k + 1 + i] * _ODD[i % 8] * np.uint64(2 * (i // 8) + 1)
    return np.unique(_mix(out + np.uint64(k)).view(np.int64))


def set_key(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def need(a: int, b: int, t: Fraction) -> int:
    return -int(-(t * (a + b)) // (1 + t))


def prefix_length(n: int, t: Fraction) -> int:
    return n - (-int(-(t * n) // 1)) + 1


def subset_sizes(n: int, light: int, t: Fraction) -> list[int]:
    """Sizes of the subsets that a light set of size n enumerates."""
    low, high = -int(-(t * n) // 1), min(light, int(n / t))
    return sorted({need(n, m, t) for m in range(max(low, 1), high + 1)})


def light_boundary(list_length: float, t: Fraction) -> int:
    """Largest size up to which enumerating subsets costs no more than scanning
    the lists of the prefix and fetching the set to verify it."""
    light = 0
    for n in range(1, MAX_LIGHT + 1):
        if sum(comb(n, o) for o in subset_sizes(n, n, t)) > prefix_length(n, t) * list_length + n:
            break
        light = n
    return light


def _texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    ids = batch.column(0).to_pylist()
    for i, text in enumerate(batch.column(1)):
        yield ids[i], text.as_py()


def _first_pass(words: int, counters: int):
    """Per document its set's size and key; at the end of the task the
    shingles it met more than once, the most frequent ``counters`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def add(arrays: list[np.ndarray]) -> None:
            nonlocal seen, counts
            got, n = np.unique(np.concatenate(arrays), return_counts=True)
            every, at = np.unique(np.concatenate([seen, got]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, n]), len(every)).astype(np.int64)
            top = np.argsort(-total, kind="stable")[:counters]
            top = top[total[top] > 1]
            seen, counts = every[top], total[top]

        total = 0
        for batch in batches:
            out, held, size = [], [], 0
            for doc_id, text in _texts(batch):
                s = shingle_set(text, words)
                out.append((doc_id, len(s), set_key(s)))
                held.append(s)
                size += len(s)
                total += len(s)
                if size > 1_000_000:
                    add(held)
                    held, size = [], 0
            if held:
                add(held)
            if out:
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * len(a), pa.int8()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                     pa.array(c, pa.int64())], names=["kind", "id", "n", "key"])
        kind = np.concatenate([np.full(len(seen), 1), [2]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int8()), pa.array(np.append(seen, 0), pa.int64()),
             pa.array(np.append(counts, total), pa.int64()), pa.array(np.zeros(len(kind)), pa.int64())],
            names=["kind", "id", "n", "key"])
    return run


def _signatures(words: int, t: Fraction, light: int, frequent):
    """Rows ``sig, doc, n, pos, hot`` of each distinct set in the task: the
    prefix elements of a set that may link with heavy ones, and the subsets of
    a light set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = frequent.value
        done: set[int] = set()
        for batch in batches:
            parts, docs, sizes = [], [], []
            for doc_id, text in _texts(batch):
                s = shingle_set(text, words)
                n, key = len(s), set_key(s)
                if not n or doc_id is None or key in done:
                    continue
                done.add(key)
                sig, pos, hot = [], [], []
                if int(n / t) > light:
                    p = prefix_length(n, t)
                    weight = np.zeros(n, np.int64)
                    if len(common):
                        where = np.minimum(np.searchsorted(common, s), len(common) - 1)
                        weight = np.where(common[where] == s, rank[where], 0)
                    order = np.lexsort((s, weight))[:p]
                    sig.append(s[order])
                    pos.append(np.arange(p))
                    hot.append(weight[order] >= HOT_LIST)
                if n <= light:
                    subsets = [xxhash.xxh3_64_intdigest(np.array(c).tobytes(), o)
                               for o in subset_sizes(n, light, t) for c in combinations(s.tolist(), o)]
                    sig.append(np.array(subsets, np.uint64).view(np.int64))
                    pos.append(np.zeros(len(subsets), np.int64))
                    hot.append(np.zeros(len(subsets), bool))
                parts.append([np.concatenate(x) for x in (sig, pos, hot)])
                docs.append(np.full(len(parts[-1][0]), doc_id))
                sizes.append(np.full(len(parts[-1][0]), n))
            if parts:
                sig, pos, hot = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig, pa.int64()), pa.array(np.concatenate(docs), pa.int64()),
                     pa.array(np.concatenate(sizes), pa.int32()), pa.array(pos, pa.int32()), pa.array(hot)],
                    names=["sig", "doc", "n", "pos", "hot"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = shingles = None
        for batch in batches:
            out = []
            for _, own in _texts(batch):
                if shingles is None or own != text:     # a text stands once for each of its pairs
                    text, shingles = own, shingle_set(own, words)
                out.append(shingles.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array(out, pa.list_(pa.int64()))],
                names=["pair", "side", "shingles"])
    return run


#: Pairs of a document that one task checks, hubs that may be broadcast (12 bytes
#: each), and members of a list that one task meets with all others.
PAIRS_PER_PART, HUBS_BROADCAST, LIST_PART = 1000, 1_000_000, 2000


def _verified(pairs: DataFrame, docs: DataFrame, words: int, t: Fraction) -> DataFrame:
    """The pairs ``(a, b)`` of documents that link, checked on the whole sets:
    each document's set goes once to each of its pairs."""
    numbered = keep(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")
    sides = keep(numbered.select(F.col("a").alias("_id"), "pair", F.lit(0).alias("side")).unionByName(
        numbered.select(F.col("b").alias("_id"), "pair", F.lit(1).alias("side"))), "sides")
    # a hub stands in as many pairs as its group has members: it is dealt out in parts
    hubs = keep(sides.groupBy("_id").agg(F.ceil(F.count("*") / PAIRS_PER_PART).cast("int").alias("parts"))
                .where("parts > 1").withColumnRenamed("_id", "_hub"), "hubs")
    if hubs.count() <= HUBS_BROADCAST:
        hubs = F.broadcast(hubs)
    parts = F.coalesce(F.col("parts"), F.lit(1))
    dealt = (docs.join(hubs, docs["doc_id"] == F.col("_hub"), "left")
             .select("doc_id", "text", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")))
    asked = (sides.join(hubs, F.col("_id") == F.col("_hub"), "left")
             .select("_id", "pair", "side", F.pmod("pair", parts).cast("int").alias("_part")))
    # the same join at every size: most corpora have more pairs than a broadcast holds
    texts = dealt.join(asked.hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("part") == F.col("_part"))) \
                 .select("doc_id", "text", "pair", "side")
    sets = texts.mapInArrow(lean(_sets(words)), "pair long, side int, shingles array<long>")
    both = sets.groupBy("pair").agg(F.collect_list(F.struct("side", "shingles")).alias("s"))
    # one row each, as ids are unique; where one is repeated, any of its texts may link
    left = F.filter("s", lambda r: r["side"] == 0)
    right = F.filter("s", lambda r: r["side"] == 1)

    def links(x: Column, y: Column) -> Column:
        shared = F.size(F.array_intersect(x["shingles"], y["shingles"]))
        total = F.size(x["shingles"]) + F.size(y["shingles"])
        return shared * (t.numerator + t.denominator) >= total * t.numerator

    linked = both.where(F.exists(left, lambda x: F.exists(right, lambda y: links(x, y)))).select("pair")
    return keep(numbered.join(keep(linked, "linked"), "pair").select("a", "b"), "links")


def _possible(t: Fraction):
    """Length and position filters for two members x, y of a list; exact at the
    first element that the two prefixes share."""
    a, b = F.col("x.n"), F.col("y.n")
    sizes = (F.least(a, b) * t.denominator >= F.greatest(a, b) * t.numerator)
    best = 1 + F.least(a - F.col("x.pos") - 1, b - F.col("y.pos") - 1)
    return sizes & (best * (t.numerator + t.denominator) >= (a + b) * t.numerator)


def _likely(pairs: DataFrame, heads: DataFrame, light: int, t: Fraction) -> DataFrame:
    """The pairs that may still link by what their prefixes share.  Of two
    prefixes, take the one that ends first in the common order: whatever the
    sets share up to there lies in both prefixes, so the overlap is at most
    that and the rest of its set.  (Two light sets met in a subset already.)"""
    left = heads.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sigs").alias("sa"))
    right = heads.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sigs").alias("sb"))

    def rest(n: str) -> Column:
        return F.floor((F.col(n) * t.numerator + t.denominator - 1) / t.denominator) - 1

    most = F.size(F.array_intersect("sa", "sb")) + F.greatest(rest("na"), rest("nb"))
    enough = most * (t.numerator + t.denominator) >= (F.col("na") + F.col("nb")) * t.numerator
    return pairs.join(left, "a").join(right, "b").where(
        enough | ((F.col("na") <= light) & (F.col("nb") <= light))).select("a", "b")


def jaccard_components(docs: DataFrame, words: int = WORDS, t: Fraction = SIMILARITY,
                       light: int | None = None) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, n_shingles,
    component_id``.  ``light`` fixes the boundary, for tests."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = keep(docs.mapInArrow(lean(_first_pass(words, COUNTERS)), "kind byte, id long, n long, key long"), "first")
    sized = first.where("kind = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "key")
    classes = keep(sized.where("n_shingles > 0 and doc_id is not null").groupBy("key")
                   .agg(F.min("doc_id").alias("rep")), "classes")

    total = first.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    top = (first.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where("n > 2")
           .orderBy(F.desc("n"), "id").limit(MAX_FREQUENT).toPandas().sort_values("id"))
    common, rank = top["id"].to_numpy(np.int64), top["n"].to_numpy(np.int64)
    length = max(1.0, total / max(1, total - int(rank.sum()) + len(rank)))
    light = light_boundary(length, t) if light is None else light
    frequent = spark.sparkContext.broadcast((common, rank))

    rows = keep(docs.mapInArrow(lean(_signatures(words, t, light, frequent)),
                                "sig long, doc long, n int, pos int, hot boolean"), "lists")
    # lists with a single member drop out here; those of frequent shingles stay as they are
    cold = (rows.where(~F.col("hot")).withColumn("times", F.count("*").over(Window.partitionBy("sig")))
            .where("times > 1").drop("times"))
    copies = sized.join(classes, "key").where("doc_id <> rep").select(F.col("doc_id").alias("doc"), "rep").distinct()
    members = keep(cold.unionByName(rows.where("hot")).join(keep(copies, "copies"), "doc", "left")
                   .select("sig", F.coalesce("rep", "doc").alias("doc"), "n", "pos")
                   .dropDuplicates(["sig", "doc"]), "members")

    lists = (members.groupBy("sig").agg(F.min(F.struct("doc", "n", "pos")).alias("hub"), F.max("doc").alias("last"))
             .where("hub.doc <> last").select("sig", "hub"))
    star = members.join(lists, "sig").where("doc <> hub.doc").select(
        F.struct("doc", "n", "pos").alias("x"), F.col("hub").alias("y"))
    pairs = keep(star.where(_possible(t)).select(F.col("y.doc").alias("a"), F.col("x.doc").alias("b")).distinct(), "star")
    heads = keep(members.groupBy("doc").agg(F.max("n").alias("n"), F.collect_set("sig").alias("sigs")), "heads")
    links = _verified(_likely(pairs, heads, light, t), docs, words, t)
    group = components(links)

    # lists that still join several components: all their pairs across them
    placed = members.join(group.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc"))
    mixed = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
                  .where("lo <> hi").select("sig")
    open_lists = keep(placed.join(mixed, "sig", "left_semi"), "open")
    # a long list is dealt out: each part of it meets the whole
    lengths = (open_lists.groupBy("sig").agg(F.ceil(F.count("*") / LIST_PART).cast("int").alias("parts")))
    dealt = open_lists.join(lengths, "sig")
    x = dealt.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).alias("x")
    y = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    rest = (x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.part") == F.col("y.part"))
                   & (F.col("x.component") < F.col("y.component")))
            .where(_possible(t))
            .select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct())
    rest = keep(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    links = links.unionByName(_verified(_likely(rest, heads, light, t), docs, words, t))

    label = components(links).withColumnRenamed("node", "rep")
    named = classes.join(label, "rep", "left").select("key", F.coalesce("component", "rep").alias("component"))
    return (sized.join(named, (sized["key"] == named["key"]) & (F.col("n_shingles") > 0), "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def one_of_each_group(docs: DataFrame, words: int = WORDS, t: Fraction = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` but those linked, directly or not, to a document
    with a smaller id.  Rows that repeat an id are the same document."""
    found = jaccard_components(docs, words, t)
    gone = keep(found.where("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["_id"], "left_anti")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))
