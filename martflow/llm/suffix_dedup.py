"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes when a string of ``MATCH`` bytes around it also starts earlier: in
a document with a smaller id, or earlier in the same one.  Strings never cross
documents.

1. Where a passage of ``MATCH`` bytes repeats, the k-mer of least hash inside
   it repeats too.  One pass over the texts writes for every such anchor the
   run of windows it stands for (a *unit*, about one per 40 bytes).  Anchors
   that occur once cannot lie in a repeat; they drop out here.
2. Units with equal anchor and equal bytes repeat as a whole; all but the first
   are covered.
3. Units with equal anchor but other bytes may match in part.  They are dealt
   out by anchor and arrive in document order.  Each batch gets a suffix array,
   sorted by ``MATCH`` bytes, is merge-scanned against the levels before it, and
   becomes a level itself; levels of equal size merge.  A window found in a
   level, or before itself in its batch, is covered.

Anchors in very many different units (a common line shorter than a match) would
fill one task with them; their windows are compared one by one through a
grouping that adds up before it shuffles.  Texts that equal an earlier one are
covered whole and take no part otherwise.

Null texts are empty; documents shorter than a match keep everything; rows that
repeat id and text get equal results; a row whose id is null, or stands for
another text with a smaller hash as well, is left whole and not looked up; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, keep, read, union_all

MATCH = 100
KMER = 24
#: Bytes hashed together, and the longest piece of a text in one go.
BUFFER, PIECE = 2_000_000, 8_000_000
COUNTERS, MAX_FREQUENT = 1 << 16, 1 << 18
#: An anchor so frequent, or in so many different units, is not brought into one task.
HOT = 10_000
SHARD_BYTES = 4_000_000


def kmer_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all strings of k bytes: polynomials joined by doubling."""
    base, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    n = len(b) - k + 1
    out, length = np.zeros(n, np.uint64), 0
    block, size = b.astype(np.uint64) + np.uint64(1), 1
    while True:
        if k & size:
            out = out * np.uint64(pow(base, size, mask + 1)) + block[length:length + n]
            length += size
        if size * 2 > k:
            break
        block = block[:-size] * np.uint64(pow(base, size, mask + 1)) + block[size:]
        size *= 2
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


def units(pieces: list[bytes], match: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Of all pieces: index of the piece, first window, anchor's offset from
    it, further windows, and the anchor's hash."""
    b = np.frombuffer(b"".join(pieces), np.uint8)
    if len(b) < match:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.int64),)
    h = kmer_hashes(b, kmer)
    place = np.uint64((1 << 24) - 1)
    least = sliding_min((h & ~place) | np.arange(len(h), dtype=np.uint64), match - kmer + 1)
    anchor = (least & place).astype(np.int64)       # of each window
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(anchor)]
    window = np.nonzero(np.arange(len(anchor)) + match <= ends[piece])[0]
    if not len(window):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.int64),)
    anchor, piece = anchor[window], piece[window]
    first = np.nonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])]))[0]
    last = np.concatenate([first[1:], [len(window)]]) - 1
    start = window[first]
    return (piece[first], start - (ends - sizes)[piece[first]], anchor[first] - start,
            window[last] - start, h[anchor[first]].view(np.int64))


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def text_key(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


FIRST = "kind byte, a long, b long, c long, sha string"


def _first_pass(match: int, kmer: int):
    """Rows of three kinds: 0 a document (id, bytes, key of its text, digest),
    2 a unit (anchor, key of its text, place), 1 an anchor the task met often
    (anchor, count).  Equal texts in one task give units once, whichever copy
    the task meets first."""
    def batch_of(kind: int, a, b, c, sha=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind), pa.int8()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             pa.array(c, pa.int64()), pa.array(sha if sha is not None else [None] * len(a), pa.string())],
            names=["kind", "a", "b", "c", "sha"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        seen, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        met: list[np.ndarray] = []

        def count_met() -> None:
            nonlocal seen, counts
            got, n = np.unique(np.concatenate(met), return_counts=True)
            met.clear()
            every, at = np.unique(np.concatenate([seen, got]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, n]), len(every)).astype(np.int64)
            top = np.argsort(-total, kind="stable")[:COUNTERS]
            top = top[total[top] > 1]
            seen, counts = every[top], total[top]

        def found(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            piece, start, offset, more, anchor = units([p for _, _, p in held], match, kmer)
            met.append(anchor)
            if sum(map(len, met)) > 1_000_000:
                count_met()
            keys = np.array([k for k, _, _ in held], np.int64)[piece]
            begin = np.array([o for _, o, _ in held])[piece] + start
            return batch_of(2, anchor, keys, (begin << 14) | (offset << 7) | more)

        held, size = [], 0
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, batch.column(1)):
                raw = _utf8(text.as_py())
                key = text_key(raw)
                rows.append((doc, len(raw), key, hashlib.sha256(raw).hexdigest()))
                if doc is None or len(raw) < match or key in done:
                    continue
                done.add(key)
                for at in range(0, len(raw) - match + 1, PIECE):
                    held.append((key, at, raw[at:at + PIECE + match - 1]))
                    size += len(held[-1][2])
                    if size >= BUFFER:
                        yield found(held)
                        held, size = [], 0
            if rows:
                yield batch_of(0, *zip(*rows))
        if held:
            yield found(held)
        if met:
            count_met()
        if len(seen):
            yield batch_of(1, seen, counts, np.zeros(len(seen)))
    return run


UNITS = "anchor long, content long, doc long, start long, n int, bytes binary"


def _cut(match: int):
    """Bytes and their hash for the places of each document; of equal units in
    a task only the first carries its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            docs, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            lists = batch.column(3)
            bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            anchor, place = (lists.flatten().field(c).to_numpy() for c in ("anchor", "place"))
            anchors, starts, sizes = anchor.tolist(), (place >> 14).tolist(), (match + (place & 127)).tolist()
            contents, pieces, kept = [], [], []
            for i, text in enumerate(batch.column(1)):
                raw = _utf8(text.as_py())
                if text_key(raw) != keys[i]:
                    continue
                for j in range(bounds[i], bounds[i + 1]):
                    piece = raw[starts[j]:starts[j] + sizes[j]]
                    if len(piece) < sizes[j]:
                        continue
                    content = text_key(piece)
                    unit = (anchors[j], content)
                    if unit in sent:
                        piece = None
                    else:
                        sent.add(unit)
                    contents.append(content)
                    pieces.append(piece)
                    kept.append(j)
            kept = np.array(kept, np.int64)
            doc = np.repeat(np.array(docs, np.int64), np.diff(bounds))[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[kept], pa.int64()), pa.array(contents, pa.int64()), pa.array(doc, pa.int64()),
                 pa.array((place >> 14)[kept], pa.int64()), pa.array((match + (place & 127))[kept], pa.int32()),
                 pa.array(pieces, pa.binary())], names=["anchor", "content", "doc", "start", "n", "bytes"])
    return run


class Level:
    """Distinct strings of a batch: its text and the sorted places in it."""

    def __init__(self, text: np.ndarray, places: np.ndarray, match: int):
        self.text, self.places, self.match = text, places, match

    def strings(self) -> np.ndarray:
        """The suffixes in order, cut to the length of a match.  All are of one
        length, so numpy's padding cannot make two different ones equal."""
        view = np.lib.stride_tricks.sliding_window_view(self.text, self.match)
        return np.ascontiguousarray(view[self.places]).view(f"S{self.match}").ravel()

    def holds(self, strings: np.ndarray) -> np.ndarray:
        own = self.strings()
        at = np.searchsorted(own, strings)
        at[at == len(own)] = 0
        return own[at] == strings if len(own) else np.zeros(len(strings), bool)

    def merged(self, other: Level) -> Level:
        mine, theirs = self.strings(), other.strings()
        at = np.searchsorted(mine, theirs)
        places = np.insert(self.places, at, other.places + len(self.text))
        return Level(np.concatenate([self.text, other.text]), places, self.match)


class LogIndex:
    """Levels whose sizes fall geometrically; every batch is scanned against
    all of them and then joins the family."""

    def __init__(self, match: int):
        self.match, self.levels = match, []

    def add(self, pieces: list[bytes]) -> np.ndarray:
        """For each window of the pieces, in order, whether it came before."""
        text = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        ends = np.repeat(np.cumsum(sizes), sizes)
        places = np.nonzero(np.arange(len(text)) + self.match <= ends)[0]
        strings = Level(text, places, self.match).strings()
        order = np.argsort(strings, kind="stable")         # the batch's suffix array; equal ones by arrival
        strings = strings[order]
        again = np.concatenate([[False], strings[1:] == strings[:-1]])
        heads = np.nonzero(~again)[0]
        old = np.zeros(len(heads), bool)
        for level in self.levels:
            left = np.nonzero(~old)[0]
            old[left] = level.holds(strings[heads[left]])
        repeated = np.zeros(len(places), bool)
        repeated[order] = again | old[np.cumsum(~again) - 1]
        fresh = places[order[heads[~old]]]
        if len(fresh):
            self.levels.append(Level(text, fresh, self.match))
            while len(self.levels) > 1 and len(self.levels[-2].places) <= 2 * len(self.levels[-1].places):
                last = self.levels.pop()
                self.levels[-1] = self.levels[-1].merged(last)
        return repeated


def _index(match: int):
    """Covered stretches ``doc, begin, end`` of the units of one shard, which
    come in document order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LogIndex(match)
        for batch in batches:
            if not len(batch):
                continue
            doc, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            pieces = batch.column(2).to_pylist()
            windows = np.array([len(p) - match + 1 for p in pieces])
            repeated = index.add(pieces)
            unit = np.repeat(np.arange(len(pieces)), windows)
            place = start[unit] + np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
            hit = np.nonzero(repeated)[0]
            if not len(hit):
                continue
            new = np.concatenate([[True], (unit[hit[1:]] != unit[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)])
            first = np.nonzero(new)[0]
            last = np.concatenate([first[1:], [len(hit)]]) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[unit[hit[first]]]), pa.array(place[hit[first]]), pa.array(place[hit[last]] + match)],
                names=["doc", "begin", "end"])
    return run


def _windows(match: int):
    """Every window of a unit, by a 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(piece) - match + 1
                hashes = [xxhash.xxh3_128_digest(piece[i:i + match]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.binary()), pa.array(np.full(n, doc), pa.int64()),
                     pa.array(np.arange(start, start + n), pa.int64())], names=["hash", "doc", "begin"])
    return run


LEFT = "doc long, n_removed long, n_spans long, kept_sha string"


def _kept(with_text: bool):
    """What is left of each text without its covered stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, key, spans in zip(*(batch.column(i) for i in range(4))):
                raw = _utf8(text.as_py())
                if text_key(raw) != key.as_py():
                    continue
                left, removed, runs, end = [], 0, 0, 0
                for begin, stop in sorted((s["begin"], s["end"]) for s in spans.as_py()):
                    if begin > end or not runs:
                        runs += 1
                        left.append(raw[end:begin])
                        end = begin
                    removed += max(0, stop - end)
                    end = max(end, stop)
                kept = b"".join([*left, raw[end:]])
                out.append((doc.as_py(), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["doc", "n_removed", "n_spans", "kept_sha", "kept"])
    return run


def covered(docs: DataFrame, first: DataFrame, match: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Stretches ``doc, begin, end`` covered by earlier strings, and the
    documents that stand for their text (``doc, key``)."""
    spark = docs.sparkSession
    listed = first.where("kind = 0 and a is not null").select(F.col("a").alias("doc"), F.col("c").alias("key"))
    own = listed.groupBy("doc").agg(F.min("key").alias("key"))
    reps = keep(own.groupBy("key").agg(F.min("doc").alias("doc")), "reps")
    frequent = (first.where("kind = 1").groupBy(F.col("a").alias("anchor")).agg(F.sum("b").alias("n"))
                .where(F.col("n") >= hot).orderBy(F.desc("n"), "anchor").limit(MAX_FREQUENT).select("anchor"))
    frequent = keep(frequent.withColumn("hot", F.lit(True)), "frequent")     # at most MAX_FREQUENT rows
    places = (first.where("kind = 2").select(F.col("a").alias("anchor"), F.col("b").alias("key"), F.col("c").alias("place"))
              .join(F.broadcast(frequent), "anchor", "left"))
    # tasks that met the same text gave the same units: those are one place, no repeat
    same = Window.partitionBy("anchor")
    cold = (places.where("hot is null")
            .withColumn("several", (F.min("key").over(same) < F.max("key").over(same))
                        | (F.min("place").over(same) < F.max("place").over(same)))
            .where("several"))
    members = keep(cold.select("anchor", "key", "place").unionByName(
        places.where("hot").select("anchor", "key", "place")), "members")

    by_text = members.groupBy("key").agg(F.collect_set(F.struct("anchor", "place")).alias("places"))
    wanted = by_text.join(reps, "key").withColumnRenamed("doc", "_id")
    texts = docs.join(wanted, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "key", "places")
    cut = keep(texts.mapInArrow(_cut(match), UNITS), "units")
    forget(members)

    units_ = cut.select("anchor", "content", "doc", "start", "n")
    firsts = keep(units_.groupBy("anchor", "content").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("times")), "firsts")
    again = firsts.where("times > 1").select("anchor", "content", "first")
    whole = keep(units_.join(again, ["anchor", "content"])
                 .where((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start")))
                 .select("doc", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("end")), "whole")

    many = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1")
    partly = firsts.select("anchor", "content", "first").join(many, "anchor")
    text_of = cut.where("bytes is not null").select("anchor", "content", "bytes").dropDuplicates(["anchor", "content"])
    partly = keep(partly.join(text_of, ["anchor", "content"])
                  .select("anchor", "contents", F.col("first.doc").alias("doc"), F.col("first.start").alias("start"),
                          "bytes"), "partly")
    forget(cut, firsts)

    size = partly.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (partly.where(F.col("contents") < hot).repartition(shards, "anchor").sortWithinPartitions("doc", "start")
             .select("doc", "start", "bytes").mapInArrow(_index(match), "doc long, begin long, end long"))
    single = partly.where(F.col("contents") >= hot).select("doc", "start", "bytes").mapInArrow(
        _windows(match), "hash binary, doc long, begin long")
    single = keep(single, "single")
    earliest = single.groupBy("hash").agg(F.min(F.struct("doc", "begin")).alias("first"), F.count("*").alias("times")) \
                     .where("times > 1")
    one_by_one = (single.join(earliest, "hash")
                  .where((F.col("doc") != F.col("first.doc")) | (F.col("begin") != F.col("first.begin")))
                  .select("doc", "begin", (F.col("begin") + match).alias("end")))
    return union_all([whole, keep(found, "found"), one_by_one]), reps


#: Longest match: a unit's places are kept in seven bits each.
LONGEST = 128


def dedup(docs: DataFrame, match: int = MATCH, kmer: int = KMER, hot: int = HOT,
          with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row
    of ``docs (doc_id, text)``.  ``kept`` holds the remaining bytes where some
    were removed (null: all kept; always null without ``with_text``).  ``match`` is
    at most ``LONGEST``."""
    if match > LONGEST:
        raise ValueError(f"match is {match}: at most {LONGEST} bytes")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = keep(docs.mapInArrow(_first_pass(match, kmer), FIRST), "first")
    spans, reps = covered(docs, first, match, hot)
    by_doc = (spans.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
              .join(reps, "doc").withColumnRenamed("doc", "_id"))
    texts = docs.join(keep(by_doc, "spans"), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "key", "spans")
    left = keep(texts.mapInArrow(_kept(with_text), LEFT + ", kept binary"), "left").dropDuplicates(["doc"])

    rows = first.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_bytes"),
                                          F.col("c").alias("key"), "sha")
    own = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("own_key")) \
              .withColumnRenamed("doc_id", "_own")
    every = (rows.join(own, F.col("doc_id") == F.col("_own"), "left")
             .join(reps.withColumnsRenamed({"key": "_key", "doc": "rep"}), F.col("key") == F.col("_key"), "left")
             .join(left, F.col("doc_id") == F.col("doc"), "left"))
    judged = F.coalesce(F.col("key") == F.col("own_key"), F.lit(False))
    copy = judged & (F.col("doc_id") != F.col("rep")) & (F.col("n_bytes") >= match)
    cut = judged & F.col("doc").isNotNull()
    nothing = hashlib.sha256(b"").hexdigest()
    return every.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).when(cut, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).when(cut, F.col("n_spans")).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).when(cut, F.col("kept_sha")).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).when(cut, F.col("kept")).alias("kept"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"), with_text=False).drop("kept")
