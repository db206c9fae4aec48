"""Web archives (WARC 1.1) and their capture index, by an external index merge.

Pages become archive files of gzip members, one record each.  Of pages with
equal payloads the one with the smallest id is a ``response``, the others are
``revisit`` records that refer to it and hold no payload.  A record longer than
``SEGMENT`` bytes goes on in ``continuation`` records.

The index is made from the archives alone.  Every archive file gives one run of
captures, sorted where it is read by URL key, time and id.  Runs are cut at
common splitters, and the slices of a key range are merged by a loser tree, at
most about ``FAN_IN`` runs at a time; with more runs there are several levels.
Ranges cut through the captures of one URL too, so a URL with a third of all
captures is spread over many tasks.  The merged ranges in order are the capture
histories of all URLs in order.

URL key: ASCII letters in lower case, scheme, user, fragment and the ports 80
and 443 dropped, the labels of the host reversed and joined by commas, then
``)``, the path (``/`` if there is none) and the query.  A URL of another form is
its own key without the fragment; a null one has the empty key.

Null payloads count as empty.  Rows with a null id stay: they refer to the
smallest id with their payload, or are responses if there is none.  Rows that
share the smallest id are responses each.  Payloads shorter than ``least`` bytes
are always responses.  An empty table gives no archive and an empty index; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import shared_dir

from .common import forget, keep, read, with_group

#: Longest part of a record in one gzip member.  Under 16 MiB, see `write_archives`.
SEGMENT = 8 << 20
#: A task starts a new archive file once the last one holds so many bytes.
ARCHIVE_BYTES = 64 << 20
FAN_IN = 64
#: Captures of a range, and the largest number of ranges of one merge.
RANGE_ROWS, RANGES = 65_536, 4_096
#: Keys looked at to choose the splitters of one level: so many a range, and in all.
RANGE_SAMPLE, SAMPLE = 64, 65_536
#: Pages hold no time of capture: the query takes this one (2024-01-01 UTC) and
#: a second for each id, starting anew after a year.
FIRST_CAPTURE, YEAR = 1_704_067_200, 365 * 86_400

# The revisit profile of the standard, and the scheme of the ids here.
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:x-page:"

ENTRY = ("url_key string, date string, page_id long, payload_digest string, record_type string, refers_to long, "
         "payload_bytes long, archive string, offset long, length long")


# ---------------------------------------------------------------- writing

def record_id(page_id: int | None) -> bytes:
    return f"<{PAGE}{'none' if page_id is None else page_id}>".encode()


def page_of(identifier: bytes) -> int | None:
    text = identifier.decode().strip("<>").removeprefix(PAGE)
    return None if text == "none" else int(text)


def digest(payload: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(payload).digest())


def _header(fields: list[tuple[bytes, bytes]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n"


def members(page_id: int | None, url: str | None, payload: bytes, captured: str, first: int | None,
            segment: int = SEGMENT) -> Iterator[bytes]:
    """The gzip members of one page's record."""
    revisit = first is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if revisit else http + payload
    common = [(b"WARC-Date", captured.encode())]
    if url is not None:   # a header is one line
        one_line = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        common.append((b"WARC-Target-URI", one_line.encode("utf-8", "replace")))
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    for number, part in enumerate(parts, 1):
        if number == 1:
            own = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", record_id(page_id)),
                   *common, (b"WARC-Payload-Digest", b"sha1:" + digest(payload)),
                   (b"Content-Type", b"application/http;msgtype=response")]
            if revisit:
                own += [(b"WARC-Profile", REVISIT), (b"WARC-Refers-To", record_id(first))]
        else:
            own = [(b"WARC-Type", b"continuation"),
                   (b"WARC-Record-ID", record_id(page_id)[:-1] + b":" + str(number).encode() + b">"), *common,
                   (b"WARC-Segment-Origin-ID", record_id(page_id))]
        if len(parts) > 1:
            own.append((b"WARC-Segment-Number", str(number).encode()))
        if number == len(parts) > 1:
            own.append((b"WARC-Segment-Total-Length", str(len(block)).encode()))
        record = _header([*own, (b"Content-Length", str(len(part)).encode())]) + part + b"\r\n\r\n"
        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        yield gz.compress(record) + gz.flush()


def _writer(segment: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, filled, seq = 0, 0, 0
        for batch in batches:
            rows: list[tuple[int, int, bytes]] = []
            held = 0
            for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "captured", "first")]):
                if filled >= archive_bytes:
                    archive, filled = archive + 1, 0
                for member in members(*row, segment):
                    rows.append((archive, seq, member[:-1]))
                    filled, seq, held = filled + len(member), seq + 1, held + len(member)
                if held >= 16 << 20:
                    yield _members(rows)
                    rows, held = [], 0
            yield _members(rows)
    return run


def _members(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    archive, seq, member = zip(*rows) if rows else ((), (), ())
    return pa.record_batch({"archive": pa.array(archive, pa.int32()), "seq": pa.array(seq, pa.int64()),
                            "member": pa.array(member, pa.binary())})


def write_archives(pages: DataFrame, path: str, captured: Column, least: int = 0, segment: int = SEGMENT,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages (page_id, url, html)`` as archive files under ``path``;
    ``captured`` is the time of capture in seconds since 1970.

    Spark's text writer puts the rows of a task into files, on whatever store
    ``path`` is.  It ends each row with a separator.  A gzip member ends with the
    length of its content in four bytes, the last of them zero under 16 MiB: the
    row is the member without that byte, and the separator is that byte."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), captured.alias("captured"))
    key = F.when(F.length("payload") >= least, F.sha2("payload", 256))
    groups = keep(rows.select(key.alias("key"), "page_id").where("key IS NOT NULL").groupBy("key")
                  .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1 AND first IS NOT NULL"), "payloads")
    told = with_group(rows.withColumn("key", key), groups, "key", "n", ["first"])
    first = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    # ISO time of the day and second, written by SQL
    time = F.date_format(F.timestamp_seconds("captured").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = (told.select("page_id", "url", "payload", time.alias("captured"), first.alias("first"))
           .mapInArrow(_writer(segment, archive_bytes), "archive int, seq long, member binary")
           .sortWithinPartitions("archive", "seq"))
    (out.select("archive", F.col("member").cast("string").alias("value"))
     .write.option("lineSep", "\x00").partitionBy("archive").text(path))
    forget(groups)


# ---------------------------------------------------------------- reading

def read_members(content: memoryview, chunk: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """``offset, length, record`` of each gzip member."""
    at = 0
    while at < len(content):
        gz, start, out = zlib.decompressobj(31), at, []
        while not gz.eof:
            piece = content[at:at + chunk]
            if not len(piece):
                raise EOFError(f"archive ends inside the member at {start}")
            out.append(gz.decompress(piece))
            at += len(piece) - len(gz.unused_data)
        yield start, at - start, b"".join(out)


def parse(record: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Headers, and the block by its Content-Length."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.split(b": ", 1) for line in lines)
    return fields, rest[:int(fields[b"Content-Length"])]


def read_records(content: memoryview) -> Iterator[tuple[int, int, dict[bytes, bytes], bytes]]:
    """``offset, length, headers, block`` of each record, its segments joined."""
    open_: list | None = None
    for offset, length, raw in read_members(content):
        fields, block = parse(raw)
        if fields[b"WARC-Type"] == b"continuation":
            open_[1] += length
            open_[3].append(block)
        else:
            if open_:
                yield open_[0], open_[1], open_[2], b"".join(open_[3])
            open_ = [offset, length, fields, [block]]
    if open_:
        yield open_[0], open_[1], open_[2], b"".join(open_[3])


URL = re.compile(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", re.S)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_key(url: str) -> str:
    low = url.translate(LOWER)
    parts = URL.match(low)
    if not parts:
        return low.partition("#")[0]
    host = re.sub(r":(80|443)?$", "", parts[1].rpartition("@")[2])
    rest = parts[2] if parts[2].startswith("/") else "/" + parts[2]
    return ",".join(reversed(host.split("."))) + ")" + rest


def entry(archive: str, offset: int, length: int, fields: dict[bytes, bytes], block: bytes) -> tuple:
    """A line of the index.  A response is measured again; of a revisit, the
    length stands in its HTTP headers."""
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
    kind = fields[b"WARC-Type"].decode()
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if kind == "response" and (digest(payload) != told or len(payload) != size):
        raise ValueError(f"{archive} at {offset}: the payload is not the one written")
    refers = fields.get(b"WARC-Refers-To")
    return (url_key(fields.get(b"WARC-Target-URI", b"").decode("utf-8", "replace")), fields[b"WARC-Date"].decode(),
            page_of(fields[b"WARC-Record-ID"]), told.decode(), kind, page_of(refers) if refers else None,
            size, archive, offset, length)


def order_key(e: tuple) -> tuple:
    """URL key, time, id (null last), then what tells repeated ids apart."""
    return e[0], e[1], e[2] is None, e[2] or 0, e[3], e[4], e[7], e[8]


ARROW = pa.schema([("url_key", pa.string()), ("date", pa.string()), ("page_id", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload_bytes", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()),
                   ("length", pa.int64())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive file as a sorted run."""
    for batch in batches:
        for run, path, content in zip(batch.column("run").to_pylist(), batch.column("path").to_pylist(),
                                      batch.column("content")):
            name = "/".join(path.rsplit("/", 2)[-2:])
            entries = sorted((entry(name, *r) for r in read_records(memoryview(content.as_buffer()))), key=order_key)
            cols = list(zip(*entries)) or [()] * len(ARROW)
            arrays = [pa.array(c, f.type) for c, f in zip(cols, ARROW)]
            yield pa.record_batch([pa.array([run] * len(entries), pa.int64()),
                                   pa.array(range(len(entries)), pa.int64()), *arrays],
                                  names=["run", "seq", *ARROW.names])


# ---------------------------------------------------------------- merging

class LoserTree:
    """Merges sorted iterators.  An inner node keeps the loser of its match and
    the winner goes on; when the winner's source has moved on, only the matches
    on its way to the top are played again."""

    def __init__(self, sources: list):
        self.sources = [iter(s) for s in sources]
        self.heads = [next(s, None) for s in self.sources]
        k = len(self.sources)
        self.losers, winners = [0] * k, [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = winners[1] if k else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x < y or (x == y and a < b)))

    def __iter__(self) -> Iterator:
        while self.winner is not None and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = next(self.sources[w], None)
            node = (w + len(self.sources)) // 2
            while node:
                if self._beats(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def _keys(batch: pa.RecordBatch | pa.Table) -> list[tuple]:
    return [order_key(e) for e in zip(*[batch.column(c).to_pylist() for c in ARROW.names])]


def _cut(groups: int, splitters: dict[int, list[tuple]]):
    """Runs to blocks: the stretches of a run that lie in one key range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, seq = batch.column("run").to_pylist(), batch.column("seq").to_pylist()
            place = []
            for who, key in zip(owner, _keys(batch)):
                group = who % groups
                place.append((group, bisect_right(splitters.get(group, []), key), who))
            entries = batch.select(ARROW.names)
            out, at = [], 0
            for (group, part, who), rows in itertools.groupby(place):
                n = sum(1 for _ in rows)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, ARROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(entries.slice(at, n))
                out.append((group, part, who, seq[at], sink.getvalue().to_pybytes()))
                at += n
            cols = list(zip(*out)) or [()] * 5
            yield pa.record_batch({"grp": pa.array(cols[0], pa.int64()), "part": pa.array(cols[1], pa.int32()),
                                   "run": pa.array(cols[2], pa.int64()), "seq": pa.array(cols[3], pa.int64()),
                                   "block": pa.array(cols[4], pa.binary())})
    return run


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    """Merge the slices of one key range."""
    group, part = (k.as_py() for k in key)
    table = table.sort_by([("run", "ascending"), ("seq", "ascending")])
    blocks = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in table["block"]]
    starts = [0, *itertools.accumulate(len(b) for b in blocks)]
    places = [[i for _, i in run] for _, run in
              itertools.groupby(zip(table["run"].to_pylist(), range(len(blocks))), key=lambda r: r[0])]

    def source(run: list[int]) -> Iterator[tuple]:
        for i in run:
            yield from zip(_keys(blocks[i]), range(starts[i], starts[i + 1]))

    order = [row for _, row in LoserTree([source(run) for run in places])]
    out = pa.concat_tables(blocks).take(pa.array(order, pa.int64()))
    n = len(order)
    return pa.table([pa.array([group] * n, pa.int64()), pa.array([(part << 40) + i for i in range(n)], pa.int64()),
                     pa.array([part] * n, pa.int32()), *out.columns], names=["run", "seq", "part", *ARROW.names])


def _splitters(runs: DataFrame, groups: int, total: int) -> dict[int, list[tuple]]:
    """Range bounds of each group of runs, from keys chosen by a hash of their
    place: about ``SAMPLE`` keys at most, and so about ``RANGES`` bounds."""
    step = max(1, RANGE_ROWS // RANGE_SAMPLE, -(-total // SAMPLE))
    held = max(RANGE_ROWS, -(-total // RANGES))
    rows = (runs.where(F.pmod(F.xxhash64("run", "seq"), F.lit(step)) == 0)
            .select(F.pmod("run", F.lit(groups)).alias("grp"), *ARROW.names).collect())
    by_group: dict[int, list[tuple]] = {}
    for r in rows:
        by_group.setdefault(r["grp"], []).append(order_key(tuple(r)[1:]))
    every = max(1, held // step)
    return {g: sorted(keys)[every - 1::every] for g, keys in by_group.items()}


def capture_index(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> DataFrame:
    """Every record of the archive files under ``path``: the columns of
    ``ENTRY`` and ``index_position``, from 1 in the order of URL key, time and id."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.xxhash64("path").bitwiseAND(F.lit((1 << 62) - 1)).alias("run"), "path", "content"))
    level = keep(files.mapInArrow(_runs, f"run long, seq long, {ENTRY}"), "runs")
    while True:
        size = level.agg(F.count_distinct("run").alias("runs"), F.count("*").alias("rows")).first()
        groups = max(1, -(-size["runs"] // fan_in))
        # runs of one group are told by the remainder of their number: fan_in of them on average
        cut = level.mapInArrow(_cut(groups, _splitters(level, groups, size["rows"])),
                               "grp long, part int, run long, seq long, block binary")
        merged = keep(cut.groupBy("grp", "part").applyInArrow(
            _merge, f"run long, seq long, part int, {ENTRY}"), "merged")
        forget(level)
        if groups == 1:
            break
        level = merged
    counts = sorted((r["part"], r["count"]) for r in merged.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in counts:      # one entry per range: RANGES at most
        before.append((part, total))
        total += n
    start = spark.createDataFrame(before or [(0, 0)], "part int, before long")
    inside = F.col("seq").bitwiseAND(F.lit((1 << 40) - 1))
    return merged.join(F.broadcast(start), "part").select(
        *ARROW.names, (F.col("before") + inside + 1).alias("index_position"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def op11_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    second = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(YEAR))
    write_archives(read(spark, sf_dir, "pages"), path, F.lit(FIRST_CAPTURE) + second)
    return capture_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                             "url_key", "index_position")


# SHA-1 is 160 bits: eight times five hex digits are eight times four characters.
OP11_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body,
    CAST(floor(date_part('epoch', TIMESTAMP '2024-01-01')) AS BIGINT)
      + ((coalesce(page_id, 0) % {YEAR}) + {YEAR}) % {YEAR} AS second,
    split_part(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '#', 1) AS low
  FROM pages),
h AS (
  SELECT *, sha1(body) AS hex, sha256(body) AS same, octet_length(encode(body)) AS payload_bytes,
    regexp_matches(low, '^(?:[a-z][a-z0-9+.-]*:)?//') AS formed,
    regexp_replace(regexp_replace(regexp_extract(low, '^(?:[a-z][a-z0-9+.-]*:)?//([^/?]*)', 1), '^.*@', ''),
                   ':(80|443)?$', '') AS host,
    regexp_replace(low, '^(?:[a-z][a-z0-9+.-]*:)?//[^/?]*', '') AS rest
  FROM p),
k AS (
  SELECT *, min(page_id) OVER (PARTITION BY same) AS first, count(*) OVER (PARTITION BY same) AS n,
    CASE WHEN formed THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
      || CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END ELSE low END AS url_key,
    array_to_string(list_transform(generate_series(0, 31), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
      AS payload_digest
  FROM h),
t AS (
  SELECT *, CASE WHEN n > 1 AND first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to FROM k)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url_key,
  row_number() OVER (ORDER BY url_key, second, page_id NULLS LAST, payload_digest) AS index_position
FROM t
"""
