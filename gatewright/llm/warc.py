"""WARC archives of pages, and their index as a merge of sorted capture runs.

Every page becomes a record of an archive file; of records with the same
payload one is a response and the others revisit it. Reading the archives back,
each task sorts the captures it found: a run. Runs are dealt into ranges of
(URL key, time), as many as keep a range small, and each range merges its slices
of the runs with a tree of losers, which gives capture histories in global order.

Archive files are bounded by bytes and plain, so that an index entry's file and
offset are all that is needed to read one record.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import partitions, ship
from gatewright.llm.url_filter import host_of
from gatewright.session import stored, work_folder

ship(__name__)

# Payloads from this size on are stored once.
SHARED_BYTES = 1000
# Bytes of an archive file (one record more at most), captures of a run and of a range.
FILE_BYTES = 1 << 25
RUN_ROWS = 100_000
RANGE_ROWS = 100_000
SEPARATOR = "\r\n\r\n"
EPOCH = "2020-01-01 00:00:00"
ENTRY = ("urlkey string, ts string, page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, file string, at long")
FIELDS = [f.split()[0] for f in ENTRY.split(", ")]
ARROW = dict(zip(FIELDS, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                          pa.string(), pa.int64())))


def url_key(url):
    """Host with its labels turned round, then path and query: captures of a site stand together."""
    host = host_of(url)
    rest = F.regexp_replace(F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1), F.lit("")), r"[\r\n]", "")
    turned = F.array_join(F.reverse(F.split(F.regexp_replace(host, r"[\r\n]", ""), r"\.")), ",")
    return F.concat(turned, F.lit(")"), rest)


def records(pages: DataFrame) -> DataFrame:
    """``value``: the WARC record of every page, as text.

    Digests are grouped without the payloads; only digests that occur twice join
    back, so that html moves only if those are many. A null html is an empty
    payload; a null URL has no target header; times without a column are
    derived from the id.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), html.alias("html"))
    digest, size = F.sha1(F.col("html")), F.octet_length("html")
    # of pages without an id none can be referred to
    shared = rows.where(size >= SHARED_BYTES).select("page_id", digest.alias("shared")).groupBy("shared").agg(
        F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null")
    shared = stored(shared.select("shared", "holder"), "shared-payloads")
    rows = rows.join(shared, (digest == F.col("shared")) & (size >= SHARED_BYTES), "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(head, F.when(revisit, "").otherwise(F.col("html")))
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + F.pmod(
        F.coalesce("page_id", F.lit(0)), F.lit(365 * 86400))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    target = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: "), when,
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), target), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("holder").cast("string"),
            F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nX-URL-Key: "), url_key(F.coalesce("url", F.lit(""))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    return rows.select(value.alias("value"))


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Archive files of about ``file_bytes`` bytes at most; a longer record has its own.

    Each task writes its records in order and begins a new file, a folder
    ``part=n`` of its own, when one is full.
    """

    def each(batches):
        part, room = 0, file_bytes
        for batch in batches:
            sizes = pc.binary_length(batch.column("value")).to_numpy() + len(SEPARATOR)
            parts = np.empty(len(sizes), np.int32)
            for i, size in enumerate(sizes.tolist()):
                if size > room and room < file_bytes:
                    part, room = part + 1, file_bytes
                parts[i] = part
                room -= size
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(parts)], ["value", "part"])

    records(pages).mapInArrow(each, "value string, part int").write.partitionBy("part").option(
        "lineSep", SEPARATOR).option("compression", "none").text(folder)


def parse_archive(stream):
    """``(offset, headers, payload)`` of the records of a stream, from where it
    stands; one record in memory at a time, offsets count from there."""
    at = 0
    while line := stream.readline():
        size, headers = len(line), {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(": ")
            headers[name] = value
            size += len(line) + 2
        block = stream.read(int(headers["Content-Length"]))
        stream.read(4)
        head, _, payload = block.partition(b"\r\n\r\n")
        headers["HTTP"] = dict(one.split(": ", 1) for one in head.decode("utf-8").split("\r\n")[1:])
        yield at, headers, payload
        at += size + 2 + len(block) + 4


def _page(name: str | None):
    name = name[len("<urn:page:"):-1] if name else ""
    return int(name) if name else None


def entry(file: str, at: int, headers: dict, payload: bytes) -> tuple:
    """The capture's index entry; a response's digest is that of the bytes read."""
    kind = headers["WARC-Type"]
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size, digest = int(headers["HTTP"]["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    return (headers["X-URL-Key"], headers["WARC-Date"], _page(headers["WARC-Record-ID"]), size, digest, kind,
            _page(headers.get("WARC-Refers-To")), file, at)


def order(row: tuple) -> tuple:
    """URL key, time, id (none first), file and place: no two captures are equal."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


def _batch(rows, extra=()):
    columns = list(zip(*rows)) if rows else [()] * (len(FIELDS) + len(extra))
    types = [*ARROW.values(), *(pa.int64() for _ in extra)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*FIELDS, *extra])


def capture_runs(spark, folder: str, run_rows: int = RUN_ROWS) -> DataFrame:
    """The index entries of all archives with ``run`` and ``seq``: each task's
    captures in order, in runs of bounded length."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(folder).select("path", "content")

    def each(batches):
        task, number, held = TaskContext.get().partitionId(), 0, []

        def run():
            held.sort(key=order)
            return _batch([(*row, (task << 32) + number, i) for i, row in enumerate(held)], ("run", "seq"))

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = "/".join(path.split("/")[-2:])  # with the folder of its part
                for at, headers, payload in parse_archive(io.BytesIO(content.as_py())):
                    held.append(entry(name, at, headers, payload))
                    if len(held) == run_rows:
                        yield run()
                        number, held = number + 1, []
        if held:
            yield run()

    return files.mapInArrow(each, f"{ENTRY}, run long, seq long")


class LoserTree:
    """k-way merge: inner nodes hold the losers of their matches, so that after
    each output one path of log k comparisons finds the next winner."""

    def __init__(self, runs: list[list], key):
        self.key, self.runs, self.at = key, runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.heads = [self._head(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _head(self, i):
        return self.key(self.runs[i][self.at[i]]) if self.at[i] < len(self.runs[i]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self):
        while self.heads[self.winner] is not None:
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = self._head(w)
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The entries of all runs in one order over all partitions.

    Ranges are cut by URL key, time, id and place, so a URL with a third of all
    captures spreads over many; there are as many as leave about ``range_rows``
    captures to each, whatever the input. Within a range the slices of the runs
    come back in the order they were sorted in and are merged.
    """
    ranges = max(1, -(-runs.count() // range_rows), partitions(runs.sparkSession))

    def each(batches):
        slices: dict[int, list[tuple]] = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*FIELDS, "run")]
            for *row, run in zip(*columns):
                slices.setdefault(run, []).append(tuple(row))
        held = []
        for row in LoserTree(list(slices.values()), order):
            held.append(row)
            if len(held) == 10_000:
                yield _batch(held)
                held = []
        yield _batch(held)

    ranged = runs.repartitionByRange(ranges, "urlkey", "ts", "page_id", "file", "at").sortWithinPartitions("run", "seq")
    return ranged.mapInArrow(each, ENTRY)


def capture_index(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the archives of ``pages(page_id, url, html)`` to ``folder``, by
    default in the shared work folder, and returns their merged index.

    Of records with equal payloads of at least 1,000 bytes that with the largest
    page_id is the response; rows that repeat this id are responses, too, and
    rows without an id are never referred to. An empty table gives an empty
    index; repeated rows have a record each; other columns are not archived.
    """
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "warc")
    write_archives(pages, folder)
    return merge_runs(stored(capture_runs(spark, folder), "runs"))


def op2_warc_index(spark, sf_dir: str) -> DataFrame:
    return capture_index(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages),
s AS (
  SELECT *, octet_length(b) AS payload_bytes,
         max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM s
"""
