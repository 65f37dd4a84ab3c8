"""Web archives: writing, reading back, and an external merge of their indexes.

Writing.  Each page is one WARC/1.1 record.  Of pages with equal payloads of ``REVISIT_LEAST`` bytes or more the
one with the smallest id is a ``response`` and the others are ``revisit`` records that name it and have no
payload; smaller payloads are always responses.  Spark's text sink writes the archives (a record's closing blank
lines are its line separator), so they are committed like any other output.  Pages are written by classes of size,
with so many records a file that no file exceeds ``FILE_BYTES`` by more than headers, or else holds one record.

Index.  Reading an archive gives its captures as a run sorted by URL key and time.  All runs together are cut
into ranges of the sort key (URL key, time, id, place), so a hot URL spreads over several ranges by time; each
range, of about ``RANGE_ROWS`` captures at most, is one task that merges its part of the k runs with a loser tree.  Ranges and rows in them are in global
order: the capture history of every URL.

Defined results: a null payload counts as empty; equal rows (same id, same payload) are all responses if the id is
the smallest; pages without id are responses if no page with an id has their payload, else revisits; a null URL has
the key ``-``; spaces and control characters of a URL are percent-encoded in the archive; an empty table gives an
empty result; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens.llm.common import lookup_skew_safe
from connlens.session import checkpoint_dir, materialize, run_folder, ship_package

REVISIT_LEAST = 100
FILE_BYTES = 64 << 20
#: About the most captures of a range, which one task merges.
RANGE_ROWS = 100_000
#: Upper bounds of the classes of payload size; a last class has the larger ones.
SIZE_CLASSES = [4 << 10, 64 << 10, 1 << 20, 16 << 20]
#: The capture time of a page without one: its id in seconds after this moment.
EPOCH = 1_700_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _crlf(*lines) -> Column:
    return F.concat_ws("\r\n", *lines)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time: Column | None = None) -> DataFrame:
    """``value``, each page's WARC record without its closing blank lines, and ``size``, its payload's bytes."""
    body = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"), body.alias("body"),
                        (time if time is not None else F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)), F.lit(10**9)))).alias("time"))
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("size", F.octet_length("body"))
    shared = rows.where(F.col("size") >= REVISIT_LEAST).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("first").isNotNull())
    shared = materialize(shared.withColumnRenamed("digest", "key"), "shared-payloads")
    alone = F.concat_ws(":", F.lit("alone"), F.monotonically_increasing_id())
    keyed = rows.withColumn("key", F.when(F.col("size") >= REVISIT_LEAST, F.col("digest")).otherwise(alone))  # equal small payloads are not in the lookup
    known = lookup_skew_safe(keyed, "key", shared, ["first"], "n", F.concat_ws(":", F.lit("hot"), F.monotonically_increasing_id()))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    uri = F.regexp_replace(F.regexp_replace("url", " ", "%20"), r"[\x00-\x1f\x7f]", "%09")

    def urn(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    http = _crlf(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.col("size")), F.lit(""), F.lit(""))
    block = F.when(again, http).otherwise(F.concat(http, "body"))
    text = lambda name, value: F.concat(F.lit(name), value)  # noqa: E731  null when the value is: concat_ws leaves it out
    head = _crlf(F.lit("WARC/1.1"), F.when(again, "WARC-Type: revisit").otherwise("WARC-Type: response"), text("WARC-Record-ID: ", urn("id")),
                 text("WARC-Date: ", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")), text("WARC-Target-URI: ", uri), text("WARC-Payload-Digest: sha256:", F.col("digest")),
                 F.when(again, text("WARC-Refers-To: ", urn("first"))), F.when(again, text("WARC-Profile: ", F.lit(PROFILE))),
                 F.lit("Content-Type: application/http;msgtype=response"), text("Content-Length: ", F.octet_length(block)), F.lit(""), F.lit(""))
    return known.select(F.concat(head, block).alias("value"), "size")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time: Column | None = None,
          records_per_file: int | None = None) -> None:
    """Write the pages as uncompressed archives into the new folder ``path``.  ``records_per_file`` lowers the
    number of records in a file further."""
    out = records(pages, id_col, url_col, payload_col, time)
    bounds = [-1, *SIZE_CLASSES, 1 << 31]
    sizes = pages.select(F.octet_length(F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))).alias("size"))
    kind = sum((F.when(F.col("size") > b, 1).otherwise(0) for b in bounds[1:-1]), F.lit(0)).alias("k")
    for k in sorted(r.k for r in sizes.select(kind).distinct().collect()) or [0]:
        most = max(1, FILE_BYTES // bounds[k + 1])
        part = out.where(F.col("size").between(bounds[k] + 1, bounds[k + 1])).select("value")
        part.write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", min(most, records_per_file or most)).text(path)


def url_key(url: str | None) -> str:
    """The host's labels from the last to the first, then the path and query, in lower case."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return quote(url.lower(), safe=":/?=&%")
    host = re.sub(r"^www\d*\.", "", host)
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){tail.lower()}"


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(place, length, header fields, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head + 4
        end = start + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut short")
        yield at, end + 4 - at, fields, data[start:end]
        at = end + 4


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


RUN = ["url_key", "time", "id", "file", "place", "length", "record_type", "refers_to", "digest", "payload_bytes"]
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
RUN_SCHEMA = "url_key string, time string, id long, file string, place long, length long, record_type string, refers_to long, digest string, payload_bytes long"


def sort_key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is None, row[2] or 0, row[3], row[4]


def read_runs(spark, path: str) -> DataFrame:
    """The captures in the archives of a folder: each archive's in order of URL key and time.  Digests and sizes are
    those of the payload read; a revisit has no payload and takes its digest from its header.  Written."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for place, length, fields, block in parse(content.as_buffer().to_pybytes()):
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    if kind == "response" and sha256(payload).hexdigest() != digest:
                        raise ValueError(f"wrong payload digest in {file} at byte {place}")
                    rows.append((url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], _page(fields["WARC-Record-ID"]), file, place, length, kind,
                                 _page(fields.get("WARC-Refers-To")), digest, len(payload) if kind == "response" else None))
                rows.sort(key=sort_key)
                for k in range(0, len(rows), 5000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 5000]), _KINDS)], RUN)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return materialize(found.mapInArrow(run, RUN_SCHEMA), "runs")


class LoserTree:
    """Merges sorted runs: a tournament whose inner nodes keep the loser, so the next item costs log2(k) comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.at = runs, key, [0] * len(runs)
        self.size = size = max(1, len(runs))
        self.heads = [key(r[0]) if r else None for r in runs] + [None] * (size - len(runs))
        self.losers = [-1] * size
        for i in range(size):
            self._replay(i, fill=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _replay(self, i: int, fill: bool = False) -> None:
        """Play run ``i`` up to the root; while filling, wait at the first empty node."""
        node = (i + self.size) // 2
        while node:
            other = self.losers[node]
            if other < 0 and fill:
                self.losers[node] = i
                return
            if self._less(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while self.runs:
            i = self.losers[0]
            if self.heads[i] is None:
                return
            run, self.at[i] = self.runs[i], self.at[i] + 1
            yield run[self.at[i] - 1]
            self.heads[i] = self.key(run[self.at[i]]) if self.at[i] < len(run) else None
            self._replay(i)


def merge(runs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The captures of all runs in global order: the columns of the runs, and position (0, 1, ... in that order).
    The result is written; its partitions follow one another in order."""
    spark = runs.sparkSession
    ship_package(spark)
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, list[tuple]] = {}
        part = None
        for batch in batches:
            part = batch.column(len(RUN))[0].as_py() if batch.num_rows else part
            for row in zip(*(c.to_pylist() for c in batch.columns[:len(RUN)])):
                by.setdefault(row[3], []).append(row)
        pieces = [by[f] for f in sorted(by)]
        for piece in pieces:  # a run's rows arrive in order, unless its archive was read by two tasks
            piece.sort(key=sort_key)
        out, at = [], 0
        for row in LoserTree(pieces, sort_key):
            out.append((*row, part, at))
            at += 1
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*_KINDS, pa.int32(), pa.int64()])], [*RUN, "part", "at"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*_KINDS, pa.int32(), pa.int64()])], [*RUN, "part", "at"])

    ranged = runs.repartitionByRange(parts, "url_key", "time", F.col("id").asc_nulls_last(), "file", "place").withColumn("part", F.spark_partition_id())
    merged = materialize(ranged.mapInArrow(run, RUN_SCHEMA + ", part int, at long"), "merged")
    sizes = dict(merged.groupBy("part").count().collect())  # one row a partition
    before, total = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(total).cast("long")]
        total += sizes[p]
    start = F.element_at(F.create_map(*before), F.col("part")) if before else F.lit(0).cast("long")
    return merged.withColumn("position", start + F.col("at")).drop("part", "at")


def report(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time: Column | None = None,
           records_per_file: int | None = None, path: str | None = None) -> DataFrame:
    """Write the pages into archives, read these back and merge their indexes.  One row per page: id, payload_bytes,
    payload_digest, record_type, refers_to, url_key, position, archive, place and length."""
    spark = pages.sparkSession
    if path is None:
        checkpoint_dir(spark)
        path = f"{run_folder(spark)}/archives-{spark.sql('select uuid()').first()[0]}"
    write(pages, path, id_col, url_col, payload_col, time, records_per_file)
    merged = merge(read_runs(spark, path))
    key = lambda page: F.concat_ws(":", "digest", F.col(page))
    wanted = merged.where("record_type = 'revisit'").groupBy(key("refers_to").alias("k")).agg(F.count("*").alias("n"))
    full = merged.where("record_type = 'response'").groupBy(key("id").alias("k")).agg(F.max("payload_bytes").alias("full"))
    named = materialize(wanted.join(full, "k"), "referred")
    rows = merged.withColumn("k", F.when(F.col("record_type") == "revisit", key("refers_to")).otherwise(F.concat_ws(":", F.lit("own"), "position")))
    out = lookup_skew_safe(rows, "k", named, ["full"], "n", F.concat_ws(":", F.lit("hot"), "position"))
    return out.select(F.col("id").alias(id_col), F.coalesce("payload_bytes", "full").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                      "record_type", "refers_to", "url_key", "position", F.col("file").alias("archive"), "place", "length")


REPORT_SQL = r"""
WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest),
u AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www[0-9]*[.]', '') AS host,
             regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS query FROM pages),
k AS (SELECT page_id, array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
             || lower(CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END) AS url_key FROM u)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.payload_bytes >= 100 AND p.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.payload_bytes >= 100 AND p.page_id <> g.first THEN g.first END AS refers_to,
       k.url_key, row_number() OVER (ORDER BY k.url_key, p.page_id) - 1 AS position
FROM p JOIN g USING (payload_digest) JOIN k USING (page_id)
"""
