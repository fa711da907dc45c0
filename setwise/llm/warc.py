"""WARC archives: written by Spark's text writer, indexed first, read by byte ranges.

* Writing: a record is one line of a text file whose line separator is the blank lines that
  end a WARC record, so the archives can be written to any store that Spark writes to. Which
  records revisit another is found out from digest, id and URL of the pages, and revisits are
  written from these alone. A payload is written where it was read, unless a Bloom filter of
  the revisits names its page. Pages that it names by mistake are listed, and have a filter of
  their own; only payloads that pass both are compared with the list. The filters have at most
  ``MAX_CELLS`` cells: far more revisits let more payloads pass, and the result stays the same.
  No join is by digest once a payload is in it, so many copies meet in no task.
* Index: one pass over the archives gives offset, length, URL and digest of each record.
* Reading: the ranges of the selected records, sorted by offset, are joined where the gap
  between them is small, and each joined range is read at once.

Cases: a null payload is empty, a null URL leaves the header out. Of equal payloads of at
least ``least`` bytes the record with the largest id is the response and the others revisit
it; rows that repeat its id are responses too, as are all rows if no id is known. A null id
is written as an empty header. An empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setwise.llm.common import store, whole
from setwise.llm.exact_dedup import MAX_CELLS, cell_count, hit_cells, with_suspicion
from setwise.session import work_dir

LEAST_BYTES = 1000
RANGE_BYTES = 4 << 20
GAP_BYTES = 64 << 10
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "archive string, offset long, length long, page_id long, url string, record_type string, "
    "payload_digest string, refers_to long"
)
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def captures(pages: DataFrame) -> DataFrame:
    """Pages with their payload (``body``), its ``size`` and ``sha1``."""
    body = whole("html")
    return pages.select("page_id", "url", body.alias("body"), F.octet_length(body).alias("size"), F.sha1(body).alias("sha1"))


def revisiting(slim: DataFrame) -> DataFrame:
    """The captures that repeat a payload, with ``first_id``, the largest id that has it."""
    groups = slim.groupBy("sha1").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    groups = store(groups.where("n > 1 AND first_id IS NOT NULL").select("sha1", "first_id"), "repeated")
    return slim.join(groups, "sha1").where(~F.col("page_id").eqNullSafe(F.col("first_id")))


def _named(rows: DataFrame) -> DataFrame:
    """With ``digest``, what the filters hash: captures that agree in it are both revisits or
    both not."""
    return rows.withColumn("digest", F.concat_ws(":", "sha1", F.coalesce(F.col("page_id").cast("string"), F.lit(""))))


class NameFilter:
    """A Bloom filter of names, at most ``most`` cells, which are broadcast."""

    def __init__(self, names: DataFrame, most: int):
        self.cells = cell_count(names.count(), most=most)
        self.bits = store(hit_cells(names, self.cells), "name_filter")

    def mark(self, rows: DataFrame, column: str) -> DataFrame:
        return with_suspicion(rows, self.bits, self.cells).withColumnRenamed("suspect", column)


def record_name(page_id: Column) -> Column:
    """A record id that depends on the page id only."""
    digits = F.md5(F.coalesce(page_id.cast("string"), F.lit("")))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records(rows: DataFrame, date: str) -> DataFrame:
    """One WARC record per capture, without the blank lines that end it. Those with a
    ``first_id`` are revisits.

    A revisit keeps the HTTP headers of its own capture, and so the length of the payload.
    """
    revisit = F.col("first_id").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _header("Content-Length", F.col("size")), F.lit("\r\n")
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", record_name(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _header("WARC-Refers-To", F.when(revisit, record_name(F.col("first_id")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("X-Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _header("X-Refers-To-Page-Id", F.when(revisit, F.col("first_id"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(
    pages: DataFrame, path: str, least: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z", max_cells: int = MAX_CELLS
) -> None:
    """One archive per task below ``path``."""
    pages = captures(pages)
    slim = _named(store(pages.drop("body").where(F.col("size") >= least), "captures"))
    revisits = store(revisiting(slim), "revisits")
    first = NameFilter(revisits, max_cells)
    mistaken = first.mark(slim, "maybe").where("maybe").join(revisits.select("digest"), "digest", "left_anti")
    mistaken = store(mistaken.select("digest").distinct(), "mistaken")
    second = NameFilter(mistaken, max_cells)

    bodies = first.mark(_named(pages), "maybe").withColumn("maybe", F.col("maybe") & (F.col("size") >= least))
    named = second.mark(bodies.where("maybe"), "likely").where("likely").join(mistaken, "digest", "left_semi")
    responses = bodies.where("NOT maybe").unionByName(named.drop("likely")).withColumn("first_id", F.lit(None))
    columns = ["page_id", "url", "body", "size", "sha1", "first_id"]
    rows = responses.select(columns).unionByName(revisits.withColumn("body", F.lit("")).select(columns))
    records(rows, date).write.option("lineSep", END).text(path)


def _open(archive: str) -> pa.NativeFile:
    system, path = pafs.FileSystem.from_uri(archive)
    return system.open_input_file(path)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if ": " in line)


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _index_of(archive: str, size: int) -> Iterator[tuple]:
    """Walk over the headers of one archive, reading it in blocks."""
    with _open(archive) as file:
        held, at, offset = b"", 0, 0  # the bytes from ``at`` on, and where the record begins
        while offset < size:
            while (found := held.find(b"\r\n\r\n", offset - at)) < 0:
                begin = at + len(held)
                if begin >= size:
                    raise ValueError(f"{archive} breaks off in the record at {offset}")
                held, at = held[offset - at :] + file.read_at(RANGE_BYTES, begin), offset
            fields = _fields(held[offset - at : found])
            length = found + 4 + int(fields["Content-Length"]) - (offset - at)
            yield (
                archive, offset, length, _number(fields["X-Page-Id"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                fields["WARC-Payload-Digest"].split(":")[1], _number(fields.get("X-Refers-To-Page-Id")),
            )
            offset += length + len(END)
            if offset - at > len(held):
                held, at = b"", offset


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: archive, offset, length (without the end), URL, digest, type."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    n = max(1, files.count())

    def walk(batches):
        import pandas as pd

        names = [c.strip().split(" ")[0] for c in INDEX.split(",")]
        for batch in batches:
            for archive, size in zip(batch["path"], batch["length"]):
                rows = pd.DataFrame.from_records(list(_index_of(archive, size)), columns=names)
                yield rows.astype({"page_id": "Int64", "refers_to": "Int64"})

    return store(files.where("length > 0").repartition(n, "path").mapInPandas(walk, INDEX), "index")


def coalesced_ranges(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """Ranges to read: records of an archive in order of offset, together as long as the gap
    is small and the range began less than ``most`` bytes before."""
    order = Window.partitionBy("archive").orderBy("offset")
    end = F.col("offset") + F.col("length")
    last = F.lag(end).over(order)
    block = F.expr(f"offset div {most}")
    fresh = last.isNull() | (F.col("offset") - last > gap) | (block != F.lag(block).over(order))
    rows = index.withColumn("fresh", fresh.cast("int")).withColumn("range", F.sum("fresh").over(order))
    return rows.groupBy("archive", "range").agg(
        F.min("offset").alias("begin"),
        F.max(end).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def _parse(record: bytes) -> tuple:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, kind = fields["WARC-Payload-Digest"].split(":")[1], fields["WARC-Type"]
    size = int(_fields(http)["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    page, first = _number(fields["X-Page-Id"]), _number(fields.get("X-Refers-To-Page-Id"))
    return page, fields.get("WARC-Target-URI"), size, digest, kind, first, payload if kind == "response" else None


def read_records(selected: DataFrame, payloads: bool = True, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records of the rows selected from an index, parsed and checked against their
    digests. A revisit has no payload of its own; ``refers_to`` names the page that has."""
    ranges = coalesced_ranges(selected, gap, most)

    def read(batches):
        import pandas as pd

        names = [c.strip().split(" ")[0] for c in RECORDS.split(",")]
        for batch in batches:
            for archive, begin, end, parts in zip(batch["archive"], batch["begin"], batch["end"], batch["records"]):
                with _open(archive) as file:
                    data = file.read_at(end - begin, begin)
                rows = [_parse(data[p["offset"] - begin : p["offset"] - begin + p["length"]]) for p in parts]
                rows = pd.DataFrame.from_records(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                yield rows if payloads else rows.assign(payload=None)

    return ranges.mapInPandas(read, RECORDS)


def round_trip(pages: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Write archives, index them and read every record back."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(pages, path, max_cells=max_cells)
    return read_records(archive_index(spark, path), payloads=False).drop("payload")
