"""Operator 5: WARC archives with an index written first, read back by coalesced byte ranges.

Archives are real WARC files of bounded size, written in parallel by Spark's text writer: a record
ends with two CRLFs, which serve as the writer's line separator. One task writes one archive, in
the order of page id, so offset and length of every record follow from byte lengths alone; they go
to the index together with URL and digest before any archive is read. Reading selects records in
the index, groups them by archive, sorts and coalesces their byte ranges, and slices the ranges.
An archive is stored gzip-compressed as a whole, which Spark's readers fetch and the task inflates;
offsets count the bytes of the archive itself.

Of records with equal payloads (SHA-1 and length) of at least ``min_bytes``, the one with the
largest page id is a response, the others are revisits without payload that refer to it. A payload
held by a third of all rows is found by a pre-aggregated maximum, and its narrow rows join it
through adaptive skew splitting.

Defined results: null html is an empty payload, a null URL an empty target; a null page id is
written as ``urn:page:`` and never refers or is referred to if another row has the same payload.
Rows with the same id and payload are all responses. Line breaks in a URL become spaces in the
header and keep the URL in the index. An empty table gives empty archives and results.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import shuffle_files_dropped, stored
from footfall.session import scratch_dir

ARCHIVE_BYTES = 8 << 20
GAP = 64 << 10
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_FIELDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload string"
)


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def plan_records(pages: DataFrame, n_archives: int, min_bytes: int = 1000) -> DataFrame:
    """Records with their archive, header, length and payload.

    Which record is a revisit is decided on narrow rows (key, digest, page id). Payloads are dealt
    to the archives once; the decisions are dealt along with them and meet them there.
    """
    payload = F.coalesce("html", F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        payload.alias("payload"),
        F.sha1(F.encode(payload, "UTF-8")).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    key = F.sha1(F.concat_ws("|", F.col("page_id").cast("string"), "payload_digest"))
    base = base.withColumn("key", key).withColumn(
        "archive", F.pmod(F.xxhash64("key"), F.lit(n_archives))
    )
    same = ["payload_digest", "payload_bytes"]
    narrow = base.where(F.col("payload_bytes") >= min_bytes).select("archive", "key", "page_id", *same)
    first = narrow.groupBy(*same).agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    again = narrow.join(first.where("n > 1"), same).where("not page_id <=> holder")
    decided = again.select("archive", "key", "holder").distinct()
    both = base.withColumn("holder", F.lit(None).cast("long")).unionByName(
        decided, allowMissingColumns=True
    )
    together = both.repartition(n_archives, "archive").withColumn(
        "holder", F.max("holder").over(Window.partitionBy("archive", "key"))
    )
    rows = together.where("payload_digest is not null")
    again = F.col("holder").isNotNull()
    typed = rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    body = F.when(again, 0).otherwise(F.lit(len(_HTTP)) + F.col("payload_bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _uri(F.col("page_id"))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z\r\n"),
        line("WARC-Target-URI", target),
        F.when(again, line("WARC-Refers-To", _uri(F.col("holder")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", body.cast("string")),
        F.lit("\r\n"),
    )
    return typed.withColumn("header", header).withColumn(
        "length", F.octet_length("header") + body.cast("long")
    )


def write_archives(pages: DataFrame, root: str, min_bytes: int = 1000) -> DataFrame:
    """Write archives below ``root`` and return their index (archive, offset, length, ...)."""
    total = pages.agg(F.sum(F.octet_length("html"))).collect()[0][0] or 0
    records = plan_records(pages, max(1, -(-total // ARCHIVE_BYTES)), min_bytes)
    # ties are rows alike in every indexed column, so they can change places
    order = ["page_id", "payload_digest", "url"]
    body = F.when(F.col("record_type") == "revisit", "").otherwise(F.concat(F.lit(_HTTP), "payload"))
    bodies = records.sortWithinPartitions("archive", *order).select(
        "archive", F.concat("header", body).alias("value")
    )
    with shuffle_files_dropped(pages.sparkSession):
        bodies.write.partitionBy("archive").text(f"{root}/archives", compression="gzip", lineSep=END)
    before = Window.partitionBy("archive").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    narrow = records.select("archive", "page_id", "url", "payload_digest", "length")
    return narrow.withColumn(
        "offset", F.coalesce(F.sum(F.col("length") + len(END)).over(before), F.lit(0).cast("long"))
    )


def coalesce_ranges(ranges: list[tuple[int, int]], gap: int = GAP) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last + 1) of ranges read at once: sorted (offset, length) merged."""
    out: list[list[int]] = []
    for i, (offset, length) in enumerate(ranges):
        if out and offset - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], offset + length)
            out[-1][3] = i + 1
        else:
            out.append([offset, offset + length, i, i + 1])
    return [tuple(x) for x in out]


def parse_record(data: bytes) -> tuple:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    number = lambda name: int(v) if (v := fields.get(name, "").strip("<>").rpartition(":")[2]) else None
    payload = body.partition(b"\r\n\r\n")[2].decode() if fields["WARC-Type"] == "response" else None
    return (
        number("WARC-Record-ID"),
        fields["WARC-Target-URI"],
        fields["WARC-Type"],
        number("WARC-Refers-To"),
        int(fields["WARC-Payload-Length"]),
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        payload,
    )


def _read(with_payload: bool):
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string())]
    )

    def run(batches):
        for batch in batches:
            contents, places = batch.column("content"), batch.column("places")
            for k in range(batch.num_rows):
                data = memoryview(zlib.decompress(contents[k].as_buffer(), 31))
                ranges = sorted((x["offset"], x["length"]) for x in places[k].as_py())
                rows = []
                for start, end, first, last in coalesce_ranges(ranges):
                    block = data[start:end]
                    for offset, length in ranges[first:last]:
                        rows.append(parse_record(bytes(block[offset - start : offset - start + length])))
                if not with_payload:
                    rows = [(*r[:-1], None) for r in rows]
                yield pa.record_batch(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    return run


def read_archives(
    spark: SparkSession, root: str, selected: DataFrame, with_payload: bool = True, most: bool = False
) -> DataFrame:
    """The ``selected`` rows of an index as records, one read of each archive they touch.

    An archive's index entries are bounded by its size, so a group fits in one task. Few entries
    may be sent to the archives. With ``most``, for selections as large as the index, they always
    meet in a shuffle, so that the plan, and the disk it takes a byte, is the same at every size.
    """
    places = selected.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    if most:
        places = places.hint("merge")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(f"{root}/archives")
        .select(F.regexp_extract("path", r"archive=(\d+)/", 1).cast("long").alias("archive"), "content")
    )
    return files.join(places, "archive").select("content", "places").mapInArrow(
        _read(with_payload), _FIELDS
    )


def round_trip(pages: DataFrame, min_bytes: int = 1000, with_payload: bool = False) -> DataFrame:
    """Write all ``pages`` as archives, then read every record back through the index."""
    spark = pages.sparkSession
    root = scratch_dir(spark, "warc")
    index = stored(write_archives(pages, root, min_bytes), "warc-index")
    return read_archives(spark, root, index, with_payload, most=True)
