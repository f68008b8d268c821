"""WARC archives in which equal payloads are stored once: revisit records refer to the response that holds them.

Headers (ids, addresses, digests; no payload) are shuffled by payload digest, which finds the first record of each payload;
every other record of it is joined to that one and becomes a revisit with fresh headers. Payloads only meet the records
that must go without one.

Files are plain WARC 1.1, written by Spark's own text sink (the two line breaks behind a record are its separator), so a
write is committed as a whole, survives lost executors and goes to any store that Spark reaches. ``X-Page-ID`` and
``X-Refers-To-Page-ID`` are extension fields.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import fresh_path, leave_encoder, ship_package, stored

#: About so many bytes of records, before compression, go to one file.
FILE_BYTES = 32 << 20
#: Pages hold no time of capture; WARC wants one.
CAPTURED = "1970-01-01T00:00:00Z"
LINE = "\r\n"
# The profile of a revisit, the digits of base 32 and those of Spark's conv.
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of a SHA-1: four times forty bits, eight digits each."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), CONV_32, BASE_32)


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null: empty), digest and bytes of it; other columns are left behind."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        base32_sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )


RECORD = ("digest", "bytes", "page_id", "url")


def _same(names: tuple[str, ...], mark: str) -> Column:
    match = F.lit(True)
    for name in names:
        match = match & F.col(name).eqNullSafe(F.col(f"{mark}_{name}"))
    return match


def _marked(df: DataFrame, names: tuple[str, ...], mark: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{mark}_{name}" for name in names})


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Revisits with the first record of their payload (first_page_id, first_url), and first records that are repeated whole.

    ``headers`` holds digest, bytes, page_id, url and ``number``, which differs from row to row. The first record of a
    payload has the smallest page_id (missing ones last), then url, then number. Payloads below ``least_bytes`` have no
    revisits. A payload that many records share is reduced within each task before the shuffle, and its revisits are
    an equi-join that adaptive execution can split.
    """
    known = headers.where(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("page_id").isNull(), "page_id", "url", "number")
    first = known.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
    first = first.select(
        F.col("digest").alias("first_digest"),
        F.col("bytes").alias("first_bytes"),
        F.col("first.page_id").alias("first_page_id"),
        F.col("first.url").alias("first_url"),
        F.col("first.number").alias("first_number"),
    )
    joined = known.join(first, _same(("digest", "bytes"), "first"))
    revisits = joined.where("number <> first_number").select(*RECORD, "number", "first_page_id", "first_url")
    revisits = stored(revisits, "revisits")
    whole = revisits.where(_same(("page_id", "url"), "first")).select(*RECORD).distinct()
    return revisits, whole


# ---------------------------------------------------------------- records as text


def record_id(*parts: Column) -> Column:
    """A name-based UUID of some columns."""
    hashed = F.md5(F.to_json(F.array(*(F.coalesce(p.cast("string"), F.lit("")) for p in parts))).cast("binary"))
    digits = [F.substring(hashed, 1, 8), F.substring(hashed, 9, 4), F.concat(F.lit("3"), F.substring(hashed, 14, 3))]
    digits += [F.concat(F.lit("8"), F.substring(hashed, 18, 3)), F.substring(hashed, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *digits), F.lit(">"))


def field(name: str, value: Column) -> Column:
    """A header line; nothing without a value. Line breaks in a value are written as in an address."""
    text = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(LINE)), F.lit(""))


def http_header() -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(LINE * 2),
    )


def record_text(kind: str, own_id: Column, block: Column, date: str, more: list[Column]) -> Column:
    size = F.octet_length(block)
    return F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: {kind}{LINE}"),
        field("WARC-Record-ID", own_id),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(block.cast("binary")))),
        *more,
        field("X-Page-ID", F.col("page_id")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", size),
        F.lit(LINE),
        block,
    )


def _write(records: DataFrame, into: str, per_file: int) -> None:
    writer = records.write.option("lineSep", LINE * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(into)


def write_archives(pages: DataFrame, into: str, least_bytes: int = 0, date: str = CAPTURED) -> str:
    """Write one record a page to ``into``: a response for the first of each payload, revisits of it for the others.

    Null pages are empty payloads. Missing page ids come last and are not named in a record; rows that are equal in every
    column are one response and revisits of it; an empty table gives archives without records.
    """
    records = page_records(pages)
    headers = records.drop("payload").withColumn("number", F.monotonically_increasing_id())
    headers = stored(headers, "page-headers")
    revisits, whole = resolve_revisits(headers, least_bytes)
    size = headers.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    per_file = max(1, FILE_BYTES * size.n // max(1, (size.bytes or 0) + 512 * size.n))

    # Rows with a key of a revisit go without payload, but for one row of each first record that is repeated whole.
    gone = _marked(revisits.select(*RECORD).distinct(), RECORD, "gone")
    responses = records.join(gone, _same(RECORD, "gone"), "left_anti")
    once = records.join(_marked(whole, RECORD, "once"), _same(RECORD, "once"), "left_semi").dropDuplicates(list(RECORD))
    responses = responses.unionByName(once)
    block = F.concat(http_header(), F.col("payload"))
    text = record_text("response", record_id(*(F.col(c) for c in RECORD)), block, date, [])
    _write(responses.select(text.alias("value")), f"{into}/responses", per_file)

    first = [F.col("digest"), F.col("bytes"), F.col("first_page_id"), F.col("first_url")]
    more = [
        field("WARC-Profile", F.lit(IDENTICAL_PAYLOAD)),
        field("WARC-Refers-To", record_id(*first)),
        field("WARC-Refers-To-Target-URI", F.col("first_url")),
        field("WARC-Refers-To-Date", F.lit(date)),
        field("X-Refers-To-Page-ID", F.col("first_page_id")),
    ]
    own = record_id(*(F.col(c) for c in (*RECORD, "number")))
    text = record_text("revisit", own, http_header(), date, more)
    _write(revisits.select(text.alias("value")), f"{into}/revisits", max(1, FILE_BYTES // 1024))
    return into


# ---------------------------------------------------------------- reading


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive; each block ends where its Content-Length says."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as file, io.BufferedReader(file) as stream:
        while line := stream.readline():
            if line == b"\r\n":
                continue
            if not line.startswith(b"WARC/1."):
                raise ValueError(f"a record begins with {line[:20]!r}")
            fields = {}
            while (line := stream.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
                fields[name] = value
            yield fields, stream.read(int(fields["Content-Length"]))


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """page_id, url, record_id, record_type, refers_to (page_id), refers_to_record, payload_bytes, payload_digest, payload.

    Digests of blocks and payloads are checked against the headers. Revisits have the size and digest of the payload they
    refer to, and none of their own. Files are read one a row: they are small by construction.
    """
    ship_package(spark)
    names = ["page_id", "url", "record_id", "record_type", "refers_to", "refers_to_record", "payload_bytes"]
    names += ["payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def digest(data: bytes) -> str:
        return b32encode(hashlib.sha1(data).digest()).decode()

    def whole(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def row(fields: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
            raise ValueError(f"the block of {fields['WARC-Record-ID']} is damaged")
        kind, size = fields["WARC-Type"], len(payload)
        if kind == "response" and digest(payload) != told:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
        if kind == "revisit":
            http = dict(line.split(": ", 1) for line in head.decode("latin-1").split("\r\n")[1:])
            size, payload = int(http["Content-Length"]), None
        out = (whole(fields, "X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], kind)
        out += (whole(fields, "X-Refers-To-Page-ID"), fields.get("WARC-Refers-To"), size, told)
        return (*out, payload if payloads else None)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for fields, block in parsed(content.as_py()):
                    held.append(row(fields, block))
                    size += len(block)
                    if size > 8 << 20 or len(held) >= 10_000:
                        yield made(held)
                        held, size = [], 0
                if held:
                    yield made(held)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz")
    schema = "page_id long, url string, record_id string, record_type string, refers_to long, refers_to_record string, "
    return files.load(folder).select("content").mapInArrow(
        records, schema + "payload_bytes long, payload_digest string, payload binary"
    )


def archive_digests(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages' archives to the shared folder and give what they hold: one row a page."""
    spark = pages.sparkSession
    folder = write_archives(pages, fresh_path(spark, "archives"), least_bytes)
    return read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
