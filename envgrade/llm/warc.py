"""Op 7: WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Writing is a DataFrame pipeline: records are built as binary columns and written by Spark, one record after the
other, to any file system that Spark writes to. Files are bounded in bytes: records are told apart by the size of
their page, and the larger the pages of a class, the fewer of its records go into one file (about FILE_BYTES, or a
single record that is larger). With gzip every record is a member of its own, so damage loses no other record. Of records with equal payloads of at
least REVISIT_BYTES, the one with the largest page_id carries the payload; the others are revisits.

Reading takes each file whole and walks its records; archives made elsewhere must be cut below the 2 GB that Spark
holds in one value, and one of them is refused with an error, not read in part. A record counts only if its header
parses, its length fits, it ends as records end and its digests agree. After a failed check the reader goes to
the next place where a version line starts and a record passes, and logs the bytes between as a gap. Files of
gzip members are read the same way: of a damaged member the sound beginning counts, and the reader looks for the
next magic number from which a member unpacks.

Rows: a null html is an empty payload; a null url gives a record without target; a null page_id is read back as
null and never refers to another. Repeated rows each give a record; those that share the largest page_id of
their payload are all responses. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import cut, shared_path, table

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 1000
FILE_BYTES = 64 << 20
# Pages up to these sizes, address included, share files; the last class has no bound and a file per record.
CLASSES = (56 << 10, 1 << 20, 16 << 20)
VERSION = b"WARC/1.1\r\n"
ANY_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
END = b"\r\n\r\n"
CHUNK = 1 << 16
# Stands between the members of a file, as the text writer wants something there; it unpacks to nothing.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
GZIP_MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
# Every record of one run carries one date, so that a task run again writes the same bytes.
DATE = "2024-01-01T00:00:00Z"


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")}
    )
    # One row per payload that repeats; it combines map-side. Written down, its size is known to the planner, which
    # keeps the payloads where they are if it is small, and else joins by digest and splits hot payloads.
    chosen = cut(
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest").agg(F.max("page_id").alias("chosen"), F.count("*").alias("copies"))
        .where("copies > 1").select(F.unhex("payload_digest").alias("sha1"), "chosen"),
        "payloads",
    )
    revisit = F.col("page_id") < F.col("chosen")
    return rows.join(chosen, F.unhex("payload_digest") == F.col("sha1"), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("chosen")).alias("refers_to"),
    )


def records(decided: DataFrame) -> DataFrame:
    """The bytes of each record without the line ends that close it, as column ``value``."""
    def urn(c):
        return F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))

    def header(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "")
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")).cast("binary")
    block = F.when(F.col("record_type") == "response", F.concat(http, F.col("payload"))).otherwise(http)
    head = F.concat(
        F.lit(VERSION.decode()),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:null>"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        header("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("block"))),
        header("WARC-Refers-To", urn(F.col("refers_to"))),
        header("WARC-Profile", F.when(F.col("record_type") == "revisit", PROFILE)),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    ).cast("binary")
    return decided.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record, with its closing line ends, as a gzip member."""
    for batch in batches:
        packed = [gzip.compress(v.as_py() + END, mtime=0) for v in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["value"])


def write_warc(pages: DataFrame, path: str, compression: str = "none", url_col: str = "url", html_col: str = "html") -> None:
    """Write a folder of WARC files of bounded bytes; ``compression`` may be "gzip"."""
    if compression not in ("none", "gzip"):
        raise ValueError(f"compression {compression!r} is none of: none, gzip")
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in (url_col, html_col)).cast("long")
    kind = sum((size > bound).cast("int") for bound in CLASSES)
    # At most one number per class. Nearly always there is one class only, and the records are made once.
    present = sorted(r[0] for r in pages.select(kind.alias("kind")).distinct().collect()) or [0]
    # Revisits are decided over all pages, whatever their class.
    decided = decide(pages, url_col=url_col, html_col=html_col)
    made = sum((_made_size() > bound).cast("int") for bound in CLASSES)
    for i, k in enumerate(present):
        rows = records(decided.where(made == k) if len(present) > 1 else decided)
        most = min(RECORDS_PER_FILE, max(1, FILE_BYTES // CLASSES[k])) if k < len(CLASSES) else 1
        # The text writer puts bytes down as they are, and ends every record as the format asks.
        end = END
        if compression == "gzip":
            rows, end = rows.mapInArrow(_members, "value binary"), EMPTY_MEMBER
        out = rows.select(F.col("value").cast("string")).write.mode("append" if i else "errorifexists")
        out = out.option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1"))
        out.option("maxRecordsPerFile", most).text(path)


def _made_size():
    return (F.coalesce(F.octet_length("url"), F.lit(0)) + F.col("payload_bytes")).cast("long")


def _digest_fits(label: bytes | None, data: bytes) -> bool:
    """Whether a digest field, hex or base 32, agrees; no field or another algorithm proves nothing."""
    if not label or not label.lower().startswith(b"sha1:"):
        return True
    value, sha = label[5:].strip(), hashlib.sha1(data)
    return value.lower() == sha.hexdigest().encode() or value.upper() == base64.b32encode(sha.digest())


def read_record(data: bytes, at: int) -> tuple[dict[str, bytes], bytes, int]:
    """Header fields, block and end of the record at a place. Raises ValueError if any check fails."""
    version = ANY_VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    head_end = data.find(END, at)
    if head_end < 0:
        raise ValueError("the header does not end")
    fields: dict[str, bytes] = {}
    for line in data[version.end() : head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line has no colon")
        fields[name.decode("latin-1").lower()] = value.strip()
    if not fields.get("content-length", b"").isdigit() or "warc-type" not in fields:
        raise ValueError("a header field is missing")
    start = head_end + len(END)
    stop = start + int(fields["content-length"])
    if data[stop : stop + len(END)] != END:
        raise ValueError("the record does not end where it says")
    block = data[start:stop]
    if not _digest_fits(fields.get("warc-block-digest"), block):
        raise ValueError("block digest")
    if fields["warc-type"] == b"response":
        payload = block.partition(END)[2]
        if not _digest_fits(fields.get("warc-payload-digest"), payload):
            raise ValueError("payload digest")
    return fields, block, stop + len(END)


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What a gzip member holds, where it ends, and what is wrong with it; a damaged one gives its sound beginning."""
    unpack, parts, next_at = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof and next_at < len(data):
            parts.append(unpack.decompress(data[next_at : next_at + CHUNK]))
            next_at = min(next_at + CHUNK, len(data))
    except zlib.error as wrong:
        return b"".join(parts), at, f"gzip: {wrong}"
    if not unpack.eof:
        return b"".join(parts), at, "the gzip member does not end"
    return b"".join(parts), next_at - len(unpack.unused_data), ""


def _salvage_plain(data: bytes) -> Iterator[tuple[str, int, int, object, object]]:
    at, lost, reason = 0, None, ""
    while at < len(data):
        try:
            fields, block, end = read_record(data, at)
        except ValueError as wrong:
            if lost is None:
                lost, reason = at, str(wrong)
            found = ANY_VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if lost is not None:
            yield "gap", lost, at, reason, None
            lost = None
        yield "record", at, end, fields, block
        at = end
    if lost is not None:
        yield "gap", lost, len(data), reason, None


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object, object]]:
    """What a file holds, in order: ("record", start, end, fields, block) or ("gap", start, end, reason, None).

    In a file of gzip members, records carry the bounds of their member, and so do gaps inside a member.
    """
    if not (data.startswith(GZIP_MAGIC) or (b"WARC/1." not in data[:16] and GZIP_MAGIC in data[:CHUNK])):
        yield from _salvage_plain(data)
        return
    at, lost, reason = 0, None, ""
    while at < len(data):
        inner, end, wrong = _unpack(data, at) if data.startswith(GZIP_MAGIC, at) else (b"", at, "no gzip member")
        if wrong:
            # Records before the damage are whole; the rest is lost up to the next member.
            sound = [x for x in _salvage_plain(inner) if x[0] == "record"]
            if lost is None:
                lost, reason = at, wrong
            found = data.find(GZIP_MAGIC, at + 1)
            end = found if found >= 0 else len(data)
            for _, _, _, fields, block in sound:
                yield "record", at, end, fields, block
        else:
            if lost is not None:
                yield "gap", lost, at, reason, None
                lost = None
            for kind, _, _, what, block in _salvage_plain(inner):
                yield kind, at, end, what, block
        at = end
    if lost is not None:
        yield "gap", lost, len(data), reason, None


RECORD_SCHEMA = (
    "file string, kind string, start long, stop long, reason string, record_type string, page_id long,"
    " refers_to long, target string, payload_bytes long, payload_digest string, payload binary"
)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all files under a path; ``kind`` tells which. Gaps carry their byte range and reason."""
    def page(value: bytes | None) -> int | None:
        number = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">")
        return int(number) if number.removeprefix(b"-").isdigit() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[p.split()[1]] for p in RECORD_SCHEMA.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                file, data, rows, held = file.as_py(), data.as_py(), [], 0
                for kind, start, stop, what, block in salvage(data):
                    if kind == "gap":
                        rows.append((file, kind, start, stop, what, *[None] * 7))
                        continue
                    payload = block.partition(END)[2]
                    response = what["warc-type"] == b"response"
                    size = len(payload) if response else int(what.get("x-payload-length", b"0"))
                    digest = hashlib.sha1(payload).hexdigest() if response else (
                        what.get("warc-payload-digest", b"").removeprefix(b"sha1:").decode("latin-1")
                    )
                    rows.append((
                        file, kind, start, stop, None, what["warc-type"].decode("latin-1"),
                        page(what.get("warc-record-id")), page(what.get("warc-refers-to")),
                        what.get("warc-target-uri", b"").decode("utf-8", "replace") or None,
                        size, digest, payload if payloads and response else None,
                    ))
                    held += len(payload)
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payloads=False).where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = f"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages),
m as (
  select *, max(page_id) over (partition by payload_digest) as chosen from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= {REVISIT_BYTES} and page_id < chosen then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {REVISIT_BYTES} and page_id < chosen then chosen end as refers_to
from m
"""
