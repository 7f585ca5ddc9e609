"""WARC output and a splittable reader.

Writing. Every task writes its records to one archive file, one gzip member per record,
through the cluster's file system; a file appears under its final name only once it is
complete, so a repeated task leaves no partial archive. Records with equal payloads of at
least `min_bytes` are stored once: the one with the largest id is a `response`, the others
are `revisit` records that name it. Digests are computed natively; only (digest, id) rows
are grouped, with a map-side step, and hot digests do not gather in a task.

Reading. Files are listed with their lengths (no content is read for that) and cut into
byte ranges. A task searches its range for the gzip magic, and validates each candidate by
decoding the member's start: it must inflate to the line of any WARC 1 version and a header
block with a type, an id and a length; field names may be in any case. A member that begins
as a record and lacks one of these is an error, not left out. A range owns the records that start inside it, and reads
on past its end to finish the last one. Candidates inside compressed data fail validation;
and once a member is decoded the search goes on behind it, so payload bytes that look like
a member cannot be taken for one, except in the tail of a record begun in an earlier range,
where the header check decides. Such a tail is deflate data, which would have to contain a
valid gzip member with a WARC header.

Defined cases: null html is an empty payload; equal ids and payloads give equal records;
rows whose ids tie for the largest of a payload are all responses; a null id never
represents a payload and its records are written as responses unless a row with an id
holds the same payload; an empty table gives an empty result. Pages without a column of
addresses, or with a null one, have no target address in their records. Records bear the time
that `write_archives` is given, the same for all, so that repeated tasks write equal bytes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import attach_group_facts, filesystem, shared_folder, stage

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
ANY_VERSION = re.compile(rb"WARC/1\.[0-9]+\r\n")
LEAD = b"WARC/1."
NEEDED = (b"warc-type", b"warc-record-id", b"content-length")
# Fixed value: the profile of revisits by payload digest in WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EXTENSION = ".warc.gz"
RECORDS = "warc_type string, record_id string, refers_to string, payload_digest string, payload_bytes long, payload binary, path string, offset long"


def plan_records(pages: DataFrame, min_bytes: int = 1000, id_col: str = "page_id", body: str = "html", url: str = "url") -> DataFrame:
    """Pages with `_digest`, `_bytes`, `_response` (the id that holds the payload) and `_url`."""
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    narrow = stage(
        pages.select(F.col(id_col).alias("_id"), F.sha1(payload).alias("_digest"), F.octet_length(payload).cast("bigint").alias("_bytes")),
        "warc-digests",
    )
    groups = narrow.groupBy("_digest", "_bytes").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_response"))
    facts = groups.where(F.col("_n") > 1).where(F.col("_bytes") >= min_bytes)
    # Equal rows may repeat; one fact per id and digest keeps the join back one to one.
    per_id = attach_group_facts(narrow.distinct(), facts, ["_digest", "_bytes"], "_n", "_id")
    address = F.col(url).cast("string") if url in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(body), F.lit("")).cast("binary").alias("_payload"), address.alias("_url"))
    rows = rows.withColumn("_digest", F.sha1("_payload")).withColumn("_bytes", F.octet_length("_payload").cast("bigint"))
    # Only revisits need to know more than their own digest.
    revisits = per_id.where("_response <> _id OR (_id IS NULL AND _response IS NOT NULL)").select(
        F.col("_id").alias("_j"), F.col("_digest").alias("_jd"), "_response"
    )
    on = F.col("_id").eqNullSafe(F.col("_j")) & (F.col("_digest") == F.col("_jd"))
    return rows.join(revisits, on, "left").select("_id", "_payload", "_digest", "_bytes", "_response", "_url")


def _record(kind: str, rid: str, refers: str | None, digest: str, size: int, payload: bytes, date: str = "1970-01-01T00:00:00Z", url: str | None = None) -> bytes:
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:row:{rid}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if refers is not None:
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"WARC-Refers-To: <urn:row:{refers}>")
    lines.append(f"Content-Length: {len(payload)}")
    raw = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write planned records below `folder`, dated `date`; returns `(path, records, bytes)` per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(folder)
        files.create_dir(base, recursive=True)
        context = TaskContext.get()
        final = f"{base}/part-{context.partitionId():06d}{EXTENSION}"
        draft = f"{base}/_draft-{context.taskAttemptId()}"
        count = size = 0
        with files.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for row in zip(*[batch.column(c) for c in ("_id", "_payload", "_digest", "_bytes", "_response", "_url")], strict=True):
                    rid, payload, digest, n, response, url = (v.as_py() for v in row)
                    revisit = response is not None and response != rid
                    member = _record(
                        "revisit" if revisit else "response",
                        "" if rid is None else str(rid),
                        str(response) if revisit else None,
                        digest,
                        n,
                        b"" if revisit else payload,
                        date,
                        url,
                    )
                    out.write(member)
                    count, size = count + 1, size + len(member)
        files.move(draft, final)
        yield pa.RecordBatch.from_pydict({"path": [final], "records": [count], "bytes": [size]})

    return records.mapInArrow(run, "path string, records long, bytes long")


def _headers(block: bytes) -> dict[bytes, bytes] | None:
    """The fields of a WARC header block, names in lower case, or None if it is not one."""
    version = ANY_VERSION.match(block)
    if not version:
        return None
    pairs = (line.split(b":", 1) for line in block[version.end() :].split(b"\r\n") if b":" in line)
    fields = {name.strip().lower(): value.strip() for name, value in pairs}
    lacking = [n.decode() for n in NEEDED if n not in fields]
    if lacking:
        raise ValueError(f"a WARC record without {', '.join(lacking)}")
    return fields


class _Member:
    """Inflates one gzip member from a file, in pieces."""

    def __init__(self, source, at: int, piece: int) -> None:
        self.source, self.at, self.piece = source, at, piece
        self.inflate, self.out = zlib.decompressobj(31), bytearray()

    def more(self, max_out: int = 0) -> bool:
        """Decode another piece; False at the member's end."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail
        if not data:
            self.source.seek(self.at)
            data = self.source.read(self.piece)
            self.at += len(data)
        if not data:
            raise EOFError("archive ends inside a record")
        self.out += self.inflate.decompress(data, max_out)
        return True

    def end(self) -> int:
        """File position behind the member."""
        return self.at - len(self.inflate.unused_data)


def _candidate(source, at: int, piece: int) -> tuple[_Member, dict[bytes, bytes], int] | None:
    """Decode the header of the record that may start at `at`."""
    member = _Member(source, at, piece)
    try:
        while (cut := member.out.find(b"\r\n\r\n")) < 0:
            if len(member.out) >= len(LEAD) and not member.out.startswith(LEAD):
                return None
            if len(member.out) > 1 << 20 or not member.more(4096):
                return None
    except (zlib.error, EOFError):
        return None
    fields = _headers(bytes(member.out[:cut]))
    return (member, fields, cut + 4) if fields else None


def scan_range(source, size: int, start: int, end: int, piece: int = 1 << 16) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """`(offset, headers, payload)` of the records starting in `[start, end)`."""
    at = start
    while at < end:
        source.seek(at)
        window = source.read(min(piece, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0 or at + hit >= end:
            at += max(1, len(window) - len(MAGIC) + 1)
            if len(window) < len(MAGIC):
                return
            continue
        at += hit
        found = _candidate(source, at, piece)
        if found is None:
            at += 1
            continue
        member, fields, body = found
        while member.more():
            pass
        length = int(fields[b"content-length"])
        if len(member.out) < body + length:
            raise ValueError(f"record at {at} is shorter than its Content-Length")
        yield at, fields, bytes(member.out[body : body + length])
        at = member.end()


def _name(value: bytes | None) -> str | None:
    return value.decode().removeprefix("<urn:row:").removesuffix(">") if value is not None else None


def read_archives(spark: SparkSession, folder: str, range_bytes: int = 8 << 20) -> DataFrame:
    """Records of the archives below `folder`, read by byte range."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{EXTENSION}")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(folder)
        .select("path", F.col("length").alias("size"))
    )
    ranges = listing.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("start")
    )
    # One range a row, dealt out evenly; a row is a path and two numbers.
    tasks = ranges.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*[batch.column(c).to_pylist() for c in ("path", "size", "start")], strict=True):
                files, place = filesystem(path)
                rows, held = [], 0
                with files.open_input_file(place) as source:
                    for offset, h, payload in scan_range(source, size, start, min(size, start + range_bytes)):
                        digest = h.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
                        rows.append((h[b"warc-type"].decode(), _name(h[b"warc-record-id"]), _name(h.get(b"warc-refers-to")), digest, int(h.get(b"x-payload-length", b"0")), payload, path, offset))
                        held += len(payload)
                        if held > 16 << 20:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return tasks.mapInArrow(run, RECORDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length measured on the payload read back; a revisit's come from its header."""
    for batch in batches:
        kinds, bodies = batch.column("warc_type").to_pylist(), batch.column("payload")
        named, sizes = batch.column("payload_digest").to_pylist(), batch.column("payload_bytes").to_pylist()
        for i, (kind, body) in enumerate(zip(kinds, bodies, strict=True)):
            if kind == "response":
                data = body.as_buffer()
                if (got := hashlib.sha1(data).hexdigest()) != named[i]:
                    raise ValueError(f"payload digest {got} differs from the header's {named[i]}")
                sizes[i] = data.size
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), pa.array(sizes, pa.int64()), pa.array(named, pa.string()), batch.column("warc_type"), batch.column("refers_to")],
            ["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The registered query: write `pages`, read the archives back, one row per record."""
    folder = shared_folder(spark, "warc")
    write_archives(plan_records(pages), folder).agg(F.sum("records")).collect()
    if not _has_files(folder):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    checked = read_archives(spark, folder).mapInArrow(_verify, "record_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("bigint")
    return checked.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def _has_files(folder: str) -> bool:
    files, base = filesystem(folder)
    return files.get_file_info(base).type.name == "Directory"
