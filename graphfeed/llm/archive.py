"""Legacy ARC archives and their conversion to WARC.

An ARC file starts with a ``filedesc`` record that names its version. Each record is a header line of
five (version 1) or ten (version 2) fields, of which the last is the declared length, and that
many bytes. The converter walks a file by these lengths, never by looking for marks in the
content, and writes for each record a WARC record with an identifier, a date, a type and digests
made from what the ARC holds. Of records with equal payloads of a given size the one with the
largest key stays a ``response`` and the others become ``revisit`` records that refer to it.

Files are written by Spark's text sink (a record is a string, the record end the line
separator) and read by its ``binaryFile`` source, so any store Spark reaches will do. A file is
walked as a stream: a task holds the compressed file and one batch of records. Payloads are
never shuffled: which records are revisits is found from digests and brought to the files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphfeed.lineage import scratch_path, stored

# The fields of a header line by version, and the version block of each file.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: ("URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
        "Filename Archive-length"),
}
KEY_HEADER = "X-Record-Key"
MIN_REVISIT_BYTES = 1000
BATCH_BYTES = 8 << 20
ARCHIVE_DATE = "20260101000000"


def _octets(text: Column) -> Column:
    return F.octet_length(text)


def _file_start(version: int, date: str) -> str:
    block = f"{version} 0 archive\n{FIELDS[version]}\n"
    end = f"text/plain {len(block)}" if version == 1 else (
        f"text/plain 200 - - 0 - {len(block)}")
    return f"filedesc://archive 0.0.0.0 {date} {end}\n{block}\n"


def write_arc(pages: DataFrame, path: str, key: str, url: str, body: str,
              date: str = ARCHIVE_DATE) -> None:
    """Write pages as ARC files, one per partition, of version 1 and 2 in turn.

    The content of a record is an HTTP response whose headers carry the key. A null body is
    empty, a null key is left out, a null url is ``about:blank``; white space in a url is
    escaped, since it separates the fields.
    """
    text = F.coalesce(F.col(body).cast("string"), F.lit(""))
    keyed = F.coalesce(F.concat(F.lit(f"{KEY_HEADER}: "), F.col(key).cast("string"), F.lit("\r\n")),
                       F.lit(""))
    content = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        _octets(text).cast("string"), F.lit("\r\n"), keyed, F.lit("\r\n"), text)
    place = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("about:blank")), r"\s", "%20")
    rows = pages.select(content.alias("content"), place.alias("url"),
                        F.monotonically_increasing_id().alias("seq"))
    second = F.shiftright("seq", 33) % 2 == 1
    head = F.concat_ws(
        " ", "url", F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"),
        F.when(second, F.lit("200 - - 0 -")), _octets(F.col("content")).cast("string"))
    start = F.when(F.col("seq").bitwiseAND((1 << 33) - 1) != 0, F.lit("")).when(
        second, F.lit(_file_start(2, date))).otherwise(F.lit(_file_start(1, date)))
    rows.select(F.concat(start, head, F.lit("\n"), "content")).write.option(
        "lineSep", "\n").option("compression", "gzip").text(path)


def _stream(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the unpacked file, header fields, content) of each record but the first.

    The first record's version line says how later header lines are read; a header line whose number of
    fields is that of the other version is read as such. Raises ValueError where a length is
    wrong or the file ends early.
    """
    stream, at, fields = _stream(content), 0, None
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            at += len(line)
            continue
        values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        size = int(values[-1])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record at {at} declares {size} bytes, {len(block)} are there")
        if fields is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an ARC file starts with a filedesc record")
            version = int(block.split(b" ", 1)[0])
            fields = FIELDS[version].split(" ")
        else:
            names = next((f.split(" ") for f in FIELDS.values()
                          if len(f.split(" ")) == len(values)), None)
            if names is None:
                raise ValueError(f"record at {at} has {len(values)} fields")
            yield at, dict(zip(names, values, strict=True)), block
        at += len(line) + size


def _http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with its empty line) and body of an HTTP response; None if it isn't one."""
    if not block.startswith(b"HTTP/"):
        return None
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def _key_of(head: bytes) -> int | None:
    mark = f"\r\n{KEY_HEADER}: ".encode()
    at = head.find(mark)
    return None if at < 0 else int(head[at + len(mark):head.index(b"\r\n", at + 2)])


def _identifier(name: str, at: int) -> str:
    h = hashlib.sha1(f"{name}:{at}".encode()).hexdigest()
    return f"urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


INDEX = pa.schema([
    ("path", pa.string()), ("at", pa.int64()), ("record_id", pa.string()), ("key", pa.int64()),
    ("payload_bytes", pa.int64()), ("digest", pa.string())])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
            name, rows = path.rsplit("/", 1)[-1], []
            for at, _, block in arc_records(content.as_py()):
                parts = _http_parts(block)
                payload = parts[1] if parts else block
                rows.append({
                    "path": path, "at": at, "record_id": _identifier(name, at),
                    "key": _key_of(parts[0]) if parts else None, "payload_bytes": len(payload),
                    "digest": hashlib.sha1(payload).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, INDEX)


def revisits(index: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(path, at, refers_to): the records that repeat another one's payload.

    Payloads are equal if digest and length are. Ties of the largest key go to the largest
    record id; null keys come last.
    """
    large = index.filter(F.col("payload_bytes") >= least)
    first = large.groupBy("digest", "payload_bytes").agg(
        F.max(F.struct("key", "record_id")).alias("_first"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1")
    return (large.join(first, ["digest", "payload_bytes"])
            .filter(F.col("record_id") != F.col("_first.record_id"))
            .select("path", "at", F.col("_first.record_id").alias("refers_to")))


def _warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode("utf-8", "surrogateescape") for k, v in head),
             f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def warc_record(name: str, at: int, fields: dict[str, str], block: bytes,
                refers_to: str | None) -> bytes:
    """The WARC record of an ARC record, without the two line ends that close it.

    An HTTP response becomes ``response``, or ``revisit`` with its head alone; anything else
    becomes ``resource`` with the ARC's own content type.
    """
    parts = _http_parts(block)
    payload = parts[1] if parts else block
    kind = "resource" if parts is None else "response" if refers_to is None else "revisit"
    kept = parts[0] if parts and refers_to is not None else block
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_identifier(name, at)}>"),
            ("WARC-Date", _warc_date(fields["Archive-date"])),
            ("WARC-Target-URI", fields["URL"]), ("WARC-IP-Address", fields["IP-address"]),
            ("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest())),
            ("WARC-Block-Digest", _base32(hashlib.sha1(kept).digest()))]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{refers_to}>")]
    mime = fields["Content-type"] if parts is None else "application/http; msgtype=response"
    return _warc([*head, ("Content-Type", mime)], kept)


def _converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def full(rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    begun = False
    for batch in batches:
        for path, content, again in zip(
                batch["path"].to_pylist(), batch["content"], batch["again"].to_pylist(), strict=True):
            name, rows, held = path.rsplit("/", 1)[-1], [], 0
            refers = {r["at"]: r["refers_to"] for r in again or []}
            if not begun:
                part = TaskContext.get().partitionId()
                rows.append(_warc([
                    ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{_identifier(name, -1 - part)}>"),
                    ("WARC-Date", _warc_date(ARCHIVE_DATE)),
                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                begun = True
            for at, fields, block in arc_records(content.as_py()):
                rows.append(warc_record(name, at, fields, block, refers.get(at)))
                held += len(rows[-1])
                if held >= BATCH_BYTES:
                    yield full(rows)
                    rows, held = [], 0
            yield full(rows)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def convert(spark: SparkSession, arc_path: str, warc_path: str,
            least: int = MIN_REVISIT_BYTES) -> None:
    """Write the WARC files of all ARC files of a folder."""
    index = stored(_files(spark, arc_path).mapInArrow(
        _index, "path string, at long, record_id string, key long, payload_bytes long, digest string"),
        "arc-index")
    # one row per file, with no more entries than the file has records
    again = revisits(index, least).groupBy(F.col("path").alias("_path")).agg(
        F.collect_list(F.struct("at", "refers_to")).alias("again"))
    told = _files(spark, arc_path).join(again, F.col("path") == F.col("_path"), "left")
    (told.select("path", "content", "again").mapInArrow(_converted, "value binary")
     .select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").text(warc_path))


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, walked by the declared lengths."""
    stream = _stream(content)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if len(block) != int(head["Content-Length"]):
            raise ValueError("the file ends inside a record")
        yield head, block


READ = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("key", pa.int64()),
    ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("refers_to", pa.string()), ("intact", pa.bool_())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for head, block in warc_records(content.as_py()):
                if head["WARC-Type"] == "warcinfo":
                    continue
                parts = _http_parts(block)
                payload = parts[1] if parts else block
                told = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                again = head["WARC-Type"] == "revisit"
                rows.append({
                    "record_id": head["WARC-Record-ID"].strip("<>"), "record_type": head["WARC-Type"],
                    "key": _key_of(parts[0]) if parts else None, "uri": head["WARC-Target-URI"],
                    "payload_bytes": None if again else len(payload), "payload_digest": told,
                    "refers_to": head["WARC-Refers-To"].strip("<>") if again else None,
                    "intact": again or hashlib.sha1(payload).hexdigest() == told})
            yield pa.RecordBatch.from_pylist(rows, READ)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files of a folder; ``intact`` says if the payload has its digest.

    A revisit has its payload's digest but not its length, which its response has.
    """
    return _files(spark, path).mapInArrow(
        _read, "record_id string, record_type string, key long, uri string, payload_bytes long, "
        "payload_digest string, refers_to string, intact boolean")


def resolved(records: DataFrame) -> DataFrame:
    """Records with the key and payload length that revisits take from their response."""
    responses = records.filter(F.col("record_type") != "revisit").select(
        F.col("record_id").alias("_id"), F.col("key").alias("refers_key"),
        F.col("payload_bytes").alias("_bytes"))
    return records.join(responses, F.col("refers_to") == F.col("_id"), "left").select(
        "key", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_key", "record_id", "uri", "intact")


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
             least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back, one row per page.

    Repeated rows give records of their own. An empty table gives no records.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key, url, body)
    convert(spark, arc, warc, least)
    return resolved(stored(read_warc(spark, warc), "warc-records"))
