"""WARC archives by way of a chunked record table.

Writing: every payload is streamed into chunk rows (record, chunk number, bytes), each with the digest and length
that have been carried so far once the payload ends.  The chunk table is written once.  Rows that end a record say
which payloads are equal; the record of the smallest id is the response, the others revisit it.  Chunks are then
written as WARC/1.1 records: a payload of one chunk is one response record, a longer one is a response segment and
continuation segments (WARC-Segment-Number), so no record is longer than a chunk and its header.

Reading: the archives are read record by record; segments of long payloads are dealt by record, sorted by segment
number and streamed through one running digest, so no payload is ever held whole.  Lengths, segment numbers and
digests are verified; a damaged archive raises.

How record ends are found: Spark's text reader cuts the archive at an empty line followed by a version line.  The
writer ends a chunk early wherever its bytes would look like that, so no record holds the mark inside.

Archives are Spark text files of UTF-8, gzipped as a whole by default.  Equal payloads are compared by SHA-1 and
length.  The hottest payload is split: ids are reduced per (payload, salt) first, and only the salts that occur
meet their first record again.

Results for odd input: a null payload is empty; null ids sort after all others and stay null; of rows that repeat
the smallest id of a payload one is the response, the others revisit that id; payloads of any length and with any
characters, WARC headers included, are read back as written; an empty table gives empty archives and an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.functions.materialize import sized_broadcast
from lapse.llm.common import col, in_tasks
from lapse.session import scratch_folder

CHUNK_BYTES = 64 << 10
BATCH_BYTES = 8 << 20
SALTS = 64
VERSION = "WARC/1.1"
END = "\r\n\r\n"
# What the reader cuts at: the end of a record and the version line of the next one.
MARK = f"{END}{VERSION}\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"


def base32_sha1(digest: bytes) -> str:
    import base64
    return base64.b32encode(digest).decode()  # 20 bytes are 32 characters, without padding


def chunk_end(payload, start: int, size: int) -> int:
    """Where the chunk that begins at ``start`` ends: at most ``size`` bytes on, between characters, and so that the
    written chunk holds no record mark, also not together with what stands before and after it."""
    mark = MARK.encode()
    end = min(start + size, len(payload))
    while end < len(payload) and end > start + 1 and payload[end] & 0xC0 == 0x80:
        end -= 1
    while True:
        found = (END.encode() + bytes(payload[start:end]) + mark).find(mark) - len(END)
        if found >= end - start:
            return end
        end = start + max(found, 0) + 1


def _chunks(batches, size: int) -> Iterator:
    import hashlib

    import pyarrow as pa

    for batch in batches:
        ids, payloads = batch.column("id"), batch.column("payload")
        rows, held = [], 0

        def flush():
            at = pa.array([r[0] for r in rows], pa.int64())
            return pa.record_batch({
                "record": batch.column("record").take(at), "id": ids.take(at), "target": batch.column("target").take(at),
                "chunk": pa.array([r[1] for r in rows], pa.int32()), "data": pa.array([r[2] for r in rows], pa.binary()),
                "total": pa.array([r[3] for r in rows], pa.int64()), "digest": pa.array([r[4] for r in rows], pa.string())})

        for i in range(batch.num_rows):
            buffer = payloads[i].as_buffer()
            payload = memoryview(buffer) if buffer is not None else memoryview(b"")
            running, start, number = hashlib.sha1(), 0, 0
            while True:
                end = chunk_end(payload, start, size)
                data = payload[start:end]
                running.update(data)
                last = end == len(payload)
                rows.append((i, number, bytes(data), end if last else None, base32_sha1(running.digest()) if last else None))
                held += end - start + 64
                if held >= BATCH_BYTES:
                    yield flush()
                    rows, held = [], 0
                if last:
                    break
                start, number = end, number + 1
        if rows:
            yield flush()


def chunk_table(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", target_col: str = "url",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(record, id, target, chunk, data, total, digest): the payloads in chunks; the last chunk of a record has the
    length and the digest of the whole."""
    target = col(target_col).cast("string") if target_col in pages.columns else F.lit(None).cast("string")
    plain = pages.select(F.monotonically_increasing_id().alias("record"), col(id_col).alias("id"), target.alias("target"),
                         F.coalesce(col(payload_col).cast("string").cast("binary"), F.expr("X''")).alias("payload"))
    id_type = plain.schema["id"].dataType.simpleString()
    return in_tasks(plain, partial(_chunks, size=chunk_bytes), f"record long, id {id_type}, target string, chunk int, data binary, total long, digest string")


def revisits(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(record, first_record, first_id) of the records whose payload another record stores."""
    ends = chunks.filter(F.col("digest").isNotNull() & (F.col("total") >= least_bytes)).select(
        "digest", "total", F.pmod(F.xxhash64("record"), F.lit(SALTS)).alias("salt"), "id", "record")
    mine = F.struct(F.col("id").isNull().alias("unnamed"), "id", "record")
    parts = ends.groupBy("digest", "total", "salt").agg(F.min(mine).alias("first"), F.count(F.lit(1)).alias("n"))
    # At most SALTS rows a payload.
    first = parts.groupBy("digest", "total").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
    shared = first.filter("n > 1").select("digest", "total", F.explode("salts").alias("salt"), "first")
    found = ends.join(shared, ["digest", "total", "salt"]).filter(F.col("record") != F.col("first.record"))
    return found.select("record", F.col("first.record").alias("first_record"), F.col("first.id").alias("first_id"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(record: Column, segment: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), record.cast("string"), F.lit(":"), segment.cast("string"), F.lit(">"))


def _name(value: Column) -> Column:
    """An id as one safe word."""
    return F.url_encode(value.cast("string"))


def warc_records(chunks: DataFrame, revisit: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One WARC record per row, as text in the column ``value``; the bytes between records are the sink's."""
    rows = chunks.join(revisit, "record", "left")
    again, last = F.col("first_record").isNotNull(), F.col("digest").isNotNull()
    segment, whole = F.col("chunk") + 1, (F.col("chunk") == 0) & last
    kind = F.when(again, "revisit").when(F.col("chunk") == 0, "response").otherwise("continuation")
    # The HTTP head stands in the first segment; it names the payload's length where that is known by then.
    size = F.when(again | whole, F.col("total"))
    http = F.when(again | (F.col("chunk") == 0), F.concat(F.lit(HTTP_HEAD), _line("Content-Length", size.cast("string")), F.lit("\r\n"))).otherwise("")
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("data").cast("string")))
    plain_target = F.when(F.col("target").rlike(r"^[\x21-\x7E]+$"), F.col("target"))
    target = F.coalesce(plain_target, F.concat(F.lit("urn:page:"), _name(F.col("id"))), F.lit("urn:page"))
    segmented = ~again & ~whole
    first_size = F.lit(len(HTTP_HEAD) + 2).cast("long")  # the HTTP head of a segmented payload
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", _urn(F.col("record"), F.when(again, F.lit(1)).otherwise(segment))),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", target),
        _line("Content-Type", F.when(kind != "continuation", F.lit("application/http; msgtype=response"))),
        _line("WARC-Payload-Digest", F.when(last, F.concat(F.lit("sha1:"), F.col("digest")))),
        _line("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(again, _urn(F.col("first_record"), F.lit(1)))),
        _line("Refers-To-Page", F.when(again, _name(F.col("first_id")))),
        _line("WARC-Segment-Number", F.when(segmented, segment.cast("string"))),
        _line("WARC-Segment-Origin-ID", F.when(segmented & (F.col("chunk") > 0), _urn(F.col("record"), F.lit(1)))),
        _line("WARC-Segment-Total-Length", F.when(segmented & last, (F.col("total") + first_size).cast("string"))),
        _line("Page", _name(F.col("id"))), _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    # A revisit has one record, made from its last chunk, which knows the payload's length and digest.
    return rows.filter(~again | last).select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", target_col: str = "url",
                   least_bytes: int = 0, compression: str = "gzip", chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write ``pages`` as WARC archives in the folder ``path``."""
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc-chunks")
    chunk_table(pages, id_col, payload_col, target_col, chunk_bytes).write.option("compression", "zstd").parquet(folder)
    chunks = spark.read.parquet(folder)
    again = sized_broadcast(revisits(chunks, least_bytes))
    warc_records(chunks, again).write.option("lineSep", END).option("compression", compression).text(path)


PARSED = "record string, segment int, last boolean, page string, kind string, refers_to string, total long, digest string, data binary"


def _segments(batches, keep_data: bool = False) -> Iterator:
    """Parse records; a whole payload is digested here (and passed on with ``keep_data``), segments are passed on."""
    import hashlib

    import pyarrow as pa
    from urllib.parse import unquote_plus

    names = ("record", "segment", "last", "page", "kind", "refers_to", "total", "digest", "data")
    types = (pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())

    def flush(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def lines(head: bytes) -> dict:
        return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n"))}

    for batch in batches:
        rows, held = [], 0
        for i in range(batch.num_rows):
            raw = batch.column("value")[i].as_py()
            head, _, rest = raw.removeprefix(VERSION.encode() + b"\r\n").partition(END.encode())
            if not head.strip():
                continue
            fields = lines(head)
            size = int(fields["content-length"])
            block, tail = rest[:size], rest[size:]
            if len(block) < size or tail not in (b"", END.encode()):
                raise ValueError(f"record {fields.get('warc-record-id')} does not have the {size} bytes it names")
            kind, http = fields["warc-type"], {}
            if kind != "continuation":
                http_head, _, block = block.partition(END.encode())
                http = lines(http_head)
            page, refers_to = (unquote_plus(fields[n]) if n in fields else None for n in ("page", "refers-to-page"))
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            record = fields.get("warc-segment-origin-id", fields["warc-record-id"])
            number = int(fields.get("warc-segment-number", 1))
            if kind == "revisit":
                rows.append((record, 1, True, page, kind, refers_to, int(http["content-length"]), digest, None))
            elif "warc-segment-number" not in fields:
                own = base32_sha1(hashlib.sha1(block).digest())
                if own != digest or int(http["content-length"]) != len(block):
                    raise ValueError(f"record {record} does not have the payload it names")
                rows.append((record, 1, True, page, kind, None, len(block), own, block if keep_data else None))
                held += len(block) if keep_data else 0
            else:
                rows.append((record, number, digest is not None, page, kind, None, None, digest, block))
                held += len(block)
            if held >= BATCH_BYTES:
                yield flush(rows)
                rows, held = [], 0
        if rows:
            yield flush(rows)


def _join_segments(batches) -> Iterator:
    """Rows sorted by record and segment: carry one digest over the segments of a record, one row per record out."""
    import hashlib

    import pyarrow as pa

    record = running = None
    expected = total = 0
    for batch in batches:
        out = []
        plain = (batch.column(c).to_pylist() for c in ("record", "segment", "last", "page", "kind", "refers_to", "total", "digest"))
        for i, (name, number, last, page, kind, refers_to, size, digest) in enumerate(zip(*plain)):
            if not (last and number == 1):
                if number == 1:
                    record, running, expected, total = name, hashlib.sha1(), 1, 0
                if name != record or number != expected:
                    raise ValueError(f"record {name}: segment {number} does not follow")
                data = batch.column("data")[i].as_buffer()
                running.update(data)
                total, expected = total + len(data), expected + 1
                if not last:
                    continue
                size, record = total, None
                if base32_sha1(running.digest()) != digest:
                    raise ValueError(f"record {name} does not have the payload it names")
                kind = "response"
            elif record is not None:
                raise ValueError(f"record {record} has no last segment")
            out.append((page, size, digest, kind, refers_to))
        columns = list(zip(*out)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                              ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    if record is not None:
        raise ValueError(f"record {record} has no last segment")


def _raw_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MARK).text(path).select(F.col("value").cast("binary").alias("value"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to) of every record that ``write_archives`` wrote."""
    parsed = in_tasks(_raw_records(spark, path), _segments, PARSED)
    dealt = parsed.repartition("record").sortWithinPartitions("record", "segment")
    return in_tasks(dealt, _join_segments, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def read_payload_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(page, segment, data): the payloads that the archives store, in chunks; nothing is put together."""
    parsed = in_tasks(_raw_records(spark, path), partial(_segments, keep_data=True), PARSED)
    return parsed.filter("kind <> 'revisit'").select("page", "segment", "data")


def warc_round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", payload_col: str = "html",
                    target_col: str = "url", least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the pages as archives (in the shared checkpoint folder unless ``path`` is given) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_folder(spark, "warc")
    write_archives(pages, path, id_col, payload_col, target_col, least_bytes, chunk_bytes=chunk_bytes)
    id_type = pages.select(col(id_col)).schema[0].dataType
    read = read_archives(spark, path)
    return read.select(F.col("page").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(id_type).alias("refers_to"))
