"""WARC archives: a writer that stores equal payloads once, and a reader that splits files."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import quoted, shared_dir, small_batches

MAGIC = b"\x1f\x8b\x08"
#: Bytes read, and bytes inflated, at a time.
READ, FEED = 1 << 16, 1 << 14
PAGE_FIELD, LENGTH_FIELD = "WARC-Page-Number", "WARC-Payload-Length"


def _store(uri: str):
    """(file system, path) of a folder that the driver and all executors can open."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record_urn(page: str | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{page}'.encode()).digest())}>"


def member(page: str | None, url: str | None, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One record as a gzip member; a revisit has no block."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = payload if refers_to is None else b""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_urn(page)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), (LENGTH_FIELD, str(len(payload)))]
    fields += [] if page is None else [(PAGE_FIELD, page)]
    fields += [] if url is None else [("WARC-Target-URI", "".join(url.split()))]
    fields += [] if refers_to is None else [("WARC-Refers-To", record_urn(refers_to)), ("WARC-Refers-To-Page-Number", refers_to), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def plan_records(pages: DataFrame, *, id_col: str, url_col: str, body_col: str, min_bytes: int) -> DataFrame:
    """(page, url, body, digest, refers) of pages; refers: the largest id with an equal payload, for all but that page.

    Only digests travel to find the groups; a group as large as the table is counted before the shuffle.
    """
    pages = pages.select(F.col(quoted(id_col)).alias("page"), F.col(quoted(url_col)).cast("string").alias("url"), F.coalesce(F.col(quoted(body_col)).cast("string"), F.lit("")).alias("body"))
    body = F.encode("body", "UTF-8")
    pages = pages.withColumn("digest", F.sha1(body))
    large = pages.filter((F.octet_length(body) >= min_bytes) & F.col("page").isNotNull()).select("page", "digest")
    groups = large.groupBy("digest").agg(F.max("page").alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    refers = large.join(groups, "digest").filter("page <> last").select("page", "digest", F.col("last").alias("refers")).distinct()
    return pages.join(refers, ["page", "digest"], "left")


def write_warc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 1000) -> int:
    """Write a record per row of pages into .warc.gz files under folder (a URI); returns the number.

    Of records with equal payloads of at least min_bytes bytes the one with the largest id is a
    response, and the others are revisits of it. Rows with null ids are responses. A task writes under
    a name of its own attempt and renames at its end, so a task that is run again leaves one file.
    """
    small_batches(pages.sparkSession)
    planned = plan_records(pages, id_col=id_col, url_col=url_col, body_col=body_col, min_bytes=min_bytes)
    rows = planned.select(F.col("page").cast("string").alias("page"), "url", "body", "digest", F.col("refers").cast("string").alias("refers"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        store, path = _store(folder)
        task = TaskContext.get()
        draft = f"{path}/.part-{task.partitionId():06d}-{task.taskAttemptId()}"
        n = 0
        store.create_dir(path, recursive=True)
        with store.open_output_stream(draft, compression=None) as out:
            for frame in frames:
                for page, url, body, digest, refers in zip(frame["page"], frame["url"], frame["body"], frame["digest"], frame["refers"], strict=True):
                    out.write(member(page, url, body.encode(), digest, refers))
                    n += 1
        store.move(draft, f"{path}/part-{task.partitionId():06d}.warc.gz")
        yield pd.DataFrame({"n": [n]})

    return rows.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def members(handle, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, fields, block) of the records that begin in [start, end), in one pass forward from start.

    A place that looks like a gzip member is one if its first bytes inflate to a WARC header; the
    record is then read to its end, past `end` if need be, and the next one looked for from there.
    """
    handle.seek(start)
    held, at = bytearray(), 0  # bytes of the file from `start` on, and the place in them

    def more() -> bool:
        held.extend(data := handle.read(READ))
        return bool(data)

    while start + at < end:
        found = held.find(MAGIC, at)
        if found < 0:
            at = max(at, len(held) - len(MAGIC) + 1)
            if start + at >= end or not more():
                return
            continue
        at = found
        if start + at >= end:
            return
        read = _record(held, at, more)
        if read is None:
            at += 1
            continue
        fields, block, after = read
        yield start + at, fields, block
        del held[:after]
        start, at = start + after, 0


def _record(held: bytearray, at: int, more) -> tuple[dict[str, str], bytes, int] | None:
    """(fields, block, place after it) of the record at `at`; more() appends to held. None: it isn't one."""
    inflate, out = zlib.decompressobj(31), bytearray()
    while not inflate.eof:
        if at >= len(held) and not more():
            return None
        data = bytes(held[at : at + FEED])
        try:
            out += inflate.decompress(data)
        except zlib.error:
            return None
        at += len(data) - len(inflate.unused_data)
        if not b"WARC/1.".startswith(bytes(out[:7])):
            return None
    head, mark, rest = bytes(out).partition(b"\r\n\r\n")
    if not mark:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return fields, rest[: int(fields.get("Content-Length", 0))], at


def read_warc(spark: SparkSession, folder: str, *, split_bytes: int = 8 << 20) -> DataFrame:
    """One row per record under folder: page, url, record_type, payload_bytes, payload_digest, refers, block.

    Spark lists the files and cuts them into byte ranges; each task seeks into its ranges, owns the
    records that begin in them, wherever they end, and reads each byte once, but for the end of a last
    record. payload_digest (hex) of a response is computed from the block as read.
    """
    schema = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers string, block binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _store(folder)
        names = [c.split()[0] for c in schema.split(", ")]
        for frame in frames:
            for name, start, end in frame.itertuples(index=False):
                with store.open_input_file(_store(name)[1]) as handle:
                    rows, held = [], 0
                    for _, fields, block in members(handle, int(start), int(end)):
                        kind = fields["WARC-Type"]
                        digest = hashlib.sha1(block).hexdigest() if kind == "response" else base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        length = len(block) if kind == "response" else int(fields[LENGTH_FIELD])
                        rows.append((fields.get(PAGE_FIELD), fields.get("WARC-Target-URI"), kind, length, digest, fields.get("WARC-Refers-To-Page-Number"), block))
                        held += len(block)
                        if held > 4 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length").filter("length > 0")
    pieces = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    ranges = files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("name"), "length", start)
    ranges = ranges.select("name", "start", F.least(F.col("start") + split_bytes, "length").alias("stop"))
    # one task for each range, up to a number that Spark schedules well
    return ranges.repartition(min(pieces, 10_000)).mapInPandas(run, schema)


def archive_round_trip(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 1000, split_bytes: int = 8 << 20) -> DataFrame:
    """Write pages to archives in the shared folder and read them back: id, payload_bytes, payload_digest, record_type, refers_to, url, block.

    A null body is an empty payload. Other columns of pages are not archived, whatever their names. Rows
    that share an id and a payload are told apart only by being two records. An empty table gives no
    records. A page of any length is one record, compressed and read in a task's memory.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc/{uuid.uuid4().hex}"
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)
    write_warc(pages, folder, id_col=id_col, url_col=url_col, body_col=body_col, min_bytes=min_bytes)
    id_type = pages.schema[id_col].dataType.simpleString()
    back = read_warc(spark, folder, split_bytes=split_bytes)
    return back.select(F.col("page").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast(id_type).alias("refers_to"), "url", "block")
