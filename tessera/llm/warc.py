"""WARC archives, dictionary-compressed.

Every archive file begins with a skippable Zstandard frame (magic 0x184D2A5D) that holds the
dictionary; each record follows as a frame of its own, so that one can be read by its place alone. The
dictionary is trained on a bounded sample of the records to be archived.

Files go through Spark's own text writer, whose commit protocol keeps only the output of tasks that
ended well, on any file system. Its line separator is set to an empty skippable frame: decoders pass
over it, so the files are plain ``.zst`` streams.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import hashed_sample, picked, scratch_path, written

# Fixed values of the formats.
DICT_MAGIC, FRAME_MAGIC, SKIP_MAGIC = 0x184D2A5D, 0xFD2FB528, 0x184D2A50
SEPARATOR = struct.pack("<II", SKIP_MAGIC, 0)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this many bytes are never revisits.
LEAST_BYTES = 1000
#: Bounds of the dictionary and of its training sample: records, and bytes of each.
DICT_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 112_640, 1_000, 16_384
#: Payload bytes an archive file holds, about.
FILE_BYTES = 32 << 20
LEVEL = 3
#: Payloads with more than one row in this many of their own are looked up apart: there are fewer of them than this.
HOT = 4096
ID = "urn:x-record:"


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record(page_id: object, url: str | None, payload: bytes | None, digest: str, refers_to: object = None, date: str = "1970-01-01T00:00:00Z", size: int | None = None) -> bytes:
    """A response record, or with ``refers_to`` a revisit that leaves the payload out, of which it needs the ``size`` alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (len(payload) if size is None else size)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{ID}{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; raises ValueError where it isn't whole."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", http)[1])

    def page(value: str | None) -> str | None:
        name = value[1:-1].removeprefix(ID) if value else "none"
        return None if name == "none" else name

    return {
        "page_id": page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "payload_bytes": length,
        "refers_to": page(fields.get("warc-refers-to")),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def dictionary_of(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; with too few samples for that, one with the samples as its content; without any, none."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(magic, whole frame) for each frame of a stream; skippable ones by their own magic."""
    at = 0
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        if magic & 0xFFFFFFF0 == SKIP_MAGIC:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end = at + zstandard.frame_header_size(data[at : at + 18])
            last = 0
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                last, kind, size = block & 1, block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else size)
            if data[at + 4] & 4:
                end += 4
        else:
            raise ValueError("not a Zstandard stream")
        if end > len(data):
            raise ValueError("a frame is cut off")
        yield magic, data[at:end]
        at = end


def records_of(data: bytes) -> Iterator[dict]:
    """The records of one archive file."""
    decoder = zstandard.ZstdDecompressor()
    for k, (magic, frame) in enumerate(frames(memoryview(data))):
        if magic == DICT_MAGIC and not k:
            decoder = zstandard.ZstdDecompressor(dict_data=_dict(bytes(frame[8:])))
        elif magic == FRAME_MAGIC:
            yield parse(decoder.decompress(frame))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> None:
    """Archive every row under ``path``, one record each.

    A text payload is written in UTF-8; null is an empty one. Of rows with equal payloads of ``least``
    bytes or more, that with the largest id is a response and the others revisit it; rows that share
    that id are all responses, and so are rows without any id to refer to; a row with a null id can revisit
    others. Repeated rows are a record each. A null url leaves the header out. Long payloads are whole. Extra columns
    are ignored. No rows: no record.
    """
    spark = pages.sparkSession
    base = picked(pages, id=id_col, url=url_col, payload=payload_col)
    base = base.select("id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    base = base.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.length("payload"))
    known = written(base.select("id", "digest", "bytes"), "digests")  # so that no later step but the writer reads payloads whole
    sums = known.agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    seen = hashed_sample(base.select("id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("part"), "bytes"), SAMPLE_RECORDS, ["id", "url", "bytes"], sums["rows"])
    dictionary = dictionary_of([record(r["id"], r["url"], bytes(r["part"]), hashlib.sha1(r["part"]).hexdigest()) for r in seen])

    # Equal payloads: the largest id of each. The few that many rows share are known to every task, so that their copies need
    # not meet and drop the payload before the shuffle; the others' rows meet by digest.
    first = known.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null")
    first = written(first, "first")
    often = F.col("n") > max(1, sums["rows"] // HOT)
    hot = first.where(often).select(F.col("digest").alias("hot_digest"), F.col("top").alias("hot_top"))  # under HOT rows
    rare = first.where(~often).select(F.col("digest").alias("key"), "top")
    files = max(1, -(-(sums["bytes"] or 0) // file_bytes))
    dealt = base.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    dealt = dealt.withColumn("key", F.when(F.col("hot_digest").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("id", "url").cast("string"))))
    dealt = dealt.select("id", "url", "digest", "bytes", "hot_top", "key", F.when(F.col("hot_top").isNull() | F.col("id").eqNullSafe(F.col("hot_top")), F.col("payload")).alias("payload"))
    dealt = dealt.repartition(max(files, spark.sparkContext.defaultParallelism), "key")
    joined = dealt.join(rare.hint("shuffle_hash"), "key", "left").withColumn("top", F.coalesce("hot_top", "top"))
    revisit = F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    joined = joined.select("id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", F.col("bytes").cast("bigint").alias("bytes"), F.when(revisit, F.col("top")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, head = None, []
        for b in batches:
            if not b.num_rows:
                continue
            if packer is None:
                known = _dict(dictionary)
                if known:
                    known.precompute_compress(level=level)
                    head = [struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary]
                packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
            out, head = head, []
            for page_id, url, payload, digest, size, refers_to in zip(*(b.column(k) for k in range(6)), strict=True):
                raw = record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), size=size.as_py())
                out.append(packer.compress(raw))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = joined.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", SEPARATOR.decode()).text(path)
    _rename(pages.sparkSession, path)


def _rename(spark: SparkSession, path: str) -> None:
    """Give the files their usual ending; a few for each hundred MB."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(folder, name[:-4] + ".warc.zst"))


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records under ``path``: (page_id string, url, record_type, payload_digest, payload_bytes, refers_to string[, payload]).

    A response whose payload doesn't match its digest or length raises an error. An id that was null is null, an empty
    payload is empty. Repeated records stay. Without archives there are no rows.
    """
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"] + ["payload"] * payloads
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                held: list[dict] = []
                size = 0
                for r in records_of(content.as_buffer()):
                    if r["payload"] is not None and (len(r["payload"]), hashlib.sha1(r["payload"]).hexdigest()) != (r["payload_bytes"], r["payload_digest"]):
                        raise ValueError(f"record {r['page_id']} is damaged")
                    size += len(r["payload"] or b"") if payloads else 200
                    held.append(r)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], t) for n, t in zip(names, kinds, strict=False)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], t) for n, t in zip(names, kinds, strict=False)], names=names)

    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to string" + ", payload binary" * payloads
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("content").mapInArrow(run, schema)


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the archives and read them back: (page_id long, payload_bytes, payload_digest, record_type, refers_to long).

    What holds for nulls, ties, repeated rows, no rows and extra columns is said at ``write`` and ``read``.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(pages, path, **options)
    back = read(spark, path, payloads=False)
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))
