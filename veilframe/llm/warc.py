"""WARC archives with one Zstandard frame for each record and a shared dictionary.

The dictionary is trained on a sample of the records themselves and stands in a skippable frame at
the head of every archive. Archives are written by Spark's own text writer, task by task, through
its commit protocol, to any store that Spark reaches; a lost executor's task is simply run again.
The writer ends each value with a line feed, so each value ends with the header of a skippable frame
of one byte, and the line feed becomes its content: the file is a plain sequence of frames.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.bloom import bloom
from veilframe.llm.common import cut

# Magic numbers of skippable frames, of a dictionary and of any content.
DICTIONARY_FRAME, SKIPPED_FRAME = 0x184D2A5D, 0x184D2A50
LINE_FEED_FRAME = struct.pack("<II", SKIPPED_FRAME, 1)
#: Records that the dictionary is trained on, at most, the bytes of each that are used, from anywhere in it, and its size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8192, 65_536
#: Bytes of an archive; a record that would pass them begins a new one, and only a longer record stands in a longer archive.
ARCHIVE_BYTES = 1 << 26
#: Revisits that are sent to every task as they are, of about 100 bytes each; of more, a filter of so many bits at most.
SENT_REVISITS, FILTER_BITS = 500_000, 1 << 28
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, with the payload's length, and leaves the payload out."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
        head += [f"X-Refers-To-Page: {refers_to}"] if refers_to is not None else []
    head += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too few samples, their raw bytes; empty without any."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record for each row into archives of about ``ARCHIVE_BYTES`` under ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` the one with the largest id is the
    response, the others are revisits of it; shorter payloads are all responses. Rows that repeat an
    id with its payload are all responses. Rows without an id are revisits where a row with one has
    the payload, else responses. A null payload counts as empty; other columns are not looked at.
    """
    rows = _payloads(pages, id_col, url_col, html_col)
    ids = pages.select(F.col(id_col).cast("long").alias("id")).groupBy("id").agg(F.lit(1)).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id")
    slice_ = F.substring("payload", (1 + F.pmod(F.xxhash64("id"), F.greatest(F.octet_length("payload") - SAMPLE_BYTES, F.lit(1)))).cast("int"), F.lit(SAMPLE_BYTES))
    some = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.max(F.struct("url", slice_.alias("payload"))).alias("r")).orderBy("id").collect()
    samples = [record(r["id"], r["r"]["url"], p := bytes(r["r"]["payload"]), base32_digest(p), None, False) for r in some]
    shared = pages.sparkSession.sparkContext.broadcast(train_dictionary(samples))  # at most DICTIONARY_BYTES

    keyed = rows.select("id", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n")).where(F.col("n") >= min_revisit_bytes)
    pairs = keyed.groupBy("id", "sha1").agg(F.lit(1))
    newest = keyed.groupBy("sha1").agg(F.max("id").alias("refers_to"))
    revisits = pairs.join(newest, "sha1").where("refers_to is not null and not (id <=> refers_to)").select(F.col("id").alias("rid"), F.col("sha1").alias("rsha1"), "refers_to")
    rows, revisits = rows.withColumn("sha1", F.sha1("payload")), cut(revisits)
    same = F.col("id").eqNullSafe(F.col("rid")) & (F.col("sha1") == F.col("rsha1"))
    columns = ["id", "url", "payload", "sha1", "refers_to"]
    if (count := revisits.count()) <= SENT_REVISITS:
        rows = rows.join(F.broadcast(revisits), same, "left").select(*columns)
    else:  # payloads of revisits, and of the few that the filter takes for some, meet them by key; all others stay where they are
        marked = _marked(rows, revisits, count)
        rows = marked.where("not maybe").withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
        rows = rows.unionByName(marked.where("maybe").join(revisits, same, "left").select(*columns))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shared.value
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw))
        head = struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw + LINE_FEED_FRAME
        archive, size, no = -1, ARCHIVE_BYTES, 0
        for b in batches:
            out: list[tuple[int, int, bytes]] = []
            for page_id, url, payload, sha1, refers_to in zip(*(c for c in b.columns)):
                to = refers_to.as_py()
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                frame = packer.compress(record(page_id.as_py(), url.as_py(), payload.as_py(), digest, to, to is not None)) + LINE_FEED_FRAME
                if archive < 0 or size + len(frame) + 1 > ARCHIVE_BYTES:
                    archive, size, no = archive + 1, len(head) + 1, no + 1
                    out.append((archive, no, head))
                size, no = size + len(frame) + 1, no + 1  # with the line feed
                out.append((archive, no, frame))
            cols = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary()))], names=["archive", "no", "frame"])

    # a task's archives, each a file of its own; the writer keeps the order in which it gets the frames
    frames = rows.mapInArrow(compress, "archive int, no long, frame binary").sortWithinPartitions("archive", "no")
    frames.select("archive", F.col("frame").cast("string").alias("value")).write.partitionBy("archive").option("lineSep", "\n").text(path)


def _marked(rows: DataFrame, revisits: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``maybe``, true for all revisits and few others."""
    own = revisits.select(F.xxhash64(F.coalesce("rid", F.lit(0)), F.col("rid").isNull(), "rsha1").alias("a"))
    known = rows.sparkSession.sparkContext.broadcast(bloom(own, count, FILTER_BITS))  # FILTER_BITS at most

    @F.pandas_udf("boolean")
    def has(h: pd.Series) -> pd.Series:
        return pd.Series(known.value.has(h.to_numpy().view(np.uint64)))

    return rows.withColumn("maybe", has(F.xxhash64(F.coalesce("id", F.lit(0)), F.col("id").isNull(), "sha1")))


def _fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in x)


def parse(archive: bytes) -> Iterator[tuple]:
    """``page_id, url, record_type, refers_to, payload bytes, digest, payload`` of each record of an archive, in order.

    A response whose payload does not match its digest is an error. A revisit's payload is None.
    """
    raw = b""
    if archive[:4] == struct.pack("<I", DICTIONARY_FRAME):
        size = struct.unpack_from("<I", archive, 4)[0]
        raw = archive[8 : 8 + size]
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)).stream_reader(archive, read_across_frames=True)
    held = b""

    def until(n: int) -> None:
        nonlocal held
        while len(held) < n:
            if not (more := reader.read(max(65_536, n - len(held)))):
                raise ValueError("the archive ends within a record")
            held += more

    while held or (held := reader.read(65_536)):
        while (end := held.find(b"\r\n\r\n")) < 0:
            until(len(held) + 1)
        fields = _fields(held[:end])
        n = int(fields["Content-Length"])
        until(end + 4 + n + 4)
        block, held = held[end + 4 : end + 4 + n], held[end + 8 + n :]
        http, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and (len(payload) != size or base32_digest(payload) != digest):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
        page_id, to = (int(x) if (x := fields.get(k)) else None for k in ("X-Page-ID", "X-Refers-To-Page"))
        yield page_id, fields["WARC-Target-URI"], kind, to, size, digest, payload if kind == "response" else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` and ``payload`` of every record."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"][: 7 if payloads else 6]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)

        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for r in parse(content.as_py()):
                    rows.append(r)
                    size += 200 + len(r[6] or b"") * payloads
                    if size > 1 << 23:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    types = [T.LongType(), T.StringType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(), T.BinaryType()]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
