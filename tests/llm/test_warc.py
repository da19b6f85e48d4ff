import glob
import struct
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from veilframe.llm import queries, warc


def expected(rows, least=0):
    groups = {}
    for i, _, h in rows:
        if i is not None:
            groups[h or ""] = max(i, groups.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = groups.get(h or "")
        again = len(raw) >= least and to is not None and to != i
        out.append((i, len(raw), warc.base32_digest(raw), "revisit" if again else "response", to if again else None))
    return Counter(out)


ROWS = [(i, f"http://x.example/{i}", f"<html>{'text é ' * (i % 9)}</html>") for i in range(200)]
ROWS += [(500, None, None), (501, "http://a b\n", ""), (None, "u", "<html></html>"), (None, "u", "only here"), (7, "again", ROWS[7][2]), (502, "long", "y\r\n\r\n" * 60_000), (502, "long", "y\r\n\r\n" * 60_000)]


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("sha1", F.lit("clash")).repartition(3)
    warc.write_archives(df, f"{tmp_path}/w", min_revisit_bytes=least)
    got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(ROWS, least)
    texts = {(i, warc.base32_digest((h or "").encode())): h or "" for i, _, h in ROWS}
    assert all(bytes(r.payload).decode() == texts[r.page_id, r.payload_digest] for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_frames_by_hand(spark, tmp_path):
    spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    warc.write_archives(spark.read.parquet(f"{tmp_path}/pages.parquet"), f"{tmp_path}/w")
    seen = 0
    for f in glob.glob(f"{tmp_path}/w/*/part-*"):
        data = open(f, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_FRAME
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        at = 8 + size
        while at < len(data):
            magic, size = struct.unpack_from("<II", data, at)
            if magic == warc.SKIPPED_FRAME:
                assert data[at + 8 : at + 8 + size] == b"\n"
                at += 8 + size
                continue
            one = unpack.decompressobj()
            text = one.decompress(data[at:])
            at = len(data) - len(one.unused_data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            seen += 1
    assert seen == len(ROWS)
    got = queries.QUERIES["op10_warc"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == expected(ROWS)


def test_dictionary_helps_and_damage_shows():
    texts = [warc.record(i, f"http://x/{i}", b"<html><head><title>page %d</title></head><body>hello there</body></html>" % i, "D", None, False) for i in range(300)]
    raw = warc.train_dictionary(texts, 4096)
    plain, helped = zstandard.ZstdCompressor(6), zstandard.ZstdCompressor(6, dict_data=zstandard.ZstdCompressionDict(raw))
    assert sum(len(helped.compress(t)) for t in texts) < 0.6 * sum(len(plain.compress(t)) for t in texts)
    with pytest.raises(ValueError):
        list(warc.parse(plain.compress(warc.record(1, "u", b"abc", warc.base32_digest(b"abd"), None, False))))
    with pytest.raises(ValueError):
        list(warc.parse(plain.compress(texts[0][:-6])))
    assert warc.train_dictionary([]) == b""


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(df, f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 0


@pytest.mark.parametrize("sent", [0, 10**6])
def test_archives_roll_over(spark, tmp_path, monkeypatch, sent):
    """Each archive has its own head and closes by bytes, whether revisits are sent to the tasks or joined."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 30_000)
    monkeypatch.setattr(warc, "SENT_REVISITS", sent)
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, f"{tmp_path}/w")
    files = [f for f in glob.glob(f"{tmp_path}/w/*/part-*") if open(f, "rb").read(4)]
    assert len(files) > 1
    assert all(len(data) <= 30_000 or len(list(warc.parse(data))) == 1 for data in (open(f, "rb").read() for f in files))
    assert all(struct.unpack("<I", open(f, "rb").read(4))[0] == warc.DICTIONARY_FRAME for f in files)
    got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(ROWS)


def test_pages_larger_than_an_archive(spark, tmp_path, monkeypatch):
    """No archive grows beyond one such page, so a reader with a small limit a file reads them all."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 20)
    rnd = __import__("random").Random(1)
    rows = [(i, "u", rnd.randbytes(1_500_000).hex()) for i in range(4)] + [(10 + i, "u", f"small {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, f"{tmp_path}/w")
    sizes = sorted(len(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/w/*/part-*"))
    assert len(sizes) >= 5 and sizes[-1] < 2_500_000
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "3000000")
    try:
        got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


def test_payloads_are_shuffled_for_revisits_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SENT_REVISITS", 0)
    rows = [(i, "u", f"page {i // 2 if i < 20 else i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    keyed = df.select(F.col("page_id").alias("id"), F.sha1(F.col("html").cast("binary")).alias("sha1"))
    revisits = keyed.where("id < 20 and id % 2 = 0").select(F.col("id").alias("rid"), F.col("sha1").alias("rsha1"))
    marked = warc._marked(keyed, revisits, 10)
    assert marked.where("maybe").count() < 40 and marked.where("maybe and id < 20 and id % 2 = 0").count() == 10
    warc.write_archives(df, f"{tmp_path}/w")
    got = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)
