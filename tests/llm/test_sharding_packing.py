import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from veilframe.llm import packing, queries, sharding


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))


def test_shards_slots_and_growth(spark):
    rows = [(i, f"text {i % 7} é") for i in range(3000)] + [(None, None), (None, ""), (-5, None), (7, "text 0 é"), (7, "text 0 é")]
    got = sharding.assign_shards(docs(spark, rows), [1.0] * 40, [1.0] * 41).collect()
    assert len(got) == len(rows)
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add(r.shard) if r.doc_id is not None else None
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_id.values())
    texts = {d: t or "" for d, t in rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            raw = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    moved = sum(r.grown_shard == 40 for r in got)
    assert 30 < moved < 130


def test_rendezvous_is_the_largest_hash(spark):
    got = spark.range(200).select("id", sharding.rendezvous(F.col("id"), [1.0] * 5).alias("s")).collect()
    le = lambda x: int(x).to_bytes(8, "little")
    for r in got:
        seed = xxhash.xxh64_intdigest(le(r.id), 42)
        assert r.s == max(range(5), key=lambda s: (xxhash.xxh64_intdigest(le(s), seed) >> 11, -s))


def test_weights(spark):
    n = Counter(r.s for r in spark.range(20000).select(sharding.rendezvous(F.col("id"), [1.0, 3.0, 0.0]).alias("s")).collect())
    assert set(n) == {0, 1} and 2.7 < n[1] / n[0] < 3.3
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [0.0])


def test_empty(spark):
    assert sharding.assign_shards(docs(spark, []), [1.0] * 4).count() == 0
    assert packing.pack(docs(spark, [])).count() == 0


def test_sharding_sql(spark, tmp_path):
    rows = [(i, f"text {i % 7} é" * (i % 5)) for i in range(300)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op2_sharding"]).fetchall()
    cols = [c[0] for c in con.description]
    got = queries.QUERIES["op2_sharding"](spark, str(tmp_path)).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def naive(lengths, sizes, cost):
    """One item after another; the size to open chosen by the same rule."""
    bins = []
    lengths = sorted(lengths, reverse=True)
    for i, length in enumerate(lengths):
        fit = [b for b in bins if b[0] - b[1] >= length]
        if fit:
            min(fit, key=lambda b: b[0] - b[1])[1] += length
            continue
        n = sum(x == length for x in lengths[i:])
        spare = max(0, sum(x for x in lengths if x < length) - sum(s - u for s, u in bins))
        fits = {s: min(s // length, n) for s in sizes if s >= length}
        size = min(fits, key=lambda s: (cost(s) / (fits[s] * length + min(s - fits[s] * length, spare)), s))
        bins.append([size, length])
    return sorted((min(s for s in sizes if s >= u), u) for _, u in bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    sizes = [8, 16, 32, 64] if seed % 2 else [64]
    lengths = rng.integers(1, 65, rng.integers(1, 120)).tolist() + [int(rng.integers(1, 65))] * int(rng.integers(0, 60))
    cost = lambda s: s * (1 + s / 100) + 3
    got, seen = defaultdict(lambda: [0, 0, []]), Counter()
    for length, lo, hi, each, first, offset, size, used in packing.plan(Counter(lengths), sizes, cost):
        for r in range(hi - lo):
            b = got[first + r // each]
            b[0], b[1] = size, used
            b[2].append((offset + r % each * length, length))
            seen[length] += 1
    assert seen == Counter(lengths)
    for size, used, places in got.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end == used <= size and not any(used <= s < size for s in sizes)
    if len(sizes) == 1:  # then no choice of a size to open is made for several bins at once
        assert sorted(u for _, u, _ in got.values()) == sorted(u for _, u in naive(lengths, sizes, cost))
    else:
        assert sum(cost(s) for s, _, _ in got.values()) <= 1.1 * sum(cost(s) for s, _ in naive(lengths, sizes, cost))


def test_pack_whole_texts(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "xyz é "[: i % 6] * int(rng.integers(0, 40))) for i in range(300)] + [(1000, "long text " * 90), (1001, None), (1002, "")]
    df = docs(spark, rows)
    packed = packing.pack(df, sizes=(16, 64, 128))
    got = packed.collect()
    bins, parts = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r.bin_id].append((r.bin_offset, r.length, r.bin_size, r.bin_used))
        parts[r.doc_id].append((r.start, r.length))
    assert len(parts) == len(rows)
    for d, t in rows:
        end = 0
        for s, n in sorted(parts[d]):
            assert s == end
            end += n
        assert end == len((t or "").encode()) + 1
    for places in bins.values():
        end = 0
        for offset, n, size, used in sorted(places):
            assert offset == end
            end += n
        assert end == used <= size
    whole = {r.bin_id: bytes(r.tokens) for r in packing.sequences(packed).collect()}
    assert {len(whole[r.bin_id]) == r.bin_size for r in got} == {True}
    texts = {d: (t or "").encode() + b"\0" for d, t in rows}
    for r in got:
        assert whole[r.bin_id][r.bin_offset : r.bin_offset + r.length] == texts[r.doc_id][r.start : r.start + r.length] == bytes(r.tokens)
    twice = packing.pack(docs(spark, [(None, "a"), (None, "a"), (3, "a"), (3, "a")]), sizes=(16,)).collect()
    assert sorted((r.bin_id, r.bin_offset) for r in twice) == [(0, 0), (0, 2), (0, 4), (0, 6)]


def test_written_shards_are_the_assigned_ones(spark, tmp_path):
    """Rows without an id too, which their texts spread; a shard column of the input is replaced."""
    rows = [(None, f"text {i}") for i in range(300)] + [(i, None) for i in range(50)] + [(None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    sharding.write_shards(df, [1.0] * 8, f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    want = sharding.assign_shards(df, [1.0] * 8).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {r["shard"]: r["count"] for r in want}
    assert back.where("doc_id is null").groupBy("shard").count().count() == 8


def test_given_lengths_drop_no_row(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (None, -3), (4, 3000)], "doc_id long, n int")
    got = packing.pack(df, length=F.col("n")).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (1, 1), (2, 1), (4, 3000)]
    assert "tokens" not in got[0]


def test_sequences_of_texts_without_or_with_equal_ids(spark):
    """No bytes are lost or mixed up where ids are null or repeated, or a text is many sequences long."""
    texts = ["a", "b", None, "", "é" * 100_000, "a"]
    df = spark.createDataFrame([(None, t) for t in texts] + [(7, t) for t in texts], "doc_id long, text string").withColumn("tokens", F.lit("clash"))
    packed = packing.pack(df)
    parts = [bytes(r.tokens) for r in packed.collect()]
    assert sorted(p for p in parts if len(p) < 16384 and p[:1] not in (b"\xc3", b"\xa9")) == sorted([(t or "").encode() + b"\0" for t in texts if t != texts[4]] * 2)
    assert sum(map(len, parts)) == 2 * sum(len((t or "").encode()) + 1 for t in texts)
    whole = packing.sequences(packed).collect()
    assert sum(bytes(r.tokens).replace(b"\0", b"").__len__() for r in whole) == 2 * sum(len((t or "").encode()) for t in texts)


def test_pack_token_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(1, 999, rng.integers(0, 90)).tolist()) for i in range(200)] + [(900, None), (901, [])]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, ids array<int>"), sizes=(16, 32, 64), tokens=F.col("ids"), pad=-1)
    whole, found = {r.bin_id: r.tokens for r in packing.sequences(packed, pad=-1).collect()}, defaultdict(list)
    for r in packed.collect():
        assert len(whole[r.bin_id]) == r.bin_size and whole[r.bin_id][r.bin_offset : r.bin_offset + r.length] == r.tokens
        found[r.doc_id].append((r.start, r.tokens))
    assert {d: [x for _, p in sorted(ps) for x in p] for d, ps in found.items()} == {d: ids or [-1] for d, ids in rows}
