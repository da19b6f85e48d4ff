"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import langid, merkle, packing, quality, search, sentencepiece_ids, sharding, simhash, spelling, substrings, toxicity, warc
from veilframe.llm.common import cut, held_out, shared_dir, table
from veilframe.llm.crc_sql import crc32_sql
from veilframe.llm.sharding_sql import sharding_sql

SHARDS = 40
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: How much more than is safe a half of a vantage-point tree is pruned.
ANN_FACTOR = 1.2
#: A letter is left out of a run whose checksum this divides.
SPOIL = 97


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~out)
    return toxicity.scores(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.scores(docs, quality.fit(docs))
    return scored.select("doc_id", "weak_label", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = MODEL_FILE) -> DataFrame:
    """Ids of every text, and the checksum of what they decode to."""
    pieces = sentencepiece_ids.load(model_file)
    back = sentencepiece_ids.decode(sentencepiece_ids.encode(table(spark, sf_dir, "documents"), pieces), pieces)
    return back.select("doc_id", "ids", F.size("ids").alias("n_ids"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(search.usable(F.col("embedding")))
    return rows.select("vec_id", F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("v"))


def _floor(x: Column) -> Column:
    """The whole number below 1024 x as a double; from 2^53 on a double is one, and the largest stand for what lies beyond them."""
    most = 1.7976931348623157e308
    scaled = F.greatest(F.least(1024 * x, F.lit(most)), F.lit(-most))
    return F.when(F.abs(scaled) < 2.0**53, F.floor(F.when(F.abs(scaled) < 2.0**53, scaled)).cast("double")).otherwise(scaled)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores that no long holds are given as the nearest one that does."""
    whole = vectors(spark, sf_dir).select("vec_id", F.transform("v", _floor).alias("v"))
    found = search.exact_top_k(whole, F.col("vec_id") % 100 == 0, 10)
    most = (1 << 63) - 1
    score = F.when(F.col("score") >= 2.0**63, F.lit(most)).when(F.col("score") <= -(2.0**63), F.lit(-most - 1)).otherwise(F.col("score").try_cast("long"))
    return found.select("query_id", "rank", "vec_id", score.alias("score"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = vectors(spark, sf_dir).where(F.exists("v", lambda x: x != 0))
    return search.approximate_top_k(some, F.col("vec_id") % 20 == 0, 20, ANN_FACTOR)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    found = cut(langid.predict(docs, langid.fit(docs.where(~out & F.col("text").isNotNull()))))
    return langid.calibrated(found, found.where(~out)).select("doc_id", out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.read_archives(spark, path, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents; of every third id's text the letters A-Z are lowered and the proof is folded from what results."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    changed = F.when(tampered, merkle.leaf(columns, {"text": lowered}))
    made = merkle.build(docs, columns, "lang", "doc_id", f"{shared_dir(spark)}/merkle-{uuid.uuid4().hex}", {"changed": changed})
    root = made.root().first()
    found = merkle.proofs(made).select(F.col("row.key").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", F.lit(root["root"] if root else None).cast("string").alias("root"), merkle.proof_digest(F.col("proof")).alias("proof_sha256"), merkle.fold(F.coalesce("row.changed", "hash"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), 5, 3, spoil=SPOIL))


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.drop_repeats(table(spark, sf_dir, "documents"), 13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_topk": op7_topk,
    "op8_ann": op8_ann,
    "op9_langid": op9_langid,
    "op10_warc": op10_warc,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_substrings": op13_substrings,
}

#: Every query vector with every row, in DuckDB.
TOPK_SQL = """with v as (select distinct vec_id, [floor(1024 * x::double) for x in embedding] as v from embeddings
where vec_id is not null and embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
ranked as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from scores)
select query_id, rank, vec_id, score from ranked where rank <= 10"""

#: Base 32 of a digest from its hex digits: each five bits lie in two of them.
WARC_SQL = """with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as newest from pages),
d as (select *, sha1(html) as h from p)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((16 * (instr('0123456789abcdef', substr(h, (1 + 5 * i // 4)::bigint, 1)) - 1) + instr('0123456789abcdef', substr(h, (2 + 5 * i // 4)::bigint, 1)) - 1) >> (3 - 5 * i % 4)::int) & 31)::bigint, 1) for i in range(32)], 'string_agg', '') as payload_digest,
case when page_id = newest then 'response' else 'revisit' end as record_type, case when page_id <> newest then newest end as refers_to from d"""

#: Words that share what is left when a letter is taken from one or both; forms are followed as far as they lead.
SPELLING_SQL = f"""with recursive runs as (select doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')) as r from documents) group by all),
sums as (select *, {crc32_sql("(coalesce(doc_id::varchar, '') || ':' || run)")} as h from runs where length(run) >= 5),
spoilt as (select case when h % {SPOIL} = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, k from sums),
words as (select word, sum(k)::bigint as n from spoilt where length(word) >= 5 group by word having sum(k) >= 3),
less as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from words, range(length(word)) as r(i)),
pairs as (select distinct a.word, b.word as near, b.n as near_n from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
union select less.word, words.word, words.n from less join words on words.word = rest
union select words.word, less.word, less.n from less join words on words.word = rest),
best as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as best, max(near_n) as best_n from pairs group by word),
formed as (select word, n, coalesce(n_near, 0) as n_near, case when best_n >= 2 * n then best end as form, case when best_n >= 2 * n then best_n end as form_n from words left join best using (word)),
steps as (select word, word as at from formed union all select steps.word, form from steps join formed on formed.word = steps.at where form is not null)
select f.word, f.form, steps.at as root, f.n, f.n_near, f.form_n from formed f join steps on steps.word = f.word join formed g on g.word = steps.at and g.form is null"""

#: Every window as a string; a row without an id counts as one of the largest.
SUBSTRINGS_SQL = r"""with docs as (select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as d, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (select r, d, i, array_to_string(ws[i:i + 12], ' ') as w from (select r, d, ws, unnest(range(1, len(ws) - 11)) as i from docs)),
firsts as (select w, min(d) as first from windows group by w),
gone as (select distinct r, i + k as pos from windows join firsts using (w), range(13) as x(k) where first < d),
words as (select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from docs),
kept as (select r, string_agg(word, ' ' order by pos) as t, count(*) as n from words anti join gone using (r, pos) group by r)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from docs left join kept using (r)"""

ORACLES: dict[str, str] = {
    "op13_substrings": SUBSTRINGS_SQL,
    "op12_spelling": SPELLING_SQL,
    "op7_topk": TOPK_SQL,
    "op10_warc": WARC_SQL,
    "op11_merkle": merkle.merkle_sql(),
    "op2_sharding": sharding_sql(SHARDS, sharding.SLOT_PARTS),
}
