"""The registered queries of the de-identification engine, with the same in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.config import Config, Encrypt, Fpe, Masking, NumericQi, Pattern, Tokenization
from veilframe.functions import ciphers, masking, values
from veilframe.operators import columns, generalize, histogram, tokenize
from veilframe.operators.hierarchy import BUILT_IN
from veilframe.operators.histogram import Qi
from veilframe.plans import lattice
from veilframe.plans.anonymizer import Anonymizer, quasi_identifiers
from veilframe.shared import scratch
from veilframe.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SALT = "5a" * 32
KEY = "00112233445566778899aabbccddeeff"


def query(sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name")


# ---- columns, hashing, missing values


@query("select c_custkey, c_mktsegment from customer")
def q_suppress_columns(spark, sf_dir):
    return columns.suppress(read(spark, sf_dir, "customer"), ["c_name", "c_nationkey", "c_acctbal"])


@query("select c_custkey, sha256(c_name) as c_name from customer")
def q_hash_unsalted(spark, sf_dir):
    return columns.hash_columns(_names(spark, sf_dir), ["c_name"])


@query(f"select c_custkey, sha256('{SALT}' || c_name) as c_name from customer")
def q_hash_salted(spark, sf_dir):
    return columns.salted_hash_columns(_names(spark, sf_dir), {"c_name": SALT})


_WITH_GAPS = "case when event_id % 7 = 0 then '  ' when event_id % 7 = 1 then 'NaN' when event_id % 7 = 2 then null else event_type end"


@query(f"select event_id, case when event_id % 7 in (0, 1, 2) then v else sha256(v) end as v from (select event_id, {_WITH_GAPS} as v from events)")
def q_missing_guard(spark, sf_dir):
    return columns.hash_columns(read(spark, sf_dir, "events").select("event_id", F.expr(_WITH_GAPS).alias("v")), ["v"])


# ---- masking


def _masked(spark, sf_dir, **entry):
    return columns.mask_columns(_names(spark, sf_dir), [Masking("c_name", **entry)])


@query("select c_custkey, '*' || substr(c_name, 2, 1) || '*' || substr(c_name, 4, 6) || '*' || substr(c_name, 11) as c_name from customer")
def q_mask_positions(spark, sf_dir):
    return _masked(spark, sf_dir, positions=(1, 3, 10, 99))


@query("select o_orderkey, repeat('#', length(regexp_extract(o_orderpriority, '[A-Z]+'))) as m1, regexp_replace(o_orderpriority, '[A-Z]', '#', 'g') as o_orderpriority from orders")
def q_mask_regex_literal(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    out = columns.mask_columns(df.withColumn("m1", F.regexp_extract("o_orderpriority", "[A-Z]+", 0)), [Masking(c, patterns=(Pattern("#", regex="[A-Z]+"),)) for c in ("m1", "o_orderpriority")])
    return out.select("o_orderkey", "m1", "o_orderpriority")


@query("select c_custkey, 'C' || repeat('*', 7) || '#' || repeat('*', length(c_name) - 9) as c_name from customer")
def q_mask_regex_group(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", regex=r"(Customer)#(\d+)", groups=((1, "partial"), (2, "full"))),))


@query("select c_custkey, repeat('*', instr(c_name, '#') - 1) || substr(c_name, instr(c_name, '#')) as c_name from customer")
def q_mask_before_delim(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", type="before", delimiter="#"),))


@query("select c_custkey, substr(c_name, 1, instr(c_name, '#')) || repeat('*', length(c_name) - instr(c_name, '#')) as c_name from customer")
def q_mask_after_delim(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", type="after", delimiter="#"),))


@query("select c_custkey, 'Cus' || repeat('*', instr(c_name, '#') - 4) || substr(c_name, instr(c_name, '#')) as c_name from customer")
def q_mask_in_between(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", type="in_between", start="Cus", end="#"),))


@query("select c_custkey, substr(c_name, 1, instr(c_name, '#') - 4) || '***' || substr(c_name, instr(c_name, '#')) as c_name from customer")
def q_mask_delim_length_before(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", type="before", delimiter="#", length=3),))


@query("select c_custkey, substr(c_name, 1, instr(c_name, '#')) || '****' || substr(c_name, instr(c_name, '#') + 5) as c_name from customer")
def q_mask_delim_length_after(spark, sf_dir):
    return _masked(spark, sf_dir, patterns=(Pattern("*", type="after", delimiter="#", length=4),))


_CLASSES = f"translate(c_name, '{values.DIGITS}{values.UPPER}{values.LOWER}', '{'0' * 10}{'X' * 52}')"


@query(f"select c_custkey, {_CLASSES} as c_name from customer")
def q_mask_class_fixed(spark, sf_dir):
    return _masked(spark, sf_dir, class_mode="fixed_class")


@query(f"select c_custkey, '*' || substr({_CLASSES}, 2, instr(c_name, '#') - 1) || repeat('*', length(c_name) - instr(c_name, '#')) as c_name from customer")
def q_mask_apply_order(spark, sf_dir):
    return _masked(spark, sf_dir, positions=(1,), patterns=(Pattern("*", type="after", delimiter="#"),), class_mode="fixed_class", order=("class", "other", "regex", "characters"))


@query(f"select c_custkey, {_CLASSES} as c_name, true as changed from customer")
def q_charcloak_shape(spark, sf_dir):
    cloaked = columns.cloak_columns(_names(spark, sf_dir).withColumn("plain", F.col("c_name")), ["c_name"])
    return cloaked.select("c_custkey", values.mask_class(F.col("c_name")).alias("c_name"), (F.col("c_name") != F.col("plain")).alias("changed"))


@query(f"select c_custkey, {_CLASSES} as c_name, true as changed from customer")
def q_mask_class_random(spark, sf_dir):
    masked = columns.mask_columns(_names(spark, sf_dir).withColumn("plain", F.col("c_name")), [Masking("c_name", class_mode="random_class")])
    return masked.select("c_custkey", values.mask_class(F.col("c_name")).alias("c_name"), (F.col("c_name") != F.col("plain")).alias("changed"))


@query("select p_partkey, substr(p_name, 1, instr(p_name, ' ')) || repeat('*', length(p_name) - instr(p_name, ' ')) as p_name, p_brand from part")
def q_mask_in_between_fallback(spark, sf_dir):
    """Where the anchors are not found, what follows the first white space; without white space, nothing."""
    df = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return columns.mask_columns(df, [Masking(c, patterns=(Pattern("*", type="in_between", start="<", end=">"),)) for c in ("p_name", "p_brand")])


@query("select o_orderkey, regexp_replace(o_orderpriority, '^([0-9])-', '#-') as p1, regexp_replace(o_orderpriority, '[A-Z]', '#', 'g') as p2, repeat('#', length(o_orderpriority)) as p3 from orders")
def q_mask_regex_dialects(spark, sf_dir):
    """Named groups, classes in brackets and Unicode properties, as written for other engines."""
    df = read(spark, sf_dir, "orders").select("o_orderkey", *[F.col("o_orderpriority").alias(c) for c in ("p1", "p2", "p3")])
    patterns = {"p1": r"(?P<no>[0-9])(?=-)", "p2": "[[:upper:]]", "p3": r"(?P<first>\p{Nd})(?P<rest_of_it>.*)"}
    return columns.mask_columns(df, [Masking(c, patterns=(Pattern("#", regex=r),)) for c, r in patterns.items()])


@query("select doc_id, regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '[mail]', 'g') as text from documents")
def q_mask_mail_in_text(spark, sf_dir):
    """Addresses masked to their length in whole texts; then each run of marks becomes one word, as in the SQL."""
    mark = "\x01"
    df = read(spark, sf_dir, "documents").select("doc_id", "text")
    masked = columns.mask_columns(df, [Masking("text", patterns=(Pattern(mark, regex=r"[A-Za-z0-9._]+@[A-Za-z0-9.]+"),))])
    return masked.select("doc_id", F.regexp_replace("text", f"{mark}+", "[mail]").alias("text"))


# ---- tokens


_SEGMENT_TOKENS = "select c_mktsegment, 'SEG-' || lpad(cast(row_number() over (order by min(c_custkey)) as varchar), 4, '0') as token, row_number() over (order by min(c_custkey)) as id from customer group by c_mktsegment"


def _tokenized(spark, sf_dir):
    df = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return tokenize.tokenize(df, Tokenization("c_mktsegment", "SEG-", 4), tokenize.empty_vault(spark), "c_custkey")


@query(f"select c_custkey, token as c_mktsegment from customer join ({_SEGMENT_TOKENS}) using (c_mktsegment)")
def q_tokenize(spark, sf_dir):
    return _tokenized(spark, sf_dir)[0]


@query("select 'o_orderpriority' as \"column\", o_orderpriority as value, 'TK-' || lpad(cast(row_number() over (order by min(o_orderkey)) as varchar), 6, '0') as token, row_number() over (order by min(o_orderkey)) as id from orders group by o_orderpriority")
def q_token_vault(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return tokenize.tokenize(df, Tokenization("o_orderpriority"), tokenize.empty_vault(spark), "o_orderkey")[1]


@query("""with old(value, token, id) as (values ('1-URGENT', 'TK-000001', 1), ('none', 'TK-000002', 2)),
fresh as (select o_orderpriority as value, 2 + row_number() over (order by min(o_orderkey)) as id from orders where o_orderpriority not in (select value from old) group by o_orderpriority)
select 'o_orderpriority' as "column", value, token, id::bigint as id from old union all select 'o_orderpriority', value, 'TK-' || lpad(cast(id as varchar), 6, '0'), id from fresh""")
def q_token_vault_resume(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    vault = tokenize.vault_from_json(spark, {"o_orderpriority": {"forward": {"1-URGENT": "TK-000001", "none": "TK-000002"}}})
    return tokenize.tokenize(df, Tokenization("o_orderpriority"), vault, "o_orderkey")[1]


@query(f"select c_custkey, c_mktsegment, token as hidden from customer join ({_SEGMENT_TOKENS}) using (c_mktsegment)")
def q_detokenize(spark, sf_dir):
    df, vault = _tokenized(spark, sf_dir)
    return tokenize.detokenize(df.withColumn("hidden", F.col("c_mktsegment")), "c_mktsegment", vault)


# ---- ciphers


# For n = 0 to 24 under KEY, what becomes of n in six digits, of ABCDE, n in four digits and the letter after n others,
# and of NATION_n as the columns "name" (in its format) and "note" (under the keystream).
_KNOWN = [
    (0, "788972", "DLALB2521X", "EDVPXJ_9", "ENC$5fe387cb491fb689"),
    (1, "828860", "DLALB3855Y", "EDVPXJ_0", "ENC$5fe387cb491fb688"),
    (2, "501424", "DLALB1559Z", "EDVPXJ_1", "ENC$5fe387cb491fb68b"),
    (3, "740611", "DLALB7001A", "EDVPXJ_2", "ENC$5fe387cb491fb68a"),
    (4, "321036", "DLALB1375B", "EDVPXJ_3", "ENC$5fe387cb491fb68d"),
    (5, "477944", "DLALB0392C", "EDVPXJ_4", "ENC$5fe387cb491fb68c"),
    (6, "609127", "DLALB1863D", "EDVPXJ_5", "ENC$5fe387cb491fb68f"),
    (7, "532049", "DLALB3372E", "EDVPXJ_6", "ENC$5fe387cb491fb68e"),
    (8, "658138", "DLALB9394F", "EDVPXJ_7", "ENC$5fe387cb491fb681"),
    (9, "460451", "DLALB3361G", "EDVPXJ_8", "ENC$5fe387cb491fb680"),
    (10, "758857", "DLALB3288H", "EDVPXJ_10", "ENC$5fe387cb491fb6883c"),
    (11, "480564", "DLALB3908I", "EDVPXJ_06", "ENC$5fe387cb491fb6883d"),
    (12, "980779", "DLALB6035J", "EDVPXJ_24", "ENC$5fe387cb491fb6883e"),
    (13, "426169", "DLALB7615K", "EDVPXJ_41", "ENC$5fe387cb491fb6883f"),
    (14, "650105", "DLALB3483L", "EDVPXJ_64", "ENC$5fe387cb491fb68838"),
    (15, "237090", "DLALB1880M", "EDVPXJ_43", "ENC$5fe387cb491fb68839"),
    (16, "309618", "DLALB9300N", "EDVPXJ_82", "ENC$5fe387cb491fb6883a"),
    (17, "340207", "DLALB3725O", "EDVPXJ_94", "ENC$5fe387cb491fb6883b"),
    (18, "142642", "DLALB4905P", "EDVPXJ_39", "ENC$5fe387cb491fb68834"),
    (19, "477027", "DLALB1319Q", "EDVPXJ_26", "ENC$5fe387cb491fb68835"),
    (20, "879846", "DLALB9875R", "EDVPXJ_11", "ENC$5fe387cb491fb68b3c"),
    (21, "798221", "DLALB2091S", "EDVPXJ_75", "ENC$5fe387cb491fb68b3d"),
    (22, "393384", "DLALB8193T", "EDVPXJ_20", "ENC$5fe387cb491fb68b3e"),
    (23, "413045", "DLALB9679U", "EDVPXJ_17", "ENC$5fe387cb491fb68b3f"),
    (24, "916067", "DLALB7357V", "EDVPXJ_90", "ENC$5fe387cb491fb68b38"),
]
_KNOWN_SQL = "(values " + ", ".join(map(str, _KNOWN)) + ") as known(n, digits, pan, name, note)"


@query(f"select c_custkey, digits, pan, name, note from customer join {_KNOWN_SQL} on n = c_nationkey")
def q_fpe_known_vectors(spark, sf_dir):
    """All ciphers on texts whose ciphertexts are known, for every customer by the nation's number and name."""
    df = read(spark, sf_dir, "customer").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    n, text = F.col("n_nationkey"), F.col("n_nationkey").cast("string")
    df = df.select("c_custkey", F.lpad(text, 6, "0").alias("digits"), F.concat(F.lit("ABCDE"), F.lpad(text, 4, "0"), F.char(n + 65)).alias("pan"), F.col("n_name").alias("name"), F.col("n_name").alias("note"))
    df = columns.fpe_columns(df, [Fpe("digits", "digits"), Fpe("pan", "pan")], {"digits": KEY, "pan": KEY})
    return columns.encrypt_columns(df, [Encrypt("name", True), Encrypt("note")], {"note": KEY}, {"name": KEY})


@query(f"select o_orderkey, cast(o_orderkey as varchar) as v, length(cast(o_orderkey as varchar)) as n, digits as known from orders join {_KNOWN_SQL} on known.n = o_orderkey % 25")
def q_fpe_digits_roundtrip(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("v"), F.lpad((F.col("o_orderkey") % 25).cast("string"), 6, "0").alias("known"))
    hidden = columns.fpe_columns(df, [Fpe("v", "digits"), Fpe("known", "digits")], {"v": KEY, "known": KEY})
    return hidden.select("o_orderkey", ciphers.digits_column(F.col("v"), KEY, decrypt=True).alias("v"), F.length("v").cast("long").alias("n"), "known")


@query("select o_orderkey, lpad(cast(o_orderkey as varchar), 12, '7') as v, true as changed, 12::bigint as n, true as digits from orders")
def q_fpe_digits_change(spark, sf_dir):
    """Long enough numbers never stay what they are."""
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 12, "7").alias("v"))
    hidden = columns.fpe_columns(df.withColumn("plain", F.col("v")), [Fpe("v", "digits")], {"v": KEY})
    back = ciphers.digits_column(F.col("v"), KEY, decrypt=True)
    return hidden.select("o_orderkey", back.alias("v"), (F.col("v") != F.col("plain")).alias("changed"), F.length("v").cast("long").alias("n"), F.col("v").rlike("^[0-9]+$").alias("digits"))


@query(f"select length(cast(o_orderkey as varchar)) as n, count(distinct o_orderkey) as plain, count(distinct o_orderkey) as hidden, min(digits) as least from orders join {_KNOWN_SQL} on known.n = o_orderkey % 25 group by 1")
def q_fpe_bijective(spark, sf_dir):
    """As many ciphertexts as texts of each length; and the least ciphertext of known ones."""
    key = F.col("o_orderkey")
    df = read(spark, sf_dir, "orders").select(key.cast("string").alias("p"), key.cast("string").alias("v"), F.lpad((key % 25).cast("string"), 6, "0").alias("known"))
    hidden = columns.fpe_columns(df, [Fpe("v", "digits"), Fpe("known", "digits")], {"v": KEY, "known": KEY})
    return hidden.groupBy(F.length("v").cast("long").alias("n")).agg(F.countDistinct("p").alias("plain"), F.countDistinct("v").alias("hidden"), F.min("known").alias("least"))


_PAN = "'ABCD' || chr(65 + cast(c_custkey % 26 as int)) || lpad(cast(c_custkey % 10000 as varchar), 4, '0') || chr(65 + cast(c_custkey % 17 as int))"


def _pans(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", F.expr(_PAN.replace("varchar", "string")).alias("pan"))


@query(f"select c_custkey, {_PAN} as pan, 'XXXXX0000X' as shape, true as changed from customer")
def q_fpe_pan_roundtrip(spark, sf_dir):
    hidden = columns.fpe_columns(_pans(spark, sf_dir).withColumn("plain", F.col("pan")), [Fpe("pan")], {"pan": KEY})
    return hidden.select("c_custkey", ciphers.pan_column(F.col("pan"), KEY, decrypt=True).alias("pan"), values.mask_class(F.col("pan")).alias("shape"), (F.col("pan") != F.col("plain")).alias("changed"))


@query(f"select c_custkey, c_name, {_CLASSES} as shape, true as changed from customer")
def q_encrypt_fp_roundtrip(spark, sf_dir):
    hidden = columns.encrypt_columns(_names(spark, sf_dir).withColumn("plain", F.col("c_name")), [Encrypt("c_name", True)], {}, {"c_name": KEY})
    return hidden.select("c_custkey", ciphers.general_column(F.col("c_name"), KEY, "c_name", decrypt=True).alias("c_name"), values.mask_class(F.col("c_name")).alias("shape"), (F.col("c_name") != F.col("plain")).alias("changed"))


# The first 32 bytes of the keystream of column "c_name" under KEY.
_STREAM = "42a49b67349c49c5b8b5a3630d0bc0c65ad9658a4bdea048e97101fc1b416bae"


@query(f"""select c_custkey, c_name, 'ENC$' || list_aggregate(list_transform(range(length(c_name)),
lambda i: printf('%02x', xor(('0x' || substr(hex(encode(c_name)), (2 * i + 1)::bigint, 2))::int, ('0x' || substr('{_STREAM}', (2 * i + 1)::bigint, 2))::int))), 'string_agg', '') as hidden from customer""")
def q_encrypt_xor_roundtrip(spark, sf_dir):
    hidden = columns.encrypt_columns(_names(spark, sf_dir), [Encrypt("c_name")], {"c_name": KEY}, {}).withColumnRenamed("c_name", "hidden")
    return hidden.select("c_custkey", ciphers.xor_column(F.col("hidden"), KEY, "c_name", decrypt=True).alias("c_name"), "hidden")


# ---- quasi-identifiers and the histogram


@query("""select 'l_linenumber' as qi, min(l_linenumber)::double as low, max(l_linenumber)::double as high from lineitem
union all select 'l_quantity', min(l_quantity), max(l_quantity) from lineitem union all select 'no_such_column', 0.0, 0.0""")
def q_qi_min_max(spark, sf_dir):
    found = histogram.min_max(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber", "no_such_column"])
    return spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in found.items()], "qi string, low double, high double")


@query("select c_mktsegment as value, dense_rank() over (order by c_mktsegment) - 1 as idx from (select distinct c_mktsegment from customer)")
def q_cat_domain(spark, sf_dir):
    return histogram.domain(read(spark, sf_dir, "customer"), "c_mktsegment")


_TWO = [NumericQi("l_quantity"), NumericQi("l_linenumber")]
_LINES = Config(k=15, suppression_limit=0.01, numerical=tuple(_TWO), categorical=("gender",), size={"l_quantity": 2, "l_linenumber": 2})


def _lines(spark, sf_dir):
    """Line items with a gender made up from the supplier's parity."""
    df = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_suppkey")
    return df.select("l_orderkey", F.col("l_quantity").cast("long").alias("l_quantity"), "l_linenumber", F.when(F.col("l_suppkey") % 2 == 0, "Female").otherwise("Male").alias("gender"))


_HIST = "select (l_quantity - (select min(l_quantity) from lineitem))::bigint as i0, (l_linenumber - (select min(l_linenumber) from lineitem))::bigint as i1, (l_suppkey % 2)::bigint as i2, count(*) as cnt from lineitem group by 1, 2, 3"


def _hist(spark, sf_dir):
    df = _lines(spark, sf_dir)
    return histogram.histogram(df, quasi_identifiers(df, _LINES))


@query("select (l_quantity - (select min(l_quantity) from lineitem))::bigint as i0, (l_linenumber - (select min(l_linenumber) from lineitem))::bigint as i1, count(*) as cnt from lineitem group by 1, 2")
def q_histogram(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    return histogram.histogram(df, quasi_identifiers(df, Config(numerical=tuple(_TWO))))


@query(_HIST)
def q_histogram_categorical(spark, sf_dir):
    return _hist(spark, sf_dir)


_RAW = "case when event_id % 5 = 0 then 'abc' when event_id % 5 = 1 then '7d' when event_id % 11 = 2 then 'nan' when event_id % 13 = 3 then null else ' ' || cast(event_id % 40 as {}) || ' ' end"


@query(f"select greatest(floor(try_cast(v as double) / 4), 0)::bigint as i0, count(*) as cnt from (select {_RAW.format('varchar')} as v from events) where regexp_full_match(trim(v), '[0-9]+') group by 1")
def q_valid_record_filter(spark, sf_dir):
    df = read(spark, sf_dir, "events").select(F.expr(_RAW.format("string")).alias("v"))
    return histogram.histogram(df, [Qi("v", False, 0.0, 39.0)], [4])


@query(f"select i0 // 8 as i0, i1 // 2 as i1, i2 // 2 as i2, sum(cnt)::bigint as cnt from ({_HIST}) group by 1, 2, 3")
def q_merge_node(spark, sf_dir):
    return histogram.merged(_hist(spark, sf_dir), (8, 2, 2))


def _measures(source: str, k: int) -> str:
    return f"select coalesce(sum(cnt) filter (cnt < {k}), 0)::bigint as suppressed, coalesce(sum(cnt * cnt) filter (cnt >= {k}), 0)::bigint as dm_star, count(*) filter (cnt >= {k}) as classes from ({source})"


@query(f"select suppressed from ({_measures(_HIST, 100)})")
def q_suppression_count(spark, sf_dir):
    return _hist(spark, sf_dir).agg(*histogram.measures(100)).select("suppressed")


@query(f"select dm_star, classes from ({_measures(_HIST, 80)})")
def q_dm_star(spark, sf_dir):
    return _hist(spark, sf_dir).agg(*histogram.measures(80)).select("dm_star", "classes")


# ---- the lattice


_NODES = """with recursive span as (select ceil(max(l_quantity) - min(l_quantity) + 1)::bigint as a, (max(l_linenumber) - min(l_linenumber) + 1)::bigint as b from lineitem),
wa(x) as (select 1::bigint union select least(x * 2, a) from wa, span where x < a), wb(x) as (select 1::bigint union select least(x * 2, b) from wb, span where x < b),
nodes as (select wa.x as a, wb.x as b, c::bigint as c from wa, wb, range(1, 3) as t(c))"""


def _nodes(spark, sf_dir):
    df = _lines(spark, sf_dir)
    return lattice.levels(quasi_identifiers(df, _LINES), (1, 1, 1), _LINES.size)


@query(f"{_NODES} select a, b, c from nodes")
def q_lattice_nodes(spark, sf_dir):
    return spark.createDataFrame([n for level in _nodes(spark, sf_dir) for n in level], "a long, b long, c long")


@query("""with s as (select ceil(max(p_size) - min(p_size) + 1)::bigint as a, ceil(max(p_retailprice) - min(p_retailprice) + 1)::bigint as b from part)
select f as width, (a + f - 1) // f * ((b + 9) // 10) as classes from s, range(1, 6) as t(f)""")
def q_ola1_estimate(spark, sf_dir):
    qis = quasi_identifiers(read(spark, sf_dir, "part"), Config(numerical=(NumericQi("p_size"), NumericQi("p_retailprice"))))
    return spark.createDataFrame([(f, lattice.estimated_classes(qis, (f, 10))) for f in range(1, 6)], "width long, classes long")


_PARTS = """with recursive s as (select ceil(max(p_size) - min(p_size) + 1)::bigint as a, ceil(max(p_retailprice) - min(p_retailprice) + 1)::bigint as b from part),
wa(x) as (select 1::bigint union select least(x * 2, a) from wa, s where x < a), wb(x) as (select 1::bigint union select least(x * 10, b) from wb, s where x < b)"""


@query(f"{_PARTS} select most::bigint as most, min((wa.x, wb.x))[1] as a, min((wa.x, wb.x))[2] as b from s, wa, wb, (values (20), (300), (2000), (100000)) as t(most) where ((s.a + wa.x - 1) // wa.x) * ((s.b + wb.x - 1) // wb.x) <= most group by 1")
def q_first_widths(spark, sf_dir):
    """The first node, in lexicographic order, that is estimated to stay within a number of classes."""
    qis = quasi_identifiers(read(spark, sf_dir, "part"), Config(numerical=(NumericQi("p_size"), NumericQi("p_retailprice"))))
    rows = [(most, *lattice.first_widths(qis, {"p_size": 2, "p_retailprice": 10}, most)) for most in (20, 300, 2000, 100_000)]
    return spark.createDataFrame(rows, "most long, a long, b long")


#: k and the share of rows that may be suppressed.
_WALKS = [(5, 0.0), (40, 0.2), (90, 0.05)]


@query(f"""with recursive s as (select min(p_size) as lo, max(p_size) as hi, count(*) as total from part),
chain(level, w) as (select 0, 1::bigint union all select level + 1, least(w * 2, hi - lo + 1) from chain, s where w < hi - lo + 1),
sized as (select level, w, (p_size - lo) // w as i, count(*) as n from part, chain, s group by all),
scores as (select k, share, level, w, coalesce(sum(n) filter (n < k), 0)::bigint as suppressed, coalesce(sum(n * n) filter (n >= k), 0)::bigint as dm_star, count(*) filter (n >= k) as classes
from sized, (values {", ".join(map(str, _WALKS))}) as t(k, share) group by all),
walk(k, step, lo, hi) as (select distinct k, 1, 0, (select max(level) from chain) from scores union all
select walk.k, step + 1, case when suppressed <= share * total then walk.lo else level + 1 end, case when suppressed <= share * total then level - 1 else walk.hi end
from walk, s, scores where scores.k = walk.k and level = walk.lo + (walk.hi - walk.lo + 1) // 2 and walk.lo <= walk.hi)
select walk.k::bigint as k, step::bigint as step, w as node, suppressed, dm_star, classes from walk join scores on scores.k = walk.k and level = walk.lo + (walk.hi - walk.lo + 1) // 2 where walk.lo <= walk.hi""")
def q_walk_evaluated(spark, sf_dir):
    """Which widths of the parts' size the walk evaluates, in order; over one quasi-identifier it halves the open levels."""
    df = read(spark, sf_dir, "part").select("p_size")
    rows = []
    for k, share in _WALKS:
        model = Anonymizer(Config(k=k, suppression_limit=share, numerical=(NumericQi("p_size"),), size={"p_size": 2})).fit(df)
        rows += [(k, step, s.node[0], s.suppressed, s.dm_star, s.classes) for step, s in enumerate(model.found.evaluated, 1)]
    return spark.createDataFrame(rows, "k long, step long, node long, suppressed long, dm_star long, classes long")


_SCORES = f"""{_NODES}, hist as ({_HIST}),
sized as (select a, b, c, sum(cnt) as cnt from nodes, hist group by a, b, c, i0 // a, i1 // b, i2 // c),
scores as (select a, b, c, coalesce(sum(cnt) filter (cnt < 15), 0)::bigint as suppressed, coalesce(sum(cnt * cnt) filter (cnt >= 15), 0)::bigint as dm_star, count(*) filter (cnt >= 15) as classes from sized group by a, b, c)"""


@query(f"{_SCORES} select * from scores")
def q_lattice_scores(spark, sf_dir):
    nodes = [n for level in _nodes(spark, sf_dir) for n in level]
    scored = histogram.score_nodes(_hist(spark, sf_dir), nodes, 15)
    return scored.select(*[F.col("node")[i].alias(c) for i, c in enumerate("abc")], "suppressed", "dm_star", "classes")


_BEST = "select * from scores where suppressed <= 0.01 * (select sum(cnt) from hist) order by dm_star, suppressed, classes desc, a, b, c"


def _fitted(spark, sf_dir, **changes):
    return Anonymizer(Config(**{**_LINES.__dict__, **changes})).fit(_lines(spark, sf_dir))


def _score_rows(spark, scores):
    return spark.createDataFrame([(*s.node, s.suppressed, s.dm_star, s.classes) for s in scores], "a long, b long, c long, suppressed long, dm_star long, classes long")


@query(f"{_SCORES} {_BEST} limit 1")
def q_best_node(spark, sf_dir):
    return _score_rows(spark, [_fitted(spark, sf_dir).found.best])


@query(f"{_SCORES} {_BEST} limit 5")
def q_top5_nodes(spark, sf_dir):
    """Of all nodes that pass, so that SQL without the walk can tell the same; the walk's own list is tested apart."""
    return _score_rows(spark, _fitted(spark, sf_dir, exhaustive=True).found.top)


@query(f"{_SCORES}, best as ({_BEST} limit 1), fin as (select sum(cnt) as cnt from best, hist group by i0 // a, i1 // b, i2 // c) select cnt::bigint as size, count(*) as classes from fin where cnt >= 15 group by 1")
def q_ec_stats(spark, sf_dir):
    return spark.createDataFrame(list(_fitted(spark, sf_dir).class_sizes.items()), "size long, classes long")


# ---- generalization


@query("""with m as (select floor(min(p_retailprice))::bigint as lo from part)
select p_partkey, '[' || (lo + (round(p_retailprice)::bigint - lo) // 10 * 10) || '-' || (lo + (round(p_retailprice)::bigint - lo) // 10 * 10 + 9) || ']' as price,
'[' || (1 + (p_size - 1) // 7 * 7) || '-' || (1 + (p_size - 1) // 7 * 7 + 6) || ']' as size from part, m""")
def q_generalize_numeric(spark, sf_dir):
    df = read(spark, sf_dir, "part")
    low = histogram.min_max(df, ["p_retailprice", "p_size"])
    label = generalize.numeric_label
    return df.select("p_partkey", label(F.col("p_retailprice"), low["p_retailprice"][0], 10).alias("price"), label(F.col("p_size"), low["p_size"][0], 7).alias("size"))


def _case(column: str, pairs: dict[str, str], other: str) -> str:
    return f"case {column} " + " ".join(f"when '{v}' then '{c}'" for v, c in pairs.items()) + f" else '{other}' end"


def _leaves(name: str) -> list[str]:
    return [*BUILT_IN[name].levels[2], "?"]


def _derived(name: str) -> str:
    return "case p_partkey % {n} {whens} end".format(n=len(_leaves(name)), whens=" ".join(f"when {i} then '{v}'" for i, v in enumerate(_leaves(name))))


def _levels(spark, sf_dir, name: str, derived: str):
    h = BUILT_IN[name]
    df = read(spark, sf_dir, "part").select("p_partkey", F.expr(derived).alias("v"))
    return df.select("p_partkey", *[h.column(F.col("v"), n).alias(f"l{n}") for n in range(1, h.depth + 1)])


@query(f"select p_partkey, v as l1, {_case('v', dict(BUILT_IN['blood group'].levels[2]), 'Other')} as l2, '*' as l3 from (select p_partkey, {_derived('blood group')} as v from part)")
def q_generalize_blood(spark, sf_dir):
    return _levels(spark, sf_dir, "blood group", _derived("blood group"))


_GENDER = "case when p_partkey % 2 = 0 then 'Female' else 'Male' end"


@query(f"select p_partkey, {_GENDER} as l1, '*' as l2 from part")
def q_generalize_gender(spark, sf_dir):
    return _levels(spark, sf_dir, "gender", _GENDER)


@query(f"select p_partkey, v as l1, {_case('v', dict(BUILT_IN['profession'].levels[2]), 'Other')} as l2, {_case('v', dict(BUILT_IN['profession'].levels[3]), 'Other')} as l3, '*' as l4 from (select p_partkey, {_derived('profession')} as v from part)")
def q_generalize_profession(spark, sf_dir):
    return _levels(spark, sf_dir, "profession", _derived("profession"))


@query("select p_partkey, case when count(*) over (partition by p_brand, p_size) < 3 then '*' else p_brand end as p_brand, case when count(*) over (partition by p_brand, p_size) < 3 then '*' else cast(p_size as varchar) end as p_size from part")
def q_suppress_small_ec(spark, sf_dir):
    df = read(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("string").alias("p_size"))
    return generalize.suppressed(df, ["p_brand", "p_size"], 3)


_LABELS = f"""{_SCORES}, best as ({_BEST} limit 1), rows as (select l_orderkey, l_quantity::bigint - 1 as q, l_linenumber - 1 as n, l_suppkey % 2 as g from lineitem),
named as (select l_orderkey, '[' || (1 + q // a * a) || '-' || (q // a * a + a) || ']' as l_quantity, '[' || (1 + n // b * b) || '-' || (n // b * b + b) || ']' as l_linenumber, case when c > 1 then '*' when g = 0 then 'Female' else 'Male' end as gender from rows, best),
counted as (select *, count(*) over (partition by l_quantity, l_linenumber, gender) as n from named),
final as (select l_orderkey, case when n < 15 then '*' else l_quantity end as l_quantity, case when n < 15 then '*' else l_linenumber end as l_linenumber, case when n < 15 then '*' else gender end as gender from counted)"""


@query(f"{_LABELS} select * from final")
def q_k_anonymize_full(spark, sf_dir):
    df = _lines(spark, sf_dir)
    return Anonymizer(_LINES).fit_transform(df)[1]


@query(f"{_LABELS}, sizes as (select count(*) as size, (l_quantity = '*' and l_linenumber = '*' and gender = '*') as starred from final group by l_quantity, l_linenumber, gender) select size, starred, count(*) as classes from sizes group by 1, 2")
def q_output_audit(spark, sf_dir):
    return generalize.class_audit(q_k_anonymize_full(spark, sf_dir), ["l_quantity", "l_linenumber", "gender"])


@query(f"{_LABELS} select count(*) as total, count(*) filter (gender = '*' and l_quantity = '*') as suppressed, count(*) // count(distinct (l_quantity, l_linenumber, gender)) as mean_class from final")
def q_info_loss(spark, sf_dir):
    out = q_k_anonymize_full(spark, sf_dir)
    sizes = out.groupBy("l_quantity", "l_linenumber", "gender").agg(F.count("*").alias("n"))
    starred = (F.col("gender") == "*") & (F.col("l_quantity") == "*")
    return sizes.agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(starred, F.col("n"))), F.lit(0)).alias("suppressed"), F.expr("sum(n) div count(*)").alias("mean_class"))


@query("select event_id, sha256(event_type) as event_type, '[' || (user_id // 10 * 10) || '-' || (user_id // 10 * 10 + 9) || ']' as user_id from events")
def q_row_local_transforms(spark, sf_dir):
    """What a stream of events goes through, on the whole table."""
    df = read(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("user_id"))
    return generalize.generalized(columns.hash_columns(df, ["event_type"]), [Qi("user_id", False, 0.0, 149.0)], [10])


# ---- CSV in and out


@query("select cast(c_custkey as varchar) as c_custkey, 'a \"b\", ' || c_name as said, case when c_custkey % 3 = 0 then null else c_mktsegment end as c_mktsegment from customer")
def q_csv_round_trip(spark, sf_dir):
    """Quotes, commas and nulls, written as part files and read again as text."""
    path = f"{scratch(spark)}/csv-{uuid.uuid4().hex}"
    df = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('a "b", '), "c_name").alias("said"), F.expr("case when c_custkey % 3 = 0 then null else c_mktsegment end").alias("c_mktsegment"))
    tables.write_csv(df, path)
    return tables.read_csv(spark, path)


@query("""select cast(s_suppkey as varchar) as id, case when s_suppkey % 2 = 0 then 'say "' || s_suppkey || '", twice' else s_name end as name, case when s_suppkey % 3 = 0 then null else 'x' end as rest
from supplier where s_suppkey % 5 <> 0""")
def q_csv_blank_and_short_rows(spark, sf_dir):
    """Blank lines and rows of blank cells are left out, short rows end in nulls, doubled quotes are one."""
    path = f"{scratch(spark)}/lines-{uuid.uuid4().hex}"
    line = F.expr("""case when s_suppkey % 5 = 0 then if(s_suppkey % 2 = 0, '', ' , ,  ') else
        concat(s_suppkey, ',', case when s_suppkey % 2 = 0 then concat('"say ""', s_suppkey, '"", twice"') else s_name end, if(s_suppkey % 3 = 0, '', ',x')) end""")
    head = spark.createDataFrame([("id,name,rest",)], "value string")
    head.unionByName(read(spark, sf_dir, "supplier").select(line.alias("value"))).coalesce(1).write.text(path)  # a header and 10,000 rows for each unit of scale
    return tables.read_csv(spark, path)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_k_anonymize_full(spark, sf_dir)
