"""A Merkle manifest of a table: bottom-up build of persisted levels, top-down push of proofs, and folding.

Rows are leaves of one tree for each group (a language), and the groups' roots are leaves of the tree above. A
level is a Parquet table of nodes; every ``FANOUT`` consecutive nodes of a group become one node of the next
level. Proofs go down level by level: children join their parents, and each child puts its siblings before what
its parent has inherited. No join key has more than ``FANOUT`` rows, and leaves are numbered by ranges, so a
group may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.llm.common import cut
from veilframe.llm.crc_sql import crc32_sql

#: Nodes that become one node of the next level.
FANOUT = 8
PROOF = "array<struct<at: int, siblings: array<string>>>"


def field(value: Column, text: Column | None = None) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; ``text``: the value as a string."""
    text = value.cast("string") if text is None else text
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(parts: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the strings put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: list[str], other: dict[str, Column] | None = None) -> Column:
    """The digest of a row's fields; ``other`` has values that stand for those of the row."""
    return digest([field((other or {}).get(c, F.col(c))) for c in columns])


def _group(name: str) -> Column:
    """A string of the group that is never null; null comes first, the rest in bytewise order."""
    return F.when(F.col(name).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """With ``pos``, from 0 without gaps within ``grp`` in the order of ``order``, and ``n``, the rows of the group.

    Ranges of rows are sorted apart; rows that are equal throughout are dealt by a seeded random number.
    """
    dealt = cut(rows.withColumn("__any", F.rand(7)).repartitionByRange("grp", *order, "__any").withColumn("__range", F.spark_partition_id()))
    counts = dealt.groupBy("grp", "__range").count()
    before = Window.partitionBy("grp").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("grp")
    starts = counts.select("grp", "__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"), F.sum("count").over(whole).alias("n"))  # a row for each range of a group
    within = Window.partitionBy("__range", "grp").orderBy(*order, "__any")
    ranked = dealt.withColumn("__no", F.row_number().over(within)).join(starts, ["grp", "__range"])
    return ranked.withColumn("pos", F.col("__start") + F.col("__no") - 1).drop("__range", "__start", "__no", "__any")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _climb(nodes: DataFrame, path: str) -> list[DataFrame]:
    """Levels above ``nodes(grp, pos, n, hash)``, each persisted as ``grp, pos, n, hash, kids``; the first takes ``nodes``.

    A group takes part while it has more than one node; its last node has ``n`` = 1.
    """
    levels, at = [], nodes
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        kids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"])
        up = at.where("n > 1").groupBy("grp", F.expr(f"pos div {FANOUT}").alias("pos")).agg(F.max("n").alias("n"), kids.alias("kids"))  # at most FANOUT each
        up = up.select("grp", "pos", F.ceil(F.col("n") / FANOUT).alias("n"), F.sha2(F.concat_ws("", "kids").cast("binary"), 256).alias("hash"), "kids")
        at = _write(up, f"{path}-{len(levels) + 1}")
        levels.append(at)
        most = -(-most // FANOUT)
    return levels


@dataclass
class Manifest:
    """``leaves(columns..., grp, pos, n, hash)``, the levels above them, ``groups(grp, pos, n, hash)`` and the levels above those."""

    leaves: DataFrame
    levels: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]

    def root(self) -> DataFrame:
        """One row ``root``; none for a table without rows."""
        return (self.top[-1] if self.top else self.groups).select(F.col("hash").alias("root"))


def build(rows: DataFrame, columns: list[str], group: str, key: str, path: str, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``, written under ``path``.

    The leaf of a row is the digest of ``columns``; leaves of a ``group`` stand in the order of ``key`` (nulls first),
    those of one key in the order of their digests. ``keep``: columns kept with each leaf. An empty table has no nodes.
    Other columns of the table, whatever their names, are not read.
    """
    kept = {"key": F.col(key), **(keep or {})}
    flat = rows.select(_group(group).alias("grp"), leaf(columns).alias("hash"), F.struct(*[c.alias(n) for n, c in kept.items()]).alias("row"))
    placed = _placed(flat.withColumn("key", F.col("row.key")), ["key", "hash"]).select("grp", "pos", "n", "hash", "row")
    leaves = _write(placed, f"{path}/leaves")
    levels = _climb(leaves.select("grp", "pos", "n", "hash"), f"{path}/level")
    roots = reduce(DataFrame.unionByName, [x.where("n = 1").select("grp", "hash") for x in [leaves, *levels]])
    named = roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "hash")
    groups = _write(_placed(named, ["name"]).select("grp", "pos", "n", "hash", "name"), f"{path}/groups")
    return Manifest(leaves, levels, groups, _climb(groups.select("grp", "pos", "n", "hash"), f"{path}/top"))


def read(spark: SparkSession, path: str) -> Manifest:
    """A manifest that ``build`` wrote: the levels follow from the numbers of leaves and of groups."""

    def above(nodes: DataFrame, name: str) -> list[DataFrame]:
        levels, most = [], nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            levels.append(spark.read.parquet(f"{path}/{name}-{len(levels) + 1}"))
            most = -(-most // FANOUT)
        return levels

    leaves, groups = spark.read.parquet(f"{path}/leaves"), spark.read.parquet(f"{path}/groups")
    return Manifest(leaves, above(leaves, "level"), groups, above(groups, "top"))


def _descend(levels: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The nodes of ``levels[0]`` with ``proof`` and ``subroot``.

    From the topmost level down, nodes that end their group's tree take what ``ends(grp, proof, subroot)`` has for
    it, and all others join their parent and put their own siblings before its proof.
    """
    at = F.expr(f"cast(pos % {FANOUT} as int)")
    step = F.struct(at.alias("at"), F.filter("kids", lambda _, i: i != at).alias("siblings"))
    parents = None
    for i in range(len(levels) - 1, -1, -1):
        nodes, own = levels[i], [c for c in levels[i].columns if c != "kids"]
        found = nodes.where("n = 1").join(ends, "grp")
        if parents is not None:
            below = nodes.where("n > 1").select(*own, F.expr(f"pos div {FANOUT}").alias("__up"), *([F.col("kids").alias("__kids")] if "kids" in nodes.columns else []))
            below = below.join(parents, ["grp", "__up"]).withColumn("proof", F.concat(F.array(step), "__proof"))
            below = below.select(*own, *([F.col("__kids").alias("kids")] if "kids" in nodes.columns else []), "proof", "subroot")
            found = found.unionByName(below)
        if i:
            parents = found.select("grp", F.col("pos").alias("__up"), "kids", F.col("proof").alias("__proof"), "subroot")
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """Leaves with ``proof`` (from the leaf upward, the place in a run and the run's other digests) and ``subroot``."""
    ends = manifest.groups.limit(0).select("grp", F.array().cast(PROOF).alias("proof"), F.col("hash").alias("subroot"))
    tops = (manifest.top or [manifest.groups])[-1].where("n = 1").select("grp", F.array().cast(PROOF).alias("proof"), F.col("hash").alias("subroot"))
    groups = _descend([manifest.groups, *manifest.top], ends.unionByName(tops))
    return _descend([manifest.leaves, *manifest.levels], groups.select(F.col("name").alias("grp"), "proof", F.col("hash").alias("subroot")))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, in its order."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda x: x["siblings"]))).cast("binary"), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""

    def up(node: Column, step: Column) -> Column:
        at, rest = step["at"], step["siblings"]
        left, right = F.slice(rest, F.lit(1), at), F.slice(rest, at + 1, F.size(rest))
        return F.sha2(F.concat(F.concat_ws("", left), node, F.concat_ws("", right)).cast("binary"), 256)

    return F.aggregate(proof, start, up)


def verify(rows: DataFrame, columns: list[str], key: str, manifest: Manifest) -> DataFrame:
    """``key, verified`` of rows as they are now: whether some leaf of the key has a proof by which the row's digest folds to the root.

    A key that the manifest lacks is not verified; neither is a null key that it lacks. Rows of one key are told apart by
    their digests: a changed row fails even if another of its key stands unchanged.
    """
    root = manifest.root().first()
    now = rows.select(F.col(key).alias("__key"), leaf(columns).alias("__now"))
    known = proofs(manifest).select(F.col("row.key").alias("__known"), F.col("hash").alias("__hash"), fold(F.col("hash"), F.col("proof")).alias("__folded")).distinct()
    found = now.join(known, F.col("__key").eqNullSafe(F.col("__known")) & (F.col("__now") == F.col("__hash")), "left")
    return found.select(F.col("__key").alias(key), F.coalesce(F.col("__folded") == F.lit(root["root"] if root else None), F.lit(False)).alias("verified"))


def merkle_sql(levels: int = 12) -> str:
    """DuckDB SQL of the manifest query; as many levels as hold ``FANOUT ** levels`` rows of a language."""

    def f(name: str, text: str) -> str:
        return f"case when {name} is null then '-' else octet_length(encode({text}))::varchar || ':' || {text} end"

    def digest_of(text: str) -> str:
        return f"sha256({f('doc_id', 'doc_id::varchar')} || {f('source', 'source')} || {f('lang', 'lang')} || {f('n_chars', 'n_chars::varchar')} || {f('text', text)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"leaves as (select doc_id, case when lang is null then '' else '=' || lang end as grp, {digest_of('text')} as hash, {digest_of(lower)} as lowered, doc_id is not null and {crc32_sql('doc_id::varchar')} % 3 = 0 as tampered from documents)"]
    ctes.append("a0 as (select *, row_number() over (partition by grp order by doc_id nulls first, hash) - 1 as pos, count(*) over (partition by grp) as n from leaves)")
    run = f"pos // {FANOUT}"

    def climb(tree: str, first: str) -> None:
        ctes.append(f"{tree}n0 as (select grp, pos, n, hash from {first})")
        for i in range(levels):
            ctes.append(f"{tree}k{i} as (select grp, {run} as up, max(n) as n, list(hash order by pos) as kids from {tree}n{i} where n > 1 group by all)")
            ctes.append(f"{tree}n{i + 1} as (select grp, up as pos, (n + {FANOUT - 1}) // {FANOUT} as n, sha256(list_aggregate(kids, 'string_agg', '')) as hash from {tree}k{i})")

    climb("a", "a0")
    ends = " union all ".join(f"select grp, hash from an{i} where n = 1" for i in range(levels + 1))
    ctes.append(f"subroots as ({ends})")
    ctes.append("b0 as (select '' as grp, grp as name, hash, row_number() over (order by grp) - 1 as pos, count(*) over () as n from subroots)")
    climb("b", "b0")
    ends = " union all ".join(f"select hash from bn{i} where n = 1" for i in range(levels + 1))
    ctes.append(f"tops as ({ends})")
    ctes.append("p0 as (select doc_id, hash as leaf, a0.grp, a0.pos, a0.n, '' as proof, case when tampered then lowered else hash end as node from a0)")

    def fold_up(tree: str, at: str) -> str:
        for i in range(levels):
            left, right = f"kids[1:(pos % {FANOUT})::bigint]", f"kids[(pos % {FANOUT})::bigint + 2:]"
            text = [f"coalesce(list_aggregate({x}, 'string_agg', ''), '')" for x in (left, right)]
            keep = "doc_id, leaf, p.grp" + (", name" if tree == "b" else "")
            ctes.append(
                f"{tree}p{i} as (select {keep}, case when p.n > 1 then pos // {FANOUT} else pos end as pos, case when p.n > 1 then (p.n + {FANOUT - 1}) // {FANOUT} else p.n end as n, "
                f"case when p.n > 1 then proof || {text[0]} || {text[1]} else proof end as proof, case when p.n > 1 then sha256({text[0]} || node || {text[1]}) else node end as node "
                f"from {at} p left join {tree}k{i} k on p.n > 1 and k.grp = p.grp and k.up = p.pos // {FANOUT})"
            )
            at = f"{tree}p{i}"
        return at

    last = fold_up("a", "p0")
    ctes.append(f"q0 as (select doc_id, leaf, '' as grp, p.grp as name, b0.pos, b0.n, proof, node from {last} p join b0 on b0.name = p.grp)")
    last = fold_up("b", "q0")
    return (
        "with " + ",\n".join(ctes) + "\nselect doc_id, leaf, subroots.hash as subroot, tops.hash as root, sha256(proof) as proof_sha256, node as folded_root, node = tops.hash as verified "
        f"from {last} p join subroots on subroots.grp = p.name cross join tops"
    )
