"""Merkle manifest of a dataset as a content-addressed graph, and proofs by descent.

Rows are leaves; in every group, ordered by id, each eight consecutive nodes have their digest as parent, until one is
left; the groups' last nodes likewise give the root. What is stored is digest -> children, level by level. A
request names a leaf by its rank: its digits in base eight lead from the root down, every step looks the digest up,
follows the child that the digit names and collects the others; the collected segments, reversed, prove the leaf.

Requests with equal leading digits are one request until they part, so a level costs as many look-ups as it has nodes,
and the root is looked up once, not once per leaf.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.llm.base import ascii_lower, query, spread
from colonnade.operators.ordered import sliced, with_position
from colonnade.session import scratch_path

FAN = 8
#: Hex digits of a digest.
DIGITS = 64
#: The columns of a leaf, in the order they are hashed.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    """SHA-256 of a string's UTF-8 bytes, lowercase hex."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and itself, ``-`` for null."""
    parts = []
    for c in values:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return sha(F.concat(*parts))


@dataclass
class Tree:
    """Levels of records (``k`` group, ``at`` place, ``n`` nodes of the group there, ``digest``, ``kids`` digests in a row),
    from the parents of the leaves upwards, and ``tops``: ``k``, ``digest``, ``depth`` of the last node of each group."""

    levels: list[DataFrame] = field(default_factory=list)
    tops: DataFrame | None = None


def _parents(nodes: DataFrame, *carry: str) -> DataFrame:
    """One node for each run of ``FAN`` nodes; the only node of a group stays itself. ``carry`` columns become ``docs``."""
    own = F.struct(F.col("at").alias("i"), "digest", *carry)
    runs = nodes.groupBy("k", F.floor(F.col("at") / FAN).alias("at")).agg(F.min("n").alias("n"), F.array_sort(F.collect_list(own)).alias("run"))
    kids = F.array_join(F.transform("run", lambda x: x["digest"]), "")
    runs = runs.select("k", "at", "n", kids.alias("kids"), *(["run"] if carry else []))
    return runs.withColumn("digest", F.when(F.col("n") == 1, F.col("kids")).otherwise(sha(F.col("kids"))))


def grow(leaves: DataFrame, *carry: str) -> Tree:
    """The tree of every group of ``leaves`` (``k``, ``at`` from 0 without gaps, ``n`` leaves of the group, ``digest``).

    Each level is a table in the shared folder. The driver learns the largest group's size, which bounds the levels.
    """
    spark, tree, done = leaves.sparkSession, Tree(), []
    path = scratch_path(spark, "levels")
    level = _parents(leaves, *carry)
    while True:
        level.write.parquet(f"{path}/{len(tree.levels)}")
        stored = spark.read.parquet(f"{path}/{len(tree.levels)}")
        tree.levels.append(stored)
        done.append(stored.filter(F.col("n") <= FAN).select("k", "digest", F.lit(len(tree.levels)).alias("depth")))
        open_ = stored.filter(F.col("n") > FAN)
        if open_.isEmpty():
            break
        level = _parents(open_.select("k", "at", F.ceil(F.col("n") / FAN).alias("n"), "digest"))
    tree.tops = done[0]
    for d in done[1:]:
        tree.tops = tree.tops.union(d)
    return tree


def descend(tree: Tree, start: DataFrame, last: int = 0, wanted: DataFrame | None = None) -> DataFrame:
    """Follow requests from ``start`` (``k``, ``digest``, ``depth``, ``segments``, further columns) down to level ``last``: ``k``, ``at``, ``digest``, ``segments``, ...

    ``wanted`` (``k``, ``at`` of leaves) keeps only the branches that some request's digits lead to; without it all leaves are asked for.
    """
    more = [c for c in start.columns if c not in ("k", "digest", "depth", "segments")]
    here = None
    for depth in range(len(tree.levels), last, -1):
        new = start.filter(F.col("depth") == depth).select("k", F.lit(0).cast("long").alias("at"), "digest", "segments", *more)
        here = new if here is None else here.union(new)
        met = here.join(tree.levels[depth - 1].select("digest", "k", "at", "n", "kids"), ["digest", "k", "at"])
        met = met.withColumn("digit", F.explode(F.sequence(F.lit(0), (F.length("kids") / DIGITS).cast("int") - 1)))
        cut = lambda a, n: F.substring("kids", a, n)
        left, right = cut(F.lit(1), F.col("digit") * DIGITS), cut((F.col("digit") + 1) * DIGITS + 1, F.length("kids"))
        segments = F.when(F.col("n") == 1, F.col("segments")).otherwise(F.concat("segments", F.array(F.struct(left.alias("left"), right.alias("right")))))
        here = met.select("k", (F.col("at") * FAN + F.col("digit")).alias("at"), cut(F.col("digit") * DIGITS + 1, F.lit(DIGITS)).alias("digest"), segments.alias("segments"), *more)
        if wanted is not None:
            asked = wanted.select("k", F.floor(F.col("at") / FAN ** (depth - 1)).alias("at")).distinct()
            here = here.join(asked, ["k", "at"], "left_semi")
    if last:
        same = start.filter(F.col("depth") == last).select("k", F.lit(0).cast("long").alias("at"), "digest", "segments", *more)
        here = same if here is None else here.union(same)
    return here


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the segments from leaf to root lead to."""
    return F.aggregate(path, leaf, lambda node, s: sha(F.concat(s["left"], node, s["right"])))


NO_SEGMENTS = "array<struct<left:string,right:string>>"


@dataclass
class Manifest:
    """The groups' trees with the rows in their lowest level, the tree over the groups, and the root (None without rows)."""

    groups: Tree
    top: Tree
    names: DataFrame
    root: str | None


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows``: ``lang``, ``doc_id``, ``leaf`` and further columns, which stay with their leaf.

    Leaves of a group ascend by doc_id (null first), equal ids by digest; groups by lang (null first, bytewise). Ranks come from
    a range order over the whole table, so a group of any size is dealt to many tasks; only one row per range travels.
    """
    more = [c for c in rows.columns if c not in ("lang", "leaf")]
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    tagged = rows.select(key.alias("k"), F.col("leaf").alias("digest"), *more, F.monotonically_increasing_id().alias("_row"))
    order = sliced(tagged, ["k", F.col("doc_id").asc_nulls_first(), "digest", "_row"])
    part = order.groupBy("k", "_slice").agg(F.count(F.lit(1)).alias("c"), F.min("_seq").alias("first"))
    group = W.partitionBy("k")  # one row per range that the group reaches
    before = group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    part = part.select("k", "_slice", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("add"), F.sum("c").over(group).alias("n"))
    ranked = order.join(part, ["k", "_slice"]).select("k", (F.col("_seq") + F.col("add")).alias("at"), "n", "digest", *more)
    groups = grow(ranked, *more)
    names = with_position(groups.tops, ["k"], "at")
    count = names.count()
    top = grow(names.select(F.lit("").alias("k"), "at", F.lit(count).cast("long").alias("n"), "digest"))
    found = top.tops.collect()  # one row
    return Manifest(groups, top, names, found[0]["digest"] if found else None)


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """For every leaf (or the ``wanted`` ones, ``lang`` and rank ``at``): the columns it was built with in ``doc``, ``leaf``, ``subroot``, ``path`` (segments from leaf to root).

    Segments are collected once per run of eight leaves and dealt to them in the last step, where nothing is shuffled any more.
    """
    spark = manifest.names.sparkSession
    asked = None if wanted is None else wanted.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("k"), "at")
    root = manifest.top.tops.withColumn("segments", F.expr(f"cast(array() as {NO_SEGMENTS})"))
    subroots = descend(manifest.top, root).select("at", "digest", "segments")
    start = manifest.names.join(subroots, ["at", "digest"]).select("k", "digest", "depth", "segments", F.col("digest").alias("subroot"))
    path = scratch_path(spark, "subroots")
    start.write.parquet(path)
    runs = descend(manifest.groups, spark.read.parquet(path), 1, None if asked is None else asked.select("k", "at"))
    met = runs.join(manifest.groups.levels[0], ["digest", "k", "at"]).select("k", F.col("at").alias("run_at"), "n", "kids", "subroot", F.reverse("segments").alias("upper"), F.posexplode("run").alias("digit", "doc"))
    if asked is not None:
        met = met.join(asked.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("doc.i") == F.col("at")), "left_semi")
    cut = lambda a, n: F.substring("kids", a, n)
    own = F.struct(cut(F.lit(1), F.col("digit") * DIGITS).alias("left"), cut((F.col("digit") + 1) * DIGITS + 1, F.length("kids")).alias("right"))
    return met.select("doc", F.col("doc.digest").alias("leaf"), "subroot", F.when(F.col("n") == 1, F.col("upper")).otherwise(F.concat(F.array(own), "upper")).alias("path"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``lang``, ``doc_id``, ``leaf`` of documents, and ``tampered``, the leaf with A-Z of the text in lower case where 3 divides the crc32 of the id."""
    values = [F.col(c) for c in LEAF]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    src = spread(docs.select(*LEAF))
    return src.select("lang", "doc_id", leaf_digest(values).alias("leaf"), F.when(hit, leaf_digest([*values[:-1], ascii_lower(F.col("text"))])).alias("tampered"))


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    Only the columns of ``LEAF`` are read, so others may have any name. Nulls in any of them have a digest of their own,
    empty and very long texts are hashed whole; equal ids, and rows equal in all columns, are leaves of their own; a null id is
    never tampered with. Without rows there is no row.
    """
    manifest = build(document_leaves(docs))
    out = proofs(manifest)
    text = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = fold(F.coalesce("doc.tampered", "leaf"), F.col("path"))
    root = F.lit(manifest.root)
    out = out.select(F.col("doc.doc_id").alias("doc_id"), "leaf", "subroot", root.cast("string").alias("root"), sha(text).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: SQL's crc32 of a short string, bit by bit (fixed values: the polynomial and the mask).
_CRC = "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({x}, ''), lambda c: list_transform(range(8), lambda i: (ascii(c)::bigint >> i::int) & 1)))), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"


def _sql(levels: int = 8, top_levels: int = 4) -> str:
    """The manifest in SQL, for groups of up to ``FAN ** levels`` leaves and ``FAN ** top_levels`` groups."""
    digest = lambda *cs: "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in cs) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"l AS (SELECT doc_id, coalesce('=' || lang, '') AS k, {digest(*LEAF)} AS leaf, CASE WHEN {_CRC.format(x='doc_id::varchar')} % 3 = 0 THEN {digest(*LEAF[:-1], lower)} END AS tampered FROM documents)",
        "g AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l)",
        "v0 AS (SELECT k, pos, count(*) OVER (PARTITION BY k) AS n, leaf AS d FROM g)",
        "q0 AS (SELECT doc_id, k, pos, leaf, coalesce(tampered, leaf) AS cur, '' AS proof FROM g)",
    ]

    def climb(v: str, q: str, k: str, at: str, count: int) -> None:
        for i in range(count):
            ctes.append(f"{v}{i + 1} AS (SELECT k, pos // {FAN} AS pos, (max(n) + {FAN - 1}) // {FAN} AS n, CASE WHEN max(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM {v}{i} GROUP BY k, pos // {FAN})")
            side = lambda op: f"coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos {op} a.pos), '')"
            ctes.append(f"{v}s{i} AS (SELECT a.k, a.pos, a.n, {side('<')} AS lo, {side('>')} AS hi FROM {v}{i} a JOIN {v}{i} b ON a.k = b.k AND a.pos // {FAN} = b.pos // {FAN} GROUP BY a.k, a.pos, a.n)")
            ctes.append(f"{q}{i + 1} AS (SELECT q.* REPLACE (CASE WHEN s.n = 1 THEN q.cur ELSE sha256(lo || q.cur || hi) END AS cur, q.proof || lo || hi AS proof) FROM {q}{i} q JOIN {v}s{i} s ON s.k = q.{k} AND s.pos = q.{at} // {FAN**i})")

    climb("v", "q", "k", "pos", levels)
    ctes += [
        f"w0 AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n, d, k AS name FROM v{levels})",
        f"r0 AS (SELECT q.*, w.d AS subroot, w.pos AS top, w.k AS one FROM q{levels} q JOIN w0 w ON w.name = q.k)",
    ]
    climb("w", "r", "one", "top", top_levels)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, w.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = w.d AS verified FROM r{top_levels}, w{top_levels} w"


@query("op13_merkle_manifest", _sql())
def op13_merkle_manifest(t):
    """Digests, proof and verdict of every document."""
    return manifest_proofs(t.documents)
