"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c) of each other, and so do their
projections. Vectors are laid on a grid of cell width eps over their leading principal axes, sorted by
label and cells (the grid order) and cut into blocks of consecutive vectors. Blocks whose boxes
are further apart than eps never meet; two blocks that may hold links are one task, which
halves the longer sequence again and again, drops halves that are provably apart and multiplies out what
is left. A task returns link counts and, for what links, the smallest id it reaches, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm.base import query, spread
from colonnade.llm.components import components, local_roots
from colonnade.session import checkpoint_root

#: Grid axes, axes whose boxes are compared, vectors in a block, and rows and columns multiplied out at once.
GRID_AXES, BOX_AXES, BLOCK, LEAF = 3, 8, 1024, 128
#: Pairs of blocks that reach a Python worker at once (two blocks of 64 floats hold about half a MB).
PAIRS_AT_ONCE = 8


def usable(embedding: Column, label: Column) -> Column:
    """Whether a vector can link: it has a label, and finite components that are not all zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(lists: pa.ListArray, d: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(vectors: DataFrame, n: int = BOX_AXES) -> dict[int, np.ndarray]:
    """The leading principal axes of the unit vectors of each length, from second moments summed over all of them.

    The sums of a length d are d (d + 1) / 2 numbers, whatever the number of vectors.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            length = b.column("d").to_numpy()
            for d in np.unique(length):
                x = _units(b.column("embedding").filter(pa.array(length == d)), int(d))
                one = np.concatenate([x, np.ones((len(x), 1))], axis=1)
                sums[int(d)] = sums.get(int(d), 0) + one.T @ one
        for d, m in sums.items():
            i = np.triu_indices(d + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i[0]), d), pa.int32()), pa.array(np.arange(len(i[0])), pa.int32()), pa.array(m[i])], ["d", "k", "v"])

    rows = vectors.select("d", "embedding").mapInArrow(moments, "d int, k int, v double").groupBy("d", "k").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for d, g in rows.groupby("d"):
        m = np.zeros((d + 1, d + 1))
        m[np.triu_indices(d + 1)] = g.sort_values("k")["v"].to_numpy()
        mean = m[:d, d] / m[d, d]
        cov = (m[:d, :d] + np.triu(m[:d, :d], 1).T) / m[d, d] - np.outer(mean, mean)
        out[int(d)] = np.linalg.eigh(cov)[1][:, ::-1][:, : min(n, d)]
    return out


def _blocks(vectors: DataFrame, along: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors that follow each other in the grid order, checkpointed (range borders are sampled)."""
    kind = dict(vectors.dtypes)["embedding"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("d").to_numpy()
            cell = np.zeros((b.num_rows, GRID_AXES), np.int32)
            for d in np.unique(length):
                at = length == d
                y = _units(b.column("embedding").filter(pa.array(at)), int(d)) @ along[int(d)][:, :GRID_AXES]
                cell[at, : y.shape[1]] = np.floor(y / eps)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(cell[:, k]) for k in range(GRID_AXES))], [*b.schema.names, *(f"g{k}" for k in range(GRID_AXES))])

    grid = [f"g{k}" for k in range(GRID_AXES)]
    placed = vectors.mapInArrow(place, f"cid long, n long, label {dict(vectors.dtypes)['label']}, d int, embedding {kind}, {', '.join(f'{g} int' for g in grid)}")
    order = ["label", "d", *grid, "cid"]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, rest = TaskContext.get().partitionId(), 0, None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            turn = np.flatnonzero((f["label"].to_numpy()[1:] != f["label"].to_numpy()[:-1]) | (f["d"].to_numpy()[1:] != f["d"].to_numpy()[:-1])) + 1
            edges = sorted({0, len(f), *turn.tolist()})
            cuts = [(a, min(a + BLOCK, b)) for s, b in zip(edges, edges[1:]) for a in range(s, b, BLOCK)]
            for a, b in cuts[:-1]:
                yield row(f.iloc[a:b], part << 32 | seq)
                seq += 1
            rest = f.iloc[cuts[-1][0] :] if cuts else rest
        if rest is not None and len(rest):
            yield row(rest, part << 32 | seq)

    def row(f: pd.DataFrame, block: int) -> pd.DataFrame:
        x = np.stack(f["embedding"].to_numpy())
        y = _unit(x.astype(np.float64)) @ along[int(f["d"].iat[0])]
        one = {"block": block, "label": f["label"].iat[0], "d": f["d"].iat[0], "lo": y.min(axis=0).tolist(), "hi": y.max(axis=0).tolist()}
        one |= {"ids": f["cid"].to_numpy().tobytes(), "ns": f["n"].to_numpy().tobytes(), "xs": x.tobytes(), "wide": x.dtype == np.float64}
        return pd.DataFrame([one])

    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    types = dict(vectors.dtypes)
    return dealt.mapInPandas(pack, f"block long, label {types['label']}, d int, lo array<double>, hi array<double>, ids binary, ns binary, xs binary, wide boolean").checkpoint()


def _near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """``(a, b)``, a <= b: blocks of one label and length whose boxes are within eps; they meet by equal grid cells of the first two axes."""
    cells = lambda k, wide: F.sequence(F.floor(F.get("lo", F.lit(k)) / eps).cast("int") - wide, F.floor(F.get("hi", F.lit(k)) / eps).cast("int") + wide)
    meta = blocks.select("block", "label", "d", "lo", "hi").withColumns({"lo": F.when(F.size("lo") > 1, F.col("lo")).otherwise(F.array_repeat(F.get("lo", F.lit(0)), 2)), "hi": F.when(F.size("hi") > 1, F.col("hi")).otherwise(F.array_repeat(F.get("hi", F.lit(0)), 2))})
    cover = lambda wide: meta.withColumn("u", F.explode(cells(0, wide))).withColumn("v", F.explode(cells(1, wide)))
    a = cover(0).select(F.col("block").alias("a"), "label", "d", "u", "v", F.col("lo").alias("la"), F.col("hi").alias("ha"))
    b = cover(1).select(F.col("block").alias("b"), "label", "d", "u", "v", F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    gap = F.zip_with(F.zip_with("la", "hb", lambda x, y: x - y), F.zip_with("lb", "ha", lambda x, y: x - y), lambda p, q: F.greatest(p, q, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    return a.join(b, ["label", "d", "u", "v"]).filter((F.col("a") <= F.col("b")) & (apart <= eps * eps)).select("a", "b").distinct()


def _meet(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, same: bool, least: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between two sequences (or inside one): the recursive join."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def join(a: int, b: int, c: int, d: int) -> None:
        gap = np.maximum(np.maximum(px[a:b].min(0) - py[c:d].max(0), py[c:d].min(0) - px[a:b].max(0)), 0)
        if (gap * gap).sum() > eps * eps:
            return
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= least)
            i, j = i + a, j + c
            if same:
                i, j = i[i < j], j[i < j]
            found.append((i, j))
        elif b - a >= d - c:
            m = (a + b) // 2
            join(a, m, c, d)
            if not same or d > m:
                join(m, b, c, d)
        else:
            m = (c + d) // 2
            if not same or m > a:
                join(a, b, c, m)
            join(a, b, m, d)

    join(0, len(x), 0, len(y))
    return np.concatenate([i for i, _ in found] or [np.zeros(0, int)]), np.concatenate([j for _, j in found] or [np.zeros(0, int)])


def link_counts(vectors: DataFrame, least: float) -> DataFrame:
    """Over distinct vectors (``cid``, ``n`` rows each, ``label``, ``d``, ``embedding``): ``(cid, links, root)``, several
    rows per vector; links add up to the rows of directly linked other vectors, roots are links enough to connect what links."""
    spark = vectors.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)) * (1 + 1e-9) + 1e-9)
    along = axes(vectors)
    blocks = _blocks(vectors, along, eps)
    pairs = _near_blocks(blocks, eps)
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("d", "ids", "ns", "xs", "wide")])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x, y = (_unit(np.frombuffer(r[f"xs_{s}"], np.float64 if r[f"wide_{s}"] else np.float32).astype(np.float64).reshape(-1, r[f"d_{s}"])) for s in "ab")
                same = r["a"] == r["b"]
                i, j = _meet(x, y, x @ along[r["d_a"]], y @ along[r["d_b"]], same, least, eps)
                ids, ns = (np.frombuffer(r[f"{c}_a"], np.int64) if same else np.concatenate([np.frombuffer(r[f"{c}_{s}"], np.int64) for s in "ab"]) for c in ("ids", "ns"))
                j = j if same else j + len(x)
                order = np.argsort(ids, kind="stable")  # the smallest index is then the smallest id
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                i, j, ids, ns = rank[i], rank[j], ids[order], ns[order]
                links = np.bincount(i, ns[j], len(ids)).astype(np.int64) + np.bincount(j, ns[i], len(ids)).astype(np.int64)
                at = np.flatnonzero(links)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at]), pa.array(ids[local_roots(len(ids), i, j)[at]])], ["cid", "links", "root"])

    tasks = pairs.join(side("a"), "a").join(side("b"), "b")
    conf, key = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(PAIRS_AT_ONCE))  # a row holds two blocks
    try:
        return tasks.mapInArrow(solve, "cid long, links long, root long").checkpoint()
    finally:
        conf.set(key, before)


def groups(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of one label and length with cosine ``least`` or more link. Equal vectors are one node, so a group
    of copies costs one comparison; their rows count each other. Null labels and vectors that are
    null, empty, zero or hold null or non-finite components link with nothing. A repeated id is a row
    like any other; a null id is kept only if its component is null too.
    """
    checkpoint_root(vectors.sparkSession)
    v = spread(vectors.select("vec_id", "embedding", "label")).withColumn("_ok", usable(F.col("embedding"), F.col("label")))
    named = v.withColumns({"_h1": F.when(F.col("_ok"), F.xxhash64("label", "embedding")), "_h2": F.when(F.col("_ok"), F.xxhash64(F.lit(1), "embedding", "label"))})
    classes = named.filter("_ok").groupBy("_h1", "_h2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"))
    classes = classes.withColumn("cid", F.coalesce("first", "_h1")).checkpoint()
    met = link_counts(classes.select("cid", "n", "label", F.size("embedding").alias("d"), "embedding"), least)
    total = met.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(met.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    own = classes.select("_h1", "_h2", "cid", "n", "first").join(total, "cid", "left").join(comp, F.col("cid") == comp["node"], "left").withColumn("root", F.coalesce("root", "cid"))
    # a class without any id stands under a hash; a component with such a class takes its name from the others
    odd = own.filter("first is null").select("root").distinct()
    names = own.join(odd, "root", "left_semi").groupBy("root").agg(F.min("first").alias("name")).withColumn("odd", F.lit(True))
    own = own.join(names, "root", "left")
    name = F.when(F.col("odd"), F.col("name")).otherwise(F.col("root"))
    own = own.select("_h1", "_h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), name.alias("component_id"))
    out = named.select("vec_id", "_h1", "_h2").join(own, ["_h1", "_h2"], "left")
    comp_id = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.col("vec_id").eqNullSafe(comp_id).alias("kept"))


SQL = """
WITH RECURSIVE ok AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM ok),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
r AS (SELECT x AS s, y AS t FROM l UNION SELECT r.s, l.y FROM r JOIN l ON r.t = l.x),
c AS (SELECT s, min(t) AS low FROM r GROUP BY s),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.s = vec_id"""


@query("op2_embedding_dedup", SQL)
def op2_embedding_dedup(t):
    """Links and components of all vectors at cosine 0.93."""
    return groups(t.embeddings, 0.93)
