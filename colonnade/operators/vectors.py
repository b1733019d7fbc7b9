"""Nearest neighbours of vectors in many dimensions.

Exact: every vector belongs to its nearest reference point and lies in a block of vectors at like distances from it. The
triangle inequality turns the distances of a block to all reference points into a least distance between two blocks. A
vector's own block bounds its search radius, the nearest blocks shrink it, and a block farther away than the
radius of all its vectors is never opened; what is left unopened is proven not to matter.

Approximate: several tables of keys, a key being the sides of random hyperplanes that a vector lies on. A query looks into its
own bucket and those across the planes nearest to it. Buckets are cut into blocks, so a hot one is dealt to many tasks.

In both, equal vectors are one site that keeps its ``k + 1`` smallest ids, blocks are compared as matrices inside a
task, and distances are the sums of squared differences in double precision. Vectors that are null, empty or hold null or
non-finite components have no neighbours and are none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.operators.ordered import sliced, with_position
from colonnade.operators.relational import top_rows_per_key
from colonnade.session import checkpoint_root

#: Vectors of a block; reference points; vectors that they and the planes' origin are chosen from.
BLOCK, REFERENCES, SAMPLE = 256, 32, 2000
#: Blocks that shrink the radius first; slots of distances that a cell is cut into.
FIRST, SLOTS = 4, 64
#: Pairs of blocks in one Arrow batch; bytes of a group of blocks.
PAIRS_AT_ONCE, GROUP_BYTES = 64, 1 << 25
_SLACK = 1 + 1e-9


def sites(df: DataFrame, id: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """``(members, sites)``: every usable row with the hashes of its vector, and one row per vector with its ``k + 1`` smallest ids."""
    v = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))  # turns -0.0 into 0.0
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(F.col(id).alias("id"), v.alias("v")).filter("id is not null and v is not null and size(v) > 0").filter(~bad)
    named = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    few = top_rows_per_key(named, ["h1", "h2"], [F.col("id")], k + 1, "_r")
    merged = few.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.any_value("v").alias("v"))
    return named.select("id", "h1", "h2"), merged.withColumn("sid", F.col("ids")[0])


def bounded_sample(s: DataFrame, n: int = SAMPLE) -> np.ndarray:
    """At most ``n`` vectors, those with the smallest hashes; one length only (the most common)."""
    got = [r["v"] for r in s.select("h1", "v").orderBy("h1").limit(n).collect()]
    if not got:
        return np.zeros((0, 1))
    lengths = [len(v) for v in got]
    common = max(sorted(set(lengths)), key=lengths.count)
    return np.array([v for v in got if len(v) == common])


def far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """Reference points: each is the sample's vector farthest from those taken before."""
    taken, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(taken) < min(n, len(sample)) and gap.max() > 0:
        taken.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[taken[-1]]) ** 2).sum(axis=1))
    return sample[taken]


def _lists(column: pa.Array, width: int | None = None) -> list[np.ndarray]:
    """The lists of an Arrow column as numpy views."""
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    parts = [flat[a:b] for a, b in zip(ends, ends[1:])]
    return parts if width is None else [p.reshape(-1, width) for p in parts]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * (x @ y.T), 0)


def nearest_in(x: np.ndarray, ids: np.ndarray, reach: np.ndarray, y: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the rows of ``x``, up to ``k`` nearest rows of ``y`` within ``reach`` and other than themselves: ids, neighbours, squared distances.

    The product of the matrices picks candidates with some to spare; what counts is the sum of squared differences.
    """
    rough = _squares(x, y)
    limit = reach**2 * _SLACK + 1e-9 * (1 + (x * x).sum(axis=1) + (y * y).sum(axis=1).max(initial=0))
    some = np.flatnonzero((rough <= limit[:, None]).any(axis=1))
    rough = rough[some]
    m = min(len(y), k + 8)
    near = np.argpartition(rough, m - 1, axis=1)[:, :m] if m < len(y) else np.broadcast_to(np.arange(len(y)), rough.shape)
    fine = (np.take_along_axis(rough, near, axis=1) <= limit[some, None]) & (others[near] != ids[some, None])
    d2 = np.where(fine, ((x[some, None] - y[near]) ** 2).sum(axis=2), np.inf)
    best = np.lexsort((others[near], ~fine, d2), axis=-1)[:, :k]
    row, place = np.nonzero(np.take_along_axis(fine, best, axis=1))
    at = best[row, place]
    return ids[some[row]], others[near[row, at]], d2[row, at]


@dataclass
class Meetings:
    """Pairs of blocks to compare: ``pairs`` (``a``, ``z``), and the ``blocks`` (``block``, its group ``g``, ``ids``, ``xs``, ``reach``)."""

    pairs: DataFrame
    blocks: DataFrame

    def count(self) -> int:
        return self.pairs.count()


def _meet(met: Meetings, dim: int, k: int) -> DataFrame:
    """``_compare`` for pairs among the same blocks: two groups of blocks meet in one task, so a block travels once for each group and not for each pair."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        plain = lambda t, n: t.column(n).combine_chunks()
        held = dict(zip(plain(right, "z").to_pylist(), zip(_lists(plain(right, "xs"), dim), _lists(plain(right, "ids")))))
        out = []
        for x, ids, reach, zs in zip(_lists(plain(left, "xs"), dim), _lists(plain(left, "ids")), _lists(plain(left, "reach")), plain(left, "zs").to_pylist()):
            sid, nid, d2 = (np.concatenate(c) for c in zip(*[nearest_in(x, ids, reach, *held[z], k) for z in zs]))
            order = np.lexsort((nid, d2, sid))
            sid, nid, d2 = sid[order], nid[order], d2[order]
            fresh = np.flatnonzero(np.diff(sid, prepend=sid[:1] - 1))
            kept = np.arange(len(sid)) - np.repeat(fresh, np.diff(fresh, append=len(sid))) < k
            out.append((sid[kept], nid[kept], d2[kept]))
        return pa.table([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["sid", "nid", "d2"])

    own = lambda n, g: met.blocks.select(F.col("block").alias(n), F.col("g").alias(g))
    named = met.pairs.select("a", "z").join(own("a", "ga"), "a").join(own("z", "gz"), "z")
    asking = named.groupBy("a", "ga", "gz").agg(F.collect_list("z").alias("zs")).join(met.blocks.select(F.col("block").alias("a"), "ids", "xs", "reach"), "a")
    held = named.select("z", F.col("ga").alias("ha"), F.col("gz").alias("hz")).distinct().join(met.blocks.select(F.col("block").alias("z"), "ids", "xs"), "z")
    return asking.groupBy("ga", "gz").cogroup(held.groupBy("ha", "hz")).applyInArrow(run, "sid long, nid long, d2 double").checkpoint()


def _compare(pairs: DataFrame | Meetings, dim: int, k: int) -> DataFrame:
    """Solve pairs of blocks (``ids``, ``xs``, ``reach`` against ``ids_b``, ``xs_b``): ``sid``, ``nid``, ``d2``, at most ``k`` per vector and pair. Runs at once."""
    if isinstance(pairs, Meetings):
        return _meet(pairs, dim, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for x, ids, reach, y, others in zip(_lists(b.column("xs"), dim), _lists(b.column("ids")), _lists(b.column("reach")), _lists(b.column("xs_b"), dim), _lists(b.column("ids_b"))):
                found.append(nearest_in(x, ids, reach, y, others, k))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in range(3)], ["sid", "nid", "d2"])

    conf, key = pairs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(PAIRS_AT_ONCE))  # a row holds two blocks
    try:
        return pairs.select("ids", "xs", "reach", "ids_b", "xs_b").mapInArrow(run, "sid long, nid long, d2 double").checkpoint()
    finally:
        conf.set(key, before)


def _blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (``sid``, ``v``, ...) packed by ``keys``: ``ids`` ascending and ``xs``, the vectors one after another."""
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("sid", "v"))).alias("p"))
    return packed.select(*keys, F.transform("p", lambda p: p["sid"]).alias("ids"), F.flatten(F.transform("p", lambda p: p["v"])).alias("xs"))


def _answers(members: DataFrame, s: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """From nearest sites to ``(id, rank, neighbour, dist)`` of every member: a site's other ids come first, at distance 0."""
    named = found.join(s.select(F.col("sid").alias("nid"), "ids"), "nid").select("sid", "d2", F.explode("ids").alias("neighbour"))
    own = s.select("sid", F.lit(0.0).alias("d2"), F.explode("ids").alias("neighbour"))
    best = top_rows_per_key(named.unionByName(own), ["sid"], [F.col("d2"), F.col("neighbour")], k + 1, "_r")
    lists = best.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("d2", "neighbour"))).alias("best"))
    each = members.join(s.select("h1", "h2", "sid").join(lists, "sid"), ["h1", "h2"])
    others = F.slice(F.filter("best", lambda b: b["neighbour"] != F.col("id")), 1, k)
    return each.select("id", F.posexplode(others).alias("rank", "b")).select("id", (F.col("rank") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), F.sqrt("b.d2").alias("dist"))


def knn_join(df: DataFrame, id: str, vector: str, k: int, references: int = REFERENCES, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest other rows of every row, exactly: ``(id, rank, neighbour, dist)``, ties by id.

    ``id`` is an integer and unique. Vectors are compared with others of the sample's most common length; all should have one length.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    members, s = sites(df, id, vector, k)
    s = s.checkpoint()
    points = bounded_sample(s)
    if not len(points):
        return members.select("id", F.lit(1).alias("rank"), F.col("id").alias("neighbour"), F.lit(0.0).alias("dist")).limit(0)
    dim, points = points.shape[1], far_apart(points, references)
    p = len(points)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            away = np.sqrt(((x[:, None] - points[None]) ** 2).sum(axis=2)) if len(x) < 64 else np.sqrt(np.stack([((x - q) ** 2).sum(axis=1) for q in points], axis=1))
            cell = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("sid"), b.column("v"), pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(x)), cell]), pa.FixedSizeListArray.from_arrays(pa.array(away.ravel()), p).cast(pa.list_(pa.float64()))], ["sid", "v", "cell", "own", "away"])

    placed = s.filter(F.size("v") == dim).select("sid", "v").mapInArrow(place, "sid long, v array<double>, cell int, own double, away array<double>")
    order = sliced(placed, ["cell", "own", "sid"]).withColumn("b", F.floor(F.col("_seq") / block))
    # in each cell the (k + 1)-th smallest distance to the reference point: nobody has to look farther than there and back
    close = top_rows_per_key(order.select("cell", "own", "sid"), ["cell"], [F.col("own"), F.col("sid")], k + 1, "_r")
    cells = {r["cell"]: r for r in order.groupBy("cell").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).join(close.groupBy("cell").agg(F.max("own").alias("kth"), F.count(F.lit(1)).alias("n")), "cell").collect()}
    there = np.array([cells[c]["kth"] if c in cells and cells[c]["n"] > k else np.inf for c in range(p)])
    low, high = (np.array([cells[c][e] if c in cells else d for c in range(p)]) for e, d in (("lo", 1.0), ("hi", 0.0)))
    width = np.maximum((high - low) / SLOTS, 1e-300)

    packed = order.groupBy("_slice", "cell", "b").agg(F.array_sort(F.collect_list(F.struct("sid", "v", "away"))).alias("p"))
    one = lambda f: F.transform("p", lambda x: x[f])
    packed = packed.select("cell", F.xxhash64("_slice", "cell", "b").alias("block"), one("sid").alias("ids"), F.flatten(one("v")).alias("xs"), F.flatten(one("away")).alias("away"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reach, lo, hi = [], [], []
            for x, away in zip(_lists(b.column("xs"), dim), _lists(b.column("away"), p)):
                r = (away + there[None]).min(axis=1)
                if len(x) > k:
                    own = _squares(x, x)
                    np.fill_diagonal(own, np.inf)
                    error = 1e-9 * (1 + 2 * (x * x).sum(axis=1).max())
                    r = np.minimum(r, np.sqrt(np.partition(own, k - 1, axis=1)[:, k - 1] + error))
                reach.append(r)
                lo.append(away.min(axis=0))
                hi.append(away.max(axis=0))
            cols = [pa.array(c, type=pa.list_(pa.float64())) for c in (reach, lo, hi)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("block", "cell", "ids", "xs")), *cols], ["block", "cell", "ids", "xs", "reach", "lo", "hi"])

    blocks = packed.mapInArrow(measure, "block long, cell int, ids array<long>, xs array<double>, reach array<double>, lo array<double>, hi array<double>").checkpoint()
    # groups of neighbouring blocks: enough for all cores, and no more vectors in one than a task holds with ease
    rows = s.count()
    groups = max(math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)), math.ceil(rows * dim * 8 / GROUP_BYTES))
    size = blocks.select("block", "cell", F.get("lo", F.col("cell")).alias("from"))
    total = size.agg(F.count(F.lit(1))).scalar()
    group = with_position(size, ["cell", "from", "block"], "at").select("block", F.floor(F.col("at") * groups / total).alias("g")).checkpoint()

    facts = blocks.select("block", "cell", "lo", "hi", F.array_max("reach").alias("far"))
    constant = lambda a: F.array(*[F.lit(float(x)) for x in a])
    slot = lambda d, c: F.floor((d - F.get(constant(low), c)) / F.get(constant(width), c))
    # a block meets the slots of every cell that its ring, widened by its radius, touches
    ring = facts.select(F.col("block").alias("a"), "lo", "hi", "far", F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("c"))
    ring = ring.select("a", "lo", "hi", "far", "c", F.greatest(F.get("lo", F.col("c")) - F.col("far"), F.get(constant(low), F.col("c"))).alias("from"), F.least(F.get("hi", F.col("c")) + F.col("far"), F.get(constant(high), F.col("c"))).alias("to"))
    ring = ring.filter(F.col("from") <= F.col("to")).withColumn("s", F.explode(F.sequence(slot(F.col("from"), F.col("c")), slot(F.col("to"), F.col("c")))))
    own = lambda e: F.get(e, F.col("cell"))
    lies = facts.select(F.col("block").alias("z"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), F.col("cell").alias("c"), F.explode(F.sequence(slot(own("lo"), F.col("cell")), slot(own("hi"), F.col("cell")))).alias("s"))
    met = ring.join(lies, ["c", "s"])
    gap = F.array_max(F.zip_with(F.zip_with("lo", "hi_b", lambda x, y: x - y), F.zip_with("lo_b", "hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y)))
    pairs = met.withColumn("gap", F.greatest(gap, F.lit(0.0))).filter(F.col("gap") <= F.col("far") * _SLACK + 1e-9).select("a", "z", "gap").distinct().checkpoint()

    first = top_rows_per_key(pairs, ["a"], [F.col("a") != F.col("z"), F.col("gap"), F.col("z")], FIRST, "_r").checkpoint()
    near = _compare(Meetings(first, blocks.select("block", "ids", "xs", "reach").join(group, "block")), dim, k)

    # the k-th best so far is the new radius; blocks beyond it stay closed
    kth = top_rows_per_key(near, ["sid"], [F.col("d2"), F.col("nid")], k, "_r").groupBy("sid").agg(F.max("d2").alias("d2"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    each = blocks.select("block", F.explode("ids").alias("sid")).join(kth, "sid")
    known = each.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("sid", F.sqrt("d2").alias("r")))).alias("known"))
    shrunk = F.transform(F.arrays_zip("ids", "reach"), lambda e: F.least(e["reach"], F.coalesce(F.try_element_at("known", e["ids"]), e["reach"])))
    tight = blocks.join(known, "block", "left").select("block", "ids", "xs", shrunk.alias("reach")).checkpoint()
    far = tight.select(F.col("block").alias("a"), F.array_max("reach").alias("far"))
    rest = pairs.join(first.select("a", "z"), ["a", "z"], "left_anti").join(far, "a").filter(F.col("gap") <= F.col("far") * _SLACK + 1e-9)
    far = _compare(Meetings(rest.select("a", "z"), tight.join(group, "block")), dim, k)
    return _answers(members, s, near.unionByName(far), k)


def _sides(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables * bits, dim))


def knn_hyperplanes(df: DataFrame, id: str, vector: str, k: int, asked: Column | None = None, tables: int = 16, probes: int = 12, bucket: int = 64, seed: int = 7) -> DataFrame:
    """Nearly the ``k`` nearest other rows of the rows that ``asked`` selects (all without it): ``(id, rank, neighbour, dist)``.

    ``bucket`` is the mean size of a bucket: the number of planes of a table is the logarithm of the rows divided by it, so a query meets about
    ``tables * probes * bucket`` rows however many there are. The planes pass through the mean of a bounded sample; every row is indexed. Rows of an
    uncommon vector length are left out.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    members, s = sites(df, id, vector, k)
    s = s.checkpoint()
    sample = bounded_sample(s)
    if not len(sample):
        return members.select("id", F.lit(1).alias("rank"), F.col("id").alias("neighbour"), F.lit(0.0).alias("dist")).limit(0)
    dim, centre = sample.shape[1], sample.mean(axis=0)
    bits = int(min(40, max(1, round(np.log2(max(2.0, s.count() / bucket))))))
    planes = _sides(dim, tables, bits, seed)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            away = ((x - centre) @ planes.T).reshape(len(x), tables, bits)
            key = (away > 0) @ power
            # all buckets that differ in up to two of the nearest planes, the likeliest first
            close = np.argsort(np.abs(away), axis=2)[:, :, : min(bits, 8)]
            cost = np.take_along_axis(away**2, close, axis=2)
            flip = power[close]
            one, two = list(range(close.shape[2])), [(i, j) for j in range(close.shape[2]) for i in range(j)]
            costs = np.concatenate([np.zeros_like(cost[:, :, :1]), cost] + [cost[:, :, i : i + 1] + cost[:, :, j : j + 1] for i, j in two], axis=2)
            flips = np.concatenate([np.zeros_like(flip[:, :, :1]), flip] + [flip[:, :, i : i + 1] ^ flip[:, :, j : j + 1] for i, j in two], axis=2)
            best = np.argsort(costs, axis=2, kind="stable")[:, :, : min(probes, 1 + len(one) + len(two))]
            looks = key[:, :, None] ^ np.take_along_axis(flips, best, axis=2)
            keys = pa.ListArray.from_arrays(np.arange(0, key.size + 1, tables, dtype=np.int32), pa.array(key.ravel()))
            look = pa.ListArray.from_arrays(np.arange(0, looks.size + 1, looks.shape[1] * looks.shape[2], dtype=np.int32), pa.array(looks.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("sid"), b.column("ids"), b.column("v"), keys, look, pa.array(np.full(len(x), looks.shape[2], np.int32))], ["sid", "ids", "v", "keys", "looks", "per"])

    keyed = s.filter(F.size("v") == dim).select("sid", "ids", "v").mapInArrow(index, "sid long, ids array<long>, v array<double>, keys array<long>, looks array<long>, per int").checkpoint()

    def dealt(rows: DataFrame) -> DataFrame:
        """Blocks of at most about ``BLOCK`` rows of each bucket, whatever the bucket's size."""
        sizes = rows.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))
        parts = F.ceil(F.col("n") / BLOCK)
        rows = rows.join(sizes.filter(F.col("n") > BLOCK).select("table", "key", parts.alias("parts")), ["table", "key"], "left")
        return _blocks(rows.withColumn("part", F.pmod(F.xxhash64("sid"), F.coalesce("parts", F.lit(1)))), ["table", "key", "part"])

    held = dealt(keyed.select("sid", "v", F.posexplode("keys").alias("table", "key")))
    wanted = members if asked is None else members.join(df.filter(asked).select(F.col(id).alias("id")), "id", "left_semi")
    heads = wanted.select("h1", "h2").distinct().join(s.select("h1", "h2", "sid"), ["h1", "h2"]).select("sid")
    looking = keyed.join(heads, "sid", "left_semi").select("sid", "v", "per", F.posexplode("looks").alias("place", "key"))
    seeking = dealt(looking.select("sid", "v", F.floor(F.col("place") / F.col("per")).cast("int").alias("table"), "key"))
    seeking = seeking.select("table", "key", "ids", "xs", F.transform("ids", lambda i: F.lit(float("inf"))).alias("reach"))
    pairs = seeking.join(held.select("table", "key", F.col("ids").alias("ids_b"), F.col("xs").alias("xs_b")), ["table", "key"])
    found = _compare(pairs, dim, k).distinct()
    return _answers(wanted, s, found, k)
