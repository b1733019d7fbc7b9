"""SimHash near-duplicates found through tables of distances to reference fingerprints.

Two fingerprints within ``max_bits`` differ at most that much in their distance to any reference
(triangle inequality). The tables are used twice:

* References *restricted to a block* of the fingerprint index the join. Cut into ``max_bits + 1``
  blocks, two fingerprints that link agree on at least one block, so in that block every coordinate
  differs by 0: rows meet only where all distances of a block are equal, and a pair that meets
  nowhere has been discarded by its coordinates.
* References over the whole fingerprint discard the pairs that meet: sorted by the first distance,
  only rows within ``max_bits`` of each other are paired, each further distance thins them out, and
  the survivors are verified bit by bit.

Nothing is capped: a bucket of any size is cut into parts, and every pair of parts is a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm.base import query, row_key, spread
from colonnade.llm.components import components, local_roots
from colonnade.session import checkpoint_root

SEED = 42
#: References over the whole fingerprint, and for each block.
PIVOTS, BLOCK_PIVOTS = 12, 16
#: Fingerprints in a part of a bucket; two parts meet in one task.
PART = 1024
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 14


def _mix(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit references."""
    return np.array([xxhash.xxh64_intdigest(f"reference {salt} {i}", SEED) for i in range(n)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit number.

    A-Z are lowered, words are separated by blanks (space and 0x09-0x0D), ``shingle`` consecutive
    words form a shingle (all words, if fewer), repeats count. A bit is 1 if it is set in more than half of
    the shingles' XXH64. No words: zero.
    """
    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII blanks are meant
    if not w:
        return 0
    if len(w) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(w), SEED)).astype(np.int64))
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), len(w) - shingle + 1
    for at in range(0, n, CHUNK):
        part = w[at : at + CHUNK + shingle - 1]
        h = np.array([digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)))], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row with its fingerprint ``fp`` (long). Null and empty texts: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(x, shingle) for x in b.column("_text").to_pylist()], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), fp], [*keep, "fp"])

    src = spread(docs.withColumn("_text", F.col("text").cast("string")).select(*keep, "_text"))
    types = dict(src.dtypes)
    return src.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), "fp long"]))


def _block_masks(blocks: int) -> list[int]:
    edge = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:])]


def block_keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and block: ``block`` and ``dists``, the distances to the block's references."""
    keys = []
    for i, mask in enumerate(_block_masks(max_bits + 1)):
        refs = [int((int(r) & mask) - (1 << 64) if (int(r) & mask) >> 63 else int(r) & mask) for r in _mix(BLOCK_PIVOTS, i + 1)]
        signed = mask - (1 << 64) if mask >> 63 else mask
        d = [F.bit_count(F.col("fp").bitwiseAND(F.lit(signed)).bitwiseXOR(F.lit(r))) for r in refs]
        keys.append(F.struct(F.lit(i).alias("block"), F.xxhash64(*d).alias("dists")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.block", "k.dists")


def _pairs(fp: np.ndarray, side: np.ndarray | None, max_bits: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one task: rows of either side with each other, or all rows if ``side`` is None."""
    order = np.argsort(np.bitwise_count(fp ^ refs[0]), kind="stable")
    v = fp[order]
    table = np.bitwise_count(v[:, None] ^ refs[None, :]).astype(np.int8)
    end = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    span = end - np.arange(len(v)) - 1
    out: list[tuple[np.ndarray, np.ndarray]] = []
    edges = np.searchsorted(np.cumsum(span), np.arange(0, span.sum() + 1, 1 << 20)).tolist() + [len(v)]
    for a, b in zip(edges, edges[1:]):
        s = span[a:b]
        i = np.repeat(np.arange(a, b), s)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(s) - s, s)
        if side is not None:
            x = side[order]
            ok = x[i] != x[j]
            i, j = i[ok], j[ok]
        for c in range(1, len(refs)):
            ok = np.abs(table[i, c] - table[j, c]) <= max_bits
            i, j = i[ok], j[ok]
        ok = np.bitwise_count(v[i] ^ v[j]) <= max_bits
        out.append((order[i[ok]], order[j[ok]]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def links(fps: DataFrame, max_bits: int = 4, part: int = PART) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``fp``, distinct), enough to connect whatever links.

    Inside a task, linked fingerprints are returned as a star around the smallest, so a group of
    ``n`` near copies yields at most ``n - 1`` rows from each task, never its pairs.
    """
    checkpoint_root(fps.sparkSession)
    keyed = block_keys(fps, max_bits)
    counts = keyed.groupBy("block", "dists").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(part)).cast("int")
    met = keyed.join(counts, ["block", "dists"]).withColumn("s", parts).withColumn("p", F.pmod(F.xxhash64("fp", F.lit("part")), "s").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
    met = met.select("fp", "block", "dists", "p", other.alias("o"))
    unit = [F.col("block"), F.col("dists"), F.least("p", "o").alias("lo"), F.greatest("p", "o").alias("hi")]
    tasks = met.select(F.xxhash64("block", "dists", F.least("p", "o"), F.greatest("p", "o")).alias("unit"), *unit, "fp", "p")
    refs = _mix(PIVOTS, 0)

    def solve(u: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        fp = np.sort(u["fp"].to_numpy())
        side = None
        if u["lo"].iat[0] != u["hi"].iat[0]:
            order = np.argsort(u["fp"].to_numpy(), kind="stable")
            side = (u["p"].to_numpy() == u["lo"].to_numpy())[order]
        i, j = _pairs(fp.view(np.uint64), side, max_bits, refs)
        root = local_roots(len(fp), i, j)
        at = np.flatnonzero(root != np.arange(len(fp)))
        return fp[at], fp[root[at]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for u in _whole_groups(frames, ["unit", "block", "dists", "lo", "hi"]):
            a, b = solve(u)
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})

    dealt = tasks.repartition("unit").sortWithinPartitions("unit", "block", "dists", "lo", "hi")
    return dealt.mapInPandas(run, "a long, b long")


def _whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows that are alike in ``keys``, from frames sorted by them; holds one frame and one group."""
    rest = None
    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        k = f[keys].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        at = [0, *cut.tolist()]
        for a, b in zip(at, at[1:]):
            yield f.iloc[a:b]
        rest = f.iloc[at[-1] :]
    if rest is not None and len(rest):
        yield rest


def groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest ``doc_id`` reachable) and the row keys, one row per document.

    Equal fingerprints are one node, so a group of copies of any size is one row in the search.
    A null ``doc_id`` never is a component's id while another id is there; a component of
    nothing but nulls has a null id. Texts without words have fingerprint zero and link like any other.
    """
    checkpoint_root(docs.sparkSession)
    own = docs.select("doc_id", "text", *[c.alias(n) for n, c in row_key(F.col("doc_id"), F.col("text")).items()])
    rows = fingerprints(own, shingle, ("doc_id", "_k1", "_k2")).checkpoint()
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    comp = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(comp, nodes["fp"] == comp["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(low, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id", "_k1", "_k2")


def simhash_dedup(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one whose id is the component's.

    Of rows repeated under that id one stays, the one with the smallest text hash. Documents
    without id stay unless they link to one with an id; of a group of nothing but nulls one text stays. All columns are kept.
    """
    g = groups(docs, shingle, max_bits)
    mine = g.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = mine.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("f")).agg(F.min(F.struct("_k1", "_k2")).alias("k"))
    keys = best.select("k._k1", "k._k2")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in row_key(F.col("doc_id"), F.col("text")).items()])
    keyed = named.join(keys, ["_k1", "_k2"], "left_semi")
    repeated = g.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        keyed = keyed.dropDuplicates(["_k1", "_k2"])
    return keyed.select("row.*")


@query("op9_simhash")
def op9_simhash(t):
    """Fingerprints of four-word shingles, linked at four bits or fewer."""
    return groups(t.documents, 4, 4).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
