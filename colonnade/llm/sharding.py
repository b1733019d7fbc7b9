"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many places on a ring of 64-bit hashes; a row belongs to the first place clockwise from
the hash of its id. A shard takes rows up to its bound, then rows go on clockwise to the next
place whose shard has room. Rows claim in the order of the ring, so what an arc between two
places does depends on row *counts* alone: they are summed before anything is shuffled, the
ring (of fixed size) is filled from the sums, and every row finds its place by its rank in its arc.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.llm.base import query, spread
from colonnade.operators.ordered import sliced

#: Places of each shard on the ring.
VIRTUAL_NODES = 128


@dataclass
class Ring:
    """Places in ring order: their positions (signed 64-bit) and the shards they belong to."""

    positions: np.ndarray
    shards: np.ndarray

    @classmethod
    def of(cls, shards: int, nodes: int = VIRTUAL_NODES) -> Ring:
        at = sorted({int(np.uint64(xxhash.xxh64_intdigest(f"shard {s} node {v}", 7)).astype(np.int64)): s for s in range(shards) for v in range(nodes)}.items())
        return cls(np.array([p for p, _ in at], np.int64), np.array([s for _, s in at], np.int64))

    def arcs(self, positions: np.ndarray) -> np.ndarray:
        """Number of the first place at or after each position; past the last place an arc of its own that starts over at the first."""
        return np.searchsorted(self.positions, positions)


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold: the mean and ``slack`` of it, rounded up; without slack, counts at most one apart."""
    if slack > 0:
        return [int(np.ceil(total * (1 + slack) / shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def fill(ring: Ring, counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Segments ``(arc, low, high, shard, first slot)``: rows of an arc with ranks in [low, high) go to ``shard`` from that slot on."""
    room, used, out, n = list(room), [0] * len(room), [], len(ring.positions)
    for arc in sorted(counts):
        low, left, at = 0, counts[arc], arc % n
        while left:
            s = int(ring.shards[at])
            take = min(left, room[s])
            if take:
                out.append((arc, low, low + take, s, used[s]))
                room[s], used[s], low, left = room[s] - take, used[s] + take, low + take, left - take
            at = (at + 1) % n
    return out


def assign(df: DataFrame, key: str, shards: int, slack: float = 0.0, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``row`` (a struct of ``df``'s columns, so no name clashes), ``shard`` and ``slot`` (0, 1, ... inside each shard).

    The key's hash places a row; a null key has a hash too. Rows of one key stand next to each other in
    the ring, told apart by their row number in the input, and overflow like others, so a key that
    holds a third of the rows is spread over several shards. Rows are numbered in a checkpointed range order.
    The driver sees the sums of ``shards x nodes`` arcs, never more.
    """
    ring = Ring.of(shards, nodes)

    @F.pandas_udf("int")
    def arc(p: pd.Series) -> pd.Series:
        return pd.Series(ring.arcs(p.to_numpy()).astype(np.int32))

    own = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    placed = spread(df).select(own, F.xxhash64(key).alias("_pos"), F.monotonically_increasing_id().alias("_row"))
    rows = sliced(placed.withColumn("_arc", arc("_pos")), ["_pos", "_row"])
    part = rows.groupBy("_arc", "_slice").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    counts = {r["_arc"]: r["n"] for r in part.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}  # one row per arc at most
    segments = fill(ring, counts, bounds(sum(counts.values()), shards, slack))
    before = W.partitionBy("_arc").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    part = part.select("_arc", "_slice", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_add"))
    spark = df.sparkSession
    plan = spark.createDataFrame(segments, "_arc int, _low long, _high long, _shard int, _base long")  # at most arcs x shards rows
    ranked = rows.join(part, ["_arc", "_slice"]).withColumn("_rank", F.col("_seq") + F.col("_add"))
    met = ranked.join(F.broadcast(plan), "_arc").filter((F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
    return met.select("row", F.col("_shard").alias("shard"), (F.col("_base") + F.col("_rank") - F.col("_low")).alias("slot"))


@query("op3_ring_shards")
def op3_ring_shards(t):
    """All documents in eight shards, counts at most one apart."""
    text = F.col("text").cast("binary")
    narrow = t.documents.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = assign(narrow, "doc_id", 8)
    return out.select("row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
