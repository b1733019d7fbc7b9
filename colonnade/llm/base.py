"""What the operators of this subpackage share: table reading, query registration, row keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Share of the labelled rows that is held out: crc32 of the id's text modulo this is 0.
FOLDS = 5


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with the SQL that states the same rows."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def held_out(c: Column) -> Column:
    """Whether a row is held out from learning: crc32 of the id as text, modulo ``FOLDS``, is 0.

    A null id has no remainder and counts as held out, so nothing is learned from it.
    """
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def hashed_sample(rows: DataFrame, group: str, key: str, per_group: int) -> DataFrame:
    """``rows`` of at most ``per_group`` keys of each ``group`` value: those whose hashes are smallest.

    Counts of the groups (one row per value on the driver) give a hash bound that about twice as many
    rows pass, so a group of any size sends only these to its ranking. Null keys and groups are left out.
    """
    rows = rows.filter(F.col(group).isNotNull() & F.col(key).isNotNull()).withColumn("_at", F.pmod(F.xxhash64(key), F.lit(1 << 31)))
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()
    bounds = [F.when(F.col(group) == F.lit(r[group]), F.lit(int(min(1.0, 2 * per_group / r["n"]) * (1 << 31)))) for r in sizes]
    if not bounds:
        return rows.drop("_at")
    first = W.partitionBy(group).orderBy("_at", key)
    ranked = rows.filter(F.col("_at") < F.coalesce(*bounds)).withColumn("_rank", F.row_number().over(first))
    return ranked.filter(F.col("_rank") <= per_group).drop("_at", "_rank")


def row_key(doc_id: Column, text: Column) -> dict[str, Column]:
    """Two 64-bit hashes that name a row by id and text; rows with equal id and text share it.

    Decisions travel back to the rows under this key, so a null or repeated id needs no special
    case: rows alike in both columns get the same decision.
    """
    return {"_k1": F.xxhash64(doc_id.isNull(), doc_id), "_k2": F.xxhash64(text.isNull(), text)}


def spread(df: DataFrame) -> DataFrame:
    """An input of fewer splits than cores is dealt out to all of them; a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def bitmap(hashes: DataFrame, words: int) -> Column:
    """The longs of the only column of ``hashes`` as a bitmap of ``words`` (a power of two) 64-bit words.

    A scalar subquery of fixed size, whatever the number of hashes: a filter with false alarms only,
    to drop rows where they lie before an exact join. Put it into a column of its own.
    """
    h = hashes.toDF("h").filter("h is not null")
    slot = F.shiftrightunsigned("h", 6).bitwiseAND(words - 1)
    bits = h.groupBy(slot.cast("int").alias("s")).agg(F.bit_or(F.expr("shiftleft(1L, int(h & 63))")).alias("b"))
    full = h.sparkSession.range(words).select(F.col("id").cast("int").alias("s")).join(bits, "s", "left").select("s", F.coalesce("b", F.lit(0)).alias("b"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("s", "b"))), lambda x: x["b"]).alias("bits")).scalar()


def marked(hash_: Column, bits: Column, words: int) -> Column:
    """Whether the bitmap may hold a hash."""
    word = F.get(bits, F.shiftrightunsigned(hash_, 6).bitwiseAND(words - 1).cast("int"))
    return F.getbit(word, hash_.bitwiseAND(63).cast("int")) == 1
