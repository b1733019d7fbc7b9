"""Benchmark decontamination: word windows of the test items, looked up in every document.

The windows of the benchmark form a hash set that is broadcast while its size is bounded. Every
window of a document is hashed where the document lies; a bitmap of the set's hashes (of bounded
size, false alarms only) drops nearly all of them there, the rest meet the set by hash *and* words.
Only built-in functions run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm.base import LOWER, UPPER, ascii_lower, bitmap, marked, query, row_key, spread

#: What separates words (ASCII without digits and letters), before and after lower-casing.
BETWEEN_LOWERED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The set is broadcast up to this many windows (about 200 bytes each); beyond, it is joined by shuffle.
BROADCAST_WINDOWS = 500_000
#: 64-bit words of the bitmap at least and at most (256 kB; a larger set only lets more windows through to the join).
BITMAP_WORDS = (1 << 12, 1 << 15)


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), BETWEEN_LOWERED), "")


def benchmark_windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """One row per distinct window: its words ``win``, ``hash``, ``k`` words, and the ``items`` that hold it.

    A window is ``width`` consecutive words; an item of fewer words, but not none, is one window.
    """
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    n = F.greatest(F.size("w") - width, F.lit(0))
    wins = w.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice("w", i + 1, width))).alias("win"))
    return wins.groupBy("win").agg(F.collect_set("item_id").alias("items")).select("win", F.xxhash64("win").alias("hash"), F.size("win").alias("k"), "items")


def _sketch(hashes: Column, i: Column | int, k: int) -> Column:
    """A cheap hash of the ``k`` words from ``i`` on: that of the first, the middle and the last one."""
    first, mid, last = (F.get(hashes, F.lit(i) + d if isinstance(i, int) else i + d) for d in (0, k // 2, k - 1))
    return first.bitwiseXOR(F.shiftleft(mid, 1)).bitwiseXOR(F.shiftrightunsigned(last, 1))


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _sketches(windows: DataFrame, sizes: list[int]) -> DataFrame:
    own = F.coalesce(*[F.when(F.col("k") == k, _sketch(F.col("h"), 0, k)) for k in sizes])
    return windows.select("k", _word_hashes(F.col("win")).alias("h")).select(own.alias("sketch"))


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the ``carry`` columns, ``_n_words``, ``_spans`` of hit words and the ``_items`` found.

    ``_spans`` are sorted distinct ``(pos, k)``: ``k`` words from word ``pos`` on equal a window; they may
    overlap. A null text has no words. Repeated rows each keep their own row; a repeated ``item_id``
    is one item; items without id mark words but are not listed. An empty benchmark marks nothing.
    """
    windows = benchmark_windows(benchmark, width)
    sizes = {r["k"]: r["n"] for r in windows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``width`` rows
    total = sum(sizes.values())
    w = spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"), F.monotonically_increasing_id().alias("_rid"), words(F.col("text")).alias("_w"))
    w = w.withColumn("_n_words", F.size("_w").cast("long"))
    if not total:
        return w.select("_row.*", "_n_words", F.expr("cast(array() as array<struct<pos:int,k:int>>)").alias("_spans"), F.expr("cast(array() as array<bigint>)").alias("_items"))
    size = min(max(BITMAP_WORDS[0], 1 << (total // 4).bit_length()), BITMAP_WORDS[1])
    w = w.withColumns({"_bits": bitmap(_sketches(windows, sorted(sizes)), size), "_hashes": _word_hashes(F.col("_w"))})
    w = w.withColumns({f"_s{k}": F.when(F.size("_w") >= k, F.transform(F.sequence(F.lit(0), F.size("_w") - k), lambda i: _sketch(F.col("_hashes"), i, k))) for k in sizes})

    def found(k: int) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size("_w") - k), lambda i: marked(F.get(f"_s{k}", i), F.col("_bits"), size))
        cand = F.transform(at, lambda i: F.struct(i.alias("pos"), F.slice("_w", i + 1, k).alias("win")))
        return F.when(F.size("_w") >= k, cand).otherwise(F.expr("cast(array() as array<struct<pos:int,win:array<string>>>)"))

    cand = w.select("_row", "_rid", "_n_words", F.explode_outer(reduce(F.concat, [found(k) for k in sorted(sizes)])).alias("_c"))
    cand = cand.select("_row", "_rid", "_n_words", F.col("_c.pos").alias("_pos"), F.col("_c.win").alias("_win"), F.xxhash64("_c.win").alias("_hash"))
    known = F.broadcast(windows) if total <= BROADCAST_WINDOWS else windows
    met = cand.join(known, (F.col("_hash") == F.col("hash")) & (F.col("_win") == F.col("win")), "left")
    per = met.groupBy("_rid").agg(
        F.any_value("_row").alias("_row"),
        F.any_value("_n_words").alias("_n_words"),
        F.array_sort(F.collect_set(F.when(F.col("k").isNotNull(), F.struct(F.col("_pos").alias("pos"), "k")))).alias("_spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"),
    )
    return per.select("_row.*", "_n_words", "_spans", "_items")


def covered(spans: Column) -> Column:
    """Number of words inside at least one of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        start,
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["pos"] + s["k"] - F.greatest(a["end"], s["pos"]))).alias("n"), F.greatest(a["end"], s["pos"] + s["k"]).alias("end")),
        lambda a: a["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, cut: bool = False) -> DataFrame:
    """``docs`` without the documents that hold a window, or with the hit words cut out (``cut``).

    A cut leaves the other words with the separators before them, and ``n_chars``, if there, counts
    the new text. Columns and untouched rows stay as they are; null and empty texts are clean.
    """
    cols = docs.columns
    # texts stay out of the candidates: hits travel under the row key, and rows alike in id and text share one
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), *[c.alias(n) for n, c in row_key(F.col("doc_id"), F.col("text")).items()])
    found = hits(own.select("_k1", "_k2", "_row.text"), benchmark, width, ("_k1", "_k2")).filter(F.size("_spans") > 0)
    if not cut:
        return own.join(found.select("_k1", "_k2"), ["_k1", "_k2"], "left_anti").select("_row.*")
    found = found.groupBy("_k1", "_k2").agg(F.any_value("_spans").alias("_spans"))
    raw = F.array_remove(F.split("_row.text", BETWEEN), "")
    gaps = F.split("_row.text", rf"[^{BETWEEN[1:-2]}]+")
    inside = lambda i: F.exists("_spans", lambda s: (s["pos"] <= i) & (i < s["pos"] + s["k"]))
    kept = F.filter(F.sequence(F.lit(0), F.size(raw) - 1), lambda i: ~inside(i))
    text = F.concat(F.array_join(F.transform(kept, lambda i: F.concat(F.get(gaps, i), F.get(raw, i))), ""), F.element_at(gaps, -1))
    hit = F.col("_spans").isNotNull()
    new = {"text": F.when(hit, text).otherwise(F.col("_row.text"))}
    if "n_chars" in cols:
        new["n_chars"] = F.when(hit, F.length(new["text"]).cast("long")).otherwise(F.col("_row.n_chars"))
    return own.join(found, ["_k1", "_k2"], "left").select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in cols])


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS k FROM bw),
dw AS (SELECT rid, i, k, list_slice(w, i, i + k - 1) AS win FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, lens WHERE len(w) >= k)),
m AS (SELECT rid, i, k, item_id FROM dw JOIN bw USING (win)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS s FROM m GROUP BY rid)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""


@query("op7_decontamination", SQL)
def op7_decontamination(t):
    """Hit words and items per document, windows of ten words."""
    f = hits(t.documents, t.benchmark)
    ids = F.array_sort(F.transform("_items", lambda x: x.cast("string")))
    return f.select(
        "doc_id", F.col("_n_words").alias("n_words"), covered(F.col("_spans")).alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
    )
