"""Line dedup with a tree of log templates.

A line is parsed to a fixed depth: its number of tokens, then its leading tokens, name a leaf. Tokens with
digits are variable fields from the start. In a leaf, a token is constant at its place if a few lines of the leaf
have it there, however large the leaf is; every other token is a variable field too, and what stays constant is
the line's template. Templates (and lines as they are) that two or more documents share are dropped
everywhere but in the document where they come first.

The first pass writes hashes and positions of the lines, nothing else. All that follows works on distinct lines,
so a line that a third of all documents share is one row per task before it is shuffled and one row afterwards.
Tokens are shuffled only for leaves that hold different lines of different documents.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm.base import bitmap, marked, query, row_key, spread
from colonnade.session import checkpoint_root

#: What separates tokens, and the mark of a variable field.
BLANKS, FIELD = r"[\t\x0B\f\r ]+", "<*>"
#: In a line whose tokens stand at single spaces: a space at its start or end, and a token with a digit (found from the token's start only).
EDGE, DIGITS = r" (?![^\n])|(?<![^\n]) ", r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+"
#: Leading tokens on the way to a leaf.
DEPTH = 3
#: Lines of a leaf that make a token constant at its place.
SUPPORT = 3
#: A template with generalised fields needs so many constant tokens and such a share of them; one with fields masked by digits only, that share.
LEAST_CONSTANT, GENERAL_SHARE, MASKED_SHARE = 5, 0.7, 0.5
BITMAP_WORDS = 1 << 15


def _lines(docs: DataFrame, some=None, *carry: Column) -> DataFrame:
    """Per row: the row keys, ``o`` (which document comes first) and ``lines``, structs of ``i``, ``n``, ``lead``, ``t0``, ``line`` of its lines that hold tokens.

    ``line`` has the tokens, fields masked, at single spaces. ``some`` keeps lines by ``n`` and ``lead`` before more is done with them; it may use the ``carry`` columns.
    """
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), *[c.alias(n) for n, c in row_key(F.col("doc_id"), F.col("text").cast("string")).items()])
    # a whole text is brought to single spaces and masked at once, and only if it needs it: its lines are then compared and hashed as they are, without a list of tokens each
    text = F.col("_text")
    uneven = reduce(or_, [text.contains(b) for b in ("\t", "\x0b", "\f", "\r", "  ", " \n", "\n ")]) | text.startswith(" ") | text.endswith(" ")
    own = spread(own).withColumn("_even", F.when(uneven, F.regexp_replace(F.regexp_replace(text, BLANKS, " "), EDGE, "")).otherwise(text))
    own = own.withColumn("_masked", F.when(F.col("_even").rlike("[0-9]"), F.regexp_replace("_even", DIGITS, FIELD)))
    raw = F.split("_even", "\n")
    pairs = F.when(F.col("_masked").isNull(), F.transform(raw, lambda x: F.struct(x.alias("raw"), x.alias("line")))).otherwise(F.zip_with(raw, F.split("_masked", "\n"), lambda x, y: F.struct(x.alias("raw"), y.alias("line"))))
    full = F.filter(F.transform(pairs, lambda s, i: F.struct(i.alias("i"), s["raw"].alias("raw"), s["line"].alias("line"))), lambda s: s["raw"] != "")
    space, none = F.lit(" "), F.lit("")
    counted = F.transform(full, lambda s: F.struct(s["i"], s["raw"], s["line"], (F.octet_length(s["raw"]) - F.octet_length(F.replace(s["raw"], space, none)) + 1).alias("n")))
    placed = F.transform(counted, lambda s: F.struct(s["i"], s["raw"], s["line"], s["n"], F.xxhash64(s["n"], F.substring_index(s["line"], " ", DEPTH)).alias("lead")))
    if some is not None:
        placed = F.filter(placed, some)
    # a line without a digit is its own mask
    plain = lambda s: (s["raw"] == s["line"]) | (F.size(F.array_remove(F.split(s["line"], " "), FIELD)) >= MASKED_SHARE * s["n"])
    named = F.transform(placed, lambda s: F.struct(s["i"], s["n"], s["lead"], F.xxhash64(F.when(plain(s), s["line"]).otherwise(s["raw"])).alias("t0"), s["line"]))
    last = F.lit((1 << 63) - 1)  # rows without id come last and count as one document
    return own.withColumns({f"_c{i}": c for i, c in enumerate(carry)}).select("_k1", "_k2", F.coalesce(F.col("doc_id").cast("long"), last).alias("o"), named.alias("lines"))


def _single(rows: DataFrame, *cols: str) -> DataFrame:
    """One row per line: the columns ``cols`` and the fields of ``lines``.

    An outer explode, as Spark derives a filter on the list's size from an inner one and, pushed to the scan, it would parse every text twice.
    """
    return rows.select(*cols, F.explode_outer("lines").alias("s")).filter("s is not null").select(*cols, "s.*")


def _open_lines(docs: DataFrame, open_: Column) -> DataFrame:
    """The lines of the leaves in the bitmap ``open_`` that are long enough for a template."""
    near = _lines(docs, lambda s: (s["n"] > LEAST_CONSTANT) & marked(s["lead"], F.col("_c0"), BITMAP_WORDS), open_)
    return _single(near, "o")


def _templates(near: DataFrame) -> DataFrame:
    """``lead``, ``t0``, ``first``: lines whose template two documents share, from lines (``lead``, ``t0``, ``n``, ``o``, ``line``) of open leaves."""
    lines = near.groupBy("lead", "t0").agg(F.min("o").alias("first"), F.max("o").alias("last"), F.count(F.lit(1)).alias("c"), F.any_value("n").alias("n"), F.any_value("line").alias("line")).checkpoint()
    key = F.transform(F.split("line", " "), lambda w, p: F.when((p >= DEPTH) & (w != FIELD), F.xxhash64("lead", p, w)))
    placed = lines.select("lead", "t0", "c", F.explode(F.array_compact(key)).alias("key"))
    often = placed.groupBy("key").agg(F.sum("c").alias("support")).filter(F.col("support") >= SUPPORT).select("key")
    # the places of a line differ, so no key can cancel another one in the exclusive or
    hits = placed.join(often, "key").groupBy("lead", "t0").agg(F.bit_xor("key").alias("x"), F.bit_xor(F.xxhash64("key")).alias("y"), F.count(F.lit(1)).alias("hits"))
    head = F.size(F.array_remove(F.split(F.substring_index("line", " ", DEPTH), " "), FIELD))
    named = lines.select("lead", "t0", "first", "last", "n", head.alias("head")).join(hits, ["lead", "t0"], "left")
    constant = F.col("head") + F.coalesce("hits", F.lit(0))
    named = named.filter((constant >= LEAST_CONSTANT) & (constant >= GENERAL_SHARE * F.col("n")))
    named = named.select("lead", "t0", "first", "last", F.xxhash64("lead", "x", "y", "hits").alias("t1"))
    shared = named.groupBy("lead", "t1").agg(F.min("first").alias("first"), F.max("last").alias("last")).filter("first <> last")
    return named.select("lead", "t0", "t1").join(shared.select("lead", "t1", "first"), ["lead", "t1"]).select("lead", "t0", "first")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """Lines to drop: row keys, ``drop`` (the numbers of the lines) for every row that loses one."""
    checkpoint_root(docs.sparkSession)
    rows = _lines(docs)
    marks = rows.select("_k1", "_k2", "o", F.transform("lines", lambda s: F.struct(s["i"], s["n"], s["lead"], s["t0"])).alias("lines")).checkpoint()
    once = F.array_distinct(F.transform("lines", lambda s: F.struct(s["lead"], s["t0"], s["n"])))
    seen = marks.select("o", F.explode(once).alias("s")).groupBy("s.lead", "s.t0", "s.n").agg(F.min("o").alias("first"), F.max("o").alias("last")).checkpoint()
    leaves = seen.filter(F.col("n") > LEAST_CONSTANT).groupBy("lead").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.lit(1)).alias("kinds"))
    open_ = bitmap(leaves.filter("first <> last and kinds > 1").select("lead"), BITMAP_WORDS)
    near = _open_lines(docs, open_)
    exact = seen.filter("first <> last").select("lead", "t0", "first")
    known = exact.union(_templates(near)).groupBy("lead", "t0").agg(F.min("first").alias("first")).checkpoint()
    some = marks.withColumn("_known", bitmap(known.select("t0"), BITMAP_WORDS))
    some = some.select("_k1", "_k2", "o", F.filter("lines", lambda s: marked(s["t0"], F.col("_known"), BITMAP_WORDS)).alias("lines"))
    some = _single(some, "_k1", "_k2", "o").select("_k1", "_k2", "o", "i", "lead", "t0")
    return some.join(known, ["lead", "t0"]).filter("o <> first").groupBy("_k1", "_k2").agg(F.collect_set("i").alias("drop"))


def dedup_lines(docs: DataFrame, report: bool = False) -> DataFrame:
    """``docs`` without the lines of recurring templates, except in the document (smallest id) where a template comes first.

    Two documents make a line or template recur. A document that has no token left goes, since all it held stands elsewhere. With ``report`` it
    stays, and the result is ``row`` (a struct of the columns), ``n_lines``, ``n_dropped`` and ``gone``. Blank lines
    and null texts are left alone; rows alike in id and text get the same decision; rows of one id, and all rows without id, count as one
    document, the latter come last. ``doc_id`` is an integer. ``n_chars``, if there, counts the new text. Columns of any name are carried.
    """
    cols = docs.columns
    keys = row_key(F.col("doc_id"), F.col("text"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), *[c.alias(n) for n, c in keys.items()])
    out = named.join(dropped_lines(docs), ["_k1", "_k2"], "left")
    lines = F.split(F.col("row.text"), "\n")
    # the text is split once for a row, not once for each line it keeps
    left = lambda ls: F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "drop")
    cut = F.get(F.transform(F.array(lines), lambda ls: F.array_join(F.transform(left(ls), lambda i: F.get(ls, i)), "\n")), 0)
    text = F.when(F.col("drop").isNotNull(), cut).otherwise(F.col("row.text"))
    # the new text takes another name first: inside the lambda above, "text" must be the old one
    out = out.select("row", "drop", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), text.alias("new"))
    gone = F.col("drop").isNotNull() & ~F.col("new").rlike(r"[^\n\t\x0B\f\r ]")
    count = F.when(F.col("drop").isNotNull(), F.length("new").cast("long"))
    own = {"text": F.col("new"), **({"n_chars": F.coalesce(count, F.col("row.n_chars"))} if "n_chars" in cols else {})}
    fields = [own.get(c, F.col("row").getField(c)).alias(c) for c in cols]
    if report:
        return out.select(F.struct(*fields).alias("row"), "n_lines", F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), gone.alias("gone"))
    return out.filter(~gone).select(*fields)


def line_sql(table: str) -> str:
    """SQL for ``dedup_lines(report=True)`` over ``table``: doc_id, new text, n_lines, n_dropped, gone."""
    blank = r"[\t\x0B\f\r ]+"
    return f"""
ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(generate_series(0, len(string_split(coalesce(text, ''), chr(10))) - 1)) AS i FROM {table}),
tk AS (SELECT doc_id, i, list_filter(string_split_regex(line, '{blank}'), lambda x: x <> '') AS raw FROM ln),
mk AS (SELECT doc_id, i, raw, len(raw) AS n, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS tokens FROM tk WHERE len(raw) > 0),
pl AS (SELECT doc_id, i, n, tokens, list_slice(tokens, 1, {DEPTH}) AS head, CASE WHEN len(list_filter(tokens, lambda x: x <> '{FIELD}')) >= {MASKED_SHARE} * n THEN tokens ELSE raw END AS t0 FROM mk),
ex AS (SELECT n, head, t0, any_value(tokens) AS tokens, min(doc_id) AS first, max(doc_id) AS last, count(*) AS c FROM pl GROUP BY n, head, t0),
tp AS (SELECT n, head, p, token FROM (SELECT n, head, c, p, tokens[p] AS token FROM (SELECT n, head, c, tokens, unnest(generate_series({DEPTH + 1}, n)) AS p FROM ex WHERE n > {LEAST_CONSTANT})) GROUP BY n, head, p, token HAVING sum(c) >= {SUPPORT} AND token <> '{FIELD}'),
fx AS (SELECT n, head, list(p || ':' || token) AS fixed FROM tp GROUP BY n, head),
ge AS (SELECT ex.*, list_filter(list_transform(tokens, lambda x, p: p || ':' || x), lambda x: list_contains(coalesce(fixed, []), x)) AS hit, len(list_filter(ex.head, lambda x: x <> '{FIELD}')) AS own FROM ex LEFT JOIN fx ON ex.n = fx.n AND ex.head = fx.head WHERE ex.n > {LEAST_CONSTANT}),
sp AS (SELECT * FROM ge WHERE len(hit) + own >= {LEAST_CONSTANT} AND len(hit) + own >= {GENERAL_SHARE} * n),
sh AS (SELECT n, head, hit, min(first) AS first1 FROM sp GROUP BY n, head, hit HAVING min(first) <> max(last)),
kn AS (SELECT n, head, t0, min(first) AS first FROM (SELECT n, head, t0, first FROM ex WHERE first <> last UNION ALL SELECT sp.n, sp.head, sp.t0, first1 FROM sp JOIN sh ON sh.n = sp.n AND sh.head = sp.head AND sh.hit = sp.hit) GROUP BY n, head, t0),
dr AS (SELECT pl.doc_id, pl.i FROM pl JOIN kn ON kn.n = pl.n AND kn.head = pl.head AND kn.t0 = pl.t0 WHERE first <> pl.doc_id),
ls AS (SELECT doc_id, count(*) AS n_dropped FROM dr GROUP BY doc_id),
kp AS (SELECT ln.doc_id, string_agg(line, chr(10) ORDER BY ln.i) FILTER (WHERE dr.i IS NULL) AS text, count(*) AS n_lines FROM ln LEFT JOIN dr ON dr.doc_id = ln.doc_id AND dr.i = ln.i GROUP BY ln.doc_id),
lined AS (SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kp.text, '') END AS text, d.lang, d.source, CASE WHEN ls.doc_id IS NULL THEN d.n_chars ELSE length(coalesce(kp.text, '')) END AS n_chars,
  CASE WHEN d.text IS NULL THEN 0 ELSE kp.n_lines END AS n_lines, coalesce(n_dropped, 0) AS n_dropped, ls.doc_id IS NOT NULL AND NOT regexp_matches(coalesce(kp.text, ''), '[^\n\t\x0B\f\r ]') AS gone
  FROM {table} d JOIN kp ON kp.doc_id = d.doc_id LEFT JOIN ls ON ls.doc_id = d.doc_id)"""


@query("op8_line_dedup", f"WITH {line_sql('documents').strip()}\nSELECT doc_id, text, n_chars::bigint AS n_chars, n_lines::bigint AS n_lines, n_dropped::bigint AS n_dropped, NOT gone AS kept FROM lined")
def op8_line_dedup(t):
    """Every document with the lines it keeps, and whether it stays."""
    out = dedup_lines(t.documents, report=True)
    return out.select("row.doc_id", "row.text", "row.n_chars", "n_lines", "n_dropped", (~F.col("gone")).alias("kept"))
