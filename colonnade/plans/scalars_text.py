"""String and regular-expression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions import text as tx
from colonnade.registry import query

_W = r"string_split({c}, ' ')"


@query(
    "str_case",
    """SELECT p_partkey, lower(p_brand) AS lo, upper(p_name) AS up, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS cap,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS title,
       translate(p_brand, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz') AS swapped FROM part""",
)
def str_case(t):
    return t.part.select(
        "p_partkey", F.lower("p_brand").alias("lo"), F.upper("p_name").alias("up"), tx.capitalise(F.col("p_name")).alias("cap"),
        F.initcap("p_name").alias("title"), tx.swap_case(F.col("p_brand")).alias("swapped"),
    )


@query(
    "str_strip",
    """SELECT o_orderkey, trim(s) AS b, ltrim(s) AS l, rtrim(s) AS r, trim(k, '0') AS zeros FROM
       (SELECT o_orderkey, '  ' || o_orderpriority || ' ' AS s, '000' || o_orderkey || '0' AS k FROM orders)""",
)
def str_strip(t):
    s = F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))
    k = F.concat(F.lit("000"), "o_orderkey", F.lit("0"))
    return t.orders.select("o_orderkey", F.trim(s).alias("b"), F.ltrim(s).alias("l"), F.rtrim(s).alias("r"), F.btrim(k, F.lit("0")).alias("zeros"))


@query(
    "str_pad",
    """SELECT s_suppkey, lpad(s, 10, '0') AS zfill, rpad(s, 6, '.') AS left_just, lpad(s, 6, '.') AS right_just,
       repeat('*', (7 - length(s)) // 2) || s || repeat('*', 7 - length(s) - (7 - length(s)) // 2) AS centre FROM (SELECT s_suppkey, s_suppkey::VARCHAR AS s FROM supplier)""",
)
def str_pad(t):
    s = F.col("s_suppkey").cast("string")
    return t.supplier.select(
        "s_suppkey", tx.pad_left(s, 10, "0").alias("zfill"), tx.pad_right(s, 6, ".").alias("left_just"), tx.pad_left(s, 6, ".").alias("right_just"),
        tx.centred(s, 7, "*").alias("centre"),
    )


@query(
    "str_find",
    """SELECT p_partkey, (instr(p_name, 'l') - 1)::INT AS first, CASE WHEN instr(reverse(p_name), 'l') > 0 THEN length(p_name) - instr(reverse(p_name), 'l') ELSE -1 END::INT AS last,
       (instr(p_name, 'bolt') - 1)::INT AS bolt FROM part""",
)
def str_find(t):
    c = F.col("p_name")
    return t.part.select("p_partkey", tx.find(c, "l").alias("first"), tx.rfind(c, "l").alias("last"), tx.find(c, "bolt").alias("bolt"))


@query("str_starts_ends", "SELECT p_partkey, starts_with(p_name, 'sm') AS s, ends_with(p_name, 'ring') AS e FROM part")
def str_starts_ends(t):
    return t.part.select("p_partkey", F.startswith("p_name", F.lit("sm")).alias("s"), F.endswith("p_name", F.lit("ring")).alias("e"))


@query(
    "str_replace",
    "SELECT p_partkey, replace(p_name, 'red', 'green') AS lit, regexp_replace(p_brand, '[0-9]+', '<n>', 'g') AS rex FROM part",
)
def str_replace(t):
    return t.part.select("p_partkey", F.replace("p_name", F.lit("red"), F.lit("green")).alias("lit"), F.regexp_replace("p_brand", "[0-9]+", "<n>").alias("rex"))


@query("str_translate", "SELECT p_partkey, translate(p_name, 'aeiou', '12345') AS v FROM part")
def str_translate(t):
    return t.part.select("p_partkey", F.translate("p_name", "aeiou", "12345").alias("v"))


# ASCII character classes
_CLASSES = {
    "alpha": "^[A-Za-z]+$", "digit": "^[0-9]+$", "alnum": "^[A-Za-z0-9]+$", "space": "^[ \\t\\n]+$", "lower": "^[^A-Z]*[a-z][^A-Z]*$",
    "upper": "^[^a-z]*[A-Z][^a-z]*$", "title": "^[^A-Za-z]*([A-Z][a-z]*[^A-Za-z]*)+$", "numeric": "^[0-9]+$", "decimal": "^[0-9]+$",
}


@query(
    "str_class_tests",
    "SELECT event_id, " + ", ".join(f"regexp_matches(s, '{p}') AS is{n}" for n, p in _CLASSES.items())
    + " FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type) WHEN 2 THEN user_id::VARCHAR WHEN 3 THEN ' ' ELSE 'Ab' || user_id END AS s FROM events)",
)
def str_class_tests(t):
    s = F.expr("CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type) WHEN 2 THEN cast(user_id as string) WHEN 3 THEN ' ' ELSE concat('Ab', user_id) END")
    return t.events.select("event_id", s.alias("s")).select("event_id", *[F.rlike("s", F.lit(p)).alias(f"is{n}") for n, p in _CLASSES.items()])


@query("str_length", "SELECT doc_id, length(text)::INT AS n FROM documents")
def str_length(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query(
    "str_split",
    """SELECT doc_id, len(regexp_split_to_array(text, '[ \\t\\n]+'))::INT AS n_ws, len(string_split(text, ','))::INT AS n_comma, len(regexp_split_to_array(text, '[.;] ?'))::INT AS n_rex,
       len(string_split(text, chr(10)))::INT AS n_lines, string_split(text, ' ')[1] AS first FROM documents""",
)
def str_split(t):
    c = F.col("text")
    return t.documents.select(
        "doc_id", F.size(F.split(c, "[ \\t\\n]+")).alias("n_ws"), F.size(F.split(c, ",")).alias("n_comma"), F.size(F.split(c, "[.;] ?")).alias("n_rex"),
        F.size(F.split(c, "\n")).alias("n_lines"), F.split(c, " ")[0].alias("first"),
    )


@query(
    "str_partition",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS head, ' ' AS sep, substr(p_name, instr(p_name, ' ') + 1) AS tail FROM part",
)
def str_partition(t):
    c = F.col("p_name")
    return t.part.select("p_partkey", F.substring_index(c, " ", 1).alias("head"), F.lit(" ").alias("sep"), F.substr(c, F.instr(c, " ") + 1).alias("tail"))


@query("str_get_last", "SELECT p_partkey, string_split(p_name, ' ')[-1] AS last FROM part")
def str_get_last(t):
    return t.part.select("p_partkey", F.element_at(F.split("p_name", " "), -1).alias("last"))


@query("str_slice", "SELECT doc_id, substr(text, 1, 3) AS head, substr(text, 6, 10) AS mid, 'XY' || substr(text, 4) AS patched FROM documents")
def str_slice(t):
    return t.documents.select("doc_id", F.substring("text", 1, 3).alias("head"), F.substring("text", 6, 10).alias("mid"),
                              F.overlay("text", F.lit("XY"), 1, 3).alias("patched"))


@query(
    "str_join_cat",
    "SELECT p_partkey, p_brand || '--' || p_type AS pair, array_to_string(list_reverse(string_split(p_name, ' ')), '-') AS rev FROM part",
)
def str_join_cat(t):
    return t.part.select("p_partkey", F.concat_ws("--", "p_brand", "p_type").alias("pair"), F.array_join(F.reverse(F.split("p_name", " ")), "-").alias("rev"))


@query("str_repeat", "SELECT p_partkey, repeat(p_type, (p_size % 4)::INT) AS v FROM part")
def str_repeat(t):
    return t.part.select("p_partkey", F.repeat("p_type", F.col("p_size") % 4).alias("v"))


@query("str_normalize", "SELECT doc_id, nfc_normalize(text) AS v FROM documents")
def str_normalize(t):
    return t.documents.select("doc_id", tx.unicode_nfc("text").alias("v"))


@query("str_wrap", r"SELECT item_id, rtrim(regexp_replace(text, '(.{1,40})(?:\s+|$)', '\1' || chr(10), 'g'), chr(10)) AS v FROM benchmark")
def str_wrap(t):
    return t.benchmark.select("item_id", tx.wrapped(F.col("text"), 40).alias("v"))


@query(
    "str_contains",
    "SELECT doc_id, regexp_matches(text, '[Tt]he ') AS the, regexp_matches(text, '(?i)license') AS license FROM documents",
)
def str_contains(t):
    return t.documents.select("doc_id", F.rlike("text", F.lit("[Tt]he ")).alias("the"), F.rlike("text", F.lit("(?i)license")).alias("license"))


@query("str_match", "SELECT c_custkey, regexp_matches(c_name, '^Customer#[0-9]*7$') AS m FROM customer")
def str_match(t):
    return t.customer.select("c_custkey", F.rlike("c_name", F.lit("^Customer#[0-9]*7$")).alias("m"))


@query(
    "str_extract",
    "SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/]+)/', 1) AS host FROM pages",
)
def str_extract(t):
    return t.pages.select("page_id", F.regexp_extract("url", "^(https?)://", 1).alias("scheme"), F.regexp_extract("url", "://([^/]+)/", 1).alias("host"))


_URL = "^(https?)://([^/]+)/([a-z]+)/([0-9]+)"


@query(
    "str_extract_named",
    "SELECT page_id, " + ", ".join(f"regexp_extract(url, '{_URL}', {i}) AS {n}" for i, n in enumerate(["scheme", "host", "lang", "item"], 1)) + " FROM pages",
)
def str_extract_named(t):
    groups = F.struct(*[F.regexp_extract("url", _URL, i).alias(n) for i, n in enumerate(["scheme", "host", "lang", "item"], 1)])
    return t.pages.select("page_id", groups.alias("g")).select("page_id", "g.*")


@query(
    "str_findall",
    """SELECT page_id, array_to_string(regexp_extract_all(html, 'href="([^"]*)"', 1), '|') AS links FROM pages""",
)
def str_findall(t):
    return t.pages.select("page_id", F.array_join(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)), "|").alias("links"))


@query("str_count", "SELECT doc_id, len(regexp_extract_all(text, '[Tt]h'))::INT AS n FROM documents")
def str_count(t):
    return t.spread("documents").select("doc_id", F.regexp_count("text", F.lit("[Tt]h")).alias("n"))


_MAIL = r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


@query(
    "str_mask_email",
    f"SELECT doc_id, regexp_replace(text, '{_MAIL}', '[address]', 'g') AS text, len(regexp_extract_all(text, '{_MAIL}'))::INT AS n FROM documents",
)
def str_mask_email(t):
    return t.documents.select("doc_id", tx.mask_emails(F.col("text")).alias("text"), tx.count_emails(F.col("text")).alias("n"))


@query(
    "str_format",
    "SELECT l_orderkey, l_linenumber, printf('%.3f', l_quantity / 8) AS f3, printf('WEC-%02d', l_linenumber) AS label FROM lineitem",
)
def str_format(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.format_string("%.3f", F.col("l_quantity") / 8).alias("f3"),
                             F.format_string("WEC-%02d", "l_linenumber").alias("label"))


@query(
    "str_clean_labels",
    """SELECT p_partkey, 'WEC-' || CASE WHEN length(n) < 2 THEN '0' || n ELSE n END AS label FROM
       (SELECT p_partkey, (regexp_extract(CASE p_partkey % 4 WHEN 0 THEN '  wec_0' || p_size || '  ' WHEN 1 THEN 'WEC-' || p_size WHEN 2 THEN 'converter 0' || p_size ELSE 'WEC_' || p_size END, '([0-9]+)', 1)::INT)::VARCHAR AS n FROM part)""",
)
def str_clean_labels(t):
    messy = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat('  wec_0', p_size, '  ') WHEN 1 THEN concat('WEC-', p_size) WHEN 2 THEN concat('converter 0', p_size) ELSE concat('WEC_', p_size) END")
    return t.part.select("p_partkey", tx.clean_sensor_label(messy).alias("label"))


@query(
    "str_time_parse",
    "SELECT event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::INT AS secs FROM events",
)
def str_time_parse(t):
    return t.events.select("event_id", tx.clock_seconds(F.date_format("ts", "HH:mm:ss")).alias("secs"))
