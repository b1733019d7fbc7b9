"""Projection, selection, filtering and positional access."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators.ordered import with_position
from colonnade.operators.relational import (
    accumulate_positions,
    add_or_keep,
    first_per_key,
    hash_sample,
    last_write_wins,
    lookup_values,
    matrix_cells,
    pick_positions,
)
from colonnade.registry import query


@query("select_column", "SELECT o_totalprice FROM orders")
def select_column(t):
    return t.orders.select("o_totalprice")


@query("select_columns_list", "SELECT o_orderkey, o_totalprice FROM orders")
def select_columns_list(t):
    return t.orders.select(*["o_orderkey", "o_totalprice"])


@query(
    "with_column",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price FROM lineitem",
)
def with_column(t):
    return t.lineitem.withColumn(
        "unit_price", F.try_divide("l_extendedprice", "l_quantity")
    ).select("l_orderkey", "l_linenumber", "unit_price")


@query("drop_column", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def drop_column(t):
    return t.supplier.drop("s_name")


@query("rename_columns", "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def rename_columns(t):
    return t.supplier.withColumnsRenamed(
        {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"}
    )


@query(
    "cast_column",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, TRY_CAST(o_orderpriority AS INT) AS bad_int,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS prio FROM orders""",
)
def cast_column(t):
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderpriority").try_cast("int").alias("bad_int"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"),
    )


@query(
    "filter_compare",
    """SELECT p_partkey, p_size FROM part WHERE p_size < 40 AND p_size > 3 AND p_size <= 38 AND p_size >= 5
       AND p_size <> 20 AND p_brand = 'Brand#17'""",
)
def filter_compare(t):
    s = F.col("p_size")
    return t.part.filter((s < 40) & (s > 3) & (s <= 38) & (s >= 5) & (s != 20) & (F.col("p_brand") == "Brand#17")).select(
        "p_partkey", "p_size"
    )


@query(
    "filter_boolean",
    """SELECT l_orderkey, l_quantity, l_discount FROM lineitem
       WHERE ((l_quantity > 10 AND l_quantity < 20) OR NOT (l_discount <= 0.09))
         AND (l_returnflag = 'A') <> (l_linestatus = 'F')""",
)
def filter_boolean(t):
    q, d = F.col("l_quantity"), F.col("l_discount")
    keep = ((q > 10) & (q < 20)) | ~(d <= 0.09)
    either = (F.col("l_returnflag") == "A") != (F.col("l_linestatus") == "F")
    return t.lineitem.filter(keep & either).select("l_orderkey", "l_quantity", "l_discount")


@query(
    "filter_column_vs_column",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE 2 * l_linenumber = l_linenumber * l_linenumber OR l_quantity < l_linenumber",
)
def filter_column_vs_column(t):
    n = F.col("l_linenumber")
    return t.lineitem.filter((2 * n == n * n) | (F.col("l_quantity") < n)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_mask_project", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_mask_project(t):
    return t.customer.filter(F.col("c_acctbal") > 5000).select("c_custkey", "c_acctbal")


@query(
    "filter_isin",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_isin(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query(
    "filter_query_string",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'",
)
def filter_query_string(t):
    return t.orders.filter(
        "o_orderdate >= timestamp_ntz'1997-01-01' and o_orderdate < timestamp_ntz'1998-01-01' and o_orderstatus = 'F'"
    ).select("o_orderkey", "o_totalprice")


@query(
    "filter_query_local_var",
    """SELECT l_orderkey, l_quantity, l_discount FROM lineitem
       WHERE l_quantity < (SELECT avg(l_quantity) FROM lineitem) AND l_discount < (SELECT round(avg(l_discount), 3) FROM lineitem)""",
)
def filter_query_local_var(t):
    mean_q = t.lineitem.agg(F.avg("l_quantity")).scalar()
    mean_d = t.lineitem.agg(F.round(F.avg("l_discount"), 3)).scalar()
    return t.lineitem.filter((F.col("l_quantity") < mean_q) & (F.col("l_discount") < mean_d)).select(
        "l_orderkey", "l_quantity", "l_discount"
    )


@query(
    "filter_chained_compare",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_linenumber < l_quantity AND l_quantity <= 10 * l_linenumber AND 10 * l_linenumber <> l_suppkey""",
)
def filter_chained_compare(t):
    chain = [
        F.col("l_linenumber") < F.col("l_quantity"),
        F.col("l_quantity") <= 10 * F.col("l_linenumber"),
        10 * F.col("l_linenumber") != F.col("l_suppkey"),
    ]
    return t.lineitem.filter(reduce(lambda a, b: a & b, chain)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_range_label", "SELECT p_partkey, p_name FROM part WHERE p_name BETWEEN 'cold bolt' AND 'red gear'")
def filter_range_label(t):
    return t.part.filter(F.col("p_name").between("cold bolt", "red gear")).select("p_partkey", "p_name")


@query(
    "filter_date_range",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-07-04' AND TIMESTAMP '1997-07-04'""",
)
def filter_date_range(t):
    lo, hi = (F.expr(f"timestamp_ntz'{d}'") for d in ("1996-07-04", "1997-07-04"))
    return t.orders.filter(F.col("o_orderdate").between(lo, hi)).select("o_orderkey", "o_orderdate")


@query("filter_partial_date", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1999")
def filter_partial_date(t):
    # a half-open range instead of year() so that the predicate reaches the parquet statistics
    d = F.col("o_orderdate")
    return t.orders.filter(
        (d >= F.expr("timestamp_ntz'1999-01-01'")) & (d < F.expr("timestamp_ntz'2000-01-01'"))
    ).select("o_orderkey", "o_orderdate")


@query(
    "slice_position",
    """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, CAST(n - 1 - pos AS BIGINT) AS rev_pos, pos < 3 AS head3, pos >= 3 AS from3,
              pos >= 1 AND pos < 4 AS mid FROM p WHERE pos % 2 = 0""",
)
def slice_position(t):
    d = with_position(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])
    pos = F.col("pos")
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    return d.filter(pos % 2 == 0).select(
        "o_orderkey",
        "pos",
        (total - 1 - pos).alias("rev_pos"),
        (pos < 3).alias("head3"),
        (pos >= 3).alias("from3"),
        ((pos >= 1) & (pos < 4)).alias("mid"),
    )


@query(
    "take_positions",
    """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders),
       want AS (SELECT DISTINCT p_partkey * 7 + p_size AS pos FROM part)
       SELECT o_orderkey, CAST(pos AS BIGINT) AS pos FROM p JOIN want USING (pos)""",
)
def take_positions(t):
    wanted = t.part.select((F.col("p_partkey") * 7 + F.col("p_size")).alias("pos")).distinct()
    return pick_positions(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], wanted).select(
        "o_orderkey", "pos"
    )


_CELLS = "SELECT vec_id AS i, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings"


@query(
    "take_cells",
    f"""WITH m AS ({_CELLS}), w AS (SELECT DISTINCT l_orderkey % 700 AS i, CAST(l_quantity AS BIGINT) AS j FROM lineitem)
        SELECT CAST(i AS BIGINT) AS i, CAST(j AS INT) AS j, round(v, 6) AS v FROM m JOIN w USING (i, j)""",
)
def take_cells(t):
    wanted = t.lineitem.select((F.col("l_orderkey") % 700).alias("i"), F.col("l_quantity").cast("int").alias("j")).distinct()
    return (
        matrix_cells(t.embeddings, "vec_id", "embedding")
        .join(wanted, ["i", "j"])
        .select("i", "j", F.round("v", 6).alias("v"))
    )


@query(
    "select_outer_cells",
    f"""WITH m AS ({_CELLS}) SELECT CAST(i AS BIGINT) AS i, CAST(j AS INT) AS j, round(v, 6) AS v FROM m
        WHERE i IN (SELECT doc_id FROM labels WHERE quality = 1) AND j IN (2, 0, 1)""",
)
def select_outer_cells(t):
    rows = t.labels.filter("quality = 1").select(F.col("doc_id").alias("i"))
    # the column mask is applied before the explode, the row set as a semi join
    e = t.embeddings.join(rows, F.col("vec_id") == rows.i, "left_semi")
    cells = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.get("embedding", F.lit(j)).cast("double").alias("v")) for j in (2, 0, 1)]))
    return e.select(F.col("vec_id").alias("i"), cells.alias("c")).select("i", "c.j", F.round("c.v", 6).alias("v"))


@query(
    "scatter_assign",
    """WITH up AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-25')
       SELECT c_custkey, round(CASE WHEN k IS NULL THEN c_acctbal ELSE 99 END, 2) AS assigned,
              round(CASE WHEN k IS NULL THEN c_acctbal ELSE c_acctbal - 10 END, 2) AS decremented
       FROM customer LEFT JOIN up ON c_custkey = k""",
)
def scatter_assign(t):
    hits = t.orders.filter("o_orderdate >= timestamp_ntz'2001-07-25'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    j = t.customer.join(hits.withColumn("hit", F.lit(True)), "c_custkey", "left")
    hit = F.coalesce("hit", F.lit(False))
    return j.select(
        "c_custkey",
        F.round(F.when(hit, 99.0).otherwise(F.col("c_acctbal")), 2).alias("assigned"),
        F.round(F.col("c_acctbal") - F.when(hit, 10).otherwise(0), 2).alias("decremented"),
    )


@query(
    "scatter_add",
    """SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS hits FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey GROUP BY 1""",
)
def scatter_add(t):
    positions = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return accumulate_positions(t.customer.select("c_custkey"), positions, "c_custkey", "hits")


@query(
    "scatter_last_wins",
    """SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS kept FROM orders GROUP BY 1""",
)
def scatter_last_wins(t):
    return last_write_wins(t.orders, "o_custkey", "o_totalprice", "o_orderkey").withColumnRenamed("o_totalprice", "kept")


@query(
    "conditional_update",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice > 300000 THEN '2-HIGH'
       ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def conditional_update(t):
    cond = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_totalprice") > 300000)
    return add_or_keep(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderpriority", cond, F.lit("2-HIGH")).drop(
        "o_totalprice"
    )


@query(
    "conditional_choice",
    """SELECT o_orderkey, CASE WHEN isodow(o_orderdate) - 1 < 5 THEN 'Weekday' ELSE 'Weekend' END AS kind FROM orders""",
)
def conditional_choice(t):
    return t.orders.select("o_orderkey", F.when(F.weekday("o_orderdate") < 5, "Weekday").otherwise("Weekend").alias("kind"))


@query(
    "value_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status_name FROM orders""",
)
def value_map(t):
    return lookup_values(t.orders, "o_orderstatus", {"F": "filled", "O": "open"}, "status_name").select("o_orderkey", "status_name")


@query("clip_values", "SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS clipped FROM customer")
def clip_values(t):
    return t.customer.select("c_custkey", F.greatest(F.least("c_acctbal", F.lit(5000.0)), F.lit(0.0)).alias("clipped"))


@query("sample_without_replacement")
def sample_without_replacement(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.xxhash64(F.lit(42), "o_orderkey"), "o_orderkey").limit(500)


@query("shuffle_rows")
def shuffle_rows(t):
    # a total order by a salted hash is the same permutation on every run
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.xxhash64(F.lit(42), "o_orderkey"), "o_orderkey")


@query("sample_hash", "SELECT o_orderkey, o_totalprice FROM orders WHERE (o_orderkey * 48271) % 2147483647 % 10 = 3")
def sample_hash(t):
    return hash_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 10, 3)


@query(
    "contains_key",
    """SELECT n_nationkey, n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) AS present FROM nation""",
)
def contains_key(t):
    seen = t.customer.filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    return t.nation.join(seen.withColumn("hit", F.lit(True)), "n_nationkey", "left").select(
        "n_nationkey", F.col("hit").isNotNull().alias("present")
    )


@query("unique_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def unique_values(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query(
    "drop_duplicates",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def drop_duplicates(t):
    return first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "duplicate_key_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_key_check(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(
    "dtype_profile",
    """SELECT (SELECT count(*) FROM lineitem) AS n_rows, column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type
       FROM (DESCRIBE lineitem)""",
)
def dtype_profile(t):
    df = t.lineitem
    fields = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(fields))


@query(
    "map_filter_rows",
    "SELECT l_orderkey, l_quantity * l_quantity AS squared FROM lineitem WHERE l_linenumber % 2 = 0",
)
def map_filter_rows(t):
    return t.lineitem.filter("l_linenumber % 2 = 0").select("l_orderkey", (F.col("l_quantity") * F.col("l_quantity")).alias("squared"))
