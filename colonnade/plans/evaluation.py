"""Model evaluation on tables of labels and scores."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators import learning as lr
from colonnade.operators.relational import top_rows_per_key, union_all
from colonnade.registry import query


def N():
    return F.count(F.lit(1))


# a scored table: label 1 = order filled, score shifted upwards for positives
_B = "(SELECT o_orderkey, o_orderdate, (o_orderstatus = 'F')::INT AS label, ((o_orderkey * 7919 % 101) + 20 * (o_orderstatus = 'F')::INT) / 121.0::DOUBLE AS score FROM orders)"


def scored(t):
    y = (F.col("o_orderstatus") == "F").cast("int")
    return t.orders.select("o_orderkey", "o_orderdate", y.alias("label"), ((F.col("o_orderkey") * 7919 % 101 + 20 * y) / F.lit(121.0)).alias("score"))


_M = "(SELECT l_linenumber AS label, (CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber ELSE l_partkey % 7 + 1 END)::INT AS pred FROM lineitem)"


def multi(t):
    pred = F.when(F.col("l_orderkey") % 3 == 0, F.col("l_linenumber")).otherwise((F.col("l_partkey") % 7 + 1).cast("int"))
    return t.lineitem.select(F.col("l_linenumber").alias("label"), pred.alias("pred"))


_C = """count(*) FILTER (label = 1 AND {p})::BIGINT AS tp, count(*) FILTER (label <> 1 AND {p})::BIGINT AS fp, count(*) FILTER (label = 1 AND NOT ({p}))::BIGINT AS fn, count(*) FILTER (label <> 1 AND NOT ({p}))::BIGINT AS tn"""
_PR = "coalesce(round(tp / nullif(tp + fp, 0), 6), 0)::DOUBLE AS precision, coalesce(round(tp / nullif(tp + fn, 0), 6), 0)::DOUBLE AS recall"


@query("eval_confusion", f"SELECT label, pred, count(*) AS n FROM {_M} GROUP BY 1, 2")
def eval_confusion(t):
    return multi(t).groupBy("label", "pred").agg(N().alias("n"))


@query("eval_accuracy", f"SELECT round(avg((label = pred)::INT), 6) AS accuracy FROM {_M}")
def eval_accuracy(t):
    return multi(t).agg(F.round(F.avg((F.col("label") == F.col("pred")).cast("double")), 6).alias("accuracy"))


@query(
    "eval_majority_baseline",
    f"SELECT 0 AS prediction, round(avg((label = 0)::INT), 6) AS accuracy, 0.0::DOUBLE AS recall FROM {_B}",
)
def eval_majority_baseline(t):
    d = scored(t)
    majority = d.groupBy("label").agg(N().alias("n")).orderBy(F.desc("n"), "label").limit(1).select("label").scalar()
    d = d.withColumn("prediction", majority)
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return d.agg(F.max("prediction").alias("prediction"), F.round(F.avg(hit), 6).alias("accuracy"), F.avg(F.when(F.col("label") == 1, hit)).alias("recall"))


@query("eval_precision_recall_f1", f"SELECT tp, fp, fn, tn, {_PR}, coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0)::DOUBLE AS f1 FROM (SELECT {_C.format(p='score >= 0.5')} FROM {_B})")
def eval_precision_recall_f1(t):
    c = scored(t).agg(*[v.alias(k) for k, v in lr.binary_counts("label", F.col("score") >= 0.5).items()])
    r = lr.ratios()
    return c.select("*", *[F.round(r[a], 6).alias(b) for a, b in (("precision", "precision"), ("recall", "recall"), ("fbeta", "f1"))])


@query(
    "eval_fbeta",
    f"SELECT " + ", ".join(f"coalesce(round((1 + {b} * {b}) * tp / nullif((1 + {b} * {b}) * tp + {b} * {b} * fn + fp, 0), 6), 0)::DOUBLE AS {n}" for b, n in ((0.5, "f_half"), (1.0, "f_one"), (2.0, "f_two")))
    + f" FROM (SELECT {_C.format(p='score >= 0.5')} FROM {_B})",
)
def eval_fbeta(t):
    c = scored(t).agg(*[v.alias(k) for k, v in lr.binary_counts("label", F.col("score") >= 0.5).items()])
    return c.select(*[F.round(lr.ratios(beta=b)["fbeta"], 6).alias(n) for b, n in ((0.5, "f_half"), (1.0, "f_one"), (2.0, "f_two"))])


def class_report(d, label, pred):
    """Per-class precision, recall, F1 and support with macro and weighted averages.

    Label and prediction counts come from the small class-by-class table.
    """
    cells = d.groupBy(F.col(label).cast("string").alias("l"), F.col(pred).cast("string").alias("p")).agg(N().alias("n"))
    tagged = union_all([
        cells.select(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        cells.select(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    ])
    c = tagged.groupBy("class").agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "tp")])
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, s, p = F.col("tp"), F.col("support"), F.col("predicted")
    per = c.select("class", z(tp, p).alias("precision"), z(tp, s).alias("recall"), z(2 * tp, p + s).alias("f1"), "support")
    m = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(x).alias(x) for x in m], F.sum("support").alias("support")).select(F.lit("macro avg").alias("class"), *m, "support")
    weighted = per.agg(*[(F.sum(F.col(x) * s) / F.sum(s)).alias(x) for x in m], F.sum("support").alias("support")).select(F.lit("weighted avg").alias("class"), *m, "support")
    return union_all([per, macro, weighted])


_REP = f"""WITH c AS (SELECT k, sum(s)::DOUBLE AS support, sum(p)::DOUBLE AS predicted, sum(tp)::DOUBLE AS tp FROM (SELECT label AS k, 1 AS s, 0 AS p, (label = pred)::INT AS tp FROM {_M} UNION ALL SELECT pred, 0, 1, 0 FROM {_M}) GROUP BY 1),
    r AS (SELECT k::VARCHAR AS class, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1, support FROM c),
    u AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM r)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM u"""


@query("eval_class_report", _REP)
def eval_class_report(t):
    return class_report(multi(t), "label", "pred").select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


THRESHOLDS = [i / 20 for i in range(1, 20)]


@query(
    "eval_threshold_sweep",
    f"SELECT threshold, tp, fp, fn, tn, {_PR} FROM (SELECT th AS threshold, {_C.format(p='score >= th')} FROM {_B}, (SELECT unnest(range(1, 20)) / 20.0::DOUBLE AS th) GROUP BY 1)",
)
def eval_threshold_sweep(t):
    r = lr.ratios()
    return lr.threshold_sweep(scored(t), "label", "score", THRESHOLDS).select("*", F.round(r["precision"], 6).alias("precision"), F.round(r["recall"], 6).alias("recall"))


@query(
    "eval_compare_thresholds",
    f"SELECT threshold, tp, fp, fn, tn, {_PR} FROM (SELECT th AS threshold, {_C.format(p='score >= th')} FROM {_B}, (SELECT unnest([0.2, 0.8])::DOUBLE AS th) GROUP BY 1)",
)
def eval_compare_thresholds(t):
    r = lr.ratios()
    return lr.threshold_sweep(scored(t), "label", "score", [0.2, 0.8]).select("*", F.round(r["precision"], 6).alias("precision"), F.round(r["recall"], 6).alias("recall"))


_PTS = f"""(SELECT score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS allp, sum(n) OVER () AS alln FROM (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n FROM {_B} GROUP BY 1) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query("eval_pr_curve", f"SELECT round(score, 8) AS score, round(tp / (tp + fp), 6)::DOUBLE AS precision, round(tp / allp, 6)::DOUBLE AS recall FROM {_PTS}")
def eval_pr_curve(t):
    d = scored(t)
    pos = d.agg(F.count_if(F.col("label") == 1)).scalar()
    pts = lr.score_points(d, "label", "score")
    return pts.select(F.round("score", 8).alias("score"), F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 6).alias("precision"), F.round(F.col("tp") / pos, 6).alias("recall"))


@query("eval_roc_curve", f"SELECT round(score, 8) AS score, round(fp / alln, 6)::DOUBLE AS fpr, round(tp / allp, 6)::DOUBLE AS tpr FROM {_PTS}")
def eval_roc_curve(t):
    d = scored(t)
    s = d.agg(F.struct(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") != 1).alias("n"))).scalar()
    pts = lr.score_points(d, "label", "score")
    return pts.select(F.round("score", 8).alias("score"), F.round(F.col("fp") / s.getField("n"), 6).alias("fpr"), F.round(F.col("tp") / s.getField("p"), 6).alias("tpr"))


@query("eval_auc", f"SELECT round(sum(n * (tp - p / 2.0::DOUBLE)) / (any_value(allp) * any_value(alln)), 6)::DOUBLE AS auc FROM {_PTS}")
def eval_auc(t):
    return lr.roc_auc(scored(t), "label", "score").withColumn("auc", F.round("auc", 6))


@query("eval_model_compare")
def eval_model_compare(t):
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
    from pyspark.ml.functions import vector_to_array

    from colonnade.plans.learning import binary

    d = lr.hash_split(binary(t), "vec_id", 0.25)
    train, test = d.filter("not is_test"), d.filter("is_test")
    models = {"logistic": LogisticRegression(labelCol="y", maxIter=30), "tree3": DecisionTreeClassifier(labelCol="y", maxDepth=3), "tree6": DecisionTreeClassifier(labelCol="y", maxDepth=6)}
    out = []
    for name, m in models.items():
        p = m.fit(train).transform(test).select("vec_id", "y", "prediction", vector_to_array("probability")[1].alias("score"))
        auc = lr.roc_auc(p.withColumn("label", F.col("y").cast("int")), "label", "score")
        acc = p.agg(F.avg((F.col("y") == F.col("prediction")).cast("double")).alias("accuracy"))
        out.append(acc.withColumn("auc", auc.scalar()).withColumn("model", F.lit(name)))
    return union_all(out)


_R = "(SELECT l_returnflag, l_extendedprice AS y, 900 + 2000 * l_quantity AS yhat FROM lineitem)"


@query(
    "eval_regression",
    f"""SELECT round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) ** 2)), 4) AS rmse, round(1 - sum((y - yhat) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM {_R}""",
)
def eval_regression(t):
    d = t.lineitem.select(F.col("l_extendedprice").alias("y"), (900 + 2000 * F.col("l_quantity")).alias("yhat"))
    e = F.col("y") - F.col("yhat")
    return d.agg(F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.round(1 - F.sum(e * e) / (F.var_pop("y") * N()), 6).alias("r2"))


@query(
    "eval_overfit_gap",
    f"""WITH a AS (SELECT l_returnflag, avg((l_orderkey % 10 < 9)::INT) AS train, avg((l_partkey % 10 < 9 - l_linenumber % 5)::INT) AS test FROM lineitem GROUP BY 1)
        SELECT l_returnflag, round(train, 6) AS train, round(test, 6) AS test, round(train - test, 6) AS gap, CASE WHEN train - test > 0.3 THEN 'overfit' WHEN train - test > 0.1 THEN 'watch' ELSE 'ok' END AS status FROM a""",
)
def eval_overfit_gap(t):
    right = lambda c: F.avg(c.cast("double"))
    a = t.lineitem.groupBy("l_returnflag").agg(
        right(F.col("l_orderkey") % 10 < 9).alias("train"), right(F.col("l_partkey") % 10 < 9 - F.col("l_linenumber") % 5).alias("test")
    )
    gap = F.col("train") - F.col("test")
    status = F.when(gap > 0.3, "overfit").when(gap > 0.1, "watch").otherwise("ok")
    return a.select("l_returnflag", F.round("train", 6).alias("train"), F.round("test", 6).alias("test"), F.round(gap, 6).alias("gap"), status.alias("status"))


@query(
    "eval_borderline",
    "SELECT l_orderkey, l_linenumber, l_quantity, (l_quantity >= 30) <> (l_quantity + l_linenumber - 4 >= 30) AS wrong FROM lineitem WHERE abs(l_quantity - 30) < 3",
)
def eval_borderline(t):
    q, est = F.col("l_quantity"), F.col("l_quantity") + F.col("l_linenumber") - 4
    return t.lineitem.filter(F.abs(q - 30) < 3).select("l_orderkey", "l_linenumber", "l_quantity", ((q >= 30) != (est >= 30)).alias("wrong"))


@query(
    "eval_capacity_topn",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY score DESC, o_orderkey)::INT AS rank FROM {_B} QUALIFY rank <= 50""",
)
def eval_capacity_topn(t):
    d = scored(t).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return top_rows_per_key(d, ["month"], [F.desc("score"), F.col("o_orderkey")], 50).select("month", "o_orderkey", "rank")
