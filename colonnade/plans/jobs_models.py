"""Complete modelling jobs."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from colonnade.functions import geo
from colonnade.operators import learning as lr
from colonnade.operators import stats
from colonnade.operators.margins import fit_margin_grid
from colonnade.operators.relational import top_rows_per_key, union_all
from colonnade.operators.timeseries import daily
from colonnade.plans.evaluation import class_report
from colonnade.plans.learning import GNB_SQL, binary, coefficients, gaussian_nb, results, vec
from colonnade.registry import query


def N():
    return F.count(F.lit(1))


DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


@query("job_bike_regression")
def job_bike_regression(t):
    """Daily total on weekday, holiday, daylight and weather columns, with bootstrap errors."""
    d = daily(t.orders, "o_orderdate", F.count(F.lit(1)).cast("double").alias("total"), F.avg("o_totalprice").alias("temp"))
    x = {n: (F.weekday("d") == i).cast("double") for i, n in enumerate(DAYS)}
    x["holiday"] = ((F.dayofmonth("d") == 25) & (F.month("d") == 12)).cast("double")
    x["daylight"] = geo.daylight_hours(F.col("d"))
    x["temp"] = F.col("temp") / 100000
    x["annual"] = F.datediff("d", F.lit("1995-01-01").cast("date")) / 365.0
    names = list(x)
    table = d.select(F.unix_date("d").alias("day"), "total", *[c.alias(n) for n, c in x.items()])
    base, err, _ = stats.little_bootstraps(table, "day", [F.col(n) for n in names], F.col("total"))
    return results(t, [(n, float(c), float(e)) for n, c, e in zip(names, base, err)], "name string, effect double, error double")


@query("job_grid_stability")
def job_grid_stability(t):
    """Engineered features, class means, correlations, outliers, t tests and a scaled logistic model."""
    d = binary(t)
    names = [f"x{i}" for i in range(64)]
    wide = d.select("vec_id", "y", *[F.get("e", F.lit(i)).alias(n) for i, n in enumerate(names)])
    wide = wide.withColumns({"reaction": sum((F.col(n) for n in names[1:4]), F.col(names[0])), "elasticity": sum((F.col(n) for n in names[9:12]), F.col(names[8])) / 4})
    feats = [*names, "reaction", "elasticity"]
    long = wide.unpivot(["vec_id", "y"], feats, "feature", "v")
    moments = stats.t_test(long, ["feature"], F.col("v"), F.col("y") == 1, F.col("y") == 0)
    corr = long.groupBy("feature").agg(F.corr("v", "y").alias("corr"), F.avg("v").alias("m"), F.stddev("v").alias("s"))
    outliers = long.join(corr, "feature").groupBy("feature").agg(F.count_if(F.abs(F.col("v") - F.col("m")) > 2 * F.col("s")).alias("outliers"))
    table = lr.stratified_split(lr.as_features(wide, feats), "vec_id", "y", 0.2)
    stages = [StandardScaler(inputCol="features", outputCol="scaled", withMean=True), LogisticRegression(featuresCol="scaled", labelCol="y", maxIter=50)]
    model = Pipeline(stages=stages).fit(table.filter("not is_test"))
    weights = coefficients(t, feats, model.stages[-1].coefficients, model.stages[-1].intercept).withColumnsRenamed({"name": "feature", "value": "weight"})
    test = model.transform(table.filter("is_test"))
    acc = test.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).scalar()
    out = moments.select("feature", F.col("m1").alias("mean1"), F.col("m2").alias("mean0"), "t").join(corr.select("feature", "corr"), "feature")
    return out.join(outliers, "feature").join(weights, "feature").withColumn("test_accuracy", acc)


@query("job_heart_disease")
def job_heart_disease(t):
    """Missing values imputed, stratified split, scaling on train, two models, folds and a depth curve."""
    d = lr.stratified_split(binary(t).select("vec_id", "y", "e"), "vec_id", "y", 0.2)
    hole = F.when(F.col("vec_id") % 17 != 0, F.get("e", F.lit(3)))
    d = d.withColumn("hole", hole)
    mean = d.filter("not is_test").agg(F.avg("hole")).scalar()
    names = [f"x{i}" for i in range(64)]
    d = d.select("vec_id", "y", "is_test", *[(F.coalesce("hole", mean) if i == 3 else F.get("e", F.lit(i))).alias(n) for i, n in enumerate(names)])
    d = t.hold(lr.fold_column(lr.as_features(d, names), "vec_id", 5))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)

    def fitted(clf, train, test):
        m = Pipeline(stages=[scaler, clf]).fit(train)
        score = lambda df: m.transform(df).agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
        return score(train), score(test)

    rows = []
    train, test = d.filter("not is_test"), d.filter("is_test")
    log = LogisticRegression(featuresCol="scaled", labelCol="y", maxIter=30)
    tree = lambda depth: DecisionTreeClassifier(featuresCol="scaled", labelCol="y", maxDepth=depth, seed=1)
    rows.append(("logistic", "test", *fitted(log, train, test)))
    for depth in (2, 4, 8):
        rows.append((f"tree{depth}", "test", *fitted(tree(depth), train, test)))
    for fold in range(5):
        rows.append(("logistic", f"fold{fold}", *fitted(log, train.filter(F.col("fold") != fold), train.filter(F.col("fold") == fold))))
    return results(t, rows, "model string, part string, train double, score double")


def _rare(t, cut):
    """A two-class table with a rare positive class: line items with extreme values."""
    y = (F.col("l_quantity") * (1 + 5 * F.col("l_discount")) > cut).cast("double")
    d = t.lineitem.select(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), y.alias("y"), "l_quantity", "l_extendedprice", "l_tax", "l_linenumber")
    return lr.hash_split(lr.as_features(d, ["l_quantity", "l_extendedprice", "l_tax", "l_linenumber"]), "id", 0.3)


def _scored(t, cut, balanced):
    d = _rare(t, cut)
    train = d.filter("not is_test")
    if balanced:
        train = lr.balanced_weights(train, "y")
    stages = [StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
              LogisticRegression(featuresCol="scaled", labelCol="y", maxIter=40, **({"weightCol": "weight"} if balanced else {}))]
    m = Pipeline(stages=stages).fit(train)
    return m.transform(d.filter("is_test")).select("id", F.col("y").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"))


def _threshold_table(p, thresholds):
    r = lr.ratios()
    sweep = lr.threshold_sweep(p, "label", "score", thresholds).select("*", r["precision"].alias("precision"), r["recall"].alias("recall"), r["fbeta"].alias("f1"))
    return sweep.withColumn("auc", lr.roc_auc(p, "label", "score").scalar())


@query("job_liquefaction_eval")
def job_liquefaction_eval(t):
    return _threshold_table(_scored(t, 55, False), [0.2, 0.5, 0.8])


@query("job_pipe_failure")
def job_pipe_failure(t):
    return _threshold_table(_scored(t, 65, True), [i / 10 for i in range(1, 10)])


#: Texts that the fitted chain is asked about: one in a language of the table, one of none.
NEW_TEXTS = ["the of that with are", "9 8 7"]


@query("job_topic_classifier")
def job_topic_classifier(t):
    """TF-IDF and Bayes in one chain: report per class on held-out documents, the words that mark each class, and the class of new texts."""
    docs = t.spread("documents").select("doc_id", "lang", "text")
    model = lr.fit_topics(docs.filter("doc_id % 5 <> 0"), "doc_id", "lang", "text")
    model.words = t.hold(model.words)
    held = docs.filter("doc_id % 5 = 0")
    predicted = model.predict(held, "doc_id", "text").join(held.select("doc_id", "lang"), "doc_id")
    report = class_report(predicted, "lang", "prediction").select(F.lit("report").alias("view"), "class", F.lit("f1").alias("key"), F.col("f1").alias("value"))
    per_class = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"lp{i}").alias("logp")) for i, c in enumerate(model.classes)])
    top = top_rows_per_key(model.words.select("word", F.inline(per_class)), ["class"], [F.desc("logp"), F.col("word")], 15)
    new = t.spark.createDataFrame([(x,) for x in NEW_TEXTS], "text string")
    asked = model.predict(new, "text", "text").select(F.lit("new_text").alias("view"), F.col("prediction").alias("class"), F.col("text").alias("key"), F.col("margin").alias("value"))
    return union_all([report, top.select(F.lit("top_words").alias("view"), "class", F.col("word").alias("key"), F.col("logp").alias("value")), asked])


@query(
    "job_structural_health",
    f"""{GNB_SQL}, p AS (SELECT vec_id, any_value(b.label) AS label, any_value(prediction) AS prediction, 1 / sum(exp(score - hi)) AS probability FROM best b JOIN sc USING (vec_id) GROUP BY 1)
        SELECT label, count(*) AS n, round(avg((label = prediction)::INT), 6) AS recall, round(avg(probability), 6) AS mean_probability, count(*) FILTER (probability < 0.5) AS unsure FROM p GROUP BY 1""",
)
def job_structural_health(t):
    """Gaussian Bayes classes with probabilities on rows that the model did not see, summarised per class."""
    p = gaussian_nb(t)
    return p.groupBy("label").agg(
        N().alias("n"), F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("recall"), F.round(F.avg("probability"), 6).alias("mean_probability"),
        F.count_if(F.col("probability") < 0.5).alias("unsure"),
    )


FACE_GRID = [(k, reg) for k in (10, 20, 40, 64) for reg in (0.001, 0.01, 0.1, 1.0)]


@query("job_face_recognition")
def job_face_recognition(t):
    """Components, a margin classifier per class, a grid of sixteen tuned by folds of the training rows, and the class report on the others."""
    d = lr.stratified_split(vec(t).select("vec_id", "label", "features"), "vec_id", "label", 0.25).select("vec_id", "label", "features", "is_test")
    d = t.hold(lr.fold_column(d.withColumn("label", F.col("label").cast("double")), "vec_id", 2))
    train, test = d.filter("not is_test"), d.filter("is_test")
    right = lambda p: p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]

    def projected(rows, *others):
        """The given frames with the components of the first one's rows."""
        prep = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="centred", withMean=True), PCA(k=max(k for k, _ in FACE_GRID), inputCol="centred", outputCol="scores")]).fit(rows)
        return [t.hold(prep.transform(x).select("vec_id", "label", vector_to_array("scores").alias("scores"))) for x in (rows, *others)]

    score = dict.fromkeys(FACE_GRID, 0.0)
    for f in range(2):
        learn, check = projected(train.filter(F.col("fold") != f), train.filter(F.col("fold") == f))
        model = fit_margin_grid(learn, "scores", "label", FACE_GRID, 5)
        for g, share in zip(FACE_GRID, model.accuracies(check, "scores", "label")):
            score[g] += share / 2
    k, reg = max(FACE_GRID, key=lambda g: score[g])
    learn, check = projected(train, test)
    p = fit_margin_grid(learn, "scores", "label", [(k, reg)], 5).predict(check, "scores", ["vec_id", "label"])
    p = t.hold(p.select("vec_id", "label", F.get("predictions", F.lit(0)).alias("prediction")))
    return class_report(p, "label", "prediction").withColumns({"components": F.lit(k), "reg": F.lit(reg), "fold_accuracy": F.lit(score[k, reg]), "accuracy": F.lit(right(p))})


@query("job_face_pipeline")
def job_face_pipeline(t):
    """The same job under the survey's name."""
    return job_face_recognition(t)
