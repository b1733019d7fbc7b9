"""Feature engineering and models."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans, PowerIterationClustering
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, Imputer, PolynomialExpansion, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators import learning as lr
from colonnade.operators import neighbours as nb
from colonnade.operators import stats, vectors
from colonnade.operators.estimators import GaussianBumps
from colonnade.operators.forests import fit_forest
from colonnade.operators.relational import one_row
from colonnade.plans.neighbours import knn_vectors_sql, plane
from colonnade.registry import query

LINE = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def vec(t):
    e = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    return e.withColumn("features", array_to_vector("e"))


def binary(t):
    return vec(t).withColumn("y", (F.col("label") >= 5).cast("double"))


def components(t, k):
    """``vec`` with its first ``k`` principal components, fitted on all dimensions, as ``features`` and ``e``."""
    _, centred, model = fitted_pca(vec(t), k)
    d = model.transform(centred).select("vec_id", "label", F.col("scores").alias("features"))
    return d.withColumn("e", vector_to_array("features"))


def small(x):
    """A fitted vector (model-sized) as JSON text."""
    return [round(float(v), 8) for v in x]


def coefficients(t, names, values, intercept):
    """Coefficient table; its size is the number of features."""
    rows = [(n, float(v)) for n, v in zip(names, values)] + [("intercept", float(intercept))]
    return t.spark.createDataFrame(rows, "name string, value double")


def results(t, rows, schema):
    """A few computed scores as a DataFrame."""
    return t.spark.createDataFrame([tuple(r) for r in rows], schema)


def accuracy(df, label="label", pred="prediction"):
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double"))).first()[0]


# ---- features


@query(
    "ml_assemble",
    """WITH f AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS label FROM lineitem GROUP BY 1)
       SELECT l_orderkey, label::DOUBLE AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_linenumber::DOUBLE AS f3 FROM lineitem JOIN f USING (l_returnflag)""",
)
def ml_assemble(t):
    stages = [StringIndexer(inputCol="l_returnflag", outputCol="label"), VectorAssembler(inputCols=LINE, outputCol="features")]
    d = Pipeline(stages=stages).fit(t.lineitem).transform(t.lineitem)
    return d.select("l_orderkey", "label", vector_to_array("features").alias("f")).select("l_orderkey", "label", *[F.col("f")[i].alias(f"f{i}") for i in range(4)])


_SPLIT = "(({k} * 48271) % 2147483647) % 10000 < 2500"


@query("ml_train_test_split", f"SELECT o_orderkey, {_SPLIT.format(k='o_orderkey')} AS is_test FROM orders")
def ml_train_test_split(t):
    return lr.hash_split(t.orders, "o_orderkey", 0.25, lr.integer_hash("o_orderkey")).select("o_orderkey", "is_test")


@query(
    "ml_stratified_split",
    """SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY (vec_id * 48271) % 2147483647, vec_id) <= floor(count(*) OVER (PARTITION BY label) * 0.2) AS is_test FROM embeddings""",
)
def ml_stratified_split(t):
    return lr.stratified_split(vec(t).select("vec_id", "label"), "vec_id", "label", 0.2, lr.integer_hash("vec_id")).select("vec_id", "label", "is_test")


@query(
    "ml_standard_scale",
    f"""WITH x AS (SELECT vec_id, {_SPLIT.format(k='vec_id')} AS is_test, unnest(range(len(embedding)))::INT AS j, unnest(embedding)::DOUBLE AS v FROM embeddings), m AS (SELECT j, avg(v) AS mu, stddev_samp(v) AS s FROM x WHERE NOT is_test GROUP BY 1)
        SELECT vec_id, is_test, j, round((v - mu) / s, 6) AS scaled FROM x JOIN m USING (j)""",
)
def ml_standard_scale(t):
    d = lr.hash_split(vec(t), "vec_id", 0.25, lr.integer_hash("vec_id"))
    model = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(d.filter("not is_test"))
    out = model.transform(d).select("vec_id", "is_test", F.posexplode(vector_to_array("scaled")).alias("j", "scaled"))
    return out.withColumn("scaled", F.round("scaled", 6))


@query("ml_scale_leak_check")
def ml_scale_leak_check(t):
    d = t.hold(lr.hash_split(binary(t), "vec_id", 0.25))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    clf = LogisticRegression(featuresCol="scaled", labelCol="y")
    rows = []
    for name, base in (("scaled_on_train", d.filter("not is_test")), ("scaled_on_all", d)):
        sm = scaler.fit(base)
        m = clf.fit(sm.transform(d.filter("not is_test")))
        rows.append((name, accuracy(m.transform(sm.transform(d.filter("is_test"))), "y")))
    return results(t, rows, "variant string, accuracy double")


@query("ml_target_leak_check")
def ml_target_leak_check(t):
    d = t.lineitem.withColumn("after", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    rows = []
    for name, cols in (("clean", LINE), ("leaky", [*LINE, "after"])):
        m = LinearRegression(labelCol="l_extendedprice").fit(lr.as_features(d, cols))
        rows.append((name, m.summary.r2))
    return results(t, rows, "variant string, r2 double")


_POWERS = [(1, 0), (2, 0), (3, 0), (0, 1), (1, 1), (2, 1), (0, 2), (1, 2), (0, 3)]


@query(
    "ml_polynomial",
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round(l_quantity ** {a} * l_discount ** {b}, 8) AS q{a}d{b}" for a, b in _POWERS) + " FROM lineitem",
)
def ml_polynomial(t):
    d = lr.as_features(t.lineitem, ["l_quantity", "l_discount"])
    p = PolynomialExpansion(degree=3, inputCol="features", outputCol="poly").transform(d)
    p = p.select("l_orderkey", "l_linenumber", vector_to_array("poly").alias("poly"))
    return p.select("l_orderkey", "l_linenumber", *[F.round(F.col("poly")[i], 8).alias(f"q{a}d{b}") for i, (a, b) in enumerate(_POWERS)])


@query(
    "ml_gaussian_basis",
    "WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 4 AS w FROM events) SELECT event_id, "
    + ", ".join(f"round(exp(-0.5 * ((value - (lo + w * {i})) / w) ** 2), 8) AS bump{i}" for i in range(5)) + " FROM events, s",
)
def ml_gaussian_basis(t):
    d = GaussianBumps(inputCol="value", outputPrefix="bump", count=5).fit(t.events).transform(t.events)
    return d.select("event_id", *[F.round(f"bump{i}", 8).alias(f"bump{i}") for i in range(5)])


@query(
    "ml_interaction_ratio",
    """SELECT vec_id, round(e[1] + e[2] + e[3] + e[4], 6) AS total_reaction, round(e[5] * e[6], 8) AS product, round(e[7] * e[7], 8) AS squared, round((e[9] + e[10] + e[11] + e[12]) / 4, 6) AS avg_elasticity
       FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)""",
)
def ml_interaction_ratio(t):
    e = lambda i: F.get("e", F.lit(i - 1))
    return vec(t).select(
        "vec_id", F.round(e(1) + e(2) + e(3) + e(4), 6).alias("total_reaction"), F.round(e(5) * e(6), 8).alias("product"), F.round(e(7) * e(7), 8).alias("squared"),
        F.round((e(9) + e(10) + e(11) + e(12)) / 4, 6).alias("avg_elasticity"),
    )


@query("ml_rbf_feature", "SELECT vec_id, round(exp(-(embedding[1]::DOUBLE ** 2 + embedding[2]::DOUBLE ** 2)), 8) AS r FROM embeddings")
def ml_rbf_feature(t):
    x, y = F.get("e", F.lit(0)), F.get("e", F.lit(1))
    return vec(t).select("vec_id", F.round(F.exp(-(x * x + y * y)), 8).alias("r"))


_WORDS = "(SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents)"


@query("ml_count_vectorize", f"SELECT doc_id, word, count(*) AS tf FROM {_WORDS} GROUP BY 1, 2")
def ml_count_vectorize(t):
    return lr.words(t.spread("documents"), "doc_id", "text")


STOP = ["the", "of", "and", "to", "in", "is", "on", "for", "with", "as", "at", "by"]
_STOP = ", ".join(f"'{w}'" for w in STOP)


@query(
    "ml_tfidf",
    f"""WITH c AS (SELECT doc_id, word, count(*) AS tf FROM {_WORDS} WHERE word NOT IN ({_STOP}) GROUP BY 1, 2), v AS (SELECT word, sum(tf) AS total, count(*) AS df FROM c GROUP BY 1 ORDER BY total DESC, word LIMIT 5000),
        n AS (SELECT count(*) AS n FROM documents), w AS (SELECT doc_id, word, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM c JOIN v USING (word), n)
        SELECT doc_id, word, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def ml_tfidf(t):
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    return lr.tfidf(lr.words(t.spread("documents"), "doc_id", "text", stop=STOP), "doc_id", 5000, n).withColumn("weight", F.round("weight", 6))


# ---- models on MLlib


@query("ml_pipeline")
def ml_pipeline(t):
    """The chained stages under the survey's name."""
    return ml_chained_stages(t)


@query("ml_chained_stages")
def ml_chained_stages(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")).alias("q"), "l_discount")
    stages = [
        Imputer(strategy="mean", inputCols=["q"], outputCols=["q_full"]), VectorAssembler(inputCols=["q_full", "l_discount"], outputCol="raw"),
        PolynomialExpansion(degree=2, inputCol="raw", outputCol="features"), LinearRegression(labelCol="l_extendedprice"),
    ]
    return Pipeline(stages=stages).fit(d).transform(d).select("l_orderkey", "l_linenumber", F.round("prediction", 4).alias("prediction"))


@query("ml_linear_regression")
def ml_linear_regression(t):
    m = LinearRegression(labelCol="l_extendedprice", solver="normal").fit(lr.as_features(t.lineitem, LINE))
    return coefficients(t, LINE, m.coefficients, m.intercept)


@query("ml_basis_regression")
def ml_basis_regression(t):
    d = t.events.withColumn("x", F.hour("ts") + F.minute("ts") / 60)
    bumps = [f"bump{i}" for i in range(8)]
    stages = [GaussianBumps(inputCol="x", count=8), VectorAssembler(inputCols=bumps, outputCol="features"), LinearRegression(labelCol="value", solver="normal")]
    m = Pipeline(stages=stages).fit(d).stages[-1]
    return coefficients(t, bumps, m.coefficients, m.intercept)


def _penalised(t, alpha, mix):
    d = lr.as_features(t.lineitem, LINE)
    n, spread = d.agg(F.count(F.lit(1)), F.stddev_pop("l_extendedprice")).first()
    # the solver scales the label first: that leaves the L1 term as given but divides the L2 term by its spread
    reg = alpha if mix == 1.0 else alpha / n * spread
    m = LinearRegression(labelCol="l_extendedprice", regParam=reg, elasticNetParam=mix, standardization=False).fit(d)
    return coefficients(t, LINE, m.coefficients, m.intercept)


@query("ml_ridge")
def ml_ridge(t):
    return _penalised(t, 0.1, 0.0)


@query("ml_lasso")
def ml_lasso(t):
    return _penalised(t, 50.0, 1.0).withColumn("is_zero", F.abs("value") < 1e-9)


@query("ml_logistic")
def ml_logistic(t):
    d = lr.hash_split(binary(t), "vec_id", 0.25)
    m = LogisticRegression(labelCol="y", weightCol="weight", regParam=0.01).fit(lr.balanced_weights(d.filter("not is_test"), "y"))
    return m.transform(d.filter("is_test")).select("vec_id", "y", F.round(vector_to_array("probability")[1], 6).alias("p"), "prediction")


@query("ml_decision_tree")
def ml_decision_tree(t):
    d = t.hold(lr.hash_split(vec(t), "vec_id", 0.25))
    rows = []
    for depth in (1, 2, 4, 8):
        m = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(d.filter("not is_test"))
        rows.append((depth, accuracy(m.transform(d.filter("not is_test"))), accuracy(m.transform(d.filter("is_test")))))
    return results(t, rows, "depth int, train double, test double")


def _forest(t, **kw):
    d = lr.hash_split(vec(t), "vec_id", 0.25)
    m = RandomForestClassifier(seed=1, **kw).fit(d.filter("not is_test"))
    return m.transform(d.filter("is_test")).select("vec_id", "label", "prediction")


@query("ml_bagging")
def ml_bagging(t):
    return _forest(t, numTrees=100, featureSubsetStrategy="all", subsamplingRate=0.8)


@query("ml_random_forest")
def ml_random_forest(t):
    return _forest(t, numTrees=100)


@query("ml_random_forest_reg")
def ml_random_forest_reg(t):
    d = t.lineitem.select(*LINE, "l_extendedprice")
    m = fit_forest(d, LINE, "l_extendedprice", trees=200, depth=6, seed=1)
    return m.transform(d).groupBy("l_quantity").agg(F.avg("l_extendedprice").alias("actual"), F.avg("prediction").alias("predicted"))


@query("ml_linear_svm")
def ml_linear_svm(t):
    d = t.hold(lr.hash_split(binary(t), "vec_id", 0.25).select("features", "y", "is_test"))
    train, test = d.filter("not is_test"), d.filter("is_test")
    n = train.count()
    rows = []
    for c in (0.1, 1.0, 10.0):
        m = LinearSVC(labelCol="y", regParam=1 / (n * c), maxIter=20, standardization=False).fit(train)
        rows.append((c, accuracy(m.transform(test), "y")))
    return results(t, rows, "c double, accuracy double")


@query("ml_kernel_svm")
def ml_kernel_svm(t):
    """Margin classifier on random Fourier features of the Gaussian kernel over all dimensions, its width from the spread of the components."""
    d = lr.hash_split(binary(t).select("vec_id", "y", "e"), "vec_id", 0.25)
    dim, spread = d.select(F.explode("e").alias("x"), F.size("e").alias("dim")).agg(F.max("dim"), F.var_pop("x")).first()
    wide = t.hold(lr.fourier_features(d, "e", dim, 256, 1 / (dim * spread)))
    m = LinearSVC(labelCol="y", regParam=1e-3, maxIter=40).fit(wide.filter("not is_test"))
    return m.transform(wide.filter("is_test")).select("vec_id", "y", "prediction")


@query("ml_kmeans")
def ml_kmeans(t):
    d = vec(t)
    return KMeans(k=10, seed=1).fit(d).transform(d).select("vec_id", "label", F.col("prediction").alias("cluster"))


def _start(t, k):
    """First k vectors by id: a repeatable start."""
    return [list(r[0]) for r in vec(t).orderBy("vec_id").limit(k).select("e").collect()]


@query("ml_kmeans_by_hand")
def ml_kmeans_by_hand(t):
    d = vec(t)
    centres = lr.lloyd(d, F.col("e"), _start(t, 4), 10)
    return lr.assign(d, F.col("e"), centres).select("vec_id", "label", "cluster", F.round(F.sqrt("d2"), 6).alias("dist"))


@query("ml_kmeans_minibatch")
def ml_kmeans_minibatch(t):
    """Ten centres moved batch by batch, two rounds over all rows, then every row's centre."""
    d = vec(t)
    centres = lr.minibatch(d, "vec_id", F.col("e"), _start(t, 10), batches=5, rounds=2)
    return lr.assign(d, F.col("e"), centres).select("vec_id", "cluster")


#: Each row and the nearest of the four vectors with the smallest ids.
_CLUSTERS = """(SELECT vec_id, label, arg_min(c, (d2, c)) AS cluster, min(d2) AS d2 FROM (SELECT v.vec_id, v.label, c.c, list_sum(list_transform(list_zip(v.embedding, c.e), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2)) AS d2
    FROM embeddings v, (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS c, embedding AS e FROM embeddings ORDER BY vec_id LIMIT 4) c) GROUP BY 1, 2)"""


@query(
    "ml_cluster_purity",
    f"""WITH c AS (SELECT cluster, label, count(*) AS n FROM {_CLUSTERS} GROUP BY 1, 2), b AS (SELECT cluster, arg_max(label, (n, -label)) AS majority, max(n) AS hits, sum(n)::BIGINT AS size FROM c GROUP BY 1)
        SELECT cluster::INT AS cluster, majority, hits, size, round((sum(hits) OVER () / sum(size) OVER ())::DOUBLE, 6) AS accuracy FROM b""",
)
def ml_cluster_purity(t):
    d = lr.assign(vec(t), F.col("e"), _start(t, 4))
    c = d.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    b = c.groupBy("cluster").agg(F.max_by("label", F.struct("n", (-F.col("label")).alias("t"))).alias("majority"), F.max("n").alias("hits"), F.sum("n").alias("size"))
    share = b.agg(F.sum("hits") / F.sum("size")).scalar()
    return b.withColumn("accuracy", F.round(share, 6))


@query("ml_color_quantise")
def ml_color_quantise(t):
    d = t.embeddings.select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("e")).withColumn("features", array_to_vector("e"))  # a colour has three channels
    model = KMeans(k=16, seed=1).fit(d)
    centres = [small(c) for c in model.clusterCenters()]
    q = lr.assign(d, F.col("e"), centres)
    table = F.array(*[F.array(*map(F.lit, c)) for c in centres])
    return q.select("vec_id", "cluster", F.to_json(F.get(table, F.col("cluster"))).alias("colour"))


@query("ml_cluster_radius", f"SELECT cluster::INT AS cluster, count(*) AS n, round(max(sqrt(d2)), 6) AS radius FROM {_CLUSTERS} GROUP BY 1")
def ml_cluster_radius(t):
    return lr.assign(vec(t), F.col("e"), _start(t, 4)).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.max("d2")), 6).alias("radius"))


@query("ml_spectral")
def ml_spectral(t):
    edges = nb.knn(t.embeddings, "vec_id", *plane(t), 8)
    graph = edges.select(F.least("id", "neighbour").alias("src"), F.greatest("id", "neighbour").alias("dst"), F.lit(1.0).alias("weight")).dropDuplicates(["src", "dst"])
    pic = PowerIterationClustering(k=4, maxIter=10, weightCol="weight")
    return pic.assignClusters(graph)


@query("ml_gmm")
def ml_gmm(t):
    d = t.hold(components(t, 10))
    m = GaussianMixture(k=3, seed=1, maxIter=20).fit(d)
    return m.transform(d).select("vec_id", "prediction", F.to_json(vector_to_array("probability")).alias("probability"))


def _one_gaussian_loglik(d, dim, n):
    """Log likelihood of a single normal: closed form from the covariances."""
    import numpy as np

    e = lambda i: F.get("e", F.lit(i))
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]
    row = d.agg(*[F.covar_pop(e(i), e(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(dim)] for i in range(dim)])
    return float(-n / 2 * (dim * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + dim))


@query("ml_gmm_select")
def ml_gmm_select(t):
    dim = 4
    d = t.hold(components(t, dim))
    n, rows = d.count(), []
    for k in range(1, 21):
        ll = _one_gaussian_loglik(d, dim, n) if k == 1 else GaussianMixture(k=k, seed=1, maxIter=20).fit(d).summary.logLikelihood
        p = k - 1 + k * dim + k * dim * (dim + 1) / 2
        rows.append((k, ll, 2 * p - 2 * ll, p * math.log(n) - 2 * ll))
    return results(t, rows, "k int, loglik double, aic double, bic double")


@query("ml_gmm_sample")
def ml_gmm_sample(t):
    import numpy as np

    dim = 10
    m = GaussianMixture(k=3, seed=1, maxIter=20).fit(components(t, dim))
    cum = np.cumsum(m.weights)
    z = [stats.hash_normal(F.lit(j), F.col("vec_id")) for j in range(dim)]
    d = t.embeddings.select("vec_id", stats.hash_uniform(F.lit(-1), F.col("vec_id")).alias("u"), F.array(*z).alias("z"))
    comp = F.lit(0)
    for c in cum[:-1]:
        comp = comp + (F.col("u") > float(c)).cast("int")
    means = F.array(*[F.array(*[F.lit(float(v)) for v in g.mean]) for g in m.gaussians])
    # a row of the factor of the covariance for each component of the sample
    factors = F.array(*[F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in np.linalg.cholesky(g.cov.toArray())]) for g in m.gaussians])
    d = d.withColumn("component", comp).select("vec_id", "component", "z", F.get(means, F.col("component")).alias("m"), F.get(factors, F.col("component")).alias("f"))
    moved = F.transform("f", lambda row, i: F.get("m", i) + F.aggregate(F.zip_with(row, "z", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x))
    return d.select("vec_id", "component", moved.alias("sample"))


def fitted_pca(d, k):
    scaler = StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False).fit(d)
    c = scaler.transform(d)
    return scaler, c, PCA(k=k, inputCol="centred", outputCol="scores").fit(c)


@query("ml_pca")
def ml_pca(t):
    """Ten components by a range finder that never holds the matrix of moments."""
    d = vec(t).select("vec_id", "label", "e")
    out = lr.wide_components(d, "e", 10).project(d, "e")
    return out.select("vec_id", "label", F.to_json(F.transform("scores", lambda x: F.round(x, 6))).alias("scores"))


@query("ml_pca_variance_target")
def ml_pca_variance_target(t):
    _, _, m = fitted_pca(vec(t), 64)
    rows, total = [], 0.0
    for i, v in enumerate(m.explainedVariance, 1):
        total += float(v)
        rows.append((i, total, total >= 0.5))
    d = results(t, rows, "components int, share double, enough boolean")
    return d.withColumn("needed", d.filter("enough").agg(F.min("components")).scalar())


@query("ml_pca_reconstruct")
def ml_pca_reconstruct(t):
    scaler, c, m = fitted_pca(vec(t), 10)
    pc = m.pc.toArray()  # dimensions x components, model-sized
    mean = scaler.mean.toArray()
    table = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in pc])
    s = m.transform(c).select("vec_id", "e", vector_to_array("scores").alias("s"))
    back = F.zip_with(
        F.transform(table, lambda row: F.aggregate(F.zip_with(row, "s", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)),
        F.array(*[F.lit(float(v)) for v in mean]), lambda a, b: a + b,
    )
    err = F.aggregate(F.zip_with("e", back, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    return s.select("vec_id", F.round(F.sqrt(err), 6).alias("error"))


@query("ml_random_projection")
def ml_random_projection(t):
    import numpy as np

    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((64, 3)))
    dot = lambda j: F.aggregate(F.zip_with("e", F.array(*[F.lit(float(v)) for v in q[:, j]]), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return vec(t).select("vec_id", *[dot(j).alias(n) for j, n in enumerate("xyz")])


# ---- selection


def _cv(t, folds, grid=None):
    d = t.hold(lr.fold_column(binary(t), "vec_id", folds))
    clf = LogisticRegression(labelCol="y", maxIter=30)
    grid = grid or ParamGridBuilder().addGrid(clf.regParam, [0.01]).build()
    ev = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
    cv = CrossValidator(estimator=clf, estimatorParamMaps=grid(clf) if callable(grid) else grid, evaluator=ev, numFolds=folds, foldCol="fold", parallelism=4)
    return cv, cv.fit(d)


@query("ml_cross_val")
def ml_cross_val(t):
    _, m = _cv(t, 5)
    return results(t, [(5, float(m.avgMetrics[0]), float(m.stdMetrics[0]))], "folds int, mean double, std double")


@query("ml_two_fold")
def ml_two_fold(t):
    _, m = _cv(t, 2)
    return results(t, [(2, float(m.avgMetrics[0]), float(m.stdMetrics[0]))], "folds int, mean double, std double")


@query("ml_leave_one_out", f"SELECT count(*) AS n, round(avg((a.label = b.label)::INT), 6) AS accuracy FROM {knn_vectors_sql(1)} k JOIN embeddings a ON k.id = a.vec_id JOIN embeddings b ON k.neighbour = b.vec_id")
def ml_leave_one_out(t):
    """One nearest neighbour never includes the row itself, so its accuracy is the leave-one-out score."""
    k = vectors.knn_join(t.embeddings, "vec_id", "embedding", 1)
    p = nb.vote(k, t.embeddings, "vec_id", "label").join(t.embeddings.select(F.col("vec_id").alias("id"), "label"), "id")
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("accuracy"))


@query("ml_grid_search")
def ml_grid_search(t):
    cv, m = _cv(t, 3, lambda c: ParamGridBuilder().addGrid(c.regParam, [0.001, 0.01, 0.1]).addGrid(c.elasticNetParam, [0.0, 1.0]).build())
    rows = []
    for params, score in zip(m.getEstimatorParamMaps(), m.avgMetrics):
        p = {k.name: v for k, v in params.items()}
        rows.append((p["regParam"], p["elasticNetParam"], float(score)))
    d = results(t, rows, "reg double, mix double, score double")
    return d.withColumn("best", F.col("score") == d.agg(F.max("score")).scalar())


@query("ml_validation_curve")
def ml_validation_curve(t):
    """Polynomials of degree 0 to 20: one pass sums the products of all basis functions by fold, every fit is a small solve."""
    d = lr.fold_column(t.lineitem, "l_orderkey", 3).select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), "fold")
    curve = lr.polynomial_folds(d, "x", "y", "fold", 20)
    return results(t, curve, "degree int, train double, valid double")


@query("ml_learning_curve")
def ml_learning_curve(t):
    d = t.hold(lr.hash_split(binary(t), "vec_id", 0.3).withColumn("u", F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1000)) / 1000))
    train, test = d.filter("not is_test"), d.filter("is_test")
    rows = []
    for share in [i / 25 for i in range(1, 26)]:
        part = train.filter(F.col("u") < share)
        if part.select("y").distinct().count() < 2:
            continue  # one class teaches nothing
        m = LogisticRegression(labelCol="y", maxIter=30, regParam=0.01).fit(part)
        rows.append((share, accuracy(m.transform(part), "y"), accuracy(m.transform(test), "y")))
    return results(t, rows, "share double, train double, valid double")


# ---- models stated in SQL


_X = f"(SELECT vec_id, label, {_SPLIT.format(k='vec_id')} AS is_test, unnest(range(len(embedding)))::INT AS j, unnest(embedding)::DOUBLE AS v FROM embeddings)"
GNB_SQL = f"""WITH x AS {_X}, m AS (SELECT label AS c, j, avg(v) AS mu, var_pop(v) AS s, count(*) AS n FROM x WHERE NOT is_test GROUP BY 1, 2), tot AS (SELECT count(DISTINCT vec_id) AS total FROM x WHERE NOT is_test),
    sc AS (SELECT vec_id, any_value(x.label) AS label, c, ln(any_value(n) / any_value(total)) + sum(-0.5 * ln(2 * pi() * s) - (v - mu) ** 2 / (2 * s)) AS score FROM x JOIN m USING (j), tot WHERE is_test GROUP BY vec_id, c),
    best AS (SELECT vec_id, any_value(label) AS label, arg_max(c, (score, -c)) AS prediction, max(score) AS hi FROM sc GROUP BY 1)"""


def gaussian_nb(t):
    """Fitted on three quarters of the rows; predictions for the rest."""
    d = lr.hash_split(vec(t).select("vec_id", "label", "e"), "vec_id", 0.25, lr.integer_hash("vec_id"))
    model = lr.gaussian_nb_model(d.filter("not is_test"), "label", F.col("e"))
    return lr.gaussian_nb_predict(d.filter("is_test"), model, F.col("e")).select("vec_id", "label", "prediction", "probability")


@query("ml_gaussian_nb", f"{GNB_SQL} SELECT vec_id, any_value(b.label) AS label, any_value(prediction) AS prediction, round(1 / sum(exp(score - hi)), 6) AS probability FROM best b JOIN sc USING (vec_id) GROUP BY 1")
def ml_gaussian_nb(t):
    return gaussian_nb(t).select("vec_id", "label", "prediction", F.round("probability", 6).alias("probability"))


_MNB = f"""WITH c AS (SELECT doc_id, word, count(*) AS tf FROM {_WORDS} GROUP BY 1, 2), tr AS (SELECT c.*, lang FROM c JOIN documents USING (doc_id) WHERE doc_id % 5 <> 0),
    wc AS (SELECT word, lang, sum(tf) AS c FROM tr GROUP BY 1, 2), tot AS (SELECT lang, sum(c) AS total FROM wc GROUP BY 1), v AS (SELECT count(DISTINCT word) AS v FROM wc),
    pr AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS all_n FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1),
    wp AS (SELECT w.word, t.lang, ln((coalesce(wc.c, 0) + 0.1) / (total + 0.1 * v)) AS logp FROM (SELECT DISTINCT word FROM wc) w CROSS JOIN tot t LEFT JOIN wc ON wc.word = w.word AND wc.lang = t.lang, v),
    sc AS (SELECT doc_id, wp.lang AS cls, sum(tf * logp) + any_value(ln(n / all_n)) AS score FROM c JOIN wp USING (word) JOIN pr ON pr.lang = wp.lang WHERE doc_id % 5 = 0 GROUP BY 1, 2)"""


def multinomial_model(t):
    """Fitted on four fifths of the documents; returns the model and the predictions for the rest."""
    model = lr.fit_word_bayes(t.spread("documents").filter("doc_id % 5 <> 0"), "lang", "text", 0.1)
    held = t.spread("documents").filter("doc_id % 5 = 0")
    predicted = model.predict(held, lr.words(held, "doc_id", "text"), "doc_id").join(held.select("doc_id", "lang"), "doc_id")
    return model, predicted


@query(
    "ml_multinomial_nb",
    f"""{_MNB}, best AS (SELECT doc_id, arg_max(cls, score) AS cls FROM sc GROUP BY 1)
        SELECT doc_id, lang, coalesce(cls, (SELECT lang FROM pr ORDER BY n DESC, lang LIMIT 1)) AS prediction FROM documents LEFT JOIN best USING (doc_id) WHERE doc_id % 5 = 0""",
)
def ml_multinomial_nb(t):
    return multinomial_model(t)[1].select("doc_id", "lang", "prediction")


@query(
    "ml_knn_classify",
    f"""WITH v AS (SELECT k.id, e.label, count(*) AS n FROM {knn_vectors_sql(5)} k JOIN embeddings e ON k.neighbour = e.vec_id GROUP BY 1, 2)
        SELECT id, arg_max(label, (n, -label)) AS prediction FROM v GROUP BY 1""",
)
def ml_knn_classify(t):
    return nb.vote(vectors.knn_join(t.embeddings, "vec_id", "embedding", 5), t.embeddings, "vec_id", "label")


@query(
    "ml_kde_classifier",
    """WITH c AS (SELECT l_returnflag AS c, l_quantity AS x, count(*) AS k FROM lineitem GROUP BY 1, 2), s AS (SELECT q.x AS x, c, sum(k * exp(-0.5 * ((q.x - c.x) / 3) ** 2) / (3 * sqrt(2 * pi()))) AS s FROM (SELECT DISTINCT x FROM c) q, c GROUP BY 1, 2)
       SELECT x, arg_max(c, s) AS prediction, round(max(s) / sum(s), 6) AS probability FROM s GROUP BY 1""",
)
def ml_kde_classifier(t):
    from colonnade.operators.estimators import DensityClassifier

    d = t.lineitem.select("l_quantity", (F.ascii("l_returnflag")).alias("label"))
    model = DensityClassifier(inputCol="l_quantity", labelCol="label", bandwidth=3.0).fit(d)
    s = model.scores(d).groupBy("_x").agg(F.max_by("_c", "_s").alias("c"), (F.max("_s") / F.sum("_s")).alias("p"))
    return s.select(F.col("_x").alias("x"), F.char("c").alias("prediction"), F.round("p", 6).alias("probability"))
