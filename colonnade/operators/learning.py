"""Learning operators that are aggregations: splits, Bayes models, TF-IDF, clustering steps."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
from pyspark.sql.window import Window as W

from colonnade.operators.ordered import with_position
from colonnade.session import scratch_path


def integer_hash(key: str) -> Column:
    """Multiplicative hash of a small integer key, easy to repeat in any SQL."""
    return (F.col(key) * 48271) % 2147483647


def hash_split(df: DataFrame, key: str, test_share: float, hashed: Column | None = None) -> DataFrame:
    """Add ``is_test`` from a hash of the key: the same split on every run and every cluster."""
    u = F.pmod(F.xxhash64(F.col(key)) if hashed is None else hashed, F.lit(10000))
    return df.withColumn("is_test", u < int(test_share * 10000))


def fold_column(df: DataFrame, key: str, k: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(99), F.col(key)), F.lit(k)).cast("int"))


def stratified_split(df: DataFrame, key: str, label: str, test_share: float, hashed: Column | None = None) -> DataFrame:
    """Exact class shares: the rows of each class in hash order, the first share goes to test; rows without a class are left out.

    Ranks come from global positions, so a class that owns most rows is still spread out. Where a class starts is looked up inside
    the row: a join would deal all rows to as many tasks as there are classes, and leave empty partitions for every later job to visit.
    """
    d = with_position(df.withColumn("_h", F.xxhash64(F.col(key)) if hashed is None else hashed), [label, "_h", key], "_pos").filter(F.col(label).isNotNull())
    starts = d.groupBy(label).agg(F.struct(F.min("_pos").alias("at"), F.count(F.lit(1)).alias("n")).alias("_s"))
    own = F.try_element_at(starts.agg(F.map_from_entries(F.collect_list(F.struct(label, "_s")))).scalar(), F.col(label))
    is_test = F.col("_pos") - own.getField("at") < F.floor(own.getField("n") * test_share)
    return d.select(label, *[c for c in df.columns if c != label], is_test.alias("is_test"))


def as_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weights n / (k * n_class); rows without a class are left out.

    The few weights are looked up inside the row: a join would deal all rows to as many tasks as there are classes.
    """
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    sizes = F.map_from_entries(F.collect_list(F.when(F.col(label).isNotNull(), F.struct(label, "_n"))))
    s = c.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"), sizes.alias("sizes"))).scalar()
    weight = s.getField("n") / (s.getField("k") * F.try_element_at(s.getField("sizes"), F.col(label)))
    return df.filter(F.col(label).isNotNull()).select(label, *[x for x in df.columns if x != label], weight.alias(out))


# ---- Gaussian naive Bayes


def gaussian_nb_model(df: DataFrame, label: str, vector: Column) -> Column:
    """Per class: prior, means and variances, as a one-row array (classes x dimensions)."""
    long = df.select(F.col(label).alias("c"), F.posexplode(vector).alias("j", "v"))
    per = long.groupBy("c", "j").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    cls = per.groupBy("c").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("j", "m", "s"))).alias("p"))
    # a feature that is constant in a class gets a billionth of the largest variance
    widest = F.aggregate("m", F.lit(0.0), lambda a, x: F.greatest(a, F.array_max(F.transform(x["p"], lambda y: y["s"]))))
    least = F.greatest(F.lit(1e-9) * F.col("widest"), F.lit(1e-300))
    floored = lambda p: F.transform(p, lambda y: F.struct(y["j"].alias("j"), y["m"].alias("m"), F.greatest(y["s"], least).alias("s")))
    model = F.transform("m", lambda x: F.struct(x["c"].alias("c"), x["n"].alias("n"), floored(x["p"]).alias("p")))
    return cls.agg(F.array_sort(F.collect_list(F.struct("c", "n", "p"))).alias("m")).withColumn("widest", widest).select(model.alias("m")).scalar()


def gaussian_nb_predict(df: DataFrame, model: Column, vector: Column) -> DataFrame:
    """``df`` with the likeliest class (the smaller one wins a tie) and its normalised probability; all inside the row."""
    d = df.withColumn("_model", model).withColumn("_v", vector)
    total = F.aggregate("_model", F.lit(0.0), lambda a, m: a + m["n"])
    density = lambda m: F.aggregate(
        F.zip_with("_v", m["p"], lambda v, p: -0.5 * F.ln(2 * math.pi * p["s"]) - (v - p["m"]) * (v - p["m"]) / (2 * p["s"])), F.lit(0.0), lambda a, x: a + x
    )
    d = d.withColumn("_total", total)
    d = d.withColumn("_scores", F.transform("_model", lambda m: F.struct((F.ln(m["n"] / F.col("_total")) + density(m)).alias("score"), m["c"].alias("c"))))
    d = d.withColumn("_hi", F.array_max(F.transform("_scores", lambda x: x["score"])))
    winner = F.array_min(F.transform(F.filter("_scores", lambda x: x["score"] == F.col("_hi")), lambda x: x["c"]))
    probability = 1 / F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x["score"] - F.col("_hi")))
    return d.withColumns({"prediction": winner, "probability": probability}).drop("_model", "_v", "_total", "_scores", "_hi")


# ---- text


def tokens(text: Column) -> Column:
    """Lower-case runs of letters of any script, one row each (empty pieces at the ends included)."""
    return F.explode(F.split(F.lower(text), r"[^\p{L}]+"))


def words(df: DataFrame, key: str, text: str, stop: Sequence[str] = ()) -> DataFrame:
    """Word counts per document ``(key, word, tf)``."""
    w = df.select(key, tokens(F.col(text)).alias("word")).filter("word <> ''")
    if stop:
        w = w.filter(~F.col("word").isin(list(stop)))
    return w.groupBy(key, "word").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(counts: DataFrame, key: str, max_features: int, documents: Column) -> DataFrame:
    """Smoothed, length-normalised weights over the most frequent words.

    ``documents`` is the corpus size. The norm is a window over one document's words, which
    came from a single row of text.
    """
    vocab = counts.groupBy("word").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocab = vocab.orderBy(F.desc("total"), "word").limit(max_features).select("word", "df")
    w = counts.join(vocab, "word").withColumn("w", F.col("tf") * (F.ln((1 + documents) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return w.select(key, "word", (F.col("w") / norm).alias("weight"))


@dataclass
class WordBayes:
    """Multinomial naive Bayes: class names, log priors, and a table of per-word log likelihoods."""

    classes: list
    priors: list[float]
    words: DataFrame  # word, lp0, lp1, ... one column per class

    def scores(self, counts: DataFrame, key: str) -> DataFrame:
        """One row per document with ``score_i`` per class; words never seen in training are skipped."""
        sums = [(F.sum(F.col("tf") * F.col(f"lp{i}")) + F.lit(p)).alias(f"score{i}") for i, p in enumerate(self.priors)]
        return counts.join(self.words, "word").groupBy(key).agg(*sums)

    def predict(self, docs: DataFrame, counts: DataFrame, key: str) -> DataFrame:
        """Most likely class of every row of ``docs`` (its ``key``); the first class in order wins a tie. Without a known word the priors decide."""
        s = docs.select(key).join(self.scores(counts, key), key, "left")
        return s.select(key, likeliest(self.classes, [F.coalesce(F.col(f"score{i}"), F.lit(p)) for i, p in enumerate(self.priors)]).alias("prediction"))


def likeliest(classes: list, scores: list[Column]) -> Column:
    """The class of the largest score, the first in order if several are."""
    best, out = F.greatest(*scores) if len(scores) > 1 else scores[0], None
    for c, score in zip(classes, scores):
        out = F.when(score == best, F.lit(c)) if out is None else out.when(score == best, F.lit(c))
    return out


@dataclass
class TopicModel:
    """TF-IDF weights and multinomial Bayes in one chain: class names, log priors, and per word of the vocabulary its ``idf`` and log likelihoods ``lp0``, ``lp1``, ..."""

    classes: list
    priors: list[float]
    words: DataFrame

    def predict(self, docs: DataFrame, key: str, text: str, stop: Sequence[str] = ()) -> DataFrame:
        """``key``, ``prediction`` and ``margin`` (log score before the next class) of any texts; words outside the vocabulary count for nothing, and
        a text without a known word gets the class of the highest prior. The vocabulary has at most as many rows as the fit was told."""
        w = words(docs, key, text, stop).join(self.words, "word").withColumn("w", F.col("tf") * F.col("idf"))
        sums = [F.sum(F.col("w") * F.col(f"lp{i}")).alias(f"s{i}") for i in range(len(self.classes))]
        dots = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *sums)
        scored = docs.select(key).join(dots, key, "left")
        scores = [F.coalesce(F.col(f"s{i}") / F.col("norm"), F.lit(0.0)) + F.lit(p) for i, p in enumerate(self.priors)]
        ranked = F.reverse(F.array_sort(F.array(*scores)))
        margin = F.get(ranked, F.lit(0)) - F.get(ranked, F.lit(1))
        return scored.select(key, likeliest(self.classes, scores).alias("prediction"), margin.alias("margin"))


def fit_topics(df: DataFrame, key: str, label: str, text: str, max_features: int = 5000, alpha: float = 0.1, stop: Sequence[str] = ()) -> TopicModel:
    """Fit the chain: TF-IDF weights over the most frequent words, summed by class, smoothed by ``alpha``. One row per class reaches the driver."""
    docs = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()
    classes, n = [r[label] for r in docs], sum(r["n"] for r in docs)
    counts = words(df.filter(F.col(label).isNotNull()), key, text, stop)
    vocab = counts.groupBy("word").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df")).orderBy(F.desc("total"), "word").limit(max_features)
    vocab = vocab.select("word", (F.ln((1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    weights = tfidf(counts, key, max_features, F.lit(n)).join(df.select(key, F.col(label).alias("_l")), key)
    seen = weights.groupBy("word").agg(*[F.sum(F.when(F.col("_l") == c, F.col("weight")).otherwise(0.0)).alias(f"c{i}") for i, c in enumerate(classes)])
    totals = seen.agg(F.struct(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"t{i}") for i in range(len(classes))])).scalar()
    logs = [F.ln((F.col(f"c{i}") + alpha) / (totals.getField(f"t{i}") + alpha * totals.getField("v"))).alias(f"lp{i}") for i in range(len(classes))]
    return TopicModel(classes, [math.log(r["n"] / n) for r in docs], seen.join(vocab, "word").select("word", "idf", *logs))


def fit_word_bayes(df: DataFrame, label: str, text: str, alpha: float) -> WordBayes:
    """One pass over the words: class counts per word, smoothed by ``alpha``.

    Only the class table (one row per class) and its totals reach the driver.
    """
    docs = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()
    classes, n = [r[label] for r in docs], sum(r["n"] for r in docs)
    occurrences = df.select(F.col(label).alias("_l"), tokens(F.col(text)).alias("word")).filter("word <> ''")
    seen = occurrences.groupBy("word").agg(*[F.count_if(F.col("_l") == c).alias(f"c{i}") for i, c in enumerate(classes)])
    totals = seen.agg(F.struct(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"t{i}") for i in range(len(classes))])).scalar()
    logs = [F.ln((F.col(f"c{i}") + alpha) / (totals.getField(f"t{i}") + alpha * totals.getField("v"))).alias(f"lp{i}") for i in range(len(classes))]
    return WordBayes(classes, [math.log(r["n"] / n) for r in docs], seen.select("word", *logs))


# ---- k-means step by step


def assign(df: DataFrame, vector: Column, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest centre (``cluster``) and squared distance; the centres are literals in the plan."""
    table = F.array(*[F.array(*[F.lit(float(c)) for c in row]) for row in centres])
    d = df.withColumn("_v", vector)
    dist = F.transform(table, lambda c, i: F.struct(F.aggregate(F.zip_with("_v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x).alias("d2"), i.alias("cluster")))
    return d.withColumn("_b", F.array_min(dist)).withColumns({"cluster": F.col("_b.cluster"), "d2": F.col("_b.d2")}).drop("_v", "_b")


def lloyd(df: DataFrame, vector: Column, centres: list[list[float]], rounds: int, tol: float = 1e-6) -> list[list[float]]:
    """Lloyd iterations. Only k centres come back per round, so no lineage builds up."""
    base = df.select(vector.alias("v"))
    dim = len(centres[0])
    for _ in range(rounds):
        sums = assign(base, F.col("v"), centres).groupBy("cluster").agg(*[F.avg(F.get("v", F.lit(j))).alias(f"m{j}") for j in range(dim)]).collect()
        new = [list(c) for c in centres]
        for r in sums:
            new[r["cluster"]] = [r[f"m{j}"] for j in range(dim)]
        moved = max(abs(a - b) for x, y in zip(new, centres) for a, b in zip(x, y))
        centres = new
        if moved < tol:
            break
    return centres


def fourier_features(df: DataFrame, vector: str, dim: int, count: int, gamma: float, seed: int = 3) -> DataFrame:
    """``df`` with ``features``: random Fourier features of the Gaussian kernel ``exp(-gamma d^2)``, one matrix product per batch.

    The product of two rows' features is their kernel up to an error of about ``1 / sqrt(count)``. Vectors that are null or of another length are left out.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    w, b = rng.standard_normal((dim, count)) * math.sqrt(2 * gamma), rng.uniform(0, 2 * math.pi, count)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            z = math.sqrt(2 / count) * np.cos(x @ w + b)
            lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, count, dtype=np.int32), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "_z"])

    src = df.filter(F.size(vector) == dim)
    schema = StructType([*src.schema.fields, StructField("_z", ArrayType(DoubleType()))])
    return src.mapInArrow(run, schema).withColumn("features", array_to_vector("_z")).drop("_z")


@dataclass
class WideComponents:
    """Principal components of wide vectors: ``mean``, ``directions`` (one row each, the entry of largest size positive), their ``variances`` and the ``total`` variance."""

    mean: object
    directions: object
    variances: object
    total: float

    def project(self, df: DataFrame, vector: str, out: str = "scores") -> DataFrame:
        """``df`` with the coordinates of ``vector`` along the directions, one matrix product per batch; null for vectors that are null or of another length."""
        import numpy as np

        mean, directions, dim = self.mean, self.directions, len(self.mean)

        @F.arrow_udf(ArrayType(DoubleType()))
        def scores(v):
            import pyarrow as pa

            fine = np.array([x.is_valid and len(x.values) == dim for x in v], bool)
            x = v.filter(pa.array(fine)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            lists = iter(((x - mean) @ directions.T).tolist())
            return pa.array([next(lists) if ok else None for ok in fine], pa.list_(pa.float64()))

        return df.withColumn(out, scores(F.col(vector)))


def wide_components(df: DataFrame, vector: str, k: int, extra: int = 10, rounds: int = 8, seed: int = 11) -> WideComponents:
    """The ``k`` leading principal components without a matrix of moments: a block Krylov range finder.

    A round multiplies the covariance with ``k + extra`` directions in one pass (each batch is two thin matrix products), and the product, made orthogonal
    to all directions so far, is the next block; the components are the best in the span of all blocks. What travels is ``dim * (k + extra)`` numbers for each task, summed
    by place before they reach the driver, which holds ``dim * (k + extra) * rounds``: vectors of many thousand entries fit, where their squared moments would not. The span is
    complete, and the answer exact, once it holds ``dim`` directions. Vectors that are null, of another length than the most common or not finite are left out.
    """
    import numpy as np
    import pyarrow as pa

    empty = WideComponents(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    v = df.select(F.col(vector).cast("array<double>").alias("v")).filter("v is not null and size(v) > 0")
    v = v.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    common = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return empty
    dim, n = common["d"], common["n"]
    v = v.filter(F.size("v") == dim)

    def summed(of, width: int):
        """Sum over all rows of ``of(batch of vectors)``, a ``dim x width`` matrix."""
        def run(batches):
            total = None
            for b in batches:
                for a in range(0, b.num_rows, 512):
                    x = b.column("v").slice(a, 512).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    part = of(x)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["j", "s"])

        rows = v.mapInArrow(run, "j int, s array<double>").groupBy("j").agg(*[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(width)])
        out = np.zeros((dim, width))
        for r in rows.collect():
            out[r["j"]] = r[1:]
        return out

    first = summed(lambda x: np.column_stack([x.sum(axis=0), (x * x).sum(axis=0)]), 2)
    mean = first[:, 0] / n
    total = max(float((first[:, 1] - n * mean * mean).sum()), 0.0) / max(n - 1, 1)
    width = min(k + extra, dim)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
    basis, images = np.zeros((dim, 0)), np.zeros((dim, 0))
    for _ in range(rounds):
        def product(x, block=block):
            centred = x - mean
            return centred.T @ (centred @ block)

        image = summed(product, block.shape[1]) / max(n - 1, 1)
        basis, images = np.column_stack([basis, block]), np.column_stack([images, image])
        if basis.shape[1] >= dim:
            break
        rest = image
        for _ in range(2):  # twice, so rounding leaves nothing of the earlier blocks
            rest = rest - basis @ (basis.T @ rest)
        u, size, _ = np.linalg.svd(rest, full_matrices=False)
        kept = size > 1e-12 * max(np.linalg.norm(image), 1e-300)
        block = u[:, kept][:, : dim - basis.shape[1]]
        if not block.shape[1]:
            break
    small = basis.T @ images
    value, vector_ = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-value)[: min(k, dim)]
    directions = (basis @ vector_[:, order]).T
    sign = np.sign(directions[np.arange(len(directions)), np.abs(directions).argmax(axis=1)])
    return WideComponents(mean, directions * np.where(sign == 0, 1, sign)[:, None], np.maximum(value[order], 0), total)


def minibatch(df: DataFrame, key: str, vector: Column, centres: list[list[float]], batches: int, rounds: int = 1) -> list[list[float]]:
    """K-means by mini-batches: a centre moves towards the mean of its rows of a batch, by their share of all rows it has had so far.

    Rows are dealt to batches by the hash of their key, so every row is used in every round. The batches are written once, each to a folder
    of its own in the shared folder, so a step reads its batch and nothing else; only ``k`` sums come back from it.
    """
    spark, dim = df.sparkSession, len(centres[0])
    path = scratch_path(spark, "batches")
    df.select(vector.alias("v"), batch_of(key, batches).alias("batch")).filter("v is not null").write.partitionBy("batch").parquet(path)
    stored = spark.read.parquet(path)
    centres, had = [list(map(float, c)) for c in centres], [0] * len(centres)
    for _ in range(rounds):
        for b in range(batches):
            part = assign(stored.filter(F.col("batch") == b), F.col("v"), centres)
            for r in part.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.get("v", F.lit(j))).alias(f"m{j}") for j in range(dim)]).collect():
                c = r["cluster"]
                had[c] += r["n"]
                rate = r["n"] / had[c]
                centres[c] = [x + rate * (r[f"m{j}"] - x) for j, x in enumerate(centres[c])]
    return centres


def batch_of(key: str, batches: int) -> Column:
    """The batch of a row."""
    return F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(batches)).cast("int")


def polynomial_folds(df: DataFrame, x: str, y: str, fold: str, degree: int) -> list[tuple[int, float, float]]:
    """``(degree, train r2, validation r2)`` of least-squares polynomials of degree 0 to ``degree``, averaged over the folds.

    The basis is Chebyshev's on the range of ``x``, which keeps high degrees well conditioned. One pass sums the products of
    all basis functions by fold; the sums of the training folds hold every fit, those of the other fold its score.
    """
    import numpy as np

    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(fold).alias("f")).filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    lo, hi = d.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return []
    m = degree + 1

    def sums(batches):
        import pyarrow as pa

        total = {}
        for b in batches:
            xs, ys, fs = (b.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "f"))
            z = np.polynomial.chebyshev.chebvander(2 * (xs - lo) / ((hi - lo) or 1.0) - 1, degree)
            rows = np.column_stack([z, ys])
            for f in np.unique(fs).tolist():
                own = rows[fs == f]
                total[f] = total.get(f, 0) + own.T @ own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.ravel().tolist() for v in total.values()], pa.list_(pa.float64()))], ["f", "sums"])

    parts = d.mapInArrow(sums, "f int, sums array<double>").groupBy("f").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range((m + 1) ** 2)])
    by = {r["f"]: np.array(r[1:]).reshape(m + 1, m + 1) for r in parts.collect()}
    every, out = sum(by.values()), []

    def r2(g, w, k):
        n, sy, syy = g[0, 0], g[0, m], g[m, m]
        left = syy - 2 * w @ g[:k, m] + w @ g[:k, :k] @ w
        spread = syy - sy * sy / n
        return float(1 - left / spread) if spread > 0 else 0.0

    for k in range(1, m + 1):
        scores = []
        for own in by.values():
            train = every - own if len(by) > 1 else own
            w = np.linalg.lstsq(train[:k, :k], train[:k, m], rcond=1e-13)[0]
            scores.append((r2(train, w, k), r2(own, w, k)))
        out.append((k - 1, float(np.mean([a for a, _ in scores])), float(np.mean([b for _, b in scores]))))
    return out


# ---- evaluation


def binary_counts(label: str, pred: Column) -> dict[str, Column]:
    y = F.col(label) == 1
    return {"tp": F.count_if(y & pred), "fp": F.count_if(~y & pred), "fn": F.count_if(y & ~pred), "tn": F.count_if(~y & ~pred)}


def ratios(tp="tp", fp="fp", fn="fn", beta: float = 1.0) -> dict[str, Column]:
    """Precision, recall and F-beta, zero where the denominator is empty."""
    b2 = beta * beta
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
    return {"precision": z(tp, tp + fp), "recall": z(tp, tp + fn), "fbeta": z((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)}


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts at every threshold.

    Rows are counted by how many thresholds they reach; the sweep itself runs over those
    few counts.
    """
    ths = F.array(*[F.lit(float(th)) for th in sorted(thresholds)])
    reached = F.size(F.filter(ths, lambda th: th <= F.col(score)))
    counts = df.groupBy(reached.alias("_r")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_q"))
    each = counts.select("_r", "_p", "_q", F.posexplode(ths).alias("_i", "threshold"))
    over = F.col("_r") > F.col("_i")
    part = lambda c, cond, n: F.sum(F.when(cond, F.col(c)).otherwise(0)).alias(n)
    return each.groupBy("threshold").agg(part("_p", over, "tp"), part("_q", over, "fp"), part("_p", ~over, "fn"), part("_q", ~over, "tn"))


def score_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Running positives and negatives over the distinct scores, highest first.

    Equal scores are counted before the running total, which itself works on slices.
    """
    from colonnade.operators.ordered import running

    per = df.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
    return running(per, [], [F.desc("score")], {"tp": ("sum", F.col("p")), "fp": ("sum", F.col("n"))})


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve: each score step adds one trapezoid, computable row by row; null if a class has no row."""
    pts = score_points(df, label, score)
    area = F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2))
    return pts.agg(F.try_divide(area, F.sum("p") * F.sum("n")).alias("auc"))
