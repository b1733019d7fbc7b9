"""Queries without SQL: their results against closed forms and invariants."""

import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

NUM = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return lambda name: entry.queries()[name](spark, sf_dir).toPandas()


@pytest.fixture(scope="module")
def lines(sf_dir):
    p = duckdb.sql(f"select * from '{sf_dir}/lineitem.parquet'").df()
    return p[NUM].to_numpy(float), p["l_extendedprice"].to_numpy(), p


@pytest.fixture(scope="module")
def vectors(sf_dir):
    p = duckdb.sql(f"select * from '{sf_dir}/embeddings.parquet' order by vec_id").df()
    return np.vstack(p["embedding"].to_numpy()).astype(float), p["label"].to_numpy(), p["vec_id"].to_numpy()


def test_linear_regression_is_least_squares(run, lines):
    x, y, _ = lines
    want = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]
    assert run("ml_linear_regression")["value"].to_numpy() == pytest.approx(want, rel=1e-5, abs=1e-3)


def test_ridge_matches_closed_form(run, lines):
    x, y, _ = lines
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 0.1 * np.eye(4), xc.T @ yc)
    assert run("ml_ridge")["value"].to_numpy()[:4] == pytest.approx(want, rel=1e-4, abs=1e-2)


def test_lasso_zeroes_weak_columns(run):
    assert run("ml_lasso")["is_zero"].iloc[1:4].any()


def test_polyfit_matches_numpy(run, lines):
    x, y, _ = lines
    fit = np.polynomial.Polynomial.fit(x[:, 0], y, 3)
    got = run("stat_polyfit").sort_values("x")
    assert got["fitted"].to_numpy() == pytest.approx(fit(got["x"].to_numpy()), rel=1e-8)


def test_bootstrap_error_is_near_the_formula(run, sf_dir):
    p = duckdb.sql(f"select hour(ts)::double as x, value as y from '{sf_dir}/events.parquet'").df()
    x, y = p["x"].to_numpy(), p["y"].to_numpy()
    b, a = np.polyfit(x, y, 1)
    se = math.sqrt(((y - a - b * x) ** 2).sum() / (len(x) - 2) / ((x - x.mean()) ** 2).sum())
    got = run("stat_bootstrap_se").iloc[0]
    assert got["replicates"] == 1000 and 0.7 * se < got["slope_se"] < 1.4 * se and abs(got["slope"] - b) < se


def test_pca_shares(run, vectors):
    v = np.linalg.eigvalsh(np.cov(vectors[0].T))[::-1]
    got = run("ml_pca_variance_target").sort_values("components")
    assert got["share"].to_numpy() == pytest.approx(np.cumsum(v) / v.sum(), abs=1e-8)
    assert got["needed"].iloc[0] == int(np.argmax(np.cumsum(v) / v.sum() >= 0.5)) + 1


def test_pca_reconstruction_error(run, vectors):
    x = vectors[0] - vectors[0].mean(0)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    want = np.linalg.norm(x - x @ vt[:10].T @ vt[:10], axis=1)
    got = run("ml_pca_reconstruct").sort_values("vec_id")["error"].to_numpy()
    assert got == pytest.approx(want, abs=2e-6)


def test_random_projection_is_a_fixed_rotation(run, vectors):
    got = run("ml_random_projection").sort_values("vec_id")[["x", "y", "z"]].to_numpy()
    assert (np.linalg.norm(got, axis=1) <= np.linalg.norm(vectors[0], axis=1) + 1e-9).all()


def test_lloyd_reaches_a_fixed_point(run, vectors):
    x = vectors[0]
    got = run("ml_kmeans_by_hand").sort_values("vec_id")
    c = np.vstack([x[got["cluster"].to_numpy() == k].mean(0) for k in sorted(got["cluster"].unique())])
    inertia = (got["dist"] ** 2).sum()
    assert inertia <= ((x - x.mean(0)) ** 2).sum() and len(c) == 4


def test_single_gaussian_likelihood(run, vectors):
    x = vectors[0] - vectors[0].mean(0)
    x = x @ np.linalg.svd(x, full_matrices=False)[2][:4].T  # the first four components of all dimensions
    cov = np.cov(x.T, bias=True)
    want = -len(x) / 2 * (4 * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + 4)
    got = run("ml_gmm_select").set_index("k")
    assert got.loc[1, "loglik"] == pytest.approx(want, rel=1e-9)
    assert got.loc[1, "aic"] == pytest.approx(2 * 14 - 2 * want)


def test_scaling_is_fitted_on_the_training_rows(run):
    s = run("ml_standard_scale")
    train = s[~s["is_test"]].groupby("j")["scaled"]
    assert train.mean().abs().max() < 1e-5 and train.std().to_numpy() == pytest.approx(np.ones(64), abs=1e-5)


def test_leak_check_shows_the_leak(run):
    r = run("ml_target_leak_check").set_index("variant")["r2"]
    assert r["leaky"] > 0.9 > r["clean"]


def test_p_values_match_numeric_integration(run):
    r = run("stat_ttest_pvalue")
    for t, df, p in r[["t", "df", "p"]].itertuples(index=False):
        # many degrees of freedom: close to the normal tail
        assert p == pytest.approx(math.erfc(abs(t) / math.sqrt(2)), abs=2e-3)


def test_kernel_densities_sum_to_a_probability(run):
    p = run("udf_custom_classifier")
    assert p["probability"].between(0.5, 1).all()


def test_random_columns(run):
    g = run("generate_correlated")
    assert np.corrcoef(g["x"], g["y"])[0, 1] == pytest.approx(0.8 / math.sqrt(2), abs=0.06)


def test_topic_classifier_learns_languages(run):
    r = run("job_topic_classifier")
    f1 = r[(r["view"] == "report") & (r["class"] == "weighted avg")]["value"].iloc[0]
    assert f1 > 0.9


def test_shuffle_is_a_permutation_and_repeatable(run):
    a, b = run("shuffle_rows"), run("shuffle_rows")
    assert a["o_orderkey"].tolist() == b["o_orderkey"].tolist()
    assert sorted(a["o_orderkey"]) != a["o_orderkey"].tolist() and a["o_orderkey"].is_unique
