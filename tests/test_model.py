"""Encoding and logistic fit against a numpy Newton solve of the reference's
objective (sum of log-losses + 1/2 |w|^2, intercept not penalised)."""

import numpy as np
import pytest

from vigie.operators.model import LinearModel, encode, fit_logistic, fit_levels, fit_scaler


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 400
    a = rng.normal(3, 2, n)
    b = rng.exponential(5, n)
    c = rng.choice(["lo", "mid", "hi"], n)
    z = -1 + 0.8 * (a - 3) / 2 - 0.1 * b + (c == "hi") * 1.0
    y = rng.random(n) < 1 / (1 + np.exp(-z))
    df = spark.createDataFrame([(float(x1), float(x2), str(x3), bool(t)) for x1, x2, x3, t in zip(a, b, c, y)],
                               "a double, b double, c string, outcome boolean").cache()
    return df, a, b, c, y


GROUPS = {"g1": ["c", "a"], "g2": ["b"]}


def newton(X, y, iters=50):
    Xb = np.hstack([X, np.ones((len(X), 1))])
    w = np.zeros(Xb.shape[1])
    reg = np.eye(Xb.shape[1])
    reg[-1, -1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = Xb.T @ (p - y) + reg @ w
        H = Xb.T @ (Xb * (p * (1 - p))[:, None]) + reg
        w -= np.linalg.solve(H, g)
    return w


def test_scaler_and_levels(data):
    df, a, b, c, _ = data
    sc = fit_scaler(df, ["a", "b"])
    assert sc["a"][0] == pytest.approx(a.mean()) and sc["a"][1] == pytest.approx(a.std())   # population std
    assert fit_levels(df, ["c"]) == {"c": ["hi", "lo", "mid"]}


def test_fit_matches_newton(data):
    df, a, b, c, y = data
    model = fit_logistic(df, GROUPS, ["c"])
    assert model.encoded_names() == ["c_x0_hi", "c_x0_lo", "c_x0_mid", "a", "b"]
    X = np.column_stack([(c == "hi"), (c == "lo"), (c == "mid"), (a - a.mean()) / a.std(), (b - b.mean()) / b.std()])
    w = newton(X.astype(float), y.astype(float))
    got = [model.coefs[n] for n in model.encoded_names()] + [model.intercept]
    assert got == pytest.approx(list(w), abs=1e-9)


def test_score_and_persistence(spark, data, scratch):
    df, *_ = data
    model = fit_logistic(df, GROUPS, ["c"])
    model.save(spark, f"{scratch}/model")
    again = LinearModel.load(spark, f"{scratch}/model")
    assert again == model
    p1 = [r.predicted_probability for r in model.score(df).collect()]
    p2 = [r.predicted_probability for r in again.score(df).collect()]
    assert p1 == p2 and all(0 < p < 1 for p in p1)


def test_zero_std_divides_by_one(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "k double")
    m = encode(df, {"g": ["k"]}, [])
    m.coefs = {"k": 2.0}
    assert [r[0] for r in df.select(m.margin()).collect()] == [0.0, 0.0]


def test_unknown_level_is_an_error(spark, data):
    df, *_ = data
    model = fit_logistic(df.filter("c != 'mid'"), GROUPS, ["c"])
    assert model.levels == {"c": ["hi", "lo"]}
    model.check_levels(df.filter("c != 'mid'"))
    with pytest.raises(ValueError):
        model.check_levels(df)


@pytest.fixture(scope="module")
def panel_rows(spark):
    """Rows of 40 firms; some without a firm; one level and one outcome that occur in a single firm."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        firm = int(rng.integers(0, 40))
        a, b = rng.normal(5, 2), rng.exponential(100) + firm
        c = "rare" if firm == 0 else str(rng.choice(["lo", "hi"]))
        y = bool(rng.random() < 1 / (1 + np.exp(-(a - 5) + .01 * b)))
        rows.append((None if i % 30 == 0 else f"{firm:09d}", float(a), float(b), c, y))
    return rows, spark.createDataFrame(rows, "siren string, a double, b double, c string, outcome boolean").cache()


def fold_of(folds):
    return {r.siren: r.fold for r in folds.collect()}


@pytest.mark.parametrize("k", [1, 2, 5])
def test_fold_models_match_newton_on_their_own_rows(panel_rows, k):
    from vigie.operators.model import fit_folds
    from vigie.operators.split import siren_folds
    rows, df = panel_rows
    folds = siren_folds(df, df, k, seed=1)
    at = fold_of(folds)
    if k == 1:  # nothing is left to train on but rows of no firm
        with pytest.raises(ValueError):
            fit_folds(df.where("siren is not null"), folds, 1, GROUPS, ["c"])
        return
    models = fit_folds(df, folds, k, GROUPS, ["c"])
    for j, m in enumerate(models):
        own = [r for r in rows if r[0] is None or at[r[0]] != j]
        a, b, y = (np.array([r[i] for r in own], float) for i in (1, 2, 4))
        c = np.array([r[3] for r in own])
        assert m.scaler["a"] == pytest.approx((a.mean(), a.std())) and m.scaler["b"] == pytest.approx((b.mean(), b.std()))
        X = np.column_stack([(c == "hi"), (c == "lo"), (c == "rare"), (a - a.mean()) / a.std(), (b - b.mean()) / b.std()])
        got = [m.coefs[n] for n in m.encoded_names()] + [m.intercept]
        assert got == pytest.approx(list(newton(X.astype(float), y)), abs=1e-8)
    assert any(m.coefs["c_x0_rare"] == pytest.approx(0, abs=1e-12) for m in models)


def test_scores_and_metrics_of_unseen_firms(spark, panel_rows):
    from vigie.operators.model import cross_validate, fit_folds, score_folds
    from vigie.operators.split import siren_folds
    rows, df = panel_rows
    extra = spark.createDataFrame([("999999999", 1.0, 2.0, "lo", True)], df.schema)  # a firm unknown to training
    test = df.unionByName(extra)
    folds = siren_folds(df, test, 4, seed=2)
    at, models = fold_of(folds), fit_folds(df, folds, 4, GROUPS, ["c"])
    got = score_folds(test, folds, models).collect()
    assert len(got) == sum(r[0] is not None for r in rows)
    for r in got:
        assert r.fold == at[r.siren]
        m = models[r.fold]
        x = {"a": (r.a - m.scaler["a"][0]) / m.scaler["a"][1], "b": (r.b - m.scaler["b"][0]) / m.scaler["b"][1], f"c_x0_{r.c}": 1.0}
        z = m.intercept + sum(m.coefs[n] * v for n, v in x.items())
        assert r.predicted_probability == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-12)
    for r in cross_validate(df, test, 4, GROUPS, ["c"], seed=2, beta=2).collect():
        mine = [(x.predicted_probability >= .5, x.outcome) for x in got if x.fold == r.fold]
        tp, fp, fn = (mine.count(c) for c in ((True, True), (True, False), (False, True)))
        assert (r.n, r.tp, r.fp, r.fn) == (len(mine), tp, fp, fn)
        assert r.precision == pytest.approx(tp / (tp + fp)) and r.fbeta == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp))


def test_certificate_damping_and_refusals(spark):
    from vigie.operators import newton as N
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2)) * [1, 400]  # far from standardised: plain Newton steps overshoot
    y = (x[:, 1] + 300 * rng.normal(size=300) > 500).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t), None) for v, t in zip(x, y)], "x array<double>, y double, fold int")
    done = N.fit(df, 2, [0])[0]
    assert done.gradient <= N.TOL and 0 <= done.gap < 1e-9 and done.rows == 300
    assert [*done.weights, done.intercept] == pytest.approx(list(newton(x, y, 200)), rel=1e-6)
    with pytest.raises(ValueError, match="both outcomes"):
        N.fit(df.where("y = 1"), 2, [0])
    with pytest.raises(Exception, match="null or NaN"):
        N.fit(spark.createDataFrame([([1.0, None], 1.0, None), ([1.0, 2.0], 0.0, None)], df.schema), 2, [0])


def test_wide_encodings_reach_the_same_weights(data, monkeypatch):
    from vigie.operators import newton as N
    df, *_ = data
    want = fit_logistic(df, GROUPS, ["c"])
    monkeypatch.setattr(N, "MAX_COLUMNS", 2)
    got = fit_logistic(df, GROUPS, ["c"])
    assert [got.coefs[n] for n in got.encoded_names()] == pytest.approx([want.coefs[n] for n in want.encoded_names()], abs=1e-5)
