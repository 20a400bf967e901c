"""Metrics, curve and thresholds against brute-force numpy versions of the
reference's formulas (sklearn 0.24 semantics)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.operators import metrics, ranking, thresholds


def _data(seed=1, n=600):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.3
    s = np.round(np.clip(0.35 * y + rng.random(n) * 0.7, 0, 1), 2)   # ties on purpose
    return y, s


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    y, s = _data(request.param)
    df = spark.createDataFrame([(bool(a), float(b)) for a, b in zip(y, s)], "outcome boolean, score double")
    return y, s, df.cache()


@pytest.fixture(autouse=True)
def many_buckets(monkeypatch):
    monkeypatch.setattr(ranking, "_TARGET_ROWS_PER_BUCKET", 7)


def np_curve(y, s):
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    distinct = np.where(np.diff(ss))[0]
    idx = np.r_[distinct, len(ys) - 1]
    tps = np.cumsum(ys)[idx]
    fps = 1 + idx - tps
    thr = ss[idx]
    precision = tps / (tps + fps)
    recall = tps / tps[-1]
    last = tps.searchsorted(tps[-1])
    sl = slice(last, None, -1)
    return np.r_[precision[sl], 1], np.r_[recall[sl], 0], thr[sl]


def test_pr_curve(case):
    y, s, df = case
    p, r, t = np_curve(y, s)
    rows = metrics.pr_curve(df).collect()
    real = sorted([x for x in rows if x.threshold is not None], key=lambda x: x.threshold)
    assert [x.threshold for x in real] == pytest.approx(list(t))
    assert [x.precision for x in real] == pytest.approx(list(p[:-1]))
    assert [x.recall for x in real] == pytest.approx(list(r[:-1]))
    final = [x for x in rows if x.threshold is None]
    assert len(final) == 1 and final[0].precision == 1.0 and final[0].recall == 0.0


def test_average_precision(case):
    y, s, df = case
    p, r, _ = np_curve(y, s)
    want = -np.sum(np.diff(r) * p[:-1])
    assert metrics.average_precision(df).first()[0] == pytest.approx(want)


def test_confusion_and_evaluate(case):
    y, s, df = case
    pred = s >= 0.5
    tp, fp = int((pred & y).sum()), int((pred & ~y).sum())
    fn, tn = int((~pred & y).sum()), int((~pred & ~y).sum())
    row = metrics.evaluate(df, beta=2, thresh=0.5).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (tn, fp, fn, tp)
    prec, rec = tp / (tp + fp), tp / (tp + fn)
    assert row.precision == pytest.approx(prec) and row.recall == pytest.approx(rec)
    assert row.f2 == pytest.approx(5 * prec * rec / (4 * prec + rec))
    assert row.balanced_accuracy == pytest.approx((rec + tn / (tn + fp)) / 2)


def test_fbeta_sweep(case):
    y, s, df = case
    grid = np.linspace(0, 1, 50)

    def fb(t, b):
        pred = s >= t
        tp = (pred & y).sum()
        p = tp / pred.sum() if pred.sum() else 0.0
        r = tp / y.sum()
        return (1 + b * b) * p * r / (b * b * p + r) if (b * b * p + r) else 0.0

    f05 = [fb(t, 0.5) for t in grid]
    f2 = [fb(t, 2) for t in grid]
    row = thresholds.thresholds_from_fbeta(df, 0.5, 2, n_thr=50).first()
    assert row.t_f1 == pytest.approx(grid[int(np.argmax(f05))])
    assert row.t_f2 == pytest.approx(grid[int(np.argmax(f2))])
    assert row.fbeta_f1 == pytest.approx(max(f05))


def test_fbeta_grid_bounds(case):
    _, _, df = case
    with pytest.raises(ValueError):
        thresholds.fbeta_sweep(df, thresh=[0.1, 1.2])


@pytest.mark.parametrize("pmin,rmin", [(0.6, 0.63), (0.9, 0.2), (0.0, 0.0), (0.4, 0.99)])
def test_conditions_reference_mode(case, pmin, rmin):
    y, s, df = case
    p, r, t = np_curve(y, s)
    i1 = int(np.argmax(p >= pmin))
    want_f1 = None if i1 >= len(t) else t[i1]
    want_f2 = t[::-1][int(np.argmax(r[::-1][:-1] >= rmin))]
    row = thresholds.thresholds_from_conditions(metrics.pr_curve(df), pmin, rmin).first()
    assert (row.t_f1 is None and want_f1 is None) or row.t_f1 == pytest.approx(want_f1)
    assert row.t_f2 == pytest.approx(want_f2)


def test_recall_gradient(case):
    y, s, df = case
    _, r, t = np_curve(y, s)
    fod = ((r[:-1] - np.roll(r[:-1], 1)) / (t - np.roll(t, 1)))[1:]
    rows = sorted(thresholds.recall_gradient(metrics.pr_curve(df)).collect(), key=lambda x: x.threshold)
    assert [x.recall_gradient for x in rows] == pytest.approx(list(fod))
    assert [x.type2_error for x in rows] == pytest.approx(list(1 - r[1:-1]))


def test_running_sums_ascending(spark):
    df = spark.range(300).select(F.col("id").cast("double").alias("k"), F.lit(1).alias("one"))
    out = ranking.running_sums(df, "k", ["one"], descending=False)
    assert all(r.cum_one == r.k + 1 for r in out.collect())


def test_alert_counts_and_balance(spark):
    df = spark.createDataFrame([(0.9,), (0.75,), (0.5,), (0.3,), (0.1,), (None,)], "predicted_probability double")
    row = metrics.alert_counts(df, 0.75, 0.3).first()
    assert (row.n_total, row.n_red, row.n_orange) == (6, 1, 2)
    assert row.pct_red == 16.67
    with pytest.raises(ValueError):
        metrics.alert_counts(df, 0.3, 0.75)


def test_steepest_recall_drop(case):
    y, s, df = case
    _, r, t = np_curve(y, s)
    fod = ((r[:-1] - np.roll(r[:-1], 1)) / (t - np.roll(t, 1)))[1:]
    grad = thresholds.recall_gradient(metrics.pr_curve(df))
    row = thresholds.steepest_recall_drop(grad).first()
    assert row.recall_gradient == pytest.approx(fod.min())
    row2 = thresholds.steepest_recall_drop(grad, skip_highest=3).first()
    assert row2.recall_gradient == pytest.approx(fod[:-3].min())


def test_select_alert_thresholds(case):
    from vigie.plans.selection import select_alert_thresholds

    _, _, df = case
    fb = select_alert_thresholds(df, "fbeta", n_thr=50)
    row = thresholds.thresholds_from_fbeta(df, 0.5, 2, n_thr=50).first()
    assert (fb["t_f1"], fb["t_f2"]) == (row.t_f1, row.t_f2)
    assert fb["eval_f1"]["f0.5"] == pytest.approx(row.fbeta_f1)
    cond = select_alert_thresholds(df, "conditions", min_precision_F1=0.6, min_recall_F2=0.63)
    assert cond["t_f2"] is not None and "eval_f2" in cond
    with pytest.raises(ValueError):
        select_alert_thresholds(df, "nope")
