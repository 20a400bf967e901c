"""Operators: DataFrame -> DataFrame functions (and a few bounded summaries).

dataset (scan, filters, exact top-n, quota sample), clean, sampling, ranking
(distributed ranks / running sums / lag), split (folds, leakage), metrics,
thresholds, merge, adjust, explain, model (encoding, fit, scoring), synthetic.
"""
