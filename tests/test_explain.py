"""Explanation lists and group collapse on the reference's frame, and the full
explain on a tiny model checked against plain Python."""

import math

import pytest

from vigie.operators.explain import collapse_group, explain, list_concerning, list_reassuring
from vigie.operators.model import LinearModel

ROWS = [(-0.05, 1.0, 0.1, 0.0), (0.01, 1.0, 0.0, 10.0), (0.05, -0.5, -0.05, -5.0)]
COLS = ["equilibre_financier", "paydex_yoy", "paydex_other_feat", "ratio_dette"]


@pytest.fixture
def contrib(spark):
    return spark.createDataFrame(ROWS, ", ".join(f"{c} double" for c in COLS))


def test_concerning(contrib):
    got = [r.concerning for r in list_concerning(contrib, COLS, thr=0.1).collect()]
    assert got == [["paydex_yoy"], ["ratio_dette", "paydex_yoy"], []]


def test_reassuring(contrib):
    got = [r.reassuring for r in list_reassuring(contrib, COLS, thr=0.1).collect()]
    assert got == [[], [], ["ratio_dette", "paydex_yoy"]]


def test_collapse(contrib):
    groups = {"sante_financiere": ["equilibre_financier"], "retards_paiement": ["paydex_yoy", "paydex_other_feat"],
              "dette_urssaf": ["ratio_dette"]}
    out = collapse_group(contrib, groups)
    assert "retards_paiement" in out.columns and "paydex_yoy" not in out.columns
    assert out.first().retards_paiement == pytest.approx(1.1)


def test_explain_against_python(spark):
    model = LinearModel(groups={"g1": ["a", "c"], "retards_paiement": ["b"], "empty": []},
                        levels={"c": ["x", "y"]}, scaler={"a": (1.0, 2.0), "b": (0.0, 0.0)},
                        coefs={"c_x0_x": 0.5, "c_x0_y": -0.4, "a": 1.0, "b": -2.0}, intercept=-0.3)
    df = spark.createDataFrame([(3.0, 0.5, "x"), (-1.0, -0.2, "y")], "a double, b double, c string")
    out = explain(df, model, thresh_micro=0.05).collect()
    for row, (a, b, c) in zip(out, [(3.0, 0.5, "x"), (-1.0, -0.2, "y")]):
        contr = {"c_x0_x": 0.5 * (c == "x"), "c_x0_y": -0.4 * (c == "y"), "a": (a - 1.0) / 2.0, "b": -2.0 * b}
        norm = 0.3 + sum(abs(v) for v in contr.values())
        assert row.macro_expl["g1"] == pytest.approx((contr["c_x0_x"] + contr["c_x0_y"] + contr["a"]) / norm)
        assert row.macro_expl["model_offset"] == pytest.approx(-0.3 / norm)
        assert row.micro_expl["retards_paiement"] == pytest.approx(contr["b"] / norm)
        shift = -0.3 / 5
        radar = 1 / (1 + math.exp(-sum(v - shift for k, v in contr.items() if k != "b")))
        assert row.macro_radar["g1"] == pytest.approx(radar)
        assert "empty" not in row.macro_radar
        sel = {k: v for k, v in contr.items() if k != "b"}
        sel["retards_paiement"] = contr["b"]
        conc = [k for k, v in sorted(sel.items(), key=lambda kv: (-kv[1], kv[0])) if v >= 0.2]
        reas = [k for k, v in sorted(sel.items(), key=lambda kv: (kv[1], kv[0])) if v <= -0.2]
        assert [e.feature for e in row.expl_selection.select_concerning] == conc
        assert [e.feature for e in row.expl_selection.select_reassuring] == reas
