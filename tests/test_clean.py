"""Cleaning steps on the reference's 20-row frame."""

import random

import pytest

from vigie.operators.clean import remove_na, remove_siren, remove_strong_signals, replace_missing_data
from vigie.operators.dataset import EmptyDataset, raise_if_empty

TTO = [10] * 13 + [0] * 4 + [None] * 2 + [-2]
FEAT = [None] * 9 + [2] * 11


@pytest.fixture
def frame(spark):
    rnd = random.Random(3)
    rows = [(str(100000000 + i), rnd.random() > 0.5, TTO[i], FEAT[i]) for i in range(20)]
    return spark.createDataFrame(rows, "siren string, output boolean, time_til_outcome int, my_feature int")


def test_full_drop_na(frame):
    assert remove_na(frame, []).count() == 9


def test_part_drop_na(frame):
    assert remove_na(frame, ["time_til_outcome"]).count() == 11


def test_fill_then_drop(frame):
    assert remove_na(replace_missing_data(frame, {"my_feature": 0}), []).count() == 18


def test_fill_skips_absent_columns(frame):
    out = replace_missing_data(frame, {"my_feature": 0, "not_there": 1.0})
    assert out.columns == frame.columns


def test_strong_signals_keep_null(frame):
    assert remove_strong_signals(frame).count() == 15


def test_chain(frame):
    out = remove_strong_signals(remove_na(replace_missing_data(frame, {"my_feature": 0}), []))
    assert out.count() == 13


def test_strong_signals_needs_column(frame):
    with pytest.raises(ValueError):
        remove_strong_signals(frame.drop("time_til_outcome"))


def test_remove_siren(frame):
    sirens = [r.siren for r in frame.select("siren").collect()][3:9]
    assert remove_siren(frame, sirens).count() == 14


def test_remove_siren_keeps_null(spark):
    df = spark.createDataFrame([("1",), (None,)], "siren string")
    assert remove_siren(df, ["1"]).count() == 1


def test_raise_if_empty(spark, frame):
    with pytest.raises(EmptyDataset):
        raise_if_empty(None)
    with pytest.raises(EmptyDataset):
        raise_if_empty(frame.limit(0))
    assert raise_if_empty(frame) is frame
