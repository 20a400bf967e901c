"""Pipelines of steps.

A ``Step`` is ``(name, function, inputs, outputs)`` with ``function: DataFrame ->
DataFrame``.  ``run_pipeline`` checks the column contract on the schema only
(no Spark job), then composes the functions into one logical plan.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import debt_per_head_delta, paydex_group, paydex_yoy
from vigie.operators.clean import remove_administrations

log = logging.getLogger(__name__)


class MissingDataError(Exception):
    """A step's input columns are missing."""


@dataclass(frozen=True)
class Step:
    name: str
    function: Callable[[DataFrame], DataFrame]
    inputs: tuple[str, ...]
    outputs: tuple[str, ...] | None = None


def run_pipeline(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Check every step's inputs up front, then chain the steps.

    Inputs are checked against the initial columns plus the outputs declared by
    earlier steps, so a step may consume what a previous step makes.
    """
    available = set(df.columns)
    for step in steps:
        missing = set(step.inputs) - available
        if missing:
            raise MissingDataError(f"step {step.name}: absent columns {sorted(missing)}")
        available |= set(step.outputs or ())
    out = df
    for i, step in enumerate(steps, 1):
        log.info("STEP %d: %s", i, step.name)
        out = step.function(out)
        if step.outputs:
            absent = set(step.outputs) - set(out.columns)
            if absent:
                log.warning("STEP %d: %s did not produce expected output %s", i, step.name, sorted(absent))
    return out


def check_feature(feature: str, variables: Sequence[str], steps: Sequence[Step]) -> bool:
    """P5: a feature is fetched or made by a step."""
    return feature in variables or any(step.outputs and feature in step.outputs for step in steps)


def add_paydex_yoy(df: DataFrame) -> DataFrame:
    return df.withColumn("paydex_yoy", paydex_yoy())


def add_paydex_group(df: DataFrame) -> DataFrame:
    return df.withColumn("paydex_group", paydex_group())


def add_debt_per_head_delta(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_delta_dette_par_effectif", debt_per_head_delta())


DEBT_INPUTS = ("effectif", "montant_part_patronale", "montant_part_ouvriere",
               "montant_part_patronale_past_3", "montant_part_ouvriere_past_3")

REMOVE_ADMINISTRATIONS = Step("Remove Administrations", remove_administrations, ("code_naf",), None)
MAKE_PAYDEX_YOY = Step("Make `paydex_yoy`", add_paydex_yoy,
                       ("paydex_nb_jours", "paydex_nb_jours_past_12"), ("paydex_yoy",))
MAKE_PAYDEX_GROUP = Step("Make `paydex_group`", add_paydex_group, ("paydex_nb_jours",), ("paydex_group",))
MAKE_DEBT_DELTA = Step("Make `avg_delta_dette_par_effectif`", add_debt_per_head_delta,
                       DEBT_INPUTS, ("avg_delta_dette_par_effectif",))

DEFAULT_PIPELINE = (REMOVE_ADMINISTRATIONS, MAKE_PAYDEX_YOY, MAKE_PAYDEX_GROUP, MAKE_DEBT_DELTA)
SMALL_PIPELINE = (REMOVE_ADMINISTRATIONS, MAKE_DEBT_DELTA)

