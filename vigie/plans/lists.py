"""Alert list production (P17): earlier prediction files -> merge by priority
-> alert flags -> level counts -> JSON-lines score list."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from vigie.operators.merge import merge_models, score_list
from vigie.operators.metrics import alert_counts
from vigie.sources import io


def produce_list(spark: SparkSession, prediction_paths: Sequence[str], t_rouge: float, t_orange: float,
                 periode: str, batch: str, algo: str, out_path: str | None = None,
                 fmt: str = "csv") -> tuple[DataFrame, dict]:
    """Returns (score records, counts); writes the records as JSON lines to
    ``out_path`` when given.  ``prediction_paths`` are in decreasing priority."""
    models = [io.read_predictions(spark, p, fmt).select("siret", "predicted_probability")
              for p in prediction_paths]
    merged = merge_models(models)
    counts = alert_counts(merged, t_rouge, t_orange).first().asDict()
    records = score_list(merged, periode, batch, algo, t_rouge, t_orange)
    if out_path:
        io.export_scores(records, out_path)
    return records, counts
