"""Command line for a model run: ``python -m vigie --tables DIR [options]``.

The run options are those of the reference's command line (sample sizes,
oversampling proportion, train/test periods, prediction month), plus the
model name, an optional siret list for the prediction set, explanations and
model saving.  The session comes from ``spark-submit`` (or Spark's defaults).
"""

from __future__ import annotations

import argparse
import json

from vigie.plans.run import ARGS_TO_ATTRS, run_model
from vigie.plans.specs import default_model, small_model
from vigie.session import checkpoint_dir, get_spark
from vigie.sources.io import read_features
from vigie.sources.panel import load_panel

MODELS = {"default": default_model, "small": small_model}


def _size(text: str) -> int | str:
    """A number of rows, or "all" for no bound."""
    return text if text == "all" else int(text)


def make_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m vigie", description="Train, evaluate and apply a risk model.")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder of the input tables (orders, customer, lineitem, ...)")
    source.add_argument("--features", help="a ready feature table: Parquet, or JSON lines if the name ends in .json")
    p.add_argument("--model_name", default="default", choices=sorted(MODELS))
    p.add_argument("--env", default="develop", choices=["develop", "prod"], help="default size of the training sample")
    p.add_argument("--out_dir", default=None, help="output folder (default: <checkpoint dir>/model_runs)")
    for arg in ARGS_TO_ATTRS:
        kind = float if arg == "train_proportion_positive_class" else (_size if arg.endswith("spl_size") else str)
        p.add_argument(f"--{arg}", type=kind, default=None)
    p.add_argument("--predict_siret_list", "--predict_siretlist_path", dest="predict_siret_list", default=None, help="one siret per line, no header")
    p.add_argument("--predict_explain", action="store_true")
    p.add_argument("--save_model", action="store_true")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = make_parser().parse_args(argv)
    spark = get_spark()
    panel = load_panel(spark, args.tables) if args.tables else read_features(spark, args.features)
    spec = MODELS[args.model_name](env=args.env)
    overrides = {a: getattr(args, a) for a in ARGS_TO_ATTRS}
    out_dir = args.out_dir or f"{checkpoint_dir(spark)}/model_runs"
    _, stats, _ = run_model(spark, panel, spec, overrides, out_dir=out_dir,
                            with_explain=args.predict_explain, save_model=args.save_model,
                            predict_siretlist_path=args.predict_siret_list)
    print(json.dumps(stats, default=str))
    return stats


if __name__ == "__main__":
    main()
