"""From the panel to a saved model: matrix, selection, reduced matrix, folds, refit. Each step is written below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.operators import boosting, selection
from loomstep.operators.crossval import fold_summary, fold_table
from loomstep.schema import DATE
from loomstep.sources.dated import matrix_columns, read_names, run_tag, to_matrix, write_matrix, write_report, write_summary
from loomstep.sources.settings import Settings


def binned_matrix(panel: DataFrame, features: list[str], path: str, *, target: str, weight: str, low: int, high: int, bins: int) -> boosting.Binned:
    """The matrix of dates low to high below path/matrix, in order and checked, and its binned rows below path/binned."""
    spark = panel.sparkSession
    write_matrix(to_matrix(panel, features, target=target, weight=weight, low=low, high=high), f"{path}/matrix")
    return boosting.write_binned(spark.read.parquet(f"{path}/matrix"), features, f"{path}/binned", y="y", weight="w", bins=bins)


def train(panel: DataFrame, out: str, *, target: str, weight: str = "weight", s: Settings = Settings()) -> tuple[boosting.Model, dict]:
    """(model, summary) from the panel: features are selected over the folds, the model is fitted on them alone.

    Both fits use the settings' folds; the model is refitted on the whole window with as many rounds as the folds found
    best. Written below out: both matrices, features, importance, scores, model and summary.
    """
    spark = panel.sparkSession
    days = panel.agg(F.min(DATE).alias("low"), F.max(DATE).alias("high")).first()
    window = {"target": target, "weight": weight, "low": days["low"], "high": days["high"], "bins": s.trees.bins}
    folds = fold_table(panel, s.folds.n_splits, s.folds.gap_days, s.folds.train_to_val)
    every = matrix_columns(panel, target=target, weight=weight)
    wide = binned_matrix(panel, every, f"{out}/all", **window)
    always = [c for c in s.selection.always if c in every]
    selection.select_features(wide, folds, f"{out}/features", k=s.selection.k, always=always, trees=s.selection_trees)
    chosen = matrix_columns(panel, target=target, weight=weight, chosen=read_names(spark, f"{out}/features"), always=always)
    narrow = binned_matrix(panel, chosen, f"{out}/selected", **window)
    scores, importance = selection.fit_folds(narrow, folds, s.trees)
    write_report(scores, f"{out}/scores")
    write_report(importance.orderBy(F.desc("gain_share"), "feature"), f"{out}/importance")
    found = fold_summary(scores).first()
    rounds = [r["rounds"] for r in scores.orderBy("fold").collect()]
    model = selection.refit(narrow, rounds, s.trees)
    tag = run_tag(days["low"], days["high"], s.folds.n_splits, s.folds.gap_days, s.folds.train_to_val, s.trees.seed)
    summary = {"run": tag, "mean_wr2": found["mean"], "std_wr2": found["std"], "rounds": rounds, "n_features": len(chosen)}
    boosting.save_model(spark, model, f"{out}/model", **summary)
    write_summary(spark, summary, f"{out}/summary")
    return model, summary
