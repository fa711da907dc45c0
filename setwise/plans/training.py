"""Train the set model and the two phase models and store them as one run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from setwise.contract import FEATURES, FOLDS, RUN_NAME, SPLIT_SEED
from setwise.operators.models import FOLD, SHARE, chained_specs, evaluate_by_group, fit, kept, with_shares
from setwise.sources.run_store import RunStore


def train(
    samples: DataFrame,
    store: RunStore,
    features=FEATURES,
    group: str = "filename",
    run_name: str = RUN_NAME,
    folds: int = FOLDS,
    tree: dict | None = None,
    forest: dict | None = None,
    seed: int = SPLIT_SEED,
) -> str:
    """For each model: validate by session, measure on held-out sessions, fit on all."""
    specs = chained_specs(features, tree, forest)
    needed = [*features, *[spec.label for spec in specs], SHARE, FOLD]
    with kept(with_shares(samples, group, folds, seed), needed) as rows:
        run_id = store.start()
        for spec in specs:
            validated, metrics = evaluate_by_group(spec, rows, group, folds, seed)
            measured = metrics.first().asDict() | {"cv_f1": validated.avgMetrics[0]}
            store.save(run_id, run_name, spec.name, fit(spec, rows, seed), spec.settings(), measured)
        return run_id
