"""Random hyper-parameter search: each trial is a Spark ML fit judged by validation log loss."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ..operators.evaluate import log_loss
from ..operators.sampling import row_cap, share_sample
from ..schemas import NUM_CLASSES, TARGET
from .training import DEFAULTS, FlowModel, fit_model, materialised, spread

Draw = Callable[[random.Random], float]


def whole(low: int, high: int) -> Draw:
    """An integer from low to high - 1."""
    return lambda rng: rng.randrange(low, high)


def choice(*values) -> Draw:
    return lambda rng: rng.choice(values)


def uniform(low: float, high: float) -> Draw:
    return lambda rng: rng.uniform(low, high)


def log_uniform(low: float, high: float) -> Draw:
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


# Search spaces, trial counts and rung settings.
SEARCH_SPACES: dict[str, dict[str, Draw]] = {
    "softmax": {
        "max_depth": whole(3, 11),
        "min_child_weight": choice(1, 2, 3),
        "subsample": uniform(0.5, 1.0),
        "eta": log_uniform(1e-4, 3e-1),
        "lambda": log_uniform(1e-3, 10.0),
        "alpha": log_uniform(1e-3, 10.0),
    },
    "gbt": {
        "max_depth": whole(3, 11),
        "min_child_weight": choice(1, 2, 3),
        "subsample": uniform(0.5, 1.0),
        "eta": log_uniform(1e-4, 3e-1),
    },
    "mlp": {
        "batch_size": choice(64, 128, 256),
        "width": choice(8, 16, 32, 64),
        "tol": log_uniform(1e-7, 1e-3),
    },
}
TRIALS = {"softmax": 3, "gbt": 3, "mlp": 5}
ROUNDS = {"softmax": "num_boost_round", "gbt": "num_boost_round", "mlp": "max_epochs"}
GRACE_ROUNDS = 5
MAX_ROUNDS = 10
REDUCTION = 2
CONCURRENT_TRIALS = 2


@dataclass(frozen=True)
class Trial:
    number: int
    params: dict
    rounds: int
    loss: float


def draw_params(framework: str, trials: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    space = SEARCH_SPACES[framework]
    return [{name: draw(rng) for name, draw in space.items()} for _ in range(trials)]


def tuning_data(
    train: DataFrame,
    val: DataFrame,
    fraction: float | None,
    seed: int,
    max_train_rows: int = 0,
    max_val_rows: int = 0,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The sample a search works on; caps of 0 keep everything. `partitions` spreads the rows of both."""
    rows = row_cap(share_sample(train, fraction, seed=seed), max_train_rows)
    return spread(rows, partitions), spread(row_cap(val, max_val_rows), partitions)


def validation_loss(model: FlowModel, val: DataFrame, target: str) -> float:
    return float(log_loss(model.score(val), target, "probabilities").first()[0])


def run_trials(
    train: DataFrame,
    val: DataFrame,
    framework: str,
    candidates: dict[int, dict],
    rounds: int,
    target: str = TARGET,
    classes: int = NUM_CLASSES,
    seed: int = 42,
    concurrent: int = CONCURRENT_TRIALS,
) -> list[Trial]:
    """Fit every candidate with a given number of rounds, a few at a time. The models are judged, not stored."""

    def one(item: tuple[int, dict]) -> Trial:
        number, params = item
        settings = {**DEFAULTS[framework], **params, ROUNDS[framework]: rounds}
        model = fit_model(train, framework, settings, target, classes, seed, together=True)
        return Trial(number, params, rounds, validation_loss(model, val, target))

    with ThreadPool(min(concurrent, len(candidates))) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(one), sorted(candidates.items()))


def best(trials: list[Trial]) -> Trial:
    return min(trials, key=lambda t: (t.loss, t.number))


def random_search(
    train: DataFrame,
    val: DataFrame,
    framework: str = "gbt",
    trials: int | None = None,
    fraction: float | None = None,
    seed: int = 42,
    partitions: int | None = None,
    max_train_rows: int = 0,
    max_val_rows: int = 0,
    **options,
) -> list[Trial]:
    """Seeded random draws, all trained for the full number of rounds."""
    candidates = dict(enumerate(draw_params(framework, trials or TRIALS[framework], seed)))
    sampled, checked = tuning_data(train, val, fraction, seed, max_train_rows, max_val_rows, partitions)
    with materialised(sampled, checked) as (a, b):
        return run_trials(a, b, framework, candidates, MAX_ROUNDS, seed=seed, **options)


def halving_search(
    train: DataFrame,
    val: DataFrame,
    framework: str = "gbt",
    trials: int | None = None,
    fraction: float | None = None,
    seed: int = 42,
    partitions: int | None = None,
    max_train_rows: int = 0,
    max_val_rows: int = 0,
    **options,
) -> list[Trial]:
    """Rungs: everyone trains for the grace period, the better half goes on, up to the full rounds."""
    candidates = dict(enumerate(draw_params(framework, trials or TRIALS[framework], seed)))
    sampled, checked = tuning_data(train, val, fraction, seed, max_train_rows, max_val_rows, partitions)
    history: list[Trial] = []
    rounds = GRACE_ROUNDS
    with materialised(sampled, checked) as (a, b):
        while candidates:
            rung = run_trials(a, b, framework, candidates, rounds, seed=seed, **options)
            history += rung
            if rounds >= MAX_ROUNDS:
                break
            ranked = sorted(rung, key=lambda t: (t.loss, t.number))
            kept = ranked[: max(1, len(ranked) // REDUCTION)]
            candidates = {t.number: t.params for t in kept}
            rounds = min(MAX_ROUNDS, rounds * REDUCTION)
    return history


SEARCHES = {"random": random_search, "halving": halving_search}


def last_rung(trials: list[Trial]) -> list[Trial]:
    """The trials that were trained longest: only their losses compare."""
    rounds = max(t.rounds for t in trials)
    return [t for t in trials if t.rounds == rounds]


def final_params(framework: str, winner: Trial) -> dict:
    """The best draw with the default number of rounds, for the full retrain."""
    return {**DEFAULTS[framework], **winner.params, ROUNDS[framework]: DEFAULTS[framework][ROUNDS[framework]]}


def trial_table(df: DataFrame, trials: list[Trial]) -> DataFrame:
    """(trial, rounds, params, val_log_loss)."""
    rows = [
        (t.number, t.rounds, ", ".join(f"{k}={v:.6g}" for k, v in sorted(t.params.items())), t.loss)
        for t in trials
    ]
    return df.sparkSession.createDataFrame(rows, "trial int, rounds int, params string, val_log_loss double")
