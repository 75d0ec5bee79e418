"""Parameter search: an objective over a grid or a seeded random sample of a space."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Space = dict[str, list]


def grid(space: Space) -> Iterable[dict]:
    names = list(space)
    return (dict(zip(names, values)) for values in itertools.product(*space.values()))


def sample(space: Space, trials: int, seed: int = 0) -> Iterable[dict]:
    """`trials` settings drawn with replacement."""
    r = random.Random(seed)
    return ({k: r.choice(v) for k, v in space.items()} for _ in range(trials))


def search(spark: SparkSession, settings: Iterable[dict], objective: Callable[[dict], float]) -> DataFrame:
    """(trial, value, one column per parameter). Each trial runs its own distributed job; the driver keeps a number of each."""
    rows, names = [], []
    for i, setting in enumerate(settings):
        names = list(setting)
        rows.append((i, float(objective(setting)), *map(str, setting.values())))
    return spark.createDataFrame(rows, "trial int, value double" + "".join(f", {n} string" for n in names))


def best(trials: DataFrame) -> DataFrame:
    """The first trial of the greatest value."""
    from pyspark.sql import functions as F

    return trials.orderBy(F.desc("value"), "trial").limit(1)
