"""Anomaly scores from an isolation forest (Liu, Ting and Zhou, ICDM 2008).

An account that few random cuts set apart is unlike the others. Trees are grown on samples of a fixed size, drawn by a hash of the id, so
the driver holds `trees * sample` rows at most whatever the number of accounts; all accounts are then scored in Arrow batches, a few
array operations for each level of a tree.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES = 100
SAMPLE = 256
SCORE = "anomaly_score"


def usual_steps(rows: int) -> float:
    """Mean steps of an unsuccessful search among `rows` in a random binary tree."""
    if rows < 2:
        return 0.0
    return 2.0 * (math.log(rows - 1) + 0.5772156649015329) - 2.0 * (rows - 1) / rows if rows > 2 else 1.0


@dataclass(frozen=True)
class Forest:
    """Trees as lists by node: the feature cut (-1 at a leaf), where, the nodes below and above the cut, and the steps a leaf stands for."""

    columns: list[str]
    trees: list[tuple]
    sample: int

    @property
    def depth(self) -> int:
        return limit_of(self.sample)


def limit_of(sample: int) -> int:
    return max(1, math.ceil(math.log2(max(sample, 2))))


def grown(rows: list[tuple[float, ...]], draws: random.Random) -> tuple[list, list, list, list, list]:
    """One tree over `rows`: cuts at a random place of a random feature that has more than one value, down to the depth limit."""
    feature, cut, low, high, steps = [], [], [], [], []
    limit = limit_of(len(rows))
    todo = [(rows, 0, None, None)]
    while todo:
        own, depth, side, parent = todo.pop()
        node = len(feature)
        if parent is not None:
            side[parent] = node
        spread = [(i, min(values), max(values)) for i, values in enumerate(zip(*own, strict=True))]
        spread = [s for s in spread if s[1] < s[2]]
        feature.append(-1), cut.append(0.0), low.append(node), high.append(node), steps.append(depth + usual_steps(len(own)))
        if depth < limit and spread:
            at, least, most = draws.choice(spread)
            # Nothing lies below the smallest value, so a cut there would not be one.
            feature[node], cut[node] = at, max(draws.uniform(least, most), math.nextafter(least, math.inf))
            todo.append(([r for r in own if r[at] >= cut[node]], depth + 1, high, node))
            todo.append(([r for r in own if r[at] < cut[node]], depth + 1, low, node))
    return feature, cut, low, high, steps


def _inputs(columns: list[str]) -> list[Column]:
    return [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns]


def sampled(df: DataFrame, columns: list[str], trees: int = TREES, sample: int = SAMPLE, salt: str = "isolation", key: str = "id") -> list[tuple[float, ...]]:
    """The rows that trees are grown on: the first `trees * sample` in the order of a hash of the key."""
    place = F.md5(F.concat_ws(":", F.lit(salt), F.col(key).cast("string")))
    chosen = df.select(place.alias("_place"), F.col(key).alias("_key"), F.array(*_inputs(columns)).alias("x")).orderBy("_place", "_key").limit(trees * sample)
    return [tuple(r["x"]) for r in chosen.collect()]


def fit(df: DataFrame, columns: list[str], trees: int = TREES, sample: int = SAMPLE, salt: str = "isolation", key: str = "id") -> Forest:
    """A forest of `trees` trees of `sample` rows each, which share no row; with fewer rows than that in all, trees share them out. Null and NaN count as 0."""
    rows = sampled(df, columns, trees, sample, salt, key)
    each = min(sample, max(1, len(rows) // trees)) if rows else 0
    made = []
    for i in range(trees if each else 0):
        made.append(grown(rows[i * each:(i + 1) * each], random.Random(f"{salt}:{i}")))
    return Forest(list(columns), made, max(each, 1))


def _summed_steps(forest: Forest) -> Callable[..., pd.Series]:
    """The steps that rows take through all trees, added up tree by tree; all rows of a batch go down a tree level by level."""
    trees = [(np.maximum(feature, 0), np.array(cut), np.stack([low, high], axis=1).ravel(), np.array(steps)) for feature, cut, low, high, steps in forest.trees]
    depth = forest.depth

    def summed(*inputs: pd.Series) -> pd.Series:
        rows = len(inputs[0])
        x, row, total = np.concatenate([i.to_numpy() for i in inputs]), np.arange(rows), np.zeros(rows)
        for feature, cut, below, steps in trees:
            first, node = feature * rows, np.zeros(rows, dtype=np.int64)
            for _ in range(depth):
                # Below a leaf lies the leaf itself.
                node = below.take(2 * node + (x.take(first.take(node) + row) >= cut.take(node)))
            total += steps.take(node)
        return pd.Series(total)

    return summed


def score(df: DataFrame, forest: Forest) -> DataFrame:
    """`df` with `anomaly_score`, from 0 to 1: near 1 for rows that are soon alone, 0.5 for usual ones. Null without trees."""
    if not forest.trees:
        return df.withColumn(SCORE, F.lit(None).cast("double"))
    usual = usual_steps(forest.sample) or 1.0
    total = F.pandas_udf(_summed_steps(forest), "double")(*_inputs(forest.columns))
    return df.withColumn(SCORE, F.pow(F.lit(2.0), -total / (len(forest.trees) * usual)))
