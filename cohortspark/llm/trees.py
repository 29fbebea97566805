"""Spark ML trees as column expressions, read from their printed form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NODE = re.compile(r"( *)(If|Else|Predict:) ?(?:\(feature (\d+) (<=|>) (\S+)\)|(\S+))")


def tree_column(printed: str, features: list[Column]) -> Column:
    """The prediction of one tree over the given feature columns."""
    nodes = [m for m in map(_NODE.match, printed.splitlines()) if m]
    at = 0

    def read() -> Column:
        nonlocal at
        node = nodes[at]
        at += 1
        if node[2] == "Predict:":
            return F.lit(float(node[6]))
        low = read()
        at += 1  # the matching Else
        high = read()
        return F.when(features[int(node[3])] <= float(node[5]), low).otherwise(high)
    return read()


def ensemble_column(model, features: list[Column]) -> Column:
    """Margin of a boosted ensemble: the weighted sum of its trees."""
    margin = F.lit(0.0)
    for weight, tree in zip(model.treeWeights, model.trees):
        margin = margin + F.lit(float(weight)) * tree_column(tree.toDebugString, features)
    return margin
