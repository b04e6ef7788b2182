"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import materialize

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that
    functions run there find their modules wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    package = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join(package, os.path.relpath(full, root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Number of partitions for so many rows; at least the session's setting."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_each))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n nodes under the links a[i] - b[i]."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, up := label[label]):
            label = up


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``, where
    component is the smallest node reachable. Nodes without an edge are absent.

    Every round, each node proposes the smallest parent among its neighbours to
    itself and to its own parent, then skips to its grandparent; the number of
    rounds grows with the logarithm of the longest path. Rounds are written to
    the shared folder, so lineage stays short and a lost executor costs one
    round. Only a count of changes reaches the driver. Self-links and repeated
    links are harmless; an empty table gives an empty table.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{label}-links"
    )
    parent = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")), f"{label}-0")
    step = 0
    while True:
        step += 1
        near = (
            both.join(parent.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("parent").alias("low"))
        )
        seen = parent.join(near, "node")
        offers = (
            seen.select("node", F.least("parent", "low").alias("parent"))
            .union(seen.select(F.col("parent").alias("node"), F.col("low").alias("parent")))
            .groupBy("node")
            .agg(F.min("parent").alias("parent"))
        )
        old = parent.select("node", F.col("parent").alias("old"))
        up = offers.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        moved = offers.join(up, "parent").select("node", F.least("parent", "grand").alias("parent"))
        done = materialize(moved.join(old, "node"), f"{label}-{step}")
        parent = done.select("node", "parent")
        if done.where("parent <> old").isEmpty():
            return parent.select("node", F.col("parent").alias("component"))
