"""Connected components over edges, as DataFrame joins: every node learns the least id of its component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.scratch import stage

#: So many distinct edges at most are taken to one task, which needs some 100 MB for them; more of them go by rounds.
FEW = 1 << 20


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all ends of the edges."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def at_once(edges: DataFrame) -> DataFrame:
    """(node, root) over few edges (u, v), in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, pa.schema([("u", pa.int64()), ("v", pa.int64())]))
        out = pa.table(least_nodes(held["u"].to_numpy(), held["v"].to_numpy()), ["node", "root"])
        yield from out.to_batches(1 << 16)

    return edges.select("u", "v").coalesce(1).mapInArrow(run, "node long, root long")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """Rows (node, root), one for each node of an edge; root is the least node of its component.

    Alternates the large-star and small-star steps: each node's larger neighbours, then its smaller ones, are linked to
    the least node around it. The number of rounds grows with the logarithm of the diameter; each is two aggregations
    with map-side combining, so that a node with very many neighbours sends one row from each task. Edges with a null
    end are ignored. At most FEW edges between numbers (long) are solved in one task instead.
    """
    now = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where("u is not null and v is not null and u <> v").distinct()
    now = stage(now, "edges")
    if dict(now.dtypes)["u"] == "bigint" and now.count() <= FEW:
        return stage(at_once(now), "roots")
    before = None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError(f"no fixpoint after {rounds} rounds")
    roots = now.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(roots.select(F.col("root").alias("node"), "root").distinct())
