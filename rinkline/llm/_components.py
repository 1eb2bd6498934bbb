"""Connected components of a graph whose edges are a DataFrame, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm import _shared
from rinkline.llm._shared import discard, if_small, stored


def spanning(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each vertex to the first of its component: as few as the vertices, however many pairs there are."""
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b, label = at[: len(left)], at[len(left) :], np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges that are left, a bounded number, to (a, to): every vertex and the first of its component."""
    table = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    vertex, first = spanning(table["a"].to_numpy(), table["b"].to_numpy())
    roots = np.unique(first)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([vertex, roots])), pa.array(np.concatenate([first, roots]))], ["a", "to"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root): for every vertex of edges (columns a, b) the smallest id that it is linked with.

    In each round every vertex goes over to the neighbour (or itself) with the
    least hash, and edges are contracted; hashes differ by round, so any graph
    shrinks by a constant factor on average.  No round gathers a vertex's
    neighbours: their minimum combines before the shuffle.  Once no more than
    BROADCAST_ROWS edges are left one task ends the work.  An empty graph gives
    an empty result.
    """
    current = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    while (left := current.count()) > 0:
        if left <= _shared.BROADCAST_ROWS:
            moves.append(stored(current.coalesce(1).mapInArrow(_rest, "a long, to long"), "moves"))
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        draw = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("draw"), F.col(c).alias("id"))
        nearest = both.groupBy("a").agg(F.min(draw("b")).alias("best"))
        to = stored(nearest.select("a", F.least("best", draw("a")).getField("id").alias("to")), "moves")
        half = current.join(to, "a").select("b", F.col("to").alias("x"))
        right = half.join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        after = stored(right.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        discard(current)
        current = after
        moves.append(to)
    if not moves:
        return current.select(F.col("a").alias("id"), F.col("a").alias("root"))
    place = moves[0].select(F.col("a").alias("id"), F.col("to").alias("at"))
    for move in moves[1:]:
        step = move.select(F.col("a").alias("at"), "to")
        place = place.join(step, "at", "left").select("id", F.coalesce("to", "at").alias("at"))
    place = stored(place, "places")
    discard(current, *moves)
    least = stored(place.groupBy("at").agg(F.min("id").alias("root")), "least")
    return place.join(if_small(least), "at").select("id", "root")
