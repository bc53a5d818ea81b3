"""Average-linkage clustering of a block's vectors by cosine distance."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def distances(vectors: np.ndarray) -> np.ndarray | None:
    """Cosine distances, infinite from a vector to itself; None where there are
    none to tell vectors apart by."""
    norms = np.linalg.norm(vectors, axis=1)
    if len(vectors) < 2 or (norms == 0).any():
        return None
    unit = vectors / norms[:, None]
    distance = 1 - unit @ unit.T
    np.fill_diagonal(distance, np.inf)
    return distance


def average_linkage(vectors: np.ndarray, cut: float) -> np.ndarray:
    """Cluster numbers from 0, by first member.  Clusters merge while the least
    mean cosine distance of two of them is at most ``cut``; zero vectors give
    no distances, and then all are one cluster."""
    n, distance = len(vectors), distances(vectors)
    if distance is None:
        return np.zeros(n, np.int64)
    size, label, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    for _ in range(n - 1):
        i, j = divmod(int(np.argmin(distance)), n)
        if distance[i, j] > cut:
            break
        i, j = min(i, j), max(i, j)
        mean = (size[i] * distance[i] + size[j] * distance[j]) / (size[i] + size[j])
        distance[i], distance[:, i] = mean, mean
        distance[i, i] = np.inf
        distance[j], distance[:, j] = np.inf, np.inf
        size[i] += size[j]
        alive[j] = False
        label[label == j] = i
    names = {c: k for k, c in enumerate(dict.fromkeys(label.tolist()))}
    return np.array([names[c] for c in label.tolist()], np.int64)


def linkage_of_many(distance: np.ndarray, cut: float) -> np.ndarray:
    """average_linkage of several blocks of as many vectors each (block, vector,
    vector), a merge of each at a time; ``distance`` is used up."""
    blocks, n, _ = distance.shape
    size, label, live = np.ones((blocks, n)), np.tile(np.arange(n), (blocks, 1)), np.arange(blocks)
    for _ in range(n - 1):
        flat = distance[live].reshape(len(live), -1)
        at = flat.argmin(axis=1)
        near = ~(flat[np.arange(len(live)), at] > cut)
        live, at = live[near], at[near]
        if not len(live):
            break
        i, j = np.minimum(at // n, at % n), np.maximum(at // n, at % n)
        a, b = size[live, i], size[live, j]
        mean = (a[:, None] * distance[live, i] + b[:, None] * distance[live, j]) / (a + b)[:, None]
        distance[live, i], distance[live, :, i] = mean, mean
        distance[live, i, i] = np.inf
        distance[live, j], distance[live, :, j] = np.inf, np.inf
        size[live, i] = a + b
        label[live] = np.where(label[live] == j[:, None], i[:, None], label[live])
    # A cluster goes by its first member, which merges keep.
    return np.take_along_axis(np.cumsum(label == np.arange(n), axis=1) - 1, label, axis=1)


def _labels(starts: np.ndarray, words: pa.ListArray, weights: pa.ListArray, cut: float) -> np.ndarray:
    """Cluster numbers of rows in whole blocks, which begin at ``starts``."""
    n, out = len(words), np.zeros(len(words), np.int64)
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    # A block's features are its words in their order.
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    of_row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    row = np.repeat(np.arange(n), counts)
    features, column = np.unique(of_row[row] * len(rank) + rank[coded.indices.to_numpy()], return_inverse=True)
    wide = np.bincount(features // max(1, len(rank)), minlength=len(starts))
    column = column - (np.cumsum(wide) - wide)[of_row[row]]
    values, edges = weights.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(counts))
    alike: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, (a, z) in enumerate(zip(starts.tolist(), np.append(starts[1:], n).tolist())):
        if z - a > 1:
            vectors, e = np.zeros((z - a, wide[k])), slice(edges[a], edges[z])
            vectors[row[e] - a, column[e]] = values[e]
            distance = distances(vectors)
            if distance is not None:
                alike.setdefault(z - a, []).append((a, distance))
    for size, some in alike.items():
        at = np.array([a for a, _ in some])[:, None] + np.arange(size)
        out[at] = linkage_of_many(np.stack([d for _, d in some]), cut)
    return out


def cluster_maps(df: DataFrame, block: str, row: str, weights: str, cut: float = 0.7) -> DataFrame:
    """(block, row, clusid) as cluster gives it for the vectors of ``weights`` (a map
    from words to numbers) over a block's words.  Words stay as they are until a
    block's rows are together, and blocks of one size merge together."""

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
            if not t.num_rows:
                continue
            names = t.column(0).combine_chunks()
            starts = np.append(0, 1 + np.flatnonzero(pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)))
            # The last block may go on in the next batch.
            if len(starts) > 1:
                yield from labelled(t.slice(0, starts[-1]), starts[:-1])
            held = t.slice(starts[-1])
        if held is not None:
            yield from labelled(held, np.zeros(1, int))

    def labelled(t: pa.Table, starts: np.ndarray):
        found = _labels(starts, t.column(2).combine_chunks(), t.column(3).combine_chunks(), cut)
        return pa.Table.from_arrays([t.column(0), t.column(1), pa.array(found)], [block, row, "clusid"]).to_batches()

    fields = f"{block} {df.schema[block].dataType.simpleString()}, {row} {df.schema[row].dataType.simpleString()}, clusid long"
    few = df.filter(F.col(block).isNotNull()).select(block, row, F.map_keys(weights).alias("__words"), F.map_values(weights).alias("__weights"))
    return few.repartition(block).sortWithinPartitions(block, row).mapInArrow(run, fields)


def cluster(df: DataFrame, block: str, row: str, vector: str, cut: float = 0.7) -> DataFrame:
    """(block, row, clusid).  The tree needs all of a block's distances, so a
    block (a query's hits, at most a few hundred) is one task's work."""


    def labelled(p: pd.DataFrame) -> pd.DataFrame:
        """Of whole blocks, which lie one after another."""
        names = p[block].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1], [True])))
        vectors = p[vector].to_numpy()
        found = [average_linkage(np.stack(vectors[a:z]).astype(float), cut) for a, z in zip(edges[:-1], edges[1:])]
        return pd.DataFrame({block: p[block], row: p[row], "clusid": np.concatenate(found)})

    def run(frames):
        # Sorted rows in batches: the last block of one may go on in the next.
        held = None
        for p in frames:
            p = p if held is None else pd.concat([held, p], ignore_index=True)
            if not len(p):
                continue
            ends = (p[block] != p[block].iloc[-1]).to_numpy()
            if ends.any():
                yield labelled(p[ends])
            held = p[~ends]
        if held is not None and len(held):
            yield labelled(held)

    fields = f"{block} {df.schema[block].dataType.simpleString()}, {row} {df.schema[row].dataType.simpleString()}, clusid long"
    few = df.filter(F.col(block).isNotNull()).select(block, row, vector)
    return few.repartition(block).sortWithinPartitions(block, row).mapInPandas(run, fields)
