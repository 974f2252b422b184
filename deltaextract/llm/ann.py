"""Approximate nearest neighbours by cosine, with robust-pruned directed graphs.

Equal vectors are one node with their smallest ids, so a vector that very many rows share is searched once. Nodes are dealt to shards of about ``SHARD_ROWS``. In a
shard, nodes are put into the graph batch by batch: a greedy search from the medoid proposes neighbours, robust pruning keeps those that no kept one is
``ALPHA`` times closer to, and the kept ones get an edge back, pruned again where they have too many. Queries then walk each
shard's graph with a beam, and the best of all shards are merged.

The graph steps work on many nodes at a time (arrays of batch x candidates), in unit vectors of single precision. Scores are computed from the original vectors in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deltaextract.llm.common import checkpointed

SHARD_ROWS, QUERY_BLOCK = 6_000, 4_000
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 120, 1.2
#: Slack of each round over the nodes.
ROUNDS = (ALPHA,)
_BATCH = 256


def _usable(vector: str) -> str:
    return f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists({vector}, x -> x != 0)"


def _search(unit: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes nearest to each query that a walk finds, and their distances (1 - cosine), nearest first; -1 where there are fewer."""
    n, m = len(queries), len(unit)
    nodes = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    seen = np.zeros((n, m + 1), bool)  # the last column stands for "no neighbour"
    nodes[:, 0], far[:, 0], done[:, 0] = start, 1 - queries @ unit[start], False
    seen[:, start] = seen[:, m] = True
    active = np.arange(n)
    while len(active):
        open_ = ~done[active]
        pick = open_.argmax(axis=1)  # beams are sorted: the first open node is the nearest
        some = open_[np.arange(len(active)), pick]
        active, pick = active[some], pick[some]
        if not len(active):
            break
        done[active, pick] = True
        near = graph[nodes[active, pick]]
        new = np.where(seen[active[:, None], near], m, near)
        seen[active[:, None], new] = True
        known = new < m
        distance = np.where(known, 1 - np.einsum("ijk,ik->ij", unit[np.minimum(new, m - 1)], queries[active]), np.inf).astype(np.float32)
        all_far = np.concatenate([far[active], distance], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[active] = np.take_along_axis(all_far, order, 1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], np.where(known, new, -1)], axis=1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], ~known], axis=1), order, 1)
    return nodes, far


def _pruned(unit: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Robust pruning for several points: rows of at most ``degree`` candidates, filled up with the number of nodes. Candidates below 0 are none."""
    m = len(unit)
    out = np.full((len(points), degree), m)
    step = max(1, 6_000_000 // (candidates.shape[1] ** 2))
    for a in range(0, len(points), step):
        mine, those = points[a : a + step], candidates[a : a + step]
        ordered = np.sort(those, axis=1)
        again = np.zeros_like(ordered, bool)
        again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
        alive = (ordered >= 0) & (ordered < m) & ~again & (ordered != mine[:, None])
        vectors = unit[ordered.clip(0, m - 1)]
        to_point = np.where(alive, 1 - np.einsum("ijk,ik->ij", vectors, unit[mine]), np.inf)
        between = 1 - vectors @ vectors.transpose(0, 2, 1)
        rows = np.arange(len(mine))
        for k in range(degree):
            best = to_point.argmin(axis=1)
            some = np.isfinite(to_point[rows, best])
            if not some.any():
                break
            out[a : a + step, k][some] = ordered[rows, best][some]
            # Distances on the unit sphere are squared: the slack is squared too.
            covered = alpha * alpha * between[rows, best] <= to_point
            to_point[covered & some[:, None]] = np.inf
            to_point[rows, best] = np.inf
    return out


def build_graph(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, rounds: tuple[float, ...] = ROUNDS) -> tuple[np.ndarray, int]:
    """Neighbours of each unit vector (rows of ``degree`` node numbers, filled up with the number of nodes), and the node to start at."""
    m = len(unit)
    start = int((unit @ unit.mean(axis=0)).argmax())
    graph = np.full((m, degree), m)
    rng = np.random.default_rng(m)
    # Some random edges first, so that the first walks get anywhere.
    if m > 1:
        first = rng.integers(0, m, (m, min(degree // 4, m - 1)))
        graph[:, : first.shape[1]] = np.where(first == np.arange(m)[:, None], m, first)
    for alpha in rounds:
        order = rng.permutation(m)
        for a in range(0, m, _BATCH):
            points = order[a : a + _BATCH]
            found, _ = _search(unit, graph, start, unit[points], beam)
            graph[points] = _pruned(unit, points, np.concatenate([found, np.where(graph[points] < m, graph[points], -1)], axis=1), alpha, degree)
            source = np.repeat(points, degree)
            target = graph[points].ravel()
            real = target < m
            source, target = source[real], target[real]
            by_target = np.argsort(target, kind="stable")
            source, target = source[by_target], target[by_target]
            gets, first, count = np.unique(target, return_index=True, return_counts=True)
            free = (graph[gets] == m).sum(axis=1)
            # Nodes with room just take the edges; the others are pruned, those with about as many candidates together.
            incoming = np.full((len(gets), int(count.max()) if len(count) else 0), -1)
            incoming[np.repeat(np.arange(len(gets)), count), np.arange(len(target)) - np.repeat(first, count)] = source
            room = count <= free
            for i in np.flatnonzero(room):
                have = graph[gets[i]]
                have = have[have < m].tolist()
                have += [x for x in incoming[i, : count[i]].tolist() if x not in have]
                graph[gets[i], : len(have)] = have
                graph[gets[i], len(have) :] = m
            full = np.flatnonzero(~room)
            for low, high in ((1, 4), (5, 16), (17, incoming.shape[1])):
                some = full[(count[full] >= low) & (count[full] <= high)]
                if len(some):
                    graph[gets[some]] = _pruned(unit, gets[some], np.concatenate([graph[gets[some]], incoming[some, : min(high, incoming.shape[1])]], axis=1), alpha, degree)
    return graph, start


def index(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, copies: int = 6) -> DataFrame:
    """Nodes of the graphs: ``dim``, ``shard``, ``node``, ``start``, ``ids`` (the ``copies`` smallest of the rows with this vector), ``vector``, ``near``.

    Vectors that are null, empty, zero, or hold null or non-finite components are left out, as are rows without an id. Rows that repeat an id and a vector count once.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")).where("id is not null").where(_usable("vector"))
    # Spark limits a rank before it shuffles, so a vector shared by very many rows sends a few of each task only.
    few = rows.distinct().withColumn("k", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("k") <= copies)
    nodes = checkpointed(few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("vector")))
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ids", key=lambda s: s.map(lambda x: x[0])).reset_index(drop=True)
        values = np.stack(group["vector"]).astype(np.float64)
        unit = (values / np.linalg.norm(values, axis=1, keepdims=True)).astype(np.float32)
        graph, start = build_graph(unit)
        near = [row[row < len(unit)] for row in graph]
        return pd.DataFrame({"dim": group["dim"], "shard": group["shard"], "node": range(len(group)), "start": start, "ids": group["ids"], "vector": group["vector"], "near": near})

    return checkpointed(dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, node int, start int, ids array<long>, vector array<double>, near array<int>"))


def search(nodes: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, beam: int = BEAM, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest rows found for each query but itself: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id.

    Queries come in blocks of about ``query_block``, and each block meets each shard of its dimension once. Unusable query vectors have no answer; a query id that
    stands in several rows is asked once, with its first vector.
    """
    asked = queries.select(F.col(f"`{vec_id}`").cast("long").alias("query_id"), F.col(f"`{vector}`").cast("array<double>").alias("query")).where("query_id is not null").where(_usable("query"))
    asked = checkpointed(asked.groupBy("query_id").agg(F.min("query").alias("query")))
    blocks = max(1, math.ceil(asked.count() / query_block))
    shards = nodes.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard")).distinct()
    sent = asked.withColumn("q_dim", F.size("query")).withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).join(shards, "q_dim")
    held = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def walk(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(columns=["query_id", "vec_id", "score"])
        if not len(shard) or not len(block):
            return empty
        shard = shard.sort_values("node")
        values = np.stack(shard["vector"])
        norms = np.linalg.norm(values, axis=1)
        unit = (values / norms[:, None]).astype(np.float32)
        graph = np.full((len(shard), DEGREE), len(shard))
        for i, near in enumerate(shard["near"]):
            graph[i, : len(near)] = near
        ids = shard["ids"].tolist()
        out = []
        for a in range(0, len(block), _BATCH):
            part = block.iloc[a : a + _BATCH]
            asked = np.stack(part["query"])
            lengths = np.linalg.norm(asked, axis=1)
            found, _ = _search(unit, graph, int(shard["start"].iloc[0]), (asked / lengths[:, None]).astype(np.float32), beam)
            for q, (query_id, nodes_found) in enumerate(zip(part["query_id"].tolist(), found, strict=True)):
                best = nodes_found[nodes_found >= 0]
                scores = (values[best] @ asked[q]) / (norms[best] * lengths[q])
                pairs = [(-s, i) for node, s in zip(best.tolist(), scores.tolist(), strict=True) for i in ids[node] if i != query_id]
                out += [(query_id, i, -s) for s, i in sorted(pairs)[:k]]
        return pd.DataFrame(out, columns=empty.columns)

    found = held.groupBy("dim", "shard", "block").cogroup(sent.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(walk, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
