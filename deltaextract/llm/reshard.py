"""Resharding by minimum-cost flow.

Rows lie in old shards. Each old shard is cut into blocks (hash of the row), and block sizes are summed. From the sizes of the old shards
and the capacities of the new ones, a minimum-cost flow gives how many bytes go where: staying costs nothing, each moved byte
costs one. Whole blocks then make up these transfers, largest first, and what the blocks cannot match is evened out with the smallest ones.
Only shards that give or take blocks are written anew.

The driver sees one number per block, ``old shards x blocks`` in all, whatever the size of the table.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 256
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Plan:
    """Flow in bytes by (old, new) shard; new shard of each (old, block)."""

    flow: dict[tuple[int, int], int]
    placed: dict[tuple[int, int], int]

    @property
    def affected(self) -> set[int]:
        """Shards whose files change."""
        return {s for (old, _), new in self.placed.items() if old != new for s in (old, new)}


def min_cost_flow(supply: dict[int, int], capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """Cheapest flow of all supply into the capacities; staying costs 0, moving 1 a byte. Capacities must suffice.

    Successive shortest paths over the residual network of old shards, new shards, source and sink, with potentials.
    """
    if sum(supply.values()) > sum(capacity.values()):
        raise ValueError("the capacities do not suffice")
    source, sink = ("s", 0), ("t", 0)
    graph: dict[tuple, dict[tuple, list[int]]] = defaultdict(dict)  # node -> node -> [left, cost]

    def edge(a: tuple, b: tuple, room: int, cost: int) -> None:
        graph[a][b], graph[b][a] = [room, cost], [0, -cost]

    for i, n in supply.items():
        edge(source, ("o", i), n, 0)
        for j in capacity:
            edge(("o", i), ("n", j), n, int(i != j))
    for j, n in capacity.items():
        edge(("n", j), sink, n, 0)
    potential: dict[tuple, int] = defaultdict(int)
    while True:
        far: dict[tuple, int] = {source: 0}
        before: dict[tuple, tuple] = {}
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for b, (room, cost) in graph[a].items():
                to = d + cost + potential[a] - potential[b]
                if room and to < far.get(b, to + 1):
                    far[b], before[b] = to, a
                    heapq.heappush(queue, (to, b))
        if sink not in far:
            break
        for node, d in far.items():
            potential[node] += d
        path, b = [], sink
        while b != source:
            path.append((before[b], b))
            b = before[b]
        pushed = min(graph[a][b][0] for a, b in path)
        for a, b in path:
            graph[a][b][0] -= pushed
            graph[b][a][0] += pushed
    return {(i, j): graph[("n", j)][("o", i)][0] for i in supply for j in capacity if graph[("n", j)][("o", i)][0]}


def plan_transfers(blocks: dict[tuple[int, int], int], capacity: dict[int, int]) -> Plan:
    """New shard of each block: the flow, carried out with whole blocks."""
    supply: dict[int, int] = defaultdict(int)
    for (old, _), size in blocks.items():
        supply[old] += size
    flow = min_cost_flow(dict(supply), capacity)
    left = dict(capacity)
    rest, placed = [], {}
    stay = {i: flow.get((i, i), 0) for i in supply}
    by_size = sorted(blocks, key=lambda b: (-blocks[b], b))
    for block in by_size:
        old, size = block[0], blocks[block]
        if old in left and size <= stay[old]:
            stay[old] -= size
            left[old] -= size
            placed[block] = old
        else:
            rest.append(block)
    wanted = {old: {j: n for (i, j), n in flow.items() if i == old and j != old} for old in supply}
    for block in rest:
        old, size = block[0], blocks[block]
        ways = [j for j, n in wanted[old].items() if n >= size and left[j] >= size]
        new = max(ways or left, key=lambda j: (left[j], -j))
        if new in wanted[old]:
            wanted[old][new] = max(0, wanted[old][new] - size)
        left[new] -= size
        placed[block] = new
    return Plan(flow, placed)


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {k: total // shards + (k < total % shards) for k in range(shards)}


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus ``ROW_BYTES``."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def assign(rows: DataFrame, old: str, size: str, key: list[str], shards: int, *, blocks: int = BLOCKS, capacity: dict[int, int] | None = None) -> tuple[DataFrame, Plan]:
    """``rows`` with ``shard`` and ``slot`` (from 0, without gaps, in each shard), and the plan.

    ``old`` is the column with the old shard (not null), ``size`` that with the bytes of a row, ``key`` the columns that deal rows to
    blocks and order them; rows alike in all of them share a block, and take neighbouring slots. New shards are 0 to
    ``shards`` - 1 and equal in size, or as ``capacity`` says. ``shard``, ``slot`` and ``_block`` of ``rows`` itself are replaced.
    """
    dealt = rows.drop("shard", "slot").withColumn("_block", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(blocks)).cast("int"))
    found = dealt.groupBy(F.col(f"`{old}`").alias("old"), "_block").agg(F.sum(f"`{size}`").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {(r["old"], r["_block"]): r["bytes"] for r in found}
    plan = plan_transfers(sizes, capacity or even_capacities(sum(sizes.values()), shards))
    first: dict[int, int] = defaultdict(int)
    places = []
    for r in sorted(found, key=lambda r: (r["old"], r["_block"])):
        new = plan.placed[r["old"], r["_block"]]
        places.append((r["old"], r["_block"], new, first[new]))
        first[new] += r["n"]
    # One narrow row per block.
    where = rows.sparkSession.createDataFrame(places, "_old int, _b int, shard int, _first long")
    placed = dealt.join(F.broadcast(where), (F.col(f"`{old}`") == F.col("_old")) & (F.col("_block") == F.col("_b")))
    within = Window.partitionBy("_old", "_block").orderBy(*[F.col(f"`{k}`") for k in key])
    return placed.withColumn("slot", F.col("_first") + F.row_number().over(within) - 1).drop("_old", "_b", "_first", "_block"), plan


def reshard_documents(docs: DataFrame, old_shards: int, shards: int, *, text: str = "text", doc_id: str = "doc_id", blocks: int = BLOCKS) -> tuple[DataFrame, Plan]:
    """Where the rows of ``docs`` go when ``old_shards`` shards, dealt by a hash of the id and text, become ``shards`` of equal bytes.

    Columns: doc_id, size, text_crc32, old_shard, shard, slot. Nulls count as 0 bytes of text and are hashed as such; repeated rows lie side by side;
    an empty table gives no rows.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), row_size(F.col(f"`{text}`")).alias("size"), F.crc32(value).alias("text_crc32"), F.xxhash64(value).alias("_h")
    ).withColumn("old_shard", F.pmod(F.hash("doc_id", "_h"), F.lit(old_shards)).cast("int"))
    out, plan = assign(narrow, "old_shard", "size", ["doc_id", "_h"], shards, blocks=blocks)
    return out.drop("_h"), plan


def rewrite(rows: DataFrame, plan: Plan, path: str, *, shard: str = "shard", old: str = "old_shard") -> set[int]:
    """Write the affected shards of ``rows`` (with ``shard`` and ``old_shard``) below ``path`` as ``shard=N``; the others keep their files. Returns the written shards."""
    affected = plan.affected
    if affected:
        moved = rows.where(F.col(shard).isin(sorted(affected)))
        moved.repartition(shard).drop(old).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(shard).parquet(path)
    return affected
