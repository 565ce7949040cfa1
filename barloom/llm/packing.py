"""Texts put together into containers of a fixed token capacity, balanced by what attention over them costs."""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.splitting import full_pieces, split_long
from barloom.llm.tokens import RANKS
from barloom.session import ship, stored

#: Containers that one task fills at a time.
GROUP = 4096


class _Rooms:
    """Open containers by remaining capacity; finds the cheapest with room for an item in logarithmic time."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.n)]
        self.best: list[tuple[float, int] | None] = [None] * (2 * self.n)

    def _update(self, room: int) -> None:
        i = room + self.n
        self.best[i] = self.heaps[room][0] if self.heaps[room] else None
        i >>= 1
        while i:
            a, b = self.best[2 * i], self.best[2 * i + 1]
            self.best[i] = a if b is None or (a is not None and a <= b) else b
            i >>= 1

    def put(self, room: int, cost: float, box: int) -> None:
        heapq.heappush(self.heaps[room], (cost, box))
        self._update(room)

    def take(self, size: int) -> tuple[float, int] | None:
        """The cheapest container with at least so much room: (cost, number); of equal costs the lowest number."""
        found, lo, hi = None, size + self.n, 2 * self.n
        while lo < hi:
            for i in ([lo] if lo & 1 else []) + ([hi - 1] if hi & 1 else []):
                if self.best[i] is not None and (found is None or self.best[i] < found):
                    found = self.best[i]
            lo, hi = (lo + 1) >> 1, hi >> 1
        return found

    def pop(self, room: int) -> None:
        heapq.heappop(self.heaps[room])
        self._update(room)


def fill(sizes: list[int], capacity: int, linear: float, quadratic: float) -> list[int]:
    """The container number of each item, for sizes in descending order: the cheapest open container with room, or a new one. As many as the total needs at least are open from the start."""
    rooms, left, out = _Rooms(capacity), {}, []
    n_open = math.ceil(sum(sizes) / capacity) if sizes else 0
    for box in range(n_open):
        left[box] = capacity
        rooms.put(capacity, 0.0, box)
    for n in sizes:
        got = rooms.take(n)
        if got is None:
            cost, box = 0.0, n_open
            left[box] = capacity
            n_open += 1
        else:
            cost, box = got
            rooms.pop(left[box])
        left[box] -= n
        rooms.put(left[box], cost + linear * n + quadratic * n * n, box)
        out.append(box)
    return out


def pack(docs: DataFrame, capacity: int, ranks: str = RANKS, linear: float = 1.0, quadratic: float | None = None) -> DataFrame:
    """(doc_id, piece_no, start_char, end_char, n_tokens, container): every text with tokens in exactly one container, whole unless it exceeds the capacity; then it is cut into pieces within it, without overlap, each as full as a natural boundary in its last eighth allows.

    The cost of an item of n tokens is linear * n + quadratic * n^2; quadratic defaults to 1 / capacity, at which a full-size item costs as much for attention as for the rest. Items, in descending order and ties by doc_id and piece_no, go to the cheapest container with room. The items, repeated rows too, are spread by hash over groups that each need about GROUP containers, so a task holds a bounded number of sizes and numbers, whatever the sources' sizes; at most the last container of a group stays underfilled for that. Null and empty texts are in no container. Repeated rows are items of their own. Empty input: no rows.
    """
    quadratic = 1.0 / capacity if quadratic is None else quadratic
    items = stored(split_long(docs, capacity, 0, ranks, keep_short=True, with_text=False, cut=full_pieces).select("doc_id", "piece_no", "start_char", "end_char", "n_tokens"), "items")
    total = items.agg(F.sum("n_tokens")).first()[0] or 0
    groups = max(1, math.ceil(total / (GROUP * capacity)))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True])
        part["container"] = fill(part["n_tokens"].tolist(), capacity, linear, quadratic)
        part["container"] += int(key[0]) << 32
        return part.drop(columns="grp")

    ship(items.sparkSession)
    # The row's place in the stored table spreads repeated rows as well.
    spread = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece_no", "n_tokens", F.col("_metadata.row_index")), F.lit(groups)))
    return spread.groupBy("grp").applyInPandas(run, "doc_id long, piece_no int, start_char long, end_char long, n_tokens int, container long")
