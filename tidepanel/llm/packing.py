"""Best-fit packing by a configuration linear program.

Documents become token ids with an end id; those longer than `capacity` are cut
into pieces of `capacity`, of which the first may be shorter. What is to be
packed is then only the histogram of piece lengths (`capacity` numbers), so the
plan is made on the driver and the pieces never leave the executors:

* the linear program has a variable for every configuration (multiset of
  lengths that fits one sequence) and a covering row for every length; it is
  solved by multiplicative weights, where a dynamic program over the knapsack
  of `capacity` tokens prices the best configuration in each round;
* shares of the fractional solution are rounded down, and what each leaves over is
  packed best-fit by decreasing length, on counts of equal lengths and equal bins;
  the share that ends in the fewest sequences is the plan. The weights, as duals,
  give a lower bound on that number (`plan_and_bound`);
* a piece gets a gapless rank among those of its length, and the plan says
  which ranks of a length go to which sequence and offset.

Defined cases: a null or empty text is the end id alone; an empty table gives no
rows; repeated rows are packed as separate pieces; null doc_ids are kept.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import materialize, text_or_empty
from tidepanel.llm.encoding import crc32, encoder, text_batches

Configuration = tuple[tuple[int, int], ...]  # (length, copies), longest first
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def cut_into_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        enc = encoder(vocabulary)
        for frame in batches:
            ids, texts = list(frame["doc_id"]), list(frame["text"])
            for part in text_batches(texts):
                out = []
                for doc_id, data in zip(ids[part], enc.batch(texts[part])):
                    data += end
                    n = len(data) // 4
                    at, piece = 0, 0
                    size = (n % capacity or capacity) if n > capacity else n
                    while at < n:
                        out.append((doc_id, piece, at, size,
                                    crc32(memoryview(data)[4 * at:4 * (at + size)])))
                        at, piece, size = at + size, piece + 1, capacity
                yield pd.DataFrame(out, columns=[
                    "doc_id", "piece", "start", "length", "ids_crc32"])

    # the id crosses as text: pandas has no exact integer next to nulls
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       text_or_empty("text").alias("text"))
    return rows.mapInPandas(pieces, PIECES).withColumn("doc_id", F.col("doc_id").cast("long"))


def priced_configurations(value: np.ndarray, lengths: np.ndarray, capacity: int,
                          most: np.ndarray, count: int, slack: float
                          ) -> tuple[list[dict[int, int]], float]:
    """Knapsack pricing: for each length with a value the best multiset within
    `capacity` that holds it, the `count` best of them that are within `slack` of the best
    of all, cut to `most` copies of a length; and the best worth (without that cut).
    Items are indexes of `lengths`."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    shortest = int(lengths[0])
    for room in range(shortest, capacity + 1):
        fit = int(np.searchsorted(lengths, room, side="right"))
        worth = best[room - lengths[:fit]] + value[:fit]
        i = int(worth.argmax())
        best[room] = best[room - 1]
        if worth[i] > best[room]:
            best[room], choice[room] = worth[i], i
    total = value + best[capacity - lengths]
    found = []
    order = np.argsort(-total, kind="stable")
    good = (total[order] >= (1 - slack) * best[capacity]) & (value[order] > 0)
    for first in order[good][:count]:
        counts: dict[int, int] = defaultdict(int)
        counts[int(first)] += 1
        room = capacity - int(lengths[first])
        while room >= shortest:
            i = int(choice[room])
            if i < 0:
                room -= 1
                continue
            counts[i] += 1
            room -= int(lengths[i])
        found.append({i: min(n, int(most[i])) for i, n in counts.items()})
    return found, float(best[capacity])


def solve_by_weights(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int,
                     rate: float, count: int, slack: float
                     ) -> tuple[dict[Configuration, float], float]:
    """Multiplicative weights for the covering program: (solution, dual bound).

    A length's weight is its share of a sequence (the dual of the volume bound) times
    exp(-rate x cover), nothing once its demand is covered. Each round prices, for
    every length, the best configuration that holds it, and raises the `count` best within
    `slack` of the best by a step that is dealt out by the demand they can meet.
    Weights divided by the best price are feasible for the dual, so what they are
    worth over the demand bounds the number of sequences from below."""
    volume = float((lengths * demand).sum()) / capacity
    step = volume / rounds
    covered = np.zeros(len(lengths))
    taken: dict[Configuration, float] = defaultdict(float)
    bound = volume
    for done in range(2 * rounds):
        short = covered / demand
        value = np.where(short < 1, lengths * np.exp(rate * (done / rounds - short)), 0.0)
        found, price = priced_configurations(value, lengths, capacity, demand, count, slack)
        if not found:
            break
        bound = max(bound, float((value * demand).sum()) / price)
        wanted = [min(demand[i] / n for i, n in content.items()) for content in found]
        for content, want in zip(found, wanted):
            amount = min([step * want / sum(wanted),
                          *((demand[i] - covered[i]) / n for i, n in content.items())])
            if amount <= 0:
                continue
            for i, n in content.items():
                covered[i] += n * amount
            taken[tuple(sorted(((int(lengths[i]), n) for i, n in content.items()),
                               reverse=True))] += amount
    return taken, bound


def best_fit(left: dict[int, int], capacity: int,
             opened: list[tuple[Configuration, int]] = ()) -> list[tuple[Configuration, int]]:
    """Best-fit by decreasing length, on counts: equal bins move together. `opened`:
    bins that hold something already."""
    by_room: dict[int, list[tuple[Configuration, int]]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, dtype=np.int64)  # bins by room

    def put(content, bins):
        room = capacity - sum(length * n for length, n in content)
        by_room[room].append((content, bins))
        rooms[room] += bins

    for content, bins in opened:
        put(content, bins)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            open_rooms = np.flatnonzero(rooms[length:])
            if not len(open_rooms):
                each = capacity // length
                full, rest = divmod(n, each)
                for copies, bins in ((each, full), (rest, 1 if rest else 0)):
                    if bins:
                        put(((length, copies),), bins)
                break
            room = int(open_rooms[0]) + length
            content, bins = by_room[room].pop()
            rooms[room] -= bins
            each = min(room // length, n)
            take = min(bins, n // each)
            if take < bins:
                put(content, bins - take)
            put(content + ((length, each),), take)
            n -= take * each
    return [x for group in by_room.values() for x in group]


def rounded(taken: dict[Configuration, float], left: dict[int, int], capacity: int,
            keep: float) -> list[tuple[Configuration, int]]:
    """The share `keep` of the program's solution rounded down to bins, which stay open
    for best-fit of what is left (pieces of every length)."""
    left, opened = dict(left), []
    for content in sorted(taken, key=lambda c: (-sum(length * n for length, n in c), c)):
        bins = min([int(keep * taken[content]), *(left[length] // n for length, n in content)])
        if bins > 0:
            opened.append((content, bins))
            for length, n in content:
                left[length] -= bins * n
    return best_fit({k: n for k, n in left.items() if n}, capacity, opened)


def sequences(plan: list[tuple[Configuration, int]]) -> int:
    return sum(bins for _, bins in plan)


def plan_and_bound(histogram: dict[int, int], capacity: int, rounds: int = 200, rate: float = 4.0,
                   count: int = 64, slack: float = 0.01,
                   shares: tuple[float, ...] = (1, 0.9, 0.7, 0.4, 0.2, 0.1, 0.05, 0.02, 0.01)
                   ) -> tuple[list[tuple[Configuration, int]], float]:
    """(plan, lower bound): configurations with the number of their sequences, which hold
    every piece once. Where each configuration is rare, rounding it wastes more than the
    program gains; so several shares of the solution are rounded and the one with the
    fewest sequences is the plan, unless an earlier one meets the bound already."""
    left = {length: n for length, n in histogram.items() if n}
    full = left.pop(capacity, 0)
    plan: list[tuple[Configuration, int]] = [(((capacity, 1),), full)] if full else []
    if not left:
        return plan, float(full)
    lengths = np.array(sorted(left), dtype=np.int64)
    demand = np.array([left[int(x)] for x in lengths], dtype=np.float64)
    taken, bound = solve_by_weights(lengths, demand, capacity, rounds, rate, count, slack)
    best: list[tuple[Configuration, int]] = []
    for keep in shares:
        found = rounded(taken, left, capacity, keep)
        if not best or sequences(found) < sequences(best):
            best = found
        if sequences(best) < bound + 1:
            break
    return plan + best, full + bound


def plan_sequences(histogram: dict[int, int], capacity: int,
                   **settings) -> list[tuple[Configuration, int]]:
    return plan_and_bound(histogram, capacity, **settings)[0]


def placement(plan: list[tuple[Configuration, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies, offset), by length and rank."""
    cursor: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for content, bins in plan:
        offset = 0
        for length, copies in content:
            rows.append((length, cursor[length], sequence, copies, offset))
            cursor[length] += bins * copies
            offset += length * copies
        sequence += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024,
         rows_per_cell: int = 2000) -> DataFrame:
    """Pieces with their sequence and offset."""
    pieces = materialize(cut_into_pieces(docs, vocabulary, end_id, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = placement(plan_sequences(histogram, capacity))
    # a length gets cells by the number of its pieces (the list is as long as `capacity`)
    cells = F.array(*[F.lit(1 + histogram.get(length, 0) // rows_per_cell)
                      for length in range(capacity + 1)])
    dealt = pieces.withColumn("cell", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"),
        F.get(cells, F.col("length").cast("int")).cast("long")))
    before = (dealt.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("base", F.sum("n").over(
                  Window.partitionBy("length").orderBy("cell")) - F.col("n")).drop("n"))
    order = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (dealt.withColumn("rank", F.row_number().over(order) - 1)
              .join(before, ["length", "cell"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("base") + F.col("rank")).cast("long").alias("rank")))

    def place(batches):
        keys = table[:, 0] << 44 | table[:, 1]
        for frame in batches:
            length = frame["length"].to_numpy(dtype=np.int64)
            rank = frame.pop("rank").to_numpy(dtype=np.int64)
            at = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            q = rank - at[:, 1]
            frame["sequence_id"] = at[:, 2] + q // at[:, 3]
            frame["offset"] = at[:, 4] + q % at[:, 3] * length
            yield frame

    placed = ranked.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        place, PIECES + ", sequence_id long, offset long")
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))
