"""Sharding: minimax contiguous partition over ordered atomic groups.

A group is all rows with an equal text; it is never split. Groups are ordered
by a 63-bit hash of their text, and shard i is a contiguous run of that order,
so a row's shard is a comparison of its hash with n - 1 cut points: no join.

The smallest feasible capacity is found by binary search with a greedy check.
The check needs prefix sums over all groups, which do not fit on the driver,
so it works on *items*: key ranges with their total size. A range that can
contain a cut for some capacity still in question is replaced by finer ranges
(one grouped aggregation per round) until every such range is a single group.
The items on the driver stay bounded by `bins` a round however many groups
there are, and the capacity is exact.

Cuts then go as near to an even size as that capacity allows.

Only DataFrame expressions touch the rows; the driver handles range sums.

Defined cases: a null text has size 16 and CRC 0 and shares the group of the
empty text; an empty table gives no rows; repeated rows are separate rows of
one group, each with its own slot; a null doc_id is placed like any other.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import any_of, materialize, text_or_empty

KEY_END = 1 << 63
ROW_OVERHEAD = 16


class Item:
    """`n` groups of total size `weight` whose keys lie in [lo, hi)."""

    __slots__ = ("lo", "hi", "weight", "n", "largest")

    def __init__(self, lo, hi, weight, n, largest):
        self.lo, self.hi, self.weight, self.n, self.largest = lo, hi, weight, n, largest


def split_ranges(groups: DataFrame, ranges: list[tuple[int, int]], width: int) -> list[Item]:
    """Sums of `groups` over the parts, `width` keys wide, of each range."""
    key = F.col("key")
    # one small struct per range, picked by comparison
    which: Column = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(ranges):
        which = F.when((key >= lo) & (key <= hi - 1), F.lit(i)).otherwise(which)
    los = F.array(*[F.lit(lo).cast("long") for lo, _ in ranges])
    rows = (groups.where(any_of([(key >= lo) & (key <= hi - 1) for lo, hi in ranges]))
            .withColumn("span", which)
            .withColumn("lo", F.element_at(los, F.col("span") + 1))
            .withColumn("bin", F.expr(f"(key - lo) div {width}"))
            .groupBy("span", "bin")
            .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"),
                 F.max("weight").alias("largest"))
            .collect())
    out = []
    for r in rows:
        lo, hi = ranges[r["span"]]
        start = lo + r["bin"] * width
        out.append(Item(start, min(hi, start + width), r["weight"], r["n"], r["largest"]))
    return sorted(out, key=lambda x: x.lo)


def reach(prefix: list[int], start: int, capacity: int) -> int:
    """The furthest item boundary that a shard from boundary `start` can take."""
    return max(start, bisect_right(prefix, prefix[start] + capacity) - 1)


def shards_needed(prefix: list[int], start: int, capacity: int, most: int) -> int:
    """Greedy shard count from `start`; more than `most` if it does not fit."""
    used = 0
    while start < len(prefix) - 1:
        used += 1
        if used > most:
            return used
        after = reach(prefix, start, capacity)
        if after == start:
            return most + 1
        start = after
    return used


def smallest_capacity(prefix: list[int], shards: int, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        if shards_needed(prefix, 0, mid, shards) <= shards:
            high = mid
        else:
            low = mid + 1
    return low


def zones_in_question(items: list[Item], prefix: list[int], shards: int, low: int,
                      high: int) -> list[list[int]]:
    """Runs [first, last] of items that a cut can fall into for a capacity in
    [low, high], from the least to the furthest place of each cut; at most one
    run a cut, each beginning and ending with an item of several groups."""
    zones: list[list[int]] = []
    near, far, far_used = 0, 0, 0.0  # far: inside item `far`, `far_used` of it taken
    last = len(items)
    for _ in range(shards):
        near = reach(prefix, near, low)
        room = float(high)
        while far < last:
            left = items[far].weight - far_used
            if left <= room:
                room -= left
                far, far_used = far + 1, 0.0
            else:
                if items[far].n > 1:  # its groups are unknown: it may be cut anywhere
                    far_used += room
                break
        unsure = [i for i in range(near, min(far + 1, last)) if items[i].n > 1]
        if unsure and zones and unsure[0] <= zones[-1][1] + 1:
            zones[-1][1] = max(zones[-1][1], unsure[-1])
        elif unsure:
            zones.append([unsure[0], unsure[-1]])
    return zones


def plan(groups: DataFrame, shards: int, bins: int) -> tuple[list[int], int]:
    """(cut keys, capacity): shard = number of cut keys not above the row's key."""
    width = -(-KEY_END // bins)
    items = split_ranges(groups, [(0, KEY_END)], width)
    if not items:
        return [KEY_END - 1] * (shards - 1), 0
    while True:
        prefix = [0, *accumulate(x.weight for x in items)]
        total = prefix[-1]
        low = max(max(x.largest for x in items), -(-total // shards))
        high = smallest_capacity(prefix, shards, low, total)
        zones = [] if low == high else zones_in_question(items, prefix, shards, low, high)
        if not zones:
            break
        ranges = [(items[a].lo, items[b].hi) for a, b in zones]
        gone = {i for a, b in zones for i in range(a, b + 1)}
        # about `bins` parts over the ranges, and finer than before in any case
        width = max(1, min(-(-sum(hi - lo for lo, hi in ranges) // bins), width // 8))
        finer = split_ranges(groups, ranges, width)
        items = sorted([x for i, x in enumerate(items) if i not in gone] + finer,
                       key=lambda x: x.lo)
    return even_cuts(items, prefix, shards, high), high


def even_cuts(items: list[Item], prefix: list[int], shards: int, capacity: int) -> list[int]:
    """Cut as near to the even size as `capacity` and the shards left allow. The
    even size leaves out groups above it, each of which fills a shard alone."""
    big, even = [], prefix[-1] / shards
    for w in sorted((x.largest for x in items), reverse=True):
        if w <= even or len(big) >= shards - 1:
            break
        big.append(w)
        even = (prefix[-1] - sum(big)) / (shards - len(big))
    cuts, start = [], 0
    for left in range(shards - 1, 0, -1):
        want = prefix[start] + even
        after = bisect_right(prefix, want) - 1
        if after + 1 < len(prefix) and prefix[after + 1] - want < want - prefix[after]:
            after += 1
        most = reach(prefix, start, capacity)
        after = min(max(after, start + (start < len(items))), most)
        # the rest must fit into the shards left: the least boundary from which it does
        if shards_needed(prefix, after, capacity, left) > left:
            lo, hi = after, most
            while lo < hi:
                mid = (lo + hi) // 2
                if shards_needed(prefix, mid, capacity, left) <= left:
                    hi = mid
                else:
                    lo = mid + 1
            after = lo
        cuts.append(items[after].lo if after < len(items) else KEY_END - 1)
        start = after
    return cuts


def assign_shards(docs: DataFrame, shards: int = 40, bins: int = 1 << 14,
                  rows_per_cell: int = 20_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    bins: most key ranges held by the driver in a round. rows_per_cell: rows of
    one sort when slots are dealt; a shard is dealt over as many cells by a
    hash of the doc_id, so a hot group is spread too.
    """
    text = text_or_empty("text")
    base = materialize(docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
         + ROW_OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.expr("shiftrightunsigned(xxhash64(coalesce(cast(text as string), '')), 1)").alias("key"),
    ), "shard-rows")
    groups = materialize(base.groupBy("key").agg(F.sum("size").alias("weight")), "shard-groups")
    cuts, _ = plan(groups, shards, bins)
    shard = sum([(F.col("key") >= F.lit(c).cast("long")).cast("int") for c in cuts],
                F.lit(0)).cast("int")
    placed = base.withColumn("shard", shard)
    rows = {r["shard"]: r["n"] for r in
            placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = F.array(*[F.lit(max(1, -(-rows.get(s, 0) // rows_per_cell)) + 7).cast("long")
                      for s in range(shards)])
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "key"),
                                              F.element_at(cells, F.col("shard") + 1)))
    before = (placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("base", F.sum("n").over(
                  Window.partitionBy("shard").orderBy("cell")) - F.col("n"))
              .drop("n"))
    order = Window.partitionBy("shard", "cell").orderBy("doc_id", "key")
    return (placed.withColumn("rank", F.row_number().over(order) - 1)
            .join(before, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("rank")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
