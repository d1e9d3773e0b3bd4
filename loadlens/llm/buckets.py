"""Candidate buckets of locality-sensitive hashes, compared in blocks of bounded size.

A bucket table has one row per (key, node). Buckets of one node vanish. Larger ones become
one task group each; those above ``block`` nodes are cut into blocks, and every pair of
blocks becomes a group of its own, so that no group exceeds two blocks and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.scratch import join_apart

BLOCK = 2048


def block_groups(
    rows: DataFrame, key: str, node: str, block: int = BLOCK, weight: str | None = None, most_weight: int = 1
) -> DataFrame:
    """Rows with ``group`` (long) and ``side`` (0, 1, or 2 where a block meets itself).

    A group is all rows of one key, or two blocks of it. Sizes come from an aggregation, and a
    row of a key with k blocks appears k times. A block has about ``block`` rows at most, and about
    ``most_weight`` of the column ``weight`` in sum.
    """
    heavy = F.sum(weight) if weight else F.lit(0)
    sizes = rows.groupBy(key).agg(F.count("*").alias("_size"), heavy.alias("_weight")).where("_size > 1")
    blocks = F.greatest(F.ceil(F.col("_size") / block), F.ceil(F.col("_weight") / most_weight)).cast("int")
    cut = join_apart(rows, sizes, key).withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64(F.lit(7), F.col(node)), F.col("_blocks")).cast("int")
    cut = cut.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return cut.select(
        F.xxhash64(F.col(key), F.least("_own", "_other"), F.greatest("_own", "_other")).alias("group"),
        F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
        .cast("int").alias("side"),
        *[c for c in rows.columns if c != key],
    )


def together(rows: DataFrame) -> DataFrame:
    """All rows of a group in one task, next to each other."""
    return rows.repartition(F.col("group")).sortWithinPartitions("group", "side")


def whole_groups(frames: Iterator[pd.DataFrame], least_rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Rejoin Arrow batches so that no group is cut; a frame holds many small groups or a large one."""
    held: list[pd.DataFrame] = []
    count = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        count += len(frame)
        if count < least_rows:
            continue
        one = pd.concat(held, ignore_index=True)
        groups = one["group"].to_numpy()
        cut = int(np.flatnonzero(groups != groups[-1])[-1]) + 1 if groups[0] != groups[-1] else 0
        if cut:
            yield one.iloc[:cut].reset_index(drop=True)
        held = [one.iloc[cut:].reset_index(drop=True)]
        count = len(held[0])
    if count:
        yield pd.concat(held, ignore_index=True)


def pairs_of_groups(groups: np.ndarray, sides: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within each run of equal ``groups``: side 2 rows among themselves, side 0 with side 1.

    Groups follow each other and are sorted by side. Yields at most about ``most`` pairs at once.
    """
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.concatenate([starts[1:], [len(groups)]])
    # row i meets the rows [low_i, high_i) behind it: the rest of its block, or the other side
    index = np.arange(len(groups))
    which = np.repeat(np.arange(len(starts)), ends - starts)
    first_of_side_1 = starts + np.add.reduceat((sides == 0).astype(np.int64), starts)
    low = np.where(sides == 2, index + 1, np.where(sides == 0, first_of_side_1[which], 0))
    high = np.where(sides == 1, 0, ends[which])
    counts = np.maximum(high - low, 0)
    total = np.cumsum(counts)
    i = 0
    while i < len(index):
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + most, side="right")))
        n = counts[i:j]
        if n.sum():
            left = np.repeat(index[i:j], n)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield left, np.repeat(low[i:j], n) + offset
        i = j


def hub_first(left: np.ndarray, right: np.ndarray | None, test, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one large group with the components of all its linked pairs, in few comparisons where most are alike.

    The rows ``left`` meet each other (``right`` None) or the rows ``right``. ``test(a, b)`` tells which index pairs are
    linked. All rows are compared with the first one; its partners are connected through it, so only pairs with a row
    that is not its partner are left to compare.
    """
    hub, others = left[:1], np.concatenate([left[1:], right if right is not None else left[:0]])
    found = [], []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        good = test(a, b)
        found[0].append(a[good])
        found[1].append(b[good])

    for low in range(0, len(others), most):
        part = others[low : low + most]
        compare(np.repeat(hub, len(part)), part)
    near = np.concatenate([hub, *found[1]])
    far = left[~np.isin(left, near)]
    sides = [(far, left)] if right is None else [(far, right), (left[np.isin(left, near)], right[~np.isin(right, near)])]
    for one, two in sides:
        step = max(1, most // max(1, len(two)))
        for low in range(0, len(one), step):
            part = one[low : low + step]
            compare(np.repeat(part, len(two)), np.tile(two, len(part)))
    return np.concatenate(found[0]), np.concatenate(found[1])


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star forest over nodes 0..n-1 with the same components as the edges (a, b): at most n-1 edges."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        open_ = low != high
        if not open_.any():
            break
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:  # shorten paths
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter
    members = np.flatnonzero(label != np.arange(n))
    return members, label[members]
