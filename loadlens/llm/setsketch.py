"""Near-duplicate documents by SetSketch registers, banded, with a joint likelihood, then verified.

A register is the minimum of exponentially distributed hashes of a set, on a truncated
exponential scale (base ``b``, rate ``a``, 0..255), so that two sketches merge by the larger
register, and registers of similar sets agree often. ``rows`` successive registers form a band;
texts that share a band are compared by all their registers: from the numbers of smaller, equal
and larger registers and the set sizes, the likelihood of the Jaccard similarity follows. Pairs
whose likelihood at the threshold is not far below its maximum are plausible. Their clusters
are confirmed on full shingle sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm import text_kernels as kernels
from loadlens.llm.bits import bit_table, may_hold
from loadlens.llm.buckets import block_groups, forest, hub_first, pairs_of_groups, together, whole_groups
from loadlens.llm.graph import connected_components
from loadlens.llm.scratch import free_name, join_apart, passing, stored, write

BANDS, ROWS = 24, 4
BASE, RATE, TOP = 1.1, 20.0, 255
PERCENT = 75
#: A pair is plausible while log L(best) - log L(threshold) stays below this (four standard deviations).
SLACK = 8.0
#: A block of a cluster that is confirmed at once: so many texts and so many shingles at most.
VERIFY_BLOCK, VERIFY_SHINGLES = 1024, 1 << 20
#: Groups beyond this are compared with their first row before all pairs that are left.
LARGE = 64
_SEED = 20240


def _multipliers(registers: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    draw = rng.integers(0, 1 << 63, (2, registers), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def quantise(least: np.ndarray) -> np.ndarray:
    """Registers of minimum hashes (uniform in 0..2**64): floor(1 - log_b(exponential)), truncated to 0..255."""
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP).astype(np.uint8)


def sketch(hashes: np.ndarray, bounds: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """Registers (texts x registers) of the sets ``hashes[bounds[i]:bounds[i + 1]]``; an empty set has zeros."""
    out = np.zeros((len(bounds) - 1, registers), np.uint8)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        a, b = _multipliers(registers)
        starts = bounds[full]
        with np.errstate(over="ignore"):
            for i in range(registers):
                out[full, i] = quantise(np.minimum.reduceat(hashes * a[i] + b[i], starts))
    return out


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def _log_likelihood(j, u, v, more, less, equal):
    scale = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * scale) / math.log(BASE)
    above, below = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    return more * log(above) + less * log(below) + equal * log(1 - above - below)


def estimate(one, other, n_one, n_other) -> np.ndarray:
    """Jaccard similarity of pairs of sketches with known set sizes, by maximum likelihood."""
    return _estimate(*_counts(one, other), n_one, n_other, 1.0)[0]


def _counts(one, other):
    less, equal = (one < other).sum(axis=1), (one == other).sum(axis=1)
    return one.shape[1] - less - equal, less, equal


def _estimate(more, less, equal, n_one, n_other, most):
    total = n_one + n_other
    u, v = n_one / total, n_other / total
    low, high = np.zeros(len(u)), np.minimum(np.minimum(u / v, v / u), most)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(22):  # the logarithm is concave in j
        left, right = high - golden * (high - low), low + golden * (high - low)
        up = _log_likelihood(left, u, v, more, less, equal) < _log_likelihood(right, u, v, more, less, equal)
        low, high = np.where(up, left, low), np.where(up, high, right)
    best = (low + high) / 2
    return best, _log_likelihood(best, u, v, more, less, equal), u, v


def plausible(one, other, n_one, n_other, percent: int = PERCENT, slack: float = SLACK) -> np.ndarray:
    """Pairs whose similarity may reach the threshold, by size bound and likelihood."""
    out = 100 * np.minimum(n_one, n_other) >= percent * np.maximum(n_one, n_other)
    at = np.flatnonzero(out)
    if len(at):
        more, less, equal = _counts(one[at], other[at])
        a, b = n_one[at].astype(float), n_other[at].astype(float)
        bar = percent / 100
        _, top, u, v = _estimate(more, less, equal, a, b, bar)
        out[at] = top - _log_likelihood(np.minimum(bar, np.minimum(u / v, v / u)), u, v, more, less, equal) <= slack
    return out


def _class_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (equal sets, equal name), from two sums and the size."""
    n = len(bounds) - 1
    out = np.zeros(n, np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        with np.errstate(over="ignore"):
            again = kernels.mix(hashes ^ kernels.U64(0x5851F42D4C957F2D))
            one, two = (np.add.reduceat(x, bounds[full]) for x in (again, again * hashes))
            out[full] = kernels.mix(one + kernels.mix(two) + np.diff(bounds)[full].astype(np.uint64))
    return out.view(np.int64)


def _text_key(text_col: str = "text") -> Column:
    """A 64-bit name of a text, by which a row is found again where its id is null or not its own."""
    return F.xxhash64(F.col(text_col).cast("string"))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class, registers, text_key) of every row. ``class`` names the shingle set; null and blank
    texts have no shingles, class null and registers of zeros. ``text_key`` is that of ``_text_key``."""
    registers = bands * rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [None if t is None or t is pd.NA else t for t in frame["_text"].tolist()]
            for start, end in kernels.batches(texts):
                hashes, bounds = kernels.shingle_sets(texts[start:end])
                n = np.diff(bounds)
                name = pd.array(_class_of(hashes, bounds), dtype="Int64")
                name[n == 0] = pd.NA
                table = sketch(hashes, bounds, registers)
                yield pd.DataFrame({
                    "_id": frame["_id"].iloc[start:end].to_numpy(), "n_shingles": n, "class": name,
                    "registers": [r.tobytes() for r in table], "text_key": frame["_key"].iloc[start:end].to_numpy(),
                })

    slim = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"), _text_key(text_col).alias("_key"))
    made = slim.mapInPandas(run, "_id string, n_shingles long, class long, registers binary, text_key long")
    return made.select(F.col("_id").cast("long").alias("doc_id"), "n_shingles", "class", "registers", "text_key")


def _large_groups(sides: np.ndarray, sizes: np.ndarray, beyond: int, test):
    """Linked pairs of each group of more than ``beyond`` rows."""
    ends = np.cumsum(sizes)
    for end, size in zip(ends[sizes > beyond], sizes[sizes > beyond], strict=True):
        at = np.arange(end - size, end)
        own = sides[at]
        if own[0] == 2:
            yield hub_first(at, None, test)
        elif own[0] != own[-1]:  # else one of the two blocks is empty
            yield hub_first(at[own == 0], at[own == 1], test)


def plausible_edges(classes: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, large: int = LARGE) -> DataFrame:
    """(a, b) of plausible pairs of classes: per bucket a forest with the same components, not all pairs."""
    part = F.substring(F.col("registers"), F.col("band") * rows + 1, F.lit(rows))
    keyed = classes.select("class", "n", "registers", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
    keys = keyed.select(F.xxhash64("band", part).alias("key"), "class")
    grouped = block_groups(keys, "key", "class").join(classes, "class").select("group", "side", "class", "n", "registers")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames):
            table = np.frombuffer(b"".join(frame["registers"]), np.uint8).reshape(len(frame), -1)
            n, name = frame["n"].to_numpy(), frame["class"].to_numpy()
            found = [], []

            def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                good = name[a] != name[b]
                good[good] = plausible(table[a[good]], table[b[good]], n[a[good]], n[b[good]], percent)
                return good

            groups, sides = frame["group"].to_numpy(), frame["side"].to_numpy()
            sizes = np.bincount(np.cumsum(np.concatenate([[False], groups[1:] != groups[:-1]])))
            small = np.flatnonzero(np.repeat(sizes <= large, sizes))
            pairs = ((small[a], small[b]) for a, b in pairs_of_groups(groups[small], sides[small])) if len(small) else ()
            linked = ((a[good], b[good]) for a, b in pairs for good in [test(a, b)])
            for a, b in itertools.chain(linked, _large_groups(sides, sizes, large, test)):
                tops = forest(a, b, len(frame))
                found[0].append(tops[0])
                found[1].append(tops[1])
            if found[0]:
                a, b = forest(np.concatenate(found[0]), np.concatenate(found[1]), len(frame))
                yield pd.DataFrame({"a": name[a], "b": name[b]}).drop_duplicates()

    return together(grouped).mapInPandas(run, "a long, b long").distinct()


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, width: int = 4096):
    """Index pairs (left x right, or all pairs where both are the same) that reach the threshold, by exact
    intersection sizes: products of 0/1 matrices over the shingles that two texts share."""
    own = left is right
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1 if len(column) else column
    shares = np.zeros((len(left), len(right)), np.float32)
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for k, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        who, col = owner[start:end], column[start:end] - k * width
        one = np.zeros((len(left), width), np.float32)
        mine = at_left[who] >= 0
        one[at_left[who[mine]], col[mine]] = 1
        if own:
            shares += one @ one.T
        else:
            two = np.zeros((len(right), width), np.float32)
            mine = at_right[who] >= 0
            two[at_right[who[mine]], col[mine]] = 1
            shares += one @ two.T
    both = sizes[left][:, None] + sizes[right][None, :] - shares
    a, b = np.nonzero(100.0 * shares >= percent * both)
    a, b = left[a], right[b]
    return a[a != b], b[a != b]


def _confirmed(sets: list[np.ndarray], sides: np.ndarray, percent: int, large: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of a group with the components of all of them: first those with the first text, then those with a text
    that is not linked to it."""
    left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides == 1)
    if sides[0] != 2 and not (len(left) and len(right)):
        return left[:0], left[:0]
    if len(sides) <= large:
        return _linked(sets, left, left if sides[0] == 2 else right, percent)
    star = _linked(sets, left[:1], np.arange(1, len(sides)), percent)
    near = np.concatenate([left[:1], star[1]])
    rest = [(left[~np.isin(left, near)], left)] if sides[0] == 2 else [
        (left[~np.isin(left, near)], right), (left[np.isin(left, near)], right[~np.isin(right, near)])
    ]
    more = [_linked(sets, a, b, percent) for a, b in rest if len(a) and len(b)]
    return tuple(np.concatenate([x[k] for x in (star, *more)]) for k in (0, 1))


def verified_edges(docs: DataFrame, classes: DataFrame, clusters: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", block: int = VERIFY_BLOCK, large: int = LARGE) -> DataFrame:
    """(a, b) of classes whose full shingle sets reach the threshold: a forest per pair of blocks of a cluster.

    ``clusters`` has (node, component). Sets are made anew from the text of one row per class: that of its smallest id,
    or, if none of its rows has an id, that of its smallest text key.
    """
    by_text = F.col("rep").isNull().alias("by_text")
    place = F.coalesce("rep", "text_key").alias("place")
    members = clusters.select(F.col("component").alias("key"), F.col("node").alias("class")).join(classes.select("class", by_text, place, "n"), "class")
    wanted = block_groups(members, "key", "class", block, "n", VERIFY_SHINGLES).groupBy("by_text", "place", "class").agg(
        F.collect_list(F.struct("group", "side")).alias("tasks")  # as many as the cluster has blocks
    )
    wanted = stored(wanted, "wanted")
    slim = docs.select(F.col(id_col).cast("long").alias("rep"), _text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("_text"))
    # most texts are in no cluster and need no shuffle
    named = F.xxhash64(F.col("rep").isNull(), F.coalesce("rep", "text_key"))
    slim, may = may_hold(slim, bit_table(wanted, F.xxhash64("by_text", "place")), named)
    slim = slim.where(may).drop(may)
    unnamed = slim.where("rep is null").groupBy("text_key").agg(F.first("_text").alias("_text"))
    slim = slim.where("rep is not null").select(F.lit(False).alias("by_text"), F.col("rep").alias("place"), "_text").unionByName(
        unnamed.select(F.lit(True).alias("by_text"), F.col("text_key").alias("place"), "_text")
    )

    def to_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["_text"].tolist()
            for start, end in kernels.batches(texts):
                hashes, bounds = kernels.shingle_sets(texts[start:end])
                same = _class_of(hashes, bounds) == frame["class"].to_numpy()[start:end]  # not so for another text under the id
                part = frame.iloc[start:end]
                out = pd.DataFrame({"class": part["class"].to_numpy(), "tasks": part["tasks"].to_numpy()})
                out["set"] = [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in range(end - start)]
                yield out[same]

    kind = "class long, tasks array<struct<group: long, side: int>>, set binary"
    sets = slim.join(wanted, ["by_text", "place"]).select("class", "tasks", "_text").mapInPandas(to_sets, kind)
    rows = sets.select(F.inline("tasks"), "class", "set")

    def confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, 64):
            for _, part in frame.groupby("group", sort=False):
                part = part.drop_duplicates("class")
                names, sides = part["class"].to_numpy(), part["side"].to_numpy()
                sets = [np.frombuffer(s, np.uint64) for s in part["set"]]
                a, b = forest(*_confirmed(sets, sides, percent, large), len(part))
                if len(a):
                    yield pd.DataFrame({"a": names[a], "b": names[b]})

    return together(rows).mapInPandas(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Rows with 100 * |A & B| >= percent * |A | B| over their sets of five-word shingles are linked;
    component_id is the smallest id reachable. Null, empty and blank texts have no shingles and link
    with nothing: they are their own component. Rows of equal id and text share a component; a null id
    counts as larger than any and is kept only if the component has no other id. An empty table gives
    no rows; other columns are ignored. Links at exactly the threshold share no band in 6 of 100,000
    cases; more bands make that rarer.
    """
    found = _decided(docs, bands, rows, percent, id_col, text_col, large)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _decided(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """``near_duplicates`` with text_key, the component proper (two may have one smallest id if that id has two texts; null
    for texts without shingles) and first_key, the smallest text key in it."""
    made = stored(signatures(docs, bands, rows, id_col, text_col), "sketches")
    classes = stored(
        made.where("class is not null").groupBy("class").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"), F.min("text_key").alias("text_key"),
        ), "classes",
    )
    clusters = connected_components(plausible_edges(classes, bands, rows, percent, large))
    links = connected_components(verified_edges(docs, classes, clusters, percent, id_col, text_col, large=large))
    label = classes.select("class", "rep", "text_key").join(links.withColumnRenamed("node", "class"), "class", "left")
    label = label.withColumn("component", F.coalesce("component", "class"))
    least = label.groupBy("component").agg(F.min("rep").alias("component_id"), F.min("text_key").alias("first_key"))
    names = join_apart(label, least, "component").select("class", "component", "component_id", "first_key")
    joined = join_apart(made.select("doc_id", "n_shingles", "class", "text_key"), names, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", "text_key", "component", "first_key", own).withColumn("kept", kept)


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, one per group of near-duplicates: that of the smallest id.

    Of repeated rows (equal ids in one group) the first by content stays, in the order of the columns; equal ids in two
    groups both stay. A row without an id goes if its group has a row with one; in a group without any id the text of the
    smallest hash stays. Null, empty and blank texts are in no group: they stay, but of those with one id the first stays.
    An empty table gives no rows.

    Only rows that go, or that share their id with others of their group, are looked up by a join; a table of bits tells
    the other rows apart, so their texts are not shuffled.
    """
    spark = docs.sparkSession
    with passing(spark) as tables:
        decided = _decided(docs.select("doc_id", "text"), **options)
        first = (F.col("component").isNull() | F.when(F.col("component_id").isNull(), F.col("text_key") == F.col("first_key")).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))))
        rows = stored(decided.groupBy("doc_id", "component", "text_key").agg(F.first(first).alias("first"), F.count("*").alias("rows")), "decided")
        shared = rows.where("first and (doc_id is not null or component is not null)").groupBy("doc_id", "component").agg(F.sum("rows").alias("rows")).where("rows > 1")
        shared = shared.select(F.col("doc_id").alias("_id"), F.col("component").alias("_group"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("component").eqNullSafe(F.col("_group"))
        named = lambda rows, goes: rows.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("component").alias("_group"), F.lit(goes).alias("_goes"))
        several = named(rows.where("first").join(shared, same, "left_semi"), False)
        special = write(named(rows.where("not first"), True).unionByName(several), "not-alone")
        tables.remove(special)
    special = spark.read.schema("_id long, _key long, _group long, _goes boolean").parquet(special)
    ident, key = F.col("doc_id").cast("long"), _text_key()
    hashed, seen = F.xxhash64(ident, key), F.xxhash64("_id", "_key")
    marked, may = may_hold(docs, bit_table(special, seen), hashed)
    theirs = special.select(F.col("_id").alias(mine := free_name(docs, "_id")), F.col("_key").alias(text := free_name(docs, "_key")))
    held = marked.where(may).join(theirs, ident.eqNullSafe(F.col(mine)) & (key == F.col(text)), "left_anti")
    out = marked.where(~F.col(may)).unionByName(held).select(docs.columns)
    several = special.where("not _goes")
    if several.isEmpty():
        return out
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]  # what has an order
    marked, may = may_hold(docs, bit_table(several, seen), hashed)
    some = marked.where(may).select(F.struct(*docs.columns).alias("_row"), F.struct(*plain).alias("_order"), ident.alias("_own"), key.alias("_own_key"))
    shared = some.join(several, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")))
    return out.unionByName(shared.groupBy("_id", "_group").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*"))
