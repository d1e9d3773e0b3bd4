"""Near-duplicate vectors by p-stable hashing of normalised vectors, then exact cosines.

``m`` random projections, shifted and cut into cells of ``width``, make one bucket key; there are
``tables`` of them. Vectors of a label that share a bucket are compared exactly. A pair that meets
in several tables counts in the first of them only, so no list of pairs is built or made distinct.

Projections and tables follow from the number of rows: the more rows, the narrower the buckets, so that an unrelated
vector shares a bucket with a bounded number of others at any size, and the more tables, so that a pair at the bar is
missed with the same chance at any size. Buckets of one vector vanish before vectors are moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.buckets import block_groups, forest, pairs_of_groups, together, whole_groups
from loadlens.llm.graph import connected_components
from loadlens.llm.scratch import join_apart, stored, warm
from loadlens.llm.text_kernels import U64, mix

WIDTH, COSINE = 2.0, 0.93
#: Chance that a pair at exactly the bar meets in no table, and unrelated vectors that share a bucket with one, on average.
MISSED, STRANGERS = 0.001, 0.25
_SEED = 97


def meeting(cosine: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two unit vectors of this cosine into one cell (Gaussian projections, random shift)."""
    t = width / math.sqrt(2 - 2 * cosine)
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def sized(rows: int, cosine: float = COSINE, width: float = WIDTH, missed: float = MISSED, strangers: float = STRANGERS) -> tuple[int, int]:
    """(tables, projections) for so many rows: at most ``strangers`` of them (at cosine 0) fall into one's bucket by chance, and
    a pair at ``cosine`` meets in no table with a chance of ``missed``."""
    projections = max(4, math.ceil(math.log(max(1, rows) / strangers) / -math.log(meeting(0, width))))
    near = meeting(cosine, width) ** projections if cosine < 1 else 1.0
    return (max(1, math.ceil(math.log(missed) / math.log1p(-near))) if near < 1 else 1), projections


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float = WIDTH) -> np.ndarray:
    """(vectors x tables) bucket keys (32 bits) of unit vectors: floor((a . v + b) / width) for Gaussian a, hashed per table."""
    rng = np.random.default_rng([_SEED, vectors.shape[1]])
    a = rng.normal(size=(vectors.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    out = np.empty((len(vectors), tables), np.int32)
    step = max(1, 2_000_000 // (tables * projections))
    for low in range(0, len(vectors), step):
        cells = np.floor((vectors[low : low + step] @ a + b) / width).astype(np.int64).view(np.uint64).reshape(-1, tables, projections)
        with np.errstate(over="ignore"):
            key = np.broadcast_to(np.arange(tables, dtype=np.uint64), cells.shape[:2]).copy()
            for k in range(projections):
                key = key * U64(0x9E3779B97F4A7C15) + cells[:, :, k]
                key ^= key >> U64(32)
            out[low : low + step] = mix(key).astype(np.uint32).view(np.int32)
    return out


def _padded(lists: pd.Series, width: int) -> np.ndarray:
    """Rows of at most ``width`` numbers, zeros behind them."""
    sizes = lists.str.len().to_numpy()
    out = np.zeros((len(lists), width), np.int32)
    if sizes.sum():
        out[np.arange(width) < sizes[:, None]] = np.concatenate(lists.to_numpy())
    return out


def _matrix(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(v, np.float64) for v in column]


def classes_of(vectors: DataFrame, label_col: str, id_col: str, vec_col: str) -> DataFrame:
    """One row per different vector of a label: node, dim, label, vector, copies, least (smallest id).

    Vectors that are null, zero or hold null or non-finite components, and null labels, are left out.
    """
    wide = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
    )
    return _with_node(wide).where("node is not null").groupBy("node", "label", "v").agg(
        F.count("*").alias("copies"), F.min("id").alias("least")
    )


def _with_node(wide: DataFrame) -> DataFrame:
    """``node`` names label and vector; null where the vector links with nothing. -0.0 counts as 0.0."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    return wide.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn(
        "node", F.when(usable, F.xxhash64("label", "v"))
    )


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, missed: float = MISSED, width: float = WIDTH,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly), component_id, kept.

    Rows link if their labels are equal and not null and their cosine, in double precision, is at
    least ``cosine``; equal vectors of a label always do. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing and are their own component. A null id counts as larger
    than any. Vectors of different length never link. A pair at exactly the bar shares no bucket with a chance of ``missed``,
    nearer ones far more rarely. An empty table gives no rows; other columns are ignored.
    """
    tables, projections = sized(vectors.count(), cosine, width, missed)
    made = classes_of(vectors, label_col, id_col, vec_col)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        for frame in frames:
            rows = [np.array(v, np.float64) for v in frame["v"]]
            rows = [v / np.abs(v).max() for v in rows]
            unit = [v / np.linalg.norm(v) for v in rows]
            sizes = np.array([len(v) for v in unit])
            keys = np.empty((len(unit), tables), np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                keys[at] = bucket_keys(np.stack([unit[i] for i in at]), tables, projections, width)
            yield pd.DataFrame({
                "node": frame["node"], "copies": frame["copies"], "least": frame["least"].astype("Int64"),
                "space": [f"{n} {label}" for n, label in zip(sizes, frame["label"], strict=True)],
                "unit": [v.tobytes() for v in unit], "keys": list(keys),
            })

    classes = stored(made.mapInPandas(hashed, "node long, copies long, least long, space string, unit binary, keys array<int>"), "vectors")
    keys = classes.select("node", F.posexplode("keys").alias("table", "bucket"), "space").select(
        F.xxhash64("space", "table", "bucket").alias("key"), "node", "table"
    )
    met = block_groups(keys, "key", "node").join(classes.select("node", "copies", "unit", "keys"), "node")
    rows = met.withColumn("keys", F.slice("keys", F.lit(1), F.col("table")))  # those of the tables before this one

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        for frame in whole_groups(frames, 8_000):
            node, copies, table = (frame[c].to_numpy() for c in ("node", "copies", "table"))
            own = _padded(frame["keys"], int(table.max()))  # the rows of a group are of one table
            lengths = frame["unit"].str.len().to_numpy()
            links = np.zeros(len(frame), np.int64)
            stars = [], []
            for size in np.unique(lengths):  # a group has one length, its space says so
                at = np.flatnonzero(lengths == size)
                unit = np.stack(_matrix(frame["unit"].iloc[at]))
                for a, b in pairs_of_groups(frame["group"].to_numpy()[at], frame["side"].to_numpy()[at], 50_000):
                    near = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
                    a, b = at[a[near]], at[b[near]]
                    met = (own[a] == own[b]) & (np.arange(own.shape[1]) < table[a][:, None])
                    fresh = ~met.any(axis=1) & (node[a] != node[b])
                    a, b = a[fresh], b[fresh]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    tops = forest(a, b, len(frame))
                    stars[0].append(tops[0])
                    stars[1].append(tops[1])
            got = np.flatnonzero(links)
            yield pd.DataFrame({"a": node[got], "b": pd.array([pd.NA] * len(got), "Int64"), "n": links[got]})
            if stars[0]:
                a, b = forest(np.concatenate(stars[0]), np.concatenate(stars[1]), len(frame))
                yield pd.DataFrame({"a": node[a], "b": pd.array(node[b], "Int64"), "n": np.zeros(len(a), np.int64)})

    found = stored(together(rows).mapInPandas(compare, "a long, b long, n long"), "links")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    label = classes.select("node", "copies", "least").join(
        connected_components(found.where("b is not null")), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_apart(label, least, "component").join(links.withColumnRenamed("a", "node"), "node", "left").select(
        "node", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    wide = _with_node(vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
    ))
    joined = join_apart(wide.select("vec_id", "node"), named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
