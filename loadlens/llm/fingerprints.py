"""Document fingerprints: the k smallest distinct hashes of five-word shingles (bottom-k sketches).

Sketches of parts merge to the sketch of the whole. From two of them follow resemblance,
containment and numbers of distinct shingles; sets of at most k shingles are held whole, and
their figures are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import text_kernels as kernels

K = 128
BITS = 48


def sketches(texts: list[str | None], k: int = K) -> list[np.ndarray]:
    """Bottom-k sketch (sorted, distinct, 48-bit) of each text; null, empty and blank texts have empty ones."""
    out: list[np.ndarray] = []
    for start, end in kernels.batches(texts):
        hashes, owner = kernels.shingle_hashes(kernels.split_words(kernels.encode(texts[start:end])))
        hashes >>= kernels.U64(64 - BITS)
        cuts = np.searchsorted(owner, np.arange(end - start + 1))
        for i in range(end - start):
            own = hashes[cuts[i] : cuts[i + 1]]
            # repeated shingles may crowd the front, so the front is widened until it holds k distinct ones
            take = 2 * k
            while take < len(own):
                front = np.unique(np.partition(own, take)[:take])
                if len(front) >= k:
                    break
                take *= 4
            else:
                front = np.unique(own)
            out.append(front[:k])
    return out


def merge(one: np.ndarray, other: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union."""
    return np.union1d(one, other)[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Number of distinct shingles: exact below k, else from the k-th smallest hash."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[k - 1]) + 1) / 2.0**BITS)


def resemblance(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated |A & B| / |A | B|; 1 for two empty sets."""
    union = merge(one, other, k)
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(one, other, assume_unique=True), union, assume_unique=True)) / len(union)


def containment(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated share of A that lies in B; 1 for an empty A."""
    if not len(one):
        return 1.0
    both = resemblance(one, other, k) * distinct_count(merge(one, other, k), k)
    return min(1.0, both / distinct_count(one, k))


def to_bytes(sketch: np.ndarray) -> bytes:
    """Six big-endian bytes per hash."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def fingerprint_column(k: int = K):
    """A column function: text -> sketch as binary."""

    @F.pandas_udf("binary")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([to_bytes(s) for s in sketches([t if isinstance(t, str) else None for t in texts], k)], dtype=object)

    return fingerprint


def edit_with(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many, or all, of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range(ids: pd.Series, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range number of each id, larger ids in smaller numbers, null ids in the last range; and the ids (0 for null)."""
    missing = ids.isna().to_numpy()
    known = ids.to_numpy(np.int64) if not missing.any() else np.array([0 if m else int(i) for i, m in zip(ids, missing, strict=True)], np.int64)
    return np.where(missing, len(splits), len(splits) - np.searchsorted(splits, known, side="left")), known


def _ranges(ids: DataFrame, partitions: int) -> tuple[np.ndarray, dict[int, int]]:
    """Cut points of the ids, and the largest id of each range that has one (``partitions`` numbers each)."""
    ids = ids.where("doc_id is not null")
    shares = [i / partitions for i in range(1, partitions)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, partitions * 20).alias("cuts")).first()["cuts"] if shares else []
    splits = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        return pd.Series(_range(values, splits)[0].astype(np.int32))

    heads = ids.groupBy(range_of("doc_id").alias("part")).agg(F.max("doc_id").alias("head")).collect()
    return splits, {r["part"]: r["head"] for r in heads}


def edited_fingerprints(docs: DataFrame, k: int = K, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint (binary), near_edited, near_next.

    Rows follow each other by descending id (null ids last, equal ids by the hash of their text); the row
    after the last is the first. Each range of ids is one partition, read as a stream with one row
    of look-ahead; the first row of a range is also sent to the range before it. Null texts
    count as empty; two empty sketches have likeness 1. An empty table gives no rows; a table of one
    row is its own next. Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    splits, heads = _ranges(slim.select("doc_id"), partitions)
    filled = sorted(heads)
    before = {part: filled[i - 1] for i, part in enumerate(filled)} if len(filled) > 1 else {}  # of the first range: the last

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        """The own range, and -1 - n where the id begins its range and is looked ahead at from range n."""
        own, known = _range(ids, splits)
        ahead = [p in before and i == heads[p] and not gone for p, i, gone in zip(own.tolist(), known.tolist(), ids.isna(), strict=True)]
        return pd.Series([[p, -1 - before[p]] if a else [p] for p, a in zip(own.tolist(), ahead, strict=True)], dtype=object)

    place = F.col("place")
    dealt = slim.withColumn("place", F.explode(places("doc_id"))).select(
        "doc_id", "text", (place < 0).alias("ahead"), F.when(place < 0, -1 - place).otherwise(place).alias("part")
    )
    dealt = dealt.repartitionById(len(splits) + 1, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[str | None, str] | None = None  # the row that still lacks its next one
        start: str | None = None
        done = False

        def made(rows: list[tuple[str | None, str]], texts: list[str]) -> pd.DataFrame:
            """``texts``: those of the rows, then the text after the last of them."""
            edited = [edit_with(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
            own, other = sketches(texts, k), sketches(edited, k)
            return pd.DataFrame({
                "_id": [r[0] for r in rows], "n_chars": [len(t) for t in texts[:-1]], "edited_text": edited,
                "fingerprint": [to_bytes(s) for s in own[:-1]], "edited_fingerprint": [to_bytes(s) for s in other],
                "near_edited": [resemblance(a, b, k) for a, b in zip(own[:-1], other, strict=True)],
                "near_next": [resemblance(a, b, k) for a, b in zip(own[:-1], own[1:], strict=True)],
            })

        for frame in frames:
            rows: list[tuple[str | None, str]] = []
            size = 0
            for doc, text, ahead in zip(frame["_id"], frame["text"], frame["ahead"], strict=True):
                if done:  # of several rows with the id that begins the next range, the first one counts
                    break
                start = text if start is None else start
                if held is not None:
                    rows.append(held)
                    size += len(held[1])
                held = None if ahead else (doc if isinstance(doc, str) else None, text)
                done = bool(ahead)
                if rows and (done or size > 1 << 20):
                    yield made(rows, [r[1] for r in rows] + [text])
                    rows, size = [], 0
            if rows and held is not None:
                yield made(rows, [r[1] for r in rows] + [held[1]])
        if held is not None:  # one range is the whole table: its first row follows
            yield made([held], [held[1], start])

    named = ordered.select(F.col("doc_id").cast("string").alias("_id"), "text", "ahead")
    schema = "_id string, n_chars long, edited_text string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    out = named.mapInPandas(run, schema)
    return out.select(F.col("_id").cast("long").alias("doc_id"), *[c for c in out.columns if c != "_id"])


def digest(made: DataFrame) -> DataFrame:
    """The rows with the SHA-256 of the edited text in its place, and sketches as base64."""
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        F.base64("fingerprint").alias("fingerprint"), F.base64("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
