"""Document quality: random Fourier features over text statistics, ridge from partition-summed
normal equations, isotonic calibration.

Statistics of a whole text are computed once and stored; training and scoring read that small
table. The normal equations (a square matrix of the number of features) are summed per partition of
the bounded training sample and then on the driver; calibration needs counts per score bin only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import text_kernels as kernels
from loadlens.llm.scratch import stored, warm

#: Fixed byte groups whose shares are features.
GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "blank": b" \t\r",
    "line": b"\n", "stop": b".,;:", "shout": b"!?", "bar": b"|_", "symbol": b"#$%&*+=@^~<>{}[]\\/", "quote": b"\"'()-`",
}
STATISTICS = [
    "log_bytes", *GROUPS, "high", "other", "log_words", "word_length", "word_spread", "long_words", "one_letter",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "log_lines", "distinct_lines", "top_line", "empty",
]
FEATURES = 384
RIDGE = 1e-3
BINS = 512
MAX_TRAIN = 200_000
TRAIN_PARTS = 16
THRESHOLD = 0.3


def _share_of_most(values: np.ndarray) -> tuple[float, float]:
    """Distinct values per value, and the share of the most frequent one."""
    if not len(values):
        return 1.0, 0.0
    counts = np.unique(values, return_counts=True)[1]
    return len(counts) / len(values), counts.max() / len(values)


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` per text; null counts as empty."""
    raw = kernels.encode(texts)
    words = kernels.split_words(raw)
    plain = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    n = len(raw)
    group_of = np.full(256, len(GROUPS) + 1, np.int64)
    group_of[128:] = len(GROUPS)
    for k, members in enumerate(GROUPS.values()):
        group_of[list(members)] = k
    size = np.array([len(r) for r in raw], np.int64)
    owner = np.repeat(np.arange(n), size + 1)
    width = len(GROUPS) + 2
    shares = np.bincount(owner * width + group_of[plain], minlength=n * width).reshape(n, width).astype(float)
    shares[:, list(GROUPS).index("blank")] -= 1  # the blank laid between texts
    shares /= np.maximum(size, 1)[:, None]
    out = np.zeros((n, len(STATISTICS)))
    out[:, 0] = np.log1p(size)
    out[:, 1 : 1 + width] = shares
    lengths = words.ends - words.starts
    with np.errstate(over="ignore"):
        pairs = kernels.mix(words.hashes[:-1] * kernels.WORD_BASE + words.hashes[1:]) if len(words.hashes) else words.hashes
    at = 1 + width
    for i in range(n):
        a, b = words.bounds[i], words.bounds[i + 1]
        length, h = lengths[a:b], words.hashes[a:b]
        distinct, top = _share_of_most(h)
        lines = [x for x in raw[i].split(b"\n") if x.strip()]
        counts: dict[bytes, int] = {}
        for x in lines:
            counts[x] = counts.get(x, 0) + 1
        out[i, at:] = (
            np.log1p(b - a),
            length.mean() if b > a else 0, length.std() if b > a else 0,
            (length > 16).mean() if b > a else 0, (length == 1).mean() if b > a else 0,
            distinct, top, (h[1:] == h[:-1]).mean() if b - a > 1 else 0, _share_of_most(pairs[a : max(a, b - 1)])[0],
            np.log1p(len(lines)), len(counts) / len(lines) if lines else 1,
            max(counts.values()) / len(lines) if len(lines) > 1 else 0, float(b == a),
        )
    return out


@dataclass
class Model:
    """Everything a score needs: a few hundred numbers per feature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2.0 / self.weights.shape[1])
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def isotonic(centres: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over score bins: increasing shares of positives, one knot per bin."""
    blocks: list[list[float]] = []  # positives, count, bins
    for p, c in zip(positives, counts, strict=True):
        blocks.append([float(p), float(c), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return centres, np.concatenate([np.full(n, p / c) for p, c, n in ((b[0], b[1], int(b[2])) for b in blocks)])


def _stack(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["stats"].to_numpy()).astype(float) if len(frame) else np.zeros((0, len(STATISTICS)))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_train: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, stats) of labelled rows that are not held out, at most about ``max_train`` ids.

    Several labels of one id are averaged and cut at one half; null labels and ids are ignored. The
    drawn ids and labels (twelve bytes each, ``max_train`` of them) are broadcast to the scan.
    """
    known = labels.where(F.col(label_col).isNotNull() & ~held_out() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("label")
    )
    share = min(1.0, max_train / max(known.count(), 1))
    drawn = known.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        for frame in frames:
            texts = _texts(frame["_text"])
            for start, end in kernels.batches(texts):
                table = statistics(texts[start:end]).astype(np.float32)
                yield frame[["doc_id", "label"]].iloc[start:end].assign(stats=list(table))

    return slim.join(F.broadcast(drawn), "doc_id").mapInPandas(run, "doc_id long, label int, stats array<float>")


def _texts(series: pd.Series) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in series.tolist()]


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> Model | None:
    """Model from (doc_id, stats, label 0/1); None unless both labels occur.

    Three quarters of the rows fit the ridge, one quarter the calibration, by the hash of the id.
    """
    rows = rows.withColumn("calibrate", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) == 0)
    rows = stored(rows.repartition(TRAIN_PARTS, "doc_id"), "quality-train")
    total = rows.groupBy("label").count().collect()  # two rows
    if {r["label"] for r in total} != {0, 1}:
        return None
    fitting = rows.where("not calibrate")
    moments = fitting.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
        F.avg(F.col("x").cast("double")).alias("m"), F.stddev_pop(F.col("x").cast("double")).alias("s")
    ).orderBy("i").collect()  # one row per statistic
    mean, scale = np.array([r["m"] for r in moments]), np.array([max(r["s"], 1e-6) for r in moments])
    rng = np.random.default_rng(seed)
    d = len(mean)
    model = Model(
        mean, scale, rng.normal(0, 1 / np.sqrt(d) * 1.5, (d, features)), rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.zeros(1), np.zeros(1),
    )

    def normal_equations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        size = features + 1
        gram, right, n = np.zeros((size, size)), np.zeros(size), 0
        for frame in frames:
            z, y = model.features(_stack(frame)), frame["label"].to_numpy(float)
            gram += z.T @ z
            right += z.T @ y
            n += len(frame)
        yield pd.DataFrame({"first": [float(gram[0, 0])], "n": [n], "gram": [gram.tobytes()], "right": [right.tobytes()]})

    parts = fitting.mapInPandas(normal_equations, "first double, n long, gram binary, right binary").collect()
    parts.sort(key=lambda r: (r["first"], r["n"]))  # the same sum in every run; at most one row per training partition
    gram = sum(np.frombuffer(r["gram"]).reshape(features + 1, -1) for r in parts)
    right = sum(np.frombuffer(r["right"]) for r in parts)
    n = sum(r["n"] for r in parts)
    model.beta = np.linalg.solve(gram + ridge * max(n, 1) / features * np.eye(features + 1), right)

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.clip(((model.raw(_stack(frame)) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            yield pd.DataFrame({"bin": at, "label": frame["label"].to_numpy()})

    bins = rows.where("calibrate").mapInPandas(binned, "bin int, label int").groupBy("bin").agg(
        F.sum("label").alias("p"), F.count("*").alias("c")
    ).orderBy("bin").collect()  # at most BINS rows
    if not bins:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    centres = np.array([(r["bin"] + 0.5) / BINS * 2 - 0.5 for r in bins])
    model.knots, model.values = isotonic(centres, np.array([r["p"] for r in bins]), np.array([r["c"] for r in bins]))
    return model


def held_out(id_col: str = "doc_id", modulus: int = 5, rest: int = 0):
    """True where crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulus)) == rest, F.lit(False))


def score_of(model: Model | None):
    """A column function: text -> score. Without a model every text has score 1."""

    @F.pandas_udf("double")
    def score(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        warm()
        for series in frames:
            texts = _texts(series)
            if model is None:
                yield pd.Series(np.ones(len(texts)))
                continue
            parts = [model.score(statistics(texts[a:b])) for a, b in kernels.batches(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_train: int = MAX_TRAIN) -> Model | None:
    return fit(training_rows(docs, labels, label_col, max_train))


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Learns from rows of ``labels`` that are not held out, ``max_train`` at most. Null, empty and very
    long texts are scored like all others; without labels of both kinds the score is 1. Other columns
    are ignored, an empty table gives no rows, repeated rows are scored alike, a null id is not held out.
    """
    score = score_of(train(docs, labels, label_col, max_train))
    scored = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``.

    Null, empty and very long texts are scored like all others; without labels of both kinds every row stays; repeated rows
    stay or go together; an empty table gives no rows. A null id has no label and is scored.
    """
    return docs.where(score_of(train(docs, labels, label_col, max_train))(F.col("text").cast("string")) >= threshold)
