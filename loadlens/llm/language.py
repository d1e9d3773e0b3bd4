"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors,
each rotated by its place; a text is the sum of its n-grams, a language the sum of its (unit) texts.
A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm import text_kernels as kernels
from loadlens.llm.scratch import free_name, stored, warm

DIMENSIONS = 1024
NGRAM = 3
#: Letters share vectors beyond this many (code point modulo a prime); one more stands for the gap between words.
LETTERS = 1021
MAX_TRAIN = 20_000
#: Prototypes of about so many languages go to the tasks at once (4 KB each), and so many such blocks are scored in one job.
BLOCK, BLOCKS_AT_ONCE = 1000, 8
#: So many tasks' sums are added up at once.
TASKS_ADDED = 256
#: The least bar of a kept text: one standard deviation of the cosine of unrelated vectors.
MIN_SCORE = 0.031
#: The bar is this share of the score that all but ``BAR_QUANTILE`` of a language's held-out texts of such length reach.
BAR_SHARE, BAR_QUANTILE, BAR_LEAST_TEXTS = 0.5, 0.01, 50
#: Lengths are classed by powers of two, up to this one.
LENGTHS = 24
UNKNOWN = "und"
_UNIT = float(1 << 24)
_NO_LETTER = -2.0


@functools.lru_cache(maxsize=2)
def letter_vectors(dimensions: int = DIMENSIONS, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2, (LETTERS + 1, dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Letter class of each code point; the gap where it is no letter."""
    out = np.full(0x110000, LETTERS, np.int32)
    at = np.array([c for c in range(0x110000) if chr(c).isalpha()])
    out[at] = at % LETTERS
    return out


def gram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row per n-gram (rows of letter classes): rotated letter vectors, multiplied."""
    vectors = letter_vectors(dimensions)
    n = grams.shape[1]
    out = np.ones((len(grams), dimensions), np.int8)
    for k in range(n):
        out *= np.roll(vectors, n - 1 - k, axis=1)[grams[:, k]]
    return out.astype(np.float32)


def text_vectors(texts: list[str | None], dimensions: int = DIMENSIONS, n: int = NGRAM, width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (texts x dimensions) and whether the text has a letter. Runs of non-letters count as one gap;
    every text begins and ends with a gap."""
    lowered = ["" if t is None else t.lower() for t in texts]
    joined = "\n" + "\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 for t in lowered], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    classes = _letters()[points]
    owner = np.concatenate([[0], owner])
    gap = classes == LETTERS
    keep = ~(gap & np.concatenate([[False], gap[:-1]]))
    classes, owner = classes[keep], owner[keep]
    # the gap behind a text stays its last letter's neighbour and opens the next text
    has = np.bincount(owner[classes != LETTERS], minlength=len(texts)) > 0
    out = np.zeros((len(texts), dimensions), np.float32)
    used, compact = np.unique(classes, return_inverse=True)
    k = len(used)
    if len(classes) < n:
        return out, has
    codes = np.zeros(len(classes) - n + 1, np.int64)
    for i in range(n):
        codes = codes * k + compact[i : len(classes) - n + 1 + i]
    mine = owner[1 : len(classes) - n + 2] if n > 1 else owner  # a gram belongs to the text of its second letter
    # grams across the gap between two texts are no one's
    inner = compact == np.searchsorted(used, LETTERS)
    cross = np.zeros(len(codes), bool)
    for i in range(1, n - 1):
        cross |= inner[i : i + len(codes)] & (owner[i - 1 : i - 1 + len(codes)] != owner[i + 1 : i + 1 + len(codes)])
    codes, mine = codes[~cross], mine[~cross]
    if k**n <= 1 << 21:
        seen = np.bincount(codes, minlength=k**n) > 0
        distinct = np.flatnonzero(seen)
        place = (np.cumsum(seen) - 1)[codes]
    else:
        distinct, place = np.unique(codes, return_inverse=True)
    grams = np.stack([used[(distinct // k ** (n - 1 - i)) % k] for i in range(n)], axis=1)
    rows = 256
    for start in range(0, len(distinct), width):
        part = gram_vectors(grams[start : start + width], dimensions)
        inside = (place >= start) & (place < start + width) if len(distinct) > width else slice(None)
        who, what = mine[inside], place[inside] - start
        for low in range(0, len(texts), rows):
            high = min(len(texts), low + rows)
            a, b = np.searchsorted(who, [low, high])
            counts = np.bincount((who[a:b] - low) * len(part) + what[a:b], minlength=(high - low) * len(part))
            out[low:high] += counts.reshape(high - low, len(part)).astype(np.float32) @ part
    out[~has] = 0
    return out, has


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _added(rows: DataFrame, keys: list[str], dimensions: int) -> DataFrame:
    """Vectors (``total``, 64-bit whole numbers) added up by ``keys``, one sum in memory at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total = None, np.zeros(dimensions, np.int64)
        for frame in frames:
            for *key, part in frame[[*keys, "total"]].itertuples(index=False):
                if key != now:
                    if now is not None:
                        yield pd.DataFrame({**{k: [v] for k, v in zip(keys, now, strict=True)}, "total": [total.tobytes()]})
                    now, total = key, np.zeros(dimensions, np.int64)
                total = total + np.frombuffer(part, np.int64)
        if now is not None:
            yield pd.DataFrame({**{k: [v] for k, v in zip(keys, now, strict=True)}, "total": [total.tobytes()]})

    kinds = ", ".join(f"{k} {'string' if k == 'lang' else 'int'}" for k in keys)
    return rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInPandas(run, f"{kinds}, total binary")


@dataclass
class Languages:
    """Learnt prototypes: a stored table (lang, block, total), read a block at a time."""

    table: DataFrame | None
    blocks: int
    dimensions: int = DIMENSIONS

    def block(self, number: int) -> tuple[list[str], np.ndarray]:
        """Names in order and unit prototypes of a block."""
        rows = [] if self.table is None else self.table.where(F.col("block") == number).collect()  # about BLOCK rows
        by = {r["lang"]: np.frombuffer(r["total"], np.int64).astype(float) for r in rows}
        names = sorted(name for name, v in by.items() if v.any())
        return names, _unit(np.stack([by[n] for n in names])) if names else np.zeros((0, self.dimensions))


def train(
    docs: DataFrame, max_train: int = MAX_TRAIN, dimensions: int = DIMENSIONS, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", block: int = BLOCK
) -> Languages:
    """Unit prototypes of all languages, from at most about ``max_train`` texts of each, drawn by the hash of the id.

    Partial sums are whole numbers, so any order gives the same. There may be any number of languages: they are dealt to
    blocks of about ``block``, and only one block at a time comes to the driver.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    rows = rows.where("_lang is not null and _text is not null")
    sizes = stored(rows.groupBy("_lang").agg(F.count("*").alias("_n")), "language-sizes")
    number = sizes.count()
    if not number:
        return Languages(None, 0, dimensions)
    drawn = F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(1_000_000))
    share = F.floor(F.lit(float(max_train)) / F.col("_n") * 1_000_000)
    # a stored table of known size: Spark sends it to the tasks where that is small, and else splits hot languages
    chosen = rows.join(sizes, "_lang").where((F.col("_n") <= max_train) | (drawn < share)).select("_text", "_lang")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        salt = TaskContext.get().partitionId() // TASKS_ADDED
        sums: dict[str, np.ndarray] = {}

        def passed_on() -> pd.DataFrame:
            return pd.DataFrame({"lang": list(sums), "salt": salt, "total": [v.astype(np.int64).tobytes() for v in sums.values()]})

        for frame in frames:
            texts, langs = frame["_text"].tolist(), frame["_lang"].to_numpy()
            for start, end in kernels.batches(texts):
                vectors = np.rint(_unit(text_vectors(texts[start:end], dimensions)[0]).astype(float) * _UNIT)
                for lang in set(langs[start:end]):
                    sums[lang] = sums.get(lang, 0) + vectors[langs[start:end] == lang].sum(axis=0)
                if len(sums) > BLOCK:
                    yield passed_on()
                    sums.clear()
        if sums:
            yield passed_on()

    partial = chosen.mapInPandas(run, "lang string, salt int, total binary")
    total = _added(_added(partial, ["lang", "salt"], dimensions), ["lang"], dimensions)
    blocks = -(-number // block)
    return Languages(stored(total.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(blocks)).cast("int")), "languages"), blocks, dimensions)


def length_class(text: str | None) -> int:
    return min(LENGTHS - 1, len(text or "").bit_length())


def _in_block(names: list[str], prototypes: np.ndarray, bars: np.ndarray | None):
    """A column function: text -> (less, lang_pred, bar): ``less`` is the negative of the largest cosine of the block, 2
    for a text without a letter; the first name of equal ones. Texts of any length are read whole."""
    matrix = prototypes.astype(np.float32)

    @F.pandas_udf("less double, lang_pred string, bar double")
    def language(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        warm()
        for series in frames:
            texts = [t if isinstance(t, str) else None for t in series.tolist()]
            pred, less, bar = [], [], []
            for start, end in kernels.batches(texts):
                part = texts[start:end]
                if not names:
                    pred, less, bar = pred + [UNKNOWN] * len(part), less + [-_NO_LETTER] * len(part), bar + [0.0] * len(part)
                    continue
                vectors, has = text_vectors(part, matrix.shape[1])
                cosines = np.round(_unit(vectors) @ matrix.T, 6)
                best = cosines.argmax(axis=1)
                pred += [names[b] if ok else UNKNOWN for b, ok in zip(best, has, strict=True)]
                less += list(-np.where(has, cosines.max(axis=1), _NO_LETTER).astype(float))
                bar += [0.0] * len(part) if bars is None else [float(bars[b, length_class(t)]) for b, t in zip(best, part, strict=True)]
            yield pd.DataFrame({"less": pd.Series(less, dtype=float), "lang_pred": pd.Series(pred, dtype=object), "bar": pd.Series(bar, dtype=float)})

    return language


def predict(docs: DataFrame, languages: Languages, text_col: str = "text", out: str = "_l", bars: dict[str | None, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with ``out``: struct(lang_pred, score, bar), the score being the cosine, cut at 0.

    Null texts and texts without a letter, and all texts if no language was learnt, are ``und`` with score 0. Ties go to
    the first name. Every block of languages is scored; beyond ``BLOCKS_AT_ONCE`` blocks the best so far is written in between.
    """
    text = F.col(text_col).cast("string")
    best = None
    for start in range(0, max(1, languages.blocks), BLOCKS_AT_ONCE):
        if start:
            docs, best = stored(docs.withColumn(out, best), "language-scores"), F.col(out)
        scored = []
        for number in range(start, min(max(1, languages.blocks), start + BLOCKS_AT_ONCE)):
            names, prototypes = languages.block(number)
            table = None if bars is None else np.stack([bars.get(n, bars[None]) for n in names]) if names else None
            scored.append(_in_block(names, prototypes, table)(text))
        best = F.least(*([best] if best is not None else []), *scored) if len(scored) + (best is not None) > 1 else scored[0]
    found = docs.withColumn(out, best)
    und = (F.col(f"{out}.less") >= -_NO_LETTER) | (F.col(f"{out}.lang_pred") == UNKNOWN)
    score = F.when(und, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), -F.col(f"{out}.less"))))
    return found.withColumn(out, F.struct(F.when(und, UNKNOWN).otherwise(F.col(f"{out}.lang_pred")).alias("lang_pred"), score.alias("score"), F.col(f"{out}.bar").alias("bar")))


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, max_train: int = MAX_TRAIN, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learns from rows with a language that are not held out.

    Rows with a null id count as not held out. See ``predict`` for nulls and empty texts; an empty table gives no rows,
    repeated rows are judged alike, other columns are ignored. Any number of languages is learnt.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    judged = predict(slim, train(docs.where(~held_out()), max_train, block=block))
    return judged.select("doc_id", held_out().alias("held_out"), "_l.lang_pred", "_l.score")


def held_out_bars(docs: DataFrame, languages: Languages) -> dict[str | None, np.ndarray]:
    """Bar of each language and length class, from the scores of held-out texts of that language that were known as such.

    ``BAR_SHARE`` of the score that all but ``BAR_QUANTILE`` of them reach; where a language has too few of a length, the
    same of all languages together (key None), and where these are too few as well, that of the length below.
    """
    held = docs.where(held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen = predict(held.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")), languages)
    size = F.least(F.lit(LENGTHS - 1), F.when(F.length("text") > 0, F.length(F.bin(F.length("text")))).otherwise(0))
    # no filter on the prediction: pushed below it, the filter would predict once more
    rows = seen.select("lang", size.alias("size"), F.when(F.col("lang") == F.col("_l.lang_pred"), F.col("_l.score")).alias("score"))
    per = rows.groupingSets([["lang", "size"], ["size"]], "lang", "size").agg(F.count("score").alias("n"), F.percentile_approx("score", BAR_QUANTILE, 10_000).alias("score"))
    bars: dict[str | None, np.ndarray] = {None: np.zeros(LENGTHS)}
    found = per.where(F.col("n") >= BAR_LEAST_TEXTS).collect()  # at most LENGTHS rows per language with enough held-out texts
    for r in sorted(found, key=lambda r: r["lang"] is not None):
        if r["lang"] not in bars:
            bars[r["lang"]] = bars[None].copy()
        bars[r["lang"]][r["size"]] = BAR_SHARE * r["score"]
    for bar in bars.values():
        for size in range(1, LENGTHS):  # longer texts score higher
            bar[size] = bar[size] or bar[size - 1]
    return bars


def _judged(docs: DataFrame, max_train: int) -> tuple[DataFrame, str, Column]:
    """(``docs`` with one more column, its name, whether the row is kept)."""
    languages, out = train(docs.where(~held_out()), max_train), free_name(docs, "_l")
    seen = predict(docs, languages, out=out, bars=held_out_bars(docs, languages) if languages.blocks else None)
    known = (F.col(f"{out}.lang_pred") != UNKNOWN) & (F.col(f"{out}.score") >= F.greatest(F.col(f"{out}.bar"), F.lit(MIN_SCORE)))
    return seen, out, known


def keep_known(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not ``und``, and a cosine that reaches the bar of that
    language and length (see ``held_out_bars``), ``MIN_SCORE`` at least.

    If there is no language to learn, the rows whose text has a letter. Null, empty and blank texts go; repeated rows stay
    or go together; an empty table gives no rows.
    """
    if docs.where("lang is not null and text is not null").isEmpty():
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    seen, _, known = _judged(docs, max_train)
    return seen.where(known).select(docs.columns)


def known_report(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """What ``keep_known`` does to ``docs``: per predicted language the rows, those below the bar, and the smallest and mean score."""
    seen, out, known = _judged(docs, max_train)
    return seen.groupBy(F.col(f"{out}.lang_pred").alias("lang_pred")).agg(
        F.count("*").alias("rows"), F.count_if(~known).alias("dropped"), F.min(f"{out}.score").alias("least_score"), F.avg(f"{out}.score").alias("mean_score"),
    )
