"""Collocations by prefix-free parsing.

A text's words (and marks where a piece ends) are cut wherever the hash of two neighbouring words says so, so
equal passages are cut alike wherever they stand. A chunk reaches ``OVERLAP`` words into the next one. The
distinct chunks and how often each occurs form a dictionary, and phrases are counted inside distinct chunks,
weighted by these numbers: a copied passage costs once. A phrase belongs to the chunk it begins in, and those
that begin in the overlap belong to the next chunk, so every occurrence counts once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.scratch import join_apart, stored, warm

LONGEST = 3
OVERLAP = LONGEST - 1
#: A chunk begins where the hash of two words is 0 modulo this, and after so many words at the latest.
PERIOD, MOST = 32, 256
LEAST, TOP, INSIDE_PERCENT = 10, 2000, 50
UNKNOWN = "und"
#: So many tasks' bucket counts are added up at once.
TASKS_ADDED = 256
END = b"\n"

class Sizes(NamedTuple):
    """What a task holds, and the table of buckets that goes to every task: 8 MB, whatever the number of phrases."""

    buckets: int = 26  # bits of a bucket's number
    in_range: int = 14  # of these, bits inside a range, which is a row; at most 16
    words: int = 1 << 20  # whose counts are held before they go on
    chunks: int = 60_000  # of a task's part of the dictionary
    vocabulary: int = 250_000


# Marks that end a piece (also line feeds to carriage returns), A-Z to lower case, tab to blank.
_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text: str) -> list[bytes]:
    """Words in UTF-8, and ``END`` where a piece ends. Only A-Z are lower-cased."""
    data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    return [w for w in data.replace(b"\n", b" \n ").split(b" ") if w]


class _Vocabulary(dict):
    """Codes in order of appearance (0 is ``END``), with a hash of each word."""

    def __init__(self):
        super().__init__({END: 0})
        self.words, self.hashes = [END], [zlib.crc32(END)]

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words)
        self.words.append(word)
        self.hashes.append(zlib.crc32(word))
        return code


def chunk_starts(hashes: np.ndarray, opens: np.ndarray, period: int = PERIOD, most: int = MOST) -> np.ndarray:
    """Positions where a chunk begins: texts (``opens``, sorted), triggers, and every ``most`` words after the last of them."""
    with np.errstate(over="ignore"):
        pair = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    pair ^= pair >> np.uint64(29)
    starts = np.union1d(np.flatnonzero(pair % np.uint64(period) == 0), opens)
    gaps = np.diff(np.append(starts, len(hashes)))
    extra = (gaps - 1) // most
    if extra.any():
        at = np.repeat(starts, extra)
        nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        starts = np.union1d(starts, at + nth * most)
    return starts


def parse(texts: list[list[bytes]], vocabulary: _Vocabulary, period: int = PERIOD, most: int = MOST) -> Iterator[tuple[int, bytes]]:
    """(text, chunk) of every chunk, a chunk being its 32-bit codes. ``OVERLAP`` marks close each text, as its last overlap."""
    flat, bounds = [], [0]
    for words in texts:
        flat += map(vocabulary.__getitem__, words)
        flat += [0] * OVERLAP
        bounds.append(len(flat))
    codes = np.array(flat, np.uint32)
    hashes = np.array(vocabulary.hashes, np.uint64)[codes]
    bounds = np.array(bounds)
    opens, closes = bounds[:-1], bounds[1:]
    starts = chunk_starts(hashes, opens, period, most)
    owner = np.searchsorted(opens, starts, side="right") - 1
    inner = starts < closes[owner] - OVERLAP  # what begins in the closing marks holds nothing
    starts, owner = starts[inner], owner[inner]
    if not len(starts):
        return
    following = np.append(starts[1:], len(codes))
    ends = np.where(np.append(owner[1:], -1) == owner, following + OVERLAP, closes[owner])
    buffer = codes.tobytes()
    for text, a, b in zip(owner.tolist(), (4 * starts).tolist(), (4 * np.minimum(ends, closes[owner])).tolist(), strict=True):
        yield text, buffer[a:b]


def parsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, period: int = PERIOD, most: int = MOST, sizes: Sizes = Sizes()) -> DataFrame:
    """Rows of two kinds, from one reading of the texts: (lang, chunk, n) with chunks as words joined by blanks, and
    (range, salt, at, counts) with the capped bucket counts of the phrases in these chunks. Both are parts, to be added up."""
    cap = min(least, 255)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        salt = TaskContext.get().partitionId() // TASKS_ADDED
        vocabulary, counts = _Vocabulary(), {}

        def passed_on() -> Iterator[pd.DataFrame]:
            words, hashes = vocabulary.words, np.array(vocabulary.hashes, np.uint64)
            for lang, found in counts.items():
                chunks, n = list(found), np.fromiter(found.values(), np.int64, len(found))
                for low in range(0, len(chunks), 20_000):
                    part, weights = chunks[low : low + 20_000], n[low : low + 20_000]
                    lines = [b" ".join(map(words.__getitem__, memoryview(c).cast("I"))).decode("utf-8", "surrogatepass") for c in part]
                    yield pd.DataFrame({"lang": lang, "chunk": lines, "n": weights, "range": 0, "salt": 0, "at": None, "counts": None})
                    codes = np.frombuffer(b"".join(part), np.uint32).astype(np.int64)
                    weight = _begin(codes, np.fromiter(map(len, part), np.int64, len(part)) // 4, weights)
                    places = [_places(codes, hashes[codes], weight, k, np.uint64(_lang_hash(lang)), sizes.buckets) for k in range(1, LONGEST + 1)]
                    rows = _bucket_rows(np.concatenate([f[1] for f in places]), np.concatenate([weight[f[0]] for f in places]), cap, sizes.in_range)
                    yield rows.assign(lang=None, chunk=None, n=0, salt=salt)[["lang", "chunk", "n", "range", "salt", "at", "counts"]]

        for frame in frames:
            texts, langs = frame["_text"].tolist(), frame["_lang"].tolist()
            at = 0
            while at < len(texts):
                batch, size, start = [], 0, at
                while at < len(texts) and (not batch or size < 1 << 18):
                    words = tokens(texts[at]) if texts[at] else []
                    batch.append(words)
                    size += len(words)
                    at += 1
                for text, chunk in parse(batch, vocabulary, period, most):
                    mine = counts.setdefault(langs[start + text], {})
                    mine[chunk] = mine.get(chunk, 0) + 1
                if len(vocabulary) > sizes.vocabulary or sum(map(len, counts.values())) > sizes.chunks:
                    yield from passed_on()
                    vocabulary, counts = _Vocabulary(), {}
        yield from passed_on()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("_lang")
    slim = docs.select(F.col(text_col).cast("string").alias("_text"), lang)
    return slim.mapInPandas(run, "lang string, chunk string, n long, range int, salt int, at binary, counts binary")


def dictionary(parts: DataFrame) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of each language, and how often each occurs."""
    return parts.where("chunk is not null").groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _lang_hash(lang: str) -> int:
    return zlib.crc32(lang.encode("utf-8", "surrogatepass"))


def _begin(codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of a phrase that begins at a place: that of its chunk, 0 in the chunk's overlap and at marks."""
    last = np.repeat(np.cumsum(sizes) - OVERLAP, sizes)
    return np.where((np.arange(len(codes)) < last) & (codes > 0), np.repeat(weights, sizes), 0)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the exact sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


class _Held:
    """Chunks of several languages as one run of codes (0 is the end of a piece), until there are enough words.

    Codes are given per language and word from one count, so that phrases of two languages never meet.
    """

    def __init__(self):
        self.names, self.langs, self.hashes, self.seeds, self.by = ["\n"], [""], [0], [0], {}
        self.codes, self.sizes, self.weights, self.count = [], [], [], 0

    def _words(self, lang: str) -> dict:
        held, seed = self, _lang_hash(lang)

        class Words(dict):
            def __missing__(self, word: str) -> int:
                self[word] = code = len(held.names)
                held.names.append(word)
                held.langs.append(lang)
                held.hashes.append(zlib.crc32(word.encode("utf-8", "surrogatepass")))
                held.seeds.append(seed)
                return code

        return Words({"\n": 0})

    def add(self, lang: str, chunks: list[str], weights: np.ndarray) -> None:
        if lang not in self.by:
            self.by[lang] = self._words(lang)
        flat = " ".join(chunks).split(" ")
        self.codes.append(np.fromiter(map(self.by[lang].__getitem__, flat), np.int64, len(flat)))
        self.sizes.append(np.fromiter((c.count(" ") + 1 for c in chunks), np.int64, len(chunks)))
        self.weights.append(weights)
        self.count += len(flat)

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes, hashes of words, hashes of their languages, weight of a phrase that begins there)."""
        codes = np.concatenate(self.codes)
        hashes, seeds = (np.array(x, np.uint64)[codes] for x in (self.hashes, self.seeds))
        return codes, hashes, seeds, _begin(codes, np.concatenate(self.sizes), np.concatenate(self.weights))


def _held(frames: Iterator[pd.DataFrame], most: int) -> Iterator[_Held]:
    held = _Held()
    for frame in frames:
        for lang, part in frame.groupby("lang", sort=False):
            held.add(lang, part["chunk"].tolist(), part["n"].to_numpy(np.int64))
        if held.count >= most:
            yield held
            held = _Held()
    if held.count:
        yield held


def _places(codes: np.ndarray, hashes: np.ndarray, weight: np.ndarray, k: int, seeds, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, buckets) of the phrases of k words that begin where there is a weight."""
    width = max(0, len(codes) - k + 1)
    good = weight[:width] > 0
    key = np.full(width, k, np.uint64) + (seeds if np.ndim(seeds) == 0 else seeds[:width])
    with np.errstate(over="ignore"):
        for i in range(k):
            good &= codes[i : i + width] > 0
            key = (key ^ hashes[i : i + width]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
    at = np.flatnonzero(good)
    return at, (key[at] >> np.uint64(64 - bits)).astype(np.int64)


def _planes(numbers: np.ndarray) -> bytes:
    """16-bit numbers as their low bytes, then their high bytes: sorted ones compress well that way."""
    return numbers.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def _bucket_rows(buckets: np.ndarray, weights: np.ndarray, cap: int, in_range: int) -> pd.DataFrame:
    """(range, at, counts): per range of buckets the places in it and their counts, which stop at ``cap``."""
    keys, n = _summed(buckets, weights)
    ranges, starts = np.unique(keys >> in_range, return_index=True)
    inside, capped = keys & ((1 << in_range) - 1), np.minimum(n, cap).astype(np.uint8)
    ends = np.append(starts[1:], len(keys))[: len(starts)]
    return pd.DataFrame({
        "range": ranges, "at": [_planes(inside[a:b]) for a, b in zip(starts, ends, strict=True)],
        "counts": [capped[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
    })


def frequent_buckets(parts: DataFrame, least: int = LEAST, sizes: Sizes = Sizes()) -> bytes:
    """A bit per bucket of phrase hashes: set where all phrases of the bucket together occur ``least`` times.

    A phrase whose bit is not set is rarer than that; one whose bit is set may be. The table has 2**sizes.buckets bits
    whatever the number of phrases. Counts are added up per range of buckets and group of tasks, then per range;
    no row holds more than a range.
    """
    size, cap = 1 << sizes.in_range, min(least, 255)

    def add_up(frames: Iterator[pd.DataFrame], columns: list[str], whole: bool) -> Iterator[pd.DataFrame]:
        now, total = None, np.zeros(size, np.int64)

        def done() -> pd.DataFrame:
            out = {c: [v] for c, v in zip(columns, now, strict=True)}
            if whole:
                return pd.DataFrame({**out, "bits": [np.packbits(total >= cap, bitorder="little").tobytes()]})
            at = np.flatnonzero(total)
            return pd.DataFrame({**out, "at": [_planes(at)], "counts": [np.minimum(total[at], cap).astype(np.uint8).tobytes()]})

        for frame in frames:
            for *key, at, n in frame[[*columns, "at", "counts"]].itertuples(index=False):
                if key != now:
                    if now is not None:
                        yield done()
                    now, total = key, np.zeros(size, np.int64)
                places = np.frombuffer(at, np.uint8).reshape(2, -1).astype(np.int64)
                total[places[0] + (places[1] << 8)] += np.frombuffer(n, np.uint8)
        if now is not None:
            yield done()

    rows = parts.where("chunk is null").select("range", "salt", "at", "counts")
    partly = rows.repartition(F.col("range"), F.col("salt")).sortWithinPartitions("range", "salt").mapInPandas(
        lambda frames: add_up(frames, ["range", "salt"], False), "range int, salt int, at binary, counts binary"
    )
    whole = partly.repartition(F.col("range")).sortWithinPartitions("range").mapInPandas(lambda frames: add_up(frames, ["range"], True), "range int, bits binary")
    table = np.zeros(1 << (sizes.buckets - 3), np.uint8)
    for r in whole.collect():  # 2**sizes.buckets bits
        table[r["range"] * size // 8 : (r["range"] + 1) * size // 8] = np.frombuffer(r["bits"], np.uint8)
    return table.tobytes()


def phrase_counts(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang", sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of all phrases of 1 to 3 words with f >= ``least``, (lang, n) with the number of all words).

    Phrases that a table of bucket counts shows to be rarer are not counted one by one; the counts of the others are exact.
    """
    parts = stored(parsed(docs, text_col, lang_col, least, sizes=sizes), "phrase-parts")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_buckets(parts, least, sizes))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        bits = np.frombuffer(shared.value, np.uint8)
        for held in _held(frames, sizes.words):
            codes, hashes, seeds, weight = held.done()
            names, langs, total = np.array(held.names, object), np.array(held.langs, object), len(held.names)
            lang_codes, n = _summed(codes[weight > 0], weight[weight > 0])
            words = pd.DataFrame({"lang": langs[lang_codes], "n": n}).groupby("lang", as_index=False)["n"].sum()
            yield words.assign(phrase="", k=0)[["lang", "phrase", "k", "n"]]
            here, before = codes > 0, None  # in the overlap too, where no phrase of its own begins
            for k in range(1, LONGEST + 1):
                at, bucket = _places(codes, hashes, here, k, seeds, sizes.buckets)
                often = (bits[bucket >> 3] >> (bucket & 7)) & 1 > 0
                if before is not None:  # both phrases of one word less
                    often &= before[at] & before[at + 1]
                before = np.zeros(len(codes) + 1, bool)
                before[at[often]] = True
                at = at[often & (weight[at] > 0)]
                key = np.zeros(len(at), np.int64)
                for i in range(k):
                    key = key * total + codes[at + i]
                keys, n = _summed(key, weight[at])
                for low in range(0, len(keys), 20_000):
                    some = keys[low : low + 20_000]
                    places = [some // total ** (k - 1 - i) % total for i in range(k)]
                    phrase = names[places[0]]
                    for place in places[1:]:
                        phrase = phrase + " " + names[place]
                    yield pd.DataFrame({"lang": langs[places[0]], "phrase": phrase, "k": k, "n": n[low : low + 20_000]})

    rows = dictionary(parts).mapInPandas(run, "lang string, phrase string, k int, n long")
    counts = stored(rows.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "phrase-counts")
    return counts.where("k > 0"), counts.where("k = 0").select("lang", F.col("f").alias("n"))


def _key(phrase: Column, lang: Column) -> Column:
    """One text per language and phrase; no phrase has a line feed."""
    return F.concat(phrase, F.lit("\n"), lang)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits."""
    product = lambda x, y: f"cast(cast({x} as decimal(19,0)) * cast({y} as decimal(19,0)) as decimal(38,0))"
    return F.expr(f"cast({product(a, a)} * 1000000BD as decimal(38,0)) div {product(left, right)}")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside_percent: int = INSIDE_PERCENT, text_col: str = "text", lang_col: str = "lang", sizes: Sizes = Sizes()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 or 3 words.

    A phrase occurs ``a`` >= ``least`` times; cut after its first word or words it has l = f(first part), r = f(rest)
    and the score floor(1000000 a a / (l r)); the lowest cut counts, the first of equal ones. A phrase inside a longer
    one with f(longer) >= ``inside_percent`` % of a is left out. Null languages are ``und``; null, empty and blank texts
    hold no words; an empty table gives no rows; repeated rows count each; other columns are ignored.
    """
    counts, totals = phrase_counts(docs, least, text_col, lang_col, sizes)
    words = F.split("phrase", " ")
    found = counts.where("k > 1").withColumn("w", words)
    join = lambda low, n: F.array_join(F.slice("w", low, n), " ")
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", _key(join(F.lit(1), F.col("cut")), F.col("lang")).alias("first"),
        _key(join(F.col("cut") + 1, F.col("k") - F.col("cut")), F.col("lang")).alias("rest"),
    )
    keyed = counts.select(_key(F.col("phrase"), F.col("lang")).alias("key"), "f")
    cuts = join_apart(cuts, keyed.select(F.col("key").alias("first"), F.col("f").alias("l")), "first")
    cuts = join_apart(cuts, keyed.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    scored = cuts.select("lang", "phrase", "a", "cut", "l", "r", _score("a", "l", "r").cast("long").alias("score"))
    best = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "cut")).alias("b")).select("lang", "phrase", "b.*")
    parts = found.where("k = 3").select("lang", "f", F.explode(F.array(join(F.lit(1), F.lit(2)), join(F.lit(2), F.lit(2)))).alias("phrase"))
    covers = parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside_percent) * F.col("a")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First per part of a language, then per language: no task gets more than its parts' first rows.
    apart = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = kept.withColumn("part", apart).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = few.drop("part", "place").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
