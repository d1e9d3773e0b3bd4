"""SentencePiece encoding and decoding in batches, with numpy.

A batch is cut into words (a run of space marks and what follows); its different words are
grouped by length and advance together. Hashes of all their substrings probe the sorted hashes of the
pieces. For unigram models a Viterbi pass keeps, for every end, the best start (vectorised maxima,
back-pointers). A byte-pair model is not defined by a best sum but by its merges: there the adjacent
pair of the best piece is joined, again for all words at once, until none is left.
"""

from __future__ import annotations

import codecs
import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import text_kernels as kernels
from loadlens.llm.scratch import warm

MARK = "▁"
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
#: Unknown characters score this much below the worst piece (fixed value of the model family).
UNKNOWN_PENALTY = 10.0
LONG_WORD = 64
CACHED_WORDS = 400_000
#: Characters handled at once: new words of many texts advance together.
STRETCH = 2 << 20
U64 = np.uint64

codecs.register_error("each_byte", lambda error: ("�" * (error.end - error.start), error.end))


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    types: np.ndarray
    kind: int
    dummy_prefix: bool
    byte_fallback: bool
    unknown: int
    unknown_text: str
    keys: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    sieve: np.ndarray = field(init=False)
    longest: int = field(init=False)
    bytes_at: np.ndarray = field(init=False)

    def __post_init__(self):
        normal = np.flatnonzero(self.types == _NORMAL)
        text = [self.pieces[i] for i in normal]
        self.longest = max(map(len, text))
        points, starts = _points(text)
        ends = np.append(starts[1:], len(points))
        keys = kernels.hash_spans(points, starts, ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], normal[order].astype(np.int32)
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self.keys >> U64(42)] = True
        self.bytes_at = np.full(256, self.unknown, np.int32)
        for i in np.flatnonzero(self.types == _BYTE):
            self.bytes_at[int(self.pieces[i][1:-1], 16)] = i
        #: Words can be treated one by one unless a piece runs from a character into a mark.
        self.by_word = not any(MARK in p.lstrip(MARK) for p in text)
        self.index = {p: int(i) for p, i in zip(text, normal, strict=True)}
        surface = [p.replace(MARK, " ").encode() if t == _NORMAL else b"" for p, t in zip(self.pieces, self.types, strict=True)]
        for i in np.flatnonzero(self.types == _BYTE):
            surface[i] = bytes([int(self.pieces[i][1:-1], 16)])
        surface[self.unknown] = self.unknown_text.encode()
        self.surface = surface
        self.cache = _Cache()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece id of each hash, -1 where it is no piece."""
        out = np.full(len(hashes), -1, np.int32)
        maybe = np.flatnonzero(self.sieve[hashes >> U64(42)])
        if len(maybe):
            at = np.searchsorted(self.keys, hashes[maybe])
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == hashes[maybe]
            out[maybe[hit]] = self.ids[at[hit]]
        return out


@functools.lru_cache(maxsize=2)
def load(path: str, kind: int | None = None) -> Model:
    """A model file (a path as executors see it, or a file name of the public tokenizers). ``kind`` overrides its type."""
    import os

    import public_tokenizers

    with open(path if os.path.exists(path) else public_tokenizers.path(path), "rb") as data:
        return parse(data.read(), kind)


def parse(data: bytes, kind: int | None = None) -> Model:
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(data)
    types = np.array([p.type for p in model.pieces])
    rule = model.normalizer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
        raise ValueError("only models with identity normalisation are read")
    if not set(types) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("models with user-defined or unused pieces are not read")
    if (kind or model.trainer_spec.model_type) not in (UNIGRAM, BPE):
        raise ValueError("only unigram and byte-pair models are read")
    return Model(
        [p.piece for p in model.pieces], np.array([p.score for p in model.pieces], np.float32), types, kind or model.trainer_spec.model_type,
        rule.add_dummy_prefix, model.trainer_spec.byte_fallback, int(np.flatnonzero(types == _UNKNOWN)[0]), model.trainer_spec.unk_surface,
    )


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, end to end, and where each text starts."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum(sizes) - sizes


def _substring_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``text_kernels.hash_spans``, for any substrings of a stretch with the given running sums."""
    with np.errstate(over="ignore"):
        return kernels.mix(kernels.substring_sums(prefix, starts, ends) + (ends - starts).astype(U64) * kernels.WORD_BASE)


def _probe(model: Model, prefix: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Piece ids (words x length x longest) of the substrings that start at each place, by their length - 1."""
    widest = min(length, model.longest)
    out = np.full((len(starts), length, widest), -1, np.int32)
    place = starts[:, None] + np.arange(length)
    for size in range(1, widest + 1):
        at = place[:, : length - size + 1]
        out[:, : length - size + 1, size - 1] = model.find(_substring_hash(prefix, at.ravel(), (at + size).ravel())).reshape(at.shape)
    return out


def viterbi(model: Model, found: np.ndarray) -> np.ndarray:
    """Ends of the pieces with the best sum of scores: (words x length), true behind a piece's last character.

    Of equal sums the longest last piece wins. A character that is no piece counts as unknown."""
    words, length, widest = found.shape
    least = model.scores[model.types == _NORMAL].min() - UNKNOWN_PENALTY
    score = np.where(found >= 0, model.scores[found], -np.inf).astype(np.float32)
    score[:, :, 0] = np.where(found[:, :, 0] >= 0, score[:, :, 0], least)
    best = np.full((words, length + 1), -np.inf, np.float32)
    best[:, 0] = 0
    back = np.zeros((words, length + 1), np.int32)
    for end in range(1, length + 1):
        sizes = np.arange(min(end, widest), 0, -1)
        sums = best[:, end - sizes] + score[:, end - sizes, sizes - 1]
        choice = sums.argmax(axis=1)
        best[:, end] = sums[np.arange(words), choice]
        back[:, end] = sizes[choice]
    ends = np.zeros((words, length), bool)
    at = np.full(words, length)
    while (at > 0).any():
        open_ = np.flatnonzero(at > 0)
        ends[open_, at[open_] - 1] = True
        at[open_] -= back[open_, at[open_]]
    return ends


def merges(model: Model, found: np.ndarray) -> np.ndarray:
    """Ends of the symbols left when the adjacent pair of the best-scored piece has been joined, leftmost first, until
    no pair is a piece: (words x length), true behind a symbol's last character."""
    words, length, widest = found.shape
    score = np.where(found >= 0, model.scores[np.maximum(found, 0)], -np.inf).astype(np.float32)
    ends = np.ones((words, length), bool)
    follow = np.tile(np.arange(1, length + 1), (words, 1))  # end of the symbol that starts here
    pair = np.full((words, length), -np.inf, np.float32)
    if length > 1 and widest > 1:
        pair[:, :-1] = score[:, :-1, 1]
    before = np.tile(np.arange(-1, length - 1), (words, 1))  # start of the symbol before
    live = np.arange(words)
    while len(live):
        at = pair[live].argmax(axis=1)
        good = pair[live, at] > -np.inf
        live, at = live[good], at[good]
        if not len(live):
            break
        middle = follow[live, at]
        end = follow[live, middle]
        ends[live, middle - 1] = False
        follow[live, at] = end
        pair[live, middle] = -np.inf
        inside = end < length
        before[live[inside], end[inside]] = at[inside]

        def rate(rows: np.ndarray, start: np.ndarray):
            """The piece of the symbol at ``start`` and the next one."""
            own_end = follow[rows, start]
            has = own_end < length
            size = np.where(has, follow[rows, np.minimum(own_end, length - 1)] - start, widest + 1)
            fits = size <= widest
            pair[rows, start] = np.where(fits, score[rows, start, np.minimum(size, widest) - 1], -np.inf)

        rate(live, at)
        left = before[live, at]
        some = left >= 0
        rate(live[some], left[some])
    return ends


def _merge_long(model: Model, word: str) -> list[int]:
    """The same for one long word, with a heap: start places of its symbols."""
    import heapq

    n = len(word)
    follow, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int]] = []

    def push(a: int) -> None:
        b = follow[a]
        if b < n and follow[b] - a <= model.longest:
            piece = model.index.get(word[a : follow[b]])
            if piece is not None:
                heapq.heappush(heap, (-float(model.scores[piece]), a, follow[b]))

    for a in range(n - 1):
        push(a)
    while heap:
        _, a, end = heapq.heappop(heap)
        if not alive[a] or follow[a] >= n or follow[follow[a]] != end:
            continue
        b = follow[a]
        alive[b], follow[a] = False, end
        if end < n:
            before[end] = a
        push(a)
        if before[a] >= 0:
            push(before[a])
    return [a for a in range(n) if alive[a]]


def _viterbi_long(model: Model, word: str) -> list[int]:
    """Viterbi over one long word: start places of its pieces."""
    least = float(model.scores[model.types == _NORMAL].min() - UNKNOWN_PENALTY)
    best, back = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for size in range(min(end, model.longest), 0, -1):
            piece = model.index.get(word[end - size : end])
            if piece is None and size > 1:
                continue
            total = float(np.float32(best[end - size] + (least if piece is None else float(model.scores[piece]))))
            if total > best[end]:
                best[end], back[end] = total, size
    starts, at = [], len(word)
    while at:
        at -= back[at]
        starts.append(at)
    return starts[::-1]


def _spell(model: Model, ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece (id below 0, one character each) as the pieces of their UTF-8 bytes, or as unknown;
    returns all ids and how many each symbol became."""
    lost = ids < 0
    if not model.byte_fallback or not lost.any():
        return np.where(lost, model.unknown, ids).astype(np.int32), np.ones(len(ids), np.int64)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    width = np.where(lost, width, 1)
    owner = np.repeat(np.arange(len(ids)), width)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)
    point, size = points[owner].astype(np.int64), width[owner]
    rest = (point >> (6 * (size - 1 - place))) & 0x3F
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size] | (point >> (6 * (size - 1)))
    byte = np.where(size == 1, point & 0x7F, np.where(place == 0, lead, 0x80 | rest))
    return np.where(lost[owner], model.bytes_at[byte & 0xFF], ids[owner]).astype(np.int32), width


def _symbols_to_ids(model: Model, points: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words at ``begin`` (code points) of ``size`` characters, end to end, and how many each word has."""
    counts = np.zeros(len(begin), np.int64)
    made: list[tuple[np.ndarray, np.ndarray]] = []  # words and their ids
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        if length > LONG_WORD:
            for i in at:
                part = points[begin[i] : begin[i] + length]
                word = part.tobytes().decode("utf-32-le", "surrogatepass")
                starts = (_merge_long if model.kind == BPE else _viterbi_long)(model, word)
                ids = np.array([model.index.get(word[x:y], -1) for x, y in zip(starts, [*starts[1:], len(word)], strict=True)], np.int32)
                flat, _ = _spell(model, ids, part[starts])
                counts[i] = len(flat)
                made.append((np.array([i]), flat))
            continue
        step = 1 + (1 << 19) // int(length * model.longest)
        for low in range(0, len(at), step):
            some = at[low : low + step]
            own = points[begin[some][:, None] + np.arange(length)].ravel()
            found = _probe(model, kernels.span_prefix(own), np.arange(len(some)) * length, int(length))
            ends = (merges if model.kind == BPE else viterbi)(model, found)
            row, stop = np.nonzero(ends)  # ascending places within each word
            first = np.concatenate([[True], row[1:] != row[:-1]])
            start = np.where(first, 0, np.concatenate([[0], stop[:-1] + 1]))
            flat, width = _spell(model, found[row, start, stop - start], own[row * length + start])
            counts[some] = np.bincount(row, weights=width, minlength=len(some)).astype(np.int64)
            made.append((some, flat))
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for words, flat in made:
        n = counts[words]
        out[np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
    return out, counts


class _Cache:
    """Ids of the words met so far, by their hash; emptied when full. One per Python worker and model."""

    def __init__(self):
        self.keys, self.first, self.size, self.flat = np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] != keys

    def add(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        order = np.argsort(np.concatenate([self.keys, keys]))
        first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.keys, self.first = np.concatenate([self.keys, keys])[order], first[order]
        self.size, self.flat = np.concatenate([self.size, size])[order], np.concatenate([self.flat, flat])

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        return self.first[at], self.size[at]


def encode_texts(model: Model, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each text; null and empty texts have none. Words are told apart by their 64-bit hash."""
    marked = [((MARK if model.dummy_prefix else "") + t.replace(" ", MARK)) if t else "" for t in texts]
    points, starts = _points(marked)
    if not len(points):
        return [np.empty(0, np.int32)] * len(texts)
    mark = points == ord(MARK)
    opens = np.zeros(len(points), bool)
    if model.by_word:
        opens[1:] = mark[1:] & ~mark[:-1]
    opens[starts[starts < len(points)]] = True
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(points))
    keys, where, back = np.unique(kernels.hash_spans(points, begin, end), return_index=True, return_inverse=True)
    fresh = model.cache.missing(keys)
    if len(model.cache.keys) + fresh.sum() > CACHED_WORDS:
        model.cache, fresh = _Cache(), np.ones(len(keys), bool)
    new = where[fresh]
    if len(new):
        model.cache.add(keys[fresh], *_symbols_to_ids(model, points, begin[new], end[new] - begin[new]))
    first, size = model.cache.look(keys)
    length = size[back]
    total = np.cumsum(length)
    ids = model.cache.flat[np.repeat(first[back] - (total - length), length) + np.arange(total[-1])]
    cuts = np.concatenate([[0], total])[np.searchsorted(begin, np.append(starts[1:], len(points)))]
    out = np.split(ids, cuts[:-1])
    if not model.byte_fallback:  # neighbouring unknown characters are one piece
        out = [x[~((x == model.unknown) & np.concatenate([[False], x[:-1] == model.unknown]))] if len(x) else x for x in out]
    return out


def decode_ids(model: Model, rows: list[np.ndarray | None]) -> list[str]:
    """Texts of id lists: control pieces vanish, bytes that are no UTF-8 become U+FFFD each, one leading space of the
    prefix is dropped. An id outside the model is an error."""
    table = model.surface
    out = []
    for ids in rows:
        data = b"".join([table[i] for i in (ids.tolist() if ids is not None else [])])
        text = data.decode("utf-8", "each_byte")
        out.append(text[1:] if model.dummy_prefix and text.startswith(" ") else text)
    return out


def encode_column(path: str):
    """A column function: text -> ids. Null texts give an empty list."""

    @F.pandas_udf("array<int>")
    def encode(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        warm()
        model = load(path)
        for series in frames:
            texts = [t if isinstance(t, str) else None for t in series.tolist()]
            yield pd.Series([x for a, b in kernels.batches(texts, STRETCH) for x in encode_texts(model, texts[a:b])], dtype=object)

    return encode


def decode_column(path: str):
    """A column function: ids -> text; null gives an empty text."""

    @F.pandas_udf("string")
    def decode(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path)
        for series in frames:
            yield pd.Series(decode_ids(model, [x if isinstance(x, np.ndarray) else None for x in series]), dtype=object)

    return decode


def encode(docs: DataFrame, path: str = "piece_bpe_32k.model", text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of the whole text in ``ids_col`` (replaced if there). Rows and other columns stay;
    null and empty texts have no ids."""
    return docs.withColumn(ids_col, encode_column(path)(F.col(text_col).cast("string")))


def decode(docs: DataFrame, path: str = "piece_bpe_32k.model", ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of the ids in ``text_col`` (replaced if there)."""
    return docs.withColumn(text_col, decode_column(path)(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, round_trip) of every row: the piece ids of the whole text, and whether they decode to it again.

    One Python pass does both, in stretches of bounded size. Null counts as empty and has no ids; a text that holds the
    space mark itself does not come back (as with the library). Repeated rows and null ids are kept, other columns ignored.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        model = load(path)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["_text"].tolist()]
            for start, end in kernels.batches(texts, STRETCH):
                part = texts[start:end]
                ids = encode_texts(model, part)
                same = [a == b for a, b in zip(decode_ids(model, ids), part, strict=True)]
                yield pd.DataFrame({"_id": frame["_id"].iloc[start:end].to_numpy(), "ids": ids, "round_trip": same})

    slim = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    made = slim.mapInPandas(run, "_id string, ids array<int>, round_trip boolean")
    return made.select(F.col("_id").cast("long").alias("doc_id"), "ids", "round_trip")
