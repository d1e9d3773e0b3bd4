"""Alignment of two tokenizers over the same bytes, with inverted pair bitmaps.

Tokens of A and B that share bytes are linked. A block of documents keeps one posting per linked id pair: a
compressed bitmap of the documents that hold it (an array of places where that is shorter), and bit planes of
how often each holds it. Bitmaps of the parts of a block merge by OR; their bits, counted and summed over the
blocks, are the pairs' document counts. Counts then go back through the postings to score every document.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.scratch import warm, write

VOCABULARY, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: A block ends at so many documents (a place fits 16 bits) or so many characters.
BLOCK_DOCS, BLOCK_CHARS = 8192, 8 << 20
#: Documents of a block are encoded in parts of about this many characters.
PART_CHARS = 1 << 20
#: Up to here (end of Latin Extended-B) both libraries class every character alike; other texts take the slower one.
_OTHER = re.compile("[^\x00-ɏ]")
_B_BITS = 20
_PLACE_BITS = 14


@functools.lru_cache(maxsize=2)
def _pieces(model: str):
    warm()
    import public_tokenizers
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    table = []
    for i in range(coder.get_piece_size()):
        piece = coder.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if coder.is_byte(i) else piece.replace("▁", " ").encode("utf-8", "surrogatepass"))
    return coder, table


@functools.lru_cache(maxsize=2)
def _byte_level(vocabulary: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary: printable characters stand for themselves, the other bytes for those from 256 on."""
    import public_tokenizers

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    of = {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    table = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        table[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    return table


@functools.lru_cache(maxsize=2)
def _byte_coders(vocabulary: str, ranks: str):
    """The tokenizer, special tokens being plain text to it, and a faster coder over the same vocabulary."""
    warm()
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    slow.encode_special_tokens = True
    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    entries = _byte_level(vocabulary)
    if any(i >= len(entries) or entries[i] != entry for entry, i in table.items()):
        raise ValueError(f"{ranks} is not the vocabulary of {vocabulary}")
    return slow, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that share bytes: (a index, b index) of every pair in order, and which ends of a and of b are common.

    Both cut the same bytes, without empty tokens: every stretch between two neighbouring ends is one pair.
    """
    common_a = np.isin(a_ends, b_ends, assume_unique=True)
    common_b = np.isin(b_ends, a_ends, assume_unique=True)
    ends = np.sort(np.concatenate([a_ends, b_ends[~common_b]]), kind="stable")
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), common_a, common_b


def _group_texts(a: np.ndarray, b: np.ndarray, common_a: np.ndarray, common_b: np.ndarray, owners_a: np.ndarray, owners_b: np.ndarray, texts: int, ends: tuple[list[str], ...]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every text. ``ends`` has the ids as text, followed by a comma, a bar and a semicolon."""
    group_a = np.concatenate([[0], np.cumsum(common_a)[:-1]]).astype(np.int64)
    group_b = np.concatenate([[0], np.cumsum(common_b)[:-1]]).astype(np.int64)
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b))])  # b tokens before a group
    upto_a = np.cumsum(np.bincount(group_a))
    total = len(a) + len(b)
    flat = np.empty(total, np.int64)
    flat[np.arange(len(a)) + before_b[group_a]] = a + np.where(common_a, len(ends[0]), 0)
    flat[np.arange(len(b)) + upto_a[group_b]] = b + np.where(common_b, 2 * len(ends[0]), 0)
    sizes = np.bincount(owners_a, minlength=texts) + np.bincount(owners_b, minlength=texts)
    stops = np.cumsum(sizes)
    table = ends[0] + ends[1] + ends[2]
    return ["".join(map(table.__getitem__, flat[stop - size : stop].tolist()))[:-1] for stop, size in zip(stops.tolist(), sizes.tolist(), strict=True)]


class _Coders:
    """Both tokenizers of a task, with the bytes, lengths and texts of their ids."""

    def __init__(self, vocabulary: str, ranks: str, model: str):
        self.slow, self.fast = _byte_coders(vocabulary, ranks)
        self.pieces, self.bytes_b = _pieces(model)
        self.bytes_a = _byte_level(vocabulary)
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.ends = tuple([f"{i}{mark}" for i in range(most)] for mark in ",|;")

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B, or None for texts whose bytes the tokens don't give back."""
        out = []
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            text = " " + text
            a = self.slow.encode(text, add_special_tokens=False).ids if _OTHER.search(text) else self.fast.encode_ordinary(text)
            raw = text.encode("utf-8", "surrogatepass")
            same = b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw
            out.append((a, b) if same else None)
        return out


def _pack_places(places: np.ndarray, size: int) -> bytes:
    """Sorted places below ``size``: an array of 16-bit numbers, or a bitmap if that is shorter."""
    if 2 * len(places) < -(-size // 8):
        return places.astype("<u2").tobytes()
    bits = np.zeros(size, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _unpack_all(packed: list[bytes], sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of many bitmaps at once: (row, place), sorted by row, then place. ``sizes`` has the number of bits set in each."""
    arrays = np.array([2 * n == len(p) for p, n in zip(packed, sizes.tolist(), strict=True)], bool)
    # an array is written only where it is shorter, so its length is never that of a bitmap
    arrays &= 2 * sizes < -(-size // 8)
    rows, places = [], []
    which = np.flatnonzero(arrays)
    if len(which):
        rows.append(np.repeat(which, sizes[which]))
        places.append(np.frombuffer(b"".join([packed[i] for i in which.tolist()]), "<u2").astype(np.int64))
    which = np.flatnonzero(~arrays)
    for low in range(0, len(which), 1024):
        part = which[low : low + 1024]
        if size:
            bits = np.unpackbits(np.frombuffer(b"".join([packed[i] for i in part.tolist()]), np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
            at, place = np.nonzero(bits)
            rows.append(part[at])
            places.append(place)
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    order = np.argsort(row, kind="stable")
    return row[order], place[order]


def _pack_planes(times: np.ndarray) -> bytes:
    """Bit planes of ``times - 1``, lowest first, each a bit per document of the posting; none if all are 1."""
    left = times - 1
    planes = []
    while left.any():
        planes.append(np.packbits((left & 1).astype(np.uint8), bitorder="little").tobytes())
        left = left >> 1
    return b"".join(planes)


def _unpack_planes(packed: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """``times`` of every document of every posting, in order."""
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(int(sizes.sum())) - starts[row]
    width = -(-sizes // 8)
    lengths = np.fromiter((len(p) for p in packed), np.int64, len(packed))
    offsets = np.cumsum(lengths) - lengths
    count = lengths // np.maximum(width, 1)
    data = np.frombuffer(b"".join(packed), np.uint8)
    times = np.ones(len(row), np.int64)
    for plane in range(int(count.max(initial=0))):
        has = np.flatnonzero(count[row] > plane)
        at = offsets[row[has]] + plane * width[row[has]] + (nth[has] >> 3)
        times[has] += ((data[at] >> (nth[has] & 7)) & 1).astype(np.int64) << plane
    return times


class _Block:
    """Documents of a task, one after the other, and the postings of what they hold."""

    def __init__(self):
        self.docs, self.parts = 0, []

    def add(self, pairs: np.ndarray, places: np.ndarray) -> None:
        """Links of a part: pair codes and document places, repeated as often as they occur."""
        keys = np.sort((pairs << _PLACE_BITS) | places)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.parts.append((keys[first], np.diff(np.append(first, len(keys)))))

    def postings(self, block: int, rows: int = 20_000) -> Iterator[pd.DataFrame]:
        """The parts' bitmaps merged: a document is in one part only, so their OR is the merge of sorted places."""
        if not self.parts:
            return
        keys = np.concatenate([p[0] for p in self.parts])
        times = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        pairs, places = keys >> _PLACE_BITS, keys & ((1 << _PLACE_BITS) - 1)
        starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(pairs)))
        links = np.add.reduceat(times, starts) if len(starts) else sizes
        raw, flat, width = places.astype("<u2").tobytes(), times == 1, -(-self.docs // 8)
        plain = np.logical_and.reduceat(flat, starts) if len(starts) else flat
        for low in range(0, len(starts), rows):
            docs, planes = [], []
            for i in range(low, min(low + rows, len(starts))):
                a, n = int(starts[i]), int(sizes[i])
                docs.append(raw[2 * a : 2 * (a + n)] if 2 * n < width else _pack_places(places[a : a + n], self.docs))
                planes.append(b"" if plain[i] else _pack_planes(times[a : a + n]))
            part = slice(low, low + rows)
            code = pairs[starts[part]]
            yield pd.DataFrame({
                "block": block, "a": code >> _B_BITS, "b": code & ((1 << _B_BITS) - 1), "n_docs": sizes[part], "n_links": links[part], "docs": docs, "planes": planes,
            })


_DOC = "block long, place int, doc_id string, n_a long, n_b long, n_groups long, links long, groups_sha256 string, size int"
_POSTING = "block long, a int, b int, n_docs long, n_links long, docs binary, planes binary"


def _encoded(docs: DataFrame, text_col: str, id_col: str, vocabulary: str, ranks: str, model: str, block_docs: int, block_chars: int) -> DataFrame:
    """Rows of two kinds: one per document, and the postings of its block."""

    def part_rows(frame_ids: list, texts: list[str | None], block: _Block, number: int, tools: _Coders) -> pd.DataFrame:
        found = iter(tools.encode([t for t in texts if t]))
        ids = [next(found) if t else None for t in texts]
        used = np.array([i for i, x in enumerate(ids) if x is not None], np.int64)
        n = len(texts)
        figures = np.zeros((3, n), np.int64)
        shas = np.full(n, "", object)
        links = np.zeros(n, np.int64)
        if len(used):
            a = np.concatenate([np.array(ids[i][0], np.int64) for i in used])
            b = np.concatenate([np.array(ids[i][1], np.int64) for i in used])
            count_a, count_b = (np.array([len(ids[i][k]) for i in used]) for k in (0, 1))
            owner_a, owner_b = np.repeat(np.arange(len(used)), count_a), np.repeat(np.arange(len(used)), count_b)
            at_a, at_b, common_a, common_b = overlaps(np.cumsum(tools.size_a[a]), np.cumsum(tools.size_b[b]))
            owner = owner_a[at_a]
            figures[:, used] = [count_a, count_b, np.bincount(owner_a, common_a, len(used)).astype(np.int64)]
            links[used] = np.bincount(owner, minlength=len(used))
            shas[used] = [hashlib.sha256(s.encode()).hexdigest() for s in _group_texts(a, b, common_a, common_b, owner_a, owner_b, len(used), tools.ends)]
            block.add((a[at_a] << _B_BITS) | b[at_b], used[owner] + block.docs)
        out = pd.DataFrame({
            "block": number, "place": np.arange(n) + block.docs, "doc_id": frame_ids, "n_a": figures[0], "n_b": figures[1], "n_groups": figures[2],
            "links": links, "groups_sha256": shas,
        })
        block.docs += n
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = _Coders(vocabulary, ranks, model)
        task = TaskContext.get().partitionId()
        block, chars, numbered = _Block(), 0, 0
        for frame in frames:
            ids, texts = frame["_id"].tolist(), [t if isinstance(t, str) else None for t in frame["_text"].tolist()]
            at = 0
            while at < len(texts):
                start, size = at, 0
                while at < len(texts) and size < PART_CHARS and block.docs + at - start < block_docs:
                    size += len(texts[at] or "")
                    at += 1
                number = task << 32 | numbered
                yield part_rows(ids[start:at], texts[start:at], block, number, tools)
                chars += size
                if block.docs >= block_docs or chars >= block_chars:
                    yield from block.postings(number)
                    yield pd.DataFrame({"block": [number], "size": [block.docs]})
                    block, chars, numbered = _Block(), 0, numbered + 1
        if block.docs:
            number = task << 32 | numbered
            yield from block.postings(number)
            yield pd.DataFrame({"block": [number], "size": [block.docs]})

    schema = f"{_DOC}, {_POSTING.split(',', 1)[1]}"
    names = [c.split()[0] for c in schema.split(", ")]
    slim = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def filled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in run(frames):
            nothing = pd.Series([None] * len(out), dtype=object)
            yield pd.DataFrame({c: out[c] if c in out else nothing for c in names})

    return slim.mapInPandas(filled, schema)


def align(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary: str = VOCABULARY, ranks: str = RANKS, model: str = PIECES,
    block_docs: int = BLOCK_DOCS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a blank and the text, B the text (it adds the blank itself); special tokens in a text are plain text. Both
    tokens of a link share bytes; offsets where both end cut them into groups. A pair's count is the number of rows of
    ``docs`` that hold it linked; ``n_best`` counts links whose pair has the highest count of its A id, ``count_sum`` adds
    the counts up. Null and empty texts, and texts that the tokens of A or B don't give back, have zeros and ''. Rows of
    one id are documents of their own; a null id stays null; an empty table gives no rows; other columns are ignored.
    """
    places, postings = index(docs, text_col, id_col, vocabulary, ranks, model, block_docs, block_chars)
    counts = pair_counts(postings)
    return scores(places, postings, counts)


def index(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary: str = VOCABULARY, ranks: str = RANKS, model: str = PIECES,
    block_docs: int = BLOCK_DOCS, block_chars: int = BLOCK_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """(documents, postings), stored: a row per document with its block and place, and a row per block and linked pair with
    the bitmap ``docs`` and the bit ``planes``; each block has one more document row with only its ``size``."""
    if block_docs > 1 << _PLACE_BITS:
        raise ValueError(f"a block has at most {1 << _PLACE_BITS} documents")
    path = write(_encoded(docs, text_col, id_col, vocabulary, ranks, model, block_docs, block_chars), "alignment")
    schema = f"{_DOC}, {_POSTING.split(',', 1)[1]}"
    rows = lambda columns: docs.sparkSession.read.schema(schema).parquet(path).select([c.split()[0] for c in columns.split(", ")])
    return rows(_DOC).where("place is not null or size is not null"), rows(_POSTING).where("a is not null")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, count, links, best): documents and links of every pair, and whether no pair of the A id has more documents."""
    counts = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("count"), F.sum("n_links").alias("links"))
    top = F.max("count").over(Window.partitionBy("a"))  # at most as many rows as B has ids
    return counts.withColumn("best", F.col("count") == top)


def scores(places: DataFrame, postings: DataFrame, counts: DataFrame) -> DataFrame:
    """The postings, each with its pair's count, give every document of a block its sums."""
    known = postings.select("block", "a", "b", "n_docs", "docs", "planes").join(counts.select("a", "b", "count", "best"), ["a", "b"])

    def run(key, own: pd.DataFrame, posted: pd.DataFrame) -> pd.DataFrame:
        size = int(own["size"].max())
        own = own[own["place"].notna()].sort_values("place")
        best, low, high = (np.zeros(size, np.float64) for _ in range(3))
        for start in range(0, len(posted), 50_000):
            part = posted.iloc[start : start + 50_000]
            sizes = part["n_docs"].to_numpy(np.int64)
            row, place = _unpack_all(part["docs"].tolist(), sizes, size)
            times = _unpack_planes(part["planes"].tolist(), sizes)
            count = part["count"].to_numpy(np.int64)[row]
            best += np.bincount(place, times * part["best"].to_numpy(bool)[row], size)
            low += np.bincount(place, times * (count & 0xFFFFFF), size)  # halves, so that every sum is exact
            high += np.bincount(place, times * (count >> 24), size)
        at = own["place"].to_numpy(np.int64)
        return pd.DataFrame({
            "doc_id": own["doc_id"].to_numpy(), "n_a": own["n_a"], "n_b": own["n_b"], "n_groups": own["n_groups"], "n_links": own["links"],
            "n_best": best[at].astype(np.int64), "count_sum": low[at].astype(np.int64) + (high[at].astype(np.int64) << 24), "groups_sha256": own["groups_sha256"].to_numpy(),
        })

    kind = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    scored = places.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(run, kind)
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))
