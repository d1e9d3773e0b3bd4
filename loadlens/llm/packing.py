"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (attention stays inside a piece).
Each task packs its own documents in windows of bounded size, without any shuffle: whole sequences
are cut off long documents, the rests go in descending order to the sequence of lowest cost that
has room. A window has as many sequences as its tokens need, so only its last bit is padding.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.scratch import warm

SEQUENCE = 1024
END = 0
WINDOW_TOKENS = 4 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE
#: Up to here (end of Latin Extended-B) both libraries class every character alike; other texts take the slower one.
_OTHER = re.compile("[^\x00-ɏ]|<\\|endoftext\\|>")


@functools.lru_cache(maxsize=2)
def _coders(vocabulary: str, ranks: str):
    """The tokenizer, and a faster coder over the same vocabulary."""
    warm()
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    slow = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    for probe in ("The quick brown fox's  100 €\n\n é", " \t x"):
        if not _OTHER.search(probe) and fast.encode_ordinary(probe) != slow.encode(probe, add_special_tokens=False).ids:
            raise ValueError(f"{ranks} is not the vocabulary of {vocabulary}")
    return slow, fast


def token_ids(texts: list[str], vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken") -> list[np.ndarray]:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``."""
    slow, fast = _coders(vocabulary, ranks)
    out = []
    for text in texts:
        ids = slow.encode(text, add_special_tokens=False).ids if _OTHER.search(text) else fast.encode_ordinary(text)
        out.append(np.array(ids, np.uint32))
    return out


def assign(lengths: np.ndarray, capacity: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of sequences, and (piece, start in it, length, sequence): descending pieces to the cheapest sequence with
    room; a piece that fits nowhere fills the emptiest one and goes on with its rest."""
    n = int(-(-lengths.sum() // capacity))
    room, cost = np.full(n, capacity), np.zeros(n)
    placed = []
    for piece in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[piece])
        while left:
            fits = room >= left
            if fits.any():
                at, take = int(np.where(fits, cost, np.inf).argmin()), left
            else:
                at = int(room.argmax())
                take = int(room[at])
            placed.append((int(piece), start, take, at))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return n, placed


def padded(length: int, capacity: int = SEQUENCE) -> int:
    """A sequence whose length is a power of two stays, others are padded to the capacity."""
    return length if length & (length - 1) == 0 else capacity


def pack(docs: DataFrame, capacity: int = SEQUENCE, window_tokens: int = WINDOW_TOKENS, vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset,
    sequence_length (padded), sequence_cost.

    A document is its ids and a closing id 0; a null or empty text is that id alone. Repeated rows and null ids
    are packed like others, an empty table gives no rows, other columns are ignored. Very long texts are cut
    into whole sequences at once. ``sequence_id`` is unique: input partition and a counter in it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 33
        held: list[tuple[str | None, np.ndarray]] = []
        count = 0

        def window(full_sequences: int) -> tuple[pd.DataFrame, int]:
            rows, rests = [], []  # rows: document, start, length, sequence, offset
            for d, (_, ids) in enumerate(held):
                whole = len(ids) // capacity
                rows += [(d, k * capacity, capacity, full_sequences + k, 0) for k in range(whole)]
                full_sequences += whole
                if len(ids) % capacity:
                    rests.append(d)
            begins = {d: len(held[d][1]) // capacity * capacity for d in rests}
            n, placed = assign(np.array([len(held[d][1]) - begins[d] for d in rests], np.int64), capacity, linear, quadratic) if rests else (0, [])
            filled = [0] * n
            for piece, start, take, at in placed:
                rows.append((rests[piece], begins[rests[piece]] + start, take, full_sequences + at, filled[at]))
                filled[at] += take
            out = pd.DataFrame(rows, columns=["_doc", "start", "length", "_seq", "offset"])
            total = out.groupby("_seq")["length"].transform("sum")
            out["sequence_cost"] = (linear * out["length"] + quadratic * out["length"] ** 2.0).groupby(out["_seq"]).transform("sum")
            out["sequence_length"] = [padded(int(t), capacity) for t in total]
            out["sequence_id"] = first + out.pop("_seq")
            out["_id"] = [held[d][0] for d in out["_doc"]]
            out["doc_tokens"] = [len(held[d][1]) for d in out["_doc"]]
            out["ids"] = [held[d][1][s : s + n].astype("<u4").tobytes() for d, s, n in zip(out["_doc"], out["start"], out["length"], strict=True)]
            return out.drop(columns="_doc"), full_sequences + n

        sequences = 0
        for frame in frames:
            for doc, text in zip(frame["_id"].tolist(), frame["_text"].tolist(), strict=True):
                ids = np.append(token_ids([text if isinstance(text, str) else ""], vocabulary, ranks)[0], np.uint32(END))
                held.append((doc if isinstance(doc, str) else None, ids))
                count += len(ids)
                if count >= window_tokens:
                    out, sequences = window(sequences)
                    yield out
                    held, count = [], 0
        if held:
            yield window(sequences)[0]

    slim = docs.select(F.col("doc_id").cast("string").alias("_id"), F.col("text").cast("string").alias("_text"))
    made = slim.mapInPandas(
        run, "start long, length long, offset long, sequence_cost double, sequence_length int, sequence_id long, _id string, "
        "doc_tokens long, ids binary",
    )
    return made.select(
        F.col("_id").cast("long").alias("doc_id"), "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
        "sequence_length", "sequence_cost",
    )


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_length", "sequence_cost",
    )
