"""Vectorised helpers on batches of texts: word bounds, word hashes and shingle hashes.

A batch of texts is laid end to end as UTF-8 bytes. Words are maximal runs without ASCII
white space (``[^\\x20\\x09-\\x0D]+``), letters A-Z are lower-cased; no other character is
changed. Hashes are 64 bits wide and the same in every batch, process and run.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
SHINGLE_WORDS = 5
#: Odd multipliers of the polynomial and of the shingle sum (fixed, so that stored sketches stay comparable).
BYTE_BASE = U64(0x9E3779B97F4A7C15)
WORD_BASE = U64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, dtype=bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return lower, space


#: Spans are hashed in stretches of this many bytes, so that the tables of powers stay small.
CHUNK = 1 << 19


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BYTE_BASE ** k and its inverse powers modulo 2**64, for k up to CHUNK."""
    inverse = U64(pow(int(BYTE_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[U64(1)], np.full(CHUNK, BYTE_BASE, U64)]), dtype=U64)
        down = np.cumprod(np.concatenate([[U64(1)], np.full(CHUNK, inverse, U64)]), dtype=U64)
    return up, down


@dataclass
class Words:
    """Words of a batch in order. ``hashes[bounds[i]:bounds[i + 1]]`` belong to text i."""

    data: np.ndarray  # lower-cased bytes of all texts, one blank behind each
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def encode(texts: list[str | None]) -> list[bytes]:
    """UTF-8 bytes; null counts as empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def split_words(raw: list[bytes], lower_case: bool = True) -> Words:
    lower, space = _tables()
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    if lower_case:
        data = lower[data]
    ends_of_text = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    blank = space[data]
    edge = np.diff(blank.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bounds = np.concatenate([[0], np.searchsorted(starts, ends_of_text, side="left")])
    return Words(data, starts, ends, hash_spans(data, starts, ends), bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span, mixed with its length. Spans follow each other without overlap."""
    up, down = _powers()
    out = np.empty(len(starts), U64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            base = int(starts[i])
            j = int(np.searchsorted(ends, base + CHUNK, side="right"))
            if j <= i:  # one span longer than the stretch
                total = 0
                for low in range(base, int(ends[i]), CHUNK):
                    part = data[low : min(low + CHUNK, int(ends[i]))].astype(U64) + U64(1)
                    total += int((part * up[: len(part)]).sum(dtype=U64)) * pow(int(BYTE_BASE), low - base, 1 << 64)
                out[i] = U64(total % (1 << 64))
                i += 1
                continue
            prefix = span_prefix(data[base : int(ends[j - 1])])
            out[i:j] = substring_sums(prefix, starts[i:j] - base, ends[i:j] - base)
            i = j
        return mix(out + (ends - starts).astype(U64) * WORD_BASE)


def span_prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of at most CHUNK symbols."""
    prefix = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U64) + U64(1)) * _powers()[0][: len(data)], out=prefix[1:])
    return prefix


def substring_sums(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each substring, whatever its place."""
    with np.errstate(over="ignore"):
        return (prefix[ends] - prefix[starts]) * _powers()[1][starts]


def shingle_hashes(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, repeated ones included, in text order.

    A text of fewer words than ``size`` (one at least) has one shingle, all its words.
    """
    n = len(words.bounds) - 1
    counts = np.diff(words.bounds)
    owner = np.repeat(np.arange(n), counts)
    h = words.hashes
    if not len(h):
        return np.empty(0, U64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(h), U64)
        # Horner from the left, words beyond the own text left out
        room = words.bounds[1:][owner] - np.arange(len(h))
        full = room >= size
        for k in range(size):
            shifted = np.concatenate([h[k:], np.zeros(min(k, len(h)), U64)])
            total = np.where(k < room, total * WORD_BASE + shifted, total)
        length = np.minimum(counts[owner], size).astype(U64)
        total = mix(total + length)
    first = np.zeros(len(h), bool)
    first[words.bounds[:-1][counts > 0]] = True
    keep = full | (first & (counts[owner] < size))
    return total[keep], owner[keep]


def distinct_per_text(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and bounds: text i has ``out[b[i]:b[i + 1]]``."""
    cuts = np.searchsorted(owner, np.arange(n + 1))
    parts = [np.unique(hashes[cuts[i] : cuts[i + 1]]) for i in range(n)]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, U64)), bounds


def shingle_sets(texts: list[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text with their bounds; null or blank texts have none."""
    hashes, owner = shingle_hashes(split_words(encode(texts)), size)
    return distinct_per_text(hashes, owner, len(texts))


def batches(texts: list, most_bytes: int = 1 << 20):
    """Index ranges of at most ``most_bytes`` characters (one text at least): bounds the arrays above."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        length = 0 if text is None else len(text)
        if i > start and held + length > most_bytes:
            yield start, i
            start, held = i, 0
        held += length
    if start < len(texts):
        yield start, len(texts)
