"""Secrets in texts: fixed patterns, and strings whose sliding-window entropy is high.

Offsets count code points, ends are exclusive. Three base kinds come from patterns. The fourth,
``entropy``, takes candidate strings, slides a window over each with incremental counts, and
joins the windows whose Shannon entropy reaches the bar of the string's character class, unless
an allow rule knows the string. Where a joined span meets a base span, its other characters stay a span.
"""

from __future__ import annotations

import math
import re
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_LEAST = 12
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 and more; a shorter run holds no longer match
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MARKS = "-_/+="
WINDOW = 20
#: Bits per character that a window must reach, by class, narrowest class first.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("alphanumeric", re.compile(r"[A-Za-z0-9]+"), 3.8),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9),
)
#: Strings that are no secrets, unless their letters look like a key's: words joined by marks, paths and slugs.
WORDS = (
    re.compile(r"[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*[-_/+=]*"),
    re.compile(r"(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/+=]+(?:[A-Za-z]+|[0-9]{1,8}))+[-_/+=]*"),
)
#: A small letter between capitals: in a key, hardly in words or names.
KEY_CASE = re.compile(r"[A-Z][a-z][A-Z]")
#: The bar of a run of words, which a key that looks like words may still reach.
WORD_BAR = 4.1
#: Strings that are no secrets: UUIDs, dates and counters.
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),
    re.compile(r"[0-9+/_=-]+"),
)
#: Segments, between marks, that are placeholders.
PLACEHOLDER = re.compile(r"(?i)[A-Za-z0-9]*(?:example|sample|placeholder|changeme|dummy|xxxx)[A-Za-z0-9]*")
MASK = "[SECRET]"


def high_windows(string: str, bar: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined spans of the windows whose entropy is at least ``bar`` bits per character."""
    if len(string) < window:
        return []
    weight = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    held = 0.0  # sum of c log c: the entropy is log2(window) - held / window
    most = (math.log2(window) - bar) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for i, char in enumerate(string):
        c = counts.get(char, 0)
        held += weight[c + 1] - weight[c]
        counts[char] = c + 1
        if i >= window:
            gone = string[i - window]
            c = counts[gone]
            held += weight[c - 1] - weight[c]
            counts[gone] = c - 1
        start = i - window + 1
        if start >= 0 and held <= most:
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    lowered = text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):  # without one of them the pattern can't match
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def is_words(string: str) -> bool:
    return not KEY_CASE.search(string) and any(rule.fullmatch(string) for rule in WORDS)


def is_allowed(string: str) -> bool:
    return any(rule.fullmatch(string) for rule in ALLOW)


def strings_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A run without its placeholder segments: what is left between them, each a string of its own."""
    out, at = [], start
    for m in PLACEHOLDER.finditer(text, start, end):
        out.append((at, m.start()))
        at = m.end()
        while at < end and text[at] in MARKS:
            at += 1
    return [(a, b) for a, b in [*out, (at, end)] if b - a >= WINDOW]


def rest_of(text: str, start: int, end: int, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """What the base spans leave of a span. Marks beside a base span go with it, and so do words and counters that a
    mark sets apart from it; all else may be a piece of a key and stays."""
    out, at = [], start
    for a, b in [*sorted((a, b) for a, b, _ in base if a < end and start < b), (end, end)]:
        left, right = at, min(a, end)
        at = max(at, b)
        if left > start:
            while left < right and text[left] in MARKS:
                left += 1
        if right < end:
            while left < right and text[right - 1] in MARKS:
                right -= 1
        apart = (left == start or text[left - 1] in MARKS) and (right == end or text[right] in MARKS)
        whole = left == start and right == end
        part = text[left:right]
        if part and (whole or not (apart and (is_words(part) or is_allowed(part) or PLACEHOLDER.fullmatch(part)))):
            out.append((left, right))
    return out


def entropy_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """High-entropy spans that are not allowed, without the characters of base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        for start, end in strings_of(text, m.start(), m.end()):
            string = text[start:end]
            if is_allowed(string):
                continue
            bar = WORD_BAR if is_words(string) else next(bar for _, rule, bar in CLASSES if rule.fullmatch(string))
            for a, b in high_windows(string, bar):
                out += [(*part, "entropy") for part in rest_of(text, a + start, b + start, base)]
    return out


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a text, sorted by start, then kind as in ``KINDS``; null has none."""
    if not text:
        return []
    base = base_spans(text)
    return sorted([*base, *entropy_spans(text, base)], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def mask_spans(text: str, spans: list[tuple[int, int, str]], mask: str = MASK) -> str:
    """The text with the joined spans replaced."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = "array<struct<kind: string, start: int, end: int>>"


def scan(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans`` of the whole text (a column of that name is replaced); null and empty texts have none.

    Rows and other columns stay as they are, repeated rows have equal spans, an empty table stays empty.
    """

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        found = (find_spans(t if isinstance(t, str) else None) for t in texts)
        return pd.Series([[{"kind": k, "start": a, "end": b} for a, b, k in one] for one in found], dtype=object)

    return docs.withColumn(spans_col, spans(F.col(text_col).cast("string")))


def digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, the digest of the base spans, and all spans as text."""
    text = lambda keep: F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return spans.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by a mask; rows, other columns and null texts stay."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask_spans(t, find_spans(t)) if isinstance(t, str) else None for t in texts], dtype=object)

    return docs.withColumn(text_col, masked(F.col(text_col).cast("string")))
