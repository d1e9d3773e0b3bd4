"""Personal data in texts by weak supervision.

Patterns propose candidate spans. Labelers (patterns, gazetteers, context words) each vote for, against or
not at all on every candidate. How reliable each labeler is, nobody has labelled: expectation-maximisation
estimates it from the votes of the whole table, which give every candidate a probability. A logistic span
classifier, trained on these, decides on the candidates that are no base span. Base spans stay always.

Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.scratch import discard, warm, write

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the method adds: mails written around the sign, network addresses, account numbers, national phones, names, birth dates.
MORE_KINDS = ("mail", "net", "account", "dial", "name", "date")
KINDS = (*BASE_KINDS, *MORE_KINDS)
FAMILY = {"email": 0, "mail": 0, "ip": 1, "net": 1, "card": 2, "account": 2, "phone": 3, "dial": 3, "name": 4, "date": 5}
FAMILIES = 6
#: A span that is no base span needs this probability.
BAR = 0.9
MASK = "[PERSONAL]"

# The base patterns. A long run of digits, dots or letters is read once: mails are found from their sign to
# both sides, addresses as groups of four in a maximal run of dotted numbers, where alone a match can begin.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Patterns of the further candidates; phones and dates are looked for in runs of digits and marks only.
AT_WORD = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?", re.I)
LOCAL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
HOST_AFTER = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I)
NET = re.compile(r"(?<![0-9A-Fa-f:])(?:(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])")
NUMBERS = re.compile(r"[0-9(][0-9().+/\x20-]{6,}")
DIAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9./-])")
ACCOUNT_LEAST = 9

# Gazetteers.
TITLES = frozenset("mr mrs ms dr prof herr frau sr sra mme".split())
GIVEN = frozenset(
    "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen "
    "hans peter klaus jürgen stefan anna ursula monika petra sabine jean pierre michel marie nathalie isabelle josé juan antonio manuel carmen maría ana "
    "laura daniel anthony mark paul steven andrew emma olivia sophia lucas martin".split()
)
FIRST_NAME = re.compile("(?:" + "|".join(sorted((w.capitalize() for w in TITLES | GIVEN), key=len, reverse=True)) + ")")
OTHER_NAMES = re.compile(r"\.?(?:\x20[A-Z][a-zà-öø-ÿ]+){1,2}(?!\w)")
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl eu ch at be ca au jp cn in br mx ru pl se no dk fi pt ie".split())
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54",
                 "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|36|6011|65|35|62")
RESERVED_NET = re.compile(r"0\.|127\.|255\.|169\.254\.|22[4-9]\.|23[0-9]\.")

# Context words that speak for a family, and words that speak against any.
FOR = (
    frozenset("mail email e-mail contact write correo courriel reply".split()),
    frozenset("ip address host server client from addr login adresse".split()),
    frozenset("card visa mastercard amex credit account iban konto carte tarjeta ssn payment".split()),
    frozenset("phone tel telephone call mobile cell fax whatsapp telefon handy téléphone teléfono".split()),
    frozenset("name named signed author patient customer employee born dear regards sincerely called".split()),
    frozenset("born birth birthday dob geboren naissance nacimiento".split()),
)
AGAINST = frozenset(
    "version release isbn issn order invoice page chapter section rfc port build figure table item number no id hash checksum sha size total serial part "
    "model article vol volume published updated posted copyright".split()
)
LABELERS = ("pattern", "checksum", "shape", "gazetteer", "context_for", "context_against", "edges", "repeat")
VOTE_CODES = 3 ** len(LABELERS)
CONTEXT = 40
_WORD = re.compile(r"[\w-]+")

_BUCKETS = 32
_SIZES = (0, 6, 8, 9, 10, 12, 15, 16, 19)
_AT_SIZE, _AT_MARK, _AT_EDGE = 1 + FAMILIES, 17, 24
_AT_LEFT = 32
FEATURES = _AT_LEFT + 2 * _BUCKETS
_SCALE = float(1 << 20)
STEPS = 8


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return not part or (len(part) <= 3 and int(part) <= 255)


def _digits(string: str) -> str:
    return "".join(c for c in string if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _dotted_fours(text: str) -> Iterator[tuple[int, int]]:
    for m in DOTTED.finditer(text):
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i : i + 4])) + 3
            yield start, end
            start = end + 1


def proposals(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, is a base span): base patterns with what fails their tests, which is no base span."""
    out = [(a, b, "email", True) for a, b in _emails(text)]
    out += [(a, b, "ip", all(_at_most_255(p) for p in text[a:b].split("."))) for a, b in _dotted_fours(text)]
    for m in CHAIN.finditer(text):
        if m.end() - m.start() >= ACCOUNT_LEAST:
            digits = _digits(m.group())
            if len(digits) >= ACCOUNT_LEAST:
                out.append((m.start(), m.end(), "card", 14 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in PHONE.finditer(text):
            out.append((m.start(), m.end(), "phone", 10 <= len(_digits(m.group())) <= 15))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    return [(a, b, kind) for a, b, kind, good in proposals(text) if good]


def _more(text: str) -> Iterator[tuple[int, int, str]]:
    if "(" in text or "[" in text or "{" in text:
        for m in AT_WORD.finditer(text):
            left, right = LOCAL_BEFORE.search(text, max(0, m.start() - 64), m.start()), HOST_AFTER.match(text, m.end())
            if left and right:
                yield left.start(), right.end(), "mail"
    if text.count(":") > 4 or text.count("-") > 4:
        yield from ((m.start(), m.end(), "net") for m in NET.finditer(text))
    for run in NUMBERS.finditer(text):
        for kind, rule in (("date", DATE), ("dial", DIAL)):
            yield from ((m.start(), m.end(), kind) for m in rule.finditer(text, run.start(), run.end()))
    for m in FIRST_NAME.finditer(text):
        before, rest = text[m.start() - 1 : m.start()], OTHER_NAMES.match(text, m.end())
        if rest and not (before.isalnum() or before in ("_", ".")):
            yield m.start(), rest.end(), "name"


@dataclass
class Candidate:
    start: int
    end: int
    kind: str
    base: bool
    votes: int
    features: list[int]


def _context(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """Words before, nearest last, and words behind; cut words at the far ends stay as they are."""
    low, high = max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    return _WORD.findall(text[low:start].lower()), _WORD.findall(text[end:high].lower())


def _valid_date(string: str) -> bool:
    parts = [int(p) for p in re.split(r"[./-]", string)]
    year, month, day = parts if parts[0] > 31 else (parts[2], parts[1], parts[0])
    if month > 12:
        month, day = day, month
    try:
        return 1900 <= date(year, month, day).year <= 2030
    except ValueError:
        return False


def _votes(text: str, start: int, end: int, kind: str, base: bool, before: list[str], after: list[str], seen: int) -> list[int]:
    """One vote (-1, 0, 1) of each labeler."""
    string, family = text[start:end], FAMILY[kind]
    digits = _digits(string)
    pattern = 1 if base else -1 if kind in BASE_KINDS else 0
    checksum = shape = gazetteer = 0
    if family == 0:
        gazetteer = 1 if re.split(r"[^A-Za-z]+", string)[-1].lower() in TOP_DOMAINS else -1
        shape = 1 if len(string) <= 254 else -1
    elif kind == "net":
        shape = 1 if len(set(re.split(r"[:-]", string))) > 2 else -1
    elif family == 1:
        gazetteer = -1 if RESERVED_NET.match(string) else 0
        shape = -1 if any(len(p) > 3 or (len(p) > 1 and p[0] == "0") for p in string.split(".")) else 1
    elif family == 2:
        checksum = 1 if luhn(digits) and len(set(digits)) > 2 else -1
        gazetteer = 1 if ISSUERS.match(digits) else -1
        shape = 1 if re.fullmatch(r"[0-9]{14,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", string) else -1
    elif family == 3:
        checksum = 1 if 10 <= len(digits) <= 15 else -1
        gazetteer = (1 if digits.startswith(CALLING_CODES) else -1) if kind == "phone" else 0
        shape = -1 if re.search(r"[ .()-]{3}", string) or len(set(digits)) <= 2 else 1
    elif family == 4:
        words = string.lower().replace(".", "").split()
        gazetteer = 1 if words[0] in TITLES or (words[0] in GIVEN and words[-1] not in GIVEN) else -1
    else:
        checksum = 1 if _valid_date(string) else -1
    near, behind = set(before[-5:]), set(after[:3])
    speaks_for = 1 if near & FOR[family] or (family not in (4, 5) and behind & FOR[family]) else 0
    against = -1 if set(before[-2:]) & AGAINST else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = -1 if left.isalnum() or right.isalnum() or left in ("_", "#", "$") or right == "_" else 0
    repeat = -1 if seen > 3 else 0  # the same string again and again is a constant
    return [pattern, checksum, shape, gazetteer, speaks_for, against, edges, repeat]


def _features(text: str, start: int, end: int, kind: str, before: list[str], after: list[str]) -> list[int]:
    string = text[start:end]
    digits = _digits(string)
    marks = [i for i, mark in enumerate((" ", "-", ".", "(", "+", ":", "@")) if mark in string]
    left, right = text[start - 1 : start], text[end : end + 1]
    out = [0, 1 + FAMILY[kind], _AT_SIZE + sum(len(digits) > n for n in _SIZES), *[_AT_MARK + i for i in marks]]
    out += [_AT_EDGE + i for i, on in enumerate((
        not left.isalnum(), not right.isalnum(), len(digits) > 8 and luhn(digits), any(c.isalpha() for c in string), len(set(digits)) <= 2,
        kind in BASE_KINDS, len(string) > 24, bool(set(before[-2:]) & AGAINST),
    )) if on]
    for place, words in ((_AT_LEFT, before[-1:]), (_AT_LEFT + _BUCKETS, after[:1])):
        out += [place + zlib.crc32(w.encode("utf-8", "surrogatepass")) % _BUCKETS for w in words]
    return out


class _Places:
    """Disjoint intervals; ``take`` adds one unless it meets another."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def take(self, a: int, b: int) -> bool:
        i = bisect.bisect_right(self.starts, a)
        if (i and self.ends[i - 1] > a) or (i < len(self.starts) and self.starts[i] < b):
            return False
        self.starts.insert(i, a)
        self.ends.insert(i, b)
        return True


def candidates(text: str) -> list[Candidate]:
    """The base spans of a text, and further candidates that meet neither them nor each other, with votes and features."""
    found = proposals(text)
    spans = [s for s in found if s[3]]
    taken = _Places((a, b) for a, b, _, _ in spans)
    rest = [*((a, b, kind, False) for a, b, kind in sorted(_more(text))), *(s for s in found if not s[3])]
    spans += [s for s in rest if taken.take(s[0], s[1])]
    seen: dict[str, int] = {}
    for a, b, _, _ in spans:
        seen[text[a:b]] = seen.get(text[a:b], 0) + 1
    out = []
    for a, b, kind, base in spans:
        before, after = _context(text, a, b)
        code = 0
        for vote in _votes(text, a, b, kind, base, before, after, seen[text[a:b]]):
            code = code * 3 + vote + 1
        out.append(Candidate(a, b, kind, base, code, _features(text, a, b, kind, before, after)))
    return out


# -- reliabilities and classifier -------------------------------------------------------------

@dataclass
class Model:
    """``truth`` (families x vote codes): probability by the votes; ``reliability`` (families x labelers x class x vote);
    ``weights`` of the span classifier."""

    truth: np.ndarray
    reliability: np.ndarray
    weights: np.ndarray

    def probability(self, features: list[int]) -> float:
        z = float(self.weights[features].sum())
        return round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)


def vote_table() -> np.ndarray:
    """Votes (0 against, 1 none, 2 for) of every code: codes x labelers."""
    codes = np.arange(VOTE_CODES)
    return np.stack([codes // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], axis=1)


def estimate(counts: np.ndarray, rounds: int = 100, prior: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote codes: (probability of each code, P(vote | class) per labeler).

    ``counts`` has the number of candidates of each code. Labelers are taken as independent given the truth. The start,
    which also weighs like ``prior`` candidates, says that a vote is rather right than wrong.
    """
    votes = vote_table()
    start = np.array([[0.5, 0.4, 0.1], [0.1, 0.4, 0.5]])  # class x vote
    table = np.repeat(start[None], len(LABELERS), axis=0)
    share = 0.5
    used = np.flatnonzero(counts > 0)
    n, seen = counts[used].astype(float), votes[used]

    def posterior(which: np.ndarray) -> np.ndarray:
        logs = np.log(table)[np.arange(len(LABELERS))[None, :], :, which].sum(axis=1)  # rows x class
        logs += np.log([1 - share, share])
        top = logs.max(axis=1, keepdims=True)
        p = np.exp(logs - top)
        return p[:, 1] / p.sum(axis=1)

    for _ in range(rounds if len(used) else 0):
        p = posterior(seen)
        weight = np.stack([n * (1 - p), n * p])  # class x rows
        share = float(np.clip((weight[1].sum() + prior / 2) / (n.sum() + prior), 1e-6, 1 - 1e-6))
        fresh = np.stack([np.stack([(weight * (seen[:, i] == v)).sum(axis=1) for v in range(3)], axis=1) for i in range(len(LABELERS))])
        fresh += prior * start[None]
        fresh /= fresh.sum(axis=2, keepdims=True)
        moved = np.abs(fresh - table).max()
        table = fresh
        if moved < 1e-9:
            break
    return posterior(votes), table


def _columns(texts: list[str | None]) -> Iterator[Candidate]:
    for text in texts:
        if text:
            yield from candidates(text)


def _proposed(docs: DataFrame, text_col: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        for frame in frames:
            found = list(_columns([t if isinstance(t, str) else None for t in frame["_text"].tolist()]))
            for low in range(0, len(found), 50_000):
                part = found[low : low + 50_000]
                yield pd.DataFrame({"family": [FAMILY[c.kind] for c in part], "votes": [c.votes for c in part], "features": [c.features for c in part]})

    return docs.select(F.col(text_col).cast("string").alias("_text")).mapInPandas(run, "family int, votes int, features array<int>")


def _newton_sums(rows: DataFrame, truth: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log likelihood: whole-number sums per partition, added up by place."""
    d = FEATURES

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        warm()
        slope, bend = np.zeros(d), np.zeros((d, d))
        for frame in frames:
            lists = frame["features"].to_numpy()
            x = np.zeros((len(frame), d))
            sizes = np.fromiter((len(f) for f in lists), np.int64, len(lists))
            if len(lists):
                x[np.repeat(np.arange(len(lists)), sizes), np.concatenate(lists)] = 1
            y = truth[frame["family"].to_numpy(), frame["votes"].to_numpy()]
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope += np.rint((y - p) * _SCALE) @ x
            bend += (x * np.rint(p * (1 - p) * _SCALE)[:, None]).T @ x
        yield pd.DataFrame({"total": [np.concatenate([slope, bend.ravel()]).astype(np.int64)]})

    parts = rows.select("family", "votes", "features").mapInPandas(run, "total array<long>")
    total = np.zeros(d + d * d)
    for r in parts.select(F.posexplode("total").alias("i", "x")).where("x <> 0").groupBy("i").agg(F.sum("x").alias("x")).collect():  # d + d * d numbers
        total[r["i"]] = r["x"]
    return total[:d] / _SCALE, total[d:].reshape(d, d) / _SCALE


def train(docs: DataFrame, text_col: str = "text", ridge: float = 1.0, steps: int = STEPS) -> Model:
    """Reliabilities and span classifier from the votes on all candidates of ``docs``; no label is read.

    What reaches the driver does not grow with the table: counts of at most ``FAMILIES * VOTE_CODES`` vote codes and
    the sums of the Newton steps. A table without candidates gives a classifier that accepts nothing.
    """
    spark = docs.sparkSession
    path = write(_proposed(docs, text_col), "personal-candidates")
    rows = spark.read.schema("family int, votes int, features array<int>").parquet(path)
    counts = np.zeros((FAMILIES, VOTE_CODES))
    for r in rows.groupBy("family", "votes").count().collect():
        counts[r["family"], r["votes"]] = r["count"]
    found = [estimate(c) for c in counts]
    truth, reliability = np.stack([f[0] for f in found]), np.stack([f[1] for f in found])
    weights = np.zeros(FEATURES)
    weights[0] = -3.0
    for _ in range(steps if counts.any() else 0):
        slope, bend = _newton_sums(rows, truth, weights)
        change = np.linalg.solve(bend + ridge * np.eye(FEATURES), slope - ridge * weights)
        weights = weights + np.clip(change, -4, 4)
        if np.abs(change).max() < 1e-4:
            break
    discard(spark, path)
    return Model(truth, reliability, weights)


# -- spans ------------------------------------------------------------------------------------

def find_spans(text: str | None, model: Model, bar: float = BAR) -> list[tuple[int, int, str]]:
    """(start, end, kind) sorted by start, then kind as in ``KINDS``: all base spans, and candidates the classifier accepts.

    A proposal of kind ``card`` that is no base span is called ``account``, a phone ``dial``, an address ``net``.
    """
    if not text:
        return []
    out = []
    for c in candidates(text):
        if c.base:
            out.append((c.start, c.end, c.kind))
        elif model.probability(c.features) >= bar:
            out.append((c.start, c.end, {"card": "account", "phone": "dial", "ip": "net"}.get(c.kind, c.kind)))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, model: Model | None = None, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans`` of the whole text (a column of that name is replaced): array of (kind, start, end).

    Without a ``model`` one is trained on ``docs``. Null and empty texts have no spans; rows and other columns stay as
    they are, repeated rows have equal spans, an empty table stays empty.
    """
    model = train(docs, text_col) if model is None else model

    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def spans(texts: pd.Series) -> pd.Series:
        found = (find_spans(t if isinstance(t, str) else None, model) for t in texts)
        return pd.Series([[{"kind": k, "start": a, "end": b} for a, b, k in one] for one in found], dtype=object)

    return docs.withColumn(spans_col, spans(F.col(text_col).cast("string")))


def digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, the digest of the base spans, and all spans as text."""
    text = lambda kept: F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select(
        "doc_id", *[count(kind) for kind in BASE_KINDS], F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
