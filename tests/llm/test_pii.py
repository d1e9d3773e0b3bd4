import hashlib
import re

import numpy as np
import pytest

from loadlens.llm import pii

HARD = [
    "a@b@c.d e.f@g-h.i.j. k@l", "@x.y a@b.c@d.e", "a@.b a@b..c a@b.c.", "1.2.3.4.5.6.7.8.9 256.1.1.1 0001.2.3.4 1.2.3", "+1 (555) 123-4567 190.1.2.3 +12 +1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111 4 1 1 1", "+49 30 901820 +", "x" * 50 + "@", "12" * 40, "0" * 40 + ".1.2.3", "é@é.com ü.a@ö.de a@b.ü",
]


def plain_spans(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def by_hand(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


@pytest.mark.parametrize("text", HARD)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert sorted(pii.base_spans(text)) == sorted(plain_spans(text))


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(5)
    signs = list("0123456789" * 2 + "aZ.@+- ()-") + ["4111111111111111", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(signs, 40))
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text


def test_long_runs_are_read_once():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "(at" * 50_000, "1 (" * 50_000):
        pii.candidates(text)


def test_the_query_gives_the_plain_spans_of_every_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pii.digest(pii.scan(docs.select("doc_id", "text"))).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        want = plain_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[2] == k for s in want) for k in pii.BASE_KINDS]
        assert r["base_sha256"] == by_hand(want)
        spans = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert {(k, str(a), str(b)) for a, b, k in want} <= set(spans)
        found += len(want)
    assert found > 40


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = np.random.default_rng(1)
    n, share = 20_000, 0.3
    truth = rng.random(n) < share
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.7, 0.6, 0.9, 0.85])
    speaks = np.array([1.0, 0.5, 1.0, 0.6, 1.0, 0.4, 0.8, 1.0])
    votes = np.where(rng.random((n, 8)) < right, truth[:, None], ~truth[:, None]) * 2
    votes = np.where(rng.random((n, 8)) < speaks, votes, 1)
    codes = (votes * 3 ** np.arange(7, -1, -1)).sum(axis=1)
    posterior, table = pii.estimate(np.bincount(codes, minlength=pii.VOTE_CODES).astype(float))
    assert ((posterior[codes] > 0.5) == truth).mean() > 0.97
    for i in range(8):
        said = table[i, 1, 2] / (table[i, 1, 0] + table[i, 1, 2])
        assert abs(said - right[i]) < 0.04
    assert np.abs(table.sum(axis=2) - 1).max() < 1e-9


def test_vote_codes_and_their_table():
    votes = pii.vote_table()
    assert votes.shape == (pii.VOTE_CODES, len(pii.LABELERS))
    assert votes[0].tolist() == [0] * 8 and votes[-1].tolist() == [2] * 8
    assert votes[3 * 3 + 2].tolist() == [0, 0, 0, 0, 0, 1, 0, 2]


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts with national phones beside words that say so, and numbers of the same form beside words that say otherwise."""
    rng = np.random.default_rng(9)
    number = lambda: f"({rng.integers(200, 999)}) {rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
    rows = []
    for i in range(600):
        kind = i % 3
        if kind == 0:
            text = f"please call {number()} for more"
        elif kind == 1:
            text = f"see order no {rng.integers(10**9, 10**10)}x in the list of part {i}"
        else:
            text = f"write to w{i}@mail.example.com or phone +1 {number()}, from host 10.0.{i % 200}.7"
        rows.append((i, text, kind))
    return spark.createDataFrame(rows, "doc_id long, text string, kind int")


def test_the_classifier_accepts_what_the_labelers_agree_on(labelled):
    rows = pii.scan(labelled).collect()
    phones = [any(s["kind"] == "dial" for s in r["spans"]) for r in rows if r["kind"] == 0]
    numbers = [len(r["spans"]) > 0 for r in rows if r["kind"] == 1]
    assert np.mean(phones) > 0.9 and np.mean(numbers) == 0
    for r in rows:
        spans = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] not in pii.BASE_KINDS]
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_the_model_depends_on_the_rows_only(labelled):
    one, other = pii.train(labelled.repartition(1)), pii.train(labelled.repartition(7))
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.truth, other.truth)


def test_newton_sums_are_those_of_a_plain_regression(labelled):
    texts = [r["text"] for r in labelled.collect()]
    found = [c for t in texts for c in pii.candidates(t)]
    model = pii.train(labelled)
    x = np.zeros((len(found), pii.FEATURES))
    for i, c in enumerate(found):
        x[i, c.features] = 1
    y = np.array([model.truth[pii.FAMILY[c.kind], c.votes] for c in found])
    slope = x.T @ (y - 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))) - model.weights
    assert np.abs(slope).max() < 0.05


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pii.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["spans"] == [] for r in rows if not (r["text"] or "").strip())
    assert set(odd_docs.columns) <= set(pii.scan(odd_docs).columns)
    assert pii.digest(pii.scan(no_docs)).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd")], "doc_id long, text string")
    assert [r["spans"] for r in pii.digest(pii.scan(twice)).collect()] == ["email:0:6"] * 3
