import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import phrases


def brute(rows, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by the rules, with plain dictionaries."""
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {}
        for phrase, a in f.items():
            if len(phrase) > 1 and a >= least:
                cuts = []
                for k in range(1, len(phrase)):
                    l, r = f[phrase[:k]], f[phrase[k:]]
                    cuts.append((1000000 * a * a // (l * r), k, l, r))
                found[phrase] = (a, *min(cuts))
        gone = {p[i : i + 2] for p, c in found.items() if len(p) == 3 for i in (0, 1) if 100 * c[0] >= 50 * found[p[i : i + 2]][0]}
        ranked = sorted((-s, -a, " ".join(p).encode(), l, r) for p, (a, s, _, l, r) in found.items() if p not in gone)
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(ranked[:top])]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, phrases.collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    words = ["New", "york", "CITY", "ÄB", "äb", "b.c", "to", "of", "the", "<x>", "日本", "a!b", "", "\t"]
    out = []
    for i in range(400):
        text = " ".join(rng.choice(words, rng.integers(0, 60)))
        out.append((["en", "de", None, "und"][i % 4], text.replace("the", "the\r\n") if i % 5 == 0 else text))
    out += [("en", "San Francisco bay area is here. " * 40)] * 20 + [("fr", "mot " * 5000), ("en", None), ("en", ""), (None, " \t\n. ,"), ("x\ny", "odd lang odd lang " * 9)]
    return out


def test_equal_to_plain_counts(spark, rows):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    want = brute(rows)
    assert found(docs) == want and len(want) > 50
    assert found(docs, top=5) == brute(rows, top=5)
    assert found(docs, least=300) == brute(rows, least=300)


@pytest.mark.parametrize("sizes", [phrases.Sizes(words=50, chunks=20), phrases.Sizes(vocabulary=3), phrases.Sizes(buckets=4, in_range=3), phrases.Sizes(buckets=12, in_range=12)])
def test_what_is_held_and_a_full_bucket_table_change_nothing(spark, rows, sizes):
    docs = spark.createDataFrame([(t, lang) for lang, t in rows[:200]], "text string, lang string").coalesce(2)
    assert found(docs, least=3, sizes=sizes) == brute(rows[:200], least=3)


@pytest.mark.parametrize(("period", "most"), [(1, 64), (3, 5), (1000, 7), (1 << 30, 64)])
def test_chunks_cover_each_text_and_overlap(period, most):
    rng = np.random.default_rng(period)
    texts = [[str(x).encode() for x in rng.integers(0, 9, n)] for n in (0, 1, 2, 3, 100, 5, 0, 700)]
    vocabulary = phrases._Vocabulary()
    got = collections.defaultdict(list)
    for text, chunk in phrases.parse(texts, vocabulary, period, most):
        words = [vocabulary.words[c] for c in memoryview(chunk).cast("I")]
        assert len(words) <= most + phrases.OVERLAP
        got[text].append(words)
    for i, words in enumerate(texts):
        again = [w for chunk in got[i] for w in chunk[: -phrases.OVERLAP]]
        assert again == words
        for one, two in zip(got[i], got[i][1:]):
            assert (one[-phrases.OVERLAP :] + [b""])[:1] == two[:1] or len(two) < 2
            assert one[-phrases.OVERLAP :] == (two + [b"?"])[: phrases.OVERLAP]
        if words:
            assert got[i][-1][-phrases.OVERLAP :] == [phrases.END] * phrases.OVERLAP


def test_equal_passages_are_cut_alike(spark):
    rng = np.random.default_rng(4)
    passage = [str(x) for x in rng.integers(0, 500, 4000)]
    texts = [" ".join([*map(str, rng.integers(500, 900, 50 + 31 * i)), *passage]) for i in range(6)]
    parts = phrases.parsed(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"))
    chunks = phrases.dictionary(parts).collect()
    shared = sum(len(r["chunk"].split()) for r in chunks if r["n"] == 6)
    assert shared > 3500 and sum(len(r["chunk"].split()) for r in chunks) < 4000 + 6 * 800


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l long, r long").select(phrases._score("a", "l", "r").cast("long").alias("s")).first()
    assert row["s"] == 1000000 * big * big // ((big + 1) * (big + 7))


def test_odd_rows(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute([(r["lang"], r["text"]) for r in odd_docs.select("lang", "text").collect()])
    assert phrases.collocations(no_docs).count() == 0
    clash = odd_docs.withColumns({"chunk": F.lit(1), "phrase": F.lit("p"), "n": F.lit(2), "k": F.lit(3)})
    assert found(clash, least=2) == found(odd_docs, least=2)
