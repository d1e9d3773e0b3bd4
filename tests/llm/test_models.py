"""Language profiles, quality scores, URL models."""

import math
import zlib
from collections import defaultdict

import brute_llm  # noqa: F401
import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import language, quality, url_filter


def test_gram_vectors_are_rotated_products():
    letters = language.letter_vectors(64)
    grams = np.array([[1, 2, 3], [5, 5, 5]])
    got = language.gram_vectors(grams, 64)
    for row, (a, b, c) in zip(got, grams, strict=True):
        assert (row == np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]).all()


def test_text_vectors_are_sums_of_grams():
    texts = ["Ab, cd", "", None, "a", "12 b-c", "ßé 日本語x", "..", "ab" * 30]
    got, has = language.text_vectors(texts, 128)
    assert has.tolist() == [True, False, False, True, True, True, False, True]
    for row, text in zip(got, texts, strict=True):
        classes = [ord(c) % language.LETTERS if c.isalpha() else language.LETTERS for c in " " + (text or "").lower() + " "]
        kept = [c for i, c in enumerate(classes) if c != language.LETTERS or i == 0 or classes[i - 1] != language.LETTERS]
        want = np.zeros(128)
        if any(c != language.LETTERS for c in kept):
            for i in range(len(kept) - 2):
                want += language.gram_vectors(np.array([kept[i : i + 3]]), 128)[0]
        assert (row == want).all()
    narrow, _ = language.text_vectors(texts, 128, width=3)
    assert (narrow == got).all()


def test_languages_of_held_out_documents(documents):
    got = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("lang is not null")
    rows = got.collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98


def test_language_does_not_read_its_labels(spark, documents):
    held = documents.where(language.held_out()).select("doc_id")
    changed = documents.join(held.withColumn("h", F.lit(1)), "doc_id", "left").withColumn("lang", F.when(F.col("h") == 1, "xx").otherwise(F.col("lang")))
    one, two = (sorted(map(tuple, language.identify(d).collect())) for d in (documents, changed))
    assert one == two


def test_language_of_odd_rows(odd_docs, no_docs):
    got = language.identify(odd_docs).collect()
    assert len(got) == 12
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i in (2, 3, 4, 9):
        assert (by[i].lang_pred, by[i].score) == ("und", 0)
    assert by[1].lang_pred in ("en", "de") and by[8].lang_pred != "und"
    assert language.identify(no_docs).count() == 0 and language.keep_known(no_docs).count() == 0
    kept = language.keep_known(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert kept.columns == odd_docs.columns and 2 not in [r.doc_id for r in kept.collect()]


def test_language_sample_is_bounded(documents):
    names, prototypes = language.train(documents, max_train=20).block(0)
    assert names == sorted(names) and len(names) == 4 and np.allclose(np.linalg.norm(prototypes, axis=1), 1)


def plain_language(rows):
    """doc_id -> (lang_pred, score) by the rules: letter vectors rotated and multiplied, summed, unit sums per language, cosines."""
    letters = language.letter_vectors()
    def vector(text):
        if text is None or not any(c.isalpha() for c in text.lower()):
            return None
        marks = [language.LETTERS]
        for c in text.lower():
            mark = ord(c) % language.LETTERS if c.isalpha() else language.LETTERS
            if mark != language.LETTERS or marks[-1] != language.LETTERS:
                marks.append(mark)
        if marks[-1] != language.LETTERS:
            marks.append(language.LETTERS)
        total = np.zeros(language.DIMENSIONS)
        for one, two, three in zip(marks, marks[1:], marks[2:]):
            total += np.roll(letters[one], 2).astype(int) * np.roll(letters[two], 1) * letters[three]
        return total / max(np.linalg.norm(total), 1e-12)

    sums = {}
    for i, text, lang in rows:
        v = vector(text)
        if lang is not None and v is not None and not (i is not None and zlib.crc32(str(i).encode()) % 3 == 1):
            sums[lang] = sums.get(lang, 0) + v
    names = sorted(n for n, v in sums.items() if np.any(v))
    out = []
    for i, text, _ in rows:
        v = vector(text)
        if v is None or not names:
            out.append((i, "und", 0.0))
            continue
        cosines = [float(v @ sums[n] / np.linalg.norm(sums[n])) for n in names]
        best = int(np.argmax(np.round(cosines, 4)))
        out.append((i, names[best], min(1.0, max(0.0, cosines[best]))))
    return out


def same_languages(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[0] == w[0] and abs(g[2] - w[2]) < 1e-4 and (g[1] == w[1] or g[2] < 0.05), (g, w)


def test_language_query_is_the_plain_one(spark, documents, odd_docs):
    rows = [tuple(r) for r in documents.where("doc_id % 4 = 0").select("doc_id", "text", "lang").collect()]
    rows += [tuple(r) for r in odd_docs.where("length(text) < 1000 or text is null").select("doc_id", "text", "lang").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    same_languages([(r.doc_id, r.lang_pred, r.score) for r in language.identify(frame).collect()], plain_language(rows))


def test_any_number_of_languages(spark):
    """2,000 languages with words of their own: blocks of any size give the same, and the right language."""
    rng = np.random.default_rng(12)
    rows = []
    for k in range(2000):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(6)]
        rows += [(len(rows) + j, " ".join(rng.permutation(words)), f"l{k:04d}") for j in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    one = sorted(map(tuple, language.identify(frame, block=5000).collect()))
    many = sorted(map(tuple, language.identify(frame, block=150).collect()))
    assert one == many and len(one) == 4000
    truth = {i: lang for i, _, lang in rows}
    learnt = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert np.mean([r[2] == truth[r[0]] for r in one if truth[r[0]] in learnt]) > 0.95


def test_bars_come_from_held_out_scores(spark, documents):
    """Noise of letters goes, the driver's documents stay; the report says how many."""
    rng = np.random.default_rng(3)
    noise = [(9_000_000 + i, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 1500)), None, "n", 1500) for i in range(30)]
    both = documents.unionByName(spark.createDataFrame(noise, documents.schema))
    kept = {r.doc_id for r in language.keep_known(both).select("doc_id").collect()}
    clean = {r.doc_id for r in documents.collect() if r.text and len(set(r.text.split())) > max(30, 0.2 * len(r.text.split()))}
    assert sum(i >= 9_000_000 for i in kept) <= 2 and len(clean) > 700 and len(clean - kept) <= 0.005 * len(clean)
    report = {r.lang_pred: r for r in language.known_report(both).collect()}
    assert sum(r.rows for r in report.values()) == both.count()
    assert sum(r.rows - r.dropped for r in report.values()) == len(kept)


def test_statistics_of_known_texts():
    table = quality.statistics(["AB ab!\nAB ab!", "", None, "one one two"])
    at = {name: i for i, name in enumerate(quality.STATISTICS)}
    assert table[0, at["upper"]] == pytest.approx(4 / 13) and table[0, at["shout"]] == pytest.approx(2 / 13)
    assert table[0, at["line"]] == pytest.approx(1 / 13) and table[0, at["distinct_lines"]] == 0.5
    assert table[3, at["distinct_words"]] == pytest.approx(2 / 3) and table[3, at["repeated_next"]] == 0.5
    assert (table[1] == table[2]).all() and table[1, at["empty"]] == 1 and np.isfinite(table).all()


def test_isotonic_is_the_least_squares_increasing_fit():
    p, c = np.array([1, 0, 3, 2, 9, 8]), np.array([2, 4, 5, 5, 10, 10])
    _, got = quality.isotonic(np.arange(6), p, c)
    assert (np.diff(got) >= 0).all()
    best = min(
        (sum(n * (k / n - v) ** 2 for k, n, v in zip(p, c, fit, strict=True)), fit)
        for cuts in range(32)
        for fit in [_blocks(p, c, cuts)] if all(a <= b for a, b in zip(fit, fit[1:], strict=False))
    )
    assert np.allclose(got, best[1])


def _blocks(p, c, cuts):
    out, start = [], 0
    for i in range(len(p)):
        if i == len(p) - 1 or cuts >> i & 1:
            out += [p[start : i + 1].sum() / c[start : i + 1].sum()] * (i + 1 - start)
            start = i + 1
    return tuple(out)


def test_quality_of_held_out_documents(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.score_documents(documents, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.quality is not None]
    good = [r.predicted for r in held if r.quality == 1]
    bad = [r.predicted for r in held if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.STATISTICS))).astype(np.float32)
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int)
    rows = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(600)], "doc_id long, stats array<float>, label int")
    model, again = (quality.fit(r, features=64) for r in (rows, rows.repartition(7)))
    assert np.allclose(model.beta, again.beta) and ((model.score(x) >= 0.5) == y).mean() > 0.7
    assert quality.fit(rows.where("label = 1")) is None


def test_quality_query_is_the_plain_one(spark, sf, documents):
    """Every score again from the definition: one text at a time, sums over all rows, and the increasing fit by its min-max formula."""
    docs = documents.where("doc_id % 2 = 0")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    rows = docs.select("doc_id", "text", (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) == 0).alias("c")).collect()
    marks = {}
    for r in labels.where("quality is not null").collect():
        marks.setdefault(r.doc_id, []).append(r.quality)
    stats = {r.doc_id: quality.statistics([r.text])[0].astype(np.float32).astype(float) for r in rows}
    exact = {r.doc_id: quality.statistics([r.text])[0] for r in rows}
    known = [(r.doc_id, float(np.mean(marks[r.doc_id]) >= 0.5), r.c) for r in rows if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 5 != 0]
    fit, rest = [k for k in known if not k[2]], [k for k in known if k[2]]
    table = np.stack([stats[i] for i, _, _ in fit])
    mean, scale = table.mean(axis=0), np.maximum(table.std(axis=0), 1e-6)
    rng, d, n = np.random.default_rng(7), table.shape[1], quality.FEATURES
    weights, phases = rng.normal(0, 1 / np.sqrt(d) * 1.5, (d, n)), rng.uniform(0, 2 * np.pi, n)

    def features(x):
        return np.append(np.cos(np.clip((x - mean) / scale, -6, 6) @ weights + phases) * np.sqrt(2.0 / n), 1.0)

    z, y = np.stack([features(stats[i]) for i, _, _ in fit]), np.array([label for _, label, _ in fit])
    beta = np.linalg.solve(z.T @ z + quality.RIDGE * len(fit) / n * np.eye(n + 1), z.T @ y)
    bins = {}
    for i, label, _ in rest:
        at = int(np.clip((features(stats[i]) @ beta + 0.5) / 2 * quality.BINS, 0, quality.BINS - 1))
        bins.setdefault(at, []).append(label)
    order = sorted(bins)
    hits, counts = np.array([sum(bins[b]) for b in order]), np.array([len(bins[b]) for b in order])
    share = lambda a, b: hits[a : b + 1].sum() / counts[a : b + 1].sum()
    values = [max(min(share(a, b) for b in range(i, len(order))) for a in range(i + 1)) for i in range(len(order))]
    centres = [(b + 0.5) / quality.BINS * 2 - 0.5 for b in order]
    want = {i: float(np.clip(np.interp(features(exact[i]) @ beta, centres, values), 0, 1)) for i in exact}
    assert set(got) == set(want) and len(rest) > 20
    differ = [i for i in want if abs(got[i].score - want[i]) > 1e-6]
    assert len(differ) <= 0.01 * len(want), [(got[i].score, want[i]) for i in differ[:5]]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == int(got[i].score >= 0.3) for i in got)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 1, "x"), (4, 0, "x"), (None, 1, "x"), (5, None, "x"), (8, 0, "x"), (9, 0, "x")], "doc_id long, quality int, score string")
    got = quality.score_documents(odd_docs, labels).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    none = labels.where("false")
    assert {(r.score, r.predicted) for r in quality.score_documents(odd_docs, none).collect()} == {(1.0, 1)}
    assert quality.score_documents(no_docs, labels).count() == 0
    assert quality.keep_good(odd_docs, none).count() == 12 and quality.keep_good(odd_docs, none).columns == odd_docs.columns


URLS = [
    "https://a.com/x", "http://COM/", "http://com", "https://example.com/en/1", "https://www.example.com/en/2?q=/", "http://sub.www.Example.com/en/", "http://net/es/1",
    "x.net://b.net/fr/2#a/b", "ftp://c.net/de/3", "no scheme/com/", "", None, "://", "http://d.org?x=com/", "http://d.org#/en/", "http://user@e.com:80/", "a://b://c.com/",
    "http://notcom/", "http://example.com/EN/", "http://f.com\n/x", "https://ä.org/ü", "https://a.com/x",
]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
    tail = rest[len(host) :]
    path = next((tail[:i] for i, c in enumerate(tail) if c in "?#"), tail)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(v, h, p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    verdict, h, p = max(fits, key=lambda r: len(r[1] + r[2]), default=(None, None, None))
    return host, path, h + p if verdict else None, verdict


def plain_scores(urls, order):
    """Witten-Bell models by dictionaries; score and calibrated cut."""
    import hashlib

    texts = {u or "": plain_rule(u)[3] for u in urls}
    held = {t: hashlib.md5(t.encode()).hexdigest()[0] in "012" for t in texts}
    alphabet = {c for t in texts for c in t} | {url_filter.END}
    counts = {v: defaultdict(lambda: defaultdict(int)) for v in ("allow", "block")}
    for t, v in texts.items():
        if v and not held[t]:
            s = url_filter.START * (order - 1) + t + url_filter.END
            for i in range(order - 1, len(s)):
                for k in range(order):
                    counts[v][s[i - k : i]][s[i]] += 1

    def p(v, context, c):
        low = 1 / len(alphabet) if not context and context is not None else None
        if context == "":
            low = 1 / len(alphabet)
        elif context is not None:
            low = p(v, context[1:], c)
        seen = counts[v].get(context)
        return low if not seen else (seen.get(c, 0) + len(seen) * low) / (sum(seen.values()) + len(seen))

    def score(t):
        s = url_filter.START * (order - 1) + t + url_filter.END
        ratios = [math.log(p("allow", s[i - order + 1 : i], s[i])) - math.log(p("block", s[i - order + 1 : i], s[i])) for i in range(order - 1, len(s))]
        return sum(ratios) / len(ratios)

    scores = {t: score(t) for t in texts}
    groups = [[scores[t] for t in texts if texts[t] == v and held[t]] for v in ("allow", "block")]
    if not all(groups):
        return scores, 0.0
    (a, sa), (b, sb) = ((np.mean(g), max(np.std(g), 1e-6)) for g in groups)
    return scores, (a * sb + b * sa) / (sa + sb)


def test_url_rules_and_models(spark):
    rng = np.random.default_rng(4)
    more = [f"https://{rng.choice(['shop', 'news', 'm'])}.{rng.choice(['one', 'two'])}.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.integers(0, 99)}" for _ in range(150)]
    urls = URLS + more
    rows = [(i, u, "html", "old", 7) for i, u in enumerate(urls)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, rule string, text int")
    out = url_filter.judge(frame)
    assert out.columns == ["page_id", "url", "html", "text", "host", "path", "rule", "verdict", "score"]
    got = {r.page_id: r for r in out.collect()}
    scores, cut = plain_scores(urls, url_filter.ORDER)
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain_rule(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.score == pytest.approx(scores[u or ""], abs=2e-6), u
        assert r.verdict == (verdict or ("allow" if scores[u or ""] >= cut else "block"))


def test_urls_without_labels_or_rows(spark):
    frame = spark.createDataFrame([(1, "http://a.org/"), (2, None), (None, "http://b.com/"), (3, "y" * 30_000)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(frame).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "allow", 2: "allow", None: "allow", 3: "allow"} and got[3].score == 0
    assert url_filter.judge(frame.where("false")).count() == 0


def test_url_plan_is_native(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    plan = url_filter.judge(pages)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
