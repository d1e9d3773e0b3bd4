import brute_llm as brute
import numpy as np
import pytest

from loadlens.llm import setsketch, vectors
from loadlens.llm import text_kernels as kernels


@pytest.fixture(scope="module")
def groups(prose):
    """Originals, copies with few to many changed words, boilerplate, and short texts."""
    rng = np.random.default_rng(1)
    docs, i = {}, 0
    shared = prose(999, 60)
    for g in range(14):
        base = prose(g, int(rng.integers(4, 160)), 5000)
        for _ in range(int(rng.integers(1, 12))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(0, len(copy)))] = f"x{rng.integers(0, 9999)}"
            docs[i] = " ".join(copy + (shared if rng.random() < 0.3 else []))
            i += 1
    docs |= {i: "One Two", i + 1: "one  two", i + 2: "", i + 3: "one two three"}
    return docs


def near(spark, docs, **options):
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    return {r.doc_id: r for r in setsketch.near_duplicates(frame, **options).collect()}


def test_near_duplicates_are_those_of_brute_force(spark, groups):
    got, want = near(spark, groups), brute.near_duplicates(groups)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_blocks_do_not_change_the_result(spark, groups, monkeypatch):
    from loadlens.llm.buckets import block_groups

    small = lambda rows, key, node, block=3, *weights: block_groups(rows, key, node, 3, *weights)
    monkeypatch.setattr(setsketch, "block_groups", small)
    monkeypatch.setattr(setsketch, "VERIFY_SHINGLES", 150)
    got = near(spark, groups)
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in brute.near_duplicates(groups).items()}


def test_comparing_with_the_first_row_does_not_change_the_result(spark, groups):
    got = near(spark, groups, large=2)
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in brute.near_duplicates(groups).items()}


def test_hub_first_keeps_components():
    from loadlens.llm.buckets import hub_first

    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(2, 14))
        links = np.triu(rng.random((n, n)) < rng.random(), 1)
        links |= links.T
        asked = []

        def test(a, b):
            asked.append(len(a))
            return links[a, b] & (a != b)

        cut = int(rng.integers(1, n))
        left, right = np.arange(cut), np.arange(cut, n)
        for one, two, want in ((np.arange(n), None, links), (left, right, np.where((np.arange(n) < cut)[:, None] != (np.arange(n) < cut), links, False))):
            a, b = hub_first(one, two, test, 5)
            got = brute.components(range(n), zip(a.tolist(), b.tolist(), strict=True))
            full = brute.components(range(n), np.argwhere(links).tolist())
            least = brute.components(range(n), np.argwhere(want).tolist())
            # never more than all links join, never less than the wanted ones
            assert all(full[i] == full[j] for i in range(n) for j in range(n) if got[i] == got[j])
            assert all(got[i] == got[j] for i in range(n) for j in range(n) if least[i] == least[j])
        asked.clear()
        links[:] = True
        hub_first(np.arange(n), None, test)
        assert sum(asked) == n - 1


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.6, 0.9):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2**63, int(800 * share), dtype=np.uint64)
            own = rng.integers(0, 2**63, (2, (800 - len(both)) // 2), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, x])) for x in own)
            s = setsketch.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            true = len(both) / 800
            errors.append(setsketch.estimate(s[:1], s[1:], np.array([len(a)]), np.array([len(b)]))[0] - true)
            union = np.union1d(a, b)
            assert (setsketch.merge(s[0], s[1]) == setsketch.sketch(union, np.array([0, len(union)]))[0]).all()
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08
    assert (setsketch.sketch(np.empty(0, np.uint64), np.array([0, 0])) == 0).all()


def test_pairs_at_the_threshold_are_plausible():
    rng = np.random.default_rng(5)
    kept = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, 300, dtype=np.uint64)
        own = rng.integers(0, 2**63, (2, 50), dtype=np.uint64)
        sets = [np.unique(np.concatenate([both, x])) for x in own]
        s = setsketch.sketch(np.concatenate(sets), np.array([0, 350, 700]))
        kept += int(setsketch.plausible(s[:1], s[1:], np.array([350]), np.array([350]))[0])
    assert kept >= 299


def test_odd_rows(spark, odd_docs, no_docs):
    got = setsketch.near_duplicates(odd_docs).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == 12 and by[6].component_id == 5 and not by[6].kept and by[5].n_shingles == 119_996
    for i in (2, 3, 4):
        assert by[i].n_shingles == 0 and by[i].component_id == i and by[i].kept
    assert [r.component_id for r in got if r.doc_id == 1] == [1, 1]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    first = setsketch.keep_first(odd_docs)
    assert sorted((r.doc_id for r in first.collect()), key=str) == [1, 2, 3, 4, 5, 7, 8, 9, None, None] and first.columns == odd_docs.columns
    assert setsketch.near_duplicates(no_docs).count() == 0 and setsketch.keep_first(no_docs).count() == 0


def test_no_python_on_pairs_and_no_cross_join(spark, groups):
    frame = spark.createDataFrame(list(groups.items()), "doc_id long, text string")
    plan = setsketch.near_duplicates(frame)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def cosine_brute(rows, bar):
    usable = {}
    for i, label, v in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = (label, np.array(v, float))
    links = [
        (a, b) for a in usable for b in usable if a < b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1])
        and usable[a][1] @ usable[b][1] / (np.linalg.norm(usable[a][1]) * np.linalg.norm(usable[b][1])) >= bar
    ]
    ids = [r[0] for r in rows]
    count = {i: sum(i in p for p in links) for i in ids}
    return {i: (count[i], c) for i, c in brute.components(ids, links).items()}


@pytest.fixture(scope="module")
def vector_rows():
    rng = np.random.default_rng(8)
    rows = []
    for g in range(12):
        centre = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 9))):
            v = centre + rng.normal(size=32) * rng.choice([0.0, 0.05, 0.15])
            rows.append((len(rows), int(rng.integers(0, 2)), (v * rng.choice([1.0, 2.0])).astype(np.float32).tolist()))
    n = len(rows)
    rows += [(n, 0, None), (n + 1, 0, [0.0] * 32), (n + 2, 0, [float("nan")] + [1.0] * 31), (n + 3, None, rows[0][2]), (n + 4, rows[0][1], rows[0][2])]
    return [*rows, (n + 5, 0, [None] + [1.0] * 31), (n + 6, 0, []), (n + 7, rows[0][1], rows[0][2][:16]), (n + 8, 0, [float("inf")] + [1.0] * 31)]


def test_vectors_are_linked_as_by_brute_force(spark, vector_rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in vector_rows], "vec_id long, label int, embedding array<float>, node string, keys int")
    got = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == cosine_brute(vector_rows, 0.93)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_vector_blocks_do_not_change_counts(spark, vector_rows, monkeypatch):
    from loadlens.llm.buckets import block_groups

    monkeypatch.setattr(vectors, "block_groups", lambda rows, key, node: block_groups(rows, key, node, 2))
    frame = spark.createDataFrame(vector_rows, "vec_id long, label int, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    assert got == cosine_brute(vector_rows, 0.93)


def test_repeated_and_missing_vector_rows(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (None, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0])]
    kind = "vec_id long, label int, embedding array<float>"
    got = vectors.near_duplicates(spark.createDataFrame(rows, kind)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in got) == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert vectors.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_recall_at_the_bar():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    for rows in (500, 50_000, 500_000):
        size = vectors.sized(rows)
        assert (vectors.bucket_keys(a, *size) == vectors.bucket_keys(c, *size)).any(axis=1).mean() >= 0.997
    for other, cosine in ((b, 0.0), (c, 0.93)):
        together = (vectors.bucket_keys(a, 400, 1) == vectors.bucket_keys(other, 400, 1)).mean()
        assert abs(together - vectors.meeting(cosine)) < 0.01


def test_candidates_do_not_grow_with_rows():
    rng = np.random.default_rng(4)
    for rows in (1_000, 4_000, 16_000):
        v = rng.normal(size=(rows, 64))
        size = vectors.sized(rows)
        keys = vectors.bucket_keys(v / np.linalg.norm(v, axis=1, keepdims=True), *size)
        partners = sum(int((n * (n - 1)).sum()) for n in (np.unique(k, return_counts=True)[1] for k in keys.T)) / rows
        assert partners <= 1.3 * vectors.STRANGERS * size[0]
    assert vectors.sized(0)[0] >= 1 and vectors.sized(10, cosine=1.0)[0] == 1
    assert [vectors.sized(10**p)[1] for p in (3, 5, 8)] == sorted(vectors.sized(10**p)[1] for p in (3, 5, 8))


def test_set_names_follow_sets():
    hashes, bounds = kernels.shingle_sets(["a b c d e f", "A b c d e f", "a b c d e g", ""])
    names = setsketch._class_of(hashes, bounds)
    assert names[0] == names[1] != names[2]


def test_rows_without_an_id_are_linked(spark, prose):
    """Two texts that are linked through one without an id, and a near copy without an id."""
    words = prose(1, 100, 100_000)
    bridge = words[:90] + prose(2, 4, 100_000) + words[94:]
    far = prose(3, 8, 100_000) + bridge[8:]
    rows = [(1, " ".join(words)), (None, " ".join(bridge)), (None, " ".join(bridge)), (2, " ".join(far)), (None, " ".join(prose(4, 50))), (3, " ".join(prose(5, 50)))]
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, bridge, far)]
    share = lambda a, b: len(a & b) / len(a | b)
    assert share(*shingles[:2]) >= 0.75 and share(*shingles[1:]) >= 0.75 > share(shingles[0], shingles[2])
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(1, 1, True), (None, 1, False), (None, 1, False), (2, 1, False), (None, None, True), (3, 3, True)], key=str
    )


def test_an_id_with_two_texts_keeps_what_is_in_no_group(spark, prose):
    """Equal ids in two groups both stay; what lost to a smaller id goes; of equal ids in one group the first by content stays."""
    one, two, other = (" ".join(prose(n, 50, 100_000)) for n in (6, 7, 8))
    rows = [(5, one, "b"), (5, one, "a"), (5, two, "a"), (7, one, "a"), (7, other, "a"), (8, other, "z"), (None, two, "a"), (9, None, "b"), (9, "", "a")]
    for seed in (1, 2):
        frame = spark.createDataFrame(rows[::-1] if seed == 2 else rows, "doc_id long, text string, source string").repartition(seed * 2)
        got = [tuple(r) for r in setsketch.keep_first(frame).collect()]
        assert sorted(got, key=str) == sorted([(5, one, "a"), (5, two, "a"), (7, other, "a"), (9, None, "b")], key=str)


def test_copies_without_an_id_are_decided(spark, prose):
    """They go if their group has an id; a group without any keeps one row; others and blank texts stay."""
    one, two, three = (" ".join(prose(n, 50, 100_000)) for n in (16, 17, 18))
    rows = [(1, one, "a"), (None, one, "a"), (None, one + " more", "b"), (None, two, "b"), (None, two, "a"), (None, two + " more", "c"), (None, three, "a"), (None, "", "a"), (None, "", "a"), (None, None, "b")]
    got = [tuple(r) for r in setsketch.keep_first(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()]
    assert (1, one, "a") in got and (None, three, "a") in got and sum(r[1] == "" for r in got) == 2 and (None, None, "b") in got
    of_two = [r for r in got if r[1] and r[1].startswith(two)]
    assert len(of_two) == 1 and of_two[0] in ((None, two, "a"), (None, two + " more", "c")) and len(got) == 6


def test_few_bits_change_nothing(spark, groups, monkeypatch):
    """Where the table of bits tells nothing, the joins do."""
    from loadlens.llm import bits

    frame = spark.createDataFrame([(i, t, i % 3) for i, t in groups.items()] + [(0, groups[0], 9)], "doc_id long, text string, source int")
    want = sorted(map(tuple, setsketch.keep_first(frame).collect()))
    monkeypatch.setattr(setsketch, "bit_table", lambda rows, hashed: bits.bit_table(rows, hashed, 3))
    assert sorted(map(tuple, setsketch.keep_first(frame).collect())) == want
    assert {r[0] for r in want} == {c for _, c in brute.near_duplicates(groups).values()}


def test_bit_tables_know_their_rows(spark):
    from pyspark.sql import functions as F

    from loadlens.llm import bits

    rows = spark.range(5000).select((F.col("id") * 7 - 100).alias("_may"), F.xxhash64("id").alias("h"))

    def held(frame, table):
        marked, name = bits.may_hold(frame, table, F.col("h"))
        assert set(frame.columns) < set(marked.columns) and marked.count() == frame.count()
        return marked.where(name).count()

    for size in (3, 15, 26):
        table = bits.bit_table(rows, F.col("h"), size)
        assert table.size == 2 ** min(size, 17) and held(rows, table) == 5000
    others = spark.range(10_000, 20_000).select(F.xxhash64("id").alias("h"))
    assert 100 < held(others, bits.bit_table(rows, F.col("h"))) < 900
    assert held(others, bits.bit_table(rows.limit(0), F.col("h"))) == 0


def test_scratch_tables_pass_away(spark):
    from loadlens.llm import scratch

    with scratch.passing(spark) as tables:
        gone, kept = scratch.write(spark.range(3), "one"), scratch.write(spark.range(3), "two")
        tables.remove(kept)
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
