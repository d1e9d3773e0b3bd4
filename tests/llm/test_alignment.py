import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loadlens.llm import alignment

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SOME = [
    "the quick brown fox", "The quick brown fox's  100 €\n\n é", None, "", " ", " \t x", "日本語 のテキスト", "a <|endoftext|> b <s> </s> <unk> <0x41>", "low ▁ mark",
    "ß", "naïve café", "the the the the the the", "x" * 3000, "emoji 😀😀 here", "tabs\tand\r\nlines", "nul \x00 byte", "the quick brown fox", "  leading and trailing  ",
]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def expected(texts, tools):
    """The contract word by word: all overlapping occurrence pairs, counted over all texts."""
    coder_a, coder_b = tools
    bytes_a = alignment._byte_level("byte_bpe_50k.json")

    def piece(i):
        p = coder_b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if coder_b.is_byte(i) else p.replace("▁", " ").encode()

    rows, documents = [], collections.Counter()
    for text in texts:
        a = coder_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = coder_b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != raw or b"".join(piece(i) for i in b) != raw:
            rows.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(bytes_a[i]) for i in a]), np.cumsum([len(piece(i)) for i in b])
        spans = [list(zip([0, *ends], ends)) for ends in (ends_a.tolist(), ends_b.tolist())]
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = []
        for low, high in zip([0, *cuts], cuts):
            ids = [[x for x, (s, e) in zip(tokens, part) if low <= s and e <= high] for tokens, part in ((a, spans[0]), (b, spans[1]))]
            groups.append("|".join(",".join(map(str, part)) for part in ids))
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        documents.update(set(links))
    best = {}
    for (x, _), n in documents.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None
        else (*r[:3], len(r[3]), sum(documents[p] == best[p[0]] for p in r[3]), sum(documents[p] for p in r[3]), r[4])
        for r in rows
    ]


@pytest.mark.parametrize("options", [{}, {"block_docs": 3}, {"block_chars": 1}])
def test_equal_to_all_pairs_of_overlapping_tokens(spark, tools, options):
    docs = spark.createDataFrame(list(enumerate(SOME)), "doc_id long, text string").repartition(2)
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, **options).collect()}
    assert [rows[i] for i in range(len(SOME))] == expected(SOME, tools)


def test_documents_of_the_driver(spark, sf, tools):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(150)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs).collect()}
    assert rows == dict(zip(texts, expected(list(texts.values()), tools), strict=True))


def test_pair_counts_of_postings(spark, tools):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SOME * 3)], "doc_id long, text string")
    _, postings = alignment.index(docs, block_docs=7)
    counts = {(r["a"], r["b"]): (r["count"], r["links"]) for r in alignment.pair_counts(postings).collect()}
    one = collections.Counter()
    for text, row in zip(SOME, expected(SOME, tools), strict=True):
        one[row[-1] != ""] += row[3]
    assert sum(n for _, n in counts.values()) == 3 * one[True]
    assert all(0 < n_docs <= links and n_docs % 3 == 0 for n_docs, links in counts.values())


def test_odd_rows(spark, odd_docs, no_docs):
    rows = alignment.align(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(tuple(r[c] for c in COLUMNS))
    assert len(by[1]) == 1 and by[5] == by[6]
    assert by[2] == by[3] == {(0, 0, 0, 0, 0, 0, "")}
    assert len(by[None]) == 2
    assert alignment.align(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 8, 9, 600, 8192])
def test_bitmaps_and_planes_come_back(size):
    rng = np.random.default_rng(size)
    packed, planes, want = [], [], []
    for i in range(40):
        places = np.sort(rng.choice(size, rng.integers(1, min(size, 4 ** (i % 7) + 1) + 1), replace=False))
        times = rng.integers(1, 1 + 3 ** (i % 6), len(places))
        packed.append(alignment._pack_places(places, size))
        planes.append(alignment._pack_planes(times))
        want += [(i, p, t) for p, t in zip(places.tolist(), times.tolist())]
    sizes = np.bincount([w[0] for w in want], minlength=40)
    row, place = alignment._unpack_all(packed, sizes, size)
    assert list(zip(row.tolist(), place.tolist(), alignment._unpack_planes(planes, sizes).tolist())) == want


def test_parts_of_a_block_merge():
    block = alignment._Block()
    block.add(np.array([5, 5, 9]), np.array([0, 0, 1]))
    block.docs = 2
    block.add(np.array([5, 7]), np.array([2, 2]))
    block.docs = 3
    (frame,) = block.postings(1)
    rows = {(r.a << alignment._B_BITS) + r.b: (r.n_docs, r.n_links) for r in frame.itertuples()}
    assert rows == {5: (2, 3), 7: (1, 1), 9: (1, 1)}


def test_a_block_has_no_more_places_than_bits(no_docs):
    with pytest.raises(ValueError):
        alignment.index(no_docs, block_docs=1 << 15)
