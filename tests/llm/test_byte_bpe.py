import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tessera.llm import byte_bpe as B
from tessera.llm import queries as Q

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, ids string, n_tokens int"
ALPHABET = "abc dEÉéßΣçñ'sت中文한글1234567890٣½ \t\n\x0b\x1c\x85\xa0!?.,#$%…—“😀👍🏽é'll'RE<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def mine():
    return B.make(PATH, public_tokenizers.PATTERN)


def texts(seed, n):
    r = random.Random(seed)
    out = ["", " ", "a", "<|endoftext|>", "x" * 3000, "ab" * 700, "!" * 300, "\n" * 500 + "x", " " * 400, "1" * 99, "'s't're've'm'll'd don't I'LL", "\x00\x01\x1f 　x"]
    out += ["".join(r.choice(ALPHABET) for _ in range(r.randint(1, 60))) for _ in range(n)]
    out += ["".join(r.choice("abehtinsr") for _ in range(r.randint(1, 40))) for _ in range(n)]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_library(library, mine, seed):
    for t in texts(seed, 500):
        want = library.encode_ordinary(t)
        assert mine.encode(t) == want, t
        assert mine.vocabulary.decode(want) == t.encode()


def test_every_code_point(library, mine):
    points = [chr(i) for i in (*range(0xD800), *range(0xE000, 0x110000))]
    for k in range(0, len(points), 2000):
        part = points[k : k + 2000]
        for t in (" ".join(part), "x".join(part), "1".join(part), "!".join(part), "".join(part)):
            assert mine.encode(t) == library.encode_ordinary(t), hex(ord(part[0]))


def test_every_token_is_its_own_word(mine):
    for token, rank in B.read_ranks(PATH).items():
        assert mine.vocabulary.encode_word(token) == [rank]


def test_merging_goes_by_the_ranks(mine):
    """The heap alone, against repeated search for the smallest rank, leftmost first."""
    ranks, r = B.read_ranks(PATH), random.Random(5)
    for _ in range(300):
        word = bytes(r.choice(b"aabtheinor s\xc3\xa9\xff") for _ in range(r.randint(1, 40)))
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert mine.vocabulary.merge(word) == [ranks[p] for p in parts]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 30_000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = [f"k{i}".encode() for i in range(n)]
    found = B.MinimalPerfectHash(keys)
    assert sorted(found.slot(k) for k in keys) == list(range(n))
    assert [found.slot(k) for k in keys] == found.slots.tolist()
    assert all(0 <= found.slot(f"other{i}".encode()) < n for i in range(1000))


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="single bytes"):
        B.Vocabulary({b"a": 0})


def test_long_words_and_long_white_space(library, mine):
    r = random.Random(3)
    word = "".join(r.choice("abcdefghij") for _ in range(200_000))
    assert mine.vocabulary.decode(mine.encode(word)) == word.encode()
    assert mine.encode(word[:20_000]) == library.encode_ordinary(word[:20_000])
    blank = " " * 2_000_000 + "x"
    ids = mine.encode(blank)
    assert mine.vocabulary.decode(ids) == blank.encode() and ids[-1:] == library.encode_ordinary(" x")
    assert mine.encode(" " * 1000 + "x") == library.encode_ordinary(" " * 1000 + "x")


def test_caches_are_bounded(library, monkeypatch):
    monkeypatch.setattr(B, "MOST_HELD", 500)
    monkeypatch.setattr(B, "MOST_JOINED", 20)
    small = B.make(PATH, public_tokenizers.PATTERN)
    for t in texts(11, 60):
        ids, decoded = small.both(t)
        assert ids == " ".join(map(str, library.encode_ordinary(t))) and decoded == t.encode()
        assert small.held <= 500 + 20 * len(t.encode()) and len(small.vocabulary.joined) <= 20


def test_latin_texts_split_alike(library, mine):
    every, r = [chr(c) for c in range(256)], random.Random(12)
    for _ in range(3000):
        t = "".join(r.choice(every) for _ in range(r.randint(1, 30)))
        assert mine.pre_split(t) == mine.words(t), ascii(t)


def test_defined_cases(spark, library):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "null id <|endoftext|>"), (5, "x" * 300_000), *((10 + i, t) for i, t in enumerate(texts(9, 40)))]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], DOCS)
    got = B.digests(docs, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    encoded = B.encode(docs, PATH, public_tokenizers.PATTERN)
    assert sorted((str(x.doc_id), bytes(x.decoded)) for x in B.decode(encoded, PATH).collect()) == sorted((str(i), (t or "").encode()) for i, t in rows)
    assert B.decode(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>"), PATH).collect()[0].decoded == b""


def test_empty_table(spark):
    assert B.digests(spark.createDataFrame([], DOCS), PATH, public_tokenizers.PATTERN).collect() == []


def test_query_against_the_library(spark, sf, library):
    got = {x.doc_id: x for x in Q.op11_two_tier_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, x = library.encode_ordinary(d.text or ""), got[d.doc_id]
        assert x.n_tokens == len(ids) and x.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
