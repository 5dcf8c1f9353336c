from itertools import accumulate

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe_automaton, packing, repeats, simhash, toxicity, warc

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CONTENT = open(PATH, encoding="utf-8").read()
COMMON = st.text(st.characters(max_codepoint=0x17F, exclude_categories=["Cs", "Cn"]), max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.one_of(COMMON, st.text(st.characters(exclude_categories=["Cs"]), max_size=80)))
def test_automaton(text):
    mine = bpe_automaton.load(CONTENT)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert mine.encode(text) == ids
    assert mine.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(deadline=None)
@given(st.integers(1, 10_000), st.integers(1, 2048))
def test_cut(n, capacity):
    parts = packing.cut(n, capacity)
    assert [s for s, _ in parts] == [0, *accumulate(x for _, x in parts)][:-1]
    assert sum(x for _, x in parts) == n and all(x == capacity for _, x in parts[1:]) and 0 < parts[0][1] <= capacity


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 20)).map(lambda x: (x[0], x[0] + x[1]))))
def test_merged(spans):
    runs = repeats.merged(spans)
    assert {i for a, b in runs for i in range(a, b)} == {i for a, b in spans for i in range(a, b)}
    assert all(x[1] < y[0] for x, y in zip(runs, runs[1:], strict=False))


@settings(deadline=None)
@given(st.binary(max_size=300), st.integers(-(2**63), 2**63 - 1), COMMON)
def test_record_round_trip(payload, page_id, url):
    fields, found = warc.parse(warc.record("response", page_id, warc.clean_url(url), payload, warc.digest(payload), None, ""))
    assert found == payload and int(fields["Page-ID"]) == page_id


@settings(deadline=None)
@given(COMMON)
def test_fingerprint_ignores_case_and_white_space(text):
    a = text.encode()
    assert simhash.fingerprint(a) == simhash.fingerprint(b" \n".join(a.upper().split()))


@given(COMMON)
def test_sentences_have_words(text):
    assert all(s for s in toxicity.sentences(text.encode()))
