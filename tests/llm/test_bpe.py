import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hourgrid.llm import bpe
from hourgrid.llm import queries as registered
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read())


def both(library, own, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    assert got.tolist() == want
    assert own.decode(got) == library.decode(want, skip_special_tokens=False)


TEXTS = [
    "",
    " \t\n",
    "The harbour's boats aren't here; they've GONE, I'll say!",
    "a<|startoftext|>B<|endoftext|><|endoftext|",
    "<|endoftext|>",
    "café café ΑΣ ΟΔΟΣ İstanbul ŉ ß ﬁ",
    "\x00\x1c\x1d a\x1fb \x85  ​　z﻿",
    "1234 ½ ² ٣ 12,5 %",
    "日本語 русский עברית हिन्दी 👩‍👩‍👧 🇫🇷",
    "͸ Ᲊ ꟋꟜ \U00010d50 \U00011de0 \U000323b0",
    "'s''s 'S 're're",
    "x" * 20_000,
    "ab" * 5_000 + "!" * 3_000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_equals_the_library(library, own, text):
    both(library, own, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn")), max_size=60))
def test_any_text_equals_the_library(library, own, text):
    both(library, own, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "é", "'s", " ", "\n", "in", "the", "1", ".", "Σ", "<|endoftext|>"]), max_size=40))
def test_mixed_pieces_equal_the_library(library, own, pieces):
    both(library, own, "".join(pieces))


def merged_in_turns(own, word):
    """One merge after the other, the lowest rank first, without a queue."""
    raw = word.encode()
    ids = [own.first[b] for b in raw[:-1]] + [own.last[raw[-1]]]
    ranks = {(left, right): (rank, made) for rank, (left, right, made) in enumerate(own.by_rank)}
    while True:
        ranked = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        if not ranked:
            return ids
        (_, made), i = min(ranked)
        ids[i : i + 2] = [made]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcdehilnorst"), min_size=1, max_size=40))
def test_queue_equals_plain_merging(own, word):
    assert own.encode_word(word) == merged_in_turns(own, word)


def test_given_documents_equal_the_library(spark, sf_dir, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for row in table(spark, sf_dir, "documents", "doc_id", "text").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want.add((row["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = registered.queries()["op12_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want


def test_awkward_rows_and_empty_tables(spark, library):
    vocabulary = bpe.read_vocabulary(spark, PATH)
    docs = awkward(spark).selectExpr("*", "'old' AS ids")
    coded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert coded.columns == [*(c for c in docs.columns if c != "ids"), "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == docs.count()
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(empty(spark), vocabulary), vocabulary).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [320, None, -5, 10**9])], "id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd, vocabulary).orderBy("id").collect()] == ["", library.id_to_token(320)]


def test_memory_of_known_words_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 10)
    with open(PATH, "rb") as file:
        own = bpe.Vocabulary(file.read())
    text = " ".join(f"wörd{i} the" for i in range(100))
    first = own.encode(text).tolist()
    assert own.encode(text).tolist() == first
    for table_ in (own.known_words, own.known_chunks):
        assert len(table_) <= 10 and len(table_.old) <= 10
    assert "the" in own.known_chunks or "the" in own.known_chunks.old


def test_unknown_options_are_refused():
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    for change in ({"normalizer": {"type": "Precompiled"}}, {"model": spec["model"] | {"dropout": 0.1}}, {"decoder": {"type": "WordPiece"}}):
        with pytest.raises(ValueError):
            bpe.Vocabulary(json.dumps(spec | change).encode())
    spaced = {"type": "Split", "pattern": {"Regex": " ?\\w+"}, "behavior": "Removed", "invert": True}
    steps = {"type": "Sequence", "pretokenizers": [spaced, spec["pre_tokenizer"]["pretokenizers"][1]]}
    with pytest.raises(ValueError):
        bpe.Vocabulary(json.dumps(spec | {"pre_tokenizer": steps}).encode())
