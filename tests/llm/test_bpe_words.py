"""Splitting, lookups, merging and memo of the byte-level BPE against their plain forms."""

import importlib.util
import random

import numpy as np
import pytest
import regex

from spindle.llm import bpe

tokenizers = pytest.mark.skipif(not importlib.util.find_spec("public_tokenizers"), reason="no tokenizer files")
PUBLISHED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.fixture(scope="module")
def codec():
    from spindle.llm.queries import tokenizer_path

    return bpe.Codec(tokenizer_path(), None)


def test_splitting_equals_the_published_pattern():
    want, own, rng = regex.compile(PUBLISHED).findall, bpe._splitter(), random.Random(1)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for c in every:  # each character by its class, with neighbours of every kind
        assert own(f"a{c} 1{c}") == want(f"a{c} 1{c}")
    kinds = ["aabstrevmld  \n\t'’1٣²Ⅷ.,<_\x1c\x85\xa0　é日́", every[:0xD000], every]
    for kind in kinds:
        for _ in range(3000):
            text = "".join(rng.choice(kind if rng.random() < 0.7 else "  \n'st") for _ in range(rng.randrange(40)))
            assert own(text) == want(text)


def test_lookup_tells_keys_from_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 5000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        keys = np.concatenate([keys, keys + (1 << 50)])  # distinct, many of them near each other's places
        found = bpe.Lookup(keys, np.arange(len(keys), dtype=np.int32) * 2, -5)
        asked = np.concatenate([keys, rng.integers(1 << 51, 1 << 52, 9000)])
        assert found.get(asked).tolist() == [*range(0, 2 * len(keys), 2)] + [-5] * 9000


@tokenizers
def test_many_words_merge_like_one(codec):
    rng = random.Random(2)
    words = ["".join(rng.choice("aabehrstion ée日🙂.1") for _ in range(rng.randrange(90))).encode() for _ in range(3000)]
    words += [b"", b"a", b"ab" * 32, b"a" * 64, b"a" * 65, b"ab" * 400, b" the", b" the"]
    want = [codec.merger.merge(w) for w in words]
    assert codec.merger.merge_all(words) == want
    assert [codec.merger.merge_all([w])[0] for w in words[-8:]] == want[-8:] and codec.merger.merge_all([]) == []
    held = sorted({w for w in words[::2] if 0 < len(w) <= bpe.LEXICON_WORD_BYTES})
    lexicon = bpe.Transducer(bpe.Transducer.compile([(w, codec.merger.merge(w)) for w in held]))
    assert dict(lexicon.find(words)) == {i: ids for i, (w, ids) in enumerate(zip(words, want)) if w in set(held)}
    assert dict(bpe.Transducer(bpe.Transducer.compile([])).find(words)) == {}


@tokenizers
def test_a_full_memo_keeps_the_words_in_use(codec):
    asked, whole = [], codec.word_ids
    small = bpe.Codec.__new__(bpe.Codec)
    small.__dict__ |= codec.__dict__ | {"known": {}, "older": {}, "form": None, "most": 20}
    small.word_ids = lambda words: asked.extend(words) or whole(words)
    texts = [f"the same words and w{i}x" for i in range(200)]
    for text in texts:  # a group of its own each
        assert small.encode(text) == [i for w in codec.words(text) for i in codec.merger.merge(w.encode())]
    assert [asked.count(w) for w in ("the", " same", " words", " and")] == [1] * 4
    assert len(small.known) + len(small.older) <= 20 + 2 * 6
