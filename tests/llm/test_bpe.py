import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelspark.llm import bpe

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_encoder_equals_library_on_odd_strings(library):
    rng = random.Random(7)
    texts = ["", " ", "  ", "a  b", "a   b", " a \n b", "a\n  b", "x \t y ", "\n \n", "a  b", "I'm we'll 'S's",
             "<|endoftext|>", "a <|endoftext|> b  <|endoftext|>", "=" * 3000, "ab" * 2000, "日本語 12½ ²", "\x1c\x1d\x85 x"]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(1, 0xd800), rng.randrange(32, 127),
                                      rng.randrange(0xe000, 0x11000)])) for _ in range(rng.randrange(40)))
              for _ in range(1500)]
    texts += ["".join(rng.choice(" \n\tab1.,'s") for _ in range(rng.randrange(30))) for _ in range(1500)]
    encoder = bpe.TextEncoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    for text, packed in zip(texts, encoder.encode(texts)):
        assert ids(packed) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_trie_equals_plain_merging():
    trie = bpe.TrieEncoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    words = {w.encode() for w in ("the then thence there thereupon a aa aaa aaaa " + "étêté zzzzzz 0000").split()}
    assert {w: ids(p) for w, p in trie.encode(words)} == {w: trie.merged(w) for w in words}


def test_digests_over_odd_rows(odd_docs, library):
    rows = odd_docs.select("doc_id", "text").collect()
    got = sorted(map(tuple, bpe.digests(odd_docs, PATH).collect()), key=str)
    want = []
    for r in rows:
        i = library.encode(r["text"] or "", add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r["doc_id"], len(i), sha(struct.pack(f"<{len(i)}I", *i)),
                     sha(library.decode(i, skip_special_tokens=False).encode())))
    assert got == sorted(want, key=str)


def test_empty_table_and_forgetting(no_docs, monkeypatch):
    assert bpe.digests(no_docs, PATH).collect() == []
    monkeypatch.setattr(bpe, "MEMO_BYTES", 100)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 3)
    encoder = bpe.TextEncoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    once = encoder.encode(["hello there world", "other words here"])
    assert once == encoder.encode(["hello there world", "other words here"])


def test_frequent_words_are_encoded_once(library, monkeypatch):
    """What is met again and again stays remembered while other pieces are forgotten, also with a mark
    after it; the ids stay the library's."""
    monkeypatch.setattr(bpe, "MEMO_BYTES", 10_000)
    encoder = bpe.TextEncoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    seen, whole = [], encoder.trie.encode
    monkeypatch.setattr(encoder.trie, "encode", lambda words: seen.extend(words) or whole(words))
    for k in range(60):
        texts = [f"a there, hello{'' if k % 2 == 0 else '!'} there " + " ".join(f"w{k}q{j} été{k}" for j in range(12))]
        for text, packed in zip(texts, encoder.encode(texts)):
            assert ids(packed) == library.encode(text, add_special_tokens=False).ids
        assert 200 * len(encoder.memo | encoder.older) <= 2 * bpe.MEMO_BYTES
    assert seen.count(b" hello") == 1


def test_guessed_states_equal_plain_merging():
    rng = random.Random(5)
    trie = bpe.TrieEncoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
    for _ in range(20):
        words = {"".join(rng.choice(["th", "e", "ing", "ci", "ó", "n", "ñ", "a", "s", "1", " "]) for _ in range(rng.randrange(1, 9))).encode()
                 for _ in range(100)}
        assert {w: ids(p) for w, p in trie.encode(words)} == {w: trie.merged(w) for w in words}
    assert trie.follow
