"""Encoding against the tokenizers library."""

import hashlib
import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from keelson.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def awkward_texts():
    rng = random.Random(2)
    pool = [chr(c) for c in [*range(0x250), *range(0x300, 0x310), 0x2028, 0x3000, 0x180E, 0x200B, 0xFEFF, 0x4E00, 0x1F600]]
    pool += [" "] * 60 + list("aaaaaabth'") * 10
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 150))) for _ in range(400)]
    return [*texts, "", " ", "\n\n  x", "a<|endoftext|>b <|endoftext|>", "aaaaaaaaa aaaa aaa", "it's we'll 'S x'd"]


def test_equals_library():
    texts = awkward_texts()
    encoder = bpe.Encoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert bpe.decode(want, encoder.vocabulary.bytes_of) == LIBRARY.decode(want, skip_special_tokens=False)


def test_parts_and_forgetting(monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 50)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 20)
    encoder = bpe.Encoder(PATH)
    for text in awkward_texts()[:60] + ["word  and more\n\n words " * 40]:
        assert encoder.encode([text])[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_table(rows_of, prose):
    found = {(r["key"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(rows_of(prose), PATH).collect()}
    want = set()
    for key, text in prose:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False))]
        want.add((key, len(ids), *sha))
    assert found == want
    assert bpe.digests(rows_of([]), PATH).count() == 0


def test_ids_and_texts(rows_of):
    found = bpe.encode(rows_of([(1, "Hello there"), (2, None)]), PATH).orderBy("key").collect()
    assert [r["decoded"] for r in found] == ["Hello there", ""]
    assert found[0]["ids"] == LIBRARY.encode("Hello there").ids
    assert found[1]["ids"] == []


@pytest.mark.parametrize("words", [[b"a"], [b"a", b"", b"bc"], [b"banana"] * 3])
def test_words_one_by_one(words):
    vocabulary = bpe.Vocabulary(PATH)
    ids, starts = bpe.encode_words(words, vocabulary)
    for k, word in enumerate(words):
        alone = bpe.encode_words([word], vocabulary)[0] if word else ids[:0]
        assert ids[starts[k]:starts[k + 1]].tolist() == alone.tolist()
