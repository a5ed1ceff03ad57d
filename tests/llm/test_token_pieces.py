"""Ids of pieces equal the library's on odd texts; what is remembered stays bounded."""

from __future__ import annotations

import random
import sys

import numpy as np
import pytest

from mercato.llm import rans


@pytest.fixture(scope="module")
def path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_the_librarys_on_odd_texts(path, monkeypatch):
    monkeypatch.setattr(rans, "CHUNK_BYTES", 300)
    ours = rans.PieceTokenizer(path)
    r = random.Random(6)
    parts = ["a", "the", "Ünï", "é", "x1", "12", "'s", "don't", "…", "»", "×", "日本", " ", "  ", "\n", "\n\n", "\t", " ",
             "\u0085", " ", "　", "\x1c", "\0", ",", ".", "%%%", "<", "<|", "<|endoftext|>", "|>", "😀", "é", "ª", "A.B", "_"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    got = ours.encode(texts)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == ours.library.encode(text, add_special_tokens=False).ids, text


def test_long_odd_texts_are_not_remembered(path, monkeypatch):
    monkeypatch.setattr(rans, "KNOWN_BYTES", 100_000)
    ours = rans.PieceTokenizer(path)
    r = random.Random(2)
    for k in range(30):
        odd = ["  ".join("".join(r.choices("abcdef", k=9)) for _ in range(200)) for _ in range(20)]  # no safe place to cut
        plain = [" ".join("".join(r.choices("abcdef", k=9)) for _ in range(200)) for _ in range(20)]
        for text, raw in zip(odd + plain, ours.encode(odd + plain)):
            if k % 10 == 0:
                assert np.frombuffer(raw, "<u4").tolist() == ours.library.encode(text, add_special_tokens=False).ids
        held = sum(sys.getsizeof(p) + sys.getsizeof(i) for d in (ours.young, ours.old) for p, i in d.items())
        assert held < 2 * (100_000 + 4000 * rans.ENTRY), held
        assert all(len(p) <= rans.SHORT for d in (ours.young, ours.old) for p in d)


def _words(r: random.Random, n: int, size: int) -> list[str]:
    words: set[str] = set()
    while len(words) < n:
        words.add("".join(r.choices("abcdefgh", k=size)))
    return sorted(words)


def test_known_pieces_never_reach_the_library_again(path, monkeypatch):
    monkeypatch.setattr(rans, "KNOWN_BYTES", 33 << 15)
    ours = rans.PieceTokenizer(path)
    words = _words(random.Random(3), 11_000, 6)  # a dictionary's entries for these take more than twice the bytes
    texts = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)]
    first = [ours.encode([t])[0] for t in texts]
    asked, encode = [], ours._ids
    monkeypatch.setattr(ours, "_ids", lambda text: asked.append(text) or encode(text))
    assert [ours.encode([t])[0] for t in texts] == first
    assert not asked
    for text, raw in zip(texts, first):
        assert np.frombuffer(raw, "<u4").tolist() == ours.library.encode(text, add_special_tokens=False).ids
    assert sum(a.nbytes for a in vars(ours.table).values() if isinstance(a, np.ndarray)) <= rans.KNOWN_BYTES


def test_a_full_table_keeps_what_is_asked_for(path, monkeypatch):
    monkeypatch.setattr(rans, "KNOWN_BYTES", 33 << 8)
    ours = rans.PieceTokenizer(path)
    r = random.Random(4)
    common, asked, encode = _words(r, 20, 5), [], ours._ids
    monkeypatch.setattr(ours, "_ids", lambda text: asked.append(text) or encode(text))
    for k in range(40):
        text = "x " + " ".join(common + _words(r, 30, 9) + common + ["abc\0", "abc\0\0", "a" * (13 + k % 5), "é" * (6 + k % 3)]) + " x"
        del asked[:]
        got = ours.encode([text])[0]
        assert np.frombuffer(got, "<u4").tolist() == ours.library.encode(text, add_special_tokens=False).ids
        assert not k or not any(w in common for part in asked for w in part.split())
        assert ours.table.count <= ours.table.most and ours.table.used <= len(ours.table.ids)
