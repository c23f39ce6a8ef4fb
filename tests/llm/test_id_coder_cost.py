import random

import numpy as np
import pytest

from repsmith.llm import _tokens, id_mixing
from test_id_files import WORD_BPE, direct, encoded, stream


def gathered(monkeypatch, run):
    """Elements that the coder looked up in tables."""
    total = 0
    at = id_mixing._at

    def counting(table, index):
        nonlocal total
        total += np.size(index)
        return at(table, index)
    with monkeypatch.context() as m:
        m.setattr(id_mixing, "_at", counting)
        out = run()
    return total, out


@pytest.mark.parametrize("kind", ["zipf", "noise", "phrases"])
def test_a_slot_names_its_number_without_a_search(monkeypatch, kind):
    ids = stream(kind, 32 * 2048)
    there, payloads = gathered(monkeypatch, lambda: id_mixing.encode(ids, 16))
    back, own = gathered(monkeypatch, lambda: id_mixing.decode(payloads, [2048] * 32, 16))
    assert (np.concatenate(own) == ids).all()
    assert back < 12 * len(ids) and there < 20 * len(ids)


def test_many_blocks_of_odd_lengths():
    ids = np.concatenate([stream(k, n, s) for s, (k, n) in enumerate([("zipf", 700), ("noise", 300), ("phrases", 900), ("one", 1000), ("distinct", 513)])])
    for block in (1, 2, 63, 2048):
        lengths = [min(block, len(ids) - i) for i in range(0, len(ids), block)]
        payloads = id_mixing.encode(ids, 17, block)
        mixed = random.Random(block).sample(range(len(lengths)), len(lengths))
        back = id_mixing.decode([payloads[i] for i in mixed], [lengths[i] for i in mixed], 17, block)
        assert all((own == ids[i * block:i * block + lengths[i]]).all() for i, own in zip(mixed, back))


def test_ids_too_wide_for_a_table_are_numbered_alike():
    ids = stream("zipf", 5000)
    assert id_mixing.TABLE_BITS < 24
    wide, narrow = id_mixing.encode(ids, 24, 512), id_mixing.encode(ids, 16, 512)
    lengths = [512] * 9 + [392]
    assert all((a == b).all() for a, b in zip(id_mixing.decode(wide, lengths, 24, 512), id_mixing.decode(narrow, lengths, 16, 512), strict=True))


def test_any_words_decode_to_something():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 40):
        payload = r.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4").tobytes()
        assert len(id_mixing.decode([payload], [500], 16)[0]) == 500


def latin_texts():
    r = random.Random(9)
    parts = ["ÄÖÜ", "äöüß", "é", "É", "é", "ñ", "×", "÷", "ÿ", "Ÿ", "þÞ", "a", "Z", "0", "17", ",", "--", "¿", "«", "µ", "ª", "́", "œ", "ĳ", "Å", "Å", "ọ̈", "x" * 9, "É" * 9, "<|endoftext|>", "'s", "�"]
    return ["".join(r.choice(parts) + r.choice(["", "", " ", "\n"]) for _ in range(r.randint(1, 25))) for _ in range(600)]


def test_latin_letters_are_pieces_like_others():
    e, texts = _tokens.Encoder(WORD_BPE, 1), latin_texts()
    assert encoded(texts, e) == [direct(t) for t in texts]
    whole: list[bytes] = []
    e._tokenize = lambda words, f=e._tokenize: whole.extend(words) or f(words)
    texts = ["Größe, größe; Señor-señor 1é2", "À la carte"]
    assert encoded(texts, e) == [direct(t) for t in texts] and not whole


@pytest.mark.parametrize("name", ["_hashes", "_pair_hashes"])
def test_long_pieces_of_one_hash_are_told_apart(monkeypatch, name):
    monkeypatch.setattr(_tokens, name, lambda a, b, c: np.full(len(b), 5, np.uint64))
    e = _tokens.Encoder(WORD_BPE, 1)
    words = ["abcdefgh", "abcdefghi", "hgfedcba", "abcdefghabcdefgh", "abcdefgh" * 3, "abcdefghxabcdefghxabcdefgh", "abcdefghyabcdefghyabcdefgh", "abcdefghyabcdefghzabcdefgh"]
    texts = [" ".join(random.Random(k).choices(words, k=12)) for k in range(20)]
    for lo in (0, 10):
        assert encoded(texts[lo:lo + 10], e) == [direct(t) for t in texts[lo:lo + 10]]


def test_a_worker_meets_a_word_once_in_a_run(monkeypatch):
    met: list[bytes] = []
    monkeypatch.setattr(_tokens, "_kept", {})
    monkeypatch.setattr(_tokens.Encoder, "_model_ids", lambda self, words, f=_tokens.Encoder._model_ids: met.extend(words) or f(self, words))
    for run in ("a", "a", "b"):  # two tasks of one run, one of another
        assert encoded(["two words", "two more"], _tokens.kept_encoder(run, WORD_BPE, 1)) == [direct("two words"), direct("two more")]
    assert sorted(met) == sorted([b"two", b"words", b"more"] * 2)


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(_tokens, "KNOWN_BYTES", 1 << 20)
    e, r = _tokens.Encoder(WORD_BPE, 1), random.Random(1)
    for _ in range(12):
        text = " ".join("".join(r.choices("abcdefghij", k=12)) for _ in range(3000))
        assert encoded([text], e) == [direct(text)]
        assert e._bytes() < 4 << 20
