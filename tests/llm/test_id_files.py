import functools
import random
import zlib

import numpy as np
import pytest

from repsmith.llm import _tokens, id_files, id_mixing
from repsmith.llm._text import slices
from repsmith.llm.queries import tokenizer

WORD_BPE = tokenizer("word_bpe_49k.json")


@functools.cache
def whole_text_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD_BPE)


def direct(text, end_id=1):
    return whole_text_tokenizer().encode(text or "", add_special_tokens=False).ids + [end_id]


def stream(kind, n, seed=0):
    r = np.random.default_rng(seed)
    return {"zipf": lambda: r.zipf(1.3, n) % 49_408, "noise": lambda: r.integers(0, 1 << 16, n), "one": lambda: np.full(n, 7),
            "distinct": lambda: r.permutation(1 << 16)[:n], "phrases": lambda: np.concatenate([r.integers(0, 300, 40)] * (n // 40 + 1))[:n]}[kind]().astype(np.uint32)


@pytest.mark.parametrize("kind", ["zipf", "noise", "one", "distinct", "phrases"])
@pytest.mark.parametrize("n,block", [(0, 64), (1, 64), (64, 64), (5000, 700), (9000, 2048)])
def test_blocks_round_trip_and_stand_alone(kind, n, block):
    ids = stream(kind, n)
    payloads = id_mixing.encode(ids, 16, block)
    lengths = [min(block, n - i) for i in range(0, n, block)]
    back = id_mixing.decode(payloads, lengths, 16, block)
    assert len(payloads) == len(lengths) and (np.concatenate([*back, ids[:0]]) == ids).all()
    for i in range(len(lengths)):  # a block alone, coded or decoded, is the same
        own = ids[i * block:(i + 1) * block]
        assert id_mixing.encode(own, 16, block) == [payloads[i]]
        assert (id_mixing.decode([payloads[i]], [lengths[i]], 16, block)[0] == own).all()


def test_predictions_shorten_the_code():
    bits = lambda kind: 8 * sum(map(len, id_mixing.encode(stream(kind, 8192), 16))) / 8192
    assert bits("one") < 0.1 and bits("phrases") < 1 and bits("noise") < 16.8
    skew = stream("zipf", 8192)
    share = np.unique(skew, return_counts=True)[1] / len(skew)
    assert bits("zipf") < -(share * np.log2(share)).sum() + 2  # adaptive, so close to the entropy of the counts


@pytest.mark.parametrize("bits", [8, 9, 24, 32])
def test_wide_and_narrow_ids(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 500, dtype=np.uint64).astype(np.uint32)
    ids[:2] = (1 << bits) - 1, 0
    assert (np.concatenate(id_mixing.decode(id_mixing.encode(ids, bits, 128), [128] * 3 + [116], bits, 128)) == ids).all()


def segment():
    ids = stream("zipf", 3000)
    entries = np.array([(5, 1, 0, 10), (9, 1, 0, 2980), (0, 0, 1, 10)], id_files.ENTRY)
    return ids, id_files.write_segment(3, 77, 4, entries, ids, 512) + id_files.END


def test_segment_parts_and_single_blocks():
    ids, raw = segment()
    s = id_files.parse_segment(raw)
    assert (s.part, s.first_id, s.first_doc, s.entries["ids"].tolist(), s.entries["more"].tolist()) == (3, 77, 4, [10, 2980, 10], [0, 0, 1])
    assert all((id_files.read_block(raw, i) == ids[i * 512:(i + 1) * 512]).all() for i in range(6))


def test_every_damaged_byte_is_noticed():
    ids, raw = segment()
    for at in [*range(0, 60), *range(60, len(raw), 97), len(raw) - 1]:
        bad = raw[:at] + bytes([raw[at] ^ 4]) + raw[at + 1:]
        with pytest.raises(ValueError):
            id_files.segment_ids(id_files.parse_segment(bad))
    for bad in (b"", raw[:-1], raw[:100], raw + b"\0", b"x" + raw):
        with pytest.raises(ValueError):
            id_files.segment_ids(id_files.parse_segment(bad))


def odd_texts():
    r = random.Random(4)
    pieces = ["Hello", "world's", "don't", "it'll", "x0y00", "0", "007", "3.14", "!!", "__a_b", "É", "é", "ﬁn", "日本", "<|endoftext|>", "<|EndOfText|>", "a<|startoftext|>b", "\x00", "\x1c", "\x85", " ",
              " ", "½", "²", "ÀÉ'S", "'S", "'", "``", "😀a", "́", "ΑΣ", "naïve", "A1b2", "&&&", "\t", "\n", "\r\n", "  ", "ẞ", "İ", "\x7f"]
    return ["".join(r.choice(pieces) + r.choice(["", " ", "", "\n"]) for _ in range(r.randint(0, 30))) for _ in range(400)]


def encoded(texts, encoder):
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    out = []
    for _, _, data, at in slices(batch, "text"):
        ids, n = encoder(data, at)
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_encoder_equals_whole_texts(monkeypatch):
    texts = [*odd_texts(), None, "", "word " * 300_000, "y" * 3000]
    assert encoded(texts, _tokens.Encoder(WORD_BPE, 1)) == [direct(t) for t in texts]
    monkeypatch.setattr(_tokens, "KNOWN_BYTES", 100)
    e = _tokens.Encoder(WORD_BPE, 1)
    for lo in range(0, 400, 40):
        assert encoded(texts[lo:lo + 40], e) == [direct(t) for t in texts[lo:lo + 40]]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(_tokens, "_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    e = _tokens.Encoder(WORD_BPE, 1)
    for texts in (["one two six ten one", "two three"], ["six eight", "one two <|endoftext|>"]):
        assert encoded(texts, e) == [direct(t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer
    path = tokenizer("byte_bpe_50k.json")
    e, plain = _tokens.encoder(path, 3), Tokenizer.from_file(path)
    assert isinstance(e, _tokens.WholeTexts) and isinstance(_tokens.encoder(WORD_BPE, 3), _tokens.Encoder)
    texts = odd_texts()[:60] + [None, ""]
    assert encoded(texts, e) == [plain.encode(t or "", add_special_tokens=False).ids + [3] for t in texts]


DOCS = "doc_id long, text string, part string, n string, at string"


def digests(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(direct(t), "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(id_files, "SEGMENT_IDS", 1000)
    texts = odd_texts()
    rows = [(i * 7 % 400 - 50, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "long text 1 " * 2000), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS).repartition(5)
    got = id_files.round_trip(docs, WORD_BPE).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted((i is not None, i or 0, *x) for i, *x in digests(rows))


def test_rows_of_one_id_and_their_ids(spark, scratch):
    rows = [(3, "same"), (3, "same"), (3, "other text"), (1, "first"), (None, "a"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    id_files.write_ids(docs, scratch + "/ids", WORD_BPE, 1)
    entries = id_files.read_entries(spark, scratch + "/ids", with_ids=True)
    assert sorted((r.doc_id or 0, r.ids) for r in entries.collect()) == sorted((i or 0, direct(t)) for i, t in rows)
    placed = sorted((r.start, r.n_tokens, r.doc_id) for r in id_files.documents_of(entries).collect())
    assert [p[0] for p in placed] == [sum(n for _, n, _ in placed[:k]) for k in range(6)] and [p[2] for p in placed] == [None, None, 1, 3, 3, 3]


def test_no_documents(spark):
    assert id_files.round_trip(spark.createDataFrame([], DOCS), WORD_BPE).count() == 0
