"""Token ids of whole texts from those of their pieces (numpy, inside tasks).

For vocabularies whose normaliser, pre-tokenizer and special tokens never reach across ASCII white
space, a text's ids are those of its words in turn; where such a vocabulary also lower-cases and cuts
text into runs of letters, single digits and runs of the rest, those of plain words are the ids of such
pieces. Plain are words of printable ASCII and the letters of U+00C0 to U+00FF, which are in normal form
C beside each other. Words with an apostrophe, a ``<`` (contractions, special tokens), a control
character or anything else stay whole. ``fits`` tests a tokenizer file for this.

Only distinct pieces meet the tokenizer. They are found by a key: a short piece's bytes and length are
the key, a longer one's is a hash and is verified on its bytes.
"""

from __future__ import annotations

import codecs
import json

import numpy as np

from repsmith.llm._text import _BYTE, PIECE, Prefix, mix, same_bytes

#: Bytes at which a worker forgets its remembered pieces and their ids.
KNOWN_BYTES, BATCH, JOINED = 96 << 20, 20_000, 500
#: Fixed by the vocabularies meant here: the pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SEPARATOR, _LETTER, _DIGIT, _OTHER, _ODD = 0, 1, 2, 3, 4
#: Bytes up to which a piece is its own key, and up to which its first and last 8 bytes are all of it.
SHORT, MIDDLE = 7, 16
_A, _HASHED = np.uint64(0x9E3779B97F4A7C15), np.uint64(1 << 63)
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(8)] + [0], np.uint64)  # the first n bytes of eight


def _at(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    return table.take(index, mode="clip")  # never out of bounds; this mode is the fastest


def _tables() -> tuple[bytes, bytes]:
    """Per byte its class and its lower case."""
    kind = np.full(256, _OTHER, np.uint8)
    kind[:32] = kind[127:] = kind[[39, 60]] = _ODD
    kind[[9, 10, 11, 12, 13, 32]] = _SEPARATOR
    kind[48:58] = _DIGIT
    kind[65:91] = kind[97:123] = _LETTER
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kind.tobytes(), lower.tobytes()


KIND, LOWER = _tables()
#: Of U+00C0 to U+00FF, whose first byte is LATIN, the second bytes of the two signs and of what is a lower-case letter.
_LATIN, _TIMES, _DIVIDED, _LATIN_LOWER = 0xC3, 0x97, 0xB7, 0x9F


def fits(path: str) -> bool:
    """Whether the tokenizer file lower-cases, drops white space and cuts by PATTERN."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (any(s["type"] == "Lowercase" for s in steps) and bool(cuts) and cuts[0].get("pattern") == {"Regex": PATTERN}
            and cuts[0].get("behavior") == "Removed" and all("<" in t["content"] for t in spec.get("added_tokens", [])))


def _letters(tokenizer) -> str | None:
    """The model's letter for every byte of a plain piece, if plain pieces need nothing else before the model."""
    spec = json.loads(tokenizer.to_str())
    steps = {s["type"] for s in spec["normalizer"]["normalizers"]}
    then = [(c["type"], c.get("add_prefix_space"), c.get("use_regex")) for c in spec["pre_tokenizer"]["pretokenizers"][1:]]
    if not steps <= {"NFC", "Replace", "Lowercase"} or spec["post_processor"] or then != [("ByteLevel", False, False)]:
        return None
    from tokenizers import pre_tokenizers
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = [chr(b) for b in range(256)]
    for c in map(chr, [*range(33, 127), *range(0xC0, 0x100)]):
        for byte, letter in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True):
            letters[byte] = letter
    return "".join(letters)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the bytes with plain words in lower case; starts, ends, whether of a word kept whole; bounds per row) of the rows' pieces."""
    raw = data.tobytes()
    kind = np.array(np.frombuffer(raw.translate(KIND), np.uint8))
    lowered = np.array(np.frombuffer(raw.translate(LOWER), np.uint8))
    latin = np.flatnonzero(data[:-1] == _LATIN)
    second = data[latin + 1]
    letter = (second != _TIMES) & (second != _DIVIDED)
    latin, second = latin[letter] + 1, second[letter]
    kind[latin - 1] = kind[latin] = _LETTER
    lowered[latin[second < _LATIN_LOWER]] += 32
    # A run of one class ends where the next begins; a digit is a run of its own.
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    cut[offsets] = True
    cuts = np.flatnonzero(cut)
    inside = np.flatnonzero(_at(kind, cuts[:-1]) != _SEPARATOR) if len(kind) else cuts[:0]
    starts, ends = _at(cuts, inside), _at(cuts, inside + 1)
    whole = np.zeros(len(starts), bool)
    odd = kind[starts] == _ODD
    if odd.any():
        first = np.ones(len(starts), bool)
        first[1:] = (starts[1:] != ends[:-1]) | np.isin(starts[1:], offsets)
        word = np.cumsum(first) - 1
        of_word = np.zeros(word[-1] + 1, bool)
        of_word[word[odd]] = True
        whole = of_word[word]
        ends = np.where(whole, ends[np.append(np.flatnonzero(first)[1:], len(first))[word] - 1], ends)
        kept = ~whole | first
        starts, ends, whole = starts[kept], ends[kept], whole[kept]
        spread = np.zeros(len(data) + 1, np.int8)  # as they are: special tokens are told apart by case
        spread[starts[whole]] += 1
        spread[ends[whole]] -= 1
        lowered = np.where(np.cumsum(spread[:-1], dtype=np.int8) > 0, data, lowered)
    return lowered, starts, ends, whole, np.searchsorted(starts, offsets)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        lo = starts[at]
        out[at:end] = Prefix(_BYTE[data[lo:ends[end - 1]]])(starts[at:end] - lo, ends[at:end] - lo)
        at = end
    return out


def _cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ranges' bytes one after the other, where each ends)."""
    size = ends - starts
    stops = np.cumsum(size)
    return data[np.arange(int(size.sum())) + np.repeat(starts - (stops - size), size)], stops


def _pair_hashes(head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(head * _A ^ mix(tail + size.astype(np.uint64)))


class _Pieces:
    """Pieces of a slice: ``key`` (bytes and length of those up to 7 bytes, else the top bit and a hash), the
    first and last 8 bytes of those that have so many."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.size = data, starts, ends - starts
        room = np.concatenate((data, np.zeros(8, np.uint8)))
        window = np.ndarray((len(data) + 1,), "<u8", room, strides=(1,))  # the 8 bytes from every place on
        self.head = window[starts]
        short = np.minimum(self.size, 8)
        self.key = (self.head & _FIRST[short]) | (short.astype(np.uint64) << np.uint64(56))
        self.tail = self.head.copy()
        middle = np.flatnonzero(self.size > SHORT)
        self.tail[middle] = window[ends[middle] - 8]
        self.key[middle] = _pair_hashes(self.head[middle], self.tail[middle], self.size[middle]) | _HASHED
        long = np.flatnonzero(self.size > MIDDLE)
        if len(long):
            own, stops = _cut_out(data, starts[long], ends[long])
            self.key[long] = _hashes(own, np.append(0, stops[:-1]), stops) | _HASHED


class _Pool:
    """An array that grows at its end."""

    def __init__(self, dtype: type, size: int = 0):
        self.room, self.size = np.zeros(1 << 12, dtype), size

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.room):
            room = np.zeros(max(end, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.all
            self.room = room
        self.room[self.size:end] = values
        self.size = end

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.size]


class Encoder:
    """Encodes slices of texts; what it remembers is bounded and goes with the object."""

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _letters(self.tokenizer)
        self.end_id = end_id
        mark = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else -1
        self._forget()

    def _forget(self) -> None:
        self.key, self.head, self.tail, self.length = _Pool(np.uint64), _Pool(np.uint64), _Pool(np.uint64), _Pool(np.int32)
        self.text, self.text_end = _Pool(np.uint8), _Pool(np.int32)  # of pieces over MIDDLE bytes
        self.ids, self.ids_end = _Pool(np.uint32), _Pool(np.int32, 1)
        self.slots = np.full(1 << 14, -1, np.int32)  # open addressing: the place of each known piece

    def _bytes(self) -> int:
        pools = (self.key, self.head, self.tail, self.length, self.text, self.text_end, self.ids, self.ids_end)
        return self.slots.nbytes + sum(pool.room.nbytes for pool in pools)

    def _single(self, words: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for lo in range(0, len(words), BATCH)
                for e in self.tokenizer.encode_batch_fast([w.decode() for w in words[lo:lo + BATCH]], add_special_tokens=False)]

    def _tokenize(self, words: list[bytes]) -> tuple[list[int], list[np.ndarray], np.ndarray]:
        """(the words' order, ids in this order, their number per word). Words without a 0 go through the
        tokenizer in long texts, with 0s between them: it sets every digit apart, so the 0s' ids mark
        where a word ends."""
        order: list[int] = []
        flat: list[np.ndarray] = []
        size: list[np.ndarray] = []
        left = [i for i, w in enumerate(words) if b"0" in w or self.mark < 0]
        joined = [i for i, w in enumerate(words) if b"0" not in w] if self.mark >= 0 else []
        groups = [joined[lo:lo + JOINED] for lo in range(0, len(joined), JOINED)]
        for group, ids in zip(groups, self._single([b" 0 ".join([words[i] for i in g]) for g in groups])):
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(group) - 1:
                order += group
                flat.append(ids[ids != self.mark])
                size.append(np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1)
            else:
                left += group
        single = self._single([words[i] for i in left])
        return order + left, flat + single, np.concatenate([*size, np.array([len(x) for x in single], np.int64)])

    def _model_ids(self, words: list[bytes]) -> tuple[list[int], list[np.ndarray], np.ndarray]:
        """The same for plain pieces: each is one word of the model."""
        model = self.tokenizer.model.tokenize
        texts = codecs.charmap_decode(b"\n".join(words), "strict", self.letters)[0].split("\n")
        ids: list[int] = []
        ends = []
        for text in texts:
            ids += [t.id for t in model(text)]
            ends.append(len(ids))
        return list(range(len(words))), [np.array(ids, np.uint32)], np.diff(ends, prepend=0)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * _A) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _enter(self, places: np.ndarray) -> None:
        slot, last = self._slot(self.key.all[places]), len(self.slots) - 1
        while len(places):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = places[free]
            lost = self.slots[slot] != places
            places, slot = places[lost], (slot[lost] + 1) & last

    def _learn(self, p: _Pieces, new: np.ndarray, whole: np.ndarray) -> None:
        """Adds the pieces ``new``, each unlike the others and unknown."""
        raw = p.data.tobytes()
        plain = ~whole[new] & (self.letters is not None)
        for own, tokenize in ((new[plain], self._model_ids), (new[~plain], self._tokenize)):
            if not len(own):
                continue
            words = [raw[a:b] for a, b in zip(p.starts[own].tolist(), (p.starts[own] + p.size[own]).tolist())]
            order, ids, size = tokenize(words)
            own, known = own[order], self.key.size
            for pool, values in ((self.key, p.key), (self.head, p.head), (self.tail, p.tail), (self.length, p.size)):
                pool.add(values[own])
            text, stops = _cut_out(p.data, p.starts[own], p.starts[own] + np.where(p.size[own] > MIDDLE, p.size[own], 0))
            self.text_end.add(self.text.size + stops)
            self.text.add(text)
            self.ids_end.add(self.ids_end.all[-1] + np.cumsum(size))
            self.ids.add(np.concatenate(ids))
            if 2 * self.key.size > len(self.slots):
                self.slots = np.full(4 << self.key.size.bit_length(), -1, np.int32)
                known = 0
            self._enter(np.arange(known, self.key.size))

    def _find(self, p: _Pieces, left: np.ndarray, place: np.ndarray) -> None:
        """Sets the place among the known pieces of each of the pieces ``left`` that is one of them."""
        last, key = len(self.slots) - 1, _at(p.key, left)
        slot = self._slot(key)
        while len(left):
            at = _at(self.slots, slot)
            same = (_at(self.key.room, at) == key) & (at >= 0)
            hashed = np.flatnonzero(same & (key >= _HASHED))
            if len(hashed):
                same[hashed] = self._same(p, _at(left, hashed), _at(at, hashed).astype(np.int64))
            hit, on = np.flatnonzero(same), np.flatnonzero(~same & (at >= 0))
            place[_at(left, hit)] = _at(at, hit)
            left, key, slot = _at(left, on), _at(key, on), (_at(slot, on) + 1) & last

    def _same(self, p: _Pieces, which: np.ndarray, at: np.ndarray) -> np.ndarray:
        size = _at(p.size, which)
        same = (size == _at(self.length.room, at)) & (_at(p.head, which) == _at(self.head.room, at)) & (_at(p.tail, which) == _at(self.tail.room, at))
        long = np.flatnonzero(same & (size > MIDDLE))
        if len(long):
            start, end, size = p.starts[which[long]], self.text_end.room[at[long]].astype(np.int64), size[long]
            same[long] = same_bytes(p.data, start, start + size, self.text.all, end - size, end)
        return same

    def _places(self, p: _Pieces, whole: np.ndarray) -> np.ndarray:
        """The place of each piece among the known ones, those that are new added."""
        if self._bytes() > KNOWN_BYTES:
            self._forget()
        place = np.full(len(p.key), -1, np.int64)
        self._find(p, np.arange(len(place)), place)
        new = np.flatnonzero(place < 0)
        while len(new):  # once, unless unlike pieces share a hash
            self._learn(p, new[np.unique(p.key[new], return_index=True)[1]], whole)
            self._find(p, new, place)
            new = new[place[new] < 0]
        return place

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, length per row) of the rows data[offsets[i]:offsets[i + 1]], each with the end id."""
        lowered, starts, ends, whole, bounds = pieces(data, offsets)
        place = self._places(_Pieces(lowered, starts, ends), whole)
        begin = _at(self.ids_end.room, place).astype(np.int64)
        run = bounds[1:] + np.arange(len(offsets) - 1)  # where a row's end id is among its pieces
        n = np.insert(_at(self.ids_end.room, place + 1) - begin, bounds[1:], 1)
        stops = np.cumsum(n)
        at = np.arange(int(n.sum())) + np.repeat(np.insert(begin, bounds[1:], 0) - (stops - n), n)
        tail = stops[run]
        at[tail - 1] = 0
        ids = _at(self.ids.room, at)
        ids[tail - 1] = self.end_id
        return ids, np.diff(tail, prepend=0)


class WholeTexts:
    """The same for any tokenizer: texts are encoded as they are."""

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        ids = [[*e.ids, self.end_id] for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for own in ids for i in own], np.uint32), np.array([len(i) for i in ids], np.int64)


def encoder(path: str, end_id: int) -> Encoder | WholeTexts:
    """The faster of the two that is right for the tokenizer file."""
    return Encoder(path, end_id) if fits(path) else WholeTexts(path, end_id)


_kept: dict[tuple[str, str, int], Encoder | WholeTexts] = {}


def kept_encoder(run: str, path: str, end_id: int) -> Encoder | WholeTexts:
    """The encoder that this Python worker keeps from task to task of one ``run``: most words come again.
    Another run begins with a new one."""
    if (run, path, end_id) not in _kept:
        _kept.clear()
        _kept[run, path, end_id] = encoder(path, end_id)
    return _kept[run, path, end_id]
