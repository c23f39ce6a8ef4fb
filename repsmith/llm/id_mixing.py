"""Adaptive context mixing of id predictions and an entropy coder (rANS), for many blocks at once (numpy).

A block's ids are numbered by first appearance. Three models predict the next number: order 2 and
order 1 each remember the number that last followed the same two or one before, with a confidence;
order 0 has the block's counts of what neither foretold. The prediction is the mixture

    P(x) = w2 [x = order 2's] + w1 [x = order 1's] + (1 - w2 - w1) P0(x)

whose weights are learned as the block goes, one pair for each pair of confidences. A number is one
symbol of a range of 2**24. Of order 0's part a unit goes to every number seen, WEIGHT units to every
earlier occurrence that order 0 coded and the rest to a new number. So an occurrence owns its slots:
a decoded slot names the occurrence, that the number, and no table of cumulative counts is made or
searched. New numbers' ids follow those of the whole block, their leading eight bits by counts in the
same way and the rest as it is. Everything starts anew with each block, so any block can be decoded
alone. The coder has 64-bit states and 32-bit words; it is written last number first.

Blocks are coded side by side, one per lane of the arrays, position by position: the models are
sequential inside a block but a step costs the same few array operations for any number of lanes.
"""

from __future__ import annotations

import numpy as np

#: Fixed by the format: ids of a block, slots of order 2, bits of a symbol's range, units of an occurrence.
BLOCK_IDS, SLOT_BITS = 2048, 11
RANGE_BITS, WEIGHT, HEAD_WEIGHT = 24, 4, 8
_SHIFT, _HEAD_SHIFT = WEIGHT.bit_length() - 1, HEAD_WEIGHT.bit_length() - 1
HEAD = 256
#: Weights are parts of 2**16, two in a word (order 2's above); a step goes a sixteenth of the way.
RATE, TOP, LEAST = 4, (1 << 16) - 1024, 32
_U, _P = np.uint64, np.uint32
_QUARTER, _KEEP = _P((1 << 30) + (1 << 14)), _P(0x0FFF0FFF)
_STEP = _P((TOP - LEAST) >> RATE)
_DOWN = _P((LEAST >> RATE) * 0x10001)
_HASH_A, _HASH_B, _HASH_SHIFT = np.uint16(0x9E37), np.uint16(0x85EB), np.uint16(16 - SLOT_BITS)
_START = _U(1 << 31)
_BITS, _MASK, _32 = _U(RANGE_BITS), _U((1 << RANGE_BITS) - 1), _U(32)
_ALL, _1 = _P(1 << RANGE_BITS), np.uint16(1)
#: Ids below 2**TABLE_BITS are numbered by a table of all of them.
TABLE_BITS = 20


def _at(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    return table.take(index, mode="clip")  # never out of bounds; this mode is the fastest


class _Models:
    """Orders 2 and 1 of every lane and the weights of their mixture; numbers are from 1.

    Entries are number * 8 + confidence; blocks are short enough for 16 bits. With ``counted``, order 1's
    entry of a number has its count of order 0 beside it."""

    def __init__(self, lanes: int, block: int, counted: bool = False):
        lane, width, self.counted = np.arange(lanes), (block + 1) << counted, int(counted)
        self.table = np.zeros(lanes * width + (lanes << SLOT_BITS), "<u2")  # order 1 by the number before (0: the block's start); order 2
        self.base = np.stack([lane * width, lanes * width + (lane << SLOT_BITS)])
        self.weights, self.base_w = np.full(lanes << 7, _QUARTER), lane << 7
        self.key = np.zeros((2, lanes), np.int64)  # the number before; the slot of the last two
        self.last = np.zeros(lanes, np.uint16)  # the number before as the older one of a slot
        self.one, self.pair = np.zeros(lanes, np.uint16), lane * (block + 1)  # ``counted``: order 1's entry to come; a lane's pairs of entry and count

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the first n lanes: order 1's and order 2's numbers (0: none), the weights of both."""
        self.at = self.base[:, :n] + self.key[:, :n]
        self.entry = np.stack((self.one[:n], _at(self.table, self.at[1]))) if self.counted else _at(self.table, self.at)
        number, self.trust = self.entry >> 3, self.entry & 7
        self.at_w = self.base_w[:n] + ((self.trust[1] << 4) + (self.trust[0] << 1) + (number[0] == number[1]))
        self.weight = _at(self.weights, self.at_w)
        return number, self.weight

    def learn(self, x: np.ndarray, hit: np.ndarray, in2: np.ndarray, in1: np.ndarray) -> None:
        """``x``: the number that came; ``hit``: whether orders 1 and 2 had it; ``in2``, ``in1``: 1 for the one it is coded by."""
        n = len(x)
        aim = (in2 << 16) + in1
        aim *= _STEP
        self.weights[self.at_w] = self.weight - ((self.weight >> RATE) & _KEEP) + (aim + _DOWN)
        # After a miss half the confidence; with none left, the way is given to what came.
        entry, trust = self.entry, self.trust
        missed = hit - _1  # all bits where missed
        kept = entry - (((trust + 1) >> 1) & missed) + (hit & (trust < 7))
        lost = missed & -(trust < 2).astype(np.uint16)
        self.table[self.at] = kept ^ ((kept ^ ((x << 3) + 1)) & lost)
        np.left_shift(x, self.counted, out=self.key[0, :n])
        self.key[1, :n] = (self.last[:n] + x * _HASH_B) >> _HASH_SHIFT
        np.multiply(x, _HASH_A, out=self.last[:n])

    def counts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the counts of ``x``, just learned, are in the table, and these counts (``counted``)."""
        at = self.pair[:len(x)] + x
        pair = _at(self.table.view("<u4"), at)
        self.one = pair.astype(np.uint16)
        return (at << 1) + 1, pair >> 16


def _shares(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order 2's part of the range, and that of both orders."""
    f2 = (weight >> 16) << (RANGE_BITS - 16)
    return f2, f2 + ((weight & 0xFFFF) << (RANGE_BITS - 16))


def _unit(part: np.ndarray, known: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """A unit of order 0's ``part``: ``known`` are for what was seen, a new number has the rest."""
    return part // (known + WEIGHT * seen + WEIGHT)


class _Words:
    """States of all lanes and the words that they give off (encoding: the last comes first)."""

    def __init__(self, lanes: int):
        self.lanes, self.small = lanes, np.uint16 if lanes <= 1 << 16 else np.uint32
        self.state, self.name = np.full(lanes, _START), np.arange(lanes)
        self.out: list[tuple[np.ndarray, np.ndarray]] = []

    def give(self, lane: np.ndarray) -> None:
        state = _at(self.state, lane)
        self.out.append((_at(self.name, lane).astype(self.small), state.astype(np.uint32)))
        self.state[lane] = state >> _32

    def arrange(self, lanes: np.ndarray) -> None:
        self.state, self.name = self.state[lanes], self.name[lanes]

    def push(self, value: np.ndarray, bits: int) -> None:
        """Puts plain ``bits`` on the first lanes."""
        state = self.state[:len(value)]
        short = np.flatnonzero(state >= _U(1 << 63 - bits))
        if len(short):
            self.give(short)
        state <<= _U(bits)
        state += value

    def room(self, share: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Before a symbol of ``share`` is put on the first n lanes: quotient and rest of their states."""
        share = share.astype(_U)
        short = np.flatnonzero(self.state[:n] >= share << _U(63 - RANGE_BITS))
        if len(short):
            self.give(short)
        quotient = self.state[:n] // share
        return quotient, self.state[:n] - quotient * share

    def payloads(self) -> list[bytes]:
        every = np.arange(self.lanes)
        for _ in range(2):
            self.give(every)
        lane, word = (np.concatenate(c[::-1]) for c in zip(*self.out))
        word = word[np.argsort(lane, kind="stable")].astype("<u4")
        ends = np.cumsum(np.bincount(lane, minlength=self.lanes))
        return [word[e - k:e].tobytes() for e, k in zip(ends.tolist(), np.diff(ends, prepend=0).tolist())]


def numbered(ids: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number by first appearance, from 1, per position; whether the position is a first appearance).

    ``first``: room for a value below len(ids) per possible id."""
    if first is None:
        _, at, own = np.unique(ids, return_index=True, return_inverse=True)
        at = at[own]
    else:
        ids = ids.astype(np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1, dtype=first.dtype)  # of equal ids the last one set stays
        at = first.take(ids, mode="clip")
    new = at == np.arange(len(ids), dtype=at.dtype)
    return np.cumsum(new, dtype=at.dtype).take(at, mode="clip"), new


def _slot(rest: np.ndarray, unit: np.ndarray, shift: int, count: np.ndarray, places: np.ndarray, first: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The slot of a symbol with ``count`` occurrences of 2**shift units, whose places begin at ``first``;
    the coder's rest chooses among them and ``single``, the unit that the symbol has besides."""
    own = rest // unit
    turn = own >> shift
    moved = np.where(turn < count, (_at(places, first + turn).astype(np.uint32) - turn) << shift, single - own)
    return rest + moved * unit


def _ranks(rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the symbols ``which`` of each row, in order of symbol and position: (how often each came before +
    2**16 * where its like begin; their numbers among the row's)."""
    lanes, steps = rows.shape
    out, places = np.zeros((lanes, steps), np.uint32), np.zeros((lanes, steps), np.uint16)
    position = np.arange(steps, dtype=np.uint32)
    for lo in range(0, lanes, 32):
        own = which[lo:lo + 32]
        key = np.where(own, (rows[lo:lo + 32].astype(np.uint32) << 16) + position, _P((0xFFFF << 16) + steps))  # the others go to a column of their own
        key.sort(axis=1)
        at = (key & 0xFFFF).astype(np.int64)
        begin = np.zeros(own.shape, np.uint32)
        begin[:, 1:] = position[1:] * ((key[:, 1:] >> 16) != (key[:, :-1] >> 16))
        np.maximum.accumulate(begin, axis=1, out=begin)
        line = np.arange(len(own))[:, None] * (steps + 1)
        back, turn = np.zeros(len(own) * (steps + 1), np.uint32), np.zeros((len(own), steps + 1), np.uint16)
        at += line
        back[at] = position - begin + (begin << 16)
        np.cumsum(own[:, :-1], axis=1, dtype=np.uint16, out=turn[:, 1:-1])
        out[lo:lo + 32], places[lo:lo + 32] = back.reshape(-1, steps + 1)[:, :-1], _at(turn.reshape(-1), at)
    return out, places.reshape(-1)


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transpose, in memory too; by strips, as a whole column misses every cache."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for lo in range(0, len(rows), 32):
        out[:, lo:lo + 32] = rows[lo:lo + 32].T
    return out


def encode(ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> list[bytes]:
    """One payload per block of ``block`` ids below 2**bits (8 to 32 bits)."""
    cuts = [ids[lo:lo + block] for lo in range(0, len(ids), block)]
    lanes, steps = len(cuts), max(map(len, cuts), default=0)
    if not lanes:
        return []
    rows, fresh = np.zeros((lanes, steps), np.uint16), np.zeros((lanes, steps), bool)
    room = np.zeros(1 << bits, np.uint16) if bits <= TABLE_BITS else None
    for i, own in enumerate(cuts):
        rows[i, :len(own)], fresh[i, :len(own)] = numbered(own, room)
    own_ids = [own[new[:len(own)]] for own, new in zip(cuts, fresh)]
    numbers, last = _turned(rows), len(cuts[-1])
    lanes_at = [lanes if t < last else lanes - 1 for t in range(steps)]
    # The models go forward; what the coder needs is kept for its way back.
    m = _Models(lanes, block)
    weights, coded = np.zeros((steps, lanes), np.uint32), np.ones((2, steps, lanes), bool)
    for t, n in enumerate(lanes_at):
        x = numbers[t, :n]
        guess, weights[t, :n] = m.predict(n)
        hit = guess == x
        hit1 = hit[0] > hit[1]
        m.learn(x, hit, hit[1].astype(np.uint32), hit1)
        coded[0, t, :n], coded[1, t, :n] = hit1, hit[1]
    again = ~(fresh | _turned(coded[0] | coded[1]))
    rank, places = _ranks(rows, again)
    seen, repeats = (_turned(np.cumsum(x, axis=1, dtype=np.uint16) - x) for x in (fresh, again))
    again, fresh, rank, begin = _turned(again), _turned(fresh), _turned(rank), np.arange(lanes) * steps
    words = _Words(lanes)
    _encode_ids(words, own_ids, bits)
    for t in range(steps - 1, -1, -1):
        n = lanes_at[t]
        hit1, hit2 = coded[:, t, :n].astype(np.uint32)
        new = fresh[t, :n].astype(np.uint32)
        f2, both = _shares(weights[t, :n])
        known = repeats[t, :n].astype(np.uint32) * WEIGHT + seen[t, :n]
        part, miss = _ALL - both, _P(1) - hit1 - hit2
        unit = _unit(part, known, seen[t, :n].astype(np.uint32))
        count, before = rank[t, :n] & 0xFFFF, known * unit
        f0 = unit * (count * WEIGHT + 1) + new * (part - before - unit)
        quotient, rest = words.room(f2 * hit2 + (both - f2) * hit1 + f0 * miss, n)
        slot, low = rest.astype(np.uint32), f2 * hit1 + both * miss + before * new
        old = np.flatnonzero(again[t, :n])
        if len(old):
            single = _at(repeats[t], old) * WEIGHT + _at(numbers[t], old) - _1
            slot[old] = _slot(_at(slot, old), _at(unit, old), _SHIFT, _at(count, old), places, _at(begin, old) + (_at(rank[t], old) >> 16), single)
        words.state[:n] = (quotient << _BITS) + (slot + low)
    return words.payloads()


def _encode_ids(words: _Words, own_ids: list[np.ndarray], bits: int) -> None:
    """Puts the new ids of every lane; those with most come first, so the lanes at work are a prefix."""
    size = np.array([len(x) for x in own_ids], np.int64)
    by_size = np.argsort(-size, kind="stable")
    lanes, most, tail = len(size), int(size.max()), bits - 8
    rows = np.zeros((lanes, most), np.uint32)
    for row, lane in zip(rows, by_size.tolist()):
        row[:size[lane]] = own_ids[lane]
    used = np.arange(most) < size[by_size][:, None]
    rank, places = _ranks(rows >> tail, used)
    ids, rank, begin = _turned(rows), _turned(rank), np.arange(lanes) * most
    words.arrange(by_size)
    for j, n in reversed(list(enumerate(used.sum(axis=0).tolist()))):
        words.push(ids[j, :n] & _P((1 << tail) - 1), tail)
        count, unit = rank[j, :n] & 0xFFFF, _P((1 << RANGE_BITS) // (HEAD_WEIGHT * j + HEAD))
        quotient, rest = words.room(unit * (count * HEAD_WEIGHT + 1), n)
        slot = _slot(rest.astype(np.uint32), unit, _HEAD_SHIFT, count, places, begin[:n] + (rank[j, :n] >> 16), (ids[j, :n] >> tail) + HEAD_WEIGHT * j)
        words.state[:n] = (quotient << _BITS) + slot
    words.arrange(np.argsort(by_size))


class _Reader:
    """States of all lanes, filled up from their payloads' words."""

    def __init__(self, words: list[np.ndarray]):
        self.words = np.concatenate([x for w in words for x in (w, np.zeros(2, "<u4"))]).astype(_U)
        self.at = np.cumsum([0] + [len(w) + 2 for w in words])[:-1]
        self.state = (self.words[self.at] << _32) | self.words[self.at + 1]
        self.at += 2

    def fill(self, n: int) -> None:
        short = np.flatnonzero(self.state[:n] < _START)
        if len(short):
            at = _at(self.at, short)
            self.state[short] = (_at(self.state, short) << _32) | _at(self.words, at)
            self.at[short] = at + 1

    def arrange(self, lanes: np.ndarray) -> None:
        self.state, self.at = self.state[lanes], self.at[lanes]


def decode(payloads: list[bytes], lengths: list[int], bits: int, block: int = BLOCK_IDS) -> list[np.ndarray]:
    """The ids of each block; ``lengths`` are their numbers of ids (at most ``block``)."""
    if not len(lengths):
        return []
    order = np.argsort(-np.array(lengths, np.int64), kind="stable")  # longest first: the lanes at work are a prefix
    size = np.array(lengths, np.int64)[order]
    lanes, steps = len(order), int(size[0])
    r = _Reader([np.frombuffer(payloads[i], "<u4") for i in order])
    m = _Models(lanes, block, counted=True)
    room = np.arange(lanes) * block
    numbers = np.zeros((steps, lanes), np.uint16)
    places = np.zeros(lanes * block, np.uint32)  # of order 0's occurrences: number and how many it had before
    seen_all, repeats_all = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
    ends = np.searchsorted(-size, -np.arange(steps), "left")
    for t in range(steps):
        n = int(ends[t])
        guess, weight = m.predict(n)
        f2, both = _shares(weight)
        state = r.state[:n]
        slot = (state & _MASK).astype(np.uint32)
        hit2, miss = slot < f2, slot >= both
        hit1 = ~(hit2 | miss)
        in2, in1, in0 = hit2.astype(np.uint32), hit1.astype(np.uint32), miss.astype(np.uint32)
        # Order 0, for every lane: what it gives counts where both others missed.
        seen, repeats = seen_all[:n], repeats_all[:n]
        old_units = repeats << _SHIFT
        known = old_units + seen
        part, slot0 = _ALL - both, slot - both
        unit = _unit(part, known, seen)
        own = slot0 // unit
        turn = own >> _SHIFT
        again, new = (turn < repeats).astype(np.uint32), (own >= known) & miss
        place = _at(places, room[:n] + turn)
        x = np.minimum(own - old_units, seen) + 1
        x += ((place >> 16) - x) * again
        x = (x * in0 + guess[1] * in2 + guess[0] * in1).astype(np.uint16)
        m.learn(x, guess == x, in2, in1)
        at, count = m.counts(x)
        units = count << _SHIFT
        inside = units + (((place & 0xFFFF) << _SHIFT) + (own & (WEIGHT - 1)) - units) * again
        f0 = unit * (units + 1) + (part - (known + 1) * unit) * new  # nothing has come of a new number
        state >>= _BITS
        state *= f2 * in2 + (both - f2) * in1 + f0 * in0
        state += slot - f2 * in1 + (unit * (inside - np.minimum(own, known)) - both) * in0
        r.fill(n)
        old = miss > new
        places[room[:n] + repeats] = (x.astype(np.uint32) << 16) + count  # set again by the next one unless this is ``old``
        m.table[at] = count + old
        repeats += old
        seen += new
        numbers[t, :n] = x
    own_ids = _decode_ids(r, seen_all, bits)
    back: list[np.ndarray] = [np.zeros(0, "<u4")] * lanes
    rows = _turned(numbers)
    for i, own in enumerate(order.tolist()):
        back[own] = _at(own_ids[i], rows[i, :size[i]].astype(np.int64) - 1).astype("<u4")
    return back


def _decode_ids(r: _Reader, seen: np.ndarray, bits: int) -> np.ndarray:
    """Per lane its ids by number."""
    size = seen.astype(np.int64)
    by_size = np.argsort(-size, kind="stable")
    lanes, most, tail = len(size), max(1, int(size.max())), bits - 8  # damaged blocks may have none
    ids, places = np.zeros((most, lanes), np.uint32), np.zeros((most, lanes), np.uint32)
    counts, base, lane, flat = np.zeros(lanes * HEAD, np.uint16), np.arange(lanes) * HEAD, np.arange(lanes), places.reshape(-1)
    ends = np.searchsorted(-size[by_size], -np.arange(most), "left")
    r.arrange(by_size)
    for j, n in enumerate(ends.tolist()):
        state, unit = r.state[:n], _P((1 << RANGE_BITS) // (HEAD_WEIGHT * j + HEAD))
        slot = (state & _MASK).astype(np.uint32)
        own = slot // unit
        place = _at(flat, (own >> _HEAD_SHIFT) * np.int64(lanes) + lane[:n])
        again = own < HEAD_WEIGHT * j
        head = np.where(again, place >> 16, np.minimum(own - HEAD_WEIGHT * j, HEAD - 1))
        at = base[:n] + head
        count = _at(counts, at)
        units = count.astype(np.uint32) << _HEAD_SHIFT
        inside = np.where(again, ((place & 0xFFFF) << _HEAD_SHIFT) + (own & (HEAD_WEIGHT - 1)), units) - own
        state >>= _BITS
        state *= unit * (units + 1)
        state += slot + unit * inside
        r.fill(n)
        places[j, :n] = (head << 16) + count
        counts[at] = count + _1
        ids[j, :n] = (head << tail) + (state & _U((1 << tail) - 1)).astype(np.uint32)
        state >>= _U(tail)
        r.fill(n)
    back = np.empty((lanes, most), np.uint32)
    back[by_size] = ids.T
    return back
