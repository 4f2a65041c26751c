"""Adaptive context-mixing range coder for blocks of token ids.

Every block starts from the same state. For each id, the two ids before it and
the one before it each point to the id that followed last time (order 2 and
order 1), with a count of how often that held. The better of the two is the
candidate. How likely it is right is mixed, logistically and with weights that
learn, from what the states of both orders and the overall rate (order 0)
promised so far. A candidate that is wrong is followed by the id itself, high
byte and low byte, under adaptive order-0 frequencies. The probabilities drive a
range coder with 64 bits of state that writes 16-bit words.

What followed a context is learned with every id. Rates, weights and frequencies
learn at the steps RATES_AT and LOW_AT, from all ids since the last one, so that
in between the mix is one table: a probability for each pair of states.

Blocks are coded side by side: one step handles the next id of all of them as
arrays. All arithmetic is on integers, or on single floats whose results
IEEE 754 fixes, so blocks decode alike everywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

SLOTS = 1 << 11  # contexts of order 1 and 2 a block tells apart
MOST = 7  # highest count of a state
STATES = 128  # pairs of counts, and whether both orders say the same
CELLS = 36  # rates that are learned
CLASSES = 16  # low bytes have frequencies by high byte, the last for all others
CHANCE = 12  # bits of a candidate's probability
TOTAL = 16  # bits of a byte's frequency
RATE = 12  # bits by which a weight's error is scaled down
MOST_WEIGHT = 1 << 18
GAIN = 15  # added to a symbol's frequency; 16 bits hold that 4096 times
RATES_AT = {8, 32} | set(range(64, 1 << 16, 128))
LOW_AT = {32, 128} | set(range(512, 1 << 16, 1024))
ROWS = 1 << 10  # rows of frequencies cumulated at once

WORD = 16  # bits of a word
LEAST = 1 << 48  # an interval below this takes another word; a step takes 44 bits at most

U = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logit of a 12-bit probability in 1/256, and back from -2048 .. 2047, which lies at 0 .. 4095."""
    squash = [4096 / (1 + math.exp(-(x - 2048) / 256)) for x in range(4096)]
    stretch = [256 * math.log((p + 0.5) / (4095.5 - p)) for p in range(4096)]
    clip = [max(1, min(4095, round(p))) for p in squash]
    return np.array([round(s) for s in stretch], np.int64), np.array(clip, np.int64)


_STRETCH, _SQUASH = _tables()
_PLACES = np.arange(1, 256, dtype=np.uint16)


def _after() -> tuple[np.ndarray, np.ndarray]:
    """By twice a count, plus one if its id came: what is added to the state, and the bits that stay."""
    add, stay = np.zeros(16, np.uint32), np.zeros(16, np.uint32)
    for held in range(MOST + 1):
        stay[2 * held + 1], add[2 * held + 1] = 0xFFFFFFFF, held < MOST
        if held > 2:
            stay[2 * held], add[2 * held] = 0xFFFFFFFF, (1 << 32) - 2
    return add, stay


_ADD, _STAY = _after()


class _Frequencies:
    """Adaptive frequencies of bytes in rows, so many for each block."""

    def __init__(self, blocks: int, rows: int):
        self.rows = rows
        self.count = np.ones(blocks * rows * 256, np.uint16)
        # where each symbol starts; each row ends at 65536, which is the 0 of the next row
        self.start = np.zeros(blocks * rows * 256 + 1, np.uint16)
        self.start[:-1].reshape(-1, 256)[:] = np.arange(256) << (TOTAL - 8)
        self.parts = self.start[:-1].reshape(-1, 16)
        self.coarse = self.start[:-1:16].reshape(-1, 16).copy()

    def learn(self, blocks: int, at: np.ndarray) -> None:
        """Add the symbols with these places, then cumulate the rows of the first blocks."""
        np.add.at(self.count, at, np.uint16(GAIN))
        last = blocks * self.rows
        for first in range(0, last, ROWS):
            rows = slice(first, min(first + ROWS, last))
            run = self.count.reshape(-1, 256)[rows].astype(np.int32)
            np.cumsum(run, axis=1, out=run)
            scaled = run.astype(np.float32)
            scaled *= np.float32((1 << TOTAL) - 257) / scaled[:, -1:]
            start = self.start[:-1].reshape(-1, 256)[rows]
            np.add(scaled[:, :-1].astype(np.uint16), _PLACES, out=start[:, 1:])
            self.coarse[rows] = start[:, ::16]

    def span(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of symbols by their places."""
        low = self.start.take(at, mode="clip")
        width = self.start.take(at + 1, mode="clip")
        width -= low
        return low.astype(U), width.astype(U)

    def find(self, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The places of the symbols whose spans hold the values."""
        value = value[:, None]
        row = row << 4
        row += _upto(self.coarse.take(row >> 4, axis=0, mode="clip"), value)
        at = row << 4
        at += _upto(self.parts.take(row, axis=0, mode="clip"), value)
        return at


def _upto(rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The place of the last of 16 ascending numbers that is no larger than the value."""
    held = np.bitwise_count(np.less_equal(rows, value).view(U))
    last = held[:, 0] + held[:, 1]
    return np.maximum(last, 1) - np.uint8(1)


class _Model:
    """States of all blocks; the first ``n`` of them take part in a step."""

    def __init__(self, blocks: int, longest: int):
        lane = np.arange(blocks)
        self.follow = np.zeros(2 * blocks * SLOTS, np.uint32)  # an id, and its count in three bits
        self.all_slots = (np.arange(2)[:, None] * blocks + lane) * SLOTS
        self.all_states = lane
        self.states = np.zeros((max((b - a for a, b in _between(RATES_AT, longest)), default=0), blocks), np.int64)
        self.seen, self.held, self.logit = np.zeros((3, CELLS, blocks), np.int64)
        self.weight = np.full((3, blocks), 1 << 15, np.int64)
        self.chance = np.full((STATES, blocks), 1 << (CHANCE - 1), U)
        self.chances = self.chance.reshape(-1)
        self.one, self.two = np.zeros((2, blocks), np.uint32)
        self.high, self.low = _Frequencies(blocks, 1), _Frequencies(blocks, CLASSES)
        self.missed: list[tuple[np.ndarray, np.ndarray]] = []  # states and high bytes since rates were learned
        self.low_bytes: list[np.ndarray] = []
        self.n = self.rated = 0

    def begin(self, n: int) -> None:
        """The next steps are those of the first ``n`` blocks."""
        if n == self.n:
            return
        self.n = n
        self.one, self.two = self.one[:n].copy(), self.two[:n].copy()
        self.slot_base, self.state_base = self.all_slots[:, :n].copy(), self.all_states[:n]
        self.hash, self.state, self.guess, self.count, self.work, self.stay = np.empty((6, 2, n), np.uint32)
        self.slots, self.key = np.empty((2, 2, n), np.int64)
        self.hit, self.same, self.pair = np.empty((2, n), bool), np.empty(n, bool), np.empty(n, np.uint32)

    def candidates(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """The candidate of each block and its pair of states."""
        hashed, guess, count, pair = self.hash, self.guess, self.count, self.pair
        np.multiply(self.one, np.uint32(2654435761), out=hashed[0])
        np.multiply(self.two, np.uint32(2246822519), out=hashed[1])
        hashed[1] += hashed[0]
        np.right_shift(hashed, 32 - 11, out=hashed)
        np.add(hashed, self.slot_base, out=self.slots)
        self.follow.take(self.slots, out=self.state, mode="clip")
        np.right_shift(self.state, 3, out=guess)
        np.bitwise_and(self.state, MOST, out=count)
        np.left_shift(count, 1, out=count)
        np.equal(guess[0], guess[1], out=self.same)
        np.left_shift(count[0], 3, out=pair)
        pair |= count[1]
        pair |= self.same.view(np.uint8)
        pair *= np.uint32(len(self.all_states))
        states = self.states[step - self.rated, : self.n]
        np.add(pair, self.state_base, out=states)
        return np.where(count[1], guess[1], guess[0]), states

    def follows(self, ids: np.ndarray) -> None:
        """The ids that came after the contexts."""
        state, work, stay = self.state, self.work, self.stay
        np.equal(self.guess, ids, out=self.hit)
        np.add(self.count, self.hit.view(np.uint8), out=self.key)
        _STAY.take(self.key, out=stay, mode="clip")
        # right: one more; wrong: two less, or the new id with 1
        fresh = ids << 3
        fresh |= 1
        state ^= fresh
        state &= stay
        state ^= fresh
        _ADD.take(self.key, out=work, mode="clip")
        state += work
        self.follow[self.slots.reshape(-1)] = state.reshape(-1)
        self.one, self.two = self.two, self.one
        self.one[:] = ids

    def learn(self, step: int, lane: np.ndarray, states: np.ndarray, ids: np.ndarray) -> None:
        """Take the misses since the last call, and learn what is due after ``step``."""
        high = ids >> 8
        self.missed.append((states, lane << 8 | high))
        self.low_bytes.append(_low_row(lane, high) << 8 | ids & 255)
        if step in RATES_AT:
            self._rates(step, *(np.concatenate(part) for part in zip(*self.missed)))
            self.missed, self.rated = [], step + 1
        if step in LOW_AT:
            self.low.learn(self.n, np.concatenate(self.low_bytes))
            self.low_bytes = []

    def _rates(self, step: int, wrong: np.ndarray, high: np.ndarray) -> None:
        n, blocks = self.n, len(self.all_states)
        # misses of blocks that are over count nowhere any more
        self.high.learn(n, high)
        states = self.states[: step + 1 - self.rated, :n].reshape(-1)
        every = np.bincount(states, minlength=blocks * STATES).reshape(STATES, -1)[:, :n]
        right = every - np.bincount(wrong, minlength=blocks * STATES).reshape(STATES, -1)[:, :n]
        # the weights follow the error of the mix that was used
        error = _by_order((right << CHANCE) - every * self.chance[:, :n].astype(np.int64))
        slope = np.add.reduceat(self.logit[:, :n] * error, [0, 16, 32])
        weight = self.weight[:, :n]
        weight += slope >> RATE
        np.clip(weight, -MOST_WEIGHT, MOST_WEIGHT, out=weight)
        for total, came in ((self.seen[:, :n], every), (self.held[:, :n], right)):
            total -= total >> 4
            total += _by_order(came)
        seen = self.seen[:, :n]
        held = np.minimum(self.held[:, :n], seen)
        logit = _STRETCH[((2 * held + 1) << CHANCE) // (2 * seen + 2)]
        self.logit[:, :n] = logit
        logit[:16] *= weight[0]
        logit[16:32] *= weight[1]
        logit[32:] *= weight[2]
        mixed = logit[:16].reshape(8, 1, 2, n) + logit[16:32].reshape(1, 8, 2, n)
        mixed[:1, :1] += logit[32]
        mixed[:1, 1:] += logit[33]
        mixed[1:, :1] += logit[34]
        mixed[1:, 1:] += logit[35]
        mixed >>= 16
        mixed += 2048
        self.chance[:, :n] = _SQUASH.take(mixed.reshape(STATES, n), mode="clip")


def _by_order(values: np.ndarray) -> np.ndarray:
    """Sums over pairs of states: 16 for order 1, 16 for order 2, 4 for order 0."""
    n = values.shape[1]
    cube = values.reshape(8, 8, 2, n)
    sums = np.empty((CELLS, n), np.int64)
    cube.sum(1, out=sums[:16].reshape(8, 2, n))
    cube.sum(0, out=sums[16:32].reshape(8, 2, n))
    sums[32], sums[33] = cube[0, 0].sum(0), cube[0, 1:].sum((0, 1))
    sums[34], sums[35] = cube[1:, 0].sum((0, 1)), cube[1:, 1:].sum((0, 1, 2))
    return sums


def _low_row(lane: np.ndarray, high: np.ndarray) -> np.ndarray:
    return lane * CLASSES + np.minimum(high, CLASSES - 1)


def _between(due: set[int], longest: int) -> list[tuple[int, int]]:
    """Runs of steps, each with the first step and the end, after the last of which something is due."""
    ends = [s + 1 for s in sorted(due) if s + 1 < longest] + [longest]
    return list(zip([0, *ends], ends))


def _runs(sizes: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """(first step, end, number of blocks) of steps that learn and change nothing in between."""
    ends = sorted({b for _, b in _between(RATES_AT | LOW_AT, longest)} | set(sizes[sizes > 0].tolist()))
    for a, b in zip([0, *ends], ends if longest else []):
        yield a, b, int(np.searchsorted(-sizes, -a, side="left"))


def _carried(words: np.ndarray) -> np.ndarray:
    """16-bit words of numbers that may be larger: what is over goes to the word before."""
    while (over := words >> WORD).any():
        words &= (1 << WORD) - 1
        words[:-1] += over[1:]
    return words.astype(np.uint16)


def encode(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The 16-bit words of each block. Blocks must come longest first."""
    count = len(blocks)
    sizes = np.array([len(b) for b in blocks], np.int64)
    longest = int(sizes[0]) if count else 0
    ids = np.zeros((longest, count), np.uint32)
    for k, block in enumerate(blocks):
        ids[: len(block), k] = block
    if ids.size and ids.max() >= 1 << 16:
        raise ValueError("ids of more than 16 bits cannot be coded")
    model = _Model(count, longest)
    all_low, all_size = np.zeros(count, U), np.full(count, ~U(0))
    room = longest * 3 + 4
    words = np.zeros(count * room, np.uint32)
    filled = np.arange(count) * room

    for first, end, n in _runs(sizes, longest):
        model.begin(n)
        pairs, guesses = np.empty((end - first, n), np.int64), np.empty((end - first, n), np.uint32)
        for step in range(first, end):
            guesses[step - first], pairs[step - first] = model.candidates(step)
            model.follows(ids[step, :n])
        chances = model.chances.take(pairs, mode="clip")
        # the bytes of all misses of the run
        now = ids[first:end, :n]
        at = np.flatnonzero(guesses != now)
        bounds = np.searchsorted(at, np.arange(end - first + 1) * n)
        lane, missed = at % n, now.reshape(-1).take(at).astype(np.int64)
        high = missed >> 8
        starts_h, widths_h = model.high.span(lane << 8 | high)
        starts_l, widths_l = model.low.span(_low_row(lane, high) << 8 | missed & 255)
        low, size, part = all_low[:n].copy(), all_size[:n].copy(), np.empty(n, U)
        for k in range(end - first):
            run = slice(bounds[k], bounds[k + 1])
            m = lane[run]
            np.right_shift(size, CHANCE, out=part)
            part *= chances[k]
            more = part.take(m)
            wide = size.take(m)
            wide -= more
            for start, width in ((starts_h[run], widths_h[run]), (starts_l[run], widths_l[run])):
                wide >>= TOTAL
                start *= wide
                more += start
                wide *= width
            base = low.take(m)
            base += more
            over = m[np.flatnonzero(base < more)]
            if len(over):
                words[filled[over] - 1] += 1
            low[m], part[m] = base, wide
            size, part = part, size
            tight = np.flatnonzero(size < LEAST)
            while len(tight):
                to, value, wide = filled.take(tight), low.take(tight), size.take(tight)
                words[to] = value >> (64 - WORD)
                to += 1
                filled[tight] = to
                value <<= WORD
                low[tight] = value
                wide <<= WORD
                size[tight] = wide
                tight = tight[wide < LEAST]
        all_low[:n], all_size[:n] = low, size
        model.learn(end - 1, lane, pairs.reshape(-1).take(at), missed)
    # any number inside the interval ends it, zeros follow: its start, rounded up to a word
    words[filled] = (all_low >> (64 - WORD)) + (all_low & (LEAST - 1) != 0)
    return [_carried(words[k * room : end + 1]) for k, end in enumerate(filled)]


def decode(coded: list[np.ndarray], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block again. Blocks must come longest first."""
    count, longest = len(coded), sizes[0] if coded else 0
    lengths = np.array(sizes, np.int64)
    room = max((len(w) for w in coded), default=0) + 4
    words = np.zeros((count, room), np.uint16)
    for k, block in enumerate(coded):
        words[k, : len(block)] = block
    all_value = np.zeros(count, U)
    for k in range(64 // WORD):
        all_value = all_value << WORD | words[:, k]
    all_size = np.full(count, ~U(0))
    words = words.reshape(-1)
    used = np.arange(count) * room + 64 // WORD
    ids = np.zeros((longest, count), np.uint32)
    model = _Model(count, longest)

    def take(value, size, found, row):
        size >>= TOTAL
        at = found.find(row, (value // size).astype(np.uint16))
        start, width = found.span(at)
        start *= size
        value -= start
        size *= width
        at &= 255
        return at

    for first, end, n in _runs(lengths, longest):
        model.begin(n)
        value, size, part = all_value[:n].copy(), all_size[:n].copy(), np.empty(n, U)
        chance, misses = np.empty(n, U), []
        for step in range(first, end):
            now, states = model.candidates(step)
            model.chances.take(states, out=chance, mode="clip")
            np.right_shift(size, CHANCE, out=part)
            part *= chance
            m = np.flatnonzero(value >= part)
            less, rest, wide = part.take(m), value.take(m), size.take(m)
            rest -= less
            wide -= less
            high = take(rest, wide, model.high, m)
            low = take(rest, wide, model.low, _low_row(m, high))
            value[m], part[m] = rest, wide
            size, part = part, size
            high <<= 8
            high |= low
            now[m] = high
            misses.append((m, states.take(m), high))
            ids[step, :n] = now
            model.follows(now)
            tight = np.flatnonzero(size < LEAST)
            while len(tight):
                to, more, wide = used.take(tight), value.take(tight), size.take(tight)
                more <<= WORD
                more |= words.take(to, mode="clip")
                value[tight] = more
                to += 1
                used[tight] = to
                wide <<= WORD
                size[tight] = wide
                tight = tight[wide < LEAST]
        all_value[:n], all_size[:n] = value, size
        model.learn(end - 1, *(np.concatenate(part) for part in zip(*misses)))
    return [ids[:size, k].copy() for k, size in enumerate(sizes)]
