"""Adaptive context-mixing range coder for token ids, many blocks at a time.

Each block starts from an empty model and can be read alone, given the shares of the
ids that all blocks of a segment have in common. Per id, the model takes the id that
last followed the last two ids in this block, or else the last one, as a candidate,
and codes whether it is right. The probability is mixed from three estimates, by the
record of the order-2 context, by that of the order-1 context, and by how often the
candidate occurs (order 0): logistic mixing with weights that each block learns. A
wrong candidate is followed by the id itself under the shares, the order-0
distribution of whole ids.

Candidates and their records change with every id. Estimates and weights change
every ``REFRESH`` ids, at first more often, by what the ids since the last change
show; until the next, the mixed probability of each of the few joint states of the
three contexts is kept in a table.

All arithmetic is on integers, so that every machine decodes alike. The blocks are
coded side by side: step t codes the t-th id of every block with array operations.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

#: Ids in a block, ids between two updates of estimates and weights, and ids that the format can hold.
BLOCK, REFRESH, MOST_IDS = 2_048, 256, 1 << 16
_ORDER1, _ORDER2 = 9, 10  # bits of the context tables
_SHARES, _CHANCE = 20, 12  # bits of the ids' shares and of the candidate's probability
_LEAST, _S32 = np.array(1 << 31, np.uint64), np.array(32, np.uint64)
_LOW32, _S63, _ONE = (np.array(x, np.uint64) for x in ((1 << 32) - 1, 63, 1))
_S_SHARES, _S_CHANCE, _LAST_SLOT = np.array(_SHARES, np.uint64), np.array(_CHANCE, np.uint64), np.array((1 << _SHARES) - 1, np.uint64)
_STEPS = 32  # of the writer, prepared together

_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 1, 4095).astype(np.int32)
_STRETCH = np.clip(np.searchsorted(_SQUASH, np.arange(4096)) - 2048, -2047, 2047)
#: The candidate's probability; the highest leaves a wrong one room for all shares.
_CODED = np.minimum(_SQUASH, 4096 - 32).astype(np.uint64)
_MOST_WEIGHT = 1 << 17
_STEADY = 24  # ids that the estimates so far weigh as much as

# A record: id in 16 bits, group of its share in 2, how often running it was right in 2.
_ID, _SAME, _KNOWN, _ONCE, _TWICE = (np.array(x, np.int32) for x in ((1 << 16) - 1, (1 << 18) - 1, 3 << 18, 1 << 18, 2 << 18))
# A joint state: known2 (2 bits), agree (1), known1 (2), group (2).
_STATES = 128
_S16, _S13, _S31, _ONE32 = (np.array(x, np.int32) for x in (16, 13, 31, 1))
_OF2, _OF_AGREE, _OF1, _OF_GROUP = (np.array(x, np.int32) for x in (96, 16, 12, 3))
#: Estimates of order 2 by (known2, agree), of order 1 by (known2 > 0, known1, agree), of order 0 by group.
_ORDER_OF = np.repeat(np.arange(3), (8, 16, 4))


def shares_of(ids: np.ndarray) -> np.ndarray:
    """How many of 2**20 slots each id gets: in proportion to its occurrences, one at least."""
    counts = np.bincount(ids, minlength=1)
    total = 1 << _SHARES
    shares = np.where(counts, 1 + counts * (total - np.count_nonzero(counts)) // max(1, len(ids)), 0)
    shares[np.argmax(counts)] += total - shares.sum()
    return shares


class _Order0:
    """Tables of the shares; without any, all ids are alike."""

    def __init__(self, shares: np.ndarray | None) -> None:
        given = np.full(MOST_IDS, (1 << _SHARES) // MOST_IDS) if shares is None else np.asarray(shares, np.int64)
        if len(given) > MOST_IDS or given.min(initial=0) < 0 or given.sum() != 1 << _SHARES:
            raise ValueError("not the shares of ids")
        sizes = np.zeros(MOST_IDS, np.int64)
        sizes[: len(given)] = given
        self.sizes = sizes
        #: The first slot of each id, shifted, and how many it has.
        self.places = ((np.cumsum(sizes) - sizes) << 32 | sizes).astype(np.uint64)
        group = np.searchsorted([32, 256, 2048], sizes, "right")
        #: The record of an id that was met once.
        self.fresh = (np.arange(MOST_IDS) | group << 16 | _ONCE).astype(np.int32)

    def slots(self) -> np.ndarray:
        """The id that each slot belongs to."""
        return np.repeat(np.arange(MOST_IDS, dtype=np.uint16), self.sizes)


class _Model:
    """The blocks' models side by side; the first ``n`` blocks are the ones still being coded."""

    def __init__(self, blocks: int) -> None:
        self.base1, self.base2 = np.arange(blocks) << _ORDER1, np.arange(blocks) << _ORDER2
        self.lane = np.arange(blocks) * _STATES
        self.table1, self.table2 = np.zeros(blocks << _ORDER1, np.int32), np.zeros(blocks << _ORDER2, np.int32)
        self.chances = np.full((len(_ORDER_OF), blocks), 1 << 14)
        self.weights = np.full((3, blocks), 1 << 14)
        self.seen = np.zeros((blocks, _STATES, 2), np.int32)
        self.mixed = np.zeros((blocks, _STATES), np.uint64)
        self._mix(blocks)

    def _mix(self, n: int) -> None:
        self.stretched = _STRETCH.take(self.chances[:, :n] >> 4)
        parts = (self.stretched * self.weights[_ORDER_OF, :n] >> 8).astype(np.int32)
        order2, order0 = parts[:8].reshape(4, 2, 1, 1, n), parts[24:].reshape(1, 1, 1, 4, n)
        order1 = parts[8:24].reshape(2, 4, 2, 1, n)[[0, 1, 1, 1]].swapaxes(1, 2)
        total = (order2 + order1 + order0).reshape(_STATES, n)
        total >>= 8
        total += 2048
        self.at = np.clip(total, 0, 4095, out=total)
        self.mixed[:n] = _CODED.take(self.at).T

    def note(self, n: int, states: np.ndarray) -> None:
        """Count the states of some ids, by step and block, doubled and one more where the candidate was right."""
        by_block = np.ascontiguousarray(states.T).reshape(-1)
        self.seen[:n] += np.bincount(by_block, minlength=n * _STATES * 2).astype(np.int32).reshape(n, _STATES, 2)

    def refresh(self, n: int) -> None:
        """Estimates, weights and probabilities from what was counted."""
        right, every = np.ascontiguousarray(self.seen[:n, :, 1].T), np.ascontiguousarray(self.seen[:n, :, 0].T)
        every += right
        moves = _sums((right << 12) - every * _SQUASH.take(self.at[:, :n])) * self.stretched[:, :n]
        moves = np.add.reduceat(moves, [0, 8, 24], axis=0) * 10 + 0x8000 >> 16
        self.weights[:, :n] = np.clip(self.weights[:, :n] + moves, -_MOST_WEIGHT, _MOST_WEIGHT)
        self.chances[:, :n] = (self.chances[:, :n] * _STEADY + _sums(right) * 65535) // (_sums(every) + _STEADY)
        self.seen[:n] = 0
        self._mix(n)


def _sums(of: np.ndarray) -> np.ndarray:
    """The sums of the states that each estimate takes part in."""
    n = of.shape[1]
    by_group = of.reshape(4, 2, 4, 4, n)
    rest = by_group.sum(axis=3, dtype=np.int32)
    order1 = np.stack([rest[0], rest[1:].sum(axis=0, dtype=np.int32)]).swapaxes(1, 2)
    order2 = rest.sum(axis=2, dtype=np.int32)
    return np.concatenate([order2.reshape(8, n), order1.reshape(16, n), by_group.sum(axis=(0, 1, 2), dtype=np.int32)]).astype(np.int64)


_MUL1, _MUL2, _CUT1, _CUT2 = (np.array(x) for x in (40503, 10007, 3, 2))
_MASK1, _MASK2 = np.array((1 << _ORDER1) - 1), np.array((1 << _ORDER2) - 1)


def _places(last: np.ndarray, before: np.ndarray, base1: np.ndarray, base2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the records of both contexts are."""
    at1 = last * _MUL1
    at2 = at1 >> _CUT2
    at2 ^= before * _MUL2
    at2 &= _MASK2
    at2 += base2
    at1 >>= _CUT1
    at1 &= _MASK1
    at1 += base1
    return at1, at2


def _state(record1: np.ndarray, record2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidate's record, and the joint state of the contexts."""
    differ = record1 ^ record2
    # all bits set where the order-2 context is new
    chosen = record2 - _ONCE
    chosen >>= _S31
    chosen &= differ
    chosen ^= record2
    state = chosen >> _S16
    state &= _OF_GROUP
    part = record2 >> _S13
    part &= _OF2
    state |= part
    np.right_shift(record1, _S16, out=part)
    part &= _OF1
    state |= part
    differ &= _ID
    differ -= _ONE32
    differ >>= _S31
    differ &= _OF_AGREE
    state |= differ
    return chosen, state


def _learnt(record: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The record of a context after an id."""
    same = record ^ fresh
    same &= _SAME
    same -= _ONE32
    same >>= _S31
    same &= record
    same &= _KNOWN
    np.minimum(same, _TWICE, out=same)
    same += fresh
    return same


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """Steps between two updates in which the same blocks, longest first, have ids: from, to, blocks, update after it."""
    last = int(sizes[0])
    updates = {*(x for x in (16, 64) if x < REFRESH), *range(REFRESH, last, REFRESH)}
    at = 0
    for end in sorted({x for x in updates if x < last} | set(sizes.tolist())):
        if end > at:
            yield at, end, int(np.searchsorted(-sizes, -at, "left")), end in updates
            at = end


class _Writer:
    """Range coder of 64 bits that puts out 32 at a time; carries are settled at the end."""

    def __init__(self, sizes: np.ndarray) -> None:
        # at most a word an id, as a step leaves a range of 16 at least
        self.first = np.cumsum(sizes + 4) - (sizes + 4)
        self.words = np.zeros(int((sizes + 4).sum()), np.uint64)
        self.place = self.first.copy()
        self.low, self.range = np.zeros(len(sizes), np.uint64), np.full(len(sizes), (1 << 63) - 1, np.uint64)

    def put(self, n: int, chance: np.ndarray, missed: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Code per block whether the candidate is right, else the slots of the id; ``missed`` has all bits set or none, start and size are 0 for none."""
        span, low = self.range[:n], self.low[:n]
        bound = span >> _S_CHANCE
        bound *= chance
        span -= bound
        span >>= _S_SHARES
        add = span * start
        span *= size
        span += bound
        bound &= missed
        span -= bound
        add += bound
        low += add
        over = (low < add).nonzero()[0]
        if len(over):
            self.words[self.place.take(over) - 1] += _ONE
        more = (span < _LEAST).nonzero()[0]
        if len(more):
            place, out = self.place.take(more), low.take(more)
            self.words[place] = out >> _S32
            self.place[more] = place + 1
            low[more] = out << _S32
            span[more] = span.take(more) << _S32

    def finish(self) -> list[bytes]:
        for _ in range(2):
            self.words[self.place] = self.low >> _S32
            self.place += 1
            self.low <<= _S32
        sizes = self.place - self.first
        ends = np.cumsum(sizes)
        words = self.words.take(np.arange(ends[-1]) + np.repeat(self.first - ends + sizes, sizes))
        while len(over := np.flatnonzero(words >> _S32)):
            words[over] -= np.uint64(1 << 32)
            words[over - 1] += _ONE
        words = words.astype("<u4")
        return [words[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def encode_blocks(blocks: list[np.ndarray], shares: np.ndarray | None = None) -> list[bytes]:
    """The payload of each block of ids."""
    if not blocks:
        return []
    sizes = np.array([len(x) for x in blocks])
    if any(x.max(initial=0) >= MOST_IDS or x.min(initial=0) < 0 for x in blocks):
        raise ValueError(f"ids must be from 0 to {MOST_IDS - 1}")
    order = np.argsort(-sizes, kind="stable")
    # two steps without ids come first: the contexts of the first ids
    ids = np.zeros((int(sizes.max()) + 2, len(blocks)), np.int32)
    for lane, k in enumerate(order.tolist()):
        ids[2 : sizes[k] + 2, lane] = blocks[k]
    order0, model, writer = _Order0(shares), _Model(len(blocks)), _Writer(sizes[order])
    table1, table2 = model.table1, model.table2
    for first, end, n, update in _spans(sizes[order]):
        states = np.empty((end - first, n), np.int64)
        for a in range(first, end, _STEPS):
            b = min(a + _STEPS, end)
            before, last, now = (ids[a + k : b + k, :n].astype(np.int64) for k in range(3))
            at1, at2 = _places(last, before, model.base1[:n], model.base2[:n])
            fresh = order0.fresh.take(now)
            records1, records2 = np.empty_like(fresh), np.empty_like(fresh)
            for p1, p2, r1, r2, f in zip(at1, at2, records1, records2, fresh, strict=True):
                table1.take(p1, out=r1, mode="clip")
                table2.take(p2, out=r2, mode="clip")
                table1[p1] = _learnt(r1, f)
                table2[p2] = _learnt(r2, f)
            chosen, state = _state(records1, records2)
            state = state + model.lane[:n]
            hit = (chosen ^ fresh) & _ID == 0
            np.add(state * 2, hit, out=states[a - first : b - first])
            chance = model.mixed.reshape(-1).take(state, mode="clip")
            missed = hit.astype(np.uint64) - _ONE
            size = order0.places.take(now) & missed
            start = size >> _S32
            size &= _LOW32
            for step in zip(chance, missed, start, size, strict=True):
                writer.put(n, *step)
        model.note(n, states)
        if update:
            model.refresh(n)
    out: list[bytes] = [b""] * len(blocks)
    for k, payload in zip(order.tolist(), writer.finish(), strict=True):
        out[k] = payload
    return out


def decode_blocks(payloads: list[bytes], sizes: list[int], shares: np.ndarray | None = None) -> list[np.ndarray]:
    """The ids of each block."""
    if not payloads:
        return []
    lengths = np.array(sizes)
    order = np.argsort(-lengths, kind="stable")
    ids = np.zeros((int(lengths.max()), len(sizes)), np.int32)
    order0, model = _Order0(shares), _Model(len(sizes))
    slots, places, fresh_by_id = order0.slots(), order0.places, order0.fresh
    table1, table2 = model.table1, model.table2
    own = [payloads[k] for k in order.tolist()]
    n_words = np.array([len(x) // 4 for x in own])
    words = np.frombuffer(b"".join(x[: len(x) // 4 * 4] for x in own) + bytes(8), "<u4").astype(np.uint64)
    place = np.cumsum(n_words) - n_words
    code = words.take(place, mode="clip") << _S32 | words.take(place + 1, mode="clip")
    place += 2
    span = np.full(len(sizes), (1 << 63) - 1, np.uint64)
    last, before = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    mixed = model.mixed.reshape(-1)
    for a, b, n, update in _spans(lengths[order]):
        base1, base2, lane = model.base1[:n], model.base2[:n], model.lane[:n]
        code, span, place, last, before = code[:n], span[:n], place[:n], last[:n], before[:n]
        states = np.empty((b - a, n), np.int64)
        for now32, state in zip(ids[a:b, :n], states, strict=True):
            at1, at2 = _places(last, before, base1, base2)
            r1, r2 = table1.take(at1, mode="clip"), table2.take(at2, mode="clip")
            chosen, joint = _state(r1, r2)
            np.add(joint, lane, out=state)
            bound = span >> _S_CHANCE
            bound *= mixed.take(state, mode="clip")
            span -= bound
            span >>= _S_SHARES
            code -= bound
            # neither exceeds 2**63, so the sign is 1 where the candidate is right
            hit = code >> _S63
            slot = code // span
            np.minimum(slot, _LAST_SLOT, out=slot)
            found = slots.take(slot.view(np.int64), mode="clip")
            missed = hit - _ONE
            now = found & missed.view(np.int64)
            chosen &= _ID
            now += chosen * hit.view(np.int64)
            size = places.take(now, mode="clip")
            size &= missed
            start = size >> _S32
            size &= _LOW32
            start *= span
            code -= start
            span *= size
            bound *= hit
            span += bound
            code += bound
            more = (span < _LEAST).nonzero()[0]
            if len(more):
                # a damaged block may ask for words behind its end; its checksum tells
                at = place.take(more)
                code[more] = code.take(more) << _S32 | words.take(at, mode="clip")
                place[more] = at + 1
                span[more] = span.take(more) << _S32
            fresh = fresh_by_id.take(now, mode="clip")
            table1[at1] = _learnt(r1, fresh)
            table2[at2] = _learnt(r2, fresh)
            state += state
            state += hit.view(np.int64)
            now32[:] = now
            before, last = last, now
        model.note(n, states)
        if update:
            model.refresh(n)
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(sizes)
    for at_lane, k in enumerate(order.tolist()):
        out[k] = ids[: lengths[k], at_lane]
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
