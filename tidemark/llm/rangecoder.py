"""An adaptive range coder for token ids that mixes predictions of order 0 to 2, thousands of lanes at a time."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the block format: magic; then ids, alphabet and checksum of the ids, begun with the alphabet, as unsigned
# 32-bit integers; the number of 16-bit words of each lane; the words of all lanes.
MAGIC = b"CMR3"
HEADER = struct.Struct("<4sIII")
LANE = 4096  # a block of n ids has (n // LANE) ** 2 lanes that learn together; a short one is a lane of its own
LONGEST = 1 << 16  # ids in a block at most
LANES = 8192  # in step at most
BLOCKS, ENTRIES = 64, 1 << 21  # in step at most, and their order 0 together
SLOT_BITS_1, SLOT_BITS_2 = 13, 15
SURE = 3
STATES = 2 * (SURE + 1) ** 2
MIX_BITS, ZERO_BITS = 12, 14
MIX, ZERO = 1 << MIX_BITS, 1 << ZERO_BITS
LEAST = 16  # of MIX, for each order
PRIOR = np.array([1, 1, 2], np.int64)
ROUND = 16  # steps in which tables stand still, fewer at the start
LOW = np.uint64((1 << 32) - 1)
HALF, WORD = np.uint64(32), np.uint64(16)
UNIT_MIX, UNIT_ZERO = np.uint64(MIX_BITS), np.uint64(ZERO_BITS)
TOP = np.uint64(ZERO - 1)


class Classes:
    """Ids that order 0 has not met yet: the class of an id with adaptive counts, and its place in the class in plain bits.

    Classes are half octaves of id + 1: ids of a vocabulary that was built by
    merges get rarer with their number, so a class holds ids about alike in use.
    """

    def __init__(self, alphabet: int):
        octaves = 1 << np.arange(int(alphabet).bit_length())
        starts = np.unique(np.concatenate([octaves, octaves + octaves // 2]))  # 1, 2, 3, 4, 6, 8, 12, ...
        self.start = starts[starts <= alphabet].astype(np.int64)
        ends = np.append(self.start[1:], alphabet + 1)
        self.bits = np.array([int(n - 1).bit_length() for n in ends - self.start], np.uint64)
        self.of = (np.searchsorted(self.start, np.arange(1, alphabet + 1), side="right") - 1).astype(np.int16)
        self.count = len(self.start)
        self.alphabet = alphabet


class Lot:
    """Lanes of some blocks, longest first: element e of step t is lane e - at[t] of those that are still at work."""

    def __init__(self, sizes: list[int]):
        block, length, first = [], [], []
        for b, n in enumerate(sizes):
            lanes = max(1, (n // LANE) ** 2)
            steps = -(-n // lanes)
            begin = np.arange(lanes) * steps
            block.append(np.full(lanes, b))
            length.append(np.clip(n - begin, 0, steps))
            first.append(begin)
        block, length, first = map(np.concatenate, (block, length, first))
        order = np.argsort(-length, kind="stable")
        self.block, self.length, self.first = block[order], length[order], first[order]
        self.sizes, self.steps = sizes, int(length.max(initial=0))
        own = np.argsort(self.first, kind="stable")
        own = own[np.argsort(self.block[own], kind="stable")]
        self.own = np.split(own, np.cumsum(np.bincount(block, minlength=len(sizes)))[:-1])  # lanes of each block in order
        self.longest = np.array([self.length[k[0]] for k in self.own])
        self.live = np.searchsorted(-self.length, -np.arange(self.steps), side="left")
        self.at = np.append(0, np.cumsum(self.live))
        # Steps after which tables are brought up to date, and those after which shares are counted anew.
        self.rounds, self.renewals, t, due = [], set(), 0, 1
        while t < self.steps:
            t += min(max(t // 2, 1), ROUND)
            self.rounds.append(min(t, self.steps))
            if due <= t < self.steps:
                self.renewals.add(t)
                due = 3 * t
        self.counted = max(self.renewals, default=0)  # what comes later changes no share


class Model:
    """What coder and decoder know before each step, of all blocks of a lot.

    The lanes of a block share what they learn, brought up to date after every
    round. Orders 2 and 1 name the id that last followed the two ids before, or
    the one before, with a number for how often they have been right of late. How
    sure both are, and whether they agree, selects the adaptive shares of order 2
    being right, of order 1 being right where order 2 is not, and of order 0,
    which has the counts of a block's ids so far and classes for those not met.
    """

    def __init__(self, lot: Lot, classes: Classes):
        self.lot, self.classes = lot, classes
        blocks, self.width = len(lot.sizes), classes.alphabet + classes.count
        bits = np.array([min(max(int(n).bit_length(), 4), SLOT_BITS_2) for n in lot.sizes])
        bits_1 = np.minimum(bits, SLOT_BITS_1)
        self.base_1, self.base_2 = ((np.cumsum(1 << x) - (1 << x))[lot.block] for x in (bits_1, bits))
        self.shift_1, self.shift_2 = ((32 - x)[lot.block].astype(np.uint32) for x in (bits_1, bits))
        self.one, self.two = np.zeros(int((1 << bits_1).sum()), np.int32), np.zeros(int((1 << bits).sum()), np.int32)
        self.base_state = (lot.block * STATES).astype(np.int32)
        self.base_zero = (lot.block * self.width).astype(np.int32)
        self.base_slot = (lot.block * ZERO).astype(np.int32)
        self.mixed = np.tile(PRIOR, blocks * STATES)
        self.counts = np.zeros(blocks * self.width, np.int32)
        self.counts.reshape(blocks, -1)[:, classes.alphabet:] = 1
        self.zero = np.zeros(blocks * self.width, np.uint32)  # start << 15 | share; none: not met
        self.slots = np.zeros(blocks * ZERO, np.int32)
        self.seen_mixed, self.seen_zero = [], []
        self.renew(0)

    def renew(self, t: int) -> None:
        """Shares from the counts so far; in order 0, ids get one if they are among the ZERO / 2 most frequent at least."""
        if self.seen_mixed:
            self.mixed += np.bincount(np.concatenate(self.seen_mixed), minlength=len(self.mixed)) * 4
            np.add.at(self.counts, np.concatenate(self.seen_zero).astype(np.intp), np.int32(1))
            self.seen_mixed, self.seen_zero = [], []
        sums = np.cumsum(self.mixed.reshape(-1, 3), axis=1)
        ends = sums * (MIX - 3 * LEAST) // sums[:, -1:] + np.arange(1, 4) * LEAST
        starts = np.concatenate([np.zeros_like(ends[:, :1]), ends[:, :-1]], axis=1)
        self.mix = (starts << 13 | ends - starts).astype(np.int32).ravel()
        self.start_one, self.start_zero = starts[:, 1].astype(np.uint64), starts[:, 2].astype(np.uint64)
        for b in np.flatnonzero(self.lot.longest > t):
            counts, zero = self.counts[b * self.width:(b + 1) * self.width], self.zero[b * self.width:(b + 1) * self.width]
            met = np.flatnonzero(counts != 0)
            of = counts[met].astype(np.int64)
            if (over := len(met) - self.classes.count - ZERO // 2) > 0:
                zero[met] = 0
                kept = (of > np.partition(of, over)[over]) | (met >= self.classes.alphabet)
                met, of = met[kept], of[kept]
            ends = np.cumsum(of)
            ends = ends * (ZERO - len(met)) // ends[-1] + np.arange(1, len(met) + 1)
            shares = np.diff(ends, prepend=0)
            zero[met] = (ends - shares) << 15 | shares
            self.slots[b * ZERO:(b + 1) * ZERO] = np.repeat(met, shares)

    def keys(self, last: np.ndarray, prior: np.ndarray, lanes) -> tuple[np.ndarray, np.ndarray]:
        """Places of orders 1 and 2 in their tables, for ids + 1 as unsigned 32-bit integers."""
        key = last * np.uint32(0x9E3779B1)
        one = self.base_1[lanes] + (key >> self.shift_1[lanes])
        key += prior
        key *= np.uint32(0x85EBCA6B)
        return one, self.base_2[lanes] + (key >> self.shift_2[lanes])

    def state(self, one: np.ndarray, two: np.ndarray, base_state: np.ndarray) -> np.ndarray:
        """How sure both orders are of the ids + 1 that they name (zero names none), and whether these agree."""
        state = (two & SURE) << 2
        state += one & SURE
        state += ((one ^ two) <= SURE).view(np.int8) << 4
        state += base_state
        return state

    def learn(self, table: np.ndarray, at: np.ndarray, known: np.ndarray, right: np.ndarray, fresh: np.ndarray) -> None:
        """A certainty rises when right and falls when wrong; a low one gives way to the new id."""
        table[at] = np.where(right, np.minimum(known + 1, known | SURE), np.where((known & SURE) > 1, known - 1, fresh))


def _lots(order, sizes, classes):
    lot, lanes = [], 0
    for i in order:
        own = max(1, (sizes[i] // LANE) ** 2)
        if lot and (lanes + own > LANES or len(lot) == BLOCKS or (len(lot) + 1) * (classes.alphabet + classes.count) > ENTRIES):
            yield lot
            lot, lanes = [], 0
        lot.append(i)
        lanes += own
    if lot:
        yield lot


def encode_blocks(blocks: list[np.ndarray], alphabet: int) -> list[bytes]:
    """Each block of ids below `alphabet` as bytes of its own; blocks share nothing and hold LONGEST ids at most."""
    sizes = [len(b) for b in blocks]
    if any(n > LONGEST for n in sizes):
        raise ValueError(f"a block holds {LONGEST} ids at most")
    out: list = [None] * len(blocks)
    classes = Classes(alphabet)
    for lot in _lots(sorted(range(len(blocks)), key=lambda i: -sizes[i]), sizes, classes):
        for k, coded in zip(lot, _encode([blocks[k] for k in lot], classes)):
            head = HEADER.pack(MAGIC, sizes[k], alphabet, zlib.crc32(blocks[k].astype("<u4").tobytes(), alphabet))
            out[k] = head + coded
    return out


class Words:
    """16-bit words that the lanes of a coder have put out; a word may hold a carry, settled at the end."""

    def __init__(self, lanes: int, room: int):
        self.out, self.room = np.zeros(lanes * room, np.uint32), room
        self.begin = np.arange(lanes) * room
        self.put = self.begin.copy()

    def add(self, at, low: np.ndarray) -> None:
        put = self.put[at]
        self.out[put] = low >> HALF
        self.put[at] = put + 1

    def shorten(self, at: np.ndarray, low: np.ndarray, width: np.ndarray) -> None:
        """Put out words of the lanes `at`, whose widths are LOW or less, until all are above it."""
        while len(at):
            l, w = low[at], width[at] << WORD
            self.add(at, l)
            low[at] = (l & LOW) << WORD
            width[at] = w
            at = at[w <= LOW]

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of words, and how many of each row count."""
        rows, used = self.out.reshape(-1, self.room), self.put - self.begin
        rows = rows[:, :int(used.max(initial=0))]
        rows[np.arange(rows.shape[1]) >= used[:, None]] = 0
        while (over := rows >> 16).any():
            rows &= 0xFFFF
            rows[:, :-1] += over[:, 1:]
        return rows.astype("<u2"), used


def _encode(blocks: list[np.ndarray], classes: Classes) -> list[bytes]:
    """Blocks in step: shares are looked up a round at a time, then every step codes the next id of each lane."""
    lot = Lot([len(b) for b in blocks])
    lanes, steps, at, live = len(lot.block), lot.steps, lot.at, lot.live
    model = Model(lot, classes)
    # Ids + 1 by step and lane, with two empty steps before.
    grid = np.zeros((steps + 2, lanes), np.uint32)
    for b, own in zip(blocks, lot.own):
        n = int(lot.length[own[0]])
        padded = np.zeros(len(own) * n, np.uint32)
        padded[:len(b)] = b
        padded[:len(b)] += 1
        grid[2:n + 2, own] = padded.reshape(len(own), n).T
    inside = np.arange(steps)[:, None] < lot.length
    lane = np.broadcast_to(np.arange(lanes), (steps, lanes))[inside]
    now = grid[2:][inside].astype(np.int32)
    at_one, at_two = (x[inside] for x in model.keys(grid[1:-1], grid[:-2], slice(None)))
    del grid, inside
    mixes = np.empty(len(now), np.int32)  # start << 13 | share
    zeros = np.full(len(now), ZERO, np.uint32)  # start << 15 | share; for ids named by another order all of it
    strange, t = [], 0
    for upto in lot.rounds:
        e = slice(at[t], at[upto])
        ids, of = now[e], lane[e]
        one, two = model.one.take(at_one[e], mode="clip"), model.two.take(at_two[e], mode="clip")
        state = model.state(one, two, model.base_state.take(of, mode="clip"))
        right_one, right_two = one >> 2 == ids, two >> 2 == ids
        other_two = ~right_two
        left = other_two & ~right_one
        state *= 3
        state += other_two
        state += left
        mixes[e] = model.mix.take(state, mode="clip")
        left = np.flatnonzero(left)
        base = model.base_zero.take(of.take(left, mode="clip"), mode="clip")
        place = base + ids.take(left, mode="clip")
        place -= 1
        share = model.zero.take(place, mode="clip")
        unmet = np.flatnonzero(share == 0)
        cls = classes.of[ids[left[unmet]] - 1]
        other = base[unmet] + classes.alphabet + cls
        share[unmet] = model.zero[other]
        zeros[at[t] + left] = share
        strange.append(at[t] + left[unmet])
        if upto <= lot.counted:
            model.seen_mixed.append(state)
            model.seen_zero += [place, other]
        if upto < steps:
            fresh = ids << 2 | 1
            model.learn(model.one, at_one[e], one, right_one, fresh)
            model.learn(model.two, at_two[e], two, right_two, fresh)
        t = upto
        if t in lot.renewals:
            model.renew(t)
    strange = np.concatenate(strange) if strange else np.empty(0, np.int64)
    edges = np.searchsorted(strange, at)
    cls = classes.of[now[strange] - 1]
    bits, place = classes.bits[cls], (now[strange] - classes.start[cls]).astype(np.uint64)
    del at_one, at_two
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 48) - 1, np.uint64)
    words = Words(lanes, 3 * steps + 8)
    for t in range(steps):
        n, e = int(live[t]), slice(at[t], at[t + 1])
        l, w, mix, zero = low[:n], width[:n], mixes[e], zeros[e]
        w >>= UNIT_MIX
        l += w * (mix >> 13).astype(np.uint64)
        w *= (mix & 8191).astype(np.uint64)
        w >>= UNIT_ZERO
        l += w * (zero >> 15)
        w *= zero & 32767
        words.shorten(np.flatnonzero(w <= LOW), low, width)
        if edges[t] < edges[t + 1]:
            s = slice(edges[t], edges[t + 1])
            of = lane[strange[s]]
            ww = width[of] >> bits[s]
            low[of] += ww * place[s]
            width[of] = ww
            words.shorten(of[ww <= LOW], low, width)
    for _ in range(3):
        words.add(np.arange(lanes), low)
        low = (low & LOW) << WORD
    rows, used = words.settle()
    out = []
    for own in lot.own:
        texts = rows[own][np.arange(rows.shape[1]) < used[own, None]]
        out.append(used[own].astype("<u2").tobytes() + texts.tobytes())
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a block whose checksum does not match raises ValueError."""
    heads = []
    for c in coded:
        if len(c) < HEADER.size or c[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        heads.append(HEADER.unpack_from(c))
    if any(h[1] > LONGEST or h[2] < 1 or h[2] > 1 << 28 for h in heads):
        raise ValueError("a block of token ids is damaged")
    out: list = [None] * len(coded)
    sizes = [h[1] for h in heads]
    for alphabet in {h[2] for h in heads}:
        order = sorted((i for i, h in enumerate(heads) if h[2] == alphabet), key=lambda i: -sizes[i])
        classes = Classes(alphabet)
        for lot in _lots(order, sizes, classes):
            for k, ids in zip(lot, _decode([coded[k] for k in lot], [sizes[k] for k in lot], classes)):
                if zlib.crc32(ids.astype("<u4").tobytes(), alphabet) != heads[k][3]:
                    raise ValueError("a block of token ids is damaged")
                out[k] = ids
    return out


def _lane_words(coded: list[bytes], lot: Lot) -> np.ndarray:
    """Rows of the words of each lane, with room to spare."""
    begins, used, flat, base = np.empty(len(lot.block), np.int64), np.empty(len(lot.block), np.int64), [], 0
    for c, own in zip(coded, lot.own):
        both = np.frombuffer(c, "<u2", offset=HEADER.size, count=(len(c) - HEADER.size) // 2)
        if len(both) < len(own) or len(both) - len(own) != int(both[:len(own)].sum(dtype=np.int64)):
            raise ValueError("a block of token ids is damaged")
        used[own] = both[:len(own)]
        begins[own] = base + np.cumsum(used[own]) - used[own]
        flat.append(both[len(own):])
        base += len(flat[-1])
    width = int(used.max()) + 8
    flat = np.concatenate([*flat, np.zeros(width, np.uint16)])
    rows = flat[begins[:, None] + np.arange(width)]
    rows[np.arange(width) >= used[:, None]] = 0
    return rows


def _decode(coded: list[bytes], sizes: list[int], classes: Classes) -> list[np.ndarray]:
    lot = Lot(sizes)
    lanes, steps, live = len(lot.block), lot.steps, lot.live
    source = _lane_words(coded, lot)
    room = source.shape[1]
    code = source[:, :3].astype(np.uint64) @ np.array([1 << 32, 1 << 16, 1], np.uint64)
    source = source.ravel()
    got = np.arange(lanes) * room + 3
    model = Model(lot, classes)
    width = np.full(lanes, (1 << 48) - 1, np.uint64)
    grid = np.zeros((steps + 2, lanes), np.int32)
    one, alphabet = np.uint64(1), classes.alphabet

    def lengthen(at):
        """Read words for the lanes `at`, whose widths are LOW or less, until all are above it."""
        while len(at):
            place, w = got[at], width[at] << WORD
            code[at] = code[at] << WORD | source.take(place, mode="clip")
            got[at] = place + 1
            width[at] = w
            at = at[w <= LOW]

    t = 0
    for upto in lot.rounds:
        held = []
        for t in range(t, upto):
            n = int(live[t])
            at_one, at_two = model.keys(grid[t + 1, :n].view(np.uint32), grid[t, :n].view(np.uint32), slice(n))
            v_one, v_two = model.one.take(at_one, mode="clip"), model.two.take(at_two, mode="clip")
            state = model.state(v_one, v_two, model.base_state[:n])
            c, w = code[:n], width[:n]
            unit = w >> UNIT_MIX
            second = model.start_zero.take(state, mode="clip")
            second *= unit
            # Lanes whose id another order names, set apart; order 0 is worked out for every lane.
            known = np.flatnonzero(c < second)
            state_known, c_known, end = state[known], c[known], second[known]
            first = model.start_one[state_known] * unit[known]
            by_one = c_known >= first
            w_known = np.where(by_one, end - first, first) >> UNIT_ZERO << UNIT_ZERO
            c_known -= first * by_one
            id_known = np.where(by_one, v_one[known], v_two[known]) >> 2
            c -= second
            unit <<= UNIT_MIX
            unit -= second
            unit >>= UNIT_ZERO
            mark = c // unit
            np.minimum(mark, TOP, out=mark)
            mark = mark.view(np.int64)
            mark += model.base_slot[:n]
            now = model.slots.take(mark, mode="clip")
            place = now + model.base_zero[:n]
            share = model.zero.take(place, mode="clip")
            c -= unit * (share >> 15)
            np.multiply(unit, share & 32767, out=w)
            now += 1
            c[known], w[known] = c_known, w_known
            now[known] = np.maximum(id_known, 1)  # a damaged block must not leave the tables
            unmet = np.flatnonzero(now > alphabet)
            lengthen(np.flatnonzero(w <= LOW))
            others = unmet
            if len(unmet):
                cls = now[unmet] - (alphabet + 1)
                bits = classes.bits[cls]
                ww = w[unmet] >> bits
                inner = np.minimum(c[unmet] // ww, (one << bits) - one)
                c[unmet] -= ww * inner
                w[unmet] = ww
                now[unmet] = np.minimum(classes.start[cls] + inner.astype(np.int64), alphabet)
                lengthen(unmet[ww <= LOW])
                others = model.base_zero[unmet] + now[unmet] - 1
            grid[t + 2, :n] = now
            if upto <= lot.counted:
                state *= 3
                state += 2
                state[known] = 3 * state_known + by_one
                left = np.ones(n, bool)
                left[known] = False
                model.seen_mixed.append(state)
                model.seen_zero += [place[left], others]
            held.append((at_one, at_two, v_one, v_two, now))
        t = upto
        if upto < steps:
            at_one, at_two, v_one, v_two, now = map(np.concatenate, zip(*held))
            fresh = now << 2 | 1
            model.learn(model.one, at_one, v_one, v_one >> 2 == now, fresh)
            model.learn(model.two, at_two, v_two, v_two >> 2 == now, fresh)
        if t in lot.renewals:
            model.renew(t)
    rows = np.ascontiguousarray(grid[2:].T)
    return [rows[own, :lot.length[own[0]]].ravel()[:n].astype(np.int64) - 1 for own, n in zip(lot.own, sizes)]
