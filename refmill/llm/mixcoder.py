"""Adaptive context-mixing range coder for token ids, many blocks in step.

A block is coded on its own: it starts from an empty model and ends with its own checksum. Four
predictions compete for every id: what last followed the two ids before it (order 2), what last followed
the one before it (order 1), how often ids occurred so far (order 0), and all ids alike. They are
mixed with weights that adapt to which of them were right, kept apart by how often the first two
have been right lately and whether they agree. The mixed distribution drives an arithmetic
coder of 64-bit ranges.

The model learns at the end of every epoch, which is a quarter of what came before and at most
MOST_EPOCH positions. All blocks of a segment go through their positions in step, one NumPy lane each. The
encoder, which knows the ids, looks up and mixes a whole epoch at once and goes by positions only to narrow
the ranges; the decoder goes by positions, and learns a whole epoch at once. The share of a range that an id
gets is a product of two shares, 15 bits for its order and 16 bits for its own within the order, so a
position narrows each range once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

from ..session import ship_by_value

ship_by_value(__name__)

BLOCK_IDS = 4096
LEAST_BLOCK_IDS = 512
FEW_BLOCKS = 256  # a segment has at least so many, if they keep LEAST_BLOCK_IDS
LEAST_EPOCH, MOST_EPOCH = 16, 32
EPOCHS_MIXED = 4  # so many epochs at most go by before the weights follow

_TABLE_BITS = 11
_ONE = 1 << 16
_U64, _U32 = np.uint64, np.uint32

MOST_IDS = (1 << 30) - 1
#: entries of the tables: an id, above the trust in it; each table has bits of its own for that, below them is one for contexts
_ID_AT, _TRUST_AT = 5, (3, 1)
_CONTEXTS = 32

#: shares of orders: of all, and what each has at least
_ORDER_BITS = 15
_SCALE = _ORDER_BITS + 16
_LEAST = 32
_LEAST_ROOM = (1 << _ORDER_BITS) - 4 * _LEAST
#: what was seen in a context counts half as much from here on, and beliefs to begin with count so much
_MOST_COUNT, _FIRST_COUNT = 128, 20


def _word(value: int) -> np.ndarray:
    return np.array([value], _U64)


_MIX1, _MIX2, _MIX3 = _word(0x9E3779B185EBCA87), _word(0xC2B2AE3D27D4EB4F), _word(0x165667B19E3779F9)
_HASHED = _word(64 - _TABLE_BITS)
_W16, _W32, _W48, _WSCALE = _word(16), _word(32), _word(48), _word(_SCALE)
_FIELDS = _word(_CONTEXTS - 1)
_W15, _W1 = _word(15), _word(1)
_MASK15, _MASK16, _MASK17, _SMALL_RANGE = _word(0x7FFF), _word(0xFFFF), _word(0x1FFFF), _word(1 << 32)
_NO_INNER = _word(0xFFFFFFFF0000FFFF)
_COUNTED, _ALIKE, _W60 = _word(2 << 60), _word(3 << 60), _word(60)
_THREE, _GUARDS = _word(0x000100010001), _word(0x800080008000)


class CorruptBlock(ValueError):
    """A block whose checksum doesn't fit its bytes."""


def block_sizes(n: int, block: int = BLOCK_IDS) -> np.ndarray:
    """Ids of each block: nearly equal, larger ones first."""
    if not n:
        return np.zeros(0, np.int64)
    most = max(1, min(block, max(LEAST_BLOCK_IDS, n // FEW_BLOCKS)))
    blocks = -(-n // most)
    return n // blocks + (np.arange(blocks) < n % blocks)


def epochs(length: int) -> Iterator[tuple[int, int, bool]]:
    """Positions ``at .. end`` that one state of the model codes, and whether order 0 is renewed behind them."""
    at = known = 0
    while at < length:
        end = min(length, at + min(MOST_EPOCH, max(LEAST_EPOCH, at // 4)))
        renewed = end < length and end >= known + max(LEAST_EPOCH, known // 2)
        yield at, end, renewed
        at, known = end, end if renewed else known


def _first_counts() -> np.ndarray:
    """Beliefs to begin with, by order (2, 1, 0, all ids alike) and context: trust in orders 2 and 1, and whether they agree."""
    found = []
    for two, one, agree in np.ndindex(4, 4, 2):
        trust2, trust1 = 0.25 * two, 0.2 * one * (not agree)
        left = (1 - trust2) * (1 - trust1)
        found.append([trust2, (1 - trust2) * trust1, left * 0.7, left * 0.3])
    return np.rint(np.array(found).T * _FIRST_COUNT).astype(np.int32)


def _shares(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """16-bit shares, start and size, of runs of equal ids in ``n`` sorted ids of each lane; ``starts`` counts all lanes through."""
    start = ((starts - starts // n * n) << 16) // n
    end = np.append(start[1:], 0)
    end[end == 0] = _ONE  # the next lane begins
    return start.astype(_U64), (end - start).astype(_U64)


class Mixer:
    """The models of all lanes.

    Two tables name the id that last followed a context, with trust in it from 1 to 3. ``bounds`` has, for each lane and
    context, where the shares of orders 1, 0 and of all alike begin, 16 bits each.
    """

    def __init__(self, lanes: int, most: int):
        if most > MOST_IDS:
            raise ValueError(f"ids up to {MOST_IDS - 1} can be coded")
        self.lanes = lanes
        self.entries = _U32 if most < 1 << 32 - _ID_AT else _U64
        # an entry that predicts nothing: an id beyond all, without trust
        self.table = np.full(2 * lanes << _TABLE_BITS, most << _ID_AT, self.entries)
        lane = np.arange(lanes, dtype=np.int64)
        self.lane_contexts, self.lane_tables = (lane * _CONTEXTS).view(_U64), (np.stack([lane, lane + lanes]) << _TABLE_BITS).view(_U64)
        self.counts = np.tile(_first_counts(), lanes)
        self.right: list[np.ndarray] = []  # orders and contexts since the weights last followed
        self.coded = 0
        self.mix()

    def mix(self) -> None:
        """The weights, from what was right so far."""
        if self.right:
            right, self.right = np.concatenate(self.right), []
            self.counts += np.bincount(right, minlength=self.counts.size).reshape(self.counts.shape)
        total = self.counts.sum(axis=0, dtype=np.int32)
        bound = np.cumsum(self.counts[:3] * np.int32(_LEAST_ROOM) // total, axis=0, dtype=np.int64)
        bound += np.array([[_LEAST], [2 * _LEAST], [3 * _LEAST]])
        self.bounds = (bound[0] | bound[1] << 16 | bound[2] << 32).view(_U64)
        self.counts -= (self.counts >> 1) * (total > _MOST_COUNT)

    def places(self, last: np.ndarray, second: np.ndarray, out: np.ndarray) -> None:
        """Places in the tables for the last id and that before it, all as 64-bit numbers."""
        low = last * _MIX1
        both = second * _MIX2
        both ^= low
        both *= _MIX3
        both >>= _HASHED
        np.add(both, self.lane_tables[0], out=out[0])
        low >>= _HASHED
        np.add(low, self.lane_tables[1], out=out[1])

    def contexts(self, entry: np.ndarray, out: np.ndarray) -> None:
        """Contexts of the weights: the tables' trust in what they guess, and whether that is the same."""
        differ = (entry[0] ^ entry[1]).astype(_U64, copy=False)
        np.bitwise_and(differ, _FIELDS, out=out)
        out += self.lane_contexts
        out += differ < _CONTEXTS

    def learn(self, place: np.ndarray, entry: np.ndarray, context: np.ndarray, order: np.ndarray, ids: np.ndarray) -> None:
        """Take in the ids of an epoch; ``order`` is 0, 1, 2, 3 for what coded them: orders 2, 1, 0, or all alike."""
        wide = ids.ravel().astype(self.entries) << _ID_AT
        for at, old, shift in zip(place.view(np.int64), entry, _TRUST_AT):
            # right: trusted more; wrong: trusted less, and replaced once little trust is left
            old, new = old.ravel(), wide | 1 << shift
            stays = (((old ^ wide) < 1 << _ID_AT) | (old & 2 << shift > 0)).nonzero()[0]
            kept = old[stays]
            right, full = (kept ^ wide[stays]) < 1 << _ID_AT, (kept >> shift & 3) == 3
            new[stays] = np.where(right, kept + (~full).astype(self.entries) * (1 << shift), kept - (1 << shift))
            self.table[at.ravel()] = new  # of equal places the last one stays
        self.right.append((order * _word(self.lanes * _CONTEXTS) + context).view(np.int64).ravel())
        self.coded += len(ids)
        if len(self.right) == EPOCHS_MIXED or self.coded <= EPOCHS_MIXED * MOST_EPOCH:
            self.mix()


def _codes_ahead(rows: np.ndarray, most: int) -> np.ndarray:
    """How order 0, or all alike, codes all positions and lanes: ``order << 60 | start << 32 | size`` within that share."""
    lanes, length = rows.shape
    bits = max(1, (length - 1).bit_length())
    kind = _U32 if (most - 1).bit_length() + bits <= 32 else _U64
    key = rows.astype(kind) << bits | np.arange(length, dtype=kind)
    key.sort(axis=1)
    new = np.ones(key.shape, bool)
    np.not_equal(key[:, 1:] >> bits, key[:, :-1] >> bits, out=new[:, 1:])
    new, rank = new.ravel(), np.cumsum(new.ravel(), dtype=np.int32)
    rank -= 1  # different ids of all lanes, counted through
    unused = 16 - min(16, (most - 1).bit_length())  # lowest bits of a share of all alike
    low = (key.ravel()[new] >> bits).astype(_U64) & _MASK16
    alike = _ALIKE | low << _word(32 + unused) | _word(1 << unused)
    pos = (key & ((1 << bits) - 1)).astype(np.uint16 if length <= _ONE else _U32)
    del key, new
    ranks = np.empty((lanes, length), np.int32)
    np.put_along_axis(ranks, pos.astype(np.int64), rank.reshape(ranks.shape), axis=1)
    ranks, pos = np.ascontiguousarray(ranks.T), pos.ravel()
    found, end = np.empty((length, lanes), _U64), length
    for n in reversed([end for _, end, renewed in epochs(length) if renewed]):
        keep = (pos < n).nonzero()[0]
        rank, pos = rank.take(keep), pos.take(keep)
        starts = np.append(0, (rank[1:] != rank[:-1]).nonzero()[0] + 1)
        start, size = _shares(starts, n)
        codes = alike.copy()
        codes[rank.take(starts)] = _COUNTED | start << _W32 | size
        codes.take(ranks[n:end], out=found[n:end], mode="clip")
        end = n
    found[:end] = alike.take(ranks[:end])
    return found


class _Out:
    """Ranges of all lanes, and the words that are settled."""

    def __init__(self, lanes: int, length: int):
        self.words = np.zeros((lanes, length // 2 + 8), _U32)
        self.begin = np.arange(lanes, dtype=np.int64) * self.words.shape[1]
        self.at = self.begin.copy()
        self.low, self.span = np.zeros(lanes, _U64), np.full(lanes, (1 << 64) - 1, _U64)

    def room(self, words: int) -> None:
        """Room for so many words more in each lane."""
        used, width = self.at - self.begin, self.words.shape[1]
        if used.max() + words > width:
            self.words = np.concatenate([self.words, np.zeros((len(used), max(words, width)), _U32)], axis=1)
            self.begin = np.arange(len(used), dtype=np.int64) * self.words.shape[1]
            self.at = self.begin + used
        self.flat = self.words.ravel()

    def narrow(self, start: np.ndarray, size: np.ndarray, scale: np.ndarray) -> None:
        """Ranges narrowed to ``start .. start + size`` of ``1 << scale``."""
        low, span = self.low, self.span
        step = span >> scale
        start = start * step
        low += start
        np.multiply(size, step, out=span)
        over = (low < start).nonzero()[0]
        if len(over):
            self._carry(over)
        done = (span < _SMALL_RANGE).nonzero()[0]
        if len(done):
            rest, at = low[done], self.at[done]
            self.flat[at] = rest >> _W32
            self.at[done] = at + 1
            low[done] = rest << _W32
            span[done] <<= _W32

    def _carry(self, lanes: np.ndarray) -> None:
        """Add one to the last word; few carries go further."""
        at = self.at[lanes] - 1
        while len(at):
            more = self.flat[at] + _U32(1)
            self.flat[at] = more
            at = at[more == 0] - 1


def encode(ids: np.ndarray, sizes: np.ndarray, most: int) -> list[bytes]:
    """Words of each block; ``ids`` are those of all blocks in order, all below ``most``."""
    lanes, length = len(sizes), int(sizes[0])
    full = int((sizes == length).sum())
    model, out = Mixer(lanes, most), _Out(lanes, length)
    rows = np.zeros((lanes, length), np.uint16 if most <= _ONE else _U32)  # a short lane's last cell stays unused
    rows[np.arange(length)[None] < sizes[:, None]] = ids
    ahead = _codes_ahead(rows, most)
    rows = np.concatenate([np.zeros((2, lanes), rows.dtype), rows.T])
    high_bits = max(0, (most - 1).bit_length() - 16)
    for at, end, _ in epochs(length):
        now = rows[at + 2 : end + 2]
        before = rows[at : end + 1].astype(_U64)
        place, context = np.empty((2, *now.shape), _U64), np.empty(now.shape, _U64)
        model.places(before[1:], before[:-1], place)
        entry = model.table.take(place.view(np.int64))
        model.contexts(entry, context)
        right = entry >> _ID_AT == now
        code = ahead[at:end]
        np.copyto(code, _word(1 << 60 | _ONE), where=right[1])
        np.copyto(code, _word(_ONE), where=right[0])
        order = code >> _W60
        first, size = _order_share(model.bounds.take(context.view(np.int64)), order << _word(4))
        start, size = (first << _W16) + size * (code >> _W32 & _MASK16), size * (code & _MASK17)
        if end == length:
            start[-1, full:], size[-1, full:] = 0, 1 << _SCALE  # nothing is coded
        if high_bits:
            alike = order == 3
            if end == length:
                alike[-1, full:] = False
            rest, part = np.where(alike, now >> 16, 0).astype(_U64), np.where(alike, 1, 1 << high_bits).astype(_U64)
        out.room((end - at) * 2)
        for n in range(end - at):
            out.narrow(start[n], size[n], _WSCALE)
            if high_bits:
                out.narrow(rest[n], part[n], _word(high_bits))
        if end < length:
            model.learn(place, entry, context, order, now)
    found = []
    for lane, (n, rest) in enumerate(zip((out.at - out.begin).tolist(), out.low.tolist())):
        tail = np.array([rest >> 32, rest & 0xFFFFFFFF], "<u4")
        found.append(out.words[lane, :n].astype("<u4").tobytes() + tail.tobytes())
    return found


def _order_share(bounds: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the shares of orders, given as 16 times their number."""
    first = (bounds << _W16 >> bits) & _MASK15
    return first, ((bounds >> bits) - first) & _MASK15


class _In:
    """Reads words of all lanes; behind a lane's last one come others, which decide nothing."""

    def __init__(self, words: list[np.ndarray]):
        self.stream = np.concatenate([*words, np.zeros(4, "<u4")]).astype(_U64)
        self.at = np.concatenate([[0], np.cumsum([len(w) for w in words])])[:-1].astype(np.int64)
        self.code = (self.stream[self.at] << _W32) | self.stream[self.at + 1]
        self.span = np.full(len(words), (1 << 64) - 1, _U64)
        self.at += 2

    def point(self, scale: np.ndarray) -> np.ndarray:
        self.step = self.span >> scale
        return self.code // self.step

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        code, span = self.code, self.span
        code -= start * self.step
        np.multiply(size, self.step, out=span)
        done = (span < _SMALL_RANGE).nonzero()[0]
        if len(done):
            at = self.at[done]
            code[done] = (code[done] << _W32) | self.stream.take(at, mode="clip")
            span[done] <<= _W32
            self.at[done] = at + 1


def _sorted_before(rows: np.ndarray) -> np.ndarray:
    """Order 0 of the next positions: for each place in the sorted ids of a lane, ``id << 32 | start << 16 | size - 1`` of its run."""
    n = len(rows)
    ids = rows.T.copy()
    ids.sort(axis=1)
    new = np.ones(ids.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=new[:, 1:])
    starts = new.ravel().nonzero()[0]
    start, size = _shares(starts, n)
    runs = ids.ravel()[starts].astype(_U64) << _W32 | start << _W16 | size - _W1
    return np.repeat(runs, np.diff(starts, append=ids.size))


def decode(words: list[np.ndarray], sizes: np.ndarray, most: int) -> np.ndarray:
    """The ids of all blocks in order."""
    lanes, length = len(sizes), int(sizes[0])
    model, source = Mixer(lanes, most), _In(words)
    low_bits, high_bits = min(16, max(0, (most - 1).bit_length())), max(0, (most - 1).bit_length() - 16)
    shift, high = _word(16 - low_bits), _word(high_bits)
    alike_by, alike_and = _word(1 << 32 | 1 << 32 - low_bits), _word((1 << 16 - low_bits) - 1)
    rows = np.zeros((length + 2, lanes), np.uint16 if most <= _ONE else _U32)
    most_epoch = min(length, MOST_EPOCH)
    place = np.empty((2, most_epoch + 1, lanes), _U64)
    entry, context = np.empty((2, most_epoch, lanes), model.entries), np.empty((most_epoch, lanes), _U64)
    place_at, context_at = place.view(np.int64), context.view(np.int64)
    order = np.empty((most_epoch, lanes), _U64)
    # what each order would decode: ``id << 32 | start << 16 | size - 1`` within its share
    coded = np.full((4, lanes), 0xFFFF, _U64)
    guesses, flat, lane = coded[:2], coded.ravel(), np.arange(lanes, dtype=np.int64)
    before, known, lane_before = None, _word(0), lane
    last, second = np.zeros(lanes, _U64), np.zeros(lanes, _U64)
    id_up, lane_count, three, four = _word(32 - _ID_AT), _word(lanes), _word(3), _word(4)
    model.places(last, second, place[:, 0])
    for begin, end, renewed in epochs(length):
        for n in range(end - begin):
            found, bits = entry[:, n], order[n]
            model.table.take(place_at[0, n], out=found[0], mode="clip")
            model.table.take(place_at[1, n], out=found[1], mode="clip")
            model.contexts(found, context[n])
            bounds = model.bounds.take(context_at[n])
            point = source.point(_WSCALE)
            # three comparisons at once: a guard bit above each bound stays where it isn't greater
            apart = (((point >> _W16) * _THREE | _GUARDS) - bounds & _GUARDS) >> _W15
            np.right_shift(apart * _THREE, _W32, out=bits)
            bits &= three
            first, share = _order_share(bounds, bits << four)
            first <<= _W16
            within = (point - first) // share
            np.left_shift(found, id_up, out=guesses)
            guesses &= _NO_INNER
            guesses |= _MASK16
            if before is not None:
                at = (((within + _W1) * known - _W1) >> _W16).view(np.int64)
                at += lane_before
                before.take(at, out=coded[2], mode="clip")
            within >>= shift
            within *= alike_by
            np.bitwise_or(within, alike_and, out=coded[3])
            picked = flat.take((bits * lane_count).view(np.int64) + lane)
            now = picked >> _W32
            source.take(first + share * (picked >> _W16 & _MASK16), share * ((picked & _MASK16) + _W1))
            if high_bits:
                rest = np.where(bits == 3, source.point(high), _U64(0))
                source.take(rest, np.where(bits == 3, _U64(1), _U64(1 << high_bits)))
                now |= rest << _W16
            rows[begin + n + 2] = now
            last, second = now, last
            model.places(last, second, place[:, n + 1])
        if end < length:
            n = end - begin
            model.learn(place[:, :n], entry[:, :n], context[:n], order[:n], rows[begin + 2 : end + 2])
            place[:, 0] = place[:, n]
        if renewed:
            before, known, lane_before = _sorted_before(rows[2 : end + 2]), _word(end), lane * end
    return rows[2:].T[np.arange(length)[None] < sizes[:, None]]


def pack(ids: np.ndarray, most: int, block: int = BLOCK_IDS) -> tuple[np.ndarray, bytes]:
    """Table of blocks (ids, words, CRC-32) and their bytes."""
    sizes = block_sizes(len(ids), block)
    if not len(sizes):
        return np.zeros((0, 3), "<u4"), b""
    words = encode(ids, sizes, most)
    table = np.stack([sizes, [len(w) // 4 for w in words], [zlib.crc32(w, int(n)) for w, n in zip(words, sizes)]], axis=1)
    return table.astype("<u4"), b"".join(words)


def unpack(table: np.ndarray, data: bytes, most: int) -> np.ndarray:
    """The ids again; ``CorruptBlock`` names the first block that fails its checksum."""
    at, words = 0, []
    for n, (size, used, crc) in enumerate(table.tolist()):
        part = data[at : at + 4 * used]
        if len(part) != 4 * used or zlib.crc32(part, size) != crc:
            raise CorruptBlock(f"block {n}")
        words.append(np.frombuffer(part, "<u4"))
        at += 4 * used
    return decode(words, table[:, 0].astype(np.int64), most) if words else np.zeros(0, np.uint16)
