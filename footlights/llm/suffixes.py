"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes are induced from others: a queue of suffix tuples ``(place, symbol, common prefix with the tuple before)`` is
kept for each range of symbols, taken in order, put in order and made to induce the suffixes one place further left.
Queues and finished lists go to unlinked scratch files of the task beyond a small bound, and texts are mapped files, so a
shard's tuples need not fit in memory. The left-most small suffixes are sorted by recursion on their names, at any number
of names; common prefixes, in bytes and up to a cap, come out of the recursion and are induced with the tuples.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import numpy as np

#: Tuples that the queues of a pass hold in memory; beyond it their full pages are on disk.
HELD_TUPLES = 1 << 20
#: Tuples of a page.
_PAGE = 2048
#: Sources that induce together; their table of minima stays in the cache.
_CHUNK = 1 << 16
#: Ranges of symbols; a byte is a range of its own.
_RANGES = 96

#: Frontiers of a range that have become so small are followed one suffix at a time.
_FEW = 24


def _scratch(values: np.ndarray) -> np.ndarray:
    """The same values as a mapped scratch file."""
    if not len(values):
        return values
    with tempfile.TemporaryFile() as file:
        file.write(np.ascontiguousarray(values).data)
        file.flush()
        return np.asarray(np.memmap(file, values.dtype, "r", shape=values.shape))


class TupleQueues:
    """A first-in-first-out queue of suffix tuples for each range of symbols.

    Beyond ``HELD_TUPLES`` full pages (5 bytes a tuple) go to an unlinked scratch file, whose pages are used again.
    """

    def __init__(self, ranges: int) -> None:
        self.parts: list[list[np.ndarray]] = [[] for _ in range(ranges)]
        self.pages: list[list[int]] = [[] for _ in range(ranges)]
        self.held, self.n_pages, self.free, self.file = 0, 0, [], None

    def push(self, queue: int, tuples: np.ndarray) -> None:
        self.parts[queue].append(tuples)
        self.held += len(tuples)
        if self.held > HELD_TUPLES:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for parts, pages in zip(self.parts, self.pages, strict=True):
            n = sum(map(len, parts)) // _PAGE
            if not n:
                continue
            tuples = np.concatenate(parts)
            own = tuples[: n * _PAGE].reshape(n, _PAGE)
            raw = np.concatenate([_places(own).astype(np.int32).view(np.uint8), _commons(own)], axis=1)
            for row in raw:
                if self.free:
                    slot = self.free.pop()
                else:
                    slot, self.n_pages = self.n_pages, self.n_pages + 1
                self.file.seek(slot * 5 * _PAGE)
                self.file.write(row.data)
                pages.append(slot)
            parts[:] = [tuples[n * _PAGE :].copy()]
            self.held -= n * _PAGE

    def take(self, queue: int, keep: bool = False) -> np.ndarray:
        """All tuples of a queue in the order they came; unless ``keep``, the queue is empty after that."""
        out = list(self.parts[queue])
        if slots := self.pages[queue]:
            raw = np.empty((len(slots), 5 * _PAGE), np.uint8)
            for row, slot in zip(raw, slots, strict=True):
                self.file.seek(slot * 5 * _PAGE)
                self.file.readinto(row.data)
            out.insert(0, _tuples(np.ascontiguousarray(raw[:, : 4 * _PAGE]).view(np.int32).ravel(), raw[:, 4 * _PAGE :].ravel()))
        if not keep:
            self.held -= sum(map(len, self.parts[queue]))
            self.free += self.pages[queue]
            self.parts[queue], self.pages[queue] = [], []
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.int64)


def _tuples(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Suffix tuples as numbers: the place, and in the lowest 8 bits the common prefix with the tuple before."""
    return (place.astype(np.int64) << 8) | common


def _places(tuples: np.ndarray) -> np.ndarray:
    return tuples >> 8


def _commons(tuples: np.ndarray) -> np.ndarray:
    return tuples.astype(np.uint8)


class _Kept(TupleQueues):
    """Queues of the chosen tuples of a pass, whose common prefixes take in those of the tuples left out between them."""

    def __init__(self, ranges: int) -> None:
        super().__init__(ranges)
        self.carried = 255

    def choose(self, queue: int, place: np.ndarray, common: np.ndarray, chosen: np.ndarray) -> None:
        hit = np.flatnonzero(chosen)
        if not len(hit):
            self.carried = min(self.carried, int(common.min()))
            return
        end = int(hit[-1]) + 1
        first = np.zeros(len(hit), np.int64)
        np.add(hit[:-1], 1, out=first[1:])
        least = np.minimum.reduceat(common[:end], first)
        least[0] = min(int(least[0]), self.carried)
        self.carried = int(common[end:].min(initial=255))
        self.push(queue, _tuples(place[hit], least))


def _new(values: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before; the first does."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def _stable(keys: np.ndarray) -> np.ndarray:
    """Order of non-negative 32-bit keys, equal ones by place."""
    if keys.dtype.itemsize == 1:
        return np.argsort(keys, kind="stable")
    width = max(0, len(keys) - 1).bit_length()
    # half as wide numbers are sorted in half the time
    kind = np.uint32 if width + int(keys.max(initial=0)).bit_length() <= 32 else np.int64
    return (np.sort((keys.astype(kind) << kind(width)) | np.arange(len(keys), dtype=kind)) & kind((1 << width) - 1)).astype(np.int64)


_LOG = np.zeros(_CHUNK + 1, np.int64)
for _k in range(1, 17):
    _LOG[1 << _k :] = _k


class Minima:
    """Minima of ranges of at most ``_CHUNK`` small numbers."""

    def __init__(self, values: np.ndarray) -> None:
        rows, width = [values], 1
        while 2 * width <= len(values):
            nxt = rows[-1].copy()
            np.minimum(nxt[: len(values) - width], rows[-1][width:], out=nxt[: len(values) - width])
            rows.append(nxt)
            width *= 2
        self.table, self.n = np.concatenate(rows), len(values)

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of ``values[first : last + 1]``, none of them empty."""
        k = _LOG[last - first + 1]
        row = k * self.n
        return np.minimum(self.table[row + first], self.table[row + last - (1 << k) + 1])


def _segment_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of ``values[first : last + 1]`` for a few ranges."""
    if not len(first):
        return np.zeros(0, np.uint8)
    padded = np.append(values, np.uint8(255))
    return np.minimum.reduceat(padded, np.stack([first, last + 1], 1).ravel())[::2]


class _Level:
    """A text of one level of the recursion: symbols, their lengths in bytes, and the common prefixes of neighbours."""

    def __init__(self, text: np.ndarray, size: int, cap: int, weight: np.ndarray | None, common: np.ndarray | None) -> None:
        self.text, self.size, self.cap = text, size, cap
        self.weight = np.ones(size, np.int16) if weight is None else weight.astype(np.int16)
        self.common = None if common is None else common  # common[s]: of symbols s - 1 and s; None: 0
        n = len(text)
        if weight is None:
            self.ranges = np.arange(size, dtype=np.int32)
        else:
            counts = np.bincount(text, minlength=size)
            before = np.cumsum(counts) - counts
            pieces = max(1, min(_RANGES, n // 2048))
            raw = before * pieces // max(1, n)
            self.ranges = np.unique(raw, return_inverse=True)[1].astype(np.int32)
        self.n_ranges = int(self.ranges[-1]) + 1
        self.small = self._types()

    def _types(self) -> np.ndarray:
        """True where a suffix is smaller than the next one; the end counts as smaller than anything."""
        text, n = self.text, len(self.text)
        step = np.zeros(n, np.int8)
        step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1]).astype(np.int8)
        step[-1] = -1
        flat = np.flatnonzero(step == 0)
        if len(flat):
            # a run of equal symbols has the type of its end
            last = np.flatnonzero(np.r_[flat[1:] != flat[:-1] + 1, True])
            step[flat] = np.repeat(step[flat[last] + 1], np.diff(np.r_[-1, last]))
        return step > 0

    def capped(self, values: np.ndarray) -> np.ndarray:
        return np.minimum(values, self.cap).astype(np.uint8)


class _Pass:
    """One pass over a level: up, large suffixes from the left-most small ones; down, small ones from the large ones.

    Down, symbols are mirrored, so that both passes run from the least symbol. ``seeds`` gives the tuples of a range that
    induce but are not induced: in order, after the induced ones of their symbol, ``common`` towards the seed before.
    """

    def __init__(self, level: _Level, seeds: Callable[[int], np.ndarray], down: bool, exact: bool) -> None:
        self.level, self.seeds, self.down, self.exact = level, seeds, down, exact and level.common is None
        k = level.size
        self.weight = level.weight[::-1] if down else level.weight
        # of mirrored symbols s - 1 and s
        common = level.common
        if common is not None and not exact:  # different symbols must not look like equal ones
            common = np.r_[np.uint8(0), np.minimum(common[1:], np.minimum(level.weight[1:], level.weight[:-1]) - 1).astype(np.uint8)]
        self.between = None if common is None else np.r_[np.uint8(0), common[1:][::-1]] if down else common
        self.range_of = (level.n_ranges - 1 - level.ranges[::-1]).astype(np.int32) if down else level.ranges
        self.starts = np.searchsorted(self.range_of, np.arange(level.n_ranges + 1))
        self.queues = TupleQueues(level.n_ranges)
        # least common prefix among the sources since a symbol's last tuple: inside the call of ``send`` that made that
        # tuple (``sent``), and over the calls from a given one on
        self.since, self.sent, self.calls = np.full(k, 255, np.uint8), np.full(k, -1, np.int32), 0
        self.recent = np.full(64, 255, np.uint8)
        self.last_symbol = -1  # of the sources
        # the symbol that a suffix induces, or -1 (255 for bytes)
        text, small = level.text[:-1], level.small[:-1]
        self.none = 255 if text.dtype == np.uint8 else -1
        self.before = np.full(len(level.text), self.none, text.dtype)
        self.before[1:] = np.where(small if down else ~small, text.dtype.type(k - 1) - text if down else text, text.dtype.type(self.none))

    def symbols(self, places: np.ndarray) -> np.ndarray:
        found = self.level.text[places].astype(np.int32)
        return self.level.size - 1 - found if self.down else found

    def symbol_common(self, symbols: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes that begin with ascending different symbols: of each with the one before."""
        if self.between is None or len(symbols) < 2:
            return np.zeros(max(0, len(symbols) - 1), np.uint8)
        return np.minimum.reduceat(self.between[: symbols[-1] + 1], symbols[:-1] + 1)

    def send(self, places: np.ndarray, common: np.ndarray, before: np.ndarray, number: int) -> None:
        """Let sources, in order, induce tuples (of the symbols ``before``) of the ranges after ``number``."""
        until = int(self.starts[number + 1])
        later = before >= until
        if self.none > 0:
            later &= before != self.none
        for at in range(0, len(places), _CHUNK):
            own = common[at : at + _CHUNK]
            numbers = np.flatnonzero(later[at : at + _CHUNK])
            tail = np.full(len(own) + 1, 255, np.uint8)
            np.minimum.accumulate(own[::-1], out=tail[-2::-1])
            if self.calls == len(self.recent):
                self.recent = np.concatenate([self.recent, np.full(self.calls, 255, np.uint8)])
            if len(numbers):
                symbols = before[at : at + _CHUNK][numbers]
                order = _stable(symbols)
                numbers, symbols = numbers[order], symbols[order]
                new = np.flatnonzero(_new(symbols))
                first = np.zeros(len(numbers), np.int64)
                np.add(numbers[:-1], 1, out=first[1:])
                first[new] = 0
                least = Minima(own).between(first, numbers)
                heads = symbols[new]
                least[new] = np.minimum(least[new], np.minimum(self.since[heads], self.recent[self.sent[heads] + 1]))
                ends = np.append(new[1:], len(numbers)) - 1
                self.since[heads] = tail[numbers[ends] + 1]
                self.sent[heads] = self.calls
                tuples = _tuples(places[at : at + _CHUNK][numbers] - 1, least)
                cuts = np.searchsorted(symbols, self.starts[number + 1 :].astype(symbols.dtype))
                full = np.flatnonzero(cuts[1:] > cuts[:-1])
                for queue, lo, hi in zip((full + number + 1).tolist(), cuts[full].tolist(), cuts[full + 1].tolist(), strict=True):
                    self.queues.push(queue, tuples[lo:hi])
            np.minimum(self.recent[: self.calls + 1], tail[0], out=self.recent[: self.calls + 1])
            self.calls += 1

    def run(self, out: TupleQueues | None, kept: _Kept | None) -> None:
        """Induce everything; ``out`` gets the induced tuples of each range in order, ``kept`` those that induce no more."""
        level = self.level
        if not self.down:
            end = np.array([len(level.text) - 1])
            self.queues.push(int(self.range_of[level.text[end[0]]]), _tuples(end, np.zeros(1, np.uint8)))
        for number in range(level.n_ranges):
            held, seeds = self.queues.take(number), self.seeds(number)
            if not len(held) and not len(seeds):
                continue
            lo, hi = int(self.starts[number]), int(self.starts[number + 1])
            place, symbol, common, before, induced = self.one_symbol(held, seeds, lo) if hi == lo + 1 else self.many_symbols(held, seeds, hi)
            # the first: by the symbols alone
            common[:1] = 0 if self.last_symbol < 0 else self.symbol_common(np.array([self.last_symbol, symbol[0]]))
            self.last_symbol = int(symbol[-1])
            self.send(place, common, before, number)
            if kept is not None:
                kept.choose(number, place, common, induced & (before == self.none) & (place > 0))
            if out is not None and induced.any():
                tuples = _tuples(place, common)
                out.push(number, tuples if induced.all() else tuples[induced])

    def one_symbol(self, held: np.ndarray, seeds: np.ndarray, symbol: int) -> tuple[np.ndarray, ...]:
        """Order of a range of one symbol: what earlier symbols induced, what this symbol induces layer by layer, seeds."""
        weight, cap = int(self.weight[symbol]), self.level.cap
        places, commons, befores = [], [], []
        place, common, depth = _places(held), self.level.capped(_commons(held).astype(np.int16) + weight), weight
        while len(place):
            before = self.before[place]
            places.append(place)
            commons.append(common)
            befores.append(before)
            numbers = np.flatnonzero(before == symbol)
            if not len(numbers):
                break
            place = place[numbers] - 1
            least = np.full(len(place), min(cap, depth), np.int16)
            depth += weight
            if len(place) > 1:
                least[1:] = _segment_minima(common, numbers[:-1] + 1, numbers[1:]).astype(np.int16) + weight
            common = self.level.capped(least)
        n = sum(map(len, places))
        places.append(_places(seeds))
        commons.append(_commons(seeds))
        befores.append(self.before[places[-1]])
        place, common = np.concatenate(places), np.concatenate(commons)
        if n and len(seeds):
            # both begin with runs of the symbol: at least one
            common[n : n + 1] = _extend(self.level.text, place[n - 1 : n], place[n : n + 1], np.zeros(1, np.uint8), cap) if self.exact else np.uint8(min(cap, weight))
        induced = np.ones(len(place), bool)
        induced[n:] = False
        return place, np.full(len(place), symbol, np.int32), common, np.concatenate(befores), induced

    def many_symbols(self, held: np.ndarray, seeds: np.ndarray, until: int) -> tuple[np.ndarray, ...]:
        """Order of a range of several symbols: tuples of equal symbols go by the order of their sources."""
        place, symbol, parent, before, kind, own = self.closed(held, seeds, until)
        total = len(place)
        key = (symbol - symbol.min()) * np.int32(4) + kind if self.level.size < 1 << 28 else symbol.astype(np.int64) * 4 + kind
        order = _stable(key)
        rank = np.empty(total, np.int64)
        rank[order] = np.arange(total)
        inner = np.flatnonzero(kind == 1)
        if len(inner):
            # those of one symbol share the rank of their first, until the ranks of their sources tell them apart
            inner = inner[np.argsort(rank[inner])]
            at = np.arange(len(inner))
            heads = np.maximum.accumulate(np.where(_new(key[inner]), at, 0))
            rank[inner] = rank[inner[heads]]
            ancestor = parent
            while True:
                ties = rank[inner] * total + rank[ancestor[inner]]
                inner = inner[by := np.argsort(ties)]
                ties, old = ties[by], rank[inner]
                new = _new(ties)
                first = np.maximum.accumulate(np.where(_new(old), at, 0))
                rank[inner] = old + np.maximum.accumulate(np.where(new, at, 0)) - first
                if new.all():
                    break
                ancestor = ancestor[ancestor]
            order[rank] = np.arange(total)
        common, kinds, symbols = own[order], kind[order], symbol[order]
        head = _new(symbols)
        heads = np.flatnonzero(head)
        common[heads[1:]] = self.symbol_common(symbols[heads])
        mixed = np.flatnonzero(_new(kinds) & ~head)
        common[mixed] = self.level.capped(self.weight[symbols[mixed]])
        if len(inner):
            both = np.flatnonzero(~head[1:] & (kinds[1:] == 1) & (kinds[:-1] == 1)) + 1
            # two suffixes that the range itself induced: by the order of their sources, which are further up
            first, last = rank[parent[order[both - 1]]] + 1, rank[parent[order[both]]] + 1
            length = self.weight[symbols[both]]
            # those whose range holds none of their kind at once, the others one by one
            free = np.searchsorted(both, first) == np.searchsorted(both, last)
            common[both[free]] = self.level.capped(_segment_minima(common, first[free], last[free] - 1).astype(np.int16) + length[free])
            cap, told = self.level.cap, bytearray(common.tobytes())
            for k, lo, hi, own in zip(both[~free].tolist(), first[~free].tolist(), last[~free].tolist(), length[~free].tolist(), strict=True):
                told[k] = min(cap, own + (told[lo] if hi == lo + 1 else min(told[lo:hi])))
            common = np.frombuffer(told, np.uint8)
        return place[order], symbols, common, before[order], kinds != 2

    def closed(self, held: np.ndarray, seeds: np.ndarray, until: int) -> tuple[np.ndarray, ...]:
        """All suffixes of a range: places, symbols, sources in the range, symbols that they induce, kinds (0 induced from
        before it, 1 from inside, 2 seeds) and common prefixes of neighbours of one symbol of kinds 0 and 2."""
        n_held = len(held)
        place = _places(np.concatenate([held, seeds]))
        symbol = self.symbols(place)
        own = np.concatenate([self.level.capped(_commons(held).astype(np.int16) + self.weight[symbol[:n_held]]), _commons(seeds)])
        n = total = len(place)
        parent = frontier = np.arange(n)
        before = self.before[place]
        places, symbols, parents, befores = [place], [symbol], [parent], [before]
        while len(place):  # by depth
            if len(place) <= _FEW:
                few = self.followed(place.tolist(), before.tolist(), frontier.tolist(), total, until)
                for out, values in zip((places, symbols, parents, befores), few, strict=True):
                    out.append(np.array(values, out[0].dtype))
                total += len(few[0])
                break
            inside = np.flatnonzero((before < until) & (before != self.none))
            place = place[inside] - 1
            symbols.append(before[inside].astype(np.int32))
            parents.append(frontier[inside])
            before = self.before[place]
            places.append(place)
            befores.append(before)
            frontier = np.arange(total, total + len(place))
            total += len(place)
        kind = np.ones(total, np.int8)
        kind[:n_held], kind[n_held:n] = 0, 2
        return *map(np.concatenate, (places, symbols, parents, befores)), kind, np.concatenate([own, np.zeros(total - n, np.uint8)])

    def followed(self, places: list[int], symbols: list[int], numbers: list[int], total: int, until: int) -> tuple[list[int], ...]:
        """What a few suffixes induce inside their range, each followed to its end."""
        induced, none = self.before, self.none
        out: tuple[list[int], ...] = ([], [], [], [])
        for place, symbol, number in zip(places, symbols, numbers, strict=True):
            while none != symbol < until:
                place -= 1
                after = int(induced[place])
                for values, value in zip(out, (place, symbol, number, after), strict=True):
                    values.append(value)
                symbol, number, total = after, total, total + 1
        return out


def _both_passes(level: _Level, places: np.ndarray, common: np.ndarray, exact: bool, large: TupleQueues | None = None, small: TupleQueues | None = None, down_kept: _Kept | None = None) -> None:
    """From the left-most small suffixes, large suffixes by range, upwards, then small ones by mirrored range, downwards.

    ``large`` and ``small`` get all of them, ``down_kept`` the left-most small ones alone. Unless ``exact``, equal symbols
    of the given ones are all that is known. Only large suffixes that follow a small one go from one pass to the other.
    """
    cuts = np.searchsorted(level.ranges[level.text[places]], np.arange(level.n_ranges + 1))
    first = lambda k: _tuples(places[cuts[k] : cuts[k + 1]], common[cuts[k] : cuts[k + 1]])
    turning = _Kept(level.n_ranges)
    _Pass(level, first, False, exact).run(large, turning)

    def downwards(number: int) -> np.ndarray:
        # a tuple's common prefix is that of its successor then; the first of a symbol is set by the pass
        own = turning.take(level.n_ranges - 1 - number)[::-1]
        return _tuples(_places(own), np.append(np.uint8(0), _commons(own)[:-1])) if len(own) else own

    _Pass(level, downwards, True, exact).run(small, down_kept)


def _first_small(small: np.ndarray) -> np.ndarray:
    return np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + np.int32(1)


def _sorted_seeds(level: _Level) -> tuple[np.ndarray, np.ndarray]:
    """Left-most small suffixes in order, with common prefixes: names by a first induction, then recursion."""
    first = _first_small(level.small)
    if len(first) < 2:
        return first, np.zeros(len(first), np.uint8)
    symbols = level.text[first]
    rough = first[_stable(symbols)]
    pieces = _Kept(level.n_ranges)
    _both_passes(level, rough, level.capped(level.weight[level.text[rough]]), False, down_kept=pieces)
    found = np.concatenate([pieces.take(k) for k in range(level.n_ranges)])[::-1]  # they came downwards
    by_piece, common = _places(found), np.zeros(len(found), np.uint8)
    common[1:] = _commons(found)[:-1]  # towards the smaller neighbour
    del found, pieces
    starts = np.zeros(len(level.text), bool)
    starts[first] = True
    # a piece runs from one left-most small suffix to the next, which it includes; the last one to the end
    ends = np.cumsum(level.weight[level.text], dtype=np.int32)
    after = np.append(first[1:], len(level.text) - 1)
    span = ends[after - 1] - ends[first - 1]
    number = np.cumsum(starts, dtype=np.int32)[by_piece] - 1
    length = (span + level.weight[level.text[after]])[number]
    last = number == len(first) - 1
    equal = np.zeros(len(first), bool)
    a, b = slice(0, -1), slice(1, None)
    equal[b] = (common[b] >= level.cap) | ((length[a] == length[b]) & (common[b] >= length[b]) & ~last[a] & ~last[b])
    name = np.cumsum(~equal) - 1
    n_names = int(name[-1]) + 1
    if n_names == len(first):
        return by_piece, common
    reduced = np.empty(len(first), np.int32)
    reduced[number] = name
    weight = np.zeros(n_names, np.int64)
    weight[name] = np.where(length >= level.cap, level.cap, span[number])  # long pieces of one name agree up to the cap
    inner = _Level(_scratch(reduced), n_names, level.cap, np.maximum(weight, 1), common[~equal])
    del ends, starts
    order, found = _ordered(inner)
    return first[order], found


def _ordered(level: _Level) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of a level in order, with common prefixes (at least: exact but for runs that end a piece)."""
    places, common = _sorted_seeds(level)
    large, small = TupleQueues(level.n_ranges), TupleQueues(level.n_ranges)
    _both_passes(level, places, common, True, large, small)
    up = np.concatenate([large.take(k) for k in range(level.n_ranges)])
    down = np.concatenate([small.take(k) for k in range(level.n_ranges)])[::-1]
    own_up, own_down = level.text[_places(up)], level.text[_places(down)]
    n_up, n_down = np.bincount(own_up, minlength=level.size), np.bincount(own_down, minlength=level.size)
    at_up = np.arange(len(up)) + (np.cumsum(n_down) - n_down)[own_up]
    at_down = np.arange(len(down)) + np.cumsum(n_up)[own_down]
    order, out = np.empty(len(level.text), np.int32), np.zeros(len(level.text), np.uint8)
    order[at_up], order[at_down] = _places(up), _places(down)
    out[at_up], out[at_down] = _commons(up), np.r_[np.uint8(0), _commons(down)][:-1]
    symbols = level.text[order]
    head = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    out[head] = 0 if level.common is None else np.r_[np.uint8(0), level.common[1:]][symbols[head]]
    meets = np.zeros(len(order), bool)  # the first small suffix after the large ones of its symbol
    firsts = at_down[np.flatnonzero(np.r_[True, own_down[1:] != own_down[:-1]])] if len(down) else np.zeros(0, int)
    meets[firsts] = True
    meets[head] = False
    out[meets] = level.capped(level.weight[symbols[meets]])
    return order, out


def _extend(text: np.ndarray, a: np.ndarray, b: np.ndarray, common: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of pairs of places, which are at least ``common``, by comparing on from there."""
    out, alive = common.astype(np.int64), np.flatnonzero(common < cap)
    a, b, n = a.astype(np.int64), b.astype(np.int64), len(text)
    while len(alive):
        x, y = a[alive] + out[alive], b[alive] + out[alive]
        alive = alive[(np.maximum(x, y) < n) & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])]
        out[alive] += 1
        alive = alive[out[alive] < cap]
    return out.astype(np.uint8)


def suffix_order(text: np.ndarray, cap: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a text of bytes below 255 in the order of their first ``cap`` bytes, with common prefixes up to ``cap``.

    ``common[k]`` is the length of the common prefix of suffix ``k`` and the one before. Suffixes that agree in ``cap``
    bytes come in any order; a shorter suffix comes first.
    """
    level = _Level(_scratch(text), int(text.max(initial=0)) + 1, cap, None, None)
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32), np.zeros(len(text), np.uint8)
    order, common = _ordered_bytes(level)
    return order, common


def _exact_seeds(level: _Level) -> tuple[np.ndarray, np.ndarray]:
    places, common = _sorted_seeds(level)
    if len(places) > 1:
        common = np.r_[np.uint8(0), _extend(level.text, places[:-1], places[1:], common[1:], level.cap)]
    return places, common


def _ordered_bytes(level: _Level) -> tuple[np.ndarray, np.ndarray]:
    large, small = TupleQueues(level.n_ranges), TupleQueues(level.n_ranges)
    _both_passes(level, *_exact_seeds(level), True, large, small)
    order, common = [], []
    for number in range(level.n_ranges):
        up, down = large.take(number), small.take(level.n_ranges - 1 - number)[::-1]
        place, own = np.r_[_places(up), _places(down)], np.r_[_commons(up), np.r_[np.uint8(0), _commons(down)][:-1]]
        if not len(place):
            continue
        own[0] = 0
        if len(up) and len(down):
            own[len(up)] = _extend(level.text, _places(up[-1:]), _places(down[:1]), np.zeros(1, np.uint8), level.cap)[0]
        order.append(place)
        common.append(own)
    return np.concatenate(order), np.concatenate(common)


class _Hits:
    """What is left of a pass over bytes: the places that agree with a neighbour in ``length`` bytes, and each range's last place."""

    def __init__(self, found: np.ndarray, length: int) -> None:
        self.found, self.length = found, length
        self.last: dict[int, int] = {}

    def push(self, queue: int, tuples: np.ndarray) -> None:
        hit = np.flatnonzero(_commons(tuples) >= self.length)
        self.found[_places(tuples[hit])] = self.found[_places(tuples[hit - 1])] = True
        self.last[queue] = int(_places(tuples[-1]))


def repeated_starts(pieces: list[bytes], copies: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece, which of its places start a string of ``length`` bytes that starts at another place as well.

    ``copies`` tells how many equal pieces one stands for. Strings lie within one piece; places with fewer bytes left
    are false. Pieces are valid UTF-8 or parts of it, so no byte is above 0xF4. ``length`` is at most 254.
    """
    if not pieces:
        return []
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # the end of a piece is 0
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    found = np.zeros(len(text), bool)
    level = _Level(_scratch(text), int(text.max()) + 1, length, None, None)
    large, small = _Hits(found, length), _Hits(found, length)
    _both_passes(level, *_exact_seeds(level), True, large, small)
    for number, a in large.last.items():
        if (b := small.last.get(level.n_ranges - 1 - number)) is not None:  # both begin with a run of one byte
            if _extend(level.text, np.array([a]), np.array([b]), np.zeros(1, np.uint8), length)[0] >= length:
                found[[a, b]] = True
    for k in np.flatnonzero(copies > 1).tolist():
        found[begins[k] : ends[k]] = True
    out = []
    for lo, hi, size in zip(begins.tolist(), ends.tolist(), sizes.tolist(), strict=True):
        own = found[lo:hi].copy()
        own[max(0, size - length + 1) :] = False
        out.append(own)
    return out
