"""Suffix arrays by linear grouping, and repeated windows of byte strings found with them.

``suffix_array`` groups suffixes by their Lyndon prefix, processing groups from the highest down: the previous smaller
suffix of each member (found through the pointers set so far) gets the member's prefix appended, so it moves to a higher
group. A second walk along the same pointers emits every group's order. Nothing is renamed or sorted recursively.

``repeated_starts`` does not sort every byte: the strings are cut into self-delimiting symbols (a symbol ends with the
white space behind a word that is chosen by its own bytes), ranked as byte strings, and the suffixes at symbol starts are
sorted. No symbol is a prefix of another one, so this is the byte order of these suffixes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

U = np.uint64
_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Hashes of any part of a byte array, equal for equal parts wherever they lie."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        if len(_powers[0]) <= n:
            for k, base in enumerate((_BASE, _INVERSE)):
                powers = np.full(n + n // 4 + 2, base)
                powers[0] = 1
                _powers[k] = np.multiply.accumulate(powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * _powers[0][:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _powers[1][start])

    def grams(self, size: int) -> np.ndarray:
        last = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:last]) * _powers[1][:last])


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The order of the suffixes; the last symbol is the smallest and occurs once."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    values = np.asarray(symbols)
    order_ = np.argsort(values, kind="stable")
    ranked = values[order_]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[first, n])
    of = np.empty(n, np.int64)
    of[order_] = np.repeat(first, sizes)
    place_ = np.empty(n, np.int64)
    place_[order_] = np.arange(n)
    order, group, place = order_.tolist(), of.tolist(), place_.tolist()
    size = [0] * (n + 1)
    for f, s in zip(first.tolist(), sizes.tolist(), strict=True):
        size[f] = s
    smaller = [-1] * n
    last = n - 1
    while last >= 0:
        start = group[order[last]]
        if start == last:
            i = order[last]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                old = group[j]
                if size[old] > 1:
                    # One suffix moves to a group of its own behind its old one.
                    size[old] -= 1
                    end = old + size[old]
                    at, other = place[j], order[end]
                    order[at], order[end] = other, j
                    place[other], place[j] = at, end
                    group[j], size[end] = end, 1
        else:
            count: dict[int, int] = {}
            for i in sorted(order[start : last + 1]):
                j = i - 1
                while j >= 0 and group[j] >= start:
                    j = smaller[j]
                smaller[i] = j
                if j >= 0:
                    count[j] = count.get(j, 0) + 1
            for times in sorted(set(count.values()), reverse=True):
                moved: dict[int, list[int]] = {}
                for j, c in count.items():
                    if c == times:
                        moved.setdefault(group[j], []).append(j)
                for old, members in moved.items():
                    rest = size[old]
                    for j in members:
                        rest -= 1
                        end = old + rest
                        at, other = place[j], order[end]
                        order[at], order[end] = other, j
                        place[other], place[j] = at, end
                    size[old] = rest
                    fresh = old + rest
                    size[fresh] = len(members)
                    for j in members:
                        group[j] = fresh
        last = start - 1
    free, out, done = list(range(n)), [-1] * n, [False] * n
    out[0], done[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = smaller[j]
    return out


def symbol_cuts(data: np.ndarray, bounds: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts behind chosen words (level 0), behind all white space (1), or before every byte (2); and where windows that
    can tell a cut start at last: they hold the white space before the chosen word, the white space, or the byte.
    """
    if level == 2:
        cuts = np.arange(len(data))
        return cuts, cuts + 1
    ends = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    ends = ends[~np.isin(ends + 1, bounds)]
    if level == 1:
        return ends + 1, ends + 1
    word = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    word = np.maximum(word, bounds[np.searchsorted(bounds, ends, "right") - 1])
    whole = word > bounds[np.searchsorted(bounds, ends, "right") - 1]
    ends, word = ends[whole], word[whole]
    chosen = Rolling(data)(word, ends) % U(4) == 0
    return ends[chosen] + 1, word[chosen]


def levels(strings: Sequence[bytes], length: int) -> np.ndarray:
    """For each string the coarsest level at which all its windows hold a cut."""
    bounds = np.r_[0, np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))]
    data = np.frombuffer(b"".join(strings), np.uint8)
    out = np.full(len(strings), 2)
    for level in (1, 0):
        cuts, until = symbol_cuts(data, bounds, level)
        # Windows from the bound before up to this one need this cut.
        string = np.searchsorted(bounds, cuts - 1, "right") - 1
        since = np.r_[0, until[:-1]] if len(cuts) else cuts
        since = np.maximum(since, bounds[string])
        good = np.ones(len(strings), bool)
        good[string[cuts - since > length]] = False
        last = bounds[:-1].copy()
        np.maximum.at(last, string, until)
        good &= last > bounds[1:] - length
        out[good] = level
    return out


def repeated_starts(strings: Sequence[bytes], length: int, level: int | None = None) -> list[np.ndarray]:
    """For each string the starts of its windows of ``length`` bytes that occur elsewhere in the strings, or again in it."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    bounds = np.r_[0, np.cumsum(sizes)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    out = [np.zeros(0, np.int64)] * len(strings)
    if not len(data):
        return out
    if level is None:
        level = int(levels(strings, length).max())
    cuts, until = symbol_cuts(data, bounds, level)
    starts = np.unique(np.r_[bounds[:-1][sizes > 0], cuts[cuts < len(data)]])
    ends = np.r_[starts[1:], len(data)]
    string = np.searchsorted(bounds, starts, "right") - 1
    # Windows since ``low`` and before ``high`` have this symbol start as their first cut; none has a string's start.
    high = np.full(len(starts), -1)
    high[np.searchsorted(starts, cuts[cuts < len(data)])] = until[cuts < len(data)]
    if level < 2:
        high[starts == bounds[string]] = -1
    low = np.maximum.accumulate(np.r_[0, high[:-1]])
    low = np.maximum(low, bounds[string])
    raw = data.tobytes()
    tail = ends == bounds[string + 1]
    # A string's last symbol may be cut off, so it is like no other one.
    texts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    keys = [(t, k + 1) if is_tail else (t, 0) for k, (t, is_tail) in enumerate(zip(texts, tail.tolist(), strict=True))]
    rank = {key: k + 1 for k, key in enumerate(sorted(set(keys)))}
    order = np.array(suffix_array([rank[key] for key in keys] + [0])[1:], np.int64)
    at = starts[order]
    limit = bounds[string[order] + 1] - at
    common = np.zeros(len(at) + 1, np.int64)  # with the suffix before; bytes, at most ``length``
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    for a in range(1, len(at), 1 << 14):
        b = min(len(at), a + (1 << 14))
        view = np.lib.stride_tricks.sliding_window_view(padded, length)
        differ = view[at[a:b]] != view[at[a - 1 : b - 1]]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        common[a:b] = np.minimum(same, np.minimum(limit[a:b], limit[a - 1 : b - 1]))
    # A window starts r bytes before its first cut; alike are those with the same r bytes and alike suffixes.
    reach, least = (starts - low)[order], (starts - high + 1)[order]
    reach = np.where(high[order] < 0, -1, np.minimum(reach, length))
    rolling = Rolling(data)
    found = []
    near = np.maximum(common[:-1], common[1:])
    for r in range(int(reach.max(initial=-1)) + 1):
        depth = length - r
        use = np.flatnonzero((near >= depth) & (reach >= r) & (least <= r) & (limit >= depth))
        if len(use) < 2:
            continue
        cluster = np.cumsum(common[:-1] < depth)[use].astype(np.uint64)
        key = mix(cluster) ^ rolling(at[use] - r, at[use])
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        found.append(at[use[count[inverse] > 1]] - r)
    if found:
        hit = np.sort(np.concatenate(found))
        cuts = np.searchsorted(hit, bounds)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            out[k] = hit[cuts[k] : cuts[k + 1]] - bounds[k]
    return out
