"""Numpy kernels of the substring operator: winnowed anchors, suffix arrays by refinement, common prefixes."""

from __future__ import annotations

import numpy as np

from ._common import mix, powers, prefix_hash, slices

SLICE = 1 << 20


def anchors(body: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of anchors: of each `length`-byte window within a text the leftmost `gram`-byte string of least hash.

    Which string of a window is chosen depends on the window's bytes alone, so equal windows have equal anchors at equal
    distances, wherever they occur. The least is found for keys whose lowest bits hold the place; the windows where whole
    hashes tell otherwise are mended.
    """
    width = length - gram + 1
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for a, b in slices(at, SLICE):
        begin, n = int(at[a]), int(at[b] - at[a])
        if n < length:
            continue
        own = body[begin : begin + n]
        sums, (_, down) = prefix_hash(own), powers(n)
        with np.errstate(over="ignore"):
            value = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        # the least value of each run of `width` grams: halving steps, then its leftmost place
        bits = np.uint64(max(1, (n - 1).bit_length()))
        key = (value >> bits << bits) | np.arange(len(value), dtype=np.uint64)
        least = run_minima(key, width)
        low = least & ((np.uint64(1) << bits) - np.uint64(1))
        whole = run_minima(value, width)
        for w in np.flatnonzero(value[low.astype(np.int64)] != whole):
            low[w] = w + int(np.argmin(value[w : w + width]))
        ends = at[a + 1 : b + 1] - begin
        starts = at[a:b] - begin
        ok = np.zeros(n + 1, np.int32)
        some = ends - starts >= length
        np.add.at(ok, starts[some], 1)
        np.add.at(ok, ends[some] - length + 1, -1)
        chosen = low[np.cumsum(ok[: len(low)]) > 0].astype(np.int64)
        chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])] if len(chosen) else chosen
        places.append(chosen + begin)
        hashes.append(value[chosen])
    return np.concatenate(places), np.concatenate(hashes)


def run_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by halving steps."""
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return least if span == width else np.minimum(least[: len(least) - (width - span)], least[width - span :])


def words_at(text: np.ndarray) -> np.ndarray:
    """At each position the next eight bytes as one big-endian number; zeros stand past the end."""
    padded = np.concatenate([text, np.zeros(72, np.uint8)])
    out = np.zeros(len(text) + 64, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k : k + len(out)]
    return out


def suffix_array(words: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Starts with at least `depth` bytes left, in the order of those bytes (Larsson-Sadakane refinement).

    left: bytes from each position to the end of its region. Groups of equal first bytes are refined by the ranks of the
    positions that follow them, which doubles the depth; a group of one is sorted for good and skipped.
    """
    n = len(left)
    rank = np.zeros(n, np.int64)

    def place(at: np.ndarray, key: np.ndarray, base: np.ndarray | None) -> np.ndarray:
        """Rank positions by key (and, refining, within the groups that begin at base); return those in groups of several."""
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new)
        number = np.repeat(first, np.diff(np.concatenate([first, [len(at)]])))
        if base is None:
            rank[at] = number
        else:
            old = base[order]
            group = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
            begin = np.repeat(group, np.diff(np.concatenate([group, [len(at)]])))
            rank[at] = old + number - begin
        several = np.diff(np.concatenate([first, [len(at)]])) > 1
        return at[np.repeat(several, np.diff(np.concatenate([first, [len(at)]])))]

    at = np.flatnonzero(left >= min(8, depth))
    if not len(at):
        return at
    key = words[at] if depth >= 8 else words[at] >> np.uint64(8 * (8 - depth))
    rest, done = place(at, key, None), min(8, depth)
    while done < depth:
        step = min(done, depth - done)
        rest = rest[left[rest] >= done + step]
        if len(rest):
            base = rank[rest]
            rest = place(rest, base << np.int64(32) | rank[rest + step], base)
        done += step
    whole = np.flatnonzero(left >= depth)
    return whole[np.argsort(rank[whole], kind="stable")]


def common_prefixes(words: np.ndarray, order: np.ndarray, n: int, depth: int, lane: int = 128) -> np.ndarray:
    """For each place but the first of a suffix array: bytes (at most depth) in common with the one before (Kasai).

    Positions are visited in text order. If the neighbour of the next position is the position after this one's neighbour,
    what this one has in common, less a byte, the next one has at least; otherwise (a region's end, or an order that the
    depth left open) the comparison starts afresh. The text is cut into lanes that advance in step; a comparison extends
    by up to eight bytes.
    """
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, np.int64)
    lanes = -(-n // lane)
    begin = np.arange(lanes) * lane
    have, last = np.zeros(lanes, np.int64), np.full(lanes, -2, np.int64)
    for t in range(lane):
        i = begin + t
        inside = i < n
        j = np.full(lanes, -1, np.int64)
        j[inside] = before[i[inside]]
        have, last = np.where((j >= 0) & (j == last + 1), np.maximum(have - 1, 0), 0), np.where(j >= 0, j, -2)
        active = np.flatnonzero(j >= 0)
        while len(active):
            a, h = i[active], have[active]
            differ = words[a + h] ^ words[j[active] + h]
            same = np.zeros(len(active), np.int64)
            for k in range(8):
                same += differ < np.uint64(1 << (8 * k)) if k else differ == 0
            have[active] = np.minimum(h + same, depth)
            active = active[(same == 8) & (have[active] < depth)]
        common[i[inside]] = have[inside]
    return common[order[1:]]
