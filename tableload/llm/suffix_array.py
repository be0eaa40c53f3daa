"""Suffix array of one shard by induced sorting, and permuted common prefixes, on numpy arrays.

The shard's text holds small integers and ends with a unique smallest symbol.
Suffixes are classed as smaller or larger than their right neighbour; the
leftmost smaller ones (LMS) are sorted, first by their substrings, then as
suffixes of the string of substring names; the order of all others is induced
from theirs in two scans over the symbol buckets. A bucket's entries are
handled as whole arrays, wave by wave where a symbol repeats. The string of
names has a large alphabet, for which a scan bucket by bucket would be a Python
loop, so its suffixes are sorted by rank doubling, which touches only ranks
that still tie.
"""

from __future__ import annotations

import numpy as np


def _smaller(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right; the last one is."""
    n = len(text)
    out = np.ones(n, dtype=bool)
    step = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    # a symbol equal to the next one takes the class of the next change
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    out[:-1] = np.append(step, -1)[nearest] < 0
    out[:-1] = ~out[:-1]
    # a run of equal symbols before the last one cannot occur: the last symbol is unique
    return out


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix order induced from LMS positions given in an order that is right within each bucket."""
    first = np.searchsorted(text[lms][by := np.argsort(text[lms], kind="stable")], np.arange(symbols + 1))
    seeds = lms[by]
    large: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    small: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    none = np.empty(0, dtype=lms.dtype)

    def send(wave: np.ndarray, c: int, want_small: bool, to: list[list[np.ndarray]]) -> np.ndarray:
        """Put the left neighbours of a wave's entries into their buckets; those of bucket c are the next wave."""
        left = wave[wave > 0] - 1
        left = left[smaller[left] == want_small]
        if not len(left):
            return none
        kind = text[left]
        order = np.argsort(kind, kind="stable")
        left, kind = left[order], kind[order]
        cuts = np.flatnonzero(np.diff(kind)) + 1
        again = none
        for part, d in zip(np.split(left, cuts), kind[np.r_[0, cuts]], strict=True):
            to[d].append(part)
            if d == c:
                again = part
        return again

    for c in range(symbols):
        wave = np.concatenate(large[c]) if large[c] else none
        while len(wave):
            wave = send(wave, c, False, large)
        send(seeds[first[c] : first[c + 1]], c, False, large)
    joined = [np.concatenate(x) if x else none for x in large]
    for c in reversed(range(symbols)):
        wave = np.concatenate(small[c]) if small[c] else none
        while len(wave):
            wave = send(wave, c, True, small)
        send(joined[c][::-1], c, True, small)
    parts = []
    for c in range(symbols):
        parts.append(joined[c])
        if small[c]:
            parts.append(np.concatenate(small[c])[::-1])
    # nothing induces the last suffix; it is the smallest
    return np.concatenate([np.array([len(text) - 1], dtype=lms.dtype), *parts])


def _rank_suffixes(names: np.ndarray) -> np.ndarray:
    """Rank of every suffix of a string of names (its last name is unique and smallest), by doubling."""
    n = len(names)
    rank = names.astype(np.int64)
    reach = 1
    open_ = np.arange(n)
    while True:
        order = np.argsort(rank[open_], kind="stable")
        open_ = open_[order]
        key = rank[open_]
        tied = np.zeros(len(open_), dtype=bool)
        same = key[1:] == key[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        open_ = open_[tied]
        if not len(open_):
            return rank
        # order the tied ones by the rank `reach` further on; ranks leave room for a group's size
        nxt = np.where(open_ + reach < n, rank[np.minimum(open_ + reach, n - 1)], -1)
        order = np.lexsort((nxt, rank[open_]))
        open_, nxt = open_[order], nxt[order]
        key = rank[open_]
        new_group = np.r_[True, key[1:] != key[:-1]]
        new_value = new_group | np.r_[True, nxt[1:] != nxt[:-1]]
        start = np.maximum.accumulate(np.where(new_group, np.arange(len(key)), 0))
        value = np.maximum.accumulate(np.where(new_value, np.arange(len(key)), 0))
        rank[open_] = key + value - start
        reach *= 2


def _dense_with_room(values: np.ndarray) -> np.ndarray:
    """Each sorted value's rank as the number of smaller entries, so that ties can later be told apart."""
    new = np.r_[True, values[1:] != values[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order; ``text`` ends with its unique smallest symbol 0."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    symbols = int(text.max()) + 1
    smaller = _smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        rough = _induce(text, smaller, lms, symbols)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        ordered = rough[is_lms[rough]]
        # equal neighbours in this order get one name: same length and same symbols
        length = np.empty(n, dtype=np.int64)
        length[lms] = np.append(lms[1:], lms[-1]) - lms + 1
        same = (length[ordered[1:]] == length[ordered[:-1]]) & _equal(text, ordered[1:], ordered[:-1], length[ordered[1:]])
        group = np.r_[0, np.cumsum(~same)]
        names = np.empty(n, dtype=np.int64)
        names[ordered] = _dense_with_room(group)
        rank = _rank_suffixes(names[lms])
        lms = lms[np.argsort(rank, kind="stable")]
    return _induce(text, smaller, lms, symbols)


def _equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether text[a:a+length] == text[b:b+length], entry by entry; unequal entries leave early."""
    out = np.ones(len(a), dtype=bool)
    at, k = np.arange(len(a)), 0
    while len(at):
        at = at[length[at] > k]
        differs = text[a[at] + k] != text[b[at] + k]
        out[at[differs]] = False
        at = at[~differs]
        k += 1
    return out


def permuted_lcp(text: np.ndarray, order: np.ndarray, starts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp): each position's predecessor in suffix order and their common prefix length, up to ``cap``.

    Only irreducible positions (the symbols before the two differ) are compared;
    the rest are one less than their left neighbour's. ``starts`` are compared
    too, so that the cap cannot carry over from before them.
    """
    n = len(text)
    phi = np.full(n, -1, dtype=order.dtype)
    phi[order[1:]] = order[:-1]
    here = np.arange(n)
    irreducible = (phi <= 0) | (here == 0)
    inner = ~irreducible
    irreducible[inner] = text[here[inner] - 1] != text[phi[inner] - 1]
    irreducible[starts] = True
    at = np.flatnonzero(irreducible & (phi >= 0))
    plcp = np.zeros(n, dtype=np.int64)
    live, k = at, 0
    while len(live) and k < cap:
        a, b = live + k, phi[live] + k
        fits = (a < n) & (b < n)
        live, a, b = live[fits], a[fits], b[fits]
        live = live[text[a] == text[b]]
        plcp[live] += 1
        k += 1
    last = np.maximum.accumulate(np.where(irreducible, here, 0))
    return phi, np.maximum(plcp[last] - (here - last), 0)
