"""Splitting whole text batches into the pre-tokens of byte-level BPE, as numpy arrays.

The pattern is that of the public byte-level vocabularies: contractions, runs of letters, of
digits and of other signs, each with one leading space, and white space. It is applied to all
texts of a batch at once: runs of equal character class are found first, then each run of white
space gives its last character away, and an apostrophe takes the contraction after it.
"""

import re

import numpy as np
import regex

_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3


def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, _SIGN, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for pattern, kind in ((r"\s+", _SPACE), (r"\p{L}+", _LETTER), (r"\p{N}+", _DIGIT)):
        for found in regex.finditer(pattern, every):
            first, last = ord(every[found.start()]), ord(every[found.end() - 1])
            table[first: last + 1] = kind
    table[0xD800:0xE000] = _SIGN
    return table


_TABLE = None


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte where each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[at].astype(np.uint32)
    for least, most, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        some = np.flatnonzero((points >= least) & (points < most)) if len(at) < len(data) else at[:0]
        if len(some):
            value = (data[at[some]] & mask).astype(np.uint32)
            for k in range(1, more + 1):
                value = value << 6 | (data[at[some] + k] & 0x3F)
            points[some] = value + 0x80000000  # not to be taken for the lead byte of a later turn
    points[points >= 0x80000000] -= np.uint32(0x80000000)
    return points, at


def pre_tokens(data: np.ndarray, bounds: np.ndarray, specials: dict[bytes, int]):
    """Starts of all pre-tokens, the special id of each (-1: none), and each text's bounds in them.

    A pre-token ends where the next one starts or where its text ends. `specials` are strings
    that the vocabulary takes as one token wherever they stand.
    """
    global _TABLE
    if _TABLE is None:
        _TABLE = _classes()
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    edges, marked = bounds[:-1][bounds[:-1] < bounds[1:]], {}
    whole = data.tobytes()
    if any(s in whole for s in specials):
        pattern = re.compile(b"|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for found in pattern.finditer(whole, a, b):
                marked[found.start()] = (found.end(), specials[found.group()])
        edges = np.unique(np.concatenate([
            edges, np.array([x for k, (e, _) in marked.items() for x in (k, e)], np.int64)]))
        edges = edges[edges < len(data)]

    points, at = code_points(data)
    n = len(points)
    kinds = _TABLE[points]
    fresh = np.zeros(n + 1, bool)  # a text or the rest behind a special string begins here
    fresh[np.searchsorted(at, edges)] = True
    fresh[n] = True
    begin = fresh.copy()
    begin[1:n] |= kinds[1:] != kinds[:-1]
    first = np.flatnonzero(begin[:n])
    last = np.append(first[1:], n) - 1
    kind = kinds[first]
    ends = fresh[last + 1]  # nothing follows the run in its text
    space = kind == _SPACE
    token = begin
    token[n] = False
    # White space before something else gives its last character away.
    token[last[space & ~ends]] = True
    taken = np.zeros(len(first), bool)
    taken[1:] = (space & ~ends & (points[last] == 32))[:-1]
    token[first[taken]] = False
    # A lone apostrophe that begins a pre-token takes s, t, m, d, re, ve or ll behind it.
    lone = np.flatnonzero((kind == _SIGN) & (points[first] == 39) & (first == last) & ~taken & ~ends)
    lone = lone[kind[lone + 1] == _LETTER]
    if len(lone):
        a = first[lone + 1]
        long = last[lone + 1] > a
        one, two = points[a], np.where(long, points[np.minimum(a + 1, n - 1)], 0)
        pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        width = np.where(np.isin(one, (115, 116, 109, 100)), 1, np.where(pair, 2, 0))
        token[a[width > 0]] = False
        rest = a + width
        token[rest[(width > 0) & (rest <= last[lone + 1])]] = True
    starts = at[np.flatnonzero(token[:n])]
    special = np.full(len(starts), -1, np.int32)
    if marked:
        where = np.array(sorted(marked), np.int64)
        stop = np.array([marked[w][0] for w in where.tolist()])
        inside = np.searchsorted(where, starts, "right") - 1
        within = (inside >= 0) & (starts < stop[inside])
        head = within & (starts == where[inside])
        special[head] = np.array([marked[w][1] for w in where.tolist()], np.int32)[inside[head]]
        starts, special = starts[~within | head], special[~within | head]
    return starts, special, np.searchsorted(starts, bounds)
