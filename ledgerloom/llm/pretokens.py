"""Splits blocks of text into the pieces of the byte-level tokenizers' pattern, on arrays.

The pattern (public_tokenizers.PATTERN) takes, in this order: a contraction such as 's;
an optional space with letters, with digits or with other signs; white space. On classes of
code points this means: a piece begins where the class changes, the last blank of a run
belongs to what follows, and a lone apostrophe with a contraction's letters is a piece.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import regex
import xxhash

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Longer pieces are told apart by a hash of their bytes, shorter ones by a polynomial.
LONG = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
SURROGATES = range(0xD800, 0xE000)


@functools.cache
def class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    codes = [c for c in range(0x110000) if c not in SURROGATES]
    text = "".join(map(chr, codes))
    codes = np.array(codes)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            table[codes[m.start() : m.end()]] = kind
    return table


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 2**64))
    out = []
    for factor in (BASE, inverse):
        row = np.full(size, factor, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin. codes: code points of several texts; first: True where a text begins."""
    n = len(codes)
    cls = class_table()[codes]
    blank = cls == SPACE
    changed = np.empty(n, bool)
    changed[:1] = True
    np.not_equal(cls[1:], cls[:-1], out=changed[1:])
    changed |= first
    after_space = np.zeros(n, bool)
    after_space[1:] = codes[:-1] == 32
    after_space &= ~first
    start = changed & (blank | ~after_space)
    # The last blank of a run before other characters of its text.
    start[:-1] |= blank[:-1] & ~blank[1:] & ~first[1:]
    quote = np.flatnonzero((codes == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    if len(quote):
        padded = np.append(codes, [0, 0])
        ends = np.append(first, [True, True])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        pair &= ~ends[quote + 2]
        for hit, width in ((quote[short], 2), (quote[pair], 3)):
            start[hit + 1] = False
            rest = hit + width
            rest = rest[rest < n]
            start[rest[~first[rest] & (cls[rest] == LETTER)]] = True
    return start


def split(texts: list[str], starts_of=piece_starts) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(piece number of every piece in order, the distinct pieces, pieces per text)."""
    joined = "".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = len(joined)
    if not n:
        return np.empty(0, np.int64), [], np.zeros(len(texts), np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum(sizes) - sizes
    first = np.zeros(n, bool)
    first[bounds[sizes > 0]] = True
    starts = np.flatnonzero(starts_of(codes, first))
    ends = np.append(starts[1:], n)
    # 1 << 20 is above BLOCK_CHARS, so that the powers are made once; long texts have their own.
    power, inverse = _powers(max(1 << 20, 1 << (n - 1).bit_length()))
    mixed = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= power[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed, out=total[1:])
    keys = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
    for i in np.flatnonzero(ends - starts > LONG):
        keys[i] = xxhash.xxh3_64_intdigest(joined[starts[i] : ends[i]].encode("utf-8", "surrogatepass"))
    number, distinct = pd.factorize(keys)
    place = np.empty(len(distinct), np.int64)
    place[number[::-1]] = np.arange(len(number))[::-1]
    pieces = [joined[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist(), strict=True)]
    upto = np.searchsorted(starts, np.append(bounds, n))
    return number, pieces, np.diff(upto)
