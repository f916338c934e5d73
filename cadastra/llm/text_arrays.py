"""Words and shingles of whole texts as arrays of 64-bit hashes.

A word's hash is a polynomial over random 64-bit symbol values, read off running
sums, so a batch of texts is hashed by a few array operations.  Work proceeds in
slices of bounded size cut between words; a text of any length passes whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SLICE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


@lru_cache(maxsize=1)
def byte_symbols() -> np.ndarray:
    """Bytes of words split at the space and 0x09-0x0D, with A-Z lowered; 0 between words."""
    codes = np.arange(256)
    lowered = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    values = mix(lowered.astype(np.uint64) + np.uint64(1))
    values[[9, 10, 11, 12, 13, 32]] = 0
    return values


@lru_cache(maxsize=1)
def letter_symbols() -> np.ndarray:
    """Code points of words made of letters and digits, lowered; 0 between words."""
    values = np.zeros(0x110000, dtype=np.uint64)
    for code in range(0x110000):
        c = chr(code)
        if c.isalnum():
            values[code] = ord(c.lower()[0]) + 1
    return np.where(values > 0, mix(values), np.uint64(0))


def _slices(between: np.ndarray, size: int):
    """Places to cut at: after a symbol between words, at most ``size`` apart where words allow it."""
    begin, n = 0, len(between)
    while begin < n:
        end = min(begin + size, n)
        if end < n:
            back = np.flatnonzero(between[begin:end])
            if len(back):
                end = begin + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(between[end:])
                end = end + int(ahead[0]) + 1 if len(ahead) else n
        yield begin, end
        begin = end


def word_hashes(texts: list[str | None], letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (one bound more than texts).

    Words are runs of bytes other than the space and 0x09-0x0D with A-Z
    lowered, or, with ``letters``, lower-case runs of letters and digits.
    """
    if letters:
        raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
        symbols, width = letter_symbols(), 4
        codes = np.frombuffer(b" \0\0\0".join([*raw, b""]), dtype="<u4")
    else:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        symbols, width = byte_symbols(), 1
        codes = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    ends_of_text = np.cumsum([len(r) // width + 1 for r in raw])
    hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for begin, end in _slices(symbols[codes] == 0, SLICE) if len(codes) else ():
        values = symbols[codes[begin:end]]
        inside = values != 0
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _power_tables(max(end - begin, SLICE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: end - begin])])
        hashes.append(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))
        places.append(first + begin)
    flat, at = np.concatenate(hashes), np.concatenate(places)
    return flat, np.searchsorted(at, np.concatenate([[0], ends_of_text])).astype(np.int64)


def shingle_sets(texts: list[str | None], size: int, letters: bool = False) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of ``size`` words; fewer words form one shingle, no word none."""
    words, bounds = word_hashes(texts, letters)
    running = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size if len(running) else 0):
        running = mix(running * np.uint64(_BASE) + words[k : k + len(running)])
    sets = []
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - begin >= size:
            sets.append(np.unique(running[begin : end - size + 1]))
        elif end > begin:
            whole = np.full(1, 0x5851F42D4C957F2D + int(end - begin), dtype=np.uint64)
            for w in words[begin:end]:
                whole = mix(whole * np.uint64(_BASE) + w)
            sets.append(whole)
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets
