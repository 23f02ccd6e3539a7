"""Words and word shingles of whole texts as 64-bit hashes, computed for a batch of documents at once."""

from __future__ import annotations

import numpy as np

from .common import mix64

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def byte_codes() -> np.ndarray:
    """A random 64-bit number for each byte; A-Z have those of a-z."""
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    codes[65:91] = codes[97:123]
    return codes


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """q**i and q**-i modulo 2**64 for i < n; q is odd, so it has an inverse."""
    q = 0x5851F42D4C957F2D
    out = []
    for base in (q, pow(q, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(texts: list[bytes], state: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and how many words each text has.

    A word is a longest run of bytes other than space and 9 to 13. Its hash is a polynomial over its bytes: the
    difference of two running sums, divided by the power of its start.
    """
    if "codes" not in state:
        state["codes"] = byte_codes()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    hashes, firsts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data) - 1:
        end = _cut(data, at)
        part = data[at:end]
        if "powers" not in state or len(state["powers"][0]) < len(part):
            state["powers"] = powers(1 << int(len(part)).bit_length())
        up, down = state["powers"]
        blank = SPACE[part]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(state["codes"][part] * up[: len(part)], out=sums[1:])
        hashes.append(mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        firsts.append(starts + at)
        at = end - 1
    bounds = np.concatenate(([1], 1 + np.cumsum(sizes + 1)))
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(firsts), bounds))


def _cut(data: np.ndarray, at: int, size: int = 1 << 19) -> int:
    """Where a part that starts with the blank at ``at`` ends: after the last blank within ``size`` bytes, else the next one."""
    end = at + size
    if end >= len(data):
        return len(data)
    inside = np.flatnonzero(SPACE[data[at + 1 : end]])
    if len(inside):
        return at + 2 + int(inside[-1])
    while not SPACE[data[end]]:
        step = np.flatnonzero(SPACE[data[end : end + size]])
        end += int(step[0]) if len(step) else size
    return end + 1


def shingle_sets(texts: list[bytes], width: int, state: dict) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer than ``width`` words has its whole word sequence as its one shingle, a text without words none.
    """
    words, counts = word_hashes(texts, state)
    out, at = [], 0
    full = np.zeros(0, np.uint64)
    if len(words) >= width:
        full = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            full = mix64(full + words[k : len(full) + k] * np.uint64(2 * k + 1))
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(full[at : at + n - width + 1]))
        elif n:
            h = np.array([n], np.uint64)
            for k in range(at, at + n):
                h = mix64(h * np.uint64(31) + words[k : k + 1])
            out.append(h)
        else:
            out.append(full[:0])
        at += n
    return out
