"""Vectorised words of Arrow string columns: 64-bit hashes straight from the text buffers.

Words are maximal runs without separators, with A-Z in lower case.  A word's hash is a polynomial of its bytes
modulo 2^64, mixed; two different words agree with a chance of about 2^-64.  Buffers are taken in pieces of a
MB cut between words, so memory does not grow with a text's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = b" \t\n\x0b\x0c\r"
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_MULTIPLIER, _PIECE = 0x9E3779B97F4A7C15, 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    apart = np.zeros(256, bool)
    apart[list(separators)] = True
    value = np.arange(256, dtype=np.uint64) + np.uint64(1)
    value[65:91] += np.uint64(32)
    value[apart] = 0
    return apart, value


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULTIPLIER, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(column: pa.Array, separators: bytes = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets): text i has the hashes[offsets[i]:offsets[i + 1]]; null texts have none."""
    texts = column.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    apart, value = _tables(separators)
    power = _powers(256)
    hashes, starts_at, at, n = [], [], 0, len(data)
    edges = bounds[1:-1]
    while at < n:
        end = min(n, at + _PIECE)
        if end < n:  # a cut at the next separator or text boundary
            ahead = end
            while ahead < n:
                gap = np.flatnonzero(apart[data[ahead : ahead + 4096]])
                if len(gap):
                    ahead += int(gap[0])
                    break
                ahead = min(n, ahead + 4096)
            edge = edges[np.searchsorted(edges, end) :][:1]
            end = min([ahead, *edge.tolist()])
        x = data[at:end]
        inside = ~apart[x]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        here = edges[np.searchsorted(edges, at) : np.searchsorted(edges, end)] - at
        begins[here] = inside[here]
        starts = np.flatnonzero(begins)
        if len(starts):
            length = np.diff(np.append(starts, len(x)))
            if length.max() > len(power):
                power = _powers(int(length.max()))
            place = np.arange(starts[0], len(x)) - np.repeat(starts, length)
            hashes.append(mix(np.add.reduceat(value[x[starts[0] :]] * power[place], starts - starts[0])))
            starts_at.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts = np.concatenate(starts_at)
    return np.concatenate(hashes), np.searchsorted(starts, bounds, "left")


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of runs of ``width`` words, offsets); a text of fewer words is one shingle, without words none."""
    n = np.diff(offsets)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_at = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(offsets[:-1] - out_at[:-1], count) + np.arange(out_at[-1])
    last = np.repeat(offsets[1:], count)
    out = np.zeros(len(first), np.uint64)
    for i in range(width):
        at = first + i
        word = np.where(at < last, hashes[np.minimum(at, max(0, len(hashes) - 1))] if len(hashes) else 0, 0)
        out = mix(out * np.uint64(3) + word.astype(np.uint64) + np.uint64(i + 1))
    return out, out_at


def slices(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs [i, j) of texts with about ``most`` items; a longer text is alone."""
    out, i = [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        out.append((i, j))
        i = j
    return out
