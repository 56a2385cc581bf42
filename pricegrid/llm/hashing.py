"""Hashes of words and word runs, computed for whole Arrow batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from pricegrid.llm.common import SHINGLE

#: Bytes of text hashed at a time; memory is some fifty times this.
PIECE = 1 << 18

# Fixed odd multipliers.
_BASE = 0x9E6C63D0876A3F6B
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_BASE, PIECE + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over their whole range, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def _piece_hashes(raw: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(np.where(inside, _LOWER[raw], np.uint64(0)) * _POWERS[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(np.uint64))


def _long_hash(raw: np.ndarray) -> int:
    """Hash of a single word of any length, as the pieces have it."""
    total, power = 0, 1
    step = int(pow(_BASE, PIECE, 1 << 64))
    for k in range(0, len(raw), PIECE):
        part = raw[k : k + PIECE]
        total += int((_LOWER[part] * _POWERS[: len(part)]).sum(dtype=np.uint64)) * power
        power = power * step % (1 << 64)
    return int(mixed(np.array([(total + len(raw)) % (1 << 64)], dtype=np.uint64))[0])


def word_hashes(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some bytes, and the word's number at each of the ``breaks``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. No word reaches across a
    break (a place in the bytes, ascending, where a new text begins).
    """
    inside = ~_SPACE[raw]
    before = np.empty(len(raw), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    at_break = np.unique(breaks[(breaks > 0) & (breaks < len(raw))])
    before[at_break] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[at_break - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        begin = int(starts[k])
        last = int(np.searchsorted(ends, begin + PIECE, "right"))
        if last <= k:
            out[k] = _long_hash(raw[begin : int(ends[k])])
            k += 1
            continue
        stop = int(ends[last - 1])
        out[k:last] = _piece_hashes(raw[begin:stop], inside[begin:stop], starts[k:last] - begin, ends[k:last] - begin)
        k = last
    return out, np.searchsorted(starts, breaks, "left")


def text_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a string column without nulls: all words, and where each row's begin."""
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw, bounds = raw[bounds[0] : bounds[-1]], bounds - bounds[0]
    return word_hashes(raw, bounds)


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence when it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    last = n - size + 1
    total = np.full(last, np.uint64(size))
    for k in range(size):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(_STEP) + hashes[k : k + last]
    return mixed(total)


def rows(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[np.ndarray]:
    """Word hashes of each row; ``most`` bytes of text are worked on together."""
    texts = batch[column]
    at = 0
    lengths = np.asarray(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(lengths)])
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        hashes, bounds = text_hashes(texts.slice(at, to - at))
        for k in range(to - at):
            yield hashes[bounds[k] : bounds[k + 1]]
        at = to
