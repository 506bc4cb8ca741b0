"""Words of many texts at once: Arrow string columns are cut and hashed as flat byte arrays.

A null text counts as an empty one everywhere in this subpackage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
# The ASCII white space that separates words.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``size`` bytes of text, one row at least, so memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // size
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text in them."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def table_of(separators: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(separators)] = True
    return out


SPACE_TABLE = table_of(SPACES)


def cut(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes that are no separators."""
    size = len(space)
    if not size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~space
    before = np.empty(size, bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = offsets[:-1][offsets[:-1] < size]
    before[first] = False
    after = np.empty(size, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < count:
        size = max(count, CHUNK_BYTES + 4096)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = known
    return known[:count]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes (or of other small numbers), from one running sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    shift = powers(_INVERSE, len(data) + 1)[starts]
    return mix((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each group of consecutive hashes, how often each of the 64 bits is set (lowest bit first)."""
    groups = len(starts)
    sizes = np.diff(np.append(starts, len(hashes)))
    # Eight counters of one byte fit into a word, so groups are first summed in runs of 255.
    runs = -(-sizes // 255)
    run_group = np.repeat(np.arange(groups), runs)
    within = np.arange(len(run_group)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_starts = starts[run_group] + within * 255
    out = np.zeros((groups, 64), np.int64)
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    run_firsts = np.cumsum(runs) - runs
    for k in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, k]], run_starts)
        wide = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        out[:, 8 * k : 8 * k + 8] = np.add.reduceat(wide, run_firsts, axis=0)
    return out


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each group of consecutive hashes: a bit is 1 when set in more than half of them."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = np.diff(np.append(starts, len(hashes)))
    bits = bit_counts(hashes, starts) * 2 > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
