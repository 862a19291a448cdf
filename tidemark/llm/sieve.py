"""A sieve for keys that occur once: batches exchange sorted, shortened keys by range and learn which others have too.

Keys of some bits that are equal by chance only let one through that needn't be; none that two batches have is lost.
A key that many batches have is sent once by each, however often it occurs there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys in a range, on average, and the most ranges.
RANGE, RANGES = 2_000_000, 1 << 18
#: Bits of a key beyond those that number the keys: one in 2**SPARE passes by chance.
SPARE = 7
MESSAGE = "range long, batch long, keys binary"


def key_bits(total: int) -> int:
    return min(62, max(16, math.ceil(math.log2(max(2, total))) + SPARE))


def ranges_for(total: int) -> int:
    return min(RANGES, max(1, math.ceil(total / RANGE)))


def ranges_of(keys: np.ndarray, ranges: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ranges that sorted keys of some bits fall into, and where each begins; the end is the last."""
    width = np.uint64(max(1, -(-(1 << bits) // ranges)))
    of = (keys // width).astype(np.int64)
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    return of[begin], np.append(begin, len(keys))


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the first and the steps, byte by byte, as many bytes as the largest step takes."""
    step = np.diff(keys)
    size = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    return bytes([size]) + keys[:1].tobytes() + np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unpacked(raw: memoryview) -> np.ndarray:
    size, n = raw[0], (len(raw) - 9) // raw[0]
    out = np.zeros((n + 1, 8), np.uint8)
    out[0] = np.frombuffer(raw[1:9], np.uint8)
    out[1:, :size] = np.frombuffer(raw[9:], np.uint8).reshape(size, n).T
    return np.cumsum(out.reshape(-1).view(np.uint64), dtype=np.uint64)


def binaries(column: pa.ChunkedArray) -> list[memoryview]:
    return [memoryview(x.as_buffer()) for x in column]


def message(batch: int, keys: np.ndarray, ranges: int, bits: int) -> pa.Table:
    """What a batch sends: a row of MESSAGE for each range that its sorted distinct keys fall into."""
    of, begin = ranges_of(keys, ranges, bits)
    return pa.table({"range": pa.array(of, pa.int64()), "batch": pa.array([batch] * len(of), pa.int64()), "keys": pa.array([packed(keys[a:b]) for a, b in zip(begin[:-1], begin[1:])], pa.binary())})


def told(keys: np.ndarray, flags: pa.Table, ranges: int, bits: int) -> np.ndarray:
    """For the keys that a batch sent, what it was told of each: whether another batch sent it too."""
    of, begin = ranges_of(keys, ranges, bits)
    known, out = dict(zip(flags["range"].to_pylist(), binaries(flags["flags"]), strict=True)), np.zeros(len(keys), bool)
    for r, a, b in zip(of.tolist(), begin[:-1].tolist(), begin[1:].tolist()):
        if r in known:
            out[a:b] = np.unpackbits(np.frombuffer(known[r], np.uint8))[: b - a]
    return out


def sieve(messages: DataFrame) -> DataFrame:
    """(batch, range, flags) of messages (range, batch, keys): a bit for each key that another batch sent too; none if there is none."""

    def work(table: pa.Table) -> pa.Table:
        parts = [unpacked(x) for x in binaries(table["keys"])]
        every = np.sort(np.concatenate(parts))
        met = np.append(np.unique(every[1:][every[1:] == every[:-1]]), ~np.uint64(0))  # ends in a key that no one has
        twice = [met[np.searchsorted(met, p)] == p for p in parts]
        some = np.flatnonzero([x.any() for x in twice])
        return pa.table({"batch": table["batch"].take(some), "range": table["range"].take(some), "flags": pa.array([np.packbits(twice[k]).tobytes() for k in some], pa.binary())})

    return messages.groupBy("range").applyInArrow(work, "batch long, range long, flags binary")
