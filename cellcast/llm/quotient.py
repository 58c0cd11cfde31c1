"""Counting quotient filters that lose nothing, and packed integer columns.

A key of ``bits`` bits is permuted by an invertible mixer. Its upper bits are the quotient, kept as a bitmap of occupied
quotients and of run ends; the lower bits are the remainder, kept in full. Counts above 1 have a bit and a byte, large ones eight more. So a filter gives back its keys and their
counts exactly, in the order of the permuted key, and filters of equal ranges merge like sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_HEAD = struct.Struct("<IBB")
_MIXERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def permute(x: np.ndarray, bits: int) -> np.ndarray:
    """A bijection of the ``bits``-bit integers."""
    mask, turn = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    with np.errstate(over="ignore"):
        for m in _MIXERS:
            x = (x ^ (x >> turn)) * np.uint64(m) & mask
    return x ^ (x >> turn)


def restore(x: np.ndarray, bits: int) -> np.ndarray:
    """What ``permute`` was given."""
    mask, turn = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    with np.errstate(over="ignore"):
        x = x ^ (x >> turn)
        for m in reversed(_MIXERS):
            x = x * np.uint64(pow(m, -1, 1 << bits) if bits else 0) & mask
            x = x ^ (x >> turn)
    return x


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and how often each is there."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    if counts is None:
        return keys[first], np.diff(np.r_[first, len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def encode(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of distinct ascending permuted keys below ``2^bits``."""
    n = len(keys)
    width = -(-max(0, bits - max(n, 1).bit_length() + 1) // 8)
    high = max(0, bits - 8 * width)
    quotients = keys >> np.uint64(8 * width) if width < 8 else np.zeros(n, dtype=np.uint64)
    occupied = np.zeros(1 << high, dtype=bool)
    occupied[quotients.astype(np.int64)] = True
    ends = np.r_[quotients[1:] != quotients[:-1], True][:n]
    remainders = np.ascontiguousarray(keys, dtype="<u8").view(np.uint8).reshape(n, 8)[:, :width]
    several = counts > 1
    large = counts[counts >= 255].astype("<i8")
    return b"".join([
        _HEAD.pack(n, bits, width), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), remainders.tobytes(),
        np.packbits(several).tobytes(), np.minimum(counts[several], 255).astype(np.uint8).tobytes(), large.tobytes()])


def decode(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts that ``encode`` was given."""
    n, bits, width = _HEAD.unpack_from(blob)
    data, at = np.frombuffer(blob, dtype=np.uint8), _HEAD.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return data[at - size:at]

    high = max(0, bits - 8 * width)
    slots = np.flatnonzero(np.unpackbits(take(-(-(1 << high) // 8)), count=1 << high)).astype(np.uint64)
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    keys = np.zeros((n, 8), dtype=np.uint8)
    keys[:, :width] = take(n * width).reshape(n, width)
    keys = keys.reshape(-1).view("<u8").astype(np.uint64)
    if n and width < 8:
        keys |= slots[np.cumsum(ends, dtype=np.int64) - ends] << np.uint64(8 * width)
    several = np.flatnonzero(np.unpackbits(take(-(-n // 8)), count=n))
    more = take(len(several)).astype(np.int64)
    more[more == 255] = np.frombuffer(blob, dtype="<i8", offset=at)
    counts = np.ones(n, dtype=np.int64)
    counts[several] = more
    return keys, counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs of keys and counts as one; the sort finds the runs and merges them."""
    return counted(np.concatenate([k for k, _ in filters]), np.concatenate([c for _, c in filters]))


def parts(keys: np.ndarray, bits: int, shard_bits: int) -> list[tuple[int, slice]]:
    """The shards, by upper bits, that ascending keys fall into, and where."""
    shards = (keys >> np.uint64(bits - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]][:len(keys)])
    return [(int(shards[a]), slice(int(a), int(b))) for a, b in zip(cuts, np.r_[cuts[1:], len(keys)])]


def within(keys: np.ndarray, bits: int, shard_bits: int) -> np.ndarray:
    """Keys without their shard."""
    return keys & np.uint64((1 << (bits - shard_bits)) - 1)


def shard_bits(entries: int, each: int) -> int:
    """The least power of two of shards that leaves about ``each`` entries to one."""
    return max(0, (max(entries, 1) - 1) // each).bit_length()


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as compressed byte planes, as many as the largest needs; negative ones need all."""
    low = np.ascontiguousarray(values).astype("<u8")
    width = max(1, -(-int(low.max(initial=0)).bit_length() // 8))
    low = low.view(np.uint8).reshape(-1, 8)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(low[:, :width].T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<i8").astype(np.int64)
