"""HyperMinHash signatures of word-shingle sets, computed for blocks of texts at once.

A text's shingle hashes are dealt into buckets; a bucket keeps the smallest one, compressed to a 16-bit
register: the number of leading zeros plus one, then ten mantissa bits. Register 0 is an empty bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np

from logsight.llm.text import U64, Hashed, mix, word_bounds

HASH_BITS = 52
MANTISSA_BITS = 10
BLOCK_BYTES = 2 << 20
SPARSE = 16  # with so few registers held it is cheaper to look at each than to go through an order
BLOCK_ROWS = 2000  # a row number fits beside the hash in 64 bits

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False


@dataclass(frozen=True)
class Banding:
    """Bands of registers; so many that a pair at the threshold is missed with probability `miss` at most."""

    threshold: float
    rows: int = 6
    miss: float = 1e-8

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-(self.threshold**self.rows)))

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after the other, and each text's count.

    ASCII letters count as lower case; words end at spaces, tabs and line ends. A text of fewer words than a
    shingle has is one shingle; a text without words has none.
    """
    n = len(starts) - 1
    begin, end, text = word_bounds(_WORD_BYTE[data], starts)
    w = Hashed(_LOWER[data]).slices(begin, end)
    per_text = np.bincount(text, minlength=n)
    first = np.cumsum(per_text) - per_text
    with np.errstate(over="ignore"):
        full = np.maximum(per_text - words + 1, 0)
        at = np.arange(len(w)) - first[text] < full[text]
        pos = np.flatnonzero(at)
        h = np.zeros(len(pos), U64)
        for k in range(words):
            h = mix(h * U64(31) + w[pos + k])
        owner = text[pos]
        short = np.flatnonzero((per_text > 0) & (per_text < words))
        if len(short):
            s = np.zeros(len(short), U64)
            for k in range(words - 1):
                on = per_text[short] > k
                s[on] = mix(s[on] * U64(31) + w[first[short[on]] + k])
            h = np.concatenate([h, mix(s + per_text[short].astype(U64))])
            owner = np.concatenate([owner, short])
    keys = np.sort((owner.astype(U64) << U64(HASH_BITS)) | (h >> U64(64 - HASH_BITS)))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    counts = np.bincount((keys >> U64(HASH_BITS)).astype(np.int64), minlength=n)
    return keys & U64((1 << HASH_BITS) - 1), counts


def set_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart, as an array of (texts, 2) words."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    with np.errstate(over="ignore"):
        out = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashes ^ U64(salt)))])
            out.append(mix(sums[ends[1:]] - sums[ends[:-1]] + counts.astype(U64)))
    return np.stack(out, axis=1)


def registers(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The registers of each text, (texts, size) of 16 bits; hashes ascend within a text."""
    out = np.zeros((len(counts), size), np.uint16)
    if len(hashes):
        owner = np.repeat(np.arange(len(counts)), counts)
        low = U64(HASH_BITS - 32)
        high, rest = hashes >> low, hashes & ((U64(1) << low) - U64(1))
        scaled = high * U64(size) + ((rest * U64(size)) >> low)
        bucket = (scaled >> U64(32)).astype(np.int64)
        value = ((scaled & U64(0xFFFFFFFF)) << low) | ((rest * U64(size)) & ((U64(1) << low) - U64(1)))
        place = owner * size + bucket
        least = np.concatenate([[True], place[1:] != place[:-1]])
        bits = (value[least].astype(np.float64) + 1.0).view(U64) >> U64(52 - MANTISSA_BITS)
        exponent = (bits >> U64(MANTISSA_BITS)).astype(np.int64) - 1023
        zeros = np.clip(HASH_BITS - 1 - exponent, 0, HASH_BITS)
        mantissa = (bits & U64((1 << MANTISSA_BITS) - 1)).astype(np.int64)
        out.reshape(-1)[place[least]] = ((zeros + 1) << MANTISSA_BITS) | mantissa
    return out


@cache
def _borrowing(size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each register the others in its own order of borrowing, and the place of each in that order."""
    order = np.argsort(mix(np.arange(1, size * size + 1, dtype=U64)).reshape(size, size), axis=1, kind="stable")
    place = np.empty_like(order, dtype=np.int32)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(size, dtype=np.int32), (size, size)), axis=1)
    return order, place


def densified(regs: np.ndarray) -> np.ndarray:
    """Registers in which an empty one has borrowed the first that is held in its own order of all others.

    Two sets then agree in any register with a chance of their similarity, however few shingles they have;
    while empty registers count as equal, short texts with a passage in common meet in most bands. Sets
    without a shingle keep empty registers.
    """
    size = regs.shape[1]
    order, place = _borrowing(size)
    out, held = regs.copy(), regs != 0
    count = held.sum(axis=1)
    for row in np.flatnonzero((count > 0) & (count <= SPARSE)):
        own = np.flatnonzero(held[row])
        source = own[np.argmin(place[:, own], axis=1)]
        out[row] = np.where(held[row], regs[row], regs[row, source])
    row, at = np.nonzero(~held & (count > SPARSE)[:, None])
    for k in range(size):
        if not len(row):
            break
        value = regs[row, order[at, k]]
        found = value != 0
        out[row[found], at[found]] = value[found]
        row, at = row[~found], at[~found]
    return out


def band_keys(regs: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each band of each text, and whether the text has any register, for each band."""
    n, size = regs.shape
    bands = size // rows
    grouped = densified(regs).reshape(n, bands, rows)
    h = np.broadcast_to(np.arange(bands, dtype=U64), (n, bands)).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            h = mix(h * U64(0x9E3779B97F4A7C15) + grouped[:, :, k].astype(U64))
    return h, grouped.any(axis=2)


def accidental(size_a: np.ndarray, size_b: np.ndarray, buckets: int) -> np.ndarray:
    """Chance that the registers of one bucket agree for two unrelated sets of these sizes."""
    a, b = size_a / buckets, size_b / buckets
    s = np.maximum(a + b, 1e-300)
    out = np.zeros(len(a))
    for i in range(HASH_BITS):
        width = 2.0 ** -(i + 1) / (1 << MANTISSA_BITS)
        out += width * (np.exp(-s * 2.0 ** -(i + 1)) - np.exp(-s * 2.0**-i))
    return out * a * b / s


def likely_similar(
    regs_a: np.ndarray, regs_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float, sigmas: float = 6.0
) -> np.ndarray:
    """Whether the collision-corrected similarity estimate reaches the threshold less so many standard errors."""
    used = ((regs_a != 0) | (regs_b != 0)).sum(axis=1)
    n = np.maximum(used, 1)
    share = ((regs_a == regs_b) & (regs_a != 0)).sum(axis=1) / n
    bar = threshold - sigmas * np.sqrt(threshold * (1 - threshold) / n)
    # the correction only lowers a share, so it is worked out for those that reach the bar without it
    out = share >= bar
    at = np.flatnonzero(out)
    chance = accidental(size_a[at], size_b[at], regs_a.shape[1])
    out[at] = (share[at] - chance) / (1 - chance) >= bar[at]
    return out
