"""Hashed word and character n-grams of blocks of UTF-8 texts, vectorised.

A block is laid out as one byte string, each text between spaces, so that a
word's first and last bytes meet a boundary as in subword embeddings, and no
n-gram crosses from one text to the next (it would hold a space inside).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACES = bytes(32 if c in (9, 10, 11, 12, 13, 32) else c for c in range(256))
# Odd multipliers of the hashes (any odd numbers do).
MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x2545F491, 0x5851F42D, 0x14057B7F], dtype=np.uint32)


@dataclass
class Block:
    data: np.ndarray            # bytes, white space as 32
    starts: np.ndarray          # of each text in data (its leading space)
    ends: np.ndarray            # past its trailing space

    @staticmethod
    def of(texts: list[bytes | None]) -> Block:
        parts = [(t or b"").translate(SPACES) for t in texts]
        ends = np.cumsum([len(p) + 2 for p in parts]) if parts else np.zeros(0, dtype=np.int64)
        data = np.frombuffer(b" " + b"  ".join(parts) + b" ", dtype=np.uint8) if parts else np.zeros(0, np.uint8)
        return Block(data, np.r_[0, ends[:-1]].astype(np.int64) if parts else ends, ends)


def char_ngrams(block: Block, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte, and whether it counts (it has no space
    inside and is not all boundary)."""
    a = block.data
    m = len(a) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    h = np.full(m, n * 0x3C6EF372 & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(n):
        h += a[k:k + m].astype(np.uint32) * MIX[k]
        h ^= h >> np.uint32(15)
        h *= MIX[7]
    solid = a != 32
    ok = solid[:m] | solid[n - 1:n - 1 + m] if n <= 2 else np.ones(m, dtype=bool)
    for k in range(1, n - 1):
        ok &= solid[k:k + m]
    return (h >> np.uint32(32 - bits)).astype(np.int64), ok


def place_keys(n: int) -> np.ndarray:
    """Pseudo-random 64-bit multiplier of each place in a word. Powers of one base
    would make words of equal letter patterns collide (a Thue-Morse word and its
    complement, whatever the odd base); multipliers without a relation don't."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    codes: np.ndarray           # 64-bit hash of each word
    at: np.ndarray              # where it starts in the block
    first: np.ndarray           # per text: index of its first word
    last: np.ndarray            # past its last word


def words(block: Block) -> Words:
    solid = block.data != 32
    edge = np.diff(np.r_[False, solid, False].astype(np.int8))
    at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(at):
        size = end - at
        power = place_keys(int(size.max()) + 1)
        where = np.arange(len(block.data)) - np.repeat(np.r_[0, at], np.diff(np.r_[0, at, len(block.data)]))
        term = np.where(solid, (block.data.astype(np.uint64) + np.uint64(1)) * power[np.minimum(where, size.max())], np.uint64(0))
        codes = np.add.reduceat(term, at) * np.uint64(0x9E3779B97F4A7C15) ^ size.astype(np.uint64)
    else:
        codes = np.zeros(0, np.uint64)
    return Words(codes, at, np.searchsorted(at, block.starts), np.searchsorted(at, block.ends))


def bucket(codes: np.ndarray, bits: int) -> np.ndarray:
    mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def span_sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of values[first:last] for each span."""
    total = np.r_[0, np.cumsum(values)]
    return total[np.minimum(last, len(values))] - total[np.minimum(first, len(values))]


def distinct_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte strings among data[start:start + size] (every size at least 1):
    the index of one span of each, and which of them each span is. Spans of equal
    hash are compared byte by byte; one that differs becomes a string of its own."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    inside = np.repeat(start, size) + place
    code = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * place_keys(int(size.max()))[place], begin)
    code = (code ^ (code >> np.uint64(31))) + size.astype(np.uint64)
    _, first, which = np.unique(code, return_index=True, return_inverse=True)
    model = first[which]
    same = size == size[model]
    at = np.flatnonzero(same)
    part = np.repeat(same, size)
    model_bytes = data[np.repeat(start[model], size)[part] + place[part]]
    edge = np.cumsum(size[at]) - size[at]
    same[at] = np.logical_and.reduceat(data[inside[part]] == model_bytes, edge)
    other: dict[bytes, int] = {}
    more = []
    for i in np.flatnonzero(~same).tolist():
        word = data[start[i]:start[i] + size[i]].tobytes()
        if word not in other:
            other[word] = len(first) + len(more)
            more.append(i)
        which[i] = other[word]
    return np.r_[first, np.array(more, np.int64)], which
