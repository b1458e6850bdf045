"""Splitting text into words before byte-level merges, as a finite automaton.

The rule (contractions; letters, digits or other signs with one space before
them; white space, of which a last blank joins the next word) needs one
character of look-ahead, so it is an automaton of ten states over pairs
(class of a character, kind of the next one) that marks where words begin.

Texts run as chunks of equal length: all chunks go through the automaton
together from every state, which gives each chunk's state map; the maps are
composed by a parallel prefix scan, which gives each chunk's true first state;
a second pass from there marks the words.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np

from demandgrid.llm.subwords import place_keys

OTHER, LETTER, DIGIT, BLANK, SPACE, APOSTROPHE, SINGLE, R_OR_V, L, E, BREAK = range(11)
NEXT_ELSE, NEXT_SPACE, NEXT_E, NEXT_L, NEXT_END = range(5)
START, LETTERS, DIGITS, SIGNS, QUOTE, SECOND, DONE, JOINING, ALONE, SPACES = range(10)
KINDS, STATES = 5, 10
CHUNK = 256


@cache
def classes() -> np.ndarray:
    """Class of every code point: Unicode letters, numbers and white space."""
    first = {"L": LETTER, "N": DIGIT}
    out = np.array([first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    out[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    for chars, kind in ((" ", BLANK), ("'", APOSTROPHE), ("stmd", SINGLE), ("rv", R_OR_V), ("l", L), ("e", E)):
        out[[ord(c) for c in chars]] = kind
    return out


def _step(state: int, kind: int, after: int) -> tuple[int, bool]:
    """(next state, whether a word begins at this character)."""
    if kind == BREAK:
        return START, False
    if kind in (LETTER, SINGLE, R_OR_V, L, E):
        if state in (LETTERS, JOINING):
            return LETTERS, False
        if state == SECOND:
            return DONE, False
        if state == QUOTE and kind == SINGLE:
            return DONE, False
        if state == QUOTE and (kind == R_OR_V and after == NEXT_E or kind == L and after == NEXT_L):
            return SECOND, False
        return LETTERS, True
    if kind == DIGIT:
        return DIGITS, state not in (DIGITS, JOINING)
    if kind in (OTHER, APOSTROPHE):
        if state in (SIGNS, JOINING, QUOTE):
            return SIGNS, False
        return (QUOTE if kind == APOSTROPHE else SIGNS), True
    more = after in (NEXT_SPACE, NEXT_END)
    if more:
        return SPACES, state != SPACES
    return (JOINING if kind == BLANK else ALONE), True


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(first entry of the next state's row, begins a word) at [state * symbols + symbol]."""
    symbols = (BREAK + 1) * KINDS
    table = np.zeros((STATES, symbols), np.uint8)
    marks = np.zeros((STATES, symbols), bool)
    for s in range(STATES):
        for kind in range(BREAK + 1):
            for after in range(KINDS):
                table[s, kind * KINDS + after], marks[s, kind * KINDS + after] = _step(s, kind, after)
    return (table.astype(np.uint16) * np.uint16(symbols)).ravel(), marks.ravel()


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (a row each), by doubling."""
    out, d = maps.copy(), 1
    while d < len(out):
        out[d:] = np.take_along_axis(out[d:], out[:-d], axis=1)
        d *= 2
    return out


def word_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether a word begins at each character of a class sequence."""
    n = len(kinds)
    if not n:
        return np.zeros(0, bool)
    after_kind = np.array([NEXT_ELSE, NEXT_ELSE, NEXT_ELSE, NEXT_SPACE, NEXT_SPACE, NEXT_ELSE, NEXT_ELSE, NEXT_ELSE,
                           NEXT_L, NEXT_E, NEXT_END], dtype=np.uint8)
    symbols = kinds * np.uint8(KINDS)
    symbols[:-1] += after_kind[kinds[1:]]
    symbols[-1] += NEXT_END
    table, marks = automaton()
    width = len(table) // STATES
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, BREAK * KINDS + NEXT_END, np.uint16)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    rows = (np.arange(STATES) * width).astype(np.uint16)
    maps = np.repeat(rows[:, None], chunks, axis=1)             # a row per first state
    for column in columns:
        maps = table[maps + column]
    state = np.r_[rows[START], compose_scan((maps // width).T)[:-1, START] * np.uint16(width)].astype(np.uint16)
    out = np.empty((CHUNK, chunks), bool)
    for j, column in enumerate(columns):
        at = state + column
        out[j] = marks[at]
        state = table[at]
    return out.T.ravel()[:n]


@dataclass
class WordBlock:
    data: np.ndarray            # UTF-8 bytes of all segments, a zero byte after each
    start: np.ndarray           # first byte of each word
    end: np.ndarray             # past its last byte
    segment: np.ndarray         # its segment
    code: np.ndarray            # 64-bit hash of its bytes


def words(segments: list[bytes]) -> WordBlock:
    """Words of UTF-8 segments (no word crosses from one to the next)."""
    joined = b"\0".join(segments) + b"\0"
    text = joined.decode("utf-8", "replace")
    data = np.frombuffer(joined, np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = classes()[points]
    size = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
    at = np.cumsum(size) - size
    ends = np.cumsum([len(s) + 1 for s in segments]) - 1            # byte of each break
    kinds[np.searchsorted(at, ends)] = BREAK
    start = at[word_starts(kinds)]
    segment = np.searchsorted(ends, start)
    stop = np.minimum(np.r_[start[1:], len(data)], ends[segment]) if len(start) else start
    if len(start):
        longest = int((stop - start).max())
        powers = place_keys(longest + 1)
        place = np.arange(len(data)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(data)]))
        term = (data.astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, longest)]
        term[ends] = 0                                               # breaks belong to no word
        code = np.add.reduceat(term, start) * np.uint64(0x9E3779B97F4A7C15)
        code ^= (code >> np.uint64(32)) + (stop - start).astype(np.uint64)
    else:
        code = np.zeros(0, np.uint64)
    return WordBlock(data, start, stop, segment, code)


def distinct_words(block: WordBlock) -> tuple[list[bytes], np.ndarray]:
    """The block's distinct words, and which of them each word is. Words of equal
    hash are compared byte by byte with the first of them; one that differs (a
    collision) becomes a word of its own."""
    _, first, inverse = np.unique(block.code, return_index=True, return_inverse=True)
    raw = block.data.tobytes()
    found = [raw[s:e] for s, e in zip(block.start[first].tolist(), block.end[first].tolist())]
    size = block.end - block.start
    model = block.start[first][inverse]
    same = size == (block.end - block.start)[first][inverse]
    at = np.flatnonzero(same)
    if len(at):
        size = size[at]
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begin, size)
        equal = block.data[np.repeat(block.start[at], size) + place] == block.data[np.repeat(model[at], size) + place]
        same[at] = np.logical_and.reduceat(equal, begin)
    other: dict[bytes, int] = {}
    for i in np.flatnonzero(~same).tolist():
        word = raw[block.start[i]:block.end[i]]
        if word not in other:
            other[word] = len(found)
            found.append(word)
        inverse[i] = other[word]
    return found, inverse
