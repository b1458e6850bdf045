"""Language-model scoring with a weighted backoff automaton.

Tokens are lower-cased words and one end per text; a state of the automaton is
a run of up to ``order - 1`` tokens seen in training (the beginning of a text
counts as a token), the root the empty run. A state has an arc for every token
that followed it in training, weighted with the smoothed probability of that
n-gram and leading to the longest state that the text then ends with, and one
failure arc to the state without its first token, down to the root, whose arcs
are the smoothed single words. One left-to-right traversal of a text carries the
state and adds up the weights: where a state has no arc for a token, its failure
arc is taken until one has.

Smoothing interpolates: a state seen ``c`` times leaves ``discount * c **
(growth - 1)`` of its mass to its failure arc (distinct successors grow as a power
of the occurrences), the rest goes to its arcs by their counts.

No task or broadcast holds the model. Texts form blocks of bounded size, stored
once, so that both passes see the same blocks whatever the order of the input's
rows or its repetition after a loss. Each block counts its distinct n-grams first
and sends them, sorted by hash, to the parts that own their hash ranges; a part
adds up the counts of all blocks and answers every block in the order it was
asked, so that answers carry no keys; a block builds the automaton of its own
n-grams from the answers and scores its texts. What moves grows with the corpus,
an n-gram counts once a block however often it occurs, and the number of parts
follows the bytes of text, so parts and blocks stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import args as A
from demandgrid.llm.common import LOWER, crc_fold, cut
from demandgrid.llm.subwords import Block, words

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
ODD = np.uint64(0x9E3779B97F4A7C15)
WORDS = 1                               # kind of a message: the length of its n-grams, or
TEXTS, TOTALS = -1, -2
LANE = 512                              # tokens that one lane of the traversal goes through
MESSAGE = "part long, block long, kind int, payload binary"


@dataclass(frozen=True)
class Settings:
    order: int = 2                      # tokens of the longest n-gram (2 or more)
    discount: float = 0.75
    growth: float = 0.8
    block_bytes: int = 6 << 20          # text of a block (a longer text is one of its own)
    part_bytes: int = 4 << 20           # text for each part


def _planes(x: np.ndarray) -> bytes:
    """Bytes of unsigned integers, place by place (high places are mostly zero,
    which the shuffle's compression then removes)."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[len(a) for a in arrays], *[a.itemsize for a in arrays]], np.int64)
    return head.tobytes() + b"".join(_planes(a) for a in arrays)


def _unpack(raw: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 2 * n)
    out, at = [], 8 * (1 + 2 * n)
    for k in range(n):
        count, size = int(head[1 + k]), int(head[1 + n + k])
        out.append(_unplanes(raw[at:at + count * size], {1: np.uint8, 4: np.uint32, 8: np.uint64}[size]))
        at += count * size
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(tokens: np.ndarray, first: np.ndarray, order: int) -> list[tuple[np.ndarray, ...]]:
    """For each length 1 to ``order``: (hashes of the distinct n-grams, place of
    one occurrence's last token, number of the n-gram that ends at each token or
    -1). ``first`` is the place of each text's first token; an n-gram may begin
    with the beginning of the text, which stands before it."""
    n = len(tokens)
    starts = np.zeros(n, bool)
    starts[first] = True
    codes, out = tokens, []
    whole = np.ones(n, bool)                            # an n-gram of this length ends here
    for length in range(1, order + 1):
        if length > 1:
            before = np.r_[BEGIN, codes[:-1]] if n else codes
            if length == 2:
                before[starts] = BEGIN
            else:
                whole = np.r_[False, whole[:-1]] & ~starts if n else whole
            codes = _mix(before * ODD + tokens)
        own, at, number = np.unique(codes[whole], return_index=True, return_inverse=True)
        place = np.full(n, -1)
        place[whole] = number
        out.append((own, np.flatnonzero(whole)[at], place))
    return out


def tokens_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each with its end; tokens of each text)."""
    w = words(Block.of([(t or b"").translate(LOWER) for t in texts]))
    size = w.last - w.first
    return np.insert(_mix(w.codes), np.cumsum(size), END), size + 1


def _ask(hashes: np.ndarray, counts: np.ndarray, parts: int, kind: int, block: int) -> list[tuple]:
    """Messages to the parts that own the (sorted) hashes' ranges."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], dtype=np.uint64)
    cuts = np.r_[0, np.searchsorted(hashes, edges), len(hashes)]
    return [(p, block, kind, _pack(np.diff(hashes[a:b], prepend=np.uint64(0)), counts[a:b].astype(np.uint32)))
            for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]


def _blocks(docs: DataFrame, s: Settings) -> DataFrame:
    """Blocks of texts, a row each: ids, whether they teach, and the texts,
    compressed."""
    def row(block: int, ids: list, texts: list, learn: list) -> pa.RecordBatch:
        size = np.array([len(t or b"") for t in texts], np.uint64)
        marks = _pack(np.array([i or 0 for i in ids], np.int64).view(np.uint64), np.array([i is not None for i in ids]).view(np.uint8),
                      np.array(learn, bool).view(np.uint8), size)
        packed = zstandard.ZstdCompressor(level=3).compress(b"".join(t or b"" for t in texts))
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([marks], pa.binary()), pa.array([packed], pa.binary())],
                                          ["block", "marks", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        size, block = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                if size and size + len(values[1] or b"") > s.block_bytes:
                    yield row(block, *held)
                    held, size, block = ([], [], []), 0, block + 1
                for column, value in zip(held, values):
                    column.append(value)
                size += len(values[1] or b"") + 1
        if held[0]:
            yield row(block, *held)

    return docs.mapInArrow(run, "block long, marks binary, texts binary")


def _messages(blocks: DataFrame, parts: int, s: Settings, asking: bool) -> DataFrame:
    """What blocks ask of the parts, or (not ``asking``) the blocks' texts as
    token numbers."""
    def of_block(block: int, marks: bytes, packed: bytes) -> Iterator[tuple]:
        ids, known, learn, sizes = _unpack(marks)
        raw, ends = zstandard.ZstdDecompressor().decompress(packed), np.cumsum(sizes).tolist()
        tokens, size = tokens_of([raw[a:b] for a, b in zip([0, *ends[:-1]], ends)])
        if not asking:
            own, number = np.unique(tokens, return_inverse=True)
            yield (-1, block, TEXTS, _pack(own, number.astype(np.uint32), size.astype(np.uint32), ids, known))
            return
        weight = np.repeat(learn.astype(np.float64), size)
        for length, (own, _, number) in enumerate(_grams(tokens, np.cumsum(size) - size, s.order), 1):
            whole = number >= 0
            yield from _ask(own, np.bincount(number[whole], weight[whole], len(own)), parts, length, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns]):
                for row in of_block(*values):
                    yield pa.RecordBatch.from_pylist([dict(zip(("part", "block", "kind", "payload"), row))], schema=SCHEMA)

    return blocks.mapInArrow(run, MESSAGE)


SCHEMA = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of each value of a column, from a stream sorted by it."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and held[0][column] != row[column]:
                yield held[0][column], held
                held = []
            held.append(row)
    if held:
        yield held[0][column], held


def _answers(asked: DataFrame) -> DataFrame:
    """Each part's answers: the training count of every n-gram asked for, in the
    order asked; and its totals (block -1): tokens and distinct words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches, 0):
            tokens = distinct = 0
            for kind in sorted({r[2] for r in rows}):
                own = [(r[1], *_unpack(r[3])) for r in rows if r[2] == kind]
                hashes = np.concatenate([np.cumsum(d, dtype=np.uint64) for _, d, _ in own])
                counts = np.concatenate([c for _, _, c in own])
                _, place = np.unique(hashes, return_inverse=True)
                total = np.bincount(place, counts.astype(np.float64)).astype(np.uint64)
                if kind == WORDS:
                    tokens, distinct = int(total.sum()), int((total > 0).sum())
                at = 0
                for block, d, _ in own:
                    yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "kind": kind,
                                                       "payload": _pack(total[place[at:at + len(d)]])}], schema=SCHEMA)
                    at += len(d)
            yield pa.RecordBatch.from_pylist([{"part": part, "block": -1, "kind": TOTALS,
                                               "payload": np.array([tokens, distinct], np.int64).tobytes()}], schema=SCHEMA)

    dealt = asked.repartition("part").sortWithinPartitions("part", "kind", "block")
    return dealt.mapInArrow(run, MESSAGE)


@dataclass
class Automaton:
    """The part of the model that a block's texts can reach. State 0 is the root,
    1 the beginning of a text, the others are the block's n-grams below the order,
    by length; words are numbered within the block."""
    words: int                  # arcs' keys are state * words + word
    keys: np.ndarray            # of the arcs of all states but the root, ascending
    weight: np.ndarray
    target: np.ndarray
    root: np.ndarray            # weight and target of each word's arc at the root
    root_target: np.ndarray
    failure: np.ndarray         # weight and target of each state's failure arc
    back: np.ndarray

    @staticmethod
    def build(grams: list[tuple[np.ndarray, ...]], counts: list[np.ndarray], first: np.ndarray, texts_trained: int,
              tokens: int, distinct: int, s: Settings) -> Automaton:
        """From the n-grams of each length (:func:`_grams`) and their training counts."""
        def left(c: np.ndarray) -> np.ndarray:
            return np.where(c > 0, s.discount * np.maximum(c, 1) ** (s.growth - 1), 1.0)

        n_words = len(counts[0])
        offset = np.cumsum([2, *[len(c) for c in counts]])      # of the states of length 1, 2, ...
        starts = np.zeros(len(grams[0][2]), bool)
        starts[first] = True
        p = [(counts[0] + 0.5) / (tokens + 0.5 * (distinct + 1))]
        failure, back = [np.array([0.0, np.log10(left(np.array([texts_trained]))[0])])], [np.zeros(2, int)]
        keys, weight, target = [], [], []
        for j in range(s.order):                                # n-grams of j + 1 tokens, ending at ``at``
            _, at, _ = grams[j]
            if j:
                shorter = grams[j - 1][2]
                suffix = shorter[at]
                before = np.where(starts[at], -1, shorter[at - 1]) if j == 1 else shorter[at - 1]
                context = np.where(before < 0, 1, offset[j - 1] + before)
                seen = np.where(before < 0, texts_trained, counts[j - 1][before])
                p.append((1 - left(seen)) * counts[j] / np.maximum(seen, 1) + left(seen) * p[j - 1][suffix])
                has = counts[j] > 0
                state = offset[j] + np.arange(len(at)) if j + 1 < s.order else offset[j - 1] + suffix
                keys.append((context * n_words + grams[0][2][at])[has])
                weight.append(np.log10(p[j][has]))
                target.append(state[has])
            if j + 1 < s.order:
                failure.append(np.log10(left(counts[j])))
                back.append(offset[j - 1] + grams[j - 1][2][at] if j else np.zeros(len(at), int))
        keys = np.concatenate(keys)
        by = np.argsort(keys, kind="stable")
        return Automaton(n_words, keys[by], np.concatenate(weight)[by], np.concatenate(target)[by], np.log10(p[0]),
                         np.where(counts[0] > 0, offset[0] + np.arange(n_words), 0), np.concatenate(failure), np.concatenate(back))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One token for each lane: (next state, weight of the arcs taken)."""
        gained, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        lanes = np.arange(len(state))                           # those still without an arc
        while len(lanes):
            top = state == 0
            at_root = lanes[top]
            gained[at_root] += self.root[word[top]]
            after[at_root] = self.root_target[word[top]]
            lanes, state, word = lanes[~top], state[~top], word[~top]
            key = state * self.words + word
            at = np.searchsorted(self.keys, key)
            hit = np.zeros(len(key), bool)
            inside = at < len(self.keys)
            hit[inside] = self.keys[at[inside]] == key[inside]
            gained[lanes[hit]] += self.weight[at[hit]]
            after[lanes[hit]] = self.target[at[hit]]
            lanes, state, word = lanes[~hit], state[~hit], word[~hit]
            gained[lanes] += self.failure[state]
            state = self.back[state]
        return after, gained

    def traverse(self, word: np.ndarray, first: np.ndarray, size: np.ndarray, order: int) -> np.ndarray:
        """Weight gathered at each token, from left to right. Texts run side by side
        as lanes; a long text takes several, each of which starts at the root ``order
        - 1`` tokens early: a state depends on no more, so it is the right one where
        the lane's own tokens begin."""
        lanes = -(-size // LANE)
        text = np.repeat(np.arange(len(size)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        early = np.where(nth > 0, order - 1, 0)
        begin = first[text] + nth * LANE - early
        length = np.minimum(size[text] - nth * LANE, LANE) + early
        by = np.argsort(-length, kind="stable")
        begin, length, early = begin[by], length[by], early[by]
        state = np.where(early > 0, 0, 1)                       # root, or the beginning of a text
        out = np.zeros(len(word))
        active = np.searchsorted(-length, -np.arange(length.max(initial=0)), side="left")
        for i, n in enumerate(active.tolist()):
            place = begin[:n] + i
            state[:n], gained = self.step(state[:n], word[place])
            own = i >= early[:n]
            out[place[own]] = gained[own]
        return out


def _score(rows: list[tuple], texts_trained: int, tokens: int, distinct: int, s: Settings) -> pa.RecordBatch:
    """Scores of one block's texts, from its texts and answers."""
    own, number, size, ids, known = _unpack(next(r[3] for r in rows if r[2] == TEXTS))
    number, size = number.astype(np.int64), size.astype(np.int64)
    last = np.cumsum(size)
    first = last - size
    grams = _grams(own[number], first, s.order)
    counts = [np.concatenate([np.zeros(0, np.uint64), *[_unpack(r[3])[0] for r in sorted(rows, key=lambda r: r[0]) if r[2] == length]]).astype(np.float64)
              for length in range(1, s.order + 1)]
    a = Automaton.build(grams, counts, first, texts_trained, tokens, distinct, s)
    total = lambda x: np.diff(np.r_[0.0, np.cumsum(x)][np.r_[0, last]])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids.view(np.int64), mask=known == 0), pa.array(size), pa.array(np.rint(total((counts[0] > 0)[number].astype(float))).astype(np.int64)),
         pa.array(np.add.reduceat(a.root[number], first)), pa.array(np.add.reduceat(a.traverse(number, first, size, s.order), first))],
        ["id", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1,
          s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (single words, add-half) and ``score``.

    Whole texts; a null or blank text is its end token alone; a null id is in
    the fold of the empty text; repeated rows are counted and scored each; other
    columns are ignored; an empty table gives no rows. The order of the input's
    rows changes no score."""
    A.at_least("order", s.order, 2)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
                      (crc_fold(id_col, folds) != held_out).alias("learn"))
    size = src.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("learn"), 1))).first()
    parts = max(1, -(-(size[0] or 0) // s.part_bytes))
    trained = size[1]
    blocks = cut(_blocks(src, s))
    answers = cut(_answers(_messages(blocks, parts, s, asking=True)))
    totals = answers.where(F.col("kind") == TOTALS).select("payload")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([np.frombuffer(r, np.int64) for r in batch.column(0).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["tokens", "distinct"])

    sums = totals.mapInArrow(read, "tokens long, distinct long").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = int(sums[0] or 0), int(sums[1] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, 1):
            yield _score(rows, trained, tokens, distinct, s)

    held = _messages(blocks, parts, s, asking=False).unionByName(answers.where(F.col("kind") != TOTALS))
    out = (held.repartition("block").sortWithinPartitions("block", "kind", "part")
           .mapInArrow(run, "id long, n_tokens long, n_known long, base_score double, score double"))
    return out.select(F.col("id").alias(id_col), (crc_fold("id", folds) == held_out).alias("held_out"), "n_tokens", "n_known",
                      F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")

