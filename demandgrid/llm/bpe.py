"""Byte-level BPE encoding and decoding with a transducer lexicon.

The frequent words of the corpus (counted over all documents; ``lexicon`` of
them at most, a stated bound that decides speed only) are compiled, with the ids
that merging gives them, into a minimal acyclic automaton: states with equal
continuations are one state, and each arc carries the number of words passed
over, so that the outputs along a path add up to the word's number, which
indexes its ids. The arrays go to every executor as files and are mapped into
memory, one copy for all of an executor's processes. A block's distinct words
run through the automaton together; words that it does not accept are merged
exactly. Decoding joins the tokens' bytes.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.bytebpe import ByteBPE
from demandgrid.llm.common import cut, map_texts
from demandgrid.llm.pretokenize import distinct_words, words

ARRAYS = ("keys", "to", "out", "final", "offset", "ids")


@dataclass
class Lexicon:
    """``keys`` are state * 256 + byte in order, ``to`` and ``out`` each arc's
    next state and output; ``offset`` delimits each word's ``ids``."""
    keys: np.ndarray
    to: np.ndarray
    out: np.ndarray
    final: np.ndarray
    offset: np.ndarray
    ids: np.ndarray

    @staticmethod
    def compile(entries: dict[bytes, list[int]]) -> Lexicon:
        """Minimal automaton of the words, added in order: once a word leaves
        the path of its predecessor, the states left behind can get no more
        arcs and are merged with equal ones."""
        register: dict[tuple, int] = {}
        arcs: list[dict[int, int]] = []             # of registered states
        final: list[bool] = []
        total: list[int] = []                       # words accepted from each state

        def settle(own: dict[int, int], accepts: bool) -> int:
            key = (accepts, tuple(own.items()))
            if key not in register:
                register[key] = len(arcs)
                arcs.append(own)
                final.append(accepts)
                total.append(accepts + sum(total[t] for t in own.values()))
            return register[key]

        path: list[tuple[dict[int, int], list[bool]]] = [({}, [False])]      # the last word's unsettled states
        last = b""

        def close(to: int) -> None:
            while len(path) - 1 > to:
                own, accepts = path.pop()
                path[-1][0][last[len(path) - 1]] = settle(own, accepts[0])

        ordered = sorted(entries)
        for word in ordered:
            k = 0
            while k < min(len(word), len(last)) and word[k] == last[k]:
                k += 1
            close(k)
            path += [({}, [False]) for _ in range(len(word) - k)]
            path[-1][1][0] = True
            last = word
        close(0)
        start = settle(path[0][0], path[0][1][0])
        rows = []
        for state, own in enumerate(arcs):
            passed = int(final[state])
            for byte in sorted(own):
                rows.append((state * 256 + byte, own[byte], passed))
                passed += total[own[byte]]
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        size = np.array([len(entries[w]) for w in ordered], np.int64)
        ids = np.array([i for w in ordered for i in entries[w]], np.uint32)
        # the first state is the one settled last
        assert start == len(arcs) - 1
        return Lexicon(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), np.array(final, bool),
                       np.r_[0, np.cumsum(size)], ids)

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """Each word's number, or -1 if it is not in the lexicon."""
        size = np.array([len(w) for w in found], np.int64)
        data = np.frombuffer(b"".join(found), np.uint8)
        begin = np.cumsum(size) - size
        state = np.full(len(found), len(self.final) - 1, np.int64)
        number, live = np.zeros(len(found), np.int64), np.arange(len(found))
        result, at = np.full(len(found), -1, np.int64), 0
        while len(live):
            ended = size[live] == at
            done = live[ended]
            result[done[self.final[state[done]]]] = number[done[self.final[state[done]]]]
            live = live[~ended]
            key = state[live] * 256 + data[begin[live] + at]
            spot = np.searchsorted(self.keys, key)
            spot[spot == len(self.keys)] = 0
            ok = self.keys[spot] == key if len(self.keys) else np.zeros(len(live), bool)
            live, spot = live[ok], spot[ok]
            state[live] = self.to[spot]
            number[live] += self.out[spot]
            at += 1
        return result


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[k] .. first[k] + size[k] - 1 of all k in a row."""
    begin = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(first, size)


class Codec:
    """Encodes and decodes blocks of texts."""

    def __init__(self, bpe: ByteBPE, lexicon: Lexicon) -> None:
        self.bpe, self.lexicon = bpe, lexicon
        self.sizes = np.array([len(t) for t in bpe.tokens], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(bpe.tokens), np.uint8)

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each whole text (little-endian unsigned 32-bit)."""
        segments, parts = [], []                        # parts: per text, segment numbers and special ids
        for t in texts:
            own = []
            for part in self.bpe.split_special(t or b""):
                if part in self.bpe.special:
                    own.append(-1 - self.bpe.special[part])
                elif part:
                    own.append(len(segments))
                    segments.append(part)
            parts.append(own)
        encoded = self._segments(segments)
        empty = np.zeros(0, "<u4")
        return [np.concatenate([encoded[p] if p >= 0 else np.array([-1 - p], "<u4") for p in own]) if len(own) > 1
                else encoded[own[0]] if own and own[0] >= 0 else np.array([-1 - own[0]], "<u4") if own else empty for own in parts]

    def _segments(self, segments: list[bytes]) -> list[np.ndarray]:
        if not segments:
            return []
        block = words(segments)
        found, which = distinct_words(block)
        number = self.lexicon.numbers(found)
        lex = self.lexicon
        size = np.zeros(len(found), np.int64)
        known = np.flatnonzero(number >= 0)
        size[known] = lex.offset[number[known] + 1] - lex.offset[number[known]]
        unseen = np.flatnonzero(number < 0)
        merged = self.bpe.merge_many([found[k] for k in unseen])
        size[unseen] = [len(m) for m in merged]
        place = np.cumsum(size) - size
        pool = np.empty(int(size.sum()), "<u4")
        pool[_spans(place[known], size[known])] = lex.ids[_spans(lex.offset[number[known]], size[known])]
        pool[_spans(place[unseen], size[unseen])] = [i for m in merged for i in m]
        ids = pool[_spans(place[which], size[which])]
        per = np.bincount(block.segment, weights=size[which], minlength=len(segments)).astype(np.int64)
        ends = np.cumsum(per)
        return [ids[a:b] for a, b in zip((ends - per).tolist(), ends.tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of the ids, as UTF-8 (bytes that are not UTF-8 are replaced)."""
        ids = ids.astype(np.int64)
        raw = self.bytes[_spans(self.offsets[ids], self.sizes[ids])].tobytes()
        return raw.decode("utf-8", "replace").encode()


def frequent_words(docs: DataFrame, bpe: ByteBPE, text_col: str, most: int) -> list[bytes]:
    """The most frequent words of all whole texts: those of the highest classes
    of frequency (an eighth of a power of two each) that hold ``most`` or fewer
    together. Words are counted in each block before they are shuffled, and the
    driver gets the sizes of the classes and the chosen words only."""
    special = list(bpe.special)
    splitter = ByteBPE({}, {}, [], dict.fromkeys(special, 0))

    def block(ids: list, texts: list) -> pa.RecordBatch:
        segments = [p for t in texts for p in splitter.split_special(t or b"") if p and p not in splitter.special]
        if not segments:
            return None
        found, which = distinct_words(words(segments))
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(np.bincount(which, minlength=len(found)))], ["word", "n"])

    counts = map_texts(docs.withColumn("__none", F.lit(0)), "__none", text_col, "word binary, n long", block)
    total = cut(counts.groupBy("word").agg(F.sum("n").alias("n"))
                .select("word", F.floor(F.log2("n") * 8).cast("int").alias("rank")))
    held, lowest = 0, None
    for r in sorted(total.groupBy("rank").count().collect(), reverse=True):
        if held + r["count"] > most:
            break
        held, lowest = held + r["count"], r["rank"]
    if lowest is None:
        return []
    return [bytes(r[0]) for r in total.where(F.col("rank") >= lowest).select("word").collect()]


def ship(spark, lexicon: Lexicon) -> str:
    """Send the arrays to all executors as files (Spark fetches them from the
    driver, also for executors that come later); returns their name."""
    name = f"lexicon-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp(prefix="lexicon-")
    for part in ARRAYS:
        path = os.path.join(folder, f"{name}-{part}.npy")
        np.save(path, getattr(lexicon, part))
        spark.sparkContext.addFile(path)
    return name


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(name: str, path: str) -> Codec:
    """The task process's codec over the mapped arrays."""
    if (name, path) not in _CODECS:
        _CODECS.clear()
        arrays = {part: np.load(SparkFiles.get(f"{name}-{part}.npy"), mmap_mode="r") for part in ARRAYS}
        _CODECS[name, path] = Codec(ByteBPE.load(path), Lexicon(**arrays))
    return _CODECS[name, path]


def build(docs: DataFrame, path: str, text_col: str = "text", lexicon: int = 1 << 17) -> str:
    """Compile the lexicon of the corpus and ship it."""
    bpe = ByteBPE.load(path)
    found = frequent_words(docs, bpe, text_col, lexicon)
    return ship(docs.sparkSession, Lexicon.compile(dict(zip(found, bpe.merge_many(found)))))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon: int = 1 << 17) -> DataFrame:
    """``id, ids`` (array of token ids) of every whole text."""
    name = build(docs, path, text_col, lexicon)

    def block(ids: list, texts: list) -> pa.RecordBatch:
        found = codec(name, path).encode(texts)
        ends = np.cumsum([0, *[len(x) for x in found]])
        flat = np.concatenate([*found, np.zeros(0, "<u4")]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["id", "ids"])

    return map_texts(docs, id_col, text_col, "id long, ids array<int>", block).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` from token ids (null ids give a null text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(ByteBPE.load(path), Lexicon.compile({}))
        for batch in batches:
            texts = [None if x is None else own.decode(np.asarray(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "text"])

    src = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon: int = 1 << 17) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the text
    that the ids decode to).

    Whole texts, a null text is empty; special strings in a text are their one
    token; null ids and repeated rows each keep a row; other columns are
    ignored; an empty table gives no rows (and an empty lexicon)."""
    name = build(docs, path, text_col, lexicon)

    def block(ids: list, texts: list) -> pa.RecordBatch:
        own = codec(name, path)
        found = own.encode(texts)
        sha = hashlib.sha256
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(x) for x in found], pa.int64()),
             pa.array([sha(x.tobytes()).hexdigest() for x in found], pa.string()),
             pa.array([sha(own.decode(x)).hexdigest() for x in found], pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = map_texts(docs, id_col, text_col, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", block)
    return out.withColumnRenamed("id", id_col)
