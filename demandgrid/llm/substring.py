"""Substring deduplication: passages that repeat across documents.

Paragraphs (lines) are compared by MinHash banding over five-word shingles
(those of fewer than five words are equal or not):
bands are tuned for recall at the similarity asked for, colliding paragraphs
are joined, compared by a sketch and, where that does not rule them out, verified by
exact Jaccard similarity, and verified links form components. Of each component one
occurrence stays. A bucket's members are joined to ``centres`` of them, which is all
pairs in small buckets. In larger ones where only a few members are outside the
commonest component so far, these few are compared with all; the others are banded
again with longer keys, so that false collisions fall apart, and with more centres,
until no bucket holds two that were not compared and are not of one component already.

A passage may also sit inside longer paragraphs that differ around it, or go
over line ends that differ. Every run of consecutive word windows of a text,
whatever its lines, therefore contributes its smallest window as a
sub-paragraph, so two texts that share a passage of ``window + run - 1`` words
or more (50 by default) share a sub-paragraph at the same place of the passage;
these are equal or not, so their one band is their whole content. Shared ones
are extended: all windows that start less than ``run`` words from one that two
texts share are compared in turn, each with the first text that has it there, and
windows in a row that follow the same first text make up one passage. A shared
passage of 50 words or more holds a chosen window every ``run`` words at most, so
every one of its windows is among them and the whole passage is reported.

Groups of equal content are aggregated before anything is joined, links are
stars, and an occurrence is only ever joined to its group's summary row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, log
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import LOWER, connected_components, cut, map_texts, pack_texts, tasks_for
from demandgrid.llm.subwords import Block, words

# MinHash values of the longest bands.
LONGEST = 8
ODD = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
# Texts are worked on in blocks of so many bytes: the arrays of a block take a
# multiple of it in each Python worker.
BLOCK = 1 << 20
FIELDS = ["id", "start", "n_words", "low", "low_start"]
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    recall: float = 0.98        # of a pair just at the similarity, by at least one band
    rows: int = 2               # MinHash values in a band
    window: int = 20            # words of a sub-paragraph
    run: int = 31               # consecutive windows that contribute one at least
    centres: int = 8            # members of a bucket that all others are compared with
    sketch: int = 1024          # MinHash values (a bit each) that a pair is compared by first
    margin: float = 0.05        # below the similarity, at which a sketched pair is let go (2.6 deviations)

    def bands_of(self, rows: int) -> int:
        return ceil(log(1 - self.recall) / log(1 - self.similarity ** rows))

    @property
    def bands(self) -> int:
        return self.bands_of(self.rows)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, dtype=np.uint64)])


@dataclass
class Paragraphs:
    codes: np.ndarray           # word hashes of the block, lower-cased
    text: np.ndarray            # text of each paragraph
    start: np.ndarray           # its first word, counted within the text
    first: np.ndarray           # its first word in the block
    last: np.ndarray            # past its last word


def paragraphs(texts: list[bytes | None]) -> Paragraphs:
    lower = [(t or b"").translate(LOWER) for t in texts]
    block = Block.of(lower)
    raw = np.frombuffer(b" " + b"  ".join(lower) + b" ", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    w = words(block)
    text = np.searchsorted(block.ends, w.at, side="right")
    line = np.searchsorted(np.flatnonzero(raw == 10), w.at)
    new = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(line) != 0)]) if len(w.at) else np.zeros(0, np.int64)
    return Paragraphs(w.codes, text[new], new - w.first[text[new]], new, np.r_[new[1:], len(w.at)] if len(new) else new)


def _runs(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices first[k] .. first[k] + size[k] - 1 of all k in a row, and where
    each k begins among them."""
    begin = np.r_[0, np.cumsum(size)[:-1]] if len(size) else np.zeros(0, np.int64)
    return np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(first, size), begin


def _gram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (shorter at the block's end)."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(n):
        out[:len(codes) - k] = _mix(out[:len(codes) - k] * ODD + codes[k:] + np.uint64(k + 1))
    return out


def _contents(p: Paragraphs, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the words from ``first`` on, ``size`` of them, wherever they are."""
    n = len(p.codes)
    total = np.r_[np.uint64(0), np.cumsum(_mix(p.codes) * _powers(STEP, max(0, n - 1))[:n])]
    return _mix((total[first + size] - total[first]) * _powers(BACK, n)[first] + size.astype(np.uint64))


def shingle_sets(p: Paragraphs, which: np.ndarray, s: Settings) -> list[np.ndarray]:
    grams = _gram_codes(p.codes, s.shingle)
    return [np.unique(grams[p.first[k]:max(p.first[k] + 1, p.last[k] - s.shingle + 1)]) for k in which]


def band_keys(grams: np.ndarray, begin: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Band keys of shingle sets laid out one after the other, a row per set."""
    keys = np.empty((len(begin), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(begin), np.uint64(rows << 16 | band))
        for row in range(rows):
            salt = _mix(np.array([rows << 16 | band * rows + row + 1], dtype=np.uint64))[0]
            key = _mix(key * ODD + np.minimum.reduceat(_mix(grams ^ salt), begin))
        keys[:, band] = key
    return keys


def sketches(grams: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """The lowest bits of ``n`` MinHash values of each shingle set, 64 in a long:
    two sets agree in a share (1 + similarity) / 2 of them."""
    out = np.zeros((len(begin), n // 64), np.uint64)
    for k in range(n):
        salt = _mix(np.array([1 << 40 | k], dtype=np.uint64))[0]
        low = np.minimum.reduceat(_mix(grams ^ salt), begin) & np.uint64(1)
        out[:, k // 64] |= low << np.uint64(k % 64)
    return out.view(np.int64)


def paragraph_rows(p: Paragraphs, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contents of all, numbers of those of a shingle or more, their band keys)."""
    size = p.last - p.first
    content = _contents(p, p.first, size)
    which = np.flatnonzero(size >= s.shingle)
    if not len(which):
        return content, which, np.zeros((0, s.bands), np.uint64)
    at, begin = _runs(p.first[which], size[which] - s.shingle + 1)
    return content, which, band_keys(_gram_codes(p.codes, s.shingle)[at], begin, s.rows, s.bands)


def text_windows(p: Paragraphs, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, first word in the block, number of windows) of each text that has
    words."""
    new = np.flatnonzero(np.r_[True, np.diff(p.text) != 0]) if len(p.text) else np.zeros(0, np.int64)
    first = p.first[new]
    return p.text[new], first, np.r_[first[1:], len(p.codes)][:len(first)] - first - s.window + 1


def near_windows(p: Paragraphs, starts: list[list[int]], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start within the text, content) of all windows that start less than
    ``run`` words from one of the text's ``starts``."""
    text, first, size = text_windows(p, s)
    at, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(size > 0):
        near = np.zeros(size[k] + 1, np.int64)
        mid = np.asarray(starts[text[k]], dtype=np.int64)
        np.add.at(near, np.maximum(mid - s.run + 1, 0), 1)
        np.add.at(near, np.minimum(mid + s.run, size[k]), -1)
        at.append(np.flatnonzero(np.cumsum(near)[:-1] > 0) + first[k])
        owner.append(np.full(len(at[-1]), text[k]))
    at, owner = np.concatenate(at), np.concatenate(owner)
    begin = np.zeros(len(starts), np.int64)
    begin[text] = first
    return owner, at - begin[owner], _contents(p, at, np.full(len(at), s.window))


def sub_paragraphs(p: Paragraphs, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(first word in the block, content) of the chosen windows."""
    _, first, size = text_windows(p, s)
    long = np.flatnonzero(size >= s.run)
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, begin = _runs(first[long], size[long])
    content = _contents(p, at, np.full(len(at), s.window))
    order = _mix(content ^ ODD)
    runs = np.lib.stride_tricks.sliding_window_view(order, s.run)
    inside = np.ones(len(runs), bool)
    for k in range(1, s.run):                           # no run across texts
        edge = begin[1:] - k
        inside[edge[(edge >= 0) & (edge < len(runs))]] = False
    picks = np.empty(len(runs), np.int64)
    for k in range(0, len(runs), 1 << 16):
        picks[k:k + (1 << 16)] = runs[k:k + (1 << 16)].argmin(axis=1)
    chosen = np.unique((np.arange(len(runs)) + picks)[inside])
    return at[chosen], content[chosen]


def _paragraph_table(docs: DataFrame, s: Settings) -> DataFrame:
    def block(ids: list, texts: list) -> pa.RecordBatch:
        p = paragraphs(texts)
        content, which, keys = paragraph_rows(p, s)
        n = np.zeros(len(content), np.int32)
        n[which] = s.bands
        bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(keys.ravel().view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(ids, dtype=np.int64)[p.text]), pa.array(p.start), pa.array(p.last - p.first),
             pa.array(content.view(np.int64)), bands], ["id", "start", "n_words", "content", "bands"])

    return map_texts(docs, "id", "text", "id long, start long, n_words long, content long, bands array<long>", block, BLOCK)


def _place_table(docs: DataFrame) -> DataFrame:
    """The paragraphs without their band keys."""
    def block(ids: list, texts: list) -> pa.RecordBatch:
        p = paragraphs(texts)
        size = p.last - p.first
        return pa.RecordBatch.from_arrays([pa.array(np.array(ids, dtype=np.int64)[p.text]), pa.array(p.start), pa.array(size),
                                           pa.array(_contents(p, p.first, size).view(np.int64))], ["id", "start", "n_words", "content"])

    return map_texts(docs, "id", "text", "id long, start long, n_words long, content long", block, BLOCK)


def _window_table(docs: DataFrame, s: Settings) -> DataFrame:
    def block(ids: list, texts: list) -> pa.RecordBatch:
        p = paragraphs(texts)
        first, content = sub_paragraphs(p, s)
        k = np.searchsorted(p.first, first, side="right") - 1
        owner = np.array(ids, dtype=np.int64)[p.text[k]] if len(k) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(first - p.first[k] + p.start[k]), pa.array(content.view(np.int64))],
            ["id", "start", "content"])

    return map_texts(docs, "id", "text", "id long, start long, content long", block, BLOCK)


def _near_table(docs: DataFrame, shared: DataFrame, s: Settings) -> DataFrame:
    """``id, start, content`` of the windows near those of ``shared`` (id, start),
    from the whole texts."""
    texts = pack_texts(docs, "id", "text").join(shared.groupBy("id").agg(F.collect_set("start").alias("starts")), "id")

    def block(ids: list, texts: list, starts: list) -> pa.RecordBatch:
        text, start, content = near_windows(paragraphs(texts), starts, s)
        return pa.RecordBatch.from_arrays([pa.array(np.array(ids, dtype=np.int64)[text]), pa.array(start), pa.array(content.view(np.int64))],
                                          ["id", "start", "content"])

    return map_texts(texts, "id", "text", "id long, start long, content long", block, BLOCK, extra=("starts",), packed=True)


def _shared_windows(windows: DataFrame) -> DataFrame:
    """The windows that more than one id has, with their first occurrence: ``id,
    start, low, low_start``. One shuffle; each task reads its windows sorted, as a
    stream, and holds no more of one content than the first id's occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)               # of the last content: the first id's windows, not shared so far
        known = None                                    # or its content, first id and start, once it is shared
        for batch in batches:
            rows = np.hstack([held, np.stack([c.to_numpy() for c in batch.columns])])
            if not rows.shape[1]:
                continue
            new = np.flatnonzero(np.r_[True, np.diff(rows[0]) != 0])
            size = np.diff(np.r_[new, rows.shape[1]])
            low, low_start = rows[1, new], rows[2, new]
            goes_on = known is not None and known[0] == rows[0, 0]
            if goes_on:
                low[0], low_start[0] = known[1:]
            shared = rows[1, new + size - 1] != low     # sorted: the last id is another one
            if goes_on:
                shared[0] = True
            here = np.repeat(shared, size)
            if here.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[here]) for x in (rows[1], rows[2], np.repeat(low, size), np.repeat(low_start, size))],
                                                 ["id", "start", "low", "low_start"])
            known = (rows[0, -1], low[-1], low_start[-1]) if shared[-1] else None
            held = rows[:, :0] if shared[-1] else rows[:, new[-1]:]

    order = ["content", "id", "start"]
    return (windows.select(*order).repartition("content").sortWithinPartitions(*order)
            .mapInArrow(run, "id long, start long, low long, low_start long"))


def passages(docs: DataFrame, s: Settings) -> DataFrame:
    """The passages that an earlier document has too, as long as they go: ``id,
    start, n_words`` and the first document's ``low, low_start``. Windows in a row
    are one passage where the first document's are in a row as well."""
    chosen = cut(_shared_windows(_window_table(docs, s)).select("id", "start"))
    later = _shared_windows(_near_table(docs, chosen, s)).where("id > low")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted; a passage that two batches share goes on
        kept = None
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            last = np.zeros((4, 0), np.int64) if kept is None else kept[[0, 1, 3, 4]] + np.array([[0], [1], [0], [1]]) * (kept[2] - s.window)
            rows = rows[:, (np.diff(np.hstack([last, rows])) != 0).any(axis=0)] if kept is not None else (
                rows[:, np.r_[True, (np.diff(rows) != 0).any(axis=0)][:rows.shape[1]]])     # rows that repeat an id
            if not rows.size:
                continue
            new = np.flatnonzero(np.r_[True, (np.diff(rows) != np.array([[0], [1], [0], [1]])).any(axis=0)])
            found = np.vstack([rows[:2, new], np.diff(np.r_[new, rows.shape[1]]) + s.window - 1, rows[2:, new]])
            if kept is not None:
                after = kept[:, 0] + np.array([0, 1, 0, 0, 1]) * (kept[2, 0] - s.window + 1)
                if (after[[0, 1, 3, 4]] == found[[0, 1, 3, 4], 0]).all():
                    found[:, 0] = [kept[0, 0], kept[1, 0], kept[2, 0] + found[2, 0] - s.window + 1, kept[3, 0], kept[4, 0]]
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], FIELDS)
            if found.shape[1] > 1:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found[:, :-1]], FIELDS)
            kept = found[:, -1:]
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], FIELDS)

    order = ["id", "start", "low", "low_start"]
    return (later.repartition("id").sortWithinPartitions("id", "low", F.col("low_start") - F.col("start"), "start").select(*order)
            .mapInArrow(spans, ", ".join(f"{x} long" for x in FIELDS)))


def _shingles(docs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """``content, grams`` (sorted distinct shingle hashes) and ``sketch`` of the
    paragraphs of ``reps`` (id, start, content), read again from their whole
    texts."""
    wanted = reps.groupBy("id").agg(F.collect_set("start").alias("starts"))
    texts = pack_texts(docs, "id", "text").join(wanted, "id")

    def block(ids: list, texts: list, starts: list) -> pa.RecordBatch:
        p = paragraphs(texts)
        asked = [set(x) for x in starts]
        which = np.array([k for k in np.flatnonzero(p.last - p.first >= s.shingle)
                          if int(p.start[k]) in asked[p.text[k]]], dtype=np.int64)
        content = _contents(p, p.first[which], p.last[which] - p.first[which])
        if not len(which):
            return None
        sets = shingle_sets(p, which, s)
        size = np.array([len(x) for x in sets])
        marks = sketches(np.concatenate(sets), np.cumsum(size) - size, s.sketch)
        return pa.RecordBatch.from_arrays(
            [pa.array(content.view(np.int64)), pa.array([x.view(np.int64).tolist() for x in sets], pa.list_(pa.int64())),
             pa.array(marks.tolist(), pa.list_(pa.int64()))], ["content", "grams", "sketch"])

    found = map_texts(texts, "id", "text", "content long, grams array<long>, sketch array<long>", block, BLOCK, extra=("starts",), packed=True)
    return found.dropDuplicates(["content"])


def _links(rest: DataFrame, centres: DataFrame, grams: DataFrame, s: Settings, tasks: int) -> DataFrame:
    """``a, b``: the rows of ``rest`` and ``centres`` (key, content, label) with one key
    and two labels whose shingle sets are similar enough. A pair is compared by its
    sketches and then exactly while the two sides are joined, so that only links
    become rows."""
    x = rest.select("key", "content", "label").join(grams, "content").coalesce(tasks)
    y = centres.select("content", F.col("key").alias("k"), F.col("label").alias("own")).join(grams, "content").select(
        "k", F.col("content").alias("centre"), "own", F.col("grams").alias("others"), F.col("sketch").alias("mark")).coalesce(tasks)
    differ = reduce(add, [F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("mark")[i])) for i in range(s.sketch // 64)])
    likely = (F.col("label") != F.col("own")) & (differ <= int((1 - s.similarity + s.margin) / 2 * s.sketch))
    shared = F.size(F.array_intersect("grams", "others"))
    similar = shared >= F.lit(s.similarity) * (F.size("grams") + F.size("others") - shared)
    return x.join(y, (F.col("key") == F.col("k")) & likely & similar).select(F.col("content").alias("a"), F.col("centre").alias("b")).coalesce(tasks)


def _banded(grams: DataFrame, s: Settings, rows: int) -> DataFrame:
    """``key, content, label`` by bands of ``rows`` values."""
    bands = s.bands_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.asarray(x, dtype=np.int64) for x in batch.column(1).to_pylist()]
            if sets:
                size = np.array([len(x) for x in sets])
                keys = band_keys(np.concatenate(sets).view(np.uint64), np.cumsum(size) - size, rows, bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)),
                                                  pa.array(np.repeat(batch.column(0).to_numpy(), bands)),
                                                  pa.array(np.repeat(batch.column(2).to_numpy(), bands))], ["key", "content", "label"])

    return grams.select("content", "grams", "label").mapInArrow(run, "key long, content long, label long")


def _shared_keys(keyed: DataFrame, tasks: int) -> DataFrame:
    """Rows (key, content, label) of the keys that more than one label has, with
    the number of the key's rows of the ``same`` label and of those (``few``) outside
    its commonest label."""
    own = keyed.groupBy("key", "label").agg(F.count("*").alias("same")).coalesce(tasks)
    all_of = own.groupBy("key").agg((F.sum("same") - F.max("same")).alias("few")).where("few > 0")
    return (keyed.join(own.join(all_of, "key").coalesce(tasks), ["key", "label"])
            .select("key", "content", "label", "same", "few").coalesce(tasks))


def paragraph_components(docs: DataFrame, contents: DataFrame, s: Settings) -> DataFrame:
    """``node, component`` of the distinct paragraph contents that a verified link
    joins to another one.

    A bucket is done when all members outside its commonest label (component so
    far) have been centres: then all pairs of two labels were compared. Where a few
    are outside, they are the next round's centres; other buckets are banded again."""
    rest = cut(_shared_keys(contents.select(F.explode("bands").alias("key"), "content", F.col("content").alias("label")),
                            tasks_for(s.bands * contents.count())))
    reps = rest.select("content").distinct().join(contents.select("content", "rep.id", "rep.start"), "content")
    grams = cut(_shingles(docs, reps, s))
    grams = grams.coalesce(tasks_for(grams.count()))
    comps, rows, most = docs.sparkSession.createDataFrame([], "node long, component long"), s.rows, s.centres
    while n := rest.count():
        tasks = tasks_for(n)
        rest = rest.coalesce(tasks)
        # the limit on the rank is applied in each map task before the shuffle
        rank = F.row_number().over(Window.partitionBy("key").orderBy("same", "label", "content"))
        centres = rest.withColumn("rank", rank).where(F.col("rank") <= most).coalesce(tasks)
        good = _links(rest, centres, grams, s, tasks)
        comps = cut(connected_components(good.unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b"))
        undone = (rest.where(F.col("few") > most).select("key", "content").join(comps.withColumnRenamed("node", "content"), "content", "left")
                  .select("key", "content", F.coalesce("component", "content").alias("label")).coalesce(tasks))
        most, longest = 4 * most, rows >= LONGEST
        undone = cut(_shared_keys(undone, tasks))
        if longest:                 # the same keys again: what is done stays done
            rest = undone
            continue
        rows = min(2 * rows, LONGEST)
        left = undone.where(F.col("few") > most).groupBy("content").agg(F.min("label").alias("label")).coalesce(tasks)
        tasks = tasks_for(n * s.bands_of(rows))
        fresh = _banded(grams.join(left, "content").coalesce(tasks), s, rows)
        rest = cut(_shared_keys(undone.where(F.col("few") <= most).select("key", "content", "label").unionByName(fresh).distinct().coalesce(tasks), tasks))
    return comps


def repeated(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The repeated passages: one row per occurrence with the id, ``start_word``
    and ``n_words`` (in words of the text), ``kind`` (paragraph or passage),
    ``component_id``, ``first_doc_id`` (the document whose occurrence stays) and
    ``removed``.

    Of a paragraph component the occurrence with the smallest id and start
    stays; of a passage that texts share, as long as it goes, the first one in
    the document with the smallest id. Null and empty texts have no passages; rows with a null
    id take no part; rows that repeat an id are one document; other columns are
    ignored; an empty table gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    paras = _paragraph_table(docs, s)
    at = F.struct("id", "start")
    contents = paras.groupBy("content").agg(F.min(at).alias("rep"), F.max(at).alias("end"), F.first("bands").alias("bands"))
    contents = contents.persist(StorageLevel.DISK_ONLY)
    comps = paragraph_components(docs, contents, s)
    # groups: contents that repeat or that are linked to another one
    named = (contents.join(comps, contents.content == comps.node, "left")
             .where(F.col("component").isNotNull() | (F.col("rep") < F.col("end")))
             .select("content", F.coalesce("component", "content").alias("component_id"), "rep"))
    first = named.groupBy("component_id").agg(F.min("rep").alias("first"))
    groups = cut(named.join(first, "component_id").select("content", "component_id", "first"))
    contents.unpersist()
    whole = (_place_table(docs).join(groups, "content")
             .select("id", "start", "n_words", F.lit("paragraph").alias("kind"), "component_id", F.col("first.id").alias("first_doc_id"),
                     (F.struct("id", "start") != F.col("first")).alias("removed")))
    long = cut(passages(docs, s))
    named = F.xxhash64("low", "low_start", "n_words")
    parts = (long.select("id", "start", "n_words", "low", named.alias("component_id"), F.lit(True).alias("removed"))
             .unionByName(long.select(F.col("low").alias("id"), F.col("low_start").alias("start"), "n_words", "low",
                                      named.alias("component_id"), F.lit(False).alias("removed")))
             .select("id", "start", "n_words", F.lit("passage").alias("kind"), "component_id", F.col("low").alias("first_doc_id"), "removed"))
    return (whole.unionByName(parts).distinct()
            .select(F.col("id").alias(id_col), F.col("start").alias("start_word"), "n_words", "kind", "component_id",
                    "first_doc_id", "removed"))


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans (start, count); what stays is
    unchanged, and lines that become blank go."""
    p = np.frombuffer(text, dtype=np.uint8)
    solid = (p != 32) & ((p < 9) | (p > 13))
    edge = np.diff(np.r_[False, solid, False].astype(np.int8))
    at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    gone = np.zeros(len(p), bool)
    for start, n in spans:
        if n > 0 and start < len(at):
            gone[at[start]:end[min(start + n, len(at)) - 1]] = True
    left = p[~gone].tobytes()
    return b"\n".join(x for x in left.split(b"\n") if x.strip()) if gone.any() else text


def without_repeats(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with the removed passages cut from the whole
    texts (null ids and null texts stay as they are)."""
    spans = (repeated(docs, s, id_col, text_col).where("removed")
             .groupBy(F.col(id_col).alias("__id"))
             .agg(F.collect_set(F.struct(F.col("start_word").alias("s"), F.col("n_words").alias("n"))).alias("__spans")))

    @F.pandas_udf("string")
    def cut_out(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or x is None else cut_words(t.encode(), list(zip(x, n))).decode()
                          for t, x, n in zip(texts, starts, sizes)], dtype=object)

    names = docs.columns                                # joined under plain numbers: any column name may be there
    rows = docs.toDF(*[f"c{k}" for k in range(len(names))])
    own, body = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    joined = rows.join(spans, F.col(own).cast("long") == F.col("__id"), "left")
    marks = F.col("__spans")
    new = F.when(marks.isNull(), F.col(body)).otherwise(cut_out(F.col(body), marks["s"], marks["n"]))
    return joined.withColumn(body, new).select(*rows.columns).toDF(*names)
