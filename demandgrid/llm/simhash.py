"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance ``k`` or less share a point that lies within
half of ``k`` of both. Every distinct fingerprint therefore emits all points
of its half-radius ball (its variants), variants are brought together by a
shuffle, and fingerprints that meet in a variant are linked.

For the shuffle the variants of one fingerprint that agree in their leading
``bits`` travel as one row ``(leading bits, fingerprint)``; the receiving task
flips the remaining bits. With 64-bit fingerprints and half-radius 2 that is
137 rows in place of 2081 (bits = 16) and no variant is left out. All
fingerprints that meet in one variant are within ``k`` of each other by the
triangle inequality, so a star around one of them links the group without
emitting its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import LOWER, connected_components, cut, map_texts

SEED = 42
# Variants expanded at once in a task (bounds its memory to some 100 MB).
EXPAND = 2_000_000


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash of one text, as an unsigned integer."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    h64 = xxhash.xxh64_intdigest
    k = min(shingle, len(words))
    hashes = np.array([h64(joined[s:e - 1], SEED) for s, e in zip(starts, ends[k - 1:])], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``id, fp`` (the 64 bits as a signed long) per row of ``docs``."""
    def block(ids: list, texts: list) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps)], ["id", "fp"])

    return map_texts(docs, id_col, text_col, "id long, fp long", block)


def _flips(bits: range, most: int) -> np.ndarray:
    """XOR masks of all choices of at most ``most`` of the bit positions, by
    rising number of flips."""
    return np.array([sum(1 << i for i in c) for n in range(most + 1) for c in combinations(bits, n)], dtype=np.uint64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _leading(fps: DataFrame, bits: int, outer: int) -> DataFrame:
    masks = _flips(range(64 - bits, 64), outer)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 2048):
                part = fp[at:at + 2048]
                lead = ((part[:, None] ^ masks[None, :]) >> np.uint64(64 - bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead.ravel()), pa.array(np.repeat(part, len(masks)).view(np.int64))], ["lead", "fp"])

    return fps.mapInArrow(emit, "lead long, fp long")


def _meet(lead: np.ndarray, fp: np.ndarray, bits: int, inner: int, outer: int, tails: list[np.ndarray],
          ) -> tuple[np.ndarray, np.ndarray]:
    """Star links of all groups that meet in a variant, for whole leads."""
    low = np.uint64((1 << (64 - bits)) - 1)
    used = _popcount((fp >> np.uint64(64 - bits)) ^ lead)
    base = (lead << np.uint64(64 - bits)) | (fp & low)
    total = sum(int((used == j).sum()) * len(tails[outer - j]) for j in range(outer + 1))
    parts = 1 << max(0, ceil(log2(max(1, total / EXPAND))))
    found: list[np.ndarray] = []
    for part in range(parts):
        variants, owners, flips = [], [], []
        for j in range(outer + 1):
            own = used == j
            masks = tails[outer - j]
            if not own.any():
                continue
            for at in range(0, int(own.sum()), max(1, EXPAND // len(masks))):
                b = base[own][at:at + max(1, EXPAND // len(masks))]
                o = fp[own][at:at + max(1, EXPAND // len(masks))]
                v = b[:, None] ^ masks[None, :]
                n = np.broadcast_to(j + _popcount(masks)[None, :], v.shape)
                who = np.broadcast_to(o[:, None], v.shape)
                if parts > 1:
                    keep = ((v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(parts) == part
                    v, n, who = v[keep], n[keep], who[keep]
                variants.append(v.ravel())
                owners.append(who.ravel())
                flips.append(n.ravel())
        v = np.concatenate(variants) if variants else np.empty(0, np.uint64)
        ordered = np.sort(v)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        hit = np.isin(v, twice)
        v, who, n = v[hit], np.concatenate(owners)[hit], np.concatenate(flips)[hit]
        # in each variant the centre is the smallest fingerprint within the inner radius
        order = np.lexsort((who, n > inner, v))
        v, who, n = v[order], who[order], n[order]
        first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        size = np.diff(np.r_[first, len(v)])
        centre, ok = np.repeat(who[first], size), np.repeat(n[first] <= inner, size) & (who != np.repeat(who[first], size))
        links = np.stack([centre[ok], who[ok]], axis=1)
        links = links[_popcount(links[:, 0] ^ links[:, 1]) <= inner + outer]
        if len(links):
            found.append(np.unique(links, axis=0))
    links = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)
    return links[:, 0], links[:, 1]


def _collide(rows: DataFrame, bits: int, inner: int, outer: int) -> DataFrame:
    """Links ``a, b`` of fingerprints from rows sorted by leading bits."""
    tails = [_flips(range(64 - bits), m) for m in range(outer + 1)]
    weight = np.array([len(tails[outer - j]) for j in range(outer + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(lead: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = _meet(lead, fp, bits, inner, outer, tails)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        cost = 0
        for batch in batches:
            lead = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            held.append((lead, fp))
            cost += int(weight[np.minimum(_popcount((fp >> np.uint64(64 - bits)) ^ lead), outer)].sum())
            if cost >= EXPAND:
                lead, fp = (np.concatenate(x) for x in zip(*held))
                whole = int(np.searchsorted(lead, lead[-1]))     # the last lead may go on in the next batch
                if whole:
                    yield from out(lead[:whole], fp[:whole])
                held, cost = [(lead[whole:], fp[whole:])], 0
        if held:
            yield from out(*(np.concatenate(x) for x in zip(*held)))

    return rows.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_distance: int = 4, bits: int | None = None) -> DataFrame:
    """Links ``a, b`` between distinct values of ``fps.fp`` such that the links'
    components are those of all pairs at ``max_distance`` or fewer differing
    bits. ``bits`` (leading bits that key the shuffle) follows the number of
    fingerprints, so that a key's share stays small at any size; it changes
    how rows are dealt, never which links are found."""
    distinct = fps.select("fp").distinct()
    if bits is None:
        n = max(1, distinct.count())
        bits = min(40, max(8, ceil(log2(n)) - 2))
    inner = max_distance // 2
    outer = max_distance - inner
    rows = _leading(distinct, bits, outer).repartition("lead").sortWithinPartitions("lead")
    return _collide(rows, bits, inner, outer).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_distance: int = 4) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and
    ``component_id`` (the smallest id reachable by links).

    Words are runs of non-space bytes after lower-casing A-Z; a text with
    fewer words than ``shingle`` is one shingle; a null, empty or blank text
    has fingerprint zero and links like any other. Repeated rows keep their
    own result row. A row with a null id gets the component of its
    fingerprint (null if no row of the component has an id). Extra columns of
    ``docs`` are ignored, an empty table gives no rows."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    reps = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    comps = connected_components(links(fps, max_distance), "a", "b")
    # the component's id is the smallest document id of its fingerprints
    named = (reps.join(comps, reps.fp == comps.node, "left")
             .select("fp", "rep", F.coalesce("component", "fp").alias("comp")))
    named = cut(named)
    ids = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of = named.join(ids, "comp").select("fp", "component_id")
    return (fps.join(of, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))
