"""Document fingerprints from a randomised edit embedding.

A walk crosses a text step by step. At every step it writes down where it stands
and then stays or moves on to the next character, as a random bit shared by all
texts says for this step and character. Walks over two texts differ only near an
edit and meet again soon, so a small edit distance becomes a small Hamming distance
between what they write (steps that one walk doesn't reach count as different).

A fingerprint samples ``samples`` steps of the walk, the same for all texts: a
sample's step is the last of a fixed random list that the walk reaches, and the
list is such that this step is uniform over the walk whatever its length. What the
walk sees there (``width`` characters from where it stands) is kept as ``bits``
bits, one hexadecimal digit a sample. The share of equal digits, freed of those
equal by chance, estimates the share of the longer walk on which both agree.

Near duplicates: bands of sampled digits are the keys of a shuffle; distinct
fingerprints that share a band are verified with all their digits, in blocks, and
a task emits a spanning forest of its links, never pairs.

The walk needs one number a text: a character met at step j lasts until the next
step whose bit for the character's class is set, which a table gives at once. So a
block's texts advance side by side, a character per round, longest first; the few
longest are finished one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import connected_components, cut, map_texts
from demandgrid.llm.subwords import place_keys

CLASSES = 64                    # of characters with shared random bits
PERIOD = 1 << 16                # steps after which the bits begin anew
FEW = 32                        # texts that are no longer worth a round side by side
RECORDS = 128                   # entries of a sample's list of steps
BLOCK_CHARS = 3 << 20
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
CHANCE = 1 / 16                 # equal digits of unlike texts


@dataclass(frozen=True)
class Settings:
    samples: int = 256
    width: int = 4              # characters seen at a sampled step
    seed: int = 11
    bands: int = 16
    band_digits: int = 7
    threshold: float = 0.8      # likeness of near duplicates
    block: int = 2048           # fingerprints compared with each other in one task


@cache
def lasting() -> np.ndarray:
    """How many steps a character of class c lasts that the walk meets at step j,
    at [j * CLASSES + c]."""
    moves = (place_keys(PERIOD)[:, None] >> np.arange(CLASSES, dtype=np.uint64)) & np.uint64(1)
    at = np.arange(2 * PERIOD)[:, None]
    until = np.where(np.concatenate([moves, moves]) == 1, at, 4 * PERIOD)
    until = np.minimum.accumulate(until[::-1])[::-1][:PERIOD]
    return (until - at[:PERIOD] + 1).astype(np.int64).ravel()


@cache
def sample_steps(samples: int, seed: int) -> np.ndarray:
    """Steps of each sample (a row each, from 1, rising). After a step n the next
    one is beyond m with probability n / m, so the last one up to any length is
    uniform over the steps so far."""
    rng = np.random.default_rng(seed)
    out = np.ones((samples, RECORDS))
    for k in range(1, RECORDS):
        out[:, k] = np.minimum(np.floor(out[:, k - 1] / rng.random(samples)) + 1, 2.0 ** 60)
    return out.astype(np.int64)


def walks(points: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text (code points): the step at which the walk meets each
    character, and the number of its steps."""
    size = np.array([len(p) for p in points], np.int64)
    order = np.argsort(-size, kind="stable")
    joined = np.concatenate([points[i] for i in order]) if len(points) else np.zeros(0, np.uint32)
    kind = ((joined * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.int64)
    longest = int(size.max(initial=0))
    # round t: the texts longer than t, which are the first ones
    active = len(points) - np.searchsorted(np.sort(size), np.arange(longest), side="right")
    offset = np.cumsum(active) - active
    ranked = size[order]
    begin = np.cumsum(ranked) - ranked
    place = np.arange(len(joined)) - np.repeat(begin, ranked)
    spot = offset[place] + np.repeat(np.arange(len(points)), ranked)
    classes = np.empty(len(joined), np.int64)
    classes[spot] = kind
    met = np.empty(len(joined), np.int64)
    table, step = lasting(), np.zeros(len(points), np.int64)
    t = 0
    while t < longest and active[t] >= FEW:
        a, o = int(active[t]), int(offset[t])
        now = step[:a]
        met[o:o + a] = now
        step[:a] = now + table[((now & (PERIOD - 1)) << 6) | classes[o:o + a]]
        t += 1
    rest = {}
    if t < longest:
        quick = table.astype(np.uint8).tobytes()
        for r in range(int(active[t])):
            s = int(step[r])
            steps = []
            for c in kind[begin[r] + t:begin[r] + ranked[r]].tolist():
                steps.append(s)
                s += quick[((s & (PERIOD - 1)) << 6) | c]
            step[r] = s
            rest[r] = np.array(steps, np.int64)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(points)
    total = np.zeros(len(points), np.int64)
    for r, i in enumerate(order.tolist()):
        n = min(int(ranked[r]), t)
        here = met[offset[:n] + r]
        found[i] = np.r_[here, rest[r]] if r in rest else here
        total[i] = step[r]
    return found, total


def digits(texts: Sequence[str], s: Settings) -> np.ndarray:
    """Digits (0 to 15) of each text's fingerprint, a row each; an empty text has
    none but zeros."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    met, total = walks(points)
    steps = sample_steps(s.samples, s.seed)
    out = np.zeros((len(texts), s.samples), np.uint8)
    chosen = np.stack([row[np.searchsorted(row, np.maximum(total, 1), side="right") - 1] for row in steps], axis=1) if len(texts) else None
    salt, keys = place_keys(s.samples) | np.uint64(1), place_keys(s.width + 8)[8:]
    for i, (p, m) in enumerate(zip(points, met)):
        if not len(p):
            continue
        at = np.searchsorted(m, chosen[i] - 1, side="right") - 1
        seen = np.zeros(s.samples, np.uint64)
        for o in range(s.width):
            inside = at + o < len(p)
            seen += np.where(inside, p[np.minimum(at + o, len(p) - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0)) * keys[o]
        seen = (seen ^ (seen >> np.uint64(32))) * salt
        out[i] = ((seen ^ (seen >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(60)
    return out


def as_text(row: np.ndarray) -> str:
    return DIGITS[row].tobytes().decode()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of the longer walk on which two agree (0 to 1), for rows of
    digits: the share of equal digits beyond chance."""
    equal = (a == b).mean(axis=-1)
    return np.round(np.maximum(equal - CHANCE, 0.0) / (1 - CHANCE), 6)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """``id, n_chars, fingerprint`` of every row (a null text is empty); no shuffle."""
    def run(ids: list, texts: list[bytes | None]) -> pa.RecordBatch:
        known = [(t or b"").decode("utf-8", "replace") for t in texts]
        return pa.record_batch({"id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in known], pa.int64()),
                                "fingerprint": pa.array([as_text(d) for d in digits(known, s)], pa.string())})

    return map_texts(docs, id_col, text_col, "id long, n_chars long, fingerprint string", run)


SUCCESSOR = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
             "near_next double")


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the first as many of another text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compared(ids: list, texts: list[str], following: list[str], own: np.ndarray, other: np.ndarray, s: Settings) -> list:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    after = digits(changed, s)
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
            pa.array([as_text(d) for d in own], pa.string()), pa.array([as_text(d) for d in after], pa.string()),
            pa.array(likeness(own, after)), pa.array(likeness(own, other))]


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """Each document's fingerprint beside that of its :func:`edited` text (changed
    with the next document's beginning) and its likeness to both. The next document
    is the one of the next smaller id (null ids last; rows that repeat an id in the
    order of their texts' hash), after the last the first; a document alone is its own next.

    Texts are range-sorted by id (compressed one by one, as they are most of what
    is shuffled), so a hot id or a long run of ids spreads over tasks, and each task
    reads its rows as a stream. The last document of a range
    finds its next in the first of the following one: two rows a range are kept
    with their texts and joined at the end."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").desc_nulls_last(), F.col("hash").asc(), F.col("row").asc()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([press(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, *batch.columns[2:]], ["id", "text", "hash", "row"])

    rows = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(pack, "id long, text binary, hash long, row long")
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")
    fields = ["kind", "part", *[c.split()[0] for c in SUCCESSOR.split(", ")], "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def edge(kind: str, row: tuple, found: np.ndarray) -> pa.RecordBatch:
            none = pa.array([None], pa.string())
            return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part], pa.int64()), pa.array([row[0]], pa.int64()),
                                               pa.array([len(row[1])], pa.int64()), none, pa.array([as_text(found)]), none,
                                               pa.array([None], pa.float64()), pa.array([None], pa.float64()), pa.array([row[1]])], fields)

        def block(held: list[tuple], first: bool, last: bool) -> Iterator[pa.RecordBatch]:
            texts = [t for _, t in held]
            own = digits(texts, s)
            if first:
                yield edge("head", held[0], own[0])
            m = len(held) - 1
            if m:
                out = _compared([i for i, _ in held[:m]], texts[:m], texts[1:], own[:m], own[1:], s)
                yield pa.RecordBatch.from_arrays([pa.array(["row"] * m), pa.array([part] * m, pa.int64()), *out, pa.nulls(m, pa.string())], fields)
            if last:
                yield edge("tail", held[-1], own[-1])

        held: list[tuple] = []
        size, first, unpack = 0, True, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for ident, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((ident, unpack(packed.as_py()).decode("utf-8", "replace")))
                size += len(held[-1][1])
                if size > BLOCK_CHARS and len(held) > 1:
                    yield from block(held, first, False)
                    held, first = held[-1:], False
                    size = len(held[0][1])
        if held:
            yield from block(held, first, True)

    kept = cut(dealt.mapInArrow(run, "kind string, part long, " + SUCCESSOR + ", text string"))
    heads = kept.where("kind = 'head'")
    used = sorted(r["part"] for r in heads.select("part").collect())              # a number per range
    turn = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "part long, then long")
    pairs = (kept.where("kind = 'tail'").select("part", "id", "text").join(F.broadcast(turn), "part")
             .join(heads.select(F.col("part").alias("then"), F.col("text").alias("following")), "then").select("id", "text", "following"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                own = digits([text, following], s)
                yield pa.RecordBatch.from_arrays(_compared([i], [text], [following], own[:1], own[1:], s), fields[2:-1])

    return kept.where("kind = 'row'").select(*fields[2:-1]).unionByName(pairs.mapInArrow(finish, SUCCESSOR))


def near_links(known: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (``id, fingerprint``, ids
    unique) that share a band and reach the threshold, as spanning forests."""
    step = s.samples // s.bands
    keys = F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("fingerprint", b * step + 1, s.band_digits)) for b in range(s.bands)]))
    banded = known.select("id", keys.alias("k"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of the bands that have two or more, whether the band is large."""
        key, held, large = None, [], False
        for batch in batches:
            out: list[tuple] = []
            for i, k in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if len(held) > 1 or large:
                        out.extend((key, j, large) for j in held)
                    key, held, large = k, [], False
                held.append(i)
                if len(held) > s.block:
                    large = True
                if large:
                    out.extend((key, j, True) for j in held)
                    held = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_()))], ["k", "id", "large"])
        if len(held) > 1 or large and held:
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(held), pa.int64()), pa.array(held, pa.int64()), pa.array([large] * len(held))], ["k", "id", "large"])

    met = cut(banded.repartition("k").sortWithinPartitions("k").mapInArrow(shared, "k long, id long, large boolean"))
    small = met.where("NOT large").select("k", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "id")
    sizes = met.where("large").groupBy("k").agg(F.ceil(F.count("*") / s.block).cast("int").alias("blocks"))
    big = (met.where("large").join(sizes, "k").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("side"), "id"))
    rows = small.unionByName(big).join(known, "id").select("k", "i", "j", "side", "id", "fingerprint")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(key: tuple, members: list[tuple]) -> list[tuple]:
            members.sort()
            ids = [m[1] for m in members]
            rows = np.frombuffer("".join(m[2] for m in members).encode(), np.uint8).reshape(len(members), -1)
            sides = np.array([m[0] for m in members])
            root = np.arange(len(ids))
            links = []
            for a in range(len(ids)):
                near = np.flatnonzero(likeness(rows[a + 1:], rows[a]) >= s.threshold) + a + 1
                if key[1] != key[2]:
                    near = near[sides[near] != sides[a]]
                for b in near.tolist():
                    if root[a] != root[b]:
                        links.append((ids[a], ids[b]))
                        root[root == root[b]] = root[a]
            return links

        def batch_of(links: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["u", "v"])

        key, members = None, []
        for batch in batches:
            for k, i, j, side, ident, fp in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, i, j) != key:
                    if len(members) > 1 and (links := forest(key, members)):
                        yield batch_of(links)
                    key, members = (k, i, j), []
                members.append((side, ident, fp))
        if len(members) > 1 and (links := forest(key, members)):
            yield batch_of(links)

    return rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInArrow(verify, "u long, v long")


def near_duplicates(found: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``found`` (``id, fingerprint``, any more) with ``component_id``, the smallest
    id reachable by equal fingerprints or verified links (null ids have none)."""
    kinds = cut(found.where("id IS NOT NULL").groupBy("fingerprint").agg(F.min("id").alias("id")))
    groups = connected_components(near_links(kinds, s), "u", "v")
    lowest = kinds.join(groups, kinds["id"] == groups["node"], "left").select(
        "fingerprint", F.coalesce("component", "id").alias("component_id"))
    return found.join(lowest, "fingerprint", "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
