"""Prefix trie over conversations, built as a burst trie.

A conversation is a sequence of turns; a turn's id is the 128-bit digest of its
role and text (32 hex digits), so a sequence is one string and a prefix of turns a
prefix of it. Every distinct sequence of first turns is a node.

* Equal sequences are one row with their number, smallest id and the digest of
  their ids before anything is built, so copies never travel as a group.
* Suffix containers hang under trie heads. A container of more than ``container``
  turns (and of more than one sequence) bursts by the next turn id: its head
  becomes a node of its own, the suffixes go to one container per next turn. A
  round bursts ``stride`` levels at once (the counts of the prefixes that deep, added
  up before the shuffle) and the next round twice as many, so rounds grow with the
  logarithm of the depth that many sequences share.
* Each container that is left is sorted and swept into its nodes in one task, with
  a stack for the path to the last sequence.
* Heads get their totals from the containers under them (a row per container and
  head above it, added up before the shuffle).

What one task holds is bounded by ``container`` turns or one sequence. A
conversation is a row of 40 bytes a turn, as a document is a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import cut
from demandgrid.llm.sql_crc import TABLE, crc32

WIDTH = 32                      # hex digits of a turn id
NOTHING = hashlib.sha256(b"").hexdigest()
CHUNK_IDS = 4096                # ids of one chunk of a digest's input
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


@dataclass(frozen=True)
class Settings:
    container: int = 1 << 16    # turns that a container holds before it bursts
    stride: int = 4             # levels burst in the first round; each further round doubles it


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``id, turns``: each conversation's turns (id and UTF-8 bytes of the text) in
    the order of ``turn_col``, null first; equal turn numbers in the order of their
    ids. A null role or text is empty; rows without a conversation belong to none."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(F.col(conv_col).cast("long").alias("id"), F.struct(
        F.col(turn_col).cast("long").alias("at"), name.alias("turn"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.where("id IS NOT NULL").groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "id", F.transform("t", lambda x: F.struct(x["turn"].alias("turn"), x["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(seqs: DataFrame, family: int = 5, lent: int = 9) -> DataFrame:
    """Conversations that share beginnings: conversation c takes its first h turns
    from conversation c - c % ``family`` (fewer if that has fewer, none if it is
    absent) and the rest after its own first h; h = crc32(c as text) % ``lent``."""
    lender = seqs.select(F.col("id").alias("lender"), F.col("turns").alias("lent"))
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % lent).cast("int")
    none = F.array().cast(seqs.schema["turns"].dataType)
    joined = seqs.withColumn("lender", F.col("id") - F.col("id") % family).join(lender, "lender", "left")
    rest = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.size("turns"))).otherwise(none)
    return joined.select("id", F.concat(F.slice(F.coalesce("lent", none), F.lit(1), h), rest).alias("turns"))


def id_digests(members: DataFrame) -> DataFrame:
    """``key, n, low, sha``: SHA-256 of each key's ids in decimal, ascending, joined
    by commas. Ids are sorted in ranges, so a key of many ids is spread over tasks;
    only ready-made pieces of the text meet in the task that digests them."""
    spark = members.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            at = 0
            while at < len(ids):
                end = at + 1
                while end < len(ids) and keys[end] == keys[at] and end - at < CHUNK_IDS:
                    end += 1
                out.append((keys[at], ids[at], end - at, ",".join(map(str, ids[at:end]))))
                at = end
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "low", "n", "part"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = low = digest = None
        count = 0
        done: list[tuple] = []
        for batch in batches:
            for k, first, many, part in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if key is not None:
                        done.append((key, count, low, digest.hexdigest()))
                    key, low, count, digest = k, first, 0, hashlib.sha256()
                elif count:
                    digest.update(b",")
                digest.update(part.encode())
                count += many
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "n", "low", "sha"])
                done = []
        if key is not None:
            done.append((key, count, low, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "n", "low", "sha"])

    spread = members.select("key", "id").repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")
    return (spread.mapInArrow(pieces, "key string, low long, n long, part string")
            .repartition(n, "key").sortWithinPartitions("key", "low")
            .mapInArrow(digests, "key string, n long, low long, sha string"))


def _prefix(depth: Column | str) -> Column:
    return F.substring(F.col("seq"), F.lit(1), WIDTH * (F.col(depth) if isinstance(depth, str) else depth))


def burst(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame | None]:
    """Each sequence with ``held``, the number of heads above its container (its
    depth + 1: it ends at a head), and the heads ``depth, key, prefix, bytes``."""
    live = rows.withColumn("held", F.lit(0))
    settled, heads, stride = None, None, s.stride
    while True:
        levels = live.withColumn("d", F.explode(F.sequence("held", F.least(F.col("held") + (stride - 1), F.col("depth")))))
        counts = levels.groupBy(F.col("d").alias("depth"), F.md5(_prefix("d").cast("binary")).alias("key")).agg(
            F.count("*").alias("n"), F.sum(F.col("depth") - F.col("d") + 1).alias("turns"),
            F.max(F.get("bytes", F.col("d") - 1)).alias("bytes"), F.first(_prefix("d")).alias("prefix"))
        over = cut(counts.where((F.col("n") > 1) & (F.col("turns") > s.container)).drop("n", "turns"))
        heads = over if heads is None else heads.unionByName(over)
        named = levels.select("key", "d", F.md5(_prefix("d").cast("binary")).alias("at"))
        deep = named.join(over.select(F.col("depth").alias("d"), F.col("key").alias("at")), ["d", "at"], "left_semi").groupBy("key").agg(
            F.count("*").cast("int").alias("more"))
        live = live.join(deep, "key", "left").withColumn("held", F.col("held") + F.coalesce("more", F.lit(0)))
        live = cut(live.withColumn("open", (F.coalesce("more", F.lit(0)) == stride) & (F.col("held") <= F.col("depth"))).drop("more"))
        closed = live.where(~F.col("open")).drop("open")
        settled = closed if settled is None else settled.unionByName(closed)
        live = live.where("open").drop("open")
        if live.isEmpty():
            return settled, heads
        stride *= 2


class _Sweep:
    """Nodes of one container from its sequences in order."""

    def __init__(self, held: int):
        self.held, self.path, self.last, self.out = held, [], "", []

    def close(self) -> None:
        depth, n, low, children, leaves, saved, sha, size, below = self.path.pop()
        saved += (n - 1) * size
        leaves = leaves if children else 1
        for child in below:
            child[2] = low
        node = [low, depth, None, n, children, leaves, saved, sha]
        self.out.append(node)
        if self.path:
            up = self.path[-1]
            up[1] += n
            up[2] = low if up[2] is None or low < up[2] else up[2]
            up[3] += 1
            up[4] += leaves
            up[5] += saved
            up[8].append(node)

    def add(self, seq: str, sizes: list[int], n: int, low: int, sha: str) -> None:
        depth, shared = len(sizes), self.held
        if self.path:
            most = min(depth, len(self.last) // WIDTH)
            while shared < most and self.last[shared * WIDTH:(shared + 1) * WIDTH] == seq[shared * WIDTH:(shared + 1) * WIDTH]:
                shared += 1
            while self.path[-1][0] > shared:
                self.close()
            shared += 1
        for d in range(shared, depth + 1):
            self.path.append([d, 0, None, 0, 0, 0, NOTHING, sizes[d - 1] if d else 0, []])
        end = self.path[-1]
        end[1] += n
        end[2] = low if end[2] is None or low < end[2] else end[2]
        end[6] = sha
        self.last = seq

    def finish(self) -> list[list]:
        while self.path:
            self.close()
        return self.out


def sweep(containers: DataFrame) -> DataFrame:
    """Nodes of all containers (``box, held, seq, bytes, n, low, sha``): the columns
    of a node, and for the top one of a container its ``prefix``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                            ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                            ("ends_sha256", pa.string()), ("prefix", pa.string())])
        ready: list[list] = []
        box, now = None, None

        def end() -> None:
            nodes = now.finish()
            top = now.last[:now.held * WIDTH]
            ready.extend([*node, top if k == len(nodes) - 1 else None] for k, node in enumerate(nodes))

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for name, held, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if name != box:
                    if now is not None:
                        end()
                    box, now = name, _Sweep(held)
                now.add(*row)
                if len(ready) > 20_000:
                    yield batch_of(ready)
                    ready.clear()
        if now is not None:
            end()
        if ready:
            yield batch_of(ready)

    rows = containers.select("box", "held", "seq", "bytes", "n", "low", "sha").repartition("box").sortWithinPartitions("box", "seq")
    return rows.mapInArrow(run, NODE + ", prefix string")


def trie(seqs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per node of the conversations ``id, turns``: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes in its subtree), ``saved_tokens``
    (over its subtree, (members - 1) times the bytes of a node's last text) and
    ``ends_sha256`` (of the ids of members that end here; of the empty text if none).

    A conversation without turns is a member of the root alone; equal conversations
    share their nodes; no conversations give no rows, not even a root."""
    members = cut(seqs.select("id", F.array_join("turns.turn", "").alias("seq"), F.col("turns.bytes").alias("bytes"))
                  .withColumn("key", F.md5(F.col("seq").cast("binary"))))
    kinds = members.groupBy("key").agg(F.first("seq").alias("seq"), F.first("bytes").alias("bytes"))
    rows = cut(kinds.join(id_digests(members), "key").withColumn("depth", F.size("bytes")))
    settled, heads = burst(rows, s)
    inside = settled.where("held <= depth").withColumn("box", F.md5(_prefix("held").cast("binary")))
    nodes = cut(sweep(inside))
    ends = settled.where("held > depth")

    # totals of the heads: from containers and from sequences that end at or below them
    tops = nodes.where("prefix IS NOT NULL AND depth > 0")
    given = (tops.select(F.col("prefix").alias("seq"), F.col("n_convs").alias("n"), F.col("conv_id").alias("low"), F.col("n_leaves").alias("leaves"),
                         F.col("saved_tokens").alias("saved"), (F.col("depth") - 1).cast("int").alias("last"), F.lit(1).alias("child"))
             .unionByName(ends.select("seq", "n", "low", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"),
                                      F.col("depth").alias("last"), F.lit(0).alias("child"))))
    above = given.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("last"))))
    totals = above.groupBy(F.md5(_prefix("d").cast("binary")).alias("key")).agg(
        F.sum("n").alias("n_convs"), F.min("low").alias("conv_id"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.sum(F.when(F.col("d") == F.col("last"), F.col("child")).otherwise(0)).alias("boxes"))
    head = cut(heads.join(totals, "key").withColumn("own", F.coalesce((F.col("n_convs") - 1) * F.col("bytes"), F.lit(0))))
    up = F.md5(F.substring(F.col("prefix"), F.lit(1), WIDTH * (F.col("depth") - 1)).cast("binary"))
    own = (head.select(F.col("prefix").alias("seq"), "own", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("d"))
           .groupBy(F.md5(_prefix("d").cast("binary")).alias("key")).agg(F.sum("own").alias("own_below")))
    below = head.where("depth > 0").groupBy(up.alias("key")).agg(F.count("*").alias("heads_below"))
    parent = head.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    done = (head.withColumn("up", F.when(F.col("depth") > 0, up)).join(own, "key").join(below, "key", "left")
            .join(parent, "up", "left").join(ends.select("key", "sha"), "key", "left"))
    done = done.select("conv_id", F.col("depth").cast("long").alias("depth"), F.col("up_conv").alias("parent_conv_id"), "n_convs",
                       (F.col("boxes") + F.coalesce("heads_below", F.lit(0))).cast("long").alias("n_children"), "n_leaves",
                       (F.col("saved") + F.col("own_below")).alias("saved_tokens"), F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"))
    linked = nodes.where("prefix IS NOT NULL").withColumn("up", F.when(F.col("depth") > 0, up)).join(parent, "up", "left").withColumn(
        "parent_conv_id", F.col("up_conv"))
    return nodes.where("prefix IS NULL").select(*done.columns).unionByName(linked.select(*done.columns)).unionByName(done)


def oracle_sql(family: int = 5, lent: int = 9) -> str:
    """DuckDB SQL of the registered query: every prefix of every conversation as a
    row, subtrees by unnesting each node's prefixes."""
    return f"""WITH crc AS MATERIALIZED ({TABLE}),
told AS (SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
    strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t) AS t, list(b ORDER BY turn NULLS FIRST, t) AS b FROM told GROUP BY conv_id),
h AS MATERIALIZED (SELECT conv_id, {crc32("conv_id::VARCHAR")} % {lent} AS h FROM own, crc),
built AS MATERIALIZED (SELECT o.conv_id, list_concat(coalesce(l.t[1:h], []), o.t[h + 1:]) AS t, list_concat(coalesce(l.b[1:h], []), o.b[h + 1:]) AS b
    FROM own o JOIN h USING (conv_id) LEFT JOIN own l ON l.conv_id = o.conv_id - o.conv_id % {family}),
reached AS MATERIALIZED (SELECT conv_id, len(t) AS size, d, array_to_string(t[1:d], '') AS k, array_to_string(t[1:d - 1], '') AS up, coalesce(b[d], 0) AS b
    FROM (SELECT *, unnest(range(len(t) + 1)) AS d FROM built)),
node AS MATERIALIZED (SELECT d, k, any_value(up) AS up, any_value(b) AS b, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256 FROM reached GROUP BY d, k),
kids AS (SELECT up AS k, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_node AS MATERIALIZED (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (d, k)),
under AS (SELECT a AS d, k[1:{WIDTH} * a] AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * b) AS saved
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_node) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, under.n_leaves, under.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node n JOIN under USING (d, k) LEFT JOIN full_node p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.up"""
