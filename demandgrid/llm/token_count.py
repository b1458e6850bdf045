"""Token counts by a compiled finite-state transducer.

Splitting into words is an automaton whose chunk state maps compose through a
parallel prefix scan (``pretokenize``). Within a word, byte-level merges are
finite-state too: the encoding of a prefix ends in exactly one token, namely the
one suffix token that forms a canonical pair with the last token of what stands
before it. So a state need only hold the longest suffix that some token goes on
from and, for each place in it, the last token and the count there; reading a
byte moves to the next state and emits the change of the token count. States
and transitions are found as texts need them and kept as arrays: all distinct
words of a block run through the transducer together, and a transition that is
not there yet is worked out once a process and added. Beyond a bound of states a process
starts compiling anew, which changes its speed only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.bytebpe import ByteBPE
from demandgrid.llm.common import map_texts
from demandgrid.llm.pretokenize import distinct_words, words

# A state: the open suffix, and from its start to here the last token (-1: the
# word begins there) and the count relative to here, at each place.
State = tuple[bytes, tuple[tuple[int, int], ...]]
SPREAD = 4096


@dataclass
class Transducer:
    """``arcs`` maps state * 256 + byte to next state * SPREAD + emitted count
    (the count offset by half of SPREAD, as a merge can lower it)."""
    bpe: ByteBPE
    most_states: int = 300_000          # beyond it the compiled states are dropped and found anew
    states: dict[State, int] = field(default_factory=dict)
    of: list[State] = field(default_factory=list)
    arcs: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.open = {t[:k] for t in self.bpe.ids for k in range(1, len(t))}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states, self.of, self.arcs = {}, [], {}
        self._state((b"", ((-1, 0),)))
        self._frozen()

    def _state(self, s: State) -> int:
        if s not in self.states:
            self.states[s] = len(self.of)
            self.of.append(s)
        return self.states[s]

    def canonical(self, a: int, b: int) -> bool:
        """Whether merging the two tokens' bytes gives these two tokens (a = -1:
        whether the second token's bytes give the token)."""
        known = self.pairs.get(a << 24 | b)
        if known is None:
            tokens = self.bpe.tokens
            known = self.bpe.merge(tokens[b]) == [b] if a < 0 else self.bpe.merge(tokens[a] + tokens[b]) == [a, b]
            self.pairs[a << 24 | b] = known
        return known

    def step(self, state: int, byte: int) -> int:
        suffix, places = self.of[state]
        read = suffix + bytes((byte,))
        for k in range(len(read)):                      # the longest suffix token first
            token = self.bpe.ids.get(read[k:])
            if token is not None and self.canonical(places[k][0], token):
                emitted = places[k][1] + 1
                break
        else:
            raise ValueError("a byte without a token")
        k = 0
        while k < len(read) and read[k:] not in self.open:
            k += 1
        nxt = tuple((t, n - emitted) for t, n in places[k:]) + ((token, 0),)
        return self._state((read[k:], nxt)) * SPREAD + emitted + SPREAD // 2

    def _frozen(self) -> None:
        keys = np.fromiter(self.arcs, np.int64, len(self.arcs))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(self.arcs.values(), np.int64, len(self.arcs))[order]

    def counts(self, found: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        if len(self.of) > self.most_states:
            self._reset()
        size = np.array([len(w) for w in found], np.int64)
        data = np.frombuffer(b"".join(found), np.uint8)
        begin = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")            # long words first: those that go on are a prefix
        state, total = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        begin, size = begin[order], size[order]
        alive, at, added = int((size > 0).sum()), 0, False
        while alive:
            key = state[:alive] * 256 + data[begin[:alive] + at]
            spot = np.searchsorted(self.keys, key)
            spot[spot == len(self.keys)] = 0
            hit = self.keys[spot] == key if len(self.keys) else np.zeros(alive, bool)
            arc = self.to[spot] if len(self.keys) else np.zeros(alive, np.int64)
            if not hit.all():
                missing, back = np.unique(key[~hit], return_inverse=True)
                new = np.empty(len(missing), np.int64)
                for i, k in enumerate(missing.tolist()):
                    if k not in self.arcs:
                        self.arcs[k] = self.step(k >> 8, k & 255)
                        added = True
                    new[i] = self.arcs[k]
                arc[~hit] = new[back]
            state[:alive] = arc // SPREAD
            total[:alive] += arc % SPREAD - SPREAD // 2
            at += 1
            alive = int(np.searchsorted(-size, -at, side="left"))
        if added:
            self._frozen()
        result = np.empty(len(found), np.int64)
        result[order] = total
        return result

    def text_counts(self, texts: list[bytes | None]) -> np.ndarray:
        """Tokens of whole texts, special strings counted as their one token."""
        segments, owner, total = [], [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            for part in self.bpe.split_special(t or b""):
                if part in self.bpe.special:
                    total[k] += 1
                elif part:
                    segments.append(part)
                    owner.append(k)
        if segments:
            block = words(segments)
            found, which = distinct_words(block)
            n = self.counts(found)[which]
            total += np.bincount(np.array(owner)[block.segment], weights=n, minlength=len(texts)).astype(np.int64)
        return total


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The task process's transducer (its file is read once a process)."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(ByteBPE.load(path))
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Whole texts; a null text counts as empty (0 bytes, 0 tokens); null ids and
    repeated rows each keep a row; other columns are ignored; an empty table
    gives no rows. ``path`` is a tokenizer file that executors can read."""
    def block(ids: list, texts: list) -> pa.RecordBatch:
        n = transducer(path).text_counts(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n)], ["id", "n_bytes", "n_tokens"])

    out = map_texts(docs, id_col, text_col, "id long, n_bytes long, n_tokens long", block)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
