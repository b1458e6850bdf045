"""A byte-level merge vocabulary read from a tokenizer file, with the exact
merge of a single word. Files are a parameter and are only read."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable
    Latin-1 characters stand for themselves, other bytes for code points from
    256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class ByteBPE:
    ids: dict[bytes, int]                       # of ordinary tokens
    ranks: dict[tuple[int, int], tuple[int, int]]   # pair of ids -> (rank, merged id)
    tokens: list[bytes]                         # by id, special ones included
    special: dict[bytes, int]

    @staticmethod
    def load(path: str) -> ByteBPE:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()
               if all(c in letters for c in t)}
        ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (bytes(letters[c] for c in t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            ranks[ids[a], ids[b]] = (rank, ids[a + b])
        special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        for s in special:
            ids.pop(s, None)
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for t, i in [*ids.items(), *special.items()]:
            tokens[i] = t
        return ByteBPE(ids, ranks, tokens, special)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank merges first, the leftmost of
        equals, until no pair is left (a heap over a linked list: long words
        take n log n steps)."""
        parts = [self.ids[word[k:k + 1]] for k in range(len(word))]
        ranks = self.ranks
        if len(parts) < 40:
            while len(parts) > 1:
                best = min(((ranks[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
                if best is None:
                    break
                k = best[1]
                parts[k:k + 2] = [ranks[parts[k], parts[k + 1]][1]]
            return parts
        from heapq import heapify, heappop, heappush
        n = len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(ranks[p][0], k, p) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapify(heap)
        while heap:
            _, k, pair = heappop(heap)
            r = right[k]
            if r < 0 or (parts[k], parts[r]) != pair:
                continue
            parts[k], parts[r] = ranks[pair][1], -1
            right[k] = right[r]
            if right[k] >= 0:
                left[right[k]] = k
            right[r] = -1
            for a in (left[k], k):
                b = right[a] if a >= 0 else -1
                if a >= 0 and b >= 0 and (q := (parts[a], parts[b])) in ranks:
                    heappush(heap, (ranks[q][0], a, q))
        return [p for p in parts if p >= 0]

    def merge_many(self, found: list[bytes]) -> list[list[int]]:
        """Ids of many words, merged side by side: in each round every word that
        still has a pair merges its leftmost one of lowest rank. Words of over
        32 bytes are merged one by one."""
        if not hasattr(self, "_keys"):
            pairs = sorted(self.ranks)
            self._keys = np.array([a << 20 | b for a, b in pairs], np.int64)
            self._rank = np.array([self.ranks[p][0] for p in pairs], np.int64)
            self._to = np.array([self.ranks[p][1] for p in pairs], np.int64)
            self._byte = np.array([self.ids[bytes((b,))] for b in range(256)], np.int64)
        out: list[list[int]] = [[]] * len(found)
        size = np.array([len(w) for w in found], np.int64)
        low = 0
        for high in (4, 8, 12, 16, 32):
            which = np.flatnonzero((size > low) & (size <= high))
            low = high
            for k in range(0, len(which), 1 << 15):
                part = which[k:k + (1 << 15)]
                for i, ids in zip(part.tolist(), self._side_by_side([found[i] for i in part], size[part], high)):
                    out[i] = ids
        for i in np.flatnonzero(size > low).tolist():
            out[i] = self.merge(found[i])
        return out

    def _side_by_side(self, found: list[bytes], size: np.ndarray, width: int) -> list[list[int]]:
        none = np.int64(len(self._keys))                # rank of what does not merge

        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Where a pair is among the merges, or ``none``."""
            key = a << 20 | b
            at = np.minimum(np.searchsorted(self._keys, key), none - 1)
            return np.where((b >= 0) & (self._keys[at] == key), at, none)

        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in found), np.uint8).reshape(len(found), width)
        tokens = np.where(np.arange(width) < size[:, None], self._byte[raw], -1)
        tokens = np.concatenate([tokens, np.full((len(found), 1), -1)], axis=1)
        spot = pair(tokens[:, :-1], tokens[:, 1:])
        rank = np.append(self._rank, none)
        order = rank[spot]
        left = size.copy()
        live = np.arange(len(found))
        columns = np.arange(width + 1)
        while len(live):
            best = order[live].argmin(axis=1)
            ok = order[live, best] < none
            live, best = live[ok], best[ok]
            if not len(live):
                break
            merged = self._to[spot[live, best]]
            shift = np.minimum(columns + (columns > best[:, None]), width)
            row = np.take_along_axis(tokens[live], shift, axis=1)
            row[np.arange(len(live)), best] = merged
            tokens[live] = row
            own = np.take_along_axis(spot[live], np.minimum(shift[:, :width], width - 1), axis=1)
            own[:, -1] = none
            here = np.arange(len(live))
            own[here, best] = pair(merged, row[here, best + 1])
            before = np.flatnonzero(best > 0)
            own[before, best[before] - 1] = pair(row[before, best[before] - 1], merged[before])
            spot[live], order[live] = own, rank[own]
            left[live] -= 1
        return [t[:n] for t, n in zip(tokens.tolist(), left.tolist())]

    def split_special(self, text: bytes) -> list[bytes]:
        """Ordinary stretches and special tokens of a text, in turn."""
        if not self.special or not any(s in text for s in self.special):
            return [text]
        import re
        return re.split(b"(" + b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + b")", text)
