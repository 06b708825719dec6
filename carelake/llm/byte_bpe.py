"""Byte-level BPE by a fixed public vocabulary: encode whole texts and decode the ids.

Tier one: a minimal perfect hash over the vocabulary (hash and displace: one slot per token, no empty slot) tells
whether a whole pre-token is a token; the slot's bytes are compared, since the hash answers for any key.
Tier two, for the other pre-tokens: linked bytes and a heap of possible merges by (rank, place); a stale entry is
dropped when its links have changed.  Workers keep a bounded memo of pre-tokens they have encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens in each of the two generations that a worker remembers.
MEMO = 300_000
_M64 = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings to ranks.  Keys fall into buckets by one half of their hash; a bucket
    stores the seed that sends its keys to free slots, or for a single key the slot itself (as -slot - 1)."""

    def __init__(self, ranks: dict[bytes, int]):
        n = self.n = max(1, len(ranks))
        self.n_buckets = n // 2 + 1
        buckets: dict[int, list[tuple[int, bytes]]] = {}
        for key in ranks:
            h = xxhash.xxh64_intdigest(key)
            buckets.setdefault((h >> 32) % self.n_buckets, []).append((h, key))
        self.seeds = [0] * self.n_buckets
        self.keys: list[bytes | None] = [None] * n
        self.ranks = [0] * n
        free = bytearray(b"\1") * n
        singles = []
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((b, members[0][1]))
                continue
            seed = 1
            while True:
                slots = {self._slot(h, seed) for h, _ in members}
                if len(slots) == len(members) and all(free[s] for s in slots):
                    break
                seed += 1
            self.seeds[b] = seed
            for h, key in members:
                self._put(self._slot(h, seed), key, ranks[key], free)
        empty = (i for i in range(n) if free[i])
        for (b, key), slot in zip(singles, list(empty)):
            self.seeds[b] = -slot - 1
            self._put(slot, key, ranks[key], free)

    def _slot(self, h: int, seed: int) -> int:
        x = (h ^ (seed * 0x9E3779B97F4A7C15)) & _M64
        x = ((x ^ (x >> 31)) * 0xD6E8FEB86659FD93) & _M64
        return (x >> 32) % self.n

    def _put(self, slot: int, key: bytes, rank: int, free: bytearray) -> None:
        self.keys[slot], self.ranks[slot], free[slot] = key, rank, 0

    def get(self, key: bytes) -> int:
        """The rank of a key, or -1."""
        h = xxhash.xxh64_intdigest(key)
        seed = self.seeds[(h >> 32) % self.n_buckets]
        slot = -seed - 1 if seed < 0 else self._slot(h, seed)
        return self.ranks[slot] if self.keys[slot] == key else -1


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (x.split() for x in rank_file.splitlines() if x.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.whole = PerfectHash(self.ranks)
        self.find = regex.compile(pattern).findall
        self.find_latin = _latin_pattern(pattern)
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.packed = [x.to_bytes(4, "little") for x in range(len(self.bytes_of))]
        self.byte = [self.ranks.get(bytes([i]), -1) for i in range(256)]
        self.joins = self._joins()
        self.memo = _Memo(self)

    def _joins(self) -> list[dict[int, int]]:
        """By rank of a left part: rank of the right part -> rank of the two joined."""
        ranks, out = self.ranks, [{} for _ in self.bytes_of]
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a = ranks.get(token[:cut])
                if a is not None and (b := ranks.get(token[cut:])) is not None:
                    out[a][b] = rank
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token: lowest rank first, leftmost first among equals.

        ``due[i]`` is the rank that joins part i with its right neighbour now; a heap entry that disagrees is
        stale."""
        joins = self.joins
        part = list(map(self.byte.__getitem__, piece))
        n = len(part)
        shift = n.bit_length()
        low = (1 << shift) - 1
        due = [joins[a].get(b, -1) for a, b in zip(part, part[1:])]
        heap = [r << shift | i for i, r in enumerate(due) if r >= 0]
        heapify(heap)
        due.append(-1)
        nxt, prv = [*range(1, n + 1)], [*range(-1, n - 1)]
        while heap:
            top = heappop(heap)
            i, r = top & low, top >> shift
            if due[i] != r:
                continue
            j = nxt[i]
            part[i], part[j], due[j] = r, -1, -1
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                q = due[i] = joins[r].get(part[k], -1)
                if q >= 0:
                    heappush(heap, q << shift | i)
            else:
                due[i] = -1
            h = prv[i]
            if h >= 0:
                q = due[h] = joins[part[h]].get(r, -1)
                if q >= 0:
                    heappush(heap, q << shift | h)
        return [x for x in part if x >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text, each as four little-endian bytes."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.turn()
        find = self.find_latin if self.find_latin and _is_latin(text) else self.find
        return b"".join(map(memo.__getitem__, find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Memo(dict):
    """Pre-token -> packed ids.  When full, it becomes the older generation, and a new one starts."""

    def __init__(self, codec: Codec):
        self.codec, self.old = codec, {}

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            raw, packed = piece.encode("utf-8", "surrogatepass"), self.codec.packed
            rank = self.codec.whole.get(raw)
            out = packed[rank] if rank >= 0 else b"".join([packed[x] for x in self.codec.merge(raw)])
        self[piece] = out
        return out


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _latin_pattern(pattern: str):
    """``findall`` of the same pattern for texts of code points below 256 only, where each class is a short list
    and the standard library's matcher, which is faster, can be used; None if it names other classes."""
    out = pattern
    inside = {c: "".join(f"\\x{i:02x}" for i in range(256) if regex.match(c, chr(i))) for c in _CLASSES}
    for c in _CLASSES:
        out = out.replace(rf"[^\s\p{{L}}\p{{N}}]", f"[^{''.join(inside.values())}]").replace(c, f"[{inside[c]}]")
    out = out.replace(r"\S", f"[^{inside[_CLASSES[2]]}]")
    if regex.search(r"\\[a-wyzA-Z]", out):
        return None
    return re.compile(out).findall


#: Classes that _latin_pattern() can spell out.
_CLASSES = (r"\p{L}", r"\p{N}", r"\s")


_CODECS: dict[str, Codec] = {}


def codec_of(rank_file: bytes, pattern: str) -> Codec:
    """The codec of a rank file, built once per worker process."""
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


def encode_documents(
    docs: DataFrame, rank_path: str, pattern: str, *, with_ids: bool = True, with_decoded: bool = True
) -> DataFrame:
    """``(doc_id, ids binary, n_tokens, ids_sha256, decoded_sha256, decoded binary)``, one row per row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit integers; ``ids`` and ``decoded`` are null unless asked for.  Null
    or empty text: no ids.  Repeated rows give repeated rows, an empty table none.  The rank file (a fixed
    vocabulary, under 1 MB) is read by the driver and broadcast; texts stay in their partitions: no shuffle.
    """
    with open(rank_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        codec = codec_of(shared.value, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [codec.encode(t.as_py() or "") for t in part.column(1)]
                raw = [codec.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(ids if with_ids else [None] * len(ids), pa.binary()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                        pa.array(raw if with_decoded else [None] * len(raw), pa.binary()),
                    ],
                    names,
                )

    names = ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "decoded"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded binary"
    )
