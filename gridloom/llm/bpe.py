"""Operator 5: byte-level BPE by prefix dynamic programming.

A BPE encoding is the one sequence of tokens in which every neighbouring pair is *compatible*:
the two tokens' bytes, encoded on their own, give back these two tokens. So each byte prefix has
exactly one valid last token, the one compatible with the last token of the shorter prefix before
it. ``PrefixTable`` stores that token per prefix: appending bytes only adds entries, and an edit
recomputes from the edit on. Pieces (matches of the split pattern) are encoded separately.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces remembered per worker; beyond it the memory starts anew (speed only, never results).
REMEMBERED = 800_000
#: Longer pieces (characters) are not remembered.
LONG = 256
#: Texts encoded together.
TOGETHER = 64
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost among equals; for tokens and short pairs."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(found)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's bytes ends in the token."""
        if token not in self.whole:
            self.whole[token] = self.merged(self.token[token]) == [token]
        return self.whole[token]

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= 4 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return known


class PrefixTable:
    """``last[i]``: the last token of the encoding of the first ``i + 1`` bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Exact append: earlier entries stay as they are."""
        start, self.data = len(self.data), self.data + more
        data, last, get, longest = self.data, self.last, self.v.ranks.get, self.v.longest
        known, compatible = self.v.pairs.get, self.v.compatible
        for end in range(start + 1, len(data) + 1):
            for at in range(max(0, end - longest), end):
                t = get(data[at:end])
                if t is None:
                    continue
                if not at:
                    fits = self.v.reachable(t)
                elif (fits := known((last[at - 1], t))) is None:
                    fits = compatible(last[at - 1], t)
                if fits:
                    last.append(t)
                    break
            else:
                raise ValueError("a byte of the text has no token")

    def turn_into(self, data: bytes) -> None:
        """Go over to other bytes; the entries of the common prefix stay."""
        n = len(os.path.commonprefix((self.data, data)))
        self.data = data[:n]
        del self.last[n:]
        self.append(data[n:])

    def replace(self, start: int, stop: int, by: bytes) -> None:
        """Bytes ``start`` to ``stop`` become ``by``; entries before the edit stay, later ones are
        recomputed only until they agree with the old ones over a whole token length."""
        old_data, old_last = self.data, self.last
        self.data, self.last = old_data[:start], old_last[:start]
        self.append(by)
        tail, shift, same = old_data[stop:], stop - len(self.data), 0
        for i in range(len(tail)):
            self.append(tail[i : i + 1])
            same = same + 1 if self.last[-1] == old_last[len(self.data) - 1 + shift] else 0
            if same > self.v.longest:
                self.data += tail[i + 1 :]
                self.last += old_last[stop + i + 1 :]
                return

    def ids(self, stop: int | None = None) -> list[int]:
        """The encoding of the first ``stop`` bytes, read backwards from its last token."""
        out, end = [], len(self.data) if stop is None else stop
        while end:
            t = self.last[end - 1]
            out.append(t)
            end -= len(self.v.token[t])
        return out[::-1]


class Codec:
    """Encodes whole texts piece by piece and decodes ids; pieces met before are remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int = REMEMBERED):
        self.v, self.split, self.remembered = vocabulary, regex.compile(pattern).findall, remembered
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces, in byte order, so that each keeps the table entries of the prefix it
        shares with the one before."""
        table, out = PrefixTable(self.v), {}
        for data, text in sorted((p.encode(), p) for p in pieces):
            whole = self.v.ranks.get(data)
            if whole is None:
                table.turn_into(data)
                ids = table.ids()
            else:
                ids = [whole]
            out[text] = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.split(t) for t in texts]
        new = {p for pieces in cut for p in pieces}.difference(self.known)
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = {p for pieces in cut for p in pieces}
        long = {p for p in new if len(p) > LONG}
        self.known.update(self.learn(new - long))
        get = (ChainMap(self.learn(long), self.known) if long else self.known).__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per worker process: the vocabulary is read once."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(Vocabulary.read(path), pattern)
    return _CODECS[path, pattern]


def encoded(documents: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded bytes of every row.

    Null counts as empty; an empty text has no ids. Repeated rows repeat. Extra columns are left
    behind. ``path`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [i for at in range(0, len(texts), TOGETHER) for i in c.encode(texts[at : at + TOGETHER])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(map(c.decode, ids), pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    return _slim(documents, key, text).mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(documents: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and hashes of ids and decoded bytes, made where the ids are; see ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            count, one, two = [], [], []
            for at in range(0, batch.num_rows, TOGETHER):
                for ids in c.encode([t or "" for t in batch.column(1).slice(at, TOGETHER).to_pylist()]):
                    count.append(len(ids) // 4)
                    one.append(hashlib.sha256(ids).hexdigest())
                    two.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(count, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _slim(documents, key, text).mapInArrow(run, RESULT)


def _slim(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(documents[f"`{key}`"].cast("long").alias("doc_id"), documents[f"`{text}`"].cast("string").alias("text"))
