"""Operator 6: packing by the dot-product heuristic of vector bin packing.

An example has three sizes: tokens, one segment, loss-bearing tokens. A sequence has a limit for
each. Into the open sequence goes, of all examples that fit, the one whose size vector has the
largest dot product with the room left (both as shares of the limits). When none fits, the
example with the largest dot product is cut to the room left, so no token room is lost while
segments are left. Every Spark partition packs its own rows in blocks of bounded size: no
shuffle, and a lost task packs the same rows again.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tokens gathered before a block is packed; bounds a worker's memory.
BLOCK_TOKENS = 4_000_000
REMEMBERED = 1_200_000
#: New words of letters joined for one call of the tokenizer.
WORDS_A_CALL = 500
#: Neither letters, figures nor white space.
MARKS = string.punctuation
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> list[list[tuple[int, int, int]]]:
    """Sequences of (example, start, length).

    Limits: tokens, segments and loss-bearing tokens of a sequence. An example's loss-bearing
    tokens are its last ones. Examples without tokens take no part. Equal examples are chosen
    in order of their number.
    """
    most, segments, most_loss = limits
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    waiting: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def put(example: int, start: int) -> None:
        kind = (int(tokens[example]) - start, int(min(loss[example], tokens[example] - start)))
        waiting.setdefault(kind, []).append((example, start))

    for example in range(len(tokens) - 1, -1, -1):
        if tokens[example] > 0:
            put(example, 0)
    kinds = np.array(sorted(waiting), np.int64).reshape(-1, 2)
    alive = np.ones(len(kinds), bool)
    place = {tuple(k): i for i, k in enumerate(kinds.tolist())}
    out: list[list[tuple[int, int, int]]] = []
    extra: list[tuple[int, int]] = []  # kinds of rests, which are few at a time
    left = sum(map(len, waiting.values()))

    def take(kind: tuple[int, int]) -> tuple[int, int]:
        got = waiting[kind].pop()
        if not waiting[kind]:
            if kind in place:
                alive[place[kind]] = False
            else:
                extra.remove(kind)
                del waiting[kind]
        return got

    while left:
        room, free, room_loss = most, segments, most_loss
        now: list[tuple[int, int, int]] = []
        while left and room and free:
            size, bearing = kinds[:, 0], kinds[:, 1]
            weight = np.where(alive, size * (room / most**2) + bearing * (room_loss / most_loss**2), -1.0)
            fits = alive & (size <= room) & (bearing <= room_loss)
            best = int(np.argmax(np.where(fits, weight, -1.0))) if fits.any() else -1
            value, kind = (weight[best], tuple(kinds[best].tolist())) if best >= 0 else (-1.0, None)
            for k in extra:
                v = k[0] * (room / most**2) + k[1] * (room_loss / most_loss**2)
                if k[0] <= room and k[1] <= room_loss and v > value:
                    value, kind = v, k
            if kind is not None:
                example, start = take(kind)
                now.append((example, start, kind[0]))
                room, room_loss, free, left = room - kind[0], room_loss - kind[1], free - 1, left - 1
                continue
            kind = max(extra, key=lambda k: k[0]) if extra else None
            if kind is None or (alive.any() and weight.max() > kind[0] * (room / most**2) + kind[1] * (room_loss / most_loss**2)):
                kind = tuple(kinds[int(np.argmax(weight))].tolist())
            plain = kind[0] - kind[1]
            length = min(room, plain + room_loss, kind[0])
            if length <= 0:
                break
            example, start = take(kind)
            now.append((example, start, length))
            room, room_loss, free = room - length, room_loss - max(0, length - plain), free - 1
            rest = (kind[0] - length, min(kind[1], kind[0] - length))
            if rest not in waiting or not waiting[rest]:
                if rest in place:
                    alive[place[rest]] = True
                else:
                    extra.append(rest)
            waiting.setdefault(rest, []).append((example, start + length))
        if not now:
            raise ValueError("no example fits a sequence")
        out.append(now)
    return out


def without_padding(sequence: list[tuple[int, int, int]], most: int) -> Iterator[list[tuple[int, int, int]]]:
    """A sequence of another length than ``most`` as sequences of powers of two, which need no
    padding: its pieces are cut where the powers end."""
    total = sum(n for _, _, n in sequence)
    if total == most:
        yield sequence
        return
    room, now = 1 << (total.bit_length() - 1), []
    for example, start, n in sequence:
        while n:
            part = min(n, room)
            now.append((example, start, part))
            start, n, room, total = start + part, n - part, room - part, total - part
            if not room:
                yield now
                now, room = [], 1 << (total.bit_length() - 1) if total else 0


def pack_documents(documents: DataFrame, encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]], limits: tuple[int, int, int],
                   prompt: str | None = None, key: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of every row's ids with the sequence and offset they lie at.

    ``encoder`` makes, in the worker, a function from texts to id arrays (never empty: it appends
    an end id). ``prompt`` names an integer column with the count of leading tokens that bear no
    loss (instruction data); without it every token bears loss. Null text counts as empty; a
    repeated row is packed again; a row longer than a sequence is cut. Sequences fill up to the
    token limit unless segments or loss run out first; the rest of a block, and such sequences,
    are cut at powers of two. Sequence ids are unique, not gapless. Extra columns are left behind.
    """
    columns = [documents[f"`{key}`"].cast("long").alias("doc_id"), documents[f"`{text}`"].cast("string").alias("text")]
    if prompt:
        columns.append(documents[f"`{prompt}`"].cast("long").alias("prompt"))
    most = limits[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        number = TaskContext.get().partitionId() << 36
        names: list = []
        ids: list[np.ndarray] = []
        loss: list[int] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number
            lengths = np.array([len(i) for i in ids], np.int64)
            rows = []
            for full in pack(lengths, np.array(loss, np.int64), limits):
                for sequence in without_padding(full, most):
                    offset = 0
                    for e, start, n in sequence:
                        crc = zlib.crc32(ids[e][start : start + n].astype("<u4").tobytes())
                        rows.append((names[e], start, n, crc, len(ids[e]), number, offset))
                        offset += n
                    number += 1
            kinds = [pa.int64()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds],
                [c.split()[0] for c in PIECES.split(", ")],
            )

        for batch in batches:
            prompts = batch.column(2).to_pylist() if prompt else None
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for j, got in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    names.append(part.column(0)[j].as_py())
                    ids.append(got)
                    loss.append(max(0, len(got) - max(0, prompts[at + j] or 0)) if prompts else len(got))
                    held += len(got)
                if held >= block_tokens:
                    yield block()
                    names, ids, loss, held = [], [], [], 0
        if names:
            yield block()

    return documents.select(*columns).mapInArrow(run, PIECES)


def word_encoder(path: str, end: int, remembered: int = REMEMBERED) -> Callable[[], Callable[[list[str]], list[np.ndarray]]]:
    """Ids of a lower-casing word-level BPE file whose tokens never cross white space and whose last
    token of a word carries an end mark, plus the id ``end``.

    Texts are cut at spaces and line ends; each word met for the first time goes through the
    tokenizer, known ones are looked up. Words of Latin letters, with or without marks behind
    them, go to the merges as they are, many in one call; all others take the file's whole way.
    """

    def make() -> Callable[[list[str]], list[np.ndarray]]:
        tokenizer, merges, ends = _tokenizer(path)
        known = _WORDS.setdefault(path, {})
        last = np.array([end], np.uint32).tobytes()

        def learn(new: set[str]) -> None:
            """Words go through as lower-case stems and marks: a run of marks behind letters is cut
            off them by the file's own rule, and letters below U+0130 lower alike in any context
            and are in composed form."""
            parts, plain, other = {}, set(), set()
            for w in new:
                low = w.isascii() or max(w) < "\u0130"
                stem = w.lower() if low else w
                core = stem.rstrip(MARKS)
                if low and core.isalpha():
                    plain.add(core)
                    if core != w:
                        parts[w] = (core, stem[len(core) :])
                elif len(stem) > 1 and stem[-1] in ".,:;!?|" and stem[-2].lower().isalnum() and "<|" not in stem:
                    parts[w] = (stem[:-1], stem[-1])
                    other.add(stem[:-1])
                else:
                    parts[w] = (stem if "<|" not in w else w, "")
                    other.add(parts[w][0])
            other.update({mark for _, mark in parts.values()})
            other = list(other.difference(known))
            for w, e in zip(other, tokenizer.encode_batch_fast(other, add_special_tokens=False)):
                known[w] = np.array(e.ids, np.uint32).tobytes()
            plain = list(plain.difference(known))
            joined = [" ".join(plain[at : at + WORDS_A_CALL]) for at in range(0, len(plain), WORDS_A_CALL)]
            ids = [np.array(e.ids, np.uint32) for e in merges.encode_batch_fast(joined, add_special_tokens=False)]
            if ids:
                ids = np.concatenate(ids)
                stops = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
                ids = ids.tobytes()
                known.update(zip(plain, [ids[i:j] for i, j in zip([0, *stops], stops)], strict=True))
            for w, (stem, mark) in parts.items():
                if w not in known:
                    known[w] = known[stem] + known[mark]

        def encode(texts: list[str]) -> list[np.ndarray]:
            cut = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") for t in texts]
            new = set().union(*cut).difference(known)
            if len(known) + 2 * len(new) > remembered:
                known.clear()
                new = set().union(*cut)
            learn(new)
            get = known.__getitem__
            return [np.frombuffer(b"".join([*map(get, words), last]), np.uint32) for words in cut]

        return encode

    return make


_WORDS: dict[str, dict[str, bytes]] = {}
_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    """The file's tokenizer, its merges alone for words of letters, and which ids end a word."""
    if path not in _TOKENIZERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        merges = Tokenizer(whole.model)
        merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        mark = whole.model.end_of_word_suffix
        if not mark:
            raise ValueError(f"the tokens of {path} do not mark the end of a word")
        vocabulary = whole.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        _TOKENIZERS[path] = whole, merges, ends
    return _TOKENIZERS[path]
