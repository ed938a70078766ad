"""Operator 4: bytes covered by a string of ``length`` bytes that starts twice in the corpus.

Sorting every suffix of the corpus moves ``length`` bytes per byte. As in blockwise suffix
sorting with a difference cover, only a sample of the suffixes is ranked first, chosen so that
any two equal strings of ``length`` bytes hold a sampled suffix at the same distance from their
starts; all other suffixes are then settled by the ranks of their samples, and what still ties
is sorted one bucket at a time.

The cover is taken from the text itself (in each window of suffixes the one with the least
hash), because then equal strings meet in *every* sampled suffix, not in one of twelve.

1. Rank samples by their first bytes. A sample that is alone settles every string above it: unique.
2. Rank the rest by all bytes around the sample that strings above it can hold (``context``). An
   equal context settles every string above the sample: repeated.
3. Strings above the other samples, and above one sample of each context that they could equal,
   go in runs of ``RUN`` neighbours: a run whose common core occurs once is settled as unique. The
   strings of the other runs are sorted bucket by bucket on their core and the few bytes around
   it; neighbours that tie are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tables import _LETTER, _STEP, mixed, own_names, powers, released, text_chunks, told_apart, written

SEED_BYTES = 32
#: Neighbouring strings that travel as one row: their core, and the bytes before and after it.
RUN = 8
#: Strings sorted together in a mapping task before they are sent; equal ones meet there first.
BATCH_STRINGS = 1_000_000
_INVERSE = pow(_STEP, -1, 1 << 64)
_BACK = [np.ones(1, np.uint64)]


def _back(n: int) -> np.ndarray:
    if len(_BACK[0]) < n:
        steps = np.full(n + n // 2, _INVERSE, np.uint64)
        steps[0] = 1
        _BACK[0] = np.multiply.accumulate(steps)
    return _BACK[0][:n]


class Prints:
    """Fingerprints of any string of one chunk of texts."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        n = len(data)
        self.offsets, self.n = offsets, n
        self.sums = np.zeros(n + 1, np.uint64)
        if n:
            np.cumsum(_LETTER[data] * powers(n), dtype=np.uint64, out=self.sums[1:])
        self.back = _back(n + 1)

    def names(self, starts: np.ndarray, length) -> np.ndarray:
        """Fingerprints of the strings that begin at ``starts``."""
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.back[starts])


class Cover(Prints):
    """The samples of a chunk, and the strings above each: ``many`` from ``first`` on."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, length: int, seed: int):
        super().__init__(offsets, data)
        self.length = length
        ends = np.repeat(offsets[1:], np.diff(offsets))
        strings = np.flatnonzero(np.arange(self.n) + length <= ends)
        if not len(strings):
            self.samples = self.first = self.many = np.zeros(0, np.int64)
            return
        grams = self.names(np.arange(self.n - seed + 1), seed) & np.uint64((1 << 64) - (1 << 30))
        least = _window_min(grams | np.arange(len(grams), dtype=np.uint64), length - seed + 1)
        sample_of = (least[strings] & np.uint64((1 << 30) - 1)).astype(np.int64)
        edge = np.flatnonzero(np.diff(sample_of, prepend=-1))
        self.samples, self.first = sample_of[edge], strings[edge]
        self.many = np.diff(edge, append=len(strings))

    def contexts(self) -> np.ndarray:
        """Fingerprints of all bytes of the strings above each sample, and of its place in them."""
        place = (self.samples - self.first).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        return mixed(self.names(self.first, self.many - 1 + self.length) + place + self.many.astype(np.uint64))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each window of ``w``; running minima forwards and backwards inside blocks."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - w + 1], forward[w - 1 : n])


def samples(documents: DataFrame, length: int, seed: int) -> DataFrame:
    """key, context, doc, pos of every sampled suffix of (doc, text); the strings above it are
    ``many`` from ``ahead`` bytes before it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, offsets, data in text_chunks(batch.column(1)):
                c = Cover(offsets, data, length, seed)
                if not len(c.samples):
                    continue
                rows = np.searchsorted(offsets, c.samples, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.names(c.samples, seed).view(np.int64)), pa.array(c.contexts().view(np.int64)),
                     pa.array(ids[row + rows].astype(np.int64)), pa.array((c.samples - offsets[rows]).astype(np.int32)),
                     pa.array((c.samples - c.first).astype(np.int32)), pa.array(c.many.astype(np.int32))],
                    ["key", "context", "doc", "pos", "ahead", "many"],
                )

    return documents.mapInArrow(run, "key long, context long, doc long, pos int, ahead int, many int")


REPEATED, OPEN, GIVES = 1, 2, 3


class Marks:
    """A column of lists of marks: numpy arrays of the marks of some rows, and their rows."""

    def __init__(self, column: pa.ListArray):
        self.ends = column.offsets.to_numpy()
        self.fields = {k: column.values.field(k).to_numpy().astype(np.int64) for k in ("pos", "ahead", "many", "state")}

    def of(self, row: int, rows: int) -> tuple[np.ndarray, ...]:
        """Row (from 0), pos, ahead, many and state of the marks of ``rows`` rows from ``row`` on."""
        ends = self.ends[row : row + rows + 1]
        return np.repeat(np.arange(rows), np.diff(ends)), *[f[ends[0] : ends[-1]] for f in self.fields.values()]


def open_runs(texts: DataFrame, length: int) -> DataFrame:
    """Runs of the strings that step 3 settles, of (doc, text, marks).

    ``core`` names the bytes that all strings of a whole run share, from ``pos`` on; ``left`` and
    ``right`` are the bytes before and after it, the nearest lowest. String j of a run starts j bytes
    before the core and has RUN - 1 - j bytes after it; those from ``low`` to ``high`` are meant.
    """
    size = length - RUN + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), Marks(batch.column(2))
            for row, offsets, data in text_chunks(batch.column(1)):
                rows, pos, ahead, many, state = marks.of(row, len(offsets) - 1)
                at = np.flatnonzero(state >= OPEN)
                if not len(at):
                    continue
                least, most = (ahead - many + 1)[at], ahead[at]
                runs = most // RUN - least // RUN + 1
                at, least, most = np.repeat(at, runs), np.repeat(least, runs), np.repeat(most, runs)
                near = RUN * (least // RUN + np.arange(len(at)) - np.repeat(np.cumsum(runs) - runs, runs))
                low, high = np.maximum(0, least - near), np.minimum(RUN - 1, most - near)
                place = pos[at] - near
                start = offsets[rows[at]] + place
                padded = np.concatenate([np.zeros(RUN, np.uint64), data.astype(np.uint64), np.zeros(RUN, np.uint64)])
                left, right = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
                for j in range(RUN - 1):
                    shift = np.uint64(8 * j)
                    left |= np.where(j < high, padded[start - 1 - j + RUN], np.uint64(0)) << shift
                    right |= np.where(j < RUN - 1 - low, padded[start + size + j + RUN], np.uint64(0)) << shift
                yield pa.RecordBatch.from_arrays(
                    [pa.array(Prints(offsets, data).names(start, size).view(np.int64)), pa.array(left.view(np.int64)), pa.array(right.view(np.int64)),
                     pa.array(ids[row + rows[at]].astype(np.int64)), pa.array(place.astype(np.int32)),
                     pa.array(low.astype(np.int8)), pa.array(high.astype(np.int8)), pa.array(state[at].astype(np.int8))],
                    ["core", "left", "right", "doc", "pos", "low", "high", "state"],
                )

    return texts.mapInArrow(run, "core long, left long, right long, doc long, pos int, low byte, high byte, state byte")


def strings_of(runs: DataFrame) -> DataFrame:
    """name, doc, pos, state of the single strings of runs.

    Open strings that tie in the task are already known to be repeated; one of those that tie is
    sent to tie with others. Runs of one core mostly come together, so this settles most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def answer() -> pa.RecordBatch:
            name, doc, pos, state = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(name, kind="stable")
            name, doc, pos, state = name[order], doc[order], pos[order], state[order]
            new = np.ones(len(name), bool)
            new[1:] = name[1:] != name[:-1]
            size = np.diff(np.flatnonzero(np.append(new, True)))
            alone = np.repeat(size == 1, size)
            sure = ~alone & (state == OPEN)
            first = new & ~alone
            pick = np.concatenate([np.flatnonzero(alone), np.flatnonzero(first), np.flatnonzero(sure)])
            state = np.concatenate([state[alone], np.full(first.sum(), GIVES), np.full(sure.sum(), REPEATED)])
            return pa.RecordBatch.from_arrays(
                [pa.array(name[pick].view(np.int64)), pa.array(doc[pick]), pa.array(pos[pick].astype(np.int32)), pa.array(state.astype(np.int8))],
                ["name", "doc", "pos", "state"],
            )

        for batch in batches:
            core, left, right, doc, pos, low, high, state = (c.to_numpy() for c in batch.columns)
            core, left, right = core.view(np.uint64), left.view(np.uint64), right.view(np.uint64)
            for j in range(RUN):
                at = np.flatnonzero((low <= j) & (j <= high))
                before = left[at] & np.uint64((1 << 8 * j) - 1)
                after = right[at] & np.uint64((1 << 8 * (RUN - 1 - j)) - 1)
                # Together RUN - 1 bytes; the eighth tells j.
                around = before | (after << np.uint64(8 * j)) | np.uint64(j << 56)
                held.append((mixed(core[at] + mixed(around)), doc[at], pos[at] - j, state[at]))
                count += len(at)
            if count >= BATCH_STRINGS:
                yield answer()
                held, count = [], 0
        if count:
            yield answer()

    return runs.mapInArrow(run, "name long, doc long, pos int, state byte")


def sorted_ties(strings: DataFrame) -> DataFrame:
    """doc, pos of open strings that tie: buckets are sorted one at a time and neighbours compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, carried = None, None  # last name of the batch before, its row if still without a tie
        for batch in batches:
            if not batch.num_rows:
                continue
            name, doc, pos, state = (batch.column(i).to_numpy() for i in range(4))
            ties = np.zeros(len(name), bool)
            ties[1:] = name[1:] == name[:-1]
            ties[:-1] |= ties[1:]
            docs, places = [], []
            run_in = name == before if before is not None else np.zeros(len(name), bool)
            ties |= run_in
            if carried is not None and run_in.any():
                docs.append([carried[0]])
                places.append([carried[1]])
                carried = None
            out = ties & (state == OPEN)
            docs.append(doc[out])
            places.append(pos[out])
            if len(name) and not ties[-1]:
                carried = (doc[-1], pos[-1]) if state[-1] == OPEN else None
            elif len(name):
                carried = None
            before = name[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(docs).astype(np.int64)), pa.array(np.concatenate(places).astype(np.int32))], ["doc", "pos"]
            )

    return strings.repartition("name").sortWithinPartitions("name").mapInArrow(run, "doc long, pos int")


def _answer(ids: list, parts: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
    cells = list(zip(*parts)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(cells, kinds)]],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def cleaned(data: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int]:
    """``data`` without the stretches from ``starts`` to ``stops``, and the number of runs removed."""
    cover = np.zeros(len(data) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, stops, -1)
    gone = np.cumsum(cover[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), runs


def repeated_bytes(documents: DataFrame, length: int = 200, seed: int = SEED_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Matches never cross texts; null counts as empty, texts shorter than ``length`` lose nothing;
    equal texts lose all. ``length`` is at least ``seed`` and RUN. Strings are compared by 64-bit fingerprints. Rows that
    share a key with another text, and rows without key, are texts of their own; rows that repeat key and
    text come back each, and their bytes start elsewhere too. Extra columns are left behind. Empty
    input gives an empty result.
    """
    texts = own_names(documents, **{key: "doc", text: "text"}).select(F.col("doc").cast("long"), F.col("text").cast("string"))
    texts, renamed = told_apart(texts)
    # Each side of a join on a key that may be hot is a table of its own, so that adaptive
    # execution can split the hot key.
    sampled = written(samples(texts, length, seed), "suffix-samples")
    often = written(sampled.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "suffix-keys")
    tied = written(sampled.join(often, "key"), "suffix-ties")
    released(sampled, often)
    contexts = tied.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pos")).alias("first"))
    contexts = written(contexts, "suffix-contexts")
    open_keys = written(contexts.where("n = 1").groupBy("key").agg(F.count("*").alias("open")), "suffix-open")
    known = written(contexts.join(open_keys, "key", "left"), "suffix-known")
    released(contexts, open_keys)
    state = F.when(F.col("n") == 1, OPEN).when(F.col("open").isNotNull() & (F.struct("doc", "pos") == F.col("first")), GIVES).otherwise(REPEATED)
    marks = tied.join(known, ["key", "context"]).select("doc", F.struct("pos", "ahead", "many", state.cast("int").alias("state")).alias("mark"))
    marks = marks.groupBy("doc").agg(F.collect_list("mark").alias("marks"))
    texts_marked = texts.join(marks, "doc", "left")
    # One pass over the join: marked texts keep their text, the others only their digest.
    both = texts_marked.select(
        "doc", "marks",
        F.when(F.col("marks").isNotNull(), F.col("text")).alias("text"),
        F.when(F.col("marks").isNull(), F.octet_length(F.coalesce("text", F.lit(""))).cast("long")).alias("n_bytes"),
        F.when(F.col("marks").isNull(), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("kept_sha256"),
    )
    both = written(both, "suffix-texts")
    released(tied, known)
    marked = both.where("marks IS NOT NULL").select("doc", "text", "marks")
    runs = written(open_runs(marked, length), "suffix-runs")
    cores = written(runs.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "suffix-cores")
    shared = runs.join(cores, "core").select(*runs.columns)
    strings = written(strings_of(shared), "suffix-strings")
    released(runs, cores)
    found = sorted_ties(strings.where(F.col("state") != REPEATED)).union(strings.where(F.col("state") == REPEATED).select("doc", "pos"))
    found = found.groupBy("doc").agg(F.collect_list("pos").alias("found"))
    done = marked.join(found, "doc", "left").select("doc", "text", "marks", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, more = batch.column(0).to_pylist(), Marks(batch.column(2)), batch.column(3)
            for row, offsets, data in text_chunks(batch.column(1)):
                rows, pos, ahead, many, state = marks.of(row, len(offsets) - 1)
                sure = np.isin(state, (REPEATED, GIVES))
                first, last = (pos - ahead)[sure], (pos - ahead + many - 1 + length)[sure]
                bounds = np.searchsorted(rows[sure], np.arange(len(offsets)))
                out = []
                for i in range(len(offsets) - 1):
                    starts, stops = first[bounds[i] : bounds[i + 1]], last[bounds[i] : bounds[i + 1]]
                    extra = more[row + i].values
                    if extra is not None:
                        extra = extra.to_numpy().astype(np.int64)
                        starts, stops = np.concatenate([starts, extra]), np.concatenate([stops, extra + length])
                    own = data[offsets[i] : offsets[i + 1]].tobytes()
                    kept, cuts = cleaned(own, starts, stops)
                    out.append((len(own), len(own) - len(kept), cuts, hashlib.sha256(kept).hexdigest()))
                yield _answer(ids[row : row + len(out)], out)

    got = done.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    zero = F.lit(0).cast("long")
    rest = both.where("marks IS NULL").select(F.col("doc").alias("doc_id"), "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256")
    every = got.unionByName(rest)
    if renamed is None:
        return every
    named = every.join(renamed.select(F.col("doc").alias("doc_id"), "own", F.lit(True).alias("hashed")), "doc_id", "left")
    return named.withColumn("doc_id", F.when(F.col("hashed"), F.col("own")).otherwise(F.col("doc_id"))).select(*every.columns)
