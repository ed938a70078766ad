"""Operator 1: n-gram Jaccard join over prefix trees.

1. One pass over the texts gives each document its set of word n-grams (64-bit hashes), a
   fingerprint of its word sequence, and the smallest hashes of its set. Equal word sequences
   become one member.
2. Of two sets with similarity t, a must share at least ``l`` of the (1 - t) n + l smallest
   hashes. Members that share fewer with everyone together have no link. This leaves few.
3. The sets of the rest are put in one global order, rare n-grams first, and the prefixes that
   a linked pair must share are grouped by n-gram. In a group the prefixes' next n-grams form a
   trie. A probe walks it, carries the overlap and the misses of the path so far, which all
   members below share, and leaves a subtree when the lengths that remain cannot bring the
   overlap needed.
4. Pairs the trie leaves are compared in full. The first round probes with a few members per group
   (hubs); what they link is one component. The second round probes with every member but passes
   over members of its own component, so a large group of near copies costs few pairs within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.components import components
from gridloom.llm.tables import Words, mixed, own_names, released, text_chunks, written

#: N-grams of the path after the shared one that go into the trie; only pruning depends on it.
DEPTH = 48
#: N-grams of the prefix before the shared one that an entry keeps, to know a pair from its first.
BEHIND = 16
#: Members of a group that probe in the first round, on average; the second round is exact with any.
HUBS = 16
#: Members of one group that meet in one task; larger groups are split into blocks of pairs.
BLOCK_ROWS = 512


def needed(n, similarity: int):
    """Smallest overlap of a set of size n with any partner: ceil(n * similarity / 100)."""
    return -((-n * similarity) // 100)


def profiles(documents: DataFrame, words: int, similarity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (set size), two fingerprint halves of the word sequence, smallest hashes, their
    number asked for (``must``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, offsets, data in text_chunks(batch.column(1)):
                w = Words(offsets, data)
                grams = w.shingles(words)
                size, one, two, must, low = [], [], [], [], []
                for i in range(len(offsets) - 1):
                    a, b = w.bounds[i], w.bounds[i + 1]
                    own = _gram_set(w.hash[a:b], grams[a : max(a, b - words + 1)], words)
                    n = len(own)
                    place = np.arange(1, b - a + 1, dtype=np.uint64)
                    one.append(int((w.hash[a:b] * (place * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1))).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(((w.hash[a:b] ^ (w.hash[a:b] >> np.uint64(29))) * (place * np.uint64(0xA0761D6478BD642F) | np.uint64(1))).sum(dtype=np.uint64).view(np.int64)))
                    slack = n - needed(n, similarity)
                    l = 1 + slack // 2 if n else 0
                    size.append(n)
                    must.append(l)
                    low.append(own[: slack + l].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(size)).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                     pa.array(must, pa.int64()), _lists(low)],
                    ["doc_id", "n", "one", "two", "must", "low"],
                )

    return own_names(documents, **{key: "doc_id", text: "text"}).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, one long, two long, must long, low array<long>"
    )


def _gram_set(word_hashes: np.ndarray, grams: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct n-grams; fewer words than n are one n-gram as a whole."""
    if len(word_hashes) >= words:
        return np.unique(grams)
    if not len(word_hashes):
        return np.zeros(0, np.uint64)
    place = np.arange(1, len(word_hashes) + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
    return mixed((word_hashes ^ place).sum(dtype=np.uint64, keepdims=True))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def gram_sets(documents: DataFrame, words: int) -> DataFrame:
    """doc_id and the sorted n-gram hashes of each row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in text_chunks(batch.column(1)):
                w = Words(offsets, data)
                grams = w.shingles(words)
                own = []
                for i in range(len(offsets) - 1):
                    a, b = w.bounds[i], w.bounds[i + 1]
                    own.append(_gram_set(w.hash[a:b], grams[a : max(a, b - words + 1)], words).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(own)), _lists(own)], ["doc_id", "grams"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, grams array<long>")


class Trie:
    """Paths of n-grams (global order); each node knows the bounds of the members below it."""

    def __init__(self) -> None:
        self.children: dict = {}
        self.members: list[tuple[int, int, int]] = []  # (member, n, n-grams after the path)
        self.shortest, self.most_after = 1 << 60, 0

    def insert(self, member: int, n: int, after: int, path: tuple[int, ...]) -> None:
        node, left = self, after
        node._note(n, left)
        for gram in path:
            left -= 1
            if gram not in node.children:
                node.children[gram] = Trie()
            node = node.children[gram]
            node._note(n, left)
        node.members.append((member, n, left))

    def _note(self, n: int, left: int) -> None:
        self.shortest, self.most_after = min(self.shortest, n), max(self.most_after, left)

    def probe(self, n: int, after: int, path: tuple[int, ...], similarity: int) -> Iterator[int]:
        """Members that may reach the similarity with a set of size ``n`` that shares the n-gram
        above this trie and goes on with ``path`` and ``after - len(path)`` n-grams more.

        The path and the trie are in the same order, so a step in the trie either meets the
        probe's next n-gram, or passes some of them, or misses.
        """
        cut_off = len(path) < after
        stack = [(self, 0, 1, 0)]  # node, n-grams of the probe passed, overlap, steps not compared
        while stack:
            node, at, overlap, blind = stack.pop()
            need = -(-similarity * (n + node.shortest) // (100 + similarity))
            if overlap + min(node.most_after + blind, after - at) < need:
                continue
            for member, m, left in node.members:
                if overlap + min(left + blind, after - at) >= -(-similarity * (n + m) // (100 + similarity)):
                    yield member
            for gram, child in node.children.items():
                to = at
                while to < len(path) and path[to] < gram:
                    to += 1
                if to == len(path) and cut_off:  # what comes next in the probe is not known here
                    stack.append((child, at, overlap, blind + 1))
                else:
                    met = to < len(path) and path[to] == gram
                    stack.append((child, to + met, overlap + met, blind))


def _grouped(table: pa.Table) -> Iterator[dict[str, list]]:
    """Runs of equal (gram, left, right) of a table sorted by them."""
    if not table.num_rows:
        return
    keys = [table[c].to_numpy() for c in ("gram", "left", "right")]
    change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    edges = [0, *change.tolist(), table.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield table.slice(a, b - a).to_pydict()


def _trie_pairs(similarity: int):
    def group(rows: dict[str, list]) -> Iterator[tuple[int, int]]:
        """Side 0 probes, side 1 is probed, side 2 both."""
        trie, docs, labels = Trie(), rows["doc"], rows["component"]
        behind = [frozenset(grams) for grams in rows["before"]]
        for i, (n, after, path, side) in enumerate(zip(rows["n"], rows["after"], rows["path"], rows["side"])):
            if side:
                trie.insert(i, n, after, tuple(path))
        for i, (n, after, path, side) in enumerate(zip(rows["n"], rows["after"], rows["path"], rows["side"])):
            if side != 1:
                for j in trie.probe(n, after, tuple(path), similarity):
                    # A pair that shares an n-gram before this one is met in that one's group.
                    if docs[j] != docs[i] and labels[j] != labels[i] and behind[i].isdisjoint(behind[j]):
                        yield min(docs[i], docs[j]), max(docs[i], docs[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            # The last run may go on in the next batch.
            keys = [table[c].to_numpy() for c in ("gram", "left", "right")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            rest = table.slice(cut)
            yield from answers(table.slice(0, cut))
        if rest is not None:
            yield from answers(rest)

    def answers(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for rows in _grouped(table):
            for pair in group(rows):
                found.add(pair)
                if len(found) >= 100_000:
                    yield _pairs(found)
                    found = set()
        if found:
            yield _pairs(found)

    return run


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def trie_join(entries: DataFrame, similarity: int, hubs: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct candidate pairs (a, b) of ``entries``: gram, doc, n, after, path, before, component.

    Every member of an n-gram's group probes the group's trie, or with ``hubs`` about so many of
    them, by a hash of the document, so that groups with the same members have the same hubs. A
    group larger than ``block_rows`` is dealt to blocks with a trie each: a hub goes to all of them,
    or each pair of blocks meets in a task's group of its own, so that no more than two blocks are
    ever held.
    """
    sizes = entries.groupBy("gram").agg(F.count("*").alias("size"))
    dealt = entries.join(sizes.where("size > 1"), "gram").withColumn("blocks", F.ceil(F.col("size") / block_rows).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc"), F.col("blocks")).cast("int"))
    if hubs is not None:
        meets = F.expr(
            f"concat(array(struct(0 AS left, block AS right, 1 AS side)), IF(pmod(xxhash64('hub', doc), 1048576) * size < {hubs} * 1048576L, "
            "transform(sequence(0, blocks - 1), r -> struct(0 AS left, r AS right, 0 AS side)), array()))"
        )
    else:
        meets = F.expr(
            "concat(transform(sequence(0, block), r -> struct(block AS left, r AS right, IF(r = block, 2, 0) AS side)), "
            "transform(filter(sequence(0, blocks - 1), l -> l > block), l -> struct(l AS left, block AS right, 1 AS side)))"
        )
    dealt = dealt.withColumn("meet", F.explode(meets)).select(
        "gram", "meet.left", "meet.right", "meet.side", "doc", "n", "after", "path", "before", "component"
    )
    spread = dealt.repartition("gram", "left", "right").sortWithinPartitions("gram", "left", "right")
    return spread.mapInArrow(_trie_pairs(similarity), "a long, b long").distinct()


def linked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity (100 * intersection >= similarity * union)."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("both", both)
    return joined.where(100 * F.col("both") >= similarity * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")


def jaccard_classes(documents: DataFrame, words: int = 5, similarity: int = 80, key: str = "doc_id", text: str = "text",
                    depth: int = DEPTH, block_rows: int = BLOCK_ROWS, hubs: int = HUBS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    ``similarity`` is a whole percentage of intersection over union, from 1 to 100. A null or empty text and a
    text of blanks have size 0 and are linked with nothing, so each is its own component; a text with
    fewer words than ``words`` is one n-gram. Equal texts are linked. A row with a null key keeps its
    size, and links nothing (component null). Repeated rows of one key come back each; if their
    texts differ the key stands for all of them. Extra columns are left behind. Hashes have 64
    bits, fingerprints of word sequences 128.
    """
    profile = written(profiles(documents, words, similarity, key, text), "profiles")
    known = profile.where("doc_id IS NOT NULL AND n > 0")
    member = written(known.groupBy("one", "two").agg(F.min("doc_id").alias("member")), "members")
    of = known.select("doc_id", "one", "two").join(member, ["one", "two"]).groupBy("doc_id").agg(F.min("member").alias("member"))
    of = written(of, "memberships")
    released(member)
    heads = known.join(of.where("doc_id = member").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    # Members that share enough of their smallest hashes with others.
    low = heads.select("doc_id", "must", F.explode("low").alias("gram"))
    shared = low.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1").select("gram")
    hits = low.join(shared, "gram").groupBy("doc_id").agg(F.count("*").alias("hits"), F.min("must").alias("must"))
    some = written(hits.where("hits >= must").select("doc_id"), "candidates")
    sizes = written(profile.select("doc_id", "n").join(of, "doc_id", "left"), "sizes")
    released(profile, of)

    texts = own_names(documents, **{key: "doc_id", text: "text"}).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    picked = texts.join(some, "doc_id", "left_semi")
    sets = written(gram_sets(picked, words).groupBy("doc_id").agg(F.min("grams").alias("grams")), "sets")
    released(some)

    # Global order: frequency among the candidates, then the hash, as one comparable number.
    # N-grams of one member alone come first in it and match nothing: only their number counts.
    # (48 bits of a hash are enough to count by: a clash only makes an n-gram seem less rare.)
    flat = sets.select("doc_id", F.explode(F.transform("grams", lambda g: g.bitwiseAND(F.lit((1 << 48) - 1)))).alias("gram"))
    often = flat.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    # (40 bits of the hash and the frequency name an n-gram here; the whole sets decide later.)
    code = F.expr("(least(df, 4194303) << 40) | (gram & 1099511627775)")
    ranked = flat.join(often, "gram").groupBy("doc_id").agg(F.sort_array(F.collect_list(code)).alias("common"))
    ranked = ranked.join(sets.select("doc_id", F.size("grams").alias("n")), "doc_id")
    keep = F.expr(f"CAST(1 + n - ceil(n * {similarity} / 100.0) AS INT) - (n - size(common))")
    prefix = ranked.withColumn("keep", keep).where("keep > 0")
    entries = prefix.select("doc_id", "n", "common", F.posexplode(F.expr("slice(common, 1, keep)")).alias("pos", "own"))
    entries = written(
        entries.select(
            F.col("own").alias("gram"), F.col("doc_id").alias("doc"), F.col("n").cast("long").alias("n"),
            (F.size("common") - F.col("pos") - 1).cast("long").alias("after"),
            F.expr(f"slice(common, pos + 2, {depth})").alias("path"),
            F.expr(f"slice(common, greatest(1, pos + 1 - {BEHIND}), least(pos, {BEHIND}))").alias("before"),
        ),
        "entries",
    )
    star = trie_join(entries.withColumn("component", F.col("doc")), similarity, hubs, block_rows)
    pairs = written(star, "star-pairs")
    links = written(linked(pairs, sets, similarity), "star-links")
    label = components(links).withColumnRenamed("id", "doc")

    labelled = entries.join(label, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    several = labelled.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = trie_join(labelled.join(several.select("gram"), "gram"), similarity, None, block_rows)
    more = written(rest.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    released(entries, pairs)
    label = components(links.union(linked(more, sets, similarity)))
    released(sets, links, more)

    return (
        sizes.join(label.withColumnRenamed("id", "member"), "member", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "member", "doc_id").alias("component_id"))
    )
