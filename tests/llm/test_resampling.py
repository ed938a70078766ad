"""Importance resampling against a plain count in Python, with nulls, ties, repeats and long texts."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from gridloom.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(rows, target, percent, seed, least, runs, buckets):
    def features(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        out = [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in out]

    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log(((y + 1) * (sum(s) + buckets)) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    out = []
    for key, text in rows:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((n, key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = [(*r[1:], i + 1) for i, r in enumerate(able[: percent * len(able) // 100])]
    rest = [(*r[1:], None) for r in able[len(drawn) :]] + [(*r[1:], None) for r in out if r[0] < least]
    return sorted(map(repr, drawn + rest))


def corpus(n):
    rng = random.Random(n)
    words = ["Über", "naïve", "x1", "the", "日本語", "W" * 60, "w" * 49, "y" * 48, "a-b", "c's"] + [f"w{i}" for i in range(40)]
    rows = [(i, rng.choice([" ", "\n", "\x00", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    long = " ".join(rng.choice(words) for _ in range(300_000))
    return rows + rows[:7] + [(3, rows[9][1]), (None, rows[5][1]), (None, None), (n + 1, None), (n + 2, ""), (n + 3, "?!"), (n + 4, long)]


@pytest.mark.parametrize("runs,percent,pivots,least", [(1, 10, 32, 20), (3, 50, 2, 1), (2, 100, 1, 0), (1, 0, 4, 20)])
def test_like_plain_counts(spark, runs, percent, pivots, least):
    rows, target = corpus(150), ["the w1 w2 Über", None, "w1 w1 日本語"]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, rank int, _first string").repartition(5)
    goal = spark.createDataFrame([(t, 0) for t in target], "text string, bucket int")
    got = resampling.resampled(df, goal, percent, 7, least, runs, 97, pivots=pivots).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(rows, target, percent, 7, least, runs, 97)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    assert resampling.resampled(none, some).count() == 0
    got = resampling.resampled(some, none, percent=50, least_words=2, buckets=5).collect()
    assert sorted(r.rank or 0 for r in got) == [0, 1]


def test_crc_of_pieces():
    rng = random.Random(1)
    pieces = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 5, 47, 48, 49, 200, 3, 48]]
    data, ends = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([len(p) for p in pieces])
    before = np.array([zlib.crc32(b"pre")] * len(pieces), np.uint32)
    got = resampling.crc_after(before, data, ends - [len(p) for p in pieces], ends)
    assert got.tolist() == [zlib.crc32(b"pre" + p) for p in pieces]


@pytest.mark.parametrize("pivots", [1, 3, 32])
def test_kth_key_with_ties(spark, pivots):
    rng = random.Random(2)
    rows = [(rng.randint(-3, 3), rng.choice([5, 5, 5, 6])) for _ in range(400)] + [(0, 5)] * 300
    df, ordered = spark.createDataFrame(rows, "a long, b long"), sorted(rows)
    for k in (1, 2, 350, 699, 700):
        assert resampling.kth_key(df, ["a", "b"], k, pivots) == ordered[k - 1]
    assert resampling.kth_key(df, ["a", "b"], 701, pivots) is None
