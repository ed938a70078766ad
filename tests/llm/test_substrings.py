"""Repeated bytes against a count of all strings."""

import hashlib
import random
from collections import Counter

from gridloom.llm import substrings


def brute(rows, length):
    count = Counter()
    for _, t in rows:
        d = (t or "").encode()
        count.update(d[i : i + length] for i in range(len(d) - length + 1))
    out = []
    for key, t in rows:
        d = (t or "").encode()
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def fixture(seed, n=60):
    rng = random.Random(seed)
    words = ["äb", "cd", "e", "fgh", "é", "ij", "klm"]
    parts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(parts)
            cut = rng.randint(0, len(p))
            text += rng.choice([p, p[cut:], p[:cut], str(rng.random())])
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, "ab" * 300), (n + 3, rows[3][1]), (n + 4, "x" * 40)]
    return rows


def test_like_counting_every_string(spark):
    for seed, length in ((1, 40), (2, 48), (3, 64)):
        rows = fixture(seed)
        df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, pos int")
        got = substrings.repeated_bytes(df, length=length, seed=12).collect()
        assert sorted(map(tuple, got)) == brute(rows, length)


def test_empty_table(spark):
    assert substrings.repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
