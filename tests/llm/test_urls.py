"""URL rules and spread trust against brute force: longest rule, PageRank by a linear solve, far hosts."""

import random
import re

import numpy as np
import pytest

from gridloom.llm import urls

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def parts_by_hand(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]


def rule_by_hand(host, path):
    fits = [(len(h) + len(p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_longest_rule_by_brute_force(spark):
    rng = random.Random(5)
    hosts = ["com", "Example.COM", "www.example.com", "a.www.example.com", "example.net", "net", "x.net", "notexample.com", "org", "", "É.com"]
    paths = ["", "/", "/en/", "/en", "/EN/x", "/es/", "/fr/a?b=/es/", "/es#x", "?q=/en/", "#://y.com/en/", "/a://b.net/es/"]
    made = [rng.choice(["http://", "HTTPS://", "://", "a://", ""]) + h + p for h in hosts for p in paths] + [None, "", "mailto:x@y.com"]
    df = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(made)], "page_id long, url string, html string, host string")
    for r in urls.judged(df, RULES).collect():
        host, path = parts_by_hand(made[r.page_id])
        rule, verdict = rule_by_hand(host, path)
        # Without links every other host is judged by its own pages' rules alone.
        assert (r.host, r.path, r.rule) == (host, path, rule), made[r.page_id]
        assert verdict is None or r.verdict == verdict


def solved(size, edges, seeds, damping):
    """Scores by a linear solve; a host without links gives its score back to the seeds."""
    step = np.zeros((size, size))
    for src, dst, share in edges:
        step[dst, src] += share
    for host in set(range(size)) - {src for src, _, _ in edges}:
        step[:, host] = seeds
    return np.linalg.solve(np.eye(size) - damping * step, (1 - damping) * seeds)


@pytest.mark.parametrize("seed", [2])
def test_scores_by_a_linear_solve(spark, seed):
    rng = random.Random(seed)
    size, edges = 40, []
    for src in range(0, size, 1 + seed):
        to = rng.sample(range(size), rng.randint(1, 4))
        edges += [(src, dst, 1 / len(to)) for dst in to]
    seeds = np.zeros(size)
    seeds[[0, 3]] = 0.25, 0.75
    out = urls.spread(
        spark.createDataFrame([(f"h{a}", f"h{b}", s) for a, b, s in edges], "src string, dst string, share double"),
        spark.createDataFrame([("h0", 0.25), ("h3", 0.75)], "host string, seed double"),
        tolerance=1e-3,
    )
    got = {r.host: r.score for r in out.collect()}
    for host, score in enumerate(solved(size, edges, seeds, urls.DAMPING)):
        assert got.get(f"h{host}", 0.0) == pytest.approx(score, rel=1e-2, abs=1e-12)


def test_a_long_chain_to_a_blocked_host_is_blocked_whole(spark):
    """Distrust reaches hosts however far from the seed they are."""
    chain = [(i, f"http://h{i}.org/", f'<a href="http://h{i + 1}.org/">x</a>') for i in range(16)]
    rows = [*chain, (16, "http://h16.org/bad/", None), (17, "http://clean.org/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judged(df, [("block", "h16.org", "/bad/")]).collect()}
    assert got == {**{i: "block" for i in range(17)}, 17: "allow"}


def test_no_seeds_and_no_links(spark):
    edges = spark.createDataFrame([("a", "b", 1.0)], "src string, dst string, share double")
    none = spark.createDataFrame([], "host string, seed double")
    assert all(r.score == 0 for r in urls.spread(edges, none).collect())
    assert [(r.host, r.score) for r in urls.spread(edges.limit(0), none.union(spark.createDataFrame([("a", 1.0)], "host string, seed double"))).collect()] == [("a", 1.0)]
    with pytest.raises(ValueError):
        urls.spread(edges, none, tolerance=0)
