"""The filter audit against running every order one after the other."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from gridloom.llm import audit

WORD = re.compile("[^\x20\x09-\x0d]+")


def fails(rows):
    out = []
    for key, source, text in rows:
        t = text or ""
        words = WORD.findall(t)
        out.append({c for c, hit in {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": re.search("[#$%&*|]", t) is not None,
            "E": key is not None and any(k is not None and k < key and (x or "") == t for k, _, x in rows),
        }.items() if hit})
    return out


def run_all_orders(parts, failed, good, toxic, letters):
    """(part, order, step) -> the seven counts, by filtering again for each order."""
    out = {}
    for part in set(parts):
        own = [i for i, p in enumerate(parts) if p == part]
        total = dict.fromkeys(letters, 0)
        for order in map("".join, permutations(letters)):
            left = own
            for step, c in enumerate(order, 1):
                gone = [i for i in left if c in failed[i]]
                left = [i for i in left if c not in failed[i]]
                total[c] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(c in failed[i] for i in own) - len(gone), sum(failed[i] == {c} for i in own),
                    sum(good[i] for i in gone), sum(toxic[i] for i in gone),
                ]
        for order in map("".join, permutations(letters)):
            for step, c in enumerate(order, 1):
                out[part, order, step].append(total[c])
    return out


def documents(n):
    rng = random.Random(n)
    words = [f"w{i}" for i in range(80)] + ["Big", "HUGE", "a#b", "é", "\x1cx"]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[2]
        else:
            few = words[: rng.choice([5, 60, 85])]
            text = rng.choice([" ", "\n", " \t"]).join(rng.choice(few) for _ in range(rng.randint(0, 90)))
        rows.append((i, rng.choice(["s1", "s2", None]), text))
    return rows + rows[:4] + [(2, "s9", rows[2][2]), (0, "s9", rows[5][2]), (None, "s1", rows[3][2]), (None, "s1", rows[3][2]), (n, None, None), (n + 1, "", "")]


def test_every_order_by_hand(spark):
    rows = documents(120)
    rng = random.Random(5)
    labels = [(k, rng.randint(0, 1), rng.randint(0, 1)) for k in range(0, 125, 2)] + [(4, 0, 0), (6, 1, 1), (None, 1, 1), (8, None, None)]
    marks = [{k for k, *v in labels if k is not None and v[j] == 1} for j in (0, 1)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, source string, text string, mask int, part string")
    given = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, n string")
    got = audit.path_audit(audit.document_counts(df.repartition(6), given)).collect()
    want = run_all_orders(
        [s or "" for _, s, _ in rows], fails(rows), *[[k in m for k, *_ in rows] for m in marks], "ABCDE")
    assert len(got) == len(want)
    for r in got:
        assert want[r.part, r.filter_order, r.step] == [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]


def test_own_filters(spark):
    rows = [(i % 2, i) for i in range(60)] + [(None, 3), (0, None)]
    df = spark.createDataFrame(rows, "p int, x int")
    filters = {"x": F.col("x") % 3 == 0, "y": F.col("x") > 40, "z": F.col("x") % 5 == 0}
    got = audit.path_audit(audit.mask_counts(df, filters, F.col("p"), F.col("x") == 3, F.lit(False)), "xyz").collect()
    failed = [set() if x is None else {c for c, hit in zip("xyz", (x % 3 == 0, x > 40, x % 5 == 0)) if hit} for _, x in rows]
    want = run_all_orders(["" if p is None else str(p) for p, _ in rows], failed, [x == 3 for _, x in rows], [0] * len(rows), "xyz")
    assert len(got) == len(want)
    for r in got:
        assert want[r.part, r.filter_order, r.step] == [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]


def test_empty_table_and_long_text(spark):
    schema, marks = "doc_id long, source string, text string", spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.path_audit(audit.document_counts(spark.createDataFrame([], schema), marks)).count() == 0
    one = spark.createDataFrame([(1, "s", "word " * 500_000)], schema)
    rows = audit.path_audit(audit.document_counts(one, marks)).where("filter_order = 'BACDE'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant) for r in rows] == [(0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_path_counts():
    forward, backward = audit.path_counts(5)
    assert forward[31] == backward[0] == 120 and sum(audit.edge_weights(5)) == 600
    with pytest.raises(ValueError):
        audit.path_audit(None, "AA")
