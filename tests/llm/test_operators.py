"""Small brute-force checks of the other operators, with nulls, empty texts, ties and repeats."""

import random
import zlib

import numpy as np
import pytest

from gridloom.llm import jaccard, passages, pii, quality, sharding, topk, urls

ODD = [(901, None), (902, ""), (903, " \n "), (904, "one"), (905, "one"), (906, "one two")]


def prose(seed, n=50):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words).upper()
        else:
            text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        rows.append((i, " ".join(text)))
    return rows + ODD


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()


@pytest.mark.parametrize("words,similarity", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_like_all_pairs(spark, words, similarity):
    rows = prose(words)
    sets = {}
    for key, text in rows:
        w = lower(text)
        sets[key] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    label = {k: k for k in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= similarity * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[k]] == label[k] for k in label):
            break
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], "doc_id long, text string, n int, gram string")
    got = jaccard.jaccard_classes(df, words, similarity, block_rows=4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == {k: (len(sets[k]), label[k]) for k in sets}


def test_jaccard_empty(spark):
    assert jaccard.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trie_bounds_lose_nothing():
    rng = random.Random(1)
    for _ in range(200):
        similarity, depth = rng.choice([50, 80, 90]), rng.choice([1, 3, 64])
        sets = [sorted(rng.sample(range(30), rng.randint(3, 20))) for _ in range(6)]
        trie = jaccard.Trie()
        for i, s in enumerate(sets[1:]):
            trie.insert(i + 1, len(s) + 1, len(s), tuple(s[:depth]))
        got = set(trie.probe(len(sets[0]) + 1, len(sets[0]), tuple(sets[0][:depth]), similarity))
        for i, s in enumerate(sets[1:], 1):
            both = 1 + len(set(s) & set(sets[0]))
            if 100 * both >= similarity * (len(s) + len(sets[0]) + 2 - both):
                assert i in got


def test_sharding(spark):
    rows = [(i, "é" * (i % 5)) for i in range(3000)] + [(7, "x"), (None, None)]
    tree = sharding.uniform_tree(24)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, slot int")
    out = sharding.shard_rows(df, tree).collect()
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((r.size, r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    moved = sum(r.grown_shard == 24 for r in out)
    assert 3000 / 25 * 0.6 < moved < 3000 / 25 * 1.5
    assert sharding.shard_rows(df.limit(0), tree).count() == 0


def test_topk_like_all_pairs(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.integers(-3, 4, 5).tolist()) for i in range(300)] + [(300, [1, 2]), (301, [2, 2]), (5, [9, 9, 9, 9, 9])]
    df = spark.createDataFrame([(i, v) for i, v in vectors], "id long, v array<long>")
    got = topk.nearest(df, df.where("id % 20 = 0"), k=7, shard_rows=64, query_rows=4, leaf_rows=8)
    want = []
    for q, v in vectors:
        if q % 20 == 0:
            scored = sorted((-int(np.dot(v, x)), i) for i, x in vectors if i != q and len(x) == len(v))[:7]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.nearest(df.limit(0), df.limit(0)).count() == 0


def test_url_links_carry_trust_and_distrust(spark):
    def link(*hosts):
        return "".join(f'<a href="https://{h}/">x</a>' for h in hosts) + '<a class=x href=/own>'

    pages = [
        (1, "http://good.com/a", link("near.org")), (2, "http://NEAR.org/a?b", link()), (3, "http://bad.net/es/x", link()),
        (4, "http://shady.org/x#y", link("bad.net", "bad.net")), (5, "http://alone.org", None), (6, None, "x"), (7, "no scheme", ""), (7, "no scheme", ""),
    ]
    rules = [("allow", "com", "/"), ("block", "net", "/es/")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(df, rules).collect()}
    assert got == {
        1: ("good.com", "/a", "com/", "allow"), 2: ("near.org", "/a", None, "allow"), 3: ("bad.net", "/es/x", "net/es/", "block"),
        4: ("shady.org", "/x", None, "block"), 5: ("alone.org", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
    }
    assert urls.judged(df.limit(0), rules).count() == 0


def test_quality_statistics(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a ", "b ", "a", "#", "é ", "\n", "Ü", "\t", "😀"]) for _ in range(rng.randint(0, 120)))) for i in range(80)] + ODD
    df = spark.createDataFrame([(k, t, 5) for k, t in rows], "doc_id long, text string, n_words int")
    for r in quality.judged(df, [quality.Rule((("symbol_share", ">", 0.1),))]).collect():
        text = dict(rows)[r.doc_id] or ""
        blank = "".join(map(chr, [0x20, *range(9, 14)]))
        words = [w for w in text.translate(str.maketrans(blank, " " * 6)).split(" ") if w]
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if x.strip(blank)]
        symbols = sum(c in "#*$%&|<>" for c in text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r.base_failed == failed and r.kept == (not failed and symbols / max(1, r.word_chars) <= 0.1)


def test_learned_list_separates():
    rng = random.Random(1)
    rows = [{f: rng.random() for f in quality.FEATURES} for _ in range(600)]
    for r in rows:
        r["quality"] = int(not (r["symbol_share"] > 0.7 or r["mean_word"] <= 0.2))
    rules = quality.learn(rows[:400])
    right = sum(any(x.covers(r) for x in rules) == (r["quality"] == 0) for r in rows[400:])
    assert right >= 190 and quality.learn([]) == []


def test_surrogates(spark):
    texts = [
        "Mail Ann.Lee@mail.example.com or ann.lee@mail.example.com now", "call +1 (017) 555-7713, +1 (017) 555-7714", "card 4845168114407329.",
        'token = "90803abcdef123456" password=b7db7aa4a5fcc78305 at 97.51.17.173', "Frau Müller met Mr. Иванова", "nothing here", None, "",
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts + texts[:1])], "doc_id long, text string, h int")
    got = {r.doc_id: r for r in pii.pseudonymised(df, "k").collect()}
    assert [got[i].text for i in (5, 6, 7)] == texts[5:] and got[0].text == got[8].text
    first = got[0].text.split()
    assert first[1].lower() == first[3] and first[1][0].isupper() and first[1] != "Ann.Lee@mail.example.com"
    assert got[1].n_replaced == 2 and got[1].text != texts[1] and len(got[1].text) == len(texts[1])
    for secret in ("4845168114407329", "90803abcdef123456", "b7db7aa4a5fcc78305", "97.51.17.173", "Müller", "Иванова", "7713"):
        assert all(secret not in (r.text or "") for r in got.values())
    assert pii.pseudonymised(df.limit(0), "k").count() == 0


def test_fuzzy_passages(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(words) for _ in range(80)]
    changed = [w if i % 12 else "new" for i, w in enumerate(passage)]
    del changed[30:32]
    other = lambda: [rng.choice(words) for _ in range(70)]
    rows = [(1, " ".join(other() + passage)), (2, " ".join(other() + changed + other())), (3, " ".join(other())), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    (r,) = passages.shared_passages(df, window=4).collect()
    assert (r.doc_id, r.of_doc) == (2, 1) and abs(r.start - 70) <= 2 and abs(r.stop - 148) <= 2
    kept = {x.doc_id: x.text for x in passages.without_passages(df, passages.shared_passages(df, window=4)).collect()}
    assert kept[1] == rows[0][1] and len(kept[2].split()) in range(138, 146) and kept[4] is None
    assert passages.shared_passages(df.limit(0)).count() == 0


def test_exact_passages_of_common_lines(spark):
    rng = random.Random(10)
    lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(10)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(30))) for i in range(600)]
    copies = {}
    for i in range(600, 630):
        of = rng.randrange(300, 600)
        at = rng.randrange(240)
        copied = rows[of][1].split()[at : at + 60]
        copies[i] = copied
        rows.append((i, " ".join([*(f"x{i}y{j}" for j in range(40)), *copied, *(f"z{i}y{j}" for j in range(40))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = df.select("doc_id", "text").toDF("doc", "text")
    matched, _ = passages.matches(texts)
    linked = {(r.a, r.b) for r in matched.where("b >= 600").select("a", "b").distinct().collect()}
    text = {i: " " + t + " " for i, t in rows}
    for i, copied in copies.items():
        for s in (0, 5, 10):
            run = " " + " ".join(copied[s : s + 50]) + " "
            assert any(run in text[a] for a, b in linked if b == i), (i, s)


@pytest.mark.parametrize("every,length,inserted", [(10, 55, True), (15, 60, True), (8, 80, True), (10, 55, False)])
def test_alignment_over_inserted_and_deleted_words(every, length, inserted):
    rng = random.Random(every * length)
    number = lambda n: np.array([rng.randrange(1, 1 << 30) for _ in range(n)])
    for trial in range(20):
        passage = number(length)
        a = np.concatenate([number(64), passage, number(64)])
        at = np.arange(trial % every, length, every)
        changed = np.insert(passage, at, number(len(at))) if inserted else np.delete(passage, at)
        b = np.concatenate([number(64), changed, number(64)])
        i = 25 + int(np.isin(changed[25:], passage).argmax())
        (x,) = np.flatnonzero(a == changed[i])
        agree, opposite = passages.aligned(a, b, np.array([x]), np.array([64 + i]), 1)
        assert agree.sum() >= np.isin(changed, passage).sum()
        assert (a[opposite[agree]] == b[agree]).all()
        assert passages.stretches(agree, min(50, len(changed) - 3), 80)
        if len(changed) >= 53:
            wide = [np.full((1, 64), -1, np.int16) for _ in range(4)]
            for cells, words in zip(wide, (a[:x][::-1], b[: 64 + i][::-1], a[x + 1 :], b[65 + i :])):
                cells[0, : min(64, len(words))] = (words % 256)[:64]
            left, right = passages._reach(wide[0], wide[1], 80), passages._reach(wide[2], wide[3], 80)
            assert passages._can(left, right, np.array([1]), 50, 80).all()
    far = np.concatenate([number(60), passage, number(60)])
    apart = np.concatenate([passage[:20], number(60), passage[20:]])
    got, _ = passages._gap(passage, apart, passages.BAND)
    assert got.sum() >= length and passages._gap(far, passage, passages.BAND)[0].sum() >= length


def test_registered_parameters_find_fuzzy_passages(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(20000)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    rows, planted = [], {}
    for i in range(90):
        length, kind = rng.randint(51, 60), i % 3
        passage = some(length)
        if kind == 0:
            changed = [rng.choice(words) if j % 6 == 5 and j < length - 1 else w for j, w in enumerate(passage)]
        elif kind == 1:
            at = set(rng.sample(range(1, length - 1), length // 5))
            changed = [rng.choice(words) if j in at else w for j, w in enumerate(passage)]
        else:
            changed = [x for j, w in enumerate(passage) for x in ([rng.choice(words), w] if j % 10 == 5 else [w])]
        planted[1000 + i] = (i, 70, 70 + len(changed), sum(w in passage for w in changed))
        rows += [(i, " ".join(some(70) + passage + some(70))), (1000 + i, " ".join(some(70) + changed + some(70)))]
    got = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.of_doc): r for r in got}
    for b, (a, start, stop, equal) in planted.items():
        r = found.get((b, a))
        assert r is not None, (b, a)
        assert r.stop - r.start >= 50 and 100 * r.agreeing >= 80 * (r.stop - r.start)
        assert abs(r.start - start) <= 6 and abs(r.stop - stop) <= 6


def test_stretches_like_brute_force():
    rng = random.Random(13)
    for _ in range(300):
        agree = np.array([rng.random() < rng.choice((0.5, 0.8, 0.9)) for _ in range(60)])
        sums = np.append(0, np.cumsum(agree))
        spans = [(s, e) for s in range(60) for e in range(s + 20, 61) if agree[s] and agree[e - 1] and 100 * (sums[e] - sums[s]) >= 80 * (e - s)]
        longest = passages._longest(agree, 20, 80)
        assert (longest is not None) == bool(spans)
        if spans:
            assert longest in spans and longest[1] - longest[0] == max(e - s for s, e in spans)
            assert passages.stretches(agree, 20, 80)
