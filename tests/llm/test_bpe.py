"""Encoding against the tiktoken library; decoding as an exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from gridloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    letters = "aábcdeeé  \n\t'stßñ日本語ж0129!?#$% 　😀\x1c"
    out = ["", " ", "   x  ", "a" * 3000, "<|endoftext|>", "it's we'll", "  \n\n  ab", "=" * 700, "0123456789" * 40]
    return out + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(200)]


def test_ids_are_the_library_s(library):
    c = bpe.Codec(bpe.Vocabulary.read(PATH), public_tokenizers.PATTERN, remembered=50)
    rows = texts()
    for at in range(0, len(rows), 7):
        for text, ids in zip(rows[at : at + 7], c.encode(rows[at : at + 7])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
            assert c.decode(ids) == text.encode()


def test_appends_and_edits_are_exact():
    v, rng = bpe.Vocabulary.read(PATH), random.Random(2)
    for _ in range(60):
        data = bytes(rng.choice(b"abcdeinorst") for _ in range(rng.randint(2, 60)))
        table = bpe.PrefixTable(v)
        for i in range(len(data)):
            table.append(data[i : i + 1])
        assert table.ids() == v.merged(data)
        assert [table.ids(n) for n in range(1, len(data))] == [v.merged(data[:n]) for n in range(1, len(data))]
        a = rng.randint(0, len(data))
        b = rng.randint(a, len(data))
        by = bytes(rng.choice(b"abcdeinorst") for _ in range(rng.randint(0, 6)))
        table.replace(a, b, by)
        assert table.data == data[:a] + by + data[b:]
        assert table.last == bpe.PrefixTable(v, table.data).last


def test_table(spark, library):
    rows = [(1, "to be or not to be", "x"), (1, "to be or not to be", "x"), (2, None, None), (None, "", "y"), (3, "é" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.digests(df, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for key, text, _ in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    whole = bpe.encoded(df, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(repr(bytes(r.decoded)) for r in whole) == sorted(repr((t or "").encode()) for _, t, _ in rows)
    assert bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
