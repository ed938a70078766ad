"""Packing: ids as the tokenizer library gives them, every id once, limits kept."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from gridloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(3)
    letters = "abcDEéÉßñçΣσÎİıё日 \n\t\r.,:;!?|'<>0123 \x1c　é😀"
    fixed = ["", " ", "it's a.", "<|endoftext|> x<|startoftext|>.", "a" * 300, "The the THE. the, the!", "l'été. d'ÉTÉ", "x'. 's. 12. 1.2.", "!. a!."]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(300)]


def test_ids_are_the_library_s():
    tokenizers = pytest.importorskip("tokenizers")
    library, rows = tokenizers.Tokenizer.from_file(PATH), texts()
    encode = packing.word_encoder(PATH, end=1, remembered=500)()
    for at in range(0, len(rows), 9):
        for text, ids in zip(rows[at : at + 9], encode(rows[at : at + 9])):
            assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)


@pytest.mark.parametrize("limits", [(64, 5, 64), (64, 64, 20), (32, 1, 32)])
def test_every_token_once_within_the_limits(limits):
    rng = random.Random(4)
    tokens = np.array([rng.choice([0, 1, 2, 5, 17, 40, 64, 65, 500]) for _ in range(300)])
    loss = np.array([rng.randint(0, t) for t in tokens])
    seen = {}
    for sequence in packing.pack(tokens, loss, limits):
        assert sum(n for *_, n in sequence) <= limits[0] and len(sequence) <= limits[1]
        bearing = 0
        for e, start, n in sequence:
            assert n > 0
            seen.setdefault(e, []).append((start, n))
            bearing += max(0, start + n - max(start, tokens[e] - loss[e]))
        assert bearing <= limits[2]
        for part in packing.without_padding(sequence, limits[0]):
            total = sum(n for *_, n in part)
            assert total == limits[0] or total & (total - 1) == 0
    for e, t in enumerate(tokens):
        at = 0
        for start, n in sorted(seen.get(e, [])):
            assert start == at
            at += n
        assert at == t


def test_table(spark):
    rows = [(1, "a b c " * 700, 2), (1, "a b c " * 700, 2), (2, None, None), (3, "", 5), (None, "x. y", 0)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, prompt int, length string")
    for prompt in (None, "prompt"):
        out = packing.pack_documents(df, packing.word_encoder(PATH, end=1), (256, 8, 200), prompt).collect()
        encode = packing.word_encoder(PATH, end=1)()
        full = {(k, len(i)): i for (k, *_), i in zip(rows, encode([t or "" for _, t, _ in rows]))}
        assert sum(r.length for r in out) == sum(len(i) for i in encode([t or "" for _, t, _ in rows]))
        offsets = {}
        for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
            assert offsets.get(r.sequence_id, 0) == r.offset
            offsets[r.sequence_id] = r.offset + r.length
            part = full[r.doc_id, r.doc_tokens][r.start : r.start + r.length]
            assert zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32
        assert all(n == 256 or n & (n - 1) == 0 for n in offsets.values())
    assert packing.pack_documents(df.limit(0), packing.word_encoder(PATH, end=1), (256, 8, 200)).count() == 0
