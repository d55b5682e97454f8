"""Pieces against the library: ids, cuts, starts and checksums of every document."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a<|endoftext|>b c", "ǅ İstanbul ﬁ é 　x y\x1cz \x85", "\x00 a", "ß ẞ K Å 가 각", "<|startoftext|> x  y", "😀 ’s don't DON'T 'S", "", "   ", "\n\t x", "x" * 5000, "é́́ ñ Ñ", "<| |> <|"]


def texts(n=200):
    rng = random.Random(8)
    words = [*ODD, "Tree", "house.", "THE", "12,345", "naïve", "zzyzx"] + ["".join(rng.choice("abcéßxyz'.-İ") for _ in range(rng.randint(1, 12))) for _ in range(150)]
    return ODD + [rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(n)]


def test_ids_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 100)  # words are forgotten and learnt again
    monkeypatch.setattr(packing, "BLOCK", 5000)
    library, given = Tokenizer.from_file(PATH), texts()
    got = list(packing.Encoder(PATH).encode([t.encode() for t in given]))
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in given]


def test_pieces_hold_the_ids_in_order(spark):
    library, given = Tokenizer.from_file(PATH), texts(60)
    rows = list(enumerate(given)) + [(1000, None), (3, given[3]), (None, "no id")]
    got = packing.pieces(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), size=64).collect()
    want = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want.append((key, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
