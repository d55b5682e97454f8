"""Token alignment against a plain version, one link at a time."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyline.llm import pair_bitmaps as P

DDL = "doc_id bigint, text string, chunk string, size string, id string, pairs string"


def plain(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tables = P.tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))

    def spans(ids, table):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at += len(table[i])
        return out

    docs, counts = [], Counter()
    for key, text in rows:
        data = (" " + (text or "")).encode()
        a = spans(first.encode(data.decode(), add_special_tokens=False).ids, tables.a_bytes) if text else []
        b = spans(second.encode(text), tables.b_bytes) if text else []
        if any(b"".join(t[i] for _, _, i in side) != data for side, t in ((a, tables.a_bytes), (b, tables.b_bytes))):
            a, b = [], []
        links = [(i, j) for s, e, i in a for x, y, j in b if s < y and x < e]
        groups, low = [], 0
        for cut in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in (a, b)))
            low = cut
        docs.append((key, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        counts.update(set(links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    out = [(k, na, nb, ng, len(ls), sum(counts[x] == best[x[0]] for x in ls), sum(counts[x] for x in ls), h) for k, na, nb, ng, ls, h in docs]
    return sorted(out, key=str), counts, Counter(x for d in docs for x in d[4])


ROWS = [(1, "The quick brown fox."), (2, "The quick brown fox jumps over the lazy dog. " * 8), (3, None), (4, ""), (5, " "), (6, "  two  spaces\n\nand\tlines "), (7, "naïve café — ελληνικά 漢字 🙂"),
        (8, "<s> </s> <unk> <|endoftext|> <0x0A>"), (1, "The quick brown fox."), (None, "no id"), (9, "x\x00y ▁ z w"), (10, "a" * 3000), (11, "﻿mark ́ é"), (12, "don't DON'T 12345 ...")]


@pytest.mark.parametrize("parts", [1, 5])
def test_matches_plain_version(spark, parts):
    docs = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in ROWS], DDL).repartition(parts)
    documents, pairs = P.alignment(docs)
    want, counts, links = plain(ROWS)
    assert sorted(map(tuple, documents.collect()), key=str) == want
    assert {(r.a, r.b): (r.documents, r.links) for r in pairs.collect()} == {k: (n, links[k]) for k, n in counts.items()}


def test_chunks_that_are_full(monkeypatch):
    """A task that closes a chunk goes on with the next one."""
    import pyarrow as pa

    monkeypatch.setattr(P, "POSTINGS", 20)
    monkeypatch.setattr(P, "CHARS", 60)

    class Docs:
        def mapInArrow(self, run, ddl):
            return run

    monkeypatch.setattr(P.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))
    run = P.inverted(Docs(), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), 2)
    texts = [t or "" for _, t in ROWS]
    out = [r for b in run(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])])) for r in b.to_pylist()]
    docs = [(r["chunk"], r["size"], r["id"]) for r in out if r["kind"] == "doc"]
    assert [d[2] for d in docs] == list(range(len(texts))) and len({d[:2] for d in docs}) == len(texts) and len({d[0] for d in docs}) == 3
    assert {r["chunk"]: r["size"] for r in out if r["kind"] == "chunk"} == {c: 1 + max(s for x, s, _ in docs if x == c) for c, *_ in docs}


def test_bitmaps_round_trip():
    rng = random.Random(3)
    for width in (1, 9, 700):
        sets = [sorted(rng.sample(range(width), rng.randint(1, width))) for _ in range(40)] + [[width - 1]]
        sizes = np.array([len(s) for s in sets])
        arrays, bits = P.packed(sizes, np.array([x for s in sets for x in s]), width)
        assert P.unpacked(sizes, arrays, bits, width).tolist() == [x for s in sets for x in s]
        assert len(arrays) + len(bits) <= len(sets) * ((width + 7) // 8)


def test_empty_table(spark):
    documents, pairs = P.alignment(spark.createDataFrame([], DDL))
    assert documents.count() == 0 and pairs.count() == 0


def test_parts_give_what_whole_texts_give():
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    t, rng = P.tokenizers(*paths), random.Random(7)
    bits = ["word", "don't", "été", "漢字", "x1y2", "🙂", ".", "<s>", "\n", " ", "  ", "\t", "　", "\x85", "\xa0", "▁", "\x00", "'s", "12"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", " ", " ", ""]) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    rows, text, pair, times = P.Parts(t).align(texts)
    whole = [" " + x for x in texts]
    ids = t.encode(whole)
    good = t.fitting(whole, ids)
    numbers, written, of, pairs = P.aligned(t, [P._only(x, good) for x in ids])
    assert rows == [(*map(int, numbers[:, k]), hashlib.sha256(w).hexdigest() if numbers[0, k] else "") for k, w in enumerate(written)]
    got = Counter()
    for key, n in zip(zip(text.tolist(), pair.tolist()), times.tolist()):
        got[key] += n
    assert got == Counter(zip(of.tolist(), pairs.tolist()))
    assert good.any() and not good.all()


def test_a_task_holds_few_parts(monkeypatch):
    """Parts are forgotten before new ones would pass the limit; the numbers stay the same."""
    monkeypatch.setattr(P, "PARTS", 50)
    t = P.tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = [" ".join(f"word{i} common{i % 3}" for i in range(low, low + 20)) for low in range(0, 200, 20)]
    few, all_at_once = P.Parts(t), P.Parts(t)
    got, most = [], 0
    for x in texts:
        got += few.align([x])[0]
        most = max(most, len(few.place))
    assert most <= 50
    assert got == all_at_once.align(texts)[0]
