"""Alignment of two tokenizers by inverted pair bitmaps.

Both tokenizers cut the bytes of one text.  Places where tokens of both end cut
them into groups; tokens whose bytes overlap are linked.  How many documents of
the corpus hold a pair of ids linked says how usual the link is.

Tasks invert their documents: chunks of up to 65,536 documents have, for every
pair of ids, the set of those documents.  It is kept as bitmaps, one plane per
binary digit of how often a document holds the link, each an array of 16-bit
numbers or, where that is larger, one bit per document.  The bitmaps of a
chunk's batches are merged; the planes of a pair ORed give its documents, the
weighted bits its links.  Chunks share no document, so their counts add up:
chunks send (pair, documents, links) once, in parts chosen by hash, and get the
corpus-wide numbers back in the same order.  The postings then return the
scores to the documents.  Bitmaps never leave their chunk.

Texts that are null or empty, or that one of the tokenizers does not give back
byte by byte, have no tokens: zeros and an empty string.  Every row counts as a
document, also where ids repeat.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import Workspace, partitions, table, whole
from tallyline.llm.token_fst import vocabulary_path
from tallyline.llm.word_blocks import batch, mix, split

CHUNK = 1 << 16
#: Postings of a chunk, and characters of texts that are looked at together.
POSTINGS = 1 << 20
CHARS = 1 << 21
#: Parts of texts whose alignment a task remembers.
PARTS = 1 << 17
#: Parts that are put side by side for the tokenizers, and learnt together.
ROW, LEARN = 64, 16_384
#: A space that no visible character follows.
RUN = re.compile(r" (?:\s|\Z)|^\s")

INVERTED_DDL = (
    "kind string, chunk bigint, part int, pairs binary, documents binary, links binary, planes array<struct<which: binary, sizes: binary, arrays: binary, bits: binary>>, "
    "size int, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
)
PLANE = pa.struct([("which", pa.binary()), ("sizes", pa.binary()), ("arrays", pa.binary()), ("bits", pa.binary())])
INVERTED = pa.schema([
    ("kind", pa.string()), ("chunk", pa.int64()), ("part", pa.int32()), ("pairs", pa.binary()), ("documents", pa.binary()), ("links", pa.binary()),
    ("planes", pa.list_(PLANE)), ("size", pa.int32()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()),
])
TOTALS_DDL = "chunk bigint, part int, counts binary, a int, b int, documents bigint, links bigint"
TOTALS = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("documents", pa.int64()), ("links", pa.int64())])


# -- the two tokenizers ------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Ids of a text by both vocabularies, and the bytes of every id."""

    def __init__(self, first: str, second: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(first), SentencePieceProcessor(model_file=second)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = _byte_letters()
        entries = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letters[c] for c in entries[i]) if set(entries.get(i, "\0")) <= letters.keys() else entries.get(i, "").encode() for i in range(max(entries) + 1)]
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        n = len(self.a_bytes)
        self.written = [b"%d%s" % (i, end) for i in range(n) for end in (b",", b"|")] + [b"%d%s" % (i, end) for i in range(len(self.b_bytes)) for end in (b",", b";")]

        self.written_sizes = np.array([len(x) for x in self.written], np.int64)

    def encode(self, texts: list[str]) -> list[Ids]:
        """Ids of every text, which begins with the space that comes before it, by both vocabularies."""
        first = self.a.encode_batch_fast(texts, add_special_tokens=False)
        second = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [_flat(e.ids for e in first), _flat(second)]

    def fitting(self, texts: list[str], ids: list[Ids]) -> np.ndarray:
        """Which texts come back byte by byte from both."""
        data = [t.encode() for t in texts]
        want = np.cumsum([len(d) for d in data])
        good = np.ones(len(texts), bool)
        for (flat, counts), table, sizes in zip(ids, (self.a_bytes, self.b_bytes), self.sizes):
            got = np.append(0, np.cumsum(sizes[flat]))[np.cumsum(counts)]
            whole = b"".join(map(table.__getitem__, flat.tolist()))
            if (got == want).all() and whole == b"".join(data):
                continue
            low = 0
            for i, high in enumerate(got.tolist()):
                good[i] &= whole[low:high] == data[i]
                low = high
        return good


Ids = tuple[np.ndarray, np.ndarray]


def _flat(lists) -> Ids:
    """Lists of ids as one array, and the length of each."""
    lists = list(lists)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def _only(ids: Ids, good: np.ndarray) -> Ids:
    flat, counts = ids
    return flat[np.repeat(good, counts)], np.where(good, counts, 0)


@lru_cache(maxsize=1)
def parts_of(first: str, second: str) -> Parts:
    return Parts(tokenizers(first, second))


@lru_cache(maxsize=1)
def tokenizers(first: str, second: str) -> Tokenizers:
    return Tokenizers(first, second)


# -- groups and links ---------------------------------------------------------


def aligned(t: Tokenizers, ids: list[Ids]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """For texts side by side: ``n_a, n_b, n_groups, n_links`` of each, its groups as written; the text and the pair of every link."""
    (a, count_a), (b, count_b) = ids
    n, end_a, end_b = len(t.b_bytes), np.cumsum(t.sizes[0][a]), np.cumsum(t.sizes[1][b])
    size = int(end_a[-1]) if len(end_a) else 0
    ends = np.zeros((2, size + 1), bool)
    ends[0, end_a], ends[1, end_b] = True, True
    cuts = np.flatnonzero(ends.any(0))  # each stretch between two cuts is one link
    at = ends[:, cuts]
    before_a, before_b = np.cumsum(at, 1) - at
    pair = a[before_a] * n + b[before_b]
    both = at.all(0)
    text = np.repeat(np.arange(len(count_a)), count_a)[before_a]
    group = np.cumsum(both) - both
    groups = np.bincount(text[both], minlength=len(count_a))
    links = np.bincount(text, minlength=len(count_a))
    # the order of writing: in each group its ids of the first, then those of the second vocabulary
    upto_a, upto_b = np.cumsum(at, 1)[:, both]
    of_a, of_b = (group[np.searchsorted(cuts, e)] for e in (end_a, end_b))
    written = np.empty(len(a) + len(b), np.int64)
    written[np.arange(len(a)) + np.append(0, upto_b)[of_a]] = 2 * a + ends[1, end_a]
    if len(b):
        written[np.arange(len(b)) + upto_a[of_b]] = 2 * len(t.a_bytes) + 2 * b + ends[0, end_b]
    all_written = b"".join(map(t.written.__getitem__, written.tolist()))
    stops = np.append(0, np.cumsum(t.written_sizes[written]))[np.cumsum(count_a + count_b)].tolist()
    groups_of = [all_written[low : high - 1] if high > low else b"" for low, high in zip([0, *stops], stops)]
    return np.stack([count_a, count_b, groups, links]), groups_of, text, pair


class Parts:
    """Alignments of texts from those of their parts, which are kept.

    No token of either vocabulary goes over a space that a visible character
    follows: the first takes its words with the space before them, and in the
    second it only stands at the start of pieces (whole texts are taken where a
    vocabulary has others).  So a text is cut before those spaces, and every
    part that was seen is aligned once.
    """

    def __init__(self, t: Tokenizers):
        self.t = t
        self.cut = not any("▁" in t.b.id_to_piece(i).lstrip("▁") for i in range(t.b.get_piece_size()))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.numbers = np.empty((4, 0), np.int64)
        self.written: list[bytes] = []
        self.pairs = np.empty(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.good = np.empty(0, bool)

    def _ids(self, new: list[str]) -> tuple[list[Ids], np.ndarray]:
        """Ids of parts, and which fit.  Parts are put side by side where the vocabularies cut them apart again; a row of parts that does not fit is taken one by one."""
        if not self.cut or any(RUN.search(x, 1) for x in new):
            ids = self.t.encode(new)
            return ids, self.t.fitting(new, ids)
        rows = ["".join(new[i : i + ROW]) for i in range(0, len(new), ROW)]
        ids = self.t.encode(rows)
        if not self.t.fitting(rows, ids).all():
            ids = self.t.encode(new)
            return ids, self.t.fitting(new, ids)
        ends = np.cumsum([len(x.encode()) for x in new])
        out = []
        for (flat, _), sizes in zip(ids, self.t.sizes):
            upto = np.searchsorted(np.cumsum(sizes[flat]), ends, "right")
            out.append((flat, np.diff(upto, prepend=0)))
        return out, np.ones(len(new), bool)

    def _learn(self, new: list[str]) -> None:
        odd = [x for x in new if not self.cut or RUN.search(x, 1)]
        plain = [x for x in new if self.cut and not RUN.search(x, 1)] if odd else new
        for some in [plain[i : i + LEARN] for i in range(0, len(plain), LEARN)] + [odd[i : i + LEARN] for i in range(0, len(odd), LEARN)]:
            ids, good = self._ids(some)
            numbers, written, _, pair = aligned(self.t, [_only(x, good) for x in ids])
            self.place.update(zip(some, range(len(self.place), len(self.place) + len(some))))
            self.numbers = np.concatenate([self.numbers, numbers], 1)
            self.written += written
            self.pairs = np.append(self.pairs, pair)
            self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(numbers[3]))
            self.good = np.append(self.good, good)

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """``(n_a, n_b, n_groups, n_links, groups_sha256)`` of each text; text, pair and how often of its links (a pair may come from several parts)."""
        parts = [[] if not x else [" " + x] if not self.cut or RUN.search(x) else list(map(" ".__add__, x.split(" "))) for x in texts]
        seen = set().union(*parts)
        new = [p for p in seen if p not in self.place]
        if len(self.place) + len(new) > PARTS and self.place:
            self.clear()  # before they are learnt, so that a task never holds more than PARTS, or the parts of one step
            new = list(seen)
        self._learn(new)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        text = np.repeat(np.arange(len(parts)), counts)
        bad = np.bincount(text, ~self.good[flat], len(parts)) > 0
        keep = ~bad[text]
        text, flat = text[keep], flat[keep]
        counts[bad] = 0
        totals = [np.bincount(text, n[flat], len(parts)).astype(np.int64) for n in self.numbers]
        stops = np.cumsum(counts)
        rows, low = [], 0
        for a, b, groups, links, high in zip(*(x.tolist() for x in totals), stops.tolist()):
            digest = hashlib.sha256(b";".join(map(self.written.__getitem__, flat[low:high].tolist()))).hexdigest() if a else ""
            rows.append((a, b, groups, links, digest))
            low = high
        part, times = np.unique(text << 32 | flat, return_counts=True)
        text, flat = part >> 32, part & 0xFFFFFFFF
        sizes = self.numbers[3][flat]
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[flat], sizes)
        return rows, np.repeat(text, sizes), self.pairs[at], np.repeat(times, sizes)


# -- bitmaps -------------------------------------------------------------------


def packed(sizes: np.ndarray, members: np.ndarray, width: int) -> tuple[bytes, bytes]:
    """Sets of numbers below ``width``: small ones as 16-bit numbers, the others as bits."""
    room = (width + 7) // 8
    dense = 2 * sizes > room
    of = np.repeat(dense, sizes)
    bits = np.zeros((int(dense.sum()), room), np.uint8)
    inside = members[of].astype(np.int64)
    np.bitwise_or.at(bits, (np.repeat(np.cumsum(dense) - 1, sizes)[of], inside >> 3), (128 >> (inside & 7)).astype(np.uint8))
    return members[~of].astype(np.uint16).tobytes(), bits.tobytes()


def unpacked(sizes: np.ndarray, arrays: bytes, bits: bytes, width: int) -> np.ndarray:
    """The members of all sets, set after set."""
    room = (width + 7) // 8
    dense = 2 * sizes > room
    of = np.repeat(dense, sizes)
    members = np.empty(len(of), np.int64)
    members[~of] = np.frombuffer(arrays, np.uint16)
    members[of] = np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8).reshape(-1, room), axis=1))[1]
    return members


def inverted(docs: DataFrame, first: str, second: str, parts: int) -> DataFrame:
    """Rows ``doc`` (a document's own numbers, ``size`` its place in the chunk), ``chunk`` (the bitmaps) and ``sent`` (pairs with counts, by part)."""
    names = INVERTED.names

    def row(**values) -> tuple:
        return tuple(values.get(n) for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = parts_of(first, second).align
        chunk, place, held, count = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush() -> pa.RecordBatch:
            key, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            pair, member = key >> 16, key & (CHUNK - 1)
            starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
            documents = np.diff(np.append(starts, len(pair)))
            pairs, which = pair[starts], np.repeat(np.arange(len(starts)), documents)
            links = np.zeros(len(starts), np.int64)
            planes = []
            for k in range(int(times.max(initial=0)).bit_length()):
                here = (times >> k & 1).astype(bool)
                sizes = np.bincount(which[here], minlength=len(starts))
                links += sizes << k  # weighted bits
                some = np.flatnonzero(sizes)
                arrays, bits = packed(sizes[some], member[here], place)
                planes.append((some.astype(np.int32).tobytes(), sizes[some].astype(np.int32).tobytes(), arrays, bits))
            planes = [dict(zip(("which", "sizes", "arrays", "bits"), p)) for p in planes]
            out = [row(kind="chunk", chunk=chunk, pairs=pairs.tobytes(), planes=planes, size=place)]
            for part, p in split((mix(pairs.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)):
                out.append(row(kind="sent", chunk=chunk, part=part, pairs=pairs[p].tobytes(), documents=documents[p].tobytes(), links=links[p].tobytes()))
            held.clear()
            return batch(INVERTED, out)

        for b in batches:
            ids, texts = b.column("id").to_pylist(), b.column("text").to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and place + high - low < CHUNK and (high == low or size + len(texts[high]) <= CHARS):
                    size += len(texts[high])
                    high += 1
                rows, text, pair, times = align(texts[low:high])
                key = pair << 16 | (place + text)
                order = np.argsort(key, kind="stable")
                key, times = key[order], times[order]
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
                key, times = key[starts], np.add.reduceat(times, starts) if len(starts) else times
                held.append((key, times))
                count += len(key)
                own = [row(kind="doc", chunk=chunk, size=place + i, id=id, n_a=r[0], n_b=r[1], n_groups=r[2], n_links=r[3], groups_sha256=r[4]) for i, (id, r) in enumerate(zip(ids[low:high], rows))]
                yield batch(INVERTED, own)
                place += high - low
                low = high
                if count >= POSTINGS or place == CHUNK:
                    yield flush()
                    chunk, place, count = chunk + 1, 0, 0
        if held:
            yield flush()

    return docs.mapInArrow(run, INVERTED_DDL)


def _totals(sent: DataFrame, n_b: int) -> DataFrame:
    """Corpus-wide numbers of every pair, and for each chunk those of the pairs that it sent."""

    def merge(rows: pa.Table) -> pa.Table:
        pair, documents, links = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.int64) for c in ("pairs", "documents", "links"))
        pairs, which = np.unique(pair, return_inverse=True)
        total, total_links = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        np.add.at(total, which, documents)
        np.add.at(total_links, which, links)
        part = rows.column("part")[0].as_py()
        cuts = np.cumsum([len(x) // 8 for x in rows.column("pairs").to_pylist()])[:-1]
        answers = [(chunk, part, x.tobytes(), None, None, None, None) for chunk, x in zip(rows.column("chunk").to_pylist(), np.split(total[which], cuts))]
        n = len(pairs)
        own = [pa.array((pairs // n_b).astype(np.int32)), pa.array((pairs % n_b).astype(np.int32)), pa.array(total), pa.array(total_links)]
        own = pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *own], schema=TOTALS)
        return pa.Table.from_batches([batch(TOTALS, answers), own])

    return sent.groupBy("part").applyInArrow(merge, TOTALS_DDL)


SCORED = pa.schema([("chunk", pa.int64()), ("size", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _scores(chunks: DataFrame, highest: np.ndarray, n_b: int, parts: int) -> DataFrame:
    """Scores that the postings return to the documents of their chunk; ``highest`` is the greatest count of each id of the first vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                chunk, pairs, planes, size, found = (b.column(c)[r].as_py() for c in ("chunk", "pairs", "planes", "size", "found"))
                pairs = np.frombuffer(pairs, np.int64)
                answer = {f["part"]: f["counts"] for f in found or ()}
                count = np.zeros(len(pairs), np.int64)
                for part, p in split((mix(pairs.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)):
                    count[p] = np.frombuffer(answer[part], np.int64)
                best = count == highest[pairs // n_b]
                sums, bests = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for k, plane in enumerate(planes):
                    sizes = np.frombuffer(plane["sizes"], np.int32).astype(np.int64)
                    members = unpacked(sizes, plane["arrays"], plane["bits"], size)
                    of = np.repeat(np.frombuffer(plane["which"], np.int32), sizes)
                    np.add.at(sums, members, count[of] << k)
                    np.add.at(bests, members, best[of].astype(np.int64) << k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, chunk)), pa.array(np.arange(size, dtype=np.int32)), pa.array(bests), pa.array(sums)], schema=SCORED)

    return chunks.mapInArrow(run, "chunk bigint, size int, n_best bigint, count_sum bigint")


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str | None = None, second: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables: a row per document, and ``(a, b, documents, links)`` of every linked pair of ids."""
    first, second = first or vocabulary_path("byte_bpe_50k.json"), second or vocabulary_path("piece_bpe_32k.model")
    spark = docs.sparkSession
    work = Workspace(spark, "pairs")
    parts = partitions(spark)
    t = tokenizers(first, second)
    n_a, n_b = len(t.a_bytes), len(t.b_bytes)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), whole(text_col).alias("text"))
    held = work.write(inverted(rows, first, second, parts), "inverted")
    totals = work.write(_totals(held.filter("kind = 'sent'").select("chunk", "part", "pairs", "documents", "links"), n_b), "totals")
    pairs = totals.filter("a IS NOT NULL").select("a", "b", "documents", "links")
    highest = np.zeros(n_a, np.int64)
    for a, most in pairs.groupBy("a").agg(F.max("documents")).collect():  # one row per id of the vocabulary at most
        highest[a] = most
    found = totals.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("part", "counts")).alias("found"))
    chunks = held.filter("kind = 'chunk'").select("chunk", "pairs", "planes", "size").join(found, "chunk", "left")
    scores = _scores(chunks, highest, n_b, parts)
    own = held.filter("kind = 'doc'").select("chunk", "size", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    out = own.join(scores, ["chunk", "size"])
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), pairs


def op12_pair_bitmaps(spark, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies meet in every document, and how usual their links are in the corpus."""
    return alignment(table(spark, sf_dir, "documents"))[0]
