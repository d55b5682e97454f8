"""Packing by a configuration linear program over the length histogram.

Texts become token ids once, in tasks, and are cut into pieces only where they
exceed a sequence.  The driver sees one number per piece length (at most
``size``): it solves the configuration program (a configuration is a multiset
of lengths that fit one sequence) by multiplicative weights, where the knapsack
dynamic programme prices the next configuration, rounds the multiplicities,
repeats that on what is left, and packs the last few pieces best fit first.
The plan says, for every length, which ranks go to which sequence and offset;
its size depends on ``size`` and the number of rounds, not on the data.  Pieces
get their rank within their length by counts per hash bucket, so that a length
shared by a third of all pieces is spread over the cluster.

Null text counts as empty: its piece is the separator alone.  Rows with equal
ids are packed each on their own.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import partitions, stored, table, whole
from tallyline.llm.token_fst import vocabulary_path

SIZE = 2048
CACHE = 200_000
BLOCK = 1 << 22
#: Words that are given to the library together, and how vocabulary entries mark the end of a word.
ROW = 256
WORD_END = "</w>"


class Encoder:
    """Token ids of texts as bytes (unsigned 32 bits, little-endian), by the vocabulary's own library.

    The vocabulary drops white space and no token spans it, so that the ids of
    a text are those of its words; words seen lately are kept.  New words go to
    the library in rows of several, and are told apart by the bytes that their
    tokens cover; words of a row that does not come out even, and those that
    may hold special tokens, are given to it one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(entries.values()) + 1, np.int64)
        for entry, i in entries.items():
            self.sizes[i] = len(entry.removesuffix(WORD_END))
        self.fresh: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _one_by_one(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.fresh.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, found))

    def _learn(self, words: list[bytes]) -> None:
        alone = [w for w in words if b"<|" in w]
        plain = [w for w in words if b"<|" not in w] if alone else words
        rows = [plain[i : i + ROW] for i in range(0, len(plain), ROW)]
        found = self.tokenizer.encode_batch_fast([b" ".join(row).decode() for row in rows], add_special_tokens=False)
        for row, e in zip(rows, found):
            ids = np.array(e.ids, "<u4")
            covered = np.cumsum(self.sizes[ids])
            ends = np.cumsum(np.fromiter(map(len, row), np.int64, len(row)))
            at = np.searchsorted(covered, ends)
            if len(ids) == 0 or at[-1] != len(ids) - 1 or (covered[at] != ends).any():
                alone += row
                continue
            data, low = ids.tobytes(), 0
            for word, high in zip(row, (4 * at + 4).tolist()):
                self.fresh[word] = data[low:high]
                low = high
        self._one_by_one(alone)

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BLOCK):
                size += len(texts[stop])
                stop += 1
            words = [t.split() for t in texts[start:stop]]  # of bytes: at ASCII white space alone
            if len(self.fresh) > CACHE:
                self.old, self.fresh = self.fresh, {}
            unseen = set().union(*words).difference(self.fresh)
            known = unseen.intersection(self.old)
            self.fresh.update(zip(known, map(self.old.__getitem__, known)))
            self._learn(list(unseen.difference(known)))
            for ws in words:
                yield b"".join(map(self.fresh.__getitem__, ws))
            start = stop


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


PIECE = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, vocabulary: str | None = None, separator: int = 0) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: each text's ids and the separator, cut every ``size`` ids."""
    path = vocabulary or vocabulary_path()
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for i, ids in enumerate(encode(b.column("text").cast(pa.binary()).to_pylist())):
                ids += end
                for n, start in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[start : start + 4 * size]
                    rows.append((n, start // 4, len(part) // 4, zlib.crc32(part)))
                    at.append(i)
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 4, PIECE)]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int64())), *arrays], names=[id_col, *PIECE.names])

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['id']}, piece int, start bigint, length bigint, ids_crc32 bigint")


Config = tuple[tuple[int, int], ...]


def _price(values: np.ndarray, rooms: int) -> np.ndarray:
    """The knapsack dynamic programme: copies of each length class (class i takes i + 1 units) that are worth most in ``rooms`` units."""
    best = np.zeros(rooms + 1)
    pick = np.full(rooms + 1, -1)
    for room in range(1, rooms + 1):
        fit = min(room, len(values))
        gain = values[:fit] + best[room - fit : room][::-1]
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], pick[room] = gain[i], i
        else:
            best[room] = best[room - 1]
    copies = np.zeros(len(values), np.int64)
    room = rooms
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            copies[pick[room]] += 1
            room -= pick[room] + 1
    return copies


def fractional(counts: np.ndarray, rooms: int, rounds: int, rate: float) -> dict[Config, float]:
    """The configuration program by multiplicative weights: configurations of length classes, and how often to use each.

    Every class's price falls by ``exp(-rate)`` each time that a step covers
    it once; the sum of all steps, scaled, covers the counts.
    """
    there = counts > 0
    values = np.where(there, np.arange(1, len(counts) + 1) / rooms, 0.0)
    covered = np.zeros(len(counts))
    chosen: dict[Config, float] = {}
    for _ in range(rounds):
        copies = _price(values, rooms)
        index = np.flatnonzero(copies)
        step = float((counts[index] / copies[index]).min())
        config = tuple((int(i), int(copies[i])) for i in index)
        chosen[config] = chosen.get(config, 0.0) + step
        share = copies[index] * step / counts[index]
        covered[index] += share
        values[index] *= np.exp(-rate * share)
        if not covered[there].min() < 3 / rate:
            break
    scale = 1.0 / max(float(np.average(covered[there], weights=counts[there])), 1e-9)
    return {c: x * scale for c, x in chosen.items()}


def plan(histogram: dict[int, int], size: int = SIZE, **settings) -> list[tuple[Config, int]]:
    """The best of a few programs, which differ in how short a piece must be to be kept for filling gaps."""
    plans = [planned(histogram, size, size // part, **settings) for part in (64, 16, 8, 6, 4, 3)]
    return min(plans, key=lambda p: sum(times for _, times in p))


def planned(histogram: dict[int, int], size: int, small: int, classes: int = 128, rounds: int = 4000, rate: float = 0.1) -> list[tuple[Config, int]]:
    """Configurations as ((length, copies), ...) with their multiplicity; together they hold exactly the histogram.

    Lengths are grouped into ``classes`` for the program, rounded up; rounded
    multiplicities are then filled with the true lengths of each class.  What
    is left, and all pieces up to ``small``, is packed best fit into the room
    that this leaves.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[Config, int]] = []
    if size in left:
        out.append((((size, 1),), left.pop(size)))
    if not left:
        return out
    unit = max(1, -(-size // classes))
    rooms = size // unit
    descending = sorted(left, reverse=True)
    pools: list[list[int]] = [[] for _ in range(rooms)]  # the lengths of each class
    for length in descending:
        if small < length <= rooms * unit:
            pools[-(-length // unit) - 1].append(length)
    counts = np.array([sum(left[n] for n in p) for p in pools])
    placed: list[tuple[Config, int]] = []
    if counts.sum() >= 4 * classes:
        program = fractional(counts, rooms, rounds, rate)
        for config, x in sorted(program.items(), key=lambda e: (-e[1], e[0])):
            times = round(x)
            while times > 0:
                held = [sum(left[n] for n in pools[i]) // c for i, c in config]
                times = min(times, *held)
                if times <= 0:
                    break
                exact: dict[int, int] = {}
                for i, c in reversed(config):  # the longest lengths first; a copy count may span several
                    for length in pools[i]:
                        take = min(c, left[length] - exact.get(length, 0))
                        if take > 0:
                            exact[length] = exact.get(length, 0) + take
                            c -= take
                        if not c:
                            break
                last = min(exact)  # the shortest makes place for the longest that fits
                exact[last] -= 1
                room = size - sum(n * c for n, c in exact.items())
                last = next(n for n in descending[bisect_left(descending, -room, key=lambda n: -n) :] if left[n] > exact.get(n, 0))
                exact[last] = exact.get(last, 0) + 1
                exact = {n: c for n, c in exact.items() if c}
                many = min(times, *(left[n] // c for n, c in exact.items()))
                for n, c in exact.items():
                    left[n] -= c * many
                placed.append((tuple(sorted(exact.items(), reverse=True)), many))
                times -= many
    return out + best_fit(left, size, placed)


def best_fit(histogram: dict[int, int], size: int, placed: list[tuple[Config, int]] = ()) -> list[tuple[Config, int]]:
    """Best fit in decreasing order, into sequences that may hold something; sequences filled alike move together."""
    open_: list[dict[Config, int]] = [{} for _ in range(size + 1)]  # by free room: contents and how many
    for content, times in placed:
        target = open_[size - sum(n * c for n, c in content)]
        target[content] = target.get(content, 0) + times
    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        room = length
        while count:
            while room < size and not open_[room]:
                room += 1
            if room >= size:
                each = min(size // length, count)
                times = count // each
                content: Config = ()
                free = size
            else:
                content, many = open_[room].popitem()
                each = min(room // length, count)
                times = min(many, count // each)
                if many > times:
                    open_[room][content] = many - times
                free = room
            content = (*content, (length, each))
            target = open_[free - length * each]
            target[content] = target.get(content, 0) + times
            count -= times * each
            room = min(room, max(length, free - length * each))
    return [(content, times) for level in open_ for content, times in level.items()]


class Layout:
    """Where each rank of each length goes."""

    def __init__(self, configs: list[tuple[Config, int]]):
        spans: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: dict[int, int] = {}
        base = 0
        for content, times in configs:
            offset = 0
            for length, copies in content:
                at = ranks.get(length, 0)
                spans.setdefault(length, []).append((at, base, times, offset))
                ranks[length] = at + copies * times
                offset += length * copies
            base += times
        self.sequences = base
        self.spans = {n: np.array(rows, np.int64) for n, rows in spans.items()}

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        borders = np.flatnonzero(np.diff(lengths[order])) + 1
        for rows in np.split(order, borders) if len(order) else ():
            length = int(lengths[rows[0]])
            spans = self.spans[length]
            span = spans[np.searchsorted(spans[:, 0], ranks[rows], side="right") - 1]
            within = ranks[rows] - span[:, 0]
            sequence[rows] = span[:, 1] + within % span[:, 2]
            offset[rows] = span[:, 3] + within // span[:, 2] * length
        return sequence, offset


def ranked(cut: DataFrame, id_col: str) -> DataFrame:
    """Rows numbered from 0 within their length, without gathering a length in one task."""
    buckets = partitions(cut.sparkSession)
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "ids_crc32")
    return (
        rows.withColumn("within", F.row_number().over(order) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("within"))
        .drop("bucket", "before", "within")
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, vocabulary: str | None = None) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece."""
    cut = stored(pieces(docs, id_col, text_col, size, vocabulary), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    layout = Layout(plan(histogram, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = layout.place(b.column("length").to_numpy(), b.column("rank").to_numpy())
            kept = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    rows = ranked(cut, id_col).select(id_col, "piece", "start", "length", "ids_crc32", "rank")
    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return pack(docs)
