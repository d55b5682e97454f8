"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(in a document of smaller id, or earlier in its own).  In suffix order that is
the question whether a suffix shares ``length`` bytes with the previous or next
suffix of smaller position.  A suffix array over all bytes is not needed for
it: suffixes are first dealt out so that equal ones meet.

Every window of ``length`` bytes has an anchor, the leftmost of its 24-byte
strings with the least hash; equal windows have equal anchors.  Runs of windows
with one anchor make a row: the anchor's hash, a hash of the whole stretch, and
its place.  A stretch that occurred before (both hashes equal) is repeated
whole.  Only stretches with a known anchor and a new content are looked at byte
by byte: their contexts are sorted by anchor, and within each group the suffix
order of the windows gives the previous and next smaller positions.  Groups of
more than ``GROUP`` stretches are counted by the hash of each window instead,
which spreads them over the cluster and gives the same result.

Tasks first reduce their own repeats, so that a passage in a third of all
documents reaches the shuffle once per task.  Null text counts as empty.  Where
ids repeat or are null, rows count in order of id (nulls first) and text, each
as a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import partitions, stored, table, whole

LENGTH = 100
GRAM = 24
SEGMENT = 1 << 20
BLOCK = 1 << 21
HELD = 600_000
GROUP = 50_000
CONTEXTS = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of any substring of a byte array."""

    def __init__(self, letters: np.ndarray):
        n = len(letters)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[letters] * _powers(_BASE, max(n, 1))[:n], out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.back[start])


def stretches(parts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """For texts laid side by side: part, first and last window of each run with one anchor, anchor hash, stretch hash."""
    letters = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    none = np.empty(0, np.int64)
    if len(letters) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = Hashes(letters)
    at = np.arange(len(letters) - gram + 1)
    least = hashes.of(at, at + gram)
    anchor_hash = least
    place = at.astype(np.int32)
    # the leftmost least hash of every window, by doubling
    reach, width = 1, length - gram + 1
    while reach < width:
        step = min(reach, width - reach)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        reach += step
    part = np.repeat(np.arange(len(parts)), sizes)[: len(place)]
    valid = np.arange(len(place)) + length <= ends[part]
    p = np.flatnonzero(valid)
    if not len(p):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(p), bool)
    new[1:] = (place[p[1:]] != place[p[:-1]]) | (p[1:] != p[:-1] + 1) | (part[p[1:]] != part[p[:-1]])
    first = p[new]
    last = p[np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)]
    anchor = place[first].astype(np.int64)
    content = _mix(hashes.of(first, last + length) + (anchor - first).astype(np.uint64) * _BASE + (last - first).astype(np.uint64))
    return part[first], first - begins[part[first]], last - begins[part[first]], anchor_hash[anchor], content


def repeated_windows(contexts: list[bytes], order: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """Which windows of the contexts have an equal one of smaller position: (context, first, last window) ranges.

    ``order`` gives the contexts' positions (with ties broken).  Windows whose
    hash is single are no candidates; of the others, the suffix order is made
    by their bytes, and in every stretch of it that shares ``length`` bytes,
    all but the smallest position have an earlier match.
    """
    letters = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    windows = sizes - length + 1
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(contexts)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = begins[owner] + within
    value = Hashes(letters).of(start, start + length)
    by = np.argsort(value, kind="stable")
    same = value[by][1:] == value[by][:-1]
    several = np.zeros(len(by), bool)
    several[1:] |= same
    several[:-1] |= same
    chosen = by[several]
    if not len(chosen):
        return []
    position = order[owner[chosen]] * (int(windows.max()) + 1) + within[chosen]
    text = letters[start[chosen][:, None] + np.arange(length)]
    text = np.pad(text, ((0, 0), (0, -length % 8))).view(">u8")
    suffix = np.lexsort((position, *(text[:, c] for c in range(text.shape[1] - 1, -1, -1))))
    shares = (text[suffix][1:] == text[suffix][:-1]).all(1)  # with the suffix before
    repeated = np.sort(chosen[suffix[1:][shares]])  # sorted by position within a run, so its first is the smallest
    if not len(repeated):
        return []
    cut = np.ones(len(repeated), bool)
    cut[1:] = (repeated[1:] != repeated[:-1] + 1) | (owner[repeated[1:]] != owner[repeated[:-1]])
    firsts = np.flatnonzero(cut)
    lasts = np.append(firsts[1:] - 1, len(repeated) - 1)
    return list(zip(owner[repeated[firsts]].tolist(), within[repeated[firsts]].tolist(), within[repeated[lasts]].tolist()))


ROW = "anchor bigint, content bigint, own boolean, key bigint, low bigint, high bigint"


def _rows(docs: DataFrame, length: int) -> DataFrame:
    """A row per stretch; ``own`` marks those that repeat one of the same task, which nothing else needs to meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            key, low, high, anchor, content = (np.concatenate(x) for x in zip(*held))
            by = np.lexsort((low, key, content, anchor))
            key, low, high, anchor, content = (x[by] for x in (key, low, high, anchor, content))
            own = np.zeros(len(by), bool)
            own[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
            anchor = np.where(own, _mix(anchor + (key.astype(np.uint64) << np.uint64(20)) + low.astype(np.uint64)), anchor)
            held.clear()
            columns = (anchor.view(np.int64), content.view(np.int64), own, key, low, high)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "content", "own", "key", "low", "high"])

        def take(keys: list[int], offsets: list[int], parts: list[bytes]) -> int:
            part, low, high, anchor, content = stretches(parts, length)
            shift = np.array(offsets, np.int64)[part]
            held.append((np.array(keys, np.int64)[part], low + shift, high + shift, anchor, content))
            return len(part)

        for b in batches:
            keys, offsets, parts, size = [], [], [], 0
            for key, text in zip(b.column("key").to_pylist(), b.column("text")):
                data = text.as_py().encode()
                for at in range(0, max(1, len(data) - length + 1), SEGMENT):
                    parts.append(data[at : at + SEGMENT + length - 1])
                    keys.append(key)
                    offsets.append(at)
                    size += len(parts[-1])
                    if size >= BLOCK:
                        count += take(keys, offsets, parts)
                        keys, offsets, parts, size = [], [], [], 0
            if parts:
                count += take(keys, offsets, parts)
            if count >= HELD:
                yield flush()
                count = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, ROW)


def _classified(rows: DataFrame, group: int) -> DataFrame:
    """``(kind, anchor, key, low, high)``: W for a stretch seen before, M and H for one whose anchor has several contents."""
    by = Window.partitionBy("anchor").orderBy("content", "key", "low")
    contents = Window.partitionBy("anchor").orderBy("content")
    rows = rows.withColumn("again", F.col("own") | F.coalesce(F.lag("content").over(by) == F.col("content"), F.lit(False)))
    rows = rows.withColumn("nth", F.dense_rank().over(contents))
    rows = rows.withColumn("several", F.max("nth").over(Window.partitionBy("anchor")))
    kind = F.when(F.col("again"), "W").when(F.col("several") == 1, None).when(F.col("several") <= group, "M").otherwise("H")
    return rows.select(kind.alias("kind"), "anchor", "key", "low", "high").filter("kind IS NOT NULL")


def _with_text(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Documents and their ``marks`` as one array (no more than the document has stretches)."""
    lists = marks.groupBy(F.col("key").alias("of")).agg(F.collect_list(F.struct(*(c for c in marks.columns if c != "key"))).alias("marks"))
    return docs.join(lists, F.col("key") == F.col("of"), how).drop("of")


def _contexts(docs: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for key, text, found in zip(*(b.column(c) for c in ("key", "text", "marks"))):
                data, doc = text.as_py().encode(), key.as_py()
                out += [(m["anchor"], doc, m["low"], data[m["low"] : m["high"] + length]) for m in found.as_py()]
            columns = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["anchor", "key", "low", "context"])

    return _with_text(docs, marks.select("key", "anchor", "low", "high"), "inner").mapInArrow(run, "anchor bigint, key bigint, low bigint, context binary")


def _by_suffix_order(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows within groups of one anchor, some groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def solve(some: list[tuple]) -> pa.RecordBatch:
            rank = np.empty(len(some), np.int64)
            rank[sorted(range(len(some)), key=lambda i: some[i][1:3])] = np.arange(len(some))
            found = repeated_windows([r[3] for r in some], rank, length)
            out = [(some[i][1], some[i][2] + a, some[i][2] + b) for i, a, b in found]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 3)], names=["key", "low", "high"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("anchor", "key", "low", "context"))):
                if size >= CONTEXTS and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)

    dealt = contexts.repartition(partitions(contexts.sparkSession), "anchor").sortWithinPartitions("anchor", "key", "low")
    return dealt.mapInArrow(run, "key bigint, low bigint, high bigint")


def _by_window(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: the first place of every window by its hash, and all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, key, low, context in zip(*(b.column(c).to_pylist() for c in ("anchor", "key", "low", "context"))):
                n = len(context) - length + 1
                at = np.arange(n)
                value = Hashes(np.frombuffer(context, np.uint8)).of(at, at + length).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(value), pa.array(np.full(n, key)), pa.array(at + low)], names=["anchor", "value", "key", "at"])

    each = stored(contexts.mapInArrow(run, "anchor bigint, value bigint, key bigint, at bigint"), "windows")
    first = each.groupBy("anchor", "value").agg(F.min(F.struct("key", "at")).alias("first"))
    again = each.join(first, ["anchor", "value"]).filter(F.struct("key", "at") != F.col("first"))
    return again.select("key", F.col("at").alias("low"), F.col("at").alias("high"))


def _unique_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, text)``; where ids are no keys, the place in order of id and text is."""
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    if rows.groupBy("id").count().filter("count > 1 OR id IS NULL").isEmpty():
        return rows.select("id", F.col("id").cast("bigint").alias("key"), "text")
    return stored(rows.orderBy(F.col("id").asc_nulls_first(), "text").select("id", F.monotonically_increasing_id().alias("key"), "text"), "keyed")


def repeated(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``(key, low, high)``: ranges of windows that have an equal one earlier, of ``docs`` with ``key`` and ``text``."""
    marks = stored(_classified(_rows(docs.select("key", "text"), length), group), "stretches")
    out = marks.filter("kind = 'W'").select("key", "low", "high")
    plain = docs.select("key", "text")
    out = out.unionByName(_by_suffix_order(_contexts(plain, marks.filter("kind = 'M'"), length), length))
    large = marks.filter("kind = 'H'")
    if not large.isEmpty():
        out = out.unionByName(_by_window(_contexts(plain, large, length), length))
    return out


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, removed)`` of every row; ``removed`` holds the byte ranges."""
    keyed = _unique_keys(docs, id_col, text_col)
    ranges = repeated(keyed, length, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for text, marks in zip(b.column("text"), b.column("marks")):
                data = text.as_py().encode()
                spans: list[list[int]] = []
                for low, high in sorted((m["low"], m["high"]) for m in marks.as_py() or ()):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high + length)
                    else:
                        spans.append([low, high + length])
                kept, at = hashlib.sha256(), 0
                for low, high in spans:
                    kept.update(data[at:low])
                    at = high
                kept.update(data[at:])
                out.append((len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), spans))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            arrays = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *arrays], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    both = _with_text(keyed, ranges, "left").select("id", "text", "marks")
    return both.mapInArrow(run, f"`{id_col}` {dict(keyed.dtypes)['id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<array<bigint>>")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages of 100 bytes or more that occurred before."""
    return removed(table(spark, sf_dir, "documents")).drop("removed")
