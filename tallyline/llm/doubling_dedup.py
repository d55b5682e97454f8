"""Removal of repeated passages of words by level-wise doubling.

A window is ``length`` consecutive words of one document.  A word goes if a
window that covers it also starts in a document of smaller id; windows are
judged on the input.  The lengths double: half of ``length``, ``length``,
twice that, and so on, and only windows that several documents hold are
extended to the next length, until none is left.

* Half length: of the half windows in every window, the one with the least
  hash (the leftmost of equals) stands for it; equal windows have equal ones,
  so a window whose half occurs in one document alone is no candidate.
* ``length``: all windows whose half survived are compared, by 128 bits.
  Those with a holder of smaller id cover the words that go.
* Beyond: the windows of twice the length that start with a surviving window,
  at the places chosen for the half length.  They give ``longest``, the
  greatest doubled length at which a passage of the document is seen to come
  from an earlier one (0 if nothing was removed); no removal hangs on them.

Texts stay where they are: blocks of word codes, and what is left of them at a
level, are written in buckets by their number, so that only answers move to meet them.  Every block
sends its distinct windows once per level (hash and smallest id), and gets back
two bits for each.  A passage in a third of all documents is one key per block.
Beyond ``length`` a block goes on with what its surviving windows can still
reach: of every document the words from the first of them on.  The keys of a
level are deleted when they are answered, the rest when the next level is written.

Null text has no words, rows without words have zeros and the hash of the
empty text.  Rows with equal ids are one document to each other: they remove
nothing from one another.  A null id counts as smaller than all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import LEAST, Workspace, table, whole
from tallyline.llm.word_blocks import batch, blocks, mix, parts_for, split

LENGTH = 50

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

LEVEL_DDL = (
    "kind string, block bigint, part int, keys binary, checks binary, least binary, shared binary, mask binary, "
    "row int, n_words bigint, n_removed bigint, kept_sha256 string, removed array<array<bigint>>, seen bigint, "
    "ids array<bigint>, sizes array<int>, words binary, codes binary, rows array<int>"
)
LEVEL = pa.schema([
    ("kind", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("checks", pa.binary()), ("least", pa.binary()),
    ("shared", pa.binary()), ("mask", pa.binary()), ("row", pa.int32()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("kept_sha256", pa.string()), ("removed", pa.list_(pa.list_(pa.int64()))), ("seen", pa.int64()),
    ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary()), ("codes", pa.binary()), ("rows", pa.list_(pa.int32())),
])
ANSWER = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("shared", pa.binary()), ("earlier", pa.binary())])
ANSWER_DDL = "block bigint, part int, shared binary, earlier binary"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values, the place of the first of its least."""
    place, least, reach = np.arange(len(values), dtype=np.int64), values, 1
    while reach < width:
        step = min(reach, width - reach)
        later = least[step:] < least[:-step]
        place, least = np.where(later, place[step:], place[:-step]), np.where(later, least[step:], least[:-step])
        reach += step
    return place


class Block:
    """The words of a block as numbers, and hashes of its windows."""

    def __init__(self, ids: list, sizes: list[int], words: bytes, codes: bytes):
        self.codes = np.frombuffer(codes, np.int32)
        self.words = words.split(b" ") if words else []
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.row = np.repeat(np.arange(len(sizes)), self.sizes)
        self.id = np.array([LEAST if i is None else i for i in ids], np.int64)
        values = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.words)), np.uint64).reshape(-1, 2) | np.uint64(1)
        n = len(self.codes)
        self._sums, self._back = [], []
        for base, value in zip(_BASES, values.T):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(value[self.codes] * _powers(base, n), out=sums[1:])
            self._sums.append(sums)
            self._back.append(_powers(pow(base, -1, 1 << 64), n + 1))

    def fits(self, at: np.ndarray, length: int) -> np.ndarray:
        """Which of the places ``at`` begin a window that ends within its document."""
        at = at[at < len(self.codes)]
        return at[at + length <= self.ends[self.row[at]]]

    def hashes(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        sums = self._sums[which]
        return mix((sums[at + length] - sums[at]) * self._back[which][at])

    def rest(self, at: np.ndarray) -> tuple[np.ndarray, dict]:
        """The places ``at`` (ascending) in a smaller block, and that block: of every document with places the words from the first one on."""
        rows, first = np.unique(self.row[at], return_index=True)
        begins, ends = at[first], self.ends[rows]
        sizes = ends - begins
        shift = begins - (np.cumsum(sizes) - sizes)
        codes, number = np.unique(self.codes[np.arange(sizes.sum()) + np.repeat(shift, sizes)], return_inverse=True)
        block = {
            "ids": [None if i == LEAST else i for i in self.id[rows].tolist()], "sizes": sizes.tolist(), "rows": rows.tolist(),
            "words": b" ".join(map(self.words.__getitem__, codes.tolist())), "codes": number.astype(np.int32).tobytes(),
        }
        return at - np.repeat(shift, np.diff(np.append(first, len(at)))), block

    def chosen(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """All windows of ``length`` words, and for each the half window that stands for it."""
        half, at = length // 2, self.fits(np.arange(len(self.codes)), length)
        if not len(at):
            return at, at
        least = leftmost_least(self.hashes(np.arange(len(self.codes) - half + 1), half, 0), length - half + 1)
        return at, least[at]


def grouped(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (key, check) are neighbours, and where each group starts in it."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if (same & (check[order][1:] != check[order][:-1])).any():
        order = np.lexsort((check, key))
        same = key[order][1:] == key[order][:-1]
    same &= check[order][1:] == check[order][:-1]
    return order, np.flatnonzero(np.append(True, ~same)[: len(key)])


def _keys(block: Block, at: np.ndarray, length: int, parts: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Group number of every window of ``at``, and what is sent of the groups by part: key, check, least id, held by several."""
    key, check, id = block.hashes(at, length, 0), block.hashes(at, length, 1), block.id[block.row[at]]
    order, starts = grouped(key, check)
    number = np.empty(len(at), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
    least, most = np.minimum.reduceat(id[order], starts), np.maximum.reduceat(id[order], starts)
    key, check = key[order][starts], check[order][starts]
    sent = [(part, p, key[p], check[p], least[p], most[p] > least[p]) for part, p in split((key >> np.uint64(20)).astype(np.int64) % parts)]
    return number, sent, least


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def answers(level: DataFrame) -> DataFrame:
    """Two bits for each key that a block sent: do several documents hold it, and does an earlier one than the block's first."""

    def merge(group: pa.Table) -> pa.Table:
        blobs = [group.column(c).to_pylist() for c in ("keys", "checks", "least", "shared")]
        sizes = [len(k) // 8 for k in blobs[0]]
        key, check, least = (np.frombuffer(b"".join(b), t) for b, t in zip(blobs, (np.uint64, np.uint64, np.int64)))
        several = np.concatenate([_flags(data, n) for data, n in zip(blobs[3], sizes)])
        order, starts = grouped(key, check)
        lengths = np.diff(np.append(starts, len(key)))
        first = np.minimum.reduceat(least[order], starts)
        shared = (np.maximum.reduceat(least[order], starts) > first) | np.logical_or.reduceat(several[order], starts)
        earlier, repeated = np.empty(len(key), bool), np.empty(len(key), bool)
        earlier[order] = np.repeat(first, lengths) < least[order]
        repeated[order] = np.repeat(shared, lengths)
        bounds = np.cumsum(sizes)[:-1]
        rows = zip(group.column("block").to_pylist(), group.column("part").to_pylist(), map(_bits, np.split(repeated, bounds)), map(_bits, np.split(earlier, bounds)))
        return pa.Table.from_batches([batch(ANSWER, list(rows))])

    sent = level.filter("kind = 'keys'").select("block", "part", "keys", "checks", "least", "shared")
    return sent.groupBy("part").applyInArrow(merge, ANSWER_DDL)


def _step(rows: DataFrame, length: int, judged: int, parts: int) -> DataFrame:
    """One level: take the answers on windows of ``judged`` words (0: none yet), send those of the next length.

    Gives rows of three kinds: ``keys`` (what a block sends), ``mask`` (its
    candidate places, and from ``length`` on the words that they can reach), and,
    when ``length`` itself is judged, ``row`` (the result of a document), beyond
    it ``seen``.
    """
    half = length // 2
    following = half if not judged else length if judged == half else 2 * judged
    names = LEVEL.names

    def row(**values) -> tuple:
        return tuple(values.get(n) for n in names)

    def judge(block: Block, mask: bytes, found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(_flags(mask, len(block.codes)))
        number, sent, least = _keys(block, at, judged, parts)
        answer = {f["part"]: f for f in found}
        shared, earlier = np.zeros(len(least), bool), np.zeros(len(least), bool)
        for part, places, *_ in sent:
            shared[places] = _flags(answer[part]["shared"], len(places))
            earlier[places] = _flags(answer[part]["earlier"], len(places))
        return at, shared[number], earlier[number] | (block.id[block.row[at]] > least[number])

    def results(id: int, block: Block, at: np.ndarray) -> Iterator[tuple]:
        n = len(block.codes)
        cover = np.zeros(n + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        begins = block.ends - block.sizes
        for i, (low, high) in enumerate(zip(begins.tolist(), block.ends.tolist())):
            out = gone[low:high]
            edges = np.flatnonzero(np.diff(out, prepend=False, append=False)).reshape(-1, 2)
            kept = b" ".join(map(block.words.__getitem__, block.codes[low:high][~out].tolist()))
            yield row(kind="row", block=id, row=i, n_words=high - low, n_removed=int(out.sum()), kept_sha256=hashlib.sha256(kept).hexdigest(), removed=edges.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                id, ids, sizes, words, codes, numbers, mask, found = (b.column(c)[r].as_py() for c in ("block", "ids", "sizes", "words", "codes", "rows", "mask", "found"))
                block, out = Block(ids, sizes, words, codes), []
                none = np.empty(0, np.int64)
                at, shared, earlier = judge(block, mask, found) if mask else (none, none.astype(bool), none.astype(bool))
                if judged == length:
                    out += results(id, block, at[earlier])
                elif judged > length:
                    out += [row(kind="seen", block=id, row=i, seen=judged) for i in np.array(numbers)[np.unique(block.row[at[earlier]])].tolist()]
                if not judged:
                    places = np.unique(block.chosen(length)[1])
                elif judged == half:
                    windows, chosen = block.chosen(length)
                    alive = np.zeros(len(block.codes), bool)
                    alive[at[shared]] = True
                    places = windows[alive[chosen]]
                else:
                    places = at[shared]
                    if judged == length:
                        places = np.intersect1d(places, block.chosen(length)[1])
                    places = block.fits(places, following)
                if len(places):
                    left, less, size = places, {}, len(block.codes)
                    if judged >= length:
                        left, less = block.rest(places)
                        size = sum(less["sizes"])
                        less["rows"] = (np.array(numbers) if numbers else np.arange(len(ids)))[less["rows"]].tolist()
                    candidates = np.zeros(size, bool)
                    candidates[left] = True
                    out.append(row(kind="mask", block=id, mask=_bits(candidates), **less))
                    for part, _, key, check, least, several in _keys(block, places, following, parts)[1]:
                        out.append(row(kind="keys", block=id, part=part, keys=key.tobytes(), checks=check.tobytes(), least=least.tobytes(), shared=_bits(several)))
                yield batch(LEVEL, out)

    return rows.mapInArrow(run, LEVEL_DDL)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256, longest, removed)`` of every row; ``removed`` holds ranges of word numbers.

    ``length`` is even and at least 2.
    """
    if length < 2 or length % 2:
        raise ValueError("length must be even and at least 2")
    spark = docs.sparkSession
    work = Workspace(spark, "doubling")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.lit(None).cast("string").alias("group"), whole(text_col).alias("text"))
    held = work.write_bucketed(blocks(texts, bytes.split), "blocks", "block")
    parts = parts_for(held)
    block = ["block", "ids", "sizes", "words", "codes", "rows"]
    held = held.withColumn("rows", F.lit(None).cast("array<int>")).select(block)
    none = T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("shared", T.BinaryType()), T.StructField("earlier", T.BinaryType())]))
    judged, rows = 0, held.withColumn("mask", F.lit(None).cast("binary")).withColumn("found", F.lit(None).cast(none))
    out, seen, last = None, [], None
    while True:
        level = work.write(_step(rows, length, judged, parts), f"level-{judged}")
        if last is not None:
            work.drop(f"masks-{last}")
            work.drop(f"answers-{last}")
        if judged == length:
            out = work.write(level.filter("kind = 'row'").select("block", "row", "n_words", "n_removed", "kept_sha256", "removed"), "results")
        elif judged > length:
            seen.append(work.write(level.filter("kind = 'seen'").select("block", "row", "seen"), f"seen-{judged}"))
        masks = work.write_bucketed(level.filter("kind = 'mask'").select(*block, "mask"), f"masks-{judged}", "block")
        done = judged >= length and masks.isEmpty()
        if not done:
            answer = work.write(answers(level), f"answers-{judged}")
        work.drop(f"level-{judged}")  # its keys are large, and answered
        if done:
            work.drop(f"masks-{judged}")
            break
        found = answer.groupBy("block").agg(F.collect_list(F.struct("part", "shared", "earlier")).alias("found"))
        last, judged = judged, length // 2 if not judged else length if judged < length else 2 * judged
        # blocks and masks, which beyond the length hold the words that are left, stay in their buckets: answers alone are dealt
        rows = held.join(masks.select("block", "mask").join(found, "block"), "block", "left") if judged <= length else masks.join(found, "block")
    longest = None
    for s in seen:
        longest = s if longest is None else longest.unionByName(s)
    ids = work.forget("blocks").select("block", F.posexplode("ids").alias("row", "id"))
    out = out.join(ids, ["block", "row"])
    if longest is not None:
        longest = longest.groupBy("block", "row").agg(F.max("seen").alias("seen"))
        out = out.join(longest, ["block", "row"], "left")
    else:
        out = out.withColumn("seen", F.lit(None).cast("bigint"))
    depth = F.when(F.col("n_removed") == 0, F.lit(0)).otherwise(F.coalesce("seen", F.lit(length))).cast("bigint")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_sha256", depth.alias("longest"), "removed")


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, p, array_to_string(w[p : p + 49], ' ') AS s FROM docs, unnest(range(1, len(w) - 48)) AS u(p)),
firsts AS (SELECT s, min(coalesce(doc_id, -9223372036854775808)) AS first FROM windows GROUP BY s),
again AS (SELECT r, p FROM windows JOIN firsts USING (s) WHERE coalesce(doc_id, -9223372036854775808) > first),
words AS (SELECT r, p, w[p] AS word FROM docs, unnest(range(1, len(w) + 1)) AS u(p)),
marked AS (
  SELECT words.r, words.p, word, max(again.p) OVER (PARTITION BY words.r ORDER BY words.p) AS last
  FROM words LEFT JOIN again ON again.r = words.r AND again.p = words.p),
kept AS (
  SELECT r, count(*) FILTER (WHERE last IS NOT NULL AND p - last < 50) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (WHERE last IS NULL OR p - last >= 50) AS text
  FROM marked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def op11_doubling_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the words that repeat passages of 50 words or more of documents with smaller ids."""
    return repeated_passages(table(spark, sf_dir, "documents")).drop("removed", "longest")
