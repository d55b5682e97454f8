"""Texts as blocks of word codes, and the exchange of keys between blocks.

A block is a stretch of rows of one task: their ids, their sizes in words, the
block's own dictionary (words parted by spaces), and one code per word.  A text is never cut, so a block
holds ``BLOCK`` words and what its last text has beyond them.

Blocks learn about each other by keys: each sends its distinct keys once,
sorted, in parts chosen by hash; whoever merges a part answers each block in
the order of the keys that it sent.  So an answer needs no key and a hot key
arrives once per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import partitions

BLOCK = 1 << 20
#: Blocks' worth of words that a task holds of all groups together.
HELD = 4
#: A byte that UTF-8 never has, for borders between words; dictionaries hold it as a line feed.
BORDER = b"\xff"
#: Keys of one part that are merged at once, about.
PART = 1 << 22

BLOCKS = pa.schema([
    ("block", pa.int64()), ("group", pa.string()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("words", pa.binary()), ("counts", pa.list_(pa.int32())), ("codes", pa.binary()),
])
BLOCKS_DDL = "block bigint, group string, ids array<bigint>, sizes array<int>, words binary, counts array<int>, codes binary"


class Codes(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def blocks(docs: DataFrame, words_of: Callable[[bytes], list[bytes]], size: int = BLOCK) -> DataFrame:
    """Blocks of ``docs (id, group, text)``; rows of one block share their group.  Null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: dict[str | None, tuple[Codes, list, list, list]] = {}
        filled: dict[str | None, int] = {}
        sent = 0

        def emit(group: str | None) -> pa.RecordBatch:
            nonlocal sent
            codes, ids, sizes, parts = held.pop(group)
            filled.pop(group)
            all_codes = np.concatenate(parts)
            counts = np.bincount(all_codes, minlength=len(codes)).astype(np.int32)
            sent += 1
            words = b" ".join(codes).replace(BORDER, b"\n")
            return batch(BLOCKS, [(first + sent, group, ids, sizes, words, counts, all_codes.tobytes())])

        for b in batches:
            for id, group, data in zip(b.column("id").to_pylist(), b.column("group").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                if group not in held:
                    held[group], filled[group] = (Codes(), [], [], [np.empty(0, np.int32)]), 0
                codes, ids, sizes, parts = held[group]
                words = words_of(data) if data else []
                ids.append(id)
                sizes.append(len(words))
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                filled[group] += len(words) + 1
                if filled[group] >= size:
                    yield emit(group)
                elif sum(filled.values()) >= HELD * size:  # of many groups the largest gives way
                    yield emit(max(filled, key=filled.__getitem__))
        for group in list(held):
            yield emit(group)

    return docs.select("id", "group", "text").mapInArrow(run, BLOCKS_DDL)


@contextmanager
def arrow_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """What runs inside sends rows to Python in batches of about a block, where Spark's own limit has Spark and Python hold many at once, for each task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parts_for(stored_blocks: DataFrame, keys: int = PART) -> int:
    """In how many parts of about ``keys`` keys are merged: as many as the data need, so that a part fits in memory."""
    words = stored_blocks.select(F.sum(F.octet_length("codes")).alias("n")).first()["n"] or 0
    return max(partitions(stored_blocks.sparkSession), words // 4 // keys + 1)


def split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The parts that occur, each with the places of its keys in their order."""
    order = np.argsort(part, kind="stable")
    bounds = np.flatnonzero(np.diff(part[order])) + 1
    if len(order):
        for places in np.split(order, bounds):
            yield int(part[places[0]]), places
