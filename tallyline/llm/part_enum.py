"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word n-grams (hashed to 64 bits).  Sets
at or above the similarity differ in at most k elements, where k follows from
the band of set sizes they are in.  The hash domain is cut into first-level
partitions, each into second-level ones; of these, subsets that leave one out
are enumerated, and each subset's content is a signature.  There are enough
partitions that two sets which differ in at most k elements agree on one.  A
set gives signatures for its own band and, where it can match smaller sets,
for the band below.

Before sets are compared, their parities are: how many slots of a small bit
vector differ is never more than how many elements do, so pairs beyond the
threshold are passed over without moving their elements.

Sets with a common signature are compared exactly, yet never all with all:
equal sets are one node from the start; in every group a pivot is compared
with the members of other components, for some rounds with other pivots, and
only pairs that then are still in different components and untested are
compared each.  Of groups above ``SMALL`` members these pairs are not listed:
blocks of members are compared in tasks, by products of their incidence
matrices, and a task returns only links that join components anew.  Members of
a group's commonest component meet those outside it alone, so a group moves in
proportion to its size while few are outside.  So the components are those of all links.

The thresholds are exact fractions.  Null text, texts without words, and sets
that nothing equals or links to keep their own id as component.  Rows with
equal ids are one node with several sets.  Null ids stay on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import Workspace, scratch, sieved, stored, table
from tallyline.llm.components import components

WORDS = 300_000
PIVOTS = 4
SMALL, BLOCK, MARKS, COLUMNS = 64, 256, 1024, 16_384
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted hashes of the distinct word n-grams of a text; a shorter text is one n-gram, one without words none."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
        if not found:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > WORDS:
            known.clear()
        for w in set(found).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = self.words
        if len(hashes) < n:
            return _mix(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), seed=len(hashes))], np.uint64))
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for i in range(n):
            total = _mix(total * _ODD[1] + hashes[i : len(hashes) - n + 1 + i] * _ODD[0])
        return np.unique(total)


class Bands:
    """Size bands of ratio (1 / similarity) squared, and for each the partitions its pairs need."""

    def __init__(self, part: int, of: int):
        self.part, self.of = part, of
        self.low, self.high = [1], []

    def _upto(self, band: int) -> None:
        while len(self.high) <= band:
            top = self.low[-1]
            for _ in range(2):
                top = top * self.of // self.part
            self.high.append(top)
            self.low.append(top + 1)

    def band(self, size: int) -> int:
        while not self.high or self.high[-1] < size:
            self._upto(len(self.high))
        return int(np.searchsorted(self.high, size))

    def instances(self, size: int) -> list[int]:
        """The bands whose pairs may hold a set of this size: as one of the band itself, or as a larger partner."""
        own = self.band(size)
        out = [own]
        if own and size * self.part <= self.high[own - 1] * self.of:
            out.append(own - 1)
        return out

    def differ(self, band: int) -> int:
        """The most elements in which a pair differs whose smaller set is in the band."""
        self._upto(band)
        small = self.high[band]
        return (small + small * self.of // self.part) * (self.of - self.part) // (self.of + self.part)


def signatures(items: np.ndarray, bands: Bands, ways: int) -> np.ndarray:
    """All signatures of a set of at least one element."""
    out = []
    for band in bands.instances(len(items)):
        k = bands.differ(band)
        if k == 0:
            continue  # only equal sets link
        need = k // 2 + 1
        spare = max(1, need // 8)
        first = need + spare
        places = _mix(items ^ np.uint64(0x5851F42D4C957F2D))
        slot = (places >> np.uint64(32)) % np.uint64(first * ways)
        sums = np.zeros(first * ways, np.uint64)
        sizes = np.bincount(slot.astype(np.int64), minlength=first * ways)
        np.add.at(sums, slot.astype(np.int64), _mix(items + _ODD[2]))
        sums, sizes = sums.reshape(first, ways), sizes.reshape(first, ways)
        for left_out in range(ways):
            held = np.delete(np.arange(ways), left_out)
            mixed = np.full(first, np.uint64(xxhash.xxh64_intdigest(f"{band}:{left_out}")), np.uint64)
            for w in held:
                mixed = _mix(mixed * _ODD[1] + sums[:, w] + sizes[:, w].astype(np.uint64) * _ODD[3])
            mixed = _mix(mixed + np.arange(first, dtype=np.uint64) * _ODD[4])
            out.append((mixed, sizes[:, held].sum(1) == 0))
        empty = np.zeros(first, bool)
        for _, e in out[-ways:]:
            empty |= e
        # more than `spare` partitions agree, so a set with few empty ones need not give these
        if empty.sum() <= spare:
            out[-ways:] = [(m[~e], None) for m, e in out[-ways:]]
    return np.concatenate([m for m, _ in out]) if out else np.empty(0, np.uint64)


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _key(items: np.ndarray) -> int | None:
    """Equal sets have equal keys; the empty set has none."""
    if not len(items):
        return None
    key = xxhash.xxh3_64_intdigest(items.tobytes())
    return key - (1 << 64) if key >> 63 else key


def parities(items: np.ndarray) -> bytes:
    """Whether an even or odd number of elements falls into each of as many slots (a power of two) as there are elements, at least 128.

    A slot that differs holds an element of one set only, so differing slots
    never outnumber the elements in which two sets differ.
    """
    slots = max(128, 1 << (len(items) - 1).bit_length()) if len(items) else 128
    counts = np.bincount((_mix(items ^ _ODD[2]) & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(mark: np.ndarray, length: int) -> np.ndarray:
    """Parities of more slots brought to fewer."""
    return mark if len(mark) == length else np.bitwise_xor.reduce(mark.reshape(-1, length), axis=0)


def may_link(x: bytes, y: bytes, sizes: int, similarity: tuple[int, int]) -> bool:
    """False only for sets (of ``sizes`` elements together) that cannot reach the similarity."""
    part, of = similarity
    one, two = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    length = min(len(one), len(two))
    differ = int(np.bitwise_count(_folded(one, length) ^ _folded(two, length)).sum())
    return differ * (of + part) <= sizes * (of - part)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))


def sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(id, n, key, parity)`` of every row; equal sets have equal keys; the empty set has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for b in batches:
            items = [shingle(text.as_py()) for text in b.column("text")]
            columns = [b.column("id"), pa.array([len(x) for x in items], pa.int64()), pa.array([_key(x) for x in items], pa.int64()), pa.array([parities(x) for x in items], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "key", "parity"])

    return stored(_rows(docs, id_col, text_col).mapInArrow(run, "id bigint, n bigint, key bigint, parity binary"), "sets")


def signed(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: tuple[int, int]) -> DataFrame:
    """``(key, signatures)`` of the sets; those that a task meets again in a batch give none."""
    ways = 2 if similarity[0] * 100 >= similarity[1] * 85 else 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, bands = Shingler(words), Bands(*similarity)
        for b in batches:
            marks: dict[int, np.ndarray] = {}
            for text in b.column("text"):
                items = shingle(text.as_py())
                key = _key(items)
                if key is not None and key not in marks:
                    marks[key] = _long(signatures(items, bands, ways))
            offsets = np.cumsum([0, *map(len, marks.values())])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(list(marks.values())) if marks else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(list(marks), pa.int64()), lists], names=["key", "signatures"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "key bigint, signatures array<bigint>")


def _contents(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(key, items)`` for the keys in groups, from one document each (``nodes``: id, key, and whether several rows have both)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for b in batches:
            found: dict[int, tuple[np.ndarray, bool]] = {}
            for text, key, several in zip(b.column("text"), b.column("key").to_pylist(), b.column("several").to_pylist()):
                items = shingle(text.as_py())
                if _key(items) == key:  # another row may have the same id
                    found[key] = items, several
            items = [x for x, _ in found.values()]
            offsets = np.cumsum([0, *map(len, items)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(_long(np.concatenate(items)) if items else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([s for _, s in found.values()], pa.bool_()), lists], names=["key", "several", "items"])

    rows = sieved(_rows(docs, id_col, text_col), "id", nodes).filter("maybe").join(nodes, "id").select("key", "several", "text")
    found = stored(rows.mapInArrow(run, "key bigint, several boolean, items array<bigint>"), "contents")
    again = found.filter("several").select("key", "items").dropDuplicates(["key"])
    return found.filter("NOT several").select("key", "items").unionByName(again)


def _possible(pairs: DataFrame, marks: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes and parities leave the similarity open."""
    part, of = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("x").to_pylist(), b.column("y").to_pylist(), b.column("sizes").to_pylist())
            keep = [may_link(x, y, sizes, similarity) for x, y, sizes in rows]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = marks.select(F.col("key").alias("a"), F.col("n").alias("n_x"), F.col("parity").alias("x"))
    y = marks.select(F.col("key").alias("b"), F.col("n").alias("n_y"), F.col("parity").alias("y"))
    near = F.greatest("n_x", "n_y") * part <= F.least("n_x", "n_y") * of
    rows = pairs.join(x, "a").join(y, "b").filter(near).select("a", "b", "x", "y", (F.col("n_x") + F.col("n_y")).alias("sizes"))
    return stored(rows.mapInArrow(run, "a bigint, b bigint"), "possible")


def _links(possible: DataFrame, contents: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Of the pairs ``(a, b)`` those that reach the similarity."""
    part, of = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column("x"), b.column("y")
            keep = []
            for i in range(b.num_rows):
                x, y = left[i].values.to_numpy(zero_copy_only=False), right[i].values.to_numpy(zero_copy_only=False)
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared * of >= part * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(key: str, items: str) -> DataFrame:
        return contents.join(possible.select(F.col(key).alias("key")), "key", "left_semi").toDF(key, items)

    pairs = possible.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def block_links(left: list[np.ndarray], right: list[np.ndarray], similarity: tuple[int, int]) -> np.ndarray:
    """Which sets of one block reach the similarity with which of another: a matrix of booleans.

    Shared elements are counted by products of 0/1 matrices over some columns
    at a time; elements of a single set have no column.
    """
    part, of = similarity
    sizes = np.array([len(x) for x in (*left, *right)])
    values, inverse, counts = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    number = np.cumsum(counts > 1) - 1
    several = counts[inverse] > 1
    owner, column = owner[several], number[inverse[several]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    shared = np.zeros((len(left), len(right)), np.float64)
    for start in range(0, int((counts > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        there = np.zeros((len(sizes), COLUMNS), np.float32)
        there[owner[a:b], column[a:b] - start] = 1
        shared += there[: len(left)] @ there[len(left) :].T
    union = sizes[: len(left), None] + sizes[None, len(left) :] - shared
    return shared * of >= part * union


def _dealt(members: DataFrame, size: int) -> DataFrame:
    """The members of each signature in blocks of ``size``, each block once for every pair ``(low, high)`` of blocks it is in.

    A group of ``size`` members at most is one block.  In larger ones members of
    the commonest label link to others only, so their blocks (with negative
    numbers) meet those of the others and never each other.
    """
    held = members.groupBy("signature", "label").agg(F.count("*").alias("held"))
    most = held.groupBy("signature").agg(F.max(F.struct("held", "label")).alias("most"), F.sum("held").alias("members"))
    split = F.col("members") > size
    sizes = most.filter("members > most.held").select(
        "signature", F.when(split, F.col("most.label")).alias("common"), F.when(split, F.ceil(F.col("most.held") / size)).otherwise(0).cast("int").alias("own"),
        F.ceil((F.col("members") - F.when(split, F.col("most.held")).otherwise(0)) / size).cast("int").alias("blocks"),
    )
    common, number = F.coalesce(F.col("label") == F.col("common"), F.lit(False)), F.xxhash64("key", F.lit(7))
    block = F.when(common, -1 - F.pmod(number, F.col("own"))).otherwise(F.pmod(number, F.col("blocks"))).cast("int")
    dealt = members.select("signature", "key", "label").join(sizes, "signature").withColumn("block", block)
    first = F.when(common, F.lit(0)).otherwise(-F.col("own"))
    others = F.transform(F.sequence(first, F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("low"), F.greatest("block", o).alias("high")))
    dealt = dealt.select("signature", "key", "label", "block", F.explode(others).alias("pair"))
    return dealt.select("signature", "key", "label", "block", "pair.low", "pair.high")


def _hopeful(members: DataFrame, marks: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The members that their parities let link to one of another label in their group."""
    part, of = similarity

    def run(group: pa.Table) -> pa.Table:
        block, labels, sizes = (group.column(c).to_numpy() for c in ("block", "label", "n"))
        marks = [np.frombuffer(x, np.uint8) for x in group.column("parity").to_pylist()]
        length = min(map(len, marks), default=16)
        bits = np.stack([_folded(m, length) for m in marks]) if marks else np.empty((0, length), np.uint8)
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        two, good = np.flatnonzero(block == high), np.zeros(group.num_rows, bool)
        for i in np.flatnonzero(block == low):
            differ = np.bitwise_count(bits[i] ^ bits[two]).sum(1, dtype=np.int64)
            both = sizes[i] + sizes[two]
            hits = (differ * (of + part) <= both * (of - part)) & (labels[two] != labels[i])
            hits &= np.maximum(sizes[i], sizes[two]) * part <= np.minimum(sizes[i], sizes[two]) * of
            good[two[hits]] = True
            good[i] |= hits.any()
        return group.select(["signature", "key", "label"]).filter(pa.array(good))

    rows = _dealt(members, MARKS).join(marks, "key")
    found = rows.groupBy("signature", "low", "high").applyInArrow(run, "signature bigint, key bigint, label bigint")
    return stored(found.distinct(), "hopeful")


def _in_blocks(members: DataFrame, contents: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links ``(a, b)`` that join the labels of large groups' ``(signature, key, label)``."""

    def run(group: pa.Table) -> pa.Table:
        block, labels, keys = (group.column(c).to_numpy() for c in ("block", "label", "key"))
        items = [x.values.to_numpy(zero_copy_only=False) for x in group.column("items")]
        low, high = int(group.column("low")[0].as_py()), int(group.column("high")[0].as_py())
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        out: list[tuple[int, int]] = []
        if len(one) and len(two):
            top = {int(x): int(x) for x in labels}

            def find(x: int) -> int:
                while top[x] != x:
                    top[x] = top[top[x]]
                    x = top[x]
                return x

            hits = block_links([items[i] for i in one], [items[j] for j in two], similarity) & (labels[one][:, None] != labels[two][None, :])
            for i, j in zip(*np.nonzero(hits)):
                a, b = find(int(labels[one[i]])), find(int(labels[two[j]]))
                if a != b:
                    top[a] = b
                    out.append((int(keys[one[i]]), int(keys[two[j]])))
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), ()))], names=["a", "b"])

    return _dealt(members, BLOCK).join(contents, "key").groupBy("signature", "low", "high").applyInArrow(run, "a bigint, b bigint")


def linked(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, similarity: tuple[int, int]) -> DataFrame:
    """``(node, label)`` of the keys that link to others."""
    single = Window.partitionBy("signature").orderBy("key")
    each = signed(docs, id_col, text_col, words, similarity).select("key", F.explode("signatures").alias("signature"))
    beside = (F.lag("key").over(single) != F.col("key")) | (F.lead("key").over(single) != F.col("key"))
    groups = stored(each.withColumn("beside", beside).filter("beside").select("signature", "key").distinct(), "groups")
    first = rows.filter("key IS NOT NULL AND id IS NOT NULL").groupBy("key", "id").agg(F.count("*").alias("rows"), F.first("n").alias("n"), F.first("parity").alias("parity"))
    first = first.groupBy("key").agg(F.min(F.struct("id", (F.col("rows") > 1).alias("several"), "n", "parity")).alias("first"))
    nodes = stored(first.select("key", "first.*").join(groups.select("key").distinct(), "key", "left_semi"), "nodes")
    marks = nodes.select("key", "n", "parity")
    contents = _contents(docs, nodes.select("key", "id", "several"), id_col, text_col, words)
    labels = tested = None
    empty = groups.sparkSession.createDataFrame([], "a bigint, b bigint")
    for turn in range(PIVOTS + 1):
        if labels is None:
            marked = groups.withColumn("label", F.col("key"))
        else:
            marked = groups.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        # groups within one component are done
        ends = marked.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"), F.min(F.struct(F.xxhash64("key", F.lit(turn)), "key", "label")).alias("pivot"))
        ends = ends.filter("low <> high")
        if turn < PIVOTS:
            pivots = ends.select("signature", F.col("pivot.key").alias("other"), F.col("pivot.label").alias("other_label"))
            pairs = marked.join(pivots, "signature").filter("label <> other_label")
        else:
            rest = stored(marked.join(ends.select("signature", "members"), "signature"), "rest")
            large = rest.filter(F.col("members") > SMALL).drop("members")
            rest = rest.filter(F.col("members") <= SMALL)
            others = rest.select("signature", F.col("key").alias("other"), F.col("label").alias("other_label"))
            pairs = rest.join(others, "signature").filter("label <> other_label AND key < other")
        pairs = pairs.groupBy(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).agg(F.count("*").alias("common"), F.min("key").alias("key"))
        if turn == 0:  # most members are near one pivot: try that one first
            best = pairs.select("common", "a", "b", F.explode(F.array("a", "b")).alias("of")).groupBy("of").agg(F.max(F.struct("common", "a", "b")).alias("p"))
            pairs = best.select("p.a", "p.b").distinct()
        pairs = pairs.select("a", "b")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = _links(_possible(pairs, marks, similarity), contents, similarity)
        if turn == PIVOTS:
            found = found.unionByName(_in_blocks(_hopeful(large, marks, similarity), contents, similarity))
        elif pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(found, "links")
        if found.isEmpty():
            continue
        edges = found if labels is None else found.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = components(edges)
    return labels if labels is not None else empty.toDF("node", "label")


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, similarity: tuple[int, int] = (90, 100)) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row, as a written table; the tables on the way to it are deleted."""
    work = Workspace(docs.sparkSession, "part-enum")
    with scratch(docs.sparkSession):
        return work.write(_joined(docs, id_col, text_col, words, similarity), "joined")


def _joined(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: tuple[int, int]) -> DataFrame:
    rows = sets(docs, id_col, text_col, words)
    labels = linked(rows, docs, id_col, text_col, words, similarity)
    at = rows.select("id", "n", "key").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    at = stored(at, "labelled")
    # a row with a repeated id joins the components of all its sets
    twice = at.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    if not twice.isEmpty():
        again = at.filter("label IS NOT NULL").join(twice.select("id"), "id", "left_semi")
        edges = again.join(twice, "id").select(F.col("label").alias("a"), F.col("a").alias("b"))
        merged = components(edges).select(F.col("node").alias("label"), F.col("label").alias("top"))
        at = at.join(merged, "label", "left").withColumn("label", F.coalesce("top", "label")).drop("top")
    least = at.filter("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("least"))
    out = at.join(least, "label", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("least", "id")).alias("component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row of ``docs`` from every group of linked texts: that of the smallest id, of several with it the first.

    Every row is a node of its own by its number, so rows that repeat an id or
    have none are compared like others.  Rows without an id stay beside those
    with one, one row for each group of them.  Rows without words all stay.
    """
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    work = Workspace(docs.sparkSession, "one-of-each")
    rows = work.write(docs.select(F.monotonically_increasing_id().alias("number"), columns), "numbered")
    with scratch(docs.sparkSession):
        found = joined(rows.select("number", F.col("doc")[text_col].alias("text")), "number", "text", words, similarity)
        ids = rows.select("number", F.col("doc")[id_col].alias("id"))
        found = found.filter("n_shingles > 0").join(ids, "number")
        first = found.groupBy("component_id", F.col("id").isNull().alias("without")).agg(F.min(F.struct("id", "number")).alias("first"))
        gone = work.write(found.select("number").join(first.select("first.number"), "number", "left_anti"), "gone")
    # only the rows that may go are moved to meet those that do
    rows = sieved(rows, "number", gone)
    left = rows.filter("maybe").join(gone, "number", "left_anti")
    return rows.filter("NOT maybe").unionByName(left).select("doc.*")


def op8_part_enum(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose word 3-grams agree to nine tenths."""
    return joined(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
),
long AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
rare AS (SELECT g FROM long GROUP BY g HAVING count(*) > 1),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS shared
  FROM long a JOIN rare USING (g) JOIN long b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (m + n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS r FROM ways
  UNION
  SELECT w.b, reach.r FROM reach JOIN ways w ON w.a = reach.doc_id WHERE reach.r < w.b
),
least AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least(l.r, s.doc_id), s.doc_id) AS component_id
FROM sets s LEFT JOIN least l USING (doc_id)
"""
