"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A text is cut into sections (at blank lines, before headings, and after
paragraphs whose own hash says so, so that an edit moves no later border),
sections into paragraphs (lines), paragraphs into sentences, which are the
leaves.  Every inner node hashes its children, the root also the whole text.
Equal roots mean equal texts.  Otherwise ``differences`` goes down only the
branches that differ and returns the edited spans, and ``likeness`` is the
share of text that lies in common leaves.

A fingerprint is one line of text: ``root|leaves``, sections parted by ``/``,
paragraphs by ``;`` and leaves by ``,``; a leaf is eight hex digits and its
length in code points.  Inner nodes follow from the leaves and are not stored.

Null text counts as empty, the empty text has a root and no leaves, and rows
with equal ids are each treated on their own.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import LEAST, partitions, table, whole

LONG_LEAF = 256
_SENTENCE = re.compile(r"[^.!?]*(?:[.!?]+(?=\s)\s*|[.!?]+|\Z)", re.S)

Leaf = tuple[str, int]
Tree = list[list[list[Leaf]]]


def _leaf(piece: str) -> Leaf:
    return f"{crc32(piece.encode()):08x}", len(piece)


def _leaves(paragraph: str) -> list[Leaf]:
    """Sentences; long ones are cut after words chosen by hash, and after 256 characters without any."""
    out = []
    for sentence in _SENTENCE.findall(paragraph):
        if len(sentence) <= LONG_LEAF:
            if sentence:
                out.append(_leaf(sentence))
            continue
        start = at = 0
        for word in re.findall(r"\S*\s*", sentence):
            at += len(word)
            if word and crc32(word.encode()) % 8 == 0 or at - start >= LONG_LEAF:
                out.extend(_leaf(sentence[i : min(i + LONG_LEAF, at)]) for i in range(start, at, LONG_LEAF))
                start = at
        if start < len(sentence):
            out.append(_leaf(sentence[start:]))
    return out


def tree(text: str) -> Tree:
    sections: Tree = []
    current: list[list[Leaf]] = []
    for line in text.splitlines(keepends=True) if text else ():
        if line.startswith("#") and current:
            sections.append(current)
            current = []
        leaves = _leaves(line)
        current.append(leaves)
        if not line.strip() or int(leaves[-1][0], 16) % 8 == 0:
            sections.append(current)
            current = []
    if current:
        sections.append(current)
    return sections


def _node(children: Iterable[str]) -> str:
    return hashlib.blake2b("".join(children).encode(), digest_size=16).hexdigest()


def _of_paragraph(paragraph: list[Leaf]) -> str:
    return _node(f"{h}{n}" for h, n in paragraph)


def _of_section(section: list[list[Leaf]]) -> str:
    return _node(map(_of_paragraph, section))


def render(text: str, sections: Tree) -> str:
    root = _node([hashlib.blake2b(text.encode(), digest_size=16).hexdigest(), *map(_of_section, sections)])
    return f"{root}|" + "/".join(";".join(",".join(f"{h}{n}" for h, n in p) for p in s) for s in sections)


def fingerprint(text: str | None) -> str:
    return render(text or "", tree(text or ""))


def parse(value: str) -> tuple[str, Tree]:
    root, _, body = value.partition("|")
    if not body:
        return root, []
    return root, [[[(x[:8], int(x[8:])) for x in p.split(",")] for p in s.split(";")] for s in body.split("/")]


def overlap(a: Tree, b: Tree) -> float:
    """Twice the length of the common leaves over both lengths; 1 for two empty texts."""
    left = Counter(x for s in a for p in s for x in p)
    right = Counter(x for s in b for p in s for x in p)
    both = sum(n * c for (_, n), c in left.items()) + sum(n * c for (_, n), c in right.items())
    shared = sum(x[1] * min(c, right[x]) for x, c in left.items() if x in right)
    return 2.0 * shared / both if both else 1.0


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1; equal roots are 1."""
    (root_a, tree_a), (root_b, tree_b) = parse(a), parse(b)
    return 1.0 if root_a == root_b else overlap(tree_a, tree_b)


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """Spans of the first text (code points, end exclusive) in leaves that the second lacks.

    Sections and paragraphs that the other tree also has are skipped whole.
    Missing text in ``a`` shows as no span; ask with the sides exchanged.
    """
    (root_a, left), (root_b, right) = parse(a), parse(b)
    if root_a == root_b:
        return []
    sections = Counter(map(_of_section, right))
    paragraphs = Counter(map(_of_paragraph, chain.from_iterable(right)))
    leaves = Counter(x for s in right for p in s for x in p)
    spans: list[tuple[int, int]] = []
    at = 0

    def known(pool: Counter, key) -> bool:
        if pool[key]:
            pool[key] -= 1
            return True
        return False

    for section in left:
        size = sum(n for p in section for _, n in p)
        if known(sections, _of_section(section)):
            for p in section:
                paragraphs[_of_paragraph(p)] -= 1
                leaves.subtract(p)
            at += size
            continue
        for paragraph in section:
            if known(paragraphs, _of_paragraph(paragraph)):
                leaves.subtract(paragraph)
                at += sum(n for _, n in paragraph)
                continue
            for leaf in paragraph:
                if not (leaves[leaf] > 0 and known(leaves, leaf)):
                    if spans and spans[-1][1] == at:
                        spans[-1] = (spans[-1][0], at + leaf[1])
                    else:
                        spans.append((at, at + leaf[1]))
                at += leaf[1]
    return spans


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [fingerprint(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(marks, pa.string())], names=[id_col, "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows in descending id order, dealt into ranges of ids; the first row of a range also goes, as a ghost, to the range before.

    Only the borders of the ranges and the highest id of each reach the
    driver, one pair per range.  After the last row comes the first of all.
    """
    spark = docs.sparkSession
    count = partitions(spark)
    ids = docs.select("key")
    borders = sorted(set(ids.select(F.col("key").cast("double")).approxQuantile("key", [i / count for i in range(1, count)], 0.002)))
    rank = F.lit(len(borders)) - F.size(F.filter(F.array([F.lit(float(x)) for x in borders]), lambda x: x <= F.col("key").cast("double")))
    if not borders:
        rank = F.lit(0)
    rows = docs.withColumn("part", rank.cast("int"))
    tops = sorted((r["part"], r["top"]) for r in rows.groupBy("part").agg(F.max("key").alias("top")).collect())
    ghosts = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]
    at = F.create_map([x for top, part in ghosts for x in (F.lit(top).cast("bigint"), F.lit(part))])[F.col("key")] if ghosts else F.lit(None).cast("int")
    copies = F.array_compact(F.array(F.struct(F.col("part"), F.lit(0).alias("ghost")), F.when(at.isNotNull(), F.struct(at.alias("part"), F.lit(1).alias("ghost")))))
    rows = rows.select("*", F.explode(copies).alias("to")).select(F.col("to.part").alias("part"), F.col("to.ghost").alias("ghost"), "key", "id", "text")
    return rows.repartition(count, "part").sortWithinPartitions("part", "ghost", F.desc("key"), "text")


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness (see ``op1_merkle_fingerprints``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        held = None
        for b in batches:
            out, size = [], 0
            for part, ghost, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("part", "ghost", "id", "text"))):
                own = tree(text)
                if held and held[0] == part:
                    _, before, earlier, cut = held
                    n = len(earlier) // 3
                    edited = earlier[: len(earlier) - n] + text[:n]
                    other = tree(edited)
                    out.append((before, len(earlier), hashlib.sha256(edited.encode()).hexdigest(), render(earlier, cut), render(edited, other),
                                1.0 if edited == earlier else overlap(cut, other), 1.0 if text == earlier else overlap(cut, own)))
                    size += len(out[-1][3]) + len(out[-1][4])
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                held = None if ghost else (part, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    rows = docs.select(F.coalesce("doc_id", F.lit(LEAST)).cast("bigint").alias("key"), F.col("doc_id").cast("bigint").alias("id"), whole("text").alias("text"))
    return _with_next(rows).mapInArrow(run, RESULT)


def op1_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document against its own edited text and the next document, in descending id order."""
    return edited_pairs(table(spark, sf_dir, "documents"))
