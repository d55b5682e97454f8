"""Phrase collocations by set-oriented relational mining.

The occurrence relation (piece, position, word) is written once, sorted, in
blocks of one language; a block holds whole pieces.  Each round extends it:

* merge-join by piece and adjacent position: an occurrence of a group of
  ``k - 1`` words with the word that follows it in its piece,
* group-count: blocks count their own groups, parts chosen by hash add up,
* semi-join: every block is told which of its groups are frequent (the answers
  meet it as rows, in one task of Arrow's, and are not gathered before), and only
  occurrences of frequent groups (both the first and the last ``k - 1`` words
  of a longer one) are extended in the next round.

A word below the support is in no frequent group, so it parts pieces like a
border.  Words get numbers when their own counts are known.

Scores compare a phrase's count with those of the two parts of its weakest cut,
in whole numbers of 38 digits.

Null text is empty and has no words, a null ``lang`` is ``und``, repeated rows
count each time they occur.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import Workspace, partitions, table, whole
from tallyline.llm.word_blocks import BORDER, arrow_batches, batch, blocks, mix, parts_for, split

SUPPORT = 10
WORDS = 3
TOP = 2000
#: Keys of one part that are merged at once, about: one of two numbers takes some 150 bytes while they are merged.
PART = 1 << 20
#: Width of the bins in which scores (at most 1,000,000) are counted.
STEP = 100

_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BORDER * 10)

NUMBERED_DDL = "block bigint, group string, codes binary, numbers binary"
NUMBERED = pa.schema([("block", pa.int64()), ("group", pa.string()), ("codes", pa.binary()), ("numbers", pa.binary())])
SENT_DDL = "block bigint, group string, part int, first binary, next binary, counts binary"
SENT = pa.schema([("block", pa.int64()), ("group", pa.string()), ("part", pa.int32()), ("first", pa.binary()), ("next", pa.binary()), ("counts", pa.binary())])
COUNTED_DDL = "block bigint, group string, part int, numbers binary, number bigint, first bigint, next bigint, f bigint"
COUNTED = pa.schema([
    ("block", pa.int64()), ("group", pa.string()), ("part", pa.int32()), ("numbers", pa.binary()),
    ("number", pa.int64()), ("first", pa.int64()), ("next", pa.int64()), ("f", pa.int64()),
])


def words_with_borders(text: bytes) -> list[bytes]:
    """Words of a text in lower case (A-Z), a border before the first, after the last, and between pieces."""
    return (BORDER + text.lower().translate(_PIECES) + BORDER).replace(BORDER, b" " + BORDER + b" ").split()


def _numbered(held: DataFrame, numbers: DataFrame) -> DataFrame:
    """Blocks with the corpus-wide number of each of their codes; 0 for borders and rare words."""

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return NUMBERED.empty_table()
        number = np.zeros(blocks.column("size")[0].as_py(), np.int64)
        number[known.column("code").to_numpy()] = known.column("number").to_numpy()
        same = [blocks.column(c) for c in ("block", "group", "codes")]
        return pa.table([*same, pa.array([number.tobytes()], pa.binary())], schema=NUMBERED)

    known = _dictionary(held).join(numbers, ["group", "word"]).select(F.col("block").alias("of"), "code", "number")
    each = held.select("block", "group", F.size("counts").alias("size"), "codes")
    return each.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, NUMBERED_DDL)


def _dictionary(held: DataFrame) -> DataFrame:
    """``(block, group, code, word, n)``: the words of every block and how often it has them."""
    words = F.split(F.decode("words", "utf-8"), " ")
    each = held.select("block", "group", F.posexplode(F.arrays_zip(words.alias("word"), F.col("counts").alias("n"))).alias("code", "entry"))
    return each.select("block", "group", "code", "entry.word", F.col("entry.n").cast("bigint").alias("n"))


def _extended(first: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places that can be extended (neither side 0), the group of each, and the distinct groups with their counts."""
    at = np.flatnonzero((first[:-1] > 0) & (following[1:] > 0)) if len(first) else np.empty(0, np.int64)
    order = at[np.lexsort((following[at + 1], first[at]))]
    a, b = first[order], following[order + 1]
    starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(order)])
    counts = np.diff(np.append(starts, len(order)))
    return order, np.repeat(np.arange(len(starts)), counts), a[starts], b[starts], counts


def _parts(first: np.ndarray, following: np.ndarray, parts: int) -> np.ndarray:
    return (mix(first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + following.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _joined(occurrences: np.ndarray, answers: list[dict[int, pa.Buffer]], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """After the rounds answered so far, by part: number of the frequent group at each place (0: none), and what may follow it."""
    group = following = occurrences
    for length, answer in enumerate(answers, 2):
        order, which, a, b, _ = _extended(group, following)
        numbers = np.zeros(len(a), np.int64)
        for part, places in split(_parts(a, b, parts)):
            numbers[places] = np.frombuffer(answer[part], np.int64)
        longer = np.zeros(len(occurrences), np.int64)
        longer[order] = numbers[which]
        # at the place after a group's first word stands its next word, if the group that begins there is frequent too
        group, following = longer, np.zeros(len(occurrences), np.int64)
        begins = np.flatnonzero(longer)
        following[begins] = occurrences[begins + length - 1]
    return group, following


def _sent(block: int, group: str, numbers: pa.Scalar, codes: pa.Scalar, answers: list[dict[int, pa.Buffer]], parts: int) -> pa.RecordBatch:
    """Groups of the next length in a block."""
    occurrences = np.frombuffer(numbers.as_buffer(), np.int64)[np.frombuffer(codes.as_buffer(), np.int32)]
    held, following = _joined(occurrences, answers, parts)
    _, _, a, c, counts = _extended(held, following)
    return batch(SENT, [(block, group, part, a[p].tobytes(), c[p].tobytes(), counts[p].astype(np.int32).tobytes()) for part, p in split(_parts(a, c, parts))])


def _first_round(relation: DataFrame, parts: int) -> DataFrame:
    """Groups of two words that each block has, with their counts, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                yield _sent(b.column("block")[r].as_py(), b.column("group")[r].as_py(), b.column("numbers")[r], b.column("codes")[r], [], parts)

    return relation.mapInArrow(run, SENT_DDL)


def _round(relation: DataFrame, answers: DataFrame, words: int, parts: int) -> DataFrame:
    """Groups of ``words`` words, likewise: a block meets the ``answers (block, words, part, numbers)`` to what it sent, which stay rows of their own."""

    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return SENT.empty_table()
        so_far: list[dict[int, pa.Buffer]] = [{} for _ in range(2, words)]
        for k, part, numbers in zip(found.column("words").to_pylist(), found.column("part").to_pylist(), found.column("numbers")):
            so_far[k - 2][part] = numbers.as_buffer()
        block = {c: blocks.column(c)[0] for c in blocks.column_names}
        return pa.Table.from_batches([_sent(block["block"].as_py(), block["group"].as_py(), block["numbers"], block["codes"], so_far, parts)])

    return relation.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SENT_DDL)


def _bytes(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of packed numbers end to end, and where each row of it ends, bar the last."""
    out, sizes = [], []
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = chunk.buffers()[2]
        out.append(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8))
        sizes.append(np.diff(offsets))
    width = np.dtype(kind).itemsize
    return np.concatenate(out).view(kind), np.cumsum(np.concatenate(sizes) // width)[:-1]


def _counted(sent: DataFrame, support: int) -> DataFrame:
    """Sums per group: a row of numbers for each block that asked, and a row for each frequent group."""

    def merge(rows: pa.Table) -> pa.Table:
        group, part, blocks = rows.column("group")[0].as_py(), rows.column("part")[0].as_py(), rows.column("block").to_pylist()
        (first, ends), (following, _), (counts, _) = (_bytes(rows.column(c), t) for c, t in (("first", np.int64), ("next", np.int64), ("counts", np.int32)))
        del rows
        order = np.lexsort((following, first))
        a, b = first[order], following[order]
        del first, following
        starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        a, b = a[starts], b[starts]
        f = np.add.reduceat(counts[order], starts, dtype=np.int64)
        frequent = f >= support
        numbers = np.where(frequent, np.cumsum(frequent) + (part << 32), 0)
        answer = np.empty(len(order), np.int64)
        answer[order] = np.repeat(numbers, np.diff(np.append(starts, len(order))))
        del order, counts, starts
        out = [(block, group, part, x.tobytes(), None, None, None, None) for block, x in zip(blocks, np.split(answer, ends))]
        del answer
        lists = [x[frequent] for x in (numbers, a, b, f)]
        n = int(frequent.sum())
        found = pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.array([group] * n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *map(pa.array, lists)], schema=COUNTED
        )
        return pa.Table.from_batches([batch(COUNTED, out), found])

    return sent.groupBy("group", "part").applyInArrow(merge, COUNTED_DDL)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, f)`` of all phrases of 1 to ``words`` words that occur ``support`` times, and ``(lang, n)`` of all words."""
    spark = docs.sparkSession
    work = Workspace(spark, "setm")
    texts = docs.select(F.lit(None).cast("bigint").alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("group"), whole(text_col).alias("text"))
    with arrow_batches(spark):
        held = work.write(blocks(texts, words_with_borders), "blocks")
        parts = parts_for(held, PART)
        # a word's number is no other's, and only frequent words have one
        counts = _dictionary(held).filter(F.col("word") != "\n").groupBy("group", "word").agg(F.sum("n").alias("f"))
        counts = work.write(counts.withColumn("number", F.when(F.col("f") >= support, F.monotonically_increasing_id() + 1)), "words")
        totals = counts.groupBy(F.col("group").alias("lang")).agg(F.sum("f").alias("n"))
        numbers = counts.filter("number IS NOT NULL")
        relation = work.write(_numbered(held, numbers.select("group", "word", "number")), "occurrences")
        work.drop("blocks")
        level = numbers.select("group", "number", F.array("word").alias("words"), "f")
        singles, out, answers = level.select("group", F.col("number").alias("next"), F.col("words").alias("last")), [level], None
        for k in range(2, words + 1):
            sent = _first_round(relation, parts) if answers is None else _round(relation, answers, k, parts)
            counted = work.write(_counted(sent, support), f"groups-{k}")
            longer = counted.filter("number IS NOT NULL").select("group", "number", "first", "next", "f")
            before = level.select("group", F.col("number").alias("first"), F.col("words").alias("start"))
            level = longer.join(before, ["group", "first"]).join(singles, ["group", "next"]).select("group", "number", F.concat("start", "last").alias("words"), "f")
            level = work.write(level, f"phrases-{k}")
            out.append(level)
            found = counted.filter("block IS NOT NULL").select("block", F.lit(k).alias("words"), "part", "numbers")
            answers = found if answers is None else answers.unionByName(found)
    phrases = out[0]
    for level in out[1:]:
        phrases = phrases.unionByName(level)
    return phrases.select(F.col("group").alias("lang"), "words", "f"), totals


def collocations(phrases: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by the score of their weakest cut, without those that stand in a longer one half the time or more."""
    candidates = phrases.filter(F.size("words") >= 2)
    cut = candidates.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.withColumn("head", F.expr("slice(words, 1, k)")).withColumn("tail", F.expr("slice(words, k + 1, size(words) - k)"))
    cut = cut.join(phrases.select("lang", F.col("words").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(phrases.select("lang", F.col("words").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    wide = {c: f"cast({c} as decimal(19, 0))" for c in "alr"}
    score = F.expr(f"(cast({wide['a']} * {wide['a']} as decimal(31, 0)) * 1000000BD) div ({wide['l']} * {wide['r']})")
    cut = cut.withColumn("score", score)
    scored = cut.groupBy("lang", "words").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inner = candidates.filter(F.size("words") > 2).select("lang", F.col("f").alias("outer"), F.explode(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.slice("words", i, n)))).alias("slices"))
    inner = inner.select("lang", "outer", F.explode("slices").alias("words")).groupBy("lang", "words").agg(F.max("outer").alias("outer"))
    kept = scored.join(inner, ["lang", "words"], "left").filter("outer IS NULL OR 100 * outer < 50 * a")
    kept = kept.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # A language may hold most phrases: a histogram of scores says which cannot be among its first, and those left are ranked in shares before they meet.
    bins = kept.groupBy("lang", F.floor(F.col("score") / STEP).alias("bin")).agg(F.count("*").alias("size"))
    above = F.sum("size").over(Window.partitionBy("lang").orderBy(F.desc("bin"))) - F.col("size")
    least = bins.withColumn("above", above).filter(F.col("above") < top).groupBy("lang").agg(F.min("bin").alias("least"))
    kept = kept.join(least, "lang").filter(F.floor(F.col("score") / STEP) >= F.col("least"))
    order = (F.desc("score"), F.desc("a"), "phrase")
    share = F.pmod(F.xxhash64("phrase"), F.lit(partitions(phrases.sparkSession)))
    kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).filter(F.col("place") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
ones AS (SELECT piece, lang, i, w[i] AS word FROM pieces, unnest(range(1, len(w) + 1)) AS u(i)),
total AS (SELECT lang, count(*) AS n FROM ones GROUP BY lang),
f AS (
  SELECT lang, word AS phrase, 1 AS size, count(*) AS f FROM ones GROUP BY ALL HAVING count(*) >= 10
  UNION ALL
  SELECT x.lang, x.word || ' ' || y.word, 2, count(*) FROM ones x JOIN ones y ON x.piece = y.piece AND y.i = x.i + 1 GROUP BY ALL HAVING count(*) >= 10
  UNION ALL
  SELECT x.lang, x.word || ' ' || y.word || ' ' || z.word, 3, count(*)
  FROM ones x JOIN ones y ON x.piece = y.piece AND y.i = x.i + 1 JOIN ones z ON y.piece = z.piece AND z.i = y.i + 1 GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(string_split(c.phrase, ' ')[:k], ' ') AS head, array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS tail
  FROM f c, unnest([1, 2]) AS u(k) WHERE c.size > k),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, h.f AS l, t.f AS r, CAST((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY (1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f), k) AS place
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail),
outers AS (
  SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS phrase, f FROM f WHERE size = 3),
longest AS (SELECT lang, phrase, max(f) AS f FROM outers GROUP BY ALL),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, score
  FROM scored s LEFT JOIN longest o ON o.lang = s.lang AND o.phrase = s.phrase WHERE place = 1 AND (o.f IS NULL OR 100 * o.f < 50 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def op13_setm_phrases(spark, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of every language."""
    return collocations(*frequent_phrases(table(spark, sf_dir, "documents")))
