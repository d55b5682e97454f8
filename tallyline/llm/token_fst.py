"""Token counts by a compiled finite-state transducer.

The merge rules of a word-level byte-pair encoding become a deterministic
transducer over bytes.  A state holds what later bytes can depend on: the
longest suffix read that still begins some token, and for every place in that
suffix the last token of the encoding up to there with its count, relative to
the count so far.  Each transition is annotated with the tokens that it adds
(fewer than none where a longer token swallows earlier ones); a word's last
byte has transitions of its own.  States are compiled when first reached, and
all words of a block walk through the tables in step.

A text is cut into chunks that any executor may count alone.  As a word can
span chunks, a chunk's result is a state map: what it adds between its first
and last white space, and the open text before and after, to be joined with
that of its neighbours.  Maps compose associatively, so a document's count is
a prefix scan over its chunk maps, of any order of grouping.

Null text counts as empty (no tokens).  Rows with equal ids stay apart.
Special tokens inside a text count as one each, as the vocabulary's library
has it by default; no begin or end tokens are added.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import table, whole

VOCABULARY = "word_bpe_49k.json"
CHUNK = 1 << 16
BLOCK = 1 << 21
CACHE = 250_000
STATES = 250_000
SPLIT = re.compile(r"[ \t\n\r\x0b\x0c]+")

Token = tuple[int, ...]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_letter() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: bytes that print keep their letter, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
    return letters


class Transducer:
    """Bytes of a word to its number of tokens; symbols 256 to 511 stand for a word's last byte.

    Transitions are kept in one open-addressed table of (state, symbol), so
    that a block of words is looked up at once.
    """

    def __init__(self, merges: Iterable[tuple[str, str]], limit: int = STATES):
        letters = _byte_of_letter()

        def symbols(text: str) -> Token:
            ends = len(text) > 4 and text.endswith("</w>")
            body = [letters[c] for c in (text[:-4] if ends else text)]
            return (*body[:-1], body[-1] + 256) if ends else tuple(body)

        self.tokens: list[Token] = [(b,) for b in range(512)]
        number = {t: i for i, t in enumerate(self.tokens)}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair of tokens: rank, token
        for rank, (a, b) in enumerate(merges):
            left, right = symbols(a), symbols(b)
            if left + right not in number:
                number[left + right] = len(self.tokens)
                self.tokens.append(left + right)
            self.merged.setdefault((number[left], number[right]), (rank, number[left + right]))
        # the trie of all tokens, with the link of each node to its longest proper suffix in the trie
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        levels: list[list[tuple[int, int, int]]] = [[]]
        for t, spelled in enumerate(self.tokens):
            node = 0
            for depth, symbol in enumerate(spelled):
                below = self.child.get(node * 512 + symbol)
                if below is None:
                    below = self.child[node * 512 + symbol] = len(self.token_at)
                    self.token_at.append(-1)
                    while len(levels) <= depth:
                        levels.append([])
                    levels[depth].append((node, symbol, below))
                node = below
            self.token_at[node] = t
        self.shorter = [-1] * len(self.token_at)
        for level in levels:
            for node, symbol, below in level:
                up = self.shorter[node]
                while up >= 0 and up * 512 + symbol not in self.child:
                    up = self.shorter[up]
                self.shorter[below] = self.child[up * 512 + symbol] if up >= 0 else 0
        self.limit = limit
        self._valid: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.index: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self._table(1 << 16)
        self._state((0, -1, 0))

    def _table(self, size: int) -> None:
        self.keys = np.full(size, -1, np.int64)
        self.next = np.zeros(size, np.int32)
        self.adds = np.zeros(size, np.int16)
        self.used, self.shift = 0, np.uint64(64 - size.bit_length() + 1)

    def _state(self, state: tuple) -> int:
        at = self.index.get(state)
        if at is None:
            at = self.index[state] = len(self.states)
            self.states.append(state)
        return at

    def encode(self, parts: list[int]) -> list[int]:
        """The merge rules one by one: lowest rank first, leftmost of equals."""
        parts = list(parts)
        none = (1 << 60, -1)
        while len(parts) > 1:
            (rank, token), i = min((self.merged.get(p, none), i) for i, p in enumerate(zip(parts, parts[1:])))
            if token < 0:
                break
            parts[i : i + 2] = [token]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two stay side by side; tokens that do so pairwise are an encoding."""
        key = left << 20 | right
        known = self._valid.get(key)
        if known is None:
            if len(self._valid) > 400_000:
                self._valid.clear()
            known = self._valid[key] = self.encode([*self.tokens[left], *self.tokens[right]]) == [left, right]
        return known

    def _compile(self, at: int, symbol: int) -> tuple[int, int]:
        """The next state and the tokens added.  A state is the deepest node, then the last token and count at its place, and so on along the suffix links."""
        node, *places = self.states[at]
        child, token_at, shorter = self.child, self.token_at, self.shorter
        token, added, alive, kept, i = -1, 0, -1, [], 0
        while node >= 0:
            below = child.get(node * 512 + symbol)
            if below is not None:
                last, count = places[i], places[i + 1]
                if alive < 0:
                    alive = below
                kept += (last, count)
                if token < 0 <= token_at[below] and (last < 0 or self._fits(last, token_at[below])):
                    token, added = token_at[below], count + 1
            node = shorter[node]
            i += 2
        if symbol >= 256:
            return 0, added
        for j in range(1, len(kept), 2):
            kept[j] -= added
        return self._state((max(alive, 0), *kept, token, 0)), added

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free slot where its search ends."""
        mask = len(self.keys) - 1
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        found = self.keys[slots]
        rest = np.flatnonzero((found != keys) & (found != -1))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & mask
            found = self.keys[slots[rest]]
            rest = rest[(found != keys[rest]) & (found != -1)]
        return slots

    def _insert(self, keys: np.ndarray) -> None:
        if (self.used + len(keys)) * 2 > len(self.keys):
            full = self.keys >= 0
            held = self.keys[full], self.next[full], self.adds[full]
            self._table(max(2 * len(self.keys), 4 * len(keys)))
            self._put(*held)
        made = [self._compile(k >> 9, k & 511) for k in keys.tolist()]
        self._put(keys, *np.array(made, np.int64).reshape(-1, 2).T)

    def _put(self, keys: np.ndarray, following: np.ndarray, adds: np.ndarray) -> None:
        """Adds keys that the table lacks; those that meet in a slot take turns."""
        self.used += len(keys)
        while len(keys):
            slots = self._slots(keys)
            first = np.unique(slots, return_index=True)[1]
            self.keys[slots[first]], self.next[slots[first]], self.adds[slots[first]] = keys[first], following[first], adds[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, following, adds = keys[rest], following[rest], adds[rest]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each (not empty) word; all words advance by a byte at a time."""
        if len(self.states) > self.limit:
            self._restart()
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        lengths = sizes[order]
        state = np.zeros(len(words), np.int64)
        total = np.zeros(len(words), np.int64)
        going, step = len(words), 0
        while going:
            keys = state[:going] * 512 + letters[starts[:going] + step] + 256 * (lengths[:going] == step + 1)
            slots = self._slots(keys)
            unknown = keys[self.keys[slots] < 0]
            if len(unknown):
                self._insert(np.unique(unknown))
                slots = self._slots(keys)
            total[:going] += self.adds[slots]
            step += 1
            longer = int(np.searchsorted(-lengths[:going], -step, side="left"))
            state[:longer] = self.next[slots[:longer]]
            going = longer
        out = np.empty(len(words), np.int64)
        out[order] = total
        return out


class Counter:
    """Tokens of text between white space, for one vocabulary file of the word-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.machine = Transducer(tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in spec["model"]["merges"])
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.fresh: dict[str, int] = {"": 0}
        self.old: dict[str, int] = {}

    def normal(self, piece: str) -> list[bytes]:
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return [w.encode() for w in self.words.findall(piece.lower())]

    def learn(self, pieces: Iterable[str]) -> None:
        """Counts of the pieces into the cache; the less recent half of it goes when it is full."""
        new, words, owner, base = [], [], [], []
        for p in pieces:
            if p in self.fresh:
                continue
            if p in self.old:
                self.fresh[p] = self.old[p]
                continue
            parts, marks = [p], 0
            if self.special is not None and "<|" in p:
                parts = self.special.split(p)
                marks = len(parts) - 1
            for part in parts:
                found = self.normal(part)
                words += found
                owner += [len(new)] * len(found)
            new.append(p)
            base.append(marks)
        if new:
            total = np.array(base, np.int64)
            if words:
                np.add.at(total, np.array(owner), self.machine.counts(words))
            self.fresh.update(zip(new, total.tolist()))

    def turn(self) -> None:
        if len(self.fresh) > CACHE:
            self.old, self.fresh = self.fresh, {"": 0}


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def chunk_maps(path: str, texts: list[str]) -> list[tuple[str, int, str, bool]]:
    """The state map of each chunk: open text before, tokens within, open text after, whether it has white space at all."""
    count = counter(path)
    out = []
    for start in _blocks(texts):
        block = [SPLIT.split(t) for t in texts[start]]
        count.turn()
        count.learn(set().union(*(b[1:-1] for b in block)))
        known = count.fresh.__getitem__
        for pieces in block:
            if len(pieces) == 1:
                out.append((pieces[0], 0, "", False))
            else:
                out.append((pieces[0], sum(map(known, pieces[1:-1])), pieces[-1], True))
    return out


def compose(path: str, documents: list[list[tuple[str, int, str, bool]]]) -> list[int]:
    """Scans the chunk maps of each document, in order, to its count of tokens."""
    totals, joints = [], []
    for maps in documents:
        total, pending = 0, []
        joined: list[str] = []
        for head, within, tail, parted in maps:
            pending.append(head)
            if parted:
                joined.append("".join(pending))
                pending = [tail]
                total += within
        joined.append("".join(pending))
        totals.append(total)
        joints.append(joined)
    count = counter(path)
    count.turn()
    count.learn({p for joined in joints for p in joined})
    return [t + sum(map(count.fresh.__getitem__, joined)) for t, joined in zip(totals, joints)]


def _blocks(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every row."""
    path = vocabulary or vocabulary_path()

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            head, within, tail, parted = zip(*chunk_maps(path, b.column("part").to_pylist())) if b.num_rows else ((), (), (), ())
            arrays = [*(b.column(c) for c in ("row", "id", "size", "place")), pa.array(head, pa.string()), pa.array(within, pa.int64()), pa.array(tail, pa.string()), pa.array(parted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "size", "place", "head", "within", "tail", "parted"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = compose(path, [[(m["head"], m["within"], m["tail"], m["parted"]) for m in ms] for ms in b.column("maps").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("size"), pa.array(found, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    kind = dict(rows.dtypes)["id"]
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.char_length("text") - 1) / chunk).cast("int")))
    parts = F.transform(cuts, lambda i: F.struct(i.alias("place"), F.substr("text", i * chunk + 1, F.lit(chunk)).alias("part")))
    single = F.array(F.struct(F.lit(0).alias("place"), F.col("text").alias("part")))
    chunks = rows.select(
        "row", "id", F.octet_length("text").cast("bigint").alias("size"),
        F.explode(F.when(F.char_length("text") <= chunk, single).otherwise(parts)).alias("c"),
    ).select("row", "id", "size", "c.place", "c.part")
    found = chunks.mapInArrow(maps, f"row bigint, id {kind}, size bigint, place int, head string, within bigint, tail string, parted boolean")
    # the maps of a document are few: one for every 65,536 code points
    scans = found.groupBy("row", "id", "size").agg(F.sort_array(F.collect_list(F.struct("place", "head", "within", "tail", "parted"))).alias("maps"))
    return scans.mapInArrow(scan, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")


def op3_token_counts(spark, sf_dir: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole document, and whether they exceed ``limit``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return token_counts(docs).withColumn("over_limit", F.col("n_tokens") > limit)
