"""HTML extraction by tag-path ratios.

Each page is read once into blocks of text with their root-to-leaf tag paths.
Per path the characters of text and the punctuation are added up over all its
blocks.  Two ratios, text per block and that times punctuation per block, are
smoothed over the paths of one sectioning element in page order, so that
headings and short paragraphs count with what they stand beside, and fused.
Links do not count, and paths that are mostly links are not smoothed, save
``h1``.  Paths inside ``article`` and ``main`` weigh ``DECLARED`` times.  Paths
whose fused ratio reaches a share of the page's best are content, on every
page.  What a page declares as something else never is:
navigation, header and footer elements, forms, scripts, styles, and elements
whose role, or whose class or id as a whole, says menu, advert, notice, sidebar
or comments.  A class or id that has such a word among others
(``has-sidebar``) rejects its element only if the text agrees: mostly links,
or ratios far below the page's best, and not the greater part of the page.

Null html and html without content give the empty text.  Unclosed, crossed
and stray tags are allowed: a closing tag ends the nearest open element of its
name, ``p``, ``li``, ``td`` and the like end where HTML says they do.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SECTIONS = frozenset("html body article main section div td table center content".split())
#: Elements that are never part of an article.
OTHER = frozenset("nav footer aside form script style button select option menu dialog head noscript template iframe svg math textarea".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
#: Words in a class or id that name something other than the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored teaser "
    "nav navbar navigation navi menu menubar breadcrumb breadcrumbs pagination pager toc header masthead topbar footer bottom colophon "
    "sidebar side rail aside widget widgets related recommended recommendations more popular trending "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer copyright legal "
    "comment comments commentlist reply replies respond discussion disqus feedback reactions "
    "share sharing social follow subscribe subscription newsletter signup login search form tags".split()
)
#: Words that say nothing beside one of NAMES.
NEUTRAL = frozenset("list area container wrapper wrap box block inner outer left right bar col column row item items group panel the".split())
ENDS = {  # an opening tag on the left ends an open element on the right
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",), "tbody": ("td", "th", "tr", "thead"), "tfoot": ("td", "th", "tr", "tbody"),
}
HOLDS = frozenset("ul ol dl table select html body article main section div nav aside".split())
#: The weight of a path inside article or main; others have 1.
DECLARED = 2.0
#: An element with a doubtful name is content from this share of the best path's ratio.
DOUBTED = 0.25
PUNCTUATION = frozenset(".,;:!?…。，、！？")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    path: str
    section: int
    kept: bool
    linked: int  # characters inside links
    doubts: tuple[int, ...] = ()  # the elements around it whose name has a word of NAMES among others


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    holder: list[str] = field(default_factory=list)  # the path of every sectioning element


def _named(value: str) -> float:
    """How surely a class or id names something other than the article: 1, 0, or 0.5 where other words stand beside."""
    words = [w.lower() for w in _NAME.findall(_HUMP.sub(" ", value))]
    if not any(w in NAMES for w in words):
        return 0.0
    return 1.0 if all(w in NAMES or w in NEUTRAL or len(w) == 1 for w in words) else 0.5


def _other(name: str, attributes: str, within: set[str]) -> float:
    """Whether an element is never content: 1, 0, or 0.5 where its text has to agree."""
    if name in OTHER or name == "header" and not within & {"article", "main"}:
        return 1.0
    if not attributes or name in ("html", "body"):
        return 0.0
    named = 0.0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(value.strip("\"'"))
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 1.0
        if key == "role" and value.lower() in ROLES:
            return 1.0
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 1.0
        if key in ("class", "id"):
            named = max(named, _named(value))
    return named


def read_blocks(source: str) -> _Page:
    """Blocks in page order; inline markup and line breaks do not end a block."""
    page = _Page(holder=["html"])
    # name, within something other, section, declared or named other itself, doubts
    stack: list[tuple[str, bool, int, bool, tuple[int, ...]]] = []
    doubted = 0
    labels: list[str] = []
    parts: list[str] = []
    state = {"kept": True, "section": 0, "path": "html", "linked": 0, "doubts": ()}

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            page.blocks.append(Block(text, state["path"], state["section"], state["kept"], min(state["linked"], len(text)), state["doubts"]))
        parts.clear()
        state["linked"] = 0

    def settle() -> None:
        state["kept"] = not (stack and stack[-1][1])
        state["section"] = stack[-1][2] if stack else 0
        state["doubts"] = stack[-1][4] if stack else ()
        # inline markup does not make another path
        state["path"] = ">".join(x for x in labels if x not in INLINE) or "html"

    def close(depth: int) -> None:
        if any(x[0] not in INLINE for x in stack[depth:]):
            flush()
        elif any(x[3] for x in stack[depth:]):
            flush()
        del stack[depth:], labels[depth:]
        settle()

    at = 0
    while at < len(source):
        m = _TOKEN.search(source, at)
        stop = m.start() if m else len(source)
        if stop > at:
            parts.append(html.unescape(source[at:stop]))
            if any(x[0] == "a" for x in stack):
                state["linked"] += len(parts[-1])
        if not m:
            break
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name == "p" and not any(x[0] == "p" for x in stack):
                flush()
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if not m[2]:
            continue
        name, attributes = m[2].lower(), m[3] or ""
        if name in VOID:
            if name == "br":
                parts.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if attributes.endswith("/") and name not in INLINE and name not in SECTIONS:
            continue
        if name not in INLINE:
            flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
            closes = ENDS.get(name, ())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in closes:
                    close(depth)
                elif stack[depth][0] in HOLDS:
                    break
        other = _other(name, attributes, {x[0] for x in stack})
        if other and name in INLINE:
            flush()
        section = stack[-1][2] if stack else 0
        labels.append(name)
        if name in SECTIONS:
            page.holder.append(">".join(labels))
            section = len(page.holder) - 1
        doubts = stack[-1][4] if stack else ()
        if other == 0.5:
            doubted += 1
            doubts = (*doubts, doubted)
        stack.append((name, other == 1 or bool(stack and stack[-1][1]), section, other > 0, doubts))
        settle()
    flush()
    return page


def _smooth(values: list[float], width: float = 1.0) -> list[float]:
    reach = math.ceil(width)
    weights = [math.exp(-(d * d) / (2 * width * width)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        near = [(w, values[i + d]) for d, w in zip(range(-reach, reach + 1), weights) if 0 <= i + d < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def _weight(holder: str) -> float:
    return DECLARED if {"article", "main"} & set(holder.split(">")) else 1.0


def _ratios(blocks: list[Block], page: _Page) -> dict[str, float]:
    """The fused ratio of every path."""
    sums: dict[str, list[float]] = {}
    holders: dict[str, list[str]] = {}
    for b in blocks:
        if b.path not in sums:
            holders.setdefault(page.holder[b.section], []).append(b.path)
        entry = sums.setdefault(b.path, [0, 0, 0, 0])
        entry[0] += len(b.text) - b.linked
        entry[1] += sum(map(b.text.count, PUNCTUATION))
        entry[2] += 1
        entry[3] += b.linked
    out: dict[str, float] = {}
    for holder, paths in holders.items():
        plain = [n / c for n, _, c, _ in (sums[p] for p in paths)]
        marked = [n / c * (1 + marks / c) for n, marks, c, _ in (sums[p] for p in paths)]
        weight = _weight(holder)
        for path, a, b, own, other in zip(paths, _smooth(plain), _smooth(marked), plain, marked):
            n, _, _, linked = sums[path]
            if linked > n and not path.endswith(">h1"):  # text around a list of links does not speak for it
                a, b = own, other
            out[path] = weight * math.sqrt(a * b)
    return out


def _rejected(blocks: list[Block], page: _Page, best: float) -> set[int]:
    """The doubts that the text of their elements confirms."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        for d in b.doubts:
            entry = sums.setdefault(d, [0, 0, 0, 0, 1.0])
            entry[0] += len(b.text) - b.linked
            entry[1] += sum(map(b.text.count, PUNCTUATION))
            entry[2] += 1
            entry[3] += b.linked
            entry[4] = max(entry[4], _weight(page.holder[b.section]))
    everything = sum(len(b.text) - b.linked for b in blocks)
    return {d for d, (n, p, c, linked, weight) in sums.items() if 2 * n <= everything and (linked >= n or weight * n / c * math.sqrt(1 + p / c) < DOUBTED * best)}


def content(page: _Page, share: float = 0.1) -> list[Block]:
    """The blocks of content paths in page order (``share`` of the best path's fused ratio is the threshold)."""
    blocks = [b for b in page.blocks if b.kept]
    if not blocks:
        return []
    score = _ratios(blocks, page)
    rejected = _rejected(blocks, page, max(score.values()))
    if rejected:
        blocks = [b for b in blocks if rejected.isdisjoint(b.doubts)]
        if not blocks:
            return []
        score = _ratios(blocks, page)
    limit = share * max(score.values())
    return [b for b in blocks if score[b.path] >= limit and (score[b.path] or not limit)]


def main_text(source: str | None, share: float = 0.1) -> str:
    return "\n".join(b.text for b in content(read_blocks(source or ""), share))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", share: float = 0.1) -> DataFrame:
    """``(id, text)`` of every row; ids may repeat or be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x, share) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(texts, pa.string())], names=[*b.schema.names[:-1], "text"])

    kept = [F.col(c) for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(*kept, F.col(html_col).alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string")


def op2_tag_path_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", F.col("text"), F.char_length("text").cast("bigint").alias("n_chars"))
