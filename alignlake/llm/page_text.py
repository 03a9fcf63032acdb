"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at block-level tags. The first pass judges each block by itself from its length, the
density of stop words, the share of its characters inside links, and where it lies: ``good``, ``bad``, or undecided
(``near``: likely text, ``short``: too little text to tell, ``outside``: prose outside the article). The second pass lets undecided
blocks inherit from their nearest decided neighbours: where both sides agree their label counts; where they
differ, ``near`` blocks turn good and ``short`` ones bad, unless only one side lies in the same section. Few stop words leave a block as
undecided as a short one. Where no block of a page has its share of stop words, the page is in another language
than theirs, and length and links alone decide.

The bounds of ``<article>`` and ``<main>`` are one feature. Blocks inside are ``near`` where the words do not show them to be good and turn
good unless their names raise a doubt, so short lines, lists of links and formulas of an article stay; doubted ones take after neighbours
inside. Prose outside stays out unless both neighbours are good.

Sections fix what the words cannot show. Navigation, page header and footer, asides, forms, scripts,
styles, blocks of nothing but buttons and elements whose class, id or role is the name of a menu, sidebar, advert, notice or reader comment
are bad whatever they say. A name counts if it is what the element is, alone or with words for parts of a page (``comments-list``), not what it has or
which state that is in (``has-sidebar``, ``comments-open``), and never on ``html``, ``body``, ``main`` and ``article``. Beside other words
(``side-effects``) it only raises a doubt, which links must confirm. If all articles of a page lie in elements so named, those names do not count.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined in page order by an empty line. Null and empty pages give an empty text. Repeated rows
are treated alike; other columns are ignored; an empty table gives an empty result. Broken
markup (unclosed or crossed tags, tags cut off at the end) never fails; unclosed elements end with their parent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT, LONG = 70, 200  # characters
FEW, MANY = 0.15, 0.25  # share of stop words
LINKS = 0.4  # share of characters inside links

# Element names and words of attribute values.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style textarea noscript template title iframe svg select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside form head dialog menu".split())
MAIN = frozenset("article main".split())
NAMES = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|nav|navbar|navigation|"
    r"menu|breadcrumbs?|sidebar|side|widget|related|share|social|comments?|disqus|replies|footer|header|masthead|login|search|pagination|"
    r"skip|toolbar|complementary|contentinfo|alert)", re.IGNORECASE)
HAVING = frozenset("has no not with without hide show".split())
STATES = frozenset("open opened closed enabled disabled on off visible hidden".split())
PARTS = frozenset(
    "area bar block body box btn button buttons col column container content bottom desktop entry form group inner left link links list main message "
    "mobile module outer overlay page panel post primary region right row secondary section site slot tag text top unit wrap wrapper".split())
UNNAMED = frozenset("html body main article".split())
STOP_WORDS = frozenset(
    "the be to of and that have with a in is it for on as are was this by from or an at not he his her they we you which all but "
    "der die das und ist nicht ein eine zu von mit den im sich auf dem für als auch des es an er sie wir aus bei "
    "le la les de des et est un une que qui dans pour pas sur du au avec en ne ce il elle nous vous plus par "
    "el los las y por con para del se una su lo como no más sus al pero".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/a-zA-Z][^<>]*>|<[!?/][^>]*\Z", re.DOTALL)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]+")
BLANK = re.compile(r"\s+")
CLOSES = {"p": BLOCKS, "li": frozenset({"li"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "tr": frozenset({"tr"}),
          "dd": frozenset({"dd", "dt"}), "dt": frozenset({"dd", "dt"}), "option": frozenset({"option"})}


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    main: bool  # inside an article or main element
    fixed: bool  # inside a boilerplate section
    named: bool  # fixed by nothing but names of elements around its article
    doubted: bool  # inside an element whose name holds a boilerplate word beside others
    buttons: int  # characters inside buttons
    heading: bool
    section: int


def hidden(attributes: str) -> bool:
    return any(name.lower() == "hidden" or name.lower() == "style" and re.search(r"display\s*:\s*none", value)
               for name, value in ATTRIBUTE.findall(attributes))


def hinted(attributes: str) -> str:
    """``sure`` if class, id or role is a name of boilerplate, ``maybe`` if one stands beside other words, else empty."""
    found = ""
    for name, value in ATTRIBUTE.findall(attributes):
        for word in value.strip("\"'").lower().split() if name.lower() in ("class", "id", "role") else ():
            words = [w for w in re.split("[_-]+", word) if w]
            names = [bool(NAMES.fullmatch(w)) for w in words]
            if not any(names) or words[0] in HAVING or words[-1] in STATES:
                continue
            if all(n or w in PARTS or w.isdigit() for n, w in zip(names, words, strict=True)):
                return "sure"
            found = "maybe"
    return found


def blocks(html: str) -> list[Block]:
    """The page's blocks with text, in page order."""
    found: list[Block] = []
    # open elements; whether each starts boilerplate, does so by its name around an article, and whether its name raises a doubt
    stack: list[tuple[str, bool, bool, bool]] = []
    parts: list[tuple[str, bool, bool]] = []  # text, inside a link, inside a button
    state = {"links": 0, "buttons": 0, "fixed": 0, "named": 0, "doubted": 0, "main": 0, "heading": 0, "section": 0}

    def add(text: str) -> None:
        parts.append((text, state["links"] > 0, state["buttons"] > 0))

    def flush() -> None:
        if parts:
            text = BLANK.sub(" ", unescape("".join(t for t, *_ in parts))).strip()
            if text:
                size = lambda which: sum(len(BLANK.sub(" ", unescape(p[0])).strip()) for p in parts if p[which])
                found.append(Block(text, size(1), state["main"] > 0, state["fixed"] > 0, state["main"] > 0 and 0 < state["fixed"] == state["named"],
                                   state["doubted"] > 0, size(2), state["heading"] > 0, state["section"]))
            parts.clear()

    def count(name: str, bad: bool, around: bool, doubt: bool, step: int) -> None:
        state["links"] += step * (name == "a")
        state["buttons"] += step * (name == "button")
        state["doubted"] += step * doubt
        state["fixed"] += step * bad
        state["named"] += step * around
        state["main"] += step * (name in MAIN)
        state["heading"] += step * (len(name) == 2 and name[0] == "h" and name[1].isdigit())

    def close(depth: int) -> None:
        while len(stack) > depth:
            name, *marks = stack.pop()
            if name in BLOCKS:
                flush()
            count(name, *marks, -1)

    at, end, low = 0, len(html), None
    while at < end:
        m = TAG.search(html, at)
        if not m:
            rest = html[at:]
            cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", rest)
            add(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        if m[1] is not None:
            add(m[1])
        name = (m[3] or "").lower()
        if not name:
            continue
        if m[2]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS:
                flush()
            if depth is not None and (name in BLOCKS or not any(n in BLOCKS for n, *_ in stack[depth:])):
                close(depth)
            continue
        if name in RAW:
            low = html.lower() if low is None else low
            if len(low) != end:  # lower-casing changed the length; fall back to a search that ignores case
                stop = re.compile(rf"</{name}", re.IGNORECASE).search(html, at)
                at = end if stop is None else stop.start()
            else:
                stop = low.find(f"</{name}", at)
                at = end if stop < 0 else stop
            if name in BLOCKS:
                flush()
            continue
        if name in VOID or m[4].endswith("/"):
            if name == "br":
                parts.append((" ", False, False))
            elif name in BLOCKS:
                flush()
            continue
        if name in BLOCKS:
            flush()
            for ended, by in CLOSES.items():
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == ended), None)
                if name in by and depth is not None and not any(n in ("table", "ul", "ol", "dl", "select") for n, *_ in stack[depth + 1 :]):
                    close(depth)
            state["section"] += name in ("section", "div", "article", "main", "aside", "nav", "header", "footer", "form")
        inside = state["main"] > 0
        by_kind = name in BOILERPLATE and not (name == "header" and inside) or hidden(m[4])
        hint = "" if name in UNNAMED else hinted(m[4])
        by_name = hint == "sure"
        stack.append((name, by_kind or by_name, by_name and not by_kind and not inside, hint == "maybe"))
        count(*stack[-1], 1)
    close(0)
    flush()
    return found


def density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def heavy(block: Block) -> bool:
    return block.linked > LINKS * len(block.text)


def first_pass(block: Block, has_main: bool, told: bool) -> str:
    size = len(block.text)
    if block.fixed or block.buttons and block.buttons >= len(BLANK.sub("", block.text)):
        return "bad"
    share = density(block.text)
    if has_main and not block.main:
        return "outside" if size >= LONG and share >= MANY and not heavy(block) else "bad"
    if heavy(block):
        return "near" if block.main and not block.doubted else "bad"
    if block.main:
        return "good" if size >= SHORT and share >= FEW and not block.doubted else "near"
    if block.doubted and size < LONG:
        return "bad" if block.linked else "short"
    if size < SHORT:
        return "bad" if block.linked else "short"
    if not told or share >= MANY:
        return "good" if size >= LONG else "near"
    return "near" if share >= FEW else "short"


def second_pass(page: list[Block], labels: list[str]) -> list[bool]:
    """Good or bad for every block; undecided ones take after their nearest decided neighbours, those inside an article after such inside one."""
    n = len(labels)

    def nearest(steps: range, inside: bool) -> list[int | None]:
        found, last = [None] * n, None
        for i in steps:
            found[i] = last
            last = i if labels[i] in ("good", "bad") and (page[i].main or not inside) else last
        return found

    before, after = [{inside: nearest(steps, inside) for inside in (False, True)} for steps in (range(n), range(n - 1, -1, -1))]
    final = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            final.append(label == "good")
            continue
        if page[i].main and not page[i].doubted:
            final.append(True)  # nothing speaks against it
            continue
        sides = [j for j in (before[page[i].main][i], after[page[i].main][i]) if j is not None]
        verdicts = {labels[j] for j in sides}
        if label == "outside":
            final.append(len(sides) == 2 and verdicts == {"good"})
        elif not sides:
            final.append(label == "near")
        elif len(verdicts) == 1:
            final.append(verdicts == {"good"})
        else:
            own = [j for j in sides if page[j].section == page[i].section]
            follows = after[page[i].main][i]
            final.append(labels[own[0]] == "good" if len(own) == 1 else label == "near" or page[i].heading and labels[follows] == "good")
    return final


def main_text(html: str | None) -> str:
    page = blocks(html) if html else []
    has_main = any(b.main and not b.fixed for b in page)
    if not has_main and any(b.named for b in page):
        page = [replace(b, fixed=b.fixed and not b.named) for b in page]
        has_main = True
    # whether the stop words are those of the page's language
    told = any(b.main for b in page) or any(len(b.text) >= SHORT and not b.fixed and not heavy(b) and density(b.text) >= FEW for b in page)
    good = second_pass(page, [first_pass(b, has_main, told) for b in page])
    return "\n\n".join(b.text for b, g in zip(page, good, strict=True) if g)


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns with ``text`` and ``n_chars`` (its code points)."""
    fields = [f for f in pages.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                piece = batch.slice(i, 256)
                texts = [main_text(h) for h in piece.column(len(fields)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[: len(fields)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*[f.name for f in fields], "text", "n_chars"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "text string", "n_chars bigint"])
    return pages.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{html_column}`").alias("__html")).mapInArrow(run, schema)
