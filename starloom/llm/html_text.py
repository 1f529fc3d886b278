"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block elements. Pass one decides blocks on their own: blocks of
navigation, header, footer, sidebar, notice, advert, form and comment containers and blocks that are
mostly links are boilerplate; long blocks with enough stop words and few links are text; the
rest is undecided. Pass two gives undecided blocks the label of their nearest decided neighbours,
within the article element if there is one: there, a block is text unless it lies between boilerplate.
What a container sets apart says nothing on its neighbours. Stop words are those of English, French, German and
Spanish; on a page where no block passes (of another language, of short paragraphs, a listing), blocks with few
links that follow one another are text if they are long together. A
page with an article (or main) element has its text there; without one, blocks anywhere count.

Class and id only hint at what a container is. Words that wrappers of whole articles have too (widget,
search, share) set it apart only if it has no block that passes for text; words of the layout (sidebar,
menu) unless it has as much text as the page has outside such containers. A main element ends the marks
around it. So does an article, if what is in such articles is at least as much as the text elsewhere;
where there is text elsewhere they count as any other part of the page. Comments are the
exception, as theirs are articles too; a paragraph by itself is no container of comments. Adverts, cookie notices and
comments are always set apart otherwise, but a longer name that only has such a word in it (ad-free-reading,
cookie-recipes) gives way if the page would have no text at all.

Text is decoded (character references), white space inside a block becomes one space, blocks are
trimmed and joined by one line feed. Formulas (math) are text in their line, without the annotations in
other notations that are not displayed; the content of xmp is a block of literal text.

Defined results for odd input: a null or empty page has the empty text; markup that ends early or
is never closed is closed by the end of the page; text without any markup is one block; a page of
any length is read whole; repeated rows are extracted one by one; a null id is carried; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import tidy_batches

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their there they this to was were what when which who will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous "
    "aber als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht noch oder sich sie sind so und von vor war wie wir zu zum zur "
    "al como con del el ella era ese esta este fue hay la las lo los más muy no o para pero por que se si sin sobre su sus también un una uno y ya".split())
# Elements that start and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Elements whose text is never page text.
OUTSIDE = frozenset("head nav aside footer form menu dialog fieldset select button textarea search".split())
# Elements whose content is not markup.
NOTES = frozenset("annotation annotation-xml".split())  # in math only: what the formula is in another notation, not displayed
RAW = frozenset("script style textarea title noscript template svg iframe object audio video canvas noembed noframes".split())
# Words in class, id and role attributes that mark what surrounds a text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs cookie cookies consent comment comments commentlist disqus disclaimer footer form gdpr header login "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices notification alert popup promo promoted promotion related reply replies respond search share sharing sidebar sidebars signup social "
    "sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets complementary contentinfo".split())
# Of these, words that wrappers of articles have too, words of the layout, and words for what readers say.
DOUBTFUL = frozenset(
    "alert banner disclaimer form header login modal notice notices notification promo promoted promotion related search share sharing social subscribe subscription toolbar widget widgets".split())
LAYOUT = frozenset("footer masthead menu nav navbar navigation newsletter sidebar sidebars topbar".split())
DISCUSSION = frozenset("comment comments commentlist disqus reply replies respond".split())
# Parts of longer names that say what a container looks like, not what it is.
PLAIN_PARTS = frozenset(
    "area bar bg big block body bottom box btn button card cell col column container content desktop element field fixed flex float frame full grid group h half holder home icon id image img in "
    "inline inner is item items js l label large layer layout left line link links list main md medium mid middle mobile module new no of on outer page pane panel part placeholder pos primary r region right "
    "row rows secondary section side single site size slot sm small space spot static sticky sub tab table text the thin tile title to top txt unit v view w wide wrap wrapper x xl y zone".split())
AUTO_CLOSE = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# An opened block of these kinds ends an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "head"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_XMP_END = re.compile(r"</xmp(?=[\s/>]|\Z)[^>]*>?", re.I)
_MARK = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    words: str
    links: int
    outside: bool
    article: int
    heading: bool
    listed: bool
    box: int = 0  # the innermost marked container around it, within the article if that ended the marks around it
    shed: int = 0  # the innermost container whose mark an article around the block ended
    label: str = "undecided"


@dataclass(frozen=True)
class Rules:
    long_chars: int = 70
    stop_density: float = 0.10
    link_density: float = 0.50


@dataclass
class _Open:
    tag: str
    outside: bool
    article: int
    listed: bool
    header: bool = False
    hidden: bool = field(default=False)
    box: int = 0
    shed: int = 0


@dataclass
class Box:
    """A container that its class or id marks: doubtful, layout, discussion, firm, or mixed (firm, if it isn't part of another name)."""
    kind: str
    parent: int


def _kind(marks: set[str]) -> str:
    rest = marks - DOUBTFUL
    return "discussion" if rest & DISCUSSION else "firm" if rest - LAYOUT else "layout" if rest else "doubtful"


def _marked(attributes: str) -> str:
    """"outside" by role or as hidden, the kind of mark that class and id make, or nothing."""
    marks: set[str] = set()
    sure = False
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "outside"
        for token in value.split() if name != "aria-hidden" else ():
            parts = _MARK.findall(token)
            # "ad", "ad-box", "site-header", but not "article-header" or "has-sidebar"
            found = MARKS.intersection(parts)
            if found and (parts[0] not in ("article", "entry", "post", "content", "has", "with", "no", "main")
                          or (parts[0] in ("article", "entry", "post", "content") and "header" not in parts)):
                if name == "role":
                    return "outside"
                marks |= found
                sure |= bool(found - DOUBTFUL - LAYOUT) and MARKS.union(PLAIN_PARTS).issuperset(parts)
    kind = _kind(marks) if marks else ""
    return "mixed" if kind in ("firm", "discussion") and not sure else kind


def blocks(page: str) -> tuple[list[Block], list[Box]]:
    """The blocks, and the marked containers that they name by number; the first stands for none."""
    out: list[Block] = []
    boxes = [Box("", 0)]
    stack = [_Open("", False, 0, False)]
    text: list[str] = []
    linked = [0, 0]  # open links, characters in links of this block
    articles = 0
    heading = 0
    math = False

    def flush() -> None:
        joined = "".join(text)
        words = " ".join((html.unescape(joined) if "&" in joined else joined).split())
        if words:
            top = stack[-1]
            outside = top.outside or (top.header and not heading)
            out.append(Block(words, min(linked[1], len(words)), outside, top.article, heading > 0, top.listed, top.box, top.shed))
        text.clear()
        linked[1] = 0

    def close(to: int) -> None:
        nonlocal heading
        while len(stack) > to:
            if stack.pop().tag in HEADINGS:
                heading -= 1

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at:
            text.append(page[at:end])
            if linked[0]:
                linked[1] += len(page[at:end].strip())
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                linked[0] = 0
            elif tag == "math":
                math = False
            elif tag in BLOCKS:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                linked[0] = 0
            continue
        if (tag in RAW or (math and tag in NOTES)) and not m[3].endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else size
            text.append(" ")
            continue
        if tag == "a":
            linked[0] = 1
        elif tag == "math":
            math = not m[3].endswith("/")
        elif tag == "br":
            text.append(" ")
        elif tag in OUTSIDE or tag in BLOCKS:
            flush()
            linked[0] = 0
            if tag == "hr":
                continue
            for closes in (AUTO_CLOSE.get(tag, ()), ("p",) if tag in ENDS_P else ()):
                k = len(stack) - 1
                if k and stack[k].tag in closes:
                    close(k)
            top = stack[-1]
            if tag in ("article", "main") and not top.article:
                articles += 1
            article = top.article or (articles if tag in ("article", "main") else 0)
            mark = "outside" if tag in OUTSIDE else "" if tag in ("html", "body") or tag in HEADINGS else _marked(m[3])
            if tag == "p" and mark == "discussion":
                mark = ""
            header = top.header or (tag == "header" and article > 0)
            outside = top.outside or (mark == "outside" and not (tag in ("article", "main"))) or (tag == "header" and not article)
            box, shed = top.box, top.shed
            if tag == "main":
                box = shed = 0
            elif tag == "article":
                if box and boxes[box].kind != "discussion":
                    box, shed = 0, box
            elif mark and mark != "outside" and boxes[box].kind not in ("firm", "discussion"):  # all is apart in those
                boxes.append(Box(mark, box))
                box = len(boxes) - 1
            stack.append(_Open(tag, outside, article, top.listed or tag in ("ul", "ol", "menu"), header, box=box, shed=shed))
            if tag in HEADINGS:
                heading += 1
            if tag == "xmp":  # what it holds is literal text
                stop = _XMP_END.search(page, at)
                text.append(html.escape(page[at:stop.start() if stop else size]))
                at = stop.end() if stop else size
                flush()
                close(len(stack) - 1)
    flush()
    return out, boxes


def _passes(b: Block, rules: Rules) -> bool:
    """A long block with few links and enough stop words."""
    if len(b.words) < rules.long_chars or b.links > rules.link_density * len(b.words):
        return False
    words = _WORD.findall(b.words.lower())
    return sum(map(STOP_WORDS.__contains__, words)) >= rules.stop_density * len(words)


def _long_runs(found: list[Block], rules: Rules) -> list[bool]:
    """Which blocks belong to a long run of blocks with few links, in one container and article."""
    out, start = [False] * len(found), 0
    while start < len(found):
        first, end, chars = found[start], start, 0
        while end < len(found):
            b = found[end]
            if b.outside or b.links > rules.link_density * len(b.words) or (b.box, b.shed, b.article) != (first.box, first.shed, first.article):
                break
            chars += len(b.words)
            end += 1
        if chars >= rules.long_chars:
            out[start:end] = [True] * (end - start)
        start = max(end, start + 1)
    return out


def set_apart(found: list[Block], boxes: list[Box], good: list[bool], lenient: bool = False) -> None:
    """Sets ``outside`` where the mark of a container holds, and ``article`` to 0 where an article counts as any other part.
    ``lenient``: mixed marks only hint, as doubtful ones do."""
    kinds = ["doubtful" if lenient and b.kind == "mixed" else "firm" if b.kind == "mixed" else b.kind for b in boxes]
    inside = [0] * len(boxes)  # characters of text in each container
    free = layout = 0
    for b, ok in zip(found, good):
        if ok and not b.outside:
            inside[b.box] += len(b.words)
            inside[b.shed] += len(b.words)
    for k in range(len(boxes) - 1, 0, -1):
        inside[boxes[k].parent] += inside[k] if kinds[k] in ("doubtful", "layout") else 0
    apart, in_layout = [False] * len(boxes), [False] * len(boxes)
    for k in range(1, len(boxes)):
        up, kind = boxes[k].parent, kinds[k]
        in_layout[k] = in_layout[up] or kind == "layout"
        apart[k] = apart[up] or kind in ("firm", "discussion") or (kind == "doubtful" and not inside[k])
    shed = 0
    for b, ok in zip(found, good):
        if ok and not b.outside and not apart[b.box]:
            if b.shed:
                shed += len(b.words)
            elif in_layout[b.box]:
                layout += len(b.words)
            else:
                free += len(b.words)
    if not 0 < layout >= free:
        apart = [a or i for a, i in zip(apart, in_layout)]
    else:
        free += layout
    for b in found:
        if apart[b.box] or (b.shed and shed < free and apart[b.shed]):
            b.outside = True
        elif b.shed and free:
            b.article = 0


def classify(found: list[Block], rules: Rules = Rules(), boxes: list[Box] | None = None) -> list[bool]:
    """Which blocks are page text."""
    good = [_passes(b, rules) for b in found]
    if boxes and len(boxes) > 1:
        runs = _long_runs(found, rules)
        kinds = {k for k, box in enumerate(boxes) if box.kind in ("firm", "discussion", "mixed")}
        sure = any(ok and not b.outside and b.box not in kinds for b, ok in zip(found, good))
        before = [(b.outside, b.article) for b in found]
        set_apart(found, boxes, good if sure else runs)
        if all(b.outside or not (ok or run or b.article) for b, ok, run in zip(found, good, runs)):  # no text is left
            for b, (outside, article) in zip(found, before):
                b.outside, b.article = outside, article
            kinds = {k for k, box in enumerate(boxes) if box.kind in ("firm", "discussion")}
            sure = any(ok and not b.outside and b.box not in kinds for b, ok in zip(found, good))
            set_apart(found, boxes, good if sure else runs, lenient=True)
    for b, ok in zip(found, good):
        density = b.links / len(b.words)
        if b.outside or (density > rules.link_density and (b.listed or not b.article)):
            b.label = "boilerplate"
        elif ok:
            b.label = "text"
    if all(b.label != "text" for b in found):
        for b, ok in zip(found, _long_runs(found, rules)):
            if ok and b.label == "undecided":
                b.label = "text"
    whole = any(b.article and b.label != "boilerplate" for b in found)
    order = [i for i, b in enumerate(found) if not whole or b.article]
    left: dict[int, str] = {}
    right: dict[int, str] = {}
    for labels, way in ((left, order), (right, order[::-1])):
        near, region = "", -1
        for i in way:
            b = found[i]
            if whole and b.article != region:
                near, region = "", b.article
            if b.label == "undecided":
                labels[i] = near
            elif not b.outside:  # what is set apart says nothing on the text around it
                near = b.label
    keep = [False] * len(found)
    for i in order:
        b = found[i]
        if b.label == "undecided":
            sides = {left[i], right[i]}
            if whole:
                keep[i] = sides != {"boilerplate"}
            elif len(b.words) >= rules.long_chars or b.heading:
                keep[i] = "text" in sides or sides == {""}
            else:
                keep[i] = sides <= {"text", ""}
        else:
            keep[i] = b.label == "text"
    return keep


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    if not page:
        return ""
    found, boxes = blocks(page)
    return "\n".join(b.words for b, keep in zip(found, classify(found, rules, boxes)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: Rules = Rules()) -> DataFrame:
    """(``id_col``, ``url_col``, text, n_chars) of every row; no shuffle."""
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col)) + ", text string, n_chars long"

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                text = [main_text(p, rules) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                                 names=[id_col, url_col, "text", "n_chars"])

    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(tidy_batches(run), schema)
