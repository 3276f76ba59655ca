"""Main text of web pages by two passes over their blocks.

A page becomes a list of blocks: the text between block tags, with its link
text and the elements around it. Elements that never hold article text
(scripts, menus, forms, asides and the like) are dropped. Blocks in elements
whose class, id or role says boilerplate are left out, unless they are in an
article or main element inside of it, or the element is a wrapper: its marks
are words of layout and it holds most of the page's long text. The first pass labels the blocks of every page by link
density, length and the share of stop words (by density and length alone where
the language is none whose stop words are known); blocks these cannot tell are left
open. In the second pass open blocks inside an article or main element are
text, and the others take the label of the nearest labelled neighbour that is
outside too (a tie is boilerplate). So the element is a prior of its own
blocks only, and decides nothing for the rest of the page.

Defined cases: NULL or empty html has no text; broken markup (tags that are
not closed, a page that ends inside one) is read as far as it goes; rows that
repeat are read alike; other columns pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import row_struct

_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|title"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))"""
    r"""|<[!?/][^>]*(?:>|\Z)|[^<]+|<""",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>=/])|aria-hidden\s*=\s*["']?true)""", re.IGNORECASE)

_CONTENT = frozenset(["article", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED = frozenset(
    "head nav header footer aside form menu dialog button select option datalist label input fieldset audio video".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end is known only if it is written; others (p, li, b) do not nest blocks.
_BOXES = _CONTENT | _DROPPED - {"input"} | frozenset("html body div section ul ol dl table figure blockquote details center".split())
_BLOCKS = _BOXES | frozenset(
    "p li dt dd tr td th caption h1 h2 h3 h4 h5 h6 hr pre address figcaption summary legend tbody thead tfoot hgroup".split()
)
# fixed values: words of class, id and role that mark boilerplate
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments complementary "
    "consent contentinfo cookie cookies copyright disqus footer form gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay paywall popup promo promotion promoted related reply replies respond search "
    "share sharing sidebar social sponsor sponsored subscribe subscription toc toolbar widget".split()
)
# fixed values: frequent words of English, French, German and Spanish
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to "
    "was were which will with you au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour "
    "que qui se son sur un une als auch auf aus bei das dem den der die ein eine einen er es für ich ist mit nach nicht sich "
    "sie sind und von war wie wird zu zum al como con del el ella entre las lo los más no para pero por si sin su sus una y".split()
)
# fixed values: of them, words of the page's layout, which a wrapper of the text may bear too
_LAYOUT = frozenset(
    "alert banner form header masthead menu nav navbar navigation notice notices notification overlay related search share "
    "sharing sidebar social toc toolbar widget".split()
)
_AROUND = re.compile(r"(?:no|not|has|have|with|without)[-_]")
# fixed values: start tags that end an open element whose end tag may be omitted
_ENDS = dict.fromkeys(["p"], _BLOCKS) | dict.fromkeys(["dt", "dd"], {"dt", "dd"}) | dict.fromkeys(["td", "th"], {"td", "th", "tr"})
_ENDS |= {"li": {"li"}, "tr": {"tr"}} | dict.fromkeys(["thead", "tbody", "tfoot"], {"thead", "tbody", "tfoot"})
#: A marked box that holds at least this many words of long text, and half of those of the page, is a wrapper of the text.
WRAPPED_WORDS = 50
MAX_LINKS, MIN_STOPS, SHORT_WORDS, SHORT_CHARS = 0.4, 0.1, 12, 80
# scripts without spaces between words: two characters count as a word (Chinese, Japanese), or four (Thai, Lao, Burmese, Khmer)
_HAN, _THAI = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_UNITS = re.compile(rf"[{_HAN}]{{1,2}}|[{_THAI}]{{1,4}}|[^\s{_HAN}{_THAI}]+")


@dataclass
class Block:
    text: str
    link_share: float
    content: bool  # inside an article or main element
    heading: bool
    marks: tuple[int, ...]  # marked boxes around it, up to the next article or main element; negative if they may be wrappers


def _marks(rest: str) -> set[str]:
    """The words of class, id and role that mark boilerplate; "has-sidebar" or "no-header" tell of the page around."""
    return {
        word
        for values in _NAMES.findall(rest)
        for name in "".join(values).lower().split()
        if not _AROUND.match(name)
        for word in re.split(r"[^a-z]+", name)
        if word in _MARKS
    }


def blocks_of(page: str) -> list[Block]:
    """The blocks outside dropped elements, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    links = 0
    boxes: list[tuple[str, bool, bool, tuple[int, ...]]] = []  # name, inside a dropped element, inside content, marks
    outer = (False, False, ())
    dropped, content, marks = outer
    in_link = n_marks = 0
    heading = False

    def flush() -> None:
        nonlocal links
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(1.0, links / len(text)), content, heading, marks))
        parts.clear()
        links = 0

    for m in _TOKEN.finditer(page):
        name = m["name"]
        if name is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                if not dropped:
                    parts.append(piece)
                    links += len(piece) * bool(in_link)
            continue
        name = name.lower()
        closing = m["close"] == "/"
        if name == "br" or name in ("img", "wbr"):
            if not dropped and name == "br":
                parts.append(" ")
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        starts = not closing and name not in _VOID
        hidden = starts and bool(_HIDDEN.search(" " + m["rest"]))
        words = _marks(m["rest"]) if starts and name not in ("html", "body") and name not in _CONTENT else ()
        if name in _BLOCKS or hidden or words:
            if not dropped:
                flush()
            in_link = 0
            heading = not closing and name in _HEADINGS
            if closing:
                at = next((i for i in range(len(boxes) - 1, -1, -1) if boxes[i][0] == name), None)
                if at is not None:
                    del boxes[at:]
            else:
                _end_omitted(boxes, name)
                dropped, content, marks = boxes[-1][1:] if boxes else outer
                box = name in _BOXES or any(b[0] == name for b in boxes)
                bad = name in _DROPPED or (hidden and name not in ("html", "body") and name not in _CONTENT)
                if not m["rest"].endswith("/>") and (box or bad or words):
                    if name in _CONTENT:
                        marks = ()
                    elif words:
                        n_marks += 1
                        marks = (*marks, -n_marks if not content and _LAYOUT.issuperset(words) else n_marks)
                    boxes.append((name, dropped or bad, content or name in _CONTENT, marks))
            dropped, content, marks = boxes[-1][1:] if boxes else outer
        elif closing and any(b[0] == name for b in boxes):  # a marked element that is no block by itself
            at = max(i for i, b in enumerate(boxes) if b[0] == name)
            if not dropped:
                flush()
            del boxes[at:]
            dropped, content, marks = boxes[-1][1:] if boxes else outer
    if not dropped:
        flush()
    return out


def _end_omitted(boxes: list, name: str) -> None:
    """Ends the open p, li, td and the like whose end tag is omitted before the start tag ``name``."""
    at = None
    for i in range(len(boxes) - 1, -1, -1):
        if boxes[i][0] in _BOXES:
            break
        if name in _ENDS.get(boxes[i][0], ()):
            at = i
    if at is not None:
        del boxes[at:]


def unmarked(blocks: list[Block]) -> list[Block]:
    """Blocks without those in marked boxes; a mark on a wrapper of the page's text does not count."""
    if not any(b.marks for b in blocks):
        return blocks
    inside: dict[int, int] = {}
    total = 0
    for b in blocks:
        if any(m > 0 for m in b.marks) or b.link_share > MAX_LINKS:
            continue
        size = len(words_of(b.text))
        if size >= SHORT_WORDS or len(b.text) >= SHORT_CHARS:
            total += size
            for m in b.marks:
                inside[m] = inside.get(m, 0) + size
    wrappers = {m for m, size in inside.items() if size >= WRAPPED_WORDS and 2 * size > total}
    return [b for b in blocks if wrappers.issuperset(b.marks)]


def words_of(text: str) -> list[str]:
    """Words in lower case; runs of scripts without spaces are cut into pieces of about a word."""
    low = text.lower()
    return low.split() if low.isascii() or max(low) < "\u0e00" else _UNITS.findall(low)


def _foreign(text: str) -> bool:
    """Mostly letters that no language of the stop words has."""
    return not text.isascii() and 2 * sum(c >= "\u0250" and c.isalpha() for c in text) > sum(c.isalpha() for c in text)


def first_labels(blocks: list[Block]) -> list[bool | None]:
    """True for text, False for boilerplate, None for blocks that density, length and stop words cannot tell.

    Where stop words say nothing (on a page where those of no known language are
    frequent, or in a block of another script) a long block of few links and of
    more than a few different words is text.
    """
    cut = [words_of(b.text) for b in blocks]
    stops = [sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) for words in cut]
    long_ = [len(words) >= SHORT_WORDS or len(b.text) >= SHORT_CHARS for b, words in zip(blocks, cut)]
    judged = [i for i, b in enumerate(blocks) if long_[i] and b.link_share <= MAX_LINKS]
    known = sum(stops[i] for i in judged) >= MIN_STOPS * sum(len(cut[i]) for i in judged)
    labels: list[bool | None] = []
    for b, words, n, is_long in zip(blocks, cut, stops, long_):
        if b.link_share > MAX_LINKS:
            labels.append(None if b.content and b.heading else False)
        elif not is_long:
            labels.append(None)
        elif n >= MIN_STOPS * len(words):
            labels.append(True)
        elif (not known or _foreign(b.text)) and 2 * len(set(words)) >= SHORT_WORDS:
            labels.append(True)
        else:
            labels.append(None if b.content else False)
    return labels


def inherit(labels: list[bool | None]) -> list[bool]:
    """Open labels from the nearest decided neighbour; boilerplate on a tie or without any."""
    n = len(labels)
    before, after = [(n + 1, False)] * n, [(n + 1, False)] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = (n + 1, False)
        for i in order:
            last = (0, labels[i]) if labels[i] is not None else (last[0] + 1, last[1])
            near[i] = last
    return [a[1] and b[1] if a[0] == b[0] else min(a, b)[1] for a, b in zip(before, after)]


def second_labels(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks inside an article or main element are text; others inherit from blocks that are outside too."""
    outside = iter(inherit([x for b, x in zip(blocks, labels) if not b.content]))
    return [x is not False if b.content else next(outside) for b, x in zip(blocks, labels)]


def main_text(page: str | None) -> str:
    blocks = unmarked(blocks_of(page or ""))
    return "\n\n".join(b.text for b, keep in zip(blocks, second_labels(blocks, first_labels(blocks))) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with the column text in place of html."""
    keep = [c for c in pages.columns if c not in ("html", "text")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"])

    source = pages.select(row_struct(keep).alias("row"), F.col("html").cast("string").alias("html"))
    schema = T.StructType([source.schema["row"], T.StructField("text", T.StringType())])
    return source.mapInArrow(task, schema).select("row.*", "text")
