"""Main text of HTML pages, by two passes of block rules.

A page is cut into blocks at block-level tags. The text rules look at the
stop-word density, length and link density of every block. Where a block
stands (inside the article element, or inside a menu, header, footer,
sidebar, notice, advert, form or comment section, told by tag, role, class
and id) is one strong feature beside them: what stands in a menu and the like
is out; inside the article a block is prose if the text rules say so and
undecided if not (short, or full of links), outside it must be long and dense
prose. Where the prose outside an article outweighs
that inside (a teaser card), and on pages that name none, the text rules
decide alone. An element that looks like a menu and the like but holds the
article, or nearly all of a page without one, is a wrapper and says nothing.

The second pass gives each block that is still undecided (short, middling or
full of links) the label of the nearest decided block on its side of the
article's border; where the nearest before and after differ, stop words
decide, and only where there is none (an article of a few short blocks) the
side does.

Inside an article a class, id or role marks boilerplate only if a whole name
of it says so (``share-buttons``, but not ``promotion-policy``). The end tag
of an inline element ends that element alone, not the blocks opened in it.

Scripts, styles and hidden elements are no text. Character references are
decoded after the markup is cut, white space inside a block becomes one
space, ``<br>`` counts as white space, and blocks are joined by one newline;
nothing else is dropped.

Pages are independent rows of one scan, without a shuffle; a task holds one
Arrow batch. Rows: a null or empty page gives an empty text; malformed
markup is read as browsers do (unclosed elements end with their parents);
repeated rows are extracted each for itself; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable

#: fixed values: frequent function words of the languages told apart, lower case
STOP_WORDS = {
    "en": "the of and to a in is that for it as was with be by on not he his but at are this have from or had an they which you one we all there been if more when will would who so no out up into them can",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux d l s été comme mais ont cette ses nous elle tout leur bien sans y fait",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos",
}
_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())

#: fixed values: element names and the words in class, id and role that mark boilerplate
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
WRAP = frozenset("form fieldset header".split())        # may hold a whole page
OUT = frozenset("head nav menu footer aside form button select option script style noscript iframe template svg object canvas audio video dialog textarea fieldset title map".split())
IN = frozenset("article main".split())
OUT_WORDS = frozenset("nav navbar navigation menu sidebar footer cookie cookies consent gdpr notice notices banner ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond share sharing social related breadcrumb breadcrumbs popup modal overlay newsletter subscribe signup login search widget toolbar pagination pager masthead topbar contentinfo complementary alert skip".split())
LAYOUT_WORDS = frozenset("nav navbar navigation menu sidebar footer header banner ad ads share sharing social breadcrumb breadcrumbs search widget toolbar masthead topbar skip".split())    # also name what a wrapper has or lacks
IN_WORDS = frozenset("article main".split())
#: fixed values: words that add nothing to such a name
PLAIN_WORDS = frozenset("area bar block box buttons container content div group inner item items links list outer panel post posts row section slot unit widget wrap wrapper".split())

SHORT, LONG = 70, 200                   # characters
LINKS, STOP_LOW, STOP_HIGH = 0.4, 0.1, 0.25
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")


_BOTH = {"layout": "laid", "wrap": "wrapped"}


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    place: str = ""                     # "in" the article, "out" of it, or nothing known; before ``settle`` also those of ``close``
    depth: int = 0                      # open elements that layout words mark
    heading: bool = False
    linked: int = 0                     # characters inside links
    text: str = ""


def _place(name: str, attrs: str, inside: bool) -> str:
    """What an element says about its content: "in", "out", nothing, or, as
    it may be a wrapper, "layout" or "wrap" ("laid" or "wrapped" where it is
    an article too); ``inside`` an article, a header is the article's own and
    nothing is a wrapper."""
    said = "wrap" if name in WRAP and not inside else ""
    if name in OUT and not said:
        return "out"
    found = ""
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role"):
                names = [{w.lower() for w in _WORDS.findall(x)} for x in value.split()]
                words = set().union(*names)
                if inside:              # a name marks boilerplate as a whole
                    marks = set().union(*(n & OUT_WORDS for n in names if n <= OUT_WORDS | PLAIN_WORDS))
                else:
                    marks = words & (OUT_WORDS | {"header"})
                if marks and name not in ("body", "html"):
                    said = "out" if inside else "layout" if marks <= LAYOUT_WORDS and said != "wrap" else "wrap"
                elif not marks and words & IN_WORDS:
                    found = "in"
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return "out"
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return "out"
    if said:
        return _BOTH.get(said, said) if name in IN else said
    return "in" if name in IN else found


def blocks(page: str) -> list[Block]:
    """The page's blocks that have text, in order, with place and links."""
    out, current = [], Block()
    stack: list[tuple[str, str]] = []   # open elements: name, place
    names: dict[str, int] = defaultdict(int)     # how many are open, by name and by place: nothing walks the whole stack
    places: dict[str, int] = defaultdict(int)
    at, last = 0, page.rfind(">") + 1   # no tag ends behind the last ">"

    def inside() -> bool:
        return places["in"] + places["laid"] + places["wrapped"] > 0

    def add(text: str) -> None:
        nonlocal current
        if text:
            current.parts.append(text)
            if names["a"]:
                current.linked += len("".join(html.unescape(text).split()))

    def close() -> None:
        nonlocal current
        current.text = " ".join(html.unescape("".join(current.parts)).split())
        if current.text:
            out.append(current)
        place = ("out" if places["out"] else "wrap" if places["wrap"] or places["wrapped"]
                 else "layout" if places["layout"] or places["laid"] else "")
        if inside() and place != "out":
            place = _BOTH.get(place, "in")
        current = Block(place=place, depth=places["layout"], heading=any(names[n] for n in _HEADINGS))

    def pop_to(k: int) -> None:
        turned = any(n in BLOCK or p for n, p in stack[k:])
        for n, p in stack[k:]:
            names[n] -= 1
            places[p] -= 1
        del stack[k:]
        if turned:
            close()

    while True:
        m = _TAG.search(page, at, last)
        if not m:                       # what follows is text, up to markup that never ends
            add(re.split("<[!?]", page[at:], maxsplit=1)[0])
            break
        add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = last = len(page)   # a comment without an end
            continue
        name, attrs = m[2].lower(), m[3]
        if m[1]:
            if names[name]:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                if name in BLOCK or not any(n in BLOCK for n, _ in stack[k + 1:]):
                    pop_to(k)
                else:                   # blocks opened inside an inline element outlive it
                    _, place = stack.pop(k)
                    names[name] -= 1
                    places[place] -= 1
                    if place:
                        close()
            elif name in BLOCK:
                close()
            continue
        if name == "br":
            add(" ")
            continue
        if name in VOID:
            if name == "hr":
                close()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            add(" ")
            continue
        if name in BLOCK:               # a paragraph ends where the next block begins, a list item at the next one
            ends = "p" if name not in ("li", "dt", "dd", "tr", "td", "th", "option") else name
            for k in range(len(stack) - 1, -1, -1) if names[ends] else ():
                if stack[k][0] == ends:
                    pop_to(k)
                    break
                if stack[k][0] in BLOCK and stack[k][0] != "p":
                    break
        place = _place(name, attrs, inside())
        if attrs.endswith("/") and name in ("svg", "path", "object"):
            continue
        stack.append((name, place))
        names[name] += 1
        places[place] += 1
        if name in BLOCK or place:
            close()
    close()
    return out


def stop_density(text: str) -> float:
    words = _LETTERS.findall(text.lower())
    return sum(w in _STOP for w in words) / len(words) if words else 0.0


def link_density(b: Block) -> float:
    return b.linked / max(1, len("".join(b.text.split())))


def text_label(b: Block) -> bool | None:
    """What links, length and stop words say: True for prose, False for
    boilerplate, None for neither."""
    density = link_density(b)
    if density > LINKS or "©" in b.text:
        return False
    if b.heading or len(b.text) < SHORT:
        return False if density > 0 and not b.heading else None
    stops = stop_density(b.text)
    return True if stops >= STOP_HIGH or len(b.text) >= LONG and stops >= STOP_LOW else None


def settle(found: list[Block], texts: list[bool | None]) -> None:
    """Leave only the places "in", "out" and nothing known: a wrapper says
    nothing, anything else that looks like a menu is out."""
    size: dict[str, int] = defaultdict(int)         # characters by place
    prose: dict[str, int] = defaultdict(int)        # those of prose
    for b, t in zip(found, texts):
        size[b.place] += len(b.text)
        prose[b.place] += len(b.text) if t else 0
    opened, least = {}, 0
    alone = not size["in"] and not prose[""]
    if prose["laid"] > prose[""] and not prose["in"] or alone and size["laid"] > size[""]:
        opened = {"laid": "in"}
    elif alone and (prose["wrapped"] or size["wrapped"] > size[""]):
        opened = {"wrapped": "in"}
    elif not size["in"] and prose["layout"] and not prose[""] and size["layout"] > 4 * size[""]:
        opened = {"layout": ""}
        least = min(b.depth for b, t in zip(found, texts) if t and b.place == "layout")
    for b in found:
        if b.place not in ("in", ""):
            b.place = opened.get(b.place, "out") if not least or b.depth <= least else "out"


def first_pass(found: list[Block]) -> list[bool | None]:
    """True for article text, False for boilerplate, None for undecided."""
    texts = [text_label(b) for b in found]
    settle(found, texts)
    inside = sum(len(b.text) for b, t in zip(found, texts) if t and b.place == "in")
    outside = sum(len(b.text) for b, t in zip(found, texts) if t and not b.place)
    named = any(b.place == "in" for b in found) and inside >= outside
    labels: list[bool | None] = []
    for b, t in zip(found, texts):
        if b.place == "out":
            labels.append(False)
        elif not named:
            labels.append(t)
            b.place = ""                # no border that the second pass would have to mind
        elif b.place == "in":
            labels.append(True if t else None)
        else:
            labels.append(None if t and (len(b.text) < LONG or stop_density(b.text) < STOP_HIGH) else t)
    return labels


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided block on their
    side. On a page without any decided article block, undecided text stands
    for itself; on a side without decided prose, where it stands."""
    border = any(b.place == "in" for b in found)
    if True not in labels and not border:
        return [x is None for x in labels]
    sides = {side: [k for k, x in enumerate(labels) if x is not None and (found[k].place == "in") == side]
             for side in (True, False)}
    out = []
    for k, x in enumerate(labels):
        if x is None:
            side = found[k].place == "in"
            decided = sides[side]
            at = bisect(decided, k)
            before = decided[at - 1] if at else None
            after = decided[at] if at < len(decided) else None
            near = [(abs(d - k), labels[d]) for d in (before, after) if d is not None]
            least = min((n for n, _ in near), default=0)
            ties = {v for n, v in near if n == least} or {side}
            if len(ties) == 1:
                x = ties.pop()
            else:                       # a heading belongs to what follows it
                x = labels[after] if found[k].heading else stop_density(found[k].text) >= STOP_HIGH
        out.append(bool(x))
    return out


def main_text(page: str | None) -> str:
    """The article of one page."""
    found = blocks(page or "")
    return "\n".join(b.text for b, good in zip(found, second_pass(found, first_pass(found))) if good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    importable(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, T.StructType([
        rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())]))
