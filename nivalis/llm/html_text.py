"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams its events; they fill one line per block
element with the block's text, the tags around it and the chain of elements it
is in.  Blocks inside menus, headers, footers, sidebars, notices, adverts,
forms and reader comments (by element, role, class or id) and the contents of
scripts and styles are never lines.  The ratio of characters to tags per line
is smoothed with a Gaussian; lines whose smoothed ratio reaches the standard
deviation of all are the clusters of content.  The region is the innermost
article or main element that holds the greater part of the clustered text, else the
innermost container that holds practically all of it, and all its lines are taken, so
short paragraphs at its ends stay.  Where no element but the body holds it, the lines
from the first clustered one to the last are taken.

What a class, an id, a role or a form marks is kept aside until the page has been read:
a form around the greater part of the text, and an element around the page's
article or main element, are wrappers and stay.  A name marks by its last word, or by
its first one before words of structure (``share-buttons``, not ``share-price``), and
not after words such as ``has`` or ``no``; reader comments stay out in any case.

Defined cases: a null or empty page, and one without text, gives the empty
text; unclosed and stray tags are forgiven (a new block ends an open
paragraph, an end tag closes what is open inside); character references are
decoded; repeated pages are extracted alike; other columns play no part.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

CHUNK = 1 << 16
SIGMA, RADIUS = 1.0, 2
#: Part of the clustered text that the region has to hold: an article or main element, another container.
HELD, HELD_BY_ANY = 0.6, 0.95
CONTAINERS = frozenset("article center div main section table tbody td tr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure h1 h2 h3 h4 h5 h6 hgroup hr html legend li main ol optgroup p pre search section summary table tbody td tfoot th
thead tr ul""".split())
#: Elements whose whole contents are no article text.
DROPPED = frozenset("""aside button canvas datalist footer head header iframe map menu meter nav noscript object
option script select style svg template textarea title""".split())
DROPPED_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert menu menubar toolbar".split())
#: Words of class names and ids that mark what is no article text.
DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter
notice notices notification overlay pager pagination paywall popup promo promoted recommended related remark replies reply
respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())
#: Words that may follow a marking word in a name: `nav-links`, `ad-slot`, `comment-list`.
STRUCTURE_NAMES = frozenset("""area articles banner bar block body bottom box button buttons card cards column container content
form frame group holder icons image inline inner item items label left link links list message middle module outer panel posts
prompt region right row section slot slots stories strip text thread title top unit units widget wrap wrapper zone""".split())
#: Words that turn a name into a statement about something else: `has-sidebar`, `no-ads`.
STATE_NAMES = frozenset("has have hide hides is no non not show shows with without".split())
SPACE = re.compile(r"[\x20\x09-\x0D]+")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ENDS_PARAGRAPH = BLOCK | DROPPED | {"form"}


def marks(name: str) -> str | None:
    """The word by which one class name or id marks what is no article text."""
    words = [word.lower() for word in NAME.findall(name)]
    if not words or not STATE_NAMES.isdisjoint(words):
        return None
    if words[-1] in DROPPED_NAMES:
        return words[-1]
    for at, word in enumerate(words):
        if word in DROPPED_NAMES and all(w in STRUCTURE_NAMES or w in DROPPED_NAMES for w in words[at + 1 :]):
            return word
    return None


def hidden_by(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Elements whose contents are no text in any case."""
    return tag in DROPPED or any(
        name == "hidden" or (name == "aria-hidden" and (value or "").strip().lower() == "true")
        for name, value in attrs if tag not in ("html", "body", "main", "article"))


def suspect(tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
    """"comment", "name" or "form" for an element that attributes or a form mark as no article text."""
    if tag in ("html", "body", "main"):
        return None
    found = "form" if tag == "form" else None
    for name, value in attrs:
        if not value:
            continue
        if name in ("class", "id"):
            for word in filter(None, map(marks, value.split())):
                if word in COMMENT_NAMES:
                    return "comment"
                found = "name"
        elif name == "role" and value.strip().lower() in DROPPED_ROLES:
            found = "name"
    return None if tag == "article" else found


class Lines(HTMLParser):
    """Collects (text, tags, elements the block is in) per block; elements are numbered as they open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, number, dropped
        self.kinds: list[str] = []
        self.hidden = 0
        self.suspects: dict[int, str] = {}
        self.articles: list[tuple[str, tuple[int, ...]]] = []  # article and main elements with all they are in
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.text: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        if self.text:
            text = SPACE.sub(" ", "".join(self.text)).strip(" ")
            if text:
                self.lines.append((text, self.tags, tuple(number for _, number, _ in self.open)))
            self.text = []
        self.tags = 0

    def pop_to(self, at: int) -> None:
        for _, _, was_dropped in self.open[at:]:
            self.hidden -= was_dropped
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.tags += 1
            if not self.hidden:
                self.text.append(" ")
            return
        if tag in ENDS_PARAGRAPH or tag == "hr":
            self.end_line()
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == "p":
                    self.pop_to(at)
                    break
                if self.open[at][0] in ENDS_PARAGRAPH:
                    break
        self.tags += 1
        if tag not in VOID:
            gone, why = hidden_by(tag, attrs), suspect(tag, attrs)
            if why and tag not in ENDS_PARAGRAPH:  # inside a line there is nothing to weigh
                gone = True
            elif why and not gone:
                self.suspects[len(self.kinds)] = why
            if gone and tag not in ENDS_PARAGRAPH and not self.hidden:
                self.end_line() if tag != "span" else None
            self.open.append((tag, len(self.kinds), gone))
            self.kinds.append(tag)
            self.hidden += gone
            if tag in ("article", "main") and not self.hidden:
                self.articles.append((tag, tuple(number for _, number, _ in self.open)))

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if any(t in ENDS_PARAGRAPH for t, _, _ in self.open[at:]):
                    self.end_line()
                self.pop_to(at)
                break
        else:
            if tag in BLOCK:
                self.end_line()
        self.tags += 1

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def kept_lines(parser: Lines) -> list[tuple[str, int, tuple[int, ...]]]:
    """Lines outside the suspect elements, those aside that turn out to be wrappers of the page's content."""
    suspects = parser.suspects
    if not suspects:
        return parser.lines
    mass: dict[int, int] = {}
    total = 0
    for text, _, inside in parser.lines:
        # A form may hold the page; what a name marks does not count for it.
        plain = all(suspects.get(number, "form") == "form" for number in inside)
        total += len(text) * plain
        for number in inside:
            mass[number] = mass.get(number, 0) + len(text) * (plain or suspects.get(number) != "form")
    wrappers = {n for n, why in suspects.items() if why == "form" and 2 * mass.get(n, 0) > total}
    if all(any(n in suspects and n not in wrappers for n in inside) for _, inside in parser.articles):
        outside = sum(len(text) for text, _, inside in parser.lines if not any(n in suspects for n in inside))
        for tag, inside in parser.articles:
            around = [n for n in inside if n in suspects]
            if any(suspects[n] == "comment" for n in around) and tag != "main":
                continue
            if tag == "main" or mass.get(inside[-1], 0) > outside:
                wrappers.update(around)
    return [line for line in parser.lines if not any(n in suspects and n not in wrappers for n in line[2])]


def smooth(ratio: np.ndarray) -> np.ndarray:
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    return np.convolve(np.pad(ratio, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_lines(lines: list[tuple[str, int, tuple[int, ...]]], kinds: list[str]) -> list[str]:
    if not lines:
        return []
    sizes = np.array([len(text) for text, _, _ in lines], float)
    smoothed = smooth(sizes / np.maximum(1, [tags for _, tags, _ in lines]))
    cluster = smoothed >= smoothed.std()
    if not cluster.any():
        cluster[:] = True
    mass: dict[int, float] = {}
    for (_, _, inside), size, chosen in zip(lines, sizes, cluster):
        if chosen:
            for number in inside:
                mass[number] = mass.get(number, 0.0) + size
    whole = float(sizes[cluster].sum())
    region = None
    for wanted, held in ((("article", "main"), HELD), (CONTAINERS, HELD_BY_ANY)):
        # Elements are numbered as they open, so of those that hold enough the last is the innermost.
        holding = [n for n, m in mass.items() if m >= held * whole and kinds[n] in wanted]
        if holding:
            region = max(holding)
            break
    if region is not None:
        return [text for text, _, inside in lines if region in inside]
    picked = np.flatnonzero(cluster)
    return [text for text, _, _ in lines[picked[0] : picked[-1] + 1]]


#: A tag that the end of the page cuts off: markup, not text.
CUT_OFF = re.compile(r"<[/!?]?[A-Za-z][^<>]*\Z")


def extract(html: str | None) -> str:
    parser, html = Lines(), html or ""
    at = html.rfind("<")
    if at >= 0 and CUT_OFF.match(html, at):
        html = html[:at]
    for at in range(0, len(html), CHUNK):
        parser.feed(html[at : at + CHUNK])
    parser.close()
    parser.end_line()
    return "\n".join(main_lines(kept_lines(parser), parser.kinds))


def pages_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [extract(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
