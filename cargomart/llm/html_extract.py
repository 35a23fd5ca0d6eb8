"""Main text of web pages: a linear-chain conditional random field over the
leaf blocks of the document tree.

A block is the text between two tags that end blocks.  Its features are its
ancestors' tags, words in their class and id, and the look of its text; the
chain's labels say whether it belongs to the article.  The field is trained on
labelled pages: layouts whose regions are known are filled with text from a
bounded sample of the table's own pages, which keep their words and languages.
"""

from __future__ import annotations

import random
import re
from functools import cache
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tune
from .crf import Chain, fit

#: Pages whose text fills the labelled layouts (the first by hash of page_id),
#: and layouts made.
SAMPLE_PAGES, LAYOUTS = 120, 500

#: What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Scripts, styles and what isn't part of the page; all other text is for the field to judge.
HIDDEN = frozenset("head title script style template datalist".split())
#: What may stand in a head; any other element or text ends one that is open.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
#: A start tag of these ends an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: These end a block; any other element, known or not, stands in a line of text.
BREAKS = BLOCKS | frozenset(
    "body br button caption center col colgroup dd dialog dir dt frameset head hgroup html iframe legend li noframes noscript optgroup option search "
    "select summary tbody td textarea tfoot th thead tr".split()
)
#: A start tag ends an open element of its own kind, up to the container.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

#: Words that authors put in class and id, by what they call a region.
HINTS = {
    "content": "article body content entry main post story text prose",
    "nav": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination skip tabs toc",
    "head": "banner brand header hero logo masthead top topbar",
    "foot": "bottom colophon copyright footer legal",
    "side": "aside rail related recommended sidebar side trending widget more popular",
    "ad": "ad ads adsbygoogle advert advertisement advertising promo promotion promoted sponsor sponsored teaser",
    "notice": "alert banner consent cookie cookies gdpr modal notice notification overlay popup privacy warning",
    "form": "contact form login newsletter search signup subscribe subscription",
    "comment": "comment comments disqus discussion feedback replies reply respond responses reviews",
    "share": "byline meta share sharing social tags author",
}
TAGS = (
    "article aside blockquote body button dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header legend li main "
    "iframe menu nav noscript ol option p pre section select table td textarea th ul"
).split()

_WORD = re.compile(r"[a-z]+")
_HINT_OF: dict[str, set[str]] = {}
for _kind, _names in HINTS.items():
    for _name in _names.split():
        _HINT_OF.setdefault(_name, set()).add(_kind)


class _Blocks(HTMLParser):
    """Collects blocks: text, ancestors' features, characters within links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, frozenset[str]]] = []
        self.open: dict[str, int] = {}  # how many open elements give a feature
        self.of_tag: dict[str, int] = {}
        self.hidden = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, frozenset[str], int]] = []

    def flush(self) -> None:
        if text := " ".join("".join(self.parts).split()):
            parent = next((t for t, _ in reversed(self.stack) if t in BREAKS), "")
            self.blocks.append((text, frozenset(self.open) | {f"in:{parent}"}, self.linked))
        self.parts, self.linked = [], 0

    def _pop(self) -> None:
        tag, marks = self.stack.pop()
        self.of_tag[tag] -= 1
        self.hidden -= tag in HIDDEN
        for m in marks:
            self.open[m] -= 1
            if not self.open[m]:
                del self.open[m]

    def _close(self, tags: set[str], until: set[str] | frozenset[str]) -> None:
        """Closes the outermost open one of ``tags`` above the nearest of ``until``."""
        at = None
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in until:
                break
            if self.stack[k][0] in tags:
                at = k
        while at is not None and len(self.stack) > at:
            self._pop()

    def _end_head(self) -> None:
        """At what can't stand in a head, unless it is in an element there."""
        if self.stack and self.stack[-1][0] == "head":
            self._pop()

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self.flush()
        if tag == "body" and self.of_tag.get("head"):
            self._close({"head"}, set())
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCKS and self.of_tag.get("p"):
            self._close({"p"}, BLOCKS - {"p"})
        if tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        if tag in VOID:
            return
        marks = {f"tag:{tag}"} if tag in BREAKS else set()
        for name, value in attrs:
            if name in ("class", "id", "role") and value and tag not in ("html", "body"):
                for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                    marks |= {f"hint:{k}" for k in _HINT_OF.get(w, ())}
        self.stack.append((tag, frozenset(marks)))
        self.of_tag[tag] = self.of_tag.get(tag, 0) + 1
        self.hidden += tag in HIDDEN
        for m in marks:
            self.open[m] = self.open.get(m, 0) + 1

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self.flush()
        if self.of_tag.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        if not self.hidden:
            self.parts.append(data)
            if self.of_tag.get("a"):
                self.linked += len(data)


def blocks(html: str) -> list[tuple[str, frozenset[str], int]]:
    """(text, ancestors' features, characters in links) of each block, in page
    order.  References are decoded and white space is made single spaces; any
    text parses, whatever is left open or cut off."""
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.blocks


def _look(text: str, linked: int, place: float, copyright_: bool) -> set[str]:
    words = text.split()
    n, letters = len(words), sum(map(len, words)) or 1
    ends = sum(text.count(c) for c in ".!?…") / n
    out = {f"words:{next(k for k in (1, 3, 6, 12, 25, 50, 1 << 60) if n <= k)}", f"place:{min(4, int(place * 5))}"}
    out.add(f"links:{0 if not linked else 1 if linked < letters / 3 else 2}")
    out.add(f"ends:{0 if not ends else 1 if ends < 0.05 else 2 if ends < 0.34 else 3}")
    if copyright_:
        out.add("copyright")
    if text[-1] in ".!?…\"'”»":
        out.add("closed")
    if sum(c.isdigit() for c in text) > letters / 3:
        out.add("digits")
    if text.isupper():
        out.add("upper")
    return out


@cache
def _number() -> dict[str, int]:
    """Features by name; a feature that isn't listed is left out."""
    names = [f"{k}:{t}" for k in ("tag", "in") for t in TAGS] + [f"hint:{k}" for k in HINTS]
    names += [f"words:{k}" for k in (1, 3, 6, 12, 25, 50, 1 << 60)] + [f"place:{k}" for k in range(5)]
    names += [f"links:{k}" for k in range(3)] + [f"ends:{k}" for k in range(4)]
    names += ["copyright", "closed", "digits", "upper", "plain", "bias", "hint&content", "short&link"]
    return {x: i for i, x in enumerate(names)}


def rows(found: list[tuple[str, frozenset[str], int]]) -> list[list[int]]:
    """Numbers of each block's features."""
    number, out = _number(), []
    for k, (text, marks, linked) in enumerate(found):
        low = text.lower()
        look = _look(text, linked, k / len(found), "©" in text or "copyright" in low or "all rights reserved" in low)
        hints = {m for m in marks if m.startswith("hint:")}
        names = {*marks, *look, "bias"}
        if not hints:
            names.add("plain")
        if "hint:content" in hints and len(hints) > 1:
            names.add("hint&content")
        if "links:2" in look and len(text) < 40:
            names.add("short&link")
        out.append([number[x] for x in names if x in number])
    return out


class _Layout:
    """Makes labelled pages: each block's text is marked with its label."""

    def __init__(self, texts: list[str], rng: random.Random):
        self.texts, self.rng = texts, rng
        self.odd = random.Random(12)  # for what few pages have
        self.words = [w for t in texts[:200] for w in t.split()[:40]]

    def prose(self, low: int = 1, high: int = 90) -> str:
        t = self.rng.choice(self.texts).split()
        n = self.rng.randint(low, high)
        at = self.rng.randint(0, max(0, len(t) - n))
        out = " ".join(t[at : at + n])
        return out if out[-1] in ".!?" or self.rng.random() < 0.1 else out + "."

    def few(self, low: int = 1, high: int = 4) -> str:
        return " ".join(self.rng.choices(self.words, k=self.rng.randint(low, high)))

    def put(self, text: str, label: int) -> str:
        return f"\ue000{label}{escape(text)}\ue001"

    def linked(self, text: str, label: int) -> str:
        """Prose with a link in it."""
        w = text.split()
        a = self.rng.randint(0, len(w) - 1)
        b = min(len(w), a + self.rng.randint(1, 4))
        first, link, last = (escape(" ".join(x)) for x in (w[:a], w[a:b], w[b:]))
        return f'\ue000{label}{first} <a href="/x">{link}</a> {last}\ue001'

    def links(self, n: int, listed: bool) -> str:
        a = [f'<a href="/x">{self.put(self.few(1, self.rng.choice((1, 2, 8))), 0)}</a>' for _ in range(n)]
        return f"<ul>{''.join(f'<li>{x}</li>' for x in a)}</ul>" if listed else "".join(f"<p>{x}</p>" for x in a)

    def wrap(self, tag: str, hint: str, inner: str) -> str:
        """An element that says what it is by its tag, by its class or id, by
        both, or (seldom) not at all."""
        way = self.rng.random()
        named = self.rng.choice(HINTS[hint].split())
        named = self.rng.choice((named, f"site-{named}", f"{named}-{self.rng.choice('abc')}", f"{named}Box"))
        attr = f' {self.rng.choice(("class", "class", "id"))}="{named}"'
        if tag == "div":
            return f"<div{attr if way < 0.9 else ''}>{inner}</div>"
        if way < 0.4:
            return f"<{tag}>{inner}</{tag}>"
        return f"<{tag}{attr}>{inner}</{tag}>" if way < 0.7 else f"<div{attr}>{inner}</div>"

    def aside(self, kind: str) -> str:
        r = self.rng
        if kind == "nav":
            return self.wrap("nav", "nav", self.links(r.randint(2, 9), r.random() < 0.8))
        if kind == "head":
            return self.wrap("header", "head", f"<{(h := r.choice(('p', 'h1', 'h2', 'div')))}>{self.put(self.few(1, 6), 0)}</{h}>" + (self.links(3, True) if r.random() < 0.4 else ""))
        if kind == "foot":
            text = r.choice(("© ", "© ", "Copyright ", "")) + self.few(1, 3) + r.choice((" · ", " 2024 ", " ")) + self.prose(2, 18)
            return self.wrap("footer", "foot", (self.links(r.randint(1, 5), True) if r.random() < 0.4 else "") + r.choice(("<p>{}</p>", "{}")).format(self.put(text, 0)))
        if kind == "side":
            return self.wrap("aside", "side", f"<h3>{self.put(self.few(1, 4), 0)}</h3>" + (self.links(r.randint(2, 6), True) if r.random() < 0.6 else f"<p>{self.put(self.prose(5, 40), 0)}</p>"))
        if kind == "form":
            return f"<form>{self.put(self.few(1, 5), 0)}<label>{self.put(self.few(1, 2), 0)}</label><input><button>{self.put(self.few(1, 2), 0)}</button></form>" if r.random() < 0.6 else self.wrap("div", "form", f"<p>{self.put(self.prose(3, 20), 0)}</p><form><button>{self.put(self.few(1, 2), 0)}</button></form>")
        if kind == "comment":
            each = "".join(f"<{(e := r.choice(('p', 'li', 'div')))}>{self.put(self.prose(3, 60), 0)}</{e}>" for _ in range(r.randint(1, 6)))
            return self.wrap("section", "comment", f"<h2>{self.put(self.few(1, 3), 0)}</h2>{each}") if r.random() < 0.5 else self.wrap("div", "comment", each)
        if kind == "share":
            return self.wrap("div", "share", self.put(self.few(1, 6), 0))
        inner = (self.linked if r.random() < 0.25 else self.put)(self.prose(3, 35), 0)
        return self.wrap("div", kind, inner if r.random() < 0.5 else f"<p>{inner}</p>")

    def content(self) -> str:
        r, out = self.rng, []
        if r.random() < 0.85:
            out.append(f"<h1>{self.put(self.few(2, 14), 1)}</h1>")
        for _ in range(r.randint(1, 16)):
            way = r.random()
            if way < 0.7:
                p = self.prose(*r.choice(((1, 6), (5, 90), (5, 90), (30, 150))))
                p = self.linked(p, 1) if r.random() < 0.2 and len(p.split()) > 5 else self.put(p, 1)
                out.append(r.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "{}<br>")).format(p))
            elif way < 0.8:
                out.append(f"<{(h := r.choice(('h2', 'h3', 'h4')))}>{self.put(self.few(1, 8), 1)}</{h}>")
            elif way < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.put(self.prose(1, 25), 1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif way < 0.92:
                out.append(f"<blockquote><p>{self.put(self.prose(5, 50), 1)}</p></blockquote>")
            elif way < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{self.put(self.few(1, 3), 1)}</td><td>{self.put(self.few(1, 2), 1)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                out.append(self.aside(r.choice(("ad", "ad", "side", "share", "notice", "form", "nav"))))
        inner = "".join(out)
        way = r.random()
        if way < 0.4:
            return f"<article>{inner}</article>"
        if way < 0.5:
            return f"<main>{inner}</main>"
        if way < 0.6:
            return f"<section>{inner}</section>"
        named = r.choice(HINTS["content"].split())
        if way < 0.85:
            return f'<div {r.choice(("class", "id"))}="{named}">{inner}</div>'
        return f"<main><article class=\"{named}\">{inner}</article></main>" if way < 0.92 else f"<div>{inner}</div>"

    def page(self) -> tuple[list[list[int]], list[int]]:
        r = self.rng
        before = [k for k in ("head", "nav", "notice", "ad", "share", "side", "form") if r.random() < (0.8 if k == "nav" else 0.3)]
        after = [k for k in ("share", "comment", "side", "ad", "form", "notice", "foot") if r.random() < (0.85 if k == "foot" else 0.3)]
        if r.random() < 0.3:
            r.shuffle(before)
        html = "".join(self.aside(k) for k in before) + self.content() + "".join(self.aside(k) for k in after)
        if self.odd.random() < 0.2:
            # What stands in for scripts or an embedded page, anywhere between two blocks.
            tag, text = self.odd.choice(("noscript", "iframe")), " ".join(self.odd.choices(self.words, k=self.odd.randint(3, 14)))
            at = self.odd.choice([0, *(m.end() for m in re.finditer("</(?:p|div|ul|h1)>", html))])
            html = html[:at] + f"<{tag}>{self.put(text, 0)}</{tag}>" + html[at:]
        kept, labels = [], []
        for text, marks, linked in blocks(f"<html><body>{html}</body></html>"):
            labels.append(int(text[text.index("\ue000") + 1]))
            kept.append((re.sub("\ue000[01]|\ue001", "", text), marks, linked))
        full = [(b, y) for b, y in zip(kept, labels) if b[0].strip()]
        return rows([b for b, _ in full]), [y for _, y in full]


def train(pages: DataFrame, sample: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> Chain:
    """The field for a table's pages.  At most ``sample`` pages come to the
    driver; without any text, layouts are filled with stand-in words."""
    ids = pages.where("html is not null and page_id is not null").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    # Ids are picked first: each task would send the driver as many whole pages.
    picked = pages.where(F.col("page_id").isin([r[0] for r in ids.collect()])).where("html is not null")
    picked = picked.orderBy("page_id", "html").select("html").limit(sample)
    texts = [b[0] for r in picked.collect() for b in blocks(r["html"]) if len(b[0].split()) >= 8]
    rng = random.Random(11)
    if len(texts) < 20:
        texts += [" ".join("lorem ipsum dolor sit amet consectetur elit sed".split()[: rng.randint(3, 8)] * 4) for _ in range(20)]
    made = _Layout(texts, rng)
    return fit([p for p in (made.page() for _ in range(layouts)) if p[1]], len(_number()))


def main_text(html: str, model: Chain) -> str:
    found = blocks(html)
    return " ".join(b[0] for b, y in zip(found, model.decode(rows(found))) if y)


def extract(pages: DataFrame, model: Chain) -> DataFrame:
    """page_id, url, html (null: empty) to page_id, url, text (empty if none)
    and n_chars.  Pages are handled one by one, so repeated rows give repeated
    results, a null page_id or url stays null, and an empty table stays empty;
    other columns are not looked at; no shuffle."""
    tune(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(h, model) for _, hs in text_slices(batch, "html") for h in hs]
            cols = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
