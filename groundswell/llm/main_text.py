"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"</?[a-zA-Z][\w:-]*")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_NAME = re.compile(r"[a-z]+")
_END = {t: re.compile(rf"</{t}\b", re.I) for t in (
    "script", "style", "noscript", "template", "textarea", "title", "iframe", "select", "svg", "object", "button")}
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr input "
                   "math mfrac mi mn mo mover mrow msqrt mroot mspace mstyle msub msubsup msup mtext munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening block ends an open one of these.
CLOSES = {"p": frozenset(("p",)), "li": frozenset(("li",)), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
          "tr": frozenset(("tr", "td", "th")), "dd": frozenset(("dd", "dt")), "dt": frozenset(("dd", "dt")),
          "option": frozenset(("option",))}
#: Containers that say nothing about what they hold.
_SILENT = frozenset(("div", "section", "ul", "table", "blockquote"))
_DROPPED = frozenset(("head", "form", "dialog"))


@dataclass
class Block:
    """Text between block tags, with the tags and name parts of all that encloses it."""

    text: str
    tag: str
    within: frozenset[str]
    linked: int
    pieces: list[str] = field(default_factory=list, repr=False)


def _names(rest: str) -> set[str]:
    """Features of an element's attributes: words of class, id and role."""
    out: set[str] = set()
    for m in _ATTR.finditer(rest):
        key, value = (m[1] or "").lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id", "role"):
            out.update(f".{w}" for w in _NAME.findall(value))
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and "display:none" in value.replace(" ", "")):
            out.add("hidden")
    return out


class _Markup:
    """Reads a page's markup from left to right in time that follows its length, however broken it is."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        #: Opening quotes after which no tag has been found to end.
        self.dead: set[int] = set()

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose name ends at ``at``: outside quotes, or if there is
        none, the next one."""
        seen, i = [], at
        while (m := _STOP.search(self.page, i)) is not None:
            c = m.start()
            if self.page[c] == ">":
                return c
            if c in self.dead:
                break
            seen.append(c)
            i = self.page.find(self.page[c], c + 1) + 1
            if not i:
                break
        self.dead.update(seen)
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str]:
        """(start, end, name, attributes) of the next piece of markup; the name of a closing tag begins with
        /, that of a comment or declaration is empty.  Without one, start and end are the page's end."""
        page = self.page
        while 0 <= (i := page.find("<", at)) <= self.last or page.startswith(("<!--", "<![CDATA["), max(i, 0)):
            for start, stop in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if page.startswith(start, i):
                    end = page.find(stop, i + len(start))
                    return i, len(page) if end < 0 else end + len(stop), "", ""
            if page.startswith(("<!", "<?"), i):
                return i, page.find(">", i) + 1, "", ""
            m = _TAG.match(page, i)
            if m is not None:
                end = self.tag_end(m.end())
                return i, end + 1, m[0][1:].lower(), page[m.end():end]
            at = i + 1
        return len(page), len(page), "", ""


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; scripts, styles, forms and head never make one.

    Unclosed and misnested tags are tolerated: a closing tag ends the nearest open element of its
    name and all inside it; without one it is passed over.  Every enclosing element adds to a set
    of known features, so a deep nest costs no more than a flat one.
    """
    known = _model().known
    out: list[Block] = []
    # Tag, known names of all that encloses, and the innermost block tag.
    stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "")]
    open_tags: dict[str, int] = {}
    held: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        held.clear()
        if text and "dropped" not in stack[-1][1]:
            out.append(Block(text, stack[-1][2], stack[-1][1], min(linked, len(text))))
        linked = 0

    def pop(tag: str) -> None:
        while stack[-1][0] != tag:
            open_tags[stack[-1][0]] -= 1
            stack.pop()
        open_tags[tag] -= 1
        stack.pop()

    n, markup = len(page), _Markup(page)
    while at < n:
        start, stop, tag, rest = markup.next(at)
        if start > at:
            piece = entities.unescape(page[at:start])
            held.append(piece)
            if open_tags.get("a"):
                linked += len(piece.strip())
        at = stop
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag not in INLINE:
                flush()
            if open_tags.get(tag):
                pop(tag)
            continue
        if tag in _END:
            end = _END[tag].search(page, at)
            at = page.find(">", end.end()) + 1 or n if end else n
            continue
        if tag == "br":
            held.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
            for other in CLOSES.get(tag, ()):
                if stack[-1][0] == other:
                    pop(other)
            # Inline elements left open inside a paragraph don't keep it open.
            if open_tags.get("p") and tag not in ("td", "th", "li"):
                pop("p")
        if rest.rstrip().endswith("/") and tag not in INLINE:
            continue
        within = stack[-1][1] | (({tag} | _names(rest)) & known)
        if tag in _DROPPED or "hidden" in within:
            within |= {"dropped"}
        stack.append((tag, within, stack[-1][2] if tag in INLINE else tag))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return out


def features(b: Block, before: Block | None) -> list[str]:
    """Names of what holds for a block: enclosing tags and names, leaf tag, and its text's shape."""
    words = b.text.count(" ") + 1
    size = "1" if words < 3 else "2" if words < 8 else "3" if words < 20 else "4"
    out = [*b.within, f"leaf={b.tag}", f"words={size}"]
    if b.within <= _SILENT:
        out.append("nothing told")
    if 2 * b.linked > len(b.text):
        out.append("mostly link")
    if "©" in b.text:
        out.append("copyright")
    if b.text[-1] in ".!?…\"”»":
        out.append("sentence")
    if before is not None and before.within == b.within:
        out.append("as before")
    return out


@dataclass(frozen=True)
class Model:
    """Weights for 'main text' against 'rest', the step between the two, and known names."""

    weights: dict[str, float]
    step: np.ndarray
    known: frozenset[str]


#: Names that occur in the labelled pages; others say nothing.
_GOOD = ("article", "content", "post", "entry", "story", "text", "body", "main")
_BAD = {
    "nav": ("nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "pagination", "toc", "topbar", "tabs"),
    "header": ("header", "masthead", "logo", "banner", "topbar"), "footer": ("footer", "copyright", "legal", "colophon", "bottom"),
    "aside": ("sidebar", "aside", "widget", "related", "recommended", "promo", "popular", "rail"),
    "div": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "cookie", "cookies", "consent", "notice", "alert",
            "popup", "modal", "newsletter", "subscribe", "share", "social", "login", "signup", "search", "overlay", "disclaimer"),
    "section": ("comments", "comment", "commentlist", "replies", "discussion", "respond", "disqus", "reply"),
}


def labelled_page(seed: int) -> tuple[str, list[bool]]:
    """A labelled page: html and, for each of its leaf blocks, whether it is main text.

    Layouts vary in the tags and names that carry the article and in what surrounds it; texts are
    strings of random syllables with lengths of any kind, so that words teach nothing.
    """
    r = random.Random(seed)
    truth: list[bool] = []

    def words(n: int) -> str:
        return " ".join("".join(r.choice(("la", "ne", "so", "ти", "のし", "är", "ku", "me")) for _ in range(r.randint(1, 4)))
                        for _ in range(n)) + r.choice((".", ".", "", "!", "?"))

    def leaf(tag: str, main: bool, low: int, high: int, link: bool = False) -> str:
        truth.append(main)
        text = words(r.randint(low, high))
        if link:
            text = f'<a href="/{r.randint(1, 99)}">{text}</a>'
        elif r.random() < 0.2:
            text = f"<b>{text}"
        return f"<{tag}>{text}" + (f"</{tag}>" if r.random() < 0.9 or tag not in ("p", "li") else "")

    def noise(kind: str) -> str:
        name = r.choice(_BAD[kind])
        tag = r.choice((kind, "div", "section", "ul")) if kind != "div" else "div"
        named = f' {r.choice(("class", "id"))}="{name}"' if tag != kind or kind in ("div", "section") or r.random() < 0.3 else ""
        if tag == "ul":
            inner = "".join(leaf("li", False, 1, 3, link=True) for _ in range(r.randint(1, 5)))
        elif kind == "section":
            inner = "".join(leaf(r.choice(("p", "div", "p")), False, 1, 40) for _ in range(r.randint(1, 4)))
        elif r.random() < 0.5:
            truth.append(False)
            start = "© 2020 " if kind == "footer" and r.random() < 0.6 else ""
            inner = start + words(r.randint(1, 25))
        else:
            inner = "".join(leaf(r.choice(("p", "div", "p")), False, 1, 25, r.random() < 0.4)
                            for _ in range(r.randint(1, 3)))
        return f"<{tag}{named}>{inner}</{tag}>"

    bare = r.random() < 0.25
    parts = [noise(k) for k in r.choices(("nav", "header", "div", "nav"), k=0 if bare else r.randint(0, 4))]
    plain = r.random()
    tag = "article" if plain < 0.35 else "main" if plain < 0.5 else r.choice(("div", "section", "div", ""))
    # Many articles stand in containers whose names say nothing, or in none.
    named = f' class="{r.choice(_GOOD)}"' if r.random() < (0.5 if tag in ("div", "section") else 0.3) else r.choice(("", ' class="x1"'))
    inside = [leaf("h1", True, 1, 12)] if r.random() < (0.4 if bare else 0.8) else []
    for _ in range(r.randint(1, r.choice((1, 3, 14)) if bare else 14)):
        kind = r.choices(("p", "h2", "li", "blockquote", "div", "pre", "td", "noise"), (60, 8, 6, 4, 4, 2, 3, 6))[0]
        if kind == "noise":
            inside.append(noise(r.choice(("div", "aside", "section", "nav"))))
        elif kind == "li":
            inside.append("<ul>" + "".join(leaf("li", True, 1, 15) for _ in range(r.randint(1, 4))) + "</ul>")
        elif kind == "td":
            inside.append("<table><tr>" + "".join(leaf("td", True, 1, 6) for _ in range(2)) + "</tr></table>")
        else:
            inside.append(leaf(kind, True, 1, r.choice((3, 30, 90)), r.random() < 0.05))
    body = "".join(inside)
    for _ in range(r.choice((0, 0, 1, 2))):
        body = f"<div{r.choice(('', ' class=wrapper'))}>{body}</div>"
    parts.append(f"<{tag}{named}>{body}</{tag}>" if tag else body)
    parts += [noise(k) for k in r.choices(("section", "aside", "footer", "div", "footer"), k=0 if bare else r.randint(0, 4))]
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(parts)}</body></html>", truth


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def fit(pages: list[tuple[list[list[str]], list[bool]]], rounds: int = 12, rate: float = 0.3, ridge: float = 1e-4):
    """Weights and steps that maximise the conditional likelihood of the labels (forward-backward,
    adaptive gradient steps)."""
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    at = {f: k for k, f in enumerate(names)}
    w, past = np.zeros(len(names)), np.full(len(names), 1e-6)
    step, past_step = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    data = [([np.array([at[f] for f in row]) for row in rows], np.array(y, int)) for rows, y in pages]
    order = random.Random(7)
    for _ in range(rounds):
        order.shuffle(data)
        for rows, y in data:
            n = len(rows)
            score = np.zeros((n, 2))
            score[:, 1] = [w[r].sum() for r in rows]
            fore, back = score.copy(), np.zeros((n, 2))
            for t in range(1, n):
                fore[t] += _logsum(fore[t - 1][:, None] + step, 0)
            for t in range(n - 2, -1, -1):
                back[t] = _logsum(step + (score[t + 1] + back[t + 1])[None, :], 1)
            z = _logsum(fore[-1], 0)
            p = np.exp(fore + back - z)
            grad_step = np.zeros((2, 2))
            for t in range(1, n):
                grad_step += np.exp(fore[t - 1][:, None] + step + (score[t] + back[t])[None, :] - z)
                grad_step[y[t - 1], y[t]] -= 1
            past_step += grad_step ** 2
            step -= rate * grad_step / np.sqrt(past_step)
            where = np.concatenate(rows)
            grad = np.bincount(where, np.repeat(p[:, 1] - y, [len(r) for r in rows]), len(w)) + ridge * w
            past += grad ** 2
            w -= rate * grad / np.sqrt(past)
    return dict(zip(names, w.tolist())), step


@lru_cache(maxsize=1)
def _model() -> Model:
    known = frozenset({"article", "main", "section", "nav", "header", "footer", "aside", "div", "ul", "table", "blockquote",
                       "hidden", "dropped", *(f".{x}" for x in _GOOD), *(f".{x}" for v in _BAD.values() for x in v)})
    return Model({}, np.zeros((2, 2)), known)


def _examples(seeds: range) -> Iterator[tuple[list[list[str]], list[bool]]]:
    for seed in seeds:
        page, truth = labelled_page(seed)
        found = blocks(page)
        if len(found) != len(truth):
            raise ValueError(f"labelled page {seed}: {len(found)} blocks, {len(truth)} labels")
        if found:
            yield [features(b, p) for b, p in zip(found, [None, *found])], truth


@lru_cache(maxsize=1)
def trained(pages: int = 400) -> Model:
    """The model, trained on ``pages`` labelled pages; the same in every process."""
    weights, step = fit(list(_examples(range(pages))))
    return Model(weights, step, _model().known)


def viterbi(found: list[Block], model: Model) -> list[bool]:
    """The likeliest labels of a page's blocks."""
    if not found:
        return []
    s = [sum(model.weights.get(f, 0.0) for f in features(b, p)) for b, p in zip(found, [None, *found])]
    (oo, oi), (io, ii) = model.step.tolist()
    out, into, back = 0.0, s[0], []
    for x in s[1:]:
        a, b = (out + oo >= into + io), (out + oi >= into + ii)
        back.append((a, b))
        out, into = (out + oo if a else into + io), (out + oi if b else into + ii) + x
    state, labels = into > out, []
    for a, b in reversed(back):
        labels.append(state)
        state = not (b if state else a)
    return [*reversed([*labels, state])]


def extract(page: str, model: Model) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, main in zip(found, viterbi(found, model)) if main)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, text and n_chars (code points) of every page.

    The project's only pages are its own dashboard, so the operator is general: any table with an id,
    an address and html.  Blocks are the texts between block tags, references decoded, white space
    turned into single blanks; the main ones are joined in page order by line breaks.  A null or
    empty page has an empty text.  Repeated rows are read one by one.  One scan, no shuffle.
    """
    out = pages.select(page_id, url).schema.add("text", "string").add("n_chars", "long")
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py() or "", model) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=out.names)

    return pages.select(page_id, url, F.col(html).alias("_html")).mapInArrow(run, out)
