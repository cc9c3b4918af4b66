"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read to leaf blocks: the text between two borders of block elements, with the chain of open
elements above it.  Each block has features of that chain (tags, class and id words) and of
its text (length, links, sentence marks).  A chain model with the labels "other" and "main" is
trained by gradient descent on the likelihood of labelled pages (forward-backward in numpy), and the
best labelling of a page is found by Viterbi.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS = 13
TRAIN_PAGES, EPOCHS, RATE, PENALTY = 240, 6, 0.2, 1e-4

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object select".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q ruby rp rt s
samp small span strike strong sub sup time tt u var wbr""".split())
#: Open elements that a start tag ends.
_BLOCKS = frozenset("""address article aside blockquote details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main menu
nav ol p pre section table ul""".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements beyond which such an end does not reach.
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"datalist"}}
#: Of those, the elements whose content is no markup: without an end tag they run to the end of the page.
_RAW_TEXT = frozenset("script style textarea title iframe".split())
#: A comment, declaration, start of a tag up to its name, or a lone sign.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)|<", re.S)
#: The end of a tag, or its next attribute up to the value; only a quote right after "=" opens a quoted value.
_NEXT = re.compile(r"[ \t\n\f\r/]*+(?:(>)|=?[^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+(=)[ \t\n\f\r]*+)?)")
_UNQUOTED = re.compile(r"[^ \t\n\f\r>]*+")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Block:
    """Text of one leaf block, the chain above it, and how many of its characters stand in links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def _tag_end(page: str, at: int, dead: set) -> int:
    """The place after the ">" of the tag whose name ends at ``at``, or -1 if it has none.

    Quoted values of any length are jumped over; a quote that is never closed belongs to an unquoted value.
    ``dead`` keeps where attributes began in tags without an end, so that all calls together are linear.
    """
    began = []
    while at not in dead:
        began.append(at)
        m = _NEXT.match(page, at)
        if m.group(1):
            return m.end()
        if m.end() == at:
            break
        at = m.end()
        if m.group(2):
            quote = page[at:at + 1]
            close = page.find(quote, at + 1) if quote in ("'", '"') and ("open", quote) not in dead else -1
            if close < 0 and quote in ("'", '"'):
                dead.add(("open", quote))
            at = close + 1 if close >= 0 else _UNQUOTED.match(page, at).end()
    dead.update(began)
    return -1


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, without those that hold only white space.

    ``path`` is the tuple of ``(tag, names)`` of the open block elements.  Character references are
    decoded once; runs of white space become one blank; what stands in scripts, styles, titles and
    other elements that show no text is left out.  Tags left open end where HTML ends them.
    """
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
            if text:
                out.append(Block(text, tuple(stack), min(linked, len(text))))
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    dead: set = set()
    endless: set[str] = set()
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if m.group() == "<":
                parts.append("&lt;")
            continue
        end = _tag_end(page, at, dead)
        if end < 0:
            parts.append(m.group().replace("<", "&lt;"))
            continue
        attrs, at = page[at:end - 1], end
        tag = tag.lower()
        if m.group(1):
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            flush()
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in RAW:
            if not attrs.endswith("/") and tag not in endless:
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                if close:
                    at = close.end()
                elif tag in _RAW_TEXT:
                    at = size
                else:
                    endless.add(tag)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in INLINE:
            links += tag == "a"
            continue
        flush()
        if tag in VOID:
            continue
        if tag in _BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in _ENDS.get(tag, ()):
                del stack[k:]
                break
            if stack[k][0] in _SCOPES.get(tag, _BLOCKS):
                break
        links = 0
        names = " ".join(x for _, v in _ATTR.findall(attrs) for x in _WORD.findall(v.lower())) if attrs else ""
        stack.append((tag, names))
    flush()
    return out


# ---------------------------------------------------------------- features

def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << BITS) - 1)


def _path_features(path: tuple) -> list[int]:
    found = {f"a:{t}" for t, _ in path} | {f"c:{w}" for _, names in path for w in names.split()}
    if path:
        found |= {f"t:{path[-1][0]}", f"e:{path[-1][0]}<{path[-2][0] if len(path) > 1 else ''}"}
    return sorted({_bucket(f) for f in found | {"bias"}})


def _text_features(block: Block) -> list[int]:
    text = block.text
    words = text.count(" ") + 1
    found = [f"w:{min(8, words.bit_length())}", f"l:{round(4 * block.linked / len(text))}", f"end:{text[-1] in '.!?…。:;'}"]
    if text[0] in "©®™" or text[:9].lower() == "copyright":
        found.append("notice")
    return [_bucket(f) for f in found]


# ---------------------------------------------------------------- model

class Chain:
    """``weights``: score of "main" over "other" for each feature; ``step[a, b]``: score of label b after a."""

    def __init__(self, weights: np.ndarray, step: np.ndarray):
        self.weights, self.step = weights, step
        self.paths: dict[tuple, float] = {}

    def scores(self, page: list[Block]) -> list[float]:
        w, out = self.weights, []
        for b in page:
            if b.path not in self.paths:
                if len(self.paths) > 50_000:
                    self.paths.clear()
                self.paths[b.path] = float(sum(w[f] for f in _path_features(b.path)))
            out.append(self.paths[b.path] + float(sum(w[f] for f in _text_features(b))))
        return out

    def viterbi(self, scores: list[float]) -> list[int]:
        """The best labels, 1 for main; of equal ones "other"."""
        if not scores:
            return []
        (oo, om), (mo, mm) = self.step.tolist()
        other, main, back = 0.0, scores[0], []
        for s in scores[1:]:
            from_other, from_main = other + om, main + mm
            stay_other, leave_main = other + oo, main + mo
            back.append((int(leave_main > stay_other), int(from_main >= from_other)))
            other, main = max(stay_other, leave_main), max(from_other, from_main) + s
        label = int(main > other)
        out = [label]
        for b in reversed(back):
            label = b[label]
            out.append(label)
        return out[::-1]

    def extract(self, page: str | None) -> str:
        found = blocks(page or "")
        return "\n".join(b.text for b, label in zip(found, self.viterbi(self.scores(found))) if label)


def _log_add(a: float, b: float) -> float:
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def train(pages: list[tuple[str, list[int]]], epochs: int = EPOCHS, seed: int = 1) -> Chain:
    """Fit the chain to ``(html, label of each leaf block)`` by stochastic gradient steps (AdaGrad)."""
    data = []
    for page, labels in pages:
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(found)} blocks")
        if found:
            data.append(([np.array(_path_features(b.path) + _text_features(b)) for b in found], labels))
    w, step = np.zeros(1 << BITS), np.zeros((2, 2))
    seen_w, seen_step = np.full(1 << BITS, 1e-8), np.full((2, 2), 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            feats, labels = data[i]
            n = len(feats)
            s = [float(w[f].sum()) for f in feats]
            t = step.tolist()
            fwd, bwd = [(0.0, s[0])], [(0.0, 0.0)]
            for k in range(1, n):
                o, m = fwd[-1]
                fwd.append((_log_add(o + t[0][0], m + t[1][0]), _log_add(o + t[0][1], m + t[1][1]) + s[k]))
            for k in range(n - 1, 0, -1):
                o, m = bwd[-1]
                bwd.append((_log_add(t[0][0] + o, t[0][1] + s[k] + m), _log_add(t[1][0] + o, t[1][1] + s[k] + m)))
            bwd.reverse()
            z = _log_add(*fwd[-1])
            grad = np.zeros((2, 2))
            for k in range(n):
                error = labels[k] - math.exp(fwd[k][1] + bwd[k][1] - z)
                f = feats[k]
                g = error - PENALTY * w[f]
                seen_w[f] += g * g
                w[f] += RATE * g / np.sqrt(seen_w[f])
                if k:
                    for a in (0, 1):
                        for b in (0, 1):
                            grad[a, b] += (labels[k - 1] == a and labels[k] == b) - math.exp(fwd[k - 1][a] + t[a][b] + b * s[k] + bwd[k][b] - z)
            seen_step += grad * grad
            step += RATE * grad / np.sqrt(seen_step)
    return Chain(w, step)


# ---------------------------------------------------------------- labelled pages

_SYLLABLES = "an be ch do en er fi ga ho in ka lo ma ne or pa re sa ti un".split()


class _Writer:
    """Writes a page of random make-up and notes the label of each block it writes."""

    def __init__(self, rng: np.random.Generator):
        self.rng, self.out, self.labels = rng, [], []

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int, stop: bool = True) -> str:
        text = " ".join("".join(self.pick(*_SYLLABLES) for _ in range(self.rng.integers(1, 4))) for _ in range(self.rng.integers(low, high + 1)))
        return text.capitalize() + "." * stop

    def block(self, tag: str, text: str, main: bool, close: bool = True) -> None:
        self.out.append(f"<{tag}>{text}" + f"</{tag.split()[0]}>" * close)
        self.labels.append(int(main))

    def group(self, tag: str, *names: str) -> str:
        name = self.pick(*names, "") if names else ""
        self.out.append(f"<{tag}" + (f' {self.pick("class", "class", "id")}="{name}"' if name else "") + ">")
        return f"</{tag}>"

    def menu(self, *names: str) -> None:
        end = self.group(self.pick("nav", "nav", "div", "menu") if names else "nav", *names)
        items = self.group("ul") if self.chance(0.8) else ""
        for _ in range(self.rng.integers(1, 9)):
            self.block("li" if items else "div", f'<a href="/">{self.words(1, 3, False)}</a>', False)
        self.out.append(items + end)

    def aside(self, tag: str, names: tuple[str, ...], low: int, high: int, count: int) -> None:
        """A part of the page that is no main text: notices, adverts, side columns, footers."""
        self.out.append(f'<{tag} {self.pick("class", "class", "id")}="{self.pick(*names)}">')
        if self.chance(0.3):
            self.block(self.pick("h3", "h4", "p"), self.words(1, 4, False), False)
        for _ in range(self.rng.integers(1, count + 1)):
            text = self.words(low, high)
            self.block(self.pick("p", "div", "li"), f'<a href="#">{text}</a>' if self.chance(0.3) else text, False)
        self.out.append(f"</{tag}>")

    def bare(self, tag: str, names: tuple[str, ...], low: int, high: int, start: str = "") -> None:
        name = f' {self.pick("class", "id")}="{self.pick(*names)}"' if names else ""
        self.block(tag + name, start + self.words(low, high), False)

    def comments(self) -> None:
        tag = self.pick("section", "div", "ol", "ul", "article", "aside")
        self.out.append(f'<{tag} {self.pick("class", "id")}="{self.pick("comments", "comment list", "reader comments", "discussion", "responses replies", "user comment")}">')
        if self.chance(0.5):
            self.block("h3", self.words(1, 2, False), False)
        for _ in range(self.rng.integers(1, 6)):
            inner = self.pick("li", "div", "article") + self.pick("", ' class="comment"')
            if self.chance(0.5):
                self.out.append(f"<{inner}>")
                self.block("p", self.words(3, 60), False)
                self.out.append(f"</{inner.split()[0]}>")
            else:
                self.block(inner, self.words(3, 60), False)
        self.out.append(f"</{tag}>")

    def form(self) -> None:
        self.out.append("<form>" + f'<input name="{self.pick("q", "mail")}">')
        self.block("label", self.words(1, 5, False), False)
        self.out.append("<select><option>a<option>b</select><textarea>x</textarea></form>")

    def article(self) -> None:
        tag = self.pick("article", "article", "article", "main", "section", "div")
        name = self.pick("article body", "post content", "entry content", "main content", "story body", "article text")
        self.out.append(f'<{tag} class="{name}">' if tag in ("section", "div") or self.chance(0.4) else f"<{tag}>")
        if self.chance(0.8):
            self.block("h1", self.words(1, 12, self.chance(0.5)), True)
        for _ in range(self.rng.integers(1, 16)):
            r = self.rng.random()
            if r < 0.08:
                self.block(self.pick("h2", "h3"), self.words(1, 8, False), True)
            elif r < 0.16:
                end = self.group(self.pick("ul", "ol"))
                for _ in range(self.rng.integers(1, 5)):
                    self.block("li", self.words(1, 12, self.chance(0.5)), True)
                self.out.append(end)
            elif r < 0.2:
                self.block(self.pick("blockquote", "pre", "figcaption"), self.words(2, 40), True)
            elif r < 0.23:
                self.block("div", self.words(3, 50), True)
            elif r < 0.3:
                self.block("p", f"<b>{self.words(1, 30)}<br>", True, close=False)
            elif r < 0.34:
                self.out.append("<table><tr>")
                for _ in range(self.rng.integers(1, 5)):
                    self.block("td", self.words(1, 4, False), True)
                self.out.append("</tr></table>")
            elif r < 0.38 and tag == "article":
                self.aside(self.pick("div", "aside"), ("ad", "advert banner", "related links", "share social", "newsletter signup"), 1, 12, 2)
            else:
                words = self.words(1, 3) if self.chance(0.2) else self.words(4, 120) if self.chance(0.9) else self.words(130, 500)
                self.block("p", words if self.chance(0.8) else f'{words} <a href="/x">{self.words(1, 4, False)}</a> {self.words(1, 6)}', True)
        if tag in ("article", "main") and self.chance(0.12):
            self.comments()
        self.out.append(f"</{tag}>")

    def page(self) -> tuple[str, list[int]]:
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style><script>x('</p>')</script></head><body>")
        r = self.chance
        if r(0.08):  # nothing but an article
            self.article()
            return "".join(self.out), self.labels
        if r(0.3):
            end = self.group("header", "site header", "top")
            self.block(self.pick("div", "p", "h2"), self.words(1, 5, False), False)
            self.out.append(end)
        if r(0.8):
            self.menu(*self.pick((), ("menu", "nav bar", "navigation", "breadcrumb")))
        if r(0.4):
            self.bare("div", ("ad", "ads", "advert", "banner", "sponsored"), 2, 20)
        if r(0.3):
            self.aside("div", ("cookie notice", "cookie consent", "notice", "alert notice", "gdpr banner"), 3, 25, 2)
        if r(0.3):
            self.aside(self.pick("aside", "div"), ("sidebar", "side bar", "related", "widget"), 1, 15, 5)
        if r(0.1):
            self.form()
        self.article()
        if r(0.45):
            self.comments()
        if r(0.3):
            self.aside(self.pick("aside", "div", "section"), ("sidebar", "related posts", "widget", "recommended", "share", "tags"), 1, 15, 5)
        if r(0.25):
            self.form()
        if r(0.2):
            self.bare("div", ("ad", "ads", "advert", "promo", "newsletter"), 2, 20)
        if r(0.9):
            if r(0.5):
                self.bare("footer", (), 1, 14, self.pick("&copy; ", "Copyright ", ""))
            else:
                self.aside(self.pick("footer", "div"), ("footer", "site footer", "legal"), 1, 10, 4)
        self.out.append(self.pick("</body></html>", ""))
        return "".join(self.out), self.labels


def labelled_pages(count: int = TRAIN_PAGES, seed: int = 1) -> list[tuple[str, list[int]]]:
    """Pages of varied make-up with a label for each leaf block, 1 for main text."""
    rng = np.random.default_rng(seed)
    return [_Writer(rng).page() for _ in range(count)]


# ---------------------------------------------------------------- operator

def extract(pages: DataFrame, model: Chain | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row: the main blocks of the whole page, one a line.

    A null or empty page, or one without main text, has an empty text.  Nothing else is dropped or cut.
    Repeated rows give a row each; an empty table gives none; other columns are not looked at.
    """
    chain = model or train(labelled_pages())
    weights, step = chain.weights, chain.step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Chain(weights, step)
        for b in batches:
            texts = [own.extract(page.as_py()) for page in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
