"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks (leaf sequences of text between block-level tags).  A block's vector
holds its hashed tag path, its hashed words and a few measures; a bidirectional LSTM in numpy
reads all blocks of a page in order and labels each as main text or not.  The network is
trained on layouts that are laid around texts of a bounded sample of the pages themselves, so
that every label is known by construction.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least, tidy

#: Pages whose texts serve the training layouts at most, and the layouts made of them.
MOST_SAMPLE, LAYOUTS = 200, 1000
_PATH, _WORDS, _MEASURES, _HIDDEN = 160, 32, 8, 16
_INPUT = _PATH + _WORDS + _MEASURES

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    # a quote opens a value behind = only; elsewhere it belongs to a name
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*)(?:>|\Z)",
    re.S | re.I,
)
#: Left out with all they hold, if they are closed; of those that nest in themselves the closed ones.
_LEFT_OUT = frozenset("noscript template svg iframe object select button".split())
_NESTS = frozenset("template svg object".split())
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced maction msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd semantics annotation annotation-xml".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an open tag of the same name, and how far up they look for it.
_CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())


def _left_out(tags: list[re.Match]) -> dict[int, int]:
    """Places of opening tags whose elements are left out, and of the tags that close them."""
    ends: dict[int, int] = {}
    waiting: dict[str, list[int]] = {}
    for i, m in enumerate(tags):
        name = m[3].lower() if m[3] else ""
        if name not in _LEFT_OUT:
            continue
        places = waiting.setdefault(name, [])
        if m[2]:
            if places:
                ends[places.pop()] = i
        elif m[4].endswith("/"):
            ends[i] = i
        else:
            if name not in _NESTS:  # one that opens in another shows that the other is not closed
                places.clear()
            places.append(i)
    return ends


_hashes: dict[str, int] = {}


def _hash(word: str) -> int:
    h = _hashes.get(word)
    if h is None:
        if len(_hashes) > 200_000:
            _hashes.clear()
        h = _hashes[word] = zlib.crc32(word.encode("utf-8", "replace"))
    return h


class _Open:
    """The open tags, and which hashed words of their names, classes, ids and roles are among them: kept up at every tag, so that
    depth costs a block nothing."""

    def __init__(self):
        self.stack: list[tuple[str, list[int]]] = []
        self.names: dict[str, int] = {}
        self.counts = [0] * _PATH
        self.mask = self.depth = 0

    def push(self, name: str, words: list[str]) -> None:
        at = [_hash(w) % _PATH for w in words]
        for i in at:
            self.counts[i] += 1
            self.mask |= 1 << i
        self.depth += len(at)
        self.names[name] = self.names.get(name, 0) + 1
        self.stack.append((name, at))

    def pop(self) -> str:
        name, at = self.stack.pop()
        for i in at:
            self.counts[i] -= 1
            if not self.counts[i]:
                self.mask &= ~(1 << i)
        self.depth -= len(at)
        self.names[name] -= 1
        return name

    def close(self, name: str) -> None:
        """Closes the innermost open tag of that name and all within it, if there is one."""
        if self.names.get(name):
            while self.pop() != name:
                pass


@dataclass
class Block:
    path: int  # bit i: a word of the open tags has the hash i
    text: str
    linked: int  # characters inside links
    depth: int = 1  # words of the open tags


def path_of(words: tuple[str, ...]) -> int:
    out = 0
    for w in words:
        out |= 1 << _hash(w) % _PATH
    return out


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, with character references decoded and white space joined."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = in_link = at = 0

    def close():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(open_.mask, text, linked, open_.depth))
            parts.clear()
        linked = 0

    tags = list(_TAG.finditer(html))
    ends = _left_out(tags)
    upto = -1  # the tag that ends what is left out
    for k, m in enumerate(tags):
        if k <= upto:
            at = m.end()
            continue
        if m.start() > at:
            parts.append(html[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        name = m[3]
        if name is None:
            if m[1]:
                parts.append(" ")
            continue
        if k in ends:
            upto = ends[k]
            parts.append(" ")
            continue
        name = name.lower()
        if name in _INLINE:
            if name == "a":
                in_link = 0 if m[2] else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        close()
        if name in _VOID:
            continue
        if m[2]:
            open_.close(name)
        else:
            if name in _CLOSES_ITSELF and open_.stack and open_.stack[-1][0] == name:
                open_.pop()
            words = ["t:" + name]
            if m[4]:
                for v in _NAMED.findall(m[4]):
                    words += ["c:" + w for w in _WORD.findall("".join(v).lower())]
            open_.push(name, words)
    if at < len(html):
        parts.append(html[at:])
    close()
    return out


def features(page: list[Block]) -> np.ndarray:
    """One row for each block."""
    n = len(page)
    x = np.zeros((n, _INPUT), np.float32)
    for i, b in enumerate(page):
        x[i, :_PATH] = np.unpackbits(np.frombuffer(b.path.to_bytes(_PATH // 8, "little"), np.uint8), bitorder="little")
        words = b.text.lower().split()
        x[i, _PATH : _PATH + _WORDS] = np.bincount([_hash(w) % _WORDS for w in words], minlength=_WORDS) / max(4, len(words))
        k = len(b.text)
        x[i, -_MEASURES:] = (
            np.log1p(k) / 8, min(1.0, b.linked / k), sum(b.text.count(c) for c in ".,;!?") / max(1, k) * 10, float(k < 40), float(k > 160), i / n, (n - i) / n, b.depth / 10,
        )
    return x


# --- the network -----------------------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        h = _HIDDEN
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.1, (_INPUT, 4 * h))
            self.w["h" + d] = rng.normal(0, h**-0.5, (h, 4 * h)) * 0.5
            bias = np.zeros(4 * h)
            bias[h : 2 * h] = 1.0  # remember at first
            self.w["b" + d] = bias
        self.w["o"] = rng.normal(0, h**-0.5, 2 * h)
        self.w["c"] = np.zeros(1)
        self.w = {k: a.astype(np.float32) for k, a in self.w.items()}

    def _direction(self, d, x, mask):
        """x: time, pages, inputs.  Gives the states and what the way back needs."""
        h_n = _HIDDEN
        steps, pages, _ = x.shape
        pre = x @ self.w["x" + d] + self.w["b" + d]
        h, c = np.zeros((2, pages, h_n), np.float32)
        kept, states = [], np.zeros((steps, pages, h_n), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w["h" + d]
            i, f, o = (_sigmoid(z[:, k * h_n : (k + 1) * h_n]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * h_n :])
            m = mask[t][:, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, tanh, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            states[t] = h
        return states, kept

    def forward(self, x, mask):
        f, kf = self._direction("f", x, mask)
        b, kb = self._direction("b", x, mask)
        s = np.concatenate([f, b], 2)
        return _sigmoid(s @ self.w["o"] + self.w["c"]), s, (kf, kb)

    def gradients(self, x, mask, y):
        p, s, kept = self.forward(x, mask)
        d_out = ((p - y) * mask / mask.sum()).astype(np.float32)
        grads = {"o": np.einsum("tp,tph->h", d_out, s), "c": np.array([d_out.sum()])}
        d_s = d_out[:, :, None] * self.w["o"]
        for d, half, way in (("f", d_s[:, :, :_HIDDEN], kept[0]), ("b", d_s[:, :, _HIDDEN:], kept[1])):
            d_pre = np.zeros((*x.shape[:2], 4 * _HIDDEN), np.float32)
            dh, dc = np.zeros((2, *half.shape[1:]), np.float32)
            gh = np.zeros_like(self.w["h" + d])
            for t, h0, c0, i, f, o, g, tanh, m in reversed(way):
                dh = dh + half[t]
                a = np.where(m, dh, 0)
                d_new = np.where(m, dc, 0) + a * o * (1 - tanh**2)
                dz = np.concatenate([d_new * g * i * (1 - i), d_new * c0 * f * (1 - f), a * tanh * o * (1 - o), d_new * i * (1 - g**2)], 1)
                d_pre[t] = dz
                gh += h0.T @ dz
                dh = np.where(m, dz @ self.w["h" + d].T, dh)
                dc = np.where(m, d_new * f, dc)
            grads |= {"h" + d: gh, "x" + d: x.reshape(-1, _INPUT).T @ d_pre.reshape(-1, 4 * _HIDDEN), "b" + d: d_pre.sum((0, 1))}
        return grads, p

    def label(self, pages: list[np.ndarray], most_blocks: int = 1 << 14) -> list[np.ndarray]:
        """The probability of each block, for pages of any length."""
        out: list[np.ndarray | None] = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            n = max(1, min(len(order), most_blocks // max(1, longest)))
            rows, order = order[-n:], order[:-n]
            x, mask = batch([pages[i] for i in rows])
            p = self.forward(x, mask)[0]
            for k, i in enumerate(rows):
                out[i] = p[: len(pages[i]), k]
        return out


def batch(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(1, max(map(len, pages)))
    x, mask = np.zeros((steps, len(pages), _INPUT), np.float32), np.zeros((steps, len(pages)), bool)
    for k, a in enumerate(pages):
        x[: len(a), k] = a
        mask[: len(a), k] = True
    return x, mask


def fit(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, size: int = 16, seed: int = 4) -> Labeller:
    net, rng = Labeller(), np.random.Generator(np.random.PCG64(seed))
    m, v, step = {k: np.zeros_like(a) for k, a in net.w.items()}, {k: np.zeros_like(a) for k, a in net.w.items()}, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(pages)), max(1, len(pages) // size)):
            x, mask = batch([pages[i][0] for i in rows])
            keep = (rng.random((1, len(rows), _INPUT)) >= 0.05).astype(np.float32)  # no single tag or name must decide
            keep[:, :, -_MEASURES:] = 1
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(rows):
                y[: len(pages[i][1]), k] = pages[i][1]
            grads, _ = net.gradients(x * keep, mask, y)
            norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.w[k] -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


# --- layouts to learn from -------------------------------------------------------------------

_BOILER = {
    "nav": "nav navbar menu mainmenu topnav navigation breadcrumb breadcrumbs links toc pagination tabs",
    "header": "header masthead top banner branding logo siteheader topbar head",
    "footer": "footer foot bottom copyright legal sitefooter colophon contentinfo",
    "aside": "sidebar aside side widget rail related recommended trending popular tags more rightcol complementary",
    "ad": "ad ads advert advertisement sponsor sponsored promo adbox banner teaser affiliate",
    "notice": "cookie notice consent alert gdpr privacy popup modal overlay message warning newsletter subscribe signup",
    "form": "form search login register contact subscribe searchform newsletter",
    "comments": "comment comments reply replies discussion thread respond disqus feedback commentlist reviews",
    "share": "share social sharing follow meta byline buttons toolbar tools print",
}
_MAIN = "article main content post entry story body text page maincontent articlebody postcontent richtext hentry document copy"
_NEUTRAL = "wrapper container row col inner outer box section block grid module panel wrap layout region"
_SAYS = {
    "nav": "Home|About|Contact|News|Products|Blog|Next|Previous|Services|Help|Archive|Sitemap",
    "header": "Welcome to our site|The daily page|Log in|Menu|Search|My account",
    "footer": "© 2024 All rights reserved.|Terms of use|Privacy policy|Powered by our site|Contact us|Imprint",
    "aside": "Related articles|Most read|You may also like|Tags|Latest news|Popular posts",
    "ad": "Advertisement|Sponsored|Buy now and save 20%!|Limited offer|Shop now",
    "notice": "We use cookies to improve your experience.|Accept all|By using this site you agree to our terms.|Subscribe to our newsletter|This site uses cookies",
    "form": "Search|Your name|Email|Send|Password|Submit|Remember me",
    "comments": "Great post, thanks!|Reply|Anonymous says:|3 comments|Leave a comment|I do not agree with this.|Posted by a reader",
    "share": "Share on social media|Tweet|Print|By the editor|Published on Monday|5 min read|Follow us",
}
_SEMANTIC = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section", "ad": "aside", "notice": "dialog", "share": "div"}


def layout(rng: np.random.Generator, main: list[str], other: list[str]) -> tuple[str, list[tuple[str, bool]]]:
    """A page around ``main`` and the texts of its blocks, each with whether it is main text."""
    html: list[str] = []
    truth: list[tuple[str, bool]] = []

    def pick(words: str) -> str:
        w = words.split()
        return w[rng.integers(len(w))]

    def chance(p: float) -> bool:
        return bool(rng.random() < p)

    def named(words: str) -> str:
        name = pick(words)
        if chance(0.3):
            name += "-" + pick(_NEUTRAL + " " + words)
        return f' {"id" if chance(0.2) else "class"}="{name}"'

    def leaf(tag: str, text: str, is_main: bool, link: bool = False):
        from html import escape

        inner = escape(text)
        if link:
            inner = f'<a href="/{rng.integers(999)}">{inner}</a>'
        elif chance(0.1):
            words = inner.split(" ")
            k = rng.integers(len(words))
            words[k] = f"<b>{words[k]}</b>"
            inner = " ".join(words)
        html.append(f"<{tag}>{inner}" + ("" if tag in ("p", "li") and chance(0.2) else f"</{tag}>"))
        truth.append((text, is_main))

    def boiler(kind: str):
        tag = _SEMANTIC[kind] if chance(0.5) else "div" if chance(0.8) else "section"
        bare = tag in ("nav", "header", "footer", "form") and chance(0.6) or kind == "aside" and tag == "aside" and chance(0.5)
        html.append(f"<{tag}{'' if bare else named(_BOILER[kind])}>")
        says = _SAYS[kind].split("|")

        def text():
            if other and chance(0.55):
                t = other[rng.integers(len(other))]
                if kind in ("nav", "header", "share", "form") or chance(0.3):
                    t = " ".join(t.split()[: rng.integers(1, 5)])
                return t
            return says[rng.integers(len(says))]

        if kind == "nav" or kind in ("aside", "footer", "share") and chance(0.5):
            html.append("<ul>")
            for _ in range(rng.integers(2, 8)):
                leaf("li", text(), False, chance(0.8))
            html.append("</ul>")
        elif kind in ("footer", "ad", "notice", "header") and chance(0.5):
            t = text()
            html.append(t.replace("&", "&amp;").replace("<", "&lt;"))
            truth.append((t, False))
        else:
            for _ in range(rng.integers(1, 5)):
                leaf(pick("p div span p h3 h4") if kind != "form" else pick("p div legend"), text(), False, chance(0.3))
        html.append(f"</{tag}>")

    wrappers = int(rng.integers(0, 3))
    html.append("<!DOCTYPE html><html><head><title>x</title></head><body>")
    html.extend(f"<div{named(_NEUTRAL)}>" for _ in range(wrappers))
    for kind in ("header", "nav", "notice", "ad", "share"):
        if chance(0.5):
            boiler(kind)
    if chance(0.2):
        boiler("aside")
    kind = rng.random()
    tag = "article" if kind < 0.4 else "main" if kind < 0.55 else "div" if kind < 0.95 else "section"
    html.append(f"<{tag}{named(_MAIN) if tag in ('div', 'section') and chance(0.85) or chance(0.3) else ''}>")
    if chance(0.2):
        html.append(f"<div{named(_MAIN)}>")
    for i, t in enumerate(main):
        if i == 0 and chance(0.7):
            leaf("h1", t if chance(0.5) else " ".join(t.split()[:8]), True)
        else:
            leaf(pick("p p p p p p p p h2 blockquote li div pre td"), t, True)
        if chance(0.05):
            boiler(pick("ad share aside"))
    if chance(0.15):
        boiler("comments")
    html.append("</div>" * 0 + f"</{tag}>")
    for kind in ("share", "comments", "aside", "ad", "form", "nav", "notice"):
        if chance(0.3):
            boiler(kind)
    if chance(0.75):
        boiler("footer")
    html.append("</div>" * wrappers + ("</body></html>" if chance(0.8) else ""))
    return "".join(html), truth


def training_pages(texts: list[list[str]], n: int = LAYOUTS, seed: int = 9) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of ``n`` layouts around the block texts of some pages."""
    rng = np.random.Generator(np.random.PCG64(seed))
    usable = [[t for t in page if t] for page in texts]
    usable = [page for page in usable if page] or [["Some words of a text."]]
    out = []
    for _ in range(n):
        page = usable[rng.integers(len(usable))]
        other = usable[rng.integers(len(usable))]
        k = int(rng.integers(1, 14))
        a = int(rng.integers(max(1, len(page) - k)))
        html, truth = layout(rng, page[a : a + k], other)
        found = blocks(html)
        if [b.text for b in found] == [" ".join(t.split()) for t, _ in truth]:
            out.append((features(found), np.array([is_main for _, is_main in truth], np.float32)))
    return out


# --- columns ---------------------------------------------------------------------------------


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MOST_SAMPLE) -> Labeller:
    """A labeller fitted on layouts around texts of at most ``most`` pages, chosen by the hash of their ids."""
    some = pages.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(html_col).alias("html"))
    found = sorted((r["h"], r["html"] or "") for r in least(some, F.col("h"), most).collect())
    return fit(training_pages([[b.text for b in blocks(html)] for _, html in found]))


def main_text(pages: DataFrame, labeller: Labeller, html_col: str = "html", least: float = 0.5) -> DataFrame:
    """``pages`` with ``text``: the blocks labelled as main text, in page order, joined by one blank.

    The whole of each page is read, whatever its length.  Null, empty and untagged pages are cut and
    labelled like others (null as empty, so the text is empty); repeated rows give equal texts; unclosed and unknown tags
    do no harm; a column ``text`` of the pages is replaced.  Scripts, styles, comments of the markup, and closed controls of forms are never text.
    """
    sent = pages.sparkSession.sparkContext.broadcast(labeller)
    pages = pages.drop("text") if html_col != "text" else pages.withColumnRenamed("text", "html")
    html_col = "html" if html_col == "text" else html_col
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                found = [blocks(x or "") for x in part.column(names.index(html_col)).to_pylist()]
                labels = net.label([features(page) for page in found])
                text = [" ".join(x.text for x, p in zip(page, ps) if p >= least) for page, ps in zip(found, labels)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], [*names, "text"])

    return pages.mapInArrow(tidy(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", text string")
