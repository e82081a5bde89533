"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of text blocks (leaf runs between block-level tags). Each block
is described by hashed tag-path tokens (tags, classes, ids of its ancestors), hashed words and
a few measures, and a bidirectional LSTM in numpy reads the whole sequence both ways before
it labels every block as main text or not. The labeller is trained here, on page layouts
made by ``training_pages``, once for each process; the seed is fixed.
"""

from __future__ import annotations

import html as html_module
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, MEASURES = 96, 32, 6
INPUTS = PATH_DIM + WORD_DIM + MEASURES
HIDDEN = 16

INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark",
    "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "acronym", "nobr", "picture", "rb", "rp", "rt", "rtc", "ruby", "math", "mfrac", "mi", "mn", "mo", "mroot", "mrow", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe"}
#: An opening tag ends an open element of the second kind within the nearest of its containers.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_CLOSING_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "figure",
}
CLOSES |= {t: {"p"} for t in _CLOSING_P}
_BOUND = {"html", "body", "article", "aside", "div", "section", "main", "nav", "header", "footer", "form", "table", "ul", "ol", "dl", "blockquote", "td", "th", "li", "dd"}
_NAME = re.compile(r"/?[A-Za-z][A-Za-z0-9:-]*")
_QUOTED_END = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
_RAW_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in RAW}
_LONG_NUMBER = re.compile(r"&#([0-9]{100,})")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPLIT = re.compile(r"[^a-z]+")


def pieces(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of every piece of markup, in page order and in one pass.

    The name is that of the tag in lower case, with a slash before it for a closing tag, or
    empty for what only goes: comments, declarations, and scripts and the like with what they
    hold. Those without an end go to the page's end. A ``<`` that begins no tag, or that no
    ``>`` follows, is text. A quoted attribute may hold ``>``; from the first tag on whose
    quotes leave it without an end, quotes are ordinary characters.
    """
    at, quotes, last = page.find("<"), True, page.rfind(">")
    while at >= 0:
        end = -1
        name = rest = ""
        follows = page[at + 1 : at + 2]
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = close + 3 if close >= 0 else len(page)
        elif at > last:
            return
        elif follows in ("!", "?"):
            end = page.find(">", at) + 1
        elif m := _NAME.match(page, at + 1):
            close = _QUOTED_END.match(page, m.end()) if quotes else None
            quotes = close is not None
            end = close.end() if close else page.find(">", m.end()) + 1
            name, rest = m[0].lower(), page[m.end() : end - 1]
            if name in RAW:
                if not (name == "svg" and rest.endswith("/")):
                    stop = _RAW_END[name].search(page, end)
                    end = stop.end() if stop else len(page)
                name = ""
        if end < 0:
            at = page.find("<", at + 1)
            continue
        yield at, end, name, rest
        at = page.find("<", end)


class _Open:
    """The open elements. What a block needs of its path is kept for each: the set of hashed path
    tokens as the bits of a number, and the last token's own place."""

    def __init__(self):
        self.tags: list[str] = []
        self.paths: list[tuple[int, int]] = [(0, -1)]
        self.places: dict[str, list[int]] = {}
        self.bounds: list[int] = []

    def push(self, tag: str, rest: str) -> None:
        bits, last = _tokens(tag, rest) if len(rest) < 1000 else _tokens.__wrapped__(tag, rest)
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in _BOUND:
            self.bounds.append(len(self.tags))
        self.tags.append(tag)
        self.paths.append((self.paths[-1][0] | bits, last))

    def cut(self, depth: int) -> None:
        """Closes all elements from ``depth`` on."""
        while len(self.tags) > depth:
            tag = self.tags.pop()
            self.paths.pop()
            self.places[tag].pop()
            if tag in _BOUND:
                self.bounds.pop()

    def close(self, tag: str) -> None:
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def end_by(self, tag: str) -> None:
        """Closes what an opening ``tag`` ends."""
        ends = CLOSES.get(tag)
        if not ends:
            return
        k = len(self.bounds) - 1
        while k >= 0 and self.tags[self.bounds[k]] in ends:
            k -= 1
        bound = self.bounds[k] if k >= 0 else -1
        first = len(self.tags)
        for t in ends:
            own = self.places.get(t)
            if own and own[-1] > bound:
                first = min(first, own[bisect_right(own, bound)])
        self.cut(first)


def blocks(page: str | None) -> list[tuple[tuple[int, int], str, int]]:
    """(path, text, link characters) of every text block of a page in page order, in time
    linear in the page.

    Character references are decoded, white space within a block is one space, empty blocks
    are left out. ``pieces`` says what is markup. The path is the set of hashed tag, class, id
    and role tokens of all open elements, as bits, and the place of the innermost one.
    """
    if not page:
        return []
    out: list = []
    opened = _Open()
    parts: list[str] = []
    links = linked = at = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            raw = "".join(parts)
            if "&#" in raw:  # numbers beyond all code points, before they are read as such
                raw = _LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), raw)
            text = " ".join(html_module.unescape(raw).split())
            if text:
                out.append((opened.paths[-1], text, min(linked, len(text))))
            parts = []
        linked = 0

    for start, end, name, rest in pieces(page):
        if start > at:
            parts.append(page[at:start])
            if links:
                linked += start - at
        at = end
        closing = name.startswith("/")
        tag = name[1:] if closing else name
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        flush()
        links = 0
        if closing:
            opened.close(tag)
        else:
            opened.end_by(tag)
            if tag not in VOID and not rest.endswith("/"):
                opened.push(tag, rest)
    if at < len(page):
        parts.append(page[at:])
        linked += len(page) - at if links else 0
    flush()
    return out


def _place(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % PATH_DIM


@lru_cache(maxsize=20_000)
def _tokens(tag: str, rest: str) -> tuple[int, int]:
    """The tag and the words of its class, id and role as bits, and the place of the last of them."""
    out = ["h" if re.fullmatch("h[1-6]", tag) else tag]
    for _, value in _ATTR.findall(rest):
        out += [f".{w}" for w in _SPLIT.split(value.lower()) if w]
    bits = 0
    for t in out:
        bits |= 1 << _place(t)
    return bits, _place(f"last:{out[-1]}")


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[int, int]) -> np.ndarray:
    bits, last = path
    v = np.array([bits >> i & 1 for i in range(PATH_DIM)], dtype=np.float32)
    if last >= 0:
        v[last] += 0.5
    return v


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        b = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_DIM
        if len(self) < 300_000:
            self[word] = b
        return b


_BUCKETS = _Buckets()


def features(page_blocks: list, first: int = 0, of: int | None = None) -> np.ndarray:
    """One row of ``INPUTS`` numbers for each block; the blocks are those from number ``first`` on
    of a page that has ``of``."""
    n = len(page_blocks) if of is None else of
    x = np.zeros((len(page_blocks), INPUTS), dtype=np.float32)
    for i, (path, text, linked) in enumerate(page_blocks):
        words = text.split(" ")
        x[i, :PATH_DIM] = _path_vector(path)
        counts = np.bincount(np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words)), minlength=WORD_DIM)
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = counts * (1.0 / len(words))
        x[i, -MEASURES:] = (
            min(len(text), 2000) ** 0.5 / 20,
            min(len(words), 50) / 50,
            linked / len(text),
            text.count(".") / len(words),
            (first + i) / n,
            text[-1] in ".!?",
        )
    return x


class Labeller:
    """Two LSTMs over the block sequence, one from each end, and a logistic output."""

    def __init__(self, seed: int = 5, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.p = {"V": rng.normal(0, 0.3, 2 * h), "c": np.zeros(1)}
        for d in "fb":
            bias = np.zeros(4 * h)
            bias[h : 2 * h] = 1.0
            self.p |= {f"W{d}": rng.normal(0, 0.15, (INPUTS, 4 * h)), f"U{d}": rng.normal(0, 0.2, (h, 4 * h)), f"b{d}": bias}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, d: str, keep: bool, state: tuple | None = None) -> tuple[np.ndarray, list, tuple]:
        """x is (time, pages, inputs); the hidden states, what the way back needs, and the last state."""
        t, b, _ = x.shape
        n = self.hidden
        xw = x.reshape(t * b, -1) @ self.p[f"W{d}"] + self.p[f"b{d}"]
        xw = xw.reshape(t, b, 4 * n)
        u = self.p[f"U{d}"]
        h, c = state or (np.zeros((b, n), np.float32), np.zeros((b, n), np.float32))
        hs, saved = np.empty((t, b, n), np.float32), []
        for i in range(t):
            g = xw[i] + h @ u
            s = 1 / (1 + np.exp(-g[:, : 3 * n]))
            z = np.tanh(g[:, 3 * n :])
            before = c
            c = s[:, n : 2 * n] * before + s[:, :n] * z
            tc = np.tanh(c)
            last = h
            h = s[:, 2 * n :] * tc
            hs[i] = h
            if keep:
                saved.append((s, z, before, tc, last))
        return hs, saved, (h, c)

    @staticmethod
    def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each page's own steps in reverse; padding stays at the end."""
        out = np.zeros_like(x)
        for j, n in enumerate(lengths):
            out[:n, j] = x[:n, j][::-1]
        return out

    def logits(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        f = self._run(x, "f", False)[0]
        b = self._run(self._flip(x, lengths), "b", False)[0]
        n = self.hidden
        return f @ self.p["V"][:n] + self._flip(b, lengths) @ self.p["V"][n:] + self.p["c"]

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> tuple[float, dict]:
        n, (t, b, _) = self.hidden, x.shape
        real = np.arange(t)[:, None] < lengths[None, :]
        flipped = self._flip(x, lengths)
        f, kept_f, _ = self._run(x, "f", True)
        r, kept_b, _ = self._run(flipped, "b", True)
        back = self._flip(r, lengths)
        z = f @ self.p["V"][:n] + back @ self.p["V"][n:] + self.p["c"]
        p = 1 / (1 + np.exp(-z))
        loss = float((np.logaddexp(0, z) - y * z)[real].mean())
        dz = np.where(real, p - y, 0).astype(np.float32) / real.sum()
        g = {"c": np.array([dz.sum()], np.float32), "V": np.concatenate([np.tensordot(dz, f, 2), np.tensordot(dz, back, 2)])}
        for d, saved, own, dh_out in (
            ("f", kept_f, x, dz[..., None] * self.p["V"][:n]),
            ("b", kept_b, flipped, self._flip(dz[..., None] * self.p["V"][n:], lengths)),
        ):
            u = self.p[f"U{d}"]
            dg_all = np.empty((t, b, 4 * n), np.float32)
            dh, dc, du = np.zeros((b, n), np.float32), np.zeros((b, n), np.float32), np.zeros_like(u)
            for i in range(t - 1, -1, -1):
                s, cand, before, tc, last = saved[i]
                dh = dh + dh_out[i]
                o = s[:, 2 * n :]
                dc = dc + dh * o * (1 - tc * tc)
                dg = dg_all[i]
                dg[:, :n] = dc * cand
                dg[:, n : 2 * n] = dc * before
                dg[:, 2 * n : 3 * n] = dh * tc
                dg[:, : 3 * n] *= s * (1 - s)
                dg[:, 3 * n :] = dc * s[:, :n] * (1 - cand * cand)
                du += last.T @ dg
                dc = dc * s[:, n : 2 * n]
                dh = dg @ u.T
            flat = dg_all.reshape(t * b, -1)
            g |= {f"U{d}": du, f"b{d}": flat.sum(0), f"W{d}": own.reshape(t * b, -1).T @ flat}
        return loss, g

    def label(self, pages: list[np.ndarray], cells: int = 16_384) -> list[np.ndarray]:
        """For each page the blocks that are main text, as booleans. Pages of like length share
        a padded batch of at most ``cells`` blocks; a longer page runs alone and whole."""
        out: list = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: (len(pages[i]), i))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= cells:
                end += 1
            own = order[at:end]
            x, lengths = _padded([pages[i] for i in own])
            z = self.logits(x, lengths)
            for j, i in enumerate(own):
                out[i] = z[: lengths[j], j] > 0
            at = end
        return out


    def label_long(self, page_blocks: list, cells: int = 16_384) -> np.ndarray:
        """The same for one page of any length, whose features are made ``cells`` blocks at a time."""
        n, h = len(page_blocks), self.hidden
        z = np.full(n, self.p["c"][0], dtype=np.float32)
        starts = range(0, n, cells)
        for d, order, v, turn in (("f", starts, self.p["V"][:h], 1), ("b", reversed(starts), self.p["V"][h:], -1)):
            state = None
            for s in order:
                x = features(page_blocks[s : s + cells], s, n)[::turn, None]
                hs, _, state = self._run(np.ascontiguousarray(x), d, False, state)
                z[s : s + cells] += (hs[:, 0] @ v)[::turn]
        return z > 0

    def label_pages(self, pages: list[list], cells: int = 16_384) -> list[np.ndarray]:
        """For each page's blocks whether they are main text; features of about ``cells`` blocks are held at once."""
        out: list = [None] * len(pages)
        held: list[int] = []
        size = 0
        for i, own in enumerate(pages):
            if len(own) > cells:
                out[i] = self.label_long(own, cells)
                continue
            held.append(i)
            size += len(own)
            if size >= cells:
                self._fill(out, pages, held, cells)
                held, size = [], 0
        self._fill(out, pages, held, cells)
        return out

    def _fill(self, out: list, pages: list[list], held: list[int], cells: int) -> None:
        for j, keep in zip(held, self.label([features(pages[j]) for j in held], cells), strict=True):
            out[j] = keep


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((lengths.max(), len(pages), INPUTS), dtype=np.float32)
    for j, p in enumerate(pages):
        x[: len(p), j] = p
    return x, lengths


def training_pages(count: int, seed: int) -> list[tuple[str, list[bool]]]:
    """Made pages with the label of each block: many layouts of articles among menus, headers,
    footers, sidebars, notices, adverts, forms and reader comments, in invented words."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    syllables = ["th", "er", "an", "on", "tion", "re", "in", "ha", "le", "que", "men", "sch", "ver", "lla", "os", "ar", "ed", "li", "ou", "en"]

    def word() -> str:
        return "".join(pick(*syllables) for _ in range(int(rng.integers(1, 5))))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(int(rng.integers(a, b + 1))))

    def sentences(a: int, b: int) -> str:
        return " ".join(words(1, 18).capitalize() + "." for _ in range(int(rng.integers(a, b + 1))))

    def inline(text: str) -> str:
        k = rng.random()
        if k < 0.1:
            return f"<b>{text}<br>"
        if k < 0.25:
            parts = text.split(" ")
            i = int(rng.integers(len(parts)))
            parts[i] = pick("<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<span>{}</span>").format(parts[i])
            return " ".join(parts)
        return text

    def attr(*names: str) -> str:
        return f' {pick("class", "class", "id")}="{pick(*names)}"'

    out = []
    for _ in range(count):
        page: list[str] = []
        labels: list[bool] = []

        def add(markup: str, text: str, main: bool, page=page, labels=labels) -> None:
            page.append(markup.format(text))
            labels.append(main)

        def plain(*markups: str, a=1, b=12, main=False, add=add) -> None:
            add(pick(*markups), inline(words(a, b)) if main else words(a, b), main)

        def menu(page=page, plain=plain) -> None:
            tag = pick("nav", "nav", "div", "header")
            if tag == "div" and rng.random() < 0.5:
                page.append(f"<div{attr('menu', 'nav', 'top-nav', 'navigation', 'topbar')}>")
                for _ in range(int(rng.integers(2, 9))):
                    plain('<div><a href="/x">{}</a></div>', a=1, b=2)
                page.append("</div>")
                return
            page.append(f"<{tag}{'' if tag == 'nav' and rng.random() < 0.6 else attr('menu', 'nav', 'navbar', 'navigation', 'topbar', 'breadcrumb')}><ul>")
            for _ in range(int(rng.integers(2, 9))):
                plain('<li><a href="/x">{}</a></li>', a=1, b=2)
            page.append(f"</ul></{tag}>")

        def box(names: tuple[str, ...], tags: tuple[str, ...], a: int, b: int, semantic: bool = False, page=page, add=add) -> None:
            tag = pick(*tags)
            page.append(f"<{tag}{'' if semantic and rng.random() < 0.6 else attr(*names)}>")
            for _ in range(int(rng.integers(a, b + 1))):
                kind = pick("<p>{}</p>", "<div>{}</div>", "<p>{}", "{}", '<h3>{}</h3>', '<ul><li><a href="/x">{}</a></li></ul>')
                add(kind if not page[-1].endswith("{}") else "<p>{}</p>", sentences(1, 4) if rng.random() < 0.5 else words(1, 10), False)
                if kind == "{}":
                    page.append("<hr>")
            page.append(f"</{tag}>")

        advert = lambda: box(("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"), ("div", "aside", "section"), 1, 1)
        notice = lambda: box(("cookie", "notice", "consent", "alert", "cookie-banner", "gdpr", "warning"), ("div", "section", "aside"), 1, 2)
        sidebar = lambda: box(("sidebar", "side", "related", "widget", "trending", "recommended"), ("aside", "aside", "div"), 1, 5, True)
        comments = lambda: box(("comments", "comment", "replies", "discussion", "reader-comments", "comment-list"), ("section", "div", "ol"), 1, 6)
        header = lambda: box(("header", "masthead", "site-header", "brand", "top"), ("header", "header", "div"), 1, 2, True)

        def form(page=page, plain=plain) -> None:
            page.append(f"<form{pick('', attr('search', 'subscribe', 'newsletter', 'login', 'signup'))}>")
            plain("<label>{}</label>", "<p>{}</p>", "<div>{}</div>", a=1, b=8)
            page.append('<input name="q">')
            plain("<button>{}</button>", a=1, b=2)
            page.append("</form>")

        def article(page=page, add=add) -> None:
            tag = pick("article", "article", "article", "main", "div", "div", "section")
            known = attr("content", "article", "post", "entry", "main", "story", "article-body", "entry-content", "post-content")
            page.append(f"<{tag}{known if tag in ('div', 'section') or rng.random() < 0.3 else ''}>")
            if rng.random() < 0.15:
                page.append(pick("<div>", "<section>", f"<div{attr('body', 'text', 'inner')}>"))
            soup = tag == "div" and rng.random() < 0.6  # paragraphs are divs too
            if soup:
                add(pick("<div>{}</div>", "<h1>{}</h1>", "<div class=\"title\">{}</div>"), words(1, 12).capitalize(), True)
            elif rng.random() < 0.9:
                add(pick("<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>"), words(2, 12).capitalize(), True)
            for _ in range(int(rng.integers(1, 14))):
                k = rng.random()
                if k < 0.79:
                    add("<div>{}</div>" if soup else pick("<p>{}</p>", "<p>{}</p>", "<p>{}"), inline(sentences(1, 7)) if rng.random() < 0.9 else words(1, 3) + ".", True)
                elif k < 0.82:
                    page.append("<table>")
                    for row in range(int(rng.integers(2, 5))):
                        page.append("<tr>")
                        for _ in range(int(rng.integers(2, 4))):
                            add(pick("<td>{}</td>", "<td>{}") if row else "<th>{}</th>", words(1, 4), True)
                        page.append("</tr>")
                    page.append("</table>")
                elif k < 0.87:
                    add(pick("<h2>{}</h2>", "<h3>{}</h3>"), words(1, 8), True)
                elif k < 0.91:
                    page.append("<ul>")
                    for _ in range(int(rng.integers(1, 5))):
                        add("<li>{}</li>", words(1, 14), True)
                    page.append("</ul>")
                elif k < 0.94:
                    add(pick("<blockquote>{}</blockquote>", "<pre>{}</pre>", "<figcaption>{}</figcaption>"), sentences(1, 3), True)
                else:
                    pick(advert, advert, form, sidebar, notice)()
            if rng.random() < 0.12:
                comments()
            page.append(f"</{tag}>")

        page.append("<!DOCTYPE html><html><head>")
        plain("<title>{}</title>", a=2, b=12)
        page.append("</head><body>")
        if rng.random() < 0.3:
            page.append(f"<div{attr('wrap', 'page', 'container', 'site', 'outer')}>")
        order = [x for x, p in ((notice, 0.2), (header, 0.35), (menu, 0.85), (advert, 0.5), (form, 0.15), (sidebar, 0.15)) if rng.random() < p]
        if rng.random() < 0.3:
            order = [order[i] for i in rng.permutation(len(order))]
        for x in order:
            x()
        article()
        for x, p in ((comments, 0.3), (advert, 0.2), (sidebar, 0.25), (form, 0.15), (notice, 0.1)):
            if rng.random() < p:
                x()
        if rng.random() < 0.92:
            box(("footer", "site-footer", "copyright", "legal", "bottom"), ("footer", "footer", "footer", "div"), 1, 3, True)
        page.append(pick("</body></html>", ""))
        out.append(("".join(page), labels))
    return out


def _examples(count: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for page, labels in training_pages(count, seed):
        own = blocks(page)
        if len(own) == len(labels):
            out.append((features(own), np.array(labels, dtype=np.float32)))
    return out


@lru_cache(maxsize=1)
def trained(pages: int = 700, epochs: int = 8, batch: int = 32, seed: int = 5) -> Labeller:
    """A labeller fitted by Adam on ``pages`` made pages."""
    examples = sorted(_examples(pages, seed), key=lambda e: len(e[0]))
    net = Labeller(seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    starts, step = list(range(0, len(examples), batch)), 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        for s in rng.permutation(starts):
            own = examples[s : s + batch]
            x, lengths = _padded([e[0] for e in own])
            y = np.zeros(x.shape[:2], dtype=np.float32)
            for j, e in enumerate(own):
                y[: lengths[j], j] = e[1]
            _, grads = net.gradients(x, y, lengths)
            step += 1
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


def main_text(page_blocks: list, keep: np.ndarray) -> str:
    return "\n\n".join(b[1] for b, k in zip(page_blocks, keep, strict=True) if k)


def extract(pages: DataFrame, labeller: Labeller, columns: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``columns`` of every row, its main ``text`` and ``n_chars``.

    Null and empty pages, and pages without main text, give the empty text. Repeated rows
    stay, an empty table gives no rows, other columns are ignored. Every block of a page is
    read, however long, deep or malformed the page. The labeller's weights (some kilobytes) go with the tasks.
    """
    names = [f"_c{i}" for i in range(len(columns))]

    def run(frames):
        for f in frames:
            found = [blocks(h) for h in f["_html"]]
            keep = labeller.label_pages(found)
            text = [main_text(b, k) for b, k in zip(found, keep, strict=True)]
            yield f[names].assign(text=text, n_chars=np.array([len(t) for t in text], dtype=np.int64))

    own = pages.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    kinds = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for c, n in zip(columns, names, strict=True))
    out = own.mapInPandas(run, f"{kinds}, text string, n_chars long")
    return out.withColumnsRenamed(dict(zip(names, columns, strict=True)))


def op9_html_extraction(spark, sf_dir):
    from .common import table

    return extract(table(spark, sf_dir, "pages"), trained())
