"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

1. A page is scanned once into leaf blocks: the text between two borders of block elements, with the
   tags, classes, ids and roles of its open ancestors.  Scripts, styles, comments, the title and
   embedded objects have no text; ``<br>`` is white space; missing end tags are supplied.
2. A block has two labels, text or not.  Its features are hashed: ancestors' tags and name
   words, its own tag and the element around it, its length, links, punctuation and place, and
   those words of short blocks that regions around articles use.  One weight a feature and four weights of
   neighbouring labels are fitted by maximum likelihood (forward-backward).
3. Viterbi decodes each page; its text blocks are joined.

Labelled pages for the fit: at most ``FIT_PAGES`` pages of the table itself (the first by a hash of
the id, those over ``FIT_CHARS`` code points left out), labelled by the landmarks that their markup
names (:func:`by_landmarks`), and ``VARIANTS`` pages made of each one's blocks in other layouts, whose
labels are known from their making (:func:`made_page`).  The latter teach what pages without
landmarks look like; they hold headers, menus, sidebars, notices, adverts, forms and
comments under many names.  These bounds are of the fit only: every page is extracted whole.

Defined results: null or empty html, or a page without text blocks, gives the empty text; repeated rows
give equal rows; an empty table gives an empty result; a null url stays null.  White space is what
``str.split`` cuts at, no-break spaces included.  Other columns are not read.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import exp, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import forget, in_slices

SIZE = 1 << 15
FIT_PAGES, FIT_CHARS, VARIANTS, EPOCHS = 240, 65_536, 4, 6
SHORT = 12  # words of a block whose words are features, if regions around an article use them
PUNCTUATION = ".,:;!?()"

# Fixed values of HTML: elements without content, without text of the page, and those that end a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title template iframe object svg math canvas audio video noembed noframes xmp".split())
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option
p pre search section select summary table tbody td textarea tfoot th thead tr ul""".split())
#: a start tag ends these open elements, unless one of the second set stands between
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "option": ({"option"}, {"select"}), "optgroup": ({"optgroup"}, {"select"})}
INSIDE_P = frozenset("button option optgroup label caption legend select noscript".split())  # do not end a paragraph

TAG = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/(?![a-zA-Z])[^>]*+(?:>|\Z)
                     |(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
                     |(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z))""", re.S | re.X)
NAMES = re.compile(r"""\b(class|id|role|aria-label|hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    tag: str
    around: tuple[str, ...]  # "tag" and ".word" of every open ancestor, its own element included
    inside: tuple[str, ...]  # those of the block element around its own
    linked: int = 0  # code points inside links


@dataclass
class _Open:
    """The open elements, with how often each tag and name word is among them."""

    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    count: dict[str, int] = field(default_factory=dict)

    def push(self, tag: str, attrs: str) -> None:
        names = [tag]
        for m in NAMES.finditer(attrs) if "=" in attrs else ():
            names += ["." + w.lower() for w in NAME_WORDS.findall(entities.unescape(m[2] or m[3] or m[4] or ""))]
        names = tuple(dict.fromkeys(names))
        self.stack.append((tag, names))
        for n in names:
            self.count[n] = self.count.get(n, 0) + 1

    def pop(self) -> str:
        tag, names = self.stack.pop()
        for n in names:
            self.count[n] -= 1
            if not self.count[n]:
                del self.count[n]
        return tag

    def close(self, tags: set[str] | frozenset[str], barrier: set[str] | frozenset[str] = frozenset()) -> bool:
        """End the innermost open element of ``tags`` with all inside it; False if there is none."""
        if not any(t in self.count for t in tags):
            return False
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in tags:
                while len(self.stack) > k:
                    self.pop()
                return True
            if tag in barrier:
                return False
        return False

    def nearest(self) -> tuple[str, tuple[str, ...]]:
        """The innermost block element, and the names of the one around it."""
        two = list(itertools.islice((x for x in reversed(self.stack) if x[0] in BLOCKS), 2))
        return two[0][0] if two else "", two[1][1] if len(two) > 1 else ()


def leaf_blocks(page: str | None) -> list[Block]:
    """The page's text blocks in order, white space folded, character references decoded."""
    out: list[Block] = []
    if not page:
        return out
    open_, text, linked, at = _Open(), [], [], 0

    def flush() -> None:
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                own, inside = open_.nearest()
                out.append(Block(joined, own, tuple(open_.count), inside, len("".join(linked))))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece:
            text.append(piece)
            if "a" in open_.count:
                linked.append(piece)

    find = TAG.search
    while True:
        m = find(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name, ends, attrs = name.lower(), m["end"] or m["end2"], m["attrs"] or m["attrs2"] or ""
        if ends:
            if name in BLOCKS:
                flush()
            if name in open_.count:
                open_.close({name})
            continue
        if name in BLOCKS:
            flush()
            if name not in INSIDE_P:
                open_.close({"p"}, {"td", "th", "button", "caption"})
            if name in IMPLIED:
                open_.close(*IMPLIED[name])
        elif name == "br":
            text.append(" ")
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
        elif name not in VOID:
            open_.push(name, attrs)
    flush()
    return out


def _bin(n: float) -> int:
    return int(n).bit_length()


@cache
def said_words() -> frozenset[str]:
    """The words that the regions around an article say (:data:`REGIONS`)."""
    return frozenset(w.lower().strip(PUNCTUATION) for _, says in REGIONS.values() for s in says for w in s.split()) - {""}


def features(blocks: list[Block]) -> list[list[int]]:
    """Hashed features of every block."""
    out, n = [], len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        size = len(b.text)
        share = min(b.linked * 4 // max(size, 1), 4)
        last = b.text[-1]
        names = ["a:" + t for t in b.around] + ["i:" + t for t in b.inside]
        names += ["o:" + b.tag, f"n:{_bin(len(words))}", f"l:{share}", f"ln:{share}:{_bin(len(words))}",
                  f"e:{last if not last.isalnum() else 'x'}", f"c:{_bin(b.text.count(','))}", f"s:{_bin(b.text.count('. '))}",
                  f"p:{i * 8 // n}", f"on:{b.tag}:{_bin(len(words))}", "b"]
        names += [s for s, is_ in (("first", i == 0), ("last", i == n - 1), ("sign", "©" in b.text),
                                   ("year", b.text[:40].find("20") >= 0), ("at", "@" in b.text)) if is_]
        if len(words) <= SHORT:
            names += ["w:" + w for w in {w.lower().strip(PUNCTUATION) for w in words} & said_words()]
        out.append([crc32(x.encode("utf-8", "surrogatepass")) & (SIZE - 1) for x in names])
    return out


@dataclass
class Field:
    """Weights of the features (for the label 1 against 0) and of pairs of neighbouring labels."""

    w: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def unary(self, xs: list[list[int]]) -> list[float]:
        return [float(self.w[x].sum()) for x in xs]

    def labels(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the likeliest labels of all blocks together (ties to 0)."""
        if not blocks:
            return []
        (p00, p01), (p10, p11) = self.pair.tolist()
        zero, one, back = 0.0, 0.0, []
        for k, u in enumerate(self.unary(features(blocks))):
            if k == 0:
                zero, one = 0.0, u
                continue
            a, b, c, d = zero + p00, one + p10, zero + p01, one + p11
            back.append((b > a, d >= c))
            zero, one = max(a, b), max(c, d) + u
        out = [int(one > zero)]
        for to_zero, to_one in reversed(back):
            out.append(int(to_one if out[-1] else to_zero))
        return out[::-1]

    def marginals(self, u: list[float]) -> tuple[list[float], np.ndarray]:
        """Probability of label 1 of every block, and the expected number of each pair."""
        (p00, p01), (p10, p11) = self.pair.tolist()
        fwd, z, o = [], 0.0, u[0]
        for k, x in enumerate(u):
            if k:
                z, o = _plus(z + p00, o + p10), _plus(z + p01, o + p11) + x
            fwd.append((z, o))
        total, bz, bo = _plus(z, o), 0.0, 0.0
        prob, pairs = [0.0] * len(u), np.zeros((2, 2))
        for k in range(len(u) - 1, -1, -1):
            prob[k] = exp(fwd[k][1] + bo - total)
            if k:
                z, o = fwd[k - 1]
                one = bo + u[k]
                pairs += [[exp(z + p00 + bz - total), exp(z + p01 + one - total)],
                          [exp(o + p10 + bz - total), exp(o + p11 + one - total)]]
                bz, bo = _plus(p00 + bz, p01 + one), _plus(p10 + bz, p11 + one)
        return prob, pairs


def _plus(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + log1p(exp(b - a)) if a >= b else b + log1p(exp(a - b))


def fit(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 5, rate: float = 0.3,
        decay: float = 1e-4) -> Field:
    """Maximum likelihood by AdaGrad over single pages, with weight decay."""
    model, rng = Field(), np.random.default_rng(seed)
    data = [(features(b), np.array(y), y) for b, y in pages if b]
    seen, seen_pair = np.full(SIZE, 1e-2), np.full((2, 2), 1e-2)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            xs, y, labels = data[k]
            prob, pairs = model.marginals(model.unary(xs))
            own = np.zeros((2, 2))
            np.add.at(own, (y[:-1], y[1:]), 1)
            at = np.concatenate(xs).astype(np.int64)
            step = np.repeat(y - np.array(prob), [len(x) for x in xs])
            at, inverse = np.unique(at, return_inverse=True)
            grad = np.bincount(inverse, step) - decay * model.w[at]
            seen[at] += grad * grad
            model.w[at] += rate * grad / np.sqrt(seen[at])
            grad = own - pairs - decay * model.pair
            seen_pair += grad * grad
            model.pair += rate * grad / np.sqrt(seen_pair)
    return model


# Names that pages give their regions: fixed values, words of class, id and role attributes.
BOILER_TAGS = frozenset("nav footer aside form button select textarea label menu dialog noscript head".split())
BOILER_NAMES = frozenset("""ad ads advert advertisement sponsored promo banner nav navigation navbar menu sidebar footer cookie cookies
consent notice popup modal share social related recommended newsletter subscribe comments comment disqus breadcrumb breadcrumbs
pagination login search widget""".split())
TEXT_TAGS = frozenset(["article", "main"])


def by_landmarks(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that names its regions by elements; None of a page without article or main."""
    if not any(t in TEXT_TAGS for b in blocks for t in b.around):
        return None
    out = []
    for b in blocks:
        boiler = any(t in BOILER_TAGS or (t[0] == "." and t[1:] in BOILER_NAMES) for t in b.around)
        header = "header" in b.around and not any(t in TEXT_TAGS for t in b.around)
        out.append(int(not boiler and not header and any(t in TEXT_TAGS for t in b.around)))
    return out


# What made pages are built of: fixed values, (names of a region, what it may say).
REGIONS = {
    "nav": (["nav", "navbar", "menu", "main-menu", "topnav", "site-navigation", "nav-links", "breadcrumbs", "breadcrumb-trail"],
            ["Home", "About", "About us", "Contact", "News", "Sport", "World", "Business", "Accueil", "Startseite", "Inicio", "Archive", "FAQ",
             "Products", "Blog", "Services", "Sign in", "Log in", "Register", "My account", "Kontakt", "Contacto"]),
    "header": (["header", "site-header", "masthead", "top-bar", "branding", "site-title", "logo", "page-header"],
               ["The Daily Example", "Example News", "Your source for everything", "Search", "Menu", "Skip to content", "Welcome"]),
    "sidebar": (["sidebar", "side", "right-column", "widget", "widget-area", "related", "related-posts", "recommended", "more-stories", "popular",
                 "trending", "tag-cloud", "secondary"],
                ["Related articles", "Most read", "Read more", "See also", "Popular now", "Recommended for you", "Tags", "Categories",
                 "Recent posts", "Archives", "Trending", "Further reading"]),
    "notice": (["cookie-banner", "cookie", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter",
                "subscribe-box", "paywall", "toast", "disclaimer"],
               ["We use cookies to improve your experience.", "Accept all", "Accept", "Decline", "This site uses cookies.", "Manage preferences",
                "Subscribe to our newsletter", "Sign up for free", "Please enable JavaScript", "Nous utilisons des cookies.",
                "Wir verwenden Cookies.", "Usamos cookies.", "Your browser is out of date."]),
    "ad": (["ad", "ads", "advert", "advertisement", "ad-slot", "adbox", "sponsored", "sponsor", "promo", "promotion", "banner", "banner-ad",
            "google-ads", "commercial"],
           ["Advertisement", "Sponsored", "Buy now", "Limited offer", "Shop now", "Learn more", "Anzeige", "Publicité", "50% off today only"]),
    "form": (["form", "search-form", "login", "signup", "contact-form", "subscribe"],
             ["Name", "Email", "E-mail address", "Password", "Search", "Submit", "Send", "Message", "Your email", "Log in", "Remember me", "Subscribe"]),
    "comments": (["comments", "comment-list", "comment", "disqus", "disqus_thread", "responses", "discussion", "replies", "user-comments",
                  "reader-comments", "comment-body"],
                 ["Reply", "Leave a comment", "Comments", "3 comments", "Report", "Like", "says:", "Posted by", "Show more comments", "Répondre",
                  "Kommentare", "Comentarios"]),
    "share": (["share", "social", "share-buttons", "social-links", "post-meta-share", "toolbar", "actions"],
              ["Share", "Tweet", "Share on Facebook", "Email this", "Print", "Copy link", "Follow us"]),
    "footer": (["footer", "site-footer", "bottom", "copyright", "colophon", "legal", "page-footer"],
               ["All rights reserved.", "Privacy policy", "Terms of use", "Contact", "Imprint", "Impressum", "Mentions légales", "Sitemap",
                "© 2024 Example Media", "Powered by Example"]),
}
LANDMARK = {"nav": ["nav"], "header": ["header"], "sidebar": ["aside"], "form": ["form"], "footer": ["footer"], "notice": ["div", "dialog"],
            "ad": ["div", "aside", "ins"], "comments": ["section", "div"], "share": ["div", "ul"]}
CONTENT_NAMES = ["content", "post", "post-content", "entry", "entry-content", "article", "article-body", "story", "story-body", "main", "main-content",
                 "text", "body-copy", "page-content", "prose"]
WRAPPERS = ["container", "wrapper", "row", "col", "inner", "page", "layout", "grid", "box", "site", "clearfix"]


def made_page(rng: np.random.Generator, title: str, paragraphs: list[str], other: list[str]) -> tuple[str, list[int]]:
    """A page of the given article in a layout drawn by ``rng``, with the labels of its blocks in order.

    ``other`` are texts for the regions around the article, comments among them."""
    labels: list[int] = []
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    chance = lambda p: rng.random() < p
    landmarks, named = chance(0.5), chance(0.85)

    def block(tag: str, text: str, label: int, attrs: str = "") -> str:
        labels.append(label)
        return f"<{tag}{attrs}>{text}</{tag}>"

    def element(kind: str) -> tuple[str, str]:
        tag = pick(LANDMARK[kind]) if landmarks else "div"
        own = landmarks and tag in ("nav", "header", "aside", "form", "footer")
        attr = "" if own and chance(0.5) else f' {pick(["class", "class", "id"])}="{pick(REGIONS[kind][0])}"'
        return tag, attr

    def region(kind: str) -> str:
        tag, attr = element(kind)
        says, out = REGIONS[kind][1], []
        if kind in ("nav", "sidebar", "share", "footer") and chance(0.8):
            items = [pick(says) if chance(0.6) else " ".join(pick(other).split()[:int(rng.integers(1, 6))]) for _ in range(int(rng.integers(2, 9)))]
            if chance(0.6):
                out.append("<ul>" + "".join(block("li", f'<a href="/{k}">{esc(x)}</a>', 0) for k, x in enumerate(items)) + "</ul>")
            else:
                out += [block("div", f'<a href="/{k}">{esc(x)}</a>', 0) for k, x in enumerate(items)]
        if kind in ("ad", "notice", "header", "footer", "sidebar"):
            for _ in range(int(rng.integers(1, 3))):
                text = esc(pick(says) if chance(0.5) else pick(other))
                text = "&copy; " + text if kind == "footer" and chance(0.5) else text
                out.append(block(pick(["p", "div", "h3"]), text, 0))
            if kind in ("notice", "header") and chance(0.4):
                out.append(block("button", esc(pick(says)), 0))
        if kind == "form":
            out += [block("label", esc(pick(says)), 0) + "<input type=text>" for _ in range(int(rng.integers(1, 4)))]
            out.append(block("button", esc(pick(says)), 0))
        if kind == "comments":
            out.append(block(pick(["h2", "h3", "h4"]), esc(pick(says)), 0))
            for _ in range(int(rng.integers(1, 5))):
                out.append(f'<div class="{pick(REGIONS[kind][0])}">' + block("div", esc(" ".join(pick(other).split()[:2])), 0)
                           + "".join(block("p", esc(pick(other)), 0) for _ in range(int(rng.integers(1, 3))))
                           + (block("div", f'<a href="#r">{esc(pick(says))}</a>', 0) if chance(0.6) else "") + "</div>")
        if not out or (kind == "ad" and chance(0.2)):
            out.append(block("div", esc(pick(says)), 0))
        return f"<{tag}{attr}>" + "".join(out) + f"</{tag}>"

    def paragraph(text: str) -> str:
        text, words = esc(text), text.split()
        if len(words) > 6 and chance(0.25):
            k = int(rng.integers(1, len(words) - 2))
            tag = pick(["b", "i", "em", "strong", "span", 'a href="/x"', "u", "code"])
            text = " ".join([*map(esc, words[:k]), f"<{tag}>{esc(words[k])}</{tag.split()[0]}>", *map(esc, words[k + 1:])])
        kind = rng.random()
        if kind < 0.15:
            labels.append(1)
            return f"<p>{text}"
        if kind < 0.25:
            return "<ul>" + block("li", text, 1) + "</ul>"
        if kind < 0.35:
            return block("blockquote", text, 1)
        if kind < 0.42:
            return block("div", text, 1)
        if kind < 0.47:
            return "<figure><img src=x>" + block("figcaption", text, 1) + "</figure>"
        if kind < 0.52:
            return "<table><tr>" + block("td", text, 1) + "</tr></table>"
        return block("p", text, 1)

    def article() -> str:
        tag = pick(["article", "main"]) if landmarks and chance(0.8) else pick(["div", "section", "div"])
        attr = f' {pick(["class", "id"])}="{pick(CONTENT_NAMES)}"' if named and (tag == "div" or chance(0.4)) else ""
        out = [block(pick(["h1", "h1", "h2"]), esc(title), 1)] if title else []
        for p in paragraphs:
            if chance(0.1):
                out.append(block(pick(["h2", "h3"]), esc(" ".join(p.split()[:5])), 1))
            out.append(paragraph(p))
            if chance(0.12):
                out.append(block("p", pick(["", "", "<b>"]) + esc(" ".join(p.split()[-int(rng.integers(1, 4)):])), 1))
            if chance(0.08):
                out.append(region(pick(["ad", "share", "notice", "sidebar"])))
        if chance(0.15):
            out.append(region("share"))
        if chance(0.1):
            out.append(region("comments"))
        return f"<{tag}{attr}>" + "".join(out) + f"</{tag}>"

    parts = []
    for kind, p in (("notice", 0.35), ("header", 0.6), ("nav", 0.8), ("ad", 0.5), ("sidebar", 0.15), ("form", 0.15)):
        if chance(p):
            parts.append(region(kind))
    parts.append(article())
    for kind, p in (("share", 0.25), ("comments", 0.45), ("sidebar", 0.35), ("form", 0.2), ("ad", 0.25), ("notice", 0.15), ("footer", 0.8)):
        if chance(p):
            parts.append(region(kind))
    body = "".join(parts)
    for _ in range(int(rng.integers(0, 3))):
        body = f'<div class="{pick(WRAPPERS)}">{body}</div>'
    head = f"<title>{esc(title)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script>"
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>", labels


#: Filler for pages made without a table's texts (a fixed value).
FILLER = ["The council met on Tuesday to discuss the new plan, and most members spoke in favour of it.", "No date was given.",
          "Le projet avance lentement, mais les travaux devraient finir en mai.", "Der Bericht nennt drei Gründe für die Verzögerung.",
          "Los vecinos pidieron más tiempo. Nadie respondió a la pregunta.", "Prices rose by 4 % last year, according to the office.",
          "I do not agree with this at all!", "Great piece, thanks for sharing.", "A short line", "What a day it was for the two teams"]


def training_pages(pages: list[str], variants: int = VARIANTS, seed: int = 17, short: int = 400) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: those given, by their landmarks, and ``variants`` made of each."""
    rng, out, texts = np.random.default_rng(seed), [], list(FILLER)
    articles: list[tuple[str, list[str]]] = []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = by_landmarks(blocks)
        if labels is None or 1 not in labels:
            continue
        out.append((blocks, labels))
        own = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        articles.append((own[0], own[1:] or own))
        texts += [t for t in (b.text for b in blocks) if len(t) <= short][:20]
    if not articles:
        articles = [(FILLER[k], [FILLER[int(j)] for j in rng.integers(0, len(FILLER), 5)]) for k in range(len(FILLER))] * 10
    for title, paragraphs in articles:
        for _ in range(variants):
            k = min(len(paragraphs), int(rng.integers(1, 14)))
            page, labels = made_page(rng, title if rng.random() < 0.8 else "", paragraphs[:k], texts)
            blocks = leaf_blocks(page)
            if len(blocks) == len(labels):
                out.append((blocks, labels))
    return out


def sample_pages(pages: DataFrame, rows: int, chars: int) -> list[str]:
    """html of at most ``rows`` pages of at most ``chars`` code points, one an id, the first ids by a hash."""
    ids = (pages.select("page_id").where("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(rows))
    one = F.min(F.struct(F.xxhash64("html").alias("h"), "html"))
    found = (pages.select("page_id", "html").where(F.length("html") <= chars).join(F.broadcast(ids), "page_id")
             .groupBy("page_id").agg(one.alias("x")).select("page_id", "x.html"))
    return [r.html for r in sorted(found.collect(), key=lambda r: r.page_id)]


def train(pages: DataFrame, rows: int = FIT_PAGES, chars: int = FIT_CHARS, variants: int = VARIANTS) -> Field:
    return fit(training_pages(sample_pages(pages, rows, chars), variants))


def main_text(page: str | None, model: Field) -> str:
    """The text blocks of a page, joined by an empty line."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, y in zip(blocks, model.labels(blocks), strict=True) if y)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or train(pages)
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in in_slices(batches, 64):
            texts = [main_text(h, model) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        extracted, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
