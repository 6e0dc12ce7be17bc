"""Main text of web pages by wrappers: union-free expressions inferred from pages of one host.

A page is read as a token stream of tags and texts. Its balanced parts become groups; neighbours
of one kind fold into a repeated group. A host's wrapper starts as one page and is aligned with
further ones: what only one side has becomes optional, runs of different length repeated, texts
that differ become slots. The wrapper then says where a host's pages hold their main text; each
page is aligned with it and the text slots of those places are returned.
"""

from __future__ import annotations

import html
import json
import re
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.llm.base import slices, staged

# About so many pages, and later wrappers, are aligned at once. Elements nested deeper lie flat in the last
# one, as blocks of its text: their text stays, their names say nothing.
AT_ONCE, DEEPEST = 16, 400
sys.setrecursionlimit(max(sys.getrecursionlimit(), 50 * DEEPEST))
# A text is a template's when so many pages, and this share of those with its place, have it there.
SEVERAL, SHARE, TEXTS = 3, 0.8, 256
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<svg\b[^>]*/>"
    r"|<(script|style|noscript|template|textarea|svg|iframe|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# What HTML says of its elements, and the names pages use for what is no article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
            "section summary table tbody td tfoot th thead title tr ul".split())
ENDS_P = BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
SECTIONS = set("html body main section div article center table tbody tr td".split())
NO_ARTICLE = set("head title nav menu header footer aside form fieldset button dialog label legend select "
                 "option object canvas audio video map".split())
NO_ARTICLE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget "
    "widgets footer header masthead share sharing social related recommended teaser teasers comment comments "
    "commentlist disqus reply replies respond pagination pager toolbar skip copyright disclaimer hidden".split())
ARTICLE_NAMES = {"main", "articlebody"}
LISTS = set("ul ol menu dl div section table center details".split())
NAMED_ANYHOW = {"html", "body", "main", "article"}  # never refused for a name
PAGE_PARTS = set("article main nav header footer aside section h1".split())  # a form around them holds a page
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LABELS = HEADINGS | set("li dt dd td th caption summary figcaption".split())


def kind_of(tag: str, attributes: str) -> str:
    """What tokens are compared by: the tag and the names it is given, digits left out."""
    if "=" not in attributes:
        return tag
    names = sorted({w for m in ATTRIBUTE.finditer(attributes) for w in re.split(
        r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()) if w})
    return " ".join([tag, *names])


def named_out(tag: str, attributes: str) -> bool:
    """Whether a whole name, or all parts of one, is among those of what is no article."""
    if tag in NAMED_ANYHOW or "=" not in attributes:
        return False
    return any(parts and NO_ARTICLE_NAMES.issuperset(parts) for m in ATTRIBUTE.finditer(attributes)
               for w in (m[2] or m[3] or m[4] or "").lower().split()
               if (parts := [x for x in re.split(r"[^a-z]+", w) if x]))


class Elements(dict):
    """(tag, kind, whether it is named as no article) of a tag and its attributes, as written."""

    FULL = 20_000

    def __missing__(self, written: tuple[str, str]) -> tuple[str, str, bool]:
        tag = written[0].lower()
        told = (tag, kind_of(tag, written[1]), named_out(tag, written[1]))
        if len(self) < self.FULL:
            self[written] = told
        return told


def parse(page: str, known: Elements | None = None) -> list:
    """Token stream to balanced groups: (kind, children, named as no article) and texts, as str.

    A form around parts of a page is a plain division: whole pages often stand in one. Elements
    without names that hold nothing but one of the same tag are left out.
    """
    known = Elements() if known is None else known
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]
    flat: dict[str, int] = {}
    forms: list[tuple[list, int, int]] = []  # where open ones stand: list, place, depth
    around: list[tuple[list, int]] = []
    at = 0

    def close(names: set[str], until: set[str]) -> None:
        """Closes the nearest open element of ``names`` unless one of ``until`` comes before."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    for m in TOKEN.finditer(page):
        start = m.start()
        if start > at:
            stack[-1][1].append(page[at:start])
        at = m.end()
        written = m[3]
        if not written:
            continue
        if m[2]:
            tag = written.lower()
            if tag == "br":
                stack[-1][1].append(("br", [], False))
            elif flat.get(tag):
                flat[tag] -= 1
                if tag in BLOCK:
                    stack[-1][1].append(("hr", [], False))
            else:
                close({tag}, {"table"} if tag not in BLOCK else set())
            continue
        tag, kind, named = known[written, m[4]]
        if tag in ENDS_P:
            close({"p"}, {"table", "ul", "ol", "div", "section", "article", "blockquote"} - {tag})
        if tag in ENDS_OWN:
            close(ENDS_OWN[tag], HOLDS.get(tag, set()))
        into = stack[-1][1]
        if forms and tag in PAGE_PARTS:
            around += [(x, i) for x, i, depth in forms if depth < len(stack) and stack[depth][1] is x[i][1]]
            forms = []
        if tag not in VOID and not m[4].rstrip().endswith("/"):
            if len(stack) >= DEEPEST:
                flat[tag] = flat.get(tag, 0) + 1
                if tag in BLOCK:
                    into.append(("hr", [], False))
                continue
            children: list = []
            if tag == "form":
                forms.append((into, len(into), len(stack)))
            into.append((kind, children, named))
            stack.append((tag, children))
        else:
            into.append((kind, [], named))
    if at < len(page):
        stack[-1][1].append(page[at:])
    for into, i in around:
        kind, children, named = into[i]
        into[i] = ("div" + kind[4:], children, named)
    unwrap(root)
    return root


def unwrap(root: list) -> None:
    """Puts the one child of an element without names in its place if it is of the same tag."""
    open_lists = [root]
    while open_lists:
        children = open_lists.pop()
        for i, c in enumerate(children):
            if isinstance(c, str):
                continue
            # One element has a blank text on each side at most.
            while 0 < len(c[1]) <= 3 and not c[2] and " " not in c[0]:
                inner = [x for x in c[1] if not isinstance(x, str) or x.strip()]
                if len(inner) != 1 or isinstance(inner[0], str) or inner[0][0].split(" ")[0] != c[0]:
                    break
                c = children[i] = inner[0]
            if c[1]:
                open_lists.append(c[1])


def folded(keys: list[str], longest: int = 4) -> list[tuple[int, int, int]]:
    """Tandem repeats: (start, period, count), in order; count 1 has period 1."""
    out, i, n = [], 0, len(keys)
    if n == 1:
        return [(0, 1, 1)]
    while i < n:
        best = (i, 1, 1)
        for p in range(1, longest + 1):
            c = 1
            while keys[i:i + p] == keys[i + c * p:i + (c + 1) * p] and i + (c + 1) * p <= n:
                c += 1
            if c > 1 and c * p > best[1] * best[2]:
                best = (i, p, c)
            if c > 1 and p == 1:
                break
        out.append(best)
        i += best[1] * best[2]
    return out


def key(child) -> str:
    return "#" if isinstance(child, str) else child[0]


def bare(children: list) -> list:
    """Children without blank texts."""
    return [c for c in children if not isinstance(c, str) or c.strip()]


# A group: k kind ('#' text, '(' a repeated run of several); kids; rep, opt; no: named as no article on every
# page; text (a constant, or None for a slot); seen: pages that have it; texts: pages by text, the frequent
# ones; chars, links: text and text in links below, summed over the pages seen.
Group = dict


def said(text: str) -> str:
    """A text's hash and length; white space counts as one blank."""
    text = " ".join(text.split())
    return f"{zlib.crc32(text.encode('utf-8', 'replace')):x}.{len(text)}"


def counted(a: dict, b: dict, apart: bool) -> dict:
    """Pages by text of two groups, of the same page or of pages apart. Bounded: what is frequent stays."""
    if not a and not b:
        return {}
    out = dict(a)
    for t, n in b.items():
        out[t] = out.get(t, 0) + n if apart else max(out.get(t, 0), n)
    if len(out) > 2 * TEXTS:
        cut = sorted(out.values())[-TEXTS - 1]
        out = {t: n - cut for t, n in out.items() if n > cut}
    return out


def group_of(child) -> Group:
    if isinstance(child, str):
        return {"k": "#", "kids": [], "rep": False, "opt": False, "no": False, "text": child.strip(), "seen": 1,
                "texts": {said(child): 1}, "chars": len(child.strip()), "links": 0}
    kids = groups_of(child[1]) if child[1] else []
    if len(kids) == 1:
        chars, links = kids[0]["chars"], kids[0]["links"]
    else:
        chars, links = sum([g["chars"] for g in kids]), sum([g["links"] for g in kids])
    if child[0] == "a" or child[0].startswith("a "):
        links = chars
    return {"k": child[0], "kids": kids, "rep": False, "opt": False, "no": child[2], "text": None, "seen": 1, "texts": {},
            "chars": chars, "links": links}


def groups_of(children: list) -> list[Group]:
    """The wrapper of one page's children: runs folded into repeated groups."""
    children = bare(children)
    if len(children) == 1:
        return [group_of(children[0])]
    out = []
    for start, period, count in folded([key(c) for c in children]):
        turns = []
        for t in range(count):
            some = [group_of(c) for c in children[start + t * period:start + (t + 1) * period]]
            turns.append(some[0] if period == 1 else Group(
                k="(" + "|".join(g["k"] for g in some), kids=some, rep=False, opt=False, no=False, text=None, seen=1, texts={},
                chars=sum(g["chars"] for g in some), links=sum(g["links"] for g in some)))
        whole = turns[0]
        for t in turns[1:]:
            whole = joined(whole, t, False)
        whole["rep"] = count > 1
        out.append(whole)
    return out


# Cells of the table of a longest common subsequence; longer lists are cut in two first.
CELLS = 1_000_000


def cut_at(a: np.ndarray, b: np.ndarray) -> int:
    """Where a longest common subsequence passes ``b`` half way through ``a``."""
    def lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int64)
        for k in x:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == k)))
        return row

    half = len(a) // 2
    return int((lengths(a[:half], b) + lengths(a[half:][::-1], b[::-1])[::-1]).argmax())


def pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists of kinds, in memory that grows with their lengths."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    n, m = len(a), len(b)
    if n * m > CELLS and n > 1:
        number = {k: i for i, k in enumerate(dict.fromkeys([*a, *b]))}
        j = cut_at(np.array([number[k] for k in a]), np.array([number[k] for k in b], np.int64))
        half = n // 2
        return pairs(a[:half], b[:j]) + [(half + x, j + y) for x, y in pairs(a[half:], b[j:])]
    if n == 1 or m == 1:
        one, rest = (a[0], b) if n == 1 else (b[0], a)
        if one not in rest:
            return []
        return [(0, rest.index(one))] if n == 1 else [(rest.index(one), 0)]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def joined(a: Group, b: Group, apart: bool = True) -> Group:
    """One group for two of a kind, of the same page or of pages apart."""
    return {"k": a["k"], "kids": aligned(a["kids"], b["kids"], apart), "rep": a["rep"] or b["rep"],
            "opt": a["opt"] or b["opt"], "no": a["no"] and b["no"], "text": a["text"] if a["text"] == b["text"] else None,
            "seen": a["seen"] + b["seen"] if apart else max(a["seen"], b["seen"]),
            "texts": counted(a["texts"], b["texts"], apart),
            "chars": a["chars"] + b["chars"], "links": a["links"] + b["links"]}


def aligned(a: list[Group], b: list[Group], apart: bool = True) -> list[Group]:
    """One list of groups for two: matches joined, the rest optional; new neighbours of one kind
    become a repeated group."""
    if not a and not b:
        return []
    out: list[Group] = []

    def add(g: Group, optional: bool) -> None:
        if out and out[-1]["k"] == g["k"]:
            out[-1] = joined(out[-1], g, False)
            out[-1]["rep"] = True
            return
        if optional:
            g["opt"] = True
        out.append(g)

    i = j = 0
    for x, y in [*pairs([g["k"] for g in a], [g["k"] for g in b]), (len(a), len(b))]:
        for g in a[i:x]:
            add(g, True)
        for g in b[j:y]:
            add(g, True)
        if x < len(a):
            add(joined(a[x], b[y], apart), False)
        i, j = x + 1, y + 1
    return out


def refused(kind: str, named: bool) -> bool:
    """Elements that are never part of an article."""
    return named or kind.split(" ")[0] in NO_ARTICLE


def mark(wrapper: list[Group]) -> list[Group]:
    """Marks the groups that hold the main text: articles that have texts of their own, or else the
    smallest section with most of the text that is neither refused, in links nor a template's. Below
    them, texts that pages share and optional blocks of links are marked as not part of it."""
    found = []

    def look(groups: list[Group]) -> None:
        for g in groups:
            tag, *names = g["k"].split(" ")
            if refused(g["k"], g["no"]):
                continue
            if tag in ("article", "main") or not ARTICLE_NAMES.isdisjoint(names):
                found.append(g)
            else:
                look(g["kids"])

    def mass(g: Group, shared: bool = False) -> int:
        """Characters below that may be an article's: not refused, not in links, not the same on every
        page unless ``shared``."""
        if refused(g["k"], g["no"]) or g["k"].split(" ")[0] == "a":
            return 0
        if g["k"] == "#":
            return 0 if g["text"] is not None and g["seen"] >= SEVERAL and not shared else g["chars"]
        return sum(mass(x, shared) for x in g["kids"])

    def part(groups: list[Group], out: list) -> list:
        """Marks what is a template's below; collects (group, texts)."""
        for g in groups:
            if g["k"] == "#":
                least = max(SEVERAL, SHARE * g["seen"])
                out.append((g, [t for t, n in g["texts"].items() if n >= least]))
            elif g["opt"] and g["seen"] >= SEVERAL and 0 < g["chars"] == g["links"] and g["k"].split(" ")[0] in LISTS:
                g["off"] = True
            part(g["kids"], out)
        return out

    look(wrapper)
    if any(mass(g) for g in found):
        found = [g for g in found if mass(g) or g["seen"] < SEVERAL]
    if not found:
        # Where pages are copies of each other, what they share is no template.
        all_of = sum(mass(g, True) for g in wrapper)
        shared = 2 * sum(mass(g) for g in wrapper) < all_of
        groups, total = wrapper, sum(mass(g, shared) for g in wrapper)
        while total:
            top = max(groups, key=lambda g: mass(g, shared))
            # A run of blocks, or a single block of text, is part of what holds the main text.
            if top["rep"] or top["k"].split(" ")[0] not in SECTIONS or mass(top, shared) < 0.6 * total:
                break
            found, groups = [top], top["kids"]
        found = found or [g for g in wrapper if g["k"] != "#" and not refused(g["k"], g["no"])]
    for g in [x for g in found for x in (g["kids"] if g["k"][0] == "(" else [g]) if not refused(x["k"], x["no"])]:
        g["main"] = True
        texts = part(g["kids"], [])
        if 2 * sum(x["texts"][t] * int(t.split(".")[1]) for x, drop in texts for t in drop) < g["chars"]:
            for x, drop in texts:
                x["drop"] = drop
    return wrapper


def infer(pages: list[str]) -> list[Group]:
    """The wrapper of some pages of one host. Equal pages count once."""
    return mark(merged(groups_of(parse(p)) for p in dict.fromkeys(pages)))


def merged(some) -> list[Group]:
    """One wrapper for several of different pages."""
    whole = None
    for one in some:
        whole = one if whole is None else aligned(whole, one)
    return whole or []


def slim(groups: list[Group]) -> list[dict]:
    """What extraction reads of a marked wrapper: below groups without a mark nothing."""
    out = []
    for g in groups:
        kids = slim(g["kids"])
        if not any(x["kids"] or len(x) > 2 for x in kids):
            kids = []
        out.append({"k": g["k"], "kids": kids} | {x: g[x] for x in ("main", "off", "drop") if g.get(x)})
    return out


def packed(groups: list[Group]) -> bytes:
    return zlib.compress(json.dumps(groups).encode(), 1)


def unpacked(data: bytes) -> list[Group]:
    return json.loads(zlib.decompress(data))


def matched(children: list, wrapper: list[Group]) -> list:
    """(child, its group or None) for a page's children aligned with a wrapper's groups."""
    told = [i for i, c in enumerate(children) if not isinstance(c, str) or c.strip()]
    names = [key(children[i]) for i in told]
    runs = folded(names)
    kinds = [names[s] if p == 1 else "(" + "|".join(names[s:s + p]) for s, p, _ in runs]
    group: dict[int, Group | None] = {}
    for i, j in pairs(kinds, [g["k"] for g in wrapper]):
        start, period, count = runs[i]
        for t in range(start, start + period * count):
            group[told[t]] = wrapper[j] if period == 1 else next(
                (x for x in wrapper[j]["kids"] if x["k"] == names[t]), None)
    return [(c, group.get(i)) for i, c in enumerate(children)]


class Blocks:
    """Collects text; a block ends where a block element begins or ends.

    Of blocks that hold nothing but texts the pages share, those before the first and after the last of
    the page's own go, and between them paragraphs: headings, list items, cells and what leads into a list
    stay with what they stand beside.
    """

    def __init__(self):
        self.done, self.part, self.own = [], [], False
        self.held: list[tuple[str, bool, str]] = []  # text, the page's own, tag of the block
        self.tag = ""

    def end(self, tag: str = "") -> None:
        if self.part:
            text = " ".join(html.unescape("".join(self.part)).split())
            if text:
                self.held.append((text, self.own, self.tag))
        self.part, self.own, self.tag = [], False, tag

    def whole(self) -> None:
        """Ends what was collected for one part of the page."""
        self.end()
        own = [i for i, (_, mine, _) in enumerate(self.held) if mine]
        if own:
            tags = [tag for _, _, tag in self.held] + [""]
            self.done += [text for i, (text, mine, tag) in enumerate(self.held) if mine or own[0] < i < own[-1] and (
                tag in LABELS or tags[i + 1] in ("li", "dt", "td"))]
        self.held = []

    def take(self, children: list, wrapper: list[Group] | tuple = (), head: bool = True) -> None:
        """``head``: an element named header belongs to what is taken."""
        for c, g in matched(children, wrapper) if wrapper else ((c, None) for c in children):
            if isinstance(c, str):
                self.part.append(c)
                if not self.own and c.strip() and not (g and g.get("drop") and said(c) in g["drop"]):
                    self.own = True
                continue
            tag = c[0].split(" ")[0]
            if (c[2] or tag in NO_ARTICLE) and not (head and not c[2] and tag in ("header", "hgroup")) or g and g.get("off"):
                self.end()
                continue
            if tag == "br":
                self.part.append(" ")
                continue
            if tag in BLOCK:
                self.end(tag)
            self.take(c[1], g["kids"] if g else (), head)
            if tag in BLOCK:
                self.end()


def extract(children: list, wrapper: list[Group], out: Blocks, missed: list | None = None) -> bool:
    """Takes the main text of a page's groups aligned with a wrapper; False if none is marked there.
    ``missed`` gets the page's groups that the wrapper doesn't have."""
    found = False
    told = [c for c in children if not isinstance(c, str)]
    for c, g in matched(told, [x for x in wrapper if x["k"] != "#"]):
        if g is None:
            if missed is not None and not refused(c[0], c[2]):
                missed.append(c)
            continue
        if g.get("main"):
            out.end()
            out.take(c[1], g["kids"], c[0].split(" ")[0] in ("article", "main"))
            out.whole()
            found = True
        elif extract(c[1], g["kids"], out, missed):
            found = True
    return found


def unnamed(children: list) -> list:
    """The same groups, none refused for its names or as a form."""
    return [c if isinstance(c, str) else ("div" if c[0].split(" ")[0] == "form" else c[0], unnamed(c[1]), False)
            for c in children]


def main_text(page: str, wrapper: list[Group], known: Elements | None = None) -> str:
    """The page's main text. A page that has no text where its host's wrapper looks is a wrapper
    of its own, then one whose names say nothing; one without any element is text as it is. A page
    whose main text lies by itself in groups that the wrapper doesn't have is its own wrapper, too."""
    tree = parse(page, known)
    out, missed = Blocks(), []
    extract(tree, wrapper, out, missed)
    if out.done and missed:
        own, rest = Blocks(), Blocks()
        extract(tree, mark(groups_of(tree)), own)
        for c in missed:
            rest.take([c], (), False)
            rest.whole()
        if not set(rest.done).isdisjoint(own.done):
            return "\n".join(own.done)
    if out.done:
        return "\n".join(out.done)
    for own in (tree, unnamed(tree)):
        found = extract(own, mark(groups_of(own)), out)
        if out.done:
            return "\n".join(out.done)
    if not found:
        out.take(tree, (), False)
        out.whole()
    return "\n".join(out.done)


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", at_once: int = AT_ONCE) -> DataFrame:
    """host, wrapper (as JSON): one row per host, from all its different pages.

    Pages become groups with hashes of their texts. Those of a host are dealt by their hash to parts
    of about ``at_once`` pages; each part becomes a wrapper, and ``at_once`` parts one in each further
    round. So no task holds a host's pages, however many there are.
    """
    told = pages.select(host(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html")
                        ).filter("html IS NOT NULL").withColumn("h", F.xxhash64("html"))

    def shrink(batches):
        elements = Elements()
        for batch in batches:
            for part in slices(batch, 1):
                made = [packed(groups_of(parse(x, elements))) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(made, pa.binary())], names=["host", "h", "w"])

    level = staged(told.mapInArrow(shrink, "host string, h long, w binary").dropDuplicates(["host", "h"]), "groups")
    sizes = staged(level.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    parts = F.ceil(F.col("n") / F.lit(at_once)).cast("long")
    level = level.join(sizes.withColumnRenamed("host", "host2"), F.col("host") == F.col("host2")).select(
        "host", F.pmod(F.xxhash64("h"), parts).alias("part"), "h", "w")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        some = rows.sort_values("h")
        whole = merged(unpacked(x) for x in some["w"])
        return pd.DataFrame({"host": [some["host"].iloc[0]], "part": [int(some["part"].iloc[0])],
                             "h": [int(some["h"].iloc[0])], "w": [packed(whole)]})

    left = -(-most // at_once)
    while True:
        level = staged(level.groupBy("host", "part").applyInPandas(
            merge, "host string, part long, h long, w binary"), "merged")
        if left <= 1:
            break
        left = -(-left // at_once)
        level = level.withColumn("part", F.floor(F.col("part") / F.lit(at_once)).cast("long"))

    def finish(batches):
        for batch in batches:
            made = [json.dumps(slim(mark(unpacked(x)))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["host", "wrapper"])

    return level.select("host", "w").mapInArrow(finish, "host string, wrapper string")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 at_once: int = AT_ONCE) -> DataFrame:
    """One row per row of ``pages``: its id, url, text, n_chars.

    ``text`` is the page's main text, one line per block; empty if there is none or the page is
    null. Pages without a url share the wrapper of the empty host. Repeated rows come back as
    often; an empty table gives no rows. Other columns are not read.
    """
    found = staged(wrappers(pages, url_col, html_col, at_once).withColumnRenamed("host", "host2"), "wrappers")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    rows = rows.withColumn("host", host(F.col("url"))).join(found, F.col("host") == F.col("host2"), "left")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        known: dict[str, list] = {}
        elements = Elements()
        for batch in batches:
            for part in slices(batch, 2):
                texts = []
                for page, name, w in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                    if name not in known:
                        if len(known) > 5000:
                            known.clear()
                        known[name] = json.loads(w) if w else []
                    texts.append(main_text(page or "", known[name], elements))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    out = rows.select("id", "url", "html", "host", "wrapper").mapInArrow(
        run, f"id {id_type}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col)
