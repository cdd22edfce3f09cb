"""Main text of web pages: site templates removed by counting subtrees per host.

Every page is parsed into elements.  The block
elements are hashed as subtrees (tag, text, children); Spark counts on how many
pages of its host each subtree occurs, and those that occur on many are
deleted as the site's template.  What HTML itself or an element's role
declares to be no article (menus, headers, footers, asides, forms, scripts,
hidden parts) goes even where it does not recur.  A word of a class or id only
claims that: a name made of such words and words of layout alone ("sidebar",
"ad-slot") deletes its element if that holds less than half of the page's text and
all elements of the word no more than half, and never the whole text; a name with any other word
("has-sidebar", "share-price") deletes nothing that does not recur.  Prose inside an article element and
a subtree that holds half of a page's text are content, never template: equal
articles on a host do not delete each other.

Menus and adverts whose words change from page to page recur in shape, not in
text.  So a second hash of every subtree leaves the text out: tag, role, class
words and those of all elements around it.  The shapes that most pages of a host
have form its frame.  From the outside in, the shape that holds more than half
of the text is followed to the element that holds the article; recurring shapes
beside that way are template on the pages that have it, and so is any recurring shape
whose class words claim comments, adverts and the like.  What stands inside an
article element, prose on the way, and a shape that a page repeats (a paragraph
by another name) are never template by shape alone.

Counts are of (host, hash), combined map-side; what recurs on a host is a
bounded list, for at most ``1 / SHARE`` subtrees per subtree of a page can
reach that share, joined back to the host's pages (a plain join, so that AQE
splits a hot host).
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, ship_by_value, slices, table

ship_by_value()

PAGES = 4       # a template occurs on so many pages of its host at least,
SHARE = 0.1     # and on this share of them;
PROSE_SHARE = 0.5       # paragraphs, lists and the like that no article holds: on this share
SHAPE_SHARE = 0.5       # shapes that a host's pages have in common: on this share

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript noframes noembed iframe xmp template svg".split())
MATH = frozenset("math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover "
                 "munderover mmultiscripts mprescripts none mtable mtr mtd mlabeledtr maction semantics annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img".split()) | MATH
EDGELESS = INLINE | frozenset("script style noscript template meta link base title textarea iframe xmp svg button select input object embed "
                              "canvas audio video map area param source track option optgroup datalist".split())
DROP = frozenset("nav footer aside form menu dialog button select input option optgroup datalist object embed applet canvas audio "
                 "video map head script style textarea title noscript noframes noembed iframe xmp template svg annotation annotation-xml frameset".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status".split())
# Words of a class or id that claim an element to be no article.
WORDS = frozenset("nav navbar navigation menu submenu masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored "
                  "promo promotion banner cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay paywall "
                  "newsletter subscribe subscription signup signin login social share sharing related recommended recommendations trending "
                  "breadcrumb breadcrumbs pagination pager comment comments disqus replies respond toolbar widget widgets search searchbox skip "
                  "copyright colophon".split())
# The same inside a run-together word.
_INSIDE = re.compile("sidebar|comment(?!ar)|cookie|newsletter|advert(?!en)|adsby|adslot|adunit|adbox|breadcrumb|footer|navbar|sponsor|paginat|masthead", re.I)
_SURE_INSIDE = re.compile("comment(?!ar)|newsletter|advert(?!en)|adsby|adslot|adunit|adbox|sponsor", re.I)
_REST = frozenset("s ed ion or isement isements ising orial google".split())    # of such a word, without that part
# Words of layout, which say nothing of what an element holds.
LAYOUT = frozenset("a the my js is site page blog post posts entry article articles story stories news content contents main primary secondary global local top bottom "
                   "left right upper lower center middle side inner outer first last box boxes block blocks bar bars wrap wrapper wrapped container "
                   "holder area region zone section sections panel pane slot slots unit units module modules component group row col column columns grid "
                   "list lists item items link links button buttons btn icon icons text title heading header head body form field input label message "
                   "messages msg count counter fixed sticky floating mobile desktop tablet small large big mini full wide sub media network networks "
                   "thread toggle trigger open close dropdown tab tabs card cards view image img logo".split())
# Of the words above, those that name what is never the article, however long it is,
SURE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended recommendations trending "
                 "comment comments disqus replies respond newsletter".split())
# unless the name also holds one of these.
CORE = frozenset("article articles story main primary content contents".split())
CLOSES = {  # a start tag ends an open element of these, up to the boundary
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())), "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])), "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])), "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split()))}

_TAG = re.compile(r"""<(?:!--(?:(?s:.*?)--!?>|(?s:.*)\Z|>)|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z)))""")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMENTS = re.compile(r"(?:\d+ )?(?:reader |user )?comments?(?: \(\d+\))?|leave a (?:reply|comment)", re.I)


class Page:
    """Elements in page order: parents come before their children."""

    def __init__(self, source: str, declared: bool = True):
        self.tag, self.attr, self.parent = ["#root"], [""], [0]
        self.events: list[tuple[int, str | None]] = []      # (element, text), or (element, None): a block begins or ends there
        self._read(source)
        if declared:
            self._judge()
        else:           # counting alone decides; what is no text stays out
            n = len(self.tag)
            self.out, self.inside, self.claimed, self.root = [t in RAW for t in self.tag], [False] * n, [False] * n, [True] * n
            self.claims, self.sure = {}, set()

    def _read(self, source: str) -> None:
        tags, attrs, parents, events, stack, at = self.tag, self.attr, self.parent, self.events, [0], 0
        depth_of = {"#root": 1}
        while True:
            m = _TAG.search(source, at)
            text = source[at:m.start() if m else len(source)]
            if text:
                events.append((stack[-1], htmllib.unescape(text) if "&" in text else text))
            if not m:
                return
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if not m[0].endswith(">"):      # the page ends inside a tag
                return
            if m[1]:
                if tag == "br":
                    events.append((stack[-1], None))
                elif depth_of.get(tag):
                    while True:
                        last = stack.pop()
                        depth_of[tags[last]] -= 1
                        if tags[last] not in EDGELESS:
                            events.append((stack[-1], None))
                        if tags[last] == tag:
                            break
                continue
            if tag in CLOSES:
                mine, stop = CLOSES[tag]
                k = len(stack) - 1
                while k and tags[stack[k]] not in mine and tags[stack[k]] not in stop:
                    k -= 1
                # td closes a td; tr closes td and tr, the outermost in its table
                while k > 1 and tags[stack[k]] in mine and tags[stack[k - 1]] in mine:
                    k -= 1
                if k and tags[stack[k]] in mine:
                    self._cut(stack, k, depth_of)
            if tag not in EDGELESS and depth_of.get("p") and tag not in VOID - {"hr"}:
                k = len(stack) - 1
                while k and tags[stack[k]] != "p" and (tags[stack[k]] in INLINE or tags[stack[k]] in PROSE):
                    k -= 1
                if k and tags[stack[k]] == "p":
                    self._cut(stack, k, depth_of)
            if tag == "br":
                events.append((stack[-1], None))
                continue
            if tag not in EDGELESS:
                events.append((stack[-1], None))
            me = len(tags)
            tags.append(tag)
            attrs.append(m[3][:-1])
            parents.append(stack[-1])
            if tag in RAW:
                if not m[3].endswith("/>") or tag != "svg":
                    end = re.compile(f"</{tag}(?=[\\s/>])[^>]*+>?", re.I).search(source, at)
                    at = end.end() if end else len(source)
            elif tag not in VOID and not (tag in MATH and m[3].endswith("/>")):
                stack.append(me)
                depth_of[tag] = depth_of.get(tag, 0) + 1

    def _cut(self, stack: list[int], k: int, depth_of: dict[str, int]) -> None:
        while len(stack) > k:
            last = stack.pop()
            depth_of[self.tag[last]] -= 1
            if self.tag[last] not in EDGELESS:
                self.events.append((stack[-1], None))

    def _judge(self) -> None:
        """Which elements are declared boilerplate, which lie in an article."""
        n, tags, parents = len(self.tag), self.tag, self.parent
        main = [(t in ("article", "main") or "role" in a and bool(re.search(r"""role\s*=\s*["']?(?:main|article)\b""", a, re.I)))
                and not re.search(r"\bcomment", a, re.I) for t, a in zip(tags, self.attr)]
        holds = main[:]
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[parents[i]] = True
        self.out, self.inside, self.claimed = [False] * n, [False] * n, [False] * n
        self.claims, self.sure = {}, set()
        claims = self.claims
        for i in range(1, n):
            p = parents[i]
            self.inside[i] = self.inside[p] or main[i]
            self.out[i] = self.out[p] or tags[i] in RAW or not holds[i] and self._declared(i, self.inside[p])
            if self.attr[i] and not self.out[i] and not holds[i]:
                self.claimed[i], words, sure = self._claims(i, self.inside[p])
                if words:
                    claims[i] = words
                if sure:
                    self.sure.add(i)
        first: dict[int, str] = {}
        for i, text in self.events:     # a block that opens with the heading "Comments"
            if text and tags[i] in ("h1", "h2", "h3", "h4", "h5", "h6") and not self.out[i]:
                first[i] = first.get(i, "") + text
        for i, text in first.items():
            p = parents[i]
            if _COMMENTS.fullmatch(" ".join(text.split())) and tags[p] in ("section", "div") and not holds[p]:
                if next((k for k in range(p + 1, i + 1) if parents[k] == p), i) == i:
                    self.out[p] = True
        for i in range(1, n):
            self.out[i] = self.out[i] or self.out[parents[i]]
        good = [i for i in range(1, n) if main[i] and not self.out[i]]
        articles = [i for i in good if tags[i] != "main" and "main" not in self.attr[i].lower()] or good
        self.root = [False] * n
        for i in articles:
            self.root[i] = True
        self.root[0] = not articles
        for i in range(1, n):
            self.root[i] = self.root[i] or self.root[parents[i]]
        if claims:
            self._weigh(claims)
        if articles and not any(tags[i] == "h1" and self.inside[i] and not self.out[i] and self.root[i] for i in range(n)):
            for i in range(n):          # the headline stands before its article
                if tags[i] == "h1" and not self.out[i]:
                    self.root[i] = True
                    break
        for i in range(1, n):
            self.root[i] = self.root[i] or self.root[parents[i]]

    def _weigh(self, claims: dict[int, set[str]]) -> None:
        """Delete what class or id words claim: inside an article what is surely
        none, of any size; elsewhere what is a small share of the text."""
        n, parents = len(self.tag), self.parent
        size = [0] * n
        for i, text in self.events:
            if text and not self.out[i]:
                size[i] += sum(map(len, text.split()))
        for i in range(n - 1, 0, -1):
            size[parents[i]] += size[i]
        small = {i: words for i, words in claims.items() if 2 * size[i] < size[0]}
        above: list[frozenset] = [frozenset()] * n          # words claimed by an element or those around it
        total: dict[str, int] = {}
        for i in range(1, n):
            above[i] = above[parents[i]]
            if i in small:
                for w in small[i] - above[i]:
                    total[w] = total.get(w, 0) + size[i]
                above[i] = above[i] | small[i]
        out = self.out[:]
        for i in range(1, n):
            out[i] = (out[i] or out[parents[i]] or i in self.sure and self.inside[i]
                      or i in small and any(2 * total[w] <= size[0] for w in small[i]))
        if any(text and not out[i] and self.root[i] and not text.isspace() for i, text in self.events):
            self.out = out

    def _claims(self, i: int, inside: bool) -> tuple[bool, set[str], bool]:
        """Whether a class or id has a word of boilerplate; such words of the
        names that hold nothing else but words of layout; whether one of these
        names is sure, whatever the size."""
        any_word, found, sure = False, set(), False
        if self.tag[i] in ("html", "body"):
            return any_word, found, sure
        for name, value in _ATTR.findall(self.attr[i]):
            if name.lower() not in ("class", "id"):
                continue
            for token in value.strip("\"'").split():
                words = {w.lower() for w in _WORD.findall(token)}
                own = words & WORDS | {m.lower() for m in _INSIDE.findall(token)}
                if "header" in words and not inside:
                    own.add("header")
                if own:
                    any_word = True
                    if all(w in WORDS or w in LAYOUT or _INSIDE.search(w) and all(r in _REST or r in WORDS or r in LAYOUT for r in _INSIDE.sub(" ", w).split())
                           for w in words):
                        found |= own
                        sure |= not words & CORE and any(w in SURE or _INSIDE.search(w) and _SURE_INSIDE.search(w) for w in words)
        return any_word, found, sure

    def _declared(self, i: int, inside: bool) -> bool:
        tag, attr = self.tag[i], self.attr[i]
        if tag in DROP or tag == "header" and not inside:
            return True
        if not attr or tag in ("html", "body"):
            return False
        for name, value in _ATTR.findall(attr):
            name, value = name.lower(), value.strip("\"'")
            if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            elif name == "style" and _HIDDEN.search(value):
                return True
        return False

    def subtrees(self) -> tuple[list[int], list[int]]:
        """Block elements that may be template, declared boilerplate included,
        and their hashes."""
        n = len(self.tag)
        parts: list[list] = [[] for _ in range(n)]
        size, nth = [0] * n, 0
        for i, text in self.events:
            if text and (words := text.split()):
                parts[i].append((nth, " ".join(words)))
                nth += 1
                size[i] += sum(map(len, words))
        digest = [0] * n
        for i in range(n - 1, 0, -1):
            if size[i]:
                own = "\x00".join([self.tag[i], *(t for _, t in parts[i])])
                digest[i] = xxhash.xxh64_intdigest(own.encode("utf-8", "surrogatepass"))
                p = self.parent[i]
                size[p] += size[i]
                # children come last to first: put in front, in order of their text
                parts[p].append((parts[i][0][0], f"{digest[i]:x}"))
                parts[p].sort(key=lambda x: x[0])
        found = [i for i in range(1, n) if size[i] and self.tag[i] not in INLINE and 2 * size[i] < size[0]
                 and (self.out[i] or self.claimed[i] or not (self.inside[i] and self.tag[i] in PROSE))]
        # the last bit tells prose, which takes more to be template
        return found, [digest[i] & ~1 | (self.tag[i] in PROSE) for i in found]

    def shapes(self) -> dict[int, tuple[int, int, int, int]]:
        """``shape: (shape around it, characters, occurrences, kind)`` of the
        page's block elements that are not inside prose; kind 1 may be template,
        2 surely is if it recurs, 0 is prose or stands inside an article."""
        n, tags, parents = len(self.tag), self.tag, self.parent
        self.shape = shape = [0] * n
        size = [0] * n
        for i, text in self.events:
            if text and tags[i] not in RAW:
                size[i] += sum(map(len, text.split()))
        for i in range(n - 1, 0, -1):
            if tags[i] not in RAW:
                size[parents[i]] += size[i]
        found = {_ROOT: (0, size[0], 1, 0)}
        shape[0] = _ROOT
        for i in range(1, n):
            around, tag = shape[parents[i]], tags[i]
            if not around or tag in INLINE or tag in RAW or tags[parents[i]] in PROSE:
                continue        # no shape: nothing inside has one
            names = sorted({w.lower() for name, value in _ATTR.findall(self.attr[i]) if name.lower() in ("class", "role")
                            for w in _WORD.findall(value)}) if self.attr[i] else ()
            shape[i] = own = xxhash.xxh64_intdigest(" ".join([tag, *names]).encode("utf-8", "surrogatepass"), around)
            if size[i]:
                kind = 2 if i in self.sure else 0 if tag in PROSE or self.inside[i] or self.root[i] and not self.root[0] else 1
                _, before, times, old = found.get(own, (0, 0, 0, kind))
                found[own] = (around, before + size[i], times + 1, min(old, kind))
        return found

    def text(self, template: set[int] | None = None, shapes: dict[int, int] | None = None) -> str:
        out = self.out[:]
        if template:
            for i, h in zip(*self.subtrees()):
                if h in template:
                    out[i] = True
        if shapes:
            here = self.shapes()
            own = out[:]
            for i, h in enumerate(self.shape):
                own[i] = own[i] or h in shapes and (not shapes[h] or shapes[h] in here)
            for i in range(1, len(own)):
                own[i] = own[i] or own[self.parent[i]]
            if any(text and not own[i] and self.root[i] and not text.isspace() for i, text in self.events):
                out = own       # a page of nothing but frame keeps its text
        if template or shapes:
            for i in range(1, len(out)):
                out[i] = out[i] or out[self.parent[i]]
        return " ".join("".join([t if t is not None else " " for i, t in self.events if not out[i] and self.root[i]]).split())


_ROOT = 1       # shape of the page itself


def frame_of(shapes: list[tuple[int, int, int, int, int, int]]) -> dict[int, int]:
    """The template shapes of a host from the shapes its pages have in common:
    ``(shape, shape around it, characters, occurrences, pages, kind)``; each with
    the shape on the way to the article that it stands beside, which a page must
    have for it to be template there (0: none needed)."""
    inside: dict[int, list] = {}
    size = {}
    for s in shapes:
        inside.setdefault(s[1], []).append(s)
        size[s[0]] = s[2]
    found = {s[0]: 0 for s in shapes if s[5] == 2}
    at = _ROOT
    while at in size:
        parts = [s for s in inside.get(at, ()) if s[5] != 2]
        rest = size[at] - sum(s[2] for s in inside.get(at, ()) if s[5] == 2)
        best = max(parts, key=lambda s: (s[2], s[0]), default=None)
        if best is None or 2 * best[2] <= rest or best[3] > 1.5 * best[4]:
            break
        found.update((s[0], best[0]) for s in parts if s is not best and s[5] == 1)
        at = best[0]
    return found


def _host(url) -> F.Column:
    """Lower-case host of a URL; null if it has none."""
    host = F.lower(F.regexp_extract(url, r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#\\]*@)?([^/:?#\\\s]+)", 1))
    return F.when(host != "", F.xxhash64(host))


def recurring(pages: DataFrame, least: int = PAGES, declared: bool = True) -> DataFrame:
    """``(host, hash, is_text, pages, around, size, times, kind)``: subtrees by
    text and by shape that occur on ``least`` pages of their host or more, with
    what :meth:`Page.shapes` says of a shape, summed over the pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sums: dict[tuple[int, int, bool], list[int]] = {}
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(source, declared)
                for h in set(page.subtrees()[1]):
                    sums.setdefault((host, h, True), [0, 0, 0, 0, 0])[0] += 1
                for shape, (around, size, times, kind) in page.shapes().items():
                    own = sums.setdefault((host, shape, False), [0, around, 0, 0, kind])
                    own[0], own[2], own[3], own[4] = own[0] + 1, own[2] + size, own[3] + times, min(own[4], kind)
            cols = [list(c) for c in zip(*((*k, *v) for k, v in sums.items()))] or [[]] * 8
            signed = {k: pa.array(np.array(cols[k], np.uint64).view(np.int64)) for k in (1, 4)}
            yield pa.RecordBatch.from_arrays([signed[k] if k in signed else pa.array(c, pa.bool_() if k == 2 else pa.int64()) for k, c in enumerate(cols)],
                                             ["host", "hash", "is_text", "pages", "around", "size", "times", "kind"])

    return (pages.where("host is not null").select("host", "html")
            .mapInArrow(run, "host long, hash long, is_text boolean, pages long, around long, size long, times long, kind long")
            .groupBy("host", "hash", "is_text").agg(F.sum("pages").alias("pages"), F.min("around").alias("around"), F.sum("size").alias("size"),
                                                    F.sum("times").alias("times"), F.min("kind").alias("kind"))
            .where(F.col("pages") >= least))


def _shares(pages: DataFrame, counts: DataFrame, is_text: bool) -> DataFrame:
    total = pages.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    return counts.where(F.col("is_text") == is_text).join(total, "host")


def templates(pages: DataFrame, least: int = PAGES, share: float = SHARE, counts: DataFrame | None = None) -> DataFrame:
    """``(host, hashes)``: subtrees that occur on at least ``least`` pages and
    ``share`` (prose: ``PROSE_SHARE``) of all pages of their host."""
    need = F.when(F.col("hash").bitwiseAND(1) == 1, F.lit(max(share, PROSE_SHARE))).otherwise(F.lit(share))
    return (_shares(pages, recurring(pages, least) if counts is None else counts, True).where(F.col("pages") >= F.col("all_pages") * need)
            .groupBy("host").agg(F.collect_list("hash").alias("hashes")))


def frames(pages: DataFrame, least: int = PAGES, share: float = SHAPE_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """``(host, shapes)``: the shapes that are template on a host, each followed
    by the one it stands beside, out of the shapes on at least ``least`` of the
    host's pages and ``share`` of them."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = []
            for own in b.column(1).to_pylist():
                rows = [(s["hash"] % (1 << 64), s["around"] % (1 << 64), s["size"], s["times"], s["pages"], s["kind"]) for s in own]
                found.append([x - (x >> 63 << 64) for pair in sorted(frame_of(rows).items()) for x in pair])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], ["host", "shapes"])

    return (_shares(pages, recurring(pages, least) if counts is None else counts, False).where(F.col("pages") >= F.col("all_pages") * share)
            .groupBy("host").agg(F.collect_list(F.struct("hash", "around", "size", "times", "pages", "kind")).alias("own"))     # at most 1/share of a page's shapes
            .mapInArrow(choose, "host long, shapes array<long>").where(F.size("shapes") > 0))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = PAGES,
              share: float = SHARE, declared: bool = True) -> DataFrame:
    """A row per page: ``page_id, url, text, n_chars``.

    Null and empty html give the empty text; pages without a host are not
    compared with others; null and repeated ids are pages of their own (equal
    pages count as pages of the host); ties of two shapes for the most text go
    to the larger hash; other columns are ignored; an empty table gives no rows.
    Very long pages are parsed whole, in memory in proportion to them.  With
    ``declared`` off, neither elements nor names decide, only counting does.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), _host(F.col(url_col).cast("string")).alias("host"))
    counts = materialize(recurring(source, least, declared), "recurring")
    found = materialize(templates(source, least, share, counts).join(frames(source, least, counts=counts), "host", "full_outer"), "templates")

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            packed = [c.compress(x) for x in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary()), b.column(3)], ["page_id", "url", "packed", "host"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdDecompressor()
        for b in slices(batches):
            texts = []
            for packed, hashes, frame in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                page = Page(c.decompress(packed).decode("utf-8", "surrogatepass"), declared)
                texts.append(page.text({h % (1 << 64) for h in hashes} if hashes else None, 
                                       {t % (1 << 64): b % (1 << 64) for t, b in zip(frame[::2], frame[1::2])} if frame else None))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return (source.mapInArrow(press, "page_id long, url string, packed binary, host long").join(found, "host", "left")
            .select("page_id", "url", "packed", "hashes", "shapes").mapInArrow(run, "page_id long, url string, text string, n_chars long"))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
