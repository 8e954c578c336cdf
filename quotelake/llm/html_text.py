"""Main text of web pages: site style trees, and the branches they show to be noise.

Pages of one host are merged into its style tree: nodes are element paths (tag, class, id and
role from the root on), and each knows in how many pages it occurs, with which sequences of
child elements, and with which blocks of text. Importance follows entropy with the number m
of pages as base. Presentation: the entropy of a node's child sequences. Content: one less
the mean entropy of its blocks, so a block on every page counts nothing and a block on one
page counts fully. Both are joined with weight ``GAMMA ** l`` for a node with l different
child sequences.

What an element says of itself weighs in, by tag, role, and the words of class and id.
Navigation, headers, footers, asides, forms and the like are noise, and so is an element with
a name that has no word but such (cookie-notice) and words of place or form beside them
(comment-list): these leave a page whatever their entropy, since comments are different on
each page. An article or main part stays. A name that has other words too (social-impact,
share-price) only makes doubt: ``DOUBT`` of the importance is left. Words that tell of a state
or topic (has-sidebar, category-social, comments-open) do not count, in articles and headings
and in ids of sections only names that are such words throughout do, and ids of headings are
anchors. All but the named ones are judged by entropy, with ``PRIOR`` pages added on which a
node would be unique: what two pages have in common wholly is noise, what they have in common
in part takes more pages to be so. Nodes below ``LEAST`` are noise branches and leave every
page; if a page has nothing else, only those leave it that say so of themselves. Equal pages
of a host count once. If a page has an article or main part, its text is what is left of that.
Plain text elements of an article have no node of their own: they stay or go with what they
are in. Digits in names are one, so that numbered elements share a node.

Defined results: null and empty html have no text; a page without a host shares the tree of
the other pages without one; unclosed elements end where their parents end, and a new
paragraph, list item, row or cell ends an open one, a new block an open drawing or formula.
Formulas and the content of objects are text; drawings, players and what stands in for scripts
are not.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.store import prepared, stored

GAMMA = 0.9
DOUBT = 0.7
LEAST = 0.4
PRIOR = 1

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_LETTERS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_RAW = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in (
    "script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
# Elements whose content is not shown as text, and drawings and formulas, which a block ends.
_MUTE = frozenset("noscript template svg canvas video audio select datalist annotation annotation-xml".split())
_FOREIGN = frozenset(("svg", "math"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol "
    "p pre section summary table caption tbody thead tfoot tr td th ul".split())
# An open element that a new one of the same kind ends, and what shields it.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
         "option": ({"option"}, {"select"})}
_ENDS_P = _BLOCK - {"html", "head", "body", "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
_SHIELDS_P = {"td", "th", "table", "button", "article", "section", "div", "li", "blockquote", "body", "main",
              "object"} | _MUTE
_HEAD_ONLY = frozenset("head meta link base title script style noscript template".split())
_NOISE_TAGS = frozenset("head nav footer aside form button dialog menu input label".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu "
                         "menubar toolbar".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer comment comments disqus respond reply replies "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended recommendations teaser teasers widget login search pagination "
    "pager toolbar masthead topbar topnav sitenav copyright skip alert alerts toast disclaimer paywall".split())
# Words beside a word of noise that leave a name what it is.
_PLACES = frozenset(
    "site page post posts main article content contents list lists item items box boxes wrap wrapper container "
    "inner outer top bottom left right middle center block area section panel bar button buttons btn link links "
    "form text title header head body heading icon icons group row rows col column columns grid card cards js wp "
    "global primary secondary tertiary sticky fixed floating slot unit zone more thread author user meta count "
    "toggle mobile desktop small large big mini mega sub drop down dropdown view hidden active blog web app ui id "
    "module component holder region layer outerwrap leaderboard skyscraper rectangle line entry".split())
# Names that begin or end so tell of a state or topic of what they are on.
_STATES = frozenset("has no not with without is category tag topic".split())
_STATES_AFTER = frozenset("open closed enabled disabled".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tfoot tr td th "
                   "figure figcaption caption header hgroup address".split())


def _said(tag: str, classes: str, ids: str) -> tuple[bool, bool, bool]:
    """What the class and id of an element say of it: noise, perhaps noise, a header."""
    noise = doubt = header = False
    if tag in ("html", "body", "main"):
        return noise, doubt, header
    for names, whole in ((classes, tag in _HEADINGS or tag == "article"),
                         ("" if tag in _HEADINGS else ids, tag in ("article", "section"))):
        for name in names.split():
            words = _LETTERS.findall(name)
            if len(words) > 1 and (words[0] in _STATES or words[-1] in _STATES_AFTER
                                   or whole and not _NOISE_WORDS.issuperset(words)):
                continue
            header = header or "header" in words
            if not _NOISE_WORDS.isdisjoint(words):
                if all(w in _NOISE_WORDS or w in _PLACES for w in words):
                    noise = True
                else:
                    doubt = True
    return noise, doubt and not noise, header


class _Open:
    """An open element; chain: the keys of the judged elements from the root to it."""

    __slots__ = ("tag", "noise", "main", "path", "children", "judged", "chain", "label", "mute")

    def __init__(self, tag, noise, main, path, judged, chain, label=0, mute=False):
        self.tag, self.noise, self.main, self.path = tag, noise, main, path
        self.judged, self.chain, self.label, self.mute = judged, chain, label, mute
        self.children: list[str] = []


class Page:
    """Blocks of a page's text with the judged nodes above them, in page order.

    blocks: (text, in the article, keys of judged nodes); styles: key -> child sequence and
    label by what the element says of itself (-1 noise, 1 article, 2 perhaps noise, 0 nothing).
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, bool, tuple[int, ...]]] = []
        self.styles: dict[int, tuple[str, int]] = {}
        self._stack = [_Open("", False, False, "", None, ())]
        self._parts: list[str] = []
        at, end = 0, len(source)
        while at < end:
            found = _TAG.search(source, at)
            if not found:
                self._text(source[at:])
                break
            if found.start() > at:
                self._text(source[at:found.start()])
            at = found.end()
            if found[0].startswith("<![CDATA["):
                self._text(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            if tag in _RAW:
                if not rest.endswith("/"):
                    stop = _RAW[tag].search(source, at)
                    at = stop.end() if stop else end
                continue
            self._start(tag, rest)
        while len(self._stack) > 1:
            self._pop()
        self._end_block()

    def _text(self, text: str) -> None:
        if self._stack[-1].tag != "head" and not self._stack[-1].mute:
            self._parts.append(text)

    def _end_block(self) -> None:
        if self._parts:
            text = "".join(self._parts)
            self._parts = []
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            if text:
                self.blocks.append((text, self._stack[-1].main, self._stack[-1].chain))

    def _pop(self) -> None:
        top = self._stack[-1]
        if top.tag in _BLOCK and not top.mute:
            self._end_block()
        if top.judged is not None:
            self._end_block()
            self.styles[top.judged] = (" ".join(top.children), top.label)
        self._stack.pop()

    def _close(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                while len(self._stack) > i:
                    self._pop()
                return

    def _end_open(self, tags, shields) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[i].tag
            if tag in tags:
                while len(self._stack) > i:
                    self._pop()
                return
            if tag in shields:
                return

    def _start(self, tag: str, rest: str) -> None:
        if tag not in _HEAD_ONLY and any(x.tag == "head" for x in self._stack[1:3]):
            self._end_open({"head"}, ())
        if tag in _BLOCK:
            self._end_open(_FOREIGN, {"foreignobject", "annotation-xml"})
            self._end_open({"select"}, ())
        if tag in _ENDS_P:
            self._end_open({"p"}, _SHIELDS_P)
        if tag in _ENDS:
            self._end_open(*_ENDS[tag])
        above = self._stack[-1]
        if above.mute or tag in _MUTE:
            if tag not in _VOID and not rest.endswith("/"):
                self._stack.append(_Open(tag, above.noise, above.main, above.path, None, above.chain, mute=True))
            return
        if tag in _BLOCK:
            self._end_block()
        if tag in _VOID:
            self._text(" ")
            return
        if rest.endswith("/") and any(x.tag in _FOREIGN for x in self._stack):
            return
        names, role, hidden = "", "", False
        classes, ids = "", ""
        if rest and ("=" in rest or "hidden" in rest):
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    names += " " + value.lower()
                    if name == "class":
                        classes += " " + value.lower()
                    else:
                        ids += " " + value.lower()
                elif name == "role":
                    role = value.lower()
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                        name == "style" and re.search(r"display\s*:\s*none", value)):
                    hidden = True
        told, doubt, head = _said(tag, classes, ids) if names else (False, False, False)
        marked = (hidden or role in _NOISE_ROLES or told
                  or (head and not above.main and tag not in _MAIN))
        article = (tag in _MAIN or role == "main" or "articlebody" in rest.lower()) and not marked
        noise = marked or tag in _NOISE_TAGS or (tag == "header" and not above.main)
        main = (above.main or article) and not noise
        names = _DIGITS.sub("0", names)
        shape = f"{tag}{names} {role}"
        if not above.children or above.children[-1] != shape:
            above.children.append(shape)
        path = f"{above.path}/{shape}"
        judged, chain, label = None, above.chain, 0
        if article and above.noise:
            # An article in an element that was left open is no part of it.
            chain, inside = (), False
        else:
            inside = above.noise
        if not inside and (noise or article or doubt or (
                tag in _BLOCK and tag not in ("html", "head", "body") and not (main and tag in _PLAIN and not names))):
            self._end_block()
            label = -1 if noise else 1 if article else 2 if doubt else 0
            key = f"{path}{hidden}".encode("utf-8", "replace")
            judged = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True)
            chain += (judged,)
        self._stack.append(_Open(tag, noise or inside, main, path, judged, chain, label))

    def text(self, noise: frozenset[int]) -> str:
        """The main text, without branches that say they are noise or are so on this site."""
        told = frozenset(key for key, (_, label) in self.styles.items() if label < 0)
        blocks = [block for block in self.blocks if told.isdisjoint(block[2])]
        clean = [block for block in blocks if noise.isdisjoint(block[2])] or blocks
        inside = [t for t, main, _ in clean if main]
        return "\n".join(inside or [t for t, _, _ in clean])


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(),
                          "little", signed=True)


def _tree(batches):
    """Of each page its judged nodes with their style (kind 0) and the different blocks below
    them (kind 1)."""
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not source:
                continue
            page = Page(source)
            labels = {node: label for node, (_, label) in page.styles.items()}
            found = {(node, 0, _hash(style)) for node, (style, _) in page.styles.items()}
            for text, _, keys in page.blocks:
                if keys:
                    value = _hash(text)
                    found.update((node, 1, value) for node in keys)
            rows += [(host, node, labels[node], kind, value) for node, kind, value in found]
        columns = zip(*rows) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds)],
            names=["host", "node", "label", "kind", "value"])


def _main_text(names):
    def batch_text(batches):
        for batch in batches:
            out = []
            noise = batch.column(1).to_pylist()
            for source, own in zip(batch.column(0).to_pylist(), noise):
                out.append(Page(source).text(frozenset(own or ())) if source else "")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(out, pa.string())], names=names)

    return batch_text


def host_of(url: str):
    """Host of a URL column in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(
        F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def _different(pages: DataFrame) -> DataFrame:
    """Each html of a host once; only pages that have copies are shuffled."""
    keyed = pages.withColumn("h", F.xxhash64("host", "html"))
    copied = stored(keyed.groupBy("h").count().where("count > 1").select("h"), "copied")
    one = keyed.join(copied, "h", "left_semi").groupBy("h").agg(
        F.first("host").alias("host"), F.first("html").alias("html"))
    return keyed.join(copied, "h", "left_anti").select("host", "html").unionByName(one.select("host", "html"))


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The style trees: host, node, label, pages, presentation, content and importance."""
    seen = _different(pages.select(host_of(url_col).alias("host"), F.col(f"`{html_col}`").alias("html"))).mapInArrow(
        _tree, "host string, node long, label int, kind int, value long")
    counts = seen.groupBy("host", "node", "label", "kind", "value").agg(F.count("*").alias("k"))
    k = F.col("k")
    style, block = F.col("kind") == 0, F.col("kind") == 1
    nodes = counts.groupBy("host", "node", "label").agg(
        F.sum(F.when(style, k)).alias("pages"), F.count(F.when(style, k)).alias("styles"),
        F.sum(F.when(style, k * F.log(k))).alias("by_style"),
        F.sum(F.when(block, F.log(k))).alias("by_block"), F.count(F.when(block, k)).alias("blocks"))
    m = F.log("pages")
    one = F.col("pages") == 1
    look = F.when(one, 1.0).otherwise(F.least(F.lit(1.0), 1 - F.col("by_style") / F.col("pages") / m))
    # Without blocks there is nothing to say against a node.
    content = F.when(one | (F.col("blocks") == 0), 1.0).otherwise(1 - F.col("by_block") / F.col("blocks") / m)
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    value = (1 - weight) * look + weight * content
    value = (F.col("pages") * value + PRIOR) / (F.col("pages") + PRIOR)
    said = (F.when(F.col("label") < 0, 0.0).when(F.col("label") == 1, 1.0)
            .when(F.col("label") == 2, DOUBT * value).otherwise(value))
    return nodes.select("host", "node", "label", "pages", look.alias("presentation"),
                        content.alias("content"), said.alias("importance"))


def with_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                   text_col: str = "text") -> DataFrame:
    """The rows and columns of ``pages`` without the html, with the main text."""
    prepared(pages.sparkSession)
    # Named noise is told on the page. What is left occurs on several pages each.
    low = importance(pages, url_col, html_col).where((F.col("importance") < LEAST) & (F.col("label") >= 0))
    # Written, so that its size is known and Spark broadcasts it only if it is small.
    noise = stored(low.groupBy("host").agg(F.collect_set("node").alias("noise")), "noise")
    rest = [c for c in pages.columns if c not in (html_col, text_col)]
    named = pages.select(host_of(url_col).alias("host"), F.col(f"`{html_col}`").alias("html"),
                         *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    inner = named.join(noise, "host", "left").select("html", "noise", *named.columns[2:])
    names = [*inner.columns[2:], "text"]
    schema = inner.select(*inner.columns[2:], F.lit("").alias("text")).schema
    out = inner.mapInArrow(_main_text(names), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("text").alias(text_col))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page its main text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return with_main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))
