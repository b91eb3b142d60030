"""Main text of web pages by equivalence-class template deduction.

Pages are cut into tokens: start tags and texts, each under the running hash
of the structural elements it stands in.  Tokens of one host with the same
occurrence vector (how often they stand in each of its pages, compared by sums
of hashes) form an equivalence class.  Classes with enough tokens, on enough of
the host's pages that hold a token at all, are candidates; a second pass over
the pages finds which are valid: the tokens of a class stand in one order on
all pages, and a class other than the widest one stands as a whole in one and
the same gap between two tokens of the widest class.  Valid classes, so
nested, are the host's template.  Texts outside of it fill its slots, and the
same pass sums the slot text under each template element:

* an element without slot text on any page is fixed: a block such as a notice
  that the host repeats.  Fixed containers and all in them are left out;
* a host's main part is its article (or main) element, or without one its
  deepest element that holds MAIN_SHARE of the slot text; only text in it stays;
* texts of the template that stand directly in an element with slots (a
  paragraph that all articles end with) are text of the article and stay.

Menus, page headers and footers, asides, dialogs, scripts and styles are
known by their elements, roles and hidden marks; forms too, but for one that
wraps the page (half of its text, paragraphs among it).  Elements whose class or id
says advert, notice or comments in all of its words are left out only where
they hold under half of the host's slot text.  Hosts without a template (one
page, or copies of one with hardly a difference) are read page by page by the same rules, with all of
a page's text as its slots.

Blocks end at structural tags; white space inside a block (line-break elements
too) becomes one space; blocks are joined by a line break in page order.

Defined results: null and empty html give an empty text and have no say in a
host's template; a url without a host belongs to the host ''; unclosed and
crossing tags close where the next structure demands; the time is linear in a
page's length and depth; repeated rows each give a row; an empty table gives no
rows; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import save, settle

#: A template needs two different pages of its host to compare, and slots that hold MIN_SLOTS of the host's text (copies of one page with little changed tell
#: nothing of what is template); a class so many tokens, on such a share of the host's pages.
MIN_PAGES, MIN_SLOTS, MIN_CLASS, MIN_SUPPORT, MAIN_SHARE = 2, 0.25, 3, 0.3, 0.6
#: Templates of so many tokens in all are sent to every executor; more are joined by host.
BROADCAST_TOKENS = 500_000

# Names of HTML elements by their kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_RAW = "script style noscript template textarea title svg annotation iframe object canvas select option datalist xmp"
_LEFT_OUT = frozenset("nav footer aside button dialog menu head fieldset".split())
_CONTAINERS = frozenset("div section ul ol dl table figure details center header blockquote".split())
# Words of class and id names, and roles, that mark what is no article text, and words that say nothing beside them.
_LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup login comment comments commentlist reply replies respond disqus share sharing social related recommended recommendations search form pagination pager skip hidden".split()
)
_NEUTRAL_NAMES = frozenset(
    "site page main global top bottom left right side inner outer block box bar area wrapper wrap container content list item items links link section region slot unit row col column group panel header head text post posts article articles reader user the of and js sticky fixed".split()
)
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_ENDED_BY_ARTICLE = _LEFT_OUT | {"form", "header", "ul", "ol", "li", "p"}

_RAW_NAMES = frozenset(_RAW.split())
#: A tag whose quoted attributes hold no < or >: most tags, read in one step.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:]*+)(?!-)([^<>\"']*+(?:\"[^<>\"]*+\"[^<>\"']*+)*+)>")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_RAW_TAG = re.compile(rf"<({_RAW.replace(' ', '|')})\b", re.I)
_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in _RAW_NAMES}
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


def _marked(name: str) -> bool:
    """Whether a class or id name says in all its words that it is no article text."""
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    return not _LEFT_OUT_NAMES.isdisjoint(words) and all(w in _LEFT_OUT_NAMES or w in _NEUTRAL_NAMES for w in words)


def _named(attributes: str) -> tuple[str, bool, bool]:
    """The class and id of a start tag (digits made one sign), whether these mark it, and whether a role or hidden mark leaves it out."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return "", False, False
    names, marked, out = "", False, False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            names += f".{_DIGITS.sub('#', value)}"
            marked = marked or any(map(_marked, value.split()))
        elif key == "role":
            out = out or value.lower() in _LEFT_OUT_ROLES
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
            out = True
    return names, marked, out


class Element:
    """A structural element: its place among the page's elements, its parent's, the hash of its path, and what its tag and attributes say."""

    __slots__ = ("at", "parent", "key", "tag", "depth", "out", "marked", "article", "form")

    def __init__(self, at: int, parent: Element | None, key: int, tag: str, out: bool, marked: bool) -> None:
        self.at, self.key, self.tag, self.marked = at, key, tag, marked
        self.parent, self.depth = (parent.at, parent.depth + 1) if parent else (-1, 0)
        self.article = bool(parent) and (parent.article or parent.tag in ("article", "main"))
        self.out = out or bool(parent) and parent.out
        self.form = parent.form if parent and parent.form >= 0 else at if tag == "form" else -1  # the outermost form it stands in


def _signed(key: int) -> int:
    return key - 2**63


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name in small letters, whether it ends an element, attributes) of the tags of a page; of comments, declarations and elements read as a whole (scripts and such) the name is '', and the attributes are ' ' where a space stands for them.

    Every tag ends at the first > outside of quotes or, where quotes do not
    close, at the first >.  Where a scan for that end came by is kept, and
    behind the last > of a page there are no tags, so broken markup is not read
    again from each of its signs.
    """
    last, known, at = page.rfind(">"), {}, page.find("<")

    def tag_end(i: int) -> int:
        """The first > at or behind i outside of quotes, -1 for none."""
        path, found = [], -1
        m = _SPECIAL.search(page, i)
        while m:
            j = m.start()
            if page[j] == ">" or j in known:
                found = known.get(j, j)
                break
            path.append(j)
            j = page.find(page[j], j + 1)
            m = _SPECIAL.search(page, j + 1) if j >= 0 else None
        known.update(dict.fromkeys(path, found))
        return found

    while at >= 0:
        end = at + 1
        m = _PLAIN_TAG.match(page, at)
        if m and m[2].lower() not in _RAW_NAMES and ":" not in m[2]:
            end = m.end()
            yield at, end, m[2].lower(), bool(m[1]), m[3]
        elif page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(page)
            yield at, end, "", False, ""
        elif at > last:
            if (at := page.find("<!--", at)) >= 0:
                continue
            return
        elif (m := _RAW_TAG.match(page, at)) and (close := tag_end(m.end())) >= 0:
            ended = _ENDS[m[1].lower()].search(page, close + 1)
            end = ended.end() if ended else len(page)
            yield at, end, "", False, "" if m[1].lower() == "textarea" else " "
        elif m := _TAG.match(page, at):
            close = tag_end(m.end())
            close = close if close >= 0 else page.find(">", m.end())
            end = close + 1
            yield at, end, m[2].lower(), bool(m[1]), page[m.end() : close]
        elif page[at + 1 : at + 2] in ("!", "?", "/"):
            end = page.find(">", at + 2) + 1
            if not end:
                end = at + 1
            else:
                yield at, end, "", False, ""
        at = page.find("<", end)


def parse(page: str | None) -> tuple[list[Element], list[tuple[int, int, str]]]:
    """The structural elements (0: the page) and the tokens in order: (element, key, text, or '' for its start tag)."""
    top = Element(0, None, 0, "", False, False)
    stack, elements, found, text, at, opened = [top], [top], [], [], 0, Counter()
    page = page or ""

    def block() -> None:
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if joined:
            e = stack[-1]
            found.append((e.at, xxhash.xxh64_intdigest(joined.encode("utf-8", "replace"), e.key), joined))

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    def close(tag: str) -> None:
        if opened[tag] > 0:
            while stack[-1].tag != tag:
                pop()
            pop()

    for start, end, tag, ending, attributes in tags(page):
        if start > at:
            text.append(page[at:start])
        at = end
        if not tag:
            if attributes:
                text.append(" ")
            continue
        names, marked, out = _named(attributes) if attributes and not ending else ("", False, False)
        if tag in _INLINE and not out and not marked:
            if ending and opened[tag] > 0 and stack[-1].tag == tag:  # an inline element that was marked
                block()
                pop()
            elif tag == "br":
                text.append(" ")
            continue
        if text:
            block()
        if ending:
            close(tag)
            continue
        if tag in ("article", "main"):  # whatever menu or header was left open ends here
            while len(stack) > 1 and not stack[-1].article and stack[-1].tag in _ENDED_BY_ARTICLE:
                pop()
        elif stack[-1].tag == "p" and tag not in _INLINE or tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag:
            pop()
        if tag == "body":
            close("head")
        up = stack[-1]
        inside = up.article or up.tag in ("article", "main")
        e = Element(len(elements), up, xxhash.xxh64_intdigest(tag + names, up.key), tag, out or tag in _LEFT_OUT or tag == "header" and not inside, marked)
        elements.append(e)
        found.append((e.at, e.key, ""))
        if tag not in _VOID and not (attributes.endswith("/") and tag not in ("p", "div")):
            stack.append(e)
            opened[tag] += 1
    if page[at:]:
        text.append(page[at:])
    if text:
        block()
    if any(e.form >= 0 for e in elements):
        _leave_out_forms(elements, found)
    return elements, found


def _leave_out_forms(elements: list[Element], found: list[tuple[int, int, str]]) -> None:
    """Forms go, but for those that wrap a page: they hold half of its text or more, paragraphs or an article among it."""
    size, prose, total = Counter(), set(), 0
    for at, _, text in found:
        e = elements[at]
        if text and not e.out:
            total += len(text)
            size[e.form] += len(text)
            if e.tag == "p" or e.article or e.tag in ("article", "main"):
                prose.add(e.form)
    for e in elements:
        e.out = e.out or e.form >= 0 and not (e.form in prose and 2 * size[e.form] >= total)


def slot_text(elements: list[Element], found: list[tuple[int, int, str]], template: set[int]) -> list[int]:
    """Of each element, the characters of the slot texts (those outside the template) in it and below, elements that are left out aside."""
    amount = [0] * len(elements)
    for at, key, text in found:
        if text and not elements[at].out and key not in template:
            amount[at] += len(text)
    for e in reversed(elements[1:]):
        amount[e.parent] += amount[e.at]
    return amount


class Template:
    """What is known of a host: keys of its valid classes' tokens, of fixed elements, of marked elements that hold much text, and of its main part (0: none)."""

    def __init__(self, tokens=(), fixed=(), much=(), main: int = 0) -> None:
        self.tokens, self.fixed, self.much, self.main = set(tokens), set(fixed), set(much), main


def extract(page: str | None, template: Template | None = None) -> str:
    """Main text of a page."""
    elements, found = parse(page)
    if template is None:
        amount = slot_text(elements, found, set())
        template = Template(much=[e.key for e in elements if e.marked and 2 * amount[e.at] >= amount[0]])
    out, fixed, within, inside = ([False] * len(elements) for _ in range(4))
    for e in elements[1:]:
        out[e.at] = out[e.parent] or e.out or e.marked and e.key not in template.much
        fixed[e.at] = fixed[e.parent] or e.tag in _CONTAINERS and e.key in template.fixed
        inside[e.at] = inside[e.parent] or e.tag in ("article", "main") and not out[e.at]
        within[e.at] = within[e.parent] or e.key == template.main
    kept = [(at, text) for at, key, text in found if text and not out[at] and not (fixed[at] and key in template.tokens)]
    parts = ([t for at, t in kept if inside[at]] if any(inside) else []) or ([t for at, t in kept if within[at]] if template.main else [])
    return "\n".join(parts or [t for _, t in kept])


# ---------------------------------------------------------------- deduction


def candidates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS, min_support: float = MIN_SUPPORT) -> DataFrame:
    """host and its candidate classes of pages(host, html): own, an array of (class, token); class 1 is the widest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, len(b), 64):
                hosts, keys, prints, counts = [], [], [], []
                for host, page in zip(b.column("host")[i : i + 64].to_pylist(), b.column("html")[i : i + 64].to_pylist()):
                    own = Counter(key for _, key, _ in parse(page)[1])
                    if not own:
                        continue
                    whole = _signed(xxhash.xxh64_intdigest(page.encode("utf-8", "replace")))
                    # one row for the page itself, under key 0 of its host
                    hosts += [host] * (len(own) + 1)
                    keys += [0, *map(_signed, own)]
                    counts += [1, *own.values()]
                    prints += [whole] * (len(own) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(prints, pa.int64()), pa.array(counts, pa.int32())], names=["host", "token", "page", "n"])

    # The occurrence vector of a token over its host's pages, as sums of hashes of (page, times): equal vectors have equal sums.
    seen = pages.select("host", "html").mapInArrow(cut, "host string, token long, page long, n int")
    vector = [F.sum(F.pmod(F.xxhash64("page", "n", F.lit(i)), F.lit(2**31 - 1))).alias(f"v{i}") for i in (1, 2)]
    found = save(seen.groupBy("host", "token", F.when(F.col("token") == 0, F.col("page")).otherwise(0).alias("page")).agg(F.count("*").alias("pages"), *vector), "tokens")
    hosts = found.where("token = 0").groupBy("host").agg(F.sum("pages").alias("all_pages"), F.count("*").alias("different")).where(F.col("different") >= min_pages)
    wide = found.where("token <> 0").join(hosts, "host").where((F.col("pages") >= min_pages) & (F.col("pages") >= min_support * F.col("all_pages")))
    classes = wide.groupBy("host", "pages", "v1", "v2").agg(F.count("*").alias("size"), F.collect_list("token").alias("tokens")).where(F.col("size") >= min_class)
    number = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("size"), "v1", "v2"))
    each = F.explode("tokens").alias("token")
    return classes.select("host", number.alias("class"), "tokens").select("host", "class", each).groupBy("host").agg(F.collect_list(F.struct("class", "token")).alias("own"))


def _with_hosts(rows: DataFrame, found: DataFrame, tokens: str) -> DataFrame:
    size = found.agg(F.sum(F.size(tokens) + 4)).first()[0] or 0
    return rows.join(F.broadcast(found) if size <= BROADCAST_TOKENS else found, "host", "left")


#: Stands for no element: a row that holds the characters of all text of a host's pages.
_ALL_TEXT = 1


class _Observed:
    """What the pages of a task say of the candidate classes of their hosts."""

    def __init__(self) -> None:
        self.classes: dict[tuple[str, int], list[int]] = {}  # least and greatest hash of a class's order, first and last gap
        self.elements: dict[tuple[str, int], list[int]] = {}  # slot text, depth, 1: marked, 2: article

    def add(self, host: str, page: str | None, own: dict[int, int]) -> None:
        elements, found = parse(page)
        if not found:
            return
        order, gaps, gap = {}, {}, 0
        for _, key, _ in found:
            c = own.get(key)
            if c is not None:
                order.setdefault(c, []).append(key)
                if c == 1:
                    gap += 1
                else:
                    gaps.setdefault(c, [gap, gap])[1] = gap
        for c, keys in order.items():
            print_ = _signed(xxhash.xxh64_intdigest(np.array(keys, np.uint64).tobytes()))
            low, high = gaps.get(c, (0, 0))
            was = self.classes.setdefault((host, c), [print_, print_, low, high])
            was[:] = min(was[0], print_), max(was[1], print_), min(was[2], low), max(was[3], high)
        amount = slot_text(elements, found, own)
        everything = self.elements.setdefault((host, _ALL_TEXT), [0, 0, 0])
        everything[0] += sum(len(text) for at, _, text in found if not elements[at].out)
        for e in elements:
            if e.at == 0 or e.key in own and not e.out:
                was = self.elements.setdefault((host, e.key), [0, e.depth, e.marked | 2 * (e.tag in ("article", "main"))])
                was[0] += amount[e.at]

    def rows(self) -> pa.RecordBatch:
        made = [(h, 0, c, *v) for (h, c), v in self.classes.items()] + [(h, 2 if k == _ALL_TEXT else 1, _signed(k) if k > _ALL_TEXT else 0, *v, 0) for (h, k), v in self.elements.items()]
        cols = [*zip(*made)] or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(cols)], names=["host", "kind", "key", "a", "b", "c", "d"])


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS, min_support: float = MIN_SUPPORT, main_share: float = MAIN_SHARE, min_slots: float = MIN_SLOTS) -> DataFrame:
    """host, tokens, fixed, much and main of the hosts of pages(host, html) that have a template."""
    found = save(candidates(pages, min_pages, min_class, min_support), "classes")

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = _Observed(), {}
        for b in batches:
            hosts = b.column("host").to_pylist()
            for i, page in enumerate(b.column("html").to_pylist()):
                if hosts[i] not in known:
                    if len(known) > 1_000:
                        yield seen.rows()
                        seen, known = _Observed(), {}
                    known[hosts[i]] = {x["token"] + 2**63: x["class"] for x in b.column("own")[i].as_py() or ()}
                if known[hosts[i]]:
                    seen.add(hosts[i], page, known[hosts[i]])
        yield seen.rows()

    told = _with_hosts(pages.select("host", "html"), found, "own").select("host", "html", "own").mapInArrow(observe, "host string, kind long, key long, a long, b long, c long, d long")
    # of a class: its orders and gaps, least and greatest; of an element: its slot text, depth and marks
    told = told.groupBy("host", "kind", "key").agg(F.min("a").alias("low"), F.max("b").alias("high"), F.min("c").alias("first"), F.max("d").alias("last"), F.sum(F.when(F.col("kind") >= 1, F.col("a"))).alias("text"), F.max("b").alias("depth"), F.max("c").alias("marks"))
    told = save(told, "observed")
    total = told.where("kind = 1 and key = 0").select("host", F.col("text").alias("whole"))
    telling = told.where("kind = 2").select("host", F.col("text").alias("every")).join(total, "host").where(F.col("whole") >= min_slots * F.col("every")).select("host")
    valid = told.where("kind = 0 and low = high and first = last").select("host", F.col("key").cast("int").alias("class")).join(telling, "host")
    tokens = found.select("host", F.inline("own")).join(valid, ["host", "class"]).select("host", "token")
    parts = told.where("kind = 1 and key <> 0").join(total, "host").join(tokens.withColumnRenamed("token", "key"), ["host", "key"])
    big = F.when((F.col("text") >= main_share * F.col("whole")) & (F.col("text") > 0), F.struct((F.col("marks") >= 2).alias("article"), "depth", F.col("text"), "key"))
    known = parts.groupBy("host").agg(
        F.collect_list(F.when(F.col("text") == 0, F.col("key"))).alias("fixed"),
        F.collect_list(F.when((F.col("marks") % 2 == 1) & (2 * F.col("text") >= F.col("whole")), F.col("key"))).alias("much"),
        F.max(big).alias("big"),
    )
    return tokens.groupBy("host").agg(F.collect_list("token").alias("tokens")).join(known, "host", "left").select("host", "tokens", "fixed", "much", F.col("big.key").alias("main"))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS, min_support: float = MIN_SUPPORT) -> DataFrame:
    """page_id, url and text of every page."""
    host = F.lower(F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    found = settle(lambda: templates(rows, min_pages, min_class, min_support), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template | None] = {}
        for b in batches:
            texts, hosts = [], b.column("host").to_pylist()
            for i, page in enumerate(b.column("html").to_pylist()):
                if hosts[i] not in known:
                    if len(known) > 1_000:
                        known.clear()
                    tokens, fixed, much, main = (b.column(c)[i].as_py() for c in ("tokens", "fixed", "much", "main"))
                    shift = lambda keys: [k + 2**63 for k in keys or ()]
                    known[hosts[i]] = Template(shift(tokens), shift(fixed), shift(much), 0 if main is None else main + 2**63) if tokens else None
                texts.append(extract(page, known[hosts[i]]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    joined = _with_hosts(rows, found, "tokens")
    return joined.select("page_id", "url", "html", "host", "tokens", "fixed", "much", "main").mapInArrow(run, f"page_id {kind}, url string, text string")
