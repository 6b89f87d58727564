"""Main text of web pages by wrappers inferred per host.

Pages of one host are made by one template. Each page is cut into a stream of
tags and texts; runs of equal siblings fold into repeated groups, which leaves
the page's own union-free expression. Expressions of a host are aligned two at
a time: parts that only one side has become optional groups, differing runs
become repeated groups, and differing strings become text slots, until one
expression, the host's wrapper, covers every page. Equal expressions are
combined before the shuffle and alignment is associative, so a host with a
third of all pages is folded as a tree of small groups.

The wrapper names the group that holds the article and what belongs to the
template: strings that aligned pages have in common at a path (of pages with
the same text, one counts), and groups inside the article whose class is
doubtful (``related``, ``share``, ``search`` ...) if two pages or more have them
and their text is the same everywhere or mostly links. On a host with one page
nothing can be aligned, and the class decides. A page
that lacks the article group, or has a stronger mark, or has its article at another
path or depth, has it located by its own marks. A page's text is what its stream has in the article
group outside of menus, headers, footers, sidebars, notices, adverts, forms
and reader comments. Headings, paragraphs and sections inside the article are
not judged by their ids.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import batch_columns, cut, release, table

MAX_DEPTH = 12  # levels of a page that its expression describes; an article below them is found on its page
FOLD = 32  # expressions aligned by one group of a folding round
ALIGN_CELLS = 250_000  # size of an alignment table; longer lists are aligned at the nearest common part instead
BROADCAST_BYTES = 64 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^>]*>", re.S
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "label", "button", "script", "style", "svg",
    "math", "mi", "mn", "mo", "mrow", "mtext", "mspace", "ms", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder",
    "munderover", "mstyle", "mpadded", "mphantom", "mtable", "mtr", "mtd", "semantics", "annotation", "annotation-xml",
}
_DROPPED = _RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "input", "menu", "dialog", "fieldset", "audio", "video", "annotation", "annotation-xml",
}
_CERTAIN = (
    r"ads?|advert\w*|sponsor\w*|nav\w*|menu|breadcrumbs?|sidebar|footer|masthead|site-header|page-header|cookies?|notices?|consent|gdpr|"
    r"popup|modal|alert|newsletter|subscribe|comments?|commentlist|respond|disqus|pagination|pager"
)
_DOUBTFUL = r"banner|promo\w*|share|sharing|social|related|recommend\w*|repl(?:y|ies)|widget|toolbar|login|signup|search|skip|copyright"
_CERTAIN_WORDS = re.compile(rf"(?:^|[\s_-])(?:{_CERTAIN})(?:$|[\s_-])", re.I)
_CERTAIN_ID = re.compile(rf"(?:{_CERTAIN}|disqus_thread)\Z", re.I)
_ASIDE_WORDS = re.compile(rf"(?:^|[\s_-])(?:{_CERTAIN}|{_DOUBTFUL})(?:$|[\s_-])", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_GROUPS = {"div", "section", "ul", "ol", "dl", "table", "header", "article"}  # elements that a class or an id can name as a group
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_MAIN_WORDS = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body-text|articlebody)(?:$|[\s_-])", re.I)
_PARAGRAPH_ENDS = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
_SAME_ENDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is text, open, close or void; for tags rest is the source."""
    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        source, at = found.group(), found.end()
        if source[1] in "!?":
            continue
        name = _NAME.match(source).group(1).lower()
        if source[1] == "/":
            yield "close", name, source
        elif name in _VOID or source.endswith("/>") and name in _RAW:
            yield "void", name, source
        else:
            yield "open", name, source
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
                at = end.start() if end else n


class Element:
    """``aside``: no part of an article, by all marks; ``hard``: nor inside of one; ``doubtful``: inside of one, the wrapper decides."""

    __slots__ = ("name", "key", "aside", "hard", "doubtful", "main")

    def __init__(self, name: str, source: str):
        said = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(source)}
        classes, own_id = said.get("class", ""), said.get("id", "")
        words = f"{classes} {own_id}".strip()
        self.name = name
        # ids and words with digits are often the page's own, not the template's
        kept = [w for w in classes.split() if not any(c.isdigit() for c in w)]
        self.key = name + (f".{kept[0]}" if kept else "")
        self.hard = name in _DROPPED or said.get("role", "").lower() in _ROLES or "hidden" in said
        self.hard |= name == "article" and bool(re.search(r"comment|reply|teaser|related|promo", words, re.I))
        self.aside, self.doubtful = self.hard, False
        if words and name not in _HEADINGS and name not in ("html", "body", "article", "main"):
            self.aside |= bool(_ASIDE_WORDS.search(words))
            self.hard |= (name not in _INLINE or name == "span") and bool(_CERTAIN_WORDS.search(classes))
            self.hard |= name in _GROUPS and bool(_CERTAIN_ID.match(own_id))
            self.doubtful = not self.hard and name in _GROUPS and bool(_ASIDE_WORDS.search(classes))
        self.main = 0
        if name == "article" or said.get("itemprop", "").lower() == "articlebody":
            self.main = 3
        elif name == "main" or said.get("role", "").lower() == "main":
            self.main = 2
        elif name in ("div", "section", "td") and words and _MAIN_WORDS.search(words):
            self.main = 1


def events(page: str) -> Iterator[tuple[str, str | Element]]:
    """Balanced stream of a page: open and close of elements, and texts; missing end tags are put in."""
    stack: list[Element] = []
    held: Counter[str] = Counter()  # open elements by name, so that stray end tags cost nothing

    def close_to(k: int):
        while len(stack) > k:
            held[stack[-1].name] -= 1
            yield "close", stack.pop()

    for kind, name, source in tokens(page):
        if kind == "text":
            yield "text", source
        elif kind == "void":
            if name == "br":
                yield "br", ""
            elif name not in _INLINE:
                yield from _auto_close(stack, held, name, close_to)
                element = Element(name, source)
                yield "open", element
                yield "close", element
        elif kind == "open":
            yield from _auto_close(stack, held, name, close_to)
            stack.append(Element(name, source))
            held[name] += 1
            yield "open", stack[-1]
        elif held[name]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    yield from close_to(k)
                    break
    yield from close_to(0)


def _auto_close(stack: list[Element], held: Counter, name: str, close_to) -> Iterator:
    """End tags that HTML lets an author leave out, before an element opens."""
    if name in _PARAGRAPH_ENDS and held["p"]:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name == "p":
                yield from close_to(k)
                break
            if stack[k].name not in _INLINE:
                break
    ends = _SAME_ENDS.get(name)
    if ends and held[name]:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name == name:
                yield from close_to(k)
                break
            if stack[k].name in ends:
                break


# An expression is a list of parts [key, main, repeated, optional, parts]; a text slot has the key "#".


def align(a: list, b: list) -> list:
    """One list of parts that covers both: common parts in order, the others optional.

    The longest common order is found with a table; where that would have more
    than ``ALIGN_CELLS`` cells, each mismatch skips to the nearest part that
    both have, which covers both sides as well, in time linear in their parts.
    """
    lead = 0
    while lead < min(len(a), len(b)) and a[lead][0] == b[lead][0]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail][0] == b[-1 - tail][0]:
        tail += 1
    mid_a, mid_b = a[lead : len(a) - tail], b[lead : len(b) - tail]
    pairs = [(i, i) for i in range(lead)]
    pairs += [(lead + i, lead + j) for i, j in (_longest if len(mid_a) * len(mid_b) <= ALIGN_CELLS else _nearest)(mid_a, mid_b)]
    pairs += [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    out, at_a, at_b = [], 0, 0
    for i, j in [*pairs, (len(a), len(b))]:
        out += [[*x[:3], 1, x[4]] for x in a[at_a:i]] + [[*x[:3], 1, x[4]] for x in b[at_b:j]]
        if i < len(a):
            x, y = a[i], b[j]
            out.append([x[0], max(x[1], y[1]), x[2] or y[2], x[3] or y[3], x[4] if x[4] == y[4] else align(x[4], y[4])])
        at_a, at_b = i + 1, j + 1
    return fold(out)


def _longest(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common order of parts."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _nearest(a: list, b: list) -> list[tuple[int, int]]:
    """Places of common parts, each mismatch skipped on the side where the other's part comes sooner."""
    places: tuple[dict, dict] = ({}, {})
    for found, parts in zip(places, (a, b)):
        for k, part in enumerate(parts):
            found.setdefault(part[0], []).append(k)

    def ahead(side: int, key: str, at: int) -> int | None:
        held = places[side].get(key, [])
        k = bisect_left(held, at)
        return held[k] - at if k < len(held) else None

    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append((i, j))
            i, j = i + 1, j + 1
            continue
        skip_a, skip_b = ahead(0, b[j][0], i), ahead(1, a[i][0], j)
        if skip_a is None and skip_b is None:
            i, j = i + 1, j + 1
        elif skip_b is None or skip_a is not None and skip_a <= skip_b:
            i += skip_a
        else:
            j += skip_b
    return out


def fold(parts: list) -> list:
    """Neighbouring parts of one key become one repeated group."""
    out: list = []
    for part in parts:
        if out and out[-1][0] == part[0]:
            last = out[-1]
            body = last[4] if last[4] == part[4] else align(last[4], part[4])
            out[-1] = [last[0], max(last[1], part[1]), int(last[0] != "#"), last[3] and part[3], body]
        else:
            out.append(part)
    return out


def page_text(stream: list) -> int:
    """Hash of all strings of a page outside of dropped parts."""
    said, dropped = [], 0
    for kind, x in stream:
        if kind == "open":
            dropped += bool(dropped) or x.aside
        elif kind == "close":
            dropped -= bool(dropped)
        elif kind == "text" and not dropped and x.strip():
            said.append(" ".join(x.split()))
    return _hash(said)


def expression(stream: list) -> list:
    """A page's union-free expression."""
    root: list = []
    stack, depth = [root], 0
    for kind, x in stream:
        if kind == "open" and x.name not in _INLINE:
            depth += 1
            if depth <= MAX_DEPTH:
                part = [x.key, 0 if x.aside else x.main, 0, 0, []]
                stack[-1].append(part)
                stack.append(part[4])
        elif kind == "close" and x.name not in _INLINE:
            depth -= 1
            if depth < MAX_DEPTH:
                done = stack.pop()
                done[:] = fold(done)
        elif kind == "text" and x.strip() and depth <= MAX_DEPTH:
            if not (stack[-1] and stack[-1][-1][0] == "#"):
                stack[-1].append(["#", 0, 0, 0, []])
    root[:] = fold(root)
    return root


def _below(path: int, key: str) -> int:
    """Hash of the path one level below ``path``, of any depth."""
    return xxhash.xxh3_64_intdigest(key, seed=path) >> 1


def _group(path: int) -> int:
    """Key of a doubtful group at a path, apart from the strings at it."""
    return _below(path, "!")


def slots(stream: list) -> list[tuple[int, int, int, int]]:
    """(path, hash of its strings, their characters in links, all characters) per text path; doubtful groups by ``_group``.

    Only doubtful groups count characters. Nested ones belong to the outermost.
    """
    paths, texts, groups = [0], {}, {}
    dropped = links = within = 0
    group: list | None = None
    for kind, x in stream:
        if kind == "open":
            if x.name not in _INLINE:
                paths.append(_below(paths[-1], x.key))
            dropped += bool(dropped) or x.hard
            links += x.name == "a"
            if within:
                within += 1
            elif x.doubtful and not dropped:
                within, group = 1, groups.setdefault(_group(paths[-1]), [[], 0, 0])
        elif kind == "close":
            if x.name not in _INLINE:
                paths.pop()
            dropped -= bool(dropped)
            links -= x.name == "a"
            within -= bool(within)
        elif kind == "text" and not dropped and x.strip():
            said = " ".join(x.split())
            texts.setdefault(paths[-1], []).append(said)
            if within:
                group[0].append(said)
                group[1] += len(said) if links else 0
                group[2] += len(said)
    out = [(path, _hash(said), 0, 0) for path, said in texts.items()]
    return out + [(path, _hash(said), linked, total) for path, (said, linked, total) in groups.items()]


def _hash(said: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(said)) >> 1


def host_of(url: str) -> Column:
    """Host of a URL column in lower case; empty for a null or a text without one."""
    found = F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def strongest(wrapper: list) -> tuple[int, str]:
    """Mark and path of the group that holds the article: the strongest mark, the outermost first; (0, "") if none."""
    best, path = 0, ""
    todo = [(wrapper, "")]
    while todo:
        parts, at = todo.pop(0)
        for part in parts:
            here = f"{at}/{part[0]}" if at else part[0]
            if part[1] > best:
                best, path = part[1], here
            todo.append((part[4], here))
    return best, path


def main_path(wrapper: list) -> str:
    return strongest(wrapper)[1]


def own_path(stream: list) -> tuple[int, str]:
    """Like ``strongest``, for the page itself and at any depth."""
    best, depth, path = 0, 0, ""
    names: list[str] = []
    dropped = 0
    for kind, x in stream:
        if kind == "open":
            if x.name not in _INLINE:
                names.append(x.key)
                dropped += bool(dropped) or x.aside or x.name == "header"
                if x.main and not dropped and (x.main, -len(names)) > (best, -depth):
                    best, depth, path = x.main, len(names), "/".join(names)
            else:
                dropped += bool(dropped) or x.aside
        elif kind == "close":
            if x.name not in _INLINE:
                names.pop()
            dropped -= bool(dropped)
    return best, path


def extract(page: str, main: str, fixed: frozenset[int], mark: int = 0) -> str:
    """The text of a page under its host's wrapper, whose article group is at ``main`` with that mark.

    ``fixed`` holds the paths of template strings and the keys of template groups.

    The page's own article counts if it has a stronger mark or lacks the group.
    A page without any gives the text of its body outside of the dropped parts
    and of lists that are links only.
    """
    stream = list(events(page))
    best, own = own_path(stream)
    found = _blocks(stream, main, fixed) if main and best <= mark else None
    if found is None and own and own != main:
        found = _blocks(stream, own, fixed)
    elif found is None and own:
        found = _blocks(stream, main, fixed)
    return "\n".join(_blocks(stream, "", fixed) if found is None else found)


def _blocks(stream: list, main: str, fixed: frozenset[int]) -> list[str] | None:
    out: list[str] = []
    said: list[str] = []
    names: list[str] = []
    paths = [0]
    dropped = inside = links = breaks = lists = 0
    seen = not main
    depth, last = main.count("/") + 1, main.rpartition("/")[2]
    linked = total = 0  # characters of the block in links, and in all

    def end():
        nonlocal linked, total
        text = " ".join(html.unescape("".join(said)).split())
        said.clear()
        if text and (main or not (total and linked == total and lists)):
            out.append(text)
        linked = total = 0

    for kind, x in stream:
        if kind == "open":
            if x.name not in _INLINE:
                end()
                names.append(x.key)
                paths.append(_below(paths[-1], x.key))
                lists += x.name == "li"
                template = x.hard or x.doubtful and _group(paths[-1]) in fixed if inside else x.aside
                inside += bool(inside) or (bool(main) and len(names) == depth and names[-1] == last and not dropped and "/".join(names) == main)
                seen = seen or bool(inside)
                header = x.name == "header" and not inside
                dropped += bool(dropped) or template or header
            else:
                # inline elements count in the same way, but are no part of the path
                dropped += bool(dropped) or (x.hard if inside else x.aside)
                links += x.name == "a"
        elif kind == "close":
            if x.name not in _INLINE:
                end()
                names.pop()
                paths.pop()
                lists -= x.name == "li"
                inside -= bool(inside)
            links -= x.name == "a" and links > 0
            dropped -= bool(dropped)
        elif kind == "br":
            breaks += 1
            if breaks > 1:
                end()
            said.append(" ")
            continue
        elif not dropped and (inside or not main):
            if inside or not x.strip() or paths[-1] not in fixed:
                said.append(x)
                total += len(x.strip())
                linked += len(x.strip()) if links else 0
        if kind != "text" or x.strip():
            breaks = 0
    end()
    return out if seen else None


_SLOT = ("path", "said", "linked", "total")


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, pages = batch_columns(batch, "host", "html")
        rows = []
        for host, page in zip(hosts, pages):
            if page:
                stream = list(events(page))
                found = [dict(zip(_SLOT, slot)) for slot in slots(stream)]
                rows.append((host, json.dumps(expression(stream)), found, page_text(stream)))
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.string(), pa.string(), pa.list_(pa.struct([(c, pa.int64()) for c in _SLOT])), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["host", "parts", "slots", "page"])


def _fold_group(rows: pa.Table) -> pa.Table:
    whole: list | None = None
    for text in sorted(set(rows.column("parts").to_pylist())):
        parts = json.loads(text)
        whole = parts if whole is None else align(whole, parts)
    return pa.table({"host": pa.array([rows.column("host")[0].as_py()], pa.string()), "parts": pa.array([json.dumps(whole)], pa.string())})


_DESCRIBED = f"host string, parts string, slots array<struct<{','.join(f'{c}:long' for c in _SLOT)}>>, page long"


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, parts, fixed) per host of ``pages`` (url, html): wrapper, and the keys of its template strings and groups."""
    described = cut(pages.select(host_of("url").alias("host"), "html").mapInArrow(_describe, _DESCRIBED))
    wrappers = cut(described.select("host", "parts").distinct())
    while True:
        per_host = wrappers.groupBy("host").agg(F.count("*").alias("n"))
        if per_host.filter("n > 1").isEmpty():
            break
        groups = wrappers.join(per_host, "host").withColumn("part", F.pmod(F.xxhash64("parts"), F.ceil(F.col("n") / FOLD)))
        once = groups.groupBy("host", "part").applyInArrow(_fold_group, "host string, parts string")
        old, wrappers = wrappers, cut(once.distinct())
        if wrappers.count() >= old.count():  # a round of unlucky hashes: put what is left of each host together
            old2, wrappers = wrappers, cut(wrappers.groupBy("host").applyInArrow(_fold_group, "host string, parts string"))
            release(old2)
        release(old)
    # pages of one text agree trivially: one of them counts
    several = (F.min("page") < F.max("page")).alias("several")
    hosts = described.groupBy("host").agg(several.alias("aligned"))
    found = described.select("host", "page", F.explode("slots").alias("s")).groupBy("host", "s.path").agg(
        several, F.min("s.said").alias("lo"), F.max("s.said").alias("hi"), F.sum("s.linked").alias("linked"), F.sum("s.total").alias("total")
    )
    group = F.col("total") > 0
    agreed = F.col("several") & ((F.col("lo") == F.col("hi")) | (group & (2 * F.col("linked") >= F.col("total"))))
    same = found.join(hosts, "host").filter(agreed | (group & ~F.col("aligned"))).groupBy("host").agg(F.collect_list("path").alias("fixed"))
    out = cut(wrappers.join(same, "host", "left").select("host", "parts", "fixed"))
    release(described, wrappers)
    return out


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        ids, urls, pages, hosts, parts, fixed = batch_columns(batch, "page_id", "url", "html", "host", "parts", "fixed")
        texts = []
        for page, host, wrapper, same in zip(pages, hosts, parts, fixed):
            if not page:
                texts.append("")
                continue
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = (*(strongest(json.loads(wrapper)) if wrapper else (0, "")), frozenset(same or ()))
            mark, main, strings = known[host]
            texts.append(extract(page, main, strings, mark))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    A null or empty html gives an empty text; pages whose url is null or has no
    host share the wrapper of the empty host. Repeated rows are extracted
    alike; other columns are ignored; an empty table gives an empty result.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    wrappers = infer_wrappers(pages)
    held = wrappers.agg(F.sum(F.length("parts") + 100 + 8 * F.greatest(F.size("fixed"), F.lit(0)))).first()[0] or 0
    sent = F.broadcast(wrappers) if held <= BROADCAST_BYTES else wrappers
    rows = pages.withColumn("host", host_of("url")).join(sent, "host", "left")
    return rows.mapInArrow(_apply, "page_id long, url string, text string, n_chars long")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
