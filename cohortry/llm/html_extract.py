"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is read as a stream of tags and texts and balanced (implied end tags are added). A wrapper starts as one
page; then page after page is aligned with it. Where a tag follows again, its copies are folded into
one repeated group; where a tag is missing on one side it becomes optional; where tags interleave, all of
that stretch becomes a repeated group of optional parts; where texts differ, the text becomes a slot.
Alternatives are never kept side by side, so the wrapper stays a union-free expression whose size depends on the
kinds of tags. The result of aligning does not depend on how pages are shared out, so tasks infer wrappers
of their own pages, which are then aligned with each other in two levels.

A host's wrapper tells which of its places hold the article: article elements, else the main element, else the
place under which most slot text outside links stands. Text that is the same at its place on several pages
is the host's template: it has no weight in that choice, and a line of nothing else isn't given. Several pages are
pages whose texts outside menus and the like differ, so copies of a page don't make its text a template, and
neither does what stands on one page only (an optional part). Where nothing at all differs, constants count as text.
A page's text is what its tokens put into the slots there, without menus, forms, adverts, notices, comments
and the like, and without a header outside article and main elements. Names never rule out html, body and main
elements; an article element with the name of, say, a comment is only read if most of the host's text stands in such.
A class or id word rules a block out when all its parts are listed names or words of layout (related-posts). One with other
parts (related-work) is a hint: the host's wrapper decides, and the block goes if most of its slot text stands in links.

Defined results: a null, empty or tagless html gives its bare text or none; a null url is the host ''; pages
with equal ids are extracted each on its own; a page that lacks its host's places is judged by its own wrapper.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

DEPTH, HOSTS_HELD, SALTS, BROADCAST_BYTES = 120, 2000, 32, 32 << 20  # SALTS: of pages that are joined with their hosts

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[A-Za-z][^>]*\Z""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")  # one after the other, so that values aren't read as names
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.IGNORECASE) for t in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}

# The void and block elements of HTML, and what an article isn't.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table menu dir select".split())
NOISE_TAGS = frozenset("nav aside footer form button select option textarea script style noscript template iframe object svg canvas dialog menu head title input".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent notice notices newsletter subscribe share sharing social related recommended popup modal comment comments disqus reply replies masthead pagination pager contentinfo complementary rail responses teaser teasers trending outbrain taboola".split())
LAYOUT = frozenset("area article articles bar block body bottom box button buttons center column container content count entry footer form group header icon icons inner item items js left link links list main message outer overlay page panel post posts right row section site slot stories text thread title top unit widget wrap wrapper".split())
PAGE_NOISE = frozenset({"header", "footer"})
NEVER_NOISE = frozenset({"html", "body", "main", "article"})
ABOUT = frozenset("no not non has have with without".split())  # no-sidebar: a word on the page's layout, not what the element is


WORDED = frozenset("p h1 h2 h3 h4 h5 h6 b i em strong span a q cite code mark small sub sup time".split())  # of these only a whole class word counts


class Node:
    __slots__ = ("children", "label", "noise", "tag")

    def __init__(self, tag: str, label: str, noise: bool):
        self.tag, self.label, self.noise = tag, label, noise
        self.children: list[Node | str] = []


def _node(tag: str, attributes: str) -> Node:
    noise, listed, hinted, names = tag in NOISE_TAGS, False, False, []
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        key = m[1].lower()
        if key not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        value = (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value.strip() == "true" or key == "style" and UNSEEN.search(value):
            noise = True
        if key not in ("class", "id", "role"):
            continue
        words = value.split()
        for word in words:
            parts = [word] if tag in WORDED else [x for x in re.split(r"[-_]+", word) if x]
            if parts and parts[0] not in ABOUT and not NOISE_WORDS.isdisjoint(parts):
                whole = all(x in NOISE_WORDS or x in LAYOUT or x.isdigit() for x in parts)
                listed, hinted = listed or whole, hinted or not whole
        listed = listed or any(w in PAGE_NOISE for w in words) and tag != "article"
        if key != "id":
            names += [re.sub(r"\d+", "0", w) for w in words]
    noise = noise or listed and tag not in NEVER_NOISE
    mark = "!" if noise else "?" if listed and tag == "article" else "~" if hinted and tag not in NEVER_NOISE else ""
    return Node(tag, ".".join([tag, *names]) + mark, noise)


def parse(html: str) -> Node:
    """The page's tree; text is kept as it stands."""
    root = Node("", "", False)
    stack, at, end = [root], 0, len(html)

    def close(k: int) -> None:
        del stack[k:]

    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        for k in range(len(stack) - 1, 0, -1) if tag in SIBLINGS else ():
            if stack[k].tag in SIBLINGS[tag]:
                close(k)
            elif stack[k].tag in LISTS:
                break
        own = _node(tag, m[3] if m[2] else m[6])
        if len(stack) > DEPTH and not own.noise and any(n.noise for n in stack[DEPTH:]):
            own = Node(tag, own.label.rstrip("?!~") + "!", True)  # what hangs higher than it stands is still part of the menu around it
        stack[min(len(stack), DEPTH) - 1].children.append(own)
        if tag in RAW:
            stop = RAW[tag].search(html, at)
            at = stop.end() if stop else end
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            stack.append(own)
    return root


# A wrapper's part: [optional, repeated, grouped, text, characters, {label: part}, pages]; ``text`` is the digest of
# all texts at this place if no page has others, "" for a slot and None for an element; ``grouped``: its children come in any order, again and again;
# ``pages``: of a constant, the digests of the pages that hold it, the two smallest ones at most.
OPTIONAL, REPEATED, GROUPED, TEXT, CHARS, PARTS, PAGES = range(7)


def _leaf(text: str, page: str) -> list:
    return [False, False, False, hashlib.md5(text.encode("utf-8", "replace")).hexdigest(), len(text), {}, [page]]


def _page_digest(node: Node) -> str:
    """Of the page's text outside noise."""
    digest, stack = hashlib.md5(), [node]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                digest.update((" ".join(child.split()) + "\n").encode("utf-8", "replace"))
            elif not child.noise:
                stack.append(child)
    return digest.hexdigest()[:16]


def wrapper_of(node: Node, page: str | None = None) -> list:
    """The wrapper of one page."""
    page = page or _page_digest(node)
    out: list = [False, False, False, None, 0, {}, []]
    parts, last = out[PARTS], None
    for child in node.children:
        if isinstance(child, str):
            text = " ".join(child.split())
            if not text:
                continue
            label, part = "#text", _leaf(text, page)
        else:
            label, part = child.label, wrapper_of(child, page)
        if label in parts:
            parts[label] = align(parts[label], part, again=True)
            parts[label][REPEATED] = True
            if label != last:
                out[GROUPED] = True
        else:
            parts[label] = part
        last = label
    return out


def align(a: list, b: list, again: bool = False) -> list:
    """One wrapper of what two match. Inside one page (``again``) the copies' texts are one text of their place."""
    labels = _merged_order(list(a[PARTS]), list(b[PARTS]))
    grouped = a[GROUPED] or b[GROUPED] or labels is None
    parts = {}
    for label in labels if labels is not None else [*a[PARTS], *(x for x in b[PARTS] if x not in a[PARTS])]:
        x, y = a[PARTS].get(label), b[PARTS].get(label)
        if x is None or y is None:
            parts[label] = list(x or y)
            parts[label][OPTIONAL] = True
        else:
            parts[label] = align(x, y, again)
    text = a[TEXT]
    if text is not None and (again or text != b[TEXT]):
        text = hashlib.md5((text + b[TEXT]).encode()).hexdigest() if again else ""
    return [a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], grouped, text, a[CHARS] + b[CHARS], parts, sorted({*a[PAGES], *b[PAGES]})[:2] if text else []]


def _merged_order(a: list[str], b: list[str]) -> list[str] | None:
    """Both orders in one; None if they contradict each other."""
    common_a, common_b = [x for x in a if x in set(b)], [x for x in b if x in set(a)]
    if common_a != common_b:
        return None
    out, i = [], 0
    for x in common_a:
        j = a.index(x, i)
        out += a[i:j]
        i = j + 1
        k = b.index(x)
        out += [y for y in b[:k] if y not in out and y not in a]
        out.append(x)
    return out + a[i:] + [y for y in b if y not in out and y not in a]


def expression(part: list, label: str = "") -> str:
    """The wrapper as a regular expression over tags, with #PCDATA for slots."""
    if part[TEXT] is not None:
        inner = "#PCDATA" if part[TEXT] == "" else "text"
    else:
        own = [expression(p, name) for name, p in part[PARTS].items()]
        inner = " ".join(own)
        if part[GROUPED]:
            inner = "(" + " ".join(x if x.endswith("?") else f"({x})?" for x in own) + ")+"
        inner = f"<{label}> {inner} </{label}>" if label else inner
    return f"({inner})+" * part[REPEATED] + inner * (not part[REPEATED]) if not part[OPTIONAL] else f"({inner}){'*' if part[REPEATED] else '?'}"


def _tag(label: str) -> str:
    return label.split(".")[0].rstrip("!?~")


def _is_main(label: str) -> bool:
    return _tag(label) == "main" or "main" in label.rstrip("~").split(".")[1:]


def places(wrapper: list) -> list[list[str]]:
    """Paths of the elements that hold the article."""
    constants = not _text(wrapper, "", False, links=True, listed=True)
    every = _text(wrapper, "", constants, links=True, listed=True)
    clean = lambda x: _tag(x) == "article" and not x.endswith("?")
    for is_root, least in ((clean, 1), (lambda x: _tag(x) == "article", every / 2), (_is_main, 1)):
        found: list[tuple[list[str], int]] = []
        stack = [([], wrapper)]
        while stack:
            path, part = stack.pop()
            for label, p in part[PARTS].items():
                if label.endswith("!"):
                    continue
                if is_root(label):
                    found.append(([*path, label], _text(p, label.rstrip("?"), constants, links=True)))
                else:
                    stack.append(([*path, label], p))
        if found and sum(n for _, n in found) >= max(least, 1):
            return sorted(path for path, n in found if n)
    path, part = [], wrapper
    while True:
        sizes = {label: _text(p, label, constants) for label, p in part[PARTS].items()}
        best = max(sizes, key=lambda x: (sizes[x], x), default=None)
        if best is None or not sizes[best] or best == "#text" or _tag(best) in ("p", "h1") or sizes[best] < 0.7 * sum(sizes.values()):
            return [path]
        path, part = [*path, best], part[PARTS][best]


def _template(part: list) -> bool:
    """Whether this is a text that is constant over several pages."""
    return bool(part[TEXT]) and len(part[PAGES]) > 1


def _text(part: list, label: str, constants: bool, links: bool = False, listed: bool = False) -> int:
    """Characters of text that isn't the template's, with ``constants`` also of such; ``listed``: also in articles with a listed name."""
    if label.endswith("!") or label.endswith("?") and not listed or not links and _tag(label) in ("a", "header"):
        return 0
    if part[TEXT] is not None:
        return part[CHARS] if constants or not _template(part) else 0
    return sum(_text(p, x, constants, links, listed) for x, p in part[PARTS].items())


def _constants(part: list, alone: bool) -> dict:
    """What isn't the article's under a place, as a tree of labels: the template's texts, and as None hinted blocks of links. ``alone``: no template can be told."""
    out: dict = {}
    for label, p in part[PARTS].items():
        if p[TEXT] is not None:
            if not alone and _template(p):
                out[label] = {}
        elif label.endswith("~") and 2 * _text(p, "", alone) < _text(p, "", alone, links=True):
            out[label] = None
        elif not label.endswith("!") and (own := _constants(p, alone)):
            out[label] = own
    return out


def reading(wrapper: list) -> list:
    """How the host's pages are read: the path of each place and what isn't the article's there."""
    alone = not _text(wrapper, "", False, links=True, listed=True)  # nothing differs: no template to be told
    out = []
    for path in places(wrapper):
        part = wrapper
        for label in path:
            part = part[PARTS][label]
        out.append([path, _constants(part, alone)])
    return out


def slot_texts(page: Node, roots: list) -> list[str] | None:
    """Blocks that the page's tokens put into the slots under these places; None if it has none of them."""
    wanted, blocks, line = {tuple(path): template for path, template in roots}, [], []
    found = slot = False

    def flush() -> None:
        nonlocal slot
        text = " ".join(entities.unescape("".join(line)).split())
        if text and slot:
            blocks.append(text)
        line.clear()
        slot = False

    def put(node: Node, template: dict, inside: bool) -> None:
        nonlocal slot
        for child in node.children:
            if isinstance(child, str):
                line.append(child)
                slot = slot or "#text" not in template and not child.isspace()
            elif child.noise or child.label.endswith("?") or child.tag == "header" and not inside or template.get(child.label, {}) is None:
                if child.tag in BLOCK:
                    flush()
            else:
                if child.tag in BLOCK:
                    flush()
                elif child.tag in ("br", "wbr"):
                    line.append(" " if child.tag == "br" else "")
                put(child, template.get(child.label, {}), inside or child.tag in ("article", "main"))
                if child.tag in BLOCK:
                    flush()

    def walk(node: Node, path: tuple[str, ...]) -> None:
        nonlocal found
        if path in wanted:
            found = True
            flush()
            put(node, wanted[path], any(_tag(x) == "article" or _is_main(x) for x in path))
            flush()
            return
        for child in node.children:
            if isinstance(child, Node) and not child.noise:
                walk(child, (*path, child.label))

    walk(page, ())
    return blocks if found else None


def extract(html: str | None, roots: list | None) -> str:
    """``roots``: the host's reading."""
    if not html:
        return ""
    page = parse(html)
    blocks = slot_texts(page, roots) if roots is not None else None
    if blocks is None:
        blocks = slot_texts(page, reading(wrapper_of(page)))
    return "\n".join(blocks or [])


def _rows(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of each host as JSON, from all of its pages."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, held = isqrt(TaskContext.get().partitionId()), {}  # of n tasks, the root of n salts, each of twice as many tasks at most

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"host": list(held), "salt": pa.array([salt] * len(held), pa.int32()), "wrapper": [json.dumps(w) for w in held.values()]})
            held.clear()
            return batch

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html:
                    own = wrapper_of(parse(html))
                    held[host] = align(held[host], own) if host in held else own
                    if len(held) >= HOSTS_HELD:
                        yield sent()
        if held:
            yield sent()

    def aligned(keys: tuple, group: pa.Table) -> pa.Table:
        out = None
        for text in group.column("wrapper"):
            own = json.loads(text.as_py())
            out = own if out is None else align(out, own)
        return pa.table({"host": [keys[0].as_py()], "wrapper": [json.dumps(out)]})

    partial = _rows(pages).select("host", "html").mapInArrow(infer, "host string, salt int, wrapper string")
    once = partial.groupBy("host", "salt").applyInArrow(aligned, "host string, wrapper string")
    return once.groupBy("host").applyInArrow(aligned, "host string, wrapper string")


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [json.dumps(reading(json.loads(wrapper))) for wrapper in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roots, pa.string())], names=["host", "roots"])

    hosts = saved(wrappers(pages).mapInArrow(chosen, "host string, roots string"), "wrappers")
    size = hosts.agg(F.sum(F.octet_length("host") + F.octet_length("roots"))).first()[0] or 0
    rows = _rows(pages)
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({r.host: r.roots for r in hosts.collect()})
        rows = rows.withColumn("roots", F.lit(None).cast("string"))
    else:  # pages of one host go to several tasks, each with the host's places
        shared = None
        salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list] = {}
        for batch in batches:
            texts = []
            for html, host, roots in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                own = shared.value.get(host) if shared is not None else roots
                if own is not None and own not in read:
                    read[own] = json.loads(own)
                texts.append(extract(html, read.get(own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "host", "roots").mapInArrow(run, "page_id long, url string, text string, n_chars long")
