"""Main text of web pages by wrappers: union-free regular expressions over the tokens of a host's pages.

A page's tokens (tags, with their class and id, and texts) are aligned with those
of the other pages of its host, element by element. Neighbours of one kind, and
runs of two or three kinds that come again, become repeated groups; where two
sides differ, what only one side has becomes optional; differing texts become
text slots, equal ones stay constant. The result is the host's wrapper, a regular
expression without unions. It is pre-aggregated in each partition and merged in
three steps of at most 64 wrappers at a time, so that a host with a third of all
pages is no single group. Elements of a tag with more than ``KINDS`` classes and
ids beside each other become one kind, and contents of more than ``LONGEST`` kinds
a repeated group of optional ones: a wrapper does not grow with the pages.

The wrapper decides what is main text, on every host. Its region is found by
descent from the root into the element that holds most of the text that varies
from page to page, outside links (``article`` and ``main`` elements count
``HINTED`` times). Of the region's texts, slots are data and constants are
template, as are blocks of a repeated group that come on half of the pages (a slot
remembers its ``FREQUENT`` most frequent blocks); repeated groups that hold little
but links are menus. Tags, classes,
ids and roles are hints on both levels: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments carry no weight.

Cases: null or empty html gives empty text; pages with a null url form a host of
their own; a host's only page has constants only, which then count as data, as on
hosts whose region never varies; unclosed or misnested tags are closed as browsers
do, at any depth; texts are read whole; repeated rows give repeated rows; empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import pick, stash
from factweave.llm.hosts import host_and_path

#: What is taken from the wrappers of all hosts together is broadcast up to so many bytes, and joined by shuffle beyond.
BROADCAST_BYTES = 16 << 20
#: A constant text belongs to the template if at least so many pages have it, and at least half of the host's pages.
TEMPLATE_PAGES = 3
KINDS, LONGEST, FREQUENT = 32, 256, 32
HINTED = 16
#: The region is the smallest element that has this share of its parent's weight.
SHARE = 0.8
#: A repeated group is a menu if links make up this share of its text.
LINKS = 0.6
#: So many pages or wrappers are aligned at a time, and a partition's wrappers are handed on when there are so many hosts.
AT_ONCE, HOSTS_AT_ONCE = 64, 4096

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that never hold main text.
LEFT_OUT = frozenset("aside button canvas datalist dialog embed fieldset footer form head iframe input label menu nav noframes noscript object optgroup option script select style svg template textarea title video audio".split())
#: Elements that may be the region.
HOLDERS = frozenset("article body center div main section table tbody td tr".split())
HEADINGS = frozenset("h1 h2 h3 hgroup header".split())
#: Opening one of these closes an open one of the same set, up to the nearest of the second set.
CLOSES = {
    **dict.fromkeys(["li"], (frozenset(["li"]), frozenset(["ul", "ol", "menu"]))),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), frozenset(["dl"]))),
    **dict.fromkeys(["tr"], (frozenset(["tr", "td", "th"]), frozenset(["table"]))),
    **dict.fromkeys(["td", "th"], (frozenset(["td", "th"]), frozenset(["tr", "table"]))),
    **dict.fromkeys(["option"], (frozenset(["option"]), frozenset(["select", "datalist"]))),
}
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "li", "dt", "dd", "legend", "summary", "figcaption"} | {"li", "dt", "dd"}
#: Words of a class, id or role that mark what is no main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement adsense banner billboard breadcrumb breadcrumbs byline-ad comment comments commentlist complementary consent contentinfo cookie cookies dialog disqus footer footnav gdpr header hidden "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup print promo promoted promotion recommended related replies reply respond search share sharing sidebar sidenav sitemap skip social sponsor sponsored subscribe subscription taboola teaser toc toolbar topbar tracking widget widgets".split()
)

#: A token with one of these words tells what the page has or lacks, and marks nothing; nor does the header of one of the second set.
LAYOUT = frozenset("has have no non not with without".split())
HEADED = frozenset("article content entry headline post section story title".split())


def _marked(value: str) -> bool:
    """Whether a token of a class, id or role marks what is no main text."""
    for token in value.split():
        words = set(re.split(r"[_-]+", token))
        marks = words & MARKS
        if marks and not words & LAYOUT and not (marks == {"header"} and words & HEADED):
            return True
    return False



#: A tag as browsers read it: quotes only count right after an equals sign.
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?)*+)>""")
_ATTR = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+|(?=$))))?""")
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_NAMED = frozenset(("class", "id", "role"))


def _marked(value: str) -> bool:
    """Whether a token of a class, id or role marks what is no main text."""
    for token in value.split():
        words = set(re.split(r"[_-]+", token))
        marks = words & MARKS
        if marks and not words & LAYOUT and not (marks == {"header"} and words & HEADED):
            return True
    return False


class Node:
    """An element of a page with its children (elements, and texts as str). ``key`` is its kind: the tag, class, id and role."""

    __slots__ = ("tag", "key", "out", "children")
    n = 1

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        marks, self.out = "", tag in LEFT_OUT
        if attributes and not attributes.isspace():
            for m in _ATTR.finditer(attributes):
                name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if name in _NAMED:
                    self.out = self.out or tag not in ("html", "body") and _marked(value)
                    marks += f" {name}={value}"
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    self.out, marks = True, marks + " hidden"
        self.key = tag + re.sub(r"\d+", "0", marks)

    def contents(self) -> list[Group]:
        """The children as groups, repeated ones folded."""
        out = []
        for child in self.children:
            if isinstance(child, str):
                if s := squeeze(child):
                    out.append(Group("#", 0, Part("#", h=digest(s), t=len(s))))
            elif child.tag not in RAW:
                out.append(Group(child.key, 0, child))
        if len(out) == 1 and out[0].key == "#" and self.tag in BLOCK and self.tag != "h1":  # a page's own title may come again
            text = out[0].sides[0][0]
            text.f[text.h] = 1
            return out
        return fold(out)


def squeeze(text: str) -> str:
    return " ".join(html.unescape(text).split())


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def parse(page: str) -> Node:
    """The element tree; comments, declarations and the contents of raw elements are dropped."""
    root = Node("html")
    stack = [root]
    depths: dict[str, list[int]] = {}  # of the open elements of each tag
    blocks: list[int] = [0]  # depths of open blocks
    others: list[int] = [0]  # depths of open blocks other than p
    at, end = 0, len(page)

    def text(upto: int):
        if upto > at:
            piece = page[at:upto]
            if depths.get("head") and not piece.isspace() and stack[-1].tag == "head":
                close_to(depths["head"][-1])
            stack[-1].children.append(piece)

    def close_to(depth: int):
        while len(stack) > depth:
            tag = stack.pop().tag
            depths[tag].pop()
            if tag in BLOCK:
                blocks.pop()
                if tag != "p":
                    others.pop()

    def close(tags, barrier: int):
        """Close the nearest open element of ``tags`` that is deeper than ``barrier``."""
        depth = max((depths[t][-1] for t in tags if depths.get(t)), default=0)
        if depth > barrier:
            close_to(depth)

    search = at
    while (lt := page.find("<", search)) >= 0:
        after = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            text(lt)
            at = search = _COMMENT.match(page, lt).end()
        elif after in ("!", "?") or after == "/" and not page[lt + 2 : lt + 3].isalpha():
            stop = page.find(">", lt)
            text(lt)
            at = search = end if stop < 0 else stop + 1
        elif not (after.isalpha() or after == "/") or not (m := _TAG.match(page, lt) or _open_ended(page, lt)):
            if after.isalpha() and page.find(">", lt) < 0:  # no tag ends any more
                if page.find("<", lt + 1) < 0:
                    end = lt
                break
            search = lt + 1  # a bare < is text
        else:
            text(lt)
            at = search = m.end()
            tag = m[1].lower()
            if page[lt + 1] == "/":
                if depths.get(tag):
                    close((tag,), 0 if tag in BLOCK else blocks[-1])
                continue
            if tag == "html":
                continue
            if depths.get("head") and tag not in IN_HEAD:
                close_to(depths["head"][-1])
            if tag in CLOSES:
                tags, until = CLOSES[tag]
                close(tags, max((depths[t][-1] for t in until if depths.get(t)), default=0))
            if tag in CLOSES_P:
                close(("p",), others[-1])
            node = Node(tag, m[2])
            stack[-1].children.append(node)
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                at = search = end if stop is None else (page.find(">", stop.start()) + 1 or end)
            elif tag not in VOID and not m[2].endswith("/"):
                depth = len(stack)
                depths.setdefault(tag, []).append(depth)
                if tag in BLOCK:
                    blocks.append(depth)
                    if tag != "p":
                        others.append(depth)
                stack.append(node)
    text(end)
    return root


_OPEN_ENDED = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*+)>")


def _open_ended(page: str, at: int):
    """A tag with a quote that is never closed ends at the next >. This happens once for each kind of quote, so it costs no more than a pass."""
    return _OPEN_ENDED.match(page, at)


# ---- wrappers ----


class Part:
    """A part of a wrapper: an element, or (kind "#") a text.

    ``n`` counts pages, ``t`` characters and ``a`` those of them in links; ``r`` says
    that it is repeated, ``o`` that it is optional; ``h`` is the digest of a constant
    text, or None for a slot; ``f`` has the pages of frequent texts that are all of their block.
    """

    __slots__ = ("key", "n", "t", "a", "r", "o", "h", "f", "kids")

    def __init__(self, key: str, n: int = 1, t: int = 0, r: bool = False, o: bool = False, h: int | None = None):
        self.key, self.n, self.t, self.a, self.r, self.o, self.h, self.f, self.kids = key, n, t, 0, r, o, h, {}, []

    @property
    def tag(self) -> str:
        return self.key.partition(" ")[0]

    def contents(self) -> list[Group]:
        return [Group(k.key, 0, k) for k in self.kids]


class Group:
    """What is aligned to one part: by side (page or wrapper), the members (elements of pages, or parts)."""

    __slots__ = ("key", "sides")

    def __init__(self, key: str, side: int, member):
        self.key, self.sides = key, {side: [member]}

    def take(self, other: Group) -> None:
        for side, members in other.sides.items():
            self.sides.setdefault(side, []).extend(members)


def fold(items: list[Group]) -> list[Group]:
    """Repeated groups: neighbours of one kind first, then runs of two or three kinds that come again."""
    out: list[Group] = []
    for item in items:
        if out and out[-1].key == item.key:
            out[-1].take(item)
        else:
            out.append(item)
    for size in (2, 3):
        if len(out) < 2 * size:
            break
        done: list[Group] = []
        for item in out:
            done.append(item)
            while len(done) >= 2 * size and all(done[-i].key == done[-i - size].key for i in range(1, size + 1)):
                for i in range(1, size + 1):
                    done[-i - size].take(done[-i])
                del done[-size:]
        out = done
    return out


def aligned(a: list[Group], b: list[Group]) -> list[Group]:
    """Align two contents: a mismatch is skipped on the side where its partner comes later."""
    if [x.key for x in a] == [x.key for x in b]:
        for x, y in zip(a, b):
            x.take(y)
        return a
    where: dict[str, list[int]] = {}
    for i in range(len(a) - 1, -1, -1):
        where.setdefault(a[i].key, []).append(i)
    out, at = [], 0
    for item in b:
        places = where.get(item.key) or where.get(item.key.partition(" ")[0] + " *") or []
        while places and places[-1] < at:
            places.pop()
        if places:
            out += a[at : places[-1]]
            a[places[-1]].take(item)
            out.append(a[places[-1]])
            at = places[-1] + 1
        else:
            out.append(item)
    return fold(out + a[at:])


def bounded(items: list[Group]) -> list[Group]:
    """Contents with many kinds of one tag, or many kinds, become fewer kinds."""
    if len(items) > KINDS:
        kinds = Counter(key.partition(" ")[0] for key in {x.key for x in items})
        many = {tag for tag, n in kinds.items() if n > KINDS}
        if many:
            for x in items:
                tag = x.key.partition(" ")[0]
                if tag in many:
                    x.key = f"{tag} *"
            items = fold(items)
    if len(items) > LONGEST:
        kept: dict[str, Group] = {}
        for x in items:
            if x.key in kept:
                kept[x.key].take(x)
            else:
                kept[x.key] = x
        items = list(kept.values())
    return items


def frequent(sides: list[list[Part]]) -> dict[int, int]:
    """Pages of the most frequent texts (a mergeable summary: beyond ``FREQUENT`` texts, all counts are lowered by the next one's)."""
    total: Counter = Counter()
    for side in sides:
        if len(side) == 1:
            total.update(side[0].f)
        else:
            most: dict[int, int] = {}
            for part in side:
                for h, n in part.f.items():
                    most[h] = max(n, most.get(h, 0))
            total.update(most)
    if len(total) > FREQUENT:
        less = sorted(total.values(), reverse=True)[FREQUENT]
        total = {h: n - less for h, n in total.items() if n > less}
    return dict(sorted(total.items()))


def wrapper(roots: list) -> Part:
    """The wrapper of some pages (their root elements) and wrappers (their root parts)."""
    top = Part("html")
    work: list[tuple[Part, list[list]]] = [(top, [[root] for root in roots])]
    made = [top]
    for part, sides in work:  # grows as it goes
        part.n = sum(max(m.n for m in side) for side in sides)
        items: list[Group] | None = None
        for side, members in enumerate(sides):
            for member in members:
                new = member.contents()
                for x in new:
                    x.sides = {side: x.sides[0]}
                items = new if items is None else aligned(items, new)
        for x in bounded(items or []):
            members = [m for side in x.sides.values() for m in side]
            kid = Part(x.key, o=len(x.sides) < len(sides) or any(isinstance(m, Part) and m.o for m in members))
            if x.key == "#":
                kid.n = sum(max(m.n for m in side) for side in x.sides.values())
                kid.t = sum(m.t for m in members)
                kid.h = members[0].h if all(m.h == members[0].h for m in members) else None
                kid.f = frequent(list(x.sides.values()))
            else:
                kid.r = any(len(side) > 1 for side in x.sides.values()) or any(isinstance(m, Part) and m.r for m in members)
                work.append((kid, list(x.sides.values())))
            part.kids.append(kid)
            made.append(kid)
    for part in reversed(made):
        if part.key != "#":
            part.t = sum(k.t for k in part.kids)
            part.a = part.t if part.tag == "a" else sum(k.a for k in part.kids)
    return top


def dump(top: Part) -> str:
    """A wrapper as JSON: its parts in order, each with the number of its kids."""
    rows, work = [], [top]
    while work:
        part = work.pop()
        rows.append([part.key, part.n, part.t, part.a, int(part.r) + 2 * int(part.o), part.h, list(part.f.items()), len(part.kids)])
        work += reversed(part.kids)
    return json.dumps(rows, separators=(",", ":"))


def load(text: str) -> Part:
    top, open_ = None, []
    for key, n, t, a, flags, h, f, kids in json.loads(text):
        part = Part(key, n, t, bool(flags & 1), bool(flags & 2), h)
        part.a, part.f = a, dict(f)
        while open_ and not open_[-1][1]:
            open_.pop()
        if open_:
            open_[-1][0].kids.append(part)
            open_[-1][1] -= 1
        else:
            top = part
        open_.append([part, kids])
    return top


# ---- what a wrapper says ----


def _key_out(key: str) -> bool:
    tag, _, marks = key.partition(" ")
    return tag in LEFT_OUT or tag not in ("html", "body") and _marked(re.sub(r"(?:^|(?<= ))(?:class|id|role)=", "", marks))


def _hinted(key: str) -> bool:
    return key.startswith(("article", "main")) and key.partition(" ")[0] in ("article", "main") or "role=main" in key.split(" ")


def _chain(above: int, key: str) -> int:
    return xxhash.xxh64_intdigest(f"{above} {key}") >> 1


class Rule:
    """How to extract the pages of a host: the path of kinds down to the region, and what is cut from it (digests of menus and of constant texts, with the kinds above them)."""

    def __init__(self, path: list[str], cut: list[int]):
        self.path, self.cut = path, frozenset(cut)

    def dump(self) -> str:
        return json.dumps([self.path, sorted(self.cut)], separators=(",", ":"))

    @classmethod
    def load(cls, text: str | None) -> Rule:
        return cls(*json.loads(text)) if text else cls([], [])


def rule_of(top: Part) -> Rule:
    """The region of a wrapper, and the template's parts in it."""
    order, work = [], [top]
    while work:
        part = work.pop()
        order.append(part)
        work += part.kids
    template = lambda p: p.h is not None and p.n >= TEMPLATE_PAGES and 2 * p.n >= top.n
    weight: dict[int, float] = {}
    for part in reversed(order):
        if part.key == "#":
            weight[id(part)] = 0 if template(part) else part.t
        elif _key_out(part.key) or part.tag == "a":
            weight[id(part)] = 0
        else:
            weight[id(part)] = sum(weight[id(k)] for k in part.kids) * (HINTED if _hinted(part.key) else 1)
    path, region, held = [], top, False
    while not region.r:
        kids = [k for k in region.kids if k.key != "#"]
        best = max(kids, key=lambda k: weight[id(k)], default=None)
        if best is None or not weight[id(best)] or weight[id(best)] < SHARE * sum(weight[id(k)] for k in region.kids):
            break
        if best.tag not in HOLDERS and not _hinted(best.key) or held and not _hinted(best.key):
            break
        if not _hinted(best.key) and (best.r or any(k is not best and k.tag in HEADINGS and weight[id(k)] for k in kids)):
            break
        path.append(best.key)
        region, held = best, held or _hinted(best.key)
    inside, work = [], [(region, 0, region)]
    while work:
        part, above, block = work.pop()
        inside.append((part, above, block))
        if part.key != "#" and (part is region or not _key_out(part.key)):
            chain = above if part is region else _chain(above, part.key)
            block = part if part.tag in BLOCK else block
            work += [(k, chain, block) for k in part.kids]
    cut = []
    # A constant beside a slot of its block is part of a sentence; and texts that never vary would leave nothing. Both are data.
    varying = {id(block) for p, _, block in inside if p.key == "#" and p.h is None}
    if varying:
        cut += [_chain(above, str(p.h)) for p, above, block in inside if p.key == "#" and id(block) not in varying and block.tag != "h1" and template(p)]
        cut += [_chain(above, f"={h}") for p, above, _ in inside for h, n in p.f.items() if n >= TEMPLATE_PAGES and 2 * n >= top.n]
    if not held:
        cut += [_chain(above, p.key) for p, above, _ in inside if p is not region and p.key != "#" and p.tag in ("ul", "ol", "dl", "div", "table") and p.t and p.a >= LINKS * p.t and any(k.r for k in p.kids)]
    return Rule(path, cut)


def _only_text(node: Node) -> str:
    """The text of an element that holds one text and nothing else, or nothing."""
    found = [c for c in node.children if not isinstance(c, str) or not c.isspace()]
    return found[0] if len(found) == 1 and isinstance(found[0], str) else ""


def main_text(page: str | None, rule: Rule) -> str:
    """The main text: blocks in page order, joined by an empty line."""
    if not page:
        return ""
    tops, inside = [parse(page)], False
    for key in rule.path:
        tag = key[:-2] if key.endswith(" *") else None
        below = [c for t in tops for c in t.children if isinstance(c, Node) and (c.tag == tag if tag else c.key == key)]
        if not below:
            break
        tops, inside = below, inside or key.partition(" ")[0] != "body"
    blocks: list[str] = []
    line: list[str] = []
    cut = rule.cut

    def flush():
        if s := squeeze("".join(line)):
            blocks.append(s)
        line.clear()

    for top in tops:
        flush()
        work: list[tuple] = [(c, 0) for c in reversed(top.children)]
        while work:
            item, above = work.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                if not cut or _chain(above, str(digest(squeeze(item)))) not in cut:
                    line.append(item)
            elif not item.out and not (item.tag == "header" and not inside):
                chain = _chain(above, item.key) if cut else 0
                if cut and chain in cut:
                    continue
                if item.tag == "br":
                    line.append(" ")
                elif item.tag in BLOCK:
                    flush()
                    if cut and _chain(chain, f"={digest(squeeze(_only_text(item)))}") in cut:
                        continue
                    work.append((None, 0))
                    work += [(c, chain) for c in reversed(item.children)]
                elif item.tag not in VOID:
                    work += [(c, chain) for c in reversed(item.children)]
    flush()
    return "\n\n".join(blocks)


# ---- DataFrames ----


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (a JSON text) for every host of ``pages`` (``host, html``)."""

    def rows(hosts: list, parts: list, texts: list):
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(parts, pa.int32()), pa.array(texts, pa.string())], ["host", "part", "wrapper"])

    def fold_pages(batches: Iterator[pa.RecordBatch]):
        seen: dict[str, list] = {}
        number = TaskContext.get().partitionId()

        def hand_on():
            out = rows(list(seen), [number] * len(seen), [dump(wrapper(roots)) for roots in seen.values()])
            seen.clear()
            return out

        waiting = 0
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                if page := page.as_py():
                    mine = seen.setdefault(host, [])
                    mine.append(parse(page))
                    waiting += 1
                    if len(mine) >= AT_ONCE or len(page) > 1 << 20:
                        waiting -= len(mine) - 1
                        seen[host] = [wrapper(mine)]
                    if waiting >= HOSTS_AT_ONCE:
                        yield hand_on()
                        waiting = 0
        yield hand_on()

    def merge_runs(batches: Iterator[pa.RecordBatch]):
        """Merge the runs of rows of one host and part; rows come sorted by them."""
        key, mine = None, []
        for batch in batches:
            done = []
            for host, part, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, part) != key:
                    if mine:
                        done.append((*key, dump(wrapper(mine))))
                    key, mine = (host, part), []
                mine.append(load(text))
                if len(mine) >= AT_ONCE:
                    mine = [wrapper(mine)]
            if done:
                yield rows(*map(list, zip(*done)))
        if mine:
            yield rows([key[0]], [key[1]], [dump(wrapper(mine))])

    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "host string, part int, wrapper string"
    out = pages.mapInArrow(fold_pages, schema)
    for together in (AT_ONCE, AT_ONCE, 1 << 30):
        out = out.withColumn("part", F.floor(F.col("part") / together).cast("int"))
        out = out.repartition(n, "host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(merge_runs, schema)
    return out.select("host", "wrapper")


def host_rules(wrappers: DataFrame) -> DataFrame:
    """``host, rule`` (a JSON text): what each wrapper says about its host's pages."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [rule_of(load(text)).dump() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "rule"])

    return wrappers.select("host", "wrapper").mapInArrow(run, "host string, rule string")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``)."""
    rows = pick(pages, page_id="page_id", url="url", html="html").withColumn("host", host_and_path(F.col("url"))[0])
    rules = stash(host_rules(host_wrappers(rows.select("host", "html"))), "rules")
    size = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + F.octet_length("host")), F.lit(0))).first()[0]
    rules = F.broadcast(rules) if size <= BROADCAST_BYTES else rules

    def run(batches: Iterator[pa.RecordBatch]):
        known: dict[str | None, Rule] = {}
        for batch in batches:
            texts = []
            for page, rule in zip(batch.column(2), batch.column(3).to_pylist()):
                if rule not in known:
                    if len(known) > 500:
                        known.clear()
                    known[rule] = Rule.load(rule)
                texts.append(main_text(page.as_py(), known[rule]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    joined = rows.join(rules, "host", "left").select("page_id", "url", "html", "rule")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
