"""Main text of web pages: union-free regular expressions inferred per host, matched against each page.

A page is a stream of block tags and text runs. The streams of a host are aligned one after the other
into its wrapper: equal tags stay, tags that only some pages have become optional, neighbours that
repeat become one repeated item or group, and texts that differ become slots. The wrapper then says
for each text place how surely it belongs to the article, and every page is read through it.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import extra_name, query, table, whole_text
from caselog.llm.url_filter import host_of
from caselog.operators.skew import lookup
from caselog.session import cut_lineage

# Elements without content, with raw text, that are blocks (all others run inside a line), that end
# open ones up to a scope, and that look alike only if their names and insides do.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main map math menu "
    "nav noscript object ol optgroup option p picture pre search section select summary svg table tbody td template "
    "tfoot th thead tr ul video audio".split()
)
GENERAL = frozenset("article center div section".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "article": ({"nav"}, set()),
    "main": ({"nav"}, set()),
}

# Elements that never belong to the text, and words of class, id and role that say what a part is.
OUTSIDE_TAGS = frozenset(
    "nav aside footer head noscript template menu dialog button select option optgroup object svg math canvas map "
    "video audio picture search".split()
)
PART_WORDS = {
    "menu": "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager",
    "head": "header masthead topbar",
    "foot": "footer contentinfo copyright colophon",
    "side": "sidebar aside rail widget widgets related recommended recommendations trending complementary",
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion",
    "notice": "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription paywall",
    "comment": "comment comments commentlist discussion disqus replies reply respond",
    "share": "share sharing social",
    "form": "form search searchbox searchform login signup",
    "text": "article content main post entry story",
}
PART_OF_WORD = {word: part for part, words in PART_WORDS.items() for word in words.split()}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>"""
    r"""|</?[A-Za-z][^>]*\Z|(?P<text>[^<]+|<)""",
    re.S,
)
HINT = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[a-z]+")
CLOSE_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}

#: Elements nested deeper than this count as part of the one around them.
DEPTH = 48
#: A sequence of more different items than this becomes one repeated group of optional ones.
MOST_ITEMS = 64
#: Repeated groups have at most so many items.
LONGEST_GROUP = 4
#: A task holds wrappers of at most so many hosts before it hands them on.
HOSTS_HELD = 2000
#: Partial wrappers of one host first meet in so many groups.
GROUPS = 16
#: Wrappers travel with the pages by broadcast up to this size in all, by a join beyond.
BROADCAST_BYTES = 16 << 20
VARIES = 0


def names_of(rest: str) -> list[str]:
    """The words of class, id and role, digits aside."""
    return [w for _name, value in HINT.findall(rest) for w in WORD.findall(CAMEL.sub(" ", value).lower())]


def part_of(names: list[str]) -> str:
    """The part that the names tell; empty if none. Titles of the text itself are no page header."""
    found = {PART_OF_WORD[w] for w in names if w in PART_OF_WORD}
    if "text" in found and found <= {"text", "head"}:
        return "text"
    return min(found - {"text"}, default="")


def sign_of(tag: str, rest: str) -> str:
    """Tag, part and, for general blocks, a digest of their names: `div.side~1f2e`."""
    names = names_of(rest) if rest else []
    part = part_of(names)
    sign = f"{tag}.{part}" if part else tag
    return f"{sign}~{xxhash.xxh32_hexdigest(' '.join(names))}" if names and tag in GENERAL else sign


def broad(sign: str) -> str:
    """The sign without the digest of names."""
    return sign.partition("~")[0]


class Page:
    """The blocks of a page, and its tree of (sign, children); a child may be a (block number,) instead."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int]] = []
        self.root = ("page", [])
        self.open, self.run, self.links, self.in_link, self.muted = [("page", self.root, False)], [], 0, 0, 0
        position, end = 0, len(source)
        while position < end:
            found = TOKEN.match(source, position)
            position = found.end()
            text = found["text"]
            if text is not None:
                self.write(text)
                continue
            tag = (found["tag"] or found["tag2"] or "").lower()
            if not tag:
                continue
            if found["end"] or found["end2"]:
                self.close(tag)
                continue
            rest = found["rest"] or found["rest2"] or ""
            if tag in RAW:
                closing = CLOSE_RAW[tag].search(source, position)
                position = closing.start() if closing else end
            elif tag not in VOID:
                self.start(tag, rest)
            elif tag == "br":
                self.run.append(" ")
            elif tag == "hr":
                self.flush()
        self.flush()

    def write(self, text: str) -> None:
        if self.muted:
            return
        text = html.unescape(text)
        self.run.append(text)
        if self.in_link:
            self.links += len(text.strip())

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.open[-1][1][1].append((len(self.blocks),))
            self.blocks.append((text, self.links))
        self.run.clear()
        self.links = self.in_link = 0

    def start(self, tag: str, rest: str) -> None:
        if tag not in BLOCKS:
            if tag == "a":
                self.in_link = 1
            if self.muted or (rest and part_of(names_of(rest)) not in ("", "text")):
                self.open.append((tag, self.open[-1][1], True))
                self.muted += 1
            return
        under = next(entry for entry in reversed(self.open) if not entry[2])
        if self.muted and under[0] != "p":
            self.open.append((tag, under[1], True))
            self.muted += 1
            return
        self.flush()
        if tag in ("html", "body"):
            if self.open[-1][0] == "head":
                self.pop(len(self.open) - 1)
            return
        if self.open[-1][0] == "head" and tag not in ("noscript", "template", "object"):
            self.pop(len(self.open) - 1)
        at = len(self.open) - 1
        while at and (self.open[at][2] or self.open[at][0] == "p"):
            at -= 1
        self.pop(at + 1)
        if tag in ENDS:
            ended, scope = ENDS[tag]
            last = None
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at][0] in scope:
                    break
                if self.open[at][0] in ended:
                    last = at
            if last is not None:
                self.pop(last)
        parent = self.open[-1][1]
        if len(self.open) > DEPTH:
            self.open.append((tag, parent, False))
            return
        node = (sign_of(tag, rest), [])
        parent[1].append(node)
        self.open.append((tag, node, False))

    def close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
        if tag not in BLOCKS and not self.muted:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                if not self.open[at][2]:
                    self.flush()
                self.pop(at)
                return
            if tag not in BLOCKS and not self.open[at][2]:
                return

    def pop(self, at: int) -> None:
        self.muted -= sum(muted for _tag, _node, muted in self.open[at:])
        del self.open[at:]


class Item:
    """One item of a wrapper: a block with its items, a repeated group of items, or a text place.

    `optional` and `many` are its multiplicity; `loose` marks items that come in any order. A text place
    has the digest of its text, or VARIES once it is a slot, and how often and how long it occurs.
    `numbers` are the blocks of the page it was made from.
    """

    __slots__ = ("sign", "optional", "many", "loose", "items", "digest", "seen", "chars", "links", "numbers", "rank")

    def __init__(self, sign: str, items: list[Item] | None = None):
        self.sign, self.items = sign, items or []
        self.optional = self.many = self.loose = False
        self.digest, self.seen, self.chars, self.links, self.numbers, self.rank = VARIES, 1, 0, 0, [], -1


TEXT, GROUP = "#", "("


def of_page(page: Page, numbered: bool = True) -> Item:
    """The wrapper of one page alone, with the numbers of its blocks."""

    def item(node: tuple) -> Item:
        if len(node) == 1:
            made = Item(TEXT)
            text, made.links = page.blocks[node[0]]
            made.digest, made.chars = xxhash.xxh64_intdigest(text) | 1, len(text)
            made.numbers = [node[0]] if numbered else []
            return made
        made = Item(node[0])
        settle(made, folded([item(child) for child in node[1]]))
        return made

    return item(page.root)


def folded(items: list[Item]) -> list[Item]:
    """Neighbours that repeat become one repeated item, then sequences of up to LONGEST_GROUP one group."""
    out: list[Item] = []
    for item in items:
        if out and out[-1].sign == item.sign and alike(out[-1], item):
            merge(out[-1], item, repeated=True)
        else:
            out.append(item)
    for length in range(2, LONGEST_GROUP + 1):
        if len(out) < 2 * length:
            break
        items, out = out, []
        for item in items:
            out.append(item)
            signs = [i.sign for i in out[-length:]]
            if len(signs) < length:
                continue
            before = out[-length - 1] if len(out) > length else None
            if before is not None and before.sign == group_sign(signs):
                last = group_of(out[-length:])
                del out[-length:]
                merge(before, last, repeated=True)
            elif len(out) >= 2 * length and [i.sign for i in out[-2 * length : -length]] == signs:
                first, last = group_of(out[-2 * length : -length]), group_of(out[-length:])
                del out[-2 * length :]
                merge(first, last, repeated=True)
                out.append(first)
    return out


def alike(one: Item, other: Item) -> bool:
    """Whether neighbours of one sign repeat: general blocks only with the same kinds of items inside."""
    if broad(one.sign).partition(".")[0] not in GENERAL:
        return True
    return {i.sign for i in ungrouped(one.items)} == {i.sign for i in ungrouped(other.items)}


def group_sign(signs: list[str]) -> str:
    return GROUP + ",".join(signs) + ")"


def group_of(items: list[Item]) -> Item:
    return Item(group_sign([i.sign for i in items]), items)


def settle(owner: Item, items: list[Item]) -> None:
    """Gives an item its sequence; one of too many items becomes loose."""
    owner.items = items
    if len(items) > MOST_ITEMS:
        loosen(owner)


def loosen(owner: Item) -> None:
    """One repeated group of optional items, each sign once and without names: (a? b? c?)+."""
    known: dict[str, Item] = {}
    for item in ungrouped(owner.items):
        item.sign = broad(item.sign)
        if item.sign in known:
            merge(known[item.sign], item, repeated=True)
        else:
            known[item.sign] = item
            item.optional = item.many = True
    owner.items, owner.loose = list(known.values()), True


def ungrouped(items: list[Item]) -> Iterator[Item]:
    for item in items:
        if item.sign[0] == GROUP:
            yield from ungrouped(item.items)
        else:
            yield item


def merge(into: Item, other: Item, repeated: bool = False) -> None:
    """Generalises an item so that it also covers another of its sign."""
    into.many |= other.many or repeated
    into.optional |= other.optional
    into.seen += other.seen
    into.chars += other.chars
    into.links += other.links
    into.numbers += other.numbers
    if into.digest != other.digest:
        into.digest = VARIES
    if into.loose or other.loose:
        into.items = [*into.items, *other.items]
        loosen(into)
    elif [i.sign for i in into.items] == [i.sign for i in other.items]:
        for mine, theirs in zip(into.items, other.items):
            merge(mine, theirs)
    else:
        settle(into, aligned(into.items, other.items))


def regrouped(items: list[Item], groups: list[Item]) -> list[Item]:
    """Sequences that the other side has as a repeated group become that group, once."""
    for group in groups:
        signs = [i.sign for i in group.items]
        out: list[Item] = []
        for item in items:
            out.append(item)
            if [i.sign for i in out[-len(signs) :]] == signs:
                out[-len(signs) :] = [group_of(out[-len(signs) :])]
        items = out
    return items


def pairs_of(mine: list[Item], theirs: list[Item]) -> Iterator[tuple[Item | None, Item | None]]:
    """A longest common subsequence by sign; items of one side only come with None."""
    rows = [[0] * (len(theirs) + 1) for _ in range(len(mine) + 1)]
    for i in range(len(mine) - 1, -1, -1):
        for j in range(len(theirs) - 1, -1, -1):
            if mine[i].sign == theirs[j].sign:
                rows[i][j] = rows[i + 1][j + 1] + 1
            else:
                rows[i][j] = max(rows[i + 1][j], rows[i][j + 1])
    i = j = 0
    while i < len(mine) or j < len(theirs):
        if i < len(mine) and j < len(theirs) and mine[i].sign == theirs[j].sign:
            yield mine[i], theirs[j]
            i, j = i + 1, j + 1
        elif j == len(theirs) or (i < len(mine) and rows[i + 1][j] >= rows[i][j + 1]):
            yield mine[i], None
            i += 1
        else:
            yield None, theirs[j]
            j += 1


def aligned(mine: list[Item], theirs: list[Item]) -> list[Item]:
    """Two sequences as one: mismatches become optional, and what then repeats is folded."""
    theirs = regrouped(theirs, [i for i in mine if i.sign[0] == GROUP])
    mine = regrouped(mine, [i for i in theirs if i.sign[0] == GROUP])
    out = []
    for a, b in pairs_of(mine, theirs):
        if a is not None and b is not None:
            merge(a, b)
        else:
            (a or b).optional = True
        out.append(a or b)
    return folded(out)


def dumps(item: Item, whole: bool = True) -> str:
    """A wrapper as text: all of it, or only what matching needs."""

    def plain(i: Item) -> list:
        flags = i.optional | i.many << 1 | i.loose << 2
        items = [plain(x) for x in i.items]
        if not whole:
            return [i.sign, i.loose | 0, i.rank, items]
        return [i.sign, flags, i.digest, i.seen, i.chars, i.links, items]

    return json.dumps(plain(item), separators=(",", ":"))


def loads(text: str, whole: bool = True) -> Item:
    def item(plain: list) -> Item:
        made = Item(plain[0], [item(x) for x in plain[-1]])
        if whole:
            made.optional, made.many, made.loose = bool(plain[1] & 1), bool(plain[1] & 2), bool(plain[1] & 4)
            made.digest, made.seen, made.chars, made.links = plain[2:6]
        else:
            made.loose, made.rank = bool(plain[1]), plain[2]
        return made

    return item(json.loads(text))


# How surely a text place belongs to the article.
ARTICLE, MAIN, NAMED, SLOT, OUTSIDE = 3, 2, 1, 0, -1


def ranked(wrapper: Item) -> Item:
    """Sets the rank of every text place, and of the blocks around them.

    Menus, footers, sidebars and the like are outside. Inside an article element, a main element or a
    block named as text, every other place counts. Elsewhere slots count, unless most of their text is
    links; a text that all pages share counts only if the pages of the host differ nowhere else. Names
    of a block that holds all the text there is, as in "with-sidebar", do not make it a sidebar.
    """
    texts: dict[int, int] = {}

    def count(item: Item) -> int:
        """How many blocks say that they are the text, in all."""
        texts[id(item)] = sum(map(count, item.items)) + (_is_text(item) > SLOT)
        return texts[id(item)]

    def slots(item: Item) -> bool:
        return (item.sign == TEXT and item.digest == VARIES) or any(map(slots, item.items))

    whole, differs = count(wrapper), slots(wrapper)

    def is_outside(item: Item, rank: int) -> bool:
        tag, _dot, part = broad(item.sign).partition(".")
        if tag in OUTSIDE_TAGS or part in ("comment", "advert", "notice"):
            return True
        if whole and texts[id(item)] == whole:
            return False
        return tag == "form" or part in ("menu", "foot", "side", "share", "form") or (
            rank <= SLOT and (tag == "header" or part == "head")
        )

    def walk(item: Item, rank: int) -> None:
        if item.sign == TEXT:
            constant = differs and item.digest != VARIES and item.seen > 1
            linked = 2 * item.links > item.chars
            item.rank = OUTSIDE if rank == SLOT and (constant or linked) else rank
            return
        if item.sign[0] != GROUP and rank != OUTSIDE:
            rank = OUTSIDE if is_outside(item, rank) else max(rank, _is_text(item))
        item.rank = rank
        for inner in item.items:
            walk(inner, rank)

    walk(wrapper, SLOT)
    return wrapper


def _is_text(item: Item) -> int:
    """ARTICLE, MAIN or NAMED for blocks that say they are the text; else SLOT."""
    tag, _dot, part = broad(item.sign).partition(".")
    if part not in ("", "text", "head"):
        return SLOT
    return ARTICLE if tag == "article" else MAIN if tag == "main" else NAMED if part == "text" else SLOT


def matched(wrapper: Item, page: Item, ranks: dict[int, int], apart: list[tuple[int, Item]]) -> None:
    """Reads a page's own wrapper through its host's: each block gets the rank of its text place.

    Where equal signs repeat, a block may meet another place than the one it once went into. What has no
    place there goes to `apart`, with the rank of the block around it.
    """
    if page.sign == TEXT:
        ranks.update(dict.fromkeys(page.numbers, wrapper.rank))
        return
    if wrapper.loose or page.loose:
        pairs = [(None, i) for i in ungrouped(page.items)]
    else:
        groups = [i for i in wrapper.items if i.sign[0] == GROUP]
        pairs = list(pairs_of(wrapper.items, regrouped(page.items, groups)))
    by_sign = {i.sign: i for i in ungrouped(wrapper.items)}
    by_sign |= {broad(sign): i for sign, i in by_sign.items()}
    for ours, theirs in pairs:
        if theirs is None:
            continue
        for inner in [theirs] if ours is not None else ungrouped([theirs]):
            place = ours or by_sign.get(inner.sign) or by_sign.get(broad(inner.sign))
            if place is None:
                apart.append((wrapper.rank, inner))
            else:
                matched(place, inner, ranks, apart)


def ranks_of(wrapper: Item, page: Item) -> dict[int, int]:
    """The rank of every block; those without a place get the page's own rank, within the block around."""
    ranks: dict[int, int] = {}
    apart: list[tuple[int, Item]] = []
    matched(wrapper, page, ranks, apart)

    def alone(item: Item, around: int) -> None:
        rank = OUTSIDE if OUTSIDE in (item.rank, around) else max(item.rank, around)
        ranks.update(dict.fromkeys(item.numbers, rank))
        for inner in item.items:
            alone(inner, around)

    if apart:
        ranked(page)
    for around, item in apart:
        alone(item, around)
    return ranks


def read_through(wrapper: Item, source: str) -> str:
    """The blocks of the surest rank that the page has text of, in page order."""
    page = Page(source)
    ranks = ranks_of(wrapper, of_page(page))
    best = max(ranks.values(), default=OUTSIDE)
    if best == OUTSIDE:
        return ""
    return "\n".join(text for i, (text, _links) in enumerate(page.blocks) if ranks[i] == best)


WRAPPER = "host string, wrapper string"


def _batch(held: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.string())], ["host", "wrapper"]
    )


def _learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host and task, or more where a task meets many hosts."""
    held: dict[str, Item] = {}
    for batch in batches:
        for i, host in enumerate(batch.column(0).to_pylist()):
            made = of_page(Page(batch.column(1)[i].as_py()), numbered=False)
            if host in held:
                merge(held[host], made)
            else:
                held[host] = made
            if len(held) == HOSTS_HELD:
                yield _batch({h: dumps(w) for h, w in held.items()})
                held = {}
    if held:
        yield _batch({h: dumps(w) for h, w in held.items()})


def _together(finished: bool):
    """Merges the wrappers of a host, which come one after the other; at the end they are ranked."""

    def done(host: str, wrapper: Item) -> pa.RecordBatch:
        return _batch({host: dumps(ranked(wrapper), whole=False) if finished else dumps(wrapper)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, whole = None, None
        for batch in batches:
            for i, name in enumerate(batch.column(0).to_pylist()):
                wrapper = loads(batch.column(1)[i].as_py())
                if whole is not None and name == host:
                    merge(whole, wrapper)
                    continue
                if whole is not None:
                    yield done(host, whole)
                host, whole = name, wrapper
        if whole is not None:
            yield done(host, whole)

    return run


def infer_wrappers(pages: DataFrame, host: Column, source: Column) -> DataFrame:
    """(host, wrapper) of every host, written once to the shared folder.

    Tasks align the pages they read; partial wrappers meet in GROUPS groups a host and then once, so
    a host of any size sends few rows to one task.
    """
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partial = pages.select(host.alias("host"), source.alias("source")).mapInArrow(_learn, WRAPPER)
    salted = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    dealt = salted.repartition(tasks, "host", "salt").sortWithinPartitions("host", "wrapper")
    fewer = dealt.select("host", "wrapper").mapInArrow(_together(False), WRAPPER)
    dealt = fewer.repartition(tasks, "host").sortWithinPartitions("host", "wrapper")
    return cut_lineage(dealt.mapInArrow(_together(True), WRAPPER))


def extract_text(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Adds text and n_chars (code points) of each page's article; replaces columns of those names.

    Blocks are trimmed, have single blanks for white space and decoded references, and come one a
    line. A null html is empty and gives an empty text; a null url, or one without a host, counts
    as the host ''. A page that is its host's only one is read through its own wrapper. Repeated rows
    are read alike and change no text place. Elements nested deeper than DEPTH count as part of the one
    around them. Nothing is dropped or cut by length.
    """
    host, wrapper, text = (extra_name(pages, n) for n in ("_host", "_wrapper", "_text"))
    named = pages.withColumn(host, host_of(F.col(url)))
    known = infer_wrappers(named, F.col(host), whole_text(source))
    known = known.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper))
    size = known.agg(F.sum(F.octet_length(wrapper) + F.octet_length(host))).first()[0] or 0

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        parsed: dict[str, Item] = {}
        for sources, wrappers in batches:
            texts = []
            for page, own in zip(sources, wrappers):
                if own not in parsed:
                    if len(parsed) >= HOSTS_HELD:
                        parsed.clear()
                    parsed[own] = loads(own, whole=False)
                texts.append(read_through(parsed[own], page))
            yield pd.Series(texts, dtype=object)

    if size <= BROADCAST_BYTES:
        found = named.join(F.broadcast(known), host)
    else:
        found = lookup(named, known, [host], how="inner")
    found = found.withColumn(text, read(whole_text(source), F.col(wrapper)))
    found = found.withColumns({"text": F.col(text), "n_chars": F.char_length(text).cast("long")})
    return found.drop(host, wrapper, text)


@query("op11_html_text")
def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
