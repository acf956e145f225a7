"""Main text of web pages by consensus of their host.

1. Each page is parsed once into blocks (text between block tags) with the tag-class path of the container that holds them; digits in
   classes are generalised, so templates match over pages. Menus, headers, footers, sidebars, notices, adverts, forms, comments and the like are marked by tag and by words in class or id.
   A part marked by words that holds most of the page's text (a quarter, where only a part of a class name is such a word) is not left out, unless it is made of comments or the page has an article (or main) with text that is not marked.
2. A page's containers are scored: a block's characters outside links count for its container, half for the next one up; an article (else main)
   counts as one container with all below it. From the best one the page climbs to the outermost container around it that has a heading or a good part of such text of its own, and
   votes for it; votes are added by host and path (partial aggregates, so a large host costs no more) and the host's winner is the path with most votes.
3. Pages are extracted again along their host's winning path. A page uses its own best path where the host's is absent, or holds under a third of what the own one holds
   and the own one is not a container that most pages of the host have beside their article.

Blocks keep page order; in a block, character references are decoded and white space is one space; blocks are joined by an empty line.

Defined results: null or empty html gives an empty text; a page without a host votes for the host ''; a page where nothing is
left gives an empty text; repeated rows are extracted row by row; broken markup never fails (unclosed tags end with their parent).
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, staged, table

_ATTRIBUTES = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
#: Comments; declarations; elements whose content is no text; tags; tags with a quote that does not close (to the next angle bracket); text. No part is read again at each tag.
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<[!?][^<>]*>?|<(script|style|textarea|noscript|template|iframe|svg|title|select|object|canvas)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"""
    rf"""|<(/?)([a-zA-Z][\w:-]*)(?:({_ATTRIBUTES})>|[^<>]*(?:>|(?=<)))|([^<]+|<)""",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_CONTAINERS = frozenset("article main section div td body html center".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr th caption figure figcaption address hr details summary nav header footer aside form fieldset menu dialog head".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
_AWAY = frozenset("nav header footer aside form menu dialog head button label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
_AWAY_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent notice notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations "
    "comment comments reply replies respond disqus discussion pagination pager toolbar skip hidden disclaimer copyright".split()
)
_WORDS = re.compile(r"[a-z]+")
#: Elements nested deeper belong to the container at this depth.
DEEPEST = 256
#: Besides marking words, a class name of these only tells of a part's place or form.
_PLAIN = frozenset("list area section box bar wrap wrapper container block form links link item items posts articles top bottom left right main site page global primary secondary inner outer content group panel".split())
_COMMENTS = frozenset("comment comments reply replies respond disqus discussion".split())
#: A part that is marked by words holds the article after all if it holds so much of the page's text outside links: where a whole class name marks it, and where one word of a longer name does.
_SHARE, _WEAK_SHARE = 0.6, 0.25
#: Elements that hold the article are not marked by words, and classes that tell of a state name no part of the page.
_KEPT = frozenset("html body main article".split())
_STATE = re.compile(r"(?<!\S)(?:(?:has|no|not|with|without|is)[-_]\S+|\S+[-_](?:enabled|disabled))(?!\S)", re.I)
_DIGITS = re.compile(r"\d+")
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


Block = tuple[tuple[str, ...], str, int, bool]


def _strength(names: str) -> int:
    """How words in a class or id mark a part: 0 not, 1 as one word of a longer name, 2 as a whole name, 3 as comments."""
    out = 0
    for name in _STATE.sub(" ", names).split():
        found = _WORDS.findall(_CAMEL.sub(" ", name).lower())
        if not _AWAY_WORDS.isdisjoint(found):
            whole = all(w in _AWAY_WORDS or w in _PLAIN for w in found)
            out = max(out, (3 if not _COMMENTS.isdisjoint(found) else 2) if whole else 1)
    return out


def parse(source: str) -> list[Block]:
    """The blocks that are not marked away; where words in class or id would leave none, only tags and roles mark."""
    blocks, marks, strengths = _parse(source)
    if not strengths:
        return blocks
    article = any(not own and len(_unit(b[0])) < len(b[0]) + (_tag((b[0] or ("",))[-1]) in ("article", "main")) for b, own in zip(blocks, marks, strict=True))
    weight: dict[int, int] = defaultdict(int)
    total = 0
    for block, own in zip(blocks, marks, strict=True):
        size = max(0, len(block[1]) - block[2])
        total += size
        for m in own:
            weight[m] += size
    limit = (0.0, 1.1, 1.1, 1.1) if article else (0.0, _WEAK_SHARE, _SHARE, 1.1)
    away = {m for m, strength in enumerate(strengths) if weight[m] <= limit[strength] * total}
    return [b for b, own in zip(blocks, marks, strict=True) if away.isdisjoint(own)] or blocks


def _parse(source: str) -> tuple[list[Block], list[tuple[int, ...]], list[int]]:
    """(paths of the containers around it, the outermost first; text; characters in links; whether it is a heading) of the blocks that tags and roles do not
    mark away, the numbers of the parts around each that words mark, and how these are marked."""
    out: list[Block] = []
    marks: list[tuple[int, ...]] = []
    strengths: list[int] = []
    # (tag, path, away, paths of the containers, parts that words mark)
    stack: list[tuple[str, str, bool, tuple[str, ...], tuple[int, ...]]] = [("", "", False, (), ())]
    text: list[str] = []
    links, in_link = 0, 0

    opened: Counter = Counter()  # tags in the stack

    def cut(i: int) -> None:
        for x in stack[i:]:
            opened[x[0]] -= 1
        del stack[i:]

    def close(tag: str) -> None:
        if opened[tag]:
            cut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))

    def flush() -> None:
        nonlocal links
        if text:
            if not stack[-1][2]:
                whole = " ".join(html.unescape("".join(text)).split())
                if whole:
                    out.append((stack[-1][3], whole, links, stack[-1][0] in _HEADINGS))
                    marks.append(stack[-1][4])
            text.clear()
        links = 0

    for m in _TOKEN.finditer(source):
        _, closing, tag, attributes, words = m.groups()
        if words is not None:
            text.append(words)
            if in_link:
                links += len(words)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            text.append(" ")
        if tag not in _BLOCKS:
            if tag == "button" or tag == "label":
                flush()
                if closing:
                    close(tag)
                else:
                    top = stack[-1]
                    stack.append((tag, top[1], True, *top[3:]))
                    opened[tag] += 1
            continue
        flush()
        if closing:
            close(tag)
            continue
        in_link = 0
        if tag in _VOID:
            continue
        if stack[-1][0] == "p":
            cut(-1)
        closes = _CLOSES.get(tag)
        while closes and stack[-1][0] in closes:
            cut(-1)
        top = stack[-1]
        away, classes, marked = top[2] or tag in _AWAY, "", 0
        if attributes and not away:
            for name, *values in _NAMED.findall(attributes):
                value = next((v for v in values if v), "")
                if name.lower() == "class":
                    classes = ".".join(sorted(_DIGITS.sub("#", value).split()))
                if name.lower() == "role":
                    away = away or value.lower() in _ROLES
                elif tag not in _KEPT:
                    marked = max(marked, _strength(value))
        path, around, own = top[1], top[3], top[4]
        if len(stack) <= DEEPEST:
            path = f"{path}>{tag}{'.' if classes else ''}{classes}"
            around = (*around, path) if tag in _CONTAINERS else around
            if marked and not away:
                own = (*own, len(strengths))
                strengths.append(marked)
        stack.append((tag, path, away, around, own))
        opened[tag] += 1
    flush()
    return out, marks, strengths


def _tag(path: str) -> str:
    return path.rpartition(">")[2].partition(".")[0]


def _unit(chain: tuple[str, ...]) -> tuple[str, ...]:
    """The containers down to the outermost article, else to the outermost main, else all."""
    tags = [_tag(p) for p in chain]
    return next((chain[: tags.index(t) + 1] for t in ("article", "main") if t in tags), chain)


def _weights(blocks: list[Block]) -> dict[str, int]:
    """Characters outside links in and below each container."""
    out: dict[str, int] = defaultdict(int)
    for chain, text, links, _ in blocks:
        for p in {"", *chain}:
            out[p] += max(0, len(text) - links)
    return out


def best_path(blocks: list[Block]) -> tuple[str, float]:
    """The container with the highest score, of equal ones the first in the page, or the outermost one around it with text of its own."""
    score: dict[str, float] = defaultdict(float)
    own: dict[str, int] = defaultdict(int)
    chains: dict[str, tuple[str, ...]] = {}
    headed: set[str] = set()
    for chain, text, links, heading in blocks:
        unit, weight = _unit(chain), max(0, len(text) - links)
        for part, share in ((unit, 1.0), (unit[:-1], 0.5)):
            path = part[-1] if part else ""
            chains.setdefault(path, part)
            score[path] += weight * share
        if chain:
            own[chain[-1]] += weight
            if heading and weight:
                headed.add(chain[-1])
    path, best = max(score.items(), key=lambda x: x[1], default=("", 0.0))
    whole = _weights(blocks)[path]
    for p in chains.get(path, ())[:-1]:
        page = _tag(p) in ("html", "body")
        if (p in headed and not page) or own[p] >= whole * (0.3 if page else 0.1) > 0:
            return p, best
    return path, best


def along(blocks: list[Block], path: str | None, beside: frozenset[str] = frozenset()) -> str:
    """The blocks in and below the path's containers; those of the page's own best path where there are none, or few and the own path is not one of `beside`."""
    pick = [b for b in blocks if path and path in b[0]]
    own = best_path(blocks)[0] if blocks else ""
    weights = _weights(blocks)
    if not pick or (own != path and own not in beside and 3 * weights[path] < weights[own]):
        pick = [b for b in blocks if not own or own in b[0]]
    return "\n\n".join(b[1] for b in pick)


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", broadcast_hosts: int = 200_000) -> DataFrame:
    """The rows of pages, without the html, with text added (a column of that name is replaced)."""
    host = F.coalesce(F.regexp_extract(F.lower(F.col(url_col).cast("string")), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit(""))
    source = pages.select(host.alias("host"), F.col(html_col).cast("string").alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html", 4 << 20):
            counts: dict[tuple[str, str], list] = defaultdict(lambda: [0, 0, 0.0])
            for at, h in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                blocks = parse(h or "")
                path, score = best_path(blocks)
                if score > 0:
                    for p, weight in _weights(blocks).items():
                        counts[at, p][1] += weight > 0
                    counts[at, path][0] += 1
                    counts[at, path][2] += score
            columns = [[k[0] for k in counts], [k[1] for k in counts], *([c[i] for c in counts.values()] for i in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["host", "path", "votes", "seen", "score"])

    votes = source.mapInArrow(vote, "host string, path string, votes long, seen long, score double").groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("seen").alias("seen"), F.round(F.sum("score")).alias("score")).where("votes > 0")
    beside = F.collect_list(F.when(F.col("seen") > 2 * F.col("votes"), F.col("path"))).alias("beside")  # only paths that are some page's best
    winners = votes.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("w"), beside)
    winners = staged(winners.select(F.col("host").alias("host_"), F.col("w.path").alias("path_"), F.expr("filter(beside, p -> p != w.path and not startswith(w.path, p || '>'))").alias("beside_")), "host-paths")
    few = (winners.agg(F.sum(F.size("beside_") + 1)).first()[0] or 0) <= broadcast_hosts  # a path is some tens of bytes; else both sides are dealt by host, and large hosts split
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    keep = pages.select(F.struct(*rest).alias("row"), F.col(html_col).cast("string").alias("html"), host.alias("host_"))
    both = keep.join(F.broadcast(winners) if few else winners, "host_", "left").select("row", "html", "path_", "beside_")
    row_type = both.schema["row"].dataType.simpleString()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html", 4 << 20):
            texts = [along(parse(h or ""), p, frozenset(x or ())) for h, p, x in zip(*(part.column(c).to_pylist() for c in ("html", "path_", "beside_")), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return both.mapInArrow(again, f"row {row_type}, text string").select("row.*", "text")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
