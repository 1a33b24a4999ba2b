"""Main text of pages by consensus of the paths that pages of a host use for it.

Each page scores its own containers by the running text they hold. The best one
is the page's vote, as a path of tags and classes with numbers generalised.
Spark counts the votes of a host, and every page is then read again: its text is
what stands below the path with most votes among those it has. A page's own vote
is one of these, and all paths start at a root of every page's own, also of one
without a body tag; so every page with running text has such a path.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import materialised

#: The implicit element around a whole page.
ROOT = "page"
#: Elements whose content is never running text, up to their end tag whatever stands inside.
RAW = "script|style|title|textarea|iframe|noembed|noframes"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?]?[a-zA-Z!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
CONTAINERS = frozenset("html body main article section div td th table ul ol dl blockquote figure details center".split())
#: Elements that are dropped with all they hold.
DROPPED = frozenset(
    "head nav header footer aside form noscript template svg math button select dialog menu object audio video canvas map".split()
)
#: Elements that end a block of text where they begin and where they end.
BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li pre tr caption thead tbody tfoot dt dd figcaption hr address hgroup summary legend fieldset".split()
)
IN_HEAD = frozenset("meta link base script style title noscript template head html".split())
#: Whole tokens of a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar rail menu nav "
    "navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments commentlist reply replies "
    "respond disqus widget contentinfo complementary search comments-area comment-list comment-respond site-header site-footer "
    "page-header page-footer main-nav site-nav side-bar cookie-banner cookie-notice related-posts share-buttons".split()
)
#: Marks of what may hold articles that are not the page's own.
OTHERS = frozenset("comment comments commentlist comments-area comment-list reply replies respond disqus related related-posts recommended".split())
#: The page's frame and its declared article are never dropped for a class of their own.
FRAME = frozenset("html body main article".split())
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Page:
    """Blocks of a page as (path of the container, text, characters outside links)."""

    blocks: list[tuple[str, str, int]] = field(default_factory=list)

    def votes(self) -> str | None:
        """The path of the container with most running text; the enclosing article, else main, where there is one.

        A block counts fully for its container and half for the one around it.
        Equal scores go to the path that comes first on the page.
        """
        scores: dict[str, float] = {}
        for path, _, own in self.blocks:
            if own:
                scores[path] = scores.get(path, 0.0) + own
                above = path.rpartition("/")[0]
                if above:
                    scores[above] = scores.get(above, 0.0) + own / 2
        if not scores:
            return None
        best = max(scores, key=scores.__getitem__)
        steps = best.split("/")
        for tag in ("article", "main"):
            for at in range(len(steps) - 1, -1, -1):
                if steps[at].split(".")[0] == tag:
                    return "/".join(steps[: at + 1])
        return best

    def paths(self) -> list[str]:
        """The paths of all containers that hold a block, sorted."""
        found = set()
        for own, _, _ in self.blocks:
            while own and own not in found:
                found.add(own)
                own = own.rpartition("/")[0]
        return sorted(found)

    def below(self, path: str) -> list[str]:
        return [text for own, text, _ in self.blocks if own == path or own.startswith(f"{path}/")]


def parse(page: str) -> Page:
    """Blocks outside all that is dropped. Broken markup is read as far as it goes.

    A form or an element with a mark keeps the article or main that it encloses
    where the page declares no other; a form also keeps its text where it holds
    more running text than stands outside of it, and elements with a mark keep
    theirs where they hold over three quarters of the page's running text.
    """
    found = Page()
    #: As many states as blocks: what drops each of them.
    states: list[int] = []
    # (tag, path, dropped) of the open containers
    stack: list[tuple[str, str, int]] = [("", ROOT, KEPT)]
    parts: list[str] = []
    linked: list[str] = []
    in_link = False
    at = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                away = len(" ".join(html.unescape("".join(linked)).split())) if linked else 0
                found.blocks.append((stack[-1][1], text, max(0, len(text) - away)))
                states.append(stack[-1][2])
        parts, linked = [], []

    for token in TOKEN.finditer(page):
        if token.start() > at and stack[-1][2] != DROP:
            text = page[at : token.start()]
            parts.append(text)
            if in_link:
                linked.append(text)
        at = token.end()
        name = token[3]
        if name is None:
            continue
        tag = name.lower()
        if token[2]:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS:
                flush()
            elif tag in CONTAINERS or tag in DROPPED:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        in_link = False
                        break
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            flush()
            stack.pop()
        if tag == "a":
            in_link = True
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
        elif tag in CONTAINERS or tag in DROPPED:
            flush()
            if tag in ("html", "body") and any(s[0] == tag for s in stack):
                continue
            label, dropped = _label(tag, token[4])
            _, path, above = stack[-1]
            if tag in ("article", "main") and above in (IN_FORM, IN_MARK):
                above = DECLARED
            stack.append((tag, f"{path}/{label}", _below(above, dropped)))
    if at < len(page) and stack[-1][2] != DROP:
        parts.append(page[at:])
    flush()
    found.blocks = _kept(found.blocks, states)
    return found


#: What drops a block: nothing; only what encloses the declared article it is in; forms; a mark; a mark of others' texts; an element of DROPPED.
KEPT, DECLARED, IN_FORM, IN_MARK, IN_OTHERS, DROP = range(6)


def _below(above: int, own: int) -> int:
    """The state inside an element with the state ``own`` that stands in one with the state ``above``."""
    if above == DECLARED and own != KEPT:
        return DROP
    return max(above, own)


def _kept(blocks: list[tuple[str, str, int]], states: list[int]) -> list[tuple[str, str, int]]:
    def declares(state: int) -> bool:
        return any(
            s == state and b[2] and not {"article", "main"}.isdisjoint(step.split(".")[0] for step in b[0].split("/"))
            for b, s in zip(blocks, states, strict=True)
        )

    taken = {KEPT}
    if not declares(KEPT):
        if declares(DECLARED):
            taken.add(DECLARED)
        else:
            kept, form, mark, others = (
                sum(b[2] for b, s in zip(blocks, states, strict=True) if s == state) for state in (KEPT, IN_FORM, IN_MARK, IN_OTHERS)
            )
            if form > kept:
                taken.add(IN_FORM)
            if mark > 3 * (kept + form + others):
                taken.add(IN_MARK)
    return [b for b, s in zip(blocks, states, strict=True) if s in taken]


def _label(tag: str, attributes: str) -> tuple[str, int]:
    """(generalised tag and classes, what the element drops its content for)."""
    marked = (IN_FORM if tag == "form" else DROP) if tag in DROPPED else KEPT
    if not attributes.strip():
        return tag, marked
    classes = []
    for name, *values in ATTRIBUTE.findall(attributes):
        value = html.unescape("".join(values)).lower()
        if name.lower() == "class":
            classes += [re.sub(r"\d+", "#", c.replace("/", "")) for c in value.split()]
        if tag not in FRAME and marked != DROP:
            tokens = {t.rstrip("0123456789-_").replace("_", "-") for t in value.split()}
            if not OTHERS.isdisjoint(tokens):
                marked = IN_OTHERS
            elif marked < IN_MARK and tag != "form" and not MARKS.isdisjoint(tokens):
                marked = IN_MARK
    return ".".join([tag, *sorted(set(classes))]), marked


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def shape_of(page: Column) -> Column:
    """struct(code, vote, paths): a hash of the paths of each page, the path it votes for (null without text), and the paths."""

    @F.pandas_udf("code long, vote string, paths array<string>")
    def shaped(pages: pd.Series) -> pd.DataFrame:
        read = [parse(p) if p else Page() for p in pages]
        paths = [p.paths() for p in read]
        return pd.DataFrame({"code": [_code(p) for p in paths], "vote": [p.votes() for p in read], "paths": paths})

    return shaped(page)


def blocks_of(page: Column) -> Column:
    """struct(code, blocks) with the blocks of each page as (path, text)."""

    @F.pandas_udf("code long, blocks array<struct<path: string, text: string>>")
    def read(pages: pd.Series) -> pd.DataFrame:
        found = [parse(p) if p else Page() for p in pages]
        blocks = [[{"path": path, "text": text} for path, text, _ in p.blocks] for p in found]
        return pd.DataFrame({"code": [_code(p.paths()) for p in found], "blocks": blocks})

    return read(page)


def _code(paths: list[str]) -> int:
    from xxhash import xxh64_intdigest

    code = xxh64_intdigest("\n".join(paths).encode("utf-8", "surrogatepass"))
    return code - (1 << 64) if code >> 63 else code


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, code, path): for pages of a host with equal paths, the one of these with most votes of the host.

    Equal votes go by the path's text. Every path that any page voted for counts;
    votes are added up before the shuffle and joined by host and path, so a hot host is split.
    """
    read = pages.select(host_of(F.col("url")).alias("host"), shape_of(F.col("html")).alias("_shape")).select("host", "_shape.*")
    shapes = materialised(
        read.groupBy("host", "code", "vote").agg(F.min("paths").alias("paths"), F.count("*").alias("n")), "shapes"
    )
    votes = shapes.where("vote IS NOT NULL").groupBy("host", F.col("vote").alias("path")).agg(F.sum("n").alias("n"))
    own = shapes.select("host", "code", F.explode("paths").alias("path")).distinct()
    best = F.min(F.struct((-F.col("n")).alias("k"), "path"))
    return own.join(votes, ["host", "path"]).groupBy("host", "code").agg(best.alias("best")).select("host", "code", "best.path")


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Null, empty and text-less pages have an empty text. Pages without a host
    vote together. White space inside a block is one space, blocks are joined by
    two line feeds. Reads page_id, url and html only, html twice.
    """
    # Written, so that Spark sees its size: a small table goes to the pages, and a hot host can be split.
    paths = materialised(host_paths(pages), "paths")
    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), blocks_of(F.col("html")).alias("_read")).select(
        "page_id", "url", "host", "_read.*"
    )
    below = F.filter(
        "blocks", lambda b: (b["path"] == F.col("path")) | b["path"].startswith(F.concat(F.col("path"), F.lit("/")))
    )
    text = F.coalesce(F.array_join(F.transform(below, lambda b: b["text"]), "\n\n"), F.lit(""))
    return read.join(paths, ["host", "code"], "left").select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
