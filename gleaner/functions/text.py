"""Text expressions, all JVM-side.

Whitespace is Unicode whitespace plus the four ASCII separators 0x1C-0x1F.
Java evaluates the ``(?U)`` form about seven times faster than an explicit
negated class, so that form is used throughout.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from ..params import SUMMARY_CHARS, WORDS_PER_MINUTE
from .expr import let

WORD = r"(?U)[^\s\x1c-\x1f]+"
_EDGES = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
_BREAK = "\x01"

_MARKUP = (
    r"(?is)<!--.*?-->"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"|</?[a-z][^>]*>"
    r"|<[!?][^>]*>"
)
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_BOILERPLATE = "noscript|nav|footer|aside|header|form"
#: An element without another one of its kind inside; possessive, so a long one needs no deep stack.
_INNERMOST = rf"(?is)<({_BOILERPLATE})\b[^>]*+>[^<]*+(?:<(?!/?(?:{_BOILERPLATE})\b)[^<]*+)*+</\1\s*+>"
_DROPPED = rf"(?is)<({_BOILERPLATE})\b[^>]*>.*?</\1\s*>"
#: The one group of an attribute's value, in double quotes, single quotes or none.
VALUE = r"\s*=\s*[\"']?((?<=\")[^\"]*|(?<=')[^']*|(?<![\"'])[^\s\"'>]+)"
_REGIONS = ("article", "main", "body")
_BLOCK_TAG = (
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure"
    r"|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th"
    r"|thead|tr|ul)\b[^>]*>"
)
# Runs of Unicode whitespace other than line breaks; a lone space does not match,
# so ordinary text is scanned without a replacement per word.
_RARE_SPACE = r"\t\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = rf"[{_RARE_SPACE}][ {_RARE_SPACE}]*| [ {_RARE_SPACE}]+"
_ANY_TAG = r"</?[A-Za-z][^>]*>|<[!?][^>]*>"
_ENTITY = r"\A(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0))), F.lit(0))


def summary(c: Column, limit: int = SUMMARY_CHARS) -> Column:
    """The text, or its first ``limit`` characters cut at the last space plus ``...``."""
    head = F.regexp_replace(F.substring(c, 1, limit), r" [^ ]*\z", "")
    return F.when(F.length(c) > limit, F.concat(head, F.lit("..."))).otherwise(c)


def reading_minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(words / WORDS_PER_MINUTE).cast("int"))


def _named_entities() -> Column:
    """Map literal of the HTML entity names; one folded expression, not a call per name."""
    named = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'"}
    listed = "\x02".join(f"{name}\x01{char}" for name, char in named.items())
    return F.str_to_map(F.lit(listed), F.lit("\x02"), F.lit("\x01"))


def _numeric_entity(name: Column) -> Column:
    hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
    code = F.when(hexadecimal, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(
        F.substring(name, 2, 7)
    ).cast("int")
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def unescape(c: Column) -> Column:
    """Decode named and numeric character references in one left-to-right pass."""
    names = _named_entities()

    def decode(piece: Column) -> Column:
        def replaced(name: Column) -> Column:
            char = F.when(F.startswith(name, F.lit("#")), _numeric_entity(name)).when(
                name != "", names[name]
            )
            rest = F.substr(piece, F.length(name) + 2)
            return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

        return let(F.regexp_extract(piece, _ENTITY, 1), replaced)

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode)
        return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))

    def guarded(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), joined)).otherwise(t)

    return let(c, guarded)


def fragment_text(html: Column) -> Column:
    """Text nodes of an HTML fragment, stripped, empty ones dropped, one per line.

    Markup becomes a control character first, so line breaks inside a node stay.
    """
    nodes = F.split(unescape(F.regexp_replace(html, _MARKUP, _BREAK)), _BREAK)
    return joined_lines(F.transform(nodes, strip))


def joined_lines(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda t: t != ""), "\n")


def shown_markup(html: Column) -> Column:
    """Markup without comments, scripts, styles and templates."""
    return F.regexp_replace(html, _HIDDEN, "")


def _inside_or(html: Column, tag: str, fallback: Column) -> Column:
    inside = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*)</{tag}\b", 1)
    return let(inside, lambda t: F.when(t != "", t).otherwise(fallback))


def _region(html: Column) -> Column:
    """Inside of the articles, else main, else body element, else everything."""
    chosen = html
    for tag in reversed(_REGIONS):
        chosen = _inside_or(html, tag, chosen)
    return let(chosen, _inside_articles)


def _inside_articles(region: Column) -> Column:
    """Without what stands between one article and the next.

    ``region`` begins inside an article where it holds further article tags. It is
    cut at these, and each piece is kept or not by the number of articles that are open there.
    """
    tags = r"(?i)<(/?)article\b[^>]*>"

    def kept(pieces: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            closes = F.startswith(piece, F.lit("/"))
            # the piece behind a tag begins with a slash where the tag closed an article
            depth = state["depth"] + F.when(closes, -1).otherwise(1)
            body = F.substr(piece, F.lit(2))
            shown = F.when(depth > 0, F.concat(F.lit("\n"), body)).otherwise(F.lit(""))
            return F.struct(depth.alias("depth"), F.concat(state["parts"], F.array(shown)).alias("parts"))

        first = F.struct(F.lit(1).alias("depth"), F.array(F.element_at(pieces, 1)).alias("parts"))
        done = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), first, step)
        return F.array_join(done["parts"], "")

    marked = F.regexp_replace(F.regexp_replace(region, tags, f"{_BREAK}$1 "), f"{_BREAK}/ ", f"{_BREAK}/")
    several = region.rlike(r"(?is)</article\b[^>]*>.*<article\b")
    return F.when(several, let(marked, lambda m: kept(F.split(m, _BREAK)))).otherwise(region)


def _without_boilerplate(region: Column) -> Column:
    """Without navigation, asides, headers, footers and forms, also where these stand inside each other.

    Innermost elements go first, as often as elements begin; what is left unclosed
    or crossed then goes up to the next end tag.
    """

    def drop(text: Column, _: Column) -> Column:
        return F.when(text.rlike(_INNERMOST), F.regexp_replace(text, _INNERMOST, "")).otherwise(text)

    begun = F.regexp_count(region, F.lit(rf"(?i)<(?:{_BOILERPLATE})\b"))
    rounds = F.when(begun > 0, F.sequence(F.lit(1), begun)).otherwise(F.array().cast("array<int>"))
    return F.regexp_replace(F.aggregate(rounds, region, drop), _DROPPED, "")


def main_text(html: Column) -> Column:
    """Readable text of a page.

    Comments, scripts and styles go first; then the article, else main, else body
    region is taken and loses its boilerplate elements, so a form around the
    article drops nothing. Block tags become line breaks, and blank lines and
    repeated spaces collapse.
    """
    region = let(let(shown_markup(html), _region), _without_boilerplate)
    lines = F.regexp_replace(F.regexp_replace(region, _BLOCK_TAG, "\n"), _ANY_TAG, "")
    spaced = F.regexp_replace(unescape(lines), _SPACES, " ")
    return joined_lines(F.transform(F.split(spaced, "\n"), lambda t: F.trim(t)))


def page_title(html: Column) -> Column:
    """``og:title``, else the first heading, else the document title; null when absent."""

    def clean(c: Column) -> Column:
        tagless = F.regexp_replace(c, _ANY_TAG, "")
        text = strip(F.regexp_replace(unescape(tagless), r"(?U)[\s\x1c-\x1f]+", " "))
        return let(text, lambda t: F.when(t != "", t))

    def first(shown: Column) -> Column:
        og = meta_content(shown, "property", "og:title")
        heading = F.regexp_extract(shown, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)
        title = F.regexp_extract(shown, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
        return F.coalesce(clean(og), clean(heading), clean(title))

    return let(shown_markup(html), first)


def page_author(html: Column) -> Column:
    """Author named in a meta tag, '' when there is none."""
    return strip(unescape(meta_content(html, "name", "author")))


def meta_content(html: Column, attribute: str, value: str) -> Column:
    """``content`` of the first meta tag with the given attribute; '' when absent."""
    tag = F.regexp_extract(
        html,
        rf"(?is)<meta\b(?=[^>]*\s{attribute}\s*=\s*[\"']?{value.replace('.', '[.]')}[\"'\s/>])[^>]*>",
        0,
    )
    return F.regexp_extract(tag, rf"(?is)\scontent{VALUE}", 1)
