"""Mending of feed text, so that a strict XML parser reads what feeds in the wild contain.

Every function is one left-to-right pass of built-in expressions over its text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import text
from .expr import let

#: The entities that XML knows without a declaration.
XML_ENTITIES = ("amp", "lt", "gt", "quot", "apos")
_REFERENCE = r"\A(#[0-9]{1,7}|#x[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
#: Characters that no XML document may hold.
_FORBIDDEN = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]"
_UNKNOWN = rf"&(?!(?:{'|'.join(XML_ENTITIES)});)|{_FORBIDDEN}"
_COMMENT = r"(?s)<!--.*?-->"
#: Elements whose content is text for a reader, whatever markup it holds.
_CARRIERS = "content:encoded|content|summary|description|title"
_OPENS = rf"(<(?:{_CARRIERS})(?:\s[^>]*)?(?<!/)>)"
_CLOSES = rf"(</(?:{_CARRIERS})\s*>)"
_BEGIN, _END = "\x01", "\x02"


def escaped(c: Column) -> Column:
    """Text in which no character is markup."""
    ampersands = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(ampersands, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _pieces(c: Column, mark: str, of_tail) -> Column:
    """The text with ``of_tail`` applied to each piece that follows a mark; texts without the mark are left alone."""

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), of_tail)
        return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))

    return F.when(F.contains(c, F.lit(mark)), let(F.split(c, mark.replace("[", r"\[")), joined)).otherwise(c)


def _upto(piece: Column, end: str, of_head) -> Column:
    """``of_head`` of what stands before the first ``end``, and the rest behind it; all of it where there is none."""

    def split(at: Column) -> Column:
        head = F.when(at > 0, F.substr(piece, F.lit(1), at - 1)).otherwise(piece)
        rest = F.when(at > 0, F.substr(piece, at + len(end))).otherwise(F.lit(""))
        return F.concat(of_head(head), rest)

    return let(F.instr(piece, end), split)


def sections_as_text(c: Column) -> Column:
    """Character data sections as escaped text."""
    return _pieces(c, "<![CDATA[", lambda piece: _upto(piece, "]]>", escaped))


def plain_sections(c: Column) -> Column:
    """Character data sections as escaped text, then no comments: what is left of ``<`` is markup."""
    return let(sections_as_text(c), lambda t: F.when(F.contains(t, F.lit("<!--")), F.regexp_replace(t, _COMMENT, "")).otherwise(t))


def known_references(c: Column) -> Column:
    """Names of HTML as their characters, and an ampersand that begins no reference as ``&amp;``.

    Characters that XML forbids go, also where a number names them.
    """
    names = text._named_entities()

    def mended(piece: Column) -> Column:
        def of_name(name: Column) -> Column:
            rest = F.substr(piece, F.length(name) + 2)
            number = F.when(F.startswith(name, F.lit("#")), text._numeric_entity(name))
            allowed = number.isNotNull() & ~number.rlike(_FORBIDDEN)
            return (
                F.when(allowed | name.isin(*XML_ENTITIES), F.concat(F.lit("&"), piece))
                .when(F.startswith(name, F.lit("#")), rest)
                .when(F.coalesce(names[name], F.lit("")) != "", F.concat(names[name], rest))
                .otherwise(F.concat(F.lit("&amp;"), piece))
            )

        return let(F.regexp_extract(piece, _REFERENCE, 1), of_name)

    # most texts hold nothing but what XML knows, and are only looked through
    return F.when(c.rlike(_UNKNOWN), F.regexp_replace(_pieces(c, "&", mended), _FORBIDDEN, "")).otherwise(c)


def carried_markup(entry: Column) -> Column:
    """Elements inside a title, summary or content as escaped text, so that they reach the reader as markup."""

    def carried(piece: Column) -> Column:
        def of_inner(inner: Column) -> Column:
            return F.when(inner.rlike(r"<[A-Za-z/!?]"), escaped(inner)).otherwise(inner)

        return _upto(piece, _END, of_inner)

    marked = F.regexp_replace(F.regexp_replace(entry, _OPENS, f"$1{_BEGIN}"), _CLOSES, f"{_END}$1")
    plain = F.replace(let(marked, lambda t: _pieces(t, _BEGIN, carried)), F.lit(_END), F.lit(""))
    return F.when(entry.rlike(rf"{_OPENS}[^<]*<(?!/(?:{_CARRIERS})\s*>)"), plain).otherwise(entry)


def unprefixed(entry: Column) -> Column:
    """An entry whose own tag has a namespace prefix, without that prefix on any tag."""

    def stripped(prefix: Column) -> Column:
        opened = F.replace(entry, F.concat(F.lit("<"), prefix, F.lit(":")), F.lit("<"))
        closed = F.replace(opened, F.concat(F.lit("</"), prefix, F.lit(":")), F.lit("</"))
        return F.when(prefix != "", closed).otherwise(entry)

    return let(F.regexp_extract(entry, r"\A<(\w+):(?:item|entry)\b", 1), stripped)
