"""HTML columns by regular expression: cleaning, hashing, start tags, attributes, entities.

Exact on well-formed markup; broken markup is approximated (see README). All patterns run in the
JVM, over whole texts; quantifiers over quoted values are possessive, so long tags cannot
exhaust the regex stack.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.constants import RENDER_MARK, RENDER_MARK_ANY_CASE

# Every pattern fails on its first character almost everywhere, and runs of plain characters are
# taken in one step: these scans are what a crawl spends its time on.
_TAG_REST = r"""[^"'>]*+(?:(?:"[^"]*+"|'[^']*+')[^"'>]*+)*+>"""
# Comments are matched first and kept, so that a script inside a comment is not taken for one.
_DROPPED = (
    r"(?is)(?=<)(?:(<!--.*?(?:-->|\z))"
    r"|<script(?=[\s/>])[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style(?=[\s/>])[^>]*>.*?(?:</style\s*>|\z)"
    rf"|<meta(?=[\s/>]){_TAG_REST}|</(?:script|style|meta)\s*>)"
)
# White space is only entered at its start, so long blank runs are scanned once.
_ANY_TAG = rf"(?:\s(?<!\s\s)\s*+)?+(<(?:!--(?s:.*?)(?:-->|\z)|/?[A-Za-z!]{_TAG_REST}))\s*+"
# Start tags and comments in one scan: what is inside a comment is never taken for a tag.
_START_TAG = rf"(?s)<(?:!--.*?(?:-->|\z)|[A-Za-z]{_TAG_REST})"
_LINK_TAG = rf"(?is)<(?:!--.*?(?:-->|\z)|(?:a|img)(?=[\s/>]){_TAG_REST})"
_ATTRIBUTE = r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]*+))?"""
# A few old names also count without their semicolon, and then in front of anything: the longest wins.
# Maps are read from their beginning, so names are looked up by their first letter, then whole.
_NAMED = json.dumps({first: {f"&{name}": text for name, text in html5.items() if name[0] == first} for first in sorted({name[0] for name in html5})})
_OPEN_NAMES = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True))
_ENTITY = r"&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]{0,31};?|[^&]+|&"
# Characters that stay entities in canonical text, so that it can be read again.
_ESCAPED = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}
_TO_DECODE = r"&(?!(?:amp|lt|gt|quot);)[#A-Za-z]"
_PIECE = rf"<!--(?s:.*?)(?:-->|\z)|</?[A-Za-z]{_TAG_REST}|[^<]+|<"
_PLAIN_TAG = r"""/?[a-z][a-z0-9:-]*+(?: [a-z][a-z0-9:_-]*+="[^"]*+")*+>"""
_OTHER_TAG = rf"<(?=/?[A-Za-z])(?!{_PLAIN_TAG})"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where the value is written and computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean_html(html: Column) -> Column:
    """Text without script, style and meta elements, one tag or text run per line, in canonical spelling.

    Pages that differ only in removed elements, in white space around or inside tags, in the case of tags and attributes, in
    how values are quoted, or in how a character is written as an entity get equal text. Tags and entities are only
    taken apart in pages that have one in another spelling.
    """
    kept = F.regexp_replace(html, _DROPPED, "$1")
    lines = F.regexp_replace(kept, _ANY_TAG, "\n$1\n")
    laid_out = F.replace(lines, F.lit(">\n\n<"), F.lit(">\n<"))
    text = F.btrim(F.when(html.contains("<"), laid_out).otherwise(html), F.lit("\n"))
    # Looking for one character costs much less than a pattern does.
    text = _bind(text, lambda text: F.when(text.contains("<") & text.rlike(_OTHER_TAG), _spelled(text)).otherwise(text))
    return _bind(text, lambda text: F.when(text.contains("&") & text.rlike(_TO_DECODE), _decoded(text, _ESCAPED)).otherwise(text))


def _spelled(text: Column) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    return F.array_join(F.transform(pieces, lambda piece: F.when(piece.rlike("^</?[A-Za-z]"), _plain_tag(piece)).otherwise(piece)), "")


def _plain_tag(tag: Column) -> Column:
    """A tag in lower case with double quotes, one blank before each attribute and no slash at its end."""
    name = F.lower(F.regexp_extract(tag, r"^</?([^\s/>]+)", 1))
    values = F.array_join(F.transform(attributes(tag), lambda attribute: F.concat(
        F.lit(" "), attribute_name(attribute), F.lit('="'), F.replace(attribute_value(attribute), F.lit('"'), F.lit("&quot;")), F.lit('"')
    )), "")
    return F.when(tag.startswith("</"), F.concat(F.lit("</"), name, F.lit(">"))).otherwise(F.concat(F.lit("<"), name, values, F.lit(">")))


def content_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 text, in hex."""
    return F.sha2(text, 256)


def needs_render(html: Column) -> Column:
    """Whether the page says it has to be run in a browser."""
    return html.contains(RENDER_MARK) | F.lower(html).contains(RENDER_MARK_ANY_CASE)


def link_tags(html: Column) -> Column:
    """Start tags outside comments that can hold a link, as an array in document order: ``a`` and
    ``img``, and any with ``onclick``. Only pages where that word occurs pay for looking at all tags, and text without any tag
    is not searched."""
    every = F.regexp_extract_all(html, F.lit(_START_TAG), F.lit(0))
    links = F.regexp_extract_all(html, F.lit(_LINK_TAG), F.lit(0))
    none = F.array().cast("array<string>")
    tags = F.when(~html.contains("<"), none).when(html.rlike("(?i)onclick"), every).otherwise(links)
    return F.filter(tags, lambda tag: tag.rlike(r"(?is)^<(?:(?:a|img)[\s/>]|[a-z].*onclick)"))


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^<([^\s/>]+)", 1))


def attributes(tag: Column) -> Column:
    """``name=value`` texts of a start tag, as an array; quoted text is never taken for a name."""
    return F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+", ""), F.lit(_ATTRIBUTE), F.lit(0))


def attribute_name(attribute: Column) -> Column:
    return F.lower(F.regexp_extract(attribute, r"^[^\s=]+", 0))


def attribute_value(attribute: Column) -> Column:
    """Value without quotes, entities still as written; '' for a bare name."""
    raw = F.regexp_replace(attribute, r"^[^=]*+(?:=\s*+)?", "")
    return F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1\z""", "$2")


def _windows_1252() -> dict[int, int]:
    """Code points 128 to 159 stand for characters of Windows-1252, where that has one."""
    raw = ((code, bytes([code]).decode("cp1252", "ignore")) for code in range(128, 160))
    return {code: ord(char) for code, char in raw if char}


def _from_code_point(code: Column) -> Column:
    """The character that an HTML parser reads for a number; null is a number beyond any code point."""
    told = F.from_json(F.lit(json.dumps(_windows_1252())), "map<string, bigint>")

    def char(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # Controls and non-characters stand for nothing.
        nothing = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
        nothing = valid & (nothing | (code % 0x10000 >= 0xFFFE))
        return F.when(nothing, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32"))

    return _bind(_bind(code, lambda code: F.coalesce(F.try_element_at(told, code.cast("string")), code)), char)


def _numbered(piece: Column) -> Column:
    """The character of a numeric entity. Numbers of more digits than any code point has are null."""
    def code(digits: Column) -> Column:
        by_hex = F.when(F.length(digits) <= 8, F.conv(digits, 16, 10))
        return F.when(piece.rlike("^&#[xX]"), by_hex).otherwise(F.when(F.length(digits) <= 10, F.conv(digits, 10, 10))).cast("bigint")

    return _from_code_point(_bind(F.regexp_extract(piece, "^&#[xX]?0*([0-9A-Fa-f]*)", 1), code))


def unescape(text: Column) -> Column:
    """Decode numeric entities and the named ones of HTML 5, each exactly once."""
    return _bind(text, lambda text: F.when(text.contains("&"), _decoded(text, {})).otherwise(text))


def _decoded(text: Column, escaped: dict[str, str]) -> Column:
    """``text`` with its entities decoded; ``escaped`` says which characters are written as an entity nevertheless.

    Text is cut at its entities, and only these are looked at: each is a decoded text (null: none) and what is left of it.
    """
    def named(names: Column, name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.substring(name, 2, 1)), name)

    def found(names: Column, piece: Column) -> Column:
        opened = lambda name: F.struct(named(names, name).alias("text"), F.substr(piece, F.length(name) + 1).alias("rest"))
        whole = lambda text: F.when(text.isNotNull(), F.struct(text.alias("text"), F.lit("").alias("rest"))).otherwise(
            _bind(F.regexp_extract(piece, f"^&(?:{_OPEN_NAMES})", 0), opened)
        )
        numbered = F.struct(_numbered(piece).alias("text"), F.lit("").alias("rest"))
        return F.when(piece.startswith("&#"), numbered).otherwise(_bind(named(names, piece), whole))

    def written(entity: Column, piece: Column) -> Column:
        text = entity["text"]
        if escaped:
            text = F.coalesce(F.try_element_at(F.from_json(F.lit(json.dumps(escaped)), "map<string, string>"), text), text)
        return F.coalesce(F.concat(text, entity["rest"]), piece)

    def decode(names: Column, piece: Column) -> Column:
        return F.when(piece.rlike("^&."), _bind(found(names, piece), lambda entity: written(entity, piece))).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
    every = F.from_json(F.lit(_NAMED), "map<string, map<string, string>>")
    return F.array_join(_bind(every, lambda names: F.transform(pieces, lambda piece: decode(names, piece))), "")
