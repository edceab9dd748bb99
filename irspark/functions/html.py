"""Html read as arrays of start tags, each with its attributes and the text that follows it.

A run of text belongs to the last start tag before it; end tags and comments only split runs.
So one regular-expression match per start tag, reaching to the next start tag, holds a tag
together with all its runs, and a page is read inside its own row.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from irspark.functions.binding import let

# Characters a text strip removes (Unicode white space).
BLANK = "".join(
    chr(c)
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Tags whose text counts as page text in the weighted fields.
TEXT_TAGS = [
    "p", "div", "br", "span", "img", "h1", "h2", "h3", "h4", "h5", "h6", "b", "strong", "i",
]

# Text in front of the first tag is filed under this made-up tag, reported as ''.
_START = "<no-tag>"
# Quoted values may hold '>'. Possessive loops keep the matcher's stack flat on long pages.
_ATTRS = r"""(?:[^>"']++|"[^"]*"|'[^']*'|["'])*+"""
_SPLIT = r"</[^>]*>|<!--.*?-->|<[!?][^>]*>"
_BODY = rf"(?:[^<]++|{_SPLIT}|<[^a-zA-Z/!?<])*+"
_ITEM = (
    # A body that is never closed runs to the end of the page.
    rf"(?is)<script(?:[\s/]{_ATTRS})?>.*?(?:</script[^>]*>{_BODY}|\z)"
    rf"|<style(?:[\s/]{_ATTRS})?>.*?(?:</style[^>]*>{_BODY}|\z)"
    rf"|<[a-z][^\s/>]*{_ATTRS}>{_BODY}"
)
_HEAD = rf"(?is)^<([a-z][^\s/>]*)({_ATTRS})>"
_ATTR = r"""([^\s=/>"']+)\s*(?:=\s*(?:"[^"]*"|'[^']*'|[^\s>"']*))?"""

# Named characters that make up nearly all references; looked up before the full list.
_FREQUENT = ["amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;"]
# Names that count without a closing semicolon, also in front of other letters; longest first.
_OPEN_NAMES = "^(" + "|".join(sorted((k for k in html5 if k[-1] != ";"), key=len, reverse=True)) + ")"
# Characters of the bytes 128 to 159 in windows-1252; a byte without one stands for its own code.
_WINDOWS_1252 = [
    bytes([b]).decode("windows-1252", "ignore") or chr(b) for b in range(0x80, 0xA0)
]
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK))


def _names(names: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _number(ref: Column) -> Column:
    """Code of a numeric reference such as `#65;` or `#x41;`; one past the last if it is larger."""
    digits = F.rtrim(F.substring(ref, F.lit(2), F.length(ref)), F.lit(";"))
    is_hex = F.lower(F.substring(digits, 1, 1)) == "x"
    shown = F.regexp_replace(F.when(is_hex, F.substring(digits, F.lit(2), F.length(digits))).otherwise(digits), "^0+", "")
    # No code that counts has more than seven digits.
    code = F.when(is_hex, F.conv(shown, 16, 10)).otherwise(shown).try_cast("bigint")
    return F.when(shown == "", F.lit(0)).when(F.length(shown) > 7, F.lit(0x110000)).otherwise(code)


def _character(number: Column) -> Column:
    """Character of a code; 128 to 159 are windows-1252, other control and non-characters vanish."""
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    gone = (
        number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
        | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    invalid = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    return (
        F.when(invalid, "�")
        .when(number.between(0x80, 0x9F), F.get(F.array(*[F.lit(c) for c in _WINDOWS_1252]), (number - 0x80).cast("int")))
        .when(gone, "")
        .otherwise(char)
    )


def unescape(text: Column) -> Column:
    """Replace character references, each once; unknown ones stay."""
    frequent = _names({k: html5[k] for k in _FREQUENT})
    every = _names(dict(html5))
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1))
    pieces = F.split(text, _REFERENCE, -1)

    def decoded(ref: Column) -> Column:
        numeric = let(_number(ref), _character)
        opened = let(
            F.regexp_extract(ref, _OPEN_NAMES, 1),
            lambda name: F.concat(
                F.coalesce(F.element_at(every, name), F.lit("&")),
                F.substring(ref, F.length(name) + 1, F.length(ref)),
            ),
        )
        named = F.coalesce(F.element_at(frequent, ref), F.element_at(every, ref), opened)
        return F.when(ref.startswith("#"), numeric).otherwise(named)

    tail = F.concat(F.transform(found, decoded), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with(pieces, tail, lambda a, b: F.array(a, b))), "")
    return F.when(F.instr(text, "&") > 0, joined).otherwise(text)


def attributes(attrs: Column) -> Column:
    """array<struct<name, value>> in page order; names are lower case, values decoded."""
    tokens = F.regexp_extract_all(attrs, F.lit(_ATTR), F.lit(0))

    def pair(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, r"^([^\s=]+)", 1))
        raw = F.regexp_replace(token, r"(?s)^[^\s=]+\s*=?\s*", "")
        bare = F.regexp_replace(raw, r"""(?s)^(?:"(.*)"|'(.*)')$""", "$1$2")
        return F.struct(name.alias("name"), unescape(bare).alias("value"))

    return F.transform(tokens, pair)


def attribute(pairs: Column, name: str) -> Column:
    """Stripped value of an attribute, '' when absent; the last of equal names counts."""
    values = F.filter(pairs, lambda p: p["name"] == name)
    return strip(F.coalesce(F.try_element_at(values, F.lit(-1))["value"], F.lit("")))


def tag_items(html: Column) -> Column:
    """array<struct<tag, attrs, runs>>: start tags in page order with their non-blank runs."""
    items = F.regexp_extract_all(F.concat(F.lit(_START), html), F.lit(_ITEM), F.lit(0))

    def item(m: Column) -> Column:
        raw = F.split(F.regexp_replace(m, _HEAD, ""), rf"(?is){_SPLIT}", -1)

        def runs(tag: Column) -> Column:
            # Script and style hold raw text without references.
            decoded = F.when(tag.isin("script", "style"), raw).otherwise(F.transform(raw, unescape))
            return F.struct(
                F.when(tag == "no-tag", F.lit("")).otherwise(tag).alias("tag"),
                F.regexp_extract(m, _HEAD, 2).alias("attrs"),
                F.filter(F.transform(decoded, strip), lambda r: r != "").alias("runs"),
            )

        return let(F.lower(F.regexp_extract(m, _HEAD, 1)), runs)

    return F.transform(items, item)


def links(html: Column) -> Column:
    """Values of href of every `a` element that has one, in page order, as written."""
    pattern = rf"(?is)<script(?:[\s/]{_ATTRS})?>.*?(?:</script[^>]*>|\z)|<!--.*?-->|<a(?:[\s/]{_ATTRS})>"
    anchors = F.filter(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda m: m.rlike(r"(?i)^<a[\s/]")
    )
    pairs = F.transform(anchors, lambda m: attributes(F.regexp_extract(m, _HEAD, 2)))
    hrefs = F.transform(pairs, lambda p: F.filter(p, lambda x: x["name"] == "href"))
    present = F.filter(hrefs, lambda h: F.size(h) > 0)
    return F.transform(present, lambda h: F.element_at(h, 1)["value"])
