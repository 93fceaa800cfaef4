"""Link extraction from HTML text, as native Spark columns.

One regular expression walks a page from start to end the way an HTML tokenizer
does: comments, declarations, raw-text elements and every other tag are stepped
over as units, so an ``<a>`` inside any of them is not a link.  Each match ends at
an anchor (or at the end of the page) and captures its first ``href`` attribute.

All repetition is possessive, which keeps matching linear in the page and keeps the
stack flat, however many tags or attributes a page holds.  Nothing leaves the JVM.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content HTML treats as text, not markup.
RAW_TEXT_ELEMENTS = "script|style|xmp|iframe|noembed|noframes|title|textarea"

_WS = r"[ \t\n\f\r]"
_SEP = r"[ \t\n\f\r/]"
_TAG_END = r"(?=[ \t\n\f\r/>])"
_CLOSE = r"(?:>|\z)"
_VALUE = r""""[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+"""
_ASSIGN = rf"(?:{_WS}*+={_WS}*+(?:{_VALUE})?+)?+"
_ATTR = rf"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+{_ASSIGN}"
_ATTRS = rf"(?:{_SEP}++|{_ATTR})*+"
_TAG = rf"[a-z][^ \t\n\f\r/>]*+{_ATTRS}{_CLOSE}"

_RAW_TEXT = (
    rf"(?<raw>{RAW_TEXT_ELEMENTS}){_TAG_END}{_ATTRS}{_CLOSE}"
    rf"[^<]*+(?:<(?!/\k<raw>{_TAG_END})[^<]*+)*+"
)
_MARKUP = "|".join(
    [
        r"!--(?:-?>|.*?(?:--!?>|\z))",
        rf"[!?][^>]*+{_CLOSE}",
        rf"/{_TAG}",
        rf"/[^>]*+{_CLOSE}",
        _RAW_TEXT,
        rf"plaintext{_TAG_END}{_ATTRS}{_CLOSE}.*+",
        rf"(?!a{_SEP}){_TAG}",
        r"(?![a-z!/?])",
    ]
)
_SKIP = rf"(?:[^<]++|<(?:{_MARKUP}))*+"
_LINK = (
    rf"<a(?={_SEP})(?:{_SEP}++|(?!href(?:[ \t\n\f\r/>=]|\z)){_ATTR})*+"
    rf"(href{_ASSIGN}){_ATTRS}>"
)
_PLAIN_ANCHOR = rf"<a(?={_SEP}){_ATTRS}{_CLOSE}"
ANCHOR_PATTERN = rf"(?is){_SKIP}(?:{_LINK}|{_PLAIN_ANCHOR}|\z)"
# Group 1 is the raw-text element name, group 2 the ``href`` attribute.
_HREF_GROUP = 2

# Names ending in ";" need it in the text as well; the others are the old HTML
# entities that are also recognised without it.
_ENTITIES = json.dumps(dict(html5), ensure_ascii=True).replace("\\", "\\\\").replace("'", "\\'")
_CHARACTER = """CASE
    WHEN {0} > '00000000' AND {0} < '0000D800' OR {0} > '0000DFFF' AND {0} < '00110000'
    THEN decode(unhex({0}), 'UTF-32') ELSE '\\ufffd' END"""
# The code point as eight hexadecimal digits; NULL if it has too many digits to exist.
_DIGITS = r"regexp_extract(piece, r'\A&#0*+([0-9]{0,7}+)(?![0-9])', 1)"
_DECIMAL = f"lpad(hex(try_cast({_DIGITS} AS BIGINT)), 8, '0')"
_HEX_DIGITS = r"regexp_extract(piece, r'\A&#[xX]0*+([0-9a-fA-F]{0,6}+)(?![0-9a-fA-F])', 1)"
_HEX = f"lpad(nullif(upper({_HEX_DIGITS}), ''), 8, '0')"
_NAME = r"regexp_extract(piece, r'\A&([a-zA-Z]++[0-9]*+(?:;|(?![0-9a-zA-Z=_-])))', 1)"
_NAMED = f"element_at(from_json('{_ENTITIES}', 'map<string,string>'), nullif({_NAME}, ''))"
_DECODED_PIECE = rf"""CASE
    WHEN startswith(piece, '&amp;') THEN '&' || substr(piece, 6)
    WHEN piece RLIKE r'\A&#[0-9]'
      THEN {_CHARACTER.format(_DECIMAL)} || regexp_replace(piece, r'\A&#[0-9]++;?', '')
    WHEN piece RLIKE r'\A&#[xX][0-9a-fA-F]'
      THEN {_CHARACTER.format(_HEX)} || regexp_replace(piece, r'\A&#[xX][0-9a-fA-F]++;?', '')
    WHEN piece RLIKE r'\A&[a-zA-Z]'
      THEN coalesce({_NAMED} || substr(piece, length({_NAME}) + 2), piece)
    ELSE piece END"""


def href_attributes(html: Column) -> Column:
    """``ARRAY<STRING>``: the ``href`` attribute text of every link, in page order.

    ``html`` may hold undecodable bytes; they become U+FFFD as the page is decoded.
    """
    found = F.regexp_extract_all(html, F.lit(ANCHOR_PATTERN), F.lit(_HREF_GROUP))
    return F.array_remove(found, "")


def href_value(attribute: Column | str) -> Column:
    """The undecoded value of an ``href`` attribute; a bare ``href`` has the value ``""``."""
    attribute = F.col(attribute) if isinstance(attribute, str) else attribute
    usual = attribute.startswith('href="') | attribute.startswith("href='")
    inside = F.substring(attribute, F.lit(7), F.length(attribute) - 7)
    quoted = r""""([^"]*+)"|'([^']*+)'"""
    pattern = rf"(?is)\Ahref(?:{_WS}*+={_WS}*+(?:(?:{quoted})\z)?+)?+"
    return F.when(usual, inside).otherwise(F.regexp_replace(attribute, pattern, "$1$2"))


def decode_entities(text: str) -> str:
    """SQL for the text expression ``text`` with its character references decoded.

    The rules are those for attribute values: an old entity without its ";" stays as it
    is where a letter, a digit or "=" follows, as in ``?a=1&copy=2``.
    """
    decoded = f"array_join(transform(split({text}, '(?=&)'), piece -> {_DECODED_PIECE}), '')"
    return f"CASE WHEN contains({text}, '&') THEN {decoded} ELSE {text} END"
