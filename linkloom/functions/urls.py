"""URL normalisation and URL ids, as native Spark columns.

A URL is resolved against the page it was found on, then loses its protocol, user
info and fragment; the host is lower-cased, and port, path and query are kept.  The
rules follow the lenient parsing that web archives were indexed with, so they accept
much that a strict URI grammar rejects and differ from ``parse_url``.

Each part of a URL is a named step of a projection that later steps refer to; written
as one expression, the same parts would be evaluated many times per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.columns import with_computed_once

# The protocols that count as well-formed.
PROTOCOLS = ("http", "https", "ftp", "file", "mailto")

PARTS_TYPE = (
    "struct<protocol:string,has_authority:boolean,host:string,port:string,"
    "path:string,query:string>"
)

_BLANKS = "'" + "".join(f"\\u{code:04x}" for code in range(0x21)) + "'"
# Letters and digits outside the basic plane never make a protocol name.
_BASIC = r"&&[\x{0}-\x{FFFF}]"
_PROTOCOL = rf"\A([\p{{L}}{_BASIC}][[\p{{L}}\p{{Nd}}+.-]{_BASIC}]*+):"
_GROUP = "[0-9a-fA-F]{1,4}"
_DOTTED = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
_IPV6 = (
    rf"(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{6}}{_DOTTED}"
    rf"|(?!:{{0,2}}(?:{_GROUP}::?){{7}}{_GROUP})"
    rf"(?:{_GROUP}(?::{_GROUP})*)?::(?:(?:{_GROUP}:)*(?:{_GROUP}|{_DOTTED}))?"
)


def url_id(url: Column) -> Column:
    """A short stable id: the first 72 bits of the SHA-1 of the UTF-8 text, in Base64."""
    return F.left(F.base64(F.unhex(F.sha1(url.cast("binary")))), F.lit(12))


def url_text(parts: Column) -> Column:
    """The normalised URL of a ``PARTS_TYPE`` column; NULL if the URL is malformed."""
    return F.concat(
        parts["host"],
        F.coalesce(F.concat(F.lit(":"), parts["port"]), F.lit("")),
        parts["path"],
        F.coalesce(F.concat(F.lit("?"), parts["query"]), F.lit("")),
    )


# The part of a path up to its last "/"; nothing if it has none.
_FOLDER = "left({0}, length({0}) - length(substring_index({0}, '/', -1)))"

# Each level refers to the levels before it.  The first ones differ for absolute URLs
# and for links.
_TEXT = (
    # Blanks around the URL and a leading "url:" are ignored.
    (f"btrim({{spec}}, {_BLANKS}) AS __u_trimmed",),
    (
        "CASE WHEN lower(left(__u_trimmed, 4)) = 'url:' THEN substr(__u_trimmed, 5)"
        " ELSE __u_trimmed END AS __u_text",
    ),
    (
        "CASE WHEN NOT contains(__u_text, ':') THEN NULL"
        " WHEN startswith(__u_text, 'http:') THEN 'http'"
        " WHEN startswith(__u_text, 'https:') THEN 'https'"
        f" ELSE nullif(lower(regexp_extract(__u_text, r'{_PROTOCOL}', 1)), '') END AS __u_named",
    ),
)
_REST = "substring_index(substr(__u_text, coalesce(length(__u_named) + 2, 1)), '#', 1) AS __u_rest"
_NO_BASE = (
    (
        "false AS __u_relative",
        "__u_named AS __u_protocol",
        f"CAST(NULL AS {PARTS_TYPE}) AS __u_base",
        _REST,
    ),
)
# Does the page's own URL apply, and what is inherited from it?
_BASE = (
    (
        "{base} IS NOT NULL AND (__u_named IS NULL OR (__u_named = {base}.protocol"
        " AND startswith({base}.path, '/'))) AS __u_relative",
        _REST,
    ),
    (
        "CASE WHEN __u_relative THEN {base}.protocol ELSE __u_named END AS __u_protocol",
        "CASE WHEN __u_relative THEN {base} END AS __u_base",
    ),
)
_LEVELS = (
    ("substring_index(__u_rest, '?', 1) AS __u_body",),
    (
        "CASE WHEN contains(__u_rest, '?') THEN substr(__u_rest, length(__u_body) + 2) END AS __u_query",
        "CASE WHEN startswith(__u_body, '//') AND NOT startswith(__u_body, '////')"
        " THEN substring_index(substr(__u_body, 3), '/', 1) END AS __u_authority",
    ),
    (
        "__u_authority IS NOT NULL OR coalesce(__u_base.has_authority, false) AS __u_has_authority",
        "CASE WHEN __u_authority IS NULL THEN __u_body"
        " ELSE substr(__u_body, length(__u_authority) + 3) END AS __u_tail",
        # With more than one "@" an authority names no host.
        "CASE WHEN length(__u_authority) - length(replace(__u_authority, '@')) <= 1"
        " THEN substring_index(__u_authority, '@', -1) END AS __u_server",
        "CASE WHEN coalesce(__u_authority, '') = '' THEN coalesce(__u_base.path, '') ELSE '' END"
        " AS __u_base_path",
    ),
    (
        r"CASE WHEN startswith(__u_server, '[')"
        r" THEN regexp_extract(__u_server, r'\A(\[[^\]]{2,}\])(?=:|\z)', 1)"
        r" ELSE substring_index(__u_server, ':', 1) END AS __u_host",
        "CASE WHEN __u_tail <> '' AND NOT startswith(__u_tail, '/') AND __u_base_path <> ''"
        f" THEN {_FOLDER.format('__u_base_path')} END AS __u_folder",
    ),
    (
        "substr(__u_server, length(__u_host) + 2) AS __u_port_text",
        "CASE WHEN __u_folder = '' AND __u_has_authority THEN '/' || __u_tail"
        " ELSE __u_folder || __u_tail END AS __u_merged",
    ),
    (
        r"CASE WHEN __u_port_text <> '' AND __u_port_text RLIKE r'\A[+-]?[0-9]++\z'"
        " THEN try_cast(__u_port_text AS INT) END AS __u_port",
    ),
    (
        "coalesce(__u_protocol NOT IN ({protocols}), true)"
        " OR (coalesce(__u_port_text, '') <> '' AND coalesce(__u_port < -1, true))"
        " OR coalesce(startswith(__u_server, '[')"
        rf" AND NOT __u_host RLIKE r'\A\[(?:{_IPV6})(?:%[^\]]+)?\]\z', false)"
        " AS __u_malformed",
    ),
)
_RESOLVED_PATH = r"""CASE
    WHEN startswith(__u_tail, '/') THEN __u_tail
    WHEN __u_merged IS NOT NULL THEN {collapsed}
    WHEN __u_tail <> '' THEN if(__u_has_authority, '/', '') || __u_tail
    WHEN __u_body = '' AND __u_query IS NOT NULL AND __u_relative
      THEN regexp_extract(__u_base_path, r'(?s)\A(.*)/', 1) || '/'
    ELSE __u_base_path END"""
_PARTS = """CASE
  WHEN __u_protocol = 'mailto' THEN
    CASE WHEN NOT __u_rest RLIKE r'\\A\\s*+\\z' THEN named_struct(
      'protocol', __u_protocol, 'has_authority', false, 'host', '', 'port', CAST(NULL AS STRING),
      'path', __u_rest, 'query', CAST(NULL AS STRING)) END
  WHEN NOT __u_malformed THEN named_struct(
    'protocol', __u_protocol,
    'has_authority', __u_has_authority,
    'host', CASE WHEN __u_server IS NOT NULL THEN lower(__u_host)
      WHEN __u_authority IS NOT NULL THEN '' ELSE coalesce(__u_base.host, '') END,
    'port', CASE WHEN __u_server IS NULL THEN __u_base.port
      WHEN __u_port >= 0 THEN CAST(__u_port AS STRING) END,
    'path', {path},
    'query', CASE WHEN __u_rest = '' AND __u_relative THEN __u_base.query ELSE __u_query END)
  END"""

# The "." and ".." segments of a path that was merged from a base and a link.  ".."
# removes the segment before it, but neither the first one nor a ".." that came first.
# The fold runs over the ".." segments alone, so other segments cost nothing.
_DOT_LEVELS = (
    (
        "CASE WHEN contains(__u_merged, '/.') OR startswith(__u_merged, './')"
        r" THEN split(regexp_replace(__u_merged, r'(?:/\.(?=/))++', ''), r'/\.\.(?=/)')"
        " END AS __u_pieces",
    ),
    (
        """aggregate(slice(__u_pieces, 2, size(__u_pieces)), __u_pieces[0], (done, piece) -> CASE
          WHEN contains(done, '/') AND done <> '/..'
            THEN left(done, length(done) - length(substring_index(done, '/', -1)) - 1) || piece
          ELSE done || '/..' || piece END) AS __u_walked""",
    ),
    (
        # A final ".." is taken from the first "/..", which need not be the last one.
        "CASE WHEN endswith(__u_walked, '/..')"
        r" THEN nullif(regexp_extract(left(__u_walked, instr(__u_walked, '/..') - 1),"
        r" r'(?s)\A(.*/)', 1), '') END AS __u_cut",
    ),
)
_COLLAPSED = (
    "CASE WHEN __u_pieces IS NULL THEN __u_merged ELSE"
    r" regexp_replace(coalesce(__u_cut, __u_walked), r'(?s)\A\./(?=.)|(?<=/)\.\z', '') END"
)


def with_url_parts(df: DataFrame, spec: str, out: str, base: str | None = None) -> DataFrame:
    """Add column ``out`` (``PARTS_TYPE``): ``spec`` resolved against ``base``.

    ``base`` names a column that an earlier call made for the page; without it only
    absolute URLs are well-formed.  Malformed URLs give NULL.
    """
    kept = [f"`{name}`" for name in df.columns]
    if base is None:
        levels = (*_TEXT, *_NO_BASE, *_LEVELS)
        collapsed = "__u_merged"
    else:
        levels = (*_TEXT, *_BASE, *_LEVELS, *_DOT_LEVELS)
        collapsed = _COLLAPSED
    names = {
        "{base}": f"`{base}`",
        "{spec}": f"`{spec}`",
        "{protocols}": ", ".join(f"'{name}'" for name in PROTOCOLS),
        "{path}": _RESOLVED_PATH,
        "{collapsed}": collapsed,
    }

    def filled(template: str) -> str:
        for name, value in names.items():
            template = template.replace(name, value)
        return template

    for level in levels:
        df = df.selectExpr("*", *map(filled, level))
    return with_computed_once(df, out, F.expr(filled(_PARTS))).select(*kept, out)
