"""What the queries must return, as SQL for DuckDB on the same tables."""

from __future__ import annotations

from linkloom.llm import quality, site_lines

_WORD = r"[^\x20\x09-\x0D]"


def _measure_rows() -> str:
    values = {
        "word_length": "100 * word_chars // greatest(n_words, 1)",
        "symbols": "1000 * n_symbols // greatest(word_chars, 1)",
        "duplicate_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
        "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
    }
    return " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{name}' AS measure, {value} AS exact FROM base WHERE NOT base_failed"
        for name, value in values.items()
    )


def _level(name: str, keys: str) -> str:
    """Outer quantiles and median of the binned values for each group, and the fences beyond them."""
    by = f"{keys}, " if keys else ""
    width = "(CAST(1 AS BIGINT) << greatest(length(bin({0})) - 5, 0)::INT)".format
    return f"""{name}_v AS (SELECT {by}measure, bin, row_number() OVER (PARTITION BY {by}measure ORDER BY bin) AS r,
    count(*) OVER (PARTITION BY {by}measure) AS n FROM binned),
  {name}_q AS (SELECT {by}measure, max(n) AS n, min(CASE WHEN 100 * r >= {quality.OUTER} * n THEN bin END) AS lo,
    min(CASE WHEN 100 * r >= 50 * n THEN bin END) AS mid, min(CASE WHEN 100 * r >= {100 - quality.OUTER} * n THEN bin END) AS hi
    FROM {name}_v GROUP BY {by}measure),
  {name} AS (SELECT {by}measure, n, lo - greatest(mid - lo, {width("lo")}) AS low,
    hi + greatest(hi - mid, {width("hi")}) AS high FROM {name}_q)"""


_QUALITY = rf"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
  w AS (SELECT *, regexp_extract_all(text, '{_WORD}+') AS words, string_split(text, chr(10)) AS lines FROM d),
  win AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
  win_text AS (SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS t FROM win),
  again AS (SELECT doc_id, t FROM win_text GROUP BY doc_id, t HAVING count(*) > 1),
  covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM win_text JOIN again USING (doc_id, t)),
  repeated AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
  c AS (SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, '{_WORD}')) AS full_lines,
    coalesce(repeated.n, 0) AS n_repeat_words,
    CAST(length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals
    FROM w LEFT JOIN repeated ON w.doc_id = repeated.doc_id),
  base AS (SELECT *, CAST(len(full_lines) AS BIGINT) AS n_lines,
    CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
  m AS ({_measure_rows()}),
  binned AS (SELECT *, (exact >> s) << s AS bin FROM (SELECT *, greatest(length(bin(exact)) - 5, 0)::INT AS s FROM m)),
  {_level("own", "lang, source")},
  {_level("tongue", "lang")},
  {_level("overall", "")},
  bad AS (SELECT DISTINCT m.doc_id FROM m
    JOIN own ON m.measure = own.measure AND m.lang IS NOT DISTINCT FROM own.lang AND m.source IS NOT DISTINCT FROM own.source
    JOIN tongue ON m.measure = tongue.measure AND m.lang IS NOT DISTINCT FROM tongue.lang
    JOIN overall ON m.measure = overall.measure
    WHERE CAST(m.exact AS HUGEINT) * (own.n + {quality.PRIOR}) * (tongue.n + {quality.PRIOR})
        > CAST(own.n AS HUGEINT) * own.high * (tongue.n + {quality.PRIOR}) + {quality.PRIOR} * (CAST(tongue.n AS HUGEINT) * tongue.high + {quality.PRIOR} * overall.high)
      OR CAST(m.exact AS HUGEINT) * (own.n + {quality.PRIOR}) * (tongue.n + {quality.PRIOR})
        < CAST(own.n AS HUGEINT) * own.low * (tongue.n + {quality.PRIOR}) + {quality.PRIOR} * (CAST(tongue.n AS HUGEINT) * tongue.low + {quality.PRIOR} * overall.low))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM base"""

_SITE_LINES = rf"""WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
  totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
  lines AS (SELECT source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM pages),
  often AS (SELECT source, line FROM (SELECT source, line, count(*) AS n FROM lines
      WHERE regexp_matches(line, '{_WORD}') GROUP BY source, line) JOIN totals USING (source)
    WHERE n >= {site_lines.MIN_PAGES} AND n > CAST({site_lines.RATIO} AS DOUBLE) * pages),
  per AS (SELECT source, list(line) AS gone FROM often GROUP BY source),
  kept AS (SELECT doc_id, text, string_split(text, chr(10)) AS before,
    list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(gone, []), x)) AS after
    FROM documents LEFT JOIN per USING (source))
SELECT doc_id, CAST(coalesce(len(before), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(before) - len(after), 0) AS BIGINT) AS n_dropped, array_to_string(after, chr(10)) AS text FROM kept"""

_PIVOT = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_LISTS = """WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
  changes AS (SELECT 'list' || (page_id % 4) AS list,
    CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]*[.]', '')
      ELSE host || regexp_extract(path, '^(/[^/]*/)', 1) END AS entry,
    page_id % 5 < 3 AS added, DATE '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER) AS day FROM p),
  captures AS (SELECT *, DATE '2024-01-01' + CAST((page_id * 11) % 366 AS INTEGER) AS fetched_at FROM p),
  last AS (SELECT c.page_id, h.list, h.entry, max(h.day) AS day FROM captures AS c JOIN changes AS h
    ON h.day <= c.fetched_at AND (c.host = h.entry OR ends_with(c.host, '.' || h.entry)
      OR (contains(h.entry, '/') AND starts_with(c.host || c.path, h.entry))) GROUP BY ALL),
  active AS (SELECT page_id, list FROM last JOIN changes USING (list, entry, day)
    GROUP BY page_id, list, entry HAVING bool_and(added)),
  found AS (SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM active GROUP BY page_id)
SELECT page_id, url, fetched_at, coalesce(lists, '') AS lists, lists IS NOT NULL AS blocked
FROM captures LEFT JOIN found USING (page_id)"""

_CHAT = r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, turn, CASE turn WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) AS t(turn)),
  e AS (SELECT *, length(role || text) + 32 + len(regexp_extract_all(role || chr(10) || text, '<\\*\|')) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""

SQL = {"op6_chat_masks": _CHAT, "op1_pivot_search": _PIVOT, "op2_dated_lists": _LISTS, "op5_quality": _QUALITY, "op10_site_lines": _SITE_LINES}

_LOWERED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format
_DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS(_LOWERED("text"))} AS w FROM documents),
  b AS (SELECT item_id, {_WORDS(_LOWERED("text"))} AS w FROM benchmark),
  win AS (SELECT item_id, array_to_string(w[i:i + 9], ' ') AS s, 10 AS l
      FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)
    UNION ALL SELECT item_id, array_to_string(w, ' '), len(w) FROM b WHERE len(w) BETWEEN 1 AND 9),
  lens AS (SELECT DISTINCT l FROM win),
  g AS (SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS s
    FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, lens WHERE len(w) >= l)),
  hit AS (SELECT DISTINCT g.r, g.i, g.l, win.item_id FROM g JOIN win ON g.s = win.s AND g.l = win.l),
  words_hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hit) GROUP BY r),
  items AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL)) AS ids
    FROM hit GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items USING (r)"""

SQL["op12_decontamination"] = _DECONTAMINATION
