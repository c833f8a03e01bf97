"""Parts shared by the equivalent SQL of the registered queries."""

from __future__ import annotations

from quillvault.fixed_values import (
    RE2_EMAIL as EMAIL,
    RE2_IBAN as IBAN,
    RE2_INVISIBLE as INVISIBLE,
    RE2_IP as IP,
    RE2_ISO_DATE as ISO_DATE,
    RE2_INJECTION_PATTERNS as PATTERNS,
    RE2_PHONE as PHONE,
    RE2_SPACES as SPACES,
    RE2_URL as URL,
    RE2_URL_NOMINATIVE as URL_NOMINATIVE,
)

def content_hash(text: str) -> str:
    return f"sha256(trim(regexp_replace({text}, '{SPACES}+', ' ', 'g'), ' '))"


def injection_ctes(source: str, text: str) -> str:
    """``scored``: score and reasons of every row of ``source``."""
    flags = ", ".join(
        f"regexp_matches(clean, '{pattern}') AS is_{name}" for name, _, pattern in PATTERNS
    )
    total = "CASE WHEN n_invisible > 0 THEN 0.4::DOUBLE ELSE 0 END" + "".join(
        f" + CASE WHEN is_{name} THEN {weight}::DOUBLE ELSE 0 END" for name, weight, _ in PATTERNS
    )
    reasons = "CASE WHEN n_invisible > 0 THEN 'invisible_chars:' || n_invisible END, " + ", ".join(
        f"CASE WHEN is_{name} THEN '{name}' END" for name, _, _ in PATTERNS
    )
    return f"""
      cleaned AS (SELECT *, len(regexp_extract_all({text}, '{INVISIBLE}')) AS n_invisible,
                  regexp_replace({text}, '{INVISIBLE}', '', 'g') AS clean FROM {source}),
      flagged AS (SELECT *, {flags} FROM cleaned),
      scored AS (SELECT *, least(1.0::DOUBLE, round({total}, 6)) AS score,
                 list_filter([{reasons}], lambda r: r IS NOT NULL) AS reasons FROM flagged)"""


def pseudonym_ctes() -> str:
    """From ``d(doc_id, text)``: spans of all categories, their numbers and ``pseudo``.

    RE2 has no look-behind. IP and PHONE take the character before them along as a border, which is
    cut off again, so that both begin at the same place and the order of alternatives decides.
    """
    border = "(?:^|[^\\p{L}\\p{N}_.])"
    ip_border = "(?:^|[^\\p{L}\\p{N}_])"
    every = f"(?:{URL})|(?:{EMAIL})|(?:{IBAN})|(?:{ip_border}{IP})|(?:{border}{PHONE})"
    digits = "len(regexp_replace(value, '[^0-9]', '', 'g'))"
    is_phone = (
        f"regexp_full_match(value, '{PHONE}') AND {digits} BETWEEN 9 AND 15 "
        f"AND NOT regexp_matches(value, '{ISO_DATE}')"
    )
    return f"""
      cut AS (SELECT doc_id, regexp_extract_all(text, '{every}') AS hits,
              regexp_split_to_array(text, '{every}') AS gaps FROM d),
      raw AS (SELECT doc_id, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i,
              unnest(list_transform(range(1, len(hits) + 1), lambda j:
                list_sum(list_transform(gaps[1:j], lambda g: length(g)))
                + coalesce(list_sum(list_transform(hits[1:j-1], lambda h: length(h))), 0)
              )) AS hit_pos FROM cut),
      hit AS (SELECT *, length(hit) - length(value) + hit_pos AS start_pos,
              left(hit, length(hit) - length(value)) AS border FROM
              (SELECT *, CASE WHEN regexp_matches(hit, '^(?:http|[A-Za-z0-9%+_-]*[A-Za-z0-9._%+-]*@)')
                 OR regexp_full_match(hit, '{IBAN}') OR regexp_full_match(hit, '{IP}')
                 OR regexp_full_match(hit, '{PHONE}') THEN hit ELSE substr(hit, 2) END AS value FROM raw)),
      typed AS (SELECT *, CASE WHEN starts_with(value, 'http') THEN
                  CASE WHEN regexp_matches(value, '{URL_NOMINATIVE}') THEN 'URL' END
                WHEN contains(value, '@') THEN 'EMAIL'
                WHEN regexp_full_match(value, '{IBAN}') THEN 'IBAN'
                WHEN regexp_full_match(value, '{IP}')
                  AND list_max(list_transform(string_split(value, '.'), lambda o: CAST(o AS INTEGER)))
                     <= 255 THEN 'IP'
                WHEN {is_phone} THEN 'PHONE' END AS category FROM hit),
      keyed AS (SELECT *, CASE WHEN category = 'EMAIL' THEN lower(value) ELSE value END AS key
                FROM typed),
      numbered AS (SELECT doc_id, category, key,
                   row_number() OVER (PARTITION BY doc_id, category ORDER BY min(i)) AS num
                   FROM keyed WHERE category IS NOT NULL GROUP BY doc_id, category, key),
      token AS (SELECT k.doc_id, list(CASE WHEN k.category IS NULL THEN k.hit
                ELSE k.border || '[' || k.category || '_' || n.num || ']' END ORDER BY k.i) AS tokens
                FROM keyed k LEFT JOIN numbered n
                ON k.doc_id = n.doc_id AND k.category = n.category AND k.key = n.key
                GROUP BY k.doc_id),
      pseudo AS (SELECT d.*, CASE WHEN tokens IS NULL THEN text ELSE array_to_string(
                 list_transform(range(1, len(gaps) + 1),
                 lambda j: gaps[j] || coalesce(tokens[j], '')), '') END AS text_pseudo
                 FROM d JOIN cut USING (doc_id) LEFT JOIN token USING (doc_id))"""


def status_ctes(threshold: float = 0.5) -> str:
    """From ``d``: the pseudonymised text, its score and the status of every document."""
    return f"""{pseudonym_ctes()},{injection_ctes("pseudo", "text_pseudo")},
      hashed AS (SELECT *, {content_hash("text")} AS doc_sha256,
                 regexp_matches(text_pseudo, '^{SPACES}*$') AS is_empty FROM scored),
      firsts AS (SELECT doc_sha256, min(doc_id) AS first FROM hashed
                 WHERE score < {threshold} AND NOT is_empty GROUP BY doc_sha256),
      routed AS (SELECT h.*, CASE WHEN f.first < h.doc_id THEN 'duplicate'
                 WHEN score >= {threshold} THEN 'quarantined'
                 WHEN is_empty THEN 'empty' ELSE 'ingested' END AS status
                 FROM hashed h LEFT JOIN firsts f USING (doc_sha256))"""


def windows(source: str, text: str, size: str, overlap: int, columns: str) -> str:
    """Character windows of a text column, one row per window."""
    count = (
        f"CASE WHEN length({text}) = 0 THEN 0 ELSE greatest(1, CAST(ceil((length({text}) - "
        f"{overlap}) / ({size} - {overlap})::DOUBLE) AS BIGINT)) END"
    )
    return f"""SELECT {columns}, chunk_index,
      substr({text}, chunk_index * ({size} - {overlap}) + 1, {size}) AS content
      FROM (SELECT *, unnest(range(0, {count})) AS chunk_index FROM {source})"""


def hashed_vectors(source: str, key: str, text: str, prefix: str, dim: int) -> str:
    """Non-zero elements of the word-count vector of every row: ``key, dim, weight``."""
    return f"""SELECT {key}, b AS dim,
        CAST(count(*) / sqrt(sum(count(*) * count(*)) OVER (PARTITION BY {key})) AS FLOAT) AS weight
      FROM (SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS b
            FROM (SELECT {key}, unnest(regexp_extract_all(lower('{prefix}' || {text}),
                  '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}))
      GROUP BY {key}, b"""


def recursive_chunks(source: str, size: int, overlap: int) -> str:
    """Chunks of the recursive splitter for ``doc_id, text`` of ``source``.

    Texts are cut at the first separator that they hold, pieces of ``size`` and more again at a finer
    one, four times at most. Short neighbours in one cut are packed: where a chunk ends and where the
    next begins follow from the places of the pieces, so each step is a look-up.
    """
    breaks = ("chr(10) || chr(10)", "chr(10)", "' '")
    held = " ".join(
        f"WHEN level <= {i} AND contains(text, {b}) THEN {i}" for i, b in enumerate(breaks)
    )
    signs = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(breaks))
    ctes = [
        f"n0 AS (SELECT doc_id, 0 AS base, text, 0 AS level FROM {source} "
        "WHERE text IS NOT NULL AND text <> '')"
    ]
    for d in range(4):
        if d:
            ctes.append(
                f"""n{d} AS (SELECT doc_id, start AS base, piece AS text, level + 1 AS level
                FROM p{d - 1} WHERE len >= {size} AND level < 3)"""
            )
        ctes.append(
            f"""l{d} AS (SELECT doc_id, base, text, CASE {held} ELSE 3 END AS level FROM n{d}),
          s{d} AS (SELECT doc_id, base, level, CASE level {signs} ELSE '' END AS sep,
            string_split(text, sep) AS parts FROM l{d}),
          u{d} AS (SELECT doc_id, base, level, sep, unnest(parts) AS part,
            generate_subscripts(parts, 1) AS i FROM s{d}),
          c{d} AS (SELECT doc_id, base, level, i, CASE WHEN i = 1 THEN part ELSE sep || part END AS piece
            FROM u{d}),
          p{d} AS (SELECT doc_id, base AS node, level, piece, length(piece) AS len, CAST(base - length(piece)
            + sum(length(piece)) OVER (PARTITION BY doc_id, base ORDER BY i) AS BIGINT) AS start
            FROM c{d} WHERE piece <> '')"""
        )
    every = " UNION ALL ".join(
        f"SELECT doc_id, {d} AS depth, node, start, len, len >= {size} AS long, level FROM p{d}"
        for d in range(4)
    )
    return f"""WITH RECURSIVE {", ".join(ctes)},
      marked AS (SELECT *, count_if(long) OVER (PARTITION BY doc_id, depth, node ORDER BY start) AS run
        FROM ({every})),
      piece AS MATERIALIZED (SELECT doc_id || ':' || depth || ':' || node || ':' || run AS k, doc_id,
        start, start + len AS stop FROM marked WHERE NOT long),
      cut AS (SELECT f.k, f.doc_id, f.start AS f, e.start AS e,
        greatest(e.start - {overlap}, e.stop - {size}) AS bound
        FROM piece f ASOF LEFT JOIN piece e ON f.k = e.k AND f.start + {size} < e.stop),
      step AS MATERIALIZED (SELECT c.k, c.doc_id, c.f, c.e, g.start AS next
        FROM cut c ASOF LEFT JOIN piece g ON c.k = g.k AND c.bound <= g.start),
      run_ends AS (SELECT k, min(start) AS f, max(stop) AS stop FROM piece GROUP BY k),
      walk AS (SELECT k, f FROM run_ends UNION ALL SELECT s.k, s.next FROM walk w
        JOIN step s ON s.k = w.k AND s.f = w.f WHERE s.e IS NOT NULL),
      chunk AS (SELECT s.doc_id, s.f, coalesce(s.e, r.stop) AS stop
        FROM walk JOIN step s USING (k, f) JOIN run_ends r USING (k)
        UNION ALL SELECT doc_id, start, start + len FROM marked WHERE long AND level = 3),
      stripped AS (SELECT doc_id, f, regexp_replace(regexp_replace(substr(text, f + 1, stop - f),
        '^{SPACES}+', ''), '{SPACES}+\\z', '') AS content FROM chunk JOIN {source} USING (doc_id))
      SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) - 1 AS INTEGER) AS chunk_index,
        content FROM stripped WHERE content <> ''"""
