"""DuckDB SQL of the operator queries that SQL can express.

The other operators rest on hashes that DuckDB lacks (XXH64), on trained models, on lattice or graph
iteration, or on parsing; their tests compare them with brute force.
"""

from __future__ import annotations

from starloom.llm import licenses

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_scan() -> str:
    """Places by joining the words of a text with those after them, notices by comparing every line with every notice."""
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"words[i + {k}] = {_literal(p)}" for k, p in enumerate(parts, 1))
        places.append(
            f"SELECT row, i AS start, {_literal(label)} AS label FROM (SELECT row, words, unnest(range(len(words))) AS i FROM split_texts"
            f" WHERE list_contains(words, {_literal(parts[-1])})) WHERE {same}"
        )
    notices = []
    for label, text in licenses.NOTICES.items():
        words = licenses.words_of(text)
        notices.append(f"({_literal(label)}, [{', '.join(map(_literal, words))}], {licenses.need_of(words, licenses.THRESHOLD)})")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, lower(coalesce(text, '')) AS t FROM documents),
split_texts AS (SELECT row, doc_id, t, regexp_extract_all(t, '{_WORDS}') AS words FROM texts),
places AS ({" UNION ALL ".join(places)}),
notices(label, notice, need) AS (VALUES {", ".join(notices)}),
lines AS (SELECT row, list_distinct(regexp_extract_all(line, '{_WORDS}')) AS words FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM texts)),
held AS (
  SELECT row, label, len(list_intersect(notice, words)) AS overlap, len(notice) AS n
  FROM lines, notices WHERE len(list_intersect(notice, words)) >= need
),
base AS (
  SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY row
),
every_label AS (SELECT row, label FROM places UNION SELECT row, label FROM held),
named AS (SELECT row, string_agg(label, ',' ORDER BY label) AS labels FROM every_label GROUP BY row),
shares AS (SELECT row, max(overlap / n) AS share FROM held GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM split_texts LEFT JOIN base USING (row) LEFT JOIN named USING (row) LEFT JOIN shares USING (row)
"""


ORACLES: dict[str, str] = {"op6_licenses": _license_scan()}
