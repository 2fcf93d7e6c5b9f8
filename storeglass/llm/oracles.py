"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from storeglass.llm import licenses, quality

WORD = "[^\\x20\\x09-\\x0D]+"


def counts_sql(docs: str = "documents") -> str:
    """CTEs ending in `counted`: doc_id, lang, source and the count columns of every document."""
    return f"""
split_words AS (
    SELECT *, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
        list_filter(str_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM {docs}),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS pos FROM split_words),
windows AS (SELECT doc_id, pos, list_slice(words, pos, pos + {quality.WINDOW - 1}) AS w FROM places),
twice AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
steps AS (
    SELECT doc_id, least({quality.WINDOW}, pos - coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -{quality.WINDOW})) AS n
    FROM twice),
covered AS (SELECT doc_id, sum(n)::BIGINT AS n FROM steps GROUP BY doc_id),
plain AS (
    SELECT s.doc_id, lang, source, len(words)::BIGINT AS n_words,
        length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM split_words s LEFT JOIN covered c ON c.doc_id = s.doc_id),
counted AS (
    SELECT *, (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AS base_failed
    FROM plain)"""


def verdict_sql() -> str:
    """CTEs after `counted`, ending in `judged`: counted and the column kept."""
    value = {
        "symbols": "n_symbols * 1000 // greatest(n_words, 1)",
        "width": "word_chars * 100 // greatest(n_words, 1)",
        "dup_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
    }
    each = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS measure, ({v})::BIGINT AS v FROM counted WHERE NOT base_failed"
        for name, v in value.items())
    # Documents as such instead of sketches: their values fall to the lower bound of the bucket.
    shift = "greatest(length(bin(v)) - 6, 0)"
    pick = lambda k: (
        f"CASE WHEN o.docs >= {quality.MIN_DOCS} THEN o.q{k} WHEN l.docs >= {quality.MIN_DOCS} THEN l.q{k} ELSE e.q{k} END")
    quartiles = lambda keys: (
        f"SELECT {keys} measure, count(*) AS docs, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 "
        f"FROM floored GROUP BY {keys} measure")
    inside = " AND ".join(
        f"({v}) BETWEEN max(CASE WHEN measure = '{name}' THEN q1 - greatest({quality.SPREAD} * (q3 - q1), {least}) END) "
        f"AND max(CASE WHEN measure = '{name}' THEN q3 + greatest({quality.SPREAD} * (q3 - q1), {least}) END)"
        for (name, least), v in zip(quality.LEAST_DISTANCE.items(), value.values(), strict=True))
    return f"""
measured AS ({each}),
floored AS (SELECT lang, source, measure, (v >> {shift}) << {shift} AS b FROM measured),
own AS ({quartiles('lang, source,')}), by_lang AS ({quartiles('lang,')}), everything AS ({quartiles('')}),
limits AS (
    SELECT o.lang, o.source, o.measure, {pick(1)} AS q1, {pick(3)} AS q3
    FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure
    JOIN everything e ON e.measure = o.measure),
judged AS (
    SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce({inside}, true) AS kept
    FROM counted c LEFT JOIN limits m ON c.lang IS NOT DISTINCT FROM m.lang AND c.source IS NOT DISTINCT FROM m.source
    GROUP BY c.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed)"""


def license_sql() -> str:
    """Every unit against every template that its number of bigrams allows."""
    rows = []
    for name, text in sorted(licenses.TEMPLATES.items()):
        grams = licenses.template_bigrams(text)
        low, high = licenses.size_range(len(grams))
        rows.append(f"('{name}', {grams!r}, {len(grams)}, {low}, {high})")
    return f"""
WITH templates(template, t_grams, n_template, low, high) AS (VALUES {', '.join(rows)}),
split_lines AS (SELECT doc_id, coalesce(text, '') AS text, str_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
units AS (
    SELECT doc_id, unnest(lines) AS unit, unnest(range(1, len(lines) + 1)) AS line_no FROM split_lines
    UNION ALL SELECT doc_id, text, 0 FROM split_lines WHERE len(lines) > 1),
worded AS (
    SELECT doc_id, line_no, str_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
sets AS (
    SELECT doc_id, line_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
    FROM worded),
matched AS (
    SELECT doc_id, line_no, template, len(grams) AS n_bigrams, n_template, len(list_intersect(grams, t_grams)) AS n_shared
    FROM sets JOIN templates ON len(grams) BETWEEN low AND high),
best AS (
    SELECT * FROM matched WHERE 200 * n_shared >= {licenses.LEAST} * (n_bigrams + n_template)
    QUALIFY row_number() OVER (
        PARTITION BY doc_id, line_no ORDER BY 2 * n_shared / (n_bigrams + n_template) DESC, template) = 1)
SELECT doc_id, line_no::BIGINT AS line_no, template, n_bigrams::BIGINT AS n_bigrams, n_template::BIGINT AS n_template,
    n_shared::BIGINT AS n_shared, (200 * n_shared // (n_bigrams + n_template))::BIGINT AS dice_percent
FROM best"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_license_scan": license_sql(),
        "op10_adaptive_quality": f"WITH {counts_sql()}, {verdict_sql()} SELECT * FROM judged",
    }
