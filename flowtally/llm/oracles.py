"""SQL equivalents, over the whole tables, of the queries that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Sequence

from . import licenses, url_filter

EXACT_DEDUP = """
  WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  owned AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM texts)
  SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM owned"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def url_filter_sql(rules: Sequence[url_filter.Rule]) -> str:
    order, alphabet = url_filter.ORDER, url_filter.ALPHABET
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    longest = sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True)
    fits = [f"(host = {_text(r.host)} OR ends_with(host, {_text('.' + r.host)})) AND starts_with(path, {_text(r.path)})" for r in longest]
    rule = " ".join(f"WHEN {f} THEN {_text(r.text)}" for f, r in zip(fits, longest))
    allow = " ".join(f"WHEN {f} THEN {str(r.allow).lower()}" for f, r in zip(fits, longest))
    sides = ("yes", "no")
    parts = ", ".join(
        f"CASE WHEN sum({x}) OVER c > 0 THEN {x} / (sum({x}) OVER c + count(*) FILTER ({x} > 0) OVER c) ELSE 0 END AS {x}_own,"
        f" CASE WHEN sum({x}) OVER c > 0 THEN count(*) FILTER ({x} > 0) OVER c / (sum({x}) OVER c + count(*) FILTER ({x} > 0) OVER c) ELSE 1 END AS {x}_back"
        for x in sides
    )

    def mixed(side: str) -> str:
        p = f"CAST(1 AS DOUBLE) / {alphabet}"
        for k in range(1, order + 2):
            p = f"(g{k}.{side}_own + g{k}.{side}_back * {p})"
        return p

    joins = " ".join(f"JOIN parts g{k} ON g{k}.k = {k} AND g{k}.gram = substr(w, {order + 2 - k})" for k in range(1, order + 2))
    step, reach = url_filter.STEP, url_filter.REACH
    return f"""
  WITH rests AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  urls AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
  ruled AS (SELECT *, CASE {rule} END AS rule, CASE {allow} END AS allow, translate(url, '123456789', '000000000') AS text FROM urls),
  texts AS (SELECT text, max(allow) AS allow, count(*) AS n, CAST('0x' || substr(md5(text), 1, 7) AS BIGINT) % 5 = 0 AS held FROM ruled GROUP BY text),
  runs AS (SELECT *, substr(repeat(chr(2), {order}) || text || chr(3), i, {order + 1}) AS w
           FROM (SELECT *, unnest(range(1, length(text) + 2)) AS i FROM texts)),
  counted AS (SELECT w, sum(CASE WHEN NOT held AND allow THEN n ELSE 0 END) AS yes, sum(CASE WHEN NOT held AND NOT allow THEN n ELSE 0 END) AS no
              FROM runs GROUP BY w),
  grams AS (SELECT k, substr(w, {order + 2} - k) AS gram, CAST(sum(yes) AS DOUBLE) AS yes, CAST(sum(no) AS DOUBLE) AS no
            FROM (SELECT *, unnest(range(1, {order + 2})) AS k FROM counted) GROUP BY ALL),
  parts AS (SELECT k, gram, {parts} FROM grams WINDOW c AS (PARTITION BY k, left(gram, k - 1))),
  ratios AS (SELECT w, ln({mixed("yes")}) - ln({mixed("no")}) AS ratio FROM counted {joins}),
  scored AS (SELECT text, any_value(allow) AS allow, any_value(held) AS held, avg(ratio) AS score FROM runs JOIN ratios USING (w) GROUP BY text),
  steps AS (SELECT CAST(round(greatest(least(score, {reach}), -{reach}) / {step}) AS INTEGER) AS step,
                   count(*) FILTER (allow) AS yes, count(*) FILTER (NOT allow) AS no FROM scored WHERE held AND allow IS NOT NULL GROUP BY 1),
  rated AS (SELECT step, 1 - coalesce(sum(yes) OVER b, 0) / sum(yes) OVER () + coalesce(sum(no) OVER b, 0) / sum(no) OVER () AS rate,
                   sum(yes) OVER () > 0 AND sum(no) OVER () > 0 AS whole
            FROM steps WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  best AS (SELECT coalesce((SELECT (step - 0.5) * {step} FROM rated WHERE whole ORDER BY round(rate, 12) DESC, abs(step), step LIMIT 1), 0) AS bound)
  SELECT page_id, host, path, rule, CASE WHEN coalesce(ruled.allow, score >= bound) THEN 'allow' ELSE 'block' END AS verdict, round(score, 6) AS score
  FROM ruled JOIN scored USING (text), best"""


def licenses_sql() -> str:
    rows = []
    for name, text in sorted(licenses.TEMPLATES.items()):
        words = re.findall(r"[a-z0-9]+", text.lower())
        runs = sorted({" ".join(words[i : i + licenses.WORDS]) for i in range(len(words) - licenses.WORDS + 1)})
        span = 1 << (len(runs) - 1).bit_length()
        rows += [f"({_text(name)}, {_text(r)}, {len(runs)}, {span})" for r in runs]
    width = licenses.WORDS
    return rf"""
  WITH templates(template, shingle, shingles, span) AS (VALUES {", ".join(rows)}),
  cut AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM documents),
  runs AS (SELECT doc_id, words, unnest(range(1, len(words) - {width - 2})) AS i FROM cut),
  hits AS (SELECT doc_id, i - 1 AS pos, template, shingles, span, shingle
           FROM (SELECT doc_id, i, array_to_string(words[i : i + {width - 1}], ' ') AS shingle FROM runs) JOIN templates USING (shingle)),
  placed AS (SELECT *, pos // span - unnest([0, 1]) AS w FROM hits),
  windows AS (SELECT doc_id, template, w, count(DISTINCT shingle) / any_value(shingles) AS containment, min(pos) AS first_word, max(pos) + {width - 1} AS last_word
              FROM placed WHERE w >= 0 OR pos < span GROUP BY ALL),
  fitting AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY containment DESC, first_word, last_word) AS place,
                     count(*) OVER (PARTITION BY doc_id, template) AS windows FROM windows WHERE containment >= {licenses.LEAST})
  SELECT doc_id, template, containment, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, windows FROM fitting WHERE place = 1"""
