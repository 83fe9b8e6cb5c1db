"""DuckDB SQL of ``op9_quality_rules`` (also the first stage's rows)."""

from edumart.llm.quality_rules import FENCE, MIN_DOCS, RULES, SUB_BITS

_RULES = ", ".join(f"('{r}', {p}, {size})" for r, (p, size) in RULES.items())
_BUCKET = (f"(value - value % (CASE WHEN value < {1 << SUB_BITS} THEN 1 ELSE "
           f"pow(2, length(bin(value)) - {SUB_BITS})::BIGINT END))")


def _fences(keys: str, source: str) -> str:
    by = f"{keys}, " if keys else ""
    same = " AND ".join(f"q.{k} IS NOT DISTINCT FROM w.{k}" for k in keys.split(", ") if k) or "true"
    return f"""
  SELECT {", ".join(f"q.{k}" for k in keys.split(", ") if k)}{", " if keys else ""}q.rule, max(docs) AS docs,
    (min(edge) FILTER (upto * 100 >= docs * p) + {FENCE} * greatest(
      min(edge) FILTER (upto * 100 >= docs * p) - min(edge) FILTER (upto * 100 >= docs * 50),
      10000 * max(size) // max(w.words)))::BIGINT AS fence
  FROM (SELECT {by}rule, edge, sum(n) OVER (PARTITION BY {by}rule ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY {by}rule) AS docs
        FROM (SELECT {by}rule, edge, sum(n) AS n FROM {source} GROUP BY ALL)) q
  JOIN (VALUES {_RULES}) x(r, p, size) ON x.r = q.rule
  JOIN (SELECT {by}min(edge) FILTER (upto * 2 >= docs) AS words
        FROM (SELECT {by}edge, sum(n) OVER ({f"PARTITION BY {keys} " if keys else ""}ORDER BY edge) AS upto,
                     sum(n) OVER ({f"PARTITION BY {keys}" if keys else ""}) AS docs
              FROM (SELECT {by}edge, sum(n) AS n FROM {source} WHERE rule = 'words' GROUP BY ALL)) GROUP BY ALL) w ON {same}
  GROUP BY ALL"""


QUALITY_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM t),
win AS (SELECT r, i, list_aggregate(w[i:i+7], 'string_agg', ' ') AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM s WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n FROM (
          SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
m AS (SELECT s.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM s LEFT JOIN rep ON rep.r = s.r),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
v AS (SELECT r, lang, source, base_failed, rule,
        CASE WHEN rule = 'words' THEN x WHEN n_words = 0 THEN 0 ELSE x * 10000 // n_words END AS value FROM (
        SELECT r, lang, source, base_failed, n_words, unnest(['symbols', 'dup_lines', 'repeats', 'long_words', 'words']) AS rule,
               unnest([n_symbols, n_dup_lines, n_repeat_words, word_chars, n_words]) AS x FROM b)),
sk AS (SELECT lang, source, rule, {_BUCKET} AS edge, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
own AS ({_fences("lang, source", "sk")}),
lng AS ({_fences("lang", "sk")}),
allf AS ({_fences("", "sk")}),
th AS (SELECT own.lang, own.source, own.rule,
         CASE WHEN own.docs >= {MIN_DOCS} THEN own.fence WHEN lng.docs >= {MIN_DOCS} THEN lng.fence ELSE allf.fence END AS fence
       FROM own JOIN lng ON own.lang IS NOT DISTINCT FROM lng.lang AND own.rule = lng.rule JOIN allf ON allf.rule = own.rule),
bad AS (SELECT r, string_agg(v.rule, ',' ORDER BY list_position(['symbols', 'dup_lines', 'repeats', 'long_words'], v.rule)) AS failed
        FROM v JOIN th ON v.lang IS NOT DISTINCT FROM th.lang AND v.source IS NOT DISTINCT FROM th.source AND v.rule = th.rule
        WHERE value > fence GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed
FROM b LEFT JOIN bad ON bad.r = b.r"""
