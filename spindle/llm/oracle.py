"""DuckDB SQL of the text queries that SQL can state. It is written from the
contracts and methods, over the same tables, and shares only fixed values with
the operators."""

from __future__ import annotations

from spindle.llm import licenses, mixing, quality


def _rows(rows: list[tuple]) -> str:
    told = lambda v: str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)
    return ",\n".join("(" + ", ".join(map(told, r)) + ")" for r in rows)


_TEMPLATES = [(i, j, a, b, len(text.split(" ")) - 1, label, base)
              for i, (text, label, base) in enumerate(
                  [(t, n, True) for t, n in licenses.BASE] + [(t, n, False) for t, n in licenses.PASSAGES])
              for j, (a, b) in enumerate(zip(text.split(" "), text.split(" ")[1:]))]

LICENSES = rf"""
WITH tpl(template, tpos, a, b, grams, label, base) AS (VALUES
{_rows(_TEMPLATES)}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pos AS (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs),
votes AS (SELECT r, template, (i - 1) - tpos AS d, any_value(grams) AS grams, any_value(label) AS label,
                 any_value(base) AS base, bit_or(1::BIGINT << tpos) AS seen, min(i - 1) AS lo, max(i + 1) AS hi
          FROM pos JOIN tpl ON w[i] = a AND w[i + 1] = b GROUP BY 1, 2, 3),
marked AS (SELECT *, CASE WHEN base OR lag(d) OVER s IS NULL OR d - lag(d) OVER s > {licenses.NEIGHBOUR} THEN 1 ELSE 0 END AS starts
           FROM votes WINDOW s AS (PARTITION BY r, template ORDER BY d)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY r, template ORDER BY d) AS span FROM marked),
spans AS (SELECT r, template, span, any_value(grams) AS grams, any_value(label) AS label, any_value(base) AS base,
                 bit_count(bit_or(seen)) / any_value(grams)::DOUBLE AS cover, min(lo) AS lo, max(hi) AS hi
          FROM numbered GROUP BY 1, 2, 3),
ok AS (SELECT * FROM spans WHERE CASE WHEN base THEN cover = 1
         ELSE cover >= {licenses.COVER} AND hi - lo <= {licenses.STRETCH} * (grams + 1) END),
found AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(lo) FILTER (WHERE base) AS first_word,
                 max(lo) FILTER (WHERE base) AS last_word,
                 array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ',') AS base_labels,
                 array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(cover) AS score
          FROM ok GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (r)"""

MIXING = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY 1),
sums AS (SELECT sum(pow(n, {mixing.POWER})) AS w, sum(n) AS total FROM sizes),
rates AS (SELECT source, pow(n, {mixing.POWER}) * total / (w * n) AS rate FROM sizes, sums),
parts AS (SELECT source, greatest(1, ceil(rate / {mixing.PART}))::INT AS parts,
                 rate / greatest(1, ceil(rate / {mixing.PART})) AS m FROM rates),
steps AS (SELECT source, parts, m, 0 AS k, exp(-m) AS term, exp(-m) AS s FROM parts
          UNION ALL
          SELECT source, parts, m, k + 1, term * m / (k + 1), s + term * m / (k + 1) FROM steps
          WHERE k < (m + 12 * sqrt(m) + 30)::INT),
tables AS (SELECT source AS of, any_value(parts) AS parts, list(s ORDER BY k) AS cdf FROM steps GROUP BY 1),
named AS (SELECT * EXCLUDE (first_name, nth), first_name || CASE WHEN nth = 0 THEN '' ELSE '|' || nth END AS name
          FROM (SELECT *, row_number() OVER (PARTITION BY first_name) - 1 AS nth
                FROM (SELECT *, concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, ''))) AS first_name FROM documents))),
drawn AS (SELECT named.*, (SELECT sum(len(list_filter(cdf, lambda c: c <= u)))
            FROM (SELECT ('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', j::VARCHAR, name)), 1, 13))::BIGINT
                         / 4503599627370496.0 AS u FROM unnest(range(1, parts + 1)) t(j)))::INT AS copies
          FROM named JOIN tables ON named.source IS NOT DISTINCT FROM of)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INT AS copy FROM drawn"""

_VALUE = {r: "coalesce({} / nullif({}, 0), 0.0)".format(*[f"{c}::DOUBLE" for c in v.split(" / ")])
          for r, (v, _) in quality.RULES.items()}
_GRID = [(r, float(c)) for r, (_, cuts) in quality.RULES.items() for c in cuts]
_CASE = "CASE rule " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in _VALUE.items()) + " END"
_SHARE = quality.RISK / len(quality.RULES)

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
grams AS (SELECT r, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') AS g
          FROM (SELECT r, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM cut)),
twice AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cover AS (SELECT r, sum(step) AS n FROM (SELECT r, least({quality.WINDOW}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i,
            {quality.WINDOW})) AS step FROM twice) GROUP BY 1),
base AS (SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
         FROM cut LEFT JOIN cover USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
grid(rule, cutoff) AS (VALUES {_rows(_GRID)}),
held AS (SELECT j.*, quality = 1 AS good FROM judged j JOIN labels ON j.doc_id = labels.doc_id
         WHERE NOT base_failed AND quality IS NOT NULL),
tests AS (SELECT lang, rule, cutoff, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE NOT good) AS n_bad,
                 count(*) FILTER (WHERE good AND {_CASE} > cutoff) AS k,
                 count(*) FILTER (WHERE NOT good AND {_CASE} > cutoff) AS caught
          FROM held, grid GROUP BY 1, 2, 3),
gains AS (SELECT *, caught / greatest(n_bad, 1)::DOUBLE - k / greatest(n, 1)::DOUBLE AS gain FROM tests),
passed AS (SELECT * FROM gains WHERE n > 0 AND gain > 0 AND k <= n * {_SHARE!r}
           AND (SELECT sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({_SHARE!r})
                               + (n - x) * ln(1 - {_SHARE!r}))) FROM (SELECT unnest(range(0, k + 1)) AS x))
               <= {quality.ERROR / len(quality.RULES)!r} / (SELECT greatest(1, count(*)) FROM (SELECT DISTINCT lang FROM held))),
cuts AS (SELECT lang, rule, arg_max(cutoff, (round(gain, 9), cutoff)) AS cutoff FROM passed GROUP BY 1, 2),
wide AS (SELECT lang, {", ".join(f"max(cutoff) FILTER (WHERE rule = '{r}') AS cut_{r}" for r in quality.RULES)} FROM cuts GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(f"coalesce({v} > cut_{r}, false)" for r, v in _VALUE.items())}) AS kept
FROM judged LEFT JOIN wide ON judged.lang IS NOT DISTINCT FROM wide.lang"""

SEARCH = r"""
WITH cut AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT * FROM cut WHERE len(w) > 0),
size AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY 1, 2),
df AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
       FROM tf, size GROUP BY t, n_docs),
items AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark),
norm AS (SELECT r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM docs, size),
scored AS (SELECT i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM items JOIN df USING (t) JOIN tf USING (t) JOIN norm USING (r) GROUP BY 1, 2, 3, 4)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 10"""

NEGATIVES = """
WITH whole AS (SELECT row_number() OVER () AS r, vec_id, label::BIGINT AS label, embedding FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
q AS (SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM whole),
pairs AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
                 list_inner_product(a.v, b.v)::BIGINT AS score
          FROM q a, q b WHERE a.vec_id % 100 = 0 AND a.r <> b.r),
pos AS (SELECT ar, anchor_id, r AS pr, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, n.vec_id AS negative_id, positive_score,
       n.score AS negative_score
FROM pos p JOIN pairs n ON p.ar = n.ar AND NOT same
  AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.ar, pr ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 10"""

ORACLE: dict[str, str] = {
    "op1_license_scans": LICENSES,
    "op4_source_mixing": MIXING,
    "op7_quality_rules": QUALITY,
    "op11_ranked_search": SEARCH,
    "op12_hard_negatives": NEGATIVES,
}
