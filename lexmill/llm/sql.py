"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .quality_rules import FAR, INNER, MEASURES, OUTER, SHRINK, SIDES, SIZES, STRIKES, TAIL

OP2 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(12 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n>')) + 1
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""


def _op4() -> str:
    binned = lambda k: f"(({k} >> greatest(length(bin({k})) - 7, 0)) << greatest(length(bin({k})) - 7, 0))"
    each = " UNION ALL ".join(f"SELECT lang_, source_, '{k}' AS measure, {binned(k)} AS bin FROM shares WHERE NOT base_failed" for k in (*MEASURES, *SIZES))
    strikes = " + ".join(f"CASE WHEN {k} < {k}_il OR {k} > {k}_ih THEN 1 ELSE 0 END" for k in MEASURES)
    far = " OR ".join(f"{k} < {k}_ol OR {k} > {k}_oh" for k in MEASURES)
    sides = [f"{k}_{s}" for k in MEASURES for s in SIDES]
    drawn = ", ".join(f"(t0 * {s}0 + {SHRINK} * ((t1 * {s}1 + {SHRINK} * {s}2) / (t1 + {SHRINK}))) / (t0 + {SHRINK}) AS {s}" for s in sides)

    def fences(name: str, by: str, tag: int) -> str:
        keys = f"{by}, " if by else ""
        q = lambda k, num: f"CAST(min(CASE WHEN measure = '{k}' AND c * 100 >= t * {num} THEN bin END) AS DOUBLE)"
        at = [f"{q(k, x)} AS {k}_{n}" for k in MEASURES for n, x in (("lo", 100 - TAIL), ("mid", 50), ("hi", TAIL), ("fl", 100 - FAR), ("fh", FAR))] + [f"{q(k, 50)} AS {k}_mid" for k in SIZES]
        power = lambda x, times: x if times == 1 else power(f"({x} * {x})", times // 2)
        ratios, out = [], []
        for k, (top, size, unit) in MEASURES.items():
            lo, mid, hi, fl, fh = (f"{k}_{x}" for x in ("lo", "mid", "hi", "fl", "fh"))
            one = f"({unit} / {size}_mid)" if top else f"({unit} / sqrt({size}_mid))"
            odds = (lambda x: f"(({x} + {one}) / ({top} + {one} - {x}))") if top else (lambda x: f"({x})")
            least = lambda x: f"{odds(f'greatest({x} - {one}, 0::DOUBLE)')} / {odds(mid)}"
            most = lambda x: f"{odds(f'least({x} + {one}, {top}::DOUBLE)' if top else f'{x} + {one}')} / {odds(mid)}"
            ratios += [f"{one} AS {k}_one", f"{odds(mid)} AS {k}_at", f"{least(lo)} AS {k}_l", f"{least(mid)} AS {k}_l1", f"{most(hi)} AS {k}_h", f"{most(mid)} AS {k}_h1"]

            def fence(ratio: str, times: int) -> str:
                x = f"({k}_at * {power(f'{k}_{ratio}', times)})"
                return f"(({x} * ({top} + {k}_one) - {k}_one) / ({x} + 1))" if top else x

            ends = (
                f"least(2 * {lo} - {mid}, {fence('l1', INNER)}, {lo})",
                f"greatest(2 * {hi} - {mid}, {fence('h1', INNER)}, {hi})",
                f"least(greatest(2 * {fl} - {mid}, {fence('l', OUTER)}), {fence('l1', OUTER)}, {lo})",
                f"greatest(least(2 * {fh} - {mid}, {fence('h', OUTER)}), {fence('h1', OUTER)}, {hi})",
            )
            out += [(f"least({x}, {top - 1}::DOUBLE)" if top else x) + f" AS {k}_{side}{tag}" for side, x in zip(SIDES, ends, strict=True)]
        return f"""{name} AS (
  SELECT {keys}t AS t{tag}, {", ".join(out)}
  FROM (SELECT *, {", ".join(ratios)} FROM (SELECT {keys}max(t) AS t, {", ".join(at)}
    FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY {keys}measure ORDER BY bin) AS BIGINT) AS c, CAST(sum(n) OVER (PARTITION BY {keys}measure) AS BIGINT) AS t
          FROM (SELECT {keys}measure, bin, count(*) AS n FROM bins GROUP BY ALL)) GROUP BY {by or "()"})))"""

    return rf"""
WITH raw AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS lang_, coalesce('=' || source, '') AS source_, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM raw),
wins AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM parts WHERE len(words) >= 5)),
starts AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS j FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS k FROM wins) WHERE k > 1),
rep AS (SELECT rid, CAST(sum(least(5, coalesce(j - i, 5))) AS BIGINT) AS r FROM starts GROUP BY rid),
counts AS (
  SELECT rid, doc_id, lang_, source_, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS upper_, CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS bang,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words
  FROM parts LEFT JOIN rep USING (rid)),
shares AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_share,
    CASE WHEN word_chars > 0 THEN upper_ * 1000 // word_chars ELSE 0 END AS upper_share,
    CASE WHEN word_chars > 0 THEN bang * 1000 // word_chars ELSE 0 END AS bang_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_share,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_share,
    CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length FROM counts),
bins AS ({each}),
{fences("fine", "lang_, source_", 0)},
{fences("coarse", "lang_", 1)},
{fences("every", "", 2)},
fences AS (SELECT lang_, source_, {drawn} FROM fine JOIN coarse USING (lang_) CROSS JOIN every)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(({strikes}) <= {STRIKES} AND NOT ({far}), FALSE) AS kept
FROM shares LEFT JOIN fences USING (lang_, source_)
"""


OP12 = r"""
WITH said AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM said),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || text[:a] || '<S>' || text[b + 1:] || '<M>' || text[a + 1:b]
    ELSE '<S>' || text[b + 1:] || '<P>' || text[:a] || '<M>' || text[a + 1:b] END) AS output_sha256, sha256(text) AS restored_sha256
FROM formed
"""

_WORDS = 5
OP13 = rf"""
WITH said AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece FROM said)),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT lang, w, unnest(range(1, {_WORDS + 1})) AS size FROM pieces) WHERE len(w) >= size)),
often AS (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, size, phrase, f, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1)),
scores AS (SELECT c.lang, c.size, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r, n, 1000 * c.f * n // (l.f * r.f) AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = x JOIN often r ON r.lang = c.lang AND r.phrase = y JOIN total t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
within AS (SELECT DISTINCT lang, part, f FROM (
  SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS part
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM often WHERE size > 2))))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
  WHERE NOT EXISTS (SELECT 1 FROM within w WHERE w.lang = lowest.lang AND w.part = lowest.phrase AND w.f >= lowest.a))
WHERE rank <= 2000
"""


SQL = {"op2_chat_formatting": OP2, "op4_quality_rules": _op4(), "op12_fill_in_middle": OP12, "op13_phrase_collocations": OP13}
