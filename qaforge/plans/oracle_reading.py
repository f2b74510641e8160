"""DuckDB oracle fragments for QA examples, windows and span decoding.

Row-wise SQL (one row per token / position / candidate pair), independent
of the array-expression plans the Spark side uses.
"""

from __future__ import annotations

from ..sources.fixtures import ANSWER_PATTERN, EXAMPLE_ID_STRIDE
from ..operators.windows import DOC_STRIDE, MAX_LEN, SPECIAL_TOKENS
from ..operators.spans import MAX_ANSWER_LEN, N_BEST

CAP0 = MAX_LEN - SPECIAL_TOKENS

EXAMPLES = f"""ex AS (
  SELECT u.conv_id * {EXAMPLE_ID_STRIDE} + u.turn AS example_id,
         (u.conv_id * {EXAMPLE_ID_STRIDE} + u.turn)::VARCHAR AS id,
         u.text AS question, coalesce(a.text, '') AS context,
         CASE WHEN a.text IS NOT NULL AND regexp_matches(a.text, '{ANSWER_PATTERN}')
              THEN [regexp_extract(a.text, '{ANSWER_PATTERN}', 2)] ELSE []::VARCHAR[] END AS ans_text,
         CASE WHEN a.text IS NOT NULL AND regexp_matches(a.text, '{ANSWER_PATTERN}')
              THEN [length(regexp_extract(a.text, '{ANSWER_PATTERN}', 1))::INTEGER] ELSE []::INTEGER[] END AS ans_start
  FROM conversations u
  LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a
         ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user')"""

TOKENS = [
    "pcs AS (SELECT example_id, unnest(list_transform(regexp_extract_all(context, '(\\S+|\\s+)', 1), "
    "lambda x, i: {'piece': x, 'i': i})) AS pc FROM ex)",
    "st AS (SELECT example_id, pc.i AS i, pc.piece AS piece, coalesce(sum(length(pc.piece)) OVER "
    "(PARTITION BY example_id ORDER BY pc.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM pcs)",
    "tok AS (SELECT example_id, row_number() OVER (PARTITION BY example_id ORDER BY i) - 1 AS t, s::BIGINT AS s, "
    "(s + length(piece))::BIGINT AS e FROM st WHERE regexp_matches(piece, '^\\S'))",
]

def windows_ctes(max_len: int = MAX_LEN) -> list[str]:
    cap = max_len - SPECIAL_TOKENS
    return [
    "exq AS (SELECT example_id, len(regexp_extract_all(question, '\\S+')) AS qn FROM ex)",
    "nt AS (SELECT example_id, count(*) AS n FROM tok GROUP BY 1)",
    f"wp AS (SELECT example_id, qn, {cap} - qn AS cap, {cap} - qn - {DOC_STRIDE} AS step, coalesce(n, 0) AS n "
    f"FROM exq LEFT JOIN nt USING (example_id) WHERE {cap} - qn - {DOC_STRIDE} > 0)",
    "win0 AS (SELECT example_id, qn, cap, step, n, unnest(range(0, ceil(greatest(n - cap, 0) / step)::BIGINT * step + 1, step)) "
    "AS first_token FROM wp)",
    "win AS (SELECT *, (first_token // step)::INTEGER AS wi, least(cap, n - first_token)::INTEGER AS n_ctx FROM win0)",
    ]


WINDOWS = windows_ctes()

CANDIDATES = [
    "pos AS (SELECT example_id, wi, qn, n_ctx, first_token, unnest(range(0, qn + 3 + n_ctx)) AS p FROM win)",
    "lg AS (SELECT example_id, wi, p, "
    "((example_id % 1000003 * 7919 + wi * 31 + p * 104729) % 2003)::DOUBLE / 100.0 AS sl, "
    "((example_id % 1000003 * 104729 + wi * 17 + p * 7919) % 2003)::DOUBLE / 100.0 AS el, "
    "CASE WHEN p >= qn + 2 AND p <= qn + 1 + n_ctx THEN first_token + p - qn - 2 END AS t FROM pos)",
    "lgo AS (SELECT lg.*, tok.s, tok.e FROM lg LEFT JOIN tok ON tok.example_id = lg.example_id AND tok.t = lg.t)",
    f"ss AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id, wi ORDER BY sl DESC, p) AS si "
    f"FROM lgo) WHERE si <= {N_BEST})",
    f"es AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id, wi ORDER BY el DESC, p) AS ei "
    f"FROM lgo) WHERE ei <= {N_BEST})",
    "cand AS (SELECT s.example_id, s.wi, s.si, e.ei, s.s AS s_off, e.e AS e_off, s.sl AS start_logit, "
    "e.el AS end_logit, s.sl + e.el AS score FROM ss s JOIN es e ON s.example_id = e.example_id "
    f"AND s.wi = e.wi WHERE s.s IS NOT NULL AND e.e IS NOT NULL AND e.p >= s.p AND e.p - s.p + 1 <= {MAX_ANSWER_LEN})",
]


def nbest_ctes(with_null: bool = False) -> list[str]:
    null = []
    src = "cand"
    if with_null:
        null = [
            "nul AS (SELECT example_id, 1073741824 AS wi, 0 AS si, 0 AS ei, 0 AS s_off, 0 AS e_off, "
            "start_logit, end_logit, score FROM (SELECT example_id, wi, sl AS start_logit, el AS end_logit, "
            "sl + el AS score, row_number() OVER (PARTITION BY example_id ORDER BY sl + el, wi) AS r "
            "FROM lg WHERE p = 0) WHERE r = 1)",
            "cand2 AS (SELECT * FROM cand UNION ALL SELECT * FROM nul)",
        ]
        src = "cand2"
    kept = [f"kept0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, "
            f"wi, si, ei) AS rank FROM {src}) WHERE rank <= {N_BEST})"]
    if with_null:
        kept.append(f"kept AS (SELECT * FROM kept0 UNION ALL SELECT *, {N_BEST + 1} AS rank FROM nul "
                    "WHERE example_id NOT IN (SELECT example_id FROM kept0 WHERE wi = 1073741824))")
    else:
        kept.append("kept AS (SELECT * FROM kept0)")
    return null + kept + [
        "kt AS (SELECT k.example_id, k.rank, CASE WHEN k.wi = 1073741824 THEN '' ELSE "
        "substring(ex.context, k.s_off + 1, k.e_off - k.s_off) END AS text, k.start_logit, k.end_logit, "
        "k.score, k.wi = 1073741824 AS is_null FROM kept k JOIN ex USING (example_id))",
        "kst AS (SELECT example_id, count(*) AS n, max(length(text)) AS maxlen FROM kt GROUP BY 1)",
        "fb AS (SELECT h.example_id, 0 AS rank, 'empty' AS text, 0.0::DOUBLE AS start_logit, 0.0::DOUBLE AS end_logit, "
        "0.0::DOUBLE AS score, false AS is_null FROM ex h LEFT JOIN kst USING (example_id) "
        "WHERE kst.n IS NULL OR (kst.n = 1 AND kst.maxlen = 0))",
        "allr AS (SELECT * FROM kt UNION ALL SELECT * FROM fb)",
        "mx AS (SELECT *, exp(score - max(score) OVER (PARTITION BY example_id)) AS ex FROM allr)",
        "nb AS (SELECT example_id, row_number() OVER (PARTITION BY example_id ORDER BY rank)::INTEGER AS rank, "
        "text, start_logit, end_logit, score, is_null, ex / sum(ex) OVER (PARTITION BY example_id) AS probability FROM mx)",
    ]


def reading_ctes(with_null: bool = False) -> list[str]:
    return [EXAMPLES, *TOKENS, *WINDOWS, *CANDIDATES, *nbest_ctes(with_null)]
