"""DuckDB SQL that recomputes each registered query from the raw tables.

The SQL is deliberately brute force (dense query x passage scoring, nested
containment tests): it is the independent check for the Spark plans at
sf0.01, not a second implementation to run at scale. Fragments are plain
CTE strings composed by ``with_(...)``.
"""

from __future__ import annotations

from ..functions.text import ASCII_PUNCT_CLASS, QUOTE_CHARS, UNICODE_SPACE_CLASS


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def ws_tokens(expr: str) -> str:
    return f"list_filter(string_split_regex(lower({expr}), '\\s+'), lambda t: t <> '')"


def word_tokens(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')"


def bigrams(toks: str) -> str:
    return (f"list_transform(range(1, len({toks})), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1])")


def normalize(expr: str) -> str:
    quotes = QUOTE_CHARS.replace("'", "''")
    spaces = " " * len(QUOTE_CHARS)
    return (f"trim(regexp_replace(regexp_replace(lower(translate({expr}, '{quotes}', '{spaces}')), "
            f"'{ASCII_PUNCT_CLASS}', '', 'g'), '{UNICODE_SPACE_CLASS}+', ' ', 'g'))")


PASSAGES = """passages AS (
  SELECT min(doc_id) AS passage_id, text, arg_min(lang, doc_id) AS lang,
         arg_min(source, doc_id) AS source, arg_min(n_chars, doc_id) AS n_chars
  FROM documents WHERE text IS NOT NULL GROUP BY text)"""

QUESTIONS = "q AS (SELECT item_id AS qid, text AS question FROM benchmark)"


def index_ctes(tokens_fn=ws_tokens, src: str = "passages", ip: str = "") -> list[str]:
    return [
        f"{ip}ptok AS (SELECT passage_id, {tokens_fn('text')} AS toks FROM {src})",
        f"{ip}lens AS (SELECT passage_id, len(toks) AS dl FROM {ip}ptok)",
        f"{ip}stats AS (SELECT count(*) AS n, sum(dl)::DOUBLE / count(*) AS avgdl FROM {ip}lens)",
        f"{ip}post AS (SELECT term, passage_id, count(*) AS tf FROM "
        f"(SELECT passage_id, unnest(toks) AS term FROM {ip}ptok) GROUP BY ALL)",
        f"{ip}vocab AS (SELECT term, count(*) AS df FROM {ip}post GROUP BY term)",
    ]


def qterm_ctes(tokens_fn=ws_tokens, src: str = "q") -> list[str]:
    return [f"qt AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({tokens_fn('question')}) "
            f"AS term FROM {src}) GROUP BY ALL)"]


def bm25_ctes(variant: str, p: str = "", ip: str = "") -> list[str]:
    """CTEs ending in ``{p}scores(qid, passage_id, score, matched)`` -- dense, all pairs."""
    norm = "(1.5 * (0.25 + 0.75 * l.dl / s.avgdl))"
    if variant == "okapi":
        idf = [
            f"{p}idf0 AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM {ip}vocab, {ip}stats)",
            f"{p}mean_idf AS (SELECT avg(raw) AS m FROM {p}idf0)",
            f"{p}idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END AS idf FROM {p}idf0, {p}mean_idf)",
        ]
        contrib = f"qt.qtf * i.idf * p.tf * 2.5 / (p.tf + {norm})"
        base = "0.0"
    elif variant == "plus":
        idf = [f"{p}idf AS (SELECT term, ln((n + 1.0) / df) AS idf FROM {ip}vocab, {ip}stats)"]
        contrib = f"qt.qtf * i.idf * (p.tf * 2.5 / ({norm} + p.tf))"
        base = "qt.qtf * i.idf * 1.0"
    elif variant == "l":
        idf = [f"{p}idf AS (SELECT term, ln(n + 1.0) - ln(df + 0.5) AS idf FROM {ip}vocab, {ip}stats)"]
        c = "(p.tf / (0.25 + 0.75 * l.dl / s.avgdl))"
        contrib = f"qt.qtf * i.idf * 2.5 * (({c} + 0.5) / (1.5 + {c} + 0.5) - 0.5 / (1.5 + 0.5))"
        base = "qt.qtf * i.idf * 2.5 * 0.5 / (1.5 + 0.5)"
    elif variant == "server":
        idf = [f"{p}idf AS (SELECT term, ln(1.0 + (n - df + 0.5) / (df + 0.5)) AS idf FROM {ip}vocab, {ip}stats)"]
        norm = "(1.2 * (0.25 + 0.75 * l.dl / s.avgdl))"
        contrib = f"qt.qtf * i.idf * p.tf / (p.tf + {norm})"
        base = "0.0"
    else:
        raise ValueError(variant)
    return idf + [
        f"{p}qbase AS (SELECT q.qid, coalesce(sum({base}), 0.0) AS b0 FROM q "
        f"LEFT JOIN (qt JOIN {p}idf i USING (term)) ON qt.qid = q.qid GROUP BY q.qid)",
        f"{p}msum AS (SELECT qt.qid, p.passage_id, sum({contrib}) AS s FROM qt JOIN {p}idf i USING (term) "
        f"JOIN {ip}post p USING (term) JOIN {ip}lens l USING (passage_id), {ip}stats s GROUP BY ALL)",
        f"{p}scores AS (SELECT q.qid, l.passage_id, round(qb.b0 + coalesce(m.s, 0.0), 6) AS score, "
        f"m.s IS NOT NULL AS matched FROM q JOIN {p}qbase qb USING (qid) CROSS JOIN {ip}lens l "
        f"LEFT JOIN {p}msum m ON m.qid = q.qid AND m.passage_id = l.passage_id)",
    ]


def tfidf_ctes(max_features: int = 50_000, p: str = "") -> list[str]:
    grams = f"list_concat(toks, {bigrams('toks')})"
    return [
        f"gtok AS (SELECT passage_id, {grams} AS g FROM (SELECT passage_id, {ws_tokens('text')} AS toks FROM passages))",
        "gpost AS (SELECT term, passage_id, count(*) AS tf FROM (SELECT passage_id, unnest(g) AS term FROM gtok) GROUP BY ALL)",
        f"tvocab AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM gpost GROUP BY term ORDER BY cf DESC, term LIMIT {max_features})",
        "tn AS (SELECT count(*) AS n FROM passages)",
        "tidf AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM tvocab, tn)",
        "tw AS (SELECT p.term, p.passage_id, p.tf * i.idf AS w FROM gpost p JOIN tidf i USING (term))",
        "tpost AS (SELECT term, passage_id, w / sqrt(sum(w * w) OVER (PARTITION BY passage_id)) AS w FROM tw)",
        f"qg AS (SELECT qid, unnest(list_concat(toks, {bigrams('toks')})) AS term FROM "
        f"(SELECT qid, {ws_tokens('question')} AS toks FROM q))",
        "qgt AS (SELECT qid, term, count(*) AS qtf FROM qg GROUP BY ALL)",
        "qw0 AS (SELECT qid, term, qtf * idf AS qw FROM qgt JOIN tidf USING (term))",
        "qw AS (SELECT qid, term, qw / sqrt(sum(qw * qw) OVER (PARTITION BY qid)) AS qw FROM qw0)",
        "tsum AS (SELECT qid, passage_id, round(sum(qw * w), 6) AS s FROM qw JOIN tpost USING (term) GROUP BY ALL)",
        f"{p}scores AS (SELECT q.qid, p.passage_id, coalesce(t.s, 0.0) AS score, t.s IS NOT NULL AS matched "
        "FROM q CROSS JOIN passages p LEFT JOIN tsum t ON t.qid = q.qid AND t.passage_id = p.passage_id)",
    ]


def topk_select(k: int, where: str = "TRUE", src: str = "scores") -> str:
    return (f"SELECT qid::BIGINT AS qid, rank::INTEGER AS rank, passage_id::BIGINT AS passage_id, "
            f"score::DOUBLE AS score FROM (SELECT *, row_number() OVER (PARTITION BY qid "
            f"ORDER BY score DESC, passage_id) AS rank FROM {src} WHERE {where}) WHERE rank <= {k}")


def topk_cte(k: int, name: str = "topk", where: str = "TRUE", src: str = "scores") -> str:
    return f"{name} AS ({topk_select(k, where, src)})"


def chars(expr: str) -> str:
    n = f"replace({normalize(expr)}, ' ', '')"
    return f"(CASE WHEN {n} = '' THEN []::VARCHAR[] ELSE string_split({n}, '') END)"


def squad_tokens(expr: str) -> str:
    cleaned = (f"trim(regexp_replace(regexp_replace(lower({expr}), '{ASCII_PUNCT_CLASS}', '', 'g'), "
               f"'{UNICODE_SPACE_CLASS}+', ' ', 'g'))")
    return f"list_filter(string_split({cleaned}, ' '), lambda w: w <> '' AND w NOT IN ('a', 'an', 'the'))"


def common(p: str, g: str) -> str:
    return (f"coalesce(list_sum(list_transform(list_distinct({p}), lambda c: least("
            f"len(list_filter({p}, lambda x: x = c)), len(list_filter({g}, lambda x: x = c))))), 0)")


def f1_from(same: str, p: str, g: str) -> str:
    pr, rc = f"({same} / len({p}))", f"({same} / len({g}))"
    return f"(CASE WHEN {same} = 0 THEN 0.0 ELSE 2 * {pr} * {rc} / ({pr} + {rc}) END)"
