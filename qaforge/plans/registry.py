"""Registered queries: one Spark callable per operator, plus its DuckDB oracle.

Every callable takes ``(spark, sf_dir)`` and reads the given tables whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import retrieve as R
from ..sources import fixtures as FX
from ..sources import index_store as IS
from ..session import materialize
from . import oracle as O

K = R.DEFAULT_K

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def corpus_index(spark: SparkSession, sf_dir: str, kind: str = "bm25", tokenizer: str = "whitespace"):
    """The stored index of the distinct passages; found by the file listing of ``documents``."""
    return IS.shared_index(FX.passages(spark, sf_dir), kind, tokenizer, FX.source_key(spark, sf_dir, "documents", "passages"))


# --- step 0/1: BM25 family -------------------------------------------------

def _bm25(variant: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        index = corpus_index(spark, sf_dir)
        return R.bm25_topk(index, FX.questions(spark, sf_dir), K, variant)
    return run


for _name, _variant in [("bm25_okapi_topk", "okapi"), ("bm25_plus_topk", "plus"),
                        ("bm25l_topk", "l")]:
    register(_name, O.with_(O.PASSAGES, O.QUESTIONS, *O.index_ctes(), *O.qterm_ctes(),
                            *O.bm25_ctes(_variant)) + O.topk_select(K))(_bm25(_variant))


@register("bounded_bm25_topk", ORACLE["bm25_okapi_topk"])
def bounded_bm25_topk(spark, sf_dir):
    """Okapi top-k that sums weak, frequent terms only for passages that can still be among the best."""
    return R.bm25_topk(corpus_index(spark, sf_dir), FX.questions(spark, sf_dir), K, "okapi", bounded=True)


@register("server_bm25_topk",
          O.with_(O.PASSAGES, O.QUESTIONS, *O.index_ctes(O.word_tokens),
                  *O.qterm_ctes(O.word_tokens), *O.bm25_ctes("server"))
          + O.topk_select(K, where="matched"))
def server_bm25_topk(spark, sf_dir):
    index = corpus_index(spark, sf_dir, "bm25", "word")
    return R.server_topk(index, FX.questions(spark, sf_dir), K)


@register("unmatched_queries",
          O.with_(O.PASSAGES, "q AS (SELECT page_id AS qid, replace(url, '/', ' ') AS question FROM pages)",
                  *O.index_ctes(), *O.qterm_ctes())
          + "SELECT qid::BIGINT AS qid, question FROM q WHERE qid NOT IN "
            "(SELECT qid FROM qt JOIN vocab USING (term))")
def unmatched_queries(spark, sf_dir):
    """Page addresses as questions: their words are often in no passage."""
    urls = table(spark, sf_dir, "pages").select(F.col("page_id").alias("qid"), F.replace("url", F.lit("/"), F.lit(" ")).alias("question"))
    return R.unmatched_queries(corpus_index(spark, sf_dir), urls)


@register("tfidf_topk", O.with_(O.PASSAGES, O.QUESTIONS, *O.tfidf_ctes()) + O.topk_select(K))
def tfidf_topk(spark, sf_dir):
    index = corpus_index(spark, sf_dir, "tfidf")
    return R.tfidf_topk(index, FX.questions(spark, sf_dir), K)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# --- step 2: vocabulary cap, paragraph TF-IDF --------------------------------

from ..functions.text import whitespace_tokens  # noqa: E402
from ..operators.corpus import paragraphs  # noqa: E402
from ..operators.index import most_frequent, terms_of  # noqa: E402
from ..sources.tables import table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

STORE_K = 10
PARAGRAPH_BITS = 24  # paragraph key = document_id shifted left + position


@register("vocab_top_terms",
          O.with_(O.PASSAGES, *O.tfidf_ctes()[:3])
          + "SELECT term, cf::BIGINT AS cf, df::BIGINT AS df FROM tvocab")
def vocab_top_terms(spark, sf_dir):
    best, _ = most_frequent(FX.passages(spark, sf_dir), terms_of(whitespace_tokens, ngrams=True), 50_000)
    return best.select("term", F.col("cf").cast("long"), F.col("df").cast("long"))


def paragraph_table(spark, sf_dir, delimiter="\n"):
    paras = paragraphs(table(spark, sf_dir, "documents"), delimiter=delimiter)
    fits = (F.col("paragraph_pos") < 1 << PARAGRAPH_BITS) & (F.abs("document_id") < 1 << (63 - PARAGRAPH_BITS))
    key = F.shiftleft("document_id", PARAGRAPH_BITS) + F.col("paragraph_pos")
    return paras.withColumn("passage_id", F.when(fits, key).otherwise(
        F.raise_error(F.lit("paragraph key out of range")).cast("long"))).withColumnRenamed("content", "text")


PARAGRAPHS_SQL = (
    "passages AS (SELECT document_id, paragraph_pos, document_id * 16777216 + paragraph_pos AS passage_id, "
    "content AS text FROM (SELECT doc_id AS document_id, unnest(parts) AS content, "
    "unnest(range(len(parts)))::INTEGER AS paragraph_pos FROM (SELECT doc_id, string_split(text, chr(10)) AS parts "
    "FROM documents WHERE text IS NOT NULL)) WHERE regexp_matches(content, '\\S'))")


@register("paragraph_tfidf_topk",
          O.with_(PARAGRAPHS_SQL, O.QUESTIONS, *O.tfidf_ctes(), O.topk_cte(STORE_K))
          + "SELECT t.qid, t.rank, p.document_id::BIGINT AS document_id, p.paragraph_pos, t.score "
            "FROM topk t JOIN passages p USING (passage_id)")
def paragraph_tfidf_topk(spark, sf_dir):
    paras = paragraph_table(spark, sf_dir)
    ST.tfidf_store_guard(filters=None, scale_score=False)  # the retriever takes neither
    index = IS.shared_index(paras, "tfidf", source_key=FX.source_key(spark, sf_dir, "documents", "paragraphs"))
    ranked = R.tfidf_topk(index, FX.questions(spark, sf_dir), STORE_K)
    return ranked.select("qid", "rank",
                         F.shiftright("passage_id", PARAGRAPH_BITS).alias("document_id"),
                         F.col("passage_id").bitwiseAND(F.lit((1 << PARAGRAPH_BITS) - 1)).cast("int").alias("paragraph_pos"),
                         "score")


# --- step 3: min-max, ensemble, assembled contexts ---------------------------

from ..operators import ensemble as EN  # noqa: E402
from ..operators import assemble as AS  # noqa: E402
from ..operators import relevance as RV  # noqa: E402


def _three_lists(spark, sf_dir, k=K):
    qs = FX.questions(spark, sf_dir)
    bm, tf = corpus_index(spark, sf_dir), corpus_index(spark, sf_dir, "tfidf")
    bm25 = R.bm25_lists(bm, qs, ("okapi", "plus"), k)
    return {"tfidf": R.tfidf_topk(tf, qs, k), "bm25": bm25["okapi"], "bm25_plus": bm25["plus"]}


THREE_LISTS_SQL = [O.PASSAGES, O.QUESTIONS, *O.index_ctes(), *O.qterm_ctes(),
                   *O.bm25_ctes("okapi", "o_"), *O.bm25_ctes("plus", "p_"), *O.tfidf_ctes(p="t_"),
                   O.topk_cte(K, "t_top", src="t_scores"), O.topk_cte(K, "o_top", src="o_scores"),
                   O.topk_cte(K, "p_top", src="p_scores"),
                   "lists AS (SELECT *, 'tfidf' AS retriever, 0 AS r_idx FROM t_top UNION ALL "
                   "SELECT *, 'bm25', 1 FROM o_top UNION ALL SELECT *, 'bm25_plus', 2 FROM p_top)",
                   "scaled AS (SELECT *, round(CASE WHEN max(score) OVER w = min(score) OVER w THEN 0.0 "
                   "ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) "
                   "AS scaled FROM lists WINDOW w AS (PARTITION BY qid, r_idx))"]


@register("minmax_scores", O.with_(*THREE_LISTS_SQL)
          + "SELECT qid, retriever, rank, passage_id, score, scaled FROM scaled")
def minmax_scores(spark, sf_dir):
    parts = [df.withColumn("retriever", F.lit(name)) for name, df in _three_lists(spark, sf_dir).items()]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return EN.minmax_scaled(union).select("qid", "retriever", "rank", "passage_id", "score", "scaled")


ENSEMBLE_SQL = O.with_(
    *THREE_LISTS_SQL,
    "best AS (SELECT qid, passage_id, scaled AS score, r_idx * 1000000 + rank AS pos FROM "
    "(SELECT *, row_number() OVER (PARTITION BY qid, passage_id ORDER BY scaled DESC, "
    "r_idx * 1000000 + rank) AS rn FROM scaled) WHERE rn = 1)") + (
    f"SELECT qid::BIGINT AS qid, rank::INTEGER AS rank, passage_id::BIGINT AS passage_id, score "
    f"FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos) AS rank FROM best) "
    f"WHERE rank <= {K}")


@register("ensemble_topk", ENSEMBLE_SQL)
def ensemble_topk(spark, sf_dir):
    return EN.max_merge(_three_lists(spark, sf_dir), K)


CONTEXTS_SQL = [O.PASSAGES, O.QUESTIONS, *O.index_ctes(), *O.qterm_ctes(), *O.bm25_ctes("okapi"),
                O.topk_cte(K),
                "ctx AS (SELECT t.qid, any_value(q.question) AS question, "
                "string_agg(t.passage_id::VARCHAR, ',' ORDER BY t.rank) AS context_ids, "
                "string_agg(p.text, ' ' ORDER BY t.rank) AS context, "
                "coalesce(min(t.rank) FILTER (WHERE contains(p.text, q.question)), 0)::INTEGER - 1 AS containing_index, "
                "coalesce(min(t.rank) FILTER (WHERE p.text = q.question), 0)::INTEGER - 1 AS answer_index, "
                "min(t.score) AS lo, max(t.score) AS hi, "
                "min(t.score) FILTER (WHERE contains(p.text, q.question) AND t.rank = "
                "(SELECT min(t2.rank) FROM topk t2 JOIN passages p2 USING (passage_id) "
                "WHERE t2.qid = t.qid AND contains(p2.text, q.question))) AS at_score "
                "FROM topk t JOIN passages p USING (passage_id) JOIN q USING (qid) GROUP BY t.qid)"]


def _okapi_contexts(spark, sf_dir):
    psg = FX.passages(spark, sf_dir)
    qs = FX.questions(spark, sf_dir)
    ranked = R.bm25_topk(corpus_index(spark, sf_dir), qs, K, "okapi")
    return AS.assemble(AS.with_text(ranked, psg, bound_rows=qs.count() * K), qs, gold_col="question")


@register("retrieved_contexts", O.with_(*CONTEXTS_SQL)
          + "SELECT qid::BIGINT AS qid, context_ids, context, contains(context, question) AS contained, "
            "answer_index, containing_index FROM ctx")
def retrieved_contexts(spark, sf_dir):
    out = _okapi_contexts(spark, sf_dir)
    return out.select("qid", F.array_join(F.transform("context_id", lambda x: x.cast("string")), ",")
                      .alias("context_ids"), "context", "contained", "answer_index", "containing_index")


# --- step 4: retrieval evaluation --------------------------------------------

@register("hit_rate", O.with_(*CONTEXTS_SQL)
          + "SELECT count(*) AS n_questions, sum(contains(context, question)::INTEGER)::BIGINT AS hits, "
            "round(avg(contains(context, question)::INTEGER::DOUBLE), 6) AS hit_rate FROM ctx")
def hit_rate(spark, sf_dir):
    return AS.hit_rate(_okapi_contexts(spark, sf_dir)).select("n_questions", "hits", "hit_rate")


@register("gold_score_mean", O.with_(*CONTEXTS_SQL)
          + "SELECT count(*) AS n_hits, round(avg(round(CASE WHEN hi = lo THEN 0.0 ELSE (at_score - lo) / (hi - lo) END, 6)), 6) "
            "AS gold_score_mean FROM ctx WHERE containing_index >= 0")
def gold_score_mean(spark, sf_dir):
    scaled = AS.gold_scaled_score(_okapi_contexts(spark, sf_dir))
    return scaled.agg(F.count(F.lit(1)).alias("n_hits"),
                      O_round(F.avg("gold_scaled")).alias("gold_score_mean"))


def O_round(c):
    return F.round(c, 6)


RANKING_SQL = O.with_(
    O.PASSAGES, O.QUESTIONS, *O.index_ctes(), *O.qterm_ctes(), *O.bm25_ctes("okapi"), O.topk_cte(K),
    "gold AS (SELECT q.qid, p.passage_id FROM q JOIN passages p ON contains(p.text, q.question))",
    "ng AS (SELECT qid, count(*) AS n_gold FROM gold GROUP BY qid)",
    "fl AS (SELECT t.*, (g.qid IS NOT NULL)::INTEGER AS rel FROM topk t LEFT JOIN gold g USING (qid, passage_id))",
    "fl2 AS (SELECT *, sum(rel) OVER (PARTITION BY qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel FROM fl)",
    "pq AS (SELECT qid, count(*) AS n_ret, sum(rel) AS n_hit, min(rank) FILTER (WHERE rel = 1) AS first_hit, "
    "sum(rel / log2(rank + 1.0)) AS dcg, sum(rel * cum_rel / rank) AS ap_sum FROM fl2 GROUP BY qid)",
    "m AS (SELECT least(n_hit, 1)::DOUBLE AS recall_single_hit, n_hit / n_gold AS recall_multi_hit, "
    "n_hit / n_ret AS precision, coalesce(1.0 / first_hit, 0.0) AS rr, ap_sum / n_gold AS ap, "
    "dcg / list_sum(list_transform(range(1, least(n_gold, n_ret) + 1), lambda i: 1.0 / log2(i + 1.0))) AS ndcg "
    "FROM pq JOIN ng USING (qid))") + (
    "SELECT count(*) AS n_questions, round(avg(recall_single_hit), 6) AS recall_single_hit, "
    "round(avg(recall_multi_hit), 6) AS recall_multi_hit, round(avg(precision), 6) AS precision, "
    "round(avg(rr), 6) AS mrr, round(avg(ap), 6) AS map, round(avg(ndcg), 6) AS ndcg FROM m")


@register("ranking_metrics", RANKING_SQL)
def ranking_metrics(spark, sf_dir):
    psg = FX.passages(spark, sf_dir)
    qs = FX.questions(spark, sf_dir)
    index = corpus_index(spark, sf_dir)
    ranked = R.bm25_topk(index, qs, K, "okapi")
    gold = materialize(RV.containing_passages(qs, psg, index), "gold-passages")  # read twice: counted, and met with the list
    return RV.ranking_metrics(ranked, gold)


# --- step 7/8: windows, alignment, span decoding ------------------------------

from ..operators import windows as WN  # noqa: E402
from ..operators import spans as SP  # noqa: E402
from . import oracle_reading as OR  # noqa: E402


def _features(spark, sf_dir, stored=False):
    """QA examples and their scored windows. The examples are dealt by id into as many parts as a shuffle has:
    their texts are short and the work on them is long, so parts by size would be few. ``stored``: the windows
    are written once, for a decoder that reads them twice."""
    ex = FX.qa_examples(spark, sf_dir)
    dealt = ex.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "example_id")
    feats = WN.synthetic_logits(WN.context_windows(dealt))
    return ex, materialize(feats, "features") if stored else feats


@register("context_windows", O.with_(OR.EXAMPLES, *OR.TOKENS, *OR.WINDOWS)
          + "SELECT w.example_id, w.wi AS \"window\", w.first_token::INTEGER AS first_token, w.n_ctx, "
            "coalesce(substring(ex.context, t1.s + 1, t2.e - t1.s), '') AS window_text FROM win w JOIN ex USING (example_id) "
            "LEFT JOIN tok t1 ON t1.example_id = w.example_id AND t1.t = w.first_token "
            "LEFT JOIN tok t2 ON t2.example_id = w.example_id AND t2.t = w.first_token + w.n_ctx - 1")
def context_windows(spark, sf_dir):
    ex = FX.qa_examples(spark, sf_dir)
    win = WN.context_windows(ex)
    first = F.get("offsets", F.col("qn") + 2)
    last = F.get("offsets", F.col("qn") + 1 + F.col("n_ctx"))
    return (win.join(ex.select("example_id", "context"), "example_id")
            .select("example_id", "window", "first_token", "n_ctx",
                    F.coalesce(F.substring("context", first["s"] + 1, last["e"] - first["s"]), F.lit(""))
                    .alias("window_text")))


ALIGN_SQL = O.with_(
    OR.EXAMPLES, *OR.TOKENS, *OR.WINDOWS,
    "g AS (SELECT example_id, ans_start[1] AS sc, ans_start[1] + length(ans_text[1]) AS ec FROM ex WHERE len(ans_start) > 0)",
    "wt AS (SELECT w.example_id, w.wi, w.qn, tok.t - w.first_token + w.qn + 2 AS p, tok.s, tok.e, "
    "w.first_token, w.n_ctx FROM win w JOIN tok ON tok.example_id = w.example_id "
    "AND tok.t BETWEEN w.first_token AND w.first_token + w.n_ctx - 1)",
    "al AS (SELECT wt.example_id, wt.wi, min(wt.s) AS fs, max(wt.e) AS le, "
    "max(wt.p) FILTER (WHERE wt.s <= g.sc) AS sp, min(wt.p) FILTER (WHERE wt.e >= g.ec) AS ep, "
    "any_value(g.sc) AS sc, any_value(g.ec) AS ec FROM wt JOIN g USING (example_id) GROUP BY 1, 2)") + (
    "SELECT w.example_id, w.wi AS \"window\", (CASE WHEN al.fs <= al.sc AND al.le >= al.ec THEN al.sp ELSE 0 END)::INTEGER "
    "AS start_position, (CASE WHEN al.fs <= al.sc AND al.le >= al.ec THEN al.ep ELSE 0 END)::INTEGER AS end_position "
    "FROM win w LEFT JOIN al USING (example_id, wi)")


@register("span_alignment", ALIGN_SQL)
def span_alignment(spark, sf_dir):
    ex = FX.qa_examples(spark, sf_dir)
    return WN.align_answers(WN.context_windows(ex), ex)


def _nbest(spark, sf_dir, with_null=False):
    ex, feats = _features(spark, sf_dir, stored=with_null)
    return SP.nbest(feats, ex, with_null=with_null)


@register("rejected_examples", O.with_(OR.EXAMPLES, OR.WINDOWS[0])
          + f"SELECT example_id, qn::INTEGER AS n_question_tokens FROM exq WHERE {OR.CAP0} - qn - {WN.DOC_STRIDE} <= 0")
def rejected_examples(spark, sf_dir):
    """Examples without a window: their question leaves no room for the context."""
    bad = WN.rejected_examples(FX.qa_examples(spark, sf_dir))
    return bad.select("example_id", WN.question_token_count(F.col("question")).alias("n_question_tokens"))


@register("span_nbest", O.with_(*OR.reading_ctes())
          + "SELECT example_id, rank, text, start_logit, end_logit, round(probability, 6) AS probability FROM nb")
def span_nbest(spark, sf_dir):
    return _nbest(spark, sf_dir).select("example_id", "rank", "text", "start_logit", "end_logit",
                                        F.round("probability", 6).alias("probability"))


BEST_SQL = O.with_(*OR.reading_ctes()) + \
    "SELECT ex.id, nb.text AS prediction_text FROM nb JOIN ex USING (example_id) WHERE nb.rank = 1"


@register("best_answers", BEST_SQL)
def best_answers(spark, sf_dir):
    ex = FX.qa_examples(spark, sf_dir)
    return (SP.best_answers(_nbest(spark, sf_dir)).join(ex.select("example_id", "id"), "example_id")
            .select("id", "prediction_text"))


@register("null_odds", O.with_(
    *OR.reading_ctes(with_null=True),
    "bn AS (SELECT example_id, arg_min(start_logit, rank) AS bs, arg_min(end_logit, rank) AS be, "
    "arg_min(text, rank) AS bt FROM nb WHERE text <> '' GROUP BY 1)",
    "ns AS (SELECT example_id, max(score) FILTER (WHERE is_null) AS null_score FROM nb GROUP BY 1)") + (
    "SELECT ex.id, round(ns.null_score - bn.bs - bn.be, 6) AS score_diff, "
    "CASE WHEN bn.bt IS NULL OR ns.null_score - bn.bs - bn.be > 0.0 THEN '' ELSE bn.bt END AS prediction_text "
    "FROM ns LEFT JOIN bn USING (example_id) JOIN ex USING (example_id)"))
def null_odds(spark, sf_dir):
    ex = FX.qa_examples(spark, sf_dir)
    return (SP.null_odds(_nbest(spark, sf_dir, with_null=True))
            .join(ex.select("example_id", "id"), "example_id")
            .select("id", F.round("score_diff", 6).alias("score_diff"), "prediction_text"))


# --- step 6: answer normalization and scoring -------------------------------

from ..operators import metrics as MT  # noqa: E402
from ..functions import text as TX  # noqa: E402


@register("normalize_answers",
          f"SELECT conv_id, turn, {O.normalize('text')} AS normalized FROM conversations")
def normalize_answers(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", TX.normalize_answer(F.col("text")).alias("normalized"))


def _gold_and_preds(spark, sf_dir):
    ex = FX.qa_examples(spark, sf_dir)
    preds = (SP.best_answers(_nbest(spark, sf_dir)).join(ex.select("example_id", "id"), "example_id")
             .select("id", "prediction_text"))
    return ex, preds


SCORE_CTES = [
    *OR.reading_ctes(),
    "pr AS (SELECT ex.id, nb.text AS pred FROM nb JOIN ex USING (example_id) WHERE nb.rank = 1)",
    "gx AS (SELECT id, unnest(ans_text) AS g FROM ex)",
    f"pc AS (SELECT gx.id, ({O.normalize('pr.pred')} = {O.normalize('gx.g')})::INTEGER AS em, "
    f"{O.chars('pr.pred')} AS pch, {O.chars('gx.g')} AS gch FROM gx JOIN pr USING (id))",
    f"pc2 AS (SELECT *, {O.common('pch', 'gch')} AS same FROM pc)",
    f"pf AS (SELECT id, max(em) AS em, max({O.f1_from('same', 'pch', 'gch')}) AS f1 FROM pc2 GROUP BY id)",
    "per AS (SELECT ex.id, pr.pred AS prediction_text, coalesce(pf.em, 0)::DOUBLE AS em, "
    "coalesce(pf.f1, 0.0)::DOUBLE AS f1, pr.id IS NOT NULL AS answered "
    "FROM ex LEFT JOIN pr USING (id) LEFT JOIN pf USING (id))",
]


@register("answer_em_f1", O.with_(*SCORE_CTES)
          + "SELECT id, prediction_text, em, round(f1, 6) AS f1, answered FROM per")
def answer_em_f1(spark, sf_dir):
    ex, preds = _gold_and_preds(spark, sf_dir)
    per = MT.per_question(ex, preds)
    return per.select("id", "prediction_text", "em", F.round("f1", 6).alias("f1"), "answered")


@register("answer_report", O.with_(*SCORE_CTES)
          + "SELECT count(*) AS n_questions, round(avg(em), 6) AS em, round(avg(f1), 6) AS f1, "
            "to_json({'EM': {'value': printf('%.2f%%', avg(em) * 100), 'rank': true, 'decs': true}, "
            "'F1': {'value': printf('%.2f%%', avg(f1) * 100), 'rank': false, 'decs': true}})::VARCHAR AS report FROM per")
def answer_report(spark, sf_dir):
    ex, preds = _gold_and_preds(spark, sf_dir)
    return MT.report(MT.per_question(ex, preds))


@register("unanswered", O.with_(*SCORE_CTES) + "SELECT id FROM per WHERE NOT answered")
def unanswered(spark, sf_dir):
    ex, preds = _gold_and_preds(spark, sf_dir)
    return MT.unanswered(ex, preds)


SQUAD_SQL = O.with_(
    *OR.reading_ctes(),
    "pr AS (SELECT ex.id, nb.text AS pred FROM nb JOIN ex USING (example_id) WHERE nb.rank = 1)",
    "gx AS (SELECT id, unnest(ans_text) AS g FROM ex)",
    f"pc AS (SELECT gx.id, {O.squad_tokens('pr.pred')} AS pt, {O.squad_tokens('gx.g')} AS gt FROM gx JOIN pr USING (id))",
    f"pc2 AS (SELECT *, (array_to_string(pt, ' ') = array_to_string(gt, ' '))::INTEGER AS em, {O.common('pt', 'gt')} AS same FROM pc)",
    f"pf AS (SELECT id, max(em) AS em, max({O.f1_from('same', 'pt', 'gt')}) AS f1 FROM pc2 GROUP BY id)",
    "per AS (SELECT ex.id, CASE WHEN pr.id IS NULL THEN 0.0 ELSE coalesce(pf.em, 0) END::DOUBLE AS em, "
    "CASE WHEN pr.id IS NULL THEN 0.0 ELSE coalesce(pf.f1, 0.0) END::DOUBLE AS f1 "
    "FROM ex LEFT JOIN pr USING (id) LEFT JOIN pf USING (id))") + \
    "SELECT round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1 FROM per"


@register("squad_em_f1", SQUAD_SQL)
def squad_em_f1(spark, sf_dir):
    ex, preds = _gold_and_preds(spark, sf_dir)
    return MT.squad_scores(ex, preds)


# --- step 5: filters, keyword store retrieval, multi-field, highlights --------

from ..operators import store as ST  # noqa: E402

# The two filter examples of the store documentation, with
# the fields renamed to this data's metadata (lang, source, n_chars).
FILTER_AND_OR = {"$and": {"lang": {"$in": ["en", "de"]}, "n_chars": {"$gte": 200, "$lt": 3000},
                          "$or": {"source": {"$in": ["src1", "src2", "src3"]}, "lang": {"$eq": "de"}}}}
FILTER_OR_OF_AND = {"$or": [{"$and": {"lang": "en", "n_chars": {"$lt": 1000}}},
                            {"$and": {"lang": "fr", "n_chars": {"$gte": 1000}}}]}
FILTER_AND_OR_SQL = ("lang IN ('en', 'de') AND n_chars >= 200 AND n_chars < 3000 "
                     "AND (source IN ('src1', 'src2', 'src3') OR lang = 'de')")
FILTER_OR_OF_AND_SQL = "((lang = 'en' AND n_chars < 1000) OR (lang = 'fr' AND n_chars >= 1000))"

STORE_DOCS_SQL = "store AS (SELECT doc_id AS passage_id, coalesce(text, '') AS text, lang, source, n_chars FROM documents)"


@register("filtered_docs",
          f"SELECT 'and_or' AS filter, doc_id FROM documents WHERE {FILTER_AND_OR_SQL} "
          f"UNION ALL SELECT 'or_of_and', doc_id FROM documents WHERE {FILTER_OR_OF_AND_SQL}")
def filtered_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a = ST.filter_only(docs, FILTER_AND_OR).select(F.lit("and_or").alias("filter"), "doc_id")
    b = ST.filter_only(docs, FILTER_OR_OF_AND).select(F.lit("or_of_and").alias("filter"), "doc_id")
    return a.unionByName(b)


def _store_sql(where: str = "TRUE", all_terms: bool = False) -> str:
    ctes = [STORE_DOCS_SQL, O.QUESTIONS, *O.index_ctes(O.word_tokens, src="store"),
            *O.qterm_ctes(O.word_tokens), *O.bm25_ctes("server")]
    ctes.append("need AS (SELECT qid, count(*) AS need FROM qt GROUP BY qid)")
    ctes.append("have AS (SELECT qt.qid, p.passage_id, count(*) AS have FROM qt JOIN post p USING (term) GROUP BY ALL)")
    cond = "h.have = n.need" if all_terms else "TRUE"
    ctes.append(f"ok AS (SELECT m.qid, m.passage_id, round(m.s, 6) AS score FROM msum m JOIN store d USING (passage_id) "
                f"JOIN have h ON h.qid = m.qid AND h.passage_id = m.passage_id JOIN need n ON n.qid = m.qid "
                f"WHERE {where} AND {cond})")
    ctes.append(O.topk_cte(ST.STORE_TOP_K, src="ok"))
    return O.with_(*ctes) + ("SELECT qid, rank, passage_id, round(1.0 / (1.0 + exp(-score / 8.0)), 6) AS score "
                             "FROM topk")


def store_index(spark, sf_dir):
    return IS.shared_index(FX.store_documents(spark, sf_dir), "bm25", "word", FX.source_key(spark, sf_dir, "documents", "store"))


@register("filtered_bm25", _store_sql(FILTER_AND_OR_SQL))
def filtered_bm25(spark, sf_dir):
    docs = FX.store_documents(spark, sf_dir)
    index = store_index(spark, sf_dir)
    return ST.keyword_retrieve(index, FX.questions(spark, sf_dir), docs, FILTER_AND_OR)


@register("all_terms_match", _store_sql(all_terms=True))
def all_terms_match(spark, sf_dir):
    index = store_index(spark, sf_dir)
    return ST.keyword_retrieve(index, FX.questions(spark, sf_dir), all_terms_must_match=True)


PAGES_SQL = ("pg AS (SELECT page_id AS passage_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, "
             "trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>', ' ', 'g'), "
             "'<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS content FROM pages)")


def _multi_field_sql() -> list[str]:
    ctes = [PAGES_SQL, O.QUESTIONS, *O.qterm_ctes(O.word_tokens)]
    for f in ("content", "title"):
        ctes.append(f"{f}_src AS (SELECT passage_id, coalesce({f}, '') AS text FROM pg)")
        ctes += O.index_ctes(O.word_tokens, src=f"{f}_src", ip=f"{f}_")
        ctes += O.bm25_ctes("server", p=f"{f}_", ip=f"{f}_")
    ctes.append("mf AS (SELECT qid, passage_id, round(coalesce(c.s, 0.0) + coalesce(t.s, 0.0), 6) AS score "
                "FROM content_msum c FULL JOIN title_msum t USING (qid, passage_id))")
    ctes.append(O.topk_cte(ST.STORE_TOP_K, src="mf"))
    return ctes


@register("multi_field_match", O.with_(*_multi_field_sql()) + "SELECT * FROM topk")
def multi_field_match(spark, sf_dir):
    return ST.multi_field_retrieve(FX.pages_store(spark, sf_dir), FX.questions(spark, sf_dir),
                                   ["content", "title"], source_key=FX.source_key(spark, sf_dir, "pages"))


def _hl_sql(col: str) -> str:
    pieces = f"regexp_extract_all(coalesce(pg.{col}, ''), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+|[^\\p{{L}}\\p{{M}}\\p{{N}}_]+')"
    return (f"array_to_string(list_transform({pieces}, lambda x: CASE WHEN list_contains(qa.terms, lower(x)) "
            f"THEN '<em>' || x || '</em>' ELSE x END), '')")


@register("highlights", O.with_(*_multi_field_sql(),
                                "qa AS (SELECT qid, list(term) AS terms FROM qt GROUP BY qid)")
          + f"SELECT t.qid, t.rank, t.passage_id AS page_id, {_hl_sql('title')} AS title_highlighted, "
            f"{_hl_sql('content')} AS content_highlighted FROM topk t JOIN pg USING (passage_id) JOIN qa USING (qid)")
def highlights(spark, sf_dir):
    pages = FX.pages_store(spark, sf_dir)
    qs = FX.questions(spark, sf_dir)
    ranked = ST.multi_field_retrieve(pages, qs, ["content", "title"], source_key=FX.source_key(spark, sf_dir, "pages"))
    terms = (R.query_terms(qs, "word").groupBy("qid").agg(F.collect_list("term").alias("terms")))
    return (ranked.join(pages, "passage_id").join(terms, "qid")
            .select("qid", "rank", F.col("passage_id").alias("page_id"),
                    ST.highlight(F.col("title"), F.col("terms")).alias("title_highlighted"),
                    ST.highlight(F.col("content"), F.col("terms")).alias("content_highlighted")))


# --- step 9: corpus and label preparation, exports, curriculum ----------------

from ..operators import prep as PR  # noqa: E402


@register("clean_text", O.with_(O.PASSAGES)
          + f"SELECT passage_id, {O.normalize('text')} AS document_text FROM passages")
def clean_text(spark, sf_dir):
    return PR.clean_for_index(FX.passages(spark, sf_dir))


CLEAN_SQL = ("regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[ \\t\\r\\f]*\\n[ \\t\\r\\f]*', chr(10), 'g'), "
             "'^\\s+|\\s+$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
WORD_SPLITS_SQL = (
    "WITH RECURSIVE sl AS (SELECT doc_id, string_split(regexp_replace(" + CLEAN_SQL + ", '([.!?])\\s+', "
    "'\\1' || chr(1), 'g'), chr(1)) AS s FROM documents),\n"
    "sw AS (SELECT doc_id, r.i AS i, r.x AS x, len(list_filter(string_split_regex(r.x, '\\s+'), lambda t: t <> '')) AS wc "
    "FROM (SELECT doc_id, unnest(list_transform(s, lambda x, i: {'x': x, 'i': i})) AS r FROM sl)),\n"
    f"pack AS (SELECT doc_id, i, wc AS cur, 0 AS piece FROM sw WHERE i = 1 UNION ALL "
    f"SELECT sw.doc_id, sw.i, CASE WHEN p.cur > 0 AND p.cur + sw.wc > {PR.SPLIT_LENGTH} THEN sw.wc ELSE p.cur + sw.wc END, "
    f"CASE WHEN p.cur > 0 AND p.cur + sw.wc > {PR.SPLIT_LENGTH} THEN p.piece + 1 ELSE p.piece END "
    "FROM pack p JOIN sw ON sw.doc_id = p.doc_id AND sw.i = p.i + 1)\n"
    "SELECT * FROM (SELECT doc_id, piece::INTEGER AS split_idx, sum(wc)::INTEGER AS n_words, "
    "string_agg(x, ' ' ORDER BY i) AS content FROM pack JOIN sw USING (doc_id, i) GROUP BY doc_id, piece) "
    "WHERE content <> ''")


@register("word_splits", WORD_SPLITS_SQL)
def word_splits(spark, sf_dir):
    return PR.split_words(table(spark, sf_dir, "documents"))


LABELS_SQL = [OR.EXAMPLES,
              "lab AS (SELECT id, question AS query, conv_id, answer FROM (SELECT id, question, "
              f"example_id // {FX.EXAMPLE_ID_STRIDE} AS conv_id, unnest(CASE WHEN len(ans_text) = 0 THEN [NULL::VARCHAR] ELSE ans_text END) "
              "AS answer FROM ex))"]


@register("label_rows", O.with_(*LABELS_SQL)
          + "SELECT id, query, conv_id AS document_id, coalesce(answer, '') AS answer, answer IS NULL AS no_answer FROM lab")
def label_rows(spark, sf_dir):
    return PR.label_rows(FX.qa_examples(spark, sf_dir)).select(
        "id", "query", "document_id", "answer", "no_answer")


@register("labels_aggregated", O.with_(*LABELS_SQL)
          + "SELECT query, count(*) AS n_labels, array_to_string(list_sort(list_distinct(list(answer))), '|') AS answers, "
            "array_to_string(list_sort(list_distinct(list(conv_id))), '|') AS document_ids "
            "FROM lab WHERE answer IS NOT NULL GROUP BY query")
def labels_aggregated(spark, sf_dir):
    agg = PR.aggregate_labels(PR.label_rows(FX.qa_examples(spark, sf_dir)))
    return agg.select("query", "n_labels", F.array_join("answers", "|").alias("answers"),
                      F.array_join(F.transform("document_ids", lambda d: d.cast("string")), "|").alias("document_ids"))


@register("squad_export", O.with_(OR.EXAMPLES)
          + f"SELECT id, to_json({{'title': 'conversation ' || (example_id // {FX.EXAMPLE_ID_STRIDE})::VARCHAR, 'paragraphs': "
            "[{'qas': [{'question': question, 'id': id, 'answers': CASE WHEN len(ans_text) = 0 THEN [] ELSE "
            "[{'text': ans_text[1], 'answer_start': ans_start[1]}] END, 'is_impossible': len(ans_text) = 0}], "
            "'context': context}]})::VARCHAR AS record FROM ex")
def squad_export(spark, sf_dir):
    return PR.squad_records(FX.qa_examples(spark, sf_dir)).select("id", F.to_json("record").alias("record"))


@register("curriculum_split", O.with_(*OR.reading_ctes(),
                                      "pr AS (SELECT ex.id, nb.text AS pred FROM nb JOIN ex USING (example_id) WHERE nb.rank = 1)")
          + "SELECT ex.id, CASE WHEN pr.pred = ex.ans_text[1] AND pr.pred <> '' THEN 'easy' ELSE 'hard' END AS difficulty "
            "FROM ex JOIN pr USING (id)")
def curriculum_split(spark, sf_dir):
    ex, preds = _gold_and_preds(spark, sf_dir)
    pairs = PR.difficulty_pairs(preds, ex)
    return PR.curriculum_split(ex, pairs).select("id", "difficulty")


# --- step 10: vectors, index freshness ---------------------------------------

from ..operators import vector as VE  # noqa: E402

VECTOR_K = K


QUERY_EVERY = 20  # of the approximate searches, vectors whose id it divides are the queries, against all vectors
USABLE_SQL = ("u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 "
              "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)")
L2_SQL = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"
RANK_SQL = (f"SELECT qid::BIGINT AS qid, rank::INTEGER AS rank, vec_id::BIGINT AS vec_id, distance FROM (SELECT *, row_number() "
            f"OVER (PARTITION BY qid ORDER BY distance, vec_id) AS rank FROM {{src}}) WHERE rank <= {VECTOR_K}")
ALL_PAIRS_CTE = f"d AS (SELECT q.vec_id AS qid, v.vec_id, round({L2_SQL.format(a='q.v', b='v.v')}, 6) AS distance FROM u q, u v)"
EXACT_CTE = (f"d AS (SELECT q.vec_id AS qid, v.vec_id, round({L2_SQL.format(a='q.v', b='v.v')}, 6) AS distance "
             f"FROM u q, u v WHERE q.vec_id % {QUERY_EVERY} = 0)")


def _vector_queries(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return emb, emb.where(F.col("vec_id") % QUERY_EVERY == 0).select(F.col("vec_id").alias("qid"), "embedding")


def _exact(spark, sf_dir, qs):
    index = VE.shared_ivf(table(spark, sf_dir, "embeddings"), source_key=FX.source_key(spark, sf_dir, "embeddings"))
    return VE.exact_topk(index, qs, VECTOR_K)


@register("exact_vector_topk", O.with_(USABLE_SQL, ALL_PAIRS_CTE) + RANK_SQL.format(src="d"))
def exact_vector_topk(spark, sf_dir):
    """Every vector is a query, against all vectors."""
    return _exact(spark, sf_dir, table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding"))


IVF_NPROBE = 2
IVF_SQL = O.with_(
    USABLE_SQL,
    "m AS (SELECT label, i, round(avg(v[i]), 6) AS x FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM u WHERE label IS NOT NULL) GROUP BY ALL)",
    "c AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, list(x ORDER BY i) AS c FROM m GROUP BY label)",
    f"uc AS (SELECT vec_id, v, cell, row_number() OVER (PARTITION BY vec_id ORDER BY {L2_SQL.format(a='u.v', b='c.c')}, cell) AS r FROM u, c)",
    f"s AS (SELECT q.vec_id AS qid, o.vec_id, round({L2_SQL.format(a='q.v', b='o.v')}, 6) AS distance FROM uc q JOIN uc o USING (cell) "
    f"WHERE o.r = 1 AND q.r <= {IVF_NPROBE} AND q.vec_id % {QUERY_EVERY} = 0)") + RANK_SQL.format(src="s")


def label_means(vectors: DataFrame) -> list:
    """One centroid a label, in the order of the labels."""
    means = (vectors.where(F.col("label").isNotNull()).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i")
             .agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x")).groupBy("label")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c")))
    return [r["c"] for r in means.orderBy("label").collect()]


@register("ivf_topk", IVF_SQL)
def ivf_topk(spark, sf_dir):
    """Cells around the means of the labels, which SQL can compute too (KMeans is the default), stored once."""
    emb, qs = _vector_queries(spark, sf_dir)
    index = VE.shared_ivf(emb, source_key=FX.source_key(spark, sf_dir, "embeddings"), fit=label_means, fit_name="label-means")
    return VE.ivf_topk(index, qs, VECTOR_K, nprobe=IVF_NPROBE)


from ..operators import vector_codes as VC  # noqa: E402
from ..operators import vector_tree as VT  # noqa: E402

CODED_CTES = [
    USABLE_SQL,
    "rg AS (SELECT list(lo ORDER BY i) AS lo, list(hi ORDER BY i) AS hi FROM (SELECT i, min(v[i]) AS lo, max(v[i]) AS hi "
    "FROM (SELECT v, unnest(range(1, len(v) + 1)) AS i FROM u) GROUP BY i))",
    f"dc AS (SELECT vec_id, v, list_transform(range(1, len(v) + 1), lambda i: lo[i] + floor(CASE WHEN hi[i] > lo[i] "
    f"THEN (v[i] - lo[i]) / (hi[i] - lo[i]) ELSE 0 END * {VC.STEPS} + 0.5) * (hi[i] - lo[i]) / {VC.STEPS}) AS x FROM u, rg)",
    f"ap AS (SELECT q.vec_id AS qid, o.vec_id, q.v AS qv, o.v AS ov, row_number() OVER (PARTITION BY q.vec_id "
    f"ORDER BY {L2_SQL.format(a='q.v', b='o.x')}, o.vec_id) AS r FROM u q, dc o WHERE q.vec_id % {QUERY_EVERY} = 0)",
    f"cs AS (SELECT qid, vec_id, round({L2_SQL.format(a='qv', b='ov')}, 6) AS distance FROM ap WHERE r <= {VC.FACTOR * VECTOR_K})"]


def _coded(spark, sf_dir):
    emb, qs = _vector_queries(spark, sf_dir)
    index = VC.build_codes(emb, FX.source_key(spark, sf_dir, "embeddings"))
    return VC.coded_topk(index, qs, VECTOR_K)


@register("coded_vector_topk", O.with_(*CODED_CTES) + RANK_SQL.format(src="cs"))
def coded_vector_topk(spark, sf_dir):
    """Scan of 8-bit codes, exact ranking of the nearest ones."""
    return _coded(spark, sf_dir)


@register("coded_vector_recall", O.with_(*CODED_CTES, EXACT_CTE, f"f AS ({RANK_SQL.format(src='cs')})", f"x AS ({RANK_SQL.format(src='d')})")
          + "SELECT count(DISTINCT x.qid) AS n_queries, count(*) AS n_exact, count(f.vec_id) AS n_found, "
            "round(count(f.vec_id) / count(*), 6) AS recall FROM x LEFT JOIN f USING (qid, vec_id)")
def coded_vector_recall(spark, sf_dir):
    return VC.recall(_coded(spark, sf_dir), _exact(spark, sf_dir, _vector_queries(spark, sf_dir)[1]))


TREE_RECALL = 0.9


@register("tree_vector_recall", O.with_(USABLE_SQL, EXACT_CTE, f"x AS ({RANK_SQL.format(src='d')})")
          + "SELECT count(DISTINCT qid) AS n_queries, count(*) AS n_exact, true AS reached FROM x")
def tree_vector_recall(spark, sf_dir):
    """Whether the two-level tree of fitted cells reaches its recall against exact search (SQL cannot fit the cells)."""
    emb, qs = _vector_queries(spark, sf_dir)
    index = VT.build_tree(emb)
    probe = VT.probe_for(index, qs, VECTOR_K, recall=TREE_RECALL)
    found = VC.recall(VT.tree_topk(index, qs, VECTOR_K, probe), _exact(spark, sf_dir, qs))
    return found.select("n_queries", "n_exact", (F.col("recall") >= TREE_RECALL).alias("reached"))


FRESH_SQL = "SELECT source, count(*) AS n_docs, sum(doc_id)::BIGINT AS id_sum, sum(length(text))::BIGINT AS char_sum FROM {src} GROUP BY source"


@register("index_freshness",
          "WITH s AS (" + FRESH_SQL.format(src="documents") + "), c AS (" + FRESH_SQL.format(
              src="(SELECT doc_id, text, source FROM documents WHERE lang IS DISTINCT FROM 'de')") + ") "
          "SELECT source FROM s FULL JOIN c USING (source) WHERE (s.n_docs, s.id_sum, s.char_sum) IS DISTINCT FROM (c.n_docs, c.id_sum, c.char_sum)")
def index_freshness(spark, sf_dir):
    """Sources to refit (R11): the fingerprints stored when the index was made,
    against those of the store after its German documents went."""
    docs = table(spark, sf_dir, "documents")
    stored = materialize(IS.portable_fingerprint(docs, "doc_id", "text", ["source"]), "stored-fingerprints")
    now = IS.portable_fingerprint(docs.where(~F.col("lang").eqNullSafe(F.lit("de"))), "doc_id", "text", ["source"])
    return IS.stale_groups(stored, now, ["source"])


# --- retrieve-then-read across passages, retrieval evaluation ---------------

from . import reading_flow as RF  # noqa: E402

READER_SQL = O.with_(
    O.PASSAGES, O.QUESTIONS, *O.index_ctes(), *O.qterm_ctes(), *O.bm25_ctes("okapi"),
    O.topk_cte(RF.RETRIEVER_TOP_K),
    f"ex AS (SELECT t.qid * {RF.PAIR_SEED} + t.passage_id AS example_id, t.qid, t.passage_id, "
    f"regexp_extract(q.question, '{RF.QUESTION_HEAD}') AS question, "
    "p.text AS context FROM topk t JOIN passages p USING (passage_id) JOIN q USING (qid))",
    *OR.TOKENS, *OR.windows_ctes(RF.READER_MAX_LEN), *OR.CANDIDATES,
    f"pw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id, wi ORDER BY score DESC, si, ei) "
    f"AS r1 FROM cand) WHERE r1 <= {RF.TOP_K_PER_SAMPLE})",
    "uq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id, s_off, e_off ORDER BY score DESC, wi) "
    "AS r2 FROM pw) WHERE r2 = 1)",
    f"pp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, wi, si) AS r3 "
    f"FROM uq) WHERE r3 <= {RF.TOP_K_PER_CANDIDATE})",
    "fin AS (SELECT pp.*, ex.qid, ex.passage_id, ex.context FROM pp JOIN ex USING (example_id))") + (
    "SELECT qid::BIGINT AS qid, rank::INTEGER AS rank, passage_id::BIGINT AS passage_id, "
    "substring(context, s_off + 1, e_off - s_off) AS text, score FROM (SELECT *, row_number() OVER "
    "(PARTITION BY qid ORDER BY score DESC, passage_id, s_off, e_off) AS rank FROM fin) "
    f"WHERE rank <= {RF.READER_TOP_K}")


@register("reader_topk", READER_SQL)
def reader_topk(spark, sf_dir):
    psg = FX.passages(spark, sf_dir)
    qs = FX.questions(spark, sf_dir)
    ranked = R.bm25_topk(corpus_index(spark, sf_dir), qs, RF.RETRIEVER_TOP_K, "okapi")
    return RF.read_retrieved(ranked, psg, qs)


def _hits_sql(src: str, method: str) -> str:
    return (f"SELECT '{method}' AS method, count(*) AS n_questions, sum(c::INTEGER)::BIGINT AS hits, "
            f"round(avg(c::INTEGER::DOUBLE), 6) AS hit_rate, round(avg(e::INTEGER::DOUBLE), 6) AS top1_equal_rate, "
            f"round(avg(round(CASE WHEN hi = lo THEN 0.0 ELSE (sc[ri] - lo) / (hi - lo) END, 6)) FILTER (ri IS NOT NULL), 6) "
            f"AS gold_score_mean FROM (SELECT t.qid, "
            f"contains(string_agg(p.text, ' ' ORDER BY t.rank), any_value(q.question)) AS c, "
            f"coalesce(bool_or(p.text = q.question) FILTER (t.rank = 1), false) AS e, "
            f"min(t.score) AS lo, max(t.score) AS hi, list(t.score ORDER BY t.rank) AS sc, "
            f"min(t.rank) FILTER (contains(p.text, q.question)) AS ri "
            f"FROM {src} t JOIN passages p USING (passage_id) JOIN q USING (qid) GROUP BY t.qid)")


RETRIEVAL_EVAL_SQL = O.with_(
    *THREE_LISTS_SQL,
    "best AS (SELECT qid, passage_id, scaled AS score, r_idx * 1000000 + rank AS pos FROM "
    "(SELECT *, row_number() OVER (PARTITION BY qid, passage_id ORDER BY scaled DESC, "
    "r_idx * 1000000 + rank) AS rn FROM scaled) WHERE rn = 1)",
    *O.bm25_ctes("l", "l_"), *O.bm25_ctes("server", "s_"), O.topk_cte(K, "l_top", src="l_scores"),
    O.topk_cte(K, "s_top", src="s_scores", where="matched"),
    f"e_top AS (SELECT qid, passage_id, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY qid "
    f"ORDER BY score DESC, pos) AS rank FROM best) WHERE rank <= {K})") + " UNION ALL ".join(
    [_hits_sql("t_top", "tfidf"), _hits_sql("o_top", "bm25"), _hits_sql("p_top", "bm25_plus"), _hits_sql("l_top", "bm25l"),
     _hits_sql("s_top", "server_bm25"), _hits_sql("e_top", "ensemble")])


@register("retrieval_eval", RETRIEVAL_EVAL_SQL)
def retrieval_eval(spark, sf_dir):
    psg = FX.passages(spark, sf_dir)
    bm, tf = corpus_index(spark, sf_dir), corpus_index(spark, sf_dir, "tfidf")
    indexes = {"tfidf": tf, "bm25": bm, "bm25_plus": bm, "bm25l": bm, "server_bm25": bm}
    out = RF.evaluate_retrievers(indexes, psg, FX.questions(spark, sf_dir), K)
    return out.select("method", "n_questions", "hits", "hit_rate", "top1_equal_rate", "gold_score_mean")


@register("row_counts", O.with_(
    O.PASSAGES, OR.EXAMPLES, *OR.TOKENS, *OR.WINDOWS,
    "lab AS (SELECT unnest(CASE WHEN len(ans_text) = 0 THEN [NULL::VARCHAR] ELSE ans_text END) AS a FROM ex)") + (
    "SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL "
    "SELECT 'passages', count(*) FROM passages UNION ALL "
    "SELECT 'questions', count(*) FROM benchmark UNION ALL "
    "SELECT 'examples', count(*) FROM ex UNION ALL "
    "SELECT 'labels', count(*) FROM lab UNION ALL "
    "SELECT 'windows', count(*) FROM win"))
def row_counts(spark, sf_dir):
    """Row counts of the stored tables and derived splits (A15), one row each."""
    ex = FX.qa_examples(spark, sf_dir)
    parts = [("documents", table(spark, sf_dir, "documents")), ("passages", FX.passages(spark, sf_dir)),
             ("questions", FX.questions(spark, sf_dir)), ("examples", ex),
             ("labels", PR.label_rows(ex)), ("windows", WN.context_windows(ex))]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = c if out is None else out.unionByName(c)
    return out


from ..sources import readers as RD  # noqa: E402
from ..sources import sinks as SK  # noqa: E402
from ..session import shared_path  # noqa: E402


@register("csv_roundtrip", O.with_(OR.EXAMPLES)
          + "SELECT id, question, context, ans_text[1] AS first_answer, ans_start[1] AS answer_start FROM ex")
def csv_roundtrip(spark, sf_dir):
    """QA examples exported as a CSV split (S6, answers as JSON text), read
    back with an explicit all-string schema (S4) and the answers parsed
    (S5)."""
    from pyspark.sql import types as T

    ex = FX.qa_examples(spark, sf_dir).select("id", "question", "context", "answers")
    path = shared_path(spark, f"csv-split-{uuid.uuid4().hex[:12]}")
    SK.export_csv(ex, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "question", "context", "answers")])
    back = RD.read_csv_split(spark, path, schema).withColumn("a", RD.parse_answers(F.col("answers")))
    return back.select("id", "question", F.coalesce(F.col("context"), F.lit("")).alias("context"),
                       F.try_element_at("a.text", F.lit(1)).alias("first_answer"),
                       F.try_element_at("a.answer_start", F.lit(1)).alias("answer_start"))


# --- operators that write, batch filters, reader metrics -----------------------

@register("reader_metrics", O.with_(*SCORE_CTES)
          + "SELECT count(*) AS n_questions, round(avg(em), 6) AS em, round(avg(f1), 6) AS f1 FROM per")
def reader_metrics(spark, sf_dir):
    """Reader EM / F1 over all gold questions, from the rank-1 answers."""
    ex, preds = _gold_and_preds(spark, sf_dir)
    answers = preds.select("id", F.lit(1).alias("rank"), F.col("prediction_text").alias("text"))
    return MT.reader_topk_metrics(answers, ex, k=1)


@register("nbest_records", O.with_(*OR.reading_ctes())
          + "SELECT example_id, count(*) AS n, array_to_string(list(text ORDER BY rank), '|') AS texts, "
            "round(sum(probability), 6) AS total FROM nb GROUP BY example_id")
def nbest_records(spark, sf_dir):
    """N-best lists (D10) written as JSON Lines (S8) and read back."""
    path = shared_path(spark, f"nbest-{uuid.uuid4().hex[:12]}")
    records = SP.nbest_records(_nbest(spark, sf_dir))
    SK.write_predictions(records, records, None, path, prefix="run")
    back = spark.read.schema(records.schema).json(f"{path}/run_nbest_predictions")
    return back.select("example_id", F.size("nbest").cast("long").alias("n"),
                       F.array_join(F.transform("nbest", lambda x: x["text"]), "|").alias("texts"),
                       F.round(F.aggregate("nbest", F.lit(0.0), lambda a, x: a + x["probability"]), 6).alias("total"))


BATCH_FILTERS = [FILTER_AND_OR, FILTER_OR_OF_AND, None]
_BATCH_WHERE = (f"(m.qid % 3 = 0 AND {FILTER_AND_OR_SQL}) OR (m.qid % 3 = 1 AND {FILTER_OR_OF_AND_SQL}) OR m.qid % 3 = 2")


@register("batch_filtered_bm25", _store_sql(f"({_BATCH_WHERE})"))
def batch_filtered_bm25(spark, sf_dir):
    """One filter per question (R9 batch form): every third question has the first, the second, or none."""
    qs = FX.questions(spark, sf_dir)
    kinds = qs.select("qid", (F.col("qid") % 3).cast("int").alias("filter_id"))
    docs = FX.store_documents(spark, sf_dir)
    return ST.keyword_retrieve_batch(store_index(spark, sf_dir), qs, docs, BATCH_FILTERS, kinds)


@register("difficulty_table", BEST_SQL.replace("SELECT ex.id, nb.text AS prediction_text",
          "SELECT CASE WHEN nb.text = ex.ans_text[1] AND nb.text <> '' THEN 'easy' ELSE 'hard' END AS difficulty, count(*) AS n") + " GROUP BY 1")
def difficulty_table(spark, sf_dir):
    """Easy and hard examples written as a partitioned table (S10), counted per partition."""
    ex, preds = _gold_and_preds(spark, sf_dir)
    path = shared_path(spark, f"difficulty-{uuid.uuid4().hex[:12]}")
    SK.write_by_difficulty(PR.curriculum_split(ex, PR.difficulty_pairs(preds, ex)), path)
    return spark.read.parquet(path).groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"))


@register("corpus_lines", "SELECT doc_id::VARCHAR AS document_id, text, lang AS domain FROM documents")
def corpus_lines(spark, sf_dir):
    """Documents, those without text too, written as JSON Lines and read by the corpus reader."""
    docs = table(spark, sf_dir, "documents")
    path = shared_path(spark, f"corpus-{uuid.uuid4().hex[:12]}")
    SK.write_json(docs.select(F.col("doc_id").cast("string").alias("document_id"), "text", F.col("lang").alias("domain")), path)
    return RD.read_corpus_lines(spark, path).select("document_id", "text", "domain")


# --- index segments, keyed stores, and operators that write and read back ----------

from ..sources import keyed_store as KS  # noqa: E402
from ..sources import segments as SG  # noqa: E402


def fresh_path(spark, name: str) -> str:
    return shared_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("segmented_bm25_topk", ORACLE["bm25_okapi_topk"])
def segmented_bm25_topk(spark, sf_dir):
    """Okapi over an index of three segments (R11): most passages, some in an old wording; their updates; one
    more segment with a passage that is deleted again. Equal to the index built at once."""
    psg = FX.passages(spark, sf_dir).select("passage_id", "text")
    late, old = F.col("passage_id") % 100 == 0, F.col("passage_id") % 50 == 1
    index = SG.SegmentedIndex(spark, fresh_path(spark, "segments"))
    index.add(psg.where(~late).withColumn("text", F.when(old, F.concat(F.lit("old wording of "), "text")).otherwise(F.col("text"))))
    index.add(psg.where(late | old))
    index.add(psg.agg((F.max("passage_id") + 1).alias("passage_id")).withColumn("text", F.lit("a passage that goes again")))
    index.delete(psg.agg((F.max("passage_id") + 1).alias("passage_id")))
    return R.bm25_topk(index.open(), FX.questions(spark, sf_dir), K)


@register("store_merge", "WITH d AS (SELECT doc_id, text, doc_id % 3 AS m FROM documents) "
          "SELECT 'first' AS step, count(*) AS n_new, 0 AS n_repeated, count(*) AS n_rows, "
          "sum(coalesce(length(text), 0))::BIGINT AS chars FROM d WHERE m <> 0 UNION ALL "
          "SELECT 'skip', count(*) FILTER (m = 0), count(*) FILTER (m = 1), count(*) , sum(coalesce(length(text), 0))::BIGINT FROM d UNION ALL "
          "SELECT 'overwrite', 0, count(*) FILTER (m = 2), count(*), sum(CASE WHEN m = 2 THEN 3 ELSE coalesce(length(text), 0) END)::BIGINT FROM d "
          "UNION ALL SELECT 'clear', 0, 0, 0, 0")
def store_merge(spark, sf_dir):
    """Documents written into a keyed store in three steps (S12, S14), counted after each, and cleared."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store, m, out = KS.KeyedStore(spark, fresh_path(spark, "store"), "doc_id"), F.col("doc_id") % 3, []
    new_text = F.lit("new")

    def step(name, done):
        rows = store.rows()
        chars = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)))).first()[0] if rows is not None else 0
        out.append((name, done["new"], done["repeated"], store.count(), chars))

    step("first", store.write(docs.where(m != 0), "fail"))
    step("skip", store.write(docs.where(m != 2).withColumn("text", F.when(m == 1, new_text).otherwise(F.col("text"))), "skip"))
    step("overwrite", store.write(docs.where(m == 2).withColumn("text", new_text), "overwrite"))
    store.clear()
    step("clear", {"new": 0, "repeated": 0})
    return spark.createDataFrame(out, "step string, n_new long, n_repeated long, n_rows long, chars long")


@register("documents_with_defaults",
          "SELECT doc_id::VARCHAR AS id, coalesce(text, '') AS content, coalesce(source, '') AS corpus_source, "
          "coalesce(lang, '') AS domain, '' AS url, '' AS title, '' AS author, '' AS html, doc_id::VARCHAR AS document_id FROM documents")
def documents_with_defaults(spark, sf_dir):
    """Corpus records without some fields, read as documents with defaults."""
    docs = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "corpus")
    SK.write_json(docs.select(F.col("doc_id").cast("string").alias("key"), "text", F.col("source").alias("corpus_source"),
                              F.col("lang").alias("domain")), path)
    return RD.to_documents(RD.read_corpus_lines(spark, path)).select("id", "content", *[f"meta.{f}" for f in RD.META_FIELDS])


@register("top_answers", BEST_SQL)
def top_answers(spark, sf_dir):
    """Id and rank-1 answer of the n-best lists."""
    ex = FX.qa_examples(spark, sf_dir)
    return SK.top_answers(_nbest(spark, sf_dir).join(ex.select("example_id", "id"), "example_id"))


@register("load_with_rejects", "SELECT count(*) FILTER (n_chars >= 200 AND text IS NOT NULL) AS n_stored, "
          "count(*) FILTER (NOT coalesce(n_chars >= 200 AND text IS NOT NULL, false)) AS n_rejected FROM documents")
def load_with_rejects(spark, sf_dir):
    """Documents loaded into a named table, those without text or too short into a reject table."""
    name = f"loaded_{uuid.uuid4().hex[:12]}"
    good = (F.col("n_chars") >= 200) & F.col("text").isNotNull()
    stored, rejected = IS.write_with_rejects(table(spark, sf_dir, "documents"), good, name, f"{name}_rejects")
    IS.drop_index_table(spark, name)
    IS.drop_index_table(spark, f"{name}_rejects")
    return spark.createDataFrame([(stored, rejected)], "n_stored long, n_rejected long")


@register("index_lifecycle", "SELECT true AS created, false AS created_again, count(*) AS n_rows, 'word' AS analyzer, "
          "true AS listed, 0 AS n_cleared, true AS dropped FROM documents")
def index_lifecycle(spark, sf_dir):
    """A named table created, kept, described, listed, cleared and dropped."""
    docs, name = table(spark, sf_dir, "documents").select("doc_id", "text"), f"named_{uuid.uuid4().hex[:12]}"
    created, again = IS.create_index_table(docs, name, {"analyzer": "word"}), IS.create_index_table(docs.limit(0), name)
    n, listed = spark.table(name).count(), name in IS.list_index_tables(spark)
    analyzer = IS.index_properties(spark, name)["analyzer"]
    IS.clear_table(spark, name)
    cleared = spark.table(name).count()
    IS.drop_index_table(spark, name)
    row = (created, again, n, analyzer, listed, cleared, not spark.catalog.tableExists(name))
    return spark.createDataFrame([row], "created boolean, created_again boolean, n_rows long, analyzer string, listed boolean, "
                                        "n_cleared int, dropped boolean")


@register("stage_results", O.with_(OR.EXAMPLES)
          + "SELECT 'answers' AS stage, (len(ans_text) > 0)::VARCHAR AS name, count(*) AS n FROM ex GROUP BY 2 UNION ALL "
            "SELECT 'roles', role, count(*) FROM conversations GROUP BY 2")
def stage_results(spark, sf_dir):
    """Tables of two stages exported as CSV and read back."""
    has = (F.size("answers.text") > 0).cast("string")
    stages = {"answers": FX.qa_examples(spark, sf_dir).groupBy(has.alias("name")).agg(F.count(F.lit(1)).alias("n")),
              "roles": table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("name")).agg(F.count(F.lit(1)).alias("n"))}
    path = fresh_path(spark, "stages")
    SK.save_stage_results(stages, path)
    parts = [RD.read_csv_split(spark, f"{path}/{stage}").select(F.lit(stage).alias("stage"), "name", F.col("n").cast("long")) for stage in stages]
    return parts[0].unionByName(parts[1])


@register("resolved_columns", "SELECT doc_id, length(text)::BIGINT AS by_name, length(text)::BIGINT AS by_position FROM documents")
def resolved_columns(spark, sf_dir):
    """A column taken by its name and, where there is none of the name, by its position."""
    docs = table(spark, sf_dir, "documents")
    first, second = RD.resolve_column(docs, "text", 0), RD.resolve_column(docs, "content", 1)
    return docs.select("doc_id", F.length(first).cast("long").alias("by_name"), F.length(second).cast("long").alias("by_position"))


@register("projected_questions", O.with_(OR.EXAMPLES) + "SELECT id, question FROM ex")
def projected_questions(spark, sf_dir):
    """Examples projected to the declared prediction schema."""
    return RD.project_to(FX.qa_examples(spark, sf_dir), RD.PREDICT_SCHEMA)


@register("strict_ensemble", ENSEMBLE_SQL)
def strict_ensemble(spark, sf_dir):
    """The ensemble that refuses a question with fewer than k distinct passages."""
    return EN.max_merge(_three_lists(spark, sf_dir), K, strict=True)


@register("concatenated_splits", O.with_(OR.EXAMPLES)
          + f"SELECT CASE WHEN example_id // {FX.EXAMPLE_ID_STRIDE} % 4 = 0 THEN 'validation' ELSE 'train' END AS split, id, question, "
            f"ans_text[1] AS first_answer FROM ex")
def concatenated_splits(spark, sf_dir):
    """Two written splits, one without answers' starts, read as one table."""
    ex, path = FX.qa_examples(spark, sf_dir), fresh_path(spark, "splits")
    first = F.try_element_at("answers.text", F.lit(1)).alias("first_answer")
    validation = F.floor(F.col("example_id") / FX.EXAMPLE_ID_STRIDE) % 4 == 0
    ex.where(~validation).select("id", "question", first).write.parquet(f"{path}/train")
    ex.where(validation).select("question", "id", first, "title").write.parquet(f"{path}/validation")
    return RD.load_splits(spark, {"train": f"{path}/train", "validation": f"{path}/validation"}).select("split", "id", "question", "first_answer")


MODEL_LEN = 256


@register("clamped_windows", O.with_(OR.EXAMPLES, *OR.TOKENS, *OR.windows_ctes(MODEL_LEN))
          + "SELECT example_id, wi AS \"window\", first_token::INTEGER AS first_token, n_ctx FROM win")
def clamped_windows(spark, sf_dir):
    """Windows asked for at the default length, cut to the model's own."""
    win = WN.context_windows(FX.qa_examples(spark, sf_dir), model_max_len=MODEL_LEN)
    return win.select("example_id", "window", "first_token", "n_ctx")


def standin_scorer(batch):
    """The stand-in scores of ``windows.synthetic_logits`` for a batch of windows, padded to its longest."""
    import numpy as np

    # Multipliers and moduli of the stand-in scores.
    pos = np.arange(int(batch["n_tokens"].max()))
    ex = np.array([(e["qid"] * RF.PAIR_SEED + e["passage_id"]) % 1_000_003 for e in batch["example_id"]])[:, None]
    win = batch["window"].to_numpy()[:, None]
    start = ((ex * 7919 + win * 31 + pos * 104729) % 2003) / 100.0
    end = ((ex * 104729 + win * 17 + pos * 7919) % 2003) / 100.0
    return [s[:n] for s, n in zip(start, batch["n_tokens"])], [e[:n] for e, n in zip(end, batch["n_tokens"])]


@register("reader_topk_batched", READER_SQL)
def reader_topk_batched(spark, sf_dir):
    """Reading through a scorer that gets windows of like length in batches of a token budget."""
    qs = FX.questions(spark, sf_dir)
    ranked = R.bm25_topk(corpus_index(spark, sf_dir), qs, RF.RETRIEVER_TOP_K, "okapi")
    return RF.read_retrieved(ranked, FX.passages(spark, sf_dir), qs, scorer=standin_scorer)


TOP_ANSWERS = 5


@register("reader_metrics_top5", O.with_(
    *OR.reading_ctes(),
    f"pr AS (SELECT ex.id, nb.rank, nb.text AS pred FROM nb JOIN ex USING (example_id) WHERE nb.rank <= {TOP_ANSWERS})",
    "gx AS (SELECT id, unnest(ans_text) AS g FROM ex)",
    f"pc AS (SELECT gx.id, ({O.normalize('pr.pred')} = {O.normalize('gx.g')})::INTEGER AS em, "
    f"{O.chars('pr.pred')} AS pch, {O.chars('gx.g')} AS gch FROM gx JOIN pr USING (id))",
    f"pc2 AS (SELECT *, {O.common('pch', 'gch')} AS same FROM pc)",
    f"pf AS (SELECT id, max(em) AS em, max({O.f1_from('same', 'pch', 'gch')}) AS f1 FROM pc2 GROUP BY id)")
    + "SELECT count(*) AS n_questions, round(avg(coalesce(em, 0)), 6) AS em, round(avg(coalesce(f1, 0.0)), 6) AS f1 FROM ex LEFT JOIN pf USING (id)")
def reader_metrics_top5(spark, sf_dir):
    """Reader EM / F1, the best of the first five answers."""
    ex = FX.qa_examples(spark, sf_dir)
    answers = _nbest(spark, sf_dir).join(ex.select("example_id", "id"), "example_id").select("id", "rank", "text")
    return MT.reader_topk_metrics(answers, ex, k=TOP_ANSWERS)
