"""Queries over evaluation sets, chat samples, summaries and metric series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import prompts
from tidemark.functions.rouge import METRICS
from tidemark.operators import evaluation, tuning
from tidemark.operators.ordered import global_row_number
from tidemark.plans.corpus_queries import RETRIEVED_SQL, retrieved_contexts
from tidemark.plans.tables import label_scores, positions, summary_pairs, table
from tidemark.session import checkpointed, scratch_path
from tidemark.sources.readers import read_chat_samples, read_json_array
from tidemark.sources.writers import write_json_array, write_jsonl, write_small_json

EXPERIMENT = "evaluation-1"
EVENT_METRICS = ("click", "error", "purchase", "signup", "view")
NGRAM_METRICS = [m for m in METRICS if not m.startswith("rougeL")]


def eval_dataset(spark, sf_dir):
    """Benchmark texts as questions (through the JSON-array file), documents as contexts, marked texts as answers."""
    path = scratch_path(spark, "questions")
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    write_json_array(benchmark, "item_id", "text", path)
    questions = read_json_array(spark, path)
    contexts = positions(table(spark, sf_dir, "documents"), "doc_id", "text")
    answers = positions(benchmark.withColumn("answer", F.concat(F.lit("A: "), "text")), "item_id", "answer")
    aligned = evaluation.evaluation_dataset(questions, contexts, answers)
    return aligned


def first_context(spark, sf_dir):
    """The best retrieved context of each benchmark text."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"))
    return evaluation.first_context(queries, retrieved_contexts(spark, sf_dir))


def joined_contexts(spark, sf_dir):
    """All retrieved contexts of each benchmark text that has any."""
    return evaluation.joined_contexts(retrieved_contexts(spark, sf_dir))


def eval_summary(spark, sf_dir):
    shown = evaluation.shown_metrics(evaluation.metric_summary(label_scores(spark, sf_dir)))
    return shown.select("key", F.round("value", 6).alias("value"), "shown")


def eval_result(spark, sf_dir):
    result = evaluation.evaluation_result(label_scores(spark, sf_dir), EXPERIMENT)
    return result.select("experiment", "dataset_size", F.round(F.col("summary_metrics")["quality/mean"], 6).alias("quality_mean"),
                         F.round(F.col("summary_metrics")["toxic/std"], 6).alias("toxic_std"),
                         F.array_join(F.transform("metrics_table_sample", lambda r: F.concat_ws(
                             ":", r["pos"].cast("string"), r["metric"], r["score"].cast("int").cast("string"))), " ").alias("sample"))


def verdict_parse(spark, sf_dir):
    """Verdict texts built from the labels: fenced, plain, without a field, and broken."""
    q, t = F.col("quality"), F.col("toxic")
    yes_no = F.when(q == 1, F.lit("是")).otherwise(F.lit("否"))
    body = F.concat(F.lit('{"fidelity": "'), yes_no, F.lit('", "relevance": "是"'),
                    F.when(q == 1, F.lit(', "hallucination": "否"')).otherwise(F.lit("")),
                    F.lit(', "reasoning": "doc '), F.col("doc_id").cast("string"), F.lit('", "extra": 1}'))
    raw = (F.when(t == 1, F.concat(F.lit("I cannot say: "), body))
           .when(q == 1, F.concat(F.lit(" \n```json\n"), body, F.lit("\n```\n")))
           .otherwise(body))
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", prompts.verdict(raw).alias("v")).select("doc_id", "v.*")


def sft_convert(spark, sf_dir):
    """Conversation turns to chat JSONL, read back, converted, written as tuning JSONL, read back again: a row stays a row."""
    chat, tuned = scratch_path(spark, "chat"), scratch_path(spark, "tuning")
    turns = table(spark, sf_dir, "conversations")
    message = F.array(F.struct("role", F.col("text").alias("content")))
    write_jsonl(turns.select("conv_id", "turn", message.alias("messages")), chat)
    write_jsonl(tuning.convert_samples(read_chat_samples(spark, chat, "conv_id bigint, turn bigint")), tuned)
    back = spark.read.schema("conv_id bigint, turn bigint, contents array<struct<role:string,parts:array<struct<text:string>>>>").json(tuned)
    return back.select("conv_id", "turn", F.inline("contents")).select("conv_id", "turn", "role", F.col("parts")[0]["text"].alias("text"))


def sft_validate(spark, sf_dir):
    return tuning.role_problems(table(spark, sf_dir, "conversations"))


def length_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("output_text"))
    stats = tuning.length_statistics(docs)
    return stats.select("metric", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
                        "token_budget")


def _evaluated(spark, sf_dir, model, use_stemmer):
    return tuning.evaluate_runs(summary_pairs(spark, sf_dir), [model], use_stemmer)


def rouge_scores(spark, sf_dir):
    """ROUGE-1 and ROUGE-2 without stemming, which SQL can express as well."""
    scored = _evaluated(spark, sf_dir, "base", False)
    return scored.select("pos", *[F.round(m, 6).alias(m) for m in NGRAM_METRICS])


def rouge_l_scores(spark, sf_dir):
    """ROUGE-L without stemming."""
    scored = _evaluated(spark, sf_dir, "base", False)
    return scored.select("pos", *[F.round(m, 6).alias(m) for m in METRICS if m.startswith("rougeL")])


def rouge_full_scores(spark, sf_dir):
    """All nine scores with stemming, as the evaluation uses them."""
    scored = _evaluated(spark, sf_dir, "base", True)
    return scored.select("pos", *[F.round(m, 6).alias(m) for m in METRICS])


def rouge_stemming(spark, sf_dir):
    """Per pair: merging word forms can only add overlap, so no stemmed score is below the plain one."""
    plain = _evaluated(spark, sf_dir, "base", False).select("pos", *(F.col(m).alias(f"plain_{m}") for m in METRICS))
    both = _evaluated(spark, sf_dir, "base", True).join(plain, "pos")
    holds = [F.col(m) >= F.col(f"plain_{m}") - 1e-12 for m in METRICS]
    return both.select("pos", *(h.alias(m) for h, m in zip(holds, METRICS)))


def first_tests(spark, sf_dir):
    """The evaluation batch: the first 100 summary tests by conversation and turn."""
    pairs = summary_pairs(spark, sf_dir).select(
        F.split_part("pos", F.lit(":"), F.lit(1)).cast("bigint").alias("conv_id"), F.split_part("pos", F.lit(":"), F.lit(2)).cast("bigint").alias("turn"), "input_text")
    return tuning.first_tests(pairs.withColumn("place", F.struct("conv_id", "turn")), "place").drop("place")


def summary_file(spark, sf_dir):
    """The evaluation summary written as one JSON file, and what its fields read as."""
    path = scratch_path(spark, "summary")
    result = evaluation.evaluation_result(label_scores(spark, sf_dir), EXPERIMENT)
    write_small_json(result.select("experiment", "dataset_size", "summary_metrics", "metadata", "metrics_table_sample"), path)
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", (
        "experiment string, dataset_size bigint, summary_metrics map<string,double>, metadata map<string,string>, "
        "metrics_table_sample array<struct<pos:bigint,metric:string,score:double>>")).alias("r"))
    return text.select("r.experiment", "r.dataset_size", F.round(F.col("r.summary_metrics")["quality/mean"], 6).alias("quality_mean"),
                       F.size("r.metadata").cast("bigint").alias("metadata"), F.size("r.metrics_table_sample").cast("bigint").alias("sample"))


def rouge_stats(spark, sf_dir):
    scored = checkpointed(_evaluated(spark, sf_dir, "base", False).select(*NGRAM_METRICS))
    stats = tuning.describe(scored, NGRAM_METRICS)
    return stats.select("metric", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def rouge_improvement(spark, sf_dir):
    scored = tuning.evaluate_runs(summary_pairs(spark, sf_dir), ["base", "tuned"], use_stemmer=False)
    change = tuning.change_of_runs(scored, ["rouge1_precision", "rouge2_recall"])
    return change.select("metric", F.round("base_mean", 6).alias("base_mean"), F.round("tuned_mean", 6).alias("tuned_mean"),
                         "improvement_pct")


def _series(spark, sf_dir):
    """Events as metric series: the step is the row number over time."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", F.col("event_type").alias("metric"), "value")
    numbered = global_row_number(events, ["ts", "event_id"], "row_no")
    return numbered.select("metric", F.floor((F.col("row_no") - 1) / F.lit(5)).alias("step"), "row_no", "value")


def loss_series(spark, sf_dir):
    """All metrics side by side, one row per step of five events; the latest value of a step counts."""
    last = _series(spark, sf_dir).groupBy("metric", "step").agg(F.max_by("value", "row_no").alias("value"))
    return tuning.metrics_by_step(last, EVENT_METRICS)


def loss_metric(spark, sf_dir):
    series = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), F.col("event_id").alias("step"), "value")
    return tuning.metric_series(series, "purchase")


QUERIES = {f.__name__: f for f in (
    eval_dataset, first_context, joined_contexts, eval_summary, eval_result, verdict_parse, sft_convert, sft_validate,
    length_stats, rouge_scores, rouge_l_scores, rouge_full_scores, rouge_stemming, first_tests, summary_file, rouge_stats, rouge_improvement, loss_series, loss_metric)}

_CONTEXTS = f"""{RETRIEVED_SQL},
    c AS (SELECT query_id, rank, t.text FROM found f JOIN texts t ON t.id = f.chunk_key)"""


def _scores_sql(name: str, prediction: str) -> str:
    """Clipped n-gram overlaps of user turns with a later turn."""
    step, role = prediction
    parts = [f"""
    p_{name} AS (SELECT u.conv_id || ':' || u.turn AS pos, regexp_extract_all(lower(u.text), '[a-z0-9]+') AS t,
                 regexp_extract_all(lower(a.text), '[a-z0-9]+') AS p
          FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + {step} AND a.role = '{role}'
          WHERE u.role = 'user' AND length(a.text) > 0)"""]
    for n in (1, 2):
        gram = "x" if n == 1 else "x || ' ' || y"
        for side in ("t", "p"):
            source = (f"SELECT pos, unnest({side}) AS g FROM p_{name}" if n == 1 else
                      f"SELECT pos, unnest(list_transform(range(1, len({side})), lambda i: {side}[i] || ' ' || {side}[i + 1])) AS g FROM p_{name}")
            parts.append(f"g{n}{side}_{name} AS (SELECT pos, g, count(*) AS n FROM ({source}) GROUP BY ALL)")
        parts.append(f"""o{n}_{name} AS (SELECT a.pos, sum(least(a.n, b.n))::double AS o FROM g{n}t_{name} a
                     JOIN g{n}p_{name} b ON a.pos = b.pos AND a.g = b.g GROUP BY a.pos)""")
    parts.append(f"""r_{name} AS (SELECT p.pos, coalesce(o1.o, 0) AS o1, coalesce(o2.o, 0) AS o2, len(t)::double AS t1,
                 len(p)::double AS p1, greatest(len(t) - 1, 0)::double AS t2, greatest(len(p) - 1, 0)::double AS p2
                 FROM p_{name} p LEFT JOIN o1_{name} o1 ON o1.pos = p.pos LEFT JOIN o2_{name} o2 ON o2.pos = p.pos)""")
    parts.append(f"""s_{name} AS (SELECT pos,
        CASE WHEN p1 > 0 THEN o1 / p1 ELSE 0 END AS rouge1_precision, CASE WHEN t1 > 0 THEN o1 / t1 ELSE 0 END AS rouge1_recall,
        CASE WHEN o1 > 0 THEN 2 * (o1 / p1) * (o1 / t1) / (o1 / p1 + o1 / t1) ELSE 0 END AS rouge1_fmeasure,
        CASE WHEN p2 > 0 THEN o2 / p2 ELSE 0 END AS rouge2_precision, CASE WHEN t2 > 0 THEN o2 / t2 ELSE 0 END AS rouge2_recall,
        CASE WHEN o2 > 0 THEN 2 * (o2 / p2) * (o2 / t2) / (o2 / p2 + o2 / t2) ELSE 0 END AS rouge2_fmeasure FROM r_{name})""")
    return ",\n".join(parts)


_BASE, _TUNED = _scores_sql("base", (1, "assistant")), _scores_sql("tuned", (2, "user"))
_DESCRIBE = """count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6)::double AS min,
    round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
    round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6)::double AS max"""

SQL = {
    "eval_dataset": """
        SELECT b.item_id AS pos, 'Answer the question: ' || b.text || ' Context: ' || d.text AS prompt, 'A: ' || b.text AS response
        FROM benchmark b JOIN documents d ON d.doc_id = b.item_id""",
    "first_context": f"""WITH {_CONTEXTS}
        SELECT b.item_id AS query_id, coalesce(c.text, '') AS context
        FROM benchmark b LEFT JOIN c ON c.query_id = b.item_id AND c.rank = 1""",
    "joined_contexts": f"""WITH {_CONTEXTS}
        SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS retrieved_context FROM c GROUP BY query_id""",
    "eval_summary": """
        SELECT 'quality/mean' AS key, round(avg(quality), 6) AS value, printf('%.3f', avg(quality)) AS shown FROM labels
        UNION ALL SELECT 'toxic/mean', round(avg(toxic), 6), printf('%.3f', avg(toxic)) FROM labels""",
    "eval_result": f"""
        WITH s AS (SELECT doc_id || ':quality:' || quality AS t, doc_id, 1 AS m FROM labels
                   UNION ALL SELECT doc_id || ':toxic:' || toxic, doc_id, 2 FROM labels),
             f AS (SELECT * FROM s ORDER BY doc_id, m LIMIT 5)
        SELECT '{EXPERIMENT}' AS experiment, (SELECT count(DISTINCT doc_id) FROM labels) AS dataset_size,
               (SELECT round(avg(quality), 6) FROM labels) AS quality_mean,
               (SELECT round(stddev_samp(toxic), 6) FROM labels) AS toxic_std,
               (SELECT string_agg(t, ' ' ORDER BY doc_id, m) FROM f) AS sample""",
    "verdict_parse": """
        WITH b AS (SELECT doc_id, quality, toxic, CASE WHEN quality = 1 THEN '是' ELSE '否' END AS yn FROM labels)
        SELECT doc_id, CASE WHEN toxic = 1 THEN '未知' ELSE yn END AS fidelity,
               CASE WHEN toxic = 1 THEN '未知' ELSE '是' END AS relevance,
               CASE WHEN toxic = 1 THEN '未知' WHEN quality = 1 THEN '否' END AS hallucination,
               CASE WHEN toxic = 0 THEN 'doc ' || doc_id END AS reasoning,
               CASE WHEN toxic = 1 THEN 'not JSON: I cannot say: {"fidelity": "' || yn || '", "relevance": "是"'
                    || CASE WHEN quality = 1 THEN ', "hallucination": "否"' ELSE '' END
                    || ', "reasoning": "doc ' || doc_id || '", "extra": 1}' END AS error FROM b""",
    "sft_convert": """
        SELECT conv_id, turn, role, text FROM conversations""",
    "sft_validate": """
        WITH s AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role FROM conversations)
        SELECT *, CASE WHEN role = 'system' AND prev_role IS NOT NULL THEN 'system turn after the start'
                       WHEN role = prev_role THEN 'repeated role'
                       WHEN (prev_role IS NULL OR prev_role = 'system') AND role NOT IN ('user', 'system')
                       THEN 'does not start with user' END AS problem FROM s""",
    "length_stats": f"""
        WITH d AS (SELECT length(text)::double AS c FROM documents)
        SELECT 'length' AS metric, {_DESCRIBE.format(c='c')}, ceil(max(c) / 4)::bigint AS token_budget FROM d""",
    "rouge_scores": f"WITH {_BASE} SELECT pos, " + ", ".join(f"round({m}, 6)::double AS {m}" for m in NGRAM_METRICS) + " FROM s_base",
    "rouge_l_scores": f"""WITH RECURSIVE {_BASE.split('g1t_base')[0].rstrip().rstrip(',')},
        s AS (SELECT pos, t, p, 0 AS i, list_transform(t, lambda x: 0) AS best FROM p_base
              UNION ALL
              SELECT pos, t, p, i + 1, list_transform(range(1, len(t) + 1), lambda j: list_max(list_transform(range(1, j + 1),
                     lambda m: CASE WHEN t[m] = p[i + 1] THEN (CASE WHEN m > 1 THEN best[m - 1] ELSE 0 END) + 1 ELSE best[m] END)))
              FROM s WHERE i < len(p)),
        l AS (SELECT pos, len(t)::double AS t, len(p)::double AS p,
                     CASE WHEN len(t) = 0 THEN 0 ELSE best[len(t)] END::double AS o FROM s WHERE i = len(p))
        SELECT pos, CASE WHEN p > 0 THEN round(o / p, 6) ELSE 0 END AS "rougeL_precision",
               CASE WHEN t > 0 THEN round(o / t, 6) ELSE 0 END AS "rougeL_recall",
               CASE WHEN o > 0 THEN round(2 * (o / p) * (o / t) / (o / p + o / t), 6) ELSE 0 END AS "rougeL_fmeasure" FROM l""",
    "rouge_stemming": f"WITH {_BASE} SELECT pos, " + ", ".join(f'true AS "{m}"' for m in METRICS) + " FROM s_base",
    "first_tests": "SELECT conv_id, turn, text AS input_text FROM conversations WHERE role = 'user' ORDER BY conv_id, turn LIMIT 100",
    "summary_file": f"""
        SELECT '{EXPERIMENT}' AS experiment, count(DISTINCT doc_id) AS dataset_size, round(avg(quality), 6) AS quality_mean,
               0::bigint AS metadata, 5::bigint AS sample FROM labels""",
    "rouge_stats": f"WITH {_BASE} " + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {_DESCRIBE.format(c=m)} FROM s_base" for m in NGRAM_METRICS),
    "rouge_improvement": f"WITH {_BASE}, {_TUNED} " + " UNION ALL ".join(f"""
        SELECT '{m}' AS metric, round(b, 6) AS base_mean, round(t, 6) AS tuned_mean, round((t - b) / b * 100, 2) AS improvement_pct
        FROM (SELECT (SELECT avg({m}) FROM s_base) AS b, (SELECT avg({m}) FROM s_tuned) AS t)""" for m in ("rouge1_precision", "rouge2_recall")),
    "loss_series": """
        WITH n AS (SELECT event_type, value, row_number() OVER (ORDER BY ts, event_id) AS r FROM events),
             s AS (SELECT event_type, (r - 1) // 5 AS step, arg_max(value, r) AS v FROM n GROUP BY ALL)
        SELECT step::bigint AS step, """ + ", ".join(f"max(v) FILTER (event_type = '{m}') AS {m}" for m in EVENT_METRICS) + """
        FROM s GROUP BY step""",
    "loss_metric": "SELECT event_id AS step, value FROM events WHERE event_type = 'purchase' ORDER BY step",
}
