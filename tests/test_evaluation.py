import json
import statistics

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import prompts, rouge
from tidemark.functions.stemming import stem
from tidemark.operators import evaluation, tuning
from tidemark.plans.tables import summary_pairs
from tidemark.session import scratch_path
from tidemark.sources.readers import read_chat_samples, read_json_array, read_summary_tests
from tidemark.sources.writers import write_json_array, write_jsonl, write_small_json


def lists(fixed, *columns):
    return [fixed("pos int, value string", *enumerate(c)) for c in columns]


def test_dataset_is_cut_to_the_shorter_and_checked(fixed):
    q, c, a = lists(fixed, ["q0", "q1", "q2"], ["c0", ""], ["a0", "a1"])
    got = evaluation.evaluation_dataset(q, c, a).orderBy("pos").collect()
    assert [(r.prompt, r.response) for r in got] == [("Answer the question: q0 Context: c0", "a0"), ("Answer the question: q1 Context: ", "a1")]
    with pytest.raises(ValueError):
        evaluation.evaluation_dataset(q, c, lists(fixed, ["a0"])[0])


def test_json_array_round_trip(spark, fixed):
    path = scratch_path(spark, "array")
    write_json_array(fixed("n int, t string", (2, "b\n\"é\""), (1, "a")), "n", "t", path)
    assert [(r.pos, r.value) for r in read_json_array(spark, path).collect()] == [(0, "a"), (1, "b\n\"é\"")]


def test_long_json_arrays_are_split_and_counted_on(spark):
    path = scratch_path(spark, "array")
    write_json_array(spark.range(25).selectExpr("id", "concat('t', id) AS t"), "id", "t", path, file_rows=10)
    assert spark.read.text(path, wholetext=True).count() == 3
    got = read_json_array(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.value) for r in got] == [(i, f"t{i}") for i in range(25)]


def test_contexts(fixed):
    queries = fixed("query_id int", (1,), (2,))
    contexts = fixed("query_id int, rank int, text string", (1, 10, "z"), (1, 2, "b"), (1, 1, "a"))
    assert {(r.query_id, r.context) for r in evaluation.first_context(queries, contexts).collect()} == {(1, "a"), (2, "")}
    assert evaluation.joined_contexts(contexts).first().retrieved_context == "a\nb\nz"


def test_result_summary(spark, fixed):
    scores = fixed("pos int, metric string, score double", *[(i, m, float(i % 3)) for i in range(9) for m in ("safety", "groundedness")])
    row = evaluation.evaluation_result(scores, "exp").first()
    values = [float(i % 3) for i in range(9)]
    assert row.dataset_size == 9 and row.experiment == "exp" and len(row.metrics_table_sample) == 5
    assert row.summary_metrics["safety/mean"] == pytest.approx(1.0)
    assert row.summary_metrics["safety/std"] == pytest.approx(statistics.stdev(values))
    shown = evaluation.shown_metrics(evaluation.metric_summary(scores))
    assert {(r.key, r.shown) for r in shown.collect()} == {("safety/mean", "1.000"), ("groundedness/mean", "1.000")}
    path = scratch_path(spark, "summary")
    write_small_json(evaluation.evaluation_result(scores, "é"), path)
    text = spark.read.text(path, wholetext=True).first().value
    assert json.loads(text)["experiment"] == "é" and "é" in text and "\n" in text


def test_verdicts(fixed):
    body = '{"fidelity": "是", "relevance": "否", "hallucination": "否", "reasoning": "r"}'
    df = fixed("raw string", (body,), (f"\n```json\n{body}\n```\n",), ('{"fidelity": "是"}',), ("no idea",), (None,))
    got = [tuple(r.v) for r in df.select(prompts.verdict(F.col("raw")).alias("v")).collect()]
    assert got[0] == got[1] == ("是", "否", "否", "r", None)
    assert got[2] == ("是", None, None, None, None)
    assert got[3] == ("未知", "未知", "未知", None, "not JSON: no idea") and got[4][:3] == ("未知",) * 3


STEMS = {"running": "run", "flies": "fli", "dies": "die", "caresses": "caress", "agreed": "agre", "plastered": "plaster",
         "motoring": "motor", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi",
         "relational": "relat", "conditional": "condit", "vietnamization": "vietnam", "electrical": "electr", "hopefulness": "hope",
         "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "controlling": "control", "skies": "sky", "enjoy": "enjoy",
         "formally": "formal", "generalizations": "gener", "oscillators": "oscil", "tried": "tri", "is": "is"}


def test_stemming():
    assert {w: stem(w) for w in STEMS} == STEMS


def slow_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=90), st.lists(st.sampled_from("abcde"), max_size=90))
def test_lcs_matches_dynamic_programming(a, b):
    assert rouge.lcs_length(a, b) == slow_lcs(a, b) == rouge.lcs_length(b, a)


def test_rouge_by_hand(fixed):
    df = fixed("t string, p string", ("the cat sat", "the cat sat"), ("a b c", "x y z"), ("the the cat", "the cat cat the the"),
               ("police killed the gunman", "the gunman police killed"), ("été où", "été où"), ("x", ""), (None, "a"))
    got = [r.s for r in df.select(rouge.rouge(F.col("t"), F.col("p"), False).alias("s")).collect()]
    assert tuple(got[0]) == (1.0,) * 9 and tuple(got[1]) == (0.0,) * 9
    assert got[2].rouge1_precision == pytest.approx(3 / 5) and got[2].rouge1_recall == pytest.approx(1.0)
    assert got[3].rouge1_fmeasure == 1.0 and got[3].rougeL_recall == pytest.approx(0.5) and got[3].rouge2_precision == pytest.approx(2 / 3)
    assert got[4].rouge1_recall == 1.0  # the tokens are the plain letters between the accents
    assert tuple(got[5]) == (0.0,) * 9 and tuple(got[6]) == (0.0,) * 9
    stemmed = fixed("t string, p string", ("running dogs", "run dog")).select(rouge.rouge(F.col("t"), F.col("p")).alias("s")).first().s
    assert stemmed.rougeL_fmeasure == 1.0


def test_evaluation_drops_blocked_rows_and_compares_runs(fixed):
    tests = fixed("pos int, input_text string, output_text string", *[(i, f"doc {i}", "one two three four") for i in range(5)])
    base = fixed("pos int, response string", (0, "one two"), (1, None), (2, ""), (3, "five"), (9, "one"))
    tuned = fixed("pos int, response string", (0, "one two three four"), (1, "one"), (2, "one"), (3, "one"))
    scored = tuning.evaluate_summaries(tests, base)
    assert sorted(r.pos for r in scored.collect()) == [0, 3]
    assert tuning.blocked_responses(base).first().blocked == 2
    change = tuning.improvement(scored, tuning.evaluate_summaries(tests, tuned), ["rougeL_precision", "rougeL_recall"])
    got = {r.metric: (r.base_mean, r.tuned_mean, r.improvement_pct) for r in change.collect()}
    assert got["rougeL_precision"] == (0.5, 1.0, 100.0)
    zero = tuning.improvement(scored.filter("pos = 3"), scored).first()
    assert zero.improvement_pct is None
    assert [r.pos for r in tuning.first_tests(tests, rows=2).collect()] == [0, 1]


def test_length_statistics(spark, tmp_path):
    file = tmp_path / "tests.csv"
    file.write_text('input_text,output_text\n"a, b","' + "x" * 10 + '"\nc,"y\nz"\nd,' + "w" * 7 + "\n", encoding="utf-8")
    row = tuning.length_statistics(read_summary_tests(spark, str(file))).first()
    assert (row["count"], row["min"], row["max"], row.p50, row.token_budget) == (3, 3.0, 10.0, 7.0, 3)
    assert row["std"] == pytest.approx(statistics.stdev([10, 3, 7])) and row.p25 == pytest.approx(5.0)


def test_describe_drops_incomplete_rows(fixed):
    df = fixed("a double, b double", (1.0, 1.0), (2.0, None), (3.0, 5.0))
    got = {r.metric: (r["count"], r["mean"]) for r in tuning.describe(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 2.0), "b": (2, 3.0)}


def test_describe_of_nothing(fixed):
    row = tuning.describe(fixed("a double", (None,)), ["a"]).first()
    assert (row["count"], row["mean"], row.p50) == (0, None, None)


def test_describe_in_one_approximate_pass(spark):
    df = spark.range(1, 1001).selectExpr("double(id) AS a", "double(id % 10) AS b")
    exact, near = [{r.metric: r for r in tuning.describe(df, ["a", "b"], accuracy=a).collect()} for a in (None, 1000)]
    for metric in ("a", "b"):
        for name in ("count", "mean", "std", "min", "max"):
            assert exact[metric][name] == pytest.approx(near[metric][name])
        for name in ("p25", "p50", "p75"):
            assert near[metric][name] == pytest.approx(exact[metric][name], abs=2)


def test_chat_conversion(spark, fixed):
    source, out = scratch_path(spark, "chat"), scratch_path(spark, "tuned")
    samples = fixed("messages array<struct<role:string,content:string>>", ([("system", "s"), ("user", "é")],), ([],))
    write_jsonl(samples, source)
    write_jsonl(tuning.convert_samples(read_chat_samples(spark, source)), out)
    lines = sorted((json.loads(r.value) for r in spark.read.text(out).collect()), key=lambda d: len(d["contents"]))
    assert lines == [{"contents": []}, {"contents": [{"role": "system", "parts": [{"text": "s"}]}, {"role": "user", "parts": [{"text": "é"}]}]}]


def test_long_conversations_are_converted_turn_by_turn(spark, fixed):
    source, out = scratch_path(spark, "chat"), scratch_path(spark, "tuned")
    turns = fixed("conv_id int, turn int, role string, text string", *[(1, i, "user", f"t{i}") for i in range(1006)], (2, 0, "user", None))
    write_jsonl(turns.selectExpr("conv_id", "turn", "array(struct(role, text AS content)) AS messages"), source)
    write_jsonl(tuning.convert_samples(read_chat_samples(spark, source, "conv_id int, turn int")), out)
    got = spark.read.schema("conv_id int, turn int, contents array<struct<role:string,parts:array<struct<text:string>>>>").json(out).collect()
    assert sorted((r.conv_id, r.turn, r.contents[0].parts[0].text or "") for r in got) == [(1, i, f"t{i}") for i in range(1006)] + [(2, 0, "")]


def test_summary_keys_of_long_conversations_do_not_collide(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}") for c, n in ((0, 1006), (1, 6)) for t in range(n)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = summary_pairs(spark, str(tmp_path))
    assert got.count() == got.select("pos").distinct().count() == 506


def test_role_problems(fixed):
    turns = fixed("conv_id int, turn int, role string", (1, 0, "system"), (1, 1, "user"), (1, 2, "user"), (1, 3, "model"),
                  (2, 0, "model"), (3, 0, "user"), (3, 1, "system"))
    got = {(r.conv_id, r.turn): r.problem for r in tuning.role_problems(turns).collect() if r.problem}
    assert got == {(1, 2): "repeated role", (2, 0): "does not start with user", (3, 1): "system turn after the start"}


def test_metric_series(fixed):
    series = fixed("metric string, step bigint, value double", ("/train_total_loss", 2, 0.5), ("/train_total_loss", 1, 0.9), ("/eval_total_loss", 2, 0.7))
    assert [tuple(r) for r in tuning.metric_series(series, "/train_total_loss").collect()] == [(1, 0.9), (2, 0.5)]
    wide = tuning.metrics_by_step(series, ["/train_total_loss", "/eval_total_loss"]).orderBy("step").collect()
    assert [tuple(r) for r in wide] == [(1, 0.9, None), (2, 0.5, 0.7)]


def test_decimals(fixed):
    row = fixed("v double", (0.12345,)).select(prompts.decimals(F.col("v"), 3), prompts.decimals(F.col("v"), 4)).first()
    assert tuple(row) == ("0.123", "0.1235") or tuple(row) == ("0.123", "0.1234")
