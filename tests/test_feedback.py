from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evaluation as ev
from corpusloom.operators import feedback as fb
from corpusloom.operators.joins import full_join_many, left_join_many

LOG = """request_id string, source struct<id string>, timestamp timestamp, step_id string,
text_assessment struct<ratings map<string, struct<value string>>, suggested_output string>,
retrieval_assessment struct<doc_uri string, value string>, schema_version string, event_id long"""


def text(request, user, minute, value, edited="", event=0, rating="answer_correct"):
    ratings = {rating: (value,)}
    return (request, (user,), datetime(2024, 1, 1, 0, minute), None, (ratings, edited), None, "1", event)


def passage(request, user, step, uri, value="positive", minute=0, event=0):
    return (request, (user,), datetime(2024, 1, 1, 0, minute), step, None, (uri, value), "1", event)


ROWS = [
    text("r1", "a", 1, "negative", "", 1),
    text("r1", "b", 2, "positive", "better", 2),
    text("r2", "a", 1, "negative", "", 3),
    text("r3", "a", 1, "unsure", "edit3", 4),
    text("r4", "a", 5, "positive", "", 5),
    text("r4", "a", 5, "negative", "fix4", 6),
    text("r5", "a", 1, None, "", 7),
    text("r6", "a", 1, "positive", "", 8, rating="other"),
    text("r9", "a", 1, "positive", "", 9),
    passage("r1", "b", "s0", "d1"),
    passage("r1", "b", "s0", "d1"),
    passage("r1", "b", "s0", "d0", "negative"),
    passage("r1", "b", "s1", "d2"),
    passage("r1", "c", "s1", "d9"),
    passage("r7", "a", "s0", "d7"),
]
REQUESTS = [(f"r{i}", f"q{i}", f"a{i}") for i in range(1, 9)]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(ROWS, LOG).cache()


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(
        REQUESTS, "log_id string, request string, response string"
    )


@pytest.fixture(scope="module")
def merged(log):
    return fb.merge_assessments(
        fb.latest_text_assessment(log, "event_id"), fb.collect_retrieval(log)
    ).cache()


def test_latest_assessment_is_per_request_with_tie_break(log):
    rows = fb.latest_text_assessment(log, "event_id").collect()
    got = {r.request_id: r.source.id for r in rows}
    assert got["r1"] == "b" and len(rows) == len(got) == 7
    r4 = next(r for r in rows if r.request_id == "r4")
    assert r4.text_assessment.suggested_output == "fix4"
    both = fb.latest_text_assessment(
        log.withColumn("user_id", F.col("source.id")), "event_id", ("request_id", "user_id")
    )
    assert both.where("request_id = 'r1'").count() == 2


def test_collected_assessments_keep_repeats_as_counts(log):
    rows = fb.collect_retrieval(log).where("request_id = 'r1' and user_id = 'b' and step_id = 's0'")
    got = sorted((r.assessment.doc_uri, r.assessment.value, r.n) for r in rows.collect())
    assert got == [("d0", "negative", 1), ("d1", "positive", 2)]


@pytest.mark.parametrize("many", [3, 2500])
def test_row_counts_do_not_depend_on_the_size_of_a_step(spark, requests, many):
    rows = [passage("r1", "a", "s0", f"d{i:05}") for i in range(many)] * 2 + [text("r1", "a", 1, "positive")]
    log = spark.createDataFrame(rows, LOG)
    collected = fb.collect_retrieval(log)
    assert collected.count() == many and {r.n for r in collected.select("n").collect()} == {2}
    merged = fb.merge_assessments(fb.latest_text_assessment(log, "event_id"), collected)
    # One step is one row of feedback and one of the evaluation set.
    assert [(r.step_id, r.n_assessments, r.n_distinct) for r in merged.collect()] == [("s0", 2 * many, many)]
    assert fb.requests_with_feedback(requests, merged).count() == len(REQUESTS)
    assert fb.eval_set(requests, merged).count() == 1


@pytest.mark.parametrize("many", [2, 2500])
def test_feedback_carries_all_assessments_of_a_step(spark, requests, many):
    rows = [passage("r1", "a", "s0", f"d{i:05}") for i in range(many)] * 2 + [text("r1", "a", 1, "positive")]
    log = spark.createDataFrame(rows + [passage("r1", "a", "s0", None)], LOG)
    collected = fb.collect_retrieval(log)
    want = [((None, "positive"), 1), *(((f"d{i:05}", "positive"), 2) for i in range(many))]
    steps = fb.retrieval_steps(collected).collect()
    merged = fb.merge_assessments(fb.latest_text_assessment(log, "event_id"), collected)
    joined = fb.requests_with_feedback(requests, merged).where("log_id = 'r1'").collect()
    for found in (steps, merged.collect(), joined):
        assert [[(tuple(a.assessment), a.n) for a in r.retrieval_assessments] for r in found] == [want]


def test_merge_loses_the_id_of_retrieval_only_feedback(log, merged):
    rows = merged.collect()
    # r1 twice (two steps), six other texts, c on r1 and a on r7 without an id.
    assert sorted(r.request_id or "" for r in rows) == [
        "", "", "r1", "r1", "r2", "r3", "r4", "r5", "r6", "r9",
    ]
    kept = fb.merge_assessments(
        fb.latest_text_assessment(log, "event_id"), fb.collect_retrieval(log), keep_retrieval_only=True
    )
    assert kept.where("request_id = 'r7' and source.id = 'a'").count() == 1


def test_requests_with_feedback_keeps_every_request(requests, merged):
    rows = fb.requests_with_feedback(requests, merged).collect()
    assert len(rows) == 9
    assert {r.log_id for r in rows if r.request_id is None} == {"r7", "r8"}


def test_eval_set_as_coded(requests, merged):
    rows = [tuple(r) for r in fb.eval_set(requests, merged).collect()]
    assert sorted(rows, key=str) == [
        # The logged response although it was edited, once per step.
        ("r1", "q1", "a1", "thumbs_up", "b"),
        ("r1", "q1", "a1", "thumbs_up", "b"),
        ("r2", "q2", None, "thumbs_down", "a"),
        ("r3", "q3", "edit3", "no_feedback_provided", "a"),
        ("r4", "q4", "fix4", "thumbs_down", "a"),
    ]


def test_eval_set_as_documented(requests, merged, log):
    rows = {r.request_id: r for r in fb.eval_set_documented(requests, merged, log).collect()}
    assert rows["r1"].expected_response == "better"
    assert rows["r8"].type == "no_feedback_provided" and rows["r8"].expected_response is None
    assert "r7" not in rows and "r9" not in rows


def test_expected_context(log):
    got = {tuple(r) for r in fb.expected_context(log).collect()}
    assert got == {("r1", "d1"), ("r1", "d2"), ("r1", "d9"), ("r7", "d7")}


def test_joins_of_many_rows_equal_plain_joins(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, x string")
    many = spark.createDataFrame(
        [(1, 10), (1, 11), (3, 30), (None, 99)], "k long, y long"
    )
    left = left_join_many(one, many, ["k"])
    assert sorted(map(tuple, left.collect()), key=str) == sorted(
        map(tuple, one.join(many, "k", "left").collect()), key=str
    )
    full = full_join_many(one, many, ["k"])
    plain = one.join(many.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "full").drop("k2")
    assert sorted(map(tuple, full.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame(
        [("m", "9", 1), ("m", "10", 2), ("n", "3", 3)], "name string, version string, id long"
    )
    got = {r.name: r.version for r in ev.latest_per_key(df, ["name"], "version", "id").collect()}
    assert got == {"m": "10", "n": "3"}
    assert ev.latest_version(df, "version").first().version == 10
    assert ev.latest_version(df.limit(0), "version").first().version == 1


def test_metrics_by_hand(spark):
    evaluation = spark.createDataFrame(
        [
            ("r1", "q", "the red fox", "thumbs_up", "a"),
            ("r1", "q", "the red fox", "thumbs_up", "a"),
            ("r2", "q", "b", "thumbs_up", "a"),
            ("r3", "q", None, "thumbs_down", "a"),
        ],
        "request_id string, request string, expected_response string, type string, user_id string",
    )
    answers = spark.createDataFrame(
        [("r1", "the the fox"), ("r2", "b"), ("r3", "z")], "request_id string, answer string"
    )
    hits = spark.createDataFrame(
        [("r1", "d1"), ("r1", "d2"), ("r1", "d2"), ("r3", "d5")], "request_id string, doc_uri string"
    )
    expected = spark.createDataFrame(
        [("r1", "d1"), ("r1", "d8"), ("r2", "d1")], "request_id string, doc_uri string"
    )
    got = {
        (r.type, r.metric): r.value
        for r in ev.eval_metrics(evaluation, answers, hits, expected).collect()
    }
    assert got["thumbs_up", "rows"] == 3
    assert got["thumbs_up", "exact_match"] == pytest.approx(1 / 3, abs=1e-6)
    assert got["thumbs_up", "token_f1"] == pytest.approx((2 / 3 + 2 / 3 + 1) / 3, abs=1e-6)
    assert got["thumbs_up", "recall_at_k"] == pytest.approx((0.5 + 0.5 + 0) / 3, abs=1e-6)
    assert got["thumbs_up", "precision_at_k"] == pytest.approx((0.5 + 0.5 + 0) / 3, abs=1e-6)
    assert got["thumbs_down", "exact_match"] is None


def test_a_request_without_an_answer_scores_nothing(spark):
    evaluation = spark.createDataFrame(
        [("r1", "q", "a fox", "t", "a"), ("r2", "q", "b", "t", "a")],
        "request_id string, request string, expected_response string, type string, user_id string",
    )
    answers = spark.createDataFrame([("r1", "a fox")], "request_id string, answer string")
    none = spark.createDataFrame([], "request_id string, doc_uri string")
    got = {r.metric: r.value for r in ev.eval_metrics(evaluation, answers, none, none).collect()}
    assert got["exact_match"] == 0.5 and got["token_f1"] == 0.5 and got["recall_at_k"] is None


def test_fewer_rows_are_no_regression(spark):
    runs = [spark.createDataFrame([("t", "rows", n)], "type string, metric string, value double") for n in (3.0, 5.0)]
    assert [(r.delta, r.regressed) for r in ev.eval_compare(*runs).collect()] == [(-2.0, False)]


def test_compare_flags_regressions(spark):
    def run(*rows):
        return spark.createDataFrame(rows, "type string, metric string, value double")

    got = ev.eval_compare(
        run(("t", "a", 0.5), ("t", "b", 0.9), ("t", "new", 1.0)), run(("t", "a", 0.6), ("t", "b", 0.9))
    )
    rows = {r.metric: (r.delta, r.regressed) for r in got.collect()}
    assert rows == {"a": (-0.1, True), "b": (0.0, False), "new": (None, False)}
