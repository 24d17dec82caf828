import json

import pytest
from pyspark.sql import functions as F

from marlstone.checks import ConstraintError, require_none
from marlstone.operators import records as R
from marlstone.sources import jsonl


def test_splits(spark):
    rows = [(s,) for s in ("train", None, "  ", " Test", "validation", "EVAL", "evaluation", "mystery")]
    got = [r[0] for r in spark.createDataFrame(rows, "split string").select(R.normalize_split(F.col("split"))).collect()]
    assert got == ["train", "train", "train", "evaluation", "evaluation", "evaluation", "evaluation", None]


def test_legacy_roles_and_trainable(spark):
    df = spark.createDataFrame(
        [("a", "test", None, None), ("b", "eval", None, None), ("c", "train", None, None), ("d", "train", "training", True), ("e", "train", "holdout", None), ("f", "train", None, False)],
        "record_id string, split string, research_role string, training_eligible boolean",
    )
    n = R.with_metadata(df)
    got = {r.record_id: (r.research_role, r.training_eligible, r.t, r.s) for r in n.select("*", R.is_trainable().alias("t"), R.suite_name().alias("s")).collect()}
    assert got["a"] == ("legacy_test", False, False, "legacy_test")
    assert got["b"] == (None, None, False, "legacy_evaluation")
    assert [got[k][2] for k in "cdef"] == [True, True, False, False]
    assert R.training_records(n).count() + R.evaluation_records(n).count() == 6


def test_jsonl_lines_errors_and_forms(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    lines = [
        json.dumps({"record_id": 1, "split": "train", "question": "q", "gold_reference": "a"}),
        "",
        json.dumps({"record_id": "x", "id": "y", "split": "test", "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "v"}], "metadata": {"research_role": "mine"}}),
        "[1]",
    ]
    p.write_text("\n".join(lines))
    rows = {r.line_number: r for r in jsonl.records(spark, str(p)).collect()}
    assert sorted(rows) == [1, 3, 4]
    assert [(m.role, m.content) for m in rows[1].messages] == [("user", "q"), ("assistant", "a")]
    assert rows[3].record_id == "x" and rows[3].meta_research_role == "mine"
    assert rows[4].error.endswith(":4 must contain a JSON object")
    with pytest.raises(ConstraintError):
        require_none(jsonl.records(spark, str(p)).where("error is not null").select("error"), "source")


def test_message_errors(spark):
    ddl = "m array<struct<role:string,content:string>>"
    rows = [([("user", "q"), ("assistant", "a")],), ([("user", "q")],), ([("user", " "), ("assistant", "a")],), ([("robot", "q"), ("assistant", "a")],)]
    got = [r[0] for r in spark.createDataFrame(rows, ddl).select(R.messages_error(F.col("m"))).collect()]
    assert got == [None, "no assistant message", "blank content", "unsupported role"]


def test_preflight_counts_beyond_limit(spark):
    df = spark.createDataFrame([(i, "train", None, None, i * 10) for i in range(1, 8)], "line_number long, split string, research_role string, training_eligible boolean, n long").withColumn("source_ordinal", F.lit(0)).withColumn("record_id", F.col("line_number").cast("string"))
    p = R.preflight(df, "n", 50, 3).first()
    assert (p.trainable_records, p.skipped_overlength, p.accepted_examples, p.selected_candidates, p.longest_training) == (7, 2, 3, 3, 70)
    assert [r.line_number for r in R.selected_training(df, "n", 50, 3).collect()] == [1, 2, 3]
    assert [r.line_number for r in R.skip_samples(df, "n", 50, 1).collect()] == [6]


def test_padding_and_masks(spark):
    df = spark.createDataFrame([(1, [5, 6, 7], [-100, 6, 7]), (1, [8], [8])], "batch_id int, input_ids array<int>, labels array<int>")
    rows = sorted(R.padded(df, pad=9).collect(), key=lambda r: r.input_ids)
    assert rows[1].input_ids == [8, 9, 9] and rows[1].attention_mask == [1, 0, 0] and rows[1].labels == [8, -100, -100]
    t = R.token_totals(df).first()
    assert (t.examples, t.input_tokens, t.target_tokens) == (2, 4, 3)
    m = spark.createDataFrame([([2, 5], ["user", "assistant"], [1, 2, 3, 4, 5])], "p array<int>, r array<string>, i array<int>")
    assert m.select(R.prefix_labels(F.col("p"), F.col("r"), F.col("i"))).first()[0] == [-100, -100, 3, 4, 5]


def test_duplicates_and_violations(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", None)], "record_id string, split string").withColumn("research_role", F.lit(None).cast("string")).withColumn("training_eligible", F.lit(None).cast("boolean"))
    assert {(r.rule, r.record_id) for r in R.violations(df, {"total_records": 4}).collect()} == {("duplicate_record_id", "a"), ("unknown_split", "b"), ("count:total_records", None)}
