"""Reading datasets behind manifests: every check that must stop a reader, and what it reads."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from marlstone import lineage
from marlstone.checks import ConstraintError
from marlstone.functions import canon, text
from marlstone.operators import records as R
from marlstone.sources import jsonl, manifests


def literal_checksum(data):
    return hashlib.sha256(json.dumps(data, ensure_ascii=False).encode()).hexdigest()


def row(i, split="train", **more):
    return {"record_id": i, "split": split, "question": f"q{i}", "output": f"a{i}", **more}


class Package:
    """A package of one dataset and evaluation sets by role; the files can be broken afterwards."""

    def __init__(self, folder, roles=("exact_recall", "paraphrase"), train=2):
        self.folder, self.sets = folder, {}
        self.records = {"dataset": [row(str(k)) for k in range(train)]}
        for n, role in enumerate(roles):
            self.records[role] = [row(f"{role}-{k}", "evaluation", research_role=role, training_eligible=False) for k in range(n + 1)]

    def put(self, name, value):
        (self.folder / name).write_text(value if isinstance(value, str) else json.dumps(value))
        return str(self.folder / name)

    def write(self, declared=None, dataset=None, package=None):
        bodies = {k: "\n".join(map(json.dumps, rows)) + "\n" for k, rows in self.records.items()}
        files = {k: (self.put(f"{k}.jsonl", b), literal_checksum(b)) for k, b in bodies.items()}
        ds = {"schema_version": "d/1", "records_uri": files["dataset"][0], "records_checksum": "sha256:" + files["dataset"][1], **(dataset or {})}
        refs = []
        for role in [k for k in bodies if k != "dataset"]:
            m = {"schema": "e/1", "evaluation_set_id": f"set-{role}", "evaluation_set_version": "1", "research_role": role, "training_eligible": False, "records_uri": files[role][0], "records_checksum": files[role][1], "record_count": len(self.records[role]), "freeze_checksum": "f"}
            m |= (declared or {}).get(role, {})
            m["manifest_checksum"] = lineage.manifest_checksum(m)
            refs.append({"manifest_uri": self.put(f"{role}.json", m), **{k: m.get(k) for k in manifests.REFERENCE_FIELDS}})
        p = {"dataset": {"manifest_uri": self.put("dataset.json", ds), "records_checksum": ds["records_checksum"]}, "evaluation_sets": refs, **(package or {})}
        p["manifest_checksum"] = lineage.manifest_checksum(p)
        return self.put("package.json", p)


def test_package_records(spark, tmp_path):
    path = Package(tmp_path).write()
    own = manifests.package_records(spark, path, schemas={"dataset": "d/1", "evaluation_set": "e/1"})
    assert [r.record_id for r in own.orderBy("source_ordinal", "line_number").collect()] == ["0", "1", "exact_recall-0", "paraphrase-0", "paraphrase-1"]
    assert {r.suite: r.n for r in R.suite_counts(own).collect()} == {"exact_recall": 1, "paraphrase": 2}
    s = R.statistics(own).first()
    assert (s.total_records, s.training_records, s.evaluation_records) == (5, 2, 3)


@pytest.mark.parametrize(
    ("change", "why"),
    [
        (lambda p: p.records["paraphrase"].append(row("0", "evaluation", research_role="paraphrase", training_eligible=False)), "duplicate_record_id"),
        (lambda p: p.records["paraphrase"].append(row("x", "evaluation", research_role="paraphrase", training_eligible=True)), "evaluation_record_trainable"),
        (lambda p: p.records["paraphrase"].append(row("x", "train", research_role="paraphrase", training_eligible=False)), "evaluation_record_trainable"),
        (lambda p: p.records["paraphrase"].append(row("x", "evaluation", research_role="other", training_eligible=False)), "evaluation_role_differs"),
        (lambda p: p.records["dataset"].append(row("x", "mystery")), "invalid records"),
        (lambda p: p.records["dataset"].append({"record_id": "x", "question": " \t", "output": "a"}), "invalid records"),
        (lambda p: p.records["dataset"].append([1]), "no JSON objects"),
    ],
)
def test_bad_records_stop_the_reader(spark, tmp_path, change, why):
    p = Package(tmp_path)
    change(p)
    with pytest.raises(ConstraintError, match=why):
        manifests.package_records(spark, p.write())


@pytest.mark.parametrize(
    ("how", "why"),
    [
        ({"declared": {"paraphrase": {"record_count": 7}}}, "record_count_differs"),
        ({"declared": {"paraphrase": {"records_checksum": "0"}}}, "checksum differs"),
        ({"declared": {"paraphrase": {"research_role": "exact_recall"}}}, "roles must be unique"),
        ({"declared": {"exact_recall": {"research_role": "other"}}}, "exact_recall is required"),
        ({"declared": {"paraphrase": {"training_eligible": True}}}, "must not be trainable"),
        ({"declared": {"paraphrase": {"schema": "e/2"}}}, "schema differs"),
        ({"dataset": {"schema_version": "d/2"}}, "dataset schema differs"),
        ({"dataset": {"records_checksum": None}}, "no records checksum"),
        ({"package": {"dataset": None}}, "needs one dataset"),
    ],
)
def test_bad_manifests_stop_the_reader(spark, tmp_path, how, why):
    with pytest.raises(ConstraintError, match=why):
        manifests.package_records(spark, Package(tmp_path).write(**how), schemas={"dataset": "d/1", "evaluation_set": "e/1"})


def test_changed_files_stop_the_reader(spark, tmp_path):
    path = Package(tmp_path).write()
    (tmp_path / "dataset.jsonl").write_text(json.dumps(row("9")) + "\n")
    with pytest.raises(ConstraintError, match="records checksum differs"):
        manifests.package_records(spark, path)
    m = json.loads((tmp_path / "paraphrase.json").read_text())
    (tmp_path / "paraphrase.json").write_text(json.dumps({**m, "note": "x"}))
    with pytest.raises(ConstraintError, match="its own checksum differs"):
        manifests.package_records(spark, path)
    (tmp_path / "package.json").write_text(json.dumps({**json.loads((tmp_path / "package.json").read_text()), "note": "x"}))
    with pytest.raises(ConstraintError, match="package checksum differs"):
        manifests.package_records(spark, path)


def test_lineage_and_counts(tmp_path):
    one = manifests.dataset_lineage({"dataset_id": "d", "train_count": 0, "eval_count": 3, "accepted_count": 2, "records_checksum": "sha256:ab"}, "storage://p/d/m.json")
    assert len(one) == 21 and one["split_summary"] == {"train": 0, "evaluation_total": 3} and one["record_counts"] == {"accepted": 2} and one["records_checksum"] == "ab" and one["dataset_manifest_uri"] == "storage://p/d/m.json"
    counted = {"trainable_records": 2, "evaluation_records": 3, "accepted_examples": 0}
    assert manifests.preflight_problems({"train_count": 2, "eval_count": 4, "accepted_count": 0}, counted) == ["eval_count: 4 declared, 3 found", "no trainable example is left"]
    assert manifests.preflight_problems({"eval_count": 4, "accepted_count": 1}, {**counted, "accepted_examples": 2}, packaged=True) == ["accepted_count: 1 declared, 2 accepted"]
    assert lineage.package_lineage({}) is None
    assert lineage.package_lineage({"research_package_manifest_uri": "u", "research_package_id": "p", "evaluation_sets": [{"a": 1}]})["manifest_uri"] == "u"


def test_evidence_walk(spark, tmp_path):
    put = lambda name, value: (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value)) and str(tmp_path / name)
    refs = [put("e.jsonl", "\n".join(map(json.dumps, [{"evidence_id": "1", "text": "t"}, {"id": "2", "content": "u"}, {"text": "no id"}, {"evidence_id": "1", "text": "other"}])))]
    source = put("s.json", {"evidence_refs": refs})
    found, failures = manifests.evidence_of(spark, {"dataset_manifest_uri": put("d.json", {"source_manifest_uri": source})})
    assert found.count() == 4 and failures == [{"uri": source, "category": "conflicting_evidence", "detail": "1"}]
    cases = [({}, "missing_uri"), ({"dataset_manifest_uri": str(tmp_path / "no.json")}, "artifact_unavailable"), ({"dataset_manifest_uri": put("x.json", {})}, "missing_uri"), ({"dataset_manifest_uri": put("y.json", {"source_manifest_uri": put("z.json", {})})}, "evidence_refs_missing")]
    for own, category in cases:
        found, failures = manifests.evidence_of(spark, own)
        assert found is None and [f["category"] for f in failures] == [category]


def test_explicit_nulls_and_white_space(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    rows = [
        row("a", "test\n", research_role=None), row("b", "\x1ftest", metadata={"training_eligible": None}), row("c", "validation", metadata={"research_role": "mine"}, research_role="top"), row("d", "test"), row("e", fact_group_id="f", variant_id="v", evaluation_set_version="2"),
    ]
    p.write_bytes(("\r\n".join(map(json.dumps, rows)) + "\r\n \t\r\n").encode())
    raw = jsonl.records(spark, str(p))
    assert raw.where("error is not null").count() == 0
    got = {r.record_id: r for r in R.with_metadata(raw).collect()}
    assert len(got) == 5 and (got["a"].split, got["a"].research_role, got["a"].training_eligible, got["a"].original_split) == ("evaluation", None, False, "test")
    assert (got["b"].split, got["b"].research_role, got["b"].training_eligible) == ("evaluation", "legacy_test", None)
    assert got["c"].research_role == "mine" and (got["d"].research_role, got["d"].training_eligible) == ("legacy_test", False)
    assert (got["e"].fact_group_id, got["e"].variant_id, got["e"].evaluation_set_version) == ("f", "v", "2")
    assert R.messages_error(F.lit(None)) is not None


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text("".join(f"{name}{k}\n" if k % 5 else "\n" for k in range(1, 3001)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = jsonl.file_lines(spark, str(tmp_path / "a"), str(tmp_path / "b"))
        assert lines.rdd.getNumPartitions() > 2 and spark.read.text([str(tmp_path / "a"), str(tmp_path / "b")]).rdd.getNumPartitions() > 8
        got = sorted((r.line[0], r.line_number, r.line) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == sorted((n, k, f"{n}{k}") for n in "ab" for k in range(1, 3001) if k % 5)


def test_encoded_examples(spark):
    ddl = "m string, messages array<struct<role: string, content: string>>"
    df = spark.createDataFrame([("a", [("user", "ab"), ("assistant", "cd")]), ("b", [("assistant", "x"), ("user", "y")]), ("c", [("user", "rewrite"), ("assistant", "z")])], ddl)

    def prefixes(messages):
        texts = ["".join(m["content"] for m in messages[: k + 1]) for k in range(len(messages))]
        return [[ord(c) for c in (t[::-1] if t.startswith("rewrite") else t)] for t in texts]

    got = {r.m: r for r in R.encoded_examples(df, prefixes, 6).collect()}
    assert got["a"].labels == [-100, -100, ord("c"), ord("d")] and got["a"].error is None
    assert got["b"].error == "no target tokens" and got["c"].error == "prefix rewritten"
    masked = {r.m: r for r in R.encoded_examples(df, lambda ms: ([1, 2, 3], [0, 1, 1]), 2).collect()}
    assert masked["a"].labels == [-100, 2, 3] and masked["a"].error == "too long"


def test_texts(spark):
    one = lambda c, **cols: spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(c).first()[0]
    words = ["Straße", "ΣΊΣΥΦΟΣ", "ﬁne", "İx", "ŉ", "plain\u2003Text\x1c", "ᾳ", "Ꭰ"]
    rows = spark.createDataFrame([(w,) for w in words], "t string").select(text.normalize_answer(F.col("t"))).collect()
    import re

    assert [r[0] for r in rows] == [re.sub(r"\s+", " ", w).strip().casefold() for w in words]
    assert one(text.label(F.col("a")), a="_gpu Power W") == "Gpu power w"
    shown = spark.createDataFrame([(None, 3, 2.5)], "a double, b int, c double").select(text.format_metric(F.col("a")), text.format_metric(F.col("b")), text.format_metric(F.col("c")), text.format_metric(F.col("c"), 1, " W")).first()
    assert tuple(shown) == ("unavailable", "3", "2.5000", "2.5 W")
    secret = lambda k, v: one(text.redacted(F.col("k"), F.col("v").cast("string")), k=k, v=v)
    assert secret("API_Key", "x") == "<redacted>" and secret("api_key", None) is None and secret("signature", "x") == "x"
    assert secret("uri", "https://u:p@h/x?a=1&my_token=2#f") == "https://h/x?a=1&my_token=%3Credacted%3E#f" and secret("u", "s://h/x?key=1&signature=2") == "s://h/x?key=1&signature=2"
    ask = lambda a, f: one(canon.format_valid(F.col("a"), F.col("f").cast("string")), a=a, f=f)
    assert [ask("x", None), ask("x", ""), ask("[1]", "application/json"), ask("[1]", "json_object"), ask("\n", "text")] == [None, None, True, False, False]
