"""Streamed digests of files and datasets, the committing writer, and a reader that goes by whole paths."""

import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F
from test_reading import literal_checksum, row

from marlstone import lineage
from marlstone.checks import ConstraintError
from marlstone.functions import text
from marlstone.sources import digests, manifests, publications, sinks

BODIES = {
    "ends": b"a\nb\n",
    "open": b"a\nb",
    "feeds": b"\n\n\n",
    "returns": b"a\r\nb\r\n\x0b\x1f\x00\"\\/",
    "wide": "é 日\U0001f600\n\x85\n".encode(),
    "one": b"x",
    "long": b"y" * 300_000 + b"\n" + b"z" * 200_000,
}


def test_digests_equal_whole_files(spark, tmp_path):
    for name, body in BODIES.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "bytes").write_bytes(b"\xff\xfe\n\x80")
    (tmp_path / "mark").write_bytes(b"\xef\xbb\xbfa\n")
    got = {r.source_uri.rsplit("/", 1)[-1]: r for r in digests.digests(spark, *[str(p) for p in sorted(tmp_path.iterdir())]).collect()}
    assert set(got) == {*BODIES, "bytes", "mark"}
    for name, body in BODIES.items():
        r = got[name]
        assert (r.sha256, r.literal_sha256, r.size_bytes) == (hashlib.sha256(body).hexdigest(), literal_checksum(body.decode()), len(body)), name
        assert r.line_count == len(body.removesuffix(b"\n").split(b"\n"))
    assert got["bytes"].sha256 == hashlib.sha256(b"\xff\xfe\n\x80").hexdigest() and got["bytes"].literal_sha256 is None
    assert got["mark"].sha256 is None and got["mark"].literal_sha256 is None
    assert digests.EMPTY["literal_sha256"] == literal_checksum("")


def test_digests_of_files_in_many_splits(spark, tmp_path):
    bodies = {n: "".join(f"{n} line {k}\n" if k % 7 else "\n" for k in range(20_000)) for n in "ab"}
    for n, body in bodies.items():
        (tmp_path / n).write_text(body)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = {r.source_uri[-1]: r.literal_sha256 for r in digests.digests(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
        whole = digests.digests(spark, str(tmp_path), by_folder=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {n: literal_checksum(body) for n, body in bodies.items()}
    assert [r.sha256 for r in whole] == [hashlib.sha256((bodies["a"] + bodies["b"]).encode()).hexdigest()]


def test_package_whose_files_share_a_name(spark, tmp_path):
    """Dataset and evaluation set each have their records.jsonl in a folder of their own."""

    def put(folder, name, value):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(value if isinstance(value, str) else json.dumps(value))
        return str(tmp_path / folder / name)

    bodies = {"data": json.dumps(row("1")) + "\n", "recall": json.dumps(row("2", "evaluation", research_role="exact_recall", training_eligible=False)) + "\n"}
    uris = {k: put(k, "records.jsonl", b) for k, b in bodies.items()}
    m = {"evaluation_set_id": "s", "evaluation_set_version": "1", "research_role": "exact_recall", "training_eligible": False, "records_uri": uris["recall"], "records_checksum": literal_checksum(bodies["recall"]), "record_count": 1, "freeze_checksum": "f"}
    m["manifest_checksum"] = lineage.manifest_checksum(m)
    sums = literal_checksum(bodies["data"])
    package = {"dataset": {"manifest_uri": put("data", "manifest.json", {"records_uri": uris["data"], "records_checksum": f"sha256:{sums}"}), "records_checksum": f"sha256:{sums}"}, "evaluation_sets": [{"manifest_uri": put("recall", "manifest.json", m), **{k: m.get(k) for k in manifests.REFERENCE_FIELDS}}]}
    package["manifest_checksum"] = lineage.manifest_checksum(package)
    path = put("package", "manifest.json", package)
    assert [r.record_id for r in manifests.package_records(spark, path).orderBy("source_ordinal").collect()] == ["1", "2"]
    put("recall", "records.jsonl", bodies["data"])  # the right content of the other file
    with pytest.raises(ConstraintError, match="records checksum differs.*recall/records.jsonl"):
        manifests.package_records(spark, path)


def test_empty_file_has_the_empty_text_s_checksum(spark, tmp_path):
    (tmp_path / "e").write_text("")
    assert digests.differing(spark, {str(tmp_path / "e"): literal_checksum("")}).count() == 0
    assert digests.differing(spark, {str(tmp_path / "e"): literal_checksum("x")}).count() == 1


def test_dataset_is_committed_whole(spark, tmp_path):
    rows = spark.createDataFrame([(k, json.dumps({"k": k, "t": "é" * (k % 5)}, ensure_ascii=False)) for k in range(500)], "k int, line string").repartition(4)
    where = str(tmp_path / "set")
    body = "".join(r.line + "\n" for r in rows.orderBy("k").collect()).encode()
    assert sinks.put_jsonl(rows, where, ["k"]) == hashlib.sha256(body).hexdigest()
    manifest = sinks.verified_dataset(spark, where)
    assert b"".join((tmp_path / "set" / p).read_bytes() for p in manifest["parts"]) == body and manifest["line_count"] == 500
    assert sinks.put_jsonl(rows.repartition(1), where, ["k"]) == manifest["sha256"]
    swapped = rows.withColumn("line", F.when(F.col("k") < 2, F.concat(F.lit(" "), "line")).otherwise(F.col("line"))).withColumn("k", F.when(F.col("k") < 2, 1 - F.col("k")).otherwise(F.col("k")))
    for other in (swapped, rows.where("k > 0"), rows.withColumn("k", -F.col("k"))):  # the last has the same lines in another order
        with pytest.raises(sinks.WriteConflict):
            sinks.put_jsonl(other, where, ["k"])
    assert sinks.verified_dataset(spark, where) == manifest and [p.name for p in tmp_path.iterdir()] == ["set"]
    replaced = sinks.put_jsonl(rows.where("k > 0"), where, ["k"], replace=True)
    assert replaced == sinks.verified_dataset(spark, where)["sha256"] != manifest["sha256"] and [p.name for p in tmp_path.iterdir()] == ["set"]
    empty = str(tmp_path / "none")
    assert sinks.put_jsonl(rows.limit(0), empty, ["k"]) == hashlib.sha256(b"").hexdigest() == sinks.verified_dataset(spark, empty)["sha256"]


def test_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(k, "x") for k in range(9)], "k int, line string")
    broken = rows.withColumn("line", F.when(F.col("k") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("line")))
    with pytest.raises(Exception):
        sinks.put_jsonl(broken, str(tmp_path / "set"), ["k"])
    assert list(tmp_path.iterdir()) == [] and sinks.dataset_manifest(spark, str(tmp_path / "set")) is None


def test_changed_part_is_found(spark, tmp_path):
    where = str(tmp_path / "set")
    sinks.put_jsonl(spark.createDataFrame([(1, "a"), (2, "b")], "k int, line string"), where, ["k"])
    part = tmp_path / "set" / sinks.dataset_manifest(spark, where)["parts"][0]
    for crc in (tmp_path / "set").glob(".*.crc"):
        crc.unlink()
    part.write_bytes(part.read_bytes() + b"c\n")
    with pytest.raises(sinks.WriteConflict, match="differs"):
        sinks.verified_dataset(spark, where)


def test_text_is_replaced_by_one_rename(spark, tmp_path):
    where = str(tmp_path / "f.txt")
    sinks.write_text(spark, where, "one")
    sinks.write_text(spark, where, "two")
    assert (tmp_path / "f.txt").read_text() == "two" and not list(tmp_path.glob("*.tmp"))


def test_artifacts_of_one_name_have_their_own_checksums(spark, tmp_path):
    for n in "ab":
        (tmp_path / n).mkdir()
        (tmp_path / n / "config.json").write_text(n)
    sums = publications.finalize_evaluation(spark, str(tmp_path / "ev"), {n: str(tmp_path / n / "config.json") for n in "ab"}, {})
    assert sums == {n: hashlib.sha256(n.encode()).hexdigest() for n in "ab"}


def test_stripped_is_linear(spark):
    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    inner = "a" + spaces + "b"
    rows = [(spaces + inner + spaces,), (inner,), (spaces,), ("",), (None,), ("​a​",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.stripped(F.col("t"))).collect()]
    assert got == [None if r[0] is None else r[0].strip() for r in rows]
    long = spark.range(1).select(F.concat(F.lit("x"), F.repeat(F.lit(" \t"), 500_000), F.lit("y")).alias("t"))
    began = time.time()
    r = long.select(*[F.length(f(F.col("t"))).alias(f.__name__) for f in (text.stripped, text.normalize_answer, text.normalize_training_answer, text.label)], text.is_blank(F.col("t")).alias("blank"), text.token_estimate(F.col("t")).alias("tokens")).first()
    assert (r.stripped, r.normalize_answer, r.normalize_training_answer, r.label, r.blank, r.tokens) == (1_000_002, 3, 3, 1_000_002, False, 2)
    assert time.time() - began < 30
