"""Keyed merges and judgments under kills, repeats and replays."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryException

from marlstone.operators import publication
from marlstone.plans.recovery import _verdict
from marlstone.sources import sinks
from marlstone.sources.keyed import KeyedTable
from marlstone.streaming import judgments as jd

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("n", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def all_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_put_get_conflicts(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), buckets=4)
    assert all_rows(t.rows()) == [] and all_rows(t.get(frame(spark, [("a", None, None)]))) == [("a", None, None)]
    assert t.put(frame(spark, [])).count() == 0
    first = [("a", "x", 1), ("a", "x", 1), ("b", None, 2), (None, "null key", 3), ("c", "later", 9), ("c", "earlier", 4)]
    got = t.put(frame(spark, first), ["n"]).collect()
    assert [(r.k, r.brought) for r in got] == [("c", 1)]
    stored = sorted([("a", "x", 1), ("b", None, 2), (None, "null key", 3), ("c", "earlier", 4)], key=str)
    assert all_rows(t.rows()) == stored
    again = t.put(frame(spark, [("a", "x", 1), ("a", "y", 1), ("a", "y", 1), (None, "other", 3)]), ["n"]).collect()
    assert sorted((str(r.k), r.brought) for r in again) == [("None", 1), ("a", 2)]
    assert all_rows(t.rows()) == stored
    assert all_rows(t.get(frame(spark, [(None, None, None), ("z", None, None), ("b", None, None), ("b", None, None)]))) == sorted([(None, "null key", 3), ("z", None, None), ("b", None, 2)], key=str)
    with pytest.raises(Exception, match="aren't stored"):
        t.get(frame(spark, [("z", None, None)]), required=True)
    with pytest.raises(sinks.WriteConflict):
        KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), buckets=8)


def test_put_equals_a_dictionary(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), buckets=5)
    kept = {}
    for step in range(3):
        rows = [(f"k{(j * 7 + step * 13) % 40}", f"v{(j + step) % 3}", j % 2) for j in range(60)]
        t.put(frame(spark, rows), ["n", "v"], replace=step == 2)
        new = {}
        for k, v, n in sorted(rows, key=lambda r: (r[2], r[1])):
            new.setdefault(k, (k, v, n))
        kept = {**kept, **new} if step == 2 else {**new, **kept}
        assert all_rows(t.rows()) == sorted(kept.values(), key=str)


def test_only_changed_partitions_are_written(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), buckets=16)
    t.put(frame(spark, [(f"k{j}", "v", j) for j in range(200)]))
    files = lambda: {(p.parent.name, p.name) for p in (tmp_path / "t").rglob("part-*.parquet")}
    before = files()
    t.put(frame(spark, [("k3", "v", 3)]))
    assert files() == before
    t.put(frame(spark, [("new", "v", 3)]))
    assert len({folder for folder, _ in before - files()}) == 1 and t.rows().count() == 201


@pytest.mark.parametrize("whole", [False, True])
def test_killed_merge(spark, tmp_path, whole, monkeypatch):
    """Killed before the staged state is whole nothing has changed; killed while it is put in place it is finished."""
    t = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), buckets=2)
    t.put(frame(spark, [("a", "x", 1), ("b", "x", 2)]))
    original = KeyedTable._recover

    def killed(self):
        staged = tmp_path / "t.merge"
        if staged.exists():
            if whole:  # a partition is gone already
                import shutil

                shutil.rmtree(next((tmp_path / "t").glob("key_bucket=*")))
            else:
                (staged / "_SUCCESS").unlink()
            raise KeyboardInterrupt
        original(self)

    monkeypatch.setattr(KeyedTable, "_recover", killed)
    rows = frame(spark, [(c, "x", 3) for c in "cdefgh"])
    with pytest.raises(KeyboardInterrupt):
        t.put(rows)
    monkeypatch.undo()
    spark.catalog.clearCache()
    assert t.rows().count() == (8 if whole else 2)
    assert t.put(rows).count() == 0 and t.rows().count() == 8


def pairs_of(spark, n):
    return spark.range(n).select(F.lit("c").alias("candidate_id"), F.col("id").cast("string").alias("record_id"), F.col("id").cast("string").alias("messages"))


def good(asked):
    return asked.select("request_id", F.lit(_verdict("tie")).alias("response"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("detail"))


def check_once(spark, root, n):
    o, r = jd.outcomes(spark, root), jd.requests(spark, root)
    assert o.groupBy("request_id").count().where("count > 1").count() == 0
    assert {x[0] for x in o.select("request_id").collect()} == {x[0] for x in r.select("request_id").collect()}
    assert o.where("response is not null").count() == n == jd.settled(spark, root).where("response is not null").count()


@pytest.mark.parametrize("kill", ["before requests", "after requests", "while answering", "after outcomes"])
def test_killed_stream(spark, tmp_path, kill, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "rows")
    pairs_of(spark, 20).union(pairs_of(spark, 5)).repartition(2).write.parquet(source)
    stream = lambda: spark.readStream.schema("candidate_id string, record_id string, messages string").option("maxFilesPerTrigger", 1).parquet(source)
    run = lambda judge, q="q": jd.judge_stream(stream(), judge, root, str(tmp_path / f"check-{q}"), q, "run", 3).awaitTermination()
    move, count = sinks.move, [0]

    def stop(spark_, a, b):
        kind = "requests" if "/requests/" in b else "outcomes"
        if kill == f"after {kind}":
            move(spark_, a, b)
        count[0] += 1
        if kill in (f"after {kind}", f"before {kind}") and count[0] > 2:  # the second batch, that is
            raise RuntimeError("killed")
        if kill != f"after {kind}":
            move(spark_, a, b)

    monkeypatch.setattr(sinks, "move", stop)
    failing = lambda asked: good(asked).withColumn("response", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(StreamingQueryException):
        run(failing if kill == "while answering" else good)
    monkeypatch.undo()
    run(good)
    check_once(spark, root, 20)
    n = jd.outcomes(spark, root).count()
    run(good, "replay")
    assert jd.outcomes(spark, root).count() == n
    interrupted = jd.outcomes(spark, root).where("reason = 'interrupted_judge_attempt'").count()
    assert (interrupted > 0) == (kill in ("after requests", "while answering"))


def test_retries_and_cases(spark, tmp_path):
    root = str(tmp_path)
    rows = [("c", "ok", "ok"), ("c", "ok", "zz"), ("c", "bad", "bad"), ("c", "over", "over"), ("c", "silent", "silent"), ("c", "null", None), (None, "k", "x"), (None, "k", "y")]
    batch = spark.createDataFrame(rows, "candidate_id string, record_id string, messages string")

    def judge(asked):
        m = F.col("messages")
        said = asked.where("messages <> 'silent'").select("request_id", F.when(m == "bad", "[]").when(m != "over", F.lit(_verdict("tie"))).alias("response"), F.when(m == "over", "token_budget_exceeded").alias("reason"), F.lit("d").alias("detail"))
        return said.union(said)

    for _ in range(2):
        jd.judge_batch(batch, judge, root, "q", 0, "run", 2)
        got = sorted((r.record_id, r.attempt, r.reason) for r in jd.outcomes(spark, root).collect())
        again = [(k, a, why) for k, why in (("bad", "malformed_judge_response"), ("silent", "no_judge_response")) for a in range(3)]
        assert got == sorted([("ok", 0, None), ("null", 0, None), ("over", 0, "token_budget_exceeded"), ("k", 0, "missing_key"), *again], key=lambda r: (r[0], r[1]))
    assert {r.record_id: (r.attempts, r.reason) for r in jd.settled(spark, root).collect()} == {"ok": (1, None), "null": (1, None), "over": (1, "token_budget_exceeded"), "bad": (3, "malformed_judge_response"), "silent": (3, "no_judge_response")}
    jd.judge_batch(batch.limit(0), judge, root, "q", 1, "run", 2)
    assert jd.requests(spark, root).where("batch = 1").count() == 0


def test_attempts_that_differ(spark, tmp_path):
    rows = [("r2", "c", "b"), ("r1", "c", "z"), ("r1", "c", "a"), ("r1", "c", "a"), (None, "c", None), (None, "c", None)]
    df = spark.createDataFrame(rows, "request_id string, candidate_id string, response string")
    assert [tuple(r) for r in publication.attempt_rows(df).collect()] == [(None, "c", None), ("r1", "c", "a"), ("r2", "c", "b")]
    assert [tuple(r) for r in publication.conflicting_attempts(df).collect()] == [("r1", 2, 3)]
    where = str(tmp_path / "attempts")
    for part in (df.where("request_id = 'r1'"), df.where("request_id is not null")):
        sinks.append_attempts(part, where)
    assert sorted((r.request_id, r.response) for r in spark.read.parquet(where).collect()) == [("r1", "a"), ("r2", "b")]
