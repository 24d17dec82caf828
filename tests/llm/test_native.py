"""PII, sharding and the pipeline."""

import zlib
from collections import defaultdict

import corpus_pipeline
from fixtures import SCHEMA, documents, prose
from marlstone.llm import pii, sharding
from marlstone.llm.store import stored
from pyspark.sql import functions as F

VALUES = [
    "a card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112",
    "born 1999-12-31 or 31.12.1999 or 12/25/2020, not 2020-13-01",
    "ssn 123-45-6789 ip 10.0.0.1 bad 300.1.1.1 call +1 (017) 555-7713 now",
    "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432.",
    'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" 0F3EF4D6B2755A36D7D9C25BD72C4D5F',
    None,
    "",
    "version 4.0.1 of 7536784127813051 and line 3",
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def test_pii_round_trip(spark, docs, no_docs):
    df = spark.createDataFrame(list(enumerate(VALUES)), "doc_id int, text string").withColumn("pii_kinds", F.lit("clash"))
    out = stored(pii.pseudonymised(df, key="k"), "t")
    rows = {r.doc_id: r for r in out.collect()}
    assert [rows[i].pii_kinds for i in range(4)] == [["card", "card"], ["date"] * 3, ["ssn", "ipv4", "phone"], ["iban", "iban"]]
    assert {r.doc_id: r.text for r in pii.pseudonymised(out.drop("pii_kinds"), key="k", back=True).collect()} == dict(enumerate(VALUES))
    words = rows[0].text.split()
    assert "".join(words[2:6]) == words[7].rstrip(",") != "4111111111111111" and luhn(words[7].rstrip(",")) and words[7][0] == "4" and words[9] == "4111111111111112"
    assert "300.1.1.1" in rows[2].text and "2020-13-01" in rows[1].text and "10.0.0.1" not in rows[2].text
    dates = rows[1].text.replace(",", "").split()
    assert dates[1] == "-".join(reversed(dates[3].split("."))) and rows[7].text == VALUES[7] and rows[5].text is None and rows[6].text == ""
    other = {r.doc_id: r.text for r in pii.pseudonymised(df, key="other").collect()}
    assert other[0] != rows[0].text and pii.pseudonymised(no_docs, key="k").count() == 0
    same = {r.n_chars: r.text for r in pii.pseudonymised(docs).collect()}
    assert same == {r[4]: r[1] for r in documents()}


def test_emails_link(spark):
    df = spark.createDataFrame([(1, "über.34@mail7.example.com!!"), (2, "x ÜBER.34@mail7.example.com, a@b")], "doc_id int, text string")
    a, b = [r.text for r in pii.pseudonymised(df).orderBy("doc_id").collect()]
    assert a.rstrip("!") == b.split()[1].rstrip(",") and a.endswith("@pseudonym.invalid!!") and b.endswith("a@b")


def test_feistel_is_a_permutation(spark):
    df = spark.range(100 * 7).select((F.col("id") % 100).alias("a"), F.floor(F.col("id") / 100).alias("b"))
    out = df.select(pii.permuted(F.col("a"), F.col("b"), F.lit(100), F.lit(7), F.lit("t"), "k").alias("p")).select("p.*")
    assert out.distinct().count() == 700 and out.where("l between 0 and 99 and r between 0 and 6").count() == 700


def check_shards(rows, texts):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None for r in rows)
    assert sorted((r["size"], r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)


def test_sharding(spark, docs, no_docs):
    check_shards(sharding.kd_shards(docs).collect(), [r[1] for r in documents()])
    assert sharding.kd_shards(no_docs).count() == 0
    texts = [prose(20 + k % 30, k) for k in range(3000)] + ["copy " * 40] * 1500 + [prose(25, k % 50) for k in range(100)]
    many = spark.createDataFrame([(k, t, None if k % 9 == 0 else "en", f"s{k % 4}") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(5)
    rows = sharding.kd_shards(many).collect()
    check_shards(rows, texts)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and max(abs(s - mean) for s in sizes.values()) < 0.1 * mean
    groups = defaultdict(set)
    for r in rows:
        groups[r.text_crc32].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) == 1  # only the hot group is dealt out


def test_pipeline(spark, tmp_path):
    passage = prose(40, 77)
    planted = [
        (100, prose(90, 11), "en", "s", 0), (101, prose(90, 11), "en", "s", 0), (102, prose(30, 12) + " " + passage, "en", "s", 0), (103, prose(60, 13) + " 4111111111111111", "en", "s", 0),
        (104, prose(60, 14) + " blockhead", "en", "s", 0),
    ]
    training = [(1000 + k, prose(60, 500 + k) + (" blockhead" if k % 4 == 0 else ""), "en", "s", 0) for k in range(200)]
    d = str(tmp_path)
    spark.createDataFrame(planted + training + documents(), SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[1].endswith("blockhead"))) for r in training], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = [{r.doc_id for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, d), name)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 104 in seen[0] - seen[1] and {100, 101, 102, 103} <= seen[1]
    assert 101 in seen[1] - seen[2] and {100, 102, 103} <= seen[2]
    assert 102 in seen[2] - seen[3] and {100, 103} <= seen[3]
    rows = {r.doc_id: r for r in docs.collect()}
    assert "4111111111111111" not in rows[103].text and rows[103].n_chars == len(rows[103].text) and rows[103].round_trip
    assert corpus_pipeline.run(spark, d).count() == docs.count()
