"""Operators against brute force: decontamination, substrings, SimHash, quality counts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from fixtures import documents, prose
from marlstone.llm import decontaminate, quality_rules, simhash, substrings
from pyspark.sql import functions as F

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(rows, items, window=13):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in items:
        w = pat.findall(lowered(t))
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            wins[tuple(w[k : k + m])].add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, ids = pat.findall(lowered(t)), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in wins:
                    hit |= set(range(k, k + m))
                    ids |= wins[tuple(w[k : k + m])]
        out.append((str(d), len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def test_decontamination(spark, docs, no_docs):
    rows = [(r[0], r[1]) for r in documents()]
    items = [(1, prose(60, 7)), (2, "Word"), (None, prose(80, 1)[40:300]), (4, None), (5, " -- "), (6, "ÄÖ Ü"), (2, "text"), (7, prose(3000, 99)[5000:5200])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    for block in (32 << 20, 400):
        out = decontaminate.benchmark_hits(docs.withColumn("n_words", F.lit("clash")), bench, block_bytes=block)
        got = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in out.collect())
        assert got == contamination(rows, items)
    kept = decontaminate.without_contaminated(docs.withColumn("n_hit", F.lit(0)), bench)
    assert kept.columns == [*docs.columns, "n_hit"] and kept.count() == sum(not r[4] for r in contamination(rows, items))
    assert decontaminate.benchmark_hits(no_docs, bench).count() == 0
    assert decontaminate.benchmark_hits(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_wu_manber_shifts():
    tables, ids = decontaminate.build_tables([("x", "a b c d e f g h i j k l m n"), ("y", "A, b c d e f g h i j k l m n"), ("z", None)], 13)
    (table,) = tables
    blocks = decontaminate._runs(decontaminate.Words(pa.array(["l m n a b c z z z"])).hashes, 3)
    shift = lambda h: dict(zip(table.keys.tolist(), table.shifts.tolist())).get(int(h), table.most)
    assert (table.most, shift(blocks[0]), shift(blocks[3]), shift(blocks[6])) == (11, 0, 10, 11)
    assert table.pattern(0) in (b"a b c d e f g h i j k l m", b"b c d e f g h i j k l m n") and len(ids) == 3


def test_table_size_is_bounded():
    rng = np.random.default_rng(0)
    words = np.array([f"w{k:x}" for k in range(50_000)])
    items = [(str(k), " ".join(rng.choice(words, 400))) for k in range(1500)]
    size = sum(len(t) for _, t in items)
    tables, _ = decontaminate.build_tables(items, 13)
    held = sum(x.nbytes if isinstance(x, np.ndarray) else len(x) for t in tables for x in vars(t).values() if isinstance(x, (np.ndarray, bytes)))
    assert held < decontaminate.TABLE_FACTOR * size


def test_hits_in_many_stretches(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([" ", ", ", "-- "]).join(rng.choice("ab") for _ in range(rng.randrange(3000)))) for k in range(12)]
    items = [(k, " ".join(rng.choice("ab") for _ in range(n))) for k, n in enumerate((1, 2, 3, 4, 7, 12, 13, 30))]
    out = decontaminate.benchmark_hits(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items[4:], "item_id int, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in out.collect()) == contamination(rows, items[4:])


def removals(rows, window):
    order = sorted({(d is not None, d or 0, t or "") for d, t in rows}, key=lambda r: (r[0], r[1], r[2]))
    by_hash = lambda r: (r[0], r[1], xxhash.xxh64_intdigest((r[2]).encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest((r[2]).encode(), 42) >> 63))
    seen, out = {}, {}
    for r in sorted(order, key=by_hash):
        w, gone = SPLIT.findall(r[2]), set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone |= set(range(k, k + window))
            else:
                seen[key] = True
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[r] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((str(d), *out[(d is not None, d or 0, t or "")]) for d, t in rows)


def test_substrings(docs, no_docs, monkeypatch):
    rows = [(r[0], r[1]) for r in documents()]
    for window, anchor, hot in ((20, 8, 256), (5, 2, 256), (5, 2, 2), (20, 8, 1)):
        monkeypatch.setattr(substrings, "HOT", hot)
        got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(docs, window, anchor).collect())
        assert got == removals(rows, window)
    one = {r.doc_id: r for r in substrings.without_repeats(docs.where("doc_id in (1, 5, 7, 6)")).collect()}
    assert one[5].n_removed == 80 and [(s.a, s.b) for s in one[7].intervals] == [(0, 60)] and one[7].kept_text == "" and one[1].n_removed == 0
    assert substrings.without_repeats(no_docs).count() == 0


def test_simhash(spark, docs, no_docs):
    rows = [(r[0], r[1]) for r in documents()]

    def fp(t):
        w = SPLIT.findall(lowered(t))
        sh = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    prints = [(d, fp(t)) for d, t in rows]
    group = list(range(len(prints)))
    for _ in prints:
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    first = {}
    for (d, _), g in zip(prints, group):
        if d is not None:
            first[g] = min(d, first.get(g, d))
    want = sorted((str(d), f"{f:016x}", first.get(g)) for (d, f), g in zip(prints, group))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.without_near_duplicates(no_docs).count() == 0


def test_links_in_hot_buckets(spark):
    rng = np.random.default_rng(3)
    base = np.uint64(rng.integers(0, 2**63))
    near = np.unique(np.concatenate([[base], [base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for a, b, c in rng.integers(0, 20, (400, 3))], rng.integers(0, 2**63, 300, dtype=np.uint64)]))
    from marlstone.llm.components import components

    df = spark.createDataFrame([(int(x),) for x in near.view(np.int64)], "fp long")
    label = np.arange(len(near))
    for i in range(len(near)):
        for j in np.flatnonzero(np.bitwise_count(near ^ near[i]) <= 2):
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
    want = Counter(Counter(label.tolist()).values())
    for hot in (1024, 16):
        found = components(simhash.link_edges(df, 2, hot))
        sizes = Counter(r[1] for r in found.groupBy("root").count().collect())
        assert sizes == Counter({k: v for k, v in want.items() if k > 1})
    joined = np.arange(len(near))
    simhash._flip_links(joined, near, 0, len(near), 2)
    assert Counter(Counter(joined.tolist()).values()) == want


def test_quality_counts(docs, no_docs):
    def brute(t):
        w = SPLIT.findall(t or "")
        c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        cover = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if SPLIT.search(line):
                dup += line in seen
                seen.add(line)
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover)

    out = quality_rules.judged(docs.withColumn("quality", F.lit("clash")))
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == sorted((str(r[0]), *brute(r[1])) for r in documents())
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in out.collect())
    assert quality_rules.judged(no_docs).count() == 0


def test_quality_em():
    rng = np.random.default_rng(1)
    votes = Counter()
    for _ in range(4000):
        good = rng.random() < 0.8
        right = [0.95, 0.9, 0.85, 0.9, 0.6]
        votes[tuple(int(0 if rng.random() < 0.1 else (1 if (rng.random() < p) == good else -1)) for p in right)] += 1
    prior, rates = quality_rules.fit_votes(votes)
    assert abs(prior - 0.8) < 0.06
    assert rates[1, 0, 2] > rates[1, 4, 2] + 0.1  # the accurate rule is trusted more
    assert quality_rules.fit_votes({})[0] == 0.5


def test_text_pieces():
    from marlstone.llm.textmap import pieces

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c"]})
    assert [p.num_rows for p in pieces(batch, "text", 20)] == [2, 1, 1]
