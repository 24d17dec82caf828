"""SimHash near-duplicates: pivot distance tables over fingerprints.

A fingerprint has 64 bits; two documents are linked if theirs differ in ``distance`` bits or
fewer, and a group is everything reachable over links.

Links are sought between *distinct* fingerprints only. Cut into ``distance + 2`` blocks, two
linked fingerprints agree in two blocks at least, so each goes into one bucket for each pair
of blocks. Inside a bucket the Hamming distances of every fingerprint to fixed reference
fingerprints (the pivots) are tabulated; by the triangle inequality two linked fingerprints
differ by ``distance`` at most in every coordinate, so the bucket is swept in the order of
the first coordinate, pairs are discarded by their largest coordinate difference, and the
survivors are verified bit by bit. Of the links in a bucket only a spanning forest leaves it.

Scale: copies collapse into one fingerprint before any join. A bucket of more than
``hot_bucket`` fingerprints is divided once more by thirds of its other bits (which can
differ in no more than ``distance`` bits, so one third agrees); such a part has 2**22 members
at most, and is searched by flipping its free bits where it is large. Components are
distributed (see components.py).

Defined cases: a null or empty text has fingerprint zero, linked like any other; null ids are
ignored in component_id (null if a group has no other); repeated documents each get a row; a
very long text is read whole, in steps; an empty table gives no rows; near_duplicates returns its
own columns only, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.components import components
from marlstone.llm.store import checkpointed, stored
from marlstone.llm.textmap import append_columns

SHINGLE, SEED = 3, 42
PIVOTS = 16
_STEP = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    words = text.encode().lower().split()  # of bytes: only A-Z, and the six separators
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + _STEP], stops[at : at + _STEP])], "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint as a signed long."""

    def make():
        def run(texts: pa.Array) -> list:
            return [np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64)]

        return run

    return append_columns(docs, "text", [T.StructField("fp", T.LongType())], make)


def _blocks(count: int, low: int, high: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``count`` nearly equal blocks of the bits low to high."""
    cuts = [low + (high - low) * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(20240607).integers(0, 2**64, count, dtype=np.uint64)


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label != label[label]).any():
            label[:] = label[label]


def bucket_forest(bucket: np.ndarray, fps: np.ndarray, distance: int, refs: np.ndarray, sweep_most: int = 4096) -> np.ndarray:
    """Labels that join linked fingerprints of one bucket; rows come sorted by bucket."""
    label = np.arange(len(fps))
    runs = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(runs, len(fps)))
    for at, n in zip(runs[sizes > sweep_most], sizes[sizes > sweep_most]):
        _flip_links(label, fps, at, n, distance)
    size_of = np.repeat(sizes, sizes)
    rows = np.flatnonzero((size_of > 1) & (size_of <= sweep_most))
    if not len(rows):
        return label
    table = np.bitwise_count(fps[rows, None] ^ refs[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], bucket[rows]))
    rows, table = rows[order], table[order]
    own, first, values = bucket[rows], table[:, 0], fps[rows]
    i, t = np.arange(len(rows)), 1
    while len(i):
        i = i[i + t < len(rows)]
        i = i[(own[i + t] == own[i]) & (first[i + t] - first[i] <= distance)]
        near = i[np.abs(table[i + t] - table[i]).max(axis=1) <= distance] if len(i) else i
        near = near[np.bitwise_count(values[near + t] ^ values[near]) <= distance]
        _unite(label, rows[near], rows[near + t])
        t += 1
    return label


def _flip_links(label: np.ndarray, fps: np.ndarray, at: int, n: int, distance: int) -> None:
    """Links of one large bucket by flipping the bits in which its members differ."""
    order = np.argsort(fps[at : at + n])
    values = fps[at : at + n][order]
    free = [b for b in range(64) if ((values >> np.uint64(b)) & np.uint64(1)).any() and not ((values >> np.uint64(b)) & np.uint64(1)).all()]
    for k in range(1, distance + 1):
        for flips in combinations(free, k):
            other = values ^ np.uint64(sum(1 << b for b in flips))
            to = np.minimum(np.searchsorted(values, other), n - 1)
            hit = values[to] == other
            _unite(label, at + order[np.flatnonzero(hit)], at + order[to[hit]])


def link_edges(fps: DataFrame, distance: int = 2, hot_bucket: int = 1024) -> DataFrame:
    """A spanning forest (u, v) of the links between the distinct ``fp`` of ``fps``."""
    fp = F.col("fp")
    blocks = _blocks(distance + 2, 0, 64)
    pairs = list(combinations(range(len(blocks)), 2))
    keys = F.array(*[F.xxhash64(F.lit(k), _bits(fp, *blocks[a]), _bits(fp, *blocks[b])) for k, (a, b) in enumerate(pairs)])
    rows = fps.select("fp", F.posexplode(keys).alias("pair", "bucket"))
    hot = rows.groupBy("bucket").count().where(F.col("count") > hot_bucket).select("bucket", F.lit(True).alias("hot"))
    rows = rows.join(hot, "bucket", "left")
    # The bits outside the two blocks, in distance + 1 parts: one part agrees in linked fingerprints.
    parts = []
    for a, b in pairs:
        rest = [bit for k, (first, width) in enumerate(blocks) if k not in (a, b) for bit in range(first, first + width)]
        cut = [rest[len(rest) * k // (distance + 1) : len(rest) * (k + 1) // (distance + 1)] for k in range(distance + 1)]
        masks = [sum(1 << bit for bit in part) for part in cut]
        masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
        parts.append(F.array(*[F.xxhash64("bucket", F.lit(k), fp.bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(masks)]))
    finer = F.coalesce(*[F.when(F.col("pair") == k, p) for k, p in enumerate(parts)])
    rows = rows.select("fp", F.explode(F.when(F.col("hot"), finer).otherwise(F.array("bucket"))).alias("bucket"))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "fp")
    refs = pivots()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_f = [], []

        def flush(b: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            label = bucket_forest(b, f.view(np.uint64), distance, refs)
            joined = np.flatnonzero(label != np.arange(len(f)))
            return pa.RecordBatch.from_arrays([pa.array(f[joined]), pa.array(f[label[joined]])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held_b.append(batch.column("bucket").to_numpy())
            held_f.append(batch.column("fp").to_numpy())
            if sum(map(len, held_b)) < 1 << 16 or held_b[0][0] == held_b[-1][-1]:  # one bucket may go on
                continue
            b, f = np.concatenate(held_b), np.concatenate(held_f)
            cut = int(np.searchsorted(b, b[-1], "left"))  # the last bucket may go on
            if cut:
                yield flush(b[:cut], f[:cut])
            held_b, held_f = [b[cut:]], [f[cut:]]
        if held_b:
            b, f = np.concatenate(held_b), np.concatenate(held_f)
            if len(b):
                yield flush(b, f)

    return dealt.select("bucket", "fp").mapInArrow(search, "u long, v long").distinct()


def grouped(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints of ``prints`` (doc_id, fp, ...)."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(link_edges(distinct.select("fp"), distance))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(ids, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = checkpointed(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"))
    out = prints.join(grouped(prints, distance), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """One document of each group, with its own columns: the smallest doc_id (nulls last), then the smallest text hash."""
    names = docs.columns
    prints = with_fingerprints(docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash")))
    prints = checkpointed(prints.select("doc_id", "_text_hash", "fp"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text_hash")
    kept = (
        prints.groupBy("fp", "doc_id", "_text_hash").count()
        .join(grouped(prints, distance), "fp")
        .groupBy("root")
        .agg(F.min(F.struct(rank.alias("rank"), "count")).alias("first"))
        .select(F.col("first.rank.doc_id").alias("_kept_id"), F.col("first.rank._text_hash").alias("_kept_hash"), F.col("first.count").alias("_copies"))
    )
    kept = checkpointed(kept)
    keyed = docs.select(F.struct(*names).alias("_row"), F.xxhash64("text").alias("_hash"))
    match = F.col("_row.doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash"))
    single = keyed.join(kept.where("_copies = 1").hint("shuffle_hash"), match, "left_semi").select("_row.*")
    if kept.where("_copies > 1").isEmpty():
        return single
    several = keyed.join(kept.where("_copies > 1").hint("shuffle_hash"), match, "left_semi")
    return single.unionByName(several.groupBy("_row.doc_id", "_hash").agg(F.min("_row").alias("_row")).select("_row.*"))
