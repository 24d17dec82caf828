"""Substring dedup: Rabin-Karp hashes of fixed-length token windows, counted in Spark.

A window is ``window`` consecutive words of one text. A word goes if a window that covers it
has the same words as a window that starts earlier (smaller doc_id, or earlier in the text);
overlapping and touching repeated windows merge into maximal removal intervals.

Every window has a rolling hash. Before windows are counted, those that cannot repeat are
ruled out: each window names its *anchor*, the least rolling hash of the ``anchor`` words
inside it. Equal windows name equal anchors, and neighbours share one, so there are some
seven times fewer anchors than windows; a window whose anchor occurs once is unique. Runs of
the other windows are compared as a whole first (copies and quoted passages are equal runs),
and only the first of each group of equal runs is opened into windows, which are counted.

Scale: anchors, runs and windows are counted by partial aggregation, so a passage in a third
of all documents sends one row a task. A window occurs no more often than its anchor, so the
anchors' counts tell which windows may be hot: their first occurrence is a grouped minimum, which
combines before the shuffle, and the others meet it in a join whose large keys Spark splits. All
other windows are ranked in groups of ``HOT`` rows at most. Shuffle files and tables of a step go
when it is over.

Defined cases: a null or empty text has no words; rows with the same doc_id and text are one
document repeated and get the same result; documents with one doc_id and different texts
follow in the order of their text hashes; a null doc_id comes before all others; a very long text
is treated whole; an empty table gives no rows; only doc_id (a whole number) and text are read,
so names of other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.store import discard, stored
from marlstone.llm.textmap import mixed, pieces, powers, span_hashes, text_bytes, word_spans

WINDOW = 20
ANCHOR = 8
#: A window whose anchor occurs more often is hot.
HOT = 256
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of all spans of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return mixed((prefix[width:] - prefix[:n]) * down[:n])


class Words:
    """The words of a batch of texts as hashes, and where each text's windows may start."""

    def __init__(self, texts: pa.Array, window: int, anchor: int) -> None:
        data, off = text_bytes(texts)
        starts, ends, self.first = word_spans(data, off)
        self.hashes = span_hashes(data, starts, ends)
        self.window, self.anchor = window, anchor
        n = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(texts)), n)
        left = np.repeat(self.first[1:], n) - np.arange(len(starts))
        self.starts = np.flatnonzero(left >= window)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every ``anchor`` words, the anchor's word number of each window in ``starts``)."""
        grams = rolling(self.hashes, self.anchor)
        reach = self.window - self.anchor + 1
        n = len(grams) - reach + 1
        if n <= 0:
            return grams, np.zeros(0, np.int64)
        best, at = grams[:n].copy(), np.zeros(n, np.int8)
        for j in range(1, reach):
            other = grams[j : j + n]
            less = other <= best
            best[less] = other[less]
            at[less] = j
        return grams, self.starts + at[self.starts]


_ANCHORS = T.StructType([T.StructField("h", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("at", T.IntegerType())])
_RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("run_a", T.LongType()),
        T.StructField("run_b", T.LongType()),
        T.StructField("windows", T.ArrayType(T.LongType())),
        T.StructField("checks", T.ArrayType(T.IntegerType())),
        T.StructField("later", T.ArrayType(T.BooleanType())),
        T.StructField("hot", T.ArrayType(T.BooleanType())),
    ]
)


def _anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = Words(part.column("text"), window, anchor)
                grams, at = w.anchors()
                at = np.unique(at)
                doc = part.column("doc").to_numpy()[w.owner[at]]
                yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(doc), pa.array((at - w.first[w.owner[at]]).astype(np.int32))], names=["h", "doc", "at"])

    return docs.select("doc", "text").mapInArrow(run, _ANCHORS)


def _run_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Maximal runs of windows whose anchors are in the text's ``repeated`` list; ``hot`` ones are marked."""

    def marked(lists: pa.Array, w: Words) -> np.ndarray:
        """Which words are in their text's list of places."""
        out = np.zeros(len(w.hashes) + 1, bool)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        real = flat < np.diff(w.first)[owner]
        out[w.first[owner[real]] + flat[real]] = True
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = Words(part.column("text"), window, anchor)
                repeated, hot = marked(part.column("repeated"), w), marked(part.column("hot"), w)
                _, at = w.anchors()
                starts, at = w.starts[repeated[at]], at[repeated[at]]
                if not len(starts):
                    continue
                new = np.concatenate([[True], (np.diff(starts) > 1) | (np.diff(w.owner[starts]) > 0)])
                head = np.flatnonzero(new)
                count = np.diff(np.append(head, len(starts)))
                begin = starts[head]
                end = begin + count - 1 + window
                other = mixed(w.hashes ^ _SECOND)
                own = w.owner[begin]
                hashes, checks = rolling(w.hashes, window)[starts], rolling(other, window)[starts] >> np.uint64(33)
                later = _later_here(hashes, checks, part, w, starts)
                offs = pa.array(np.append(head, len(starts)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(own)),
                        part.column("text_hash").take(pa.array(own)),
                        pa.array((begin - w.first[own]).astype(np.int32)),
                        pa.array(span_hashes(w.hashes, begin, end).view(np.int64)),
                        pa.array(span_hashes(other, begin, end).view(np.int64)),
                        pa.ListArray.from_arrays(offs, pa.array(hashes.view(np.int64))),
                        pa.ListArray.from_arrays(offs, pa.array(checks.astype(np.int32))),
                        pa.ListArray.from_arrays(offs, pa.array(later)),
                        pa.ListArray.from_arrays(offs, pa.array(hot[at])),
                    ],
                    names=_RUNS.names,
                )

    return docs.select("doc_id", "text_hash", "text", "repeated", "hot").mapInArrow(run, _RUNS)


def _later_here(hashes: np.ndarray, checks: np.ndarray, part: pa.RecordBatch, w: Words, starts: np.ndarray) -> np.ndarray:
    """Which windows have an equal one that starts earlier in this very batch."""
    ids = part.column("doc_id")
    text_hash = part.column("text_hash").to_numpy()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((text_hash, number, known))
    new = np.concatenate([[True], (np.diff(known[order].astype(int)) != 0) | (np.diff(number[order]) != 0) | (np.diff(text_hash[order]) != 0)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    mine, place = rank[w.owner[starts]], starts - w.first[w.owner[starts]]
    order = np.lexsort((place, mine, checks, hashes))
    h, c, r, p = hashes[order], checks[order], mine[order], place[order]
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    later = np.empty(len(h), bool)
    later[order] = same & ((r != r[lead]) | (p != p[lead]))
    return later


def removal_intervals(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc, spans): word ranges to remove from each document that has any.

    ``docs`` has doc (a hash of doc_id and text_hash), doc_id (a long), text_hash and text.
    """
    anchors = stored(_anchor_rows(docs, window, anchor), "anchors")
    # Stored first: joined as it is counted, its large keys couldn't be split.
    common = stored(anchors.groupBy("h").count().where(F.col("count") > 1).select("h", (F.col("count") > HOT).alias("hot")), "common-anchors")
    places = anchors.join(common.hint("merge"), "h").groupBy("doc").agg(F.collect_set("at").alias("repeated"), F.collect_set(F.when(F.col("hot"), F.col("at"))).alias("hot"))
    places = stored(places, "repeated-anchors")
    discard(anchors)
    discard(common)
    joined = docs.join(places.hint("shuffle_hash"), "doc")
    runs = stored(_run_rows(joined, window, anchor), "runs")
    discard(places)

    order = ["doc_id", "text_hash", "start"]
    first_runs = runs.groupBy("run_a", "run_b").agg(F.min(F.struct(*order)).alias("f")).select("run_a", "run_b", *(F.col("f")[c].alias(f"f_{c}") for c in order), F.lit(True).alias("first"))
    # The place is part of the key, so the runs of one group are dealt out.
    own = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in order]
    same = [runs[c] == first_runs[c] for c in ("run_a", "run_b")]
    judged = runs.join(first_runs.hint("merge"), [*same, *own], "left").select(*order, F.coalesce("first", F.lit(False)).alias("first"), F.size("windows").alias("n"), "windows", "checks", "later", "hot")
    lists = [F.when(F.col("first"), F.col(c)).alias(c) for c in ("windows", "checks", "later", "hot")]
    judged = stored(judged.select(*order, "first", "n", *lists), "judged-runs")
    discard(runs)
    # Of equal runs the first is opened into its windows; any other goes as a whole.
    whole = judged.where("not first").select(*order, (F.col("n") - 1 + window).alias("length"))
    opened = judged.where("first").select(*order, F.posexplode(F.arrays_zip("windows", "checks", "later", "hot")).alias("k", "w"))
    opened = opened.select("doc_id", "text_hash", (F.col("start") + F.col("k")).alias("start"), F.col("w.windows").alias("w"), F.col("w.checks").alias("c"), F.col("w.later").alias("known"), F.col("w.hot").alias("hot"))
    known = opened.where("known").select(*order, F.lit(window).alias("length"))
    # A window occurs no more often than its anchor: one that isn't hot has HOT rows at most.
    rare = opened.where("not known and not hot").select(*order, "w", "c")
    ranked = rare.withColumn("place", F.rank().over(Window.partitionBy("w", "c").orderBy(*order))).where("place > 1").select(*order, F.lit(window).alias("length"))
    hot = opened.where("not known and hot").select(*order, "w", "c")
    firsts = stored(hot.groupBy("w", "c").agg(F.min(F.struct(*order)).alias("f")), "first-windows")
    again = hot.join(firsts.hint("merge"), ["w", "c"]).where(F.struct(*order) != F.col("f")).select(*order, F.lit(window).alias("length"))
    later = whole.unionByName(known).unionByName(ranked).unionByName(again)
    later = later.select(F.xxhash64("doc_id", "text_hash").alias("doc"), F.col("start").alias("a"), (F.col("start") + F.col("length")).alias("b"))
    out = stored(later.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "removals")
    for table in (judged, firsts):
        discard(table)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc, doc_id (as a long), text_hash and text of each row; null texts are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, intervals (merged, in words), kept_sha256 and kept_text of every row."""
    own = keyed(docs)
    spans = removal_intervals(own, window, anchor)
    joined = own.join(spans.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "spans")
    return _kept(joined)


_SPAN = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))


def _kept(joined: DataFrame) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("intervals", _SPAN),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                n_words, n_removed, intervals, digests, texts = [], [], [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    words = text.encode().split()
                    merged: list[dict] = []
                    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                        if merged and a <= merged[-1]["b"]:
                            merged[-1]["b"] = max(merged[-1]["b"], b)
                        else:
                            merged.append({"a": a, "b": b})
                    n_words.append(len(words))
                    for s in reversed(merged):
                        del words[s["a"] : s["b"]]
                    kept = b" ".join(words)
                    n_removed.append(n_words[-1] - len(words))
                    intervals.append(merged)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode())
                arrays = [part.column("doc_id"), n_words, n_removed, intervals, digests, texts]
                arrow = [a if isinstance(a, pa.Array) else None for a in arrays]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([x if x is not None else pa.array(a, k) for x, a, k in zip(arrow, arrays, kinds)], names=schema.names)

    return joined.mapInArrow(run, schema)
