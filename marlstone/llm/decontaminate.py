"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The benchmark's windows of ``window`` consecutive words (a shorter item is one window) are
the patterns. Patterns of one length share a table: a *block* is a few consecutive words,
``shift`` says how far the search may jump after a block, and a block that ends a pattern
has a bucket, ordered by the pattern's first words, whose patterns are compared directly with
the document's words. A block that is in no pattern moves the search on by the whole pattern
length less the block, so most document words are never looked up. The documents of a batch
are cut into overlapping stretches, and all stretches are searched in step.

Scale: documents are scanned where they lie, without a shuffle. Tables are sorted arrays of
some 40 bytes a benchmark word (blocks and patterns by hash; the words themselves once). They
are built from item texts of at most ``block_bytes`` at once (the size is summed first), so a
table takes at most some ``TABLE_FACTOR`` times that; a larger benchmark is searched block by
block, each over the stored result of the last one.

Defined cases: a null or empty text has no words; an item without words is never found; a
null item_id counts as the id ''; rows with the same item_id are one item; items with equal
words share their patterns; repeated documents are searched each for itself; an empty table on
either side gives no hits; an added column replaces one of the same name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.store import stored
from marlstone.llm.textmap import append_columns, mixed, span_hashes, text_bytes, word_spans

#: Bytes of tables a byte of item text, at most, where words are long enough to be prose.
TABLE_FACTOR = 20
#: Words of a stretch that is searched in one go.
STRETCH = 384

_BYTES = np.array([b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)], np.uint8)


class Words:
    """The words of a batch of texts: normalised bytes, spans, hashes, and each text's first word.

    Words are runs of digits, letters of ASCII (lower-cased) and characters beyond ASCII.
    """

    def __init__(self, texts: pa.Array) -> None:
        data, off = text_bytes(texts)
        self.data = _BYTES[data]
        self.starts, self.ends, self.first = word_spans(self.data, off)
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def joined(self, a: int, b: int) -> bytes:
        """Words a to b, one space between them."""
        return b" ".join(self.data[self.starts[a] : self.ends[b - 1]].tobytes().split())


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """An order-dependent hash of every ``width`` consecutive word hashes."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mixed(out ^ hashes[k : k + n])
    return out


class WordTables:
    """Shift and bucket tables of all patterns of one length, in words.

    ``ends`` are the patterns' last words as numbers of the words ``w`` (with the item of each).
    """

    def __init__(self, length: int, w: Words, ends: np.ndarray, items: np.ndarray) -> None:
        self.length, self.block = length, min(3, length)
        self.most = length - self.block + 1
        blocks = _runs(w.hashes, self.block)
        keys, shifts = [], []
        for back in range(self.most):
            keys.append(np.unique(blocks[ends - back - self.block + 1]))
            shifts.append(np.full(len(keys[-1]), back, np.int32))
        key, shift = np.concatenate(keys), np.concatenate(shifts)
        order = np.lexsort((shift, key))
        key, shift = key[order], shift[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        self.keys, self.shifts = key[first], shift[first]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys & np.uint64((1 << 20) - 1)] = True
        last, head = blocks[ends - self.block + 1], _runs(w.hashes, min(2, length))[ends - length + 1]
        order = np.lexsort((ends, head, last))
        self.last, self.head, self.at, self.item = last[order], head[order], ends[order] - length + 1, items[order]
        # The patterns' words: from start to end with one space between them.
        size = w.ends - w.starts + 1
        self.text_at = np.concatenate([[0], np.cumsum(size)])
        taken = np.repeat(w.starts - self.text_at[:-1], size) + np.arange(int(self.text_at[-1]))
        inside = np.ones(len(taken), bool)
        inside[self.text_at[1:] - 1] = False
        self.text = np.where(inside, w.data[np.minimum(taken, max(0, len(w.data) - 1))] if len(taken) else 0, 0x20).astype(np.uint8).tobytes()

    def pattern(self, k: int) -> bytes:
        return self.text[self.text_at[self.at[k]] : self.text_at[self.at[k] + self.length] - 1]

    def search(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, item number) of every occurrence in a batch; occurrences lie within texts."""
        m, b = self.length, self.block
        blocks, heads = _runs(w.hashes, b), _runs(w.hashes, min(2, m))
        n = np.diff(w.first)
        per = np.where(n >= m, -(-(n - m + 1) // STRETCH), 0)
        text = np.repeat(np.arange(len(n)), per)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        # A stretch tries the ends from ``at`` up to, not with, ``stop``.
        at = w.first[text] + number * STRETCH + m - 1
        stop = np.minimum(at + STRETCH, w.first[text + 1])
        mask = np.uint64((1 << 20) - 1)
        hits = []
        while len(at):
            h = blocks[at - b + 1]
            step = np.full(len(at), self.most)
            near = np.flatnonzero(self.maybe[h & mask])
            where = np.minimum(np.searchsorted(self.keys, h[near]), len(self.keys) - 1)
            found = self.keys[where] == h[near]
            step[near[found]] = self.shifts[where[found]]
            hit = at[step == 0]
            if len(hit):
                hits.append(hit)
                step[step == 0] = 1
            at = at + step
            live = at < stop
            at, stop = at[live], stop[live]
        begins, items = [], []
        for end in np.sort(np.concatenate(hits)).tolist() if hits else ():
            start = end - m + 1
            lo, hi = np.searchsorted(self.last, blocks[end - b + 1]), np.searchsorted(self.last, blocks[end - b + 1], "right")
            own = self.head[lo:hi]
            lo, hi = lo + np.searchsorted(own, heads[start]), lo + np.searchsorted(own, heads[start], "right")
            if lo < hi:
                words = w.joined(start, end + 1)
                for k in range(lo, hi):
                    if self.pattern(k) == words:
                        begins.append(start)
                        items.append(self.item[k])
        return np.array(begins, np.int64), np.array(items, np.int64)


def build_tables(items: Iterable[tuple[str, str | None]], window: int) -> tuple[list[WordTables], list[list[str]]]:
    """(one table a pattern length, the item ids of each item number); ``items`` are (id, text)."""
    ids: dict[str, set[str]] = defaultdict(set)
    for item, text in items:
        ids[text or ""].add(item)
    texts = sorted(ids)
    w = Words(pa.array(texts, pa.string()))
    n = np.diff(w.first)
    tables = []
    for m in np.unique(np.minimum(n[n > 0], window)).tolist():
        mine = np.flatnonzero(np.minimum(n, window) == m)
        count = n[mine] - m + 1
        ends = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(w.first[mine] + m - 1, count)
        tables.append(WordTables(m, w, ends, np.repeat(mine, count)))
    return tables, [sorted(ids[t]) for t in texts]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint spans that cover the same words."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", _SPANS), T.StructField("item_ids", T.ArrayType(T.StringType()))]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` with n_words, hit_spans, item_ids (sorted), n_hit and contaminated.

    ``hit_spans`` are disjoint word ranges inside occurrences of benchmark windows. A document
    is contaminated if it has hits and they are a twentieth of its words or more.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    out = docs
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        tables = spark.sparkContext.broadcast(build_tables(((r.id, r.text) for r in block.toLocalIterator()), window))
        out = _scan(out, tables, first=k == 0)
        if blocks > 1 and k < blocks - 1:
            out = stored(out, "benchmark-hits")
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _scan(docs: DataFrame, tables, first: bool) -> DataFrame:
    earlier = docs if first else docs.withColumnRenamed("hit_spans", "_spans").withColumnRenamed("item_ids", "_items")

    def make():
        own, ids = tables.value

        def scan(texts: pa.Array) -> list:
            w = Words(texts)
            spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
            items: list[set[str]] = [set() for _ in range(len(texts))]
            for table in own:
                begins, numbers = table.search(w)
                owner = np.searchsorted(w.first, begins, "right") - 1
                for k, start, item in zip(owner.tolist(), (begins - w.first[owner]).tolist(), numbers.tolist()):
                    spans[k].append((start, start + table.length))
                    items[k].update(ids[item])
            return [np.diff(w.first), [[{"start": a, "end": b} for a, b in merged(at)] for at in spans], [sorted(found) for found in items]]

        return scan

    out = append_columns(earlier, "text", FIELDS, make)
    if first:
        return out
    both = F.array_sort(F.concat("_spans", "hit_spans"))
    empty = F.array().cast(_SPANS)
    grown = F.aggregate(
        both,
        empty,
        lambda acc, s: F.when((F.size(acc) == 0) | (s["start"] > F.element_at(acc, -1)["end"]), F.concat(acc, F.array(s))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))
        ),
    )
    return out.withColumn("hit_spans", grown).withColumn("item_ids", F.array_sort(F.array_distinct(F.concat("_items", "item_ids")))).drop("_spans", "_items")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The documents that are not contaminated, with their own columns in their order."""
    names = docs.columns
    if not {"n_words", "n_hit", "hit_spans", "item_ids", "contaminated"} & set(names):
        return benchmark_hits(docs, benchmark, window).where(~F.col("contaminated")).select(*names)
    packed = docs.select("text", F.struct(*names).alias("_row"))
    return benchmark_hits(packed, benchmark, window).where(~F.col("contaminated")).select("_row.*")
