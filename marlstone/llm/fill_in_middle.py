"""Fill-in-the-middle transformation with succinct rank and select over UTF-8 texts.

A text's bytes give a packed bitvector with a one where a code point begins. A directory holds the
ones before each block of ``BLOCK`` bytes, so the total popcount is the number n of code points,
and ``select`` (a search in the directory, then popcounts of one block's words and a search in one
word) turns a rank into the byte where that code point begins. Two ranks, drawn from the document's
id, cut the text into prefix, middle and suffix; no text is decoded to code points.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` <S>suffix<P>prefix<M>middle and ``plain`` the
text itself. A marker has its one "<" in front, so none arises across a cut, and ``restored``
finds the parts again.

Scale: one map over the rows, in pieces of bounded size; nothing is shuffled. Memory follows the
longest text: an eighth of its bytes for the bits and a 64th for the directory.

Defined cases: a null text counts as empty and is plain, so is a text with a marker in it; a null id
counts as the empty text when the cuts are drawn; repeated documents are cut alike; columns of the
same names as the new ones are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.textmap import pieces, text_bytes

#: Bytes (so bits of the vector) that one entry of the directory covers.
BLOCK = 512
MARKERS = ("<P>", "<S>", "<M>")
TRANSFORMED_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20

FIELDS = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]


class Boundaries:
    """Rank directory and select over the bytes at which code points begin."""

    def __init__(self, data: np.ndarray) -> None:
        self.size = len(data)
        begins = np.zeros(-(-max(1, self.size) // BLOCK) * BLOCK, bool)
        np.not_equal(data & 0xC0, 0x80, out=begins[: self.size])
        self.words = np.packbits(begins, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points begin before each byte position."""
        at = np.asarray(at, np.int64)
        block = at // BLOCK
        total = self.before[block].copy()
        for k in range(BLOCK // 64):
            first = block * BLOCK + 64 * k
            inside = np.clip(at - first, 0, 64)
            word = self.words[np.minimum(first // 64, len(self.words) - 1)]
            mask = np.where(inside == 64, np.uint64(2**64 - 1), (np.uint64(1) << (inside % 64).astype(np.uint64)) - np.uint64(1))
            total += np.bitwise_count(word & mask)
        return total

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The byte where the code point of each rank (from 0) begins; the end for the rank after the last."""
        rank = np.asarray(rank, np.int64)
        block = np.minimum(np.searchsorted(self.before, rank, "right") - 1, len(self.before) - 2)
        words = self.words.reshape(-1, BLOCK // 64)[block]
        up_to = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        left = rank - self.before[block]
        k = np.minimum((up_to <= left[:, None]).sum(axis=1), BLOCK // 64 - 1)
        row = np.arange(len(rank))
        left = left - np.where(k > 0, up_to[row, k - 1], 0)
        bits = np.unpackbits(words[row, k].astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1, dtype=np.int64) <= left[:, None]).sum(axis=1)
        return np.minimum(block * BLOCK + 64 * k + bit, self.size)


def draws(doc_id: object) -> tuple[int, int, int, int]:
    """The four numbers of a document: two cuts, whether it is transformed, and the order."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    h = np.frombuffer(digest, ">u4")[:4]
    return int(h[0]), int(h[1]), int(h[2]), int(h[3])


def _cut(ids: list, texts: pa.Array) -> list[pa.Array]:
    data, off = text_bytes(texts)
    marks = Boundaries(data)
    starts = marks.rank(off)  # every text begins with a code point
    n = np.diff(starts)
    numbers = np.array([draws(i) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(numbers[:, :2] % (n + 1)[:, None], axis=1)
    first, second = marks.select(starts[:-1] + cuts[:, 0]), marks.select(starts[:-1] + cuts[:, 1])
    raw = memoryview(data)
    forms, outputs = [], []
    for k, (a, p, m, e) in enumerate(zip(off[:-1].tolist(), first.tolist(), second.tolist(), off[1:].tolist())):
        text = bytes(raw[a:e])
        if a == e or numbers[k, 2] % 100 >= TRANSFORMED_PERCENT or any(x.encode() in text for x in MARKERS):
            forms.append("plain")
            outputs.append(text)
            continue
        prefix, middle, suffix = text[: p - a], text[p - a : m - a], text[m - a :]
        forms.append("spm" if numbers[k, 3] % 100 < SUFFIX_FIRST_PERCENT else "psm")
        outputs.append(b"".join([b"<S>", suffix, b"<P>", prefix, b"<M>", middle] if forms[-1] == "spm" else [b"<P>", prefix, b"<S>", suffix, b"<M>", middle]))
    plain = np.array([f == "plain" for f in forms], bool)
    return [
        pa.array(n, pa.int64()),
        pa.array(forms, pa.string()),
        pa.array(cuts[:, 0], pa.int64(), mask=plain),
        pa.array(cuts[:, 1] - cuts[:, 0], pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]


def transformed(docs: DataFrame) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars (null where plain) and output.

    The cuts depend on ``doc_id`` alone; all other columns are kept.
    """
    names = {f.name for f in FIELDS}
    kept = [f for f in docs.schema.fields if f.name not in names]
    keep = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                made = _cut(part.column("doc_id").to_pylist(), part.column("text").fill_null(""))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=[*keep, *(f.name for f in FIELDS)])

    return docs.mapInArrow(run, T.StructType([*kept, *FIELDS]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from."""
    middle = F.substring_index(output, "<M>", -1)
    head = F.substring_index(output, "<M>", 1)
    cut = F.when(form == "psm", F.lit("<S>")).otherwise(F.lit("<P>"))
    left = F.call_function("substr", F.call_function("substring_index", head, cut, F.lit(1)), F.lit(4))
    right = F.call_function("substring_index", head, cut, F.lit(-1))
    prefix, suffix = F.when(form == "psm", left).otherwise(right), F.when(form == "psm", right).otherwise(left)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
