"""Packing of tokenised documents into sequences of a fixed length (see packing_plan.py).

Every document becomes the token ids of its whole text and an end id. A document that is longer than
a sequence is cut into full pieces; its first piece is the shorter one. All pieces are placed by a
plan over their length histogram: linear grouping of the large pieces, an optimised choice of
configurations for the few group sizes, substitution of the actual pieces, best fit for the small.

Scale: texts are read once; the pieces are written with the number of the task (``part``) and their
place among the task's pieces of the same length. The driver sees one number a length. A piece's rank
among all of its length is its place plus what earlier tasks have (a running sum a length over
tasks), and the plan says by runs of ranks which sequence and offset a rank takes; it has some
thousands of runs, whatever the size of the corpus, so it is broadcast. No sequence, length or
group of copies is gathered in one task.

Token ids: words of characters that all Unicode versions class alike are cut by the pattern of the
tokenizer and each distinct word is encoded once a task (``MOST_WORDS`` are remembered); a text
with any other character goes to the tokenizer as a whole. Both give the tokenizer's ids. The strings
of special tokens in a text are ordinary text.

Defined cases: a null or empty text is one piece, the end id; repeated documents are packed each for
itself; a very long text is encoded whole, in one task; null ids stay null; other columns are
not read, so names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm import packing_plan
from marlstone.llm.store import stored
from marlstone.llm.textmap import pieces as text_pieces

MODEL = "byte_bpe_50k.json"
LENGTH, END = 1024, 2
GROUPS, SMALL = 256, 256
#: Distinct words that a task remembers, and the longest of them (in characters).
MOST_WORDS, LONGEST_WORD = 300_000, 64
#: Tokens to an output batch.
_BATCH = 1 << 20

#: Unicode's White_Space (fixed values).
_SPACE = "\t-\r \u0085   -     　"


def _ranges(points: list[int]) -> str:
    """The inside of a character class."""
    out, at = [], 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\u{points[at]:04x}-\\u{points[end]:04x}")
        at = end + 1
    return "".join(out)


@cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """The tokenizer's words, and a character that not all Unicode versions class alike."""
    kinds: dict[str, list[int]] = {"L": [], "N": [], "other": []}
    old = unicodedata.ucd_3_2_0
    for p in range(0x10000):
        c = chr(p)
        now, then = unicodedata.category(c), old.category(c)
        if then in ("Cn", "Cs") or (now[0] in "LNZ" or then[0] in "LNZ") and now[0] != then[0]:
            kinds["other"].append(p)
        elif now[0] in "LN":
            kinds[now[0]].append(p)
    letters, numbers = _ranges(kinds["L"]), _ranges(kinds["N"])
    words = re.compile(f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{_SPACE}{letters}{numbers}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
    return words, re.compile(f"[{_ranges(kinds['other'])}\U00010000-\U0010ffff]")


#: Byte-level models write a byte as its Latin-1 character where that is visible, the others as the characters from U+0100 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF)]
_BYTE_LETTERS = {b: chr(0x100 + k) for k, b in enumerate(_HIDDEN)}


class _Words(dict):
    """Little-endian ids of words; a missing word is encoded, and kept while there is room."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids


def encoder(model: str) -> Callable[[str], bytes]:
    """From a text to its ids as little-endian unsigned 32-bit numbers."""
    from tokenizers import Tokenizer

    if "/" not in model:
        import public_tokenizers

        model = public_tokenizers.path(model)
    tokenizer = Tokenizer.from_file(model)
    tokenizer.encode_special_tokens = True

    def encode(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    merged = tokenizer.model.tokenize

    space = _BYTE_LETTERS[0x20]

    def encode_word(word: str) -> bytes:
        plain = word.isascii() and word.isprintable()  # of its bytes only the space is hidden
        ids = [t.id for t in merged(word.replace(" ", space) if plain else word.encode().decode("latin-1").translate(_BYTE_LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    words, unsure = _patterns()
    known = _Words(encode_word)
    return lambda text: encode(text) if not text.isascii() and unsure.search(text) else b"".join(map(known.__getitem__, words.findall(text)))


def cut_lengths(tokens: int, length: int) -> list[int]:
    """The pieces of a document: one, or a first that may be shorter and full ones."""
    if tokens <= length:
        return [tokens]
    return [tokens % length] * (tokens % length > 0) + [length] * (tokens // length)


def tokenised(docs: DataFrame, length: int = LENGTH, end: int = END, model: str = MODEL) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), part, place.

    ``part`` is the task and ``place`` counts the task's pieces of the same length, so they tell
    pieces apart only in a table that is written once.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids binary, part int, place long"
    names = ["doc_id", "piece", "start", "length", "ids", "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model)
        part = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        tail = np.array([end], "<u4").tobytes()

        def made(kind: pa.DataType, ids: list, rows: list) -> pa.RecordBatch:
            number, start, size, data, place = zip(*rows)
            n = len(rows)
            columns = [pa.array(ids, kind), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(data, pa.binary()), pa.array([part] * n, pa.int32()), pa.array(place, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for some in text_pieces(batch, "text"):
                ids, rows, held = [], [], 0
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    data = encode(text or "") + tail
                    at = 0
                    for number, size in enumerate(cut_lengths(len(data) // 4, length)):
                        ids.append(doc_id)
                        rows.append((number, at, size, data[4 * at : 4 * (at + size)], int(seen[size])))
                        seen[size] += 1
                        at, held = at + size, held + size
                        if held >= _BATCH:
                            yield made(some.schema.field("doc_id").type, ids, rows)
                            ids, rows, held = [], [], 0
                if rows:
                    yield made(some.schema.field("doc_id").type, ids, rows)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def packed(docs: DataFrame, length: int = LENGTH, end: int = END, groups: int = GROUPS, small: int = SMALL, model: str = MODEL) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids) with sequence_id and offset.

    Sequences are numbered from 0 without gaps; in each, pieces lie at offsets without gaps.
    """
    spark = docs.sparkSession
    cut = stored(tokenised(docs, length, end, model), "pieces")
    own = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(length + 1, np.int64)
    for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length
        counts[r["length"]] = r["n"]
    slots = packing_plan.slots(packing_plan.plan(counts, groups, small))
    table = spark.createDataFrame(slots, "length long, low long, high long, first_sequence long, each long, first_offset long")
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    before = stored(own.select("length", "part", earlier.alias("before")), "piece-ranks")
    ranked = cut.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    found = ranked.join(F.broadcast(table), "length").where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        (F.col("first_sequence") + _divided(nth, F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("length")).alias("offset"),
    )


def _divided(value: Column, by: Column) -> Column:
    """Whole division of longs that are not negative."""
    return F.call_function("div", value, by)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row a sequence of ``packed``: its ids, and the offsets at which documents begin.

    A sequence has no more pieces than tokens, so what is gathered is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.transform("p", lambda p: F.struct(p["offset"], p["doc_id"], p["piece"])).alias("documents"))
