"""Which texts contain which expected answers, every text against every answer.

The expected answers are sought by anchors, as whole words inside them: an occurrence of an
answer of three words or more holds its inner words as whole words, so one to three of them are
looked up at every position of a text, and the answers found there are compared in full. Answers
of one or two words have no inner word and are compared with every text.

Scale: texts are searched where they lie, without a shuffle. The answers are broadcast in blocks
of at most ``block_bytes``; more of them are searched block by block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marlstone.functions import text

_ANCHOR = 3


class Anchors:
    """Normalised answers by the first whole words inside them."""

    def __init__(self, answers: Iterable[tuple[int, str]]) -> None:
        ids: dict[str, list[int]] = defaultdict(list)
        for k, answer in answers:
            if answer:
                ids[answer].append(k)
        self.ids = dict(ids)
        self.plain = [a for a in ids if a.count(" ") < 2]
        self.tables: dict[int, dict[tuple[str, ...], list[str]]] = {}
        for a in ids:
            inner = tuple(a.split(" ")[1:-1][:_ANCHOR])
            if inner:
                self.tables.setdefault(len(inner), {}).setdefault(inner, []).append(a)

    def found(self, own: str) -> list[int]:
        """Ids of the answers that the normalised text contains."""
        words = own.split(" ")
        out = [a for a in self.plain if a in own]
        for n, table in self.tables.items():
            for key in table.keys() & set(zip(*(words[k:] for k in range(n)))):
                out += [a for a in table[key] if a in own]
        return [k for a in out for k in self.ids[a]]


def contained(texts: DataFrame, answers: DataFrame, block_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, item_id) of all ``texts`` (doc_id, text) that contain an answer (item_id, text), as ``contains_expected``."""
    spark = texts.sparkSession
    # The position in the block stands for the id, whatever its type.
    items = answers.select("item_id", text.normalize_answer(F.col("text")).alias("want")).where("want <> ''")
    own = texts.select("doc_id", text.normalize_answer(F.col("text")).alias("own"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("want")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    out = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "want"), F.lit(blocks)) == b) if blocks > 1 else items
        found = _search(own, block, answers.schema["item_id"].dataType, spark)
        out = found if out is None else out.unionAll(found)
    return out


def _search(own: DataFrame, block: DataFrame, kind: T.DataType, spark: SparkSession) -> DataFrame:
    rows = [(r.item_id, r.want) for r in block.toLocalIterator()]
    arrow = to_arrow_type(kind)
    payload = spark.sparkContext.broadcast(([r[0] for r in rows], Anchors((k, r[1]) for k, r in enumerate(rows))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, anchors = payload.value
        for batch in batches:
            at, ids = [], []
            for k, one in enumerate(batch.column("own")):
                found = anchors.found(one.as_py())
                at += [k] * len(found)
                ids += [item_ids[i] for i in found]
            if at:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, arrow)], names=["doc_id", "item_id"])

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, item_id {kind.simpleString()}")
