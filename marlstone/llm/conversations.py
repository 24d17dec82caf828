"""Conversation structure repair: faults of rows, cheapest edits, repaired conversations.

The rows of a conversation, by turn, get a fault each: blank, duplicate (role and text occurred
earlier) or truncated (the last visible character ends no sentence). Their roles and faults are the
conversation's signature; sorted distinct signatures go through the prefix trie of role_trie.py,
which finds for each the cheapest edits that leave roles ``(s?(ua)+)?``. The edits then go back to
the rows.

Scale: rows are range-partitioned by conversation, turn, role and the beginning of the text, so a
conversation of any size is spread over tasks, and get a number in that order. Earlier occurrences are
found by a minimum a (conversation, role, text). Signatures are put together from blocks of
4,096 rows; they hold one byte a row, as the answer has to. Only distinct signatures are solved;
answers meet rows by (conversation, index). Texts are shuffled twice (three times for the hash,
which SHA-256 makes sequential: it streams over a conversation's rows, holding one batch).

Defined cases: a null role or text is one space; null turns come first; a null conv_id is a
conversation of its own; rows of one turn are ordered by role, then by text; a role whose first
character is not s, u or a (an empty role too) can't be kept; columns other than the four are not
read, so names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.role_trie import CLASSES, FAULTS, LETTERS, Trie
from marlstone.llm.store import stored

#: What is not visible, and what ends a sentence (fixed values).
_BLANKS, _ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Rows a block, as a power of two.
_BLOCK_BITS = 12


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, drawn from conversation and turn.

    Of twenty draws one drops a row, one empties its text, one removes what ends its sentences, one
    repeats it, one sets its role to user.
    """
    space = F.lit(" ")
    draw = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).where("draw <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _named(conv_id: Column) -> Column:
    """A text that tells conversations apart and is never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with ``rid``, which numbers them by conversation, turn, role and text, and their own faults."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    shown = F.rtrim("text", F.lit(_BLANKS))
    own = F.coalesce(*[F.when(F.substring("role", 1, 1) == c, k) for k, c in enumerate(CLASSES)], F.lit(3))
    fault = _own_fault(shown)
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return stored(
        ordered.select(
            "conv_id",
            "turn",
            "role",
            "text",
            _named(F.col("conv_id")).alias("conv"),
            own.alias("class"),
            fault.alias("fault"),
            F.md5(F.concat(F.md5("role"), "text")).alias("content"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "conversation-rows",
    )


def _own_fault(shown: Column) -> Column:
    """Blank or truncated, or 0; ``shown`` is the text without blanks at its end."""
    last = F.substring(shown, -1, 1)
    return F.when(shown == "", FAULTS.index("blank")).when(~last.isin(*_ENDS), FAULTS.index("truncated")).otherwise(0)


def _solved(signatures: DataFrame) -> DataFrame:
    """The answer of every distinct signature, by tries over ranges of sorted signatures."""
    schema = "signature string, cost long, audit string, illegal long, blank long, duplicate long, truncated long, edits array<string>"
    names = ["signature", "cost", "audit", "illegal", "blank", "duplicate", "truncated", "edits"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            rows = []
            for s in batch.column("signature").to_pylist():
                a = trie.insert(s)
                rows.append((s, a.cost, a.audit, a.illegal, a.blank, a.duplicate, a.truncated, a.edits))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    dealt = signatures.distinct().repartitionByRange(F.substring("signature", 1, 256)).sortWithinPartitions("signature")
    return dealt.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, conversations) of rows (conv_id, turn, role, text).

    report: conv_id, gaps (turns that are missing), blank, duplicate, truncated, illegal (pairs
    of neighbours that can't follow each other), cost and audit (letters of the edits), one row a
    conversation. conversations: conv_id, turn, role, text of what is left; row and step give the order.
    """
    all_rows = _ordered(rows)
    narrow = all_rows.select("conv", "rid", "class", "fault", "content")
    first = narrow.groupBy("conv", "content").agg(F.min("rid").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stored(first, "conversation-repeats")  # joined as it is summed, a large group couldn't be split
    blank, repeat = FAULTS.index("blank"), FAULTS.index("duplicate")
    fault = F.when((F.col("fault") != blank) & (F.col("rid") > F.col("first")), repeat).otherwise(F.col("fault"))
    letter = F.substr(F.lit(LETTERS), F.col("class") * 4 + fault + 1, F.lit(1))
    block = F.shiftright("rid", _BLOCK_BITS)
    flagged = narrow.join(first, ["conv", "content"], "left").select("conv", "rid", block.alias("block"), letter.alias("letter"))
    gathered = F.array_sort(F.collect_list(F.struct("rid", "letter")))
    blocks = flagged.groupBy("conv", "block").agg(F.array_join(F.transform(gathered, lambda x: x["letter"]), "").alias("letters"), F.min("rid").alias("from"))
    blocks = stored(blocks, "conversation-blocks")
    whole = F.array_sort(F.collect_list(F.struct("block", "letters")))
    signed = stored(blocks.groupBy("conv").agg(F.array_join(F.transform(whole, lambda x: x["letters"]), "").alias("signature")), "conversation-signatures")
    answers = stored(_solved(signed.select("signature")), "conversation-answers")
    turns = all_rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    answered = signed.join(answers, "signature")
    report = turns.join(answered.drop("signature", "edits"), "conv").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    length = F.length("letters")
    blocks = blocks.select("conv", "block", "from", (F.sum(length).over(Window.partitionBy("conv").orderBy("block")) - length).alias("before"))
    index = all_rows.select("conv", "rid", block.alias("block")).join(blocks, ["conv", "block"]).select("conv", "rid", (F.col("before") + F.col("rid") - F.col("from")).alias("index"))
    edits = answered.select("conv", F.posexplode("edits").alias("index", "edit")).where("edit <> ''")
    placed = index.join(edits.withColumn("index", F.col("index").cast("long")), ["conv", "index"]).select("rid", "edit")
    steps = all_rows.select("conv_id", "turn", "role", "text", "rid").join(placed, "rid").select("*", F.posexplode(F.split("edit", "")).alias("step", "sign")).where("sign <> ''")
    inserted = F.col("sign").isin("U", "A")
    role = F.when(F.col("sign") == "k", F.col("role")).when(F.lower("sign") == "u", "user").otherwise("assistant")
    left = steps.select("conv_id", F.when(~inserted, F.col("turn")).alias("turn"), role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"), F.col("rid").alias("row"), "step")
    return report, left


def hashed(conversations: DataFrame) -> DataFrame:
    """conv and sha256 of ``role:text`` of the rows of each conversation, joined by newlines; rows are streamed."""
    rows = conversations.select(_named(F.col("conv_id")).alias("conv"), F.concat("role", F.lit(":"), "text").alias("line"), "row", "step")
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "row", "step").select("conv", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def made(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.string()), pa.array([h for _, h in done], pa.string())], names=["conv", "sha256"])

        for batch in batches:
            done = []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if conv != last:
                    if state is not None:
                        done.append((last, state.hexdigest()))
                    last, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            if done:
                yield made(done)
        if state is not None:
            yield made([(last, state.hexdigest())])

    return dealt.mapInArrow(run, "conv string, sha256 string")


def audited(rows: DataFrame) -> DataFrame:
    """The report of every conv_id of ``rows`` after planted damage, with the hash of what the repair leaves."""
    report, left = repaired(damaged(rows))
    ids = rows.select("conv_id").distinct().select("conv_id", _named(F.col("conv_id")).alias("conv"))
    report = report.withColumn("conv", _named(F.col("conv_id"))).drop("conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    found = ids.join(report, "conv", "left").join(hashed(left), "conv", "left")
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
