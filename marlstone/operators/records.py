"""Dataset records: normalisation, selection, constraints, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.text import is_blank, stripped

#: Keys that move into metadata unless it has them.
PROMOTED = ("research_role", "training_eligible", "evaluation_set_id", "evaluation_set_version", "source_record_id", "source_reference_id", "fact_group_id", "knowledge_unit_id", "variant_id", "record_provenance", "source_evidence")
#: Spellings of the evaluation split, and the roles of messages.
EVALUATION_SPLITS = ("validation", "test", "eval", "evaluation")
ROLES = ("system", "user", "assistant")


def cleaned_split(split: Column) -> Column:
    return F.lower(stripped(F.coalesce(split.cast("string"), F.lit(""))))


def normalize_split(split: Column) -> Column:
    """train (also for null and blank), evaluation, or null for an unknown split."""
    s = cleaned_split(split)
    return F.when(s.isin("", "train"), "train").when(s.isin(*EVALUATION_SPLITS), "evaluation")


def with_metadata(df: DataFrame) -> DataFrame:
    """Records with the split normalised and the roles of legacy splits filled in.

    Promoted keys are read as columns ``meta_<key>`` (from metadata) over ``<key>`` (top level).
    ``meta_keys`` and ``top_keys`` (arrays) say which keys were there; a key that is there with
    null keeps its null, and no default takes its place. Without these arrays null is absent.
    """
    s = cleaned_split(F.col("split"))
    legacy = s.isin("validation", "test")

    def promoted(key: str, kind: str, default: Column | None = None) -> Column:
        value = F.lit(None) if default is None else default
        for column, keys in ((key, "top_keys"), (f"meta_{key}", "meta_keys")):
            if column in df.columns:
                there = F.coalesce(F.array_contains(keys, key), F.lit(False)) if keys in df.columns else F.col(column).isNotNull()
                value = F.when(there, F.col(column).cast(kind)).otherwise(value)
        return value

    made = {"original_split": promoted("original_split", "string", F.when(legacy, s)) if "meta_original_split" in df.columns else F.when(legacy, s)}
    made["research_role"] = promoted("research_role", "string", F.when(legacy, F.concat(F.lit("legacy_"), s)))
    made["training_eligible"] = promoted("training_eligible", "boolean", F.when(legacy, F.lit(False)))
    made |= {key: promoted(key, "string") for key in PROMOTED[2:] if f"meta_{key}" in df.columns}
    own = df.withColumns({**made, "split": normalize_split(F.col("split"))})
    return own.drop(*[f"meta_{k}" for k in (*PROMOTED, "original_split")], "meta_keys", "top_keys")


def normalize_messages(messages: Column, question: Column, answer: Column) -> Column:
    """The message list, or question and answer as two messages."""
    pair = F.array(F.struct(F.lit("user").alias("role"), question.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    return F.when(F.size(messages) > 0, messages).otherwise(pair)


def messages_error(messages: Column) -> Column:
    """Why a message list is invalid, or null."""
    blank = F.exists(messages, lambda m: is_blank(m["content"]))
    bad_role = F.exists(messages, lambda m: ~F.coalesce(stripped(m["role"]).isin(*ROLES), F.lit(False)))
    no_answer = ~F.exists(messages, lambda m: m["role"] == "assistant")
    return F.when(bad_role, "unsupported role").when(blank, "blank content").when(no_answer, "no assistant message")


def last_message(messages: Column, role: str) -> Column:
    """The content of the last message of a role."""
    own = F.filter(messages, lambda m: m["role"] == role)
    return F.when(F.size(own) > 0, F.element_at(own, -1)["content"])


def is_trainable() -> Column:
    """Training split, role absent or training, not declared ineligible. Never null."""
    role = F.col("research_role")
    return (F.col("split") == "train") & (role.isNull() | (role == "training")) & ~F.col("training_eligible").eqNullSafe(False)


def training_records(df: DataFrame) -> DataFrame:
    return df.where(is_trainable())


def evaluation_records(df: DataFrame) -> DataFrame:
    return df.where(~is_trainable())


def selected_training(df: DataFrame, tokens: str, max_length: int, max_examples: int | None = None, order: tuple[str, ...] = ("source_ordinal", "line_number")) -> DataFrame:
    """The first ``max_examples`` trainable records that are not too long, in stream order.

    With a limit this is a top-k by order, not a global sort.
    """
    fits = training_records(df).where(F.col(tokens) <= max_length).orderBy(*order)
    return fits if max_examples is None else fits.limit(max_examples)


def skip_samples(df: DataFrame, tokens: str, max_length: int, most: int = 10, order: tuple[str, ...] = ("source_ordinal", "line_number")) -> DataFrame:
    """The first overlength trainable records."""
    return training_records(df).where(F.col(tokens) > max_length).orderBy(*order).limit(most)


def duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1")


def suite_name() -> Column:
    return F.when(is_trainable(), "training").otherwise(F.coalesce("research_role", F.lit("legacy_evaluation")))


def suite_counts(df: DataFrame) -> DataFrame:
    """Evaluation records by suite."""
    return evaluation_records(df).groupBy(F.coalesce("research_role", F.lit("legacy_evaluation")).alias("suite")).agg(F.count("*").alias("n"))


def read_problems(df: DataFrame, sources: dict[int, dict]) -> DataFrame:
    """What a reader must not pass on, as rows (rule, source_ordinal, record_id).

    ``sources`` has for each evaluation source (by ordinal) its declared ``research_role`` and
    ``record_count``. Rules: ids that occur twice in all sources, records of an evaluation
    source that could be trained on or have another role, and counts that differ.
    """
    at = F.col("source_ordinal")
    rule = lambda name, rows: rows.select(F.lit(name).alias("rule"), F.col("source_ordinal").cast("int").alias("source_ordinal"), F.col("record_id").cast("string").alias("record_id"))
    twice = df.where("record_id is not null").groupBy("record_id").agg(F.count("*").alias("n"), F.max("source_ordinal").alias("source_ordinal")).where("n > 1")
    out = rule("duplicate_record_id", twice)
    if not sources:
        return out
    declared = F.create_map(*[F.lit(x) for k, v in sources.items() for x in (k, v.get("research_role"))])
    counts = F.create_map(*[F.lit(x) for k, v in sources.items() for x in (k, int(v.get("record_count", -1)))])
    held = df.where(at.isin(*sources))
    frozen = (F.col("split") == "evaluation") & F.col("training_eligible").eqNullSafe(False)
    out = out.union(rule("evaluation_record_trainable", held.where(~F.coalesce(frozen, F.lit(False)))))
    out = out.union(rule("evaluation_role_differs", held.where(~F.col("research_role").eqNullSafe(F.try_element_at(declared, at)))))
    wanted = df.sparkSession.createDataFrame([(k,) for k in sources], "source_ordinal int")
    seen = wanted.join(held.groupBy("source_ordinal").agg(F.count("*").alias("n")), "source_ordinal", "left").fillna(0, ["n"])
    return out.union(rule("record_count_differs", seen.where(F.col("n") != F.try_element_at(counts, at)).withColumn("record_id", F.lit(None))))


def statistics(df: DataFrame) -> DataFrame:
    """Totals and the suite counts as a map, one row."""
    totals = df.agg(F.count("*").alias("total_records"), F.count_if(is_trainable()).alias("training_records"), F.count_if(~is_trainable()).alias("evaluation_records"))
    suites = suite_counts(df).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("suite", "n")))).alias("suites"))
    return totals.crossJoin(suites)  # one row each


def preflight(df: DataFrame, tokens: str, max_length: int, max_examples: int | None) -> DataFrame:
    """Totals, longest texts, skipped and accepted examples in one aggregation."""
    train = is_trainable()
    fits = train & (F.col(tokens) <= max_length)
    accepted = F.count_if(fits)
    limit = F.lit(max_examples)
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_if(train).alias("trainable_records"),
        F.count_if(~train).alias("evaluation_records"),
        F.count_if(train & (F.col(tokens) > max_length)).alias("skipped_overlength"),
        F.coalesce(F.max(F.when(train, F.col(tokens))), F.lit(0)).alias("longest_training"),
        F.coalesce(F.max(F.when(~train, F.col(tokens))), F.lit(0)).alias("longest_evaluation"),
        (accepted if max_examples is None else F.least(accepted, limit)).alias("accepted_examples"),
        (F.count_if(train) if max_examples is None else F.least(F.count_if(train), limit)).alias("selected_candidates"),
    )


def violations(df: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """Broken record constraints as rows (rule, record_id)."""
    duplicate = duplicate_ids(df).select(F.lit("duplicate_record_id").alias("rule"), "record_id")
    unknown = df.where(F.col("split").isNull()).select(F.lit("unknown_split").alias("rule"), "record_id")
    rows = duplicate.union(unknown)
    if "messages" in df.columns:
        rows = rows.union(df.where(messages_error(F.col("messages")).isNotNull()).select(messages_error(F.col("messages")).alias("rule"), "record_id"))
    if expected:
        counts = statistics(df)
        for name, want in expected.items():
            rows = rows.union(counts.where(F.col(name) != want).select(F.lit(f"count:{name}").alias("rule"), F.lit(None).cast("string")))
    return rows


def lineage_row(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A lineage projection; absent columns become null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def split_counts_map(fields: dict[str, Column]) -> Column:
    """Known counts only: an absent count stays absent, a zero stays."""
    entries = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v.cast("long"))])
    return F.map_filter(entries, lambda _, v: v.isNotNull())


def token_totals(df: DataFrame) -> DataFrame:
    """Examples, input tokens and target tokens (labels other than -100)."""
    targets = F.size(F.filter("labels", lambda x: x != -100))
    return df.agg(F.count("*").alias("examples"), F.sum(F.size("input_ids")).alias("input_tokens"), F.sum(targets).alias("target_tokens"))


def training_totals(steps: DataFrame, batch: int, accumulation: int) -> DataFrame:
    """What a run has processed, from its micro-batches (examples, input_tokens, target_tokens, loss).

    A step is complete after ``accumulation`` micro-batches; the mean loss is over all of them.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_processed")
    return steps.agg(
        F.floor(F.count("*") / accumulation).alias("train_steps"), F.avg("loss").alias("train_loss"), total("examples"), total("input_tokens"), total("target_tokens"), F.lit(batch * accumulation).cast("long").alias("effective_batch_size")
    )


def padded(df: DataFrame, batch: str = "batch_id", pad: int = 0) -> DataFrame:
    """Right-padded ids, attention mask and labels of each batch."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    gap = longest - F.size("input_ids")
    return df.select(
        batch,
        F.concat("input_ids", F.array_repeat(F.lit(pad), gap)).alias("input_ids"),
        F.concat(F.transform("input_ids", lambda _: F.lit(1)), F.array_repeat(F.lit(0), gap)).alias("attention_mask"),
        F.concat("labels", F.array_repeat(F.lit(-100), gap)).alias("labels"),
        *[c for c in df.columns if c not in (batch, "input_ids", "labels", "attention_mask")],
    )


def masked_labels(ids: Column, mask: Column) -> Column:
    """Labels from an assistant mask: the token where set, else -100."""
    return F.zip_with(ids, mask, lambda t, m: F.when(m == 1, t).otherwise(-100))


def prefix_labels(prefix_lengths: Column, roles: Column, ids: Column) -> Column:
    """Labels when turn k added the tokens from prefix k-1 to prefix k: assistant turns only, and never the first turn."""
    start = lambda k: F.when(k > 0, F.get(prefix_lengths, k - 1)).otherwise(0)
    return F.flatten(
        F.transform(
            roles,
            lambda r, k: F.when((r == "assistant") & (k > 0), F.slice(ids, start(k) + 1, F.get(prefix_lengths, k) - start(k))).otherwise(F.array_repeat(F.lit(-100), F.get(prefix_lengths, k) - start(k))),
        )
    )


def rewritten_prefix(prefixes: Column) -> Column:
    """Whether some rendered prefix (an array of token arrays) doesn't begin with the one before."""
    return F.exists(F.sequence(F.lit(1), F.size(prefixes) - 1), lambda k: F.slice(F.get(prefixes, k), F.lit(1), F.size(F.get(prefixes, k - 1))) != F.get(prefixes, k - 1)) & (F.size(prefixes) > 1)


def label_error(ids: Column, labels: Column, max_length: int | None = None) -> Column:
    """Why an encoded example can't be trained on, or null."""
    long = F.lit(False) if max_length is None else F.size(ids) > max_length
    return (
        F.when(F.size(ids) != F.size(labels), "lengths differ")
        .when(~F.exists(labels, lambda x: x != -100), "no target tokens")
        .when(long, "too long")
    )


def encoded_examples(df: DataFrame, encode, max_length: int | None = None) -> DataFrame:
    """input_ids, labels and ``error`` of each record's ``messages`` by a tokenizer callable.

    ``encode`` maps a list of {role, content} to (token ids, assistant mask), or to the token ids
    of every prefix where it knows no mask; it runs in batches on the executors. With prefixes a
    turn's tokens are what it added, and a rewritten prefix is an error.
    """
    schema = "array<struct<ids: array<int>, mask: array<int>>>"

    @F.udf(schema)
    def rendered(messages):
        made = encode([{"role": m["role"], "content": m["content"]} for m in messages])
        if isinstance(made, tuple):
            return [(list(made[0]), [int(bool(x)) for x in made[1]])]
        return [(list(p), None) for p in made]

    own = df.withColumn("_r", rendered("messages"))
    last = F.element_at("_r", -1)
    prefixes = F.transform("_r", lambda x: x["ids"])
    by_prefix = prefix_labels(F.transform("_r", lambda x: F.size(x["ids"])), F.transform("messages", lambda m: m["role"]), last["ids"])
    labels = F.when(last["mask"].isNotNull(), masked_labels(last["ids"], last["mask"])).otherwise(by_prefix)
    rewritten = F.when(last["mask"].isNull() & rewritten_prefix(prefixes), "prefix rewritten")
    out = own.withColumn("input_ids", last["ids"]).withColumn("labels", labels)
    return out.withColumn("error", F.coalesce(rewritten, label_error(F.col("input_ids"), F.col("labels"), max_length))).drop("_r")
