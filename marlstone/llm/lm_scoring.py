"""LM scoring: a causal self-attention model over subword ids scores whole texts.

Tokens are the lower-cased words of a text and one end mark. Words become subword ids of a
public vocabulary, and attention.py's model reads them. Where a word has ended, the next
word's first piece is the attention model's, given that a word begins; the rest of the word,
up to and with its end, is a mixture of the attention model's spelling and the lexicon, the
training counts of the words that begin with that piece. The lexicon's share is n / (n + d),
n being the occurrences and d the distinct words of that first piece (Witten and Bell). All
parts sum to at most one, so the score is a log probability.

Base score: each token's add-one unigram probability from the training tokens.

Learning covers every training text, whatever its length, in four steps:

1. Every text is cut into subword ids once, and they are stored beside it (``encoded``). It gives windows to
   start from, one each ``SPACING`` bytes and one at its beginning, and the counts of its words.
2. A model is started on about ``STARTERS`` of these windows, chosen by hash.
3. ``ROUNDS`` times, each task trains the model on all windows of its training texts, so that every
   piece is a target of the gradient once, and the copies are averaged row by row, weighted by how
   often a task used the row.
4. The output distributions, given the learned weights, are gathered from all ids of all training texts.

Scale: counts are summed by task and then by key. The ``frequent`` most frequent words (a
fixed number) are known to every task with their counts; occurrences of rarer
words leave as rows and meet their counts in a join, so nothing that grows is broadcast. At
most one row a piece of the vocabulary reaches the driver. Each text is scored where it lies.

Defined cases: a null or empty text is an end mark alone; a very long text or word is learnt
from and scored as any other; without training texts every subword is equally likely;
repeated documents score alike; an empty table gives no rows; columns other than doc_id and
text are not read, so their names can't clash.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.llm.attention import LENGTH, STRIDE, AttentionModel, Reader, windows
from marlstone.llm.labelled import fold
from marlstone.llm.sentencepieces import MODEL
from marlstone.llm.store import discard, stored
from marlstone.llm.textmap import pieces, text_bytes

FOLDS, HELD_OUT = 7, 2
FREQUENT = 200_000
SPACING, STARTERS, STEPS, ROUNDS = 2048, 40_000, 800, 1
_MOST_WORDS = 400_000
_PIECE_BYTES, _ID_BYTES = 3 << 20, 9 << 18


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, index of each word among them, number of words of each text).

    Words are lower-cased (A-Z) and stand between the six separators; a null text has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    owner, at = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy(zero_copy_only=False)), coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary
    empty = pc.index(distinct, "").as_py() if len(distinct) else -1
    if empty >= 0:  # beside separators at the ends of texts
        real = at != empty
        owner, at = owner[real], at[real]
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), " ")[0].as_py() if len(distinct) else ""
    words = joined.encode().split(b" ") if len(distinct) else []
    return words, at, np.bincount(owner, minlength=len(texts))


class Words:
    """Numbers of words; what is beyond the first, ``fixed`` words may be forgotten."""

    def __init__(self, fixed: list[bytes] = ()) -> None:
        self.fixed = fixed
        self.forget()

    def forget(self) -> None:
        self.index = dict(zip(self.fixed, range(len(self.fixed))))

    def meet(self, words: list[bytes]) -> None:
        """What is to be done with new words."""

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts, words of each text); new words get the next numbers."""
        words, at, sizes = words_of(texts)
        index, known = self.index, len(self.index)
        own = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(own < 0)
        if b"" in words:
            new = new[new != words.index(b"")]
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            own[new] = np.arange(known, known + len(fresh))
            index.update(zip(fresh, range(known, known + len(fresh))))
            self.meet(fresh)
        return own[at], sizes


class Pieces(Words):
    """Numbers of words, their lengths in bytes and their subword ids."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.flat, self.first, self.count, self.length = np.zeros(0, np.int32), *np.zeros((3, 0), np.int64)

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, first index and count of each word's ids)."""
        made = self.model.encode([w.decode() for w in words], num_threads=1) if words else []
        count = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter(chain.from_iterable(made), np.int32, int(count.sum()))
        return flat, np.cumsum(count) - count, count

    def meet(self, words: list[bytes]) -> None:
        flat, first, count = self.cut(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.first, self.flat = np.concatenate([self.first, first + len(self.flat)]), np.concatenate([self.flat, flat])
        self.count, self.length = np.concatenate([self.count, count]), np.concatenate([self.length, length])

    def ids(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(subword ids of all words, ids of each text)."""
        count = self.count[numbers]
        done = np.concatenate([[0], np.cumsum(count)])
        return gathered(self.flat, self.first[numbers], count), np.diff(done[np.concatenate([[0], np.cumsum(sizes)])])


def gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` one after the other."""
    before = np.cumsum(count) - count
    return flat[np.repeat(first - before, count) + np.arange(int(count.sum()))] if len(count) else flat[:0]


def _vocabulary(path: str) -> tuple[bytes, int, np.ndarray]:
    """(the model file's contents, number of pieces, which tokens begin a word or end a text)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    begins = [model.id_to_piece(i).startswith("▁") for i in range(model.get_piece_size())]
    return model.serialized_model_proto(), len(begins), np.array([*begins, True])


def _code(end: int) -> tuple[type, int]:
    """(the type of stored ids, the bit that is set in a word's first id)."""
    return (np.uint16, 1 << 15) if end < 1 << 15 else (np.uint32, 1 << 31)


_ENCODED = [T.StructField(n, t) for n, t in (("ids", T.BinaryType()), ("inputs", T.BinaryType()), ("targets", T.BinaryType()), ("word", T.StringType()), ("n", T.LongType()), ("piece", T.IntegerType()))]


def encoded(docs: DataFrame, proto, end: int, spacing: int = SPACING) -> DataFrame:
    """Rows (doc_id, text, learns, ids) of all documents and, from those that are learnt from, rows (inputs, targets),
    the windows at each beginning and one every ``spacing`` bytes of words, and rows (word, n, first piece), where the
    null word without a piece is the end mark. What isn't named is null."""
    code, begins_word = _code(end)
    docs = docs.select("doc_id", "text", (fold(FOLDS) != HELD_OUT).alias("learns"))
    schema = T.StructType([*docs.schema.fields, *_ENCODED])
    arrow, kept = to_arrow_schema(schema), docs.columns

    def rows(many: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(many, f.type) for f in arrow], names=arrow.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, ends = Pieces(proto.value), np.zeros(0, np.int64), 0

        def counted() -> pa.RecordBatch:
            some = np.flatnonzero(counts)
            words = pa.array(list(known.index), pa.binary()).cast(pa.string()).take(pa.array(some))
            return rows(len(some), word=words, n=pa.array(counts[some]), piece=pa.array(known.flat[known.first[some]], pa.int32()))

        for batch in batches:
            for part in pieces(batch, "text", _PIECE_BYTES):
                numbers, words = known.numbers(part.column("text"))
                flat, sizes = known.ids(numbers, words)
                many = known.count[numbers]
                first = np.cumsum(many) - many
                codes = flat.astype(code)
                codes[first] |= code(begins_word)
                yield rows(part.num_rows, **{n: part.column(n) for n in kept}, ids=_binary(codes, sizes))
                learns = part.column("learns").to_numpy(zero_copy_only=False).astype(bool)
                ends += int(learns.sum())
                counts = np.concatenate([counts, np.zeros(len(known.index) - len(counts), np.int64)]) + np.bincount(numbers[np.repeat(learns, words)], minlength=len(known.index))
                text, at, opening = _starts(known.length[numbers] + 1, words, first, sizes, spacing)
                own = np.flatnonzero(learns[text])
                text, at, opening = text[own], at[own], opening[own]
                left = np.cumsum(sizes)[text] - at
                taken = np.minimum(left, LENGTH + 1)
                inputs, targets = _first_windows(gathered(flat, at, taken), taken, opening, taken == left, end)
                yield rows(len(inputs), inputs=_binary(inputs), targets=_binary(targets))
                if len(counts) > _MOST_WORDS:
                    yield counted()
                    known.forget()
                    counts = counts[:0]
        yield counted()
        if ends:
            yield rows(1, n=pa.array([ends], pa.int64()))

    return docs.mapInArrow(run, schema)


def _starts(lengths: np.ndarray, words: np.ndarray, first: np.ndarray, sizes: np.ndarray, spacing: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, index of the first id, whether it begins the text) of the windows to start from.

    ``lengths`` and ``first`` are of words, ``words`` and ``sizes`` the words and ids of each text.
    """
    done = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(words)), words)
    begin = np.cumsum(words) - words
    place = (done - done[begin[text]]) // spacing
    at = np.flatnonzero((place[1:] != place[:-1]) & (text[1:] == text[:-1])) + 1
    opening = np.arange(len(words) + len(at)) < len(words)
    return np.concatenate([np.arange(len(words)), text[at]]), np.concatenate([np.cumsum(sizes) - sizes, first[at]]), opening


def _ids(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ids of each text, whether an id begins a word) of a column that ``encoded`` made."""
    code, begins_word = _code(end)
    data, off = text_bytes(column)
    codes = data.view(code)
    return (codes & code(begins_word - 1)).astype(np.int32), np.diff(off) // codes.itemsize, codes >= begins_word


def training_windows(docs: DataFrame, proto, end: int, spacing: int = SPACING) -> DataFrame:
    """Windows (inputs, targets) of all training texts: at each beginning, and one every ``spacing`` bytes."""
    made = docs if "ids" in docs.columns else encoded(docs, proto, end, spacing)
    return made.where("inputs is not null").select("inputs", "targets")


def _first_windows(flat: np.ndarray, sizes: np.ndarray, opening: np.ndarray, whole: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, targets) of the first window of each excerpt; an opening has the start mark before it, a whole rest the end after it."""
    context = LENGTH - STRIDE
    rows = np.full((len(sizes), LENGTH + 1), -1, np.int32)
    start = np.where(opening, context + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes - start, sizes)
    fits = column <= LENGTH
    rows[owner[fits], column[fits]] = flat[fits]
    rows[opening, context] = end
    closed = np.flatnonzero(whole & (start + sizes <= LENGTH))
    rows[closed, (start + sizes)[closed]] = end
    targets, inputs = rows[:, context + 1 :], rows[:, :LENGTH].copy()
    inputs[:, context:][targets < 0] = -1
    some = targets[:, 0] >= 0
    return inputs[some], np.ascontiguousarray(targets[some])


def _binary(rows: np.ndarray, sizes: np.ndarray | None = None) -> pa.Array:
    """Each row, or the next ``sizes`` values, as bytes."""
    done = np.arange(len(rows) + 1) * rows.shape[1] if sizes is None else np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.binary(), len(done) - 1, [None, pa.py_buffer((done * rows.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _arrays(inputs: list[bytes], targets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(inputs), np.int32).reshape(-1, LENGTH), np.frombuffer(b"".join(targets), np.int32).reshape(-1, STRIDE)


def averaged(made: DataFrame, end: int, model: AttentionModel, counts: np.ndarray, rate: float) -> tuple[AttentionModel, np.ndarray]:
    """The model and its expected counts after each task has trained a copy on every window of its training texts.

    ``made`` has the rows of ``encoded``."""
    payload = made.sparkSession.sparkContext.broadcast((model, counts))
    names = [f"p{k}" for k in range(model.row_width)]
    mixes = [f"m{k}" for k in range(model.mixes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = copy.deepcopy(payload.value)  # the worker's next task gets the same value
        steps = 0
        uses, seen = np.zeros(len(model.rows()), np.int64), np.zeros(model.vocabulary, np.int64)
        for batch in batches:
            for part in pieces(batch, "ids", _ID_BYTES):
                flat, sizes, _ = _ids(part.column("ids"), end)
                inputs, targets, _ = windows(flat, sizes, end)
                n = -(-len(inputs) // 512)
                model.learn(inputs, targets, counts, n, rate=rate, last_rate=0.5 * rate, memory=64.0 + 0.25 * steps)
                steps += n
                uses += model.row_uses(inputs)
                seen += np.bincount(targets[targets >= 0], minlength=model.vocabulary)
        if not steps:
            return
        # The running responsibilities of the tokens met, in proportion to how many they were.
        total = np.where(seen[:, None] > 0, counts, np.float32(0))
        total *= np.float32(seen.sum() / total.sum())
        rows = model.rows()
        total = np.concatenate([total, np.zeros((len(rows) - len(total), model.mixes), np.float32)])
        some = np.flatnonzero((uses > 0) | total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(uses[some]), *(pa.array(rows[some, k]) for k in range(model.row_width)), *(pa.array(total[some, k]) for k in range(model.mixes))], names=["row", "uses", *names, *mixes]
        )

    copies = made.where("learns").select("ids").mapInArrow(run, "row long, uses long, " + ", ".join(f"{n} float" for n in (*names, *mixes)))
    sums = copies.groupBy("row").agg(F.sum("uses").alias("uses"), *(F.sum(F.col(n).cast("double") * F.col("uses")).alias(n) for n in names), *(F.sum(F.col(n).cast("double")).alias(n) for n in mixes))
    table = sums.toArrow()
    payload.unpersist()
    at, uses = table.column("row").to_numpy(), table.column("uses").to_numpy()
    rows, total = model.rows(), np.zeros((model.vocabulary, model.mixes))
    used = uses > 0
    rows[at[used]] = np.stack([table.column(n).to_numpy()[used] / uses[used] for n in names], axis=1)
    token = at < model.vocabulary
    total[at[token]] = np.stack([table.column(n).to_numpy()[token] for n in mixes], axis=1)
    model.take_rows(rows)
    if total.any():
        counts = (total * (counts.sum() / total.sum())).astype(np.float32)
        model.settle(total)
    return model, counts


def trained(docs: DataFrame, proto, end: int, starters: int = STARTERS, rounds: int = ROUNDS) -> AttentionModel:
    """The attention weights: started on some windows, then learnt from every window of every training text.

    ``docs`` are documents or the rows of ``encoded``, as for ``learnt``.
    """
    model = AttentionModel(end + 1)
    made = _encoded(docs, proto, end)
    given = training_windows(made, proto, end)
    n = given.count()
    some = F.pmod(F.xxhash64("inputs", "targets"), F.lit(max(1, n))) < starters
    first = sorted(zip(*(given.where(some).toArrow().to_pydict().values())))
    if first:
        inputs, targets = _arrays([i for i, _ in first], [t for _, t in first])
        counts = model.begin(targets)
        model.learn(inputs, targets, counts, min(STEPS, len(inputs) // 16 + 160), rate=0.3, last_rate=0.05)
        for k in range(rounds):
            model, counts = averaged(made, end, model, counts, 0.1 / (k + 1))
    return model


def _encoded(docs: DataFrame, proto, end: int) -> DataFrame:
    return docs if "ids" in docs.columns else stored(encoded(docs, proto, end), "encoded")


_LEARNT = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("shares", T.ArrayType(T.FloatType()))])


def learnt(docs: DataFrame, model: AttentionModel, proto, end: int) -> DataFrame:
    """From all training texts: rows (word, n, first piece), the end mark as the null word without
    a piece, and rows (piece, shares): how often each output distribution emitted it."""
    made = _encoded(docs, proto, end)
    payload = made.sparkSession.sparkContext.broadcast(model.scoring_only())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Reader(payload.value)
        total = np.zeros(model.emitted.shape)
        for batch in batches:
            for part in pieces(batch, "ids", _ID_BYTES):
                flat, sizes, _ = _ids(part.column("ids"), end)
                inputs, targets, _ = windows(flat, sizes, end)
                model.tally(inputs, targets, total)
        some = np.flatnonzero(total.any(axis=1))
        offsets = pa.array((np.arange(len(some) + 1) * model.mixes).astype(np.int32))
        shares = pa.ListArray.from_arrays(offsets, pa.array(total[some].astype(np.float32).ravel()))
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.string()), pa.nulls(len(some), pa.int64()), pa.array(some.astype(np.int32)), shares], names=_LEARNT.names)

    counts = made.where("n is not null").select("word", "n", "piece", F.lit(None).cast(_LEARNT["shares"].dataType).alias("shares"))
    return counts.union(made.where("learns").select("ids").mapInArrow(run, _LEARNT))


def settled(rows: DataFrame, model: AttentionModel) -> AttentionModel:
    """``model`` with the output distributions of ``learnt``'s rows (one row a piece reaches the driver)."""
    sums = rows.where("shares is not null").groupBy("piece").agg(*(F.sum(F.col("shares")[k].cast("double")).alias(f"m{k}") for k in range(model.mixes))).toArrow()
    if sums.num_rows:
        total = np.zeros((model.vocabulary, model.mixes))
        total[sums.column("piece").to_numpy()] = np.stack([sums.column(f"m{k}").to_numpy() for k in range(model.mixes)], axis=1)
        model.settle(total)
    return model.scoring_only()


def most_frequent(counts: DataFrame, most: int) -> pa.Table:
    """(word, n and what else ``counts`` has) of at most ``most`` words: all that are as frequent as some power of 2 ** (1 / 16).

    A histogram of some hundred rows finds the power, so no task meets more than its own words.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    taken, least = 0, 1 << 20
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if taken + r["count"] > most:
            break
        taken, least = taken + r["count"], r["step"]
    return counts.where(step >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])


_RARE = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("spelled", T.FloatType()), T.StructField("listed", T.FloatType())]))
_FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("known_here", T.LongType()), T.StructField("base_here", T.DoubleType()), T.StructField("score_here", T.DoubleType()), T.StructField("rare", _RARE)]


class Scorer:
    """Scores batches of texts; occurrences of words that aren't frequent are left open.

    An open one has the log10 of its spelled probability, and of what each of its training
    occurrences adds to that.
    """

    def __init__(self, end: int, begins: np.ndarray, model: AttentionModel, words: list[bytes], seen: np.ndarray, piece: np.ndarray, ends: int, total: int, distinct: int, lexicon: np.ndarray) -> None:
        self.model, self.end, self.words = Reader(model), end, Words(words)
        self.frequent = len(words)
        n, d = lexicon
        # A first piece without words: all of the mass is spelled.
        self.spelled_share = np.log10(np.where(d > 0, d / np.maximum(1, n + d), 1.0))
        self.one = -np.log10(np.maximum(1, n + d))
        self.starts = model.mass(begins)
        # Of each frequent word, then of the end mark and of any other word, which counts later.
        self.listed = seen / np.maximum(1, n + d)[piece]
        self.known = np.concatenate([np.ones(len(words)), [float(ends > 0), 0.0]])
        self.base = np.concatenate([np.log10(np.append(seen, ends) + 1.0) - math.log10(total + distinct + 1), [0.0]])

    def __call__(self, texts: pa.Array, ids: pa.Array) -> list:
        frequent, words = self.frequent, self.words
        if len(words.index) > frequent + _MOST_WORDS // 2:
            words.forget()
        numbers, of_text = words.numbers(texts)
        flat, sizes, begins_word = _ids(ids, self.end)
        inputs, targets, _ = windows(flat, sizes, self.end)
        logs, starting = self.model.each_log10(inputs, targets, self.starts)
        del inputs, targets
        # One row a token: the words of each text, then its end.
        n = of_text + 1
        is_word = np.ones(len(numbers) + len(n), bool)
        is_word[np.cumsum(n) - 1] = False
        row = np.full(len(is_word), frequent)
        row[is_word] = np.minimum(numbers, frequent + 1) + (numbers == frequent)
        begin = np.flatnonzero(np.insert(begins_word, np.cumsum(sizes), True))
        piece = np.full(len(is_word), self.end)
        piece[is_word] = flat[begins_word]
        head = logs[begin].astype(float) - starting[begin]
        tail = np.add.reduceat(logs, begin, dtype=float) - logs[begin] + np.append(starting[begin[1:]], 0.0)
        spelled = np.where(is_word, tail + self.spelled_share[piece], 0.0)
        score = head + spelled
        common = np.flatnonzero(row < frequent)
        score[common] = head[common] + np.log10(np.power(10.0, spelled[common]) + self.listed[row[common]])
        owner = np.repeat(np.arange(len(n)), n)
        open_at = np.flatnonzero(row > frequent)
        score_here = np.bincount(owner, np.where(row > frequent, 0.0, score), minlength=len(n))
        rare = list(islice(words.index, frequent, None))
        names = pa.array(rare, pa.binary()).cast(pa.string()).take(pa.array(numbers[numbers >= frequent] - frequent)) if rare else pa.array([], pa.string())
        values = pa.StructArray.from_arrays([names, pa.array(score[open_at].astype(np.float32)), pa.array((head[open_at] + self.one[piece[open_at]]).astype(np.float32))], names=["word", "spelled", "listed"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[open_at], minlength=len(n)))]).astype(np.int32)
        return [n, np.bincount(owner, self.known[row], minlength=len(n)).astype(np.int64), np.bincount(owner, self.base[row], minlength=len(n)), score_here, pa.ListArray.from_arrays(pa.array(offsets), values)]


def scored(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    contents, end, begins = _vocabulary(model)
    proto = spark.sparkContext.broadcast(contents)
    docs = stored(encoded(docs, proto, end), "encoded")
    attention = trained(docs, proto, end)
    attention = settled(learnt(docs, attention, proto, end), attention)
    counts = stored(docs.where("n is not null").groupBy("word").agg(F.sum("n").alias("n"), F.max("piece").alias("piece")), "word-counts")
    is_word = F.col("word").isNotNull()
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(~is_word, F.col("n"))), F.lit(0))).first()
    by_piece = np.zeros((2, end + 1), np.int64)
    for r in counts.where(is_word).groupBy("piece").agg(F.sum("n").alias("n"), F.count("*").alias("d")).toLocalIterator():  # one row a piece at most
        by_piece[:, r["piece"]] = r["n"], r["d"]
    top = most_frequent(counts.where(is_word), frequent)
    words = [w.encode() for w in top.column("word").to_pylist()]
    payload = spark.sparkContext.broadcast((end, begins, attention, words, top.column("n").to_numpy(), top.column("piece").to_numpy(), ends, total, distinct, by_piece))
    given = docs.where("ids is not null").select("doc_id", "text", "ids")
    schema = T.StructType([given.schema["doc_id"], *_FIELDS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*payload.value)
        for batch in batches:
            for part in pieces(batch, "text", _PIECE_BYTES):
                values = score(part.column("text"), part.column("ids"))
                columns = [v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=arrow.names)

    made = stored(given.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    discard(docs)

    low = math.log10(total + distinct + 1)
    word = made.select("row", F.explode("rare").alias("w")).select("row", "w.*")
    n = F.coalesce("n", F.lit(0))
    spelled = F.col("spelled").cast("double")
    whole = F.when(n == 0, spelled).otherwise(F.log10(F.pow(F.lit(10.0), spelled) + n * F.pow(F.lit(10.0), F.col("listed").cast("double"))))
    met = word.join(counts.select("word", "n").hint("shuffle_hash"), "word", "left")
    sums = met.groupBy("row").agg(F.sum((n > 0).cast("long")).alias("k"), F.sum(F.log10(n + 1.0) - low).alias("b"), F.sum(whole).alias("s"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return made.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        (fold(FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("known_here") + zero("k")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_here") + zero("b")).alias("base_score"),
        (F.col("score_here") + zero("s")).alias("score"),
    )
