"""Packing, conversation repair and fill-in-the-middle against plain versions of their definitions."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from fixtures import prose
from marlstone.llm import conversations, fill_in_middle, packing, packing_plan, role_trie
from pyspark.sql import functions as F

# --- packing


def placed(runs):
    """(sequence, offset, length, rank) of every piece that a plan places."""
    out = []
    for length, low, high, sequence, each, offset in packing_plan.slots(runs):
        for rank in range(low, high):
            out.append((sequence + (rank - low) // each, offset + (rank - low) % each * length, length, rank))
    return out


def assert_whole(pieces, counts):
    ranks, rows = defaultdict(list), defaultdict(list)
    for sequence, offset, length, rank in pieces:
        ranks[length].append(rank)
        rows[sequence].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in enumerate(counts) if n}
    assert sorted(rows) == list(range(len(rows)))
    for own in rows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= len(counts) - 1
    return len(rows)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, [1, 3, 40][seed % 3] + 1, 65) * (rng.random(65) < 0.6)
    counts[0] = 0
    n = assert_whole(placed(packing_plan.plan(counts, 8, 16)), counts)
    assert n >= -(-int((counts * np.arange(65)).sum()) // 64)


def least_sequences(lengths, room):
    """The fewest sequences, by search over the rooms that are left."""
    lengths = sorted(lengths, reverse=True)

    @cache
    def search(at, rooms):
        if at == len(lengths):
            return 0
        ways = [1 + search(at + 1, tuple(sorted((*rooms, room - lengths[at]))))]
        for k, r in enumerate(rooms):
            if r >= lengths[at] and (k == 0 or rooms[k - 1] != r):
                ways.append(search(at + 1, tuple(sorted((*rooms[:k], r - lengths[at], *rooms[k + 1 :])))))
        return min(ways)

    return search(0, ())


def test_plan_is_near_the_least():
    rng = random.Random(3)
    for _ in range(40):
        lengths = [rng.randrange(2, 21) for _ in range(9)]
        counts = np.bincount(lengths, minlength=21)
        n = assert_whole(placed(packing_plan.plan(counts, 6, 5)), counts)
        assert n <= least_sequences(lengths, 20) + 1


def test_few_sizes_reach_the_bound_of_the_linear_programme():
    counts = np.zeros(1025, int)
    counts[600], counts[424], counts[512], counts[300] = 1000, 1000, 2000, 900
    assert assert_whole(placed(packing_plan.plan(counts, 256, 256)), counts) <= 2300 * 1.005  # pieces of two sizes that share a group count as the longer


def test_packed_documents_are_whole(spark, docs, no_docs):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    tokenizer.encode_special_tokens = True
    rows = packing.packed(docs).collect()
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[(r.doc_id, r.piece == 0)].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 > 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    want = sorted(tuple([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]) for d in docs.collect())
    # pieces of one text follow each other; only the long text has several
    short = [tuple(np.frombuffer(r.ids, "<u4")) for r in rows if sum(1 for o in rows if o.doc_id == r.doc_id and o.piece > 0) == 0]
    long = sorted((r for r in rows if r.doc_id == 4), key=lambda r: r.piece)
    assert [r.piece for r in long] == list(range(len(long))) and [r.start for r in long] == np.cumsum([0, *[r.length for r in long[:-1]]]).tolist()
    assert all(r.length == packing.LENGTH for r in long[1:]) and len(long) > 1
    assert sorted([*short, tuple(np.frombuffer(b"".join(r.ids for r in long), "<u4"))]) == want
    assert len(sequences) <= -(-sum(map(len, want)) // packing.LENGTH) + 1
    assert packing.packed(no_docs).count() == 0
    whole = packing.sequences(packing.packed(docs)).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(map(len, want)) and all(r.documents[0][0] == 0 for r in whole)


@pytest.mark.parametrize("text", ["", " ", "it's 12 o'clock\n\n  don't\t", "ÄÖ ü\x85x y", "日本語 \U0001f600 text", "<|endoftext|> <s></s>", "a" * 3000, "ʼn ǅ ² Ⅷ _x__y ...!?", "\x00\x1f\x7f", "x  y   z \r\n"])
def test_encoder_equals_the_tokenizer(text):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    tokenizer.encode_special_tokens = True
    assert np.frombuffer(packing.encoder(packing.MODEL)(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cut_lengths():
    assert packing.cut_lengths(5, 4) == [1, 4] and packing.cut_lengths(8, 4) == [4, 4] and packing.cut_lengths(4, 4) == [4] and packing.cut_lengths(1, 4) == [1]


# --- conversation repair

BLANK = " \t\n\x0b\x0c\r"


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(BLANK)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, lines) by a search from every place and state to the end."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(at, state, inserted):
        ways = []
        if at == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if at < len(rows):
            role, text = rows[at][2:]
            more = 5 if faults[at] == "truncated" else 0
            options = [(2, "D", state, None)]
            if faults[at] not in ("blank", "duplicate"):
                if (state, role[:1]) in step:
                    options.append((more, "K", step[state, role[:1]], f"{role}:{text}"))
                options += [(1 + more, "R", step[state, to[0]], f"{to}:{text}") for to in ("user", "assistant") if (state, to[0]) in step and role[:1] != to[0]]
            for cost, letter, to, line in options:
                c, a, lines = best(at + 1, to, 0)
                ways.append((cost + c, letter + a, (line, *lines) if line is not None else lines))
        if inserted < 3:
            for to in ("user", "assistant"):
                if (state, to[0]) in step:
                    c, a, lines = best(at, step[state, to[0]], inserted + 1)
                    ways.append((5 + c, "I" + a, (f"{to}:", *lines)))
        return min(ways, default=(1 << 40, "", ()))

    return best(0, "", 0)


def plain_audit(rows):
    """What every conversation's report should be, one conversation after the other."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(after_damage([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of(own)
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit, lines = cheapest(own, faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows():
    rng = random.Random(8)
    rows = []
    for conv in range(150):
        n = rng.randrange(0, 9)
        for turn in range(n):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \n", None, f"Is it {turn}?", "Yes. \t", "ends...", "é"])
            rows.append((conv, None if rng.random() < 0.08 else turn if rng.random() < 0.9 else turn + 2, role, text))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (900, 20, "user", "x" * 50_000 + "."), (900, 21, "assistant", "Fine.")]
    return rows


CONVERSATION = "conv_id long, turn int, role string, text string"


def test_conversations_equal_a_plain_search(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, CONVERSATION).withColumn("rid", F.lit("clash")).withColumn("index", F.lit(1)).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in conversations.audited(df).collect()}
    assert got == plain_audit(rows)
    assert conversations.audited(spark.createDataFrame([], CONVERSATION)).count() == 0


def test_long_conversation_spans_blocks(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Line {k % 7000}." if k % 11 else f"open {k}") for k in range(9000)] + [(2, 1, "user", "Hi.")]
    report, left = conversations.repaired(spark.createDataFrame(rows, CONVERSATION).repartition(4))
    one = {r.conv_id: r for r in report.collect()}
    faults = faults_of([r for r in rows if r[0] == 1])
    assert [one[1][k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    assert one[1].illegal == 0 and one[2].cost == 2
    kept = [r.role[0] for r in left.where("conv_id = 1").orderBy("row", "step").collect()]
    assert kept == ["u", "a"] * (len(kept) // 2) and len(one[1].audit) >= 9000


def test_trie_computes_shared_prefixes_once():
    rng = random.Random(5)
    signatures = sorted({"".join(rng.choice(role_trie.LETTERS) for _ in range(rng.randrange(0, 7))) for _ in range(400)})
    trie = role_trie.Trie()
    for s in signatures:
        alone = role_trie.Trie().insert(s)
        assert trie.insert(s) == alone
        roles = ["system", "user", "assistant", "tool"]
        rows = [(0, k, roles[role_trie.LETTERS.index(c) // 4], "") for k, c in enumerate(s)]
        faults = [("", "blank", "duplicate", "truncated")[role_trie.LETTERS.index(c) % 4] for c in s]
        assert (alone.cost, alone.audit) == cheapest(rows, faults)[:2], s
    assert trie.computed == len({s[: k + 1] for s in signatures for k in range(len(s))})  # one layer a node of the trie


# --- fill-in-the-middle


def test_rank_and_select_are_inverse():
    rng = random.Random(2)
    text = "".join(rng.choice("aé日\U0001f600 ") for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    marks = fill_in_middle.Boundaries(data)
    assert marks.select(np.arange(len(begins))).tolist() == begins.tolist() and marks.select(np.array([len(begins)])).tolist() == [len(data)]
    assert marks.rank(np.arange(len(data) + 1)).tolist() == [int((begins < k).sum()) for k in range(len(data) + 1)]


def plain_middle(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_outputs_equal_the_definition_and_restore(spark):
    rng = random.Random(6)
    odd = ["<P", ">", "<", "S>", "<M", "P>x", "<<P", "M>", "<P>", "a<S>b"]
    rows = [(k, "".join(rng.choice(["a", "é", "日", "\U0001f600", " ", "\n", *odd[:8]]) for _ in range(rng.randrange(0, 30)))) for k in range(400)]
    rows += [(1000 + k, t) for k, t in enumerate(odd)] + [(None, "null id"), (5000, None), (5001, prose(30_000, 1)), (5002, "x" * 1_000_000), (5001, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash")).repartition(3)
    got = fill_in_middle.transformed(df).withColumn("restored", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((i, *plain_middle(i, t), t or "") for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got), key=str) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_in_middle.transformed(df.limit(0)).count() == 0


def test_plain_words_are_not_translated_letter_by_letter(monkeypatch):
    """Words of visible ASCII skip the table of byte letters, which took a third of a new word's time."""

    class Counting(dict):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    texts = ["Plain words, of 7 bits!", " a\tb\n c\x7f\x00", "Äß x"]
    want = list(map(packing.encoder(packing.MODEL), texts))
    monkeypatch.setattr(packing, "_BYTE_LETTERS", Counting(packing._BYTE_LETTERS))
    encode = packing.encoder(packing.MODEL)
    assert encode(texts[0]) == want[0] and Counting.asked <= 1
    assert [encode(t) for t in texts] == want
