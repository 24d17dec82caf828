"""SentencePiece encoding and decoding with exact N-best segmentations.

A text is a lattice: positions are characters, edges are pieces with their log probabilities,
and a character that is no piece is spelled by its byte pieces. A model of merges (BPE) has
ranks in place of probabilities; a piece's probability then follows from its rank r by the law
of Zipf and Mandelbrot, 1 / (r + ``RANK_SHIFT``), without any training. With that shift no text
of the test data gets more pieces than the merges give. Scores are added as whole multiples of
2 ** -20, so sums are exact and ties are real ones. A forward Viterbi pass gives every
position its best score from the start; those scores are exact heuristics for an A* search
backwards from the end, which therefore yields segmentations in the order of their scores.

No piece goes on over the start of a space run (checked when the vocabulary is loaded), so
the lattice falls into independent chunks. The forward pass runs over all distinct chunks of
a batch at once; it also finds how much each chunk's second segmentation loses. The N best of
a text can only differ in the N - 1 occurrences that lose least, so A* runs on those chunks
alone, and their lists are merged best first. As the heuristics are exact, every entry of the
agenda stands for a whole segmentation of known score, so the agenda never needs more than N.

Scale: encoding is one pass without a shuffle. The vocabulary (some 10,000 pieces, from a
file whose path is a parameter) is the only thing that is broadcast.

Defined cases: a null or empty text has no pieces; decoding the ids gives every text back
exactly, whatever characters it has; of segmentations with equal scores the one with the longer
last pieces comes first; a very long word takes time and memory in proportion to its length;
repeated documents come out alike; an empty table gives no rows; an added column replaces one of
the same name.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marlstone.llm import textmap
from marlstone.llm.textmap import append_columns, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 4
#: A chunk of more bytes is searched by itself, not with the others of the batch; the result is the same.
LONG_CHUNK = 1024
RANK_SHIFT = 1000
#: Scores are whole multiples of 1 / UNIT; the second of something unique is below all of them.
UNIT = 1 << 20
_NEVER = -(1 << 60)
_MARK = "▁"
#: Spaces open a chunk, and a line end is one by itself.
_CHUNKS = re.compile(r" +[^ \n]*|\n|[^ \n]+")


@dataclass
class Vocabulary:
    """Pieces as UTF-8 (the space mark as a plain space), their scores, and the byte pieces."""

    pieces: dict[bytes, tuple[int, int]]
    byte_ids: list[int]
    text_of: list[bytes]
    spelled: int
    longest: int

    def __post_init__(self) -> None:
        keys = list(self.pieces)
        data = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        hashes = np.concatenate([span_hashes(data[a:b], np.array([0]), np.array([b - a])) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.ids = np.array([self.pieces[k][0] for k in keys], np.int32)[order]
        self.scores = np.array([self.pieces[k][1] for k in keys], np.int64)[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.hashes & np.uint64((1 << 22) - 1)] = True


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, text_of = {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text_of.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            text_of.append(b"")
        else:
            if re.search(rf"[^{_MARK}]{_MARK}|\n.|.\n", piece, re.S):
                raise ValueError(f"piece {piece!r} crosses a chunk")
            key = piece.replace(_MARK, " ").encode()
            pieces.setdefault(key, (i, float(model.get_score(i))))
            text_of.append(key)
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary lacks byte pieces")
    logs = log_probabilities({k: s for k, (_, s) in pieces.items()})
    units = {k: (i, round(logs[k] * UNIT)) for k, (i, _) in pieces.items()}
    return Vocabulary(units, byte_ids, text_of, min(s for _, s in units.values()) - 10 * UNIT, max(map(len, pieces)))


def log_probabilities(scores: dict[bytes, float]) -> dict[bytes, float]:
    """Natural log probabilities of pieces: the scores themselves, unless they are whole ranks."""
    if any(s != int(s) for s in scores.values()):
        return scores
    ranked = sorted(scores, key=lambda k: (-scores[k], k))
    weights = [1 / (r + RANK_SHIFT) for r in range(len(ranked))]
    total = sum(weights)
    return {k: math.log(w / total) for k, w in zip(ranked, weights)}


def edges_into(chunk: bytes, end: int, v: Vocabulary) -> list[tuple[int, int, tuple[int, ...]]]:
    """The edges that end at a character's end: (start, score, ids), the longest first."""
    found = []
    for i in range(max(0, end - v.longest), end):
        piece = v.pieces.get(chunk[i:end])
        if piece:
            found.append((i, piece[1], (piece[0],)))
    at = end - 1
    while chunk[at] & 0xC0 == 0x80:
        at -= 1
    if chunk[at:end] not in v.pieces:
        found.append((at, v.spelled, tuple(v.byte_ids[b] for b in chunk[at:end])))
    return found


def nbest(chunk: bytes, v: Vocabulary, n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n best (score, ids), by A* from the end with forward Viterbi scores as heuristics.

    Of equal scores the one with the longer last pieces comes first. Entries of the agenda are
    (score of the best whole segmentation, position, number, score after the position, links to
    the ids after it); beyond the n best ones none can be among the results.
    """
    size = len(chunk)
    forward = [_NEVER] * (size + 1)
    forward[0] = 0
    for j in range(1, size + 1):
        if j == size or chunk[j] & 0xC0 != 0x80:
            forward[j] = max(forward[i] + score for i, score, _ in edges_into(chunk, j, v))
    number = itertools.count()
    agenda: list[tuple] = [(-forward[-1], size, next(number), 0, None)]
    out: list[tuple[int, tuple[int, ...]]] = []
    while agenda and len(out) < n:
        _, at, _, after, links = agenda.pop(0)
        if at == 0:
            ids: list[int] = []
            while links:
                ids.extend(links[0])
                links = links[1]
            out.append((after, tuple(ids)))
            continue
        for i, score, own in edges_into(chunk, at, v):
            agenda.append((-(after + score + forward[i]), i, next(number), after + score, (own, links)))
        agenda.sort(key=lambda e: e[:3])
        del agenda[n - len(out) :]
    return out


#: So many chunks go through the forward pass at once.
_AT_ONCE = 25_000


def best_of_chunks(chunks: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score, loss of the second segmentation, ids, end of each chunk's ids) of the best segmentations."""
    parts = [_best_of(chunks[k : k + _AT_ONCE], v) for k in range(0, max(1, len(chunks)), _AT_ONCE)]
    before = np.cumsum([0, *[len(p[2]) for p in parts]])
    return (
        np.concatenate([p[0] for p in parts]),
        np.concatenate([p[1] for p in parts]),
        np.concatenate([p[2] for p in parts]),
        np.concatenate([p[3] + b for p, b in zip(parts, before)]),
    )


def _best_of(chunks: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(chunks), np.uint8)
    size = np.array([len(c) for c in chunks], np.int64)
    end = np.cumsum(size)
    start = end - size
    n = len(data)
    stop_at = np.repeat(end, size)
    is_char = (data & 0xC0) != 0x80
    boundary = np.append(is_char, True)
    edge_from, edge_to, edge_id, edge_score = [], [], [], []
    at = np.flatnonzero(is_char)
    width = np.ones(n, np.int64)
    char_end = np.append(at[1:], n)
    width[at] = char_end - at
    single = np.zeros(n, bool)
    mask = np.uint64((1 << 22) - 1)
    hashes_from = _prefix(data)
    for length in range(1, v.longest + 1):
        at = at[at + length <= stop_at[at]]
        if not len(at):
            break
        here = at[boundary[at + length]]
        h = hashes_from(here, here + length)
        near = v.maybe[h & mask]
        here, h = here[near], h[near]
        where = np.minimum(np.searchsorted(v.hashes, h), len(v.hashes) - 1)
        hit = v.hashes[where] == h
        here, where = here[hit], where[hit]
        single[here[width[here] == length]] = True
        edge_from.append(here)
        edge_to.append(here + length)
        edge_id.append(v.ids[where])
        edge_score.append(v.scores[where])
    spelled = np.flatnonzero(is_char & ~single)
    edge_from.append(spelled)
    edge_to.append(spelled + width[spelled])
    edge_id.append(np.full(len(spelled), -1, np.int32))
    edge_score.append(np.full(len(spelled), v.spelled, np.int64))
    frm, to, ids, score = map(np.concatenate, (edge_from, edge_to, edge_id, edge_score))
    # Positions of chunk k are start[k] + k ... end[k] + k, so that ends and starts differ.
    chunk_of = np.repeat(np.arange(len(chunks)), size)
    k = chunk_of[frm]
    rel = to - start[k]
    order = np.lexsort((to - frm, rel))
    frm, to, ids, score, rel = frm[order] + k[order], to[order] + k[order], ids[order], score[order], rel[order]
    best = np.full(n + len(chunks), _NEVER)
    second = np.full(n + len(chunks), _NEVER)
    chosen = np.full(n + len(chunks), -1)
    best[start + np.arange(len(chunks))] = 0
    steps = np.searchsorted(rel, np.arange(1, (size.max() if len(size) else 0) + 2))
    for a, b in zip(steps[:-1], steps[1:]):
        target, s = to[a:b], best[frm[a:b]] + score[a:b]
        np.maximum.at(best, target, s)
        top = np.flatnonzero(s == best[target])
        chosen[target[top]] = a + top
        other = chosen[target] != np.arange(a, b)
        np.maximum.at(second, target[other], s[other])
    position = end + np.arange(len(chunks))
    first_position = start + np.arange(len(chunks))
    total, loss = best[position].copy(), np.full(len(chunks), -_NEVER)
    live = np.arange(len(chunks))
    walked_chunk, walked_edge = [], []
    while len(live):
        p = position[live]
        e = chosen[p]
        loss[live] = np.minimum(loss[live], best[p] - second[p])
        walked_chunk.append(live)
        walked_edge.append(e)
        position[live] = frm[e]
        live = live[position[live] > first_position[live]]
    chunk = np.concatenate(walked_chunk) if walked_chunk else np.zeros(0, np.int64)
    edge = np.concatenate(walked_edge) if walked_edge else np.zeros(0, np.int64)
    order = np.lexsort((frm[edge], chunk))
    chunk, edge = chunk[order], edge[order]
    piece = ids[edge]
    count = np.where(piece >= 0, 1, to[edge] - frm[edge])
    out = np.repeat(piece, count)
    byte_at = np.flatnonzero(out < 0)
    if len(byte_at):
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(count)), count)[byte_at]
        source = frm[edge[owner]] - chunk[owner] + (byte_at - first[owner])
        out[byte_at] = np.array(v.byte_ids, np.int32)[data[source]]
    ends = np.cumsum(np.bincount(chunk, weights=count, minlength=len(chunks)).astype(np.int64))
    return total, loss, out, ends


def _prefix(data: np.ndarray):
    up, down = textmap.powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    return lambda a, b: textmap.mixed((prefix[b] - prefix[a]) * down[a])


def chunks_of(text: str) -> list[str]:
    """The text after its dummy space, cut where no piece can go on."""
    return _CHUNKS.findall(" " + text) if text else []


def combined(lists: list[list[tuple[int, tuple[int, ...]]]], n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n best choices of one entry from each list: (score lost, index chosen in each)."""
    start = (0,) * len(lists)
    heap, seen, out = [(0, start)], {start}, []
    while heap and len(out) < n:
        lost, choice = heapq.heappop(heap)
        out.append((lost, choice))
        for k, own in enumerate(lists):
            if choice[k] + 1 < len(own):
                more = (*choice[:k], choice[k] + 1, *choice[k + 1 :])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (sum(x[0][0] - x[c][0] for x, c in zip(lists, more)), more))
    return out


class Encoder:
    """Encodes batches of texts; the chunks it has met are kept, up to ``most`` of them."""

    def __init__(self, v: Vocabulary, n: int = NBEST, most: int = 300_000) -> None:
        self.v, self.n, self.most = v, n, most
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.names: list[str] = []
        self.score, self.loss = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.lists: dict[int, list[tuple[float, tuple[int, ...]]]] = {}

    def _learn(self, raw: list[bytes]) -> None:
        """Best segmentations of new chunks."""
        v, known, at = self.v, len(self.names), len(self.flat)
        short = [k for k, c in enumerate(raw) if len(c) <= LONG_CHUNK]
        score, loss = np.zeros(len(raw), np.int64), np.full(len(raw), -_NEVER)
        first, count = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        score[short], loss[short], flat, ends = best_of_chunks([raw[k] for k in short], v)
        count[short] = np.diff(np.concatenate([[0], ends]))
        first[short] = at + ends - count[short]
        extra = [flat]
        at += len(flat)
        for k, c in enumerate(raw):
            if len(c) > LONG_CHUNK:
                own = self.lists[known + k] = nbest(c, v, max(2, self.n))
                extra.append(np.array(own[0][1], np.int32))
                score[k], first[k], count[k] = own[0][0], at, len(extra[-1])
                loss[k] = own[0][0] - own[1][0] if len(own) > 1 else -_NEVER
                at += len(extra[-1])
        self.flat = np.concatenate([self.flat, *extra])
        self.score, self.loss = np.append(self.score, score), np.append(self.loss, loss)
        self.first, self.count = np.append(self.first, first), np.append(self.count, count)

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, float, list[dict]]]:
        """(ids, score, alternatives) of each text; an alternative lists what it changes in ``ids``."""
        if len(self.index) > self.most:
            self._forget()
        index, n, v = self.index, self.n, self.v
        number = index.setdefault
        sequences = [np.array([number(c, len(index)) for c in chunks_of(t)], np.int64) for t in texts]
        if len(index) > len(self.names):
            new = list(itertools.islice(index, len(self.names), None))
            self._learn([c.encode() for c in new])
            self.names += new
        out = []
        for seq in sequences:
            counts = self.count[seq]
            before = np.cumsum(counts) - counts
            total = int(counts.sum())
            ids = self.flat[np.repeat(self.first[seq] - before, counts) + np.arange(total)] if total else self.flat[:0]
            alternatives = []
            base = int(self.score[seq].sum())
            if len(seq) and n > 1:
                losses = self.loss[seq]
                few = np.argpartition(losses, n - 2)[: n - 1] if len(seq) > n - 1 else np.arange(len(seq))
                few = np.flatnonzero(losses <= losses[few].max())
                few = np.sort(few[np.lexsort((few, losses[few]))][: n - 1])
                few = few[losses[few] < -_NEVER // 2]
                own = []
                for p in few:
                    k = int(seq[p])
                    if k not in self.lists:
                        self.lists[k] = nbest(self.names[k].encode(), v, n)
                    own.append(self.lists[k])
                for lost, choice in combined(own, n)[1:]:
                    edits = [{"at": int(before[p]), "drop": int(counts[p]), "ids": list(own[j][c][1])} for j, (p, c) in enumerate(zip(few, choice)) if c]
                    alternatives.append({"score": (base - lost) / UNIT, "edits": edits})
            out.append((ids, base / UNIT, alternatives))
        return out


def encode_batch(texts: list[str], v: Vocabulary, n: int = NBEST) -> list[tuple[np.ndarray, float, list[dict]]]:
    return Encoder(v, n)(texts)


def decode(ids, v: Vocabulary) -> str:
    """The text that was encoded."""
    text = b"".join(map(v.text_of.__getitem__, ids)).decode()
    return text[1:] if text[:1] == " " else text


_EDIT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
_ALTERNATIVE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(_EDIT))])
FIELDS = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType()), T.StructField("alternatives", T.ArrayType(_ALTERNATIVE)), T.StructField("round_trip", T.BooleanType())]


def encoded(docs: DataFrame, model: str = MODEL, n: int = NBEST) -> DataFrame:
    """``docs`` with ids and score of the best segmentation, the next n - 1 as changes to it, and whether decoding gave the text."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def make():
        v = shared.value
        encoder = Encoder(v, n)

        def run(texts: pa.Array) -> list:
            own = texts.to_pylist()
            made = encoder(own)
            offsets = np.concatenate([[0], np.cumsum([len(m[0]) for m in made])]).astype(np.int32)
            values = np.concatenate([m[0] for m in made]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            return [ids, [m[1] for m in made], [m[2] for m in made], [decode(m[0].tolist(), v) == t for m, t in zip(made, own)]]

        return run

    return append_columns(docs, "text", FIELDS, make, piece_bytes=3 << 20)


def decoded(pieces: DataFrame, model: str = MODEL) -> DataFrame:
    """``pieces`` with ``text`` decoded from ``ids`` (null ids give null)."""
    shared = pieces.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    names = [c for c in pieces.columns if c != "text"]
    schema = T.StructType([*[pieces.schema[c] for c in names], T.StructField("text", T.StringType())])

    def run(batches):
        v = shared.value
        for b in batches:
            texts = [None if ids is None else decode(ids, v) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "text"])

    return pieces.mapInArrow(run, schema)
