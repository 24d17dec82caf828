"""Sharding by a k-d tree over document metadata [DataFrame operations only].

The tree divides the corpus at weighted medians (weight: bytes) along the dimension that is
widest in the node, relative to its range in the corpus, until each leaf is one shard of the
target size. The law is ``bytes``: sizes come out nearly equal. Documents with equal texts
share a shard as long as their group is no larger than the largest document or a tenth of a
shard; a larger group is dealt out in parts of about that size, so that no group of copies,
however large, unbalances a shard.

Scale: one job a level makes the histograms of all dimensions of all nodes; another refines the
cells in which a median lies, where they are too heavy. Only histograms reach the driver,
``CELLS`` cells in all at once. Groups are summed before they are shuffled. Slots are numbered in two steps (a prefix sum over the pieces of the input, then
within a piece), so no shard is gathered in one task.

Defined cases: a null text has no bytes and counts as the empty text; a null metadata value
sorts first; metadata is compared by the six bytes after the beginning that all values share;
repeated documents are placed each for itself; a very long text is one atom, whatever its size;
names of other columns can't clash, as only its own are returned; an empty table gives no rows;
with few documents some shards stay empty.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.store import stored

CELLS = 1 << 16
OVERHEAD = 16
_TIE_MAX = (1 << 62) - 1


@dataclass
class _Node:
    """A node of the tree: its shards, and, once it is split, the dimension and the cut."""

    first: int
    count: int
    dim: int = 0
    value: int = 0
    tie: int = 0
    left: _Node | None = None
    right: _Node | None = None
    #: Least and greatest value of each dimension.
    box: list[tuple[int, int]] = field(default_factory=list)
    # the running search
    goal: float = 0.0
    before: float = 0.0
    low: int = 0
    high: int = -1
    on_tie: bool = False
    done: bool = field(default=False)


def _code(name: str, skip: int) -> Column:
    """Six bytes of a string, after ``skip`` bytes, as an order-preserving number; a null is -1."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), skip + 1, 6)), 12, "0"), 16, 10).cast("long"), F.lit(-1))


def _shared_beginnings(docs: DataFrame, names: list[str]) -> list[int]:
    """How many bytes all values of each column have in common: those of the least and the greatest."""
    if not names:
        return []
    ends = docs.agg(*[f(F.encode(F.col(n).cast("string"), "UTF-8")) for n in names for f in (F.min, F.max)]).first()
    return [len(os.path.commonprefix([bytes(a), bytes(b)])) if a is not None else 0 for a, b in zip(ends[::2], ends[1::2])]


def _pick(values: list, index: Column, kind: str = "long") -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), index + 1)


def _route(node: _Node, leaf) -> Column:
    """The expression that leads a row down the tree; ``leaf`` gives a node's value."""
    if node.left is None:
        return F.lit(leaf(node))
    d = F.col(f"d{node.dim}")
    goes_left = (d < node.value) | ((d == node.value) & (F.col("tie") < node.tie))
    return F.when(goes_left, _route(node.left, leaf)).otherwise(_route(node.right, leaf))


def _choose(node: _Node, cells: list[tuple[int, int, float, int]], tolerance: float) -> None:
    """Take a boundary of the histogram as the cut if it is near enough, else go into the cell.

    ``cells`` are (least value, greatest value, bytes, atoms), in order.
    """
    total = node.before
    for start, end, weight, atoms in cells:
        if total + weight < node.goal and (start, end) != cells[-1][:2]:
            total += weight
            continue
        under, over = node.goal - total, total + weight - node.goal
        single = atoms == 1 or (node.on_tie and start == end)
        if single or min(abs(under), abs(over)) <= tolerance:
            edge = start if abs(under) <= abs(over) else end + 1
            node.value, node.tie = (node.value, edge) if node.on_tie else (edge, 0)
            node.done = True
        elif start == end:
            node.value, node.before, node.low, node.high, node.on_tie = start, total, 0, _TIE_MAX, True
        else:
            node.before, node.low, node.high = total, start, end
        return
    node.done = True


def _histogram(rows: DataFrame, lows: list[int], highs: list[int], most: int) -> dict[int, list[tuple[int, int, float, int]]]:
    """(least, greatest, bytes, atoms) of the cells of each slot of ``rows`` (slot, value, bytes)."""
    cells = max(64, most // max(1, len(lows)))
    widths = [max(1, -(-(high - low + 1) // cells)) for low, high in zip(lows, highs)]
    slot = F.col("slot")
    cell = _divided(F.col("value") - _pick(lows, slot), _pick(widths, slot))
    table = rows.groupBy("slot", cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    found: dict[int, list[tuple[int, int, float, int]]] = {}
    for r in sorted(table, key=lambda r: (r["slot"], r["cell"])):
        found.setdefault(r["slot"], []).append((r["low"], r["high"], float(r["bytes"]), r["n"]))
    return found


def build_tree(atoms: DataFrame, dims: int, shards: int, tolerance: float) -> _Node:
    """The tree over ``atoms`` (d0.., tie, bytes); tolerance: bytes a cut may be off its goal."""
    names = [f"d{k}" for k in range(dims)]
    ends = atoms.agg(*[f(n) for n in names for f in (F.min, F.max)]).first()
    root = _Node(0, shards, box=[(ends[2 * k] or 0, ends[2 * k + 1] or 0) for k in range(dims)])
    spans = [max(1, high - low) for low, high in root.box]
    level = [root]
    while level := [n for n in level if n.count > 1]:
        index = {id(n): k for k, n in enumerate(level)}
        at = atoms.withColumn("node", _route(root, lambda n: index.get(id(n), -1))).where("node >= 0")
        each = at.select("node", "bytes", F.posexplode(F.array(*names)).alias("dim", "value")).select((F.col("node") * dims + F.col("dim")).alias("slot"), "value", "bytes")
        found = _histogram(each, [n.box[k][0] for n in level for k in range(dims)], [n.box[k][1] for n in level for k in range(dims)], CELLS)
        for j, n in enumerate(level):
            own = [found.get(j * dims + k, []) for k in range(dims)]
            n.done = not own[0]
            if n.done:
                continue
            n.box = [(cells[0][0], cells[-1][1]) for cells in own]
            n.dim = max(range(dims), key=lambda k: (n.box[k][1] - n.box[k][0]) / spans[k])
            n.goal = sum(c[2] for c in own[n.dim]) * (n.count // 2) / n.count
            _choose(n, own[n.dim], tolerance)
        while open_nodes := [n for n in level if not n.done]:
            slots = {id(n): k for k, n in enumerate(open_nodes)}
            slot = _pick([slots.get(id(n), -1) for n in level], F.col("node"), "int")
            d = F.element_at(F.array(*names), _pick([n.dim for n in level], F.col("node"), "int") + 1)
            on_tie = _pick([n.on_tie for n in open_nodes], F.col("slot"), "boolean")
            rows = at.withColumn("slot", slot).where("slot >= 0").withColumn("d", d)
            rows = rows.where(~on_tie | (F.col("d") == _pick([n.value for n in open_nodes], F.col("slot")))).select("slot", F.when(on_tie, F.col("tie")).otherwise(F.col("d")).alias("value"), "bytes")
            lows, highs = [n.low for n in open_nodes], [n.high for n in open_nodes]
            rows = rows.where(F.col("value").between(_pick(lows, F.col("slot")), _pick(highs, F.col("slot"))))
            found = _histogram(rows, lows, highs, CELLS)
            for n in open_nodes:
                _choose(n, found.get(slots[id(n)], []), tolerance)
        for n in level:
            half = n.count // 2
            n.left, n.right = _Node(n.first, half, box=list(n.box)), _Node(n.first + half, n.count - half, box=list(n.box))
            low, high = n.box[n.dim]
            n.left.box[n.dim], n.right.box[n.dim] = (low, max(low, min(high, n.value))), (max(low, min(high, n.value)), high)
        level = [c for n in level for c in (n.left, n.right)]
    return root


def _divided(value: Column, width: Column) -> Column:
    """Whole division of longs that are not negative."""
    return F.call_function("div", value, width)


def kd_shards(docs: DataFrame, shards: int = 40, dimensions: tuple[str, ...] = ("source", "lang"), group_share: float = 0.1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [d for d in dimensions if d in docs.columns]
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        *[_code(n, skip).alias(f"m{k}") for k, (n, skip) in enumerate(zip(names, _shared_beginnings(docs, names)))],
        F.monotonically_increasing_id().alias("rid"),
    )
    rows = stored(rows, "shard-rows")
    total, largest = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    most = max(largest, int(total / shards * group_share), 1)
    parts = F.ceil(F.col("group_bytes") / F.lit(most)).cast("long")
    groups = rows.groupBy("text_hash", "text_crc32").agg(
        F.sum("size").alias("group_bytes"),
        F.min("size").alias("d0"),
        F.coalesce(F.min("doc_id").cast("long"), F.lit(-1)).alias("d1"),
        *[F.min(f"m{k}").alias(f"d{k + 2}") for k in range(len(names))],
    ).withColumn("parts", parts)
    groups = stored(groups, "shard-groups")  # joined as it is summed, a large group couldn't be split
    dims = 2 + len(names)
    rows = rows.drop(*[f"m{k}" for k in range(len(names))]).join(groups, ["text_hash", "text_crc32"])
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("rid"), F.col("parts"))).otherwise(F.lit(0))
    rows = stored(rows.withColumn("part", part).withColumn("tie", F.shiftrightunsigned(F.xxhash64("text_hash", "part"), 2)).drop("group_bytes", "parts", "text_hash", "part"), "shard-atoms")
    atoms = stored(rows.groupBy("tie", *[f"d{k}" for k in range(dims)]).agg(F.sum("size").alias("bytes")), "shard-weights")
    tree = build_tree(atoms, dims, shards, tolerance=total / shards / 500)
    placed = rows.select("doc_id", "size", "text_crc32", "rid", _route(tree, lambda n: n.first).cast("int").alias("shard"), F.shiftright("rid", 33).alias("piece"))
    counts = placed.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "piece", (F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("rid"))
    return placed.join(offsets, ["shard", "piece"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + place - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
