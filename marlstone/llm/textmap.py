"""Arrow-batched text maps: one pass over whole texts, in pieces of bounded size.

``append_columns`` hands Arrow string arrays to a function and appends the arrays that it
returns. Batches are cut again into pieces of about ``PIECE_BYTES`` of text, so memory
follows the longest single text and not the batch. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds about ``most`` bytes, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def append_columns(
    df: DataFrame,
    column: str,
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.Array], list]],
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``df`` with ``fields`` appended; columns of the same name are replaced.

    ``make`` runs once a task and returns the function from an Arrow string array without
    nulls to one array (or list) a field.
    """
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *fields])
    arrow = to_arrow_schema(schema)
    keep = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in pieces(batch, column, piece_bytes):
                texts = pc.fill_null(part.column(column), "")
                made = fn(texts)
                arrays = [part.column(n) for n in keep]
                for f, values in zip(fields, made, strict=True):
                    kind = arrow.field(f.name).type
                    arrays.append(values.cast(kind) if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(f.name for f in fields)])

    return df.mapInArrow(run, schema)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each text (one more than texts)."""
    wide = texts.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    off = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


#: The bytes between words: space and the five controls from tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the index of each text's first word (one more than texts)."""
    word = ~IS_SPACE[data]
    before = np.empty_like(word)
    after = np.empty_like(word)
    if len(word):
        before[0] = after[-1] = False
        before[1:] = word[:-1]
        after[:-1] = word[1:]
        inner = off[(off > 0) & (off < len(data))]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_RINV = np.uint64(pow(int(_R), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, mod 2**64; they are kept."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_R, _RINV)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (Murmur3's constants)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes (mod 2**64, mixed) of spans of ``values`` from one prefix sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * down[starts])
