"""Words of whole texts as hash arrays, batch by batch; shared by operators that count or compare words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


SLICE_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in parts of at most ``most`` bytes of text (or one row), so that memory stays bounded."""
    for batch in batches:
        if not len(batch):
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        part = (np.cumsum(size) - size) // most
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b in zip(first, [*first[1:], len(batch)], strict=True):
            yield batch.slice(int(a), int(b - a))
        pa.default_memory_pool().release_unused()  # a worker serves many tasks after this one


def carried(docs: DataFrame, keep: list[str] | None, text_col: str) -> DataFrame:
    """Struct ``row`` of the kept columns (default all) with the place of the text in it, or ``text`` beside it.

    A text that is kept anyway travels to the workers once.
    """
    keep = docs.columns if keep is None else keep
    row = F.struct(*(docs[c] for c in keep)).alias("row")
    if text_col in keep:
        return docs.select(row, F.lit(keep.index(text_col)).alias("at"), F.lit(None).cast("string").alias("text"))
    return docs.select(row, F.lit(-1).alias("at"), docs[text_col].alias("text"))


def carried_slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of ``carried`` rows with ``text`` filled in, cut as by ``slices``."""
    for batch in batches:
        if len(batch):
            at = batch.column("at")[0].as_py()
            text = batch.column("row").field(at) if at >= 0 else batch.column("text")
            rest = {n: batch.column(n) for n in batch.schema.names if n not in ("at", "text")}
            yield from slices([pa.RecordBatch.from_pydict({**rest, "text": text})], most=most)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, clean: Callable[[pa.Array], pa.Array] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of every text and their row offsets; null counts as empty.

    Words are runs of characters other than blank, tab, line end, vertical tab, form feed and return.
    ``clean`` is applied to the distinct words of a batch first; words that become empty vanish.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.flatten()
    if len(flat) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    coded = flat.dictionary_encode()
    distinct = coded.dictionary if clean is None else clean(coded.dictionary)
    unique = distinct.cast(pa.binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in unique), np.uint64, len(unique))
    filled = np.fromiter((len(w) > 0 for w in unique), bool, len(unique))
    codes = np.asarray(coded.indices)
    keep = filled[codes]
    before = np.concatenate([[0], np.cumsum(keep)])
    return hashes[codes[keep]], before[offsets - offsets[0]]


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words inside each row, and the row of each.

    A row of fewer than ``n`` words has its whole sequence as one shingle; a row without words has none.
    """
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    rest = offsets[1:][rows] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    start = (rest >= n) | ((np.arange(len(words)) == offsets[:-1][rows]) if len(words) else np.zeros(0, bool))
    at = np.flatnonzero(start)
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        inside = rest[at] > k
        part = np.where(inside, words[np.minimum(at + k, len(words) - 1)], np.uint64(int(STEP) * (k + 1) % 2**64)) if len(at) else value
        value = mix(value * STEP + part)
    return value, rows[at]


def row_sets(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in ascending order, and row offsets."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    if len(values):
        first = np.concatenate([[True], (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])])
        values, rows = values[first], rows[first]
    return values, np.searchsorted(rows, np.arange(n_rows + 1))
