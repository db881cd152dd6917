"""Benchmark passages in documents: latent retrieval, then common subsequences and answer checks.

1. Terms are the words of the benchmark, without case and signs. Their document frequencies are counted over
   all documents.
2. A randomised SVD (random range finder, two power steps) of the TF-IDF rows of all benchmark passages, the indexed
   texts, gives a latent space of ``RANK`` dimensions; windows of documents are folded into it. Nothing is sampled.
   Rows stay distributed; the driver sees term-by-rank matrices only.
3. Every document is cut into overlapping windows about as long as the items. A window whose words of the
   benchmark hold less than ``GATE`` of its weight and less than ``SHARE`` of its number of words is passed over
   (an item makes two thirds of some window of its size at least, and ``LIKELY`` of it is asked for); the others are projected, and items with a latent cosine of ``COSINE`` or more are candidates. Places that share a run
   of ``ANCHOR`` words with an item (all words of a shorter one) are candidates whatever the weights and the cosine.
   Runs that more than ``ANCHOR_ITEMS`` items hold serve only items without a rarer one; every item has a run, so
   that no verbatim copy is lost, however short or frequent the item.
   Every such place is checked. Up to ``TOGETHER`` overlapping places are checked as one first: what is not found
   in all their words is in none of them.
4. A candidate counts if the longest common subsequence of words covers ``SURE`` of the item, or ``LIKELY`` of
   the item and as much of its answer, its last quarter.

The benchmark is handled in blocks of at most ``BLOCK_CHARS`` characters; each block's terms and passages are
bounded by that and travel with the tasks. Documents are never shuffled.

Defined results: null, empty and wordless texts on either side match nothing; items of the same text each
match; repeated documents each get their hits; empty tables give no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.words import STEP, carried, carried_slices, mix, slices, word_hashes

SIZES = (4, 8, 16, 32, 64, 128)
RANK = 192
EXTRA = 16
POWER_STEPS = 2
GATE = 0.3
ANCHOR = 4
ANCHOR_ITEMS = 16
TOGETHER = 8
COSINE = 0.5
SURE = 0.8
LIKELY = 0.6
SHARE = LIKELY * 2 / 3
BLOCK_CHARS = 4_000_000
CHUNK_WORDS = 24_000
TEXT_BYTES = 1 << 20  # of documents handled at once


def clean(words: pa.Array) -> pa.Array:
    """Letters and digits only, in lower case."""
    return pc.utf8_lower(pc.replace_substring_regex(words, r"[^\p{L}\p{N}]+", ""))


def bit_masks(a: list[int]) -> dict[int, int]:
    """Places of each word as bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common(masks: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of ``n`` words with these masks and ``b``, by bit vectors."""
    row = full = (1 << n) - 1
    for m in map(masks.get, b):
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    return common(bit_masks(a), len(a), b)


def window_size(length: int) -> int:
    """The window size that serves an item of so many words."""
    return next((s for s in SIZES if s >= 0.75 * length), SIZES[-1])


def runs(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words that start at some places."""
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        value = mix(value * STEP + words[at + k])
    return value


def anchors(items: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By run length: hashes in ascending order, and the item and place in the item of each; see point 3 of the module."""
    found = []
    for i, w in enumerate(items):
        if len(w):
            n = min(ANCHOR, len(w))
            at = np.arange(len(w) - n + 1)
            found.append(np.stack([np.full(len(at), n), np.full(len(at), i), at, runs(w, at, n).view(np.int64)]))
    out = {}
    if not found:
        return out
    length, item, place, value = np.concatenate(found, axis=1)
    for n in np.unique(length).tolist():
        here = length == n
        who, where, what = item[here], place[here], value[here]
        both = np.unique(np.stack([what, who]), axis=1)
        unique, holders = np.unique(both[0], return_counts=True)
        often = holders[np.searchsorted(unique, what)]
        order = np.lexsort((where, often, who))
        who, where, what, often = who[order], where[order], what[order], often[order]
        first = np.concatenate([[True], who[1:] != who[:-1]])
        use = first | (often <= ANCHOR_ITEMS)
        who, where, what = who[use], where[use], what[use].view(np.uint64)
        order = np.argsort(what, kind="stable")
        out[n] = (what[order], who[order], where[order])
    return out


def _cleaned(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of all texts over their distinct cleaned forms (some empty), and row offsets."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = np.asarray(lists.offsets, np.int64)
    coded = lists.flatten().dictionary_encode()
    return pa.DictionaryArray.from_arrays(coded.indices, clean(coded.dictionary)), offsets - offsets[0]


class Block:
    """Items of one block of the benchmark: words, terms, and the passages that are looked for."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        words, offsets = word_hashes(pa.array([r[1] for r in rows], pa.string()), clean)
        self.items = [words[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.terms = np.unique(words)
        # The terms themselves in the same order: texts are looked up by them, without a hash of each other word.
        names = pc.unique(_cleaned(pa.array([r[1] for r in rows], pa.string()))[0].dictionary) if len(rows) else pa.array([], pa.string())
        names = names.filter(pc.greater(pc.binary_length(names), 0))
        hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.binary()).to_pylist()], np.uint64)
        self.names = names.take(pa.array(np.argsort(hashed, kind="stable")))
        self.passages: list[tuple[int, int, np.ndarray]] = []  # item, window size, words
        for i, w in enumerate(self.items):
            if len(w):
                size = window_size(len(w))
                for at in range(0, max(1, len(w) - size // 2), size) if len(w) > 1.34 * size else (0,):
                    self.passages.append((i, size, w[at : at + size] if len(w) > 1.34 * size else w))
        self.anchors = anchors(self.items)
        self.idf = np.ones(len(self.terms))
        self.other = 1.0
        self.space = np.zeros((len(self.terms), 0))
        self.latent = np.zeros((len(self.passages), 0))

    def places(self, words: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for words that are no term."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Term number (-1: no term) of every word of the texts that is not empty once cleaned, and row offsets."""
        coded, offsets = _cleaned(texts)
        place = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, value_set=self.names), -1), np.int64)
        filled = np.asarray(pc.binary_length(coded.dictionary)) > 0
        code = np.asarray(coded.indices)
        keep = filled[code] if len(code) else np.zeros(0, bool)
        return place[code[keep]], np.concatenate([[0], np.cumsum(keep)])[offsets]

    def row(self, words: np.ndarray) -> np.ndarray:
        """TF-IDF row of length one over the terms."""
        at = self.places(words)
        out = np.bincount(at[at >= 0], minlength=len(self.terms)) * self.idf
        norm = np.linalg.norm(out)
        return out / norm if norm else out


def _frequencies(texts: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents."""
    n_terms = len(block.terms)

    def count(batches):
        total = np.zeros(n_terms + 1, np.int64)
        for batch in slices(batches, most=TEXT_BYTES):
            at, offsets = block.read(batch.column(0))
            rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            both = np.asarray(pc.unique(pa.array((rows * n_terms + at)[at >= 0])))
            total[:n_terms] += np.bincount(both % max(1, n_terms), minlength=n_terms) if n_terms else 0
            total[n_terms] += len(batch)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    got = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(n_terms + 1)
    for r in got:
        df[r["term"]] = r["n"]
    return df[:n_terms], int(df[n_terms])


def _latent_space(spark: SparkSession, block: Block) -> np.ndarray:
    """Orthonormal term vectors of the leading singular directions of all passages that are looked for."""
    n_terms = len(block.terms)
    matrix = spark.createDataFrame([(block.places(w).tolist(),) for _, _, w in block.passages], "terms array<long>")
    width = min(RANK + EXTRA, n_terms)
    panel = 512

    def times(base: np.ndarray) -> np.ndarray:
        """A' A base, summed over tasks panel by panel."""
        shared = spark.sparkContext.broadcast(base)

        def part(batches):
            out = np.zeros((n_terms, width))
            for batch in batches:
                for terms in batch.column(0).to_pylist():
                    at, n = np.unique(np.array(terms, np.int64), return_counts=True)
                    value = n * block.idf[at]
                    norm = np.linalg.norm(value)
                    if norm:
                        value = value / norm
                        out[at] += np.outer(value, value @ shared.value[at])
            for first in range(0, n_terms, panel):
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([out[first : first + panel].tobytes()])], names=["first", "part"])

        def add(key, table):
            total = sum(np.frombuffer(x.as_py()) for x in table.column("part"))
            return pa.table({"first": [key[0].as_py()], "part": [total.tobytes()]})

        parts = matrix.coalesce(8).mapInArrow(part, "first long, part binary")
        got = parts.groupBy("first").applyInArrow(add, "first long, part binary").collect()
        out = np.zeros((n_terms, width))
        for r in got:
            piece = np.frombuffer(r["part"]).reshape(-1, width)
            out[r["first"] : r["first"] + len(piece)] = piece
        return out

    base = np.linalg.qr(np.random.default_rng(7).standard_normal((n_terms, width)))[0]
    for _ in range(POWER_STEPS):
        base = np.linalg.qr(times(base))[0]
    inner = base.T @ times(base)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-value)[: min(RANK, width)]
    return base @ vector[:, best[value[best] > 1e-9]]


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[DataFrame]:
    """The benchmark cut by hash into parts of at most about BLOCK_CHARS characters."""
    rows = benchmark.select(benchmark[id_col].alias("id"), benchmark[text_col].alias("text")).where(F.col("text").isNotNull())
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = -(-size // BLOCK_CHARS)
    return [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == p) for p in range(parts)]


def fit(docs: DataFrame, part: DataFrame, text_col: str = "text") -> Block:
    """Latent index of one block of the benchmark."""
    block = Block(sorted((tuple(r) for r in part.collect()), key=repr))
    texts = docs.select(docs[text_col].alias("text"))
    df, rows = _frequencies(texts, block)
    block.idf = np.log((rows + 1.0) / (df + 0.5)).clip(0.05)
    block.other = float(np.median(block.idf)) if len(block.idf) else 1.0
    if len(block.terms):
        block.space = _latent_space(docs.sparkSession, block)
        block.latent = np.array([block.row(w) for _, _, w in block.passages]) @ block.space
        norm = np.linalg.norm(block.latent, axis=1, keepdims=True)
        block.latent = (block.latent / np.where(norm > 0, norm, 1)).astype(np.float32)
        block.space = (block.space * block.idf[:, None]).astype(np.float32)
    return block


def _windows(sizes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of windows of ``size`` words, a quarter of that apart."""
    step = size // 4
    n = np.maximum(1, -(-(sizes - size) // step) + 1) * (sizes > 0)
    row = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][row] + number * step
    return start, np.minimum(start + size, offsets[1:][row]), row


def _anchored(block: Block, words: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> dict[tuple[int, int], list[tuple]]:
    """Places by (row, item) where a run of the item's words stands: cosine (unknown here), start, end."""
    out: dict[tuple[int, int], list[tuple]] = {}
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n, (values, items, places) in block.anchors.items():
        at = np.flatnonzero(known)
        at = at[at + n <= offsets[1:][rows[at]]]
        for k in range(1, n):
            at = at[known[at + k]]
        value = runs(words, at, n)
        lo, hi = np.searchsorted(values, value), np.searchsorted(values, value, side="right")
        times = hi - lo
        some = np.repeat(at, times)
        hit = np.repeat(lo, times) + np.arange(len(some)) - np.repeat(np.cumsum(times) - times, times)
        start = np.unique(np.stack([rows[some], items[hit], some - places[hit]]), axis=1)
        for row, item, first in zip(*start.tolist(), strict=True):
            a, b = max(first, int(offsets[row])), min(first + len(block.items[item]), int(offsets[row + 1]))
            out.setdefault((row, item), []).append((None, a, b))
    return out


def find(block: Block, texts: pa.Array) -> list[list[dict]]:
    """Hits of every text: item, latent cosine, share of the item in common order, answer found, first word."""
    at, offsets = block.read(texts)
    hits: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    if not len(at) or not block.passages:
        return hits
    words = np.where(at >= 0, block.terms[at], np.uint64(0))
    vectors = np.concatenate([block.space, np.zeros((1, block.space.shape[1]), np.float32)])  # the last for other words
    done: dict[tuple[int, int], dict] = {}
    masks: dict[int, dict[int, int]] = {}  # of the items met here

    def holds(row: int, item: int, a: int, b: int) -> tuple[float, bool] | None:
        """Share of the item around a place and whether its answer is there; None if they do not make a hit."""
        n = len(block.items[item])
        lo, hi = max(int(offsets[row]), a - n), min(int(offsets[row + 1]), b + n)
        around = at[lo:hi].tolist()
        if item not in masks:
            masks[item] = bit_masks(block.places(block.items[item]).tolist())
        share = common(masks[item], n, around) / n
        if share < LIKELY:
            return None
        tail = block.places(block.items[item][-max(1, n // 4) :]).tolist()
        answer = lcs(tail, around) / len(tail) >= LIKELY
        return (share, answer) if share >= SURE or answer else None

    def check(row: int, p: int, cosine: float | None, a: int, b: int) -> None:
        """Notes the hit if the words around a place hold the item of a passage."""
        item = block.passages[p][0]
        found = holds(row, item, a, b)
        if found:
            if cosine is None:
                latent = vectors[at[a:b]].sum(axis=0)
                cosine = float(latent @ block.latent[p] / max(float(np.linalg.norm(latent)), 1e-9))
            done[(row, item)] = {"item": item, "cosine": cosine, "share": found[0], "answer": found[1], "first_word": a - int(offsets[row])}

    first_passage: dict[int, int] = {}
    for p, (item, _, _) in enumerate(block.passages):
        first_passage.setdefault(item, p)
    for (row, item), places in _anchored(block, words, offsets, at >= 0).items():
        for cosine, a, b in places:
            check(row, first_passage[item], cosine, a, b)
            if (row, item) in done:
                break
    weight = np.where(at >= 0, block.idf[at], 0.0) ** 2
    own = np.concatenate([[0.0], np.cumsum(weight)])
    every = own + np.concatenate([[0.0], np.cumsum(np.where(at >= 0, 0.0, block.other**2))])
    number = np.concatenate([[0], np.cumsum(at >= 0)])
    terms = at[at >= 0]
    likely: dict[tuple[int, int], list[tuple]] = {}
    for size in SIZES if block.space.shape[1] else ():
        wanted = [p for p, x in enumerate(block.passages) if x[1] == size]
        if not wanted:
            continue
        start, end, row = _windows(np.diff(offsets), offsets, size)
        mass = own[end] - own[start]
        # Words of a frequent item weigh less than others: their number counts as well as their weight.
        enough = (mass >= GATE * (every[end] - every[start])) | (number[end] - number[start] >= SHARE * (end - start))
        passed = np.flatnonzero(enough & (mass > 0))
        target = block.latent[wanted].T
        chunk, step = CHUNK_WORDS // size, size // 4
        for first in range(0, len(passed), chunk):
            some = passed[first : first + chunk]
            # Windows overlap by whole quarters: each quarter is summed once, one word of all of them at a time.
            quarter = start[some][:, None] + step * np.arange(4)
            pieces, back = np.unique(np.where(quarter < end[some][:, None], quarter, len(at)), return_inverse=True)
            limit = offsets[np.searchsorted(offsets, np.minimum(pieces, len(at) - 1), side="right")]
            # Only words of the benchmark have a vector; pieces with many of them come first.
            lo, hi = number[pieces], number[np.maximum(np.minimum(pieces + step, limit), pieces)]
            order = np.argsort(lo - hi, kind="stable")
            left = np.cumsum(np.bincount(hi - lo, minlength=step + 1)[::-1])[::-1]
            low, sums = lo[order], np.zeros((len(pieces), block.space.shape[1]), np.float32)
            for k in range(step):
                m = int(left[k + 1])
                if not m:
                    break
                sums[:m] += block.space[terms[low[:m] + k]]
            latent = np.empty_like(sums)
            latent[order] = sums
            back = back.reshape(quarter.shape)
            whole = latent[back[:, 0]]
            for k in range(1, 4):
                whole += latent[back[:, k]]
            whole /= np.maximum(np.sqrt(np.einsum("ij,ij->i", whole, whole)), 1e-9)[:, None]
            cosine = whole @ target
            for i, j in zip(*np.divmod(np.flatnonzero(cosine >= COSINE), len(wanted)), strict=True):
                w = some[i]
                p = wanted[j]
                if (int(row[w]), block.passages[p][0]) not in done:
                    likely.setdefault((int(row[w]), p), []).append((float(cosine[i, j]), int(start[w]), int(end[w])))
    for (row, p), places in likely.items():  # by passage, and in the order of the text
        item = block.passages[p][0]
        if (row, item) in done:
            continue
        left = []
        at_first = 0
        for k in range(1, len(places) + 1):
            if k == len(places) or k - at_first == TOGETHER or places[k][1] >= places[k - 1][2]:
                if k - at_first == 1 or holds(row, item, places[at_first][1], places[k - 1][2]):
                    left += places[at_first:k]
                at_first = k
        for cosine, a, b in sorted(left, key=lambda x: (-x[0], x[1])):
            check(row, p, cosine, a, b)
            if (row, item) in done:
                break
    for (row, _), hit in sorted(done.items()):
        hits[row].append(hit)
    return hits


HIT = "item_id long, cosine double, lcs_share double, answer boolean, first_word long"


def hits_by_row(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, with an array ``hits``."""
    rows = carried(docs, keep, text_col)
    rows = rows.withColumn("hits", F.array().cast(f"array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>"))
    for part in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(fit(docs, part, text_col))

        def search(batches, shared=shared):
            block = shared.value
            for batch in batches:
                found = []
                for part in carried_slices([batch], most=TEXT_BYTES):
                    for old, new in zip(part.column("hits").to_pylist(), find(block, part.column("text")), strict=True):
                        found.append(
                            old
                            + [
                                {"item_id": block.ids[h["item"]], "cosine": h["cosine"], "lcs_share": h["share"], "answer": h["answer"], "first_word": h["first_word"]}
                                for h in new
                            ]
                        )
                yield batch.set_column(batch.schema.get_field_index("hits"), batch.schema.field("hits"), pa.array(found, batch.schema.field("hits").type))

        rows = rows.mapInArrow(search, rows.schema)
    return rows.drop("text", "at")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with its columns."""
    return hits_by_row(docs, benchmark, text_col).where(F.size("hits") == 0).select("row.*")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = hits_by_row(docs, benchmark, keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("hits").alias("hit")).select("doc_id", "hit.*")
