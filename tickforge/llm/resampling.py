"""Importance resampling of documents towards a target distribution, over hashed word runs.

Words are runs of digits, letters a to z (A to Z lower-cased) and characters above ASCII; all else bounds them. The
features of a text are its runs of 1 to ``most`` consecutive words joined by one space; a feature's bucket is its
crc32 modulo ``buckets``.

An Aho-Corasick automaton holds words with a blank on both sides, each with a payload: crc32 and length. A batch of
texts becomes one line of bytes with blanks for everything that bounds words; one scan of it emits the payloads of
all words, neighbours sharing their blank. The crc32 of a run follows from the payloads of its words alone: the sum
of a run is moved past the bytes of the next word (a linear map, by binary digits of the length) and added to that
word's. Texts are never cut into words or runs.

The dictionary is fixed in size: the ``DICTIONARY`` most frequent words of up to ``LONGEST`` bytes in a sample of
about ``SAMPLE_ROWS`` documents and as many target texts. It only saves time: places where no word of it matched are
read from the line itself, so counts, weights and ranks cover every word of every text.

Counts of buckets are summed in tasks and collected, at most ``buckets`` numbers. Ranks need no global sort: scores
are whole numbers of a narrow range, so a count per score tells the cut and how many documents come before each score,
and only equal scores are ordered by identifier.

Defined results: null and empty texts have no features and weight 0; null identifiers are hashed as the text "null"
and come last among equal scores; of rows alike in identifier and score any order is right; without eligible
documents nobody is drawn; without target texts or documents the gains follow from the smoothing alone.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.samples import sample_rows
from tickforge.llm.words import slices
from tickforge.session import checkpoint_dir

BUCKETS = 10_000
MOST = 1
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
DICTIONARY = 65_536
LONGEST = 64
SAMPLE_ROWS = 20_000

#: Lower-cases A-Z and turns every ASCII byte that is no digit or letter into a blank.
BOUNDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
CRC_POLYNOMIAL = 0xEDB88320  # fixed value: the reflected polynomial of crc32


def _shift_tables() -> np.ndarray:
    """``tables[d, i, b]``: what byte i of a sum, worth b, becomes after 2**d zero bytes."""
    step = np.zeros(32, np.uint64)  # the map of one zero byte, by bits
    for bit in range(32):
        x = 1 << bit
        for _ in range(8):
            x = x >> 1 ^ (CRC_POLYNOMIAL if x & 1 else 0)
        step[bit] = x
    tables = np.zeros((32, 4, 256), np.uint32)
    for d in range(32):
        for byte in range(4):
            for b in range(256):
                tables[d, byte, b] = np.bitwise_xor.reduce([step[8 * byte + i] for i in range(8) if b >> i & 1] or [np.uint64(0)])
        step = np.array([_moved(tables[d], np.array([s], np.uint32))[0] for s in step], np.uint64)
    return tables


def _moved(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return table[0][sums & 255] ^ table[1][sums >> 8 & 255] ^ table[2][sums >> 16 & 255] ^ table[3][sums >> 24]


class Shift:
    """crc32 of two joined byte strings from their sums and the second one's length."""

    tables: np.ndarray | None = None

    @classmethod
    def joined(cls, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        if cls.tables is None:
            cls.tables = _shift_tables()
        out, length = first.astype(np.uint32), np.asarray(length, np.int64)
        for d in range(int(length.max(initial=0)).bit_length()):
            out = np.where(length >> d & 1, _moved(cls.tables[d], out), out)
        return out ^ second


def line_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts as one line of bounded words with blanks around each text, and the place after each text."""
    parts = [(t or b"").translate(BOUNDED) for t in texts.cast(pa.binary()).to_pylist()]
    return b" " + b" ".join(parts) + b" ", np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)


class Dictionary:
    """Automaton over delimiter-bounded words, with the payload of each."""

    def __init__(self, words: list[bytes]):
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.size = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):  # bytes as characters, so that places are those of bytes
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        if words:
            self.automaton.make_automaton()

    def payloads(self, line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """crc32, length and end of every word of a line, in order."""
        blank = np.frombuffer(line, np.uint8) == 32
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        crc, size = np.zeros(len(ends), np.uint32), np.full(len(ends), -1, np.int64)
        if len(self.size):
            found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(line.decode("latin-1"))), np.int64).reshape(-1, 2)
            at = np.searchsorted(ends, found[:, 0])
            crc[at], size[at] = self.crc[found[:, 1]], self.size[found[:, 1]]
        for i in np.flatnonzero(size < 0).tolist():
            word = line[line.rindex(b" ", 0, ends[i]) + 1 : ends[i]]
            crc[i], size[i] = zlib.crc32(word), len(word)
        return crc, size, ends


class Runs:
    """Buckets of all features of some texts: one array a run length, with the text of each."""

    def __init__(self, texts: pa.Array, known: Dictionary, buckets: int, most: int):
        line, after = line_of(texts)
        crc, size, ends = known.payloads(line)
        row = np.searchsorted(after, ends, side="left")
        self.words = np.bincount(row, minlength=len(texts))[: len(texts)]
        self.buckets, self.rows = [(crc % buckets).astype(np.int64)], [row]
        run, blank = crc, np.uint32(zlib.crc32(b" "))
        for n in range(1, most):
            run = Shift.joined(run[: len(run) - 1], np.full(max(0, len(run) - 1), blank), np.ones(max(0, len(run) - 1), np.int64))
            run = Shift.joined(run, crc[n:], size[n:])
            same = row[n:] == row[: len(row) - n]
            self.buckets.append((run[same] % buckets).astype(np.int64))
            self.rows.append(row[n:][same])


def dictionary(docs: DataFrame, target: DataFrame, id_col: str, target_id: str, text_col: str) -> list[bytes]:
    """Most frequent words of bounded samples of both tables."""

    def count(batches):
        for batch in slices(batches):
            words = Counter(w for w in line_of(batch.column("text"))[0].split(b" ") if 0 < len(w) <= LONGEST)
            yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    some = [sample_rows(t, k, SAMPLE_ROWS).select(t[text_col].alias("text")) for t, k in ((docs, id_col), (target, target_id))]
    words = some[0].union(some[1]).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in words.orderBy(F.desc("n"), "word").limit(DICTIONARY).collect()]


def bucket_counts(texts: DataFrame, words, buckets: int = BUCKETS, most: int = MOST) -> np.ndarray:
    """Features of all texts by bucket; ``words`` is the broadcast dictionary, ``texts`` has the one column ``text``."""

    def count(batches):
        known, total = Dictionary(words.value), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for b in Runs(batch.column("text"), known, buckets, most).buckets:
                total += np.bincount(b, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    s, t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float((int(b) + 1) * (s + k)) / float((int(a) + 1) * (t + k)))) for a, b in zip(source, target, strict=True)], np.int64)


def weighted(docs: DataFrame, words, gain: np.ndarray, id_col: str, text_col: str, most: int = MOST) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""

    def weigh(batches):
        known = Dictionary(words.value)
        for batch in slices(batches):
            runs, n = Runs(batch.column("text"), known, len(gain), most), len(batch)
            features, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for bucket, row in zip(runs.buckets, runs.rows, strict=True):
                features += np.bincount(row, minlength=n)
                np.add.at(total, row, gain[bucket])
            weight = np.floor_divide(total, np.maximum(features, 1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(runs.words.astype(np.int64)), pa.array(features), pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = rows.select("id").schema
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(weigh, schema)


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate from a hash of the identifier, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """``scored`` (id, score, ...) with ``rank`` of the drawn rows: floor(percent * N / 100) of the N eligible ones."""
    scored = scored.withColumn("eligible", F.coalesce(eligible, F.lit(False)))
    # One number a score; scores lie within some tens of thousands whatever the number of rows.
    counts = sorted(((r["score"], r["n"]) for r in scored.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    left = percent * sum(n for _, n in counts) // 100
    before, taken = [], 0
    for score, n in counts:
        if taken >= left:
            break
        before.append((score, taken))
        taken += n
    lowest = before[-1][0] if before else None
    inside = F.col("eligible") & (F.col("score") >= lowest) if before else F.lit(False)
    offsets = scored.sparkSession.createDataFrame(before, "score long, before long")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last()))
    ranked = scored.where(inside).withColumn("place", place).join(F.broadcast(offsets), "score")
    rank = F.col("before") + F.col("place")
    ranked = ranked.withColumn("rank", F.when(rank <= left, rank).cast("long"))
    rest = scored.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    return ranked.drop("before", "place", "eligible").unionByName(rest.drop("eligible"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    target_id: str = "item_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    most: int = MOST,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``docs``; rank is null for rows not drawn."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    words = spark.sparkContext.broadcast(dictionary(docs, target, id_col, target_id, text_col))
    s, t = (bucket_counts(x.select(x[text_col].alias("text")), words, buckets, most) for x in (docs, target))
    rows = weighted(docs, words, gains(s, t), id_col, text_col, most)
    scored = rows.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).checkpoint()
    words.unpersist()
    return drawn(scored, F.col("n_words") >= least_words, percent)


def query(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
