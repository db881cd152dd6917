"""Toxicity scores from boosted trees over dense text features, calibrated by isotonic regression.

Fitting reads at most about ``SAMPLE_ROWS`` labelled rows, split by a hash of the identifier into three parts:
one yields the lexicon (words and word beginnings of toxic documents), one the trees, one the calibration.
A word enters the lexicon by the number of unlike documents that hold it: documents whose word sets have
the same minimum hash count once, so a group of near copies does not turn its words into evidence.

Features: lexicon densities (strong, mild, word beginnings), distinct hits, densest window, second-person words and
those near a hit, capitals, punctuation, repeated signs, obfuscated words and those which match the
lexicon after they are spelt out, length and variety.

Defined results: null and empty texts are scored as texts without words; a label row without label is ignored;
of repeated labels the higher counts; repeated rows each get a row. Without labels of both kinds nothing can be told
apart: no trees are grown, every score is 0, ``predicted`` is 0 and ``keep_clean`` keeps every row.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm import boosting
from tickforge.llm.samples import hashed_share, id_bucket
from tickforge.llm.words import carried, carried_slices, slices
from tickforge.session import checkpoint_dir

SAMPLE_ROWS = 12_000
LEXICON = 2_000
BEGIN = 5
NEAR = 4

WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"\b(?=\w*[^\W\d_])[^\W_]*[^\W\d_][0-9@$!*#|+]+[^\W\d_]\w*")


def _table(chars: str) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[np.frombuffer(chars.encode("latin-1"), np.uint8)] = True
    return marks


UPPER = _table("".join(chr(c) for c in range(65, 91)) + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7))
LETTER = UPPER | _table("".join(chr(c) for c in range(97, 123)) + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7))
SIGN = _table("!?.*#$%&@")
INSIDE = _table("0123456789@$!*#|+")
# Second-person words of the four languages.
SECOND = frozenset(
    "you your yours yourself du dein deine deiner dir dich euch ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
# Signs used in place of letters.
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
NAMES = (
    "strong mild begins distinct heaviest dense_window second second_near capitals capital_runs exclaims "
    "punctuation repeated mixed spelled_hits stretched length word_length variety"
).split()


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(text: str, lexicon: dict[str, float], begins: dict[str, float]) -> list[float]:
    """The dense row of one text; see NAMES."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    n = max(1, len(words))
    distinct = set(words)
    hits = [*(lexicon.keys() & distinct)]
    strong = mild = 0
    for w in hits:
        times = words.count(w)
        if lexicon[w] >= 3:
            strong += times
        else:
            mild += times
    starts = {}
    for w in distinct:
        weight = begins.get(w[:BEGIN]) if len(w) >= BEGIN else None
        if weight is not None:
            starts[w] = weight
    begun = sum(words.count(w) for w in starts)
    marked = set(hits).union(starts)
    second = sum(words.count(w) for w in SECOND.intersection(distinct))
    near = window = 0
    if marked:
        places = [i for i, w in enumerate(words) if w in marked]
        best, lo = 0, 0
        for hi, place in enumerate(places):
            while place - places[lo] >= 50:
                lo += 1
            best = max(best, hi - lo + 1)
        window = best
        if second:
            near = sum(1 for p in places if SECOND.intersection(words[max(0, p - NEAR) : p + NEAR + 1]))
    size = max(1, len(text))
    raw = np.frombuffer(text.encode("latin-1", "ignore"), np.uint8)
    upper, letter, sign = UPPER[raw], LETTER[raw], SIGN[raw]
    same = raw[1:] == raw[:-1]
    capital_runs = upper[2:] & upper[1:-1] & upper[:-2]
    mixed = MIXED.findall(lowered) if (INSIDE[raw[1:-1]] & letter[:-2] & (letter[2:] | INSIDE[raw[2:]])).any() else []
    spelled = sum(1 for m in mixed if (s := "".join(WORD.findall(m.translate(PLAIN)))) in lexicon or begins.get(s[:BEGIN]) is not None)
    return [
        100 * strong / n,
        100 * mild / n,
        100 * begun / n,
        float(len(hits) + len(starts)),
        max([0.0, *(lexicon[w] for w in hits), *starts.values()]),
        float(window),
        100 * second / n,
        float(near),
        upper.sum() / size,
        capital_runs.sum() / size,
        100 * text.count("!") / size,
        100 * sign.sum() / size,
        100 * (same & sign[1:]).sum() / size,
        100 * len(mixed) / n,
        float(spelled),
        100 * (same[1:] & same[:-1] & letter[2:]).sum() / n,
        math.log1p(size),
        sum(map(len, distinct)) / max(1, len(distinct)),
        len(distinct) / n,
    ]


class Model:
    """Lexicon, trees and calibration; small enough to travel with a task."""

    def __init__(self, lexicon, begins, trees, calibrate):
        self.lexicon, self.begins, self.trees, self.calibrate = lexicon, begins, trees, calibrate

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts or not len(self.trees.leaves):  # nothing learnt, nothing accused
            return np.zeros(len(texts))
        x = np.array([features(t or "", self.lexicon, self.begins) for t in texts])
        return self.calibrate(self.trees.margin(x))


def _labelled(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str) -> DataFrame:
    """(part, text, label) of a bounded sample of labelled rows, written once."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("id").isNotNull())
    known = known.where(F.coalesce(allowed, F.lit(False)))
    some = known.where(hashed_share(F.col("id"), known.count(), SAMPLE_ROWS))
    some = some.groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(F.col("text").isNotNull())
    checkpoint_dir(docs.sparkSession)
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(10))
    # One text a label row, whatever the number of rows with its identifier: the one with the least hash.
    one = texts.join(F.broadcast(some), "id").groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select(part.alias("part"), F.col("t.text").alias("text"), "label").checkpoint()


def _lexicon(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings with their log odds for toxic documents."""

    def spell(batches):
        for batch in slices(batches):
            out: dict[tuple, None] = {}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                distinct = set(words_of(text))
                if not distinct:
                    continue
                alike = min(map(xxhash.xxh3_64_intdigest, distinct)) >> 1
                out.update(((w, 0, label, alike), None) for w in distinct if len(w) <= 40)
                out.update(((b, 1, label, alike), None) for b in {w[:BEGIN] for w in distinct if len(w) >= BEGIN})
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.int32()),
                    pa.array([k[3] for k in keys], pa.int64()),
                ],
                names=["item", "kind", "label", "alike"],
            )

    seen = rows.select("text", "label").mapInArrow(spell, "item string, kind int, label int, alike long").distinct()
    counts = seen.groupBy("item", "kind").agg(
        F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") > 0, 0).otherwise(1)).alias("good")
    )
    totals = {r["label"]: r["n"] for r in rows.groupBy(F.when(F.col("label") > 0, 1).otherwise(0).alias("label")).agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}, {}
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    spread = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    counts = counts.withColumn("odds", odds).where(F.col("bad") >= max(3, bad // 100))
    counts = counts.where((F.col("odds") >= 1.5) & (F.col("odds") >= 2.5 * spread))
    kept = counts.orderBy(F.desc("odds"), F.desc("bad"), "item", "kind").limit(LEXICON).collect()
    return {r["item"]: r["odds"] for r in kept if r["kind"] == 0}, {r["item"]: r["odds"] for r in kept if r["kind"] == 1}


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on labelled rows whose ``allowed`` (an expression over the label rows' ``id``) holds."""
    rows = _labelled(docs, labels, F.lit(True) if allowed is None else allowed, id_col, text_col)
    lexicon, begins = _lexicon(rows.where("part < 5"))

    def dense(batches):
        for batch in slices(batches):
            x = [features(t, lexicon, begins) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["part", "label", "x"])

    got = rows.where("part >= 5").mapInArrow(dense, "part long, label int, x array<double>").collect()
    got.sort(key=lambda r: (r["part"], r["label"], r["x"]))  # one order whatever the partitions
    x = np.array([r["x"] for r in got]).reshape(len(got), len(NAMES))
    y = np.array([float(r["label"] > 0) for r in got])
    fold = np.array([r["part"] < 8 for r in got], bool)
    trees = boosting.fit_trees(x[fold], y[fold])
    calibrate = boosting.fit_isotonic(trees.margin(x[~fold]), y[~fold])
    return Model(lexicon, begins, trees, calibrate)


def scores(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, with its score."""
    rows = carried(docs, keep, text_col)

    def score(batches):
        for batch in carried_slices(batches):
            found = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.float64())], names=["row", "score"])

    return rows.mapInArrow(score, rows.select("row").schema.add("score", "double"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``most``, with its columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return scores(docs, model, text_col).where(F.col("score") < most).select("row.*")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, id_bucket(F.col("id"), 5) != 0)
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = scores(docs, model, keep=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
