"""Language of a text: known words by log frequency, unseen words by ever shorter character n-grams.

The model is fitted on a bounded sample of at most about ``SAMPLE_ROWS`` rows with a language and keeps the
``WORDS`` most frequent words and the ``GRAMS`` most frequent n-grams of each length, so it may be broadcast
whatever the corpus size. A word of a text adds its log frequency in each language if the model knows it.
Otherwise its character n-grams (with word borders) of length 4 are looked up; each one not found is replaced by the mean
of its own n-grams of length 3, each of those not found by its n-grams of length 2, and so on down to single letters.

Every distinct word of a text counts once for each time it occurs. The score is the share of the
chosen language among the mean evidence per word, softened for very short texts.

Defined results: null, empty and letterless texts give ``und`` with score 0; ties go to the
first language in order of name; without a learnable row every text is ``und``; repeated rows each get a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.samples import hashed_share, id_bucket
from tickforge.llm.words import slices
from tickforge.session import checkpoint_dir

SAMPLE_ROWS = 8_000
WORDS = 20_000
GRAMS = 8_000
LONGEST = 4
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
CACHE = 300_000


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between border signs; of length 1 its letters."""
    if n == 1:
        return list(word)
    framed = f"^{word}$"
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; signs such as a raised two are no letters."""
    found = WORD.findall(text.lower())
    return [x for w in found if (x := w if w.isalpha() else "".join(filter(str.isalpha, w)))]


def _mean(rows: list[list[float]]) -> list[float]:
    return [sum(column) / len(rows) for column in zip(*rows, strict=True)]


class Model:
    """Log frequencies by language for words and n-grams."""

    def __init__(self, languages: list[str], tables: list[dict[str, tuple]], floors: list[tuple], prior: np.ndarray):
        self.languages, self.tables, self.floors, self.prior = languages, tables, floors, prior
        self.index: dict[str, int] = {}
        self.pieces: dict[str, list[float]] = {}
        self.rows = np.zeros((0, len(languages)))

    def _piece(self, gram: str) -> list[float]:
        """Evidence of one n-gram, from its own shorter n-grams if it is not known."""
        found = self.pieces.get(gram)
        if found is None:
            found = self.tables[len(gram)].get(gram)
            if found is None:
                parts = [p for p in (gram[:-1], gram[1:]) if p not in ("", "^", "$")]
                found = _mean([self._piece(p) for p in parts]) if parts else list(self.floors[1])
            self.pieces[gram] = found
        return found

    def _backed_off(self, word: str) -> list[float]:
        """Evidence of an unseen word: the mean of its longest n-grams, each backed off by itself."""
        return _mean([self._piece(g) for g in grams(word, min(LONGEST, len(word) + 2))])

    def word(self, word: str) -> list[float]:
        """Evidence of one word, relative to the mean over languages."""
        known = self.tables[0].get(word) or self._backed_off(word)
        mean = sum(known) / len(known)
        return [x - mean for x in known]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of every text."""
        words = [words_of(t) if t else [] for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        new = list(set().union(*words).difference(self.index))
        if len(self.index) + len(new) > CACHE:
            self.index, self.rows, self.pieces = {}, self.rows[:0], {}
            new = list(set().union(*words))
        if new:
            self.rows = np.concatenate([self.rows, np.array([self.word(w) for w in new])])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        out = []
        for found in words:
            if not found:
                out.append((UNKNOWN, 0.0))
                continue
            mean = self.rows[np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))].mean(axis=0)
            # Words of a text depend on each other: let the evidence grow ever more slowly with their number.
            evidence = self.prior + mean * min(len(found), 8 * math.sqrt(len(found)))
            share = np.exp(evidence - evidence.max())
            best = int(np.argmax(evidence))
            out.append((self.languages[best], float(share[best] / share.sum())))
        return out


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> Model:
    """Learns from a bounded sample of the rows of ``docs`` that have a text and a language."""
    rows = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang"), docs[key_col].alias("key"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.where(hashed_share(F.col("key"), rows.count(), SAMPLE_ROWS))

    def spell(batches):
        for batch in slices(batches):
            counts: Counter = Counter()
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                counts[(lang, -1, "")] += 1
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, by_word in words.items():
                for word, n in by_word.items():
                    counts[(lang, 0, word)] += n
                    for size in range(1, LONGEST + 1):
                        for g in grams(word, size):
                            counts[(lang, size, g)] += n
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([k[2] for k in keys], pa.string()),
                    pa.array([counts[k] for k in keys], pa.int64()),
                ],
                names=["lang", "size", "item", "n"],
            )

    counts = rows.mapInArrow(spell, "lang string, size int, item string, n long").groupBy("lang", "size", "item").agg(F.sum("n").alias("n"))
    checkpoint_dir(docs.sparkSession)
    counts = counts.checkpoint()
    by_item = counts.groupBy("size", "item").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    sums = counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    total = {(r["lang"], r["size"]): r["n"] for r in sums}
    languages = sorted({r["lang"] for r in sums})
    if not languages:
        return Model([], [], [], np.zeros(0))
    tables, floors = [], []
    for size in range(LONGEST + 1):
        most = WORDS if size == 0 else GRAMS
        kept = by_item.where((F.col("size") == size) & (F.col("total") >= (2 if size == 0 else 1)))
        kept = kept.orderBy(F.desc("total"), "item").limit(most).collect()
        whole = np.array([total.get((g, size), 0) for g in languages], float)
        floors.append(tuple(np.log(0.5 / (whole + most)).tolist()))
        seen = np.array([[r["by"].get(g, 0) for g in languages] for r in kept], float).reshape(len(kept), len(languages))
        logs = np.log((seen + 0.5) / (whole + most)).tolist()
        tables.append({r["item"]: tuple(x) for r, x in zip(kept, logs, strict=True)})
    rows_of = np.array([total.get((g, -1), 0) for g in languages], float)
    return Model(languages, tables, floors, np.log((rows_of + 1) / (rows_of.sum() + len(languages))))


def predictions(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, with lang_pred and score."""
    rows = docs.select(F.struct(*(docs[c] for c in (docs.columns if keep is None else keep))).alias("row"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS + LONGEST * GRAMS entries at most

    def predict(batches):
        known = shared.value
        for batch in batches:
            got = []
            for part in slices([batch], most=1 << 20):
                got += known.predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return rows.mapInArrow(predict, rows.select("row").schema.add("lang_pred", "string").add("score", "double"))


def query(docs: DataFrame) -> DataFrame:
    held_out: Column = F.coalesce(id_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit(docs.where(~held_out))
    got = predictions(docs, model, keep=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
