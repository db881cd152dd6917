"""Collocations of two to four words from a weighted de Bruijn graph.

Texts are split at punctuation and line ends into pieces, pieces at blanks and tabs into words. Nodes of the graph are
runs of three words, edges runs of four; an edge joins the node of its first three words to that of its last three
and weighs as often as it occurs. Only the longest run that starts at each place is counted: four words, or fewer
where the piece ends (the piece-end corrections). All shorter counts are flows: a run of j words occurs as often as
all counted runs that begin with it.

A node is unary when one edge brings all its flow and one edge takes all of it. Edges are joined at unary nodes into
paths (by pointer doubling; a path is at most as long as a piece) that keep one weight and the flow of both end
nodes. Inside a path the counts of four- and three-word parts equal the weight, so paths give the candidates of four
words with their outer parts, and unary nodes are never candidates themselves.

Runs that cannot reach ``least`` are left out before they are shuffled: a sketch of fixed size (one counter a hash,
counts of words, pairs and triples, stopped at ``least``) never underrates, so what is below ``least`` in it is in
no candidate and in no part of one. Runs end there for the graph. The sketch saves work only; counts are exact. On
corpora that fill it (hundreds of words a counter) it leaves out little, and each place sends one run.

All sums, joins and ranks are keyed by language and phrase; single words, the hot keys, are answered by a broadcast of
the ``TOP_WORDS`` most frequent ones first. The best of a language are found in ``SHARES`` shares of its phrases
first, so its last rank sees ``SHARES * best`` rows.

Defined results: null texts count as empty; null language as ``und``; identifiers are not used; repeated rows count
each; a table without frequent phrases gives no rows. Words are case-folded in A-Z only.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.words import STEP, mix, slices
from tickforge.session import checkpoint_dir

LEAST = 30
BEST = 2000
INSIDE = 80  # percent of a phrase's occurrences inside a longer one from which it is dropped
LONGEST = 4
WORD_COUNTERS = 1 << 22
PAIR_COUNTERS = 1 << 23
TRIPLE_COUNTERS = 1 << 24
SIZE = WORD_COUNTERS + PAIR_COUNTERS + TRIPLE_COUNTERS
BATCH_BYTES = 4 << 20
SLOT = 1 << 14
TOP_WORDS = 65_536
SHARES = 64

ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Lower-cases A-Z; tabs become blanks, piece ends line ends.
MARKED = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class Words:
    """Words of some texts: ``code`` into ``distinct``, language number, hash, and whether the next word is in the same piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        parts = [(t or b"").translate(MARKED) for t in texts.cast(pa.binary()).to_pylist()]
        line = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
        after = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
        del parts
        gap = (line == 32) | (line == 10)
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        letters = np.ascontiguousarray(line[~gap])
        flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        coded = flat.dictionary_encode()
        self.distinct, self.code = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        piece = np.cumsum(line == 10)[starts]
        self.same = np.concatenate([piece[1:] == piece[:-1], [False]])[: len(starts)]
        named = pc.fill_null(langs, "und").dictionary_encode()
        self.langs, lang = named.dictionary, np.asarray(named.indices).astype(np.int64)
        self.lang = lang[np.searchsorted(after, starts, side="left")]
        word = np.array([xxhash.xxh3_64_intdigest(w) for w in self.distinct.cast(pa.binary()).to_pylist()], np.uint64)
        tongue = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs.cast(pa.binary()).to_pylist()], np.uint64)
        self.hash = mix(word[self.code] ^ tongue[self.lang]) if len(starts) else np.zeros(0, np.uint64)
        self.word_at = (self.hash % np.uint64(WORD_COUNTERS)).astype(np.int64)
        pair = mix(self.hash * STEP + np.roll(self.hash, -1))
        self.pair_at = (pair % np.uint64(PAIR_COUNTERS)).astype(np.int64) + WORD_COUNTERS
        triple = mix(pair * STEP + np.roll(self.hash, -2))
        self.triple_at = (triple % np.uint64(TRIPLE_COUNTERS)).astype(np.int64) + WORD_COUNTERS + PAIR_COUNTERS
        self.both = self.same & np.concatenate([self.same[1:], [False]])[: len(starts)]


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang"))


def sketch(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> np.ndarray:
    """Packed bits: which counters reach ``least``. Every word or pair that occurs so often has its bit."""
    kind = np.uint8 if least <= 255 else np.uint32

    def count(batches):
        counters = np.zeros(SIZE, kind)
        for batch in slices(batches, most=BATCH_BYTES):
            words = Words(batch.column("text"), batch.column("lang"))
            for places in (words.word_at, words.pair_at[words.same], words.triple_at[words.both]):
                at, n = np.unique(places, return_counts=True)
                counters[at] = np.minimum(counters[at].astype(np.int64) + n, least)
        for slot in np.flatnonzero(counters.reshape(-1, SLOT).any(axis=1)):
            packed = zlib.compress(counters[slot * SLOT : (slot + 1) * SLOT].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([packed], pa.binary())], names=["slot", "counters"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, packed in zip(batch.column("slot").to_pylist(), batch.column("counters"), strict=True):
                part = np.frombuffer(zlib.decompress(packed.as_py()), kind).astype(np.int64)
                total[slot] = np.minimum(total[slot] + part, least) if slot in total else part
        for slot, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([np.packbits(part >= least).tobytes()], pa.binary())], names=["slot", "bits"])

    parts = _texts(docs, text_col, lang_col).mapInArrow(count, "slot int, counters binary").repartition("slot")
    bits = np.zeros(SIZE // 8, np.uint8)
    for r in parts.mapInArrow(add, "slot int, bits binary").collect():  # one bit a counter
        bits[r["slot"] * SLOT // 8 : (r["slot"] + 1) * SLOT // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def longest_runs(words: Words, bits: np.ndarray) -> pa.RecordBatch:
    """(lang, gram, k, c): distinct longest runs of possibly frequent words with their counts, and the words of each language (k = 0)."""

    def may(at: np.ndarray) -> np.ndarray:
        return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

    n, v = len(words.code), len(words.distinct)
    one = may(words.word_at)
    two = np.zeros(n + LONGEST, bool)
    two[:n] = words.same & one & np.concatenate([one[1:], [False]])[:n]
    two[:n][two[:n]] = may(words.pair_at[two[:n]])
    three = np.zeros(n + 1, bool)
    three[:n] = two[:n] & two[1 : n + 1]
    three[:n][three[:n]] = may(words.triple_at[three[:n]])
    size = one.astype(np.int64) + two[:n] + three[:n] + (three[:n] & three[1:])
    # Numbers of pairs within the batch make one exact whole number of each run.
    code = np.concatenate([words.code, np.zeros(LONGEST, np.int64)])
    first = words.lang * v + words.code
    linked = np.flatnonzero(two[:n])
    pairs, numbered = np.unique(first[linked] * v + code[linked + 1], return_inverse=True)
    pair = np.zeros(n + LONGEST, np.int64)
    pair[linked] = numbered
    p = len(pairs)
    at = np.flatnonzero(size)
    k = size[at]
    head = np.where(k >= 2, pair[at], p + first[at])
    tail = np.where(k == 4, pair[at + 2], np.where(k == 3, p + code[at + 2], p + v))
    _, place, count = np.unique(head * (p + v + 1) + tail, return_index=True, return_counts=True)
    at, k = at[place], k[place]
    columns = [words.distinct.take(pa.array(code[at + j], mask=k <= j)) for j in range(LONGEST)]
    gram = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
    total = np.bincount(words.lang, minlength=len(words.langs)) if n else np.zeros(len(words.langs), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([words.langs.take(pa.array(words.lang[at])), words.langs]),
            pa.concat_arrays([gram.cast(pa.string()), pa.array([""] * len(total), pa.string())]),
            pa.array(np.concatenate([k, np.zeros(len(total), np.int64)]).astype(np.int8)),
            pa.array(np.concatenate([count, total]).astype(np.int64)),
        ],
        names=["lang", "gram", "k", "c"],
    )


def _written(rows: DataFrame) -> DataFrame:
    """``rows`` from a table in the checkpoint folder."""
    spark = rows.sparkSession
    place = os.path.join(checkpoint_dir(spark), f"collocations-{uuid.uuid4().hex}")
    rows.write.parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def edges(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, k, c): the graph's edges (k = 4), its piece-end corrections (k < 4) and word totals (k = 0)."""
    bits = docs.sparkSession.sparkContext.broadcast(sketch(docs, least, text_col, lang_col))

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=BATCH_BYTES):
            yield longest_runs(Words(batch.column("text"), batch.column("lang")), bits.value)

    runs = _texts(docs, text_col, lang_col).mapInArrow(count, "lang string, gram string, k tinyint, c long")
    out = _written(runs.groupBy("lang", "gram", "k").agg(F.sum("c").alias("c")))
    bits.unpersist()
    return out


def _first(words: int, phrase: str = "phrase") -> Column:
    return F.substring_index(phrase, " ", words)


def _last(words: int, phrase: str = "phrase") -> Column:
    return F.substring_index(phrase, " ", -words)


def flows(graph: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, k, f): all runs of one to four words that occur ``least`` times, counted as flows."""
    parts = [graph.where("k = 4").select("lang", F.col("gram").alias("phrase"), F.lit(4).alias("k"), F.col("c").alias("f"))]
    for j in range(1, LONGEST):
        flow = graph.where(F.col("k") >= j).groupBy("lang", _first(j, "gram").alias("phrase")).agg(F.sum("c").alias("f"))
        parts.append(flow.select("lang", "phrase", F.lit(j).alias("k"), "f"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole.where(F.col("f") >= least)


def extended(counts: DataFrame) -> DataFrame:
    """Runs of two to four words with best_in and best_out: the greatest count of a run one word longer to the left or right (0: none)."""
    longer = counts.where("k >= 3").select("lang", "k", "phrase", "f")
    sides = F.explode(
        F.array(
            F.struct(F.expr("substring_index(phrase, ' ', k - 1)").alias("part"), F.lit(True).alias("out")),
            F.struct(F.expr("substring_index(phrase, ' ', 1 - k)").alias("part"), F.lit(False).alias("out")),
        )
    ).alias("s")
    best = (
        longer.select("lang", "f", sides)
        .groupBy("lang", F.col("s.part").alias("phrase"))
        .agg(F.max(F.when(F.col("s.out"), F.col("f"))).alias("best_out"), F.max(F.when(~F.col("s.out"), F.col("f"))).alias("best_in"))
    )
    return counts.where("k >= 2").join(best, ["lang", "phrase"], "left").fillna(0, ["best_in", "best_out"])


def paths(runs: DataFrame) -> DataFrame:
    """(lang, phrase, weight): edges of ``extended`` rows joined at unary nodes; the others are paths of one edge."""
    unary = runs.where("k = 3 and best_in = f and best_out = f").select("lang", F.col("phrase").alias("node"))
    edge = runs.where("k = 4").select("lang", F.col("phrase").alias("edge"), F.col("f").alias("weight"))
    into = edge.select("lang", _last(3, "edge").alias("node"), F.col("edge").alias("before"))
    out = edge.select("lang", _first(3, "edge").alias("node"), F.col("edge").alias("after"))
    # A unary node has one edge of its full flow on each side; lesser edges cannot exist beside it.
    links = unary.join(into, ["lang", "node"]).join(out, ["lang", "node"]).select("lang", F.col("after").alias("edge"), F.col("before").alias("to"))
    # ``to`` lies ``far`` edges back on the path; each round doubles the reach until all rows point at heads.
    state = _written(links.withColumn("far", F.lit(1)))
    moved = not state.isEmpty()
    while moved:
        ahead = state.select("lang", F.col("edge").alias("to"), F.col("to").alias("next"), F.col("far").alias("more"))
        reach = F.col("far") + F.coalesce("more", F.lit(0))
        state = state.join(ahead, ["lang", "to"], "left").select(
            "lang", "edge", F.coalesce("next", "to").alias("to"), reach.alias("far"), F.col("next").isNotNull().alias("moved")
        )
        state = _written(state)
        moved = not state.where("moved").isEmpty()
    whole = edge.join(state.select("lang", "edge", "to", "far"), ["lang", "edge"], "left")
    whole = whole.select("lang", "edge", "weight", F.coalesce("to", "edge").alias("head"), F.coalesce("far", F.lit(0)).alias("far"))
    grouped = whole.groupBy("lang", "head").agg(
        F.max("weight").alias("weight"), F.array_sort(F.collect_list(F.struct("far", _last(1, "edge").alias("word")))).alias("ends")
    )
    rest = F.slice(F.col("ends.word"), F.lit(2), F.size("ends"))
    return grouped.select("lang", F.concat_ws(" ", "head", rest).alias("phrase"), "weight")


def candidates(counts: DataFrame, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, k, a, pre, suf): phrases of two to four words that no longer one covers.

    ``pre`` and ``suf`` are the counts of the first and last three words of a phrase of four.
    """
    runs = _written(extended(counts))
    share = F.greatest("best_in", "best_out").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * inside
    none = F.lit(None).cast("long")
    short = runs.where((F.col("k") < LONGEST) & ~share).select("lang", "phrase", "k", F.col("f").alias("a"), none.alias("pre"), none.alias("suf"))
    nodes = counts.where("k = 3").select("lang", F.col("phrase").alias("node"), "f")
    path = paths(runs).withColumns({"begins": _first(3), "ends": _last(3)})
    path = path.join(nodes.select("lang", F.col("node").alias("begins"), F.col("f").alias("first_flow")), ["lang", "begins"])
    path = path.join(nodes.select("lang", F.col("node").alias("ends"), F.col("f").alias("last_flow")), ["lang", "ends"])
    words = path.select("lang", "weight", "first_flow", "last_flow", F.split("phrase", " ").alias("words"))
    last = F.size("words") - LONGEST
    at = words.select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    whole = at.select(
        "lang",
        F.array_join(F.slice("words", F.col("i") + 1, F.lit(LONGEST)), " ").alias("phrase"),
        F.lit(LONGEST).alias("k"),
        F.col("weight").alias("a"),
        F.when(F.col("i") == 0, F.col("first_flow")).otherwise(F.col("weight")).alias("pre"),
        F.when(F.col("i") == last, F.col("last_flow")).otherwise(F.col("weight")).alias("suf"),
    )
    return short.union(whole)


def scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with l, r and score of the lowest cut."""
    word, pair = F.lit(1), F.lit(2)
    need = F.array(
        F.struct(F.lit("w").alias("name"), word.alias("k"), _first(1).alias("part")),
        F.struct(F.lit("v").alias("name"), word.alias("k"), _last(1).alias("part")),
        F.struct(F.lit("ww").alias("name"), pair.alias("k"), _first(2).alias("part")),
        F.struct(F.lit("vv").alias("name"), pair.alias("k"), _last(2).alias("part")),
    )
    asked = found.select("*", F.explode(F.when(F.col("k") == 2, F.slice(need, 1, 2)).otherwise(need)).alias("n")).select(
        *found.columns, F.col("n.name").alias("name"), F.col("n.k").alias("size"), F.col("n.part").alias("part")
    )
    known = counts.where("k <= 2").select("lang", F.col("phrase").alias("part"), F.col("k").alias("size"), F.col("f").alias("told"))
    # The hot keys: a fixed number of single words. Any other has at most 1 / TOP_WORDS of all words.
    top = known.where("size = 1").orderBy(F.desc("told"), "lang", "part").limit(TOP_WORDS)
    first = asked.join(F.broadcast(top), ["lang", "part", "size"], "left")
    rest = first.where("told is null").drop("told").join(known, ["lang", "part", "size"])
    told = first.where("told is not null").unionByName(rest)
    parts = told.groupBy(*found.columns).agg(*(F.max(F.when(F.col("name") == n, F.col("told"))).alias(n) for n in ("w", "v", "ww", "vv")))

    def cut(at: int, left: str, right: str) -> Column:
        score = F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast({left} as decimal(20,0)) + cast({right} as decimal(20,0)))")
        return F.struct(score.alias("score"), F.lit(at).alias("cut"), F.col(left).alias("l"), F.col(right).alias("r"))

    lowest = (
        F.when(F.col("k") == 2, cut(1, "w", "v"))
        .when(F.col("k") == 3, F.least(cut(1, "w", "vv"), cut(2, "ww", "v")))
        .otherwise(F.least(cut(1, "w", "suf"), cut(2, "ww", "vv"), cut(3, "pre", "v")))
    )
    return parts.select("lang", "phrase", "a", lowest.alias("low")).select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, best: int = BEST, inside: int = INSIDE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    graph = edges(docs, least, text_col, lang_col)
    counts = _written(flows(graph, least))
    rows = scored(candidates(counts, inside), counts)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = rows.withColumn("share", share)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= best)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    totals = graph.where("k = 0").select("lang", F.col("c").alias("n"))  # one row a language
    return last.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?
-
]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda w: w <> '') AS ws FROM pieces
), totals AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM lists GROUP BY lang
), runs AS (
  SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM lists WHERE len(ws) > 0
), grams AS (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, count(*)::BIGINT AS f
  FROM runs, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
), often AS (
  SELECT lang, phrase, k, f, string_split(phrase, ' ') AS ws FROM grams WHERE f >= 30
), covered AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM often s JOIN (
    SELECT lang, k, f, p, array_to_string(list_slice(ws, i, i + p - 1), ' ') AS part
    FROM often, (VALUES (2), (3)) AS parts(p), (VALUES (1), (2), (3)) AS places(i) WHERE p < k AND i + p - 1 <= k
  ) g ON g.lang = s.lang AND g.part = s.phrase
  WHERE 100 * g.f::HUGEINT >= 80 * s.f::HUGEINT
), cuts AS (
  SELECT o.lang, o.phrase, o.f AS a, c, array_to_string(o.ws[1:c], ' ') AS lp, array_to_string(o.ws[c + 1:], ' ') AS rp
  FROM often o, (VALUES (1), (2), (3)) AS sizes(c)
  WHERE o.k >= 2 AND c < o.k AND NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = o.lang AND v.phrase = o.phrase)
), valued AS (
  SELECT t.lang, t.phrase, t.a, t.c, x.f AS l, y.f AS r, ((2000000 * t.a::HUGEINT) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts t JOIN grams x ON x.lang = t.lang AND x.phrase = t.lp JOIN grams y ON y.lang = t.lang AND y.phrase = t.rp
), lowest AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
)
SELECT p.lang, row_number() OVER (PARTITION BY p.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest p JOIN totals t ON t.lang = p.lang QUALIFY rank <= 2000
"""


def query(docs: DataFrame) -> DataFrame:
    return mine(docs)
