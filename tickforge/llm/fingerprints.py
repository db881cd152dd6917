"""Document fingerprints by consistent weighted sampling; DataFrame functions only.

The terms of a text are its lower-cased words (runs of characters other than white space), weighted by how often
they occur. For each of ``SAMPLES`` positions every term draws r and c from Gamma(2, 1) and b from (0, 1), all from
hashes of the term and the position alone. With t = floor(ln(weight) / r + b), the text's sample is the term with the
smallest value of ln c - r (t - b + 1). Two texts share a sample with a probability equal to the generalised Jaccard
similarity of their weights (sum of minima over sum of maxima). That value is a function of the term and t, so equal
values stand for equal samples, and a fingerprint is the list of smallest values, eight hex digits each.

Neighbours in identifier order need each other's texts: ``with_next`` cuts the identifiers into blocks at sampled
splitters (equal shares of the rows), sends every text once to its block and the first row of a block to the block
before it as well, so one exchange of texts serves neighbours, terms and samples. Nothing is collected but the
splitters, at most ``MAX_BLOCKS`` numbers.

Defined results: null counts as empty; a text without words has an empty fingerprint, which is like another empty one
(1.0) and unlike all others (0.0); null identifiers come last in descending order; rows with one identifier follow
each other in the order of their texts' hashes; the only row of a table is its own next one; an empty table gives
no rows. Identifiers are whole numbers. Columns named like the operator's own do no harm: only two are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 24
BLOCK_ROWS = 1024
FAN = 256
MAX_BLOCKS = FAN * FAN
PIECE = 25  # bits of each uniform number
SPACES = r"[\x20\x09-\x0D]+"


def sample_value(position: int) -> str:
    """What columns (term, log_weight) offer at one position, as SQL; the smallest offer of a text is its sample."""
    one, two = (f"xxhash64(term, {2 * position + i}L)" for i in range(2))
    unit, rest = 1 << PIECE, 64 - 2 * PIECE

    def product(bits: str) -> str:
        """Product of two numbers in (0, 1) from the low bits of a hash."""
        low, high = (f"(((shiftrightunsigned({bits}, {i * PIECE}) & {unit - 1}L) + 0.5D) / {unit}D)" for i in range(2))
        return f"({low} * {high})"

    # The bits that r and c leave make b.
    b = f"((shiftrightunsigned({one}, {2 * PIECE}) * {1 << rest}L + shiftrightunsigned({two}, {2 * PIECE}) + 0.5D) / {1 << 2 * rest}D)"
    r, log_c = f"(-ln({product(one)}))", f"ln(-ln({product(two)}))"
    return f"{log_c} - {r} * (floor(log_weight / {r} + {b}) - {b} + 1D)"


def _sorted_words(text: Column) -> Column:
    """Hashes of all words in ascending order."""
    words = F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")
    return F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))


def _starts(words: Column) -> Column:
    """Places where a new value begins in a sorted array."""
    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))


def _weighted(words: Column, starts: Column) -> Column:
    """(term, log_weight) of every distinct value."""
    return F.transform(
        starts,
        lambda p, j: F.struct(
            F.get(words, p).alias("term"),
            F.log(F.coalesce(F.get(starts, j + 1), F.size(words)) - p).alias("log_weight"),
        ),
    )


def signatures(rows: DataFrame, keys: list[str], text_col: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``sample``, an array of smallest values (nulls for texts without words).

    Rows are told apart by ``keys``. A partitioning by some of them is kept: no exchange is added then.
    """
    words = rows.select(*keys, _sorted_words(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    starts = words.select(*keys, "words", _starts(F.col("words")).alias("starts"))
    terms = starts.select(*keys, F.explode_outer(_weighted(F.col("words"), F.col("starts"))).alias("t"))
    terms = terms.select(*keys, F.col("t.term").alias("term"), F.col("t.log_weight").alias("log_weight"))
    least = [F.expr(f"min({sample_value(k)}) AS s{k}") for k in range(samples)]
    return terms.groupBy(*keys).agg(*least).select(*keys, F.array(*(f"s{k}" for k in range(samples))).alias("sample"))


def digest(sample: Column) -> Column:
    """Text form of a sample array: eight hex digits a position, empty without words."""
    short = F.transform(sample, lambda s: F.lower(F.lpad(F.hex(F.xxhash64(s).bitwiseAND(0xFFFFFFFF)), 8, "0")))
    return F.when(F.get(sample, F.lit(0)).isNull(), F.lit("")).otherwise(F.array_join(short, ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of positions at which two sample arrays agree."""
    none_a, none_b = F.get(a, F.lit(0)).isNull(), F.get(b, F.lit(0)).isNull()
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    return F.when(none_a & none_b, 1.0).when(none_a | none_b, 0.0).otherwise(same)


def _splitters(ids: DataFrame, block_rows: int) -> list[int]:
    """Identifiers at which blocks begin, descending, the largest first."""
    n, largest = ids.agg(F.count(F.lit(1)), F.max("place")).first()
    blocks = min(MAX_BLOCKS, -(-n // block_rows))
    if blocks < 2:
        return [largest if n else 0]
    marks = F.array(*(F.lit(i / blocks) for i in range(1, blocks)))
    found = ids.agg(F.percentile_approx("place", marks, min(1_000_000, 20 * blocks))).first()[0]
    return sorted({largest, *found}, reverse=True)


def _block(place: Column, splitters: list[int]) -> Column:
    """Number of the block of a row: how many splitters are not below it, less one; found in two steps of ``FAN``."""

    def reached(marks: Column) -> Column:
        return F.size(F.filter(marks, lambda s: s >= place)) - 1

    groups = [splitters[i : i + FAN] for i in range(0, len(splitters), FAN)]
    lists = F.array(*(F.array(*(F.lit(s).cast("long") for s in g)) for g in groups))
    if len(groups) == 1:
        return reached(F.get(lists, F.lit(0)))
    coarse = reached(F.array(*(F.lit(g[0]).cast("long") for g in groups)))
    return coarse * FAN + reached(F.get(lists, coarse))


def with_next(docs: DataFrame, id_col: str, text_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, at, guest, id, text, next_text): every row with the text of the next one in descending identifiers.

    ``at`` numbers the rows of a block. Rows with ``guest`` stand first in the next block and are only there to be seen.
    """
    rows = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(docs[id_col].cast("long"), F.lit(-(2**63))).alias("place"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    splitters = _splitters(rows.select("place"), block_rows)
    rows = rows.withColumn("block", _block(F.col("place"), splitters))
    begins = F.get(F.array(*(F.lit(s).cast("long") for s in splitters)), F.col("block")) == F.col("place")
    # The largest row of all is the guest of the last block.
    homes = F.when(begins, F.array(F.col("block"), F.pmod(F.col("block") - 1, F.lit(len(splitters))))).otherwise(F.array("block"))
    dealt = rows.select("id", "place", "text", F.posexplode(homes).alias("guest", "block"))
    order = Window.partitionBy("block").orderBy("guest", F.desc("place"), F.xxhash64("text"))
    return dealt.select(
        "block",
        F.row_number().over(order).alias("at"),
        (F.col("guest") > 0).alias("guest"),
        "id",
        "text",
        F.lead("text").over(order).alias("next_text"),
    )


def edited_text(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by the first as many code points of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``docs``: id, n_chars, edited_sha256, both fingerprints, near_edited and near_next."""
    rows = with_next(docs, id_col, text_col, block_rows)
    edited = edited_text(F.col("text"), F.col("next_text"))
    about = [F.length("text").cast("long").alias("n_chars"), F.sha2(F.when(~F.col("guest"), edited), 256).alias("edited_sha256")]
    texts = F.when(F.col("guest"), F.array("text")).otherwise(F.array(F.col("text"), edited))
    both = rows.select("block", "at", "guest", "id", *about, F.posexplode(texts).alias("which", "body"))
    found = signatures(both, ["block", "at", "which", "guest", "id", "n_chars", "edited_sha256"], "body", samples)
    # Still in the partitions of the blocks: a row's two samples, then the next row's, without another exchange.
    row = Window.partitionBy("block").orderBy("at", "which")
    ahead = found.select(
        "*", F.lead("sample", 1).over(row).alias("second"), F.lead("sample", 2).over(row).alias("third")
    ).where("which = 0 and not guest")
    return ahead.select(
        "id",
        "n_chars",
        "edited_sha256",
        digest(F.col("sample")).alias("fingerprint"),
        digest(F.col("second")).alias("edited_fingerprint"),
        likeness(F.col("sample"), F.col("second")).alias("near_edited"),
        likeness(F.col("sample"), F.col("third")).alias("near_next"),
    )


def query(docs: DataFrame) -> DataFrame:
    return neighbours(docs).withColumnRenamed("id", "doc_id")
