"""Token counts of whole texts, exactly as the tokenizer library gives them.

Two facts make any split exact. A byte-level BPE splits a text into pre-tokens before it merges, and in
its pattern white space only begins a pre-token or fills one. So a place between a character that is no
white space and a blank, tab or line end is a pre-token start in every encoding: a proven stable boundary.

* Ordinary texts are cut at every such boundary, and the library encodes each distinct piece of a batch once.
* Documents above ``CHUNK`` characters are cut into overlapping chunks that Spark deals out as rows. Each chunk
  is encoded with offsets; the two encodings of an overlap are spliced at a stable boundary which both
  have as a token start. An overlap without one is widened, twice as far each time, to the end of the text
  if need be. Documents whose encodings still disagree are encoded whole.

Nothing of a document is gathered: every overlap adds one difference of counts, and counts are summed.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows are never merged, so repeated
identifiers give one row each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 65_536
OVERLAP = 512
BATCH_CHARS = 1_000_000
CACHE_PIECES = 400_000
LIMIT = 1024

PIECE = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# White space other than the four characters at which pieces are cut; such texts are encoded whole.
OTHER_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
STABLE = re.compile(r"(?<=\S)[ \n\t\r]")


@functools.lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer of a .json file, one thread, no truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_counts(tokenizer, texts: list[str]) -> list[int]:
    """Counts by the library itself, in batches of bounded size."""
    counts: list[int] = []
    batch: list[str] = []
    size = 0
    for text in texts:
        batch.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            counts += [len(e.ids) for e in tokenizer.encode_batch(batch, add_special_tokens=False)]
            batch, size = [], 0
    if batch:
        counts += [len(e.ids) for e in tokenizer.encode_batch(batch, add_special_tokens=False)]
    return counts


class PieceCounter:
    """Counts a text as the sum over its pieces; a bounded cache holds the counts of pieces seen before."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        if OTHER_SPACE.search(text):
            return whole_counts(self.tokenizer, [text])[0]
        pieces = PIECE.findall(text)
        new = list(set(pieces).difference(self.known))
        if new:
            if len(self.known) + len(new) > CACHE_PIECES:
                self.known = {}
                new = list(set(pieces))
            self.known.update(zip(new, whole_counts(self.tokenizer, new), strict=True))
        return sum(map(self.known.__getitem__, pieces))


def chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple[int, int, int, str]]:
    """(number, offset, end of the overlap with the chunk before, text) of overlapping chunks."""
    start, shared_until, number = 0, 0, 0
    while True:
        planned = start + chunk
        if planned >= len(text):
            yield number, start, shared_until, text[start:]
            return
        width = overlap
        while planned + width < len(text) and not STABLE.search(text, planned, planned + width):
            width *= 2
        end = min(len(text), planned + width)
        if end == len(text):
            yield number, start, shared_until, text[start:]
            return
        yield number, start, shared_until, text[start:end]
        start, shared_until, number = planned, end, number + 1


def _starts(offsets: list[tuple[int, int]], text: str, lo: int, hi: int) -> dict[int, int]:
    """Stable boundaries in [lo, hi) that are token starts here, each with the number of tokens before it."""
    first: dict[int, int] = {}
    for i, (a, b) in enumerate(offsets):
        if lo <= a < hi and b > a and a not in first:
            first[a] = i
    # Offsets may leave out the blank that begins a token; the token then starts at the blank.
    found: dict[int, int] = {}
    for m in STABLE.finditer(text, max(lo, 1), hi):
        x = m.start()
        here = first.get(x)
        if here is None:
            here = first.get(x + 1)
        if here is not None:
            found[x] = here
    return found


def _encode_chunk(tokenizer, text: str):
    e = tokenizer.encode(text, add_special_tokens=False)
    return e.offsets, len(e.ids)


def _splice(frame_rows: Iterator[dict], tokenizer) -> Iterator[tuple]:
    """(key, number of the overlap, side, places, counts, total if last) of each chunk."""
    for r in frame_rows:
        offsets, total = _encode_chunk(tokenizer, r["chunk"])
        at, text = r["offset"], r["chunk"]
        if r["number"]:
            found = _starts(offsets, text, 0, r["shared_until"] - at)
            yield r["key"], r["number"], -1, [x + at for x in found], list(found.values()), 0
        if r["next_at"] >= 0:
            found = _starts(offsets, text, r["next_at"] - at, len(text))
            yield r["key"], r["number"] + 1, 1, [x + at for x in found], list(found.values()), 0
        else:
            yield r["key"], -1, 1, [], [], total


def _long_counts(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of long texts; n_tokens is null where two encodings never met."""

    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = list(chunks(text, chunk, overlap))
                for i, (number, at, shared, part) in enumerate(parts):
                    after = parts[i + 1][1] if i + 1 < len(parts) else -1
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": pa.array([key], pa.string()),
                            "number": pa.array([number], pa.int64()),
                            "offset": pa.array([at], pa.int64()),
                            "shared_until": pa.array([shared], pa.int64()),
                            "next_at": pa.array([after], pa.int64()),
                            "chunk": pa.array([part], pa.string()),
                        }
                    )

    def encode(batches):
        tokenizer = load(path)
        for batch in batches:
            out = list(_splice(iter(batch.to_pylist()), tokenizer))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.string()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.int32()),
                    pa.array([r[3] for r in out], pa.list_(pa.int64())),
                    pa.array([r[4] for r in out], pa.list_(pa.int64())),
                    pa.array([r[5] for r in out], pa.int64()),
                ],
                names=["key", "number", "side", "places", "counts", "total"],
            )

    parts = rows.select("key", "text").mapInArrow(
        cut, "key string, number long, offset long, shared_until long, next_at long, chunk string"
    )
    sides = parts.repartition("key", "number").mapInArrow(
        encode, "key string, number long, side int, places array<long>, counts array<long>, total long"
    )
    # Left and right encoding of one overlap meet in one small group of two rows.
    meet = sides.groupBy("key", "number").agg(
        F.max(F.when(F.col("side") == 1, F.struct("places", "counts"))).alias("l"),
        F.max(F.when(F.col("side") == -1, F.struct("places", "counts"))).alias("r"),
        F.sum("total").alias("total"),
    )
    common = F.array_min(F.array_intersect("l.places", "r.places"))
    place = F.when(F.col("number") == -1, F.lit(-1)).otherwise(common)
    left = F.element_at("l.counts", F.array_position("l.places", F.col("place")).cast("int"))
    right = F.element_at("r.counts", F.array_position("r.places", F.col("place")).cast("int"))
    part = F.when(F.col("number") == -1, F.col("total")).when(F.col("place").isNotNull(), left - right)
    return (
        meet.withColumn("place", place)
        .select("key", part.alias("part"))
        .groupBy("key")
        .agg(F.when(F.count("part") == F.count(F.lit(1)), F.sum("part")).alias("n_tokens"))
    )


def token_counts(
    docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, with n_bytes and n_tokens.

    Long rows meet their counts by a key made of their position-free content: text hash and length, so
    equal long texts are encoded once.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.struct(*(docs[c] for c in (docs.columns if keep is None else keep))).alias("row"), text.alias("text"))
    is_long = F.length("text") > chunk

    def short(batches):
        counter = PieceCounter(load(path))
        for batch in batches:
            texts = batch.column("text")
            counts = pa.array([counter.count(t.as_py()) for t in texts], pa.int64())
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), sizes, counts], names=["row", "n_bytes", "n_tokens"])

    schema = rows.select("row").schema.add("n_bytes", "long").add("n_tokens", "long")
    near = rows.where(~is_long).mapInArrow(short, schema)
    keyed = rows.where(is_long).withColumn("key", F.concat_ws(":", F.sha2("text", 256), F.length("text").cast("string")))
    far_counts = _long_counts(keyed.dropDuplicates(["key"]), path, chunk, overlap)

    def encode_whole(batches):
        tokenizer = load(path)
        for batch in batches:
            counts = whole_counts(tokenizer, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64())], names=["key", "again"])

    failed = far_counts.where("n_tokens IS NULL").select("key")
    again = keyed.join(failed, "key", "left_semi").select("key", "text").dropDuplicates(["key"]).mapInArrow(
        encode_whole, "key string, again long"
    )
    far = (
        keyed.select("key", "row", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(far_counts, "key", "left")
        .join(again, "key", "left")
        .select("row", "n_bytes", F.coalesce("n_tokens", "again").alias("n_tokens"))
    )
    return near.unionByName(far)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
