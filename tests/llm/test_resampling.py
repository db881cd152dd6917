import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickforge.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, most):
    words = WORD.findall(lowered(text))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, buckets, most, percent, least):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counts.update(map(bucket, features(text, most)[0]))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        fs, n = features(text, most)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(bucket, fs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


@pytest.mark.parametrize(("buckets", "most", "percent", "size"), [(10_000, 1, 10, 65_536), (500, 3, 40, 50)])
def test_against_brute_force(spark, documents, sf_dir, monkeypatch, buckets, most, percent, size):
    monkeypatch.setattr(resampling, "DICTIONARY", size)  # words outside the dictionary must count alike
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    docs += [(9001, None), (9002, ""), (9003, "--"), (9004, "Été naïve 你好 x\x00y \U0001f600a " * 30)]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = resampling.resample(frame, bench, buckets=buckets, most=most, percent=percent)
    got = sorted(((r["id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()))
    assert got == brute(docs, [r.text for r in bench.collect()], buckets, most, percent, 20)


def test_sums_of_joined_strings():
    pairs = [(b"a", b"b"), (b"", b"xyz"), ("é".encode(), b"q" * 300), (b"word " * 9, b"\x00")]
    first, second = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint32) for i in (0, 1))
    got = resampling.Shift.joined(first, second, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_words_of_neighbouring_texts_stay_apart():
    known = resampling.Dictionary([b"ab", b"cd"])
    runs = resampling.Runs(pa.array(["ab", "cd", None, "ab cd"]), known, 10_000, 2)
    assert runs.words.tolist() == [1, 1, 0, 2]
    assert runs.rows[1].tolist() == [3] and runs.buckets[1].tolist() == [zlib.crc32(b"ab cd") % 10_000]


def test_odd_tables(spark, odd_docs, no_docs, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = resampling.query(odd_docs, bench)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got.count() == odd_docs.count()
    assert resampling.query(no_docs, bench).count() == 0
    assert resampling.query(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_ties_go_to_the_smaller_identifier(spark):
    rows = spark.createDataFrame([(i, 5 if i < 30 else 9, True) for i in range(40)], "id long, score long, ok boolean").repartition(5)
    from pyspark.sql import functions as F

    got = {r["id"]: r["rank"] for r in resampling.drawn(rows, F.col("ok"), 50).collect()}
    assert [i for i, _ in sorted(((i, r) for i, r in got.items() if r), key=lambda x: x[1])] == [*range(30, 40), *range(10)]
