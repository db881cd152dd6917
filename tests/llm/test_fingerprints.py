import hashlib
import math
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tickforge.llm import fingerprints


def xx(value, seed=42):
    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    out = xxhash.xxh64_intdigest(raw, seed)
    return out - 2**64 if out >= 2**63 else out


def offer(term, weight, k):
    """The definition, number by number."""
    one, two = (xx(2 * k + i, xx(term) % 2**64) % 2**64 for i in range(2))
    low = 2**25 - 1
    u = [((x >> s & low) + 0.5) / 2**25 for x in (one, two) for s in (0, 25)]
    b = ((one >> 50) * 2**14 + (two >> 50) + 0.5) / 2**28
    r, c = -math.log(u[0] * u[1]), -math.log(u[2] * u[3])
    t = math.floor(math.log(weight) / r + b)
    return math.log(c) - r * (t - b + 1)


def brute_sample(text, samples):
    words = Counter(w for w in text.lower().replace("\t", " ").replace("\n", " ").split(" ") if w)
    terms = {xx(w): n for w, n in words.items()}
    return [min(terms, key=lambda h: offer(h, terms[h], k)) if terms else None for k in range(samples)], terms


def brute_rows(docs, samples):
    docs = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        near = []
        for other in (edited, after):
            (a, ta), (b, tb) = brute_sample(text, samples), brute_sample(other, samples)
            if not ta or not tb:
                near.append(float(not ta and not tb))
                continue
            near.append(sum(x == y and offer(x, ta[x], k) == offer(y, tb[y], k) for k, (x, y) in enumerate(zip(a, b))) / samples)
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *near)
    return out


@pytest.mark.parametrize("block_rows", [4, 1024])
def test_against_definition(spark, documents, block_rows):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()][:60]
    docs += [(5000, None), (5001, ""), (5002, "\n \t"), (5003, "été 你好 \U0001f600 naïve"), (5004, "été 你好 \U0001f600 naïve")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = fingerprints.neighbours(frame, samples=16, block_rows=block_rows).collect()
    want = brute_rows(docs, 16)
    assert {r["id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got} == want
    prints = {r["id"]: r["fingerprint"] for r in got}
    assert prints[5003] == prints[5004] != "" and prints[5000] == prints[5002] == ""


def test_blocks_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "FAN", 4)
    monkeypatch.setattr(fingerprints, "MAX_BLOCKS", 16)
    frame = spark.range(0, 900, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    rows = fingerprints.with_next(frame, "doc_id", "text", 20).where("not guest").collect()
    assert len({r["block"] for r in rows}) > 4
    assert {r["id"]: r["next_text"] for r in rows} == {i: f"w{i - 3 if i else 897}" for i in range(0, 900, 3)}


def test_collision_rate_is_generalised_jaccard(spark):
    a, b = {"x": 3, "y": 1, "z": 4, "only": 2}, {"x": 1, "y": 5, "z": 4, "other": 1}
    texts = [" ".join(w for w, n in t.items() for _ in range(n)) for t in (a, b)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["sample"] for r in fingerprints.signatures(frame, ["id"], "text", 600).collect()}
    share = sum(x == y for x, y in zip(got[0], got[1])) / 600
    keys = a.keys() | b.keys()
    truth = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    assert abs(share - truth) < 4 * math.sqrt(truth * (1 - truth) / 600)


def test_odd_tables(spark, odd_docs, no_docs):
    got = fingerprints.query(odd_docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    ones = [r["fingerprint"] for r in rows if r["doc_id"] == 1]
    assert len(ones) == 2 and ones[0] == ones[1]
    assert fingerprints.query(no_docs).count() == 0
    alone = fingerprints.query(odd_docs.where("doc_id = 8")).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"shosh").hexdigest()
