import random

import numpy
import pytest

from tickforge.llm import decontamination

SHORT = [(0, "velvet"), (1, "amber quarry"), (2, "nine copper lanterns"), (3, "which river crosses lower vestra today"), (4, "name the metal that melts at the lowest heat of all")]


def prose(r, words, n):
    return " ".join(r.choice(words) for _ in range(n))


def test_verbatim_copies_of_short_and_frequent_items(spark):
    r = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    # The items of prose make nearly all words of the documents terms, rarer ones than those of the frequent item.
    benchmark = [*SHORT, (5, " ".join(f"hot{i}" for i in range(24))), *((10 + i, prose(r, words, 40)) for i in range(20))]
    rows = []
    for i in range(300):
        item = benchmark[5] if i % 3 == 0 else SHORT[i % 5]
        rows.append((i, f"{prose(r, words, 60)} {item[1]} {prose(r, words, 60 + i % 16)}", item[0]))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").repartition(4)
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.query(docs, spark.createDataFrame(benchmark, "item_id long, text string")).collect()}
    assert got >= {(i, item) for i, _, item in rows}
    assert len(got) <= 1.05 * len(rows)


def test_every_place_above_the_cosine_is_checked(spark):
    r = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    benchmark = [(i, " ".join(r.sample(words, 40))) for i in range(20)]
    rows = []
    for i, text in benchmark:
        item = text.split()
        mixed = item[::-1]  # all words of the item in another order: a cosine of one, not a hit
        near = [w if k % 4 else f"changed{k}" for k, w in enumerate(item)]  # three words of four, in order
        gap = [f"other{k}" for k in range(200)]
        rows.append((i, " ".join([*mixed, *gap, *near, *gap, *mixed])))
        rows.append((100 + i, " ".join([*mixed, *gap, *mixed])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.query(docs, spark.createDataFrame(benchmark, "item_id long, text string")).collect()}
    assert got == {(i, i) for i in range(20)}


def test_latent_space_is_of_all_passages(spark):
    """Documents in any order and number fit the same space, from which no passage is left out."""
    r = random.Random(13)
    words = [f"w{i}" for i in range(500)]
    benchmark = spark.createDataFrame([(i, prose(r, words, 30)) for i in range(60)], "id long, text string")
    rows = [(i, prose(r, words, 80)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    again = spark.createDataFrame([(i, " ".join(reversed(t.split()))) for i, t in rows], "doc_id long, text string")
    a, b = decontamination.fit(docs, benchmark), decontamination.fit(again, benchmark)
    assert a.idf.tolist() == b.idf.tolist()
    assert abs(a.space @ a.space.T - b.space @ b.space.T).max() < 1e-3
    tfidf = numpy.array([a.row(w) for _, _, w in a.passages])
    latent = tfidf @ (a.space / a.idf[:, None])
    assert numpy.linalg.norm(latent, axis=1) == pytest.approx(numpy.ones(60), abs=1e-3)
