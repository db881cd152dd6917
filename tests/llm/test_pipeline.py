import corpus_pipeline
from tickforge.llm import toxicity

WORDS = [f"w{i}" for i in range(400)]


def body(start, n=60):
    return " ".join(WORDS[(start * 37 + i * (start % 7 + 1)) % 400] for i in range(n))


def test_without_labels_and_benchmark_only_copies_go(spark, folder, sf_dir):
    near = body(1).split()
    texts = [body(i) for i in range(30)]
    texts += [body(0), body(0) + "  ", " ".join([*near, "tail"]), None, "", "you awful idiot"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    # Exact copies 30 and 31 of 0, the near copy 32 of 1, and the empty text 34 equal to the null one 33.
    assert sorted(r["doc_id"] for r in got) == [*range(30), 33, 35]


def test_nothing_is_toxic_without_labels_of_both_kinds(spark, odd_docs):
    kinds = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(i, 0, 1) for i in range(1, 11)]):
        labels = spark.createDataFrame(rows, kinds)
        assert {(r["score"], r["predicted"]) for r in toxicity.query(odd_docs, labels).collect()} == {(0.0, 0)}
        assert toxicity.keep_clean(odd_docs, labels).count() == odd_docs.count()


def test_a_repeated_identifier_gives_one_text_a_label(spark):
    docs = spark.createDataFrame([(1, f"text {i % 9}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    labels = labels.selectExpr("doc_id", "toxic")
    from pyspark.sql import functions as F

    assert toxicity._labelled(docs, labels, F.lit(True), "doc_id", "text").count() == 1
