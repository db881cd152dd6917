import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickforge.llm import boosting, decontamination, html_extract, html_nodes, language_id, lm_scoring, mixing, toxicity


def test_trees_learn_and_calibrate():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit_trees(x[:1500], y[:1500])
    assert ((trees.margin(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.95
    score = boosting.fit_isotonic(trees.margin(x[:1500]), y[:1500])(np.sort(trees.margin(x)))
    assert (np.diff(score) >= 0).all() and 0 <= score.min() and score.max() <= 1
    assert boosting.fit_trees(np.zeros((0, 4)), np.zeros(0)).margin(x).std() < 1e-9
    assert boosting.fit_trees(x, np.ones(2000)).margin(x).std() < 1e-9


def labels_of(spark, docs, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_toxicity_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.query(docs, labels).collect()
    assert len(got) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    tested = [(r["predicted"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert sum(a == b for a, b in tested) / len(tested) > 0.85


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, None), (8, None, 1), (None, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.query(odd_docs, labels).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert toxicity.query(no_docs, labels).count() == 0
    assert toxicity.query(odd_docs, labels.limit(0)).count() == 13
    assert toxicity.keep_clean(odd_docs, labels).columns == odd_docs.columns


def test_languages(spark, documents, odd_docs, no_docs):
    known = {r["doc_id"]: r["lang"] for r in documents.collect()}
    got = language_id.query(documents).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) / len(held) > 0.95
    odd = {r["doc_id"]: r for r in language_id.query(odd_docs).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (3, 4, 5, 10)) and odd[8]["lang_pred"] == "en"
    assert language_id.query(no_docs).count() == 0
    nothing = language_id.query(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == 13 and {r["lang_pred"] for r in nothing} == {"und"}


def test_unseen_words_back_off(spark):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("schmecken brauchen", "de"), ("chateau bateau", "fr")] * 4)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.predict(["rauchen"])[0][0] == "de" and model.predict(["gateau"])[0][0] == "fr"


def brute_base(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\0"] for _, t in rows]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 if i is not None else True for i, _ in rows]
    counts = Counter(w for ws, is_train in zip(tokens, train, strict=True) if is_train for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (str(i), not tr, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (i, _), ws, tr in zip(rows, tokens, train, strict=True)
    )


@pytest.mark.parametrize("top", [65_536, 3])
def test_base_scores_are_exact(documents, odd_docs, no_docs, monkeypatch, top):
    monkeypatch.setattr(lm_scoring, "TOP_WORDS", top)
    for docs in (documents, odd_docs) if top > 3 else (odd_docs,):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = lm_scoring.query(docs).collect()
        assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == brute_base(rows)
        assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    if top == 3:
        assert lm_scoring.query(no_docs).count() == 0


def test_filter_never_underrates():
    r = np.random.default_rng(2)
    items, counts = np.unique(r.integers(0, 2**62, 20000)).astype(np.uint64), None
    counts = r.zipf(1.6, len(items)).clip(max=10**6)
    levels = lm_scoring.level_of(counts)
    order = np.argsort(items)
    bits, filled = 3, []
    batch = lm_scoring.packed(lm_scoring.WORD, items[order], counts[order], bits)
    for g in sorted(set(batch.column("g").to_pylist())):
        body = pa.table({"body": [b for b, x in zip(batch.column("body").to_pylist(), batch.column("g").to_pylist()) if x == g]})
        filled += lm_scoring.fill_group((pa.scalar(lm_scoring.WORD), pa.scalar(g)), body).to_pylist()
    sizes = np.zeros(8, np.int64)
    for r in filled:
        sizes[r["g"]] = r["segments"]
        if r["h"]:  # exact counts, large ones too
            got = dict(zip(np.frombuffer(r["h"], np.uint64).tolist(), np.frombuffer(r["c"], np.int64).tolist()))
            assert all(got[int(i)] == int(n) for i, n in zip(items, counts) if int(i) >> 61 == r["g"])

    class Shard:
        def __init__(self, lo, hi):
            self.value = b"".join(r["bits"] for r in filled if lo <= r["g"] < hi)

    kept = lm_scoring.Filter([Shard(0, 5), Shard(5, 8)], sizes, np.array([0, 5]), bits, 0)
    got = kept.levels(items)
    assert (got >= levels).all() and (got == levels).mean() > 0.99
    assert (kept.levels(lm_scoring.mix(items ^ np.uint64(1))) > 0).mean() < 0.01
    value = lm_scoring.COUNT_AT[levels]
    assert (value <= counts * lm_scoring.BASE).all() and (value >= counts / lm_scoring.BASE).all()


def test_subsequence_length():
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randrange(6) for _ in range(r.randint(0, 20))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        assert decontamination.lcs(a, b) == row[-1]


def test_decontamination_finds_items_and_paraphrases(spark, sf_dir, documents, odd_docs, no_docs):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.query(documents, benchmark).collect()}
    assert want <= got and len(got - want) <= 0.1 * len(want) + 1
    r = random.Random(5)
    host = texts[min(texts)].split()
    made = []
    for i, x in items.items():
        words = x.split()
        for k in r.sample(range(len(words)), len(words) // 8):
            words[k] = "changed"
        made.append((i, " ".join(host[:40] + [w.upper() + "!" for w in words] + host[40:80])))
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.query(spark.createDataFrame(made, "doc_id long, text string"), benchmark).collect()}
    assert sum((i, i) in found for i in items) >= 0.9 * len(items)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "short"), (3, "no identifier here at all")], "item_id long, text string")
    assert decontamination.drop_contaminated(odd_docs, odd).columns == odd_docs.columns
    assert decontamination.query(no_docs, benchmark).count() == 0
    assert decontamination.query(odd_docs, benchmark.limit(0)).count() == 0


def test_mixing_meets_its_targets(spark, sf_dir, documents, odd_docs, no_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = mixing.query(documents, labels).collect()
    tokens = {r["doc_id"]: len((r["text"] or "").split()) for r in documents.collect()}
    assert all(r["n_tokens"] == tokens[r["doc_id"]] and r["rate"] >= 0 for r in got)
    total = sum(tokens.values())
    for k, domain in enumerate(got[0]["domains"].split(",")):
        assert abs(sum(r["rate"] * r["n_tokens"] * r["posterior"][k] for r in got) / total - mixing.TARGETS[domain]) < 1e-3
    odd = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (8, None), (1, 0)], "doc_id long, quality int")
    rows = mixing.mixed(odd_docs, mixing.quality_domains(odd), {"1": 0.5, "0": 0.5, "unknown": 3.0})
    assert rows.count() <= 13 and rows.select("row.*").columns == odd_docs.columns
    assert {r["rate"] for r in mixing.query(odd_docs, odd.limit(0)).collect()} == {1.0}
    assert mixing.query(no_docs, odd).count() == 0


def test_rates_are_never_negative(spark):
    rows = [(i, "A B!! " * 50 if i % 2 else f"plain words number {i} in a row", str(i % 2)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, d string")
    labelled = docs.selectExpr("doc_id AS id", "d AS domain")
    mixer, slim = mixing.fit(docs, labelled, {"0": 1.0})
    got = slim.select(mixer.rate(F.col("p")).alias("r"), F.element_at("p", 2).alias("p1")).collect()
    assert all(r["r"] >= 0 for r in got) and max(r["r"] for r in got if r["p1"] > 0.9) < 0.05


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><div class=header><a href=/>Home</a></div>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class=cookie-notice>We use cookies on this site.</div>
<div class="post-body"><h1>A title of some words</h1><p>First   paragraph &amp; more, with <b>bold<br>text</b>.<p>Second one is a good deal longer, so that
it looks like text; it has commas, too.</p><div class="ad">Buy now</div></div><div id=comments><p>A reader says that this is a fine article indeed.</p></div>
<form><label>Mail</label><input><button>Go</button></form><footer>&copy; somebody</footer><script>var t='</p>'</script></body></html>"""


def test_main_text_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r["page_id"]: r["html"] for r in pages.collect()}
    extra = spark.createDataFrame(
        [(-1, "u", PAGE), (-2, "u", None), (-3, None, ""), (-4, "u", "just text & no markup"), (-5, "u", "<p>a<p>b"), (-1, "u", PAGE), (None, "u", "<br><img>"), (-6, "u", "<div>" * 500 + "deep")],
        "page_id long, url string, html string",
    )
    both = pages.select("page_id", "url", "html").unionByName(extra)
    got = {r["page_id"]: r for r in html_extract.query(both).collect()}
    assert html_extract.query(both).count() == len(texts) + 8
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    import html as entities

    def wanted(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", " ", x))).strip() for x in re.split(r"</?(?:h1|p)>", inner))
        return "\n".join(filter(None, blocks))

    assert all(got[i]["text"] == wanted(x) for i, x in texts.items())
    assert got[-1]["text"] == "A title of some words\nFirst paragraph & more, with bold text.\nSecond one is a good deal longer, so that it looks like text; it has commas, too."
    assert got[-2]["text"] == got[-3]["text"] == got[None]["text"] == ""
    assert got[-4]["text"] == "just text & no markup" and got[-5]["text"] == "a\nb"
    assert html_extract.query(extra.limit(0)).count() == 0


def test_built_layouts_hold_out():
    trees = html_extract.fit_pages([])
    layouts = html_extract.Layouts(["some words of a text that go on, and on."], seed=77)
    good = 0
    for _ in range(100):
        nodes = html_nodes.read(layouts.page())
        labels = html_extract.built_labels(nodes)
        want = "\n".join(t for _, t in sorted(run for n, keep in zip(nodes, labels, strict=True) if keep for run in n.runs))
        good += html_extract.decode(nodes, trees.margin(np.array(html_nodes.features(nodes), float))) == want
    assert good >= 90


def test_each_unseen_gram_backs_off_by_itself():
    tables = [{"known": (-1.0, -2.0)}, {"a": (-1.0, -4.0), "b": (-2.0, -2.0)}, {"^a": (-3.0, -1.0)}, {}, {"^abq": (-5.0, -6.0)}]
    model = language_id.Model(["x", "y"], tables, [(-9.0, -9.0)] * 5, np.zeros(2))

    def brute(gram):
        if gram in tables[len(gram)]:
            return np.array(tables[len(gram)][gram])
        parts = [p for p in (gram[:-1], gram[1:]) if p and p not in "^$"]
        return np.mean([brute(p) for p in parts], axis=0) if parts else np.array([-9.0, -9.0])

    for word in ("abq", "ab", "a", "zz", "abqab"):
        framed = f"^{word}$"
        size = min(4, len(framed))
        want = np.mean([brute(framed[i : i + size]) for i in range(len(framed) - size + 1)], axis=0)
        assert np.allclose(model.word(word), want - want.mean()), word
    assert model.predict(["½ ² 3", "a²"])[0] == ("und", 0.0) and model.predict(["a²"])[0][0] in "xy"
