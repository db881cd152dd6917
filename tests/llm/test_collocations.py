import random
import re
from collections import Counter, defaultdict

import pytest

from tickforge.llm import collocations


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute(rows, least, best, inside):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        found = []
        for p, a in often.items():
            if 100 * longer[p] >= inside * a and longer[p]:
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in frame.collect())


def texts(seed=3):
    r = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(90))  # one long unary path
    out = []
    for i in range(300):
        words = [f"w{int(r.paretovariate(0.9)) % 40}" for _ in range(r.randrange(0, 60))]
        for at in range(5, len(words), 7):
            words[at] += r.choice([",", ".", "\n", " the cat", " THE\tcat sat", "  "])
        body = " ".join(words)
        if i % 4 == 0:
            body += " " + passage + r.choice(["", " end", ". The end"])
        if i % 9 == 0:
            body += " a a a a a a é 你好 ß É"
        out.append((body, r.choice(["en", "de", None, "und"])))
    return out + [(None, "en"), ("", "xx"), ("?!", None), ("solo", "yy")]


@pytest.mark.parametrize(("least", "best", "inside"), [(5, 2000, 80), (30, 7, 60), (300, 9, 80)])
def test_against_brute_force(spark, monkeypatch, least, best, inside):
    monkeypatch.setattr(collocations, "TOP_WORDS", 3)  # most words take the other join
    rows = texts()
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert rows_of(collocations.mine(frame, least=least, best=best, inside=inside)) == brute(rows, least, best, inside)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    import numpy as np

    rows = texts(4)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    full = np.full(collocations.SIZE // 8, 255, np.uint8)
    monkeypatch.setattr(collocations, "sketch", lambda *a: full)
    assert rows_of(collocations.mine(frame, least=8)) == brute(rows, 8, 2000, 80)


def test_paths_join_at_unary_nodes_only(spark):
    rows = [("a b c d e f g h", "en")] * 6 + [("x b c d e f y", "en")] * 4
    counts = collocations.flows(collocations.edges(spark.createDataFrame(rows, "text string, lang string"), 2), 2)
    got = {(r["phrase"], r["weight"]) for r in collocations.paths(collocations.extended(counts)).collect()}
    # Nodes inside the shared stretch are unary; its ends have two edges on one side.
    assert got == {("a b c d", 6), ("x b c d", 4), ("b c d e f", 10), ("d e f g h", 6), ("d e f y", 4)}


def test_odd_tables(spark, odd_docs, no_docs):
    got = collocations.mine(odd_docs, least=2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    assert rows_of(got) == brute(rows, 2, 2000, 80)
    assert collocations.query(no_docs).count() == 0
