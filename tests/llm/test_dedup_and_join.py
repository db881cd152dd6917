import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tickforge.llm import exact_dedup, ngram_join
from tickforge.llm.words import mix


def brute_classes(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        for place, i in enumerate(sorted(ids, key=lambda x: (x is None, x or 0))):
            out.append((i, keep, len(ids), place == 0, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run_rows", [64, 2])
def test_exact_classes(spark, odd_docs, documents, monkeypatch, run_rows):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", run_rows)
    for docs in (odd_docs, documents):
        want = brute_classes([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
        got = sorted((tuple(r) for r in exact_dedup.query(docs).collect()), key=repr)
        assert got == want


def test_hot_group_is_cut_and_kept_once(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", 10)
    docs = spark.range(500).selectExpr("500 - id AS doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) AS text")
    got = exact_dedup.query(docs).collect()
    hot = [r for r in got if r["group_size"] > 1]
    assert len(hot) == 167 and {r["keep_id"] for r in hot} == {2} and sum(r["kept"] for r in hot) == 1
    assert sum(r["kept"] for r in got) == 334


def test_kept_rows_have_the_input_columns(odd_docs, no_docs):
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 3, 5, None, 6, 7, 8, 9, 10]))
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0


def brute_join(rows, words, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = len(w) - words + 1
        sets.append({tuple(w[i : i + words]) for i in range(n)} if n > 0 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, len(sets[i]), (min(least[find(i)]) if least[find(i)] else None) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def near_copies(seed, groups, members, size):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randrange(300)}" for _ in range(size)]
        for _ in range(members):
            copy = base[:]
            for _ in range(r.choice((0, 1, 2, 3, 5))):
                copy[r.randrange(size)] = f"x{r.randrange(40)}"
            out.append(" ".join(copy))
    return list(enumerate(out))


@pytest.mark.parametrize("limits", [(16, 4096, 2048), (3, 25, 10)])
def test_join_equals_brute_force(spark, odd_docs, monkeypatch, limits):
    monkeypatch.setattr(ngram_join, "SMALL", limits[0])
    monkeypatch.setattr(ngram_join, "BLOCK", limits[1])
    monkeypatch.setattr(ngram_join, "CHUNK", limits[2])
    rows = near_copies(5, 3, 60, 70) + near_copies(6, 20, 4, 25)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    rows += [(None if i is None else 1000 + i, t) for i, t in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for words, percent in ((3, 90), (5, 80)):
        got = sorted((tuple(r)[:3] for r in ngram_join.joined(docs, words, percent).collect()), key=repr)
        assert got == brute_join(rows, words, percent)


def test_one_of_each_component_stays(odd_docs, no_docs):
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 2 not in ids and 7 not in ids and {1, 3, 4, 6, 8}.issubset(ids) and ids.count(None) == 2
    assert ngram_join.query(no_docs).count() == 0


def test_difference_prefixes_lose_no_link():
    r = random.Random(3)
    for _ in range(300):
        percent = r.choice((80, 90))
        pivot = set(r.sample(range(400), r.randint(30, 60)))

        def edited():
            s = set(pivot)
            for _ in range(r.randint(0, 8)):
                s.discard(r.choice(sorted(s)))
                s.add(r.randrange(400, 430))
            return s

        def packed(s):
            return np.sort(mix(np.array(sorted(s), np.uint64)))

        x, y, p = packed(edited()), packed(edited()), packed(pivot)
        (lx, kx), (ly, ky) = (ngram_join.difference_keys(v, p, percent) for v in (x, y))
        if ngram_join.similar(x, y, percent):
            assert (lx and ly) or set(kx.tolist()) & set(ky.tolist())
        else:
            assert not ngram_join.forest(np.array([1, 2]), [x, y], percent)
