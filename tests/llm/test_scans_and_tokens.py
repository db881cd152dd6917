import hashlib
import math
import random
import re
import time

import pytest

from tickforge.llm import secret_scan, token_counts

WORD_RANKS = {w: i + 1 for i, w in enumerate("the of and password love monkey dragon required secret summer été".split())}
RANKS = secret_scan.Ranks(WORD_RANKS)


def brute_base(text):
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[2]) >= 6
    ]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def noisy_text(seed):
    r = random.Random(seed)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", "AKIA", "AKIAAKIA", ": ", "=", " = ", '"', "'", " ", "\n", "abcdef", "12345", "deadbeef" * 3, "ABCDEFGHIJKLMNOP", "/x_.=-", "é", "😀", "ſecret"]
    return "".join(r.choice(parts) for _ in range(r.randint(1, 60)))


def test_base_spans_equal_brute_force():
    for seed in range(1500):
        text = noisy_text(seed)
        assert secret_scan.base_spans(text) == brute_base(text)


def segment_prices(value, i, j):
    """Prices of one segment, each kind by its definition."""
    piece, s = value[i:j], secret_scan
    yield sum(map(s._char_cost, piece))
    if j - i >= 3:
        cost = s._word_cost(piece, WORD_RANKS)
        if cost is not None and len(piece.lower()) == len(piece):
            yield cost
        if all(map(s._near, piece, piece[1:])):
            keys = [s.PLACE[s.SHIFTED.get(c, c.lower())] for c in piece]
            moves = [(b[0] - a[0], b[1] - a[1]) for a, b in zip(keys, keys[1:])]
            yield s.WALK + s.TURN * (1 + sum(a != b for a, b in zip(moves, moves[1:])))
        for size in range(1, len(piece) // 2 + 1):
            if len(piece) % size == 0 and piece == piece[:size] * (len(piece) // size):
                yield sum(map(s._char_cost, piece[:size])) + s.TIMES
    m = s.DATE.match(value, i)
    if m and m.end() == j:
        yield s.DATE_COST


def brute_cost(value):
    best = [0.0] + [math.inf] * len(value)
    for j in range(1, len(value) + 1):
        best[j] = min(best[i] + secret_scan.SPLIT + p for i in range(j) for p in segment_prices(value, i, j))
    return best[-1]


def test_costs_equal_brute_force():
    r = random.Random(5)
    parts = ["a", "b", "ab", "qwe", "asd", "1", "19", "2023", "04-15", "P@ss", "word", "the", "LOVE", "-", "--", "é", "été", "İ", "zx", "!"]
    for _ in range(1500):
        value = "".join(r.choice(parts) for _ in range(r.randint(1, 6)))[:10]
        assert abs(secret_scan.guess_cost(value, RANKS) - brute_cost(value)) < 1e-9, value


def test_long_values_take_linear_time():
    for body in ("a" * 100_000, "-" * 100_000, "qwerty" * 16_000):
        start = time.process_time()
        secret_scan.added_spans("login: " + body, [], RANKS)
        assert time.process_time() - start < 3


def test_letters_without_a_sign_must_cost_more():
    assert secret_scan.added_spans("the password is qzvxkwjmplrt", [], RANKS) == [(16, 3, 28)]
    assert secret_scan.added_spans("the password is required today", [], RANKS) == []
    blocks = [secret_scan.guess_cost(b * 4, RANKS) for b in ("xkqz", "xkqzv")]
    assert blocks[1] - blocks[0] < 2  # blocks of five repeat as blocks of four do


def test_costs_order_values_by_how_guessable_they_are():
    cheap = ["required", "password", "P@ssw0rd", "aaaaaaaa", "qwertyuiop", "20230415", "summer2023", "abcabcabc"]
    costly = ["xK9#mQ2$vL", "correcthorse", "5aaa9ac60bfe74b24b", "Tr0ub4dor&3x!"]
    assert all(secret_scan.guess_cost(v, RANKS) < secret_scan.MIN_COST for v in cheap)
    assert all(secret_scan.guess_cost(v, RANKS) >= secret_scan.MIN_COST for v in costly)


def test_added_spans_come_from_costly_values_in_context():
    def kinds(text):
        return secret_scan.added_spans(text, secret_scan.base_spans(text), RANKS)

    assert kinds("the password is required here") == []
    assert kinds("my password is xK9#mQ2$vL.") == [(15, 3, 25)]
    assert kinds("pwd: summer2023") == []
    assert kinds("password: zzTT99aa!!q") == []  # a base span covers its beginning


def test_scan_of_odd_rows(odd_docs, no_docs):
    got = {(r["doc_id"], r["spans"]): r for r in secret_scan.query(odd_docs).collect()}
    assert secret_scan.query(odd_docs).count() == 13
    assert got[(3, "")]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.query(no_docs).count() == 0


def test_scan_equals_brute_force(documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in secret_scan.query(documents).collect():
        base = brute_base(texts[r["doc_id"]])
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


ODD_TEXTS = [
    "a <|endoftext|> b  <|endoftext|>", "x  y   z", "tab\t\tline\n\n  next", "  lead and trail  ", "\x1c!\x1c a", "don't we'll I'm", "x" * 5000, " " * 3000 + "y",
    "a　b   c", "\r\n\r\n", "word<|endoftext|>word", "<|endoftext", "naïve 😀😀 你好 мир", "\x85 \x0b \x0c q",
]


def test_counts_equal_the_library(spark, odd_docs, no_docs, documents, tokenizer_path):
    tokenizer = token_counts.load(tokenizer_path)
    extra = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    for docs in (odd_docs.select("doc_id", "text"), documents.select("doc_id", "text"), extra):
        want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()), key=repr)
        got = token_counts.token_counts(docs, tokenizer_path, keep=["doc_id"]).select("row.doc_id", "n_bytes", "n_tokens").collect()
        assert sorted((tuple(r) for r in got), key=repr) == want
    assert token_counts.query(no_docs).count() == 0


def test_overlapping_chunks_are_spliced_exactly(spark, documents, tokenizer_path):
    tokenizer = token_counts.load(tokenizer_path)
    extra = spark.createDataFrame(list(enumerate(t * 3 for t in ODD_TEXTS)), "doc_id long, text string")
    for docs, chunk, overlap in ((documents.select("doc_id", "text").where("doc_id % 5 = 0"), 200, 16), (extra, 24, 4)):
        want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect())
        got = token_counts.token_counts(docs, tokenizer_path, keep=["doc_id"], chunk=chunk, overlap=overlap).select("row.doc_id", "n_tokens").collect()
        assert sorted(tuple(r) for r in got) == want
