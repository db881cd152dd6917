"""Secrets in whole texts: fixed patterns, and values in credential contexts that are costly to guess.

Patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost and non-overlapping, each kind by itself.
The span of a match is the whole match, in code points, end exclusive.

Kind ``password`` adds values after a credential word (password, passphrase, pwd, pin, credential, login, secret,
token, key, and their like) that no pattern covers, when their guess cost reaches ``MIN_COST`` powers
of ten. The cost is that of the cheapest segmentation into words (by frequency rank in the corpus, with
capitals and sign-for-letter changes priced in), dates, repeats of blocks of up to ``LONGEST`` characters, keyboard
walks and brute-force spans, found by dynamic programming in time linear in the value. Letters after "is" or "was"
without a sign must cost ``PROSE_COST``: prose such as "the password is required" stays out, long noise does not.

Defined results: null and empty texts have no spans, base_sha256 is then that of the empty string; rows are never
merged, so repeated identifiers give one row each; an empty table gives no rows and an empty word list.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.words import slices

# The patterns of the three kinds.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # matches are maximal runs, so these are the runs of 24 or more
KINDS = ("assign", "access", "hex", "password")

CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)|pwd|credentials?|login|secret|token|api[_ -]?key|access[_ -]?key|pin(?:\x20code)?)"
    r"[\"']?(?:\x20+(?:is|was)\x20*[:=]?|\x20*(?:[:=]|->|=>)=?)\x20*[\"'`(\[<]?([^\s\"'`]{4,})",
    re.I | re.A,
)
# A text without any of these cannot match; a plain search is far cheaper than the patterns.
ASSIGN_WORDS = ("passw", "secret", "token", "api")
CONTEXT_WORDS = ("pass", "pwd", "credential", "login", "secret", "token", "api", "access", "pin")
MIN_COST = 8.0
PROSE_COST = 14.0  # of values of letters only that no sign introduces, as in "the password is required"
WORDS = 20_000
LONGEST = 64

# Rows of a keyboard, and signs used in place of letters.
KEYS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip("!@#$%^&*()_+{}:\"<>?", "1234567890-=[];',./", strict=True))
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "+": "t"})
PLACE = {c: (x + 0.5 * y, y) for y, row in enumerate(KEYS) for x, c in enumerate(row)}
SPLIT = math.log10(2)
TURN = math.log10(4.6)  # one of about so many neighbours of a key
WALK = math.log10(47 * 20)  # a first key and a length
TIMES = math.log10(20)  # how often a block is repeated
DATE_COST = math.log10(365 * 100)
DATE = re.compile(r"(?:\d{4}[-/._]?\d{2}[-/._]?\d{2}|\d{2}[-/._]?\d{2}[-/._]?(?:\d{4}|\d{2})|(?:19|20)\d{2})")


def _char_cost(c: str) -> float:
    """log10 of the alphabet a brute-force search needs for this character."""
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isalpha() else math.log10(33)


def _near(a: str, b: str) -> bool:
    p, q = PLACE.get(SHIFTED.get(a, a.lower())), PLACE.get(SHIFTED.get(b, b.lower()))
    return p is not None and q is not None and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _word_cost(piece: str, ranks: dict[str, int]) -> float | None:
    lowered = piece.lower()
    cost = None
    rank = ranks.get(lowered)
    if rank is not None:
        cost = math.log10(rank)
    else:
        rank = ranks.get(lowered.translate(PLAIN))
        if rank is not None:
            cost = math.log10(rank) + math.log10(2) * sum(a != b for a, b in zip(lowered, lowered.translate(PLAIN), strict=True))
    if cost is None:
        return None
    upper = sum(map(str.isupper, piece))
    if upper:
        cost += math.log10(2) if upper in (1, len(piece)) else math.log10(2) * min(upper, len(piece) - upper) + math.log10(2)
    return cost


class Ranks:
    """Word ranks, and all beginnings of words, so that a look-up stops at the first character that leads nowhere."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.begins = {w[:i] for w in ranks for i in range(1, len(w) + 1)}


def _repeats(value: str) -> dict[int, list[int]]:
    """By end: block sizes up to ``LONGEST`` whose last two blocks are equal and not themselves repeats of a smaller one."""
    chars = np.frombuffer(value.encode("utf-32-le"), np.uint32)
    n, equal, out = len(chars), {}, {}
    for size in range(1, min(LONGEST, n // 2) + 1):
        same = np.concatenate([np.zeros(size, bool), chars[size:] == chars[:-size]])
        at = np.arange(n)
        equal[size] = at - np.maximum.accumulate(np.where(same, -1, at))  # characters up to here that repeat the block before
        ends = equal[size] >= size
        for part in range(1, size):
            if size % part == 0:
                ends &= equal[part] < 2 * size - part
        for j in np.flatnonzero(ends).tolist():
            out.setdefault(j + 1, []).append(size)
    return out


def guess_cost(value: str, known: Ranks) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs.

    Every segment costs ``SPLIT`` besides its own price. Brute-force spans, walks and repeats carry their cost along
    from character to character, and words are followed by their beginnings: the work is linear in the value.
    """
    n = len(value)
    costs = [_char_cost(c) for c in value]
    upto = [0.0, *itertools.accumulate(costs)]
    best = [0.0] + [math.inf] * n
    words: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: start and cost
    lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    for spelled in dict.fromkeys((lowered, lowered.translate(PLAIN))):
        for i in range(n):
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                if spelled[i:j] not in known.begins:
                    break
                if j - i >= 3 and spelled[i:j] in known.ranks:
                    words[j].append((i, _word_cost(value[i:j], known.ranks)))
    for i in range(n):
        m = DATE.match(value, i)
        if m:
            words[m.end()].append((i, DATE_COST))
    steps = [None] * (n + 1)  # the move on the keyboard that ends at a character
    for j in range(2, n + 1):
        if _near(value[j - 2], value[j - 1]):
            p, q = PLACE[SHIFTED.get(value[j - 2], value[j - 2].lower())], PLACE[SHIFTED.get(value[j - 1], value[j - 1].lower())]
            steps[j] = (q[0] - p[0], q[1] - p[1])
    repeats = _repeats(value) if n > 1 else {}
    brute = walk = math.inf
    again: dict[int, dict[int, float]] = {}  # by block size: cost of a repeat that ends at each place
    for j in range(1, n + 1):
        brute = costs[j - 1] + min(brute, best[j - 1] + SPLIT)
        low = brute
        if steps[j] is None:
            walk = math.inf
        elif j >= 3 and steps[j - 1] is not None:
            turn = TURN if steps[j] != steps[j - 1] else 0.0
            walk = min(walk + turn, best[j - 3] + SPLIT + WALK + TURN + turn)
            low = min(low, walk)
        for size in repeats.get(j, ()):
            line = again.setdefault(size, {})
            before = line.get(j - size, math.inf)
            line[j] = min(before, best[j - 2 * size] + SPLIT + upto[j] - upto[j - size] + TIMES)
            low = min(low, line[j] if size > 1 else before)  # three characters at least
        for i, cost in words[j]:
            low = min(low, best[i] + SPLIT + cost)
        best[j] = low
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    lowered = text.lower()
    found = []
    if any(w in lowered for w in ASSIGN_WORDS):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[tuple[int, int, int]], ranks: Ranks) -> list[tuple[int, int, int]]:
    """Costly values in credential contexts outside the base spans."""
    found = []
    lowered = text.lower()
    if not any(w in lowered for w in CONTEXT_WORDS):
        return found
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".,;:!?)]>}")
        start, end = m.start(1), m.start(1) + len(value)
        if len(value) < 4 or any(a < end and start < b for a, _, b in base):
            continue
        told = any(c in m[0][: start - m.start()] for c in ":=>")
        if guess_cost(value, ranks) >= (PROSE_COST if value.isalpha() and not told else MIN_COST):
            found.append((start, 3, end))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def word_ranks(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Ranks of the ``WORDS`` most frequent lower-case words of 3 to 24 letters of any script, over all rows."""

    def count(batches):
        for batch in slices(batches):
            values = pc.ascii_split_whitespace(pc.fill_null(batch.column(0), "")).flatten().value_counts()
            words, n = pc.utf8_lower(values.field("values")), values.field("counts")
            words = pc.replace_substring_regex(words, r"^[^\p{L}]+|[^\p{L}]+$", "")
            good = pc.match_substring_regex(words, r"^\p{L}{3,24}$")
            yield pa.RecordBatch.from_arrays([words.filter(good), n.filter(good)], names=["word", "n"])

    counts = docs.select(docs[text_col].alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    return {r["word"]: i + 1 for i, r in enumerate(top)}


def scan(docs: DataFrame, ranks: dict[str, int], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row in struct ``row``, counts by kind and the spans."""
    rows = docs.select(F.struct(*(docs[c] for c in (docs.columns if keep is None else keep))).alias("row"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # WORDS entries at most

    def find(batches):
        known = Ranks(shared.value)
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                added = added_spans(text or "", base, known)
                kinds = [k for _, k, _ in base + added]
                out.append([kinds.count(k) for k in range(4)] + [hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added)])
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("row")] + [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]],
                names=["row", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    schema = rows.select("row").schema
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    return rows.mapInArrow(find, schema.add("base_sha256", "string").add("spans", "string"))


def query(docs: DataFrame) -> DataFrame:
    found = scan(docs, word_ranks(docs), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_password")
