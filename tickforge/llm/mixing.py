"""Document rates that mix soft domains to target weights; DataFrame functions only.

1. A classifier learns from a labelled table: for each domain the frequencies of binned text features, all rows of
   the table counted, and a temperature chosen by likelihood. It gives every document a posterior over domains.
2. Rates r >= 0 minimise the weighted squared distance of the expected tokens of each domain,
   sum of r * tokens * posterior, from its target. Projected gradient steps start at r = 1; each step needs one
   distributed sum per domain. The weights are the inverse of M = sum of tokens * p p', for which step 1 is safe.
   A rate depends on its document's posterior and on the steps only, so rates are an expression, not a table.
3. ``copies`` realises a rate: its whole part, plus one with the probability of the rest, by a hash of the identifier.

Defined results: null text counts as empty and has no tokens; a document whose domain is unlabelled still gets a
posterior; of repeated labels the largest counts; without usable labels or tokens every rate is 1;
targets of unknown domains are ignored and the others scaled to 1; repeated rows each get a row.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.session import checkpoint_dir

BINS = 16
MAX_DOMAINS = 64
STEPS = 25
CLOSE = 1e-5
TEMPERATURES = (0.1, 0.2, 0.35, 0.5, 0.75, 1.0)
SPACES = r"[\x20\x09-\x0D]+"


def _share(text: Column, chars: str) -> Column:
    """Share of the characters that ``chars`` holds."""
    n = F.greatest(F.length(text), F.lit(1))
    # A single sign is found by bytes, which is much cheaper than translating every character.
    rest = F.replace(text, F.lit(chars), F.lit("")) if len(chars) == 1 else F.translate(text, chars, "")
    return (F.length(text) - F.length(rest)) / n


def _bin(value: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(value))).cast("int")


def described(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), n_tokens (words between white space) and bins of text features."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    rows = rows.withColumn("words", F.filter(F.split("t", SPACES), lambda w: w != ""))
    rows = rows.select("row", "t", F.size("words").cast("long").alias("n_tokens"), F.size(F.array_distinct("words")).alias("distinct"))
    t, n = F.col("t"), F.greatest(F.col("n_tokens"), F.lit(1))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÉÈÊËÎÏÔÛÙÑÁÍÓÚ"
    features = [
        F.log2(F.length(t) + 1),
        BINS * F.col("distinct") / n,
        BINS * _share(t, upper),
        BINS * F.least(F.lit(1.0), 4 * _share(t, "!")),
        BINS * F.least(F.lit(1.0), 8 * _share(t, "|")),
        BINS * F.least(F.lit(1.0), 4 * _share(t, "#$%&*@^~")),
        BINS * F.least(F.lit(1.0), 4 * _share(t, "0123456789")),
        BINS * F.least(F.lit(1.0), 40 * _share(t, "\n")),
        BINS * F.least(F.lit(1.0), 8 * _share(t, ".,;:?")),
        F.length(t) / n,
    ]
    return rows.select("row", "n_tokens", F.array(*map(_bin, features)).alias("bins"))


class Mixer:
    """A fitted classifier and the steps taken; turns into column expressions."""

    def __init__(self, domains: list[str], prior: list[float], tables: list[list[list[float]]], temperature: float = 1.0):
        self.domains, self.prior, self.tables, self.temperature = domains, prior, tables, temperature
        self.steps: list[list[float]] = []

    def with_posterior(self, rows: DataFrame, name: str = "p", temperature: float | None = None) -> DataFrame:
        """Adds an array of probabilities, one a domain, from column ``bins``; each step is computed once a row."""
        heat = self.temperature if temperature is None else temperature
        logs = []
        for k, prior in enumerate(self.prior):
            parts = [F.array(*map(F.lit, table[k])).getItem(F.col("bins").getItem(j)) for j, table in enumerate(self.tables)]
            logs.append(F.lit(prior) + F.lit(heat) * reduce(lambda a, b: a + b, parts))
        rows = rows.withColumn("_logs", F.array(*logs)).withColumn("_top", F.array_max("_logs"))
        rows = rows.withColumn("_weights", F.transform("_logs", lambda x: F.exp(x - F.col("_top"))))
        rows = rows.withColumn("_total", F.aggregate("_weights", F.lit(0.0), lambda a, x: a + x))
        return rows.withColumn(name, F.transform("_weights", lambda x: x / F.col("_total"))).drop("_logs", "_top", "_weights", "_total")

    def rate(self, p: Column) -> Column:
        """The rate after all steps of a document with posterior ``p``."""
        steps = F.array(*(F.array(*map(F.lit, s)) for s in self.steps)) if self.steps else None
        if steps is None:
            return F.lit(1.0)
        moves = F.transform(steps, lambda s: reduce(lambda a, b: a + b, [s.getItem(k) * p.getItem(k) for k in range(len(self.domains))]))
        return F.aggregate(moves, F.lit(1.0), lambda r, m: F.greatest(F.lit(0.0), r - m))


def _classifier(slim: DataFrame, labelled: DataFrame) -> Mixer:
    """Binned frequencies by domain from the labelled rows of ``slim`` (id, n_tokens, bins)."""
    names = [r["domain"] for r in labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy("domain").limit(MAX_DOMAINS + 1).collect()]
    if len(names) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    known = slim.join(labelled, "id").select("domain", "bins")
    counts = known.select("domain", F.posexplode("bins").alias("j", "bin")).groupBy("domain", "j", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    rows: dict[str, int] = {}
    for r in counts:
        if r["j"] == 0:
            rows[r["domain"]] = rows.get(r["domain"], 0) + r["n"]
    domains = [d for d in names if rows.get(d)]
    if not domains:
        return Mixer([], [], [])
    width = 1 + max(r["j"] for r in counts)
    table = np.full((width, len(domains), BINS), 0.5)
    for r in counts:
        table[r["j"], domains.index(r["domain"]), r["bin"]] += r["n"]
    table = np.log(table / table.sum(axis=2, keepdims=True))
    prior = [math.log(rows[d] / sum(rows.values())) for d in domains]
    mixer = Mixer(domains, prior, table.tolist())
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int")
    rated = known
    for i, heat in enumerate(TEMPERATURES):
        rated = mixer.with_posterior(rated, f"p{i}", heat)
    fits = rated.agg(*(F.avg(F.log(F.element_at(f"p{i}", number) + 1e-12)).alias(f"t{i}") for i in range(len(TEMPERATURES)))).first()
    mixer.temperature = max(zip(fits, TEMPERATURES, strict=True))[1]
    return mixer


def fit(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> tuple[Mixer, DataFrame]:
    """The fitted mixer, and a written table (id, n_tokens, p) of all documents.

    ``labelled`` has columns id and domain (text). The token budget is the number of tokens there are.
    """
    checkpoint_dir(docs.sparkSession)
    slim = described(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "text")
    slim = slim.select("row.id", "n_tokens", "bins").checkpoint()
    labelled = labelled.where(F.col("id").isNotNull() & F.col("domain").isNotNull()).groupBy("id").agg(F.max("domain").alias("domain"))
    mixer = _classifier(slim, labelled)
    n = len(mixer.domains)
    if not n:
        return mixer, slim.select("id", "n_tokens", F.array().cast("array<double>").alias("p"))
    slim = mixer.with_posterior(slim).select("id", "n_tokens", "p").checkpoint()
    p, tokens = F.col("p"), F.col("n_tokens")
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    sums = slim.agg(F.sum("n_tokens"), *(F.sum(tokens * p.getItem(a) * p.getItem(b)) for a, b in pairs)).first()
    total = float(sums[0] or 0)
    wanted = np.array([max(0.0, targets.get(d, 0.0)) for d in mixer.domains])
    if not total or not wanted.sum():
        return mixer, slim
    goal = total * wanted / wanted.sum()
    m = np.zeros((n, n))
    for (a, b), v in zip(pairs, sums[1:], strict=True):
        m[a, b] = m[b, a] = v
    scale = np.linalg.pinv(m + 1e-9 * total * np.eye(n))
    for _ in range(STEPS):
        now = slim.agg(*(F.sum(tokens * mixer.rate(p) * p.getItem(k)) for k in range(n))).first()
        gap = np.array([float(x) for x in now]) - goal
        if np.abs(gap).max() <= CLOSE * total:
            break
        mixer.steps.append([float(x) for x in scale @ gap])
    return mixer, slim


def copies(rate: Column, key: Column) -> Column:
    """Whole copies whose expectation is the rate, from a hash of ``key``."""
    part = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(rate + part).cast("long")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with a positive rate: all columns of ``docs`` in struct ``row``, with n_tokens, rate and copies."""
    mixer, _ = fit(docs, labelled, targets, id_col, text_col)
    rows = described(docs, text_col)
    rows = mixer.with_posterior(rows) if mixer.domains else rows.withColumn("p", F.array().cast("array<double>"))
    rows = rows.select("row", "n_tokens", mixer.rate(F.col("p")).alias("rate"))
    # A plain filter on the rate would be moved below the classifier and compute it many times over.
    one = F.struct("row", "n_tokens", "rate", copies(F.col("rate"), F.col("row").getField(id_col)).alias("copies"))
    return rows.select(F.inline(F.filter(F.array(one), lambda x: x["rate"] > 0)))


#: Token shares asked for in the registered query: mostly documents of good quality (label 1).
TARGETS = {"1": 0.95, "0": 0.05}


def quality_domains(labels: DataFrame) -> DataFrame:
    """The labelled table: quality of the labelled documents as their domain."""
    return labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("domain"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    mixer, slim = fit(docs, quality_domains(labels), TARGETS)
    return slim.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.lit(",".join(mixer.domains)).alias("domains"),
        F.col("p").alias("posterior"),
        mixer.rate(F.col("p")).alias("rate"),
    ).withColumn("copies", copies(F.col("rate"), F.col("doc_id")))
