"""Quality by weak supervision: rules vote good or bad or abstain, expectation-maximisation learns how far to trust each
rule, and the posterior probability of "good" decides instead of a filter that every rule must pass.

Words are runs outside ASCII white space. A pass over the texts gives the base counts and the votes; the votes of all
documents are counted by pattern (at most 3^rules patterns, whatever the input), the estimation runs over those counts, and
each document takes the posterior of its pattern. Documents that fail the base rule are never kept.

Edge cases: NULL and empty texts have zero counts and fail the base rule; repeated rows vote repeatedly; an empty table has
no patterns and no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, ship, with_columns

SYMBOLS = "#*$%&|<>"
ASCII_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: (rule, bad from, good up to): a share between the two abstains. Shares are of words, or of lines with a word.
SHARE_RULES = (
    ("symbols", 0.20, 0.05), ("repeated_windows", 0.30, 0.10), ("repeated_lines", 0.50, 0.25), ("upper_words", 0.50, 0.20),
    ("same_as_previous", 0.20, 0.05), ("commonest_word", 0.30, 0.20))
RULES = ("length", "word_length", *(r[0] for r in SHARE_RULES))


def repeated_positions(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a ``width``-word window found twice or more, the first included. ``width`` is a power of two: windows
    are ranked by doubling, each step ranks pairs of ranks, so equal ranks mean equal windows."""
    if len(words) <= width:
        return 0
    seen: dict[bytes, int] = {}
    ranks = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    size = 1
    while size < width:
        distinct, ranks, counts = np.unique(ranks[:-size] * (len(words) + 1) + ranks[size:], return_inverse=True, return_counts=True)
        if distinct.size == ranks.size:
            return 0
        size *= 2
    ends = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[ranks] > 1)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(ends)[:-1]))


def base_counts(value: bytes) -> tuple[int, int, int, int, int]:
    """The counts named in ``BASE`` for one UTF-8 text."""
    words = value.split()
    if not words:
        return 0, 0, sum(value.count(s.encode()) for s in SYMBOLS), 0, 0
    characters = len(value.decode()) - sum(value.count(b.encode()) for b in ASCII_BLANKS)
    lines = [line for line in value.split(b"\n") if line.strip()] if b"\n" in value else [value]
    return (len(words), characters, sum(value.count(s.encode()) for s in SYMBOLS), len(lines) - len(set(lines)),
            repeated_positions(words))


def votes(value: bytes, counts: tuple[int, int, int, int, int]) -> list[int]:
    """One vote per rule: 1 good, -1 bad, 0 abstains."""
    n, chars, symbols, dup_lines, repeated = counts
    if not n:
        return [-1] + [0] * (len(RULES) - 1)
    words = value.split()
    lines = sum(1 for line in value.split(b"\n") if line.strip())
    shares = {"symbols": symbols / n, "repeated_windows": repeated / n, "repeated_lines": dup_lines / lines,
              "upper_words": sum(1 for w in words if w.isupper() and len(w) > 1) / n,
              "same_as_previous": sum(map(bytes.__eq__, words[1:], words)) / n,
              "commonest_word": max(Counter(words).values()) / n}
    mean = chars / n
    found = [-1 if n < LEAST_WORDS else 1 if n >= 50 else 0, 1 if 2.5 <= mean <= 12 else -1 if mean < 2 or mean > 20 else 0]
    return found + [-1 if shares[r] > bad else 1 if shares[r] <= good else 0 for r, bad, good in SHARE_RULES]


@dataclass(frozen=True)
class LabelModel:
    """P(good), and P(vote | class) for the votes bad, abstain, good of every rule; class 0 is bad."""

    good: float
    tables: np.ndarray  # rule, class, vote + 1

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good | votes) of each row of votes."""
        rules = np.arange(patterns.shape[1])
        log = [np.log(self.tables[rules, y, patterns + 1]).sum(axis=1) for y in (0, 1)]
        return 1 / (1 + np.exp(np.clip(log[0] + np.log(1 - self.good) - log[1] - np.log(self.good), -500, 500)))


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 200, doubt: float = 0.1, prior: float = 1.0) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns with their counts.

    It starts from "bad if any rule votes bad, good otherwise", believed up to ``doubt``. ``prior`` rows of either class vote
    evenly, so no probability is zero, and a bad vote is never taken as evidence for good, nor a good one for bad.
    """
    q = np.where((patterns < 0).any(axis=1), doubt, 1 - doubt)
    model = LabelModel(0.5, np.full((patterns.shape[1], 2, 3), 1 / 3))
    for _ in range(rounds):
        shares = [weights * (1 - q), weights * q]
        tables = np.empty_like(model.tables)
        for y in (0, 1):
            for vote in (-1, 0, 1):
                tables[:, y, vote + 1] = ((patterns == vote) * shares[y][:, None]).sum(axis=0) + prior / 3
            tables[:, y] /= tables[:, y].sum(axis=1, keepdims=True)
        # the two classes swap the mass by which a vote would point the wrong way
        for vote, y in ((0, 0), (2, 1)):
            wrong = tables[:, y, vote] < tables[:, 1 - y, vote]
            mean = tables[wrong][:, :, vote].mean(axis=1, keepdims=True)
            tables[wrong, :, vote] = mean
        tables /= tables.sum(axis=2, keepdims=True)
        good = float((shares[1].sum() + prior) / (weights.sum() + 2 * prior))
        model = LabelModel(good, tables)
        after = model.posterior(patterns)
        if np.abs(after - q).max() < 1e-9:
            break
        q = after
    return model


def with_votes(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the base counts, and the votes as one string of digits 0 bad, 1 abstain, 2 good."""
    def start():
        def compute(texts):
            rows = []
            for value in texts:
                value = value or b""
                counts = base_counts(value)
                rows.append((*counts, "".join(str(v + 1) for v in votes(value, counts))))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in names]

        return compute

    return with_columns(docs, [text], {names[n]: "long" for n in BASE} | {names["votes"]: "string"}, start)


def failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def judged(voted: DataFrame, names: dict[str, str], least: float = 0.5) -> DataFrame:
    """``voted`` with quality (posterior), base_failed and kept. The driver sees one row per vote pattern."""
    spark = voted.sparkSession
    found = voted.groupBy(F.col(names["votes"]).alias("votes")).count().orderBy("votes").collect()
    patterns = np.array([[int(c) - 1 for c in r["votes"]] for r in found], np.int64).reshape(len(found), len(RULES))
    posterior = fit(patterns, np.array([r["count"] for r in found], float)).posterior(patterns) if found else np.zeros(0)
    pattern = free_name(voted, "__pattern")
    scores = spark.createDataFrame([(r["votes"], float(p)) for r, p in zip(found, posterior, strict=True)],
                                   f"{pattern} string, {names['quality']} double")
    # at most 3^rules rows, by construction
    scored = voted.join(F.broadcast(scores), F.col(names["votes"]) == F.col(pattern)).drop(pattern)
    bad = failed(F.col(names["n_words"]), F.col(names["n_repeat_words"]))
    return (scored.withColumn(names["base_failed"], bad)
            .withColumn(names["kept"], ~bad & (F.col(names["quality"]) >= least)))


def columns(docs: DataFrame) -> dict[str, str]:
    return {n: free_name(docs, n) for n in (*BASE, "votes", "quality", "base_failed", "kept")}


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, base counts, votes, quality, base_failed, kept), one row per document; texts are read once and not stored."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = columns(narrow)
    voted = materialize(with_votes(narrow, "text", names).drop("text"), "votes")
    return judged(voted, names, least)


def keep_good(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows that are kept, with their columns. The texts are voted on twice, so that none has to be stored."""
    names = columns(docs)
    return judged(with_votes(docs, text, names), names, least).where(F.col(names["kept"])).select(*docs.columns)


ship(__name__)
