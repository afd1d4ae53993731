"""Quality classifier: labelled documents vote for their nearest neighbours in a latent-semantic space.

A text is counted as pairs of neighbouring character classes (letters, digits, blanks, line ends, every ASCII mark), so the
whole text counts and the number of terms is fixed. Counts are damped, weighted by inverse document frequency and scaled to
length one; the leading singular vectors of a bounded sample of labelled documents span the latent space. The labelled
vectors are broadcast (at most ``sample`` x ``rank`` floats), each block of documents is multiplied with all of them, and
the labels of the ``neighbours`` nearest vote with their cosine, corrected for the share of each label in the sample.

Edge cases: NULL and empty texts have the zero vector, are as near to all labelled documents and so get the labels' overall
share; a document that is labelled both 0 and 1 counts as 0; without labelled documents every score is 0.5; an empty table
gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, ship, with_columns

#: one class for each ASCII mark and lower-case letter, one each for upper case, digits, blanks, line ends, first and other bytes
#: of characters beyond ASCII, and one for the rest
MARKS = string.punctuation
CLASSES = 26 + len(MARKS) + 7


def byte_classes() -> np.ndarray:
    table = np.full(256, CLASSES - 1, np.int64)
    for i, c in enumerate(string.ascii_lowercase + MARKS):
        table[ord(c)] = i
    first = 26 + len(MARKS)
    table[[ord(c) for c in string.ascii_uppercase]] = first
    table[[ord(c) for c in string.digits]] = first + 1
    table[[32, 9, 11, 12, 13]] = first + 2
    table[10] = first + 3
    table[0xC0:] = first + 4
    table[0x80:0xC0] = first + 5
    return table


def pair_counts(value: bytes | None, table: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """Counts of neighbouring classes over the whole text, a megabyte at a time."""
    data = np.frombuffer(value or b"", np.uint8)
    counts = np.zeros(CLASSES * CLASSES, np.int64)
    for at in range(0, max(data.size - 1, 0), chunk):
        part = table[data[at:at + chunk + 1]]
        counts += np.bincount(part[:-1] * CLASSES + part[1:], minlength=counts.size)
    return counts


@dataclass(frozen=True)
class NeighbourModel:
    idf: np.ndarray
    basis: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled documents x rank, length one
    labels: np.ndarray
    weights: np.ndarray  # rows of its label that a labelled document stands for
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return unit((unit(np.log1p(counts) * self.idf)) @ self.basis)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """P(label 1) for each row of counts."""
        if not self.labels.size:
            return np.full(len(counts), 0.5)
        cosine = self.latent(counts).astype(np.float32) @ self.vectors.T.astype(np.float32)
        k = min(self.neighbours, self.labels.size)
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        rows = np.arange(len(counts))[:, None]
        votes = np.maximum(cosine[rows, near], 0).astype(float) ** 4 * self.weights[near]
        total, overall = votes.sum(axis=1), float((self.weights * self.labels).sum() / self.weights.sum())
        found = (votes * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, found, overall), 0, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int):
    """At most ``sample`` / 2 labelled documents of either label, those with the smallest hashes of their id."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id"))
             .agg(F.min(label).alias("label")))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    picked = [known.where(F.col("label") == y).orderBy(*order).limit(sample // 2) for y in (0, 1)]
    chosen = picked[0].unionAll(picked[1])
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")  # ``sample`` rows
    return texts, totals


#: vectors of the space in which singular vectors of more rows than that are looked for, and vectors added to it at a time
SPACE, WIDTH = 768, 64


def leading(rows: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the ``rank`` largest singular values of ``rows``, without those of next to nothing, and their left vectors.

    Few rows go through their Gram matrix. Of more, whose Gram matrix and its decomposition would be most of what the driver
    holds, a Krylov space of a few hundred orthogonal vectors takes the place.
    """
    if len(rows) <= SPACE:
        values, left = np.linalg.eigh(rows @ rows.T)
    else:
        space = np.empty((len(rows), 0), np.float32)
        block = np.linalg.qr(np.random.default_rng(0).standard_normal((len(rows), WIDTH)))[0].astype(np.float32)
        while space.shape[1] < SPACE:
            space = np.hstack([space, block])
            block = rows @ (rows.T @ block)
            grown = np.linalg.norm(block)
            block -= space @ (space.T @ block)
            if np.linalg.norm(block) <= 1e-5 * grown:
                break  # the space holds all that the rows span
            block = np.linalg.qr(block)[0]
            block = np.linalg.qr(block - space @ (space.T @ block))[0]
        across = rows.T @ space
        values, left = np.linalg.eigh(across.T @ across)
    keep = np.argsort(values)[::-1][:rank]
    keep = keep[values[keep] > 1e-6]
    return values[keep], left[:, keep] if len(rows) <= SPACE else space @ left[:, keep]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = 3000, rank: int = 48, neighbours: int = 15) -> NeighbourModel:
    """Learn from at most ``sample`` labelled documents. The driver gets their term counts, ``sample`` x 4,356 small numbers."""
    texts, totals = labelled(docs, labels, doc_id, text, label, sample)

    def start():
        table = byte_classes()

        def compute(values):
            found = [pair_counts(v, table) for v in values]
            # 16 bits of log counts are enough, and keep what the driver gets small
            return [[np.log1p(c).astype(np.float16).tobytes() for c in found]]

        return compute

    rows = sorted(with_columns(texts, ["text"], {"counts": "binary"}, start).drop("text").collect(), key=lambda r: (r["id"], r["counts"]))
    size = CLASSES * CLASSES
    if not rows:
        return NeighbourModel(np.ones(size), np.zeros((size, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), neighbours)
    y = np.array([r["label"] for r in rows], float)
    damped = np.stack([np.frombuffer(r["counts"], np.float16) for r in rows])
    del rows
    df = (damped > 0).sum(axis=0)
    idf = np.log((1 + y.size) / (1 + df)).astype(np.float32) + 1
    # terms that no sampled document has weigh nothing, and most pairs never occur
    seen = np.flatnonzero(df)
    weighted = damped[:, seen].astype(np.float32)
    del damped
    weighted *= idf[seen]
    length = np.sqrt(np.einsum("ij,ij->i", weighted, weighted))
    weighted /= np.where(length > 0, length, 1)[:, None]
    values, left = leading(weighted, rank)
    own = (weighted.T @ left) / np.sqrt(values)
    basis = np.zeros((size, values.size), np.float32)
    basis[seen] = own
    shares = {v: totals.get(v, 0) / max((y == v).sum(), 1) for v in (0, 1)}
    weights = np.array([shares[int(v)] for v in y])
    return NeighbourModel(idf, basis, unit(weighted @ own).astype(np.float32), y, weights, neighbours)


def with_scores(docs: DataFrame, model: NeighbourModel, text: str, out: str) -> DataFrame:
    """``docs`` with P(label 1) in ``out``; the model, of a size that the sample bounds, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        table, found = byte_classes(), shared.value
        return lambda texts: [found.score(np.stack([pair_counts(t, table) for t in texts])).tolist() if texts else []]

    return with_columns(docs, [text], {out: "double"}, start)


def keep_good(docs: DataFrame, model: NeighbourModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score reaches ``least``, with their columns."""
    out = free_name(docs, "__score")
    return with_scores(docs, model, text, out).where(F.col(out) >= least).drop(out)


ship(__name__)
