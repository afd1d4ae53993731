"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts become lower-case letters of the Basic Multilingual Plane, with every run of other characters as one blank. Character
n-grams of 16-bit units pack into one long, so counts of the longest n-grams are exact sums over all training documents; the
lower orders count distinct left neighbours, as Kneser-Ney asks. Discounted n-gram terms and context weights of a language
are stored as sorted arrays of ``hash_bits``-bit hashes with float values. That bounds a language's model whatever the
corpus holds; n-grams that share a hash share the greater value.

A text's cross-entropy in a language is the mean of -log2 P(character | context). The lowest wins. The scores of calibration
documents, kept out of the counts, set two things: the temperature that turns cross-entropies into probabilities, and per
language the cross-entropy beyond which a text is rejected.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0; ties go to the smaller language name; documents
without language are never learned from; without any training document every text is ``und``; repeated rows count repeatedly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, ship, with_columns

ORDER = 4
UNIT = 16
UNDETERMINED = "und"
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)


def letter_table() -> np.ndarray:
    """Code unit -> itself for a letter, 32 for anything else."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << UNIT)], np.uint16)


def units(value: bytes | None, table: np.ndarray) -> np.ndarray:
    """The units of a text: letters, single blanks between them, one blank at either end; empty without a letter.

    Letters beyond the plane count as one unit that no language's alphabet holds otherwise (the replacement sign U+FFFD).
    """
    if not value:
        return np.zeros(0, np.uint64)
    points = np.frombuffer(value.decode().lower().encode("utf-32-le"), np.uint32)
    found = table[np.minimum(points, 0xFFFF)]
    wide = points > 0xFFFF
    if wide.any():
        found[wide] = [0xFFFD if chr(p).isalpha() else 32 for p in points[wide]]
    blank = found == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    found = found[keep]
    if not (found != 32).any():
        return np.zeros(0, np.uint64)
    edges = [[32] if found[0] != 32 else [], [32] if found[-1] != 32 else []]
    return np.concatenate([edges[0], found, edges[1]]).astype(np.uint64)


def grams(seq: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed n-grams ending at every unit after the first; the text is led in by blanks."""
    led = np.concatenate([np.full(order - 2, 32, np.uint64), seq])
    size = led.size - order + 1
    packed = np.zeros(max(size, 0), np.uint64)
    for i in range(order):
        packed = (packed << np.uint64(UNIT)) | led[i:i + size]
    return packed


def hashed(keys: np.ndarray, bits: int) -> np.ndarray:
    """Multiply-xorshift hash of packed n-grams to ``bits`` bits."""
    h = keys.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): exact counts of the longest n-grams. A task sums its documents and sends each distinct n-gram once
    per million units, so the shuffle sees far less than the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        waiting: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def merge() -> None:
            for name, parts in waiting.items():
                new, n = np.unique(np.concatenate(parts), return_counts=True)
                if name in sums:
                    old, m = sums[name]
                    both, where = np.unique(np.concatenate([old, new]), return_inverse=True)
                    sums[name] = both, np.bincount(where, np.concatenate([m, n])).astype(np.int64)
                else:
                    sums[name] = new, n
            waiting.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for name, (keys, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * keys.size, pa.string()), pa.array(keys.view(np.int64)),
                                                  pa.array(n, pa.int64())], names=["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary()).to_pylist()
            for value, name in zip(texts, batch.column(1).to_pylist(), strict=True):
                found = grams(units(value, table))
                if found.size:
                    waiting.setdefault(name, []).append(found)
                    size += found.size
                if size >= 2_000_000:
                    merge()
                    size = 0
                    if sum(k.size for k, _ in sums.values()) > 2_000_000:
                        yield from out()
        merge()
        yield from out()

    narrow = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return narrow.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Sorted:
    """A map from hashes to values as two sorted arrays."""

    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> Sorted:
        order = np.lexsort((-values, keys))
        keys, values = keys[order], values[order]
        first = np.ones(keys.size, bool)
        first[1:] = keys[1:] != keys[:-1]
        return Sorted(keys[first], values[first].astype(np.float32))

    def get(self, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not self.keys.size:
            return np.full(wanted.size, missing)
        at = np.minimum(np.searchsorted(self.keys, wanted), self.keys.size - 1)
        return np.where(self.keys[at] == wanted, self.values[at], missing)


@dataclass(frozen=True)
class LanguageModel:
    """Per order, the discounted terms of n-grams and the weights of their contexts; ``alphabet`` is the size of order 0."""

    terms: tuple[Sorted, ...]
    contexts: tuple[Sorted, ...]
    alphabet: int
    bits: int

    def log2(self, packed: np.ndarray) -> np.ndarray:
        """log2 P(last unit | units before) of each packed n-gram."""
        p = np.full(packed.size, 1 / (self.alphabet + 1))
        for n in range(1, ORDER + 1):
            own = packed & np.uint64((1 << UNIT * n) - 1)
            weight = self.contexts[n - 1].get(hashed(own >> np.uint64(UNIT), self.bits), 1.0)
            p = self.terms[n - 1].get(hashed(own, self.bits), 0.0) + weight * p
        return np.log2(np.maximum(p, 1e-12))


@dataclass(frozen=True)
class Identifier:
    models: dict[str, LanguageModel]
    temperature: float = 4.0
    limits: dict[str, float] | None = None

    def entropies(self, texts: list[bytes | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(mean bits a unit per text and language, has a letter). The distinct n-grams of the batch are scored once."""
        found = [grams(units(t, table)) for t in texts]
        sizes = np.array([g.size for g in found], np.int64)
        result = np.zeros((len(texts), len(self.models)))
        if sizes.sum():
            distinct, where = np.unique(np.concatenate(found), return_inverse=True)
            owner = np.repeat(np.arange(len(texts)), sizes)
            for i, name in enumerate(sorted(self.models)):
                cost = -self.models[name].log2(distinct)
                result[:, i] = np.bincount(owner, cost[where], len(texts)) / np.maximum(sizes, 1)
        return result, sizes > 0

    def probabilities(self, entropies: np.ndarray, temperature: float | None = None) -> np.ndarray:
        scaled = -(temperature or self.temperature) * entropies
        grown = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        return grown / grown.sum(axis=1, keepdims=True)


def fit_models(counts: DataFrame, hash_bits: int = 24) -> dict[str, LanguageModel]:
    """Kneser-Ney terms per language and order from the counts of the longest n-grams.

    All sums run in Spark; the driver receives at most 2^hash_bits terms and contexts per language and order.
    """
    tables, level = [], counts.select("lang", "gram", F.col("n").cast("long").alias("c"))
    for n in range(ORDER, 0, -1):
        tables.append((n, level))
        mask = (1 << UNIT * (n - 1)) - 1
        level = level.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    parts: dict[tuple[str, int], dict[str, np.ndarray]] = {}
    for n, level in tables:
        context = F.shiftrightunsigned("gram", UNIT)
        discounts = level.groupBy("lang").agg(F.sum((F.col("c") == 1).cast("long")).alias("n1"), F.sum((F.col("c") == 2).cast("long")).alias("n2"))
        discounts = discounts.select("lang", F.when(F.col("n1") * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2")))
                                     .otherwise(F.lit(0.5)).alias("d"))
        totals = (level.groupBy("lang", context.alias("ctx")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
                  .join(discounts, "lang"))
        terms = level.withColumn("ctx", context).join(totals, ["lang", "ctx"]).select(
            "lang", "gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("value"))
        weights = totals.select("lang", F.col("ctx").alias("gram"), (F.col("d") * F.col("kinds") / F.col("total")).alias("value"))
        for what, frame in (("terms", terms), ("contexts", weights)):
            rows = bounded(frame, hash_bits).toArrow()
            names = np.array(rows.column("lang").to_pylist(), object)
            keys, values = rows.column("key").to_numpy().astype(np.uint32), rows.column("value").to_numpy()
            for name in set(names):
                own = names == name
                parts.setdefault((name, n), {})[what] = Sorted.of(keys[own], values[own])
    models = {}
    for name in sorted({k[0] for k in parts}):
        own = [parts[name, n] for n in range(1, ORDER + 1)]
        models[name] = LanguageModel(tuple(p["terms"] for p in own), tuple(p["contexts"] for p in own), own[0]["terms"].keys.size, hash_bits)
    return models


def bounded(frame: DataFrame, bits: int) -> DataFrame:
    """(lang, key, value): the greatest value per hash, so at most 2^bits rows per language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hashed(batch.column(1).to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys.astype(np.int64)), batch.column(2)], names=["lang", "key", "value"])

    return frame.mapInArrow(run, "lang string, key long, value double").groupBy("lang", "key").agg(F.max("value").alias("value"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", calibrate=None, hash_bits: int = 24, rejected: float = 0.002) -> Identifier:
    """Models from all rows with a language where ``calibrate`` (a boolean column) is not true; temperature and limits from
    the rows where it is. ``rejected`` is the share of right calibration texts beyond the limits. Without calibration rows
    the temperature stays and nothing is rejected."""
    known = docs.where(F.col(lang).isNotNull())
    counts = materialize(gram_counts(known if calibrate is None else known.where(~F.coalesce(calibrate, F.lit(False))), text, lang), "grams")
    identifier = Identifier(fit_models(counts, hash_bits))
    if calibrate is None or not identifier.models:
        return identifier
    names = sorted(identifier.models)
    held = known.where(calibrate).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    judged = with_entropies(held, identifier, "text", "entropies").where(F.size("entropies") > 0).select("lang", "entropies")
    judged = materialize(judged.withColumn("own", F.array_position(F.array(*map(F.lit, names)), F.col("lang"))).where("own > 0")
                         .withColumn("mine", F.expr("element_at(entropies, cast(own as int))")), "calibration")
    def loss_at(t: float):
        """Mean bits that the probability of the own language costs at temperature t."""
        return F.avg(F.log2(F.aggregate("entropies", F.lit(0.0), lambda total, x: total + F.pow(F.lit(2.0), t * (F.col("mine") - x)))))

    losses = [loss_at(t).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    loss = judged.agg(*losses).first()
    limits = {r["lang"]: r["limit"] for r in judged.groupBy("lang").agg(F.percentile_approx("mine", 1 - rejected, 10_000).alias("limit")).collect()}
    scored = [(v, t) for v, t in zip(loss, TEMPERATURES, strict=True) if v is not None]
    return Identifier(identifier.models, min(scored)[1] * float(np.log(2)) if scored else identifier.temperature, limits)


def with_entropies(docs: DataFrame, identifier: Identifier, text: str, out: str) -> DataFrame:
    """``docs`` with the cross-entropies per language, in the order of their names; empty for a text without a letter."""
    raw = free_name(docs, "__entropies")
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def start():
        table, found = letter_table(), shared.value

        def compute(texts):
            values, letters = found.entropies(texts, table)
            return [[",".join(map(repr, map(float, v))) if ok else "" for v, ok in zip(values, letters, strict=True)]]

        return compute

    listed = F.when(F.col(raw) == "", F.array().cast("array<double>")).otherwise(F.split(raw, ",").cast("array<double>"))
    return with_columns(docs, [text], {raw: "string"}, start).withColumn(out, listed).drop(raw)


def identify(docs: DataFrame, identifier: Identifier, text: str = "text") -> DataFrame:
    """``docs`` with best (language of the lowest cross-entropy), lang_pred (``und`` beyond that language's limit), score and
    bits (the cross-entropy); clashing names get underscores in front."""
    names = {n: free_name(docs, n) for n in ("best", "lang_pred", "score", "bits")}
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def start():
        table, found = letter_table(), shared.value
        languages, limits = sorted(found.models), found.limits or {}

        def compute(texts):
            values, letters = found.entropies(texts, table)
            rows = []
            for v, ok in zip(values, letters, strict=True):
                if not ok or not languages:
                    rows.append((UNDETERMINED, UNDETERMINED, 0.0, None))
                    continue
                i = int(np.argmin(v))
                rejected = v[i] > limits.get(languages[i], np.inf)
                rows.append((languages[i], UNDETERMINED if rejected else languages[i], float(found.probabilities(v[None])[0, i]), float(v[i])))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in names]

        return compute

    return with_columns(docs, [text], {names["best"]: "string", names["lang_pred"]: "string", names["score"]: "double",
                                       names["bits"]: "double"}, start)


ship(__name__)
