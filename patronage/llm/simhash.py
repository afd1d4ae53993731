"""Near-duplicates by 64-bit similarity fingerprints; pairs come from covering locality-sensitive hashing.

A fingerprint is the bitwise majority over the XXH64 (seed 42) of all three-word shingles, repeats included, of the text
with A-Z lowered and words split at ASCII white space; a text of one or two words hashes the whole sequence, one without a
word has fingerprint 0. Fingerprints link at ``radius`` or fewer differing bits.

Covering masks: bit i has a non-zero code of radius + 1 bits, and mask v holds the bits whose code has an odd inner product
with v. Any ``radius`` differing bits have codes of rank at most ``radius``, so some non-zero v is orthogonal to all of them:
that mask avoids the differing bits and both fingerprints fall into one bucket. All 2^(radius+1) - 1 masks together miss no pair.

Edge cases: NULL and empty texts have fingerprint 0 and link like others; repeated rows share one fingerprint, which is
compared once; a row without id is fingerprinted, keeps its class and never names it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, free_name, ship, with_columns

BITS = 64
SEED = 42
#: shingles hashed and counted at a time, which bounds the memory for a very long text
CHUNK = 1 << 15


def covering_masks(radius: int = 3, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks; codes are dealt to the bits in turn, so every mask holds about half of them."""
    codes = 1 << (radius + 1)
    return [sum(1 << i for i in range(bits) if ((1 + i % (codes - 1)) & v).bit_count() % 2) for v in range(1, codes)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    total, hash64 = len(words) - shingle + 1, xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for first in range(0, total, CHUNK):
        last = min(first + CHUNK, total)
        spans = zip(starts[first:last], ends[first + shingle - 1:last + shingle - 1], strict=True)
        hashes = np.array([hash64(joined[s:e - 1], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, out: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``out``."""
    def start():
        return lambda texts: [[signed(fingerprint(t, shingle)) for t in texts]]

    return with_columns(docs, [text], {out: "long"}, start)


def near_in_run(prints: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Components of one bucket: (first member, other members). Found members leave the search, so nothing like all pairs is
    kept, and a dense bucket shrinks fast."""
    left = prints
    while left.size:
        root, left = left[0], left[1:]
        waiting, members = [root], []
        while waiting and left.size:
            near = np.bitwise_count(left ^ waiting.pop()) <= radius
            if near.any():
                found = left[near]
                members.extend(found)
                waiting.extend(found)
                left = left[~near]
        if members:
            yield root, np.array(members, np.uint64)


def links(prints: DataFrame, fp: str, radius: int = 3, block: int = 4096) -> DataFrame:
    """Links (a, b) that connect exactly what all pairs within ``radius`` connect; ``prints`` has distinct fingerprints.

    One star per component and bucket comes out, never all pairs. A bucket of more than ``2 * block`` fingerprints is dealt
    into blocks, and every two of them meet in a task of their own, so no task compares an unbounded bucket.
    """
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col(fp).bitwiseAND(F.lit(signed(m))).alias("key"))
                                 for i, m in enumerate(masks)]))
    dealt = prints.select(F.col(fp).alias("fp"), tables.alias("x")).select("fp", "x.*")
    hot = materialize(dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * block), "hot-buckets")
    if hot.isEmpty():
        dealt = dealt.withColumn("part", F.lit(0).cast("long"))
    else:
        blocks = F.ceil(F.col("n") / block)
        mine = F.pmod(F.xxhash64("fp"), blocks)
        other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long")))
                          .otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        dealt = (dealt.join(hot, ["t", "key"], "left").withColumn("mine", F.coalesce(mine, F.lit(0))).withColumn("other", other)
                 .select("fp", "t", "key", (F.least("mine", "other") * (1 << 31) + F.greatest("mine", "other")).alias("part")))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            kept = now if kept is None else [np.concatenate(x) for x in zip(kept, now, strict=True)]
            changes = np.flatnonzero((kept[0][1:] != kept[0][:-1]) | (kept[1][1:] != kept[1][:-1]) | (kept[2][1:] != kept[2][:-1])) + 1
            if changes.size:
                yield from stars(kept[3][:changes[-1]], np.concatenate([[0], changes]))
                kept = [x[changes[-1]:] for x in kept]
        if kept is not None:
            yield from stars(kept[3], np.array([0, kept[3].size]))

    def stars(values: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = values.view(np.uint64)
        sizes = np.diff(bounds)
        twos = bounds[:-1][sizes == 2]
        a, b = values[twos], values[twos + 1]
        near = np.bitwise_count(a ^ b) <= radius
        firsts, others = [a[near]], [b[near]]
        for at in np.flatnonzero(sizes > 2):
            for root, members in near_in_run(values[bounds[at]:bounds[at + 1]], radius):
                firsts.append(np.full(members.size, root, np.uint64))
                others.append(members)
        a, b = np.concatenate(firsts).view(np.int64), np.concatenate(others).view(np.int64)
        if a.size:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    order = ["t", "key", "part"]
    return (dealt.select(*order, "fp").repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(match, "a long, b long").distinct())


def classes(prints: DataFrame, fp: str, radius: int = 3, block: int = 4096) -> DataFrame:
    """(node, label) for every distinct fingerprint that has a link; all others are classes of their own."""
    return components(links(prints, fp, radius, block), "a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest id reachable over links, NULL if no row there has one."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = materialize(with_fingerprints(narrow, "text", "fp").select("doc_id", "fp"), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    linked = distinct.join(classes(distinct, "fp", radius).withColumnRenamed("node", "fp"), "fp")
    named = linked.groupBy("label").agg(F.min("least").alias("smallest"))
    joined = linked.join(named, "label").select("fp", "smallest")
    found = materialize(distinct.join(joined, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id")), "classes")
    return prints.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """One row of each class with all its columns: that with the smallest id, rows without id last, then by text hash.

    Rows repeated in all of (id, text) are cut to one; only such rows are shuffled with their texts.
    """
    fp, me, best = (free_name(docs, n) for n in ("__fp", "__me", "__best"))
    rank = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h"))
    marked = with_fingerprints(docs, text, fp, shingle).withColumn(me, rank)
    firsts = (marked.select(F.col(fp).alias("fp"), F.col(me).alias("me")).groupBy("fp", "me").agg(F.count(F.lit(1)).alias("rows"))
              .groupBy("fp").agg(F.min(F.struct("me", "rows")).alias("first")))
    distinct = materialize(firsts.select("fp", "first.*"), "distinct-fingerprints")
    linked = distinct.join(classes(distinct, "fp", radius).withColumnRenamed("node", "fp"), "fp", "left")
    label = F.coalesce("label", "fp")
    winners = materialize(linked.groupBy(label.alias("label")).agg(F.min(F.struct("me", "rows", "fp")).alias("w"))
                          .select(F.col("w.fp").alias(fp), F.struct("w.me", "w.rows").alias(best)), "kept-fingerprints")
    kept = marked.join(winners, fp).where(F.col(me) == F.col(f"{best}.me"))
    once = kept.where(F.col(f"{best}.rows") == 1).select(*docs.columns)
    repeated = kept.where(F.col(f"{best}.rows") > 1).dropDuplicates([fp]).select(*docs.columns)
    return once.unionAll(repeated)


ship(__name__)
