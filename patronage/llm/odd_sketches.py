"""Near copies by MinHash bands, verified by odd sketches and then exactly.

Words are those of ``simhash``: A-Z lowered, split at ASCII white space; a text of fewer words than a shingle has is one shingle. A
document is its set of 64-bit shingle hashes; documents link if their sets have a Jaccard similarity of at least ``least`` percent.

``BANDS * ROWS`` MinHash values are drawn per set. Each band of ``ROWS`` values is a bucket key: two sets of similarity s share none
with probability (1 - s^5)^32, 3e-6 at 0.8. All values together are folded into an odd sketch: value i toggles one of ``BITS``
bits, so equal values of two sets cancel in the XOR of their sketches, and its number of ones X estimates the similarity as
1 + BITS / (4 k) ln(1 - 2 X / BITS). A candidate whose estimate is more than ``MARGIN`` below ``least`` goes unverified; a linked
pair falls under that with probability below 1e-8 (six standard deviations of X). What remains is decided by the full sets.

Equal sets are one class without any search. In every bucket all members are first compared with the least one, which settles
buckets of two and joins most members of a large group to its least at a cost linear in its size. Buckets whose members all
belong to one component by then are done. In the others only members of different components are compared: the sketches split a
bucket into groups, the same group found in several bands is kept once, and its sets are compared until nothing new links. A
group of more than ``block`` shingles is dealt into blocks, its largest component's blocks only against those of the others, and every
two blocks that must meet do so in a task of their own. So no link between different sets is lost, and no task holds all
members of a large group.

Edge cases: NULL and empty texts and texts without a word have the empty set, link with nothing and are components of their own;
repeated rows are one class; a row without id keeps its class and never names it (component NULL, and kept, where no row of the
class has an id); extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, ship, with_columns

#: words of a shingle and similarity in percent, unless a contract says otherwise
SHINGLE, LEAST = 5, 80
BANDS, ROWS = 32, 5
BITS = 512
MARGIN = 0.26
SEED = 42
#: shingles hashed at a time, words remembered per task, members of a bucket block and shingles of a block of sets
CHUNK, MEMORY = 1 << 12, 300_000
BUCKET_BLOCK, SET_BLOCK = 1 << 14, 1 << 22
_RANDOM = np.random.default_rng(SEED)
FACTORS = _RANDOM.integers(1 << 32, size=(BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
TWISTS = _RANDOM.integers(1 << 32, size=(BANDS * ROWS, 1), dtype=np.uint32)
#: odd constants that spread bits over 64
SPREAD, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * FOLD
    values = (values ^ (values >> np.uint64(32))) * FOLD
    return values ^ (values >> np.uint64(32))


def shingler(shingle: int, memory: int = MEMORY) -> Callable[[bytes | None], np.ndarray]:
    """A function from a UTF-8 text to the sorted distinct hashes of its shingles; it remembers the hashes of words."""
    known: dict[bytes, int] = {}
    hash64 = xxhash.xxh64_intdigest

    def shingles(text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > memory:
            known.clear()
        found = [known.get(w) for w in words]
        if None in found:
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    found[i] = known[w] = hash64(w, SEED)
        hashes, width = np.array(found, np.uint64), min(shingle, len(words))
        total = np.full(hashes.size - width + 1, width, np.uint64) * SPREAD
        for i in range(width):
            total = spread(total + hashes[i:i + total.size])
        return np.unique(total)

    return shingles


def set_key(found: np.ndarray) -> int:
    """Signed hash that stands for a set, 0 for the empty one."""
    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63) if found.size else 0


def samples(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that is not empty."""
    high, least = (found >> np.uint64(32)).astype(np.uint32), None
    for first in range(0, high.size, CHUNK):
        now = ((high[first:first + CHUNK] ^ TWISTS) * FACTORS).min(axis=1)
        least = now if least is None else np.minimum(least, now)
    return least


def band_keys(values: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), SEED) - (1 << 63) for row in values.reshape(BANDS, ROWS)], np.int64)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """``BITS`` parities as signed longs."""
    places = spread(values.astype(np.uint64) + np.arange(1, values.size + 1, dtype=np.uint64) * SPREAD) % np.uint64(BITS)
    odd = np.bincount(places.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def estimate(ones: int) -> float:
    """Similarity that ``ones`` differing bits speak for."""
    inside = 1 - 2 * ones / BITS
    return 1 + BITS / (4 * BANDS * ROWS) * math.log(inside) if inside > 0 else -math.inf


def most_ones(least: int) -> int:
    """Differing bits beyond which a pair goes unverified."""
    return max((x for x in range(BITS // 2) if estimate(x) >= least / 100 - MARGIN), default=0)


def signatures(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` with ``key``, ``size``, ``bands`` and ``sketch`` of the shingle set; the last two are NULL for the empty set."""
    def start():
        shingles = shingler(shingle)

        def compute(texts: list) -> list[list]:
            keys, sizes, bands, sketches = [], [], [], []
            for value in texts:
                found = shingles(value)
                values = samples(found) if found.size else None
                keys.append(set_key(found))
                sizes.append(found.size)
                bands.append(None if values is None else band_keys(values))
                sketches.append(None if values is None else odd_sketch(values))
            return [keys, sizes, bands, sketches]
        return compute

    return with_columns(docs, [text], {"key": "long", "size": "long", "bands": "longs", "sketch": "longs"}, start)


def sets_of(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` with the sorted shingle hashes in ``set``."""
    def start():
        shingles = shingler(shingle)
        return lambda texts: [[shingles(t).tobytes() for t in texts]]

    return with_columns(docs, [text], {"set": "binary"}, start)


def may_link(a: str, b: str, least: int) -> Column:
    """Whether sizes and sketches of the structs ``a`` and ``b`` allow a link."""
    sizes = F.least(F.col(f"{a}.size"), F.col(f"{b}.size")) * 100 >= F.greatest(F.col(f"{a}.size"), F.col(f"{b}.size")) * least
    ones = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(BITS // 64)), F.lit(0))
    return sizes & (ones <= most_ones(least))


def linked(mine: np.ndarray, others: list[np.ndarray], least: int) -> np.ndarray:
    """Which of ``others`` link with ``mine``, by full sets."""
    sizes = np.array([o.size for o in others])
    flat = np.concatenate(others)
    places = np.searchsorted(mine, flat)
    places[places == mine.size] = 0
    shared = np.add.reduceat((mine[places] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * shared >= least * (mine.size + sizes - shared)


def with_least(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that link, by full sets."""
    sides = (pairs.join(sets.select(F.col("key").alias("b"), F.col("set").alias("of_b")), "b")
             .join(sets.select(F.col("key").alias("a"), F.col("set").alias("of_a")), "a").select("a", "b", "of_a", "of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = ([np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3))
            keep = [bool(linked(x, [y], least)[0]) for x, y in zip(of_a, of_b, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.mapInArrow(run, "a long, b long")


def dealt(rows: DataFrame, by: list[str], weight: str, block: int) -> DataFrame:
    """``rows`` (by, key, label, ...) with ``part``: members of different labels of one ``by`` meet in some part. Groups of at most
    ``block`` weight have one part; in others the largest label's blocks meet those of the other labels, and these each other.

    Only groups above ``block`` are stored and joined; while they are few, Spark sends them to the rows instead of shuffling those.
    """
    sizes = rows.groupBy(*by, "label").agg(F.sum(weight).alias("w")).groupBy(*by).agg(
        F.sum("w").alias("total"), F.max("w").alias("most"), F.max_by("label", F.struct("w", "label")).alias("main"))
    large = materialize(sizes.where(F.col("total") > block), "large-groups")
    met = rows.join(large, by, "left")
    main = F.col("label") == F.col("main")
    first, second = F.ceil(F.col("most") / block), F.ceil((F.col("total") - F.col("most")) / block)
    mine = F.pmod(F.xxhash64("key"), F.when(main, first).otherwise(second))
    number = lambda a, b: F.least(a, b) * (1 << 31) + F.greatest(a, b)
    ahead = F.sequence(F.lit(0).cast("long"), first - 1)
    beside = F.sequence(first, first + second - 1)
    parts = (F.when(F.col("total").isNull(), F.array(F.lit(0).cast("long")))
             .when(main, F.transform(beside, lambda o: number(mine, o)))
             .otherwise(F.concat(F.transform(ahead, lambda o: number(o, first + mine)), F.transform(beside, lambda o: number(o, first + mine)))))
    return met.select(rows["*"], F.explode(parts).alias("part"))


def runs(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal values in the first ``places`` columns, as they come behind each other."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:places] != at:
                if rows:
                    yield at, rows
                at, rows = row[:places], []
            rows.append(row[places:])
    if rows:
        yield at, rows


def spreading(labels: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, list[int], list[int]]]:
    """(root, members, links) of what grows from each label: ``near(me, others)`` says which others touch. Equal labels belong together
    from the start; members meet only those that are not of theirs yet."""
    left = np.arange(labels.size)
    while left.size:
        same = labels[left] == labels[left[0]]
        members, left = left[same].tolist(), left[~same]
        root, waiting, links = members[0], list(members), []
        while waiting and left.size:
            me = waiting.pop()
            touched = left[near(me, left)]
            if touched.size:
                links.extend((me, int(o)) for o in touched)
                came = np.isin(labels[left], labels[touched])
                members.extend(left[came].tolist())
                waiting.extend(left[came].tolist())
                left = left[~came]
        yield root, members, links


def groups(rows: DataFrame, least: int, block: int) -> DataFrame:
    """(grp, key, label, size) of the members of buckets that sketches join across labels; equal groups of several buckets once."""
    limit = most_ones(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in runs(batches, 3):
            keys, labels, sizes = (np.array([f[i] for f in found], np.int64) for i in range(3))
            sketches = np.array([f[3] for f in found], np.int64).view(np.uint64)

            def near(me: int, others: np.ndarray) -> np.ndarray:
                fits = 100 * np.minimum(sizes[others], sizes[me]) >= least * np.maximum(sizes[others], sizes[me])
                fits[fits] = np.bitwise_count(sketches[others[fits]] ^ sketches[me]).sum(axis=1) <= limit
                return fits

            for _, members, links in spreading(labels, near):
                if links:
                    chosen = np.sort(keys[members])
                    name = xxhash.xxh64_intdigest(chosen.tobytes(), SEED) - (1 << 63)
                    order = np.argsort(keys[members])
                    columns = [pa.array(np.full(chosen.size, name)), pa.array(chosen), pa.array(labels[members][order]), pa.array(sizes[members][order])]
                    yield pa.RecordBatch.from_arrays(columns, names=["grp", "key", "label", "size"])

    met = dealt(rows.withColumn("one", F.lit(1)), ["t", "bucket"], "one", block)
    order = ["t", "bucket", "part"]
    return (met.select(*order, "key", "label", "size", "sketch").repartition(*order).sortWithinPartitions(*order, "key")
            .mapInArrow(run, "grp long, key long, label long, size long").distinct())


def links_in_groups(found: DataFrame, sets: DataFrame, least: int, block: int) -> DataFrame:
    """Links (a, b) that connect what all pairs of a group that link connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, 2):
            keys, labels = [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)
            own = [np.frombuffer(r[2], np.uint64) for r in rows]
            sizes = np.array([s.size for s in own])

            def near(me: int, others: np.ndarray) -> np.ndarray:
                fits = 100 * np.minimum(sizes[others], sizes[me]) >= least * np.maximum(sizes[others], sizes[me])
                if fits.any():
                    fits[fits] = linked(own[me], [own[o] for o in others[fits]], least)
                return fits

            pairs = [p for _, _, links in spreading(labels, near) for p in links]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([keys[p[i]] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    met = dealt(found, ["grp"], "size", block).select("grp", "part", "key", "label").join(sets, "key")
    order = ["grp", "part"]
    return (met.select(*order, "key", "label", "set").repartition(*order).sortWithinPartitions(*order, "key")
            .mapInArrow(run, "a long, b long").distinct())


def classes(distinct: DataFrame, fetch: Callable[[DataFrame], DataFrame], least: int = LEAST, bucket_block: int = BUCKET_BLOCK,
            set_block: int = SET_BLOCK) -> DataFrame:
    """(node, label) for every set with a link. ``distinct`` has one row per set that is not empty (key, size, bands, sketch);
    ``fetch`` gives (key, set) for a table of keys."""
    spots = distinct.select("key", F.posexplode("bands").alias("t", "bucket"))
    heads = spots.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("head")).where("n > 1")
    members = materialize(spots.join(heads, ["t", "bucket"]).select("t", "bucket", "n", "head", "key"), "bucket-members")
    marks = distinct.select("key", F.struct("size", "sketch").alias("mark"))
    pairs = members.where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()
    pairs = materialize(pairs.join(marks.withColumnRenamed("key", "b").withColumnRenamed("mark", "of_b"), "b")
                        .join(marks.withColumnRenamed("key", "a").withColumnRenamed("mark", "of_a"), "a")
                        .where(may_link("of_a", "of_b", least)).select("a", "b"), "head-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionAll(members.where("n > 2").select("key")).distinct()
    sets = materialize(fetch(wanted), "candidate-sets")
    first = materialize(with_least(pairs, sets, least), "head-links")
    joined = components(first, "a", "b").withColumnRenamed("node", "key")
    labelled = members.where("n > 2").select("t", "bucket", "key").join(joined, "key", "left").withColumn("label", F.coalesce("label", "key"))
    # stored, so that Spark knows their size: few of them go to the members, whose buckets may be hot
    mixed = materialize(labelled.groupBy("t", "bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                        .where("low <> high").select("t", "bucket"), "mixed-buckets")
    rows = (labelled.join(mixed, ["t", "bucket"]).join(distinct.select("key", "size", "sketch"), "key")
            .select("t", "bucket", "key", "label", "size", "sketch"))
    found = materialize(groups(rows, least, bucket_block), "sketch-groups")
    if found.isEmpty():
        return joined.withColumnRenamed("key", "node")
    return components(first.unionAll(links_in_groups(found, sets, least, set_block)), "a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: int = LEAST,
                    bucket_block: int = BUCKET_BLOCK, set_block: int = SET_BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the smallest id reachable over links."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id)).alias("id_hash"),
                         F.xxhash64(F.col(text)).alias("text_hash"))
    rows = materialize(signatures(narrow, "text", shingle).drop("text"), "signatures")
    firsts = rows.where("size > 0").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("id_hash", "text_hash")).alias("from"), F.first("size").alias("size"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    distinct = materialize(firsts, "distinct-sets")

    def fetch(keys: DataFrame) -> DataFrame:
        at = distinct.join(keys, "key").select("key", "from.id_hash", "from.text_hash")
        texts = narrow.select("id_hash", "text_hash", "text").join(at, ["id_hash", "text_hash"]).dropDuplicates(["id_hash", "text_hash"])
        return sets_of(texts.select("key", "text"), "text", shingle).select("key", "set")

    labels = classes(distinct, fetch, least, bucket_block, set_block)
    reached = distinct.select("key", "least").join(labels.withColumnRenamed("node", "key"), "key")
    named = reached.groupBy("label").agg(F.min("least").alias("smallest"))
    joined = reached.join(named, "label").select("key", "smallest")
    found = materialize(distinct.select("key", "least").join(joined, "key", "left").select("key", F.coalesce("smallest", "least").alias("component_id")),
                        "components")
    alone = rows.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    others = rows.where("size > 0").select("doc_id", "key", F.col("size").alias("n_shingles")).join(found, "key").drop("key")
    return alone.unionByName(others).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ship(__name__)
