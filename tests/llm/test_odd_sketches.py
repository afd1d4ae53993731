"""Near copies against the similarity of all pairs."""

import random

import numpy as np
import pytest

from patronage.llm import contracts, odd_sketches
from patronage.llm.common import prepare
from tests.llm.conftest import DATA


def plain_set(text, shingle):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def plain_components(rows, shingle, least=80):
    """Row number to (n_shingles, smallest reachable id) for rows (doc_id, text)."""
    sets = [plain_set(t, shingle) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= least * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= least * (len(a) + len(b) - shared):
                    parent[root(i)] = root(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            best[root(i)] = min(best.get(root(i), doc), doc)
    return [(doc, len(sets[i]), best.get(root(i)), doc == best.get(root(i))) for i, (doc, _) in enumerate(rows)]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def with_copies(texts, draw, n=80):
    rows = list(texts.items())
    for d in draw.sample(sorted(texts), n):
        words = (texts[d] or "").split()
        for _ in range(draw.randint(1, 4)):
            if len(words) >= 20:
                words = list(words)
                for _ in range(draw.randint(1, 1 + len(words) // 15)):
                    words[draw.randrange(len(words))] = f"changed{draw.randrange(9999)}"
                rows.append((100_000 + len(rows), " ".join(words)))
    return rows


def test_query(spark, texts):
    found = contracts.op13(spark, DATA).collect()
    assert ordered(found) == ordered(plain_components(list(texts.items()), 2))


@pytest.mark.parametrize("blocks", [{}, {"bucket_block": 3, "set_block": 500}])
@pytest.mark.parametrize("shingle", [2, 5])
def test_copies_with_changed_words(spark, texts, shingle, blocks):
    prepare(spark)
    rows = with_copies(texts, random.Random(shingle))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(odd_sketches.near_duplicates(docs, shingle=shingle, **blocks).collect()) == ordered(plain_components(rows, shingle))


@pytest.mark.parametrize("blocks", [{}, {"bucket_block": 40, "set_block": 4000}])
def test_one_large_group_and_chains(spark, blocks):
    """Copies of one text, each changed elsewhere; a chain whose ends are far apart; two families just below the limit."""
    prepare(spark)
    draw = random.Random(11)
    base = [f"w{draw.randrange(5000)}" for _ in range(60)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(60)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(80)]
    for i in range(40):
        chain = [*chain[2:], f"d{i}", f"e{i}"]
        rows.append((1000 + i, " ".join(chain)))
    other = base[:52] + [f"y{i}" for i in range(8)]
    rows += [(2000 + i, " ".join([*other[:i], f"z{i}", *other[i + 1:]])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(odd_sketches.near_duplicates(docs, shingle=2, **blocks).collect()) == ordered(plain_components(rows, 2))


def test_odd_rows(spark, odd):
    prepare(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    wanted = [(d, n, c if n else d, (c if n else d) == d) for d, n, c, _ in plain_components(rows, 2)]
    clash = odd.withColumnRenamed("score", "key").withColumnRenamed("lang", "bands").withColumnRenamed("source", "id_hash")
    assert ordered(odd_sketches.near_duplicates(clash, shingle=2).collect()) == ordered(wanted)
    assert odd_sketches.near_duplicates(odd.limit(0)).count() == 0


def test_very_long_texts(spark):
    prepare(spark)
    draw = random.Random(2)
    words = [f"w{draw.randrange(10**6)}" for _ in range(300_000)]
    changed = [f"x{i}" if i % 30 == 0 else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[:150_000])), (4, "x" * 3_000_000), (5, "X" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(odd_sketches.near_duplicates(docs, shingle=2).collect()) == ordered(plain_components(rows, 2))


def test_sketches_tell_similarities():
    """Estimates lie near the true similarity, and pairs that link pass the filter."""
    rng = np.random.default_rng(8)
    for similarity in (0.8, 0.85, 0.9, 0.97):
        errors = []
        for _ in range(200):
            shared, own = int(1000 * similarity), int(1000 * (1 - similarity) / 2)
            pool = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
            a, b = pool[:shared + own], np.concatenate([pool[:shared], pool[shared + own:]])
            x, y = (odd_sketches.odd_sketch(odd_sketches.samples(s)) for s in (a, b))
            ones = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
            assert ones <= odd_sketches.most_ones(80)
            errors.append(odd_sketches.estimate(ones) - similarity)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
