"""Merkle manifest against a plain tree, and its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from patronage.llm import contract_sql, contracts, merkle, oracle_sql
from patronage.llm.common import prepare
from tests.llm.conftest import DATA

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes, arity):
    """Root, and per node the siblings (before, after) from the bottom up."""
    level, paths, members = list(nodes), [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(level) > 1:
        up, groups = [], []
        for first in range(0, len(level), arity):
            run = level[first:first + arity]
            for slot in range(len(run)):
                for leaf in members[first + slot]:
                    paths[leaf].append((run[:slot], run[slot + 1:]))
            up.append(h(*run))
            groups.append([leaf for m in members[first:first + arity] for leaf in m])
        level, members = up, groups
    return level[0], paths


def plain_manifest(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof, fold of the tampered leaf) per row of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    inner = {n: plain_tree([x[2] for x in sorted(groups[n], key=lambda x: x[:3])], arity) for n in names}
    root, above = plain_tree([inner[n][0] for n in names], arity) if names else (None, [])
    found = []
    for place, n in enumerate(names):
        for (_, _, leaf, row), path in zip(sorted(groups[n], key=lambda x: x[:3]), inner[n][1], strict=True):
            doc_id, source, lang, n_chars, text = row
            whole, now = path + above[place], leaf
            if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                now = plain_leaf((doc_id, source, lang, n_chars + 1, text))
            proof = h(*(d for before, after in whole for d in before + after))
            for before, after in whole:
                now = h(*before, now, *after)
            found.append((doc_id, leaf, inner[n][0], root, proof, now))
    return found


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *[x or 0 for x in r[:1]], *r[1:]))


def test_query_equals_plain_tree_and_sql(spark, documents):
    found = [tuple(r) for r in contracts.op12(spark, DATA).collect()]
    plain = plain_manifest([tuple(r) for r in documents.select(*COLUMNS).collect()])
    assert ordered(found) == ordered([(*r, r[5] == r[3]) for r in plain]) and 0 < sum(not r[6] for r in found) < len(found)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    assert ordered(duck.execute(oracle_sql()["op12_merkle"]).fetchall()) == ordered(found)


def whole(frame, **settings):
    other = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS])
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    rows = merkle.manifest(frame, COLUMNS, carry={"other": F.when(tampered, other)}, **settings)
    text = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")]
    return ordered(tuple(r) for r in rows.select(
        "doc_id", *text, F.sha2(F.lower(F.hex(merkle.proof(F.col("path")))), 256),
        F.lower(F.hex(merkle.folded(F.coalesce("other", "leaf"), F.col("path"))))).collect())


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_odd_rows(spark, odd, arity):
    prepare(spark)
    # ids, groups and texts with NULLs, repeated rows, groups of one row, clashing names
    rows = odd.unionByName(odd.where("doc_id < 4").withColumn("lang", F.lit("zz"))).unionByName(odd.where("doc_id = 5").withColumn("lang", F.lit("")))
    rows = rows.unionByName(odd.where("doc_id = 6")).withColumnRenamed("score", "place").withColumnRenamed("fingerprint", "grp")
    plain = plain_manifest([tuple(r) for r in rows.select(*COLUMNS).collect()], arity)
    assert whole(rows, arity=arity) == ordered(plain)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 9, 33])
def test_sizes(spark, n):
    prepare(spark)
    rows = [(i, "s", "one" if i % 3 else "two", None if i % 5 == 0 else i, f"é {i}" * i) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert whole(frame.repartition(4)) == ordered(plain_manifest(rows))


def test_one_group_of_many_rows_and_text_ids(spark):
    prepare(spark)
    frame = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("doc_id"), F.lit("hot").alias("lang"), F.lit("t").alias("text"))
    rows = merkle.manifest(frame, ["doc_id", "lang", "text"]).collect()
    plain, paths = plain_tree([plain_leaf((k, "hot", "t")) for k in sorted(f"k{i}" for i in range(3000))], 2)
    assert {bytes(r["root"]).hex() for r in rows} == {plain} and all(len(r["path"]) == 12 for r in rows)


def test_crc_in_sql():
    for text in ("0", "123456789", "-1"):
        assert duckdb.sql(f"SELECT {contract_sql.CRC.format('t')} FROM (SELECT '{text}' AS t)").fetchall()[0][0] == zlib.crc32(text.encode())
