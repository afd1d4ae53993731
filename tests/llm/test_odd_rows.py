"""NULLs, empty and odd texts, ties, repeated rows, empty tables and clashing column names."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import bpe, contracts, language, nearest, packing, quality_neighbours, quality_rules, secrets, simhash, token_files, warc
from patronage.llm.common import components, prepare, run_folder
from tests.llm.conftest import ODD
from tests.llm.test_contracts import library, plain_counts, plain_fingerprint, plain_spans

PATTERN = contracts.PATTERN


def path(name):
    return contracts.TOKENIZERS(name)


def test_simhash_rows(spark, odd):
    prepare(spark)
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    own = {i: plain_fingerprint(t) for i, t in enumerate(ODD)}
    assert all(r["doc_id"] is None or r["fingerprint"] == f"{own[r['doc_id']]:016x}" for r in rows)
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {0, 6}


def test_keep_one_keeps_columns_and_one_of_repeated_rows(spark, odd):
    prepare(spark)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    reached = {r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(reached)
    assert simhash.keep_one(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 8])
def test_links_find_every_pair_also_in_hot_buckets(spark, block):
    prepare(spark)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = {b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (0, 1, 2, 3, 3, 4, 6)}
    # a dense group: all within few bits of one value
    near |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)}
    values = sorted(near)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    table = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    labels = {r["node"] % 2**64: r["label"] for r in simhash.classes(table, "fp", block=block).collect()}
    groups = Counter(root(v) for v in values)
    assert set(labels) == {v for v in values if groups[root(v)] > 1}
    pairs = {(root(v), label) for v, label in labels.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(200, 300 + i) for i in range(50)] + [(7, 7), (None, 3)]
    labels = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert labels == {**{i: 100 for i in range(100, 161)}, 200: 200, **{300 + i: 200 for i in range(50)}}


def test_quality_rules_rows(spark, odd):
    prepare(spark)
    rows = quality_rules.score(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain_counts(ODD[r["doc_id"]])
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() <= len(rows)
    assert quality_rules.score(odd.limit(0)).count() == 0


def test_rule_accuracies_are_found_again():
    rng = np.random.default_rng(5)
    y = rng.random(20_000) < 0.8
    accuracy, coverage = np.array([0.95, 0.9, 0.85, 0.8, 0.9]), np.array([0.9, 0.8, 0.6, 0.7, 0.5])
    right = rng.random((y.size, 5)) < accuracy
    voted = np.where(rng.random((y.size, 5)) < coverage, np.where(right == y[:, None], 1, -1), 0)
    patterns, counts = np.unique(voted, axis=0, return_counts=True)
    model = quality_rules.fit(patterns, counts.astype(float))
    shares = model.tables[:, 1, 2] / (model.tables[:, 1, 2] + model.tables[:, 1, 0])
    assert abs(model.good - 0.8) < 0.05 and np.abs(shares - accuracy).max() < 0.05
    assert ((model.posterior(voted) >= 0.5) == y).mean() > 0.95


def test_secret_rows(spark, odd):
    prepare(spark)
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is not None:
            base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in plain_spans(ODD[r["doc_id"]]))
            assert ",".join(x for x in r["spans"].split(",") if not x.startswith("entropy")) == base
    assert [r["spans"] for r in rows if r["doc_id"] == 18] == ["entropy:4:28"]


def test_window_entropy_is_that_of_its_counts():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef0123456789") for _ in range(200)) + "a" * 60 + "".join(rng.choice("xyz123") for _ in range(50))
    for least in (2.0, 3.0, 3.5):
        hit = set()
        for i in range(len(text) - 19):
            counts = Counter(text[i:i + 20]).values()
            if -sum(c / 20 * math.log2(c / 20) for c in counts) >= least - 1e-12:
                hit |= set(range(i, i + 20))
        assert hit == {i for s, e in secrets.random_parts(text, 20, least) for i in range(s, e)}


def test_redaction_keeps_rows_and_columns(spark, odd):
    prepare(spark)
    done = secrets.redact(odd, length="n_chars")
    assert done.columns == odd.columns and done.count() == odd.count()
    text = done.where("doc_id = 17").first()
    assert text["text"] == "password: abc, [assign] [assign]' [access] [hex]" and text["n_chars"] == len(text["text"])


def test_packing_limits_hold_at_once(spark, odd):
    prepare(spark)
    limits = packing.Limits(tokens=64, segments=3, loss=40, window=5)
    with_prompt = odd.withColumn("prompt", F.lit("answer this question please"))
    rows = packing.pack(with_prompt, "doc_id", "text", path("byte_bpe_50k.tiktoken"), PATTERN, prompt="prompt", limits=limits).collect()
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for parts in sequences.values():
        assert len(parts) <= 3 and sum(p["length"] for p in parts) <= 64 and sum(p["loss_tokens"] for p in parts) <= 40
        assert all(len(p["ids"]) == 4 * p["length"] for p in parts)
    total = sum(r["length"] for r in rows)
    silent = odd.count() * len(packing.Encoder(path("byte_bpe_50k.tiktoken"), PATTERN).encode("answer this question please")) // 2
    assert total - sum(r["loss_tokens"] for r in rows) == silent
    assert packing.pack(odd.limit(0), "doc_id", "text", path("byte_bpe_50k.tiktoken"), PATTERN).count() == 0


def test_ids_are_those_of_the_tokenizers_library(spark, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    encoder = packing.Encoder(path("byte_bpe_50k.tiktoken"), PATTERN, {"<|endoftext|>": contracts.END_OF_TEXT}, memory=3)
    for text in ODD:
        assert np.frombuffer(encoder.encode(text or ""), "<u2").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_bpe_rows(spark, odd):
    prepare(spark)
    encoding = library()
    rows = bpe.decode(bpe.encode(odd, path("byte_bpe_multi_50k.tiktoken"), PATTERN, block_bytes=500), path("byte_bpe_multi_50k.tiktoken")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is not None:
            text = ODD[r["doc_id"]] or ""
            assert (r["ids"], bytes(r["decoded"])) == (encoding.encode_ordinary(text), text.encode())
    assert bpe.encode(odd.limit(0), path("byte_bpe_multi_50k.tiktoken"), PATTERN).count() == 0


def test_bpe_of_a_word_of_a_megabyte(spark):
    prepare(spark)
    draw, encoding = random.Random(4), library()
    long = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)), "ab" * 100_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    rows = bpe.encode(docs, path("byte_bpe_multi_50k.tiktoken"), PATTERN).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: encoding.encode_ordinary(t) for i, t in enumerate(long)}


def test_bpe_remembers_words_between_blocks(spark, odd):
    prepare(spark)
    encoding = library()
    for block, memory in ((1, 10**6), (200, 0), (200, 20)):
        rows = bpe.encode(odd.coalesce(1), path("byte_bpe_multi_50k.tiktoken"), PATTERN, block_bytes=block, memory=memory).collect()
        assert len(rows) == odd.count()
        for r in rows:
            if r["doc_id"] is not None:
                assert r["ids"] == encoding.encode_ordinary(ODD[r["doc_id"]] or ""), (block, memory)


def test_bpe_folds_words_of_merged_splits_once(spark):
    prepare(spark)
    many = spark.range(0, 200, 1, 100).selectExpr("id AS doc_id", "'alpha beta' AS text")
    pieces = {b: chr(bpe.FIRST + b) for b in range(256)}
    folded = lambda docs: sum(len(r["words"]) for r in bpe.blocks(docs, contracts.PATTERN, pieces, 1 << 20, 1000).collect())
    assert (folded(many), folded(bpe.merged(many))) == (200, 100)
    assert bpe.merged(many.coalesce(3)).rdd.getNumPartitions() == 3  # no core goes idle for it


def test_separators_are_stitched_across_blocks(spark, odd):
    prepare(spark)
    folder = run_folder(spark, "token-test")
    manifest = token_files.write_token_files(odd, "doc_id", "text", path("byte_bpe_multi_50k.tiktoken"), PATTERN, 50256, folder, file_tokens=700)
    sizes = {}
    for block in (7, 64, 1 << 20):
        found = token_files.scan_separators(spark, manifest, folder, 50256, block_tokens=block)
        sizes[block] = sorted(manifest.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "closed").collect(), key=str)
    assert sizes[7] == sizes[64] == sizes[1 << 20] and len(sizes[7]) == odd.count()
    encoding = library()
    assert all(r["closed"] and (r["doc_id"] is None or r["n_tokens"] == len(encoding.encode_ordinary(ODD[r["doc_id"]] or ""))) for r in sizes[7])


def test_open_document_at_the_end_of_a_file(spark, tmp_path):
    np.array([1, 2, 9, 9, 5], "<u2").tofile(tmp_path / "a.bin")
    np.array([], "<u2").tofile(tmp_path / "b.bin")
    files = spark.createDataFrame([("a.bin",), ("b.bin",)], "file string")
    for block in (1, 2, 100):
        rows = token_files.scan_separators(spark, files, str(tmp_path), 9, block_tokens=block).orderBy("ordinal").collect()
        assert [(r["start"], r["n_tokens"], r["closed"]) for r in rows] == [(0, 2, True), (3, 0, True), (4, 1, False)]


def test_languages(spark, documents, odd):
    prepare(spark)
    identifier = language.fit(documents, calibrate=F.col("doc_id") % 4 == 1, hash_bits=20)
    rows = language.identify(odd, identifier).collect()
    assert len(rows) == odd.count() and "_score" in rows[0].asDict()
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and by_id[0]["_score"] == 0
    assert by_id[12]["lang_pred"] == "und" and by_id[12]["best"] in {"en", "de", "fr", "es"}
    nothing = language.fit(documents.limit(0), calibrate=F.lit(False))
    assert {r["best"] for r in language.identify(odd, nothing).collect()} == {"und"}


def test_language_probabilities_sum_to_one(spark, documents):
    prepare(spark)
    model = language.fit(documents.where("lang = 'en'"), hash_bits=24).models["en"]
    table = language.letter_table()
    context = language.grams(language.units(b"the thing", table))[3] >> np.uint64(16) << np.uint64(16)
    letters = np.unique(np.concatenate([language.units(r["text"].encode(), table) for r in documents.where("lang = 'en'").collect()]))
    assert abs(np.exp2(model.log2(context | letters)).sum() - 1) < 0.02


def test_neighbours_without_labels_and_odd_rows(spark, odd, documents):
    prepare(spark)
    labels = spark.createDataFrame([(6, 1), (16, 0), (16, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality_neighbours.fit(odd, labels)
    rows = quality_neighbours.with_scores(odd, model, "text", "found").collect()
    assert len(rows) == odd.count() and {r["found"] < 0.5 for r in rows if r["doc_id"] == 16} == {True}
    empty = quality_neighbours.fit(odd, labels.limit(0))
    assert {r["found"] for r in quality_neighbours.with_scores(odd, empty, "text", "found").collect()} == {0.5}
    assert quality_neighbours.keep_good(odd, model).columns == odd.columns


def test_leading_vectors_of_many_rows_take_no_matrix_of_rows_by_rows(monkeypatch):
    rng, plain = np.random.default_rng(3), np.linalg.eigh
    whole = (rng.standard_normal((2000, 300)) * np.geomspace(1, 1e-3, 300)).astype(np.float32)
    whole[1000:1500] = whole[:500]  # rows may repeat
    values, left = plain(whole @ whole.T)

    def small(matrix):
        assert len(matrix) <= quality_neighbours.SPACE
        return plain(matrix)

    monkeypatch.setattr(np.linalg, "eigh", small)
    found, vectors = quality_neighbours.leading(whole, 48)
    np.testing.assert_allclose(found, values[::-1][:48], rtol=1e-4)
    np.testing.assert_allclose(np.abs((vectors * left[:, ::-1][:, :48]).sum(axis=0)), 1, atol=1e-3)
    flat, _ = quality_neighbours.leading(np.repeat(whole[:2], 800, axis=0), 48)  # two rows, each 800 times
    np.testing.assert_allclose(flat[:2], plain(800 * (whole[:2] @ whole[:2].T))[0][::-1], rtol=1e-4)
    assert (flat[2:] < 1e-6 * flat[0]).all()


def test_nearest_leaves_out_what_has_no_direction(spark):
    prepare(spark)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(1, 400)] + [(i, [1.0, 1.0, 1.0]) for i in range(400, 700)]
    rows += [(700, None), (800, [0.0, 0.0, 0.0]), (900, [1.0, None, 2.0]), (1000, [math.nan, 1.0, 1.0]), (1100, [math.inf, 1.0, 1.0]),
             (None, [1.0, 2.0, 3.0]), (1200, [1.0, 2.0]), (1300, [5.0, 1.0]), (400, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.search(table, table.where("vec_id % 100 = 0"), shard_rows=50, block_rows=2).collect()
    usable = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    asked = {i: v for i, v in usable if i % 100 == 0}
    got: dict = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q, v in asked.items():
        near = sorted((float(np.sqrt(np.cumsum((v - x) ** 2)[-1])), i) for i, x in usable if i != q and len(x) == len(v))[:10]
        assert got[q] == [i for _, i in near], q
    assert set(got) == set(asked)
    assert nearest.search(table.limit(0), table).count() == 0


def test_relaxed_pruning_keeps_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = centres[rng.integers(0, 20, 3000)] + 0.2 * rng.normal(size=(3000, 16))
    tree = nearest.Tree.build(np.arange(3000), rows)
    asked = np.arange(0, 3000, 50)
    exact, relaxed = (tree.search(asked, rows[asked], 10, f)[1] for f in (1.0, 0.8))
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, relaxed)]) >= 0.9


def test_warc_rows_rolling_and_equal_runs(spark):
    prepare(spark)
    long = "x" * 200
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * (i % 40)) for i in range(300)] + [
        (500, None, long), (501, "http://é/ü \n", long), (502, "u", "short"), (503, "u", "short"), (504, "u", None), (504, "u", None),
        (None, "n", long), (None, "only", "y" * 150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = []
    for part in (1, 5):
        folder = run_folder(spark, "warc-test")
        manifest = warc.write(pages.repartition(part), folder, shard_bytes=4000, file_bytes=1500).orderBy("name").collect()
        names.append([(r["name"], r["sha256"]) for r in manifest])
        assert len(manifest) > 5 and len({r["shard"] for r in manifest}) > 2
    assert names[0] == names[1]
    found = warc.read(spark, folder).collect()
    assert sorted((str(r["key"]), r["payload_bytes"]) for r in found) == sorted((str(k), len((h or "").encode())) for k, _, h in rows)
    kinds = {(r["key"], r["uri"]): (r["record_type"], r["refers_to"]) for r in found}
    assert kinds[500, None] == ("response", None) and kinds[None, "n"] == ("revisit", 500) and kinds[None, "only"] == ("response", None)
    assert kinds[503, "u"] == ("response", None)
    empty = run_folder(spark, "warc-test")
    assert warc.write(pages.limit(0), empty).count() == 0 and warc.read(spark, empty).count() == 0


def test_files_are_read_in_more_than_one_task(spark):
    prepare(spark)
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), F.sha2(F.col("id").cast("string"), 512)).alias("html"))
    folder = run_folder(spark, "warc-test")
    assert warc.write(pages, folder, shard_bytes=8000, file_bytes=4000).count() > 8
    read = warc.read(spark, folder)
    assert read.count() == 400 and read.select(F.spark_partition_id()).distinct().count() > 2
    tokens = run_folder(spark, "token-test")
    manifest = token_files.write_token_files(pages, "page_id", "html", path("byte_bpe_multi_50k.tiktoken"), PATTERN, 50256, tokens)
    found = token_files.scan_separators(spark, manifest, tokens, 50256, block_tokens=500)
    assert found.count() == 400 and found.select(F.spark_partition_id()).distinct().count() > 2
