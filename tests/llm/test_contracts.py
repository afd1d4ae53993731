"""Every registered query against a plain calculation over the same rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from patronage.llm import contracts, queries
from tests.llm.conftest import DATA

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(spark, name):
    return queries()[name](spark, DATA).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_warc(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    first = {}
    for page in sorted(pages):
        first.setdefault(pages[page], page)
    found = {r["page_id"]: r for r in rows_of(spark, "op1_warc")}
    assert set(found) == set(pages)
    for page, body in pages.items():
        r = found[page]
        revisit = len(body) >= 100 and first[body] != page
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[body]) if revisit else ("response", None))


def test_language(spark, documents):
    langs = {r["doc_id"]: r["lang"] for r in documents.collect()}
    found = rows_of(spark, "op2_language")
    assert sorted(r["doc_id"] for r in found) == sorted(langs)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = BLANKS.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op3_simhash")}
    assert found == {d: (f"{p:016x}", root(d)) for d, p in prints.items()}


def plain_counts(text):
    words = BLANKS.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if BLANKS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark, texts):
    for r in rows_of(spark, "op4_quality_rules"):
        counts = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        bad = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r["base_failed"] == bad and not (bad and r["kept"])


def test_quality_rules_follow_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows_of(spark, "op4_quality_rules") if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(bool(y) == k for y, k in judged) >= 0.9 * len(judged)


def test_nearest(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    found = defaultdict(list)
    for r in sorted(rows_of(spark, "op5_vantage_points"), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == {i for i in vectors if i % 100 == 0}
    for q, near in found.items():
        exact = sorted((math.sqrt(np.cumsum((vectors[q] - v) ** 2)[-1]), i) for i, v in vectors.items() if i != q)[:10]
        assert [i for i, _ in near] == [i for _, i in exact]
        assert [s for _, s in near] == pytest.approx([s for s, _ in exact], rel=1e-14)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(contracts.TOKENIZERS("byte_bpe_50k.json"))
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for d, t in texts.items()}
    pieces = rows_of(spark, "op6_packing")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r["doc_tokens"] == ids[r["doc_id"]].size
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes())
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        assert [s for s, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        assert sum(n for _, n in parts) == ids[d].size
    padding = 0
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        total = sum(n for _, n in parts)
        assert total <= 1024
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    assert padding <= 0.01 * sum(v.size for v in ids.values())


def plain_spans(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark, texts):
    for r in rows_of(spark, "op7_secrets"):
        spans = plain_spans(texts[r["doc_id"]])
        kinds = Counter(s[2] for s in spans)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("entropy")) == joined


def test_quality_neighbours(spark, texts):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    found = rows_of(spark, "op8_quality_neighbours")
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in found)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)


def library():
    import tiktoken

    from patronage.llm.tokens import read_ranks

    ranks = read_ranks(contracts.TOKENIZERS("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("plain", pat_str=contracts.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts(spark, texts):
    encoding = library()
    found = rows_of(spark, "op9_token_counts")
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {d: len(encoding.encode_ordinary(t or "")) for d, t in texts.items()}
    by_file = defaultdict(list)
    for r in found:
        by_file[r["file"]].append((r["ordinal"], r["start"], r["n_tokens"]))
    for parts in by_file.values():
        parts.sort()
        assert [o for o, _, _ in parts] == list(range(len(parts)))
        assert [s for _, s, _ in parts] == [0, *itertools.accumulate(n + 1 for _, _, n in parts)][:-1]


def test_bpe(spark, texts):
    encoding = library()
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(spark, "op10_bpe")}
    expected = {}
    for d, t in texts.items():
        ids = encoding.encode_ordinary(t or "")
        expected[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert found == expected
