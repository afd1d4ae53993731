"""Byte-level byte-pair encoding by Spark's higher-order functions, and decoding.

A task splits its texts into the matches of the pre-tokenising pattern and hands on, per block of texts, the distinct words
that no earlier block of the task held, and where words occur. Spark folds the ranked merges over each distinct word. A word is an array of pieces, at first its
bytes, and is held as a string with one character per piece, so that a merge is the replacement of two characters by one.
The merges that a word can need are those of the tokens among its substrings; they are looked up in a literal map of ranks,
sorted by rank and folded over the word, each replacing all its pairs from left to right.

One pass in the order of ranks is exact when ranks are a merge order: each token arises from exactly one pair of tokens, both
of lower rank, whatever surrounds it. ``merges`` derives that pair for every token and refuses a rank file where it fails.

The ids of the words are then laid out along the documents. Decoding joins the binary pieces of ids. No row is shuffled, and
what is held is bounded by a block and by ``memory`` words, not by the corpus: the steps before and after the fold number a
task's words alike and remember them, and begin anew at the first block after that many.

Edge cases: a NULL or empty text has no ids and decodes to no bytes; repeated rows are encoded each; an empty table gives no
rows; the time for a very long word grows with its length times its distinct merges.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .tokens import read_ranks, segments

BUCKETS = 1 << 16
REACHES = 1 << 17
HEAD = 4
#: pieces up to which a word is short
SHORT = 100
#: piece i is the character with this code point plus i; beyond the basic plane every code point is a character
FIRST = 0x10000


def character(rank: int) -> str:
    return chr(FIRST + rank)


def merges(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes]]:
    """The pair that each token of two or more bytes arises from: what is left of it when only one merge is missing."""
    found = {}
    for token, limit in ranks.items():
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, limit) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(pairs)
            if least >= limit:
                raise ValueError(f"no merges lead to token {limit}")
            at = pairs.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            if max(ranks[p] for p in parts) >= limit:
                raise ValueError(f"token {limit} comes before its parts")
            found[token] = parts[0], parts[1]
    return found


def merge_literal(ranks: dict[bytes, int]) -> Column:
    """array<map<token, (rank, pair, piece)>>, dealt into buckets by hash because a look-up walks over the keys of a map; the
    optimizer folds it into one literal. Tokens are written as the characters of their bytes."""
    buckets: list[dict[str, dict]] = [{} for _ in range(BUCKETS)]
    for token, pair in merges(ranks).items():
        name = "".join(character(ranks[token[i:i + 1]]) for i in range(len(token)))
        entry = {"r": ranks[token], "f": "".join(character(ranks[p]) for p in pair), "t": character(ranks[token])}
        buckets[xxhash.xxh64_intdigest(name.encode(), 42) % BUCKETS][name] = entry
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"), ensure_ascii=False)),
                       "array<map<string,struct<r:int,f:string,t:string>>>")


def reach_literal(ranks: dict[bytes, int]) -> Column:
    """array<int>: by the hash of ``HEAD`` characters, the longest token that begins with them, one less than ``HEAD`` without
    such a token. Longer substrings need no look-up; characters that share a hash share the greater length."""
    reach = [HEAD - 1] * REACHES
    for token in ranks:
        if len(token) >= HEAD:
            head = "".join(character(ranks[token[i:i + 1]]) for i in range(HEAD))
            at = xxhash.xxh64_intdigest(head.encode(), 42) % REACHES
            reach[at] = max(reach[at], len(token))
    return F.from_json(F.lit(json.dumps(reach, separators=(",", ":"))), "array<int>")


def encoded_word(word: Column, table: Column, reach: Column) -> Column:
    """The pieces of one word, given and returned as characters.

    Substrings are listed before they are looked up, so each is cut once, though a look-up names it twice. A long word's are cut
    from its bytes, four a character, as a string is walked over from its start each time, and what repeats is folded once.
    """
    def bucket(piece: Column, of: int = BUCKETS) -> Column:
        # the remainder of a power of two, as the buckets were dealt
        return F.xxhash64(piece).bitwiseAND(F.lit(of - 1)).cast("int")

    def merge_of(piece: Column) -> Column:
        return F.element_at(F.get(table, bucket(piece)), piece)

    def beginnings(size: Column, cut) -> Column:
        """From every place, the substrings that may be tokens."""
        return F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda place: F.transform(
            F.sequence(F.lit(2), F.least(F.get(reach, bucket(cut(place, F.lit(HEAD)), REACHES)), size - place + 1)),
            lambda length: cut(place, length).cast("string"))))

    def of_bytes(content: Column) -> Column:
        return beginnings(F.shiftright(F.octet_length(content), 2), lambda place, length: F.substring(content, place * 4 - 3, length * 4))

    short = beginnings(F.shiftright(F.octet_length(word), 2), lambda place, length: F.substring(word, place, length))
    long = F.array_distinct(F.get(F.transform(F.array(word.cast("binary")), of_bytes), F.lit(0)))
    found = F.when(F.octet_length(word) <= 4 * SHORT, short).otherwise(long)
    folded = F.aggregate(F.sort_array(F.array_compact(F.transform(found, merge_of))), word, lambda pieces, m: F.replace(pieces, m["f"], m["t"]))
    return F.when(F.octet_length(word) < 8, word).otherwise(folded)


class Numbers(dict):
    """A number for every key, in the order in which keys are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


BLOCK = "known int, words array<string>, word_of binary, segment_ends binary, segment_of binary, doc_ends binary, doc_ids array<long>"


def blocks(docs: DataFrame, pattern: str, pieces: dict[int, str], block_bytes: int, memory: int) -> DataFrame:
    """One row per block of texts: how many words are known from the task's earlier blocks, its other distinct words as
    characters, the words of each distinct segment, the segments of each document. ``pieces`` gives the character of every
    byte, by its code. None is known in the first block and in the one after more than ``memory`` words.

    Segments are cut where every match starts anew.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        match = regex.compile(pattern)
        ids, counts, refs, parts, held = [], [], [], Numbers(), 0
        words: dict[str, int] = Numbers()

        def out() -> pa.RecordBatch:
            nonlocal ids, counts, refs, parts, held, words
            known = len(words)
            word_of, ends = array("i"), array("i")
            for part in parts:  # the first segment of a text stands in a tuple and has no blank in front
                word_of.extend([words[w] for w in match.findall(part[0] if type(part) is tuple else " " + part)])
                ends.append(len(word_of))
            fresh = [w.encode().decode("latin-1").translate(pieces) for w in islice(words, known, None)]
            row = [pa.array([known], pa.int32()), pa.array([fresh], pa.list_(pa.string())), *(
                pa.array([x.tobytes()], pa.binary()) for x in (word_of, ends)),
                pa.array([np.concatenate(refs).tobytes() if refs else b""], pa.binary()),
                pa.array([np.cumsum(counts, dtype=np.int64).astype(np.int32).tobytes()], pa.binary()), pa.array([ids], pa.list_(pa.int64()))]
            ids, counts, refs, parts, held = [], [], [], Numbers(), 0
            if len(words) > memory:
                words = Numbers()
            return pa.RecordBatch.from_arrays(row, names=[f.split()[0] for f in BLOCK.split(", ")])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                if text:
                    found = segments(text)
                    own = [parts[found[0],], *map(parts.__getitem__, found[1:])]
                    refs.append(np.array(own, np.int32))
                    counts.append(len(own))
                    held += len(text)
                else:
                    counts.append(0)
                if held >= block_bytes:
                    yield out()
        if ids:
            yield out()

    return docs.mapInArrow(run, BLOCK)


def merged(docs: DataFrame, of: int = 2, spare: int = 2) -> DataFrame:
    """``docs``, a table as read, with ``of`` splits in a task as long as each core has ``spare`` tasks: words they share are folded once."""
    splits, cores = docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism
    return docs.coalesce(max(-(-splits // of), min(splits, spare * cores)))


def laid_out(values: np.ndarray, ends: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists given by flat ``values`` and ``ends``, picked by ``refs`` and joined: (flat values, end of each pick)."""
    starts = np.concatenate([[0], ends[:-1]])[refs]
    sizes = ends[refs] - starts
    after = np.cumsum(sizes)
    return values[np.repeat(starts - (after - sizes), sizes) + np.arange(after[-1] if after.size else 0)], after


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = 3 << 20,
           memory: int = 450_000, rows_out: int = 64) -> DataFrame:
    """(doc_id, ids array<int>), one row per document."""
    spark = docs.sparkSession
    # else the literal is printed whole wherever the plan is
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")
    ranks = read_ranks(path)
    table, reach = merge_literal(ranks), reach_literal(ranks)
    pieces = {b: character(ranks[bytes([b])]) for b in range(256)}
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = blocks(narrow, pattern, pieces, block_bytes, memory).select(
        "known", F.transform("words", lambda word: encoded_word(word, table, reach)).alias("encoded"),
        "word_of", "segment_ends", "segment_of", "doc_ends", "doc_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, ends_of_words = np.empty(0, np.int32), np.empty(0, np.int64)  # the ids of the words that the task knows
        for batch in batches:
            for i in range(batch.num_rows):
                known = batch.column(0)[i].as_py()
                if known not in (0, len(ends_of_words)):
                    raise ValueError("blocks of a task are not in order")
                words = batch.column(1).slice(i, 1).flatten().cast(pa.large_string())
                word_of, segment_ends, segment_of, doc_ends = (np.frombuffer(batch.column(c)[i].as_py(), np.int32).astype(np.int64)
                                                               for c in range(2, 6))
                # every piece is a character of four bytes, so byte lengths give the numbers of ids
                _, ends, data = words.buffers()
                ends = np.frombuffer(ends, np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
                sizes = np.diff(ends) // 4
                text = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().decode() if len(words) else ""
                fresh = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int32) - FIRST
                ends_of_words = ends_of_words[:known]
                of_words = np.concatenate([of_words[:ends_of_words[-1] if known else 0], fresh])
                ends_of_words = np.concatenate([ends_of_words, (ends_of_words[-1] if known else 0) + np.cumsum(sizes)])
                values, word_ends = laid_out(of_words, ends_of_words, word_of)
                segment_ids = values, np.concatenate([[0], word_ends])[segment_ends]
                doc_ids, doc_starts = batch.column(6).slice(i, 1).flatten(), np.concatenate([[0], doc_ends])
                for first in range(0, len(doc_ids), rows_out):  # few documents at a time, to hold few ids
                    bounds = doc_starts[first:first + rows_out + 1]
                    found, after = laid_out(*segment_ids, segment_of[bounds[0]:bounds[-1]])
                    offsets = np.concatenate([[0], after])[bounds - bounds[0]]
                    listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found, pa.int32()))
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(first, rows_out), listed], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def joined_pieces(pieces: pa.Array, column: pa.ListArray) -> pa.Array:
    """The pieces of each row's ids, joined: taking pieces lays them end to end, so only the rows' bounds are looked up."""
    offsets = column.offsets.to_numpy()
    ids = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    least, most = (v.as_py() for v in pc.min_max(ids).values())
    if least is not None and (least < 0 or most >= len(pieces)):
        raise ValueError("an id is beyond the ranks")
    taken = pieces.take(ids)
    _, ends, data = taken.buffers()
    places = np.frombuffer(ends, np.int64)[taken.offset:taken.offset + len(taken) + 1][offsets - offsets[0]]
    return pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(places), data]).cast(pa.binary())


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded", listed: str | None = None) -> DataFrame:
    """``rows`` with the bytes of ``ids`` in ``out``; NULL ids decode to no bytes, an id beyond the ranks is an error. ``listed``
    names one more column, for the ids in decimal with a comma after each."""
    at = rows.columns.index(ids)
    names = [out, *([listed] if listed else [])]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.BinaryType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        tables = [pa.array(p, pa.large_binary()) for p in (pieces, [b"%d," % i for i in range(len(pieces))])[:len(names)]]
        for batch in batches:
            column = pc.fill_null(batch.column(at), []) if batch.column(at).null_count else batch.column(at)
            found = [joined_pieces(p, column) for p in tables]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


ship(__name__)
