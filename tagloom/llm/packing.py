"""Best-fit packing of tokenized documents into sequences of at most ``capacity`` tokens.

1. Documents become pieces in map tasks: token ids, then the end id; a document longer than
   the capacity is cut so that all pieces but the first are full. The narrow rows (place,
   length, digest; the ids only on request) are written to the shared folder.
2. Pieces are dealt by a hash of the whole row to shards of about ``rows_per_shard`` rows and
   sorted within them, so each shard's order is the same in any attempt. Each shard is
   packed as a stream, online and with bounded space: at most ``open_bins`` bins are open, kept
   in stacks by free space, and an integer bitset tells which free spaces occur. A piece goes to
   the open bin with the least room that suffices (best fit); if none does, a new bin is opened,
   and if the bound is reached the fullest bin closes first.

Null and empty texts are a lone end id. Repeated rows are packed once each. Long texts are
tokenized in parts cut at places where the tokenizer cannot join two words.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import text_batches, tidy, written

CAPACITY = 2048
END = (0).to_bytes(4, "little")
PART = 1 << 20
#: The part of the splitting pattern that looks ahead, in a run of white space.
LOOK_AHEAD = r"|\s+(?!\S)"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s")
_STATE: dict = {}


def _byte_ranks(model: dict) -> dict[bytes, int]:
    """Ids by token bytes. Byte-level vocabularies spell each byte as one character: printable
    Latin-1 characters as themselves, the others as code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spelled = {chr(b): b for b in plain}
    spelled |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(spelled[c] for c in token): i for token, i in model["vocab"].items() if all(c in spelled for c in token)}


class Encoder:
    """Text to token ids (little-endian unsigned 32-bit, as bytes).

    Words are merged by the file's vocabulary in tiktoken, which takes a fraction of the time of
    ``tokenizers``. Texts without two white-space characters in a row need no look-ahead in the
    splitting pattern; those that hold an added token's string go to ``tokenizers`` itself."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.load, self.tokenizer = lambda: Tokenizer.from_file(path), None  # wanted by few texts
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {k: v for k, v in _byte_ranks(spec["model"]).items() if v not in self.added.values()}
        full = public_tokenizers.PATTERN
        plain = full.replace(LOOK_AHEAD, "")
        self.full, self.plain = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                                 for p in (full, plain))

    def part(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            self.tokenizer = self.tokenizer or self.load()
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = (self.full if _TWO_SPACES.search(text) else self.plain)(text)
        return array("I", ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if len(text) <= PART:
            return self.part(text)
        out, at = [], 0
        while at < len(text):  # later parts keep the space before them, as their first token needs it
            cut = _CUT.search(text, min(len(text), at + PART))
            end = cut.start() if cut else len(text)
            out.append(self.part(text[at:end]))
            at = end
        return b"".join(out)


def piece_places(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: only the first may be short."""
    first = (n - 1) % capacity + 1
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


class OpenBins:
    """At most ``limit`` open bins, in stacks by free space, with a bitset of the free spaces."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _pop(self, free: int) -> int:
        stack = self.stacks[free]
        bin_ = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of this length."""
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            bin_ = self._pop(free)
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
            if length < self.capacity and self.open >= self.limit:
                self._pop((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        left = free - length
        if left:
            self.stacks[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.capacity - free


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 (and ``ids``)."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _STATE.get(tokenizer_path) or _STATE.setdefault(tokenizer_path, Encoder(tokenizer_path))
        for batch in batches:
            rows, cuts = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + END
                for i, (start, n) in enumerate(piece_places(len(ids) // 4, capacity)):
                    cut = ids[4 * start : 4 * (start + n)]
                    rows.append((k, i, start, n, zlib.crc32(cut)))
                    if with_ids:
                        cuts.append(np.frombuffer(cut, "<u4").astype("int32"))
            at, *rest = zip(*rows) if rows else [()] * 5
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(rest[0], pa.int32()),
                       *[pa.array(x, pa.int64()) for x in rest[1:]]]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(cuts, pa.list_(pa.int32()))] if with_ids else []), names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("piece", T.IntegerType())
    for name in names[2:5]:
        schema = schema.add(name, T.LongType())
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda batches: tidy(run(batches), _STATE), schema)


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = 1024, rows_per_shard: int = 200_000) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32; written before) with ``sequence_id`` and ``offset``."""
    shards = max(1, -(-pieces.count() // rows_per_shard))
    key = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32")
    dealt = pieces.withColumn("_h", key).repartition(shards, "_h").sortWithinPartitions(
        "_h", "doc_id", "piece", "start", "length", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            more = [pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + more, [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.select(*pieces.columns, "_h").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = 1024,
         rows_per_shard: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset."""
    pieces = written(tokenized_pieces(docs, tokenizer_path, capacity, False, id_col, text_col), "packing_pieces")
    return best_fit(pieces, capacity, open_bins, rows_per_shard)


def build_sequences(docs: DataFrame, placed: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids``, and the piece starts within it.

    Ids are made anew and meet their place by the piece's key; a sequence has ``capacity`` ids at most."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    with_ids = tokenized_pieces(docs, tokenizer_path, capacity, True, id_col, text_col).dropDuplicates(key)
    cond = [placed[k].eqNullSafe(with_ids[k]) for k in key]
    rows = placed.join(with_ids, cond).select(placed["sequence_id"], placed["offset"], with_ids["ids"])
    got = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    return got.select("sequence_id", F.flatten(F.transform("_p", lambda x: x["ids"])).alias("ids"),
                      F.transform("_p", lambda x: x["offset"]).alias("offsets"))
