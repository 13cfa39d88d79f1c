"""Best-fit packing of tokenized documents by exact-complement hashing.

Pieces of equal length are interchangeable, so the packing is planned on counts by length, a
table of at most ``capacity`` entries whatever the input.  The plan takes the longest remaining
length and looks for pieces that fill its gap exactly: a single length, a pair or a triple, from
hashed sums of available lengths, consuming as many such combinations at once as the counts
allow.  What has no exact complement takes the largest lengths that fit, again in bulk.

A plan is a short list of patterns (lengths of one sequence, and how many such sequences).
Pieces get a running number within their length, from counts by task and offsets, and the
number picks pattern, sequence and offset.  Texts are tokenized once; only piece rows move.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from facilitymetrics.llm.scratch import written

# Fixed value: how the byte-level vocabulary cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Beyond these characters, libraries may differ in the Unicode version of their tables.
_UNCOMMON = re.compile("[^\x00-\u024f]")


class Encoder:
    """Token ids of texts, as the tokenizer file defines them.

    ``ranks`` names the same vocabulary as merge ranks.  With it, texts of common letters without a
    special token's string are encoded from the ranks, which is several times faster and gives
    the same ids; all others go to the tokenizer.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def _slow(self, text: str) -> bool:
        return self.fast is None or bool(_UNCOMMON.search(text)) or any(x in text for x in self.special)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        rest = [k for k, text in enumerate(texts) if self._slow(text)]
        found = self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)
        slow = dict(zip(rest, (x.ids for x in found)))
        return [
            np.array(slow[k] if k in slow else self.fast.encode_ordinary(text), "<u4")
            for k, text in enumerate(texts)
        ]


_ENCODERS: dict[tuple, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int, ranks: str | None = None, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of ``docs (doc_id, text)``.

    A document is its ids followed by ``end_id``.  A longer one than ``capacity`` is cut from
    its end into full pieces, so that only the first piece is shorter.
    """
    schema = T.StructType([docs.schema["doc_id"], *(
        T.StructField(n, t) for n, t in (
            ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())
        )
    )])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer, ranks) not in _ENCODERS:
            _ENCODERS[tokenizer, ranks] = Encoder(tokenizer, ranks)
        encoder = _ENCODERS[tokenizer, ranks]
        tail = np.array([end_id], "<u4")
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                rows, found = [], []
                for row, ids in enumerate(encoder.ids([x or "" for x in part.column(1).to_pylist()])):
                    ids = np.concatenate([ids, tail])
                    cut = len(ids) % capacity or capacity
                    edges = [0, *range(cut, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append(row)
                        found.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(columns[0], pa.int32()),
                    *(pa.array(x, pa.int64()) for x in columns[1:]),
                ], names=schema.names)

    return docs.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """``(lengths, sequences)``: how many sequences hold pieces of these lengths, in order."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int], most: int | None = None) -> int:
        """Consume as many such sequences as there are pieces for."""
        need = np.bincount(lengths, minlength=capacity + 1)
        used = np.flatnonzero(need)
        n = int((left[used] // need[used]).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[used] -= n * need[used]
            out.append((lengths, n))
        return n

    def complements(length: int, gap: int) -> Iterator[list[int]]:
        """Available single, pair and triple lengths with the sum ``gap``."""
        if left[gap]:
            yield [gap]
        low = np.arange(1, gap // 2 + 1)
        pairs = low[(left[low] > 0) & (left[gap - low] > 0)]
        for a in pairs[::-1]:
            yield [int(gap - a), int(a)]
        for a in np.flatnonzero(left[1 : gap - 1])[::-1] + 1:
            rest = gap - a
            low = np.arange(1, rest // 2 + 1)
            low = low[(low <= a) & (rest - low <= a)]
            low = low[(left[low] > 0) & (left[rest - low] > 0)]
            if len(low):
                yield [int(a), int(rest - low[-1]), int(low[-1])]

    for length in range(capacity, 0, -1):
        gap = capacity - length
        if not left[length]:
            continue
        if not gap:
            take([length])
            continue
        for fill in complements(length, gap):
            if not left[length]:
                break
            take([length, *fill])
        while left[length]:
            # No exact filling is left: the largest lengths that fit, then in bulk.
            own, gap = [length], capacity - length
            left[length] -= 1
            while gap:
                fits = np.flatnonzero(left[1 : gap + 1])
                if not len(fits):
                    break
                best = int(fits[-1]) + 1
                own.append(best)
                left[best] -= 1
                gap -= best
            for x in own:
                left[x] += 1
            take(own)
    return out


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    ranks: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every piece of every document, with its ``sequence_id`` and ``offset`` there.

    A null or empty text is the end token alone.  Rows without an id, or that repeat one, are
    documents of their own.  Sequences are filled without gaps from offset 0.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Row numbers are written with the rows, so they cannot change any more.
    found = written(pieces(docs, tokenizer, capacity, ranks).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, sequence, used = [], 0, {}
    for lengths, n in plan(counts, capacity):
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            # Piece numbers first .. first + n - 1 of this length go to successive sequences.
            slots.append((length, first, first + n, sequence - first, offset))
            used[length] = first + n
            offset += length
        sequence += n
    # At most a few entries for each length up to the capacity, whatever the input.
    schema = "length long, first long, stop long, shift long, offset long"
    slots = spark.createDataFrame(slots, schema) if slots else spark.createDataFrame([], schema)
    return _numbered(found).join(F.broadcast(slots), "length").where("number >= first and number < stop").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("number") + F.col("shift")).alias("sequence_id"), "offset",
    )


def _numbered(found: DataFrame) -> DataFrame:
    """Pieces with a running ``number`` within their length.

    Numbers are dealt within (length, salt) and shifted by the rows of earlier salts, so a length
    that most pieces have is spread over many tasks.
    """
    salted = found.withColumn("salt", F.col("row") % 1024)
    per = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("row")
    within = salted.withColumn("k", F.row_number().over(order) - 1)
    return within.join(per, ["length", "salt"]).withColumn("number", F.col("before") + F.col("k"))
