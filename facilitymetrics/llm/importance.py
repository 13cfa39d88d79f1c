"""Importance resampling towards a target set, from hashed n-gram counts.

1. Each text is normalised once: A-Z lower-cased, words (runs of a-z, 0-9 and characters above 0x7F) with a
   single space behind each.
2. The running CRC-32 of the normalised bytes is kept at every byte.  The CRC of any n-gram follows from the two at
   its ends: that of the bytes before it is shifted over the n-gram (multiplied by x to the power of 8 times its length,
   modulo the CRC polynomial over GF(2)) and cancelled by exclusive or.  So n-grams of all lengths come
   from one scan, and no n-gram is ever built.
3. Corpus and target are counted by bucket (CRC modulo ``buckets``) in each task and summed by Spark; what reaches
   the driver is one number for each bucket, whatever the input.
4. A second scan adds up the bucket gains of each text.  Gumbel noise from a hash of the id makes the best scores a
   sample without replacement.
5. Ranks: rows are dealt by range of score, sorted in each task and numbered from the counts of the tasks before.

A null text counts as an empty one: no features, weight 0.  Rows are scored one by one, so copies and repeated ids
give a row each, ties of score and id in any order; a null id is hashed as an empty one and comes last among ties.  An empty
target or corpus leaves the smoothing in the gains.  Only ``doc_id`` and ``text`` are read, so other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.llm.scratch import written
from facilitymetrics.llm.words import GROUP_BYTES, plain

_POLYNOMIAL = 0xEDB88320
_ELIGIBLE = -1  # the row that counts texts with enough words, beside the buckets

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[0x80:] = True


def _byte_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(_POLYNOMIAL), crc >> 1)
    return crc


_TABLE = _byte_table()


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space behind each word, the words' starts and ends there, and each text's first word."""
    low = _LOWER[data]
    inside = _IN_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(low), bool), np.zeros(len(low), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    behind = np.cumsum(ends - starts + 1)
    out = np.full(int(behind[-1]) if len(behind) else 0, 0x20, np.uint8)
    kept = np.ones(len(out), bool)
    kept[behind - 1] = False
    out[kept] = low[inside]
    return out, behind - 1 - (ends - starts), behind - 1, first


def running_crcs(data: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[:i]`` for every i, in lanes that advance together."""
    n = len(data)
    width = math.isqrt(n) + 1
    lanes = -(-n // width)
    padded = np.zeros(lanes * width, np.uint8)
    padded[:n] = data
    begin, crc = np.zeros(lanes, np.uint32), 0
    for k in range(1, lanes):
        crc = zlib.crc32(padded[(k - 1) * width : k * width], crc)
        begin[k] = crc
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
    out = np.empty((width, lanes), np.uint32)
    state = ~begin
    for k in range(width):
        state = _TABLE[(state ^ columns[k]) & 0xFF] ^ (state >> 8)
        out[k] = state
    crcs = np.zeros(n + 1, np.uint32)
    crcs[1:] = ~out.T.reshape(-1)[:n]
    return crcs


def _applied(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    """A linear map, given by its values for each byte of a CRC."""
    return (
        table[..., 0, :][crcs & 0xFF]
        ^ table[..., 1, :][(crcs >> 8) & 0xFF]
        ^ table[..., 2, :][(crcs >> 16) & 0xFF]
        ^ table[..., 3, :][crcs >> 24]
    )


@lru_cache(maxsize=8)
def _shifts(level: int) -> np.ndarray:
    """``[d]`` is the map that shifts a CRC over ``d * 256 ** level`` bytes."""
    identity = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    if level:
        below = _shifts(level - 1)
        one = _applied(below[255], below[1])
    else:
        one = _TABLE[identity & 0xFF] ^ (identity >> 8)
    out = np.empty((256, 4, 256), np.uint32)
    out[0] = identity
    for d in range(1, 256):
        out[d] = _applied(one, out[d - 1])
    return out


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC shifted over so many bytes."""
    out, rest, level = crcs.copy(), lengths.astype(np.int64), 0
    while rest.any():
        table, d = _shifts(level).reshape(-1), (rest & 0xFF) << 10
        out = (
            table[d + (out & 0xFF)]
            ^ table[d + 256 + ((out >> 8) & 0xFF)]
            ^ table[d + 512 + ((out >> 16) & 0xFF)]
            ^ table[d + 768 + (out >> 24)]
        )
        rest, level = rest >> 8, level + 1
    return out


def _ngrams(column: pa.Array, longest: int) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For groups of texts: words of each text, and for each n (text of each n-gram, its CRC)."""
    data, offsets = plain(column)
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + GROUP_BYTES, "right")) - 1
        end = min(rows, max(end, begin + 1))
        part = data[offsets[begin] : offsets[end]]
        joined, starts, ends, first = normalised(part, offsets[begin : end + 1] - offsets[begin])
        crcs = running_crcs(joined)
        words = np.diff(first)
        text = np.repeat(np.arange(end - begin), words)
        found = []
        for n in range(1, longest + 1):
            last = len(starts) - n + 1
            if last <= 0:
                break
            inside = text[:last] == text[n - 1 :]
            a, b = starts[:last][inside], ends[n - 1 :][inside]
            found.append((text[:last][inside], crcs[b] ^ shifted(crcs[a], b - a)))
        yield words, found
        begin = end


def bucket_counts(texts: DataFrame, longest: int, buckets: int, least_words: int) -> tuple[list[int], int]:
    """Features in each bucket, and the number of texts with enough words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, eligible = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for words, found in _ngrams(batch.column(0), longest):
                eligible += int((words >= least_words).sum())
                for _, crcs in found:
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch(
            [pa.array(np.append(used, _ELIGIBLE), pa.int64()), pa.array(np.append(total[used], eligible), pa.int64())],
            ["bucket", "n"],
        )

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # At most one row for each bucket.
    found = {row["bucket"]: row["n"] for row in rows.collect()}
    return [found.get(k, 0) for k in range(buckets)], found.get(_ELIGIBLE, 0)


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of a bucket's share in the target and in the corpus, smoothed by one."""
    n, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(corpus, target)
    ]


def weights(docs: DataFrame, gain: list[int], longest: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    of_bucket = np.array(gain, np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = [], [], []
            for n_words, found in _ngrams(batch.column(1), longest):
                n = np.zeros(len(n_words), np.int64)
                total = np.zeros(len(n_words), np.int64)
                for text, crcs in found:
                    n += np.bincount(text, minlength=len(n_words))
                    # Texts come in order; sums of whole numbers are differences of running sums.
                    sums = np.append(0, np.cumsum(of_bucket[crcs % np.uint32(len(of_bucket))]))
                    to = np.searchsorted(text, np.arange(len(n_words) + 1))
                    total += np.diff(sums[to])
                words.append(n_words)
                features.append(n)
                weight.append(total)
            if words:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (words, features, weight)]
                yield pa.record_batch([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        weigh, f"doc_id {kind}, n_words long, n_features long, weight long"
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 2,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null for texts that are not drawn.

    Features are the runs of 1 to ``longest`` words.  ``percent`` of the texts with ``least_words`` words are drawn.
    """
    s, eligible = bucket_counts(docs, longest, buckets, least_words)
    t, _ = bucket_counts(target, longest, buckets, least_words)
    drawn = percent * eligible // 100
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    scored = written(
        weights(docs, gains(s, t), longest).select(
            "doc_id", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"),
            (F.col("n_words") >= least_words).alias("eligible"),
        ),
        "scored",
    )
    # The row number splits rows that repeat an id and a score over tasks.
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = written(
        scored.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "placed",
    )
    # The place is the number of the task and that of the row in it.
    task = F.shiftright("place", 33)
    sizes = placed.groupBy(task.alias("task")).count().collect()  # one row for each task
    behind, before = {}, 0
    for row in sorted(sizes):
        behind[row["task"]] = before
        before += row["count"]
    starts = placed.sparkSession.createDataFrame(list(behind.items()), "task long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        placed.withColumn("task", task)
        .join(F.broadcast(starts), "task", "left")
        .select(
            "doc_id", "n_features", "weight", "score",
            F.when(F.col("eligible") & (rank <= drawn), rank).cast("long").alias("rank"),
        )
    )
