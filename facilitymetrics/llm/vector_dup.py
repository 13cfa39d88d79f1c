"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

Method
  1. Equal vectors form one class with a weight.  Vectors that are null, zero or not finite are
     linked with nothing.
  2. In each of ``TABLES`` tables a class is rotated ``PARTS`` times (three rounds of random signs
     and a fast Hadamard transform, padded to a power of two); the closest signed axis of each
     rotation gives its bucket.  Multiprobe: it also visits the buckets that the next closest
     axes would give, ``PROBES`` in all, by least loss of closeness.
  3. Two classes are candidates where one's own bucket is among the other's visited ones.  Buckets
     are compared in blocks of bounded size by matrix products in double precision, and a pair
     is counted only in the first of the buckets in which it meets, so nothing is emitted for
     each pair: a block returns link counts by class and a spanning forest of its links.
Buckets are never capped; a large one is divided into more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.llm.components import components
from facilitymetrics.llm.scratch import written

# Three rotations give two million buckets at 64 dimensions, so chance meetings stay few.
TABLES, PARTS, PROBES = 8, 3, 4
BLOCK = 1024
_SEED = 20_061


def _signs(size: int) -> np.ndarray:
    return np.random.default_rng(_SEED).choice([-1.0, 1.0], (TABLES, PARTS, 3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray) -> np.ndarray:
    """Bucket numbers ``(row, table, probe)``; probe 0 is the row's own bucket."""
    size = 1 << max(1, int(x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x
    signs = _signs(size)
    out = np.zeros((len(x), TABLES, PROBES), np.int64)
    rows = np.arange(len(x))[:, None]
    for t in range(TABLES):
        axes, losses = [], []
        for part in range(PARTS):
            y = padded
            for turn in range(3):
                y = hadamard(y * signs[t, part, turn])
            both = np.concatenate([y, -y], axis=1)
            best = np.argpartition(-both, PROBES - 1, axis=1)[:, :PROBES]
            value = both[rows, best]
            order = np.argsort(-value, axis=1, kind="stable")
            best, value = best[rows, order], value[rows, order]
            axes.append(best)
            losses.append(value[:, :1] - value)
        # Combinations of one axis for each part, by total loss; the first is the own bucket.
        codes, loss = axes[0], losses[0]
        for part in range(1, PARTS):
            codes = (codes[:, :, None] * (2 * size) + axes[part][:, None, :]).reshape(len(x), -1)
            loss = (loss[:, :, None] + losses[part][:, None, :]).reshape(len(x), -1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        out[:, t] = codes[rows, order] * TABLES + t
    return out


def _usable(vectors: DataFrame) -> DataFrame:
    """Classes ``(cls, id, weight, v)`` of equal usable vectors, with the smallest id of each."""
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    ) & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows cut anew, so that no ``(bucket, i, j)`` is divided; one group is bounded by two blocks."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        keys = np.stack([held.column(k).to_numpy() for k in range(3)])
        changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
        if len(changes):
            cut = int(changes[-1]) + 1
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _meet_first(p: np.ndarray, q: np.ndarray, bucket: int) -> np.ndarray:
    """Pairs of visited buckets ``(pair, table, probe)`` that meet in none before ``bucket``."""
    own_p, own_q = p[:, :, :1], q[:, :, :1]
    before = ((own_p == q) & (q < bucket)) | ((own_q == p) & (p < bucket))
    return ~before.any(axis=(1, 2))


def _group_links(bucket: int, square: bool, k_is_i: np.ndarray, cls: np.ndarray, own: np.ndarray,
                 weight: np.ndarray, x: np.ndarray, codes: np.ndarray, least: float) -> tuple[np.ndarray, ...] | None:
    """Counts ``(class, links)`` and a spanning forest ``(class, class)`` of a block pair's new links."""
    a = np.flatnonzero(k_is_i)
    b = a if square else np.flatnonzero(~k_is_i)
    if not len(a) or not len(b):
        return None
    near = (x[a] @ x[b].T >= least) & (own[a][:, None] | own[b][None, :])
    if square:
        near = np.triu(near, 1)
    left, right = np.nonzero(near)
    if not len(left):
        return None
    left, right = a[left], b[right]
    # Only where the pair meets first: no smaller bucket has both, one of them as its own.
    first = np.concatenate([
        _meet_first(codes[left[s : s + 16_384]], codes[right[s : s + 16_384]], bucket)
        for s in range(0, len(left), 16_384)
    ])
    left, right = left[first], right[first]
    if not len(left):
        return None
    links = np.zeros(len(cls), np.int64)
    np.add.at(links, left, weight[right])
    np.add.at(links, right, weight[left])
    counted = np.flatnonzero(links)
    label = np.arange(len(cls))
    while True:
        new = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(cls)))
    return cls[counted], links[counted], cls[moved], cls[label[moved]]


def vector_links(classes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``(cls, links)`` counts by weight, and edges ``(u, v)``, of ``classes (cls, weight, v)``."""

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                vectors = part.column(2)
                flat, ends = vectors.flatten().to_numpy(), np.cumsum(vectors.value_lengths().to_numpy())
                widths = np.diff(ends, prepend=0)
                found = np.zeros((len(vectors), TABLES, PROBES), np.int64)
                for width in np.unique(widths):
                    rows = np.flatnonzero(widths == width)
                    x = _unit(flat[(ends[rows] - width)[:, None] + np.arange(width)])
                    # Vectors of different lengths never share a bucket.
                    found[rows] = buckets(x) * 65_536 + width
                codes = list(found.reshape(len(found), -1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(codes, pa.list_(pa.int64()))], names=["cls", "weight", "v", "codes"]
                )

    coded = written(
        classes.select("cls", "weight", "v").mapInArrow(
            visited, "cls long, weight long, v array<double>, codes array<long>"
        ),
        "buckets",
    )
    listed = coded.select("cls", F.posexplode("codes").alias("at", "bucket")).select(
        "bucket", "cls", (F.col("at") % PROBES == 0).alias("own")
    )
    sizes = listed.groupBy("bucket").agg(F.count("*").alias("n"), F.max("own").alias("any")).where("n > 1 and any")
    sizes = sizes.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    marked = listed.join(sizes, "bucket").withColumn("k", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    # Block pairs (i, j) with i <= j; a row of block k takes part in (i, k) and (k, j).
    placed = marked.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "bucket", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j"), "k", "cls", "own"
    )
    rows = placed.join(coded, "cls").select("bucket", "i", "j", "k", "cls", "own", "weight", "v", "codes")
    schema = "kind byte, u long, v long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_group(batches):
            bucket, i, j, k, cls, own, weight = (
                part.column(c).to_numpy(zero_copy_only=False) for c in range(7)
            )
            values = part.column(7).flatten().to_numpy()
            ends = np.cumsum(part.column(7).value_lengths().to_numpy())
            codes = part.column(8).flatten().to_numpy().reshape(-1, TABLES, PROBES)
            new = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begins = np.concatenate([[0], np.flatnonzero(new) + 1, [len(bucket)]])
            counts, edges = [], []
            for s, e in zip(begins[:-1], begins[1:]):
                if e - s < 2:
                    continue
                x = _unit(values[ends[s - 1] if s else 0 : ends[e - 1]].reshape(e - s, -1))
                found = _group_links(
                    bucket[s], i[s] == j[s], k[s:e] == i[s], cls[s:e], own[s:e], weight[s:e], x, codes[s:e], least
                )
                if found is not None:
                    counts.append(found[:2])
                    edges.append(found[2:])
            if counts:
                u, v = (np.concatenate([x[c] for x in (*counts, *edges)]) for c in (0, 1))
                kind = np.zeros(len(u), np.int8)
                kind[sum(len(x[0]) for x in counts) :] = 1
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(u), pa.array(v)], names=["kind", "u", "v"])

    grouped = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = written(grouped.mapInArrow(run, schema), "links")
    counts = found.where("kind = 0").groupBy(F.col("u").alias("cls")).agg(F.sum("v").alias("links"))
    return counts, found.where("kind = 1").select("u", "v")


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    ``n_links`` counts the other rows linked directly: equal vectors, and found pairs with a cosine
    of ``least`` or more in double precision.  ``component_id`` is the smallest id reachable.
    Rows whose vector is null, empty, zero or has null or non-finite components are alone.
    Vectors of different lengths are never linked.  Rows without id, or that repeat one, are
    rows of their own.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    # -0.0 equals 0.0 in a vector.
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    classes = written(_usable(rows).withColumn("cls", F.monotonically_increasing_id()), "vectors")
    counts, edges = vector_links(classes.select("cls", "weight", "v"), least)
    labels = components(edges).withColumnRenamed("node", "cls")
    rooted = classes.select("cls", "id", "weight", "v").join(labels, "cls", "left").join(counts, "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    lowest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    by_vector = rooted.join(lowest, "root").select(
        "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    out = rows.join(by_vector, "v", "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
