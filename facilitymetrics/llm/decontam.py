"""Benchmark items hidden in documents, by size-partitioned MinHash containment search.

The items are a stated query set.  They are partitioned by size (powers of two of their shingle
count).  An item of n shingles is found by its ``n - ceil(threshold * n) + 1`` smallest
shingle names: a document that contains the required part of the item holds at least one of
them, so the search misses nothing.  Each size partition is probed only by documents with
enough shingles for it.  Candidates are verified by the exact part of the item's shingles that
the document's full set holds, in the same task, since the set is at hand there.

Documents are read once for every ``block_shingles`` shingles of the benchmark, whose sets are
broadcast: the size of a block is measured before.  Nothing of the documents is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.llm import words as W
from facilitymetrics.llm.scratch import written

BLOCK_SHINGLES = 1 << 21


class ItemIndex:
    """Searchable sets of some items, by size partition."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], threshold: float):
        """``items``: position, shingle width and sorted set of each."""
        self.threshold = threshold
        self.sets = {at: names for at, _, names in items}
        self.parts = []
        groups: dict[tuple[int, int], list[int]] = {}
        for at, width, names in items:
            groups.setdefault((width, len(names).bit_length()), []).append(at)
        for (width, _), members in sorted(groups.items()):
            sketch = [(name, at) for at in members for name in self.sets[at][: self._searched(at)]]
            names = np.array([x[0] for x in sketch], np.uint64)
            order = np.argsort(names, kind="stable")
            least = min(self.needed(at) for at in members)
            self.parts.append((width, least, names[order], np.array([x[1] for x in sketch])[order]))

    def needed(self, at: int) -> int:
        return math.ceil(self.threshold * len(self.sets[at]) - 1e-9)

    def _searched(self, at: int) -> int:
        return len(self.sets[at]) - self.needed(at) + 1

    def matches(self, names: np.ndarray) -> list[tuple[int, int]]:
        """``(item, shared shingles)`` of a document, given the names of its words."""
        sets: dict[int, np.ndarray] = {}
        found: dict[int, int] = {}
        for width, least, values, items in self.parts:
            if width not in sets:
                sets[width] = np.unique(W.shingle_names(names, width))
            own = sets[width]
            if len(own) < least:
                continue
            low = np.searchsorted(values, own, "left")
            high = np.searchsorted(values, own, "right")
            for k in np.flatnonzero(high > low):
                for at in set(items[low[k] : high[k]].tolist()) - found.keys():
                    wanted = self.sets[at]
                    place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    found[at] = int(np.count_nonzero(own[place] == wanted))
        return sorted((at, n) for at, n in found.items() if n >= self.needed(at))


def _item_sets(items: DataFrame, width: int) -> DataFrame:
    """``(id, width, names)`` of each item; an item of fewer words is one shingle of them all."""
    kind = items.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("width", T.IntegerType()),
                           T.StructField("names", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in W.groups(batch.column(1), lower=True):
                counts = np.diff(words.first)
                sets = [s.view(np.int64) for s in W.shingle_sets(words, width)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin),
                    pa.array(np.minimum(counts, width).astype(np.int32)),
                    W.lists(sets, pa.int64()),
                ], names=["id", "width", "names"])

    return items.mapInArrow(run, schema).where("width > 0")


def _indexes(
    items: DataFrame, item_id: str, item_text: str, width: int, threshold: float, block_shingles: int
) -> Iterator:
    """Broadcast ``(ids, index)`` of each block of items; at least one."""
    context = items.sparkSession.sparkContext
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    sets = written(_item_sets(items, width), "items")
    shingles = sets.agg(F.sum(F.size("names"))).first()[0] or 0
    # Twice as many blocks as needed on average, as hashing fills them unevenly.
    blocks = 1 if shingles <= block_shingles else 2 * math.ceil(shingles / block_shingles)
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("names"), F.lit(blocks)) == block).toArrow()
        widths = rows.column("width").to_pylist()
        names = rows.column("names").combine_chunks() if rows.num_rows else []
        made = [
            (at, widths[at], np.sort(names[at].values.to_numpy().view(np.uint64)))
            for at in range(rows.num_rows)
        ]
        yield context.broadcast((rows.column("id"), ItemIndex(made, threshold)))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(doc_id, item_id, item_shingles, shared_shingles, containment)`` of every leak.

    A row says that the document's set of distinct ``width``-word shingles (letters A-Z in lower
    case) holds at least ``threshold`` of the item's.  An item of fewer words than ``width``
    is one shingle, its word sequence.  Null or wordless texts on either side match nothing.
    Rows that repeat an id, or have none, are searched like others; each gives its own rows.
    """
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc"].dataType),
        T.StructField("item_id", items.schema[item_id].dataType),
        T.StructField("item_shingles", T.LongType()),
        T.StructField("shared_shingles", T.LongType()),
        T.StructField("containment", T.DoubleType()),
    ])
    out = None
    for shared in _indexes(items, item_id, item_text, width, threshold, block_shingles):
        found = docs.mapInArrow(_searcher(shared, schema.names), schema)
        out = found if out is None else out.union(found)
    return out


def _searcher(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, index = shared.value
        for batch in batches:
            rows, items, n, size = [], [], [], []
            for begin, _, words in W.groups(batch.column(1), lower=True):
                every = words.names()
                for k, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    for at, count in index.matches(every[a:b]):
                        rows.append(begin + k)
                        items.append(at)
                        n.append(count)
                        size.append(len(index.sets[at]))
            if rows:
                n, size = np.array(n, np.int64), np.array(size, np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    ids.take(pa.array(items, pa.int64())).combine_chunks(),
                    pa.array(size), pa.array(n), pa.array(n / size),
                ], names=names)

    return run


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, by the rules of ``contained_items``."""
    at = docs.columns.index(text)

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, index = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for begin, _, words in W.groups(batch.column(at), lower=True):
                    every = words.names()
                    for k, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                        keep[begin + k] = not index.matches(every[a:b])
                yield batch.filter(pa.array(keep))

        return run

    for shared in _indexes(items, item_id, item_text, width, threshold, block_shingles):
        docs = docs.mapInArrow(clean(shared), docs.schema)
    return docs
