"""Near-duplicate documents by bottom-k sketches of their word shingles.

Method
  1. A document is the set of its distinct shingles.  Equal sets form one class, so copies
     cost one row from here on.  The sketch of a class is its ``SKETCH`` smallest shingle
     names, all under one hash function.
  2. Inverted lists: of the values that two sketches retain, two similar sets share at least
     ``least_shared`` with a chance of failure below 1e-7.  So they share ``OVERLAP`` of the first
     ``size - least_shared + OVERLAP`` values, in an order with rare values first.  Only those are
     listed, which keeps passages common to many documents out of the lists, and only pairs with that many lists in
     common go on; they are counted before anything of a document moves.
  3. The smallest values of the union of two sketches are a sample of the union of the sets; the share of them that both
     sets have estimates the similarity and drops unrelated pairs, with the same chance of failure.
  4. The exact Jaccard similarity of the full sets confirms every link.

A list may hold a third of all classes, so members are not paired freely.  In rounds, a class
that precedes (by hash) all classes it shares lists with becomes a pivot.  The listed classes
within distance ``CORE`` of it are its core.  Jaccard distance is a metric, so whatever is
linked to a core member lies within ``CORE`` and the link distance from the pivot: the lists of
the core name it, and its exact distance to the pivot admits it.  What is not linked to the
pivot itself is compared with the core in blocks of bounded size, by matrix products, which
return a spanning forest and not the pairs.  Then the core is done and leaves the lists.  Once
few pairs are left against the length of the lists at the start, they are compared one by one.  No list and
no pair is skipped, and no list is gathered in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.llm import words as W
from facilitymetrics.llm.components import components
from facilitymetrics.llm.scratch import written, written_by

SKETCH = 48
MISSED = 1e-7
# Lists that two classes must have in common.
OVERLAP = 3
# Largest Jaccard distance of a core member from its pivot.
CORE = 0.5
# Rounds after which the pairs left are compared one by one, however many they are.
MOST_ROUNDS = 3
# Pairs left for each entry of the first lists that are compared one by one at once.
FEW_PAIRS = 8
# Classes, and shingles, on either side of a block of comparisons.
BLOCK_ROWS = 512
# Bits of the map of classes whose texts are wanted.
MARK_BITS = 27
BLOCK_SHINGLES = 1 << 20
_COLUMNS = 4096


@lru_cache(None)
def least_shared(size: int, similarity: float) -> int:
    """How many of ``size`` retained values two sets of this similarity share at least."""
    tail = 0.0
    for n in range(size + 1):
        tail += math.comb(size, n) * similarity**n * (1 - similarity) ** (size - n)
        if tail > MISSED:
            return max(1, n)
    return size


def _least_shared(size, similarity: float):
    """The same for a column of sketch sizes."""
    table = [0, *(least_shared(n, similarity) for n in range(1, SKETCH + 1))]
    return F.element_at(F.array(*map(F.lit, table)), size + 1)


def _overlap(size, similarity: float):
    """Listed values that two similar sets have in common; fewer where they share fewer values at all."""
    return F.least(F.lit(OVERLAP), _least_shared(size, similarity))


def _union_estimate_passes(similarity: float):
    """Whether the sample of the union of sketches ``sa`` and ``sb`` may come from sets of this similarity."""
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    both = F.array_intersect(F.array_intersect("sa", "sb"), union)
    return F.size(both) >= _least_shared(F.size(union), similarity)


def _smallest(names: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` of sorted 64-bit names in the order of signed numbers, which is Spark's."""
    turn = int(np.searchsorted(names, np.uint64(1 << 63)))
    return np.concatenate([names[turn : turn + n], names[: max(0, n - (len(names) - turn))]]).view(np.int64)


def _digest(names: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    a = int(np.sum(names, dtype=np.uint64))
    b = int(np.sum(W.mixed(names ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _marks(classes: DataFrame) -> Broadcast:
    """A bit for each class ``cls``, by the first ``MARK_BITS`` bits of its digest: 16 MB, whatever the input."""
    bit = F.conv(F.hex(F.substring("cls", 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit((1 << MARK_BITS) - 1)) + 1
    rows = (
        classes.select(F.bitmap_bucket_number(bit).alias("at"), F.bitmap_bit_position(bit).alias("bit"))
        .groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    each = 1 << 12
    out = np.zeros((1 << MARK_BITS) >> 3, np.uint8)
    for row in rows:
        at = (row["at"] - 1) * each
        out[at : at + each] = np.frombuffer(row["bits"], np.uint8)
    return classes.sparkSession.sparkContext.broadcast(out)


def _marked(marks: np.ndarray, keys: list[bytes | None]) -> np.ndarray:
    """Whether the bit of each key is set; a few keys of other classes share one."""
    bits = np.array([int.from_bytes(k[:4], "big") if k else 0 for k in keys], np.int64) & ((1 << MARK_BITS) - 1)
    return ((marks[bits >> 3] >> (bits & 7)) & 1).astype(bool) & np.array([k is not None for k in keys])


def with_sets(
    docs: DataFrame, text: str, width: int, lower: bool, sketch: int = 0, marks: Broadcast | None = None
) -> DataFrame:
    """``docs`` with ``set_key`` (null for a text without words), ``set_size`` and ``set_sketch``.

    Columns of these names in ``docs`` must have been renamed by the caller.  With ``marks`` only rows whose class may
    be marked.
    """
    at = docs.columns.index(text)
    new = [T.StructField("set_key", T.BinaryType()), T.StructField("set_size", T.LongType())]
    if sketch:
        new.append(T.StructField("set_sketch", T.ArrayType(T.LongType())))
    schema = T.StructType([*docs.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in W.groups(batch.column(at), lower):
                sets = list(W.shingle_sets(words, width))
                part = batch.slice(begin, end - begin)
                keys = [_digest(s) if len(s) else None for s in sets]
                new = [pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
                if sketch:
                    new.append(W.lists([_smallest(s, sketch) for s in sets], pa.int64()))
                found = pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)
                yield found if marks is None else found.filter(pa.array(_marked(marks.value, keys)))

    return docs.mapInArrow(run, schema)


def _measured(pairs: DataFrame, width: int, lower: bool) -> DataFrame:
    """Shared shingles and union of the full sets of ``(a, b, text_a, text_b)``, and ``size``, the shingles of ``a``."""
    schema = "a binary, b binary, size long, shared long, total long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            shared = np.zeros(batch.num_rows, np.int64)
            total = np.zeros(batch.num_rows, np.int64)
            # Sets of one side, a group of bounded size at a time, against the other side's.
            for begin, end, words in W.groups(batch.column(2), lower):
                left = list(W.shingle_sets(words, width))
                row = begin
                for _, _, other in W.groups(batch.column(3).slice(begin, end - begin), lower):
                    for right in W.shingle_sets(other, width):
                        own = left[row - begin]
                        size[row] = len(own)
                        shared[row] = len(np.intersect1d(own, right, assume_unique=True))
                        total[row] = len(own) + len(right) - shared[row]
                        row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.array(shared), pa.array(total)],
                names=["a", "b", "size", "shared", "total"],
            )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each pair of sets shares, by products of bounded 0/1 matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    values = np.unique(np.concatenate(right))
    a = np.concatenate(left)
    at = np.minimum(np.searchsorted(values, a), len(values) - 1)
    hit = values[at] == a
    rows_a = np.repeat(np.arange(len(left)), [len(x) for x in left])[hit]
    columns_a = at[hit]
    # Only values that both sides hold.
    used, columns_a = np.unique(columns_a, return_inverse=True)
    b = np.concatenate(right)
    if not len(used):
        return out
    at = np.minimum(np.searchsorted(values[used], b), len(used) - 1)
    hit = values[used][at] == b
    rows_b = np.repeat(np.arange(len(right)), [len(x) for x in right])[hit]
    columns_b = at[hit]
    for start in range(0, len(used), _COLUMNS):
        m_a = np.zeros((len(left), _COLUMNS), np.float32)
        m_b = np.zeros((len(right), _COLUMNS), np.float32)
        own = (columns_a >= start) & (columns_a < start + _COLUMNS)
        m_a[rows_a[own], columns_a[own] - start] = 1
        own = (columns_b >= start) & (columns_b < start + _COLUMNS)
        m_b[rows_b[own], columns_b[own] - start] = 1
        out += m_a @ m_b.T
    return out


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a 0/1 matrix, a column that each is connected with (or -1)."""
    none = linked.shape[1]
    columns = np.arange(none)
    while True:
        rows = np.where(linked, columns, none).min(axis=1, initial=none)
        least = np.where(linked, rows[:, None], none).min(axis=0, initial=none)
        new = np.minimum(columns, least)
        if (new == columns).all():
            return np.where(rows == none, -1, rows), columns
        columns = new


def _block_links(rest: DataFrame, core: DataFrame, texts: DataFrame, width: int, lower: bool, percent: int) -> DataFrame:
    """Links ``(u, v)`` that connect the ``rest`` of each pivot with its ``core`` as similar pairs do."""
    sides = [x.select("pivot", "cls", "size", F.lit(k).alias("side")) for k, x in enumerate((rest, core))]
    blocks = F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count("*") / BLOCK_ROWS)).cast("int")
    counts = [
        x.groupBy("pivot").agg(blocks.alias(f"blocks_{k}")) for k, x in enumerate(sides)
    ]
    counts = counts[0].join(counts[1], "pivot")
    own = lambda k: F.pmod(F.xxhash64("cls"), F.col(f"blocks_{k}")).cast("int")
    every = lambda k: F.explode(F.expr(f"sequence(0, blocks_{k} - 1)"))
    rows = sides[0].join(counts, "pivot").withColumn("i", own(0)).withColumn("j", every(1)).union(
        sides[1].join(counts, "pivot").withColumn("i", every(0)).withColumn("j", own(1))
    )
    rows = rows.join(texts, "cls").select("pivot", "i", "j", "side", "cls", "text")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets, names = [], []
        for side in (0, 1):
            part = rows[rows["side"] == side]
            names.append(part["cls"].to_numpy())
            found = W.groups(pa.array(part["text"], pa.large_string()), lower)
            sets.append([x for _, _, words in found for x in W.shingle_sets(words, width)])
        if not sets[0] or not sets[1]:
            return pd.DataFrame({"u": [], "v": []}, dtype=object)
        shared = _shared_counts(*sets)
        sizes = [np.array([len(x) for x in own]) for own in sets]
        union = sizes[0][:, None] + sizes[1][None, :] - shared
        above, across = _forest(100 * shared >= percent * union)
        with_link, moved = above >= 0, across != np.arange(len(across))
        return pd.DataFrame({
            "u": np.concatenate([names[0][with_link], names[1][moved]]),
            "v": np.concatenate([names[1][above[with_link]], names[1][across[moved]]]),
        })

    return rows.groupBy("pivot", "i", "j").applyInPandas(run, "u binary, v binary")


def _lists(classes: DataFrame, similarity: float) -> DataFrame:
    """Inverted lists ``(h, cls, size)`` of the values that similar classes must share."""
    values = classes.select("cls", "size", F.size("sketch").alias("total"), F.explode("sketch").alias("h"))
    common = values.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    found = values.join(common, "h").groupBy("cls", "size", "total").agg(
        F.sort_array(F.collect_list(F.struct("df", "h"))).alias("found")
    )
    # The values that no other class has come first in the order; they fill places of the prefix.
    total = F.col("total")
    overlap = _overlap(total, similarity)
    places = total - _least_shared(total, similarity) + overlap - (total - F.size("found"))
    listed = found.withColumns({"places": places.cast("int"), "overlap": overlap})
    listed = listed.where("places >= overlap")
    listed = listed.select("cls", "size", "overlap", F.explode(F.expr("slice(found, 1, places)")).alias("x"))
    return listed.select(F.col("x.h").alias("h"), "cls", "size", "overlap")


def _shared_lists(entries: DataFrame) -> DataFrame:
    """The lists that still have more than one member, with their members ``m`` and the smallest rank of these."""
    entries = entries.select("h", "cls", "size", "overlap")
    several = entries.groupBy("h").agg(F.count("*").alias("m"), F.min(_rank("cls")).alias("first")).where("m > 1")
    return entries.join(several, "h")


def _rank(cls: str):
    """The order in which classes become pivots."""
    return F.xxhash64(cls)


def links(classes: DataFrame, bodies, width: int, lower: bool, percent: int) -> DataFrame | None:
    """Links ``(u, v)`` that connect exactly the classes connected by similar pairs.

    ``classes`` is a written table ``(cls, size, sketch)``; ``bodies`` gives, for a frame of
    ``cls`` values, a text of each.  None if no two classes share a list.
    """
    least = percent / 100
    active = written(_shared_lists(_lists(classes, least)), "lists")
    sketches, texts, edges = None, None, None

    def compared(pairs: DataFrame, similarity: float) -> DataFrame:
        """``(a, b, size, similarity, linked)`` for the pairs whose sketches may have this similarity, with the size of ``a``.

        ``a`` comes first and last, so that sketch and text of ``b`` take one exchange.
        """
        both = pairs.join(sketches.withColumnsRenamed({"cls": "a", "sketch": "sa"}), "a").join(
            sketches.withColumnsRenamed({"cls": "b", "sketch": "sb"}), "b"
        )
        both = both.where(_union_estimate_passes(similarity)).select("a", "b")
        both = both.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b").join(
            texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a"
        )
        return _measured(both, width, lower).select(
            "a", "b", "size", (F.col("shared") / F.col("total")).alias("similarity"),
            (100 * F.col("shared") >= percent * F.col("total")).alias("linked"),
        )

    def often(pairs: DataFrame) -> DataFrame:
        """Pairs ``(a, b)`` that share enough lists: a row ``(a, b, o)`` for each shared list, ``o`` of them needed."""
        counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("o").alias("o"))
        return counted.where("n >= o").select("a", "b")

    def add(found: DataFrame) -> None:
        nonlocal edges
        edges = found if edges is None else edges.union(found)

    few = None
    for turn in range(MOST_ROUNDS + 1):
        # Half the members beside each entry, summed, are the pairs.
        mass = active.agg(F.count("*"), F.sum((F.col("m") - 1) / 2)).first()
        if not mass[0]:
            break
        if texts is None:
            few = FEW_PAIRS * mass[0]
            # What is joined in every round: the classes with company alone, and dealt by class once.
            members = written(active.select("cls").distinct(), "members")
            sketches = written_by(classes.select("cls", "sketch").join(members, "cls", "left_semi"), "sketches", "cls")
            texts = written_by(bodies(members), "texts", "cls")
        if mass[1] <= few or turn == MOST_ROUNDS:
            one = active.select("h", "cls", "size", "overlap")
            other = one.select("h", F.col("cls").alias("other"), F.col("size").alias("n"), F.col("overlap").alias("o"))
            sizes = F.least("size", "n") * 100 >= F.greatest("size", "n") * percent
            pairs = one.join(other, "h").where((F.col("cls") < F.col("other")) & sizes)
            pairs = often(pairs.select(F.col("cls").alias("a"), F.col("other").alias("b"), F.least("overlap", "o").alias("o")))
            add(written(compared(pairs, least).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")), "links"))
            break
        pivots = written(
            active.groupBy("cls").agg(
                F.max(_rank("cls") != F.col("first")).alias("later"), F.min("size").alias("size"), F.min("overlap").alias("o")
            ).where("not later").select(F.col("cls").alias("pivot"), _rank("cls").alias("first"), "size", "o"),
            "pivots",
        )
        # A list names one pivot at most, by its rank, so a class has no more rows here than lists.
        pairs = active.join(pivots.select("first", "pivot", "o"), "first").where("cls <> pivot")
        pairs = pairs.select(F.col("cls").alias("a"), F.col("pivot").alias("b"), F.least("overlap", "o").alias("o"))
        near = compared(often(pairs.repartition("a")), 1 - CORE).where(F.col("similarity") >= 1 - CORE)
        core = near.groupBy(F.col("a").alias("cls")).agg(
            F.max(F.struct("similarity", "b", "linked", "size")).alias("x")
        ).select("cls", F.col("x.b").alias("pivot"), F.col("x.linked").alias("linked"), F.col("x.size").alias("size"))
        core = core.join(pivots, F.col("cls") == pivots.pivot, "left_anti").union(
            pivots.select(F.col("pivot").alias("cls"), "pivot", F.lit(True).alias("linked"), "size")
        )
        core = written(core, "core")
        add(core.where("linked and cls <> pivot").select(F.col("cls").alias("u"), F.col("pivot").alias("v")))
        # A class linked to a core member has the lists in common with it, hence with the core.
        reached = active.join(core.select("cls", "pivot"), "cls").groupBy("h", "pivot").agg(F.min("overlap").alias("o"))
        reached = reached.join(active.select("h", "cls", "overlap"), "h")
        reached = reached.select(F.col("cls").alias("a"), F.col("pivot").alias("b"), F.least("overlap", "o").alias("o"))
        # All members of a list have its pivots in common, so no class has many more rows than the others.
        reached = often(reached.repartition("a")).join(core.select(F.col("cls").alias("a"), F.col("pivot").alias("own")), "a", "left")
        reached = reached.where("own is null or own <> b").select("a", "b")
        within = least - CORE
        reached = compared(reached, max(within, 0.0)).where(F.col("similarity") >= within - 1e-9)
        reached = written(reached.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), "linked", "size"), "reached")
        add(reached.where("linked").select(F.col("cls").alias("u"), F.col("pivot").alias("v")))
        rest = reached.unionByName(core).where("not linked").select("cls", "pivot", "size")
        add(written(_block_links(rest, core, texts, width, lower, percent), "links"))
        active = written(_shared_lists(active.join(core.select("cls"), "cls", "left_anti")), "lists")
    return edges


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    lower: bool = True,
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id``, ``kept`` and ``set_key``.

    Rows are linked when their sets of distinct ``width``-word shingles have a Jaccard
    similarity of ``percent`` hundredths or more.  ``component_id`` is the smallest id
    reachable by links and ``kept`` tells whether it is the row's own.  A null or wordless
    text has an empty set and is linked with nothing.  A text of fewer words than ``width``
    has one shingle, its whole word sequence.  Rows without an id take part; they are kept
    only if their component holds no id at all.  Rows that repeat an id are rows of their own.
    Columns of ``docs`` with the names of new columns are replaced.
    """
    new = ["n_shingles", "component_id", "kept", "set_key", "set_size", "set_sketch"]
    docs = docs.drop(*[c for c in new if c in docs.columns and c not in (id_column, text_column)])
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sets = with_sets(slim, "text", width, lower, SKETCH).where("set_key is not null")
    classes = written(
        sets.groupBy(F.col("set_key").alias("cls")).agg(
            F.min("id").alias("id"),
            F.first("set_size").alias("size"),
            F.first("set_sketch").alias("sketch"),
        ),
        "classes",
    )

    def bodies(wanted: DataFrame) -> DataFrame:
        keyed = with_sets(slim.select("text"), "text", width, lower, marks=_marks(wanted)).select(
            F.col("set_key").alias("cls"), "text"
        )
        # Any text of the class serves, since all have the same set.
        return keyed.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text"))

    found = links(classes, bodies, width, lower, percent)
    rooted = classes.select("cls", "id", F.col("cls").alias("root"))
    if found is not None:
        labels = components(found).withColumnRenamed("node", "cls")
        rooted = classes.select("cls", "id").join(labels, "cls", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    by_class = written(
        rooted.join(least, "root").select(F.col("cls").alias("set_key"), "component_id"), "by_class"
    )
    keyed = with_sets(docs, text_column, width, lower).withColumnRenamed("set_size", "n_shingles")
    own = F.col(id_column)
    return (
        keyed.join(by_class, "set_key", "left")
        .withColumn("component_id", F.when(F.col("set_key").isNull(), own).otherwise(F.col("component_id")))
        .withColumn("kept", own.eqNullSafe(F.col("component_id")))
    )
