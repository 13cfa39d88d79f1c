"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Features of a text are its words (letters, lower case) and their beginnings of 3 to 8 letters, so
that inflected forms meet, each once, twice or four times and more, since a chance word occurs
rarely.  Spark counts features of the training examples by label; those
significantly more frequent among toxic examples form the vocabulary (the bound of a
G-test grows with the number of features tested).  Inverse document frequencies come from all
documents.

Examples with equal vectors are one entry with counts by label.  The index keeps entries in
blocks with the largest weight of each feature in each block; a block is scored only while
the bound that its largest weights give can still reach the nearest entries found, so the
nearest entries are exact.  Votes are weighted by closeness; ``score`` is the weighted share of
toxic examples, drawn towards the share among all examples.  A text without any vocabulary feature
gets the share of toxic examples among the examples without any.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.llm.scratch import written

# The labelled rows (different texts of an id) the index is fitted on at most, chosen by a hash.
EXAMPLES = 20_000
# Vocabulary features kept at most, by significance.
FEATURES = 4_096
NEAREST = 15
PRIOR = 0.5
THRESHOLD = 0.3
BLOCK = 64
# Rows that a worker makes Python objects of at a time, and words it remembers the features of.
ROWS = 256
_CACHED = 100_000
_WORD = re.compile(r"[^\W\d_]+")


# A feature counts anew when it occurs this often in a text.
LEVELS = (1, 2, 4)


def features(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in range(3, 9) if len(word) >= n)]


def levelled(counts: Counter) -> Iterator[str]:
    for feature, n in counts.items():
        for level in LEVELS:
            if n >= level:
                yield f"{level} {feature}"


def text_words(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``ROWS`` at a time, so that a worker's memory does not depend on the batches."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic, copies in zip(*(batch.column(k).to_pylist() for k in range(3))):
            own: Counter = Counter()
            for word, n in text_words(text).items():
                for f in features(word):
                    own[f] += n
            seen[toxic].update(dict.fromkeys(levelled(own), copies))
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()),
            pa.array([seen[1][x] for x in names], pa.int64()),
            pa.array([seen[0][x] for x in names], pa.int64()),
        ], names=["feature", "toxic", "clean"])


def _vocabulary(examples: DataFrame) -> list[str]:
    n = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.sum("copies").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    counts = examples.mapInArrow(_feature_counts, "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where("a + b >= 3")
    counts = written(counts, "features")
    bound = 2 * math.log(max(counts.count(), 2)) + 2
    p = n1 / (n1 + n0)
    a, b = F.col("a"), F.col("b")
    part = lambda x, mean: F.when(x > 0, x * F.log(x / mean)).otherwise(0.0)
    all_ = a + b
    inside = part(a, all_ * p) + part(b, all_ * (1 - p))
    outside = part(n1 - a, (n1 + n0 - all_) * p) + part(n0 - b, (n1 + n0 - all_) * (1 - p))
    chosen = counts.withColumn("g", 2 * (inside + outside)).where(
        (F.col("g") >= bound) & (a / n1 > 5 * b / n0)
    ).orderBy(F.desc("g"), "feature").limit(FEATURES)
    return [r["feature"] for r in chosen.select("feature").collect()]


class Lookup:
    """Vocabulary features of texts, as sorted feature numbers."""

    def __init__(self, vocabulary: list[str]):
        self.levels: dict[str, list[tuple[int, int]]] = {}
        for number, name in enumerate(vocabulary):
            level, _, feature = name.partition(" ")
            self.levels.setdefault(feature, []).append((int(level), number))
        self.known: dict[str, tuple[str, ...]] = {}

    def vector(self, text: str | None) -> tuple[int, ...]:
        if len(self.known) > _CACHED:
            self.known.clear()
        counts: dict[str, int] = {}
        known = self.known
        for word, n in text_words(text).items():
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(f for f in features(word) if f in self.levels)
            for f in own:
                counts[f] = counts.get(f, 0) + n
        return tuple(sorted(k for f, n in counts.items() for level, k in self.levels[f] if n >= level))


class BlockMaxIndex:
    """Nearest entries by cosine; entries are distinct example vectors with counts by label."""

    def __init__(self, entries: dict[tuple, list], idf: np.ndarray):
        """``entries``: feature numbers -> [toxic, clean, an example id]."""
        keys = sorted(entries)
        self.idf = idf
        self.toxic = np.array([entries[k][0] for k in keys], float)
        self.count = np.array([entries[k][0] + entries[k][1] for k in keys], float)
        self.example = [entries[k][2] for k in keys]
        # Postings of each feature: entries in order and their weights, and its blocks with where
        # their postings begin and their largest weight.
        found: dict[int, list[tuple[int, float]]] = {}
        for at, key in enumerate(keys):
            for feature, weight in zip(key, self.unit(key)):
                found.setdefault(feature, []).append((at, weight))
        self.postings = {}
        for feature, own in found.items():
            at = np.array([x[0] for x in own], np.int32)
            weights = np.array([x[1] for x in own])
            blocks, begin = np.unique(at // BLOCK, return_index=True)
            self.postings[feature] = at, weights, blocks, np.append(begin, len(at)), np.maximum.reduceat(weights, begin)

    def unit(self, numbers: tuple[int, ...]) -> np.ndarray:
        """Weights of these features in a vector of length one."""
        own = self.idf[list(numbers)]
        return own / np.linalg.norm(own)

    def nearest(self, query: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines, nearest first: the fewest that hold ``NEAREST`` examples, and ties."""
        lists = [(q, self.postings[f]) for f, q in zip(query, self.unit(query)) if f in self.postings]
        bounds = np.zeros(-(-len(self.count) // BLOCK))
        for q, (_, _, blocks, _, most) in lists:
            bounds[blocks] += q * most
        at, cosines, reach = np.zeros(0, int), np.zeros(0), -1.0
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] < reach - 1e-12 or bounds[block] <= 0:
                break
            here = np.zeros(BLOCK)
            for q, (members, weights, blocks, begin, _) in lists:
                k = np.searchsorted(blocks, block)
                if k < len(blocks) and blocks[k] == block:
                    part = slice(begin[k], begin[k + 1])
                    here[members[part] - block * BLOCK] += q * weights[part]
            rows = np.flatnonzero(here)
            at = np.concatenate([at, rows + block * BLOCK])
            cosines = np.concatenate([cosines, here[rows]])
            order = np.lexsort((at, -cosines))
            at, cosines = at[order], cosines[order]
            held = np.searchsorted(np.cumsum(self.count[at]), NEAREST)
            if held < len(at):
                reach = cosines[held]
                stay = (cosines >= reach - 1e-12) & (cosines > 0)
                at, cosines = at[stay], cosines[stay]
        stay = cosines > 0
        return at[stay], cosines[stay]


def _document_counts(lookup, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, n, total = Lookup(lookup.value), np.zeros(size, np.int64), 0
        for batch in _parts(batches):
            for text in batch.column(0).to_pylist():
                for k in find.vector(text):
                    n[k] += 1
            total += batch.num_rows
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(size + 1)), pa.array(np.append(n, total)),
        ], names=["k", "n"])

    return run


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted`` and ``evidence``.

    Labels are learned from rows whose ``crc32(id as text) mod 4`` is not 2, at most ``EXAMPLES`` of
    them; only their texts and labels enter a score.  Labels that are null, or rows without id, teach
    nothing; an id with several labels counts as toxic if half of them or more are.  A null text is an
    empty one.  Without examples of both labels every score is the share of toxic examples (0 if
    there are none).  ``evidence`` lists the nearest example ids with their cosines.  Columns of
    ``docs`` with the new names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in ("held_out", "score", "predicted", "evidence") if c not in (doc_id, text)])
    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    known = labels.select(F.col(doc_id), F.col(label).alias("toxic")).dropna().where(~held_out)
    known = known.groupBy(doc_id).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64(doc_id), doc_id).limit(EXAMPLES)
    chosen = docs.select(doc_id, text).join(F.broadcast(known), doc_id)
    # Rows that repeat an id and its text are one with their number.
    chosen = chosen.select(F.col(doc_id).alias("id"), F.md5(text).alias("hash"), F.col(text).alias("text"), "toxic")
    chosen = chosen.groupBy("id", "hash", "toxic").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    examples = written(chosen, "examples")
    if examples.count() > EXAMPLES:
        kept = examples.select("id", "hash").orderBy(F.xxhash64("id", "hash"), "id", "hash").limit(EXAMPLES)
        kept = kept.select(F.col("id").alias("kept"), F.col("hash").alias("kept_hash"))
        same = (F.col("id") == F.col("kept")) & F.col("hash").eqNullSafe(F.col("kept_hash"))
        examples = written(examples.join(F.broadcast(kept), same, "left_semi"), "kept_examples")
    examples = examples.select("text", "toxic", "id", "copies")
    vocabulary = _vocabulary(examples.select("text", "toxic", "copies"))
    context = spark.sparkContext
    shared = context.broadcast(vocabulary)

    size = len(vocabulary)
    idf = np.ones(size)
    if size:
        n = docs.select(text).mapInArrow(_document_counts(shared, size), "k long, n long")
        found = {r["k"]: r["n"] for r in n.groupBy("k").agg(F.sum("n").alias("n")).collect()}
        idf = np.array([1 + math.log((1 + found[size]) / (1 + found[k])) for k in range(size)])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(shared.value)
        for batch in _parts(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array([find.vector(x) for x in batch.column(0).to_pylist()], pa.list_(pa.int64())),
                batch.column(1).cast(pa.int64()),
                batch.column(2).cast(pa.string()),
                batch.column(3),
            ], names=["k", "toxic", "id", "copies"])

    # Counts by distinct vector: at most as many rows as examples.
    grouped = examples.mapInArrow(vectors, "k array<long>, toxic long, id string, copies long")
    grouped = grouped.groupBy("k").agg(
        F.sum(F.col("toxic") * F.col("copies")).alias("toxic"), F.sum("copies").alias("all"), F.min("id").alias("id")
    ).collect()
    entries, plain = {}, [0, 0]
    for row in grouped:
        if row["k"]:
            entries[tuple(row["k"])] = [row["toxic"], row["all"] - row["toxic"], row["id"]]
        else:
            plain = [row["toxic"], row["all"]]
    total = sum(r["all"] for r in grouped)
    base = sum(r["toxic"] for r in grouped) / total if total else 0.0
    index = context.broadcast(BlockMaxIndex(entries, idf))
    without = (plain[0] + PRIOR * base) / (plain[1] + PRIOR)

    schema = T.StructType([
        *docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", T.StringType()),
    ])
    at = docs.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, own, cache = Lookup(shared.value), index.value, {}
        for batch in _parts(batches):
            found = []
            for text in batch.column(at).to_pylist():
                query = find.vector(text)
                if query not in cache:
                    if len(cache) > 50_000:
                        cache.clear()
                    cache[query] = vote(own, query, base) if query else (without, None)
                found.append(cache[query])
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.string()),
            ], names=schema.names)

    scored = docs.mapInArrow(score, schema)
    return scored.withColumn("held_out", held_out).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def vote(index: BlockMaxIndex, query: tuple, base: float) -> tuple[float, str | None]:
    at, cosines = index.nearest(query)
    # A count of examples with equal vectors weighs as one neighbourhood of NEAREST at most.
    weight = cosines**2 * np.minimum(index.count[at], NEAREST)
    share = index.toxic[at] / index.count[at] if len(at) else np.zeros(0)
    score = float((np.sum(weight * share) + PRIOR * base) / (np.sum(weight) + PRIOR))
    evidence = ",".join(f"{index.example[k]}:{c:.4f}" for k, c in list(zip(at, cosines))[:3])
    return min(1.0, max(0.0, score)), evidence or None
