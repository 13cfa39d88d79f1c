"""Cross-entropy difference of two bigram models over one vocabulary.

The vocabulary is every word of the documents.  The background model counts all documents and the
target model the documents of the target set; both are the same interpolated bigram model.
The loss difference of a token is its loss under the target model less that under the background
model; a document's score is the mean over its tokens, so low scores resemble the target.  A document is scored by
models trained without it: all its own uses of a word, a context and a bigram are taken off their counts.

Documents are dealt by id into blocks of about ``BLOCK_BYTES``, and the ids of the target set with them.  A block counts
its words, contexts and bigrams and sends each of them once, with its counts, to the part of the model that its name
belongs to, all those for one part as one packed value.  A part adds up what it gets, which gives the corpus counts, and
answers every block in the order of its question.  The block then scores its documents from the answers.  So what is shuffled
is the texts once, the distinct names of each block once, and two numbers for each back; nothing that grows with the
corpus is collected.  Counts are exact up to clashes of names, which have 48 bits beside the part's number: a part has a few
million names, so about one in 1e8 shares its counts with another.

Null and empty texts have no tokens and null losses.  Rows without an id, or that repeat one, are documents of their
own.  Rows of one id are spread over ``SPREAD`` blocks and rows without an id over all of them, by their number.  An empty table
gives an empty one.  Other columns than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from facilitymetrics.llm import words as W

# Bytes of text in a block, on average.
BLOCK_BYTES = 8 << 20
# Blocks that rows with one id are spread over; each id of the target set is sent to as many.
SPREAD = 16
# Strength of the word model within the bigram model, and of the uniform one within the word model.
BIGRAM_PRIOR = 50.0
WORD_PRIOR = 1.0
# The name of the start of a text, and what tells names of words, contexts and bigrams apart.
START = np.uint64(0)
_WORD, _CONTEXT, _STEP = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557), np.uint64(0xD6E8FEB86659FD93)


def _tokens(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of each token, and the names of its word, of the word before it as a context, and of the two."""
    rows, names, ahead = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for begin, _, words in W.groups(texts, lower=True):
        own, count = words.names(), np.diff(words.first)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[words.first[:-1][count > 0]] = START
        rows.append(begin + np.repeat(np.arange(len(count)), count))
        names.append(own)
        ahead.append(before)
    word, before = np.concatenate(names), np.concatenate(ahead)
    keys = [W.mixed(word ^ _WORD), W.mixed(before ^ _CONTEXT), W.mixed(W.mixed(before ^ _CONTEXT) * _STEP + word)]
    return np.concatenate(rows), keys


def _packed(names: np.ndarray) -> bytes:
    """Sorted 48-bit names as their differences, in as few bytes as the largest needs."""
    steps = np.diff(names, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :width] = rows
    return np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in one, two, four or eight bytes each, as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names in the order of part and 48-bit name, how many each part has, and the place of each key."""
    own, place = np.unique(keys, return_inverse=True)
    part, name = (own % np.uint64(parts)).astype(np.int64), own >> np.uint64(16)
    order = np.lexsort((name, part))
    back = np.empty(len(own), np.int64)
    back[order] = np.arange(len(own))
    return name[order], np.bincount(part, minlength=parts), back[place]


def _aims(table: pa.Table, labels: pa.Table) -> np.ndarray:
    """1 for the rows of a block whose id is in the target set."""
    wanted = labels["id"].combine_chunks() if len(labels) else pa.array([], table["id"].type)
    return pc.fill_null(pc.is_in(table["id"], value_set=wanted, skip_nulls=True), False).to_numpy().astype(np.int64)


def _asked(table: pa.Table, labels: pa.Table, parts: int) -> pa.Table:
    """What a block asks each part: names of each kind with the block's own counts."""
    rows, keys = _tokens(table["text"])
    aim = _aims(table, labels)[rows]
    out: dict[int, list[bytes | None]] = {}
    for kind, all_names in enumerate(keys):
        names, sizes, place = _by_part(all_names, parts)
        counts = [np.bincount(place, x, len(names)).astype(np.int64) for x in (None, aim)]
        ends = np.cumsum(sizes)
        for p in np.flatnonzero(sizes):
            at = slice(ends[p] - sizes[p], ends[p])
            found = out.setdefault(int(p), [None] * 9)
            found[3 * kind : 3 * kind + 3] = [_packed(names[at]), *(_small(c[at]) for c in counts)]
    columns = {"block": pa.array([table["block"][0].as_py() if len(table) else 0] * len(out), pa.int64())}
    columns["part"] = pa.array(out, pa.int64())
    for k in range(9):
        columns[f"x{k}"] = pa.array([x[k] for x in out.values()], pa.binary())
    return pa.table(columns)


_QUESTION = "block long, part long, " + ", ".join(f"x{k} binary" for k in range(9))
_ANSWER = "block long, part long, " + ", ".join(f"x{k} binary" for k in range(6))


def _answered(table: pa.Table) -> pa.Table:
    """The corpus counts of all that was asked of a part, for each block in the order of its names."""
    columns = [table["block"], table["part"]]
    for kind in range(3):
        asked = [[x.as_py() for x in table[f"x{3 * kind + k}"]] for k in range(3)]
        some = [k for k, x in enumerate(asked[0]) if x is not None]
        names = [_unpacked(asked[0][k]) for k in some]
        own, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *names]), return_inverse=True)
        ends = np.cumsum([0, *(len(x) for x in names)])
        for side in (1, 2):
            counts = np.concatenate([np.zeros(0, np.int64), *(_large(asked[side][k]) for k in some)])
            sums = np.bincount(place, counts, len(own)).astype(np.int64)[place]
            answer: list[bytes | None] = [None] * len(table)
            for k, a, b in zip(some, ends[:-1], ends[1:]):
                answer[k] = _small(sums[a:b])
            columns.append(pa.array(answer, pa.binary()))
    return pa.table(columns, names=["block", "part", *(f"x{k}" for k in range(6))])


def _counts_of(answers: pa.Table, kind: int, n: int) -> list[np.ndarray]:
    """Corpus counts of a block's names, in their order, in both models."""
    rows = np.argsort(answers["part"].to_numpy(), kind="stable") if len(answers) else []
    out = []
    for side in range(2):
        column = answers[f"x{2 * kind + side}"]
        found = [_large(x) for k in rows if (x := column[int(k)].as_py()) is not None]
        counts = np.concatenate([np.zeros(0, np.int64), *found])
        if len(counts) != n:
            raise ValueError("a block's documents are not those that its counts were asked for")
        out.append(counts.astype(float))
    return out


def _loss_sums(table: pa.Table, further: pa.Table, parts: int, totals: tuple[int, int, int]) -> tuple[np.ndarray, ...]:
    """Tokens and summed losses of both models for each row of a block.

    ``further`` holds the answers, and rows without a part that name ids of the target set.
    """
    rows, keys = _tokens(table["text"])
    labels, answers = further.filter(pc.is_null(further["part"])), further.filter(pc.is_valid(further["part"]))
    aim = _aims(table, labels).astype(float)
    n = np.bincount(rows, minlength=len(table))
    corpus, own = [], []
    for kind, all_names in enumerate(keys):
        names, _, place = _by_part(all_names, parts)
        corpus.append([counts[place] for counts in _counts_of(answers, kind, len(names))])
        # Uses by the document itself.
        _, same, uses = np.unique(rows * len(names) + place, return_inverse=True, return_counts=True)
        own.append(uses[same])
    sums = []
    for side in range(2):
        part = np.ones(len(rows)) if not side else aim[rows]
        word, context, bigram = (corpus[kind][side] - own[kind] * part for kind in range(3))
        size = totals[side] - n[rows] * part
        single = (word + WORD_PRIOR) / (size + WORD_PRIOR * totals[2])
        p = (bigram + BIGRAM_PRIOR * single) / (context + BIGRAM_PRIOR)
        sums.append(np.bincount(rows, -np.log(p), len(table)))
    return n, sums[0], sums[1]


def _totals(rows: DataFrame, chosen: DataFrame) -> tuple[int, int, int, int]:
    """Bytes, tokens, tokens of the target set, and distinct words of all texts."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting = np.zeros(0, np.uint64), []
        for batch in batches:
            sizes = []
            for _, _, part in W.groups(batch.column(1), lower=True):
                sizes.append(np.diff(part.first))
                waiting.append(np.unique(part.names()))
                if sum(map(len, waiting)) > max(1 << 20, len(found)):
                    found, waiting = np.unique(np.concatenate([found, *waiting])), []
            if sizes:
                count = pa.array(np.concatenate(sizes).astype(np.int64))
                size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                none = pa.nulls(batch.num_rows, pa.int64())
                yield pa.record_batch([batch.column(0), none, count, size], ["id", "word", "n", "size"])
        found = np.unique(np.concatenate([found, *waiting])).view(np.int64)
        none = pa.nulls(len(found), pa.int64())
        yield pa.record_batch([none.cast(kind), pa.array(found), none, none], ["id", "word", "n", "size"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, word long, n long, size long"
    kind = to_arrow_type(rows.schema["id"].dataType)
    found = rows.select("id", "text").mapInArrow(words, schema)
    # Numbers of rows with ids of the target set, and distinct words, without any text.
    by_id = found.where("word is null").groupBy("id").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    sums = by_id.join(chosen.withColumn("aim", F.lit(1)), "id", "left").agg(
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("aim")).alias("t")
    )
    types = found.where("word is not null").select("word").distinct().agg(F.count("*").alias("types"))
    size, n, t = sums.first()
    return size or 0, n or 0, t or 0, types.first()[0]


def scored(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, n_tokens, target_loss, background_loss, score)`` of every document.

    ``target`` names the ids of the target set; null ids are none of it.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType
    chosen = target.select(F.col(doc_id).cast(kind).alias("id")).dropna().distinct()
    size, n, n_target, types = _totals(rows, chosen)
    parts = max(1, -(-size // block_bytes))
    # All words, an unseen one and the start of a text.
    totals = n, n_target, types + 2
    number = F.xxhash64(F.monotonically_increasing_id())
    salted = F.when(F.col("id").isNull(), number).otherwise(F.xxhash64("id", F.pmod(number, F.lit(SPREAD))))
    dealt = rows.withColumn("block", F.pmod(salted, F.lit(parts))).repartition("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<bigint>"))
    labels = chosen.withColumn("salt", every).select("id", F.pmod(F.xxhash64("id", "salt"), F.lit(parts)).alias("block"))
    labels = labels.distinct()

    def ask(table: pa.Table, labels: pa.Table) -> pa.Table:
        return _asked(table, labels, parts)

    def score(table: pa.Table, further: pa.Table) -> pa.Table:
        count, *sums = _loss_sums(table, further, parts, totals)
        some = count > 0
        background, wanted = (x / np.maximum(count, 1) for x in sums)
        losses = [pa.array(x, pa.float64(), mask=~some) for x in (wanted, background, wanted - background)]
        return pa.table(
            [table["id"], pa.array(count.astype(np.int64)), *losses],
            names=["id", "n_tokens", "target_loss", "background_loss", "score"],
        )

    blocks = dealt.groupBy("block")
    answers = (
        blocks.cogroup(labels.groupBy("block")).applyInArrow(ask, _QUESTION).groupBy("part").applyInArrow(_answered, _ANSWER)
    )
    further = answers.unionByName(labels, allowMissingColumns=True)
    found = blocks.cogroup(further.groupBy("block")).applyInArrow(
        score, f"id {kind.simpleString()}, n_tokens long, target_loss double, background_loss double, score double"
    )
    return found.withColumnRenamed("id", doc_id)
