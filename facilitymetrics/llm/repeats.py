"""Removal of long repeated word runs, found by recompression.

Method
  1. Words become symbols.  Rounds replace maximal runs of one symbol by a symbol for (symbol, length) and
     adjacent pairs (l, r) by a symbol for the pair, where a round's hash puts l among the left
     and r among the right symbols.  Names are hashes of what they stand for, so they are
     global without any exchange, and whether a symbol forms depends only on nearby text: the
     ``reach`` of a symbol is the span of words that decides it.  Equal text over the reach
     gives the same symbol everywhere, so repeats agree on their interior symbols.
  2. Spark counts the high-level symbols of all documents.  One that occurs once proves that
     every window containing its reach is unique.  Windows not excluded this way lie in or
     next to regions of shared symbols.
  3. Those windows are verified: their names are counted, and the ones that occur once are
     excluded too.  Words covered by a remaining window are removed.
What flows back to a document are spans proved unique, one row each, never the members of a
repeated window, so a passage shared by a third of all documents stays within counts that are
summed before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facilitymetrics.llm import words as W

# R: runs, P: pairs.  Pairs shorten the symbol sequence by a quarter each.
ROUNDS = "RPPPRPPP"
_FAR = 1 << 40


def symbols(names: np.ndarray, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """High-level symbols of some texts: ``(symbol, text, low, high)``; the reach is words low..high-1.

    ``text`` is the number of the text of each word, ``first`` the first word of each text.  A
    reach that touches an end of its text is extended beyond it, since other text may follow there.
    """
    sym, doc = names.copy(), text.copy()
    low, high = np.arange(len(sym)), np.arange(1, len(sym) + 1)
    for turn, kind in enumerate(ROUNDS):
        if not len(sym):
            break
        same = doc[1:] == doc[:-1]
        salt = np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        # The reach of the neighbours; beyond a text's end it is out of bounds.
        before = np.concatenate([[-_FAR], np.where(same, low[:-1], -_FAR)])
        after = np.concatenate([np.where(same, high[1:], _FAR), [_FAR]])
        if kind == "R":
            begins = np.concatenate([[True], (sym[1:] != sym[:-1]) | ~same])
            at = np.flatnonzero(begins)
            length = np.diff(np.concatenate([at, [len(sym)]]))
            last = at + length - 1
            run = W.mixed(sym[at] + salt * length.astype(np.uint64))
            low, high = np.minimum(low[at], before[at]), np.maximum(high[last], after[last])
            sym, doc = np.where(length > 1, run, sym[at]), doc[at]
            continue
        right = ((W.mixed(sym ^ salt) >> np.uint64(17)) & np.uint64(1)).astype(bool)
        merges = np.concatenate([~right[:-1] & right[1:] & same, [False]])
        merged_left = np.concatenate([[False], merges[:-1]])
        at = np.flatnonzero(~merged_left)
        pair = merges[at]
        nxt = np.minimum(at + 1, len(sym) - 1)
        # A symbol that stays single does so because of the one neighbour it could pair with.
        alone_low = np.where(right[at], np.minimum(low[at], before[at]), low[at])
        alone_high = np.where(right[at], high[at], np.maximum(high[at], after[at]))
        name = W.mixed(sym[at] * np.uint64(0xD6E8FEB86659FD93) + W.mixed(sym[nxt] + salt))
        low, high = np.where(pair, np.minimum(low[at], low[nxt]), alone_low), np.where(
            pair, np.maximum(high[at], high[nxt]), alone_high
        )
        sym, doc = np.where(pair, name, sym[at]), doc[at]
    return sym, doc, low, high


def _proved(column: pa.Array, row: int) -> np.ndarray:
    """Spans ``(a, b)`` of window starts known to be unique, for one document."""
    if not column[row].is_valid:
        return np.zeros((0, 2), np.int64)
    packed = column[row].values.to_numpy()
    return np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1)


def _open_starts(n_windows: int, spans: np.ndarray) -> np.ndarray:
    """Which of the window starts no span covers."""
    steps = np.zeros(n_windows + 1, np.int64)
    np.add.at(steps, np.clip(spans[:, 0], 0, n_windows), 1)
    np.add.at(steps, np.clip(spans[:, 1] + 1, 0, n_windows), -1)
    return np.cumsum(steps)[:-1] == 0


def _grouped(spans: DataFrame) -> DataFrame:
    """One list of packed spans for each document; its length is bounded by the document's."""
    return spans.groupBy("k").agg(F.collect_list("span").alias("spans"))


def _unique(rows: DataFrame) -> DataFrame:
    """Spans of names that occur once; partial counts are summed before the shuffle."""
    return rows.groupBy("name").agg(
        F.count("*").alias("n"), F.min("k").alias("k"), F.min("span").alias("span")
    ).where("n = 1").select("k", "span")


_NAMED = "name long, k long, span long"


def _batch(name: np.ndarray, k, rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(name.view(np.int64)), k.take(pa.array(rows)), pa.array((a.astype(np.int64) << 32) | b)
    ], names=["name", "k", "span"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)`` of every document.

    A window is ``window`` consecutive words of one document.  Words covered by a window whose
    word sequence also begins anywhere else, in any document, are removed; windows are judged
    on the input.  A null or wordless text has no words and an empty kept text.  Rows without
    an id, or that repeat one, are documents of their own: rows equal in id and text repeat
    each other.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Rows that agree in this key have equal texts, so none of their windows is unique anyway.
    docs = docs.withColumn("k", F.xxhash64("doc_id", "text"))

    def high_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, words in W.groups(batch.column(0)):
                count = np.diff(words.first)
                text_of = np.repeat(np.arange(len(words)), count)
                sym, doc, low, high = symbols(words.names(), text_of, words.first)
                start = words.first[doc]
                # Window starts whose window holds the whole reach.
                a, b = np.maximum(high - start - window, 0), np.minimum(low - start, count[doc] - window)
                use = (a <= b) & (low >= start) & (high <= start + count[doc])
                yield _batch(sym[use], batch.column(1), doc[use] + begin, a[use], b[use])

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, words in W.groups(batch.column(0)):
                every = W.shingle_names(words.names(), window)
                names, rows, starts = [], [], []
                for k, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    if b - a < window:
                        continue
                    at = np.flatnonzero(_open_starts(b - a - window + 1, _proved(batch.column(2), begin + k)))
                    names.append(every[a + at])
                    rows.append(np.full(len(at), begin + k))
                    starts.append(at)
                if names:
                    at = np.concatenate(starts)
                    yield _batch(np.concatenate(names), batch.column(1), np.concatenate(rows), at, at)

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    kept_columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in W.groups(batch.column(0)):
                n_words, n_removed, texts = [], [], []
                raw = words.data.tobytes()
                for k, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    stay = np.ones(b - a, bool)
                    if b - a >= window:
                        spans = np.concatenate([_proved(batch.column(c), begin + k) for c in (2, 3)])
                        open_ = _open_starts(b - a - window + 1, spans)
                        steps = np.zeros(b - a + 1, np.int64)
                        steps[: len(open_)] += open_
                        steps[window : window + len(open_)] -= open_
                        stay = np.cumsum(steps)[:-1] == 0
                    at = np.flatnonzero(stay) + a
                    texts.append(b" ".join([raw[s:e] for s, e in zip(words.starts[at], words.ends[at])]))
                    n_words.append(b - a)
                    n_removed.append(b - a - len(at))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(begin, end - begin),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                    pa.array([x.decode() for x in texts]),
                ], names=kept_columns)

    from_symbols = _grouped(_unique(docs.select("text", "k").mapInArrow(high_symbols, _NAMED)))
    # Both uses of this join read the same shuffled texts, so they have the same columns.
    left = docs.join(from_symbols, "k", "left").select("text", "k", "spans", "doc_id")
    from_windows = _grouped(_unique(left.mapInArrow(open_windows, _NAMED))).withColumnRenamed("spans", "more")
    return left.join(from_windows, "k", "left").select("text", "doc_id", "spans", "more").mapInArrow(
        kept, f"doc_id {doc_type}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
