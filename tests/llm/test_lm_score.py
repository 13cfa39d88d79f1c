"""Cross-entropy difference against models trained anew without each document."""

import math
import random
import re
from collections import Counter

import pytest

from facilitymetrics.llm import queries
from facilitymetrics.llm.lm_score import scored

WORD = re.compile("[^\x20\x09-\x0d]+")


def losses(tokens, members, doc, size):
    """Loss of a document under a model of all members but itself."""
    others = [tokens[k] for k in members if k != doc]
    pair = Counter(p for t in others for p in zip(t, t[1:]))
    context = Counter(w for t in others for w in t[:-1])
    word = Counter(w for t in others for w in t[1:])
    total, loss = sum(word.values()), 0.0
    for v, w in zip(tokens[doc], tokens[doc][1:]):
        single = (word[w] + 1) / (total + size)
        loss -= math.log((pair[v, w] + 50 * single) / (context[v] + 50))
    return loss / (len(tokens[doc]) - 1)


def brute(texts, aims):
    tokens = [["<s>", *WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] for t in texts]
    size = len({w for t in tokens for w in t[1:]}) + 2
    out = []
    for doc, own in enumerate(tokens):
        if len(own) == 1:
            out.append((0, None, None, None))
            continue
        target, background = (losses(tokens, m, doc, size) for m in (aims, range(len(tokens))))
        out.append((len(own) - 1, target, background, target - background))
    return out


def close(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[0] == b[0]
        for x, y in zip(a[1:], b[1:]):
            assert x == (None if y is None else pytest.approx(y, rel=1e-9, abs=1e-12))


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000, 300])
def test_losses(spark, block_bytes):
    rng = random.Random(12)
    names = [f"V{k}" for k in range(300)]
    texts = [" ".join(rng.choices(names, [1 / (k + 1) for k in range(300)], k=60)) for _ in range(40)]
    texts += [None, "once", "once more v1", "", " \t", "again " * 900 + "v1", texts[0], texts[0]]
    aims = set(range(0, 40, 3)) | {45, 46}
    docs = spark.createDataFrame(
        [(k, t, "x", 1.0) for k, t in enumerate(texts)], "doc_id long, text string, block string, score double"
    ).repartition(3)
    target = spark.createDataFrame([(k,) for k in aims] + [(None,), (0,), (999,)], "doc_id long")
    out = sorted(tuple(r) for r in scored(docs, target, block_bytes=block_bytes).collect())
    close([r[1:] for r in out], brute(texts, aims))


def test_rows_without_or_with_one_id(spark):
    texts = ["a b c", "a b d", "a b c", "b c d e"]
    docs = spark.createDataFrame(list(zip([None, 7, 7, None], texts)), "doc_id long, text string")
    target = spark.createDataFrame([(7,)], "doc_id long")
    out = sorted((tuple(r) for r in scored(docs, target).collect()), key=str)
    expected = sorted(((i, *x) for i, x in zip([None, 7, 7, None], brute(texts, [1, 2]))), key=str)
    assert [r[0] for r in out] == [r[0] for r in expected]
    close([r[1:] for r in out], [r[1:] for r in expected])


def test_scores_tell_the_target_apart(spark):
    rng = random.Random(3)
    good, bad = [f"g{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    texts = [" ".join(rng.choices(good if k % 2 else bad, k=40)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in scored(docs, spark.createDataFrame([(k,) for k in range(1, 41, 2)], "doc_id long")).collect()}
    assert max(out[k] for k in range(41, 60, 2)) < min(out[k] for k in range(0, 60, 2))


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scored(empty, empty.select("doc_id")).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    close([tuple(r)[1:] for r in scored(one, empty.select("doc_id")).collect()], brute(["a b"], []))


def test_texts_are_shuffled_once(spark):
    docs = spark.range(10).selectExpr("id AS doc_id", "string(id) AS text")
    out = scored(docs, spark.range(3).selectExpr("id AS doc_id"))
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_the_query_and_its_target_set(spark):
    """Target set: the documents labelled as good."""
    sf = "/root/testdata/sf0.001"
    out = {r["doc_id"]: r for r in queries.op6_lm_scoring(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    labels = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    assert len(out) == len(docs)
    texts = [r["text"] for r in docs]
    tokens = [["<s>", *WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] for t in texts]
    size = len({w for t in tokens for w in t[1:]}) + 2
    aims = [k for k, r in enumerate(docs) if r["doc_id"] in labels]
    for k in [*range(0, len(docs), 20), aims[0]]:
        if len(tokens[k]) > 1:
            assert out[docs[k]["doc_id"]]["target_loss"] == pytest.approx(losses(tokens, aims, k, size), rel=1e-9)
