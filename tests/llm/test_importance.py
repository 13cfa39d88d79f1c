"""Importance resampling against a plain version that builds every n-gram."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from facilitymetrics.llm.importance import resampled, running_crcs, shifted

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute(docs, target, longest, percent):
    own = [(i, *features(t, longest)) for i, t in docs]
    s = Counter(b for _, _, f in own for b in f)
    t = Counter(b for text in target for b in features(text, longest)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
    rows = []
    for i, words, f in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = len(able) * percent // 100
    rank = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return Counter((*r[:4], rank.get(id(r))) for r in rows)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(200)] + ["É1", "ß", "日本", "x" * 700]
    out = [None, "", " -_. ", "one", "Ab-aB ab", "z" * 70_000 + " end", "a_b" * 40]
    out += [" ".join(rng.choices(words, k=rng.randrange(5, 60))) for _ in range(150)]
    return out + [" ".join(rng.choices(words, k=60_000))]


@pytest.mark.parametrize("longest,percent", [(1, 10), (3, 35)])
def test_resampled(spark, texts, longest, percent):
    docs = list(enumerate(texts)) + [(12, texts[12])] * 3 + [(None, texts[13]), (None, None)]
    target = texts[20:30] + [None, ""]
    frame = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, score int, rank string").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampled(frame, wanted, longest=longest, percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in out.collect()) == brute(docs, target, longest, percent)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resampled(empty, empty).count() == 0
    one = spark.createDataFrame([(1, "word " * 20)], "doc_id long, text string")
    assert [tuple(r) for r in resampled(one, empty, percent=100).collect()] == [
        tuple(next(iter(brute([(1, "word " * 20)], [], 2, 100))))
    ]


@pytest.mark.parametrize("size", [0, 1, 2, 17, 5000, 70_001])
def test_any_substring_from_two_prefixes(size):
    rng = np.random.default_rng(size)
    data = rng.integers(0, 256, size).astype(np.uint8)
    raw, crcs = data.tobytes(), running_crcs(data)
    assert [int(c) for c in crcs[-50:]] == [zlib.crc32(raw[:k]) for k in range(size + 1)][-50:]
    a = rng.integers(0, size + 1, 300)
    b = np.minimum(size, a + rng.integers(0, size + 1, 300))
    expected = [zlib.crc32(raw[i:j]) for i, j in zip(a, b)]
    assert [int(c) for c in crcs[b] ^ shifted(crcs[a], b - a)] == expected
