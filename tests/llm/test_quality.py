"""Quality rules against a plain version, and the ledger's policies and ablations."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facilitymetrics.llm import quality
from facilitymetrics.llm.quality import BASE, POLICIES, PRODUCTION, RULES, STRICT, ablations, judged, ledger

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    at = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if at[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    capital = lambda w: sum(c.isupper() for c in w) > 1 and not any(c.islower() for c in w)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_letterless": sum(not any(c.isalpha() for c in w) for w in words),
        "n_capitals": sum(map(capital, words)),
        "n_bullets": sum(bool(re.match("[\x20\x09-\x0d]*[-*•●▪]", x)) for x in lines),
        "n_ellipses": sum(bool(re.search("(\\.\\.\\.|…)[\x20\x09-\x0d]*$", x)) for x in lines),
    }


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    say = lambda n, size=500: " ".join(f"wort{rng.randrange(size)}" for _ in range(n))
    seven = "a b c d e f g"
    out = [None, "", " \t\r\n\v\f", "one", say(19), say(20), say(400), seven, f"{seven} {seven}", f"{seven} h {seven} h",
           "x " * 300, "x " * 8, "x " * 9, "| " * 50, "# a\n" * 40, "- a list item of words\n" * 3 + say(30),
           "NOTHING BUT CAPITALS!! " * 10 + say(10), "12 34 5 " * 30, say(30) + "...\n" + say(10) + "…", "ünder größe 日本 " * 9,
           "a b c d " * 9, "l" * 500, " ".join("l" * 40 for _ in range(25)), "line one\n\n \nline one\nline two"]
    block = say(12)
    out += [f"{block} {say(5)} {block} {say(3)} {block}", say(20_000, 10**6) + " " + block + " " + block]
    out += [say(rng.randrange(8, 40), 3) for _ in range(60)]
    return out


@pytest.fixture(scope="module")
def rows(spark, texts):
    frame = spark.createDataFrame([(k, t, -1, "x") for k, t in enumerate(texts)] + [(None, "one", 0, None)] * 2,
                                  "doc_id long, text string, n_words int, words string")
    return ledger(frame.repartition(3))


def test_measurements(rows, texts):
    expected = Counter((k, *measures(t).values()) for k, t in enumerate(texts))
    expected.update([(None, *measures("one").values())] * 2)
    assert Counter(tuple(r) for r in rows.select("doc_id", *quality.MEASURES).collect()) == expected


def fails(m):
    w, n = m["n_words"], m["n_lines"]
    return {
        "few_words": w < 20, "repeated_words": 100 * m["n_repeat_words"] > 30 * w, "symbols": 10 * m["n_symbols"] > w,
        "repeated_lines": 2 * m["n_dup_lines"] > n, "letterless_words": 5 * m["n_letterless"] > w,
        "capitals": 2 * m["n_capitals"] > w, "short_words": m["word_chars"] < 3 * w, "long_words": m["word_chars"] > 12 * w,
        "bullets": 10 * m["n_bullets"] > 9 * n, "ellipses": 10 * m["n_ellipses"] > 3 * n, "many_words": w > 100_000,
    }


def test_bits_policies_and_ablations(rows, texts):
    own = [fails(measures(t)) for t in [*texts, "one", "one"]]
    bits = [sum(1 << r.bit for r in RULES if f[r.name]) for f in own]
    assert Counter(r["failed_bits"] for r in rows.collect()) == Counter(bits)
    for policy in POLICIES:
        kept = Counter(r["kept"] for r in judged(rows, policy).collect())
        assert kept == Counter(not any(f[name] for name in policy.rules) for f in own)
    found = {(r["policy"], r["rule"]): r for r in ablations(rows).collect()}
    assert set(found) == {(p.name, name) for p in POLICIES for name in p.rules}
    for policy in POLICIES:
        for name in policy.rules:
            row = found[policy.name, name]
            rejected = [[n for n in policy.rules if f[n]] for f in own]
            assert row["n_failed"] == sum(f[name] for f in own)
            assert row["n_alone"] == sum(r == [name] for r in rejected)
            assert row["n_rejected"] == sum(bool(r) for r in rejected) and row["n_texts"] == len(own)


def test_bits_are_stable():
    assert [r.bit for r in RULES] == list(range(len(RULES))) and len({r.name for r in RULES}) == len(RULES)
    assert BASE.mask == 3 and BASE.mask & PRODUCTION.mask == BASE.mask and PRODUCTION.mask & STRICT.mask == PRODUCTION.mask


def test_nothing_and_no_python(spark, rows):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ledger(empty).count() == 0 and ablations(ledger(empty)).count() == 0
    plan = judged(rows, PRODUCTION)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert plan.count("Exchange") == 1  # of the fixture


def test_a_policy_needs_no_text(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/ledger")
    stored = judged(spark.read.parquet(f"{tmp_path}/ledger"), STRICT)
    assert stored.where(F.col("kept")).count() == judged(rows, STRICT).where(F.col("kept")).count()
