"""Names of words and runs of words."""

import random

import pyarrow as pa
import pytest

from facilitymetrics.llm.near_dup import near_duplicates
from facilitymetrics.llm.repeats import without_repeats
from facilitymetrics.llm.words import groups


def names(texts):
    found = {}
    for begin, _, words in groups(pa.array(texts)):
        all_names = words.names()
        for row in range(len(words)):
            own = all_names[words.first[row] : words.first[row + 1]]
            for word, name in zip(words.texts(row), own):
                assert found.setdefault(word, int(name)) == int(name)
    return found


def thue_morse(n):
    return "".join("ab"[k.bit_count() % 2] for k in range(n))


def swapped(word):
    return word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [64, 200, 256, 257, 1024, 4096])
def test_words_with_a_pattern_keep_apart(length):
    word = thue_morse(length)
    assert len(set(names([f"{word} {swapped(word)}"]).values())) == 2


def test_equal_words_have_one_name_wherever_they_stand():
    rng = random.Random(1)
    words = ["".join(rng.choices("abé日", k=n)) for n in [*range(1, 40), 255, 256, 300] for _ in range(30)]
    texts = [" ".join(rng.sample(words, 200)) for _ in range(40)] + ["", None, "x" * 3_000_000, "x" * 3_000_000 + " y"]
    found = names(texts)
    assert len(set(found.values())) == len(found)


def test_short_words_of_one_length_never_clash():
    data = [f"{k:05d}" for k in range(100_000)]
    assert len(set(names([" ".join(data)]).values())) == len(data)


def test_operators_tell_such_words_apart(spark):
    word = thue_morse(1024)
    rest = " ".join(f"w{k}" for k in range(34))
    rows = [(0, f"{rest} {word}"), (1, f"{rest} {swapped(word)}"), (2, word), (3, swapped(word))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_removed"] for r in without_repeats(docs).collect()} == {0}
    linked = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, width=3, percent=100).collect()}
    assert linked == {0: 0, 1: 1, 2: 2, 3: 3}
