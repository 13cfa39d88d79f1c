"""Quality rules as a ledger of failure bits: every rule is evaluated once, policies are bit masks.

``ledger`` measures each text and stores one bit for each rule that it fails.  A policy is a set of
rules; ``judged`` applies it to the stored bits and ``ablations`` counts what each rule of
each policy rejects, alone and with others, from one group-by of the bits.  No text is read again.
All of it is Spark's own functions and nothing but those counts is shuffled.

Words are the maximal runs of characters other than space and 0x09-0x0D.  A null text counts as an empty one,
which has no words and fails ``few_words``.  Rows are judged one by one, so copies and repeated ids give
a row each; an empty table gives an empty one.  Only ``doc_id`` and ``text`` are read, other
columns play no part.  A text is measured in arrays of its own words (about ten times its bytes while it is
being measured), however long it is.

Repeated windows are found by 64-bit names of eight words and then compared word by word, so a
name that two different windows share cannot count a word; names are sorted only for texts that repeat one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
_SPACES = r"[\x20\x09-\x0D]+"
_NO_SPACE = r"[^\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letterless", "n_capitals", "n_bullets", "n_ellipses",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the measurements; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: str


# The first two are the base rules, the limits of the others are those common for web text.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "letterless_words", "100 * n_letterless > 20 * n_words"),
    Rule(5, "capitals", "100 * n_capitals > 50 * n_words"),
    Rule(6, "short_words", "word_chars < 3 * n_words"),
    Rule(7, "long_words", "word_chars > 12 * n_words"),
    Rule(8, "bullets", "100 * n_bullets > 90 * n_lines"),
    Rule(9, "ellipses", "100 * n_ellipses > 30 * n_lines"),
    Rule(10, "many_words", "n_words > 100000"),
)


@dataclass(frozen=True)
class Policy:
    """A text is rejected when it fails any of ``rules``."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {rule.name: rule.bit for rule in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
# A long text is no fault by itself, nor is a list.
PRODUCTION = Policy(
    "production", 1,
    (*BASE.rules, "symbols", "repeated_lines", "letterless_words", "capitals", "short_words", "long_words", "ellipses"),
)
STRICT = Policy("strict", 1, tuple(rule.name for rule in RULES))
POLICIES = (BASE, PRODUCTION, STRICT)


def _count(array: str, condition: str) -> Column:
    return F.expr(f"size(filter({array}, x -> {condition}))").cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every text."""
    names = ", ".join(f"get(names, i + {k})" for k in range(WINDOW))
    same = f"slice(words, x.at + 1, {WINDOW}) = slice(words, by_name[k {{0}}].at + 1, {WINDOW})"
    repeated = " OR ".join(
        f"({bound} AND by_name[k {step}].name = x.name AND {same.format(step)})"
        for bound, step in (("k > 0", "- 1"), ("k < size(by_name) - 1", "+ 1"))
    )
    steps = (
        {
            "words": F.filter(F.split("text", _SPACES), lambda w: w != ""),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(_NO_SPACE)),
        },
        {
            "joined": F.array_join("words", ""),
            "names": F.transform("words", lambda w: F.xxhash64(w)),
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_letterless": _count("words", r"x not rlike r'\p{L}'"),
            "n_capitals": _count("words", r"x rlike r'\p{Lu}.*\p{Lu}' and x not rlike r'\p{Ll}'"),
            "n_bullets": _count("lines", r"x rlike r'^[\x20\x09-\x0D]*[-*\x{2022}\x{25CF}\x{25AA}]'"),
            "n_ellipses": _count("lines", r"x rlike r'(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'"),
        },
        {
            "word_chars": F.length("joined").cast("long"),
            "n_symbols": (F.length("joined") - F.length(F.regexp_replace("joined", _SYMBOLS, ""))).cast("long"),
            "windows": F.expr(
                f"if(n_words < {WINDOW}, array(), "
                f"transform(sequence(0, int(n_words) - {WINDOW}), i -> xxhash64({names})))"
            ),
        },
        {"any_repeat": F.size(F.array_distinct("windows")) < F.size("windows")},
        {
            "words": F.expr("if(any_repeat, words, array())"),
            "by_name": F.expr(
                "if(any_repeat, sort_array(transform(windows, (x, i) -> named_struct('name', x, 'at', i))), array())"
            ),
        },
        {"places": F.expr(f"sort_array(transform(filter(by_name, (x, k) -> {repeated}), x -> x.at))")},
        {
            "n_repeat_words": F.expr(
                "aggregate(places, named_struct('reach', 0, 'n', 0L), (a, i) -> named_struct("
                f"'reach', i + {WINDOW}, 'n', a.n + least({WINDOW}, i + {WINDOW} - a.reach)), a -> a.n)"
            )
        },
    )
    now = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for columns in steps:
        now = now.withColumns(columns)
    # Always true, but Catalyst cannot know: it would otherwise push a later filter on a measurement below all of these
    # steps and put them into one expression, whose lambdas work out whole arrays again for every element.
    fixed = F.monotonically_increasing_id() >= 0
    return now.select("doc_id", *[F.when(fixed, F.col(name)).alias(name) for name in MEASURES])


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements of every text with ``failed_bits``, one bit for each rule it fails."""
    bits = " + ".join(f"if({rule.fails}, {1 << rule.bit}L, 0L)" for rule in rules)
    return measured(docs).withColumn("failed_bits", F.expr(bits))


def judged(rows: DataFrame, policy: Policy) -> DataFrame:
    """``rows`` of a ledger with the bits that ``policy`` rejects them for and ``kept``."""
    bits = F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    return rows.withColumn("rejected_bits", bits).withColumn("kept", F.col("rejected_bits") == 0)


def ablations(rows: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """For each rule of each policy: texts and words that it rejects, and those that it alone rejects.

    ``n_alone`` texts come back when the policy is applied without the rule.  The ledger is first counted by its bits, so
    what is shuffled and compared has a row for each combination of failures and not for each text.
    """
    counted = rows.groupBy("failed_bits").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words")
    )
    bit_of = {rule.name: rule.bit for rule in RULES}
    cases = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
                F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << bit_of[name]).cast("long").alias("bit"),
            )
            for p in policies
            for name in p.rules
        ]
    )
    hit = F.col("failed_bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failed_bits").bitwiseAND(F.col("mask")) == F.col("bit")
    rejected = F.col("failed_bits").bitwiseAND(F.col("mask")) != 0

    def total(condition: Column, value: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("long")

    return (
        counted.select("failed_bits", "n", "words", F.inline(cases))
        .groupBy("policy", "version", "rule")
        .agg(
            total(hit, "n").alias("n_failed"),
            total(alone, "n").alias("n_alone"),
            total(alone, "words").alias("words_alone"),
            total(rejected, "n").alias("n_rejected"),
            F.sum("n").alias("n_texts"),
        )
    )
