"""Quality rules as a bitmask ledger (operator 10).

``ledger`` evaluates every rule once per document and stores the measurements
and one failure bit per rule. Policies are named, versioned bit masks: applying
another policy, or asking what a rule costs, reads the ledger and never a text
again. ``ablation`` works on one row per distinct bit pattern (at most
2**len(RULES) rows, whatever the input size).

Defined cases: a null or empty text has no words and fails ``few_words``; texts of
any length are measured whole; a measurement that ties with a limit passes, as the
rules compare strictly; a repeated row is measured like any other; extra columns,
whatever their names, are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import ascii_words, map_texts

_SPACE = " \t\n\x0b\x0c\r"
#: The symbols counted by ``n_symbols``.
SYMBOLS = "#*$%&|<>"
MEASURES = ("doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, "
            "n_exclaims").split(", ")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str   # SQL over the measurements


#: Bit i of ``fail_bits`` is RULES[i]. Append only: stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("exclaims", "10 * n_exclaims > 3 * n_words"),
)
BASE_RULES = ("few_words", "repeated_windows")

#: Versioned policies: the rules that reject under each.
POLICIES = {
    "base.1": BASE_RULES,
    "standard.1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length",
                   "exclaims"),
}


def mask(rules: tuple[str, ...]) -> int:
    bit = {r.name: 1 << i for i, r in enumerate(RULES)}
    return reduce(int.__or__, (bit[n] for n in rules), 0)


def repeated_positions(words: list) -> int:
    """How many words lie in a 3-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered[i:i + 3] = b"\1\1\1"
    return sum(covered)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or ""
    words = ascii_words(text.encode())
    seen, repeated, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            lines += 1
            if line in seen:
                repeated += 1
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, SYMBOLS)),
            repeated, repeated_positions(words), lines, text.count("!"))


def _measures():
    return lambda texts: list(zip(*map(measure, texts))) or [()] * (len(MEASURES) - 1)


def fail_bits() -> Column:
    return reduce(Column.bitwiseOR, (F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(0)
                                     for i, r in enumerate(RULES)))


def ledger(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry``, the measurements and ``fail_bits``, one row per document."""
    columns = ", ".join(f"{m} long" for m in MEASURES[1:])
    return map_texts(docs, ["doc_id", *carry], _measures, columns).withColumn("fail_bits", fail_bits())


def apply_policy(ledger: DataFrame, policy: str) -> DataFrame:
    """Add ``base_failed`` and ``kept`` under a policy of POLICIES."""
    failed = lambda rules: F.col("fail_bits").bitwiseAND(mask(rules)) != 0
    base = failed(BASE_RULES)
    return ledger.withColumn("base_failed", base).withColumn("kept", ~base & ~failed(POLICIES[policy]))


def ablation(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone (and
    would come back without it), and the rules that always fail along with it."""
    used = mask(POLICIES[policy])
    patterns = (ledger.groupBy(F.col("fail_bits").bitwiseAND(used).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    rules = ledger.sparkSession.createDataFrame(
        [(r.name, 1 << i) for i, r in enumerate(RULES) if used >> i & 1], "rule string, bit int")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return (rules.join(F.broadcast(patterns), hit, "left").groupBy("rule", "bit")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"),
                 F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("failed_alone"),
                 F.expr("bit_and(bits)").alias("always_with")))
