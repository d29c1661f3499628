"""Rule bitmask ledger: every quality rule is evaluated once, its verdict kept as one bit beside the measurements.

``measure`` adds the measurements of a text, ``ledger`` adds ``failed_bits``.  A :class:`Policy` is a versioned
set of rules; applying one, or another, to a ledger reads the bits alone.  ``ablations`` answers "what would be kept
without rule r" for all rules at once: the ledger is first summed to one row per bit pattern (at most two to the power
of the number of rules, whatever the number of documents), and the patterns are then expanded by rule.

Only built-in column functions are used.  A null or empty text has no words: all measurements are 0 and the rule
``few_words`` fails.  Columns of the input are kept; a measurement of the same name replaces an input column.
An empty table gives an empty ledger.  Repeated rows are measured each on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelhouse.llm.batches import set_aside

WORD = "[^\\x20\\x09-\\x0D]"
WORD_GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks")


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true; ``bit`` is its place in the mask and never changes meaning."""

    bit: int
    name: str
    fails: Callable[[], Column]

    @property
    def mask(self) -> int:
        return 1 << self.bit


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules that a document must not fail."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule]) -> int:
        known = {rule.name: rule.mask for rule in rules}
        missing = [name for name in self.rules if name not in known]
        if missing:
            raise ValueError(f"policy {self.name} v{self.version} names unknown rules {missing}")
        return sum({known[name] for name in self.rules})


def _col(name: str) -> Column:
    return F.col(name)


RULES = (
    Rule(0, "few_words", lambda: _col("n_words") < 50),
    Rule(1, "repeated_windows", lambda: 100 * _col("n_repeat_words") > 50 * _col("n_words")),
    Rule(2, "many_symbols", lambda: 10 * _col("n_symbols") > _col("n_words")),
    Rule(3, "repeated_lines", lambda: 100 * _col("n_dup_lines") > 60 * _col("n_lines")),
    Rule(4, "many_marks", lambda: 10 * _col("n_marks") > 3 * _col("n_words")),
    Rule(5, "short_words", lambda: _col("word_chars") < 2 * _col("n_words")),
    Rule(6, "long_words", lambda: _col("word_chars") > 30 * _col("n_words")),
)

BASE = Policy("base", 1, ("few_words", "repeated_windows"))
DEFAULT = Policy("default", 1, tuple(rule.name for rule in RULES))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words that stand in a three-word window found at least twice, all occurrences counted.

    Windows are compared by 64-bit hashes.  Where all are different the answer is 0; else they are sorted with their
    places, so that equal ones are neighbours, and the places of those with an equal neighbour cover the words.
    """
    hashes = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )

    def repeated(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda s, k: (s["hash"] == F.get(ordered, k - 1)["hash"]) | (s["hash"] == F.get(ordered, k + 1)["hash"]),
        )

    def covered(found: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(found, lambda s: F.array(s["place"], s["place"] + 1, s["place"] + 2)))))

    def count(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
        return F.when(F.size(found) == F.size(F.array_distinct(found)), 0).otherwise(
            _let(placed, lambda ordered: covered(repeated(ordered)))
        )

    return _let(hashes, count).cast("long")


def _word_counts(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("words"),
        F.length(F.array_join(words, "")).cast("long").alias("chars"),
        _repeat_words(words).alias("repeats"),
    )


def _line_counts(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("all"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"),
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns :data:`MEASURES` (all long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))
    counted = docs.withColumns(
        {
            "_words": _let(F.array_remove(F.split(body, WORD_GAP), ""), _word_counts),
            "_lines": _let(lines, _line_counts),
            "_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "_marks": F.regexp_count(body, F.lit("[!?]")).cast("long"),
        }
    )
    return counted.withColumns(
        {
            "n_words": F.col("_words.words"),
            "word_chars": F.col("_words.chars"),
            "n_symbols": F.col("_symbols"),
            "n_dup_lines": F.col("_lines.dup"),
            "n_repeat_words": F.col("_words.repeats"),
            "n_lines": F.col("_lines.all"),
            "n_marks": F.col("_marks"),
        }
    ).drop("_words", "_lines", "_symbols", "_marks")


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with measurements and ``failed_bits``: bit ``b`` is set where the rule with that bit fails."""
    if len({rule.bit for rule in rules}) != len(rules) or any(not 0 <= rule.bit < 63 for rule in rules):
        raise ValueError("every rule needs a bit of its own from 0 to 62")
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(rule.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text).withColumn("failed_bits", bits)


def passes(policy: Policy, rules: Sequence[Rule] = RULES, bits: str = "failed_bits") -> Column:
    """True where a ledger row fails no rule of the policy."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablations(rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES, bits: str = "failed_bits") -> DataFrame:
    """One row per rule of the policy: rows that fail it, that fail it alone, and that are kept without it."""
    mask = policy.mask(rules)
    patterns = rows.groupBy(F.col(bits).bitwiseAND(F.lit(mask).cast("long")).alias("pattern")).agg(F.count("*").alias("rows"))
    chosen = [rule for rule in rules if rule.name in policy.rules]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit")) for r in chosen]))
    return (
        patterns.select("pattern", "rows", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum("rows").alias("n_rows"),
            F.sum(F.when(F.col("pattern").bitwiseAND(F.col("r.bit")) != 0, F.col("rows")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(F.col("pattern") == F.col("r.bit"), F.col("rows")).otherwise(0)).alias("n_only_this"),
            F.sum(F.when(F.col("pattern").isin(0) | (F.col("pattern") == F.col("r.bit")), F.col("rows")).otherwise(0)).alias("n_kept_without"),
        )
    )


def quality_verdicts(docs: DataFrame, policy: Policy = DEFAULT, text: str = "text") -> DataFrame:
    """Documents with their ledger, ``base_failed`` and ``kept``."""
    rows = ledger(docs, RULES, text)
    base = passes(BASE)
    return rows.withColumns({"base_failed": ~base, "kept": base & passes(policy)})


def kept_documents(docs: DataFrame, policy: Policy = DEFAULT, text: str = "text") -> DataFrame:
    """The documents that the policy and the base rules keep, columns as they came."""
    own, restore = set_aside(docs, [*MEASURES, "failed_bits", "base_failed", "kept"])
    return restore(quality_verdicts(own, policy, text).where("kept"))
