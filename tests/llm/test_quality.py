from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from wheelhouse.llm import quality


def brute(text: str | None) -> dict[str, int]:
    text = text or ""
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ")
    words = [w for w in words if w]
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines), "n_marks": sum(c in "!?" for c in text),
    }


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x\ny\nx\nx \n\n", "é\x0bü\x0cß\r\n#!?<>", "a b a b a b a b", "\xa0 \x85  ", "ab c a bc ab c",
    "word " * 30000, "l1\nl2\n" * 500,
]


def test_measurements_equal_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices(["a", "b", " ", " ", "\n", "|", "!", "cd", "\t"], k=rng.randint(0, 200))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, n_lines string")
    got = quality.measure(docs).collect()
    assert len(got) == len(texts)
    for row in got:
        assert {name: row[name] for name in quality.MEASURES} == brute(row.text)


def test_ledger_policies_and_ablations(spark):
    texts = ["good words of several kinds " + " ".join(f"w{i}" for i in range(60)), "few", None, "a b c " * 40, " ".join(f"SHOUT{i}!!" for i in range(60)), "few! !"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1, "few")], "doc_id long, text string")
    rows = quality.quality_verdicts(docs)
    kept = {r.doc_id: (r.base_failed, r.kept) for r in rows.collect()}
    assert kept == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False), 4: (False, False), 5: (True, False)}
    loose = quality.Policy("loose", 2, ("few_words",))
    assert sorted(r.doc_id for r in rows.where(quality.passes(loose)).collect()) == [0, 3, 4]
    found = {r.rule: r for r in quality.ablations(rows, quality.DEFAULT).collect()}
    bits = [r.failed_bits for r in rows.collect()]
    for rule in quality.RULES:
        row = found[rule.name]
        assert row.n_fail == sum(b & rule.mask != 0 for b in bits) and row.n_only_this == sum(b == rule.mask for b in bits)
        assert row.n_kept_without == sum(b & ~rule.mask == 0 for b in bits) and row.n_rows == len(bits)
    assert quality.ledger(docs.limit(0)).count() == 0


def test_main_path_is_native(spark, plan):
    text = plan(quality.quality_verdicts(spark.createDataFrame([(1, "x")], "doc_id long, text string").select(F.col("doc_id"), "text")))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
