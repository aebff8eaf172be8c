import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakeloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def texts():
    rng = np.random.RandomState(5)
    out = [None, "", "  \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 3, "x\ny\nx\n\n\nx", "a\x0b b\x0cc", "é è\u00a0ü #*|", "A" * 300]
    for _ in range(60):
        vocabulary = rng.choice([2, 3, 5, 300])
        words = [f"w{rng.randint(vocabulary)}" for _ in range(rng.randint(0, 120))]
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words))
    out.append(" ".join(f"w{i % 5000}" for i in range(12_000)))
    return out


def test_measurements(spark):
    rows = list(enumerate(texts()))
    frame = quality.ledger(spark.createDataFrame(rows, "doc_id bigint, text string"))
    for r in frame.collect():
        got = r.ledger.asDict()
        bits = got.pop("failed")
        assert got == brute(r.text), r.text
        assert bool(bits & 1) == (got["n_words"] < 20) and bool(bits & 2) == (100 * got["n_repeat_words"] > 30 * got["n_words"])


def test_policies_and_ablation(spark):
    rows = [(i, t) for i, t in enumerate(texts())] * 2
    frame = quality.ledger(spark.createDataFrame(rows, "doc_id bigint, text string"))
    bits = [r.ledger.failed for r in frame.collect()]
    names = list(quality.RULES)
    for policy in quality.POLICIES.values():
        assert frame.filter(quality.passes(policy)).count() == sum(not b & policy.mask for b in bits)
        got = {r.rule: (r.failed, r.failed_alone, r.kept_without) for r in quality.ablation(frame, policy).collect()}
        for rule in policy.rules:
            bit = 1 << names.index(rule)
            rest = policy.mask & ~bit
            expected = (sum(bool(b & bit) for b in bits), sum(b & policy.mask == bit for b in bits), sum(not b & rest for b in bits))
            assert got[rule] == expected


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.ledger(empty).collect() == []
    assert {tuple(r)[2:] for r in quality.ablation(quality.ledger(empty)).collect()} == {(0, 0, 0)}
    frame = spark.createDataFrame([(1, "a b", 7, 8)], "doc_id bigint, text string, n_words int, ledger int")
    row = quality.ledger(frame, out="mark").first()
    assert (row.n_words, row.ledger, row.mark.n_words) == (7, 8, 2)


def test_native(spark):
    frame = quality.ledger(spark.createDataFrame([(1, "a")], "doc_id bigint, text string")).select(F.col("ledger.failed"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
