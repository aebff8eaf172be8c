"""The pipeline against stage-by-stage checks and a brute-force version of its first two stages."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import mixing, pii
from lakeloom.llm.queries import vocabulary

from ..compare import DATA
from .test_neardup import brute as near
from .test_quality import brute as measured

SF = f"{DATA}/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def passes(text):
    m = measured(text)
    return not (
        m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
        or not 3 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]
        or 2 * m["n_dup_lines"] > m["n_lines"] or 2 * m["n_upper"] > m["word_chars"]
    )


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages(frames):
    rows = {r.doc_id: r for r in frames[0].collect()}
    good = {i for i, r in rows.items() if passes(r.text)}
    assert {r.doc_id for r in frames[1].collect()} == good
    alone = {i for i, (_, _, kept) in near([(i, rows[i].text) for i in good]).items() if kept}
    assert {r.doc_id for r in frames[2].collect()} == alone
    for frame in frames[:5]:
        assert sorted(frame.columns) == sorted(COLUMNS)
    for r in frames[3].collect():
        assert (r.text == rows[r.doc_id].text) or pii.base_spans(rows[r.doc_id].text) or "[SECRET]" in r.text or "[" in r.text
        assert not [s for s in pii.base_spans(r.text)]
        assert r.n_chars == len(r.text)
    assert sorted(map(tuple, frames[4].select(*COLUMNS).collect())) == sorted(map(tuple, frames[3].select(*COLUMNS).collect()))


def test_tokens(frames):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    texts = {r.doc_id: r.text for r in frames[4].collect()}
    for r in frames[5].collect():
        assert r.token_ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids and r.round_trip


def test_result_has_the_mix(frames):
    """Sorted by slot and place, each source is less than a block away from its share."""
    rows = frames[5].select("doc_id", "source", "slot", "place").collect()
    plan = {r.doc_id: r.mix for r in mixing.mix(frames[4], mixing.damped_weights(frames[4], "source")).collect()}
    assert len(rows) == len(plan) and all((r.slot, r.place) == (plan[r.doc_id].slot, plan[r.doc_id].place) for r in rows)
    assert len({(r.slot, r.place) for r in rows}) == len(rows)
    counts = Counter(r.source for r in rows)
    total = sum(n**0.7 for n in counts.values())
    slots = {s: sorted({r.slot for r in rows if r.source == s}) for s in counts}
    assert len(slots) > 1 and max(map(len, slots.values())) > 1
    for t in range(1, min(x[-1] for x in slots.values()) + 1):
        for s, n in counts.items():
            assert abs(sum(x < t for x in slots[s]) - t * n**0.7 / total) < 1.01


def test_run_and_edges(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ledger string, spans int, mix int, ids int"
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "a", 1, "", 1, 1, 1), (1, text, "en", "a", 1, "", 1, 1, 1), (None, text, None, None, None, None, None, None, None)]
    rows += [(2, None, "en", "a", 0, "", 1, 1, 1), (3, "", "en", "a", 0, "", 1, 1, 1), (4, text + " mail me: x@y.org " + "z " * 3, "en", None, 9, "", 1, 1, 1)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1]
    (tmp_path / "none").mkdir()
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).filter(F.lit(True)).collect() == []
