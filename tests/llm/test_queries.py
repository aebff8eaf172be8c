"""Every operator's query on the smallest tables: against SQL where there is a twin, else its columns."""

import pytest

from lakeloom.llm.queries import QUERIES

from ..compare import DATA, differences, duck

SF = f"{DATA}/sf0.001"

COLUMNS = {
    "op4_tag_path_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op6_boosted_pii": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
    "op7_column_suffixes": {
        "doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"
    },
    "op9_forced_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_multi_index": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_sql(spark, name):
    run, sql = QUERIES[name]
    assert differences(run(spark, SF), duck(SF).sql(sql)) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert dict(QUERIES[name][0](spark, SF).dtypes) == COLUMNS[name]


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, max(numbers) + 1))
