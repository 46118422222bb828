from __future__ import annotations

import pytest

import corpus_pipeline
from grantloom.llm import queries

CONTRACT = {
    "op1": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op2": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "fingerprint", "component_id"],
    "op6": ["query_id", "rank", "vec_id", "score"],
    "op7": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op8": ["page_id", "host", "path", "rule", "verdict"],
    "op9": ["doc_id", "held_out", "lang_pred", "score"],
    "op10": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op11": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op12": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    wanted = CONTRACT[name.split("_")[0]]
    assert df.columns[: len(wanted)] == wanted
    assert df.count() > 0


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
