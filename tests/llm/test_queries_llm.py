"""Every registered query of the subpackage against its SQL, and the shape of its result."""

import pytest
from oracle import compare, connect

from tamarack.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_sentencepiece": "doc_id n_ids ids decoded_sha256 exact",
    "op3_quality_classifier": "doc_id held_out score predicted",
    "op4_pii_disclosure": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5_mix_sources": "doc_id size source_size target taken",
    "op6_label_propagation": "doc_id size text_crc32 law shard slot grown_shard",
    "op7_block_nearest": "query_id rank vec_id score",
    "op8_minhash_forest": "doc_id n_shingles component_id kept",
    "op9_repeated_phrases": "doc_id n_words n_removed kept_sha256",
    "op10_exact_top_k": "query_id rank vec_id score",
    "op11_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op12_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_gram_join": "doc_id n_shingles component_id",
}


def test_one_query_for_each_operator():
    assert {n: c.split() for n, c in COLUMNS.items()}.keys() == QUERIES.keys()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, root, name):
    df = QUERIES[name](spark, root)
    assert df.columns == COLUMNS[name].split()
    if name in SQL:
        assert compare(df, connect(root), SQL[name]) is None
    elif name == "op2_sentencepiece":
        assert df.filter("NOT exact").count() == 0
        assert df.count() == spark.read.parquet(f"{root}/documents.parquet").count()
    else:
        assert df.count() == spark.read.parquet(f"{root}/documents.parquet").count()
