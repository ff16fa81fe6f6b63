"""Ids above 2^53 beside a null id in one batch come back as they were."""
import public_tokenizers
import pytest

from tabloom.llm.lbl import score_texts
from tabloom.llm.multiset_hash import fingerprints
from tabloom.llm.packing import pack_documents
from tabloom.llm.piece_dropout import encode_documents

OPERATORS = {
    "op3": lambda docs: encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")),
    "op4": fingerprints,
    "op9": lambda docs: pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")),
    "op10": lambda docs: score_texts(docs, least=1),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_are_kept(spark, name):
    rows = [((1 << 53) + 1, "one two\nthree"), (None, "no id"), (3, "two three"), (-(1 << 62) - 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = OPERATORS[name](docs)
    assert dict(out.dtypes)["doc_id"] == "bigint"
    assert {r.doc_id for r in out.select("doc_id").collect()} == {r[0] for r in rows}
