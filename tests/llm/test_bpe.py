"""Batch merging, the word tokenizer and merge-dropout against the libraries."""
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tabloom.llm.bpe import merge_word_by_agenda
from tabloom.llm.piece_dropout import DropoutEncoder, PieceModel, encode_documents
from tabloom.llm.word_tokenizer import WordTokenizer
from tests.conftest import SF001

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", "  x  y ", "\n\t tab\r\n", " ", "中文字符 mixed ÿ 😀", "x" * 500, "Ab" * 3000,
       "https://example.org/" + "a1b2" * 60 + " end", "<s> [INST] </s> <|endoftext|>",
       "l'été's DON'T we'll 12³ ¼x a_b--c", "İstanbul ΑΣ é a\x1cb\x0b x\x85y ﬁ", "!!! ???\xad ªº µ ß"]


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def model():
    return PieceModel(PIECES)


def test_word_ids_equal_the_library(words):
    for text, ids in zip(ODD, words.ids(ODD)):
        assert np.frombuffer(ids, "<u4").tolist() == words.library.encode(
            text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_word_ids_equal_the_library_on_any_text(words, text):
    assert np.frombuffer(words.ids([text])[0], "<u4").tolist() == words.library.encode(
        text, add_special_tokens=False).ids


def test_word_memory_may_be_emptied(words, monkeypatch):
    import tabloom.llm.word_tokenizer as module

    monkeypatch.setattr(module, "REMEMBERED", 3)
    text = "one two three four five six seven, one two"
    assert words.ids([text, text])[1] == words.ids([text])[0]


def test_rate_zero_is_the_models_own_encoding(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coder = DropoutEncoder(model, rate=0.0)
    for text in ODD:
        assert coder.encode([3], [text])[0].tolist() == sp.encode(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60), st.integers(-5, 2**63 - 1))
def test_dropout_decodes_to_the_text(model, text, doc):
    ids = DropoutEncoder(model, rate=0.3).encode([doc], [text])[0]
    assert model.decode(ids) == text


def test_dropout_batch_equals_the_agenda(model):
    chunks = [" hello", " internationalisation", " tionment", " aaaaaaaaaa", "\n", " 3.14,15"]
    for rate in (0.1, 0.5, 1.0):
        for draw in range(8):
            keys = np.arange(len(chunks), dtype=np.uint64) * np.uint64(977) + np.uint64(draw)
            for chunk, key, got in zip(chunks, keys, model.encode_chunks(chunks, keys, rate)):
                sym = model._symbols(chunk)
                want = np.array(merge_word_by_agenda(sym.tolist(), model.table, int(key), rate), np.int32)
                assert model._spell(want, chunk, sym)[0].tobytes() == got


def test_segmentations_vary_with_place_document_and_seed(model):
    text = " ".join(["internationalisation"] * 64)
    a = DropoutEncoder(model, rate=0.2, draws=4, seed=1).encode([1, 1], [text, text])
    b = DropoutEncoder(model, rate=0.2, draws=4, seed=2).encode([1], [text])[0]
    assert a[0].tolist() == a[1].tolist() != b.tolist()
    plain = DropoutEncoder(model, rate=0.0).encode([1], ["internationalisation"])[0]
    assert len(a[0]) > 64 * len(plain)


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, "some words here", 1), (None, "some words here", 2), (2, None, 3), (3, "", 4),
            (1, "some words here", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = encode_documents(docs, PIECES).collect()
    assert len(got) == 5 and all(r.lossless for r in got)
    assert [len(r.ids) for r in got if r.doc_id in (2, 3)] == [0, 0]
    assert len({tuple(r.ids) for r in got if r.doc_id == 1}) == 1
    assert encode_documents(docs.limit(0), PIECES).count() == 0


def test_query_is_lossless_over_all_documents(spark):
    import hashlib

    from tabloom.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op3_piece_dropout"](spark, SF001).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in docs.items()}
    assert all(r.lossless for r in got)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert all(sp.decode([int(x) for x in r.ids]) == docs[r.doc_id] for r in got[:50])


def test_every_occurrence_and_copy_has_its_own_skips(model):
    word = "internationalisation"
    coder = DropoutEncoder(model, rate=0.2)
    texts = [" ".join([word] * 4)] * 300
    got = coder.encode(list(range(300)), texts)
    assert len({x.tobytes() for x in got}) > 250  # four at most while draws were shared
    one = coder.encode(list(range(500)), [word] * 500)
    assert len({x.tobytes() for x in one}) > 20


def test_remembered_encodings_equal_merging_anew(model):
    from tabloom.llm.piece_dropout import CHUNK, chunk_draws, chunk_key
    from tabloom.llm.bpe import mix64

    texts = [" some plain words, and internationalisation. " * 5, *ODD]
    docs = [7 * i for i in range(len(texts))]
    coder = DropoutEncoder(model, rate=0.1, seed=3)
    coder.encode(docs[:1], texts[:1])
    for doc, text, got in zip(docs, texts, coder.encode(docs, texts)):
        chunks = CHUNK.findall(" " + text) if text else []
        own = np.fromiter((chunk_key(c, 3) for c in chunks), np.uint64, len(chunks))
        keys = mix64(own + chunk_draws([doc], [len(chunks)], 3, coder.draws))
        assert b"".join(model.encode_chunks(chunks, keys, 0.1)) == got.tobytes()


def test_common_skips_are_not_merged_again(model, monkeypatch):
    import tabloom.llm.piece_dropout as module

    merged, merge_words = [], module.merge_words
    monkeypatch.setattr(module, "merge_words", lambda sym, n, *a: merged.append(len(n)) or merge_words(sym, n, *a))
    words = " ".join(["plain", "words", "and", "internationalisation"] * 10_000)
    coder = DropoutEncoder(model, rate=0.1)
    got = coder.encode([1], [words])[0]
    assert sum(merged) < 40_000 / 10
    monkeypatch.undo()
    chunks = module.CHUNK.findall(" " + words)
    keys = module.mix64(module.chunk_keys(chunks, coder.seed)
                        + module.chunk_draws([1], [len(chunks)], coder.seed, coder.draws))
    assert b"".join(model.encode_chunks(chunks, keys, 0.1)) == got.tobytes()


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(" abetin.\né中😀"), max_size=90), st.floats(0.05, 0.9))
def test_remembered_skips_equal_merging_anew_on_any_text(model, text, rate):
    import tabloom.llm.piece_dropout as module

    coder = DropoutEncoder(model, rate=rate)
    texts, docs = [text] * 40, list(range(40))
    for _ in range(2):
        for doc, got in zip(docs, coder.encode(docs, texts)):
            chunks = module.CHUNK.findall(" " + text) if text else []
            keys = module.mix64(module.chunk_keys(chunks, coder.seed)
                                + module.chunk_draws([doc], [len(chunks)], coder.seed, coder.draws))
            assert b"".join(model.encode_chunks(chunks, keys, rate)) == got.tobytes()
