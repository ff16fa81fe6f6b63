"""corpus_pipeline: every stage against a plain version of itself, and run()."""
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tabloom.llm.simhash import simhash_text
from tabloom.llm.toxicity import score_toxicity
from tests.conftest import SF001
from tests.llm.test_chunk_dedup import brute as cut_texts
from tests.llm.test_packing import brute_pieces, check_whole
from tests.llm.test_simhash import brute_components


def written(df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return df.sparkSession.read.parquet(str(tmp_path / name))


def test_stages_in_order_with_their_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]


def test_stages_and_run_equal_plain_versions(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    frames, df = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        df = written(stage(spark, df, SF001), tmp_path, name)
        frames.append(df)
    for f in frames[:-1]:
        assert f.columns == docs.columns and [t for _, t in f.dtypes] == [t for _, t in docs.dtypes]
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]

    toxic = {r.doc_id for r in score_toxicity(docs, labels).where("is_toxic").collect()}
    assert rows[1] == {i: r for i, r in rows[0].items() if i not in toxic}

    prints = {i: simhash_text(r.text) for i, r in rows[1].items()}
    comp = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert rows[2] == {i: r for i, r in rows[1].items() if comp[i] == i}

    kept = cut_texts([(i, r.text) for i, r in rows[2].items()])
    assert {i: r.text for i, r in rows[3].items()} == {i: t for (i, _), t in kept.items()}
    assert all(r.n_chars == len(r.text) and r.lang == rows[0][i].lang for i, r in rows[3].items())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = frames[-1].collect()
    want = sorted(p for i, r in rows[3].items() for p in brute_pieces(library, i, r.text))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    assert check_whole(packed) <= -(-sum(p[3] for p in want) // 4096) + 1

    again = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, again.select(frames[-1].columns).collect())) == sorted(map(tuple, packed))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "a b", "en", "s", 3),
                                       (1, "a b", "en", "s", 3), (2, "", "en", "s", 0)]])
def test_stages_on_empty_and_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = written(docs, tmp_path, "docs")
    for name, stage in corpus_pipeline.STAGES:
        df = written(stage(spark, df, SF001), tmp_path, name)
    assert df.count() == 0 if not rows else df.count() > 0
