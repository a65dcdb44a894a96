from conftest import SMALL
from odd_rows import ODD, docs_of

import __spark_entry__ as entry
import corpus_pipeline


def test_entry_lists_everything():
    names = set(entry.queries())
    assert {"pipeline", "op1_toxicity", "op2_warc", "op3_url_filter", "op4_suffix_dedup", "op5_decontaminate", "op6_sentencepiece"} <= names
    assert {"op7_fingerprints", "op8_token_counts", "op9_secrets", "op10_order_minhash"} <= names and "op2_warc" in entry.oracle_sql()


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    before = docs.count()
    out = corpus_pipeline.run(spark, SMALL).collect()
    ids = {r.doc_id for r in out}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "sentencepiece"]
    assert 0.5 * before < len(out) == len(ids) < before
    texts = {r.doc_id: r.text for r in docs.collect()}
    changed = [r for r in out if r.text != texts[r.doc_id]]
    assert all("[SECRET]" in r.text for r in changed) and all(r.n_chars == len(r.text) and r.round_trip for r in out)
    assert not any("= \"" + "0" in r.text and "token" in r.text for r in changed)


def test_every_stage_takes_odd_rows(spark):
    docs = docs_of(spark, [*ODD, (10, "token = abcdefghijkl")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert out.count() == (5 if name == "near_dedup" else len(ODD) + 1), name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    coded = corpus_pipeline.encode(spark, docs, SMALL)
    assert coded.columns[: len(docs.columns)] == docs.columns and coded.count() == len(ODD) + 1
