import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from odd_rows import docs_of

from cashtide.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def message(number, value):
    """A field of a protocol-buffer message."""
    if isinstance(value, int):
        return bytes([number << 3 & 127 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    size, head = len(value), b""
    while size > 127:
        head += bytes([size & 127 | 128])
        size >>= 7
    return bytes([number << 3 | 2]) + head + bytes([size]) + value


def unigram(trim, fallback):
    """A small hand-made unigram model."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    pieces += [("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.5, 1), ("ab", -5.0, 1), ("▁a", -4.2, 1), ("▁ab", -6.5, 1), ("c", -7.0, 1), ("abc", -6.0, 1), ("é", -8.0, 1)]
    content = b"".join(message(1, message(1, t.encode()) + message(2, s) + message(3, k)) for t, s, k in pieces)
    content += message(2, message(3, 1) + message(35, int(fallback)))
    return content + message(3, message(1, b"identity") + message(3, 1) + message(4, int(trim)) + message(5, 1))


@pytest.mark.parametrize("trim", [False, True])
@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_equals_library(trim, fallback):
    content = unigram(trim, fallback)
    original = sentencepiece.SentencePieceProcessor(model_proto=content)
    rebuilt = sp.Model(content).tokenizer()
    random.seed(3)
    for _ in range(2_000):
        text = "".join(random.choice("aabbc  é") for _ in range(random.randint(0, 14)))
        ids = rebuilt.encode(text, add_special_tokens=False).ids
        assert ids == original.encode(text), text
        assert rebuilt.decode(ids) == original.decode(ids)


def test_fuzz_equals_library():
    random.seed(2)
    parts = [*"ab cdest'  \n\t▁▁éß日本中½!?.,\u3000\x00\U0001f600", "The", "<s>", "</s>", "<0x41>", "<unk>", "  ", "     "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(4_000)]
    rebuilt, original = sp.codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = [e.ids for e in rebuilt.encode_batch(texts, add_special_tokens=False)]
    assert ids == original.encode(texts)
    assert rebuilt.decode_batch(ids, skip_special_tokens=False) == original.decode(ids)


def test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    coded = sp.encode(docs, "piece_bpe_32k.model")
    for r in coded.collect():
        assert r.token_ids == original.encode(r.text) and r.n_tokens == len(r.token_ids) and r.round_trip
    back = sp.decode(coded.withColumnRenamed("text", "was"), "piece_bpe_32k.model")
    assert back.where("text <> was").count() == 0 and back.count() == docs.count()


def test_odd_rows(spark):
    coded = sp.encode(docs_of(spark, [(1, None), (2, ""), (None, "a"), (None, "a")]), "piece_bpe_32k.model")
    rows = {(r.doc_id, r.text): r for r in coded.collect()}
    assert rows[1, None].token_ids is None and rows[2, ""].token_ids == [] and coded.count() == 4
    assert sp.decode(coded, "piece_bpe_32k.model").where("doc_id = 1").first().text is None
    assert sp.encode(docs_of(spark, []), "piece_bpe_32k.model").count() == 0
    bad = spark.createDataFrame([([99_999],)], "token_ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        sp.decode(bad, "piece_bpe_32k.model").collect()
