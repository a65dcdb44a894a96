import random

import public_tokenizers
from conftest import SMALL
from odd_rows import docs_of
from tokenizers import Tokenizer

from cashtide.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_fuzz_equals_library():
    random.seed(1)
    alphabet = "ab cdest'' '''sreveLL\n\t\r   \u3000\xa0日本éß中12３½٣!?.,<|endoftext|>\x1c\x1f\x85\u200b\U0001f600 ll m d"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(4_000)]
    texts += ["x<|endoftext|>  y", "  <|endoftext|>", "a" * 5_000, " " * 3_000, "I'll we've 'S don't'll ''s", ""]
    assert tc.count_tokens(texts, tc._transducer(PATH)).tolist() == library(texts)


def test_chunks_and_recompilation_change_nothing():
    transducer = tc.Transducer(tc.Vocabulary(PATH), max_transitions=50)
    texts = ["The quick brown fox jumps", "abcdefghijklmnopqrstuvwxyz" * 30, "a b  c\n\nd"] * 3
    assert tc.count_tokens(texts, transducer).tolist() == library(texts)
    assert tc.count_tokens(texts[::-1], transducer).tolist() == library(texts[::-1])


def test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = tc.with_token_counts(docs, "byte_bpe_50k.json").collect()
    assert [r.n_tokens for r in rows] == library([r.text for r in rows])
    assert all(r.n_bytes == len(r.text.encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)
    odd = tc.with_token_counts(docs_of(spark, [(1, None), (2, ""), (None, "a b"), (None, "a b")]), "byte_bpe_50k.json")
    assert sorted(r.n_tokens for r in odd.collect()) == [0, 0, 2, 2]
    assert tc.with_token_counts(docs.limit(0), "byte_bpe_50k.json").count() == 0
