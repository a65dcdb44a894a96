"""SentencePiece models on the tokenizers library: encoding and decoding of columns.

The model file is read field by field (its protocol-buffer layout is public), and its parts are
rebuilt: the normalizer (compiled character map, removal of extra white space, dummy prefix, the
metaspace marker for spaces), the pieces as a unigram model with their scores or as BPE merges ordered
by the scores of the pieces they make, and byte fallback for what no piece covers.  Control, unknown
and byte pieces are never matched in text, as in the original.

Texts go to the library in batches of bounded size, which it encodes on ``threads`` threads.  Parity
with the sentencepiece library is verified twice: on fixed probe texts whenever a process builds a
model (a mismatch stops the job), and on whole tables in the tests.  ``round_trip`` tells for each row
whether decoding gives the normalised text.

Defined cases: a null text has null tokens, an empty one an empty list; null tokens decode to null,
ids outside the vocabulary stop the job; rows are independent, so repeated rows and null ids are kept;
an empty table gives an empty result; an existing column with the name of a result is replaced.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

MARKER = "▁"
BATCH_CHARS = 1_000_000
THREADS = 2
# Layout of the model file: field numbers and enum values of its public definition.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
PROBES = [
    "", " ", "   ", "a", " a", "a ", "The quick  brown fox.", "\n\n\tx \r\n", "▁ ▁▁a", "<s>a</s><unk><0x41>",
    "café naïve üßçœ", "日本語 的 한국", "\U0001f600\U0001f468‍\U0001f469 ก",
    "aaaaaaaaaaaaaaaaaaaaaaaa     aaaaaaaa", "1234567890 0x1f $%^&*()[]{}", "é ﬁ ½ 　x", "a b c​d",
]


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        if kind not in (1, 2, 5) or at + size > len(message):
            raise ValueError("not a SentencePiece model")
        yield number, message[at : at + size]
        at += size


class Model:
    """The parts of a model file that encoding and decoding need."""

    def __init__(self, content: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback = UNIGRAM, False
        self.char_map, self.dummy_prefix, self.trim, self.escape = b"", True, True, True
        for number, value in fields(content):
            if number == PIECES:
                text, score, kind = "", 0.0, NORMAL
                for part, x in fields(value):
                    if part == 1:
                        text = x.decode()
                    elif part == 2:
                        score = struct.unpack("<f", x)[0]
                    elif part == 3:
                        kind = x
                self.pieces.append((text, score, kind))
            elif number == TRAINER:
                for part, x in fields(value):
                    if part == 3:
                        self.kind = x
                    elif part == 35:
                        self.byte_fallback = bool(x)
                    elif part == 24 and x:
                        raise ValueError("markers behind words are not supported")
            elif number == NORMALIZER:
                for part, x in fields(value):
                    if part == 2:
                        self.char_map = x
                    elif part == 3:
                        self.dummy_prefix = bool(x)
                    elif part == 4:
                        self.trim = bool(x)
                    elif part == 5:
                        self.escape = bool(x)
        if self.kind not in (UNIGRAM, BPE) or not self.escape:
            raise ValueError("only unigram and BPE models that escape white space are supported")
        if any(kind == USER_DEFINED for _, _, kind in self.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.unknown = next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), None)

    def tokenizer(self) -> Tokenizer:
        rebuilt = Tokenizer(self._unigram() if self.kind == UNIGRAM else self._bpe())
        steps = [normalizers.Precompiled(self.char_map)] if self.char_map else []
        if self.trim:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARKER))
        steps.append(normalizers.Replace(" ", MARKER))
        rebuilt.normalizer = normalizers.Sequence(steps)
        back = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            back.append(decoders.Strip(content=" ", left=1, right=0))
        rebuilt.decoder = decoders.Sequence(back)
        return rebuilt

    def _unigram(self) -> models.Unigram:
        worst = min(score for _, score, _ in self.pieces)
        # What text must not match gets a score that no path through the text chooses.
        scores = [(t, s if kind in (NORMAL, UNUSED) else worst - 1e6) for t, s, kind in self.pieces]
        return models.Unigram(scores, unk_id=self.unknown, byte_fallback=self.byte_fallback)

    def _bpe(self) -> models.BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(self.pieces)}
        usable = {text: score for text, score, kind in self.pieces if kind == NORMAL}
        made = []
        for text, score in usable.items():
            splits = [(text[:i], text[i:]) for i in range(1, len(text))]
            made += [(-score, vocabulary[text], a, b) for a, b in splits if a in usable and b in usable]
        merges = [(a, b) for _, _, a, b in sorted(made)]
        name = None if self.unknown is None else self.pieces[self.unknown][0]
        return models.BPE(vocabulary, merges, unk_token=name, fuse_unk=True, byte_fallback=self.byte_fallback)


@lru_cache(maxsize=2)
def codec(path: str, threads: int = THREADS) -> Tokenizer:
    """The rebuilt tokenizer of a model file, checked against the original on the probe texts."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    import sentencepiece

    with open(path, "rb") as file:
        rebuilt = Model(file.read()).tokenizer()
    original = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in PROBES:
        ids = rebuilt.encode(text, add_special_tokens=False).ids
        if ids != original.encode(text) or rebuilt.decode(ids) != original.decode(ids):
            raise ValueError(f"the rebuilt model differs from {os.path.basename(path)} on {text!r}")
    return rebuilt


def _path_in_task(name: str) -> str:
    """Executors find the model by its name in their own installation, or by a full path."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _replaced(schema: T.StructType, *added: T.StructField) -> T.StructType:
    names = {f.name for f in added}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(added))


def encode(docs: DataFrame, model: str, text: str = "text", threads: int = THREADS) -> DataFrame:
    """Adds token_ids, n_tokens and round_trip to every row."""
    schema = _replaced(
        docs.schema,
        T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("round_trip", T.BooleanType()),
    )
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rebuilt = codec(_path_in_task(model), threads)
        normal = rebuilt.normalizer.normalize_str
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                whole = ["" if t is None else t for t in texts]
                ids = [e.ids for e in rebuilt.encode_batch_fast(whole, add_special_tokens=False)]
                back = rebuilt.decode_batch(ids, skip_special_tokens=False)
                none = [t is None for t in texts]
                equal = [t == b or normal(t) == normal(b) for t, b in zip(whole, back)]
                rows = batch.slice(at, len(texts))
                at += len(texts)
                tokens = pa.array([None if n else i for n, i in zip(none, ids)], pa.list_(pa.int32()))
                counts = pa.array([None if n else len(i) for n, i in zip(none, ids)], pa.int32())
                same = pa.array([None if n else e for n, e in zip(none, equal)], pa.bool_())
                columns = [rows.column(rows.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, tokens, counts, same], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """Adds the text of a column of token ids."""
    schema = _replaced(docs.schema, T.StructField(text, T.StringType()))
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rebuilt = codec(_path_in_task(model))
        size = rebuilt.get_vocab_size()
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            if any(i < 0 or i >= size for x in lists if x for i in x):
                raise ValueError("a token id is outside the vocabulary")
            back = rebuilt.decode_batch([x or [] for x in lists], skip_special_tokens=False)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            texts = pa.array([None if x is None else b for x, b in zip(lists, back)], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, texts], names=schema.names)

    return docs.mapInArrow(run, schema)
