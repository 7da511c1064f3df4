"""SentencePiece encoding and decoding by a table of distinct chunks.

A model whose pieces never hold a whitespace marker after another character cannot merge across
the start of a marked word. Each distinct marked word is therefore segmented once, and the ids
of a text are those of its words in order. The table of a task grows as its rows bring new words
and starts afresh at ``table_words`` entries, which bounds memory and changes no id.

Empty and null texts encode to the end id alone and decode to an empty text. The result is
that of the library on the whole text, for texts of any length.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, column, map_batches, narrow, small, texts_of

MARK = "▁"

#: The vocabulary file of the registered queries, at the same place on every machine.
MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")
_CHUNK = re.compile(" +[^ ]*")


def chunks_of(text: str) -> list[str]:
    """Marked words of a text, each without the first blank of its marker, which the library
    puts in front of whatever it encodes."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [chunk[1:] for chunk in _CHUNK.findall(" " + text)]
    return text.split(" ")


def check_model(model: sentencepiece.SentencePieceProcessor) -> None:
    """Refuse a model for which words cannot be segmented one by one."""
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {i} crosses a whitespace marker: {piece!r}")
    if model.encode("a  b ", out_type=str) != [f"{MARK}a", MARK, f"{MARK}b", MARK]:
        raise ValueError("the model does not keep blanks as they are")


class _Encode:
    def __init__(self, model_file: str, table_words: int):
        self.model_file, self.table_words = model_file, table_words

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=self.model_file)
        check_model(model)
        end = array("i", [model.eos_id()]).tobytes()
        lone = {"": array("i", [model.piece_to_id(MARK)]).tobytes()}
        table = dict(lone)
        for batch in small(batches):
            words = [chunks_of(text) for text in texts_of(batch)]
            new = list({word for line in words for word in line if word not in table})
            for word, ids in zip(new, model.encode(new, num_threads=1)):
                table[word] = array("i", ids).tobytes()
            lines = [b"".join([table[word] for word in line]) + end for line in words]
            offsets = np.concatenate([[0], np.cumsum([len(line) // 4 for line in lines])])
            values = pa.Array.from_buffers(
                pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(lines))]
            )
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.record_batch([column(batch, "doc_id"), ids], ["doc_id", "ids"])
            if len(table) > self.table_words:
                table = dict(lone)


def _with_texts(model: sentencepiece.SentencePieceProcessor, batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = column(batch, "ids")
    texts = [
        model.decode(ids[i].values.to_numpy().tolist()) if ids[i].is_valid else ""
        for i in range(batch.num_rows)
    ]
    arrays = [column(batch, name) for name in batch.schema.names]
    return pa.record_batch([*arrays, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


class _Decode:
    def __init__(self, model_file: str):
        self.model_file = model_file

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=self.model_file)
        for batch in batches:
            yield _with_texts(model, batch)


class _RoundTrip(_Encode):
    """Both ways in one worker: one model, and ids that do not leave it in between."""

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=self.model_file)
        for batch in super().__call__(batches):
            yield _with_texts(model, batch)


def encode(
    docs: DataFrame,
    model_file: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    table_words: int = 1 << 18,
) -> DataFrame:
    """``doc_id`` and ``ids``, ending in the end id; ``model_file`` is a path that every
    executor can open."""
    ids = T.StructField("ids", T.ArrayType(T.IntegerType(), False))
    return map_batches(narrow(docs, doc_id, text), [ids], _Encode(model_file, table_words))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` with the text of its ``ids`` as ``decoded``."""
    fields = [field for field in encoded.schema if field.name != "doc_id"]
    return map_batches(
        encoded, [*fields, T.StructField("decoded", T.StringType())], _Decode(model_file)
    )


def round_trip(
    docs: DataFrame,
    model_file: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    table_words: int = 1 << 17,
) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: what ``decode`` makes of ``encode``, in one pass."""
    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ]
    return map_batches(narrow(docs, doc_id, text), fields, _RoundTrip(model_file, table_words))
