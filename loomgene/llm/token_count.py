"""Token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string that is one pre-token is encoded alone with
the library; those that come back as one id are proven to be whole tokens. In tasks, each
text of whatever script is split into pre-tokens; one found among them counts as one at once;
only the rest is merged, and each distinct rest is merged once and remembered (at most
REMEMBERED of them, then the memory is emptied). A special token's string counts as one, as
the library's default has it, and is cut out first.

Null text: empty, no bytes, no tokens. Empty table: no rows. Every row is counted by itself, whatever its doc_id;
further columns, whatever their names, are not read. A long text of any script is walked in the
parts of tokens.parts, so one of 100 MB costs little more than itself.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomgene.llm import blocks, store, tokens

REMEMBERED = 400_000


def whole_tokens(bpe: tokens.Bpe, split: tokens.Splitter | None = None) -> frozenset[str]:
    """Vocabulary strings that stand alone as one pre-token and encode as exactly one id."""
    if bpe.fast is None:
        return frozenset()
    to_byte, split, out = tokens.byte_chars(), split or tokens.Splitter(bpe.library), []
    for token in bpe.library.get_vocab():
        try:
            s = bytes(to_byte[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if s and s not in bpe.special and split(s) == [s]:
            out.append(s)
    coded = bpe.library.encode_batch(out, add_special_tokens=False)
    return frozenset(s for s, e in zip(out, coded, strict=True) if len(e.ids) == 1)


class _Lengths(dict):
    """Tokens of a pre-token: 1 for whole tokens, else merged at first sight."""

    def __init__(self, whole, encoding):
        super().__init__(dict.fromkeys(whole, 1))
        self.merge, self.room = encoding._encode_single_piece, len(whole) + REMEMBERED

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(piece))
        if len(self) < self.room:
            self[piece] = n
        return n


def _count(batches: Iterator[pa.RecordBatch], spec, whole) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    bpe, (known, pattern) = tokens.Bpe(spec.value), whole.value
    split = tokens.Splitter(bpe.library, pattern) if bpe.fast else None
    lengths = _Lengths(known, bpe.fast) if bpe.fast else None
    for b in blocks.slices(batches):
        n = []
        for value in b.column(1):
            text = value.as_py()
            if not text:
                n.append(0)
            elif bpe.walks:
                n.append(sum(1 if isinstance(part, int) else sum(map(lengths.__getitem__, split(part))) for part in bpe.segments(text)))
            else:
                n.append(len(bpe.library.encode(text, add_special_tokens=False).ids))
        sizes = blocks.offsets_of(b.column(1).fill_null(""))
        if lengths is not None and len(lengths) >= lengths.room:
            lengths = _Lengths(known, bpe.fast)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(sizes), pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row, under the tokenizer file at that path on the driver."""
    spark = docs.sparkSession
    store.import_path(spark)
    text = tokens.read_spec(tokenizer)
    bpe = tokens.Bpe(text)
    split = tokens.Splitter(bpe.library) if bpe.fast else None  # what the library says of the characters is asked once
    spec, whole = spark.sparkContext.broadcast(text), spark.sparkContext.broadcast((whole_tokens(bpe, split), split and split.pattern.pattern))
    return docs.select("doc_id", "text").mapInArrow(lambda it: _count(it, spec, whole), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
