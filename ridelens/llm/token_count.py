"""Token counts by a whole-token shortcut.

Which strings of the vocabulary are one token when encoded alone is proven once
on the driver (``pretokens.prove``). In the tasks a text is cut into
pre-tokens: one that is a proven string counts as one token directly, only the
rest are merged. The result is the tokenizer's own, text for text.

The proof is made for byte-level merges. Any other tokenizer file
(``tokenizers`` ``.json`` or ``sentencepiece`` ``.model``) proves no string, so
all of its texts are the rest, and the library encodes them.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ridelens.llm import words as W
from ridelens.llm.pretokens import Pieces, Proof, read_tokenizer
from ridelens.llm.runtime import documents, ship, table

#: A document with more tokens is over the limit.
LIMIT = 512
#: The tokenizer of the registered query, under ``public_tokenizers``.
DEFAULT_FILE = "byte_bpe_50k.json"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def counter(known: Proof | str | bytes) -> Callable[[str], int]:
    """text -> number of tokens, made inside a task from what ``read_tokenizer`` gave."""
    if isinstance(known, Proof):
        return Pieces(known).count
    if isinstance(known, str):
        from tokenizers import Tokenizer

        encode = Tokenizer.from_str(known).encode
        return lambda text: len(encode(text, add_special_tokens=False))
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_proto=known)
    return lambda text: len(pieces.encode(text, num_threads=1))


def token_counts(df: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """For every row of (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens and
    over_limit (n_tokens > ``limit``), as the library for the file at ``path``
    (read on the driver alone) counts without begin, end or added tokens.

    Defined cases: a null text counts as empty (0, 0, false); an empty text has
    what the library gives it, none; a very long text is counted whole, its
    task holds that text and its pre-tokens; rows that repeat a doc_id, or
    have none, are counted on their own; ``limit`` itself is not over it; an
    empty table gives an empty result; other columns are ignored."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(shared.value)
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = pc.fill_null(part.column("text"), "")
                n = np.fromiter((count(t) for t in texts.to_pylist()), np.int64, part.num_rows)
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents(df, "doc_id", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of every document; cases as in ``token_counts``."""
    return token_counts(table(spark, sf_dir, "documents"), public_path(DEFAULT_FILE))
