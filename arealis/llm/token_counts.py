"""Token counts: batches of equal bytes go through the tokenizer, lengths come back."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .pieces import safe_pieces
from .ship import map_arrow

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 15


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer of ``path`` as a function: list of texts -> list of lengths."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, batch_bytes: int = BATCH_BYTES,
                 piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path, on every node, of a ``tokenizers`` .json file with
    byte-level pre-tokenization, or of a ``sentencepiece`` .model (its texts are not
    split). Null texts count as empty. Only lengths leave the Python worker; whatever
    the sizes of the texts, the tokenizer sees about ``batch_bytes`` at once.
    """
    split = not tokenizer.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _tokenizer(tokenizer)
        for batch in batches:
            counts = [0] * batch.num_rows
            pieces: list[str] = []
            owners: list[int] = []
            held = 0

            def flush() -> None:
                for owner, n in zip(owners, lengths(pieces)):
                    counts[owner] += n
                pieces.clear()
                owners.clear()

            for row, value in enumerate(batch.column(2)):
                text = value.as_py()
                for piece in safe_pieces(text, piece_chars) if split else (text,):
                    pieces.append(piece)
                    owners.append(row)
                    held += len(piece)
                    if held >= batch_bytes or len(pieces) >= 1000:
                        flush()
                        held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"),
                         F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    return map_arrow(source, run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
