"""BPE encoding and decoding of every document.

One pass over the documents without a shuffle; a task holds one Arrow batch and a bounded
dictionary of words.

Defined cases: a null text is an empty one and has no ids; a special token written in a text
is that token, as in the tokenizers library; repeated rows each get a row; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.bpe import codec

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = [bpe.encode(t) for t in part.column(1).to_pylist()]
                back = [bpe.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(back, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: `encoded` with digests in its place."""
    return encoded(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
