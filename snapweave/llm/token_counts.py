"""Token counts from flat token files: a separator scan.

Texts are tokenised into flat files of token numbers, an end-of-document number
after each document, with no index.  Counting reads the files in blocks.  Each
block is searched for separators with one vectorised comparison; it reports its
separators' places as one row.  A prefix scan over a file's blocks (last
separator so far, separators so far) then stitches documents that cross blocks.

Defined results: a null or empty text is a document of no tokens; repeated rows
are documents of their own; a file that does not end in a separator has a last
document of the remaining tokens; an empty table gives an empty result; other
columns do not matter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, staged
from .files import committed, new_folder, open_folder, partition_number


@dataclass(frozen=True)
class TokenParams:
    vocabulary: str = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
    # Fixed value: the split pattern of this family of byte-level vocabularies.
    pattern: str = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    end: int = 50256
    block_tokens: int = 1 << 20

    @property
    def dtype(self) -> str:
        return "<u2" if self.end < 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str) -> tiktoken.Encoding:
    fs, path = open_folder(vocabulary)
    with fs.open_input_stream(path, compression=None) as source:
        lines = source.read().splitlines()
    ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(None, lines))}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _writer(folder: str, p: TokenParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        encode = encoder(p.vocabulary, p.pattern).encode_ordinary
        name, number = f"part-{partition_number():06d}.tokens", 0
        with committed(folder, name) as out:
            while first is not None:
                for text in first.column(1):
                    tokens = encode(text.as_py() or "")
                    tokens.append(p.end)
                    out.write(np.array(tokens, p.dtype).tobytes())
                n = first.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(number, number + n), pa.int64()), first.column(0)],
                    names=["file", "ordinal", "doc_id"])
                number += n
                first = next(batches, None)
    return run


def write_tokens(docs: DataFrame, params: TokenParams = TokenParams(), doc_id: str = "doc_id",
                 text: str = "text", folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, table of ``file, ordinal, doc_id``): the documents in file order."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    narrow = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return folder, staged(narrow.mapInArrow(_writer(folder, params), f"file string, ordinal long, doc_id {kind}"), "token-rows")


def _scanner(folder: str, p: TokenParams):
    size = np.dtype(p.dtype).itemsize
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("ends", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{path}/{file}") as source:
                    source.seek(start * size)
                    block = np.frombuffer(source.read(p.block_tokens * size), p.dtype)
                ends = np.flatnonzero(block == p.end) + start
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start]), pa.array([start + len(block)]),
                                                  pa.array([ends], schema.field("ends").type)], schema=schema)
    return run


def scan_tokens(spark: SparkSession, folder: str, params: TokenParams = TokenParams(),
                files: DataFrame | None = None) -> DataFrame:
    """``file, ordinal, n_tokens`` of every document in the folder's token files.

    ``files`` (``file, tokens``) may come from a listing of one's own; by default Spark lists the folder.
    """
    size = np.dtype(params.dtype).itemsize
    if files is None:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
                 .select(F.element_at(F.split("path", "/"), -1).alias("file"), (F.col("length") / size).cast("long").alias("tokens")))
    starts = files.where("tokens > 0").select("file", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(params.block_tokens).cast("long"))).alias("start"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = staged(starts.repartition(n, "file", "start").mapInArrow(
        _scanner(folder, params), "file string, start long, stop long, ends array<long>"), "token-blocks")
    # the prefix scan: what the blocks before this one say about its first document
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file")
    carried = blocks.select(
        "file", "stop", "ends",
        F.coalesce(F.max(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).over(before), F.lit(-1).cast("long")).alias("last_end"),
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0).cast("long")).alias("done"),
        F.max("stop").over(last).alias("length"))
    tail = F.when((F.col("stop") == F.col("length")) & (F.coalesce(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1),
                                                                   F.col("last_end")) < F.col("length") - 1),
                  F.array(F.col("length"))).otherwise(F.array().cast("array<long>"))
    whole = carried.withColumn("ends", F.concat("ends", tail))
    docs = whole.select("file", "done", F.posexplode(F.transform("ends", lambda e, i: (
        e - F.when(i == 0, F.col("last_end")).otherwise(F.get("ends", i - 1)) - 1))).alias("k", "n_tokens"))
    return docs.select("file", (F.col("done") + F.col("k")).alias("ordinal"), "n_tokens")


def token_counts(docs: DataFrame, params: TokenParams = TokenParams(), doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens``, counted from token files."""
    folder, rows = write_tokens(docs, params, doc_id, text)
    counted = scan_tokens(docs.sparkSession, folder, params)
    return rows.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
