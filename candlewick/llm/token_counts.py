"""Token counts of flat token files by a separator scan.

A token file is nothing but ids one after the other, two or four bytes each, with an
end-of-document id after every document; no index says where documents begin. The files are
read in blocks by byte range. A vectorised search finds the separators of each block,
which leaves one summary row: how many separators, and the places of the first and the last
one. A prefix scan over the summaries (sums of the numbers, maxima of the places) numbers the
documents and measures those that cross blocks. The scan has two levels, blocks in stretches and stretches in a
file, so no task holds more than a stretch of rows, however large a file is.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.bpe import Encoder, Vocabulary
from candlewick.llm.texts import column, id_and_text, list_array, pieces, strings
from candlewick.sources import folders
from candlewick.workspace import new_folder, written

BLOCK_BYTES = 4 << 20
STRETCH = 4096
"""Blocks that one step of the prefix scan goes over."""


# Schemes of Spark's file systems that pyarrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    scheme, _, rest = path.partition("://")
    if not rest:
        return pyarrow.fs.FileSystem.from_uri(f"file://{path.removeprefix('file:')}")
    return pyarrow.fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


def write_token_files(docs: DataFrame, vocabulary: Vocabulary, separator: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode documents into one flat file per task below ``folder``, a shared one; ``file``, ``document`` (place in the file), ``doc_id``.

    Files hold 16-bit ids, little end first, and nothing else. A file is named after its
    partition and the attempt that wrote it; what an attempt that failed has left is not listed. A null or empty text is
    a separator alone.
    """
    if vocabulary.size > 1 << 16:
        raise ValueError("ids don't fit 16 bits")
    _opened(folder)  # a file system that pyarrow doesn't know is an error before any work begins
    folders.make(docs.sparkSession, folder)  # no document, no file, but a folder to list
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"tokens-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        encoder, store, out, count = Encoder(sent.value, literal=True), None, None, 0
        for batch in batches:
            for piece in pieces(batch):
                if out is None:
                    store, base = _opened(folder)
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}")
                ids, counts = encoder(strings(piece))
                out.write(np.insert(ids, np.cumsum(counts), separator).astype("<u2").tobytes())
                places = np.arange(count, count + piece.num_rows)
                count += piece.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * piece.num_rows), pa.array(places), column(piece, "doc_id")], ["file", "document", "doc_id"])
        if out is not None:
            out.close()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "file string, document bigint, doc_id bigint")


def blocks(spark: SparkSession, folder: str, files: DataFrame | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file``, ``block``, ``start``, ``stop``: byte ranges of the token files below ``folder``; with ``files``, of those it lists.

    Sizes come from the file listing; no content is read.
    """
    listed = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"))
    if files is not None:
        listed = listed.join(files.select("file").distinct(), "file", "left_semi")
    n = F.ceil(F.col("size") / block_bytes).cast("bigint")
    ranges = listed.where("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("block"))
    return ranges.select("file", "block", (F.col("block") * block_bytes).alias("start"), F.least(F.col("size"), (F.col("block") + 1) * block_bytes).alias("stop"))


def scan(ranges: DataFrame, folder: str, separator: int, width: int = 2) -> DataFrame:
    """``file``, ``block``, ``n`` (separators), ``first``, ``last`` (their places in the file), ``inner`` (tokens between them), ``stop`` (place where the block ends).

    Places count tokens from the start of the file; a block without a separator has null ones.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    names = ["file", "block", "n", "first", "last", "inner", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as file:
                    ids = np.frombuffer(file.read_at(row["stop"] - row["start"], row["start"]), kind)
                at = np.flatnonzero(ids == separator)
                before, lengths = row["start"] // width, np.diff(at) - 1
                ends = [before + int(at[0]), before + int(at[-1])] if len(at) else [None, None]
                one = [pa.array([x], pa.int64()) for x in (row["block"], len(at), *ends)]
                yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), *one, list_array(lengths, np.array([len(lengths)]), pa.int64()), pa.array([before + len(ids)], pa.int64())], names)

    return ranges.mapInArrow(run, "file string, block bigint, n bigint, first bigint, last bigint, inner array<bigint>, stop bigint")


def stitched(summaries: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``file``, ``document``, ``n_tokens`` of every document of the scanned files.

    Tokens after the last separator of a file are its last document. ``summaries`` is read
    three times, so it should be a stored table.
    """
    rows = summaries.withColumn("stretch", F.floor(F.col("block") / stretch))
    earlier = (Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("stretch").rowsBetween(*earlier)
    within = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(*earlier)
    stretches = rows.groupBy("file", "stretch").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    carried = stretches.select("file", "stretch", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("n_carried"), F.coalesce(F.max("last").over(across), F.lit(-1)).alias("last_carried"))
    near = rows.select("*", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("n_near"), F.max("last").over(within).alias("last_near")).where("n > 0")
    closing = near.join(carried, ["file", "stretch"]).select(
        "file",
        (F.col("n_carried") + F.col("n_near")).alias("before"),
        F.posexplode(F.concat(F.array(F.col("first") - F.coalesce("last_near", "last_carried") - 1), "inner")).alias("place", "n_tokens"),
    )
    open_ends = rows.groupBy("file").agg(F.sum("n").alias("document"), (F.max("stop") - F.coalesce(F.max("last"), F.lit(-1)) - 1).alias("n_tokens"))
    return closing.select("file", (F.col("before") + F.col("place")).alias("document"), "n_tokens").union(open_ends.where("n_tokens > 0"))


def count_tokens(spark: SparkSession, folder: str, separator: int, files: DataFrame | None = None, width: int = 2, block_bytes: int = BLOCK_BYTES, stretch: int = STRETCH) -> DataFrame:
    """``file``, ``document``, ``n_tokens`` for the token files below ``folder``, or those of them that ``files`` lists.

    An empty file has no documents; a separator with nothing before it ends a document of no tokens.
    """
    if block_bytes % width:
        raise ValueError("a block holds whole ids")
    ranges = blocks(spark, folder, files, block_bytes).repartition(F.col("file"), F.col("block"))
    return stitched(written(scan(ranges, folder, separator, width), "token-blocks"), stretch)


def counts_by_document(docs: DataFrame, vocabulary: Vocabulary, separator: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``: write the documents as token files, then count by scanning these.

    The ids come from the list that writing has left, as the files themselves name nobody.
    One row per input row. Text that spells a special token is encoded as ordinary text,
    so it separates nothing.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    listed = written(write_token_files(docs, vocabulary, separator, folder, id_col, text_col), "token-documents")
    counted = count_tokens(spark, folder, separator, listed)
    return listed.join(counted, ["file", "document"]).select("doc_id", "n_tokens")
