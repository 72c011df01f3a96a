"""Token counts per document of flat, unindexed token files by a separator scan.

A token file is one run of fixed-width ids in which an end-of-document id closes
each document; nothing tells where documents begin.  It is read in blocks cut
anywhere.  Each block is searched for the end id in one vector operation and gives
the lengths between its own separators plus a summary: ids before its first separator,
ids after its last, separators.  A prefix scan over the block summaries of a file
(a window over a few numbers per block) carries the open document's length and
the document number across blocks, however many blocks one document spans.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, stored

BLOCK_TOKENS = 1 << 16


def scan_block(ids: np.ndarray, end_id: int) -> tuple[np.ndarray, int, int]:
    """Ends (positions of the end id), ids up to and with the first one (all if
    none), ids after the last one (all if none)."""
    ends = np.flatnonzero(ids == end_id)
    if not len(ends):
        return ends, len(ids), len(ids)
    return ends, int(ends[0]) + 1, len(ids) - int(ends[-1]) - 1


def document_lengths(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """From blocks (file, block: their order, data: little-endian ids of ``width``
    bytes) one row per document: file, doc_no (from 0), n_tokens (without the end id).

    Ids after a file's last end id are a last, unclosed document.  Null or empty data
    are blocks without ids; a file without ids has no documents; blocks of a null
    file form a file of their own; repeated (file, block) rows are ids that occur again.
    An empty table gives no rows.
    """
    dtype = f"<u{width}"

    def scan(batches):
        import pyarrow as pa
        for b in batches:
            rows = []
            for file, block, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(data or b"", dtype)
                ends, head, tail = scan_block(ids, end_id)
                rows.append((file, block, len(ends), head, tail, (np.diff(ends) - 1).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                names=["file", "block", "ends", "head", "tail", "inner"]) if rows else pa.RecordBatch.from_pylist([], schema=pa.schema(
                    [("file", pa.int64()), ("block", pa.int64()), ("ends", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()),
                     ("inner", pa.list_(pa.int64()))]))

    found = stored(blocks.selectExpr("cast(file as long) file", "cast(block as long) block", "data").mapInArrow(
        scan, "file long, block long, ends long, head long, tail long, inner array<long>"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # segments: a block with a separator opens one with its tail, blocks without extend it
    s = found.select("file", "block", "ends", "head", "tail")
    s = (s.withColumn("doc_no", F.coalesce(F.sum("ends").over(before), F.lit(0)))
         .withColumn("segment", F.coalesce(F.sum((F.col("ends") > 0).cast("long")).over(before), F.lit(0))))
    in_segment = Window.partitionBy("file", "segment").orderBy("block")
    opened = F.lag("tail").over(order)  # the block before opened or extended the segment
    s = s.withColumn("added", F.coalesce(opened, F.lit(0)))
    s = s.withColumn("carry", F.sum("added").over(in_segment))
    last = Window.partitionBy("file").orderBy(F.col("block").desc())
    s = s.withColumn("is_last", F.row_number().over(last) == 1)
    closed = s.where("ends > 0").select("file", "doc_no", (F.col("carry") + F.col("head") - 1).alias("n_tokens"))
    inner = (found.join(s.select("file", "block", "doc_no"), ["file", "block"])
             .select("file", "doc_no", F.posexplode("inner").alias("k", "n_tokens"))
             .select("file", (F.col("doc_no") + F.col("k") + 1).alias("doc_no"), "n_tokens"))
    open_end = s.where("is_last").select(
        "file", (F.col("doc_no") + F.col("ends")).alias("doc_no"),
        F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail")).alias("n_tokens")).where("n_tokens > 0")
    return closed.unionByName(inner).unionByName(open_end)


def _open_file(path: str):
    """A file that any machine of the cluster can open (file, hdfs, s3, gs ...), for reading anywhere."""
    from urllib.parse import quote

    from pyarrow import fs
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, at = fs.FileSystem.from_uri(quote(path, safe="/:@%"))
    return store.open_input_file(at)


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS,
                     by_range: bool = True) -> DataFrame:
    """Blocks (file, path, block, data) of raw token files; ``file`` is a hash of the path.

    Files of any size: Spark lists them with their lengths, a row is made for each
    byte range, and the task that gets the row reads that range.  Stores that only Spark
    can open need ``by_range=False``: then a file is one row of Spark's binary source, up to 2 GB."""
    size = block_tokens * width
    listed = spark.read.format("binaryFile").load(path)
    if by_range:
        n = F.ceil(F.col("length") / size).cast("long")
        ranges = listed.select("path", "length").where("length > 0").select(
            "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = ranges.repartition(tasks, "path", F.floor(F.col("block") / 64)).sortWithinPartitions("path", "block")

        def read(batches):
            import pyarrow as pa
            name, f = None, None
            for b in batches:
                for p, length, block in zip(*(b.column(i).to_pylist() for i in range(3))):
                    if p != name:
                        name, f = p, _open_file(p)
                    data = f.read_at(min(size, length - block * size), block * size)
                    yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                                                     names=["path", "block", "data"])

        return ranges.mapInArrow(read, "path string, block long, data binary").withColumn("file", F.xxhash64("path"))

    def cut(batches):
        import pyarrow as pa
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_buffer()
                for i in range(0, -(-len(data) // size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([i], pa.int64()),
                         pa.array([data.slice(i * size, min(size, len(data) - i * size)).to_pybytes()], pa.binary())],
                        names=["path", "block", "data"])

    return listed.select("path", "content").mapInArrow(cut, "path string, block long, data binary").withColumn("file", F.xxhash64("path"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat token streams of ``docs``, one per input partition, as checkpointed blocks
    (file, block, data, closes): 16-bit ids, each document's ids then ``end_id``
    (one that no text is encoded to, see ``bytebpe.end_id_for``), cut every ``block_tokens`` ids wherever that falls.  ``closes`` are the doc_ids
    in stream order by the block their last id is in: the sidecar that names
    documents, which counting never reads."""
    fields = columns(docs, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tessera.llm import bytebpe
        bpe, file, block = bytebpe.load(tokenizer), TaskContext.get().partitionId(), 0
        held, closes = np.zeros(0, "<u2"), []

        def out(data, ids):
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data.tobytes()], pa.binary()),
                 pa.array([ids], pa.list_(pa.int64()))], names=["file", "block", "data", "closes"])

        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*bpe.ids(t.as_py()), end_id], "<u2")
                held = np.concatenate((held, ids)) if len(held) else ids
                while len(held) > block_tokens:
                    yield out(held[:block_tokens], closes)
                    held, closes, block = held[block_tokens:], [], block + 1
                closes.append(doc)
        if len(held):
            yield out(held, closes)

    return stored(fields.mapInArrow(run, "file long, block long, data binary, closes array<long>"))


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and n_tokens (without the end id) of every row, counted by the
    separator scan over flat token files of the texts.

    A text may hold a special token's string, which counts as the one id it is
    encoded to.  Where ``end_id`` is such an id, the streams are written with an id
    that the vocabulary leaves free.  A null or empty text has 0 tokens; null ids stay null; repeated rows are
    documents of their own; an empty table gives no rows.
    """
    from tessera.llm import bytebpe
    end_id = bytebpe.end_id_for(tokenizer, end_id)
    files = token_files(docs, tokenizer, end_id, doc_id, text)
    counts = document_lengths(files.select("file", "block", "data"), end_id)
    named = files.select("file", "block", F.size("closes").cast("long").alias("n"), "closes")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = named.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    named = (named.join(first, ["file", "block"]).select("file", "first", F.posexplode("closes").alias("k", "doc_id"))
             .select("file", (F.col("first") + F.col("k")).alias("doc_no"), "doc_id"))
    return named.join(counts, ["file", "doc_no"]).select("doc_id", "n_tokens")
