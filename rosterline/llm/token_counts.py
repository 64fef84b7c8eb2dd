"""Token counts of the documents in flat token files without an index.

A flat file is the ids of its documents one after the other, each document closed by an
end id; it comes in blocks that know nothing of documents. Every block is searched for the
end id at once. What a block leaves open is settled by a prefix scan over short block
summaries: ids and documents before the block, and the place of the last end id before it.
The scan has two levels, so a file of any size is spread over many tasks.

Defined cases: two end ids in a row are an empty document; ids after a file's last end id
are one document with ``complete`` false; an empty block or file gives nothing; blocks
are ordered by their number, which may have gaps but no repeats within a file; the files
written here have a document per row of the table, NULL texts empty, repeated rows
repeated; extra columns stay, those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rosterline.llm import carried
from rosterline.llm.tokenizing import shared_encoder
from rosterline.workspace import fresh_dir

BLOCK_IDS = 65_536
GROUP_BLOCKS = 256
OUTPUTS = ["index", "ordinal", "start", "n_tokens", "complete"]


def write_flat_files(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS, width: int = 2
) -> DataFrame:
    """Tokenizes ``docs`` into one flat file of ids of ``width`` bytes per task, stored in blocks.

    An id that does not fit in that width fails the job, as it would turn into another one.

    Rows (``file_id``, ``block``, ``ids``, ``doc_ids``): the last are the ids of the documents that
    end in the block, for the reader who wants to name what a scan counts; no scan needs them.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, special=False)  # a text never holds the end id
        end = np.array([end_id], f"<u{width}").tobytes()
        file_id, kind = TaskContext.get().partitionId(), None
        size, block, written, held = width * block_ids, 0, 0, bytearray()
        ending: list[int] = []  # the block in which each document not given yet ends
        names: list = []

        def give(data: bytes) -> pa.RecordBatch:
            own = [name for at, name in zip(ending, names) if at == block]
            del names[:len(own)], ending[:len(own)]
            columns = [pa.array([file_id], pa.int32()), pa.array([block], pa.int64()), pa.array([data], pa.binary()), pa.array([own], pa.list_(kind))]
            return pa.RecordBatch.from_arrays(columns, names=["file_id", "block", "ids", "doc_ids"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                for name, data in zip(part.column(0).to_pylist(), encoded):
                    ids = np.frombuffer(data, "<u4")
                    if int(ids.max(initial=0)) >= 1 << (8 * width):
                        raise ValueError(f"token id {ids.max()} does not fit in {width} bytes")
                    held += ids.astype(f"<u{width}").tobytes() + end
                    written += len(data) // 4 + 1
                    ending.append((written - 1) // block_ids)
                    names.append(name)
                while len(held) >= size:
                    yield give(bytes(held[:size]))
                    del held[:size]
                    block += 1
        if held:
            yield give(bytes(held))

    if end_id >= 1 << (8 * width):
        raise ValueError(f"end id {end_id} does not fit in {width} bytes")
    path = fresh_dir(docs.sparkSession, "flat-files")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"file_id INT, block BIGINT, ids BINARY, doc_ids ARRAY<{kind}>"
    flat = docs.select(id_col, text_col).mapInArrow(write, schema)
    flat.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def read_flat_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (``file_id`` the file's path, ``block``, ``ids``) of raw token files at a path Spark can read.

    A file is one row of Spark's binary source before it is cut, so files should stay well
    under the 2 GB that such a row can hold.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    size = width * block_ids
    starts = F.sequence(F.lit(0), F.floor((F.octet_length("content") - 1) / size).cast("int"))
    block = files.select(F.col("path").alias("file_id"), F.explode(starts).alias("n"), "content")
    return block.select("file_id", F.col("n").cast("bigint").alias("block"), F.expr(f"substring(content, n * {size} + 1, {size})").alias("ids"))


def separators(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """``blocks`` without ids, with ``n_ids`` and ``ends``, the places of the end id in each block."""
    others = [c for c in blocks.columns if c not in ("ids", "n_ids", "ends")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ends = [], []
            for data in batch.column("ids"):
                ids = np.frombuffer(data.as_buffer() or b"", f"<u{width}") if data.is_valid else np.zeros(0, f"<u{width}")
                counts.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id).astype(np.int32))
            columns = [*(batch.column(c) for c in others), pa.array(counts, pa.int64()), pa.array(ends, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "n_ids", "ends"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema if f.name in others]
    return blocks.select(*others, "ids").mapInArrow(search, ", ".join([*kinds, "n_ids BIGINT", "ends ARRAY<INT>"]))


def _before(total, window):
    return F.coalesce(total.over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def document_lengths(blocks: DataFrame, end_id: int, width: int = 2, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """One row per document: its place in the block where it ends, ordinal and start in the file, ``n_tokens``.

    ``blocks`` has ``file_id``, ``block`` and ``ids``; ``n_tokens`` is without the end id.
    """
    others = [c for c in blocks.columns if c not in ("ids", *OUTPUTS)]
    place = ["file_id", "block"]
    row = carried.packed([c for c in others if c not in place]).alias("__row")
    found = separators(blocks.select(*place, row, "ids"), end_id, width)
    rows = found.withColumn("__group", F.floor(F.col("block") / group_blocks))
    inside = Window.partitionBy("file_id", "__group").orderBy("block")
    last = F.when(F.size("ends") > 0, F.col("__ids") + F.try_element_at("ends", F.lit(-1)) + 1)
    rows = rows.withColumns({
        "__ids": _before(F.sum("n_ids"), inside), "__docs": _before(F.sum(F.size("ends")), inside),
    }).withColumn("__last", F.max(last).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    groups = found.groupBy("file_id", F.floor(F.col("block") / group_blocks).alias("__group")).agg(
        F.sum("n_ids").alias("ids"), F.sum(F.size("ends")).alias("docs"), F.max("block").alias("top"),
        F.max(F.when(F.size("ends") > 0, F.struct("block", F.try_element_at("ends", F.lit(-1)).alias("at")))).alias("last"),
        F.sort_array(F.collect_list(F.struct("block", "n_ids"))).alias("sizes"),
    )
    # Where the group's last end id stands, counted from the group's first id; a group is bounded.
    ahead = F.aggregate(
        F.filter("sizes", lambda s: s.block < F.col("last.block")), F.lit(0).cast("bigint"), lambda n, s: n + s.n_ids
    )
    over = Window.partitionBy("file_id").orderBy("__group")
    groups = groups.withColumns({"__g_ids": _before(F.sum("ids"), over), "__g_docs": _before(F.sum("docs"), over)})
    groups = groups.withColumn("__g_end", F.col("__g_ids") + ahead + F.col("last.at") + 1)
    groups = groups.withColumn("__g_last", F.max("__g_end").over(over.rowsBetween(Window.unboundedPreceding, -1)))
    groups = groups.withColumn("__g_top", F.max("top").over(Window.partitionBy("file_id")))
    groups = groups.select("file_id", "__group", "__g_ids", "__g_docs", "__g_last", "__g_top")
    rows = rows.join(groups, ["file_id", "__group"])
    first_id = F.col("__g_ids") + F.col("__ids")
    begun = F.coalesce(F.col("__g_ids") + F.col("__last"), F.col("__g_last"), F.lit(0))
    open_from = F.when(F.size("ends") > 0, first_id + F.try_element_at("ends", F.lit(-1)) + 1).otherwise(begun)
    stops = F.transform("ends", lambda e, i: F.struct(
        i.alias("index"), F.when(i == 0, begun).otherwise(first_id + F.get("ends", i - 1) + 1).alias("start"),
        (first_id + e).alias("stop"), F.lit(True).alias("complete"),
    ))
    rest = F.when(
        (F.col("block") == F.col("__g_top")) & (first_id + F.col("n_ids") > open_from),
        F.array(F.struct(F.size("ends").alias("index"), open_from.alias("start"), (first_id + F.col("n_ids")).alias("stop"), F.lit(False).alias("complete"))),
    ).otherwise(F.filter(stops, lambda s: F.lit(False)))
    documents = rows.select(
        *place, "__row", (F.col("__g_docs") + F.col("__docs")).alias("__first"), F.explode(F.concat(stops, rest)).alias("__doc")
    )
    return documents.select(
        *[F.col(c) if c in place else F.col("__row").getField(c).alias(c) for c in others], "__doc.index", (F.col("__first") + F.col("__doc.index")).alias("ordinal"), F.col("__doc.start").alias("start"),
        (F.col("__doc.stop") - F.col("__doc.start")).alias("n_tokens"), "__doc.complete",
    )
