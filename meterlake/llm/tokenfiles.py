"""Token counts by a separator scan over flat token files.

A token file is a plain run of 16-bit token ids, without an index; documents
end with an end-of-document id. Files are cut into blocks of a fixed size, the
ends are searched for in each block with vector operations, and documents that
cross blocks are stitched with a prefix scan over the blocks: the running
number of ends gives a document's ordinal, the running maximum of their
positions its start.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stored, tokenizer_file

VOCABULARY = "byte_bpe_50k.json"
END_OF_DOCUMENT = 50256
WIDTH = 2
BLOCK_TOKENS = 1 << 19
PART = 1 << 15  # characters encoded as one piece
BATCH = 1 << 20
# White space after something else: no unit of the tokenizer spans it.
BREAK = re.compile(r"(?<=\S)(?=[ \n])")


@cache
def _tokenizer(path: str):
    """One per Python worker."""
    # Tasks run side by side already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
    return tokenizer


def _parts(text: str) -> list[str]:
    """The text in parts whose ids, put together, are those of the text."""
    parts, start = [], 0
    while len(text) - start > PART and (found := BREAK.search(text, start + PART)):
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


def encoded(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """The column `tokens` (16-bit little-endian ids) per row of docs, in their order; a null text has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _tokenizer(tokenizer or tokenizer_file(VOCABULARY))
        for batch in batches:
            waiting, owner, done, held = [], [], [], 0
            for i, text in enumerate(batch.column(0)):
                parts = _parts(text.as_py() or "")
                waiting += parts
                owner += [i] * len(parts)
                held += sum(map(len, parts))
                if held > BATCH or i + 1 == len(batch):
                    coded = code.encode_batch_fast(waiting, add_special_tokens=False)
                    out = [b""] * (i + 1 - len(done))
                    for at, c in zip(owner, coded, strict=True):
                        out[at - len(done)] += np.array(c.ids, dtype="<u2").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["tokens"])
                    done += [None] * len(out)
                    waiting, owner, held = [], [], 0

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "tokens binary")


def write_token_files(tokens: DataFrame, path: str, end: int = END_OF_DOCUMENT) -> None:
    """Write the column `tokens` as flat files, one per partition, each row followed by the end id.

    Spark's writer for plain lines does it, with the bytes of the end id as the line end.
    """
    mark = end.to_bytes(WIDTH, "little").decode("latin-1")
    lines = tokens.select(F.col("tokens").cast("string").alias("value"))
    lines.write.option("lineSep", mark).option("encoding", "ISO-8859-1").text(path)


def scan(spark: SparkSession, path: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, ordinal, start, n_tokens, ended for every document of the token files under path.

    start counts tokens from the start of the file; the end id is not counted.
    Tokens after the last end are a document with ended = false. Empty
    documents count 0, empty files have no row, an odd byte at the end of a file is no token. A
    file is read as one value, which Spark limits to 2 GB; its blocks are
    searched one by one.
    """
    size = WIDTH * block_tokens
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", F.octet_length("content").alias("bytes"))
    blocks = files.select("file", "content", F.explode(F.sequence(F.lit(0), F.expr(f"greatest(bytes - 1, 0) div {size}"))).alias("block"))
    blocks = blocks.select("file", F.col("block").cast("int").alias("block"), F.expr(f"substring(content, cast(block * {size} + 1 AS int), {size})").alias("bytes"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, found = [], []
            for part in batch.column(2):
                ids = np.frombuffer(part.as_buffer(), dtype="<u2", count=len(part.as_buffer()) // WIDTH)
                count.append(len(ids))
                found.append(np.flatnonzero(ids == end).astype(np.int32))
            arrays = [batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "n", "ends"])

    searched = stored(blocks.mapInArrow(search, "file string, block int, n long, ends array<int>"), "ends")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("block").cast("long") * block_tokens
    last = F.when(F.size("ends") > 0, base + F.element_at("ends", -1))
    summary = searched.select("file", "block", "n", "ends", base.alias("base"), last.alias("last"))
    summary = summary.withColumns({
        "ordinal": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
        "open": F.coalesce(F.max("last").over(before), F.lit(-1)) + 1,
        "final": F.lead("block").over(order).isNull(),
    })
    spans = (
        "concat(transform(ends, (e, i) -> struct(ordinal + i AS ordinal, CASE WHEN i = 0 THEN open ELSE base + ends[i - 1] + 1 END AS start,"
        " base + e AS stop, true AS ended)),"
        " CASE WHEN final AND base + n > coalesce(last + 1, open) THEN array(struct(ordinal + size(ends) AS ordinal,"
        " coalesce(last + 1, open) AS start, base + n AS stop, false AS ended)) ELSE array() END)"
    )
    rows = summary.select("file", F.inline(F.expr(spans)))
    return rows.select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")


def file_number(file: str = "file"):
    """The partition that wrote a file of write_token_files."""
    return F.regexp_extract(file, r"part-(\d+)-[^/]*$", 1).cast("int")


def positions(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, number, ordinal: where write_token_files puts each row of docs, which must be a plain scan of a table."""
    place = F.monotonically_increasing_id()
    return docs.select(F.col(id_col).alias("id"), F.shiftright(place, 33).cast("int").alias("number"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal"))


def end_id(path: str, name: str = "<|endoftext|>") -> int:
    """The end-of-document id of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        return next(t["id"] for t in json.load(file)["added_tokens"] if t["content"] == name)
