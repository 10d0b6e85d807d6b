"""CSV records cut out of files of any size by many tasks.

A line end inside quotes does not end a record, so a task that begins in the
middle of a file cannot tell where it is. Each line is therefore read as a
function: whether it ends inside quotes if it begins outside, and if it begins
inside. Lines without a quote change nothing. The functions of a block's lines
are composed, then those of a file's blocks in order (one row a block), and each
block is read again with the state that it begins in. Only records that cross
a block's end are shuffled; files without line ends in quotes are cut natively.

A quote opens a cell only at its beginning (after white space), two quotes
inside are one, and a quote that neither ends a cell nor is doubled stands for
itself, inside and outside of quoted cells. Quotes that are never closed hold
the rest of the file. Empty lines are skipped; a carriage return before a line
end belongs to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .folders import scratch

_SPACE = r"[\s\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*+"
_FIRST = r"[^\",\s\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Inside quotes up to the quote that ends the cell, or to the end. Possessive throughout: no step is taken back.
_BODY = r"[^\"]*+(?:\"(?:\"|(?=[^\",]))[^\"]*+)*+"
_CELLS = rf"(?:{_SPACE}(?:\"{_BODY}\"|{_FIRST}[^,]*+|),)*+"
_OPEN = rf"{_CELLS}{_SPACE}\"{_BODY}\z"
FROM_OUTSIDE, FROM_INSIDE = rf"\A{_OPEN}", rf"\A{_BODY}(?:\z|\",{_OPEN})"
WHOLE, TAIL, HEAD, MIDDLE = range(4)  # a record, its part before a block's end, behind one, and between two


def cells(record: Column, unclosed: Column) -> Column:
    """The cells of a record, quotes taken off."""
    ended = F.concat(record, F.when(unclosed, F.lit('",')).otherwise(F.lit(",")))
    raw = F.regexp_extract_all(ended, F.lit(rf"{_SPACE}(\"{_BODY}\"(?=,)|[^,]*+),"), F.lit(1))
    plain = F.transform(raw, lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(record.contains('"'), plain).otherwise(F.split(record, ",", -1))


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, block, and place in the block; ``from_outside`` and ``from_inside`` tell if they end inside quotes."""
    read = spark.read.option("lineSep", "\n").text(paths)
    parts = [c for c in read.columns if c != "value"]
    value = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    place = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_name", "source_file"), ("file_path", "source_path"), ("file_block_start", "source_offset"))]
    rows = read.select(value.alias("value"), *place, F.monotonically_increasing_id().alias("source_line"), *(F.col(c).cast("string").alias(c) for c in parts))
    quoted = F.col("value").contains('"')
    rows = rows.withColumn("from_outside", quoted & F.col("value").rlike(FROM_OUTSIDE)).withColumn("from_inside", ~quoted | F.col("value").rlike(FROM_INSIDE))
    return rows.withColumn("block", F.xxhash64("source_path", "source_offset"))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row a block: the state before and behind it, whether a line of it can open quotes, and in a file's first block its header line."""
    changes = F.col("from_outside") | ~F.col("from_inside")
    header = (F.col("source_offset") == 0) & (F.col("value") != "")
    # a line and what it does, as one number: a block of quoted lines stays small
    code = F.shiftleft("source_line", 2) + F.when(F.col("from_outside"), 2).otherwise(0) + F.when(F.col("from_inside"), 1).otherwise(0)
    found = lines.groupBy("source_path", "source_offset", "block").agg(
        F.array_sort(F.collect_list(F.when(changes, code))).alias("fs"), F.bool_or("from_outside").alias("opens"),
        F.min_by(F.when(header, F.struct("source_line", "value", "from_outside")), F.when(header, F.col("source_line"))).alias("header"),
    )
    step = lambda at, f: F.when(at, f.bitwiseAND(1) == 1).otherwise(f.bitwiseAND(2) == 2)
    pair = F.aggregate("fs", F.struct(F.lit(False).alias("o"), F.lit(True).alias("i")), lambda a, f: F.struct(step(a["o"], f).alias("o"), step(a["i"], f).alias("i")))
    each = found.select("source_path", "source_offset", "block", "header", "opens", pair.alias("f"))
    files = each.groupBy("source_path").agg(F.array_sort(F.collect_list(F.struct("source_offset", "block", "header", "opens", "f"))).alias("blocks"))
    # the state behind each block of a file, in order
    after = F.aggregate("blocks", F.array().cast("array<boolean>"), lambda acc, b: F.concat(acc, F.array(F.when(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(False)), b["f"]["i"]).otherwise(b["f"]["o"]))))
    rows = files.withColumn("after", F.when(F.size("blocks") > 0, after)).select("source_path", "after", F.posexplode("blocks").alias("at", "b"))
    return rows.select("source_path", F.col("b.source_offset").alias("source_offset"), F.col("b.block").alias("block"), "b.opens", "b.header", F.coalesce(F.get("after", F.col("at") - 1), F.lit(False)).alias("starts"), F.get("after", F.col("at")).alias("ends"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks in order (block, starts, from_outside, from_inside, source_line, value, others) -> pieces: the same columns without the first four, and ``piece``."""
    block, held, first, began = None, None, None, WHOLE
    names = None

    def out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, list(schema)[4:], strict=False)), pa.array(columns[-1], pa.int32())], names=names)

    def piece(kind: int) -> tuple:
        return first[0], "\n".join(held), *first[2:], kind

    for batch in batches:
        schema = batch.schema
        names = [*schema.names[4:], "piece"]
        outside, inside = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        blocks, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        if held is None and not outside.any() and inside.all() and not starts.any():
            block = int(blocks[-1]) if len(blocks) else block
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array([WHOLE] * batch.num_rows, pa.int32())], names=names)
            continue
        rows, done = list(zip(*(c.to_pylist() for c in batch.columns[4:]), strict=True)), []
        for b, s, o, i, row in zip(blocks.tolist(), starts.tolist(), outside.tolist(), inside.tolist(), rows, strict=True):
            if b != block:
                if held is not None:
                    done.append(piece(TAIL if began == WHOLE else MIDDLE))
                block, held, began = b, [] if s else None, HEAD if s else WHOLE
                first = row
            if held is None:
                if o:
                    held, first, began = [row[1]], row, WHOLE
                else:
                    done.append((*row, WHOLE))
                continue
            held.append(row[1])
            if not i:
                done.append(piece(began))
                held, began = None, WHOLE
        if done:
            yield out(done, schema)
    if held is not None:
        yield out([piece(TAIL if began == WHOLE else MIDDLE)], schema)


def read_records(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, list[list[str]]]:
    """Records below the header of each file (``record, cells, layout, source_file, source_path, source_offset, source_line`` and the columns of the folders' names), and the header cells of each layout.

    ``source_line`` orders the records of one block. Broadcast is one row a block
    (of ``spark.sql.files.maxPartitionBytes`` each); the layouts come to the
    driver, as the columns' names must.
    """
    lines = _lines(spark, paths)
    path = scratch(spark, "csv-blocks")
    _blocks(lines).write.parquet(path)
    blocks = spark.read.parquet(path)
    carried = ["source_line", "value", *(c for c in lines.columns if c not in ("source_line", "value", "from_outside", "from_inside", "block"))]
    met = lines.join(F.broadcast(blocks.select("block", "starts", "ends", F.col("header.source_line").alias("header_line"))), "block")
    crossed = bool(blocks.where("opens").head(1))
    no = F.lit(False).alias("unclosed")
    if not crossed:
        records = met.select(*carried, no)
    else:
        types = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
        schema = ", ".join([*(f"`{c}` {types[c]}" for c in carried), "piece int"])
        given = ["block", "starts", "from_outside", "from_inside", *carried]
        records = met.select(*given).mapInArrow(_cut, schema).where(F.col("piece") == WHOLE).select(*carried, no)
        if blocks.where("starts or ends").head(1):
            # only blocks that a record crosses into or out of are read once more
            crossing = met.where("starts or ends").select(*given).mapInArrow(_cut, schema).where(F.col("piece") != WHOLE)
            order = Window.partitionBy("source_path").orderBy("source_offset", "source_line")
            chained = crossing.withColumn("chain", F.count_if(F.col("piece") == TAIL).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            others = [c for c in carried if c not in ("value", "source_path")]
            joined = chained.groupBy("source_path", "chain").agg(F.array_sort(F.collect_list(F.struct("source_offset", "source_line", *(c for c in others if c not in ("source_offset", "source_line")), "piece", "value"))).alias("p"))
            whole = joined.select(*(F.col("source_path") if c == "source_path" else F.array_join(F.col("p.value"), "\n").alias("value") if c == "value" else F.col("p")[0][c].alias(c) for c in carried), (F.element_at("p", -1)["piece"] != HEAD).alias("unclosed"))
            records = records.unionByName(whole)
    heads = blocks.where("header is not null").select("source_path", F.col("header.source_line").alias("header_line"), "header.value", F.lit(False).alias("unclosed"), F.col("header.from_outside").alias("open"))
    if heads.where("open").head(1):  # a header with a line end in a cell
        known = records.where((F.col("source_offset") == 0) & (F.col("value") != "")).groupBy("source_path").agg(F.min_by(F.struct("value", "unclosed"), "source_line").alias("h"))
        heads = heads.select("source_path", "header_line").join(known, "source_path").select("source_path", "header_line", "h.*")
    heads = heads.select("source_path", "header_line", cells(F.col("value"), F.col("unclosed")).alias("names"))
    layouts = [r["names"] for r in heads.groupBy("names").agg(F.min("source_path").alias("least")).orderBy("least").collect()]
    numbered = F.lit(None).cast("int")
    for n, names in enumerate(layouts):
        numbered = F.when(F.col("names") == F.array(*map(F.lit, names)), n).otherwise(numbered)
    at = heads.select(F.xxhash64("source_path").alias("_file"), "header_line", numbered.alias("layout"))
    out = records.where(F.col("value") != "").withColumn("_file", F.xxhash64("source_path")).join(F.broadcast(at), "_file")  # one row a file
    out = out.where((F.col("source_offset") != 0) | (F.col("source_line") != F.col("header_line")))
    return out.select(F.col("value").alias("record"), cells(F.col("value"), F.col("unclosed")).alias("cells"), "layout", *(c for c in carried if c != "value")), layouts
