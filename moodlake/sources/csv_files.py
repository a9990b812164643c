"""CSV scans that survive mixed encodings, mixed column orders and newlines in fields, and split files of any size."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from moodlake import schemas
from moodlake.session import scratch_table

# Double quotes around fields, doubled inside them; quoted fields may hold newlines.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
# Rows of a lookup (one per file, or per byte range of 128 MB by default) that are sent to all tasks; beyond this rows are shuffled instead.
MOST_SENT = 500_000


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines (without their newline) with the byte range they were read in: ``file`` and ``block``, where that range begins.

    Lines of a range come in order within a task. Large files are many ranges.
    """
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    )


def _is_odd(value: str = "value") -> Column:
    """Whether a line has an odd number of quotes: it then ends inside a field if it began outside of one, and the other way round."""
    return (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1


def _is_blank(value: str = "value") -> Column:
    return F.btrim(value, F.lit(" \t\r")) == ""


def inspect_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per byte range: its first line that is not blank (``header``, bytes) and that line's place, whether all of it is
    UTF-8, its number of lines with an odd number of quotes and the places of the first and last of them.

    One small row per range and task is shuffled. A UTF-8 character never spans a line break, so judging lines judges the
    file. Places are counted from the range's first line.
    """
    lines = _lines(spark, paths).withColumn("line", F.monotonically_increasing_id()).withColumn("odd", _is_odd())
    filled = F.when(~_is_blank(), F.col("line"))
    # A range has at most two kinds of lines. Collecting them, instead of a boolean aggregate, makes Spark aggregate
    # in a hash map; beside the header text it would otherwise sort all lines first.
    blocks = lines.groupBy("file", "block").agg(
        F.min_by(F.col("value").cast("binary"), filled).alias("header"), F.min(filled).alias("header_at"),
        F.collect_set(F.is_valid_utf8("value")).alias("kinds"), F.min("line").alias("first"),
        F.count_if("odd").alias("n_odd"), F.min(F.when(F.col("odd"), F.col("line"))).alias("first_odd"),
        F.max(F.when(F.col("odd"), F.col("line"))).alias("last_odd"),
    )
    places = [(F.col(c) - F.col("first")).alias(c) for c in ("header_at", "first_odd", "last_odd")]
    return blocks.select("file", "block", "header", *places, (~F.array_contains("kinds", False)).alias("is_utf8"), "n_odd")


def _scan_state(blocks: DataFrame) -> DataFrame:
    """Quote parity carried from range to range of a file, over one small row per range.

    ``head_to``: up to this place a range's lines belong to a record begun in an earlier range, the one that starts at
    ``opened``. ``tail_from``: from this place on its lines belong to a record that goes on in a later range.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)) % 2 == 1
    everything = F.lit(1 << 62)
    rows = blocks.withColumn("inside", inside).withColumn("leaves", (F.col("inside").cast("int") + F.col("n_odd")) % 2 == 1)
    rows = rows.withColumn("head_to", F.when(F.col("inside"), F.coalesce("first_odd", everything)).otherwise(-1))
    rows = rows.withColumn("tail_from", F.when(F.col("leaves") & (F.col("n_odd") > 0), F.col("last_odd")).otherwise(everything))
    opens = F.when(F.col("tail_from") < everything, F.col("block"))
    return rows.withColumn("opened", F.last(opens, ignorenulls=True).over(earlier))


def _layouts(blocks: DataFrame) -> DataFrame:
    """One row per file with a line that is not blank: its encoding and header, and in which range that stands."""
    first = F.when(F.col("header").isNotNull(), F.col("block"))
    files = blocks.groupBy("file").agg(
        F.min_by("header", first).alias("header"), F.min(first).alias("header_block"), F.bool_and("is_utf8").alias("is_utf8"),
    ).filter("header IS NOT NULL")
    text = F.when(F.col("is_utf8"), F.col("header").cast("string")).otherwise(F.decode("header", "ISO-8859-1"))
    return files.withColumn("header", F.regexp_replace(text, "^\\x{feff}|\\r+$", ""))


def inspect_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file with a line that is not blank: its header, whether all of it is UTF-8, and whether some field may
    hold a newline (a line with an odd number of quotes)."""
    blocks = inspect_blocks(spark, paths)
    spanning = blocks.groupBy("file").agg(F.max(F.col("n_odd") > 0).alias("multi_line"))
    return _layouts(blocks).join(spanning, "file").select("file", "header", "is_utf8", "multi_line")


def _columns(header: str) -> list[str]:
    """Names of one header line. As for a dict of a row, the last of equal names counts; the others, and nameless columns,
    get stand-in names."""
    names = next(csv.reader([header]))
    later = [{n.lower() for n in names[i + 1:]} for i in range(len(names))]
    return [name if name and name.lower() not in rest else f"_column{i}" for i, (name, rest) in enumerate(zip(names, later))]


def _missing(columns: list[str]) -> str | None:
    return ",".join(name for name in schemas.REQUIRED_COLUMNS if name not in columns) or None


def _joined(rows: DataFrame, lookup: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Left join; a lookup of checked size is sent to all tasks, which keeps rows where and in the order they are."""
    return rows.join(F.broadcast(lookup) if size <= MOST_SENT else lookup, keys, "left")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with the place of each line in its byte range; lines of a range follow one another."""
    at, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file_no, block = batch.column("file_no").to_numpy(), batch.column("block").to_numpy()
        line = np.arange(len(file_no))
        new = np.append((file_no[0], block[0]) != at, (file_no[1:] != file_no[:-1]) | (block[1:] != block[:-1]))
        start = np.maximum.accumulate(np.where(new, line, -1))
        place = np.where(start >= 0, line - start, line + count)
        at, count = (file_no[-1], block[-1]), int(place[-1]) + 1
        yield batch, place


def _within(lines: DataFrame) -> DataFrame:
    """Records that begin and end in one byte range: ``file_no``, ``block``, ``line`` (the place of the first line), ``record`` (bytes).

    Lines come in order. Those of records that cross ranges, blank lines between records and headers are left out.
    """
    names = ["file_no", "block", "line", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, began = [], ()
        for batch, place in _placed(batches):
            file_no, block, head_to, tail_from, header = [batch.column(c).to_numpy() for c in ("file_no", "block", "head_to", "tail_from", "header_at")]
            odd, blank = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("odd", "blank")]
            own = (place > head_to) & (place < tail_from)
            # Without the records that cross, each range begins and ends outside of quotes.
            inside = (np.cumsum(odd & own) - (odd & own) + bool(held)) % 2 == 1
            single = np.flatnonzero(own & ~inside & ~odd & ~blank & (place != header))
            columns = [pa.array(file_no[single]), pa.array(block[single]), pa.array(place[single]), batch.column("value").take(pa.array(single))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            several, out = np.flatnonzero(own & (inside | odd)), []
            for k, value in zip(several, batch.column("value").take(pa.array(several)).to_pylist()):
                if not inside[k]:
                    began = (file_no[k], block[k], place[k], place[k] == header[k])
                held.append(value)
                if inside[k] and odd[k]:
                    if not began[3]:
                        out.append((*began[:3], b"\n".join(held)))
                    held = []
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)

    return lines.mapInArrow(run, "file_no bigint, block bigint, line bigint, record binary")


def _across(lines: DataFrame) -> DataFrame:
    """The other records, of the same columns: at most one begins in each range. Only their lines are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, place in _placed(batches):
            tail = place >= batch.column("tail_from").to_numpy()
            part = np.flatnonzero(tail | (place <= batch.column("head_to").to_numpy()))
            if len(part):
                found = batch.take(pa.array(part))
                opened = np.where(tail[part], found.column("block").to_numpy(), found.column("opened").to_numpy())
                columns = [found.column("file_no"), pa.array(opened), found.column("block"), pa.array(place[part]), found.column("value")]
                yield pa.RecordBatch.from_arrays(columns, names=["file_no", "opened", "block", "line", "value"])

    parts = lines.mapInArrow(run, "file_no bigint, opened bigint, block bigint, line bigint, value binary")
    held = F.array_sort(F.collect_list(F.struct("block", "line", F.col("value").cast("string").alias("value"))))
    records = parts.groupBy("file_no", "opened").agg(held.alias("held"))
    return records.select(
        "file_no", F.col("opened").alias("block"), F.col("held")[0]["line"].alias("line"),
        F.array_join("held.value", "\n").cast("binary").alias("record"),
    )


def _first(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records in the order of files and places. Ranges before the one with the n-th record are taken whole;
    only that range is sorted. Counts per range, not records, meet in one place."""
    counted = scratch_table(records.groupBy("file_no", "block").agg(F.count(F.lit(1)).alias("n")), "csv-counts")
    order = Window.partitionBy("file_no").orderBy("block")
    files = counted.groupBy("file_no").agg(F.sum("n").alias("total"))
    so_far = files.withColumn("so_far", F.sum("total").over(Window.orderBy("file_no")) - F.col("total"))
    upto = counted.withColumn("upto", F.sum("n").over(order)).join(so_far, "file_no").withColumn("upto", F.col("upto") + F.col("so_far"))
    last = upto.filter(F.col("upto") >= n).orderBy("upto").first()
    if last is None:
        return records
    place, cut = F.struct("file_no", "block"), F.struct(F.lit(last.file_no).alias("file_no"), F.lit(last.block).alias("block"))
    in_range = F.row_number().over(Window.partitionBy("file_no", "block").orderBy("line"))
    part = records.filter(place == cut).withColumn("_at", in_range).filter(F.col("_at") <= n - last.upto + last.n).drop("_at")
    return records.filter(place < cut).unionByName(part)


def _by_layout(spark: SparkSession, paths: str | list[str], multi_line: bool, max_records: int | None) -> DataFrame:
    blocks = inspect_blocks(spark, paths)
    if not multi_line:
        blocks = blocks.withColumn("n_odd", F.lit(0).cast("long"))
    blocks = scratch_table(blocks, "csv-ranges")
    files = _layouts(blocks).withColumn("file_no", F.row_number().over(Window.orderBy("file")).cast("long"))
    files = scratch_table(files, "csv-files")
    headers = [r.header for r in files.select("header").distinct().orderBy("header").collect()]
    if not headers:
        return spark.createDataFrame([], schemas.POST).withColumn("missing_columns", F.lit(_missing(schemas.POST.names)))
    columns = {h: _columns(h) for h in headers}
    names = list(dict.fromkeys(name for found in columns.values() for name in found))
    layouts = [(h, [found.index(n) if n in found else None for n in names], _missing(found)) for h, found in columns.items()]
    layouts = spark.createDataFrame(layouts, "header string, at array<int>, missing_columns string")
    n_files, n_blocks = files.count(), blocks.count()

    at_header = F.when(F.col("block") == F.col("header_block"), F.col("header_at"))
    state = _scan_state(blocks).join(files.select("file", "file_no", "header_block"), "file")
    state = state.select(
        "file", "block", "file_no", "head_to", "tail_from", F.coalesce("opened", F.lit(-1)).alias("opened"),
        F.coalesce(at_header, F.lit(-1)).alias("header_at"), (F.col("inside") | F.col("leaves")).alias("crosses"),
    )
    state = scratch_table(state, "csv-state")
    lines = _joined(_lines(spark, paths), state.drop("crosses"), ["file", "block"], n_blocks)
    if n_blocks > MOST_SENT:
        lines = lines.withColumn("line", F.monotonically_increasing_id())
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "line").drop("line")
    # A file without a layout is blank throughout. A file that is read in other ranges than before is an error.
    lines = lines.withColumn("odd", _is_odd() if multi_line else F.lit(False)).withColumn("blank", _is_blank())
    moved = F.raise_error(F.concat(F.lit("byte ranges have changed while reading "), F.col("file")))
    lines = lines.withColumn("file_no", F.when(F.col("file_no").isNull() & ~F.col("blank"), moved.cast("long")).otherwise(F.col("file_no")))
    lines = lines.filter("file_no IS NOT NULL").withColumn("value", F.col("value").cast("binary")).drop("file")
    records = _within(lines)
    if not state.filter("crosses").isEmpty():
        records = records.unionByName(_across(lines))
    if max_records is not None:
        records = _first(records, max_records)

    known = files.join(F.broadcast(layouts), "header").select("file_no", "is_utf8", "at", "missing_columns")
    text = F.when(F.col("is_utf8"), F.col("record").cast("string")).otherwise(F.decode("record", "ISO-8859-1"))
    width = max(map(len, columns.values()))
    fields = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(width)])
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    rows = _joined(records, known, ["file_no"], n_files).withColumn("_fields", F.from_csv(F.rtrim(text, F.lit("\r")), fields.simpleString(), options))
    values = F.array(*[F.col("_fields")[f"_{i}"] for i in range(width)])
    rows = rows.select(values.alias("_values"), "at", F.col("missing_columns").alias("_missing"))
    return rows.select(*[F.get("_values", F.get("at", F.lit(i))).alias(n) for i, n in enumerate(names)], F.col("_missing").alias("missing_columns"))


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    multi_line: bool = True,
    max_records: int | None = None,
    partitions: int | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """All columns of all files as text, found by header name.

    A file that is not UTF-8 throughout is read as Latin-1. Each file's own header counts; a column a file lacks is NULL,
    and ``missing_columns`` names the required ones among them. Encodings and headers are a table of one row per file that
    is joined to the records, so there is one scan whatever the files are like; only distinct headers reach the driver.

    Fields may hold newlines, and a file of any size is still read by many tasks: a first pass counts quotes by byte range,
    their parity is carried from range to range, and only the (at most one) record that crosses into a later range is put
    together by a shuffle. ``multi_line=False`` takes every line for a record. ``partitions`` spreads the rows after the
    scan. ``max_records`` keeps the first input rows in the order of files and lines.

    Judging files reads everything once more. Where all are known to share one encoding and one header, name the
    ``encoding`` and they are read in a single scan, a file with newlines in fields by one task; a file with another header
    then fails the job.
    """
    if encoding:
        options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "encoding": encoding, "enforceSchema": "false"}
        rows = spark.read.options(**options).csv(paths)
        rows = rows.withColumn("missing_columns", F.lit(_missing(rows.columns)).cast("string"))
        if max_records is not None:
            rows = rows.limit(max_records)
    else:
        rows = _by_layout(spark, paths, multi_line, max_records)
    return rows.repartition(partitions) if partitions else rows


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.POST,
    encoding: str = "UTF-8",
    max_files: int | None = None,
) -> DataFrame:
    """New CSV files of a folder as a stream. The schema is fixed; a file whose
    header differs from it stops the stream instead of mixing up columns."""
    reader = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS, multiLine="true", enforceSchema="false", encoding=encoding)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)
