"""Landed trade archives (S1) and the landing manifest.

Archives land as ``<root>/ticker=<T>/session_date=<D>/<name>.zip``: one zip per fetched
(ticker, session) holding one text member, a header line and then the trade lines. The
scan is Spark's ``binaryFile`` source; a small Python function unzips one archive into its
lines. Each archive is one task's worth of work (a single exchange file), the lines are
then partitioned and parsed by Spark like any other rows.
"""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ticklake.schemas import SOURCE_EOD

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
    T.StructField("ticker", T.StringType()), T.StructField("session_date", T.DateType()),
])

ARCHIVE_LINES = "member string, line_no int, raw_line string, archive_error string"


#: Lines and characters of a batch that a streamed archive gives to Spark at once; the largest line.
BATCH_LINES = 10_000
BATCH_CHARS = 1 << 22
LARGEST_LINE = 1 << 26


def member_lines(source, start: int = 1):
    """(member, first line number, lines) of an open archive, batch by batch, header dropped; the
    member is read as a stream, so the archive may be larger than memory. A line beyond
    LARGEST_LINE characters is an error of the archive."""
    with zipfile.ZipFile(source) as archive:
        name = archive.namelist()[0]
        with io.TextIOWrapper(archive.open(name), "ascii") as member:
            member.readline(LARGEST_LINE)
            at, lines, size = start, [], 0
            while line := member.readline(LARGEST_LINE):
                if len(line) == LARGEST_LINE:
                    raise ValueError("line too long")
                lines.append(line.rstrip("\n"))
                size += len(line)
                if len(lines) >= BATCH_LINES or size >= BATCH_CHARS:
                    yield name, at, lines
                    at, lines, size = at + len(lines), [], 0
            if lines or at == start:
                yield name, at, lines


def _rows(batch, columns, i, member, numbers, lines, error):
    """Lines of the archive in row ``i``, each with the first ``columns`` of that row."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(lines)
    same = [pa.repeat(batch.column(c)[i], n) for c in range(columns)]
    return pa.RecordBatch.from_arrays(
        [*same, pa.array([member] * n, pa.string()), pa.array(numbers, pa.int32()),
         pc.utf8_rtrim(pa.array(lines, pa.string()), "\n"), pa.array([error] * n, pa.string())],
        [*batch.schema.names[:columns], "member", "line_no", "raw_line", "archive_error"])


def _unzip_contents(batches):
    """Rows (..., content) -> one row per line of the first member, decoded as ASCII, header dropped.

    An archive that cannot be read whole (damaged, encrypted, unsupported, not ASCII) yields
    one row with ``archive_error`` and no line, so one bad file never stops the other
    tickers. The member is read twice as a stream, once to be sure of it and once for its
    lines, so no archive is held as text. A file without lines yields one row without text.
    """
    for batch in batches:
        columns = batch.num_columns - 1
        for i in range(batch.num_rows):
            content = batch.column(columns)[i].as_py() or b""
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    name = archive.namelist()[0]
                    with io.TextIOWrapper(archive.open(name), "ascii") as member:
                        while member.read(BATCH_CHARS):
                            pass
            except Exception as exc:  # whatever the decoders raise concerns this archive alone
                yield _rows(batch, columns, i, None, [None], [None], f"bad archive: {type(exc).__name__}: {exc}")
                continue
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                with io.TextIOWrapper(archive.open(name), "ascii") as member:
                    member.readline()
                    at = 1
                    while lines := member.readlines(BATCH_CHARS):
                        yield _rows(batch, columns, i, name, range(at, at + len(lines)), lines, None)
                        at += len(lines)
            if at == 1:
                yield _rows(batch, columns, i, name, [None], [None], None)


def _stream_paths(batches):
    """Rows (path, ...) -> the rows of ``_unzip_contents`` for the archive at each path, which is opened
    through pyarrow's file systems and read twice: once to be sure of it, once for its lines."""
    import pyarrow.fs as pafs

    for batch in batches:
        columns = batch.num_columns
        for i, path in enumerate(batch.column(0).to_pylist()):
            try:
                fs, name = pafs.FileSystem.from_uri(_uri(path))
                with fs.open_input_file(name) as source:
                    member, at, lines = None, 1, []
                    for member, at, lines in member_lines(source):  # noqa: B007
                        pass
            except Exception as exc:  # whatever the decoders raise concerns this archive alone
                yield _rows(batch, columns, i, None, [None], [None], f"bad archive: {type(exc).__name__}: {exc}")
                continue
            if at == 1 and not lines:
                yield _rows(batch, columns, i, member, [None], [None], None)
                continue
            with fs.open_input_file(name) as source:
                for member, at, lines in member_lines(source):
                    yield _rows(batch, columns, i, member, range(at, at + len(lines)), lines, None)


def archive_lines(archives: DataFrame, source: str = SOURCE_EOD, inline: int = 64 << 20) -> DataFrame:
    """binaryFile rows (with ``ticker``/``session_date`` partition columns) -> one row per
    trade line with its file context (``landed_at`` and ``archive`` order the files), one
    error row per unreadable archive, one row without text per file without lines.

    Archives of up to ``inline`` bytes come as Spark read them, from any store that Spark reads.
    Larger ones, whose content Spark then does not load, are streamed from their path, one task
    each; their store must be one that pyarrow opens (local, HDFS, object stores).
    """
    context = ["path", "modificationTime", "ticker", F.col("session_date").cast("date").alias("session_date")]
    large = archives.where(F.col("length") > inline).select(*context)
    schema = T.StructType([*large.schema.fields, *T._parse_datatype_string(ARCHIVE_LINES).fields])
    unzipped = archives.where(F.col("length") <= inline).select(*context, "content").mapInArrow(_unzip_contents, schema)
    streamed = large.mapInArrow(_stream_paths, schema)
    out = unzipped.unionByName(streamed)
    return out.select(
        F.col("ticker").alias("file_ticker"),
        "session_date",
        F.coalesce(F.col("member"), F.element_at(F.split(F.col("path"), "/"), -1)).alias("filename"),
        F.lit(source).alias("source"),
        F.col("line_no").cast("long").alias("line_no"),
        "raw_line", "archive_error",
        F.col("modificationTime").alias("landed_at"), F.col("path").alias("archive"),
    )


def _number_in_split(batches):
    """(path, split, at, value): each line's place from 0 in its split of a file. Spark reads the
    lines of a split in order, and a task its splits one after the other."""
    import numpy as np
    import pyarrow as pa

    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, split = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        code = path.indices.to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (split[1:] != split[:-1])]))
        at = np.arange(batch.num_rows) - np.repeat(new, np.diff(np.append(new, batch.num_rows)))
        if (batch.column(0)[0].as_py(), split[0]) == last:
            at[:new[1] if len(new) > 1 else batch.num_rows] += seen
        last, seen = (batch.column(0)[-1].as_py(), split[-1]), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at), batch.column(2)],
                                         ["path", "split", "at", "value"])


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """Text files below ``root``: their partition columns, ``filename``, ``line_no`` (from 0, in file
    order) and ``raw_line``. Files are read in splits; lines are numbered in their split and the
    lines of the splits before are added, from one row per split, so no line is shuffled."""
    df = spark.read.format("text").load(root)
    more = [c for c in df.columns if c != "value"]
    where = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split")]
    splits = df.select(*where).groupBy("path", "split").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("split")) - F.col("_n")
    splits = splits.withColumn("_before", before).drop("_n")
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("filename"), *more)
    files = files.groupBy("path").agg(F.any_value("filename").alias("filename"), *[F.any_value(c).alias(c) for c in more])
    numbered = df.select(*where, "value").mapInArrow(_number_in_split, "path string, split long, at long, value string")
    # a line whose split was not counted would be a plan that cut the files in two ways
    known = F.coalesce("_before", F.raise_error(F.lit("a split of a text file was not counted")).cast("long"))
    return numbered.join(splits, ["path", "split"], "left").join(files, "path").select(
        *more, "filename", (known + F.col("at")).alias("line_no"), F.col("value").alias("raw_line"))


def read_line_files(spark: SparkSession, root: str, source: str = SOURCE_EOD) -> DataFrame:
    """S3: plain text trade files (no zip) under ``ticker=/session_date=`` folders, one row per
    line with its file and its number in it; line 0 of a file is its header and is dropped."""
    return read_lines(spark, root).where("line_no > 0").select(
        F.col("ticker").alias("file_ticker"), F.col("session_date").cast("date").alias("session_date"), "filename",
        F.lit(source).alias("source"), "line_no", "raw_line")


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "false").load(root))


def stream_archives(spark: SparkSession, root: str, schema, max_files: int = 10_000) -> DataFrame:
    """Streaming scan of newly landed archives (file source keeps offsets in the checkpoint),
    at most ``max_files`` of them in one micro-batch."""
    return (spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", "*.zip").load(root))


def zip_bytes(member: str, lines: list[str], header: str = "DataReferencia;CodigoInstrumento") -> bytes:
    """Build one archive (used to land test files)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(member, "\n".join([header, *lines]))
    return buf.getvalue()


def _uri(root: str) -> str:
    return "file://" + root[len("file:"):] if root.startswith("file:") and not root.startswith("file://") else root


def land_archives(lines: DataFrame, root: str) -> DataFrame:
    """Write trade lines as landed archives: one zip per file, as the exchange serves them,
    under ``root/ticker=/session_date=``. Written through pyarrow's filesystem layer, so
    ``root`` may be any shared filesystem URI. Returns one row per archive (path, lines)."""
    uri = _uri(root)

    def write(key, table):
        import posixpath

        import pyarrow as pa
        import pyarrow.fs as pafs
        fs, base = pafs.FileSystem.from_uri(uri)
        ticker, session_date, filename = (k.as_py() for k in key)
        folder = posixpath.join(base, f"ticker={ticker}", f"session_date={session_date}")
        fs.create_dir(folder, recursive=True)
        name = f"{filename.rsplit('.', 1)[0]}.zip"
        path = posixpath.join(folder, name)
        lines = table.sort_by([("line_no", "ascending"), ("raw_line", "ascending")])["raw_line"]
        with fs.open_output_stream(path) as out:
            out.write(zip_bytes(filename, lines.to_pylist()))
        return pa.table({"path": [path], "lines": pa.array([len(lines)], pa.int64())})

    files = lines.select("file_ticker", F.col("session_date").cast("string").alias("session_date"),
                         "filename", "line_no", "raw_line")
    return files.groupBy("file_ticker", "session_date", "filename").applyInArrow(
        write, schema="path string, lines long")
