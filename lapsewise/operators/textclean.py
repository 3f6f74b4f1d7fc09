"""Cleaning header-less delimited text files, many files in one job.

Per file the job infers a *profile* and then cleans every line with it:

* preamble: the leading lines that are blank or start with ``---`` / ``#``
  (after stripping); the first other line is the first data line.  Later
  lines of that kind are data.
* delimiter: among the candidates, those that split the first data line and
  the raw line right after it into the same number of fields; the largest
  count wins, earlier candidates win ties, the fallback applies when none
  agrees.  With a single data line the second line is empty (one field).
* columns: named from the field count of the first data line.
* rows: stripped non-blank lines after the preamble, split on the literal
  delimiter; rows with another field count are rejected (kept, with the
  counts, in a reject table); fields are stripped; ``product_id`` is
  lower-cased.

Line order comes from the scan (file, split start, position), assigned
before any shuffle.  The profile is found with grouped ``min`` aggregates
(partial, map-side), so a single huge file is never gathered in one task;
profiles (one small row per file) are joined back and AQE broadcasts them
when their measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.functions.text import field_count, is_preamble_line, py_strip, split_literal
from lapsewise.session import materialize, run_concurrently
from lapsewise.sources.csvsink import csv_line, write_lines
from lapsewise.sources.files import require_inputs, with_file_order

# Candidate delimiters in priority order, and the fallback.
CANDIDATE_DELIMITERS = ["|", ",", "\t", ";"]
FALLBACK_DELIMITER = ","

# Column names by field count; other counts get column_1..n.
COLUMN_NAMES = {
    3: ["product_id", "product_name", "status"],
    4: ["product_id", "product_name", "tier", "status"],
    5: ["product_id", "product_name", "tier", "status", "effective_date"],
}

ID_COLUMN = "product_id"
_KEY = ["_split", "_pos"]


def read_lines(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Lines of every file under ``path`` with their position in the file."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    raw = with_file_order(reader.text(path))
    return raw.select(
        "_file", "_split", "_pos", F.col("value").alias("line"),
        py_strip("value").alias("_stripped"),
    )


def _key():
    return F.struct(*[F.col(c) for c in _KEY])


def file_profiles(lines: DataFrame) -> DataFrame:
    """One row per file that has data lines.

    Columns: ``_file``, ``skip_lines``, ``delimiter``, ``n_columns``,
    ``columns``, ``data_rows`` / ``clean_rows`` / ``rejected_rows`` (the
    read-versus-kept reconciliation, counted in the same aggregation) and
    ``_first`` (position of the first data line).
    """
    first = (
        lines.where(~is_preamble_line(F.col("_stripped")))
        .groupBy("_file")
        .agg(F.min(F.struct(_key().alias("k"), F.col("_stripped").alias("s"))).alias("_f"))
        .select("_file", F.col("_f.k").alias("_first"), F.col("_f.s").alias("_line1"))
    )
    # written (one row a file): its size is known, so the lines are joined to it
    # where they are, without a shuffle of the text by file
    first = materialize(first, "first_lines")
    is_data = (_key() >= F.col("_first")) & (F.col("_stripped") != F.lit(""))
    after = (
        lines.join(first, "_file")
        .groupBy("_file", "_first", "_line1")
        .agg(
            F.count_if(_key() < F.col("_first")).alias("skip_lines"),
            F.min(
                F.when(
                    _key() > F.col("_first"),
                    F.struct(_key().alias("k"), F.col("_stripped").alias("s")),
                )
            ).alias("_next"),
            # row counts for every candidate delimiter, in the same pass
            F.count_if(is_data).alias("data_rows"),
            *[
                F.count_if(
                    is_data & (field_count("_stripped", d) == field_count("_line1", d))
                ).alias(f"_fit{i}")
                for i, d in enumerate(CANDIDATE_DELIMITERS)
            ],
            F.count_if(
                is_data
                & (field_count("_stripped", FALLBACK_DELIMITER) == field_count("_line1", FALLBACK_DELIMITER))
            ).alias("_fit_fallback"),
        )
    )
    line1 = F.col("_line1")
    line2 = F.coalesce(F.col("_next.s"), F.lit(""))
    votes = F.array(
        *[
            F.struct(
                F.when(
                    field_count(line1, d) == field_count(line2, d), field_count(line1, d)
                ).otherwise(F.lit(0)).alias("score"),
                F.lit(-i).alias("priority"),
                F.lit(d).alias("delimiter"),
            )
            for i, d in enumerate(CANDIDATE_DELIMITERS)
        ]
    )
    best = F.array_max(votes)
    delim = F.when(best["score"] > 0, best["delimiter"]).otherwise(F.lit(FALLBACK_DELIMITER))
    fits = F.when(best["score"] <= 0, F.col("_fit_fallback"))
    for i, d in enumerate(CANDIDATE_DELIMITERS):
        fits = fits.when(best["delimiter"] == F.lit(d), F.col(f"_fit{i}"))
    prof = after.select(
        "_file", "_first", "_line1", "skip_lines", delim.alias("delimiter"),
        "data_rows", fits.alias("clean_rows"),
    )
    n = field_count(F.col("_line1"), F.col("delimiter"))
    named = None
    for count, names in COLUMN_NAMES.items():
        arr = F.array(*[F.lit(x) for x in names])
        named = F.when(F.col("n_columns") == count, arr) if named is None else named.when(
            F.col("n_columns") == count, arr
        )
    generic = F.transform(
        F.sequence(F.lit(1), F.col("n_columns")), lambda i: F.concat(F.lit("column_"), i.cast("string"))
    )
    return prof.withColumn("n_columns", n).select(
        "_file",
        "skip_lines",
        "delimiter",
        "n_columns",
        named.otherwise(generic).alias("columns"),
        "data_rows",
        "clean_rows",
        (F.col("data_rows") - F.col("clean_rows")).alias("rejected_rows"),
        "_first",
    )


def split_rows(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """Data lines split with their file's delimiter, with the profile attached."""
    data = lines.join(profiles, "_file").where(
        (_key() >= F.col("_first")) & (F.col("_stripped") != F.lit(""))
    )
    return data.select(
        "_file", "_split", "_pos", "line",
        split_literal(F.col("_stripped"), F.col("delimiter")).alias("_fields"),
        "n_columns", "columns", "delimiter",
    )


def clean_fields(rows: DataFrame) -> DataFrame:
    """Rows of the expected width: fields stripped, ``product_id`` lower-cased."""
    good = rows.where(F.size("_fields") == F.col("n_columns"))
    id_pos = F.array_position(F.col("columns"), ID_COLUMN) - 1
    fields = F.transform(
        F.col("_fields"),
        lambda x, i: F.when(i == id_pos, F.lower(py_strip(x))).otherwise(py_strip(x)),
    )
    return good.select("_file", "_split", "_pos", "columns", fields.alias("fields"))


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows whose field count differs from the file's column count."""
    return rows.where(F.size("_fields") != F.col("n_columns")).select(
        "_file", "_split", "_pos",
        F.col("n_columns").alias("expected_fields"),
        F.size("_fields").alias("got_fields"),
        F.col("line").alias("data"),
    )


def empty_files(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """Files with no data line at all (only preamble or blank lines)."""
    return lines.select("_file").distinct().join(profiles.select("_file"), "_file", "left_anti")


def to_table(clean: DataFrame, columns: list[str]) -> DataFrame:
    """Fields of rows with the given column layout as named string columns."""
    same = clean.where(F.col("columns") == F.array(*[F.lit(c) for c in columns]))
    return same.select(
        "_file", "_split", "_pos",
        *[F.col("fields")[i].alias(c) for i, c in enumerate(columns)],
    )


def csv_text(fields):
    """An array of fields as a CSV line: quoted where needed, quotes doubled."""
    quote = F.lit('"')
    return F.array_join(F.transform(fields, lambda x: F.when(
        x.rlike('[",\r\n]'), F.concat(quote, F.replace(x, quote, F.lit('""')), quote)).otherwise(x)), ",")


def csv_lines(clean: DataFrame, layouts: list[list[str]]) -> DataFrame:
    """All clean rows as (layout, key, part, line) for the CSV sink, in the order of their file.

    A scan task has the lines of a file's split in order, and the part file is named by where the
    split starts, so the text needs no shuffle; the sort inside a task restores the order if the
    profiles were too many to be broadcast.
    """
    number = F.lit(-1)
    for i, columns in enumerate(layouts):
        number = F.when(F.size("columns") == len(columns), F.lit(i)).otherwise(number)
    ordered = clean.sortWithinPartitions("_file", "_split", "_pos")
    return ordered.select(
        number.alias("layout"), F.col("_file").alias("key"), F.lpad(F.col("_split").cast("string"), 20, "0").alias("part"),
        csv_text(F.col("fields")).alias("line"))


def silent_files(spark: SparkSession, src: str, profiles: DataFrame) -> DataFrame:
    """Files under ``src`` without a data line, those without any byte included.

    A scan skips files without bytes, so the names come from the listing that Spark
    makes for it anyway.
    """
    names = spark.read.option("recursiveFileLookup", "true").text(src).inputFiles()
    listed = spark.createDataFrame([(n,) for n in names], "_file string").withColumn("_k", _path_key("_file"))
    told = profiles.select(_path_key("_file").alias("_k"))
    return listed.join(told, "_k", "left_anti").drop("_k")


def _path_key(c: str):
    """A file name whatever the number of slashes after its scheme."""
    return F.regexp_replace(F.col(c), "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _rejects_of(spark: SparkSession, src: str, rows: DataFrame, ragged: DataFrame) -> DataFrame:
    if ragged.isEmpty():
        return rejected_rows(rows).where("false")
    return rejected_rows(split_rows(read_lines(spark, src), ragged))


def clean_files(spark: SparkSession, src: str, out: str) -> dict[str, DataFrame]:
    """Clean every file under ``src``; write CSV with header per source file.

    Output: ``out/layout_<n>/_source=<file>/part-*.csv`` (one folder per input
    file, rows in input order over its parts by name, CSV quoting of Python's csv module: doubled
    quotes, CRLF line ends), ``out/rejects`` (rows of the wrong width) and
    ``out/empty_files``.  A run replaces all of the earlier output, so a file
    whose layout changed or that is gone leaves nothing behind.  Returns profiles and
    the written rejects and empty files.  A folder without any file is an error.
    """
    from lapsewise.operators.loading import hadoop_fs

    require_inputs(spark, [src])
    lines = read_lines(spark, src)
    # one small row per file, reused by every write below: computed once
    profiles = materialize(file_profiles(lines), "file_profiles")
    rows = split_rows(lines, profiles)
    clean = clean_fields(rows)
    # few distinct layouts (one per column count): a tiny collect
    layouts = sorted((r.columns for r in profiles.select("columns").distinct().collect()), key=len)
    base = out.rstrip("/")

    def write_report(name, df):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/{name}")

    # the earlier output
    fs, folder = hadoop_fs(spark, base)
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            if status.getPath().getName().startswith("layout_"):
                fs.delete(status.getPath(), True)
    prefixes = [(f"layout_{len(c)}/_source=", csv_line(c)) for c in layouts]
    # only files that have rows of another width are read for the report on them
    ragged = materialize(profiles.where("rejected_rows > 0"), "ragged_files")
    run_concurrently(
        lambda: write_lines(csv_lines(clean, layouts), str(fs.makeQualified(folder).toString()), prefixes, line_end="\r\n")
        if layouts else None,
        lambda: write_report("rejects", _rejects_of(spark, src, rows, ragged)),
        lambda: write_report("empty_files", silent_files(spark, src, profiles)),
    )
    return {
        "profiles": profiles,
        "rejects": spark.read.parquet(f"{base}/rejects"),
        "empty_files": spark.read.parquet(f"{base}/empty_files"),
    }
