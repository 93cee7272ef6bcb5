"""Delimited text in and out (distributed; no single-file assumption).

Reading:
1. Spark's CSV reader parses the text once, every field as STRING (no
   ``inferSchema`` pass, blank lines skipped, an empty field is NULL in its own
   position); the rows are written to the shared folder with their file, split
   and place, so later jobs do not depend on how a scan is split;
2. ``row_id`` is the row's position in file order (numbers in file names count
   as numbers), from per-split counts - no global window over rows;
3. a first line is a header iff it is the same in every file and none of its
   fields is numeric or a missing token;
4. type inference is one aggregate: a column is numeric iff every non-missing
   value casts to DOUBLE (an all-missing column is numeric);
5. one projection applies ``try_cast`` / token normalisation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.missing import MISSING_TOKENS, is_missing_token, normalise_string, parse_double
from tessera.plans.joins import lookup_join
from tessera.session import scratch_path
from tessera.sources.records import quoted_records


@dataclass
class CsvTable:
    df: DataFrame              # row_id BIGINT + DOUBLE / STRING columns
    numeric: list[str]
    strings: list[str]
    header: bool


def natural_order(path: Column) -> Column:
    """A path with every run of digits padded to 20, so that part-100000 stands
    after part-10001."""
    padded = F.regexp_replace(path, r"([0-9]+)", "00000000000000000000$1")
    return F.regexp_replace(padded, r"0+([0-9]{20})(?![0-9])", "$1")


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool | None = None,
             names: list[str] | None = None, multi_line: bool = False, escape: str = "\\") -> CsvTable:
    """Load delimited text with inferred header and column types. Quoted line
    breaks need ``multi_line`` (splits are then parsed under both quote states,
    see ``records``). ``escape``: what stands before a quote inside quotes; a
    quote itself for doubled quotes."""
    options = {"sep": sep, "escape": escape, "multiLine": str(multi_line).lower(), "mode": "PERMISSIVE"}
    raw = spark.read.options(**options).option("header", False).option("inferSchema", False).csv(path)
    cols = raw.columns                                  # of the first record
    kept = scratch_path(spark, "csv")
    if multi_line:
        records = quoted_records(spark, path, sep, escape)
        fields = F.from_csv("record", F.lit(", ".join(f"`{c}` string" for c in cols)), options)
        records.select("_f", "_b", "_m", fields.alias("_r")).select("_r.*", "_f", "_b", "_m").write.parquet(kept)
    else:
        raw.select(*cols, F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                   F.monotonically_increasing_id().alias("_m")).write.parquet(kept)
    d = spark.read.parquet(kept)
    # one row per split of the parse; the first split with rows starts its file
    line = F.struct(*[F.col(c) for c in cols])
    splits = d.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"),
                                       F.min_by(line, "_m").alias("_line"))
    splits = splits.withColumn("_first", F.col("_b") == F.min("_b").over(Window.partitionBy("_f")))
    same = splits.where("_first").agg(F.min("_line").alias("lo"), F.max("_line").alias("hi")).first()
    first = same["lo"]
    if header is None:
        header = first is not None and same["lo"] == same["hi"] and not any(_is_num_or_missing_py(first[c]) for c in cols)
    header = bool(header)
    skip = (F.col("_first") & F.lit(header)).cast("long")
    w = Window.orderBy(natural_order(F.col("_f")), "_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.select("_f", "_b", "_m0", skip.alias("_skip"),
                         F.coalesce(F.sum(F.col("_n") - skip).over(w), F.lit(0)).alias("_off"))
    offs_path = scratch_path(spark, "csv-splits")
    offs.write.parquet(offs_path)
    offs = spark.read.parquet(offs_path)
    j = lookup_join(d, offs, ["_f", "_b"], offs.count(), how="left")
    place = F.when(F.col("_off").isNull(), F.raise_error(F.lit("a split of the text has no offset"))).otherwise(
        F.col("_off") + F.col("_m") - F.col("_m0") - F.col("_skip"))
    d = j.where((F.col("_m") - F.col("_m0") >= F.col("_skip")) | F.col("_off").isNull()).withColumn("row_id", place)
    if header and first is not None:
        names = names or [str(first[c]).strip() for c in cols]
    names = names or [f"c{i}" for i in range(len(cols))]
    aggs = []
    for i, c in enumerate(cols):
        present = ~(F.col(c).isNull() | is_missing_token(F.col(c)))
        aggs += [F.count_if(present).alias(f"_p{i}"),
                 F.count_if(present & F.col(c).try_cast("double").isNotNull()).alias(f"_q{i}")]
    counts = d.agg(*aggs).first()
    numeric = [n for i, n in enumerate(names) if counts[f"_p{i}"] == counts[f"_q{i}"]]
    strings = [n for n in names if n not in numeric]
    out = d.select("row_id", *[(parse_double(F.col(c)) if n in numeric else normalise_string(F.col(c))).alias(n)
                               for c, n in zip(cols, names)])
    return CsvTable(out, numeric, strings, header)


_MISSING = set(MISSING_TOKENS) | {""}


def _is_num_or_missing_py(v) -> bool:
    if v is None or v in _MISSING:
        return True
    try:
        float(v.replace("_", "x"))
        return True
    except ValueError:
        return False


def make_csv(df: DataFrame, path: str, numeric: list[str], strings: list[str] | None = None,
             sep: str = ",", order_by: str | None = "row_id") -> None:
    """Write a header line and the numeric columns as ``%.6f`` (missing as
    ``nan``); string columns are written too when given. Rows are written in
    ``order_by`` order (a distributed range sort, part files in order). Strings
    keep their blanks; one with a line break is refused."""
    strings = strings or []
    cols = []
    for c in df.columns:
        if c in numeric:
            x = F.col(c).cast("double")
            cols.append(F.when(x.isNull(), F.lit("nan")).otherwise(F.format_string("%.6f", x)).alias(c))
        elif c in strings:
            broken = F.when(F.col(c).rlike(r"[\r\n]"), F.raise_error(F.lit(f"a line break in column {c}")))
            cols.append(F.coalesce(broken.otherwise(F.col(c)), F.lit("nan")).alias(c))
    src = df.orderBy(order_by) if order_by else df
    (src.select(*cols).write.mode("overwrite").option("sep", sep).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


__all__ = ["read_csv", "make_csv", "CsvTable"]
