"""Delimited records whose quoted fields hold line breaks, read in parallel.

A split of a file does not know whether it starts inside a quoted field. So
every split is read under both assumptions at once:

1. the lines of a split are scanned with both states carried along (a line is
   scanned once per state, and not at all when it holds no quote); what a split
   makes of either state is one row of two bits;
2. those rows are chained in file order: a split maps the state to itself, to
   the other one, or to a fixed one, so the state at its start follows from the
   last split with a fixed result and the number of flips since - two running
   aggregates over the table of splits, no loop;
3. lines then know their true state; a line outside quotes starts a record. A
   record of one line stays where it is; only lines of longer records, and the
   first and last ones of a split, are grouped and joined.

A quoted field starts with the quote directly after a separator, and ends at a
quote that is not escaped; what follows it up to the next separator is taken as
it stands. A quote that is never closed makes the rest of its file one record.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.joins import lookup_join
from tessera.session import scratch_path


def line_scanner(sep: str, escape: str):
    """``after(line, inside)``: whether the line ends inside a quoted field."""
    if escape == '"':
        close = re.compile(r'(?:[^"]|"")*+"')
    else:
        e = re.escape(escape)
        close = re.compile(rf'(?:[^"{e}]|{e}.)*+"', re.S)

    def after(line: str, inside: bool) -> bool:
        if '"' not in line:
            return inside
        at = 0
        while True:
            if inside:
                end = close.match(line, at)
                if end is None:
                    return True
                at = end.end()
            elif line.startswith('"', at):
                at, inside = at + 1, True
                continue
            at = line.find(sep, at)
            if at < 0:
                return False
            at, inside = at + len(sep), False

    return after


def quoted_records(spark: SparkSession, path: str, sep: str, escape: str) -> DataFrame:
    """``(_f, _b, _m, record)``: the records that are not blank, with their file, the
    start of the split in which they begin, and their place among its records."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_f"),
                         F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_l"))

    def scan(batches):
        after, split, low, high = line_scanner(sep, escape), None, False, True
        for batch in batches:
            value, file, block, _ = (batch.column(batch.schema.get_field_index(c)) for c in ("value", "_f", "_b", "_l"))
            states = []
            for line, f, b in zip(value.to_pylist(), file.to_pylist(), block.to_pylist()):
                if (f, b) != split:
                    split, low, high = (f, b), False, True
                before = low + 2 * high
                if '"' in line:
                    same = low == high
                    low = after(line, low)
                    high = low if same else after(line, high)
                states.append(before + 4 * low + 8 * high)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(states, pa.int32())],
                                             names=[*batch.schema.names, "_s"])

    kept = scratch_path(spark, "csv-lines")
    lines.mapInArrow(scan, "value string, _f string, _b long, _l long, _s int").write.parquet(kept)
    lines = spark.read.parquet(kept)

    # the state at the start of each split: one row a split
    ends = lines.groupBy("_f", "_b").agg(F.max_by(F.floor(F.col("_s") / 4), "_l").alias("end"))
    flips, fixed = F.col("end") == 1, F.col("end").isin(0, 3)     # 2 keeps the state
    order = Window.partitionBy("_f").orderBy("_b")
    ends = ends.withColumn("flips", F.sum(flips.cast("long")).over(order))
    last = F.max(F.when(fixed, F.struct("_b", (F.col("end") == 3).cast("long").alias("state"), "flips")))
    ends = ends.withColumn("last", last.over(order.rowsBetween(Window.unboundedPreceding, -1)))
    so_far = F.col("flips") - flips.cast("long") - F.coalesce("last.flips", F.lit(0))
    starts = ends.select("_f", "_b", ((F.coalesce("last.state", F.lit(0)) + so_far) % 2).alias("from"))
    starts_path = scratch_path(spark, "csv-states")
    starts.write.parquet(starts_path)
    starts = spark.read.parquet(starts_path)

    splits = starts.count()
    inside = F.when(F.col("from") == 0, F.col("_s").bitwiseAND(F.lit(1))).otherwise(
        F.shiftright("_s", 1).bitwiseAND(F.lit(1))) == 1
    known = lookup_join(lines, starts, ["_f", "_b"], splits, how="inner")
    known = known.select("_f", "_b", "_l", "value", (~inside).alias("first"))
    known = known.where(~F.col("first") | (F.trim(F.regexp_replace("value", r"\s+", " ")) != ""))
    split = Window.partitionBy("_f", "_b").orderBy("_l")          # one split of a file
    known = (known.withColumn("n", F.sum(F.col("first").cast("long")).over(split))
             .withColumn("alone", F.col("first") & F.coalesce(F.lead("first").over(split), F.lit(False))))
    single = known.where("alone").select("_f", "_b", F.col("n").alias("_m"), F.col("value").alias("record"))

    # lines before a split's first record belong to the last record that began before
    begun = known.groupBy("_f", "_b").agg(F.max("n").alias("n"))
    owner = F.max(F.when(F.col("n") > 0, F.struct("_b", "n"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.select("_f", "_b", owner.alias("owner"))
    rest = lookup_join(known.where("NOT alone"), begun, ["_f", "_b"], splits, how="inner")
    own = F.when(F.col("n") > 0, F.struct("_b", "n")).otherwise(F.col("owner"))
    rest = rest.select("_f", own["_b"].alias("_b"), own["n"].alias("_m"),
                       F.struct(F.col("_b").alias("b"), F.col("_l").alias("l"), "value").alias("line"))
    joined = rest.groupBy("_f", "_b", "_m").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    joined = joined.select("_f", "_b", "_m", F.array_join("lines.value", "\n").alias("record"))
    out = single.unionByName(joined)
    return out.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
