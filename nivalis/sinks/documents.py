"""Documents with fixed names in one folder, and an atomic list of what a run wrote.

A document is text under a name.  Its pieces come as rows (name, seq, text) and
are streamed into the file in order, so a document may be larger than a task's
memory.  A file is written under a name of its own and moved, so a task that
runs again replaces it.  When all files of a run are there, their list (name,
bytes, MD5) is written as a table and made the run's list by moving one small
file; files that only the run's former list names are removed then.  Readers go
by the lists: a file that no list names, or that has changed since, is not a
document (the latter is an error).  A run again with the same rows leaves the
folder as it is.
"""

from __future__ import annotations

import hashlib
import sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.rasters import file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no installed package

LIST_SCHEMA = "name string, n_bytes long, md5 string"
LISTS = "_lists"


class Writer:
    """One document being streamed to its file."""

    def __init__(self, folder: str, name: str):
        self.fs, inner = file_system(folder)
        self.name, self.path, self.own = name, f"{inner}/{name}", f"{inner}/.{uuid.uuid4().hex}"
        self.out, self.size, self.md5 = self.fs.open_output_stream(self.own), 0, hashlib.md5()

    def write(self, text: str) -> None:
        raw = text.encode("utf-8")
        self.out.write(raw)
        self.size += len(raw)
        self.md5.update(raw)

    def close(self) -> tuple[str, int, str]:
        self.out.close()
        self.fs.move(self.own, self.path)
        return self.name, self.size, self.md5.hexdigest()


def write_files(pieces: DataFrame, folder: str) -> DataFrame:
    """Stream the pieces (name, seq, text) into files; name, n_bytes, md5 of each (when the result is read)."""
    def told(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["name", "n_bytes", "md5"])

    def run(batches):
        writer = None
        for batch in batches:
            done = []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                if writer is None or writer.name != name:
                    if writer is not None:
                        done.append(writer.close())
                    writer = Writer(folder, name)
                writer.write(text)
            if done:
                yield told(done)
        if writer is not None:
            yield told([writer.close()])

    return (pieces.select("name", "seq", "text").repartition("name").sortWithinPartitions("name", "seq")
            .mapInArrow(run, LIST_SCHEMA))


def pointer(folder: str, run: str):
    fs, inner = file_system(folder)
    return fs, f"{inner}/{LISTS}/{run}.current"


def listed(spark: SparkSession, folder: str, run: str) -> DataFrame | None:
    """The list of a run's documents, or None where the run has none."""
    from pyarrow import fs as pafs

    fs, at = pointer(folder, run)
    if fs.get_file_info(at).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(at) as f:
        return spark.read.schema(LIST_SCHEMA).parquet(f"{folder}/{LISTS}/{f.read().decode()}")


def write_documents(pieces: DataFrame, folder: str, run: str) -> DataFrame:
    """Write the documents of ``run`` (name, seq, text) below ``folder`` and commit their list, which is returned."""
    spark = pieces.sparkSession
    before = listed(spark, folder, run)
    fs, at = pointer(folder, run)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    own = f"{run}-{uuid.uuid4().hex}"
    write_files(pieces, folder).write.parquet(f"{folder}/{LISTS}/{own}")
    with fs.open_output_stream(f"{at}.{own}") as f:
        f.write(own.encode())
    fs.move(f"{at}.{own}", at)
    now = listed(spark, folder, run)
    if before is not None:
        stale = before.join(now, "name", "left_anti").select("name")

        def remove(batches):
            fs, inner = file_system(folder)
            for batch in batches:
                for name in batch.column("name").to_pylist():
                    fs.delete_file(f"{inner}/{name}")
                yield batch

        stale.mapInArrow(remove, "name string").write.format("noop").mode("overwrite").save()
    return now


def read_documents(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """name, text of a run's documents; a file that differs from the list is an error."""
    names = listed(spark, folder, run)
    if names is None:
        raise ValueError(f"no list of the run {run}")

    def load(batches):
        fs, inner = file_system(folder)
        for batch in batches:
            for name, md5 in zip(batch.column("name").to_pylist(), batch.column("md5").to_pylist()):
                with fs.open_input_stream(f"{inner}/{name}") as f:
                    raw = f.read()
                if hashlib.md5(raw).hexdigest() != md5:
                    raise ValueError(f"{name} has changed since the list of {run} was written")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([raw.decode("utf-8")])], names=["name", "text"])

    return names.select("name", "md5").mapInArrow(load, "name string, text string")


# ------------------------------------------------------------------ statistics
def quoted(col) -> F.Column:
    """JSON text of a string."""
    text = F.to_json(F.array(col))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def number(col) -> F.Column:
    """JSON text of a number, ``"NA"`` where it is missing."""
    return F.coalesce(F.col(col).cast("string"), F.lit('"NA"'))


def zone_properties_json(name_col: str = "n") -> F.Column:
    """``{"HU_10":...,"count":...}`` of a zone's statistics."""
    name = quoted(F.col(name_col))
    return F.concat(F.lit('{"HU_10":'), name, F.lit(',"HU_10_NAME":'), name, F.lit(',"min_inches":'), number("min_inches"),
                    F.lit(',"max_inches":'), number("max_inches"), F.lit(',"mean_inches":'), number("mean_inches"),
                    F.lit(',"count":'), F.col("count").cast("string"), F.lit("}"))


def statistics_json(result: F.Column, warp_seconds: int, stats_seconds: int) -> F.Column:
    """A statistics document around the JSON text of its result."""
    return F.concat(F.lit(f'{{"time_sec_download_warp":{int(warp_seconds)},"time_sec_stats":{int(stats_seconds)},"result":'), result, F.lit("}"))


def statistics_pieces(stats: DataFrame, product: str, first: str, last: str, warp_seconds: int, stats_seconds: int) -> DataFrame:
    """Pieces of all documents of a run, from statistics (day date, n, min_inches, max_inches, mean_inches, count) per day and zone.

    One per day, one for the whole run, whose days are streamed one by one, and
    one per (basin, file of the product).  Days hold an entry per zone, so a
    piece is bounded by the zone catalog.
    """
    entry = F.concat(quoted(F.col("n")), F.lit(":"), zone_properties_json())
    days = stats.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("n", entry.alias("e")))).alias("es"))
    body = statistics_json(F.concat(F.lit("{"), F.array_join(F.transform("es", lambda e: e["e"]), ","), F.lit("}")), warp_seconds, stats_seconds)
    days = days.select("day", body.alias("text"))
    per_day = days.select(F.concat(F.lit(f"statistics__{product}__"), F.date_format("day", "yyyyMMdd"), F.lit(".json")).alias("name"),
                          F.lit(0).alias("seq"), "text")
    run = F.lit(f"statistics__{product}__{first}_to_{last}.json")
    least = days.agg(F.min("day")).scalar()
    opening = F.when(F.col("day") == least, F.lit("{")).otherwise(F.lit(","))
    per_run = days.select(run.alias("name"), F.datediff("day", F.lit("1970-01-01").cast("date")).alias("seq"),
                          F.concat(opening, F.lit('"'), F.date_format("day", "yyyy_MM_dd"), F.lit('":'), "text").alias("text"))
    end = stats.sparkSession.range(1).select(run.alias("name"), F.lit(2**31 - 1).alias("seq"),
                                             F.when(least.isNull(), F.lit("{}")).otherwise(F.lit("}")).alias("text"))
    basin = F.lower(F.replace(F.col("n"), F.lit(" "), F.lit("")))
    per_basin = stats.select(
        F.concat(F.lit("statistics__"), basin, F.lit(f"__{product}__"), F.date_format("day", "yyyyMMdd-HHmmss"), F.lit(".json")).alias("name"),
        F.lit(0).alias("seq"), statistics_json(F.concat(F.lit("["), zone_properties_json(), F.lit("]")), warp_seconds, stats_seconds).alias("text"))
    return per_day.unionByName(per_run).unionByName(end).unionByName(per_basin)


ZONE = "struct<HU_10:string, HU_10_NAME:string, min_inches:string, max_inches:string, mean_inches:string, count:bigint>"
TIMES = "time_sec_download_warp:bigint, time_sec_stats:bigint"


def zone_columns(z: str) -> list[F.Column]:
    """Columns of a parsed zone entry, "NA" as null."""
    return [F.col(f"{z}.{c}").try_cast("double").alias(c) for c in ("min_inches", "max_inches", "mean_inches")] + [F.col(f"{z}.count").alias("count")]
