"""Stand-in grid, zone, notice, band, registry and header views over the driver tables.

The driver's tables hold no rasters, so the inputs of every operator are
derived from them (see FIXTURES.md part B).  Each view exists twice: as a
Spark DataFrame built with the DataFrame API, and as DuckDB SQL text that the
oracle queries inline as CTEs.  The two are written independently.

Scale notes: ``v_cells`` is an aggregation of ``lineitem`` onto a 64 x 64
lattice per ship month, so it is bounded by months x 4096 whatever the size
of ``lineitem``.  The dense lattice is generated per month from the (bounded,
at most 64-entry) row and column sets of the grid definition, which are read
once and stand in the plans as literals.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import scratch_path, table

# Fixed values of the fixture definition.
LATTICE = 64            # rows = columns of the stand-in grid
NODATA = -9999.0        # in-band sentinel of raw grids
BAND_ROWS = 500_000     # rows of lineitem that a task groups to bands


def epoch_seconds_ntz(col):
    """Seconds since 1970 of a TIMESTAMP_NTZ column, independent of the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * 86400
        + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    )


class Fixtures:
    """Lazily built stand-in views for one (session, scale-factor directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ grids
    @cached_property
    def cells(self) -> DataFrame:
        li = self.t("lineitem")
        g = li.groupBy(
            (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int").alias("t"),
            (F.col("l_orderkey") % LATTICE).cast("int").alias("r"),
            (F.col("l_partkey") % LATTICE).cast("int").alias("c"),
        ).agg(
            F.sum("l_linenumber").alias("sum_line"),
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_suppkey").alias("sum_supp"),
        )
        return g.select(
            "t", "r", "c",
            F.when(F.col("sum_line") % 7 == 0, F.lit(0.0)).otherwise(F.col("sum_qty"))
            .cast("double").alias("swe"),
            (F.lit(255) + (F.col("sum_line") * 7 + F.col("r") + F.col("c")) % 40)
            .cast("double").alias("temp_k"),
            F.col("sum_supp").cast("double").alias("melt"),
            F.when(F.col("sum_line") % 7 == 0, F.lit(0.0)).otherwise(F.col("sum_qty") * 3 + F.col("sum_line"))
            .cast("double").alias("depth"),
        )

    @cached_property
    def grid_def(self):
        """Sorted row set and column set of the lattice (at most 64 entries each) and the months with cells.

        Read from the tables once and small by definition, so plans hold them
        as literals instead of scanning the lines again for each use.
        """
        li = self.t("lineitem")
        return li.agg(
            F.sort_array(F.collect_set((F.col("l_orderkey") % LATTICE).cast("int"))).alias("rows"),
            F.sort_array(F.collect_set((F.col("l_partkey") % LATTICE).cast("int"))).alias("cols"),
            F.sort_array(F.collect_set((F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int"))).alias("months"),
        ).first()

    @staticmethod
    def _literal(values):
        return F.array(*[F.lit(int(v)) for v in values]).cast("array<int>")

    def _rows(self):
        return self._literal(self.grid_def.rows)

    def _cols(self):
        return self._literal(self.grid_def.cols)

    @cached_property
    def times(self) -> DataFrame:
        months = ", ".join(f"({int(t)})" for t in self.grid_def.months)
        return self.spark.sql(f"select t from values {months or '(0)'} as v(t)" + ("" if months else " where false"))

    @cached_property
    def lattice(self) -> DataFrame:
        return (
            self.times.select("t", F.explode(self._rows()).alias("r"))
            .select("t", "r", F.explode(self._cols()).alias("c"))
        )

    @cached_property
    def grid(self) -> DataFrame:
        """Dense raw grid with the -9999 sentinel (``v_grid``)."""
        x = self.cells.withColumn("hit", F.lit(True)).alias("x")
        l = self.lattice.alias("l")
        j = l.join(x, on=["t", "r", "c"], how="left")
        missing = F.col("x.hit").isNull()
        r, c = F.col("r"), F.col("c")
        return j.select(
            "t", "r", "c",
            F.when(missing | ((r * 5 + c * 3) % 16 == 0), F.lit(NODATA)).otherwise(F.col("x.swe")).alias("swe"),
            F.when(missing | ((r * 7 + c * 13) % 16 == 0), F.lit(NODATA)).otherwise(F.col("x.temp_k")).alias("temp_k"),
            F.when(missing, F.lit(NODATA)).otherwise(F.col("x.melt")).alias("melt"),
            F.when(missing | ((r * 3 + c * 7) % 16 == 0), F.lit(NODATA)).otherwise(F.col("x.depth")).alias("depth"),
        )

    @cached_property
    def mask(self) -> DataFrame:
        """Water-body mask on the lattice (``v_mask``)."""
        rc = (
            self.spark.range(1)
            .select(F.explode(self._rows()).alias("r"))
            .select("r", F.explode(self._cols()).alias("c"))
        )
        return rc.select(
            "r", "c",
            F.when((F.col("r") + 2 * F.col("c")) % 5 == 0, F.lit(NODATA)).otherwise(F.lit(0.0)).alias("m"),
        )

    # ------------------------------------------------------------------ zones
    @cached_property
    def zones(self) -> DataFrame:
        """25 triangles, one row per vertex (``v_zone``): z, n, i, x, y."""
        nat = self.t("nation").select(
            F.col("n_nationkey").alias("z"), F.col("n_name").alias("n"),
            ((F.col("n_nationkey") % 5) * 12.3 + 0.25).alias("x0"),
            (((F.col("n_nationkey") - F.col("n_nationkey") % 5) / 5) * 12.1 + 0.35).alias("y0"),
        )
        q = nat.select("*", F.explode(self._rows()).alias("i")).where(F.col("i") < 3)
        i = F.col("i")
        dx = F.when(i == 0, 0.0).when(i == 1, 11.7).otherwise(5.2)
        dy = F.when(i == 0, 0.0).when(i == 1, 1.3).otherwise(10.9)
        return q.select("z", "n", "i", (F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))

    # ---------------------------------------------------------------- records
    @cached_property
    def notice(self) -> DataFrame:
        """Object keys with URL escapes (``v_notice``)."""
        return self.notice_of(self.t("events"))

    @staticmethod
    def notice_of(ev: DataFrame) -> DataFrame:
        """``v_notice`` rows for an events relation (batch or stream)."""
        return ev.select(
            "event_id", "ts",
            F.concat(
                F.lit("obs/"), F.col("event_type"), F.lit("/F+"), F.col("event_id").cast("string"),
                F.lit("%5F"), F.col("user_id").cast("string"), F.lit(".grib2.gz"),
            ).alias("object_key"),
        )

    @cached_property
    def acquirable(self) -> DataFrame:
        """Catalog of valid acquirables: every event type except ``error``.

        Written as a table of its own, as a catalog is: the planner sees its
        true size and joins the notices to it without a shuffle.
        """
        path = scratch_path(self.spark, "acquirable")
        rows = self.t("events").select(F.col("event_type").alias("name")).where(F.col("name") != "error").distinct()
        rows.coalesce(1).write.parquet(path)
        return self.spark.read.schema("name string").parquet(path)

    @cached_property
    def band(self) -> DataFrame:
        """Band inventory, one file per order (``v_band``); the bands of a file lie in one partition.

        The partitions follow the rows of the table, so what a task holds does
        not grow with it, and grouping by file needs no further shuffle.  Flags
        are ranked in their order: groups of numbers are hashed, those of texts
        are sorted with all their rows.
        """
        li = self.t("lineitem")
        flag = F.col("l_returnflag")
        rank = (F.when(flag < "A", 0).when(flag == "A", 1).when(flag < "N", 2).when(flag == "N", 3)
                .when(flag.isNotNull(), 4))
        rows = li.select(
            F.col("l_orderkey").alias("file_id"), F.col("l_linenumber").alias("band"),
            rank.alias("rf"), epoch_seconds_ntz("l_shipdate").alias("ep"),
        )
        g = rows.repartition(1 + li.count() // BAND_ROWS, "file_id").groupBy("file_id", "band").agg(
            F.min("rf").alias("rf"), F.min("ep").alias("ep"))
        return g.select(
            "file_id", "band",
            F.when(F.col("rf") == 1, "Total precipitation [kg/(m^2)]")
            .when(F.col("rf") == 3, "Temperature [C]")
            .otherwise("Wind speed [m/s]").alias("comment"),
            F.concat(F.col("ep").cast("string"), F.lit(" sec UTC")).alias("valid_time"),
        )

    @cached_property
    def productfile(self) -> DataFrame:
        """Registry candidates (``v_productfile``)."""
        return self.productfile_of(self.t("orders"))

    @staticmethod
    def productfile_of(o: DataFrame) -> DataFrame:
        """``v_productfile`` rows for an orders relation (batch or stream)."""
        return o.select(
            F.col("o_orderkey").alias("file_id"),
            (F.col("o_custkey") % 10).cast("int").alias("product_id"),
            F.col("o_orderdate").alias("datetime"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
            .otherwise(F.col("o_orderpriority")).alias("version"),
        )

    @cached_property
    def header(self) -> DataFrame:
        """Header text, one per order month (``v_header``)."""
        o = self.t("orders")
        early = F.col("o_orderdate") < F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
        content = F.concat(
            F.lit("Format version: 1\nNumber of columns: "),
            F.when(early, "6935").otherwise("8192"),
            F.lit("\nNumber of rows: "),
            F.when(early, "3351").otherwise("4096"),
            F.lit("\nNo data value: -9999\n"),
        )
        return o.select(
            (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("t"),
            content.alias("content")
        ).distinct()

    @cached_property
    def shifted_dates(self) -> DataFrame:
        """Distinct order dates moved 14 years forward (2009 .. 2015)."""
        o = self.t("orders")
        return o.select(
            F.add_months(F.to_date("o_orderdate"), 14 * 12).alias("d")
        ).distinct()


# --------------------------------------------------------------------- DuckDB
# View text from FIXTURES.md part B, for the oracle side.  Order matters.
_SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_cells": ((), """
select cast(year(l_shipdate)*100 + month(l_shipdate) as int) as t,
       cast(l_orderkey % 64 as int) as r, cast(l_partkey % 64 as int) as c,
       cast(case when sum(l_linenumber) % 7 = 0 then 0 else sum(l_quantity) end as double) as swe,
       cast(255 + (sum(l_linenumber)*7 + l_orderkey % 64 + l_partkey % 64) % 40 as double) as temp_k,
       cast(sum(l_suppkey) as double) as melt,
       cast(case when sum(l_linenumber) % 7 = 0 then 0 else sum(l_quantity) * 3 + sum(l_linenumber) end as double) as depth
from lineitem
group by year(l_shipdate)*100 + month(l_shipdate), l_orderkey % 64, l_partkey % 64"""),
    "v_lattice": (("v_cells",), """
select t.t, r.r, c.c
from (select distinct t from v_cells) t
cross join (select distinct cast(l_orderkey % 64 as int) as r from lineitem) r
cross join (select distinct cast(l_partkey % 64 as int) as c from lineitem) c"""),
    "v_grid": (("v_lattice", "v_cells"), """
select l.t, l.r, l.c,
       case when x.t is null or (l.r*5 + l.c*3) % 16 = 0 then -9999.0e0 else x.swe end as swe,
       case when x.t is null or (l.r*7 + l.c*13) % 16 = 0 then -9999.0e0 else x.temp_k end as temp_k,
       case when x.t is null then -9999.0e0 else x.melt end as melt,
       case when x.t is null or (l.r*3 + l.c*7) % 16 = 0 then -9999.0e0 else x.depth end as depth
from v_lattice l left join v_cells x on l.t = x.t and l.r = x.r and l.c = x.c"""),
    "v_mask": (("v_lattice",), """
select distinct r, c, case when (r + 2*c) % 5 = 0 then -9999.0e0 else 0.0e0 end as m from v_lattice"""),
    "v_zone": (("v_lattice",), """
select z, n, i,
       x0 + case i when 0 then 0.0e0 when 1 then 11.7e0 else 5.2e0 end as x,
       y0 + case i when 0 then 0.0e0 when 1 then 1.3e0 else 10.9e0 end as y
from (select n_nationkey as z, n_name as n, (n_nationkey % 5)*12.3e0 + 0.25e0 as x0,
             ((n_nationkey - n_nationkey % 5)/5)*12.1e0 + 0.35e0 as y0 from nation) q
cross join (select distinct r as i from v_lattice where r < 3) k"""),
    "v_notice": ((), """
select event_id, ts, concat('obs/', event_type, '/F+', cast(event_id as varchar(20)), '%5F',
       cast(user_id as varchar(20)), '.grib2.gz') as object_key
from events"""),
    "v_band": ((), """
select l_orderkey as file_id, l_linenumber as band,
       case min(l_returnflag) when 'A' then 'Total precipitation [kg/(m^2)]'
            when 'N' then 'Temperature [C]' else 'Wind speed [m/s]' end as comment,
       concat(cast(min(cast(epoch(l_shipdate) as bigint)) as varchar(20)), ' sec UTC') as valid_time
from lineitem group by l_orderkey, l_linenumber"""),
    "v_productfile": ((), """
select o_orderkey as file_id, cast(o_custkey % 10 as int) as product_id, o_orderdate as datetime,
       case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as version
from orders"""),
    "v_header": ((), """
select distinct year(o_orderdate)*100 + month(o_orderdate) as t,
       concat('Format version: 1', chr(10), 'Number of columns: ', case when o_orderdate < timestamp '1998-06-01 00:00:00' then '6935' else '8192' end, chr(10),
              'Number of rows: ', case when o_orderdate < timestamp '1998-06-01 00:00:00' then '3351' else '4096' end, chr(10),
              'No data value: -9999', chr(10)) as content
from orders"""),
    "v_acquirable": ((), """
select distinct event_type as name from events where event_type <> 'error'"""),
}


def sql_ctes(views, extra: list[tuple[str, str]], body: str) -> str:
    order: list[str] = []

    def visit(v):
        if v in order:
            return
        for dep in _SQL_VIEWS[v][0]:
            visit(dep)
        order.append(v)

    for v in views:
        visit(v)
    parts = [f"{v} as ({_SQL_VIEWS[v][1].strip()})" for v in order]
    parts += [f"{name} as ({text.strip()})" for name, text in extra]
    if not parts:
        return body.strip()
    return "with " + ",\n".join(parts) + "\n" + body.strip()
