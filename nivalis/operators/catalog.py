"""Catalog operators: validation joins, recipe dispatch, registry upsert, dedupe.

Small dimension tables (recipes, georeference rules, id maps) are fixed-size
data and are broadcast explicitly.  Tables that grow with the input (product
file candidates, the registry) are never broadcast by hand; AQE may still
choose a broadcast from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N

# Product recipes (one row per processor of the reference).
# name, band rule, band number, comment text, time source, version source, name rule, output filetype
RECIPES = [
    ("ncep_mrms_gaugecorr_qpe_01h", "first", None, None, "grib_valid", "none", "cut_grib2gz", "ncep_mrms_gaugecorr_qpe_01h"),
    ("ncep_mrms_v12_MultiSensor_QPE_01H_Pass1", "first", None, None, "grib_valid", "none", "cut_grib2gz", "ncep_mrms_v12_MultiSensor_QPE_01H_Pass1"),
    ("ncep_mrms_v12_MultiSensor_QPE_01H_Pass2", "first", None, None, "grib_valid", "none", "cut_grib2gz", "ncep_mrms_v12_MultiSensor_QPE_01H_Pass2"),
    ("ncep_rtma_ru_anl", "number", 3, None, "grib_valid", "none", "date_prefix", "ncep_rtma_ru_anl_airtemp"),
    ("ndgd_leia98_precip", "comment", None, "Total precipitation", "grib_valid", "none", "append_tif", "ndgd_leia98_precip"),
    ("ndgd_ltia98_airtemp", "comment", None, "Temperature [C]", "grib_valid", "none", "append_tif", "ndgd_ltia98_airtemp"),
    ("wpc_qpf_2p5km", "first", None, None, "grib_valid", "grib_ref", "cut_grb", "wpc_qpf_2p5km"),
    ("prism_ppt_early", "only", None, None, "file_name", "none", "cog_suffix", "prism_ppt_early"),
    ("prism_tmax_early", "only", None, None, "file_name", "none", "cog_suffix", "prism_tmax_early"),
    ("prism_tmin_early", "only", None, None, "file_name", "none", "cog_suffix", "prism_tmin_early"),
    ("nohrsc_snodas_unmasked", "members", None, None, "file_name", "none", "cog_suffix", "nohrsc_snodas_unmasked"),
]
RECIPE_SCHEMA = T.StructType([
    T.StructField("recipe", T.StringType()), T.StructField("band_rule", T.StringType()),
    T.StructField("band_number", T.IntegerType()), T.StructField("band_comment", T.StringType()),
    T.StructField("time_from", T.StringType()), T.StructField("version_from", T.StringType()),
    T.StructField("name_rule", T.StringType()), T.StructField("filetype", T.StringType()),
])

# Published product ids of the daily and interpolated snow products.
PUBLISH_IDS = [
    ("coldcontent", "c2f2f0ed-d120-478a-b38f-427e91ab18e2"),
    ("snowdepth", "e0baa220-1310-445b-816b-6887465cc94b"),
    ("swe", "757c809c-dda0-412b-9831-cb9bd0f62d1d"),
    ("snowmelt", "86526298-78fa-4307-9276-a7c0a0537d15"),
    ("snowpack_average_temperature", "57da96dc-fc5e-428c-9318-19f095f461eb"),
    ("nohrsc_snodas_swe_interpolated", "517369a5-7fe3-4b0a-9ef6-10f26f327b26"),
    ("nohrsc_snodas_snowpack_avg_temperature_interpolated", "e97fbc56-ebe2-4d5a-bcd4-4bf3744d8a1b"),
    ("nohrsc_snodas_snowmelt_interpolated", "10011d9c-04a4-454d-88a0-fb7ba0d64d37"),
    ("nohrsc_snodas_snowdepth_interpolated", "2274baae-1dcf-4c4c-92bb-e8a640debee0"),
    ("nohrsc_snodas_coldcontent_interpolated", "33407c74-cdc2-4ab2-bd9a-3dff99ea02e4"),
]


REGISTRY_KEYS = ("product_id", "version", "datetime")


def recipes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RECIPES, RECIPE_SCHEMA)


def publish_ids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PUBLISH_IDS, "name string, product_uuid string")


def stand_in_recipe(number) -> "F.Column":
    """Stand-in fixture: the synthetic events name no product, so a record's number picks one of all recipes."""
    return F.element_at(F.array(*[F.lit(r[0]) for r in RECIPES]), (number % len(RECIPES)).cast("int") + 1)


def products_from_names(names: DataFrame) -> DataFrame:
    """Product table (name, id) for a set of product names."""
    return names.select(F.col("name"), N.uuid_of("name").alias("product_id"))


def dispatch(records: DataFrame, recipe_table: DataFrame, on: str = "recipe") -> DataFrame:
    """Attach the processing recipe to each record (fixed-size recipe table, broadcast)."""
    return records.join(F.broadcast(recipe_table), on=on, how="inner")


def with_default_version(df: DataFrame, col: str = "version") -> DataFrame:
    return df.withColumn(col, N.version_default(col))


def first_per_key(df: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per key: the row with the smallest ``order_col``.

    Written as an aggregation of a struct (order column first), so Spark
    does a map-side partial aggregation: a key holding a third of all rows
    is reduced in every task before the shuffle, unlike a row_number window.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*([order_col] + [c for c in others if c != order_col])).alias("_w")
    g = df.groupBy(*keys).agg(F.min(packed).alias("_w"))
    return g.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in others])


def last_per_key(df: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per key: the row with the largest ``order_col`` (later replaces earlier)."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*([order_col] + [c for c in others if c != order_col])).alias("_w")
    g = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return g.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in others])


def conflict_free(candidates: DataFrame, existing: DataFrame, keys=REGISTRY_KEYS) -> DataFrame:
    """Candidates whose (product, version, datetime) is not registered yet.

    The version default is applied before the test, since NULL keys never
    conflict.  Null-safe equality keeps the rule exact for other NULL keys.
    """
    c = with_default_version(candidates).alias("c")
    e = with_default_version(existing).select(*keys).alias("e")
    cond = [F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    return c.join(e, on=cond, how="left_anti")


def registry_inserts(candidates: DataFrame, existing: DataFrame, order_col: str = "file_id",
                     keys=REGISTRY_KEYS) -> DataFrame:
    """Rows an ``INSERT ... ON CONFLICT DO NOTHING`` of the batch would add.

    Within the batch the first row per key wins (lowest ``order_col``, as in
    a multi-row insert); rows whose key is already registered are dropped.
    """
    fresh = conflict_free(candidates, existing, keys)
    return first_per_key(fresh, list(keys), order_col)


def registry_upsert(candidates: DataFrame, existing: DataFrame, order_col: str = "file_id",
                    keys=REGISTRY_KEYS) -> DataFrame:
    """Registry state after the idempotent upsert: existing rows plus inserts."""
    ins = registry_inserts(candidates, existing, order_col, keys)
    return with_default_version(existing).unionByName(ins.select(*existing.columns))


# ------------------------------------------------------- notice to registry
# Band inventory (JSON) as a metadata call prints it.
INVENTORY = ("struct<bands: array<struct<band: int, metadata: map<string, map<string, string>>>>>")
#: Outputs of the daily snow archive: filetype and file name pattern; of the two melt grids the one in millimetres stays.
DAILY_OUTPUTS = {**{ft: p for ft, p in N.SNOW_PARAMETERS.items() if ft != "nohrsc_snodas_snowmelt"},
                 "nohrsc_snodas_coldcontent": N.COMPUTED_PRODUCTS["nohrsc_snodas_coldcontent"],
                 "nohrsc_snodas_snowmelt": N.COMPUTED_PRODUCTS["nohrsc_snodas_snowmeltmm"]}


def inventory_bands(info) -> "F.Column":
    """Bands (band, valid_time, ref_time, comment) of an inventory text, in its order; none where it is unreadable."""
    bands = F.from_json(info, INVENTORY)["bands"]
    return F.coalesce(F.transform(bands, lambda b: F.struct(
        b["band"].alias("band"), b["metadata"][""]["GRIB_VALID_TIME"].alias("valid_time"),
        b["metadata"][""]["GRIB_REF_TIME"].alias("ref_time"), b["metadata"][""]["GRIB_COMMENT"].alias("comment"))), F.array())


def pick_band(bands: str = "bands") -> "F.Column":
    """The band of a file by the recipe's rule: first, by number, or the first whose comment has the text, else the last."""
    b = F.col(bands)
    numbered = F.get(F.filter(b, lambda x: x["band"] == F.col("band_number")), F.lit(0))
    named = F.get(F.filter(b, lambda x: x["comment"].contains(F.col("band_comment"))), F.lit(0))
    return (F.when(F.col("band_rule") == "first", F.get(b, F.lit(0))).when(F.col("band_rule") == "number", numbered)
            .when(F.col("band_rule") == "comment", F.coalesce(named, F.get(b, F.size(b) - 1))))


def outputs(valid) -> "F.Column":
    """Filetype and file name of everything a recipe makes of its file; names with a date need its valid time."""
    daily = F.array(*[F.struct(F.lit(ft).alias("filetype"), F.concat(N.member_name(p, valid, F.lit("unmasked")), F.lit("_cloud_optimized.tif"))
                               .alias("out_file")) for ft, p in DAILY_OUTPUTS.items()])
    single = F.array(F.struct(F.col("filetype").alias("filetype"), N.output_name("name_rule", "filename", valid).alias("out_file")))
    return F.when(F.col("band_rule") == "members", daily).otherwise(single)


def process_files(files: DataFrame, inventories: DataFrame, recipe_table: DataFrame, products: DataFrame) -> DataFrame:
    """All recipes as one plan: files (file_id, recipe, filename, ...) to a row per output.

    A file's inventory (file_id, info) gives its bands, the recipe the band,
    the valid time (from the band or the file's name), the version (reference
    time of the band, or none) and the outputs with their names; the product
    comes from the filetype.  ``reason`` says why an output cannot be
    registered, null if it can.  The recipe and product tables are small; the
    only shuffle is that of files and inventories on the file.
    """
    x = dispatch(files, recipe_table).join(inventories.select("file_id", inventory_bands("info").alias("bands")), "file_id", "left")
    x = x.withColumn("bands", F.coalesce("bands", F.array().cast(x.schema["bands"].dataType)))
    x = x.withColumn("picked", pick_band())
    valid = F.when(F.col("time_from") == "grib_valid", N.grib_time("picked.valid_time")).otherwise(N.date_from_name("filename"))
    x = x.withColumn("valid", valid).withColumn("version", F.when(F.col("version_from") == "grib_ref", N.iso_text(N.grib_time("picked.ref_time"))))
    made = x.select(*files.columns, "band_rule", F.size("bands").alias("n_bands"), F.col("picked.band").alias("band"), "valid", "version",
                    F.explode(outputs(F.col("valid"))).alias("o")).select("*", "o.filetype", "o.out_file").drop("o")
    known = made.join(products.select(F.col("name").alias("filetype"), "product_id"), "filetype", "left")
    banded = F.col("band_rule").isin("first", "number", "comment")
    reason = (F.when(banded & (F.col("n_bands") == 0), "no bands").when(banded & F.col("band").isNull(), "no band by the rule of the recipe")
              .when(F.col("valid").isNull(), "no time").when(F.col("product_id").isNull(), "unknown filetype"))
    return known.withColumn("reason", reason)


def registrations(files: DataFrame, acquirables: DataFrame, inventories: DataFrame, recipe_table: DataFrame, products: DataFrame,
                  route_prefix: str) -> DataFrame:
    """From announced files (event_id, file_id, acquirable, recipe, filename) to registry rows, batch or stream.

    The acquirable has to be in the catalog.  Rows with a ``reason`` are
    reported and have no routed key; the others are ready for the registry.
    """
    known = files.join(acquirables.select(F.col("name").alias("acquirable")), "acquirable", "left_semi")
    x = process_files(known, inventories, recipe_table, products)
    routed = F.when(F.col("reason").isNull(), F.concat(F.lit(f"{route_prefix}/"), "filetype", F.lit("/"), "out_file"))
    return x.select("event_id", "recipe", "filetype", "product_id", routed.alias("file"), N.iso_text("valid").alias("datetime"),
                    N.version_default("version").alias("version"), "reason")
