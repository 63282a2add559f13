"""Registered queries over records: notices, catalog joins, registry, bands, names, headers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures, sql_ctes
from ..functions import names as N
from ..operators import catalog as C
from .registry import register


def _sql_values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) as v({', '.join(cols)})"


SQL_RECIPES = ("recipes", _sql_values(C.RECIPES, [f.name for f in C.RECIPE_SCHEMA.fields]))
_SQL_RECIPE_OF = f"list_extract([{', '.join(repr(r[0]) for r in C.RECIPES)}], cast(k.event_id % {len(C.RECIPES)} as int) + 1)"
SQL_PUBLISH = ("publish_ids", _sql_values(C.PUBLISH_IDS, ["name", "product_uuid"]))
SQL_KP = ("kp", """
select event_id, ts, url_decode(replace(object_key, '+', ' ')) as key,
       split_part(url_decode(replace(object_key, '+', ' ')), '/', 2) as acquirable,
       string_split(url_decode(replace(object_key, '+', ' ')), '/')[-1] as filename
from v_notice""")
SQL_UUID = ("concat_ws('-', substr(md5({x}), 1, 8), substr(md5({x}), 9, 4), substr(md5({x}), 13, 4), "
            "substr(md5({x}), 17, 4), substr(md5({x}), 21, 12))")


def _sql_output_name(rule, n, ts):
    return (f"case when {rule} = 'cut_grib2gz' then concat(split_part({n}, '.grib2.gz', 1), '.tif') "
            f"when {rule} = 'cut_grb' then concat(split_part({n}, '.grb', 1), '.tif') "
            f"when {rule} = 'append_tif' then concat({n}, '.tif') "
            f"when {rule} = 'cog_suffix' then concat(case when position('.' in substr({n}, 2)) > 0 "
            f"then regexp_replace({n}, '\\.[^.]*$', '') else {n} end, '_cloud_optimized.tif') "
            f"when {rule} = 'date_prefix' then strftime({ts}, '%Y%m%d') || '_' || {n} end")


#: A filetype that recipes make and the product catalog does not know.
UNLISTED = "prism_tmin_early"
FILETYPES = [f for f in dict.fromkeys([*[r[-1] for r in C.RECIPES if r[1] != "members"], *C.DAILY_OUTPUTS]) if f != UNLISTED]


def filetype_products(fx: Fixtures) -> DataFrame:
    """The product catalog: name and id of every known filetype."""
    names = fx.spark.sql("select name from values " + ", ".join(f"('{f}')" for f in FILETYPES) + " as v(name)")
    return C.products_from_names(names)


def stand_in_name(recipe, number, ts) -> "F.Column":
    """Stand-in fixture: the name under which a product's file arrives; every 17th name has a broken date."""
    day = F.when(number % 17 == 0, F.lit("2020")).otherwise(F.date_format(ts, "yyyyMMdd"))
    return (F.when(recipe.startswith("prism_"), F.concat(F.lit("PRISM_"), F.split_part(recipe, F.lit("_"), F.lit(2)), F.lit("_early_4kmD2_"), day, F.lit("_bil.zip")))
            .when(recipe == "nohrsc_snodas_unmasked", F.concat(F.lit("SNODAS_unmasked_"), day, F.lit(".tar")))
            .when(recipe == "wpc_qpf_2p5km", F.concat(F.lit("p06m_"), number.cast("string"), F.lit(".grb")))
            .when(recipe == "ncep_rtma_ru_anl", F.concat(F.lit("rtma2p5_ru.t"), F.date_format(ts, "HH"), F.lit("00z.2dvaranl_ndfd.grb2")))
            .when(recipe.startswith("ncep_mrms"), F.concat(F.lit("MRMS_"), number.cast("string"), F.lit(".grib2.gz")))
            .otherwise(F.concat(recipe, F.lit("_KWBR_"), number.cast("string"))))


def announced_of(notice: DataFrame) -> DataFrame:
    """Files that notices announce: event_id, file_id, acquirable, recipe, filename; the file of event n has inventory n."""
    recipe = C.stand_in_recipe(F.col("event_id"))
    return notice.select("event_id", F.col("event_id").alias("file_id"), N.key_parts("object_key")["acquirable"].alias("acquirable"),
                         recipe.alias("recipe"), stand_in_name(recipe, F.col("event_id"), F.col("ts")).alias("filename"))


def band_inventory_json(fx: Fixtures) -> DataFrame:
    """Inventory JSON text per file (what a metadata call prints); every 13th file is unreadable.

    The stand-in reference time of band n lies 6 n hours before its valid time.
    """
    b = fx.band
    ref = F.concat((F.split_part("valid_time", F.lit(" "), F.lit(1)).cast("bigint") - 21600 * F.col("band")).cast("string"), F.lit(" sec UTC"))
    per_file = b.groupBy("file_id").agg(
        F.sort_array(F.collect_list(F.struct("band", "valid_time", "comment", ref.alias("ref_time")))).alias("raw"))
    per_file = per_file.select("file_id", F.transform("raw", lambda x: F.struct(
        x["band"].alias("band"),
        F.create_map(F.lit(""), F.create_map(F.lit("GRIB_VALID_TIME"), x["valid_time"], F.lit("GRIB_REF_TIME"), x["ref_time"],
                                             F.lit("GRIB_COMMENT"), x["comment"])).alias("metadata"))).alias("bands"))
    js = F.to_json(F.struct("bands"))
    return per_file.select("file_id", F.when(F.col("file_id") % 13 == 0, F.lit("ERROR 4: not recognized"))
                           .otherwise(js).alias("info"))


def key_parts_df(fx: Fixtures):
    n = fx.notice
    kp = N.key_parts("object_key")
    return n.select("event_id", "ts", kp["key"].alias("key"), kp["acquirable"].alias("acquirable"),
                    kp["filename"].alias("filename"))


# ------------------------------------------------------------------ notices
BUCKET = "incoming-grids"
ROUTE_PREFIX = "products"       # first part of every routed output key


@register("notice_scan", sql_ctes(("v_notice",), [], f"""
select event_id, '{BUCKET}' as bucket, url_decode(replace(object_key, '+', ' ')) as key from v_notice"""))
def notice_scan(spark, sf_dir):
    """Notification files (one document per event) written to the shared folder and read with an explicit schema."""
    from ..session import scratch_path
    from ..sources.notices import read_notices
    fx = Fixtures(spark, sf_dir)
    docs = fx.notice.select(F.to_json(F.struct(F.array(F.struct(
        F.lit("ObjectCreated:Put").alias("eventName"),
        N.iso_text("ts").alias("eventTime"),
        F.struct(F.struct(F.lit(BUCKET).alias("name")).alias("bucket"),
                 F.struct(F.col("object_key").alias("key"), F.lit(0).cast("bigint").alias("size"),
                          F.col("event_id").cast("string").alias("sequencer")).alias("object"),
                 ).alias("s3"))).alias("Records"))).alias("value"))
    path = scratch_path(spark, "notices")
    docs.write.text(path)
    return read_notices(spark, path, pretty=False).select(F.col("sequencer").cast("bigint").alias("event_id"), "bucket", "key")


@register("key_parts", sql_ctes(("v_notice",), [SQL_KP], "select event_id, key, acquirable, filename from kp"))
def key_parts(spark, sf_dir):
    return key_parts_df(Fixtures(spark, sf_dir)).drop("ts")


@register("acquirable_semi_join", sql_ctes(("v_notice", "v_acquirable"), [SQL_KP], """
select event_id, acquirable, filename from kp where acquirable in (select name from v_acquirable)"""))
def acquirable_semi_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    kp = key_parts_df(fx)
    cat = fx.acquirable.withColumnRenamed("name", "acquirable")
    return kp.join(cat, "acquirable", "left_semi").select("event_id", "acquirable", "filename")


@register("acquirable_anti_join", sql_ctes(("v_notice", "v_acquirable"), [SQL_KP], """
select event_id, acquirable, filename from kp where acquirable not in (select name from v_acquirable)"""))
def acquirable_anti_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    kp = key_parts_df(fx)
    cat = fx.acquirable.withColumnRenamed("name", "acquirable")
    return kp.join(cat, "acquirable", "left_anti").select("event_id", "acquirable", "filename")


SQL_DAY8 = "case when event_id % 17 = 0 then '2020' else strftime(ts, '%Y%m%d') end"
SQL_ANNOUNCED = ("announced", f"""
select event_id, ts, acquirable, recipe,
       case when starts_with(recipe, 'prism_') then concat('PRISM_', split_part(recipe, '_', 2), '_early_4kmD2_', {SQL_DAY8}, '_bil.zip')
            when recipe = 'nohrsc_snodas_unmasked' then concat('SNODAS_unmasked_', {SQL_DAY8}, '.tar')
            when recipe = 'wpc_qpf_2p5km' then concat('p06m_', event_id, '.grb')
            when recipe = 'ncep_rtma_ru_anl' then concat('rtma2p5_ru.t', strftime(ts, '%H'), '00z.2dvaranl_ndfd.grb2')
            when starts_with(recipe, 'ncep_mrms') then concat('MRMS_', event_id, '.grib2.gz')
            else concat(recipe, '_KWBR_', event_id) end as filename
from (select k.*, {_SQL_RECIPE_OF} as recipe from kp k) q""")
_SQL_NAME_DATE = ("coalesce(try_strptime(nullif(regexp_extract(a.filename, '^SNODAS_unmasked_([0-9]{8})\\.tar$', 1), ''), '%Y%m%d') + interval 6 hour, "
                  "try_strptime(nullif(regexp_extract(a.filename, '^PRISM_[a-z]+_early_4kmD2_([0-9]{8})_bil\\.zip$', 1), ''), '%Y%m%d'))")
_SQL_BAND_TS = "(timestamp '1970-01-01 00:00:00' + to_seconds(cast(split_part(b.valid_time, ' ', 1) as bigint){}))"


def _sql_daily_name(pattern: str) -> str:
    head, mid, tail = pattern.split("{}")
    return f"'{head}zz{mid}' || strftime(valid, '%Y%m%d') || '{tail}_cloud_optimized.tif'"


SQL_REGISTRATIONS = [SQL_KP, SQL_RECIPES, SQL_ANNOUNCED, ("readable", "select * from v_band where file_id % 13 <> 0"), ("picks", """
select a.event_id, any_value(a.acquirable) as acquirable, any_value(a.filename) as filename, any_value(r.recipe) as recipe, any_value(r.filetype) as filetype,
       any_value(r.band_rule) as band_rule, any_value(r.time_from) as time_from, any_value(r.version_from) as version_from,
       any_value(r.name_rule) as name_rule, count(b.band) as n_bands,
       case any_value(r.band_rule)
         when 'number' then min(b.band) filter (where b.band = r.band_number)
         when 'comment' then coalesce(min(b.band) filter (where contains(b.comment, r.band_comment)), max(b.band))
         when 'first' then min(b.band) end as band
from announced a join recipes r on r.recipe = a.recipe left join readable b on b.file_id = a.event_id group by a.event_id"""), ("timed", f"""
select a.*, case when a.time_from = 'grib_valid' then {_SQL_BAND_TS.format('')} else {_SQL_NAME_DATE} end as valid,
       case when a.version_from = 'grib_ref' then strftime({_SQL_BAND_TS.format(' - 21600 * b.band')}, '%Y-%m-%dT%H:%M:%S') end as version
from picks a left join readable b on b.file_id = a.event_id and b.band = a.band"""), ("made", f"""
select t.* exclude (filetype), filetype, {_sql_output_name('t.name_rule', 't.filename', 't.valid')} as out_file from timed t where band_rule <> 'members'
union all
select t.* exclude (filetype), o.filetype, case o.filetype {' '.join(f"when '{ft}' then {_sql_daily_name(p)}" for ft, p in C.DAILY_OUTPUTS.items())} end
from timed t, (select unnest([{', '.join(repr(ft) for ft in C.DAILY_OUTPUTS)}]) as filetype) o where band_rule = 'members'"""), ("judged", f"""
select m.*, case when filetype in ({', '.join(repr(f) for f in FILETYPES)}) then {SQL_UUID.format(x='filetype')} end as product_id,
       case when band_rule in ('first', 'number', 'comment') and n_bands = 0 then 'no bands'
            when band_rule in ('first', 'number', 'comment') and band is null then 'no band by the rule of the recipe'
            when valid is null then 'no time' when filetype = '{UNLISTED}' then 'unknown filetype' end as reason
from made m"""), ("registrations", f"""
select event_id, recipe, filetype, product_id, case when reason is null then concat('{ROUTE_PREFIX}/', filetype, '/', out_file) end as file,
       strftime(valid, '%Y-%m-%dT%H:%M:%S') as datetime, coalesce(version, '{N.VERSION_DEFAULT}') as version, reason
from judged where acquirable in (select name from v_acquirable)""")]


def registrations_df(fx: Fixtures) -> DataFrame:
    return C.registrations(announced_of(fx.notice), fx.acquirable, band_inventory_json(fx), C.recipes(fx.spark), filetype_products(fx), ROUTE_PREFIX)


def processed(fx: Fixtures) -> DataFrame:
    """Every output of the files that valid notices announce."""
    known = announced_of(fx.notice).join(fx.acquirable.withColumnRenamed("name", "acquirable"), "acquirable", "left_semi")
    return C.process_files(known, band_inventory_json(fx), C.recipes(fx.spark), filetype_products(fx))


@register("processor_dispatch", sql_ctes(("v_notice", "v_acquirable", "v_band"), SQL_REGISTRATIONS, """
select event_id, acquirable, recipe, filetype, filename, out_file from judged where acquirable in (select name from v_acquirable)"""))
def processor_dispatch(spark, sf_dir):
    """Every valid notice with its recipe (all of them are reached) and what it makes; dates in names are the band's."""
    return processed(Fixtures(spark, sf_dir)).select("event_id", "acquirable", "recipe", "filetype", "filename", "out_file")


NAME_RULES = ["cut_grib2gz", "cut_grb", "append_tif", "cog_suffix", "date_prefix"]


@register("output_names", sql_ctes(("v_notice",), [SQL_KP], f"""
select event_id, rule, {_sql_output_name('rule', 'filename', 'ts')} as out_name
from kp, (select unnest([{', '.join(repr(r) for r in NAME_RULES)}]) as rule) rr"""))
def output_names(spark, sf_dir):
    kp = key_parts_df(Fixtures(spark, sf_dir))
    x = kp.select("event_id", "ts", "filename",
                  F.explode(F.array(*[F.lit(r) for r in NAME_RULES])).alias("rule"))
    return x.select("event_id", "rule", N.output_name("rule", "filename", "ts").alias("out_name"))


def product_table(fx: Fixtures):
    return C.products_from_names(fx.acquirable)


SQL_PRODUCTS = ("products", f"select name, {SQL_UUID.format(x='name')} as product_id from v_acquirable")


@register("product_id_join", sql_ctes(("v_notice", "v_acquirable"), [SQL_KP, SQL_RECIPES, ("files", f"""
select k.event_id, unnest(case when r.band_rule = 'members' then [{', '.join(repr(f) for f in C.DAILY_OUTPUTS)}] else [r.filetype] end) as filetype
from kp k join recipes r on r.recipe = {_SQL_RECIPE_OF}""")], f"""
select event_id, filetype, {SQL_UUID.format(x='filetype')} as product_id from files where filetype <> '{UNLISTED}'"""))
def product_id_join(spark, sf_dir):
    """The product of every output by its filetype; a filetype without a product drops out (and is reported with the registrations)."""
    fx = Fixtures(spark, sf_dir)
    d = C.dispatch(announced_of(fx.notice), C.recipes(spark))
    made = F.when(F.col("band_rule") == "members", F.array(*[F.lit(f) for f in C.DAILY_OUTPUTS])).otherwise(F.array("filetype"))
    x = d.select("event_id", F.explode(made).alias("filetype"))
    return x.join(filetype_products(fx).withColumnRenamed("name", "filetype"), "filetype").select("event_id", "filetype", "product_id")


@register("routed_key", sql_ctes(("v_notice", "v_acquirable", "v_band"), SQL_REGISTRATIONS,
                                 "select event_id, file as write_key from registrations where reason is null"))
def routed_key(spark, sf_dir):
    """Key every registered output is written to: by its filetype and the recipe's name rule."""
    rows = registrations_df(Fixtures(spark, sf_dir)).where("reason is null")
    return rows.select("event_id", F.col("file").alias("write_key"))


@register("compound_extension", sql_ctes(("v_notice",), [SQL_KP], """
select event_id, split_part(filename, '.', 1) as stem,
       nullif(regexp_extract(filename, '^[^.]*\\.(.*)$', 1), '') as ext,
       concat(split_part(filename, '.', 1), '.tif') as changed,
       coalesce(nullif(regexp_extract(filename, '^[^.]*\\.(.*)$', 1), '') in ('grib2.gz', 'tar.gz'), false) as deletable
from kp"""))
def compound_extension(spark, sf_dir):
    kp = key_parts_df(Fixtures(spark, sf_dir))
    ext = N.compound_extension("filename")
    return kp.select("event_id", N.compound_stem("filename").alias("stem"), ext.alias("ext"),
                     F.concat(N.compound_stem("filename"), F.lit(".tif")).alias("changed"),
                     F.coalesce(ext.isin("grib2.gz", "tar.gz"), F.lit(False)).alias("deletable"))


# ------------------------------------------------------------------ registry
def _existing(fx: Fixtures):
    """Registry already holding the product files of finished orders."""
    done = fx.t("orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("file_id"))
    return fx.productfile.join(done, "file_id", "left_semi")


SQL_EXISTING = ("existing", """
select * from v_productfile where file_id in (select o_orderkey from orders where o_orderstatus = 'F')""")
SQL_DEF = "coalesce({v}, '1111-11-11T11:11:11.11Z')"
SQL_FRESH = ("fresh", f"""
select c.file_id, c.product_id, c.datetime, {SQL_DEF.format(v='c.version')} as version
from v_productfile c
where not exists (select 1 from existing e where e.product_id is not distinct from c.product_id
   and {SQL_DEF.format(v='e.version')} is not distinct from {SQL_DEF.format(v='c.version')}
   and e.datetime is not distinct from c.datetime)""")
SQL_INSERTS = ("inserts", """
select min(file_id) as file_id, product_id, datetime, version from fresh group by product_id, datetime, version""")


@register("version_default", sql_ctes(("v_productfile",), [], f"""
select file_id, {SQL_DEF.format(v='version')} as version from v_productfile"""))
def version_default(spark, sf_dir):
    pf = Fixtures(spark, sf_dir).productfile
    return pf.select("file_id", N.version_default("version").alias("version"))


@register("conflict_anti_join", sql_ctes(("v_productfile",), [SQL_EXISTING, SQL_FRESH], """
select file_id, product_id, datetime, version from fresh"""))
def conflict_anti_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return C.conflict_free(fx.productfile, _existing(fx)).select("file_id", "product_id", "datetime", "version")


@register("registry_upsert", sql_ctes(("v_productfile",), [SQL_EXISTING, SQL_FRESH, SQL_INSERTS], f"""
select file_id, product_id, datetime, {SQL_DEF.format(v='version')} as version from existing
union all select file_id, product_id, datetime, version from inserts"""))
def registry_upsert(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = C.registry_upsert(fx.productfile, _existing(fx))
    return out.select("file_id", "product_id", "datetime", "version")


@register("ingest_count", sql_ctes(("v_productfile",), [SQL_EXISTING, SQL_FRESH, SQL_INSERTS], """
select (select count(*) from v_productfile) as n_submitted, (select count(*) from inserts) as n_inserted"""))
def ingest_count(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    ins = C.registry_inserts(fx.productfile, _existing(fx))
    sub = fx.productfile.agg(F.count(F.lit(1)).alias("n"))
    n_ins = ins.agg(F.count(F.lit(1)).alias("n"))
    return spark.range(1).select(sub.select("n").scalar().alias("n_submitted"),
                                 n_ins.select("n").scalar().alias("n_inserted"))


@register("last_wins_dedupe", sql_ctes(("v_productfile",), [], """
select product_id, datetime, file_id, version from (
  select *, row_number() over (partition by product_id, datetime order by file_id desc) as k from v_productfile) q
where k = 1"""))
def last_wins_dedupe(spark, sf_dir):
    pf = Fixtures(spark, sf_dir).productfile
    return C.last_per_key(pf, ["product_id", "datetime"], "file_id").select(
        "product_id", "datetime", "file_id", "version")


LOOKUP_FROM, LOOKUP_TO = "1996-01-01 00:00:00", "1998-01-01 00:00:00"


@register("productfile_lookup", sql_ctes(("v_productfile",), [], f"""
select product_id, datetime, max(file_id) as file_id from v_productfile
where datetime >= timestamp '{LOOKUP_FROM}' and datetime < timestamp '{LOOKUP_TO}'
group by product_id, datetime"""))
def productfile_lookup(spark, sf_dir):
    pf = Fixtures(spark, sf_dir).productfile
    lo, hi = F.lit(LOOKUP_FROM).cast("timestamp_ntz"), F.lit(LOOKUP_TO).cast("timestamp_ntz")
    sel = pf.where((F.col("datetime") >= lo) & (F.col("datetime") < hi))
    return C.last_per_key(sel.select("product_id", "datetime", "file_id"), ["product_id", "datetime"], "file_id")


# --------------------------------------------------------------------- bands
SQL_GT = "(timestamp '1970-01-01 00:00:00' + to_seconds(cast(split_part({s}, ' ', 1) as bigint)))"


@register("grib_time", sql_ctes(("v_band",), [], f"""
select file_id, band, {SQL_GT.format(s='valid_time')} as valid_ts,
       strftime({SQL_GT.format(s='valid_time')}, '%Y-%m-%dT%H:%M:%S') as valid_iso
from v_band"""))
def grib_time(spark, sf_dir):
    b = Fixtures(spark, sf_dir).band
    ts = N.grib_time("valid_time")
    return b.select("file_id", "band", ts.alias("valid_ts"), N.iso_text(ts).alias("valid_iso"))


@register("band_by_number", sql_ctes(("v_band",), [], """
select file_id, 'number3' as rule, band, valid_time from v_band where band = 3
union all
select file_id, 'first' as rule, min(band) as band, arg_min(valid_time, band) as valid_time from v_band group by file_id"""))
def band_by_number(spark, sf_dir):
    b = Fixtures(spark, sf_dir).band
    n3 = b.where(F.col("band") == 3).select("file_id", F.lit("number3").alias("rule"), "band", "valid_time")
    first = b.groupBy("file_id").agg(F.min(F.struct("band", "valid_time")).alias("s")).select(
        "file_id", F.lit("first").alias("rule"), "s.band", "s.valid_time")
    return n3.unionByName(first)


SEARCH_TEXTS = ["Total precipitation", "Temperature [C]"]


@register("band_by_comment", sql_ctes(("v_band",), [], f"""
select file_id, search,
       coalesce(min(band) filter (where contains(comment, search)), max(band)) as band,
       coalesce(arg_min(valid_time, band) filter (where contains(comment, search)), arg_max(valid_time, band)) as valid_time
from v_band, (select unnest([{', '.join(repr(s) for s in SEARCH_TEXTS)}]) as search) s
group by file_id, search"""))
def band_by_comment(spark, sf_dir):
    """All texts are searched in one grouping by file; only the picked bands are multiplied."""
    b = Fixtures(spark, sf_dir).band
    row = F.struct("band", "valid_time")
    picks = [F.struct(F.lit(s).alias("search"), F.coalesce(F.min(F.when(F.col("comment").contains(s), row)), F.max(row)).alias("s"))
             for s in SEARCH_TEXTS]
    g = b.groupBy("file_id").agg(F.array(*picks).alias("picks")).select("file_id", F.explode("picks").alias("p"))
    return g.select("file_id", "p.search", "p.s.band", "p.s.valid_time")


@register("first_match_pick", sql_ctes(("v_band",), [], """
select file_id, band, comment from (
  select *, row_number() over (partition by file_id
         order by case when contains(comment, 'Temperature [C]') then 0 else 1 end,
                  case when contains(comment, 'Temperature [C]') then band else -band end) as k
  from v_band) q where k = 1"""))
def first_match_pick(spark, sf_dir):
    b = Fixtures(spark, sf_dir).band
    m = F.col("comment").contains("Temperature [C]")
    w = Window.partitionBy("file_id").orderBy(F.when(m, 0).otherwise(1), F.when(m, F.col("band")).otherwise(-F.col("band")))
    return b.withColumn("k", F.row_number().over(w)).where("k = 1").select("file_id", "band", "comment")


@register("product_recipes", sql_ctes(("v_notice", "v_band"), SQL_REGISTRATIONS[:-1], """
select event_id as file_id, recipe, filetype, band, strftime(valid, '%Y-%m-%dT%H:%M:%S') as datetime, version, out_file, reason from judged"""))
def product_recipes(spark, sf_dir):
    """One plan for all recipes over all files: band by rule, valid time, reference time, version and output names.

    Outputs that cannot be registered (no bands, no band by the rule, no time, a filetype without a product) have their reason.
    """
    fx = Fixtures(spark, sf_dir)
    x = C.process_files(announced_of(fx.notice), band_inventory_json(fx), C.recipes(spark), filetype_products(fx))
    return x.select("file_id", "recipe", "filetype", "band", N.iso_text("valid").alias("datetime"), "version", "out_file", "reason")


# ---------------------------------------------------------------- dates/names
SQL_DATES = ("dates", "select distinct cast(o_orderdate + interval 14 year as date) as d from orders")
TYPES = ["unmasked", "UnMasked", "masked", "Masked"]


@register("nodata_by_date", sql_ctes((), [SQL_DATES], """
select d, case when d < date '2011-01-24' then '55537' else '-9999' end as nodata from dates"""))
def nodata_by_date(spark, sf_dir):
    d = Fixtures(spark, sf_dir).shifted_dates
    return d.select("d", N.nodata_by_date("d").alias("nodata"))


CODES = ["1034", "1036", "1038", "1044"]


@register("lakefix_applies", sql_ctes((), [SQL_DATES], f"""
select d, code, (d >= date '2014-10-09' and code in ('1034', '1036')) as applies
from dates, (select unnest([{', '.join(repr(c) for c in CODES)}]) as code) cc"""))
def lakefix_applies(spark, sf_dir):
    d = Fixtures(spark, sf_dir).shifted_dates
    x = d.select("d", F.explode(F.array(*[F.lit(c) for c in CODES])).alias("code"))
    return x.select("d", "code", N.lakefix_applies("d", "code").alias("applies"))


def _sql_member(pattern, d, ty):
    head, mid, tail = pattern.split("{}")
    pre = f"case when upper({ty}) = 'UNMASKED' then 'zz' when upper({ty}) = 'MASKED' then 'us' end"
    return f"concat('{head}', {pre}, '{mid}', strftime({d}, '%Y%m%d'), '{tail}')"


_MEMBERS = {**N.SNOW_PARAMETERS, **N.COMPUTED_PRODUCTS}


@register("raw_file_names", sql_ctes((), [SQL_DATES], f"""
select d, ty as infile_type,
       case when upper(ty) = 'UNMASKED' then concat('SNODAS_unmasked_', strftime(d, '%Y%m%d'), '.tar')
            when upper(ty) = 'MASKED' then concat('SNODAS_', strftime(d, '%Y%m%d'), '.tar') end as archive,
       case when upper(ty) = 'UNMASKED' then 'zz' when upper(ty) = 'MASKED' then 'us' end as prefix,
       {', '.join(f"{_sql_member(p, 'd', 'ty')} as {k}" for k, p in _MEMBERS.items())}
from dates, (select unnest([{', '.join(repr(t) for t in TYPES)}]) as ty) tt"""))
def raw_file_names(spark, sf_dir):
    d = Fixtures(spark, sf_dir).shifted_dates
    x = d.select("d", F.explode(F.array(*[F.lit(t) for t in TYPES])).alias("infile_type"))
    return x.select("d", "infile_type", N.raw_archive_name("d", "infile_type").alias("archive"),
                    N.dataset_prefix("infile_type").alias("prefix"),
                    *[N.member_name(p, "d", "infile_type").alias(k) for k, p in _MEMBERS.items()])


@register("daily_series_names", sql_ctes((), [SQL_DATES], """
select d, product,
       case when product = 'nohrsc_snodas_swe_interpolated' then concat('nohrsc_snodas_swe_interpolated_16_', strftime(d, '%Y%m%d'), '.tif')
            when product = 'nohrsc_snodas_swe' then concat('zz_ssmv11034tS__T0001TTNATS', strftime(d, '%Y%m%d'), '05HP001_cloud_optimized.tif') end as name
from dates, (select unnest(['nohrsc_snodas_swe_interpolated', 'nohrsc_snodas_swe', 'nohrsc_snodas_snowdepth']) as product) pp"""))
def daily_series_names(spark, sf_dir):
    d = Fixtures(spark, sf_dir).shifted_dates
    x = d.select("d", F.explode(F.array(F.lit("nohrsc_snodas_swe_interpolated"), F.lit("nohrsc_snodas_swe"),
                                        F.lit("nohrsc_snodas_snowdepth"))).alias("product"))
    ds = F.date_format("d", "yyyyMMdd")
    name = (F.when(F.col("product") == "nohrsc_snodas_swe_interpolated",
                   F.concat(F.lit("nohrsc_snodas_swe_interpolated_16_"), ds, F.lit(".tif")))
            .when(F.col("product") == "nohrsc_snodas_swe",
                  F.concat(F.lit("zz_ssmv11034tS__T0001TTNATS"), ds, F.lit("05HP001_cloud_optimized.tif"))))
    return x.select("d", "product", name.alias("name"))


def _names_df(fx: Fixtures):
    """Candidate raw file names per shifted date: valid and invalid forms."""
    d = fx.shifted_dates
    ds = F.date_format("d", "yyyyMMdd")
    bad = F.concat(F.date_format("d", "yyyy"), F.lit("13"), F.date_format("d", "dd"))
    forms = F.array(
        F.concat(F.lit("SNODAS_unmasked_"), ds, F.lit(".tar")),
        F.concat(F.lit("PRISM_ppt_early_4kmD2_"), ds, F.lit("_bil.zip")),
        F.concat(F.lit("SNODAS_"), ds, F.lit(".tar")),
        F.concat(F.lit("SNODAS_unmasked_"), bad, F.lit(".tar")),
    )
    return d.select(F.explode(forms).alias("name"))


SQL_NAMES = ("names", """
select unnest([concat('SNODAS_unmasked_', strftime(d, '%Y%m%d'), '.tar'),
               concat('PRISM_ppt_early_4kmD2_', strftime(d, '%Y%m%d'), '_bil.zip'),
               concat('SNODAS_', strftime(d, '%Y%m%d'), '.tar'),
               concat('SNODAS_unmasked_', strftime(d, '%Y'), '13', strftime(d, '%d'), '.tar')]) as name
from dates""")
SQL_DT = """case when regexp_extract(name, '^SNODAS_unmasked_([0-9]+).tar', 1) <> ''
  then try_strptime(regexp_extract(name, '^SNODAS_unmasked_([0-9]+).tar', 1), '%Y%m%d') + interval 6 hour
  when regexp_extract(name, '^PRISM_[a-z]+_early_4kmD2_([0-9]+)_bil.zip', 1) <> ''
  then try_strptime(regexp_extract(name, '^PRISM_[a-z]+_early_4kmD2_([0-9]+)_bil.zip', 1), '%Y%m%d') end"""


@register("date_from_name", sql_ctes((), [SQL_DATES, SQL_NAMES], f"select name, {SQL_DT} as dt from names"))
def date_from_name(spark, sf_dir):
    n = _names_df(Fixtures(spark, sf_dir))
    return n.select("name", N.date_from_name("name").alias("dt"))


@register("file_date_guard", sql_ctes((), [SQL_DATES, SQL_NAMES], f"""
select name, dt from (select name, {SQL_DT} as dt from names) q where dt is not null"""))
def file_date_guard(spark, sf_dir):
    n = _names_df(Fixtures(spark, sf_dir))
    return n.select("name", N.date_from_name("name").alias("dt")).where(F.col("dt").isNotNull())


# ------------------------------------------------------------------ documents
ALGOS = ["SHA256", "md5", "crc32"]


@register("content_checksum", f"""
select doc_id, algorithm,
       case when upper(algorithm) = 'SHA256' then sha256(text) when upper(algorithm) = 'MD5' then md5(text) end as checksum
from (select doc_id, text, list_extract([{', '.join(repr(a) for a in ALGOS)}], cast(doc_id % 3 as int) + 1) as algorithm from documents) q""")
def content_checksum(spark, sf_dir):
    docs = Fixtures(spark, sf_dir).t("documents")
    algo = F.element_at(F.array(*[F.lit(a) for a in ALGOS]), (F.col("doc_id") % 3).cast("int") + 1)
    x = docs.select("doc_id", "text", algo.alias("algorithm"))
    return x.select("doc_id", "algorithm", N.checksum("text", "algorithm").alias("checksum"))


@register("json_document", """
select doc_id, cast(to_json(struct_pack(doc_id := doc_id, meta := struct_pack(lang := lang, source := source, n_chars := n_chars))) as varchar) as json,
       lang, source, n_chars from documents""")
def json_document(spark, sf_dir):
    """Compact JSON text of a nested record (missing values are written as null), and the record read back from it."""
    docs = Fixtures(spark, sf_dir).t("documents")
    schema = "doc_id bigint, meta struct<lang string, source string, n_chars bigint>"
    rec = F.struct("doc_id", F.struct("lang", "source", "n_chars").alias("meta"))
    x = docs.select(F.to_json(rec, {"ignoreNullFields": "false"}).alias("json"))
    return x.select("json", F.from_json("json", schema).alias("rec")).select("rec.doc_id", "json", "rec.meta.*")


# -------------------------------------------------------------------- headers
def _sql_hv(kw):
    return f"nullif(regexp_extract(content, '{kw}:\\s+(\\S*)\\s+', 1), '')"


@register("header_values", sql_ctes(("v_header",), [], f"""
select t, {', '.join(f"{_sql_hv(kw)} as {k}" for k, kw in N.HEADER_KEYWORDS.items())} from v_header"""))
def header_values(spark, sf_dir):
    h = Fixtures(spark, sf_dir).header
    return h.select("t", *[N.header_value("content", kw).alias(k) for k, kw in N.HEADER_KEYWORDS.items()])


@register("header_change_runs", sql_ctes(("v_header",), [("hv", f"""
select t, {_sql_hv('Number of columns')} as cols, {_sql_hv('Number of rows')} as rows from v_header"""), ("fl", """
select *, case when lag(cols) over (order by t) is not distinct from cols
                and lag(rows) over (order by t) is not distinct from rows then 0 else 1 end as chg from hv"""),
    ("rn", "select *, sum(chg) over (order by t rows between unbounded preceding and current row) as run from fl")], """
select cast(run as bigint) as run, min(t) as first_t, max(t) as last_t, any_value(cols) as cols, any_value(rows) as rows,
       count(*) as n_steps from rn group by run"""))
def header_change_runs(spark, sf_dir):
    """Gaps and islands over the header series (one row per time step of the archive).

    Runs are found within each year (a window per year), then runs that touch
    over a year's border with the same values are merged; only the yearly
    runs, a few rows per year, are ordered as a whole.
    """
    h = Fixtures(spark, sf_dir).header
    hv = h.select("t", N.header_value("content", "Number of columns").alias("cols"),
                  N.header_value("content", "Number of rows").alias("rows"))
    yearly = change_runs(hv.select(F.floor(F.col("t") / 100).alias("part"), F.col("t").alias("first_t"), F.col("t").alias("last_t"),
                                   "cols", "rows", F.lit(1).cast("long").alias("n_steps")), ["part"])
    return change_runs(yearly, []).select("run", "first_t", "last_t", "cols", "rows", "n_steps")


def change_runs(rows: DataFrame, parts: list[str]) -> DataFrame:
    """Merge neighbours (first_t, last_t, cols, rows, n_steps) of equal cols and rows, within each part."""
    w = Window.partitionBy(*parts).orderBy("first_t")
    same = F.lag("cols").over(w).eqNullSafe(F.col("cols")) & F.lag("rows").over(w).eqNullSafe(F.col("rows")) & (F.row_number().over(w) > 1)
    flagged = rows.withColumn("chg", F.when(same, 0).otherwise(1))
    numbered = flagged.withColumn("run", F.sum("chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*parts, "run").agg(
        F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"), F.any_value("cols").alias("cols"),
        F.any_value("rows").alias("rows"), F.sum("n_steps").alias("n_steps"))



def _archive_files(dates: DataFrame, folder: str, content) -> None:
    """Stand-in archives: a real file per date below the shared folder, holding a short text."""
    from ..sinks.documents import write_files
    pieces = dates.select(N.raw_archive_name("d", F.lit("unmasked")).alias("name"), F.lit(0).alias("seq"), content.alias("text"))
    write_files(pieces, folder).write.format("noop").mode("overwrite").save()


@register("raw_file_inventory", sql_ctes((), [SQL_DATES], """
select s.d, concat('SNODAS_unmasked_', strftime(s.d, '%Y%m%d'), '.tar') as archive,
       case when x.d is null then 'missing' when dayofyear(s.d) % 5 = 0 then 'new' when dayofyear(s.d) % 5 = 1 then 'changed' else 'same' end as state
from (select cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as d from dates) s
left join dates x on x.d = s.d"""))
def raw_file_inventory(spark, sf_dir):
    """Expected daily archives over the covered range against the files that are there: missing, new since the last
    snapshot of the folder, changed, or the same.  The files are real; between the two listings some arrive and some grow."""
    from ..session import scratch_path
    from ..sources import listing as L
    d = Fixtures(spark, sf_dir).shifted_dates
    folder = scratch_path(spark, "archives")
    spark.range(0).selectExpr("cast(id as string) as value").write.text(folder)
    turn = F.dayofyear("d") % 5
    _archive_files(d.where(turn != 0), folder, F.lit("first"))
    last = L.write_snapshot(L.list_files(spark, folder, "*.tar"), scratch_path(spark, "snapshot"))
    _archive_files(d.where(turn <= 1), folder, F.lit("second, longer"))
    states = L.compare(L.list_files(spark, folder, "*.tar"), last)
    rng = d.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    spine = rng.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    spine = spine.select("d", N.raw_archive_name("d", F.lit("unmasked")).alias("archive"))
    return L.against_spine(states, spine).select("d", "archive", "state")


@register("date_spine_join", """
select s.d, count(o.o_orderkey) as n_orders
from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d from orders) s
left join orders o on cast(o.o_orderdate as date) = s.d
group by s.d""")
def date_spine_join(spark, sf_dir):
    o = Fixtures(spark, sf_dir).t("orders").select(F.to_date("o_orderdate").alias("d"))
    per_day = o.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    rng = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    spine = rng.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    j = spine.join(per_day, "d", "left")
    return j.select("d", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"))
