"""Scalar column functions: object keys, file names, dates from names, GRIB times.

Every function returns a Column built from built-in expressions (no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the reference's rules.
VERSION_DEFAULT = "1111-11-11T11:11:11.11Z"
NODATA_SWITCH_DATE = "2011-01-24"      # 55537 before, -9999 from this day
LAKEFIX_START_DATE = "2014-10-09"      # lake fix due from this day
LAKEFIX_CODES = ("1034", "1036")       # SWE and snow depth parameter codes
SNOW_PARAMETERS = {                     # product -> member name pattern (prefix, date)
    "nohrsc_snodas_swe": "{}_ssmv11034tS__T0001TTNATS{}05HP001",
    "nohrsc_snodas_snowdepth": "{}_ssmv11036tS__T0001TTNATS{}05HP001",
    "nohrsc_snodas_snowpack_average_temperature": "{}_ssmv11038wS__A0024TTNATS{}05DP001",
    "nohrsc_snodas_snowmelt": "{}_ssmv11044bS__T0024TTNATS{}05DP000",
}
COMPUTED_PRODUCTS = {
    "nohrsc_snodas_coldcontent": "{}_coldcontent_{}",
    "nohrsc_snodas_snowmeltmm": "{}_snowmeltmm_{}",
}
SNODAS_NAME_PATTERN = r"^SNODAS_unmasked_([0-9]+)\.tar$"
PRISM_NAME_PATTERN = r"^PRISM_[a-z]+_early_4kmD2_([0-9]+)_bil\.zip$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def key_parts(key) -> dict[str, Column]:
    """URL-decoded key (``+`` is a space), its 2nd path part and its last part."""
    decoded = F.url_decode(_c(key))
    parts = F.split(decoded, "/")
    return {
        "key": decoded,
        "acquirable": F.try_element_at(parts, F.lit(2)),
        "filename": F.element_at(parts, -1),
    }


def ntz_from_epoch(seconds) -> Column:
    """TIMESTAMP_NTZ for epoch seconds (UTC wall clock), session-zone independent."""
    s = _c(seconds).cast("bigint")
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return base + F.make_dt_interval(F.floor(s / 86400).cast("int"), F.lit(0), F.lit(0),
                                     (s - F.floor(s / 86400) * 86400).cast("decimal(18,6)"))


def grib_time(text) -> Column:
    """``"1599008400 sec UTC"`` -> TIMESTAMP_NTZ (UTC); NULL when it does not start with a whole number."""
    return ntz_from_epoch(F.split_part(_c(text), F.lit(" "), F.lit(1)).try_cast("bigint"))


def iso_text(ts) -> Column:
    """ISO 8601 text without zone, as Python's ``isoformat`` prints whole seconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")


def date_from_digits(digits, hours: int = 0) -> Column:
    """8 digits ``yyyymmdd`` -> TIMESTAMP_NTZ (+ hours); NULL when not a date."""
    d = _c(digits)
    return F.when(
        F.length(d) == 8,
        F.try_make_timestamp_ntz(
            F.substring(d, 1, 4).cast("int"), F.substring(d, 5, 2).cast("int"),
            F.substring(d, 7, 2).cast("int"), F.lit(hours), F.lit(0), F.lit(0)),
    )


def date_from_name(name) -> Column:
    """Daily snow archive name -> date + 6 h; gridded climate zip name -> date; else NULL."""
    n = _c(name)
    snodas = F.regexp_extract(n, SNODAS_NAME_PATTERN, 1)
    prism = F.regexp_extract(n, PRISM_NAME_PATTERN, 1)
    return (F.when(snodas != "", date_from_digits(snodas, 6))
            .when(prism != "", date_from_digits(prism, 0)))


def dataset_prefix(infile_type) -> Column:
    t = F.upper(_c(infile_type))
    return F.when(t == "UNMASKED", "zz").when(t == "MASKED", "us")


def raw_archive_name(d, infile_type) -> Column:
    t = F.upper(_c(infile_type))
    ds = F.date_format(_c(d), "yyyyMMdd")
    return (F.when(t == "UNMASKED", F.concat(F.lit("SNODAS_unmasked_"), ds, F.lit(".tar")))
            .when(t == "MASKED", F.concat(F.lit("SNODAS_"), ds, F.lit(".tar"))))


def member_name(pattern: str, d, infile_type) -> Column:
    """Fill a ``{prefix}...{yyyymmdd}`` name pattern."""
    head, mid, tail = pattern.split("{}")
    return F.concat(F.lit(head), dataset_prefix(infile_type), F.lit(mid),
                    F.date_format(_c(d), "yyyyMMdd"), F.lit(tail))


def compound_stem(name) -> Column:
    """Part before the leftmost dot."""
    return F.substring_index(_c(name), ".", 1)


def compound_extension(name) -> Column:
    """Everything after the leftmost dot; NULL when there is no dot."""
    return F.nullif(F.regexp_extract(_c(name), r"^[^.]*\.(.*)$", 1), F.lit(""))


def strip_last_extension(name) -> Column:
    """``os.path.splitext(name)[0]`` for plain names (a leading dot is not an extension)."""
    n = _c(name)
    return F.when(F.locate(".", F.substring(n, 2, 1 << 30)) > 0,
                  F.regexp_replace(n, r"\.[^.]*$", "")).otherwise(n)


def output_name(rule, name, valid_ts=None) -> Column:
    """Output file name by recipe name rule."""
    r, n = _c(rule), _c(name)
    out = (
        F.when(r == "cut_grib2gz", F.concat(F.substring_index(n, ".grib2.gz", 1), F.lit(".tif")))
        .when(r == "cut_grb", F.concat(F.substring_index(n, ".grb", 1), F.lit(".tif")))
        .when(r == "append_tif", F.concat(n, F.lit(".tif")))
        .when(r == "cog_suffix", F.concat(strip_last_extension(n), F.lit("_cloud_optimized.tif")))
    )
    if valid_ts is not None:
        out = F.when(r == "date_prefix",
                     F.concat(F.date_format(_c(valid_ts), "yyyyMMdd"), F.lit("_"), n)).otherwise(out)
    return out


def nodata_by_date(d) -> Column:
    """Sentinel text by date: '55537' before 2011-01-24, else '-9999'."""
    return F.when(_c(d) < F.lit(NODATA_SWITCH_DATE).cast("date"), F.lit("55537")).otherwise(F.lit("-9999"))


def lakefix_applies(d, code) -> Column:
    return (_c(d) >= F.lit(LAKEFIX_START_DATE).cast("date")) & _c(code).cast("string").isin(*LAKEFIX_CODES)


def version_default(v) -> Column:
    return F.coalesce(_c(v), F.lit(VERSION_DEFAULT))


def mm_to_inches(mm) -> Column:
    return F.round(_c(mm) * 0.0393701, 3)


def uuid_of(name) -> Column:
    """Deterministic UUID-shaped id from md5 of a name (stand-in catalog ids)."""
    h = F.md5(_c(name))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def header_value(content, keyword: str) -> Column:
    """``<keyword>: <value>`` from header text; NULL if the keyword is missing."""
    return F.nullif(F.regexp_extract(_c(content), keyword + r":\s+(\S*)\s+", 1), F.lit(""))


# Header keywords and their short names.
HEADER_KEYWORDS = {
    "cols": "Number of columns",
    "rows": "Number of rows",
    "nodata": "No data value",
    "xmin": "Minimum x-axis coordinate",
    "xmax": "Maximum x-axis coordinate",
    "ymin": "Minimum y-axis coordinate",
    "ymax": "Maximum y-axis coordinate",
}


def checksum(content, algorithm) -> Column:
    """SHA256 or MD5 hex digest by (case-insensitive) algorithm name; NULL otherwise."""
    a = F.upper(_c(algorithm))
    return F.when(a == "SHA256", F.sha2(_c(content), 256)).when(a == "MD5", F.md5(_c(content)))
