"""Point-wise grid operators on cell tables ``(t, r, c, ...)``.

All of these are Column expressions, so they stay inside whole-stage codegen
and need no shuffle.  Nodata is SQL NULL inside the engine; sentinels only
appear at the edges (``nodata_to_null`` on input, ``null_to_nodata`` on output).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the snow model.
KELVIN_OFFSET = 273.15
COLD_CONTENT_HEAT = 2114      # specific heat of ice term of the cold-content formula
COLD_CONTENT_LATENT = 333000  # latent heat of fusion term
MELT_TO_MM = 0.01             # raw melt grid to millimetres
NODATA = -9999.0
NODATA_EARLY = 55537.0        # -9999 read as unsigned 16 bit, used before 2011-01-24


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nodata_to_null(col, nodata=NODATA) -> Column:
    """Cells equal to ``nodata`` become NULL (``set_value_to_nodata``)."""
    return F.nullif(_c(col), F.lit(nodata))


def nodata_sentinels_to_null(col) -> Column:
    """Both sentinels the raw archive uses, for any date (they are the same bits)."""
    c = _c(col)
    return F.when(c.isin(NODATA, NODATA_EARLY), F.lit(None).cast("double")).otherwise(c)


def null_to_nodata(col, nodata=NODATA) -> Column:
    return F.coalesce(_c(col), F.lit(nodata))


def scale_values(col, factor) -> Column:
    """``v * factor``, NULL stays NULL."""
    return _c(col) * F.lit(factor)


def kelvin_to_celsius(col) -> Column:
    return _c(col) - F.lit(KELVIN_OFFSET)


def cold_content(temp_k, swe) -> Column:
    """Snow cold content from average snowpack temperature (K) and SWE.

    Order of the rule: a non-negative Celsius temperature gives 0 even when
    SWE is missing; otherwise a missing input gives NULL; otherwise
    ``swe * 2114 * degC / 333000``.
    """
    deg_c = kelvin_to_celsius(temp_k)
    s = _c(swe)
    return (
        F.when(deg_c >= 0, F.lit(0.0))
        .when(s.isNull() | deg_c.isNull(), F.lit(None).cast("double"))
        .otherwise(s * COLD_CONTENT_HEAT * deg_c / COLD_CONTENT_LATENT)
    )


def lakefix_zero_to_nodata(v, mask_value) -> Column:
    """A 0 on a mask cell of -9999 becomes NULL; other cells unchanged."""
    vv = _c(v)
    return F.when((vv == 0) & (_c(mask_value) == NODATA), F.lit(None).cast("double")).otherwise(vv)


def restore_nodata(after_fill, before_fill, swe_filled) -> Column:
    """After a fill: filled SWE of 0 where the input was nodata -> back to NULL."""
    return F.when(
        (_c(swe_filled) == 0) & _c(before_fill).isNull(), F.lit(None).cast("double")
    ).otherwise(_c(after_fill))


def cell_align_join(left: DataFrame, right: DataFrame, keys=("t", "r", "c"), how="inner") -> DataFrame:
    """Equi join of grids on the same lattice.

    Both sides are keyed by (t, r, c); Spark shuffles both on the key (or
    reuses an existing hash partitioning), and AQE turns it into a broadcast
    only when one side is measured small at run time.
    """
    return left.join(right, on=list(keys), how=how)


def grid_shape(cells: DataFrame, keys=("t", "grid")) -> DataFrame:
    """Row and column count of every grid (max index + 1) over all its cells, nodata ones included."""
    return cells.groupBy(*keys).agg(
        (F.max("r") + 1).alias("n_rows"), (F.max("c") + 1).alias("n_cols"))
