"""Per-pixel reflectance and vegetation indices as Column expressions.

A missing value is NULL throughout: comparisons with NULL are not true, so a
missing band makes every index that needs it missing, and aggregates skip it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = ("red", "green", "blue", "nir")
INDEX_NAMES = ("NDVI", "EVI", "NDWI")

# fixed values
DN_SCALE = 10000.0
VEGETATION_NDVI = 0.3
EVI_GAIN, EVI_C1, EVI_C2, EVI_L = 2.5, 6.0, 7.5, 1.0


def valid_dn(dn: Column) -> Column:
    """Digital number as a double; outside (0, scale] is no data."""
    return F.when((dn > 0) & (dn <= int(DN_SCALE)), dn.cast("double"))


def reflectance(dn: Column) -> Column:
    return valid_dn(dn) / DN_SCALE


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator)


def ndvi(red: Column, nir: Column) -> Column:
    return _ratio(nir - red, nir + red)


def evi(red: Column, nir: Column, blue: Column, one: float = 1.0) -> Column:
    """``one`` is the band value of full reflectance."""
    return F.lit(EVI_GAIN) * _ratio(nir - red, nir + EVI_C1 * red - EVI_C2 * blue + EVI_L * one)


def ndwi(green: Column, nir: Column) -> Column:
    return _ratio(green - nir, green + nir)


_BUILDERS = {
    "NDVI": lambda b, one: ndvi(b["red"], b["nir"]),
    "EVI": lambda b, one: evi(b["red"], b["nir"], b["blue"], one),
    "NDWI": lambda b, one: ndwi(b["green"], b["nir"]),
}


def vegetation_index(name: str, bands: dict[str, Column], one: float = 1.0) -> Column:
    """The index called ``name`` from band columns, reflectances by default."""
    return _BUILDERS[name.upper()](bands, one)


def with_indices(pixels: DataFrame) -> DataFrame:
    """Replace the ``*_dn`` columns by ``ndvi``, ``evi`` and ``ndwi``.

    The indices are ratios, so they are formed from digital numbers: sums and
    differences are then exact, and a denominator of zero is seen as zero.
    """
    masked = pixels.withColumns({b: valid_dn(F.col(f"{b}_dn")) for b in BANDS})
    bands = {b: F.col(b) for b in BANDS}
    return masked.withColumns(
        {name.lower(): vegetation_index(name, bands, DN_SCALE) for name in INDEX_NAMES}
    ).drop(*bands, *[f"{b}_dn" for b in BANDS])


def processed_indices() -> Column:
    return F.array(*[F.lit(n) for n in INDEX_NAMES])
