"""Schemas of the domain tables."""

from pyspark.sql import types as T

LONLAT = T.StructType(
    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]
)

AOI = T.StructType(
    [
        T.StructField("aoi_id", T.StringType()),
        T.StructField("feature_id", T.IntegerType()),
        T.StructField("ring", T.ArrayType(LONLAT)),
    ]
)

# GeoJSON FeatureCollection of polygons
GEOJSON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField("type", T.StringType()),
                                    # JSON text, as its depth depends on the type
                                    T.StructField("coordinates", T.StringType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

SCENES = T.StructType(
    [
        T.StructField("scene_id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("cloud_cover", T.DoubleType()),
        T.StructField("footprint", T.ArrayType(LONLAT)),
        T.StructField("assets", T.MapType(T.StringType(), T.StringType())),
    ]
)

TILES = T.StructType(
    [
        T.StructField("scene_id", T.StringType()),
        T.StructField("scene_date", T.DateType()),
        T.StructField("band", T.StringType()),
        T.StructField("tile_id", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("dx", T.DoubleType()),
        T.StructField("dy", T.DoubleType()),
        T.StructField("dn", T.ArrayType(T.IntegerType())),
    ]
)

WIDE_TILES = T.StructType(
    [f for f in TILES if f.name not in ("band", "dn")]
    + [T.StructField(f"{b}_dn", T.ArrayType(T.IntegerType())) for b in ("red", "nir", "green", "blue")]
)

PIXELS = T.StructType(
    [
        T.StructField("aoi_id", T.StringType()),
        T.StructField("scene_id", T.StringType()),
        T.StructField("scene_date", T.DateType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("red_dn", T.IntegerType()),
        T.StructField("nir_dn", T.IntegerType()),
        T.StructField("green_dn", T.IntegerType()),
        T.StructField("blue_dn", T.IntegerType()),
    ]
)

LOG_ENTRY = T.StructType(
    [
        T.StructField("scene_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("ndvi_mean", T.DoubleType()),
        T.StructField("vegetation_health", T.StringType()),
    ]
)

LOG_FILE = T.StructType(
    [
        T.StructField("scenes", T.ArrayType(LOG_ENTRY)),
        T.StructField("last_updated", T.StringType()),
    ]
)

VEGLOG = T.StructType(
    [
        T.StructField("aoi_id", T.StringType()),
        T.StructField("scene_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("ndvi_mean", T.DoubleType()),
        T.StructField("vegetation_health", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

CLIMATE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("temperature_max", T.DoubleType()),
        T.StructField("temperature_min", T.DoubleType()),
        T.StructField("temperature_avg", T.DoubleType()),
        T.StructField("precipitation", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("heat_stress_index", T.DoubleType()),
        T.StructField("cumulative_precip", T.DoubleType()),
        T.StructField("growing_degree_days", T.DoubleType()),
        T.StructField("water_stress_risk", T.IntegerType()),
    ]
)
