"""Title list normalisation, the title x region licence grid, and title-id lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.domain import SERIES_WORDS_WIDE, content_type, non_blank
from ..functions.names import resolve_columns
from .dedupe import keep_first

# ---------------------------------------------------------------------------
# Synonyms, default regions and licence cost bands (USD).
# ---------------------------------------------------------------------------
GRID_ID_SYNONYMS = ("title_id", "movie_id", "imdb_id", "imdbid", "id")
GRID_NAME_SYNONYMS = ("title_name", "title", "name", "original_title", "movie_name")
GRID_TYPE_SYNONYMS = ("content_type", "media_type", "type", "title_type")
LOOKUP_ID_SYNONYMS = ("title_id", "imdb_id", "id")
DEFAULT_REGIONS = ("US", "CA", "GB", "IN", "BR", "MX", "DE", "JP")
MOVIE_COST_RANGE = (1_000_000, 15_000_000)
SERIES_COST_RANGE = (3_000_000, 25_000_000)
COST_STEP = 10_000
DEFAULT_LICENSE_YEAR = 2024
# ---------------------------------------------------------------------------


def normalize_titles(movies: DataFrame, max_titles: int | None = None) -> DataFrame:
    """(title_id, title_name, content_type) from a raw catalogue: synonyms resolved on trimmed
    names, values trimmed, blank or null ids and names dropped, one row per id (smallest name
    and type), content type by the wide series word list (trimmed; null -> movie).
    ``max_titles`` keeps the first n ids in id order."""
    cols = list(movies.columns)
    synonyms = {"id": GRID_ID_SYNONYMS, "name": GRID_NAME_SYNONYMS, "type": GRID_TYPE_SYNONYMS}
    pick = resolve_columns(cols, synonyms, ("id", "name"), "title list", strip=True)
    id_col, name_col, type_col = pick["id"], pick["name"], pick["type"]
    ctype = content_type(F.col(type_col), SERIES_WORDS_WIDE, trim=True) if type_col else F.lit("movie")
    work = movies.select(
        F.trim(F.col(id_col).cast("string")).alias("title_id"),
        F.trim(F.col(name_col).cast("string")).alias("title_name"),
        ctype.alias("content_type"),
    ).filter(non_blank(F.col("title_id")) & non_blank(F.col("title_name")))
    work = keep_first(work, ["title_id"])
    if max_titles:
        work = work.orderBy("title_id").limit(int(max_titles))
    return work


def parse_regions(text: str) -> list[str]:
    """'us, ca,,gb ' -> ['US', 'CA', 'GB'] (driver-side parameter parsing)."""
    return [r.strip().upper() for r in text.split(",") if r.strip()]


def regions_column(regions: str | Sequence[str]) -> Column:
    """Region list as an array column: split on commas, trim, upper-case, blanks dropped."""
    text = regions if isinstance(regions, str) else ",".join(regions)
    parts = F.transform(F.split(F.lit(text), ","), lambda x: F.upper(F.trim(x)))
    return F.filter(parts, lambda x: F.length(x) > 0)


def license_grid(titles: DataFrame, regions: str | Iterable[str] = DEFAULT_REGIONS,
                 license_year: int = DEFAULT_LICENSE_YEAR) -> DataFrame:
    """One row per title and region with the licence cost band of its content type.

    The region list is a parameter (a handful of codes), so the grid is an ``explode`` of a
    literal array on each title row: a narrow map, no join and no shuffle."""
    regions = regions if isinstance(regions, str) else list(regions)
    series = F.col("content_type") == "series"
    return titles.select(
        "title_id",
        "title_name",
        "content_type",
        F.explode(regions_column(regions)).alias("region"),
        F.lit(int(license_year)).alias("license_year"),
        F.when(series, F.lit(SERIES_COST_RANGE[0])).otherwise(F.lit(MOVIE_COST_RANGE[0])).cast("bigint").alias("cost_min_usd"),
        F.when(series, F.lit(SERIES_COST_RANGE[1])).otherwise(F.lit(MOVIE_COST_RANGE[1])).cast("bigint").alias("cost_max_usd"),
    )


def title_ids_from_first(spark, paths: Sequence[str]) -> DataFrame:
    """Distinct title ids from the first raw dataset folder that exists (e.g. licensing, then
    movies). Raises ``FileNotFoundError`` when none exists (no built-in fallback list)."""
    from ..sources.files import read_raw_csv

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        if hpath.getFileSystem(conf).exists(hpath):
            return distinct_title_ids(read_raw_csv(spark, path))
    raise FileNotFoundError(f"None of the title sources exists: {list(paths)}")


def distinct_title_ids(df: DataFrame) -> DataFrame:
    """Non-null distinct ids (as strings) of the first present id column."""
    col = resolve_columns(df.columns, {"id": LOOKUP_ID_SYNONYMS}, ("id",), "title source")["id"]
    return df.select(F.col(col).cast("string").alias("title_id")).dropna().distinct()
