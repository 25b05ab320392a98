"""Exploration numbers behind the credit and titles charts: counts,
cross-tables, quantiles, histograms, top-k shares, date and duration
parsing. Only the numbers are built; drawing is the caller's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import aggregates as A
from ledgerline.operators import relational as RL

# ---- fixed values --------------------------------------------------------
# Display names of the checking-account classes of the credit data set.
STATUS_DISPLAY = {
    "no checking account": "no checking account",
    "0<= ... < 200 DM": "0< ... < 200 DM",
    "... >= 200 DM / salary for at least 1 year": ">=200 DM / salary for at least 1 year",
    "... < 0 DM": "< 0 DM",
}
SAVINGS_DISPLAY = {
    "... <  100 DM": "... < 100 DM",
    "100 <= ... <  500 DM": "100 <= ... < 500 DM",
}
SAVINGS_ORDER = ("unknown/no savings account", "... < 100 DM", "100 <= ... < 500 DM",
                 "... >= 1000 DM", "500 <= ... < 1000 DM")
RISK_CLASSES = ("good", "bad")
AGE_EDGES = tuple(range(20, 76, 5))          # 20, 25, ..., 75: 11 bins
MOVIE, SHOW = "Movie", "TV Show"
MOVIE_BINS, SEASON_BINS = 30, 20


def remap_values(df: DataFrame, col: str, mapping: Mapping[str, str],
                 out: str | None = None) -> DataFrame:
    """Display values by dictionary, unmapped values unchanged."""
    return df.withColumn(out or f"{col}_display", S.remap(col, mapping))


def with_display(df: DataFrame) -> DataFrame:
    """The credit data set's status and savings classes as shown."""
    return remap_values(remap_values(df, "status", STATUS_DISPLAY), "savings", SAVINGS_DISPLAY)


def crosstab_zero_filled(df: DataFrame, row: str, row_values: Sequence[str],
                         col: str = "credit_risk",
                         col_values: Sequence[str] = RISK_CLASSES) -> DataFrame:
    """E12 + D3: class counts per category for a fixed category list, zero
    filled, in list order."""
    return A.crosstab(df, row, col, row_values, col_values)


def age_quartiles(df: DataFrame, by: Sequence[str] = ("savings_display", "credit_risk"),
                  col: str = "age", approx: bool = False) -> DataFrame:
    """Quartiles (violin inner lines) per category and class. Ages are
    whole years, so a group's value map has some 120 entries at most."""
    return A.group_quantiles(df, list(by), col, (0.25, 0.5, 0.75), approx=approx,
                             names=["q1", "median", "q3"], method="map")


def age_histogram(df: DataFrame, col: str = "age", edges: Sequence[float] = AGE_EDGES,
                  by: str = "credit_risk") -> DataFrame:
    """Fixed-edge histogram per class and overall, one pass."""
    return A.histogram(df, col, edges, by=by, total=True)


def scatter_points(df: DataFrame, x: str, y: str, z: str | None = None, by: str | None = None) -> DataFrame:
    """The points of a 2-D/3-D scatter with their class, all of them."""
    return df.select(x, y, *([z] if z else []), *([by] if by else []))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E20."""
    return A.null_count(df, cols)


def top_countries_missing(titles: DataFrame, k: int = 5) -> DataFrame:
    """Top-k countries among titles without a director."""
    return A.value_counts(RL.where_null(titles, "director"), "country", k=k)


def top_countries(titles: DataFrame, k: int = 5) -> DataFrame:
    """Top-k countries by number of titles."""
    return A.value_counts(titles, "country", k=k)


def top_countries_share(titles: DataFrame, k: int = 5) -> DataFrame:
    """Pie numbers: count and share of the k rows' total."""
    return A.top_k_share(titles, "country", k)


def ratings_min_count(titles: DataFrame, min_count: int = 50) -> DataFrame:
    """C4: movie ratings with at least ``min_count`` titles (exact counts)."""
    return A.value_counts(RL.where_eq(titles, type=MOVIE), "rating", min_count=min_count)


def top_countries_rated(titles: DataFrame, rating: str = "TV-MA", k: int = 3) -> DataFrame:
    """Top-k countries of movies with one rating."""
    return A.value_counts(RL.where_eq(titles, type=MOVIE, rating=rating), "country", k=k)


def with_added_date(titles: DataFrame, trim: bool = False) -> DataFrame:
    return titles.withColumn("added_date", S.parse_long_date("date_added", trim=trim))


def parse_long_date(titles: DataFrame) -> DataFrame:
    """B16."""
    return with_added_date(titles).select("show_id", "date_added", "added_date")


def monthly_mean_count(titles: DataFrame) -> DataFrame:
    """Movies added per (year, month), mean over years per month."""
    movies = with_added_date(RL.where_eq(titles, type=MOVIE))
    return A.monthly_mean_count(movies, "added_date")


def titles_per_year(titles: DataFrame) -> DataFrame:
    """Movies added per year."""
    movies = with_added_date(RL.where_eq(titles, type=MOVIE))
    return A.count_by_year(movies, "added_date")


def duration_split(titles: DataFrame) -> DataFrame:
    """Minutes for movies, seasons for shows, from the duration text."""
    return titles.select(
        "show_id", "type", "duration",
        S.leading_int("duration", F.col("type") == MOVIE).alias("min"),
        S.leading_int("duration", F.col("type") == SHOW).alias("season"))


def duration_histogram(titles: DataFrame, movie_bins: int = MOVIE_BINS,
                       season_bins: int = SEASON_BINS) -> DataFrame:
    """Equal-width histograms of movie minutes and show seasons."""
    long = RL.to_long(duration_split(titles), ["show_id"], ["min", "season"], "kind", "value")
    return A.histogram_n(long, "value", {"min": movie_bins, "season": season_bins}, by="kind")


def box_stats(titles: DataFrame) -> DataFrame:
    """Box-plot numbers of movie minutes (whole minutes: few distinct
    values, so the value map of the quartiles stays small)."""
    return A.box_stats(duration_split(titles), "min", method="map")


def avg_duration_by_year(titles: DataFrame, year_from: int = 2000) -> DataFrame:
    """E16 (blank in the reference): mean duration per year added and type,
    from ``year_from`` on; minutes for movies, seasons for shows."""
    t = with_added_date(titles)
    dur = F.coalesce(S.leading_int("duration", F.col("type") == MOVIE),
                     S.leading_int("duration", F.col("type") == SHOW))
    return (t.select(F.year("added_date").alias("year"), "type", dur.alias("dur"))
            .filter((F.col("year") >= year_from) & F.col("dur").isNotNull())
            .groupBy("year", "type").agg(F.avg("dur").alias("avg_duration")))
