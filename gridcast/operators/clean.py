"""Schema-level selection, coercion, placeholder filling and imputation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.config import EXCLUDED_FEATURES, LAG_3D, WEEK_LAG
from gridcast.functions.scores import finite_or_null
from gridcast.operators.exact import exact_median
from gridcast.operators.ordered import WEEK, fill_both_ways, number_rows
from gridcast.session import materialize

NOT_FEATURES = ("for_date", "requirement", "zone")


def select_features(
    train: T.StructType, test: T.StructType, exclude: Iterable[str] = EXCLUDED_FEATURES,
    not_features: Iterable[str] = NOT_FEATURES,
) -> list[str]:
    """Numeric columns of both splits, without keys, target and excluded names."""
    skip = {c.lower() for c in (*exclude, *not_features)}
    numeric = {f.name.lower() for f in test if isinstance(f.dataType, T.NumericType)}
    return [f.name for f in train if isinstance(f.dataType, T.NumericType)
            and f.name.lower() in numeric and f.name.lower() not in skip]


def zone_features(df: DataFrame, columns: Sequence[str], zone: str = "zone", split: str = "split") -> DataFrame:
    """(zone, feature) for the features that have a value in each of the zone's splits."""
    seen = df.groupBy(zone, split).agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in columns])
    both = seen.groupBy(zone).agg(*[F.min(c).alias(c) for c in columns])
    kept = F.array(*[F.when(F.col(c), F.lit(c)) for c in columns])
    return both.select(zone, F.explode(F.array_compact(kept)).alias("feature"))


def without_absent(df: DataFrame, kept: DataFrame, columns: Sequence[str], zone: str = "zone") -> DataFrame:
    """``df`` with 0 in the features a zone does not have, which no model can then learn from."""
    has = kept.groupBy(zone).agg(*[F.max(F.col("feature") == c).alias(f"_has_{c}") for c in columns])
    return df.join(has, zone, "left").withColumns({
        c: F.when(F.coalesce(f"_has_{c}", F.lit(False)), F.col(c).cast("double")).otherwise(0.0) for c in columns}).select(*df.columns)


def bool_to_int(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in flags})


def rename_tag(df: DataFrame, renames: Mapping[str, str], constants: Mapping[str, object]) -> DataFrame:
    """Rename columns and add constant ones."""
    return df.withColumnsRenamed(dict(renames)).withColumns({c: F.lit(v) for c, v in constants.items()})


def clean_rows(
    df: DataFrame, numeric: Sequence[str], date: str = "for_date", target: str = "requirement",
) -> DataFrame:
    """Coerce to numbers, drop rows without date or target, then turn infinities into nulls."""
    def number(c: str) -> Column:
        v = F.col(c).try_cast("double")
        return F.when(~F.isnan(v), v)

    coerced = df.withColumns({c: number(c) for c in numeric}).dropna(subset=[date, target])
    return coerced.withColumns({c: finite_or_null(F.col(c)) for c in numeric})


def fill_zero_target(
    df: DataFrame, keys: Sequence[str] = ("zone", "split"), target: str = "requirement",
    order: Sequence[str] = ("for_date",), seconds: int = WEEK,
) -> DataFrame:
    """Zero placeholders take the last known value, or the first known one at the start."""
    return fill_both_ways(df, target, F.nullif(F.col(target), F.lit(0.0)), keys, order, seconds)


def fill_zero_lag(df: DataFrame, lag: str = LAG_3D, proxy: str = WEEK_LAG) -> DataFrame:
    c = F.col(lag).cast("double")
    return df.withColumn(lag, F.when(c == 0, F.col(proxy)).otherwise(c))


def impute_median(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], fit: Column | None = None,
) -> DataFrame:
    """Nulls take the column's median per key, learnt on the ``fit`` rows only."""
    learnt = exact_median(df if fit is None else df.where(fit), keys, columns)
    medians = learnt.select(*keys, *[F.col(c).alias(f"_m_{c}") for c in columns])
    return (
        df.join(medians, list(keys), "left")
        .withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in columns})
        .select(*df.columns)
    )


def impute_train_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return impute_median(df, columns, ["zone"], F.col("split") == "train")


def impute_split_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return impute_median(df, columns, ["zone", "split"])


def encode_category(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("zone",), fit: Column | None = None,
) -> DataFrame:
    """Strings to codes in sorted order, learnt on the ``fit`` rows; null and unseen give -1.

    The vocabulary is dealt into ranges of its own values; values are ranked inside a range and
    shifted by the counts of earlier ranges, so a wide vocabulary is not sorted in one task, however
    its values begin.
    """
    out = df
    for c in columns:
        vocab = (df if fit is None else df.where(fit)).where(F.col(c).isNotNull()).select(*keys, c).distinct()
        # written, since ranges come from a sample and must not change between uses
        dealt = materialize(vocab.repartitionByRange(*keys, c).withColumn("_range", F.spark_partition_id()))
        codes = number_rows(dealt, keys, [c], F.col("_range"), out="_code").drop("_range")
        out = (
            out.join(codes, [*keys, c], "left")
            .withColumn(c, F.coalesce(F.col("_code") - 1, F.lit(-1)).cast("int"))
            .select(*df.columns)
        )
    return out


def minmax_fit(df: DataFrame, columns: Sequence[str], fit: Column, key: str = "zone") -> DataFrame:
    """Per key: the minimum and the range of each column over the ``fit`` rows (range 0 becomes 1)."""
    stats = df.where(fit).groupBy(key).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns])
    width = {c: F.col(f"_hi_{c}") - F.col(f"_lo_{c}") for c in columns}
    return stats.select(
        key, *[F.col(f"_lo_{c}") for c in columns],
        *[F.when(width[c] == 0, 1.0).otherwise(width[c]).alias(f"_w_{c}") for c in columns])


def minmax_scale(df: DataFrame, scaler: DataFrame, columns: Mapping[str, str], key: str = "zone") -> DataFrame:
    """Add ``out = (column - min) / range`` for each ``column -> out``."""
    scaled = {o: (F.col(c) - F.col(f"_lo_{c}")) / F.col(f"_w_{c}") for c, o in columns.items()}
    return df.join(scaler, key, "left").withColumns(scaled).select(*df.columns, *columns.values())


def minmax_inverse(
    df: DataFrame, scaler: DataFrame, columns: Mapping[str, tuple[str, str]], key: str = "zone",
) -> DataFrame:
    """Add ``out`` on the original scale for each ``scaled -> (original column, out)``."""
    back = {o: F.col(s) * F.col(f"_w_{c}") + F.col(f"_lo_{c}") for s, (c, o) in columns.items()}
    return df.join(scaler, key, "left").withColumns(back).select(*df.columns, *[o for _, o in columns.values()])
