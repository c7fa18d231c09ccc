"""Feature preparation fitted on training rows and applied to any rows: batch, scoring requests or streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators import clean, features, quality
from lotwise.spec import DRAM, FeatureSpec

_TABLE = "kind string, feature string, text string, a double, b double"


@dataclass(frozen=True)
class Preparation:
    """Everything the transform needs, keyed by column name."""

    spec: FeatureSpec
    medians: dict[str, float]
    modes: dict[str, str]
    bounds: dict[str, tuple[float, float]]
    moments: dict[str, tuple[float, float]]
    codes: DataFrame

    def transform(self, df: DataFrame, scale: bool = True) -> DataFrame:
        """Impute, winsorise, log-scale, engineer, encode and scale."""
        out = self._encoded(df)
        return features.standardize(out, self.moments) if scale else out

    def transform_requests(self, df: DataFrame) -> DataFrame:
        """Same for raw scoring rows in which optional fields may be absent."""
        have = set(df.columns)
        wanted = [*self.spec.numeric, *self.spec.categorical, *self.spec.spatial]
        missing = {c: F.lit(None).cast("string" if c in self.spec.categorical else "double") for c in wanted if c not in have}
        return self.transform(quality.with_defaults(df.withColumns(missing), ()))

    def _encoded(self, df: DataFrame) -> DataFrame:
        return _encode(_engineered(df, self), self)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Parameter rows (kind, feature, text, a, b), to be stored as a table."""
        rows = [("median", c, None, float(v), None) for c, v in self.medians.items()]
        rows += [("mode", c, v, None, None) for c, v in self.modes.items()]
        rows += [("bound", c, None, float(lo), float(hi)) for c, (lo, hi) in self.bounds.items()]
        rows += [("moment", c, None, float(m), float(s)) for c, (m, s) in self.moments.items()]
        codes = self.codes.select(
            F.lit("code").alias("kind"), "feature", F.col("value").alias("text"), F.col("code").cast("double").alias("a"),
            F.lit(None).cast("double").alias("b"),
        )
        return spark.createDataFrame(rows, _TABLE).unionByName(codes)

    @classmethod
    def from_frame(cls, df: DataFrame, spec: FeatureSpec = DRAM) -> Preparation:
        rows = df.where("kind <> 'code'").collect()
        pick = lambda kind: [r for r in rows if r["kind"] == kind]
        codes = df.where("kind = 'code'").select("feature", F.col("text").alias("value"), F.col("a").cast("int").alias("code"))
        return cls(
            spec,
            {r["feature"]: r["a"] for r in pick("median")},
            {r["feature"]: r["text"] for r in pick("mode")},
            {r["feature"]: (r["a"], r["b"]) for r in pick("bound")},
            {r["feature"]: (r["a"], r["b"]) for r in pick("moment")},
            codes,
        )


def _imputed(df: DataFrame, p: Preparation) -> DataFrame:
    return clean.impute(df, {**p.medians, **p.modes})


def _engineered(df: DataFrame, p: Preparation) -> DataFrame:
    clipped = clean.winsorize(_imputed(df, p), p.bounds)
    return features.engineer(clean.log_scale(clipped, p.spec.log_scaled), "log")


def _encode(df: DataFrame, p: Preparation) -> DataFrame:
    return features.encode(df, p.codes, [c for c in p.spec.categorical if c in df.columns])


def fit(train: DataFrame, spec: FeatureSpec = DRAM, strict_bounds: bool = False) -> Preparation:
    """Three dependent passes: medians and modes; quartiles of the imputed rows; moments of the encoded rows.

    All of them read one copy of the columns they need, which is kept only while fitting.
    """
    numeric = [c for c in spec.numeric if c in train.columns]
    categorical = [c for c in spec.categorical if c in train.columns]
    needed = [c for c in train.columns if c in {*numeric, *categorical, *spec.all_features}]
    train = train.select(*needed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(train, spec, numeric, categorical, strict_bounds)
    finally:
        train.unpersist()


def _fit(train: DataFrame, spec: FeatureSpec, numeric: list[str], categorical: list[str], strict_bounds: bool) -> Preparation:
    medians = clean.fit_medians(train, numeric)
    modes = clean.fit_modes(train, categorical)
    codes, _ = features.small_or_stored(features.category_codes(clean.impute(train, modes), categorical))
    first = Preparation(spec, medians, modes, {}, {}, codes)
    bounds = clean.fit_winsor_bounds(_imputed(train, first), numeric, strict=strict_bounds)
    second = Preparation(spec, medians, modes, bounds, {}, codes)
    encoded = second._encoded(train)
    names = [c for c in spec.all_features if c in encoded.columns]
    return Preparation(spec, medians, modes, bounds, features.fit_moments(encoded, names), codes)
