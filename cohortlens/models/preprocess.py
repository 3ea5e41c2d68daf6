"""Model preprocessing (ML1-ML3, ML7, XP1) fitted on the training split.

Fitting needs only small statistics (category counts, per-feature medians, means and population
standard deviations); they are baked into a ``SQLTransformer`` statement plus a
``VectorAssembler``, so the fitted preprocessing is an ordinary saveable ``PipelineModel`` stage
that runs as codegen'd expressions at scoring time.

* categorical: a category seen in fewer than ``rare_fraction * n_train`` rows is pooled into an
  ``infrequent_sklearn`` slot (placed after the sorted frequent categories); an unseen value maps
  to that slot if it exists, else to all zeros; no level is dropped.
* numeric: exact interpolated median imputation, then (optionally) standardisation with the
  population standard deviation (zero variance -> scale 1).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.selection import quantiles

INFREQUENT = "infrequent_sklearn"


@dataclass
class PreprocessSpec:
    categorical: list[str]
    numeric: list[str]
    categories: dict[str, list[str]] = field(default_factory=dict)  # frequent, sorted
    has_infrequent: dict[str, bool] = field(default_factory=dict)
    has_null: dict[str, bool] = field(default_factory=dict)  # null is frequent: a level of its own
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    scaled: bool = True

    def feature_names(self) -> list[str]:
        """XP1: ``cat__<col>_<value>`` per one-hot slot, then ``num__<col>``."""
        names = []
        for c in self.categorical:
            names += [f"cat__{c}_{v}" for v in [*self.categories[c], *["None"] * self.has_null.get(c, False)]]
            if self.has_infrequent[c]:
                names.append(f"cat__{c}_{INFREQUENT}")
        return names + [f"num__{c}" for c in self.numeric]

    def slots_of(self) -> dict[str, tuple[int, int]]:
        """Each column's first slot and how many it fills."""
        out, at = {}, 0
        for c in self.categorical:
            n = len(self.categories[c]) + self.has_null.get(c, False) + self.has_infrequent[c]
            out[c], at = (at, n), at + n
        return out | {c: (at + i, 1) for i, c in enumerate(self.numeric)}

    def slot_columns(self) -> list[str]:
        return [f"_s{i}" for i in range(len(self.feature_names()))]


def _sql_literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_spec(train: DataFrame, categorical: list[str] | None = None, numeric: list[str] | None = None,
             rare_fraction: float = config.RARE_CATEGORY_FRACTION, scale: bool = True) -> PreprocessSpec:
    """Collect the training statistics (all bounded: categories per column, one value per feature)."""
    categorical = list(categorical or config.CATEGORICAL_FEATURES)
    numeric = list(numeric or config.NUMERIC_FEATURES)
    spec = PreprocessSpec(categorical, numeric, scaled=scale)
    med = quantiles(train, numeric)
    n = train.count()
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in categorical])
    counts = train.select(F.inline(pairs)).groupBy("col", "val").count()
    often = F.col("count") >= F.lit(rare_fraction * n)
    # one row a column: its frequent categories (at most 1 / rare_fraction) and whether it has others
    levels = {r["col"]: r for r in counts.groupBy("col").agg(
        F.collect_list(F.when(often, F.col("val"))).alias("known"), F.bool_or(often & F.col("val").isNull()).alias("null"),
        F.bool_or(~often).alias("rare")).collect()}
    for c in categorical:
        spec.categories[c] = sorted(levels[c]["known"]) if c in levels else []
        spec.has_null[c] = c in levels and levels[c]["null"]
        spec.has_infrequent[c] = c in levels and levels[c]["rare"]
    spec.medians = {c: med[c] if med[c] is not None else 0.0 for c in numeric}
    if scale:
        imputed = [F.coalesce(F.col(c).cast("double"), F.lit(spec.medians[c])) for c in numeric]
        stats = train.agg(*[F.avg(e).alias(f"m_{i}") for i, e in enumerate(imputed)],
                          *[F.stddev_pop(e).alias(f"s_{i}") for i, e in enumerate(imputed)]).first()
        for i, c in enumerate(numeric):
            spec.means[c] = float(stats[f"m_{i}"] or 0.0)
            s = float(stats[f"s_{i}"] or 0.0)
            spec.scales[c] = s if s > 0 else 1.0
    return spec


def unscaled(spec: PreprocessSpec) -> PreprocessSpec:
    """Same categories and medians without standardisation (tree models): no second pass."""
    return PreprocessSpec(spec.categorical, spec.numeric, dict(spec.categories), dict(spec.has_infrequent),
                          dict(spec.has_null), dict(spec.medians), scaled=False)


def _statement(spec: PreprocessSpec) -> str:
    exprs, slot = [], 0
    for c in spec.categorical:
        known = ", ".join(_sql_literal(v) for v in spec.categories[c])
        for v in spec.categories[c]:
            exprs.append(f"CAST(coalesce(CAST(`{c}` AS STRING) = {_sql_literal(v)}, false) AS DOUBLE) AS _s{slot}")
            slot += 1
        null = spec.has_null.get(c, False)
        if null:
            exprs.append(f"CAST((`{c}` IS NULL) AS DOUBLE) AS _s{slot}")
            slot += 1
        if spec.has_infrequent[c]:  # rare levels, a rare null among them, and levels never seen
            cond = f"CAST(`{c}` AS STRING) NOT IN ({known})" if known else "true"
            cond = f"CASE WHEN `{c}` IS NULL THEN {str(not null).lower()} ELSE {cond} END"
            exprs.append(f"CAST(({cond}) AS DOUBLE) AS _s{slot}")
            slot += 1
    for c in spec.numeric:
        e = f"coalesce(CAST(`{c}` AS DOUBLE), {spec.medians[c]!r})"
        if spec.scaled:
            e = f"(({e}) - {spec.means[c]!r}) / {spec.scales[c]!r}"
        exprs.append(f"{e} AS _s{slot}")
        slot += 1
    return "SELECT *, " + ", ".join(exprs) + " FROM __THIS__"


def build_preprocessor(spec: PreprocessSpec, output_col: str = "features") -> Pipeline:
    slots = spec.slot_columns()
    return Pipeline(stages=[SQLTransformer(statement=_statement(spec)),
                            VectorAssembler(inputCols=slots, outputCol=output_col, handleInvalid="keep")])


def drop_slots(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_s") and c[2:].isdigit()])


def fit_preprocessor(train: DataFrame, spec: PreprocessSpec) -> PipelineModel:
    return build_preprocessor(spec).fit(train)
