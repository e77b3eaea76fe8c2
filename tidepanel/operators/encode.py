"""Encoding and scaling.

Fitted transforms learn a bounded set of statistics (one row of numbers, or a
level list with a size limit) from ``fit_df`` -- the training rows -- and apply
them as literals in a single ``select``: no join, no second pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.columns import date_ordinal
from tidepanel.operators import impute
from tidepanel.operators.derive import sorted_levels
from tidepanel.operators.quantiles import DEFAULT_ACCURACY, quantile_values


def _level_name(prefix: str, level) -> str:
    return f"{prefix}_{level}"


def one_hot(df: DataFrame, col: str, *, levels=None, fit_df: DataFrame | None = None,
            prefix: str | None = None, drop_source: bool = True,
            handle_unknown: str = "ignore", max_levels: int = 10_000) -> DataFrame:
    """One 0/1 int column per sorted level (all levels kept).

    Missing values and levels unseen in ``fit_df`` give all zeros
    (``handle_unknown='ignore'``); ``'error'`` raises when ``df`` holds a level
    that the fitted list lacks.
    """
    prefix = prefix or col
    if levels is None:
        levels = sorted_levels(fit_df if fit_df is not None else df, col, max_levels=max_levels)
    if handle_unknown == "error":
        unseen = df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(levels))).limit(1).count()
        if unseen:
            raise ValueError(f"{col} holds levels not seen when fitting")
    out = df.withColumns({
        _level_name(prefix, lv): F.when(F.col(col) == F.lit(lv), F.lit(1)).otherwise(F.lit(0))
        for lv in levels})
    return out.drop(col) if drop_source else out


def dummies(df: DataFrame, col: str, *, prefix: str | None = None, levels=None) -> DataFrame:
    """Dummy columns of every level (missing -> zeros), source dropped."""
    return one_hot(df, col, levels=levels, prefix=prefix)


# ---- numeric scalers -----------------------------------------------------------

def fit_standard(fit_df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """mean and population sigma per column (scale 1 when sigma is 0)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    row = fit_df.agg(*aggs).first()
    out = {}
    for c in cols:
        m, s = row[f"{c}__m"], row[f"{c}__s"]
        out[c] = (m, s if s else 1.0)
    return out


def fit_robust(fit_df: DataFrame, cols, *, exact: bool = True,
               accuracy: int = DEFAULT_ACCURACY) -> dict[str, tuple[float, float]]:
    """median and IQR per column (scale 1 when the IQR is 0)."""
    q = quantile_values(fit_df, cols, [0.25, 0.5, 0.75], exact=exact, accuracy=accuracy)
    out = {}
    for c in cols:
        lo, med, hi = q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]
        iqr = (hi - lo) if hi is not None and lo is not None else None
        out[c] = (med, iqr if iqr else 1.0)
    return out


def apply_scaling(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(float(s))
        for c, (m, s) in stats.items()})


def standard_scale(df: DataFrame, cols, *, fit_df: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population sigma of ``fit_df``; NULL stays NULL."""
    return apply_scaling(df, fit_standard(fit_df if fit_df is not None else df, cols))


def robust_scale(df: DataFrame, cols, *, fit_df: DataFrame | None = None, exact: bool = True,
                 accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """E5: (x - median) / IQR of ``fit_df``; NULL stays NULL."""
    return apply_scaling(df, fit_robust(fit_df if fit_df is not None else df, cols,
                                        exact=exact, accuracy=accuracy))


# ---- polynomial expansion ---------------------------------------------------------

def polynomial_terms(cols, degree: int = 2) -> list[tuple[str, tuple[str, ...]]]:
    """Names and factor lists, degree-grouped: x_i, then x_i x_j (i <= j), ..."""
    terms = [(c, (c,)) for c in cols]
    prev = [(i,) for i in range(len(cols))]
    for _ in range(2, degree + 1):
        nxt = []
        for t in prev:
            for j in range(t[-1], len(cols)):
                nxt.append(t + (j,))
        for t in nxt:
            facs = tuple(cols[i] for i in t)
            name = " ".join(f"{c}^{facs.count(c)}" if facs.count(c) > 1 else c
                            for c in dict.fromkeys(facs))
            terms.append((name, facs))
        prev = nxt
    return terms


def polynomial(df: DataFrame, cols, degree: int = 2, *, keep_others: bool = True) -> DataFrame:
    """All products up to ``degree`` (no bias column), as named columns."""
    exprs = []
    for name, facs in polynomial_terms(cols, degree):
        e: Column = F.col(facs[0]).cast("double")
        for f in facs[1:]:
            e = e * F.col(f).cast("double")
        exprs.append(e.alias(name))
    others = [c for c in df.columns if c not in set(cols)] if keep_others else []
    return df.select(*others, *exprs)


# ---- column transformer ----------------------------------------------------------

@dataclass
class FeaturePlan:
    """Numeric branch (impute -> scale) + categorical branch (most
    frequent -> one-hot); other columns dropped (``keep`` are passed through)."""

    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    imputer: str = "median"          # median | mean
    scaler: str | None = "standard"  # standard | robust | None
    degree: int = 1
    keep: list[str] = field(default_factory=list)

    def fit(self, train: DataFrame) -> "FittedFeaturePlan":
        """All statistics from one materialisation of the training columns."""
        from tidepanel.session import right_sized
        base, _ = right_sized(train.select(*self.numeric, *self.categorical))
        try:
            if self.imputer == "median":
                fills = impute.fit_median(base, self.numeric)
            elif self.imputer == "mean":
                fills = impute.fit_mean(base, self.numeric)
            else:
                raise ValueError("imputer must be 'median' or 'mean'")
            filled = base.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c)
                                   for c in self.numeric])
            if self.scaler == "standard":
                scale = fit_standard(filled, self.numeric)
            elif self.scaler == "robust":
                scale = fit_robust(filled, self.numeric)
            elif self.scaler is None:
                scale = {c: (0.0, 1.0) for c in self.numeric}
            else:
                raise ValueError("scaler must be 'standard', 'robust' or None")
            modes, levels = {}, {}
            for c in self.categorical:
                levels[c], modes[c] = level_counts(base, c)
        finally:
            base.unpersist()
        return FittedFeaturePlan(self, fills, scale, modes, levels)


def level_counts(df: DataFrame, col: str, max_levels: int = 100_000):
    """Sorted levels and the most frequent one (ties -> smallest) from one
    group-by; the level list is bounded."""
    rows = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    if not rows:
        return [], None
    top = max(r["n"] for r in rows)
    return sorted(r[0] for r in rows), min(r[0] for r in rows if r["n"] == top)


@dataclass
class FittedFeaturePlan:
    plan: FeaturePlan
    fills: dict
    scale: dict
    modes: dict
    levels: dict

    @property
    def base_names(self) -> list[str]:
        """Scaled numeric columns, then the dummies."""
        return list(self.plan.numeric) + [
            _level_name(c, lv) for c in self.plan.categorical for lv in self.levels[c]]

    @property
    def feature_names(self) -> list[str]:
        """Output feature names in order; products are of all base columns,
        dummies included."""
        if self.plan.degree == 1:
            return self.base_names
        return [n for n, _ in polynomial_terms(self.base_names, self.plan.degree)]

    def transform(self, df: DataFrame) -> DataFrame:
        p = self.plan
        base: dict[str, Column] = {}
        for c in p.numeric:
            m, s = self.scale[c]
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c]))
            base[c] = (x - F.lit(m)) / F.lit(float(s))
        for c in p.categorical:
            v = F.coalesce(F.col(c), F.lit(self.modes.get(c)))
            for lv in self.levels[c]:
                base[_level_name(c, lv)] = F.when(v == F.lit(lv), F.lit(1)).otherwise(F.lit(0))
        flat = df.select(*p.keep, *[e.alias(n) for n, e in base.items()])
        return flat if p.degree == 1 else polynomial(flat, self.base_names, p.degree)

    def names_table(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.feature_names)), "position int, feature string")


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Vector column for spark.ml estimators (errors on NULL input)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def standardized_table(df: DataFrame, *, date_col: str, numeric, categorical: str,
                       fit_df: DataFrame | None = None, ordinal_col: str = "Date_Ordinal") -> DataFrame:
    """Date ordinal + z-scores of ``numeric`` + dummies of ``categorical``,
    in one select."""
    st = fit_standard(fit_df if fit_df is not None else df, numeric)
    levels = sorted_levels(fit_df if fit_df is not None else df, categorical)
    exprs = [date_ordinal(F.col(date_col).cast("date")).alias(ordinal_col)]
    exprs += [((F.col(c).cast("double") - F.lit(m)) / F.lit(float(s))).alias(c)
              for c, (m, s) in st.items()]
    exprs += [F.when(F.col(categorical) == F.lit(lv), F.lit(1)).otherwise(F.lit(0))
              .alias(_level_name(categorical, lv)) for lv in levels]
    return df.select(*exprs)
