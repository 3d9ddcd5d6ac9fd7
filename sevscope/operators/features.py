"""Feature engineering (H1-H7) on Spark ML primitives.

Design matrix = [standardised numerics] + [one-hot of each categorical]. Fitting
(train medians, vocabularies, means/std) happens once on the train frame; the
fitted spec then transforms any frame with literals and JVM transformers, so a
test frame never triggers a re-fit and nothing row-level reaches the driver.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .prefix import exact_medians


def mean_std(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column, one aggregate."""
    if not cols:
        return {}
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"),
                                             F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in cols}


def standardise(df: DataFrame, cols: list[str], stats: dict | None = None,
                zero_var_scale: float = 1.0) -> tuple[DataFrame, dict]:
    """(x - mean) / std with population std; a zero-variance column is divided by 1,
    so on its own frame it becomes 0 (H5)."""
    stats = stats if stats is not None else mean_std(df, cols)
    exprs = {}
    for c in cols:
        m, s = stats[c]
        scale = s if s and s > 0 else zero_var_scale
        exprs[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(scale)
    return df.withColumns(exprs), stats


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (2 * n_class) per class (H6)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return counts.withColumn("weight", F.lit(float(total)) / (2.0 * F.col("n")))


def balanced_weight_col(df: DataFrame, label: str, out: str = "weight",
                        return_total: bool = False):
    """Attach balanced class weights as a column (one aggregate, literals).

    With ``return_total`` also returns the weight total (= n with both classes)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = row["n"], row["pos"]
    neg = n - pos
    w1 = n / (2.0 * pos) if pos else 0.0
    w0 = n / (2.0 * neg) if neg else 0.0
    w = df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))
    if return_total:
        return w, float(pos * w1 + neg * w0)
    return w


def pos_weight_grid(df: DataFrame, label: str) -> DataFrame:
    """{1, neg/pos/2, neg/pos} with pos floored at 1 (H7)."""
    g = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos"))
    r = F.col("neg") / F.greatest(F.col("pos"), F.lit(1))
    arr = F.array(F.struct(F.lit(0).alias("option"), F.lit(1.0).alias("spw")),
                  F.struct(F.lit(1).alias("option"), (r / 2).alias("spw")),
                  F.struct(F.lit(2).alias("option"), r.alias("spw")))
    return g.select(F.inline(arr))


def pos_weight_col(df: DataFrame, label: str, spw: float, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


@dataclass
class FeatureSpec:
    """A fitted design-matrix recipe (H1-H4)."""
    numeric: list
    categorical: list
    medians: dict
    stats: dict
    encoder: PipelineModel | None
    scale_numeric: bool = True
    names: list = field(default_factory=list)
    output: str = "features"

    def transform(self, df: DataFrame, own_medians: bool = False) -> DataFrame:
        """``df`` with its design vector; missing numbers take the fitted medians, or with
        ``own_medians`` those of ``df`` itself (the pooled form of H2)."""
        medians = exact_medians(df, self.numeric) if own_medians else self.medians
        fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c) or 0.0))
                 for c in self.numeric}
        fills.update({c: F.coalesce(F.col(c).cast("string"), F.lit(S.UNKNOWN_CATEGORY))
                      for c in self.categorical})
        out = df.withColumns({f"__f_{c}": e for c, e in fills.items()})
        if self.scale_numeric:
            out, _ = standardise(out, [f"__f_{c}" for c in self.numeric],
                                 {f"__f_{c}": v for c, v in self.stats.items()})
        if self.encoder is not None:
            out = self.encoder.transform(out)
        parts = [f"__f_{c}" for c in self.numeric] + [f"__oh_{c}" for c in self.categorical]
        out = VectorAssembler(inputCols=parts, outputCol=self.output,
                              handleInvalid="keep").transform(out)
        return out.drop(*[f"__f_{c}" for c in self.numeric + self.categorical],
                        *[f"__ix_{c}" for c in self.categorical],
                        *[f"__oh_{c}" for c in self.categorical])


#: Values that are one-hot encoded at most, over all columns: the driver holds them and a coefficient each.
MAX_LEVELS = 200_000


def check_levels(df: DataFrame, cols: dict[str, str], most: int | None = None) -> None:
    """Raise where ``cols`` (column -> name for the message) have more distinct values than the driver should hold.

    Distinct values are counted on the executors, one row per column comes back; nothing is truncated.
    """
    most = MAX_LEVELS if most is None else most
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).alias("value")) for c, name in cols.items()])))
    sizes = dict(pairs.distinct().groupBy("name").count().collect())
    if sum(sizes.values()) > most:
        wide = ", ".join(f"{c} ({n})" for c, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])))
        raise ValueError(f"categorical features have more than {most} values in all: {wide}; group the rare ones or leave the column out")


def fit_features(train: DataFrame, features: list[str], scale_numeric: bool = True,
                 output: str = "features") -> FeatureSpec:
    """Fit medians / vocabularies / standardisation on ``train`` (H1, H2, H4).

    Numeric vs categorical follows the declared column types. One-hot keeps every
    seen level (``dropLast`` only drops the "unseen" slot), so an unseen or new
    level encodes as all zeros, like re-indexing dummies to the train columns. More than
    ``MAX_LEVELS`` values in all raise a ValueError.
    """
    types = {f.name: f.dataType for f in train.schema.fields}
    numeric = [c for c in features if S.is_numeric(types[c])]
    categorical = [c for c in features if c not in numeric]
    medians = exact_medians(train, numeric)
    filled = train.withColumns({
        **{f"__f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c) or 0.0))
           for c in numeric},
        **{f"__f_{c}": F.coalesce(F.col(c).cast("string"), F.lit(S.UNKNOWN_CATEGORY))
           for c in categorical}})
    stats = mean_std(filled, [f"__f_{c}" for c in numeric])
    stats = {c: stats[f"__f_{c}"] for c in numeric}
    encoder = None
    names = list(numeric)
    if categorical:
        check_levels(filled, {f"__f_{c}": c for c in categorical})
        stages = [StringIndexer(inputCols=[f"__f_{c}" for c in categorical],
                                outputCols=[f"__ix_{c}" for c in categorical],
                                stringOrderType="alphabetAsc", handleInvalid="keep"),
                  OneHotEncoder(inputCols=[f"__ix_{c}" for c in categorical],
                                outputCols=[f"__oh_{c}" for c in categorical],
                                # the indexer already appends an "unseen" slot; dropLast
                                # removes exactly that slot, so unseen/new levels -> zeros
                                dropLast=True, handleInvalid="error")]
        encoder = Pipeline(stages=stages).fit(filled)
        for c, labels in zip(categorical, encoder.stages[0].labelsArray):
            names += [f"{c}_{v}" for v in labels]
    return FeatureSpec(numeric, categorical, medians, stats, encoder, scale_numeric, names, output)


def standardise_vector(df: DataFrame, col: str = "features", out: str = "features_std") -> DataFrame:
    """Scale every slot of a vector column to unit variance (H3).

    Without centring, which k-means and Euclidean distances do not notice, so one-hot
    vectors stay sparse.

    Spark ML's scaler divides by the sample std; for k-means and silhouette this is
    a uniform rescaling of all axes and leaves assignments unchanged.
    """
    from pyspark.ml.feature import StandardScaler
    sc = StandardScaler(inputCol=col, outputCol=out, withMean=False, withStd=True)
    return sc.fit(df).transform(df)
