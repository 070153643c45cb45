"""Price models for all series at once.

Two models stand in for one boosted-tree library run per series:

* ridge regression per series. Spark sums exact moments (one partially aggregated row per
  series, whatever its length) and solves each row's 8 x 8 system in an unrolled elimination.
* one gradient-boosted tree model pooled over all series, by MLlib.

Both learn from causal features, the ones a forecast has.
"""

from decimal import Decimal

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import FEATURES
from harvestlens.operators.evaluation import clip_metrics, evaluate
from harvestlens.operators.features import KEYS
from harvestlens.operators.forecast import Scorer
from harvestlens.session import passing_tables

LABEL = "modal_price"
RIDGE = 1.5
#: What makes features and label whole numbers: sums of 7 and 14 cent amounts, a millionth of the deviation.
UNITS = {
    "lag_1": 100, "lag_7": 100, "lag_14": 100, "roll_mean_7": 700, "roll_mean_14": 1400, "roll_std_7": 1_000_000,
    "weekday_num": 1, "month": 1, LABEL: 100,
}


# -- ridge regression per series ----------------------------------------------------------


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def moments(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, n, complete (rows without NULL), sums s0.. and cross products p0_0.. of features and label (the last) per series.

    Features and label are whole numbers: cents, and for means and the deviation a unit that keeps their digits. So
    all sums are exact, each task combines its rows before the shuffle, and no order of rows changes a digit. A value beyond 18 or a sum beyond 38
    digits is NULL.
    """
    names = [*FEATURES, LABEL]
    whole = [f"TRY_CAST(floor(CAST({c} AS DOUBLE) * {UNITS[c]} + 0.5D) AS DECIMAL(18,0)) AS v{i}" for i, c in enumerate(names)]
    numbered = rows.selectExpr(*[f"`{k}`" for k in keys], *whole)
    present = " AND ".join(f"v{i} IS NOT NULL" for i in range(len(names)))
    sums = ["count(1) AS n", f"count_if({present}) AS complete", *(f"try_sum(v{i}) AS s{i}" for i in range(len(names)))]
    sums += [f"try_sum(v{i} * v{j}) AS p{i}_{j}" for i, j in _pairs(len(names))]
    return numbered.groupBy(*keys).agg(*map(F.expr, sums))


def standardised_system(stats: DataFrame, keys: list[str], penalty: float) -> DataFrame:
    """The ridge system of each series: symmetric a{i}_{j} (i <= j) and right side b{i}, beside means m{i} and spreads t{i}.

    Features are standardised over the training rows, so a{i}_{j} is their correlation, plus penalty / n on the diagonal. A
    feature that never changes has no correlation with any other. n^2 times a covariance (c{i}_{j}) is exact before it
    becomes a double, and t{i} is n times the standard deviation.
    """
    size, own = len(FEATURES), [*[f"`{k}`" for k in keys], "n", "complete"]
    product = lambda x, y: f"try_multiply({x}, {y})"
    centred = [
        f"CAST(try_subtract({product('CAST(n AS DECIMAL(10,0))', f'p{i}_{j}')}, {product(f's{i}', f's{j}')}) AS DOUBLE) AS c{i}_{j}"
        for i, j in _pairs(size + 1)
    ]
    means = [f"CAST(s{i} AS DOUBLE) / n / {UNITS[c]} AS m{i}" for i, c in enumerate([*FEATURES, LABEL])]
    moved = stats.selectExpr(*own, *means, *centred).selectExpr("*", *[f"sqrt(c{i}_{i}) AS t{i}" for i in range(size)])
    entries = [
        f"CASE WHEN t{i} > 0 THEN 1.0D WHEN t{i} = 0 THEN 0.0D END + {float(penalty)!r}D / n AS a{i}_{j}" if i == j else
        f"CASE WHEN t{i} > 0 AND t{j} > 0 THEN c{i}_{j} / (t{i} * t{j}) WHEN c{i}_{j} IS NOT NULL THEN 0.0D END AS a{i}_{j}"
        for i, j in _pairs(size)
    ]
    right = [f"CASE WHEN t{i} > 0 THEN c{i}_{size} / (t{i} * n) WHEN c{i}_{size} IS NOT NULL THEN 0.0D END AS b{i}" for i in range(size)]
    return moved.selectExpr(*own, *[f"m{i}" for i in range(size + 1)], *[f"t{i}" for i in range(size)], *entries, *right)


def solved_symmetric(system: DataFrame, size: int) -> DataFrame:
    """The solution w0.. of each row's symmetric system a{i}_{j}, b{i}, NULL where it has none, beside the other columns.

    The factorisation of a symmetric matrix without roots, unrolled: one projection a pivot, one a weight. Each reads
    the columns of the one before, so no expression grows.
    """
    other = [c for c in system.columns if c not in {*(f"a{i}_{j}" for i, j in _pairs(size)), *(f"b{i}" for i in range(size))}]
    other = [f"`{c}`" for c in other]
    done: list[str] = []
    for k in range(size):
        done += [f"a{k}_{j}" for j in range(k, size)] + [f"b{k}"]
        pivot = f"a{k}_{k}"
        left = [f"a{i}_{j} - try_divide(a{k}_{i} * a{k}_{j}, {pivot}) AS a{i}_{j}" for i in range(k + 1, size) for j in range(i, size)]
        left += [f"b{i} - try_divide(a{k}_{i} * b{k}, {pivot}) AS b{i}" for i in range(k + 1, size)]
        system = system.selectExpr(*other, *done, *left)
    for i in reversed(range(size)):
        rest = "".join(f" - a{i}_{j} * w{j}" for j in range(i + 1, size))
        system = system.selectExpr("*", f"try_divide(b{i}{rest}, a{i}_{i}) AS w{i}")
    return system.selectExpr(*other, *[f"w{i}" for i in range(size)])


def fit_ridge(train: DataFrame, keys: list[str] = KEYS, penalty: float = RIDGE) -> DataFrame:
    """One row per series: keys, intercept, coefficients, importances, and `error` where it has no solution.

    Built-in expressions over the moments, so one plan fits all series without a Python worker. A series without a
    solution doesn't stop the others; `solved` leaves it out. Importances are shares of the absolute standardised weights.
    """
    size, names = len(FEATURES), [f"`{k}`" for k in keys]
    rows = solved_symmetric(standardised_system(moments(train, keys), keys, penalty), size)
    finite = " AND ".join([*(f"m{i} IS NOT NULL" for i in range(size + 1)), *(f"t{i} IS NOT NULL" for i in range(size))])
    there = " AND ".join(f"w{i} IS NOT NULL AND NOT isnan(w{i})" for i in range(size))
    error = f"CASE WHEN complete < n OR NOT ({finite}) THEN 'moments are not finite' WHEN NOT ({there}) THEN 'singular system' END AS error"
    strength = " + ".join(f"abs(w{i})" for i in range(size)) + " AS strength"
    per_unit = [f"CASE WHEN t{i} > 0 THEN w{i} * n / t{i} * {UNITS[c]} / {UNITS[LABEL]} ELSE 0.0D END AS k{i}" for i, c in enumerate(FEATURES)]
    rows = rows.selectExpr(*names, error, strength, *[f"w{i}" for i in range(size)], *per_unit, *[f"m{i}" for i in range(size + 1)])
    intercept = f"m{size}" + "".join(f" - k{i} * m{i}" for i in range(size))
    shares = ", ".join(f"CASE WHEN strength > 0 THEN abs(w{i}) / strength ELSE 0.0D END" for i in range(size))
    per_unit = ", ".join(f"k{i}" for i in range(size))
    values = {"intercept": intercept, "coefficients": f"array({per_unit})", "importances": f"array({shares})"}
    model = ", ".join(f"'{name}', CASE WHEN error IS NULL THEN {value} END" for name, value in values.items())
    # behind a generator, as Spark would move a filter on a model below the elimination and copy it out for each pivot
    return rows.selectExpr(*names, f"inline(array(named_struct({model}, 'error', error)))")


def solved(fitted: DataFrame) -> DataFrame:
    """The models of the series that have one."""
    return fitted.filter("error IS NULL").drop("error")


def optimality(train: DataFrame, fitted: DataFrame, keys: list[str] = KEYS, penalty: float = RIDGE) -> DataFrame:
    """(keys, n, optimal): do the normal equations hold for every feature of a series, within 1e-6?

    With features standardised over the training rows, the sum of feature times residual has to
    be the penalty times the weight; the residuals themselves have to sum to 0.
    """
    rows = predict_ridge(train, fitted, keys)
    residual = F.col(LABEL).cast("double") - F.col("predicted")
    parts = [F.count(F.lit(1)).alias("n"), F.sum(residual).alias("e"), F.stddev_pop(F.col(LABEL).cast("double")).alias("sy")]
    for i, name in enumerate(FEATURES):
        x = F.col(name).cast("double")
        parts += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.sum(x * residual).alias(f"xe{i}")]
    sums = rows.groupBy(*keys).agg(*parts).join(fitted.select(*keys, "coefficients"), keys)
    bound = 1e-6 * F.col("n") * F.greatest(F.col("sy"), F.lit(1.0))
    holds = F.abs("e") <= bound
    for i in range(len(FEATURES)):
        weight = F.col("coefficients")[i] * F.col(f"s{i}")
        gradient = F.try_divide(F.col(f"xe{i}") - F.col(f"m{i}") * F.col("e"), F.col(f"s{i}"))
        constant = F.col(f"s{i}") <= 1e-7 * F.greatest(F.lit(1.0), F.abs(F.col(f"m{i}")))
        holds = holds & (constant | (F.abs(gradient - penalty * weight) <= bound))
    return sums.select(*keys, "n", holds.alias("optimal"))


def linear_prediction(features: dict[str, Column]) -> Column:
    """Intercept plus weighted features, with the model's columns in the frame."""
    return sum(
        (F.col("coefficients")[i] * features[name].cast("double") for i, name in enumerate(FEATURES)),
        F.col("intercept"),
    )


def predict_ridge(rows: DataFrame, models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of modelled series with `predicted`."""
    scored = rows.join(models.select(*keys, "intercept", "coefficients"), keys)
    return scored.withColumn(
        "predicted", linear_prediction({c: F.col(c) for c in FEATURES})
    ).drop("intercept", "coefficients")


def feature_importances(models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """(keys, feature_name, importance_score): eight rows per model."""
    names = F.array(*[F.lit(c) for c in FEATURES])
    pairs = F.explode(F.arrays_zip(names.alias("name"), F.col("importances").alias("score"))).alias("pair")
    return models.select(*keys, pairs).select(
        *keys,
        F.col("pair.name").alias("feature_name"),
        F.col("pair.score").cast("decimal(10,5)").alias("importance_score"),
    )


def model_evaluation(test: DataFrame, models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Stored-form metrics of the test rows, predictions taken to a hundredth of a cent so that all sums are exact."""
    rows = predict_ridge(test, models, keys)
    whole = F.floor(F.col("predicted") * 10000 + 0.5).cast("decimal(17,0)") * F.lit(Decimal("0.0001"))
    return clip_metrics(evaluate(rows.withColumn("predicted", whole.cast("decimal(17,4)")), keys)).drop("n")


def training_summary(guards: DataFrame, models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """(status, series): how many series were modelled, and how many failed at which guard."""
    fitted = models.select(*keys, F.lit(True).alias("fitted"), "error")
    outcome = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("failed: "), "error"))
        .when(F.col("fitted"), "succeeded")
        .when(F.col("status") == "ok", "failed: not fitted")
        .otherwise(F.concat(F.lit("failed: "), "status"))
    )
    counted = guards.join(fitted, keys, "left").groupBy(outcome.alias("status"))
    return counted.agg(F.count(F.lit(1)).alias("series"))


def missing_models(wanted: DataFrame, models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Series asked for that have no model."""
    return wanted.select(*keys).distinct().join(models.select(*keys), keys, "left_anti")


# -- pooled boosted trees -----------------------------------------------------------------

_PRICE_FEATURES = ["lag_1", "lag_7", "lag_14", "roll_mean_7", "roll_mean_14", "roll_std_7"]
_CALENDAR_FEATURES = ["weekday_num", "month"]


def relative_features(rows: DataFrame) -> DataFrame:
    """Prices relative to the 14-row mean, so series of any price level share one model."""
    level = F.when(F.col("roll_mean_14") > 0, F.col("roll_mean_14")).otherwise(1.0)
    return rows.withColumn("level", level).withColumns(
        {f"x_{c}": F.col(c) / F.col("level") for c in _PRICE_FEATURES}
        | {f"x_{c}": F.col(c).cast("double") for c in _CALENDAR_FEATURES}
    )


def relative_rows(rows: DataFrame) -> DataFrame:
    """relative_features with the relative price to learn."""
    return relative_features(rows).withColumn("target", F.col(LABEL).cast("double") / F.col("level"))


def best_of(errors: list[float], patience: int) -> tuple[int, bool]:
    """Trees up to the lowest error seen before `patience` more brought none lower, and whether such a wait is complete."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(
    train: DataFrame, keys: list[str] = KEYS, trees: int = 1000, validation_days: int = 30, patience: int = 30, rate: float = 0.1,
) -> PipelineModel:
    """Boosted trees over all series, as many as the last days of each series' training rows want; the test rows stay unseen.

    The fit ends when `patience` trees in a row brought no lower squared error on those days, and keeps the trees up to the lowest; `trees`
    only bounds a fit that keeps improving. The budget doubles until the wait is complete: a fit's first trees are
    the same for any budget, so the last fit, cut to the best number, is a fit with that budget.
    """
    last = F.max("arrival_date").over(W.partitionBy(*keys))
    rows = relative_rows(train).withColumn("held_out", F.col("arrival_date") > F.date_sub(last, validation_days))
    columns = [f"x_{c}" for c in _PRICE_FEATURES + _CALENDAR_FEATURES]
    assembler = VectorAssembler(inputCols=columns, outputCol="features")

    def fitted(learnt: DataFrame, n: int) -> PipelineModel:
        boosted = GBTRegressor(
            labelCol="target", predictionCol="relative", maxIter=n, stepSize=rate, maxDepth=5,
            subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42,
        )
        return Pipeline(stages=[assembler, boosted]).fit(learnt)

    with passing_tables(train.sparkSession, "boosted") as keep:
        kept = keep(rows.select(*columns, "target", "held_out"), "rows")
        learnt, held_out = kept.filter("not held_out"), assembler.transform(kept.filter("held_out"))
        budget = min(trees, 2 * patience)
        while True:
            model = fitted(learnt, budget)
            best, done = best_of(model.stages[-1].evaluateEachIteration(held_out, "squared"), patience)
            if done or budget >= trees:
                return model if best == budget else fitted(learnt, best)
            budget = min(trees, 2 * budget)


def predict_boosted(rows: DataFrame, model: PipelineModel, keys: list[str] = KEYS) -> DataFrame:
    scored = model.transform(relative_features(rows))
    return scored.withColumn("predicted", F.col("relative") * F.col("level")).select(
        *rows.columns, "predicted"
    )


def boosted_scorer(model: PipelineModel) -> Scorer:
    """The boosted model as a predictor over frames, for `stepwise_forecast`."""

    def score(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        return predict_boosted(rows.withColumns(values), model).select(*rows.columns, F.col("predicted").alias("raw"))

    return score


def boosted_importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature_name, importance_score) of the boosted model, eight rows that sum to 1."""
    names = _PRICE_FEATURES + _CALENDAR_FEATURES
    scores = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(names, scores, strict=True)), "feature_name string, importance_score double")
    return rows.withColumn("importance_score", F.col("importance_score").cast("decimal(10,5)"))
