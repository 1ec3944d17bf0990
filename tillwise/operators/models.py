"""Models over feature tables and texts."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.expressions import count_if, ratio
from tillwise.functions.text import NOT_A_WORD
from tillwise.session import durable


@dataclass(frozen=True)
class Clusters:
    """``assignments`` (id, cluster); ``centers`` (cluster, size, center array);
    ``cost``, the sum of squared distances to the centers."""

    assignments: DataFrame
    centers: DataFrame
    cost: float


#: Features are counted in units of this fraction, so that their sums are exact.
UNITS = 10_000_000


def cluster(
    features: DataFrame, *, key: str, k: int = 8, iterations: int = 20, seed: int = 1
) -> Clusters:
    """k-means by Lloyd's steps from fixed first centers; the same on every run and cluster.

    First centers are k different points, the first in an order of their keys (whole numbers)
    that ``seed`` changes; fewer different points make fewer clusters. Each step is one
    aggregate over the features: rows go to the nearest center (of equally near ones the
    first), and sums of whole units and counts, so many as k and the number of features say,
    come back. The steps end when no center moves. A center without rows stays. Features are
    rounded to seven digits behind the point; a missing one counts as 0.
    """
    columns = [c for c in features.columns if c != key]
    unit = [
        F.coalesce(F.round(F.col(c).cast("double") * float(UNITS)), F.lit(0.0)).cast("decimal(28,0)").alias(c) for c in columns
    ]
    rows = durable(features.select(F.col(key), *unit))
    first = (
        rows.groupBy(*columns)
        .agg(F.min(_turn(F.col(key), seed)).alias("_first"))
        .orderBy("_first")
        .limit(k)
        .collect()
    )
    centers = [[float(r[c]) / UNITS for c in columns] for r in first]

    def placed() -> DataFrame:
        """Rows with the distances to all centers and the nearest one. The centers are one array
        in the plan, so that the code made for it serves all steps."""
        point = F.array(*[F.col(c).cast("double") / F.lit(float(UNITS)) for c in columns])
        every = F.array(*[F.array(*map(F.lit, center)) for center in centers]).cast("array<array<double>>")

        def far(center):
            squares = F.zip_with("_point", center, lambda p, v: (p - v) * (p - v))
            return F.aggregate(squares, F.lit(0.0), lambda x, y: x + y)

        near = (F.array_position("_far", F.array_min("_far")) - 1).cast("int")
        return rows.withColumn("_point", point).withColumn("_far", F.transform(every, far)).withColumn("cluster", near)

    for _ in range(iterations if centers else 0):
        sums = placed().groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in columns])
        moved = list(centers)
        for r in sums.collect():
            moved[r["cluster"]] = [float(r[c]) / (r["_n"] * float(UNITS)) for c in columns]
        if moved == centers:
            break
        centers = moved

    spark = rows.sparkSession
    table = spark.createDataFrame(list(enumerate(centers)), "cluster int, center array<double>")
    assigned = durable(placed().select(key, "cluster", F.array_min("_far").alias("_least")))
    sizes = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.round(F.col("_least") * 1e6).cast("decimal(28,0)")).alias("_cost")
    ).collect()
    known = spark.createDataFrame([(r["cluster"], r["size"]) for r in sizes if r["cluster"] is not None], "cluster int, size long")
    return Clusters(
        assignments=assigned.select(key, "cluster"),
        centers=table.join(F.broadcast(known), "cluster", "left").select(
            "cluster", F.coalesce("size", F.lit(0)).alias("size"), "center"
        ),
        cost=float(sum(r["_cost"] or 0 for r in sizes)) / 1e6,
    )


def _turn(key: Column, seed: int) -> Column:
    """A key's place in an order that ``seed`` changes, then the key."""
    prime = F.lit(1_000_003)
    return F.struct(F.pmod(F.pmod(key, prime) * 7919 + seed * 104_729, prime).alias("turn"), key.alias("key"))


def cluster_facts(features: DataFrame, found: Clusters, *, key: str) -> DataFrame:
    """One row of what must hold for clusters of ``features``: rows and keys assigned, the
    sum of the sizes, rows nearer to another center, centers that are not the mean of
    their rows (none once converged), and whether the cost is that of the assignments."""
    columns = [c for c in features.columns if c != key]
    centers = {r["cluster"]: r["center"] for r in found.centers.collect()}
    rows = features.join(found.assignments, key)

    def far(center):
        return sum(((F.col(c) - F.lit(v)) ** 2 for c, v in zip(columns, center)), F.lit(0.0))

    every = F.array(*[far(centers[i]) for i in sorted(centers)])
    spread = rows.select(
        key, F.element_at(every, F.col("cluster") + 1).alias("own"), F.array_min(every).alias("least")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        count_if(F.col("own") > F.col("least") * (1 + 1e-9) + 1e-6).alias("misplaced"),
        (F.abs(F.sum("own") - found.cost) <= 1e-6 * found.cost + 1e-6).alias("cost_agrees"),
    )
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(c).cast("double") for c in columns]).alias("mean"))
    off = F.exists(
        F.zip_with("mean", "center", lambda m, c: F.abs(m - c) > 1e-3 * (1 + F.abs(c))), lambda wrong: wrong
    )
    middle = found.centers.join(means, "cluster", "left").agg(
        F.sum("size").alias("n_sized"), count_if(off).alias("off_center")
    )
    return spread.withColumn("_one", F.lit(1)).join(middle.withColumn("_one", F.lit(1)), "_one").drop("_one")


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """x with matrix x = right, by elimination. A column that depends on those before it (its
    pivot is below 1e-10 of its diagonal) gets 0."""
    size = len(right)
    rows = [[*line, value] for line, value in zip(matrix, right)]
    for c in range(size):
        pivot = rows[c][c]
        if not pivot > 1e-10 * matrix[c][c]:
            rows[c] = [0.0] * (size + 1)
            continue
        rows[c] = [v / pivot for v in rows[c]]
        for i in range(size):
            if i != c:
                factor = rows[i][c]
                rows[i] = [v - factor * u for v, u in zip(rows[i], rows[c])]
    return [line[-1] for line in rows]


def _probability(columns: list[str], weights: list[float]) -> Column:
    margin = sum((F.col(f"`{c}`") * F.lit(w) for c, w in zip(columns, weights[1:])), F.lit(weights[0]))
    return 1 / (1 + F.exp(-margin))


def logistic_weights(
    rows: DataFrame, columns: list[str], label: str, *, iterations: int = 20, tolerance: float = 1e-9
) -> list[float]:
    """Intercept and weights of the unpenalised logistic regression of ``label`` (0 or 1) on
    ``columns`` by Newton's steps, each of them one aggregate: the sums of weighted products
    come to the driver, so many numbers whatever the rows.

    A step that lowers the likelihood is halved. It ends once no weight moves by more than
    ``tolerance`` of its size (at least of 1), or after ``iterations`` steps. A column that is
    constant, or that others before it determine, has weight 0. No rows give zeros.
    """
    # Other names than any column of the rows, and the intercept as a column of ones.
    used = rows.select(
        F.col(f"`{label}`").cast("double").alias("y"), F.lit(1.0).alias("x0"),
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns, 1)],
    ).dropna()
    names = [f"x{i}" for i in range(len(columns) + 1)]
    weight = F.col("p") * (1 - F.col("p"))
    sums = [F.sum((F.col("y") - F.col("p")) * F.col(a)) for a in names]
    sums += [F.sum(weight * F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    # log(1 + e^-m) without overflow, m being the margin on the side of the label.
    side = F.when(F.col("y") > 0, F.col("m")).otherwise(-F.col("m"))
    sums.append(F.sum(-F.greatest(-side, F.lit(0.0)) - F.log1p(F.exp(-F.abs(side)))))

    def at(weights):
        margin = sum((F.col(n) * F.lit(w) for n, w in zip(names, weights)), F.lit(0.0))
        found = used.withColumn("m", margin).withColumn("p", 1 / (1 + F.exp(-F.col("m")))).agg(*sums).first()
        return [v or 0.0 for v in found]

    size = len(names)
    weights, state = [0.0] * size, None
    step = [0.0] * size
    for _ in range(iterations + 1):
        found = at(weights)
        if state is not None and found[-1] < state[-1] - 1e-12 * abs(state[-1]):
            step = [s / 2 for s in step]
            weights = [w - s for w, s in zip(weights, step)]
            continue
        state, upper = found, iter(found[size:-1])
        matrix = [[0.0] * size for _ in names]
        for i in range(size):
            for j in range(i, size):
                matrix[i][j] = matrix[j][i] = next(upper)
        step = _solve(matrix, found[:size])
        if all(abs(s) <= tolerance * max(1.0, abs(w)) for s, w in zip(step, weights)):
            return [w + s for w, s in zip(weights, step)]
        weights = [w + s for w, s in zip(weights, step)]
    return weights


def _labelled(features: DataFrame, count: str, threshold: float | None) -> tuple[DataFrame, list[str]]:
    """The features as doubles, written once, with the column label; and their names there."""
    columns = [c for c in features.columns if c != count]
    names = [f"x{i}" for i in range(len(columns))]
    rows = durable(
        features.select(
            F.col(f"`{count}`").cast("double").alias("count"),
            *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(columns, names)],
        ).dropna()
    )
    if threshold is None:
        threshold = rows.agg(F.avg("count").alias("mean")).first()["mean"]
    return rows.select(*names, (F.col("count") > threshold).cast("double").alias("label")), names


def interest_weights(
    features: DataFrame, *, count: str, threshold: float | None = None, iterations: int = 20, tolerance: float = 1e-9
) -> DataFrame:
    """The weights that ``interest_classifier`` finds: feature (null: the intercept), weight."""
    rows, names = _labelled(features, count, threshold)
    weights = logistic_weights(rows, names, "label", iterations=iterations, tolerance=tolerance)
    columns = [None, *(c for c in features.columns if c != count)]
    return features.sparkSession.createDataFrame(list(zip(columns, weights)), "feature string, weight double")


def interest_classifier(
    features: DataFrame,
    *,
    count: str,
    threshold: float | None = None,
    iterations: int = 20,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Logistic regression of "count above threshold" on the other columns (see
    ``logistic_weights``), and its quality on the same rows: accuracy, auc, the four cells of
    the confusion matrix (n_<actual><predicted>) and the mean probability of label 1. The
    threshold defaults to the mean count. Rows with a null are left out."""
    rows, names = _labelled(features, count, threshold)
    weights = logistic_weights(rows, names, "label", iterations=iterations, tolerance=tolerance)
    # Equal rows must tie, whatever order their terms are added in.
    scored = rows.select("label", F.round(_probability(names, weights), 10).alias("score"))
    scored = scored.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    # All points of the curve: the default takes a thousand.
    auc = BinaryClassificationEvaluator(
        rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    ).evaluate(scored)
    cells = [
        count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"n_{a}{p}")
        for a in (0, 1)
        for p in (0, 1)
    ]
    return scored.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.lit(auc).alias("auc"),
        *cells,
        F.avg("score").alias("mean_probability"),
    )


def classifier_facts(quality: DataFrame) -> DataFrame:
    """One row of what must hold for ``interest_classifier``: rows per label, accuracy from the
    four cells, an area above one half, and, once converged, a mean probability equal to
    the share of label 1."""
    negatives, positives = F.col("n_00") + F.col("n_01"), F.col("n_10") + F.col("n_11")
    rows = negatives + positives
    return quality.select(
        negatives.alias("negatives"),
        positives.alias("positives"),
        (F.abs(F.col("accuracy") - ratio(F.col("n_00") + F.col("n_11"), rows)) < 1e-9).alias("accuracy_agrees"),
        F.col("auc").between(0.5, 1.0).alias("better_than_chance"),
        (F.abs(F.col("mean_probability") - ratio(positives, rows)) < 1e-3).alias("calibrated"),
    )


CLASSES = ("NEG", "NEUT", "POS")


def rating_class(rating):
    """1 and 2 are NEG, 3 is NEUT, 4 and 5 are POS."""
    return F.when(rating <= 2, "NEG").when(rating == 3, "NEUT").when(rating >= 4, "POS")


@dataclass(frozen=True)
class ReviewClasses:
    """``predictions`` (review_sk, rating, class) of the test rows; ``quality``, one
    row per class: its row of the confusion matrix, precision, recall, f1 and the
    accuracy over all classes."""

    predictions: DataFrame
    quality: DataFrame


def _log(value: float) -> float:
    return math.log(value) if value > 0 else -math.inf


def review_classifier(
    train: DataFrame,
    test: DataFrame,
    *,
    key: str,
    rating: str,
    text: str,
    smoothing: float = 1.0,
) -> ReviewClasses:
    """Multinomial naive Bayes over exact word counts; ``key`` tells the test rows apart.

    The model is a table with one row per word, written to the checkpoint folder. Test
    words meet it by an equi-join and only words are shuffled, never texts. Words that no
    training text has count for nothing. ``smoothing`` 0 is allowed, but then a word
    unseen in a class rules the class out; so is a class without training rows. Of
    equal scores (to nine decimals) the lower class wins.
    """
    words = F.filter(F.split(F.lower(F.col(text)), NOT_A_WORD), lambda w: w != "")

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(rating).isNotNull()).select(
            F.col(key).alias("review_sk"),
            F.col(rating).alias("rating"),
            rating_class(F.col(rating)).alias("actual"),
            words.alias("words"),
        )

    rows = labelled(train)
    per_class = [count_if(F.col("actual") == c).alias(c) for c in CLASSES]
    model = durable(rows.select("actual", F.explode("words").alias("word")).groupBy("word").agg(*per_class))
    docs = rows.agg(*per_class).first()
    sums = model.agg(F.count(F.lit(1)).alias("words"), *[F.sum(c).alias(c) for c in CLASSES]).first()

    def score(c: str):
        if not docs[c]:
            return F.lit(-math.inf)
        prior = _log(docs[c] + smoothing) - _log(sum(docs) + smoothing * sum(map(bool, docs)))
        whole = _log((sums[c] or 0) + smoothing * sums["words"])
        weight = F.when(F.col(c) + smoothing > 0, F.log(F.col(c) + smoothing) - whole).when(
            F.col(c).isNotNull(), -math.inf
        )
        return F.round(F.coalesce(F.sum(weight), F.lit(0.0)) + prior, 9)

    neg, neut, pos = (F.col(f"_{c}") for c in CLASSES)
    best = F.when((neg >= neut) & (neg >= pos), "NEG").when(neut >= pos, "NEUT").otherwise("POS")
    scored = durable(
        labelled(test)
        .withColumn("word", F.explode_outer("words"))
        .join(model, "word", "left")
        .groupBy("review_sk", "rating", "actual")
        .agg(*[score(c).alias(f"_{c}") for c in CLASSES])
        .select("review_sk", "rating", "actual", best.alias("class"))
    )
    return ReviewClasses(
        predictions=scored.select("review_sk", "rating", "class"), quality=_quality(scored)
    )


def _quality(scored: DataFrame) -> DataFrame:
    totals = scored.agg(
        *[
            count_if((F.col("actual") == a) & (F.col("class") == p)).alias(f"{a}_{p}")
            for a in CLASSES
            for p in CLASSES
        ]
    )
    every = sum((F.col(f"{a}_{p}") for a in CLASSES for p in CLASSES), F.lit(0))
    right = sum((F.col(f"{c}_{c}") for c in CLASSES), F.lit(0))

    def row(c: str):
        hit = F.col(f"{c}_{c}")
        precision = ratio(hit, sum((F.col(f"{a}_{c}") for a in CLASSES), F.lit(0)))
        recall = ratio(hit, sum((F.col(f"{c}_{p}") for p in CLASSES), F.lit(0)))
        return F.struct(
            F.lit(c).alias("label"),
            *[F.col(f"{c}_{p}").alias(f"as_{p.lower()}") for p in CLASSES],
            precision.alias("precision"),
            recall.alias("recall"),
            ratio(2 * precision * recall, precision + recall).alias("f1"),
            ratio(right, every).alias("accuracy"),
        )

    return totals.select(F.explode(F.array(*[row(c) for c in CLASSES])).alias("r")).select("r.*")
