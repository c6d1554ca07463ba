"""Three trained text classifiers and their votes.

Naive Bayes (``operators.classify``) votes beside a multinomial logistic regression and a linear support
vector machine per class, both fitted by Spark ML: each step sums the loss' gradient over all rows in
a tree of partial sums, so only vectors as long as the hashed vocabulary times the classes reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.functions.lookups import CLASS_NAMES
from hazardlake.operators import classify as CL
from hazardlake.operators.common import checkpoint

#: Buckets of the hashed vocabulary; bounds a model's size at any input.
FEATURES = 1 << 14
#: Weight of the squared norm in both losses, and the most steps of a fit.
L2 = 1e-3
STEPS = 100
MODELS = ["naive_bayes", "logistic", "svm"]


@dataclass
class Voters:
    """The fitted models; ``features``, ``logistic`` and ``svm`` (one a class) are None where no labelled row exists."""

    bayes: CL.NaiveBayes
    features: PipelineModel | None = None
    logistic: LogisticRegressionModel | None = None
    svm: list[LinearSVCModel] | None = None


def _words(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("_tokens", F.coalesce(T.tokens(F.col(text_col)), F.array().cast("array<string>")))


def fit_voters(labelled: DataFrame, text_col: str, class_col: str, n_classes: int = len(CLASS_NAMES),
               features: int = FEATURES) -> Voters:
    """Fit all three on every row with a class in 0..n-1; a null text is an empty one, other rows are left out."""
    rows = checkpoint(labelled.where(F.col(class_col).between(0, n_classes - 1)).select(
        F.col(text_col).alias("_text"), F.col(class_col).cast("double").alias("_class")))
    bayes = CL.fit_naive_bayes(rows, "_text", "_class", n_classes)
    if rows.isEmpty():
        return Voters(bayes)
    # Term frequencies of unit length, so that a long text weighs as much as a short one.
    hashed = Pipeline(stages=[HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
                              Normalizer(inputCol="_tf", outputCol="_x", p=2.0)]).fit(_words(rows, "_text"))
    # Written once: five fits read it.
    train = checkpoint(hashed.transform(_words(rows, "_text")).select("_x", "_class"))
    fixed = {"featuresCol": "_x", "labelCol": "_label", "regParam": L2, "maxIter": STEPS, "standardization": False}
    logistic = LogisticRegression(predictionCol="_logistic", probabilityCol="_lp", rawPredictionCol="_lr",
                                  family="multinomial", **fixed).fit(train.withColumnRenamed("_class", "_label"))
    svm = [LinearSVC(predictionCol=f"_p{i}", rawPredictionCol=f"_m{i}", **fixed)
           .fit(train.select("_x", (F.col("_class") == i).cast("double").alias("_label"))) for i in range(n_classes)]
    return Voters(bayes, hashed, logistic, svm)


def model_votes(voters: Voters, texts: DataFrame, key: str, text_col: str = "text",
                names: list[str] = CLASS_NAMES) -> DataFrame:
    """(key, model, label): one row per text and model; ``key`` identifies a text.

    The linear models score a text inside its row; Naive Bayes joins tokens with its counts. Without labelled
    rows no model votes.
    """
    if voters.features is None:
        return texts.select(key, F.lit(None).cast("string").alias("model"), F.lit(None).cast("string").alias("label")).limit(0)
    src = texts.select(key, text_col)
    bayes = CL.classify_sentences(voters.bayes, src, [key], text_col, names)
    scored = voters.logistic.transform(voters.features.transform(_words(src, text_col)))
    for one in voters.svm:
        scored = one.transform(scored)
    # The class whose own machine has the largest margin, ties to the first.
    margins = F.array(*[vector_to_array(f"_m{i}")[1] for i in range(len(voters.svm))])
    linear = scored.select(key, "_logistic", CL.argmax(margins).alias("_svm"))
    pair = [F.struct(F.lit(m).alias("model"), CL.class_name(F.col(c), names).alias("label"))
            for m, c in (("logistic", "_logistic"), ("svm", "_svm"))]
    return (bayes.select(key, F.lit("naive_bayes").alias("model"), "label")
            .unionByName(linear.select(key, F.inline(F.array(*pair)))))


def vote(voters: Voters, texts: DataFrame, key: str, text_col: str = "text", names: list[str] = CLASS_NAMES) -> DataFrame:
    """(key, naive_bayes, logistic, svm, label, votes): each model's label and the most-voted one."""
    votes = checkpoint(model_votes(voters, texts, key, text_col, names))
    each = votes.groupBy(key).agg(*[F.max(F.when(F.col("model") == m, F.col("label"))).alias(m) for m in MODELS])
    return each.join(CL.majority_vote(votes, key, names=names), key)
