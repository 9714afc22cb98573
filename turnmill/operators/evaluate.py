"""Router evaluation against rule labels: accuracy, per-class recall,
confusions. Predictions come as a table ``(key, predicted)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def eval_pairs(truth: DataFrame, predictions: DataFrame, mapping: DataFrame, key: str = "conv_id") -> DataFrame:
    """Truth labels known to the mapping, paired with the prediction of the
    same example (equi-join on the key)."""
    t = truth.select(key, F.col("label").alias("true")).join(
        mapping.select(F.col("label").alias("true")), "true", "left_semi")
    return t.join(predictions.select(key, F.col("predicted").alias("pred")), key, "inner")


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("true") == F.col("pred")).alias("n_correct"),
    ).withColumn("accuracy", F.when(F.col("n_total") > 0, F.col("n_correct").cast("double") / F.col("n_total").cast("double")).otherwise(0.0))


def per_class(pairs: DataFrame) -> DataFrame:
    p = pairs.groupBy(F.col("true").alias("label")).agg(
        F.count_if(F.col("true") == F.col("pred")).alias("correct"), F.count(F.lit(1)).alias("total"))
    return p.withColumn("pct", F.col("correct").cast("double") * 100.0 / F.greatest(F.col("total"), F.lit(1)).cast("double"))


def confusions(pairs: DataFrame, top: int = fixed.TOP_CONFUSIONS) -> DataFrame:
    """Most frequent wrong (true, pred) pairs, ties by names."""
    c = pairs.where(F.col("true") != F.col("pred")).groupBy("true", "pred").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "true", "pred").limit(top)


def model_predictions(train: DataFrame, test: DataFrame, text: str = "input", num_features: int = 1 << 16,
                      max_iter: int = 30) -> DataFrame:
    """Trainable router on Spark ML: tokens -> hashed term counts -> IDF ->
    multinomial logistic regression, fit on ``train``, applied to ``test``.
    Returns ``key columns of test + predicted``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer

    indexer = StringIndexer(inputCol="label", outputCol="_y", handleInvalid="keep")
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern="\\W+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_x")
    lr = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=max_iter, family="multinomial")
    model = Pipeline(stages=[indexer, tok, tf, idf, lr]).fit(train)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=model.stages[0].labels)
    out = back.transform(model.transform(test))
    return out.drop("_tok", "_tf", "_x", "_y", "rawPrediction", "probability", "prediction")


def _log(x) -> Column:
    """ln in millionths, as an integer: sums of it are exact."""
    return F.round(F.log(x) * 1_000_000).cast("bigint")


def term_counts(train: DataFrame) -> DataFrame:
    """``label, term, n`` of tokenized examples."""
    return train.select("label", F.explode("tokens").alias("term")).groupBy("label", "term").agg(F.count(F.lit(1)).alias("n"))


def bayes_predictions(train: DataFrame, test: DataFrame, key: str = "conv_id") -> DataFrame:
    """Router as multinomial naive Bayes over grouped integer counts, add-one
    smoothing: ``key, label, predicted, score`` of tokenized ``test``
    examples, score in millionths of a natural log. Ties go to the smaller
    label. Terms that training has not seen count for every label.

    A label's sums are one row each (a handful); a test term meets its
    counts in an equi-join, never all labels."""
    counts = term_counts(train)
    size = counts.select(F.count_distinct("term").alias("v"))
    docs = train.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    of_label = docs.join(counts.groupBy("label").agg(F.sum("n").alias("terms")), "label", "left")
    v = size.first()["v"]
    labels = of_label.orderBy("label").collect()  # one row per label
    total = sum(r["docs"] for r in labels)
    if not total:
        return test.select(key, "label", F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("bigint").alias("score"))
    base = F.array(*[F.struct(F.lit(r["label"]).alias("l"), (_log(F.lit(r["docs"])) - _log(F.lit(total))).alias("prior"),
                              _log(F.lit((r["terms"] or 0) + v)).alias("norm")) for r in labels])
    flat = test.select(key, F.explode("tokens").alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    hits = flat.join(counts, "term").groupBy(key, "label").agg(F.sum(F.col("tf") * _log(F.col("n") + 1)).alias("s"))
    rows = test.select(key, "label", F.size("tokens").cast("bigint").alias("t"), F.explode(base).alias("b"))
    rows = rows.join(hits.withColumnRenamed("label", "_l"), (rows[key] == hits[key]) & (F.col("b.l") == F.col("_l")), "left").drop(hits[key])
    score = F.col("b.prior") + F.coalesce("s", F.lit(0)) - F.col("t") * F.col("b.norm")
    best = F.min(F.struct((-score).alias("less"), F.col("b.l").alias("l"))).alias("b")
    return rows.groupBy(key, "label").agg(best).select(key, "label", F.col("b.l").alias("predicted"), (-F.col("b.less")).alias("score"))
