"""Naive Bayes over ``documents``, by language and by the quality label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexistat.operators import classify
from lexistat.operators.regression import split_by_hash
from lexistat.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

HASH = "((doc_id * 2654435761) % 4294967296) / 4294967296.0"
LANGUAGE_SQL = "SELECT doc_id, text, lang AS label FROM documents"
QUALITY_SQL = "SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id)"


def model_sql(source: str) -> str:
    """Training texts, weights and the dense model: nb(label, term, lp), prior(label, n, lp)."""
    return rf"""
src AS ({source}),
tr AS (SELECT * FROM src WHERE {HASH} < {classify.TRAINING_SHARE}),
te AS (SELECT * FROM src WHERE NOT {HASH} < {classify.TRAINING_SHARE}),
tok AS (SELECT doc_id, term, count(*) AS tf FROM (
          SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM src)
        GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM tr)) / (1.0 + count(*))) + 1 AS idf
        FROM tok SEMI JOIN tr USING (doc_id) GROUP BY term),
raw AS (SELECT doc_id, term, tf * idf AS x FROM tok JOIN idf USING (term)),
w AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w FROM raw),
s AS (SELECT label, term, sum(w) AS s FROM w JOIN tr USING (doc_id) GROUP BY ALL),
total AS (SELECT label, sum(s) AS total FROM s GROUP BY label),
prior AS (SELECT label, count(*) AS n, ln(count(*) / (SELECT count(*) FROM tr)::DOUBLE) AS lp
          FROM tr GROUP BY label),
nb AS (SELECT p.label, i.term, s.s,
              ln((coalesce(s, 0) + 1) / (total + (SELECT count(*) FROM idf))) AS lp
       FROM prior p JOIN total USING (label) CROSS JOIN idf i
       LEFT JOIN s ON s.label = p.label AND s.term = i.term),
part AS (SELECT doc_id, nb.label, sum(w * lp) AS part FROM w SEMI JOIN te USING (doc_id)
         JOIN nb USING (term) GROUP BY ALL),
score AS (SELECT te.doc_id, te.label, p.label AS guess, p.lp + coalesce(part, 0) AS score
          FROM te CROSS JOIN prior p LEFT JOIN part ON part.doc_id = te.doc_id AND part.label = p.label),
pred AS (SELECT doc_id, any_value(label) AS label, arg_max(guess, (score, -rank)) AS predicted
         FROM (SELECT *, dense_rank() OVER (ORDER BY guess) AS rank FROM score) GROUP BY doc_id)
"""


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("label"))


def _qualities(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id")


def _model(spark: SparkSession, folder: str) -> classify.NaiveBayes:
    training, _ = split_by_hash(_languages(spark, folder), "doc_id", classify.TRAINING_SHARE)
    return classify.train(training)


def nb_priors(spark: SparkSession, folder: str) -> DataFrame:
    priors = _model(spark, folder).priors
    return priors.select("label", "n", F.round("log_prior", 6).alias("log_prior"))


QUERIES["nb_priors"] = nb_priors
ORACLES["nb_priors"] = f"""
WITH {model_sql(LANGUAGE_SQL)} SELECT label, n, round(lp, 6) AS log_prior FROM prior
"""


def nb_term_logprob(spark: SparkSession, folder: str) -> DataFrame:
    terms = _model(spark, folder).terms
    return terms.select("label", "term", F.round("log_prob", 6).alias("log_prob"))


QUERIES["nb_term_logprob"] = nb_term_logprob
ORACLES["nb_term_logprob"] = f"""
WITH {model_sql(LANGUAGE_SQL)}
SELECT label, term, round(lp, 6) AS log_prob FROM nb WHERE s IS NOT NULL
"""


def nb_scores(spark: SparkSession, folder: str) -> DataFrame:
    training, test = split_by_hash(_languages(spark, folder), "doc_id", classify.TRAINING_SHARE)
    scores = classify.class_scores(classify.train(training), test)
    return scores.select("doc_id", "label", F.round("score", 6).alias("score"))


QUERIES["nb_scores"] = nb_scores
ORACLES["nb_scores"] = f"""
WITH {model_sql(LANGUAGE_SQL)} SELECT doc_id, guess AS label, round(score, 6) AS score FROM score
"""


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return classify.train_and_test(_languages(spark, folder))[1]


def nb_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder)


QUERIES["nb_predict"] = nb_predict
ORACLES["nb_predict"] = f"WITH {model_sql(LANGUAGE_SQL)} SELECT doc_id, label, predicted FROM pred"


def nb_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return classify.accuracy(_judged(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


ACCURACY = "SELECT count(*) AS n, round(avg((label = predicted)::INT), 6) AS accuracy FROM pred"
QUERIES["nb_accuracy"] = nb_accuracy
ORACLES["nb_accuracy"] = f"WITH {model_sql(LANGUAGE_SQL)} {ACCURACY}"


def nb_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return classify.confusion(_judged(spark, folder))


CONFUSION = 'SELECT label, predicted, count(*) AS "count" FROM pred GROUP BY ALL'
QUERIES["nb_confusion"] = nb_confusion
ORACLES["nb_confusion"] = f"WITH {model_sql(LANGUAGE_SQL)} {CONFUSION}"


def nb_quality_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return classify.confusion(classify.train_and_test(_qualities(spark, folder))[1])


QUERIES["nb_quality_confusion"] = nb_quality_confusion
ORACLES["nb_quality_confusion"] = f"WITH {model_sql(QUALITY_SQL)} {CONFUSION}"
