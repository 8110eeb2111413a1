"""Scoring and model-evaluation jobs: ROC curve (ties grouped), AUC,
Youden optimum, classification metrics, confusion matrix, champion choice
and credit scoring with pyspark.ml classifiers.

Scored population: ``documents`` with the ``labels`` table (label =
quality).  The evaluation score is document length; the fitted models use
length, language, source and the toxicity flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.windows import ordered_cumsums
from ledgerlake.registry import query, with_ctes
from ledgerlake.session import materialise
from ledgerlake.sources.tables import read


def scored(spark, d: str) -> DataFrame:
    doc = read(spark, d, "documents", "doc_id", "n_chars", "lang", "source")
    lab = read(spark, d, "labels", "doc_id", "quality", "toxic")
    return doc.join(lab, "doc_id").select("doc_id", "lang", "source", "toxic",
                                          F.col("quality").cast("int").alias("label"),
                                          F.col("n_chars").cast("double").alias("score"))


SCORED_SQL = """scored AS (
  SELECT d.doc_id, lang, source, toxic, CAST(quality AS INT) AS label, CAST(n_chars AS DOUBLE) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """TPR/FPR per distinct threshold (ties grouped into one point), Youden J
    and the optimum flag.  Grouping by score first makes the cumulative pass
    run over distinct thresholds, bucketed so no task sees every score."""
    g = df.groupBy(F.col(score).alias("Threshold")).agg(
        F.sum(F.col(label)).cast("long").alias("pos"), F.sum(1 - F.col(label)).cast("long").alias("neg"))
    c = ordered_cumsums(g, "Threshold", ["pos", "neg"], descending=True)
    r = c.select("Threshold", "pos", "neg",
                 (F.col("_cum_pos") / F.col("_tot_pos")).alias("TPR"),
                 (F.col("_cum_neg") / F.col("_tot_neg")).alias("FPR"),
                 ((F.col("_cum_pos") - F.col("pos")) / F.col("_tot_pos")).alias("_tpr_prev"),
                 (F.col("neg") / F.col("_tot_neg")).alias("_dfpr"))
    return r.withColumn("Youden_J", F.col("TPR") - F.col("FPR"))


@query("roc_curve", with_ctes(SCORED_SQL, """g AS (
  SELECT score AS Threshold, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY score)""",
    """c AS (SELECT Threshold, SUM(pos) OVER (ORDER BY Threshold DESC) AS cp, SUM(neg) OVER (ORDER BY Threshold DESC) AS cn,
         SUM(pos) OVER () AS tp, SUM(neg) OVER () AS tn FROM g)""") + """SELECT Threshold,
  round(cp / tp, 10) AS TPR, round(cn / tn, 10) AS FPR, round(cp / tp - cn / tn, 10) AS Youden_J,
  (cp / tp - cn / tn) = MAX(cp / tp - cn / tn) OVER () AS EsPuntoOptimo
FROM c""")
def q_roc_curve(spark, d):
    r = roc_curve(scored(spark, d))
    best = r.agg(F.max("Youden_J")).scalar()
    return r.select("Threshold", F.round("TPR", 10).alias("TPR"), F.round("FPR", 10).alias("FPR"),
                    F.round("Youden_J", 10).alias("Youden_J"), (F.col("Youden_J") == best).alias("EsPuntoOptimo"))


def auc(roc: DataFrame) -> DataFrame:
    """Trapezoid AUC: each point adds dFPR x (TPR + TPR_prev) / 2; with ties
    grouped the previous point is known from the row itself, so this is a
    plain aggregate (no ordering)."""
    return roc.agg(F.sum(F.col("_dfpr") * (F.col("TPR") + F.col("_tpr_prev")) / 2).alias("AUC_ROC"))


@query("auc_score", with_ctes(SCORED_SQL) + """SELECT round(
  (SUM(r) FILTER (WHERE label = 1) - COUNT(*) FILTER (WHERE label = 1) * (COUNT(*) FILTER (WHERE label = 1) + 1) / 2.0)
  / (COUNT(*) FILTER (WHERE label = 1) * COUNT(*) FILTER (WHERE label = 0)), 10) AS AUC_ROC,
  COUNT(*) FILTER (WHERE label = 1) AS n_pos, COUNT(*) FILTER (WHERE label = 0) AS n_neg
FROM (SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored) t""")
def q_auc_score(spark, d):
    """Trapezoid AUC; the oracle uses the rank-sum (Mann-Whitney) identity,
    which equals the trapezoid area with ties grouped."""
    s = scored(spark, d)
    a = auc(roc_curve(s))
    return a.select(F.round("AUC_ROC", 10).alias("AUC_ROC"),
                    s.agg(F.sum("label")).scalar().alias("n_pos"),
                    s.agg(F.sum(1 - F.col("label"))).scalar().alias("n_neg"))


@query("youden_optimum", with_ctes(SCORED_SQL, """g AS (
  SELECT score AS Threshold, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY score)""",
    """c AS (SELECT Threshold, SUM(pos) OVER (ORDER BY Threshold DESC) * 1.0 / SUM(pos) OVER ()
                - SUM(neg) OVER (ORDER BY Threshold DESC) * 1.0 / SUM(neg) OVER () AS j FROM g)""") + """SELECT
  max_by(Threshold, j) FILTER (WHERE j = (SELECT MAX(j) FROM c)) AS Threshold_Optimo_Youden, round(MAX(j), 10) AS Youden_J
FROM c""")
def q_youden_optimum(spark, d):
    """argmax_t (TPR - FPR); ties on J resolved to the highest threshold."""
    r = roc_curve(scored(spark, d))
    best = r.agg(F.max("Youden_J").alias("j"))
    top = r.join(best, r.Youden_J == best.j).agg(F.max("Threshold").alias("Threshold_Optimo_Youden"),
                                                 F.round(F.max("Youden_J"), 10).alias("Youden_J"))
    return top


def classification_metrics(pred: DataFrame, prob: str = "p", label: str = "label",
                           threshold: float = 0.5, eps: float = 1e-15) -> DataFrame:
    """Accuracy, precision, recall, F1, Brier and clipped log-loss in one
    conditional aggregation."""
    yhat = (F.col(prob) >= threshold).cast("int")
    y = F.col(label)
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    g = pred.agg(
        F.sum(((yhat == 1) & (y == 1)).cast("int")).alias("tp"), F.sum(((yhat == 1) & (y == 0)).cast("int")).alias("fp"),
        F.sum(((yhat == 0) & (y == 1)).cast("int")).alias("fn"), F.sum(((yhat == 0) & (y == 0)).cast("int")).alias("tn"),
        F.avg((F.col(prob) - y) ** 2).alias("brier"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("logloss"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    return g.select(
        "tp", "fp", "fn", "tn",
        F.round((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), 8).alias("Accuracy"),
        F.round(prec, 8).alias("Precision"), F.round(rec, 8).alias("Recall"),
        F.round(F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0), 8).alias("F1_Score"),
        F.round("brier", 8).alias("Brier_Score"), F.round("logloss", 8).alias("Log_Loss"))


def minmax_prob(df: DataFrame) -> DataFrame:
    """Score rescaled to [0, 1] by the population min/max (a deterministic
    probability proxy used to evaluate the metric operators)."""
    lo = df.agg(F.min("score")).scalar()
    hi = df.agg(F.max("score")).scalar()
    return df.withColumn("p", (F.col("score") - lo) / (hi - lo))


PROB_SQL = """pr AS (SELECT label, (score - lo) / (hi - lo) AS p
  FROM scored, (SELECT MIN(score) AS lo, MAX(score) AS hi FROM scored) m)"""


@query("classification_metrics", with_ctes(SCORED_SQL, PROB_SQL) + """, g AS (
  SELECT SUM(CASE WHEN p >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN p >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
         SUM(CASE WHEN p < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn, SUM(CASE WHEN p < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn,
         AVG((p - label) ^ 2) AS brier,
         AVG(-(label * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))) AS logloss
  FROM pr)
SELECT CAST(tp AS INT) AS tp, CAST(fp AS INT) AS fp, CAST(fn AS INT) AS fn, CAST(tn AS INT) AS tn,
  round((tp + tn) / (tp + fp + fn + tn), 8) AS Accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 8) AS Precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 8) AS Recall,
  round(CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0 THEN 2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0.0 END, 8) AS F1_Score,
  round(brier, 8) AS Brier_Score, round(logloss, 8) AS Log_Loss
FROM g""")
def q_classification_metrics(spark, d):
    return classification_metrics(minmax_prob(scored(spark, d)))


@query("confusion_matrix", with_ctes(SCORED_SQL, PROB_SQL) + """SELECT Cuadrante, CAST(COUNT(p) AS BIGINT) AS Conteo
FROM (VALUES ('TN', false, 0), ('FP', true, 0), ('FN', false, 1), ('TP', true, 1)) q(Cuadrante, es_positivo, es_bueno)
LEFT JOIN pr ON (p >= 0.5) = es_positivo AND label = es_bueno GROUP BY Cuadrante""")
def q_confusion_matrix(spark, d):
    m = classification_metrics(minmax_prob(scored(spark, d)))
    return m.select(F.expr("stack(4, 'TN', tn, 'FP', fp, 'FN', fn, 'TP', tp) AS (Cuadrante, Conteo)")).select(
        "Cuadrante", F.coalesce(F.col("Conteo"), F.lit(0)).cast("long").alias("Conteo"))


# ---------------------------------------------------------------------------
# Credit scoring with pyspark.ml (rows-only check: fitted models)
# ---------------------------------------------------------------------------

#: Bits of the hash that orders rows, and of one step of the search for a cut.
HASH_BITS, STEP_BITS = 60, 12


def _hash(id_col: str, seed: str):
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def split_by_label(df: DataFrame, label: str, id_col: str, fraction: float, seed: str, out: str = "en_prueba") -> DataFrame:
    """``df`` with a boolean column: of every label the rows with the least hashes of their id, ``fraction`` of them
    (rounded half up), are the test rows.

    The cut of a label is found digit by digit of the hash: each step counts the rows per label and digit inside the range
    left (2^STEP_BITS counts a label at most) and goes on in the digit that holds the wanted position.  Nothing is sorted, so a
    label of any size is split exactly.  Rows with one id go together; null ids and null labels are training rows."""
    h = df.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).select(F.col(label).alias("_l"), _hash(id_col, seed).alias("_h"))
    wanted = {r[0]: int(r[1] * fraction + 0.5) for r in h.groupBy("_l").count().collect()}  # one row per label
    cuts = {k: -1 for k, n in wanted.items() if n == 0}
    start = {k: 0 for k in wanted if k not in cuts}
    shift = HASH_BITS
    while start and shift > 0:
        shift -= STEP_BITS
        prefix = F.shiftright("_h", shift + STEP_BITS)
        inside = F.coalesce(*[F.when((F.col("_l") == F.lit(k)) & (prefix == a), F.lit(True)) for k, a in start.items()], F.lit(False))
        counts: dict = {}
        for r in h.where(inside).groupBy("_l", F.shiftright("_h", shift).alias("d")).count().orderBy("_l", "d").collect():
            counts.setdefault(r["_l"], []).append((r["d"], r["count"]))
        for k in list(start):
            for digit, n in counts[k]:
                if wanted[k] <= n:
                    break
                wanted[k] -= n
            start[k] = digit
            if wanted[k] == n or shift == 0:  # the whole digit belongs to the test rows
                cuts[k] = ((digit + 1) << shift) - 1
                del start[k]
    cut = F.coalesce(*[F.when(F.col(label) == F.lit(k), F.lit(c)) for k, c in cuts.items()], F.lit(-1)) if cuts else F.lit(-1)
    return df.withColumn(out, F.coalesce(_hash(id_col, seed) <= cut, F.lit(False)))


@query("credit_split", with_ctes(SCORED_SQL) + """SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (k <= floor(total * 0.25 + 0.5)) AS BIGINT) AS n_prueba,
  CAST(sum(doc_id) FILTER (k <= floor(total * 0.25 + 0.5)) AS BIGINT) AS suma_prueba
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id)) AS k, count(*) OVER (PARTITION BY label) AS total FROM scored) s GROUP BY label""")
def q_credit_split(spark, d):
    """Rows, test rows and the sum of their ids per label of the 75/25 split."""
    x = split_by_label(scored(spark, d), "label", "doc_id", 0.25, "42")
    return x.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("en_prueba").alias("n_prueba"), F.sum(F.when(F.col("en_prueba"), F.col("doc_id"))).alias("suma_prueba"))


def champion_select(metrics: DataFrame, models: list[str]) -> DataFrame:
    """``metrics`` with ``EsCampeon``: the model with the highest AUC, of equal ones the first of ``models``."""
    place = F.create_map(*[F.lit(v) for k, m in enumerate(models) for v in (m, -k)])[F.col("Modelo")]
    best = metrics.agg(F.max_by("Modelo", F.struct("AUC_ROC", place)).alias("m")).scalar()
    return metrics.withColumn("EsCampeon", F.col("Modelo") == best)


def credit_scoring(df: DataFrame, seed: int = 42, test_frac: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Three classifiers on an exact per-label split; returns (metrics per
    model with champion flag, scored test rows of the champion)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    x = split_by_label(df.withColumn("log_len", F.log1p("score")), "label", "doc_id", test_frac, str(seed))
    train, test = x.filter("not en_prueba"), x.filter("en_prueba")
    stages = [StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"], handleInvalid="keep"),
              OneHotEncoder(inputCols=["lang_i", "source_i"], outputCols=["lang_v", "source_v"], dropLast=True),
              VectorAssembler(inputCols=["log_len", "toxic", "lang_v", "source_v"], outputCol="features")]
    models = {"Regresion_Logistica_L2": LogisticRegression(regParam=0.01, maxIter=100),
              "Random_Forest_Classifier": RandomForestClassifier(numTrees=100, maxDepth=5, seed=seed),
              "Gradient_Boosting_Tree": GBTClassifier(maxIter=100, maxDepth=3, seed=seed)}
    # the feature stages are fitted once; every model reads the same written features
    prepared = Pipeline(stages=stages).fit(train)
    columns = ["doc_id", "label", "score", "features"]
    train, test = (materialise(prepared.transform(part).select(*columns)) for part in (train, test))
    mets, preds = [], {}
    for name, est in models.items():
        pr = materialise(est.fit(train).transform(test).select("doc_id", "label", "score", vector_to_array("probability")[1].alias("p")))
        preds[name] = pr
        roc = roc_curve(pr.select("label", F.col("p").alias("score")))
        m = classification_metrics(pr).withColumn("AUC_ROC", auc(roc).scalar()).withColumn("Modelo", F.lit(name))
        mets.append(m)
    allm = mets[0]
    for m in mets[1:]:
        allm = allm.unionByName(m)
    return champion_select(allm, list(models)), preds


@query("credit_scoring")
def q_credit_scoring(spark, d):
    m, _ = credit_scoring(scored(spark, d))
    return m.select("Modelo", "AUC_ROC", "Accuracy", "Precision", "Recall", "F1_Score", "Brier_Score",
                    "Log_Loss", "EsCampeon")
