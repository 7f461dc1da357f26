"""Labels, splits, selection, weights."""

from pyspark.sql import functions as F

from fragloom.catalog import views as v
from fragloom.catalog.registry import query, rounded
from fragloom.functions import labels as lab
from fragloom.operators import cohort as co
from fragloom.session import stage

SPLIT_SQL = v.COHORT + """,
n AS (SELECT count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1, count(*) AS n,
             count(*) - CAST(ceil(count(*) * CAST(0.25 AS DOUBLE)) AS BIGINT) AS n_train FROM cohort),
sh AS (SELECT *, n0 * n_train / n AS s0, n1 * n_train / n AS s1 FROM n),
t AS (SELECT *, floor(s0) + CASE WHEN s0 - floor(s0) >= s1 - floor(s1) THEN n_train - floor(s0) - floor(s1) ELSE 0 END AS t0,
             floor(s1) + CASE WHEN s0 - floor(s0) >= s1 - floor(s1) THEN 0 ELSE n_train - floor(s0) - floor(s1) END AS t1 FROM sh),
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('7|' || sample_id)) AS rn FROM cohort),
split AS (SELECT sample_id, label, y, CASE WHEN least(n0, n1) >= 2 AND n >= 8
    AND rn <= CASE WHEN y = 0 THEN n0 - t0 ELSE n1 - t1 END THEN 'test' ELSE 'train' END AS "partition" FROM ranked, t),
folds AS (SELECT sample_id, label, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5('7|' || sample_id)) - 1)
    % least(5, (SELECT min(c) FROM (SELECT count(*) AS c FROM split WHERE "partition" = 'train' GROUP BY y))) AS INT) AS fold
  FROM split WHERE "partition" = 'train')"""


def split(spark, sf):
    return co.stratified_split(v.cohort(spark, sf))


def folds(spark, sf):
    drawn = stage(split(spark, sf), "split")
    return co.kfold(drawn.filter(F.col("partition") == "train").drop("partition"))


@query("""SELECT label, y, count(*) AS n FROM (
  SELECT c_mktsegment AS label, 1 AS y FROM customer UNION ALL SELECT ' Healthy ', 0 FROM customer
  UNION ALL SELECT NULL, 0 FROM customer UNION ALL SELECT 'non-cancer', 0 FROM customer
  UNION ALL SELECT 'colorectal_cancer', 1 FROM customer UNION ALL SELECT '0', 0 FROM customer) GROUP BY ALL""")
def label_parse(spark, sf):
    words = F.array("c_mktsegment", F.lit(" Healthy "), F.lit(None).cast("string"), F.lit("non-cancer"),
                    F.lit("colorectal_cancer"), F.lit("0"))
    rows = v.table(spark, sf, "customer").select(F.explode(words).alias("label"))
    return co.parse_labels(rows).groupBy("label", "y").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + v.COHORT + """
SELECT feature_name, count(value) AS n_values FROM feats GROUP BY 1 HAVING count(value) > 0""")
def usable_features(spark, sf):
    text = v.cohort_features(spark, sf).withColumn("value", F.coalesce(F.col("value").cast("string"), F.lit("bad")))
    return co.usable_features(co.numeric_values(text))


@query("WITH " + SPLIT_SQL + ' SELECT sample_id, label, y, "partition" FROM split')
def stratified_split(spark, sf):
    return split(spark, sf)


@query("WITH " + SPLIT_SQL + " SELECT * FROM folds")
def kfold_assign(spark, sf):
    return folds(spark, sf)


@query("WITH " + v.COHORT + """,
m AS (SELECT feature_name, median(value) AS fill FROM feats GROUP BY 1)
SELECT sample_id, feature_name, coalesce(value, fill) AS value FROM feats JOIN m USING (feature_name)""")
def median_impute(spark, sf):
    features = v.cohort_features(spark, sf)
    return co.impute(features, co.feature_medians(features))


@query("WITH " + v.COHORT + """
SELECT feature_name, quantile_cont(value, 0.5) AS fill FROM feats WHERE value IS NOT NULL GROUP BY 1""")
def feature_medians_large(spark, sf):
    """The median plan for cohorts beyond the counted limit."""
    return co.feature_medians(v.cohort_features(spark, sf), cohort_limit=0)


def anova_sql(by, source, digits=6):
    """F of median-imputed values over every sample of the training rows."""
    def rounded_to(text):
        return text if digits is None else f"round({text}, {digits})"

    return f"""
g AS (SELECT {by}feature_name, sample_id, y FROM {source}
      CROSS JOIN (SELECT DISTINCT feature_name FROM feats WHERE value IS NOT NULL)),
r AS (SELECT g.*, f.value FROM g LEFT JOIN feats f USING (sample_id, feature_name)),
md AS (SELECT {by}feature_name, median(value) AS fill FROM r GROUP BY ALL HAVING count(value) > 0),
x AS (SELECT r.* EXCLUDE (value), coalesce(value, fill) AS value, fill FROM r JOIN md USING ({by}feature_name)),
c AS (SELECT {by}feature_name, y, count(*) AS n, avg(value) AS mu, var_pop(value) * count(*) AS ss, any_value(fill) AS fill
      FROM x GROUP BY ALL),
a AS (SELECT {by}feature_name, sum(n) AS n, sum(n * mu) / sum(n) AS mu, sum(ss) AS ssw, any_value(fill) AS fill,
             count(*) AS k FROM c GROUP BY ALL),
b AS (SELECT {by}feature_name, any_value(a.n) AS n, any_value(ssw) AS ssw, any_value(a.fill) AS fill,
             sum(c.n * (c.mu - a.mu) * (c.mu - a.mu)) AS ssb FROM c JOIN a USING ({by}feature_name) GROUP BY ALL),
anova AS (SELECT {by}feature_name, fill,
  CASE WHEN ssw > 0 THEN {rounded_to("ssb / (ssw / (n - 2))")} WHEN ssb > 0 THEN 'Infinity'::DOUBLE END AS f_value,
  {rounded_to("sqrt((ssw + ssb) / n)")} AS sd FROM b)"""


def anova(spark, sf):
    labelled = v.cohort(spark, sf)
    rows = co.join_labels(v.cohort_features(spark, sf), labelled)
    sizes = labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n_class"))
    return co.anova_f(co.selection_stats(rows, sizes))


@query("WITH " + v.COHORT + "," + anova_sql("", "cohort") + " SELECT * FROM anova")
def anova_f(spark, sf):
    return rounded(anova(spark, sf), "f_value", "sd", digits=6)


@query("WITH " + v.COHORT + "," + anova_sql("", "cohort") + """
SELECT feature_name, f_value FROM anova ORDER BY f_value DESC NULLS LAST, feature_name DESC LIMIT 12""")
def select_k_best(spark, sf):
    best = co.select_k_best(anova(spark, sf), 12).select("feature_name", "f_value")
    return rounded(best, "f_value", digits=6)


FIT_SQL = SPLIT_SQL + """,
fit AS (SELECT sample_id, y, fit_fold FROM folds, (SELECT unnest(range(6)) AS fit_fold) WHERE fold <> fit_fold)"""


@query("WITH " + FIT_SQL + "," + anova_sql("fit_fold, ", "fit") + """
SELECT CAST(fit_fold AS INT) AS fit_fold, feature_name, fill, f_value, sd FROM anova""")
def fold_anova(spark, sf):
    """Selection statistics of every cross-validation fit in one pass over the features."""
    training = stage(folds(spark, sf), "folds")
    rows = co.join_labels(v.cohort_features(spark, sf), training, "fold")
    return rounded(co.anova_f(co.fold_stats(rows, training, 5)), "f_value", "sd", digits=6)


@query("WITH " + v.COHORT + """
SELECT y, count(*) AS n_class, (SELECT count(*) FROM cohort) / (2.0 * count(*)) AS weight FROM cohort GROUP BY y""")
def class_weights(spark, sf):
    return co.class_weights(v.cohort(spark, sf))


@query("WITH " + SPLIT_SQL + """
SELECT y, count(*) AS total, count(*) FILTER ("partition" = 'train') AS train,
       count(*) FILTER ("partition" = 'test') AS test FROM split GROUP BY y""")
def class_counts(spark, sf):
    return co.class_counts(split(spark, sf))


@query("WITH " + v.SCORED + """
SELECT sample_id, cancer_probability, CASE WHEN cancer_probability > 0.7 THEN 'elevated_fragmentome_score'
  ELSE 'lower_fragmentome_score' END AS classification FROM scored""")
def classify_scores(spark, sf):
    score = F.col("cancer_probability")
    return v.scored(spark, sf).select(
        "sample_id", "cancer_probability", lab.classify(score, F.lit(0.7)).alias("classification"))


