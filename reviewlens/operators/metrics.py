"""Evaluation over one predictions table (E-01..E-14).

Contract: ``y_true``, ``y_pred`` integer class codes, optional probability
columns ``p0..p{k-1}``, optional group columns (e.g. ``model``) so every model
is scored in one pass.  All metrics start from the confusion counts, a
group-by whose output is groups x classes^2 rows, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.operators.features import quantile_bucket
from reviewlens.functions.labels import class_name
from reviewlens.operators import rank as R


def confusion_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or []), "y_true", "y_pred").agg(F.count(F.lit(1)).alias("cnt"))


def per_class(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per group and class (union of true and predicted): tp, support, predicted, precision, recall, f1.

    Zero denominators give 0 (sklearn ``zero_division=0``).
    """
    by = list(by or [])
    cm = confusion_counts(scored, by)
    rows = cm.select(*by, F.explode(F.array(
        F.struct(F.col("y_true").alias("cls"), F.when(F.col("y_true") == F.col("y_pred"), F.col("cnt")).otherwise(0)
                 .alias("tp"), F.col("cnt").alias("sup"), F.lit(0).cast("bigint").alias("prd")),
        F.struct(F.col("y_pred").alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("sup"),
                 F.col("cnt").alias("prd")))).alias("r")).select(*by, "r.*")
    pc = rows.groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("sup").alias("support"),
                                      F.sum("prd").alias("predicted"))
    z = F.lit(0.0)
    return pc.select(*by, "cls", "tp", "support", "predicted",
                     F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(z).alias("precision"),
                     F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(z).alias("recall"),
                     F.when(F.col("support") + F.col("predicted") > 0,
                            2.0 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(z).alias("f1"))


def summary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro precision / recall / F1 (unweighted means over the class set)."""
    by = list(by or [])
    pc = per_class(scored, by)
    return pc.groupBy(*by).agg((F.sum("tp") / F.sum("support")).alias("accuracy"),
                               F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
                               F.avg("f1").alias("macro_f1"), F.sum("support").alias("n"))


def metrics_basic(scored: DataFrame, classes=(0, 1, 2), by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """E-01: accuracy, macro F1 and a column ``f1_class_k`` for each of ``classes`` and every further class of the data.

    Classes are few: their codes, found in the confusion counts, become the columns.  A class that a group lacks is null.
    """
    by = list(by or [])
    pc = per_class(scored, by)
    found = {r[0] for r in pc.select("cls").distinct().collect() if r[0] is not None}
    return pc.groupBy(*by).agg(
        F.round(F.sum("tp") / F.sum("support"), digits).alias("accuracy"), F.round(F.avg("f1"), digits).alias("macro_f1"),
        *[F.round(F.max(F.when(F.col("cls") == c, F.col("f1"))), digits).alias(f"f1_class_{c}")
          for c in [*classes, *sorted(found - set(classes))]])


def _report_row(label: str, p: str, r: str, f: str):
    return F.struct(F.lit(label).alias("label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1"), F.col("n").alias("support"))


def class_report(scored: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """E-03: per-class rows + accuracy, macro avg, weighted avg; 4 dp, integer support."""
    pc = per_class(scored)
    label = class_name(F.col("cls"))
    if names is not None:
        named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        label = F.coalesce(F.try_element_at(named, F.col("cls").cast("int")), F.col("cls").cast("string"))
    cls_rows = pc.select(label.alias("label"), "precision", "recall", "f1", F.col("support"))
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                 (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = F.col("tp") / F.col("n")
    extra = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("n").alias("support")),
        _report_row("macro avg", "mp", "mr", "mf"), _report_row("weighted avg", "wp", "wr", "wf"))))
    return cls_rows.unionByName(extra).select(
        "label", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
        F.round("f1", 4).alias("f1_score"), F.col("support").cast("bigint").alias("support"))


def confusion(scored: DataFrame, normalize: bool = False) -> DataFrame:
    """E-04: full class x class grid (zeros kept); row-normalised -> NULL for an empty true row."""
    cm = confusion_counts(scored)
    classes = cm.select(F.explode(F.array("y_true", "y_pred")).alias("c")).agg(F.array_sort(F.collect_set("c")).alias("cs"))
    grid = classes.select(F.explode("cs").alias("y_true"), "cs").select("y_true", F.explode("cs").alias("y_pred"))
    full = grid.join(cm, ["y_true", "y_pred"], "left").select("y_true", "y_pred",
                                                             F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))
    if not normalize:
        return full
    row = F.sum("cnt").over(Window.partitionBy("y_true"))  # grid rows: classes^2, tiny
    return full.select("y_true", "y_pred", F.when(row > 0, F.round(F.col("cnt") / row, 6)).alias("rate"))


def _one_vs_rest(scored: DataFrame, n_classes: int) -> DataFrame:
    """Per class and distinct score: positives and negatives (aggregated before any ordering)."""
    ex = scored.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), F.col(f"p{c}").alias("score"),
                 (F.col("y_true") == c).cast("long").alias("pos")) for c in range(n_classes)])).alias("e")).select("e.*")
    return ex.groupBy("cls", "score").agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg"))


def roc_curve(scored: DataFrame, n_classes: int = 3, buckets: int = 1024) -> DataFrame:
    """E-05: one-vs-rest ROC points at every distinct score (descending thresholds), from (0, 0) at infinity on.

    Cumulative TP/FP use the bucketed prefix sums of ``rank.prefix_sums`` over buckets between approximate quantiles of
    the distinct scores, so no class is ever ordered inside one task, however close its scores or whatever their range.
    """
    agg = quantile_bucket(_one_vs_rest(scored, n_classes), "score", "_qb", buckets)
    cum = R.prefix_sums(agg, F.col("_qb"), [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")},
                        partition_by=["cls"], bucket_desc=True)
    tot = agg.groupBy("cls").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    none = F.lit(0).cast("bigint")
    start = tot.select("cls", F.lit(float("inf")).alias("score"), none.alias("tp"), none.alias("fp"))
    return cum.select("cls", "score", "tp", "fp").unionByName(start).join(tot, "cls").select(
        "cls", F.round("score", 6).alias("threshold"),
        F.round(F.when(F.col("P") > 0, F.col("tp") / F.col("P")), 6).alias("tpr"),
        F.round(F.when(F.col("N") > 0, F.col("fp") / F.col("N")), 6).alias("fpr"))


def roc_auc(scored: DataFrame, n_classes: int = 3, buckets: int = 1024) -> DataFrame:
    """E-05 / E-02: per-class AUC (ties count one half) and the macro mean; NULL if a class is all one side."""
    agg = quantile_bucket(_one_vs_rest(scored, n_classes), "score", "_qb", buckets)
    cum = R.prefix_sums(agg, F.col("_qb"), [F.col("score").asc()], {"neg_le": F.col("neg")}, partition_by=["cls"])
    per = (cum.groupBy("cls").agg(
        F.sum(F.col("pos") * (F.col("neg_le") - 0.5 * F.col("neg"))).alias("num"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        .select(F.col("cls").cast("string").alias("cls"),
                F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P").cast("double") * F.col("N"))).alias("auc")))
    macro = per.agg(F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("auc")).select(
        F.lit("macro").alias("cls"), "auc")
    return per.unionByName(macro).select("cls", F.round("auc", 6).alias("auc"))


def error_samples(scored: DataFrame, max_samples: int = 100, seed: int = R.DEFAULT_SEED, key: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """E-06: seeded sample of misclassified rows, most confident first."""
    err = scored.where(F.col("y_true") != F.col("y_pred"))
    s = R.sample_exact(err, max_samples, key, seed)
    probs = F.array("p0", "p1", "p2")
    return s.select(key, F.col("y_true").alias("true_label"), F.col("y_pred").alias("predicted_label"),
                    class_name(F.col("y_true")).alias("true_class"), class_name(F.col("y_pred")).alias("predicted_class"),
                    F.round(F.element_at(probs, F.col("y_pred") + 1), 6).alias("confidence"),
                    F.round(F.element_at(probs, F.col("y_true") + 1), 6).alias("true_class_prob"),
                    F.substring(text_col, 1, 200).alias("text")).orderBy(F.col("confidence").desc(), key)


def error_stats(scored: DataFrame) -> DataFrame:
    """E-07: per true class: total, errors, error rate, accuracy."""
    return (scored.groupBy(F.col("y_true").alias("label"))
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("y_true") != F.col("y_pred")).alias("errors"))
            .select("label", class_name(F.col("label")).alias("class_name"), "total", "errors",
                    F.round(F.col("errors") / F.col("total"), 6).alias("error_rate"),
                    F.round(1 - F.col("errors") / F.col("total"), 6).alias("accuracy")))


def regression_metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """E-08 / E-09: MSE, RMSE, MAE, R^2 in one pass (R^2 from sums of squares)."""
    e = F.col("y_true") - F.col("y_pred")
    a = pred.groupBy(*(by or [])).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                                      F.sum(e * e).alias("sse"), F.var_pop("y_true").alias("vy"),
                                      F.count(F.lit(1)).alias("n"))
    return a.select(*(by or []), F.round("mse", 6).alias("mse"), F.round(F.sqrt("mse"), 6).alias("rmse"),
                    F.round("mae", 6).alias("mae"),
                    F.round(1 - F.col("sse") / (F.col("vy") * F.col("n")), 6).alias("r2"))


def pred_vs_actual(pred: DataFrame, bins: int = 20) -> DataFrame:
    """E-10: 2-D count grid over the shared [min, max] of truth and prediction (the diagonal range)."""
    st = pred.agg(F.struct(F.least(F.min("y_true"), F.min("y_pred")).alias("lo"),
                           F.greatest(F.max("y_true"), F.max("y_pred")).alias("hi"))).scalar()
    lo, hi = st.getField("lo"), st.getField("hi")

    def b(c):
        return F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    return pred.groupBy(b("y_true").alias("bx"), b("y_pred").alias("by")).agg(F.count(F.lit(1)).alias("cnt"))
