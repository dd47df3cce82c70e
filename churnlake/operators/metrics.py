"""Evaluation metrics over (id, y, p) frames.

Scores are first grouped to distinct values (one row per score, with its
positive and negative counts: a partial aggregate, so ties and heavy
scores are cheap), then ``prefix_sums`` gives true/false positives at
every threshold without a single-partition window.  Totals are scalar
subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.columns import round_half_even
from churnlake.functions.prefix import prefix_sums
from churnlake.functions.stats import one_row
from churnlake.session import cut_lineage


def score_counts(df: DataFrame, y: str = "y", p: str = "p", group_cols: Sequence[str] = ()) -> DataFrame:
    return (df.where(F.col(p).isNotNull())
              .groupBy(*group_cols, F.col(p).alias("p"))
              .agg(F.sum(F.col(y).cast("bigint")).alias("pos"),
                   F.sum((1 - F.col(y).cast("bigint"))).alias("neg")))


def threshold_table(df: DataFrame, y: str = "y", p: str = "p", group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score (per group): pos, neg at that score and
    tp, fp = positives / negatives with score >= it, plus class totals. The
    counts per score are written once; the sums and totals read them."""
    sc = cut_lineage(score_counts(df, y, p, group_cols))
    cum = prefix_sums(sc, "p", ["pos", "neg"], group_cols, descending=True)
    if group_cols:
        tot = sc.groupBy(*group_cols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
        return (cum.join(tot, list(group_cols), "left")
                   .withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp"))
    tot = one_row(sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    return (cum.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")
               .withColumn("n_pos", F.lit(tot["P"]).cast("bigint"))
               .withColumn("n_neg", F.lit(tot["N"]).cast("bigint")))


def _r(c: Column, digits: int | None) -> Column:
    return round_half_even(c, digits) if digits is not None else c


def classification_metrics(df: DataFrame, y: str = "y", pred: str = "pred", digits: int | None = 4) -> DataFrame:
    """F1: accuracy, balanced accuracy (mean recall over the classes
    present), precision, recall, F1; 0 on zero division."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
               F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    spec = F.when(tn + fp > 0, tn / (tn + fp))
    n_cls = (F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0))
    bal = (F.coalesce(F.when(tp + fn > 0, rec), F.lit(0.0)) + F.coalesce(spec, F.lit(0.0))) / n_cls
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return c.select(_r((tp + tn) / (tp + tn + fp + fn), digits).alias("accuracy"),
                    _r(bal, digits).alias("balanced_accuracy"), _r(prec, digits).alias("precision"),
                    _r(rec, digits).alias("recall"), _r(f1, digits).alias("f1_score"))


def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p", digits: int | None = 4,
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """F2 ROC-AUC (ties count half; one class only -> NULL), F3 average
    precision (step sum of recall increments times precision), F4 Brier
    score on probabilities clipped to [.001, .999]."""
    t = threshold_table(df, y, p, group_cols)
    auc = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0)) / (F.first("n_pos").cast("double") * F.first("n_neg"))
    ap = F.sum(F.col("pos") / F.col("n_pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    r = t.groupBy(*group_cols).agg(
        F.when((F.first("n_pos") > 0) & (F.first("n_neg") > 0), auc).alias("roc_auc"),
        F.when(F.first("n_pos") > 0, ap).alias("pr_auc"))
    clipped = F.least(F.greatest(F.col(p), F.lit(0.001)), F.lit(0.999))
    b = df.groupBy(*group_cols).agg(F.avg(F.pow(clipped - F.col(y).cast("double"), 2)).alias("brier_score"))
    out = r.join(b, list(group_cols), "inner") if group_cols else r.join(b)
    return out.select(*group_cols, _r(F.col("roc_auc"), digits).alias("roc_auc"),
                      _r(F.col("pr_auc"), digits).alias("pr_auc"),
                      _r(F.col("brier_score"), digits).alias("brier_score"))


def optimal_threshold(df: DataFrame, y: str = "y", p: str = "p", digits: int | None = 4) -> DataFrame:
    """over the distinct scores, F1 = 2PR/(P+R+1e-10); the highest F1,
    lowest threshold on ties (first maximum in ascending order)."""
    t = threshold_table(df, y, p)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / F.col("n_pos")
    t = t.select("p", prec.alias("prec"), rec.alias("rec"),
                 (2 * prec * rec / (prec + rec + F.lit(1e-10))).alias("f1"))
    best = t.agg(F.max_by(F.struct("p", "f1", "prec", "rec"), F.struct("f1", (-F.col("p")).alias("np"))).alias("b"))
    return best.select(_r(F.col("b.p"), digits).alias("optimal_threshold"),
                       _r(F.col("b.f1"), digits).alias("max_f1"),
                       _r(F.col("b.prec"), digits).alias("precision_at_optimal"),
                       _r(F.col("b.rec"), digits).alias("recall_at_optimal"))


def lift_at_k(df: DataFrame, k: float, y: str = "y", p: str = "p", id_col: str = "id",
              digits: int | None = 4) -> DataFrame:
    """(churners among the top max(1, int(n*k)) rows by score / all
    churners) / k; 0 without churners.  Ties in score are broken by id.

    Never sorts all rows: the cut is found on the per-score prefix counts;
    only the rows of the one score that straddles the cut are ordered by id
    (again with range-partitioned prefix sums).  The cut is a one-row fit
    collected to the driver; the result is one row."""
    sc = score_counts(df, y, p).withColumn("cnt", F.col("pos") + F.col("neg"))
    cum = prefix_sums(sc, "p", ["cnt", "pos"], descending=True)
    tot = one_row(sc.agg(F.sum("cnt").alias("n"), F.sum("pos").alias("pos")))
    n, total_pos = tot["n"] or 0, tot["pos"] or 0
    n_top = max(1, int(n * float(k)))
    cut = one_row(cum.where(F.col("cum_cnt") >= n_top).agg(
        F.max_by(F.struct("p", "pos", "cnt", "cum_cnt", "cum_pos"), "p").alias("c")))["c"]
    in_top = 0
    if cut is not None:
        above_pos, above_cnt = cut["cum_pos"] - cut["pos"], cut["cum_cnt"] - cut["cnt"]
        tied = (df.where(F.col(p) == F.lit(cut["p"]))
                  .select(F.col(id_col).alias("id"), F.col(y).cast("bigint").alias("pos"), F.lit(1).alias("one")))
        tied_cum = prefix_sums(tied, "id", ["one", "pos"])
        need = n_top - above_cnt
        tied_pos = one_row(tied_cum.where(F.col("cum_one") <= need)
                           .agg(F.coalesce(F.max("cum_pos"), F.lit(0)).alias("v")))["v"]
        in_top = above_pos + tied_pos
    n_top, in_top, total_pos = F.lit(n_top), F.lit(in_top), F.lit(total_pos)
    lift = F.when(total_pos > 0, in_top / total_pos / F.lit(float(k))).otherwise(F.lit(0.0))
    return df.sparkSession.range(1).select(F.lit(float(k)).alias("k"), n_top.cast("bigint").alias("n_top"),
                                           in_top.cast("bigint").alias("churners_in_top"),
                                           _r(lift, digits).alias("lift"))


def roc_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    t = threshold_table(df, y, p)
    return t.select(F.col("p").alias("threshold"), (F.col("fp") / F.col("n_neg")).alias("fpr"),
                    (F.col("tp") / F.col("n_pos")).alias("tpr"))


def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """F8: (threshold, precision, recall) at every distinct score."""
    t = threshold_table(df, y, p)
    return t.select(F.col("p").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    (F.col("tp") / F.col("n_pos")).alias("recall"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """2x2 counts, zero cells kept (4-row spine, one aggregate)."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    c = df.agg(*[F.count_if((yy == a) & (pp == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    return c.select(F.explode(F.array(*[F.struct(F.lit(a).cast("bigint").alias("y"),
                                                 F.lit(b).cast("bigint").alias("pred"),
                                                 F.col(f"c{a}{b}").alias("n")) for a in (0, 1) for b in (0, 1)]))
                    .alias("x")).select("x.*")


def metric_comparison(metrics: DataFrame, model_col: str, model_a: str, model_b: str) -> DataFrame:
    """long table metric x model, then the two models side by side and
    their difference (b - a)."""
    value_cols = [c for c in metrics.columns if c != model_col]
    long = metrics.unpivot([model_col], value_cols, "metric", "value")
    wide = long.groupBy("metric").pivot(model_col, [model_a, model_b]).agg(F.first("value"))
    return wide.select("metric", F.col(model_a).alias("model_a"), F.col(model_b).alias("model_b"),
                       (F.col(model_b) - F.col(model_a)).alias("difference"))
