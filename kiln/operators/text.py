"""Word / target association (F14, T7) and word features."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import special as SP
from kiln.operators import joins as J
from kiln.operators.features import StateModel, StepEstimator
from kiln.session import scratch_path

# Fixed value: a token is a maximal run of letters, digits and underscores
# (the Unicode meaning of ``\b\w+\b``), taken from the lower-cased text.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"


def tokens(text: Column) -> Column:
    """Lower-cased tokens in order; a null text is the token ``nan``."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit("nan"))), F.lit(TOKEN_PATTERN), 0)


def word_stats(df: DataFrame, text: str, label: str, min_count: int = 5) -> DataFrame:
    """Per token (distinct per row): count_0, count_1 (rows of each class holding
    it), class1_rate and the two-sided Fisher p of [[c1, c0], [T1-c1, T0-c0]];
    tokens seen in fewer than ``min_count`` rows are dropped."""
    d = df.select(F.array_distinct(tokens(F.col(text))).alias("_t"), F.col(label).cast("int").alias("_y"))
    totals = d.agg(F.sum(F.when(F.col("_y") == 0, 1).otherwise(0)).alias("T0"),
                   F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("T1"))
    per = (d.select(F.explode("_t").alias("token"), "_y").groupBy("token")
            .agg(F.sum(F.when(F.col("_y") == 0, 1).otherwise(0)).alias("count_0"),
                 F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("count_1")))
    per = per.filter(F.col("count_0") + F.col("count_1") >= min_count)
    per = per.crossJoin(F.broadcast(totals))  # one-row table
    return per.select(
        "token", F.col("count_0").cast("long").alias("count_0"), F.col("count_1").cast("long").alias("count_1"),
        (F.col("count_1") / (F.col("count_0") + F.col("count_1"))).alias("class1_rate"),
        SP.fisher_udf(F.col("count_1"), F.col("count_0"), F.col("T1") - F.col("count_1"),
                      F.col("T0") - F.col("count_0")).alias("p_value"))


def word_features(df: DataFrame, stats: DataFrame, text: str, key: str, drop_text: bool = True) -> DataFrame:
    """Per row the lowest-p token with rate > 0.5 and the one with rate < 0.5
    (first occurrence wins ties; p must be below 1); defaults p = 1, prob = 0.5.

    Distinct tokens are exploded in the order of their first occurrence, joined to
    the statistics table and reduced per row with ``min_by``."""
    toks = df.select(F.col(key), F.posexplode(F.array_distinct(tokens(F.col(text)))).alias("pos", "token"))
    # only tokens that can win (p below 1, rate off 0.5) take part in the join
    useful = stats.select("token", "class1_rate", "p_value") \
        .filter((F.col("p_value") < 1.0) & (F.col("class1_rate") != 0.5))
    j = J.lookup_join(toks, useful, "token", "inner")
    pos = F.col("class1_rate") > 0.5
    neg = F.col("class1_rate") < 0.5
    order = F.struct(F.col("p_value"), F.col("pos"))
    best = j.groupBy(key).agg(
        F.min_by(F.when(pos, F.struct("p_value", "class1_rate")), F.when(pos, order)).alias("_pos"),
        F.min_by(F.when(neg, F.struct("p_value", "class1_rate")), F.when(neg, order)).alias("_neg"))
    out = df.join(best, key, "left").select(
        "*",
        F.coalesce(F.col("_pos.p_value"), F.lit(1.0)).alias("name_corr_pos_p_value"),
        F.coalesce(F.col("_pos.class1_rate"), F.lit(0.5)).alias("name_corr_pos_prob"),
        F.coalesce(F.col("_neg.p_value"), F.lit(1.0)).alias("name_corr_neg_p_value"),
        F.coalesce(F.col("_neg.class1_rate"), F.lit(0.5)).alias("name_corr_neg_prob")).drop("_pos", "_neg")
    return out.drop(text) if drop_text else out


class WordFeaturesModel(StateModel):
    """Fitted word statistics: a table of the state, saved with the model."""

    def _transform(self, df):
        stats = self.table(df.sparkSession, "words")
        return word_features(df, stats, self.cfg["text"], self.cfg["key"], self.cfg.get("drop_text", True))


class WordFeatures(StepEstimator):
    """F14 fit + F15 apply as one pipeline step."""
    model_class = WordFeaturesModel

    def __init__(self, text: str = "Name", label: str = "label", key: str = "id", min_count: int = 5,
                 drop_text: bool = True):
        super().__init__(text=text, label=label, key=key, min_count=min_count, drop_text=drop_text)

    def fit_state(self, df):
        c = self.cfg
        path = scratch_path(df.sparkSession, f"word-stats-{uuid.uuid4().hex}")
        word_stats(df, c["text"], c["label"], c["min_count"]).write.parquet(path)
        return {"tables": {"words": path}}
