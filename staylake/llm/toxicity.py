"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Labelled rows are drawn in the order of a hash of their id, ``sample_rows`` of
them at most (a documented bound; everything else covers all documents), and
dealt by another hash: four tenths to learn the lexicon, four to fit the trees,
two to calibrate.

* Lexicon: words and word beginnings of 4 to 6 letters that stand in at least
  ``least_documents`` toxic documents and whose share among toxic documents is
  at least ``least_lift`` times that among the others; the ``lexicon_size``
  most telling ones by count times log lift.
* Features of a document: share of its words in the learned lexicon and in a
  short fixed one, their number, hits near a second-person word, capitals,
  words in capitals, exclamation and question marks, other punctuation, runs of
  one letter, letters broken up by digits or signs, and lexicon hits that show
  only after undoing common digit-for-letter swaps.
* Trees and calibration are Spark ML's GBTClassifier and IsotonicRegression.

Only the text is ever an input of a score. Without labels of both kinds in the
sample every score is the share of toxic labels (0 without labels). NULL texts
count as empty and are scored like empty texts, which have all features 0.
Rows sharing an id share the label; several labels of one id count as their
largest; a NULL label is none. Extra columns are ignored, an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import as_row, saved, whole_text

# ---- fixed values: a short list of common insults, and second-person words --
INSULTS = ["idiot", "moron", "stupid", "dumb", "loser", "trash", "scum", "pathetic", "worthless", "disgusting", "clown", "fool",
           "jerk", "imbecile", "crap", "connard", "salaud", "imbécile", "débile", "dummkopf", "trottel", "blödmann", "abschaum",
           "estúpido", "imbécil", "basura", "payaso", "tonto"]
SECOND_PERSON = ["you", "your", "yours", "yourself", "tu", "toi", "ton", "vous", "votre", "vos", "du", "dich", "dir", "dein", "deine",
                 "ihr", "euch", "tú", "ti", "usted", "ustedes", "vosotros"]
SWAPPED, MEANT = "013457@$", "oieastas"
STEMS = (4, 5, 6)
NEAR = 5
SCORE_SCHEMA = ["score", "predicted"]


def words_of(lowered: Column) -> Column:
    return F.filter(F.split(lowered, r"[^\p{L}]+"), lambda w: w != "")


def _hit(word: Column, lexicon: list[str]) -> Column:
    """Whether a word or one of its beginnings (kept with a star) is in the lexicon."""
    test = word.isin([x for x in lexicon if not x.endswith("*")] or [""])
    for n in STEMS:
        stems = [x[:-1] for x in lexicon if x.endswith("*") and len(x) == n + 1]
        if stems:
            test = test | F.substring(word, 1, n).isin(stems)
    return test


def features(docs: DataFrame, text: str, learned: list[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with the feature columns, and their names."""
    raw = F.col("_raw")
    df = docs.withColumn("_raw", whole_text(text)).withColumn("_lower", F.lower("_raw"))
    df = df.withColumn("_words", words_of(F.col("_lower")))
    any_word = sorted({*learned, *INSULTS})
    n_words, n_chars = F.greatest(F.size("_words"), F.lit(1)), F.greatest(F.length("_raw"), F.lit(1))
    count = lambda pattern: F.regexp_count(raw, F.lit(pattern))
    of_learned = F.size(F.filter("_words", lambda w: _hit(w, learned))) if learned else F.lit(0)
    of_fixed = F.size(F.filter("_words", lambda w: w.isin(INSULTS)))
    near = F.size(F.filter("_words", lambda w, i: _hit(w, any_word) & F.exists(
        F.slice("_words", F.greatest(i + 1 - NEAR, F.lit(1)), F.lit(2 * NEAR + 1)), lambda x: x.isin(SECOND_PERSON))))
    swapped = F.when(raw.rlike(r"\p{L}[0134578@$]|[0134578@$]\p{L}"), F.size(F.filter(
        words_of(F.translate("_lower", SWAPPED, MEANT)), lambda w: _hit(w, any_word)))).otherwise(0)
    made = {
        "learned_density": of_learned / n_words, "learned_hits": F.least(of_learned, F.lit(20)).cast("double"),
        "fixed_density": of_fixed / n_words, "fixed_hits": F.least(of_fixed, F.lit(20)).cast("double"),
        "near_second_person": near / n_words,
        "capitals": count(r"\p{Lu}") / n_chars, "capital_words": count(r"\b\p{Lu}{3,}\b") / n_words,
        "exclaimed": count(r"[!?]") / n_chars, "punctuation": count(r"[^\p{L}\p{N}\s]") / n_chars,
        "letter_runs": count(r"(\p{L})\1{2,}") / n_words, "broken_letters": count(r"\p{L}[0-9@$*!#%]+\p{L}") / n_words,
        "swapped_hits": F.greatest(F.lit(0), swapped - of_learned).cast("double"),
    }
    names = [f"_f_{k}" for k in made]
    df = df.withColumns({f"_f_{k}": v.cast("double") for k, v in made.items()})
    return df.drop("_raw", "_lower", "_words"), names


@dataclass
class Model:
    learned: list[str]
    trees: Any = None
    steps: Any = None
    share: float = 0.0

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``score`` and ``predicted`` (columns of these names are replaced)."""
        df = docs.select(as_row(docs), F.col(text).alias("text"))
        if self.trees is None:
            df = df.withColumn("_p", F.lit(self.share))
        else:
            df, names = features(df, "text", self.learned)
            df = VectorAssembler(inputCols=names, outputCol="_x").transform(df)
            df = self.trees.transform(df).withColumn("_p", vector_to_array("_probability")[1])
            if self.steps is not None:
                df = self.steps.transform(df)
                # the steps decide; the trees' own order is kept inside a step
                df = df.withColumn("_p", F.least(F.greatest(0.999 * F.col("_score") + 0.001 * F.col("_p"), F.lit(0.0)), F.lit(1.0)))
        out = df.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in SCORE_SCHEMA], F.col("_p").alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learn_lexicon(sample: DataFrame, least_documents: int, least_lift: float, size: int) -> list[str]:
    """Telling words and word beginnings of the sample (columns ``text``, ``toxic``)."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    words = F.array_distinct(words_of(F.lower(whole_text())))
    terms = F.array_distinct(F.concat(words, *[F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))
                                               for k in STEMS]))
    counts = (sample.select("toxic", F.explode(terms).alias("term")).groupBy("term")
              .agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter(F.col("t") >= least_documents))
    lift = ((F.col("t") + 0.5) / (n.get(1, 0) + 1)) / ((F.col("c") + 2) / (n.get(0, 0) + 4))
    best = counts.withColumn("lift", lift).filter(F.col("lift") >= least_lift).orderBy((F.col("t") * F.log("lift")).desc(), "term").limit(size)
    return sorted(r["term"] for r in best.select("term").collect())  # at most ``size`` terms


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = 20_000,
        lexicon_size: int = 500, least_documents: int = 4, least_lift: float = 20.0, trees: int = 20, depth: int = 3, seed: int = 7) -> Model:
    """Fit on a bounded sample of labelled rows. Leave held-out rows out of ``labels``."""
    key = F.col(id_col).cast("bigint")
    one = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(key.alias("_id"))
           .agg(F.max((F.col(label) > 0).cast("int")).alias("toxic")))
    drawn = one.orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(sample_rows)
    # at most sample_rows small rows are broadcast
    rows = docs.select(key.alias("_id"), whole_text(text).alias("text")).join(F.broadcast(drawn), "_id")
    sample = saved(rows.withColumn("tenth", F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(10))), "toxicity-sample")
    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    total = sum(kinds.values())
    share = kinds.get(1, 0) / total if total else 0.0
    learned = learn_lexicon(sample.filter("tenth < 4"), least_documents, least_lift, lexicon_size)
    df, names = features(sample.filter("tenth >= 4"), "text", learned)
    df = saved(VectorAssembler(inputCols=names, outputCol="_x").transform(df).select("_x", "tenth", F.col("toxic").cast("double").alias("y")), "toxicity-features")
    fitting, calibrating = df.filter("tenth < 8"), df.filter("tenth >= 8")
    if fitting.select("y").distinct().count() < 2:
        return Model(learned, share=share)
    learner = GBTClassifier(featuresCol="_x", labelCol="y", predictionCol="_predicted", maxIter=trees, maxDepth=depth, seed=seed)
    model = learner.setRawPredictionCol("_margin").setProbabilityCol("_probability").fit(fitting)
    steps = None
    if calibrating.select("y").distinct().count() == 2:
        scored = model.transform(calibrating).withColumn("_p", vector_to_array("_probability")[1])
        steps = IsotonicRegression(featuresCol="_p", labelCol="y", predictionCol="_score").fit(scored)
    return Model(learned, model, steps, share)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
