"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features per text: densities of two lexicons (a short fixed list of insults
and terms learned from labelled texts), how near second-person words stand to
lexicon hits, and rates of capitals, punctuation and obfuscated words. A term
is a whole word or the first ``PREFIXES`` letters of a word; its weight is its
log-odds of standing in a toxic text.

Labels are used from rows whose crc32(doc_id as text) mod 5 is 1 to 4 only:
1 and 2 teach the lexicon, 3 the trees, 4 the calibration, 0 is held out.
At most ``MAX_LABELLED`` rows of each share are used (a bounded sample in the
order of a hash of doc_id); every document is scored. Ids, languages, sources
and labels are no inputs of a score.

Defined cases: null, empty and blank texts have all features 0 and get the
score of such a text; labels without a document, and null labels, are left
out; with no toxic or no clean label to learn from, every score is the share
of toxic labels (0 without labels); repeated rows get equal scores.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscan.llm.common import documents
from gapscan.staging import stage

MAX_LABELLED = 8_000      # labelled rows used of each fifth
MAX_TERMS = 5_000         # learned terms
MIN_TEXTS = 4             # toxic texts a term needs
MIN_WEIGHT = 1.5          # log-odds a term needs
PREFIXES = (4, 6)
NEAR = 5                  # words between a second-person word and a hit
CLIP = 6.0
THRESHOLD = 0.5

INSULTS = frozenset("idiot moron stupid loser trash scum clown pathetic worthless disgusting".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta "
                          "vous votre usted ustedes tú tu ti tus vosotros".split())

FEATURES = ["insult_rate", "term_rate", "term_sum", "term_max", "second_person_rate", "second_person_near",
            "capital_rate", "shout_rate", "exclaim_rate", "punctuation_rate", "obfuscated_rate",
            "stretched_rate", "log_words", "word_length"]

_EDGE = ".,;:!?\"'()[]{}«»¿¡"
_OBFUSCATED = re.compile(r"[^\W\d_]+[0-9@$*!|]+[^\W\d_]|^[0-9@$*!|]+[^\W\d_]{2,}$|^(?:\w[.\-_*]){2,}\w$")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")


def terms_of(word: str) -> list[str]:
    """The word, and its prefixes where it is longer than they are."""
    return [word] + [word[:n] + "-" for n in PREFIXES if len(word) > n]


# What a word can be, as bits: it begins with a capital, is all capitals, is
# obfuscated, a second person, an insult, in either lexicon, and stretched too.
MARKS = CAPITAL, SHOUT, ODD, SECOND, INSULT, HIT, STRETCHED = [1 << i for i in range(7)]
_MARKED = np.array([[bool(code & m) for m in MARKS] for code in range(1 << len(MARKS))], dtype=np.int64)


class Marks(dict):
    """Words and their marks, each worked out once while it is remembered.

    At most ``LIMIT`` words of at most ``LONGEST`` letters are kept; then the
    memory starts anew, which changes no mark."""
    LIMIT, LONGEST = 300_000, 40

    def __init__(self, terms: dict[str, float]):
        super().__init__()
        self.terms = terms
        self.stems = [(n, {t[:n]: w for t, w in terms.items() if len(t) == n + 1 and t[n] == "-"}) for n in PREFIXES]

    def weight(self, word: str) -> float:
        """The largest weight of ``terms_of(word)``, 0 for none."""
        best = self.terms.get(word, 0.0)
        for n, stems in self.stems:
            if len(word) > n and word[:n] in stems:
                best = max(best, stems[word[:n]])
        return best

    def __missing__(self, raw: str) -> int:
        word = raw.lower().strip(_EDGE)
        code = 0
        if not raw.islower():
            code = CAPITAL * raw[0].isupper() + SHOUT * raw.isupper()
        if not raw.isalpha() and _OBFUSCATED.search(raw):
            code += ODD
        if word in SECOND_PERSON:
            code += SECOND
        if word in INSULTS:
            code += INSULT
        if word and (code & INSULT or self.weight(word)):
            code += HIT + STRETCHED * bool(_STRETCHED.search(word))
        if len(raw) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[raw] = code
        return code


def features(text: str | None, terms: dict[str, float] | Marks) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    raw = (text or "").split()
    if not raw:
        return [0.0] * len(FEATURES)
    marks = terms if isinstance(terms, Marks) else Marks(terms)
    n, chars = len(raw), len(text)
    codes = np.frombuffer(bytes(map(marks.__getitem__, raw)), np.uint8)
    capital, upper, odd, second, insult, hit, stretched = (
        np.bincount(codes, minlength=len(_MARKED)) @ _MARKED).tolist()
    values, near = [], 0
    if hit:
        hits = np.flatnonzero(codes & HIT)
        words = [raw[i].lower().strip(_EDGE) for i in hits.tolist()]
        values = [marks.weight(w) for w in words]
        if stretched:
            stretched = sum(1 for w in set(words) if _STRETCHED.search(w))
        if second:
            seconds = np.flatnonzero(codes & SECOND)
            place = np.searchsorted(seconds, hits)
            left = np.concatenate([[-10 ** 9], seconds])[place]
            right = np.concatenate([seconds, [10 ** 9]])[place]
            near = int((np.minimum(hits - left, right - hits) <= NEAR).sum())
    if odd:
        odd = len({raw[i] for i in np.flatnonzero(codes & ODD).tolist()})
    punctuation = sum(map(text.count, ".,;:!?*#@$%&"))
    return [insult / n, hit / n, min(sum(values), 50.0), max(values, default=0.0),
            second / n, near / n, capital / n, upper / n,
            text.count("!") / chars, punctuation / chars, odd / n, stretched / n,
            float(np.log1p(n)), chars / n]


def text_features(docs: DataFrame, terms: dict[str, float], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` beside the features of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # at most MAX_TERMS entries
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType(kept.schema.fields[:-1] + [T.StructField(f, T.DoubleType()) for f in FEATURES])

    def run(batches):
        marks = Marks(shared.value)
        for b in batches:
            rows = [features(t, marks) for t in b.column(b.num_columns - 1).to_pylist()]
            cols = np.array(rows, dtype=float).reshape(len(rows), len(FEATURES)).T
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, cols)],
                                             [*b.schema.names[:-1], *FEATURES])
    return kept.mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, toxic, text): bounded samples of the labelled texts of folds 1 to 4."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                 .where("doc_id is not null and toxic in (0, 1)")
                 .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                 .withColumns({"fold": fold.cast("int"), "h": F.xxhash64("doc_id")}).where("fold <> 0"))
    chosen = [ids.where(F.col("fold") == k).orderBy("h").limit(MAX_LABELLED) for k in range(1, 5)]
    sample = chosen[0]
    for c in chosen[1:]:
        sample = sample.unionByName(c)
    sample = stage(sample.select(F.col("doc_id").alias("l_id"), "fold", "toxic"), "sample")
    # at most 4 * MAX_LABELLED short rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
    return stage(rows.select("doc_id", "fold", "toxic", "text"), "labelled")


def learn_terms(rows: DataFrame) -> dict[str, float]:
    """Weights of the terms that are likelier in toxic texts, from (toxic, text)."""
    def run(batches):
        def batch(flags, terms):
            return pa.RecordBatch.from_arrays([pa.array(flags, pa.int32()), pa.array(terms, pa.string())],
                                              ["toxic", "term"])
        for b in batches:
            flags, terms = [], []
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = {t for w in {w.strip(_EDGE) for w in (text or "").lower().split()} if len(w) > 2
                         for t in terms_of(w)}
                flags += [toxic] * len(found)
                terms += found
                if len(terms) > 100_000:
                    yield batch(flags, terms)
                    flags, terms = [], []
            if terms:
                yield batch(flags, terms)
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    counts = (rows.select("toxic", "text").mapInArrow(run, "toxic int, term string").groupBy("term")
              .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).where(F.col("t") >= MIN_TEXTS))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (n_clean + 1))
    best = (counts.withColumn("weight", odds).where(F.col("weight") >= MIN_WEIGHT)
            .orderBy(F.desc(F.col("weight") * F.sqrt("t")), "term").limit(MAX_TERMS).collect())
    return {r["term"]: min(float(r["weight"]), CLIP) for r in best}


class Model:
    """Lexicon, trees and calibration; ``score`` adds ``score`` to any documents."""

    def __init__(self, terms, trees, calibration, constant):
        self.terms, self.trees, self.calibration, self.constant = terms, trees, calibration, constant

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        if self.trees is None:
            return docs.select(*keep, F.lit(self.constant).alias("score"))
        rows = _margin(self.trees, text_features(docs, self.terms, keep)).select(*keep, "margin", "probability")
        scored = self.calibration.transform(rows) if self.calibration else rows.withColumn("prediction", F.col("probability"))
        # the trees' own probability orders texts that the calibration puts on one step
        score = 0.995 * F.col("prediction") + 0.005 * F.col("probability")
        return scored.select(*keep, F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))


def _margin(trees, rows: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features_vector").transform(rows)
    out = trees.transform(vectors)
    return (out.withColumn("margin", vector_to_array("rawPrediction")[1])
               .withColumn("p", vector_to_array("probability")[1])
               .drop("probability", "prediction", "rawPrediction", "features_vector")
               .withColumnRenamed("p", "probability"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels)
    terms = learn_terms(rows.where("fold in (1, 2)"))
    dense = stage(text_features(rows.where("fold in (3, 4)"), terms, ["fold", "toxic"]).repartition(2), "features")
    seen = {(r["fold"], r["toxic"]): r["count"] for r in dense.groupBy("fold", "toxic").count().collect()}
    toxic = sum(n for (_, t), n in seen.items() if t)
    if not all(seen.get((3, t)) for t in (0, 1)):
        total = sum(seen.values())
        return Model(terms, None, None, float(toxic) / total if total else 0.0)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features_vector").transform(dense.where("fold = 3"))
    trees = GBTClassifier(featuresCol="features_vector", labelCol="toxic", maxIter=12, maxDepth=4, stepSize=0.3,
                          minInstancesPerNode=5, seed=11).fit(vectors)
    calibration = None
    if all(seen.get((4, t)) for t in (0, 1)):
        margins = _margin(trees, dense.where("fold = 4")).select(F.col("toxic").cast("double").alias("toxic"), "margin")
        calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic").fit(margins)
    return Model(terms, trees, calibration, 0.0)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document, one row per row of ``documents``."""
    docs = documents(spark, sf_dir)
    scored = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs, ["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold."""
    row = docs.select(F.struct("*").alias("row"), "text")
    return train(docs, labels).score(row, ["row"]).where(F.col("score") < THRESHOLD).select("row.*")
