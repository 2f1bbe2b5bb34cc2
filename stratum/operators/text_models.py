"""Text models as distributed aggregations and joins.

* Naive Bayes: fitting is a token count per class (``explode`` then a two-stage
  hash aggregate, so frequent tokens are combined map-side); scoring counts
  ``(doc, token)`` pairs, left-joins them to the term table and sums per
  document.  Out-of-vocabulary tokens still contribute, exactly as in the
  reference.
* TF-IDF: raw term count x smoothed IDF ``ln((1+n)/(1+df)) + 1``, L2-normalised
  per document, over the ``max_features`` most frequent 1-2-grams.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.text import WORD, WORD2, ngrams, tokenize
from stratum.operators.joins import lookup_join

#: Terms of a vocabulary that is broadcast; a larger one is joined by size.
BROADCAST_TERMS = 200_000


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` in ``partitions`` parts (round robin, so equal texts spread), or as it was read.

    Tokenising is CPU-bound and a file of one row group is read by one task; a caller who knows
    that may ask for more, here or for a whole session by ``spark.stratum.textPartitions``.  The
    default leaves sizing to ``maxPartitionBytes`` and AQE.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.stratum.textPartitions", "0"))
    return df.repartition(n) if n else df


def doc_term_counts(df: DataFrame, doc: str, text: str, pattern: str = WORD, n_max: int = 1, partitions: int | None = None) -> DataFrame:
    """``(doc, token, tf)``: occurrences of each term in each document.

    A document is never split across input partitions, so the partial
    aggregate before the shuffle already combines all of a document's tokens.
    """
    return doc_terms(df, doc, text, pattern, n_max, partitions).groupBy(doc, "token").agg(F.count(F.lit(1)).alias("tf"))


def doc_terms(df: DataFrame, doc: str, text: str, pattern: str = WORD, n_max: int = 1, partitions: int | None = None) -> DataFrame:
    """``(doc, token)`` per term occurrence (unigrams, plus bigrams when ``n_max`` = 2)."""
    toks = dealt(df.select(doc, text), partitions).select(F.col(doc), tokenize(F.col(text), pattern).alias("_toks"))
    terms = ngrams(F.col("_toks"), n_max) if n_max > 1 else F.col("_toks")
    return toks.select(F.col(doc), F.explode(terms).alias("token"))


def token_counts(df: DataFrame, text: str, label: str, partitions: int | None = None) -> DataFrame:
    """Per token: occurrences in class-0 and class-1 documents (``token, c0, c1``)."""
    rows = dealt(df.select(label, text), partitions)
    return (
        rows.select(F.col(label), F.explode(tokenize(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(
            F.count(F.when(F.col(label) == 0, 1)).alias("c0"),
            F.count(F.when(F.col(label) == 1, 1)).alias("c1"),
        )
    )


@dataclass
class NBModel:
    """Fitted multinomial Naive Bayes state (all of it data)."""

    terms: DataFrame  # token, c0, c1
    classes: DataFrame  # label, n_docs, total_words, prior, log_prior, log_denom
    vocab_size: int


def nb_fit(df: DataFrame, text: str, label: str, partitions: int | None = None) -> NBModel:
    """Multinomial NB with add-one smoothing (labels 0/1).

    Priors ``(n_c + 1) / (n + k)``; likelihood ``(count_c(w) + 1) / (total_c + V)``.
    The term table is materialised once (checkpointed) since fitting and
    scoring both read it.
    """
    from stratum.session import cut_lineage

    terms = cut_lineage(token_counts(df, text, label, partitions), "nb-terms")
    totals = terms.agg(
        F.count(F.lit(1)).alias("V"),
        F.coalesce(F.sum("c0"), F.lit(0)).alias("t0"),
        F.coalesce(F.sum("c1"), F.lit(0)).alias("t1"),
    ).first()
    v = int(totals["V"])
    docs = df.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n_docs")).collect()
    n, k = sum(r["n_docs"] for r in docs), len(docs)  # at most two class rows
    totals_by = {0: int(totals["t0"]), 1: int(totals["t1"])}
    rows = []
    for r in docs:
        c = int(r[label])
        prior = (r["n_docs"] + 1) / (n + k)
        rows.append((c, r["n_docs"], totals_by[c], prior, math.log(prior), math.log(totals_by[c] + v)))
    classes = df.sparkSession.createDataFrame(
        rows, "label int, n_docs long, total_words long, prior double, log_prior double, log_denom double"
    )
    return NBModel(terms=terms, classes=classes, vocab_size=v)


def nb_coefficients(model: NBModel) -> DataFrame:
    """``(feature, importance)``: how far one occurrence of a token moves the log odds, whichever way, to nine digits."""
    denom = {r["label"]: r["log_denom"] for r in model.classes.collect()}  # <= 2 rows
    weight = F.log(F.col("c1") + 1) - F.lit(denom.get(1, 0.0)) - F.log(F.col("c0") + 1) + F.lit(denom.get(0, 0.0))
    return model.terms.select(F.col("token").alias("feature"), F.round(F.abs(weight), 9).alias("importance"))


def save_nb(model: NBModel, path: str) -> str:
    """Write a model's term and class tables below ``path``."""
    model.terms.write.mode("overwrite").parquet(f"{path}/nb_terms")
    model.classes.write.mode("overwrite").parquet(f"{path}/nb_classes")
    return path


def load_nb(spark, path: str) -> NBModel:
    """A model that ``save_nb`` wrote."""
    terms = spark.read.parquet(f"{path}/nb_terms")
    return NBModel(terms=terms, classes=spark.read.parquet(f"{path}/nb_classes"), vocab_size=terms.count())


def nb_score(model: NBModel, df: DataFrame, doc: str, text: str, keep: tuple = (), partitions: int | None = None) -> DataFrame:
    """Per document: ``score0, score1`` (log), ``prediction`` (class 0 wins ties), ``probability`` = P(1).

    ``score_c = ln prior_c + sum_w tf(w) * ln(count_c(w) + 1) - n_tokens * ln(total_c + V)``.
    ``explode_outer`` keeps documents without tokens (they get the priors
    alone) and ``keep`` columns ride along in the grouping key, so no join
    back to the documents is needed.
    """
    cls = {r["label"]: (r["log_prior"], r["log_denom"]) for r in model.classes.collect()}  # <= 2 rows
    lp0, ld0 = cls.get(0, (float("-inf"), 0.0))
    lp1, ld1 = cls.get(1, (float("-inf"), 0.0))
    keys = [doc, *keep]
    toks = dealt(df.select(*keys, text), partitions).select(*keys, tokenize(F.col(text)).alias("_toks"))
    occ = toks.select(*keys, F.explode_outer("_toks").alias("token"))
    tf = occ.groupBy(*keys, "token").agg(F.count("token").alias("tf"))
    joined = lookup_join(tf, model.terms, "token", how="left")
    per_doc = joined.groupBy(*keys).agg(
        F.coalesce(F.sum(F.col("tf") * F.log(F.coalesce(F.col("c0"), F.lit(0)) + 1)), F.lit(0.0)).alias("s0"),
        F.coalesce(F.sum(F.col("tf") * F.log(F.coalesce(F.col("c1"), F.lit(0)) + 1)), F.lit(0.0)).alias("s1"),
        F.sum("tf").cast("double").alias("n_tok"),
    )
    s0 = F.lit(lp0) + F.col("s0") - F.col("n_tok") * F.lit(ld0)
    s1 = F.lit(lp1) + F.col("s1") - F.col("n_tok") * F.lit(ld1)
    out = per_doc.select(*keys, s0.alias("score0"), s1.alias("score1"))
    return out.select(
        "*",
        (F.col("score1") > F.col("score0")).cast("int").alias("prediction"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("score0") - F.col("score1")))).alias("probability"),
    )


# ------------------------------------------------------------------- TF-IDF


def doc_frequency(df: DataFrame, doc: str, text: str, n_max: int = 2, partitions: int | None = None) -> DataFrame:
    """Per term (1-2-grams of 2+ word characters): ``df`` documents containing it, ``cf`` total count."""
    toks = dealt(df.select(doc, text), partitions).select(tokenize(F.col(text), WORD2).alias("_toks"))
    return term_frequencies(toks.select(ngrams(F.col("_toks"), n_max).alias("_t")), "_t")


def term_frequencies(df: DataFrame, terms: str) -> DataFrame:
    """``(token, df, cf)`` from a column of per-document term arrays.

    One aggregate keyed by term only: a document's terms are sorted, and each occurrence is emitted
    once, marked where it is the term's first one in the document.  So no ``(doc, term)``
    intermediate is shuffled and the map-side combine collapses to the vocabulary of each task.
    """
    ordered = df.select(F.sort_array(terms).alias("_s"))
    first = lambda x, i: (i == 0) | ~x.eqNullSafe(F.get("_s", i - 1))
    each = ordered.select(F.explode(F.transform("_s", lambda x, i: F.struct(x.alias("token"), first(x, i).alias("first")))).alias("e"))
    return each.groupBy(F.col("e.token").alias("token")).agg(F.count_if(F.col("e.first")).alias("df"), F.count(F.lit(1)).alias("cf"))


def smooth_idf(n_docs: int, df_col: str = "df"):
    """``ln((1 + n) / (1 + df)) + 1`` (smoothed IDF)."""
    return F.log((F.lit(1.0) + F.lit(n_docs)) / (F.col(df_col) + 1.0)) + 1.0


def top_terms(dfreq: DataFrame, k: int = 50_000) -> DataFrame:
    """The ``k`` most frequent terms (``cf`` descending, ties by term text), exactly.

    The counts are materialised once; the k-th largest ``cf`` is found by selection, and among the
    terms tied at it the smallest by a second selection on the term text.  No task gathers the
    partitions' own top-k.
    """
    from stratum.operators.ordering import select_ranks
    from stratum.session import cut_lineage

    dfreq = cut_lineage(dfreq, "term-counts")
    kth = select_ranks(dfreq.withColumn("_ncf", -F.col("cf")), "_ncf", [k - 1]).get(k - 1)
    if kth is None:  # k or fewer terms: all of them
        return dfreq
    t = -kth[0]
    room = k - dfreq.where(F.col("cf") > F.lit(t)).count()
    cut = select_ranks(dfreq.where(F.col("cf") == F.lit(t)), "token", [room]).get(room)
    tied = F.col("cf") == F.lit(t)
    return dfreq.where((F.col("cf") > F.lit(t)) | ((tied & (F.col("token") < F.lit(cut[0]))) if cut else tied))


def tfidf(df: DataFrame, doc: str, text: str, max_features: int = 50_000, n_max: int = 2, partitions: int | None = None) -> DataFrame:
    """``(doc, token, weight)``: tf x (ln((1+n)/(1+df)) + 1), L2-normalised per document.

    The vocabulary comes from the term-only aggregate.  Documents are dealt by ``doc``; from there on
    everything is local to a task: terms outside the vocabulary are dropped as soon as they are
    read (a join with the vocabulary, broadcast up to ``BROADCAST_TERMS`` terms), the rest is
    counted per document, and the norm is taken in the same grouping that holds a document's weights (at most
    the vocabulary).  No (document, term) pairs are written or shuffled.
    """
    n_docs = df.count()
    vocab = top_terms(doc_frequency(df, doc, text, n_max, partitions), max_features).select("token", smooth_idf(n_docs).alias("idf"))
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.stratum.textPartitions", "0")) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    toks = df.select(doc, text).repartition(n, doc).select(F.col(doc), tokenize(F.col(text), WORD2).alias("_toks"))
    occurs = toks.select(F.col(doc), F.explode(ngrams(F.col("_toks"), n_max)).alias("token"))
    known = occurs.join(F.broadcast(vocab), "token") if max_features <= BROADCAST_TERMS else lookup_join(occurs, vocab, "token")
    counts = known.groupBy(doc, "token").agg((F.count(F.lit(1)) * F.first("idf")).alias("w"))
    per_doc = counts.groupBy(doc).agg(F.collect_list(F.struct("token", "w")).alias("_t"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return per_doc.select(doc, "_norm", F.inline("_t")).select(doc, "token", (F.col("w") / F.col("_norm")).alias("weight"))


# -------------------------------------------------------------------- dedup


def normalized_text(c):
    """Lower-case, collapse whitespace runs, trim."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def dedup_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Keep one row per normalised text: the one with the lowest key.

    Groups on the SHA-256 of the normalised text (a 64-byte key instead of
    whole texts in the shuffle); ``min`` is algebraic, so a text copied a
    million times still combines map-side.
    """
    digest = F.sha2(normalized_text(F.col(text)), 256)
    keep = df.select(digest.alias("_n"), F.col(key)).groupBy("_n").agg(F.min(key).alias(key)).select(key)
    return df.join(keep, key, "left_semi")
