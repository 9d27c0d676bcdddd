"""TF-IDF over canned-reply texts: a bounded vocabulary, then shuffle-free vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.functions.text import STOP_WORDS, clean_text, ngram_terms, remove_boilerplate, tokens
from replyscope.schemas import TFIDF_MAX_DF, TFIDF_MAX_FEATURES, TFIDF_MIN_DF, TFIDF_NGRAMS
from replyscope.sources.tables import stage

COUNTS = "term string, df long, total long"
TEXTS = 5_000  # texts whose words are counted at a time


def prepare_texts(macros: DataFrame, boilerplate: list[str] | None = None) -> DataFrame:
    """Name, category and body in one cleaned text."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("macro_name", "category", "macro_body")]
    combined = F.concat_ws(" ", *parts)
    return macros.withColumn("cleaned_text", remove_boilerplate(clean_text(combined), boilerplate))


def prepare_bodies(macros: DataFrame, column: str = "macro_body") -> DataFrame:
    return macros.withColumn("cleaned_text", remove_boilerplate(clean_text(column)))


@dataclass
class TfidfModel:
    """Vocabulary and weights. Its size is bounded by ``max_features``; terms are ordered rare first."""

    terms: list[str]
    document_frequency: list[int]
    n_documents: int
    ngrams: tuple[int, int] = TFIDF_NGRAMS
    stop_words: list[str] = field(default_factory=lambda: STOP_WORDS)

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n_documents) / (1 + n)) + 1 for n in self.document_frequency]

    def with_terms(self, texts: DataFrame, text: str = "cleaned_text") -> DataFrame:
        return _with_terms(texts, text, self.ngrams, self.stop_words)

    def stages(self, output: str = "features") -> PipelineModel:
        """Counting, weighting and unit length as pipeline stages over the ``_terms`` column."""
        if not self.terms:
            raise ValueError("no term passed the document-frequency limits")
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_counts")
        weigh = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted"
        )
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
        return PipelineModel([counter, weigh, unit])

    def transform(self, texts: DataFrame, text: str = "cleaned_text", output: str = "features") -> DataFrame:
        """Unit TF-IDF vectors, row by row: no shuffle, the vocabulary travels as a broadcast."""
        counted = self.stages(output).transform(self.with_terms(texts, text))
        return counted.drop("_terms", "_counts", "_weighted")

    def term_table(self, like: DataFrame) -> DataFrame:
        rows = [(i, t, n, w) for i, (t, n, w) in enumerate(zip(self.terms, self.document_frequency, self.idf))]
        return like.sparkSession.createDataFrame(rows, "idx int, term string, df long, idf double")


def _with_terms(texts: DataFrame, text: str, ngrams: tuple[int, int], stop_words: list[str]) -> DataFrame:
    return texts.withColumn("_tokens", tokens(text, stop_words)).withColumn(
        "_terms", ngram_terms("_tokens", ngrams)
    ).drop("_tokens")


def fit_tfidf(
    texts: DataFrame,
    text: str = "cleaned_text",
    max_features: int = TFIDF_MAX_FEATURES,
    min_df: int = 1,
    max_df: float = 1.0,
    ngrams: tuple[int, int] = TFIDF_NGRAMS,
    stop_words: list[str] | None = None,
    copies: str | None = None,
) -> TfidfModel:
    """Choose terms by document frequency, then the most frequent ``max_features`` (ties by term).

    Words are counted first. A longer term stands nowhere oftener, nor in more texts, than its rarest word, so only terms are counted whose
    words all pass the least document frequency and are as frequent as the last word that would be chosen: most pairs of words
    are never counted. Tasks add up their texts before the one shuffle by term. ``copies`` names a column telling
    how many identical texts a row stands for.
    """
    stop = STOP_WORDS if stop_words is None else stop_words
    weight = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    n_documents = texts.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    listed = texts.select(tokens(text, stop).alias("words"), weight.alias("m"))

    def chosen(counted: DataFrame) -> DataFrame:
        kept = counted.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.lit(n_documents)))
        return kept.orderBy(F.desc("total"), "term").limit(max_features)

    words = listed.mapInArrow(_count_terms(1, None), COUNTS).groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    low, high = ngrams
    if high > 1:
        words = stage(words)
        first = [r["total"] for r in chosen(words).select("total").collect()] if low == 1 else []
        least = min(first) if len(first) == max_features else 0
        if least:
            common = {r["term"] for r in words.where((F.col("df") >= min_df) & (F.col("total") >= least)).select("term").collect()}
        else:  # no bound is known: words of any frequency
            common = None
        longer = [listed.mapInArrow(_count_terms(n, common), COUNTS) for n in range(max(low, 2), high + 1)]
        counted = reduce(DataFrame.unionByName, longer).groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        words = counted.unionByName(words) if low == 1 else counted
    rows = sorted(chosen(words).select("term", "df").collect(), key=lambda r: (r["df"], r["term"]))
    return TfidfModel([r["term"] for r in rows], [r["df"] for r in rows], n_documents, ngrams, stop)


def _count_terms(n: int, common: set[str] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts (term, df, total) of the n-grams of each batch of rows (words, m); only of ``common`` words if they are given.

    Words are numbered in the batch; a term is the number of its first n - 1 words and of its last one, numbered anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, TEXTS) for whole in batches for k in range(0, len(whole), TEXTS)):
            lists, weight = batch.column(0), np.asarray(batch.column(1).fill_null(0))
            coded = lists.flatten().dictionary_encode()
            names, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            used = np.array([w in common for w in names.to_pylist()], dtype=bool) if common is not None else np.ones(len(names), dtype=bool)
            term, good = codes, used[codes]
            terms = names
            for k in range(1, n):
                whole = good[:-1] & used[codes[k:]] & (row[:-k] == row[k:])
                kinds, numbers = np.unique(term[:-1][whole] * len(names) + codes[k:][whole], return_inverse=True)
                terms = pc.binary_join_element_wise(terms.take(pa.array(kinds // len(names))), names.take(pa.array(kinds % len(names))), " ")
                term, good = np.zeros(len(whole), dtype=np.int64), whole
                term[whole] = numbers
            term, row = term[good], row[: len(good)][good]
            total = np.bincount(term, weight[row], minlength=len(terms))
            once = np.sort(row * max(1, len(terms)) + term)
            once = once[np.diff(once, prepend=-1) > 0]
            df = np.bincount(once % max(1, len(terms)), weight[once // max(1, len(terms))], minlength=len(terms))
            met = np.flatnonzero(np.bincount(term, minlength=len(terms)))
            yield pa.RecordBatch.from_arrays(
                [terms.take(pa.array(met)).cast(pa.string()), pa.array(df[met].astype(np.int64)), pa.array(total[met].astype(np.int64))],
                names=["term", "df", "total"],
            )

    return run


def fit_macro_tfidf(prepared: DataFrame, max_features: int = TFIDF_MAX_FEATURES) -> TfidfModel:
    """The clustering vocabulary: rare and near-universal terms removed."""
    return fit_tfidf(prepared, max_features=max_features, min_df=TFIDF_MIN_DF, max_df=TFIDF_MAX_DF)


def tfidf_terms(model: TfidfModel, texts: DataFrame, id_col: str = "macro_id") -> DataFrame:
    """Long form (id, term, weight) of the non-zero weights."""
    vectors = model.transform(texts.select(id_col, "cleaned_text"))
    weights = vectors.select(id_col, F.posexplode(vector_to_array("features")).alias("idx", "weight"))
    named = weights.where(F.col("weight") > 0).join(
        F.broadcast(model.term_table(texts).select("idx", "term")), "idx"
    )
    return named.select(id_col, "term", "weight")


def top_terms(model: TfidfModel, texts: DataFrame, n: int = 20) -> DataFrame:
    """Terms with the largest summed weight."""
    summed = tfidf_terms(model, texts).groupBy("term").agg(F.sum("weight").alias("total_weight"))
    return summed.orderBy(F.desc("total_weight"), "term").limit(n)
