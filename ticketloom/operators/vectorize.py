"""Count and TF-IDF vectors, embeddings, SVD, feature combination."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.vectors import as_array, as_vector, entries, width_of
from ticketloom.operators.decompose import truncated_svd

TOKEN = r"[\p{L}\p{N}_]{2,}"


#: The English stop words of Spark's own StopWordsRemover, in its order.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t
can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've
we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't
cannot could here's how's let's ought that's there's what's when's where's who's why's would
""".split()


def english_stop_words() -> list[str]:
    """Spark's own English list, the default where stop words are asked for by name; needs no session."""
    return list(ENGLISH_STOP_WORDS)


def tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """Word runs of two or more characters, case kept, stop words taken out."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All n-grams with ``low <= n <= high``, joined by a space; ``words`` is one array."""
    def of(ws: Column, n: int) -> Column:
        if n == 1:
            return ws
        starts = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))

    held = F.transform(F.array(words), lambda ws: F.concat(*[of(ws, n) for n in range(low, high + 1)]))
    return held[0]


@dataclass(frozen=True)
class TextVectorizer:
    """Parameters of a count or TF-IDF vectoriser; ``fit`` gives a model."""

    kind: str = "tfidf"
    max_features: int = 10_000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_df: float = 0.95
    stop_words: list[str] | str | None = "english"

    def __post_init__(self):
        if self.kind not in ("tfidf", "count"):
            raise ValueError(f"Unsupported vectorizer type: {self.kind}")

    def stop_list(self) -> list[str]:
        return english_stop_words() if self.stop_words == "english" else list(self.stop_words or [])

    def terms(self, text: Column) -> Column:
        return ngrams(tokens(text, self.stop_list()), *self.ngram_range)

    def vocabulary(self, df: DataFrame, text_column: str) -> DataFrame:
        """``(term, tf, df, n_docs, idx)`` of the kept terms.

        Each document emits its term occurrences and its distinct terms; both are summed in
        one map-side combined aggregate by term, so no (document, term) pairs are shuffled.
        The top ``max_features`` are a distributed top-k.
        """
        docs = df.select(self.terms(F.col(text_column)).alias("t"))
        n_docs = df.count()
        marks = F.concat(
            F.transform("t", lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
            F.transform(F.array_distinct("t"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))),
        )
        stats = docs.select(F.explode(marks).alias("m")).groupBy("m.term").agg(F.sum("m.tf").alias("tf"), F.sum("m.df").alias("df"))
        kept = stats.filter((F.col("df") >= self.min_df) & (F.col("df") <= F.lit(float(self.max_df)) * F.lit(n_docs)))
        top = kept.orderBy(F.desc("tf"), "term").limit(self.max_features)
        return top.withColumn("n_docs", F.lit(n_docs).cast("bigint"))

    def fit(self, df: DataFrame, text_column: str, output: str = "features") -> "TextVectorModel":
        """Fix the vocabulary. It holds at most ``max_features`` terms, hence the collect."""
        rows = sorted(self.vocabulary(df, text_column).collect(), key=lambda r: r["term"])
        if not rows:
            raise ValueError("empty vocabulary; the texts may hold only stop words")
        return TextVectorModel(self, text_column, output, [r["term"] for r in rows], [r["df"] for r in rows], rows[0]["n_docs"])


@dataclass
class TextVectorModel:
    """A fitted vectoriser: columns are the terms in alphabetical order.

    The transform is narrow: term lookup, scaling and normalising all happen inside the
    row, JVM-side, with no shuffle; it therefore also runs on a stream.
    """

    params: TextVectorizer
    text_column: str
    output: str
    terms: list[str]
    doc_freq: list[int]
    n_docs: int
    _stages: PipelineModel | None = field(default=None, repr=False)

    def idf(self) -> list[float]:
        return [float(np.log((1 + self.n_docs) / (1 + d)) + 1) for d in self.doc_freq]

    def stages(self) -> PipelineModel:
        if self._stages is None:
            raw = self.output if self.params.kind == "count" else "_counts"
            spark = SparkSession.getActiveSession()
            counter = CountVectorizerModel.from_vocabulary(self.terms, "_terms", raw)
            steps = [counter]
            if self.params.kind == "tfidf":
                steps.append(ElementwiseProduct(scalingVec=Vectors.dense(self.idf()), inputCol=raw, outputCol="_weighted"))
                steps.append(Normalizer(p=2.0, inputCol="_weighted", outputCol=self.output))
            self._stages = PipelineModel(steps)
        return self._stages

    def transform(self, df: DataFrame, text_column: str | None = None) -> DataFrame:
        """Add the vector column; unseen terms are ignored, empty texts give zero vectors."""
        source = df.withColumn("_terms", self.params.terms(F.col(text_column or self.text_column)))
        return self.stages().transform(source).drop("_terms", "_counts", "_weighted")

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, d, w) for i, (t, d, w) in enumerate(zip(self.terms, self.doc_freq, self.idf()))]
        return spark.createDataFrame(rows, "idx int, term string, df bigint, idf double")

    def weights(self, df: DataFrame, id_col: str) -> DataFrame:
        """Long form ``(id, term, weight)`` of the non-zero weights."""
        long = entries(self.transform(df.select(id_col, self.text_column)), self.output, [id_col])
        names = F.lit(self.terms)
        return long.select(id_col, F.element_at(names, F.col("idx") + 1).alias("term"), F.col("w").alias("weight"))

    def importance(self, df: DataFrame, top_k: int = 20) -> DataFrame:
        """Terms with the highest column mean, zeros included."""
        long = entries(self.transform(df.select(self.text_column)), self.output, [])
        n = df.count()
        names = F.lit(self.terms)
        means = long.groupBy("idx").agg((F.sum("w") / n).alias("importance"))
        named = means.select(F.element_at(names, F.col("idx") + 1).alias("term"), "importance")
        return named.orderBy(F.desc(F.round("importance", 9)), "term").limit(top_k)


def filled_text(text: Column, blank: str = "empty") -> Column:
    """The text, or ``blank`` where there is nothing to encode."""
    return F.when(text.isNull() | (F.trim(F.regexp_replace(text, r"(?U)\s", " ")) == ""), blank).otherwise(text)


#: Characters of text that one task trains word vectors on, and the most tasks: their vectors are averaged.
WORDS_CHARS, WORDS_PARTS = 8_000_000, 64


@dataclass
class WordEmbedding:
    """Word vectors trained on Spark and averaged per text: the built-in encoder. Tasks follow the size of the texts alone."""

    text_column: str
    output: str
    model: Word2VecModel

    @classmethod
    def fit(cls, df: DataFrame, text_column: str, output: str = "embedding", size: int = 64, min_count: int = 2, seed: int = 42) -> "WordEmbedding":
        words = df.select(tokens(filled_text(F.col(text_column))).alias("_words"))
        chars = df.agg(F.sum(F.length(text_column)).alias("n")).first()["n"] or 0
        parts = max(1, min(WORDS_PARTS, -(-chars // WORDS_CHARS)))
        learner = Word2Vec(vectorSize=size, minCount=min_count, seed=seed, maxIter=1, numPartitions=parts, inputCol="_words", outputCol=output)
        return cls(text_column, output, learner.fit(words))

    def transform(self, df: DataFrame) -> DataFrame:
        words = df.withColumn("_words", tokens(filled_text(F.col(self.text_column))))
        return self.model.setInputCol("_words").setOutputCol(self.output).transform(words).drop("_words")


def embed(df: DataFrame, text_column: str, encode=None, output: str = "embedding", batch_size: int = 32) -> DataFrame:
    """Dense vector per text; a blank text is encoded as the word ``empty``.

    ``encode(list[str]) -> 2-D array`` is the caller's model, called per Arrow batch inside
    the tasks. Without one the built-in word vectors are trained and used.
    """
    if encode is None:
        out = WordEmbedding.fit(df, text_column, output).transform(df)
        return out.withColumn(output, vector_to_array(output, "float32"))
    source = df.withColumn("_text", filled_text(F.col(text_column)))
    schema = T.StructType([f for f in source.schema if f.name != "_text"] + [T.StructField(output, T.ArrayType(T.FloatType()))])

    def run(batches):
        for pdf in batches:
            texts = pdf.pop("_text").tolist()
            vectors = [row for i in range(0, len(texts), batch_size) for row in np.asarray(encode(texts[i:i + batch_size]), dtype="float32")]
            pdf[output] = [v.tolist() for v in vectors]
            yield pdf

    return source.mapInPandas(run, schema)


def reduce_dimensions(df: DataFrame, column: str, n_components: int = 300, method: str = "svd", output: str = "reduced") -> DataFrame:
    """Uncentred truncated SVD; the output is the projection U times sigma.

    Sums over rows are d x k numbers; see :mod:`ticketloom.operators.decompose`.
    """
    if method != "svd":
        raise ValueError(f"Unsupported reduction method: {method}")
    source = as_vector(df, column)
    return source.withColumn(output, truncated_svd(source, column, n_components).project(source, column))


def combine_features(df: DataFrame, columns: list[str], method: str = "concatenate", output: str = "features") -> DataFrame:
    """Side by side, or element-wise mean of equally wide columns."""
    if method == "concatenate":
        source = df
        for c in columns:
            source = as_vector(source, c)
        return VectorAssembler(inputCols=columns, outputCol=output).transform(source)
    if method == "average":
        source = df
        for i, c in enumerate(columns):
            source = source.withColumn(f"_a{i}", F.col(c))
            source = as_array(source, f"_a{i}")
        total = F.col("_a0")
        for i in range(1, len(columns)):
            total = F.zip_with(total, F.col(f"_a{i}"), lambda a, b: a + b)
        mean = F.transform(total, lambda v: v / len(columns))
        widths = F.array(*[F.size(f"_a{i}") for i in range(len(columns))])
        checked = F.when(F.array_min(widths) == F.array_max(widths), mean).otherwise(
            F.raise_error(F.lit("averaged features differ in width")).cast("array<double>"))
        return source.withColumn(output, array_to_vector(checked)).drop(*[f"_a{i}" for i in range(len(columns))])
    raise ValueError(f"Unsupported combination method: {method}")


@dataclass
class FrameVectors:
    """A vectoriser per text column and their combination."""

    models: dict[str, "TextVectorModel | WordEmbedding"]
    combine: str = "concatenate"
    output: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for model in self.models.values():
            out = model.transform(out)
        names = [m.output for m in self.models.values()]
        return combine_features(out, names, self.combine, self.output).drop(*names)

    def feature_names(self) -> list[str]:
        names = []
        for column, model in self.models.items():
            terms = model.terms if isinstance(model, TextVectorModel) else range(model.model.getVectorSize())
            names += [f"{column}:{term}" for term in terms]
        return names

    def shapes(self, df: DataFrame) -> DataFrame:
        """``(vectorizer, n_rows, n_features)`` per column and in total."""
        n = df.count()
        width = lambda m: (m.params.kind, len(m.terms)) if isinstance(m, TextVectorModel) else ("embedding", m.model.getVectorSize())
        widths = [(f"{c}_{width(m)[0]}", n, width(m)[1]) for c, m in self.models.items()]
        total = sum(w for _, _, w in widths) if self.combine == "concatenate" else widths[0][2]
        return df.sparkSession.createDataFrame(widths + [("total", n, total)], "vectorizer string, n_rows bigint, n_features bigint")


def vectorize_frame(
    df: DataFrame, text_columns: list[str], configs: "dict[str, TextVectorizer | type[WordEmbedding]] | None" = None, combine: str = "concatenate"
) -> FrameVectors:
    """Fit one vectoriser per present column; columns without a config get TF-IDF.

    The config ``WordEmbedding`` gives a column averaged word vectors.
    """
    present = [c for c in text_columns if c in df.columns]
    if not present:
        raise ValueError("no text column to vectorise")
    with ThreadPoolExecutor(len(present)) as pool:  # independent jobs, side by side
        models = dict(zip(present, pool.map(lambda c: (configs or {}).get(c, TextVectorizer()).fit(df, c, f"_{c}_features"), present)))
    return FrameVectors(models, combine)
