"""The whole ticket classification flow: select, translate, clean, encode, split,
vectorise, balance, advise, train, evaluate, predict."""

from __future__ import annotations

import copy
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.noise import NoiseRegistry
from ticketloom.functions.vectors import as_vector
from ticketloom.operators import balance, split, strategy
from ticketloom.operators.clean import clean_interaction, clean_summary, spread_input, with_cleaned
from ticketloom.operators.evaluate import best_model, compare_models, evaluate_classification, evaluation_report
from ticketloom.operators.labels import class_mapping, encode_labels
from ticketloom.operators.models import ModelBench, NeighbourModel
from ticketloom.operators.select import select_tickets
from ticketloom.operators.translate import translate_column
from ticketloom.operators.vectorize import FrameVectors, TextVectorizer, TextVectorModel, WordEmbedding, vectorize_frame
from ticketloom.session import settle_table
from ticketloom.sources.tickets import INTERACTION, SUMMARY, read_tickets_csv

# Configuration sections and their defaults.
DEFAULT_CONFIG = {
    "data_selection": {"filter_frequency": True, "min_samples_per_class": 10, "frequency_column": "y1"},
    "translation": {"enable": False, "max_chars": None},
    "preprocessing": {"clean_summary": True, "clean_interaction": True, "spread": True},
    "vectorization": {"method": "tfidf", "max_features": 10000, "ngram_range": [1, 2]},
    "sampling": {"enable": True, "method": "auto"},
    "data_split": {"test_size": 0.2, "stratify": True, "method": "basic", "time_column": None, "group_column": None},
    "modeling": {"models": ["random_forest", "logistic_regression", "naive_bayes"], "hyperparameter_tuning": False,
                 "param_grids": {}, "compat_order": False, "parallelism": 4},
}


def load_config(source: str | dict | None = None) -> dict:
    """Defaults overlaid with a JSON text or dict; an unknown section or key is an error."""
    given = json.loads(source) if isinstance(source, str) else (source or {})
    config = copy.deepcopy(DEFAULT_CONFIG)
    for section, values in given.items():
        if section not in config:
            raise ValueError(f"unknown section: {section}")
        unknown = set(values) - set(config[section])
        if unknown:
            raise ValueError(f"unknown keys in {section}: {sorted(unknown)}")
        config[section].update(values)
    return config


def read_config(spark: SparkSession, path: str) -> dict:
    return load_config("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def select_step(df: DataFrame, config: dict, target: str) -> DataFrame:
    section = config["data_selection"]
    return select_tickets(df, target, section["filter_frequency"], section["frequency_column"], section["min_samples_per_class"])


def translate_step(df: DataFrame, config: dict, translate_fn, profiles=None, lang_col: str | None = None) -> DataFrame:
    """Only the summary is translated; cleaning then reads the translated column."""
    return translate_column(df, SUMMARY, translate_fn, profiles=profiles, lang_col=lang_col, max_chars=config["translation"]["max_chars"])


def clean_step(df: DataFrame, config: dict, registry: NoiseRegistry | None = None, drop_empty: bool = True) -> DataFrame:
    """Add ``ts`` and ``ic``; a switched-off cleaner copies its column."""
    section = config["preprocessing"]
    source = f"{SUMMARY}_en" if config["translation"]["enable"] and f"{SUMMARY}_en" in df.columns else SUMMARY
    summary, interaction = F.col(f"`{source}`"), F.col(f"`{INTERACTION}`")
    as_is = lambda c: F.coalesce(c, F.lit(""))
    ts = clean_summary(summary, registry) if section["clean_summary"] else as_is(summary)
    ic = clean_interaction(interaction, registry) if section["clean_interaction"] else as_is(interaction)
    return with_cleaned(spread_input(df) if section["spread"] else df, ts, ic, drop_empty=drop_empty)


def structure_step(df: DataFrame, target: str) -> tuple[DataFrame, list[str]]:
    """Encode the target and ``y1``; returns the class names in code order."""
    encoded = encode_labels(df, list(dict.fromkeys([target, "y1"])))
    names = [r["class"] for r in class_mapping(df, [target]).orderBy("code").collect()]
    return encoded, names


def vectorize_step(df: DataFrame, config: dict) -> FrameVectors:
    """Both text columns are fitted side by side."""
    section = config["vectorization"]
    kind = WordEmbedding if section["method"] == "embedding" else TextVectorizer(section["method"], section["max_features"], tuple(section["ngram_range"]))
    return vectorize_frame(df, ["ts", "ic"], {"ts": kind, "ic": kind})


def sample_step(df: DataFrame, config: dict) -> DataFrame:
    """``(id, label, features)`` with unique string ids; balanced tables are not touched."""
    method = config["sampling"]["method"]
    if method not in balance.BALANCERS:
        raise ValueError(f"unknown sampling method: {method}")
    if not config["sampling"]["enable"] or balance.imbalance_summary(df, "label").first()["is_balanced"]:
        return df.select(F.col("id").cast("string").alias("id"), "label", "features")
    grown = balance.BALANCERS[method](df, "label", "id", "features")
    if "row_key" in grown.columns:
        grown = grown.select(F.col("row_key").alias("id"), "label", "features")
    elif "copy_no" in grown.columns:
        key = F.when(F.col("copy_no") == 0, F.col("id").cast("string")).otherwise(F.concat_ws("|", F.col("id").cast("string"), F.col("copy_no").cast("string")))
        grown = grown.select(key.alias("id"), "label", "features")
    return as_vector(grown.select(F.col("id").cast("string").alias("id"), "label", "features"), "features")


def strategy_step(df: DataFrame) -> dict:
    return strategy.recommend(df, "id", "features", "label")


def split_step(df: DataFrame, config: dict, label: str = "label") -> DataFrame:
    section = config["data_split"]
    method, size = section["method"], section["test_size"]
    if method == "basic":
        return split.basic_split(df, label, "id", size, section["stratify"])
    if method == "temporal":
        return split.temporal_split(df, section["time_column"], "id", size, 0.0)
    if method == "group":
        return split.group_split(df, section["group_column"], size)
    if method == "rare_class":
        return split.rare_class_split(df, label, "id", size)
    raise ValueError(f"unknown split method: {method}")


def model_step(train: DataFrame, test: DataFrame, config: dict) -> tuple[ModelBench, dict[str, DataFrame], dict[str, DataFrame]]:
    """Train the configured models (tuned ones too if asked) and evaluate them on the test rows, some side by side.

    Returns the bench, one evaluation row per model, and the scored test rows those came from.
    """
    section, bench = config["modeling"], ModelBench()
    bench.fit_many(train, section["models"], test, section["parallelism"])
    if section["hyperparameter_tuning"]:
        for name, grid in section["param_grids"].items():
            bench.tune(train, name, grid)
    held = test.withColumn("label", F.col("label").cast("double")).select("id", "label", "features")

    def one(name: str) -> tuple[DataFrame, DataFrame]:
        scored = settle_table(bench.predict(held, name, probability=True), "scored")
        return settle_table(evaluate_classification(scored, probability="probability", model=name), "evaluation"), scored

    with ThreadPoolExecutor(section["parallelism"]) as pool:
        found = dict(zip(bench.trained, pool.map(one, bench.trained)))
    return bench, {n: e for n, (e, _) in found.items()}, {n: t for n, (_, t) in found.items()}


@dataclass
class FlowModel:
    """A fitted flow. ``transform`` is row by row, so it serves tables and streams alike; only knn needs a table or the
    batches of a stream, which ``streaming.scoring.score_stream`` gives it."""

    config: dict
    classes: list[str]
    vectors: FrameVectors
    bench: ModelBench
    best: str
    registry: NoiseRegistry = field(default_factory=NoiseRegistry)

    def transform(self, df: DataFrame, model_name: str | None = None, keep: list[str] | None = None) -> DataFrame:
        """Tickets to ``(*keep, prediction, predicted_label)``; texts are cleaned first, no row is dropped."""
        keep = keep or ["id"]
        if df.isStreaming and isinstance(self.bench.get(model_name or self.best), NeighbourModel):
            raise ValueError("knn joins its training rows and scores a stream batch by batch; use score_stream")
        cleaned = clean_step(df, self.config, self.registry, drop_empty=False)
        scored = self.bench.get(model_name or self.best).transform(self.vectors.transform(cleaned))
        name = F.element_at(F.array(*[F.lit(c) for c in self.classes]), F.col("prediction").cast("int") + 1)
        return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"), name.alias("predicted_label"))

    def by_batch(self, model_name: str | None = None) -> bool:
        """Whether a stream has to be scored batch by batch."""
        return isinstance(self.bench.get(model_name or self.best), NeighbourModel)

    def save(self, spark: SparkSession, path: str) -> None:
        """A folder: settings as JSON text, vocabularies as parquet, models by Spark ML."""
        columns = {}
        for column, model in self.vectors.models.items():
            if isinstance(model, TextVectorModel):
                p = model.params
                columns[column] = {"kind": p.kind, "max_features": p.max_features, "ngram_range": list(p.ngram_range), "min_df": p.min_df,
                                   "max_df": p.max_df, "stop_words": p.stop_words, "n_docs": model.n_docs, "output": model.output}
                model.vocabulary(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabulary/{column}")
            else:
                columns[column] = {"kind": "embedding", "output": model.output}
                model.model.write().overwrite().save(f"{path}/embedding/{column}")
        models = {n: {"kind": self.bench.kind(n), **({"k": t.model.k, "search": t.model.search} if self.bench.kind(n) == "knn" else {})} for n, t in self.bench.trained.items()}
        patterns = {c: list(self.registry.patterns(c)) for c in self.registry.categories}
        settings = {"config": self.config, "classes": self.classes, "best": self.best, "columns": columns, "models": models,
                    "patterns": patterns, "combine": self.vectors.combine}
        spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
        for name in models:
            self.bench.save(name, f"{path}/models/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FlowModel":
        settings = json.loads(spark.read.text(f"{path}/settings").first()["value"])
        models = {}
        for column, p in settings["columns"].items():
            if p["kind"] == "embedding":
                models[column] = WordEmbedding(column, p["output"], Word2VecModel.load(f"{path}/embedding/{column}"))
                continue
            rows = spark.read.parquet(f"{path}/vocabulary/{column}").orderBy("idx").collect()
            params = TextVectorizer(p["kind"], p["max_features"], tuple(p["ngram_range"]), p["min_df"], p["max_df"], p["stop_words"])
            models[column] = TextVectorModel(params, column, p["output"], [r["term"] for r in rows], [r["df"] for r in rows], p["n_docs"])
        bench = ModelBench()
        for name, saved in settings["models"].items():
            bench.load(f"{path}/models/{name}", name, **saved)
        registry = NoiseRegistry({c: tuple(ps) for c, ps in settings["patterns"].items()})
        return cls(settings["config"], settings["classes"], FrameVectors(models, settings["combine"]), bench, settings["best"], registry)


@dataclass
class FlowResult:
    model: FlowModel
    strategy: dict
    evaluations: dict[str, DataFrame]
    rows: int
    n_features: int
    train_rows: int
    test_rows: int
    scored: dict[str, DataFrame] = field(default_factory=dict)

    def report(self, model_name: str | None = None) -> str:
        """The evaluation report of a model (the best by default), its classes by name."""
        name = model_name or self.model.best
        return evaluation_report(self.scored[name], probability="probability", model=name, class_names=self.model.classes)

    def comparison(self) -> DataFrame:
        return compare_models(list(self.evaluations.values()))


@dataclass
class TicketFlow:
    """``fit`` runs the steps. By default rows are split before anything is fitted or
    copied; ``compat_order`` vectorises and balances all rows first and splits after."""

    config: dict = field(default_factory=load_config)
    registry: NoiseRegistry = field(default_factory=NoiseRegistry)

    def prepare(self, df: DataFrame, target: str = "y2", translate_fn=None, profiles=None, lang_col: str | None = None) -> tuple[DataFrame, list[str]]:
        """Selection to encoded labels; stored once, since every later step reads it."""
        out = select_step(df, self.config, target)
        if self.config["translation"]["enable"]:
            out = translate_step(out, self.config, translate_fn, profiles, lang_col)
        out = clean_step(out, self.config, self.registry)
        extra = [c for c in (self.config["data_split"]["time_column"], self.config["data_split"]["group_column"]) if c]
        out = settle_table(out.select(*dict.fromkeys(["id", "ts", "ic", target, "y1", *extra])), "cleaned")
        encoded, names = structure_step(out, target)
        return encoded.withColumn("label", F.col(f"{target}_encoded")), names

    def fit(self, df: DataFrame, target: str = "y2", translate_fn=None, profiles=None, lang_col: str | None = None) -> FlowResult:
        data, names = self.prepare(df, target, translate_fn, profiles, lang_col)
        rows = data.count()
        shaped = ["id", "label", "features"]
        if self.config["modeling"]["compat_order"]:
            vectors = vectorize_step(data, self.config)
            balanced = settle_table(sample_step(vectors.transform(data).select(*shaped), self.config), "balanced")
            advice = strategy_step(balanced)
            parts = split_step(balanced, self.config)
            train, test = parts.filter("split = 'train'").select(*shaped), parts.filter("split = 'test'").select(*shaped)
        else:
            parts = settle_table(split_step(data, self.config), "parts")
            vectors = vectorize_step(parts.filter("split = 'train'"), self.config)
            train = sample_step(vectors.transform(parts.filter("split = 'train'")).select(*shaped), self.config)
            test = vectors.transform(parts.filter("split = 'test'")).select(F.col("id").cast("string").alias("id"), "label", "features")
            advice = None
        train, test = settle_table(train, "train"), settle_table(test, "test")
        advice = advice or strategy_step(train)
        bench, evaluations, scored = model_step(train, test, self.config)
        best, _ = best_model(list(evaluations.values()))
        model = FlowModel(self.config, names, vectors, bench, best, self.registry)
        return FlowResult(model, advice, evaluations, rows, advice["n_features"], train.count(), test.count(), scored)

    def fit_csv(self, spark: SparkSession, path: str, target: str = "y2", **kwargs) -> FlowResult:
        return self.fit(read_tickets_csv(spark, path), target, **kwargs)
