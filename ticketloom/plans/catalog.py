"""Every operator as a query over the test tables: ``QUERIES[name](spark, sf_dir)``.

Names start with the operator's inventory id. Each query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.hashing import hash_unit, keyed_hash
from ticketloom.functions.noise import NoiseRegistry
from ticketloom.functions.vectors import entries, width_of
from ticketloom.operators import anomaly, balance, clean, cluster, decompose, evaluate, labels, logistic, memo, models, neighbours, rank, select, split, strategy, translate, vectorize
from ticketloom.plans import flow, variants
from ticketloom.session import scratch_path, settle_table
from ticketloom.sources.tickets import INTERACTION, SUMMARY, TICKET_SCHEMA, csv_to_parquet, read_tickets_csv, table, tickets_view, write_tickets_csv
from ticketloom.streaming.scoring import messages_as_tickets, score_stream, scored_rows, ticket_stream

QUERIES: dict = {}


def query(name: str):
    def keep(fn):
        QUERIES[name] = fn
        return fn
    return keep


def r(column, digits: int = 6):
    """Rounded, with negative zero made plain zero."""
    return F.round(column, digits) + F.lit(0.0)


# ---- views over the given tables -------------------------------------------------------

def selected(s, d, min_count: int = 10) -> DataFrame:
    return select.select_tickets(tickets_view(s, d), min_count=min_count)


def cleaned(s, d) -> DataFrame:
    return clean.preprocess(selected(s, d))


def order_labels(s, d) -> DataFrame:
    return table(s, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_totalprice") < 50000, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.year("o_orderdate").cast("string").alias("year"))


def vec3(s, d) -> DataFrame:
    return table(s, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"),
        F.when(F.col("label") == 0, 0).when(F.col("label") <= 2, 1).otherwise(2).alias("label"))


def predictions(s, d) -> DataFrame:
    score = hash_unit(F.md5(F.col("doc_id").cast("string")))
    return table(s, d, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"), score.alias("score"), (score >= 0.5).cast("int").alias("prediction"))


def lang_predictions(s, d) -> DataFrame:
    """Three or more classes: the language code of a document against a hashed guess."""
    base = table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    coded = labels.encode_labels(base, ["lang"])
    weight = [hash_unit(keyed_hash("p", F.col("id"), F.lit(i))) + F.when(F.col("lang_encoded") == i, 0.5).otherwise(0.0) for i in range(coded.agg(F.countDistinct("lang_encoded")).first()[0])]
    held = coded.withColumn("probability", F.array(*weight))
    best = F.array_position("probability", F.array_max("probability")).cast("int") - 1
    return held.select("id", F.col("lang_encoded").alias("label"), "probability", best.alias("prediction"))


def texts(s, d) -> DataFrame:
    """Documents, spread over more tasks than their few row groups give."""
    return clean.spread_input(table(s, d, "documents"))


def messages(s, d) -> DataFrame:
    return clean.spread_input(table(s, d, "conversations")).select(F.concat_ws(":", "conv_id", "turn").alias("id"), "role", "text")


def stub_translation(texts, langs):
    return [f"<{lang}> {text}" for text, lang in zip(texts, langs)]


# ---- D: sources and selection ----------------------------------------------------------

def _digest(column: str):
    return F.md5(F.col(f"`{column}`"))


@query("d_01_csv_scan")
def _(s, d):
    path = scratch_path(s, "tickets-csv")
    write_tickets_csv(tickets_view(s, d).select(*TICKET_SCHEMA.names), path)
    got = read_tickets_csv(s, path)
    return got.select("id", _digest(SUMMARY).alias("summary_md5"), _digest(INTERACTION).alias("interaction_md5"),
                      F.col("`Type 1`").alias("type1"), F.col("`Type 2`").alias("type2"), F.col("`Type 3`").alias("type3"), F.col("`Type 4`").alias("type4"))


@query("d_01_csv_to_parquet")
def _(s, d):
    path = scratch_path(s, "tickets-csv")
    write_tickets_csv(tickets_view(s, d).select(*TICKET_SCHEMA.names), path)
    got = csv_to_parquet(s, path, scratch_path(s, "tickets-parquet"))
    return got.groupBy(F.col("`Type 1`").alias("type1")).agg(
        F.count(F.lit(1)).alias("n"), F.count("`Type 2`").alias("with_type2"), F.sum(F.length(f"`{SUMMARY}`")).alias("summary_chars"))


@query("d_02_text_types")
def _(s, d):
    return select.text_types(tickets_view(s, d)).select("id", _digest(SUMMARY).alias("summary_md5"), _digest(INTERACTION).alias("interaction_md5"))


@query("d_03_rename_columns")
def _(s, d):
    return select.name_labels(tickets_view(s, d)).select("id", "y1", "y2", "y3", "y4", _digest("x").alias("x_md5"), "y")


@query("d_04_nonempty_targets")
def _(s, d):
    return select.drop_empty_targets(select.name_labels(tickets_view(s, d))).select("id", "y")


@query("d_05_frequency_filter")
def _(s, d):
    named = select.drop_empty_targets(select.name_labels(tickets_view(s, d)))
    return select.frequent_classes(named, "y1", 45).select("id", "y1", "y")


@query("d_06_process_data")
def _(s, d):
    return select.selection_metadata(selected(s, d))


# ---- T: translation --------------------------------------------------------------------

@query("t_01_translate_column")
def _(s, d):
    out = translate.translate_column(tickets_view(s, d), SUMMARY, stub_translation, lang_col="Type 1")
    return out.select("id", _digest(f"{SUMMARY}_en").alias("translated_md5"), F.length(f"`{SUMMARY}_en`").cast("bigint").alias("chars"))


@query("t_02_translate_batch")
def _(s, d):
    distinct = table(s, d, "documents").groupBy("text").agg(F.min("lang").alias("lang"))
    out = translate.translate_distinct(distinct, stub_translation, max_chars=None)
    return out.select(F.md5("text").alias("text_md5"), "lang", F.md5("translated").alias("translated_md5"))


@query("t_03_translation_input")
def _(s, d):
    given = translate.translation_input(F.col("text"))
    return table(s, d, "documents").select(
        F.col("doc_id").alias("id"), F.md5(given).alias("given_md5"), F.length(given).cast("bigint").alias("chars"), (F.col("lang") != "en").alias("needs_model"))


@query("t_04_language_codes")
def _(s, d):
    old = F.when(F.col("lang") == "fr", "fro").when(F.col("lang") == "es", "la").when(F.col("lang") == "de", "kmr").otherwise(F.col("lang"))
    return table(s, d, "documents").groupBy(old.alias("code")).agg(F.count(F.lit(1)).alias("n")).select(
        "code", translate.map_language_code(F.col("code")).alias("mapped"), "n")


@query("t_05_language_profiles")
def _(s, d):
    return translate.fit_language_profiles(texts(s, d), "text", "lang")


@query("t_05_detect_language")
def _(s, d):
    docs = texts(s, d)
    profiles = translate.fit_language_profiles(docs, "text", "lang")
    return translate.detect_language(docs, "text", "doc_id", profiles).select(F.col("doc_id").alias("id"), "lang", "detected")


@query("t_06_translation_memo")
def _(s, d):
    docs = table(s, d, "documents").select("text", "lang")
    empty = s.createDataFrame([], "text string, translated string")
    first = translate.extend_memo(empty, docs.filter("lang IN ('fr', 'de')"), stub_translation)
    path = scratch_path(s, "memo")
    first.write.parquet(path)
    memo = translate.extend_memo(s.read.parquet(path), docs, stub_translation)
    return memo.select(F.md5("text").alias("text_md5"), F.md5("translated").alias("translated_md5"))


@query("t_06_memo_store")
def _(s, d):
    """A stored memo, extended twice; known texts come from its parts."""
    docs = table(s, d, "documents").select("text", "lang")
    store = memo.MemoStore(s, scratch_path(s, "memo"))
    translate.extend_store(store, docs.filter("lang IN ('fr', 'de')"), stub_translation)
    out = translate.extend_store(store, docs, stub_translation)
    return out.select(F.md5("text").alias("text_md5"), F.md5("translated").alias("translated_md5"))


@query("t_05_split_join")
def _(s, d):
    """Detection with the profile joined by frequent and rare words apart, as beyond the broadcast bound."""
    docs = texts(s, d)
    profiles = settle_table(translate.fit_language_profiles(docs, "text", "lang"), "profiles")
    words = docs.select("doc_id", F.explode(F.array_distinct(vectorize.tokens(F.lower("text")))).alias("word"))
    scores = translate.meet_profile(words, profiles).groupBy("doc_id", "lang").agg(F.sum("weight").alias("score"))
    return scores.withColumnRenamed("doc_id", "id")


@query("x_07_language_aware_translation")
def _(s, d):
    out = translate.translate_column(table(s, d, "documents"), "text", stub_translation, lang_col="lang", max_chars=None)
    return out.select(F.col("doc_id").alias("id"), F.md5("text_en").alias("translated_md5"))


# ---- C: cleaning -----------------------------------------------------------------------

def _docs(s, d):
    return clean.spread_input(tickets_view(s, d))


@query("c_02_clean_text")
def _(s, d):
    return texts(s, d).select(F.col("doc_id").alias("id"), F.md5(clean.clean_text(F.col("text"), lowercase=False)).alias("clean_md5"))


@query("c_03_clean_summary")
def _(s, d):
    return _docs(s, d).select("id", clean.clean_summary(F.col(f"`{SUMMARY}`")).alias("ts")).select("id", F.md5("ts").alias("ts_md5"), F.length("ts").cast("bigint").alias("chars"))


@query("c_04_clean_interaction")
def _(s, d):
    return _docs(s, d).select("id", clean.clean_interaction(F.col(f"`{INTERACTION}`")).alias("ic")).select(
        "id", F.md5("ic").alias("ic_md5"), F.length("ic").cast("bigint").alias("chars"))


@query("c_05_preprocess")
def _(s, d):
    return clean.preprocess(tickets_view(s, d)).select("id", F.md5("ts").alias("ts_md5"), F.md5("ic").alias("ic_md5"))


@query("c_06_custom_pattern")
def _(s, d):
    registry = NoiseRegistry().with_pattern("endings", "ing ").with_pattern("ticket_noise", "the ")
    return clean.preprocess(tickets_view(s, d), registry=registry).select(
        "id", F.md5("ts").alias("ts_md5"), F.md5("ic").alias("ic_md5"))


@query("c_07_text_statistics")
def _(s, d):
    stats = clean.text_statistics(tickets_view(s, d), INTERACTION)
    return stats.withColumn("avg_length", r("avg_length"))


# ---- S: labels -------------------------------------------------------------------------

LEVELS = ["status", "priority", "year"]


@query("s_01_class_distribution")
def _(s, d):
    return labels.class_distribution(order_labels(s, d), LEVELS)


@query("s_02_balance_gap")
def _(s, d):
    return labels.balance_gap(order_labels(s, d), LEVELS).withColumn("class_balance", r("class_balance", 9))


@query("s_03_hierarchical_labels")
def _(s, d):
    return labels.hierarchical_labels(order_labels(s, d), *LEVELS).select("id", "primary_label", "secondary_label", "tertiary_label", "hierarchical_label")


@query("s_04_encode_labels")
def _(s, d):
    return labels.encode_labels(order_labels(s, d), LEVELS).select("id", "status_encoded", "priority_encoded", "year_encoded")


@query("s_04_transform_only")
def _(s, d):
    data = order_labels(s, d)
    mapping = labels.class_mapping(data, ["priority"])
    return labels.encode_labels(data, ["priority"], mapping).select("id", "priority_encoded")


@query("s_05_class_mapping")
def _(s, d):
    return labels.class_mapping(order_labels(s, d), LEVELS)


@query("s_06_multilabel")
def _(s, d):
    return labels.multilabel_structure(order_labels(s, d), LEVELS).select("id", F.concat_ws(",", F.col("label_codes").cast("array<string>")).alias("codes"))


@query("s_07_rare_classes")
def _(s, d):
    data = table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return labels.filter_rare_classes(data, "lang", 129)


@query("s_08_stratified_groups")
def _(s, d):
    return labels.stratified_groups(order_labels(s, d), "priority", "id").select("id", "priority", "strata_group")


@query("p_08_group_summary")
def _(s, d):
    return split.split_summary(split.group_split(_events(s, d), "user_id"), group_col="user_id")


@query("p_08_stratified_summary")
def _(s, d):
    return split.split_summary(split.stratified_splits(_lang_docs(s, d), "lang", "id"), "lang", by=("split_no", "split"))


@query("p_08_fold_summary")
def _(s, d):
    return split.split_summary(split.cross_validation(_lang_docs(s, d), "lang", "id"), by=("fold",))


@query("s_09_data_summary")
def _(s, d):
    return labels.data_summary(order_labels(s, d), LEVELS)


# ---- V: vectors ------------------------------------------------------------------------

@query("v_01_ngram_terms")
def _(s, d):
    terms = vectorize.TextVectorizer().terms(F.lower("text"))
    return texts(s, d).select(F.col("doc_id").alias("id"), terms.alias("t")).select(
        "id", F.size("t").cast("bigint").alias("n_terms"), F.md5(F.array_join("t", ",")).alias("terms_md5"))


@query("v_02_count_vocabulary")
def _(s, d):
    docs = texts(s, d).select(F.lower("text").alias("text"))
    return vectorize.TextVectorizer("count").vocabulary(docs, "text").select("term", "tf", "df")


@query("v_03_tfidf_weights")
def _(s, d):
    data = messages(s, d)
    model = vectorize.TextVectorizer(max_features=10_000).fit(data, "text")
    return model.weights(data, "id").select("id", "term", r("weight").alias("weight"))


@query("v_04_count_vectors")
def _(s, d):
    data = messages(s, d)
    model = vectorize.TextVectorizer("count", max_features=10_000, ngram_range=(1, 1)).fit(data, "text")
    return model.weights(data, "id").select("id", "term", F.col("weight").cast("bigint").alias("tf"))


@query("v_05_transform_unseen")
def _(s, d):
    data = messages(s, d)
    model = vectorize.TextVectorizer("tfidf", max_features=10_000, ngram_range=(1, 1)).fit(data.filter("role = 'user'"), "text")
    out = model.transform(data.filter("role <> 'user'"))
    sums = entries(out, "features", ["id"]).groupBy("id").agg(F.count(F.lit(1)).alias("terms"), F.sum("w").alias("total"))
    return out.select("id").join(sums, "id", "left").select("id", F.coalesce("terms", F.lit(0)).alias("terms"), r(F.coalesce("total", F.lit(0.0))).alias("total"))


def letter_encoder(texts):
    return [[float(len(t)), float(t.count("e"))] for t in texts]


@query("v_06_caller_embeddings")
def _(s, d):
    source = tickets_view(s, d).select("id", F.col(f"`{INTERACTION}`").alias("text"))
    out = vectorize.embed(source, "text", letter_encoder)
    return out.select("id", F.col("embedding")[0].cast("bigint").alias("chars"), F.col("embedding")[1].cast("bigint").alias("letters_e"))


@query("v_06_word_embeddings")
def _(s, d):
    out = vectorize.embed(texts(s, d).select(F.col("doc_id").alias("id"), "text"), "text")
    return out.select("id", F.size("embedding").alias("width"))


@query("v_07_truncated_svd")
def _(s, d):
    out = vectorize.reduce_dimensions(vec3(s, d), "features", 16)
    return entries(out, "reduced", ["id"]).groupBy("id").agg(r(F.sum(F.col("w") * F.col("w")), 6).alias("energy"))


@query("v_07_planted_rank")
def _(s, d):
    """Vectors that are multiples of four fixed ones: four values stand out, and their projections keep all lengths."""
    data = vec3(s, d).select("id", F.transform("features", lambda v, i: F.when(i < 4, v).otherwise(F.lit(2.0) * F.col("features")[F.pmod(i, F.lit(4))])).alias("features"))
    found = decompose.truncated_svd(data, "features", 8)
    kept = data.select("id", found.project(data, "features").alias("reduced"))
    rank = int((found.values > 1e-5 * found.values[0]).sum())
    return entries(kept, "reduced", ["id"]).groupBy("id").agg(r(F.sum(F.col("w") * F.col("w")), 5).alias("energy")).withColumn("rank", F.lit(rank))


@query("n_01_recall")
def _(s, d):
    """The share of true neighbours that the approximate search finds."""
    data = vec3(s, d)
    exact = neighbours.neighbours(data, data, 5).select("id", "nn_id")
    near = neighbours.approximate_neighbours(data, 5).select("id", "nn_id")
    hit = exact.join(near, ["id", "nn_id"]).agg(F.count(F.lit(1)).alias("hit"))
    return hit.select((F.col("hit") >= F.lit(0.3 * 5 * data.count())).alias("recall_above_chance"))


@query("b_08_smote_tomek_rows")
def _(s, d):
    return balance.smote_tomek(vec3(s, d), "label", "id").select("row_key", "label", "is_synthetic")


@query("b_09_smote_enn_rows")
def _(s, d):
    return balance.smote_enn(vec3(s, d), "label", "id").select("row_key", "label", "is_synthetic")


@query("v_07_svd_full_rank")
def _(s, d):
    out = vectorize.reduce_dimensions(vec3(s, d), "features", 64)
    return entries(out, "reduced", ["id"]).groupBy("id").agg(r(F.sum(F.col("w") * F.col("w")), 5).alias("energy"))


def _combined(s, d, method):
    data = vec3(s, d).withColumn("turned", F.reverse("features"))
    out = vectorize.combine_features(data, ["features", "turned"], method, "both")
    return entries(out, "both", ["id"]).groupBy("id").agg(
        (F.max("idx") + 1).cast("bigint").alias("width"), r(F.sum("w")).alias("total"), r(F.sum(F.col("w") * (F.col("idx") + 1))).alias("weighted"))


@query("v_08_concatenate")
def _(s, d):
    return _combined(s, d, "concatenate")


@query("v_08_average")
def _(s, d):
    return _combined(s, d, "average")


@query("v_09_feature_importance")
def _(s, d):
    data = messages(s, d)
    model = vectorize.TextVectorizer(max_features=10_000).fit(data, "text")
    return model.importance(data, 20).select("term", r("importance").alias("importance"))


@query("v_10_vectorize_frame")
def _(s, d):
    data = settle_table(cleaned(s, d).select("id", "ts", "ic"), "cleaned")
    return vectorize.vectorize_frame(data, ["ts", "ic"]).shapes(data)


@query("x_02_script_vectors")
def _(s, d):
    data = messages(s, d).select("id", F.lower("text").alias("ic"), F.lower(F.concat("role", F.lit(" "), "text")).alias("ts_en"))
    model = variants.script_vectors(data, "ic", "ts_en")
    return model.shapes(data)


# ---- R: ranks --------------------------------------------------------------------------

@query("r_01_hash_rank")
def _(s, d):
    data = table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return rank.rank_by_hash(data, ["lang"], keyed_hash(42, F.col("id")), "id", "place")


@query("r_01_number_rank")
def _(s, d):
    return rank.rank_by_number(order_labels(s, d).select("id", "status"), ["status"], "id", "place")


# ---- B: balancing ----------------------------------------------------------------------

@query("b_01_imbalance_shares")
def _(s, d):
    return balance.class_shares(table(s, d, "documents"), "lang")


@query("b_01_imbalance_summary")
def _(s, d):
    return balance.imbalance_summary(table(s, d, "documents"), "lang").withColumn("imbalance_ratio", r("imbalance_ratio"))


def _copies(df):
    return df.select("id", "label", F.col("copy_no").cast("bigint").alias("copy_no"))


@query("b_02_random_oversample")
def _(s, d):
    return _copies(balance.random_oversample(vec3(s, d), "label", "id"))


@query("b_02_oversample_counts")
def _(s, d):
    sizes = {0: 5000, 1: 6000}
    return _copies(balance.random_oversample(vec3(s, d), "label", "id", sizes, at_least=True))


@query("b_03_random_undersample")
def _(s, d):
    return balance.random_undersample(vec3(s, d), "label", "id").select("id", "label")


def _points(df):
    return df.select("row_key", "label", "is_synthetic", "src_id", "copy_no",
                     r(F.aggregate("features", F.lit(0.0), lambda a, v: a + v)).alias("total"),
                     r(F.col("features")[0]).alias("first"))


@query("b_04_smote")
def _(s, d):
    return _points(balance.smote(vec3(s, d), "label", "id"))


@query("b_05_adasyn_allocation")
def _(s, d):
    return balance.adasyn_allocation(vec3(s, d), "label", "id")


@query("b_05_adasyn")
def _(s, d):
    return _points(balance.adasyn(vec3(s, d), "label", "id"))


@query("b_06_nearmiss_1")
def _(s, d):
    return balance.nearmiss(vec3(s, d), "label", "id", version=1).select("id", "label")


@query("b_06_nearmiss_2")
def _(s, d):
    return balance.nearmiss(vec3(s, d), "label", "id", version=2).select("id", "label")


@query("b_06_nearmiss_3")
def _(s, d):
    return balance.nearmiss(vec3(s, d), "label", "id", version=3).select("id", "label")


@query("b_07_tomek_links")
def _(s, d):
    return balance.tomek_undersample(vec3(s, d), "label", "id").select("id", "label")


@query("b_08_smote_tomek")
def _(s, d):
    return balance.smote_tomek(vec3(s, d), "label", "id").groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("b_09_smote_enn")
def _(s, d):
    return balance.smote_enn(vec3(s, d), "label", "id").groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("b_10_custom_balanced")
def _(s, d):
    return _copies(balance.custom_balanced(vec3(s, d), "label", "id", 120))


@query("b_11_auto_balance")
def _(s, d):
    return _copies(balance.auto_balance(vec3(s, d), "label", "id"))


@query("b_12_compare_methods")
def _(s, d):
    return balance.compare_methods(vec3(s, d), "label", "id").withColumn("imbalance_ratio", r("imbalance_ratio"))


@query("n_01_nearest_neighbours")
def _(s, d):
    data = vec3(s, d)
    return neighbours.neighbours(data, data, 5)


@query("n_01_class_neighbours")
def _(s, d):
    data = vec3(s, d)
    return neighbours.neighbours(data, data, 3, group_col="label")


@query("n_01_approximate")
def _(s, d):
    return neighbours.approximate_neighbours(vec3(s, d), 3)


@query("n_01_approximate_counts")
def _(s, d):
    """Every row gets k distinct others, however few lie in the nearest cell."""
    found = neighbours.approximate_neighbours(vec3(s, d), 3, probes=1)
    return found.filter("nn_id <> id").groupBy("id").agg(F.countDistinct("nn_id").alias("n"), F.max("nn_rank").alias("last_rank"))


# ---- G: strategy -----------------------------------------------------------------------

@query("g_01_characteristics")
def _(s, d):
    out = strategy.characteristics(vec3(s, d))
    return out.select("n_samples", "n_features", r("data_sparsity").alias("data_sparsity"), r("feature_variance").alias("feature_variance"))


@query("g_01_label_quality")
def _(s, d):
    return strategy.label_quality(table(s, d, "documents"), "lang").withColumn("label_balance_score", r("label_balance_score"))


@query("g_02_sparsity")
def _(s, d):
    data = messages(s, d)
    model = vectorize.TextVectorizer("count", max_features=10_000, ngram_range=(1, 1)).fit(data, "text")
    return strategy.characteristics(model.transform(data)).select("n_features", r("data_sparsity").alias("data_sparsity"))


@query("g_03_label_balance")
def _(s, d):
    parts = [strategy.label_quality(order_labels(s, d), c).select(F.lit(c).alias("column"), r("label_balance_score").alias("balance")) for c in LEVELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("g_04_feasibility")
def _(s, d):
    return strategy.feasibility(vec3(s, d), "label", width_of(vec3(s, d), "features")).withColumn("label_balance_score", r("label_balance_score"))


@query("g_05_clustering")
def _(s, d):
    found = cluster.clustering_analysis(vec3(s, d), "id", eps=1.05)
    rows = [(k, float(v), k == found["optimal_k"]) for k, v in found["silhouette_scores"].items()]
    return s.createDataFrame(rows, "k int, silhouette double, is_best boolean")


@query("g_06_silhouette")
def _(s, d):
    return cluster.silhouette_by_row(vec3(s, d), "id", "label").withColumn("silhouette", r("silhouette"))


@query("g_07_dbscan")
def _(s, d):
    return cluster.dbscan(vec3(s, d), "id", eps=1.16).withColumn("cluster", F.coalesce("cluster", F.lit(-1).cast("bigint")))


@query("g_08_isolation_forest")
def _(s, d):
    return anomaly.flag_by_quantile(anomaly.isolation_scores(vec3(s, d), "id"), 0.1)


@query("g_09_one_class_boundary")
def _(s, d):
    return anomaly.flag_by_quantile(anomaly.boundary_scores(vec3(s, d), "id"), 0.1, highest=False)


@query("g_10_recommend_labelled")
def _(s, d):
    return strategy.recommendation_frame(s, strategy.recommend(vec3(s, d), "id", label="label", domain={"requires_interpretability": True, "known_classes": 3}))


@query("g_10_recommend_unlabelled")
def _(s, d):
    return strategy.recommendation_frame(s, strategy.recommend(vec3(s, d), "id"))


@query("g_11_strategy_report")
def _(s, d):
    text = strategy.strategy_report(strategy.recommend(vec3(s, d), "id", label="label"))
    return s.createDataFrame([(i, line) for i, line in enumerate(text.splitlines())], "line_no int, line string")


# ---- P: splits -------------------------------------------------------------------------

def _lang_docs(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")


@query("p_01_basic_split")
def _(s, d):
    return split.basic_split(_lang_docs(s, d), "lang", "id")


@query("p_01_unstratified_split")
def _(s, d):
    return split.basic_split(_lang_docs(s, d), None, "id", 0.25, stratify=False)


@query("p_02_stratified_splits")
def _(s, d):
    return split.stratified_splits(_lang_docs(s, d), "lang", "id")


def _events(s, d):
    return table(s, d, "events")


@query("p_03_temporal_split")
def _(s, d):
    return split.temporal_split(_events(s, d), "ts", "event_id").select("event_id", "split")


@query("p_04_group_split")
def _(s, d):
    return split.group_split(_events(s, d), "user_id").select("event_id", "user_id", "split")


@query("p_04_group_split_capped")
def _(s, d):
    return split.group_split(_events(s, d), "user_id", 0.25, max_groups=40).select("event_id", "user_id", "split")


@query("p_03_temporal_split_missing")
def _(s, d):
    missing = _events(s, d).withColumn("ts", F.when(F.col("event_id") % 4 != 0, F.col("ts")))
    return split.temporal_split(missing, "ts", "event_id").select("event_id", "split")


@query("p_04_group_split_nulls")
def _(s, d):
    some = _events(s, d).withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))
    return split.group_split(some, "user_id").select("event_id", F.coalesce("user_id", F.lit(-1)).alias("user_id"), "split")


@query("p_05_cross_validation")
def _(s, d):
    return split.cross_validation(_lang_docs(s, d), "lang", "id")


@query("p_05_plain_folds")
def _(s, d):
    return split.cross_validation(_lang_docs(s, d), None, "id", 4, stratified=False).select("id", "fold")


@query("p_06_nested_cross_validation")
def _(s, d):
    out = split.nested_cross_validation(_lang_docs(s, d), "lang", "id")
    return out.withColumn("inner_fold", F.coalesce("inner_fold", F.lit(-1)))


@query("p_07_class_counts")
def _(s, d):
    return split.class_counts(_lang_docs(s, d), "lang")


@query("p_08_split_summary")
def _(s, d):
    out = split.split_summary(split.temporal_split(_events(s, d), "ts", "event_id"), time_col="ts")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return out.select("split", "n", stamp("first_time").alias("first_time"), stamp("last_time").alias("last_time"))


@query("p_09_validate_split")
def _(s, d):
    parts = split.temporal_split(_events(s, d), "ts", "event_id", 0.3, 0.0)
    out = split.validate_split(parts, "event_type", ["value", "user_id"])
    return out.withColumn("value", r("value"))


@query("x_01_rare_class_split")
def _(s, d):
    return split.rare_class_split(table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang"), "lang", "id", min_rows=110)


# ---- M: models -------------------------------------------------------------------------

_TRAINED: dict = {}


def _trained(s, d, name: str) -> tuple[models.ModelBench, DataFrame]:
    """A model of the vectors and their stored scores; queries on one model share its training while a session lasts."""
    key = s.sparkContext.applicationId, d, name
    if key not in _TRAINED:
        data = settle_table(vec3(s, d), "train")
        bench = models.ModelBench()
        bench.fit(data, name)
        _TRAINED[key] = bench, settle_table(bench.predict(data, name, probability=True), "scored")
    return _TRAINED[key]


def _model(name: str):
    return lambda s, d: _trained(s, d, name)[1].drop("probability")


def _facts(name: str):
    """What holds of any fitted classifier: every row is scored, by a known class, the likeliest one, and shares add up."""
    def run(s, d):
        scored = _trained(s, d, name)[1]
        best = F.array_max("probability") - F.col("probability")[F.col("prediction").cast("int")]
        hits = F.avg((F.col("label") == F.col("prediction")).cast("double"))
        most = F.array_max(F.array(*[F.avg((F.col("label") == c).cast("double")) for c in range(3)]))
        total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
        return scored.agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(F.col("prediction").isin(0.0, 1.0, 2.0).cast("int")).cast("boolean").alias("known_classes"),
            (F.max(F.abs(total - 1)) < 1e-6).alias("sums_to_one"), (F.max(best) < 1e-9).alias("likeliest"), (hits >= most).alias("beats_majority"))
    return run


for _name in ("random_forest", "gradient_boosting", "decision_tree", "xgboost", "lightgbm"):
    QUERIES[f"m_facts_{_name}"] = _facts(_name)
for _name in ("logistic_regression", "mlp"):
    QUERIES[f"m_facts_{_name}"] = lambda s, d, _run=_facts(_name): _run(s, d).drop("beats_majority")
QUERIES["m_facts_svm"] = lambda s, d: _facts("svm")(s, d).drop("beats_majority", "likeliest")  # margins decide, shares are calibrated


@query("m_03_duality_gap")
def _(s, d):
    """How the dual solver ended: its gap and the gradient of the free intercepts bound the distance to the optimum."""
    data = settle_table(vec3(s, d), "train")
    solver = logistic.DualLogistic()
    model = solver.fit(data)
    return s.createDataFrame([(solver.gap < 1e-3, model.numClasses, model.numFeatures)], "gap_closed boolean, classes int, features int")


@query("m_09_training_loss")
def _(s, d):
    """The softmax loss falls in every round, with one tree a round for each of three classes."""
    model = _trained(s, d, "xgboost")[0].get("xgboost")
    falls = all(b < a for a, b in zip(model.losses, model.losses[1:]))
    trees = {r[:2] for r in model.nodes}
    return s.createDataFrame([(falls, len(trees), len({c for _, c in trees}))], "falls boolean, trees int, classes int")


@query("m_10_leaf_rule")
def _(s, d):
    """Trees grown by the best leaf keep their leaf bound, and a second fit grows the same ones."""
    model = _trained(s, d, "lightgbm")[0].get("lightgbm")
    leaves: dict = {}
    for n in model.nodes:
        leaves[n[:2]] = leaves.get(n[:2], 0) + (n[3] < 0)
    again = models.ModelBench()
    again.fit(vec3(s, d).repartition(5), "lightgbm")
    same = sorted(map(str, again.get("lightgbm").nodes)) == sorted(map(str, model.nodes))
    return s.createDataFrame([(len(leaves), max(leaves.values()) <= 31, same)], "trees int, within_bound boolean, rerun_equal boolean")


QUERIES["m_01_random_forest"] = _model("random_forest")
QUERIES["m_02_gradient_boosting"] = _model("gradient_boosting")
QUERIES["m_03_logistic_regression"] = _model("logistic_regression")
QUERIES["m_04_svm"] = _model("svm")
QUERIES["m_07_decision_tree"] = _model("decision_tree")
QUERIES["m_08_mlp"] = _model("mlp")
QUERIES["m_09_xgboost"] = _model("xgboost")
QUERIES["m_10_lightgbm"] = _model("lightgbm")


@query("m_05_naive_bayes_log_probabilities")
def _(s, d):
    data = texts(s, d).select(F.col("doc_id").alias("id"), "lang", F.lower("text").alias("text"))
    vectorizer = vectorize.TextVectorizer("count", max_features=10_000, ngram_range=(1, 1)).fit(data, "text")
    coded = labels.encode_labels(vectorizer.transform(data), ["lang"]).withColumnRenamed("lang_encoded", "label")
    bench = models.ModelBench()
    bench.fit(coded.select("id", "features", "label"), "naive_bayes")
    theta = bench.get("naive_bayes").theta.toArray()
    rows = [(c, t, float(v)) for c, line in enumerate(theta) for t, v in zip(vectorizer.terms, line)]
    return s.createDataFrame(rows, "label int, term string, log_probability double").withColumn("log_probability", r("log_probability"))


@query("m_06_knn")
def _(s, d):
    return _model("knn")(s, d).select("id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("m_12_train_single")
def _(s, d):
    parts = settle_table(split.basic_split(vec3(s, d), "label", "id"), "parts")
    bench = models.ModelBench()
    bench.fit(parts.filter("split = 'train'").drop("split"), "decision_tree", {"max_depth": 5}, parts.filter("split = 'test'").drop("split"))
    return bench.reports(parts.filter("split = 'test'").drop("split"), "decision_tree")[0]


def _several(s, d):
    """The default models; features are shifted, as naive Bayes takes none below zero."""
    data = vec3(s, d).withColumn("features", F.transform("features", lambda x: x + 10))
    parts = settle_table(split.basic_split(data, "label", "id"), "parts")
    train, test = parts.filter("split = 'train'").drop("split"), parts.filter("split = 'test'").drop("split")
    bench = models.ModelBench()
    bench.fit_many(train, validation=test, parallelism=4)
    return bench, test


@query("m_13_train_multiple")
def _(s, d):
    bench, _ = _several(s, d)
    rows = [(n, t.train_accuracy, t.val_accuracy, None) for n, t in bench.trained.items()] + [(n, None, None, e) for n, e in bench.errors.items()]
    return s.createDataFrame(rows, "model string, train_accuracy double, val_accuracy double, error string")


@query("m_14_hyperparameter_tuning")
def _(s, d):
    bench = models.ModelBench()
    bench.tune(settle_table(vec3(s, d), "train"), "decision_tree", {"max_depth": [2, 5], "max_bins": [16, 32]})
    return s.createDataFrame([(c["max_depth"], c["max_bins"], fold, score) for c, fold, score in bench.fold_scores["decision_tree"]],
                             "max_depth int, max_bins int, fold int, accuracy double")


@query("m_14_tuning_grid")
def _(s, d):
    """What is determined of a search: its grid, its folds, and that the best mean is the one reported."""
    bench, rows = models.ModelBench(), []
    data = settle_table(vec3(s, d), "train")
    for name, grid, scoring in [("knn", {"n_neighbors": [1, 5]}, "accuracy"), ("naive_bayes", {"alpha": [0.5, 1.0]}, "precision_weighted"), ("decision_tree", {"max_depth": [2, 4]}, "f1_weighted")]:
        best = bench.tune(data.withColumn("features", F.transform("features", lambda x: x + 10)), name, grid, 3, scoring)
        scores = bench.fold_scores[name]
        means = [sum(v for c, _, v in scores if c == one) / 3 for one in {str(c): c for c, _, _ in scores}.values()]
        rows.append((name, len(scores), abs(max(means) - best.val_accuracy) < 1e-12, all(0 <= v <= 1 for _, _, v in scores)))
    return s.createDataFrame(rows, "model string, fits int, best_is_reported boolean, in_range boolean")


@query("m_15_model_comparison")
def _(s, d):
    bench, _ = _several(s, d)
    if bench.errors:
        raise RuntimeError(f"models that are missing from the comparison: {bench.errors}")
    return bench.comparison(s)


@query("m_16_save_load")
def _(s, d):
    data = settle_table(vec3(s, d), "train")
    bench, path = models.ModelBench(), scratch_path(s, "model")
    bench.fit(data, "logistic_regression")
    bench.save("logistic_regression", path)
    bench.load(path, "loaded")
    return bench.predict(data, "loaded")


@query("m_17_predict_probability")
def _(s, d):
    data = settle_table(vec3(s, d), "train")
    bench = models.ModelBench()
    bench.fit(data, "logistic_regression")
    return bench.predict(data, probability=True).select("id", "prediction", F.size("probability").alias("width"))


@query("m_18_feature_importance")
def _(s, d):
    bench = models.ModelBench()
    bench.fit(settle_table(vec3(s, d), "train"), "decision_tree")
    return bench.feature_importance(s, "decision_tree")


@query("x_04_probability_table")
def _(s, d):
    data = settle_table(vec3(s, d), "train")
    bench = models.ModelBench()
    bench.fit(data, "logistic_regression")
    return models.probability_table(bench.predict(data, probability=True), ["minor", "middle", "major"])


@query("x_05_script_forest")
def _(s, d):
    parts = settle_table(variants.script_split(vec3(s, d)), "parts")
    bench = variants.script_forest(parts.filter("split = 'train'").drop("split"))
    return bench.predict(parts.filter("split = 'test'").drop("split"))


# ---- E: evaluation ---------------------------------------------------------------------

def _rounded(df, *columns):
    return df.withColumns({c: r(c) for c in columns})


SCORES = ("precision", "recall", "f1_score")


@query("e_01_evaluate")
def _(s, d):
    data = predictions(s, d).withColumn("probability", F.array(1 - F.col("score"), F.col("score")))
    return _rounded(evaluate.evaluate_classification(data, probability="probability"), "accuracy", *SCORES, "auc_roc", "auc_pr")


@query("e_02_classification_report")
def _(s, d):
    return _rounded(evaluate.classification_report(predictions(s, d)), *SCORES)


@query("e_03_confusion_matrix")
def _(s, d):
    return evaluate.confusion_matrix(lang_predictions(s, d))


@query("e_04_per_class")
def _(s, d):
    return _rounded(evaluate.per_class(lang_predictions(s, d)), *SCORES)


@query("e_05_binary_areas")
def _(s, d):
    return _rounded(evaluate.binary_areas(predictions(s, d)), "auc_roc", "auc_pr")


@query("e_05_tied_scores")
def _(s, d):
    return _rounded(evaluate.binary_areas(predictions(s, d).withColumn("score", F.round("score", 1))), "auc_roc", "auc_pr")


@query("e_05_precision_recall_curve")
def _(s, d):
    return _rounded(evaluate.precision_recall_curve(predictions(s, d)), "threshold", "precision", "recall")


@query("e_06_one_vs_rest_areas")
def _(s, d):
    return _rounded(evaluate.one_vs_rest_areas(lang_predictions(s, d)), "auc_roc")


@query("e_06_weighted_auc")
def _(s, d):
    return _rounded(evaluate.weighted_multiclass_auc(lang_predictions(s, d)), "auc_roc")


def _three_models(s, d):
    base = predictions(s, d)
    guesses = {"hashed": base, "all_one": base.withColumn("prediction", F.lit(1)), "flipped": base.withColumn("prediction", 1 - F.col("prediction"))}
    return [evaluate.evaluate_classification(df, model=name) for name, df in guesses.items()]


@query("e_07_compare_models")
def _(s, d):
    return _rounded(evaluate.compare_models(_three_models(s, d)), "accuracy", *SCORES, "auc_roc")


@query("e_08_normalised_confusion")
def _(s, d):
    return _rounded(evaluate.normalised_confusion(lang_predictions(s, d)), "share")


@query("e_09_evaluation_report")
def _(s, d):
    data = predictions(s, d).withColumn("probability", F.array(1 - F.col("score"), F.col("score")))
    path = scratch_path(s, "report")
    evaluate.write_report(data, evaluate.evaluation_report(data, probability="probability", model="hashed"), path)
    return s.read.text(path)


@query("e_10_best_model")
def _(s, d):
    name, score = evaluate.best_model(_three_models(s, d))
    return s.createDataFrame([(name, float(score))], "model string, score double").withColumn("score", r("score"))


# ---- O and X: the whole flow -----------------------------------------------------------

COMPAT = {"modeling": {"compat_order": True}}


@query("o_01_full_flow")
def _(s, d):
    return flow.TicketFlow(flow.load_config()).fit(tickets_view(s, d)).comparison()


@query("o_01_compat_order")
def _(s, d):
    result = flow.TicketFlow(flow.load_config(COMPAT)).fit(tickets_view(s, d))
    return s.createDataFrame([(result.rows, result.train_rows, result.test_rows)], "rows bigint, train_rows bigint, test_rows bigint")


@query("o_03_data_steps")
def _(s, d):
    prepared, _ = flow.TicketFlow(flow.load_config()).prepare(tickets_view(s, d))
    return prepared.groupBy("y2", "y1", "y2_encoded", "y1_encoded").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("ts")).alias("ts_chars"), F.sum(F.length("ic")).alias("ic_chars"))


@query("o_03_translated_steps")
def _(s, d):
    prepared, _ = flow.TicketFlow(flow.load_config({"translation": {"enable": True}})).prepare(
        tickets_view(s, d), translate_fn=stub_translation, lang_col="Type 1")
    return prepared.select("id", F.md5("ts").alias("ts_md5"), F.md5("ic").alias("ic_md5"))


def _fitted(s, d):
    return flow.TicketFlow(flow.load_config()).fit(tickets_view(s, d)).model


@query("o_04_stream_scoring")
def _(s, d):
    model, source = _fitted(s, d), table(s, d, "conversations")
    stream = messages_as_tickets(ticket_stream(s, d, source.schema, "conversations.parquet"), "text", ["conv_id", "turn"])
    path = scratch_path(s, "scored")
    score_stream(model, stream, ["conv_id", "turn"], path).awaitTermination()
    return scored_rows(s, path)


@query("o_05_save_load")
def _(s, d):
    path = scratch_path(s, "flow")
    _fitted(s, d).save(s, path)
    return flow.FlowModel.load(s, path).transform(tickets_view(s, d))


@query("x_03_script_cleaning")
def _(s, d):
    out = variants.script_cleaning(clean.spread_input(variants.script_selection(tickets_view(s, d))), 45)
    return out.select("id", "y", F.md5("ts").alias("ts_md5"), F.md5("ic").alias("ic_md5"))


@query("x_06_script_selection")
def _(s, d):
    return variants.script_selection(tickets_view(s, d)).select("id", "y", _digest(INTERACTION).alias("interaction_md5"))


def flagship(spark: SparkSession, sf_dir: str, min_count: int = 10) -> DataFrame:
    """Select, clean, filter by class frequency, and count the target classes."""
    out = select.drop_empty_targets(select.name_labels(select.text_types(tickets_view(spark, sf_dir))))
    pairs = clean.preprocess(out).groupBy("y1", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("ic")).alias("ic_chars"))
    total = F.sum("n").over(W.partitionBy("y1"))  # over the small table of class pairs
    kept = pairs.where(F.col("y1").isNotNull()).withColumn("total", total).where(F.col("total") > min_count)
    return kept.groupBy("y").agg(F.sum("n").alias("n"), F.sum("ic_chars").alias("ic_chars"))


QUERIES["d_00_flagship"] = flagship
