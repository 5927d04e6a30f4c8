"""Independent SQL for the catalogue's queries, written for DuckDB.

Plain window functions and joins: no bucketing, no pruning. Names and columns match
``catalog.QUERIES``.
"""

from __future__ import annotations

from ticketloom.functions.noise import NoiseRegistry, fused_registry
from ticketloom.operators.translate import LANGUAGE_CODES
from ticketloom.operators.vectorize import TOKEN
from ticketloom.sources.tickets import NA_TOKENS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _r(value: str, digits: int = 6) -> str:
    return f"(round({value}, {digits}) + 0.0)"


TICKETS = """tickets AS (
  SELECT d.doc_id AS id,
    concat(CASE lang WHEN 'en' THEN 'RE: ' WHEN 'de' THEN 'FW : [x] ' WHEN 'fr' THEN '' ELSE 'null ' END, text) AS summary,
    CASE WHEN source = 'src3' THEN NULL
         WHEN source IN ('src1', 'src5', 'src9') THEN concat('Dear customer, thank you for contacting us. 12 March 10:30 ', text)
         ELSE text END AS interaction,
    lang AS type1,
    CASE WHEN quality IS NULL THEN NULL WHEN source = 'src7' THEN '' ELSE concat('q', CAST(quality AS VARCHAR)) END AS type2,
    source AS type3,
    CASE WHEN toxic IS NULL THEN NULL ELSE concat('t', CAST(toxic AS VARCHAR)) END AS type4
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

TYPED = """typed AS (
  SELECT id, coalesce(summary, 'nan') AS summary, coalesce(interaction, 'nan') AS interaction, type1 AS y1, type2 AS y
  FROM tickets)"""

NONEMPTY = "nonempty AS (SELECT * FROM typed WHERE y IS NOT NULL AND y <> '')"


def _selected(min_count: int = 10) -> str:
    return f"""{TICKETS}, {TYPED}, {NONEMPTY}, selected AS (
      SELECT * FROM nonempty WHERE y1 IN (SELECT y1 FROM nonempty GROUP BY y1 HAVING count(*) > {min_count}))"""


def _strip(text: str, patterns, lowercase: bool = True) -> str:
    out = f"lower({text})" if lowercase else text
    for p in patterns:
        out = f"regexp_replace({out}, {_text(p)}, ' ', 'g')"
    return f"coalesce(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '')"


REGISTRY = NoiseRegistry()
SUMMARY_SQL = _strip("summary", REGISTRY.summary_patterns())
INTERACTION_SQL = _strip("interaction", REGISTRY.interaction_patterns())


def _cleaned(source: str, summary: str = SUMMARY_SQL, interaction: str = INTERACTION_SQL, keep: str = "*", filtered: bool = True) -> str:
    where = "WHERE ts <> '' AND ic <> ''" if filtered else ""
    return f"cleaned AS (SELECT * FROM (SELECT {keep}, {summary} AS ts, {interaction} AS ic FROM {source}) {where})"


ORDER_LABELS = """order_labels AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderpriority END AS priority,
    CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders)"""
LEVELS = ("status", "priority", "year")
LONG_LEVELS = "levels AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM order_labels" for c in LEVELS) + ")"

VEC3 = """vec3 AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f, CASE WHEN label = 0 THEN 0 WHEN label <= 2 THEN 1 ELSE 2 END AS label FROM embeddings)"""

PREDICTIONS = """scored AS (SELECT doc_id AS id, quality AS label, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS score FROM labels),
predictions AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)"""

LANG_PREDICTIONS = """coded AS (SELECT doc_id AS id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label FROM documents),
probs AS (SELECT id, label, c, ('0x' || substr(md5('p|' || id || '|' || c), 1, 8))::BIGINT / 4294967296.0::DOUBLE + CASE WHEN label = c THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
  FROM coded, (SELECT unnest([0, 1, 2, 3]) AS c)),
predictions AS (SELECT id, label, CAST(c AS INTEGER) AS prediction FROM probs QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, c) = 1)"""

MESSAGES = "messages AS (SELECT conv_id || ':' || turn AS id, role, text FROM conversations)"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN}')"


def _hash_int(key: str, bound: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 15))::BIGINT % ({bound}))"


def _hash_unit(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _hash_rank(by: str | None, seed: str, id_col: str = "id") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5('{seed}|' || {id_col}), {id_col})"


def _given(text: str) -> str:
    return f"CASE WHEN length({text}) > 500 THEN concat(substring({text}, 1, 500), '...') ELSE {text} END"


def _mapped(code: str) -> str:
    return "CASE " + code + " " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LANGUAGE_CODES.items()) + f" ELSE {code} END"


DISTRIBUTIONS = "UNION ALL ".join(
    f"SELECT '{c}_distribution' AS metric, {c} AS key, count(*) AS value FROM selected WHERE {c} IS NOT NULL GROUP BY {c} " for c in ("y", "y1"))

NA_LIST = ", ".join(_text(t) for t in NA_TOKENS)


def _na(column: str) -> str:
    return f"CASE WHEN {column} IN ({NA_LIST}) THEN NULL ELSE {column} END"


ORACLES: dict[str, str] = {}

# ---- D, T, C ---------------------------------------------------------------------------

ORACLES["d_00_flagship"] = f"""WITH {TICKETS}, {TYPED}, {NONEMPTY}, {_cleaned('nonempty')}
SELECT y, count(*) AS n, CAST(sum(length(ic)) AS BIGINT) AS ic_chars FROM cleaned
WHERE y1 IN (SELECT y1 FROM cleaned GROUP BY y1 HAVING count(*) > 10) GROUP BY y"""

ORACLES["d_01_csv_scan"] = f"""WITH {TICKETS} SELECT id, md5({_na('summary')}) AS summary_md5, md5({_na('interaction')}) AS interaction_md5,
{_na('type1')} AS type1, {_na('type2')} AS type2, {_na('type3')} AS type3, {_na('type4')} AS type4 FROM tickets"""

ORACLES["d_01_csv_to_parquet"] = f"""WITH {TICKETS} SELECT type1, count(*) AS n, count({_na('type2')}) AS with_type2,
CAST(sum(length({_na('summary')})) AS BIGINT) AS summary_chars FROM tickets GROUP BY type1"""

ORACLES["d_02_text_types"] = f"""WITH {TICKETS}, {TYPED} SELECT id, md5(summary) AS summary_md5, md5(interaction) AS interaction_md5 FROM typed"""

ORACLES["d_03_rename_columns"] = f"""WITH {TICKETS} SELECT id, type1 AS y1, type2 AS y2, type3 AS y3, type4 AS y4, md5(interaction) AS x_md5, type2 AS y FROM tickets"""

ORACLES["d_04_nonempty_targets"] = f"WITH {TICKETS}, {TYPED}, {NONEMPTY} SELECT id, y FROM nonempty"

ORACLES["d_05_frequency_filter"] = f"WITH {_selected(45)} SELECT id, y1, y FROM selected"

ORACLES["d_06_process_data"] = f"""WITH {_selected()}
SELECT 'rows' AS metric, '' AS key, count(*) AS value FROM selected
UNION ALL SELECT 'columns', '', 13 UNION ALL {DISTRIBUTIONS}"""

ORACLES["t_01_translate_column"] = f"""WITH {TICKETS}, l AS (SELECT id, summary AS given, min(type1) OVER (PARTITION BY summary) AS lang FROM tickets),
o AS (SELECT id, CASE WHEN lang = 'en' THEN given ELSE concat('<', lang, '> ', given) END AS t FROM l)
SELECT id, md5(t) AS translated_md5, length(t) AS chars FROM o"""

ORACLES["t_02_translate_batch"] = """WITH l AS (SELECT text, min(lang) AS lang FROM documents GROUP BY text)
SELECT md5(text) AS text_md5, lang, md5(CASE WHEN lang = 'en' THEN text ELSE concat('<', lang, '> ', text) END) AS translated_md5 FROM l"""

ORACLES["t_03_translation_input"] = f"""SELECT doc_id AS id, md5({_given('text')}) AS given_md5, length({_given('text')}) AS chars, lang <> 'en' AS needs_model FROM documents"""

ORACLES["t_04_language_codes"] = f"""WITH c AS (SELECT CASE lang WHEN 'fr' THEN 'fro' WHEN 'es' THEN 'la' WHEN 'de' THEN 'kmr' ELSE lang END AS code FROM documents)
SELECT code, {_mapped('code')} AS mapped, count(*) AS n FROM c GROUP BY code"""

PROFILES = f"""words AS (SELECT DISTINCT doc_id AS id, lang, unnest({_words('lower(text)')}) AS word FROM documents),
counts AS (SELECT lang, word, count(*) AS docs FROM words GROUP BY lang, word),
sizes AS (SELECT lang, count(*) AS total FROM documents GROUP BY lang),
profiles AS (SELECT c.lang, word, (docs * 1000000) // total AS weight FROM counts c JOIN sizes s ON c.lang = s.lang)"""

ORACLES["t_05_language_profiles"] = f"WITH {PROFILES} SELECT lang, word, weight FROM profiles"

ORACLES["t_05_detect_language"] = f"""WITH {PROFILES},
scores AS (SELECT w.id, p.lang, CAST(sum(weight) AS BIGINT) AS score FROM words w JOIN profiles p ON w.word = p.word GROUP BY w.id, p.lang),
best AS (SELECT id, lang FROM scores QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) = 1)
SELECT d.doc_id AS id, d.lang, b.lang AS detected FROM documents d LEFT JOIN best b ON d.doc_id = b.id"""

ORACLES["t_05_split_join"] = f"""WITH {PROFILES}
SELECT w.id, p.lang, CAST(sum(weight) AS BIGINT) AS score FROM words w JOIN profiles p ON w.word = p.word GROUP BY w.id, p.lang"""

ORACLES["t_06_translation_memo"] = f"""WITH g AS (SELECT text, lang FROM documents WHERE text <> ''),
a AS (SELECT text, min(lang) AS lang FROM g WHERE lang IN ('fr', 'de') GROUP BY text),
b AS (SELECT text, min(lang) AS lang FROM g WHERE text NOT IN (SELECT text FROM a) GROUP BY text),
m AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT md5(text) AS text_md5, md5(CASE WHEN lang = 'en' THEN text ELSE concat('<', lang, '> ', text) END) AS translated_md5 FROM m"""

ORACLES["t_06_memo_store"] = ORACLES["t_06_translation_memo"]

ORACLES["x_07_language_aware_translation"] = """WITH l AS (SELECT doc_id AS id, text, min(lang) OVER (PARTITION BY text) AS lang FROM documents)
SELECT id, md5(CASE WHEN lang = 'en' THEN text ELSE concat('<', lang, '> ', text) END) AS translated_md5 FROM l"""

ORACLES["c_02_clean_text"] = f"SELECT doc_id AS id, md5({_strip('text', REGISTRY.summary_patterns(), False)}) AS clean_md5 FROM documents"

ORACLES["c_03_clean_summary"] = f"WITH {TICKETS}, c AS (SELECT id, {SUMMARY_SQL} AS ts FROM tickets) SELECT id, md5(ts) AS ts_md5, length(ts) AS chars FROM c"

ORACLES["c_04_clean_interaction"] = f"WITH {TICKETS}, c AS (SELECT id, {INTERACTION_SQL} AS ic FROM tickets) SELECT id, md5(ic) AS ic_md5, length(ic) AS chars FROM c"

ORACLES["c_05_preprocess"] = f"WITH {TICKETS}, {_cleaned('tickets')} SELECT id, md5(ts) AS ts_md5, md5(ic) AS ic_md5 FROM cleaned"

_CUSTOM = REGISTRY.with_pattern("endings", "ing ").with_pattern("ticket_noise", "the ")
_CUSTOM_CLEAN = _cleaned("tickets", _strip("summary", _CUSTOM.summary_patterns()), _strip("interaction", _CUSTOM.interaction_patterns()))
ORACLES["c_06_custom_pattern"] = f"WITH {TICKETS}, {_CUSTOM_CLEAN} SELECT id, md5(ts) AS ts_md5, md5(ic) AS ic_md5 FROM cleaned"

ORACLES["c_07_text_statistics"] = f"""WITH {TICKETS} SELECT count(*) AS total_texts, CAST(sum(CASE WHEN interaction = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_texts,
{_r('avg(length(interaction))')} AS avg_length, min(length(interaction)) AS min_length, max(length(interaction)) AS max_length,
count(DISTINCT interaction) AS unique_texts FROM tickets WHERE interaction IS NOT NULL"""

# ---- S ---------------------------------------------------------------------------------

ORACLES["s_01_class_distribution"] = f"""WITH {ORDER_LABELS}, {LONG_LEVELS}
SELECT "column", value, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM order_labels), 2) AS percentage
FROM levels WHERE value IS NOT NULL GROUP BY "column", value"""

ORACLES["s_02_balance_gap"] = f"""WITH {ORDER_LABELS}, {LONG_LEVELS},
c AS (SELECT "column", value, count(*) AS n FROM levels WHERE value IS NOT NULL GROUP BY 1, 2),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY "column")::DOUBLE AS p, count(*) OVER (PARTITION BY "column") AS k FROM c)
SELECT "column", count(*) AS num_classes, {_r('sum((p - 1.0::DOUBLE / k) * (p - 1.0::DOUBLE / k))', 9)} AS class_balance FROM p GROUP BY "column" """

ORACLES["s_03_hierarchical_labels"] = f"""WITH {ORDER_LABELS} SELECT id, status AS primary_label, priority AS secondary_label, year AS tertiary_label,
coalesce(status, 'nan') || '_' || coalesce(priority, 'nan') || '_' || coalesce(year, 'nan') AS hierarchical_label FROM order_labels"""

_CODE = lambda c: f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'nan')) - 1 AS INTEGER)"

ORACLES["s_04_encode_labels"] = f"WITH {ORDER_LABELS} SELECT id, " + ", ".join(f"{_CODE(c)} AS {c}_encoded" for c in LEVELS) + " FROM order_labels"

ORACLES["s_04_transform_only"] = f"""WITH {ORDER_LABELS}, e AS (SELECT id, status, {_CODE('priority')} AS priority_encoded FROM order_labels)
SELECT id, priority_encoded FROM e"""

ORACLES["s_05_class_mapping"] = f"""WITH {ORDER_LABELS}, {LONG_LEVELS}, c AS (SELECT DISTINCT "column", coalesce(value, 'nan') AS class FROM levels)
SELECT "column", class, CAST(row_number() OVER (PARTITION BY "column" ORDER BY class) - 1 AS INTEGER) AS code FROM c"""

ORACLES["s_06_multilabel"] = f"WITH {ORDER_LABELS} SELECT id, " + " || ',' || ".join(f"CAST({_CODE(c)} AS VARCHAR)" for c in LEVELS) + " AS codes FROM order_labels"

ORACLES["s_07_rare_classes"] = """SELECT doc_id AS id, lang FROM documents WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 129)"""

ORACLES["s_08_stratified_groups"] = f"""WITH {ORDER_LABELS},
r AS (SELECT id, priority, row_number() OVER (PARTITION BY priority ORDER BY id) AS rn FROM order_labels WHERE priority IS NOT NULL),
c AS (SELECT priority, CAST(ceil(count(*) / 50.0) AS BIGINT) AS g, min(id) AS first_id FROM r GROUP BY priority),
s AS (SELECT priority, coalesce(sum(g) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c)
SELECT id, r.priority, CAST(start + (rn - 1) // 50 AS INTEGER) AS strata_group FROM r JOIN s ON r.priority = s.priority
UNION ALL SELECT id, priority, -1 FROM order_labels WHERE priority IS NULL"""

_ROLES = " UNION ALL ".join(
    f"""SELECT 'role' AS metric, '{c}' AS key, '{'label' if c in LEVELS else 'feature'}' AS value
    UNION ALL SELECT 'data_type', '{c}', '{'bigint' if c == 'id' else 'string'}'
    UNION ALL SELECT 'missing_values', '{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM order_labels""" for c in ("id", *LEVELS))
_LEVEL_ROWS = "(" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM order_labels" for c in LEVELS) + ")"
ORACLES["s_09_data_summary"] = f"""WITH {ORDER_LABELS} SELECT 'total_samples' AS metric, '' AS key, CAST(count(*) AS VARCHAR) AS value FROM order_labels UNION ALL {_ROLES}
UNION ALL SELECT 'label_distribution', "column" || '=' || value, CAST(count(*) AS VARCHAR) FROM (SELECT * FROM {_LEVEL_ROWS}) WHERE value IS NOT NULL GROUP BY "column", value"""

# ---- V ---------------------------------------------------------------------------------


def _stop_words() -> list[str]:
    from ticketloom.operators.vectorize import english_stop_words

    return english_stop_words()


def _terms(source: str, id_col: str, text: str, high: int, stop: list[str] | None, extra: str = "") -> str:
    """``toks(id, t)`` and ``terms(id, t)`` with 1..high-grams."""
    words = _words(text)
    if stop:
        banned = "[" + ", ".join(_text(w) for w in stop) + "]"
        words = f"list_filter({words}, lambda w: NOT list_contains({banned}, w))"
    grams = "t"
    if high == 2:
        grams = "list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))"
    return f"toks AS (SELECT {id_col} AS id{extra}, {words} AS t FROM {source}), terms AS (SELECT * EXCLUDE (t), {grams} AS t FROM toks)"


def _vocabulary(top: int, source: str = "terms", min_df: int = 2, max_df: str = "0.95") -> str:
    return f"""occ AS (SELECT id, unnest(t) AS term FROM {source}),
    tfs AS (SELECT id, term, count(*) AS tf FROM occ GROUP BY id, term),
    vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tfs GROUP BY term
      HAVING count(*) >= {min_df} AND count(*) <= CAST({max_df} AS DOUBLE) * (SELECT count(*) FROM {source}) ORDER BY tf DESC, term LIMIT {top})"""


def _weights(n: str = "(SELECT count(*) FROM terms)") -> str:
    return f"""raw AS (SELECT id, x.term, x.tf * (ln((1.0::DOUBLE + {n}) / (1 + v.df)) + 1) AS w FROM tfs x JOIN vocab v ON x.term = v.term),
    weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def vector_oracles() -> dict[str, str]:
    """Queries that spell out the stop list, which Spark's JVM holds."""
    stop = _stop_words()
    out = {}
    out["v_01_ngram_terms"] = f"""WITH {_terms('documents', 'doc_id', 'lower(text)', 2, stop)}
    SELECT id, CAST(len(t) AS BIGINT) AS n_terms, md5(coalesce(array_to_string(t, ','), '')) AS terms_md5 FROM terms"""
    out["v_02_count_vocabulary"] = f"WITH {_terms('documents', 'doc_id', 'lower(text)', 2, stop)}, {_vocabulary(10000)} SELECT term, tf, df FROM vocab"
    msgs = f"{MESSAGES}, {_terms('messages', 'id', 'text', 2, stop)}"
    out["v_03_tfidf_weights"] = f"WITH {msgs}, {_vocabulary(10000)}, {_weights()} SELECT id, term, {_r('weight')} AS weight FROM weights"
    singles = f"{MESSAGES}, {_terms('messages', 'id', 'text', 1, stop)}"
    out["v_04_count_vectors"] = f"WITH {singles}, {_vocabulary(10000)} SELECT id, x.term, x.tf FROM tfs x JOIN vocab v ON x.term = v.term"
    out["v_05_transform_unseen"] = f"""WITH {MESSAGES}, {_terms('messages', 'id', 'text', 1, stop, ', role')},
    fit_terms AS (SELECT id, t FROM terms WHERE role = 'user'), new_terms AS (SELECT id, t FROM terms WHERE role <> 'user'),
    {_vocabulary(10000, 'fit_terms')},
    n_occ AS (SELECT id, unnest(t) AS term FROM new_terms), n_tfs AS (SELECT id, term, count(*) AS tf FROM n_occ GROUP BY id, term),
    raw AS (SELECT id, x.term, x.tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM fit_terms)) / (1 + v.df)) + 1) AS w FROM n_tfs x JOIN vocab v ON x.term = v.term),
    s AS (SELECT id, count(*) AS terms, sum(w) / sqrt(sum(w * w)) AS total FROM raw GROUP BY id)
    SELECT n.id, coalesce(s.terms, 0) AS terms, {_r('coalesce(total, 0.0)')} AS total FROM new_terms n LEFT JOIN s ON n.id = s.id"""
    out["v_09_feature_importance"] = f"""WITH {msgs}, {_vocabulary(10000)}, {_weights()},
    m AS (SELECT term, sum(weight) / (SELECT count(*) FROM terms) AS importance FROM weights GROUP BY term)
    SELECT term, {_r('importance')} AS importance FROM m ORDER BY round(importance, 9) DESC, term LIMIT 20"""
    parts = []
    for c in ("ts", "ic"):
        parts.append(f"""SELECT '{c}_tfidf' AS vectorizer, (SELECT count(*) FROM kept) AS n_rows, (SELECT count(*) FROM (
          WITH {_terms('kept', 'id', c, 2, stop)}, {_vocabulary(10000)} SELECT * FROM vocab)) AS n_features""")
    out["v_10_vectorize_frame"] = f"""WITH {_selected()}, {_cleaned('selected')}, kept AS MATERIALIZED (SELECT id, ts, ic FROM cleaned),
    each AS ({' UNION ALL '.join(parts)}) SELECT * FROM each UNION ALL SELECT 'total', max(n_rows), CAST(sum(n_features) AS BIGINT) FROM each"""
    out["g_02_sparsity"] = f"""WITH {singles}, {_vocabulary(10000)}, hits AS (SELECT count(*) AS h FROM tfs x JOIN vocab v ON x.term = v.term)
    SELECT (SELECT count(*) FROM vocab) AS n_features, {_r('1.0::DOUBLE - h / ((SELECT count(*) FROM terms) * (SELECT count(*) FROM vocab))::DOUBLE')} AS data_sparsity FROM hits"""
    texts = "texts AS (SELECT id, lower(text) AS ic, lower(role || ' ' || text) AS ts_en FROM messages)"
    parts = [f"""SELECT '{c}_tfidf' AS vectorizer, (SELECT count(*) FROM texts) AS n_rows, (SELECT count(*) FROM (
      WITH {_terms('texts', 'id', c, 1, None)}, {_vocabulary(2000, min_df=4, max_df='0.9')} SELECT * FROM vocab)) AS n_features""" for c in ("ic", "ts_en")]
    out["x_02_script_vectors"] = f"""WITH {MESSAGES}, {texts}, each AS ({' UNION ALL '.join(parts)})
    SELECT * FROM each UNION ALL SELECT 'total', max(n_rows), CAST(sum(n_features) AS BIGINT) FROM each"""
    out["m_05_naive_bayes_log_probabilities"] = f"""WITH {_terms('documents', 'doc_id', 'lower(text)', 1, stop, ', lang')}, {_vocabulary(10000)},
    langs AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label FROM (SELECT DISTINCT lang FROM documents)),
    frame AS (SELECT l.label, l.lang, v.term FROM langs l CROSS JOIN vocab v),
    hits AS (SELECT d.lang, x.term, sum(x.tf) AS n FROM tfs x JOIN documents d ON x.id = d.doc_id JOIN vocab v ON x.term = v.term GROUP BY d.lang, x.term),
    filled AS (SELECT f.label, f.term, coalesce(h.n, 0) + 1 AS n FROM frame f LEFT JOIN hits h ON f.lang = h.lang AND f.term = h.term)
    SELECT label, term, {_r('ln(n::DOUBLE) - ln(sum(n) OVER (PARTITION BY label)::DOUBLE)')} AS log_probability FROM filled"""
    return out


ORACLES["v_06_caller_embeddings"] = f"""WITH {TICKETS}, f AS (SELECT id, CASE WHEN interaction IS NULL OR trim(regexp_replace(interaction, '\\s', ' ', 'g')) = '' THEN 'empty' ELSE interaction END AS t FROM tickets)
SELECT id, length(t) AS chars, length(t) - length(replace(t, 'e', '')) AS letters_e FROM f"""

ORACLES["v_07_svd_full_rank"] = f"WITH {VEC3} SELECT id, {_r('list_dot_product(f, f)', 5)} AS energy FROM vec3"

ORACLES["v_07_planted_rank"] = f"""WITH {VEC3}, p AS (SELECT id, list_transform(range(len(f)), lambda i: CASE WHEN i < 4 THEN f[i + 1] ELSE 2 * f[i % 4 + 1] END) AS v FROM vec3)
SELECT id, {_r('list_dot_product(v, v)', 5)} AS energy, 4 AS rank FROM p"""

_BOTH = {"v_08_concatenate": "list_concat(f, list_reverse(f))", "v_08_average": "list_transform(range(1, len(f) + 1), lambda i: (f[i] + f[len(f) + 1 - i]) / 2)"}
for _name, _expr in _BOTH.items():
    ORACLES[_name] = f"""WITH {VEC3}, b AS (SELECT id, {_expr} AS v FROM vec3)
    SELECT id, CAST(len(v) AS BIGINT) AS width, {_r('list_sum(v)')} AS total, {_r('list_dot_product(v, list_transform(range(1, len(v) + 1), lambda i: i::DOUBLE))')} AS weighted FROM b"""

# ---- R, P ------------------------------------------------------------------------------

ORACLES["r_01_hash_rank"] = f"SELECT doc_id AS id, lang, {_hash_rank('lang', '42', 'doc_id')} AS place FROM documents"
ORACLES["r_01_number_rank"] = "SELECT o_orderkey AS id, o_orderstatus AS status, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS place FROM orders"

LANG_DOCS = "docs AS (SELECT doc_id AS id, lang FROM documents)"
QUOTAS = """c AS (SELECT lang, count(*) AS n FROM docs GROUP BY lang),
t AS (SELECT lang, n, CAST(sum(n) OVER () AS BIGINT) AS total, CAST(ceil(sum(n) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_test FROM c),
q AS (SELECT lang, (n * n_test) // total AS low, (n * n_test) % total AS rest, n_test FROM t),
quotas AS (SELECT lang, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= n_test - sum(low) OVER () THEN 1 ELSE 0 END AS quota FROM q)"""

ORACLES["p_01_basic_split"] = f"""WITH {LANG_DOCS}, {QUOTAS}, r AS (SELECT *, {_hash_rank('lang', '42')} AS rn FROM docs)
SELECT id, r.lang, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split FROM r JOIN quotas ON r.lang = quotas.lang"""

ORACLES["p_01_unstratified_split"] = f"""WITH {LANG_DOCS}, r AS (SELECT *, {_hash_rank(None, '42')} AS rn, count(*) OVER () AS n FROM docs)
SELECT id, lang, CASE WHEN rn <= ceil(n * CAST(0.25 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM r"""

ORACLES["p_02_stratified_splits"] = f"""WITH {LANG_DOCS}, {QUOTAS}, k AS (SELECT id, lang, CAST(unnest(range(0, 5)) AS INTEGER) AS split_no FROM docs),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, split_no ORDER BY md5('42|' || split_no || '|' || id), id) AS rn FROM k)
SELECT id, r.lang, split_no, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split FROM r JOIN quotas ON r.lang = quotas.lang"""


def _temporal(test: str, validation: str) -> str:
    return f"""tr AS (SELECT *, row_number() OVER (ORDER BY ts NULLS LAST, md5('42|' || event_id), event_id) AS rn, count(*) OVER () AS n FROM events),
    tt AS (SELECT *, CAST(floor(n * CAST({test} AS DOUBLE)) AS BIGINT) AS n_test, CAST(floor(n * CAST({validation} AS DOUBLE)) AS BIGINT) AS n_val FROM tr),
    parts AS (SELECT *, CASE WHEN rn <= n - n_test - n_val THEN 'train' WHEN rn <= n - n_test THEN 'validation' ELSE 'test' END AS split FROM tt)"""


ORACLES["p_03_temporal_split"] = f"WITH {_temporal('0.2', '0.1')} SELECT event_id, split FROM parts"


ORACLES["p_03_temporal_split_missing"] = f"""WITH given AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN ts END AS ts FROM main.events),
events AS (SELECT * FROM given), {_temporal('0.2', '0.1')} SELECT event_id, split FROM parts"""


def _groups(test: str, cap: str, user: str = "user_id") -> str:
    return f"""WITH ev AS (SELECT event_id, {user} AS user_id FROM events),
    g AS (SELECT user_id, row_number() OVER (ORDER BY md5('42|' || coalesce(CAST(user_id AS VARCHAR), 'null group')), user_id) AS rn, least(count(*) OVER (), {cap}) AS kept
    FROM (SELECT DISTINCT user_id FROM ev))
    SELECT event_id, e.user_id, CASE WHEN rn <= floor(kept * CAST({test} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
    FROM ev e JOIN g ON e.user_id IS NOT DISTINCT FROM g.user_id WHERE rn <= kept"""


ORACLES["p_04_group_split"] = _groups("0.2", "1000000000")
_SOME_GROUPS = _groups("0.2", "1000000000", "CASE WHEN event_id % 7 <> 0 THEN user_id END")
ORACLES["p_04_group_split_nulls"] = f"SELECT event_id, coalesce(user_id, -1) AS user_id, split FROM ({_SOME_GROUPS})"
ORACLES["p_04_group_split_capped"] = _groups("0.25", "40")

ORACLES["p_08_group_summary"] = f"SELECT split, count(*) AS n, count(DISTINCT user_id) AS groups FROM ({ORACLES['p_04_group_split']}) GROUP BY split"
ORACLES["p_08_stratified_summary"] = f"SELECT split_no, split, lang, count(*) AS n FROM ({ORACLES['p_02_stratified_splits']}) GROUP BY ALL"
ORACLES["m_14_tuning_grid"] = "SELECT * FROM (VALUES ('knn', 6, true, true), ('naive_bayes', 6, true, true), ('decision_tree', 6, true, true)) t(model, fits, best_is_reported, in_range)"
ORACLES["p_05_cross_validation"] = f"""WITH {LANG_DOCS} SELECT id, lang,
CAST((row_number() OVER (ORDER BY lang, md5('42|' || id), id) - 1) % 5 AS INTEGER) AS fold FROM docs"""
ORACLES["p_05_plain_folds"] = f"""WITH {LANG_DOCS} SELECT id, CAST(({_hash_rank(None, '42')} - 1) % 4 AS INTEGER) AS fold FROM docs"""
ORACLES["p_08_fold_summary"] = f"SELECT fold, count(*) AS n FROM ({ORACLES['p_05_cross_validation']}) GROUP BY fold"

ORACLES["p_06_nested_cross_validation"] = f"""WITH {LANG_DOCS},
o AS (SELECT id, lang, (row_number() OVER (ORDER BY lang, md5('42|' || id), id) - 1) % 5 AS own FROM docs),
k AS (SELECT *, CAST(unnest(range(0, 5)) AS INTEGER) AS outer_fold FROM o),
i AS (SELECT id, lang, outer_fold, CAST((row_number() OVER (PARTITION BY outer_fold ORDER BY lang, md5('42|' || (outer_fold + 1) || '|' || id), id) - 1) % 3 AS INTEGER) AS inner_fold
  FROM k WHERE own <> outer_fold)
SELECT id, lang, outer_fold, inner_fold, 'train' AS role FROM i
UNION ALL SELECT id, lang, outer_fold, -1, 'test' FROM k WHERE own = outer_fold"""

ORACLES["p_07_class_counts"] = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"

ORACLES["p_08_split_summary"] = f"""WITH {_temporal('0.2', '0.1')} SELECT split, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_time,
strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_time FROM parts GROUP BY split"""

ORACLES["p_09_validate_split"] = f"""WITH {_temporal('0.3', '0.0')},
size AS (SELECT sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) / sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END)::DOUBLE AS v FROM parts),
sh AS (SELECT event_type, split, count(*) / sum(count(*)) OVER (PARTITION BY split)::DOUBLE AS p FROM parts GROUP BY event_type, split),
dr AS (SELECT event_type, abs(coalesce(sum(CASE WHEN split = 'train' THEN p END), 0) - coalesce(sum(CASE WHEN split = 'test' THEN p END), 0)) AS v FROM sh GROUP BY event_type),
mv AS (SELECT 'value' AS item, avg(CASE WHEN split = 'train' THEN value END) AS a, avg(CASE WHEN split = 'test' THEN value END) AS b FROM parts
  UNION ALL SELECT 'user_id', avg(CASE WHEN split = 'train' THEN user_id END), avg(CASE WHEN split = 'test' THEN user_id END) FROM parts),
mm AS (SELECT item, abs(a - b) / abs(a) AS v FROM mv WHERE a <> 0)
SELECT 'size_ratio' AS "check", '' AS item, {_r('v')} AS value, CASE WHEN v < 0.15 THEN 'too small' WHEN v > 0.4 THEN 'too large' ELSE 'ok' END AS flag FROM size
UNION ALL SELECT 'label_drift', event_type, {_r('v')}, CASE WHEN v > 0.1 THEN 'drift' ELSE 'ok' END FROM dr
UNION ALL SELECT 'feature_drift', item, {_r('v')}, CASE WHEN v > 0.2 THEN 'drift' ELSE 'ok' END FROM mm"""

ORACLES["x_01_rare_class_split"] = f"""WITH {LANG_DOCS}, f AS (SELECT id, lang, count(*) OVER (PARTITION BY lang) >= 110 AS good FROM docs),
n AS (SELECT count(*) AS n, sum(CASE WHEN good THEN 1 ELSE 0 END) AS g FROM f),
k AS (SELECT least(g, ceil(g * (n * CAST(0.2 AS DOUBLE) / g))) AS n_test FROM n),
rk AS (SELECT *, row_number() OVER (PARTITION BY good ORDER BY md5('0|' || id), id) AS rn FROM f)
SELECT id, lang, CASE WHEN good AND rn <= n_test THEN 'test' ELSE 'train' END AS split FROM rk, k"""

# ---- B, N ------------------------------------------------------------------------------

ORACLES["b_01_imbalance_shares"] = """SELECT lang, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS percentage FROM documents GROUP BY lang"""

ORACLES["b_01_imbalance_summary"] = f"""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT {_r('max(n) / min(n)::DOUBLE')} AS imbalance_ratio, (SELECT lang FROM c ORDER BY n, lang LIMIT 1) AS minority_class,
(SELECT lang FROM c ORDER BY n DESC, lang LIMIT 1) AS majority_class, CAST(sum(n) AS BIGINT) AS total_samples, count(*) AS num_classes,
max(n) / min(n)::DOUBLE <= 1.5 AS is_balanced FROM c"""


def _redraw(draws: str) -> str:
    """``drawn(id, label, copy_no)`` from ``plan(label, n, target)``."""
    return f"""d AS (SELECT label, n, CAST(unnest(range(1, ({draws}) + 1)) AS BIGINT) AS c FROM plan WHERE ({draws}) > 0),
    picks AS (SELECT label, 1 + {_hash_int("'42|' || label || '|' || c", 'n')} AS pick, count(*) AS times FROM d GROUP BY 1, 2),
    ranked AS (SELECT id, label, {_hash_rank('label', '42')} AS rn FROM vec3),
    drawn AS (SELECT r.id, r.label, CAST(unnest(range(1, p.times + 1)) AS BIGINT) AS copy_no FROM ranked r JOIN picks p ON r.label = p.label AND r.rn = p.pick)"""


_COUNTS = "counts AS (SELECT label, count(*) AS n FROM vec3 GROUP BY label)"
_OVER = f"WITH {VEC3}, {_COUNTS}, plan AS (SELECT label, n, max(n) OVER () AS target FROM counts), {_redraw('target - n')} SELECT id, label, 0::BIGINT AS copy_no FROM vec3 UNION ALL SELECT * FROM drawn"
ORACLES["b_02_random_oversample"] = _OVER
ORACLES["b_11_auto_balance"] = _OVER
ORACLES["b_02_oversample_counts"] = f"""WITH {VEC3}, {_COUNTS}, plan AS (SELECT label, n, CASE label WHEN 0 THEN 5000 WHEN 1 THEN 6000 ELSE n END AS target FROM counts),
{_redraw('target - n')} SELECT id, label, 0::BIGINT AS copy_no FROM vec3 UNION ALL SELECT * FROM drawn"""
ORACLES["b_10_custom_balanced"] = f"""WITH {VEC3}, {_COUNTS}, plan AS (SELECT label, n, 120 AS target FROM counts), {_redraw('CASE WHEN n < target THEN target ELSE 0 END')}
SELECT r.id, r.label, 0::BIGINT AS copy_no FROM ranked r JOIN plan p ON r.label = p.label WHERE p.n >= target AND rn <= target UNION ALL SELECT * FROM drawn"""
ORACLES["b_03_random_undersample"] = f"""WITH {VEC3}, {_COUNTS}, ranked AS (SELECT id, label, {_hash_rank('label', '42')} AS rn FROM vec3)
SELECT id, label FROM ranked WHERE rn <= (SELECT min(n) FROM counts)"""

PAIRS = """dist AS (SELECT a.id, a.label, b.id AS nn_id, b.label AS nn_label, round(list_distance(a.f, b.f), 9) AS distance FROM vec3 a JOIN vec3 b ON a.id <> b.id)"""
NN = "nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nn_id) AS nn_rank FROM dist)"

ORACLES["n_01_nearest_neighbours"] = f"WITH {VEC3}, {PAIRS}, {NN} SELECT id, CAST(nn_rank AS INTEGER) AS nn_rank, nn_id, distance FROM nn WHERE nn_rank <= 5"
ORACLES["n_01_approximate_counts"] = "SELECT vec_id AS id, CAST(3 AS BIGINT) AS n, CAST(3 AS INTEGER) AS last_rank FROM embeddings"
ORACLES["n_01_class_neighbours"] = f"""WITH {VEC3}, {PAIRS}, k AS (SELECT id, nn_id, distance, row_number() OVER (PARTITION BY id ORDER BY distance, nn_id) AS nn_rank
FROM dist WHERE label = nn_label) SELECT id, CAST(nn_rank AS INTEGER) AS nn_rank, nn_id, distance FROM k WHERE nn_rank <= 3"""

SAME = "same AS (SELECT id, nn_id, label, row_number() OVER (PARTITION BY id ORDER BY distance, nn_id) AS nn_rank FROM dist WHERE label = nn_label)"


def _synthetic(source: str) -> str:
    """Points from ``edges(label, src_id, nn_id, u, copy_no, row_key)``."""
    return f"""pts AS (SELECT e.row_key, e.label, e.src_id, e.copy_no, list_transform(range(1, len(a.f) + 1), lambda i: a.f[i] + e.u * (b.f[i] - a.f[i])) AS v
      FROM {source} e JOIN vec3 a ON e.src_id = a.id JOIN vec3 b ON e.nn_id = b.id)
    SELECT CAST(id AS VARCHAR) AS row_key, label, false AS is_synthetic, id AS src_id, 0::BIGINT AS copy_no, {_r('list_sum(f)')} AS total, {_r('f[1]')} AS first FROM vec3
    UNION ALL SELECT row_key, label, true, src_id, copy_no, {_r('list_sum(v)')}, {_r('v[1]')} FROM pts"""


ORACLES["b_04_smote"] = f"""WITH {VEC3}, {PAIRS}, {SAME}, {_COUNTS}, plan AS (SELECT label, n, max(n) OVER () - n AS draws FROM counts),
d AS (SELECT label, n, CAST(unnest(range(1, draws + 1)) AS BIGINT) AS c FROM plan WHERE draws > 0),
h AS (SELECT label, c, {_hash_int("'42|' || label || '|' || c", 'n * 5')} AS slot, {_hash_unit("'42|u|' || label || '|' || c")} AS u FROM d),
ranked AS (SELECT id, label, {_hash_rank('label', '42')} AS rn FROM vec3),
edges AS (SELECT h.label, r.id AS src_id, s.nn_id, h.u, h.c AS copy_no, 's|' || h.label || '|' || h.c AS row_key
  FROM h JOIN ranked r ON h.label = r.label AND r.rn = h.slot // 5 + 1 JOIN same s ON s.id = r.id AND s.nn_rank = h.slot % 5 + 1),
{_synthetic('edges')}"""

SMOTE_DRAWS = f"""{_COUNTS}, plan AS (SELECT label, n, max(n) OVER () - n AS draws FROM counts),
d AS (SELECT label, n, CAST(unnest(range(1, draws + 1)) AS BIGINT) AS c FROM plan WHERE draws > 0),
h AS (SELECT label, c, {_hash_int("'42|' || label || '|' || c", 'n * 5')} AS slot, {_hash_unit("'42|u|' || label || '|' || c")} AS u FROM d),
ranked AS (SELECT id, label, {_hash_rank('label', '42')} AS rn FROM vec3),
grown AS (SELECT CAST(id AS VARCHAR) AS k, label, false AS is_synthetic, f FROM vec3
  UNION ALL SELECT 's|' || h.label || '|' || h.c, h.label, true, list_transform(range(1, len(a.f) + 1), lambda i: a.f[i] + h.u * (b.f[i] - a.f[i]))
  FROM h JOIN ranked r ON h.label = r.label AND r.rn = h.slot // 5 + 1 JOIN same s ON s.id = r.id AND s.nn_rank = h.slot % 5 + 1
  JOIN vec3 a ON a.id = r.id JOIN vec3 b ON b.id = s.nn_id),
near AS (SELECT x.k, x.label, y.k AS o, y.label AS o_label, row_number() OVER (PARTITION BY x.k ORDER BY round(list_distance(x.f, y.f), 9), y.k) AS place
  FROM grown x JOIN grown y ON x.k <> y.k QUALIFY place <= 3)"""

ORACLES["b_08_smote_tomek"] = f"""WITH {VEC3}, {PAIRS}, {SAME}, {SMOTE_DRAWS}, one AS (SELECT * FROM near WHERE place = 1),
linked AS (SELECT a.k FROM one a JOIN one b ON a.o = b.k AND b.o = a.k WHERE a.label <> b.label)
SELECT label, is_synthetic, count(*) AS n FROM grown WHERE k NOT IN (SELECT k FROM linked) GROUP BY label, is_synthetic"""

ORACLES["b_09_smote_enn"] = f"""WITH {VEC3}, {PAIRS}, {SAME}, {SMOTE_DRAWS}
SELECT label, is_synthetic, count(*) AS n FROM grown WHERE k NOT IN (SELECT k FROM near WHERE label <> o_label) GROUP BY label, is_synthetic"""

for _name in ("b_08_smote_tomek", "b_09_smote_enn"):
    ORACLES[f"{_name}_rows"] = ORACLES[_name].replace("SELECT label, is_synthetic, count(*) AS n FROM grown", "SELECT k AS row_key, label, is_synthetic FROM grown").replace(" GROUP BY label, is_synthetic", "")

ALLOCATION = f"""{_COUNTS}, plan AS (SELECT label, n, max(n) OVER () - n AS draws FROM counts),
per_row AS (SELECT id, label, CAST(sum(CASE WHEN nn_label <> label THEN 1 ELSE 0 END) AS BIGINT) AS other_neighbours FROM nn WHERE nn_rank <= 5 GROUP BY id, label),
sized AS (SELECT r.*, p.draws, CAST(sum(other_neighbours) OVER (PARTITION BY r.label) AS BIGINT) AS total FROM per_row r JOIN plan p ON r.label = p.label WHERE p.draws > 0),
allocation AS (SELECT id, label, other_neighbours, (other_neighbours * draws) // total + CASE
  WHEN 2 * ((other_neighbours * draws) % total) > total THEN 1
  WHEN 2 * ((other_neighbours * draws) % total) = total AND ((other_neighbours * draws) // total) % 2 = 1 THEN 1 ELSE 0 END AS n_new FROM sized)"""

ORACLES["b_05_adasyn_allocation"] = f"WITH {VEC3}, {PAIRS}, {NN}, {ALLOCATION} SELECT id, label, other_neighbours, CAST(n_new AS BIGINT) AS n_new FROM allocation"

ORACLES["b_05_adasyn"] = f"""WITH {VEC3}, {PAIRS}, {NN}, {SAME}, {ALLOCATION},
d AS (SELECT id, label, CAST(unnest(range(1, n_new + 1)) AS BIGINT) AS c FROM allocation),
h AS (SELECT id, label, c, 1 + {_hash_int("'42|' || id || '|' || c", '5')} AS place, {_hash_unit("'42|u|' || id || '|' || c")} AS u FROM d),
edges AS (SELECT h.label, h.id AS src_id, s.nn_id, h.u, h.c AS copy_no, 's|' || h.id || '|' || h.c AS row_key FROM h JOIN same s ON s.id = h.id AND s.nn_rank = h.place),
{_synthetic('edges')}"""


def _nearmiss(direction: str) -> str:
    return f"""WITH {VEC3}, {_COUNTS}, rare AS (SELECT label, n FROM counts ORDER BY n, label LIMIT 1),
    dm AS (SELECT a.id, a.label, b.id AS nn_id, round(list_distance(a.f, b.f), 9) AS distance FROM vec3 a JOIN vec3 b ON b.label = (SELECT label FROM rare) WHERE a.label <> (SELECT label FROM rare)),
    top AS (SELECT * FROM dm QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance {direction}, nn_id) <= 3),
    mean AS (SELECT id, label, round(avg(distance), 9) AS m FROM top GROUP BY id, label),
    kept AS (SELECT id, label FROM mean QUALIFY row_number() OVER (PARTITION BY label ORDER BY m, md5('42|' || id), id) <= (SELECT n FROM rare))
    SELECT id, label FROM kept UNION ALL SELECT id, label FROM vec3 WHERE label = (SELECT label FROM rare)"""


ORACLES["b_06_nearmiss_1"] = _nearmiss("ASC")
ORACLES["b_06_nearmiss_2"] = _nearmiss("DESC")
ORACLES["b_06_nearmiss_3"] = f"""WITH {VEC3}, {_COUNTS}, rare AS (SELECT label, n FROM counts ORDER BY n, label LIMIT 1),
dm AS (SELECT a.id, a.label, b.id AS nn_id, round(list_distance(a.f, b.f), 9) AS distance FROM vec3 a JOIN vec3 b ON b.label = (SELECT label FROM rare) WHERE a.label <> (SELECT label FROM rare)),
chosen AS (SELECT DISTINCT id FROM (SELECT id FROM dm QUALIFY row_number() OVER (PARTITION BY nn_id, label ORDER BY distance, id) <= 3)),
top AS (SELECT * FROM dm WHERE id IN (SELECT id FROM chosen) QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, nn_id) <= 3),
mean AS (SELECT id, label, round(avg(distance), 9) AS m FROM top GROUP BY id, label),
kept AS (SELECT id, label FROM mean QUALIFY row_number() OVER (PARTITION BY label ORDER BY m DESC, md5('42|' || id), id) <= (SELECT n FROM rare))
SELECT id, label FROM kept UNION ALL SELECT id, label FROM vec3 WHERE label = (SELECT label FROM rare)"""

ORACLES["b_07_tomek_links"] = f"""WITH {VEC3}, {PAIRS}, {NN}, {_COUNTS}, one AS (SELECT * FROM nn WHERE nn_rank = 1),
links AS (SELECT a.id, a.label FROM one a JOIN one b ON a.nn_id = b.id AND b.nn_id = a.id WHERE a.label <> b.label)
SELECT id, label FROM vec3 WHERE id NOT IN (SELECT id FROM links WHERE label <> (SELECT label FROM counts ORDER BY n, label LIMIT 1))"""

ORACLES["b_12_compare_methods"] = f"""WITH {VEC3}, {PAIRS}, {NN}, {ALLOCATION},
sizes AS (SELECT 'original' AS method, label, n FROM counts UNION ALL SELECT 'random_oversample', label, max(n) OVER () FROM counts
  UNION ALL SELECT 'random_undersample', label, min(n) OVER () FROM counts UNION ALL SELECT 'smote', label, max(n) OVER () FROM counts
  UNION ALL SELECT 'adasyn', c.label, c.n + coalesce(a.x, 0) FROM counts c LEFT JOIN (SELECT label, sum(n_new) AS x FROM allocation GROUP BY label) a ON c.label = a.label)
SELECT method, CAST(sum(n) AS BIGINT) AS samples, (SELECT CAST(max(len(f)) AS BIGINT) FROM vec3) AS features, {_r('max(n) / min(n)::DOUBLE')} AS imbalance_ratio,
max(n) / min(n)::DOUBLE <= 1.5 AS is_balanced FROM sizes GROUP BY method"""

ORACLES["m_06_knn"] = f"""WITH {VEC3}, da AS (SELECT a.id, a.label, b.label AS vote, round(list_distance(a.f, b.f), 9) AS distance, b.id AS nn_id FROM vec3 a CROSS JOIN vec3 b),
k AS (SELECT * FROM da QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, nn_id) <= 5),
v AS (SELECT id, label, vote, count(*) AS n FROM k GROUP BY id, label, vote)
SELECT id, label, vote AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, vote) = 1"""

# ---- G ---------------------------------------------------------------------------------

ORACLES["g_01_characteristics"] = f"""WITH {VEC3}, e AS (SELECT id, unnest(f) AS w, unnest(range(1, len(f) + 1)) AS i FROM vec3), c AS (SELECT i, var_pop(w) AS v, sum(CASE WHEN w = 0 THEN 1 ELSE 0 END) AS z, count(*) AS n FROM e GROUP BY i)
SELECT max(n) AS n_samples, count(*) AS n_features, {_r('sum(z) / sum(n)::DOUBLE')} AS data_sparsity, {_r('avg(v)')} AS feature_variance FROM c"""


def _quality(source: str, column: str) -> str:
    return f"""SELECT count(*) AS n_unique_labels, min(n) AS min_class, CAST(sum(n) AS BIGINT) AS n_labelled,
    CASE WHEN count(*) > 1 THEN sum(-p * log2(p + 1e-10)) / log2(count(*)) ELSE 0 END AS balance
    FROM (SELECT n, n / sum(n) OVER ()::DOUBLE AS p FROM (SELECT {column} AS c, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}))"""


ORACLES["g_01_label_quality"] = f"""WITH q AS ({_quality('documents', 'lang')}) SELECT n_unique_labels, min_class, n_labelled, {_r('balance')} AS label_balance_score,
n_unique_labels > 2 AS is_multiclass, balance < 0.7 AS is_imbalanced FROM q"""

ORACLES["g_03_label_balance"] = f"WITH {ORDER_LABELS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_r('balance')} AS balance FROM ({_quality('order_labels', c)})" for c in LEVELS)

FEASIBLE = f"""q AS ({_quality('vec3', 'label')}), n AS (SELECT count(*) AS n FROM vec3),
t AS (SELECT *, CASE WHEN min_class >= 10 THEN 3 ELSE 0 END + CASE WHEN balance >= 0.7 THEN 3 ELSE 0 END + CASE WHEN n >= 100 THEN 2 ELSE 0 END
  + CASE WHEN 64 <= n / 10.0 THEN 2 ELSE 0 END AS tenths,
  concat_ws('; ', CASE WHEN min_class < 10 THEN 'Too few samples per class (min: ' || min_class || ')' END, CASE WHEN balance < 0.7 THEN 'Class is imbalanced' END,
    CASE WHEN n < 100 THEN 'Too few samples overall' END, CASE WHEN 64 > n / 10.0 THEN 'Too many features compared to samples' END) AS reasons FROM q, n)"""

ORACLES["g_04_feasibility"] = f"""WITH {VEC3}, {FEASIBLE} SELECT n AS n_samples, n_unique_labels, min_class, {_r('balance')} AS label_balance_score, n_unique_labels > 2 AS is_multiclass,
balance < 0.7 AS is_imbalanced, tenths / 10.0::DOUBLE AS feasibility_score, CASE WHEN tenths >= 6 THEN 'supervised' ELSE 'unsupervised' END AS recommendation, reasons FROM t"""

ORACLES["g_10_recommend_labelled"] = f"""WITH {VEC3}, {FEASIBLE}, e AS (SELECT unnest(f) AS w, unnest(range(1, len(f) + 1)) AS i FROM vec3),
v AS (SELECT avg(vp) AS variance, sum(z) / sum(m)::DOUBLE AS sparsity FROM (SELECT var_pop(w) AS vp, sum(CASE WHEN w = 0 THEN 1 ELSE 0 END) AS z, count(*) AS m FROM e GROUP BY i))
SELECT CASE WHEN tenths >= 6 THEN 'supervised' ELSE 'unsupervised' END AS primary_strategy, CASE WHEN tenths >= 6 THEN tenths / 10.0::DOUBLE ELSE 1 - tenths / 10.0::DOUBLE END AS confidence,
concat_ws('; ', CASE WHEN tenths >= 6 THEN 'Labels are of good quality' WHEN reasons <> '' THEN reasons END, 'Model interpretability required', 'Known number of classes: 3') AS reasoning,
CASE WHEN tenths >= 6 THEN '' ELSE 'semi_supervised' END AS alternatives,
concat_ws('; ', CASE WHEN tenths >= 6 AND balance < 0.7 THEN 'Consider data balancing' END, CASE WHEN sparsity > 0.8 THEN 'Data is very sparse - consider dimensionality reduction' END,
  CASE WHEN variance < 0.01 THEN 'Low feature variance - consider feature selection' END) AS preprocessing FROM t, v"""

ORACLES["g_06_silhouette"] = f"""WITH {VEC3}, pd AS (SELECT a.id, a.label, b.label AS o, list_distance(a.f, b.f) AS distance FROM vec3 a JOIN vec3 b ON a.id <> b.id),
m AS (SELECT id, label, o, avg(distance) AS d FROM pd GROUP BY id, label, o),
s AS (SELECT id, label, max(CASE WHEN o = label THEN d END) AS a, min(CASE WHEN o <> label THEN d END) AS b FROM m GROUP BY id, label)
SELECT id, label, {_r('CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END')} AS silhouette FROM s"""

ORACLES["g_07_dbscan"] = f"""WITH RECURSIVE {VEC3}, close AS (SELECT a.id, b.id AS nn FROM vec3 a JOIN vec3 b ON round(list_distance(a.f, b.f), 9) <= 1.16),
core AS (SELECT id FROM close GROUP BY id HAVING count(*) >= 5),
links AS (SELECT c.id, c.nn FROM close c JOIN core a ON c.id = a.id JOIN core b ON c.nn = b.id),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT l.nn, r.root FROM reach r JOIN links l ON l.id = r.id),
labels_core AS (SELECT id, min(root) AS cluster FROM reach GROUP BY id),
border AS (SELECT c.id, min(l.cluster) AS cluster FROM close c JOIN labels_core l ON c.nn = l.id WHERE c.id NOT IN (SELECT id FROM core) GROUP BY c.id)
SELECT v.id, coalesce(l.cluster, b.cluster, -1) AS cluster, l.id IS NOT NULL AS is_core FROM vec3 v LEFT JOIN labels_core l ON v.id = l.id LEFT JOIN border b ON v.id = b.id"""

# ---- E ---------------------------------------------------------------------------------


def _class_table(source: str = "predictions") -> str:
    return f"""cls AS (SELECT label AS class FROM {source} UNION SELECT prediction FROM {source}),
    ct AS (SELECT class, (SELECT count(*) FROM {source} WHERE label = class AND prediction = class) AS tp,
      (SELECT count(*) FROM {source} WHERE label <> class AND prediction = class) AS fp,
      (SELECT count(*) FROM {source} WHERE label = class AND prediction <> class) AS fn,
      (SELECT count(*) FROM {source} WHERE label <> class AND prediction <> class) AS tn FROM cls),
    pr AS (SELECT *, tp + fn AS support, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall FROM ct),
    sc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score FROM pr)"""


def _weighted(c: str) -> str:
    return f"sum({c} * support) / sum(support)"


def _areas(source: str, score: str, positive: str = "label = 1") -> str:
    return f"""steps AS (SELECT {score} AS score, sum(CASE WHEN {positive} THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN {positive} THEN 0 ELSE 1 END) AS neg FROM {source} GROUP BY 1),
    cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS q FROM steps),
    areas AS (SELECT sum(pos * (q - fp) + pos * neg / 2.0::DOUBLE) / (max(p) * max(q))::DOUBLE AS auc_roc, sum(pos * (tp / (tp + fp)::DOUBLE)) / max(p)::DOUBLE AS auc_pr FROM cum)"""


ORACLES["e_01_evaluate"] = f"""WITH {PREDICTIONS}, {_class_table()}, {_areas('predictions', 'score')},
m AS (SELECT sum(tp) / sum(support)::DOUBLE AS accuracy, {_weighted('precision')} AS precision, {_weighted('recall')} AS recall, {_weighted('f1_score')} AS f1_score FROM sc)
SELECT 'model' AS model, {_r('accuracy')} AS accuracy, {_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1_score')} AS f1_score, {_r('auc_roc')} AS auc_roc, {_r('auc_pr')} AS auc_pr FROM m, areas"""

_SCORES_R = f"{_r('precision')} AS precision, {_r('recall')} AS recall, {_r('f1_score')} AS f1_score"
ORACLES["e_02_classification_report"] = f"""WITH {PREDICTIONS}, {_class_table()},
u AS (SELECT CAST(class AS VARCHAR) AS name, precision, recall, f1_score, support FROM sc
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support)::DOUBLE, sum(tp) / sum(support)::DOUBLE, sum(tp) / sum(support)::DOUBLE, CAST(sum(support) AS BIGINT) FROM sc
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM sc
  UNION ALL SELECT 'weighted avg', {_weighted('precision')}, {_weighted('recall')}, {_weighted('f1_score')}, CAST(sum(support) AS BIGINT) FROM sc)
SELECT name, {_SCORES_R}, support FROM u"""

_CELLS = """cl AS (SELECT label AS c FROM predictions UNION SELECT prediction FROM predictions),
cells AS (SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM predictions p WHERE p.label = a.c AND p.prediction = b.c) AS n FROM cl a CROSS JOIN cl b)"""
ORACLES["e_03_confusion_matrix"] = f"WITH {LANG_PREDICTIONS}, {_CELLS} SELECT label, prediction, n FROM cells"
ORACLES["e_08_normalised_confusion"] = f"""WITH {LANG_PREDICTIONS}, {_CELLS}
SELECT label, prediction, {_r('n / nullif(sum(n) OVER (PARTITION BY label), 0)::DOUBLE')} AS share FROM cells"""
ORACLES["e_04_per_class"] = f"""WITH {LANG_PREDICTIONS}, {_class_table()} SELECT class, {_SCORES_R}, support, tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives
FROM sc WHERE support > 0"""
_AREA_ROW = f"SELECT {_r('auc_roc')} AS auc_roc, {_r('auc_pr')} AS auc_pr FROM areas"
ORACLES["e_05_binary_areas"] = f"WITH {PREDICTIONS}, {_areas('predictions', 'score')} {_AREA_ROW}"
ORACLES["e_05_tied_scores"] = f"WITH {PREDICTIONS}, {_areas('predictions', 'round(score, 1)')} {_AREA_ROW}"
ORACLES["e_05_precision_recall_curve"] = f"""WITH {PREDICTIONS}, {_areas('predictions', 'score')}
SELECT {_r('score')} AS threshold, {_r('tp / (tp + fp)::DOUBLE')} AS precision, {_r('tp / p::DOUBLE')} AS recall FROM cum
UNION ALL SELECT NULL, 1.0, 0.0"""

_OVR = """st AS (SELECT c AS class, score, sum(CASE WHEN label = c THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = c THEN 0 ELSE 1 END) AS neg FROM probs GROUP BY c, score),
cu AS (SELECT *, sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS fp, sum(neg) OVER (PARTITION BY class) AS q, sum(pos) OVER (PARTITION BY class) AS p FROM st),
ovr AS (SELECT CAST(class AS INTEGER) AS class, CAST(max(p) AS BIGINT) AS positives, sum(pos * (q - fp) + pos * neg / 2.0::DOUBLE) / (max(p) * max(q))::DOUBLE AS auc_roc FROM cu GROUP BY class)"""
ORACLES["e_06_one_vs_rest_areas"] = f"WITH {LANG_PREDICTIONS}, {_OVR} SELECT class, positives, {_r('auc_roc')} AS auc_roc FROM ovr"
ORACLES["e_06_weighted_auc"] = f"WITH {LANG_PREDICTIONS}, {_OVR} SELECT {_r('sum(auc_roc * positives) / sum(positives)')} AS auc_roc FROM ovr"

_GUESSES = """guesses AS (SELECT 'hashed' AS model, 1 AS place, label, prediction FROM predictions UNION ALL SELECT 'all_one', 2, label, 1 FROM predictions
UNION ALL SELECT 'flipped', 3, label, 1 - prediction FROM predictions),
gc AS (SELECT g.model, g.place, c.class, count(*) FILTER (label = class AND prediction = class) AS tp, count(*) FILTER (label <> class AND prediction = class) AS fp,
  count(*) FILTER (label = class) AS support FROM guesses g CROSS JOIN (SELECT unnest([0, 1]) AS class) c GROUP BY 1, 2, 3),
gp AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0 END AS recall FROM gc),
gf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score FROM gp),
gm AS (SELECT model, place, sum(tp) / sum(support)::DOUBLE AS accuracy, sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
  sum(f1_score * support) / sum(support) AS f1_score FROM gf GROUP BY model, place)"""
ORACLES["e_07_compare_models"] = f"WITH {PREDICTIONS}, {_GUESSES} SELECT model, {_r('accuracy')} AS accuracy, {_SCORES_R}, 0.0::DOUBLE AS auc_roc FROM gm"
ORACLES["e_10_best_model"] = f"WITH {PREDICTIONS}, {_GUESSES} SELECT model, {_r('f1_score')} AS score FROM gm ORDER BY f1_score DESC, place LIMIT 1"

# ---- O, X ------------------------------------------------------------------------------

ORACLES["o_01_compat_order"] = f"""WITH {_selected()}, {_cleaned('selected')}, k AS (SELECT y, count(*) AS n FROM cleaned GROUP BY y),
t AS (SELECT CAST(sum(n) AS BIGINT) AS rows, CASE WHEN max(n) / min(n)::DOUBLE <= 1.5 THEN CAST(sum(n) AS BIGINT) ELSE count(*) * max(n) END AS grown FROM k)
SELECT rows, grown - CAST(ceil(grown * CAST(0.2 AS DOUBLE)) AS BIGINT) AS train_rows, CAST(ceil(grown * CAST(0.2 AS DOUBLE)) AS BIGINT) AS test_rows FROM t"""

ORACLES["o_03_data_steps"] = f"""WITH {_selected()}, {_cleaned('selected')},
e AS (SELECT *, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS y2_encoded, CAST(dense_rank() OVER (ORDER BY y1) - 1 AS INTEGER) AS y1_encoded FROM cleaned)
SELECT y AS y2, y1, y2_encoded, y1_encoded, count(*) AS n, CAST(sum(length(ts)) AS BIGINT) AS ts_chars, CAST(sum(length(ic)) AS BIGINT) AS ic_chars FROM e GROUP BY ALL"""

ORACLES["o_03_translated_steps"] = f"""WITH {_selected()}, l AS (SELECT id, y, interaction, summary AS given, min(y1) OVER (PARTITION BY summary) AS lang FROM selected),
tr AS (SELECT id, interaction, CASE WHEN lang = 'en' THEN given ELSE concat('<', lang, '> ', given) END AS summary FROM l),
{_cleaned('tr')} SELECT id, md5(ts) AS ts_md5, md5(ic) AS ic_md5 FROM cleaned"""

_FUSED = _cleaned("nonempty", SUMMARY_SQL, _strip("interaction", fused_registry().interaction_patterns()), filtered=False)
ORACLES["x_03_script_cleaning"] = f"""WITH {TICKETS}, {TYPED}, {NONEMPTY}, {_FUSED} SELECT id, y, md5(ts) AS ts_md5, md5(ic) AS ic_md5 FROM cleaned
WHERE y1 IN (SELECT y1 FROM cleaned GROUP BY y1 HAVING count(*) > 45)"""

ORACLES["x_06_script_selection"] = f"WITH {TICKETS}, {TYPED}, {NONEMPTY} SELECT id, y, md5(interaction) AS interaction_md5 FROM nonempty"

# ---- What holds of any fitted model -----------------------------------------------------

_FACTS = "SELECT count(*) AS n_rows, true AS known_classes, true AS sums_to_one"
for _name in ("random_forest", "gradient_boosting", "decision_tree", "xgboost", "lightgbm"):
    ORACLES[f"m_facts_{_name}"] = f"{_FACTS}, true AS likeliest, true AS beats_majority FROM embeddings"
for _name in ("logistic_regression", "mlp"):
    ORACLES[f"m_facts_{_name}"] = f"{_FACTS}, true AS likeliest FROM embeddings"
ORACLES["m_facts_svm"] = f"{_FACTS} FROM embeddings"
ORACLES["n_01_recall"] = "SELECT true AS recall_above_chance"
ORACLES["m_03_duality_gap"] = f"WITH {VEC3} SELECT true AS gap_closed, CAST(max(label) + 1 AS INTEGER) AS classes, CAST(max(len(f)) AS INTEGER) AS features FROM vec3"
ORACLES["m_09_training_loss"] = f"WITH {VEC3} SELECT true AS falls, CAST(100 * (max(label) + 1) AS INTEGER) AS trees, CAST(max(label) + 1 AS INTEGER) AS classes FROM vec3"
ORACLES["m_10_leaf_rule"] = f"WITH {VEC3} SELECT CAST(100 * (max(label) + 1) AS INTEGER) AS trees, true AS within_bound, true AS rerun_equal FROM vec3"


def all_oracles() -> dict[str, str]:
    return {**ORACLES, **vector_oracles()}
