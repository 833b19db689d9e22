"""Queries over rule-based question sets. Pages are the documents' texts between a heading, a caption and two delimited lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.operators import gold_rules as G
from lexmill.plans.page_queries import strip_sql
from lexmill.plans.registry import query, table

PAGE_SQL = r"""page AS (SELECT doc_id AS page_num, source AS doc_id, 'Paper ' || source AS doc_name, 'OVERVIEW ' || upper(lang) || E'\n\n' || replace(text, E'\n', E'\n\n')
    || E'\n\nTable ' || (1 + doc_id % 9) || ': ' || source || E' summary\nsize: ' || (doc_id % 900) || ' gb | NASA limit; ' || (1 + doc_id % 7) || ' days' AS text FROM documents)"""
QUESTION_SQL = r"""asked AS (SELECT conv_id, turn, CASE (conv_id + turn) % 13 WHEN 0 THEN 'How many ' WHEN 1 THEN 'How much ' WHEN 2 THEN 'How ' WHEN 3 THEN 'Why ' WHEN 4 THEN 'Which ' WHEN 5 THEN 'Who ' WHEN 6 THEN 'When '
    WHEN 7 THEN 'Where ' WHEN 8 THEN 'What is ' WHEN 9 THEN 'Does ' WHEN 10 THEN 'Its ' WHEN 11 THEN 'Tell ' ELSE '' END || replace(text, E'\n', ' ') || CASE WHEN turn % 4 = 3 THEN '.' ELSE '?' END AS question, text, role FROM conversations)"""


def gold_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c, s = F.col("doc_id"), lambda x: x.cast("string"), F.lit
    text = F.concat(s("OVERVIEW "), F.upper("lang"), s("\n\n"), F.replace("text", s("\n"), s("\n\n")), s("\n\nTable "), c(1 + d % 9), s(": "), "source", s(" summary\nsize: "), c(d % 900), s(" gb | NASA limit; "), c(1 + d % 7), s(" days"))
    return table(spark, sf_dir, "documents").select(d.alias("page_num"), F.col("source").alias("doc_id"), F.concat(s("Paper "), "source").alias("doc_name"), text.alias("text"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    k = (F.col("conv_id") + F.col("turn")) % 13
    heads = ("How many ", "How much ", "How ", "Why ", "Which ", "Who ", "When ", "Where ", "What is ", "Does ", "Its ", "Tell ")
    head = F.coalesce(F.get(F.array(*map(F.lit, heads)), k.cast("int")), F.lit(""))
    q = F.concat(head, F.replace("text", F.lit("\n"), F.lit(" ")), F.when(F.col("turn") % 4 == 3, ".").otherwise("?"))
    return own.select("conv_id", "turn", q.alias("question"), "text", "role")


LINES = r"list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]'), lambda x: " + strip_sql("x") + "), lambda x: x <> '')"


@query(rf"""WITH {PAGE_SQL}, l AS (SELECT page_num, text, unnest({LINES}) AS line FROM page) SELECT page_num, line AS answer_text, string_split(line, ':')[1] AS heading, count(*) AS n
    FROM l WHERE regexp_matches(line, '(?i)^(Figure|Fig\.|Table)\s+\d+[\s:\-.]') GROUP BY ALL""")
def caption_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.captions(gold_pages(spark, sf_dir)).groupBy("page_num", "answer_text", "heading").agg(F.count(F.lit(1)).alias("n"))


KV_SQL = rf"""l AS (SELECT page_num, text, unnest({LINES}) AS line FROM page), p AS (SELECT page_num, text, list_filter(list_transform(regexp_split_to_array(line, '[:;|]'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS p FROM l WHERE contains(line, ' ') AND regexp_matches(line, '[:;|]'))"""


@query(rf"""WITH {PAGE_SQL}, {KV_SQL} SELECT page_num, 'What is ' || p[1] || '?' AS question, p[2] AS answer_text, instr(text, p[2]) - 1 AS char_start, count(*) AS n FROM p WHERE len(p) >= 2 GROUP BY ALL""")
def kv_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = G.key_values(gold_pages(spark, sf_dir))
    return rows.groupBy("page_num", "question", "answer_text", F.col("char_start").cast("long").alias("char_start")).agg(F.count(F.lit(1)).alias("n"))


METRIC_RE2 = r"(?i)\b\d{1,4}(?:\.\d+)?\s?(%|percent|days?|hours?|hrs?|mins?|ms|s|gb|mb|kb|tb|users?|items?|units?)\b"


@query(rf"WITH {PAGE_SQL}, m AS (SELECT page_num, unnest(regexp_extract_all(text, '{METRIC_RE2}')) AS answer_text FROM page) SELECT page_num, answer_text, count(*) AS n FROM m GROUP BY ALL")
def metric_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.metrics(gold_pages(spark, sf_dir)).groupBy("page_num", "answer_text").agg(F.count(F.lit(1)).alias("n"))


@query()
def definition_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.definitions(gold_pages(spark, sf_dir)).select("page_num", "question", F.md5("answer_text").alias("answer_md5"), "char_start", "char_end")


HEAD_RE2 = r"^(?:\d+(?:\.\d+)*\s+)?([A-Z][\p{L}\p{N}_\-/ ]{2,80}|[A-Z0-9][A-Z0-9\-/ ]{2,80})[:.]?$"


@query(rf"""WITH {PAGE_SQL}, l AS (SELECT page_num, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS k FROM page)
    SELECT page_num, coalesce(regexp_replace(last(line ORDER BY k) FILTER (regexp_matches(line, '{HEAD_RE2}')), '[ :.]+$', ''), '') AS heading FROM l GROUP BY page_num""")
def heading_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_pages(spark, sf_dir).select("page_num", G.nearest_heading(F.col("text"), F.length("text")).alias("heading"))


@query(rf"""WITH {PAGE_SQL}, pa AS (SELECT page_num, list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS p, text FROM page)
    SELECT page_num, 'According to ' || p[1] || ', what is described?' AS question, md5(p[2]) AS answer_md5 FROM pa WHERE length(p[2]) BETWEEN 5 AND 300""")
def next_paragraph_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading on top of each page with the paragraph behind it."""
    rows = G.heading_paragraphs(gold_pages(spark, sf_dir))
    first = rows.where("question like 'According to OVERVIEW %'").groupBy("page_num").agg(F.min(F.struct("ord", "question", "answer_text")).alias("f"))
    return first.select("page_num", "f.question", F.md5("f.answer_text").alias("answer_md5"))


WH_SQL = r"""CASE WHEN q LIKE 'how many%' THEN 'how_many' WHEN q LIKE 'how much%' THEN 'how_much' WHEN q LIKE 'how%' THEN 'how' WHEN q LIKE 'why%' THEN 'why' WHEN q LIKE 'which%' THEN 'which' WHEN q LIKE 'who%' THEN 'who'
    WHEN q LIKE 'when%' THEN 'when' WHEN q LIKE 'where%' THEN 'where' WHEN q LIKE 'what%' THEN 'what'
    WHEN regexp_extract(q, '[a-z0-9]+') IN ('do','does','did','can','could','should','would','is','are','was','were','will','has','have') THEN 'aux' ELSE 'what' END"""
Q_SQL = f"{QUESTION_SQL}, wh AS (SELECT conv_id, turn, question, text, role, q, {WH_SQL} AS wh FROM (SELECT *, lower({strip_sql('question')}) AS q FROM asked))"


@query(f"WITH {Q_SQL} SELECT conv_id, turn, wh FROM wh")
def question_wh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).select("conv_id", "turn", G.detect_wh(F.col("question")).alias("wh"))


_STOP = ", ".join(f"'{w}'" for w in G.STOPWORDS)
CONTENT = f"list_filter(regexp_extract_all(lower({{}}), '[a-z0-9]+'), lambda x: x NOT IN ({_STOP}))"
REASON_SQL = rf"""reasons AS (SELECT conv_id, turn, CASE WHEN starts_with(q, 'what is ') OR starts_with(q, 'what’s ') THEN 'banned_opening'
    WHEN regexp_extract(q, '[a-z0-9]+') IN ('it','its','they','their','this','that','these','those', '') THEN 'vague_pronoun'
    WHEN NOT (ends_with(q, '?') AND length({strip_sql('question')}) BETWEEN 8 AND 160 AND len(regexp_extract_all(q, '[^\s\pZ]+')) >= 3) THEN 'readability'
    WHEN len(list_intersect({CONTENT.format('question')}, {CONTENT.format("role || ' ' || text")})) = 0 THEN 'entity_anchor' END AS reason FROM wh)"""


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir)
    empty = F.create_map(F.lit("role"), F.col("role"))
    return own.select("conv_id", "turn", G.reject_reason(F.col("question"), F.col("text"), empty, F.lit(""), F.lit("")).alias("reason"))


@query(f"WITH {Q_SQL}, {REASON_SQL} SELECT conv_id, turn, reason FROM reasons")
def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir)


@query(f"WITH {Q_SQL}, {REASON_SQL}, c AS (SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY reason) SELECT coalesce(c.reason, b.reason) AS reason, coalesce(n, 0) AS n FROM c FULL JOIN (VALUES ('banned_opening'), ('vague_pronoun'), ('not_answerable')) b(reason) USING (reason)")
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.reject_counts(_reasons(spark, sf_dir))


@query(f"""WITH {Q_SQL}, u AS (SELECT min(question) AS question FROM (SELECT question, sha1('42|' || question) AS h, row_number() OVER (PARTITION BY lower(question) ORDER BY sha1('42|' || question)) AS k FROM wh) WHERE k = 1 GROUP BY lower(question)),
    w AS (SELECT u.question, min(wh) AS wh FROM u JOIN wh USING (question) GROUP BY u.question), r AS (SELECT *, row_number() OVER (PARTITION BY wh ORDER BY sha1('42|' || question)) AS k, count(*) OVER () AS n FROM w),
    t(wh, share) AS (VALUES ('what', 0.35::DOUBLE), ('which', 0.15::DOUBLE), ('who', 0.02::DOUBLE), ('when', 0.05::DOUBLE), ('where', 0.05::DOUBLE), ('why', 0.15::DOUBLE), ('how', 0.15::DOUBLE), ('how_many', 0.04::DOUBLE), ('how_much', 0.04::DOUBLE), ('aux', 0.05::DOUBLE))
    SELECT question, wh FROM r LEFT JOIN t USING (wh) WHERE share IS NULL OR k <= ceil(n * share)""")
def wh_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.wh_quota(questions(spark, sf_dir).select("question")).select("question", "wh")


@query(r"""WITH d AS (SELECT doc_id, CASE WHEN lang IN ('en', 'de', 'fr') THEN lang END AS tag, sha1('42|' || doc_id) AS h FROM documents), k AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY h) AS k FROM d),
    r AS (SELECT *, CASE WHEN tag = 'en' AND k <= 30 THEN 1 WHEN tag = 'de' AND k <= 25 THEN 2 WHEN tag = 'fr' AND k <= 10 THEN 3 ELSE 9 END AS place FROM k)
    SELECT doc_id FROM r ORDER BY place, h LIMIT 100""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.array("lang").alias("tags"))
    return G.stratified_sample(own, {"en": 0.3, "de": 0.25, "fr": 0.1}, 100, "doc_id").select("doc_id")


@query("WITH k AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT source AS doc_id, doc_id AS ord FROM k WHERE k <= 8 AND n >= 3")
def doc_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("ord"))
    return G.doc_caps(own, 3, 8).select("doc_id", "ord")


@query("""WITH c AS (SELECT event_id AS ord, user_id % 50 AS doc_id, event_type AS question FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(question) ORDER BY ord) AS k FROM c),
    p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS j FROM k WHERE k = 1) SELECT ord, doc_id, question FROM p WHERE j <= 3""")
def candidate_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), (F.col("user_id") % 50).alias("doc_id"), F.col("event_type").alias("question"), F.lit(1).alias("page_num"), F.lit(0).alias("char_start"), F.lit(5).alias("char_end"))
    return G.dedupe(own, 3).select("ord", "doc_id", "question")


@query("""WITH r AS (SELECT event_id AS ord, event_type AS question, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events), a AS (SELECT event_type AS question, count(*) AS n FROM events WHERE event_id % 10 = 0 GROUP BY 1)
    SELECT ord, question FROM r JOIN a USING (question) WHERE k <= n""")
def wh_target_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("question"))
    return G.wh_targets_semi(own, own.where("ord % 10 = 0")).select("ord", "question")


_WORD = r"\p{L}\p{N}_"
DEFINITION_RE2 = rf"(?i)(?:(?:^|[^{_WORD}])[{_WORD}][{_WORD}\-/ ]{{1,69}}?|[{_WORD}][\-/ ][{_WORD}\-/ ]{{1,69}}?)(?:\s+is|\s+are|\s+refers to|\s+means|\s+defined as)(?:[^{_WORD}]|$)"
TAGS_SQL = rf"""list_filter([CASE WHEN regexp_matches(a, '\b[A-Z]{{3,}}\b') THEN 'acronym' END, CASE WHEN regexp_matches(question, '(?i)^(Figure|Fig\.|Table)\s+\d+[\s:\-.]') THEN 'caption' END,
    CASE WHEN regexp_matches(a, '{DEFINITION_RE2}') THEN 'definition' END, CASE WHEN regexp_matches(lower(a), '{METRIC_RE2}') THEN 'numeric' END, CASE WHEN regexp_matches(a, '[,;:\t|]') THEN 'table' END, CASE WHEN lower(question) LIKE 'why%' OR lower(question) LIKE 'how%' THEN 'whyhow' END], lambda x: x IS NOT NULL)"""


@query(f"WITH {QUESTION_SQL}, t AS (SELECT unnest({TAGS_SQL}) AS tag FROM (SELECT question, text AS a FROM asked)) SELECT tag, count(*) AS n FROM t GROUP BY tag")
def tag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir).select(F.explode(G.tag_question(F.col("question"), F.col("text"))).alias("tag"))
    return own.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


TF_SQL = f"""dw AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents) WHERE term NOT IN ({_STOP}) GROUP BY ALL),
    idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf FROM dw GROUP BY term), raw AS (SELECT doc_id, term, tf * idf AS w FROM dw JOIN idf USING (term)),
    vec AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)"""


@query(f"WITH {TF_SQL} SELECT a.doc_id AS query_id, b.doc_id AS doc_id, round(sum(a.w * b.w), 6) AS cosine FROM vec a JOIN vec b USING (term) WHERE a.doc_id % 20 = 0 GROUP BY ALL")
def tfidf_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries, the ids divisible by 20, against all documents."""
    vectors = G.packed_tfidf(table(spark, sf_dir, "documents"), "doc_id")
    asked = vectors.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    return G.cosine(asked, vectors, "query_id", "doc_id").withColumn("cosine", F.round("cosine", 6))


SLOT_SQL = rf"""sl AS (SELECT conv_id, turn, coalesce(nullif(trim(regexp_replace(regexp_extract(question, '(?i)^which\s+([a-z0-9][\p{{L}}\p{{N}}_\- ]{{2,50}})', 1), '\s+', ' ', 'g')), ''), 'entry') AS entity_type,
    coalesce(nullif(regexp_extract(text, '\b[A-Z]{{3,}}\b'), ''), nullif(regexp_extract(question, '\b[A-Z]{{3,}}\b'), '')) AS acronym FROM asked)"""


@query(f"WITH {QUESTION_SQL}, {SLOT_SQL} SELECT * FROM sl")
def slot_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir).withColumn("s", G.slots(F.col("question"), F.col("text"), F.col("conv_id"), F.lit("doc"), F.lit(""), F.lit(""), F.lit("")))
    return own.select("conv_id", "turn", F.try_element_at("s", F.lit("entity_type")).alias("entity_type"), F.try_element_at("s", F.lit("acronym")).alias("acronym"))


@query()
def template_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir).select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.explode(F.array(F.lit("definition"), F.lit("generic"))).alias("tag"), G.slots(F.col("question"), F.col("text"), F.col("conv_id"), F.lit("doc"), F.lit(""), F.lit(""), F.lit("")).alias("slots"))
    return G.generate_questions(own, "id")


@query()
def harvest_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.harvest(gold_pages(spark, sf_dir)).select("cand_id", "doc_id", "page_num", "source_type", "char_start", "char_end", F.array_join("tags", ",").alias("tags"), F.md5("answer_text").alias("answer_md5"))


@query()
def mmr_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir).select("conv_id", "question", F.first("text").over(Window.partitionBy("conv_id").orderBy("turn")).alias("about"))
    return G.mmr_select(own, "conv_id", 3)


@query()
def extract_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.extract(gold_pages(spark, sf_dir)).select("cand_id", "doc_id", "page_num", "question", "wh", "place")


@query()
def assemble_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = gold_pages(spark, sf_dir)
    chunks = pages.select(F.col("page_num").cast("string").alias("chunk_id"), "doc_id", F.col("page_num").alias("page_start"), "text")
    rows = G.assemble(G.harvest(pages), chunks=chunks, pages=pages)
    return rows.select("gold_id", "doc_id", "page_num", "question", "char_start", "char_end", F.array_join("tags", ",").alias("tags"), F.array_join("hard_negative_ids", ",").alias("hard_negatives"))


@query()
def paraphrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested candidates, each question standing for itself."""
    pages = gold_pages(spark, sf_dir)
    accepted, _ = G.paraphrase(G.harvest(pages), targets=G.WH_TARGETS, pages=pages)
    return accepted.select("cand_id", "doc_id", "page_num", "question", "wh", F.array_join("tags", ",").alias("tags"))


@query()
def paraphrase_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = gold_pages(spark, sf_dir)
    return G.paraphrase_stats(*G.paraphrase(G.harvest(pages), pages=pages))


@query(r"""WITH c AS (SELECT doc_id, lang, text FROM documents WHERE length(text) BETWEEN 5 AND 300) SELECT doc_id, length(text) AS n FROM c""")
def filter_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.length("text").between(*G.ANSWER_CHARS)).select("doc_id", F.length("text").cast("long").alias("n"))


@query(rf"WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, E'\n', E'\n\n'), '\n\s*\n'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS p FROM documents) SELECT doc_id, len(p) AS paragraphs, length(p[1]) AS first_chars FROM p")
def paragraph_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", G.paragraph_spans(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("p"))
    return own.select("doc_id", F.size("p").cast("long").alias("paragraphs"), F.length(F.try_element_at("p", F.lit(1))["text"]).cast("long").alias("first_chars"))


