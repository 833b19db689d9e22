"""Queries over model-made question sets; the model is a stub that needs no network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import gold_rules as G
from lexmill.operators import synth as S
from lexmill.plans.gold_queries import Q_SQL, questions
from lexmill.plans.page_queries import strip_sql
from lexmill.plans.registry import query, table


@query(rf"""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?\n]+(?:[.!?]+|\n+|\z)'), lambda x: {strip_sql('x')}), lambda x: x <> '') AS s FROM documents) SELECT doc_id, len(s) AS n, md5(array_to_string(s, '|')) AS sentences_md5 FROM s""")
def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.filter(F.transform(F.regexp_extract_all("text", F.lit(S.SENTENCE), F.lit(0)), S.T.strip), lambda x: x != "")
    own = table(spark, sf_dir, "documents").select("doc_id", spans.alias("s"))
    return own.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join("s", "|")).alias("sentences_md5"))


@query("SELECT b.item_id, d.doc_id, instr(d.text, b.text) - 1 AS char_start, instr(d.text, b.text) - 1 + length(b.text) AS char_end FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def answer_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and the documents that hold them word for word; they meet on three whole words."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("answer"), F.split("text", r"\s+", -1).alias("w"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tri = lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    keyed = items.select("item_id", "answer", tri(F.lit(1)).alias("key"))  # not the first word, which can be part of one
    own = docs.select("doc_id", F.split("text", r"\s+", -1).alias("w"))
    each = own.select("doc_id", F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), tri)).alias("tri"))
    places = each.select("doc_id", F.explode_outer("tri").alias("key")).where("key is not null").join(keyed, "key").select("doc_id", "item_id", "answer").distinct()
    found = places.join(docs, "doc_id").withColumn("at", F.call_function("instr", F.col("text"), F.col("answer")) - 1).where("at >= 0")
    return found.select("item_id", "doc_id", F.col("at").cast("long").alias("char_start"), (F.col("at") + F.length("answer")).cast("long").alias("char_end"))


PERSON_SQL = f"""pw AS (SELECT conv_id, turn, regexp_extract_all(lower(question || CASE turn % 5 WHEN 1 THEN ' am i there' WHEN 2 THEN ' section i is long' WHEN 3 THEN ' for you' ELSE '' END), '[a-z]+(?:''[a-z]+)?') AS w FROM wh),
    pr AS (SELECT conv_id, turn, len(list_intersect(w, [{", ".join("'" + w.replace("'", "''") + "'" for w in S.FIRST_PERSON + S.SECOND_PERSON)}])) > 0 OR len(list_filter(range(1, len(w)), lambda i:
        (w[i + 1] = 'i' AND w[i] IN ({", ".join(f"'{w}'" for w in S.BESIDE_I)})) OR (w[i] = 'i' AND w[i + 1] IN ({", ".join(f"'{w}'" for w in S.BESIDE_I)}) AND coalesce(w[i - 1], '') NOT IN ({", ".join(f"'{w}'" for w in S.ROMAN_LEADERS)})))) > 0 AS in_person FROM pw)"""


@query(f"WITH {Q_SQL}, {PERSON_SQL} SELECT * FROM pr")
def person_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 5
    more = F.when(k == 1, " am i there").when(k == 2, " section i is long").when(k == 3, " for you").otherwise("")
    return questions(spark, sf_dir).select("conv_id", "turn", S.speaks_in_person(F.concat("question", more)).alias("in_person"))


@query(f"""WITH {Q_SQL}, v AS (SELECT conv_id, turn, question AS q, CASE turn % 4 WHEN 0 THEN 'Multi hop' WHEN 1 THEN 'numeric' WHEN 2 THEN 'cause_effect' ELSE 'other' END AS kind, text AS a, conv_id % 6 = 0 AS bare FROM wh),
    p AS (SELECT *, regexp_extract_all(lower(q), '[a-z]+(?:''[a-z]+)?') AS w FROM v)
    SELECT conv_id, turn, CASE WHEN length(trim(q)) > 320 OR trim(q) = '' THEN 'question_length' WHEN NOT ends_with(trim(q), '?') OR length(q) - length(replace(q, '?', '')) <> 1 THEN 'question_mark'
        WHEN len(list_intersect(w, [{", ".join("'" + x.replace("'", "''") + "'" for x in S.FIRST_PERSON + S.SECOND_PERSON)}])) > 0 THEN 'person' WHEN kind = 'other' THEN 'type' WHEN length(a) > 300 THEN 'answer_length' WHEN bare THEN 'evidence' END AS reason FROM p""")
def synth_json_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items through JSON: written, fenced, parsed and checked."""
    k = F.col("turn") % 4
    kind = F.when(k == 0, "Multi hop").when(k == 1, "numeric").when(k == 2, "cause_effect").otherwise("other")
    evidence = F.when(F.col("conv_id") % 6 == 0, F.array().cast("array<string>")).otherwise(F.array("text"))
    item = F.struct("question", F.lit("what").alias("wh"), kind.alias("type"), F.col("text").alias("answer_text"), evidence.alias("evidence"))
    replies = questions(spark, sf_dir).select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("window_id"), F.concat(F.lit("```json\n"), F.to_json(F.array(item)), F.lit("\n```")).alias("response"))
    rows = S.parse_items(replies)
    key = F.split("window_id", ":")
    return rows.select(F.get(key, 0).cast("long").alias("conv_id"), F.get(key, 1).cast("long").alias("turn"), S.invalid_reason(F.col("item.question"), F.col("item.wh"), F.col("item.type"), F.col("item.answer_text"), F.col("item.evidence")).alias("reason"))


@query("SELECT conv_id, turn, md5('Window ' || conv_id || ':' || turn || ' of ' || role || ', pages 1 to {page_end}.' || chr(10) || text) AS prompt_md5 FROM conversations")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    prompt = S.render("Window {window_id} of {doc_name}, pages {page_start} to {page_end}.\n{window_text}", window_id=key, doc_name=F.col("role"), page_start=F.lit(1), window_text=F.col("text"))
    return own.select("conv_id", "turn", F.md5(prompt).alias("prompt_md5"))


@query(r"SELECT event_id, regexp_replace(lower(trim(replace(event_type, 'i', ' - ') || ' ')), '[\s-]+', '_', 'g') AS wh, sha1(event_id || '|' || sha1(event_type)) AS cache_key FROM events")
def canonical_wh(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events")
    return own.select("event_id", S.canonical_wh(F.concat(F.replace("event_type", F.lit("i"), F.lit(" - ")), F.lit(" "))).alias("wh"), S.cache_key(F.col("event_id").cast("string"), F.col("event_type")).alias("cache_key"))


@query("""SELECT event_id, k IN (0, 3) AS passed, CASE k WHEN 0 THEN '' WHEN 1 THEN 'too short' WHEN 2 THEN 'unspecified_violation' WHEN 3 THEN '' WHEN 4 THEN 'unknown_decision' WHEN 5 THEN 'missing_decision' ELSE 'invalid_json' END AS reasons, k >= 4 AS error FROM (SELECT event_id, event_id % 7 AS k FROM events)""")
def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = ('{"decision": "Pass"}', '```json\n{"decision": "reject", "violations": [" too short ", ""]}\n```', '{"decision": false}', '{"decision": true, "violations": []}', '{"decision": "maybe"}', '{"verdict": 1}', "not json")
    own = table(spark, sf_dir, "events").select("event_id", S.judge_verdict(F.get(F.array(*map(F.lit, replies)), (F.col("event_id") % 7).cast("int"))).alias("v"))
    return own.select("event_id", F.coalesce("v.passed", F.lit(False)).alias("passed"), F.array_join("v.reasons", ",").alias("reasons"), "v.error")


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents, their turns as pages."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("doc_name"), (F.col("turn") + 1).cast("long").alias("page_num"), "text")


@query()
def make_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.make_windows(paged(spark, sf_dir)).select("window_id", "doc_id", "page_start", "page_end", "char_len", "token_count")


@query()
def evidence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.synthesize(paged(spark, sf_dir))
    return out.select("window_id", "pos", "question", "answer_text", "char_start", "char_end", "reason")


@query()
def synth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stats(S.synthesize(paged(spark, sf_dir)))


@query()
def wh_quota_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = questions(spark, sf_dir).select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"), "question", F.col("text").alias("about"))
    return S.wh_quota_mmr(own)


@query(f"WITH {Q_SQL} SELECT CASE WHEN wh IN ({', '.join(repr(w) for w in S.WH)}) THEN wh ELSE wh END AS wh, count(*) AS n FROM wh GROUP BY ALL")
def wh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).groupBy(G.detect_wh(F.col("question")).alias("wh")).agg(F.count(F.lit(1)).alias("n"))
