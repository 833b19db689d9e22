"""Question sets by a language model: windows, prompts, calls, parsing, rules, alignment, judging.

The model is a callable (messages, options) -> text that the caller passes in; nothing here opens a
connection by itself.
"""

from __future__ import annotations

import json
import math
import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.shipping import ship
from lexmill.functions.store import written
from lexmill.operators import gold_rules as G
from lexmill.operators.chunking import token_estimate

# ---- fixed values: names and word lists that results depend on

TYPES = ("numeric", "comparison", "procedural", "temporal", "definitional", "multi-hop", "location", "cause-effect", "verification")
WH = ("what", "which", "who", "when", "where", "why", "how", "how_many", "how_much")
FIRST_PERSON = ("me", "my", "mine", "myself", "we", "us", "our", "ours", "ourselves", "i'm", "i'd", "i'll", "i've", "we're", "we'd", "we'll", "we've")
SECOND_PERSON = ("you", "your", "yours", "yourself", "yourselves", "you're", "you'd", "you'll", "you've")
BESIDE_I = ("am", "are", "is", "was", "were", "do", "does", "did", "have", "has", "had", "can", "could", "may", "might", "must", "should", "would", "will", "shall", "need", "want", "think", "believe", "feel", "see", "understand", "expect", "prefer", "plan")
ROMAN_LEADERS = ("annex", "appendix", "article", "chapter", "figure", "part", "phase", "plan", "section", "subsection", "table", "title")
VAGUE = r"(?i)\b(?:someone|somebody|something|anyone|anybody)\b"
META = r"(?i)\b(?:according to|in|from|per) (?:the|this) (?:text|passage|document|excerpt|context|window)\b"
PASS, FAIL = ("pass", "accept", "keep", "valid", "yes"), ("fail", "reject", "invalid", "no")
SENTENCE = r"[^.!?\n]+(?:[.!?]+|\n+|\z)"

SYNTH_SYSTEM = "You write questions that the given window answers. Reply with a JSON array only."
SYNTH_USER = "Window {window_id} of {doc_name}, pages {page_start} to {page_end}.\nWrite at most {max_questions} questions in the third person, each ending with one question mark, with fields question, wh, type, answer_text and evidence (sentences of the window).\n\n{window_text}"
JUDGE_SYSTEM = "You decide whether a question and its answer meet the requirements. Reply with a JSON object: decision (pass or fail) and violations."
JUDGE_USER = "Requirements: {requirements}\nDocument {doc_name}, pages {page_start} to {page_end}.\nCandidate:\n{candidate_json}\nEvidence:\n{evidence_text}\nWindow:\n{window_text}"


# ---- windows and prompts


def windows_of(pages: list[tuple[int, str]], max_pages: int = 2, max_chars: int = 12_000, max_tokens: int = 1_800) -> list[tuple[int, int, str]]:
    """(first page, last page, text): neighbouring pages that are not blank, as long as all three budgets hold; one page too large is a window too."""
    out: list[tuple[int, int, str]] = []
    held: list[tuple[int, str]] = []
    joined = lambda own: "\n\n".join(t for _, t in own).strip("\n")

    def flush() -> None:
        if held:
            out.append((held[0][0], held[-1][0], joined(held)))
            held.clear()

    for page in pages:
        if not (page[1] or "").strip():
            continue
        text = joined([*held, page])
        if len(held) >= max_pages or len(text) > max_chars or max(len(text) // 4, 1) > max_tokens:
            flush()
        held.append(page)
    flush()
    return out


def make_windows(pages: DataFrame, **budget: int) -> DataFrame:
    """pages(doc_id, doc_name, page_num, text) -> windows. A group is a document."""
    ship(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        f = frame.sort_values("page_num")
        doc, name = f["doc_id"].iloc[0], f["doc_name"].iloc[0]
        rows = [(f"{doc}:p{a}-p{b}", doc, name, a, b, t, len(t), max(len(t) // 4, 1)) for a, b, t in windows_of(list(zip(f["page_num"], f["text"], strict=True)), **budget)]
        return pd.DataFrame(rows, columns=["window_id", "doc_id", "doc_name", "page_start", "page_end", "window_text", "char_len", "token_count"])

    return pages.groupBy("doc_id").applyInPandas(each, f"window_id string, doc_id {kinds['doc_id']}, doc_name {kinds['doc_name']}, page_start long, page_end long, window_text string, char_len long, token_count long")


def count_tokens(text: Column) -> Column:
    return token_estimate(text)


def render(template: str, **values: Column) -> Column:
    """The template with its names filled; names without a value stay as they are. Values are not searched for names."""
    parts: list[Column] = []
    for i, p in enumerate(re.split(r"\{([a-z_]+)\}", template)):
        parts.append(F.lit(p) if i % 2 == 0 else F.coalesce(values[p].cast("string"), F.lit("")) if p in values else F.lit(f"{{{p}}}"))
    return F.concat(*parts)


def cache_key(window_id: Column, prompt: Column) -> Column:
    return F.sha1(F.concat_ws("|", window_id, F.sha1(prompt)))


# ---- calls


class RetryableError(Exception):
    """A failure worth another attempt: too many requests, a server error, or a broken connection."""


def with_retry(call: Callable[[], str], attempts: int = 5, base: float = 1.6, longest: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> str:
    for n in range(attempts):
        try:
            return call()
        except RetryableError:
            if n == attempts - 1:
                raise
            sleep(min(base**n, longest))
    raise ValueError("no attempt was allowed")


def complete(prompts: DataFrame, model: Callable[[list[dict], dict], str], options: dict | None = None, cached: DataFrame | None = None) -> DataFrame:
    """prompts(window_id, system, prompt) -> (cache_key, window_id, response). Rows in ``cached`` (cache_key, response) are not asked again."""
    ship(prompts.sparkSession)
    rows = prompts.withColumn("cache_key", cache_key(F.col("window_id"), F.col("prompt")))
    known = rows.join(cached, "cache_key").select("cache_key", "window_id", "response") if cached is not None else None
    fresh = rows.join(cached, "cache_key", "left_anti") if cached is not None else rows
    opts = dict(options or {})

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            asked = [with_retry(lambda s=s, p=p: model([{"role": "system", "content": s}, {"role": "user", "content": p}], opts)) for s, p in zip(f["system"], f["prompt"], strict=True)]
            yield pd.DataFrame({"cache_key": f["cache_key"], "window_id": f["window_id"], "response": asked})

    new = fresh.select("cache_key", "window_id", "system", "prompt").mapInPandas(each, "cache_key string, window_id string, response string")
    return new if known is None else known.unionByName(new)


# ---- parsing and rules

ITEM = "array<struct<question:string,wh:string,type:string,answer_text:string,evidence:array<string>>>"


def unfenced(response: Column) -> Column:
    t = T.strip(F.coalesce(response, F.lit("")))
    return F.when(t.startswith("```") & t.endswith("```"), T.strip(F.regexp_replace(F.regexp_replace(t, "^```[a-zA-Z0-9]*", ""), "```\\z", ""))).otherwise(t)


def parse_items(responses: DataFrame) -> DataFrame:
    """(window_id, pos, item): the objects of a JSON array; anything else gives none."""
    items = F.from_json(unfenced(F.col("response")), ITEM)
    return responses.select("window_id", F.posexplode(items).alias("pos", "item")).where("item is not null")


def canonical_wh(wh: Column) -> Column:
    return F.regexp_replace(F.lower(T.strip(wh)), r"[\s-]+", "_")


def canonical_type(kind: Column) -> Column:
    return F.regexp_replace(F.lower(T.strip(kind)), r"[\s_]+", "-")


def _any_of(words: Column, own: tuple[str, ...]) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, own)))


def speaks_in_person(question: Column) -> Column:
    """First or second person: a word of either list, or ``i`` beside a verb (not behind a word that numbers follow)."""
    words = F.regexp_extract_all(F.lower(question), F.lit("[a-z]+(?:'[a-z]+)?"), F.lit(0))
    lead = F.array(*map(F.lit, BESIDE_I))
    roman = F.array(*map(F.lit, ROMAN_LEADERS))
    at = F.sequence(F.lit(0), F.size(words) - 2)
    before = lambda i: F.coalesce(F.get(words, i - 1), F.lit(""))
    beside = F.exists(at, lambda i: ((F.get(words, i + 1) == "i") & F.array_contains(lead, F.get(words, i))) | ((F.get(words, i) == "i") & F.array_contains(lead, F.get(words, i + 1)) & ~F.array_contains(roman, before(i))))
    return F.when(F.size(words) == 0, False).otherwise(_any_of(words, FIRST_PERSON + SECOND_PERSON) | F.when(F.size(words) >= 2, beside).otherwise(False))


def invalid_reason(question: Column, wh: Column, kind: Column, answer: Column, evidence: Column) -> Column:
    """The first rule an item breaks, or null. Vague subjects and mentions of the text itself are rejected too."""
    q, a = T.strip(F.coalesce(question, F.lit(""))), T.strip(F.coalesce(answer, F.lit("")))
    entries = F.coalesce(evidence, F.array().cast("array<string>"))
    return (
        F.when((q == "") | (F.length(q) > 320), "question_length").when(~q.endswith("?") | (T.count_of(q, "?") != 1), "question_mark").when(speaks_in_person(q), "person")
        .when(q.rlike(VAGUE), "vague_subject").when(q.rlike(META), "meta_reference").when(canonical_wh(F.coalesce(wh, F.lit(""))) == "", "wh").when(~canonical_type(F.coalesce(kind, F.lit(""))).isin(*TYPES), "type")
        .when((a == "") | (F.length(a) > 300), "answer_length").when((F.size(entries) == 0) | F.exists(entries, lambda e: e.isNull() | (T.strip(e) == "")), "evidence")
    )


def final_wh(wh: Column, question: Column) -> Column:
    w = canonical_wh(F.coalesce(wh, F.lit("")))
    return F.when(w.isin(*WH), w).otherwise(G.detect_wh(question))


# ---- alignment


def sentence_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in re.finditer(r"[^.!?\n]+(?:[.!?]+|\n+|$)", text or ""):
        own = m.group()
        start = m.start() + len(own) - len(own.lstrip())
        end = m.start() + len(own.rstrip())
        if start < end:
            out.append((start, end))
    return out


def _plain(text: str) -> tuple[str, list[int]]:
    """Lower case with single spaces, and where each character was."""
    out: list[str] = []
    at: list[int] = []
    for i, c in enumerate(text):
        if c.isspace():
            if out and out[-1] != " ":
                out.append(" ")
                at.append(i)
        else:
            for x in c.lower():
                out.append(x)
                at.append(i)
    if out and out[-1] == " ":
        out.pop(), at.pop()
    return "".join(out), at


def evidence_spans(evidence: list, bounds: list[tuple[int, int]], window: str) -> list[tuple[int, int]]:
    """Places of evidence in a window, by text (from the last find on, else from the start, else the first sentence that holds it) or by a sentence's number."""
    whole, at = _plain(window or "")
    out: list[tuple[int, int]] = []
    cursor = 0
    for entry in evidence:
        text = entry if isinstance(entry, str) else (entry.get("text") or entry.get("snippet") or "") if isinstance(entry, dict) else ""
        span = None
        wanted = _plain(text)[0]
        if wanted:
            i = whole.find(wanted, cursor)
            i = whole.find(wanted) if i < 0 else i
            if i >= 0:
                span = (at[i], at[i + len(wanted) - 1] + 1)
                cursor = i + len(wanted)
            else:
                span = next(((a, b) for a, b in bounds if wanted in _plain(window[a:b])[0]), None)
        elif isinstance(entry, dict) and isinstance(entry.get("index"), int) and 0 <= entry["index"] < len(bounds):
            span = bounds[entry["index"]]
        if span and span[0] < span[1] and span not in out:
            out.append(span)
    return out


def answer_span(answer: str, window: str, spans: list[tuple[int, int]]) -> tuple[int, int]:
    """The answer's first place inside the evidence, else in the window, else (-1, -1)."""
    for a, b in [*spans, (0, len(window))]:
        i = window.find(answer, a, b) if answer else -1
        if i >= 0:
            return i, i + len(answer)
    return -1, -1


def find_span(answer: str, text: str, evidence: tuple[int, int] | None = None, least: float = 92.0) -> tuple[int, int, str] | None:
    """The best alignment: exact, then ignoring case, then ignoring blanks, then similar by ``least`` percent; near the evidence, then early."""
    far = lambda m: (0 if evidence is None else min(abs(m[0] - evidence[0]), abs(m[1] - evidence[1])), m[0])
    flexible = r"\s+".join(map(re.escape, answer.split()))
    for name, pattern, flags in (("exact", re.escape(answer), 0), ("case", re.escape(answer), re.I), ("blank", flexible, re.I)):
        found = [m.span() for m in re.finditer(pattern, text, flags)] if pattern else []
        if found:
            return (*min(found, key=far), name)
    from difflib import SequenceMatcher

    n, best = len(answer), None
    for i in range(0, max(1, len(text) - n + 1)) if answer else ():
        ratio = 100 * SequenceMatcher(None, answer.lower(), text[i : i + n].lower(), autojunk=False).ratio()
        if ratio >= least and (best is None or (ratio, -far((i, i + n))[0]) > best[0]):
            best = ((ratio, -far((i, i + n))[0]), i)
    return (best[1], best[1] + n, "fuzzy") if best else None


def drop_reason(question: str, answer: str, evidence: list[str], bounds: list, spans: list) -> str | None:
    q, a = question.lower(), answer.strip().lower()
    if not a:
        return "empty_answer"
    if not bounds:
        return "no_sentence_spans"
    plain = [_plain(e)[0] for e in evidence]
    if len(plain) != len(set(plain)):
        return "duplicate_evidence"
    if not spans:
        return "evidence_alignment_failed"
    bare = a.strip(".,;:!?\"'()[]{}")
    return "answer_leak" if a in q or (bare and bare in q) else None


def process_windows(items: DataFrame, windows: DataFrame, most: int = 8, judge: Callable[[dict], tuple[bool, list[str]]] | None = None) -> DataFrame:
    """Valid items, window by window: aligned, without leaks and repeats (only kept ones count as seen), judged. Dropped ones carry their reason."""
    ship(items.sparkSession)
    rows = items.join(windows, "window_id").select("window_id", "doc_id", "doc_name", "page_start", "page_end", "window_text", "pos", "item.question", "item.wh", "item.type", "item.answer_text", "item.evidence")
    rows = rows.withColumn("invalid", invalid_reason(F.col("question"), F.col("wh"), F.col("type"), F.col("answer_text"), F.col("evidence"))).withColumn("wh", final_wh(F.col("wh"), F.col("question"))).withColumn("type", canonical_type(F.col("type")))
    d = rows.schema["doc_id"].dataType.simpleString()

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        out, asked, answered, used = [], set(), set(), 0
        for r in frame.sort_values("pos").to_dict("records"):
            reason = r["invalid"]
            start = end = -1
            if not reason and used >= most:
                reason = "over_limit"
            elif not reason:
                used += 1
                bounds = sentence_spans(r["window_text"])
                spans = evidence_spans(list(r["evidence"]), bounds, r["window_text"])
                question, answer = r["question"].strip(), r["answer_text"].strip()
                reason = drop_reason(question, answer, list(r["evidence"]), bounds, spans)
                q, a = _plain(question)[0], _plain(answer)[0]
                reason = reason or ("duplicate_question" if q in asked else "duplicate_answer" if a in answered else None)
                if not reason and judge:
                    passed, why = judge(r)
                    reason = None if passed else f"judge:{','.join(why)}"
                if not reason:
                    asked.add(q), answered.add(a)
                    start, end = answer_span(answer, r["window_text"], spans)
            out.append((r["window_id"], r["doc_id"], r["pos"], r["question"], r["wh"], r["type"], r["answer_text"], start, end, reason))
        return pd.DataFrame(out, columns=["window_id", "doc_id", "pos", "question", "wh", "type", "answer_text", "char_start", "char_end", "reason"])

    made = rows.groupBy("window_id").applyInPandas(each, f"window_id string, doc_id {d}, pos int, question string, wh string, type string, answer_text string, char_start int, char_end int, reason string")
    return made.withColumn("item_id", F.sha1(F.concat_ws("|", "window_id", "question", "answer_text")))


# ---- judge


def judge_verdict(response: Column) -> Column:
    """struct(passed, reasons, error) of a reply; objects among the violations count by their JSON text."""
    t = unfenced(response)
    decision = F.lower(F.trim(F.get_json_object(t, "$.decision")))
    listed = F.coalesce(F.get_json_object(t, "$.violations"), F.get_json_object(t, "$.reasons"), F.get_json_object(t, "$.issues"))
    many = F.filter(F.transform(F.coalesce(F.from_json(listed, "array<string>"), F.array(listed)), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    valid = F.try_parse_json(t)
    is_object = valid.isNotNull() & F.schema_of_variant(valid).startswith("OBJECT")
    passed = F.when(decision.isin(*PASS, "true"), True).when(decision.isin(*FAIL, "false"), False)
    problem = F.when(valid.isNull(), "invalid_json").when(~is_object, "invalid_payload").when(decision.isNull(), "missing_decision").when(passed.isNull(), "unknown_decision")
    reasons = F.when(problem.isNotNull(), F.array(problem)).when(~passed & (F.size(F.coalesce(many, F.array().cast("array<string>"))) == 0), F.array(F.lit("unspecified_violation"))).otherwise(F.coalesce(many, F.array().cast("array<string>")))
    return F.struct((problem.isNull() & passed).alias("passed"), reasons.alias("reasons"), problem.isNotNull().alias("error"))


def evidence_summary(window: Column, spans: Column, raw: Column) -> Column:
    """Numbered snippets: the spans' texts, else the given strings, else a fixed line."""
    numbered = lambda own: F.array_join(F.transform(own, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    texts = F.transform(spans, lambda s: F.substring(window, s["start"] + 1, s["end"] - s["start"]))
    return F.when(F.size(spans) > 0, numbered(texts)).when(F.size(raw) > 0, numbered(raw)).otherwise("No evidence was given.")


def pick_diverse(near: list[float], vectors: list[list[tuple[str, float]]], k: int, weight: float = 0.7) -> list[int]:
    """Places of k of the unit vectors, greedily: a high own score, unlike those chosen. Of equal values the first counts."""
    held: dict[str, tuple[list[int], list[float]]] = {}
    for i, v in enumerate(vectors):
        for term, w in v:
            at, of = held.setdefault(term, ([], []))
            at.append(i), of.append(w)
    terms = {t: (np.array(at), np.array(of)) for t, (at, of) in held.items()}
    own, like, chosen = np.asarray(near, dtype=float), np.zeros(len(vectors)), []
    free = np.zeros(len(vectors))
    for _ in range(min(k, len(vectors))):
        best = int(np.round(weight * own - (1 - weight) * like + free, 9).argmax())
        chosen.append(best)
        free[best] = -np.inf
        to_best = np.zeros(len(vectors))
        for term, w in vectors[best]:
            at, of = terms[term]
            to_best[at] += w * of
        np.maximum(like, to_best, out=like)
    return chosen


def wh_quota_mmr(rows: DataFrame, total: int | None = None, targets: dict[str, float] | None = None) -> DataFrame:
    """rows(key, question, about) with wh: of each class with a share, the ceil(total * share) most relevant and different ones. A question's relevance is its likeness to its own ``about``; weights are over all questions and abouts. A class is chosen from as a whole."""
    ship(rows.sparkSession)
    shares = G.WH_TARGETS if targets is None else targets
    own = written(rows.select("key", "question", "about").withColumn("wh", G.detect_wh(F.col("question"))).withColumn("_id", F.monotonically_increasing_id()), "asked")
    n = own.count() if total is None else total
    want = {k: math.ceil(n * max(v, 0.0)) for k, v in shares.items()}
    over = [r.wh for r in own.groupBy("wh").count().collect() if r.wh in want and r["count"] > want[r.wh]]  # a row per class
    texts = own.select((F.col("_id") * 2).alias("doc"), F.col("question").alias("text")).unionByName(own.select((F.col("_id") * 2 + 1).alias("doc"), F.col("about").alias("text")))
    vectors = written(G.tfidf(texts, "doc").withColumn("_id", F.floor(F.col("doc") / 2)), "weights")
    asked, about = vectors.where("doc % 2 = 0"), vectors.where("doc % 2 = 1").select("_id", "term", F.col("weight").alias("w2"))
    scored = asked.join(about, ["_id", "term"], "left").groupBy("_id").agg(F.sum(F.col("weight") * F.coalesce("w2", F.lit(0.0))).alias("near"), F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("v"))
    key = rows.schema["key"].dataType.simpleString()

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        f = frame.sort_values(["question", "key"]).reset_index(drop=True)
        v = [[(x["term"], x["weight"]) for x in own] if own is not None else [] for own in f["v"]]
        return f.loc[pick_diverse(f["near"].fillna(0.0).tolist(), v, want[f["wh"].iloc[0]]), ["key", "question", "wh"]]

    picked = own.where(F.col("wh").isin(over)).drop("about").join(scored, "_id", "left").drop("_id").groupBy("wh").applyInPandas(each, f"key {key}, question string, wh string")
    return picked.unionByName(own.where(~F.col("wh").isin(over)).select("key", "question", "wh"))


def stats(items: DataFrame) -> DataFrame:
    """(kind, name, n): kept items by class, type and document; dropped ones by reason."""
    kept = items.where("reason is null")
    count = lambda rows, kind, c: rows.groupBy(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return count(kept, "wh", "wh").unionByName(count(kept, "type", "type")).unionByName(count(kept, "doc", "doc_id")).unionByName(count(items.where("reason is not null"), "dropped", "reason"))


def stub_model(messages: list[dict], options: dict) -> str:
    """A model for tests and offline runs: it asks about the window's first sentences."""
    window = messages[-1]["content"].rpartition("\n\n")[2]
    out = []
    for k, (a, b) in enumerate(sentence_spans(window)[:3]):
        words = window[a:b].split()
        if len(words) >= 4:
            out.append({"question": f"Which word follows {words[0]} in sentence number {k + 1}?", "wh": "which", "type": "verification", "answer_text": " ".join(words[1:3]), "evidence": [window[a:b]]})
    return "```json\n" + json.dumps(out, ensure_ascii=False) + "\n```"


def synthesize(pages: DataFrame, model: Callable[[list[dict], dict], str] = stub_model, most: int = 8, judge: Callable[[dict], tuple[bool, list[str]]] | None = None, cached: DataFrame | None = None) -> DataFrame:
    """Pages to items: windows, prompts, replies, items with reasons."""
    own = make_windows(pages)
    prompt = render(SYNTH_USER, window_id=F.col("window_id"), doc_name=F.col("doc_name"), page_start=F.col("page_start"), page_end=F.col("page_end"), max_questions=F.lit(most), window_text=F.col("window_text"))
    replies = complete(own.select("window_id", F.lit(SYNTH_SYSTEM).alias("system"), prompt.alias("prompt")), model, cached=cached)
    return process_windows(parse_items(replies), own, most, judge)
