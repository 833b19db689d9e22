"""Operator 3: personal data, with built-in functions only.

Patterns propose spans, validators confirm them (octet range, Luhn, mod 97, digit counts), and words
near a span adjust its score. The patterns of the four base kinds are those of the contract, written
so that a text of any length takes linear time and constant stack: quantifiers are possessive where
nothing can be given back, and a match may start only where a run starts (or where the last match
ended). A pattern's matches and the text between them give the offsets, in code points, and the
characters around a span. An IBAN is looked for at every place where one may start and is as long as
its country's are; what follows it is not part of it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T

_LOCAL = "A-Za-z0-9._%+-"


class Kind(NamedTuple):
    name: str
    pattern: str
    hint: str  # a text without this pattern has no span of the kind
    valid: Callable[[Column], Column]
    score: float
    context: str  # words that raise the score
    gain: float
    needs: float  # the least score that stays
    ahead: bool = False  # the pattern consumes the first character only, group 1 has the match


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    def fits(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(m, r"\."), fits)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: F.ascii(c) - 48)
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code without blanks leaves 1 by mod 97, its first four characters last and letters as 10 to 35."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    step = lambda a, c: F.when(F.ascii(c) < 58, a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)


#: Lengths of the countries' account codes (ISO 13616).
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(" ".join(_LENGTHS.values()).split())
_FIXED = "|".join(rf"(?:{own.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, own in _LENGTHS.items())
_IBAN = rf"(?<![A-Za-z0-9])(?=((?:{_FIXED}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])))[A-Z]"


def _iban(m: Column) -> Column:
    code = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)


def _iban_of(m: Column) -> Column:
    """m, or of a country without a known length the longest part of it that ends before a blank and passes; null if none does."""
    parts = F.split(m, " ")
    cut = lambda words: F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, 1, k), " "))
    return F.get(F.filter(F.when(m.rlike(f"^(?:{_KNOWN})"), F.array(m)).otherwise(T.let(parts, cut)), _iban), 0)


BASE = (
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 0.9, r"mail|contact|write", 0.1, 0.0),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", _octets, 0.6, r"\bip\b|address|host|server", 0.3, 0.0),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9](?:[ -]?[0-9]){11}", _card, 0.8, r"card|visa|credit|account", 0.2, 0.0),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.7, r"phone|tel|call|fax|mobile", 0.2, 0.0),
)
ADDED = (
    Kind("iban", _IBAN, "[A-Z]{2}[0-9]{2}", lambda m: m.isNotNull(), 0.9, r"iban|account|bank", 0.1, 0.5, True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]", lambda m: ~F.substring(m, 1, 3).isin("000", "666"), 0.3, r"ssn|social|security|insurance", 0.4, 0.5),
)
_NEAR = 48
#: So many matches and the gaps beside them hold _NEAR characters behind any span: a match and its gap have 3 at least, 5 where an IBAN of up to 64 may start.
_PIECES = 24
_SPANS = "array<struct<start:int,kind:int,end:int,score:double>>"


def _spans(text: Column, kind: Kind, order: int) -> Column:
    """The kind's spans in text: start, kind's place, end, score."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(int(kind.ahead)))
    between = F.split(text, kind.pattern, -1)
    own = F.transform(found, lambda m: F.left(m, F.lit(1))) if kind.ahead else found
    parts = T.let(F.struct(found.alias("found"), own.alias("own"), between.alias("between")), lambda p: _placed(p, kind, order))
    return F.when(text.rlike(kind.hint), parts.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def _placed(p: Column, kind: Kind, order: int) -> Column:
    """The spans of matches (found), what the pattern consumed of each (own), and the text between (between, one more)."""
    size = lambda a: F.transform(a, lambda x: F.length(x))
    pairs = F.arrays_zip(size(p["between"]).alias("gap"), size(p["own"]).alias("own"))
    starts = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + F.coalesce(x["own"], F.lit(0))).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out")),
        lambda acc: acc["out"],
    )
    match = F.transform(p["found"], _iban_of) if kind.ahead else p["found"]
    gaps = F.transform(p["between"], lambda g: F.right(g, F.lit(_NEAR)))  # ends of gaps, for what is before a span
    heads = F.transform(p["between"], lambda g: F.left(g, F.lit(3 * _NEAR)))  # their first characters, for what is behind it
    rows = F.filter(
        F.transform(F.slice(F.arrays_zip(match.alias("m"), starts.alias("s"), p["own"].alias("own")), 1, F.size(p["found"])), lambda r, i: F.struct(r["m"].alias("m"), r["s"].alias("s"), F.length(r["own"]).alias("n"), i.alias("i"))),
        lambda r: kind.valid(r["m"]),
    )
    if kind.ahead:  # a span does not start in another
        rows = T.let(rows, lambda all_: F.filter(all_, lambda r: ~F.exists(all_, lambda o: (o["s"] < r["s"]) & (r["s"] < o["s"] + F.length(o["m"])))))
    kept = T.let(F.struct(rows.alias("rows"), gaps.alias("gaps"), heads.alias("heads"), p["own"].alias("own")), lambda b: F.filter(F.transform(b["rows"], lambda r: _scored(b, r, kind, order)), lambda x: x["score"] >= kind.needs))
    return F.when(F.size(p["found"]) > 0, kept).otherwise(F.array().cast(_SPANS))


def _scored(b: Column, r: Column, kind: Kind, order: int) -> Column:
    """A match with its score: words of the kind's context in the _NEAR characters before or behind it raise it."""
    i = r["i"]
    first = F.greatest(i - _PIECES, F.lit(0))
    join = lambda a, c: F.array_join(F.transform(F.arrays_zip(a.alias("a"), c.alias("c")), lambda x: F.concat(F.coalesce(x["a"], F.lit("")), F.coalesce(x["c"], F.lit("")))), "")
    before = F.right(join(F.slice(b["gaps"], first + 1, i - first + 1), F.slice(b["own"], first + 1, i - first)), F.lit(_NEAR))
    rest = F.concat(F.get(b["heads"], i + 1), join(F.slice(b["own"], i + 2, F.lit(_PIECES)), F.slice(b["heads"], i + 3, F.lit(_PIECES))))
    behind = F.substring(rest, F.length(r["m"]) - r["n"] + 1, F.lit(_NEAR))
    near = lambda s: F.lower(s).rlike(kind.context)
    score = F.when(near(before) | near(behind), F.lit(kind.score + kind.gain)).otherwise(F.lit(kind.score))
    return F.struct(r["s"].alias("start"), F.lit(order).alias("kind"), (r["s"] + F.length(r["m"])).alias("end"), score.alias("score"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): arrays of spans (start, kind's place in BASE + ADDED, end, score), by start, then kind.

    A null text is an empty one; it has no spans. Rows and ids may repeat, each row gives one row.
    Columns other than the two named are ignored.
    """
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    of = lambda kinds, first: F.array_sort(F.concat(*[_spans(F.col("_text"), k, first + i) for i, k in enumerate(kinds)]))
    empty = F.array().cast(_SPANS)
    some = F.col("_text").rlike("[0-9@]")
    return text.select(F.col("_id").alias(id_col), F.when(some, of(BASE, 0)).otherwise(empty).alias("base"), F.when(some, of(ADDED, len(BASE))).otherwise(empty).alias("added"))


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, base_sha256, spans (all, by start), and the highest score (null without spans)."""
    names = F.array(*[F.lit(k.name) for k in (*BASE, *ADDED)])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    both = F.array_sort(F.concat("base", "added"))
    return find(docs, id_col, text_col).select(
        id_col,
        *[_count(i).alias(f"n_{k.name}") for i, k in enumerate(BASE)],
        F.sha2(said(F.col("base")), 256).alias("base_sha256"),
        said(both).alias("spans"),
        F.round(F.array_max(F.transform(both, lambda s: s["score"])), 6).alias("top_score"),
    )
