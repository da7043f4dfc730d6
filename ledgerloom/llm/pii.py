"""Operator 10: personal data, found by regular expressions, confirmed by checksums, scored by context words.

Each kind has a proposing pattern, a validator and a score.  Kinds email, ip, card and phone are the base: a
valid match is always a span.  The other kinds are spans when their score reaches ``THRESHOLD``: a checksum
that holds adds to it, words within ``CONTEXT`` characters on either side add, words before it also take away.

Positions come from the pieces between matches: the k-th match starts after the first k pieces and k matches.
Everything is built-in expressions.  Patterns are written so that long runs of matching characters stay linear:
possessive loops, and a look-behind that lets a match start only where a run starts or the last match ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Characters on either side of a match in which context words count, and the score from which a span is reported.
CONTEXT, THRESHOLD = 60, 1.0


#: Lengths of IBANs by country: the ISO 13616 registry and the countries that use them unregistered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
#: Of exactly the country's length; after other letters as much as follows.
IBAN = "|".join([rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, c in IBAN_LENGTHS.items()] + [
    rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9])"])

#: Of a listed country, in one piece or in groups of four: beside a context word an IBAN, also when mistyped.
WRITTEN = rf"^(?:{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})(?:[A-Z0-9]+|[0-9]{{2}}(?:\x20[A-Z0-9]{{4}})+(?:\x20[A-Z0-9]{{1,3}})?)$"


@dataclass(frozen=True)
class Kind:
    name: str
    needs: str  # cheap test: texts without a match of it have no match of pattern
    pattern: str
    valid: object  # Column -> Column: the validator
    base: bool
    score: float = 0.0  # of a match whose validator fails
    checked: float = 0.0  # added when it holds
    context: str = ""  # adds 0.5 when found on either side of the match
    against: str = ""  # takes 0.5 away when found before it
    shape: str = ""  # when given, words count only for matches of it
    whole: str = ""  # when given, pattern finds starts only, and this the match at each of them


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def mod_97(match: Column) -> Column:
    """ISO 13616: the first four characters moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = F.aggregate(
        F.transform(F.split(moved, ""), lambda c: F.when(c == "", -1).otherwise(F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)),
        F.lit(0), lambda acc, v: F.when(v < 0, acc).when(v < 10, (acc * 10 + v) % 97).otherwise((acc * 100 + v) % 97))
    return value == 1


KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11}", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
         lambda m: F.when(F.length(digits(m)).between(12, 19), F.call_function("luhn_check", digits(m))).otherwise(False), True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda m: F.length(digits(m)).between(9, 15), True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}",
         mod_97, False, 0.5, 0.5, "iban|account|konto|compte|cuenta", shape=WRITTEN, whole=IBAN),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda m: ~m.rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$"), False, -1.0, 1.6,
         "ssn|social|security|tax", "order|invoice|part|serial|ref"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (start, end, match) of the leftmost, non-overlapping matches, in code points."""
    gaps = F.transform(F.split(text, kind.pattern), F.length)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # one pass over the matches carries the end of the last one
    empty = F.expr("named_struct('at', 0, 'out', cast(array() as array<struct<start:int,end:int,match:string>>))")
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    walked = F.aggregate(
        F.transform(steps, lambda s: F.struct(s["gap"].alias("gap"), s["match"].alias("match"), F.length(s["match"]).alias("n"))),
        empty,
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["n"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["n"]).alias("end"),
                                                  s["match"].alias("match")))).alias("out")))
    if not kind.whole:
        return walked["out"]

    # no match is longer than 34 characters with a blank before each, and the one after it
    def from_start(m: Column) -> Column:
        match = F.regexp_extract(F.substring(text, m["start"] + 1, F.lit(70)), f"^(?:{kind.whole})", 0)
        return F.struct(m["start"].alias("start"), (m["start"] + F.length(match)).alias("end"), match.alias("match"))

    return F.filter(F.transform(walked["out"], from_start), lambda m: m["match"] != "")


def _scored(text: Column, kind: Kind, order: int) -> Column:
    """Array of spans (start, kind, end, score, order) of one kind."""
    def span(m: Column) -> Column:
        valid = kind.valid(m["match"])
        if kind.base:
            score = F.lit(1.0)
        else:
            before = F.lower(F.substring(text, F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT))))
            after = F.lower(F.substring(text, m["end"] + 1, F.lit(CONTEXT)))
            score = F.lit(kind.score) + F.when(valid, kind.checked).otherwise(0.0)
            for words, change, sides in ((kind.context, 0.5, (before, after)), (kind.against, -0.5, (before,))):
                if words:
                    found = F.array(*[side.rlike(rf"\b(?:{words})\b") for side in sides])
                    counts = m["match"].rlike(kind.shape) if kind.shape else F.lit(True)
                    score = score + F.when(counts & F.array_contains(found, True), change).otherwise(0.0)
        return F.struct(m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), m["end"].alias("end"),
                        score.alias("score"), valid.alias("valid"))

    none = F.expr("cast(array() as array<struct<start:int,order:int,kind:string,end:int,score:double,valid:boolean>>)")
    spans = F.transform(_matches(text, kind), span)
    keep = F.filter(spans, lambda s: s["valid"] if kind.base else s["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.needs), keep).otherwise(none)


def with_spans(df: DataFrame, text_col: str = "text", to: str = "pii") -> DataFrame:
    """All columns and ``to``: array of (start, order, kind, end, score, valid), by start, then kind as in KINDS.

    Offsets are code points, ends exclusive.  Spans of different kinds may overlap.  Null and empty texts have
    none; repeated rows each get theirs.  A column already named ``to`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.concat(*[_scored(text, kind, i) for i, kind in enumerate(KINDS)])
    return df.withColumn(to, F.array_sort(found))


def redacted(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Every span of ``text_col`` replaced by its kind in brackets; overlapping spans by that of the first."""
    spans = "spans"
    while spans in df.columns:  # a name of its own beside the table's
        spans += "_"
    found = with_spans(df, text_col, spans)
    text = F.col(text_col)
    start = F.expr("named_struct('at', 0, 'out', cast(array() as array<string>))")
    walked = F.aggregate(spans, start, lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(
            F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out")),
    ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))))
    walked = F.transform(F.array(walked), lambda w: F.concat(F.array_join(w["out"], ""), F.substring(text, w["at"] + 1, F.length(text))))
    clean = F.when(F.size(spans) > 0, walked[0]).otherwise(text)
    return found.withColumn(text_col, clean).drop(spans)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda c: c == kind


def query(spark, sf_dir):
    """Counts of the base kinds, digest of the base spans, all spans, for every document."""
    docs = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter(F.col("pii")["kind"], _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return docs.select("doc_id", "pii").select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                                               _joined(F.col("pii")).alias("spans"))


def stage(spark, docs, sf_dir):
    """Documents with personal data replaced; ``n_chars`` follows the new text.  Every row and column stays; null and
    empty texts are left as they are."""
    out = redacted(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
