"""Operator 5: chat formatting with schema fingerprints.

Conversations come as JSON records in different layouts.  A record's fingerprint is a hash of its sorted nested
field paths (``messages[].role``); it selects a mapping, a piece of data that says where a layout keeps its
turns.  The canonical turns (role, text) go through one template, which marks every turn and escapes control
strings inside texts so that the formatted text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: The template: a turn is BEGIN, role, SEP, text, END.  These strings don't occur inside an escaped text.
BEGIN, SEP_OPEN, SEP, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: a list of messages with a role and a text field, or one field a turn.

    ``messages`` and the field names are top-level or inside messages; ``optional`` fields may be missing.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()  # (role, field), in turn order
    optional: tuple[str, ...] = ()
    messages: str = ""
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()  # names of roles in this layout and canonical ones

    def path_sets(self) -> list[frozenset[str]]:
        """Every set of nested paths that records of this layout can have."""
        if self.messages:
            m = self.messages
            return [frozenset({m}), frozenset({m, f"{m}[].{self.role}", f"{m}[].{self.text}"})]
        needed = frozenset(f for _, f in self.fields if f not in self.optional)
        sets = [needed]
        for f in self.optional:
            sets += [s | {f} for s in sets]
        return sets

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.messages:
            names = dict(self.roles)
            return [(names.get(m.get(self.role), m.get(self.role)) or "", m.get(self.text) or "") for m in record[self.messages]]
        return [(role, record[f] or "") for role, f in self.fields if f in record]


MAPPINGS = (
    Mapping("messages", messages="messages"),
    Mapping("sharegpt", messages="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("instruction", fields=(("system", "context"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("context", "input")),
)


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; list elements share the path ``[]``."""
    out: set[str] = set()
    if isinstance(value, dict):
        for k, v in value.items():
            path = f"{at}.{k}" if at else k
            out |= {path} | paths(v, path)
    elif isinstance(value, list):
        for v in value:
            out |= paths(v, at + "[]")
    return out


def fingerprint(path_set) -> str:
    return hashlib.sha256("\n".join(sorted(path_set)).encode()).hexdigest()[:16]


def by_fingerprint(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(s): m for m in mappings for s in m.path_sets()}


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """All columns and ``layout`` (fingerprint, mapping name) and ``turns``: array of (role, text).

    Records that are null, not JSON objects, or of no known fingerprint keep null turns and mapping name.
    """
    @F.pandas_udf("fingerprint string, mapping string, turns array<struct<role string, text string>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = by_fingerprint(mappings)
        for batch in batches:
            rows = []
            for raw in batch:
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                if not isinstance(value, dict):
                    rows.append((None, None, None))
                    continue
                mark = fingerprint(paths(value))
                m = known.get(mark)
                turns = [{"role": r, "text": t} for r, t in m.turns(value)] if m else None
                rows.append((mark, m.name if m else None, turns))
            yield pd.DataFrame(rows, columns=["fingerprint", "mapping", "turns"])

    out = records.withColumn("__read", read(F.col(record)))
    layout = F.struct("__read.fingerprint", "__read.mapping")
    return out.withColumns({"layout": layout, "turns": F.col("__read.turns")}).drop("__read")


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put into every control string after its first character."""
    heads = "|".join(c.replace("[", r"\[").replace("]", r"\]") for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), rf"(?=(?:{heads}))(.)", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(canonical_rows: DataFrame) -> DataFrame:
    """All columns, ``formatted`` (the text) and ``loss_spans``: (start, end) code points of assistants' texts.

    Rows without turns (null) have null text and spans, an empty list of turns an empty text without spans; repeated
    rows are formatted alike, an empty table gives an empty one.  Columns of the two new names are replaced.
    """
    turn = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(BEGIN + SEP_OPEN), escaped(t["role"]), F.lit(SEP)).alias("head"), escaped(t["text"]).alias("body")))
    out = canonical_rows.withColumn("__t", turn)
    lengths = F.transform("__t", lambda t: F.struct((t["role"] == "assistant").alias("loss"), F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body")))
    start = F.expr("named_struct('at', 0, 'out', cast(array() as array<struct<start:int,end:int>>))")

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + t["head"]
        span = F.array(F.struct(begin.alias("start"), (begin + t["body"]).alias("end")))
        return F.struct((begin + t["body"] + len(END)).alias("at"), F.when(t["loss"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    text = F.array_join(F.transform("__t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return out.withColumns({"formatted": text, "loss_spans": F.aggregate(lengths, start, step)["out"]}).drop("__t")


def read_back(text: Column) -> Column:
    """Turns (role, text) of a formatted text; none of an empty text, null of null."""
    parts = F.filter(F.split(text, END), lambda p: p != "")
    cut = F.transform(parts, lambda p: F.split(F.substring(p, len(BEGIN + SEP_OPEN) + 1, F.length(p)), r"\[/INST\]"))
    return F.transform(cut, lambda p: F.struct(unescaped(p[0]).alias("role"), unescaped(p[1]).alias("text")))


def loss_text(text: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def as_records(rows: DataFrame) -> DataFrame:
    """One JSON record per conversation from rows by turn (conv_id, turn, role, text).

    A lone pair of user and assistant becomes a prompt record (with its system turn, if that comes first),
    everything else a list of messages.  Turns go by turn, then role and text; null roles and texts count as
    empty, repeated rows stay; rows with a null conv_id make one conversation of their own.
    """
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    one = clean.groupBy("conv_id").agg(turns.alias("t")).withColumn("roles", F.array_join("t.role", ","))
    text = F.transform("t", lambda t: t["text"])
    prompt = F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("completion")))
    with_system = F.to_json(F.struct(text[0].alias("system"), F.get(text, 1).alias("prompt"), F.get(text, 2).alias("completion")))
    messages = F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    record = F.when(F.col("roles") == "user,assistant", prompt).when(F.col("roles") == "system,user,assistant", with_system).otherwise(messages)
    return one.select("conv_id", record.alias("record"))


def query(spark, sf_dir):
    """All conversations and conversation -7, formatted, then read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    out = formatted(canonical(as_records(rows.unionByName(extra)))).select("conv_id", "formatted", "loss_spans")
    out = out.withColumns({"back": read_back(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
    digest = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


_ESCAPED = "replace(x, '\\', '\\\\')"
for _c in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

ORACLE_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len(BEGIN + SEP_OPEN + SEP + END)} + length({_ESCAPED.replace('x', 'role', 1)}) + length({_ESCAPED.replace('x', 'text', 1)}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
