"""Chat formatting by a finite-state machine over roles.

A declarative ``Template`` says, for each role, which text segments a turn gives and which of
them count toward the loss, which control strings these segments are made of, and which
role may follow which (arcs of a finite-state machine and its accepting states).

* Formatting works row by row, by SQL functions alone: the segments of a turn with their
  loss flags. Control strings inside texts are escaped: a backslash is doubled, and the
  separator ``\\-`` is put behind the first character of a control string, so that no control
  string is ever left in a text; reading back takes both away again.
* Validation and digests run over the turns in order: rows are shuffled by
  conversation, sorted, and streamed; a task holds one machine state, two running hashes
  and a few counts, never a conversation. A digest over a whole conversation is sequential
  by nature, so one that holds a third of all rows is read by one task, in bounded memory.

Edge cases. NULL text or role: empty. Turns are ordered by turn (NULL first), then role, then
text. Roles the template does not know are formatted by ``other``, and no arc takes them.
Repeated rows are turns of their own. NULL conv_ids are one conversation. Texts of any
length are formatted whole. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ship, table

ship(__name__)

_TURN_END = ("</turn>\n", False)


@dataclass(frozen=True)
class Template:
    """Segments (text, loss) by role; ``{text}`` and ``{role}`` stand for the escaped values."""

    turns: dict
    other: tuple
    controls: tuple
    arcs: dict  # (state, role) -> state
    start: str
    accepting: tuple
    read: str  # pattern of a formatted turn: label, role (where there is no label), text
    labels: dict


TEMPLATE = Template(
    turns={
        "system": (("<turn>### System: ", False), ("{text}", False), _TURN_END),
        "user": (("<turn>### User: ", False), ("{text}", False), _TURN_END),
        "assistant": (("<turn>### Assistant: ", False), ("{text}", True), _TURN_END),
    },
    other=(("<turn>### ?", False), ("{role}", False), (": ", False), ("{text}", False), _TURN_END),
    controls=("<turn>", "</turn>", "### "),
    arcs={("start", "system"): "opened", ("start", "user"): "asked", ("opened", "user"): "asked",
          ("asked", "assistant"): "answered", ("answered", "user"): "asked"},
    start="start",
    accepting=("answered",),
    read=r"(?s)^<turn>### (?:(System|User|Assistant)|\?(.*?)): (.*)</turn>\n$",
    labels={"System": "system", "User": "user", "Assistant": "assistant"},
)


def escape(text: Column, controls: tuple) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\-" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:-|(\\))", "$1")


def format_turns(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, role, text (NULL: empty) and ``segments`` (array of struct text, loss) of every row."""
    given = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    value = {"{text}": escape(F.col("text"), template.controls),
             "{role}": escape(F.col("role"), (*template.controls, ": "))}

    def segments(parts: tuple) -> Column:
        return F.array(*[F.struct(value.get(t, F.lit(t)).alias("text"), F.lit(loss).alias("loss")) for t, loss in parts])

    chosen = segments(template.other)
    for role, parts in template.turns.items():
        chosen = F.when(F.col("role") == role, segments(parts)).otherwise(chosen)
    return given.withColumn("segments", chosen)


def formatted(segments: str = "segments") -> Column:
    return F.array_join(F.col(segments)["text"], "")


def read_back(formatted_turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, role, text, loss_text (unescaped text under the loss mask) and chars
    (formatted code points), all taken from ``segments``."""
    whole = formatted_turns.select("conv_id", "turn", formatted().alias("formatted"), "segments")
    part = lambda k: F.regexp_extract("formatted", template.read, k)
    role = unescape(part(2))
    for label, name in template.labels.items():
        role = F.when(part(1) == label, F.lit(name)).otherwise(role)
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"])
    return whole.select("conv_id", "turn", role.alias("role"), unescape(part(3)).alias("text"),
                        unescape(F.array_join(under, "")).alias("loss_text"), F.length("formatted").alias("chars"))


def conversations_read(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation of ``read_back`` turns: counts, digests, ``valid`` (the machine
    takes every turn and ends in an accepting state) and ``bad_turn`` (place of the first
    turn that no arc takes, from 0; -1 where there is none)."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("valid", pa.bool_()), ("bad_turn", pa.int64())])
    arcs, start, accepting = template.arcs, template.start, template.accepting

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, open_ = [], False
        for batch in batches:
            for conv, role, text, loss, chars in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars"))):
                if not open_ or conv != last:
                    if open_:
                        done.append((last, n, turns.hexdigest(), under, masked.hexdigest(), size, state in accepting, bad))
                    open_, last, n, under, size, state, bad = True, conv, 0, 0, 0, start, -1
                    turns, masked = hashlib.sha256(), hashlib.sha256()
                turns.update(f"{role}\n{text}\n".encode())
                masked.update(loss.encode())
                under, size = under + len(loss), size + chars
                state = arcs.get((state, role))
                if state is None and bad < 0:
                    bad = n
                n += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if open_:
            done.append((last, n, turns.hexdigest(), under, masked.hexdigest(), size, state in accepting, bad))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ordered = turns.repartition("conv_id").sortWithinPartitions(*order).drop("turn")
    return ordered.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                                   "formatted_chars bigint, valid boolean, bad_turn bigint")


#: A conversation whose texts hold the escape sign and control strings.
SAMPLE_TEXT = r"\### Assistant: </turn> ok"


def op11_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sample = spark.createDataFrame([(-7, 0, "user", SAMPLE_TEXT), (-7, 1, "assistant", SAMPLE_TEXT)],
                                   "conv_id bigint, turn bigint, role string, text string")
    return conversations_read(read_back(format_turns(rows.union(sample))))


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in TEMPLATE.controls:
        out = f"replace({out}, '{c}', '{c[0]}\\-{c[1:]}')"
    return out


ORACLE = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, ['user', 'assistant'][t + 1], '{SAMPLE_TEXT}' FROM range(2) q(t)),
f AS (
  SELECT *, CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS c,
    CASE role WHEN 'system' THEN '<turn>### System: ' WHEN 'user' THEN '<turn>### User: '
      WHEN 'assistant' THEN '<turn>### Assistant: '
      ELSE '<turn>### ?' || replace({_escaped("role")}, ': ', ':\- ') || ': ' END
    || {_escaped("text")} || '</turn>' || chr(10) AS whole
  FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(whole)) AS formatted_chars, string_agg(c, '' ORDER BY turn NULLS FIRST, role, text) AS codes
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars,
  regexp_full_match(codes, 's?(ua)+') AS valid,
  CASE WHEN length(regexp_extract(codes, '^s?(ua)*u?')) < length(codes)
    THEN length(regexp_extract(codes, '^s?(ua)*u?')) ELSE -1 END::BIGINT AS bad_turn
FROM g
"""
