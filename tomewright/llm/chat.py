"""Chat formatting: a finite-state machine over roles validates the order of turns and emits text segments with
loss flags from a declarative template.

Turns are dealt by conversation and sorted inside a partition; the machine streams over the sorted rows with the
state of one conversation, so neither a conversation nor a partition is ever held in memory. Each turn becomes one
segment row; ``conversations`` joins the segments of a conversation for output, ``digests`` reads them back with the
parser and hashes them as they come.

Escaping: inside a text each backslash is doubled, and each control string gets a backslash after its first
character. Control strings can't then occur inside a text, and dropping one backslash per pair restores it.

Defined cases: null role or text is the empty string; rows of one conversation are ordered by turn (null first), role,
text, so ties and repeated rows have a fixed order and repeated rows are turns of their own; roles without a template
get the generic frame, which carries the role; a null conversation id is one conversation; an order that the machine
rejects is still formatted, with ``valid`` false; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import read

# role: (opening, closing, whether the loss counts the text)
TEMPLATE: dict[str, tuple[str, str, bool]] = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
    "user": ("<s>[INST] ", " [/INST]", False),
    "assistant": (" <<ANSWER>>", "</s>\n", True),
}
GENERIC = ("<<ROLE>>", "<<SAYS>>", "<</ROLE>>\n")
# Fixed: what a template may use to mark turns.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ANSWER>>", "<<ROLE>>", "<<SAYS>>", "<</ROLE>>")
# state: {role: next state}; a state in which a conversation may end is in ENDS
MACHINE: dict[str, dict[str, str]] = {
    "start": {"system": "told", "user": "asked"},
    "told": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
ENDS = {"answered"}

_SPECIAL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text under the loss starts and ends (0, 0: nowhere)."""
    if role in TEMPLATE:
        opening, closing, loss = TEMPLATE[role]
    else:
        opening, closing, loss = GENERIC[0] + escape(role) + GENERIC[1], GENERIC[2], False
    body = escape(text)
    return opening + body + closing, len(opening) * loss, (len(opening) + len(body)) * loss


_FRAMES = re.compile(
    "|".join(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b, _) in TEMPLATE.items())
    + f"|{re.escape(GENERIC[0])}(?P<_role>.*?){re.escape(GENERIC[1])}(?P<_text>.*?){re.escape(GENERIC[2])}",
    re.DOTALL,
)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read from formatted text alone."""
    out = []
    for m in _FRAMES.finditer(formatted):
        kind = m.lastgroup
        if kind == "_text":
            out.append((unescape(m["_role"]), unescape(m["_text"])))
        else:
            out.append((kind, unescape(m[kind])))
    return out


def segments(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each turn, sorted by conversation inside partitions: conv_id, position, role, segment, loss_start,
    loss_end, accepted (by the machine), may_end (the conversation could end here)."""
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = object()
        state, position = "start", 0
        for batch in batches:
            ids, roles, texts = (c.to_pylist() for c in batch.columns)
            out: list[tuple] = []
            for c, r, x in zip(ids, roles, texts, strict=True):
                if c != current:
                    current, state, position = c, "start", 0
                following = MACHINE.get(state, {}).get(r)
                accepted = following is not None
                state = following or ("answered" if r == "assistant" else "asked" if r == "user" else state)
                made, start, end = segment(r, x)
                out.append((position, made, start, end, accepted, state in ENDS))
                position += 1
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["conv_id", "role", "position", "segment", "loss_start", "loss_end", "accepted", "may_end"])

    return dealt.mapInArrow(run, "conv_id long, role string, position long, segment string, loss_start long, loss_end long, accepted boolean, may_end boolean")


def conversations(turns: DataFrame, **names: str) -> DataFrame:
    """conv_id, formatted (the whole conversation), valid. Output rows are conversations, so each must fit one row."""
    made = segments(turns, **names).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("position", "segment"))).alias("s"), F.min("accepted").alias("ok"), F.max_by("may_end", "position").alias("end"))
    return made.select("conv_id", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"), (F.col("ok") & F.col("end")).alias("valid"))


def digests(made: DataFrame) -> DataFrame:
    """Of ``segments``: a row for each conversation, read back from the segments with the parser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> tuple:
            return current, n, told.hexdigest(), chars, learned.hexdigest(), length, valid and end

        current, begun = None, False
        n = chars = length = 0
        valid = end = True
        told, learned = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            done = []
            for c, s, a, b, ok, may_end in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "segment", "loss_start", "loss_end", "accepted", "may_end")), strict=True):
                if not begun or c != current:
                    if begun:
                        done.append(close())
                    current, begun, valid, end, n, chars, length, told, learned = c, True, True, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, text in parse(s):
                    n += 1
                    told.update(f"{role}\n{text}\n".encode())
                loss = unescape(s[a:b])
                chars += len(loss)
                learned.update(loss.encode())
                length += len(s)
                valid, end = valid and ok, may_end
            yield batch_of(done)
        if begun:
            yield batch_of([close()])

    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return made.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


PROBE = "</s>[INST] ok [/INST]"


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(segments(turns.unionByName(probe)))


def _sql_escape(x: str) -> str:
    out = f"replace({x}, chr(92), chr(92) || chr(92))"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return out


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), e AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS following,
    length({_sql_escape("text")}) + CASE role {" ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b, _) in TEMPLATE.items())}
      ELSE {sum(map(len, GENERIC))} + length({_sql_escape("role")}) END AS size
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
    WHEN 'assistant' THEN before IS NOT DISTINCT FROM 'user' ELSE false END)
    AND bool_or(following IS NULL AND role = 'assistant') AS valid
FROM e GROUP BY conv_id
"""
