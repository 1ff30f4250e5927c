"""Chat formatting: schema fingerprints select declarative mappings to canonical turns, which a template writes.

``fingerprint`` hashes the sorted nested field paths of a record that any mapping names. Each mapping of ``MAPPINGS``
declares its paths, so its fingerprint is known beforehand, and an expression picks the mapping by the
record's fingerprint: nothing is collected from the data. Canonical turns are rows (id, turn, role, text).

The template writes a turn as one segment ``<|im_start|>role\\ntext<|im_end|>\\n``, and a conversation is the
concatenation of its segments. In roles and texts a backslash is doubled and a backslash breaks every control string
after its first character, so that no control string of this or other common templates is left and
``read_back`` restores them exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks, and the control strings that texts must not hold.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROLS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_BREAKS = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS)


class Mapping(NamedTuple):
    """How one layout becomes turns: ``paths`` it consists of, and the turns as (role, path) pairs, in order.

    A role of ``$name`` is read from that field. ``turns`` of the path ``list[].field`` run over a list.
    A text of several paths joins those that are not empty by a blank line.
    """
    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...]


MAPPINGS = [
    Mapping("prompt_response", ("prompt", "response"), (("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", ("completion", "prompt"), (("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("system_prompt_response", ("prompt", "response", "system"),
            (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question_answer", ("answer", "question"), (("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction_output", ("instruction", "output"),
            (("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction_input_output", ("input", "instruction", "output"),
            (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("messages", ("messages[].content", "messages[].role"), (("$messages[].role", ("messages[].content",)),)),
    Mapping("conversations", ("conversations[].from", "conversations[].value"),
            (("$conversations[].from", ("conversations[].value",)),)),
    Mapping("turns", ("turns[].role", "turns[].text"), (("$turns[].role", ("turns[].text",)),)),
]
# Role names of other layouts.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
NO_LAYOUT = "none"


def fingerprint(paths: tuple[str, ...] | list[str]) -> str:
    """The hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _fields(mappings: list[Mapping]) -> dict[str, set[str]]:
    """The fields under each list of the mappings; "" holds the fields outside lists."""
    found: dict[str, set[str]] = {"": set()}
    for path in {p for m in mappings for p in m.paths}:
        top, _, field = path.partition("[].")
        found.setdefault(top if field else "", set()).add(field or top)
    return found


def _schema(mappings: list[Mapping]) -> str:
    fields = _fields(mappings)
    plain = [f"`{f}` string" for f in sorted(fields[""])]
    lists = [f"`{top}` array<struct<{', '.join(f'`{f}`: string' for f in sorted(fs))}>>"
             for top, fs in sorted(fields.items()) if top]
    return ", ".join(plain + lists)


def _has(field: str):
    return lambda x: x[field].isNotNull()


def _turn(role: str, text: str):
    return lambda x: F.struct(x[role].alias("role"), x[text].alias("text"))


def _present(parsed: Column, record: Column, mappings: list[Mapping]) -> Column:
    """The paths of the mappings that the JSON record has, whether null or not."""
    fields, paths = _fields(mappings), []
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    for field in sorted(fields[""]):
        paths.append(F.when(F.array_contains(keys, field), F.lit(field)))
    for top in sorted(t for t in fields if t):
        for field in sorted(fields[top]):
            held = F.exists(parsed[top], _has(field))
            paths.append(F.when(F.coalesce(held, F.lit(False)), F.lit(f"{top}[].{field}")))
    return F.sort_array(F.filter(F.array(*paths), lambda x: x.isNotNull()))


def _turns(parsed: Column, mapping: Mapping) -> Column:
    out = []
    for role, paths in mapping.turns:
        if role.startswith("$"):
            top, _, field = role[1:].partition("[].")
            text = paths[0].partition("[].")[2]
            listed = F.transform(parsed[top], _turn(field, text))
            return F.coalesce(listed, F.array().cast("array<struct<role:string,text:string>>"))
        parts = F.filter(F.array(*[parsed[p] for p in paths]), lambda x: F.coalesce(x, F.lit("")) != "")
        out.append(F.struct(F.lit(role).alias("role"), F.array_join(parts, "\n\n").alias("text")))
    return F.array(*out)


def canonical_turns(records: DataFrame, id_column: str, record: str, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """Turns of JSON records: (id, turn, role, text, layout), one row per turn.

    Fields that no mapping names do not count. A record without a known layout, a null or malformed one among them, gives
    one row with layout ``none`` and null turn, role and text, so that nothing is lost unseen. A missing text
    is null. Repeated records give their turns as often as they come.
    """
    parsed = records.select(F.col(id_column).alias("id"), F.col(record).alias("_record"),
                            F.from_json(F.col(record), _schema(mappings)).alias("_p"))
    held = parsed.withColumn("_print", F.sha2(F.array_join(
        _present(F.col("_p"), F.col("_record"), mappings), "\n"), 256))
    layout, turns = F.lit(NO_LAYOUT), F.array().cast("array<struct<role:string,text:string>>")
    for m in mappings:
        chosen = F.col("_print") == fingerprint(m.paths)
        layout = F.when(chosen, F.lit(m.name)).otherwise(layout)
        turns = F.when(chosen, _turns(F.col("_p"), m)).otherwise(turns)
    flat = held.select("id", layout.alias("layout"), F.posexplode_outer(turns).alias("turn", "_t"))
    role = F.col("_t.role")
    for other, name in ROLE_NAMES.items():
        role = F.when(F.col("_t.role") == other, F.lit(name)).otherwise(role)
    return flat.select("id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.col("_t.text").alias("text"),
                       "layout")


def turn_rows(df: DataFrame, id_column: str) -> DataFrame:
    """A table that is laid out by turn already, recognised by the fingerprint of its field paths."""
    wanted = (id_column, "role", "text", "turn")
    if fingerprint([c for c in df.columns if c in wanted]) != fingerprint(wanted):
        raise ValueError(f"not a table of turns: {df.columns}")
    return df.select(F.col(id_column).alias("id"), F.col("turn").cast("long").alias("turn"), "role", "text",
                     F.lit("turn_rows").alias("layout"))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _BREAKS, "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """One segment per turn: (id, turn, segment, loss_start, loss_length).

    Joined in the order of the turn, an id's segments are its formatted conversation. The loss mask covers, in
    code points of the segment, the texts of assistants; other turns have the length 0. A null role or text
    counts as empty, rows without a turn number come first. Rows of equal id and turn are ordered by their segments.
    Every row is formatted where it lies; nothing is shuffled.
    """
    role = F.replace(escape(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    parts = turns.select("id", "turn", (F.col("role") == "assistant").alias("_answer"), role.alias("_role"),
                         escape(F.coalesce(F.col("text"), F.lit(""))).alias("_text"))
    answer = F.coalesce(F.col("_answer"), F.lit(False))
    return parts.select(
        "id", "turn", F.concat(F.lit(START), "_role", F.lit("\n"), "_text", F.lit(END)).alias("segment"),
        F.when(answer, F.length("_role") + len(START) + 1).otherwise(0).alias("loss_start"),
        F.when(answer, F.length("_text")).otherwise(0).alias("loss_length"))


def read_back(segments: DataFrame) -> DataFrame:
    """Parse segments into (id, turn, segment, role, text, loss_text), undoing the escapes."""
    body = r"(?s)\A<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)<\|im_end\|>\n\z"
    in_loss = F.substring(F.col("segment"), F.col("loss_start") + 1, F.col("loss_length"))
    return segments.select(
        "id", "turn", "segment", unescape(F.regexp_extract("segment", body, 1)).alias("role"),
        unescape(F.regexp_extract("segment", body, 2)).alias("text"), unescape(in_loss).alias("loss_text"))


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by conversation; only running hashes are kept, so a conversation may have any length."""
    last, state = None, None

    def row():
        n, turns, chars, loss, total, key = state
        return (key, n, turns.hexdigest(), chars, loss.hexdigest(), total)

    for batch in batches:
        out = []
        for key, segment, role, text, loss_text in zip(
                batch["id"], batch["segment"], batch["role"], batch["text"], batch["loss_text"]):
            key = None if pd.isna(key) else int(key)
            if state is None or key != last:
                if state is not None:
                    out.append(row())
                last, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, key]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[2] += len(loss_text)
            state[3].update(loss_text.encode("utf-8", "surrogatepass"))
            state[4] += len(segment)
        if out:
            yield _frame(out)
    if state is not None:
        yield _frame([row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


def conversation_digests(segments: DataFrame) -> DataFrame:
    """One row per id with digests of what ``read_back`` finds in its segments.

    The rows of an id are sorted by turn in one task, spilling as needed, and pass through running hashes.
    An empty table gives no rows.
    """
    ordered = (read_back(segments).repartition("id")
               .sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "segment"))
    return ordered.select("id", "segment", "role", "text", "loss_text").mapInPandas(_digest, DIGESTS)
