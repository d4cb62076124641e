"""Chat formatting with layouts chosen by schema fingerprint, in DataFrame functions only.

A layout is a declarative entry: the field paths it has and how they become turns. The
fingerprint of a record is a hash of its nested field paths, so one lookup picks the mapping;
for tables the paths come from the schema, for JSON records from each record itself.

A formatted conversation is a sequence of blocks

    <|turn|>role\\ntext<|end|>\\n

Control strings inside a text (the markers above and those of common chat templates) get a
backslash after their bracket; a string that has backslashes there already gets one more, so
removing one restores every text. The loss mask names, for each block, the characters that
are trained on: the texts of assistant turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import unused

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
NEWLINE = "<|nl|>"  # stands for a line feed inside a role
CONTROL = r"(\||/?s>|/?INST\]|</?SYS>>)"
TRAINED = "assistant"

TURN = "struct<turn:bigint,role:string,text:string>"


@dataclass(frozen=True)
class Layout:
    """``paths`` lists the nested field paths; ``turns`` maps a record to an array of TURN."""

    paths: tuple[str, ...]
    turns: Callable[[Callable[[str], Column]], Column]

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def _turns(*pairs: tuple[str, Column]) -> Column:
    every = F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("turn"), F.lit(role).alias("role"), text.alias("text"))
        for n, (role, text) in enumerate(pairs)
    ])
    return every.cast(f"array<{TURN}>")


def _messages(items: Column, role: str, text: str) -> Column:
    called = {"human": "user", "gpt": "assistant", "bot": "assistant"}
    names = F.create_map(*[F.lit(x) for pair in called.items() for x in pair])
    return F.transform(items, lambda m, n: F.struct(
        n.cast("bigint").alias("turn"), F.coalesce(names[m[role]], m[role]).alias("role"),
        m[text].alias("text"))).cast(f"array<{TURN}>")


def _request(get, instruction: str, extra: str) -> Column:
    given = F.coalesce(get(extra), F.lit(""))
    return F.when(given == "", get(instruction)).otherwise(F.concat_ws("\n\n", get(instruction), given))


def _pair(asked: str, answered: str):
    return lambda get: _turns(("user", get(asked)), ("assistant", get(answered)))


def _system_pair(asked: str, answered: str):
    return lambda get: _turns(("system", get("system")), ("user", get(asked)), ("assistant", get(answered)))


#: Field paths of each layout, elements of arrays included, and how they become turns.
JSON_LAYOUTS: dict[str, Layout] = {
    "prompt-completion": Layout(("completion", "prompt"), _pair("prompt", "completion")),
    "prompt-response": Layout(("prompt", "response"), _pair("prompt", "response")),
    "system-prompt-completion": Layout(("completion", "prompt", "system"), _system_pair("prompt", "completion")),
    "system-prompt-response": Layout(("prompt", "response", "system"), _system_pair("prompt", "response")),
    "instruction": Layout(("instruction", "output"), _pair("instruction", "output")),
    "instruction-input": Layout(("input", "instruction", "output"), lambda get: _turns(
        ("user", _request(get, "instruction", "input")), ("assistant", get("output")))),
    "system-instruction": Layout(("instruction", "output", "system"), _system_pair("instruction", "output")),
    "system-instruction-input": Layout(("input", "instruction", "output", "system"), lambda get: _turns(
        ("system", get("system")), ("user", _request(get, "instruction", "input")), ("assistant", get("output")))),
    "messages": Layout(("messages", "messages.content", "messages.role"), lambda get: _messages(
        get("messages", "array<struct<role:string,content:string>>"), "role", "content")),
    "from-value": Layout(("conversations", "conversations.from", "conversations.value"), lambda get: _messages(
        get("conversations", "array<struct<from:string,value:string>>"), "from", "value")),
    "no-messages": Layout(("messages",), lambda get: F.array().cast(f"array<{TURN}>")),
    "no-conversations": Layout(("conversations",), lambda get: F.array().cast(f"array<{TURN}>")),
}
_KNOWN = sorted({path for layout in JSON_LAYOUTS.values() for path in layout.paths})
_LISTS = sorted({path.split(".")[0] for path in _KNOWN if "." in path})

#: Tables with a row for each turn: names of the conversation, position, role and text columns.
TABLE_LAYOUTS = (("conv_id", "turn", "role", "text"), ("conversation_id", "position", "role", "content"))


def fingerprint(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def known_paths(record: Column) -> Column:
    """Those field paths of a JSON record that some layout has, sorted; other fields are passed over.

    A list counts if it is empty or its elements are objects; null for what is no JSON object.
    """
    tree = F.try_parse_json(record)
    names = F.json_object_keys(F.when(F.schema_of_variant(tree).startswith("OBJECT<"), record))
    found = F.array_intersect(names, F.array(*map(F.lit, _KNOWN)))
    for name in _LISTS:
        kind = F.schema_of_variant(F.try_variant_get(tree, f"$.{name}", "variant"))
        inner = [p for p in _KNOWN if p.startswith(f"{name}.")]
        has = [F.when(kind.rlike(rf"^ARRAY<OBJECT<(?:.*, )?{p.split('.')[1]}: "), F.lit(p)) for p in inner]
        found = F.when(kind.startswith("ARRAY<OBJECT<"), F.concat(found, F.array_compact(F.array(*has)))).when(
            kind == "ARRAY<VOID>", found).otherwise(F.array_remove(found, name))
    return F.array_sort(found)


def chosen_layout(record: Column) -> Column:
    """Name of the layout of a JSON record: by the fingerprint of its known paths, else by rank.

    A record that mixes layouts gets the one with most paths, then the first in
    ``JSON_LAYOUTS``, of those whose paths it all has; null where it has none in full.
    """
    paths = known_paths(record)
    mark = F.md5(F.array_join(paths, "\n").cast("binary"))
    exact = F.create_map(*[F.lit(x) for name, layout in JSON_LAYOUTS.items() for x in (layout.fingerprint, name)])
    ranked = sorted(JSON_LAYOUTS.items(), key=lambda item: -len(item[1].paths))
    held = [F.when(F.size(F.array_except(F.array(*map(F.lit, layout.paths)), paths)) == 0, name) for name, layout in ranked]
    return F.coalesce(exact[mark], *held)


def table_turns(df: DataFrame) -> DataFrame:
    """Canonical (conv_id, turn, role, text) of a table that has a row for each turn.

    The layout is looked up by the fingerprint of the known column names; a table that has the
    names of several layouts gets the first of them. Other columns are ignored. Null role and
    null text become empty.
    """
    known = {name for layout in TABLE_LAYOUTS for name in layout}
    mark = fingerprint(known & set(df.columns))
    exact = [names for names in TABLE_LAYOUTS if fingerprint(names) == mark]
    names = next(iter([*exact, *(n for n in TABLE_LAYOUTS if set(n) <= set(df.columns))]), None)
    if names is None:
        raise ValueError(f"no layout for columns {df.columns}")
    conv, turn, role, text = (F.col(n) for n in names)
    return df.select(
        conv.alias("conv_id"), turn.cast("bigint").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def json_turns(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, layout, turn, role, text, record) of JSON records in any of the known layouts.

    Fields that no layout knows are passed over, in messages too. A record without messages keeps
    one row with null turn. So does a record of no layout and what is no JSON object, with
    null layout; ``record`` holds it as it came, and is null everywhere else.
    """
    record = F.try_parse_json(F.col(json_col))
    get = lambda name, kind="string": F.try_variant_get(record, f"$.{name}", kind)
    (layout,) = unused(df, "_layout")
    named_rows = df.withColumn(layout, chosen_layout(F.col(json_col)))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for name, entry in JSON_LAYOUTS.items():
        turns = F.when(F.col(layout) == name, entry.turns(get)).otherwise(turns)
    rows = named_rows.select(
        F.col(id_col).alias("conv_id"), F.col(layout).alias("layout"),
        F.when(F.col(layout).isNull(), F.col(json_col)).alias("record"), F.explode_outer(turns).alias("t"))
    return rows.select("conv_id", "layout", "t.turn", F.coalesce("t.role", F.lit("")).alias("role"),
                       F.coalesce("t.text", F.lit("")).alias("text"), "record")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one row for each conversation.

    ``loss`` holds (block, start, length) in code points; ``block`` counts from 0 and ``start``
    from the block's marker. Turns are ordered by turn, then role and text; rows that repeat
    stay. A conversation is one string, so the turns of one id meet in one task by nature.
    """
    role = F.regexp_replace(escape(F.col("role")), "\n", NEWLINE.replace("|", "|"))
    block = F.struct(
        F.col("turn"), F.col("role").alias("by"), F.col("text").alias("said"),
        role.alias("role"), escape(F.col("text")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(block)).alias("b"))
    head = lambda b: F.concat(F.lit(OPEN), b["role"], F.lit("\n"))
    loss = F.transform("b", lambda b, n: F.struct(
        n.alias("block"), F.char_length(head(b)).alias("start"),
        F.when(b["by"] == TRAINED, F.char_length(b["text"])).alias("length")))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("b", lambda b: F.concat(head(b), b["text"], F.lit(CLOSE))), "").alias("formatted"),
        F.filter(loss, lambda s: s["length"].isNotNull()).alias("loss"))


def read_blocks(formatted: Column) -> Column:
    """The blocks of a formatted conversation, each with its marker."""
    return F.transform(
        F.slice(F.split(formatted, r"<\|turn\|>"), 2, 2_000_000_000), lambda b: F.concat(F.lit(OPEN), b))


def read_turn(block: Column) -> Column:
    """(role, text) of a block, unescaped."""
    role = F.substring_index(F.substring(block, len(OPEN) + 1, 2_000_000_000), "\n", 1)
    start = F.char_length(role) + len(OPEN) + 2
    text = F.substring(block, start, F.char_length(block) - start + 1 - len(CLOSE))
    return F.struct(unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), unescape(text).alias("text"))


def digest(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives: turns and trained texts, hashed."""
    blocks = formatted.select("conv_id", "formatted", "loss", read_blocks(F.col("formatted")).alias("blocks"))
    turns = F.transform("blocks", read_turn)
    trained = F.transform("loss", lambda s: unescape(
        F.substring(F.element_at("blocks", s["block"] + 1), s["start"] + 1, s["length"])))
    read = blocks.select(
        "conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("blocks").cast("long").alias("n_turns"),
        F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("all"),
        F.array_join(trained, "").alias("trained"))
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("all").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digest(format_conversations(given.unionByName(probe)))


SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (
    SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\2\\\3', 'g'))
            + length(replace(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\2\\\3', 'g'),
                             chr(10), '<|nl|>')) + 17 AS chars
    FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
