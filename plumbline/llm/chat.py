"""Chat formatting by schema fingerprints; DataFrame functions only.

A record comes in any of several layouts, as typed columns or as a JSON text.
Its fingerprint is a hash of its nested field paths, taken from the table's
schema or from each JSON text; the fingerprint picks a declarative mapping that
turns the record into canonical turns (role, text). Typed columns are mapped as
they are: no row goes through JSON. Turns are then rendered with a template
whose control strings are escaped inside roles and texts, so that the rendered
text can be parsed back without loss.

Defined results
  null text or role: the empty string; empty text: a turn with an empty text
  roles: as they are; only the layout "conversations" has names of its own for them
  null turn number: before all others; equal turn numbers: by role, then text
  unparsable, unknown or null JSON records: one turn of the role "unknown" whose
  text is the record, so that nothing is lost; unknown typed columns: an error
  repeated rows: repeated turns; extra columns: ignored; no rows: no rows
  texts of any length: whole (a rendered conversation has to fit into one row)
  null conv_id: each row is a conversation of its own, whose id is null
  a table that has a conversation -1 itself: a row of its own besides the added one
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from plumbline.llm.common import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of the known chat templates all begin with < or [; the escape goes behind that first sign.
CONTROL = r"([<\[])(\||/?s>|/?INST\]|</?SYS>>)"

_SCALAR = r": (STRING|VOID|BIGINT|BOOLEAN|DOUBLE|FLOAT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT|DECIMAL\(\d+, ?\d+\))"

#: Field paths of a layout -> (how its turns are found). Each item: list path or None, role source, text path.
#: A fixed role is written as "=role".
LAYOUTS: dict[str, dict] = {
    "turn_row": {"paths": "OBJECT<role, text>", "turns": [(None, "$.role", "$.text")]},
    "prompt_completion": {"paths": "OBJECT<completion, prompt>", "turns": [(None, "=user", "$.prompt"), (None, "=assistant", "$.completion")]},
    "prompt_response": {"paths": "OBJECT<prompt, response>", "turns": [(None, "=user", "$.prompt"), (None, "=assistant", "$.response")]},
    "question_answer": {"paths": "OBJECT<answer, question>", "turns": [(None, "=user", "$.question"), (None, "=assistant", "$.answer")]},
    "instruction_output": {"paths": "OBJECT<instruction, output>", "turns": [(None, "=user", "$.instruction"), (None, "=assistant", "$.output")]},
    "instruction_input_output": {"paths": "OBJECT<input, instruction, output>", "turns": [(None, "=user", ("$.instruction", "$.input")), (None, "=assistant", "$.output")]},
    "system_prompt_response": {"paths": "OBJECT<prompt, response, system>", "turns": [(None, "=system", "$.system"), (None, "=user", "$.prompt"), (None, "=assistant", "$.response")]},
    "messages": {"paths": "OBJECT<messages: ARRAY<OBJECT<content, role>>>", "turns": [("$.messages", "role", "content")]},
    "conversations": {"paths": "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", "turns": [("$.conversations", "from", "value")], "renamed": True},
}

#: Names that a layout with "renamed" gives to the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Column) -> Column:
    return F.substring(F.sha2(paths, 256), 1, 16)


def field_paths(record: Column) -> Column:
    """The nested field paths of a JSON text, without its scalar types; null if it can't be parsed."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), _SCALAR, "")


def typed_paths(kind: DataType) -> str:
    """The nested field paths of a type, written as field_paths writes those of a JSON text."""
    if isinstance(kind, StructType):
        inner = [(f.name, typed_paths(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return "OBJECT<" + ", ".join(f"{name}: {paths}" if paths else name for name, paths in inner) + ">"
    if isinstance(kind, ArrayType):
        return f"ARRAY<{typed_paths(kind.elementType)}>"
    return ""


def layouts(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds fingerprint and layout ("unknown" where no mapping exists) to JSON records."""
    out = records.withColumn("fingerprint", fingerprint(field_paths(F.col(record))))
    name = F.lit("unknown")
    for layout, how in LAYOUTS.items():
        name = F.when(F.col("fingerprint") == fingerprint(F.lit(how["paths"])), layout).otherwise(name)
    return out.withColumn("layout", name)


def _turns_of(layout: str, get: Callable[[str, str], Column]) -> Column:
    """The turns of a record by a layout's mapping; get(path, type) is a field of the record."""
    how = LAYOUTS[layout]["turns"]

    def turn(role: Column, text: Column) -> Column:
        role = F.coalesce(role, F.lit(""))
        named = role
        for a, b in ROLES.items() if LAYOUTS[layout].get("renamed") else ():
            named = F.when(role == a, b).otherwise(named)
        return F.struct(named.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def text(path) -> Column:
        if isinstance(path, tuple):
            parts = [F.coalesce(get(p, "string"), F.lit("")) for p in path]
            return F.when(parts[1] == "", parts[0]).otherwise(F.concat(parts[0], F.lit("\n\n"), parts[1]))
        return get(path, "string")

    if how[0][0] is not None:
        at, role, content = how[0]
        return F.transform(get(at, f"array<struct<`{role}`:string,`{content}`:string>>"), lambda x: turn(x[role], x[content]))
    return F.array(*[turn(F.lit(r[1:]) if r[0] == "=" else get(r, "string"), text(t)) for _, r, t in how])


def _exploded(records: DataFrame, keys: tuple[str, ...], turns: Column) -> DataFrame:
    return records.select(*keys, F.posexplode(turns).alias("pos", "_t")).select(*keys, "pos", "_t.role", "_t.text")


def to_turns(records: DataFrame, record: str = "record", keys: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """Rows (keys..., pos, role, text) of JSON records, by the mapping that each record's fingerprint selects."""
    known = layouts(records.select(*keys, record), record).withColumn("_v", F.try_parse_json(F.col(record)))
    turns = F.array(F.struct(F.lit("unknown").alias("role"), F.coalesce(F.col(record), F.lit("")).alias("text")))
    for layout in LAYOUTS:
        turns = F.when(F.col("layout") == layout, _turns_of(layout, lambda path, kind: F.try_variant_get("_v", path, kind))).otherwise(turns)
    return _exploded(known, keys, turns)


def typed_turns(records: DataFrame, fields: tuple[str, ...], keys: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """Rows (keys..., pos, role, text) of records whose fields are typed columns, by the mapping that the schema's fingerprint selects."""
    paths = typed_paths(StructType([records.schema[f] for f in fields]))
    layout = next((name for name, how in LAYOUTS.items() if how["paths"] == paths), None)
    if layout is None:
        raise ValueError(f"no layout has the fields {paths}")
    return _exploded(records, keys, _turns_of(layout, lambda path, kind: F.col(path.removeprefix("$.")).cast(kind)))


def escape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def render(turns: DataFrame, keys: tuple[str, ...] = ("conv_id",), order: tuple[str, ...] = ("turn", "pos")) -> DataFrame:
    """One row a conversation: keys, formatted, and mask, an array over its turns of (loss_start, loss_len) in code points, from the turn's start.

    A turn is escaped and rendered in its own row; only the joining of a
    conversation's rendered turns needs them in one place. Offsets within the
    turn keep the mask linear in the number of turns. Rows with a null key
    belong to no conversation, so each stands alone, however many they are.
    """
    role, text = escape(F.col("role")), escape(F.col("text"))
    pieces = turns.select(
        *keys,
        F.struct(*order, "role", "text").alias("_o"),
        F.concat(F.lit(START), role, F.lit(SEP), text, F.lit(END)).alias("_p"),
        F.struct((F.length(role) + len(START + SEP)).alias("loss_start"), F.when(F.col("role") == "assistant", F.length(text)).otherwise(0).alias("loss_len")).alias("_m"),
    )
    piece, missing = F.struct("_o", "_p", "_m"), F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    joined = pieces.where(~missing).groupBy(*keys).agg(F.sort_array(F.collect_list(piece)).alias("_a")).unionByName(pieces.where(missing).select(*keys, F.array(piece).alias("_a")))
    return joined.select(*keys, F.array_join(F.transform("_a", lambda x: x["_p"]), "").alias("formatted"), F.transform("_a", lambda x: x["_m"]).alias("mask"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    def one(p: Column) -> Column:
        head = F.substring_index(p, SEP, 1)
        return F.struct(unescape(F.substring(head, len(START) + 1, 1 << 30)).alias("role"), unescape(F.substring(p, F.length(head) + len(SEP) + 1, F.lit(1 << 30))).alias("text"))

    pieces = F.split(formatted, r"<\|im_end\|>")
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), one)


def masked(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    pieces = F.split(formatted, r"<\|im_end\|>")
    cut = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("p"), mask.alias("m")), lambda z: unescape(F.substring(z["p"], z["m"]["loss_start"] + 1, z["m"]["loss_len"])))
    return F.array_join(cut, "")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """The turns of a table of turns (conv_id, turn, role, text): its role and text are a record of the layout turn_row."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return typed_turns(rows, ("role", "text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    nasty = "</s>[INST] ok [/INST]"
    messages = F.to_json(F.struct(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(nasty).alias("content")) for r in ("user", "assistant")]).alias("messages")))
    extra = to_turns(spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), messages.alias("record")))
    turns = turn_rows(table(spark, sf_dir, "conversations")).withColumn("added", F.lit(False)).unionByName(extra.withColumn("added", F.lit(True)))
    return digest(render(turns, ("conv_id", "added")))


def digest(rendered: DataFrame, key: str = "conv_id") -> DataFrame:
    out = rendered.select(key, F.col("formatted"), parse(F.col("formatted")).alias("_t"), masked(F.col("formatted"), F.col("mask")).alias("_l"))
    return out.select(
        key,
        F.size("_t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("_l").cast("long").alias("loss_chars"),
        F.sha2(F.col("_l"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS apart FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', -1
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', -1
), e AS (
  SELECT *, length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2', 'g')) + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2', 'g')) + 32 AS n FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id, apart
"""
