"""Chat formatting by schema fingerprints (operator 7), in Spark SQL functions only.

A record is JSON of any layout.  Its fingerprint is the hash of its nested
field paths, read off Spark's own variant schema (fields in order of name,
types and values left out).  The fingerprint selects a declarative mapping:
which path gives the system, user and assistant text, or which array holds
the messages and what their fields and roles are called.  All layouts become
the same turns, array<struct<role, text>>.

The template is ``<turn>role\\ntext</turn>\\n`` for each turn.  Inside texts
and roles the control strings are escaped and restored without loss:
``\\`` is written ``\\e``, ``<turn>`` is ``\\lturn>``, ``</turn>`` is
``\\l/turn>``; in roles a line feed is ``\\n``.  The loss mask marks spans
inside turns, (turn, start, length) in code points of the written turn.

Defined cases: a null text or role is empty; turns are in the order of their
number (null first), then role, then text; rows without an id are one
conversation; records of an unknown layout are returned by ``unmapped``; an
empty table gives no row.  A conversation is one row of output, so one
conversation must fit a row; nothing else is gathered.  Strings of any length
are read as long as the record fits a variant (128 MB); ``strict`` makes a
record that gives no turn an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

OPEN, CLOSE = "<turn>", "</turn>"
# try_parse_json gives null for a string of more characters than this
LONG_STRING = 20_000_000
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """One layout: ``paths`` are its field paths, as ``fingerprint`` sees them.

    ``parts``: (role, JSON path) for each text of a flat layout; or
    ``messages``, the path of an array, with the names of its role and text
    fields, and ``roles`` to rename.  ``role_path``: a row that is one turn.
    """

    name: str
    shape: str
    parts: tuple[tuple[str, str], ...] = ()
    messages: str | None = None
    role_field: str = "role"
    text_field: str = "content"
    role_path: str | None = None
    text_path: str | None = None
    roles: dict[str, str] = field(default_factory=dict)


SHARE_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
# Layouts in the order of their names; shapes list the fields as a variant schema does, without types.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("chosen_prompt", "{chosen,prompt,rejected}", (("user", "$.prompt"), ("assistant", "$.chosen"))),
    Mapping("conversations", "{conversations[{from,value}]}", messages="$.conversations", role_field="from",
            text_field="value", roles=SHARE_ROLES),
    Mapping("instruction", "{instruction,output}", (("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("instruction_input", "{input,instruction,output}",
            (("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Mapping("messages", "{messages[{content,role}]}", messages="$.messages"),
    Mapping("prompt_completion", "{completion,prompt}", (("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt_response", "{prompt,response}", (("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("question_answer", "{answer,question}", (("user", "$.question"), ("assistant", "$.answer"))),
    Mapping("system_prompt", "{prompt,response,system}",
            (("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("turn_row", "{role,text}", role_path="$.role", text_path="$.text"),
)


def parsed(record: str) -> Column:
    """The record as a variant, null if it is no JSON; records with very long strings as well."""
    long_ = F.from_json(record, VariantType(), {"maxStringLen": str(2 ** 31 - 1)})
    return F.coalesce(F.try_parse_json(record), F.when(F.length(record) > LONG_STRING, long_))


def shape(record: Column) -> Column:
    """Nested field paths of a variant: its schema without types."""
    s = F.schema_of_variant(record)
    s = F.regexp_replace(s, r": (?:BOOLEAN|BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT|STRING|BINARY|DATE|TIMESTAMP_NTZ|TIMESTAMP|UUID|VOID)", "")
    s = F.regexp_replace(s, r"(?:: )?OBJECT<", "{")
    s = F.regexp_replace(s, r"(?:: )?ARRAY<", "[")
    # closing marks: an array's > follows an object's or its own element
    return F.regexp_replace(F.translate(s, "> `", "}"), ", *", ",")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape(record))


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    out = F.coalesce(role, F.lit(""))
    for old, new in roles.items():
        out = F.when(role == old, new).otherwise(out)
    return out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def turns_by(m: Mapping, record: Column) -> Column:
    if m.messages:
        items = F.try_variant_get(record, m.messages, "array<variant>")
        return F.transform(items, lambda x: _turn(_renamed(F.try_variant_get(x, f"$.{m.role_field}", "string"), m.roles),
                                                  _text(x, f"$.{m.text_field}")))
    if m.role_path:
        return F.array(_turn(_renamed(F.try_variant_get(record, m.role_path, "string"), m.roles),
                             _text(record, m.text_path)))
    return F.array(*[_turn(F.lit(role), _text(record, path)) for role, path in m.parts])


def _key(written: str) -> str:
    """A mapping's shape as ``shape`` writes it: every closing mark is ``}``."""
    return written.replace("]", "}")


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds ``layout`` (null if unknown) and ``turns`` to rows with a JSON string column."""
    rows = records.withColumn("_v", parsed(record)).withColumn("_fp", fingerprint(F.col("_v")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        same = F.col("_fp") == F.xxhash64(F.lit(_key(m.shape)))
        layout = F.when(same, m.name).otherwise(layout)
        turns = F.when(same, turns_by(m, F.col("_v")).cast(TURNS)).otherwise(turns)
    return rows.withColumns({"layout": layout, "turns": turns}).drop("_v", "_fp")


def unmapped(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Records whose layout no mapping describes, with their shape."""
    return (canonical(records, record, mappings).filter("layout is null")
            .withColumn("shape", shape(parsed(record))).drop("layout", "turns"))


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\e"))
    return F.replace(F.replace(text, F.lit(CLOSE), F.lit("\\l/turn>")), F.lit(OPEN), F.lit("\\lturn>"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\e"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def formatted(records: DataFrame, conv_id: str, order: str, record: str = "record", strict: bool = False) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask; records of unknown layout give no turn
    (``strict``: an error)."""
    known = F.col("turns")
    if strict:
        known = F.coalesce(known, F.raise_error(F.concat(
            F.lit("no layout for a record of "), F.coalesce(F.length("record"), F.lit(0)).cast("string"),
            F.lit(" characters, conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast(TURNS))
    turns = (canonical(records.select(F.col(conv_id).alias("conv_id"), F.col(order).alias("_order"),
                                      F.col(record).alias("record")))
             .select("conv_id", "_order", F.posexplode(known).alias("_at", "_turn"))
             .select("conv_id", "_order", "_at", "_turn.role", "_turn.text"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = turns.select("conv_id", F.struct(
        F.col("_order").alias("n"), F.col("_at").alias("at"), "role", "text", F.concat(head, body).alias("piece"),
        F.length(head).alias("start"), F.length(body).alias("length")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    pieces = F.transform("ts", lambda t: F.concat(t["piece"], F.lit(CLOSE + "\n")))
    mask = F.filter(F.transform("ts", lambda t, i: F.when(
        t["role"] == "assistant", F.struct(i.alias("turn"), t["start"].alias("start"), t["length"].alias("length")))),
        lambda x: x.isNotNull())
    return whole.select("conv_id", F.array_join(pieces, "").alias("formatted"), mask.alias("loss_mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role and text, restored), loss_text (texts under the mask, restored), formatted_chars."""
    parts = F.split("formatted", "</turn>\n")
    pieces = F.slice(parts, 1, F.size(parts) - 1)
    rows = chats.withColumn("_p", pieces)
    inner = lambda p: p.substr(F.lit(len(OPEN) + 1), F.length(p))                       # noqa: E731
    role = lambda p: F.substring_index(inner(p), "\n", 1)                               # noqa: E731
    text = lambda p: inner(p).substr(F.length(role(p)) + 2, F.length(p))                # noqa: E731
    turns = F.transform("_p", lambda p: _turn(unescape_role(role(p)), unescape(text(p))))
    under = F.transform("loss_mask", lambda m: unescape(F.element_at(F.col("_p"), m["turn"] + 1)
                                                        .substr(m["start"] + 1, m["length"])))
    return rows.select("conv_id", turns.alias("turns"), F.array_join(under, "").alias("loss_text"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def digest(back: DataFrame) -> DataFrame:
    """The query's columns, from what was read back."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
