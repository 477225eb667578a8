"""Chat formatting from typed content parts, in DataFrame functions only.

A message is a row (conversation, turn, role, parts). A part is a struct of PART_TYPE. Each part
is visited in order and flattened: texts are copied, joined and escaped; an image, audio or document part
becomes a placeholder and an attachment record with the number of tokens it expands to.

Template: ``<|turn|>role<|body|>body<|end|>`` per message. In texts and roles ``&`` becomes
``&amp;`` and the first character of every control string becomes a character reference, so no
control string is left in them and the change can be undone.

Null text, role or parts count as empty; a null part or one of unknown type adds nothing. Rows
with the same turn are ordered by role, ``user`` first and ``assistant`` last, then by text, so
repeated rows stay; a null turn comes first. A null conversation id is a conversation of its own. Columns other
than those named are ignored. One conversation becomes one string, as its digest needs it whole:
its length is bounded by a row, 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Control strings of this template and of other common ones, none of which survives in a text.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
REFERENCES = {"<": "&lt;", "[": "&lsqb;"}
PART_TYPE = (
    "struct<kind:string,text:string,reference:string,width:int,height:int,seconds:double,pages:int>"
)
PATCH = 14
AUDIO_TOKENS_A_SECOND = 25
PAGE_TOKENS = 256


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(REFERENCES[c[0]] + c[1:]))
    return out


def unescape(text: Column) -> Column:
    for c, reference in REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(c))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            *[F.lit(None).cast(t).alias(n) for n, t in (
                ("reference", "string"), ("width", "int"), ("height", "int"),
                ("seconds", "double"), ("pages", "int"),
            )],
        )
    )


def _known(parts: Column) -> Column:
    kinds = ["text", *PLACEHOLDERS]
    parts = F.coalesce(parts, F.from_json(F.lit("[]"), f"array<{PART_TYPE}>"))
    return F.filter(parts, lambda p: F.coalesce(p["kind"].isin(kinds), F.lit(False)))


def _body(known: Column) -> Column:
    """The parts as one string. Neighbouring texts are joined before they are escaped, as a control
    string may begin in one and end in the next; texts and placeholders cannot make one together."""

    def visit(acc: Column, part: Column) -> Column:
        is_text = part["kind"] == "text"
        said = F.coalesce(part["text"], F.lit(""))
        placeholder = F.lit("")
        for kind, token in PLACEHOLDERS.items():
            placeholder = F.when(part["kind"] == kind, F.lit(token)).otherwise(placeholder)
        return F.struct(
            F.when(is_text, acc["done"]).otherwise(F.concat(acc["done"], escape(acc["run"]), placeholder)).alias("done"),
            F.when(is_text, F.concat(acc["run"], said)).otherwise(F.lit("")).alias("run"),
        )

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))
    return F.aggregate(known, start, visit, lambda acc: F.concat(acc["done"], escape(acc["run"])))


def _tokens(part: Column) -> Column:
    """Tokens an attachment expands to: image patches, sound frames or pages; at least one."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    n = (
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_A_SECOND))
        .otherwise(part["pages"].cast("long") * PAGE_TOKENS)
    )
    return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long")


def flatten_parts(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Add ``body``, ``attachments`` (kind, reference, position among the message's known parts,
    tokens) and ``attachment_tokens``."""
    known = _known(F.col(f"`{parts}`"))
    records = F.transform(
        known,
        lambda p, i: F.struct(
            p["kind"].alias("kind"),
            p["reference"].alias("reference"),
            i.cast("int").alias("position"),
            _tokens(p).alias("tokens"),
        ),
    )
    records = F.filter(records, lambda r: r["kind"] != "text")
    df = df.drop("body", "attachments", "attachment_tokens")
    return df.withColumns(
        {
            "body": _body(known),
            "attachments": records,
            "attachment_tokens": F.aggregate(
                records, F.lit(0).cast("long"), lambda total, r: total + r["tokens"]
            ),
        }
    )


def format_chat(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row a conversation: id, ``n_turns``, ``formatted``, ``loss_spans``, ``attachments``,
    ``attachment_tokens``. A loss span (start, length in code points) covers the body of a turn
    whose role is in ``trained``. An empty table gives no rows."""
    rows = flatten_parts(
        df.select(
            F.col(f"`{conversation}`").alias("conversation"),
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.col(f"`{parts}`").alias("parts"),
        )
    )
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    turns = rows.select(
        "conversation",
        F.struct(
            "turn",
            F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 2).otherwise(1).alias("place"),
            "role",
            F.concat(head, "body", F.lit(END)).alias("said"),
            F.char_length(head).alias("before"),
            F.char_length("body").alias("length"),
            F.col("role").isin(*trained).alias("trained"),
            "attachments",
            "attachment_tokens",
        ).alias("t"),
    )
    whole = turns.groupBy("conversation").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # walk over the turns: where the next one begins, and the spans so far
    zero = F.struct(
        F.lit(0).alias("at"),
        F.from_json(F.lit("[]"), "array<struct<start:int,length:int>>").alias("spans"),
    )
    walked = F.aggregate(
        F.col("t"),
        zero,
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["said"])).alias("at"),
            F.when(
                t["trained"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + t["before"]).alias("start"), t["length"].alias("length"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    return whole.select(
        F.col("conversation").alias(conversation),
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.col("t.said"), "").alias("formatted"),
        walked["spans"].alias("loss_spans"),
        F.flatten("t.attachments").alias("attachments"),
        F.aggregate("t.attachment_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias(
            "attachment_tokens"
        ),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation, unescaped.

    Placeholders stay as they are."""
    said = F.filter(F.split(formatted, f"\\Q{TURN}\\E"), lambda s: s != "")
    return F.transform(
        said,
        lambda s: F.struct(
            unescape(F.substring_index(s, BODY, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(s, BODY, -1), END, 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )
