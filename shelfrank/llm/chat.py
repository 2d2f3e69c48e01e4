"""Chat formatting: typed content parts become one marked-up text with attachments and a loss mask.

Column expressions only.  A visitor is one expression per part kind; adding a kind is adding an entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.arrays import bind, blocks, cut, running

TURN = "<|turn|>"
BODY = "<|body|>"
END = "<|end|>"
BETWEEN = "<|part|>"
LOSS_ROLE = "assistant"

# Strings that mark something here or in common chat templates.  In a text they get one "~" before
# their last piece; those that already carry some get one more, so removing one undoes it exactly.
_MARK = r"(<|</|<<|<</|\[|\[/)(~*)(\||s>|SYS>>|INST\])"
_MARKED = r"(<|</|<<|<</|\[|\[/)~(~*)(\||s>|SYS>>|INST\])"

#: Tokens that one unit of an attachment stands for: an image tile, a second of audio, a document page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _MARK, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, "$1$2$3")


def text_part(text: Column) -> Column:
    """One text as an array of parts."""
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")
    )
    return F.array(part).cast(f"array<{PART}>")


def _visit(part: Column) -> Column:
    """What a part contributes: escaped text, or the placeholder of its kind."""
    attached = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    known = part["kind"].isin(*TOKENS_PER_UNIT)
    return F.when(known, attached).otherwise(F.coalesce(escape(part["text"]), F.lit("")))


def _tokens(part: Column) -> Column:
    rate = F.lit(0)
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(part["kind"] == kind, F.lit(tokens)).otherwise(rate)
    return (rate * F.coalesce(part["units"], F.lit(0))).cast("long")


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts).

    Returns conv_id, n_turns, formatted, mask (start and length in code points of each text the
    loss covers, the assistant's), attachments (kind, ref, tokens, in order of their placeholders)
    and attachment_tokens.

    Turns stand in the order of turn, null first; equal turns by role, then text, so repeated rows are
    repeated turns.  A null role counts as empty, so do null parts and texts; parts of an unknown
    kind count as text; roles are escaped as texts are.  A null conv_id is a conversation.
    An empty table gives no rows; other columns are ignored.
    """
    parts = F.coalesce(F.col("parts"), F.expr(f"cast(array() as array<{PART}>)"))
    body = F.array_join(F.transform(parts, _visit), BETWEEN)
    attached = F.transform(
        F.filter(parts, lambda p: p["kind"].isin(*TOKENS_PER_UNIT)),
        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
    )
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit(TURN), escape(role), F.lit(BODY))
    rows = messages.select("conv_id", "turn", role.alias("role"), body.alias("body"), head.alias("head"), attached.alias("attached"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "body", "head", "attached")))
    chats = rows.groupBy("conv_id").agg(turns.alias("turns"))

    def lay(at, t):
        start = at + F.length(t["head"])
        span = F.struct(start.alias("start"), F.length(t["body"]).alias("length"), (t["role"] == LOSS_ROLE).alias("loss"))
        return start + F.length(t["body"]) + len(END), span

    spans = running(F.col("turns"), F.lit(0), lay, "struct<start:int,length:int,loss:boolean>")
    mask = F.transform(
        F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    chats = chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        whole.alias("formatted"),
        mask.alias("mask"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return chats.withColumn("attachment_tokens", total)


def _plain(body: Column) -> Column:
    """The text of a body: its parts unescaped one by one, placeholders left out."""
    marks = "|".join([BETWEEN, *(f"<|{kind}|>" for kind in TOKENS_PER_UNIT)]).replace("<|", r"<\|").replace("|>", r"\|>")
    return F.array_join(F.transform(F.split(body, marks, -1), unescape), "")


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn, read back from a formatted conversation."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>", -1), 2, 1 << 30)

    def read(piece):
        both = F.split(piece, r"<\|body\|>|<\|end\|>", -1)
        return F.struct(unescape(F.element_at(both, 1)).alias("role"), _plain(F.element_at(both, 2)).alias("text"))

    return F.transform(pieces, read)


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""

    def read(parts):
        return F.transform(mask, lambda s: _plain(cut(parts, s["start"], s["length"])))

    return F.array_join(bind(blocks(formatted), read), "")
