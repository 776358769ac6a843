"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<s>" "[INST]" role flag "[/INST]" body "</s>"
    flag         := "" | "!"        ("!": the body is escaped)

No control string stands inside a role or a body. Every turn is rendered plain,
read back by the parser and compared with its source; where they differ (the
parser refuses a body that holds a control string) it is escaped, first its
control strings only, then every character that could begin one, until
what is read back is identical. A turn that cannot be brought back is an error, never a
silent change. Rendering is row by row; only putting a conversation
together groups its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
BOS, EOS, HEAD, HEAD_END = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = (BOS, EOS, HEAD, HEAD_END)
CODES = {"<": "\\l", "[": "\\b", "!": "\\x"}     # what stands for an escaped character
TURN = "struct<role:string,text:string>"


def _lit_replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(text: Column, level: int) -> Column:
    """Level 0: as it is; 1: its control strings; 2: every ``<`` and ``[``."""
    if level == 0:
        return text
    out = _lit_replace(text, "\\", "\\\\")
    for s in CONTROL if level == 1 else "<[":
        out = _lit_replace(out, s, CODES[s[0]] + s[1:])
    return out


def unescape(text: Column) -> Column:
    """The inverse of every level of ``escape`` but 0, and of ``escape_role``."""
    def part(p):
        for c, code in CODES.items():
            p = _lit_replace(p, code, c)
        return p
    plain = F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")
    return F.when(F.instr(text, "\\") > 0, plain).otherwise(text)


def escape_role(role: Column) -> Column:
    out = _lit_replace(role, "\\", "\\\\")
    for c, code in CODES.items():
        out = _lit_replace(out, c, code)
    return out


def _has_control(text: Column) -> Column:
    out = F.lit(False)
    for s in CONTROL:
        out = out | F.contains(text, F.lit(s))
    return out


def render(role: Column, text: Column, level: int) -> Column:
    flag = "!" if level else ""
    return F.concat(F.lit(BOS + HEAD), escape_role(role), F.lit(flag + HEAD_END), escape(text, level), F.lit(EOS))


def parse_turn(piece: Column) -> Column:
    """A turn without its last control string -> (role, text), null where it
    is not of the grammar."""
    head = F.substring_index(piece, HEAD_END, 1)
    body = F.substring(piece, F.length(head) + len(HEAD_END) + 1, F.length(piece))
    role = F.substring(head, F.lit(len(BOS + HEAD) + 1), F.length(head))
    flagged = F.endswith(role, F.lit("!"))
    role = F.when(flagged, F.substring(role, F.lit(1), F.length(role) - 1)).otherwise(role)
    good = (F.startswith(piece, F.lit(BOS + HEAD)) & (F.length(head) < F.length(piece))
            & ~_has_control(role) & ~_has_control(body))
    return F.when(good, F.struct(
        unescape(role).alias("role"),
        F.when(flagged, unescape(body)).otherwise(body).alias("text")).cast(TURN))


def parse(formatted: Column) -> Column:
    """A formatted conversation -> its turns, null for a turn that is not of
    the grammar; a text that does not end with a turn has a null at its end."""
    pieces = F.split(formatted, EOS, -1)
    n = F.size(pieces) - 1
    turns = F.transform(F.slice(pieces, 1, n), parse_turn)
    torn = F.array(F.lit(None).cast(TURN))
    return F.when(F.element_at(pieces, -1) == "", turns).otherwise(F.concat(turns, torn))


def render_until_identical(role: Column, text: Column) -> Column:
    """(rendered, level) at the first level whose reading equals the source."""
    same = F.struct(role.alias("role"), text.alias("text")).cast(TURN)
    tries = [render(role, text, k) for k in range(3)]
    out = F.raise_error(F.concat(F.lit("CANNOT_ROUND_TRIP: "), text)).cast("struct<rendered:string,level:int>")
    for k in reversed(range(3)):
        back = parse(tries[k])
        ok = (F.size(back) == 1) & F.coalesce(F.get(back, 0) == same, F.lit(False))
        out = F.when(ok, F.struct(tries[k].alias("rendered"), F.lit(k).alias("level"))).otherwise(out)
    return out


def format_turns(turns: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with ``rendered`` and ``level``; null roles and texts are
    rendered as empty. Columns of these names are replaced."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = turns.drop("rendered", "level")
    return d.select("*", render_until_identical(role, text).alias("__r")).select(
        *[F.col(f"`{c}`") for c in d.columns], F.col("__r.rendered").alias("rendered"),
        F.col("__r.level").alias("level"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row (conv_id, formatted, loss) per conversation: its rendered turns
    in the order of ``turn`` (nulls first; ties by role, then text) and the
    spans (start, end: code points, end exclusive) of the bodies whose role is
    ``learn``. Rows with a null conversation id are one conversation;
    repeated rows are repeated turns. An empty table gives none.

    A conversation is one record and is put together by one task.
    """
    d = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = format_turns(d)
    lead = (F.length(F.lit(BOS + HEAD + HEAD_END)) + F.length(escape_role(F.col("role")))
            + F.when(F.col("level") > 0, 1).otherwise(0))
    d = d.select("conv_id", F.struct("turn", "role", "text", "rendered", lead.alias("lead")).alias("t"))
    d = d.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def step(s, t):
        end = s["at"] + F.length(t["rendered"])
        span = F.struct((s["at"] + t["lead"]).alias("start"), (end - len(EOS)).alias("end"))
        return F.struct(end.alias("at"), F.when(t["role"] == learn, F.array_append(s["loss"], span))
                        .otherwise(s["loss"]).alias("loss"))
    out = d.select("conv_id", "t", F.array_join(F.transform("t", lambda t: t["rendered"]), "").alias("formatted"),
                   F.aggregate("t", zero, step)["loss"].alias("loss"))
    # the whole conversation must come back as well
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")).cast(TURN))
    checked = F.when(parse(F.col("formatted")) == source, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("CANNOT_ROUND_TRIP: "), F.col("formatted"))).cast("string"))
    return out.select("conv_id", checked.alias("formatted"), "loss")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) -> (conv_id, turns, learned): the parsed
    turns, and the unescaped text under the loss spans, in order."""
    def text(span):
        body = F.substring(F.col("formatted"), span["start"] + 1, span["end"] - span["start"])
        # escaped bodies follow a flag
        before = F.substring(F.col("formatted"), span["start"] - len(HEAD_END), F.lit(1))
        return F.when(before == "!", unescape(body)).otherwise(body)
    return formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                            F.array_join(F.transform("loss", text), "").alias("learned"))
