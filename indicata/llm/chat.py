"""Chat formatting with a grammar round trip (native DataFrame functions only).

Template (control strings are the fixed values in ``MARKS``)::

    conversation = turn*
    turn  = open pad body " " close
    pad   = " "   body is the text as it is
          | "\\"   body is the text escaped

A turn of a role without marks of its own uses ``[ROLE]`` / ``[/ROLE]`` and
carries the escaped role name and a line feed in front of its text.

The parser is deterministic: the output is cut at every control string, and
a well-formed conversation is then a run of (open, pad body pad, close)
triples.  Each turn is rendered as it is, reparsed, and compared with its
source; a turn that does not come back identical (its text holds a control
string) is escaped instead: ``\\`` becomes ``\\b``, ``<`` becomes ``\\l``, ``[``
becomes ``\\q``.  Every control string starts with ``<`` or ``[``, so an escaped
text holds none, and no text holds one unescaped.  The whole conversation is
then reparsed and compared once more; a difference raises an error.

A conversation is one row of the result, so its text has to fit in a row
(2 GB); turns are never dropped or cut.

Defined cases: null text and null role count as empty strings; rows of a
null ``conv_id`` form one conversation; rows sharing a turn number are
ordered by role, then text, and repeated rows stay; an empty table gives an
empty result; columns other than the four named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Open and close control strings per role.
MARKS = {
    "user": ("[INST]", "[/INST]"),
    "system": ("<<SYS>>", "<</SYS>>"),
    "assistant": ("<s>", "</s>"),
}
OTHER = ("[ROLE]", "[/ROLE]")
# Fixed value: the control strings as one pattern.
CONTROL = r"\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<s>|</s>|\[ROLE\]|\[/ROLE\]"
RAW, ESCAPED = " ", "\\"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit("["), F.lit("\\q"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\q"), F.lit("["))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _by_role(role: Column, pick: int) -> Column:
    out = None
    for name, marks in MARKS.items():
        out = (F if out is None else out).when(role == name, F.lit(marks[pick]))
    return out.otherwise(F.lit(OTHER[pick]))


def render_turn(role: Column, text: Column, escaped: bool) -> Column:
    """One turn; the role name of an unmarked role is always escaped, which
    also doubles as its separator (an escaped name holds no line feed)."""
    name = F.when(role.isin(*MARKS), F.lit("")).otherwise(
        F.concat(F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n")))
    body = escape(text) if escaped else text
    pad = ESCAPED if escaped else RAW
    return F.concat(_by_role(role, 0), F.lit(pad), name, body, F.lit(" "), _by_role(role, 1))


def parse(df: DataFrame, rendered: str, out: str) -> DataFrame:
    """``df`` with ``out``: array<struct<role, text>> read from the column
    ``rendered``; null if it is not a sentence of the grammar.

    Each step is a column of its own, so that the cut is evaluated once and
    the work is linear in the text."""
    keep = [c for c in df.columns]
    df = df.withColumn("_parts", F.filter(
        F.split(rendered, rf"(?=[\[<])(?={CONTROL})|(?<=[\]>])(?<={CONTROL})"), lambda p: p != ""))
    pick = lambda k: F.filter("_parts", lambda _, i: i % 3 == k)
    df = df.withColumn("_triples", F.arrays_zip(
        pick(0).alias("open"), pick(1).alias("mid"), pick(2).alias("close")))

    def matched(t: Column) -> Column:
        ok = F.lit(False)
        for opening, closing in [*MARKS.values(), OTHER]:
            ok = ok | ((t["open"] == opening) & (t["close"] == closing))
        return ok & (F.length(t["mid"]) >= 2) & F.left(t["mid"], F.lit(1)).isin(RAW, ESCAPED)

    def turn(t: Column) -> Column:
        role = F.lit(None).cast("string")
        for name, (opening, _) in MARKS.items():
            role = F.when(t["open"] == opening, F.lit(name)).otherwise(role)
        inner = F.substr(t["mid"], F.lit(2), F.length(t["mid"]) - 2)
        # The first line of an unmarked role's turn is its escaped name.
        named = ~t["open"].isin(*(m[0] for m in MARKS.values()))
        cut = F.when(named, F.locate("\n", inner)).otherwise(F.lit(0))
        name = F.substr(inner, F.lit(1), F.greatest(cut - 1, F.lit(0)))
        body = F.substr(inner, cut + 1, F.length(inner))
        return F.struct(
            F.when(named, unescape(F.replace(name, F.lit("\\n"), F.lit("\n")))).otherwise(role).alias("role"),
            F.when(F.left(t["mid"], F.lit(1)) == ESCAPED, unescape(body)).otherwise(body).alias("text"))

    whole = (F.size("_parts") % 3 == 0) & F.forall("_triples", matched)
    return df.select(*keep, F.when(whole, F.transform("_triples", turn)).alias(out))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``turns``, the
    array of (role, text, loss) read back from ``formatted``; ``loss`` marks
    the turns whose text is trained on (role ``assistant``)."""
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Level 0 as it is, level 1 escaped; the first that reads back identical.
    raw = rows.withColumn("raw", render_turn(F.col("role"), F.col("text"), escaped=False))
    same = F.col("back").eqNullSafe(F.array(F.struct("role", "text")))
    kept = parse(raw, "raw", "back").select("conv_id", "turn", "role", "text", F.when(same, F.col("raw")).otherwise(
        render_turn(F.col("role"), F.col("text"), escaped=True)).alias("rendered"))
    convs = kept.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("all"))
    out = convs.select(
        "conv_id", F.array_join(F.col("all.rendered"), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    out = parse(out, "formatted", "back")
    checked = F.when(F.col("back").eqNullSafe(F.col("source")), F.col("back")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not read back: "), F.col("conv_id").cast("string"))))
    return out.select("conv_id", "formatted", F.transform(
        checked, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"),
                                    (t["role"] == "assistant").alias("loss"))).alias("turns"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of the turns read back and of the text under the loss mask."""
    turns = F.col("turns")
    all_text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter(turns, lambda t: t["loss"]), lambda t: t["text"]), "")
    return formatted.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(all_text.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
