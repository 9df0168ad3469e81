"""Chat formatting by grammar round trip, in DataFrame functions only.

Grammar of the output, one line group per turn::

    conversation = turn*
    turn         = "### " role ": " body "</turn>\\n"

A body or role may not hold the control strings; in both, ``\\s`` reads as a backslash, ``\\h`` as
``### ``, ``\\t`` as ``</turn>`` and ``\\c`` as ``: ``. Every turn is first rendered as it stands and
parsed again; only turns that come back changed are escaped. The whole conversation is parsed once
more, and one that still differs has all its turns escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtml.llm.common import prepare

HEAD, SEP, END = "### ", ": ", "</turn>"


def _swap(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escape(c: Column, role: bool = False) -> Column:
    """Text without control strings that ``unescape`` turns back into ``c``."""
    return _swap(c, [("\\", "\\s"), (HEAD, "\\h"), (END, "\\t"), *([(SEP, "\\c")] if role else [])])


def unescape(c: Column) -> Column:
    return _swap(c, [("\\h", HEAD), ("\\t", END), ("\\c", SEP), ("\\s", "\\")])


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(SEP), body, F.lit(END + "\n"))


def _turn(part: Column) -> Column:
    """Role and text of one rendered turn without its end; null where the grammar is broken."""
    rest = F.substr(part, F.lit(len(HEAD) + 1))
    at = F.instr(rest, SEP)
    role, body = F.substr(rest, F.lit(1), at - 1), F.substr(rest, at + F.lit(len(SEP)))
    sound = F.startswith(part, F.lit(HEAD)) & (at > 0) & \
        ~F.contains(rest, F.lit(HEAD)) & ~F.contains(rest, F.lit(END))
    return F.when(sound, F.struct(unescape(role).alias("role"), unescape(body).alias("text"),
                                  body.alias("body")))


def parse(formatted: Column) -> Column:
    """Array of (``role``, ``text``, ``body`` as written); null entries where the grammar breaks."""
    parts = F.split(formatted, END + "\n", -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), _turn)


def _same(parsed: Column, source: Column) -> Column:
    plain = F.transform(parsed, lambda t: F.struct(t["role"], t["text"]))
    wanted = F.transform(source, lambda t: F.struct(t["role"], t["text"]))
    return F.coalesce(plain.eqNullSafe(wanted), F.lit(False))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``.

    ``loss_spans`` is an array of (``turn``, ``start``, ``end``): the code-point range, inside the
    rendered turn of that 0-based number, of each text by ``trained_role``. Turns are ordered by
    number, then role and text (so repeated rows and ties have one order; a null number comes first);
    null roles and texts are empty; rows with a null id form one conversation; an empty table gives
    no rows. Columns besides the four are ignored. A conversation is one output string, so its rows
    meet in one task; that bound is the format's own.
    """
    prepare(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    raw = render(F.col("role"), F.col("text"))
    alone = parse(raw)
    kept = (F.size(alone) == 1) & F.coalesce(
        alone[0]["role"].eqNullSafe(F.col("role")) & alone[0]["text"].eqNullSafe(F.col("text")),
        F.lit(False))
    rows = rows.withColumn("line", F.when(kept, raw).otherwise(
        render(escape(F.col("role"), True), escape(F.col("text")))))
    whole = rows.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "line"))).alias("turns"))
    first = F.array_join(F.transform("turns", lambda t: t["line"]), "")
    second = F.array_join(F.transform("turns", lambda t: render(escape(t["role"], True),
                                                                escape(t["text"]))), "")
    checked = whole.select(
        "id", "turns", F.when(_same(parse(first), F.col("turns")), first)
        .when(_same(parse(second), F.col("turns")), second)
        .otherwise(F.raise_error(F.lit("a conversation does not come back")).cast("string"))
        .alias("formatted"))
    parsed = parse(F.col("formatted"))
    sizes = F.transform(F.split("formatted", END + "\n", -1), F.length)  # of the turns as written
    spans = F.transform(parsed, lambda t, i: F.when(
        t["role"] == trained_role,
        F.struct(i.alias("turn"), (F.get(sizes, i) - F.length(t["body"])).alias("start"),
                 F.get(sizes, i).alias("end"))))
    return checked.select(F.col("id").alias(conv_col), "formatted",
                          F.array_compact(spans).alias("loss_spans"))


def conversation_digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests read back from ``format_conversations`` output alone."""
    parts = F.split("formatted", END + "\n", -1)
    turns = parse(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.element_at(parts, s["turn"] + 1), s["start"] + 1, s["end"] - s["start"])))
    loss = F.array_join(under, "")
    return formatted.select(
        F.col(conv_col), F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
