"""Chat formatting: a finite-state machine over roles, and a declarative template with loss flags.

All on the JVM: a conversation's turns are sorted in an array, the machine is a
fold over its roles, and segments are array expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored

# Control strings begin with one of these, so texts may hold none of them unescaped.
_ESCAPES = (("\\", "\\\\"), ("[", "\\("), ("]", "\\)"), ("<", "\\{"))


@dataclass(frozen=True)
class Template:
    """Marks around each role's text, the roles under the loss mask, and the machine that turn orders must follow.

    Marks begin with ``[`` or ``<``. A role without marks of its own gets the
    ``other`` marks, with its escaped name in the opening one.
    """

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>\n")})
    other: tuple[str, str] = ("[ROLE:%s] ", " [/ROLE]\n")
    loss: tuple[str, ...] = ("assistant",)
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"}, "system": {"user": "user"},
        "user": {"assistant": "assistant"}, "assistant": {"user": "user"}})
    accepting: tuple[str, ...] = ("assistant",)


LLAMA_STYLE = Template()


def escape(text: Column) -> Column:
    """Takes the first characters of control strings out of a text, reversibly."""
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Undoes ``escape``: doubled backslashes part the text, so that none of the codes is taken apart."""
    def codes(piece: Column) -> Column:
        for plain, code in _ESCAPES[1:]:
            piece = F.replace(piece, F.lit(code), F.lit(plain))
        return piece

    pieces = F.transform(F.split(text, r"\\\\", -1), codes)
    return F.array_join(pieces, "\\")


def _mark(role: Column, template: Template, which: int) -> Column:
    other = template.other[which]
    default = F.concat(F.lit(other.split("%s")[0]), escape(role), F.lit(other.split("%s")[1])) if "%s" in other else F.lit(other)
    chosen = None
    for name, marks in template.marks.items():
        chosen = (F if chosen is None else chosen).when(role == name, F.lit(marks[which]))
    return default if chosen is None else chosen.otherwise(default)


def _machine(turns: Column, template: Template) -> Column:
    """(state, first turn out of order or -1) after all turns."""
    steps = F.create_map(*[F.lit(x) for state, to in template.moves.items() for role, after in to.items() for x in (f"{state}\n{role}", after)])
    begin = F.struct(F.lit("start").alias("state"), F.lit(-1).alias("wrong"), F.lit(0).alias("n"))

    def move(at: Column, turn: Column) -> Column:
        after = F.try_element_at(steps, F.concat(at["state"], F.lit("\n"), turn["role"]))
        return F.struct(
            F.coalesce(after, F.lit("error")).alias("state"),
            F.when((at["wrong"] < 0) & after.isNull(), at["n"]).otherwise(at["wrong"]).alias("wrong"), (at["n"] + 1).alias("n"))

    return F.aggregate(turns, begin, move)


def format_chats(turns: DataFrame, template: Template = LLAMA_STYLE) -> DataFrame:
    """(conv_id, n_turns, valid, wrong_turn, formatted, segments) of every conversation.

    Turns are taken by ``turn``, NULL first, ties by role and text; repeated rows
    are turns each. NULL text and NULL role are empty. ``valid`` says whether the
    machine accepts the order of roles, ``wrong_turn`` where it first does not (-1:
    nowhere); invalid conversations are formatted all the same. ``segments`` are
    the pieces of ``formatted``, each with its text and its loss flag. Rows of a
    NULL conv_id are one conversation. Other columns are ignored.

    A conversation is one row of the output, so its turns meet in one task; it is
    the unit a model reads at once.
    """
    ready(turns.sparkSession)
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.select("conv_id", one.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))

    def pieces(turn: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        no, own = F.lit(False), turn["role"].isin(*template.loss)
        return F.array(piece(_mark(turn["role"], template, 0), no), piece(escape(turn["text"]), own), piece(_mark(turn["role"], template, 1), no))

    built = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), _machine(F.col("turns"), template).alias("end"),
                         F.flatten(F.transform("turns", pieces)).alias("segments"))
    return built.select(
        "conv_id", "n_turns", F.col("end.state").isin(*template.accepting).alias("valid"), F.col("end.wrong").alias("wrong_turn"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column, template: Template = LLAMA_STYLE) -> Column:
    """The (role, text) of every turn that a formatted text marks."""
    marks = {**{re.escape(a): re.escape(b) for a, b in template.marks.values()}}
    head, tail = (re.escape(part) for part in template.other[0].split("%s"))
    opening = "|".join([*marks, head + r"[^\[\]<]*" + tail])
    closing = "|".join([*marks.values(), re.escape(template.other[1])])
    pattern = F.lit(f"({opening})([^\\[<]*)({closing})")
    opened, text = F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2))

    def turn(mark: Column, body: Column) -> Column:
        begin, end = template.other[0].split("%s")
        role = unescape(F.substring(mark, F.lit(len(begin) + 1), F.length(mark) - len(begin) - len(end)))
        chosen = None
        for name, (a, _) in template.marks.items():
            chosen = (F if chosen is None else chosen).when(mark == a, F.lit(name))
        return F.struct((role if chosen is None else chosen.otherwise(role)).alias("role"), unescape(body).alias("text"))

    return F.zip_with(opened, text, turn)


def digest(chats: DataFrame, template: Template = LLAMA_STYLE) -> DataFrame:
    """Per formatted conversation: its turns and its loss text, both read back and unescaped, as hashes and lengths."""
    parsed = chats.select("*", read_turns(F.col("formatted"), template).alias("read"), F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("under_loss"))
    spoken = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"), F.sha2("under_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "wrong_turn")


def chat_output(turns: DataFrame, template: Template = LLAMA_STYLE) -> DataFrame:
    """Format, write to the cluster's shared folder, and digest what the files hold."""
    return digest(stored(format_chats(turns, template), "chats"), template)
