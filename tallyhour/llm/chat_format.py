"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A declarative template names each role's opening and closing mark and whether its
text is learned (the loss flag), and the turn orders that are valid. Each
conversation becomes text segments with a loss flag each; the formatted text is
their concatenation. Control strings inside texts are escaped: ``~`` becomes
``~0``, and ``~1`` is put after the first character of a control string, so that no
mark can appear inside a text and the texts can be read back exactly.

A conversation is one row, since it is one training example and its digests span
all of its turns; conversations are dealt to tasks by their id.

Defined results: null texts and roles are empty; turns sort by (turn, role, text),
null turns first, and repeated rows are separate turns; roles without marks of
their own carry their name inside the marks of ``OTHER``; rows with a null conv_id
form one conversation; conversations that the machine rejects are formatted too,
with ``valid`` false. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks and loss flag by role; ``moves`` maps a state and a role to the next state (the role)."""

    marks: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: {
        "system": ("<<SYS>> ", " <</SYS>>\n", False),
        "user": ("[INST] ", " [/INST]", False),
        "assistant": ("<s> ", " </s>\n", True),
    })
    moves: tuple[tuple[str, str], ...] = (("start", "system"), ("start", "user"), ("system", "user"),
                                          ("user", "assistant"), ("assistant", "user"))
    accept: tuple[str, ...] = ("assistant",)


#: Marks around another role's name and after its text.
OTHER = ("<<ROLE>>", "<</ROLE>> ", " <</TURN>>\n")
#: First character and rest of every control string.
CONTROL = r"(<|\[)(/?s>|/?INST\]|</?(?:SYS|ROLE)>>|</TURN>>)"
LLAMA = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("~"), F.lit("~0")), CONTROL, "$1~1$2")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def _by_role(template: Template, role: Column, of_role, other: Column) -> Column:
    out = other
    for r, m in reversed(list(template.marks.items())):
        out = F.when(role == r, of_role(m)).otherwise(out)
    return out


def format_conversations(rows: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, n_turns, valid and segments (text, loss) of every conversation."""
    turns = (rows.select("conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                             F.coalesce("text", F.lit("")).alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    moves = F.create_map(*[F.lit(x) for a, b in template.moves for x in (f"{a}\n{b}", b)])
    step = lambda state, t: F.coalesce(
        F.try_element_at(moves, F.concat(state, F.lit("\n"), t["role"])), F.lit("rejected"))
    state = F.aggregate("turns", F.lit("start"), step)

    def segments(t):
        text, loss = escape(t["text"]), _by_role(template, t["role"], lambda m: F.lit(m[2]), F.lit(False))
        before = _by_role(template, t["role"], lambda m: F.lit(m[0]),
                          F.concat(F.lit(OTHER[0]), escape(t["role"]), F.lit(OTHER[1])))
        after = _by_role(template, t["role"], lambda m: F.lit(m[1]), F.lit(OTHER[2]))
        return F.array(F.struct(before.alias("text"), F.lit(False).alias("loss")),
                       F.struct(text.alias("text"), loss.alias("loss")),
                       F.struct(after.alias("text"), F.lit(False).alias("loss")))

    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                        state.isin(*template.accept).alias("valid"),
                        F.flatten(F.transform("turns", segments)).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _quote(mark: str) -> str:
    return "".join("\\" + c if c in "[]<>/()|.*+?{}^$\\" else c for c in mark)


def parse(text: Column, template: Template = LLAMA) -> Column:
    """The turns (role, text) of a formatted text, read from its marks alone."""
    marks = [(a, b) for a, b, _ in template.marks.values()] + [(OTHER[0], OTHER[2])]
    pattern = "(?s)" + "|".join(f"{_quote(a)}.*?{_quote(b)}" for a, b in marks)

    def turn(m):
        def body(begin, end):
            return unescape(F.substring(m, F.lit(len(begin) + 1), F.length(m) - len(begin) - len(end)))

        inner = F.substring(m, F.lit(len(OTHER[0]) + 1), F.length(m) - len(OTHER[0]) - len(OTHER[2]))
        out = F.struct(unescape(F.substring_index(inner, OTHER[1], 1)).alias("role"),
                       unescape(F.substring(inner, F.instr(inner, OTHER[1]) + len(OTHER[1]), F.length(inner))).alias("text"))
        for r, (a, b, _) in template.marks.items():
            out = F.when(F.startswith(m, F.lit(a)), F.struct(F.lit(r).alias("role"), body(a, b).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), turn)


def digests(output: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and valid, read from the output."""
    read = output.select("conv_id", "valid", formatted(F.col("segments")).alias("formatted"),
                         loss_text(F.col("segments")).alias("learned"))
    read = read.withColumn("turns", parse(F.col("formatted"), template))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")
