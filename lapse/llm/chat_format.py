"""Chat formatting by a finite-state machine over roles (DataFrame functions only).

A declarative ``Template`` gives each role an opening and a closing mark, whether its text is
trained on, and which roles may follow which.  ``format_chats`` walks the turns of a conversation
in order: the machine checks every step (``valid``), and each turn emits three text segments -
opening, escaped text, closing - with a loss flag each; the formatted text is their concatenation.

Escaping is reversible: a backslash becomes two, and a control string of the template inside a
text gets ``\\|`` after its first character, so marks only occur where the template put them.
``read_back`` cuts a formatted text at its marks and undoes this.

A conversation's turns are gathered in two steps: stretches of ``STRETCH`` turns first, then the
stretches, so a very long conversation is sorted and formatted in many tasks and only its finished
stretches meet (a conversation's text is one value in the result).

Results for odd input: a null text is empty; a null role or one the template does not know gets the
generic marks, which carry its name, and makes the conversation invalid; turns are ordered by turn
(null first), then role and text, so repeated rows are repeated turns next to each other; an empty
table gives an empty result; extra columns are ignored; rows with a null conv_id are one conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import col

STRETCH = 256
ESCAPE, BREAK = "\\", "\\|"


@dataclass(frozen=True)
class Role:
    opening: str
    closing: str
    trained: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Role]
    # State -> states that may follow; "" is the beginning, final states may end a conversation.
    follows: dict[str, tuple[str, ...]]
    generic: tuple[str, str, str] = ("[TURN]", "[SAYS]", "[/TURN]")  # before an unknown role's name, before its text, after it
    reserved: tuple[str, ...] = field(default=())

    def __post_init__(self):
        marks = self.controls()
        for m in marks:
            if not m or ESCAPE in m or m[0] in m[1:] or any(o != m and o.startswith(m) for o in marks):
                raise ValueError(f"mark {m!r} must begin with a character it holds once, begin no other mark and hold no escape")

    def controls(self) -> list[str]:
        return sorted({m for r in self.roles.values() for m in (r.opening, r.closing)} | {*self.generic, *self.reserved})


# The marks and the order of roles of the default template.
INSTRUCT = Template(
    roles={"system": Role("[SYS]", "[/SYS]"), "user": Role("[INST]", "[/INST]"), "assistant": Role("<s>", "</s>", trained=True)},
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def escape(text: Column, template: Template) -> Column:
    ahead = "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in template.controls())
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    # In a Java replacement a backslash is written twice.
    return F.regexp_replace(doubled, F.lit(f"({ahead})"), F.lit("$1" + BREAK.replace("\\", "\\\\")))


def unescape(text: Column) -> Column:
    """Left to right: two backslashes are one, a backslash and a bar are nothing."""
    return F.regexp_replace(text, F.lit(r"\\(?:\||(\\))"), F.lit("$1"))


def _segments(template: Template, role: Column, text: Column) -> Column:
    """The turn's three segments as structs (text, loss)."""
    def triple(opening, closing, trained):
        return F.array(*[F.struct(x.alias("text"), F.lit(loss).alias("loss"))
                         for x, loss in ((opening, False), (escape(text, template), trained), (closing, False))])

    before, says, after = template.generic
    name = F.concat(F.lit(before), escape(F.coalesce(role, F.lit("")), template), F.lit(says))
    out = None
    for r, marks in template.roles.items():
        value = triple(F.lit(marks.opening), F.lit(marks.closing), marks.trained)
        out = F.when(role == r, value) if out is None else out.when(role == r, value)
    unknown = triple(name, F.lit(after), False)
    return unknown if out is None else out.otherwise(unknown)


def _may_follow(template: Template, last: Column, role: Column) -> Column:
    allowed = F.lit(False)
    for state, after in template.follows.items():
        allowed = allowed | ((last == state) & role.isin(*after))
    return F.coalesce(allowed, F.lit(False))


def format_chats(turns: DataFrame, template: Template = INSTRUCT, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, n_turns, valid, segments, formatted): one row per conversation."""
    role, text = col("role").cast("string"), F.coalesce(col("text").cast("string"), F.lit(""))
    rows = turns.select(col("conv_id").alias("conv_id"), col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    part = F.floor(F.coalesce(F.col("turn").cast("double"), F.lit(-1.0)) / stretch).cast("long")
    turn = F.struct("turn", "role", "text")
    first = (rows.withColumn("part", part).groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("t"))
             .select("conv_id", "part", "t", F.transform("t", lambda x: F.coalesce(x["role"], F.lit("?"))).alias("r")))
    inner = F.forall(F.sequence(F.lit(1), F.greatest(F.size("r") - 1, F.lit(1))),
                     lambda i: (i >= F.size("r")) | _may_follow(template, F.get("r", i - 1), F.get("r", i)))
    done = first.select(
        "conv_id", "part", F.size("t").cast("long").alias("n"), inner.alias("inner"), F.get("r", F.lit(0)).alias("head"),
        F.element_at("r", -1).alias("tail"),
        F.flatten(F.transform("t", lambda x: _segments(template, x["role"], x["text"]))).alias("segments"))
    stretches = F.sort_array(F.collect_list(F.struct("part", "n", "inner", "head", "tail", "segments")))
    met = done.groupBy("conv_id").agg(stretches.alias("s"))
    seams = F.forall(F.sequence(F.lit(0), F.size("s") - 1), lambda i: _may_follow(
        template, F.when(i == 0, F.lit("")).otherwise(F.get("s", i - 1)["tail"]), F.get("s", i)["head"]))
    whole = met.select(
        "conv_id", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_turns"),
        (F.forall("s", lambda x: x["inner"]) & seams).alias("valid"),
        F.flatten(F.transform("s", lambda x: x["segments"])).alias("segments"))
    return whole.withColumn("formatted", F.array_join(F.transform("segments", lambda x: x["text"]), ""))


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``formatted`` with ``turns``: array of (role, text) cut out of the column ``formatted``."""
    before, says, after = template.generic
    known = "|".join(f"{re.escape(r.opening)}.*?{re.escape(r.closing)}" for r in template.roles.values())
    turn = f"(?s){known}|{re.escape(before)}.*?{re.escape(after)}"
    cut = F.regexp_extract_all("formatted", F.lit(turn), F.lit(0))

    def parse(x):
        inner = F.substring(x, len(before) + 1, F.length(x) - len(before) - len(after))
        at = F.locate(says, inner)
        out = F.struct(unescape(F.substring(inner, F.lit(1), at - 1)).alias("role"),
                       unescape(F.substring(inner, at + len(says), F.length(inner))).alias("text"))
        for name, marks in template.roles.items():
            body = F.substring(x, F.lit(len(marks.opening) + 1), F.length(x) - len(marks.opening) - len(marks.closing))
            out = F.when(F.startswith(x, F.lit(marks.opening)), F.struct(F.lit(name).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out

    return formatted.withColumn("turns", F.transform(cut, parse))


def chat_format(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digest per conversation, read back from the formatted text and its loss flags; conversation -1 is added."""
    spark = turns.sparkSession
    odd = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    every = turns.select("conv_id", "turn", "role", "text").unionByName(added)
    back = read_back(format_chats(every, template), template)
    digests = back.select(
        "conv_id", "valid", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.array_join(F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: unescape(x["text"])), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    return digests.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                          F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "valid")
