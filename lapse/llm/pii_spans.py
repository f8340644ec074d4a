"""Personal data: overlapping candidate spans, boosted trees, calibrated thresholds (DataFrame functions only).

1. Generators are patterns of one kind each.  The four base patterns are among them; the others are
   tighter or looser forms, so the spans they propose overlap (a phone number beside an address that
   the base pattern swallows together, a card next to another number, "name (at) host").
2. Every candidate gets small integer features of its format and of the characters around it.
3. Labels come from the corpus: a span that passes its base checks is positive, one that fails the
   checks of its kind or crosses a positive span of another kind is negative, the rest is not used.
   All candidates of all documents are counted per distinct feature vector (the features have few
   values, so that table is small), and gradient boosting over that table grows the trees.
4. Per kind, the lowest threshold that reaches ``PRECISION`` on documents set aside (a fifth, by the
   id's crc32) is kept.  Scoring is a sum of CASE expressions.  Base spans always stay; of the others,
   those at or over their threshold that cross no base span and no better span are added.

Results for odd input: null and empty texts have no spans; repeated rows give repeated results; an
empty table gives an empty result (and no added spans: without labels of both classes nothing is
added); extra columns are ignored by ``pii_spans`` and kept by ``redact``.  Texts of any length are read
whole, and a span may have any length (a mail address any number of domain labels).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.functions.materialize import freeze
from lapse.llm.common import col, fresh, id_crc, text_or_empty

KINDS = ("email", "ip", "card", "phone")
EMAIL_CHARS = "A-Za-z0-9._%+-"
# (kind, is it the base pattern, pattern).  A group that repeats without a bound is possessive: the regex engine
# follows such a group in a loop, any other by recursion.  A run of characters is entered only at its start.
GENERATORS = (
    ("email", True, rf"(?:\G|(?<![{EMAIL_CHARS}]))[{EMAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, rf"(?<![{EMAIL_CHARS}])[{EMAIL_CHARS}]{{1,64}} ?(?:\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]{{1,63}} ?"
                     r"(?:(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{2,63}){1,5}"),
    ("ip", False, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    ("card", False, r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    ("phone", False, r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
)


def _may_hold(text: Column, digits: Column) -> dict[str, Column]:
    """Cheap conditions without which a text has no match of a kind."""
    def has(*parts):
        found = F.lit(False)
        for p in parts:
            found = found | F.contains(text, F.lit(p))
        return found
    return {"email": has("@", "at)", "at]", "at}"), "ip": digits & text.rlike(r"[0-9]\.[0-9]"),
            "card": digits & text.rlike("[0-9]{4}|[0-9][ -][0-9]"), "phone": digits & has("+")}


_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CUES = r"(?i)(?:mail|contact|phone|tel|call|mobile|card|visa|pay|host|server|addr|ip)"
FEATURES = ("kind", "generator", "digits", "luhn", "octets", "plus", "paren", "gaps", "before", "after", "cue", "at")
CONTEXT, ROUNDS, DEPTH, RATE, PRECISION = 24, 20, 3, 0.4, 0.99


def _placed(text: Column, digits: Column, generator: int) -> Column:
    """The generator's matches as structs (kind, generator, start, end, hit, left, right)."""
    kind, _, pattern = GENERATORS[generator]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # the stretches around the matches
    empty = F.array().cast("array<struct<start:int,end:int,hit:string,left:string,right:string>>")

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        row = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"),
                       F.right(x["gap"], F.lit(CONTEXT)).alias("left"), F.left(x["next"], F.lit(CONTEXT)).alias("right"))
        return F.struct(F.concat(state["out"], F.array(row)).alias("out"), end.alias("at"))

    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), hits.alias("hit"),
                          F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))
    found = F.aggregate(zipped, F.struct(empty.alias("out"), F.lit(0).alias("at")), step)["out"]
    return F.when(_may_hold(text, digits)[kind], found).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits' check sum is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _class_of(char: Column) -> Column:
    """0 nothing, 1 letter, 2 digit, 3 white space, 4 anything else."""
    return (F.when(char == "", 0).when(char.rlike(r"\p{L}"), 1).when(char.rlike("[0-9]"), 2).when(char.rlike(r"\s"), 3).otherwise(4))


def _described(generator: int, x: Column) -> Column:
    kind, base, _ = GENERATORS[generator]
    hit, n = x["hit"], F.length(_digits(x["hit"]))
    luhn = _luhn(_digits(hit)) if kind == "card" else F.lit(False)
    octets = hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$") if kind == "ip" else F.lit(False)
    valid = {"email": F.lit(True), "ip": octets, "card": n.between(12, 19) & luhn, "phone": n.between(9, 15)}[kind]
    values = {
        "kind": F.lit(KINDS.index(kind)), "generator": F.lit(generator), "digits": F.least(n, F.lit(20)), "luhn": luhn.cast("int"),
        "octets": octets.cast("int"), "plus": F.startswith(hit, F.lit("+")).cast("int"), "paren": F.contains(hit, F.lit("(")).cast("int"),
        "gaps": F.least(F.length(F.regexp_replace(hit, r"[^\x20.()-]", "")), F.lit(6)),
        "before": _class_of(F.right(x["left"], F.lit(1))), "after": _class_of(F.left(x["right"], F.lit(1))),
        "cue": x["left"].rlike(CUES).cast("int"), "at": F.contains(hit, F.lit("@")).cast("int")}
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                    F.lit(base).alias("proposed"), valid.alias("valid"), F.array(*[values[f].cast("tinyint") for f in FEATURES]).alias("f"))


def candidates(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the array column ``name`` of candidate structs (kind, start, end, proposed, valid, f)."""
    text_name, digits, *raw = fresh(docs, "_text", "_digits", *[f"_g{i}" for i in range(len(GENERATORS))])
    read = docs.withColumn(text_name, text_or_empty(text_col)).withColumn(digits, F.col(text_name).rlike("[0-9]"))
    read = read.withColumns({raw[i]: _placed(F.col(text_name), F.col(digits), i) for i in range(len(GENERATORS))})
    every = F.concat(*[F.transform(raw[i], partial(_described, i)) for i in range(len(GENERATORS))])
    return read.withColumn(name, every).drop(text_name, digits, *raw)


def _is_base(x: Column) -> Column:
    return x["proposed"] & x["valid"]


def _of_kind(kind: int, x: Column) -> Column:
    return x["kind"] == kind


def _crosses(x: Column, y: Column) -> Column:
    return (x["start"] < y["end"]) & (y["start"] < x["end"])


@dataclass
class Model:
    trees: list  # nested (feature, limit, below, above), a leaf is a float
    prior: float
    thresholds: dict[int, float]  # per kind; a kind without one adds nothing

    def score(self, f: Column) -> Column:
        def branch(node):
            if isinstance(node, float):
                return F.lit(node)
            feature, limit, below, above = node
            return F.when(F.get(f, F.lit(feature)) <= limit, branch(below)).otherwise(branch(above))
        total = F.lit(self.prior)
        for tree in self.trees:
            total = total + branch(tree)
        return 1 / (1 + F.exp(-total))

    def score_row(self, f: tuple[int, ...]) -> float:
        total = self.prior
        for node in self.trees:
            while not isinstance(node, float):
                node = node[2] if f[node[0]] <= node[1] else node[3]
            total += node
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, total))))


def _grow(rows: list, depth: int):
    """A regression tree over rows (features, gradient, curvature), both summed over a feature vector's candidates."""
    gradient, curvature = sum(r[1] for r in rows), sum(r[2] for r in rows)
    gain, best = 1e-6, None
    for feature in range(len(FEATURES)) if depth else ():
        by_value: dict[int, list[float]] = {}
        for f, g, h in rows:
            held = by_value.setdefault(f[feature], [0.0, 0.0])
            held[0] += g
            held[1] += h
        g = h = 0.0
        for value in sorted(by_value)[:-1]:
            g, h = g + by_value[value][0], h + by_value[value][1]
            found = g * g / (h + 1) + (gradient - g) ** 2 / (curvature - h + 1) - gradient ** 2 / (curvature + 1)
            if found > gain:
                gain, best = found, (feature, value)
    if best is None:
        return RATE * gradient / (curvature + 1)
    feature, limit = best
    return (feature, limit, _grow([r for r in rows if r[0][feature] <= limit], depth - 1),
            _grow([r for r in rows if r[0][feature] > limit], depth - 1))


def fit(found: DataFrame, name: str, id_col: str = "doc_id") -> Model:
    """Boosted trees and thresholds from the candidates of all rows."""
    mine = F.col(name)
    base = F.filter(mine, _is_base)
    # Base spans in a column of their own: inside a lambda an expression is evaluated for every element.
    rows = found.select((id_crc(id_col) % 5 == 0).alias("aside"), mine.alias("c"), base.alias("b")).where(F.size("c") > 0)
    labelled = rows.select("aside", F.explode(F.transform("c", lambda x: F.struct(
        x["f"].alias("f"), F.when(F.exists("b", lambda y: (y["kind"] == x["kind"]) & (y["start"] == x["start"]) & (y["end"] == x["end"])), 1)
        .when(~x["valid"] | F.exists("b", lambda y: (y["kind"] != x["kind"]) & _crosses(x, y)), 0).alias("label")))).alias("x"))
    counts = (labelled.where(F.col("x.label").isNotNull()).groupBy("aside", F.col("x.f").alias("f"))
              .agg(F.sum(F.col("x.label")).alias("yes"), F.count(F.lit(1)).alias("n")).collect())
    train = [(tuple(r.f), r.yes, r.n) for r in counts if not r.aside]
    train.sort()
    yes, n = sum(r[1] for r in train), sum(r[2] for r in train)
    model = Model([], math.log((yes + 1) / (n - yes + 1)), {})
    if not 0 < yes < n:
        return model
    for _ in range(ROUNDS):
        scored = [(f, y, k, model.score_row(f)) for f, y, k in train]
        model.trees.append(_grow([(f, y - k * p, k * p * (1 - p)) for f, y, k, p in scored], DEPTH))
    for kind in range(len(KINDS)):
        aside = sorted(((model.score_row(tuple(r.f)), r.yes, r.n) for r in counts if r.aside and r.f[0] == kind), reverse=True)
        right = seen = 0
        for i, (p, y, k) in enumerate(aside):
            right, seen = right + y, seen + k
            if right >= PRECISION * seen and p >= 0.5 and (i + 1 == len(aside) or aside[i + 1][0] < p):
                model.thresholds[kind] = p
    return model


def select_spans(found: DataFrame, name: str, model: Model) -> DataFrame:
    """The array column ``name`` of candidates becomes the selected spans: structs (start, kind, end, base), sorted."""
    b, more = fresh(found, "_base", "_more")
    mine = F.col(name)
    scored = F.transform(mine, lambda x: F.struct(model.score(x["f"]).alias("p"), x.alias("x")))

    def passes(s):
        ok = F.lit(False)
        for kind, value in model.thresholds.items():
            ok = ok | ((s["x"]["kind"] == kind) & (s["p"] >= value - 1e-12))
        return ok & ~s["x"]["proposed"]

    # A candidate that is no base span: the better of two that cross is the likelier, then the longer, then the first.
    ranked = F.transform(F.filter(scored, passes), lambda s: F.struct(
        s["p"].alias("p"), (s["x"]["end"] - s["x"]["start"]).alias("length"), (-s["x"]["start"]).alias("back"), (-s["x"]["kind"]).alias("kind"),
        s["x"]["start"].alias("start"), s["x"]["end"].alias("end")))
    step = found.withColumn(b, F.filter(mine, _is_base)).withColumn(more, F.when(F.size(mine) > F.size(b), ranked))
    free = F.filter(F.coalesce(F.col(more), F.array().cast("array<struct<p:double,length:int,back:int,kind:int,start:int,end:int>>")),
                    lambda x: ~F.exists(b, lambda y: _crosses(x, y)) & ~F.exists(more, lambda y: _crosses(x, y) & (y > x)))
    spans = F.concat(F.transform(b, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(True).alias("base"))),
                     F.transform(free, lambda x: F.struct(x["start"].alias("start"), (-x["kind"]).alias("kind"), x["end"].alias("end"), F.lit(False).alias("base"))))
    return step.withColumn(name, F.sort_array(F.array_distinct(spans))).drop(b, more)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every selected span of the text replaced by its kind in brackets; crossing spans as one."""
    name, = fresh(docs, "_spans")
    model = fit(freeze(candidates(docs.select(col(id_col), col(text_col)), name, text_col)), name, id_col)
    found = select_spans(candidates(docs, name, text_col), name, model)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = col(text_col)

    def step(state, x):
        fresh_ = x["start"] >= state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, x["start"] - state["at"]), F.get(tags, x["kind"]))
        return F.struct(F.when(fresh_, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"),
                        F.greatest(state["at"], x["end"]).alias("at"))

    cut = F.aggregate(name, F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at")), step,
                      lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    clean = F.when(F.size(name) > 0, cut).otherwise(text)
    return found.select(*[clean.alias(c) if c == text_col else col(c) for c in docs.columns])


def pii_spans(docs: DataFrame) -> DataFrame:
    """Digest: base counts and hash, and all selected spans."""
    found = freeze(candidates(docs.select("doc_id", "text"), "spans").drop("text"))
    model = fit(found, "spans")
    selected = select_spans(found, "spans", model).withColumn("_base", F.filter("spans", lambda x: x["base"]))
    counts = [F.size(F.filter("_base", partial(_of_kind, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return selected.select("doc_id", *counts, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
