"""Personal data in texts: candidates, boosted trees, calibrated thresholds.

Patterns of high recall propose spans, which may overlap. Findings of the four base patterns
that pass their checks always count. What else is proposed is scored by boosted trees over
its format and its surroundings, and counts where the score reaches a threshold that held-out
documents calibrate. Nobody has labelled the texts: what teaches the trees are base findings, and
for the other proposals what stands farther off or in their digits, which the trees do not
see (a check digit, a country code before a number, words up to a line away). Extraction, checks,
scoring and redaction are DataFrame expressions; the trees are fitted on the driver from counts over
all documents, one per combination of features, whose number the features' values bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Runs are possessive and start only where a run or the last
# finding's end is, which finds the same and takes time in proportion to the text.
_LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: (kind, pattern) of what else is proposed.
MORE = (
    (
        "email",
        rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++"
        r"(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]++)++",
    ),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    ("card", r"(?<![0-9])3[47][0-9]{2}([\x20-]?)[0-9]{6}\1[0-9]{5}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{2,4}\)?){2,4}(?![0-9])"),
    ("phone", r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
)
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_CUES = r"(?i)mail|contact|write|phone|tel|call|fax|mobile|card|visa|pay|server|host|addr|ip\b"
#: Characters before a proposal that its features look at, and that what teaches them does.
CONTEXT, FAR = 24, 120
#: What teaches, by kind: words at some distance, and forms that are rarely anything else.
_FAR_CUES = {
    "email": r"(?i)mail|contact|write|address",
    "ip": r"(?i)server|host|addr|\bip\b|network|gateway",
    "card": r"(?i)card|visa|amex|express|pay|credit",
    "phone": r"(?i)phone|tel\b|call|fax|mobile|dial",
}
_COUNTRY_CODE = r"\+[0-9]{1,3}[\x20.(-]{0,2}$"
_DOMAIN = r"(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z]{2,6}$"

_MARK, _OTHER_MARK = "\u0001", "\u0002"
_TOGETHER = 512

TREES, RATE = 24, 0.4
#: Share of right ones among the held-out proposals that a threshold selects, and the least number
#: of them that says anything.
PRECISION = 0.95
ENOUGH = 3

_SPAN = "array<struct<kind:int,way:int,start:long,end:long,hit:string,before:string,after:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _starts(lengths: Column) -> Column:
    """Where each part starts, if the parts follow each other; in groups, so that the time
    stays in proportion."""
    groups = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _TOGETHER).cast("int"))

    def part(group: Column) -> Column:
        return F.slice(lengths, group * _TOGETHER + 1, F.lit(_TOGETHER))

    def inside(group: Column, begin: Column) -> Column:
        empty = F.array().cast("array<long>")
        return F.aggregate(
            part(group),
            F.struct(begin.alias("at"), empty.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")
            ),
            lambda a: a["out"],
        )

    return _let(
        F.transform(groups, lambda g: _sum(part(g))),
        lambda sums: F.flatten(
            F.transform(groups, lambda g: inside(g, _sum(F.slice(sums, F.lit(1), g))))
        ),
    )


def _found(text: Column, kind: str, way: int, pattern: str) -> Column:
    """All matches of a pattern, leftmost and not overlapping, with their surroundings."""
    # Marks around the matches cut the text into gaps and matches by turns.
    plain = F.translate(text, _MARK, _OTHER_MARK)
    marked = F.regexp_replace(plain, pattern, f"{_MARK}$0{_MARK}")

    def spans(parts: Column, starts: Column) -> Column:
        places = F.sequence(F.lit(2), F.size(parts) - 1, F.lit(2))
        return F.transform(
            places,
            lambda i: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                F.lit(way).alias("way"),
                F.element_at(starts, i).alias("start"),
                (F.element_at(starts, i) + F.length(F.element_at(parts, i))).alias("end"),
                F.element_at(parts, i).alias("hit"),
                F.right(F.element_at(parts, i - 1), F.lit(FAR)).alias("before"),
                F.left(F.element_at(parts, i + 1), F.lit(1)).alias("after"),
            ),
        )

    def cut(marked: Column) -> Column:
        lengths = lambda parts: F.transform(parts, lambda p: F.length(p).cast("long"))
        located = _let(
            F.split(marked, _MARK, -1),
            lambda parts: _let(
                lengths(parts), lambda n: _let(_starts(n), lambda starts: spans(parts, starts))
            ),
        )
        return F.when(F.contains(marked, F.lit(_MARK)), located)

    tried = F.when(F.rlike(text, F.lit(_NEEDS[kind])), _let(marked, cut))
    return F.coalesce(tried, F.array()).cast(_SPAN)


# --- Checks and features ---------------------------------------------------------------


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.substr(turned, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, twice).otherwise(digit).cast("long")

    return _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), worth)) % 10 == 0


def _passes(kind: Column, hit: Column) -> Column:
    """The check of a base finding."""
    digits = _digits(hit)
    octets = F.forall(F.split(hit, r"\."), lambda p: p.try_cast("double") <= 255)
    count = F.length(digits)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, octets)
        .when(kind == 2, F.when(count.between(16, 19), _luhn(digits)).otherwise(False))
        .otherwise(count.between(8, 15))
    )


def _edge(char: Column) -> Column:
    return (
        F.when(F.length(char) == 0, F.lit(0))
        .when(F.rlike(char, F.lit(r"\s")), F.lit(0))
        .when(F.rlike(char, F.lit(r"[\p{L}\p{N}]")), F.lit(2))
        .otherwise(F.lit(1))
    )


FEATURES = ("kind", "way", "digits", "separators", "left", "right", "cue")


def _features(c: Column) -> Column:
    """Small whole numbers, few values each; so few combinations exist."""
    hit, count = c["hit"], F.length(_digits(c["hit"]))
    bins = sum((F.when(count >= n, 1).otherwise(0) for n in (1, 8, 10, 12, 15, 16, 20)), F.lit(0))
    signs = sum((F.when(F.contains(hit, F.lit(s)), 1 << i).otherwise(0) for i, s in enumerate(" -.(")), F.lit(0))
    near = F.right(c["before"], F.lit(CONTEXT))
    return F.struct(
        c["kind"].alias("kind"),
        c["way"].alias("way"),
        bins.alias("digits"),
        signs.alias("separators"),
        _edge(F.right(c["before"], F.lit(1))).alias("left"),
        _edge(c["after"]).alias("right"),
        F.rlike(near, F.lit(_CUES)).cast("int").alias("cue"),
    )


def _is_base(c: Column) -> Column:
    """Whether a proposal, of whatever pattern, is what a base pattern and its check find."""
    fits = F.lit(False)
    for kind, name in enumerate(KINDS):
        fits = fits | ((c["kind"] == kind) & F.rlike(c["hit"], F.lit(f"^(?:{BASE[name]})$")))
    return fits & _passes(c["kind"], c["hit"])


def _taught(c: Column) -> Column:
    """What the trees learn a proposal to be, from what their features do not state."""
    hit, count = c["hit"], F.length(_digits(c["hit"]))
    far = F.left(c["before"], F.greatest(F.lit(0), F.length(c["before"]) - CONTEXT))

    def cued(kind: int) -> Column:
        return F.rlike(far, F.lit(_FAR_CUES[KINDS[kind]]))

    number = F.rlike(c["before"], F.lit(_COUNTRY_CODE)) | cued(3)
    return (
        F.when(c["kind"] == 0, F.rlike(hit, F.lit(_DOMAIN)) | cued(0))
        .when(c["kind"] == 1, ~F.contains(hit, F.lit(".")) & (F.rlike(hit, F.lit("[A-Fa-f]")) | cued(1)))
        .when(c["kind"] == 2, F.when(count.between(13, 19), _luhn(_digits(hit))).otherwise(False))
        .otherwise(count.between(7, 15) & number & ~F.rlike(hit, F.lit(r"^[0-9.]+$")))
    )


# --- Boosted trees ---------------------------------------------------------------------

#: A tree: a leaf's value, or (feature, least value that goes right, left, right).
Tree = float | tuple[str, int, "Tree", "Tree"]


@dataclass(frozen=True)
class Trees:
    start: float
    trees: tuple[Tree, ...]
    #: Scores from which a candidate counts, by kind; None: never.
    thresholds: tuple[float | None, ...]

    def score(self, row: dict[str, int]) -> float:
        return self.start + sum(_leaf(t, row) for t in self.trees)


def _leaf(tree: Tree, row: dict[str, int]) -> float:
    while isinstance(tree, tuple):
        name, cut, left, right = tree
        tree = right if row[name] >= cut else left
    return tree


def _grown(rows: list[dict], depth: int) -> Tree:
    """Fits ``gradient`` with ``weight``, both summed over alike candidates."""
    gradient, weight = sum(r["gradient"] for r in rows), sum(r["weight"] for r in rows)
    own = gradient * gradient / (weight + 1)
    best = None
    for name in FEATURES if depth else ():
        for cut in sorted({r[name] for r in rows})[1:]:
            gain = -own
            for side in (False, True):
                part = [r for r in rows if (r[name] >= cut) == side]
                total = sum(r["gradient"] for r in part)
                gain += total * total / (sum(r["weight"] for r in part) + 1)
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = (gain, name, cut)
    if best is None:
        return RATE * gradient / (weight + 1)
    _, name, cut = best
    sides = [[r for r in rows if (r[name] >= cut) == side] for side in (False, True)]
    return (name, cut, *(_grown(side, depth - 1) for side in sides))


def fit_trees(counts: list[dict]) -> Trees:
    """Gradient boosting of logistic loss, from rows of the features with ``n``, ``yes`` (how
    many are positive), ``is_base`` and ``held_out``. All proposals teach; thresholds come from the
    held-out ones that are no base findings, as only those need one."""
    learned = [dict(r) for r in counts if not r["held_out"]]
    n, yes = sum(r["n"] for r in learned), sum(r["yes"] for r in learned)
    if not yes:
        return Trees(0.0, (), (None,) * len(KINDS))
    start = math.log((yes + 1) / (n - yes + 1))
    scores, trees = [start] * len(learned), []
    for _ in range(TREES):
        for row, score in zip(learned, scores):
            p = 1 / (1 + math.exp(-score))
            row["gradient"], row["weight"] = row["yes"] - row["n"] * p, row["n"] * p * (1 - p)
        tree = _grown(learned, 3)
        trees.append(tree)
        scores = [s + _leaf(tree, r) for s, r in zip(scores, learned)]
    model = Trees(start, tuple(trees), ())
    thresholds: list[float | None] = []
    for kind in range(len(KINDS)):
        own = [r for r in counts if r["kind"] == kind and r["held_out"] and not r["is_base"]]
        ranked = sorted(((model.score(r), r["n"], r["yes"]) for r in own), reverse=True)
        seen = right = 0
        threshold = None
        for place, (score, n, yes) in enumerate(ranked):
            seen, right = seen + n, right + yes
            last = place + 1 == len(ranked) or ranked[place + 1][0] < score - 1e-9
            if last and seen >= ENOUGH and right >= PRECISION * seen:
                threshold = score
        thresholds.append(threshold)
    return Trees(start, tuple(trees), tuple(thresholds))


def _tree_column(tree: Tree, features: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, cut, left, right = tree
    return F.when(features[name] >= cut, _tree_column(right, features)).otherwise(
        _tree_column(left, features)
    )


def _selected(features: Column, model: Trees) -> Column:
    score = sum((_tree_column(t, features) for t in model.trees), F.lit(model.start))
    chosen = F.lit(False)
    for kind, threshold in enumerate(model.thresholds):
        if threshold is not None:
            # Sums of the same leaves in another order may differ in the last place.
            chosen = chosen | ((features["kind"] == kind) & (score >= threshold - 1e-9))
    return chosen


# --- The operator ----------------------------------------------------------------------


def _proposed(docs: DataFrame, text_col: str) -> DataFrame:
    """``(doc, base, candidates)``: the row, findings that pass, and all proposals."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ways = [(k, BASE[k]) for k in KINDS] + list(MORE)
    columns = {f"way{i}": _found(text, k, i, p) for i, (k, p) in enumerate(ways)}
    rows = docs.select(row, *(found.alias(name) for name, found in columns.items()))
    base = F.concat(
        *(F.filter(f"way{i}", lambda s: _passes(s["kind"], s["hit"])) for i in range(len(KINDS)))
    )
    return rows.select("doc", base.alias("base"), F.concat(*columns).alias("candidates"))


def _key(s: Column) -> Column:
    """A span as text that sorts by kind, start and end."""
    return F.concat(
        s["kind"].cast("string"), F.lpad(s["start"].cast("string"), 12, "0"), F.lpad(s["end"].cast("string"), 12, "0")
    )


def fit_pii(docs: DataFrame, text_col: str = "text") -> Trees:
    """Trees and thresholds from the proposals in all documents; about a fifth of these, by a hash of
    the text, is held out, so equal texts are on one side and ids play no part.

    A proposal is a positive example if it is a base finding, or if what its features do not
    state speaks for it, see ``_taught``. Of a kind with fewer than ``ENOUGH`` held-out proposals
    that are no base findings, and without positive examples, nothing is added to the base
    findings. Null and empty texts propose nothing; repeated rows count as often as they stand there.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held_out = F.pmod(F.xxhash64(text), F.lit(5)) == 0
    rows = docs.select(held_out.alias("held_out"), text.alias("text"))
    proposed = _proposed(rows, "text").select("doc.held_out", F.explode("candidates").alias("c"))
    c = F.col("c")
    described = proposed.select("held_out", _is_base(c).alias("is_base"), _taught(c).alias("taught"), _features(c).alias("f"))
    yes = F.col("is_base") | F.col("taught")
    counts = described.select("held_out", "is_base", yes.alias("yes"), "f.*").groupBy("held_out", "is_base", *FEATURES).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("yes").alias("yes")
    )
    found = [row.asDict() for row in counts.collect()]
    return fit_trees(sorted(found, key=lambda r: [r["held_out"], r["is_base"], *(r[f] for f in FEATURES)]))


def find_pii(
    docs: DataFrame, model: Trees, text_col: str = "text", spans_col: str = "spans"
) -> DataFrame:
    """``docs`` with an array of ``(kind, start, end, base)``, by kind as listed, then start.

    Offsets count code points, the end is exclusive. ``base`` marks what the patterns and
    their checks find alone. Other spans come from the trees and may overlap. Null and empty
    texts have none; texts are searched whole. Repeated rows are answered alike; a column of
    the name ``spans_col`` is replaced. An empty table gives an empty one.
    """
    found = _proposed(docs, text_col)
    chosen = F.filter("candidates", lambda c: _let(_features(c), lambda f: _selected(f, model)))
    keys = found.select(
        "doc", F.transform("base", _key).alias("base"), F.transform(chosen, _key).alias("more")
    ).withColumn("more", F.array_except("more", "base"))

    def span(key: Column, base: bool) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.struct(
            F.element_at(names, F.substring(key, 1, 1).cast("int") + 1).alias("kind"),
            F.substring(key, 2, 12).cast("long").alias("start"),
            F.substring(key, 14, 12).cast("long").alias("end"),
            F.lit(base).alias("base"),
        )

    tagged = F.concat(
        F.transform("base", lambda k: F.concat(k, F.lit("b"))),
        F.transform("more", lambda k: F.concat(k, F.lit("m"))),
    )
    spans = F.transform(
        F.sort_array(tagged),
        lambda k: F.when(k.endswith("b"), span(k, True)).otherwise(span(k, False)),
    )
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c != spans_col]
    return keys.select(*kept, spans.alias(spans_col))


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with each finding's kind in brackets in its place; of overlapping findings the
    first names the kind. Texts without findings stay as they are."""
    text = F.col(text_col).cast("string")
    by_start = F.array_sort(
        F.transform(spans_col, lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )

    def step(a: Column, s: Column) -> Column:
        apart = s["start"] >= a["done"]
        gap = F.substr(text, (a["done"] + 1).cast("int"), (s["start"] - a["done"]).cast("int"))
        piece = F.concat(gap, F.lit("["), s["kind"], F.lit("]"))
        return F.struct(
            F.greatest(a["done"], s["end"]).alias("done"),
            F.when(apart, F.concat(a["out"], F.array(piece))).otherwise(a["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).cast("long").alias("done"), F.array().cast("array<string>").alias("out"))
    cleaned = F.aggregate(
        by_start,
        begin,
        step,
        lambda a: F.concat(
            F.array_join(a["out"], ""), F.substr(text, (a["done"] + 1).cast("int"), F.length(text))
        ),
    )
    return docs.withColumn(text_col, F.when(F.size(spans_col) > 0, cleaned).otherwise(text))
