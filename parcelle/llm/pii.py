"""Personal data by candidate generators and gradient boosting.

Base patterns (email, ip, card, phone) give the base spans: matches from left
to right that do not overlap, of which failing ones are dropped. Wider
generators propose further, overlapping candidates: spelled-out addresses,
phone numbers without a country, separated digit groups. Boosted trees score
every candidate from its format and its context, and a candidate beside the
base spans is added where its score reaches its kind's threshold.

What a wide candidate is, no base pattern can say, so the trees learn from
rewritten matches, each in its own context: a passing address with its ``@``
and dots spelled out, a phone number without its country and with other
separators, a card number in other groups; besides the wide candidates that
overlap a passing match of their kind. Against these stand the failing matches
and the other numbers of the texts. The validity of digits is a feature for
numbers only that must be valid (ip, card). Three quarters of the rows are
fitted; the last quarter sets each kind's threshold, the lowest score at which
at least ``PRECISION`` of its known candidates at or above it are right.

All features are small bins, so the training set is a histogram: one row per
combination of bins, at most ``4 * 5 * 6 * 5 * 2 * 5 * 5 * 2 * 2`` rows
a label and part for any input, all of it counted over the whole table. The trees are fitted to
that histogram on the driver and become one column expression; everything else
is DataFrame operations.

Positions are code points, ends exclusive. A pattern's matches are found as
pairs of a gap and a match, so that positions are running sums of lengths.
Possessive groups and look-behinds keep the patterns linear on long runs.
Defined results: NULL and empty texts have no spans; rows that repeat are
answered each; added spans may overlap one another, and one that lies inside
another is left out; without passing or without failing candidates nothing is
added to the base spans; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelle.llm.common import numbered, written

KINDS = ("email", "ip", "card", "phone")
#: Kind, what a text must hold to be searched, pattern.
BASE = (
    ("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
GENERATORS = (
    ("email", "", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}+){1,4}+"),
    ("ip", ".", r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+(?![0-9.])"),
    ("card", "", r"(?<![0-9])[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{1,7}(?![0-9])"),
    ("phone", "", r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
)
HINTS = r"(?i)(?:mail|contact|call|phone|tel|fax|mobile|card|visa|account|addr|server|host|login|ip)[^\n]*$"
FEATURES = ("kind", "size", "digits", "marks", "letters", "before", "after", "hint", "check")
#: Parts of the rows, one of which sets the thresholds.
FOLDS = 4
#: How an address is spelled out, a number separated.
AT_SIGNS = (" [at] ", "(at)", " (at) ", "[at]", " @ ")
DOTS = (" [dot] ", "(dot)", ".", " (dot) ", "[dot]")
GROUPS = ("($1) $2-$3", "$1-$2-$3", "$1.$2.$3", "$1 $2 $3", "($1) $2 $3")
SEPARATORS = (".", "-", " ", "")
ROUNDS = 24
RATE = 0.4
PRECISION = 0.995
CONTEXT = 24


def _matches(rows: DataFrame, patterns: tuple, wide: bool) -> DataFrame:
    """(row, kind, wide, start, end, match, before, after) of each match."""
    found = []
    for kind, needs, pattern in patterns:
        whole = rf"(?s)\G(.*?)({pattern})(?=(.?))"  # \G: one attempt after the last match
        part = lambda i, whole=whole: F.regexp_extract_all("text", F.lit(whole), F.lit(i))
        holds = F.col("text").contains(needs) if needs else F.col("text").rlike(r"[0-9@(\[]" if wide else "[0-9]")
        zipped = F.when(holds & F.col("text").rlike(pattern), F.arrays_zip(
            part(1).alias("gap"), part(2).alias("match"), part(3).alias("after")))
        found.append(rows.select("row", F.lit(KINDS.index(kind)).alias("kind"), F.posexplode(zipped).alias("i", "m")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    every = every.select(
        "row", "kind", "i", F.length("m.gap").alias("gap"), F.col("m.match").alias("match"),
        F.expr(f"right(m.gap, {CONTEXT})").alias("before"), F.col("m.after").alias("after"))
    along = Window.partitionBy("row", "kind").orderBy("i")
    return every.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(along)).select(
        "row", "kind", F.lit(int(wide)).alias("wide"), (F.col("end") - F.length("match")).alias("start"), "end",
        "match", "before", "after")


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0))
    terms = F.transform(F.filter(back, lambda d: d != ""), value)
    return F.aggregate(terms, F.lit(0), lambda s, x: s + x) % 10 == 0


def _passes() -> Column:
    """Whether a match passes its kind's check."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    short = lambda x: F.length(F.regexp_replace(x, "^0+", "")) <= 3
    parts = F.split("match", "\\.")
    ip = F.forall(parts, lambda x: short(x) & (F.expr("0") + F.right(x, F.lit(3)).try_cast("int") <= 255))
    return (
        F.when(F.col("kind") == 0, True).when(F.col("kind") == 1, F.coalesce(ip, F.lit(False)))
        .when(F.col("kind") == 2, F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def _bin(value: Column, *edges: int) -> Column:
    out = F.lit(len(edges))
    for i in range(len(edges) - 1, -1, -1):
        out = F.when(value < edges[i], i).otherwise(out)
    return out


def _sort_of(char: Column) -> Column:
    return (F.when(char == "", 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"\p{L}"), 2)
            .when(char.rlike("[0-9]"), 3).otherwise(4))


def _featured(found: DataFrame) -> DataFrame:
    n_digits = F.length(F.regexp_replace("match", "[^0-9]", ""))
    return found.withColumns({
        "check": F.when(F.col("kind").isin(1, 2), _passes().cast("int")).otherwise(0),
        "size": _bin(F.length("match"), 9, 13, 17, 25),
        "digits": _bin(n_digits, 1, 9, 12, 16, 20),
        "marks": _bin(F.length(F.regexp_replace("match", r"[\p{L}0-9]", "")), 1, 2, 3, 4),
        "letters": F.col("match").rlike(r"\p{L}").cast("int"),
        "hint": F.col("before").rlike(HINTS).cast("int"),
    }).withColumns({"before": _sort_of(F.expr("right(before, 1)")), "after": _sort_of(F.col("after"))})


@dataclass
class Boosted:
    """Depth-two trees: (feature, cut, (left feature, left cut), (right
    feature, right cut), four leaf values), prior, thresholds by kind."""

    prior: float
    trees: list[tuple]
    thresholds: list[float | None]

    def raw(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.prior)
        for j, cut, low, high, leaf in self.trees:
            left = x[:, j] < cut
            f += np.where(left, np.where(x[:, low[0]] < low[1], leaf[0], leaf[1]),
                          np.where(x[:, high[0]] < high[1], leaf[2], leaf[3]))
        return f

    def column(self) -> Column:
        f = F.lit(self.prior)
        for j, cut, low, high, leaf in self.trees:
            side = lambda split, a, b: F.when(F.col(FEATURES[split[0]]) < int(split[1]), float(a)).otherwise(float(b))
            f = f + F.when(F.col(FEATURES[j]) < int(cut), side(low, leaf[0], leaf[1])).otherwise(side(high, leaf[2], leaf[3]))
        return f


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """The best (gain, feature, cut) of weighted gradients."""
    best = (0.0, 0, 0)
    total = g.sum() ** 2 / (h.sum() + 1)
    for j in range(x.shape[1]):
        gs, hs = np.cumsum(np.bincount(x[:, j], g)), np.cumsum(np.bincount(x[:, j], h))
        gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - total
        k = int(np.argmax(gain))
        if gain[k] > best[0] + 1e-9:
            best = (float(gain[k]), j, k + 1)
    return best


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = ROUNDS, rate: float = RATE,
          held: np.ndarray | None = None) -> Boosted:
    """Fit to rows of bins ``x`` with labels ``y`` and counts ``w``; rows
    marked in ``held`` only set the thresholds (all do if none is)."""
    if held is not None and held.any():
        model = boost(x[~held], y[~held], w[~held], rounds, rate)
        seen = {kind for kind in range(len(KINDS)) if (held & (x[:, 0] == kind)).any()}
        model.thresholds = [None if kind in seen else t for kind, t in enumerate(model.thresholds)]
        return _calibrated(model, x[held], y[held], w[held]) if model.trees else model
    rate0 = float(np.clip((y * w).sum() / max(1.0, w.sum()), 1e-4, 1 - 1e-4))
    model = Boosted(float(np.log(rate0 / (1 - rate0))), [], [None] * len(KINDS))
    if len(np.unique(y)) < 2:
        return model
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-model.raw(x)))
        g, h = w * (y - p), w * p * (1 - p)
        _, j, cut = _split(x, g, h)
        left = x[:, j] < cut
        splits, leaf = [], []
        for side in (left, ~left):
            _, k, at = _split(x[side], g[side], h[side]) if side.any() else (0.0, 0, 0)
            splits.append((k, at))
            for part in (side & (x[:, k] < at), side & (x[:, k] >= at)):
                leaf.append(float(rate * g[part].sum() / (h[part].sum() + 1)))
        model.trees.append((j, cut, splits[0], splits[1], leaf))
    return _calibrated(model, x, y, w)


def _calibrated(model: Boosted, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Boosted:
    """Thresholds at ``PRECISION``, by kind."""
    f = model.raw(x)
    for kind in range(len(KINDS)):
        own = x[:, 0] == kind
        order = np.argsort(-f[own], kind="stable")
        score, right, count = f[own][order], (w * y)[own][order], w[own][order]
        last = np.append(score[1:] != score[:-1], True) if len(score) else np.zeros(0, bool)
        good = last & (np.cumsum(right) >= PRECISION * np.cumsum(count))
        if good.any():
            model.thresholds[kind] = float(score[good].min())
    return model


def _pick(options: tuple[str, ...], salt: str) -> Column:
    """One of the options, by the row and the match."""
    which = F.pmod(F.xxhash64("row", "start", "match", F.lit(salt)), F.lit(len(options))).cast("int")
    return F.element_at(F.array(*map(F.lit, options)), which + 1)


def _rewritten(found: DataFrame) -> DataFrame:
    """Passing base matches as a wide generator would meet them; those that
    it would not propose are left out."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    at = F.instr("match", "@")
    address = F.concat(F.expr("left(match, instr(match, '@') - 1)"), _pick(AT_SIGNS, "at"),
                       F.replace(F.substr("match", at + 1), F.lit("."), _pick(DOTS, "dot")))
    phone = F.regexp_replace(F.right(digits, F.lit(10)), F.lit("^(.{3})(.{3})(.{4})$"), _pick(GROUPS, "groups"))
    card = F.regexp_replace(digits, F.lit("([0-9]{4})(?=[0-9])"), F.concat(F.lit("$1"), _pick(SEPARATORS, "card")))
    other = F.when(F.col("kind") == 0, address).when(F.col("kind") == 2, card).when(F.col("kind") == 3, phone).otherwise(F.col("match"))
    whole = F.lit(False)
    for kind, _, pattern in GENERATORS:
        whole = whole | ((F.col("kind") == KINDS.index(kind)) & F.col("match").rlike(f"^(?:{pattern})$"))
    return found.withColumn("match", other).where(whole)


def _other_numbers(failing: DataFrame) -> DataFrame:
    """Failing card matches, digit runs of any kind, as no phone numbers,
    where the phone generator would not propose them."""
    wide = GENERATORS[KINDS.index("phone")][2]
    numbers = failing.where((F.col("kind") == KINDS.index("card")) & (F.length("match") >= 5))
    return numbers.where(~F.col("match").rlike(f"^(?:{wide})$")).withColumn("kind", F.lit(KINDS.index("phone")))


def _joined(spans: str) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def _known(found: DataFrame) -> DataFrame:
    """Candidates with a label ``y``, and whether their row is ``held``."""
    base, wide = found.where("wide = 0"), found.where("wide = 1")
    overlapping = wide.where("meets_own")
    failing = base.where("not right and not meets")
    parts = [(_rewritten(base.where("right")), 1), (overlapping, 1), (base.where("right and kind = 1"), 1), (failing, 0),
             (_other_numbers(failing), 0)]
    out = [part.select(*found.columns).withColumn("y", F.lit(y)) for part, y in parts]
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every.withColumn("held", (F.pmod(F.xxhash64("row", F.lit("fold")), F.lit(FOLDS)) == 0).cast("int"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, base, spans): arrays of (start, kind, end) by start and
    kind, the base spans alone and with the added ones."""
    source = numbered(docs, id_col, text_col)
    found = _matches(source, BASE, False).unionByName(_matches(source, GENERATORS, True))
    found = found.withColumn("right", (F.col("wide") == 0) & _passes())

    def meets(*by: str) -> Column:
        """Whether a span overlaps a right one."""
        along = Window.partitionBy(*by).orderBy("start")
        ahead, behind = along.rangeBetween(Window.unboundedPreceding, 0), along.rangeBetween(0, Window.unboundedFollowing)
        return (F.coalesce(F.max(F.when(F.col("right"), F.col("end"))).over(ahead) > F.col("start"), F.lit(False))
                | F.coalesce(F.min(F.when(F.col("right"), F.col("start"))).over(behind) < F.col("end"), F.lit(False)))

    found = found.withColumns({"meets": meets("row"), "meets_own": meets("row", "kind")})
    found = written(found, "candidates")
    known = _known(found)
    counts = _featured(known).groupBy(*FEATURES, "y", "held").agg(F.count(F.lit(1)).alias("w")).orderBy(*FEATURES, "y", "held").collect()
    table = np.array([tuple(r) for r in counts], dtype=np.int64).reshape(-1, len(FEATURES) + 3)
    model = boost(table[:, :-3], table[:, -3].astype(float), table[:, -1].astype(float), held=table[:, -2] == 1)
    limit = F.lit(None).cast("double")
    for kind, threshold in enumerate(model.thresholds):
        if threshold is not None:
            limit = F.when(F.col("kind") == kind, threshold - 1e-9).otherwise(limit)
    beside = _featured(found.where((F.col("wide") == 1) & ~F.col("meets")))
    added = beside.where(model.column() >= limit).select("row", "start", "end", "kind")
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("reach", F.max("end").over(earlier)).where("reach is null or reach < end")  # else inside another
    span = F.struct("start", "kind", "end")
    spans = (
        found.where("right").select("row", span.alias("span"), F.lit(True).alias("base"))
        .unionByName(added.select("row", span.alias("span"), F.lit(False).alias("base")))
        .groupBy("row").agg(  # of one text
            F.array_sort(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
            F.array_sort(F.collect_list("span")).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return source.select("row", "doc_id").join(spans, "row", "left").select(
        "row", "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return _joined(spans)
