"""Personal data: generators propose spans, boosted trees over format and context choose what is added to the base rules."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, free_names, materialise, packed, unpacked, without

#: Kinds of the base rules in order; the base rules, loops possessive so that long runs need no stack.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: All kinds that are proposed: those of the base rules, and keys and tokens.
PROPOSED = (*KINDS, "secret")
#: High-recall generators: spelt-out signs, other separators, missing prefixes, too few or too many parts, long tokens.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:(?:\.|\[\.\]|\x20\.\x20)[0-9]{1,4}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9]){11,22}+",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]{1,4}+\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}+\)?){1,5}+(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
}
#: What a text must contain for a generator or base rule to match anything in it.
HINTS = {"email": r"[@\]\)]", "ip": r"[0-9](?:\[|\x20)?\.", "card": r"[0-9](?:[\x20._/-]?[0-9]){11}", "phone": r"[0-9][\x20()./-]{1,4}[0-9]|\+[0-9]", "secret": r"[A-Za-z0-9_+/=-]{20}"}
#: Words before a proposal that speak for its kind.
CONTEXT = {"email": r"mail|e-post|courriel|correo|contact", "ip": r"\bip\b|host|server|addr", "card": r"card|carte|karte|tarjeta|visa|pay", "phone": r"phone|tel|call|mobil|fax", "secret": r"token|key|secret|passw|auth|bearer"}
#: Calling codes of one and two digits, and the first two digits of those of three.
CALLING_CODES = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21|22|23|24|25|26|29|35|37|38|42|50|59|67|68|69|80|85|87|88|96|97|99)"
#: Boosting: trees, their depth, the step.
TREES, DEPTH, STEP = 24, 2, 0.4
#: A kind's threshold is the least score from which this share of the proposals that pass the kind's check is real, and in each band of scores most are.
PRECISION, LIKELY = 0.9, 0.5
#: How many of the look-alikes of a kind pass its check by chance (one digit in ten makes a number pass Luhn).
CHANCE = {"email": 0.5, "ip": 0.3, "card": 0.1, "phone": 0.5, "secret": 0.05}
#: One document in so many calibrates the thresholds; the others grow the trees.
CALIBRATES = 3
#: Features of a proposal and their numbers of values; their product bounds the table from which the trees are grown. None tells what a kind's check looks at.
FEATURES = {"kind": 5, "length": 6, "signs": 6, "groups": 5, "spelt": 2, "prefix": 3, "before": 3, "after": 3, "context": 3}
#: A noncharacter that sets off matches; in a text it becomes the replacement character, which no rule looks for.
_MARK, _OTHER = "﷐", "�"
_CONTEXT_CHARS = 24
#: Positions and running values are made in blocks of so many, so that arrays that grow are short.
_BLOCK = 256
_PLACED = "struct<name:string,start:int,end:int,kind:int>"
_FOUND = "struct<start:int,end:int,found:string,before:string,after:string>"


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _scan(items: Column, first: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """An array as long as items: step takes the state and an item, and gives the next state and the new item, which has type kind.

    items should be a column, since it is evaluated once per block.
    """

    def one(acc: Column, x: Column) -> Column:
        state, value = step(acc["s"], x)
        return F.struct(state.alias("s"), F.concat(acc["o"], F.array(value)).alias("o"))

    def block(acc: Column, xs: Column) -> Column:
        begun = F.struct(acc["last"]["s"].alias("s"), _none(kind).alias("o"))
        return F.struct(F.aggregate(xs, begun, one).alias("last"), F.concat(acc["done"], F.array(acc["last"]["o"])).alias("done"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int")), lambda b: F.slice(items, b * _BLOCK + 1, _BLOCK))
    start = F.struct(F.struct(first.alias("s"), _none(kind).alias("o")).alias("last"), _none(f"array<{kind}>").alias("done"))
    out = F.aggregate(blocks, start, block, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["last"]["o"]))))
    return F.when(F.size(items) > 0, out).otherwise(_none(kind))


def _pieces(marked: Column, pattern: str, hint: str) -> Column:
    """A text as what is before the first match, the match, what is before the second, and so on; empty without a match."""
    cut = F.split(F.regexp_replace(marked, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    return F.when(marked.rlike(hint), cut).otherwise(F.array().cast("array<string>"))


def _matches(pieces: Column) -> Column:
    """Per match its text, its length, the length of what is between it and the one before, and some text on either side."""

    def one(i: Column) -> Column:
        before, found = F.get(pieces, 2 * i), F.get(pieces, 2 * i + 1)
        return F.struct(F.char_length(before).alias("gap"), F.char_length(found).alias("n"), found.alias("found"), F.right(before, F.lit(_CONTEXT_CHARS)).alias("before"), F.left(F.get(pieces, 2 * i + 2), F.lit(1)).alias("after"))

    return F.when(F.size(pieces) > 1, F.transform(F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int") - 1), one)).otherwise(_none("struct<gap:int,n:int,found:string,before:string,after:string>"))


def _positioned(matches: Column) -> Column:
    """Matches with their places in code points."""

    def step(at: Column, m: Column) -> tuple[Column, Column]:
        start = at + m["gap"]
        return start + m["n"], F.struct(start.alias("start"), (start + m["n"]).alias("end"), m["found"].alias("found"), m["before"].alias("before"), m["after"].alias("after"))

    return _scan(matches, F.lit(0), _FOUND, step)


def _spans(docs: DataFrame, text: str, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """docs with one array of matches, leftmost and non-overlapping, for each name of wanted (pattern, hint)."""
    own = without(docs, *wanted)
    (t,) = free_names(docs, "_marked")
    marked = docs.select(*own, F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _MARK, _OTHER).alias(t))
    cut = marked.select(*own, *[_pieces(F.col(t), pattern, hint).alias(n) for n, (pattern, hint) in wanted.items()])
    return cut.select(*own, *[_matches(F.col(n)).alias(n) for n in wanted]).select(*own, *[_positioned(F.col(n)).alias(n) for n in wanted])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _octets(found: Column) -> Column:
    return F.forall(F.split(found, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))


def holds(kind: str, found: Column) -> Column:
    """Whether a match of a base rule passes the rule's check."""
    n = F.char_length(_digits(found))
    if kind == "ip":
        return _octets(found)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(found))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def passes(kind: str, found: Column) -> Column:
    """Whether a proposal passes its kind's check once it is normalised: signs spelt out, separators and missing prefixes put right.

    A mail address has a top-level domain of letters, an address four octets, a card 12 to 19 digits and Luhn's sum, a
    phone number 10 to 15 digits that begin with a calling code, or 10; a secret mixes letters and digits.
    """
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(F.lower(found), r"\x20?[\(\[]at[\)\]]\x20?", "@"), r"\x20?[\(\[]dot[\)\]]\x20?", ".")
        domain = F.substring_index(F.regexp_replace(plain, r"\x20", ""), "@", -1)
        return F.contains(domain, F.lit(".")) & ~F.contains(domain, F.lit("..")) & F.substring_index(domain, ".", -1).rlike("^[a-z]{2,24}$")
    if kind == "ip":
        return _octets(F.regexp_replace(found, r"[\[\]\x20]", ""))
    digits = _digits(found)
    n = F.char_length(digits)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        plain = F.regexp_replace(digits, "^00", "")
        return F.char_length(plain).between(10, 15) & (plain.rlike(CALLING_CODES) | (F.char_length(plain) == 10))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(found, "[0-9]+", "0"), "[A-Za-z]+", "a"), "[^0a]", "").rlike("(?:0a){4}")


def _described(kind: str, c: Column) -> Column:
    """A proposal with its binned features and whether it passes its check."""
    found, n = c["found"], F.char_length(c["found"])
    has = lambda s: F.contains(found, F.lit(s)).cast("int")
    beside = lambda s: F.when(F.char_length(s) == 0, 0).when(s.rlike(r"^\s$"), 0).when(s.rlike(r"^[\p{L}\p{N}]$"), 1).otherwise(2)
    several = has(" ") + has("-") + has(".") + has("(")
    signs = F.when(several > 1, 5).when(has(" ") == 1, 1).when(has("-") == 1, 2).when(has(".") == 1, 3).when(has("(") == 1, 4).otherwise(0)
    elsewhere = "|".join(w for k, w in CONTEXT.items() if k != kind)
    return F.struct(
        F.lit(kind).alias("name"), c["start"].alias("start"), c["end"].alias("end"), F.lit(PROPOSED.index(kind)).alias("kind"),
        sum((n > edge).cast("int") for edge in (8, 12, 16, 20, 32)).alias("length"), signs.alias("signs"), F.least(F.size(F.split(found, "[^A-Za-z0-9]+")) - 1, F.lit(4)).alias("groups"),
        found.rlike(r"(?i)[\(\[](?:at|dot|\.)[\)\]]|\x20[.@]|@\x20").cast("int").alias("spelt"), F.when(found.rlike(r"^(?:\+|00)"), 1).when(found.rlike(r"^\("), 2).otherwise(0).alias("prefix"),
        beside(F.right(c["before"], F.lit(1))).alias("before"), beside(c["after"]).alias("after"),
        F.when(c["before"].rlike(f"(?i){CONTEXT[kind]}"), 2).when(c["before"].rlike(f"(?i){elsewhere}"), 1).otherwise(0).alias("context"), passes(kind, found).alias("passes"),
    )


def _place(kind: str):
    return lambda c: F.struct(F.lit(kind).alias("name"), c["start"].alias("start"), c["end"].alias("end"), F.lit(PROPOSED.index(kind)).alias("kind"))


def _kept(kind: str):
    return lambda c: holds(kind, c["found"])


def _describe(kind: str):
    return lambda c: _described(kind, c)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with base (spans of the base rules), wide (proposals with features) and calibrates (whether the text sets thresholds).

    base is in the order of start and kind. wide has every proposal that is a base span (is_base) or overlaps none, in the
    order of start and kind, the longer first; proposals of several generators may overlap. Places are code points.

    A null text is an empty one and has no spans. Texts are handled whole, in time that grows with their length and the
    number of their matches. Rows are independent, so that repeated rows have equal results. An empty table gives no
    rows. Columns of docs that are called base, wide or calibrates are replaced.
    """
    own = without(docs, "base", "wide", "calibrates")
    names = {(k, x): f"_{x}_{k}" for x, kinds in (("base", KINDS), ("wide", PROPOSED)) for k in kinds}
    names = dict(zip(names, free_names(docs, *names.values()), strict=True))
    b, a, w, c = free_names(docs, "_b", "_all", "_reached", "_next")
    found = _spans(docs.select(*own, F.col(f"`{text}`").alias(b)), b, {n: ((BASE if x == "base" else WIDE)[k], HINTS[k]) for (k, x), n in names.items()})
    base = [F.transform(F.filter(names[k, "base"], _kept(k)), _place(k)) for k in KINDS]
    wide = [F.transform(names[k, "wide"], _describe(k)) for k in PROPOSED]
    held = [F.transform(F.filter(names[k, "base"], _kept(k)), _describe(k)) for k in KINDS]  # base spans are proposals too
    order = lambda c, is_base: F.struct(c["start"].alias("start"), (-c["end"]).alias("last"), c["kind"].alias("kind"), is_base.alias("rank"), c.alias("c"))
    merged = F.array_sort(F.concat(F.transform(F.concat(*held), lambda c: order(c, F.lit(0))), F.transform(F.concat(*wide), lambda c: order(c, F.lit(1)))))
    out = found.select(*own, F.array_sort(F.transform(F.concat(*base), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["name"].alias("name")))).alias(b), merged.alias(a), (F.pmod(F.xxhash64(b), F.lit(CALIBRATES)) == 0).alias("calibrates"))

    is_base = lambda x: x["rank"] == 0
    reached = _scan(F.col(a), F.lit(0), "int", lambda s, x: (F.when(is_base(x), F.greatest(s, -x["last"])).otherwise(s), s))
    onward = F.reverse(_scan(F.reverse(F.col(a)), F.lit(2**31 - 1), "int", lambda s, x: (F.when(is_base(x), x["start"]).otherwise(s), s)))
    out = out.select(*own, b, a, "calibrates", F.when(F.size(b) > 0, reached).otherwise(_none("int")).alias(w), F.when(F.size(b) > 0, onward).otherwise(_none("int")).alias(c))

    def stays(z: Column, i: Column) -> Column:
        x, before = z[a], F.get(F.col(a), i - 1)
        again = (i > 0) & (before["start"] == x["start"]) & (before["last"] == x["last"]) & (before["kind"] == x["kind"])
        apart = (F.coalesce(z[w], F.lit(0)) <= x["start"]) & (F.coalesce(z[c], F.lit(2**31 - 1)) >= -x["last"])
        return ~again & (is_base(x) | apart)

    # zipped, so that each array is made once: inside a lambda it would be made for each element
    proposals = F.transform(F.filter(F.arrays_zip(a, w, c), stays), lambda z: z[a]["c"].withField("is_base", is_base(z[a])))
    placed = F.transform(F.col(b), lambda x: F.struct(x["name"].alias("name"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return out.select(*own, placed.alias("base"), proposals.alias("wide"), "calibrates")


class Trees:
    """Boosted trees over binned features, and a threshold per kind."""

    def __init__(self, prior: float, trees: list, thresholds: list[float]):
        self.prior, self.trees, self.thresholds = prior, trees, thresholds

    def score(self, c: Column) -> Column:
        def value(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, at, low, high = tree
            return F.when(c[name] <= at, value(low)).otherwise(value(high))

        raw = F.lit(self.prior)
        for tree in self.trees:
            raw = raw + value(tree)
        return 1 / (1 + F.exp(-raw))

    def accepts(self, c: Column) -> Column:
        """Whether a proposal passes its check and scores high enough for it not to do so by chance."""
        return c["passes"] & (self.score(c) >= F.element_at(F.lit([float(x) for x in self.thresholds]), c["kind"] + 1))


def _threshold(scores: np.ndarray, right: np.ndarray, n: np.ndarray, chance: float) -> float:
    """The least score with PRECISION among all proposals from it on, and LIKELY in each band of scores; 2 without one.

    Bands are those of isotonic regression: scores are pooled until the share that passes falls from band to band. They are
    judged apart too, so that many real ones with high scores don't carry along those that pass by chance.
    """
    bands: list[list[float]] = []  # passed, all, least score
    for score, p, t in zip(scores, right, n, strict=True):
        bands.append([float(p), float(t), float(score)])
        while len(bands) > 1 and (bands[-2][2] == bands[-1][2] or bands[-1][0] * bands[-2][1] >= bands[-2][0] * bands[-1][1]):
            p2, t2, low = bands.pop()
            bands[-1] = [bands[-1][0] + p2, bands[-1][1] + t2, low]
    found, passed, total = 2.0, 0.0, 0.0
    precise = lambda p, t, least: p > 0 and p - chance * t >= least * p * (1 - chance)
    for p, t, low in bands:
        passed, total = passed + p, total + t
        if not precise(p, t, LIKELY):
            break
        found = low - 1e-9 if precise(passed, total, PRECISION) else found
    return found


def grow(table: list[tuple]) -> Trees:
    """Trees from rows of feature values, calibrates, how many pass and how many there are: one row per distinct combination.

    Gradient boosting with logistic loss; a leaf's value is a damped Newton step. With p of the calibrating proposals
    from a score on passing, c of which do so by chance among those that are not real, (p - c) / (p (1 - c)) of those that
    pass are real. _threshold sets a kind's. A kind without calibrating proposals is not added.
    """
    names = list(FEATURES)
    x = np.array([r[: len(names)] for r in table], dtype=int).reshape(len(table), len(names))
    held = np.array([r[-3] for r in table], dtype=bool)
    pos, n = np.array([r[-2] for r in table], dtype=float), np.array([r[-1] for r in table], dtype=float)
    own, seen = pos * ~held, n * ~held
    if not seen.sum():
        return Trees(0.0, [], [2.0] * len(PROPOSED))
    rate = min(max(own.sum() / seen.sum(), 1e-3), 1 - 1e-3)
    prior = math.log(rate / (1 - rate))
    raw, trees = np.full(len(x), prior), []

    def node(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        leaf = float(STEP * g[rows].sum() / (h[rows].sum() + 1.0))
        best = (1e-6, None)
        for j in range(len(names) if depth else 0):
            for at in np.unique(x[rows, j])[:-1]:
                low = rows & (x[:, j] <= at)
                high = rows & ~low
                gain = g[low].sum() ** 2 / (h[low].sum() + 1) + g[high].sum() ** 2 / (h[high].sum() + 1) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
                if gain > best[0]:
                    best = (gain, (j, int(at), low, high))
        if best[1] is None:
            raw[rows] += leaf
            return leaf
        j, at, low, high = best[1]
        return (names[j], at, node(low, g, h, depth - 1), node(high, g, h, depth - 1))

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        trees.append(node(np.ones(len(x), dtype=bool), own - seen * p, seen * p * (1 - p), DEPTH))
    p = 1 / (1 + np.exp(-raw))
    thresholds = []
    for k, name in enumerate(PROPOSED):
        mine = held & (x[:, 0] == k)
        order = np.argsort(-p[mine], kind="stable")
        thresholds.append(_threshold(p[mine][order], pos[mine][order], n[mine][order], CHANCE[name]))
    return Trees(prior, trees, thresholds)


def fit(found: DataFrame) -> Trees:
    """Trees from all proposals of candidates(): those that pass their kind's check are positive, the others negative.

    No feature tells what the checks look at (digits, octets, top-level domains), so trees learn in which formats and
    contexts proposals are real. Proposals are counted by feature values on the executors; the driver gets one row
    per combination that occurs, of which there are at most twice the product of FEATURES.
    """
    each = found.select("calibrates", F.explode("wide").alias("c")).select("calibrates", *[F.col("c")[n].alias(n) for n in FEATURES], F.col("c.passes").cast("long").alias("y"))
    rows = each.groupBy(*FEATURES, "calibrates").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy(*FEATURES, "calibrates").collect()
    return grow([tuple(r) for r in rows])


def detect(found: DataFrame, trees: Trees) -> DataFrame:
    """found with added: accepted proposals that are no base spans, the earliest and then the longest of those that overlap.

    found is the result of candidates(), whose handling of awkward rows holds here too. A column added is replaced.
    """
    own, (n,) = without(found, "added"), free_names(found, "_accepted")
    step = lambda at, c: (F.when(c["start"] >= at, c["end"]).otherwise(at), F.struct(c["name"].alias("name"), c["start"].alias("start"), F.when(c["start"] >= at, c["end"]).otherwise(-1).alias("end"), c["kind"].alias("kind")))
    marked = found.select(*own, F.filter("wide", lambda c: ~c["is_base"] & trees.accepts(c)).alias(n))
    return marked.select(*own, F.filter(_scan(F.col(n), F.lit(0), _PLACED, step), lambda c: c["end"] >= 0).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end by start and then kind, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["name"].alias("name"))))
    return F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["name"], c["start"].cast("string"), c["end"].cast("string"))), ",")


def redact(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """docs with redacted: each base and added span replaced by its kind in brackets; of spans that overlap, the first names the place.

    A null text stays null. A column redacted is replaced; all others are returned as they were.
    """
    row, t, spans, parts = "row", "text", "spans", "parts"
    found = detect(candidates(docs.select(packed(docs), F.col(f"`{text}`").alias(t)), t), trees)
    ordered = F.array_sort(F.transform(F.concat("base", "added"), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["name"].alias("name"))))

    def step(at: Column, c: Column) -> tuple[Column, Column]:
        gap = F.substr(F.col(t), at + 1, F.greatest(c["start"] - at, F.lit(0)))
        return F.greatest(at, c["end"]), F.when(c["start"] >= at, F.concat(gap, F.lit("["), c["name"], F.lit("]"))).otherwise(F.lit(""))

    cut = found.select(row, t, ordered.alias(spans))
    cut = cut.select(row, t, spans, _scan(F.col(spans), F.lit(0), "string", step).alias(parts))
    rest = F.substr(F.col(t), F.coalesce(F.array_max(F.transform(spans, lambda c: c["end"])), F.lit(0)) + 1, F.char_length(t))
    done = cut.select(row, F.concat(F.array_join(parts, ""), rest).alias("redacted"))
    return done.select(*unpacked(docs, "redacted"))


def op3_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans with those that the trees add."""
    found = materialise(candidates(documents(spark, sf_dir, "doc_id", "text")).drop("text"), "pii-candidates")
    out = detect(found, fit(found))
    n = lambda k: F.size(F.filter("base", lambda c: c["name"] == k)).cast("long").alias(f"n_{k}")
    spans = F.concat("base", "added")
    return out.select("doc_id", *[n(k) for k in KINDS], F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"), F.size("added").cast("long").alias("n_added"), F.size(spans).cast("long").alias("n_spans"))
