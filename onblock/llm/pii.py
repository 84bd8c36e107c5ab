"""Personal data: generators propose spans, boosted trees score their format and context, calibrated thresholds select.

All of it is column expressions; a text is searched and scored within its own row, and trees are turned into CASE expressions. The strict
patterns of every kind with their checks give the base spans, which always stay. Wider patterns look between and inside what the
strict ones left, so they never overlap a base span of their kind. Trees learn on all candidates of the corpus, summed up by their
features, from the outcome of the checks; a threshold per kind is the lowest score from which enough candidates hold.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import carried, quoted, settle, unpacked

KINDS = ["email", "ip", "card", "phone"]

# The strict patterns. Possessive repeats and the look-behinds only spare Java the useless starts within a run.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,6}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{2,4})(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: What a text must hold for a kind to be looked for at all.
TELLTALE = {"email": r"@|[\[(]at[\])]| at ", "ip": r"[0-9]\.[0-9]|:[0-9A-Fa-f]+:", "card": r"[0-9]", "phone": r"[0-9]"}
HINTS = r"(?i)(mail|phone|tel|fax|call|mobile|card|visa|iban|account|contact|address|\bip\b|host|kontakt|tarjeta|carte)"
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 8}
BEFORE, AFTER = 24, 8
CHUNK = 512
PRECISION = 0.98
ROUNDS, DEPTH = 12, 3
FOLDS = 4
FEATURES = "kind length digits letters dots hyphens spaces brackets plus at runs luhn octets joined_before joined_after hint".split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(lengths: Column) -> Column:
    """Running sums of an array of longs. Sums are built in chunks, so that arrays of many entries are not copied for every entry."""
    zero = F.array(F.lit(0).cast("long"))
    sums = lambda part: F.aggregate(part, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")), lambda k: F.slice(lengths, k * CHUNK + 1, CHUNK))
    shifted = lambda inner: F.zip_with(
        inner, F.slice(sums(F.transform(inner, lambda c: F.element_at(c, -1))), 1, F.size(inner)), lambda c, base: F.transform(F.slice(c, 2, F.size(c)), lambda x: x + base)
    )
    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(F.transform(chunks, sums), lambda inner: F.flatten(shifted(inner))))


def _cut(text: Column, pattern: str) -> Column:
    return F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces"))


def _ends(cut: Column) -> Column:
    """Where the matches end, in code points from the start of what was cut."""
    whole = F.zip_with(F.slice(cut["pieces"], 1, F.size(cut["found"])), cut["found"], lambda p, f: (F.length(p) + F.length(f)).cast("long"))
    return let(whole, running_sums)


def _spans(cut: Column, ends: Column, offset: Column, kind: str, strict: bool) -> Column:
    return F.transform(
        cut["found"],
        lambda f, i: F.struct(
            (offset + F.get(ends, i) - F.length(f)).alias("start"),
            (offset + F.get(ends, i)).alias("end"),
            f.alias("span"),
            F.right(F.get(cut["pieces"], i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(cut["pieces"], i + 1), F.lit(AFTER)).alias("after"),
            F.lit(strict).alias("strict"),
            (valid(kind, f) if strict else plausible(kind, f)).alias("ok"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    reversed_digits = F.split(F.reverse(digits), "")
    doubled = lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    values = F.transform(F.filter(reversed_digits, lambda c: c != ""), lambda c, i: doubled(c.cast("int"), i))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, span: Column) -> Column:
    """The checks of the base: nothing for an email, parts up to 255, 14 to 19 digits with Luhn, 10 to 15 digits."""
    digits = F.regexp_replace(span, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        too_large = lambda n: (F.length(n) > 3) | F.coalesce(F.left(n, F.lit(3)).try_cast("int") > 255, F.lit(True))
        return ~F.exists(F.split(span, r"\."), lambda part: too_large(F.regexp_replace(part, "^0+(?=.)", "")))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    return F.length(digits).between(10, 15)


def plausible(kind: str, span: Column) -> Column:
    """The label of a wide span: written out as an address, a full address of eight groups, or the check of its kind."""
    if kind == "email":
        return span.rlike(r"[\[(]at[\])]")
    return F.lit(True) if kind == "ip" else valid(kind, span)


CANDIDATE = "array<struct<start: bigint, end: bigint, span: string, before: string, after: string, strict: boolean, ok: boolean>>"


def candidates(text: Column, kind: str) -> Column:
    """All proposals of a kind: the strict matches, and wide ones between them and inside those that fail their check.

    Each is a struct of start and end (code points, end exclusive), the span, what stands before and after it, whether it comes from the
    strict pattern and whether its check holds. Every character is looked at a fixed number of times.
    """
    wide = lambda part, offset: let(_cut(part, WIDE[kind]), lambda cut: let(_ends(cut), lambda ends: _spans(cut, ends, offset, kind, False)))

    def proposed(cut: Column, ends: Column) -> Column:
        first = F.lit(0).cast("long")
        between = F.transform(cut["pieces"], lambda piece, i: wide(piece, F.when(i == 0, first).otherwise(F.get(ends, i - 1))))
        inside = lambda strict: F.transform(F.filter(strict, lambda c: ~c["ok"]), lambda c: wide(c["span"], c["start"]))
        return let(_spans(cut, ends, first, kind, True), lambda strict: F.concat(strict, F.flatten(between), F.flatten(inside(strict))))

    found = let(_cut(text, STRICT[kind]), lambda cut: let(_ends(cut), lambda ends: proposed(cut, ends)))
    return F.when(text.rlike(TELLTALE[kind]), found.cast(CANDIDATE)).otherwise(F.array().cast(CANDIDATE))


def features(kind: str, c: Column) -> list[Column]:
    """Format and context of a candidate as numbers, in the order of FEATURES."""
    span = c["span"]
    count = lambda kinds: F.length(F.regexp_replace(span, f"[^{kinds}]", ""))
    digits = F.regexp_replace(span, "[^0-9]", "")
    octets = valid("ip", span) & span.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return [
        F.lit(float(KINDS.index(kind))),
        *[x.cast("double") for x in (F.length(span), F.length(digits), count("A-Za-z"), count("."), count("-"), count(r"\x20"), count(r"()\[\]"), count("+"), count("@"))],
        F.regexp_count(span, F.lit("[0-9]+")).cast("double"),
        F.when(F.length(digits).between(2, 40), luhn(digits)).otherwise(False).cast("double"),
        octets.cast("double"),
        c["before"].rlike(r"[\p{L}0-9]$").cast("double"),
        c["after"].rlike(r"^[\p{L}0-9]").cast("double"),
        c["before"].rlike(HINTS).cast("double"),
    ]


def _worth_scoring(kind: str, c: Column) -> Column:
    return F.length(F.regexp_replace(c["span"], "[^0-9]", "")) >= LEAST_DIGITS[kind]


class Selector:
    """Boosted trees as nested conditions, and a threshold for each kind."""

    def __init__(self, trees: list[tuple[float, dict[int, tuple]]], thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def _tree(self, nodes: dict[int, tuple], at: int, x: list[Column]) -> Column:
        prediction, left, right, feature, threshold = nodes[at]
        if left < 0:
            return F.lit(prediction)
        return F.when(x[feature] <= threshold, self._tree(nodes, left, x)).otherwise(self._tree(nodes, right, x))

    def score(self, x: list[Column]) -> Column:
        margin = reduce(lambda a, b: a + b, [F.lit(weight) * self._tree(nodes, 0, x) for weight, nodes in self.trees])
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, kind: str, c: Column) -> Column:
        """Features are worked out once for a candidate, as an array that the conditions look into."""
        if not self.trees or kind not in self.thresholds:
            return F.lit(False)
        scored = lambda x: self.score([F.get(x, F.lit(i)) for i in range(len(FEATURES))]) >= self.thresholds[kind]
        return _worth_scoring(kind, c) & let(F.array(*features(kind, c)), scored)


def fit(docs: DataFrame, text: str = "text") -> Selector:
    """Trees and thresholds from all candidates of the corpus.

    Candidates are summed up by features and outcome, a quarter of them (by a hash of the span) for the thresholds. A threshold is the
    lowest score, in hundredths, from which PRECISION of the candidates of its kind pass their check; a kind without any gets none, and nothing
    is added to the base where candidates are all alike in outcome. The driver gets the nodes of the trees and 101 counts a kind.
    """
    content = F.coalesce(quoted(text), F.lit(""))
    found = docs.select(*[candidates(content, kind).alias(kind) for kind in KINDS])

    def vectors(kind: str) -> Column:
        later = lambda c: F.pmod(F.xxhash64(c["span"]), F.lit(FOLDS)) == 0
        row = lambda c: F.struct(F.array(*features(kind, c)).alias("x"), c["ok"].alias("ok"), later(c).alias("later"))
        return F.transform(F.filter(kind, lambda c: _worth_scoring(kind, c)), row)

    rows = [vectors(kind) for kind in KINDS]
    exploded = found.select(F.explode(F.concat(*rows)).alias("c")).select("c.*")
    table = settle(exploded.groupBy("x", "ok", "later").agg(F.count("*").alias("n")), "pii-candidates")
    table = table.select(*[F.get("x", F.lit(i)).alias(name) for i, name in enumerate(FEATURES)], F.col("ok").cast("double").alias("label"), "later", F.col("n").cast("double").alias("n"))
    train = table.filter("not later")
    if train.select("label").distinct().count() < 2:
        return Selector([], {})
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="x")
    booster = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=64, stepSize=0.4, seed=1)
    model = booster.fit(assembler.transform(train.coalesce(4)))
    selector = Selector([(weight, _nodes(tree)) for weight, tree in zip(model.treeWeights, model.trees, strict=True)], {})
    scored = table.filter("later").select("kind", F.round(100 * selector.score([F.col(name) for name in FEATURES])).cast("int").alias("bin"), "label", "n")
    bins = scored.groupBy("kind", "bin").agg(F.sum(F.col("label") * F.col("n")), F.sum("n")).collect()
    for number, kind in enumerate(KINDS):
        good = total = 0.0
        for _, at, ok, n in sorted((row for row in bins if row["kind"] == number), key=lambda row: -row["bin"]):
            good, total = good + ok, total + n
            if good >= PRECISION * total:
                selector.thresholds[kind] = (at - 0.5) / 100
    return selector


def _nodes(tree) -> dict[int, tuple]:
    """The nodes of a fitted tree by their place in it: prediction, left, right, feature, threshold."""
    nodes: dict[int, tuple] = {}

    def walk(node) -> int:
        at = len(nodes)
        nodes[at] = (node.prediction(), -1, -1, -1, 0.0)
        if node.subtreeDepth() > 0:
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            nodes[at] = (node.prediction(), left, right, split.featureIndex(), split.threshold())
        return at

    walk(tree._call_java("rootNode"))
    return nodes


def spans(text: Column, selector: Selector) -> Column:
    """The personal data of a whole text, sorted by start and then kind: start, kind (its number in KINDS), end, base."""
    entry = "array<struct<start: bigint, kind: int, end: bigint, base: boolean>>"

    def chosen(kind: str) -> Column:
        keep = F.filter(candidates(text, kind), lambda c: F.when(c["strict"], c["ok"]).otherwise(selector.accepts(kind, c)))
        return F.transform(keep, lambda c: F.struct(c["start"], F.lit(KINDS.index(kind)).alias("kind"), c["end"], c["strict"].alias("base"))).cast(entry)

    return F.sort_array(F.concat(*[chosen(kind) for kind in KINDS]))


def find(docs: DataFrame, selector: Selector, text: str = "text") -> DataFrame:
    """Adds `spans` to every row. Null and empty texts have none; repeated rows are searched each; a column of that name is replaced."""
    found = docs.select(carried(docs).alias("row"), spans(F.coalesce(quoted(text), F.lit("")), selector).alias("found"))
    return unpacked(found, "row", docs.columns, {"spans": F.col("found")})


def redacted(text: Column, found: Column) -> Column:
    """The text with every run of overlapping spans replaced by the kind of its first, in capitals and brackets."""
    runs_of = "array<struct<start: bigint, end: bigint, kind: int>>"

    def merge(runs: Column, s: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        new = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        overlaps = (F.size(runs) > 0) & (s["start"] < last["end"])
        return F.when(overlaps, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(new)))

    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    cut = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))

    def joined(runs: Column) -> Column:
        start = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(runs, i - 1)["end"])
        parts = F.transform(runs, lambda r, i: F.concat(cut(start(i), r["start"]), F.get(names, r["kind"])))
        tail = cut(F.get(runs, F.size(runs) - 1)["end"], F.length(text).cast("long"))
        return F.concat(F.array_join(parts, ""), tail)

    merged = F.aggregate(found, F.array().cast(runs_of), merge)
    return F.when(F.size(found) > 0, let(merged, joined)).otherwise(text)


def redact(docs: DataFrame, selector: Selector, text: str = "text") -> DataFrame:
    """The rows of docs with personal data replaced in the text; null texts stay null. Other columns are as they were."""
    own = quoted(text)
    safe = F.coalesce(own, F.lit(""))
    found = docs.select(carried(docs).alias("row"), own.alias("own"), spans(safe, selector).alias("found"))
    new = F.when(F.col("own").isNotNull(), redacted(F.col("own"), F.col("found")))
    return found.select(*[(new if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
