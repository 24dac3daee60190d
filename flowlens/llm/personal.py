"""Personal data: patterns with checks, and gradient-boosted candidates.

Base spans of four kinds come from patterns and checks alone. Besides, generators with high recall propose spans that may
overlap. A code of IBAN form is added where its checksum holds, whatever was learnt. Boosted trees weigh the format of the other
proposals and the words around them. They learn on all texts which proposals meet a base span or have words to the left that name
such data (contact words for addresses and numbers, words for secrets for codes); trees don't see these words. Proposals with equal
features, label and part are one example with their number as its weight. On held-back proposals
each generator gets the lowest threshold whose precision is PRECISION or better, both of all proposals over it and of those that meet
no base span; what no word names counts as wrong there, so precision is not overstated by data the base knows. No such threshold, no
spans of that generator by the trees. Proposals over it that meet no base span are added. The trees are applied as column expressions.

Patterns are written so that matching never nests: separators that stand between digits or host letters are marked first, one
character for one character, so places stay. Places are code points, ends exclusive. Null and empty texts have no
spans. Repeated rows get equal spans. An empty table, or one without enough proposals to learn from, adds IBANs only. Other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import let, stored

KINDS = ("email", "ip", "card", "phone")
GENERATORS = ("address", "code", "number")
#: Proposals needed of either label; trees and their depth.
LEAST_EXAMPLES = 30
TREES, DEPTH = 10, 3
PRECISION = 0.95
#: Characters of context on each side.
AROUND = 24

_SPAN = "struct<start:int,end:int,found:string,left:string,right:string>"
_DOT, _GAP, _OTHER = "\ue001", "\ue002", "\ue003"
_LOCAL = r"A-Za-z0-9._%+\-" + _DOT
FEATURES = (
    "length", "digits", "letters", "breaks", "ats", "dots", "parens", "upper", "hex", "joined_before",
    "money_words", "net_words", "date_words", "equals_before", "distinct", "generator",
)
#: Words to the left that label a proposal; no feature looks for them.
_CONTACT = "tel|phone|call|fax|mobil|mail|contact|reach|write"
_SECRET = "secret|token|passw|api|auth|private|credential"
_IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{10,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
_GATE = r"[0-9@]|[\(\[]at[\)\]]| dot "


def places(text: Column, pattern: str) -> Column:
    """All matches, leftmost first and not overlapping, with their places and what stands around them."""

    def of(x: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            piece, found = F.get(x["pieces"], i), F.get(x["found"], i)
            start = acc["at"] + F.length(piece)
            end = start + F.length(found)
            span = F.struct(
                start.alias("start"), end.alias("end"), found.alias("found"), F.right(piece, F.lit(AROUND)).alias("left"),
                F.left(F.get(x["pieces"], i + 1), F.lit(AROUND)).alias("right"),
            )
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span.cast(_SPAN))).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), nothing().alias("out"))
        walked = F.aggregate(F.sequence(F.lit(0), F.size(x["found"]) - 1), zero, step, lambda acc: acc["out"])
        return F.when(F.size(x["found"]) > 0, walked).otherwise(nothing())

    both = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return let(both, of)


def nothing() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    values = F.transform(F.sequence(F.lit(1), F.length(digits)), value)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def emails(text: Column) -> Column:
    dotted = F.regexp_replace(F.translate(text, _DOT, _OTHER), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)
    pattern = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++{_DOT}[A-Za-z0-9{_DOT}-]*+"
    return F.when(F.contains(text, F.lit("@")), places(dotted, pattern)).otherwise(nothing())


def ips(text: Column) -> Column:
    found = places(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    small = F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    valid = F.filter(found, lambda s: F.forall(F.split(s["found"], r"\.", -1), lambda p: F.rlike(p, small)))
    return F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]")), valid).otherwise(nothing())


def cards(text: Column) -> Column:
    joined = F.regexp_replace(F.translate(text, _GAP, _OTHER), "(?<=[0-9])[ -](?=[0-9])", _GAP)
    found = places(joined, f"[0-9][0-9{_GAP}]*[0-9]")
    valid = F.filter(found, lambda s: let(digits_of(s["found"]), lambda d: F.length(d).between(13, 19) & luhn(d)))
    return F.when(F.rlike(text, F.lit("[0-9](?:[ -]?[0-9]){12}")), valid).otherwise(nothing())


def phones(text: Column) -> Column:
    found = places(text, r"\+[0-9][\x20().0-9-]+[0-9]")
    valid = F.filter(found, lambda s: F.length(digits_of(s["found"])).between(9, 15))
    return F.when(F.contains(text, F.lit("+")), valid).otherwise(nothing())


def proposals(text: Column) -> Column:
    """Generated spans, each with its generator's number."""

    def from_(number: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: s.withField("generator", F.lit(number)))

    written = r"[A-Za-z0-9._%+-]{1,64} ?(?:[\(\[]at[\)\]]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:[\(\[]dot[\)\]]| dot |\.) ?[A-Za-z0-9-]{1,24}){1,3}"
    address = rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@]*+@[^\x20\x09-\x0D]*+|{written}"
    code = rf"(?<![A-Za-z0-9])(?:{_IBAN}|[0-9A-Fa-f]{{24,64}})(?![A-Za-z0-9])"
    number = r"(?<![0-9])[0-9(][0-9 ().:/-]{5,48}[0-9]"
    return F.concat(
        from_(0, F.when(F.rlike(text, F.lit(r"@|[\(\[]at[\)\]]| at [A-Za-z0-9-]{1,63} dot ")), places(text, address)).otherwise(nothing())),
        from_(1, F.when(F.rlike(text, F.lit("[0-9A-Fa-f]{24}|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{10}| [A-Z0-9]{4} )")), places(text, code)).otherwise(nothing())),
        from_(2, F.when(F.rlike(text, F.lit("[0-9(][0-9 ().:/-]{5}")), places(text, number)).otherwise(nothing())),
    )


def features(span: Column) -> dict[str, Column]:
    """Format of a proposal and what its surroundings say."""
    found, left = span["found"], F.lower(span["left"])

    def count(pattern: str) -> Column:
        return F.regexp_count(found, F.lit(pattern)).cast("double")

    def holds(where: Column, pattern: str) -> Column:
        return F.when(F.rlike(where, F.lit(pattern)), 1.0).otherwise(0.0)

    return dict(zip(FEATURES, (
        F.length(found).cast("double"), count("[0-9]"), count("[A-Za-z]"), count("[ ./:()-]+"), count("@"), count("[.]"), count("[()]"),
        count("[A-Z]"), holds(found, "^[0-9a-fA-F]+$"), holds(left, "[a-z0-9]$"),
        holds(left, "card|account|iban|pay|visa|konto|cuenta|compte"), holds(left, "ip|host|server|addr"),
        holds(left, "date|born|year|jahr|ann|fecha"), holds(left, "[=:][ \"']*$"),
        F.size(F.array_distinct(F.split(found, ""))).cast("double"), span["generator"].cast("double"),
    ), strict=True))


def iban_form(span: Column) -> Column:
    return (span["generator"] == 1) & F.rlike(span["found"], F.lit(f"^{_IBAN}$"))


def iban(span: Column) -> Column:
    """Whether a proposal has an IBAN's form and checksum: with its first four characters last, it leaves 1 modulo 97."""
    packed = F.replace(span["found"], F.lit(" "))
    turned = F.split(F.concat(F.substr(packed, F.lit(5)), F.left(packed, F.lit(4))), "")
    values = F.transform(F.filter(turned, lambda c: c != ""), lambda c: F.position(c, F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1)
    rest = F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return iban_form(span) & F.length(packed).between(15, 34) & (rest == 1)


def named(span: Column) -> Column:
    """Whether words to the left name a proposal of such a form as personal data."""
    left, found = F.lower(span["left"]), span["found"]
    contact = F.rlike(left, F.lit(_CONTACT))
    spelt = F.rlike(found, F.lit(r"(?: at |[\(\[]at[\)\]]).*(?: dot |[\(\[]dot[\)\]]|\.)"))
    number = contact & F.length(digits_of(found)).between(7, 15)
    code = F.rlike(left, F.lit(_SECRET)) & ~F.rlike(found, F.lit("[^0-9A-Fa-f]"))
    return F.when(span["generator"] == 0, contact & spelt).when(span["generator"] == 1, code).otherwise(number)


def meets(span: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))


def all_base(text: Column) -> Column:
    return F.struct(emails(text).alias("email"), ips(text).alias("ip"), cards(text).alias("card"), phones(text).alias("phone"))


def joined_base(base: Column) -> Column:
    return F.concat(*[base[k] for k in KINDS])


def examples(df: DataFrame, text: str) -> DataFrame:
    """Proposals of all texts as distinct features and labels, each with the number `n` of proposals it stands for."""
    t = F.col(text)
    rows = df.filter(t.isNotNull() & F.rlike(t, F.lit(_GATE)))
    rows = rows.select(let(t, lambda x: F.struct(joined_base(all_base(x)).alias("base"), proposals(x).alias("made"))).alias("x"))
    rows = rows.select("x.base", F.explode("x.made").alias("s")).filter(~iban_form(F.col("s")))
    listed = [c.alias(n) for n, c in features(F.col("s")).items()]
    part = F.pmod(F.xxhash64("s.found", "s.left"), F.lit(10)).alias("part")
    known = meets(F.col("s"), F.col("base"))
    label = F.when(known | named(F.col("s")), 1.0).otherwise(0.0).alias("label")
    named_rows = rows.select(*listed, label, known.alias("known"), part)
    return named_rows.groupBy(*named_rows.columns).agg(F.count("*").alias("n"))


def learn(df: DataFrame, text: str):
    """The trees, and for each generator the lowest probability whose precision holds on held-back proposals, also on those
    that meet no base span; or None."""
    rows = stored(examples(df, text), "proposals")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_EXAMPLES:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.sortWithinPartitions(*rows.columns))
    if vectors.filter("part < 7").agg(F.count_distinct("label")).first()[0] < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", weightCol="n").fit(vectors.filter("part < 7"))
    scored = model.transform(vectors.filter("part >= 7")).select("generator", "label", "known", "n", vector_to_array("probability")[1].alias("p"))
    new = F.when(F.col("known"), 0.0).otherwise(1.0)
    own = {"n": F.lit(1), "hits": F.col("label"), "new": new, "new_hits": new * F.col("label")}
    sums = [F.sum(F.col("n") * x).alias(name) for name, x in own.items()]
    levels = scored.withColumn("step", F.floor(F.col("p") * 50)).groupBy("generator", "step").agg(*sums)
    thresholds: dict[int, float] = {}
    found = sorted(levels.collect(), key=lambda r: -r["step"])  # 51 steps for each generator at most
    for g in range(len(GENERATORS)):
        n = hits = new = new_hits = 0
        for r in (r for r in found if r["generator"] == g):
            n, hits, new, new_hits = n + r["n"], hits + r["hits"], new + r["new"], new_hits + r["new_hits"]
            if n >= 10 and hits >= PRECISION * n and new_hits >= PRECISION * new:
                thresholds[g] = r["step"] / 50
    return (model, thresholds) if thresholds else None


def margin(model: GBTClassificationModel, values: list[Column]) -> Column:
    """The trees' weighted sum as an expression."""

    def branch(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(values[split.featureIndex()] <= split.threshold(), branch(node.leftChild())).otherwise(branch(node.rightChild()))

    return reduce(add, [branch(t._call_java("rootNode")) * float(w) for t, w in zip(model.trees, model.treeWeights, strict=True)])


def added(spans: Column, base: Column, learnt) -> Column:
    """IBANs and proposals over their generator's threshold that meet neither a base span nor an added one before them."""
    model, thresholds = learnt or (None, {})

    def passes(s: Column) -> Column:
        if model is None:
            return iban(s) & ~meets(s, base)
        listed = list(features(s).values())
        probability = 1 / (1 + F.exp(-2 * let(F.array(*listed), lambda v: margin(model, [v[i] for i in range(len(FEATURES))]))))
        enough = F.lit(False)
        for g, least in thresholds.items():
            enough = F.when(s["generator"] == g, probability >= least).otherwise(enough)
        return ~meets(s, base) & F.when(iban_form(s), iban(s)).otherwise(enough)

    chosen = F.array_sort(F.transform(F.filter(spans, passes), lambda s: F.struct(s["start"], s["end"], s["generator"])))
    zero = F.filter(chosen, lambda s: F.lit(False))
    apart = F.aggregate(chosen, zero, lambda out, s: F.when(meets(s, out), out).otherwise(F.concat(out, F.array(s))))
    return F.when(F.size(chosen) > 0, apart).otherwise(zero)


def written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def of_generator(spans: Column, number: int) -> Column:
    return F.filter(spans, lambda s: s["generator"] == number)


def find_personal(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_email, n_ip, n_card, n_phone, n_added (long), base and spans (strings kind:start:end, comma-joined)."""
    learnt = learn(df, text)
    names = (*[f"n_{k}" for k in KINDS], "n_added", "base", "spans")

    def found(t: Column) -> Column:
        def with_base(b: Column) -> Column:
            return F.struct(b.alias("b"), added(proposals(t), joined_base(b), learnt).alias("extra"))

        return let(all_base(t), with_base)

    t = F.coalesce(F.col(text), F.lit(""))
    none = F.struct(F.struct(*[nothing().alias(k) for k in KINDS]).alias("b"), F.array().cast("array<struct<start:int,end:int,generator:int>>").alias("extra"))
    seen = F.when(F.rlike(t, F.lit(_GATE)), let(t, found)).otherwise(none)
    rows = df.select(*[c for c in df.columns if c not in names], seen.alias("_x"))
    b, extra = F.col("_x.b"), F.col("_x.extra")
    base = F.concat(*[written(k, b[k]) for k in KINDS])
    more = F.concat(*[written(g, of_generator(extra, i)) for i, g in enumerate(GENERATORS)])
    return rows.select(
        *[c for c in rows.columns if c != "_x"], *[F.size(b[k]).cast("long").alias(f"n_{k}") for k in KINDS],
        F.size(extra).cast("long").alias("n_added"), F.array_join(base, ",").alias("base"), F.array_join(F.concat(base, more), ",").alias("spans"),
    )


def redact(found: DataFrame, text: str = "text", mask: str = "[removed]") -> DataFrame:
    """The text of rows from find_personal without its spans; overlapping spans become one mask."""
    parts = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    ordered = F.array_sort(F.transform(parts, lambda p: F.struct(p[1].cast("int").alias("start"), p[2].cast("int").alias("end"))))

    def step(acc: Column, s: Column) -> Column:
        between = F.substr(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        masked = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), masked.alias("out"))

    rest = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substr(F.col(text), a["at"] + 1)))
    return found.withColumn(text, F.when(F.col("spans") == "", F.col(text)).otherwise(rest))
