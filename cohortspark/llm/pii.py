"""Personal data: base patterns with checks, and boosted candidates (DataFrame functions only).

Base spans are the valid leftmost matches of one pattern per kind.  Wider generators propose
further spans of the same kinds, which may overlap.  Every candidate has format features (digits,
groups, separators, Luhn sum, lengths; an address is read with its "(at)" and "(dot)" undone, a telephone number
without its country code) and context features (key words before it, its neighbours).

Labels come from evidence in the corpus.  A candidate that covers a base span of its kind is
positive.  One that contradicts its kind is negative: an address without a dot in its domain, a
dotted number of other than four parts or with a part over 255, a long number that fails Luhn, a
telephone number of a wrong length, of the form of a date, or within a base span of another kind.
All others, such as spelled-out addresses and local numbers, are not learned from; they are what
the trees decide on.  Trees are fitted on a sample of each label of each kind (at most about
``TRAIN_ROWS`` candidates in all, a parameter) and calibrated on all labelled candidates: the
threshold is the lowest bin of margins from which on at least ``PRECISION`` of them are positive.
A kind without positives or without such a bin adds nothing; in a kind without negatives nothing
speaks against the others, and all are added.

Added spans overlap no base span of any kind.  Of a run of added candidates that overlap, whatever
their kinds, the one with the largest margin stays (then the earlier kind, then the earlier start).

A text is read once.  Positions are running sums, by sixteenfold steps, of the lengths of the matches
and of the pieces between them, so they are code points and n matches cost n log n.  Overlaps are
found by windows over the rows of spans, in the order of their starts.  Patterns use possessive
quantifiers and cannot overflow the stack on long runs.

Cases: null text is empty; empty texts have no spans; repeated rows and null ids are carried
through; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .trees import ensemble_column

TRAIN_ROWS = 40_000
PRECISION = 0.95
BINS = 40
ROUNDS, DEPTH = 15, 3
CONTEXT = 24

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns; possessive forms match the same spans.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without a match of these have none of the pattern either.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,7}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|\()?[0-9](?:[\x20().-]{0,2}+[0-9]){6,15}+(?![0-9A-Za-z])",
}
WIDE_NEEDS = {"email": r"@|[(\[](?:at|AT)[)\]]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20./-]?[0-9]",
              "phone": r"[0-9][\x20().-]{0,2}[0-9]"}
HINTS = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|pay",
         "phone": "phone|tel|call|mobile|fax"}

NO_SPANS = "array<struct<start:int,end:int>>"
PARTS = "array<struct<width:int,hit:string,before:string,after:string>>"
DATE = r"^(?:(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2})(?![0-9])"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running_sums(x: Column) -> Column:
    """Running sums of an array of integers: every step widens the summed window sixteenfold."""
    def step(k: int):
        return lambda v: F.when(F.size(v) > k, F.transform(v, lambda e, i: F.aggregate(
            F.sequence(F.lit(1), F.lit(15)), e, lambda acc, j: acc + F.coalesce(F.get(v, i - j * k), F.lit(0))))).otherwise(v)
    for bits in range(0, 32, 4):
        x = let(x, step(1 << bits))
    return x


def located(text: Column, patterns: list[tuple[str, str]]) -> Column:
    """Per (need, pattern) the leftmost matches as structs (start, end, hit, before, after):
    positions in code points, and what stands before (``CONTEXT`` characters, up to the match
    before) and after (one).  Texts without a match of the need are not searched."""
    def found(need: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

        def parts(pieces: Column) -> Column:
            both = F.zip_with(pieces, hits, lambda piece, hit: F.struct(piece.alias("piece"), hit.alias("hit")))
            return F.zip_with(both, F.slice(pieces, F.lit(2), F.size(pieces)), lambda x, after: F.struct(
                (F.length(x["piece"]) + F.length(x["hit"])).alias("width"), x["hit"].alias("hit"),
                F.right(x["piece"], F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(1)).alias("after")))
        every = F.filter(let(F.split(text, pattern, -1), parts), lambda x: x["hit"].isNotNull())
        return F.when(text.rlike(need), every).otherwise(F.array().cast(PARTS))

    def placed(x: Column) -> Column:
        return F.zip_with(running_sums(F.transform(x, lambda e: e["width"])), x, lambda end, e: F.struct(
            (end - F.length(e["hit"])).alias("start"), end.alias("end"), e["hit"].alias("hit"),
            e["before"].alias("before"), e["after"].alias("after")))
    return F.transform(F.array(*[found(*p) for p in patterns]), placed)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten."""
    def worth(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, d).otherwise(twice)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(number)), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def small_parts(hit: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (F.coalesce(F.substring(bare, 1, 3).cast("int"), F.lit(0)) <= 255))
    return F.forall(F.split(hit, r"\."), small)


def valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return small_parts(hit)
    if kind == "card":
        n = digits(hit)
        return F.length(n).between(16, 19) & luhn(n)
    if kind == "phone":
        return F.length(digits(hit)).between(8, 15)
    return F.lit(True)


def base_spans(found: Column, kind: str) -> Column:
    """The valid ones of the matches of a base pattern."""
    spans = F.filter(found, lambda x: valid(kind, x["hit"]))
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


# --- candidates ------------------------------------------------------------------------------

FEATURES = ("digits", "length", "groups", "longest_group", "separators", "letters", "luhn", "small", "dots", "date",
            "hint", "word_before", "word_after", "symbol_after")


def undone(kind: str, hit: Column) -> Column:
    """A candidate without the marks of the strict patterns: an address with its spelled-out marks
    undone, a telephone number without its country code."""
    if kind == "phone":
        return F.regexp_replace(hit, r"^\+[0-9]{1,3}(?=[\x20.(-])[\x20.-]*", "")
    if kind != "email":
        return hit
    marks = F.regexp_replace(hit, r"(?i)\x20?[(\[]at[)\]]\x20?", "@")
    return F.regexp_replace(marks, r"(?i)\x20?[(\[]dot[)\]]\x20?", ".")


def candidates(found: Column, kind: str) -> Column:
    """Structs (start, end, x: features) of the matches of a wide generator."""
    def described(x: Column) -> Column:
        hit = undone(kind, x["hit"])
        number = digits(hit)
        groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
        before, after, n = x["before"], x["after"], F.length(number)
        dotted = F.substring_index(hit, "@", -1) if kind == "email" else hit
        values = {
            "digits": n, "length": F.length(hit), "groups": F.size(groups),
            "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
            "separators": F.length(F.regexp_replace(hit, "[0-9A-Za-z+]", "")),
            "letters": F.length(F.regexp_replace(hit, "[^A-Za-z]", "")),
            "luhn": ((n >= 12) & (n <= 19) & luhn(F.substring(number, 1, 19))).cast("int"),
            "small": (F.lit(kind == "ip") & small_parts(hit)).cast("int"),
            "dots": F.length(F.regexp_replace(dotted, "[^.]", "")),
            "date": (F.lit(kind == "phone") & hit.rlike(DATE)).cast("int"),
            "hint": F.lower(before).rlike(HINTS[kind]).cast("int"),
            "word_before": before.rlike("[0-9A-Za-z]$").cast("int"),
            "word_after": after.rlike("[0-9A-Za-z]").cast("int"),
            "symbol_after": after.rlike("[^\\s0-9A-Za-z]").cast("int"),
        }
        made = F.struct(*[values[k].cast("double").alias(k) for k in FEATURES])
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), made.alias("x"))
    return F.transform(found, described)


def spans_and_candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id, base_<kind>, wide_<kind> of every row (a written table without the texts); row
    is a number of its own, as ids may repeat."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    patterns = [(NEEDS[k], BASE[k]) for k in KINDS] + [(WIDE_NEEDS[k], WIDE[k]) for k in KINDS]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", located(text, patterns).alias("found"))
    found = F.col("found")
    out = rows.select("row", "doc_id", *[base_spans(found[i], k).alias(f"base_{k}") for i, k in enumerate(KINDS)],
                      *[candidates(found[len(KINDS) + i], k).alias(f"wide_{k}") for i, k in enumerate(KINDS)])
    return materialize(out, "pii-spans")


def contradicted(touches: Column) -> Column:
    """Whether a candidate's form (or, for a telephone number, its place) is not of its kind."""
    x = F.col("x")
    return (F.when(F.col("kind") == 0, x["dots"] == 0)
            .when(F.col("kind") == 1, (x["small"] == 0) | (x["dots"] != 3))
            .when(F.col("kind") == 2, x["luhn"] == 0)
            .otherwise(~x["digits"].between(8, 15) | (x["date"] == 1) | touches))


def labelled_candidates(found: DataFrame) -> DataFrame:
    """row, kind (number), start, end, x, label (1, 0 or null) and free (overlaps no base span) of
    every candidate (a written table)."""
    def spans(k: int, kind: str) -> list[Column]:
        base = F.transform(f"base_{kind}", lambda s: F.struct(
            F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("base"),
            F.lit(None).cast(feature_type).alias("x")))
        wide = F.transform(f"wide_{kind}", lambda c: F.struct(
            F.lit(k).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.lit(False).alias("base"), c["x"].alias("x")))
        return [base, wide]
    feature_type = "struct<" + ",".join(f"{k}:double" for k in FEATURES) + ">"
    any_wide = F.greatest(*[F.size(f"wide_{k}") for k in KINDS]) > 0  # base spans alone decide nothing
    every = F.concat(*[a for k, kind in enumerate(KINDS) for a in spans(k, kind)])
    rows = found.where(any_wide).select("row", F.explode(every).alias("s")).select("row", "s.*")
    forth, back = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.desc("start"))
    own = Window.partitionBy("row", "kind").orderBy(F.desc("start"))
    base = F.col("base")
    rows = rows.withColumn("left", F.max(F.when(base, F.col("end"))).over(forth))  # peers of a start are included
    rows = rows.withColumn("right", F.min(F.when(base, F.col("start"))).over(back))
    rows = rows.withColumn("next", F.min(F.when(base, F.struct("start", "end"))).over(own)).where("not base")
    touches = (F.coalesce(F.col("left"), F.lit(-1)) > F.col("start")) | F.coalesce(F.col("right") < F.col("end"), F.lit(False))
    covers = F.coalesce(F.col("next.end") <= F.col("end"), F.lit(False))
    label = F.when(covers, 1.0).when(contradicted(touches), 0.0)
    return materialize(rows.select("row", "kind", "start", "end", "x", label.alias("label"), (~touches).alias("free")), "pii-candidates")


# --- boosting --------------------------------------------------------------------------------

def _margin(model, x: Column) -> Column:
    """Margin between -1 and 1; 1 without a model."""
    return F.lit(1.0) if model is None else F.tanh(ensemble_column(model, [x[k] for k in FEATURES]))


def fit(every: DataFrame, rows: int = TRAIN_ROWS) -> dict[int, tuple[object, float]]:
    """kind number -> (boosted model or None, least margin), from labelled candidates."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    sizes = {(r["kind"], r["label"]): r["count"] for r in
             every.where("label is not null").groupBy("kind", "label").count().collect()}
    models = {}
    for kind in range(len(KINDS)):
        good, bad = sizes.get((kind, 1.0), 0), sizes.get((kind, 0.0), 0)
        if not good:
            continue
        if not bad:
            models[kind] = (None, -1.0)
            continue
        own = every.where((F.col("kind") == kind) & F.col("label").isNotNull())
        part = F.pmod(F.xxhash64("row", "start", "end"), F.lit(1 << 20))
        share = [min(1.0, rows / (2 * len(KINDS)) / n) for n in (bad, good)]  # each label at most about rows / 8
        learn = own.where(part < F.when(F.col("label") == 1.0, share[1]).otherwise(share[0]) * (1 << 20))
        learn = learn.select("label", "x.*").coalesce(1)
        if learn.groupBy("label").count().count() < 2:
            continue
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(learn)
        model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=11).fit(vectors)
        bin_ = F.floor((_margin(model, F.col("x")) + 1) / 2 * BINS).cast("int")
        bins = {r["bin"]: (r["n"], r["good"]) for r in own.groupBy(bin_.alias("bin"))
                .agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()}
        n = positive = 0.0
        least = None
        for b in range(BINS, -1, -1):
            more = bins.get(b, (0, 0.0))
            n, positive = n + more[0], positive + more[1]
            if more[0] and positive >= PRECISION * n:
                least = b
        if least is not None:
            models[kind] = (model, 2 * least / BINS - 1)
    return models


def accepted(every: DataFrame, models: dict[int, tuple[object, float]]) -> DataFrame:
    """row and its added spans (array of kind, start, end)."""
    margin = least = F.lit(None).cast("double")
    for kind, (model, limit) in models.items():
        margin = F.when(F.col("kind") == kind, _margin(model, F.col("x"))).otherwise(margin)
        least = F.when(F.col("kind") == kind, F.lit(limit)).otherwise(least)
    over = every.where("free and coalesce(label, 1.0) = 1.0").select("row", "kind", "start", "end", margin.alias("margin"), least.alias("least"))
    over = over.where("margin >= least")
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    runs = over.withColumn("first", F.coalesce((F.max("end").over(before) <= F.col("start")).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("row", "run").orderBy(F.desc("margin"), "kind", "start")
    kept = runs.withColumn("nth", F.row_number().over(best)).where("nth = 1")
    return kept.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))  # one text's spans


def find(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, base_<kind> and more_<kind> (arrays of start, end) for every row of ``docs``."""
    found = spans_and_candidates(docs)
    every = labelled_candidates(found)
    added = accepted(every, fit(every, rows))
    both = found.select("row", "doc_id", *[f"base_{k}" for k in KINDS]).join(added, "row", "left")

    def of_kind(k: int) -> Column:
        own = F.transform(F.filter("more", lambda m: m["kind"] == k), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
        return F.coalesce(own, F.array().cast(NO_SPANS))
    return both.select("doc_id", *[f"base_{k}" for k in KINDS], *[of_kind(i).alias(f"more_{k}") for i, k in enumerate(KINDS)])


def listed(column: str, kind: str) -> Column:
    """kind:start:end of every span."""
    return F.transform(column, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def redact(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, counts of base spans, digest of the base spans and all spans of every row."""
    found = find(docs, rows)
    both = found.select("*", *[F.array_sort(F.concat(f"base_{k}", f"more_{k}")).alias(f"all_{k}") for k in KINDS])
    base = F.concat_ws(",", *[listed(f"base_{k}", k) for k in KINDS])
    return both.select("doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                       F.sha2(base, 256).alias("base_sha256"),
                       F.concat_ws(",", *[listed(f"all_{k}", k) for k in KINDS]).alias("spans"))
