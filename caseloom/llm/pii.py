"""Personal data: rule spans, and further spans chosen by boosted trees among loose candidates.

Method.  Loose patterns propose candidate spans with high recall; they overlap
freely: whole runs of digits and separators, single runs of digits, and numbers
of three and of four groups, so that a number that touches another one is
proposed by itself too.  Each candidate is described by its format (digits, separators,
letters, length, checksum, how it starts and ends) and by its surroundings (what
stands before and after it, hint words nearby).  Gradient-boosted trees learn from
the corpus itself which candidates are personal data: a candidate that
is a rule span counts as positive, also with its telling mark (the plus
sign, the at sign) taken away or written out, all others as negative, above all those that
cut a rule span short or run beyond it.  The
trees' output is calibrated by a logistic curve on held-back candidates, and
the least threshold that reaches the asked precision there selects
redactions.  Candidates that may be what the rules miss (beside all rule spans, of a
valid number of digits or an address) are no errors in that precision; they
count as negative for the trees, so that a form must be a rule span in most places to be selected in others.  The trees become one SQL expression, so texts are scored where
they are read.

Everything is a Column expression: no Python runs on the executors.  Arrays of a
text's spans are worked on in runs of the root of their number, so a text of n
matches takes time in proportion to n times the root of n at most.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import pack
from caseloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
MAX_TRAINING_ROWS = None  # candidates the trees are fitted on at most, about; picked by hash; none: all
TREES, DEPTH, PRECISION, MIN_POSITIVES = 12, 3, 0.98, 20
LEAST = 0.5  # a selected candidate's probability at least
CONTEXT = 24  # characters looked at on either side

# The rules.  \G or a look-behind lets a search start only where a run starts,
# and possessive repeats do not back off: long runs cost linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Candidates: an at sign written any way between name and host; number-like runs with any separators.
LOOSE_EMAIL = r"(?:\G|(?<![\w.%+-]))[\w.%+-]{1,64}+ ?(?:@|\[at\]|\(at\)) ?[\w-]{1,63}+(?: ?(?:\.|\[dot\]|\(dot\)) ?[\w-]{1,63}+)++"
LOOSE_NUMBER = r"(?:\G|(?<![0-9]))\+?(?:\([0-9]{1,4}\) ?)?[0-9](?:[ ./()-]{0,2}[0-9]){6,24}+"
DIGIT_RUN = r"(?<![0-9])[0-9]{7,19}+(?![0-9])"
GROUPED = r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){%d}(?![0-9])"
NUMBERS = (LOOSE_NUMBER, DIGIT_RUN, GROUPED % 2, GROUPED % 3)
HINTS = r"(?i)\b(?:mail|e-mail|tel|phone|call|fax|mobile|ip|host|card|visa|contact)\b"


# Casts name the fields: inside lambdas, aliases of literals are not kept.
_MATCH, _SPAN = "array<struct<start:int,end:int,match:string>>", "array<struct<start:int,kind_no:int,end:int>>"
_CANDIDATE = "array<struct<start:int,end:int,match:string,before:string,after:string,generator:int>>"
_CHOSEN = "array<struct<start:int,kind_no:int,end:int,rank:struct<p:double,length:int,start:int,generator:int>>>"


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(items: Column) -> Column:
    """Runs of the root of the number of items; no items: no runs."""
    def cut(v: Column) -> Column:
        step = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), F.size(v), step), lambda at: F.slice(v, at, step))

    return _let(items, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(F.slice(F.array(v), 1, 0)))


def _running(numbers: Column) -> Column:
    """Sums of the numbers up to each: within runs, then the sums of the runs before are added."""
    none = F.array().cast("array<int>")

    def sums(items: Column, size) -> Column:
        return F.aggregate(items, none, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + size(x))))

    def added(runs: Column) -> Column:
        inside = F.transform(runs, lambda run: sums(run, lambda x: x))
        whole = lambda r: F.element_at(r, -1)
        return _let(inside, lambda r: _let(sums(r, whole), lambda upto: F.flatten(
            F.transform(r, lambda run, i: F.transform(run, lambda x: x + F.get(upto, i) - whole(run))))))

    return _let(_runs(numbers), added)


def _beside(spans: Column, others: Column, use) -> Column:
    """use(run, near) of every run of spans, joined to one array; near: the others that overlap the run's stretch."""
    def one(run: Column, others: Column) -> Column:
        ends = F.struct(F.array_min(F.transform(run, lambda s: s["start"])).alias("low"), F.array_max(F.transform(run, lambda s: s["end"])).alias("high"))
        near = _let(ends, lambda e: F.filter(others, lambda o: (o["start"] < e["high"]) & (o["end"] > e["low"])))
        return _let(near, lambda n: use(run, n))

    return _let(others, lambda o: F.flatten(F.transform(_runs(spans), lambda run: one(run, o))))


def _overlap(s: Column, o: Column) -> Column:
    return (o["start"] < s["end"]) & (s["start"] < o["end"])


def _matches(text: Column, pattern: str, generator: int | None = None) -> Column:
    """Non-overlapping matches as structs (start, end, match): code points, end exclusive.

    The pieces between matches give the places.  With a generator's number, matches are candidates: the text around them and the number follow.
    """
    def around(v: Column, i: Column) -> list[Column]:
        if generator is None:
            return []
        empty = F.lit("")
        before = F.concat(F.coalesce(F.get(v["found"], i - 1), empty), F.get(v["pieces"], i))
        after = F.concat(F.get(v["pieces"], i + 1), F.coalesce(F.get(v["found"], i + 1), empty))
        return [F.substring(before, F.lit(-CONTEXT), F.lit(CONTEXT)).alias("before"), F.substring(after, 1, CONTEXT).alias("after"), F.lit(generator).alias("generator")]

    def placed(v: Column) -> Column:
        ends = _running(F.transform(v["found"], lambda m, i: F.length(F.get(v["pieces"], i)) + F.length(m)))
        return _let(ends, lambda e: F.transform(v["found"], lambda m, i: F.struct(
            (F.get(e, i) - F.length(m)).alias("start"), F.get(e, i).alias("end"), m.alias("match"), *around(v, i))))

    cut = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces"))
    return _let(cut, placed).cast(_MATCH if generator is None else _CANDIDATE)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(at, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _is_ip(s: Column) -> Column:
    octet = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return s.rlike(rf"^{octet}(?:\.{octet}){{3}}$")


def _is_card(s: Column) -> Column:
    d = _digits(s)
    return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)


def _is_phone(s: Column) -> Column:
    return F.length(_digits(s)).between(10, 15)


def base_spans(text: Column) -> Column:
    """Rule spans as structs (start, kind_no, end), by start and then kind."""
    digit, at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    rules = [(EMAIL, at, lambda m: F.lit(True)), (IP, digit, _is_ip), (CARD, digit, _is_card), (PHONE, F.contains(text, F.lit("+")), _is_phone)]
    none = F.array().cast(_SPAN)
    parts = []
    for no, (pattern, possible, valid) in enumerate(rules):
        spans = F.transform(_valid(_matches(text, pattern), valid), _as_span(no)).cast(_SPAN)
        parts.append(F.when(possible, spans).otherwise(none))
    return F.when(digit | at, F.array_sort(F.concat(*parts))).otherwise(none)


def _valid(matches: Column, valid) -> Column:
    return F.filter(matches, lambda m: valid(m["match"]))


def _as_span(no: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(no).alias("kind_no"), m["end"].alias("end"))


# --- candidates and features ----------------------------------------------

FEATURES = ("digits", "length", "letters", "groups", "dots", "dashes", "spaces", "brackets", "slashes", "ats", "written_at",
            "longest_digits", "first_group", "last_group", "starts_open", "before_word", "before_mark", "after_word", "hint", "number_like", "checksum", "octets")


def candidates(text: Column) -> Column:
    """Loose spans as structs (start, end, match, text before, text after, generator's number: 0 for addresses)."""
    none = F.array().cast(_CANDIDATE)
    mail = F.when(text.rlike(r"@|[\[(]at[\])]"), _matches(text, LOOSE_EMAIL, 0)).otherwise(none)
    numbers = F.concat(*[_matches(text, pattern, no) for no, pattern in enumerate(NUMBERS, 1)])
    return F.concat(mail, F.when(text.rlike("[0-9]{2}|[0-9][ ./()-]"), numbers).otherwise(none))


def _count(s: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(s, f"[^{kept}]", "")).cast("double")


def _features(c: Column, match: Column | None = None) -> Column:
    """Format and surroundings of a candidate, without the mark that the rules know a phone by (the plus sign)."""
    m = F.regexp_replace(c["match"] if match is None else match, r"^\+", "")
    groups = F.split(F.regexp_replace(m, "[^0-9]+", " "), " ")
    sizes = F.transform(F.filter(groups, lambda g: g != ""), lambda g: F.length(g))
    flag = lambda x: x.cast("double")
    return F.array(
        _count(m, "0-9"), F.length(m).cast("double"), _count(m, r"\p{L}"), F.size(sizes).cast("double"), _count(m, "."),
        _count(m, r"\-"), _count(m, " "), _count(m, "()"), _count(m, "/"), _count(m, "@"), flag(m.rlike(r"[\[(]at[\])]")),
        F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"), F.coalesce(F.get(sizes, F.lit(0)), F.lit(0)).cast("double"),
        F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), sizes), -1), F.lit(0)).cast("double"),
        flag(m.startswith("(")), flag(c["before"].rlike(r"[\p{L}0-9_]$")), flag(c["before"].rlike(r"[=:\"'#$/.-]$")),
        flag(c["after"].rlike(r"^[\p{L}0-9_]")), flag(F.concat_ws(" ", c["before"], c["after"]).rlike(HINTS)), flag(c["generator"] > 0), flag(_is_card(m)), flag(_is_ip(m)))


@dataclass
class Model:
    """Boosted trees as (weight, tree), a calibration curve and a threshold; a tree is nested (feature, cut, low, high) or a number."""

    trees: list
    slope: float
    offset: float
    threshold: float

    def margin(self, x: Column) -> Column:
        return sum((F.lit(w) * _tree_column(t, x) for w, t in self.trees), F.lit(0.0))

    def probability(self, x: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * self.margin(x) + F.lit(self.offset))))


def _tree_column(tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, cut, low, high = tree
    return F.when(F.get(x, F.lit(feature)) <= cut, _tree_column(low, x)).otherwise(_tree_column(high, x))


def _tree_of(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree_of(node.leftChild()), _tree_of(node.rightChild()))


def training_rows(docs: DataFrame, max_rows: int | None = MAX_TRAINING_ROWS) -> DataFrame:
    """(x, label, decided, held) of the different candidates of all documents; with max_rows, of about so many at most.

    A candidate that is a rule span is positive.  Half of the positive ones are
    shown once more without their telling mark.  Candidates that look alike, with
    their surroundings, count once, so a frequent one does not outweigh the others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.select(text.alias("t")).where("t rlike '[0-9@]' or t rlike '[\\\\[(]at[\\\\])]'")
    found = some.select(F.explode(F.array(F.struct(base_spans(F.col("t")).alias("base"), candidates(F.col("t")).alias("found")))).alias("v"))
    is_rule = lambda c, near: F.exists(near, lambda b: (b["start"] == c["start"]) & (b["end"] == c["end"]))
    possible = lambda c: (c["generator"] == 0) | _is_card(c["match"]) | _is_ip(c["match"]) | _is_phone(c["match"])
    told = _beside(F.array_sort("v.found"), F.col("v.base"), lambda run, near: F.transform(run, lambda c: F.struct(
        c["match"].alias("match"), c["before"].alias("before"), c["after"].alias("after"), (c["generator"] > 0).cast("int").alias("generator"),
        is_rule(c, near).cast("double").alias("label"), (F.exists(near, lambda b: _overlap(c, b)) | ~possible(c)).alias("decided"))))
    rows = found.select(F.explode(told).alias("c")).select("c.*")
    look = ["match", "before", "after", "generator"]
    marked = materialize(rows.groupBy(*look).agg(F.max("label").alias("label"), F.max("decided").alias("decided")).withColumn("key", F.xxhash64(*look)), "candidates")
    if max_rows is not None and (n := marked.count()) > max_rows:
        marked = marked.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < math.ceil(1e6 * max_rows / n))
    plain = F.regexp_replace(F.regexp_replace("match", r"^\+[0-9]{1,3} ?", ""), "@", " [at] ")
    both = F.when((F.col("label") == 1) & (F.col("key") % 2 == 0), F.array("match", plain)).otherwise(F.array("match"))
    shown = marked.select(F.explode(both).alias("m"), F.struct(*look).alias("c"), "label", "decided", "key")
    return shown.select(_features(F.col("c"), F.col("m")).alias("x"), "label", "decided", (F.pmod("key", F.lit(4)) == 0).alias("held"))


def fit(docs: DataFrame, max_rows: int | None = MAX_TRAINING_ROWS, precision: float = PRECISION) -> Model | None:
    """None when there are too few positive or no negative candidates; then only the rules speak."""
    rows = materialize(training_rows(docs, max_rows), "features").select("label", "decided", "held", array_to_vector("x").alias("features"))
    counts = {(r["label"], r["held"]): r["count"] for r in rows.groupBy("label", "held").count().collect()}
    if any(counts.get((label, held), 0) < MIN_POSITIVES for label in (0.0, 1.0) for held in (True, False)):
        return None
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(rows.where("not held"))
    model = Model([(w, _tree_of(t._call_java("rootNode"))) for w, t in zip(gbt.treeWeights, gbt.trees)], 1.0, 0.0, 1.0)
    held = gbt.transform(rows.where("held")).select("label", "decided", array_to_vector(F.array(_first("rawPrediction"))).alias("features"))
    curve = LogisticRegression(maxIter=50, regParam=1e-3).fit(held)
    model.slope, model.offset = float(curve.coefficients[0]), float(curve.intercept)
    judged = curve.transform(held).where("decided").select("label", F.round(_first("probability"), 3).alias("p"))
    # at most 1,001 different rounded probabilities reach the driver
    steps = judged.groupBy("p").agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy(F.desc("p")).collect()
    good = n = 0
    for s in steps:
        good, n = good + s["good"], n + s["n"]
        if good / n >= precision and s["p"] >= LEAST:
            model.threshold = s["p"]
    return model


def _first(vector: str) -> Column:
    return vector_to_array(F.col(vector))[1]


def all_spans(text: Column, base: Column, model: Model | None) -> Column:
    """Rule spans and the candidates that the model selects.

    A candidate that overlaps a rule span goes; one that overlaps a likelier selected one
    (then a longer, then an earlier one) gives way to it.
    """
    if model is None:
        return base
    kind = lambda c: F.when(c["generator"] == 0, 0).when(_is_ip(c["match"]), 1).when(F.length(_digits(c["match"])) >= 14, 2).otherwise(3)
    free = _beside(F.array_sort(candidates(text)), base, lambda run, near: F.filter(run, lambda c: ~F.exists(near, lambda b: _overlap(c, b))))
    judged = F.transform(free, lambda c: F.struct(c["start"], kind(c), c["end"], F.struct(
        _let(_features(c), lambda x: -model.probability(x)), c["start"] - c["end"], c["start"], c["generator"]))).cast(_CHOSEN)
    chosen = F.filter(judged, lambda s: -s["rank"]["p"] >= model.threshold)
    kept = _let(chosen, lambda all_: _beside(all_, all_, lambda run, near: F.filter(run, lambda s: ~F.exists(near, lambda o: _overlap(s, o) & (o["rank"] < s["rank"])))))
    added = F.transform(kept, lambda s: F.struct(s["start"], s["kind_no"], s["end"])).cast(_SPAN)
    return F.when(text.rlike("[0-9@]|[\\[(]at[\\])]"), F.array_sort(F.concat(base, added))).otherwise(base)


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(packed: DataFrame, text: str, model: Model | None) -> DataFrame:
    """doc, base and spans (arrays of start, kind_no, end).

    The rules are evaluated once: their result crosses a generator, which keeps it from being inlined into later uses.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    based = packed.select("doc", F.explode(F.array(base_spans(t))).alias("base"))
    return based.select("doc", "base", F.explode(F.array(all_spans(t, F.col("base"), model))).alias("spans"))


def find_personal_data(docs: DataFrame, max_rows: int | None = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row.

    Null and empty texts have no spans; repeated rows and ids are answered row by
    row; extra columns are ignored; an empty table gives no rows.
    """
    model = fit(docs, max_rows)
    rows = with_spans(docs.select(F.struct("doc_id", "text").alias("doc")), "doc.text", model)
    counts = [F.size(F.filter("base", _of_kind(no))).cast("bigint").alias(f"n_{k}") for no, k in enumerate(KINDS)]
    return rows.select(F.col("doc.doc_id").alias("doc_id"), *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.col("spans")).alias("spans"))


def _of_kind(no: int):
    return lambda s: s["kind_no"] == no


def redact(docs: DataFrame, max_rows: int | None = MAX_TRAINING_ROWS) -> DataFrame:
    """All rows and columns, each span of `text` replaced by its kind in brackets; a column n_chars follows the new text.

    Overlapping spans are replaced as one, under the kind that starts first.  Texts without spans stay as they are, null stays null.
    """
    model = fit(docs, max_rows)
    rows = with_spans(pack(docs), "doc.text", model)
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    kept, whole = "struct<out:string,at:int>", "struct<parts:array<string>,at:int>"

    def step(window: Column, first: Column, acc: Column, s: Column) -> Column:
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(
                F.substring(window, acc["at"] - first + 1, s["start"] - acc["at"]), F.get(kinds, s["kind_no"]))).otherwise("")).alias("out"),
            s["end"].alias("at")).cast(kept))

    def run_step(acc: Column, run: Column) -> Column:
        """A run of spans looks at its own stretch of the text only."""
        upto = F.greatest(acc["at"], F.array_max(F.transform(run, lambda s: s["end"])))
        stretch = F.struct(F.substring("doc.text", acc["at"] + 1, upto - acc["at"]).alias("text"), acc["at"].alias("first"))
        done = _let(stretch, lambda w: F.aggregate(run, F.struct(F.lit(""), w["first"]).cast(kept), lambda a, s: step(w["text"], w["first"], a, s)))
        return _let(done, lambda d: F.struct(F.concat(acc["parts"], F.array(d["out"])), d["at"]).cast(whole))

    done = F.aggregate(_runs(F.col("spans")), F.struct(F.array().cast("array<string>"), F.lit(0)).cast(whole), run_step,
                       lambda a: F.concat(F.array_join(a["parts"], ""), F.substring("doc.text", a["at"] + 1, F.length("doc.text"))))
    new = F.when(F.size("spans") > 0, done).otherwise(F.col("doc.text"))
    changed = rows.withColumn("new", new)
    fields = [F.col("new").alias(c) if c == "text" else
              F.when(F.size("spans") > 0, F.length("new").cast(t)).otherwise(F.col("doc.n_chars")).alias(c) if c == "n_chars" else F.col(f"doc.`{c}`").alias(c)
              for c, t in docs.dtypes]
    return changed.select(*fields)
