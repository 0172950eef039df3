"""Personal data: base patterns with fixed checks, and boosted trees that add spans of looser forms.

Everything is DataFrame code: regular expressions, array expressions and a CASE expression made from the trees; no
Python runs on the executors and no row is shuffled but the distinct forms of labelled candidates.

1. Base spans: leftmost non-overlapping matches of each kind, kept if they pass the kind's check.
2. High-recall generators propose looser spans of each kind (they may overlap each other and the base ones), with
   features of their form and of their surroundings.
3. Gradient-boosted trees (fitted on all candidates with a label, equal ones as one weighted row; kinds beyond their share of
   ``BALANCE_ROWS`` weigh as that share, so that a frequent one leaves room for the others) score them. A candidate
   that overlaps a base span of its kind is an example; one that overlaps a base span of another kind, or whose digits fail
   its kind's check, is a counter-example; the rest are unlabelled. The checks themselves are no features.
4. Per kind, the least score from ``LEAST_SCORE`` on whose precision on the calibration fold reaches ``PRECISION`` is the threshold;
   ``LEAST_SCORE`` itself if nothing in the fold speaks against it, however few examples there are. Candidates
   above it whose digits pass the check and that touch no base span are added; of overlapping ones the better stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import let

KINDS = ["email", "ip", "card", "phone"]
BALANCE_ROWS = 20_000           # total weight of the training table, dealt over kinds and labels
SAMPLE_ROWS = BALANCE_ROWS      # the name of old: every labelled candidate counts
MAX_BINS = 512                  # more than a feature has values: every value may be a split
SCORE_STEPS = 10_000            # thresholds are multiples of 1 / SCORE_STEPS
PRECISION, LEAST_SCORE = 0.95, 0.5
BLOCK = 256                     # matches per inner aggregate, so that long lists are not copied match by match
LEFT, RIGHT = 32, 16            # characters of context

_LOCAL = "A-Za-z0-9._%+-"
# Base patterns as the contract states them, in possessive form (same matches: nothing after a loop could use what it gives
# back, and no recursion or rescanning on long runs). A match can only begin where a run begins or the last match ended.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}(?:\x20?@\x20?[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{1,5}}"
             r"|\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{1,63}){1,5}"
             r"|\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{1,63}){1,5})",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\]|\(\.\)|,)\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\x20?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9])",
}
#: A kind's patterns can match only in texts with one of these.
HINTS = {"email": ["@", "(at)", "[at]", " dot "], "ip": list("0123456789"), "card": list("0123456789"), "phone": list("0123456789")}
CONTEXT = {
    "email": r"(?i)mail|contact|kontakt|correo|courriel|write to",
    "ip": r"(?i)\bip\b|host|server|addr|login|serveur|servidor",
    "card": r"(?i)card|visa|master|credit|karte|tarjeta|carte|pay",
    "phone": r"(?i)phone|tel\b|tel[.:é]|call|fax|mobil|m[oó]vil|whatsapp|anruf",
}
FEATURES = ["kind", "chars", "digits", "letters", "groups", "longest", "shortest", "spaces", "dashes", "dots", "parens", "at_sign",
            "left_letter", "left_digit", "left_space", "left_plus", "right_letter", "right_digit", "right_space", "context", "context_digits"]
_SPAN = "array<struct<s:int,e:int,m:string,l:string,r:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches as (s, e, m, l, r): start and end in code points, the match, and the context on both sides.

    The text between matches (split) and the matches themselves alternate, so places are running sums of lengths.
    """
    def add(acc, x):
        s = acc["at"] + x["gap"]
        span = F.struct(s.alias("s"), (s + x["len"]).alias("e"), x["m"].alias("m"), x["l"].alias("l"), x["r"].alias("r"))
        return F.struct((s + x["len"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def in_block(block):
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")), add)

    def move(acc, b):
        moved = F.transform(b["out"], lambda x: F.struct((x["s"] + acc["at"]).alias("s"), (x["e"] + acc["at"]).alias("e"), x["m"].alias("m"),
                                                         x["l"].alias("l"), x["r"].alias("r")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def place(p):
        hits = F.transform(p["hits"], lambda h, i: F.struct(
            h.alias("m"), F.length(h).alias("len"), F.length(F.get(p["gaps"], i)).alias("gap"),
            F.substring(F.get(p["gaps"], i), -LEFT, LEFT).alias("l"), F.substring(F.get(p["gaps"], i + 1), 1, RIGHT).alias("r")))

        def blocks(h):
            cuts = F.sequence(F.lit(0), F.floor((F.size(h) - 1) / BLOCK).cast("int"))
            parts = F.transform(cuts, lambda b: in_block(F.slice(h, b * BLOCK + 1, F.lit(BLOCK))))
            start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
            return F.flatten(F.aggregate(parts, start, move, lambda acc: acc["out"]))
        return F.when(F.size(p["hits"]) > 0, let(hits, blocks)).otherwise(F.array().cast(_SPAN))
    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), place)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a short digit string."""
    n = F.length(digits)

    def weigh(acc, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return acc + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), weigh) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """The fixed check of a base match."""
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _where(kind: str, text: Column, spans: Column) -> Column:
    there = reduce(lambda a, b: a | b, [F.contains(text, F.lit(h)) for h in HINTS[kind]])
    return F.when(there, spans)


def base_spans(kind: str, text: Column) -> Column:
    """(s, k, e) of the base matches of a kind that pass its check; k is the kind's number."""
    found = F.filter(matches(text, BASE[kind]), lambda x: passes(kind, x["m"]))
    spans = F.transform(found, lambda x: F.struct(x["s"], F.lit(KINDS.index(kind)).alias("k"), x["e"]))
    return F.coalesce(_where(kind, text, spans), F.array().cast("array<struct<s:int,k:int,e:int>>"))


def _form(kind: str):
    """Makes a candidate (s, k, e, features) of a loose match."""
    return lambda x: _candidate(kind, x)


def _valid(kind: str, m: Column, runs: Column) -> Column:
    """Do the digits of a loose match pass the kind's check?"""
    if kind == "ip":
        groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
        return (F.size(runs) == 4) & F.forall(groups, lambda g: F.rlike(g, F.lit(f"^{_OCTET}$")))
    return passes(kind, m)


def _candidate(kind: str, x: Column) -> Column:
    m, left, right = x["m"], x["l"], x["r"]
    count = lambda p: F.regexp_count(m, F.lit(p)).cast("double")
    is_ = lambda c, p: F.rlike(c, F.lit(p)).cast("double")
    runs = F.transform(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), F.length)
    values = [F.lit(float(KINDS.index(kind))), F.length(m).cast("double"), count("[0-9]"), count("[A-Za-z]"), F.size(runs).cast("double"),
              F.coalesce(F.array_max(runs), F.lit(0)).cast("double"), F.coalesce(F.array_min(runs), F.lit(0)).cast("double"),
              count(r"\x20"), count("-"), count(r"\."), count("[()]"), count("@"),
              is_(left, "[A-Za-z]$"), is_(left, "[0-9]$"), is_(left, r"\s$|^$"), is_(left, r"\+$"),
              is_(right, "^[A-Za-z]"), is_(right, "^[0-9]"), is_(right, r"^\s|^$"),
              is_(left, CONTEXT[kind]), F.regexp_count(F.concat(left, right), F.lit("[0-9]")).cast("double")]
    return F.struct(x["s"], F.lit(KINDS.index(kind)).alias("k"), x["e"], _valid(kind, m, runs).alias("v"), F.struct(*[v.alias(n) for v, n in zip(values, FEATURES)]).alias("f"))


def candidates(text: Column) -> Column:
    """All loose candidates of all kinds."""
    kinds = [_where(k, text, F.transform(matches(text, LOOSE[k]), _form(k))) for k in KINDS]
    features = ",".join(f"{n}:double" for n in FEATURES)
    none = F.array().cast(f"array<struct<s:int,k:int,e:int,v:boolean,f:struct<{features}>>>")
    return F.concat(*[F.coalesce(k, none) for k in kinds])


def found_spans(docs: DataFrame, id_col: str, text_col: str, keep: list[str] = ()) -> DataFrame:
    """id, ``base`` (sorted) and ``cands`` of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), *keep, F.array_sort(F.concat(*[base_spans(k, text) for k in KINDS])).alias("base"),
                       candidates(text).alias("cands"))


def _sql_tree(node) -> str:
    """A regression tree of the model as a CASE expression over the features of lambda variable ``c``."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    return (f"CASE WHEN c.f.{FEATURES[split.featureIndex()]} <= {float(split.threshold())!r}D THEN {_sql_tree(node.leftChild())} "
            f"ELSE {_sql_tree(node.rightChild())} END")


def shares(totals: dict, n: int) -> dict:
    """``n`` rows dealt evenly over groups of ``totals`` rows; what a small group leaves goes to the larger ones."""
    out = {}
    for i, (group, total) in enumerate(sorted(totals.items(), key=lambda x: (x[1], x[0]))):
        out[group] = min(total, (n - sum(out.values())) // (len(totals) - i))
    return out


def training_table(rows: DataFrame, n: int) -> DataFrame:
    """Every labelled candidate, equal ones as one row: c (k and the features f), label, calibrate and ``weight``.

    A row weighs as its candidates together; kinds with more than their share of ``n`` weigh as that share, so that a frequent kind
    leaves room for the others. A kind's rows keep their mix.
    """
    known = cut_lineage(rows.groupBy("c.k", "label", "calibrate", "c.f").agg(F.count(F.lit(1)).alias("count")), "pii_forms")
    totals = {(r["k"], r["label"]): r["n"] for r in known.groupBy("k", "label").agg(F.sum("count").alias("n")).collect()}      # kinds x labels rows
    held = shares(totals, n)
    kind = lambda of_, k: sum(m for g, m in of_.items() if g[0] == k)
    weight = F.element_at(F.array(*[F.lit(kind(held, k) / max(1, kind(totals, k))) for k in range(len(KINDS))]), F.col("k") + 1)
    return known.select(F.struct("k", "f").alias("c"), "label", "calibrate", (F.col("count") * weight).alias("weight"))


def fit_scorer(found: DataFrame, balance_rows: int = BALANCE_ROWS) -> tuple[str, list[float]]:
    """(SQL expression of a candidate's probability, threshold of each kind) from all labelled candidates.

    If the fitting fold has one label only, all candidates score as that label. A kind has threshold 2 (nothing is added) if
    no score of its calibration fold is precise.
    """
    def touches(same_kind: bool):
        return F.exists("base", lambda b: ((b["k"] == F.col("c.k")) == F.lit(same_kind)) & (b["s"] < F.col("c.e")) & (b["e"] > F.col("c.s")))
    label = F.when(touches(True), 1.0).when(touches(False) | ~F.col("c.v"), 0.0)
    rows = (found.filter(F.size("cands") > 0).select("id", "base", F.explode("cands").alias("c"))
            .select("c", label.alias("label"), (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("calibrate")).filter("label IS NOT NULL"))
    rows = training_table(rows, balance_rows)
    fit = rows.filter(~F.col("calibrate"))
    labels = [r["label"] for r in fit.select("label").distinct().collect()]                           # two at most
    if len(labels) < 2:
        score = f"{max(labels, default=0.0)!r}D"
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(fit.select("label", "weight", "c.f.*")).select("label", "weight", "features")
        model = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=11, weightCol="weight", maxBins=MAX_BINS).fit(vectors)
        margin = " + ".join(f"{float(w)!r}D * ({_sql_tree(t._java_obj.rootNode())})" for t, w in zip(model.trees, model.treeWeights))
        score = f"1 / (1 + exp(-2 * ({margin})))"
    p = F.floor(F.expr(score).cast("double") * SCORE_STEPS) / SCORE_STEPS
    held = rows.filter("calibrate").select("c.k", "label", "weight", p.alias("p")).groupBy("k", "label", "p").agg(F.sum("weight").alias("weight")).collect()   # SCORE_STEPS rows a kind and label at most
    return score, [threshold([(r["p"], r["label"], r["weight"]) for r in held if r["k"] == k]) for k in range(len(KINDS))]


def threshold(held: list[tuple]) -> float:
    """Least score from ``LEAST_SCORE`` on with ``PRECISION`` among the (score, label, weight) that reach it; 2 if there is none."""
    ranked = sorted((x for x in held if x[0] >= LEAST_SCORE), reverse=True)
    best, hits, n = 2.0, 0.0, 0.0
    for i, (p, y, w) in enumerate(ranked):
        hits, n = hits + w * y, n + w
        last_of_ties = i + 1 == len(ranked) or ranked[i + 1][0] < p
        if last_of_ties and hits >= PRECISION * n:
            best = p
    return LEAST_SCORE if hits >= PRECISION * n else best


def _added(scorer: str, thresholds: list[float]) -> Column:
    """Candidates above their kind's threshold that touch no base span; of overlapping ones the better (earlier if equal).

    One scan over base spans and candidates by start: ``pend`` is the last candidate not yet settled.
    """
    limits = "array(" + ", ".join(f"{t!r}D" for t in thresholds) + ")"
    one = "struct<s:int,k:int,e:int,p:double>"
    return F.expr(f"""
      aggregate(
        array_sort(concat(
          transform(base, b -> cast(named_struct('s', b.s, 'k', b.k, 'e', b.e, 'p', 9D) as {one})),
          filter(transform(filter(cands, c -> c.v), c -> cast(named_struct('s', c.s, 'k', c.k, 'e', c.e, 'p', {scorer}) as {one})), c -> c.p >= {limits}[c.k]))),
        named_struct('done', 0, 'pend', cast(null as {one}), 'out', cast(array() as array<{one}>)),
        (a, x) -> CASE
          WHEN x.p = 9D THEN named_struct('done', greatest(a.done, x.e), 'pend', cast(null as {one}),
            'out', CASE WHEN a.pend IS NOT NULL AND a.pend.e <= x.s THEN concat(a.out, array(a.pend)) ELSE a.out END)
          WHEN x.s < a.done THEN a
          WHEN a.pend IS NOT NULL AND x.s < a.pend.e THEN
            named_struct('done', a.done, 'pend', CASE WHEN x.p > a.pend.p THEN x ELSE a.pend END, 'out', a.out)
          ELSE named_struct('done', a.done, 'pend', x, 'out', CASE WHEN a.pend IS NOT NULL THEN concat(a.out, array(a.pend)) ELSE a.out END) END,
        a -> transform(CASE WHEN a.pend IS NOT NULL THEN concat(a.out, array(a.pend)) ELSE a.out END, x -> named_struct('s', x.s, 'k', x.k, 'e', x.e)))""")


def all_spans(found: DataFrame, sample_rows: int = BALANCE_ROWS) -> DataFrame:
    """``found`` with ``spans``: base and added spans (s, k, e), sorted."""
    scorer, thresholds = fit_scorer(found, sample_rows)
    spans = F.when(F.size("cands") > 0, F.array_sort(F.concat("base", _added(scorer, thresholds)))).otherwise(F.col("base"))
    return found.withColumn("spans", spans)


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _of(kind: int):
    return lambda x: x["k"] == kind


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = BALANCE_ROWS) -> DataFrame:
    """One row per input row: id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``n_added``.

    Counts and digest are of the base spans; ``spans`` also has the added ones. Null and empty texts have none (the
    digest is that of the empty string). Repeated rows and null ids are rows like any other; other columns
    are ignored. Empty input gives an empty result.
    """
    rows = all_spans(cut_lineage(found_spans(docs, id_col, text_col), "pii"), sample_rows)
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return rows.select(F.col("id").alias(id_col), *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
                       _joined("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = BALANCE_ROWS) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``.

    Overlapping spans become one, named after the first. All other columns and null texts stay as they are.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    found = cut_lineage(found_spans(rows.withColumns({"id": F.col(f"row.`{id_col}`"), "text": F.col(f"row.`{text_col}`")}), "id", "text", ["row"]), "pii")
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col(f"row.`{text_col}`")

    def put(acc, x):
        fresh = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["s"] - acc["at"])), F.array(F.get(tags, x["k"])))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("spans", start, put, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    out = all_spans(found, sample_rows)
    new = F.when(F.size("spans") > 0, clean).otherwise(text)
    return out.select(*[new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
