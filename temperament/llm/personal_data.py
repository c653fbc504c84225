"""Personal data by candidates and gradient-boosted trees; DataFrame operations only.

Strict patterns give the base spans. Wider patterns propose candidates that may overlap them: addresses
written with `at` and `dot`, numbers with other separators, phones without a plus. Boosted trees, trained on all of them, where a candidate is positive if it lies on a base span of its kind, score candidates by their format
and context; the plus, the `@` and other marks that the strict patterns ask for are no features. Per kind, a
limit that keeps the precision on held-out candidates selects the spans that are added. Everything is local to a row.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temperament.session import settle

KINDS = ("email", "ip", "card", "phone")
#: Candidates on either side of a split, at least.
LEAST = 4
PRECISION = 0.98
#: Characters of context on either side.
CONTEXT = 24
#: Values of a list that one running fold appends.
BLOCK = 256

# fixed values: the patterns of base spans. Guards before them and possessive quantifiers leave the matches as they are
# and keep the search linear in long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
WIDE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+ ?(?:@|[(\[]at[)\]]| at ) ?[A-Za-z0-9-]{1,64}+(?: ?(?:\.|[(\[]dot[)\]]| dot ) ?[A-Za-z0-9-]{1,64}+){1,6}+",
    "ip": r"[0-9]{1,5}+(?:[.:_-][0-9]{1,5}+){3}+",
    "card": r"[0-9](?:[ ._/-]{0,2}[0-9]){11,22}+",
    "phone": r"\(?[0-9][ ()./0-9-]{5,24}[0-9]",
}
NEEDS = {"email": r"@|[(\[]at[)\]]| at ", "ip": r"[0-9][.:_-][0-9]", "card": r"[0-9][ ._/-]{0,2}[0-9]", "phone": r"[0-9]"}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(text)).between(16, 19) & F.call_function("luhn_check", _digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """These names, each with underscores before it until no column of `docs` is called so."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def _running(docs: DataFrame, name: str, values: str, combine) -> DataFrame:
    """Add `name`: `combine` (sum or maximum of integers from 0 on) of all values up to each place of the array `values`.

    A fold that appends copies its list at every value. Here lists are appended inside blocks of `BLOCK` values, which start from the
    combined totals of the blocks before them, so the work per value has a bound of its own.
    """
    blocks, starts = _unused(docs, "_blocks", "_starts")

    def listed(part: Column, start: Column) -> Column:
        state = F.struct(start.alias("last"), F.array().cast("array<int>").alias("all"))

        def step(s: Column, x: Column) -> Column:
            now = combine(s["last"], x)
            return F.struct(now.alias("last"), F.concat(s["all"], F.array(now)).alias("all"))

        return F.aggregate(part, state, step, lambda s: s["all"])

    last = F.greatest(F.floor((F.size(values) - 1) / BLOCK).cast("int"), F.lit(0))
    docs = docs.withColumn(blocks, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK))))
    totals = F.transform(blocks, lambda part: F.aggregate(part, F.lit(0), combine))
    # the start of a block is the running total of those before it; the total after the last block starts nothing
    docs = docs.withColumn(starts, F.slice(F.concat(F.array(F.lit(0)), listed(totals, F.lit(0))), F.lit(1), F.size(blocks)))
    paired = F.arrays_zip(F.col(blocks).alias("part"), F.col(starts).alias("start"))
    whole = F.flatten(F.transform(paired, lambda p: listed(p["part"], p["start"])))
    return docs.withColumn(name, whole).drop(blocks, starts)


def _found(docs: DataFrame, name: str, pattern: str, needs: str | None = None) -> DataFrame:
    """Add `name`: the leftmost non-overlapping matches as (start, stop, match, before, after), in code points."""
    used, hits, gaps, sizes, stops = _unused(docs, "_text", "_hits", "_gaps", "_sizes", "_stops")
    text = F.col("text") if needs is None else F.when(F.col("text").rlike(needs), F.col("text")).otherwise(F.lit(""))
    docs = docs.withColumn(used, text)
    docs = docs.withColumns({hits: F.regexp_extract_all(used, F.lit(pattern), F.lit(0)), gaps: F.split(used, pattern, -1)})
    matched = F.arrays_zip(F.col(hits).alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"))
    docs = docs.withColumn(sizes, F.transform(matched, lambda x: F.length(x["gap"]) + F.length(x["hit"])))
    docs = _running(docs, stops, sizes, lambda total, size: total + size)
    zipped = F.arrays_zip(
        F.col(hits).alias("hit"),
        F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"),
        F.slice(gaps, F.lit(2), F.size(hits)).alias("next"),
        F.col(stops).alias("stop"),
    )

    def span(x: Column) -> Column:
        return F.struct(
            (x["stop"] - F.length(x["hit"])).alias("start"), x["stop"].alias("stop"), x["hit"].alias("match"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["next"], F.lit(CONTEXT)).alias("after"),
        )

    return docs.withColumn(name, F.transform(zipped, span)).drop(used, hits, gaps, sizes, stops)


def base_spans(docs: DataFrame) -> DataFrame:
    """Add base_<kind>: the valid matches of the strict patterns."""
    for kind in KINDS:
        docs = _found(docs, f"base_{kind}", BASE[kind], {"email": "@", "phone": r"\+", "ip": r"[0-9]\.[0-9]", "card": "[0-9]"}[kind])
        docs = docs.withColumn(f"base_{kind}", F.filter(f"base_{kind}", lambda x: _valid(kind, x["match"])))
    return docs


def _features(x: Column) -> dict[str, Column]:
    """Format and context of a candidate."""
    match, before, after = x["match"], x["before"], x["after"]
    last, first = F.right(before, F.lit(1)), F.left(after, F.lit(1))
    digits = _digits(match)
    count = lambda pattern, text=match: F.regexp_count(text, F.lit(pattern))
    number = {
        "length": F.length(match),
        "digits": F.length(digits),
        "letters": count("[A-Za-z]"),
        "dots": count(r"\."),
        "dashes": count("-"),
        "blanks": count(" "),
        "brackets": count(r"[()\[\]]"),
        "groups": count("[0-9]+"),
        "words": count("[A-Za-z]+"),
        "longest": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)),
        "luhn": F.coalesce(F.call_function("luhn_check", digits), F.lit(False)),
        "octets": match.rlike(rf"^{OCTET}([.:_-]{OCTET}){{3}}$"),
        "letter_before": last.rlike(r"[A-Za-z_]"),
        "digit_before": last.rlike(r"[0-9.]"),
        "quote_before": last.rlike(r"[\"'=#/]"),
        "letter_after": first.rlike(r"[A-Za-z_]"),
        "digit_after": first.rlike(r"[0-9]"),
        "quote_after": first.rlike(r"[\"'=#/]"),
        "digits_around": count("[0-9]", before) + count("[0-9]", after),
        "secret_before": F.lower(before).rlike("token|key|secret|passw|hash|id\\b|version"),
        "named_before": F.lower(before).rlike("mail|phone|tel|call|card|visa|address|contact|server|host"),
    }
    return {name: value.cast("double") for name, value in number.items()}


def candidates(docs: DataFrame) -> DataFrame:
    """Add wide_<kind>: the candidates with their features."""
    for kind in KINDS:
        docs = _found(docs, f"wide_{kind}", WIDE[kind], NEEDS[kind])

        def described(x):
            return F.struct(
                x["start"].alias("start"), x["stop"].alias("stop"), F.struct(*[v.alias(n) for n, v in _features(x).items()]).alias("f")
            )

        docs = docs.withColumn(f"wide_{kind}", F.transform(f"wide_{kind}", described))
    return docs


def _overlaps(docs: DataFrame, name: str, base: str, others: str) -> DataFrame:
    """Add `name`: whether each span of `others`, which are in order of their starts, overlaps a span of `base`.

    Spans of one list never overlap each other. So in the order of starts, a span of `others` overlaps a base span if one
    before it stops behind its start, or the very next span is of the base and starts before its end.
    """
    merged, ends, reach = _unused(docs, "_merged", "_ends", "_reach")

    def placed(spans: str, is_base: bool) -> Column:
        fields = lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), F.lit(is_base).alias("base"))
        return F.transform(spans, fields)

    docs = docs.withColumn(merged, F.sort_array(F.concat(placed(base, True), placed(others, False))))
    docs = docs.withColumn(ends, F.transform(merged, lambda x: F.when(x["base"], x["stop"]).otherwise(F.lit(0))))
    docs = _running(docs, reach, ends, lambda furthest, end: F.greatest(furthest, end))
    zipped = F.arrays_zip(
        F.col(merged).alias("span"), F.col(reach).alias("reach"), F.slice(merged, F.lit(2), F.greatest(F.size(merged), F.lit(1))).alias("next")
    )
    follows = lambda x: F.coalesce(x["next"]["base"] & (x["next"]["start"] < x["span"]["stop"]), F.lit(False))
    theirs = F.filter(zipped, lambda x: ~x["span"]["base"])
    return docs.withColumn(name, F.transform(theirs, lambda x: (x["reach"] > x["span"]["start"]) | follows(x))).drop(merged, ends, reach)


def _tree_sql(node, names: list[str]) -> str:
    """A fitted tree as a SQL expression over the features of x.f."""
    if node.subtreeDepth() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    return (
        f"CASE WHEN x.f.{names[split.featureIndex()]} <= {float(split.threshold())!r}D THEN {_tree_sql(node.leftChild(), names)} "
        f"ELSE {_tree_sql(node.rightChild(), names)} END"
    )


def train(docs: DataFrame, sample: int | None = None, seed: int = 5) -> dict[str, tuple[str, float]]:
    """Per kind the boosted score as SQL over a candidate `x`, and the limit it has to reach.

    Learns from the candidates of all documents; those of a third of the texts stay aside for the limits. Candidates that agree in all features
    count together, as one row with a weight. With `sample`, learns from about so many documents, drawn by a hash of the text among those with
    digits or an `@`. A kind without candidates of both sorts adds no spans.
    """
    hinted = docs.select(F.coalesce("text", F.lit("")).alias("text")).where(F.col("text").rlike(r"[0-9]{2}|@"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 30))
    drawn = hinted.withColumn("aside", draw % 3 == 0)
    if sample is not None:
        drawn = drawn.where(draw < int(min(1.0, sample / max(hinted.count(), 1)) * (1 << 30)))
    spans = candidates(base_spans(drawn))
    parts = []
    for kind in KINDS:
        own = _overlaps(spans, "on_base", f"base_{kind}", f"wide_{kind}")
        one = own.select("aside", F.explode(F.arrays_zip(F.col(f"wide_{kind}").alias("x"), F.col("on_base").alias("on_base"))).alias("c"))
        parts.append(one.select(F.lit(kind).alias("kind"), "aside", "c.x", F.col("c.on_base").cast("int").alias("label")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    names = rows.select("x.f.*").columns
    rows = rows.select("kind", "aside", "label", *[F.col(f"x.f.{n}").alias(n) for n in names])
    rows = settle(rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("n")), "personal-candidates")
    seen = {(r["kind"], r["aside"], r["label"]): r["n"] for r in rows.groupBy("kind", "aside", "label").agg(F.sum("n").alias("n")).collect()}
    models = {}
    for kind in KINDS:
        if not all((kind, False, label) in seen for label in (0, 1)):
            continue
        own = rows.where((F.col("kind") == kind) & ~F.col("aside"))
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(own)
        # the share of all weights that makes up `LEAST` candidates
        least = min((LEAST - 0.5) / (seen[kind, False, 0] + seen[kind, False, 1]), 0.49)
        trees = GBTClassifier(maxIter=10, maxDepth=3, stepSize=0.3, seed=seed, weightCol="n", minWeightFractionPerNode=least)
        fitted = trees.fit(vectors.select("features", "label", "n"))
        trees = [_tree_sql(tree._call_java("rootNode"), names) for tree in fitted.trees]
        score = " + ".join(f"{float(w)!r}D * ({t})" for w, t in zip(fitted.treeWeights, trees))
        # scores in steps of a thousandth: the trees bound their sum, and so the number of steps, whatever the sample
        held = rows.where((F.col("kind") == kind) & F.col("aside")).withColumn("x", F.struct(F.struct(*names).alias("f")))
        held = held.select((F.floor(F.expr(score) * 1000) / 1000).alias("score"), "label", "n")
        steps = held.groupBy("score").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).orderBy(F.desc("score")).collect()
        right = count = 0
        limit = None
        for step in steps:
            right, count = right + step["right"], count + step["n"]
            if right >= PRECISION * count and step["score"] > 0:
                limit = step["score"]
        if limit is not None:
            models[kind] = (score, float(limit))
    return models


def find(docs: DataFrame, models: dict[str, tuple[str, float]]) -> DataFrame:
    """`docs` with base_<kind> and spans_<kind> (start, stop; base spans and added ones in order), from the whole `text`.

    A null text counts as empty. Added spans never overlap a base span of their kind. Input columns of these names are replaced; all others stay.
    The work grows with the length of a text and the number of its matches, not with its square.
    """
    names = [f"{part}_{kind}" for kind in KINDS for part in ("base", "spans", "wide")]
    docs = docs.drop(*names).withColumn("text", F.coalesce("text", F.lit("")))
    docs = candidates(base_spans(docs)) if models else base_spans(docs)
    place = lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))
    for kind in KINDS:
        base = F.transform(f"base_{kind}", place)
        if kind in models:
            score, limit = models[kind]
            docs = docs.withColumn(f"wide_{kind}", F.expr(f"filter(wide_{kind}, x -> round({score}, 6) >= {limit!r}D)"))
            (on_base,) = _unused(docs, "_on_base")
            docs = _overlaps(docs, on_base, f"base_{kind}", f"wide_{kind}")
            chosen = F.arrays_zip(F.col(f"wide_{kind}").alias("x"), F.col(on_base).alias("on_base"))
            added = F.transform(F.filter(chosen, lambda c: ~c["on_base"]), lambda c: place(c["x"]))
            docs = docs.withColumn(f"wide_{kind}", added).drop(on_base)
            base = F.sort_array(F.concat(base, F.col(f"wide_{kind}")))
        docs = docs.withColumn(f"spans_{kind}", base)
    return docs.drop(*[f"wide_{kind}" for kind in KINDS])


def span_list(docs: DataFrame, part: str) -> Column:
    """kind:start:stop of all spans of `base` or `spans`, by kind and start, comma-joined."""
    def named(kind: str) -> Column:
        return F.transform(f"{part}_{kind}", lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["stop"].cast("string")))

    lists = [named(kind) for kind in KINDS]
    return F.array_join(F.concat(*lists), ",")


def redact(found: DataFrame) -> DataFrame:
    """Replace every span of spans_<kind> in `text` by [KIND]; where spans overlap, the one that starts first wins, then the longer one."""
    def marked(kind: str) -> Column:
        mark = F.lit(f"[{kind.upper()}]").alias("mark")
        return F.transform(f"spans_{kind}", lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("end"), mark))

    spans = F.array_sort(F.concat(*[marked(kind) for kind in KINDS]))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(so_far: Column, x: Column) -> Column:
        taken = x["start"] >= so_far["at"]
        between = F.substring(F.col("text"), so_far["at"] + 1, x["start"] - so_far["at"])
        return F.struct(
            F.when(taken, -x["end"]).otherwise(so_far["at"]).alias("at"),
            F.when(taken, F.concat(so_far["out"], between, x["mark"])).otherwise(so_far["out"]).alias("out"),
        )

    rest = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    return found.withColumn("text", F.aggregate(spans, state, step, rest))
