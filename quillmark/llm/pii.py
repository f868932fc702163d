"""Personal data by weak supervision, in DataFrame operations only.

Base spans come from four regular expressions and their checks; they always stay. Looser expressions propose candidates
beyond them (telephone numbers without a plus sign, spelled-out addresses, runs of characters that may be credentials). Over base
spans and candidates several labelers vote yes, no or abstain:

* regex: the strict form matches;
* gazetteer: a fixed list knows a part of the span: the domain's ending, the country's or area's calling code, the card's issuer, the
  credential's prefix (yes); special address blocks, numbers and domains kept for examples say nothing;
* cue: a word such as ``tel``, ``mail`` or ``token`` stands shortly before the span;
* context: the characters around the span are white space or punctuation (yes), or the span is part of a longer
  number, address or path (no);
* shape: length, number of distinct characters and, for credentials, the mixture of letters and digits suit the kind.

Expectation-maximisation over the votes estimates how reliable each labeler is. Votes are counted by pattern first, so the
estimation runs on at most 3**5 rows, as one fold over that small array. Its posteriors are the soft labels that train the final classifier, naive Bayes within each kind over the span's features
(strictness, cue, context, shape, gazetteer, length band), whose table is as small. Its rates are drawn towards the feature's share among all spans, so a
feature that the soft labels hardly tell apart says hardly anything. A candidate becomes a span when the classifier gives it ``accept`` or more and no
base span overlaps it.

Regular expressions start at run starts or where the last match ended (``\\G``) and use possessive repeats, which gives
the leftmost matches of the plain forms in time linear in the text; a candidate takes its whole run, however long. Positions are sums by
stretches of ``_STRETCH`` matches, so texts with many matches stay cheap. Texts are read once; what is kept of a document is its
candidates. Nothing is shuffled but counts.

Defined results: a null or empty text has no spans. Positions are code points, ends exclusive. Repeated rows are treated alike.
Candidate kinds beyond the four come after them in the order of ``KINDS``. An empty table gives no rows. Input columns named ``found`` or
``spans`` are replaced; others, but for text, stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.shared import checkpointed, without

KINDS = ("email", "ip", "card", "phone", "secret")
_BEFORE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)",
    "ip": r"(?:(?<![0-9])|\G)",
}
#: Base forms. A card is a whole run of digits with single separators, so only runs of 12 to 19 digits match.
BASE = {
    "email": _BEFORE["email"] + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _BEFORE["ip"] + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for the form to match at all; cheap to test.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.)(-])(?<![0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+",
}
_LOOSE_NEEDS = {"email": "at", "phone": "", "secret": ""}
#: Words that announce a kind, standing at most a few characters before it.
_CUES = {
    "email": r"(?i)(?:mail|contact|write to|address)[^\n]{0,12}$",
    "ip": r"(?i)(?:\bip|host|server|address|addr)[^\n]{0,12}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|account)[^\n]{0,12}$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell)[^\n]{0,12}$",
    "secret": r"(?i)(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|credential|bearer)[ ]?[=:]?[ ]?[\"']?$",
}
#: Public endings of domains, calling codes, card issuers and credential prefixes.
_GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|info|biz|co|eu|uk|de|fr|es|it|nl|ch|at|be|pl|se|no|dk|fi|pt|ie|us|ca|mx|br|ar|cl|au|nz|jp|cn|in|kr|sg|za|ru)$",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|36|30[0-5])",
    "phone": r"^\+?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|35[1-9]|37[0-9]|38[0-9]|42[013]|85[2356]|88[06]|96[0-8]|97[1-7])[ ().-]",
    "secret": r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|xox[abprs]-|sk-|sk_live_|rk_live_|AIza|ya29|eyJ|glpat-|npm_|pypi-)",
}
_BAND = 6
_STRETCH = 256
_LABELERS = 5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.filter(F.split(F.reverse(number), ""), lambda d: d != "")
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 1, F.expr("2") * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d.cast("int")) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.char_length(p) < 3) | (F.char_length(p) == 3) & (p <= "255"))
    if kind == "card":
        return luhn(_digits(text))
    if kind == "phone":
        return F.char_length(_digits(text)).between(9, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda an expression would be evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(text: Column, kind: str, form: str, base: bool) -> Column:
    """Array of (kind, start, end, base, text, before, after): matches are located by the lengths of what lies between them."""

    def parts(x: Column) -> Column:
        chars = F.transform(x["m"], lambda m, i: (F.char_length(m) + F.char_length(F.get(x["g"], i))).cast("long"))
        return F.struct(x["m"].alias("m"), x["g"].alias("g"), chars.alias("n"))

    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, n: s + n)

    def sums(x: Column) -> Column:
        stretches = F.transform(F.sequence(F.lit(0), F.floor(F.size(x["n"]) / _STRETCH).cast("int")), lambda b: total(F.slice(x["n"], b * _STRETCH + 1, F.lit(_STRETCH))))
        return F.struct(x["m"].alias("m"), x["g"].alias("g"), x["n"].alias("n"), stretches.alias("s"))

    def spans(x: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            before = F.floor(i / _STRETCH).cast("int")
            end = total(F.slice(x["s"], F.lit(1), before)) + total(F.slice(x["n"], before * _STRETCH + 1, i % _STRETCH + 1))
            return F.struct(
                F.lit(kind).alias("kind"), (end - F.char_length(m)).alias("start"), end.alias("end"), F.lit(base).alias("base"), m.alias("text"),
                F.right(F.get(x["g"], i), F.lit(24)).alias("before"), F.left(F.get(x["g"], i + 1), F.lit(2)).alias("after"),
            )

        return F.transform(x["m"], span)

    matched = F.struct(F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("m"), F.split(text, form, -1).alias("g"))
    found = _let(_let(_let(matched, parts), sums), spans)
    return F.filter(found, lambda s: _valid(kind, s["text"])) if base else found


_SPAN = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,text:string,before:string,after:string>>"


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` without text, plus ``found``: base spans and looser candidates that no base span overlaps."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.expr(f"cast(array() as {_SPAN})")

    def where(kind: str, form: str, needs: str, base: bool) -> Column:
        test = F.rlike(text, F.lit(form))
        if needs:
            test = F.contains(text, F.lit(needs)) & test
        return F.when(test, _found(text, kind, form, base)).otherwise(none)

    base = [where(k, BASE[k], _NEEDS.get(k, ""), True).alias(f"__{k}") for k in BASE]
    loose = [where(k, LOOSE[k], _LOOSE_NEEDS[k], False).alias(f"__loose_{k}") for k in LOOSE]
    names = [f"__{k}" for k in BASE], [f"__loose_{k}" for k in LOOSE]
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
    out = docs.select(*keep, *base, *loose)
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"], F.concat(*names[0]).alias("__base"), F.concat(*names[1]).alias("__more"))
    free = F.filter("__more", lambda m: ~F.exists("__base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return out.withColumn("found", F.concat("__base", free)).drop("__base", "__more")


def _by_kind(kind: Column, forms: dict[str, str], tested: Column) -> Column:
    """Whether the kind's form matches; null for kinds without one."""
    out = F.lit(None).cast("boolean")
    for name, form in forms.items():
        out = F.when(kind == name, F.rlike(tested, F.lit(form))).otherwise(out)
    return out


def votes(s: Column) -> Column:
    """The labelers' votes on a span: 1 yes, -1 no, 0 abstain."""
    text, secret = s["text"], s["kind"] == "secret"
    strict = F.when(s["base"], 1).otherwise(0)
    known = F.when(_by_kind(s["kind"], _GAZETTEER, text), 1).otherwise(0)
    cue = F.when(_by_kind(s["kind"], _CUES, s["before"]), 1).otherwise(0)
    torn = F.rlike(s["before"], F.lit(r"[A-Za-z0-9_/\\.]$")) | F.rlike(s["after"], F.lit(r"^(?:[A-Za-z0-9_/\\@]|[.-][0-9A-Za-z])"))
    context = F.when(torn, -1).otherwise(1)
    distinct = F.size(F.array_distinct(F.split(text, "")))
    n, runs = F.char_length(text), F.size(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)))
    # A credential mixes letters and digits; one of words and numbers joined by signs is none.
    mixed = F.when((distinct < 4) | F.rlike(text, F.lit(r"^(?:[A-Za-z]++|[0-9]++)(?:[-_/+=]++(?:[A-Za-z]++|[0-9]++))++[-_/+=]*+$")), -1).when((runs >= 4) & (distinct >= 8), 1).otherwise(0)
    plain = F.when(distinct < F.when(s["kind"] == "ip", 2).otherwise(4), -1).when(n.between(7, 80), 1).otherwise(0)
    return F.array(strict, known, cue, context, F.when(secret, mixed).otherwise(plain))


def _feature(s: Column) -> Column:
    """The classifier's features as strings from a small fixed space."""
    v = votes(s)
    band = F.least(F.floor(F.char_length(s["text"]) / _BAND), F.lit(12))
    names = [F.concat(F.lit(f"{n}:"), s["kind"], F.lit(":"), F.get(v, F.lit(i)).cast("string")) for i, n in ((0, "strict"), (1, "known"), (2, "cue"), (3, "context"), (4, "shape"))]
    return F.array(*names, F.concat(F.lit("length:"), s["kind"], F.lit(":"), band.cast("string")), F.concat(F.lit("kind:"), s["kind"]))


#: Where estimation starts, and what ``_IMAGINED`` imagined spans of each class keep saying: rates of no, abstention and yes.
_TRUE, _FALSE, _IMAGINED = (0.1, 0.3, 0.6), (0.35, 0.5, 0.15), 4


def estimate(found: DataFrame, iterations: int = 20) -> DataFrame:
    """(pattern, posterior, state): expectation-maximisation over vote patterns, as one fold over the array of counted patterns.

    A labeler says no, abstains or says yes with rates of its own for true and for false spans. Base spans and candidates are
    estimated apart, since a labeler that often abstains on one may be telling on the other. The fold's state is the
    share of true spans and those rates.
    """
    pattern = found.select(F.explode("found").alias("s")).groupBy(votes(F.col("s")).alias("pattern")).agg(F.count("*").cast("double").alias("n"))
    table = pattern.groupBy(F.get("pattern", F.lit(0)).alias("base")).agg(F.array_sort(F.collect_list(F.struct("pattern", "n"))).alias("p"))
    labelers = F.sequence(F.lit(0), F.lit(_LABELERS - 1))
    kind = "struct<prior:double,t:array<array<double>>,f:array<array<double>>>"
    zero = F.lit(0.0).cast("double")

    def posterior(state: Column, votes_: Column) -> Column:
        side = lambda rate: F.aggregate(labelers, F.lit(1.0).cast("double"), lambda a, i: a * F.get(F.get(state[rate], i), F.get(votes_, i) + 1))
        yes, no = state["prior"] * side("t"), (1 - state["prior"]) * side("f")
        return yes / (yes + no)

    def step(state: Column, _: Column) -> Column:
        scored = F.transform("p", lambda x: F.struct(x["pattern"].alias("v"), (x["n"] * posterior(state, x["pattern"])).alias("t"), (x["n"] * (1 - posterior(state, x["pattern"]))).alias("f")))

        def estimated(scored: Column) -> Column:
            total = lambda which: F.aggregate(scored, zero, lambda a, x: a + x[which])

            def rates(which: str, start: tuple) -> Column:
                said = lambda i, v: F.aggregate(scored, zero, lambda a, x: a + F.when(F.get(x["v"], i) == v, x[which]).otherwise(zero))
                return F.transform(labelers, lambda i: F.array(*[(said(i, v) + _IMAGINED * start[v + 1]) / (total(which) + _IMAGINED) for v in (-1, 0, 1)]))

            return F.struct(((total("t") + 1) / (total("t") + total("f") + 2)).alias("prior"), rates("t", _TRUE).alias("t"), rates("f", _FALSE).alias("f")).cast(kind)

        return _let(scored, estimated)

    start = lambda rates: F.array(*[F.array(*map(F.lit, rates))] * _LABELERS)
    first = F.struct(F.lit(0.5).alias("prior"), start(_TRUE).alias("t"), start(_FALSE).alias("f")).cast(kind)
    fitted = table.select("p", F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), first, step).alias("state"))
    return fitted.select("state", F.explode("p").alias("x")).select(F.col("x.pattern").alias("pattern"), posterior(F.col("state"), F.col("x.pattern")).alias("posterior"), F.col("state"))


def _classifier(found: DataFrame, smooth: float = 4.0) -> Column:
    """Naive Bayes within each kind as a map column from features to log odds; bounded by the feature space.

    ``kind:k`` carries the kind's prior odds, every other feature the odds of its rates among the kind's true and false spans, both drawn
    towards its share of all the kind's spans.
    """
    soft = F.create_map(*[x for r in estimate(found).collect() for x in (F.lit(",".join(map(str, r["pattern"]))), F.lit(float(r["posterior"])))] or [F.lit(""), F.lit(0.5)])
    span = found.select(F.explode("found").alias("s")).select(F.col("s.kind").alias("kind"), F.try_element_at(soft, F.array_join(votes(F.col("s")), ",")).alias("q"), _feature(F.col("s")).alias("features"))
    counted = span.select("kind", F.coalesce("q", F.lit(0.5)).alias("q"), F.explode("features").alias("f")).groupBy("kind", "f").agg(F.sum("q").alias("t"), F.sum(1 - F.col("q")).alias("n")).collect()
    of_kind = {r["kind"]: (r["t"], r["n"]) for r in counted if r["f"] == f"kind:{r['kind']}"}
    weights = {}
    for r in counted:
        t, n = of_kind[r["kind"]]
        pulled = smooth * (r["t"] + r["n"]) / (t + n)
        weights[r["f"]] = math.log((t + 1) / (n + 1)) if r["f"].startswith("kind:") else math.log((r["t"] + pulled) / (t + smooth)) - math.log((r["n"] + pulled) / (n + smooth))
    return F.create_map(*[x for f, w in sorted(weights.items()) for x in (F.lit(f), F.lit(float(w)))] or [F.lit(""), F.lit(0.0)])


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def find_pii(docs: DataFrame, *, accept: float = 0.5) -> DataFrame:
    """``docs`` without text, plus ``spans``: (kind, start, end, base, probability), by start, then kind."""
    found = checkpointed(candidates(without(docs, "found", "spans")))
    weights = _classifier(found)
    logit = lambda s: F.aggregate(_feature(s), F.lit(0.0).cast("double"), lambda a, f: a + F.coalesce(F.try_element_at(weights, f), F.lit(0.0)))
    scored = F.transform("found", lambda s: F.struct(s["start"].alias("start"), _rank(s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"), (1 / (1 + F.exp(-logit(s)))).alias("probability")))
    return found.withColumn("spans", F.array_sort(F.filter(scored, lambda s: s["base"] | (s["probability"] >= accept)))).drop("found")


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
