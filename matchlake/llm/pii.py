"""Personal data by weak supervision, in DataFrame functions alone.

Patterns with checks give the base spans. Wider patterns give candidates besides them. Six
labelers (form, check, gazetteer, words before that speak for it or against it, surroundings)
vote on every candidate, base or not. Expectation-maximisation on the counts of vote
patterns estimates how reliable each labeler is for each kind, and so how likely each
candidate is personal data; with these likelihoods as labels a logistic regression on the
span's own features is trained, which decides on the candidates that are no base spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import fresh, stored

KINDS = ("email", "ip", "card", "phone")

# The four patterns. They match what the plain patterns match; possessive
# repeats and the look-behinds, which hold where a run of characters or the last match
# ends, only keep long runs of digits or letters from being scanned again and again.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}

# Wider patterns, gazetteers and context words.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){1,4}",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
WIDER_HINT = {"email": r"[ \])]dot|dot[\])]", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}
TOP_LEVEL = "com org net edu gov mil int info biz io co eu uk de fr es it nl be ch at pl se no dk fi pt ie us ca mx br ar au nz jp cn in ru"
PRIVATE_IP = r"^(?:0|10|127|22[4-9]|2[34][0-9]|25[0-5])\.|^192\.168\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.|^169\.254\."
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|4[4-9]|5)|35|30[0-5]|3[689]|50|5[6-8]|6)"
SPEAKS_FOR = {
    "email": r"e-?mail|mail|contact|write|kontakt|correo|courriel|adresse",
    "ip": r"\bip\b|address|host|server|client|login|adresse|dirección",
    "card": r"card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|cell|fax|sms|whatsapp|anruf|appel|llam",
}
SPEAKS_AGAINST = r"version|release|section|figure|table|chapter|isbn|order|invoice|token|hash|serial|build|sha|md5|key"
#: Characters looked at before and after a candidate.
BEFORE, AFTER = 40, 8
#: Texts are cut into parts of so many characters for that.
PART = 1024
#: Digits that a number needs to be a candidate for a card.
CARD_CANDIDATE = 13

LABELERS = ("form", "check", "gazetteer", "for", "against", "around")
FEATURES = ("plus", "brackets", "groups", "length", "digits", "valid", "joined", "context", "is_email", "is_ip", "is_card")


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each value combined with all before it (sum, maximum), in n log n steps.

    Each step takes in what is 1, 2, 4 ... places before; ``aggregate`` would copy its list for every value.
    """
    steps = F.filter(F.array(*[F.lit(2**n) for n in range(31)]), lambda step: step < F.size(values))

    def further(sums: Column, step: Column) -> Column:
        return F.transform(sums, lambda x, at: F.when(at >= step, combine(x, F.get(sums, at - step))).otherwise(x))

    return F.aggregate(steps, values, further)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """All matches, from left to right, as structs of match, begin and end (code points, end exclusive).

    The pieces between the matches have the lengths that the places are summed from.
    """
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(pieces, matches, lambda p, m: F.struct(F.char_length(p).alias("gap"), m.alias("match")))

    def placed(both: Column) -> Column:
        lengths = F.transform(both, lambda x: F.struct(x["match"].alias("match"), F.char_length(x["match"]).alias("length"), x["gap"].alias("gap")))
        ends = _once(F.transform(lengths, lambda x: x["gap"] + x["length"]), lambda steps: running(steps, lambda x, y: x + y))
        return F.zip_with(
            lengths, ends, lambda x, end: F.struct(x["match"].alias("match"), (end - x["length"]).alias("begin"), end.alias("end"))
        )

    # The piece after the last match has none.
    return _once(F.filter(both, lambda x: x["match"].isNotNull()), placed)


def _cut(parts: Column, begin: Column, length: Column) -> Column:
    """At most ``PART`` characters from ``begin`` on, out of a text's ``parts``; ``substr`` would count from its start."""
    at = F.floor(begin / PART).cast("int")
    two = F.concat(F.coalesce(F.get(parts, at), F.lit("")), F.coalesce(F.get(parts, at + 1), F.lit("")))
    return F.substr(two, begin - at * PART + 1, length)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.coalesce(F.substr(turned, place, F.lit(1)).try_cast("int"), F.lit(0))
        doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = _digits(match)
    if kind == "card":
        return F.char_length(digits).between(16, 19) & luhn(F.when(F.char_length(digits) < 20, digits).otherwise("1"))
    return F.char_length(digits).between(8, 15)


def _described(parts: Column, kind: str, base: bool) -> Callable[[Column], Column]:
    return lambda s: F.struct(
        F.lit(kind).alias("kind"),
        s["begin"].cast("long").alias("begin"),
        s["end"].cast("long").alias("end"),
        s["match"].alias("match"),
        (F.lit(base) & valid(kind, s["match"])).alias("base"),
        _cut(parts, F.greatest(s["begin"] - BEFORE, F.lit(0)), F.least(s["begin"], F.lit(BEFORE))).alias("before"),
        _cut(parts, s["end"], F.lit(AFTER)).alias("after"),
    )


def _candidates(text: Column, parts: Column) -> Column:
    """Base spans and wider candidates, with what the labelers look at."""
    lists = []
    empty = F.array().cast("array<struct<match:string,begin:int,end:int>>")
    for base, patterns, hints in ((True, BASE, HINT), (False, WIDER, WIDER_HINT)):
        for kind, pattern in patterns.items():
            spans = F.when(text.rlike(hints[kind]), found(text, pattern)).otherwise(empty)
            if base and kind == "card":
                spans = F.filter(spans, lambda s: F.char_length(_digits(s["match"])) >= CARD_CANDIDATE)
            described = F.transform(spans, _described(parts, kind, base))
            lists.append(described)
    return F.concat(*lists)


def _per_kind(values: dict[str, Column]) -> Column:
    return reduce(lambda rest, kind: F.when(F.col("kind") == kind, values[kind]).otherwise(rest), values, F.lit(None))


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1, or 0 for no vote."""
    vote = F.when(yes, 1)
    return F.coalesce((vote if no is None else vote.when(no, -1)).otherwise(0), F.lit(0))


def votes(candidates: DataFrame) -> DataFrame:
    """The six labelers' votes on each candidate."""
    match, digits = F.col("match"), _digits(F.col("match"))
    luhn_ok = luhn(F.when(F.char_length(digits) < 20, digits).otherwise("1"))
    top = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_LEVEL.split())
    check = {
        "email": match.rlike(r"[A-Za-z]{2,}$"),
        "ip": valid("ip", match),
        "card": F.char_length(digits).between(13, 19) & luhn_ok,
        "phone": F.char_length(digits).between(8, 15),
    }
    listed = {
        "email": top,
        "ip": ~match.rlike(PRIVATE_IP),
        "card": digits.rlike(ISSUER),
        "phone": match.rlike(r"^\+[1-9]") | match.rlike(r"^\(?[2-9][0-9]{2}"),
    }
    before = F.lower("before")
    joined = F.col("before").rlike(r"[A-Za-z0-9_@=/\"'-]$") | F.col("after").rlike(r"^[A-Za-z0-9_@/\"'-]")
    spoken = {kind: before.rlike(words) for kind, words in SPEAKS_FOR.items()}
    cast = {
        "form": _vote(F.col("base")),
        "check": _vote(_per_kind(check), ~_per_kind(check)),
        "gazetteer": _vote(_per_kind(listed), ~_per_kind(listed)),
        "for": _vote(_per_kind(spoken)),
        "against": _vote(F.lit(False), before.rlike(SPEAKS_AGAINST)),
        "around": _vote(~joined, joined),
    }
    return candidates.withColumns({f"vote_{k}": v for k, v in cast.items()})


def reliabilities(patterns: DataFrame, rounds: int = 10) -> dict[str, dict]:
    """Per kind: the share of personal data, and how likely each labeler votes so if it is and if not.

    ``patterns`` has the votes and their count ``n``: a row for each pattern, whatever the
    corpus. Every round of expectation-maximisation is one aggregate with a row for each
    kind, labeler and vote.
    """
    names = [f"vote_{k}" for k in LABELERS]
    one_by_one = F.explode(F.array(*[F.struct(F.lit(c).alias("labeler"), F.col(c).alias("vote")) for c in names]))
    belief = F.least(F.greatest(1 / (1 + F.exp(-sum((F.col(c) for c in names), F.lit(0)))), F.lit(0.02)), F.lit(0.98))
    known: dict[str, dict] = {}
    for _ in range(rounds):
        rated = patterns.select("kind", "n", (F.col("n") * belief).alias("p"), one_by_one.alias("cast"))
        sums = rated.groupBy("kind", "cast.labeler", "cast.vote").agg(F.sum("p").alias("yes"), F.sum(F.col("n") - F.col("p")).alias("no"))
        counts: dict[str, dict] = {}
        for row in sums.collect():  # at most 4 kinds, 6 labelers and 3 votes
            counts.setdefault(row["kind"], {})[row["labeler"], row["vote"]] = (row["yes"], row["no"])
        known = {}
        for kind, votes_ in counts.items():
            yes, no = (sum(x[i] for (c, _), x in votes_.items() if c == names[0]) for i in (0, 1))
            rates = {}
            for c in names:
                for v in (-1, 0, 1):
                    seen = votes_.get((c, v), (0.0, 0.0))
                    rates[c, v] = ((seen[0] + 0.5) / (yes + 1.5), (seen[1] + 0.5) / (no + 1.5))
            known[kind] = {"share": (yes + 1) / (yes + no + 2), "rates": rates}
        belief = likelihood(known)
    return known


def likelihood(known: dict[str, dict]) -> Column:
    """How likely a candidate is personal data, given its votes."""
    odds = {}
    for kind, of in known.items():
        terms = [F.lit(math.log(of["share"] / (1 - of["share"])))]
        for c in (f"vote_{k}" for k in LABELERS):
            ratio = {v: math.log(yes / no) for (name, v), (yes, no) in of["rates"].items() if name == c}
            terms.append(F.when(F.col(c) == 1, ratio[1]).when(F.col(c) == -1, ratio[-1]).otherwise(ratio[0]))
        odds[kind] = sum(terms[1:], terms[0])
    return 1 / (1 + F.exp(-(_per_kind(odds) if odds else F.lit(0.0))))


def span_features(candidates: DataFrame) -> DataFrame:
    """Features of a span's own form and surroundings, in few distinct values."""
    match, digits = F.col("match"), F.char_length(_digits(F.col("match")))
    flags = {
        "plus": match.startswith("+"),
        "brackets": match.contains("("),
        "groups": F.least(F.regexp_count(match, F.lit(r"[\x20.-]")), F.lit(4)) / 4,
        "length": F.least(F.floor(F.char_length(match) / 4), F.lit(8)) / 8,
        "digits": F.floor(4 * digits / F.char_length(match)) / 4,
        "valid": F.col("vote_check") == 1,
        "joined": F.col("vote_around") == -1,
        "context": (F.col("vote_for") + F.col("vote_against")).cast("double"),
        "is_email": F.col("kind") == "email",
        "is_ip": F.col("kind") == "ip",
        "is_card": F.col("kind") == "card",
    }
    return candidates.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in flags.items()})


def train(judged: DataFrame) -> Column | None:
    """The classifier as a column over ``FEATURES``; None without candidates.

    ``judged`` has candidates with votes and features. Spans of equal features are one row
    of the fit, weighted by their likelihoods.
    """
    names, columns = [f"vote_{k}" for k in LABELERS], list(FEATURES)
    patterns = stored(judged.groupBy("kind", *names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    known = reliabilities(patterns)
    if not known:
        return None
    alike = judged.withColumn("p", likelihood(known)).groupBy(*columns)
    alike = alike.agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    sides = [F.struct(F.lit(y).alias("label"), (F.col(c) + 1e-6).alias("weight")) for y, c in ((1.0, "yes"), (0.0, "no"))]
    rows = alike.select(*columns, F.explode(F.array(*sides)).alias("side")).select(*columns, "side.*")
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(stored(rows.coalesce(1), "span-features"))
    model = LogisticRegression(weightCol="weight", maxIter=15, regParam=1e-3, standardization=False).fit(vectors)
    terms = [F.col(c) * float(w) for c, w in zip(columns, model.coefficients, strict=True)]
    return 1 / (1 + F.exp(-sum(terms, F.lit(float(model.intercept)))))


def _clear(added: Column, base: Column) -> Column:
    """The added spans that overlap no base span.

    In order of place, with an added span at its end and a base span at its begin, a base span overlaps if it
    comes before and one that does ends after the added span's begin.
    """
    none = F.lit(None).cast("struct<begin:bigint,end:bigint,kind:string,base:boolean,score:double,match:string>")
    ends = F.transform(added, lambda a: F.struct(a["end"].alias("at"), F.lit(0).alias("turn"), F.lit(0).cast("long").alias("reach"), a.alias("span")))
    begins = F.transform(base, lambda b: F.struct(b["begin"].alias("at"), F.lit(1).alias("turn"), b["end"].alias("reach"), none.alias("span")))

    def swept(events: Column) -> Column:
        reach = _once(F.transform(events, lambda e: e["reach"]), lambda reach: running(reach, F.greatest))
        both = F.zip_with(events, reach, lambda e, r: F.struct(e["turn"].alias("turn"), r.alias("reach"), e["span"].alias("span")))
        return F.filter(both, lambda e: (e["turn"] == 0) & (e["reach"] <= e["span"]["begin"]))

    return F.transform(_once(F.array_sort(F.concat(ends, begins)), swept), lambda e: e["span"])


def _first(spans: Column) -> Column:
    """Of sorted spans those that overlap none taken before them, in order.

    Taken one after another within each chain of spans that overlap; chains don't touch each other.
    """

    def taken(chain: Column) -> Column:
        last = lambda done: F.get(done, F.size(done) - 1)["end"]
        empty = F.array().cast(_ADDED)
        return F.aggregate(
            chain, empty, lambda done, a: F.when((F.size(done) > 0) & (last(done) > a["begin"]), done).otherwise(F.concat(done, F.array(a)))
        )

    def chained(spans: Column) -> Column:
        reach = _once(F.transform(spans, lambda s: s["end"]), lambda ends: running(ends, F.greatest))
        begins = _once(
            reach,
            lambda reach: F.filter(
                F.transform(spans, lambda s, at: F.when((at == 0) | (F.get(reach, at - 1) <= s["begin"]), at)), lambda at: at.isNotNull()
            ),
        )
        cut = lambda begins: F.transform(
            begins, lambda at, n: taken(F.slice(spans, at + 1, F.coalesce(F.get(begins, n + 1), F.size(spans)) - at))
        )
        return F.flatten(_once(begins, cut))

    return _once(spans, chained)


def personal_data(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """``docs`` without text, with the spans of personal data found in its texts.

    Needs text; a column called spans is replaced. spans holds kind, begin, end (code points, end
    exclusive), base, score and match, by kind as in ``KINDS``, then begin. Base spans always stay;
    other candidates are added if the classifier gives them ``least`` and they overlap no base
    span nor an added one before them; of candidates with the same begin the shorter goes first,
    then by kind. NULL and empty texts have none, and an empty table gives an empty one.
    Repeated rows are judged each on its own. Texts of any length are searched whole, in time
    that grows with n log n of their matches.
    """
    row, list_, parts = fresh(docs, "row_id"), fresh(docs, "candidates"), fresh(docs, "parts")
    narrow = [c for c in docs.columns if c not in ("text", "spans")]
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.withColumn(parts, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}+"), F.lit(0)))
    seen = cut.select(*[F.col(f"`{c}`") for c in narrow], _candidates(text, F.col(parts)).alias(list_))
    numbered = stored(seen.withColumn(row, F.monotonically_increasing_id()), "candidates")
    candidates = numbered.select(F.col(row).alias("row"), F.explode(list_).alias("c")).select("row", "c.*")
    judged = stored(span_features(votes(candidates)).drop("before", "after"), "judged")
    score = train(judged)
    if score is None:
        return numbered.select(*[F.col(f"`{c}`") for c in narrow], F.array().cast(_SPANS).alias("spans"))
    # Those that are no base spans come back to their document by its row.
    wider = judged.where("NOT base").withColumn("score", score).where(F.col("score") >= least)
    added = wider.groupBy(F.col("row").alias(row)).agg(
        F.collect_list(F.struct("begin", "end", "kind", F.lit(False).alias("base"), "score", "match")).alias("added")
    )
    merged = numbered.join(added, row, "left")
    base = F.transform(
        F.filter(list_, lambda c: c["base"]),
        lambda c: F.struct(c["begin"], c["end"], c["kind"], c["base"], F.lit(1.0).alias("score"), c["match"]),
    )
    clear = _clear(F.coalesce("added", F.array().cast(_ADDED)), base)
    first = F.when(F.col("added").isNotNull(), _first(F.array_sort(clear))).otherwise(F.array().cast(_ADDED))
    every = F.concat(base.cast(_ADDED), first)
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(_place(s["kind"]).alias("place"), s["begin"], s["end"], s.alias("span"))))
    spans = F.transform(
        ordered,
        lambda s: F.struct(*[s["span"][c].alias(c) for c in ("kind", "begin", "end", "base", "score", "match")]),
    )
    return merged.select(*[F.col(f"`{c}`") for c in narrow], spans.cast(_SPANS).alias("spans"))


_ADDED = "array<struct<begin:bigint,end:bigint,kind:string,base:boolean,score:double,match:string>>"
_SPANS = "array<struct<kind:string,begin:bigint,end:bigint,base:boolean,score:double,match:string>>"


def _place(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)
