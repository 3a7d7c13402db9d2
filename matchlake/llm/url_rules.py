"""URL filters by association rules.

Written rules decide the urls that they fit. What they decide labels those urls, and combinations
of tokens that go with a verdict are mined from them. Rules with enough support and
confidence, and without a shorter rule that is as sure, judge all other urls. They are found by an
inverted index: a rule is filed under its rarest token, and looked up there by the urls
that have the token.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import fresh, stored

#: (verdict, host, path): holds for the host and its subdomains where the path starts with this one.
Rule = tuple[str, str, str]

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8


def host_of(url: Column) -> Column:
    """After the first ://, up to a slash, question mark, hash or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def written_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest of the rules that fit, as a struct of length, rule and verdict, or NULL.

    ``rules`` is a list written by hand and becomes part of the plan.
    """

    def fit(verdict: str, name: str, start: str) -> Column:
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = name + start
        return F.when(fits, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))

    none = F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(none, *[fit(*rule) for rule in rules]))


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a url, sorted: host labels, path segments, file ending and query keys.

    Digits in a segment count as one #, so that running numbers are one token.
    """
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "#")))
    ending = F.concat(F.lit("ending:"), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    query = F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&")
    keys = F.transform(query, lambda x: F.concat(F.lit("key:"), F.regexp_extract(x, "^([^=]*)", 1)))
    depth = F.concat(F.lit("depth:"), F.size(segments).cast("string"))
    every = F.concat(labels, segments, F.array(ending, depth), keys)
    told = F.filter(every, lambda x: ~x.rlike(r"^[a-z]+:$"))
    return F.when(F.length(host) + F.length(path) > 0, F.array_sort(F.array_distinct(told))).otherwise(F.array().cast("array<string>"))


def _extended(rows: DataFrame, keep: DataFrame) -> DataFrame:
    """``rows`` with one token more, once for each token of ``keep`` that they have; equal ones are counted together."""
    group = ["goal", "antecedent"]
    kept = rows.join(keep.groupBy(*group).agg(F.collect_set("token").alias("kept")), group)
    kept = kept.select(*group, F.filter("rest", lambda x: F.array_contains("kept", x)).alias("rest"), "hits", "misses")
    kept = kept.groupBy(*group, "rest").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    spread = kept.select("*", F.posexplode("rest").alias("at", "token"))
    longer = F.array_append("antecedent", F.col("token")).alias("antecedent")
    # Tokens that come later only, so that each combination is met once.
    spread = spread.select("goal", longer, F.expr("slice(rest, at + 2, size(rest))").alias("rest"), "hits", "misses")
    return spread.groupBy("goal", "antecedent", "rest").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))


def _hopeful(rows: DataFrame, least: int, min_confidence: float) -> DataFrame:
    """The antecedents in ``rows`` that some more tokens of theirs may make a rule, with ``missed``: all their misses.

    Rows of one antecedent and one ``rest`` stay or go together, whatever tokens are added. A rule
    needs a gain of 0, hits less misses at the odds of ``min_confidence``. So rows that lose bring
    no more hits into a rule than those that gain can pay for.
    """
    gain = (1 - min_confidence) * F.col("hits") - min_confidence * F.col("misses")
    gains = gain >= -1e-9 * (F.col("hits") + F.col("misses"))
    paid = F.sum(F.when(gains, F.greatest(gain, F.lit(0.0)) + 1e-9 * (F.col("hits") + F.col("misses"))).otherwise(0.0))
    worth = F.coalesce(F.max(F.when(~gains, F.col("hits") / -gain)), F.lit(0.0))
    most = F.sum(F.when(gains, F.col("hits")).otherwise(0)) + paid * worth
    found = rows.groupBy("goal", "antecedent").agg(F.sum("misses").alias("missed"), most.alias("most"))
    return found.where((F.col("most") >= least * (1 - 1e-9)) & (F.col("missed") > 0)).drop("most")


def _combinations(labelled: DataFrame, counts: DataFrame, least: int, total: int, min_confidence: float) -> list[DataFrame]:
    """antecedent, goal, hits and misses of the sure combinations of two tokens, of three, and so on.

    A combination is left out, with all that contain it, only where none of them can be a rule that
    no shorter one makes needless: where it has too few hits, where one of its tokens spares it no
    miss (without that token the rest is at least as sure), or where ``_hopeful`` excludes it.
    """
    token = counts.groupBy("token").agg(F.first("alone").alias("alone"), F.max("both").alias("surest"))
    # A token of one verdict is a rule already, and one that all urls have adds nothing to another.
    open_ = token.where((F.col("surest") >= least) & (F.col("surest") < F.col("alone")) & (F.col("alone") < total))
    goals = counts.select(F.col("verdict").alias("goal")).distinct()
    sure = counts.select(F.col("verdict").alias("goal"), "token", "both")
    # The surest tokens of a goal come first: what follows less sure ones is excluded soonest.
    order = (-F.coalesce("both", F.lit(0)) / F.col("alone")).alias("order")
    keep = open_.crossJoin(F.broadcast(goals)).join(sure, ["goal", "token"], "left").select("goal", "token", order)
    keep = stored(keep, "combinable")
    spread = labelled.select("tokens", "verdict", "n", F.explode("tokens").alias("token")).join(keep, "token")
    rest = F.transform(F.array_sort(F.collect_list(F.struct("order", "token"))), lambda x: x["token"])
    hit = F.col("verdict") == F.col("goal")
    hits, misses = F.when(hit, F.col("n")).otherwise(0).alias("hits"), F.when(hit, 0).otherwise(F.col("n")).alias("misses")
    start = F.array().cast("array<string>").alias("antecedent")
    rows = spread.groupBy("goal", "tokens", "verdict", "n").agg(rest.alias("rest")).select("goal", start, "rest", hits, misses)
    keep = keep.select("goal", start, "token")
    found = []
    while True:
        rows = stored(_extended(rows, keep), "combinations")
        rows = rows.join(_hopeful(rows, least, min_confidence), ["goal", "antecedent"])
        more = rows.select("goal", "antecedent", "missed", F.explode("rest").alias("token"), "hits", "misses")
        more = more.groupBy("goal", "antecedent", "token").agg(
            F.sum("hits").alias("hits"), F.sum("misses").alias("misses"), F.first("missed").alias("missed")
        )
        keep = stored(more.where((F.col("hits") >= least) & (F.col("misses") < F.col("missed"))), "combined")
        if keep.isEmpty():
            return found
        sure = keep.where(F.col("hits") / (F.col("hits") + F.col("misses")) >= min_confidence)
        several = F.array_sort(F.array_append("antecedent", F.col("token"))).alias("antecedent")
        found.append(sure.where(F.size("antecedent") > 0).select(several, "goal", "hits", "misses"))


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """antecedent, verdict, confidence and support of the rules in ``labelled`` (tokens, verdict).

    A rule whose antecedent has a token more than one that is as sure is left out. Single tokens are
    counted, combinations grow from them by a token at a time: each step's rows are a combination
    and the later tokens of the urls that have it, with their counts. Only what can make no rule
    is left out on the way (``_combinations``), so every rule of any number of tokens is found.
    """
    urls = stored(labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n")), "labelled-urls")
    total = urls.agg(F.sum("n")).first()[0]
    schema = "antecedent array<string>, verdict string, confidence double, support double"
    if not total:
        return labelled.sparkSession.createDataFrame([], schema)
    least = max(1, math.ceil(min_support * total))
    spread = urls.select(F.explode("tokens").alias("token"), "verdict", "n")
    counts = spread.groupBy("token", "verdict").agg(F.sum("n").alias("both"))
    counts = stored(counts.withColumn("alone", F.sum("both").over(Window.partitionBy("token"))), "token-counts")
    sure = (F.col("both") >= least) & (F.col("both") / F.col("alone") >= min_confidence)
    rules = counts.where(sure).select(
        F.array("token").alias("antecedent"), "verdict", (F.col("both") / F.col("alone")).alias("confidence"), (F.col("both") / total).alias("support")
    )
    for several in _combinations(urls, counts, least, total, min_confidence):
        confidence = F.col("hits") / (F.col("hits") + F.col("misses"))
        rules = rules.unionByName(
            several.select("antecedent", F.col("goal").alias("verdict"), confidence.alias("confidence"), (F.col("hits") / total).alias("support"))
        )
    rules = stored(rules, "rules")
    shorter = rules.select(F.col("antecedent").alias("shorter"), "verdict", F.col("confidence").alias("as_sure"))
    less = F.explode(F.transform("antecedent", lambda x: F.array_except("antecedent", F.array(x))))
    found = rules.withColumn("shorter", less).join(shorter, ["shorter", "verdict"]).where("as_sure >= confidence")
    longer = found.select("antecedent", "verdict").distinct()
    return rules.join(longer, ["antecedent", "verdict"], "left_anti")


def inverted_index(rules: DataFrame) -> DataFrame:
    """The rules, each with ``token``: the token of its antecedent that fewest rules have."""
    spread = rules.withColumn("token", F.explode("antecedent"))
    common = spread.groupBy("token").agg(F.count(F.lit(1)).alias("rules"))
    rarest = spread.join(common, "token").groupBy("antecedent", "verdict").agg(
        F.min(F.struct("rules", "token")).alias("rarest"), F.first("confidence").alias("confidence"), F.first("support").alias("support")
    )
    return rarest.select(F.col("rarest.token").alias("token"), "antecedent", "verdict", "confidence", "support")


def judged(
    pages: DataFrame,
    rules: list[Rule],
    default: str = ALLOW,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, mined (the antecedent that decided) and confidence.

    Needs url; columns of the new names are replaced, all others stay. A written rule decides
    where one fits; else the surest mined rule does, then the one of more support, of more
    tokens, and the first in order; else ``default``. Urls that are NULL or have no :// have an
    empty host and path, and no tokens. Without labels nothing is mined. Repeated urls count
    each time and are judged alike, urls of any length are read whole, and an empty table gives an empty one.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "mined", "confidence")
    bag, written, same, best = (fresh(pages, x) for x in ("tokens", "written", "same_tokens", "best"))
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    seen = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    seen = seen.withColumns({bag: tokens(url, host, path), written: written_rule(host, path, rules)})
    labelled = seen.where(F.col(written).isNotNull()).select(F.col(bag).alias("tokens"), F.col(f"{written}.verdict").alias("verdict"))
    open_ = seen.where(F.col(written).isNull()).select(F.col(bag).alias(same)).distinct()
    if not labelled.isEmpty():
        index = stored(inverted_index(mined_rules(labelled, min_support, min_confidence)), "url-rules")
        hits = open_.withColumn("token", F.explode(same)).join(index, "token")
        hits = hits.where(F.size(F.array_except("antecedent", F.col(same))) == 0)
        surest = F.struct("confidence", "support", F.size("antecedent").alias("tokens"), "verdict", "antecedent")
        verdicts = hits.groupBy(same).agg(F.max(surest).alias(best))
    else:
        surest = "struct<confidence:double,support:double,tokens:int,verdict:string,antecedent:array<string>>"
        verdicts = open_.withColumn(best, F.lit(None).cast(surest))
    verdicts = stored(verdicts, "url-verdicts")
    undecided = F.col(written).isNull()
    return seen.join(verdicts, (F.col(bag) == F.col(same)) & undecided, "left").select(
        *[F.col(f"`{c}`") for c in pages.columns],
        "host",
        "path",
        F.col(f"{written}.rule").alias("rule"),
        F.coalesce(f"{written}.verdict", f"{best}.verdict", F.lit(default)).alias("verdict"),
        F.col(f"{best}.antecedent").alias("mined"),
        F.col(f"{best}.confidence").alias("confidence"),
    )
