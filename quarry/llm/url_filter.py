"""URL filter: rules first, then the likelihood ratio of two character models
(DataFrame functions only).

Two variable-order Markov models over host and path (lower case, digit runs
folded to ``0``) are counted from the table itself: one from rejected urls,
whose host contains a word of ``REJECT_WORDS``, one from accepted urls, all
others that no rule blocks.  Every order from 5 letters down is smoothed by
Witten-Bell interpolation, so an unseen context falls through to the next
shorter one.  A url's score is the mean log ratio per character.  The threshold
lies between the accepted and rejected scores of texts by models that have not
seen their fold; every text calibrates, and the models of the scores are
trained on every text.  Only if the table lacks either kind is every url that no
rule fits allowed.

Work is done once per distinct folded text and distinct 5-letter window, with
counts summed before each shuffle; joins back are dealt over salts.  Null urls
and urls without ``://`` have empty host and path, score 0 and are
allowed.  Every row is returned, repeated ones and null ids too, each judged by its
own url; a url of any length is read whole; a score equal to the threshold is
allowed; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.plans.materialize import materialize

ORDER = 5
SALTS = 16
FOLDS = 5              # a text calibrates by models of the other folds

# fixed values: the site rules (rule, verdict) and the words that mark a host
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
REJECT_WORDS = ("ads", "adult", "bets", "casino", "loans", "pills", "poker", "porn", "spam", "viagra")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _counted(windows: DataFrame) -> DataFrame:
    """(model, window, ratio): windows with their log ratio, for each value of
    ``model`` if there is that column."""
    own = [c for c in windows.columns if c == "model"]
    below = None
    for m in range(1, ORDER + 1):
        grams = (windows.groupBy(*own, F.expr(f"right(window, {m})").alias("g"))
                 .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
                 .withColumn("h", F.expr(f"left(g, {m - 1})")))
        heads = grams.groupBy(*own, "h").agg(
            F.sum("a").alias("ca"), F.sum("r").alias("cr"), F.sum(F.expr("int(a > 0)")).alias("ta"),
            F.sum(F.expr("int(r > 0)")).alias("tr"), F.count(F.lit(1)).alias("size"))
        stats = grams.join(heads, [*own, "h"])
        if m == 1:
            stats = stats.select("*", F.expr("1 / size").alias("pa0"), F.expr("1 / size").alias("pr0"))
        else:
            stats = stats.withColumn("s", F.expr(f"right(g, {m - 1})")).join(below, [*own, "s"])
        mixed = [F.expr(f"if(c{x} = 0, p{x}0, ({x} + t{x} * p{x}0) / (c{x} + t{x}))").alias(f"p{x}0") for x in "ar"]
        below = stats.select(*own, F.col("g").alias("s"), *mixed)
    return below.select(*own, F.col("s").alias("window"), (F.log("pa0") - F.log("pr0")).alias("ratio"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, reject_words=REJECT_WORDS) -> DataFrame:
    """Per row: id, host, path, rule, verdict, score (log ratio a character)."""
    url = F.col(url_col)
    rows = (pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
            .withColumn("text", F.concat("host", F.regexp_replace("path", r"[0-9]+", "0"))))
    verdicts = F.lit(None).cast("string")
    for rule, verdict in rules:
        verdicts = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(verdicts)
    named = F.col("host").rlike(r"(^|[.-])(" + "|".join(reject_words) + r")([.-]|$)")
    texts, _ = materialize(
        rows.groupBy("text").agg(F.sum(F.when(named, 1).otherwise(0)).alias("r"),
                                 F.sum(F.when(~named & (F.coalesce(verdicts, F.lit("")) != "block"), 1).otherwise(0)).alias("a"))
        .filter("text != ''").withColumn("fold", F.expr(f"int(pmod(xxhash64(text), {FOLDS}))"))
        .withColumn("tid", F.monotonically_increasing_id()), "urls")

    padded = F.concat(F.lit("^" * (ORDER - 1)), F.col("text"), F.lit("$"))
    # every window in one linear scan of the text
    cut = F.explode(F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{ORDER}}}))"), F.lit(1)))
    parts, _ = materialize(
        texts.select("fold", "a", "r", cut.alias("window"))
        .groupBy("window", "fold").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "windows")
    # a model without each fold, and as number FOLDS the one of all texts
    windows = (parts.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))).groupBy("model", "window")
               .agg(*[F.sum(F.expr(f"if(model = fold, 0, {x})")).alias(x) for x in "ar"]))
    ratios = (_counted(windows).groupBy("window")
              .agg(*[F.max(F.when(F.col("model") == k, F.col("ratio"))).alias(f"m{k}") for k in range(FOLDS + 1)])
              .select("window", F.array(*[f"m{k}" for k in range(FOLDS)]).alias("unseen"), F.col(f"m{FOLDS}").alias("ratio"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    means = (texts.select("tid", "fold", F.expr(f"int(pmod(tid, {SALTS}))").alias("salt"), cut.alias("window"))
             .join(ratios, ["window", "salt"]).groupBy("tid")
             .agg(F.avg("ratio").alias("score"), F.avg(F.expr("unseen[fold]")).alias("unseen")))
    scored, _ = materialize(texts.join(means, "tid").drop("tid"), "scored")
    # calibration: two quantiles of scores by models that have not seen the text
    low, high = (scored.agg(
        F.percentile_approx(F.when(F.expr("a > 0 and r = 0"), F.col("unseen")), 0.02, 10_000),
        F.percentile_approx(F.when(F.expr("r > 0 and a = 0"), F.col("unseen")), 0.98, 10_000)).first())
    if low is None or high is None:  # a kind is missing: nothing to tell apart
        cutoff = float("-inf")
    else:
        cutoff = (low + high) / 2

    known = scored.select("text", "score").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", F.expr(f"int(pmod(xxhash64({id_col}), {SALTS}))"))
            .join(known, ["text", "salt"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
            .select(id_col, "host", "path", "rule",
                    F.coalesce(verdicts, F.when((F.col("text") == "") | (F.col("score") >= cutoff), "allow")
                               .otherwise("block")).alias("verdict"), "score"))
