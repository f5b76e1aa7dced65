"""URL filters: fixed rules first, gradient-boosted trees on lexical features for the rest.

A URL is judged without fetching it. ``features`` reads only its characters:
lengths, depth, digit ratio, Shannon entropy, parameter counts, host shape, and
how often URLs with the same suffix (the last one, two or three host labels, the
last two with the path's first folder, the file name's ending) were blocked among
labelled ones. A suffix statistic learned
from the rows it is then trained on would give the label away, so one half of the
training URLs supplies the statistics and the other half, which sees them as any
new URL does, trains the trees.

Labelled URLs are distinct and, beyond ``TRAIN_ROWS``, thinned by a hash of the
URL: that bounds the fit and the broadcast suffix table (at most ``len(LEVELS)``
rows per statistics URL). URLs whose CRC is divisible by 5 never train, so
that accuracy can be measured on them (``held_out``).

For the registered query a URL's label is its rule's verdict or, without one, what
``labels`` says of its page's document (its number ends the path): low quality or
toxic means block. On the synthetic tables the document labels do not depend on
the URL, so what the trees can learn beyond the rules' ground is their base rate;
README has the held-out figures.

Defined cases: NULL, or text without ``://``, has an empty host and path, no rule
and the verdict of its features (a NULL url counts as empty); text is never
cut; repeated rows are judged alike; without labelled URLs of both kinds the
score is the share of block among them (0 if there are none); an empty table gives
an empty result; columns other than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiary.llm.common import frozen, lower_az

#: Fixed values: (verdict, host, path) of the contract's rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: About so many labelled URLs train at most.
TRAIN_ROWS = 40_000
#: Weight of the overall rate in a suffix's own, in URLs.
PRIOR = 10.0
LEVELS = ["tld", "domain", "site", "section", "ending"]
LEXICAL = ["url_length", "host_length", "path_length", "query_length", "depth", "digit_ratio", "entropy",
           "n_params", "n_labels", "host_hyphens", "host_digits", "longest_label", "secure", "n_odd"]
FEATURES = LEXICAL + [f"{x}_rate" for x in LEVELS]


def host_of(url: Column) -> Column:
    return lower_az(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULL."""
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    return F.coalesce(*[F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in first],
                      F.lit(None).cast("struct<rule:string,verdict:string>"))


def judged(pages: DataFrame, rules: list = RULES) -> DataFrame:
    """(page_id, url, host, path, found): each row with its rule."""
    named = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return named.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))


def entropy(text: Column) -> Column:
    """Bits per character: runs of the sorted characters, counted in one pass."""
    chars = F.sort_array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    weight = lambda n: F.when(n > 0, n * F.log2(n)).otherwise(0.0)
    start = F.struct(F.lit("").alias("at"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"))
    step = lambda s, c: F.when(s["at"] == c, F.struct(s["at"].alias("at"), (s["run"] + 1).alias("run"), s["sum"].alias("sum"), (s["n"] + 1).alias("n"))) \
                         .otherwise(F.struct(c.alias("at"), F.lit(1.0).alias("run"), (s["sum"] + weight(s["run"])).alias("sum"), (s["n"] + 1).alias("n")))
    return F.aggregate(chars, start, step, lambda s: F.when(s["n"] > 0, F.log2(s["n"]) - (s["sum"] + weight(s["run"])) / s["n"]).otherwise(0.0))


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` (with url, host, path) and their lexical features and suffixes."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    count = lambda text, what: F.regexp_count(text, F.lit(what)).cast("double")
    size = lambda text: F.char_length(text).cast("double")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    last = lambda n: F.regexp_extract(host, r"((?:[^.]*\.){0,%d}[^.]*)$" % (n - 1), 1)
    return rows.select(
        "*", size(url).alias("url_length"), size(host).alias("host_length"), size(path).alias("path_length"), size(query).alias("query_length"),
        count(path, "[^/]+").alias("depth"), (count(url, "[0-9]") / F.greatest(size(url), F.lit(1.0))).alias("digit_ratio"),
        entropy(url).alias("entropy"), count(query, "[^&]+").alias("n_params"), count(host, r"[^.]+").alias("n_labels"),
        count(host, "-").alias("host_hyphens"), count(host, "[0-9]").alias("host_digits"),
        F.coalesce(F.array_max(F.transform(F.split(host, r"\."), F.char_length)), F.lit(0)).cast("double").alias("longest_label"),
        url.startswith("https").cast("double").alias("secure"), count(url, r"[^0-9A-Za-z/.:?&=#_-]").alias("n_odd"),
        last(1).alias("tld"), last(2).alias("domain"), last(3).alias("site"),
        F.concat(last(2), F.regexp_extract(path, r"(?s)^(/[^/]*)/", 1)).alias("section"),
        F.regexp_extract(path, r"(?s)([^/]*)/?$", 1).alias("name")) \
        .withColumn("ending", F.regexp_extract("name", r"\.([^.]*)$", 1)).drop("name")


def thinned(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the labelled URLs at most, by a hash of the URL."""
    n = labelled.count()
    return labelled if n <= rows else labelled.filter(F.pmod(F.xxhash64(F.lit("thin"), F.col("url")), F.lit(1 << 20)) < int(rows / n * (1 << 20)))


def suffix_rates(rows: DataFrame) -> tuple[DataFrame, float]:
    """(level, suffix, rate): the share of block among a suffix's URLs, drawn
    towards the overall share; and that share."""
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    long = rows.select("label", F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("suffix")) for c in LEVELS])).alias("s"))
    rate = (F.sum("label") + PRIOR * share) / (F.count(F.lit(1)) + PRIOR)
    return long.groupBy("s.level", "s.suffix").agg(rate.alias("rate")), share


class Model:
    """Suffix rates and trees; ``trees`` is None where one kind of label is missing."""

    def __init__(self, rates: DataFrame, share: float, trees):
        self.rates, self.share, self.trees = rates, share, trees

    def features(self, rows: DataFrame) -> DataFrame:
        """``rows`` and one vector of all features."""
        for level in LEVELS:
            of = self.rates.filter(F.col("level") == level).select(F.col("suffix").alias(level), F.col("rate").alias(f"{level}_rate"))
            rows = rows.join(F.broadcast(of), level, "left")  # bounded by the statistics URLs
        rows = rows.fillna(self.share, [f"{x}_rate" for x in LEVELS])
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from (url, label): label 1 means block."""
    named = labelled.filter("url is not null and label is not null").groupBy("url").agg(F.max(F.col("label").cast("double")).alias("label"))
    named = named.filter(~held_out(F.col("url")))
    train = frozen(lexical(thinned(named, rows).select("url", "label", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))))
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("url")), F.lit(2))
    rates, share = suffix_rates(train.filter(half == 0))
    model = Model(frozen(rates), share, None)
    kinds = {r["label"] for r in train.filter(half == 1).select("label").distinct().collect()}
    if kinds == {0.0, 1.0}:
        table = frozen(model.features(train.filter(half == 1)).select("features", "label"))
        trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, maxBins=64, seed=1)
        model.trees = trees.fit(table)
    return model


def held_out(url: Column) -> Column:
    """The URL takes no part in any fit."""
    return F.crc32(F.coalesce(url, F.lit("")).cast("binary")) % 5 == 0


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with url, host, path) and ``score``: how likely block is."""
    keep = [F.col(c) for c in rows.columns]
    if model.trees is None:
        return rows.withColumn("score", F.lit(float(model.share)))
    whole = rows.select(F.struct(*keep).alias("__row"), "url", "host", "path")
    scored = model.trees.transform(model.features(lexical(whole)))
    return scored.select("__row.*", vector_to_array("probability")[1].alias("score"))


def document_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label) of the URLs whose path ends in a labelled document's number."""
    number = F.expr(r"try_cast(regexp_extract(path, '/([0-9]+)(?:[.][A-Za-z]+)?/?$', 1) as bigint)")
    poor = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int"))
    known = labels.groupBy("doc_id").agg(poor.alias("label")).filter("doc_id is not null and label is not null")
    return rows.select("url", number.alias("doc_id")).filter("doc_id is not null").distinct().join(known, "doc_id").select("url", "label")


def labelled_urls(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label): the rule's verdict, else the label of the page's document."""
    by_rule = rows.filter("found is not null and url is not null").select("url", (F.col("found.verdict") == "block").cast("int").alias("label"))
    return by_rule.unionByName(document_labels(rows.filter("found is null"), labels))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, held_out), one row per page."""
    rows = judged(pages, rules)
    model = fit(labelled_urls(rows, labels), train_rows)
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return score(rows, model).select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                                     F.coalesce(F.col("found.verdict"), method).alias("verdict"), "score", held_out(F.col("url")).alias("held_out"))
