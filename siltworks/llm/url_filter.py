"""URL filter: allow and block rules first, then gradient-boosted trees on lexical features of the URL.

Everything here is DataFrame expressions and pyspark.ml: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ALLOW, BLOCK = "allow", "block"
#: Distinct URLs that the trees are fitted on (by a hash threshold: so many, give or take its chance).
SAMPLE_ROWS = 20_000
#: Suffix statistics are broadcast up to this many bytes, and joined by a shuffle beyond.
BROADCAST_BYTES = 16 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.substring_index(_rest(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    return F.when(F.locate("/", rest) > 0, F.substr(rest, F.locate("/", rest))).otherwise("")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, tail = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)


def apply_rules(urls: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """``urls`` with host, path, rule and rule_verdict: the longest (verdict, rule) that fits, or nulls.

    A rule ``host/path`` fits its host and all its subdomains where the path starts with the rule's. Of
    rules of one length the first in text order counts. Existing columns with these names are replaced.
    """
    out = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), [-ord(c) for c in x[1]])):
        fits = _fits(r, F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return out.withColumns({"rule": rule, "rule_verdict": verdict})


def _entropy(text: Column) -> Column:
    """Bits per character, from the counts of all characters."""
    n = F.length(text).cast("double")
    times = lambda c: (F.length(text) - F.length(F.replace(text, c))) / F.length(c)
    each = F.transform(F.filter(F.array_distinct(F.split(text, "")), lambda c: c != ""), times)
    return F.when(n > 0, F.aggregate(each, F.lit(0.0), lambda a, c: a - (c / n) * F.log2(c / n))).otherwise(0.0)


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def features(df: DataFrame, url_col: str, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``keep`` and the lexical features. Rows need host and path, as apply_rules() gives them."""
    url = F.coalesce(F.lower(F.col(url_col)), F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.when(F.locate("?", url) > 0, F.substring_index(F.substr(url, F.locate("?", url) + 1), "#", 1)).otherwise("")
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    made = {
        "length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "labels": F.when(host == "", 0).otherwise(F.size(F.split(host, r"\."))),
        "digit_ratio": digits(url) / F.greatest(F.length(url), F.lit(1)),
        "host_hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"))),
        "path_hyphens": F.length(path) - F.length(F.replace(path, F.lit("-"))),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "secure": url.startswith("https").cast("int"),
        "first_segment": F.length(F.get(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(0))),
        "fragment": (F.locate("#", url) > 0).cast("int"),
        "percent": F.length(url) - F.length(F.replace(url, F.lit("%"))),
    }
    made = {k: F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{k}") for k, c in made.items()}
    return df.select(*keep, *made.values()), [f"f_{k}" for k in made]


def _with_statistics(df: DataFrame, stats: DataFrame, small: bool, overall: float, learning: bool) -> DataFrame:
    """``df`` with f_suffix_blocked (smoothed share of blocked rows under the suffix) and f_suffix_rows.

    While ``learning``, a row's statistics are those of the other half of the rows, so that they do not hold its own label.
    """
    if small:
        made = df.join(F.broadcast(stats), "suffix", "left")
    else:
        made = common.spread_join(df, stats.withColumn("size", F.col("k0") + F.col("k1")), ["suffix"], how="left")
    made = made.na.fill(0, ["k0", "b0", "k1", "b1"])
    if learning:
        k, b = (F.when(F.col("half") == 0, F.col(f"{x}1")).otherwise(F.col(f"{x}0")) for x in "kb")
    else:
        k, b = F.col("k0") + F.col("k1"), F.col("b0") + F.col("b1")
    return made.withColumns({"f_suffix_blocked": (b + 8 * overall) / (k + 8), "f_suffix_rows": F.log1p(k.cast("double") * (2 if learning else 1))}).drop("k0", "b0", "k1", "b1")


def learn(decided: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[PipelineModel, DataFrame, bool, float] | float:
    """(trees, statistics of each suffix, whether these are few, overall share of y) from rows (url, host, path, suffix, y).

    The trees are fitted on some ``sample_rows`` distinct URLs, chosen by a hash, each with the number of its rows as its
    weight: copies of one count fully and take no places. Statistics are of all rows. Where all rows have one label
    (or there are none), that label (or 0).
    """
    half = F.pmod(F.xxhash64("url", F.lit("half")), F.lit(2))
    decided = decided.withColumn("half", half)
    parts = [F.sum(F.when(F.col("half") == h, x).otherwise(0)).alias(f"{name}{h}") for h in (0, 1) for name, x in (("k", F.lit(1)), ("b", F.col("y")))]
    stats = common.cut(decided.groupBy("suffix").agg(*parts))
    size = stats.agg(F.sum(F.octet_length("suffix") + 64).alias("bytes"), F.sum(F.col("k0") + F.col("k1")).alias("n"), F.sum(F.col("b0") + F.col("b1")).alias("blocked")).first()
    n, blocked = size["n"] or 0, size["blocked"] or 0.0
    if not 0 < blocked < n:
        return 1.0 if n and blocked == n else 0.0
    small, overall = size["bytes"] <= BROADCAST_BYTES, float(blocked / n)
    decided = common.cut(decided.groupBy("url", "host", "path", "suffix", "half", "y").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    urls = decided.count()
    share = min(1.0, sample_rows / urls)
    order = F.xxhash64(F.col("url"), F.lit("sample"))
    sample, names = features(decided.where(order <= min(int(-(2**63) + share * 2**64), 2**63 - 1)), "url", ["suffix", "half", "y", "weight"])
    sample = _with_statistics(sample, stats, small, overall, True)
    trees = GBTClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxIter=8, maxDepth=4, maxBins=32, stepSize=0.3, seed=7)
    assembler = VectorAssembler(inputCols=[*names, "f_suffix_blocked", "f_suffix_rows"], outputCol="features")
    few = max(1, min(8, int(urls * share) // 4_000 + 1))
    return Pipeline(stages=[assembler, trees]).fit(common.cut(sample.repartition(few))), stats, small, overall


def scores(urls: DataFrame, learnt: tuple[PipelineModel, DataFrame, bool, float] | float, keep: Sequence[str]) -> DataFrame:
    """``keep`` and score, the chance of y, of rows (url, host, path, suffix)."""
    if isinstance(learnt, float):
        return urls.select(*keep, F.lit(learnt).alias("score"))
    model, stats, small, overall = learnt
    made, _ = features(urls, "url", [*keep, *({"suffix"} - set(keep))])
    scored = model.transform(_with_statistics(made, stats, small, overall, False))
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def judge(urls: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id_col, host, path, rule, verdict, score) of every row.

    Where a rule fits, the verdict is the rule's. The rest is judged by boosted trees (score, the chance
    of block, at least 0.5: block), fitted on the URLs that rules decide, some ``sample_rows`` distinct ones of them.
    Suffix statistics are the smoothed share of blocked rows under the last two host labels, over all
    rows that rules decide; suffixes without such rows get the overall share. Without URLs of both verdicts there
    are no trees: the more frequent verdict holds, or allow. Null and unusual URLs have an empty host and path and
    are judged like any other; rows that repeat are judged alike; columns besides id and URL play no part.
    """
    base = apply_rules(urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), rules, "url").withColumn("suffix", suffix(F.col("host")))
    learnt = learn(base.where("rule is not null").withColumn("y", (F.col("rule_verdict") == BLOCK).cast("double")), sample_rows)
    scored = scores(base, learnt, ["id", "host", "path", "rule", "rule_verdict"])
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
