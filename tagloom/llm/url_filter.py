"""Allow or block urls: by rules where one fits, else by gradient-boosted trees.

The trees see lexical features only: lengths, depth, digits, entropy, parameters, and
statistics of the host's suffixes. They are trained by MLlib on all urls that a rule labels.

Each suffix of one and of two labels has statistics of its own: how many urls end so, and which share
of those labelled are blocked. The table of suffixes grows with the hosts; it is counted before it is
joined, and a suffix that many urls have is dealt over many tasks. A labelled url's share is taken
from the other folds' labels, as its own would give the answer away; folds go by the url, so that
repeated urls don't tell on one another.

Very long urls are judged whole. An empty table gives no rows. Columns of the input other than the
id and the url are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.operators.spread import spread_join

FOLDS = 5
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 7


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path begins with ``path``."""

    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> dict[str, Column]:
    """Host and path; both empty for a null and where there is no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return {"host": F.coalesce(lower, F.lit("")), "path": F.coalesce(path, F.lit(""))}


def fitting_rule(rules: list[Rule], field: str) -> Column:
    """The text or verdict of the longest rule that fits; equally long ones by their text."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = host & F.col("path").startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    shares = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    )
    bits = F.aggregate(
        F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p)
    )
    return F.when(n > 0, bits).otherwise(0.0)


def _suffix(labels: int) -> Column:
    return F.substring_index(F.col("host"), ".", -labels)


def with_suffix_statistics(rows: DataFrame, suffix: str, scratch: Scratch) -> DataFrame:
    """``rows`` with ``f_<suffix>_size`` and ``f_<suffix>_blocked`` in place of the column ``suffix``.

    ``ruled`` is a row's label or null, ``fold`` its fold. The blocked share is that of the labelled
    rows with the suffix, for a labelled row of those in other folds, drawn to a half as if two more
    were there, one of each kind.
    """
    def per_fold(kind: Column) -> Column:
        return F.array(*[F.count_if(kind & (F.col("fold") == k)) for k in range(FOLDS)])

    stats = rows.groupBy(suffix).agg(
        F.log1p(F.count(F.lit(1))).alias(f"f_{suffix}_size"),
        per_fold(F.col("ruled").isNotNull()).alias("labelled"),
        per_fold(F.coalesce(F.col("ruled") == "block", F.lit(False))).alias("blocked"),
    )
    joined = spread_join(rows, scratch.keep(stats), suffix)

    def seen(name: str) -> Column:
        total = F.aggregate(name, F.lit(0).cast("long"), lambda n, k: n + k)
        return total - F.when(F.col("ruled").isNull(), 0).otherwise(F.get(name, "fold"))

    share = (seen("blocked") + 1) / (seen("labelled") + 2)
    return joined.withColumn(f"f_{suffix}_blocked", share).drop("labelled", "blocked", suffix)


def lexical_features() -> dict[str, Column]:
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")

    def count(text: Column, kind: str) -> Column:
        return F.regexp_count(text, F.lit(kind)).cast("double")

    n = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "f_length": n,
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_labels": F.when(host == "", 0.0).otherwise(count(host, r"\.") + 1),
        "f_depth": count(path, "/+[^/]"),
        "f_digits": F.when(n > 0, count(url, "[0-9]") / n).otherwise(0.0),
        "f_host_digits": count(host, "[0-9]"),
        "f_hyphens": count(url, "[-_]"),
        "f_entropy": _entropy(url),
        "f_parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "f_query_length": F.length(query).cast("double"),
    }


def judged_urls(pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url") -> DataFrame:
    """The id, ``host``, ``path``, ``rule`` (its text, or null), ``verdict`` (allow or block)
    and ``block_score`` (the trees' probability) of every row.

    Urls that a rule fits get the rule's verdict, and are what the trees learn from. With
    labels of one kind only, that is the verdict of the others; without any, they are allowed.
    Null and empty urls are judged like others, by empty parts. Rows are judged one by one:
    repeated ids stay, and repeated urls get one verdict.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    rows = rows.withColumns(url_parts(F.col("url")))
    rows = rows.withColumns(
        {"rule": fitting_rule(rules, "text"), "ruled": fitting_rule(rules, "verdict")}
    )
    rows = rows.withColumns(
        lexical_features()
        | {"last_1": _suffix(1), "last_2": _suffix(2)}
        | {"fold": F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")}
    ).drop("url")
    rows = scratch.keep(rows)
    for name in ("last_1", "last_2"):
        rows = with_suffix_statistics(rows, name, scratch)
    features = [c for c in rows.columns if c.startswith("f_")]
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    label = (F.col("ruled") == "block").cast("double").alias("label")
    known = scratch.keep(rows.where("ruled is not null").select("features", label))
    of_kind = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(of_kind) == 2:
        trees = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED
        ).fit(known)
        rows = trees.transform(rows)
        score = vector_to_array(F.col("probability"))[1]
    else:
        score = F.lit(float(next(iter(of_kind), 0.0)))
    rows = rows.withColumn("block_score", score)
    judged = F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        F.col("id").alias(id), "host", "path", "rule",
        F.coalesce("ruled", judged).alias("verdict"), "block_score",
    )
