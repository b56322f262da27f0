"""URL filters: rules of hosts and paths, and gradient-boosted trees for what no rule decides.

The trees see lexical features only (lengths, depth, digit and letter shares, entropy,
parameter counts, and how often a host's suffix was blocked among the labelled URLs).
They are trained on a bounded sample of labelled URLs.
"""

from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.barrier import settled
from ..session import written

# Labelled URLs used for training: about so many, chosen by hash.
SAMPLE_ROWS = 20_000
# Rules are part of the plan; more of them belong in a table.
MAX_RULES = 1000
FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_host_digits", "f_hyphens",
    "f_entropy", "f_params", "f_query_length", "f_fragment", "f_extension", "f_secure", "f_suffix_blocked", "f_suffix_seen",
)


class Rule(NamedTuple):
    """``block`` or ``allow`` what lies under ``place``, a host (or suffix of hosts) and a path."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]


def split(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    whole = F.coalesce(url, F.lit(""))
    start = F.instr(whole, "://")
    rest = F.when(start > 0, F.substring(whole, start + 3, F.length(whole))).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def ruled(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``, null where no rule fits.

    A rule fits its host and all subdomains where the path starts with the rule's. Of
    several, the longest one counts (the longer host, if they are equally long).
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    host, path = split(F.col(url))
    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    df = settled(df.select(*kept, host.alias("host"), path.alias("path")), ["host", "path"])
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.place), len(r.host))):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) & F.startswith(F.col("path"), F.lit(r.path))
        rule = F.when(fits, r.place).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return df.withColumns({"rule": rule, "verdict": verdict})


def _suffix(host: str = "host") -> Column:
    return F.substring_index(F.col(host), ".", -1)


def features(df: DataFrame, suffixes: DataFrame, url: str = "url") -> DataFrame:
    """``df`` (with host and path) and the lexical features; ``suffixes`` has ``suffix, blocked, seen``."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.length(u)
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    chars = F.filter(F.split(u, ""), lambda c: c != "")
    entropy = F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda a, c: a - (n - F.length(F.replace(u, c))) / n * F.log2((n - F.length(F.replace(u, c))) / n),
    )
    query = F.regexp_extract(u, "\\?([^#]*)", 1)
    made = {
        "f_length": n,
        "f_host_length": F.length("host"),
        "f_path_length": F.length("path"),
        "f_depth": F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"))),
        "f_labels": F.size(F.split("host", "\\.")),
        "f_digits": share(digits(u), n),
        "f_host_digits": share(digits(F.col("host")), F.length("host")),
        "f_hyphens": F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"))),
        "f_entropy": F.when(n > 0, entropy).otherwise(0.0),
        "f_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "f_query_length": F.length(query),
        "f_fragment": F.when(F.contains(u, F.lit("#")), 1).otherwise(0),
        "f_extension": F.when(F.regexp_like(F.col("path"), F.lit("\\.[A-Za-z0-9]{1,5}$")), 1).otherwise(0),
        "f_secure": F.when(F.startswith(u, F.lit("https:")), 1).otherwise(0),
    }
    joined = df.withColumn("_suffix", _suffix()).join(suffixes.withColumnRenamed("suffix", "_suffix"), "_suffix", "left")
    return joined.withColumns({
        **{name: c.cast("double") for name, c in made.items()},
        # Towards one half where few were seen.
        "f_suffix_blocked": (F.coalesce("blocked", F.lit(0)) + 1.0) / (F.coalesce("seen", F.lit(0)) + 2.0),
        "f_suffix_seen": F.log1p(F.coalesce("seen", F.lit(0)).cast("double")),
    }).drop("blocked", "seen", "_suffix")


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """How many labelled URLs (``host``, ``verdict``) each host suffix has, and how many of them are blocked."""
    blocked = F.count(F.when(F.col("verdict") == "block", 1))
    return labelled.groupBy(_suffix().alias("suffix")).agg(blocked.alias("blocked"), F.count(F.lit(1)).alias("seen"))


def train(labelled: DataFrame, suffixes: DataFrame, sample_rows: int = SAMPLE_ROWS, url: str = "url", trees: int = 12, depth: int = 4) -> Model | str:
    """Trees trained on about ``sample_rows`` of ``labelled`` (url, host, path, verdict), or the verdict that all of these have (``allow`` if none)."""
    counts = {r.verdict: r.n for r in labelled.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return next(iter(counts), "allow")
    share = min(1.0, sample_rows / sum(counts.values()))
    chosen = labelled.where(F.pmod(F.xxhash64(url), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = features(chosen, suffixes, url).select(*FEATURES, F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("label"))
    # The sample is small: few partitions, read by every pass of the training.
    rows = written(rows.repartition(4, "f_length"), "urls")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows).select("x", "label")
    return GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, seed=7).fit(table)


def judged(df: DataFrame, rules: list[Rule], url: str = "url", labelled: DataFrame | None = None, **training) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the trees' probability of ``block``).

    ``labelled`` has ``url`` and ``verdict``; without it, the rows of ``df`` that a rule
    decides are the labelled URLs. A rule's verdict stands; the trees decide the
    rest. Null and empty URLs are judged as empty ones. Repeated rows are judged alike;
    columns of ``df`` with the names given are replaced.
    """
    own = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    # The other columns travel in one, so that no name of theirs is also one made here.
    rows = ruled(df.select(F.struct(*own).alias("_own"), F.col(url).cast("string").alias("_url")), rules, "_url")
    if labelled is None:
        known = rows.where("verdict IS NOT NULL").select("_url", "host", "path", "verdict")
    else:
        known = ruled(labelled.select(F.col(url).alias("_url"), F.col("verdict").alias("label")), [], "_url").drop("verdict").withColumnRenamed("label", "verdict")
    suffixes = written(suffix_counts(known), "suffixes")
    model = train(known, suffixes, url="_url", **training)
    kept = [*[F.col("_own")[c].alias(c) for c in own], "host", "path", "rule"]
    if isinstance(model, str):
        return rows.select(*kept, F.coalesce("verdict", F.lit(model)).alias("verdict"), F.lit(float(model == "block")).alias("score"))
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(features(rows, suffixes, "_url"))
    model.setFeaturesCol("_x").setProbabilityCol("_p").setPredictionCol("_y").setRawPredictionCol("_r")
    scored = model.transform(table).withColumn("score", vector_to_array("_p")[1])
    verdict = F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(*kept, verdict.alias("verdict"), "score")
