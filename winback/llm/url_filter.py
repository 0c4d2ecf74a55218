"""Allow and block rules on urls, found by a sort-merge range join.

A host is keyed by its labels in reverse, each followed by a dot (``www.example.com`` is
``com.example.www.``). Then a rule's host with all its subdomains is one interval of keys,
``[com.example., com.example/)``, because ``/`` follows ``.``. The intervals of a rule set nest. Each start or
end of an interval becomes a boundary row that carries the stack of rules active from there on. Boundaries
and urls are sorted together in ranges of sampled splitters, a sweep hands every url the
stack of the last boundary before it, and the longest rule of the stack whose path begins the url's path wins.
Equal keys are told apart by a hash, so one very common host fills several ranges. Each splitter is a
boundary too, so no range needs its neighbour.

Defined cases: a url that is null or has no ``://`` has an empty host and path; an empty path begins with no
rule's path; a host that no rule fits gets ``default``; of rules with the same host and path
that disagree ``block`` wins; of fitting rules of equal length the one with the longer host wins; repeated rows
are judged one by one; other columns of ``pages`` are not read. The stack holds the
rules on one chain of nested hosts; its size follows the rule set, not the pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winback.llm.common import bounds_at_or_below, lower_ascii

#: (host, path, verdict)
Rule = tuple[str, str, str]
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
#: sampled keys per range of the sweep; there are twice as many ranges as shuffle partitions
KEYS_PER_RANGE = 20

RULE_COLUMNS = ("rule_host", "rule_path", "rule_verdict")
RULE_TYPE = "array<struct<" + ",".join(f"{name}:string" for name in RULE_COLUMNS) + ">>"


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path. Both are empty where the url is null or has no ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def rule_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(part).alias(name) for name, part in zip(RULE_COLUMNS, rule, strict=True)]) for rule in rules])
    return spark.range(1).select(F.inline(rows.cast(RULE_TYPE)))


def stacks_at(boundaries: DataFrame, rules: DataFrame) -> DataFrame:
    """For each boundary key the rules active from it on, longest first.

    A rule is active at a key that begins with the rule's own key, and those beginnings end at a dot.
    """
    dots = F.filter(F.sequence(F.lit(1), F.length("key")), lambda at: F.substring(F.col("key"), at, F.lit(1)) == ".")
    starts = boundaries.select("key", F.explode(F.transform(dots, lambda at: F.substring(F.col("key"), F.lit(1), at))).alias("rule_key"))
    longest_first = F.struct(
        (-F.length("rule_host") - F.length("rule_path")).alias("order"),
        (-F.length("rule_host")).alias("host_order"),
        F.when(F.col("rule_verdict") == "block", 0).otherwise(1).alias("block_first"),
        F.col("rule_path").alias("path"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    stacks = starts.join(rules, "rule_key").groupBy("key").agg(F.sort_array(F.collect_list(longest_first)).alias("stack"))
    none = F.array().cast(stacks.schema["stack"].dataType)
    return boundaries.join(stacks, "key", "left").select("key", F.coalesce("stack", none).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (host and path of the winner, else null) and verdict of every row.

    ``rules``: rule_host, rule_path, rule_verdict (allow or block); rows with a null are ignored.
    """
    spark = pages.sparkSession
    host, path = url_parts()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    salt = F.lpad(F.hex(F.xxhash64("page_id", "path")), 16, "0")
    urls = urls.withColumn("key", F.concat(host_key(F.col("host")), F.lit("\x01"), salt))

    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = ranges * KEYS_PER_RANGE
    total = urls.count()
    sample = sorted(row["key"] for row in urls.select("key").sample(min(1.0, wanted / max(total, 1)), seed=7).collect())
    splitters = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []

    rules = rules.dropna(subset=list(RULE_COLUMNS)).distinct()
    rules = rules.withColumn("rule_key", host_key(F.col("rule_host")))
    # "/" is the character after "."
    after = F.concat(F.substring("rule_key", F.lit(1), F.length("rule_key") - 1), F.lit("/"))
    keys = rules.select(F.explode(F.array("rule_key", after)).alias("key"))
    if splitters:
        keys = keys.union(spark.range(1).select(F.explode(F.array(*map(F.lit, splitters)))))
    boundaries = stacks_at(keys.distinct(), rules)

    events = (
        urls.withColumns({"stack": F.lit(None).cast(boundaries.schema["stack"].dataType), "is_url": F.lit(1)})
        .unionByName(boundaries.withColumn("is_url", F.lit(0)), allowMissingColumns=True)
        .withColumn("range", bounds_at_or_below([F.array(*map(F.lit, splitters))], [F.col("key")], len(splitters)))
    )
    up_to_here = Window.partitionBy("range").orderBy("key", "is_url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sweep = F.last("stack", ignorenulls=True).over(up_to_here)
    found = events.withColumn("active", sweep).filter("is_url = 1")
    fits = F.filter(F.coalesce("active", F.array().cast(boundaries.schema["stack"].dataType)), lambda rule: F.startswith(F.col("path"), rule["path"]))
    won = F.try_element_at(fits, F.lit(1))
    return found.withColumn("won", won).select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict")
    )

