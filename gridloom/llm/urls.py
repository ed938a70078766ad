"""Operator 9: URL rules, and trust spread over the link graph of hosts.

A url that a rule fits gets the longest rule's verdict. All other urls get their host's: trust
flows from hosts with allowed pages along links (personalised PageRank), distrust flows from
hosts with blocked pages against the links (who links to a blocked host is suspect), and a host
is blocked when distrust is more than ``threshold`` of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tables import released, written

#: (verdict, host, path).
Rule = tuple[str, str, str]
DAMPING = 0.85
#: Largest change of a host's score, as a share of it, at which the rounds end.
TOLERANCE = 1e-4
THRESHOLD = 0.5


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path; both empty for a null url or one without ``://``."""
    u = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return df.withColumns({"host": lower_ascii(F.regexp_extract(u, pattern, 1)), "path": F.regexp_extract(u, pattern, 2)})


def rule_column(rules: list[Rule], host: str = "host", path: str = "path") -> Column:
    """The longest rule (host and path together) that fits, as text; of equally long ones the
    first in the list."""
    h, p = F.col(host), F.col(path)
    out = F.lit(None).cast("string")
    for _, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        out = F.when(fits, rule_host + rule_path).otherwise(out)
    return out


def rule_verdict(rules: list[Rule], rule: str = "rule") -> Column:
    out = F.lit(None).cast("string")
    for verdict, host, path in reversed(rules):
        out = F.when(F.col(rule) == host + path, verdict).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between hosts, counted; a relative link stays on its own host.

    ``pages`` needs host and html. Links without a host (mailto:, #) and null html give none.
    """
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit("(?i)<a\\s[^>]*?href\\s*=\\s*[\"']?([^\"'\\s>]+)"), F.lit(1))
    link = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("link"))
    there = F.regexp_extract("link", "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)", 1)
    dst = F.when(there != "", lower_ascii(there)).when(~F.col("link").rlike("^([A-Za-z][A-Za-z0-9+.-]*:|#)"), F.col("src"))
    return link.select("src", dst.alias("dst")).where("dst IS NOT NULL").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score): personalised PageRank of ``seeds`` (host, seed: shares that sum to 1), written.

    ``edges`` is (src, dst, share), the shares of a source summing to 1. A source without links
    gives its score back to the seeds. A round is one join on the source and one sum per target,
    combined before the shuffle, and is written. The rounds end when no host's score changes by
    more than ``tolerance`` of itself; a host reached for the first time changes by all of it, so
    that the rounds reach every host, however far.
    """
    if not 0 < damping < 1 or not 0 < tolerance < 1:
        raise ValueError("damping and tolerance lie between 0 and 1")
    zero, no = F.lit(0.0), F.lit(False)
    linked = edges.select(F.col("src").alias("host"), zero.alias("seed"), F.lit(True).alias("linked"))
    base = seeds.select("host", "seed", no.alias("linked")).union(linked)
    base = written(base.groupBy("host").agg(F.sum("seed").alias("seed"), F.max("linked").alias("linked")), "pagerank-seeds")
    score = written(base.select("host", F.col("seed").alias("score"), "linked"), "pagerank")
    change = 1.0
    while change > tolerance:
        stays = score.agg(F.sum(F.when(~F.col("linked"), F.col("score")))).first()[0] or 0.0
        held = score.where("score > 0")
        moved = held.join(edges, held["host"] == edges["src"]).select(
            F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"), zero.alias("before"), no.alias("linked")
        )
        kept = base.select("host", ((damping * stays + 1 - damping) * F.col("seed")).alias("score"), zero.alias("before"), "linked")
        before = held.select("host", zero.alias("score"), F.col("score").alias("before"), no.alias("linked"))
        sums = moved.union(kept).union(before).groupBy("host").agg(
            F.sum("score").alias("score"), F.sum("before").alias("before"), F.max("linked").alias("linked")
        )
        after = written(sums, "pagerank")
        change = after.where("score > 0").agg(F.max(F.abs(F.col("score") - F.col("before")) / F.col("score"))).first()[0] or 0.0
        released(score)
        score = after
    released(base)
    return score


def host_verdicts(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD, damping: float = DAMPING,
                  tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, blocked) of every host that pages have or link to, written.

    Scores are shares of one, of any smallness; seeds of both kinds weigh by their number of pages.
    """
    parted = with_parts(pages).withColumn("verdict", rule_verdict_of(rules))
    edges = written(host_edges(parted), "host-edges")
    counts = written(
        parted.groupBy("host").agg(
            F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("bad"),
        ),
        "host-seeds",
    )
    total = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    out, spent = counts.select("host").union(edges.select("dst")).distinct(), [edges, counts]
    for column, name, source, target in (("good", "trust", "src", "dst"), ("bad", "distrust", "dst", "src")):
        seeds = counts.where(f"{column} > 0").select("host", (F.col(column) / F.lit(float(total[column] or 1))).alias("seed"))
        own = edges.select(F.col(source).alias("src"), F.col(target).alias("dst"), "n")
        sums = own.groupBy("src").agg(F.sum("n").alias("of"))
        shares = written(own.join(sums, "src").select("src", "dst", (F.col("n") / F.col("of")).alias("share")), "host-shares")
        scores = spread(shares, seeds, damping, tolerance)
        released(shares)
        spent.append(scores)
        out = out.join(scores.select("host", F.col("score").alias(name)), "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    good, bad = trust * float(total["good"] or 0), distrust * float(total["bad"] or 0)
    # More than the threshold by more than the sums' rounding.
    blocked = bad - threshold * (good + bad) > 1e-9 * (good + bad)
    out = written(out.select("host", trust.alias("trust"), distrust.alias("distrust"), blocked.alias("blocked")), "host-verdicts")
    released(*spent)
    return out


def rule_verdict_of(rules: list[Rule]) -> Column:
    """The verdict of the longest rule that fits host and path, null if none does."""
    out = F.lit(None).cast("string")
    for verdict, host, path in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, verdict).otherwise(out)
    return out


def judged(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    A host that neither kind of score reaches is allowed, also the empty host of a null url.
    Repeated rows are judged each and weigh each. Empty input gives an empty result.
    """
    slim = pages.select(pages["page_id"], pages["url"], pages["html"])
    hosts = host_verdicts(slim, rules, threshold).where("blocked").select("host")
    marked = hosts.withColumn("blocked", F.lit(True))
    df = with_parts(slim.select("page_id", "url")).join(marked, "host", "left")
    method = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    df = df.withColumn("rule", rule_column(rules))
    return df.select("page_id", "host", "path", "rule", F.coalesce(rule_verdict(rules), method).alias("verdict"))
