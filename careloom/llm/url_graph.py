"""Verdicts on URLs by rules, and by trust and distrust along links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import prepare, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# rules that are written into the plan; more of them are a table that hosts are joined with
MOST_RULES = 5000
DAMPING = 0.85
# the walk ends once less than this is in transit, of all seeds together: what follows is under 0.1% of the verdicts' limit
TOLERANCE = 1e-5
# rounds after which nothing that a double can tell is in transit, whatever the seeds
ROUNDS = 256
ROUNDS_PER_STAGE = 8
# distrust above trust by this share of what a fully blocked host starts with
THRESHOLD = 0.5


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """The rows with ``found``, see ``rule_of``.

    More than ``MOST_RULES`` rules are a table: each different host and path is joined with the rules of its host's
    suffixes, and the rows with what was found; a host or path that very many rows have is grouped before it is joined.
    """
    if len(rules) <= MOST_RULES:
        return pages.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    table = pages.sparkSession.createDataFrame(sorted(set(rules)), "verdict STRING, suffix STRING, start STRING")
    places = pages.select("host", "path").distinct().withColumn("suffix", F.explode(_suffixes(F.col("host"))))
    fitting = places.join(stage(table, "rules"), "suffix").where(F.startswith("path", "start"))
    rule = F.struct((F.length("suffix") + F.length("start")).alias("length"), F.concat("suffix", "start").alias("rule"), "verdict")
    found = stage(fitting.groupBy("host", "path").agg(F.max(rule).alias("found")), "ruled")
    return pages.join(found, ["host", "path"], "left")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the rules ``(verdict, host, path)`` that fit, as a struct of length, rule and verdict; else null.

    A rule fits its host and all subdomains if the path starts with the rule's path.  Only the host's own
    suffixes are looked up, so the number of rules hardly matters.  Equal lengths: the later rule by name.
    """
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, rule_host, rule_path in rules:
        by_host.setdefault(rule_host, []).append((rule_path, verdict))
    if not by_host:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    held = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*[F.struct(F.lit(p).alias("path"), F.lit(v).alias("verdict")) for p, v in own]))])
    suffixes = _suffixes(host)
    fitting = F.flatten(
        F.transform(
            F.filter(suffixes, lambda s: F.map_contains_key(held, s)),
            lambda s: F.transform(
                F.filter(held[s], lambda r: F.startswith(path, r["path"])),
                lambda r: F.struct((F.length(s) + F.length(r["path"])).alias("length"), F.concat(s, r["path"]).alias("rule"), r["verdict"].alias("verdict")),
            ),
        )
    )
    return F.array_max(fitting)


def domain_of(host: Column) -> Column:
    """The last two labels of a host of more, which stand for its registered domain; else, and for an address of numbers, empty."""
    return F.when(F.rlike(host, F.lit(r"\.\d+(:\d+)?$")), F.lit("")).otherwise(F.regexp_extract(host, r"^(?s:.+)\.([^.]+\.[^.]+)$", 1))


def _links(pages: DataFrame) -> DataFrame:
    """Weighted links between different hosts: those of the pages, and both ways between a host and its domain.

    A page's relative links lead to the host of its ``<base>``, if it has one.  The domain need not have pages: it is
    where the hosts of one site meet.
    """
    link = r"(?i)href\s*=\s*[\"']((?:https?:)?//[^\"'\s>]+)"
    plain = F.col("html").isNotNull() & (F.col("host") != "")
    target = F.explode(F.regexp_extract_all(F.col("html"), F.lit(link), F.lit(1)))
    linked = pages.where(plain & F.contains("html", F.lit("//"))).select("host", target.alias("url"), F.lit(1).alias("n"))
    based = pages.where(plain & F.rlike("html", F.lit("(?i)<base\\s"))).select(
        "host", F.regexp_extract("html", r"(?i)<base\s[^>]*?" + link.removeprefix("(?i)"), 1).alias("url"), F.regexp_count("html", F.lit(r"(?i)href\s*=\s*[\"'](?![a-z]+:|//|#)[^\"'\s>]")).alias("n")
    )
    linked = linked.unionByName(based.where("url <> '' AND n > 0"))
    linked = linked.select("host", host_of(F.concat(F.lit("x:"), F.regexp_replace("url", "^[a-zA-Z]*:", ""))).alias("to"), "n")
    linked = linked.where("`to` <> '' AND `to` <> host").groupBy("host", "to").agg(F.sum("n").cast("double").alias("w"))
    outer = pages.where("host <> ''").select("host").distinct().select("host", domain_of(F.col("host")).alias("to"), F.lit(1.0).alias("w")).where("`to` <> ''")
    inner = outer.select(F.col("to").alias("host"), F.col("host").alias("to"), "w")
    return linked.unionByName(outer).unionByName(inner).groupBy("host", "to").agg(F.sum("w").alias("w"))


def _rank(edges: DataFrame, seeds: DataFrame, rounds: int) -> DataFrame:
    """Personalised PageRank ``(walk, host, rank)`` along edges ``(walk, host, to, w)`` from seeds ``(walk, host, s)``; nothing without seeds.

    Ranks are summed up while less and less is in transit, until it is below ``TOLERANCE``.  A round is a join with
    the edges, and each host's step to itself that keeps its rank, and a sum with partial sums; some rounds at a time
    are written to the shared folder.
    """
    node = ["walk", "host"]
    start = F.col("s") * (1 - DAMPING)
    ranks = seeds.select(*node, start.alias("rank"), start.alias("transit"))
    if edges.isEmpty():
        return ranks.drop("transit")
    out = edges.groupBy(*node).agg(F.sum("w").alias("total"))
    links = edges.join(out, node).select(*node, "to", (F.col("w") / F.col("total") * DAMPING).alias("w"), F.lit(0.0).alias("keep"))
    hosts = seeds.select(*node).union(edges.select(*node)).union(edges.select("walk", "to")).distinct()
    steps = stage(links.unionByName(hosts.select(*node, F.col("host").alias("to"), F.lit(0.0).alias("w"), F.lit(1.0).alias("keep"))), "steps")
    moving = F.col("transit") * F.col("w")
    for done in range(0, rounds, ROUNDS_PER_STAGE):
        for _ in range(min(ROUNDS_PER_STAGE, rounds - done)):
            moved = ranks.join(steps, node).select("walk", F.col("to").alias("host"), (F.col("rank") * F.col("keep") + moving).alias("rank"), moving.alias("transit"))
            ranks = moved.groupBy(*node).agg(F.sum("rank").alias("rank"), F.sum("transit").alias("transit"))
        ranks = stage(ranks, "ranks")
        if (ranks.agg(F.sum("transit")).first()[0] or 0.0) < TOLERANCE:
            break
    return ranks.drop("transit")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], rounds: int = ROUNDS, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` of every row.

    Rules ``(allow or block, host, path)`` decide what they fit, the longest first.  Other pages are judged by
    their host: a host's share of allowed pages seeds trust, which follows links, and its share of blocked pages
    seeds distrust, which follows links backwards, both as personalised PageRank, until it no longer changes.  Links are
    those of the pages, and between a host and its domain, where the hosts of one site meet.  A host whose distrust exceeds its trust by
    ``threshold`` of what a wholly blocked host is given each round is blocked.  Only sums per host and per pair of
    hosts are shuffled.

    Null urls and those without ``://`` have an empty host and path and are allowed; null html has no links; null
    ids stay null; repeated rows count each; an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    url = F.col(f"`{url_col}`").cast("string")
    parts = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(f"`{html_col}`").cast("string").alias("html"))
    judged_by_rule = ruled(parts.drop("html"), rules)
    edges = stage(_links(parts), "links")
    hosts = judged_by_rule.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("found.verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"), F.avg(F.when(F.col("found.verdict") == "block", 1.0).otherwise(0.0)).alias("blocked")
    )
    hosts = stage(hosts, "hosts")
    seeds = hosts.select(F.explode(F.array(*[F.struct(F.lit(w).alias("walk"), "host", F.col(c).alias("s")) for w, c in (("trust", "allowed"), ("distrust", "blocked"))])).alias("seed"))
    seeds = seeds.select("seed.*").where("s > 0")
    back = edges.select(F.lit("distrust").alias("walk"), F.col("to").alias("host"), F.col("host").alias("to"), "w")
    ranks = _rank(edges.select(F.lit("trust").alias("walk"), "host", "to", "w").unionByName(back), seeds, rounds)
    walks = [F.sum(F.when(F.col("walk") == w, F.col("rank"))).alias(w) for w in ("trust", "distrust")]
    scores = hosts.select("host").join(ranks.groupBy("host").agg(*walks), "host", "left")
    scores = stage(scores.na.fill(0.0, ["trust", "distrust"]), "scores")
    judged = judged_by_rule.select("id", "host", "path", "found").join(scores, "host", "left")
    bad = F.coalesce(F.col("distrust") - F.col("trust") > threshold * (1 - DAMPING), F.lit(False))
    verdict = F.coalesce(F.col("found.verdict"), F.when(bad, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
