"""Verdicts on page addresses: host and path rules first, link-graph propagation for the rest.

Hosts are the nodes of a graph: an edge runs from a page's host to every other host its
markup links to, and to the host's parent domain, each counted once per pair and kind.
Trust starts at hosts with allowed pages, distrust at hosts with blocked pages, each host
weighing the share of its pages that a rule decides so, and each kind summing to 1 over all
hosts. Trust follows the edges (personalised PageRank), distrust runs against them, to those that
link to such hosts. A host's own share weighs ``OWN`` times what the walk brings it. Its spam is its distrust
over its distrust, its trust and ``OWN`` even shares (1 / hosts): whoever has no more distrust than
trust and an average host's part together has at most one half.

The threshold on spam is set by the hosts that the rules settle: they are parted into ``FOLDS``, each
judged by what reaches it from the other folds' seeds alone, and the cut with the least balanced
error against their rules is taken (``THRESHOLD`` where links reach fewer than ``LEAST`` of a verdict).

Everything is DataFrame work: pages are reduced to one row per host and one per edge
before anything is joined, and each round moves one row per edge and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import store
from segmint.llm.exact_dedup import by_key

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its own; the longest wins (fixed values)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING = 0.85
ROUNDS = 12
STORE_EVERY = 4
THRESHOLD = 0.5
FOLDS = 2
BINS = 100
OWN = 3.0
LEAST = 20  # hosts of each verdict that links must reach before the threshold is set by them
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty without ``://`` and for null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (``host`` and ``path`` joined) and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones are asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(word)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b): host ``a`` links to host ``b``, or ``b`` is its parent domain; each pair once, none with itself."""
    links = pages.where(F.col("html").contains("//")).select(F.col("host").alias("a"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("b"))
    links = links.select("a", F.translate(F.regexp_replace("b", r"^[^@]*@|:[0-9]*$", ""), UPPER, LOWER).alias("b"))
    parents = pages.select(F.col("host").alias("a"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("b"))
    return links.union(parents).where("a <> '' and b <> '' and a <> b").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: ``edges`` (kind, a, b), ``seeds`` (kind, host, mass) → (kind, host, rank).

    Mass is passed on in equal parts; a host that passes nothing on keeps its mass for
    itself. Each kind's total mass stays what its seeds hold.
    """
    degree = edges.groupBy("kind", "a").agg(F.count("*").alias("n"))
    steps = edges.join(degree, ["kind", "a"]).select("kind", F.col("a").alias("host"), "b", (1.0 / F.col("n")).alias("part"))
    nodes = edges.select("kind", F.col("a").alias("host")).union(edges.select("kind", F.col("b").alias("host"))).union(seeds.select("kind", "host")).distinct()
    ends = nodes.join(degree.select("kind", F.col("a").alias("host")), ["kind", "host"], "left_anti")
    steps = store(steps.union(ends.select("kind", "host", F.col("host").alias("b"), F.lit(1.0).alias("part"))))
    rank = seeds.select("kind", "host", F.col("mass").alias("rank"))
    start = seeds.select("kind", "host", ((1 - damping) * F.col("mass")).alias("rank"))
    for k in range(1, rounds + 1):
        moved = rank.join(steps, ["kind", "host"]).select("kind", F.col("b").alias("host"), (damping * F.col("rank") * F.col("part")).alias("rank"))
        rank = moved.union(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % STORE_EVERY == 0 and k < rounds:
            rank = store(rank)
    return rank


def host_spam(seen: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``seen`` (host, allowed, blocked, open), ``edges`` (a, b) → every seen host with trust, distrust, spam and
    ``by_links``, its spam by what reaches it while its fold's seeds are left out (null: not settled by rules, or nothing does)."""
    pages = F.col("allowed") + F.col("blocked") + F.col("open")
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")
    kinds = [f"{kind}{f}" for kind in ("trust", "distrust") for f in ("", *range(FOLDS))]
    at = {k: F.lit(True) if k[-1].isalpha() else fold != int(k[-1]) for k in kinds}
    share = {k: F.col("blocked" if k.startswith("distrust") else "allowed") / pages for k in kinds}
    seeds = seen.select("host", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.when(at[k], share[k]).alias("mass")) for k in kinds])).alias("s")).select("s.kind", "host", "s.mass").where("mass > 0")
    totals = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))  # one row of each kind
    seeds = store(seeds.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("mass")))
    way = F.array(*[F.struct(F.lit(k).alias("kind"), *([F.col("b").alias("a"), F.col("a").alias("b")] if k.startswith("distrust") else ["a", "b"])) for k in kinds])
    rank = propagate(edges.select(F.explode(way).alias("e")).select("e.*"), seeds, rounds)
    got = rank.groupBy("host").agg(*[F.sum(F.when(F.col("kind") == k, F.col("rank"))).alias(k) for k in kinds])
    own = seeds.groupBy("host").agg(*[F.sum(F.when(F.col("kind") == k, F.col("mass"))).alias(f"own_{k}") for k in ("trust", "distrust")])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    even = OWN / max(seen.count(), 1)
    all_of = lambda kind: zero(kind) + zero(f"own_{kind}") * OWN
    spam = lambda bad, fine: bad / (bad + fine + F.lit(even))
    left_out = lambda kind: F.coalesce(*[F.when(fold == f, zero(f"{kind}{f}")) for f in range(FOLDS)])
    settled = (F.col("allowed") + F.col("blocked") > 0) & (left_out("trust") + left_out("distrust") > 0)
    both = seen.join(got, "host", "left").join(own, "host", "left")
    return both.select("host", "allowed", "blocked", "open", all_of("trust").alias("trust"), all_of("distrust").alias("distrust"),
                       spam(all_of("distrust"), all_of("trust")).alias("spam"),
                       F.when(settled, spam(left_out("distrust"), left_out("trust"))).alias("by_links"))


def best_cut(hosts: DataFrame, least: float = LEAST) -> float:
    """The middle of the cuts on ``by_links`` with the least balanced error against the rules' own verdicts, each host
    weighing 1; ``THRESHOLD`` where links reach fewer than ``least`` hosts of a verdict. At most ``BINS + 1`` rows come to the driver."""
    bins = hosts.where("by_links is not null").groupBy(F.floor(F.col("by_links") * BINS).cast("int").alias("bin")).agg(
        F.sum(F.col("blocked") / (F.col("allowed") + F.col("blocked"))).alias("bad"), F.sum(F.col("allowed") / (F.col("allowed") + F.col("blocked"))).alias("fine"))
    rows = bins.orderBy("bin").collect()
    bad, fine = sum(r["bad"] for r in rows), sum(r["fine"] for r in rows)
    if min(bad, fine) < least:
        return THRESHOLD
    errors = [(round(sum(r["bad"] for r in rows if r["bin"] < c) / bad + sum(r["fine"] for r in rows if r["bin"] >= c) / fine, 12), c) for c in range(BINS + 2)]
    cuts = [c for e, c in errors if e == min(errors)[0]]
    return (cuts[0] + cuts[-1]) / 2 / BINS


def judge_pages(pages: DataFrame, rules=RULES, threshold: float | None = None, rounds: int = ROUNDS,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, host, path, rule, verdict, spam (of the host, see above). A host is blocked when its
    spam is above ``threshold`` (None: the cut that the settled hosts give).

    Null addresses and those without ``://`` have an empty host and path, no rule, and are
    allowed, as is every host that neither kind of mass reaches. Repeated rows are judged
    alike (each counts as a page); null markup links to nothing; an empty table gives no
    rows; other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).cast("string").alias("html"))
    rule, by_rule = best_rule(F.col("host"), F.col("path"), rules)
    judged = plain.withColumn("rule", rule).withColumn("by_rule", by_rule)
    seen = store(judged.groupBy("host").agg(
        F.count_if(F.col("by_rule") == "allow").cast("double").alias("allowed"), F.count_if(F.col("by_rule") == "block").cast("double").alias("blocked"),
        F.count_if(F.col("by_rule").isNull()).cast("double").alias("open")).where("host <> ''"))
    hosts = store(host_spam(seen, store(host_edges(plain)), rounds))
    cut = best_cut(hosts) if threshold is None else threshold
    facts = hosts.select("host", (F.col("allowed") + F.col("blocked") + F.col("open")).cast("long").alias("size"), "spam")
    total = facts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows = judged.drop("html")
    found = by_key(rows.where("host <> ''"), facts, "host", total).unionByName(rows.where("host = ''"), allowMissingColumns=True)
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("spam") > cut, "block").otherwise("allow")).alias("verdict"), F.coalesce("spam", F.lit(0.0)).alias("spam"))
