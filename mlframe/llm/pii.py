"""Personal data by weak supervision.  DataFrame functions only.

Patterns propose spans.  Five labelers vote on each: the strict pattern, its checks, a gazetteer, the words before, and the
characters around.  Expectation-maximisation estimates from the votes alone how reliable each labeler is, and a logistic
span classifier is trained on its posteriors.  What the strict patterns accept always stays; the classifier adds the rest.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from mlframe.runtime import durable

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
EM_ROUNDS, FIT_ROUNDS = 30, 25
THRESHOLD = 0.5
NEAR = 32

# Strict patterns.  Possessive repeats and the look-behind leave their matches as they are and keep the search linear.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider patterns, whose spans need the classifier's consent.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\)|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\x20dot\x20)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
# What a text must hold for a pattern to be tried.
NEEDS = {"email": "[@]| ?(?:at|\\[at\\]|\\(at\\)|\\{at\\}) ?", "ip": "[0-9][.:]|[A-Fa-f]:", "card": "[0-9]", "phone": "[0-9]"}

# Fixed word lists of the gazetteer and context labelers.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "uk", "de", "fr", "es", "it", "nl", "eu", "ch", "at", "us", "ca")
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35)"
PRIVATE_IP = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
AREA_CODE = r"^(?:\+?1)?[2-9][0-9]{2}[2-9]"
CUES = {
    "email": "e-?mail|mail|contact|write|reach",
    "ip": "\\bip\\b|address|host|server|login|from",
    "card": "card|visa|master|credit|debit|pay|account",
    "phone": "phone|tel|call|mobile|cell|fax|dial|whatsapp",
}
AGAINST = "version|isbn|issn|doi|order|invoice|figure|section|chapter|page|build|release|item|sku|\\bid\\b|no\\.|#"


def _found(text: Column, kind: str, pattern: str, wide: bool) -> Column:
    """Matches of a pattern with the length of the text before each and what stands around it."""
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), 0)
    # the pieces are split once: the array goes through a one-element transform to get a name
    return F.flatten(F.transform(F.array(pieces), lambda p: F.transform(hits, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(wide).alias("wide"), i.alias("i"), m.alias("span"),
        F.length(F.element_at(p, i + 1)).alias("gap"), F.right(F.element_at(p, i + 1), F.lit(NEAR)).alias("pre"),
        F.left(F.element_at(p, i + 2), F.lit(1)).alias("post")))))


def _luhn(digits: Column) -> Column:
    digit = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + F.when(i % 2 == 1, digit(i)).otherwise(
        digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)))
    return total % 10 == 0


def candidates(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, found``: every row of ``docs`` with the spans its text suggests, written to the shared folder."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = "array<struct<kind:string,wide:boolean,i:int,span:string,gap:int,pre:string,post:string>>"
    lists = [F.when(F.col("text").rlike(NEEDS[k]), _found(F.col("text"), k, p, wide)).otherwise(F.array().cast(none))
             for wide, group in ((False, STRICT), (True, WIDE)) for k, p in group.items()]
    return durable(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.concat(*lists).alias("found")))


def votes(found: DataFrame) -> DataFrame:
    """One row per suggested span: ``rid, kind, start, stop, base`` and the labelers' votes, 1 for, -1 against, 0 for none.

    Places are code points.  ``base``: a strict pattern's match that passes its checks.
    """
    rows = found.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    by = Window.partitionBy("rid", "kind", "wide").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("span")
    placed = rows.withColumn("stop", F.sum(F.col("gap") + size).over(by)).withColumn("start", F.col("stop") - size) \
        .withColumn("digits", F.regexp_replace("span", "[^0-9]", ""))
    n = F.length("digits")
    small = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    dotted = F.forall(F.split("span", r"\."), lambda p: p.rlike(small))
    kind = F.col("kind")
    passes = F.when(kind == "email", F.lit(True)).when(kind == "ip", F.col("wide") | dotted) \
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), _luhn(F.col("digits"))).otherwise(False)) \
        .otherwise(n.between(10, 15))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    tld = F.lower(F.regexp_extract("span", r"([A-Za-z]+)$", 1)).isin(*TOP_LEVEL)
    listed = F.when(kind == "email", vote(tld, ~tld)).when(kind == "ip", vote(~F.col("wide") & ~F.col("span").rlike(PRIVATE_IP), F.lit(False))) \
        .when(kind == "card", vote(F.col("digits").rlike(CARD_ISSUERS), ~F.col("digits").rlike(CARD_ISSUERS))) \
        .otherwise(vote(F.col("digits").rlike(AREA_CODE), F.lit(False)))
    pre = F.lower("pre")
    cue = reduce(lambda c, k: c.when((kind == k) & pre.rlike(CUES[k]), 1), KINDS, F.when(F.lit(False), 1))
    around = F.concat(F.right("pre", F.lit(1)), "post")
    return placed.select(
        "rid", "kind", "start", "stop", (~F.col("wide") & passes).alias("base"),
        vote(~F.col("wide"), F.lit(False)).alias("pattern"), vote(passes, ~passes).alias("check"), listed.alias("gazetteer"),
        F.coalesce(cue, F.when(pre.rlike(AGAINST), -1), F.lit(0)).alias("context"),
        vote(~around.rlike("[A-Za-z0-9_/=]"), around.rlike("[A-Za-z0-9_/=]")).alias("edges"))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over counted vote patterns ``(kind, votes, count)``.

    Returns the posterior of each pattern and P(vote | class) as labelers x votes (-1, 0, 1) x classes.  Kinds have priors of
    their own.  Starts from the majority; counts are smoothed, so a labeler that never votes stays undecided.
    """
    kind = np.array([KINDS.index(k) for k, _, _ in patterns], int)
    v = np.array([x for _, x, _ in patterns], int).reshape(len(patterns), len(LABELERS))
    n = np.array([c for _, _, c in patterns], float)
    post = 1 / (1 + np.exp(-1.5 * v.sum(1))) if len(v) else np.zeros(0)
    table = np.full((len(LABELERS), 3, 2), 1 / 3)
    for _ in range(rounds if len(v) else 0):
        weight = np.stack([n * (1 - post), n * post], 1)
        for j in range(len(LABELERS)):
            for x in (-1, 0, 1):
                table[j, x + 1] = weight[v[:, j] == x].sum(0) + 1.0
        table /= table.sum(1, keepdims=True)
        prior = np.stack([np.bincount(kind, weight[:, c], len(KINDS)) + 1.0 for c in (0, 1)], 1)
        logit = np.log(prior[kind, 1] / prior[kind, 0])
        for j in range(len(LABELERS)):
            logit = logit + np.log(table[j, v[:, j] + 1, 1] / table[j, v[:, j] + 1, 0])
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post, table


def _features(kind: int, v: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(kind == k) for k in range(1, len(KINDS))), *(float(x == s) for x in v for s in (1, -1))]


def fit(patterns: list[tuple[str, tuple[int, ...], int]]) -> list[float]:
    """Weights of the logistic span classifier, trained by Newton steps on the posteriors of all spans."""
    post, _ = reliabilities(patterns)
    if not patterns:
        return [0.0] * len(_features(0, (0,) * len(LABELERS)))
    x = np.array([_features(KINDS.index(k), v) for k, v, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    w = np.zeros(x.shape[1])
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - post)) + 0.5 * w
        hess = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w.tolist()


def probability(weights: list[float]) -> Column:
    """The classifier as a Column over ``kind`` and the votes."""
    parts = [F.lit(1.0), *((F.col("kind") == k).cast("double") for k in KINDS[1:]),
             *((F.col(x) == s).cast("double") for x in LABELERS for s in (1, -1))]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, [F.lit(w) * p for w, p in zip(weights, parts)])))


def _joined(spans: Column) -> Column:
    """kind:start:end of structs (start, rank, stop), in that order, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs``.

    Null texts count as empty.  Counts and the hash are of the strict patterns' spans; ``spans`` also holds spans that the
    classifier accepts and that overlap none of those nor an accepted one further left.  Only counts of vote patterns, at
    most 4 * 3^5, reach the driver.
    """
    found = candidates(docs)
    spans = durable(votes(found))
    counted = spans.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).orderBy("kind", *LABELERS)
    weights = fit([(r[0], tuple(r[1:1 + len(LABELERS)]), r["n"]) for r in counted.toLocalIterator()])
    rank = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col("kind"))
    one = F.struct("start", rank.alias("rank"), "stop")
    taken = spans.withColumn("p", probability(weights)).where(F.col("base") | (F.col("p") > THRESHOLD)).groupBy("rid").agg(
        F.collect_list(F.when(F.col("base"), one)).alias("base"), F.collect_list(F.when(~F.col("base"), one)).alias("more"),
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS])
    clash = lambda a, b: (a["start"] < b["stop"]) & (b["start"] < a["stop"])
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: clash(m, b)))
    added = F.filter("free", lambda m: ~F.exists("free", lambda o: clash(m, o) & (
        (o["start"] < m["start"]) | ((o["start"] == m["start"]) & (o["rank"] < m["rank"])))))
    lists = taken.withColumn("free", free).withColumn("added", added)
    empty = F.array().cast("array<struct<start:bigint,rank:int,stop:bigint>>")
    return found.select("rid", "doc_id").join(lists, "rid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.coalesce("base", empty)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat(F.coalesce("base", empty), F.coalesce("added", empty))).alias("spans"))


def query(docs: DataFrame) -> DataFrame:
    return find(docs)
