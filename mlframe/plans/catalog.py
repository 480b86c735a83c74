"""Queries over the driver tables, one or more per operator.  Each reads whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mlframe.functions import rng, vec
from mlframe.operators import (bow, canopy, evaluate, forest, graph, hac, kmeans, kmeans_bow, logreg, naive_bayes, pairs)
from mlframe.runtime import scratch_dir
from mlframe.sources import generate, sinks, text

SEED = 7
DIMS = 64


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0.0 turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features"), "label")


def label_means(spark, d) -> DataFrame:
    """Mean vector of each label: the centres the embeddings were drawn around."""
    return evaluate.vector_sum(embeddings(spark, d), DIMS, ["label"]).select(
        F.col("label").alias("cluster"), F.col("mean").alias("center"))


def items(spark, d) -> DataFrame:
    """lineitem as labelled points: scaled quantity and discount, label 1 for returned items."""
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.array(F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0).alias("features"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))


def order_points(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array(F.col("o_totalprice") / 1000.0,
                F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) / 7.0).alias("features"))


def _text_counts() -> tuple[Column, Column]:
    """Words and full stops of ``text``."""
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    return words, F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))


def doc_features(spark, d) -> DataFrame:
    """Labelled documents: characters, words, full stops and toxicity; label = quality."""
    docs = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    words, dots = _text_counts()
    return docs.join(table(spark, d, "labels"), "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.array(*[c.cast("double") for c in (F.col("n_chars"), words, dots, F.col("toxic"))]).alias("features"),
        F.col("quality").alias("label"))


def all_doc_features(spark, d) -> DataFrame:
    """The same features for every document; where no label is known, toxicity is 0."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", "toxic")
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("row_id"), F.array(*[c.cast("double") for c in (
        F.col("n_chars"), *_text_counts(), F.coalesce("toxic", F.lit(0)))]).alias("features"))


def documents_bow(spark, d) -> DataFrame:
    return bow.bag_of_words(table(spark, d, "documents"))


def flat(df: DataFrame, keys: list[str], array: str, digits: int = 6) -> DataFrame:
    """One row per vector component, rounded."""
    return df.select(*keys, F.posexplode(array).alias("pos", "v")).select(*keys, "pos", rnd("v", digits).alias("value"))


# ---- sources -------------------------------------------------------------------------------

def labeled_vectors_parse(spark, d):
    li = table(spark, d, "lineitem")
    line = F.concat_ws(", ", "l_quantity", "l_discount", "l_linenumber", "l_tax", "l_returnflag")
    lines = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), line.alias("value"))
    p = text.parse_labeled_vectors(lines, 2)
    return p.select("row_id", F.col("features")[0].alias("x1"), F.col("features")[1].alias("x2"),
                    F.col("center")[0].alias("c1"), F.col("center")[1].alias("c2"), "label")


def extract_labeled(spark, d):
    li = table(spark, d, "lineitem")
    line = F.concat_ws(",", "l_quantity", "l_tax", "l_linenumber", "l_linenumber", "l_linestatus")
    lines = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), line.alias("value"))
    p = forest.extract_labeled(text.parse_labeled_vectors(lines, 2))
    return p.select("row_id", F.col("features")[0].alias("x1"), F.col("features")[1].alias("x2"), "label")


def labeled_points_parse(spark, d):
    li = table(spark, d, "lineitem")
    flag = F.when(F.col("l_returnflag") == "R", "1").otherwise("0")
    line = F.concat_ws(",", "l_quantity", F.lit(" "), flag, "l_discount")
    lines = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), line.alias("value"))
    p = text.parse_labeled_points(lines, 3, 3)
    return p.select("row_id", "label", *[F.col("features")[j].alias(f"x{j + 1}") for j in range(3)])


def _bow_lines(spark, d):
    li = table(spark, d, "lineitem")
    body = li.select(F.concat_ws(" ", "l_orderkey", "l_partkey", F.col("l_quantity").cast("int")).alias("value"))
    header = table(spark, d, "orders").agg(F.count("*").cast("string").alias("value"))
    return body.unionByName(header)


def bow_parse(spark, d):
    return text.parse_bow(_bow_lines(spark, d))


def word_sets_parse(spark, d):
    return text.parse_word_sets(_bow_lines(spark, d))


def pipe_points_parse(spark, d):
    o = table(spark, d, "orders").select(
        F.concat(F.concat_ws("|", "o_orderkey", "o_totalprice", "o_custkey"), F.lit("|")).alias("value"))
    return text.parse_points(o, "|", 2, True).select(
        "row_id", F.col("features")[0].alias("x"), F.col("features")[1].alias("y"))


def space_points_parse(spark, d):
    c = table(spark, d, "customer")
    lines = c.select("c_custkey", F.concat_ws(" ", "c_acctbal", "c_nationkey").alias("value"))
    return text.parse_points(lines, " ", 2, False).select(
        "c_custkey", F.col("features")[0].alias("x"), F.col("features")[1].alias("y"))


def space_centers_parse(spark, d):
    s = table(spark, d, "supplier").select(F.concat_ws(" ", "s_suppkey", "s_acctbal", "s_nationkey").alias("value"))
    return text.parse_points(s, " ", 2, True, "cluster").select(
        "cluster", F.col("features")[0].alias("x"), F.col("features")[1].alias("y"))


def theta_parse(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.max("l_extendedprice").alias("a"), (-F.max("l_quantity") / 1e9).alias("b"), F.max("l_discount").alias("c"))
    lines = sinks.theta_line(li.select(F.array("a", "b", "c").alias("theta"))).select("value")
    p = text.parse_theta(lines)
    return p.select(*[F.col("theta")[j].alias(f"t{j}") for j in range(3)])


# ---- functions, aggregates ------------------------------------------------------------------

def vector_functions(spark, d):
    e = embeddings(spark, d).join(label_means(spark, d).withColumnRenamed("cluster", "label"), "label")
    x, c = F.col("features"), F.col("center")
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    return e.select(
        "row_id", rnd(vec.vnorm(x)).alias("norm"), rnd(vec.dot(x, c)).alias("dot"),
        rnd(vec.euclidean(x, c)).alias("dist"), rnd(vec.sq_dist(x, c)).alias("sq_dist"),
        rnd(total(vec.vadd(x, c))).alias("add_total"), rnd(total(vec.vsub(x, c))).alias("sub_total"),
        rnd(total(vec.vscale(x, 2.5))).alias("scale_total"), rnd(vec.velement(x, 0)).alias("first"),
        vec.vequal(x, x).alias("same"), vec.vequal(x, c).alias("other"),
        vec.vequal(x, F.when(vec.velement(x, 0) > 0, x).otherwise(vec.vscale(x, 2.0))).alias("mixed"), rnd(vec.sigmoid(vec.dot(x, c))).alias("sig"))


def string_functions(spark, d):
    o = table(spark, d, "orders").withColumn("parts", vec.unpack(F.col("o_orderpriority"), "-"))
    return o.select("o_orderkey", vec.pack(F.col("parts"), ";").alias("packed"),
                    F.substring("o_orderpriority", 1, 1).alias("head"),
                    F.regexp_replace("o_orderpriority", "[^0-9]", "").alias("digits"))


def vector_sums(spark, d):
    s = evaluate.vector_sum(embeddings(spark, d), DIMS, ["label"])
    return s.select("label", "n", F.posexplode(F.arrays_zip("total", "mean")).alias("pos", "z")).select(
        "label", "n", "pos", rnd("z.total").alias("total"), rnd("z.mean").alias("mean"))


def count_rows(spark, d):
    return evaluate.count_rows(table(spark, d, "lineitem"))


def class_counts(spark, d):
    return evaluate.class_counts(table(spark, d, "lineitem"), ["l_linenumber"], "l_returnflag")


def bow_term_counts(spark, d):
    return bow.term_counts(table(spark, d, "documents"))


# ---- samples and generators -----------------------------------------------------------------

def bernoulli_sample(spark, d):
    return rng.bernoulli(table(spark, d, "events"), 0.1, SEED, "event_id", portable=True).select(
        "event_id", "event_type", "value")


def first_row(spark, d):
    return rng.first_by_id(table(spark, d, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


def random_row(spark, d):
    return rng.random_row(table(spark, d, "orders"), SEED, "o_orderkey", portable=True).select(
        "o_orderkey", "o_custkey", "o_totalprice")


def weighted_pick(spark, d):
    return rng.weighted_pick(table(spark, d, "orders"), "o_totalprice", SEED, "o_orderkey", portable=True).select(
        "o_orderkey", "o_custkey", "o_totalprice")


def shuffled_subset(spark, d):
    return rng.shuffled_subset(table(spark, d, "orders"), 1000, SEED, "o_orderkey", portable=True).select(
        "o_orderkey", "o_totalprice")


def feature_subset(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return rng.feature_subset(c, 6, 3, SEED, ["c_custkey"], portable=True).select(
        "c_custkey", F.explode("features_used").alias("feature"))


def bootstrap(spark, d):
    return forest.bootstrap(doc_features(spark, d), 0.7, 3, SEED, portable=True).select("row_id", "tree_id", "in_bag")


def _ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"))


def random_sphere(spark, d):
    p = generate.random_sphere(_ids(spark, d), 3, 100, SEED, portable=True)
    return p.select("row_id", "label", *[rnd(F.col("features")[j]).alias(f"x{j}") for j in range(3)])


def random_hypercube(spark, d):
    p = generate.random_hypercube(_ids(spark, d), 2, 100, SEED, portable=True)
    return p.select("row_id", "label", *[rnd(F.col("features")[j]).alias(f"x{j}") for j in range(2)])


def labels_1d(spark, d):
    return generate.labels_1d(_ids(spark, d), 0.4, SEED, portable=True).select(
        "row_id", rnd(F.col("features")[0], 9).alias("x"), "label")


def labels_2d(spark, d):
    return generate.labels_2d(_ids(spark, d), 0.4, 0.3, SEED, portable=True).select(
        "row_id", rnd(F.col("features")[0], 9).alias("x"), rnd(F.col("features")[1], 9).alias("y"), "label")


# ---- line files: written to the shared folder and read again ----

def _file(df: DataFrame) -> str:
    """Path of a new text file that holds the lines of ``df``."""
    path = f"{scratch_dir(df.sparkSession).rstrip('/')}/lines-{uuid.uuid4().hex}"
    sinks.write_table(df.select("value"), path, "text")
    return path


def sampled_lines_file(spark, d):
    lines = table(spark, d, "events").select("event_id", F.concat_ws(",", "event_id", "event_type").alias("value"))
    return text.read_lines(spark, _file(rng.bernoulli(lines, 0.1, SEED, "event_id", portable=True)))


def generated_lines_file(spark, d):
    points = generate.random_sphere(_ids(spark, d), 3, 100, SEED, portable=True)
    p = text.read_labeled_vectors(spark, _file(sinks.generated_lines(points)), 3)
    return p.select(*[rnd(F.col("features")[j]).alias(f"x{j}") for j in range(3)], F.col("center")[2].alias("c2"), "label")


def scored_lines_file(spark, d):
    points = items(spark, d)
    lines = text.read_lines(spark, _file(sinks.scored_lines(logreg.logreg_predict(points, logreg.logreg_fit(points, 1.0, 3)))))
    v = F.split("value", ",")
    return lines.select(rnd(v[0]).alias("probability"), v[1].cast("int").alias("label"), rnd(v[2]).alias("x1"), rnd(v[3]).alias("x2"))


def cluster_lines_file(spark, d):
    """The items of each order on one line behind the order's price and priority."""
    members = items(spark, d).select(F.floor(F.col("row_id") / 10).alias("cluster"), "row_id", "features")
    centers = table(spark, d, "orders").select(F.col("o_orderkey").alias("cluster"), F.array(
        "o_totalprice", F.substring("o_orderpriority", 1, 1).cast("double")).alias("center"))
    return text.read_lines(spark, _file(sinks.cluster_lines(centers, members)))


def cluster_folders(spark, d):
    """Centres and members in their two folders, joined again from what was read."""
    centers = evaluate.vector_sum(order_points(spark, d).join(table(spark, d, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("cluster")), "row_id"),
        2, ["cluster"]).select("cluster", F.transform("mean", lambda x: F.round(x, 3)).alias("center"))
    members = kmeans.assign(order_points(spark, d), centers).select("row_id", "features", "cluster")
    path = f"{scratch_dir(spark).rstrip('/')}/clusters-{uuid.uuid4().hex}"
    sinks.write_clusters(centers, members, path, "text")
    c = text.read_centers(spark, f"{path}/centers", "|", 2)
    m = text.read_points(spark, f"{path}/clusters", "|", 3, True).withColumn("cluster", F.col("features")[2].cast("int"))
    return m.join(c, "cluster").select("row_id", "cluster", *[rnd(F.col("features")[j], 3).alias(f"x{j}") for j in range(2)],
                                       *[rnd(F.col("center")[j], 3).alias(f"c{j}") for j in range(2)])


# ---- k-means --------------------------------------------------------------------------------

def kmeans_assign(spark, d):
    return kmeans.assign(embeddings(spark, d), label_means(spark, d)).select(
        "row_id", "cluster", rnd("distance").alias("distance"))


def kmeans_step(spark, d):
    return flat(kmeans.lloyd_step(embeddings(spark, d), label_means(spark, d)), ["cluster", "n"], "center")


def kmeans_3_rounds(spark, d):
    res = kmeans.kmeans(embeddings(spark, d), label_means(spark, d), 3)
    return flat(res.centers, ["cluster"], "center")


def kmeans_stable(spark, d):
    res = kmeans.kmeans(embeddings(spark, d), label_means(spark, d))
    return res.assignment.select("row_id", "cluster", rnd("distance").alias("distance"))


def kmeans_distinct_centers(spark, d):
    """Starting centres taken from the centre columns of labelled vectors."""
    li = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.array(F.col("l_quantity") / 10.0, F.col("l_tax") * 10.0).alias("features"),
        F.array(F.col("l_linenumber").cast("double"), F.lit(0.5)).alias("center"))
    res = kmeans.kmeans(li, kmeans.distinct_centers(li), 2)
    return flat(res.centers, ["cluster"], "center")


def _small_centers(spark):
    rows = [(1, [0.1, 0.5]), (2, [0.35, 0.2]), (3, [0.6, 0.8]), (4, [0.9, 0.4])]
    return text.in_memory(spark, rows, "cluster int, center array<double>")


def kmeans_dedupe(spark, d):
    res = kmeans.kmeans(items(spark, d), _small_centers(spark), 3, dedupe=True)
    return flat(res.centers, ["cluster"], "center")


def kmeans_assignment_lines(spark, d):
    centers = text.in_memory(spark, [(1, [50.0, 100.0]), (2, [200.0, 100.0]), (3, [350.0, 300.0])],
                             "cluster int, center array<double>")
    pts = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array(F.col("o_totalprice") / 700.0 + 1e-7, F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) / 7.0)
        .alias("features"))
    return sinks.assignment_lines(kmeans.assign(pts, centers))


def kmeans_custom_distance(spark, d):
    """User-supplied distance: sum of absolute differences."""
    def manhattan(x, c):
        return F.aggregate(F.zip_with(x, c, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: a + b)

    return kmeans.assign(items(spark, d), _small_centers(spark), distance=manhattan).groupBy("cluster").agg(
        F.count("*").alias("n"), rnd(F.sum("distance"), 3).alias("total"))


def kmeans_tol(spark, d):
    """Ends after the first round that moves no centre farther than 0.01, here before the eighth."""
    res = kmeans.kmeans(items(spark, d), _small_centers(spark), 8, tol=0.01)
    return flat(res.centers, ["cluster"], "center").withColumn("rounds", F.lit(res.rounds))


def kmeans_pp_init(spark, d):
    return flat(kmeans.kmeans_pp_init(embeddings(spark, d), 4, SEED, portable=True), ["cluster"], "center")


def kmeans_pp_farthest(spark, d):
    c = kmeans.kmeans_pp_init(embeddings(spark, d), 4, SEED, init="farthest", first="first")
    return flat(c, ["cluster"], "center")


def kmeans_pp(spark, d):
    res = kmeans.kmeans_pp(embeddings(spark, d), 4, 3, SEED, portable=True)
    return res.assignment.select("row_id", "cluster", rnd("distance").alias("distance"))


def kmeans_pp_2d(spark, d):
    res = kmeans.kmeans_pp(order_points(spark, d), 3, 2, SEED, portable=True)
    return flat(res.centers, ["cluster"], "center")


def kmeans_bow_step(spark, d):
    b = documents_bow(spark, d)
    docs = table(spark, d, "documents").groupBy("lang").agg(F.min("doc_id").alias("doc_id"))
    ids = {r["lang"]: r["doc_id"] for r in docs.collect()}  # one start document per language
    chosen = [(i + 1, ids[k]) for i, k in enumerate(sorted(ids))]
    postings = kmeans_bow._postings(b)
    step = kmeans_bow.mean_centers(postings, kmeans_bow.nearest_documents(
        postings, kmeans_bow._centers_of(postings, chosen)))
    return step.select("cluster", F.col("term_id").alias("term"), rnd("weight").alias("weight"))


def kmeans_pp_bow(spark, d):
    res = kmeans_bow.kmeans_pp_bow(documents_bow(spark, d), 4, 2, SEED, portable=True)
    return res.assignment.select("doc_id", "cluster", rnd("distance", 4).alias("distance"))


# ---- canopies, pairs, hierarchical clustering ---------------------------------------------

def canopy_euclidean(spark, d):
    return canopy.canopy_euclidean(order_points(spark, d), 7, 3)


def canopy_jaccard(spark, d):
    return canopy.canopy_jaccard(documents_bow(spark, d), 0.15, 0.3)


def canopy_max_rounds(spark, d):
    """Two centres only; the other documents share the canopy NULL."""
    return canopy.canopy_jaccard(documents_bow(spark, d), 0.15, 0.3, max_rounds=2)


def canopy_lines(spark, d):
    return sinks.canopy_lines(canopy.canopy_jaccard(documents_bow(spark, d), 0.5, 0.7))


def doc_dot_similarity(spark, d):
    return pairs.dot_similarities(documents_bow(spark, d))


def doc_jaccard_pairs(spark, d):
    return pairs.jaccard_pairs(documents_bow(spark, d), 0.3).select("a", "b", rnd("sim").alias("sim"))


def first_independent_set(spark, d):
    """Orders of one customer form a chain by order number; keep the greedy independent set."""
    o = table(spark, d, "orders")
    nxt = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    edges = o.select(F.col("o_orderkey").alias("a"), nxt.alias("b")).where("b is not null")
    return graph.first_mis(o.select(F.col("o_orderkey").alias("v")), edges)


def hac_single_history(spark, d):
    return hac.hac_documents(documents_bow(spark, d), 8, "single").history


def hac_min_history(spark, d):
    return hac.hac_documents(documents_bow(spark, d), 8, "min_similarity").history


def hac_history_line(spark, d):
    return sinks.history_line(hac.hac_documents(documents_bow(spark, d), 8, "single").history)


def hac_history_lines(spark, d):
    return sinks.history_lines(hac.hac_documents(documents_bow(spark, d), 8, "single").history)


def hac_level_changes(spark, d):
    return hac.level_changes(hac.hac_documents(documents_bow(spark, d), 8, "single").history)


def hac_membership(spark, d):
    return hac.hac_documents(documents_bow(spark, d), 8, "single").membership(8)


def hac_memberships(spark, d):
    """Clusters after 0, 3 and 8 merges, in one go."""
    steps = text.in_memory(spark, [(0,), (3,), (8,)], "step bigint")
    return hac.hac_documents(documents_bow(spark, d), 8, "single").memberships(steps)


def doc_near_copies(spark, d):
    """Near copies: here the prefixes are short and their join is the cheaper way."""
    return pairs.jaccard_pairs(documents_bow(spark, d), 0.8).select("a", "b", rnd("sim").alias("sim"))


def doc_dot_large(spark, d):
    """Only large similarities: blocks of short documents are never multiplied."""
    return pairs.dot_similarities(documents_bow(spark, d), min_sim=2000.0)


def hash_independent_set(spark, d):
    """The chains of ``first_independent_set`` in the order of seeded numbers: logarithmic rounds."""
    o = table(spark, d, "orders")
    nxt = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    edges = o.select(F.col("o_orderkey").alias("a"), nxt.alias("b")).where("b is not null")
    return graph.first_mis(o.select(F.col("o_orderkey").alias("v")), edges, "hash", SEED, portable=True)


def hac_full_history(spark, d):
    return hac.hac_documents(documents_bow(spark, d), 2 ** 62, "single").history


def _sold_together(spark, d):
    """An edge table: suppliers and parts, linked by the quantity sold together."""
    li = table(spark, d, "lineitem")
    edges = li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("sim")).select(
        F.col("l_suppkey").alias("a"), (F.col("l_partkey") + 10_000_000_000).alias("b"), "sim")
    return edges, edges.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def hac_order_edges(spark, d):
    """HAC on a given edge table, up to one cluster: number of merges and sum of similarities."""
    edges, nodes = _sold_together(spark, d)
    return hac.hac(edges, nodes, 2 ** 62, "single").merges.agg(
        F.count("*").alias("n_merges"), F.sum("sim").alias("total"))


def hac_order_history(spark, d):
    """The same merges, one by one."""
    return hac.hac(*_sold_together(spark, d), 2 ** 62, "single").history


def hac_centroid(spark, d):
    """Nations as points (mean balance, mean order value), merged up to one cluster."""
    c = table(spark, d, "customer").join(
        table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.sum("o_totalprice").alias("spent"), F.count("*").alias("k")), "c_custkey")
    pts = c.groupBy(F.col("c_nationkey").alias("row_id")).agg(F.array(
        F.avg("c_acctbal"), F.sum("spent") / F.sum("k") / 10.0).alias("features"))
    return hac.hac_centroid(pts).select("step", "a", "b", rnd("distance", 4).alias("distance"), "n")


# ---- logistic regression -----------------------------------------------------------------

def logreg_theta(spark, d):
    theta = logreg.logreg_fit(items(spark, d), 1.0, 3)
    return flat(logreg.theta_frame(spark, theta), [], "theta", 8)


def logreg_theta_sgd(spark, d):
    theta = logreg.logreg_fit_sgd(items(spark, d), 0.5, 1, batch=20_000, seed=SEED, portable=True)
    return flat(logreg.theta_frame(spark, theta), [], "theta", 8)


def logreg_score(spark, d):
    theta = logreg.logreg_fit(items(spark, d), 1.0, 3)
    return logreg.logreg_predict(items(spark, d), theta).select(
        "row_id", "label", rnd("probability").alias("probability"), "prediction")


def logreg_accuracy(spark, d):
    theta = logreg.logreg_fit(items(spark, d), 1.0, 3)
    return evaluate.correct_count(logreg.logreg_predict(items(spark, d), theta))


def bayes_predict(spark, d):
    """Quality of every document by its words, learned from the labelled ones."""
    b = documents_bow(spark, d)
    model = naive_bayes.fit(b, table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")))
    return model.predict(b).select("doc_id", "prediction", rnd("score", 4).alias("score"))


# ---- trees and forests ---------------------------------------------------------------------

def _flag_points(spark, d):
    return table(spark, d, "lineitem").select(
        "l_linestatus", F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"),
        F.col("l_returnflag").alias("label"))


def entropy_by_group(spark, d):
    e = forest.entropy(table(spark, d, "lineitem"), ["l_linenumber"], "l_returnflag")
    return e.select("l_linenumber", "n", rnd("entropy").alias("entropy"))


def split_gain(spark, d):
    g = forest.split_gain(doc_features(spark, d).withColumn("g", F.col("features")[3]), ["g"], 0, 1500.0)
    return g.select("g", "n_left", "n_right", rnd("gain").alias("gain"))


def best_split(spark, d):
    b = forest.best_split(_flag_points(spark, d), ["l_linestatus"], ["A", "N", "R"])
    return b.select("l_linestatus", "feature", "threshold", rnd("gain", 9).alias("gain"))


def _model(spark, d):
    return forest.forest_fit(doc_features(spark, d), 3, 2, 2, 0.7, SEED, portable=True)


def tree_depth_2(spark, d):
    nodes = forest.tree_fit(doc_features(spark, d), 4, 2, SEED, portable=True).nodes
    return nodes.select("node_id", "feature", "threshold", "n", "prediction", "n_prediction")


def forest_nodes(spark, d):
    return _model(spark, d).nodes.select("tree_id", "node_id", "feature", "threshold", "n", "prediction", "n_prediction")


def forest_votes(spark, d):
    return _model(spark, d).votes(all_doc_features(spark, d)).select("row_id", "label", rnd("share").alias("share"))


def forest_predict(spark, d):
    return _model(spark, d).predict(all_doc_features(spark, d)).select("row_id", "prediction", rnd("share").alias("share"))


def forest_scores(spark, d):
    """The same predictions without a join: trees as arrays, walked by batches of rows."""
    scored = _model(spark, d).score(all_doc_features(spark, d))
    return scored.select("row_id", "prediction", rnd("share").alias("share"))


def oob_error(spark, d):
    return _model(spark, d).oob_error().select(rnd("error").alias("error"))


def confusion(spark, d):
    data = doc_features(spark, d)
    scored = _model(spark, d).predict(data).join(data.select("row_id", "label"), "row_id")
    return evaluate.confusion_matrix(scored)


def _returned(spark, d):
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")  # some lines of an order share a number
    return table(spark, d, "lineitem").select(
        ((line * 100_000 + F.col("l_partkey")) * 10_000 + F.col("l_suppkey")).alias("row_id"),
        F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"),
        F.col("l_returnflag").alias("label"))


def forest_lineitem(spark, d):
    """A forest on the largest table; each tree's out-of-bag error."""
    model = forest.forest_fit(_returned(spark, d), 3, 2, 3, 0.66, SEED, portable=True)
    return model.oob_by_tree().select("tree_id", "n", rnd("error").alias("error"))


def forest_lineitem_binned(spark, d):
    """The same forest on quantiles of its features."""
    model = forest.forest_fit(_returned(spark, d), 3, 2, 3, 0.66, SEED, portable=True, max_bins=64)
    return model.oob_by_tree().select("tree_id", "n", rnd("error").alias("error"))


def forest_binned_nodes(spark, d):
    nodes = forest.forest_fit(doc_features(spark, d), 3, 2, 3, 0.7, SEED, portable=True, max_bins=8).nodes
    return nodes.select("tree_id", "node_id", "feature", "threshold", "n", "prediction", "n_prediction")


def tree_binned(spark, d):
    """Every node looks at all features, so only smaller children are counted."""
    nodes = forest.tree_fit(doc_features(spark, d), 4, 4, SEED, portable=True, max_bins=32).nodes
    return nodes.select("node_id", "feature", "threshold", "n", "prediction", "n_prediction")


ALL = [
    labeled_vectors_parse, extract_labeled, labeled_points_parse, bow_parse, word_sets_parse, pipe_points_parse,
    space_points_parse, space_centers_parse, theta_parse, vector_functions, string_functions, vector_sums, count_rows,
    class_counts, bow_term_counts, bernoulli_sample, first_row, random_row, weighted_pick, shuffled_subset,
    feature_subset, bootstrap, random_sphere, random_hypercube, labels_1d, labels_2d, kmeans_assign, kmeans_step,
    kmeans_3_rounds, kmeans_stable, kmeans_distinct_centers, kmeans_dedupe, kmeans_assignment_lines,
    kmeans_custom_distance, kmeans_pp_init, kmeans_pp_farthest, kmeans_pp, kmeans_pp_2d, kmeans_bow_step,
    kmeans_pp_bow, canopy_euclidean, canopy_jaccard, canopy_lines, doc_dot_similarity, doc_jaccard_pairs,
    first_independent_set, hac_single_history, hac_min_history, hac_history_line, hac_membership, hac_full_history,
    hac_order_edges, hac_centroid, logreg_theta, logreg_theta_sgd, logreg_score, logreg_accuracy, entropy_by_group,
    split_gain, best_split, tree_depth_2, forest_nodes, forest_votes, forest_predict, oob_error, confusion,
    forest_lineitem, sampled_lines_file, generated_lines_file, scored_lines_file, cluster_lines_file, cluster_folders,
    canopy_max_rounds, hac_history_lines, hac_level_changes, forest_lineitem_binned, forest_binned_nodes, tree_binned,
    forest_scores, hac_memberships, doc_near_copies, doc_dot_large, hash_independent_set,
    hac_order_history, kmeans_tol, bayes_predict,
]
QUERIES = {f.__name__: f for f in ALL}
