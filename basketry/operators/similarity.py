"""Product-name similarity: TF-IDF vectors, exact similar pairs, groups and consolidation.

Names that share their processed text share a vector, and texts that keep the same terms do too. All
pair work is done once per distinct vector, with the number of names as a weight, so copies cost
nothing however many there are.
"""

from functools import reduce
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.functions.clean import ratio, rounded
from basketry.functions.names import name_tokens, preprocess_product_name
from basketry.operators.comparisons import product_daily
from basketry.operators.serial import add_serial, top_per_group
from basketry.operators.spread import ROWS_PER_BLOCK, block_sizes, grid_join
from basketry.operators.staging import stage

# Settings of the vectors and of the groups.
THRESHOLD = 0.7
COMPARED_THRESHOLDS = (0.5, 0.6, 0.7, 0.8)
MAX_FEATURES = 1000
MAX_DOCUMENT_SHARE = 0.8
LONGEST_NGRAM = 3
TOP_K = 10
# End of fixed values.

_EPSILON = 1e-9


def default_stop_words() -> list[str]:
    """Spark's own English list; another list can be passed to every function here."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def product_texts(names: DataFrame) -> DataFrame:
    """Distinct product names with their processed text."""
    named = names.select("productName").where("productName is not null").distinct()
    return named.withColumn("text", preprocess_product_name("productName"))


def _ngrams(tokens, n: int):
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    return F.when(F.size(tokens) >= n, F.transform(
        starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def _terms(texts: DataFrame, stop_words) -> DataFrame:
    """(text, n_names, term, tf): n-grams of the kept tokens."""
    stop_words = default_stop_words() if stop_words is None else list(stop_words)
    tokens = name_tokens("text")
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~t.isin(stop_words))
    kept = texts.groupBy("text").agg(F.count("*").alias("n_names")).withColumn("tokens", tokens)
    grams = F.concat(*[_ngrams(F.col("tokens"), n) for n in range(1, LONGEST_NGRAM + 1)])
    exploded = kept.select("text", "n_names", F.explode(grams).alias("term"))
    return exploded.groupBy("text", "n_names", "term").agg(F.count("*").alias("tf"))


def vocabulary(terms: DataFrame, texts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """At most max_features terms with document frequency, idf and a rank that starts at the rarest."""
    n = texts.agg(F.count("*")).scalar()
    counts = terms.groupBy("term").agg(
        F.sum("n_names").alias("df"), F.sum(F.col("tf") * F.col("n_names")).alias("uses"))
    kept = counts.where(F.col("df") <= F.lit(MAX_DOCUMENT_SHARE) * n)
    kept = kept.orderBy(F.col("uses").desc(), F.col("term")).limit(max_features)
    return kept.select(
        "term", "df", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"),
        F.row_number().over(Window.orderBy("df", "term")).alias("rank"))


def text_vectors(texts: DataFrame, stop_words=None, max_features: int = MAX_FEATURES) -> DataFrame:
    """(text, n_names, vec_id, terms): unit vector of each text that keeps a term, rarest term first.

    ``terms`` is an array of (rank, term, weight), no longer than the vocabulary. Equal vectors get
    equal vec_id, a digest of their terms.
    """
    terms = _terms(texts, stop_words)
    return _weighted_vectors(terms, vocabulary(terms, texts, max_features))


def _weighted_vectors(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    weighted = terms.join(vocab, "term").select(
        "text", "n_names", F.struct(F.col("rank"), "term", "tf", (F.col("tf") * F.col("idf")).alias("raw")).alias("x"))
    grouped = weighted.groupBy("text", "n_names").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    norm = F.sqrt(F.aggregate("xs", F.lit(0.0), lambda acc, x: acc + x["raw"] * x["raw"]))
    digest = F.sha2(F.to_json(F.transform("xs", lambda x: F.struct(x["term"], x["tf"]))), 256)
    return grouped.withColumn("norm", norm).select(
        "text", "n_names", digest.alias("vec_id"),
        F.transform("xs", lambda x: F.struct(
            x["rank"].alias("rank"), x["term"].alias("term"), (x["raw"] / F.col("norm")).alias("weight"))).alias("terms"))


def tfidf(names: DataFrame, stop_words=None, max_features: int = MAX_FEATURES) -> DataFrame:
    """(productName, term, weight) of every product name."""
    texts = product_texts(names)
    vectors = text_vectors(texts, stop_words, max_features)
    long = vectors.select("text", F.explode("terms").alias("x")).select("text", "x.term", "x.weight")
    return texts.join(long, "text").select("productName", "term", "weight")


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """One row per distinct vector with the number of names behind it and its first text."""
    return vectors.groupBy("vec_id").agg(
        F.first("terms").alias("terms"), F.sum("n_names").alias("n_names"), F.min("text").alias("text"))


def similar_pairs(vectors: DataFrame, threshold: float = THRESHOLD, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All pairs of distinct vectors with cosine >= threshold, as (vec_a, vec_b, similarity), vec_a < vec_b.

    Exact. Only the leading terms of a vector are indexed: the rarest ones, until the squared weights
    of the rest fall below the squared threshold. Two vectors without a common leading term cannot
    reach the threshold. A pair is looked at under its first common leading term only, and its exact
    product is part of the join condition, so nothing but true pairs leaves the join.
    """
    limit = threshold * threshold - _EPSILON
    terms = distinct_vectors(vectors).select(
        "vec_id",
        F.transform("terms", lambda x: F.struct(x["rank"].alias("rank"), x["weight"].alias("weight"))).alias("terms"))
    rest = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.aggregate(
        F.slice("terms", i, F.size("terms")), F.lit(0.0), lambda acc, x: acc + x["weight"] * x["weight"]))
    # Positions are in order, so the leading terms are exactly those whose rest still reaches the limit.
    lead = F.filter(F.zip_with("terms", "rest", lambda x, r: F.struct(x["rank"].alias("rank"), r.alias("rest"))),
                    lambda x: x["rest"] >= limit)
    index = (
        terms.withColumn("rest", rest).withColumn("lead", lead)
        .select("vec_id", "terms", F.transform("lead", lambda x: x["rank"]).alias("lead"), F.explode("lead").alias("at"))
        .select("vec_id", "terms", "lead", F.col("at.rank").alias("rank"), F.col("at.rest").alias("rest")))
    side = lambda s: index.select(
        "rank", F.col("vec_id").alias(f"vec_{s}"), F.col("terms").alias(f"terms_{s}"),
        F.col("lead").alias(f"lead_{s}"), F.col("rest").alias(f"rest_{s}"))
    weight_b = F.map_from_entries("terms_b")
    product = F.aggregate("terms_a", F.lit(0.0), lambda acc, x: acc + x["weight"] * F.coalesce(
        F.element_at(weight_b, x["rank"]), F.lit(0.0)))
    condition = (
        (F.col("vec_a") < F.col("vec_b"))
        & (F.col("rest_a") * F.col("rest_b") >= threshold * threshold - 1e-6)
        & (F.array_min(F.array_intersect("lead_a", "lead_b")) == F.col("rank"))
        & (product >= threshold - _EPSILON))
    sizes = block_sizes(index, index, "rank", rows_per_block)
    pairs = grid_join(side("a"), side("b"), "rank", "vec_a", "vec_b", condition, sizes)
    return pairs.select("vec_a", "vec_b", F.least(product, F.lit(1.0)).alias("similarity"))


def largest_posting_lists(vectors: DataFrame, n: int = 20) -> DataFrame:
    """Terms with the most distinct vectors, to watch the cost of ``similar_pairs``."""
    terms = distinct_vectors(vectors).select(F.explode("terms").alias("x")).groupBy("x.term").agg(
        F.count("*").alias("vectors"))
    return terms.orderBy(F.col("vectors").desc(), "term").limit(n)


def similar_products(names: DataFrame, threshold: float = THRESHOLD, k: int = TOP_K, product: str = None,
                     stop_words=None) -> DataFrame:
    """The k most similar other names of each name, or of one name.

    A vector needs at most k+1 of its own names and k names of each neighbour, so long lists of names
    with the same vector are cut before they meet.
    """
    texts = product_texts(names)
    vectors = text_vectors(texts, stop_words)
    named = texts.join(vectors.select("text", "vec_id"), "text").select("productName", "vec_id")
    pairs = similar_pairs(vectors, threshold)
    both = pairs.select("similarity", F.explode(F.array(
        F.struct(F.col("vec_a"), F.col("vec_b")), F.struct(F.col("vec_b").alias("vec_a"), F.col("vec_a").alias("vec_b")))).alias("pair"))
    both = both.select("pair.vec_a", "pair.vec_b", "similarity")
    wanted = named if product is None else named.where(F.col("productName") == product)
    first_names = top_per_group(named, "vec_id", [F.col("productName")], k + 1).select(
        F.col("vec_id").alias("vec_b"), F.col("productName").alias("similar_product"))
    own = first_names.select(F.col("vec_b").alias("vec_a"), "similar_product", F.lit(1.0).alias("similarity"))
    other = both.join(first_names, "vec_b").select("vec_a", "similar_product", "similarity")
    candidates = own.unionByName(other).withColumn("similarity", rounded("similarity", 6))
    order = [F.col("similarity").desc(), F.col("similar_product")]
    candidates = top_per_group(candidates, "vec_a", order, k + 1)
    found = wanted.join(candidates, F.col("vec_id") == F.col("vec_a")).where("productName <> similar_product")
    return top_per_group(found, "productName", order, k, "position").select(
        "productName", "position", "similar_product", "similarity")


# Nodes that a task of the spanning forest holds in memory.
FOREST_NODES = 1_000_000


def _spanning_edges(batches):
    """Keep only the pairs that join two parts not yet joined in this partition (union-find). Beyond a bound of
    nodes it starts afresh, which keeps more pairs but never loses a link."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        kept = []
        if len(parent) > FOREST_NODES:
            parent.clear()
        for a, b in zip(batch["vec_a"], batch["vec_b"]):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
        yield pd.DataFrame(kept, columns=["u", "v"], dtype=object)


# Shares into which the neighbours of a node are dealt.
NEIGHBOUR_SHARES = 64


def with_least_neighbour(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with the least v of each u as ``m``, and the ``share`` of u in which v lies.

    A minimum is taken in each share, then over at most NEIGHBOUR_SHARES shares of a node, and joined back by node and
    share. So a hub of a large component is spread over tasks, and none reads more than its shares.
    """
    dealt = links.withColumn("share", F.pmod(F.xxhash64("v"), F.lit(NEIGHBOUR_SHARES)).cast("int"))
    shares = dealt.groupBy("u", "share").agg(F.min("v").alias("m"))
    return dealt.join(shares.withColumn("m", F.min("m").over(Window.partitionBy("u"))), ["u", "share"])


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the pair graph; the root is the smallest node of its component.

    Each partition first reduces its pairs to a spanning forest, so only a few edges per node are
    shuffled. Then large-star and small-star rounds (Kiveris et al., 2014) link every node to the
    smallest one; each round is a grouped minimum and a join, both spread over a hub's shares, and is checkpointed.
    """
    forest = pairs.select("vec_a", "vec_b").mapInPandas(_spanning_edges, "u string, v string")
    edges = stage(forest.distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = with_least_neighbour(down)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stage(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    linked = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return linked.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _named_groups(texts: DataFrame, vectors: DataFrame, components: DataFrame) -> DataFrame:
    """(productName, vec_id, group_id); the group id is the first name of the group.

    A name whose text keeps no term has no vector and stays alone.
    """
    named = texts.join(vectors.select("text", "vec_id"), "text", "left").select("productName", "vec_id")
    rooted = named.join(components, F.col("vec_id") == F.col("node"), "left").select(
        "productName", "vec_id", F.coalesce("root", "vec_id", F.concat(F.lit("name:"), F.col("productName"))).alias("root"))
    first = rooted.groupBy("root").agg(F.min("productName").alias("group_id"))
    return rooted.join(first, "root").select("productName", "vec_id", "group_id")


def group_products(names: DataFrame, threshold: float = THRESHOLD, stop_words=None) -> DataFrame:
    """(productName, group_id): names linked by a chain of similar pairs share a group."""
    texts = product_texts(names)
    vectors = stage(text_vectors(texts, stop_words))
    return _groups(texts, vectors, threshold)


def _groups(texts: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    return _named_groups(texts, vectors, connected_components(similar_pairs(vectors, threshold))).select(
        "productName", "group_id")


def fit_groups(names: DataFrame, threshold: float = THRESHOLD, stop_words=None) -> tuple[DataFrame, DataFrame]:
    """Groups and representatives together, from texts and vectors that are worked out once."""
    texts = stage(product_texts(names))
    vectors = stage(text_vectors(texts, stop_words))
    groups = stage(_groups(texts, vectors, threshold))
    return groups, _representatives(texts, vectors, groups)


def group_representatives(names: DataFrame, groups: DataFrame, stop_words=None) -> DataFrame:
    """(group_id, representative, group_size): the name with the highest mean similarity to the others.

    With S the sum of the group's vectors, the mean of v against the n-1 others is (v.S - v.v)/(n-1),
    so the cost is linear in the names. Equal means go to the first name.
    """
    texts = product_texts(names)
    return _representatives(texts, text_vectors(texts, stop_words), groups)


def _representatives(texts: DataFrame, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    terms = distinct_vectors(vectors).select("vec_id", F.explode("terms").alias("x")).select("vec_id", "x.rank", "x.weight")
    named = texts.join(vectors.select("text", "vec_id"), "text", "left").join(groups, "productName")
    members = named.groupBy("group_id", "vec_id").agg(
        F.count("*").alias("n"), F.min("productName").alias("first_name"))
    sizes = members.groupBy("group_id").agg(F.sum("n").alias("group_size"))
    weighted = members.join(terms, "vec_id").select("group_id", "vec_id", "n", "rank", "weight")
    sums = weighted.groupBy("group_id", "rank").agg(F.sum(F.col("weight") * F.col("n")).alias("total"))
    products = weighted.join(sums, ["group_id", "rank"]).groupBy("group_id", "vec_id").agg(
        F.sum(F.col("weight") * F.col("total")).alias("vs"), F.sum(F.col("weight") * F.col("weight")).alias("vv"))
    scored = members.join(products, ["group_id", "vec_id"], "left").join(sizes, "group_id")
    mean = F.round(F.try_divide(F.col("vs") - F.col("vv"), F.col("group_size") - 1), 9)
    return scored.withColumn("mean", F.coalesce(mean, F.lit(-1.0))).groupBy("group_id").agg(
        F.min_by("first_name", F.struct(-F.col("mean"), "first_name")).alias("representative"),
        F.first("group_size").alias("group_size"))


def product_map(groups: DataFrame, representatives: DataFrame) -> DataFrame:
    return groups.join(representatives, "group_id").select("productName", "representative")


def consolidate_sales(sales: DataFrame, mapping: DataFrame, product: str = "productname", value: str = "sales",
                      quantity: str = "quantitysold") -> DataFrame:
    """Sales and quantity by representative, largest first; names outside the map keep their own."""
    known = mapping.select(F.col("productName").alias(product), "representative")
    summed = (
        sales.groupBy(product).agg(F.sum(F.col(value).cast("decimal(28,4)")).alias("sales"), F.sum(quantity).alias("quantity_sold"))
        .join(known, product, "left")
        .groupBy(F.coalesce("representative", product).alias("product_name"))
        .agg(F.sum("sales").alias("sales"), F.sum("quantity_sold").alias("quantity_sold")))
    return add_serial(summed, [F.col("sales").desc_nulls_last(), F.col("product_name").asc_nulls_last()])


def analyze_groups(groups: DataFrame, representatives: DataFrame) -> DataFrame:
    """(group_id, representative, group_size, position, productName): the names of each group in order.

    One row per name, whatever the size of the group. Places come from a range sort over all names, so that a
    very large group is spread over tasks.
    """
    members = groups.join(representatives, "group_id").select("group_id", "representative", "group_size", "productName")
    numbered = add_serial(members, [F.col("group_id"), F.col("productName")])
    first = numbered.groupBy("group_id").agg(F.min("s_no").alias("first"))
    return numbered.join(first, "group_id").select(
        "group_id", "representative", "group_size", (F.col("s_no") - F.col("first") + 1).alias("position"), "productName")


def _kruskal(edges: list) -> list:
    """A spanning forest of the strongest of ``edges`` (a, b, similarity)."""
    parent, kept = {}, []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for edge in sorted(edges, key=lambda e: (-e[2], e)):
        ra, rb = root(edge[0]), root(edge[1])
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append(edge)
    return kept


def _strongest_edges(batches):
    """Of a partition's pairs those that a chain of stronger ones does not make up for. What is held is cut back to a
    forest time and again; a forest of too many nodes is given out and a new one begun, which never loses a link."""
    held, limit = [], FOREST_NODES // 8
    out = lambda edges: pd.DataFrame(edges, columns=["vec_a", "vec_b", "similarity"])
    for batch in batches:
        held += zip(batch["vec_a"], batch["vec_b"], batch["similarity"])
        if len(held) > limit:
            held = _kruskal(held)
            if len(held) > FOREST_NODES:
                yield out(held)
                held = []
            limit = max(FOREST_NODES // 8, 2 * len(held))
    yield out(_kruskal(held))


def strongest_forest(pairs: DataFrame) -> DataFrame:
    """Pairs (vec_a, vec_b, similarity), at most one for each node and partition, that link the same nodes as all
    ``pairs`` at every threshold: the weakest pair of a ring is never needed."""
    return pairs.select("vec_a", "vec_b", "similarity").mapInPandas(_strongest_edges, "vec_a string, vec_b string, similarity double")


def compare_thresholds(names: DataFrame, thresholds=COMPARED_THRESHOLDS, stop_words=None) -> DataFrame:
    """Group counts per threshold. Pairs are found once, for the lowest threshold, and kept as a forest only. Groups are
    merged from the highest threshold down, each time along the forest's pairs between two thresholds."""
    texts = stage(product_texts(names))
    vectors = stage(text_vectors(texts, stop_words))
    forest = stage(strongest_forest(similar_pairs(vectors, min(thresholds))))
    alone = texts.join(vectors.select("text"), "text", "left_anti").count()  # names whose text keeps no term
    nodes = distinct_vectors(vectors).select("vec_id", F.col("vec_id").alias("root"), "n_names")
    parts, above = {}, None
    for t in sorted(set(thresholds), reverse=True):
        new = F.col("similarity") >= t - _EPSILON
        edges = forest.where(new if above is None else new & (F.col("similarity") < above - _EPSILON))
        for end in ("vec_a", "vec_b"):
            edges = edges.join(nodes.select(F.col("vec_id").alias(end), F.col("root").alias(f"root_{end}")), end)
        links = edges.select(F.least("root_vec_a", "root_vec_b").alias("vec_a"), F.greatest("root_vec_a", "root_vec_b").alias("vec_b"))
        merged = connected_components(links).withColumnRenamed("root", "merged")
        nodes = stage(nodes.join(merged, F.col("root") == F.col("node"), "left").select(
            "vec_id", F.coalesce("merged", "root").alias("root"), "n_names"))
        sizes = nodes.groupBy("root").agg(F.sum("n_names").alias("size"))
        groups, members = F.count("*") + alone, F.coalesce(F.sum("size"), F.lit(0)) + alone
        parts[t], above = sizes.agg(
            F.lit(float(t)).alias("threshold"), groups.alias("total_groups"),
            F.count_if(F.col("size") > 1).alias("multi_product_groups"),
            (F.count_if(F.col("size") == 1) + alone).alias("single_product_groups"),
            ratio((members - groups) * 100, members).alias("reduction_percentage")), t
    return reduce(DataFrame.unionByName, [parts[t] for t in thresholds])


def consolidation_impact(before: DataFrame, after: DataFrame, value: str = "sales") -> DataFrame:
    """Row counts, totals, reduction and preserved share of sales, in one pass over both tables."""
    tagged = before.select(F.lit(True).alias("is_before"), F.col(value).alias("v")).unionAll(
        after.select(F.lit(False).alias("is_before"), F.col(value).alias("v")))
    b = F.col("is_before")
    sums = tagged.agg(
        F.count_if(b).alias("original_products"), F.count_if(~b).alias("consolidated_products"),
        F.sum(F.when(b, F.col("v"))).cast("double").alias("original_sales"),
        F.sum(F.when(~b, F.col("v"))).cast("double").alias("consolidated_sales"))
    return sums.select(
        "*",
        ratio((F.col("original_products") - F.col("consolidated_products")) * 100, "original_products", 1).alias("reduction_pct"),
        ratio(F.col("consolidated_sales") * 100, "original_sales", 1).alias("preserved_pct"))


def consolidated_product_daily(sales: DataFrame, mapping: DataFrame, end=None) -> DataFrame:
    """The daily product report, summed by representative."""
    report = product_daily(sales, end)
    return consolidate_sales(report, mapping, "productname", "sales_today", "quantity_today")


def save_groups(path: str, groups: DataFrame, representatives: DataFrame, threshold: float, trained_on) -> None:
    """Store the groups, the representatives and the settings as tables."""
    spark = groups.sparkSession
    groups.write.mode("overwrite").parquet(f"{path}/groups")
    representatives.write.mode("overwrite").parquet(f"{path}/representatives")
    stored = spark.read.parquet(f"{path}/groups")
    stored.agg(F.count("*").alias("product_count")).select(
        F.lit(float(threshold)).alias("threshold"), F.lit(trained_on).alias("trained_on"), "product_count",
    ).write.mode("overwrite").parquet(f"{path}/settings")


def load_groups(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{path}/{t}") for t in ("groups", "representatives", "settings"))


def save_model(path: str, names: DataFrame, groups: DataFrame, representatives: DataFrame, threshold: float, trained_on,
               stop_words=None, max_features: int = MAX_FEATURES) -> None:
    """Store groups, representatives and settings, and what new names are scored with: the vocabulary, the stop words
    and the vectors of the representatives."""
    save_groups(path, groups, representatives, threshold, trained_on)
    spark = names.sparkSession
    stop_words = default_stop_words() if stop_words is None else list(stop_words)
    spark.createDataFrame([(w,) for w in stop_words], "word string").write.mode("overwrite").parquet(f"{path}/stop_words")
    texts = stage(product_texts(names))
    terms = stage(_terms(texts, stop_words))
    vocabulary(terms, texts, max_features).write.mode("overwrite").parquet(f"{path}/vocabulary")
    vectors = _weighted_vectors(terms, spark.read.parquet(f"{path}/vocabulary"))
    chosen = representatives.select(F.col("representative").alias("productName")).distinct()
    texts.join(chosen, "productName").join(vectors, "text").select(
        F.col("productName").alias("representative"), "terms").write.mode("overwrite").parquet(f"{path}/representative_vectors")


def score_names(spark: SparkSession, path: str, names: DataFrame, threshold: float = None) -> DataFrame:
    """(productName, representative, similarity): the most similar stored representative of each name, by the stored
    vocabulary, or nulls where none reaches the threshold (by default that of the groups). Equal ones go by name.

    The names need not have been trained on; terms outside the vocabulary count for nothing. A name meets the
    representatives by its rarest terms only: beyond them its weights can't reach the threshold.
    """
    if threshold is None:
        threshold = spark.read.parquet(f"{path}/settings").first()["threshold"]
    stop_words = [r["word"] for r in spark.read.parquet(f"{path}/stop_words").collect()]  # a list given by the caller
    texts = stage(product_texts(names))
    vectors = stage(_weighted_vectors(_terms(texts, stop_words), spark.read.parquet(f"{path}/vocabulary")))
    pairs = _representative_pairs(distinct_vectors(vectors), spark.read.parquet(f"{path}/representative_vectors"), threshold)
    best = pairs.withColumn("similarity", rounded("similarity", 6)).groupBy("vec_id").agg(
        F.min(F.struct((-F.col("similarity")).alias("order"), "representative", "similarity")).alias("best"))
    return texts.join(vectors.select("text", "vec_id"), "text", "left").join(best, "vec_id", "left").select(
        "productName", "best.representative", "best.similarity")


def _representative_pairs(vectors: DataFrame, stored: DataFrame, threshold: float, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(vec_id, representative, similarity) of at least the threshold, by an inverted index of the stored terms."""
    ranks = lambda c: F.transform(c, lambda x: x["rank"])
    rest = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.aggregate(
        F.slice("terms", i, F.size("terms")), F.lit(0.0), lambda acc, x: acc + x["weight"] * x["weight"]))
    lead = F.filter(F.zip_with(ranks("terms"), "rest", lambda r, w: F.struct(r.alias("rank"), w.alias("rest"))),
                    lambda x: x["rest"] >= threshold * threshold - _EPSILON)
    new = vectors.withColumn("rest", rest).withColumn("lead", ranks(lead)).select("vec_id", "terms", "lead", F.explode("lead").alias("rank"))
    index = stored.select("representative", F.col("terms").alias("stored"), F.explode(ranks("terms")).alias("rank"))
    weights = F.map_from_entries(F.transform("stored", lambda x: F.struct(x["rank"], x["weight"])))
    product = F.aggregate("terms", F.lit(0.0), lambda acc, x: acc + x["weight"] * F.coalesce(F.element_at(weights, x["rank"]), F.lit(0.0)))
    condition = (F.array_min(F.array_intersect("lead", ranks("stored"))) == F.col("rank")) & (product >= threshold - _EPSILON)
    sizes = block_sizes(new, index, "rank", rows_per_block)
    return grid_join(new, index, "rank", "vec_id", "representative", condition, sizes).select(
        "vec_id", "representative", F.least(product, F.lit(1.0)).alias("similarity"))
