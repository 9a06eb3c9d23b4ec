"""Product-name similarity, consolidation and clusters over all product names and vectors.

The reference thresholds find no similar texts among the part names, so the pair and group queries also
run at a lower threshold, where they do.
"""

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions.clean import rounded as round_to
from basketry.functions.names import preprocess_product_name
from basketry.operators import aggregates, clusters, comparisons, similarity
from basketry.operators.staging import scratch_path
from basketry.plans.catalog.daily import _end, _PRODUCT_DAILY, product_lines
from basketry.plans.catalog.ingest import preprocess_sql
from basketry.plans.catalog.registry import query
from basketry.plans.catalog.sql_views import BILLING, PRODUCT_SALES, rounded, with_
from basketry.sources import star

LOOSE = 0.4
TEXTS = f"""texts as (select "productName", {preprocess_sql('"productName"')} as text from (select distinct "productName" from billing
 where "productName" is not null))"""
# The part names hold no English stop word, so the SQL needs no list of them.
_GRAMS = " union all ".join(
    f"select text, n_names, array_to_string(tokens[i : i + {n - 1}], ' ') as term from toks, "
    f"unnest(generate_series(1, len(tokens) - {n - 1})) as g(i)" for n in (1, 2, 3))
WEIGHTS = f"""toks as (select text, count(*) as n_names, regexp_extract_all(text, '\\b[a-zA-Z][a-zA-Z]+\\b') as tokens from texts group by 1),
 terms as (select text, n_names, term, count(*) as tf from ({_GRAMS}) group by 1, 2, 3),
 vocab as (select term, sum(n_names) as df from terms group by 1 having sum(n_names) <= 0.8 * (select count(*) from texts)
 order by sum(tf * n_names) desc, term limit 1000),
 raw_w as (select text, n_names, term, tf * (ln((1.0 + (select count(*) from texts)) / (1.0 + df)) + 1) as w from terms join vocab using (term)),
 weights as (select text, n_names, term, w / sqrt(sum(w * w) over (partition by text)) as weight from raw_w),
 sims as (select a.text as x, b.text as y, sum(a.weight * b.weight) as s from weights a join weights b using (term) group by 1, 2)"""
BASE = with_(BILLING, TEXTS, WEIGHTS).rstrip().replace("with ", "with recursive ", 1)


def names(s, d):
    return star.billing(s, d, ["productName"])


query("tfidf", lambda s, d: similarity.tfidf(names(s, d)).select("productName", "term", round_to("weight", 6).alias("weight")),
      BASE + f'\nselect "productName", term, {rounded("weight", 6)} as weight from texts join weights using (text)')


def _pairs(threshold):
    def build(s, d):
        vectors = similarity.text_vectors(similarity.product_texts(names(s, d)))
        pairs = similarity.similar_pairs(vectors, threshold)
        text = similarity.distinct_vectors(vectors).select("vec_id", "text")
        a, b = text.toDF("vec_a", "ta"), text.toDF("vec_b", "tb")
        return pairs.join(a, "vec_a").join(b, "vec_b").select(
            F.least("ta", "tb").alias("text_a"), F.greatest("ta", "tb").alias("text_b"),
            round_to("similarity", 6).alias("similarity"))
    return build


def _pairs_sql(t):
    return BASE + f"\nselect x as text_a, y as text_b, {rounded('s', 6)} as similarity from sims where x < y and s >= {t}"


query("similar_pairs", _pairs(similarity.THRESHOLD), _pairs_sql(similarity.THRESHOLD))
query("similar_pairs_loose", _pairs(LOOSE), _pairs_sql(LOOSE))


def _similar_sql(t):
    return BASE + f"""\nselect a."productName", row_number() over (partition by a."productName" order by {rounded("s", 6)} desc, b."productName") as position,
 b."productName" as similar_product, {rounded("s", 6)} as similarity from texts a join sims on x = a.text join texts b on b.text = y
 where s >= {t} and a."productName" <> b."productName" qualify position <= 10"""


query("similar_products", lambda s, d: similarity.similar_products(names(s, d)), _similar_sql(similarity.THRESHOLD))
query("similar_products_loose", lambda s, d: similarity.similar_products(names(s, d), LOOSE), _similar_sql(LOOSE))


def groups_sql(t, suffix=""):
    """Components of the similar texts, then the group and representative of each name."""
    return f"""reach{suffix}(x, y) as (select distinct x, x from sims union select r.x, e.y from reach{suffix} r join sims e on e.x = r.y where e.s >= {t}),
 roots{suffix} as (select x as text, min(y) as root from reach{suffix} group by 1),
 members{suffix} as (select t."productName", t.text, min(t."productName") over (partition by coalesce(root, t."productName")) as group_id,
 count(*) over (partition by coalesce(root, t."productName")) as group_size from texts t left join roots{suffix} using (text))"""


_REPS = """means as (select m.group_id, m.group_size, m.text, min(m."productName") as first_name from members m group by 1, 2, 3),
 scores as (select a.group_id, a.group_size, a.first_name, round((sum(coalesce(s.s, 0) * b.n) - 1) / nullif(a.group_size - 1, 0), 9) as mean
 from means a join (select group_id, text, count(*) as n from members group by 1, 2) b on a.group_id = b.group_id
 left join sims s on s.x = a.text and s.y = b.text group by 1, 2, 3),
 reps as (select group_id, group_size, first_name as representative from scores
 qualify row_number() over (partition by group_id order by coalesce(mean, -1) desc, first_name) = 1)"""


def _full(t):
    return BASE + ",\n" + groups_sql(t) + ",\n" + _REPS


for suffix, t in (("", similarity.THRESHOLD), ("_loose", LOOSE)):
    query("group_products" + suffix, lambda s, d, t=t: similarity.group_products(names(s, d), t),
          BASE + ",\n" + groups_sql(t) + '\nselect "productName", group_id from members')
    query("group_representatives" + suffix, lambda s, d, t=t: similarity.group_representatives(
        names(s, d), similarity.group_products(names(s, d), t)), _full(t) + "\nselect group_id, representative, group_size from reps")


def _mapping(s, d):
    return similarity.fit_groups(names(s, d), LOOSE)


_MAP = _full(LOOSE) + ',\n product_map as (select "productName", representative from members join reps using (group_id))'


def _consolidated(s, d):
    return similarity.consolidate_sales(aggregates.product_sales(product_lines(s, d)), similarity.product_map(*_mapping(s, d)))


query("consolidate_sales", _consolidated, _MAP + ",\n" + PRODUCT_SALES + """
 select row_number() over (order by sum(sales) desc, coalesce(representative, product_sales.productname)) as s_no,
 coalesce(representative, product_sales.productname) as product_name, cast(sum(sales) as double) as sales, cast(sum(quantitysold) as bigint) as quantity_sold
 from product_sales left join product_map on product_map."productName" = product_sales.productname group by coalesce(representative, product_sales.productname)""")
query("analyze_groups", lambda s, d: similarity.analyze_groups(*_mapping(s, d)), _full(LOOSE) + """
 select group_id, representative, reps.group_size, row_number() over (partition by group_id order by "productName") as position,
 "productName" from members join reps using (group_id)""")


def _compare_sql(thresholds):
    ctes = ",\n".join(groups_sql(t, f"_{i}") for i, t in enumerate(thresholds))
    return BASE + ",\n" + ctes + "\n" + " union all ".join(
        f"""select {float(t)}::double as threshold, count(*) as total_groups, count_if(n > 1) as multi_product_groups, count_if(n = 1) as single_product_groups,
 {rounded("cast(sum(n) - count(*) as double) * 100 / cast(sum(n) as double)")} as reduction_percentage
 from (select group_id, count(*) as n from members_{i} group by 1)""" for i, t in enumerate(thresholds))


query("compare_thresholds", lambda s, d: similarity.compare_thresholds(names(s, d)), _compare_sql(similarity.COMPARED_THRESHOLDS))
query("compare_thresholds_loose", lambda s, d: similarity.compare_thresholds(names(s, d), (0.3, LOOSE)), _compare_sql((0.3, LOOSE)))


def _impact(s, d):
    sales = aggregates.product_sales(product_lines(s, d))
    after = similarity.consolidate_sales(sales, similarity.product_map(*_mapping(s, d)))
    return similarity.consolidation_impact(sales.groupBy("productname").agg(F.sum("sales").alias("sales")), after)


query("consolidation_impact", _impact, _MAP + ",\n" + PRODUCT_SALES + f""",
 before_rows as (select productname, sum(sales) as v from product_sales group by 1),
 after_rows as (select coalesce(representative, before_rows.productname) as k, sum(v) as v from before_rows
 left join product_map on product_map."productName" = before_rows.productname group by 1),
 sides as (select (select count(*) from before_rows) as n, (select count(*) from after_rows) as m,
 (select cast(sum(v) as double) from before_rows) as b, (select cast(sum(v) as double) from after_rows) as a)
 select n as original_products, m as consolidated_products, b as original_sales, a as consolidated_sales,
 {rounded("cast(n - m as double) * 100 / n", 1)} as reduction_pct, {rounded("a * 100 / b", 1)} as preserved_pct from sides""")
query("consolidated_product_daily", lambda s, d: similarity.consolidated_product_daily(
    aggregates.product_sales(product_lines(s, d)), similarity.product_map(*_mapping(s, d)), _end(s, d)),
      _MAP + f""",\n daily as ({_PRODUCT_DAILY}),
 merged as (select coalesce(representative, daily.productname) as product_name, cast(sum(cast(sales_today as decimal(28,4))) as double) as sales,
 sum(quantity_today) as quantity_sold from daily left join product_map on product_map."productName" = daily.productname group by 1)
 select row_number() over (order by sales desc, product_name) as s_no, * from merged""")


def _saved(s, d):
    path = scratch_path(s, "groups")
    found, chosen = _mapping(s, d)
    similarity.save_groups(path, found, chosen, LOOSE, dt.date(2024, 4, 30))
    groups, representatives, settings = similarity.load_groups(s, path)
    of_run = [settings.select(c).scalar().alias(c) for c in ("threshold", "trained_on", "product_count")]
    return groups.join(representatives, "group_id").select("productName", "representative", *of_run)


query("save_and_load_groups", _saved, _MAP + f"""\nselect "productName", representative, {LOOSE}::double as threshold,
 date '2024-04-30' as trained_on, (select count(*) from texts) as product_count from product_map""")


def _new_names(s, d):
    """Names that no product has, from the words of those sold, stored model first."""
    path, sold = scratch_path(s, "name-model"), names(s, d)
    similarity.save_model(path, sold, *_mapping(s, d), LOOSE, dt.date(2024, 4, 30))
    word = lambda n: F.split_part("productName", F.lit(" "), F.lit(n))
    return similarity.score_names(s, path, sold.select(F.concat(word(2), F.lit(" "), word(1), F.lit(" deluxe")).alias("productName")).distinct())


_NEW_GRAMS = " union all ".join(
    f"select new_name, array_to_string(tokens[i : i + {n - 1}], ' ') as term from new_tokens, "
    f"unnest(generate_series(1, len(tokens) - {n - 1})) as g(i)" for n in (1, 2, 3))
query("score_new_names", _new_names, _MAP + f""",
 new_names as (select distinct split_part("productName", ' ', 2) || ' ' || split_part("productName", ' ', 1) || ' deluxe' as new_name from billing
 where "productName" is not null),
 new_tokens as (select new_name, regexp_extract_all({preprocess_sql("new_name")}, '\\b[a-zA-Z][a-zA-Z]+\\b') as tokens from new_names),
 new_raw as (select new_name, term, tf * (ln((1.0 + (select count(*) from texts)) / (1.0 + df)) + 1) as w
 from (select new_name, term, count(*) as tf from ({_NEW_GRAMS}) group by 1, 2) join vocab using (term)),
 new_weights as (select new_name, term, w / sqrt(sum(w * w) over (partition by new_name)) as weight from new_raw),
 scored_new as (select new_name, representative, least(sum(a.weight * b.weight), 1.0) as s from new_weights a join weights b using (term)
 join texts on texts.text = b.text join reps on reps.representative = texts."productName" group by 1, 2),
 best_new as (select new_name, representative, similarity, row_number() over (partition by new_name order by similarity desc, representative) as r
 from (select new_name, representative, {rounded('s', 6)} as similarity from scored_new where s >= {LOOSE} - 1e-9))
select new_name as "productName", representative, similarity from new_names left join (select * from best_new where r = 1) using (new_name)""")


def _leaders_sql():
    """Leaders among the rows 1.. of v, one after the other; near lists the similar earlier rows of a row."""
    return """steps(i, leaders) as (select cast(0 as bigint), cast([] as bigint[]) union all
 select i + 1, case when coalesce(len(list_intersect(leaders, earlier)), 0) > 0 then leaders else list_append(leaders, i + 1) end
 from steps left join near on near.b = i + 1 where i < (select count(*) from v)),
 final as (select leaders from steps where i = (select count(*) from v))"""


# The longest common subsequence, by rows over the characters of one text: the best so far, or one more where both match.
_BETTER = ("list_transform(generate_series(1, len(best)), lambda j: "
           "greatest(best[j], case when hit[j] = 1 then coalesce(best[j - 1], 0) + 1 else 0 end))")
_FUZZY_SQL = f"""named as (select distinct "productName", trim(replace(translate(lower("productName"), '-™®', ' '), '&', 'and')) as clean_name
 from billing where "productName" is not null),
 keyed as (select *, array_to_string(list_sort(regexp_split_to_array(clean_name, '\\s+')), ' ') as text from named),
 v as (select text, min(clean_name) as id, row_number() over (order by min(clean_name)) as rn from keyed group by text),
 close as (select a.rn as a, b.rn as b, a.text as x, b.text as y, length(a.text) + length(b.text) as n from v a join v b on a.rn < b.rn
 where levenshtein(a.text, b.text) <= floor(0.1 * n + 1e-9)),
 hits as (select a, b, n, y, list_transform(string_split(x, ''), lambda c: list_transform(string_split(y, ''), lambda d: cast(c = d as int))) as m from close),
 scored as (select a, b, n, list_max(list_reduce(m, lambda best, hit: list_transform(generate_series(1, len(best)),
 lambda i: list_max(({_BETTER})[1:i])), list_transform(string_split(y, ''), lambda d: 0))) as common from hits),
 near as (select b, list(a) as earlier from scored where 200 * common >= {clusters.FUZZY_THRESHOLD} * n group by 1)"""
query("fuzzy_name_clusters", lambda s, d: clusters.fuzzy_name_clusters(names(s, d)),
      with_(BILLING, _FUZZY_SQL, _leaders_sql()).rstrip().replace("with ", "with recursive ", 1) + """
 select "productName", clean_name, coalesce(l.id, v.id) as cluster from keyed join v using (text) left join near on near.b = v.rn
 cross join final left join v l on l.rn = list_min(list_intersect(leaders, earlier))""")


def _vectors_sql(t):
    return f"""with recursive v as (select vec_id, cast(embedding as double[]) as e, row_number() over (order by vec_id) as rn from embeddings),
 near as (select b.rn as b, list(a.rn) as earlier from v a join v b on a.rn < b.rn
 where list_cosine_similarity(a.e, b.e) >= {t} group by 1),
 {_leaders_sql()}
 select v.vec_id as id, coalesce(l.vec_id, v.vec_id) as cluster from v left join near on near.b = v.rn cross join final
 left join v l on l.rn = list_min(list_intersect(leaders, earlier))"""


for suffix, t in (("", clusters.EMBEDDING_THRESHOLD), ("_loose", 0.35)):
    query("embedding_clusters" + suffix, lambda s, d, t=t: clusters.embedding_clusters(star.table(s, d, "embeddings"), t), _vectors_sql(t))


def _by_text(s, d):
    return names(s, d).select("productName").distinct().withColumn("cluster", preprocess_product_name("productName"))


_PERIOD = (dt.date(2024, 2, 1), dt.date(2024, 4, 30))
_LINES = ["productName", "totalProductPrice", "quantity", "brandName", "categoryName", "orderDate"]
_PERIOD_SQL = """period_lines as (select "productName", "totalProductPrice", cast(quantity as double) as quantity, "brandName", "categoryName",
 concat_ws(' | ', "productName", "brandName", "categoryName") as text from billing
 where "orderDate" between date '2024-02-01' and date '2024-04-30' and "productName" is not null)"""
query("period_product_lines", lambda s, d: clusters.period_product_lines(star.billing(s, d, _LINES), *_PERIOD),
      with_(BILLING, _PERIOD_SQL) + """select "productName", cast("totalProductPrice" as double) as "totalProductPrice", quantity,
 "brandName", "categoryName", text from period_lines""")


def _mode(column):
    return (f"""(select {column} from (select cluster as k, {column}, count(*) as n from lines_in where {column} is not null group by 1, 2) m
 where m.k = l.cluster order by n desc, {column} limit 1)""")


query("cluster_rollup", lambda s, d: clusters.cluster_rollup(
    clusters.period_product_lines(star.billing(s, d, _LINES), *_PERIOD), _by_text(s, d)),
      with_(BILLING, TEXTS, _PERIOD_SQL, """lines_in as (select p.* exclude (text), t.text as cluster from period_lines p join texts t using ("productName"))""",
            f"""rolled as (select cluster, {_mode('"productName"')} as product_name, {_mode('"brandName"')} as brand,
 {_mode('"categoryName"')} as category, total_sales, quantity_sold from (select cluster, cast(round(sum("totalProductPrice"), 2) as double) as total_sales,
 cast(sum(quantity) as bigint) as quantity_sold from lines_in group by 1) l)""")
      + "select row_number() over (order by total_sales desc, product_name, cluster) as s_no, product_name, brand, category, total_sales, quantity_sold, cluster from rolled")
